"""URL filters with a path-template tree.

Block and allow rules judge the urls they fit. The rest is judged by what the
rules say about like urls of the same host:

1. paths are counted per host once (a hot host is pre-aggregated), and cut
   into segments; a segment made of digits becomes ``<n>`` (its extension
   stays), one of hex digits or a date ``<id>``;
2. a tree grows per host. A node takes all segments that its paths have in
   common at once, then branches. Where a node has more than
   ``MANY_CHILDREN`` children, those with a small share each are one variable
   segment ``<*>``; of the rest, branches whose labelled shares do not differ
   significantly (two-proportion test, both with evidence) are merged. A node
   without a labelled url grows no further;
3. a template (a path from the root) has the smoothed share of blocked urls of
   the nearest node on it that has labelled urls, itself first. It is rejected
   if that purity reaches ``REJECT_PURITY``.

Levels are joins and partial aggregations over (host, prefix). There are as
many as labelled paths of one host branch below each other, whatever their
depth; the only thing gathered for one node is its at most
``MANY_CHILDREN + 1 / SMALL_SHARE`` remaining children with evidence.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakewash.llm.common import only, staged, table

#: (host, path, verdict): fixed values of the result contract.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"),
         ("org", "/fr/", "allow"))
MANY_CHILDREN = 20
SMALL_SHARE = 0.05
#: Labelled urls that a branch needs to be compared with another.
EVIDENCE = 10
SIGNIFICANT_Z = 1.96
#: Weight of the neutral prior (a half) in a template's purity, and where it rejects.
PRIOR_WEIGHT = 4.0
REJECT_PURITY = 0.9
#: Where a path ends: a segment that no url has, before all others.
END = "\x00"


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path): host after the first ``://`` up to /, ?, # or the end,
    A-Z lower-cased; path from there up to ?, # or the end. A null url, or one
    without ``://``, has both empty."""
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.coalesce(F.regexp_extract(url, parts, 1), F.lit(""))
    return (F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"),
            F.coalesce(F.regexp_extract(url, parts, 2), F.lit("")))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls. A rule fits
    its host and all subdomains if the path starts with the rule's."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        rule = F.when(fits, F.lit(h + p)).otherwise(rule)
        verdict = F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def _typed(segment: Column) -> Column:
    """A segment of digits, hex digits or a date as its type; the extension stays."""
    extension = F.regexp_extract(segment, r"(\.[A-Za-z][A-Za-z0-9]{0,5})$", 1)
    stem = F.regexp_replace(segment, r"\.[A-Za-z][A-Za-z0-9]{0,5}$", "")
    return (F.when(stem.rlike(r"^[0-9]+$"), F.concat(F.lit("<n>"), extension))
            .when(stem.rlike(r"^[0-9]{4}-[0-9]{2}(-[0-9]{2})?$|^(?=.*[0-9])[0-9a-fA-F-]{8,}$"),
                  F.concat(F.lit("<id>"), extension)).otherwise(segment))


def _merge_branches(children: list) -> dict[str, str]:
    """Segment to branch name for one node's children (seg, bad, labelled):
    in order of their blocked share, a branch joins the one before it if both
    have evidence and their shares do not differ significantly."""
    names: dict[str, str] = {}
    groups: list[list] = []
    ready = sorted((c for c in children if c["labelled"] >= EVIDENCE),
                   key=lambda c: (c["bad"] / c["labelled"], c["seg"]))
    for c in ready:
        if groups:
            bad, n = sum(x["bad"] for x in groups[-1]), sum(x["labelled"] for x in groups[-1])
            both = (bad + c["bad"]) / (n + c["labelled"])
            sd = math.sqrt(max(both * (1 - both), 1e-12) * (1 / n + 1 / c["labelled"]))
            if abs(bad / n - c["bad"] / c["labelled"]) <= SIGNIFICANT_Z * sd:
                groups[-1].append(c)
                continue
        groups.append([c])
    for group in groups:
        segs = sorted(x["seg"] for x in group)
        name = segs[0] if len(segs) == 1 else "{" + "|".join(segs) + "}"
        names.update({s: name for s in segs})
    for c in children:
        names.setdefault(c["seg"], c["seg"])
    return names


# one call for each node that has two branches with evidence, not for each url
_merge = F.udf(_merge_branches, T.MapType(T.StringType(), T.StringType()), useArrow=False)


def _purity(bad: Column, labelled: Column) -> Column:
    return (bad + PRIOR_WEIGHT / 2) / (labelled + PRIOR_WEIGHT)


def _in_common(low: Column, high: Column) -> Column:
    """How many segments all lists share that lie between two in order."""
    size = F.least(F.size(low), F.size(high))
    differs = F.filter(F.sequence(F.lit(0), F.greatest(size - 1, F.lit(0))),
                       lambda i: ~F.get(low, i).eqNullSafe(F.get(high, i)))
    return F.when(size == 0, 0).otherwise(F.coalesce(F.get(differs, F.lit(0)), size))


def _take_common(rows: DataFrame) -> DataFrame:
    """``rows`` after each node took the segments that all its paths begin
    with, or all that is left where nothing in the node is labelled, and its
    purity where something is."""
    node = rows.groupBy("host", "prefix").agg(
        F.sum("bad").alias("_bad"), F.sum("labelled").alias("_labelled"),
        F.min("rest").alias("_low"), F.max("rest").alias("_high")).select(
            "host", "prefix", (F.col("_labelled") > 0).alias("_evidence"),
            _purity(F.col("_bad"), F.col("_labelled")).alias("_own"),
            _in_common(F.col("_low"), F.col("_high")).alias("_common"))
    count = F.when(F.col("_evidence"), F.col("_common")).otherwise(F.size("rest"))
    taken = F.filter(F.slice("rest", F.lit(1), count), lambda x: x != END)
    return rows.join(node, ["host", "prefix"]).select(
        "host", "path", "n", "bad", "labelled",
        F.slice("rest", count + 1, F.size("rest")).alias("rest"),
        F.concat("prefix", F.array_join(F.transform(taken, lambda x: F.concat(F.lit("/"), x)), "")).alias("prefix"),
        F.when(F.col("_evidence"), F.col("_own")).otherwise(F.col("purity")).alias("purity"))


def _branch(rows: DataFrame) -> DataFrame:
    """``rows`` one segment further, each in the branch its segment falls in."""
    seg = F.get("rest", F.lit(0)).alias("seg")
    child = staged(rows.groupBy("host", "prefix", seg).agg(
        F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.sum("labelled").alias("labelled")), "tree-children")
    node = child.groupBy("host", "prefix").agg(F.count("*").alias("children"), F.sum("n").alias("all"))
    variable = ((F.col("children") > MANY_CHILDREN) & (F.col("n") < SMALL_SHARE * F.col("all"))
                & ~F.col("seg").startswith("<") & (F.col("seg") != END))
    child = child.join(node, ["host", "prefix"]).withColumn("variable", variable)
    ready = child.where(~F.col("variable") & (F.col("labelled") >= EVIDENCE) & (F.col("seg") != END))
    merged = (ready.groupBy("host", "prefix").agg(F.collect_list(F.struct("seg", "bad", "labelled")).alias("kids"))
              .where(F.size("kids") > 1).select("host", "prefix", F.explode(_merge("kids")).alias("seg", "merged")))
    names = staged(child.join(merged, ["host", "prefix", "seg"], "left").select(
        "host", "prefix", "seg", F.when(F.col("variable"), F.lit("<*>")).otherwise(F.coalesce("merged", "seg")).alias("name")),
        "tree-names")
    return rows.withColumn("seg", seg).join(names, ["host", "prefix", "seg"]).select(
        "host", "path", "n", "bad", "labelled", F.slice("rest", F.lit(2), F.size("rest")).alias("rest"),
        F.when(F.col("seg") == END, F.col("prefix")).otherwise(F.concat("prefix", F.lit("/"), "name")).alias("prefix"),
        "purity")


def templates(paths: DataFrame) -> DataFrame:
    """``paths`` (host, path, n, bad, labelled; host and path unique) with the
    template each path falls under and its purity."""
    segments = F.transform(F.split(F.regexp_replace("path", "^/", ""), "/"), _typed)
    growing = staged(paths.select(
        "host", "path", "n", "bad", "labelled", F.concat(segments, F.array(F.lit(END))).alias("rest"),
        F.lit("").alias("prefix"), F.lit(0.5).alias("purity")), "tree")
    done = []
    while True:
        moved = staged(_take_common(growing), "tree")
        done.append(moved.where(F.size("rest") == 0))
        growing = moved.where(F.size("rest") > 0)
        if growing.isEmpty():
            break
        growing = staged(_branch(growing), "tree")
    found = done[0]
    for more in done[1:]:
        found = found.unionByName(more)
    return found.drop("rest").withColumnRenamed("prefix", "template")


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, purity) for every row of
    ``pages``.

    Edge cases: a null url, or one without ``://``, has an empty host and path
    and the verdict allow unless its template is impure. A template of a
    host without labelled urls has the neutral purity and is allowed. A path
    of any depth is judged by all its segments. A null page_id keeps
    its row; repeated rows are counted and judged alike; an empty table gives
    no rows; extra columns are ignored.
    """
    host, path = split_url(F.col("url"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    split = only(pages, "page_id", "url").select("page_id", host.alias("host"), path.alias("path")).withColumn(
        "rule", rule).withColumn("ruled", verdict)
    paths = split.groupBy("host", "path").agg(
        F.count("*").alias("n"), F.count(F.when(F.col("ruled") == "block", True)).alias("bad"),
        F.count("ruled").alias("labelled"))
    known = staged(templates(paths).select(
        F.col("host").alias("_host"), F.col("path").alias("_path"), "template", "purity"), "judged-paths")
    return split.join(known, (F.col("host") == F.col("_host")) & (F.col("path") == F.col("_path"))).select(
        "page_id", "host", "path", "rule",
        F.coalesce("ruled", F.when(F.col("purity") >= REJECT_PURITY, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        "template", "purity")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages")).drop("purity")
