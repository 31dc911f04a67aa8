"""Quality rules with risk-controlled thresholds, in column expressions only.

Base measures come from each whole text. Beside the base rule, each metric
rule rejects a document whose metric exceeds a cutoff. Cutoffs are not
chosen by hand: for every stratum (language) and rule the strictest cutoff of
a fixed grid is taken for which all labelled good documents prove, by an exact binomial
bound, that at most ``risk`` of good documents would be rejected. All
(stratum, rule, cutoff) triples are tested at once, so the level of each test
is ``level`` divided by their number (Bonferroni): with probability
``1 - level`` every cutoff in use keeps its promise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewash.llm.common import Apart, let, only, staged, table

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: Largest share of a stratum's good documents that one rule may reject; the
#: five rules together reject at most five times that.
RISK = 0.01
#: Probability that any cutoff in use breaks its promise.
LEVEL = 0.05
#: Metric rules: a value above the cutoff rejects. Each grid goes from strict to lenient.
GRIDS = {
    "symbols_per_word": (0.05, 0.1, 0.2, 0.4, 0.8, 1.6),
    "dup_line_share": (0.1, 0.2, 0.3, 0.5, 0.7),
    "repeat_share": (0.02, 0.05, 0.1, 0.15, 0.2),
    "upper_share": (0.15, 0.3, 0.5, 0.7, 0.9),
    "chars_per_word": (9.0, 12.0, 16.0, 24.0, 40.0),
}


# ----------------------------------------------------------------- measures

def _words(text: Column) -> Column:
    return F.filter(F.split(F.translate(text, SPACE, " " * len(SPACE)), " "), lambda w: w != "")


def _repeat_words(words: Column) -> Column:
    """Words inside windows of ``WINDOW`` words found twice or more in the text.

    Windows are hashed; only a text with an equal pair goes on: its (hash,
    place) pairs are sorted, places whose neighbour has the same hash are
    sorted again, and each covers up to the next one. n log n at any length.
    """
    def covered(sorted_: Column) -> Column:
        same = F.filter(sorted_, lambda x, i: (
            F.coalesce(F.get(sorted_, i - 1)["h"] == x["h"], F.lit(False))
            | F.coalesce(F.get(sorted_, i + 1)["h"] == x["h"], F.lit(False))))
        places = F.sort_array(F.transform(same, lambda x: x["p"]))
        return let(places, lambda at: F.aggregate(
            F.transform(at, lambda p, i: F.least(F.coalesce(F.get(at, i + 1) - p, F.lit(WINDOW)), F.lit(WINDOW))),
            F.lit(0).cast("long"), lambda s, x: s + x))

    def from_hashes(hashes: Column) -> Column:
        pairs = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p")))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(
            let(F.sort_array(pairs), covered))

    def from_words(ws: Column) -> Column:
        windows = F.transform(F.sequence(F.lit(1), F.size(ws) - (WINDOW - 1)),
                              lambda i: F.xxhash64(F.slice(ws, i, WINDOW)))
        return F.when(F.size(ws) <= WINDOW, F.lit(0).cast("long")).otherwise(let(windows, from_hashes))

    return let(words, from_words)


def _measure(text: Column) -> Column:
    """The measures of one text (not null) as a struct."""
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    upper = F.length(text) - F.length(F.regexp_replace(text, r"\p{Lu}", ""))
    words = let(_words(text), lambda ws: F.struct(
        F.size(ws).cast("long").alias("n"), _repeat_words(ws).alias("repeat")))
    line = let(lines, lambda x: F.struct((F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"),
                                         F.size(x).cast("long").alias("n")))
    return let(F.struct(words.alias("w"), line.alias("l")), lambda c: F.struct(
        c["w"]["n"].alias("n_words"),
        F.length(F.translate(text, SPACE, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        c["l"]["dup"].alias("n_dup_lines"), c["w"]["repeat"].alias("n_repeat_words"),
        c["l"]["n"].alias("n_lines"), upper.cast("long").alias("n_upper")))


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper")


def measures(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, and ``MEASURES``) of each whole text. A null text has no word."""
    docs = only(docs, "doc_id", "text", "lang").withColumn("text", F.coalesce("text", F.lit("")))
    return docs.select("doc_id", "lang", _measure(F.col("text")).alias("m")).select("doc_id", "lang", "m.*")


def _base_failed(m=F.col) -> Column:
    """The base rule on measures: ``m`` gives a measure by its name."""
    return (m("n_words") < MIN_WORDS) | (100 * m("n_repeat_words") > MAX_REPEAT_PERCENT * m("n_words"))


def _metrics(m=F.col) -> dict[str, Column]:
    def over(top: str, below: str) -> Column:
        return F.when(m(below) > 0, m(top) / m(below)).otherwise(F.lit(0.0))
    return {"symbols_per_word": over("n_symbols", "n_words"), "dup_line_share": over("n_dup_lines", "n_lines"),
            "repeat_share": over("n_repeat_words", "n_words"), "upper_share": over("n_upper", "word_chars"),
            "chars_per_word": over("word_chars", "n_words")}


# --------------------------------------------------------------- thresholds

def _proved(n: Column, k: Column, risk: float, level: Column) -> Column:
    """Whether k of n prove a rate of at most ``risk``: P(X <= k) <= level for
    X binomial(n, risk), the exact (Clopper-Pearson) bound. Terms are summed
    from the k-th down as ratios to it, so nothing underflows; the k-th itself
    is a product of ratios in logarithms."""
    odds = risk / (1 - risk)
    log_k = F.aggregate(F.sequence(F.lit(1), k), n * F.log(F.lit(1 - risk)),
                        lambda s, j: s + F.log((n - j + 1) / j * odds))
    log_k = F.when(k > 0, log_k).otherwise(n * F.log(F.lit(1 - risk)))
    ratio = F.aggregate(
        F.sequence(F.lit(1), k), F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total")),
        lambda s, j: F.struct(
            (s["term"] * (k - j + 1) / ((n - (k - j)) * odds)).alias("term"),
            (s["total"] + s["term"] * (k - j + 1) / ((n - (k - j)) * odds)).alias("total")))["total"]
    ratio = F.when(k > 0, ratio).otherwise(F.lit(1.0))
    # beyond the mean the bound cannot hold, and the sum would be long
    return F.when(k >= n * risk, F.lit(False)).otherwise(log_k + F.log(ratio) <= F.log(level))


def cutoffs(measured: DataFrame, labels: DataFrame, risk: float = RISK, level: float = LEVEL) -> DataFrame:
    """(stratum, one column per rule): the strictest proved cutoff, null where
    none is proved, from all good (quality 1) labelled documents that pass the
    base rule. A document labelled both 0 and 1 counts as good."""
    good = (only(labels, "doc_id", "quality").where("quality = 1 and doc_id is not null")
            .select(F.col("doc_id").alias("labelled_id")).distinct())
    stratum = F.coalesce(F.col("lang"), F.lit("")).alias("stratum")
    passed = measured.where(~_base_failed()).select("doc_id", stratum, *[m.alias(r) for r, m in _metrics().items()])
    held = passed.join(good, passed.doc_id == good.labelled_id, "left_semi")
    tests = [(r, c) for r, grid in GRIDS.items() for c in grid]
    counts = held.groupBy("stratum").agg(F.count("*").alias("n"), *[
        F.count(F.when(F.col(r) > c, True)).alias(f"k{i}") for i, (r, c) in enumerate(tests)])
    strata = counts.agg(F.count("*").alias("strata"))
    at = F.lit(level) / (F.col("strata") * len(tests))
    proved = counts.join(F.broadcast(strata))  # one row
    best = []
    for rule, grid in GRIDS.items():
        arms = [F.when(_proved(F.col("n"), F.col(f"k{i}"), risk, at), F.lit(c))
                for i, (r, c) in enumerate(tests) if r == rule]
        best.append(F.coalesce(*arms).alias(f"max_{rule}"))
    return proved.select("stratum", *best)


def _broken(m=F.col) -> Column:
    """The rules that measures break, given the stratum's cutoffs in the row."""
    return F.filter(F.array(*[F.when(x > F.col(f"max_{r}"), F.lit(r)) for r, x in _metrics(m).items()]),
                    lambda r: r.isNotNull())


def quality_rules(docs: DataFrame, labels: DataFrame, risk: float = RISK, level: float = LEVEL) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, failed_rules) for every row of ``docs``.

    Edge cases: a null or empty text has no word and fails the base rule. A
    null language counts as the empty one. A stratum without enough labelled
    good documents gets no cutoff, so its documents are judged by the base
    rule alone. A null doc_id is measured and judged like any other but can
    carry no label. Repeated rows are judged alike; an empty table gives no
    rows; extra columns are ignored. A metric that equals its cutoff passes.
    """
    measured = staged(measures(docs), "measures")  # a few numbers for each document; texts are read once
    limits = cutoffs(measured, labels, risk, level).withColumnRenamed("stratum", "_stratum")
    # one row for each language that occurs among labelled documents
    joined = measured.join(limits, F.coalesce(F.col("lang"), F.lit("")) == F.col("_stratum"), "left")
    broken = _broken()
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        _base_failed().alias("base_failed"),
        (~_base_failed() & (F.size(broken) == 0)).alias("kept"),
        broken.alias("failed_rules"))


def keep_good(docs: DataFrame, labels: DataFrame, risk: float = RISK, level: float = LEVEL) -> DataFrame:
    """The rows of ``docs`` that the quality rules keep, unchanged; edge cases
    as in :func:`quality_rules`.

    Texts are measured a second time beside the row they belong to, so no text
    is shuffled and no key is needed to join verdicts back.
    """
    limits = staged(cutoffs(staged(measures(docs), "measures"), labels, risk, level), "cutoffs")
    own = Apart(docs)
    text, lang = (F.coalesce(own[c], F.lit("")) for c in ("text", "lang"))
    judged = own.rows.join(limits.withColumnRenamed("stratum", "_stratum"), lang == F.col("_stratum"), "left")
    # one expression, so that each text is measured once however many rules read a measure
    good = let(_measure(text), lambda m: ~_base_failed(m.getField) & (F.size(_broken(m.getField)) == 0))
    return own.back(judged.where(good))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("failed_rules")


_GRID_SQL = ", ".join(f"('{r}', {c})" for r, grid in GRIDS.items() for c in grid)
_METRIC_SQL = {
    "symbols_per_word": "n_symbols / nullif(n_words, 0)", "dup_line_share": "n_dup_lines / nullif(n_lines, 0)",
    "repeat_share": "n_repeat_words / nullif(n_words, 0)", "upper_share": "n_upper / nullif(word_chars, 0)",
    "chars_per_word": "word_chars / nullif(n_words, 0)"}


def oracle_rows(docs: str = "documents") -> str:
    """DuckDB CTEs whose last one, ``verdicts``, has the operator's rows and
    the row number ``rid`` of each document."""
    metrics = " UNION ALL ".join(
        f"SELECT rid, doc_id, stratum, base_failed, '{r}' AS rule, coalesce({m}, 0.0)::DOUBLE AS value FROM based"
        for r, m in _METRIC_SQL.items())
    return rf"""
src AS (SELECT row_number() OVER () AS rid, *, coalesce(text, '') AS body FROM {docs}),
split AS (SELECT rid, doc_id, coalesce(lang, '') AS stratum, body,
    regexp_extract_all(body, '[^\x20\x09-\x0D]+') AS ws,
    list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM src),
wins AS (SELECT rid, i, list_slice(ws, i, i + {WINDOW - 1}) AS win
    FROM (SELECT rid, ws, unnest(range(1, len(ws) - {WINDOW - 2})) AS i FROM split WHERE len(ws) >= {WINDOW})),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, win) AS c FROM wins) WHERE c > 1),
covered AS (SELECT rid, sum(least({WINDOW}, coalesce(nxt - i, {WINDOW})))::BIGINT AS n
    FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt FROM twice) GROUP BY rid),
measured AS (SELECT s.rid, doc_id, stratum, len(ws)::BIGINT AS n_words,
    length(regexp_replace(body, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(body, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines)::BIGINT AS n_lines,
    length(regexp_replace(body, '\P{{Lu}}', '', 'g'))::BIGINT AS n_upper,
    coalesce(c.n, 0)::BIGINT AS n_repeat_words FROM split s LEFT JOIN covered c USING (rid)),
based AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed
    FROM measured),
vals AS ({metrics}),
good AS (SELECT DISTINCT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL),
grid AS (SELECT * FROM (VALUES {_GRID_SQL}) AS g(rule, cutoff)),
tests AS (SELECT stratum, rule, cutoff, count(*)::BIGINT AS n, count(*) FILTER (value > cutoff)::BIGINT AS k
    FROM vals JOIN grid USING (rule) WHERE NOT base_failed AND doc_id IN (SELECT doc_id FROM good) GROUP BY ALL),
proved AS (SELECT stratum, rule, min(cutoff) AS cutoff FROM tests,
    (SELECT count(*) AS m FROM tests) WHERE k < n * {RISK} AND list_sum(list_transform(range(k + 1), lambda j:
        exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln({RISK}) + (n - j) * ln(1 - {RISK}))))
        <= {LEVEL} / m GROUP BY ALL),
broken AS (SELECT DISTINCT rid FROM vals JOIN proved USING (stratum, rule) WHERE value > cutoff),
verdicts AS (SELECT rid, doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND rid NOT IN (SELECT rid FROM broken) AS kept FROM based)"""


ORACLE = f"WITH {oracle_rows()} SELECT * EXCLUDE (rid) FROM verdicts"

