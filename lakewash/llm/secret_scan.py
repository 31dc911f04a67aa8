"""Secret scans: key patterns plus a randomness test battery, in column
expressions only.

Patterns give the base spans. The method looks at every other token of at
least ``MIN_TOKEN`` characters of ``[A-Za-z0-9+/_-]`` that holds a digit and
asks how much likelier its characters are under a random key than under the
corpus's ordinary text:

* an encoding is inferred from the token's alphabet (hex, lower- or
  upper-case base36, base62, base64);
* three tests against that alphabet: chi-squared uniformity of its
  characters, a runs test of letter/digit changes, and the lag-one serial
  correlation of the alphabet places. A token that fails one of them at
  ``RANDOM_LEVEL`` (Bonferroni over the three) is not random and is let go;
* for the rest, a p-value against ordinary text: the chance that a token of
  that length changes between digits, lower and upper case as often as this
  one does, at the rate of the corpus's median word. Words are shorter than
  any tested token, so keys have no part in that rate however many there are.
  It is divided by the battery's own p-value, the three joined by Fisher's
  method: a token that fits a random key less well needs more evidence, and
  the quotient never understates the chance;
* long tokens give more evidence, so the level a token has to reach depends on
  its length: the Benjamini-Hochberg step-up runs over these quotients of all tested tokens of a
  length band, with as many tests as the band has different tokens in the
  whole corpus. Copies of a token are one test and one discovery.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakewash.llm.common import Apart, let, only, staged, table
from lakewash.llm.spans import SPAN, digest, pattern_spans, running

# Fixed values of the result contract.
KINDS = ("assign", "access", "hex")
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"  # a run of A-Z0-9 that is too short has no later start that is long enough
HEX = r"[0-9a-f]{24,}"  # runs are maximal, so a minimum in the pattern drops exactly the short ones
ASSIGN_VALUE = 6

MIN_TOKEN = 20
TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}(?![A-Za-z0-9+/_-])"
ALPHABETS = (  # encoding, what its tokens match, alphabet
    ("hex", r"^([0-9a-f]+|[0-9A-F]+)$", "0123456789abcdef"),
    ("base36", r"^([0-9a-z]+|[0-9A-Z]+)$", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("base62", r"^[0-9A-Za-z]+$", "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("base64", r".", "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/_-"),
)
#: Between digits and others, and between lower and upper case.
CLASS_CHANGE = r"(?<=[0-9])(?=[^0-9])|(?<=[^0-9])(?=[0-9])|(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[a-z])"
RANDOM_LEVEL = 0.01
REPLACEMENT = "[SECRET]"
FALSE_DISCOVERY = 0.001
#: Tokens are banded by length, and p-values by this many steps for a factor ten.
BANDS = (32, 48, 64, 128)
STEPS = 4


# --------------------------------------------------------------- base spans

def base_spans(text: Column) -> Column:
    """Spans of the three base kinds, by start and then kind as listed."""
    value = F.lit(ASSIGN_VALUE)
    assign = pattern_spans(text, ASSIGN, "assign", 0,
                           lambda hit: F.length(F.regexp_extract(hit, ASSIGN, 2)) >= value)
    return F.concat(assign, pattern_spans(text, ACCESS, "access", 1), pattern_spans(text, HEX, "hex", 2))


def _by_start(spans: Column) -> Column:
    return F.sort_array(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["ord"].alias("ord"), s["end"].alias("end"), s["kind"].alias("kind"))))


# ------------------------------------------------------------------ battery

def _tail(z: Column) -> Column:
    """P(Z > z) of a standard normal (Zelen and Severo's polynomial, error
    under 1e-7; beyond 5 the leading term of Mills' ratio)."""
    def upper(a: Column) -> Column:
        dens = F.exp(-a * a / 2) / math.sqrt(2 * math.pi)
        poly = let(1 / (1 + 0.2316419 * a), lambda t: t * (0.319381530 + t * (-0.356563782 + t * (
            1.781477937 + t * (-1.821255978 + t * 1.330274429)))))
        return F.when(a > 5, dens / a).otherwise(dens * poly)

    # bound once: an argument written out again for each use would multiply the plan
    return let(z, lambda x: let(upper(F.abs(x)), lambda up: F.when(x >= 0, up).otherwise(1 - up)))


def _both(z: Column) -> Column:
    return F.least(F.lit(1.0), 2 * _tail(F.abs(z)))


def battery(tokens: DataFrame) -> DataFrame:
    """``tokens`` (tok) with the inferred encoding and the p-values of the
    three tests under a uniformly random token of that encoding.

    p_uniform: chi-squared of the character counts, as a normal by its exact
    mean and variance under the multinomial (right for short tokens too).
    p_runs: changes between letters and digits, given their numbers.
    p_serial: correlation of neighbouring alphabet places.
    """
    kind, letters = F.lit(ALPHABETS[-1][0]), F.lit(ALPHABETS[-1][2])
    for name, shape, alphabet in reversed(ALPHABETS[:-1]):
        kind = F.when(F.col("tok").rlike(shape), F.lit(name)).otherwise(kind)
        letters = F.when(F.col("tok").rlike(shape), F.lit(alphabet)).otherwise(letters)
    one_case = F.col("encoding").isin("hex", "base36")
    df = tokens.withColumn("encoding", kind).withColumn("alphabet", letters)
    df = df.withColumn("body", F.when(one_case, F.lower("tok")).otherwise(F.col("tok")))
    n, m = F.length("body").cast("double"), F.length("alphabet").cast("double")
    counts = F.transform(F.split("alphabet", ""), lambda c: (
        F.length("body") - F.length(F.replace(F.col("body"), c))).cast("double"))
    places = F.transform(F.split("body", ""), lambda c: F.position(c, F.col("alphabet")).cast("double"))
    df = df.withColumn("n", n).withColumn("m", m).withColumn("places", places).withColumn(
        "chi2", F.aggregate(counts, F.lit(0.0), lambda s, c: s + (c - n / m) * (c - n / m) / (n / m)))
    # mean and variance of Pearson's statistic under equal cell chances
    z_uniform = (F.col("chi2") - (m - 1)) / F.sqrt(2 * (m - 1) * (n - 1) / n)
    mean = F.aggregate("places", F.lit(0.0), lambda s, x: s + x) / n
    df = df.withColumn("mean", mean)
    cover = F.aggregate(F.sequence(F.lit(0), F.size("places") - 2), F.lit(0.0), lambda s, i: s + (
        (F.get(F.col("places"), i) - F.col("mean")) * (F.get(F.col("places"), i + 1) - F.col("mean"))))
    spread = F.aggregate("places", F.lit(0.0), lambda s, x: s + (x - F.col("mean")) * (x - F.col("mean")))
    z_serial = F.when(spread > 0, (cover / spread + 1 / n) * F.sqrt(n)).otherwise(F.sqrt(n))
    digits = F.length(F.regexp_replace("body", "[^0-9]", "")).cast("double")
    changes = F.length(F.regexp_replace("body", r"(?<=[0-9])(?=[^0-9])|(?<=[^0-9])(?=[0-9])", " ")) - F.length("body")
    other = n - digits
    runs_mean = 2 * digits * other / n
    runs_var = runs_mean * (2 * digits * other - n) / (n * (n - 1))
    z_runs = F.when(runs_var > 0, (changes - runs_mean) / F.sqrt(runs_var)).otherwise(F.lit(0.0))
    return (df.withColumn("p_uniform", _tail(z_uniform)).withColumn("p_serial", _both(z_serial))
            .withColumn("p_runs", _both(z_runs))
            .withColumn("digits", digits).drop("alphabet", "places", "mean", "body", "chi2"))


def _log_fisher(*p_values: str) -> Column:
    """Logarithm of the p-value that Fisher's method joins these to: the tail
    of chi-squared with twice as many degrees of freedom, in closed form."""
    t = -sum(F.log(F.greatest(F.col(p), F.lit(1e-300))) for p in p_values)
    terms, term = F.lit(1.0), F.lit(1.0)
    for k in range(1, len(p_values)):
        term = term * t / k
        terms = terms + term
    return F.log(terms) - t


def _changes(token: Column) -> Column:
    return (F.length(F.regexp_replace(token, CLASS_CHANGE, " ")) - F.length(token)).cast("double")


def word_rate(docs: DataFrame) -> DataFrame:
    """One row: how often the corpus's median word changes between character
    classes, for each of its characters. Every different run of token
    characters too short to be tested is one word; null where there is none."""
    runs = F.array_distinct(F.split(F.coalesce("text", F.lit("")), "[^A-Za-z0-9+/_-]+"))
    words = (only(docs, "text").select(F.explode(runs).alias("word"))
             .where((F.length("word") > 1) & (F.length("word") < MIN_TOKEN)).distinct())
    return words.agg(F.percentile_approx(_changes(F.col("word")) / F.length("word"), 0.5, 1000).alias("usual"))


def random_tokens(tokens: DataFrame, level: float = FALSE_DISCOVERY, usual: DataFrame | None = None) -> DataFrame:
    """``tokens`` (tok and any others) that pass the battery and the
    length-aware false-discovery control, with their encoding. ``usual`` is the
    row of :func:`word_rate`; without it words count as free of changes."""
    length = F.length("tok")
    band = F.lit(len(BANDS))
    for i, top in reversed(list(enumerate(BANDS))):
        band = F.when(length <= top, F.lit(i)).otherwise(band)
    marked = tokens.withColumn("band", band).withColumn("_changes", _changes(F.col("tok")))
    # every different candidate counts as a test, also one without a digit
    different = marked.select("band", "tok").distinct()
    # half a change for each candidate keeps the rate above zero
    usual = tokens.sparkSession.createDataFrame([(0.0,)], "usual double") if usual is None else usual
    lengths = different.agg(F.avg(F.length("tok")).alias("mean_len")).join(F.broadcast(usual))  # one row
    plain = different.groupBy("band").agg(F.count("*").alias("tests")).join(F.broadcast(lengths))  # one row
    # written first, so that the filter reads three numbers and does not repeat the battery
    tested = staged(battery(marked.where("tok rlike '[0-9]' and tok rlike '[A-Za-z]'")), "battery").where(
        F.least("p_uniform", "p_serial", "p_runs") > RANDOM_LEVEL / 3)
    rate = F.greatest(F.coalesce("usual", F.lit(0.0)), 0.5 / F.col("mean_len"))
    mean = rate * (F.col("n") - 1)
    # Poisson tail P(X >= changes) by Chernoff's bound, which never understates it
    x = F.col("_changes")
    log_p = F.when(x > mean, x - mean - x * F.log(x / mean)).otherwise(F.lit(0.0))
    log_p = F.least(log_p - _log_fisher("p_uniform", "p_runs", "p_serial"), F.lit(0.0))
    step = F.floor(-log_p / math.log(10) * STEPS).cast("int")  # rounded towards the larger p-value
    scored = staged(tested.join(F.broadcast(plain), "band").withColumn("step", step), "scored")  # one row a band
    found = (scored.select("band", "step", "tok", "tests").distinct()
             .groupBy("band", "step").agg(F.count("*").alias("c"), F.first("tests").alias("tests")))
    # a row for each step of a band: their number grows with the longest token, not with the corpus
    down = Window.partitionBy("band").orderBy(F.col("step").desc())
    least = (found.withColumn("at_least", F.sum("c").over(down))
             # Benjamini-Hochberg: the weakest p-value p with p <= level * discoveries / tests
             .where(F.pow(F.lit(10.0), -F.col("step") / STEPS) <= level * F.col("at_least") / F.col("tests"))
             .groupBy("band").agg(F.min("step").alias("least_step")))
    return (scored.join(F.broadcast(least), "band").where("step >= least_step")  # one row a band
            .select(*tokens.columns, "encoding"))


# ----------------------------------------------------------------- operator

_ADDED = "array<struct<start:int,ord:int,end:int,kind:string>>"


def _cells(docs: DataFrame) -> DataFrame:
    """doc_id, a hash of the text, base spans and the tokens outside them."""
    rows = only(docs, "doc_id", "text").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = rows.select("doc_id", F.xxhash64("text").alias("digest"), base_spans(F.col("text")).alias("base"),
                        pattern_spans(F.col("text"), TOKEN, "token", 0).alias("toks"))
    free = F.filter("toks", lambda t: ~F.exists(
        "base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))
    return staged(found.select("doc_id", "digest", _by_start(F.col("base")).alias("base"), F.transform(
        free, lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"), t["hit"].alias("tok"))).alias("toks")),
        "secret-cells")


def _added(cells: DataFrame, docs: DataFrame) -> DataFrame:
    """(id, digest, added): the random tokens of each text in ``cells``, the
    cells of ``docs``, that has any. Equal rows share an entry, so a text
    copied many times is one."""
    tokens = (cells.where(F.size("toks") > 0).select(F.col("doc_id").alias("id"), "digest", F.explode("toks").alias("t"))
              .select("id", "digest", "t.*").distinct())
    span = F.struct("start", F.lit(len(KINDS)).alias("ord"), "end", F.concat(F.lit("random-"), "encoding").alias("kind"))
    return staged(random_tokens(tokens, usual=staged(word_rate(docs), "word-rate")).groupBy("id", F.col("digest").alias("_digest"))
                  .agg(F.sort_array(F.collect_set(span)).alias("added")), "secret-added")


def _same(doc_id: Column, digest_: Column) -> Column:
    return doc_id.eqNullSafe(F.col("id")) & (digest_ == F.col("_digest"))


def secret_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, base, added) for every row of ``docs``: ``base`` the pattern
    spans, ``added`` the random tokens outside them, as arrays of
    struct(start, ord, end, kind); starts and ends in code points.

    Edge cases: a null or empty text has no span. Each row gives one row,
    repeated rows too; a null doc_id is kept. An empty table gives no rows;
    extra columns are ignored. A very long text is scanned whole, in time n log n
    for n matches in it.
    """
    cells = _cells(docs)
    return (cells.drop("toks").join(_added(cells, docs), _same(F.col("doc_id"), F.col("digest")), "left")
            .select("doc_id", "base", F.coalesce("added", F.array().cast(_ADDED)).alias("added")))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_spans(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(digest(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        digest(F.sort_array(F.concat("base", "added"))).alias("spans"))


#: Characters of a block that a text is cut into before spans are taken out.
BLOCK = 4096


def redact_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with every base or added span replaced by ``[SECRET]``
    (overlapping spans by one) and n_chars set to the new length.

    Edge cases: a row without a secret, also one with a null text, is
    unchanged; column order and extra columns stay.
    """
    own = Apart(docs)
    text = F.coalesce(own["text"], F.lit(""))
    joined = own.rows.join(_added(_cells(docs), docs), _same(own["doc_id"], F.xxhash64(text)), "left")

    def cut(spans: Column) -> Column:
        def pieces(ends: Column, blocks: Column) -> Column:
            def between(begin: Column, end: Column) -> Column:
                # a substring walks its text from the first character: here from that of a block
                block = F.floor(begin / BLOCK).cast("int")
                near = F.array_join(F.slice(blocks, block + 1, F.floor(end / BLOCK).cast("int") - block + 1), "")
                return F.substring(near, begin - block * BLOCK + 1, end - begin)

            # a span that starts before the furthest end so far belongs to the region before it
            first = F.filter(F.sequence(F.lit(0), F.size(spans) - 1), lambda i: (i == 0) | (
                F.get(spans, i)["start"] >= F.get(ends, i - 1)))
            return let(first, lambda at: F.concat(
                F.array_join(F.transform(at, lambda i: let(
                    F.when(i == 0, 0).otherwise(F.get(ends, i - 1)), lambda begin: F.concat(
                        between(begin, F.get(spans, i)["start"]), F.lit(REPLACEMENT)))), ""),
                between(F.element_at(ends, -1), F.length(text))))
        return let(running(F.transform(spans, lambda s: s["end"]), F.greatest), lambda ends: let(
            F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0)), lambda blocks: pieces(ends, blocks)))

    spans = F.sort_array(F.concat(_by_start(base_spans(text)), F.coalesce("added", F.array().cast(_ADDED))))
    out = joined.withColumn("_clean", let(spans, lambda all_: F.when(F.size(all_) > 0, cut(all_))))
    swap = {"text": F.coalesce(F.col("_clean"), own["text"])}
    if "n_chars" in docs.columns:
        swap["n_chars"] = F.when(F.col("_clean").isNotNull(), F.length("_clean").cast(docs.schema["n_chars"].dataType)).otherwise(
            own["n_chars"])
    return out.select(*[swap.get(c.lower(), F.col(n)).alias(c) for c, n in own.name.items()])
