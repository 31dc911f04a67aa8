"""Mixing sources to target weights by subset-sum budget fitting.

Every source gets a target of words. Whole passes over the source are taken
first (a target of 2.4 times the source takes each document twice); the rest
is a budget that a subset of its documents must fill:

1. documents are counted by exact token length, one row per (source, length);
2. per source, each length gets its share of the budget by seeded rounding,
   then a bounded-knapsack dynamic programme over what is left of each length
   closes the remaining gap exactly where a subset sum allows it;
3. within a length, the documents with the least seeded hash are taken.

Only the length histogram of a source meets in one task. D distinct lengths
need at least D^2 / 2 words, so 10^14 words cannot have more than 1.5 * 10^7
rows there, however many documents a source has. Picking the first k of a
length is dealt out over hash buckets, so a source with a third of all rows,
or a length that very many documents share, is never one window.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakewash.llm.common import WORD_RE, Apart, only, staged, table
from lakewash.operators.ids import OCCURRENCE, with_occurrence

SEED = 20240601
WEIGHTS = (1, 2, 3)
MAX_REPEAT = 3
#: Words that the dynamic programme decides, or more where documents are longer.
DP_BUDGET = 1 << 16
#: Cells of its table at most (12 bytes each).
MAX_CELLS = 1 << 22
#: Documents of one length are picked within hash buckets of about this size.
BUCKET_ROWS = 2_000


def sizes(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """(doc_id, source, size, pick): words of each whole text, and the seeded
    hash that orders documents of one length."""
    rows = only(docs, "doc_id", "source", "text")
    return rows.select(
        "doc_id", "source",
        F.coalesce(F.regexp_count("text", F.lit(WORD_RE)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64(F.lit(seed), "doc_id", F.xxhash64("text")).alias("pick"))


def targets(source_sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = MAX_REPEAT) -> DataFrame:
    """(source, source_size, target): the words of all sources shared by
    weight, each at most ``cap`` times its source, the excess reshared by
    weight until no source is above. Sources by code point, null last.

    A source is full exactly if its words per unit of weight are at or below a
    water level, so the sources are sorted by source_size / weight and the
    level is the first that the ones before it, full, leave for the rest:
    running sums instead of rounds of resharing.
    """
    pattern = F.array(*[F.lit(float(w)) for w in weights])
    # windows over one row per source, not over documents
    by_name = Window.orderBy(F.col("source").isNull(), F.encode("source", "utf-8"))
    ranked = source_sizes.withColumn("weight", F.element_at(
        pattern, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))
    ratio = (F.col("source_size") / F.col("weight"))
    by_ratio = Window.orderBy(ratio, F.col("source").isNull(), F.encode("source", "utf-8"))
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onwards = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    levelled = (ranked
                .withColumn("full_before", F.coalesce(F.sum(cap * F.col("source_size")).over(before), F.lit(0)).cast("double"))
                .withColumn("weight_left", F.sum("weight").over(onwards))
                .withColumn("total", F.sum("source_size").over(everything).cast("double"))
                .withColumn("level", (F.col("total") - F.col("full_before")) / F.col("weight_left"))
                # the first source, by ratio, that the level does not fill
                .withColumn("open", F.col("level") <= cap * ratio)
                .withColumn("water", F.first(F.when(F.col("open"), F.col("level")), ignorenulls=True).over(
                    by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))))
    full = (cap * F.col("source_size")).cast("double")
    return levelled.select("source", "source_size", F.when(
        F.col("water").isNull() | (cap * ratio < F.col("water")), full).otherwise(
            F.col("weight") * F.col("water")).alias("target"))


# ------------------------------------------------------------- budget fitting

def closest_subset(weights: list[int], goal: int, cells: int = MAX_CELLS) -> list[int]:
    """Places of those ``weights`` whose sum comes nearest to ``goal`` from below.

    Sums are counted in the weights' common divisor. Each cell of the table
    holds the first sum found in it and the weight that reached it, which is
    all that the way back needs. Up to ``cells`` units a cell is one sum and the
    result exact; above, a cell is a range of goal / cells units.
    """
    unit = math.gcd(*weights) if weights else 1
    goal //= unit
    grid = goal // cells + 1
    value = np.full(goal // grid + 1, -1, np.int64)
    choice = np.full(len(value), -1, np.int32)
    value[0] = 0
    for k, weight in enumerate(w // unit for w in weights):
        sums = value[value >= 0] + weight
        sums = sums[sums <= goal]
        sums = sums[value[sums // grid] < 0]
        value[sums // grid], choice[sums // grid] = sums, k
        if value[-1] == goal:
            break
    left, used = int(value.max()), []
    while left:  # a sum's own weight came after those of the sum before it
        used.append(int(choice[left // grid]))
        left -= weights[used[-1]] // unit
    return used


def fit_budget(lengths: np.ndarray, counts: np.ndarray, budget: int, seed: int = SEED,
               dp_budget: int = DP_BUDGET) -> np.ndarray:
    """How many documents of each length to take so that the words come as
    near to ``budget`` from below as the dynamic programme finds. It decides
    ``dp_budget`` words or four times the longest document, whichever is more;
    while that leaves a gap, four times as many, up to the whole budget or ``MAX_CELLS``."""
    take = np.zeros(len(lengths), np.int64)
    use = lengths > 0
    total = int((lengths[use] * counts[use]).sum())
    if budget <= 0 or total <= 0:
        return take
    if budget >= total:
        take[use] = counts[use]
        return take
    rng = np.random.default_rng(seed)
    share = budget / total
    take[use] = np.minimum(counts[use], np.floor(counts[use] * share + rng.random(int(use.sum())))).astype(np.int64)
    order = rng.permutation(np.flatnonzero(use))
    room, unit = max(dp_budget, 4 * int(lengths[use].max())), int(np.gcd.reduce(lengths[use]))
    while True:
        fitted = _fitted(lengths, counts, take, budget, order, room)
        missed = (budget - int((lengths * fitted).sum())) // unit
        if not missed or room >= min(budget, MAX_CELLS):
            return fitted
        room *= 4


def _fitted(lengths: np.ndarray, counts: np.ndarray, take: np.ndarray, budget: int, order: np.ndarray, room: int) -> np.ndarray:
    """``take`` changed so that about ``room`` words of the budget are chosen by the programme."""
    take = take.copy()
    gap = budget - int((lengths * take).sum())
    for i in order:  # documents taken go back, in seeded order, until the programme has room
        if gap >= room:
            break
        back = min(int(take[i]), -((gap - room) // int(lengths[i])))
        take[i] -= back
        gap += back * int(lengths[i])
    for i in order:  # far below: whole documents are taken until the gap fits
        if gap <= room:
            break
        more = min(int(counts[i] - take[i]), (gap - room) // int(lengths[i]))
        take[i] += more
        gap -= more * int(lengths[i])
    parts = []  # what is left of a length, in powers of two
    for i in order:
        left, part = int(counts[i] - take[i]), 1
        while left > 0 and part * int(lengths[i]) <= gap:
            part = min(part, left)
            parts.append((i, part))
            left -= part
            part *= 2
    for k in closest_subset([part * int(lengths[i]) for i, part in parts], gap):
        take[parts[k][0]] += parts[k][1]
    return take


def _plan(histogram: DataFrame, seed: int) -> DataFrame:
    """(source, size, full, picked): passes over the whole source, and how
    many documents of the length are taken once more."""
    def per_source(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("size", kind="stable")
        size, target = int(pdf["source_size"].iloc[0]), float(pdf["target"].iloc[0])
        full = min(MAX_REPEAT, int(target // size)) if size else 0
        budget = int(round(target)) - full * size if size else 0
        picked = fit_budget(pdf["size"].to_numpy(np.int64), pdf["n"].to_numpy(np.int64), budget, seed)
        return pd.DataFrame({"source": pdf["source"], "size": pdf["size"], "full": full, "picked": picked})

    return histogram.groupBy("source").applyInPandas(per_source, "source string, size long, full long, picked long")


def _same_source(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def mix(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) for every row of
    ``docs``; ``taken`` counts repeats.

    Edge cases: a null text has size 0, and a document of size 0 is taken 0
    words. A null source is a source of its own, sorted last. A null doc_id
    is a document like any other; of equal rows any may be taken, so the
    result is the same bag of rows on each run. Ties in the seeded hash are
    broken by doc_id. An empty table gives no rows. Extra columns are ignored.
    """
    sized = staged(sizes(docs, seed), "sizes")
    histogram = staged(sized.groupBy("source", "size").agg(F.count("*").alias("n")), "lengths")
    per_source = histogram.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    goals = staged(targets(per_source), "targets").withColumnRenamed("source", "_s")
    full = histogram.join(goals, _same_source(F.col("source"), F.col("_s"))).drop("_s")
    plan = staged(_plan(full, seed).withColumnRenamed("source", "_s2").withColumnRenamed("size", "_size2").join(
        full, _same_source(F.col("_s2"), F.col("source")) & (F.col("_size2") == F.col("size"))).select(
            F.col("source").alias("_s"), F.col("size").alias("_size"), "n", "source_size", "target", "full", "picked"),
        "mix-plan")
    buckets = F.greatest(F.lit(1), F.ceil(F.col("n") / BUCKET_ROWS)).cast("int")
    # the hash splits each length into ordered buckets; only the one where the quota ends needs ranks
    unit = (F.col("pick") / F.lit(float(1 << 64)) + F.lit(0.5))
    placed = sized.join(plan, _same_source(F.col("source"), F.col("_s")) & (F.col("size") == F.col("_size"))).drop(
        "_s", "_size").withColumn("bucket", F.least(F.floor(unit * buckets), buckets - 1).cast("int"))
    partial = (F.col("picked") > 0) & (F.col("picked") < F.col("n"))
    counts = placed.where(partial).groupBy("source", "size", "bucket").agg(F.count("*").alias("c"))
    upto = Window.partitionBy("source", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    edges = counts.select(F.col("source").alias("_s"), F.col("size").alias("_size"), F.col("bucket").alias("_bucket"),
                          F.coalesce(F.sum("c").over(upto), F.lit(0)).alias("before"))
    rank = Window.partitionBy("source", "size", "bucket").orderBy("pick", "doc_id")
    ranked = (placed.where(partial).withColumn("rank", F.row_number().over(rank))
              .join(edges, _same_source(F.col("source"), F.col("_s")) & (F.col("size") == F.col("_size"))
                    & (F.col("bucket") == F.col("_bucket")))
              .withColumn("chosen", (F.col("rank") + F.col("before") <= F.col("picked"))))
    rest = placed.where(~partial).withColumn("chosen", F.col("picked") > 0)
    cols = ["doc_id", "source", "size", "source_size", "target", "full", "chosen", "pick"]
    out = ranked.select(*cols).unionByName(rest.select(*cols))
    taken = F.col("size") * (F.col("full") + F.col("chosen").cast("long"))
    return out.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"), "pick")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


ADDED = ("size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The rows of ``docs`` that the mix takes, with size, source_size, target
    and taken (columns of these names in ``docs`` are replaced). A document
    taken several times is one row whose ``taken`` is a multiple of its size;
    a row the mix leaves out is dropped.

    The numbers are joined back by doc_id and the seeded hash. Rows that agree
    in both are equal documents: they share the words taken of them in whole
    documents, the first ones (numbered without gathering them) one more.
    """
    numbers = staged(mix(docs, seed), "mix")
    shares = staged(numbers.groupBy("doc_id", "pick").agg(
        F.first("size").alias("size"), F.first("source_size").alias("source_size"), F.first("target").alias("target"),
        F.count("*").alias("_rows"), F.sum("taken").alias("_words")).where("_words > 0").select(
            F.col("doc_id").alias("_id"), F.col("pick").alias("_pick"), "size", "source_size", "target", "_rows",
            (F.col("_words") / F.col("size")).cast("long").alias("_copies")), "mix-shares")
    own = Apart(docs)
    key = F.xxhash64(F.lit(seed), own["doc_id"], F.xxhash64(own["text"]))
    # a row for each document grows with the corpus: joined by a shuffle at every size, never broadcast
    joined = own.rows.join(shares.hint("merge"), own["doc_id"].eqNullSafe(F.col("_id")) & (key == F.col("_pick")))
    out = joined.where("_rows = 1").withColumn(OCCURRENCE, F.lit(0).cast("long"))
    if not shares.where("_rows > 1").isEmpty():
        equal = staged(joined.where("_rows > 1").withColumn("_key", F.concat_ws(":", "_id", "_pick")), "equal-documents")
        out = out.unionByName(with_occurrence(equal, "_key").drop("_key"))
    extra = F.when(F.col(OCCURRENCE) < F.col("_copies") % F.col("_rows"), 1).otherwise(0)
    taken = F.col("size") * (F.floor(F.col("_copies") / F.col("_rows")) + extra)
    done = out.withColumn("taken", taken.cast("long")).where("taken > 0")
    return done.select(
        *[F.col(n).alias(c) for c, n in own.name.items() if c.lower() not in ADDED], *ADDED)
