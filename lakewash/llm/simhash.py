"""SimHash near-duplicate detection with BK-trees.

A document's fingerprint is the bitwise majority of the XXH64 hashes of its
word shingles. Two fingerprints link when they differ in at most ``radius``
bits; the components of that graph are the groups of near duplicates.

How links are found without comparing all pairs:

1. Equal fingerprints are folded to one node first (a partial aggregation, so
   a group of copies holding a third of all rows is one row per task).
2. Two 64-bit values at distance <= r agree on at least ``b - r`` of ``b``
   blocks of their bits. Each node is sent to one bucket per choice of
   ``b - r`` blocks. ``b`` grows with the number of nodes, so the expected
   bucket stays small at any size; the result is exact for every ``b``.
3. Each bucket is one shard: a BK-tree whose children are keyed by the
   integer Hamming distance to the parent. The trees of a task are built and
   searched as arrays; a search follows only edges within the radius, and
   only a spanning forest of the links leaves the task.
4. A bucket with more than ``shard_rows`` nodes is dealt out again on each of
   five blocks of the bits in which its nodes vary, again and again; v varying
   bits allow 2^v nodes at most, so every bucket ends below ``shard_rows``.
   No task ever holds more than one bounded shard beside its stream.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakewash.llm import bloom, graph
from lakewash.llm.common import Apart, only, staged, table

SEED = 42
SHINGLE = 4
RADIUS = 4
SHARD_ROWS = 4096


# ------------------------------------------------------------- fingerprints

def fingerprint(text: bytes | None, size: int = SHINGLE) -> int:
    """The unsigned 64-bit fingerprint of one UTF-8 text (0: no word)."""
    words = (text or b"").lower().split()  # bytes: A-Z and the six ASCII white space characters only
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= size:
        return xxhash.xxh64_intdigest(line, SEED)
    starts = [0, *itertools.accumulate(len(w) + 1 for w in words)]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[s:e - 1], SEED) for s, e in zip(starts, starts[size:])], np.uint64)
    votes = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at:at + (1 << 16)]
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): the fingerprint of each whole text as a signed long."""
    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            fps = np.fromiter((fingerprint(t.as_py(), size) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    docs = only(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return docs.mapInArrow(per_batch, "doc_id long, fp long")


# ----------------------------------------------------------------- BK-trees

def bk_links(fp: np.ndarray, group: np.ndarray, radius: int, step: int = 8192) -> tuple[np.ndarray, np.ndarray]:
    """Links among distinct fingerprints of the same group as two index arrays
    (member, least member of its component). ``group`` is sorted.

    The BK-trees of all groups grow together, one level at a time: the first
    node of each subtree becomes a vertex, the rest go to the child keyed by
    their Hamming distance to it.
    """
    n = len(fp)
    parent, edge = np.full(n, -1), np.zeros(n, np.int64)
    rest, tree = np.arange(n), group.astype(np.int64)
    up = np.full(n, -1)
    via = np.zeros(n, np.int64)
    while len(rest):
        first = np.ones(len(rest), bool)
        first[1:] = tree[1:] != tree[:-1]
        vertex = rest[first][np.cumsum(first) - 1]
        heads = rest[first]
        parent[heads], edge[heads] = up[heads], via[heads]
        keep = ~first
        rest, vertex = rest[keep], vertex[keep]
        dist = np.bitwise_count(fp[rest] ^ fp[vertex]).astype(np.int64)
        up[rest], via[rest] = vertex, dist
        key = vertex * 65 + dist
        order = np.argsort(key, kind="stable")
        rest, tree = rest[order], key[order]

    child = np.flatnonzero(parent >= 0)
    keys = parent[child] * 65 + edge[child]
    order = np.argsort(keys, kind="stable")
    child, keys = child[order], keys[order]
    head = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if n else np.zeros(0, np.int64)
    root = head[np.searchsorted(head, np.arange(n), "right") - 1] if n else head

    label = np.arange(n)

    def join(a: np.ndarray, b: np.ndarray) -> None:
        while True:
            la, lb = label[a], label[b]
            differ = la != lb
            if not differ.any():
                return
            a, b, la, lb = a[differ], b[differ], la[differ], lb[differ]
            low = np.minimum(la, lb)
            np.minimum.at(label, la, low)
            np.minimum.at(label, lb, low)
            while True:
                jumped = label[label]
                if (jumped == label).all():
                    break
                label[:] = jumped

    for at in range(0, n, step):
        q = np.arange(at, min(n, at + step))
        node = root[q]
        while len(q):
            d = np.bitwise_count(fp[q] ^ fp[node]).astype(np.int64)
            hit = (d <= radius) & (q != node)
            if hit.any():
                join(q[hit], node[hit])
            lo = np.searchsorted(keys, node * 65 + np.maximum(d - radius, 0))
            hi = np.searchsorted(keys, node * 65 + np.minimum(d + radius, 64), "right")
            count = hi - lo
            q = np.repeat(q, count)
            total = np.cumsum(count)
            node = child[np.repeat(lo - (total - count), count) + np.arange(len(q))]
    member = np.flatnonzero(label != np.arange(n))
    return member, label[member]


def _forest_of_batches(radius: int, hold: int):
    """Streams rows (mask, val, fp) sorted by bucket; whole buckets are
    searched together, about ``hold`` rows at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] = []

        def links(block: np.ndarray) -> pa.RecordBatch:
            new = np.r_[True, (block[1:, :2] != block[:-1, :2]).any(1)]
            size = np.diff(np.r_[np.flatnonzero(new), len(block)])
            group = np.cumsum(new) - 1
            many = size[group] > 1
            fp, group = block[many, 2].view(np.uint64), group[many]
            a, b = bk_links(fp, group, radius)
            fp = fp.view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(fp[a]), pa.array(fp[b])], ["u", "v"])

        for batch in batches:
            if not batch.num_rows:
                continue
            kept.append(np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)], axis=1))
            if sum(map(len, kept)) >= hold:
                block = np.concatenate(kept)
                last = block[-1, :2]
                cut = int(np.flatnonzero((block[:, :2] != last).any(1))[-1]) + 1 if (block[:, :2] != last).any() else 0
                if cut:
                    yield links(np.ascontiguousarray(block[:cut]))
                kept = [block[cut:]]
        if kept and sum(map(len, kept)):
            yield links(np.ascontiguousarray(np.concatenate(kept)))
    return run


# ------------------------------------------------------------------ buckets

def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _blocks(bits: list[int], parts: int) -> list[int]:
    """The bit positions cut into ``parts`` runs of nearly equal length, as masks."""
    cuts = [round(i * len(bits) / parts) for i in range(parts + 1)]
    return [sum(1 << b for b in bits[lo:hi]) for lo, hi in zip(cuts, cuts[1:])]


def block_count(nodes: int, radius: int) -> int:
    """Blocks such that a bucket of evenly spread fingerprints holds under 64
    of ``nodes``; every count from radius + 1 on gives the same links."""
    blocks = radius + 1
    while blocks < 2 * radius and nodes / 2 ** (64 * (blocks - radius) // blocks) > 64:
        blocks += 1
    return blocks


def _masks(nodes: int, radius: int) -> list[int]:
    blocks = block_count(nodes, radius)
    runs = _blocks(list(range(64)), blocks)
    return [sum(c) for c in itertools.combinations(runs, blocks - radius)]


def _finer(varying: int, radius: int) -> list[int]:
    """Masks that fix, beside the bits that a bucket's nodes all share, one of
    radius + 1 blocks of the bits in which they vary (as signed longs)."""
    vary = varying & ((1 << 64) - 1)
    shared = ~vary & ((1 << 64) - 1)
    bits = [b for b in range(64) if vary >> b & 1]
    return sorted({_signed(shared | run) for run in _blocks(bits, radius + 1)})


def _bucketed(nodes: DataFrame, masks: Column) -> DataFrame:
    return (nodes.select("fp", F.explode(masks).alias("mask"))
            .select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("val"), "fp"))


def links(nodes: DataFrame, radius: int = RADIUS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Edges (u, v) whose components are those of all links among the distinct
    fingerprints ``nodes`` (fp)."""
    if shard_rows < 2 ** (radius + 1):  # fewer varying bits than blocks could not be split
        raise ValueError("shard_rows must be at least 2 ** (radius + 1)")
    spark = nodes.sparkSession
    masks = _masks(nodes.count(), radius)
    todo = _bucketed(nodes, F.array(*[F.lit(_signed(m)) for m in masks]))
    search = _forest_of_batches(radius, hold=1 << 17)
    found = None
    finer = F.udf(lambda vary: _finer(vary, radius), T.ArrayType(T.LongType()), useArrow=False)  # a call for each large bucket
    while True:
        large = staged(todo.groupBy("mask", "val").agg(
            F.count("*").alias("n"), F.bit_or("fp").bitwiseXOR(F.bit_and("fp")).alias("vary"))
            .where(F.col("n") > shard_rows).select("mask", "val", finer("vary").alias("masks")), "large-buckets")
        hot = not large.isEmpty()
        small = todo.join(large.select("mask", "val"), ["mask", "val"], "left_anti") if hot else todo
        # many more shards than cores; a shard is bounded, so no key can swell a task
        parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
        edges = (small.repartition(parts, "mask", "val").sortWithinPartitions("mask", "val", "fp")
                 .mapInArrow(search, "u long, v long"))
        edges = staged(edges.distinct(), "links")
        found = edges if found is None else found.unionByName(edges)
        if not hot:
            return found
        rest = todo.join(large, ["mask", "val"]).select("fp", F.explode("masks").alias("mask"))
        # buckets with the same nodes, met under several masks, become the same ones
        todo = staged(rest.select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("val"), "fp").distinct(), "rebucketed")


# ----------------------------------------------------------------- operator

def simhash_components(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS,
                       shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``.

    ``fingerprint`` is 16 lower-case hex digits, ``component_id`` the smallest
    doc_id among all documents reachable over links, the document included.

    Edge cases: a null or empty text has no word and the fingerprint zero,
    which links like any other. A null doc_id keeps its row and still carries
    links; it is never a component's id unless all its members are null.
    Repeated rows stay repeated. An empty table gives no rows. Other columns
    of ``docs`` are ignored.
    """
    fps = staged(fingerprints(docs, shingle), "fingerprints")
    nodes = staged(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "nodes")
    roots = graph.components(links(nodes.select("fp"), radius, shard_rows))
    rooted = nodes.join(roots, nodes.fp == roots.node, "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = staged(rooted.join(least, "root").select(F.col("fp").alias("node_fp"), "component_id"), "classes")
    return (fps.join(classes, fps.fp == classes.node_fp)
            .select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"))


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one document of each component: the one whose doc_id is
    the component's id.

    Edge cases: where several rows carry that doc_id, or the doc_id is null,
    the row whose text has the least hash stays (of equal rows, one). Empty
    texts are one group.
    """
    found = staged(simhash_components(docs, shingle, radius), "components")
    rows = found.groupBy("doc_id").agg(F.count("*").alias("n"))
    keeper = found.where(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    kept = staged(rows.join(keeper, "doc_id", "left_semi").select(F.col("doc_id").alias("kept_id"), "n"), "keepers")
    own = Apart(docs)
    doc_id = own["doc_id"].cast("long")
    same = doc_id == F.col("kept_id")
    # A verdict for each document grows with the corpus, and joining it would
    # move every text. Most documents stay: those whose id is surely none of
    # the ids that go (a Bloom filter) stay where they are, and only the others
    # are joined, for the exact answer.
    alone = kept.where("n = 1")
    going = staged(rows.where("doc_id is not null").join(alone, F.col("doc_id") == F.col("kept_id"), "left_anti")
                   .select(F.xxhash64("doc_id").alias("h")), "going")
    flags = bloom.build(going, "h", bloom.bits_for(going.count()))
    hashed = own.rows.where(doc_id.isNotNull()).withColumn("_h", F.xxhash64(doc_id))
    stay = bloom.prefilter(hashed, "_h", flags, may=False).drop("_h")
    out = stay.unionByName(bloom.prefilter(hashed, "_h", flags).drop("_h").join(alone.hint("merge"), same, "left_semi"))
    # the least row by content, found with a partial aggregation
    everything = F.struct(*own.name.values())
    least = F.min_by(everything, F.struct(F.xxhash64(own["text"]), F.to_json(everything))).alias("_row")
    twice = kept.where("n > 1")
    if not twice.isEmpty():  # ids that several rows carry
        again = own.rows.join(twice, same, "left_semi").groupBy(doc_id.alias("_id")).agg(least).select("_row.*")
        out = out.unionByName(again)
    if not found.where("component_id is null").isEmpty():
        # components without any id: their documents take a hash of the text as id
        bare = staged(own.rows.where(doc_id.isNull()).withColumn("_t", F.xxhash64(F.coalesce(own["text"], F.lit("")))), "bare")
        with_id = found.where("component_id is not null").select("fingerprint").distinct()
        alone = simhash_components(bare.select(F.col("_t").alias("doc_id"), own["text"].alias("text")), shingle, radius)
        keep = (alone.join(with_id, "fingerprint", "left_anti").where("doc_id = component_id")
                .select(F.col("doc_id").alias("_kept_t")).distinct())
        rest = bare.join(keep, F.col("_t") == F.col("_kept_t"), "left_semi")
        out = out.unionByName(rest.groupBy("_t").agg(least).select("_row.*"))
    return own.back(out)


def op1_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))
