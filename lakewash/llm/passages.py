"""Near-duplicate passages across documents by compact windows.

Every document is the sequence of its five-word shingles. Under a min-hash
function, the Cartesian tree of the shingles' hashes groups all subsequences
that share a signature: a tree node (l, c, r) stands for every subsequence
that lies in [l, r] and holds c, since c is the least there. Only nodes of
``2 * SIDE - 1`` shingles or more are kept; they are the least elements of
sliding windows, so the tree is built over a few places per document.

Two documents that share a run of that many shingles share the node of its
least shingle c, and ``SIDE`` shingles to the left or to the right of c lie in
the run: their hashes, where they lie in [l, r], are the keys of the interval
join. Two passages of ``MIN_WORDS`` words that follow one another with a shingle
similarity of ``SIMILARITY`` share such a run: a changed, added or missing
word breaks four or five shingles, so one break leaves a run of 21 of the least
passage's 46, and a passage with more breaks is longer and leaves a longer one.
The key intervals of a run touch, and lack fewer than ``SIDE`` shingles at either end.

What lies beyond is compared in two rounds, beside the keys where a document's
shared intervals end. First the intervals are lengthened to the ends of their runs:
every second of the next ``SIDE - 1`` shingles gives a code of its hash, the key's and
the distance, and one that two documents have proves the words up to it. Then, for runs
that are long enough for a passage but in none yet, each shingle for a passage's length
gives a code of its hash and the key's: one that two documents have is a shared shingle
beside a shared key, at whatever distance, across the changed words.

A passage is a stretch of a document with c shared of n shingles that a passage
of m shingles or more (m: those of ``MIN_WORDS`` words) can match with the asked Jaccard
similarity t, c >= t (n + m) / (1 + t), n counting as m at least, and c >= t n.

Keys and codes are aggregated to a least and a greatest document before anything
is joined, so a passage that a third of all documents hold is one row per task,
and no pair of documents is ever written out.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakewash.llm import bloom
from lakewash.llm.bloom import may_hold
from lakewash.llm.common import only, staged, table, unstaged
from lakewash.llm.words import Words, _powers, lowered, mix, shingles, slices, text_buffer

SHINGLE = 5
MIN_WORDS = 50
SIMILARITY = 0.8
HASHES = 1
#: Shingles of one side of a node: 11 shingles are 15 words.
SIDE = 11
#: Words between two shared stretches of one passage.
GAP = 16
#: Bits of the filters that spare the join keys of one document alone (4 MB).
BLOOM_BITS = 1 << 25
#: Shingles that one code of a run's end stands for.
STEP = 2
#: Bytes of the texts whose words are in memory at once.
SLICE = 500_000
#: Bytes of the texts that look for their shared codes at once.
LOT = 4_000_000
#: Tells the right of a key from its left in the filter of keys to compare beside.
_RIGHT = 0x38495AB5E6546B64
_BASE = 0xC2B2AE3D27D4EB4F | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def _sliding(values: np.ndarray, width: int, op) -> np.ndarray:
    """``op`` (least or greatest) of every window of ``width`` elements, by doubling."""
    span = 1
    while 2 * span <= width:
        values = op(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return op(values[:-rest], values[rest:]) if rest else values


def compact_windows(values: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(l, c, r) of the Cartesian tree's nodes with r - l + 1 >= ``width``,
    for distinct ``values`` (the least is the root).

    A node is that wide exactly if it is the least of some window of
    ``width`` elements; the ancestors of such a node are as wide, so the
    bounds l and r are found among these nodes alone.
    """
    n = len(values)
    empty = np.zeros(0, np.int64)
    if n < width:
        return empty, empty, empty
    least = _sliding(values, width, np.minimum)
    beyond = np.full(width - 1, values.min())
    # the greatest least of the windows around a place is its value only if it is one of them
    at = np.flatnonzero(_sliding(np.concatenate((beyond, least, beyond)), width, np.maximum) == values)
    left, right, stack = np.zeros(len(at), np.int64), np.full(len(at), n - 1), []
    vals, places = values[at].tolist(), at.tolist()
    for k, v in enumerate(vals):
        while stack and vals[stack[-1]] > v:
            right[stack.pop()] = places[k] - 1
        left[k] = places[stack[-1]] + 1 if stack else 0
        stack.append(k)
    return left, at, right


def _distinct(values: np.ndarray, apart: np.ndarray) -> np.ndarray:
    """The hashes with their low bits replaced by the place, so that equal
    shingles are told apart and the first of them is the least. The places
    ``apart`` are less than all others, so that no node reaches across one."""
    at = np.arange(len(values), dtype=np.uint64)
    bits = np.uint64(len(values).bit_length())
    return np.where(apart, at, (values >> np.uint64(1) | np.uint64(1 << 63)) >> bits << bits | at)


def _nodes(texts: pa.Array, rids: np.ndarray, hashes: int, side: int, fewest: int):
    """For each slice of the texts: the shingles' hashes, and of every node's
    sides the arrays sig, rid, place of the first shingle in its text, place
    of the text's first shingle, number of the text's shingles. Texts of fewer
    than ``fewest`` shingles hold no passage. The texts of a slice are one row of
    values; a text's end parts its nodes from the next one's."""
    for lo, hi in slices(texts, SLICE):
        data, offsets = text_buffer(texts.slice(lo, hi - lo))
        words = Words(lowered(data), offsets)
        sh = shingles(words.hashes(), SHINGLE)
        sizes = np.diff(words.first) - SHINGLE + 1
        text = words.text[:len(sh)]
        apart = (np.arange(len(sh)) - words.first[text] >= sizes[text]) | (sizes[text] < fewest)
        if apart.all():
            continue
        total = np.zeros(len(sh) + 1, np.uint64)
        np.cumsum(sh * _powers(_BASE, len(sh)), out=total[1:])
        back = _powers(_INVERSE, len(sh) + 1)
        salts, begins, leasts = [], [], []
        for i in range(hashes):
            left, at, right = compact_windows(_distinct(mix(sh, 11 + i), apart), 2 * side - 1)
            inside = ~apart[at]
            for begin, ok, salt in ((at - side + 1, at - side + 1 >= left, 2 * i),
                                    (at, at + side - 1 <= right, 2 * i + 1)):
                begins.append(begin[ok & inside])
                leasts.append(at[ok & inside])
                salts.append(np.full(len(begins[-1]), salt, np.uint64))
        at, salt, own = np.concatenate(begins), np.concatenate(salts), text[np.concatenate(leasts)]
        run = (total[at + side] - total[at]) * back[at]
        first = words.first[own]
        yield sh, mix(run ^ mix(salt, 101)), rids[lo + own], at - first, first, sizes[own]


def _keys_of_batch(texts: pa.Array, rids: np.ndarray, hashes: int, side: int, fewest: int):
    """Arrays (sig, rid, start) of every node's sides: start is a word's place."""
    for _, sig, owner, begin, _, _ in _nodes(texts, rids, hashes, side, fewest):
        yield sig.view(np.int64), owner, begin.astype(np.int32)


def _codes_of_batch(texts: pa.Array, rids: np.ndarray, hashes: int, side: int, fewest: int, flags: bytes, far: bool):
    """Arrays (code, rid, place) beside the keys that the Bloom filter may hold,
    place being a shingle's in its text. To the end of a run, a code is of the key,
    the distance and the shingle there and stands for ``STEP`` shingles from place
    on; ``far``, it is of the key, the direction and the shingle at place."""
    for sh, sig, owner, begin, first, n in _nodes(texts, rids, hashes, side, fewest):
        for right in (False, True):
            held = may_hold(flags, sig ^ np.uint64(_RIGHT if right else 0))
            key, rid, at, text = sig[held], owner[held], begin[held], first[held]
            room = np.minimum(n[held] - at - side if right else at, fewest - SHINGLE if far else side - 1)
            steps = room if far else room // STEP
            of = np.repeat(np.arange(len(key)), steps)
            away = (np.arange(len(of)) - np.repeat(np.cumsum(steps) - steps, steps) + 1) * (1 if far else STEP)
            shingle = sh[text[of] + (at[of] + side - 1 + away if right else at[of] - away)]
            salt = mix(key, 103 + right)[of] if far else mix(key, 105 + right)[of] + away.astype(np.uint64)
            place = at[of] + side + away - (1 if far else STEP) if right else at[of] - away
            yield mix(shingle ^ salt).view(np.int64), rid[of], place.astype(np.int32)


def _first_of(*columns: np.ndarray) -> np.ndarray:
    """Where the rows of sorted columns differ from the row before."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.logical_or.reduce([x[1:] != x[:-1] for x in columns])
    return np.flatnonzero(new)


def _ranges_of_codes(found) -> Iterator[tuple]:
    """(code, low, high): the least and the greatest text of each code."""
    for code, rid, _ in found:
        if len(code):
            order = np.argsort(code)
            code, rid = code[order], rid[order]
            at = _first_of(code)
            yield code[at], np.minimum.reduceat(rid, at), np.maximum.reduceat(rid, at)


def _marks_of_codes(found, shared: np.ndarray, low: np.ndarray, high: np.ndarray, step: int) -> Iterator[tuple]:
    """(rid, s, e, other): the places of the shared codes (sorted), with the least of the
    other texts; those that follow one another with the same one are one mark."""
    def least(rid, place, other):
        order = np.lexsort((other, place, rid))
        at = order[_first_of(rid[order], place[order])]
        return rid[at], place[at], other[at]

    parts = [(np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int64))]
    for code, rid, place in found:
        at = np.minimum(np.searchsorted(shared, code), len(shared) - 1)
        held = shared[at] == code
        rid, at = rid[held], at[held]
        parts.append(least(rid, place[held], np.where(rid == low[at], high[at], low[at])))
    rid, place, other = least(*(np.concatenate(x) for x in zip(*parts)))
    order = np.lexsort((place, place % step, other, rid))
    rid, place, other = rid[order], place[order], other[order]
    begin = _first_of(rid, other, place - step * np.arange(len(place)))
    end = place[np.r_[begin[1:], len(place)][:len(begin)] - 1] + step
    yield rid[begin], place[begin], end.astype(np.int32), other[begin]


def _of_texts(docs: DataFrame, schema: str, arrays) -> DataFrame:
    """Rows of the arrays that ``arrays`` gives for batches of texts; rid is a
    hash of doc_id and text."""
    names = [x.split()[0] for x in schema.split(", ")]

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for found in arrays(batch.column("text"), batch.column("rid").to_numpy(zero_copy_only=False)):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], names)

    return only(docs, "doc_id", "text").select(_rid().alias("rid"), "text").mapInArrow(per_batch, schema)


def window_keys(docs: DataFrame, hashes: int = HASHES, side: int = SIDE, min_words: int = MIN_WORDS) -> DataFrame:
    """(sig, rid, start): the interval of side + SHINGLE - 1 words from ``start``
    on has the signature ``sig``; rid is a hash of doc_id and text."""
    return _of_texts(docs, "sig long, rid long, start int",
                     lambda texts, rids: _keys_of_batch(texts, rids, hashes, side, min_words - SHINGLE + 1))


def shared_beside(docs: DataFrame, hits: DataFrame, asked: DataFrame, far: bool, hashes: int = HASHES, side: int = SIDE,
                  min_words: int = MIN_WORDS) -> tuple[DataFrame, tuple[DataFrame, ...]]:
    """(rid, s, e, other): shingles s up to e that another document has too
    beside a key of ``asked`` (its column ``kind``). Every document's codes
    are counted, as one may end where another goes on; ``hits`` tells which
    documents hold a key, and the others are not read again.

    A text has far more codes than shared places, and near texts have the same ones. So the
    texts are dealt into lots of ``LOT`` bytes; of a lot's codes each one moves once,
    with the least and the greatest text, and those that two texts have come back to the lot,
    whose texts then give their places. Second come the staged tables that the rows are read from.
    """
    flags = docs.sparkSession.sparkContext.broadcast(bloom.build(asked, "kind", BLOOM_BITS))
    texts = staged(_lots(docs, bloom.build(_holders(hits, flags), "rid", BLOOM_BITS)), "lots")
    step = 1 if far else STEP

    def codes(column: pa.Array, rids: np.ndarray):
        return _codes_of_batch(column, rids, hashes, side, min_words - SHINGLE + 1, flags.value, far)

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lots = batch.column("lot").to_numpy(zero_copy_only=False)
            bounds = [*_first_of(lots).tolist(), len(lots)]
            for lo, hi in zip(bounds, bounds[1:]):
                part = batch.slice(lo, hi - lo)
                for code, low, high in _ranges_of_codes(codes(part.column("text"), part.column("rid").to_numpy(zero_copy_only=False))):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(code), lots[lo])), *map(pa.array, (code, low, high))],
                                                     ["lot", "code", "low", "high"])

    def places(own: pa.Table, shared: pa.Table) -> pa.Table:
        names = ["rid", "s", "e", "other"]
        if not len(own) or not len(shared):
            return pa.table([pa.array([], t) for t in (pa.int64(), pa.int32(), pa.int32(), pa.int64())], names)
        shared = shared.sort_by("code")
        found = codes(own.column("text").combine_chunks(), own.column("rid").to_numpy())
        marks = _marks_of_codes(found, *(shared.column(x).to_numpy() for x in ("code", "low", "high")), step)
        return pa.table([pa.array(x) for x in next(marks)], names)

    in_lots = staged(texts.mapInArrow(ranges, "lot long, code long, low long, high long"), "lot-codes")
    both = staged(_of_two(in_lots.select("code", F.explode(F.array("low", "high")).alias("rid")), "code"), "shared-codes")
    back = in_lots.select("lot", "code").join(both, F.col("code") == F.col("shared_code")).select(
        "lot", "code", both["low"], both["high"]).distinct()
    return texts.groupBy("lot").cogroup(back.groupBy("lot")).applyInArrow(
        places, "rid long, s int, e int, other long"), (texts, in_lots, both)


def _lots(docs: DataFrame, rids: bytes) -> DataFrame:
    """(lot, rid, text): the texts whose rid the filter may hold, in lots of ``LOT`` bytes;
    a longer text is a lot of its own."""
    held = docs.sparkSession.sparkContext.broadcast(rids)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, lot = TaskContext.get().partitionId(), 0
        for batch in batches:
            own = batch.column("rid").to_numpy(zero_copy_only=False).view(np.uint64)
            batch = batch.filter(pa.array(may_hold(held.value, own)))
            for lo, hi in slices(batch.column("text"), LOT):
                of = np.full(hi - lo, task << 32 | lot)
                lot += 1
                yield pa.RecordBatch.from_arrays([pa.array(of), *batch.slice(lo, hi - lo).columns], ["lot", "rid", "text"])

    return only(docs, "doc_id", "text").select(_rid().alias("rid"), "text").mapInArrow(deal, "lot long, rid long, text string")


def _holders(hits: DataFrame, flags) -> DataFrame:
    """(rid): the documents with a key that the filter may hold on either side."""
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sig = batch.column("sig").to_numpy(zero_copy_only=False).view(np.uint64)
            held = may_hold(flags.value, sig) | may_hold(flags.value, sig ^ np.uint64(_RIGHT))
            yield batch.select(["rid"]).filter(pa.array(held))

    return hits.select("sig", "rid").mapInArrow(keep, "rid long")


def _of_two(rows: DataFrame, key: str) -> DataFrame:
    """(key, low, high): the least and the greatest document of each key that
    two documents have."""
    return rows.groupBy(F.col(key).alias(f"shared_{key}")).agg(
        F.min("rid").alias("low"), F.max("rid").alias("high")).where("low <> high")


def _other():
    """One of the other documents of a shared key."""
    return F.when(F.col("rid") == F.col("low"), F.col("high")).otherwise(F.col("low")).alias("other")


def _at_ends(hits: DataFrame, side: int) -> DataFrame:
    """``hits`` and whether shingles that a run may add on the ``left`` or ``right``
    lie in no shared interval of the document. Inside an island of intervals
    all are shared already. ``before`` and ``after`` tell the next key of the
    island on either side and its distance.

    Intervals are equally long, so those that touch form islands, whose first
    and last one tell what they cover. The windows hold one document's nodes.
    """
    in_text = Window.partitionBy("rid").orderBy("start", "sig")
    island = Window.partitionBy("rid", "_island")
    ahead = F.lead("start").over(in_text) - F.col("start")
    behind = F.col("start") - F.lag("start").over(in_text)
    return (hits.withColumns({
        "before": F.when(behind <= side, F.xxhash64(F.lag("sig").over(in_text), behind)),
        "after": F.when(ahead <= side, F.xxhash64(F.lead("sig").over(in_text), ahead))})
        .withColumn("_island", F.sum(F.col("before").isNull().cast("int")).over(in_text))
        .withColumns({"left": F.min("start").over(island) > F.col("start") - side + 1,
                      "right": F.max("start").over(island) < F.col("start") + side - 1}).drop("_island"))


def _parting(hits: DataFrame) -> DataFrame:
    """(sig, left, right, left_open, right_open): the sides on which a key must
    be compared, and whether a document asks for it. A key that the same key follows
    at the same distance in every document leaves that side to the next key."""
    alone = lambda step: (F.min(step) < F.max(step)) | (F.count(step) < F.count(F.lit(1)))
    return hits.groupBy("sig").agg(
        F.coalesce(alone("before"), F.lit(True)).alias("left"), F.coalesce(alone("after"), F.lit(True)).alias("right"),
        F.bool_or("left").alias("left_open"), F.bool_or("right").alias("right_open")).where("left OR right")


def _kinds(keys: DataFrame, left: str, right: str) -> DataFrame:
    """(kind): the keys with the sides to compare, as the filter holds them."""
    return keys.select(F.explode(F.array(
        F.when(F.expr(left), F.col("sig")), F.when(F.expr(right), F.col("sig").bitwiseXOR(F.lit(_RIGHT))))).alias("kind")).where(
        "kind IS NOT NULL")


def _rid():
    return F.xxhash64("doc_id", "text")


def _enough(n: int, fewest: int, similarity: float) -> float:
    """Shingles that a stretch of n must share to be similar to one of
    ``fewest`` shingles or more."""
    return similarity * (max(n, fewest) + fewest) / (1 + similarity) - 1e-6


def _segments(runs: list[tuple[int, int]], weight: float) -> list[list[tuple[int, int]]]:
    """The maximal scoring stretches of runs of shared shingles (Ruzzo and
    Tompa): a shared shingle scores 1 - ``weight``, any other -``weight``."""
    found, total = [], 0.0
    for i, (s, e) in enumerate(runs):
        total -= weight * (s - runs[i - 1][1]) if i else 0
        mine = [i, total, total + (1 - weight) * (e - s)]  # first run, score before it and up to the last
        total = mine[2]
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][1] >= mine[1]:
                j -= 1
            if j < 0 or found[j][2] >= mine[2]:
                break
            mine[:2] = found[j][:2]
            del found[j:]
        found.append([*mine, i])
    return [runs[x[0]:x[3] + 1] for x in found]


def _short(runs: list[tuple[int, int]], fewest: int, similarity: float) -> Iterator[tuple[int, int]]:
    """Ranges of up to 2 * ``fewest`` shingles that share enough. A segment may leave
    out a short run beyond a changed word that its passage needs."""
    for i, (begin, _) in enumerate(runs):
        shared, best = 0, None
        for s, e in runs[i:]:
            if e - begin > 2 * fewest:
                break
            shared += e - s
            if shared >= max(_enough(e - begin, fewest, similarity), similarity * (e - begin)):
                best = begin, e
        if best:
            yield best


def _stretches(runs: list[tuple[int, int]], fewest: int, similarity: float, gap: int) -> list[tuple[int, int]]:
    """Passages, as ranges of shingles, among disjoint runs of shared ones."""
    tail = SHINGLE - 1  # a run's last shingle ends so many words later
    cut = [i for i in range(1, len(runs)) if runs[i][0] - runs[i - 1][1] - tail > gap]
    todo, found = [runs[a:b] for a, b in zip([0, *cut], [*cut, len(runs)])], []
    for near in todo:
        found += _short(near, fewest, similarity)
    while todo:
        for part in _segments(todo.pop(), similarity / (1 + similarity)):
            begin, end = part[0][0], part[-1][1]
            shared = sum(e - s for s, e in part)
            if shared < _enough(end - begin, fewest, similarity):
                continue
            holes = [b[0] - a[1] for a, b in zip(part, part[1:])]
            if shared >= similarity * (end - begin):
                found.append((begin, end))
            else:
                at = holes.index(max(holes)) + 1
                todo += [part[:at], part[at:]]
    # stretches that overlap are one passage as long as enough of it is shared
    starts, ends, upto = [x[0] for x in runs], [x[1] for x in runs], [0, *accumulate(e - s for s, e in runs)]
    out = []
    for begin, end in sorted(found, key=lambda x: (x[0], -x[1])):
        if out and end <= out[-1][1]:
            continue
        if out and begin < out[-1][1]:
            whole = out[-1][0], end
            if upto[bisect_right(ends, end)] - upto[bisect_left(starts, whole[0])] >= similarity * (end - whole[0]):
                out[-1] = whole
                continue
        out.append((begin, end))
    return out


def _runs(marks: list[tuple]) -> list[tuple[int, int]]:
    """Disjoint runs of sorted marks (start, end, ...)."""
    runs = []
    for s, e, *_ in marks:
        if runs and s <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(e, runs[-1][1]))
        else:
            runs.append((s, e))
    return runs


def _unplaced(fewest: int, similarity: float, gap: int, least: int):
    """Keys of the runs of ``least`` shingles or more that are in no passage."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = set()
            for spans in pdf["spans"]:
                marks = sorted((x["s"], x["e"], x["sig"]) for x in spans)
                runs = _runs(marks)
                found = _stretches(runs, fewest, similarity, gap)
                ends = [e for _, e in found]
                starts = [s for s, _, _ in marks]
                for s, e in runs:
                    at = bisect_left(ends, e)
                    if e - s >= least and not (at < len(found) and found[at][0] <= s):
                        out.update(x[2] for x in marks[bisect_left(starts, s):bisect_left(starts, e)])
            yield pd.DataFrame({"sig": np.array([x for x in out if x], np.int64)})
    return run


def _passages(fewest: int, similarity: float, gap: int):
    """Joins a document's shared shingles to passages."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for rid, spans in zip(pdf["rid"], pdf["spans"]):
                marks = sorted((x["s"], x["e"], x["other"]) for x in spans)
                starts = [x[0] for x in marks]
                for begin, end in _stretches(_runs(marks), fewest, similarity, gap):
                    share = {}
                    for s, e, o in marks[bisect_left(starts, begin):bisect_left(starts, end)]:
                        share[o] = share.get(o, 0) + e - s
                    out.append((rid, begin, end + SHINGLE - 1, min(share, key=lambda o: (-share[o], o))))
            yield pd.DataFrame(out, columns=["rid", "start_word", "end_word", "other"]).astype("int64")
    return run


def repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS, similarity: float = SIMILARITY,
                      hashes: int = HASHES, side: int = SIDE) -> DataFrame:
    """(doc_id, start_word, end_word, n_words, other_doc_id): the passages of
    each document that another document repeats, exactly or nearly; words are
    counted from 0, the end is exclusive, and ``other_doc_id`` is one of the
    documents that hold part of it.

    Edge cases: a null or empty text, and one below ``min_words`` words, has
    no passage. Equal rows (doc_id and text) are one document and reported
    once; the same text under two doc_ids is two documents that repeat each
    other. A null doc_id is reported as null. Of equal shingles in a text the
    first is the least. An empty table gives no rows; extra columns are ignored.
    """
    fewest = min_words - SHINGLE + 1
    how = hashes, side, min_words
    keys = staged(window_keys(docs, *how), "window-keys")
    shared = staged(_of_two(keys, "sig"), "shared-keys")
    hits = bloom.prefilter(keys, "sig", bloom.build(shared, "shared_sig", BLOOM_BITS)).join(
        shared, F.col("sig") == F.col("shared_sig")).select("sig", "rid", "start", _other())
    hits = staged(_at_ends(hits, side), "shared-windows")
    unstaged(keys, shared)
    parting = staged(_parting(hits), "parting-keys")
    near, near_from = shared_beside(docs, hits, _kinds(parting, "left AND left_open", "right AND right_open"), False, *how)
    # bounded by the document's own shingles: one mark each
    marks = staged(hits.select("rid", F.col("start").alias("s"), (F.col("start") + side).alias("e"), "other", "sig").unionByName(
        near.withColumn("sig", F.lit(0).cast("long"))).groupBy("rid", "s", "e", "sig").agg(F.min("other").alias("other")), "marks")
    unstaged(*near_from)
    spans = lambda rows, *c: rows.groupBy("rid").agg(F.collect_list(F.struct("s", "e", *c)).alias("spans"))
    # a run may lack STEP - 1 shingles at either end
    unplaced = spans(marks, "sig").mapInPandas(_unplaced(fewest, similarity, GAP, 2 * (side - STEP) + 1), "sig long").distinct()
    far, _ = shared_beside(docs, hits, _kinds(parting.join(staged(unplaced, "unplaced-keys"), "sig"), "left", "right"), True, *how)
    unstaged(hits)
    own = spans(marks.drop("sig").unionByName(far.groupBy("rid", "s", "e").agg(F.min("other").alias("other"))), "other")
    found = staged(own.mapInPandas(_passages(fewest, similarity, GAP),
                                   "rid long, start_word long, end_word long, other long"), "passages")
    ids = staged(only(docs, "doc_id", "text").select(_rid().alias("id_rid"), F.col("doc_id").cast("long").alias("id"))
                 .groupBy("id_rid").agg(F.first("id").alias("id")), "passage-ids")
    named = found.join(ids, F.col("rid") == F.col("id_rid")).select(
        F.col("id").alias("doc_id"), "start_word", "end_word", "other")
    return named.join(ids, F.col("other") == F.col("id_rid")).select(
        "doc_id", "start_word", "end_word", (F.col("end_word") - F.col("start_word")).alias("n_words"),
        F.col("id").alias("other_doc_id"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))
