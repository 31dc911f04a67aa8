"""Quality classifier from weak labels.

1. Heuristic labellers vote good, bad or nothing on every document (symbols,
   function words, capitals, repetition, tables, lines); a second set votes on
   insulting language (a lexicon, and words and word beginnings that mark the
   labelled toxic documents of a bounded sample).
2. Expectation-maximisation estimates each labeller's accuracies from how
   they agree, without labels. All documents count: votes form a bounded set
   of patterns, and only the patterns' counts reach the driver.
3. The posterior of a pattern labels a bounded, seeded sample of documents,
   which trains a linear scorer over hashed words, word beginnings and word
   shapes; the scorer judges every document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewash.llm.common import only, table
from lakewash.llm.words import Words, lowered, slices, text_buffer

SEED = 11
FEATURES = 1 << 14
#: Documents that the scorer is trained on, labelled rows that the marker
#: lexicon is drawn from, and entries of that lexicon, at most.
TRAIN_DOCS = 3_000
LABELLED_DOCS = 6_000
MARKERS = 400
#: Toxic documents of the sample that must hold a marker.
MARKER_DOCS = 8
PREFIX_BYTES = 6
EM_STEPS = 200
# Frequent function words of four languages, and insults.
FUNCTION_WORDS = (
    "the of and to in a is that it was for on with as be by this are at from have not or an "
    "der die das und ist in den von zu mit sich auf für nicht ein eine als auch es an dem des im "
    "le la les de des et un une est que dans pour qui sur pas avec du en au ce il "
    "el los las y en un una que es por con para se no su al lo como del").split()
INSULTS = ("idiot idiots moron morons scum trash worthless disgusting pathetic clown loser losers stupid filth "
           "vermin imbecile dumb garbage").split()

QUALITY_VOTERS = ("symbols", "marks", "function_words", "capitals", "shouts", "variety", "stutter", "tables", "lines")
TOXIC_VOTERS = ("insults", "markers", "marker_share")


def _hash_set(words: list[str]) -> np.ndarray:
    data, offsets = text_buffer(pa.array([" ".join(words)], pa.large_string()))
    return np.unique(Words(lowered(data), offsets).hashes())


def _member(h: np.ndarray, sorted_set: np.ndarray) -> np.ndarray:
    if not len(sorted_set):
        return np.zeros(len(h), bool)
    at = np.minimum(np.searchsorted(sorted_set, h), len(sorted_set) - 1)
    return sorted_set[at] == h


_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[97:123] = 97
_SHAPE[65:91] = 65
_SHAPE[48:58] = 48
_SHAPE[128:] = 97


class Batch:
    """Word hashes of a range of texts: whole words and word beginnings
    without punctuation at the end, and the shape of each word's last bytes."""

    def __init__(self, texts: pa.Array):
        data, offsets = text_buffer(texts)
        low = lowered(data)
        self.words = w = Words(data, offsets)
        end = w.end.copy()
        for _ in range(4):  # trailing punctuation is not part of a word
            last = data[np.maximum(end - 1, 0)]
            cut = (end - w.start > 1) & (last < 128) & ~_alnum(last)
            end = end - cut
        self.count = np.diff(w.first)
        total = Words.hashes
        self.word = total(w, low, w.start, end)
        self.prefix = total(w, low, w.start, np.minimum(end, w.start + PREFIX_BYTES))
        self.has_prefix = end - w.start > PREFIX_BYTES
        self.shape = total(w, _SHAPE[data], np.maximum(w.start, w.end - 4), w.end)
        self.data, self.offsets = data, offsets

    def per_text(self, flag: np.ndarray) -> np.ndarray:
        """Sum of a value per word over each text."""
        run = np.r_[0, np.cumsum(flag)]
        return run[self.words.first[1:]] - run[self.words.first[:-1]]

    def per_bytes(self, flag: np.ndarray) -> np.ndarray:
        run = np.r_[0, np.cumsum(flag)]
        return run[self.offsets[1:]] - run[self.offsets[:-1]]

    def features(self) -> np.ndarray:
        """(words, 3) feature numbers."""
        return np.stack([self.word, self.prefix + np.uint64(1), self.shape + np.uint64(2)], 1) % np.uint64(FEATURES)


def _alnum(b: np.ndarray) -> np.ndarray:
    return ((b >= 48) & (b <= 57)) | ((b >= 65) & (b <= 90)) | ((b >= 97) & (b <= 122))


def _vote(bad: np.ndarray, good: np.ndarray) -> np.ndarray:
    return np.where(bad, 0, np.where(good, 1, -1)).astype(np.int64)


#: Edges of the buckets that a text's statistics fall into, as features of the scorer.
STATISTICS = {
    "symbols": (0.02, 0.05, 0.1, 0.2, 0.4, 0.8, 1.5), "common": (0.01, 0.03, 0.06, 0.1, 0.15, 0.25),
    "capitals": (0.02, 0.05, 0.1, 0.2, 0.4, 0.7), "variety": (0.02, 0.05, 0.1, 0.2, 0.3, 0.4, 0.6, 0.8),
    "marks": (0.02, 0.05, 0.1, 0.3, 0.6, 0.9), "shouts": (0.02, 0.05, 0.1, 0.3, 0.6),
    "stutter": (0.01, 0.03, 0.06, 0.1, 0.2, 0.5), "bars": (0.02, 0.1, 0.2, 0.4, 0.8), "stops": (0.005, 0.01, 0.02, 0.05, 0.1, 0.3), "breaks": (0.01, 0.05, 0.1, 0.2, 0.4),
    "rude": (0.5, 1.5, 2.5), "marked": (0.5, 1.5, 2.5, 5.5), "marked_share": (0.0005, 0.001, 0.002, 0.004, 0.01),
}
#: Room for 16 buckets of each statistic after the hashed features.
WIDTH = FEATURES + 16 * len(STATISTICS)


def statistics(batch: Batch, function_words: np.ndarray, insults: np.ndarray, markers: np.ndarray) -> dict[str, np.ndarray]:
    """Shares and counts for each text, by the names of ``STATISTICS``."""
    d, n = batch.data, np.maximum(batch.count, 1)
    letters = np.maximum(batch.per_bytes(_alnum(d) | (d > 127)), 1)
    # distinct words: first places of each (text, word)
    order = np.lexsort((batch.word, batch.words.text))
    w, t = batch.word[order], batch.words.text[order]
    new = np.ones(len(w), bool)
    new[1:] = (w[1:] != w[:-1]) | (t[1:] != t[:-1])
    last = d[batch.words.end - 1]
    again = np.zeros(len(last), bool)
    again[1:] = (batch.word[1:] == batch.word[:-1]) & (batch.words.text[1:] == batch.words.text[:-1])
    marked = batch.per_text(_member(batch.word, markers) | batch.has_prefix & _member(batch.prefix, markers))
    return {
        "symbols": batch.per_bytes(np.isin(d, np.frombuffer(b"#*$%&<>|!{}[]=\\^~", np.uint8))) / n,
        "common": batch.per_text(_member(batch.word, function_words)) / n,
        "capitals": batch.per_bytes((d >= 65) & (d <= 90)) / letters,
        # long texts use fewer new words, so the share is of the root of the length beyond 100 words
        "variety": np.bincount(t[new], minlength=len(n)) / np.where(n > 100, 10 * np.sqrt(n), n),
        "marks": batch.per_text(np.isin(last, np.frombuffer(b"#*$%&<>|{}[]=\\^~", np.uint8))) / n,
        "shouts": batch.per_text((last == 33) & (d[np.maximum(batch.words.end - 2, 0)] == 33)) / n,
        "stutter": batch.per_text(again) / n,
        "bars": batch.per_bytes(d == 124) / n,
        "stops": batch.per_bytes((d == 46) | (d == 63)) / n,
        "breaks": batch.per_bytes(d == 10) / n,
        "rude": batch.per_text(_member(batch.word, insults)).astype(float),
        "marked": marked.astype(float), "marked_share": marked / n}


def votes(batch: Batch, x: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(texts, voters) votes on quality (1 good) and on insults (1 toxic); -1 abstains."""
    enough, none = batch.count >= 20, np.zeros(len(batch.count), bool)
    quality = np.stack([
        _vote(x["symbols"] > 0.3, x["symbols"] < 0.05),
        _vote(x["marks"] > 0.2, x["marks"] < 0.05),
        _vote(enough & (x["common"] < 0.03), x["common"] > 0.1),
        _vote(x["capitals"] > 0.4, x["capitals"] < 0.15),
        _vote(x["shouts"] > 0.2, x["shouts"] < 0.05),
        _vote(enough & (x["variety"] < 0.25), enough & (x["variety"] > 0.4)),
        _vote(enough & (x["stutter"] > 0.1), x["stutter"] < 0.05),
        _vote(x["bars"] > 0.2, x["bars"] < 0.02),
        _vote(enough & ((x["stops"] < 0.01) | (x["breaks"] > 0.3)), (x["stops"] > 0.03) & (x["stops"] < 0.3)),
    ], 1)
    toxic = np.stack([
        _vote(x["rude"] == 0, x["rude"] >= 2),
        _vote(x["marked"] == 0, x["marked"] >= 2),
        _vote(x["marked_share"] < 0.0005, x["marked_share"] > 0.003),
    ], 1)
    return quality, toxic


def _buckets(x: dict[str, np.ndarray]) -> np.ndarray:
    """(texts, statistics) feature numbers."""
    return np.stack([FEATURES + 16 * i + np.searchsorted(edges, x[name])
                     for i, (name, edges) in enumerate(STATISTICS.items())], 1)


def _pattern(v: np.ndarray) -> np.ndarray:
    return ((v + 1) * 3 ** np.arange(v.shape[1])).sum(1)


def _unpattern(code: np.ndarray, voters: int) -> np.ndarray:
    return code[:, None] // 3 ** np.arange(voters) % 3 - 1


@dataclass
class LabelModel:
    """Accuracies of the voters by class, and the classes' shares."""
    prior: np.ndarray
    chance: np.ndarray  # (class, voter, vote + 1)

    def posterior(self, votes_: np.ndarray) -> np.ndarray:
        """P(class 1) of each row of votes."""
        log = np.log(self.prior)[None, :] + sum(
            np.log(self.chance[:, j, :])[:, votes_[:, j] + 1].T for j in range(votes_.shape[1]))
        return 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -500, 500)))


def fit_label_model(votes_: np.ndarray, counts: np.ndarray, share: float, rare_vote: int,
                    steps: int = EM_STEPS) -> LabelModel:
    """Expectation-maximisation over vote patterns with their counts.

    Labellers overlap but look for different faults, so a vote for the rare
    class (``rare_vote``) is strong and one for the common class weak: the
    rare class's documents have most faults not. The start says so, and stays
    as a prior of a tenth of the documents, which also keeps the classes from
    trading places.
    """
    voters = votes_.shape[1]
    first = np.empty((2, voters, 3))  # abstain, vote 0, vote 1
    rare, common = [0.2, 0.3, 0.5], [0.2, 0.03, 0.77]
    if rare_vote == 1:
        rare, common = [0.2, 0.2, 0.6], [0.2, 0.77, 0.03]
    first[rare_vote], first[1 - rare_vote] = rare, common
    model = LabelModel(np.array([1 - share, share]), first.copy())
    counts = counts.astype(float)
    for _ in range(steps):
        p = model.posterior(votes_)
        for c, weight in ((0, counts * (1 - p)), (1, counts * p)):
            model.prior[c] = weight.sum() + 1
            for j in range(voters):
                seen = np.bincount(votes_[:, j] + 1, weights=weight, minlength=3) + (0.1 * weight.sum() + 1) * first[c, j]
                model.chance[c, j] = seen / seen.sum()
        model.prior /= model.prior.sum()
    return model


# ------------------------------------------------------------------ scorer

def _count_vectors(batch: Batch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature, count) of every text's features."""
    f = batch.features()
    t = np.repeat(batch.words.text, 3)
    key, count = np.unique(t.astype(np.int64) * FEATURES + f.ravel().astype(np.int64), return_counts=True)
    return key // FEATURES, key % FEATURES, count


@dataclass
class Scorer:
    """Logistic scores of the root-scaled counts of word features and of the
    buckets of a text's statistics."""
    weights: np.ndarray  # (WIDTH, tasks)
    bias: np.ndarray

    def score(self, batch: Batch, x: dict[str, np.ndarray]) -> np.ndarray:
        per_word = self.weights[batch.features().astype(np.int64)].sum(1)
        sums = np.stack([batch.per_text(per_word[:, k]) for k in range(per_word.shape[1])], 1)
        z = sums / np.sqrt(np.maximum(batch.count, 1))[:, None] + self.weights[_buckets(x)].sum(1) + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_scorer(x: np.ndarray, y: np.ndarray, steps: int = 150, rate: float = 0.05, decay: float = 1e-4) -> Scorer:
    """Logistic regression with Adam on soft labels; x is (rows, WIDTH)."""
    w, b = np.zeros((x.shape[1], y.shape[1]), np.float32), np.log((y.mean(0) + 1e-3) / (1 - y.mean(0) + 1e-3))
    m, v = np.zeros_like(w), np.zeros_like(w)
    # a rare class counts somewhat more than its share
    yes = np.clip((y > 0.5).mean(0), 0.02, 0.98)
    weight = np.sqrt(np.where(y > 0.5, 0.5 / yes, 0.5 / (1 - yes)))
    for n in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30)))
        d = (weight * (p - y) / len(x)).astype(np.float32)
        g = x.T @ d + decay * w
        b = b - rate * d.sum(0)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9 ** n)) / (np.sqrt(v / (1 - 0.999 ** n)) + 1e-7)
    return Scorer(w, b)


# ----------------------------------------------------------------- operator

def _each(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, Batch]]:
    for batch in batches:
        texts = batch.column(column)
        for lo, hi in slices(texts):
            yield batch.slice(lo, hi - lo), Batch(texts.slice(lo, hi - lo))


def markers(docs: DataFrame, labels: DataFrame, limit: int = LABELLED_DOCS, entries: int = MARKERS) -> np.ndarray:
    """Hashes of words and word beginnings that mark toxic documents, from a
    bounded, seeded sample of labelled rows."""
    rows = only(labels, "doc_id", "toxic").where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(
        F.max("toxic").alias("toxic"))
    sample = rows.orderBy(F.xxhash64(F.lit(SEED), "doc_id"), "doc_id").limit(limit).withColumnRenamed("doc_id", "_id")
    picked = only(docs, "doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("_id"))  # LABELLED_DOCS rows

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, batch in _each(batches):
            toxic = part.column("toxic").to_numpy(zero_copy_only=False)
            t = batch.words.text
            h = np.r_[batch.word, batch.prefix[batch.has_prefix]]
            own = np.r_[t, t[batch.has_prefix]]
            pairs = np.unique(np.stack([own.astype(np.uint64), h], 1), axis=0)
            flag = toxic[pairs[:, 0].astype(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(pairs[:, 1]).view(np.int64)),
                                              pa.array((flag > 0).astype(np.int64))], ["h", "toxic"])

    counts = picked.select("text", "toxic").mapInArrow(seen, "h long, toxic long").groupBy("h").agg(
        F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"))
    size = picked.agg(F.sum(F.when(F.col("toxic") > 0, 1).otherwise(0)), F.count("*")).first()
    bad, good = float(size[0] or 0), float((size[1] or 0) - (size[0] or 0))
    if not bad or not good:
        return np.zeros(0, np.uint64)
    odds = (F.col("bad") + 0.5) / bad / ((F.col("good") + 0.5) / good)
    found = counts.where((F.col("bad") >= MARKER_DOCS) & (odds > 20)).orderBy(odds.desc(), "h").limit(entries).select("h").collect()
    return np.unique(np.array([r.h for r in found], np.int64).view(np.uint64)) if found else np.zeros(0, np.uint64)


@dataclass
class Classifier:
    quality: LabelModel
    toxic: LabelModel
    scorer: Scorer
    words: tuple[np.ndarray, np.ndarray, np.ndarray]  # function words, insults, markers


def fit(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS) -> Classifier:
    """The label models over all documents, and the scorer."""
    spark = docs.sparkSession
    words = spark.sparkContext.broadcast((_hash_set(FUNCTION_WORDS), _hash_set(INSULTS), markers(docs, labels)))

    def patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, batch in _each(batches):
            q, t = votes(batch, statistics(batch, *words.value))
            yield pa.RecordBatch.from_arrays([pa.array(_pattern(q)), pa.array(_pattern(t))], ["q", "t"])

    texts = only(docs, "doc_id", "text")
    # at most 3^9 * 3^3 rows, whatever the number of documents
    seen = texts.select("text").mapInArrow(patterns, "q long, t long").groupBy("q", "t").agg(F.count("*").alias("n")).collect()
    q, t, n = (np.array([r[i] for r in seen], np.int64) for i in range(3))
    if not len(n):
        q, t, n = np.zeros(1, np.int64), np.zeros(1, np.int64), np.ones(1, np.int64)
    quality = fit_label_model(_unpattern(q, len(QUALITY_VOTERS)), n, share=0.8, rare_vote=0)
    toxic = fit_label_model(_unpattern(t, len(TOXIC_VOTERS)), n, share=0.1, rare_vote=1)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, batch in _each(batches):
            x = statistics(batch, *words.value)
            qv, tv = votes(batch, x)
            row, feature, count = _count_vectors(batch)
            cut = np.searchsorted(row, np.arange(len(batch.count) + 1))
            make = lambda x: pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(x.astype(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [part.column("h"), pa.array(_pattern(qv)), pa.array(_pattern(tv)), pa.array(batch.count.astype(np.int64)),
                 make(feature), make(count), pa.array(_buckets(x).tolist(), pa.list_(pa.int32()))],
                ["h", "q", "t", "n", "f", "c", "b"])

    share = min(1.0, 1.2 * train_docs / max(1, int(n.sum())))
    order = F.xxhash64(F.lit(SEED), "doc_id", "text")
    pick = F.pmod(order, F.lit(1_000_000)) < int(share * 1_000_000) + 1
    # the least hashes, so that the sample does not hang on the layout of files; rows that tie are equal
    rows = texts.where(pick).select("text", order.alias("h")).mapInArrow(
        vectors, "h long, q long, t long, n long, f array<int>, c array<int>, b array<int>").orderBy("h").limit(train_docs).collect()
    x = np.zeros((max(1, len(rows)), WIDTH), np.float32)
    for i, r in enumerate(rows):
        x[i, r.f] = np.array(r.c, np.float32) / np.sqrt(max(1, r.n))
        x[i, r.b] = 1
    y = np.zeros((len(x), 2))
    if rows:
        y[:, 0] = quality.posterior(_unpattern(np.array([r.q for r in rows]), len(QUALITY_VOTERS)))
        y[:, 1] = toxic.posterior(_unpattern(np.array([r.t for r in rows]), len(TOXIC_VOTERS)))
    return Classifier(quality, toxic, fit_scorer(x, y), words.value)


def classify(docs: DataFrame, labels: DataFrame, model: Classifier | None = None) -> DataFrame:
    """(doc_id, quality_score, toxic_score, kept) for every row of ``docs``;
    kept if the quality score is at least a half and the toxic score below.

    Edge cases: a null or empty text has no features and gets the scorer's
    prior. A document labelled both ways counts as toxic in the marker sample.
    Without usable labels there are no markers and the lexicon votes alone.
    Null doc_ids and repeated rows keep their rows and equal rows get equal
    scores; an empty table gives no rows; extra columns are ignored.
    """
    model = model or fit(docs, labels)
    # WIDTH weights for each of two tasks, and word lists of a fixed size
    shared = docs.sparkSession.sparkContext.broadcast((model.scorer.weights, model.scorer.bias, model.words))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias, words = shared.value
        scorer = Scorer(weights, bias)
        for part, batch in _each(batches):
            p = scorer.score(batch, statistics(batch, *words)).round(6)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(p[:, 0]), pa.array(p[:, 1]), pa.array((p[:, 0] >= 0.5) & (p[:, 1] < 0.5))],
                ["doc_id", "quality_score", "toxic_score", "kept"])

    rows = only(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(score, "doc_id long, quality_score double, toxic_score double, kept boolean")


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
