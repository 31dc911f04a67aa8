"""Token counts, Merkle proofs and whitening against plain versions of
themselves, and on odd input."""

import hashlib
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from test_edge_cases import documents

from lakewash.llm import merkle, registry, token_counts, whitening
from lakewash.llm.common import table
from lakewash.session import scratch_path
from lakewash.sources.readers import path_exists

public_tokenizers = pytest.importorskip("public_tokenizers")
SF = "/root/testdata/sf0.001"


# ------------------------------------------------------------------ op11

@pytest.fixture(scope="module")
def vocabulary():
    return token_counts.tokenizer_at(public_tokenizers.path("piece_bpe_32k.model"))


def plain_count(text):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    return len(sp.encode(text or ""))


def test_token_counts_match_the_library(spark):
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())
    got = registry.QUERIES["op11_token_counts"](spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        n = plain_count(texts[r.doc_id])
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((texts[r.doc_id] or "").encode()), n, n > 4096)


LONG_TEXTS = ["  two  spaces \n line\tand <s> marks </s> ▁ ▁▁x " * 4000, "é日本😀 " * 30_000, "nospace" * 30_000, " " * 200_000,
              ("x" * 70_000 + "  ") * 3, "<0x41> \x00 b" * 12_000]


@pytest.mark.parametrize("text", LONG_TEXTS, ids=range(len(LONG_TEXTS)))
def test_long_texts_count_the_same_in_pieces(vocabulary, text):
    assert vocabulary.counter()(text) == plain_count(text)


def test_only_distinct_misses_are_encoded_and_appended(spark, vocabulary):
    cache = scratch_path(spark, "test-token-cache")
    docs = table(spark, SF, "documents")

    def run(part):
        token_counts.token_counts(part, vocabulary, cache).collect()
        return spark.read.parquet(cache).count()

    half = docs.where("doc_id % 2 = 0")
    assert run(half) == half.select("text").distinct().count()
    assert run(docs.union(docs)) == docs.select("text").distinct().count()
    assert run(docs) == docs.select("text").distinct().count()
    # stored counts are what is returned, and another tokenizer has its own
    other = token_counts.tokenizer_at(public_tokenizers.path("word_bpe_49k.json"))
    lower = token_counts.token_counts(docs, other, cache, normalise=lambda c: F.lower(token_counts.as_written(c)))
    import tokenizers
    plain = tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for r in lower.join(docs.select("doc_id", "text"), "doc_id").collect():
        assert r.n_tokens == len(plain.encode(r.text or "", add_special_tokens=False))
    folders = path_exists(spark, f"{cache}/tokenizer={vocabulary.digest}"), path_exists(spark, f"{cache}/tokenizer={other.digest}")
    assert folders == (True, True) and vocabulary.digest != other.digest


def test_token_counts_of_odd_rows(spark, vocabulary):
    cache = scratch_path(spark, "test-token-cache")
    docs = documents(spark)
    want = sorted(((r.doc_id, len((r.text or "").encode()), plain_count(r.text)) for r in docs.collect()), key=str)
    for _ in range(2):  # from an empty and from a full cache
        got = token_counts.token_counts(docs, vocabulary, cache).collect()
        assert sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in got), key=str) == want
    assert token_counts.token_counts(documents(spark, []), vocabulary, cache).count() == 0
    with pytest.raises(ValueError):
        token_counts.tokenizer_at("words.txt")


# ------------------------------------------------------------------ op12

def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def levels_of(leaves):
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i:i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def way(levels, at):
    out = []
    for row in levels[:-1]:
        out.append((bool(at & 1), row[at ^ 1] if at ^ 1 < len(row) else None))
        at >>= 1
    return out


def climb(leaf, steps):
    for left, s in steps:
        leaf = h(leaf) if s is None else h(s, leaf) if left else h(leaf, s)
    return leaf


def brute_proofs(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    none_first = lambda v: (v is not None, v)
    trees = {}
    for r in rows:
        trees.setdefault(r[2], []).append((r[0], h(*map(field, r)), r))
    langs = sorted(trees, key=lambda g: (g is not None, (g or "").encode()))
    for g in langs:
        trees[g].sort(key=lambda x: (none_first(x[0]), x[1]))
    grown = {g: levels_of([x[1] for x in trees[g]]) for g in langs}
    top = levels_of([grown[g][-1][0] for g in langs])
    out = []
    for rank, g in enumerate(langs):
        for at, (doc_id, leaf, r) in enumerate(trees[g]):
            steps = way(grown[g], at) + way(top, rank)
            seen = leaf
            if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0:
                seen = h(*map(field, (*r[:3], None if r[3] is None else r[3] + 1, r[4])))
            end = climb(seen, steps)
            out.append((doc_id, leaf, grown[g][-1][0], top[-1][0], h(*[s for _, s in steps if s]), end, end == top[-1][0]))
    return sorted(out, key=str)


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_merkle_matches_brute_force_and_sql(spark):
    rows = duckdb.sql(f"SELECT doc_id, source, lang, n_chars, text FROM '{SF}/documents.parquet'").fetchall()
    got = sorted((tuple(r) for r in registry.QUERIES["op12_merkle_manifest"](spark, SF).select(*COLUMNS).collect()), key=str)
    assert got == brute_proofs(rows)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    sql = con.sql(f"SELECT {', '.join(COLUMNS)} FROM ({merkle.ORACLE})").fetchall()
    assert sorted(sql, key=str) == got
    assert 0 < sum(r[-1] for r in got) < len(got)


def test_merkle_of_odd_rows(spark):
    docs = documents(spark)
    made = merkle.document_proofs(docs).withColumn("proof_sha256", merkle.proof_digest(F.col("proof"))).select(*COLUMNS)
    rows = [tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    assert sorted((tuple(r) for r in made.collect()), key=str) == brute_proofs(rows)
    assert merkle.document_proofs(documents(spark, [])).count() == 0
    one = merkle.document_proofs(documents(spark, [(3, "only", None, None)])).first()
    assert one.proof == [] and one.leaf == one.subroot == one.root and one.verified


@pytest.fixture
def small_blocks(monkeypatch):
    """Blocks of four leaves, so that trees grow in rounds and blocks fetch."""
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", 2)


def test_trees_over_many_rounds_and_a_subset(spark, small_blocks):
    docs = spark.createDataFrame([(i, "s", "en" if i % 3 else f"l{i % 5}", i, f"text {i}") for i in range(203)],
                                 "doc_id long, source string, lang string, n_chars long, text string")
    rows = [tuple(r) for r in docs.collect()]
    want = {r[0]: r for r in brute_proofs(rows)}
    made = merkle.manifest(docs, merkle.FIELDS, "lang", "doc_id", {"doc_id": F.col("doc_id")})
    picked = made.leaves.where("doc_id % 7 in (1, 2)")
    got = merkle.prove(made, picked).withColumn("end", merkle.folded(F.col("leaf"), F.col("proof"))).withColumn(
        "digest", merkle.proof_digest(F.col("proof"))).collect()
    assert sorted(r.doc_id for r in got) == [i for i in range(203) if i % 7 in (1, 2)]
    for r in got:
        assert (r.leaf, r.subroot, r.root, r.digest) == want[r.doc_id][1:5]
        assert r.end == made.root


def test_a_block_lacks_the_least_union():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 7, 64, 101):
        for _ in range(20):
            held = sorted(rng.choice(n, rng.integers(1, n + 1), replace=False).tolist())
            sizes = [n]
            while sizes[-1] > 1:
                sizes.append((sizes[-1] + 1) // 2)
            above = [{i >> k for i in held} for k in range(len(sizes))]  # held or derived, by level
            siblings = {(k, i ^ 1) for k, row in enumerate(above[:-1]) for i in row if i ^ 1 < sizes[k]}
            assert set(merkle.lacking(held, n)) == {(k, i) for k, i in siblings if i not in above[k]}


# ------------------------------------------------------------------ op13

def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<float>, x int")


def check_whitening(spark, rows, components=16):
    got = whitening.whiten(vectors(spark, rows), components=components).toPandas()
    x = {i: np.floor(64 * np.array(v, np.float32).astype(float)).astype(int) + 1_000_000 for i, v in rows
         if v is not None and all(c is not None and np.isfinite(c) for c in v)}
    fit = np.unique(np.array(list(x.values())), axis=0)
    n, mean, sums = len(fit), fit.mean(0), [int(s) for s in fit.sum(0)]
    v = (fit - mean).T @ (fit - mean) / n
    e, q = np.linalg.eigh(v)
    e, q = e[::-1], q[:, ::-1]
    k = min(components, int((e > len(e) * 2.3e-16 * e[0]).sum()))
    assert len(got) == k * len(x) and set(got.n) == {n}
    assert got.identity_error.max() <= 1e-9
    for i in x:
        mine = got[got.vec_id == i].sort_values("component")
        assert set(mine.deviation) == {sum((n * int(a) - s) ** 2 for a, s in zip(x[i], sums))}
        np.testing.assert_allclose(mine.explained, e[:k] / e.sum(), rtol=1e-9)
    wide = got.pivot(index="vec_id", columns="component", values="whitened")
    want = np.array([(x[i] - mean) @ q[:, :k] / np.sqrt(e[:k]) for i in wide.index])
    sign = np.sign((want * wide.values).sum(0))
    np.testing.assert_allclose(wide.values, want * sign, atol=1e-7)


def test_whitening_matches_the_eigenvectors(spark):
    rows = [tuple(r) for r in table(spark, SF, "embeddings").select("vec_id", "embedding").collect()]
    check_whitening(spark, rows)


def test_whitening_of_odd_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(5).tolist()) for i in range(40)]
    rows += [(40, rows[0][1]), (41, None), (42, [1.0, None, 2.0, 3.0, 4.0]), (43, [float("nan")] * 5),
             (44, [float("inf"), 0.0, 0.0, 0.0, 0.0])]
    check_whitening(spark, rows)
    check_whitening(spark, rows, components=2)
    # one dimension never varies, another repeats: two components fewer
    flat = [(i, [a, b, 0.5, a]) for i, (a, b) in enumerate(rng.standard_normal((30, 2)).tolist())]
    check_whitening(spark, flat)
    # rows of another length, an empty vector and a null id
    mixed = whitening.whiten(vectors(spark, [*rows[:10], (None, rows[1][1]), (50, []), (51, [1.0])])).toPandas()
    assert mixed.vec_id.isna().sum() == 5 and len(mixed) == 55
    assert whitening.whiten(vectors(spark, [])).count() == 0
    assert whitening.whiten(vectors(spark, [(1, None), (2, [])])).count() == 0
    assert whitening.whiten(vectors(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    huge = whitening.whiten(vectors(spark, [(1, [1e30, 0.0]), (2, [0.0, 1.0])])).collect()
    assert len(huge) == 2 and all(r.deviation is None for r in huge)


def test_divide_and_conquer_on_hard_spectra():
    rng = np.random.default_rng(5)
    for d in (1, 2, 7, 60):
        q = np.linalg.qr(rng.standard_normal((d, d)))[0]
        for e in (np.ones(d), np.r_[np.zeros(d // 2), np.ones(d - d // 2)], 10.0 ** -np.arange(d),
                  np.repeat(np.arange(1, d + 1), 3)[:d], 1 + 1e-9 * np.arange(d)):
            v = (q * e) @ q.T
            v = (v + v.T) / 2
            values, w = whitening.spectral_components(v)
            scale = max(e.max(), 1e-300)
            np.testing.assert_allclose(values, np.sort(e)[::-1], atol=1e-13 * scale)
            np.testing.assert_allclose(w.T @ w, np.eye(d), atol=1e-13)
            np.testing.assert_allclose(v @ w, w * values, atol=1e-13 * scale)
