"""Long texts, exact budgets and samples that do not hang on file layout."""

import itertools
import random
import re
import time

import numpy as np
import pytest

from lakewash.llm import mixing, quality_classifier, secret_scan


@pytest.mark.parametrize("lengths, counts, budget, best", [
    ([70_000, 100_000], [5, 5], 200_000, 200_000),
    ([50_000, 66_000, 131_000], [5, 5, 5], 198_000, 198_000),
    ([10_000_001, 10_000_013, 3_000_000], [4, 4, 4], 40_000_027, 40_000_016)])
def test_budget_of_long_documents(lengths, counts, budget, best):
    take = mixing.fit_budget(np.array(lengths), np.array(counts), budget)
    assert (take <= counts).all() and int((np.array(lengths) * take).sum()) == best


def test_budget_against_every_choice():
    rng = np.random.default_rng(1)
    for _ in range(100):
        lengths = np.unique(rng.integers(1, 200_000, rng.integers(1, 5)))
        counts = rng.integers(1, 4, len(lengths))
        budget = int(rng.integers(0, (lengths * counts).sum() + 1))
        sums = (int((lengths * np.array(k)).sum()) for k in itertools.product(*[range(c + 1) for c in counts]))
        take = mixing.fit_budget(lengths, counts, budget)
        assert (take <= counts).all() and int((lengths * take).sum()) == max(s for s in sums if s <= budget)


def test_secrets_of_a_long_text(spark):
    draw = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    text = "é " + " ".join("".join(draw.choices(letters, k=24)) for _ in range(40_000))  # 1 MB of tokens
    docs = spark.createDataFrame([(1, text), (2, "a password=hunter22 b")], "doc_id long, text string")
    begin = time.perf_counter()
    added = {r.doc_id: sorted((s["start"], s["end"]) for s in r.added) for r in secret_scan.secret_spans(docs).collect()}
    clean = {r.doc_id: r.text for r in secret_scan.redact_secrets(docs).collect()}
    assert time.perf_counter() - begin < 120  # quadratic work took many minutes
    assert set(added[1]) <= {m.span() for m in re.finditer(secret_scan.TOKEN, text)} and len(added[1]) > 36_000
    want, at = [], 0
    for s, e in added[1]:
        want += [text[at:s], secret_scan.REPLACEMENT]
        at = e
    assert clean[1] == "".join(want) + text[at:] and clean[2] == "a [SECRET] b"


def test_classifier_sample_does_not_hang_on_layout(spark):
    rows = [(i, f"word{i % 7} the plain text number {i} of a story about rivers") for i in range(400)]
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int, lang string")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    one, two = (quality_classifier.fit(d, labels, train_docs=50).scorer.weights
                for d in (docs.repartition(3, "text"), docs.orderBy("doc_id", ascending=False).coalesce(1)))
    assert np.allclose(one, two, atol=1e-4)
