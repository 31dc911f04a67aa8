"""Every operator and stage on nulls, empty and very long texts, ties,
repeated rows, empty tables and extra columns with clashing names."""

import pytest
from pyspark.sql import functions as F

from lakewash.llm import (decontamination, html_extract, mixing, passages, pii, quality_classifier, quality_rules,
                          secret_scan, simhash, url_filter)

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ["id", "digest", "added", "size", "taken", "target", "fp", "kept_id", "sig", "rid", "start", "stratum",
         "n_words", "h", "rank", "bucket", "row", "v", "u", "_id", "prefix", "host"]
LONG = " ".join(f"w{i % 5000} and" for i in range(60_000))
PLAIN = " ".join(f"plain{i} word of text" for i in range(12)) + "."


def documents(spark, rows=None):
    rows = rows if rows is not None else [
        (1, PLAIN, "en", "a"), (2, PLAIN, "en", "b"), (3, None, "en", "a"), (4, "", None, None), (5, " \n\t ", "en", "a"),
        (6, LONG, "de", "c"), (7, "the same row twice " * 9, "en", "b"), (7, "the same row twice " * 9, "en", "b"),
        (None, "no id here " + PLAIN[::-1], "en", "b"), (None, "no id here " + PLAIN[::-1], "en", "b"),
        (None, None, None, None), (8, 'x password = "abcdefgh12" y', "en", "z"), (9, "été 日本 😀 a@b.example.org 1.2.3.4", "fr", "z")]
    df = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], DOCS)
    return df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASH)])


def labels(spark, rows=((1, 1, 0), (1, 0, 1), (6, 1, 0), (None, 1, 0), (9, None, None))):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int").withColumn("n", F.lit(1))


def benchmark(spark, rows=((1, PLAIN), (2, None), (3, ""), (None, "a b"))):
    return spark.createDataFrame(list(rows), "item_id long, text string").withColumn("w", F.lit(1))


def pages(spark, rows=None):
    rows = rows if rows is not None else [
        (1, "http://A.Example.net/en/1", "<p>hi"), (2, None, None), (3, "no scheme", ""), (None, "x://", "<article><p>a &lt; b"),
        (5, "http://h.org" + "/a" * 40 + "?q", "<p>" + "long text " * 50_000), (6, "http://h.org?x", "<!-- only -->"),
        (6, "http://h.org?x", "<!-- only -->"), (7, "a://b://c/d", "<div>" * 3000 + "deep")]
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("template", F.lit(1)).withColumn(
        "text", F.lit("clash"))


OPERATORS = {
    "simhash": lambda s, e: simhash.simhash_components(documents(s, e)),
    "passages": lambda s, e: passages.repeated_passages(documents(s, e)),
    "urls": lambda s, e: url_filter.judge(pages(s, e)),
    "mixing": lambda s, e: mixing.mix(documents(s, e)),
    "quality": lambda s, e: quality_rules.quality_rules(documents(s, e), labels(s)),
    "secrets": lambda s, e: secret_scan.secret_spans(documents(s, e)),
    "classifier": lambda s, e: quality_classifier.classify(documents(s, e), labels(s)),
    "html": lambda s, e: html_extract.extract(pages(s, e)),
    "leaks": lambda s, e: decontamination.leaks(documents(s, e), benchmark(s)),
    "pii": lambda s, e: pii.find_pii(documents(s, e)),
}
STAGES = {
    "quality": lambda s, e: quality_rules.keep_good(documents(s, e), labels(s)),
    "simhash": lambda s, e: simhash.drop_near_duplicates(documents(s, e)),
    "leaks": lambda s, e: decontamination.drop_contaminated(documents(s, e), benchmark(s)),
    "secrets": lambda s, e: secret_scan.redact_secrets(documents(s, e)),
    "mixing": lambda s, e: mixing.mixed_documents(documents(s, e)),
}
ROW_FOR_ROW = {"simhash", "urls", "mixing", "quality", "secrets", "classifier", "html", "pii"}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_operator(spark, name):
    rows = OPERATORS[name](spark, None).collect()
    if name in ROW_FOR_ROW:
        assert len(rows) == (pages(spark) if name in ("urls", "html") else documents(spark)).count()
    assert OPERATORS[name](spark, []).collect() == []


@pytest.mark.parametrize("name", sorted(STAGES))
def test_stage(spark, name):
    docs = documents(spark)
    out = STAGES[name](spark, None)
    expected = [c for c in docs.columns if c not in mixing.ADDED] if name == "mixing" else docs.columns
    assert out.columns[:len(expected)] == expected
    rows = out.collect()
    assert STAGES[name](spark, []).collect() == []
    texts = [r.text for r in rows]
    if name == "quality":
        assert None not in texts and "" not in texts and texts.count(PLAIN) == 2
    elif name == "simhash":  # one of each group, also of rows without an id
        assert sorted(r.doc_id or 0 for r in rows) == [0, 1, 3, 6, 7, 8, 9]
        assert sum(r.doc_id is None for r in rows) == 1
    elif name == "leaks":
        assert len(rows) == docs.count() - 2 and PLAIN not in texts
    elif name == "secrets":
        assert len(rows) == docs.count() and 'x [SECRET]" y' in texts
        assert {r.n_chars for r in rows if r.doc_id == 8} == {len('x [SECRET]" y')}
    else:
        assert all(r.taken % r.size == 0 and 0 < r.taken <= 3 * r.size for r in rows)
        total = {}
        for r in mixing.mix(docs).collect():
            total[r.source] = total.get(r.source, 0) + r.taken
        kept = {}
        for r in rows:
            kept[r.source] = kept.get(r.source, 0) + r.taken
        assert kept == {k: v for k, v in total.items() if v}
