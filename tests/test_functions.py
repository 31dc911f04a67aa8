"""Golden edge cases for every cleaner (FIXTURES.md section 5)."""

from datetime import date, datetime
from decimal import Decimal

from conftest import column_values

from lakewash import functions as X


def test_trim_single_line_initcap(spark):
    assert column_values(spark, ["  a b ", "\tx\t", None], X.trim_text) == ["a b", "\tx\t", None]
    assert column_values(spark, [" 12 Main St\nSuite 4 ", "a\n\nb"], X.single_line_text) == [
        "12 Main St Suite 4", "a  b"]
    assert column_values(spark, [" dark  BLUE ", "1-urgent"], X.initcap_text) == ["Dark  Blue", "1-urgent"]


def test_regex_chain_order(spark):
    out = column_values(spark, ["aXbXc"], lambda c: X.regex_chain(c, [("X", "-"), ("-b", "B")]))
    assert out == ["aB-c"]


def test_clean_phone(spark):
    ins = ["+1 (555) 123-4567", "001-555-123-4567x89", "555.123.4567", "1-555-123-4567", "555 0100", None]
    assert column_values(spark, ins, X.clean_phone) == [
        "5551234567", "5551234567", "5551234567", None, None, None]


def test_clean_boolean(spark):
    ins = ["TRUE", "truee", "False", "fal_se", "trueee", " true", "yes", "1", "", None]
    assert column_values(spark, ins, X.clean_boolean) == [
        True, True, False, False, None, None, None, None, None, None]


def test_clean_identity_number(spark):
    ins = [" 123-45-6789\t", "12<br />34", "123 <br/>", "   ", "", None]
    assert column_values(spark, ins, X.clean_identity_number) == [
        "123456789", "1234", "123 ", "", None, None]


def test_file_stem(spark):
    assert column_values(spark, ["s3a://b/d/a.b.csv", "/x/noext", None, ".bashrc", "a."], X.file_stem) == [
        "a.b", "", None, "", "a"]


def test_clean_timestamp(spark):
    cases = {
        "not a date": None,
        "Friday, March 1st, 2024": datetime(2024, 3, 1),
        "March 22nd, 2024": datetime(2024, 3, 22),
        "2024-03-15TEST": datetime(2024, 3, 15),
        "1850-01-01 05:00:00": datetime(1900, 1, 1),
        "2029-01-31 12:00:00": datetime(2029, 1, 31, 12),
        "2029-02-01 00:00:00": datetime(2029, 1, 31),
        "March 1st, 2050": datetime(2050, 3, 1),
        "Jan 5th, 2024": None,
        "February 30th, 2024": None,
        "10:15": None, "2024": None, "zzz": None, "": None,
        "2024-05-06 07:08:09": datetime(2024, 5, 6, 7, 8, 9),
        "2024-05-06": datetime(2024, 5, 6),
    }
    out = column_values(spark, list(cases), X.clean_timestamp)
    assert dict(zip(cases, out)) == cases


def test_repair_time_string(spark):
    cases = {
        "1700000000": datetime(2023, 11, 14, 22, 13, 20),
        "2024-02-03 101500": datetime(2024, 2, 3, 10, 15),
        "2024-02-03T1015": datetime(2024, 2, 3, 10, 15),
        "2024-02-03T101530": datetime(2024, 2, 3, 10, 15),
        "2024-02-03T10:15:30": datetime(2024, 2, 3, 10, 15, 30),
        "2024-02-03T10:05:75": datetime(2024, 2, 3, 10, 6, 15),
        "2024-02-03T10:75:20": datetime(2024, 2, 3, 11, 15, 20),
        "2024-02-03T23:59:60": datetime(2024, 2, 4),
        "2024-02-03T10:15:30.123Z": datetime(2024, 2, 3, 10, 15, 30),
        "2024-02-03 25:15:00": None,
        "garbage": None,
        None: None,
    }
    out = column_values(spark, list(cases), X.repair_time_string)
    assert dict(zip(cases, out)) == cases


def test_epoch_and_pattern(spark):
    assert column_values(spark, ["1700000000", "1700000000.5", "abc", None, "99999999999999"],
                         X.epoch_text_to_timestamp) == [datetime(2023, 11, 14, 22, 13, 20), None, None, None, None]
    assert column_values(spark, [1700000000, None], X.epoch_to_timestamp, "bigint") == [
        datetime(2023, 11, 14, 22, 13, 20), None]
    assert column_values(spark, ["2024-02-03 1015:30", "2024-02-03 10:15:30"],
                         lambda c: X.parse_with_pattern(c, "yyyy-MM-dd HHmm:ss")) == [
        datetime(2024, 2, 3, 10, 15, 30), None]


def test_dates_and_clamp(spark):
    assert column_values(spark, ["2024-01-05", "2024-01-05 10:00:00", "2024", "2024-02-30", "x"],
                         X.text_to_date) == [date(2024, 1, 5), date(2024, 1, 5), None, None, None]
    ts = [datetime(1850, 1, 1), datetime(2029, 1, 31, 12), datetime(2030, 1, 1), datetime(2000, 1, 1)]
    assert column_values(spark, ts, X.clamp_dates, "timestamp") == [
        datetime(1900, 1, 1), datetime(2029, 1, 31, 12), datetime(2029, 1, 31), datetime(2000, 1, 1)]


def test_decimal_amount(spark):
    assert column_values(spark, ["2.345", "-2.345", "99999999.995", "1,000.5", "1e3"], X.decimal_amount) == [
        Decimal("2.35"), Decimal("-2.35"), None, None, Decimal("1000.00")]


def test_hash_mask_strip(spark):
    assert column_values(spark, ["abc", None], X.hash_identifier) == [
        "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad", None]
    assert column_values(spark, ["x", None], X.mask_secret) == ["********", "********"]
    assert column_values(spark, ["March 22nd, 2024", "1st 2nd"], X.strip_ordinals) == ["March 22, 2024", "1 2"]


def test_no_python_in_plans(spark):
    df = spark.createDataFrame([("a",)], "v string")
    cols = [X.clean_timestamp("v"), X.repair_time_string("v"), X.clean_phone("v"), X.clean_boolean("v"),
            X.clean_identity_number("v"), X.file_stem("v"), X.decimal_amount("v")]
    plan = df.select(*[c.alias(f"c{i}") for i, c in enumerate(cols)])._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_clean_phone_two_pass_equals_four_step_chain(spark):
    """The two-pass phone cleaner equals the four rewrites applied in order."""
    from hypothesis import given, settings, strategies as st
    from lakewash.functions.text import PHONE_DIGITS, PHONE_REWRITES

    alphabet = st.sampled_from(list("0123456789x+- ().\t\n1"))
    texts = st.lists(st.text(alphabet=alphabet, min_size=0, max_size=18), min_size=50, max_size=50)

    @settings(max_examples=20, deadline=None)
    @given(texts)
    def check(values):
        df = spark.createDataFrame([(v,) for v in values] + [(" + 1 555 123 4567",), ("0 01x 9 5551234567",)],
                                   "v string")
        from pyspark.sql import functions as F
        chain = X.regex_chain("v", PHONE_REWRITES)
        reference = F.when(F.length(chain) == PHONE_DIGITS, chain)
        rows = df.select(X.clean_phone("v").alias("a"), reference.alias("b")).collect()
        assert all(r.a == r.b for r in rows), [r for r in rows if r.a != r.b][:3]

    check()


def test_zone_offsets_become_utc(spark):
    """Offsets are honoured and the instant is shown in UTC (kept out of the
    DuckDB fixtures, whose TIMESTAMP ignores them)."""
    out = column_values(spark, ["2024-01-05 10:00:00+08:00", "2024-01-05T10:00:00Z"], X.clean_timestamp)
    assert out == [datetime(2024, 1, 5, 2), datetime(2024, 1, 5, 10)]


def test_cleaners_accept_inferred_types(spark):
    """Schema inference may hand a cleaner a number, a boolean or a timestamp;
    it is cleaned like its written form."""
    df = spark.createDataFrame([(datetime(1850, 1, 1, 5), 1700000000, 5551234567, True)],
                               "ts timestamp, ep bigint, ph bigint, b boolean")
    row = df.select(X.clean_timestamp("ts").alias("a"), X.epoch_text_to_timestamp("ep").alias("b"),
                    X.clean_phone("ph").alias("c"), X.clean_boolean("b").alias("d"),
                    X.clean_identity_number("ep").alias("e"), X.text_to_date("ts").alias("f")).first()
    assert tuple(row) == (datetime(1900, 1, 1), datetime(2023, 11, 14, 22, 13, 20), "5551234567", True,
                          "1700000000", date(1850, 1, 1))


def test_padded_signed_and_zoned_values_are_read(spark):
    """What a plain cast reads stays readable."""
    ten = datetime(2024, 1, 5, 10)
    assert column_values(spark, [" 2024-01-05 10:00:00", "2024-01-05 8:05:00", "2024-01-05 8:05", "2024-01-05 10:00:00 UTC",
                                 "2024-01-05 18:00:00+08", "2024-01-05 18:00:00 +08:00"], X.clean_timestamp) == [
        ten, datetime(2024, 1, 5, 8, 5), datetime(2024, 1, 5, 8, 5), ten, ten, ten]
    assert column_values(spark, [" 2024-01-05", "2024-1-5  "], X.text_to_date) == [date(2024, 1, 5)] * 2
    assert column_values(spark, ["0001700000000", " 1700000000", "1700000000 ", "+1700000000", "9" * 30],
                         X.epoch_text_to_timestamp) == [datetime(2023, 11, 14, 22, 13, 20)] * 4 + [None]
    assert column_values(spark, ["2024-01-05 1015:20", "2024-01-05T99:10:10", "2024-01-05T23:75:00"], X.repair_time_string) == [
        datetime(2024, 1, 5, 10, 15, 20), None, datetime(2024, 1, 6, 0, 15)]
