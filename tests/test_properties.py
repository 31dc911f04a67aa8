"""Properties of the cleaners (hypothesis), checked in batches so each
example set is one Spark job."""

from datetime import datetime

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from lakewash import functions as X
from lakewash.operators import mapping, quality

TEXT = st.text(alphabet=st.sampled_from(list("ab AZ019-+x().\t\n<br/>,stndrh:T")), max_size=24)
BATCH = st.lists(TEXT, min_size=30, max_size=30)
SETTINGS = settings(max_examples=10, deadline=None)


def _frame(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")


def test_idempotent_text_cleaners(spark):
    cleaners = {"trim": X.trim_text, "single_line": X.single_line_text, "initcap": X.initcap_text,
                "phone": X.clean_phone, "identity": X.clean_identity_number, "ordinals": X.strip_ordinals}

    @SETTINGS
    @given(BATCH)
    def check(values):
        df = _frame(spark, values)
        once = df.select("i", *[fn("v").alias(n) for n, fn in cleaners.items()])
        twice = once.select("i", *[fn(n).alias(n) for n, fn in cleaners.items()])
        a = sorted(map(tuple, once.collect()))
        b = sorted(map(tuple, twice.collect()))
        # identity numbers: a second pass may strip whitespace a removed tag exposed
        for ra, rb in zip(a, b):
            for k, name in enumerate(["i", *cleaners]):
                if name == "identity":
                    continue
                assert ra[k] == rb[k], (name, ra[k], rb[k])

    check()


def test_phone_output_shape(spark):
    @SETTINGS
    @given(BATCH)
    def check(values):
        out = [r[0] for r in _frame(spark, values).select(X.clean_phone("v")).collect()]
        assert all(v is None or (len(v) == 10 and v.isdigit()) for v in out)

    check()


def test_clamp_in_range(spark):
    stamps = st.lists(st.datetimes(min_value=datetime(1700, 1, 1), max_value=datetime(2200, 1, 1)),
                      min_size=30, max_size=30)

    @SETTINGS
    @given(stamps)
    def check(values):
        df = spark.createDataFrame([(v,) for v in values], "t timestamp")
        out = [r[0] for r in df.select(X.clamp_dates("t")).collect()]
        assert all(datetime(1900, 1, 1) <= v < datetime(2029, 2, 1) for v in out)

    check()


def test_timestamp_cleaners_total(spark):
    """Any text gives a timestamp or null - never an error under ANSI."""
    @SETTINGS
    @given(BATCH)
    def check(values):
        df = _frame(spark, values)
        df.select(X.clean_timestamp("v"), X.repair_time_string("v"), X.epoch_text_to_timestamp("v"),
                  X.text_to_date("v"), X.decimal_amount("v"), X.clean_boolean("v")).collect()

    check()


@settings(max_examples=50, deadline=None)
@given(st.text(max_size=20))
def test_normalize_name_idempotent(name):
    once = mapping.normalize_name(name)
    assert mapping.normalize_name(once) == once
    assert once == once.lower() and not once.startswith("_") and not once.endswith("_")


def test_contract_split_keeps_every_row(spark):
    @SETTINGS
    @given(BATCH)
    def check(values):
        df = _frame(spark, values)
        rules = {"phone": X.clean_phone("v").isNotNull(), "short": F.length("v") < 10}
        good, bad = quality.split_by_contract(df, rules)
        assert good.count() + bad.count() == len(values)

    check()


def test_time_repair_carries_like_timedelta(spark):
    """``yyyy-MM-ddTHH:mm:ss`` with any two-digit fields: the result is the
    date plus that many hours, minutes and seconds, null from hour 24 on."""
    from datetime import date, timedelta

    parts = st.tuples(st.dates(min_value=date(1990, 1, 1), max_value=date(2030, 12, 31)),
                      st.integers(0, 99), st.integers(0, 99), st.integers(0, 99))

    @SETTINGS
    @given(st.lists(parts, min_size=20, max_size=20))
    def check(values):
        texts = [f"{d.isoformat()}T{h:02d}:{m:02d}:{s:02d}" for d, h, m, s in values]
        out = [r[0] for r in _frame(spark, texts).orderBy("i").select(X.repair_time_string("v")).collect()]
        expected = [datetime(d.year, d.month, d.day) + timedelta(hours=h, minutes=m, seconds=s) if h < 24 else None
                    for d, h, m, s in values]
        assert out == expected

    check()


def test_shaped_timestamps_clamp_by_calendar_date(spark):
    stamps = st.lists(st.datetimes(min_value=datetime(1800, 1, 1), max_value=datetime(2100, 1, 1)),
                      min_size=30, max_size=30)

    @SETTINGS
    @given(stamps)
    def check(values):
        texts = [v.replace(microsecond=0).isoformat(sep=" ") for v in values]
        out = [r[0] for r in _frame(spark, texts).orderBy("i").select(X.clean_timestamp("v")).collect()]
        for text, got in zip(texts, out):
            ts = datetime.fromisoformat(text)
            if ts.date() < datetime(1900, 1, 1).date():
                assert got == datetime(1900, 1, 1)
            elif ts.date() > datetime(2029, 1, 31).date():
                assert got == datetime(2029, 1, 31)
            else:
                assert got == ts

    check()
