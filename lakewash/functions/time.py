"""Time cleaners: dirty text in, ``timestamp`` (or ``date``) out.

Spark 4 runs with ANSI on, so a plain cast of unreadable text raises. Every
parse here is a ``try_`` form behind a shape guard: the guard keeps Spark
from reading ``'10:15'`` as today at 10:15 or ``'2024'`` as 1 January, and
the ``try_`` form turns impossible dates (30 February) into null. Every arm of
every ``CASE`` is typed ``timestamp``, so the result type never depends on the
ANSI setting.

Timestamps are instants in the session zone, which jobs pin to UTC
(:func:`lakewash.session.pin_utc`). Sinks without zones receive them as
``timestamp_ntz`` (see :func:`lakewash.operators.mapping.to_zoneless`).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakewash.functions.text import ColumnOrName, _col, _text, strip_ordinals

# --- fixed values: bounds and patterns that decide which rows are cleaned ---
# Dates before the lower bound or after the upper bound are clamped to it.
DEFAULT_MIN_TS = "1900-01-01 00:00:00"
DEFAULT_MAX_TS = "2029-01-31 00:00:00"
# Text containing this marker is a known non-date.
NOT_A_DATE = "not a date"
# "Friday, March 1st, 2024"
WEEKDAY_LONG_DATE = r"^[A-Za-z]+,\s[A-Za-z]+\s\d{1,2}[a-z]{2},\s\d{4}$"
# "March 1st, 2024"
LONG_DATE = r"^[A-Za-z]+\s\d{1,2}[a-z]{2},\s\d{4}$"
# "2024-03-15TEST"
DATE_TEST_SUFFIX = r"^\d{4}-\d{2}-\d{2}TEST$"
LONG_DATE_FORMAT = "MMMM d, yyyy"
# The month words that pattern reads (full English names, any letter case).
MONTH_NAMES = ["January", "February", "March", "April", "May", "June", "July",
               "August", "September", "October", "November", "December"]
# Broken time strings, matched at the start of the text in this order.
EPOCH_DIGITS = r"^\d{9,10}$"
DATE_SPACE_HHMMSS = r"^\d{4}-\d{2}-\d{2} \d{6}"
DATE_T_HHMM = r"^\d{4}-\d{2}-\d{2}T\d{4}"
DATE_T_HH_MM_SS = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}"
DATE_SPACE_HHMM_SS = r"^\d{4}-\d{2}-\d{2} \d{4}:\d{2}"
# Leading weekday and repeated whitespace, dropped from long dates.
WEEKDAY_PREFIX = r"^[A-Za-z]+,\s"
WHITESPACE_RUN = r"\s+"
# --- end of fixed values ------------------------------------------------------

_MONTH_FIRST = "(?i)^(" + "|".join(MONTH_NAMES) + ") "

# Text that starts with a full date, padded or not. What follows the date is
# left to Spark's own cast, which reads times with one-digit fields, fractions
# and zones, and gives null for anything else.
DATE_SHAPE = r"(?s)^\s*\d{4}-\d{1,2}-\d{1,2}([ T].*|\s*)$"
# Epoch seconds: an integer of any length, signed and padded or not; the range
# is tested on the number.
EPOCH_TEXT_SHAPE = r"^\s*[+-]?\d+\s*$"
_MAX_EPOCH = 253402300799  # 9999-12-31 23:59:59 UTC


def safe_timestamp(c: ColumnOrName) -> Column:
    """Lenient Spark cast, but only for text that starts with a full date."""
    col = _text(c)
    return F.when(col.rlike(DATE_SHAPE), col.try_cast("timestamp"))


def text_to_date(c: ColumnOrName) -> Column:
    """Date from ``yyyy-MM-dd`` text (anything after a space or ``T`` is
    ignored, as a Spark date cast does); other shapes and impossible dates
    give null."""
    col = _text(c)
    return F.when(col.rlike(DATE_SHAPE), col.try_cast("date"))


def _ts(text: str) -> Column:
    return F.lit(text).cast("timestamp")


def clamp_dates(ts: ColumnOrName, lo: str = DEFAULT_MIN_TS, hi: str = DEFAULT_MAX_TS) -> Column:
    """Clamp by calendar date: a day before ``lo``'s date becomes ``lo``, a
    day after ``hi``'s date becomes ``hi``; the bound days themselves are kept
    whole (``2029-01-31 12:00`` stays)."""
    col = _col(ts)
    day = F.to_date(col)
    return (F.when(day < F.to_date(_ts(lo)), _ts(lo))
            .when(day > F.to_date(_ts(hi)), _ts(hi))
            .otherwise(col.cast("timestamp")))


def clean_timestamp(c: ColumnOrName, lo: str = DEFAULT_MIN_TS, hi: str = DEFAULT_MAX_TS) -> Column:
    """Timestamp from dirty text; the first matching arm wins.

    1. contains ``not a date`` -> null
    2. ``Friday, March 1st, 2024`` -> weekday and ordinal dropped, parsed
    3. ``March 1st, 2024`` -> ordinal dropped, parsed (abbreviated months and
       impossible days give null)
    4. ``2024-03-15TEST`` -> the date part
    5. a date before ``lo`` -> ``lo``
    6. a date after ``hi`` -> ``hi`` (compared as dates)
    7. otherwise a shape-guarded cast, null when unreadable

    Arms 2 to 4 are not clamped. The day of month is kept in arms 2 and 3.
    """
    col = _text(c)
    no_weekday = F.regexp_replace(F.regexp_replace(col, WEEKDAY_PREFIX, ""), WHITESPACE_RUN, " ")

    def long_date(text: Column) -> Column:
        # Only a full month name can parse; testing for one first spares the
        # parser a thrown exception per abbreviated or misspelt month.
        return F.when(text.rlike(_MONTH_FIRST), F.try_to_timestamp(strip_ordinals(text), F.lit(LONG_DATE_FORMAT)))

    # Arms 5-7 only apply to text that starts with a full date, so that shape
    # is tested once and guards all three.
    day = col.try_cast("date")
    shaped = (F.when(day < F.to_date(_ts(lo)), _ts(lo))
              .when(day > F.to_date(_ts(hi)), _ts(hi))
              .otherwise(col.try_cast("timestamp")))
    return (
        F.when(col.contains(NOT_A_DATE), F.lit(None).cast("timestamp"))
        .when(col.rlike(WEEKDAY_LONG_DATE), long_date(no_weekday))
        .when(col.rlike(LONG_DATE), long_date(col))
        .when(col.rlike(DATE_TEST_SUFFIX),
              F.try_to_timestamp(F.substring(col, 1, 10), F.lit("yyyy-MM-dd")))
        .when(col.rlike(DATE_SHAPE), shaped)
    )


def epoch_text_to_timestamp(c: ColumnOrName) -> Column:
    """Epoch seconds written as an integer -> timestamp; padding, a sign and
    leading zeros are read. Fractions and values past the year 9999 give null."""
    col = _text(c)
    return F.when(col.rlike(EPOCH_TEXT_SHAPE), epoch_to_timestamp(col.try_cast("bigint")))  # the cast trims


def epoch_to_timestamp(c: ColumnOrName) -> Column:
    """Epoch seconds (integer) -> timestamp; out-of-range values give null."""
    col = _col(c)
    return F.when(F.abs(col) <= F.lit(_MAX_EPOCH), F.timestamp_seconds(col))


def parse_with_pattern(c: ColumnOrName, pattern: str) -> Column:
    """Parse with a Spark datetime pattern; null when the text does not fit."""
    return F.try_to_timestamp(_text(c), F.lit(pattern))


def repair_time_string(c: ColumnOrName) -> Column:
    """Timestamp from broken time text; the text is matched at its start:

    1. nine or ten digits: epoch seconds
    2. ``yyyy-MM-dd HHmmss`` and ``yyyy-MM-dd HHmm:ss``: colons restored
    3. ``yyyy-MM-ddTHHmm``: seconds set to zero (trailing digits ignored)
    4. ``yyyy-MM-ddTHH:mm:ss``: seconds of 60 or more carry into minutes,
       minutes into hours, hours into days (``10:75:20`` -> ``11:15:20``);
       an hour above 23 is no time and gives null
    5. anything else: shape-guarded cast, else null

    Text after the matched prefix (fractions, zone suffix) is ignored.
    """
    col = _text(c)
    date_part = F.substring(col, 1, 10)

    def hms(h: Column, m: Column, s: Column) -> Column:
        return F.try_to_timestamp(F.concat(date_part, F.lit(" "), h, F.lit(":"), m, F.lit(":"), s),
                                  F.lit("yyyy-MM-dd HH:mm:ss"))

    def num(pos: int) -> Column:
        return F.substring(col, pos, 2).cast("int")

    carried = (F.try_to_timestamp(date_part, F.lit("yyyy-MM-dd"))
               + F.make_dt_interval(F.lit(0), num(12), num(15), num(18).cast("decimal(18,6)")))
    return (
        F.when(col.rlike(EPOCH_DIGITS), F.timestamp_seconds(col.try_cast("bigint")))
        .when(col.rlike(DATE_SPACE_HHMMSS),
              hms(F.substring(col, 12, 2), F.substring(col, 14, 2), F.substring(col, 16, 2)))
        .when(col.rlike(DATE_T_HHMM),
              hms(F.substring(col, 12, 2), F.substring(col, 14, 2), F.lit("00")))
        .when(col.rlike(DATE_SPACE_HHMM_SS),
              hms(F.substring(col, 12, 2), F.substring(col, 14, 2), F.substring(col, 17, 2)))
        .when(col.rlike(DATE_T_HH_MM_SS), F.when(num(12) <= 23, carried))
        .otherwise(safe_timestamp(col))
    )
