"""DuckDB forms of the cleaners, used only to write the oracle SQL that the
correctness check runs beside each Spark query.

Differences the forms bridge: DuckDB's ``regexp_replace`` needs ``'g'`` to
replace every match and writes groups as ``\\1`` (Spark: ``$1``); DuckDB has
no ``initcap``; ``count_if`` and ``length`` return other integer widths.

Every rule is stated here again, as the oracle's own literals: nothing comes
from :mod:`lakewash.functions`, so a wrong pattern there shows as a mismatch.
"""

from __future__ import annotations

# --- fixed values: the rules as the oracle states them ------------------------
PHONE_STEPS = [(r"\s+", ""), (r"^\+1|^001", ""), (r"x\d*", ""), (r"[^\d]", "")]
BOOLEAN_TYPOS = [("truee", "true"), ("fal_se", "false")]
ORDINAL = r"(\d{1,2})(st|nd|rd|th)"
BREAK_TAG = r"<br\s*/>"
MIN_TS, MAX_TS = "1900-01-01 00:00:00", "2029-01-31 00:00:00"
NO_DATE = "not a date"
LONG_DATE = r"^[A-Za-z]+\s\d{1,2}[a-z]{2},\s\d{4}$"
WEEKDAY_DATE = r"^[A-Za-z]+,\s[A-Za-z]+\s\d{1,2}[a-z]{2},\s\d{4}$"
TEST_DATE = r"^\d{4}-\d{2}-\d{2}TEST$"
# A date at the start, the rest of the text, and the parts of a date-time.
DATE_START = r"^\s*\d{4}-\d{1,2}-\d{1,2}([ T]|\s*$)"
DATE_TIME = (r"^\s*\d{4}-\d{1,2}-\d{1,2}(?:[ T](\d{1,2}):(\d{1,2})(?::(\d{1,2})(?:\.(\d{1,6}))?)?"
             r"\s*(?:Z|UTC|GMT|([+-])(\d{1,2})(?::?(\d{2}))?)?)?\s*$")
# --- end of fixed values ------------------------------------------------------


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def rx(x: str, pattern: str, repl: str) -> str:
    return f"regexp_replace({x}, {q(pattern)}, {q(repl)}, 'g')"


def chain(x: str, rewrites) -> str:
    for pattern, repl in rewrites:
        x = rx(x, pattern, repl)
    return x


def trim_text(x: str) -> str:
    return f"trim({x})"


def single_line_text(x: str) -> str:
    return f"trim({rx(x, chr(10), ' ')})"


def initcap_text(x: str) -> str:
    return (f"array_to_string(list_transform(string_split(trim({x}), ' '), "
            f"lambda w: upper(w[1]) || lower(w[2:])), ' ')")


def clean_phone(x: str) -> str:
    d = chain(x, PHONE_STEPS)
    return f"CASE WHEN length({d}) = 10 THEN {d} END"


def clean_identity_number(x: str) -> str:
    c = chain(x, [(r"^\s+|\s+$", ""), ("-", ""), (BREAK_TAG, "")])
    return f"CASE WHEN {x} IS NULL OR {x} = '' THEN NULL ELSE {c} END"


def clean_boolean(x: str) -> str:
    t = f"lower(CAST({x} AS VARCHAR))"
    for wrong, right in BOOLEAN_TYPOS:
        t = f"replace({t}, {q(wrong)}, {q(right)})"
    return f"CASE WHEN {t} = 'true' THEN TRUE WHEN {t} = 'false' THEN FALSE END"


def file_stem(x: str) -> str:
    return f"regexp_extract(string_split({x}, '/')[-1], {q(r'(?s)^(.*)\.[^.]*$')}, 1)"


def strip_ordinals(x: str) -> str:
    return rx(x, ORDINAL, r"\1")


def hash_identifier(x: str) -> str:
    return f"sha256({x})"


def _part(x: str, group: int, default: str = "0") -> str:
    return f"coalesce(nullif(regexp_extract({x}, {q(DATE_TIME)}, {group}), ''), {q(default)})"


def _ymd(x: str) -> str:
    """The date text at the start, padded to two-digit fields."""
    y, m, d = (f"regexp_extract({x}, '^\\s*([0-9]{{4}})-([0-9]{{1,2}})-([0-9]{{1,2}})', {i})" for i in (1, 2, 3))
    return f"{y} || '-' || lpad({m}, 2, '0') || '-' || lpad({d}, 2, '0')"


def safe_timestamp(x: str) -> str:
    clock = " || ':' || ".join(f"lpad({_part(x, i)}, 2, '0')" for i in (1, 2, 3))
    micros = f"CAST(rpad({_part(x, 4)}, 6, '0') AS BIGINT)"
    minutes = f"(CAST({_part(x, 6)} AS BIGINT) * 60 + CAST({_part(x, 7)} AS BIGINT))"
    sign = f"(CASE WHEN {_part(x, 5)} = '-' THEN 1 ELSE -1 END)"
    return (f"CASE WHEN regexp_matches({x}, {q(DATE_TIME)}) THEN "
            f"try_strptime({_ymd(x)} || ' ' || {clock}, '%Y-%m-%d %H:%M:%S') + to_microseconds({micros}) "
            f"+ to_microseconds({sign} * {minutes} * 60000000) END")


def text_to_date(x: str) -> str:
    return f"CASE WHEN regexp_matches({x}, {q(DATE_START)}) THEN try_cast({_ymd(x)} AS DATE) END"


def ts_lit(text: str) -> str:
    return f"TIMESTAMP {q(text)}"


def clamp_dates(x: str, lo: str = MIN_TS, hi: str = MAX_TS) -> str:
    return (f"CASE WHEN CAST({x} AS DATE) < CAST({ts_lit(lo)} AS DATE) THEN {ts_lit(lo)} "
            f"WHEN CAST({x} AS DATE) > CAST({ts_lit(hi)} AS DATE) THEN {ts_lit(hi)} ELSE {x} END")


def clean_timestamp(x: str, lo: str = MIN_TS, hi: str = MAX_TS) -> str:
    no_weekday = rx(rx(x, r"^[A-Za-z]+,\s", ""), r"\s+", " ")
    day = text_to_date(x)
    return (
        f"CASE WHEN contains({x}, {q(NO_DATE)}) THEN NULL "
        f"WHEN regexp_matches({x}, {q(WEEKDAY_DATE)}) THEN try_strptime({strip_ordinals(no_weekday)}, '%B %-d, %Y') "
        f"WHEN regexp_matches({x}, {q(LONG_DATE)}) THEN try_strptime({strip_ordinals(x)}, '%B %-d, %Y') "
        f"WHEN regexp_matches({x}, {q(TEST_DATE)}) THEN try_strptime(substr({x}, 1, 10), '%Y-%m-%d') "
        f"WHEN {day} < CAST({ts_lit(lo)} AS DATE) THEN {ts_lit(lo)} "
        f"WHEN {day} > CAST({ts_lit(hi)} AS DATE) THEN {ts_lit(hi)} "
        f"ELSE {safe_timestamp(x)} END"
    )


def epoch_to_timestamp(x: str) -> str:
    return f"CASE WHEN abs({x}) <= 253402300799 THEN make_timestamp(CAST({x} AS BIGINT) * 1000000) END"


def epoch_text_to_timestamp(x: str) -> str:
    whole = f"try_cast(trim({x}) AS BIGINT)"
    return f"CASE WHEN regexp_matches({x}, '^\\s*[+-]?[0-9]+\\s*$') THEN {epoch_to_timestamp(whole)} END"


def repair_time_string(x: str) -> str:
    def hms(h: str, m: str, s: str) -> str:
        return f"try_strptime(substr({x}, 1, 10) || ' ' || {h} || ':' || {m} || ':' || {s}, '%Y-%m-%d %H:%M:%S')"

    def sub(pos: int) -> str:
        return f"substr({x}, {pos}, 2)"

    def starts(shape: str) -> str:
        return f"regexp_matches({x}, {q('^' + shape)})"

    date = r"\d{4}-\d{2}-\d{2}"
    carried = (f"try_strptime(substr({x}, 1, 10), '%Y-%m-%d') + to_hours(CAST({sub(12)} AS INT)) "
               f"+ to_minutes(CAST({sub(15)} AS INT)) + to_seconds(CAST({sub(18)} AS INT))")
    return (
        f"CASE WHEN {starts(r'[0-9]{9,10}$')} THEN make_timestamp(CAST({x} AS BIGINT) * 1000000) "
        f"WHEN {starts(date + r' [0-9]{6}')} THEN {hms(sub(12), sub(14), sub(16))} "
        f"WHEN {starts(date + r'T[0-9]{4}')} THEN {hms(sub(12), sub(14), q('00'))} "
        f"WHEN {starts(date + r' [0-9]{4}:[0-9]{2}')} THEN {hms(sub(12), sub(14), sub(17))} "
        f"WHEN {starts(date + r'T[0-9]{2}:[0-9]{2}:[0-9]{2}')} THEN CASE WHEN CAST({sub(12)} AS INT) <= 23 THEN {carried} END "
        f"ELSE {safe_timestamp(x)} END"
    )


def decimal_amount(x: str) -> str:
    return f"try_cast({x} AS DECIMAL(10,2))"


def row_digest(*cols: str) -> str:
    """MD5 of the fields, each with its length before it (``~`` for null)."""
    field = "CASE WHEN {0} IS NULL THEN '~' ELSE CAST(length(CAST({0} AS VARCHAR)) AS VARCHAR) || ':' || CAST({0} AS VARCHAR) END"
    return "md5(concat(" + ", ".join(field.format(c) for c in cols) + "))"


def stable_uuid(*cols: str) -> str:
    h = row_digest(*cols)
    return (f"concat_ws('-', substr({h}, 1, 8), substr({h}, 9, 4), substr({h}, 13, 4), "
            f"substr({h}, 17, 4), substr({h}, 21, 12))")
