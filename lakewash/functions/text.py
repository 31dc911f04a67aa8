"""Text cleaners. Each takes a column (or a column name) and returns a
``Column`` built from Spark's own functions, so every rule runs inside
whole-stage code generation, never in a Python worker.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Union

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Union[Column, str]

# --- fixed values: these must equal the source rules for equal results -----
# Phone rewrite steps, applied in this order: drop whitespace, drop a leading
# +1 or 001, drop an x-extension with its digits, drop every other non-digit.
PHONE_REWRITES = [
    (r"\s+", ""),
    (r"^\+1|^001", ""),
    (r"x\d*", ""),
    (r"[^\d]", ""),
]
PHONE_DIGITS = 10
# Misspellings repaired before a boolean is read, in this order.
BOOLEAN_REPAIRS = [
    ("truee", "true"),
    ("fal_se", "false"),
]
# Text written in place of a secret.
SECRET_MASK = "********"
# English day ordinals stripped before a date is parsed.
ORDINAL_PATTERN = r"(\d{1,2})(st|nd|rd|th)"
# Markup removed from identity numbers.
BREAK_TAG_PATTERN = r"<br\s*/>"
# --- end of fixed values ------------------------------------------------------


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _text(c: ColumnOrName) -> Column:
    """The input read as text, so a column that schema inference typed (a
    number, a timestamp) is cleaned like its written form. A no-op on text."""
    return _col(c).cast("string")


def trim_text(c: ColumnOrName) -> Column:
    """Strip spaces at both ends (spaces only; tabs and newlines stay)."""
    return F.trim(_text(c))


def single_line_text(c: ColumnOrName) -> Column:
    """Newlines become spaces, then the ends are trimmed (a character map,
    no regex engine)."""
    return F.trim(F.translate(_text(c), "\n", " "))


def initcap_text(c: ColumnOrName) -> Column:
    """Trim, then capitalise each space-separated word (the rest lower-cased)."""
    return F.initcap(F.trim(_text(c)))


def regex_chain(c: ColumnOrName, rewrites: Iterable[tuple[str, str]]) -> Column:
    """Apply ``(pattern, replacement)`` rewrites in order, each to every match.

    Replacements use Java syntax: a group is ``$1``.
    """
    return reduce(lambda acc, pr: F.regexp_replace(acc, pr[0], pr[1]), rewrites, _text(c))


# The same four rewrites in two regex passes. Whitespace is dropped before the
# prefix and extension rules see the text, so both rules here let whitespace
# sit anywhere inside what they match; every other non-digit goes in the
# second pass, which removes one character at a time and so cannot interact
# with the extension rule.
_PHONE_PREFIX = r"^\s*(\+\s*1|0\s*0\s*1)"
_PHONE_REST = r"x[\s\d]*|[^\d]"


def clean_phone(c: ColumnOrName) -> Column:
    """Ten-digit phone number, else null.

    The rules of :data:`PHONE_REWRITES`, in order: drop whitespace, drop a
    leading ``+1`` or ``001``, drop an ``x`` with the digits right after it,
    drop every other non-digit; keep exactly ten digits. ``+1 (555) 123-4567``
    -> ``5551234567``; ``1-555-123-4567`` (eleven digits) -> null; ``x-12``
    loses only the ``x``, so the 12 stays. Evaluated in two regex passes
    instead of four (same result; see ``tests/test_functions.py``).
    """
    digits = F.regexp_replace(F.regexp_replace(_text(c), _PHONE_PREFIX, ""), _PHONE_REST, "")
    return F.when(F.length(digits) == PHONE_DIGITS, digits)


def clean_identity_number(c: ColumnOrName) -> Column:
    """Null or empty -> null; strip surrounding whitespace; drop ``-`` and
    ``<br/>`` / ``<br />`` tags.

    Whitespace-only input gives an empty string. Whitespace exposed by a
    removed tag stays. ``\\s`` is Java's ASCII whitespace class.
    """
    col = _text(c)
    cleaned = regex_chain(col, [(r"^\s+|\s+$", ""), ("-", ""), (BREAK_TAG_PATTERN, "")])
    return F.when(col.isNull() | (col == ""), F.lit(None).cast("string")).otherwise(cleaned)


def clean_boolean(c: ColumnOrName) -> Column:
    """Lower-case, repair known misspellings once left to right, then read
    exactly ``true`` / ``false``; anything else (including padded text) is null.
    """
    text = F.lower(_text(c))
    for wrong, right in BOOLEAN_REPAIRS:
        text = F.replace(text, F.lit(wrong), F.lit(right))
    return F.when(text == "true", F.lit(True)).when(text == "false", F.lit(False))


def file_stem(c: ColumnOrName) -> Column:
    """File name without folders and without its last extension.

    ``s3a://b/d/a.b.csv`` -> ``a.b``; a name with no dot -> empty string.
    """
    name = F.substring_index(_text(c), "/", -1)
    return F.regexp_extract(name, r"(?s)^(.*)\.[^.]*$", 1)


def strip_ordinals(c: ColumnOrName) -> Column:
    """``March 22nd, 2024`` -> ``March 22, 2024``."""
    return F.regexp_replace(_text(c), ORDINAL_PATTERN, "$1")


def hash_identifier(c: ColumnOrName) -> Column:
    """Hex SHA-256 of the text; null stays null."""
    return F.sha2(_text(c), 256)


def mask_secret(c: ColumnOrName | None = None) -> Column:
    """A fixed mask; every row gets it, nulls included."""
    return F.lit(SECRET_MASK)


def matches(c: ColumnOrName, pattern: str) -> Column:
    """True when the pattern is found anywhere in the text (Java regex)."""
    return _text(c).rlike(pattern)


def text_length(c: ColumnOrName) -> Column:
    """Length in characters as a 64-bit integer."""
    return F.length(_text(c)).cast("bigint")


def text_prefix(c: ColumnOrName, n: int) -> Column:
    """The first ``n`` characters."""
    return F.substring(_text(c), 1, n)
