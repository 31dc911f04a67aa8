"""Numeric cleaners."""

from __future__ import annotations

from pyspark.sql import Column

from lakewash.functions.text import ColumnOrName, _col


def decimal_amount(c: ColumnOrName, precision: int = 10, scale: int = 2) -> Column:
    """Text or number -> ``decimal(precision, scale)``, rounded half up.

    Values that do not fit, and text Spark cannot read as a number
    (``1,000.5``), give null instead of failing the job.
    """
    return _col(c).try_cast(f"decimal({precision},{scale})")


def safe_cast(c: ColumnOrName, data_type: str) -> Column:
    """Cast that yields null instead of raising under ANSI mode."""
    return _col(c).try_cast(data_type)
