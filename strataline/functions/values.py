"""Column expressions for dates and money, and header names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataline import fixed_values as fixed


def parse_date(value: Column | str, pattern: str = fixed.ORDER_DATE_FORMAT) -> Column:
    """Text to date; text that does not fit the pattern becomes NULL.

    ``to_date`` would fail the whole job on the first bad row under ANSI mode.
    """
    return F.try_to_date(F.col(value) if isinstance(value, str) else value, pattern)


def money(value: Column | str) -> Column:
    """Half-up to cents, as an exact decimal."""
    return F.round(value, 2).cast(fixed.MONEY_TYPE)


def or_unknown(value: Column | str) -> Column:
    return F.coalesce(F.col(value) if isinstance(value, str) else value, F.lit(fixed.UNKNOWN))


def snake_case(frame: DataFrame) -> DataFrame:
    """Lower-case headers with ``_`` for each blank; nothing else changes."""
    return frame.toDF(*(name.lower().replace(" ", "_") for name in frame.columns))
