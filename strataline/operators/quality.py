"""Set malformed and keyless rows aside instead of losing them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataline import fixed_values as fixed


def clean_rows(written: DataFrame, corrupt: str = fixed.CORRUPT) -> DataFrame:
    """Well-formed rows of a *written* frame, without the corrupt column."""
    return written.where(F.col(corrupt).isNull()).drop(corrupt)


def quarantine(written: DataFrame, corrupt: str = fixed.CORRUPT) -> DataFrame:
    """Malformed rows of a *written* frame, raw text included."""
    return written.where(F.col(corrupt).isNotNull())


def split_keyless(rows: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with every key set, rows with at least one key missing)."""
    whole = F.lit(True)
    for key in keys:
        whole = whole & F.col(key).isNotNull()
    return rows.where(whole), rows.where(~whole)


def row_count(rows: DataFrame) -> DataFrame:
    """The number of rows, as a one-row frame."""
    return rows.agg(F.count(F.lit(1)).alias("n_rows"))


def is_empty(rows: DataFrame) -> bool:
    """Whether there is nothing to do; reads at most one row."""
    return rows.isEmpty()
