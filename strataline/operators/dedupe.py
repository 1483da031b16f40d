"""Keep one row per key, or one of each distinct row.

Both forms of ``latest_per_key`` cut every map task's rows to one per key
before the shuffle, so a key that holds most rows costs one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

_RANK = "_latest_rank"
_BEST = "_latest_row"


def _order(rows: DataFrame, keys, newest, tiebreak) -> list[str]:
    fixed_order = [*newest, *(tiebreak or ())]
    rest = [c for c in rows.columns if c not in keys and c not in fixed_order]
    # With no stated tie-break all other columns decide, so equal versions of a
    # key give the same winner in every run.
    return fixed_order if tiebreak is not None else fixed_order + rest


def latest_per_key(
    rows: DataFrame,
    keys: Sequence[str],
    newest: Sequence[str],
    tiebreak: Sequence[str] | None = None,
) -> DataFrame:
    """The row with the highest ``newest`` for each key; NULL is a key too.

    Spark plans the rank filter as a group limit on both sides of the shuffle.
    """
    order = [F.col(c).desc_nulls_last() for c in _order(rows, keys, newest, tiebreak)]
    ranked = rows.withColumn(
        _RANK, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    )
    return ranked.where(F.col(_RANK) == 1).drop(_RANK)


def latest_per_key_by_max(
    rows: DataFrame,
    keys: Sequence[str],
    newest: Sequence[str],
    tiebreak: Sequence[str] | None = None,
) -> DataFrame:
    """The same rows as an aggregate: the greatest struct of each key.

    All columns must be orderable (no maps).
    """
    order = _order(rows, keys, newest, tiebreak)
    rest = [c for c in rows.columns if c not in keys and c not in order]
    best = F.max(F.struct(*order, *rest)).alias(_BEST)
    picked = rows.groupBy(*keys).agg(best)
    return picked.select(
        *(F.col(c) if c in keys else F.col(f"{_BEST}.{c}").alias(c) for c in rows.columns)
    )


def distinct_rows(rows: DataFrame) -> DataFrame:
    """One of each set of rows equal in all columns."""
    return rows.dropDuplicates()
