"""Row-level incremental selection, decided inside the query.

The bounds are scalar subqueries: Spark evaluates each once and pushes it into
the scan, and no value travels through the driver as text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataline import fixed_values as fixed


def high_water_mark(rows: DataFrame, column: str = fixed.LOAD_TS) -> Column:
    """The greatest value of ``column`` as a scalar subquery; NULL if no rows."""
    return rows.agg(F.max(column).alias("high_water")).scalar()


def newer_than(
    source: DataFrame,
    target: DataFrame,
    column: str = fixed.LOAD_TS,
    inclusive: bool = False,
) -> DataFrame:
    """Source rows loaded after everything in the target; all, if it is empty.

    ``inclusive`` also takes rows *at* the mark. Appending those again after a
    run would count the last batch twice, hence the strict default.
    """
    start = F.lit(fixed.EARLIEST_LOAD).cast(source.schema[column].dataType)
    mark = F.coalesce(high_water_mark(target, column), start)
    value = F.col(column)
    return source.where(value >= mark if inclusive else value > mark)


def latest_batch(rows: DataFrame, column: str = fixed.LOAD_TS) -> DataFrame:
    """Rows of the most recent load only."""
    return rows.where(F.col(column) == high_water_mark(rows, column))
