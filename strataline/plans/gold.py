"""Profit by year, category, sub-category and customer, and its reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataline import fixed_values as fixed

KPI_KEYS = ("order_year", "category", "sub_category", "customer_id")
TOTAL = "total_profit"

REPORTS = {
    "by_year": ("order_year",),
    "by_year_category": ("order_year", "category"),
    "by_year_customer": ("order_year", "customer_id"),
    "by_customer": ("customer_id",),
}


def kpi(orders: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Total profit by the four keys, and those in ``by``; undated orders form a NULL year.

    Sums are combined before the only shuffle, so a customer or product with
    most of the rows costs no more than any other.
    """
    return orders.groupBy(F.year("order_date").alias("order_year"), *KPI_KEYS[1:], *by).agg(
        F.sum("profit").cast(fixed.MONEY_TYPE).alias(TOTAL)
    )


N_ORDERS, N_PROFITS = "n_orders", "n_profits"
STORED_KPI = f"{fixed.GOLD_KPI}, {N_ORDERS} bigint, {N_PROFITS} bigint"


def stored_kpi(orders: DataFrame, by: Sequence[str], sign: str | None = None) -> DataFrame:
    """Totals that can be taken back: with the number of orders, and of those with a profit.

    ``sign`` names a column of 1 and -1: orders of -1 are taken back. Such rows add up to those
    of the orders that are left, also where none is, or none with a profit.
    """
    times = F.lit(1) if sign is None else F.col(sign)
    profit = F.when(times < 0, -F.col("profit")).otherwise(F.col("profit"))
    has = F.when(F.col("profit").isNotNull(), times).otherwise(0)
    return orders.groupBy(F.year("order_date").alias("order_year"), *KPI_KEYS[1:], *by).agg(
        F.sum(profit).cast(fixed.MONEY_TYPE).alias(TOTAL),
        F.sum(times).cast("bigint").alias(N_ORDERS),
        F.sum(has).cast("bigint").alias(N_PROFITS),
    )


def added_up(stored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Stored totals of any number of batches as those of one, with their counts."""
    return stored.groupBy(*KPI_KEYS, *by).agg(
        F.sum(TOTAL).cast(fixed.MONEY_TYPE).alias(TOTAL),
        F.sum(N_ORDERS).cast("bigint").alias(N_ORDERS),
        F.sum(N_PROFITS).cast("bigint").alias(N_PROFITS),
    )


def kpi_of_stored(stored: DataFrame) -> DataFrame:
    """The KPI: groups that still have orders, NULL where none of them has a profit."""
    total = F.when(F.col(N_PROFITS) > 0, F.col(TOTAL)).cast(fixed.MONEY_TYPE)
    return added_up(stored).where(F.col(N_ORDERS) > 0).select(*KPI_KEYS, total.alias(TOTAL))


def report(kpis: DataFrame, name: str) -> DataFrame:
    """One of ``REPORTS``: totals of the KPI frame, sorted by the report's keys."""
    return total_by(kpis, REPORTS[name]).orderBy(*REPORTS[name])


def report_of_orders(orders: DataFrame, name: str) -> DataFrame:
    """The same report straight from orders.

    Totals are exact decimals, so summing in one step equals summing the KPI,
    and it saves the shuffle by all four keys. Worth it when the KPI is not
    stored and just one report is wanted.
    """
    keys = [F.year("order_date").alias(k) if k == "order_year" else F.col(k) for k in REPORTS[name]]
    totals = orders.groupBy(*keys).agg(F.sum("profit").cast(fixed.MONEY_TYPE).alias(TOTAL))
    return totals.orderBy(*REPORTS[name])


def total_by(kpis: DataFrame, keys: Sequence[str]) -> DataFrame:
    return kpis.groupBy(*keys).agg(F.sum(TOTAL).cast(fixed.MONEY_TYPE).alias(TOTAL))


def all_reports(kpis: DataFrame) -> DataFrame:
    """The four reports in one pass; ``report`` says which one a row is of.

    The rows that grouping sets multiply are KPI rows, not order rows: those are
    summed up by then. Columns a report does not use are NULL.
    """
    columns = ("order_year", "category", "customer_id")
    sets = [[F.col(key) for key in keys] for keys in REPORTS.values()]
    absent = [F.grouping(c) for c in columns]
    # Which columns are absent identifies the report.
    name = F.when(absent[0] == 1, F.lit("by_customer"))
    name = name.when(absent[1] == 0, F.lit("by_year_category"))
    name = name.when(absent[2] == 0, F.lit("by_year_customer")).otherwise(F.lit("by_year"))
    return kpis.groupingSets(sets, *columns).agg(
        F.sum(TOTAL).alias(TOTAL), name.alias("report")
    )


def kpi_view_query(orders_table: str) -> str:
    """The KPI over a table, as the text of a view."""
    by = ", ".join(KPI_KEYS[1:])
    return (
        f"SELECT year(order_date) AS order_year, {by}, "
        f"CAST(sum(profit) AS {fixed.MONEY_TYPE}) AS {TOTAL} "
        f"FROM {orders_table} GROUP BY ALL"
    )
