"""The three loads and the whole job, each safe to run again after a failure.

A load has two halves that meet in the batch marks. *Landing* writes a batch of
the feed to its own bronze partition and marks it. *Refining* takes every
landed batch that silver has not marked. Files may also be landed by a stream
(``strataline.streaming.ingest``); refining is the same. *Publishing* adds the
totals of every refined batch that gold has not marked.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from strataline import fixed_values as fixed
from strataline.functions.text import clean_customers
from strataline.functions.values import money, parse_date, snake_case
from strataline.operators.dedupe import latest_per_key_by_max
from strataline.operators.enrich import Dimension, enrich, is_broadcast, resolved
from strataline.operators.ledger import list_files
from strataline.operators.quality import clean_rows, split_keyless
from strataline.plans import gold
from strataline.plans.lake import BATCH, KPI_FLOW, REFINED, SINCE, Lake, batch_name, load_time
from strataline.sources import tables
from strataline.sources.files import FILE, FILE_TIME, read_csv, read_json_elements, read_json_lines, stamp
from strataline.sources.workbook import read_workbooks

LANDED, PUBLISHED = "landed", "published"
FILES_PER_BATCH = 10_000
JSON_FILES = "*.{json,json.gz,json.lz4}"
"""Files of orders, plain or compressed; Spark's readers tell by the name."""
WRITTEN_APART = 8
"""Up to so many waiting batches are refined one by one: each a write to one partition, without
the sort, and the shuffle, by batch that a write to many takes."""
KPI_PARTS = 64
"""So many partitions of the stored KPI are folded into one."""

Reader = Callable[[list[str]], DataFrame]


def _token(batches: list[str]) -> str:
    """A name for this very set of batches."""
    digest = hashlib.sha256("/".join(batches).encode()).hexdigest()[:12]
    return f"{batches[-1]}-{digest}"


def land(lake: Lake, flow: str, rows: DataFrame, batch: str) -> None:
    """Write all columns of a stamped batch to its bronze partition; mark it.

    Rows and malformed rows are counted while they are written, and the counts stand in the
    mark. (Where Spark repeats a stage after losing an executor, they can be too high.)
    """
    seen = Observation()
    target = lake.spark.table(lake.bronze[flow]).schema
    unknown = {f.name: F.lit(None).cast(f.dataType) for f in target if f.name in (FILE, FILE_TIME)}
    rows = rows.withColumns({name: value for name, value in unknown.items() if name not in rows.columns})
    malformed = F.count_if(F.col(fixed.CORRUPT).isNotNull())
    counted = rows.observe(seen, F.count(F.lit(1)).alias("rows"), malformed.alias("malformed"))
    tables.replace_partitions(counted.withColumn(BATCH, F.lit(batch)), lake.bronze[flow])
    lake.marks.add(flow, [batch], LANDED, counts=(seen.get["rows"], seen.get["malformed"]))


def land_new_files(
    lake: Lake,
    flow: str,
    folder: str | list[str],
    read: Reader,
    glob: str = "*",
    load_ts: datetime | None = None,
    files_per_batch: int = FILES_PER_BATCH,
) -> list[str]:
    """Land the folder's files that the ledger does not know; returns batches.

    File names, never contents, pass the driver, those of one batch at a time.
    More files than fit in one batch become several batches of the same load time,
    so how files are dealt into batches changes no result. Batches planned by a
    run that failed are landed first, from those of their files that are still as
    they were; what an earlier attempt left in the partition is cleared.
    """
    landed = []
    present = list_files(lake.spark, folder, glob)
    for batch in lake.files.unfinished(flow, lake.marks.reached(flow, LANDED)):
        paths = lake.files.paths(flow, batch, present)
        tables.clear_partition(lake.spark, lake.bronze[flow], BATCH, batch)
        if paths:
            land(lake, flow, stamp(read(paths), load_time(batch)), batch)
        else:
            lake.marks.add(flow, [batch], LANDED)
        landed.append(batch)
    moment = load_ts or datetime.now(timezone.utc)
    name = lake.files.unused_name(flow, batch_name(moment))
    for batch in lake.files.plan(lake.files.unseen(present, flow), flow, name, files_per_batch):
        land(lake, flow, stamp(read(lake.files.paths(flow, batch)), moment), batch)
        landed.append(batch)
    return landed


# --- customers ---------------------------------------------------------------


def land_customers(lake: Lake, rows: DataFrame, load_ts: datetime | None = None) -> str:
    """Customers come whole each time; every delivery is one batch."""
    moment = load_ts or datetime.now(timezone.utc)
    land(lake, "customers", stamp(rows, moment), batch_name(moment))
    return batch_name(moment)


def refine_customers(lake: Lake, rebuild: bool = False) -> None:
    """Clean customers and keep each one's latest delivery.

    The default merges only new batches. ``rebuild`` makes the table anew from
    all landed batches and gives the same rows.
    """
    waiting = lake.marks.pending("customers", after=LANDED, before=REFINED)
    if rebuild:
        cleaned = clean_customers(clean_rows(lake.landed("customers")).drop(BATCH))
        rows = latest_per_key_by_max(cleaned, ["customer_id"], [fixed.LOAD_TS])
        lake.customers.rebuild(rows, f"rebuild-{batch_name(datetime.now(timezone.utc))}")
    elif waiting:
        cleaned = clean_customers(clean_rows(lake.raw("customers", waiting)).drop(BATCH))
        lake.customers.merge(cleaned, _token(waiting))
    lake.marks.add("customers", waiting, REFINED)


def load_customers(
    lake: Lake, paths: str | list[str], load_ts: datetime | None = None, rebuild: bool = False
) -> None:
    land_customers(lake, read_workbooks(lake.spark, paths), load_ts)
    refine_customers(lake, rebuild)


# --- products ----------------------------------------------------------------


def refine_products(lake: Lake) -> None:
    """Merge well-formed products of all waiting batches by key and load time.

    A product without an id can never match, so it would be inserted anew with
    each delivery; it stays in bronze.
    """
    waiting = lake.marks.pending("products", after=LANDED, before=REFINED)
    if waiting:
        wanted = clean_rows(lake.raw("products", waiting)).select(
            "product_id", "category", "sub_category", fixed.LOAD_TS
        )
        keyed, _ = split_keyless(wanted, ["product_id"])
        lake.products.merge(keyed, _token(waiting))
        lake.marks.add("products", waiting, REFINED)


def load_products(
    lake: Lake,
    folder: str | list[str],
    load_ts: datetime | None = None,
    files_per_batch: int = FILES_PER_BATCH,
    glob: str = "*.csv",
) -> None:
    def read(paths: list[str]) -> DataFrame:
        return read_csv(lake.spark, paths, sourced=True)

    land_new_files(lake, "products", folder, read, glob, load_ts, files_per_batch)
    refine_products(lake)


# --- orders ------------------------------------------------------------------


def order_facts(raw_orders: DataFrame) -> DataFrame:
    """Well-formed orders with typed date and money, before enrichment."""
    return clean_rows(raw_orders).select(
        "row_id",
        "order_id",
        parse_date("order_date").alias("order_date"),
        "customer_id",
        "product_id",
        money("profit").alias("profit"),
        *(c for c in (fixed.LOAD_TS, FILE, BATCH) if c in raw_orders.columns),
    )


def order_dimensions(products: DataFrame, customers: DataFrame, join: str = "auto") -> list[Dimension]:
    categories = ["category", "sub_category"]
    return [
        Dimension(products, "product_id", categories, fill_unknown=categories, join=join),
        Dimension(customers, "customer_id", ["customer_name", "country"], join=join),
    ]


def enrich_orders(
    facts: DataFrame, products: DataFrame, customers: DataFrame, join: str = "auto"
) -> DataFrame:
    """Every order once, with its product's and its customer's attributes.

    An unknown product gives the word for it, an unknown customer NULL.
    """
    return enrich(facts, order_dimensions(products, customers, join))


def _supersede(lake: Lake, waiting: list[str]) -> None:
    """Note which versions of files the waiting batches replace, or come too late for.

    Of the versions of a path the one with the latest load time counts. A note belongs to
    the batch that makes it true and is seen once that batch is refined.
    """
    entries = lake.files.entries("orders").select(FILE, BATCH).distinct()
    new = F.col(BATCH).isin(waiting)
    touched = entries.where(new).select(FILE).distinct()
    after = F.lead(BATCH).over(Window.partitionBy(FILE).orderBy(BATCH))
    versions = entries.join(touched, FILE, "left_semi").withColumn("after", after).where("after is not null")
    since = F.when(F.col("after").isin(waiting), F.col("after")).when(new, F.col(BATCH))
    known = lake.spark.table(lake.superseded).where(~F.col(SINCE).isin(waiting))
    notes = versions.select(FILE, BATCH, since.alias(SINCE)).where(F.col(SINCE).isNotNull())
    notes = notes.join(known.select(FILE, BATCH), [FILE, BATCH], "left_anti")
    for batch in sorted(tables.partitions(lake.spark, lake.superseded, SINCE) & set(waiting)):
        tables.clear_partition(lake.spark, lake.superseded, SINCE, batch)
    tables.replace_partitions(notes.hint("rebalance", F.col(SINCE)), lake.superseded)


def refine_orders(lake: Lake, join: str = "measured") -> None:
    """Enrich all waiting batches, each into its own silver partition."""
    waiting = lake.marks.pending("orders", after=LANDED, before=REFINED)
    if waiting:
        if lake.latest_versions:
            _supersede(lake, waiting)
        dimensions = order_dimensions(lake.products.read(), lake.customers.read(), join)
        dimensions = [resolved(dimension) for dimension in dimensions]
        if len(waiting) <= WRITTEN_APART:
            for batch in waiting:
                # As a constant the batch needs no sort before the write.
                facts = order_facts(lake.raw("orders", [batch]).withColumn(BATCH, F.lit(batch)))
                tables.replace_partitions(enrich(facts, dimensions), lake.order_enrich)
        else:
            enriched = enrich(order_facts(lake.raw("orders", waiting)), dimensions)
            if not all(map(is_broadcast, dimensions)):
                # Each task of a shuffled join would write a file per batch. Without a
                # shuffle a task has rows of one batch, as it reads its partition.
                enriched = enriched.hint("rebalance", F.col(BATCH))
            tables.replace_partitions(enriched, lake.order_enrich)
        lake.marks.add("orders", waiting, REFINED)


def load_orders(
    lake: Lake,
    folder: str | list[str],
    load_ts: datetime | None = None,
    lines: bool = False,
    files_per_batch: int = FILES_PER_BATCH,
    join: str = "measured",
    glob: str = JSON_FILES,
) -> None:
    """``lines``: the files hold JSON lines instead of one document each."""
    read_json = read_json_lines if lines else read_json_elements

    def read(paths: list[str]) -> DataFrame:
        return snake_case(read_json(lake.spark, paths, sourced=True))

    land_new_files(lake, "orders", folder, read, glob, load_ts, files_per_batch)
    refine_orders(lake, join)


# --- gold and the whole job --------------------------------------------------


def kpi_of_batches(lake: Lake, batches: list[str]) -> DataFrame:
    """The totals of each batch's orders, less those of the file versions it replaces.

    Only the partitions of these batches, and of the versions replaced, are read.
    """
    orders = lake.spark.table(lake.order_enrich)
    own = orders.where(F.col(BATCH).isin(batches)).withColumn(_SIGN, F.lit(1))
    if lake.latest_versions:
        gone = lake.spark.table(lake.superseded).where(F.col(SINCE).isin(batches))
        earlier = [row[0] for row in gone.select(BATCH).distinct().collect()]
        taken = orders.where(F.col(BATCH).isin(earlier)).join(gone, [FILE, BATCH])
        own = own.unionByName(taken.withColumns({BATCH: F.col(SINCE), _SIGN: F.lit(-1)}).drop(SINCE))
    if len(batches) == 1:
        own = own.withColumn(BATCH, F.lit(batches[0]))
    totals = gold.stored_kpi(own, [BATCH], _SIGN)
    # Else each task would write a file for each batch; of few batches it may.
    return totals.hint("rebalance", F.col(BATCH)) if len(batches) > WRITTEN_APART else totals


def publish_kpi(lake: Lake) -> None:
    """Add the totals of new batches to the stored KPI, each in its own partition.

    Totals are exact and add up, so earlier batches are not read again. Beyond
    ``KPI_PARTS`` partitions they are folded into one.
    """
    waiting = lake.marks.pending("orders", after=REFINED, before=PUBLISHED)
    if waiting:
        tables.replace_partitions(kpi_of_batches(lake, waiting), lake.kpi_table)
        lake.marks.add("orders", waiting, PUBLISHED)
    if len(lake.kpi_parts()) > KPI_PARTS:
        fold_kpi(lake)


def fold_kpi(lake: Lake) -> None:
    """Sum the partitions of the stored KPI into a new one, which counts in their place.

    One mark, written at once, says so; what was folded is cleared by the next fold, when
    no reader that began before can be left.
    """
    steps = lake.marks.steps(KPI_FLOW)
    there = tables.partitions(lake.spark, lake.kpi_table, BATCH)
    old = sorted({batch for batch, step in steps if step == "folded"} & there)
    for batch in old:
        tables.clear_partition(lake.spark, lake.kpi_table, BATCH, batch)
    tables.forget_partitions(lake.spark, lake.kpi_table, BATCH, old)
    parts = lake.kpi_parts()
    name = f"fold-{sum(step == 'made' for _, step in steps):06d}"
    stored = lake.spark.table(lake.kpi_table).where(F.col(BATCH).isin(parts))
    tables.replace_partitions(gold.added_up(stored).withColumn(BATCH, F.lit(name)), lake.kpi_table)
    lake.marks.add(KPI_FLOW, [name], "made", also=[(parts, "folded")])


_SIGN = "_sign"


def reports(lake: Lake) -> dict[str, DataFrame]:
    """The four reports, from the stored KPI."""
    return {name: gold.report(lake.kpis(), name) for name in gold.REPORTS}


def run_all(
    lake: Lake,
    customers: str | list[str],
    products: str,
    orders: str,
    load_ts: datetime | None = None,
    lines: bool = False,
) -> dict[str, DataFrame]:
    """Load what is new in the three feeds and return the reports."""
    load_customers(lake, customers, load_ts)
    load_products(lake, products, load_ts)
    load_orders(lake, orders, load_ts, lines=lines)
    publish_kpi(lake)
    return reports(lake)
