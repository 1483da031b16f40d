"""One query per operator, each over whole tables of the driver's data."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from checks import inputs
from strataline import fixed_values as fixed
from strataline.functions.text import clean_customers, clean_email, clean_name, digits
from strataline.functions.values import money, parse_date, snake_case
from strataline.operators import dedupe, incremental, quality, upsert
from strataline.operators.enrich import Dimension, enrich
from strataline.operators.ledger import BatchMarks, FileLedger, list_files
from strataline.plans import flows, gold
from strataline.plans.lake import BATCH, Lake, load_time
from strataline.session import scratch
from strataline.sources import tables
from strataline.sources.files import FILE, FILE_TIME, read_csv, read_json_documents, read_json_elements, read_json_lines, stamp
from strataline.sources.workbook import parse_workbooks, read_workbooks
from strataline.streaming.ingest import ORDER_KEYS, land_stream, load_orders_stream, merge_stream

LOADED_AT = datetime(2024, 1, 1, tzinfo=timezone.utc)
TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


# --- gold ----------------------------------------------------------------------


def categorised_sales(spark: SparkSession, sf: str) -> DataFrame:
    categories = ["category", "sub_category"]
    catalogue = Dimension(
        inputs.products(spark, sf), "product_id", categories, fill_unknown=categories
    )
    return enrich(inputs.sales(spark, sf), [catalogue])


def kpi_agg(spark, sf):
    return gold.kpi(categorised_sales(spark, sf))


def profit_by_year(spark, sf):
    return gold.report_of_orders(inputs.sales(spark, sf), "by_year")


def profit_by_year_category(spark, sf):
    return gold.report_of_orders(categorised_sales(spark, sf), "by_year_category")


def profit_by_year_customer(spark, sf):
    return gold.report_of_orders(inputs.sales(spark, sf), "by_year_customer")


def profit_by_customer(spark, sf):
    return gold.report_of_orders(inputs.sales(spark, sf), "by_customer")


def profit_all_reports(spark, sf):
    return gold.all_reports(kpi_agg(spark, sf))


def profit_from_view(spark, sf):
    """A report over the catalog view of a stored silver table."""
    lake = _lake(spark)
    facts = categorised_sales(spark, sf).select(
        "row_id",
        F.col("order_id").cast("string"),
        F.col("order_date").cast("date"),
        F.col("customer_id").cast("string"),
        F.col("product_id").cast("string"),
        money("profit").alias("profit"),
        "category",
        "sub_category",
        F.lit(None).cast("string").alias("customer_name"),
        F.lit(None).cast("string").alias("country"),
        F.lit(LOADED_AT).alias(fixed.LOAD_TS),
        F.lit(None).cast("string").alias(FILE),
        F.lit("first").alias(BATCH),
    )
    tables.replace_partitions(facts, lake.order_enrich)
    return gold.report(spark.table(lake.kpi_view), "by_year_category")


# --- silver orders ---------------------------------------------------------------


def _enriched(spark, sf, join, bucketed=False, **changes):
    facts = inputs.sales(spark, sf).select(
        "row_id",
        "order_id",
        parse_date(F.date_format("order_date", "d/M/yyyy")).alias("order_date"),
        "customer_id",
        "product_id",
        money("profit").alias("profit"),
        "returned",
    )
    facts = facts.withColumns(changes).drop("returned")
    if join == "split":
        # It looks at the facts' keys first, so they are stored, as in bronze.
        folder = scratch(spark, "facts")
        facts.write.parquet(folder)
        facts = spark.read.parquet(folder)
    listed = inputs.products(spark, sf).where(F.col("size") <= 45)
    # PROMO is no category: a NULL from the dimension itself.
    listed = listed.withColumn("category", F.expr("nullif(category, 'PROMO')"))
    solvent = inputs.customers(spark, sf).where(F.col("balance") >= 0)
    if bucketed:
        schema, folder = inputs.new_prefix() + "buckets", scratch(spark, "buckets")
        tables.create_schema(spark, schema, folder)
        listed = tables.overwrite_bucketed(listed, f"{schema}.products", "product_id", 16, f"{folder}/products")
        solvent = tables.overwrite_bucketed(solvent, f"{schema}.customers", "customer_id", 16, f"{folder}/customers")
    return flows.enrich_orders(facts, listed, solvent, join)


def order_enrich(spark, sf):
    return _enriched(spark, sf, "auto")


def order_enrich_measured(spark, sf):
    return _enriched(spark, sf, "measured")


def order_enrich_split(spark, sf):
    """All returned items belong to one customer, a third of the facts; the
    rest of them have no product."""
    returned = F.col("returned")
    return _enriched(
        spark,
        sf,
        "split",
        customer_id=F.when(returned, F.lit(1)).otherwise(F.col("customer_id")),
        product_id=F.when(returned, F.col("product_id")),
    )


def order_enrich_bucketed(spark, sf):
    """Both dimensions are bucketed tables, and hot customers are set aside."""
    hot = F.when(F.col("returned"), F.lit(1)).otherwise(F.col("customer_id"))
    return _enriched(spark, sf, "split", bucketed=True, customer_id=hot)


# --- cleaning and projections ------------------------------------------------------


def clean_customer(spark, sf):
    cleaned = clean_customers(inputs.dirty_customers(spark, sf))
    return cleaned.select("customer_id", "customer_name", "email", "phone")


def clean_text(spark, sf):
    return inputs.table(spark, sf, "documents").select(
        "doc_id",
        clean_name("text").alias("letters"),
        clean_email("text").alias("address_characters"),
        digits("text").alias("digits"),
    )


def snake_headers(spark, sf):
    spaced = inputs.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("Order Key"),
        F.col("o_custkey").alias("Customer ID"),
        F.col("o_orderstatus").alias("Order-Status"),
        F.col("o_totalprice").alias("Total Price"),
    )
    return snake_case(spaced)


def parse_dates(spark, sf):
    """Orders of status P carry a date in another format, which gives NULL."""
    orders = inputs.table(spark, sf, "orders")
    text = F.when(
        F.col("o_orderstatus") == "P", F.date_format("o_orderdate", "yyyy-MM-dd")
    ).otherwise(F.date_format("o_orderdate", "d/M/yyyy"))
    return orders.select(
        "o_orderkey", parse_date(text).alias("order_date"), F.year(parse_date(text)).alias("order_year")
    )


# --- one row per key -----------------------------------------------------------------


def latest_per_key(spark, sf):
    return dedupe.latest_per_key(
        inputs.table(spark, sf, "events"), ["user_id"], ["ts"], ["event_id"]
    )


def latest_per_key_max(spark, sf):
    return dedupe.latest_per_key_by_max(
        inputs.table(spark, sf, "events"), ["user_id"], ["ts"], ["event_id"]
    )


def distinct_rows(spark, sf):
    return dedupe.distinct_rows(
        inputs.table(spark, sf, "lineitem").select("l_partkey", "l_returnflag", "l_linestatus")
    )


# --- row-level increments ----------------------------------------------------------


def _loads(spark, sf):
    return inputs.table(spark, sf, "events").select(
        "event_id", "user_id", "value", F.to_date("ts").alias(fixed.LOAD_TS)
    )


def _loaded_before(spark, sf):
    return _loads(spark, sf).where(F.col(fixed.LOAD_TS) <= F.lit("2024-01-20").cast("date"))


def latest_batch(spark, sf):
    return incremental.latest_batch(_loads(spark, sf))


def newer_than_watermark(spark, sf):
    return incremental.newer_than(_loads(spark, sf), _loaded_before(spark, sf))


def watermark_inclusive(spark, sf):
    return incremental.newer_than(_loads(spark, sf), _loaded_before(spark, sf), inclusive=True)


def newer_than_nothing(spark, sf):
    """An empty target has no mark: all rows are new."""
    loads = _loads(spark, sf)
    return incremental.newer_than(loads, loads.where(F.col("event_id") < 0))


def money_of_products(spark, sf):
    """Exact decimals with a third and fourth digit, halves included, to the cent."""
    exact = (F.col("l_extendedprice").cast("decimal(12,2)") * F.col("l_discount").cast("decimal(4,2)")).alias("exact")
    half = F.col("l_quantity").cast("decimal(12,0)") * F.lit("0.005").cast("decimal(4,3)")
    return inputs.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", money(exact).alias("discounted"), money(half).alias("halves")
    )


def reports_in_order(spark, sf):
    """The place of each row in the report by year and category, undated orders included."""
    undated = inputs.sales(spark, sf).withColumn(
        "order_date", F.when(F.col("returned"), F.lit(None)).otherwise(F.col("order_date"))
    )
    categories = ["category", "sub_category"]
    catalogue = Dimension(inputs.products(spark, sf), "product_id", categories, fill_unknown=categories)
    ordered = gold.report(gold.kpi(enrich(undated, [catalogue])), "by_year_category")
    # The id grows in the order of the partitions and of the rows in them, so it is the
    # order in which the report comes; its rows are few.
    came = ordered.withColumn("came", F.monotonically_increasing_id())
    return came.withColumn("place", F.row_number().over(Window.orderBy("came"))).drop("came")


# --- upsert ---------------------------------------------------------------------------


def _versions(spark, sf):
    """(target, source): a part's version is its size; the source has two
    versions of each of its keys, of which only the higher may count."""
    parts = inputs.products(spark, sf).withColumnRenamed("size", "version")
    target = parts.where(F.col("category") != "ECONOMY")
    changed = parts.where(~F.col("sub_category").isin("Brand#1", "Brand#2", "Brand#3"))
    newer = changed.withColumns(
        {"category": F.lower("category"), "version": F.lit(25)}
    )
    older = changed.withColumns({"category": F.lit("stale"), "version": F.lit(20)})
    return target, newer.unionByName(older)


def merge_upsert(spark, sf):
    target, source = _versions(spark, sf)
    return upsert.merge_frames(target, source, ["product_id"], "version")


def _bucketed(spark, columns, key, version, **options):
    folder, schema = scratch(spark, "bucketed"), inputs.new_prefix() + "merge"
    tables.create_schema(spark, schema, f"{folder}/schema")
    marks = BatchMarks(spark, f"{schema}.marks", f"{folder}/marks")
    table = upsert.BucketedTable(
        spark, f"{schema}.keyed", columns, [key], marks, version, location=f"{folder}/keyed",
        buckets=8, **options,
    )
    marks.create()
    table.create()
    return table


def merge_upsert_bucketed(spark, sf):
    columns = "product_id bigint, category string, sub_category string, version int"
    table = _bucketed(spark, columns, "product_id", "version")
    target, source = _versions(spark, sf)
    table.merge(target, "first")
    table.merge(source, "second")
    table.merge(source, "again")
    return table.read()


# --- files ------------------------------------------------------------------------------


def _written(spark, rows):
    """All columns of a raw frame in a table; only then is it split."""
    folder = scratch(spark, "bronze")
    stamp(rows, LOADED_AT).write.parquet(folder)
    return spark.read.parquet(folder).drop(fixed.LOAD_TS)


def _products_csv(spark, sf):
    return _written(spark, read_csv(spark, inputs.write_product_csv(spark, sf)))


def csv_clean(spark, sf):
    return quality.clean_rows(_products_csv(spark, sf))


def csv_quarantine(spark, sf):
    return quality.quarantine(_products_csv(spark, sf)).select(
        "product_id", "category", "sub_category", "product_name", "state",
        F.col(fixed.CORRUPT).alias("raw_text"),
    )


_ORDER_COLUMNS = ("row_id", "order_id", "customer_id", "price", "ship_mode")


def json_documents_clean(spark, sf):
    folder = inputs.write_order_documents(spark, sf)
    raw = snake_case(read_json_documents(spark, folder))
    return quality.clean_rows(_written(spark, raw)).select(*_ORDER_COLUMNS)


def json_documents_quarantine(spark, sf):
    folder = inputs.write_order_documents(spark, sf)
    raw = snake_case(read_json_documents(spark, folder))
    return quality.row_count(quality.quarantine(_written(spark, raw)))


def _order_elements(spark, sf):
    raw = read_json_elements(spark, inputs.write_order_documents_with_faults(spark, sf))
    return _written(spark, snake_case(raw))


def json_elements_clean(spark, sf):
    """Documents in which some orders have a text for a price: all others are clean."""
    return quality.clean_rows(_order_elements(spark, sf)).select(*_ORDER_COLUMNS)


def json_elements_quarantine(spark, sf):
    """And those orders alone are set aside, each with its own text."""
    return quality.quarantine(_order_elements(spark, sf)).select(
        *_ORDER_COLUMNS, F.col(fixed.CORRUPT).alias("raw_text")
    )


def json_lines_clean(spark, sf):
    raw = snake_case(read_json_lines(spark, inputs.write_order_lines(spark, sf)))
    return quality.clean_rows(_written(spark, raw)).select(*_ORDER_COLUMNS)


def json_lines_quarantine(spark, sf):
    raw = snake_case(read_json_lines(spark, inputs.write_order_lines(spark, sf)))
    # The malformed field is NULL, the others of its row are kept.
    return quality.quarantine(_written(spark, raw)).select(*_ORDER_COLUMNS)


def workbook_rows(spark, sf):
    books = inputs.customer_workbooks(spark, sf)
    return parse_workbooks(books).select(
        "customer_id", "customer_name", "email", "phone", "city", "postal"
    )


# --- the file ledger ----------------------------------------------------------------


def file_ledger_new_files(spark, sf):
    """Events arrive in two deliveries; after the first is in the ledger, only
    files of the second are new."""
    landing, folder = scratch(spark, "events"), scratch(spark, "ledger")
    schema = inputs.new_prefix() + "ledger"
    tables.create_schema(spark, schema, f"{folder}/schema")
    ledger = FileLedger(spark, f"{schema}.processed_files", f"{folder}/files")
    ledger.create()
    events = inputs.table(spark, sf, "events").select(
        "event_id", "user_id", "event_type", "value", F.to_date("ts").alias("day")
    )
    first = F.col("day") < F.lit("2024-01-16").cast("date")

    def deliver(rows):
        rows.hint("rebalance", F.col("day")).write.mode("append").partitionBy("day").json(landing)

    deliver(events.where(first))
    ledger.plan(list_files(spark, landing, "*.json"), "events", "first")
    deliver(events.where(~first))
    ledger.plan(ledger.unseen(list_files(spark, landing, "*.json"), "events"), "events", "second")
    return read_json_lines(
        spark,
        ledger.paths("events", "second"),
        "event_id bigint, user_id bigint, event_type string, value double",
    )


def _events_ledger(spark):
    folder, schema = scratch(spark, "ledger"), inputs.new_prefix() + "ledger"
    tables.create_schema(spark, schema, f"{folder}/schema")
    ledger = FileLedger(spark, f"{schema}.processed_files", f"{folder}/files")
    ledger.create()
    return ledger


def _event_files(spark, sf):
    """A file for each event, of the event's time."""
    return inputs.table(spark, sf, "events").select(
        F.concat(F.lit("file:/events/"), "event_id").alias("file_path"),
        F.date_trunc("second", F.col("ts").cast("timestamp")).alias("modification_time"),
    )


def files_modified_since(spark, sf):
    """Files newer than all in the ledger, which knows those of the first half of the
    month; and, for an object without an entry, all of them."""
    ledger, files = _events_ledger(spark), _event_files(spark, sf)
    known = files.where(F.col("modification_time") < F.lit("2024-01-16").cast("timestamp"))
    ledger.plan(known, "events", "first")
    return reduce(
        DataFrame.unionByName,
        (
            ledger.modified_since(files, obj).select(F.lit(obj).alias("object"), "file_path")
            for obj in ("events", "others")
        ),
    )


def ledger_entries(spark, sf):
    """Rows made by the caller are entered as files, in parts of a thousand, and read back."""
    ledger, files = _events_ledger(spark), _event_files(spark, sf)
    local = spark.createDataFrame(
        [("file:/local", LOADED_AT)], "file_path string, modification_time timestamp"
    )
    ledger.plan(files, "events", "base", files_per_batch=1000)
    ledger.plan(local, "events", "local")
    return ledger.entries("events").select(
        "file_path",
        F.date_format("modification_time", "yyyy-MM-dd HH:mm:ss").alias("modified"),
        F.substring("batch", 1, 4).alias("planned_as"),
    )


# --- streams -------------------------------------------------------------------------


def _lake(spark):
    return Lake(spark, scratch(spark, "lake"), inputs.new_prefix(), buckets=8).create()


def stream_ingest_orders(spark, sf):
    """Orders arrive in two deliveries, each drained by its own stream run."""
    lake, landing = _lake(spark), scratch(spark, "orders-landing")
    checkpoint = scratch(spark, "orders-checkpoint")
    objects = inputs.order_objects(spark, sf)
    late = F.col("o_orderstatus") == "P"
    for delivery in (objects.where(~late), objects.where(late)):
        delivery.select("order.*").write.mode("append").json(landing)
        raw = snake_case(read_json_lines(spark, landing, stream=True))
        land_stream(lake, "orders", stamp(raw, LOADED_AT), checkpoint)
    return lake.raw("orders").select(*_ORDER_COLUMNS)


def stream_orders_once(spark, sf):
    """Orders come in three stream runs over one checkpoint; the second repeats finished orders
    under new file names, the third everything."""
    lake, landing = _lake(spark), scratch(spark, "orders-landing")
    checkpoint = scratch(spark, "orders-checkpoint")
    objects = inputs.order_objects(spark, sf)
    status = F.col("o_orderstatus")
    for day, which in enumerate((status != "P", status != "O", F.lit(True)), 1):
        objects.where(which).select("order.*").write.mode("append").json(landing)
        moment = LOADED_AT.replace(day=day)
        load_orders_stream(lake, landing, checkpoint, moment, lines=True, once_by=ORDER_KEYS)
    return lake.raw("orders").select(*_ORDER_COLUMNS, F.dayofmonth(fixed.LOAD_TS).alias("came_on"))


def stream_upsert_customers(spark, sf):
    """All customers come first, then a second version of those in debt."""
    columns = "customer_id bigint, customer_name string, segment string, version int"
    table = _bucketed(spark, columns, "customer_id", "version")
    landing, checkpoint = scratch(spark, "versions"), scratch(spark, "versions-checkpoint")
    everyone = inputs.customers(spark, sf).select(
        "customer_id", "customer_name", "segment", F.lit(1).alias("version"), "balance"
    )
    debtors = everyone.where(F.col("balance") < 0).withColumns(
        {"segment": F.lower("segment"), "version": F.lit(2)}
    )
    for delivery in (everyone, debtors):
        delivery.drop("balance").write.mode("append").json(landing)
        versions = read_json_lines(spark, landing, columns, stream=True)
        merge_stream(table, versions, checkpoint)
    return table.read()


# --- tables ---------------------------------------------------------------------------


def _order_table(spark):
    folder, schema = scratch(spark, "tables"), inputs.new_prefix() + "tables"
    tables.create_schema(spark, schema, f"{folder}/schema")
    name = f"{schema}.orders"
    columns = "o_orderkey bigint, o_orderstatus string, o_totalprice double"
    tables.create_table(spark, name, columns, f"{folder}/orders")
    return name


def append_table(spark, sf):
    """Two appends, the second with its columns in another order."""
    name, orders = _order_table(spark), inputs.table(spark, sf, "orders")
    done = F.col("o_orderstatus") == "F"
    tables.append(orders.where(done).select("o_orderkey", "o_orderstatus", "o_totalprice"), name)
    tables.append(orders.where(~done).select("o_totalprice", "o_orderkey", "o_orderstatus"), name)
    return tables.read(spark, name)


def overwrite_table(spark, sf):
    name, orders = _order_table(spark), inputs.table(spark, sf, "orders")
    orders = orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    tables.append(orders, name)
    tables.overwrite(orders.withColumn("o_orderstatus", F.lower("o_orderstatus")), name)
    return tables.read(spark, name)


def view_of_table(spark, sf):
    """A table is dropped and made again, then read through a view."""
    name = _order_table(spark)
    tables.drop_table(spark, name)
    tables.create_table(
        spark, name, "o_orderkey bigint, o_orderstatus string, o_totalprice double",
        scratch(spark, "tables"),
    )
    orders = inputs.table(spark, sf, "orders")
    tables.append(orders.select("o_orderkey", "o_orderstatus", "o_totalprice"), name)
    tables.create_view(
        spark,
        f"{name}_by_status",
        f"SELECT o_orderstatus, count(*) AS n_orders FROM {name} GROUP BY o_orderstatus",
    )
    return tables.read(spark, f"{name}_by_status")


def temp_view_scan(spark, sf):
    """A frame handed to SQL under a name, with the columns and rows it needs."""
    inputs.table(spark, sf, "orders").createOrReplaceTempView("orders_view")
    return spark.sql(
        "SELECT o_orderkey, o_totalprice FROM orders_view WHERE o_orderstatus = 'F'"
    )


def batch_guards(spark, sf):
    """Row count of every table, and whether it is empty; the same of its rows that
    cannot be, as their key is below zero."""
    guarded = []
    for name in TABLES:
        rows = inputs.table(spark, sf, name)
        for label, part in ((name, rows), (f"{name} below zero", rows.where(F.col(rows.columns[0]) < 0))):
            counted = quality.row_count(part).select(F.lit(label).alias("table_name"), "n_rows")
            guarded.append(counted.withColumn("is_empty", F.lit(quality.is_empty(part))))
    return reduce(DataFrame.unionByName, guarded)


# --- the whole job -------------------------------------------------------------------


def _loaded_lake(spark, sf):
    lake = _lake(spark)
    books = inputs.customer_workbooks(spark, sf)
    flows.land_customers(lake, parse_workbooks(books), LOADED_AT)
    flows.refine_customers(lake)
    flows.load_products(lake, inputs.write_product_csv(spark, sf), LOADED_AT)
    flows.load_orders(lake, inputs.write_sales_lines(spark, sf), LOADED_AT, lines=True)
    return lake


def end_to_end_profit(spark, sf):
    """Three feeds of files through all layers to a report. Malformed products
    never reach silver, so their orders count as unknown."""
    lake = _loaded_lake(spark, sf)
    flows.publish_kpi(lake)
    return flows.reports(lake)["by_year_category"]


SECOND_LOAD = datetime(2024, 2, 1, tzinfo=timezone.utc)


def products_of_two_files(spark, sf):
    """Two files deliver the same products in one run, each file a batch of its own;
    the other columns decide between equal load times."""
    lake, folder = _lake(spark), scratch(spark, "two-files")
    listed = inputs.products(spark, sf).select(
        F.col("product_id").cast("string"),
        "category",
        "sub_category",
        F.lit("n").alias("product_name"),
        F.lit("s").alias("state"),
        F.lit(1.0).alias("price_per_product"),
    )
    for rows in (listed, listed.withColumn("category", F.reverse("category"))):
        rows.write.mode("append").csv(folder, header=True)
    flows.load_products(lake, folder, LOADED_AT, files_per_batch=1)
    return lake.products.read().select(
        "product_id", "category", "sub_category", F.col(fixed.LOAD_TS).cast("date").alias("loaded")
    )


def _customers_again(spark, sf):
    """Customers in debt are delivered again, in another country."""
    again = inputs.dirty_customers(spark, sf, balance_below=0)
    return again.withColumn("country", F.concat(F.lit("new "), "country"))


def _delivered_customers(lake, sf, rebuild):
    spark = lake.spark
    first = inputs.write_workbooks(spark, inputs.dirty_customers(spark, sf))
    flows.load_customers(lake, first, LOADED_AT)
    second = inputs.write_workbooks(spark, _customers_again(spark, sf))
    flows.land_customers(lake, read_workbooks(spark, second), SECOND_LOAD)
    flows.refine_customers(lake, rebuild)
    return lake.customers.read().select(
        "customer_id", "customer_name", "phone", "country", F.col(fixed.LOAD_TS).cast("date").alias("loaded")
    )


def customers_merged(spark, sf):
    return _delivered_customers(_lake(spark), sf, rebuild=False)


def customers_rebuilt(spark, sf):
    return _delivered_customers(_lake(spark), sf, rebuild=True)


def _two_deliveries(spark, sf):
    """The whole job twice. The second delivery has customers in debt again, all
    products of two brands under another category, and every fifth order."""
    lake = _lake(spark)
    customers = inputs.write_workbooks(spark, inputs.dirty_customers(spark, sf))
    products = inputs.write_product_csv(spark, sf)
    late = F.col("order_id") % 5 == 0
    orders = inputs.write_sales_lines(spark, sf, ~late)
    flows.run_all(lake, customers, products, orders, LOADED_AT, lines=True)
    customers = inputs.write_workbooks(spark, _customers_again(spark, sf))
    inputs.write_product_csv(spark, sf, changed=("Brand#1", "Brand#2"), folder=products)
    inputs.write_sales_lines(spark, sf, late, folder=orders)
    flows.run_all(lake, customers, products, orders, SECOND_LOAD, lines=True)
    return lake


def end_to_end_two_deliveries(spark, sf):
    return _two_deliveries(spark, sf).orders().withColumn(fixed.LOAD_TS, F.col(fixed.LOAD_TS).cast("date"))


def reports_after_two_deliveries(spark, sf):
    """All four reports over the stored KPI of two batches."""
    return gold.all_reports(_two_deliveries(spark, sf).kpis())


def _rewritten_orders(spark, sf):
    """Every other file of orders is written again, without the items that were returned."""
    lake = Lake(spark, scratch(spark, "lake"), inputs.new_prefix(), buckets=8, latest_versions=True).create()
    flows.load_products(lake, inputs.write_product_csv(spark, sf), LOADED_AT)
    folder = inputs.write_sales_files(spark, sf, scratch(spark, "sales-files"))
    flows.load_orders(lake, folder, LOADED_AT, lines=True)
    flows.publish_kpi(lake)
    again = F.floor(F.col("order_id") / inputs.ORDERS_PER_DOCUMENT) % 2 == 0
    inputs.write_sales_files(spark, sf, folder, again & ~F.col("returned"))
    flows.load_orders(lake, folder, SECOND_LOAD, lines=True)
    flows.publish_kpi(lake)
    return lake


def orders_of_latest_versions(spark, sf):
    return _rewritten_orders(spark, sf).orders().select("row_id", "order_id", "category", "profit")


def reports_of_latest_versions(spark, sf):
    """The KPI, from which the totals of replaced file versions were taken, folded into one partition."""
    lake = _rewritten_orders(spark, sf)
    flows.fold_kpi(lake)
    return gold.all_reports(lake.kpis())


def load_time_of_products(spark, sf):
    """Products loaded at the current time: each has the time in its batch's mark, within the load."""
    lake, before = _lake(spark), datetime.now(timezone.utc)
    flows.load_products(lake, inputs.write_product_csv(spark, sf))
    (batch,) = lake.marks.passed("products", flows.REFINED)
    now = spark.range(1).select(F.current_timestamp().alias("now"))
    stamped = F.col(fixed.LOAD_TS)
    within = (stamped >= F.lit(before)) & (stamped <= F.col("now"))
    return lake.products.read().crossJoin(F.broadcast(now)).select(
        "product_id", within.alias("within_load"), (stamped == F.lit(load_time(batch))).alias("as_marked")
    )


def landing_counts(spark, sf):
    """Rows and malformed rows of landed batches, as counted while they were written."""
    lake = _lake(spark)
    flows.load_products(lake, inputs.write_product_csv(spark, sf), LOADED_AT)
    flows.load_orders(lake, inputs.write_order_lines(spark, sf), LOADED_AT, lines=True, glob="*.txt")
    return reduce(
        DataFrame.unionByName,
        (
            lake.marks.counts(flow, flows.LANDED).select(F.lit(flow).alias("flow"), "n_rows", "n_malformed")
            for flow in ("products", "orders")
        ),
    )


def rows_by_planned_file(spark, sf):
    """Rows of bronze by whether the file they were read from, in that version, was planned for their batch."""
    lake = _lake(spark)
    flows.load_orders(lake, inputs.write_order_lines(spark, sf), LOADED_AT, lines=True, files_per_batch=2, glob="*.txt")
    planned = lake.files.entries("orders").select(
        FILE, F.col("modification_time").alias(FILE_TIME), BATCH, F.lit(True).alias("planned")
    )
    read = lake.raw("orders").join(planned, [FILE, FILE_TIME, BATCH], "left")
    return read.groupBy(F.coalesce("planned", F.lit(False)).alias("planned")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("order_id").alias("n_orders")
    )


def end_to_end_orders(spark, sf):
    """The same, silver orders after a second run that finds nothing new."""
    lake = _loaded_lake(spark, sf)
    flows.refine_products(lake)
    flows.refine_orders(lake)
    return lake.orders().drop(fixed.LOAD_TS)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        kpi_agg,
        profit_by_year,
        profit_by_year_category,
        profit_by_year_customer,
        profit_by_customer,
        profit_all_reports,
        profit_from_view,
        order_enrich,
        order_enrich_measured,
        order_enrich_split,
        order_enrich_bucketed,
        clean_customer,
        clean_text,
        snake_headers,
        parse_dates,
        latest_per_key,
        latest_per_key_max,
        distinct_rows,
        latest_batch,
        newer_than_watermark,
        watermark_inclusive,
        merge_upsert,
        merge_upsert_bucketed,
        csv_clean,
        csv_quarantine,
        json_documents_clean,
        json_documents_quarantine,
        json_elements_clean,
        json_elements_quarantine,
        json_lines_clean,
        json_lines_quarantine,
        workbook_rows,
        file_ledger_new_files,
        stream_ingest_orders,
        stream_orders_once,
        stream_upsert_customers,
        append_table,
        overwrite_table,
        view_of_table,
        temp_view_scan,
        batch_guards,
        end_to_end_profit,
        end_to_end_orders,
        newer_than_nothing,
        money_of_products,
        reports_in_order,
        files_modified_since,
        ledger_entries,
        products_of_two_files,
        customers_merged,
        customers_rebuilt,
        end_to_end_two_deliveries,
        reports_after_two_deliveries,
        orders_of_latest_versions,
        reports_of_latest_versions,
        load_time_of_products,
        landing_counts,
        rows_by_planned_file,
    )
}
# The split join was a salted one once; its query keeps that name too.
QUERIES["order_enrich_salted"] = order_enrich_split
