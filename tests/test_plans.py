"""The physical plans the operators are meant to get."""

import os
import re

import pytest
from pyspark.sql import functions as F

from checks import inputs
from checks.queries import QUERIES
from strataline.operators.enrich import Dimension, enrich, even_share, hot_keys
from strataline.session import scratch, shared_folder
from strataline.sources import tables

DATA = "/root/testdata/sf0.001"
PURE = (
    "kpi_agg profit_by_year profit_by_year_category profit_by_year_customer profit_by_customer "
    "profit_all_reports order_enrich clean_customer clean_text snake_headers parse_dates "
    "latest_per_key latest_per_key_max distinct_rows latest_batch newer_than_watermark "
    "merge_upsert temp_view_scan batch_guards"
).split()


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def read_columns(text, table):
    schemas = re.findall(rf"{table}\.parquet.*?ReadSchema: struct<(.*?)>", text)
    return [sorted(c.split(":")[0] for c in s.split(",")) for s in schemas]


@pytest.mark.parametrize("name", PURE)
def test_no_cross_join_and_no_python_in_the_plan(spark, name):
    text = plan(QUERIES[name](spark, DATA))
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonEval", "MapInPandas"):
        assert unwanted not in text


def test_flagship_reads_only_what_it_needs(spark):
    text = plan(QUERIES["kpi_agg"](spark, DATA))
    assert read_columns(text, "lineitem") == [
        ["l_discount", "l_extendedprice", "l_orderkey", "l_partkey"]
    ]
    assert read_columns(text, "orders") == [["o_custkey", "o_orderdate", "o_orderkey"]]
    assert read_columns(text, "part") == [["p_brand", "p_partkey", "p_type"]]
    # Facts meet facts by sort-merge; only the dimension is broadcast.
    assert text.count("SortMergeJoin") == 1 and text.count("BroadcastHashJoin") == 1
    assert "partial_sum" in text


def test_year_report_shuffles_only_partial_sums(spark):
    text = plan(QUERIES["profit_by_year"](spark, DATA))
    assert "part.parquet" not in text
    assert len(re.findall(r"HashAggregate\(keys=\[_groupingexpression", text)) == 2


def test_filters_reach_the_scan(spark):
    text = plan(QUERIES["temp_view_scan"](spark, DATA))
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in text


def test_a_dimension_over_the_threshold_is_not_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        assert "BroadcastHashJoin" not in plan(QUERIES["order_enrich"](spark, DATA))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_facts_of_hot_and_missing_keys_are_not_shuffled(spark, tmp_path):
    kind = F.col("id") % 3
    key = F.when(kind == 0, F.lit(-1)).when(kind == 1, F.col("id"))
    facts_path = str(tmp_path / "facts")
    spark.range(0, 9000, numPartitions=16).select("id", key.alias("product_id")).write.parquet(facts_path)
    facts = spark.read.parquet(facts_path)
    products = spark.range(-1, 9000).select(
        F.col("id").alias("product_id"), F.lit("c").alias("category")
    )
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = enrich(facts, [Dimension(products, "product_id", ["category"], join="split")])
        assert joined.count() == 9000 and joined.where("category is not null").count() == 6000
        text = plan(joined)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    at_rest, shuffled_part = re.split(r"\n +\+- SortMergeJoin", text, maxsplit=1)
    # One branch broadcasts the hot key's row to the facts where they are.
    assert "BroadcastHashJoin" in at_rest and "Exchange hashpartitioning" not in at_rest
    assert "product_id#" in at_rest and "isnull(product_id" in at_rest
    # The facts of the other branch are those with a key that is not hot.
    assert "isnull(_is_hot" in shuffled_part and "isnotnull(product_id" in shuffled_part
    assert shuffled_part.count("LeftAnti, BuildRight") == 1


@pytest.mark.parametrize("partitions", [6_000, 500_000])
def test_a_split_join_does_not_depend_on_the_number_of_partitions(spark, tmp_path, partitions):
    """At the larger number, which a test cannot run, keys and plan only."""
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
    path = str(tmp_path / "facts")
    spark.range(0, 30_000, numPartitions=8).select("id", key.alias("product_id")).write.parquet(path)
    facts = spark.read.parquet(path)
    products = facts.select("product_id").distinct().withColumn("category", F.upper("product_id"))
    kept = {c: spark.conf.get(c) for c in ("spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        share = even_share(facts)
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        assert share == 1 / partitions
        joined = enrich(facts, [Dimension(products, "product_id", ["category"], join="split", hot_share=share)])
        assert joined.where("category is null or category <> upper(product_id)").isEmpty()
        assert joined.count() == 30_000
        assert plan(joined).count("SortMergeJoin") == 1
        assert hot_keys(facts, "product_id", share).counts.where("key = 'hot'").first().n == 10_000
    finally:
        for name, value in kept.items():
            spark.conf.set(name, value)


def test_a_bucketed_dimension_is_not_shuffled(spark, tmp_path):
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 500).cast("string"))
    path, schema = str(tmp_path / "facts"), inputs.new_prefix() + "buckets"
    spark.range(0, 30_000, numPartitions=8).select("id", key.alias("product_id")).write.parquet(path)
    facts = spark.read.parquet(path)
    tables.create_schema(spark, schema, str(tmp_path / "schema"))
    made = facts.select("product_id").distinct().withColumn("category", F.upper("product_id"))
    products = tables.overwrite_bucketed(made, f"{schema}.products", "product_id", 16, str(tmp_path / "products"))
    cold = tables.overwrite_bucketed(facts.where("product_id <> 'hot'"), f"{schema}.cold", "product_id", 16, str(tmp_path / "cold"))
    assert len([f for f in os.listdir(tmp_path / "products") if f.endswith(".parquet")]) == 16
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = enrich(facts, [Dimension(products, "product_id", ["category"], join="split", hot_share=0.1)])
        text = plan(joined)
        # The facts alone move, and of them those with a rare key.
        assert text.count("Exchange hashpartitioning") == 1 and text.count("SortMergeJoin") == 1
        assert joined.where("category = upper(product_id)").count() == 30_000
        staged = enrich(cold, [Dimension(products, "product_id", ["category"])])
        assert "Exchange" not in plan(staged) and "SortMergeJoin" in plan(staged)
        assert staged.where("category = upper(product_id)").count() == 20_000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_batches_that_wait_together_are_not_shuffled(spark, lake, landing, monkeypatch):
    from strataline.plans import flows
    from strataline.sources import tables

    one = '{"Row ID": %d, "Order ID": "O", "Order Date": "1/2/2020", "Product ID": "P", "Profit": 1.0}'
    for number in (1, 2):
        landing(f"orders/{number}.json", one % number)
    written = []
    real = tables.replace_partitions

    def remember(frame, name):
        written.append((name, plan(frame)))
        real(frame, name)

    with monkeypatch.context() as patch:
        patch.setattr(flows, "refine_orders", lambda *a: None)
        flows.load_orders(lake, f"{landing.folder}/orders", lines=True, files_per_batch=1)
    assert len(lake.marks.pending("orders", flows.LANDED, flows.REFINED)) >= 1
    monkeypatch.setattr(tables, "replace_partitions", remember)
    flows.refine_orders(lake)
    (text,) = [t for name, t in written if name == lake.order_enrich]
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text and "REBALANCE" not in text
    flows.publish_kpi(lake)
    (text,) = [t for name, t in written if name == lake.kpi_table]
    assert re.search(r"PartitionFilters: \[.*batch#", text)


def test_one_batch_is_read_from_its_partition(spark, lake):
    lake_rows = spark.range(4).selectExpr("id as row_id", "cast(id % 2 as string) as batch")
    columns = [f for f in spark.table(lake.bronze["orders"]).schema if f.name not in lake_rows.columns]
    full = lake_rows.select("*", *(F.lit(None).cast(f.dataType).alias(f.name) for f in columns))
    from strataline.sources import tables

    tables.replace_partitions(full, lake.bronze["orders"])
    text = plan(lake.raw("orders", ["1"]).select("row_id"))
    assert re.search(r"PartitionFilters: \[isnotnull\(batch#\d+\), \(batch#\d+ = 1\)\]", text)
    assert "ReadSchema: struct<row_id:bigint>" in text


def test_scratch_goes_below_the_shared_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert shared_folder(spark) == named.rstrip("/")
    first, second = scratch(spark, "x"), scratch(spark, "x")
    assert first != second and first.startswith(shared_folder(spark))


def test_scratch_paths_can_be_cleared(spark, monkeypatch):
    from strataline import session

    monkeypatch.setattr(session, "_given", {})
    made, unused = scratch(spark, "made"), scratch(spark, "unused")
    spark.range(3).write.parquet(made)
    assert session.clear_scratch(spark) == [made] and unused
    assert not os.path.exists(made.removeprefix("file://")) and session.clear_scratch(spark) == []


def test_documents_and_workbooks_are_bounded():
    assert inputs.ORDERS_PER_DOCUMENT < 10_000
    assert inputs.CUSTOMERS_PER_WORKBOOK < 1_048_576
