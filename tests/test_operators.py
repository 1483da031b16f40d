import random
from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from compare import rows
from strataline.operators.dedupe import distinct_rows, latest_per_key, latest_per_key_by_max
from strataline.operators.enrich import Dimension, enrich, hot_keys, measured_bytes
from strataline.operators.incremental import high_water_mark, latest_batch, newer_than
from strataline.operators.upsert import merge_frames

few = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)

versions = st.lists(
    st.tuples(
        st.one_of(st.none(), st.integers(0, 4)), st.integers(0, 3), st.sampled_from("abc")
    ),
    max_size=25,
)
COLUMNS = "k int, v int, x string"


def best(group):
    return max(group, key=lambda r: (r[1], r[2]))


def by_key(data):
    groups = {}
    for row in data:
        groups.setdefault(row[0], []).append(row)
    return groups


@few
@given(versions)
def test_latest_per_key_is_the_greatest_of_each_key(spark, data):
    frame = spark.createDataFrame(data, COLUMNS)
    expected = sorted((best(g) for g in by_key(data).values()), key=repr)
    assert rows(latest_per_key(frame, ["k"], ["v"])) == expected
    assert rows(latest_per_key_by_max(frame, ["k"], ["v"])) == expected


def test_latest_per_key_is_cut_before_the_shuffle(spark):
    plan = latest_per_key(spark.createDataFrame([(1, 2, "a")], COLUMNS), ["k"], ["v"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("WindowGroupLimit") == 2


def test_distinct_rows_compares_all_columns(spark):
    frame = spark.createDataFrame([(1, 1, "a"), (1, 1, "a"), (1, 1, None), (1, 1, None)], COLUMNS)
    assert rows(distinct_rows(frame)) == [(1, 1, "a"), (1, 1, None)]


def merged(target, source):
    out = {row[0]: row for row in target}
    for key, group in by_key(source).items():
        new = best(group)
        if key is None:
            continue
        if key not in out or new[1] >= out[key][1]:
            out[key] = new
    return out


@few
@given(versions, versions)
def test_merge_agrees_with_one_key_at_a_time(spark, target, source):
    held = [best(g) for k, g in by_key(target).items() if k is not None]
    source = [r for r in source if r[0] is not None]
    got = merge_frames(
        spark.createDataFrame(held, COLUMNS), spark.createDataFrame(source, COLUMNS), ["k"], "v"
    )
    assert rows(got) == sorted(merged(held, source).values(), key=repr)


def test_merge_cases(spark):
    target = spark.createDataFrame(
        [(1, 5, "kept"), (2, 5, "older loses"), (3, 5, "equal"), (4, 5, "newer")], COLUMNS
    )
    source = spark.createDataFrame(
        [(2, 4, "no"), (3, 5, "tie"), (4, 6, "new"), (5, 1, "added"), (5, 0, "stale")], COLUMNS
    )
    assert rows(merge_frames(target, source, ["k"], "v")) == [
        (1, 5, "kept"), (2, 5, "older loses"), (3, 5, "tie"), (4, 6, "new"), (5, 1, "added"),
    ]
    partly = merge_frames(target, source, ["k"], "v", update=["x"])
    assert (4, 5, "new") in rows(partly) and (5, 1, "added") in rows(partly)


def test_null_keys_match_only_when_asked(spark):
    target = spark.createDataFrame([(None, 1, "old")], COLUMNS)
    source = spark.createDataFrame([(None, 2, "new")], COLUMNS)
    assert merge_frames(target, source, ["k"], "v").count() == 2
    assert rows(merge_frames(target, source, ["k"], "v", null_safe=True)) == [(None, 2, "new")]


DAYS = "n int, load_ts date"


def day(number):
    return date(2024, 1, number)


def test_newer_rows_and_the_inclusive_trap(spark):
    source = spark.createDataFrame([(i, day(i)) for i in range(1, 6)], DAYS)
    target = spark.createDataFrame([(1, day(1)), (3, day(3))], DAYS)
    empty = target.limit(0)
    assert [r[0] for r in rows(newer_than(source, target))] == [4, 5]
    assert [r[0] for r in rows(newer_than(source, target, inclusive=True))] == [3, 4, 5]
    assert newer_than(source, empty).count() == 5
    # Appending what is newer twice adds nothing the second time.
    once = target.unionByName(newer_than(source, target))
    assert newer_than(source, once).count() == 0
    assert newer_than(source, once, inclusive=True).count() == 1


def test_latest_batch_and_high_water_mark(spark):
    source = spark.createDataFrame([(1, day(1)), (2, day(2)), (3, day(2))], DAYS)
    assert [r[0] for r in rows(latest_batch(source))] == [2, 3]
    assert latest_batch(source.limit(0)).count() == 0
    assert spark.range(1).select(high_water_mark(source).alias("m")).first().m == day(2)


def test_watermark_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "days")
    spark.createDataFrame([(i, day(i)) for i in range(1, 6)], DAYS).write.parquet(path)
    source = spark.read.parquet(path)
    plan = latest_batch(source)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(load_ts)" in plan


# --- enrichment --------------------------------------------------------------------

FACTS = "n int, product_id string, customer_id string"
JOINS = ["auto", "measured", "broadcast", "split"]


def dimensions(spark, join, **options):
    products = spark.createDataFrame(
        [("p1", "c1", 7), ("p2", None, 7)], "product_id string, category string, load_ts int"
    )
    customers = spark.createDataFrame(
        [("k1", "Kim", 7)], "customer_id string, customer_name string, load_ts int"
    )
    return [
        Dimension(products, "product_id", ["category"], ["category"], join=join, **options),
        Dimension(customers, "customer_id", ["customer_name"], join=join, **options),
    ]


@pytest.mark.parametrize("join", JOINS)
def test_every_fact_stays_once_whatever_the_join(spark, join):
    facts = spark.createDataFrame(
        [(1, "p1", "k1"), (2, "p2", "k1"), (3, "nope", "nope"), (4, None, None)], FACTS
    )
    assert rows(enrich(facts, dimensions(spark, join))) == [
        (1, "p1", "k1", "c1", "Kim"),
        (2, "p2", "k1", "unknown", "Kim"),
        (3, "nope", "nope", "unknown", None),
        (4, None, None, "unknown", None),
    ]


def hot_names(facts, key, share):
    return {row.key for row in hot_keys(facts, key, share).counts.collect()}


def test_a_split_join_of_skewed_facts_equals_a_plain_one(spark):
    chance = random.Random(1)
    keys = ["hot"] * 1000 + [f"k{chance.randrange(300)}" for _ in range(1500)] + [None] * 500
    facts = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "n int, product_id string")
    products = spark.createDataFrame(
        [("hot", "h")] + [(f"k{i}", f"c{i}") for i in range(0, 300, 2)],
        "product_id string, category string",
    )

    def joined(join):
        return enrich(
            facts, [Dimension(products, "product_id", ["category"], join=join, hot_share=0.1)]
        )

    assert hot_names(facts, "product_id", 0.1) == {"hot"}
    assert hot_keys(facts, "product_id", 0.1).missing == 500
    assert rows(joined("split")) == rows(joined("auto"))


def test_a_large_dimension_is_measured_and_not_broadcast(spark):
    facts = spark.createDataFrame([(1, "p1", "k1")], FACTS)
    large = enrich(facts, dimensions(spark, "measured", broadcast_limit=10, hot_share=1.0))
    small = enrich(facts, dimensions(spark, "measured"))
    plans = [frame._jdf.queryExecution().analyzed().toString() for frame in (large, small)]
    assert ["strategy=broadcast" in text for text in plans] == [False, True]
    assert rows(large) == rows(small) == [(1, "p1", "k1", "c1", "Kim")]
    size = measured_bytes(spark.createDataFrame([("ab", 1), (None, 22)], "a string, b int"))
    assert size == 2 * 32 + 2 + 1 + 2


@pytest.mark.parametrize("limit,hashed", [(100, True), (10, False)])
def test_a_measured_dimension_of_small_parts_leaves_the_facts_unsorted(spark, limit, hashed):
    keys = ["hot"] * 40 + [f"k{i % 9}" for i in range(30)] + [None] * 20
    facts = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "n int, product_id string")
    products = spark.createDataFrame([("hot", "h"), *((f"k{i}", f"c{i}") for i in range(5))], "product_id string, category string")

    def joined(hot_share, **options):
        return enrich(facts, [Dimension(products, "product_id", ["category"], hot_share=hot_share, **options)])

    for hot_share in (1.0, 0.2):
        measured = joined(hot_share, join="measured", broadcast_limit=limit)
        hints = measured._jdf.queryExecution().analyzed().toString()
        assert ("strategy=shuffle_hash" in hints) == hashed
        assert rows(measured) == rows(joined(hot_share, join="auto"))


def test_equal_names_are_refused(spark):
    facts = spark.createDataFrame([("p1", "x")], "product_id string, category string")
    with pytest.raises(ValueError):
        enrich(facts, dimensions(spark, "auto")[:1])


def test_hot_keys_are_bounded_by_the_share(spark):
    facts = spark.range(1000).select((F.col("id") % 10).alias("k"))
    assert hot_names(facts, "k", 0.09) == set(range(10))
    assert hot_names(facts, "k", 0.1) == set()
    assert hot_names(facts.limit(0), "k", 0.1) == set()


def test_every_key_above_the_share_is_found_among_many(spark):
    # Two hundred keys, each just above the share, among very many that come once.
    ids = F.col("id")
    key = F.when(ids % 4 == 0, F.concat(F.lit("h"), (ids / 4).cast("long") % 200)).otherwise(ids.cast("string"))
    facts = spark.range(0, 400_000, 1, 16).select(key.alias("k"))
    assert hot_names(facts, "k", 499 / 400_000) == {f"h{n}" for n in range(200)}
    assert hot_names(facts, "k", 500 / 400_000) == set()


def test_the_share_has_a_floor_whatever_the_partitions(spark):
    facts = spark.range(0, 100_000, 1, 8).select(F.when(F.col("id") < 9, -1).otherwise(F.col("id")).alias("k"))
    assert hot_names(facts, "k", 1 / 500_000) == {-1}


@pytest.mark.parametrize("limit", [1 << 20, 120, 1])
def test_rows_of_hot_keys_fit_the_limit(spark, limit):
    facts = spark.range(0, 900, 1, 4).select("id", (F.col("id") % 5).alias("k"))
    lookup = spark.range(0, 4).select(F.col("id").alias("k"), F.repeat(F.lit("x"), 20).alias("x"))
    joined = enrich(facts, [Dimension(lookup, "k", ["x"], join="split", hot_share=0.1, broadcast_limit=limit)])
    assert rows(joined) == [(k, k % 5, "x" * 20 if k % 5 < 4 else None) for k in sorted(range(900), key=lambda n: repr((n, n % 5)))]


@few
@given(st.lists(st.one_of(st.none(), st.integers(0, 6)), min_size=1, max_size=60))
def test_splitting_never_changes_the_result(spark, keys):
    facts = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "n int, k int")
    lookup = spark.createDataFrame([(k, f"x{k}") for k in range(4)], "k int, x string")

    def joined(join, share=0.5):
        return rows(enrich(facts, [Dimension(lookup, "k", ["x"], join=join, hot_share=share)]))

    held = {k: f"x{k}" for k in range(4)}
    expected = sorted(((i, k, held.get(k)) for i, k in enumerate(keys)), key=repr)
    assert joined("auto") == joined("split", 0.3) == joined("split", 0.05) == expected
