"""Left-join facts with dimensions, keeping every fact exactly once."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from strataline.functions.values import or_unknown

BROADCAST_LIMIT = 64 * 1024 * 1024
_ROW_OVERHEAD = 32

LEAST_SHARE = 1 / 16_384
"""No key with a smaller share of the facts is treated as hot: there would be too many to track."""
# A sketch of m keys is off by 3.5 / m of the facts at most, and returns the keys that it
# counts above that, so those above 7 / m are all among them.
_TRACKED_EACH = 7
_HOT = "_is_hot"


@dataclass(frozen=True)
class Dimension:
    """One row per ``key``; ``columns`` are added to the facts.

    ``fill_unknown`` names added columns in which NULL, whether from a miss or
    from the dimension itself, becomes the fixed word for it.

    ``join`` says how:

    * ``auto``: a plain left join. Spark broadcasts the dimension if its own
      size estimate is under the session's threshold, else shuffles, and
      adaptive execution splits skewed shuffle partitions.
    * ``measured``: the dimension's bytes are summed first (one aggregate over
      the needed columns). Within ``broadcast_limit`` it is broadcast, beyond
      it the join is split. If a shuffle partition of it is within the limit, tasks
      hold their part of the dimension as a hash table, so the facts are not sorted.
    * ``broadcast``: what ``measured`` comes to within the limit.
    * ``split``: keys with more facts than an even part of a shuffle partition are
      looked for first, by a sketch of bounded size and one exact count. Their
      dimension rows, which have to fit ``broadcast_limit`` as well, are broadcast to
      their facts; facts without a key need no row. Only the other facts are
      shuffled, and the dimension is not either, if it is a table bucketed by the key
      (``tables.overwrite_bucketed``). Without such keys it is a plain join.
      ``hot_share`` overrides what counts as hot.
    """

    rows: DataFrame
    key: str
    columns: Sequence[str]
    fill_unknown: Sequence[str] = ()
    join: str = "auto"
    broadcast_limit: int = BROADCAST_LIMIT
    hot_share: float | None = None
    size: int | None = None
    """Bytes, once measured."""


def measured_bytes(rows: DataFrame) -> int:
    """Bytes of the rows as text, plus a fixed overhead for each."""
    width = F.lit(_ROW_OVERHEAD)
    for name in rows.columns:
        width = width + F.coalesce(F.octet_length(F.col(name).cast("string")), F.lit(0))
    return rows.agg(F.sum(width.cast("bigint"))).first()[0] or 0


def resolved(dimension: Dimension) -> Dimension:
    """With ``measured`` replaced by what it comes to."""
    if dimension.join != "measured":
        return dimension
    size = measured_bytes(dimension.rows.select(dimension.key, *dimension.columns))
    return replace(dimension, join="broadcast" if size <= dimension.broadcast_limit else "split", size=size)


def _hashed(lookup: DataFrame, dimension: Dimension) -> DataFrame:
    """The lookup, to be held as a hash table in a shuffled join, if its parts are known to be small."""
    parts = int(lookup.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    small = dimension.size is not None and dimension.size <= parts * dimension.broadcast_limit
    return lookup.hint("shuffle_hash") if small else lookup


def is_broadcast(dimension: Dimension) -> bool:
    """Whether the join is sure to leave the facts where they are."""
    return dimension.join == "broadcast"


@dataclass(frozen=True)
class HotKeys:
    """The keys with many facts (``key``, ``n``), the facts without a key, and the number of all facts."""

    counts: DataFrame
    missing: int
    total: int


def hot_keys(facts: DataFrame, key: str, share: float) -> HotKeys:
    """The keys holding more than ``share`` of all facts.

    A share below ``LEAST_SHARE`` counts as that, so fewer than ``1 / LEAST_SHARE`` keys
    qualify, whatever the data and however many shuffle partitions there are. Neither
    pass shuffles by key: each task of the first keeps a heavy-hitter sketch of as many
    keys as finds every key above the share for certain, and the sketches are merged; the second
    counts just the candidates, exactly.
    """
    share = max(share, LEAST_SHARE)
    tracked = math.ceil(_TRACKED_EACH / share)
    keys = facts.select(F.col(key).alias("key"))
    sketch = F.expr(f"approx_top_k(key, {tracked}, {tracked}) FILTER (WHERE key IS NOT NULL)")
    total, present, found = keys.agg(F.count(F.lit(1)), F.count("key"), sketch).first()
    spark = facts.sparkSession
    schema = StructType([StructField("key", facts.schema[key].dataType), StructField("n", LongType())])
    # The sketch never counts too low and returns all keys it counts above what it may be off
    # by, so no key is missing among those it counts above the share.
    candidates = [(row.item, 0) for row in found if row["count"] > share * total]
    kept = []
    if candidates:
        named = F.broadcast(spark.createDataFrame(candidates, schema).select("key"))
        counts = keys.join(named, "key", "left_semi").groupBy("key").agg(F.count(F.lit(1)).alias("n"))
        kept = [(row.key, row.n) for row in counts.where(F.col("n") > share * total).collect()]
    hot = spark.createDataFrame(sorted(kept, key=lambda row: -row[1]), schema)
    return HotKeys(hot, total - present, total)


def even_share(facts: DataFrame) -> float:
    """An even part of a shuffle: more facts of one key than this make a partition uneven."""
    partitions = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return 1 / max(2, partitions)


def _rows_of_hot(lookup: DataFrame, key: str, hot: DataFrame, limit: int) -> tuple[DataFrame, DataFrame]:
    """The hot keys whose dimension rows together fit the limit, the most frequent first; and those rows."""
    while True:
        rows = lookup.join(F.broadcast(hot.select(F.col("key").alias(key))), key, "left_semi")
        if measured_bytes(rows) <= limit:
            return hot, rows
        hot = hot.sparkSession.createDataFrame(hot.take(hot.count() // 2), hot.schema)


def _split_join(facts: DataFrame, lookup: DataFrame, hot: DataFrame, dimension: Dimension) -> DataFrame:
    key = dimension.key
    hot, rows = _rows_of_hot(lookup, key, hot, dimension.broadcast_limit)
    named = F.broadcast(hot.select(F.col("key").alias(key), F.lit(True).alias(_HOT)))
    marked = facts.join(named, key, "left")
    # Facts without a key stay where they are too: the broadcast rows do not match them.
    stay = F.col(_HOT) | F.col(key).isNull()
    at_rest = marked.where(stay).drop(_HOT).join(F.broadcast(rows), key, "left")
    cold = lookup.join(named, key, "left_anti").where(F.col(key).isNotNull())
    moved = marked.where(F.col(_HOT).isNull() & F.col(key).isNotNull()).drop(_HOT)
    return at_rest.unionByName(moved.join(_hashed(cold, dimension), key, "left"))


def _join(
    facts: DataFrame, counted: DataFrame, lookup: DataFrame, dimension: Dimension
) -> DataFrame:
    dimension = resolved(dimension)
    how, key = dimension.join, dimension.key
    if how == "broadcast":
        return facts.join(F.broadcast(lookup), key, "left")
    if how == "split":
        share = dimension.hot_share or even_share(facts)
        hot = hot_keys(counted, key, share)
        if hot.counts.isEmpty() and hot.missing <= share * hot.total:
            return facts.join(_hashed(lookup, dimension), key, "left")
        return _split_join(facts, lookup, hot.counts, dimension)
    if how == "auto":
        return facts.join(lookup, key, "left")
    raise ValueError(f"unknown join {dimension.join!r}")


def enrich(facts: DataFrame, dimensions: Sequence[Dimension]) -> DataFrame:
    """Facts with the dimensions' columns added, in the order given.

    Each dimension is cut to its key and needed columns before its join, so
    equal names elsewhere (a load time, say) cannot clash. A miss leaves NULL.
    """
    given = facts
    for dimension in dimensions:
        clash = set(dimension.columns) & set(facts.columns)
        if clash:
            raise ValueError(f"facts already have {sorted(clash)}")
        lookup = dimension.rows.select(dimension.key, *dimension.columns)
        kept = facts.columns
        # Joins before this one neither add nor drop facts, so keys are counted
        # without running them, unless one of them has brought the key.
        counted = given if dimension.key in given.columns else facts
        joined = _join(facts, counted, lookup, dimension)
        added = [
            or_unknown(c).alias(c) if c in dimension.fill_unknown else F.col(c)
            for c in dimension.columns
        ]
        facts = joined.select(*kept, *added)
    return facts
