"""Catalog tables and views: create, append, overwrite, drop."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructType


def create_schema(spark: SparkSession, name: str, location: str | None = None) -> None:
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}{at}")


def create_table(
    spark: SparkSession,
    name: str,
    columns: StructType | str,
    location: str | None = None,
    partitioned_by: Sequence[str] = (),
) -> None:
    """A parquet table; ``columns`` is a DDL string or a ``StructType``."""
    ddl = columns if isinstance(columns, str) else columns.toDDL()
    statement = f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet"
    if partitioned_by:
        # The mode belongs to the table: a writer's option is ignored when
        # writing into a table, and a session's setting is shared by its threads.
        statement += " OPTIONS (partitionOverwriteMode 'dynamic')"
        statement += f" PARTITIONED BY ({', '.join(partitioned_by)})"
    if location:
        statement += f" LOCATION '{location}'"
    spark.sql(statement)


def recover_partitions(spark: SparkSession, name: str) -> None:
    """Let a partitioned table take over what an earlier one left at its place."""
    # Writing no rows makes the folder, which the repair needs, if there is none.
    spark.table(name).limit(0).write.insertInto(name)
    spark.sql(f"MSCK REPAIR TABLE {name}")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def create_view(spark: SparkSession, name: str, query: str) -> None:
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {query}")


def drop_view(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP VIEW IF EXISTS {name}")


def read(spark: SparkSession, name: str, hide: Sequence[str] = ()) -> DataFrame:
    return spark.table(name).drop(*hide)


def _is_partitioned(spark: SparkSession, name: str) -> bool:
    lines = spark.sql(f"DESCRIBE TABLE {name}").collect()
    return any(line.col_name == "# Partition Information" for line in lines)


def _in_table_order(frame: DataFrame, name: str) -> DataFrame:
    wanted = frame.sparkSession.table(name).columns
    if set(wanted) != set(frame.columns):
        raise ValueError(
            f"{name} has columns {sorted(wanted)}, the frame has {sorted(frame.columns)}"
        )
    return frame.select(*wanted)


def append(frame: DataFrame, name: str) -> None:
    """Add rows; columns are matched by name, whatever their order."""
    _in_table_order(frame, name).write.insertInto(name)


def overwrite(frame: DataFrame, name: str) -> None:
    """Replace all rows of an unpartitioned table, which the frame must not read."""
    if _is_partitioned(frame.sparkSession, name):
        raise ValueError(f"{name} is partitioned: use replace_partitions and clear_partition")
    _in_table_order(frame, name).write.insertInto(name, overwrite=True)


def overwrite_bucketed(
    frame: DataFrame, name: str, key: str, buckets: int, location: str | None = None
) -> DataFrame:
    """The frame as a table whose files are dealt and sorted by a hash of ``key``; returns it.

    Spark knows the layout. A join on the key leaves such a table where it is and shuffles
    the other side only, and neither side if that has the same layout. Worth it for a
    large dimension that many loads meet. A bucket is read by one task, so frequent keys
    must not be among the rows: for facts, ``enrich`` with ``split`` sets those aside.
    """
    writer = frame.repartition(buckets, key).write.format("parquet").mode("overwrite")
    if location:
        writer = writer.option("path", location)
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    return frame.sparkSession.table(name)


def replace_partitions(frame: DataFrame, name: str) -> None:
    """Replace just the partitions the frame has rows for.

    Writing the same rows twice leaves them once, so a batch that owns its
    partition can be written again after a failure.
    """
    if not _is_partitioned(frame.sparkSession, name):
        raise ValueError(f"{name} has no partitions")
    _in_table_order(frame, name).write.insertInto(name, overwrite=True)


def clear_partition(spark: SparkSession, name: str, column: str, value: int | str) -> None:
    """Remove the rows of one partition, given by an integer or a plain word."""
    if isinstance(value, str):
        if not re.fullmatch(r"[\w.-]+", value):
            raise ValueError(f"{value!r} is no plain word")
        value = f"'{value}'"
    kept = [field for field in spark.table(name).schema if field.name != column]
    spark.sql(
        f"INSERT OVERWRITE TABLE {name} PARTITION ({column} = {value}) SELECT * FROM {{none}}",
        none=spark.createDataFrame([], StructType(kept)),
    )


# --- partitions at places of their own -------------------------------------------


def location_of(spark: SparkSession, name: str) -> str:
    lines = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    return next(line.data_type for line in lines if line.col_name == "Location")


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def partitions(spark: SparkSession, name: str, column: str) -> set[str]:
    """The values of the only partition column, as text."""
    found = spark.sql(f"SHOW PARTITIONS {name}").collect()
    return {row.partition.removeprefix(f"{column}=") for row in found}


def partition_places(spark: SparkSession, name: str, column: str) -> dict[str, str]:
    """Where the catalog says each partition lies."""
    places = {}
    for value in partitions(spark, name, column):
        lines = spark.sql(f"DESCRIBE TABLE EXTENDED {name} PARTITION ({column} = {value})").collect()
        places[value] = next(line.data_type for line in lines if line.col_name == "Location")
    return places


def point_partitions(spark: SparkSession, name: str, column: str, places: dict[str, str]) -> None:
    """Let partitions (by an integer) lie at these folders; each changes at once, none is ever absent."""
    known = partitions(spark, name, column)
    new = {value: place for value, place in places.items() if value not in known}
    if new:
        parts = " ".join(f"PARTITION ({column} = {v}) LOCATION {_literal(p)}" for v, p in new.items())
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {parts}")
    for value, place in places.items():
        if value in known:
            spark.sql(f"ALTER TABLE {name} PARTITION ({column} = {value}) SET LOCATION {_literal(place)}")


def forget_partitions(spark: SparkSession, name: str, column: str, values: Sequence[str]) -> None:
    """Take partitions out of an external table's catalog entry; their files stay."""
    if values:
        is_text = isinstance(spark.table(name).schema[column].dataType, StringType)
        written = [_literal(value) if is_text else value for value in values]
        parts = ", ".join(f"PARTITION ({column} = {value})" for value in written)
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {parts}")


def delete_folder(spark: SparkSession, place: str) -> None:
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(place)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
