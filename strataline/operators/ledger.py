"""What has been done: processed files, and the steps each batch has passed."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataline import fixed_values as fixed
from strataline.sources import tables


PART = "part"


class Log:
    """A table that is only added to, a small file for each addition.

    Its readers do not mind a row being there twice. So ``compact`` may copy all
    rows to a new partition first and clear the old ones after that: a failure
    in between leaves copies and loses nothing. One writer at a time.
    """

    COLUMNS: str

    def __init__(self, spark: SparkSession, name: str, location: str | None = None):
        self.spark, self.name, self.location = spark, name, location

    def create(self) -> None:
        columns = f"{self.COLUMNS}, {PART} int"
        tables.create_table(self.spark, self.name, columns, self.location, [PART])

    def rows(self) -> DataFrame:
        return tables.read(self.spark, self.name, hide=[PART])

    def append(self, rows: DataFrame) -> None:
        # As few files as the rows fill, made by as many tasks as there were.
        tables.append(rows.withColumn(PART, F.lit(0)).hint("rebalance"), self.name)

    def compact(self) -> None:
        """Bring the rows of all additions so far into as few files as they fill."""
        found = self.spark.table(self.name).select(PART).distinct().collect()
        old = [row[0] for row in found]
        if old:
            target = F.lit(max(old) + 1)
            everything = self.rows().distinct().withColumn(PART, target)
            tables.replace_partitions(everything.hint("rebalance", F.col(PART)), self.name)
            for part in old:
                tables.clear_partition(self.spark, self.name, PART, part)


class BatchMarks(Log):
    """One row per (flow, batch, step) that finished.

    A mark is written only after the step's data. So a step without a mark may
    have been done in part and is done again; every step is written so that
    doing it again changes nothing.
    """

    COLUMNS = "flow string, batch string, step string, n_rows bigint, n_malformed bigint"

    def add(
        self,
        flow: str,
        batches: Sequence[str],
        step: str,
        counts: tuple[int, int] | None = None,
        also: Sequence[tuple[Sequence[str], str]] = (),
    ) -> None:
        """Mark batches; ``counts`` are the batch's rows and malformed rows. ``also`` adds
        (batches, step) in the same write, so that readers see all of it or nothing."""
        marks = [(batch, step) for batch in batches]
        marks += [(batch, other) for more, other in also for batch in more]
        if marks:
            n_rows, n_malformed = counts or (None, None)
            pairs = F.array(*(F.struct(F.lit(b).alias("batch"), F.lit(s).alias("step")) for b, s in marks))
            one_row = self.spark.range(0, 1, numPartitions=1)
            rows = one_row.select(F.lit(flow).alias("flow"), F.inline(pairs)).withColumns(
                {"n_rows": F.lit(n_rows).cast("bigint"), "n_malformed": F.lit(n_malformed).cast("bigint")}
            )
            self.append(rows)

    def counts(self, flow: str, step: str) -> DataFrame:
        """(``batch``, ``n_rows``, ``n_malformed``) of the batches that passed a step."""
        return self._of(flow).where(F.col("step") == step).select("batch", "n_rows", "n_malformed").distinct()

    def _of(self, flow: str) -> DataFrame:
        return self.rows().where(F.col("flow") == flow)

    def steps(self, flow: str) -> set[tuple[str, str]]:
        """All (batch, step) of a flow, in one look and without a shuffle."""
        return {tuple(row) for row in self._of(flow).select("batch", "step").collect()}


    def reached(self, flow: str, step: str) -> DataFrame:
        """The batches (column ``batch``) that passed a step."""
        return self._of(flow).where(F.col("step") == step).select("batch").distinct()

    def passed(self, flow: str, step: str) -> list[str]:
        return sorted(batch for batch, reached in self.steps(flow) if reached == step)

    def pending(self, flow: str, after: str, before: str) -> list[str]:
        """Names of batches that passed ``after`` but not yet ``before``."""
        steps = self.steps(flow)
        return sorted(batch for batch, step in steps if step == after and (batch, before) not in steps)


def list_files(spark: SparkSession, folder: str | Sequence[str], glob: str = "*") -> DataFrame:
    """(file_path, modification_time) below a folder, or several; contents are not read.

    Spark lists with several tasks, but keeps the names and sizes of all files found in the
    driver. Where files stay for long, give the folders that may still get some (``dated_folders``).
    """
    folders = [folder] if isinstance(folder, str) else list(folder)
    if not folders:
        return spark.createDataFrame([], "file_path string, modification_time timestamp")
    found = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(folders)
    )
    return found.select(
        F.col("path").alias("file_path"), F.col("modificationTime").alias("modification_time")
    )


def dated_folders(spark: SparkSession, root: str, since: date) -> list[str]:
    """The folders directly below ``root`` that are named after a day (``2024-03-01``, ``day=2024-03-01``)
    from ``since`` on; none of their files is looked at."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(root)
    names = []
    for status in path.getFileSystem(context._jsc.hadoopConfiguration()).listStatus(path):
        name = status.getPath().getName()
        found = re.fullmatch(r"(?:[^=]*=)?(\d{4}-\d{2}-\d{2})", name)
        if status.isDirectory() and found and date.fromisoformat(found[1]) >= since:
            names.append(f"{root.rstrip('/')}/{name}")
    return sorted(names)


class FileLedger(Log):
    """The processed files of each object, one row per file version and batch.

    Files are entered *before* they are loaded, as the plan of a batch: after a
    failure the same batch is loaded again from the same files.
    """

    COLUMNS = f"{fixed.PROCESSED_FILES}, batch string"

    def entries(self, obj: str) -> DataFrame:
        return self.rows().where(F.col("object") == obj)

    def unseen(self, files: DataFrame, obj: str) -> DataFrame:
        """Files whose path and time are not in the ledger.

        A file that arrives late with an old time is found, and so is a path
        written again.
        """
        return files.join(self.entries(obj), ["file_path", "modification_time"], "left_anti")

    def modified_since(self, files: DataFrame, obj: str) -> DataFrame:
        """Files newer than every file in the ledger; all, if it has none.

        Cheaper to keep than ``unseen`` but blind to late files.
        """
        newest = self.entries(obj).agg(F.max("modification_time")).scalar()
        return files.where(newest.isNull() | (F.col("modification_time") > newest))

    def plan(self, files: DataFrame, obj: str, batch: str, files_per_batch: int | None = None) -> list[str]:
        """Enter files as the content of a batch; returns the batches. No files: no batch.

        With a limit, files are dealt by a hash into parts of about as many files,
        each a batch of its own, named by the part's number.
        """
        rows = files.select("file_path", F.lit(obj).alias("object"), "modification_time")
        count = rows.count()
        if not count:
            return []
        if files_per_batch is None:
            self.append(rows.withColumn("batch", F.lit(batch)))
            return [batch]
        parts = -(-count // files_per_batch)
        part = F.pmod(F.xxhash64("file_path", "modification_time"), F.lit(parts))
        name = F.concat(F.lit(f"{batch}-"), F.lpad(part.cast("string"), 6, "0"))
        self.append(rows.withColumn("batch", name))
        planned = self.entries(obj).where(F.startswith("batch", F.lit(f"{batch}-")))
        return sorted(row.batch for row in planned.select("batch").distinct().collect())

    def unfinished(self, obj: str, done: DataFrame) -> list[str]:
        """Planned batches that are not among ``done`` (column ``batch``)."""
        left = self.entries(obj).select("batch").distinct().join(done, "batch", "left_anti")
        return sorted(row.batch for row in left.collect())

    def unused_name(self, obj: str, batch: str) -> str:
        """The name, with a number if batches of this name were planned before."""
        taken = self.entries(obj).select(F.split_part("batch", F.lit("-"), F.lit(1)).alias("name"), "batch")
        runs = F.count_distinct(F.split_part(F.col("batch"), F.lit("-"), F.lit(-2)))
        before = taken.where(F.col("name") == batch).agg(runs).first()[0]
        return f"{batch}-{before:03d}"

    def paths(self, obj: str, batch: str, present: DataFrame | None = None) -> list[str]:
        """File names of one batch, for the reader. ``plan`` bounds how many.

        Given a listing, files that are gone or were written again since they
        were planned are left out; the latter belong to a new batch.
        """
        files = self.entries(obj).where(F.col("batch") == batch)
        if present is not None:
            files = files.join(present, ["file_path", "modification_time"], "left_semi")
        return sorted(row.file_path for row in files.select("file_path").distinct().collect())
