"""Merge a batch of new versions into a keyed table."""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataline import fixed_values as fixed
from strataline.operators.dedupe import latest_per_key_by_max
from strataline.operators.ledger import BatchMarks
from strataline.sources import tables

BUCKET = "bkt"


def merge_frames(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    version: str = fixed.LOAD_TS,
    update: Sequence[str] | None = None,
    null_safe: bool = False,
) -> DataFrame:
    """The target after an upsert from the source, as one full outer join.

    * key in both: the source row wins if its version is not older;
    * key in the source only: the source row is inserted;
    * key in the target only: the target row stays.

    ``update`` limits the columns replaced on a match (default: all). The
    source may hold several versions of a key; only its latest takes part.
    NULL keys match nothing unless ``null_safe``. Target keys must be unique.
    """
    columns = target.columns
    changed = set(columns if update is None else update)
    newest = latest_per_key_by_max(source.select(*columns), keys, [version])
    old = target.select(*(F.col(c).alias(f"t_{c}") for c in columns), F.lit(1).alias("t_has"))
    new = newest.select(*(F.col(c).alias(f"s_{c}") for c in columns), F.lit(1).alias("s_has"))

    matched = F.lit(True)
    for key in keys:
        left, right = F.col(f"t_{key}"), F.col(f"s_{key}")
        matched = matched & (left.eqNullSafe(right) if null_safe else left == right)

    inserted = F.col("t_has").isNull()
    updated = F.coalesce(F.col(f"s_{version}") >= F.col(f"t_{version}"), F.lit(False))

    def outcome(name: str) -> Column:
        takes_new = (inserted | updated) if name in changed else inserted
        return F.when(takes_new, F.col(f"s_{name}")).otherwise(F.col(f"t_{name}")).alias(name)

    return old.join(new, matched, "full_outer").select(*(outcome(c) for c in columns))


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


class BucketedTable:
    """A keyed parquet table, partitioned by a hash of its key.

    A merge reads only the buckets the batch has keys for, and writes their new content
    once, into a folder of its own: a *version*. Then the catalog's partitions are pointed
    there, one bucket after the other. So readers find each bucket whole at any time, old
    or new. Marks say which versions are written and which are published: a failure
    before the first mark leaves the table untouched, one after it is finished by
    ``recover``, which every merge runs first, by pointing again. One writer at a time.

    Where the catalog itself is lost, ``attach`` points each bucket to the latest
    published version that has it. Superseded folders stay, for queries that still read
    them, until ``clear_superseded``.

    Keys are unique, so a hash spreads them evenly whatever rows they had.
    Choose ``buckets`` so that one holds some hundred megabytes; it is fixed for
    the life of the table.
    """

    def __init__(
        self,
        spark: SparkSession,
        name: str,
        columns: str,
        keys: Sequence[str],
        marks: BatchMarks,
        version: str = fixed.LOAD_TS,
        update: Sequence[str] | None = None,
        null_safe: bool = False,
        buckets: int = 32,
        location: str | None = None,
    ):
        self.spark, self.name, self.columns = spark, name, columns
        self.keys, self.version, self.update = list(keys), version, update
        self.null_safe, self.buckets = null_safe, buckets
        self.marks, self.location = marks, location

    def create(self) -> None:
        columns = f"{self.columns}, {BUCKET} int"
        tables.create_table(self.spark, self.name, columns, self.location, [BUCKET])

    def drop(self) -> None:
        tables.drop_table(self.spark, self.name)

    def read(self) -> DataFrame:
        return tables.read(self.spark, self.name, hide=[BUCKET])

    def attach(self) -> None:
        """Point a newly created table to what was published under an earlier catalog."""
        steps = self._steps()
        current: dict[int, str] = {}
        found = self._written(sorted(steps["staged"] & steps["merged"]))
        for version in sorted(found):
            if version in steps["whole"]:
                current = {}
            current |= dict.fromkeys(found[version], version)
        self._point(current)

    def recover(self) -> None:
        """Publish versions that were written but not published to their end."""
        steps = self._steps()
        self._check_buckets(steps["buckets"])
        self._finish(steps)

    def _finish(self, steps: dict[str, set[str]]) -> None:
        for version in sorted(steps["staged"] - steps["merged"]):
            buckets = self._written([version]).get(version, [])
            self._publish(version, buckets, whole=version in steps["whole"])
            steps["merged"].add(version)

    def _steps(self) -> dict[str, set[str]]:
        """What has passed each step, in one look at the marks."""
        passed = defaultdict(set)
        for batch, step in self.marks.steps(self.name):
            passed[step].add(batch)
        return passed

    def _check_buckets(self, known: set[str]) -> None:
        # With another number a key's old row would be looked for in the wrong place.
        if not known:
            self.marks.add(self.name, [str(self.buckets)], "buckets")
        elif known != {str(self.buckets)}:
            raise ValueError(f"{self.name} was made with {min(known)} buckets, not {self.buckets}")

    def merge(self, source: DataFrame, token: str) -> None:
        """Upsert ``source``; a token that was merged before is not repeated."""
        steps = self._steps()
        self._check_buckets(steps["buckets"])
        self._finish(steps)
        version = _next_version(steps["staged"] | steps["merged"], token)
        if any(_token_of(done) == _token_of(version) for done in steps["merged"]):
            return
        bucket = bucket_of(self.keys, self.buckets)
        # At most ``buckets`` integers come back; they prune the target's scan.
        touched = [row[0] for row in source.select(bucket.alias(BUCKET)).distinct().collect()]
        if touched:
            target = self.spark.table(self.name).where(F.col(BUCKET).isin(touched)).drop(BUCKET)
            merged = merge_frames(
                target, source, self.keys, self.version, self.update, self.null_safe
            )
            self._stage(merged, version)
            self.marks.add(self.name, [version], "staged")
            self._publish(version, touched, whole=False)
        else:
            self.marks.add(self.name, [version], "merged")

    def rebuild(self, rows: DataFrame, token: str) -> None:
        """Replace the whole table by ``rows``, which must have unique keys."""
        steps = self._steps()
        self._check_buckets(steps["buckets"])
        self._finish(steps)
        version = _next_version(steps["staged"] | steps["merged"], token)
        self._stage(rows, version)
        self.marks.add(self.name, [version], "whole")
        self.marks.add(self.name, [version], "staged")
        self._publish(version, self._written([version]).get(version, []), whole=True)

    # --- versions -----------------------------------------------------------------

    def _folder(self) -> str:
        place = self.location or tables.location_of(self.spark, self.name)
        return f"{place}/{_VERSIONS}"

    def _stage(self, rows: DataFrame, version: str) -> None:
        placed = rows.withColumn(BUCKET, bucket_of(self.keys, self.buckets))
        # One bucket goes to as few files as its size allows: adaptive execution
        # splits a large bucket over tasks and packs small ones together.
        gathered = placed.hint("rebalance", F.col(BUCKET))
        gathered.write.mode("overwrite").partitionBy(BUCKET).parquet(f"{self._folder()}/{_VERSION}={version}")

    def _written(self, versions: list[str]) -> dict[str, list[int]]:
        """The buckets that these versions, whose folders are there, have; from the folders' names."""
        if not versions:
            return {}
        columns = f"{self.columns}, {_VERSION} string, {BUCKET} int"
        folder = self._folder()
        places = [f"{folder}/{_VERSION}={v}" for v in versions] if len(versions) == 1 else [folder]
        files = self.spark.read.schema(columns).option("basePath", folder).parquet(*places)
        found = files.where(F.col(_VERSION).isin(versions)).select(_VERSION, BUCKET).distinct().collect()
        buckets = defaultdict(list)
        for version, bucket in found:
            buckets[version].append(bucket)
        return buckets

    def _publish(self, version: str, buckets: list[int], whole: bool) -> None:
        self._point(dict.fromkeys(sorted(buckets), version))
        if whole:
            stale = tables.partitions(self.spark, self.name, BUCKET) - set(map(str, buckets))
            tables.forget_partitions(self.spark, self.name, BUCKET, sorted(stale))
        self.marks.add(self.name, [version], "merged")

    def _point(self, versions: dict[int, str]) -> None:
        folder = self._folder()
        places = {str(b): f"{folder}/{_VERSION}={v}/{BUCKET}={b}" for b, v in versions.items()}
        tables.point_partitions(self.spark, self.name, BUCKET, places)

    def clear_superseded(self) -> list[str]:
        """Delete the folders of published versions that no bucket points to any more; returns them.

        A query that began before the last merge may still read them: call it when there is none.
        """
        steps = self._steps()
        written = self._written(sorted(steps["staged"] & steps["merged"]))
        current = set(tables.partition_places(self.spark, self.name, BUCKET).values())
        folder, gone = self._folder(), []
        for version, buckets in written.items():
            for bucket in buckets:
                place = f"{_VERSION}={version}/{BUCKET}={bucket}"
                if not any(used.endswith(f"/{_VERSIONS}/{place}") for used in current):
                    tables.delete_folder(self.spark, f"{folder}/{place}")
                    gone.append(place)
        return sorted(gone)


_VERSIONS, _VERSION = "versions", "version_of"


def _next_version(known: set[str], token: str) -> str:
    """A name after all known ones, with a digest of the token behind the number."""
    number = 1 + max((int(name.split("-")[0]) for name in known), default=0)
    return f"{number:08d}-{hashlib.sha256(token.encode()).hexdigest()[:16]}"


def _token_of(version: str) -> str:
    return version.split("-")[1]
