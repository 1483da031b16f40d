"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Adaptive execution is what copes with sizes nobody knew up front: it merges
# small shuffle partitions, splits skewed ones and turns a sort-merge join into
# a broadcast join once the measured side is small enough.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Beyond 2,000 shuffle partitions map tasks report average block sizes, which
    # hides a skewed one from adaptive execution; this keeps such blocks exact.
    "spark.shuffle.accurateBlockSkewedFactor": "5",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    # Rows are larger in memory than in their files. Size estimates, which decide
    # on broadcasts, have to allow for it.
    "spark.sql.sources.fileCompressionFactor": "3.0",
    # Keys that streams remember lie on disk, not on the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.ui.enabled": "false",
}

_local_scratch: dict[str, str] = {}
_given: dict[str, list[str]] = {}


def session(app: str = "strataline", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above; ``extra`` adds or overrides."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    Only a local master, which has no other machine, may go without the
    setting; it then gets a temporary folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not re.match(r"local(\[|$)", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    if context.applicationId not in _local_scratch:
        _local_scratch[context.applicationId] = tempfile.mkdtemp(prefix="strataline-")
    return _local_scratch[context.applicationId]


def scratch(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder, known to ``clear_scratch``."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex[:12]}"
    _given.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def clear_scratch(spark: SparkSession) -> list[str]:
    """Delete what this application has put into its scratch paths; returns those that were there.

    Call it when nothing is read any more that was made with them, results included.
    """
    context, gone = spark.sparkContext, []
    for path in _given.pop(context.applicationId, []):
        place = context._jvm.org.apache.hadoop.fs.Path(path)
        if place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True):
            gone.append(path)
    return gone
