"""Land files through a file stream instead of the ledger.

The stream's checkpoint remembers each file by path, so late files are found
and nothing is listed against a ledger. It forgets those older than ``maxFileAge``
before the newest, and skips files that come later than that. A micro-batch takes
``maxFilesPerTrigger`` files at most; both are options of the loads below, passed on
to the reader. A micro-batch that failed is repeated with the same files under the
same number, and lands in the same partition. A path written again is not read
again; use the ledger for such folders.
"""

from __future__ import annotations

import hashlib
import operator
from collections.abc import Callable, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataline import fixed_values as fixed
from strataline.functions.values import snake_case
from strataline.operators.upsert import BucketedTable
from strataline.plans.flows import land, refine_orders, refine_products
from strataline.plans.lake import Lake
from strataline.sources.files import read_csv, read_json_elements, read_json_lines, stamp

ORDER_KEYS = ("row_id", "order_id")
MAX_FILE_AGE_INTERVAL = "90 days"
"""As long as a file stream remembers its files."""
_ALONE = "_alone"


def drain(
    stream: DataFrame,
    handle: Callable[[DataFrame, str], None],
    checkpoint: str,
    timeout: int | None = None,
) -> None:
    """Process all files that are there, then stop.

    ``handle`` gets each micro-batch and a name that is the same when the
    micro-batch is repeated and differs between checkpoints.
    """
    source = hashlib.sha256(checkpoint.encode()).hexdigest()[:8]

    def each(batch: DataFrame, number: int) -> None:
        handle(batch, f"stream-{source}-{number:010d}")

    query = (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    try:
        if not query.awaitTermination(timeout) and timeout is not None:
            raise TimeoutError(f"stream still running after {timeout} s")
    finally:
        query.stop()


def once_within(
    stream: DataFrame, keys: Sequence[str], delay: str = MAX_FILE_AGE_INTERVAL, time: str = fixed.LOAD_TS
) -> DataFrame:
    """The first row of each key, also over micro-batches and restarts.

    The stream's state holds every key for ``delay`` after its time at least, and lets go of
    it when a later run has passed that time by the delay again, so the delay bounds the
    state; a key that comes after that counts again. Rows that are older than the latest by
    more than the delay are dropped, so load times must not go back that far.
    Rows in which any key is missing, malformed ones among them, all stay.

    Choose ``spark.sql.shuffle.partitions`` before the first run: it fixes the number of
    parts of the state.
    """
    whole = reduce(operator.and_, (F.col(k).isNotNull() for k in keys))
    # A row without a key gets one that no other row has.
    alone = F.when(~whole, F.uuid())
    keyed = stream.withColumn(_ALONE, alone).withWatermark(time, delay)
    return keyed.dropDuplicatesWithinWatermark([*keys, _ALONE]).drop(_ALONE)


def land_stream(
    lake: Lake, flow: str, stream: DataFrame, checkpoint: str, timeout: int | None = None
) -> None:
    """Land a stamped stream; ``refine_products`` or ``refine_orders`` follow."""
    drain(stream, lambda batch, name: land(lake, flow, batch, name), checkpoint, timeout)


def load_products_stream(
    lake: Lake,
    folder: str,
    checkpoint: str,
    load_ts: datetime | None = None,
    timeout: int | None = None,
    **options: str,
) -> None:
    """Products from CSV files: land what is new, then merge it."""
    stream = stamp(read_csv(lake.spark, folder, stream=True, sourced=True, **options), load_ts)
    land_stream(lake, "products", stream, checkpoint, timeout)
    refine_products(lake)


def load_orders_stream(
    lake: Lake,
    folder: str,
    checkpoint: str,
    load_ts: datetime | None = None,
    lines: bool = False,
    timeout: int | None = None,
    once_by: Sequence[str] = (),
    **options: str,
) -> None:
    """Orders from JSON documents or lines: land what is new, then enrich it.

    With ``once_by`` (``ORDER_KEYS``, say) an order that comes in several files, a file
    written again under another name among them, lands once.
    """
    read_json = read_json_lines if lines else read_json_elements
    stream = stamp(snake_case(read_json(lake.spark, folder, stream=True, sourced=True, **options)), load_ts)
    if once_by:
        stream = once_within(stream, once_by)
    land_stream(lake, "orders", stream, checkpoint, timeout)
    refine_orders(lake)


def merge_stream(
    table: BucketedTable, stream: DataFrame, checkpoint: str, timeout: int | None = None
) -> None:
    """Upsert every micro-batch of a stream of versions into a keyed table."""

    def merge(batch: DataFrame, name: str) -> None:
        # A merge looks at its source twice; the files are read once.
        batch.persist()
        try:
            table.merge(batch, name)
        finally:
            batch.unpersist()

    drain(stream, merge, checkpoint, timeout)
