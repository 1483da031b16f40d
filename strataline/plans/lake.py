"""The tables of the three layers, under names and a folder of your choice."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataline import fixed_values as fixed
from strataline.operators.ledger import BatchMarks, FileLedger
from strataline.operators.upsert import BucketedTable
from strataline.plans.gold import STORED_KPI, kpi_of_stored, kpi_view_query
from strataline.sources import tables
from strataline.sources.files import FILE, FILE_COLUMNS

BATCH = "batch"

_BRONZE = {
    fixed.CUSTOMERS_TABLE: fixed.BRONZE_CUSTOMERS,
    fixed.PRODUCTS_TABLE: fixed.BRONZE_PRODUCTS,
    fixed.ORDERS_TABLE: fixed.BRONZE_ORDERS,
}


# The step of a batch that readers may see, as in ``flows``.
REFINED = "refined"

_FILE_FEEDS = (fixed.PRODUCTS_TABLE, fixed.ORDERS_TABLE)
SINCE = "since_batch"
KPI_FLOW = "kpi"


def batch_name(load_ts: datetime) -> str:
    """A batch's partition value: its load time in UTC, in sortable form."""
    if load_ts.tzinfo is None:
        raise ValueError("load_ts needs a time zone")
    return load_ts.astimezone(timezone.utc).strftime("%Y%m%dT%H%M%S%fZ")


def load_time(batch: str) -> datetime:
    """The load time a batch is named after."""
    moment = datetime.strptime(batch.split("-", 1)[0], "%Y%m%dT%H%M%S%fZ")
    return moment.replace(tzinfo=timezone.utc)


class Lake:
    """Bronze, silver facts and the KPI are partitioned by batch, silver keyed tables
    by a hash of the key. Service columns stay out of what is read.

    ``prefix`` goes before the schema names ``bronze``, ``silver`` and ``gold``.

    With ``latest_versions`` a path that is written again replaces its orders: those of
    the version with the latest load time count, in the orders, the KPI and the view, from the
    moment its batch is refined. Without, the orders of all versions count.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        prefix: str = "",
        buckets: int = 32,
        latest_versions: bool = False,
    ):
        self.spark, self.root, self.latest_versions = spark, root.rstrip("/"), latest_versions
        layers = (fixed.BRONZE, fixed.SILVER, fixed.GOLD)
        self.schemas = [f"{prefix}{layer}" for layer in layers]
        bronze, silver, gold = self.schemas
        self.bronze = {flow: f"{bronze}.{flow}" for flow in _BRONZE}
        self.order_enrich = f"{silver}.{fixed.SILVER_ORDERS_TABLE}"
        self.kpi_view = f"{gold}.{fixed.KPI_VIEW}"
        self.kpi_table = f"{gold}.kpi_totals"
        self.superseded = f"{bronze}.superseded_files"
        marks, files = f"{bronze}.batch_marks", f"{bronze}.{fixed.FILES_TABLE}"
        self.marks = BatchMarks(spark, marks, self._place(marks))
        self.files = FileLedger(spark, files, self._place(files))
        self.products = self._keyed(
            f"{silver}.{fixed.SILVER_PRODUCTS_TABLE}", fixed.SILVER_PRODUCTS, "product_id", buckets
        )
        self.customers = self._keyed(
            f"{silver}.{fixed.CUSTOMERS_TABLE}",
            fixed.SILVER_CUSTOMERS,
            "customer_id",
            buckets,
            null_safe=True,
        )

    def _keyed(self, name: str, columns: str, key: str, buckets: int, null_safe: bool = False):
        return BucketedTable(
            self.spark,
            name,
            columns,
            [key],
            self.marks,
            null_safe=null_safe,
            buckets=buckets,
            location=self._place(name),
        )

    def _place(self, table: str) -> str:
        return f"{self.root}/{table.replace('.', '/')}"

    def create(self) -> Lake:
        """Create what the catalog does not have yet."""
        for schema in self.schemas:
            tables.create_schema(self.spark, schema, f"{self.root}/{schema}")
        for flow, columns in _BRONZE.items():
            files = f", {FILE_COLUMNS}" if flow in _FILE_FEEDS else ""
            self._create(self.bronze[flow], f"{columns}{files}, {BATCH} string", [BATCH])
        self._create(self.order_enrich, f"{fixed.SILVER_ORDERS}, {FILE} string, {BATCH} string", [BATCH])
        self._create(self.kpi_table, f"{STORED_KPI}, {BATCH} string", [BATCH])
        self._create(self.superseded, f"{FILE} string, {BATCH} string, {SINCE} string", [SINCE])
        for part in (self.marks, self.files, self.products, self.customers):
            part.create()
        tables.create_view(self.spark, self.kpi_view, kpi_view_query(self._orders_query()))
        return self

    def _orders_query(self) -> str:
        """What readers of the orders see: the table, or what is refined and not superseded in it."""
        if not self.latest_versions:
            return self.order_enrich
        refined = f"SELECT batch FROM {self.marks.name} WHERE flow = 'orders' AND step = '{REFINED}'"
        gone = f"SELECT {FILE}, {BATCH} FROM {self.superseded} WHERE {SINCE} IN ({refined})"
        return (
            f"(SELECT * FROM {self.order_enrich} o LEFT SEMI JOIN ({refined}) r ON o.{BATCH} = r.batch "
            f"LEFT ANTI JOIN ({gone}) g ON o.{FILE} = g.{FILE} AND o.{BATCH} = g.{BATCH})"
        )

    def attach(self) -> Lake:
        """Create the tables in a new catalog over the data of an earlier one."""
        self.create()
        by_batch = [*self.bronze.values(), self.order_enrich, self.kpi_table, self.superseded]
        for name in [*by_batch, self.marks.name, self.files.name]:
            tables.recover_partitions(self.spark, name)
        for keyed in (self.products, self.customers):
            keyed.attach()
        return self

    def _create(self, name: str, columns: str, partitioned_by: list[str]) -> None:
        tables.create_table(self.spark, name, columns, self._place(name), partitioned_by)

    def drop(self) -> None:
        """Forget all tables and the view. Their files stay where they are."""
        tables.drop_view(self.spark, self.kpi_view)
        for part in (self.products, self.customers):
            part.drop()
        names = [*self.bronze.values(), self.order_enrich, self.kpi_table, self.superseded]
        for name in [*names, self.marks.name, self.files.name]:
            tables.drop_table(self.spark, name)

    def raw(self, flow: str, batches: list[str] | None = None) -> DataFrame:
        """Bronze rows of a flow, of some batches (pruned by partition) or all."""
        rows = self.spark.table(self.bronze[flow])
        return rows if batches is None else rows.where(F.col(BATCH).isin(batches))

    def compact(self) -> None:
        """Merge the small files of marks and ledger. No load may be running."""
        self.marks.compact()
        self.files.compact()

    def orders(self) -> DataFrame:
        found = self.spark.sql(f"SELECT * FROM {self._orders_query()}")
        return found.drop(BATCH, FILE)

    def landed(self, flow: str) -> DataFrame:
        """Bronze rows of the batches that were landed to their end."""
        return self.raw(flow).join(self.marks.reached(flow, "landed"), BATCH, "left_semi")

    def kpi_parts(self) -> list[str]:
        """The partitions of the stored KPI that count: published batches and folds, but those folded."""
        orders, folds = self.marks.steps("orders"), self.marks.steps(KPI_FLOW)
        made = {batch for batch, step in orders if step == "published"} | {b for b, step in folds if step == "made"}
        return sorted(made - {batch for batch, step in folds if step == "folded"})

    def kpis(self) -> DataFrame:
        """The stored KPI, summed over batches."""
        stored = self.spark.table(self.kpi_table).where(F.col(BATCH).isin(self.kpi_parts()))
        return kpi_of_stored(stored)

    def quarantined(self, flow: str) -> DataFrame:
        """Malformed rows of a flow, raw text or reason included."""
        return self.landed(flow).where(F.col(fixed.CORRUPT).isNotNull()).drop(BATCH)
