"""Feeds derived from the driver's tables, always from all their rows.

Faults are planted by an attribute of the row (its type, status or size), so
every row takes part and the SQL can say which ones must be affected.
"""

from __future__ import annotations

import gzip
import io
import sys
import uuid
import zipfile
from collections.abc import Iterable
from pathlib import Path
from xml.sax.saxutils import escape

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataline.session import scratch

# About half a megabyte of JSON.
ORDERS_PER_DOCUMENT = 2_000
CUSTOMERS_PER_WORKBOOK = 5_000

# About twenty megabytes of JSON: a compressed file is read by one task, which takes several.
SALES_PER_FILE = 100_000

CSV_HEADER = "id,kind,sort,title,where,cost"

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def new_prefix() -> str:
    return f"t{uuid.uuid4().hex[:10]}_"


def sales(spark: SparkSession, sf: str) -> DataFrame:
    """Order facts: one row per line item, with exact profit.

    Both sides grow with the data, so neither is ever broadcast. Price and
    discount travel through the join; the decimal is made after it.
    """
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice", "l_discount", "l_returnflag"
    )
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    discount = F.col("l_discount").cast("decimal(4,2)")
    return lines.join(
        orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey")
    ).select(
        F.col("l_linenumber").alias("row_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("o_orderdate").alias("order_date"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("product_id"),
        F.round(price * (1 - discount), 2).alias("profit"),
        (F.col("l_returnflag") == "R").alias("returned"),
    )


def products(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("sub_category"),
        F.col("p_size").alias("size"),
    )


def customers(spark: SparkSession, sf: str) -> DataFrame:
    nations = table(spark, sf, "nation").select("n_nationkey", "n_name")
    return (
        table(spark, sf, "customer")
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            F.col("n_name").alias("country"),
            F.col("c_mktsegment").alias("segment"),
            F.col("c_acctbal").alias("balance"),
            F.col("c_nationkey").alias("nation"),
        )
    )


def dirty_customers(spark: SparkSession, sf: str, balance_below: float | None = None) -> DataFrame:
    """Customers, all or the poorer ones, whose name, email and phone need every cleaning rule.

    Customers in debt have a phone number that is too short.
    """
    key, nation = F.col("customer_id"), F.col("nation")
    long_phone = F.format_string(
        "+%d / %d-%d (ext. %d)", nation + 100, key % 800 + 200, key % 9000 + 1000, nation
    )
    everyone = customers(spark, sf)
    chosen = everyone if balance_below is None else everyone.where(F.col("balance") < balance_below)
    return chosen.select(
        key.cast("string").alias("customer_id"),
        F.concat(
            "segment", F.lit(" ~{2}  "), "country", F.lit("_#7 "), "customer_name"
        ).alias("customer_name"),
        F.concat(
            F.lit(" "), F.lower("segment"), F.lit("."), key, F.lit("+news<1>@mail. shop-4.org,")
        ).alias("email"),
        F.when(F.col("balance") < 0, F.format_string("~/%d", key % 800 + 200))
        .otherwise(long_phone)
        .alias("phone"),
        F.format_string("%d Main Street", key).alias("address"),
        "segment",
        "country",
        F.lit(None).cast("string").alias("city"),
        F.lit(None).cast("string").alias("state"),
        nation.cast("string").alias("postal"),
        F.lit("all").alias("region"),
    )


def write_product_csv(
    spark: SparkSession, sf: str, changed: tuple[str, ...] = (), folder: str | None = None
) -> str:
    """Parts as CSV. PROMO has a token too many, size 50 one too few.

    ``changed`` are the brands to deliver, under another category, all if none.
    """
    kind = F.concat(F.lit("new "), "p_type") if changed else F.col("p_type")
    parts = table(spark, sf, "part")
    parts = parts.where(F.col("p_brand").isin(*changed)) if changed else parts
    fields = [
        F.col("p_partkey").alias("id"),
        kind.alias("category"),
        F.col("p_brand").alias("sub_category"),
        F.col("p_name").alias("name"),
        F.concat(F.lit("S"), F.col("p_size")).alias("state"),
    ]
    price = F.col("p_retailprice").alias("price")
    full = F.to_csv(F.struct(*fields, price))
    line = (
        F.when(F.col("p_type") == "PROMO", F.concat(full, F.lit(",left over")))
        .when(F.col("p_size") == 50, F.to_csv(F.struct(*fields)))
        .otherwise(full)
    )
    folder = folder or scratch(spark, "products-csv")
    # One raw line per row: separator and quote are characters no line contains.
    parts.select(line.alias(CSV_HEADER)).write.mode("append").csv(
        folder, header=True, sep="\u0001", quote="\u0000"
    )
    return folder


def order_objects(spark: SparkSession, sf: str) -> DataFrame:
    """Orders under the feed's spaced names, as a struct column ``order``."""
    day = F.date_format("o_orderdate", "d/M/yyyy")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        "o_orderstatus",
        F.struct(
            F.col("o_orderkey").alias("Row ID"),
            F.concat(F.lit("O-"), "o_orderkey").alias("Order ID"),
            day.alias("Order Date"),
            day.alias("Ship Date"),
            F.col("o_orderpriority").alias("Ship Mode"),
            F.col("o_custkey").cast("string").alias("Customer ID"),
            F.col("o_orderstatus").alias("Product ID"),
            F.lit(1).alias("Quantity"),
            F.col("o_totalprice").alias("Price"),
            F.lit(0.0).alias("Discount"),
            F.col("o_totalprice").alias("Profit"),
        ).alias("order"),
    )


def write_order_documents(spark: SparkSession, sf: str) -> str:
    """Orders as one JSON array per file. A document with more orders of status
    P than of status F is broken.

    A document holds a fixed range of keys, so its size is bounded and only the
    number of documents grows with the data.
    """
    document = F.floor(F.col("o_orderkey") / ORDERS_PER_DOCUMENT).alias("document")
    body = F.array_join(F.sort_array(F.collect_list(F.to_json("order"))), ",\n")
    status = F.col("o_orderstatus")
    broken = F.count_if(status == "P") > F.count_if(status == "F")
    end = F.when(broken, F.lit(",,\n]")).otherwise(F.lit("\n]"))
    text = F.concat(F.lit("[\n"), body, end).alias("value")
    folder = scratch(spark, "order-documents")
    documents = order_objects(spark, sf).groupBy(document).agg(text)
    documents.write.partitionBy("document").text(folder)
    return folder


def write_order_documents_with_faults(spark: SparkSession, sf: str) -> str:
    """Orders as one JSON array per file, each of a fixed range of keys. Those of status P have
    a text where a number goes."""
    document = F.floor(F.col("o_orderkey") / ORDERS_PER_DOCUMENT).alias("document")
    bad = F.to_json(F.col("order").withField("Price", F.lit("n/a")))
    element = F.when(F.col("o_orderstatus") == "P", bad).otherwise(F.to_json("order"))
    text = F.concat(F.lit("["), F.array_join(F.sort_array(F.collect_list(element)), ",\n"), F.lit("]"))
    folder = scratch(spark, "order-documents")
    documents = order_objects(spark, sf).groupBy(document).agg(text.alias("value"))
    documents.write.partitionBy("document").text(folder)
    return folder


def write_order_lines(spark: SparkSession, sf: str) -> str:
    """Orders as JSON lines; those of status P have a text where a number goes."""
    good = F.to_json("order")
    bad = F.to_json(F.col("order").withField("Price", F.lit("n/a")))
    folder = scratch(spark, "order-lines")
    order_objects(spark, sf).select(
        F.when(F.col("o_orderstatus") == "P", bad).otherwise(good).alias("value")
    ).write.text(folder)
    return folder


def write_sales_lines(
    spark: SparkSession, sf: str, which: Column | None = None, folder: str | None = None
) -> str:
    """Sales, all or some, as JSON lines under the feed's names, profit to the cent.

    The names make each line long, and the files are compressed: they take a sixth of the text.
    """
    day = F.date_format("order_date", "d/M/yyyy")
    folder = folder or scratch(spark, "sales-lines")
    sold = sales(spark, sf)
    (sold if which is None else sold.where(which)).select(
        F.col("row_id").alias("Row ID"),
        F.col("order_id").cast("string").alias("Order ID"),
        day.alias("Order Date"),
        day.alias("Ship Date"),
        F.lit("Standard").alias("Ship Mode"),
        F.col("customer_id").cast("string").alias("Customer ID"),
        F.col("product_id").cast("string").alias("Product ID"),
        F.lit(1).alias("Quantity"),
        F.col("profit").cast("double").alias("Price"),
        F.lit(0.0).alias("Discount"),
        F.col("profit").cast("double").alias("Profit"),
    ).write.mode("append").option("maxRecordsPerFile", SALES_PER_FILE).json(folder, compression="lz4")
    return folder


def write_sales_files(spark: SparkSession, sf: str, folder: str, which: Column | None = None) -> str:
    """Sales, all or some, as a compressed file of JSON lines for each range of order keys, under the
    range's name: a file that is there is written again.

    As with workbooks, the tasks write through the file system that holds the shared folder.
    """
    place = folder.removeprefix("file://").removeprefix("file:")
    if "://" in place:
        raise ValueError(f"cannot write single files below {folder}")
    Path(place).mkdir(parents=True, exist_ok=True)
    day = F.date_format("order_date", "d/M/yyyy")
    sold = sales(spark, sf)
    line = F.to_json(
        F.struct(
            F.col("row_id").alias("Row ID"),
            F.col("order_id").cast("string").alias("Order ID"),
            day.alias("Order Date"),
            F.col("customer_id").cast("string").alias("Customer ID"),
            F.col("product_id").cast("string").alias("Product ID"),
            F.col("profit").cast("double").alias("Profit"),
        )
    )
    chosen = (sold if which is None else sold.where(which)).select(
        F.floor(F.col("order_id") / ORDERS_PER_DOCUMENT).alias("range"), line.alias("line")
    )

    def put(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        text = "\n".join(group["line"]) + "\n"
        Path(f"{place}/{key[0]}.json.gz").write_bytes(gzip.compress(text.encode(), 1))
        return pd.DataFrame({"range": [key[0]]})

    chosen.groupBy("range").applyInPandas(put, "range bigint").write.format("noop").mode("overwrite").save()
    return folder


# --- workbooks -----------------------------------------------------------------

_PARTS = {
    "xl/workbook.xml": (
        '<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" '
        'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships">'
        '<sheets><sheet name="Data" sheetId="1" r:id="rId1"/></sheets></workbook>'
    ),
    "xl/_rels/workbook.xml.rels": (
        '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
        '<Relationship Id="rId1" Target="worksheets/sheet1.xml" Type="http://schemas.'
        'openxmlformats.org/officeDocument/2006/relationships/worksheet"/></Relationships>'
    ),
}


def workbook(header: list[str], rows: Iterable[Iterable[str | None]], shared: bool = False) -> bytes:
    """A minimal xlsx file of text cells, inline or in the shared table."""
    strings: dict[str, int] = {}

    def cell(column: int, row: int, text: str) -> str:
        place = f"{chr(ord('A') + column)}{row}"
        if shared:
            return f'<c r="{place}" t="s"><v>{strings.setdefault(text, len(strings))}</v></c>'
        return f'<c r="{place}" t="inlineStr"><is><t>{escape(text)}</t></is></c>'

    lines = []
    for number, values in enumerate([header, *rows], 1):
        cells = (cell(i, number, v) for i, v in enumerate(values) if v is not None)
        lines.append(f'<row r="{number}">{"".join(cells)}</row>')
    namespace = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    parts = dict(_PARTS)
    parts["xl/worksheets/sheet1.xml"] = (
        f"<worksheet {namespace}><sheetData>{''.join(lines)}</sheetData></worksheet>"
    )
    if shared:
        items = "".join(f"<si><t>{escape(text)}</t></si>" for text in strings)
        parts["xl/sharedStrings.xml"] = f"<sst {namespace}>{items}</sst>"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        for name, text in parts.items():
            book.writestr(name, text)
    return out.getvalue()


def customer_workbooks(spark: SparkSession, sf: str) -> DataFrame:
    """Dirty customers as workbooks in a binary column ``content``."""
    return workbooks(dirty_customers(spark, sf))


def workbooks(rows: DataFrame) -> DataFrame:
    """Rows as workbooks (``book``, ``content``), each of a fixed range of keys, which
    bounds its group."""
    names = rows.columns

    def pack(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        cells = group[names].astype(object).where(group[names].notna(), None)
        made = workbook(names, cells.itertuples(index=False))
        return pd.DataFrame({"book": [key[0]], "content": [made]})

    book = F.floor(F.col("customer_id").cast("bigint") / CUSTOMERS_PER_WORKBOOK)
    return rows.groupBy(book.alias("book")).applyInPandas(pack, "book bigint, content binary")


def write_workbooks(spark: SparkSession, rows: DataFrame) -> str:
    """The workbooks as .xlsx files in a new folder of the shared one.

    Spark has no writer for single binary files, so the tasks write through the
    file system that holds the shared folder; only a local one is served.
    """
    folder = scratch(spark, "workbooks")
    place = folder.removeprefix("file://").removeprefix("file:")
    if "://" in place:
        raise ValueError(f"cannot write single files below {folder}")
    Path(place).mkdir(parents=True)

    def put(batches: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        for batch in batches:
            for number, content in zip(batch["book"], batch["content"], strict=True):
                with open(f"{place}/{number}.xlsx", "wb") as file:
                    file.write(content)
            yield batch[["book"]]

    workbooks(rows).mapInPandas(put, "book bigint").write.format("noop").mode("overwrite").save()
    return folder
