"""CSV and JSON feeds, as batch frames or file streams.

Every reader takes an explicit schema (a DDL string or ``StructType``) and is
permissive: a malformed record is kept, its raw text in the corrupt column.

Spark parses only the columns a query asks for, and only what is parsed can be
found malformed. So never split a frame from here into good and bad rows
directly: write all its columns first, then split what was written (see
``operators.quality``).
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, VariantType

from strataline import fixed_values as fixed

Paths = str | Sequence[str]

# A file stream remembers the paths it has seen, and silently skips files older than
# the newest one minus this age, whose paths it forgets. So the age bounds both how
# late a file may come and what the stream remembers; Spark's default is seven days.
MAX_FILE_AGE = "90d"
MAX_FILES_PER_TRIGGER = 10_000


FILE, FILE_TIME = "file_path", "file_time"
FILE_COLUMNS = f"{FILE} string, {FILE_TIME} timestamp"
"""Which file a row was read from, and the file's time: with ``sourced``, readers add them."""


def _open(spark, form: str, paths: Paths, schema, stream: bool, options: dict, sourced: bool = False) -> DataFrame:
    bounds = {"maxFileAge": MAX_FILE_AGE, "maxFilesPerTrigger": MAX_FILES_PER_TRIGGER}
    source = spark.readStream.options(**bounds) if stream else spark.read
    if stream and not isinstance(paths, str):
        raise ValueError("a stream watches one folder")
    frame = (
        source.format(form)
        .schema(schema)
        .options(mode="PERMISSIVE", columnNameOfCorruptRecord=fixed.CORRUPT, **options)
        .load(paths if isinstance(paths, str) else list(paths))
    )
    if not sourced:
        return frame
    # The path comes encoded as in a URL, but for a plus sign. Most paths have nothing encoded,
    # and decoding costs more than looking, for each row.
    named = F.col("_metadata.file_path")
    decoded = F.url_decode(F.replace(named, F.lit("+"), F.lit("%2B")))
    path = F.when(F.contains(named, F.lit("%")), decoded).otherwise(named)
    return frame.withColumns({FILE: path, FILE_TIME: F.col("_metadata.file_modification_time")})


def read_csv(
    spark: SparkSession,
    paths: Paths,
    schema: StructType | str = fixed.PRODUCT_FEED,
    stream: bool = False,
    sourced: bool = False,
    **options: str,
) -> DataFrame:
    """CSV with a header line. Columns are taken by position, not by header."""
    return _open(spark, "csv", paths, schema, stream, {"header": "true", **options}, sourced)


def read_json_documents(
    spark: SparkSession,
    paths: Paths,
    schema: StructType | str = fixed.ORDER_FEED,
    stream: bool = False,
    sourced: bool = False,
    **options: str,
) -> DataFrame:
    """One JSON document (an array of objects) per file.

    A document cannot be split: one task reads one file, and one syntax or type
    error marks the file (``read_json_elements`` keeps a type error to its element).
    Feeds with large files should deliver JSON lines.
    """
    return _open(spark, "json", paths, schema, stream, {"multiLine": "true", **options}, sourced)


def read_json_lines(
    spark: SparkSession,
    paths: Paths,
    schema: StructType | str = fixed.ORDER_FEED,
    stream: bool = False,
    sourced: bool = False,
    **options: str,
) -> DataFrame:
    """One JSON object per line: files split, and an error costs one row."""
    return _open(spark, "json", paths, schema, stream, options, sourced)


# The largest document that is parsed as one variant value; Spark's own limit is 128 MB.
ELEMENT_DOCUMENT_BYTES = 100 << 20

_NUMBERS = {"bigint": ("BIGINT",), "int": ("BIGINT",), "double": ("BIGINT", "DOUBLE", "DECIMAL")}


def _typed(raw: Column, kind: str) -> tuple[Column, Column]:
    """A field's value, NULL if it is absent or of another type; and whether it is of another type."""
    found = F.split_part(F.schema_of_variant(raw), F.lit("("), F.lit(1))
    absent = found.isNull() | (found == "VOID")
    if kind == "string":
        # As the JSON reader does: what is no text is kept as its JSON.
        text = F.when(found == "STRING", F.try_variant_get(raw, "$", "string")).otherwise(F.to_json(raw))
        return F.when(~absent, text), F.lit(False)
    wanted = found == "BOOLEAN" if kind == "boolean" else found.isin(*_NUMBERS[kind])
    value = F.try_variant_get(raw, "$", kind)
    return F.when(wanted, value), ~absent & (~wanted | value.isNull())


def json_elements(documents: DataFrame, schema: StructType | str = fixed.ORDER_FEED) -> DataFrame:
    """The elements of JSON documents (a text column ``value``), each judged on its own, with further columns.

    A document is an array of objects, or one object. An element with a field of a
    wrong type keeps its other fields and has its own text in the corrupt column; an
    element that is no object has nothing but that. A text that is no JSON, or
    repeats a name within an object, is one malformed row with the whole text. A
    blank text has no rows.
    """
    fields = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    others = [c for c in documents.columns if c != "value"]
    parsed = documents.where(F.regexp_like("value", F.lit(r"\S"))).select(
        "value", *others, F.try_parse_json("value").alias("parsed")
    )

    def as_type(kind: str) -> Column:
        return F.try_variant_get("parsed", "$", kind)

    one = F.when(as_type("map<string,variant>").isNotNull(), F.array("parsed"))
    elements = F.coalesce(as_type("array<variant>"), one)
    # An empty array has no rows, so only what is no array is carried by an outer row.
    exploded = parsed.select("value", *others, elements.alias("elements")).where(
        F.col("elements").isNull() | (F.size("elements") > 0)
    ).select(
        F.when(F.col("elements").isNull(), F.col("value")).alias("value"),
        *others,
        F.explode_outer("elements").alias("element"),
    )
    wanted = [field for field in fields if field.name != fixed.CORRUPT]
    raw = StructType([StructField(field.name, VariantType()) for field in wanted])
    # NULL where the element is no object.
    cut = exploded.withColumn("fields", F.try_variant_get("element", "$", f"struct<{raw.toDDL()}>"))
    values, wrong = {}, F.col("fields").isNull()
    for field in wanted:
        values[field.name], bad = _typed(F.col("fields").getField(field.name), field.dataType.simpleString())
        wrong = wrong | F.coalesce(bad, F.lit(False))
    values[fixed.CORRUPT] = F.when(F.col("value").isNotNull(), F.col("value")).when(wrong, F.to_json("element"))
    return cut.select(*(values[field.name].alias(field.name) for field in fields), *others)


def read_json_elements(
    spark: SparkSession,
    paths: Paths,
    schema: StructType | str = fixed.ORDER_FEED,
    stream: bool = False,
    sourced: bool = False,
    **options: str,
) -> DataFrame:
    """JSON documents like ``read_json_documents``, but an error of type costs an element, not the file.

    A document is still read by one task. Those beyond ``ELEMENT_DOCUMENT_BYTES`` are too
    large for a variant value and go through the other reader; a stream, which
    cannot, has them as malformed. Columns from folder names are left out.
    """
    texts = _open(spark, "text", paths, "value string", stream, {"wholetext": "true", **options}, sourced)
    if sourced:
        texts = texts.select("value", FILE, FILE_TIME, "_metadata")
    else:
        texts = texts.select("value", "_metadata")
    if stream:
        return json_elements(texts.drop("_metadata"), schema)
    small = F.col("_metadata.file_size") <= ELEMENT_DOCUMENT_BYTES
    elements = json_elements(texts.where(small).drop("_metadata"), schema)
    large = read_json_documents(spark, paths, schema, sourced=sourced, **options).where(~small)
    return elements.unionByName(large.select(*elements.columns))


def stamp(frame: DataFrame, load_ts: datetime | None = None) -> DataFrame:
    """Add the load time: the given one, else the time the batch started."""
    moment = F.current_timestamp() if load_ts is None else F.lit(load_ts)
    return frame.withColumn(fixed.LOAD_TS, moment)
