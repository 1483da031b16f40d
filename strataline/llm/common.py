"""Helpers the operators share: words, rows kept whole, written intermediate tables."""

from __future__ import annotations

import operator
import pickle
import string
from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataline.session import scratch

ROW = "row"
"""The column that holds a whole input row while an operator works on it."""

ALNUM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
"""A word of lower-cased text: ASCII digits and letters, and all beyond ASCII."""

BROADCAST_LIMIT = 32 << 20

SPACES = "\t\n\x0b\x0c\r"
"""White space besides the blank."""

_ALNUM = bytes(
    ord(chr(b).lower()) if chr(b) in string.ascii_letters else b if chr(b) in string.digits or b > 127 else 32
    for b in range(256)
)
_LOWER = bytes(ord(chr(b).lower()) if chr(b) in string.ascii_uppercase else b for b in range(256))


def alnum_words(text: bytes | None) -> list[bytes]:
    """Words by ``ALNUM_WORD`` of UTF-8 text with A-Z lower-cased; none of null."""
    return text.translate(_ALNUM).split() if text else []


def lower_ascii(text: bytes | None) -> bytes:
    return text.translate(_LOWER) if text else b""


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def free_name(name: str, taken: Iterable[str]) -> str:
    """The name, with as many underscores behind it as it takes to be new."""
    taken = {other.lower() for other in taken}
    while name.lower() in taken:
        name += "_"
    return name


def packed(frame: DataFrame, text: str) -> list[Column]:
    """A frame as two columns: its text as ``text``, and ``row``, a struct of all others.

    No name of the frame can then clash with an operator's own, and the text is not
    carried twice.
    """
    others = [quoted(c) for c in frame.columns if c != text]
    filler = F.lit(0).alias(free_name("_", frame.columns))
    return [F.struct(*others, filler).alias(ROW), quoted(text).cast("string").alias("text")]


def unpacked(packed_frame: DataFrame, columns: list[str], text: str, new_text: Column | None = None) -> DataFrame:
    """Undo ``packed``: the columns in their order, the text as it is or as given."""
    value = F.col("text") if new_text is None else new_text
    return packed_frame.select(
        *(value.alias(c) if c == text else F.col(ROW).getField(c).alias(c) for c in columns)
    )


def space_words(text: Column) -> Column:
    """Words between white space, as an array; none of null."""
    blanks = F.translate(F.coalesce(text, F.lit("")), SPACES, " " * len(SPACES))
    return F.array_remove(F.split(blanks, " "), "")


def utf8_list(batch: pa.RecordBatch, name: str = "text") -> list[bytes | None]:
    """A string column of an Arrow batch as bytes, without decoding."""
    column = batch.column(batch.schema.get_field_index(name))
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def written(frame: DataFrame, label: str) -> DataFrame:
    """The frame as a table in the shared folder: later reads see the same rows and
    a lost executor repeats this step's work only."""
    path = scratch(frame.sparkSession, f"llm-{label}")
    frame.write.option("compression", "zstd").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def small_enough(table: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """A written table with a broadcast hint, if its rows come to at most ``limit`` bytes.

    The size is summed first. Beyond it the join is Spark's to plan, and as both
    sides are then shuffled as they are, adaptive execution can split a hot key.
    """

    def width(field: T.StructField) -> Column:
        column = quoted(field.name)
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(column), F.lit(0)) + 16
        if isinstance(field.dataType, T.ArrayType):
            return 8 * F.greatest(F.size(column), F.lit(0)) + 32
        return F.lit(64 if isinstance(field.dataType, T.StructType) else 8)

    size = reduce(operator.add, map(width, table.schema.fields), F.lit(16))
    measured = table.agg(F.sum(size.cast("bigint"))).first()[0] or 0
    return F.broadcast(table) if measured <= limit else table


class Shared:
    """A value that goes to each worker once, with the classes of this package it is made of.

    A broadcast alone would look for those classes in the worker's own copy of the
    repository, which there need not be.
    """

    def __init__(self, spark: SparkSession, value: object):
        self.content = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    def get(self) -> object:
        """The value, for as long as a task wants it: the worker keeps nothing of it."""
        content = self.content.value
        self.content.__dict__.pop("_value", None)
        return pickle.loads(content)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """An expression with a name for a value it uses more than once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def keep_one_of_equal(rows: DataFrame, equal: DataFrame, key: list[str]) -> DataFrame:
    """Of the rows (``row``, ``text``, key) whose key is in ``equal`` one each, all others as they are.

    Which one is decided by a hash of its other columns. They are reduced before
    the shuffle, so a key with very many rows does not fill a task.
    """
    if equal.isEmpty():
        return rows
    same = F.lit(True)
    for name in key:
        same = same & rows[name].eqNullSafe(equal[name])
    one = (
        rows.join(equal, same, "left_semi")
        .groupBy(*key)
        .agg(F.min_by(F.struct(ROW, "text"), F.xxhash64(ROW)).alias("kept"))
        .select(f"kept.{ROW}", "kept.text", *key)
    )
    return rows.join(equal, same, "left_anti").select(ROW, "text", *key).unionByName(one)


def map_rows(
    frame: DataFrame,
    schema: T.StructType,
    work: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]],
    keep: list[str],
) -> DataFrame:
    """``mapInArrow`` for a function that adds columns and leaves others as they are.

    ``work`` gets the batches and yields, for each, a dict of the added columns;
    the columns ``keep`` go through untouched.
    """
    fields = [frame.schema[name] for name in keep]
    out = T.StructType([*fields, *schema.fields])

    def run(batches):
        held: list[pa.RecordBatch] = []

        def seen():
            for batch in batches:
                held.append(batch)
                yield batch

        for added in work(seen()):
            batch = held.pop(0)
            arrays = [batch.column(batch.schema.get_field_index(name)) for name in keep]
            arrays += [pa.array(added[f.name], type=_arrow(f.dataType)) for f in schema.fields]
            yield pa.RecordBatch.from_arrays(arrays, names=[*keep, *(f.name for f in schema.fields)])

    return frame.mapInArrow(run, out)


def _arrow(kind: T.DataType) -> pa.DataType:
    if isinstance(kind, T.ArrayType):
        return pa.list_(_arrow(kind.elementType))
    if isinstance(kind, T.StructType):
        return pa.struct([pa.field(f.name, _arrow(f.dataType)) for f in kind.fields])
    return {
        "bigint": pa.int64(),
        "int": pa.int32(),
        "double": pa.float64(),
        "string": pa.string(),
        "boolean": pa.bool_(),
        "binary": pa.binary(),
    }[kind.simpleString()]
