"""Read xlsx workbooks as text cells, one task per group of files.

Spark finds, distributes and loads the files; the function run in each task
only takes a workbook's first sheet apart. A sheet has at most 1,048,576 rows
by format, which bounds what one task holds. A file that cannot be read and a row
with a cell beyond the schema cost no others: they are kept, with path and reason
in the corrupt column.
"""

from __future__ import annotations

import io
import re
import sys
import zipfile
from collections.abc import Iterator, Sequence
from xml.etree import ElementTree

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strataline import fixed_values as fixed

# Fixed values of the file format.
_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL_ID = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"

_CHUNK = 10_000

# Send this module's functions along with the tasks, so that executors need no
# installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _column_number(reference: str) -> int:
    number = 0
    for letter in re.match(r"[A-Z]+", reference).group():
        number = number * 26 + ord(letter) - ord("A") + 1
    return number - 1


def _text(node) -> str:
    # Phonetic guides (rPh) are pronunciation hints, not cell text.
    runs = node.findall(f"{_MAIN}t") + node.findall(f"{_MAIN}r/{_MAIN}t")
    return "".join(run.text or "" for run in runs)


def _first_sheet(book: zipfile.ZipFile) -> str:
    sheet = ElementTree.parse(book.open("xl/workbook.xml")).find(f".//{_MAIN}sheet")
    links = ElementTree.parse(book.open("xl/_rels/workbook.xml.rels")).getroot()
    target = next(x.get("Target") for x in links if x.get("Id") == sheet.get(_REL_ID))
    return target.lstrip("/") if target.startswith("/") else f"xl/{target}"


def sheet_rows(content: bytes, width: int) -> Iterator[tuple[list[str | None], int]]:
    """Rows of the first sheet as ``width`` texts each, header included, with the
    number of filled cells beyond."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        shared: list[str] = []
        if "xl/sharedStrings.xml" in book.namelist():
            for _, node in ElementTree.iterparse(book.open("xl/sharedStrings.xml")):
                if node.tag == f"{_MAIN}si":
                    shared.append(_text(node))
                    node.clear()
        for _, node in ElementTree.iterparse(book.open(_first_sheet(book))):
            if node.tag != f"{_MAIN}row":
                continue
            cells: list[str | None] = [None] * width
            beyond = 0
            for place, cell in enumerate(node.findall(f"{_MAIN}c")):
                reference = cell.get("r")
                column = _column_number(reference) if reference else place
                if cell.get("t") == "inlineStr":
                    inline = cell.find(f"{_MAIN}is")
                    value = None if inline is None else _text(inline)
                else:
                    value = cell.findtext(f"{_MAIN}v")
                    if cell.get("t") == "s" and value is not None:
                        value = shared[int(value)]
                if column < width:
                    cells[column] = value
                else:
                    beyond += value is not None
            node.clear()
            yield cells, beyond


def _records(content: bytes, path: str, width: int) -> Iterator[list[str | None]]:
    """A sheet's rows after its header, each with what is wrong with it or None."""
    try:
        for number, (cells, beyond) in enumerate(sheet_rows(content, width)):
            if number and (beyond or any(cell is not None for cell in cells)):
                wrong = f"{path}: row {number + 1} has {beyond} cells too many" if beyond else None
                yield [*cells, wrong]
    except (zipfile.BadZipFile, ElementTree.ParseError, LookupError, ValueError, AttributeError, StopIteration) as error:
        yield [*[None] * width, f"{path}: {type(error).__name__}: {error}"]


def parse_workbooks(
    contents: DataFrame, schema: StructType | str = fixed.CUSTOMER_FEED
) -> DataFrame:
    """Rows of the workbooks in the binary column ``content``, told by ``path`` if given.

    The first row of a sheet is its header and is skipped; columns are taken by
    position. All columns of ``schema`` must be strings; the last is the corrupt
    column. Empty rows are skipped. Of a file that breaks off, rows before the
    break are kept.
    """
    names = (StructType.fromDDL(schema) if isinstance(schema, str) else schema).fieldNames()

    def take_apart(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content, path in zip(batch["content"], batch["path"], strict=True):
                chunk: list[Sequence[str | None]] = []
                for row in _records(content, path, len(names) - 1):
                    chunk.append(row)
                    if len(chunk) == _CHUNK:
                        yield pd.DataFrame(chunk, columns=names, dtype=object)
                        chunk = []
                if chunk:
                    yield pd.DataFrame(chunk, columns=names, dtype=object)

    path = F.col("path") if "path" in contents.columns else F.lit("workbook").alias("path")
    return contents.select("content", path).mapInPandas(take_apart, schema)


def read_workbooks(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: StructType | str = fixed.CUSTOMER_FEED,
) -> DataFrame:
    """Scan many ``.xlsx`` files or folders of them."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.xlsx")
        .load(paths if isinstance(paths, str) else list(paths))
    )
    return parse_workbooks(files.select("content", "path"), schema)
