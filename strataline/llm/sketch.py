"""A counting-Bloom sketch of hashes that says which of them surely occur once.

Each hash belongs to a segment of ``CELLS`` counters and raises ``PLACES`` of them. A
task counts its own hashes into partial sketches, of which only the counters it
raised leave it, and the partial sketches of a segment are merged by adding, up to 2.
A hash with a counter that stays below 2 occurs once; all others possibly repeat.
Counters are about ``CELLS_EACH`` for a row, so two in a hundred of the hashes that
occur once are not cleared. Segments are all alike and their number grows with
the rows. The table of segments is broadcast up to 32 MB, which is some 26 million rows;
beyond that the rows that are looked up are shuffled to it, with all their columns, and
adaptive execution splits a hot segment.

Defined results: null hashes count as a hash of their own; no rows give an empty
sketch, which clears everything.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataline.llm.common import quoted, small_enough, written

CELL_BITS = 15
CELLS = 1 << CELL_BITS
PLACES = 3
CELLS_EACH = 10
HELD = 1 << 20
"""Hashes a task holds before it gives out a partial sketch."""
TABLE = "segment bigint, words array<bigint>"


def _segment(hashed: Column, segments: int) -> Column:
    return F.pmod(F.xxhash64(hashed), F.lit(segments).cast("bigint"))


def _partial(segment: np.ndarray, hashed: np.ndarray) -> pa.RecordBatch:
    """The raised counters of each segment: twice the place, plus 1 if raised twice or more."""
    hashed, first, times = np.unique(hashed, return_index=True, return_counts=True)
    segment = segment[first]
    cells = np.concatenate(
        [(segment << CELL_BITS) | ((hashed >> (CELL_BITS * k)) & (CELLS - 1)) for k in range(PLACES)]
    )
    order = np.argsort(cells, kind="stable")
    cells, start = np.unique(cells[order], return_index=True)
    raised = np.minimum(np.add.reduceat(np.tile(np.minimum(times, 2), PLACES)[order], start), 2)
    at = cells >> CELL_BITS
    code = ((cells & (CELLS - 1)) * 2 + raised - 1).astype("<u2")
    begins = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    offsets = (np.r_[begins, len(code)] * 2).astype(np.int32)
    packed = pa.Array.from_buffers(pa.binary(), len(begins), [None, pa.py_buffer(offsets), pa.py_buffer(code)])
    return pa.RecordBatch.from_arrays([pa.array(at[begins]), packed], names=["segment", "cells"])


def _partials(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, n = [], 0
    for batch in batches:
        held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
        n += batch.num_rows
        if n >= HELD:
            yield _partial(*map(np.concatenate, zip(*held, strict=True)))
            held, n = [], 0
    if n:
        yield _partial(*map(np.concatenate, zip(*held, strict=True)))


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add up the partial sketches, which come in order of their segments; keep who reached 2."""
    segment, counters = None, None

    def done() -> Iterator[pa.RecordBatch]:
        if segment is not None and (counters >= 2).any():
            words = np.packbits(counters >= 2, bitorder="little").view("<i8")
            yield pa.RecordBatch.from_arrays([pa.array([segment]), pa.array([words])], names=["segment", "words"])

    for batch in batches:
        at, cells = batch.column(0).to_numpy(), batch.column(1).to_pylist()
        begins = np.flatnonzero(np.r_[True, at[1:] != at[:-1]]) if len(at) else []
        for a, b in zip(begins, [*begins[1:], len(at)], strict=True):
            if at[a] != segment:
                yield from done()
                segment, counters = int(at[a]), np.zeros(CELLS, np.int64)
            code = np.frombuffer(b"".join(cells[a:b]), "<u2")
            place = code >> 1
            counters += np.bincount(place, minlength=CELLS) + np.bincount(place[(code & 1) == 1], minlength=CELLS)
            np.minimum(counters, 2, out=counters)
    yield from done()


class Repeats:
    """Which hashes possibly occur more than once, as a table of merged segments."""

    def __init__(self, hashes: DataFrame, column: str = "hash"):
        """``hashes`` should be a written table; it is read twice."""
        rows = hashes.select(F.coalesce(quoted(column), F.lit(0)).alias("hash"))
        self.segments = max(1, -(-rows.count() * CELLS_EACH // CELLS))
        partial = rows.select(_segment(F.col("hash"), self.segments).alias("segment"), "hash").mapInArrow(
            _partials, "segment bigint, cells binary"
        )
        merged = partial.repartition("segment").sortWithinPartitions("segment").mapInArrow(_merged, TABLE)
        self.table = small_enough(written(merged, "sketch"))

    def among(self, rows: DataFrame, column: str = "hash") -> DataFrame:
        """The rows whose hash the sketch does not clear."""
        return self._met(rows, column, "left_semi")

    def cleared(self, rows: DataFrame, column: str = "hash") -> DataFrame:
        """The rows whose hash surely occurs once."""
        return self._met(rows, column, "left_anti")

    def _met(self, rows: DataFrame, column: str, how: str) -> DataFrame:
        hashed = F.coalesce(F.col(column), F.lit(0))
        table = self.table.select(F.col("segment").alias("sketch_segment"), F.col("words").alias("sketch_words"))
        raised = _segment(hashed, self.segments) == F.col("sketch_segment")
        for k in range(PLACES):
            place = F.shiftright(hashed, CELL_BITS * k).bitwiseAND(CELLS - 1)
            word = F.get("sketch_words", F.shiftright(place, 6).cast("int"))
            raised = raised & (F.getbit(word, place.bitwiseAND(63)) == 1)
        return rows.join(table, raised, how)
