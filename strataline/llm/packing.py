"""Documents packed into windows of tokens, best fit decreasing.

A document's ids come from the tokenizer, with an end mark behind them. A document
longer than a window is first cut into full windows; the rest, and each shorter
document, is a piece to be packed. Pieces are dealt by a hash into shards of about
``SHARD_TOKENS`` tokens. In a shard they come longest first, and each goes into the
open window with the least room that still holds it. That window is found by a
segment tree over the room left, 0 to the window's size, whose nodes say whether an
open window has a room in their range; it costs a few steps however many windows are
open. A shard streams through one task, which holds the open windows only.

The tokenizer works on words: its normaliser and pre-tokenizer never join what a
blank or a line feed separates (``word_bpe_49k`` drops white space), so the ids of each
distinct word are computed once and kept, up to ``KEPT`` words in a worker. A tokenizer
file of another kind would need another way to cut texts.

A row number, given when the pieces are written, tells equal documents apart and
deals them to different shards.

Defined results: a null or empty text is its end mark alone; a text of any length is cut
whole; equal rows are packed each; equal lengths go by the row number; no documents give
no rows; other columns stay in ``row``.
"""

from __future__ import annotations

import os
import re
import sys
import zlib
from collections.abc import Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataline.llm.common import ROW, packed, utf8_list, written

WINDOW = 4096
END = 2
VOCABULARY = "word_bpe_49k.json"
SHARD_TOKENS = 1 << 25
KEPT = 1 << 20
LONGEST_KEPT = 64
"""Bytes of the words whose ids are kept."""
WORD_END = "</w>"
MARKS_BEHIND_WORD = re.compile(rb"(?<=[a-z])([!-&(-/:-@\[-`{-~]+)(?=[ \n])")
OF_WORKER = "packing_words_of_this_worker"
BATCH_BYTES = 1 << 22
PLACES = T.StructType(
    [
        T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType()),
    ]
)
PIECE = T.StructType(
    [
        T.StructField("piece", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
        T.StructField("doc_tokens", T.LongType()),
    ]
)


class Words:
    """Ids of texts, as little-endian 32-bit numbers, by way of their words."""

    def __init__(self, model: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(model)
        self.known = {b"": b""}
        size = self.tokenizer.get_vocab_size()
        names = (self.tokenizer.id_to_token(k) or "" for k in range(size))
        self.ends_word = np.array([name.endswith(WORD_END) for name in names])

    @staticmethod
    def cut(text: bytes) -> list[bytes]:
        """Parts of a text whose ids, one after the other, are the text's.

        The tokenizer lowers letters, except in the names of its special tokens, and
        after composing accents; so A-Z are lowered here where neither occurs. Marks
        between a letter and white space are a part of their own.
        """
        if b"<|" not in text:
            if not (b"\xcc" in text or b"\xcd" in text):
                text = text.lower()
            text = MARKS_BEHIND_WORD.sub(rb" \1", text)
        return text.replace(b"\n", b" ").split(b" ")

    def _encode(self, parts: list[bytes]) -> dict[bytes, bytes]:
        """Words of letters go through the tokenizer together: each ends with an end-of-word token."""
        texts = [p.decode("utf-8", "replace") for p in parts]
        letters = [k for k, t in enumerate(texts) if t.isalpha()]
        joined = self.tokenizer.encode_batch_fast([" ".join(texts[k] for k in letters)], add_special_tokens=False)
        ids = np.asarray(joined[0].ids, "<u4")
        ends = np.flatnonzero(self.ends_word[ids]) + 1
        found = {}
        if len(ends) == len(letters):
            data, begin = ids.tobytes(), 0
            for k, end in zip(letters, (4 * ends).tolist(), strict=True):
                found[parts[k]] = data[begin:end]
                begin = end
        others = [k for k, part in enumerate(parts) if part not in found]
        one_by_one = self.tokenizer.encode_batch_fast([texts[k] for k in others], add_special_tokens=False)
        found.update((parts[k], np.asarray(e.ids, "<u4").tobytes()) for k, e in zip(others, one_by_one, strict=True))
        return found

    def ids(self, texts: list[bytes | None]) -> Iterator[bytes]:
        known = self.known
        cut = [self.cut(t) if t else [] for t in texts]
        found = [list(map(known.get, parts)) for parts in cut]
        gaps = [(ids, parts, [*_places(ids, None)]) for ids, parts in zip(found, cut, strict=True) if None in ids]
        made = self._encode(sorted({parts[k] for _, parts, places in gaps for k in places})) if gaps else {}
        for ids, parts, places in gaps:
            for k in places:
                ids[k] = made[parts[k]]
        if len(known) + len(made) > KEPT:
            known = self.known = {b"": b""}
        known.update((part, ids) for part, ids in made.items() if len(part) <= LONGEST_KEPT)
        return map(b"".join, found)


def _places(items: list, wanted: object) -> Iterator[int]:
    """Where the item stands in the list."""
    at = -1
    try:
        while True:
            at = items.index(wanted, at + 1)
            yield at
    except ValueError:
        return


def _words_of_worker(model: str) -> Words:
    """The worker's own: Spark runs many tasks in a Python worker, and words stay known between them."""
    place = sys.modules.setdefault(OF_WORKER, ModuleType(OF_WORKER))
    if getattr(place, "model", None) != model:
        place.model, place.words = model, Words(model)
    return place.words


def _in_parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in parts of about ``BATCH_BYTES`` of text."""
    texts = utf8_list(batch)
    begin, size = 0, 0
    for k, text in enumerate(texts):
        size += len(text or b"")
        if size >= BATCH_BYTES:
            yield batch.slice(begin, k + 1 - begin)
            begin, size = k + 1, 0
    if begin < len(texts):
        yield batch.slice(begin)


def pieces(
    documents: DataFrame,
    vocabulary: str,
    text: str = "text",
    window: int = WINDOW,
    end: int = END,
    keep_ids: bool = False,
) -> DataFrame:
    """The other columns (``row``) with each piece of the documents, written.

    ``vocabulary`` is a tokenizer file that the driver can read. With ``keep_ids`` a
    piece's ids come along.
    """
    with open(vocabulary, encoding="utf-8") as file:
        model = documents.sparkSession.sparkContext.broadcast(file.read())
    frame = documents.select(*packed(documents, text))
    fields = [*PIECE.fields, *([T.StructField("ids", T.ArrayType(T.IntegerType()))] if keep_ids else [])]
    out = T.StructType([frame.schema[ROW], *fields])
    mark = np.asarray([end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _words_of_worker(model.value)
        number = TaskContext.get().partitionId() << 40
        width = 4 * window
        for whole in batches:
            for batch in _in_parts(whole):
                owner, columns = [], [[] for _ in fields]
                for k, found in enumerate(tokenizer.ids(utf8_list(batch))):
                    ids = found + mark
                    for begin in range(0, len(ids), width):
                        part = ids[begin : begin + width]
                        owner.append(k)
                        values = [number, begin // 4, len(part) // 4, zlib.crc32(part), len(ids) // 4]
                        if keep_ids:
                            values.append(np.frombuffer(part, "<u4").astype(np.int32))
                        for column, value in zip(columns, values, strict=True):
                            column.append(value)
                        number += 1
                rows = batch.column(batch.schema.get_field_index(ROW)).take(pa.array(owner, pa.int64()))
                kinds = [pa.int64()] * len(PIECE.fields) + [pa.list_(pa.int32())] * keep_ids
                arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([rows, *arrays], names=[ROW, *(f.name for f in fields)])

    return written(frame.mapInArrow(run, out), "pieces")


class Windows:
    """The open windows of a shard under a segment tree over the room they have left."""

    def __init__(self, size: int):
        self.size = size
        self.leaves = 1 << size.bit_length()
        self.tree = bytearray(2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(size + 1)]
        self.made = 0

    def _tightest(self, length: int) -> int:
        """The least room of at least ``length`` that an open window has, or -1."""
        tree, node = self.tree, self.leaves + length
        while not tree[node]:
            # Up to where something lies to the right, then to it.
            while node & 1:
                node >>= 1
            if not node:
                return -1
            node += 1
            if not node & (node - 1):
                return -1
        while node < self.leaves:
            node *= 2
            if not tree[node]:
                node += 1
        return node - self.leaves

    def _mark(self, room: int, there: int) -> None:
        tree, node = self.tree, self.leaves + room
        tree[node] = there
        while node > 1:
            node >>= 1
            value = tree[2 * node] | tree[2 * node + 1]
            if tree[node] == value:
                break
            tree[node] = value

    def put(self, length: int) -> tuple[int, int]:
        """The window for a piece of this length, and where in it the piece begins."""
        room = self._tightest(length)
        if room < 0:
            room, number = self.size, self.made
            self.made += 1
        else:
            number = self.open[room].pop()
            if not self.open[room]:
                self._mark(room, 0)
        left = room - length
        if left:
            self.open[left].append(number)
            if len(self.open[left]) == 1:
                self._mark(left, 1)
        return number, self.size - room


def pack(made: DataFrame, window: int = WINDOW, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """The pieces (written) with ``sequence_id`` and ``offset``.

    A sequence's tokens end where its last piece ends; what is left of the window is padding.
    """
    total = made.agg(F.sum("length")).first()[0] or 0
    shards = max(1, -(-total // shard_tokens))
    dealt = made.withColumn("shard", F.pmod(F.xxhash64("piece"), F.lit(shards).cast("bigint")))
    ordered = dealt.repartition("shard").sortWithinPartitions("shard", F.desc("length"), "piece")
    columns = made.columns
    out = T.StructType([*made.schema.fields, *PLACES.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, windows = None, None
        for batch in batches:
            where, offset = [], []
            lengths = batch.column(batch.schema.get_field_index("length")).to_pylist()
            at = batch.column(batch.schema.get_field_index("shard")).to_pylist()
            for length, here in zip(lengths, at, strict=True):
                if here != shard:
                    shard, windows = here, Windows(window)
                number, begin = windows.put(length)
                where.append((here << 32) + number)
                offset.append(begin)
            kept = [batch.column(batch.schema.get_field_index(name)) for name in columns]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(where, pa.int64()), pa.array(offset, pa.int64())],
                names=[*columns, *PLACES.names],
            )

    return ordered.mapInArrow(run, out)
