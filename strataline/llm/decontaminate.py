"""Benchmark decontamination by suffix arrays over shards of the training text.

Every task turns its documents into shards of at most ``shard_words`` words (a
longer document is a shard of its own), builds a suffix array of each and
binary-searches every suffix of the benchmark that can hold a window. The range
of the array a search ends in gives all places of the window; windows that
follow each other on one diagonal join to the longest verbatim matches.

A word that is in no benchmark item can be in no match, so it ends a suffix: the
arrays hold only runs of benchmark words.

The benchmark is dealt into blocks of about ``block_words`` words by a hash of
the item, which are broadcast one by one. A task takes each batch of documents
through the blocks, of which it holds one at a time, so that is bounded whatever the
benchmark's size. There is one such step and no shuffle.

Defined results: a null or empty text has no words and no matches; an item
without words has no window; an item with a null id makes hits but is not named;
items with the same id count once; repeated documents get one row each; an empty
benchmark leaves every document clean; further columns stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataline.llm.common import (
    ALNUM_WORD,
    ROW,
    Shared,
    alnum_words,
    map_rows,
    packed,
    quoted,
    unpacked,
    utf8_list,
)

WINDOW = 13
SHARD_WORDS = 1 << 20
BLOCK_WORDS = 1 << 20
PLACES_AT_ONCE = 1 << 22

MATCH = T.StructType(
    [
        T.StructField("item_id", T.StringType()),
        T.StructField("item_start", T.LongType()),
        T.StructField("doc_start", T.LongType()),
        T.StructField("n_words", T.LongType()),
    ]
)
FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("spans", T.ArrayType(T.LongType())),
        T.StructField("matches", T.ArrayType(MATCH)),
    ]
)


def suffix_array(words: np.ndarray) -> np.ndarray:
    """Positions of the non-zero words, in order of the words from there to the next zero.

    Several words are packed into the first sort key; what is equal then is
    refined by prefix doubling, where only groups still undecided take part.
    """
    n = len(words)
    bits = max(1, int(words.max(initial=0)).bit_length())
    h = max(1, 62 // bits)
    key, alive = np.zeros(n, np.int64), np.ones(n, bool)
    for k in range(h):
        word = np.zeros(n, np.int64)
        word[: max(0, n - k)] = words[k:]
        word *= alive
        alive = word > 0
        key = (key << bits) | word
    order = np.flatnonzero(words)
    key = key[order]
    by = np.argsort(key, kind="stable")
    order, key = order[by], key[by]
    rank = np.zeros(n + 1, np.int64)
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    sizes = np.diff(np.r_[starts, len(key)])
    rank[order] = np.repeat(starts + 1, sizes)
    slots = np.flatnonzero(np.repeat(sizes > 1, sizes) & alive[order])
    while len(slots):
        at = order[slots]
        first, second = rank[at], rank[np.minimum(at + h, n)]
        by = np.lexsort((second, first))
        at, first, second = at[by], first[by], second[by]
        order[slots] = at
        new = np.r_[True, (first[1:] != first[:-1]) | (second[1:] != second[:-1])]
        starts = np.flatnonzero(new)
        sizes = np.diff(np.r_[starts, len(at)])
        rank[at] = np.repeat(slots[starts] + 1, sizes)
        slots = slots[np.repeat(sizes > 1, sizes) & (second > 0)]
        h *= 2
    return order


def search(words: np.ndarray, suffixes: np.ndarray, query: np.ndarray, start: np.ndarray, need: np.ndarray):
    """For each query suffix the range of the array that begins with its first ``need`` words."""
    padded = np.r_[words, 0]
    low, high = np.zeros(len(start), np.int64), np.full(len(start), len(suffixes), np.int64)
    for depth in range(int(need.max(initial=0))):
        todo = np.flatnonzero((need > depth) & (low < high))
        if not len(todo):
            break
        wanted = query[start[todo] + depth]
        bounds = []
        for target in (wanted, wanted + 1):
            a, b = low[todo].copy(), high[todo].copy()
            while (still := np.flatnonzero(a < b)).size:
                middle = (a[still] + b[still]) // 2
                less = padded[suffixes[middle] + depth] < target[still]
                a[still[less]] = middle[less] + 1
                b[still[~less]] = middle[~less]
            bounds.append(a)
        low[todo], high[todo] = bounds
    return low, high


class Block:
    """One block of benchmark items: their words as numbers, and the windows to look for."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int):
        self.names: list[str | None] = []
        self.numbers: dict[bytes, int] = {}
        query, start, need, owner, inside = [0], [], [], [], []
        for name, text in items:
            words = alnum_words(text)
            size = min(window, len(words))
            for k in range(len(words) - size + 1 if words else 0):
                start.append(len(query) + k)
                need.append(size)
                owner.append(len(self.names))
                inside.append(k)
            query += [self.numbers.setdefault(w, len(self.numbers) + 1) for w in words] + [0]
            self.names.append(name)
        self.query = np.array(query, np.int64)
        self.start, self.need = np.array(start, np.int64), np.array(need, np.int64)
        self.owner, self.inside = np.array(owner, np.int64), np.array(inside, np.int64)

    def matches(self, words: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int, int]]]:
        """Which words are hit, and the longest match of each item and document.

        ``words`` are the numbers of a shard's words, a zero after each document;
        ``starts`` are the documents' first places. A match is (document, item, its
        start in the item, its place in the shard, words).
        """
        hit = np.zeros(len(words) + 1, np.int64)
        suffixes = suffix_array(words)
        low, high = search(words, suffixes, self.query, self.start, self.need)
        found = np.flatnonzero(high > low)
        longest: dict[tuple[int, int], tuple[int, int, int]] = {}
        ends = np.cumsum(high[found] - low[found])
        # Queries go in pieces of bounded size, at items' ends if they can. Where an item is
        # cut, its runs up to the cut wait for those that follow them.
        a, waiting = 0, None
        while a < len(found):
            b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + PLACES_AT_ONCE)))
            if b < len(found):
                cut = int(np.searchsorted(self.owner[found], self.owner[found[b]]))
                b = cut if cut > a else b
            q = found[a:b]
            sizes = high[q] - low[q]
            which = np.repeat(q, sizes)
            offset = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            place = suffixes[low[which] + offset]
            np.add.at(hit, place, 1)
            np.add.at(hit, place + self.need[which], -1)
            diagonal = place - self.inside[which]
            by = np.lexsort((place, diagonal, self.owner[which]))
            which, place, diagonal = which[by], place[by], diagonal[by]
            owner, doc = self.owner[which], np.searchsorted(starts, place, side="right") - 1
            new = np.r_[True, (owner[1:] != owner[:-1]) | (diagonal[1:] != diagonal[:-1]) | (place[1:] != place[:-1] + 1) | (doc[1:] != doc[:-1])]
            first = np.flatnonzero(new)
            run = np.diff(np.r_[first, len(place)])
            begin, size = place[first].copy(), self.need[which[first]] + run - 1
            if waiting is not None and q[0] == waiting[0] + 1 and self.owner[q[0]] == self.owner[waiting[0]]:
                _, diagonals, begins, lengths = waiting
                follows = np.flatnonzero(which[first] == q[0])
                at = np.minimum(np.searchsorted(diagonals, diagonal[first[follows]]), len(diagonals) - 1)
                joined = (diagonals[at] == diagonal[first[follows]]) & (begins[at] + lengths[at] == begin[follows] + self.need[q[0]] - 1)
                follows, at = follows[joined], at[joined]
                begin[follows], size[follows] = begins[at], lengths[at] + run[follows]
            last = np.r_[first[1:], len(place)] - 1
            ending = np.flatnonzero(which[last] == q[-1])
            ending = ending[np.argsort(diagonal[first[ending]])]
            waiting = (q[-1], diagonal[first[ending]], begin[ending], size[ending]) if len(ending) else None
            for k in np.lexsort((begin, -size)):
                at = first[k]
                key = (int(owner[at]), int(doc[at]))
                if key not in longest or longest[key][2] < size[k]:
                    longest[key] = (int(begin[k] - diagonal[at]), int(begin[k]), int(size[k]))
            a = b
        return np.cumsum(hit[:-1]) > 0, [(doc, item, *at) for (item, doc), at in longest.items()]

    def scan(self, texts: list[bytes | None], before: list[list[int]], shard_words: int) -> Iterator[tuple]:
        """For each text: number of words, hit spans joined with those of ``before``, matches."""
        shard: list[list[int]] = []
        size = 0
        for k, text in enumerate(texts):
            shard.append([self.numbers.get(w, 0) for w in alnum_words(text)])
            size += len(shard[-1]) + 1
            if size >= shard_words or k == len(texts) - 1:
                yield from self._shard(shard, before[k + 1 - len(shard) : k + 1])
                shard, size = [], 0

    def _shard(self, documents: list[list[int]], before: list[list[int]]) -> Iterator[tuple]:
        sizes = np.array([len(d) for d in documents], np.int64)
        starts = np.cumsum(sizes + 1) - sizes - 1
        words = np.zeros(int(sizes.sum()) + len(sizes), np.int64)
        for start, document in zip(starts, documents, strict=True):
            words[start : start + len(document)] = document
        hit, matches = self.matches(words, starts)
        for start, spans in zip(starts, before, strict=True):
            for a, b in zip(spans[::2], spans[1::2], strict=True):
                hit[start + a : start + b] = True
        edges = np.flatnonzero(np.diff(np.r_[0, hit.astype(np.int8), 0]))
        by_document: list[list[tuple]] = [[] for _ in documents]
        for doc, item, item_start, place, size in matches:
            by_document[doc].append((self.names[item], item_start, int(place - starts[doc]), size))
        for k, (start, size) in enumerate(zip(starts, sizes, strict=True)):
            a, b = np.searchsorted(edges, (start, start + size + 1))
            yield int(size), (edges[a:b] - start).tolist(), by_document[k]


def find_matches(
    documents: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    shard_words: int = SHARD_WORDS,
    block_words: int = BLOCK_WORDS,
    keep_text: bool = False,
) -> DataFrame:
    """Each document's other columns (``row``), words, hit words and longest match per item.

    ``n_hit`` counts the words inside any place of any window of ``window`` item
    words (of the whole item, if that is shorter); ``items`` are the ids, as
    sorted strings, of the items with such places.
    """
    items = benchmark.select(
        quoted(item).cast("string").alias("id"), quoted(item_text).cast("string").alias("text")
    )
    n_words = F.size(F.regexp_extract_all(F.lower("text"), F.lit(ALNUM_WORD), F.lit(0)))
    total = items.where(F.col("text").isNotNull()).agg(F.sum(n_words)).first()[0] or 0
    n_blocks = max(1, -(-total // block_words))
    dealt = F.pmod(F.xxhash64("id", "text"), F.lit(n_blocks))
    blocks = []
    for k in range(n_blocks):
        rows = items.where(dealt == k).orderBy("id", "text").collect()
        block = Block([(r.id, r.text and r.text.encode()) for r in rows], window)
        blocks.append(Shared(documents.sparkSession, block))
    found = map_rows(
        documents.select(*packed(documents, text)),
        FOUND,
        _scanner(blocks, shard_words),
        [ROW, "text"] if keep_text else [ROW],
    )
    named = F.filter(F.col("matches.item_id"), lambda name: name.isNotNull())
    return found.withColumn("items", F.array_sort(F.array_distinct(named))).drop("spans")


def _scanner(blocks: list[Shared], shard_words: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        only = blocks[0].get() if len(blocks) == 1 else None
        for batch in batches:
            texts = utf8_list(batch)
            sizes, spans, matches = [0] * len(texts), [[] for _ in texts], [[] for _ in texts]
            for shared in blocks:
                block = only or shared.get()
                scanned = block.scan(texts, spans, shard_words)
                spans = [[]] * len(texts)
                for k, (size, hit, found) in enumerate(scanned):
                    sizes[k], spans[k] = size, hit
                    matches[k] += [dict(zip(MATCH.names, m, strict=True)) for m in found]
                # Before the next block is loaded.
                del block
            hits = [sum(hit[1::2]) - sum(hit[::2]) for hit in spans]
            yield dict(zip(FOUND.names, (sizes, hits, spans, matches), strict=True))

    return scan


def is_contaminated(least: int = 20) -> Column:
    """At least one word in ``least`` is hit."""
    return (F.col("n_hit") > 0) & (least * F.col("n_hit") >= F.col("n_words"))


def clean_documents(documents: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents that are not contaminated, with their columns."""
    found = find_matches(documents, benchmark, text=text, keep_text=True, **options)
    return unpacked(found.where(~is_contaminated()), documents.columns, text)
