"""SimHash near-duplicates through a Gray-order hierarchical index.

Copies are folded first: the index holds each fingerprint once. Two fingerprints
that differ in at most 3 of 64 bits agree on at least one of four 16-bit parts, so
the tops of the index are the groups that share a part, and each fingerprint
stands below four of them. Within a group fingerprints stand in Gray order, where
neighbours differ in few bits; every ``FANOUT`` neighbours form a node that holds
the bits all of them share, and so on upwards. The search walks pairs of nodes
downwards and drops a pair as soon as the shared bits of its two nodes differ in
more places than allowed. Links join in the task that finds them, which hands on
at most one link a fingerprint.

Groups are counted before they are dealt. One beyond ``GROUP_LIMIT`` is dealt by four
parts of its other bits instead, each with the same guarantee, until it is small enough. After five such steps at
most 15 bits are open, so a group cannot exceed 32,768 fingerprints.

Defined results: null and empty texts have fingerprint zero and link like any
other; rows with equal texts share a component; a component's id is its smallest
document id, null if all its ids are null; no documents give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataline.llm.common import (
    ROW,
    keep_one_of_equal,
    lower_ascii,
    map_rows,
    packed,
    small_enough,
    unpacked,
    utf8_list,
    written,
)
from strataline.llm.components import components

SHINGLE = 3
DISTANCE = 3
PARTS = DISTANCE + 1
GROUP_LIMIT = 1 << 15
OPEN_BITS = 15
FANOUT = 8
PAIRS_AT_ONCE = 1 << 12
SEED = 42
SHINGLES_AT_ONCE = 1 << 16

FINGERPRINT = T.StructType([T.StructField("fingerprint", T.LongType())])


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The 64 bits as a signed number; a bit is set if it is set in over half the hashes."""
    words = lower_ascii(text).split()
    if not words:
        return 0
    counts = np.zeros(64, np.int64)
    n = max(1, len(words) - shingle + 1)
    for a in range(0, n, SHINGLES_AT_ONCE):
        part = words[a : a + SHINGLES_AT_ONCE + shingle - 1]
        m = max(1, len(part) - shingle + 1)
        hashes = np.fromiter(
            (xxhash.xxh64_intdigest(b" ".join(part[k : k + shingle]), SEED) for k in range(m)), np.uint64, m
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(m, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.int64)[0])


def with_fingerprints(
    documents: DataFrame, text: str = "text", shingle: int = SHINGLE, keep_text: bool = False
) -> DataFrame:
    """The other columns (``row``), the text if wanted, and its ``fingerprint``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            yield {"fingerprint": [fingerprint(t, shingle) for t in utf8_list(batch)]}

    return map_rows(
        documents.select(*packed(documents, text)), FINGERPRINT, work, [ROW, "text"] if keep_text else [ROW]
    )


def gray_rank(code: Column) -> Column:
    """Where a 64-bit code stands in the Gray sequence."""
    for shift in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, shift))
    return code


def _split(mask: int) -> list[int]:
    """The bits outside ``mask``, in four parts; each part joined with ``mask``, as signed numbers."""
    free = [b for b in range(64) if not mask >> b & 1]
    sizes = [len(free) // PARTS + (k < len(free) % PARTS) for k in range(PARTS)]
    cuts = np.cumsum([0, *sizes])
    masks = [mask | sum(1 << b for b in free[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


LINK = "a bigint, b bigint"


def near_links(classes: DataFrame, limit: int = GROUP_LIMIT) -> DataFrame:
    """Links (``a``, ``b``) that join the distinct ``fingerprint`` of ``classes`` into components."""
    masks, found = [0], []
    rows = classes.select("fingerprint", F.lit(0).cast("bigint").alias("part"))
    while True:
        last = _open_bits(masks) <= OPEN_BITS
        if not last:
            children = {m: _split(m % (1 << 64)) for m in masks}
            below = F.coalesce(
                *(
                    F.when(F.col("part") == m, F.array(*(F.lit(c).cast("bigint") for c in children[m])))
                    for m in masks
                )
            )
            rows = rows.select("fingerprint", F.explode(below).alias("part"))
            masks = sorted({c for m in masks for c in children[m]})
        group = F.xxhash64("part", F.col("fingerprint").bitwiseAND(F.col("part")))
        rows = rows.withColumn("group", group)
        large = None
        if not last:
            # Counted first, by one row for each group and task, so that no large one is ever in a task.
            sizes = rows.groupBy("group").agg(F.count(F.lit(1)).alias("n"))
            large = small_enough(written(sizes.where(F.col("n") > limit).select("group"), "simhash-large"))
            if large.isEmpty():
                large = None
        small = rows if large is None else rows.join(large, "group", "left_anti")
        searched = (
            small.select("group", "fingerprint", gray_rank(F.col("fingerprint")).alias("rank"))
            .repartition("group")
            .sortWithinPartitions("group", "rank")
            .select("group", "fingerprint")
            .mapInArrow(_search, LINK)
        )
        found.append(written(searched, "simhash-links"))
        if large is None:
            return reduce(DataFrame.unionAll, found)
        rows = written(rows.join(large, "group", "left_semi").select("fingerprint", "part"), "simhash-again")


def _open_bits(masks: list[int]) -> int:
    return max(64 - (m % (1 << 64)).bit_count() for m in masks)


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Link the fingerprints of each group; a group's rows come one after the other."""
    held = [np.zeros(0, np.int64)] * 2
    for batch in batches:
        held = [np.r_[x, batch.column(k).to_numpy()] for k, x in enumerate(held)]
        if len(held[0]):
            end = int(np.flatnonzero(np.r_[True, held[0][1:] != held[0][:-1]])[-1])
            if end:
                yield _links(held[0][:end], held[1][:end].view(np.uint64))
            held = [x[end:] for x in held]
    if len(held[0]):
        yield _links(held[0], held[1].view(np.uint64))


def _links(groups: np.ndarray, codes: np.ndarray) -> pa.RecordBatch:
    root = linked(groups, codes)
    signed = codes.view(np.int64)
    # All links of a component go to its smallest code, as components() wants them.
    smallest = signed.copy()
    np.minimum.at(smallest, root, signed)
    to = smallest[root]
    own = np.flatnonzero(to != signed)
    return pa.RecordBatch.from_arrays([pa.array(signed[own]), pa.array(to[own])], names=["a", "b"])


def linked(groups: np.ndarray, codes: np.ndarray, distance: int = DISTANCE) -> np.ndarray:
    """For each code the first code it is connected to within its group.

    Codes of a group stand together, in Gray order.
    """
    n = len(codes)
    new = np.r_[True, groups[1:] != groups[:-1]][:n]
    first = np.flatnonzero(new)
    place = np.arange(n) - np.repeat(first, np.diff(np.r_[first, n]))
    # Levels from the codes upwards: where each node's children begin, its shared bits, its group's top.
    starts, patterns, masks = [np.arange(n + 1)], [codes], [np.full(n, ~np.uint64(0))]
    width = 1
    while width <= place.max(initial=0):
        width *= FANOUT
        below = starts[-1][:-1] if len(starts) == 1 else heads
        heads = np.flatnonzero(new | (place % width == 0))
        child = np.searchsorted(below, heads)
        both = np.bitwise_and.reduceat(patterns[0], heads)
        some = np.bitwise_or.reduceat(patterns[0], heads)
        starts.append(np.r_[child, len(below)])
        masks.append(~(both ^ some))
        patterns.append(both & masks[-1])
    root = np.arange(n)
    level = len(starts) - 1
    if level == 0:
        return root
    top = np.arange(len(starts[-1]) - 1)
    sizes = np.diff(np.r_[first, n])
    pairs = [(level, p, p) for p in (top[sizes > 1],) if len(p)]
    while pairs:
        level, left, right = pairs.pop()
        if len(left) > PAIRS_AT_ONCE:
            pairs += [
                (level, left[k : k + PAIRS_AT_ONCE], right[k : k + PAIRS_AT_ONCE])
                for k in range(0, len(left), PAIRS_AT_ONCE)
            ]
            continue
        first_of, n_left = starts[level][left], np.diff(starts[level])[left]
        other_of, n_right = starts[level][right], np.diff(starts[level])[right]
        combos = n_left * n_right
        which = np.repeat(np.arange(len(left)), combos)
        k = np.arange(combos.sum()) - np.repeat(np.cumsum(combos) - combos, combos)
        a = first_of[which] + k // n_right[which]
        b = other_of[which] + k % n_right[which]
        level -= 1
        shared = masks[level][a] & masks[level][b]
        near = np.bitwise_count((patterns[level][a] ^ patterns[level][b]) & shared) <= distance
        near &= (a < b) | ((a == b) & (level > 0))
        a, b = a[near], b[near]
        if not len(a):
            continue
        if level:
            pairs.append((level, a, b))
        else:
            _join(root, a, b)
    return root


def _join(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the components of each a with that of its b; roots are smallest members."""
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            return
        a, b = a[apart], b[apart]
        x, y = x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root[:] = root[root]


def near_duplicates(fingerprints: DataFrame, doc_id: Column, limit: int = GROUP_LIMIT) -> DataFrame:
    """(``fingerprint``, ``component``, ``component_id``) for each distinct fingerprint."""
    classes = written(
        fingerprints.groupBy("fingerprint").agg(F.min(doc_id).alias("first_id")), "simhash-classes"
    )
    roots = written(components(near_links(classes, limit)), "simhash-roots")
    joined = classes.join(roots, classes["fingerprint"] == roots["node"], "left").select(
        "fingerprint", F.coalesce("root", "fingerprint").alias("component"), "first_id"
    )
    # Written, so that a component with very many fingerprints can be split in the join.
    smallest = written(joined.groupBy("component").agg(F.min("first_id").alias("component_id")), "simhash-smallest")
    return joined.select("fingerprint", "component").join(small_enough(smallest), "component")


def drop_near_duplicates(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE
) -> DataFrame:
    """One document of each component, with its columns: the one with the smallest id.

    Nulls come last; equal ids are told apart by a hash of the text, then one row of
    each is kept. Only rows that go are looked up, by id and text, so neither copies
    nor a hot component meet in one task.
    """
    key = [F.struct(F.col("id").isNull(), "id", "hash").alias("key")]
    prints = written(
        with_fingerprints(documents, text, shingle, keep_text=True).select(
            "fingerprint",
            F.col(ROW).getField(doc_id).alias("id"),
            F.xxhash64(F.lit(0), "text").alias("hash"),
        ).groupBy("fingerprint", "id", "hash").count(),
        "simhash-ids",
    )
    groups = near_duplicates(prints, F.col("id")).select("fingerprint", "component")
    keyed = written(prints.join(groups, "fingerprint").select("component", "id", "hash", "count", *key), "simhash-keys")
    first = small_enough(written(keyed.groupBy("component").agg(F.min("key").alias("first")), "simhash-first"))
    judged = keyed.join(first, "component").withColumn("keep", F.col("key") == F.col("first"))
    goes = written(judged.where(~F.col("keep")).select("id", "hash"), "simhash-goes")
    equal = written(judged.where(F.col("keep") & (F.col("count") > 1)).select("id", "hash"), "simhash-equal")
    rows = documents.select(*packed(documents, text)).select(
        ROW, "text", F.col(ROW).getField(doc_id).alias("id"), F.xxhash64(F.lit(0), "text").alias("hash")
    )
    same = rows["id"].eqNullSafe(goes["id"]) & (rows["hash"] == goes["hash"])
    stay = keep_one_of_equal(rows.join(small_enough(goes), same, "left_anti"), equal, ["id", "hash"])
    return unpacked(stay, documents.columns, text)
