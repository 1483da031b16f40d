"""How the words of sources differ, within each language, in exact whole numbers.

Identical texts of a language are collapsed before they are read: a counting-Bloom
sketch (``sketch``) clears texts that surely are unique, the others are shuffled,
reduced in each task first, into one row with the times each source has the text. Each
distinct text is then cut into terms once, and adds its counts and its document
frequencies, times those numbers, to sources and terms. A language keeps the
terms in at least ``LEAST_DOCUMENTS`` of its documents.

The share of a term in a group is ``p = 1 + floor(SCALE * (count + 1) / (total + terms))``,
and a term adds ``f(p, q) = floor((p - q)^2 / q)`` to a divergence. A pair of sources is a sum of
``f`` over all kept terms, most of which neither or only one of them has. So each
pair gets what it would be if no term were shared, from the few distinct shares of
each source and from the share of an absent term; and each term corrects the pairs
of those sources only that have it. Corrections gather in the tasks, in a matrix
for each two blocks of ``BLOCK`` sources, and never as a row for each pair and term.

Sizes: a language's sources are numbered, and a row of numbers for each of them (their totals)
travels with its rows; the result itself has a row for each two sources.

Defined results: null text, lang and source are ''; a source without terms, or a
language without kept terms, has pairs still (of value 0 without kept terms); repeated
rows count each; no documents give no rows; other columns are not read.
"""

from __future__ import annotations

from collections import Counter, OrderedDict, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strataline.llm.common import quoted, small_enough, utf8_list, written
from strataline.llm.sketch import Repeats

SCALE = 1_000_000_000
LEAST_DOCUMENTS = 3
TOP_TERMS = 200
BLOCK = 256
"""Sources in a side of a matrix of corrections."""
MATRICES = 32
"""Matrices a task holds before it gives one out."""
HELD = 1 << 18
"""Counts a task holds before it gives them out."""
CELLS = 1 << 20
"""Numbers a step of the arithmetic makes at once, about."""
PAIR = "lang string, a int, b int, value bigint"

_LETTERS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def terms(text: bytes | None) -> list[bytes]:
    """Runs of letters and of what lies beyond ASCII, A-Z lowered."""
    return text.translate(_LETTERS).split() if text else []


def numbered(documents: DataFrame, lang: str, source: str) -> DataFrame:
    """(``lang``, ``source``, ``idx``, ``gid``) of each group: its number in the language, and in all. Written."""
    groups = documents.select(*_named(lang, source)).distinct()
    by_lang = W.partitionBy("lang").orderBy("source")
    return written(
        groups.withColumn("idx", F.row_number().over(by_lang) - 1).withColumn(
            "gid", F.row_number().over(W.orderBy("lang", "source")) - 1
        ),
        "groups",
    )


def _named(*columns: str) -> list[Column]:
    names = ("lang", "source", "text")
    return [
        F.coalesce(quoted(c).cast("string"), F.lit("")).alias(n) for c, n in zip(columns, names, strict=False)
    ]


def collapsed(documents: DataFrame, groups: DataFrame, lang: str, source: str, text: str) -> DataFrame:
    """(``text``, ``held``): each distinct text of a language with its groups and the times they have it."""
    rows = (
        documents.select(*_named(lang, source, text))
        .join(small_enough(groups.select("lang", "source", "gid")), ["lang", "source"])
        .select("lang", "gid", "text", F.xxhash64("lang", "text").alias("hash"))
    )
    repeats = Repeats(written(rows.select("hash"), "text-hashes"))
    held = F.struct("gid", F.col("n"))
    alone = repeats.cleared(rows).withColumn("n", F.lit(1).cast("bigint")).select("text", F.array(held).alias("held"))
    several = (
        repeats.among(rows)
        .groupBy("lang", "text", "gid")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("lang", "text")
        .agg(F.collect_list(held).alias("held"))
    )
    return alone.unionByName(several.select("text", "held"))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[int, Counter] = defaultdict(Counter)
    docs: dict[int, Counter] = defaultdict(Counter)

    def given() -> Iterator[pa.RecordBatch]:
        for gid, found in counts.items():
            arrays = [
                pa.array([gid] * len(found), pa.int32()),
                pa.array(found.keys(), pa.binary()),
                pa.array(found.values(), pa.int64()),
                pa.array(map(docs[gid].__getitem__, found), pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["gid", "term", "n", "docs"])
        counts.clear()
        docs.clear()

    since = 0
    for batch in batches:
        held = batch.column(batch.schema.get_field_index("held")).to_pylist()
        for text, groups in zip(utf8_list(batch), held, strict=True):
            found = terms(text)
            since += len(found)
            if len(groups) == 1 and groups[0]["n"] == 1:
                gid = groups[0]["gid"]
                counts[gid].update(found)
                docs[gid].update(set(found))
            else:
                for term, k in Counter(found).items():
                    for group in groups:
                        counts[group["gid"]][term] += k * group["n"]
                        docs[group["gid"]][term] += group["n"]
            if since >= HELD:
                since = 0
                if sum(map(len, counts.values())) >= HELD:
                    yield from given()
    yield from given()


def postings(texts: DataFrame, groups: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """(``lang``, ``term``, ``n``, ``entries``) of the kept terms; an entry is a source's ``idx`` and count. Written."""
    counted = texts.mapInArrow(_count, "gid int, term binary, n bigint, docs bigint")
    by_group = counted.groupBy("gid", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    named = by_group.join(small_enough(groups.select("gid", "lang", "idx")), "gid")
    by_term = named.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("n"), F.collect_list(F.struct("idx", "n")).alias("entries")
    )
    return written(by_term.where(F.col("docs") >= least).drop("docs"), "postings")


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def share(count: Column, total: Column, kept: Column) -> Column:
    """``p`` of a term; through decimals where the product is beyond a long."""
    narrow = _div(SCALE * (count + 1), total + kept)
    wide = _div(F.lit(SCALE).cast("decimal(10,0)") * (count + 1).cast("decimal(20,0)"), (total + kept).cast("decimal(20,0)"))
    return 1 + F.when(count < 9_000_000_000, narrow).otherwise(wide)


def languages(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """A row for each language: ``kept`` terms, the language's ``total``, and by ``idx`` its sources' ``totals``,
    numbers of terms (``sizes``) and shares of an absent term (``absent``). Written."""
    entry = kept.select("lang", F.explode("entries").alias("e")).select("lang", "e.idx", "e.n")
    sums = entry.groupBy("lang", "idx").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("size"))
    zero = F.lit(0).cast("bigint")
    by_source = groups.join(sums, ["lang", "idx"], "left").select(
        "lang",
        F.struct("idx", F.coalesce("total", zero).alias("total"), F.coalesce("size", zero).alias("size")).alias("s"),
    )
    sources = by_source.groupBy("lang").agg(F.array_sort(F.collect_list("s")).alias("s"))
    whole = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("n").alias("total"))
    joined = sources.join(whole, "lang", "left").select(
        "lang",
        F.coalesce("kept", zero).alias("kept"),
        F.coalesce("total", zero).alias("total"),
        F.col("s.total").alias("totals"),
        F.col("s.size").alias("sizes"),
    )
    absent = F.transform(
        "totals", lambda n: F.when(F.col("kept") > 0, share(zero, n, F.col("kept"))).otherwise(F.lit(1).cast("bigint"))
    )
    return written(joined.withColumn("absent", absent), "languages")


def f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _unshared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each pair with a source would be if it shared no term with the other."""
    for batch in batches:
        for row in batch.to_pylist():
            a, kept = row["idx"], row["kept"]
            absent = np.array(row["absent"], np.int64)
            p, n = (np.array([h[k] for h in row["shares"] or []], np.int64) for k in ("p", "n"))
            there = (kept - n.sum() - np.array(row["sizes"], np.int64)) * f(absent[a], absent) * (kept > 0)
            back = np.zeros(len(absent), np.int64)
            step = max(1, CELLS // len(absent))
            for k in range(0, len(p), step):
                some, times = p[k : k + step, None], n[k : k + step, None]
                there += (times * f(some, absent[None, :])).sum(axis=0)
                back += (times * f(absent[None, :], some)).sum(axis=0)
            other = np.flatnonzero(np.arange(len(absent)) != a)
            mine = np.full(len(other), a)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([row["lang"]] * (2 * len(other)), pa.string()),
                    pa.array(np.r_[mine, other], pa.int32()),
                    pa.array(np.r_[other, mine], pa.int32()),
                    pa.array(np.r_[there[other], back[other]], pa.int64()),
                ],
                names=["lang", "a", "b", "value"],
            )


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the terms that both sources of a pair have change."""
    held: OrderedDict[tuple, np.ndarray] = OrderedDict()

    def given(unit: tuple, matrix: np.ndarray) -> pa.RecordBatch:
        lang, block_a, block_b = unit
        a, b = np.nonzero(matrix)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([lang] * len(a), pa.string()),
                pa.array(a + BLOCK * block_a, pa.int32()),
                pa.array(b + BLOCK * block_b, pa.int32()),
                pa.array(matrix[a, b], pa.int64()),
            ],
            names=["lang", "a", "b", "value"],
        )

    def side(column: pa.ListArray, rows: np.ndarray, size: int) -> list[np.ndarray]:
        begin = column.offsets.to_numpy()[:-1][rows]
        at = begin[:, None] + np.arange(size)[None, :]
        return [column.values.field(k).to_numpy()[at].astype(np.int64) for k in ("idx", "p", "p0")]

    for batch in batches:
        names = batch.schema.names
        units = list(zip(*(batch.column(names.index(c)).to_pylist() for c in ("lang", "block_a", "block_b")), strict=True))
        left, right = (batch.column(names.index(c)) for c in ("side_a", "side_b"))
        sizes = zip(left.value_lengths().to_pylist(), right.value_lengths().to_pylist(), strict=True)
        alike: dict[tuple, list[int]] = defaultdict(list)
        for k, key in enumerate(zip(units, sizes, strict=True)):
            alike[key].append(k)
        for (unit, (size_a, size_b)), found in alike.items():
            if unit not in held:
                if len(held) >= MATRICES:
                    yield given(*held.popitem(last=False))
                held[unit] = np.zeros((BLOCK, BLOCK), np.int64)
            held.move_to_end(unit)
            step = max(1, CELLS // (size_a * size_b))
            for k in range(0, len(found), step):
                rows = np.array(found[k : k + step])
                a, p, p0 = (x[:, :, None] for x in side(left, rows, size_a))
                b, q, q0 = (x[:, None, :] for x in side(right, rows, size_b))
                change = f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0)
                np.add.at(held[unit], (a % BLOCK, b % BLOCK), change)
    for unit, matrix in held.items():
        yield given(unit, matrix)


def pair_values(shares: DataFrame, by_lang: DataFrame, groups: DataFrame) -> DataFrame:
    """(``lang``, ``a``, ``b``, ``value``) of each two different sources of a language."""
    entry = shares.select("lang", F.explode("entries").alias("e")).select("lang", "e.idx", "e.p")
    counted = entry.groupBy("lang", "idx", "p").agg(F.count(F.lit(1)).alias("n"))
    listed = counted.groupBy("lang", "idx").agg(F.collect_list(F.struct("p", "n")).alias("shares"))
    alone = (
        groups.select("lang", "idx")
        .join(listed, ["lang", "idx"], "left")
        .join(small_enough(by_lang), "lang")
        .select("lang", "idx", "shares", "kept", "absent", "sizes")
        .mapInArrow(_unshared, PAIR)
    )

    def block(e: Column) -> Column:
        return F.floor(e["idx"] / BLOCK).cast("int")

    blocks = F.array_distinct(F.transform("entries", block))
    units = (
        shares.where(F.size("entries") > 1)
        .withColumn("blocks", blocks)
        .withColumn("block_a", F.explode("blocks"))
        .withColumn("block_b", F.explode("blocks"))
    )

    def side(which: str) -> Column:
        some = F.filter("entries", lambda e: block(e) == F.col(which))
        return F.when(F.size("blocks") == 1, F.col("entries")).otherwise(some)

    corrections = units.select(
        "lang", "block_a", "block_b", side("block_a").alias("side_a"), side("block_b").alias("side_b")
    ).mapInArrow(_shared, PAIR)
    exact = F.sum(F.col("value").cast("decimal(38,0)")).cast("bigint")
    return alone.unionAll(corrections.where("a <> b")).groupBy("lang", "a", "b").agg(exact.alias("value"))


def audit(
    documents: DataFrame,
    lang: str = "lang",
    source: str = "source",
    text: str = "text",
    least: int = LEAST_DOCUMENTS,
    top: int = TOP_TERMS,
) -> DataFrame:
    """(``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``).

    Part ``pair``: the divergence of a source from each other of its language. Part
    ``term``: the ``top`` terms it has more often than its language, by what they add to the
    divergence from the language.
    """
    groups = numbered(documents, lang, source)
    kept = postings(collapsed(documents, groups, lang, source, text), groups, least)
    by_lang = languages(kept, groups)
    joined = kept.join(small_enough(by_lang.withColumnRenamed("kept", "v").withColumnRenamed("total", "all")), "lang")
    entries = F.transform(
        "entries",
        lambda e: F.struct(
            e["idx"].alias("idx"),
            share(e["n"], F.get("totals", e["idx"]), F.col("v")).alias("p"),
            F.get("absent", e["idx"]).alias("p0"),
        ),
    )
    shares = joined.select("lang", "term", share(F.col("n"), F.col("all"), F.col("v")).alias("q"), entries.alias("entries"))
    names = small_enough(groups.select("lang", "idx", "source"))

    values = pair_values(shares, by_lang, groups)
    others = names.select("lang", F.col("idx").alias("b"), F.col("source").alias("item"))
    pairs = (
        values.join(names.withColumnRenamed("idx", "a"), ["lang", "a"])
        .join(others, ["lang", "b"])
        .withColumn("rank", _rank("lang", "source"))
        .select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank")
    )
    p, q = F.col("e.p"), F.col("q")
    above = (
        shares.select("lang", "term", "q", F.explode("entries").alias("e"))
        .where(p > q)
        .select(
            "lang", F.col("e.idx").alias("idx"), F.col("term").cast("string").alias("item"),
            _div((p - q) * (p - q), q).alias("value"),
        )
        .withColumn("rank", _rank("lang", "idx"))
        .where(F.col("rank") <= top)
        .join(names, ["lang", "idx"])
    )
    return pairs.unionByName(above.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))


def _rank(*group: str) -> Column:
    return F.row_number().over(W.partitionBy(*group).orderBy(F.desc("value"), "item"))
