"""How filters interact: what each removes, finds already gone, or alone removes, in every order.

Each document gets a mask with a bit for each filter it fails. All filters but the
last judge a text alone. The last one fails a document whose text a smaller id has
too, anywhere in the table. For it, a counting-Bloom sketch of the texts' hashes
(``sketch``) clears those that surely are unique; only the texts that possibly repeat
are shuffled, reduced in each task first, to find the smallest id of each full text. A
document then meets that id by its hash, without its text; where two texts
share a hash, the texts are compared.

Masks are joined with the labels and counted by part. Any order of filters can be
read off these counts, as a sum over masks: what a step sees depends only on the set
of filters before it. The Shapley value of a filter, summed over all orders, weighs
each such set by the orders that begin with it.

Defined results: a null text is empty and a null source the part ''; a document
without an id has no smaller id and is no one's smaller id; equal rows are
documents each, and neither is the smaller; a label counts if any row of the id has it;
no documents give no rows; other columns are not read.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strataline.llm.common import let, quoted, small_enough, space_words, written
from strataline.llm.sketch import Repeats

CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MARKS = "#$%&*|"
FILTERS = "ABCDE"
"""One letter for each filter; the last is the one for repeated texts."""

Hash = Callable[[Column], Column]


def _without(text: Column, characters: str) -> Column:
    return F.char_length(F.translate(text, characters, ""))


def text_mask(text: Column) -> Column:
    """A bit for each filter on the text alone that it fails: A is 1, B is 2, C is 4, D is 8."""
    counted = let(
        space_words(text),
        lambda w: F.struct(F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("distinct")),
    )

    def mask(c: Column) -> Column:
        length = F.char_length(text)
        fails = [
            c["n"] < 50,
            100 * c["distinct"].cast("bigint") < 65 * c["n"].cast("bigint"),
            100 * (length - _without(text, CAPITALS)).cast("bigint") > 5 * length.cast("bigint"),
            _without(text, MARKS) < length,
        ]
        return sum((F.when(fail, 1 << k).otherwise(0) for k, fail in enumerate(fails)), F.lit(0))

    return let(counted, mask)


def masks(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    hashed: Hash = F.xxhash64,
) -> DataFrame:
    """(``doc_id``, ``part``, ``mask``) of each document."""
    rows = documents.select(
        quoted(doc_id).alias("doc_id"),
        F.coalesce(quoted(source).cast("string"), F.lit("")).alias("part"),
        F.coalesce(quoted(text).cast("string"), F.lit("")).alias("text"),
    ).withColumn("hash", hashed(F.col("text")))
    repeated = F.lit(1 << (len(FILTERS) - 1))
    slim = written(rows.select("doc_id", "part", "hash", text_mask(F.col("text")).alias("mask")), "masks")

    possible = Repeats(slim).among(rows.select("doc_id", "text", "hash"))
    ends = F.min("doc_id").alias("first"), F.max("doc_id").alias("last")
    texts = written(possible.groupBy("hash", "text").agg(*ends).select("hash", "first", "last"), "repeats")
    found = texts.groupBy("hash").agg(
        F.count(F.lit(1)).alias("texts"), F.min("first").alias("first"), F.max("last").alias("last")
    )
    found = written(found.where((F.col("texts") > 1) | (F.col("first") < F.col("last"))), "repeated-hashes")

    one = small_enough(written(found.where("texts = 1").select("hash", "first"), "first-ids"))
    shared = small_enough(written(found.where("texts > 1").select("hash"), "shared-hashes"))
    later = F.when(F.col("first") < F.col("doc_id"), F.col("mask") + repeated).otherwise(F.col("mask"))
    if shared.isEmpty():
        return slim.join(one, "hash", "left").select("doc_id", "part", later.alias("mask"))
    # Different texts under one hash: those rows go by their texts.
    alone = slim.join(shared, "hash", "left_anti").join(one, "hash", "left")
    full = rows.join(shared, "hash", "left_semi")
    firsts = written(full.groupBy("text").agg(F.min("doc_id").alias("first")), "first-ids-of-texts")
    by_text = full.withColumn("mask", text_mask(F.col("text"))).join(firsts, "text")
    return alone.unionByName(by_text, allowMissingColumns=True).select("doc_id", "part", later.alias("mask"))


def mask_counts(marked: DataFrame, labels: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """(``part``, ``mask``, ``n``, ``good``, ``toxic``): documents, and those labelled so."""
    known = labels.groupBy(quoted(doc_id).alias("labelled")).agg(
        F.coalesce(F.bool_or(F.col("quality") == 1), F.lit(False)).alias("is_good"),
        F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).alias("is_toxic"),
    )
    known = small_enough(written(known.where("labelled is not null and (is_good or is_toxic)"), "audit-labels"))
    joined = marked.join(known, marked["doc_id"] == known["labelled"], "left")
    return joined.groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("is_good").alias("good"), F.count_if("is_toxic").alias("toxic")
    )


def _orders(filters: str) -> list[tuple[int, int, str, int]]:
    """(filters before it as a mask, the filter's bit, order, step) of each step of each order."""
    found = []
    for order in itertools.permutations(range(len(filters))):
        before = 0
        for step, k in enumerate(order):
            found.append((before, 1 << k, "".join(filters[i] for i in order), step + 1))
            before |= 1 << k
    return found


def audit(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """A row for each part, order of the filters and step, from ``mask_counts``."""
    spark = counts.sparkSession
    orders = _orders(filters)
    n = len(filters)
    steps = sorted({(before, bit) for before, bit, _, _ in orders})
    exploded = counts.withColumn(
        "at",
        F.explode(F.array(*(F.struct(F.lit(s).alias("before"), F.lit(b).alias("bit")) for s, b in steps))),
    ).select("*", "at.before", "at.bit")
    mask, before, bit = F.col("mask"), F.col("before"), F.col("bit")
    fails = mask.bitwiseAND(bit) != 0
    gone = mask.bitwiseAND(before) != 0

    def total(condition: Column, of: str = "n") -> Column:
        return F.sum(F.when(condition, F.col(of)).otherwise(0)).cast("bigint")

    by_set = exploded.groupBy("part", "before", "bit").agg(
        total(~fails & ~gone).alias("kept"),
        total(fails & ~gone).alias("removed"),
        total(fails & gone).alias("redundant"),
        total(mask == bit).alias("unique_fails"),
        total(fails & ~gone, "good").alias("good_lost"),
        total(fails & ~gone, "toxic").alias("toxic_lost"),
    )
    weights = [math.factorial(k) * math.factorial(n - 1 - k) for k in range(n)]
    weight = F.element_at(F.array(*map(F.lit, weights)), F.bit_count("before") + 1)
    shapley = F.sum(weight * F.col("removed")).over(W.partitionBy("part", "bit")).cast("bigint")
    table = spark.createDataFrame(orders, "before int, bit int, filter_order string, step int")
    return (
        by_set.withColumn("shapley", shapley)
        .join(F.broadcast(table), ["before", "bit"])
        .select(
            "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost",
            "toxic_lost", "shapley",
        )
    )
