"""Repeated line runs by a distributed suffix array over line ids.

Lines with a word are the letters, named by a 128-bit hash. Prefix doubling ranks
ever longer runs: the rank of ``2h`` lines from a place follows from the ranks of
its two halves. Only places whose run occurs at least twice keep a rank, as all
others end their interval of common prefixes; lines that occur once, and
stretches of repeated lines with fewer than ``min_words`` words, drop out first.
Ranks keep the order of the suffixes: they number the distinct pairs of ranks,
sorted over range partitions.

A run of ``k`` lines is named by the ranks of its first and its last ``h`` lines,
``h`` the power of two below: two places with the same name stand in one interval
of the array whose common prefix reaches ``k``. It is enough to compare, from each
line forwards and backwards, the shortest run with ``min_words`` words: every
repeated run with that many words is a union of such runs. As each line has a
word, they have at most ``min_words`` lines, so there are few rounds, however long
the documents are.

Of places with the same name the first, by document id, then hash of the text,
then line, stays; the lines of all later ones go. Where a run overlaps its own
first place, only lines beyond that place go.

Defined results: null texts have no lines; lines without a word are neither
compared nor deleted; nulls among the ids come last; rows with the same id and
text are one document, whose further copies lose all lines if it has
``min_words`` words; no documents give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strataline.llm.common import ROW, keep_one_of_equal, let, packed, quoted, small_enough, space_words, written

MIN_WORDS = 50
KEY = ["doc_id", "hash"]
WORD = r"[^\x20\x09-\x0D]"


def text_hash(text: Column) -> Column:
    return F.xxhash64(F.lit(8), F.coalesce(text, F.lit("")), text.isNull())


def _content(text: Column) -> Column:
    """The lines with a word: two hashes and the number of words of each."""
    lines = F.transform(
        F.split(F.coalesce(text, F.lit("")), "\n"),
        lambda line: F.struct(
            F.xxhash64(line).alias("a"),
            F.xxhash64(F.lit("b"), line).alias("b"),
            F.size(space_words(line)).alias("words"),
        ),
    )
    return F.filter(lines, lambda line: line["words"] > 0)


def _ranked(repeated: DataFrame, *by: str) -> DataFrame:
    """Number distinct keys in their order."""
    ordered = repeated.repartitionByRange(*by).sortWithinPartitions(*by)
    return written(ordered.select(*by, F.monotonically_increasing_id().alias("rank")), "lines-ranks")


def _twice(frame: DataFrame, *by: str) -> DataFrame:
    return frame.groupBy(*by).count().where(F.col("count") > 1).select(*by)


def line_table(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each line with a word, and one for each document without."""
    return written(
        documents.select(
            quoted(doc_id).alias("doc_id"),
            text_hash(quoted(text)).alias("hash"),
            F.posexplode_outer(_content(quoted(text))).alias("line", "content"),
        ).select(*KEY, "line", "content.*"),
        "lines",
    )


def _stretches(lines: DataFrame, min_words: int) -> DataFrame:
    """Repeated lines in stretches of enough words, with the shortest runs from and to each."""
    found = lines.where(F.col("line").isNotNull())
    ranks = _ranked(_twice(found, "a", "b"), "a", "b")
    document = W.partitionBy(*KEY)
    stretch = W.partitionBy(*KEY, "stretch")
    in_order = stretch.orderBy("line").rowsBetween(W.unboundedPreceding, 0)
    reach = min_words - 1
    forwards = stretch.orderBy("before").rangeBetween(0, reach)
    backwards = stretch.orderBy("up_to").rangeBetween(-reach, 0)
    return written(
        found.join(ranks, ["a", "b"])
        .select(*KEY, "line", "words", "rank")
        .repartition(*KEY)
        .dropDuplicates([*KEY, "line"])
        .withColumn("stretch", F.col("line") - F.row_number().over(document.orderBy("line")))
        .withColumn("total", F.sum("words").over(stretch))
        .where(F.col("total") >= min_words)
        .withColumn("up_to", F.sum("words").over(in_order))
        .withColumn("before", F.col("up_to") - F.col("words"))
        .withColumn("end", F.max("line").over(forwards))
        .withColumn("end_words", F.max("up_to").over(forwards) - F.col("before"))
        .withColumn("start", F.min("line").over(backwards))
        .withColumn("start_words", F.col("up_to") - F.min("before").over(backwards))
        .select(
            *KEY,
            "line",
            "rank",
            F.when(F.col("end_words") >= min_words, F.col("end") - F.col("line") + 1).alias("forwards"),
            F.when(F.col("start_words") >= min_words, F.col("line") - F.col("start") + 1).alias("backwards"),
        ),
        "lines-stretches",
    )


def suffix_ranks(stretches: DataFrame, longest: int) -> DataFrame:
    """(document, ``line``, ``h``, ``rank``): ranks of the runs of ``h`` lines, for each power of two."""
    level = stretches.select(*KEY, "line", "rank")
    ranks, h = level.withColumn("h", F.lit(1)), 1
    while 2 * h <= longest:
        ahead = W.partitionBy(*KEY).orderBy("line").rangeBetween(h, h)
        pairs = level.withColumn("second", F.first("rank").over(ahead)).where(F.col("second").isNotNull())
        pairs = pairs.withColumnRenamed("rank", "first")
        found = _ranked(_twice(pairs, "first", "second"), "first", "second")
        level = written(
            pairs.join(found, ["first", "second"]).select(*KEY, "line", "rank"), "lines-level"
        )
        h *= 2
        ranks = ranks.unionByName(level.withColumn("h", F.lit(h)))
    return ranks


def _place(*more: str) -> Column:
    return F.struct(F.col("doc_id").isNull().alias("no_id"), *KEY, *more)


def later_runs(lines: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(document, ``start``, ``k``, ``first``): runs of the least length that an earlier place has too, and the first such place."""
    stretches = _stretches(lines, min_words)
    longest = stretches.agg(F.greatest(F.max("forwards"), F.max("backwards"))).first()[0] or 0
    ranks = suffix_ranks(stretches, longest)
    runs = (
        stretches.where(F.col("forwards").isNotNull())
        .select(*KEY, F.col("line").alias("start"), F.col("forwards").alias("k"))
        .unionByName(
            stretches.where(F.col("backwards").isNotNull()).select(
                *KEY, (F.col("line") - F.col("backwards") + 1).alias("start"), F.col("backwards").alias("k")
            )
        )
        .distinct()
        .withColumn("h", F.pow(2, F.floor(F.log2("k"))).cast("int"))
    )
    head = ranks.select(*(F.col(c).alias(f"head_{c}") for c in (*KEY, "line", "h")), F.col("rank").alias("head"))
    tail = ranks.select(*(F.col(c).alias(f"tail_{c}") for c in (*KEY, "line", "h")), F.col("rank").alias("tail"))

    def at(side: str, line: Column) -> Column:
        return (
            F.col("doc_id").eqNullSafe(F.col(f"{side}_doc_id"))
            & (F.col("hash") == F.col(f"{side}_hash"))
            & (line == F.col(f"{side}_line"))
            & (F.col("h") == F.col(f"{side}_h"))
        )

    named = written(
        runs.join(head, at("head", F.col("start")))
        .join(tail, at("tail", F.col("start") + F.col("k") - F.col("h")))
        .select(*KEY, "start", "k", "head", "tail"),
        "lines-runs",
    )
    name = ["k", "head", "tail"]
    first = named.groupBy(*name).agg(F.min(_place("start")).alias("first"), F.count("*").alias("n"))
    first = small_enough(written(first.where(F.col("n") > 1), "lines-first"))
    later = named.join(first, name).where(_place("start") != F.col("first"))
    return later.select(*KEY, "start", "k", "first")


def deleted_lines(lines: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(document, ``deleted``): the lines of each document that repeat an earlier run, sorted."""
    own = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("hash") == F.col("first.hash"))
    begin = F.when(own, F.greatest("start", F.col("first.start") + F.col("k"))).otherwise(F.col("start"))
    # Runs overlap: each adds the lines beyond those that reach farthest before it.
    before = W.partitionBy(*KEY).orderBy("begin", "end").rowsBetween(W.unboundedPreceding, -1)
    spans = later_runs(lines, min_words).select(*KEY, begin.alias("begin"), (F.col("start") + F.col("k") - 1).alias("end"))
    new = spans.withColumn("next", F.greatest("begin", F.max("end").over(before) + 1)).where(F.col("next") <= F.col("end"))
    return written(
        new.select(*KEY, F.explode(F.sequence("next", "end")).alias("line"))
        .groupBy(*KEY)
        .agg(F.array_sort(F.collect_list("line")).alias("deleted")),
        "lines-deleted",
    )


def repeated_runs(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """The maximal runs that an earlier place has too.

    A row has the document (``doc_id``, ``hash`` of its text), the run's ``start`` and number of
    ``lines``, and where the same lines come first (``first_doc_id``, ``first_hash``,
    ``first_start``). Runs of the least length that follow each other here and at their
    first place are one; where the first place changes to another document, a new run begins.
    """
    runs = later_runs(line_table(documents, doc_id, text), min_words).select(
        *KEY, "start", "k", F.col("first.doc_id").alias("first_doc_id"), F.col("first.hash").alias("first_hash"),
        F.col("first.start").alias("first_start"),
    )
    along = [*KEY, "first_doc_id", "first_hash", "shift"]
    shifted = runs.withColumn("shift", F.col("start") - F.col("first_start")).withColumn("end", F.col("start") + F.col("k"))
    order = W.partitionBy(*along).orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(W.unboundedPreceding, -1))
    begins = F.when(F.col("start") <= reach, 0).otherwise(1)
    numbered = shifted.withColumn("begins", begins).withColumn("run", F.sum("begins").over(order.rowsBetween(W.unboundedPreceding, 0)))
    return numbered.groupBy(*along, "run").agg(
        F.min("start").alias("start"), (F.max("end") - F.min("start")).alias("lines"), F.min("first_start").alias("first_start")
    ).drop("shift", "run")


def _same(left: DataFrame, right: DataFrame) -> Column:
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["hash"] == right["hash"])


def _units(lines: DataFrame) -> DataFrame:
    """Each document with its number of lines and words, and how many rows it has."""
    first = F.col("line").isNull() | (F.col("line") == 0)
    return lines.groupBy(*KEY).agg(
        F.coalesce(F.max("line") + 1, F.lit(0)).alias("n_lines"),
        F.sum(F.when(first, 1).otherwise(0)).alias("n"),
        F.coalesce(F.sum("words"), F.lit(0)).alias("all_words"),
    ).withColumn("n_words", F.floor(F.col("all_words") / F.col("n"))).drop("all_words")


def line_report(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """A row for each document row: ``doc_id``, ``n_lines``, and its ``deleted`` lines."""
    lines = line_table(documents, doc_id, text)
    deleted, units = deleted_lines(lines, min_words), _units(lines)
    none = F.array().cast("array<int>")
    rows = units.join(deleted, _same(units, deleted), "left").select(
        units["doc_id"], "n_lines", "n_words", "deleted", F.explode(F.sequence(F.lit(1).cast("bigint"), "n")).alias("copy")
    )
    every = F.when(F.col("n_lines") > 0, F.sequence(F.lit(0), F.col("n_lines") - 1)).otherwise(none)
    again = (F.col("copy") > 1) & (F.col("n_words") >= min_words)
    return rows.select(
        "doc_id", "n_lines", F.when(again, every).otherwise(F.coalesce("deleted", none)).alias("deleted")
    )


def remove_repeated_lines(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    n_chars: str | None = "n_chars",
    min_words: int = MIN_WORDS,
) -> DataFrame:
    """The documents without later copies of line runs, with their columns.

    Documents that lose all their lines go. ``n_chars`` follows the text, if there
    is such a column. Texts are looked up by id and hash, so a hot passage does not
    bring its documents together.
    """
    lines = line_table(documents, doc_id, text)
    deleted = deleted_lines(lines, min_words)
    repeated = _units(lines).where((F.col("n") > 1) & (F.col("n_words") >= min_words)).select(*KEY)
    rows = documents.select(*packed(documents, text))
    rows = rows.select(ROW, "text", F.col(ROW).getField(doc_id).alias("doc_id"), text_hash(F.col("text")).alias("hash"))
    rows = keep_one_of_equal(rows, written(repeated, "lines-equal"), KEY)
    changed = rows.join(small_enough(deleted), _same(rows, deleted), "left").select(ROW, "text", "deleted")
    rebuilt = changed.withColumn("left", F.when(F.col("deleted").isNotNull(), _without("text", "deleted")))
    rebuilt = rebuilt.where(F.col("deleted").isNull() | F.col("left.any"))
    new_text = F.when(F.col("deleted").isNull(), F.col("text")).otherwise(F.col("left.text"))
    out = []
    for name in documents.columns:
        value = new_text if name == text else F.col(ROW).getField(name)
        if name == n_chars:
            size = F.char_length(F.col("left.text")).cast(documents.schema[name].dataType)
            value = F.when(F.col("deleted").isNull(), value).otherwise(size)
        out.append(value.alias(name))
    return rebuilt.select(*out)


def _without(text: str, deleted: str) -> Column:
    """What is left of a text: the lines, and whether ``any`` has a word."""

    def rebuild(lines: Column) -> Column:
        numbered = F.transform(lines, lambda line, i: F.when(F.regexp_like(line, F.lit(WORD)), i))
        return let(
            F.filter(numbered, lambda i: i.isNotNull()),
            lambda content: let(
                F.array_except(
                    F.sequence(F.lit(0), F.size(lines) - 1), F.transform(deleted, lambda c: F.get(content, c))
                ),
                lambda stay: F.struct(
                    F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n").alias("text"),
                    (F.size(content) > F.size(deleted)).alias("any"),
                ),
            ),
        )

    return let(F.split(text, "\n"), rebuild)
