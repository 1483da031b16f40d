"""Bounded samples of labelled documents, and the fold that is held out of all fits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataline.llm.common import quoted

FOLDS = 5
SAMPLE = 2_000
"""Documents of each class in a sample, at most."""
SAMPLE_BYTES = 1 << 14
"""Longer texts are left out of samples, so a sample has at most 2 * SAMPLE * SAMPLE_BYTES bytes."""


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS)) == 0


def labelled_sample(
    documents: DataFrame,
    labels: DataFrame,
    label: str,
    doc_id: str = "doc_id",
    text: str = "text",
    per_class: int = SAMPLE,
    most_bytes: int = SAMPLE_BYTES,
) -> tuple[list[bytes], list[bytes], float]:
    """Texts labelled 1, texts labelled 0, and the share of 1 among all labels that may be learned from.

    Learned from are labels of ids outside the held-out fold. Of each class the
    ids with the smallest hashes are taken; their texts are found by one scan of the
    documents with a broadcast of these few ids.
    """
    usable = labels.select(quoted(doc_id).alias("id"), quoted(label).cast("int").alias("label")).where(
        F.col("id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("id"))
    ).distinct()
    counts = dict(usable.groupBy("label").count().collect())
    total = sum(counts.values())
    share = counts.get(1, 0) / total if total else 0.5
    order = F.xxhash64(F.lit(label), "id")
    ids = [
        usable.where(F.col("label") == value).orderBy(order, "id").limit(per_class).select("id", "label")
        for value in (1, 0)
    ]
    chosen = F.broadcast(ids[0].unionAll(ids[1]).withColumnRenamed("id", "labelled_id"))
    texts = documents.select(quoted(doc_id).alias("id"), quoted(text).cast("string").alias("text")).where(
        F.col("text").isNotNull() & (F.octet_length("text") <= most_bytes)
    )
    found = (
        texts.join(chosen, F.col("id") == F.col("labelled_id"))
        .orderBy(F.xxhash64(F.lit(label), "id"), "id", "text", "label")
        .select("text", "label")
        .limit(2 * per_class)
        .collect()
    )
    return (
        [r.text.encode() for r in found if r.label == 1],
        [r.text.encode() for r in found if r.label == 0],
        share,
    )
