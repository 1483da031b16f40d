import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strataline.llm import mixing


def by_rounds(sizes, weights, share=1.5):
    """Give the excess of stopped sources to the others until none is above."""
    target, stopped = {}, set()
    total = share * sum(sizes)
    while True:
        left = total - sum(2 * sizes[k] for k in stopped)
        free = [k for k in range(len(sizes)) if k not in stopped]
        part = sum(weights[k] for k in free)
        target = {k: left * weights[k] / part for k in free} if free else {}
        over = {k for k in free if target[k] >= 2 * sizes[k]}
        if not over:
            return [target.get(k, 2 * sizes[k]) for k in range(len(sizes))]
        stopped |= over


@pytest.mark.parametrize("sizes", [[100, 100, 100], [1, 500, 20, 7, 300, 0], [0, 0], [10_000, 1, 1, 1, 1, 1, 9_000], [5]])
def test_targets_agree_with_rounds(spark, sizes):
    names = [chr(97 + k) for k in range(len(sizes) - 1)] + [None]
    totals = spark.createDataFrame(list(zip(names, sizes, strict=True)), "source string, words long")
    rows = mixing.targets(totals).orderBy("number").collect()
    weights = [(5, 2, 1)[k % 3] for k in range(len(sizes))]
    assert [r.source for r in rows] == names and [r.weight for r in rows] == weights
    assert [r.target for r in rows] == pytest.approx(by_rounds(sizes, weights))


def test_draws_follow_the_distribution(spark):
    n, kind, drawn, tries = 20, 8, 10, 20_000
    u = mixing._draw(1, F.col("id"))
    arguments = [F.lit(x).cast("long") for x in (n, kind, drawn)]
    counts = dict(spark.range(tries).select(mixing.hypergeometric(*arguments, u).alias("k")).groupBy("k").count().collect())
    for k in range(9):
        p = math.comb(kind, k) * math.comb(n - kind, drawn - k) / math.comb(n, drawn)
        assert abs(counts.get(k, 0) / tries - p) < 0.02


def test_quotas_are_split_exactly(spark):
    quotas = [1000, 0, 1, 37, 12_345]
    root = spark.createDataFrame([(quotas,)], "quotas array<long>")
    leaves = mixing.split_quotas(root, 4).collect()
    assert sorted(r.shard for r in leaves) == list(range(16))
    assert [sum(r.quotas[k] for r in leaves) for k in range(5)] == quotas
    assert min(min(r.quotas) for r in leaves) >= 0
    sizes = [sum(r.quotas) for r in leaves]
    assert max(sizes) - min(sizes) <= 4


def test_mix_meets_its_targets(spark, docs):
    texts = [" ".join("w" for _ in range(1 + k % 13)) + f" {k}" for k in range(900)]
    sources = [None if k % 3 == 0 else f"s{k % 7}" if k % 2 else "hot" for k in range(900)]
    frame = docs(texts, sources)
    mix = mixing.plan_mix(frame, block_words=64, shard_words=500)
    got = mixing.taken(mix).join(frame.select("doc_id", "source"), "doc_id").collect()
    assert len(got) == 900 and all(r["size"] == len(texts[r.doc_id].split()) for r in got)
    assert all(r.taken % r["size"] == 0 and r.taken <= 2 * r["size"] for r in got)
    for name in {r.source for r in got}:
        own = [r for r in got if r.source == name]
        assert sum(r["size"] for r in own) == own[0].source_size
        assert abs(sum(r.taken for r in own) - own[0].target) <= 14
    again = mixing.taken(mixing.plan_mix(frame.repartition(5), block_words=64, shard_words=500))
    assert Counter(map(tuple, again.collect())) == Counter(map(tuple, mixing.taken(mix).collect()))
    rows = mixing.mixed(frame, mix).collect()
    times = Counter(r.doc_id for r in rows)
    assert {r.doc_id: r.taken // r["size"] for r in got if r.taken} == dict(times)
    assert len({r.mix_shard for r in rows}) > 4
    by_shard = mix.copies.groupBy("shard").count().collect()
    assert max(r["count"] for r in by_shard) - min(r["count"] for r in by_shard) <= 5


def test_empty_texts_come_no_oftener_than_others(docs):
    """A source that is taken twice: its block of empty texts too, and not a third time."""
    texts = ["w " * 500] * 3 + ["x"] * 2 + [""] * 5
    frame = docs(texts, ["big"] * 3 + ["small"] * 7)
    times = Counter(r.doc_id for r in mixing.mixed(frame, mixing.plan_mix(frame, block_words=1)).collect())
    assert all(times[k] == 2 for k in range(3, 10))
    only = docs(["", "", None], ["a", "a", "b"])
    assert sorted(r.doc_id for r in mixing.mixed(only, mixing.plan_mix(only)).collect()) == [0, 1, 2]


def test_ranges_parts_and_stages_change_nothing(docs, monkeypatch):
    texts = [" ".join("w" for _ in range(1 + k % 13)) + f" {k}" for k in range(500)]
    frame = docs(texts, [f"s{k % 3}" for k in range(500)])

    def mix():
        made = mixing.plan_mix(frame, block_words=16, shard_words=60)
        return Counter(map(tuple, mixing.taken(made).collect())), Counter(map(tuple, made.copies.collect()))

    whole = mix()
    assert len({copy[2] for copy in whole[1]}) > 32
    monkeypatch.setattr(mixing, "RANGE", 3)
    monkeypatch.setattr(mixing, "DEAL_BITS", 3)
    monkeypatch.setattr(mixing, "LEVELS_AT_ONCE", 2)
    assert mix() == whole


def test_awkward_documents(awkward, nothing):
    mix = mixing.plan_mix(awkward)
    rows = mixing.taken(mix).collect()
    assert len(rows) == awkward.count()
    assert sum(r["size"] for r in rows if r.doc_id == 4) == 100_000
    mixed = mixing.mixed(awkward, mix)
    assert mixed.columns == [*awkward.columns, "mix_shard_", "mix_place_"]
    assert all(r.taken <= 2 * r["size"] for r in rows)
    words = re.compile(r"[^\x20\x09-\x0D]+")
    in_mix = sum(len(words.findall(r.text or "")) for r in mixed.select("text").collect())
    assert in_mix == sum(r.taken for r in rows)
    empty = mixing.plan_mix(nothing)
    assert mixing.taken(empty).collect() == [] and mixing.mixed(nothing, empty).collect() == []
