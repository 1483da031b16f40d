import itertools
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from strataline.llm import interactions
from strataline.llm.sketch import Repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LABELS = "doc_id long, quality int, toxic int"


def brute(docs, labels):
    """docs: (doc_id, text, source); labels: (doc_id, quality, toxic)."""
    first, good, toxic = {}, set(), set()
    for d, t, _ in docs:
        if d is not None:
            first[t or ""] = min(d, first.get(t or "", d))
    for d, q, x in labels:
        good |= {d} if q == 1 and d is not None else set()
        toxic |= {d} if x == 1 and d is not None else set()
    failed = []
    for d, t, s in docs:
        t = t or ""
        words = WORD.findall(t)
        fails = {
            "A": len(words) < 50,
            "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)),
            "E": d is not None and first[t] < d,
        }
        failed.append((s or "", {k for k, v in fails.items() if v}, d in good, d in toxic))
    orders = ["".join(o) for o in itertools.permutations("ABCDE")]
    rows, removed_in_all = {}, {}
    for part in {p for p, *_ in failed}:
        mine = [x[1:] for x in failed if x[0] == part]
        for order in orders:
            for k, own in enumerate(order):
                before = set(order[:k])
                here = [x for x in mine if own in x[0] and not x[0] & before]
                removed_in_all[part, own] = removed_in_all.get((part, own), 0) + len(here)
                rows[part, order, k + 1] = (
                    sum(not x[0] & (before | {own}) for x in mine),
                    len(here),
                    sum(own in x[0] and bool(x[0] & before) for x in mine),
                    sum(x[0] == {own} for x in mine),
                    sum(x[1] for x in here),
                    sum(x[2] for x in here),
                )
    return {k: (*v, removed_in_all[k[0], k[1][k[2] - 1]]) for k, v in rows.items()}


def found(documents, labels, **how):
    rows = interactions.audit(interactions.mask_counts(interactions.masks(documents, **how), labels)).collect()
    assert len({r[:3] for r in rows}) == len(rows)
    return {tuple(r[:3]): tuple(r[3:]) for r in rows}


def random_texts():
    rng = random.Random(11)
    words = ["Aa", "bb", "cc", "d#d", "EE", "ff", "\x1cx", "é"] + [f"w{k}" for k in range(60)]
    texts = [" ".join(rng.choices(words[: rng.choice((5, 20, 68))], k=rng.choice((0, 49, 50, 80)))) for _ in range(80)]
    return texts + rng.choices(texts, k=120) + [texts[0]] * 100


@pytest.mark.parametrize("hashed", [F.xxhash64, lambda t: F.pmod(F.xxhash64(t), F.lit(9)), lambda t: F.lit(3)])
def test_agrees_with_brute_force_also_where_texts_share_a_hash(spark, hashed):
    rng = random.Random(5)
    texts = random_texts()
    rows = [(rng.randrange(250), t, rng.choice(["x", "y", None])) for t in texts] + [(None, texts[0], "x"), (7, None, "y")]
    labels = [(rng.choice([None, *range(250)]), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(150)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    marks = spark.createDataFrame(labels + labels[:9], LABELS)
    assert found(documents, marks, hashed=hashed) == brute(rows, labels)


def test_awkward_documents(spark, awkward, nothing):
    rows = [(r.doc_id, r.text, r.source) for r in awkward.collect()]
    none = spark.createDataFrame([], LABELS)
    assert found(awkward, none) == brute(rows, [])
    assert found(nothing, none) == {}


def test_values_add_up(spark, docs):
    documents = docs(random_texts(), [f"s{k % 3}" for k in range(300)])
    rows = interactions.audit(interactions.mask_counts(interactions.masks(documents), spark.createDataFrame([], LABELS)))
    last = rows.where("step = 5").groupBy("part").agg(F.count_distinct("kept").alias("n"), F.first("kept").alias("kept"))
    left = {r.part: r.kept for r in last.collect() if r.n == 1}
    fair = rows.where("filter_order = 'ABCDE'").groupBy("part").agg(F.sum("shapley").alias("s")).collect()
    assert len(left) == 3
    assert all(r.s == math.factorial(5) * (100 - left[r.part]) for r in fair)


def test_sketch_clears_only_what_occurs_once(spark):
    rows = spark.range(0, 40_000, 1, 9).select(F.xxhash64("id").alias("hash"))
    twice = rows.where("pmod(hash, 50) = 0")
    hot = spark.range(0, 5000, 1, 7).select(F.lit(77).cast("long").alias("hash"))
    null = spark.range(0, 3).select(F.lit(None).cast("long").alias("hash"))
    everything = rows.unionAll(twice).unionAll(hot).unionAll(null)
    repeats = Repeats(everything)
    assert repeats.segments > 4
    once = everything.groupBy("hash").count().where("count = 1").count()
    cleared = repeats.cleared(everything)
    assert cleared.groupBy("hash").count().join(everything.groupBy("hash").count().where("count > 1"), "hash").isEmpty()
    assert cleared.where("hash is null or hash = 77").isEmpty()
    assert 0.95 * once <= cleared.count() <= once
    assert cleared.count() + repeats.among(everything).count() == everything.count()
    assert Repeats(everything.limit(0)).among(everything).isEmpty()
