import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strataline.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = "text string, lang string, source string"


def brute(rows, least=3, top=200):
    rows = [(t or "", l or "", s or "") for t, l, s in rows]
    small = {c: c + 32 for c in range(65, 91)}
    out = set()
    for lang in {r[1] for r in rows}:
        docs, count = Counter(), {r[2]: Counter() for r in rows if r[1] == lang}
        for t, l, s in rows:
            if l == lang:
                found = TERM.findall(t.translate(small))
                docs.update(set(found))
                count[s].update(found)
        kept = [t for t, n in docs.items() if n >= least]
        total = {s: sum(c[t] for t in kept) for s, c in count.items()}
        p = {s: {t: 1 + 10**9 * (c[t] + 1) // (total[s] + len(kept)) for t in kept} for s, c in count.items()}
        both = {t: sum(c[t] for c in count.values()) for t in kept}
        q = {t: 1 + 10**9 * (both[t] + 1) // (sum(both.values()) + len(kept)) for t in kept}
        f = lambda a, b: (a - b) ** 2 // b
        for s in count:
            pairs = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in count if o != s]
            above = [(t, f(p[s][t], q[t])) for t in kept if count[s][t] and p[s][t] > q[t]]
            for part, items in (("pair", pairs), ("term", above)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                limit = top if part == "term" else len(items)
                out |= {(lang, s, part, i, v, k) for k, (i, v) in enumerate(items[:limit], 1)}
    return out


def found(frame, **how):
    rows = [tuple(r) for r in divergence.audit(frame, **how).collect()]
    assert len(set(rows)) == len(rows)
    return set(rows)


def random_rows():
    rng = random.Random(4)
    words = ["The", "the", "a1b", "É", "é", "x-y", "ß", "漢字"] + [f"w{chr(97 + k)}" for k in range(26)]
    made = []
    for _ in range(150):
        text = " ".join(rng.choices(words, k=rng.randrange(30)))
        made.append((text, rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "S3", "ü", None])))
    copies = [(rng.choice(made)[0], rng.choice(["en", "de"]), rng.choice(["s1", "s4", "s5"])) for _ in range(100)]
    return made + copies + [made[0]] * 300 + [("only here", "xx", "s1"), (None, "en", "empty"), ("", "yy", "a"), ("1", "yy", "b")]


@pytest.mark.parametrize("block", [256, 2])
def test_agrees_with_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(divergence, "BLOCK", block)
    monkeypatch.setattr(divergence, "MATRICES", 2)
    rows = random_rows()
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(frame, top=7) == brute(rows, top=7)


def test_counts_given_out_early_add_up(spark, monkeypatch):
    monkeypatch.setattr(divergence, "HELD", 40)
    monkeypatch.setattr(divergence, "CELLS", 4)
    rows = random_rows()
    assert found(spark.createDataFrame(rows, SCHEMA).repartition(3)) == brute(rows)


def test_many_sources(spark):
    rng = random.Random(9)
    rows = [(" ".join(rng.choices("abcdefgh", k=5)), "en", f"s{k % 300:03d}") for k in range(600)]
    assert found(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_shares_of_large_counts_are_exact(spark):
    counts = [0, 1, 8_999_999_998, 8_999_999_999, 9_000_000_000, 10**15, 4 * 10**17]
    frame = spark.createDataFrame([(n, t, v) for n in counts for t in (n, n + 7, 5 * 10**17) for v in (1, 10**8)], "n long, t long, v long")
    for r in frame.select("*", divergence.share(F.col("n"), F.col("t"), F.col("v")).alias("p")).collect():
        assert r.p == 1 + 10**9 * (r.n + 1) // (r.t + r.v)


def test_awkward_documents(awkward, nothing):
    rows = [(r.text, r.lang, r.source) for r in awkward.collect()]
    assert found(awkward) == brute(rows)
    assert found(awkward, least=1) == brute(rows, least=1)
    assert found(nothing) == set()
