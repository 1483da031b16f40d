import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from strataline.llm import simhash
from strataline.llm.components import components


def naive(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", words)]
    if not words:
        return 0
    runs = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_follow_the_definition(monkeypatch):
    monkeypatch.setattr(simhash, "SHINGLES_AT_ONCE", 5)
    rng = random.Random(1)
    texts = [" ".join(rng.choice(["Aa", "b", "É", "c d"]) for _ in range(n)) for n in (0, 1, 2, 3, 4, 7, 8, 30)]
    for text in [*texts, None, "a\tB\x0bc\r\nd"]:
        assert simhash.fingerprint(text and text.encode()) % (1 << 64) == naive(text)


def clusters(n, seed):
    """Codes in chains and balls, with far ones between."""
    rng = random.Random(seed)
    codes = {0, (1 << 64) - 1}
    while len(codes) < n:
        code = rng.getrandbits(64)
        for _ in range(rng.randrange(1, 12)):
            codes.add(code)
            code ^= sum(1 << b for b in rng.sample(range(64), rng.randrange(1, 5)))
    return sorted(codes)


def brute(codes):
    root = {c: c for c in codes}

    def find(c):
        while root[c] != c:
            c = root[c]
        return c

    for a in codes:
        for b in codes:
            if a < b and (a ^ b).bit_count() <= 3:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {c: find(c) for c in codes}


@pytest.mark.parametrize("limit", [1 << 15, 3])
def test_components_agree_with_brute_force(spark, limit):
    codes = clusters(300, limit)
    # Far beyond the limit in one group: all codes near one that differ in few low bits.
    codes = sorted({*codes, *(0xABCD << 48 | k for k in range(0, 256, 3))})
    signed = [c - (1 << 64) if c >> 63 else c for c in codes]
    frame = spark.createDataFrame([(c, k) for k, c in enumerate(signed)], "fingerprint long, doc_id long")
    got = {r.fingerprint % (1 << 64): r.component_id for r in simhash.near_duplicates(frame, F.col("doc_id"), limit).collect()}
    by_root = {}
    for code, root in brute(codes).items():
        by_root.setdefault(root, []).append(codes.index(code))
    expected = {codes[k]: min(members) for members in by_root.values() for k in members}
    assert got == expected


def test_gray_neighbours_stand_together(spark):
    ranks = spark.range(8).select(simhash.gray_rank(F.col("id").bitwiseXOR(F.shiftright("id", 1)))).collect()
    assert [r[0] for r in ranks] == list(range(8))


def test_index_over_one_group():
    codes = np.array(clusters(2000, 5), np.uint64)
    root = simhash.linked(np.zeros(len(codes), np.int64), codes)
    expected = brute([int(c) for c in codes])
    assert [int(codes[r]) for r in root] == [expected[int(c)] for c in codes]


def test_long_chain_is_one_component(spark):
    links = spark.range(200).selectExpr("id as a", "id + 1 as b").union(spark.createDataFrame([(5, 5), (None, 3)], "a long, b long"))
    found = components(links).collect()
    assert len(found) == 201 and {r.root for r in found} == {0}
    assert components(links.limit(0)).collect() == []


def test_one_document_of_each_group_stays(spark, awkward, nothing):
    kept = simhash.drop_near_duplicates(awkward)
    assert kept.schema == awkward.schema
    # Nulls and empty texts are one group, the prose another; equal rows lose all but one.
    assert sorted((r.doc_id, (r.text or "")[:5]) for r in kept.collect()) == [
        (1, ""), (4, awkward.where("doc_id = 4").first().text[:5]), (5, "other"), (5, "p0 p1"), (6, "é ünï"),
    ]
    assert simhash.drop_near_duplicates(nothing).collect() == []
    assert simhash.near_duplicates(
        simhash.with_fingerprints(nothing).select("fingerprint"), F.lit(1).cast("long")
    ).collect() == []
