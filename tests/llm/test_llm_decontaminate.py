import random
import re
import string
from collections import Counter

import numpy as np
import pytest

from strataline.llm import decontaminate
from strataline.llm.common import ROW
from strataline.llm.decontaminate import clean_documents, find_matches, suffix_array

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(texts, items, window):
    out = []
    for text in texts:
        own, hit, named = words(text), set(), set()
        for name, item in items:
            item = words(item)
            size = min(window, len(item))
            runs = {tuple(item[k : k + size]) for k in range(len(item) - size + 1)} if item else set()
            for k in range(len(own) - size + 1):
                if tuple(own[k : k + size]) in runs:
                    hit |= set(range(k, k + size))
                    named |= {str(name)} if name is not None else set()
        out.append((len(own), len(hit), sorted(named)))
    return out


def benchmark(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def found(frame):
    rows = frame.select(f"{ROW}.doc_id", "n_words", "n_hit", "items").orderBy("doc_id").collect()
    return [(r.n_words, r.n_hit, list(r["items"])) for r in rows]


@pytest.mark.parametrize(("shard", "block"), [(1 << 20, 1 << 20), (30, 1 << 20), (1 << 20, 12), (7, 5)])
def test_matches_agree_with_brute_force(spark, docs, shard, block):
    rng = random.Random(shard + block)
    texts = [" ".join(rng.choice("abC") for _ in range(rng.randrange(60))) for _ in range(40)] + [None, "", "é É-é"]
    items = [(k, " ".join(rng.choice("ABc") for _ in range(rng.randrange(12)))) for k in range(14)]
    items += [(3, "a b c a"), (None, "b b b c c"), (99, None), (98, "é É é")]
    got = found(find_matches(docs(texts), benchmark(spark, items), window=4, shard_words=shard, block_words=block))
    assert got == brute(texts, items, 4)


def test_longest_match_and_its_place(spark, docs):
    item = " ".join(f"w{k}" for k in range(30))
    text = "x y " + " ".join(f"w{k}" for k in range(5, 27)) + " z " + " ".join(f"w{k}" for k in range(13))
    row = find_matches(docs([text]), benchmark(spark, [(7, item)])).first()
    assert [tuple(m) for m in row.matches] == [("7", 5, 2, 22)]
    assert row.n_hit == 35


@pytest.mark.parametrize("at_once", [1, 2, 7, 40])
def test_matches_are_whole_however_places_are_dealt(monkeypatch, at_once):
    """One item with very many places: its longest matches as in one piece."""
    rng = random.Random(at_once)
    items = [("a", b"x y " * 9 + b"z " + b"x y " * 4), ("b", b"y x y x z x y x y x")]
    block = decontaminate.Block(items, 4)
    texts = [" ".join(rng.choice(["x y", "x y", "x y", "z", "q"]) for _ in range(80)).encode() for _ in range(6)]
    whole = list(block.scan(texts, [[]] * 6, 1 << 20))
    monkeypatch.setattr(decontaminate, "PLACES_AT_ONCE", at_once)
    dealt = list(block.scan(texts, [[]] * 6, 1 << 20))
    sizes = [{(m[0], m[3]) for m in found} for _, _, found in whole]
    assert [{(m[0], m[3]) for m in found} for _, _, found in dealt] == sizes and any(sizes)
    assert [x[:2] for x in dealt] == [x[:2] for x in whole]
    for text, (_, _, found) in zip(texts, dealt, strict=True):
        for name, item_start, start, size in found:
            item = dict(items)[name].split()
            assert item[item_start : item_start + size] == text.split()[start : start + size]


def test_many_blocks_are_one_step(spark, docs):
    items = [(k, f"a{k} b c d e f g") for k in range(40)]
    found_ = find_matches(docs(["x a3 b c d e f g y", "b c d e f"]), benchmark(spark, items), window=4, block_words=30)
    text = found_._jdf.queryExecution().executedPlan().toString()
    assert text.count("MapInArrow") == 1
    assert [r[2] for r in found(found_)][0] == sorted(map(str, range(40)))


def test_suffix_array_is_in_order():
    rng = np.random.default_rng(2)
    for high in (2, 3, 50, 70_000):
        words_ = rng.integers(0, high, 400)

        def suffix(at, words_=words_):
            end = np.flatnonzero(words_[at:] == 0)
            return tuple(words_[at : at + end[0]] if len(end) else words_[at:])

        order = suffix_array(words_)
        assert Counter(order.tolist()) == Counter(np.flatnonzero(words_).tolist())
        runs = [suffix(k) for k in order]
        assert runs == sorted(runs)


def test_clean_documents_keep_their_columns(spark, awkward, nothing):
    items = benchmark(spark, [(1, " ".join(f"p{k}" for k in range(20)))])
    clean = clean_documents(awkward, items)
    assert clean.schema == awkward.schema
    assert sorted(r.doc_id or 0 for r in clean.collect()) == [0, 1, 2, 3, 4, 5, 6]
    assert clean_documents(awkward, items.limit(0)).count() == awkward.count()
    assert clean_documents(nothing, items).collect() == []
