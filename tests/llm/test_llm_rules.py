import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strataline.llm import rules
from strataline.llm.common import let, space_words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def repeat_words(words):
    runs = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    n = Counter(runs)
    return len({k + j for k, r in enumerate(runs) if n[r] > 1 for j in range(5)})


def test_repeated_words_agree_with_brute_force(spark, docs):
    rng = random.Random(4)
    texts = [" ".join(rng.choice("ab" if k % 2 else "abcdefgh") for _ in range(k)) for k in range(40)]
    texts += ["x " * 500, None, "a\tb\n\x0bc  d e a b c d e"]
    frame = docs(texts)
    words = let(space_words(F.col("text")), lambda w: rules.n_repeat_words(w))
    got = [r[0] for r in frame.orderBy("doc_id").select(words).collect()]
    assert got == [repeat_words(WORD.findall(t or "")) for t in texts]


def test_counts(docs):
    row = docs(["a#b é\U0001f600|\n\n x\nx \nx\r\n x\n"])
    found = row.select(rules.counts(F.col("text")).alias("counts")).first().counts
    assert (found.n_words, found.word_chars, found.n_symbols, found.n_dup_lines) == (6, 10, 2, 1)


def test_order_does_not_change_what_is_kept(spark, docs):
    texts = ["one two three", "fine " * 3, "###### " * 20, "LOUD " * 30, "no! " * 20] + [
        " ".join(f"w{k * j % 97}" for j in range(60)) for k in range(1, 30)
    ]
    frame = docs(texts)
    all_rules = rules.production_rules()
    kept = []
    for order in (all_rules, all_rules[::-1]):
        rows = frame.withColumn("by", rules.cascade(order, rules.Text(F.col("text")))).collect()
        kept.append([r.doc_id for r in rows if r.by is None])
    assert kept[0] == kept[1]
    for report in (False, True):
        judged = rules.judged(frame, report=report).collect()
        assert [r.row.doc_id for r in judged if r.rejected_by is None] == kept[0]
    assert [r.doc_id for r in rules.keep_accepted(frame).collect()] == kept[0]


def test_the_cascade_goes_by_what_earlier_rules_leave(docs, monkeypatch):
    frame = docs(["a b c"] * 30 + ["a " * 40] * 10 + ["b " * 40] * 2).select("text")
    made = [
        rules.Rule("none", lambda t: t.text.isNull()),
        rules.Rule("short", lambda t: F.length(t.text) < 10),
        rules.Rule("short or b", lambda t: (F.length(t.text) < 10) | F.startswith(t.text, F.lit("b"))),
        rules.Rule("a", lambda t: F.startswith(t.text, F.lit("a"))),
    ]
    monkeypatch.setattr(rules.time, "perf_counter", lambda: 0.0)  # all cost the same
    found = rules.estimates(frame, made, sample_rows=100)
    assert [(e.rule.name, e.rejected) for e in found] == [("a", 40), ("short or b", 2), ("none", 0), ("short", 0)]


def test_dear_rules_come_late(docs):
    frame = docs(["a b c " * 50] * 30 + ["x"] * 10).select("text")
    dear = rules.Rule("dear", lambda t: F.length(F.aggregate(F.sequence(F.lit(1), F.lit(3000)), t.text, lambda a, _: F.reverse(a))) < 5)
    cheap = rules.Rule("cheap", lambda t: F.length(t.text) < 5)
    found = rules.estimates(frame, [dear, cheap], sample_rows=100)
    assert [e.rule.name for e in found] == ["cheap", "dear"] and found[1].rejected == 0


FAILING = rules.Rule("fails", lambda _: F.raise_error(F.lit("asked")).cast("boolean"))


def test_a_rejected_text_is_not_shown_to_later_rules(spark, docs, monkeypatch):
    first = rules.Rule("long", lambda t: F.length(t.text) > 2)
    frame = docs(["four", "five", "six!"])
    monkeypatch.setattr(rules, "estimates", lambda _, given, __: [rules.Estimate(r, 1, 1) for r in given])
    assert rules.keep_accepted(frame, rules=[first, FAILING]).collect() == []
    assert {r.rejected_by for r in rules.judged(frame, rules=[first, FAILING]).collect()} == {"long"}
    with pytest.raises(Exception, match="asked"):
        rules.keep_accepted(docs(["a"]), rules=[first, FAILING]).collect()


def test_counts_are_the_same_where_rules_ask_and_before(docs):
    texts = ["a\tb\n\x0bc  d#e é\U0001f600", "", " \n", "x", "\x1c \x85 \xa0", " lead and trail \r\n"]
    frame = docs(texts).withColumn("counts", rules.counts(F.col("text")))
    here, before = rules.Text(F.col("text")), rules.Text(F.col("text"), F.col("counts"))
    for name in ("n_words", "word_chars", "n_symbols"):
        assert frame.where(getattr(here, name) != getattr(before, name)).isEmpty()


def test_nothing_is_counted_for_documents_that_are_only_kept(docs):
    text = rules.keep_accepted(docs(["a b c"]))._jdf.queryExecution().analyzed().toString()
    assert "n_dup_lines" not in text and "word_chars" not in text


def test_awkward_documents(awkward, nothing):
    by = {(r.row.doc_id, r.text): r.rejected_by for r in rules.judged(awkward).collect()}
    assert sum(v is None for v in by.values()) == 3 and by[(1, None)] is not None
    kept = rules.keep_accepted(awkward)
    assert kept.schema == awkward.schema and kept.count() == 4
    assert rules.keep_accepted(nothing).collect() == []
