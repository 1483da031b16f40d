"""Quality rules as a short-circuit cascade, ordered by rejection per cost.

A rule is a condition on a text that rejects it, an expression of its own. On a
sample each rule is run alone over the texts, several times, and the least time is its
cost; one more pass says which rules reject which texts. The cascade begins with the rule
that rejects most for its cost, goes on with the one that rejects most of what is left
for its cost, and so on. It is one CASE expression, so a text that a rule rejects is
not shown to the later ones. The order changes the time, and which of several rules is
named, never whether a text is kept. Costs count in powers of two, so that the order
does not follow small differences of time.

All rules are built-in expressions. ``judged(report=True)`` also counts words, symbols
and repetitions of every text for a report; the rules then read those counts.
The words repeated within a text come from a hash of each window of five words: only
texts in which two hashes are equal look for their places.

Defined results: null and empty texts have no words and are rejected for it; a
text of any length counts whole; repeated rows get the same verdict; no rows give
no rows; further columns stay as they are.
"""

from __future__ import annotations

import math
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataline.llm.common import SPACES, let, packed, quoted, space_words, unpacked, written

SYMBOLS = "[#*$%&|<>]"
WINDOW = 5
SAMPLE_ROWS = 2_000
REPEATS = 3
CAPITALS, SMALL = "[A-Z]", "[a-z]"
BLANK, WORD = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]"


class Text:
    """A text without nulls as rules see it: what they ask for is counted where they ask, or was before."""

    def __init__(self, text: Column, counted: Column | None = None, n_words: Column | None = None):
        self.text, self.counted, self._n_words = text, counted, n_words

    def _own(self, name: str, count: Callable[[Column], Column]) -> Column:
        return count(self.text) if self.counted is None else self.counted[name]

    @property
    def n_words(self) -> Column:
        if self._n_words is not None:
            return self._n_words
        return self._own("n_words", lambda t: _count(t, f"{WORD}+"))

    @property
    def word_chars(self) -> Column:
        return self._own("word_chars", _word_chars)

    @property
    def n_symbols(self) -> Column:
        return self._own("n_symbols", lambda t: _count(t, SYMBOLS))

    def repeated_words(self) -> Column:
        """Whether more than a fifth of the words are in repeated windows."""
        if self.counted is not None:
            return _repeated_words(self.counted["n_repeat_words"], self.counted["n_words"])
        return let(space_words(self.text), lambda w: _repeated_words(n_repeat_words(w), F.size(w)))


@dataclass(frozen=True)
class Rule:
    """A name and the condition under which a text is rejected."""

    name: str
    rejects: Callable[[Text], Column]


@dataclass(frozen=True)
class Estimate:
    """What the sample says of a rule: texts it rejects of those that earlier rules let through, and seconds."""

    rule: Rule
    rejected: float
    seconds: float


def _count(text: Column, pattern: str) -> Column:
    """How often the pattern, of a character or a run, stands in the text."""
    return F.regexp_count(text, F.lit(pattern))


def _word_chars(text: Column) -> Column:
    return F.char_length(text) - _count(text, BLANK)


def _content_lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: F.regexp_like(line, F.lit(WORD)))


def n_repeat_words(words: Column, window: int = WINDOW) -> Column:
    """Words in windows of ``window`` words that stand in the text at least twice."""

    def starts(hashes: Column) -> Column:
        """Where windows that are not alone begin, in order."""
        ordered = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(
            ordered,
            lambda s: F.array_sort(
                F.array_distinct(
                    F.flatten(
                        F.zip_with(
                            F.slice(s, 1, F.size(s) - 1),
                            F.slice(s, 2, F.size(s) - 1),
                            lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])).otherwise(
                                F.array().cast("array<int>")
                            ),
                        )
                    )
                )
            ),
        )

    def covered(at: Column) -> Column:
        gaps = F.zip_with(F.slice(at, 1, F.size(at) - 1), F.slice(at, 2, F.size(at) - 1), lambda a, b: b - a)
        return F.aggregate(gaps, F.lit(window), lambda sum_, gap: sum_ + F.least(gap, F.lit(window)))

    def count(hashes: Column) -> Column:
        alone = F.size(F.array_distinct(hashes)) == F.size(hashes)
        return F.when(alone, 0).otherwise(let(starts(hashes), covered))

    def windows(hashed: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(hashed) - window),
            lambda i: F.xxhash64(*(F.get(hashed, i + k) for k in range(window))),
        )

    hashed = F.transform(words, lambda word: F.xxhash64(word))
    found = let(hashed, lambda h: let(windows(h), count))
    return F.when(F.size(words) <= window, 0).otherwise(found).cast("bigint")


def counts(text: Column) -> Column:
    """What a report says of a text without nulls, as one struct, each counted once."""
    words = let(
        space_words(text),
        lambda w: F.struct(F.size(w).cast("bigint").alias("all"), n_repeat_words(w).alias("repeated")),
    )
    lines = let(_content_lines(text), lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("bigint"))
    return let(
        words,
        lambda w: F.struct(
            w["all"].alias("n_words"),
            w["repeated"].alias("n_repeat_words"),
            lines.alias("n_dup_lines"),
            _word_chars(text).cast("bigint").alias("word_chars"),
            _count(text, SYMBOLS).cast("bigint").alias("n_symbols"),
        ),
    )


def base_failed(c: Column) -> Column:
    """Too few words, or too many in repeated windows."""
    return _few_words(c["n_words"]) | _repeated_words(c["n_repeat_words"], c["n_words"])


def _few_words(n: Column) -> Column:
    return n < 10


def _repeated_words(repeated: Column, n: Column) -> Column:
    return 100 * repeated > 20 * n


def _monotonous(words: Column) -> Column:
    """Distinct words grow about with the root of the words: few are below twice the root."""
    n, distinct = F.size(words).cast("bigint"), F.size(F.array_distinct(words)).cast("bigint")
    return (n >= 50) & (distinct * distinct < 4 * n)


def production_rules() -> list[Rule]:
    """The base rules, and limits on symbols, capitals, exclamations, lines, and words."""

    def lines(t: Text) -> Column:
        return let(_content_lines(t.text), lambda x: 2 * F.size(F.array_distinct(x)) < F.size(x))

    return [
        Rule("few_words", lambda t: _few_words(t.n_words)),
        Rule("repeated_words", Text.repeated_words),
        Rule("symbols", lambda t: 10 * t.n_symbols > t.n_words),
        Rule("capitals", lambda t: _count(t.text, CAPITALS) > _count(t.text, SMALL)),
        Rule("exclamations", lambda t: 2 * _count(t.text, "!") > t.n_words),
        Rule("repeated_lines", lines),
        Rule("few_distinct_words", lambda t: let(space_words(t.text), _monotonous)),
        Rule("long_words", lambda t: t.word_chars > 15 * t.n_words),
    ]


BASE = ("few_words", "repeated_words")


def estimates(
    texts: DataFrame, rules: list[Rule], sample_rows: int = SAMPLE_ROWS, repeats: int = REPEATS
) -> list[Estimate]:
    """The rules in the order of the cascade, from about ``sample_rows`` of the texts (``text``, no nulls)."""
    total = texts.count()
    sample = written(texts.sample(fraction=min(1.0, sample_rows / max(1, total)), seed=3), "rules-sample")
    text = Text(F.col("text"))

    def seconds(condition: Column) -> float:
        def once() -> float:
            began = time.perf_counter()
            sample.agg(F.count_if(condition)).collect()
            return time.perf_counter() - began

        once()  # compiles the condition
        return min(once() for _ in range(repeats))

    idle = seconds(F.col("text").isNull())
    cost = {rule.name: max(seconds(_of(rule, text)) - idle, 1e-3) for rule in rules}
    cost = {name: 2.0 ** round(math.log2(value)) for name, value in cost.items()}
    together = F.array_compact(F.array(*(F.when(_of(rule, text), F.lit(rule.name)) for rule in rules)))
    rejecting = [(set(row.by), row["count"]) for row in sample.groupBy(together.alias("by")).count().collect()]
    left, order = sorted(rules, key=lambda rule: rule.name), []
    while left:
        rejected = {rule.name: sum(n for by, n in rejecting if rule.name in by) for rule in left}
        best = min(left, key=lambda rule: (-rejected[rule.name] / cost[rule.name], cost[rule.name]))
        order.append(Estimate(best, rejected[best.name], cost[best.name]))
        rejecting = [(by, n) for by, n in rejecting if best.name not in by]
        left.remove(best)
    return order


def _of(rule: Rule, text: Text) -> Column:
    return F.coalesce(rule.rejects(text), F.lit(False))


def cascade(rules: list[Rule], text: Text) -> Column:
    """The name of the first rule in this order that rejects a text, null if none does."""
    verdict = F.lit(None).cast("string")
    for rule in reversed(rules):
        verdict = F.when(_of(rule, text), F.lit(rule.name)).otherwise(verdict)
    return verdict


def judged(
    documents: DataFrame,
    text: str = "text",
    rules: list[Rule] | None = None,
    report: bool = False,
    sample_rows: int = SAMPLE_ROWS,
    as_name: str = "rejected_by",
) -> DataFrame:
    """Each document's other columns (``row``), its ``text`` and the rule that rejects it.

    With a ``report`` also its ``counts``, which the rules then use, the base rules first.
    """
    body = F.coalesce("text", F.lit(""))
    texts = documents.select(F.coalesce(quoted(text).cast("string"), F.lit("")).alias("text"))
    order = [e.rule for e in estimates(texts, rules or production_rules(), sample_rows)]
    frame = documents.select(*packed(documents, text))
    if not report:
        # Most rules go by the words, so these are counted once; all else where it is asked for.
        verdict = let(Text(body).n_words, lambda n: cascade(order, Text(body, n_words=n)))
        return frame.withColumn(as_name, verdict)
    order.sort(key=lambda rule: rule.name not in BASE)
    seen = Text(body, F.col("counts"))
    return frame.withColumn("counts", counts(body)).withColumn(as_name, cascade(order, seen))


def keep_accepted(documents: DataFrame, text: str = "text", rules: list[Rule] | None = None) -> DataFrame:
    """The documents that no rule rejects, with their columns."""
    kept = judged(documents, text, rules).where(F.col("rejected_by").isNull())
    return unpacked(kept, documents.columns, text)
