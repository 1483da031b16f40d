"""URL filters: rules by host and path, and a list of keys in a Bloom filter cascade.

The first filter of the cascade holds the listed keys. The other keys of the corpus
that pass it by mistake are held by the second, the listed keys that pass that one
by the third, and so on, until a filter lets nothing wrong through. As the filters
were made over all keys there are, each key's answer is exact: it is listed if the
first filter that does not hold it is an even one. A filter has as many bits for each
key as let about as many other keys pass as it holds, however many others there are:
so no level is much larger than the first, and from the second on they shrink.

A filter is a bit array in one row, read as a scalar subquery: a lookup is an array
access, without a join. A cascade is built over at most ``MOST_KEYS`` listed keys;
beyond, keys are dealt by a hash into as many cascades as it takes, used one after
the other, with the pages written in between. So an array has ``MOST_BITS`` times
``MOST_KEYS`` bits, 84 MB, at the very most, and with less than a thousand other keys for
each listed one about 30 MB.

Defined results: a null URL or one without ``://`` has an empty host and path; a
key is listed if any of its rows is; null flags count as not listed; repeated URLs
get equal verdicts; no pages give no rows; further columns stay as they are.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataline.llm.common import free_name, written

CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
AFTER_SCHEME = r"(?s)^.*?://([^/?#]*)([^?#]*)"
LEAST_BITS = 8
MOST_BITS = 40
"""Bits for each key of a filter, at least and at most."""
MOST_KEYS = 1 << 24


@dataclass(frozen=True)
class UrlRule:
    """A verdict for a host with its subdomains, and paths that begin with ``path``."""

    verdict: str
    host: str
    path: str

    @classmethod
    def of(cls, verdict: str, text: str) -> UrlRule:
        host, slash, path = text.partition("/")
        return cls(verdict, host, slash + path)

    @property
    def text(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        subdomain = F.endswith(host, F.lit("." + self.host))
        return ((host == self.host) | subdomain) & F.startswith(path, F.lit(self.path))


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), AFTER_SCHEME, 1)
    return F.translate(found, CAPITALS, CAPITALS.lower())


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), AFTER_SCHEME, 2)


def longest_rule(rules: list[UrlRule], host: Column, path: Column) -> Column:
    """The longest rule that fits, as a struct of ``rule`` and ``verdict``; null if none does."""
    best = sorted(rules, key=lambda r: (-len(r.text), r.text, r.verdict))
    return F.coalesce(
        F.lit(None).cast("struct<rule:string,verdict:string>"),
        *(
            F.when(r.fits(host, path), F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict")))
            for r in best
        ),
    )


class Cascade:
    """Filters of one part of the keys, as one-row tables, with their sizes in bits."""

    def __init__(self, listed: DataFrame, others: DataFrame):
        """``listed`` and ``others`` are distinct keys (column ``key``) without overlap."""
        self.filters: list[tuple[DataFrame, int, int]] = []
        held, rest = listed, others
        n, n_rest = held.count(), rest.count()
        while n:
            self.filters.append(self._filter(held, n, n_rest))
            # What passes the new filter without being held by it is what the next one holds.
            held, rest = written(rest.where(self._holds(len(self.filters) - 1, F.col("key"))), "urls-passed"), held
            n, n_rest = held.count(), n

    def _filter(self, keys: DataFrame, n: int, n_rest: int) -> tuple[DataFrame, int, int]:
        """The filter's row, its size in words, and its hashes a key."""
        # The share of others that pass is about 2 to the power of -ln(2) times the bits.
        bits = min(MOST_BITS, max(LEAST_BITS, math.log2(max(1.0, n_rest / n)) / math.log(2)))
        words, hashes = max(1, math.ceil(n * bits / 64)), max(1, int(bits * math.log(2)))
        level = len(self.filters)
        set_bits = (
            keys.select(F.explode(F.array(*self._bits(level, words, hashes, F.col("key")))).alias("bit"))
            .groupBy(F.floor(F.col("bit") / 64).cast("bigint").alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(pmod(bit, 64) as int))")).alias("bits"))
        )
        every = keys.sparkSession.range(words).withColumnRenamed("id", "word")
        row = every.join(set_bits, "word", "left").agg(
            F.array_sort(F.collect_list(F.struct("word", F.coalesce("bits", F.lit(0).cast("bigint")).alias("bits")))).alias("all")
        )
        return written(row.select(F.col("all.bits").alias("words")), "urls-filter"), words, hashes

    @staticmethod
    def _bits(level: int, words: int, hashes: int, key: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(F.lit(level), F.lit(k), key), F.lit(64 * words)) for k in range(hashes)]

    def _holds(self, level: int, key: Column) -> Column:
        table, words, hashes = self.filters[level]
        bits = table.select("words").scalar()
        holds = F.lit(True)
        for bit in self._bits(level, words, hashes, key):
            word = F.get(bits, F.floor(bit / 64).cast("int"))
            holds = holds & (F.getbit(word, F.pmod(bit, F.lit(64)).cast("int")) == 1)
        return holds

    def lists(self, key: Column) -> Column:
        """Whether a key of the universe is listed."""
        answer = F.lit(len(self.filters) % 2 == 1)
        for level in reversed(range(len(self.filters))):
            answer = F.when(~self._holds(level, key), F.lit(level % 2 == 1)).otherwise(answer)
        return answer


def with_listed(
    pages: DataFrame, key: Column, listed: Column, as_name: str = "listed", most_keys: int = MOST_KEYS
) -> DataFrame:
    """The pages with whether their key is listed, which it is if ``listed`` holds on any of its rows.

    If the pages have a column ``as_name``, the new one gets an underscore behind its name.
    """
    as_name = free_name(as_name, pages.columns)
    keys = written(
        pages.select(key.alias("key"), F.coalesce(listed, F.lit(False)).alias("listed"))
        .groupBy("key")
        .agg(F.max("listed").alias("listed")),
        "urls-keys",
    )
    n_listed = keys.where("listed").count()
    parts = max(1, math.ceil(n_listed / most_keys))

    def cascade(own: DataFrame) -> Cascade:
        return Cascade(own.where("listed").select("key"), own.where(~F.col("listed")).select("key"))

    if parts == 1:
        return pages.withColumn(as_name, cascade(keys).lists(key))
    answers = []
    for part in range(parts):
        made = cascade(keys.where(F.pmod(F.xxhash64("key"), F.lit(parts)) == part))
        own_pages = pages.where(F.pmod(F.xxhash64(key), F.lit(parts)) == part)
        answers.append(written(own_pages.withColumn(as_name, made.lists(key)), "urls-part"))
    return reduce(DataFrame.unionByName, answers)
