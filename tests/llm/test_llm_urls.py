import pytest
from pyspark.sql import functions as F

from strataline.llm import urls
from strataline.llm.queries import URL_RULES


@pytest.mark.parametrize(("n", "most"), [(3000, 1 << 24), (3000, 100), (1, 1 << 24)])
def test_membership_is_exact(spark, n, most):
    pages = spark.range(2 * n).select(
        F.concat(F.lit("k"), (F.col("id") % n).cast("string")).alias("key"), (F.col("id") % 17 == 3).alias("flag")
    )
    found = urls.with_listed(pages, F.col("key"), F.col("flag"), most_keys=most)
    listed = {f"k{k % n}" for k in range(2 * n) if k % 17 == 3}
    rows = found.collect()
    assert len(rows) == 2 * n
    assert all(r.listed == (r.key in listed) for r in rows)


@pytest.mark.parametrize(("listed", "others"), [(4000, 16_000), (100, 100_000), (3000, 300), (1, 50_000)])
def test_no_level_is_much_larger_than_the_first(spark, listed, others):
    keys = spark.range(listed + others).select(F.col("id").cast("string").alias("key"))
    number = F.col("key").cast("int")
    cascade = urls.Cascade(keys.where(number < listed), keys.where(number >= listed))
    sizes = [words for _, words, _ in cascade.filters]
    assert max(sizes) <= 2 * sizes[0] + 4
    assert all(later <= earlier / 2 + 4 for earlier, later in zip(sizes[1:], sizes[2:], strict=False))
    table, words, _ = cascade.filters[0]
    assert len(table.first().words) == words
    wrong = keys.where(cascade.lists(F.col("key")) != (number < listed))
    assert wrong.isEmpty()


@pytest.mark.parametrize(
    ("url", "host", "path"),
    [
        ("HTTP://User@WWW.Example.ORG/Es/X?q#f", "user@www.example.org", "/Es/X"),
        ("http://h", "h", ""),
        ("http://h?x/y", "h", ""),
        ("a://b://c/d", "b:", "//c/d"),
        ("no scheme/x", "", ""),
        ("", "", ""),
        (None, "", ""),
        ("x://É.com/\n/p", "É.com", "/\n/p"),
    ],
)
def test_parts_of_urls(spark, url, host, path):
    frame = spark.createDataFrame([(url,)], "url string")
    assert tuple(frame.select(urls.host_of(F.col("url")), urls.path_of(F.col("url"))).first()) == (host, path)


@pytest.mark.parametrize(
    ("host", "path", "rule"),
    [
        ("example.org", "/es/1", "example.org/es/"),
        ("a.example.org", "/en/12", "example.org/en/1"),
        ("example.org", "/en/2", "org/"),
        ("notexample.org", "/es/1", "org/"),
        ("com", "/fr/", "com/fr/"),
        ("xcom", "/fr/", None),
        ("a.com", "/de", None),
        ("org", "", None),
        ("", "", None),
    ],
)
def test_longest_rule(spark, host, path, rule):
    frame = spark.createDataFrame([(host, path)], "host string, path string")
    best = frame.select(urls.longest_rule(URL_RULES, F.col("host"), F.col("path")).alias("best")).first().best
    assert (best and best.rule) == rule


def test_nulls_and_no_pages(spark):
    pages = spark.createDataFrame([("a", None), ("a", True), ("b", None), ("", False)], "key string, flag boolean")
    assert {r.key: r.listed for r in urls.with_listed(pages, F.col("key"), F.col("flag")).collect()} == {
        "a": True, "b": False, "": False,
    }
    assert urls.with_listed(pages.limit(0), F.col("key"), F.col("flag")).collect() == []


def test_long_urls_and_clashing_columns(spark, awkward):
    pages = awkward.withColumns({"listed": F.lit("mine"), "url": F.concat(F.lit("http://H/"), F.coalesce("text", F.lit("")))})
    found = urls.with_listed(pages, urls.path_of(F.col("url")), F.col("text").contains("prose") | F.col("text").contains("w7"))
    assert found.columns == [*pages.columns, "listed_"]
    rows = found.collect()
    assert len(rows) == pages.count() and all(r.listed == "mine" for r in rows)
    assert {r.doc_id for r in rows if r.listed_} == {4}
