"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataline.llm import (
    decontaminate,
    divergence,
    interactions,
    licenses,
    linededup,
    mixing,
    packing,
    quality,
    rules,
    simhash,
    tokens,
    toxicity,
    urls,
)
from strataline.llm.common import ROW, written
from strataline.llm.training import held_out


def table(spark: SparkSession, sf: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet").select(*columns)


def op1_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    found = decontaminate.find_matches(
        table(spark, sf, "documents", "doc_id", "text"), table(spark, sf, "benchmark", "item_id", "text")
    )
    return found.select(
        F.col(f"{ROW}.doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontaminate.is_contaminated().alias("contaminated"),
    )


def op2_quality(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents", "doc_id", "text")
    scorer = quality.fit(documents, table(spark, sf, "labels", "doc_id", "quality"))
    return quality.with_scores(documents, scorer).select(
        F.col(f"{ROW}.doc_id"),
        held_out(F.col(f"{ROW}.doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


def op3_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    judged = rules.judged(table(spark, sf, "documents", "doc_id", "text"), report=True)
    failed = rules.base_failed(F.col("counts"))
    counted = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select(
        F.col(f"{ROW}.doc_id"),
        *(F.col(f"counts.{name}") for name in counted),
        failed.alias("base_failed"),
        (~failed & F.col("rejected_by").isNull()).alias("kept"),
    )


def op4_simhash(spark: SparkSession, sf: str) -> DataFrame:
    prints = written(
        simhash.with_fingerprints(table(spark, sf, "documents", "doc_id", "text")).select(
            F.col(f"{ROW}.doc_id"), "fingerprint"
        ),
        "simhash-prints",
    )
    groups = simhash.near_duplicates(prints, F.col("doc_id"))
    return prints.join(groups, "fingerprint").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def op5_licenses(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.find_licenses(table(spark, sf, "documents", "doc_id", "text")).select(
        F.col(f"{ROW}.doc_id"),
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


URL_RULES = [
    urls.UrlRule.of("allow", "org/"),
    urls.UrlRule.of("block", "example.org/es/"),
    urls.UrlRule.of("block", "example.org/en/1"),
    urls.UrlRule.of("allow", "com/fr/"),
    urls.UrlRule.of("block", "com/de/"),
]
JUNK_MARKS = ("***", "###", "$$$")


def op6_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Listed are the addresses (host and path) of pages whose text has marks of generated junk."""
    pages = table(spark, sf, "pages", "page_id", "url", "html")
    junk = F.lit(False)
    for mark in JUNK_MARKS:
        junk = junk | F.contains("html", F.lit(mark))
    parsed = pages.withColumns({"host": urls.host_of(F.col("url")), "path": urls.path_of(F.col("url"))})
    listed = urls.with_listed(parsed, F.concat("host", "path"), junk)
    best = urls.longest_rule(URL_RULES, F.col("host"), F.col("path"))
    return listed.withColumn("best", best).select(
        "page_id",
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"),
    )


def op7_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    counted = tokens.with_token_counts(table(spark, sf, "documents", "doc_id", "text"), tokens.Vocabulary.load())
    return counted.select(F.col(f"{ROW}.doc_id"), "n_pretokens", "n_tokens")


def op8_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    report = linededup.line_report(table(spark, sf, "documents", "doc_id", "text"))
    return report.select(
        "doc_id",
        F.col("n_lines").cast("bigint").alias("n_lines"),
        F.size("deleted").cast("bigint").alias("n_deleted"),
        F.array_join("deleted", ",").alias("deleted"),
    )


def op9_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents", "doc_id", "text")
    model = toxicity.fit(documents, table(spark, sf, "labels", "doc_id", "toxic"))
    return toxicity.with_severity(documents, model).select(
        F.col(f"{ROW}.doc_id"),
        held_out(F.col(f"{ROW}.doc_id")).alias("held_out"),
        "n_words",
        "severity",
        "p_toxic",
        (F.col("p_toxic") >= 0.5).cast("int").alias("predicted"),
    )


def op10_mixing(spark: SparkSession, sf: str) -> DataFrame:
    mix = mixing.plan_mix(table(spark, sf, "documents", "doc_id", "text", "source"))
    return mixing.taken(mix)


def op11_interactions(spark: SparkSession, sf: str) -> DataFrame:
    marked = interactions.masks(table(spark, sf, "documents", "doc_id", "text", "source"))
    return interactions.audit(interactions.mask_counts(marked, table(spark, sf, "labels", "doc_id", "quality", "toxic")))


def op12_packing(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    vocabulary = public_tokenizers.path(packing.VOCABULARY)
    packed = packing.pack(packing.pieces(table(spark, sf, "documents", "doc_id", "text"), vocabulary))
    return packed.select(
        F.col(f"{ROW}.doc_id"), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


def op13_divergence(spark: SparkSession, sf: str) -> DataFrame:
    return divergence.audit(table(spark, sf, "documents", "text", "lang", "source"))


QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_quality": op2_quality,
    "op3_quality_rules": op3_quality_rules,
    "op4_simhash": op4_simhash,
    "op5_licenses": op5_licenses,
    "op6_url_filter": op6_url_filter,
    "op7_token_counts": op7_token_counts,
    "op8_line_dedup": op8_line_dedup,
    "op9_toxicity": op9_toxicity,
    "op10_mixing": op10_mixing,
    "op11_interactions": op11_interactions,
    "op12_packing": op12_packing,
    "op13_divergence": op13_divergence,
}
# Lines are compared as texts, runs as the lines joined; the shortest run with 50 words
# from each line, forwards and backwards.
OP8_SQL = """
with numbered as (
  select *, count(*) over (partition by doc_id, text) as n,
    row_number() over (partition by doc_id, text) as copy
  from (select doc_id, coalesce(text, '') as text from documents)
), split_up as (
  select doc_id, text, string_split(text, chr(10)) as lines from numbered where copy = 1
), raw as (
  select doc_id, text, unnest(lines) as line, unnest(range(len(lines))) as line_no from split_up
), content as (
  select doc_id, text, line, line_no,
    len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) as words from raw
), lines as (
  select doc_id, text, line, words,
    row_number() over (partition by doc_id, text order by line_no) - 1 as i,
    sum(words) over (partition by doc_id, text order by line_no) as up_to
  from content where words > 0
), docs as (
  select doc_id, text, list(line order by i) as all_lines, count(*) as n_lines, sum(words) as n_words
  from lines group by all
), ends as (
  select a.doc_id, a.text, a.i as first, min(b.i) as last from lines a join lines b
    on a.doc_id = b.doc_id and a.text = b.text and b.i >= a.i and b.up_to - a.up_to + a.words >= 50
  group by all
  union
  select b.doc_id, b.text, max(a.i), b.i from lines a join lines b
    on a.doc_id = b.doc_id and a.text = b.text and b.i >= a.i and b.up_to - a.up_to + a.words >= 50
  group by b.doc_id, b.text, b.i
), runs as (
  select e.doc_id, e.text, e.first, e.last,
    array_to_string(list_slice(d.all_lines, e.first + 1, e.last + 1), chr(10)) as run
  from ends e join docs d on e.doc_id = d.doc_id and e.text = d.text
), placed as (
  select *, first_value({'doc_id': doc_id, 'text': text, 'first': first, 'last': last})
    over (partition by run order by doc_id, text, first) as source
  from runs
), gone as (
  select distinct doc_id, text, unnest(range(
    case when doc_id = source.doc_id and text = source.text then greatest(first, source.last + 1) else first end,
    last + 1)) as i
  from placed where doc_id <> source.doc_id or text <> source.text or first <> source.first
), gone_lists as (
  select doc_id, text, list(i order by i) as deleted from gone group by all
)
select u.doc_id, coalesce(d.n_lines, 0) as n_lines,
  case when u.copy > 1 and d.n_words >= 50 then d.n_lines else coalesce(len(g.deleted), 0) end as n_deleted,
  case when u.copy > 1 and d.n_words >= 50 then array_to_string(range(d.n_lines), ',')
    else coalesce(array_to_string(g.deleted, ','), '') end as deleted
from numbered u
left join docs d on u.doc_id = d.doc_id and u.text = d.text
left join gone_lists g on u.doc_id = g.doc_id and u.text = g.text
"""

OP1_SQL = r"""
with docs as (
  select row_number() over () as rid, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents
), items as (
  select cast(item_id as varchar) as item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark
), item_starts as (
  select item_id, w, least(13, len(w)) as size, unnest(range(1, greatest(len(w) - 12, 1) + 1)) as i
  from items where len(w) > 0
), windows as (
  select item_id, size, array_to_string(list_slice(w, i, i + size - 1), ' ') as run from item_starts
), doc_starts as (
  select rid, w, size, unnest(range(1, len(w) - size + 2)) as i
  from docs, (select distinct size from windows) where len(w) >= size
), places as (
  select rid, size, i, array_to_string(list_slice(w, i, i + size - 1), ' ') as run from doc_starts
), found as (
  select p.rid, p.i, p.size, x.item_id from places p join windows x on p.size = x.size and p.run = x.run
), hit_words as (
  select rid, count(distinct k) as n_hit from (select rid, unnest(range(i, i + size)) as k from found) group by rid
), hit_items as (
  select rid, count(*) as n_items, string_agg(item_id, ',' order by item_id) as names
  from (select distinct rid, item_id from found) group by rid
)
select d.doc_id, len(d.w) as n_words, coalesce(h.n_hit, 0) as n_hit, coalesce(t.n_items, 0) as n_items,
  sha256(coalesce(t.names, '')) as items_sha256,
  coalesce(h.n_hit, 0) > 0 and 20 * coalesce(h.n_hit, 0) >= len(d.w) as contaminated
from docs d left join hit_words h on d.rid = h.rid left join hit_items t on d.rid = t.rid
"""

OP3_SQL = r"""
with docs as (
  select row_number() over () as rid, doc_id, coalesce(text, '') as text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents
), starts as (
  select rid, i, array_to_string(list_slice(w, i, i + 4), ' ') as run
  from (select rid, w, unnest(range(1, len(w) - 3)) as i from docs where len(w) >= 5)
), repeated as (
  select rid, i from (select rid, i, count(*) over (partition by rid, run) as n from starts) where n > 1
), covered as (
  select rid, count(distinct k) as n from (select rid, unnest(range(i, i + 5)) as k from repeated) group by rid
), lines as (
  select rid, count(*) as n_lines, count(*) - count(distinct line) as n_dup
  from (select rid, unnest(string_split(text, chr(10))) as line from docs)
  where regexp_matches(line, '[^\x20\x09-\x0D]') group by rid
), counted as (
  select d.doc_id, len(d.w) as n_words, length(regexp_replace(d.text, '[\x20\x09-\x0D]', '', 'g')) as word_chars,
    length(d.text) - length(regexp_replace(d.text, '[#*$%&|<>]', '', 'g')) as n_symbols,
    coalesce(l.n_dup, 0) as n_dup_lines, coalesce(c.n, 0) as n_repeat_words, coalesce(l.n_lines, 0) as n_lines,
    length(d.text) - length(regexp_replace(d.text, '[A-Z]', '', 'g')) as capitals,
    length(d.text) - length(regexp_replace(d.text, '[a-z]', '', 'g')) as small,
    length(d.text) - length(replace(d.text, '!', '')) as exclamations, len(list_distinct(d.w)) as n_distinct
  from docs d left join lines l on d.rid = l.rid left join covered c on d.rid = c.rid
), judged as (
  select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from counted
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and not (10 * n_symbols > n_words or capitals > small or 2 * exclamations > n_words
    or 2 * n_dup_lines > n_lines or (n_words >= 50 and n_distinct * n_distinct < 4 * n_words)
    or word_chars > 15 * n_words) as kept
from judged
"""

OP6_SQL = r"""
with parsed as (
  select page_id, html, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') as path
  from pages
), listed as (
  select distinct host || path as address from parsed
  where contains(html, '***') or contains(html, '###') or contains(html, '$$$')
), rules(verdict, host, path) as (
  values ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
    ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), best as (
  select p.page_id, p.host, p.path, arg_max(r.host || r.path, length(r.host || r.path)) as rule,
    arg_max(r.verdict, length(r.host || r.path)) as verdict
  from (select distinct page_id, host, path from parsed) p
  join rules r on (p.host = r.host or ends_with(p.host, '.' || r.host)) and starts_with(p.path, r.path)
  group by all
)
select p.page_id, p.host, p.path, b.rule,
  coalesce(b.verdict, case when l.address is not null then 'block' else 'allow' end) as verdict
from parsed p
left join best b on p.page_id = b.page_id and p.host = b.host and p.path = b.path
left join listed l on l.address = p.host || p.path
"""

OP11_SQL = r"""
with docs as (
  select doc_id, coalesce(source, '') as part, coalesce(text, '') as text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents
), known as (
  select doc_id, max(case when quality = 1 then 1 else 0 end) as good, max(case when toxic = 1 then 1 else 0 end) as toxic
  from labels where doc_id is not null group by doc_id
), failed as (
  select d.part, coalesce(k.good, 0) as good, coalesce(k.toxic, 0) as toxic, [
    len(w) < 50,
    100 * len(list_distinct(w)) < 65 * len(w),
    100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 5 * length(text),
    regexp_matches(text, '[#$%&*|]'),
    coalesce(min(d.doc_id) over (partition by text) < d.doc_id, false)] as fails
  from docs d left join known k on d.doc_id = k.doc_id
), counted as (
  select part, fails, count(*) as n, sum(good) as good, sum(toxic) as toxic from failed group by all
), letters(k) as (
  values (1), (2), (3), (4), (5)
), orders as (
  select [a.k, b.k, c.k, d.k, e.k] as ks from letters a, letters b, letters c, letters d, letters e
  where len(list_distinct([a.k, b.k, c.k, d.k, e.k])) = 5
), steps as (
  select array_to_string(list_transform(ks, lambda x: substr('ABCDE', x, 1)), '') as filter_order,
    step, ks[step] as own, ks[1:step - 1] as before
  from orders, (select unnest(range(1, 6)) as step)
), judged as (
  select c.*, s.filter_order, s.step, s.own, c.fails[s.own] as here,
    len(list_filter(s.before, lambda x: c.fails[x])) > 0 as earlier,
    len(list_filter(c.fails, lambda x: x)) as n_fails
  from counted c, steps s
), summed as (
  select part, filter_order, step, own,
    cast(coalesce(sum(n) filter (not here and not earlier), 0) as bigint) as kept,
    cast(coalesce(sum(n) filter (here and not earlier), 0) as bigint) as removed,
    cast(coalesce(sum(n) filter (here and earlier), 0) as bigint) as redundant,
    cast(coalesce(sum(n) filter (here and n_fails = 1), 0) as bigint) as unique_fails,
    cast(coalesce(sum(good) filter (here and not earlier), 0) as bigint) as good_lost,
    cast(coalesce(sum(toxic) filter (here and not earlier), 0) as bigint) as toxic_lost
  from judged group by all
)
select * exclude (own), cast(sum(removed) over (partition by part, own) as bigint) as shapley from summed
"""

OP13_SQL = r"""
with docs as (
  select row_number() over () as rid, coalesce(lang, '') as lang, coalesce(source, '') as source, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as w
  from documents
), found as (
  select lang, source, term, count(*) as n, count(distinct rid) as docs
  from (select rid, lang, source, unnest(w) as term from docs) group by all
), kept as (
  select lang, term, sum(n)::hugeint as n from found group by lang, term having sum(docs) >= 3
), groups as (
  select d.lang, d.source, coalesce(t.total, 0)::hugeint as total
  from (select distinct lang, source from docs) d left join (
    select lang, source, sum(n) as total from found semi join kept using (lang, term) group by all
  ) t on d.lang = t.lang and d.source = t.source
), langs as (
  select lang, count(*)::hugeint as v, sum(n)::hugeint as total from kept group by lang
), shares as (
  select g.lang, g.source, k.term, coalesce(f.n, 0) as n,
    1 + 1000000000::hugeint * (coalesce(f.n, 0) + 1) // (g.total + l.v) as p,
    1 + 1000000000::hugeint * (k.n + 1) // (l.total + l.v) as q
  from groups g join kept k on g.lang = k.lang join langs l on l.lang = g.lang
  left join found f on f.lang = g.lang and f.source = g.source and f.term = k.term
), summed as (
  select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // b.p) as value
  from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all
), pairs as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(s.value, 0)::bigint as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source
  left join summed s on s.lang = a.lang and s.source = a.source and s.item = b.source
), above as (
  select lang, source, 'term' as part, term as item, ((p - q) * (p - q) // q)::bigint as value
  from shares where n > 0 and p > q
), ranked as (
  select *, cast(row_number() over (partition by lang, source, part order by value desc, item) as integer) as rank
  from (select * from pairs union all select * from above)
)
select * from ranked where part = 'pair' or rank <= 200
"""

ORACLES = {
    "op1_decontaminate": OP1_SQL,
    "op3_quality_rules": OP3_SQL,
    "op6_url_filter": OP6_SQL,
    "op8_line_dedup": OP8_SQL,
    "op11_interactions": OP11_SQL,
    "op13_divergence": OP13_SQL,
}
