"""The registered queries against their SQL, and the pipeline against its operators."""

import pytest
from compare import database, differences

import corpus_pipeline
from strataline.llm import quality, queries
from test_llm_decontaminate import brute as brute_decontamination
from test_llm_linededup import WORD as LINE_WORD
from test_llm_linededup import brute as brute_lines
from test_llm_simhash import brute as brute_components
from test_llm_simhash import naive

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", queries.ORACLES)
def test_query_agrees_with_sql(spark, name):
    with database(DATA) as db:
        assert differences(queries.QUERIES[name](spark, DATA), db, queries.ORACLES[name]) == []


OF_PIECES = ("op12_packing",)
"""Have a row for each piece; test_llm_packing tests them whole."""


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n not in queries.ORACLES and n not in OF_PIECES])
def test_query_returns_a_row_for_each_document(spark, name):
    found = queries.QUERIES[name](spark, DATA)
    ids = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id")
    assert found.select("doc_id").exceptAll(ids).isEmpty() and ids.exceptAll(found.select("doc_id")).isEmpty()


def test_simhash_query_agrees_with_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    codes = {d: naive(t) for d, t in texts.items()}
    root = brute_components(sorted(set(codes.values())))
    smallest = {}
    for d in sorted(codes):
        smallest.setdefault(root[codes[d]], d)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op4_simhash(spark, DATA).collect()}
    assert got == {d: (f"{c:016x}", smallest[root[c]]) for d, c in codes.items()}


def without(text, deleted):
    lines = text.split("\n")
    content = [k for k, line in enumerate(lines) if LINE_WORD.search(line)]
    gone = {content[k] for k in deleted}
    return None if content and len(gone) == len(content) else "\n".join(x for k, x in enumerate(lines) if k not in gone)


def test_pipeline_agrees_with_brute_force(spark):
    """Quality scores come from the fitted scorer, all else from definitions in plain Python."""
    documents = spark.read.parquet(f"{DATA}/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    scorer = quality.fit(documents, labels)
    if scorer.measure:
        scorer.measure.start()
    rows = sorted(documents.collect(), key=lambda r: r.doc_id)
    scores = scorer.scores([r.text.encode() for r in rows])
    kept = [(r.doc_id, r.text) for r, s in zip(rows, scores, strict=True) if s >= quality.THRESHOLD]
    gone = brute_lines([t for _, t in kept], 50)
    kept = [(d, without(t, x)) for (d, t), (_, x) in zip(kept, gone, strict=True)]
    kept = [(d, t) for d, t in kept if t is not None]
    codes = {d: naive(t) for d, t in kept}
    root = brute_components(sorted(set(codes.values())))
    first = {}
    for d, _ in kept:
        first.setdefault(root[codes[d]], d)
    kept = [(d, t) for d, t in kept if first[root[codes[d]]] == d]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    hits = brute_decontamination([t for _, t in kept], items, 13)
    kept = {d: t for (d, t), (n, hit, _) in zip(kept, hits, strict=True) if not (hit and 20 * hit >= n)}

    mixed = corpus_pipeline.run(spark, DATA)
    assert mixed.columns == [*documents.columns, "mix_shard", "mix_place"]
    found = mixed.collect()
    assert {r.doc_id: r.text for r in found}.items() <= kept.items()
    assert all(r.n_chars == len(r.text) for r in found)
    sizes, taken, source = {}, {}, {r.doc_id: r.source for r in rows}
    for d, t in kept.items():
        sizes[source[d]] = sizes.get(source[d], 0) + len(LINE_WORD.findall(t))
    for r in found:
        taken[r.source] = taken.get(r.source, 0) + len(LINE_WORD.findall(r.text))
    assert sum(taken.values()) == pytest.approx(1.5 * sum(sizes.values()), rel=0.02)
    assert all(taken[s] <= 2 * n for s, n in sizes.items() if s in taken)


def test_stages_return_the_columns_of_documents(spark, nothing):
    frame = nothing.select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, frame, DATA).schema.names == frame.columns, name


def test_pipeline_with_awkward_documents(spark, awkward, tmp_path):
    """Nulls, empty and long texts, repeated rows, no rows, and columns with the operators' names, through all stages."""
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{DATA}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    columns = awkward.columns
    for documents in (awkward, awkward.limit(0)):
        frame = documents
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            frame = stage(spark, frame, str(tmp_path))
            if k < len(corpus_pipeline.STAGES) - 1:
                assert frame.columns == columns, name
                frame.write.mode("overwrite").parquet(str(tmp_path / f"stage{k}"))
                frame = spark.read.schema(awkward.schema).parquet(str(tmp_path / f"stage{k}"))
        assert frame.columns == [*columns, "mix_shard_", "mix_place_"]
        ids = {(r.doc_id, r.text) for r in documents.collect()}
        assert {(r.doc_id, r.text) for r in frame.collect()} <= ids
