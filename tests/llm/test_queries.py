"""Registered queries: DuckDB where SQL expresses them, contract shapes, and the pipeline."""

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline
from cinerank.llm import decontaminate, line_dedup, near_dup, pieces, quality
from cinerank.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(E.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_duckdb(spark, duck, name):
    res = duck.execute(ORACLE[name])
    cols = [d[0] for d in res.description]
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(cols)
    assert sorted((tuple(r[c] for c in cols) for r in got.collect()), key=repr) == sorted(res.fetchall(), key=repr)


SHAPES = {
    "op1_license_scan": ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
    "op2_lm_score": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    "op4_quality_classifier": ["doc_id", "score", "kept"],
    "op5_minhash_near_dedup": ["doc_id", "n_shingles", "component_id", "kept"],
    "op6_language_id": ["doc_id", "held_out", "lang_pred", "score"],
    "op8_sentencepiece": ["doc_id", "n_pieces", "ids", "round_trip"],
}


@pytest.mark.parametrize("name", sorted(SHAPES))
def test_one_row_per_document(spark, name):
    got = QUERIES[name](spark, SF)
    assert set(SHAPES[name]) <= set(got.columns)
    rows = got.collect()
    assert sorted(r.doc_id for r in rows) == sorted(
        r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect())
    if name == "op8_sentencepiece":
        assert all(r.round_trip for r in rows)


def test_pipeline_equals_its_operators(spark):
    """run() is the five operators in order, each on what its predecessor kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "line_dedup", "near_dedup", "decontamination", "sentencepiece"]
    model = quality.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    ids = [r.doc_id for r in quality.classify(docs, model).filter("kept").collect()]
    good = spark.createDataFrame([r for r in docs.collect() if r.doc_id in set(ids)], docs.schema)
    cut = {r.doc_id: r.text for r in line_dedup.dedup_lines(good).collect() if r.n_removed == 0 or (r.text or "").strip()}
    left = spark.createDataFrame(sorted(cut.items()), "doc_id long, text string")
    once = {r.doc_id for r in near_dup.near_duplicates(left).filter("kept").collect()}
    bad = {r.doc_id for r in decontaminate.contamination(left, bench).filter("contaminated").collect()}
    want = {i: cut[i] for i in once - bad}
    rows = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id: r.text for r in rows} == want and len(rows) == len(want)
    own = pieces.load()
    assert all(r.ids == own.encode(r.text).tolist() for r in rows)
    assert all(r.n_chars == len(r.text) for r in rows)


def test_stages_keep_columns_and_take_empty_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs.limit(0), SF)
        assert out.columns[:len(docs.columns)] == docs.columns
        assert out.collect() == []
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.schema == docs.schema or [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
