"""The registered queries against their SQL, and the pipeline against brute-force versions of its stages."""

import duckdb
import pyarrow as pa
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from checks.compare import compare, connect
from tapflow.llm import mixing, queries, toxicity, words as W
from tests.llm import test_decontamination, test_files, test_minhash
from tests.llm.helpers import DATA


@pytest.fixture(scope="module")
def db() -> duckdb.DuckDBPyConnection:
    return connect(DATA)


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_query_equals_sql(spark, db, name):
    assert compare(spark, db, DATA, name).startswith("ok")


def test_one_query_for_each_operator_and_the_pipeline():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 14)]
    assert "pipeline" in entry.queries() and len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", ["op1_spotsigs", "op2_minhash_dedup", "op4_toxicity", "op6_line_dedup", "op7_token_files", "op9_personal_data"])
def test_query_returns_every_document(spark, name):
    rows = entry.queries()[name](spark, DATA)
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    assert sorted(r.doc_id for r in rows.select("doc_id").collect()) == sorted(r.doc_id for r in docs.select("doc_id").collect())


def test_pipeline_equals_brute_force(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    model = toxicity.train(docs, spark.read.parquet(f"{DATA}/labels.parquet"))
    scores = toxicity.scores(model, W.flat(pa.array([r.text for r in rows.values()])))
    left = [i for (i, r), s in zip(rows.items(), scores, strict=True) if s < model.limit(r.lang)]
    classes = test_minhash.brute([rows[i].text for i in left])
    left = [i for n, i in enumerate(left) if classes[n] == n]
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    hits = test_decontamination.brute([rows[i].text for i in left], items)
    left = [i for i, h in zip(left, hits, strict=True) if not h[-1]]
    assert 0 < len(left) < len(rows)
    drawn = [r.doc_id for r in mixing.draws(docs.where(docs.doc_id.isin(left))).collect()]
    expected = test_files.expected([(i, rows[i].text) for i in drawn])
    found = corpus_pipeline.run(spark, DATA).collect()
    assert sorted(map(tuple, found), key=lambda r: r[1]) == expected
