"""The registered queries on the small tables: those with SQL against DuckDB, and the pipeline stage by stage."""

import duckdb
import pytest

import corpus_pipeline
from jobsieve.llm import queries
from jobsieve.llm.store import table, written

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(queries.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    c = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "labels", "embeddings"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    got, want = queries.QUERIES[name](spark, FOLDER).toPandas(), c.sql(queries.ORACLE_SQL[name]).df()
    names = sorted(want.columns)
    rows = lambda f: sorted(tuple(str(x).removesuffix('.0') for x in r) for r in f[names].astype(object).where(f[names].notna(), None).itertuples(index=False))
    assert sorted(got.columns) == names and sorted(map(str, rows(got))) == sorted(map(str, rows(want)))


def test_pipeline(spark):
    docs = table(spark, FOLDER, "documents")
    columns = docs.columns
    ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
    labels = {r["doc_id"]: r["quality"] for r in table(spark, FOLDER, "labels").collect()}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = written(stage(spark, docs, FOLDER), name)
        now = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert now <= ids
        if k < 4:
            assert docs.columns == columns and docs.count() == len(now)
        if name in ("language_id", "quality_classifier"):
            assert not [i for i in ids - now if labels.get(i) == 1]
        if name == "quality_classifier":
            assert [i for i in ids - now if labels.get(i) == 0]
        if name == "best_fit_packing":
            assert now == ids
        ids = now
    assert corpus_pipeline.run(spark, FOLDER).count() == docs.count()


def test_pipeline_stages_on_odd_documents(spark, odd_docs, no_docs):
    odd = odd_docs.select("doc_id", "text", "lang", "source", "n_chars")
    for docs in (odd, odd.limit(0)):
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            docs = written(stage(spark, docs, FOLDER), name)
            assert k == 4 or docs.columns == odd.columns


def test_one_row_of_a_repeated_id_stays(spark, odd_docs):
    kept = corpus_pipeline.near_dedup(spark, odd_docs, FOLDER)
    ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
    assert ids.count(100) == 1 and ids.count(None) == 1 and 9 in ids and 6 in ids and 10 not in ids
