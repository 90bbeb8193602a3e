import corpus_pipeline
from jobsieve.llm.store import table
from .conftest import prose
from .test_queries import FOLDER


def kept(spark, stage, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = stage(spark, docs, FOLDER)
    assert out.columns == docs.columns
    return sorted(map(tuple, out.collect()), key=str)


def test_near_dedup_judges_null_and_repeated_ids_by_their_texts(spark):
    a, b, c, d = (prose(k, 60) for k in range(20, 24))
    got = kept(spark, corpus_pipeline.near_dedup, [(None, a), (None, a), (None, b), (5, b), (7, c), (7, d), (7, d), (8, d)])
    assert got == sorted([(None, a), (5, b), (7, c), (7, d)], key=str)


def test_decontamination_judges_null_and_repeated_ids_by_their_texts(spark):
    item = table(spark, FOLDER, "benchmark").orderBy("item_id").first()["text"]
    clean, other = prose(30, 80), prose(31, 80)
    dirty = f"{clean} {item} {other}"
    got = kept(spark, corpus_pipeline.benchmark_decontamination, [(None, dirty), (None, clean), (7, dirty), (7, other), (8, dirty), (9, clean)])
    assert got == sorted([(None, clean), (7, other), (9, clean)], key=str)
