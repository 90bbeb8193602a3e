import pytest

from jobsieve.llm import store


def test_broadcast_only_below_the_bound(spark):
    df = spark.range(5)
    other = spark.range(100)
    plan = lambda d: other.join(d, "id")._jdf.queryExecution().logical().toString()
    assert "broadcast" in plan(store.broadcast_if_small(df, 5, 10, 50)) and "broadcast" not in plan(store.broadcast_if_small(df, 6, 10, 50))


def test_removed_deletes_written_tables_alone(spark, tmp_path):
    own = store.written(spark.range(3), "x")
    other = spark.range(3)
    other.write.parquet(f"file://{tmp_path}/kept")
    kept = spark.read.parquet(f"file://{tmp_path}/kept")
    store.removed(spark, own)
    store.removed(spark, kept)
    assert kept.count() == 3
    with pytest.raises(Exception):
        own.collect()


def test_batches_are_small(spark):
    store.table(spark, "/root/testdata/sf0.001", "labels")
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= store.BATCH_ROWS


def test_a_cluster_needs_a_shared_folder():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        store.shared_dir(Session())
