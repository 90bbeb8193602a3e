import numpy as np

from jobsieve.llm import ann as A


def test_repeated_rows_count_once(spark):
    r = np.random.default_rng(4)
    base, own = r.standard_normal(8).tolist(), r.standard_normal(8).tolist()
    rows = [(0, base)] * 9 + [(i, base) for i in range(1, 12)] + [(100 + i, r.standard_normal(8).tolist()) for i in range(30)] + [(50, own)] * 3
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for x in A.search(A.build_index(df), df.where("vec_id in (0, 50)")).collect():
        got.setdefault(x["query_id"], []).append((x["rank"], x["vec_id"]))
    assert sorted(got[0]) == [(k, k) for k in range(1, 6)]
    assert [k for k, _ in sorted(got[50])] == [1, 2, 3, 4, 5] and len({i for _, i in got[50]}) == 5


def test_many_vectors_of_one_direction(spark):
    r = np.random.default_rng(5)
    base = r.standard_normal(16)
    rows = [(i, (base * (0.1 + i)).tolist()) for i in range(1500)] + [(5000 + i, r.standard_normal(16).tolist()) for i in range(500)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    index = A.build_index(df, shard_vectors=256)
    assert index.agg({"n": "sum"}).first()[0] == 501
    got = {}
    for x in A.search(index, df.where("vec_id % 100 = 0")).collect():
        got.setdefault(x["query_id"], []).append((x["rank"], x["vec_id"]))
    for q in range(0, 1500, 100):
        assert sorted(got[q]) == [(k + 1, i) for k, i in enumerate([i for i in range(6) if i != q][:5])]
    own = {i: np.array(v) / np.linalg.norm(v) for i, v in rows}
    for q in range(5000, 5500, 100):
        # all of the direction are equally near, the smallest ids first
        want = sorted((-round(float(own[q] @ v), 9), i) for i, v in own.items() if i != q)[:5]
        assert len({i for _, i in want} & {i for _, i in got[q]}) >= 4


def test_each_shard_has_a_task_and_moves_once(spark):
    r = np.random.default_rng(6)
    df = spark.createDataFrame([(i, r.standard_normal(8).tolist()) for i in range(600)], "vec_id long, embedding array<double>")
    index = A.build_index(df, shard_vectors=100)
    shards = index.count()
    placed = A._placed(index.select("dim", "shard"), shards)
    assert sorted(placed.rdd.glom().map(len).collect()) == [1] * shards
    plan = A.search(index, df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FlatMapGroupsInArrow") == 1 and "CoGroups" not in plan
    own = plan[plan.index("FlatMapGroupsInArrow") :]
    assert own.index("REPARTITION_BY_NUM") < own.index("Union") and "ENSURE_REQUIREMENTS" not in own[: own.index("REPARTITION_BY_NUM")]
    assert own[: own.index("Exchange")].count("Sort") == 1
