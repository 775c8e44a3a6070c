import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from atelier.llm import topk


def brute(rows, k):
    ok = {i: [math.floor(64 * x) for x in v] for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    out = set()
    for q, a in ok.items():
        if q % 20 == 0:
            hits = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in ok.items() if i != q and len(b) == len(a))
            out |= {(q, r, i, -s) for r, (s, i) in enumerate(hits[:k], 1)}
    return out


@pytest.mark.parametrize("summaries", [topk.SUMMARIES, 0])
def test_equals_brute_force(spark, summaries):
    rnd = random.Random(2)
    rows = [(i, [rnd.choice([-0.5, 0.25, 0.1, rnd.gauss(0, 1)]) for _ in range(8)]) for i in range(700)]
    rows += [(i, [0.25] * 8) for i in range(700, 900)]  # one vector for a large part
    rows += [(901, None), (902, []), (903, [1.0, None]), (904, [float("nan")] * 8), (905, [float("inf")] * 8), (None, [0.5] * 8), (920, [0.5] * 3), (921, [0.25] * 3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    v = topk.integral(df)
    got = topk.top_k(spark, v, v.filter("vec_id % 20 = 0").withColumnRenamed("vec_id", "query_id"), 20, shard_rows=40, query_rows=4, summaries=summaries).collect()
    assert {(r.query_id, r["rank"], r.vec_id, r.score) for r in got} == brute(rows, 20) and len(got) == len(set(got))


def test_repeated_rows_take_a_rank_each(spark):
    rnd = random.Random(4)
    rows = [(i, [rnd.gauss(0, 1) for _ in range(4)]) for i in range(1, 300)] + [(7, [9.0] * 4)] * 5 + [(11, [8.0] * 4)] * 3 + [(20, [1.0] * 4)] * 2
    v = topk.integral(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    asked = v.filter("vec_id % 20 = 0").withColumnRenamed("vec_id", "query_id").dropDuplicates(["query_id"])
    got = {}
    for r in topk.top_k(spark, v, asked, 20, shard_rows=40).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((-r.score, r.vec_id))
    data = v.collect()
    for q in asked.collect():
        want = sorted((-sum(x * y for x, y in zip(q.v, c.v)), c.vec_id) for c in data if c.vec_id != q.query_id)
        assert got[q.query_id] == want[:20]


def test_thirty_rows_of_one_id_and_clashing_names(spark):
    rnd = random.Random(6)
    rows = [(0, [1.0, 1.0]), (0, [0.5, 9.0])] + [(1, [5.0, 5.0])] * 30 + [(i, [rnd.random(), rnd.random()]) for i in range(2, 58)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: topk.F.lit(7) for c in ("n", "dim", "cell", "part", "query_id", "rank", "score")})
    v = topk.integral(df)
    got = topk.top_k(spark, v, v.filter("vec_id = 0").withColumnRenamed("vec_id", "query_id")).collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in sorted(got, key=lambda r: r["rank"])] == [(0, k, 1, 320 * (32 + 576)) for k in range(1, 21)]  # the least vector of id 0


def test_sql_ranks_rows(spark, tmp_path):
    import duckdb

    rnd = random.Random(3)
    rows = [(i % 90, [rnd.choice([0.25, -0.5, 1.0]) for _ in range(6)]) for i in range(200)] + [(40, None), (None, [1.0] * 6)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").coalesce(1).write.parquet(f"file://{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.sql(f"create view embeddings as select * from '{tmp_path}/embeddings.parquet/*.parquet'")
    assert sorted(map(tuple, topk.op5_topk(spark, f"file://{tmp_path}").collect())) == sorted(con.sql(topk.OP5_SQL).fetchall())


def test_bounds_leave_most_leaves_alone():
    rng = np.random.default_rng(5)
    centres = rng.normal(0, 300, (40, 8))
    vecs = np.floor(centres[rng.integers(0, 40, 8000)] + rng.normal(0, 5, (8000, 8))).astype(np.int64)
    tree = topk.build(np.arange(8000), vecs)
    leaves = sum(x < 0 for x in tree["left"])
    best = topk.Best(np.arange(5), 20, np.full(5, topk.NONE.min))
    assert topk.search(tree, vecs[:5], best) < leaves / 2
    # a shared score that nothing here beats leaves all of them alone
    again = topk.Best(np.arange(5), 20, np.full(5, topk.NONE.max // 2))
    assert topk.search(tree, vecs[:5], again) == 0


def test_no_pairing_joins(spark):
    rows = [(i, [float(i % 7), 1.0, float(i % 3)]) for i in range(400)]
    v = topk.integral(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    plan = topk.top_k(spark, v, v.filter("vec_id % 20 = 0").withColumnRenamed("vec_id", "query_id"), 5, shard_rows=50)._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_empty(spark):
    v = topk.integral(spark.createDataFrame([], "vec_id long, embedding array<float>"))
    assert topk.top_k(spark, v, v.withColumnRenamed("vec_id", "query_id")).count() == 0


@settings(max_examples=30, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 200), st.sampled_from([1, 3, 2**28]))
def test_tree_search_is_exact(seed, n, size):
    rng = np.random.default_rng(seed)
    vecs = rng.integers(-size, size + 1, (n, 4))
    ids = rng.permutation(10 * n)[:n].astype(np.int64)
    best = topk.Best(ids[:5], 3, np.full(len(ids[:5]), np.iinfo(np.int64).min))
    topk.search(topk.build(ids, vecs, leaf=4), vecs[:5], best)
    for r, (q, v) in enumerate(zip(ids[:5], vecs[:5])):
        want = sorted((-int(sum(int(a) * int(b) for a, b in zip(v, w))), int(i)) for i, w in zip(ids, vecs) if i != q)[:3]
        assert [(-int(s), int(i)) for s, i in zip(best.score[r], best.id[r]) if i != np.iinfo(np.int64).max] == want


def test_a_task_holds_vectors_in_their_narrowest_type_and_sends_no_row_under_the_lead():
    import pickle

    import pyarrow as pa

    rng = np.random.default_rng(4)
    vecs, ids = rng.integers(-40, 40, (500, 8)), np.arange(500)
    tree = topk.build(ids, vecs)
    assert tree["vecs"].dtype == np.int8 and (tree["vecs"] == vecs[tree["ids"]]).all()
    assert [topk.compact(np.array([0, x])).dtype.itemsize for x in (127, -129, 2**15, -(2**31) - 1)] == [1, 2, 4, 8]
    q = vecs[:6]
    scores = q @ vecs.T
    scores[np.arange(6), np.arange(6)] = -(2**62)
    floor = np.sort(scores, axis=1)[:, -3]  # a lead knows that three rows have this score
    asked = {"asked": pa.array([pickle.dumps((ids[:6], topk.compact(q), floor))])}
    out = topk._walk(5)(None, {"tree": pa.array([pickle.dumps(tree)])}, asked).to_pydict()
    want = [(i, j, scores[i, j]) for i in range(6) for j in sorted(range(500), key=lambda j: (-scores[i, j], j))[:5] if scores[i, j] >= floor[i]]
    assert sorted(zip(out["query_id"], out["vec_id"], out["score"])) == sorted(want)
