"""Tables that change by key, and streams that keep them."""

import random

import pytest
from pyspark.sql import functions as F

from atelier.operators import settle
from atelier.plans import reports
from atelier.sources import upsert
from atelier.streaming import streams


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_upserts_equal_a_dictionary(spark, tmp_path):
    path, rnd, state = f"file://{tmp_path}/t", random.Random(1), {}
    for k in range(4):
        made = [(rnd.choice([None, *range(30)]), rnd.choice("ab"), i, rnd.random() < 0.2) for i in range(rnd.choice((0, 12)) if k == 2 else 12)]
        got = upsert.upsert(spark.createDataFrame(made, "k int, part string, v int, gone boolean"), path, ["k", "part"], order=["v"], deleted="gone", buckets=8)
        for key, part, v, gone in sorted(made, key=lambda r: r[2]):
            state.pop((key, part), None) if gone else state.update({(key, part): v})
        assert got == k and rows(upsert.read(spark, path)) == sorted(((*a, v) for a, v in state.items()), key=str)
    with pytest.raises(Exception, match="no order"):
        upsert.upsert(spark.createDataFrame([(1, "a", 1), (1, "a", 2)], "k int, part string, v int"), path, ["k", "part"])
    with pytest.raises(ValueError):
        upsert.upsert(spark.createDataFrame([(1, 2)], "k int, v int"), path, ["k"])


def test_only_touched_partitions_are_written(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    upsert.upsert(spark.range(1000).select("id", F.lit(0).alias("v")), path, ["id"], buckets=16)
    before = upsert.commit(spark, path)["folders"]
    upsert.upsert(spark.createDataFrame([(7, 1)], "id long, v int"), path, ["id"])
    after = upsert.commit(spark, path)["folders"]
    assert len(before) == 16 and sum(before[k] != after[k] for k in before) == 1
    assert upsert.read(spark, path).filter("v = 1").count() == 1 and upsert.read(spark, path, 0).filter("v = 1").count() == 0
    assert upsert.tidy(spark, path) == 1 and upsert.read(spark, path).count() == 1000


def test_a_stop_after_each_step_leaves_the_last_commit(spark, tmp_path, monkeypatch):
    path = f"file://{tmp_path}/t"
    upsert.upsert(spark.createDataFrame([(1, 1), (2, 1)], "k int, v int"), path, ["k"], buckets=4)
    change = spark.createDataFrame([(2, 5), (3, 5)], "k int, v int")
    was, put, names = rows(upsert.read(spark, path)), upsert._put, upsert._names

    def stop(*_):
        raise RuntimeError("stopped")

    monkeypatch.setattr(upsert, "_put", stop)  # the rows are written, no commit is
    with pytest.raises(RuntimeError):
        upsert.upsert(change, path, ["k"])
    assert rows(upsert.read(spark, path)) == was
    monkeypatch.setattr(upsert, "_put", put)
    # the commit is written beside the others and has no name yet
    (tmp_path / "t/_commits/.half").write_text('{"number": 1')
    assert upsert.commits(spark, path) == [0] and rows(upsert.read(spark, path)) == was
    upsert.upsert(change, path, ["k"])
    assert rows(upsert.read(spark, path)) == [(1, 1), (2, 5), (3, 5)]
    with pytest.raises(FileExistsError):  # a writer that began with the commit before
        put(spark, path, upsert.commit(spark, path))
    assert upsert.tidy(spark, path) >= 1 and rows(upsert.read(spark, path)) == [(1, 1), (2, 5), (3, 5)]
    assert names(spark, path)


def test_a_batch_is_applied_once(spark, tmp_path):
    path, one = f"file://{tmp_path}/t", spark.createDataFrame([(1, 1)], "k int, v int")
    assert upsert.upsert(one, path, ["k"], batch=("w", 0)) == 0
    assert upsert.upsert(spark.createDataFrame([(1, 9)], "k int, v int"), path, ["k"], batch=("w", 0)) == 0
    assert upsert.upsert(one, path, ["k"], batch=("x", 0)) == 1 and rows(upsert.read(spark, path)) == [(1, 1)]


def test_streamed_totals_equal_one_pass(spark, tmp_path):
    ddl = "event_id long, event_type string, value double, ts timestamp"
    made = [(i, "abc"[i % 3], float(i), f"2024-01-01 00:{i % 60:02d}:00") for i in range(90)]
    rnd = random.Random(3)
    frame = lambda part: spark.createDataFrame(part, "event_id long, event_type string, value double, ts string").withColumn("ts", F.col("ts").cast("timestamp"))
    land, path, cp = (f"file://{tmp_path}/{n}" for n in ("in", "out", "cp"))
    for k in range(3):  # the second and third files bring repeats of earlier rows, out of order
        part = made[30 * k : 30 * k + 30] + (rnd.sample(made[: 30 * k], 10) if k else [])
        rnd.shuffle(part)
        frame(part).coalesce(1).write.mode("append").parquet(land)
        streams.totals_stream(spark.readStream.schema(ddl).parquet(land), path, cp, late="2 hours").awaitTermination()
    want = streams.rule_totals(streams.distinct_events(frame(made), ["event_id"]))
    assert rows(upsert.read(spark, path)) == rows(want)
    number = upsert.commit(spark, path)["number"]
    upsert.upsert(frame(made[:1]).select("event_type", F.lit(1).cast("long").alias("n"), F.col("value").alias("total"), F.col("ts").alias("last_seen")), path, ["event_type"], batch=("totals", 0))
    assert upsert.commit(spark, path)["number"] == number  # played again: left out


def test_figures_of_the_running_job(spark, tmp_path):
    spark.range(500).withColumn("v", F.col("id") % 7).write.parquet(f"file://{tmp_path}/in")
    df = spark.read.parquet(f"file://{tmp_path}/in")
    seen, watch = reports.observed(df.filter("v > 2"), rows=F.count("*"), low=F.count_if(F.col("v") == 3))
    plan = seen._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "CollectMetrics" in plan
    kept = settle.settled(seen)
    got = reports.run_steps(spark, [watch])
    assert rows(got) == [(0, "rows", kept.count()), (1, "low", kept.filter("v = 3").count())]
    assert "- **rows:** " in reports.run_summary(got, "in", 1.0).first().text
    none, watch = reports.observed(df.filter("v > 9"), rows=F.count("*"), most=F.max("v"))
    settle.settled(none)
    assert rows(reports.run_steps(spark, [watch])) == [(0, "rows", 0), (1, "most", None)]
