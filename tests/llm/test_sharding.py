from collections import Counter

import pytest

from atelier.llm import sharding

SCHEMA = "doc_id long, text string, shard string"
ROWS = [(i, f"text {i} " * (i % 7), "own") for i in range(200)] + [(None, None, None), (None, None, None), (5, "text 5 " * 5, "own"), (900, "", "x"), (901, "long " * 20_000, "x")]


def shuffled(spark, tmp_path, rows, **kw):
    return sharding.external_shuffle(spark, spark.createDataFrame(rows, SCHEMA), 8, f"file://{tmp_path}/out", **kw).collect()


@pytest.mark.parametrize("bucket_bytes", [1 << 20, 500])
def test_every_row_has_one_place(spark, tmp_path, bucket_bytes):
    got = shuffled(spark, tmp_path, ROWS, bucket_bytes=bucket_bytes)
    assert Counter((r.doc_id, r.text) for r in got) == Counter((a, b) for a, b, _ in ROWS)
    sizes = Counter(r.shard for r in got)
    assert set(sizes) <= set(range(8)) and max(sizes.values()) - min(sizes.values()) <= 1
    for s, n in sizes.items():
        assert sorted(r.slot for r in got if r.shard == s) == list(range(n))


def test_a_repeated_row_is_split_over_buckets(spark, tmp_path):
    got = shuffled(spark, tmp_path, [(1, "same text " * 10, "x")] * 300, bucket_bytes=2000)
    sizes = Counter(r.shard for r in got)
    assert sum(sizes.values()) == 300 and max(sizes.values()) - min(sizes.values()) <= 1


def test_order_follows_the_seed(spark, tmp_path):
    order = lambda seed, at: [r.doc_id for r in sorted(shuffled(spark, tmp_path / at, ROWS[:100], seed=seed), key=lambda r: (r.shard, r.slot))]
    a = order(1, "a")
    assert a == order(1, "b") != order(2, "c") and a != sorted(a)


def test_empty(spark, tmp_path):
    df = spark.createDataFrame([], SCHEMA)
    assert sharding.external_shuffle(spark, df, 8, f"file://{tmp_path}/out").count() == 0


def test_query(spark):
    import zlib

    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in sharding.op1_sharding(spark, sf).collect():
        raw = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "rows", None)
