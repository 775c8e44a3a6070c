"""Sharding: a two-pass external shuffle.

Pass one counts the seeded hash buckets, which are so many that each fits in memory, and gives each its place in
the written order; pass two scatters the records into them, shuffles each bucket by Fisher-Yates and writes it.
The written order is one permutation of the whole input; shards are its equal ranges, so their row counts differ
by one at most.  The table of buckets stays in Spark: a bucket meets its own row of it in its task.

Defined results: nulls in any column are ordinary values (a null text has no bytes); empty and very long texts are
rows like others (a bucket holds one long text at least); repeated rows each keep their own slot; ties of the hash
are settled by the seeded shuffle; an empty table gives an empty result; the caller's columns are kept and must not
be named ``shard`` or ``slot``, which are replaced.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .scratch import Scratch, schema_with

BUCKET_BYTES = 32 << 20
#: Buckets to split that are broadcast at most; more are joined by key.
BROADCAST_ROWS = 100_000


def size_of(text: str) -> F.Column:
    return F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long") + 1


def external_shuffle(spark: SparkSession, docs: DataFrame, n_shards: int, out: str, seed: int = 17, bucket_bytes: int = BUCKET_BYTES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write ``docs`` in shuffled order below ``out``, one folder per shard, and return what was written.

    Added columns: shard (0..n_shards-1) and slot (place in the shard, gapless from 0).
    A bucket that a repeated key makes larger than four times ``bucket_bytes`` is split by row.
    """
    scratch = Scratch(spark, "sharding")
    docs = docs.drop("shard", "slot")
    total = docs.agg(F.sum(size_of(text))).first()[0] or 0
    n_buckets = max(1, math.ceil(total / bucket_bytes))
    hashed = docs.withColumns({"__h": F.xxhash64(F.lit(seed), F.col(key), F.col(text)), "__sub": F.lit(0)})
    placed = hashed.withColumn("__bucket", F.pmod("__h", F.lit(n_buckets)).cast("int"))
    counted = scratch.table(placed.groupBy("__bucket").agg(F.count("*").alias("n"), F.sum(size_of(text)).alias("size")), "counted")
    large = counted.filter(F.col("size") > 4 * bucket_bytes).select("__bucket", F.ceil(F.col("size") / bucket_bytes).cast("int").alias("__parts"))
    n_large = large.count()
    starts = counted.select("__bucket", F.lit(0).alias("__sub"), "n")
    if n_large:
        # equal rows can only be told apart by their place, so the split of these buckets is written before it is counted
        side = F.broadcast(large) if n_large <= BROADCAST_ROWS else large
        split = placed.join(side, "__bucket").withColumn("__sub", F.pmod(F.xxhash64(F.monotonically_increasing_id()), "__parts").cast("int"))
        split = scratch.table(split.select(*placed.columns), "split")
        placed = placed.join(side, "__bucket", "left_anti").select(*placed.columns).unionByName(split)
        starts = starts.join(side, "__bucket", "left_anti").unionByName(split.groupBy("__bucket", "__sub").agg(F.count("*").alias("n")))
    # a row for each bucket, numbered on end: a running sum
    before = Window.orderBy("__bucket", "__sub").rowsBetween(Window.unboundedPreceding, -1)
    starts = scratch.table(starts.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))), "starts")
    rows = starts.agg(F.sum("n")).first()[0] or 0
    cuts = np.array([s * rows // n_shards for s in range(n_shards + 1)], np.int64)
    keep = list(docs.columns)

    def shuffle(group, table, place):
        at = (group[0].as_py(), group[1].as_py())
        n, counted = table.num_rows, place["n"].to_pylist()
        if counted != [n]:
            raise RuntimeError(f"bucket {at} has {n} rows where pass one counted {counted}: the input changed between the passes")
        order = np.argsort(table["__h"].to_numpy(), kind="stable")
        deal = np.random.Generator(np.random.PCG64([seed, *at]))
        for i, j in zip(range(n - 1, 0, -1), deal.integers(0, np.arange(n, 1, -1)) if n > 1 else ()):
            order[i], order[j] = order[j], order[i]
        at_row = place["start"][0].as_py() + np.arange(n)
        shard = np.searchsorted(cuts, at_row, "right") - 1
        table = table.select(keep).take(pa.array(order))
        return table.append_column("shard", pa.array(shard, pa.int32())).append_column("slot", pa.array(at_row - cuts[shard], pa.int64()))

    schema = schema_with(docs, shard="int", slot="bigint")
    mixed = placed.groupBy("__bucket", "__sub").cogroup(starts.groupBy("__bucket", "__sub")).applyInArrow(shuffle, schema)
    mixed.write.mode("overwrite").option("compression", "zstd").partitionBy("shard").parquet(out)
    scratch.sweep()
    return spark.read.schema(schema).parquet(out)


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards under the law ``rows``."""
    scratch = Scratch(spark, "op1")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    done = external_shuffle(spark, docs, 8, f"{scratch.root}/shards")
    return done.select(
        "doc_id",
        size_of("text").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
