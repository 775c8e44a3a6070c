"""Importance resampling of documents towards a target distribution of hashed word runs, by external sort-count.

The first pass writes every document's features as buckets: packed 16-bit streams of blocks of documents, with the
offset of each document in its block.  The second sorts each stream and run-length encodes it, and Spark adds up
the runs.  A bucket's gain compares its share in the target with that in the documents.  The third gathers the gains
along the streams and sums them between offsets with ``np.add.reduceat``; texts are read and hashed once.

Noise of a Gumbel distribution, fixed by seed and doc_id, turns the best scores into a weighted draw without
replacement.  The draw is ranked over range partitions: no task holds more than its share of the drawn documents.

Defined results: a null or empty text, or one without words, has no features and weight 0 and isn't drawn unless
``least`` is 0; texts of any length count whole; a null doc_id draws as the empty text and comes after all others in
ties; repeated rows are documents of their own, those of equal doc_id, score and number of features in any order, which
no result shows; without documents the result is empty; without a target each gain depends on the documents
alone; further columns, whatever their names, aren't read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import Scratch, partitions
from .textkit import buffers, coded, runs, spans, tidy

BUCKETS = 10_000
LONGEST = 1
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024
GAIN_SCALE = 1000
#: Bytes of text of a block; a longer text is a block of its own.
BLOCK_BYTES = 1 << 22
#: Letters a-z, digits and all that is not ASCII.
WORD = np.zeros(256, bool)
WORD[0x30:0x3A] = WORD[0x61:0x7B] = WORD[0x80:] = True
STREAMS = "ids array<bigint>, words array<bigint>, offsets array<bigint>, stream binary"


def feature_buckets(words: pa.Array, first: np.ndarray, buckets: int, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, offsets): crc32 modulo ``buckets`` of all runs of 1 to ``longest`` words, by document."""
    code, vocabulary = coded(words)
    said = vocabulary.to_pylist()
    state = np.array([zlib.crc32(w) for w in said], np.uint64)[code]
    parts, owners = [state], [np.repeat(np.arange(len(first) - 1), np.diff(first))]
    for k in range(2, longest + 1):
        # a run of k words is one of k - 1 and the next word, whose bytes carry its checksum on
        n = len(code) - k + 1
        if n <= 0:
            break
        inside = owners[0][:n] == owners[0][k - 1 :]
        pair, back = np.unique((state[:n][inside] << np.uint64(32)) | code[k - 1 :][inside].astype(np.uint64), return_inverse=True)
        grown = np.array([zlib.crc32(b" " + said[int(p) & 0xFFFFFFFF], int(p) >> 32) for p in pair], np.uint64)
        state = np.zeros(n, np.uint64)
        state[inside] = grown[back] if len(pair) else 0
        parts.append(state[inside])
        owners.append(owners[0][:n][inside])
    value, owner = np.concatenate(parts), np.concatenate(owners)
    if len(parts) > 1:
        order = np.argsort(owner, kind="stable")
        value, owner = value[order], owner[order]
    offsets = np.searchsorted(owner, np.arange(len(first)))
    return (value % np.uint64(buckets)).astype("<u2"), offsets


def _streams(buckets: int, longest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, (data, offsets) = batch.column(0), buffers(batch.column(1))
            for a, b in spans(offsets, BLOCK_BYTES):
                lo = offsets[a]
                words, first = runs(data[lo : offsets[b]], offsets[a : b + 1] - lo, WORD)
                stream, at = feature_buckets(words, first, buckets, longest)
                row = [[ids.slice(a, b - a).to_pylist()], [np.diff(first)], [at], [stream.tobytes()]]
                kinds = [pa.list_(pa.int64())] * 3 + [pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, kinds, strict=True)], ["ids", "words", "offsets", "stream"])

    return run


def _run_lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, n) of each sorted stream."""
    for batch in batches:
        for held in batch.column(0):
            x = np.sort(np.frombuffer(held.as_buffer(), "<u2"), kind="stable")
            head = np.flatnonzero(np.concatenate((np.ones(min(len(x), 1), bool), x[1:] != x[:-1])))
            yield pa.RecordBatch.from_arrays([pa.array(x[head].astype(np.int32)), pa.array(np.diff(np.append(head, len(x))))], ["bucket", "n"])


def _weights(gains):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = gains.value
        for batch in batches:
            for k in range(batch.num_rows):
                ids, words = batch.column(0)[k].values, batch.column(1)[k].values
                at = batch.column(2)[k].values.to_numpy()
                along = gain[np.frombuffer(batch.column(3)[k].as_buffer(), "<u2")]
                n = np.diff(at)
                total = np.zeros(len(n), np.int64)
                if len(along):
                    total[n > 0] = np.add.reduceat(along, at[:-1][n > 0])
                yield pa.RecordBatch.from_arrays([ids.cast(pa.int64()), words.cast(pa.int64()), pa.array(n), pa.array(total // np.maximum(n, 1))], ["doc_id", "n_words", "n_features", "weight"])

    return run


def counts(streams: DataFrame, buckets: int) -> np.ndarray:
    """How often each bucket is in the streams: ``buckets`` numbers."""
    found = streams.select("stream").mapInArrow(tidy(_run_lengths), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, np.int64)
    out[found["bucket"].to_numpy()] = found["n"].to_numpy()
    return out


def gains(target: np.ndarray, own: np.ndarray) -> np.ndarray:
    """floor(1000 ln(share in the target / share in the documents)) of each bucket, one added to every count."""
    buckets, t_all, s_all = len(own), int(target.sum()), int(own.sum())
    return np.array([math.floor(GAIN_SCALE * math.log(float((int(t) + 1) * (s_all + buckets)) / float((int(s) + 1) * (t_all + buckets)))) for t, s in zip(target, own, strict=True)], np.int64)


def noise(seed: int, doc_id: str = "doc_id") -> F.Column:
    """floor(-1000 ln(-ln u)), u in (0, 1) by a digest of seed and doc_id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 256)
    u = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    return F.floor(-GAIN_SCALE * F.log(-F.log(u))).cast("long")


def ranked(scratch: Scratch, pool: DataFrame, order: list, most: int, name: str) -> DataFrame:
    """``pool`` with ``rank`` from 1 in a total order, null beyond ``most``; rows are numbered within range partitions.

    Only the numbers of rows of the partitions, as many as there are partitions, come to the driver.
    """
    dealt = pool.repartitionByRange(partitions(scratch.spark), *order).sortWithinPartitions(*order)
    dealt = scratch.table(dealt.withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}), name)
    sizes = sorted((r[0], r[1]) for r in dealt.groupBy("_part").count().collect())
    before, rows = 0, []
    for part, n in sizes:
        rows.append((part, before))
        before += n
    side = scratch.spark.createDataFrame(rows, "_p int, _before long")
    place = F.col("_before") + F.col("_at") + 1
    out = dealt.join(F.broadcast(side), F.col("_part") == F.col("_p"))
    return out.withColumn("rank", F.when(place <= most, place)).drop("_part", "_at", "_p", "_before")


def resample(spark: SparkSession, docs: DataFrame, target: DataFrame, percent: int = PERCENT, least: int = LEAST_WORDS, buckets: int = BUCKETS, longest: int = LONGEST, seed: int = SEED, scratch: Scratch | None = None) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every row of ``docs`` (doc_id, text); ``target``: text.

    rank is null for what is not drawn; floor(percent * N / 100) of the N documents of at least ``least`` words are.
    """
    if not 0 < buckets <= 1 << 16:
        raise ValueError("buckets are kept in 16 bits")
    scratch = scratch or Scratch(spark, "resample")
    stream = tidy(_streams(buckets, longest))
    own = scratch.table(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(stream, STREAMS), "own")
    wanted = target.select(F.lit(None).cast("long").alias("doc_id"), "text").mapInArrow(stream, STREAMS)
    gain = spark.sparkContext.broadcast(gains(counts(wanted, buckets), counts(own, buckets)))  # ``buckets`` numbers
    weighed = own.mapInArrow(tidy(_weights(gain)), "doc_id long, n_words long, n_features long, weight long")
    scored = scratch.table(weighed.withColumn("score", F.col("weight") + noise(seed)), "scored")
    # Scores are whole numbers within the span of gains and noise, about 2 * 10^5 values at most whatever the number of documents.
    able = F.col("n_words") >= least
    held = scored.filter(able).groupBy("score").agg(F.count("*").alias("n")).toArrow().sort_by([("score", "descending")])
    n = held["n"].to_numpy()
    draw = percent * int(n.sum()) // 100
    shut = F.lit(False)
    if draw:
        cut = held["score"].to_numpy()[np.searchsorted(np.cumsum(n), draw)]
        shut = able & (F.col("score") >= int(cut))
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("_row")]
    pool = scored.filter(shut).withColumn("_row", F.monotonically_increasing_id())
    drawn = ranked(scratch, pool, order, draw, "drawn").drop("_row")
    rest = scored.filter(~shut).withColumn("rank", F.lit(None).cast("long"))
    return drawn.unionByName(rest)


def op12_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with weight, score and rank in the draw towards ``benchmark``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = resample(spark, docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")


OP12_SQL = rf"""
WITH tab AS MATERIALIZED (SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(3988292384::BIGINT, c // 2) ELSE c // 2 END)) AS t),
dw AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
bw AS MATERIALIZED (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark),
dx AS MATERIALIZED (SELECT r, unnest(w) AS w FROM dw),
v AS (SELECT w, hex(encode(w)) AS x FROM (SELECT w FROM dx UNION SELECT w FROM bw)),
crc AS MATERIALIZED (SELECT w, xor(4294967295::BIGINT, list_reduce(list_concat([4294967295::BIGINT], list_transform(range(len(x) // 2), lambda i: ('0x' || substr(x, (2 * i + 1)::BIGINT, 2))::BIGINT)), lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1]))) % {BUCKETS} AS b FROM v, tab),
s AS (SELECT b, count(*) AS s FROM dx JOIN crc USING (w) GROUP BY 1), t AS (SELECT b, count(*) AS t FROM bw JOIN crc USING (w) GROUP BY 1),
g AS MATERIALIZED (SELECT i.b, floor({GAIN_SCALE} * ln(((coalesce(t, 0) + 1) * ((SELECT coalesce(sum(s), 0) FROM s) + {BUCKETS}))::DOUBLE / ((coalesce(s, 0) + 1) * ((SELECT coalesce(sum(t), 0) FROM t) + {BUCKETS}))::DOUBLE))::BIGINT AS gain FROM (SELECT unnest(range({BUCKETS})) AS b) i LEFT JOIN s ON s.b = i.b LEFT JOIN t ON t.b = i.b),
m AS (SELECT r, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight FROM dx JOIN crc USING (w) JOIN g ON g.b = crc.b GROUP BY 1),
c AS (SELECT doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0) AS weight, ('0x' || substr(sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h FROM dw LEFT JOIN m ON m.r = dw.r),
x AS (SELECT doc_id, n_features, weight, weight + floor(-{GAIN_SCALE} * ln(-ln((h + 0.5::DOUBLE) / 4294967296.0::DOUBLE)))::BIGINT AS score FROM c),
k AS (SELECT *, row_number() OVER (PARTITION BY n_features >= {LEAST_WORDS} ORDER BY score DESC, doc_id, n_features) AS place, count(*) FILTER (n_features >= {LEAST_WORDS}) OVER () AS n FROM x)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= {LEAST_WORDS} AND place <= {PERCENT} * n // 100 THEN place END AS rank FROM k
"""
