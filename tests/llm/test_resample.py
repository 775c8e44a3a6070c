"""Resampling against plain loops, and on odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from atelier.llm import resample

DOCS = "doc_id long, text string, score string, rank int, stream binary"


def features(text, buckets, longest):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)
    return len(words), [zlib.crc32(" ".join(words[i : i + k]).encode()) % buckets for k in range(1, longest + 1) for i in range(len(words) - k + 1)]


def plain(rows, target, percent=10, least=20, buckets=10_000, longest=1, seed=2024):
    docs = [(r[0], *features(r[1], buckets, longest)) for r in rows]
    s, t = Counter(b for d in docs for b in d[2]), Counter(b for x in target for b in features(x, buckets, longest)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets))))
    out = []
    for k, (i, n, f) in enumerate(docs):
        weight = sum(map(gain, f)) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([k, i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    able = sorted((x for x in out if x[2] >= least), key=lambda x: (-x[5], x[1] is None, x[1] or 0, x[3]))
    rank = {x[0]: r + 1 for r, x in enumerate(able[: percent * len(able) // 100])}
    return Counter((x[1], x[3], x[4], x[5], rank.get(x[0])) for x in out)


def drawn(spark, rows, target, **more):
    out = resample.resample(spark, spark.createDataFrame(rows, DOCS), spark.createDataFrame([(x,) for x in target], "text string"), **more)
    return Counter(tuple(r) for r in out.select("doc_id", "n_features", "weight", "score", "rank").collect())


def corpus(seed, n=300):
    rng = random.Random(seed)
    words = ["Éte", "naïve", "a1", "UPPER"] + [f"w{k}" for k in range(200)]
    say = lambda most: " ".join(rng.choice(words[: 4 + int(200 * rng.random() ** 2)]) for _ in range(rng.randint(0, most)))
    return [(k, say(60), "x", k, b"y") for k in range(n)], [say(30) for _ in range(12)]


@pytest.mark.parametrize("more", [{}, {"longest": 3, "buckets": 512}, {"percent": 100, "least": 0}, {"percent": 0}])
def test_equals_loops(spark, more):
    rows, target = corpus(5)
    assert drawn(spark, rows, target, **more) == plain(rows, target, **more)


def test_odd_rows(spark):
    rows, target = corpus(6, 40)
    long = " ".join(f"mot{k % 977}" for k in range(700_000))
    rows += [(None, None, None, None, None), (1000, "", "x", 1, b""), (1001, None, "x", 1, b""), (1002, " ,;- \t", "x", 1, b""), (1003, long, "x", 1, b"")]
    rows += [(None, rows[3][1] + " more" * 20, "x", 1, b"")] * 2 + [(7, rows[7][1], "again", 1, b"")] * 3 + [(2000 + k, rows[5][1], "copy", 1, b"") for k in range(30)]
    for more in ({"percent": 60}, {"percent": 100, "least": 0}):
        assert drawn(spark, rows, target + [None, ""], **more) == plain(rows, target + [None, ""], **more)


def test_empty_tables(spark):
    rows, target = corpus(7, 30)
    assert drawn(spark, [], target) == Counter()
    assert drawn(spark, rows, []) == plain(rows, [])
    assert drawn(spark, [], []) == Counter()


def test_buckets_fit_their_width(spark):
    with pytest.raises(ValueError):
        resample.resample(spark, spark.createDataFrame([], DOCS), spark.createDataFrame([], "text string"), buckets=70_000)


def test_streams_hold_documents_by_offset():
    """A block's stream is its documents' buckets one after the other; run lengths of it count every bucket."""
    texts = ["b a b", None, "", "c", "!", "a a a a"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(6), pa.int64()), pa.array(texts)], ["doc_id", "text"])
    (block,) = list(resample._streams(997, 1)([batch]))
    row = block.to_pylist()[0]
    stream = np.frombuffer(row["stream"], "<u2")
    assert row["offsets"] == [0, 3, 3, 3, 4, 4, 8] and row["words"] == [3, 0, 0, 1, 0, 4]
    assert stream.tolist() == [zlib.crc32(w) % 997 for w in (b"b", b"a", b"b", b"c", b"a", b"a", b"a", b"a")]
    runs = [r for b in resample._run_lengths([block.select(["stream"])]) for r in b.to_pylist()]
    assert {r["bucket"]: r["n"] for r in runs} == Counter(stream.tolist()) and [r["bucket"] for r in runs] == sorted(set(stream.tolist()))


def test_equal_scores_rank_over_partitions(spark):
    """A third of the rows with one doc_id: every rank once, in the order of doc_id."""
    text = " ".join(["word"] * 25)
    rows = [(5, text, "x", 1, b"")] * 200 + [(k, text, "x", 1, b"") for k in range(400)]
    out = resample.resample(spark, spark.createDataFrame(rows, DOCS), spark.createDataFrame([("word",)], "text string"), percent=50).filter("rank is not null")
    got = sorted((r["rank"], -r["score"], r["doc_id"]) for r in out.collect())
    assert [g[0] for g in got] == list(range(1, 301)) and [g[1:] for g in got] == sorted(g[1:] for g in got)
