"""Near-duplicate documents by SimHash: fingerprints that differ in at most three bits are linked.

Three bits over two halves of 32 bits leave one half with at most one differing bit, so a half without one of its bits
(the wildcard) is equal in both: every fingerprint is indexed under the 64 one-wildcard variants of its halves,
equal variants meet, and what meets is verified on all 64 bits.

Only distinct fingerprints are indexed, so copies cost nothing.  A variant's members are walked in order, each beside
the one before it and the least of them, which links nearly all of what is alike without a pair of each two.  Only
where members of a variant are still apart do they meet across components: directly where they are few, else under
variants of the other half in turn, cut into quarters and eighths, until at most 2**11 of them can differ at all.  Every link
between components is found: the same argument holds within each part, and members that are together need no link.

Defined results: a text of fewer words than a shingle has is one shingle; a null or empty text, or one without words,
has fingerprint zero and is linked like any other; texts of any length count whole (they are read in slices that
overlap by a shingle); equal fingerprints are one component, however many rows have them; a null doc_id gets its
component's least id and is no id of it (null where all are null); repeated rows stay; an empty table gives an empty
result; further columns, whatever their names, aren't read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .components import components, extended
from .scratch import Scratch
from .textkit import tidy

WORDS = 3
SEED = 42
BITS = 3
#: Bytes of a text that are taken at a time.
SLICE = 1 << 20
BLANK = re.compile(rb"[\x20\x09-\x0d]")
#: Members of a variant that meet directly; more are cut further.
SMALL = 64
#: Widths of the parts that stay to be cut, after the halves.
DEEPER = (32, 16)
BROADCAST_ROWS = 100_000
#: At most this many fingerprints are called hot, and each has more rows than all rows over this number.
HOT = 10_000


def fingerprint(raw: bytes, k: int = WORDS, seed: int = SEED) -> int:
    """The 64 bits that are set in over half of the XXH64 of a text's k-word shingles."""
    ones, n, at, words = np.zeros(64, np.int64), 0, 0, []
    while at < len(raw):
        found = BLANK.search(raw, at + SLICE)
        end = found.start() if found else len(raw)
        words += raw[at:end].lower().split()
        at = end
        if len(words) >= k:
            ones += _ones(words, k, seed)
            n += len(words) - k + 1
            words = words[len(words) - k + 1 :]
    if not n and words:
        ones, n = _ones(words, len(words), seed), 1
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def _ones(words: list[bytes], k: int, seed: int) -> np.ndarray:
    """How many of the hashes of the runs of k words have each bit."""
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 1
    end = np.cumsum(size) - 1
    start = end - size + 1
    xx = xxhash.xxh64_intdigest
    hashes = np.array([xx(joined[a:b], seed) for a, b in zip(start.tolist(), end[k - 1 :].tolist(), strict=False)], "<u8")
    return np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def _prints(k: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            bits = [fingerprint(x.as_buffer().to_pybytes(), k, seed) if x.is_valid else 0 for x in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits, pa.int64())], ["doc_id", "fp"])

    return run


def variants(start: F.Column, width: int) -> F.Column:
    """Both halves of the ``width`` bits from ``start`` on, each without one of its bits: (part, key, rest).

    key: half, wildcard and the bits that are left, as one number; rest: where the other half starts.
    """
    half = width // 2
    each = []
    for side in (0, 1):
        bits = F.expr("shiftrightunsigned(fp, cast({0} as int))".format("__s" if side == 0 else f"__s + {half}")).bitwiseAND(F.lit((1 << half) - 1))
        for i in range(half):
            kept = bits.bitwiseAND(F.lit((1 << half) - 1 - (1 << i)))
            each.append(F.struct((kept + F.lit((side * half + i) << 32)).alias("key"), (F.col("__s") + (half if side == 0 else 0)).alias("rest")))
    return F.array(*each)


def _cut(members: DataFrame, start: F.Column, width: int, over: list[str]) -> DataFrame:
    out = members.withColumn("__s", start.cast("int"))
    out = out.select(*over, "fp", F.explode(variants(F.col("__s"), width)).alias("_v"))
    return out.select(*over, "fp", F.col("_v.key").alias(f"k{width}"), F.col("_v.rest").alias(f"r{width}"))


def near(a: str, b: str, bits: int = BITS) -> F.Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= bits


def _walked(members: DataFrame, keys: list[str]) -> DataFrame:
    """Members of variants of two or more, each with the one before it and the least."""
    w = Window.partitionBy(*keys).orderBy("fp")
    out = members.withColumns({"before": F.lag("fp").over(w), "after": F.lead("fp").over(w), "least": F.first("fp").over(w)})
    return out.filter("before is not null or after is not null").drop("after")


def _links(walked: DataFrame) -> DataFrame:
    close = walked.filter("before is not null").select("fp", F.explode(F.array_distinct(F.array("before", "least"))).alias("b"))
    return close.filter(near("fp", "b")).select(F.col("fp").alias("a"), "b").distinct()


def linked(scratch: Scratch, fps: DataFrame) -> DataFrame:
    """(node, label) of the distinct fingerprints ``fp`` that are linked with others."""
    keys = ["k64"]
    crowd = scratch.table(_walked(_cut(fps, F.lit(0), 64, []), keys), "crowd-64")
    labels = components(scratch, _links(crowd), "cc-64")
    for width in (*DEEPER, None):
        of = labels.withColumnsRenamed({"node": "fp"})
        named = crowd.join(F.broadcast(of) if of.count() <= BROADCAST_ROWS else of, "fp", "left").withColumn("label", F.coalesce("label", "fp"))
        mixed = named.groupBy(*keys).agg(F.count("*").alias("n"), F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi").select(*keys, "n")
        mixed = scratch.table(mixed, f"mixed-{width}")
        apart = scratch.table(named.join(F.broadcast(mixed) if mixed.count() <= BROADCAST_ROWS else mixed, keys), f"apart-{width}")
        few = apart if width is None else apart.filter(F.col("n") <= SMALL)
        x, y = few.select(*keys, F.col("fp").alias("a"), F.col("label").alias("la")), few.select(*keys, F.col("fp").alias("b"), F.col("label").alias("lb"))
        found = x.join(y, keys).filter(F.col("la") < F.col("lb")).filter(near("a", "b")).select("a", "b").distinct()
        many = None if width is None else apart.filter(F.col("n") > SMALL)
        if many is None or not many.limit(1).count():
            return extended(scratch, labels, found, f"cc-few-{width}")
        rest = F.col(f"r{64 if width == 32 else 2 * width}")
        crowd = scratch.table(_walked(_cut(many, rest, width, keys), [*keys, f"k{width}"]), f"crowd-{width}")
        keys = [*keys, f"k{width}"]
        labels = extended(scratch, labels, found.unionByName(_links(crowd)).distinct(), f"cc-{width}")
    return labels


def simhash_components(spark: SparkSession, docs: DataFrame, words: int = WORDS, seed: int = SEED, scratch: Scratch | None = None) -> DataFrame:
    """(doc_id, fp, component_id) of every row of ``docs`` (doc_id, text); fp: the fingerprint as a signed number."""
    scratch = scratch or Scratch(spark, "simhash")
    printed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(tidy(_prints(words, seed)), "doc_id long, fp long")
    rows = scratch.table(printed, "rows")
    fps = scratch.table(rows.groupBy("fp").agg(F.min("doc_id").alias("least_id"), F.count("*").alias("n")), "fps")
    labels = linked(scratch, fps.select("fp"))
    # of fingerprints that stand alone with one row, the row's own id is the component's
    of = fps.join(labels.withColumnRenamed("node", "fp"), "fp", "left")
    least = of.filter("label is not null").groupBy("label").agg(F.min("least_id").alias("of_label"))
    told = of.filter("label is not null or n > 1").join(least, "label", "left")
    told = scratch.table(told.select(F.col("fp").alias("_fp"), "n", F.coalesce("of_label", "least_id").alias("component_id")), "told")
    about = told.agg(F.count("*"), F.sum("n")).first()
    if about[0] <= BROADCAST_ROWS:
        out = rows.join(F.broadcast(told), F.col("fp") == F.col("_fp"), "left")
    else:
        # fingerprints of so many rows that one task would hold them: fewer than HOT by their own definition
        hot = F.col("n") > about[1] / HOT
        first = rows.join(F.broadcast(told.filter(hot)), F.col("fp") == F.col("_fp"), "left")
        rest = first.filter("_fp is null").select("doc_id", "fp").join(told.filter(~hot), F.col("fp") == F.col("_fp"), "left")
        out = first.filter("_fp is not null").unionByName(rest)
    return out.select("doc_id", "fp", F.when(F.col("_fp").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its fingerprint and the least doc_id that links reach."""
    out = simhash_components(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
