"""Line dedup: lines that spread over many sites are boilerplate and go.

A line is its text without blanks at the ends, known by a 64-bit hash; a site is a value of ``source``.
HyperLogLog sketches of the sites of each line hash are made from the raw rows and merge by aggregation, map
side first, so that a line of any number of documents travels as one sketch a task.  Only lines whose estimate
is near the threshold get exact (line, site) pairs and a distinct count; the rest are decided by the sketch.

With ``own`` a document all of whose lines would go is left whole: it is a copy of other documents rather than a
carrier of boilerplate, and a matter of document-level deduplication.  Without it every boilerplate line goes.

Defined results: blank lines are never counted or removed; a null text stays null with no lines; a text of
boilerplate alone keeps its blank lines or becomes empty; a null source is a site of its own; lines repeated within
a document count once for its site, and each of them goes; a line on exactly ``sites`` sites goes; repeated rows get
equal results; texts of any length are taken whole; an empty table gives an empty result; further columns pass
unchanged, but for n_lines, n_removed and left_whole, which are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import Scratch, schema_with
from .textkit import tidy

SITES = 5
LG_K = 10
#: The sketch alone decides outside these multiples of the threshold.
BAND = (0.5, 2.0)
#: Boilerplate hashes that are broadcast at most (8 bytes each); beyond, they are joined by text.
BROADCAST_MOST = 1_000_000
BLANKS = " \t\r\x0b\x0c"


def line_hashes(text: str = "text") -> F.Column:
    """Hash of each line of a text, null for a blank line."""

    def of(line):
        bare = F.btrim(line, F.lit(BLANKS))
        return F.when(bare != "", F.xxhash64(bare))

    return F.transform(F.split(F.coalesce(F.col(text), F.lit("")), "\n"), of)


def boilerplate(scratch: Scratch, docs: DataFrame, sites: int = SITES, broadcast_most: int = BROADCAST_MOST) -> DataFrame:
    """(h): hashes of the lines on at least ``sites`` distinct sources.  docs: source, __lines."""
    site = F.xxhash64(F.coalesce(F.concat(F.lit("="), "source"), F.lit("none")))
    hashes = scratch.table(docs.select(site.alias("site"), F.array_distinct(F.array_compact("__lines")).alias("hs")).filter(F.size("hs") > 0), "hashes")
    raw = hashes.select("site", F.explode("hs").alias("h"))
    sketched = raw.groupBy("h").agg(F.hll_sketch_agg("site", F.lit(LG_K)).alias("sketch"))
    judged = scratch.table(sketched.select("h", F.hll_sketch_estimate("sketch").alias("n")).filter(F.col("n") >= sites * BAND[0]), "estimates")
    sure = judged.filter(F.col("n") >= sites * BAND[1]).select("h")
    near = judged.filter(F.col("n") < sites * BAND[1]).select("h")
    # pairs of the band alone; where it is too large to broadcast, pairs are made distinct before they are dealt by line
    pairs = raw.join(F.broadcast(near), "h", "left_semi").distinct() if near.count() <= broadcast_most else raw.distinct().join(near, "h", "left_semi")
    exact = pairs.groupBy("h").agg(F.count("*").alias("n")).filter(F.col("n") >= sites).select("h")
    return scratch.table(sure.unionByName(exact), "boilerplate")


def _strip(at: int, hashes: int, hits: int | None, known, own_line: bool) -> object:
    def run(batches):
        table = known.value if known is not None else None
        for batch in batches:
            lists = batch.column(hashes)
            flat = lists.flatten()
            offs = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            values = flat.fill_null(0).to_numpy(zero_copy_only=False)
            blank = flat.is_null().to_numpy(zero_copy_only=False)
            if table is not None:
                hit = np.isin(values, table)
            else:
                own = batch.column(hits).to_pylist()
                hit = np.concatenate([np.isin(values[a:b], np.array(h or [], np.int64)) for a, b, h in zip(offs[:-1], offs[1:], own)] or [np.zeros(0, bool)])
            hit &= ~blank
            n_lines = np.add.reduceat(np.concatenate((~blank, [False])), offs[:-1]) if len(offs) > 1 else np.zeros(0, np.int64)
            some = np.concatenate(([0], np.cumsum(hit)))
            removed = some[offs[1:]] - some[offs[:-1]]
            texts, whole = batch.column(at), np.zeros(batch.num_rows, bool)
            changed = {}
            for d in np.flatnonzero(removed):
                lines = texts[int(d)].as_py().encode().split(b"\n")
                go = hit[offs[d] : offs[d + 1]]
                live = ~blank[offs[d] : offs[d + 1]]
                if own_line and go[live].all():
                    whole[d], removed[d] = True, 0
                else:
                    changed[int(d)] = b"\n".join(x for x, g in zip(lines, go) if not g).decode()
            if changed:
                mask = np.zeros(batch.num_rows, bool)
                mask[list(changed)] = True
                texts = pc.replace_with_mask(texts, pa.array(mask), pa.array(list(changed.values()), texts.type))
            cols = [texts if i == at else c for i, c in enumerate(batch.columns) if i not in (hashes, hits)]
            names = [x for i, x in enumerate(batch.schema.names) if i not in (hashes, hits)]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(n_lines.astype(np.int64)), pa.array(removed.astype(np.int64)), pa.array(whole)], names=[*names, "n_lines", "n_removed", "left_whole"])

    return run


def strip_boilerplate(spark: SparkSession, docs: DataFrame, sites: int = SITES, broadcast_most: int = BROADCAST_MOST, own: bool = False) -> DataFrame:
    """``docs`` with boilerplate lines taken out of ``text``; adds n_lines, n_removed and left_whole."""
    scratch = Scratch(spark, "lines")
    docs = docs.drop("n_lines", "n_removed", "left_whole", "__lines")
    hashed = docs.withColumn("__lines", line_hashes())
    known = boilerplate(scratch, hashed.select("source", "__lines"), sites, broadcast_most)
    schema = schema_with(docs, n_lines="bigint", n_removed="bigint", left_whole="boolean")
    at, lh = docs.columns.index("text"), len(docs.columns)
    if known.count() <= broadcast_most:
        table = spark.sparkContext.broadcast(np.sort(known.toArrow()["h"].to_numpy()))
        return hashed.mapInArrow(tidy(_strip(at, lh, None, table, own)), schema)
    keyed = hashed.withColumn("__text", F.md5("text"))
    hits = keyed.select("__text", F.explode(F.array_distinct(F.array_compact("__lines"))).alias("h")).distinct().join(known, "h").groupBy("__text").agg(F.collect_list("h").alias("__hits"))
    joined = keyed.join(hits, "__text", "left").select(*docs.columns, "__lines", "__hits")
    return joined.mapInArrow(tidy(_strip(at, lh, lh + 1, None, own)), schema)


def op7_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document after boilerplate lines are gone, as counts and a digest of its text."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    return strip_boilerplate(spark, docs).select("doc_id", "n_lines", "n_removed", F.md5("text").alias("text_md5"), F.octet_length("text").cast("long").alias("n_bytes"))


_BARE = r"trim(l, ' ' || chr(9) || chr(13) || chr(11) || chr(12))"
OP7_SQL = f"""
WITH x AS (SELECT doc_id, source, text, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS MATERIALIZED (SELECT doc_id, source, unnest(ls) AS l, generate_subscripts(ls, 1) AS i FROM x),
b AS MATERIALIZED (SELECT {_BARE} AS k FROM l WHERE {_BARE} <> '' GROUP BY 1 HAVING count(DISTINCT coalesce('=' || source, 'none')) >= {SITES}),
m AS (SELECT doc_id, l, i, {_BARE} <> '' AS live, b.k IS NOT NULL AS hit FROM l LEFT JOIN b ON {_BARE} = b.k),
g AS (SELECT doc_id, count(*) FILTER (live) AS n_lines, count(*) FILTER (hit) AS n_removed, string_agg(l, chr(10) ORDER BY i) FILTER (NOT hit) AS rest FROM m GROUP BY 1)
SELECT x.doc_id, n_lines, n_removed, md5(CASE WHEN n_removed = 0 THEN text ELSE coalesce(rest, '') END) AS text_md5, strlen(CASE WHEN n_removed = 0 THEN text ELSE coalesce(rest, '') END)::BIGINT AS n_bytes
FROM x JOIN g USING (doc_id)
"""
