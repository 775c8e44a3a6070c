"""Source divergence audit: how far the sources of a language are apart, and by which terms.

Occurrences are counted by (language, source, term); a language keeps the terms of at least ``least`` of its documents.
A term's counts by source, those above zero, are its vector.  Terms of the same vector are one row with a
multiplicity, every pair of sources of a vector is evaluated once and multiplied by it, and only the rows of the best vectors
go back to their terms.

Shares are whole numbers, p = 1 + floor(scale * (count + add) / (N + add * V)), so all sums are exact.  What a pair
of sources differs by is split three ways, so that no vector is widened to sources it doesn't have:
V times the difference of both shares of absent terms; what each source's own terms change in that, from its few
distinct counts; and what vectors with both sources change in turn.

Defined results: a null text, language or source is the empty string; a group without terms has the shares of
absent terms; a language without kept terms has pairs of value 0 and no terms; a language of one source has no pairs;
a repeated row is a document of its own; equal values rank by item in UTF-8 order; texts of any length count whole;
without documents the result is empty; further columns, whatever their names, aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .scratch import Scratch
from .textkit import buffers, coded, gathered, runs, spans, tidy

LEAST = 30
ADD = 5
SCALE = 1_000_000_000
TOP = 50
#: Bytes of text that are counted together before Spark adds up, and of a part of them that is held as words.
CHUNK, PART = 1 << 25, 1 << 23
BROADCAST_ROWS = 100_000
#: Pairs of sources that are held before they are added up.
HELD_PAIRS = 1 << 21
#: Letters a-z and all that is not ASCII.
LETTER = np.zeros(256, bool)
LETTER[0x61:0x7B] = LETTER[0x80:] = True
COUNTED = "lang string, source string, term string, n long, df long"


def _summed(key: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order, with the sum of each value; without values, how often a key is there."""
    if not len(key):
        return (key, *(values or (np.zeros(0, np.int64),)))
    order = np.argsort(key, kind="stable")
    key = key[order]
    head = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    if not values:
        return key[head], np.diff(np.append(head, len(key)))
    return (key[head], *(np.add.reduceat(v[order], head) for v in values))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in gathered(batches, CHUNK):
        lang, source = (batch.column(k).fill_null("").dictionary_encode() for k in (0, 1))
        group = lang.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy()
        data, offsets = buffers(batch.column(2))
        for a, b in spans(offsets, PART):
            lo = offsets[a]
            words, first = runs(data[lo : offsets[b]], offsets[a : b + 1] - lo, LETTER)
            code, vocabulary = coded(words)
            size = max(len(vocabulary), 1)
            doc = np.repeat(np.arange(b - a), np.diff(first))
            of_doc, n = _summed(doc * size + code)  # once for each term of a document
            key, n, df = _summed(group[a:b][of_doc // size] * size + of_doc % size, n, np.ones(len(n), np.int64))
            g, term = key // size, vocabulary.take(pa.array(key % size)).cast(pa.string())
            cols = [lang.dictionary.take(pa.array(g // max(len(source.dictionary), 1))), source.dictionary.take(pa.array(g % max(len(source.dictionary), 1))), term, pa.array(n), pa.array(df)]
            yield pa.RecordBatch.from_arrays([c.cast(pa.string()) if k < 3 else c.cast(pa.int64()) for k, c in enumerate(cols)], ["lang", "source", "term", "n", "df"])


def share(n: str, total: str, v: str, add: int = ADD, scale: int = SCALE) -> F.Column:
    """1 + floor(scale * (n + add) / (total + add * v)), in decimals: counts of any corpus fit."""
    wide = lambda x: f"cast({x} as decimal(18, 0))"
    return F.expr(f"1 + (cast({scale} as decimal(10, 0)) * ({wide(n)} + {add})) div ({wide(total)} + {add} * {wide(v)})")


def _own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For a source's distinct shares (p, m) and each other source of its language with share x of an absent term:
    the sum of m * (|p - x| - |p0 - x|), by prefix sums about x."""
    for batch in batches:
        for row in batch.to_pylist():
            # a: this source; others: (source, p0) of the language
            p = np.array([e["p"] for e in row["own"] or []], np.int64)
            m = np.array([e["m"] for e in row["own"] or []], np.int64)
            order = np.argsort(p, kind="stable")
            p, m = p[order], m[order]
            mass, moment = np.append(0, np.cumsum(m)), np.append(0, np.cumsum(m * p))
            names = [o["source"] for o in row["others"] if o["source"] != row["source"]]
            x = np.array([o["p0"] for o in row["others"] if o["source"] != row["source"]], np.int64)
            at = np.searchsorted(p, x, "right")
            apart = x * mass[at] - moment[at] + (moment[-1] - moment[at]) - x * (mass[-1] - mass[at])
            zero = np.abs(row["p0"] - x)
            value = apart - mass[-1] * zero
            before = np.array([row["source"].encode() < s.encode() for s in names], bool)
            value += np.where(before, row["v"] * zero, 0)  # once for each two sources
            lo = [row["source"] if k else s for k, s in zip(before, names, strict=True)]
            hi = [s if k else row["source"] for k, s in zip(before, names, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([row["lang"]] * len(names), pa.string()), pa.array(lo, pa.string()), pa.array(hi, pa.string()), pa.array(value, pa.int64())], ["lang", "lo", "hi", "value"])


def _both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For every two sources of a vector, with shares p, r and p0, r0 of absent terms: m * (|p - r| - |p - r0| - |p0 - r| + |p0 - r0|)."""
    for batch in batches:
        lang, entries = batch.column(0).dictionary_encode(), batch.column(2)
        flat, offs = entries.flatten(), entries.offsets.to_numpy()
        source = flat.field("source").dictionary_encode()
        code, p, p0 = source.indices.to_numpy().astype(np.int64), flat.field("p").to_numpy(), flat.field("p0").to_numpy()
        mult, group, width = batch.column(1).to_numpy(), lang.indices.to_numpy().astype(np.int64), max(len(source.dictionary), 1)
        offs = offs - offs[0]
        size = np.diff(offs)
        keys, values, held = [], [], 0

        def flush():
            nonlocal keys, values, held
            key, value = _summed(np.concatenate(keys), np.concatenate(values))  # noqa: B023
            keys, values, held = [], [], 0
            pair = key % (width * width)  # noqa: B023
            names = [lang.dictionary.take(pa.array(key // (width * width))), source.dictionary.take(pa.array(pair // width)), source.dictionary.take(pa.array(pair % width))]  # noqa: B023
            return pa.RecordBatch.from_arrays([*(c.cast(pa.string()) for c in names), pa.array(value, pa.int64())], ["lang", "lo", "hi", "value"])

        for k in np.unique(size[size > 1]).tolist():
            rows = np.flatnonzero(size == k)
            step = max(HELD_PAIRS // (4 * k), 1)
            for at in range(0, len(rows), step):
                r = rows[at : at + step]
                take = offs[r][:, None] + np.arange(k)
                c, x, x0, m, g = code[take], p[take], p0[take], mult[r][:, None], group[r][:, None] * width * width
                for i in range(k - 1):
                    a, a0, b, b0 = x[:, i : i + 1], x0[:, i : i + 1], x[:, i + 1 :], x0[:, i + 1 :]
                    keys.append((g + c[:, i : i + 1] * width + c[:, i + 1 :]).ravel())
                    values.append((m * (np.abs(a - b) - np.abs(a - b0) - np.abs(a0 - b) + np.abs(a0 - b0))).ravel())
                    held += len(keys[-1])
                    if held >= HELD_PAIRS:
                        yield flush()
        if held:
            yield flush()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, df): occurrences, and documents that have the term."""
    parts = docs.select(*(F.col(k).cast("string").alias(k) for k in ("lang", "source", "text"))).mapInArrow(tidy(_counted), COUNTED)
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))


def audit(spark: SparkSession, docs: DataFrame, least: int = LEAST, add: int = ADD, scale: int = SCALE, top: int = TOP, scratch: Scratch | None = None) -> DataFrame:
    """(lang, source, part, item, q, value, rank): part ``pair``, each other source of the language, farthest first;
    part ``term``, the ``top`` terms that a source has more of than its language."""
    scratch = scratch or Scratch(spark, "divergence")
    side = lambda df: F.broadcast(df) if df.count() <= BROADCAST_ROWS else df
    vector = F.array_sort(F.collect_list(F.struct("source", "n")))
    by_term = term_counts(docs).groupBy("lang", "term").agg(vector.alias("vec"), F.sum("n").alias("total"), F.sum("df").alias("df"))
    terms = scratch.table(by_term.filter(F.col("df") >= least).drop("df"), "terms")
    same = terms.groupBy("lang", "vec", "total").agg(F.count("*").alias("m"))
    vectors = scratch.table(same.withColumn("vid", F.monotonically_increasing_id()), "vectors")

    by_lang = vectors.groupBy("lang").agg(F.sum(F.col("m") * F.col("total")).alias("lang_n"), F.sum("m").alias("v"))
    own_n = vectors.select("lang", "m", F.explode("vec").alias("e")).groupBy("lang", F.col("e.source").alias("source")).agg(F.sum(F.col("m") * F.col("e.n")).alias("own_n"))
    every = docs.select(*(F.coalesce(F.col(k).cast("string"), F.lit("")).alias(k) for k in ("lang", "source"))).distinct()
    groups = every.join(own_n, ["lang", "source"], "left").join(by_lang, "lang", "left").fillna(0, ["own_n", "v", "lang_n"])
    groups = scratch.table(groups.withColumn("p0", F.when(F.col("v") > 0, share("0", "own_n", "v", add, scale)).otherwise(F.lit(0).cast("long"))), "groups")

    # every entry of a vector with its share, once for each distinct vector
    entries = vectors.select("vid", "lang", "m", "total", F.explode("vec").alias("e")).select("vid", "lang", "m", "total", "e.source", "e.n")
    entries = entries.join(side(groups), ["lang", "source"]).withColumns({"p": share("n", "own_n", "v", add, scale), "q": share("total", "lang_n", "v", add, scale)})
    entries = scratch.table(entries.select("vid", "lang", "source", "m", "p", "p0", "q"), "entries")

    others = groups.groupBy("lang").agg(F.collect_list(F.struct("source", "p0")).alias("others"))  # a language's sources
    spread = entries.groupBy("lang", "source", "p").agg(F.sum("m").alias("m")).groupBy("lang", "source").agg(F.collect_list(F.struct("p", "m")).alias("own"))
    alone = groups.join(spread, ["lang", "source"], "left").join(others, "lang").select("lang", "source", "p0", "v", "own", "others")
    kind = "lang string, lo string, hi string, value long"
    met = entries.groupBy("vid", "lang", "m").agg(F.array_sort(F.collect_list(F.struct("source", "p", "p0"))).alias("e")).filter(F.size("e") > 1).select("lang", "m", "e")
    parts = alone.mapInArrow(tidy(_own), kind).unionByName(met.mapInArrow(tidy(_both), kind))
    pairs = parts.groupBy("lang", "lo", "hi").agg(F.sum("value").alias("value"))
    ways = F.array(F.struct(F.col("lo").alias("source"), F.col("hi").alias("item")), F.struct(F.col("hi").alias("source"), F.col("lo").alias("item")))
    pairs = pairs.select("lang", F.explode(ways).alias("w"), "value").select("lang", "w.source", F.lit("pair").alias("part"), "w.item", F.lit(None).cast("long").alias("q"), "value")
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(best))

    # the vectors of the best values (all of a tie), then their terms
    over = entries.filter("p > q").withColumn("value", F.col("p") - F.col("q"))
    lead = over.withColumn("_r", F.rank().over(Window.partitionBy("lang", "source").orderBy(F.desc("value")))).filter(F.col("_r") <= top).select("vid", "source", "q", "value")
    chosen = scratch.table(lead.join(vectors.select("vid", "lang", "vec"), "vid"), "chosen")
    named = terms.join(side(chosen), ["lang", "vec"]).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "q", "value")
    named = named.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    return pairs.unionByName(named)


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources of every language against each other, and the terms each has most above its language."""
    out = audit(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("lang", "source", "part", "item", "value", "rank")


def _share_sql(n: str, total: str) -> str:
    return f"1 + ({SCALE}::HUGEINT * ({n} + {ADD})) // ({total} + {ADD} * v)"


OP11_SQL = rf"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
x AS MATERIALIZED (SELECT r, lang, source, unnest(w) AS term FROM d),
k AS MATERIALIZED (SELECT lang, term, count(*) AS total FROM x GROUP BY ALL HAVING count(DISTINCT r) >= {LEAST}),
c AS MATERIALIZED (SELECT lang, source, term, count(*) AS n FROM x SEMI JOIN k USING (lang, term) GROUP BY ALL),
l AS (SELECT lang, sum(total) AS lang_n, count(*) AS v FROM k GROUP BY 1),
g AS MATERIALIZED (SELECT lang, source, coalesce(own_n, 0) AS own_n, v, lang_n FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN (SELECT lang, source, sum(n) AS own_n FROM c GROUP BY ALL) USING (lang, source) LEFT JOIN l USING (lang)),
p AS MATERIALIZED (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, {_share_sql("coalesce(c.n, 0)", "own_n")} AS p, {_share_sql("k.total", "lang_n")} AS q FROM g JOIN k ON k.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
f AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
o AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
 UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM o QUALIFY part = 'pair' OR rank <= {TOP}
"""
