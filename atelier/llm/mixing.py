"""Mixing sources to target weights by iterative proportional fitting, with DataFrame functions only.

Token counts are summed to cells of (source, language, topic).  Raking scales the cells until their
totals match the target of every source, language and topic; the factor of a cell, over the largest
factor, is the probability with which its documents are kept.  Rounds go on until no total is further from its
target than ``TOLERANCE`` of it, or ``MOST_ROUNDS`` are done (targets that no weights of the cells meet); the largest
distance that is left is returned with every row (``residual``).

With a stated ``share`` the probability is min(1, c * factor) instead, c such that this share of all tokens is
expected: then a small cell of a high factor is kept whole and doesn't set the rate of all others.  Cells at 1
fall short of their targets by what c * factor has beyond 1.

Defined results: a null in source or language is a value of its own; a null or empty text has no
tokens and topic ``empty``, and where a cell holds no tokens its factor is the mean of 1; ties and
repeated rows are kept or left together, since the draw depends on doc_id and seed; a null doc_id
draws as the text ``null``; texts of any length count whole; an empty table gives an empty result; further
columns are passed through, but for those that are added, which are replaced (``topic`` is read where it is asked for).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .scratch import Scratch

DIMS = ("source", "lang", "topic")
ALPHA = 0.7  # targets: share of tokens to this power
ROUNDS = 4  # in one plan; the residual is read between plans
SQL_ROUNDS = 12
MOST_ROUNDS = 240
TOLERANCE = 1e-10
SEED = 29
#: Cells up to this number are raked in one task without an exchange, and broadcast; more are dealt by key.
SMALL_CELLS = 100_000
SPACES = "[\\x20\\x09-\\x0D]+"
#: First match decides.
TOPICS = (("table", " | "), ("markup", "###"), ("shout", "!! "))


def tokens(text: str = "text") -> F.Column:
    words = F.split(F.coalesce(F.col(text), F.lit("")), SPACES)
    return (F.size(words) - F.when(F.element_at(words, 1) == "", 1).otherwise(0) - F.when((F.size(words) > 1) & (F.element_at(words, -1) == ""), 1).otherwise(0)).cast("long")


def topic(text: str = "text", n: str = "n_tokens") -> F.Column:
    t = F.col(text)
    out = F.when(F.coalesce(F.col(n), F.lit(0)) == 0, "empty")
    for name, mark in TOPICS:
        out = out.when(F.contains(t, F.lit(mark)), name)
    return out.when(F.col(n) < 100, "note").when(F.col(n) < 1000, "article").otherwise("book")


def tempered(cells: DataFrame, dim: str, alpha: float = ALPHA) -> DataFrame:
    """Targets for one dimension: token shares to the power alpha, scaled to one."""
    sums = cells.groupBy(dim).agg(F.pow(F.sum("w"), F.lit(alpha)).alias("t"))
    every = sums.agg(F.sum("t")).first()[0] or 1.0  # one number
    return sums.select(dim, (F.col("t") / F.lit(every)).alias(f"target_{dim}"))


def rake(cells: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Cells with columns w, total and target_<dim>: adds ``fit``, or takes it further, raked to every target in turn,
    and ``gap``: how far the cell's totals are from their targets, relative to these."""
    out = cells if "fit" in cells.columns else cells.withColumn("fit", F.col("w"))
    for _ in range(rounds):
        for dim in DIMS:
            total = F.sum("fit").over(Window.partitionBy(dim))
            out = out.withColumn("fit", F.when(total > 0, F.col("fit") * F.col(f"target_{dim}") * F.col("total") / total).otherwise(F.lit(0.0)))
    gaps = [F.coalesce(F.abs(F.try_divide(F.sum("fit").over(Window.partitionBy(dim)), F.col(f"target_{dim}") * F.col("total")) - 1), F.lit(0.0)) for dim in DIMS]
    return out.withColumn("gap", F.greatest(*gaps))


def scale(fitted: DataFrame, share: float) -> float:
    """The c at which the cells' tokens times min(1, c * factor) come to ``share`` of all.  It grows until no further cell meets 1."""
    c, capped = 0.0, -1
    while True:
        full = F.col("factor") * F.lit(c) >= 1
        n, held, rest, total = fitted.agg(F.count_if(full), F.sum(F.when(full, F.col("w"))), F.sum(F.when(~full, F.col("w") * F.col("factor"))), F.sum("w")).first()
        if not total:
            return share
        if n == capped or not rest:
            return c
        c, capped = max(c, (share * total - (held or 0.0)) / rest), n


def fit_cells(spark: SparkSession, scratch: Scratch, docs: DataFrame, targets: dict[str, DataFrame] | None = None, share: float | None = None) -> tuple[DataFrame, int]:
    """Cells with factor, probability and the residual, and their number.  targets: {dimension: (dimension, target_<dimension>)}."""
    cells = scratch.table(docs.groupBy(*DIMS).agg(F.sum("n_tokens").cast("double").alias("w")), "cells")
    n = cells.count()
    small = n <= SMALL_CELLS
    base = cells.coalesce(1) if small else cells
    full = base.withColumn("total", F.lit(float(cells.agg(F.sum("w")).first()[0] or 0.0)))
    for dim in DIMS:
        side = ((targets or {}).get(dim) or tempered(cells, dim)).withColumnRenamed(dim, "_k")
        side = F.broadcast(side) if small else side
        full = full.join(side, F.col(dim).eqNullSafe(F.col("_k")), "left").drop("_k").fillna(0.0, [f"target_{dim}"])
    done, far = 0, None
    while far is None or far > TOLERANCE and done < MOST_ROUNDS:
        full = scratch.table(rake(full), f"raked-{done}")
        full = full.coalesce(1) if small else full
        done, far = done + ROUNDS, full.agg(F.max("gap")).first()[0] or 0.0  # one number
    fitted = full.select(*DIMS, "w", F.when(F.col("w") > 0, F.col("fit") / F.col("w")).otherwise(1.0).alias("factor"), F.lit(far).alias("residual"))
    if share is not None:
        return fitted.select(*DIMS, "factor", F.least(F.lit(1.0), F.col("factor") * F.lit(scale(fitted, share))).alias("prob"), "residual"), n
    top = max(fitted.agg(F.max("factor")).first()[0] or 0.0, 1e-300)
    return fitted.select(*DIMS, "factor", (F.col("factor") / F.lit(top)).alias("prob"), "residual"), n


def unit(seed: int = SEED, key: str = "doc_id") -> F.Column:
    """A number in [0, 1) for each key: 52 bits of an md5."""
    digest = F.md5(F.concat(F.coalesce(F.col(key).cast("string"), F.lit("null")), F.lit(f"/{seed}")))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def mix(spark: SparkSession, docs: DataFrame, scratch: Scratch | None = None, targets: dict[str, DataFrame] | None = None, seed: int = SEED, share: float | None = None, own_topic: str | None = None) -> DataFrame:
    """``docs`` with n_tokens, topic, factor, prob, residual and sampled (all rows; the caller filters).

    share: of all tokens, to expect in the draw; own_topic: the column that holds topics, else the form of the text is one.
    """
    scratch = scratch or Scratch(spark, "mixing")
    given = docs.withColumn("__topic", F.col(own_topic)) if own_topic else docs
    counted = given.drop("n_tokens", "topic", "factor", "prob", "residual", "sampled").withColumn("n_tokens", tokens())
    counted = counted.withColumn("topic", F.col("__topic") if own_topic else topic()).drop("__topic")
    cells, n = fit_cells(spark, scratch, counted.select(*DIMS, "n_tokens"), targets, share=share)
    side = cells.select(*(F.col(d).alias(f"__{d}") for d in DIMS), "factor", "prob", "residual")
    side = F.broadcast(side) if n <= SMALL_CELLS else side
    same = F.lit(True)
    for d in DIMS:
        same = same & F.col(d).eqNullSafe(F.col(f"__{d}"))
    return counted.join(side, same, "left").drop(*(f"__{d}" for d in DIMS)).withColumn("sampled", unit(seed) < F.col("prob"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its cell's probability and whether it is drawn."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source", "lang")
    return mix(spark, docs).select("doc_id", "source", "lang", "topic", "n_tokens", F.round("factor", 6).alias("factor"), F.round("prob", 6).alias("prob"), "sampled")


def op10_sql(rounds: int = SQL_ROUNDS, alpha: float = ALPHA, seed: int = SEED) -> str:
    """The same raking in ANSI SQL, one common table for each step."""
    marks = " ".join(f"WHEN contains(text, '{m}') THEN '{n}'" for n, m in TOPICS)
    steps = [
        r"d0 AS (SELECT doc_id, source, lang, text, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS n_tokens FROM documents)",
        f"d AS (SELECT doc_id, source, lang, n_tokens, CASE WHEN n_tokens = 0 THEN 'empty' {marks} WHEN n_tokens < 100 THEN 'note' WHEN n_tokens < 1000 THEN 'article' ELSE 'book' END AS topic FROM d0)",
        "c AS (SELECT source, lang, topic, sum(n_tokens)::DOUBLE AS w FROM d GROUP BY ALL)",
    ]
    for x in DIMS:
        steps.append(f"t_{x} AS (SELECT {x}, pow(sum(w), {alpha}) / sum(pow(sum(w), {alpha})) OVER () AS target_{x} FROM c GROUP BY {x})")
    joins = " ".join(f"JOIN t_{x} ON c.{x} IS NOT DISTINCT FROM t_{x}.{x}" for x in DIMS)
    steps.append(f"r0 AS MATERIALIZED (SELECT c.source, c.lang, c.topic, w, w AS fit, sum(w) OVER () AS total, target_source, target_lang, target_topic FROM c {joins})")
    k = 0
    for _ in range(rounds):
        for x in DIMS:
            steps.append(f"r{k + 1} AS MATERIALIZED (SELECT source, lang, topic, w, CASE WHEN sum(fit) OVER (PARTITION BY {x}) > 0 THEN fit * target_{x} * total / sum(fit) OVER (PARTITION BY {x}) ELSE 0 END AS fit, total, target_source, target_lang, target_topic FROM r{k})")
            k += 1
    steps.append(f"f AS (SELECT source, lang, topic, CASE WHEN w > 0 THEN fit / w ELSE 1 END AS factor FROM r{k})")
    steps.append("p AS (SELECT *, factor / max(factor) OVER () AS prob FROM f)")
    draw = f"('0x' || substr(md5(coalesce(d.doc_id::VARCHAR, 'null') || '/{seed}'), 1, 13))::BIGINT / {2**52}.0::DOUBLE"
    return "WITH " + ",\n".join(steps) + f"\nSELECT d.doc_id, d.source, d.lang, d.topic, d.n_tokens, round(factor, 6) AS factor, round(prob, 6) AS prob, {draw} < prob AS sampled FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source AND d.lang IS NOT DISTINCT FROM p.lang AND d.topic = p.topic"
