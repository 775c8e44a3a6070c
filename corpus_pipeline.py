"""The corpus pipeline: raw documents to calibrated, tokenised training documents, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written as Parquet and read
again as the next stage's documents.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atelier.llm import jaccard, linededup, mixing, pieces, quality
from atelier.llm.scratch import Scratch

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Share of the tokens that mixing_sources draws.
TOKEN_SHARE = 0.5


def _same(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rule or meet a learned rule go.  Rules are learned from the labels of these documents.

    A null or empty text has no words, fails the base rule and goes; a null doc_id has no label and is judged like
    others; equal texts share a verdict, so repeated rows go or stay together; without labels the base rule alone decides;
    further columns are left out.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return quality.judged(spark, docs, labels).filter("kept").select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines on many sources go from every text that has a line of its own; documents stay, n_chars is counted again.

    A null or empty text and one of boilerplate alone stay as they are; a null source is a site; a null doc_id is no
    matter; repeated rows stay and get equal texts; a line on exactly the least number of sites goes.
    """
    return _same(linededup.strip_boilerplate(spark, docs, own=True))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the first by doc_id, then by text, then by its other columns.

    A null doc_id comes after all others.  Verdicts are of rows: rows that share a doc_id are one document only where
    all of their columns are equal.  A document without words (null and empty texts too) groups with nothing and stays.
    """
    scratch = Scratch(spark, "near")
    groups = jaccard.grouped(spark, docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    label_of = groups.filter("label is not null").select("tkey", "label").distinct()
    other = F.xxhash64(*(F.coalesce(F.to_json(F.struct(c)), F.lit("")) for c in docs.columns if c not in ("doc_id", "text")))
    named = docs.withColumns({"__text": F.md5("text"), "__other": other})
    place = F.struct(F.col("doc_id").isNull().alias("late"), F.col("doc_id").alias("id"), F.col("__text").alias("text"), F.col("__other").alias("other"))
    # the first row of each text, then of each group of texts: sums of the map side, however many copies a text has
    of_text = scratch.table(named.groupBy("__text").agg(F.min(place).alias("first"), F.count("*").alias("n")), "of_text")
    joined = of_text.join(label_of.withColumnRenamed("tkey", "__text"), "__text")
    first = joined.groupBy("label").agg(F.min("first").alias("first"), F.sum("n").alias("n")).filter("n > 1")
    # texts in groups of several rows alone are looked up, so that all others stay where they are
    marked = scratch.table(joined.select("__text", "label").join(first, "label").select(F.col("__text").alias("__of"), "first"), "marked")
    side = F.broadcast(marked) if marked.count() <= jaccard.BROADCAST_ROWS else marked
    kept = named.join(side, F.col("__text") == F.col("__of"), "left").filter(F.col("first").isNull() | F.col("first").eqNullSafe(place))
    # equal rows that are the first of their group: one of them
    again = scratch.table(named.groupBy("__text", "doc_id", "__other").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("__text").alias("__t"), F.col("doc_id").alias("__d"), F.col("__other").alias("__o")), "again")
    again = F.broadcast(again) if again.count() <= jaccard.BROADCAST_ROWS else again
    kept = kept.join(again, (F.col("__text") == F.col("__t")) & F.col("doc_id").eqNullSafe(F.col("__d")) & (F.col("__other") == F.col("__o")), "left")
    one = kept.filter("first is not null and __t is not null").dropDuplicates(["__text", "doc_id", "__other"])
    return kept.filter("first is null or __t is null").unionByName(one).select(*COLUMNS)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn towards the target weights of source, language and topic; half of all tokens are expected in the draw.

    Nulls of source and language are values of their own; a null or empty text has topic ``empty``, costs no tokens and
    stays with the probability of its cell; a null doc_id draws as the text ``null``; rows of one doc_id and cell are
    drawn or left together.
    """
    return mixing.mix(spark, docs, share=TOKEN_SHARE).filter("sampled").select(*COLUMNS)


def piece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of the pieces of every text; a null text has null ids and n_ids 0, an empty one no ids; every row stays."""
    return pieces.encode(docs).select("doc_id", "lang", "source", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_ids"), "ids", "round_trip")


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("mixing_sources", mixing_sources),
    ("piece_encoding", piece_encoding),
]

#: Learned rules and piece ids have no SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result a written table."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch.table(stage(spark, docs, sf_dir), name)
    return docs
