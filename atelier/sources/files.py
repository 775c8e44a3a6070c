"""JSON documents in and out.  Schemas are stated, never inferred; a file that is not there is an empty table."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

POINT = "STRUCT<x: DOUBLE, y: DOUBLE>"
SIZED = "STRUCT<x: DOUBLE, y: DOUBLE, width: DOUBLE, height: DOUBLE>"
ITEM = f"STRUCT<type: STRING, p1: {POINT}, p2: {POINT}, p3: {POINT}, p4: {POINT}, x: DOUBLE, y: DOUBLE, width: DOUBLE, height: DOUBLE, points: ARRAY<{POINT}>>"
#: Vector documents, both layouts: pages with blocks and drawings, or curves, lines and texts at the top.
VECTORS = f"""source STRING, total_pages INT, dpi INT, page INT,
  pages ARRAY<STRUCT<page_number: INT, dimensions: STRUCT<width_pts: DOUBLE, height_pts: DOUBLE, width_px: DOUBLE, height_px: DOUBLE, scale_factor: DOUBLE>,
    text_blocks: ARRAY<STRUCT<text: STRING, bbox: {SIZED}, font: STRING, size: DOUBLE, flags: INT>>,
    drawings: ARRAY<STRUCT<bbox: {SIZED}, items: ARRAY<{ITEM}>, fill: STRING, stroke: STRING, width: DOUBLE>>>>,
  curves ARRAY<STRUCT<start: {POINT}, `end`: {POINT}, center: {POINT}, control1: {POINT}, control2: {POINT}>>,
  lines ARRAY<STRUCT<start: {POINT}, `end`: {POINT}>>,
  texts ARRAY<STRUCT<text: STRING, bbox: STRUCT<x0: DOUBLE, y0: DOUBLE, x1: DOUBLE, y1: DOUBLE>>>"""
ROOMS = "rooms ARRAY<STRUCT<id: STRING, plan_id: STRING, number: STRING, name: STRING, block: STRING, floor: INT, type: STRING, source: STRING, confidence: STRING, source_pages: ARRAY<INT>, primary_source: INT, extraction_method: STRING, extraction_notes: STRING, notes: STRING, area_pica: STRING, page: INT>>"


def present(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Whole JSON documents; nothing where there is no file."""
    if not present(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("multiLine", True).json(path)


def page_range(text: str) -> list[int]:
    """Pages of a literal such as 1-5,7: sorted, each once."""
    out: set[int] = set()
    for part in filter(None, (p.strip() for p in text.split(","))):
        a, _, b = part.partition("-")
        out |= set(range(int(a), int(b or a) + 1))
    return sorted(out)


def page_range_column(c: Column) -> Column:
    """The same as a column."""
    ends = lambda p: F.split(F.trim(p), "-")
    each = F.transform(F.split(c, ","), lambda p: F.sequence(F.element_at(ends(p), 1).cast("int"), F.element_at(ends(p), -1).cast("int")))
    return F.array_sort(F.array_distinct(F.flatten(each)))


def pages(vectors: DataFrame, wanted: list[int] | None = None) -> DataFrame:
    """A row for each page: doc, page, width, height, scale; pages that are not there are left out silently."""
    out = vectors.select(F.coalesce("source", F.lit("")).alias("doc"), "dpi", F.explode("pages").alias("p"))
    out = out.select("doc", F.col("p.page_number").alias("page"), F.col("p.dimensions.width_px").alias("width"), F.col("p.dimensions.height_px").alias("height"), scale("p.dimensions", "dpi").alias("scale"), F.col("p.text_blocks").alias("blocks"), F.col("p.drawings").alias("drawings"))
    return out.filter(F.col("page").isin(wanted)) if wanted else out


def totals(vectors: DataFrame) -> DataFrame:
    """(doc, n_pages, n_blocks, n_drawings) of vector documents, from their nested arrays."""
    size = lambda a: F.coalesce(F.size(a), F.lit(0))
    nested = lambda k: F.aggregate(F.coalesce("pages", F.array().cast(vectors.schema["pages"].dataType)), F.lit(0).cast("long"), lambda acc, p: acc + F.greatest(size(p[k]), F.lit(0)))
    return vectors.select(F.coalesce("source", F.lit("")).alias("doc"), F.greatest(size(F.col("pages")), F.lit(0)).alias("n_pages"), nested("text_blocks").alias("n_blocks"), nested("drawings").alias("n_drawings"))


def scale(dims: str, dpi: str) -> Column:
    """Pixels a point: the mean of both sides' ratios, else by resolution."""
    d = lambda k: F.col(f"{dims}.{k}")
    ratio = (F.try_divide(d("width_px"), d("width_pts")) + F.try_divide(d("height_px"), d("height_pts"))) / 2
    return F.coalesce(d("scale_factor"), ratio, F.coalesce(F.col(dpi), F.lit(300)) / 72)


def text_blocks(vectors: DataFrame, wanted: list[int] | None = None) -> DataFrame:
    """Texts of both layouts: doc, page, ord, text, x0, y0, x1, y1, size, bold.  Blank texts are left out."""
    new = pages(vectors, wanted).select("doc", "page", F.posexplode("blocks").alias("ord", "b"))
    new = new.select("doc", "page", "ord", F.col("b.text").alias("text"), F.col("b.bbox.x").alias("x0"), F.col("b.bbox.y").alias("y0"), (F.col("b.bbox.x") + F.col("b.bbox.width")).alias("x1"), (F.col("b.bbox.y") + F.col("b.bbox.height")).alias("y1"), F.col("b.size").alias("size"), (F.coalesce(F.col("b.flags"), F.lit(0)).bitwiseAND(16) != 0).alias("bold"))
    old = vectors.select(F.coalesce("source", F.lit("")).alias("doc"), F.coalesce("page", F.lit(1)).alias("page"), F.posexplode("texts").alias("ord", "b"))
    old = old.select("doc", "page", "ord", F.col("b.text").alias("text"), *(F.col(f"b.bbox.{k}").alias(k) for k in ("x0", "y0", "x1", "y1")), F.lit(None).cast("double").alias("size"), F.lit(False).alias("bold"))
    return new.unionByName(old).filter(F.trim("text") != "")


def shapes(vectors: DataFrame, chord_centre: bool = False) -> tuple[DataFrame, DataFrame]:
    """(curves, lines) of both layouts.  Only stated centres are kept: the middle of the chord is no centre of an arc
    (chord_centre=True puts it in)."""
    xy = lambda c, a: [F.col(f"{c}.x").alias(f"{a}x"), F.col(f"{c}.y").alias(f"{a}y")]
    items = pages(vectors).select("doc", "page", F.posexplode("drawings").alias("_d", "d")).select("doc", "page", "_d", F.posexplode("d.items").alias("_i", "i"))
    items = items.withColumn("ord", F.col("_d") * 10_000 + F.col("_i"))
    none = F.lit(None).cast("double")
    new = items.filter("i.type = 'curve'")
    mid = [((F.col("i.p1.x") + F.col("i.p4.x")) / 2).alias("cx"), ((F.col("i.p1.y") + F.col("i.p4.y")) / 2).alias("cy")] if chord_centre else [none.alias("cx"), none.alias("cy")]
    curves = new.select("doc", "page", "ord", *xy("i.p1", "s"), *xy("i.p4", "e"), *mid, *xy("i.p2", "c1"), *xy("i.p3", "c2"))
    lines = items.filter("i.type = 'line'").select("doc", "page", "ord", *xy("i.p1", "s"), *xy("i.p2", "e"))
    top = vectors.select(F.coalesce("source", F.lit("")).alias("doc"), F.coalesce("page", F.lit(1)).alias("page"), "curves", "lines")
    old = top.select("doc", "page", F.posexplode("curves").alias("ord", "c")).select("doc", "page", "ord", *xy("c.start", "s"), *xy("c.end", "e"), *xy("c.center", "c"), *xy("c.control1", "c1"), *xy("c.control2", "c2"))
    flat = top.select("doc", "page", F.posexplode("lines").alias("ord", "l")).select("doc", "page", "ord", *xy("l.start", "s"), *xy("l.end", "e"))
    return curves.unionByName(old), lines.unionByName(flat)


def write_json(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    """JSON lines, in folders by ``by``."""
    w = df.write.mode("overwrite")
    (w.partitionBy(*by) if by else w).json(path)


def replace_table(spark: SparkSession, df: DataFrame, path: str) -> str:
    """Write beside a table that is being read, then swap; the old one stays as a backup, whose path is returned.

    Each swap has a backup of its own, so a table is at the path or whole in a backup at any time.
    """
    stamp = uuid.uuid4().hex
    fresh, old = f"{path}.new-{stamp}", f"{path}.bak-{stamp}"
    df.write.mode("overwrite").parquet(fresh)
    at = lambda p: spark._jvm.org.apache.hadoop.fs.Path(p)
    fs = at(path).getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(at(path)) and not fs.rename(at(path), at(old)):
        raise OSError(f"{path} could not be set aside")
    if not fs.rename(at(fresh), at(path)):
        raise OSError(f"{fresh} could not be put at {path}")
    return old


def write_run(df: DataFrame, path: str, run: str | None = None) -> str:
    """JSON lines of one run in a folder of its own, named by the time unless ``run`` names it; returns the folder."""
    run = run or datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%fZ")
    at = f"{path}/run_ts={run}"
    df.write.mode("errorifexists").json(at)
    return at


def parsed_reply(text: Column, schema: str) -> Column:
    """struct<parsed, raw>: JSON of a model's reply, in a fenced block or plain; raw where it is neither."""
    fenced = F.regexp_extract(text, r"```(?:json)?\s*([\s\S]*?)\s*```", 1)
    json = lambda c: F.when(F.json_object_keys(c).isNotNull(), F.from_json(c, schema))
    found = F.coalesce(json(text), F.when(fenced != "", json(fenced)))
    return F.struct(found.alias("parsed"), F.when(found.isNull(), text).alias("raw"))


def media_type(path: Column) -> Column:
    end = F.lower(F.regexp_extract(path, r"\.([^.]+)$", 1))
    return F.when(end.isin("jpg", "jpeg"), "image/jpeg").when(end == "gif", "image/gif").when(end == "webp", "image/webp").otherwise("image/png")
