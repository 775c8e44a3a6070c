"""Sections of running text: titles open them, what follows belongs to them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed

#: Numbers of a document's order that are scanned in one task.
STRETCH = 4096

def is_title(text: Column, size: Column, dominant: Column, bold: Column) -> Column:
    """Larger than the dominant size, bold, or more than three letters all in capitals."""
    capitals = (F.upper(text) == text) & (F.lower(text) != text) & (F.length(text) > 3)
    return (size > dominant) | bold | capitals


def title_level(size: Column, dominant: Column, bold: Column) -> Column:
    return F.when(size - dominant >= 4, 1).when(size - dominant >= 2, 2).when(bold, 3).otherwise(2)


def dominant_font(blocks: DataFrame, keys: list[str]) -> DataFrame:
    """The size that most text of a document has; the earlier of equals."""
    sizes = blocks.groupBy(*keys, "size").agg(F.sum(F.length("text")).alias("_w"), F.min("ord").alias("_o"))
    return sizes.groupBy(*keys).agg(F.max_by("size", F.struct("_w", -F.col("_o"))).alias("dominant"))


def _block(df: DataFrame, order: str, size: int) -> Column | None:
    """The stretch of a document that a row is in, where its order is a whole number; else there are none."""
    return F.floor(F.col(order) / size) if dict(df.dtypes)[order] in ("tinyint", "smallint", "int", "bigint") else None


def carried(df: DataFrame, keys: list[str], order: list[str], value: Column, name: str, size: int = STRETCH) -> DataFrame:
    """``df`` with the last ``value`` that isn't null up to each row of its key, in order.

    A document is dealt in stretches of ``size`` numbers of its order, each scanned by itself; what a stretch ends with is
    carried into the next ones over a table of a row for each stretch.  So one long document is dealt to all tasks.
    """
    block = _block(df, order[0], size)
    own = df.withColumns({"_value": value, "_block": F.lit(0) if block is None else block})
    up_to = Window.partitionBy(*keys, "_block").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = own.withColumn(name, F.last("_value", ignorenulls=True).over(up_to))
    if block is None:
        return out.drop("_value", "_block")
    ends = own.groupBy(*keys, "_block").agg(F.max_by("_value", F.when(F.col("_value").isNotNull(), F.struct(*order))).alias("_end"))
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumn("_before", F.last("_end", ignorenulls=True).over(before)).filter("_before is not null")
    ends = ends.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), F.col("_block").alias("_b"), "_before")
    same = F.col("_block").eqNullSafe(F.col("_b"))
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return out.join(ends, same, "left").withColumn(name, F.coalesce(name, "_before")).drop("_value", "_block", "_before", "_b", *(f"_k{i}" for i in range(len(keys))))


def filled(df: DataFrame, keys: list[str], order: list[str], opens: Column, name: str = "section", size: int = STRETCH) -> DataFrame:
    """The order value of the row that opened the section each row is in; null before the first."""
    return carried(df, keys, order, F.when(opens, F.col(order[-1])), name, size)


def numbered_rows(df: DataFrame, keys: list[str], order: list[str], name: str, size: int = STRETCH) -> DataFrame:
    """``df`` with the number of each row in its key from 0, in order, by stretches as in ``carried``."""
    block = _block(df, order[0], size)
    own = df.withColumn("_block", F.lit(0) if block is None else block)
    out = own.withColumn(name, F.row_number().over(Window.partitionBy(*keys, "_block").orderBy(*order)).cast("long") - 1)
    if block is None:
        return out.drop("_block")
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    ends = own.groupBy(*keys, "_block").agg(F.count("*").alias("_n")).withColumn("_before", F.sum("_n").over(before)).filter("_before is not null")
    ends = ends.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), F.col("_block").alias("_b"), "_before")
    same = F.col("_block").eqNullSafe(F.col("_b"))
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return out.join(ends, same, "left").withColumn(name, F.col(name) + F.coalesce("_before", F.lit(0))).drop("_block", "_before", "_b", *(f"_k{i}" for i in range(len(keys))))


def gathered(df: DataFrame, keys: list[str], order: str, text: str = "text", sep: str = "\n") -> DataFrame:
    """Rows of each key as one text, in order."""
    parts = F.array_sort(F.collect_list(F.struct(order, text)))
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows"), F.array_join(F.transform(parts, lambda p: p[text]), sep).alias("content"))


def context(df: DataFrame, keys: list[str], order: list[str], text: str = "text", before: int = 3, after: int = 2, least: int = 4, most: int = 500, size: int = STRETCH) -> DataFrame:
    """The rows about each row, those of ``least`` letters or more, joined and cut.

    Rows are numbered and dealt in stretches of ``size``; the rows at the ends of a stretch stand in its neighbour too.
    """
    if size < max(before, after):
        raise ValueError("a stretch must hold the rows about a row")
    rows = numbered_rows(df, keys, order, "_at", size)
    place, own = F.col("_at") % size, F.floor(F.col("_at") / size)
    homes = F.array_compact(F.array(own, F.when(place < after, own - 1), F.when(place >= size - before, own + 1)))
    dealt = rows.withColumn("_home", F.explode(homes))
    w = Window.partitionBy(*keys, "_home").orderBy("_at").rowsBetween(-before, after)
    out = dealt.withColumn("context", F.left(F.array_join(F.filter(F.collect_list(text).over(w), lambda t: F.length(t) >= least), " | "), F.lit(most)))
    return out.filter(F.col("_home") == own).drop("_at", "_home")


def pages_of(text: DataFrame, keys: list[str]) -> DataFrame:
    """Pages of a text with ``--- Page n ---`` separators."""
    parts = F.split(F.col("text"), "--- Page ")
    out = text.select(*keys, F.posexplode(parts).alias("_i", "_t")).filter("_i > 0")
    return out.select(*keys, F.expr(r"try_cast(regexp_extract(_t, '^(\\d+)', 1) as int)").alias("page"), F.regexp_replace("_t", r"^\d+ ---\n?", "").alias("text"))


def header_parts(pages: DataFrame, keys: list[str]) -> DataFrame:
    """Pages cut at their section headers: keys, page, n, code (null before the first header), title and text of each part.

    The title is the line above the header, unless that is a page number or a running head.
    """
    cut = pages.select(*keys, "page", F.split("text", f"(?={fixed.HEADER})").alias("_pieces"))
    before = F.concat(F.array(F.lit(None).cast("string")), F.slice("_pieces", 1, F.size("_pieces") - 1))
    each = F.zip_with("_pieces", before, lambda x, y: F.struct(x.alias("text"), y.alias("above")))
    parts = cut.select(*keys, "page", F.posexplode(each).alias("n", "_part")).select(*keys, "page", "n", "_part.*")
    code = F.regexp_replace(F.nullif(F.regexp_extract("text", f"^{fixed.HEADER}", 1), F.lit("")), r"\s+", " ")
    above = F.col("above")
    lines = F.split(F.regexp_replace(above, r"\n[^\n]*\z", ""), "\n", -1)
    line = F.when(F.contains(above, F.lit("\n")), F.regexp_replace(F.element_at(lines, -1), r"(?U)^\s+|\s+$", ""))
    title = F.when(code.isNotNull() & (line != "") & ~line.rlike(fixed.NO_TITLE), line)
    return parts.select(*keys, "page", "n", code.alias("code"), F.coalesce(title, F.lit("")).alias("title"), "text")


def spec_sections(pages: DataFrame, keys: list[str], carry: bool = True) -> DataFrame:
    """Pages, title and text of each section code.

    A page is cut at its headers: every section on it has its part, and what stands before the first header belongs to
    the section before.  carry=False gives a page whole to its first header and leaves pages without one out.
    """
    parts = header_parts(pages, keys)
    if carry:
        placed = carried(parts.withColumnRenamed("code", "_own"), keys, ["page", "n"], F.col("_own"), "code").drop("_own")
    else:
        first = parts.filter("code is not null").groupBy(*keys, "page").agg(F.min_by(F.struct("code", "title"), "n").alias("h"))
        placed = pages.join(first, [*keys, "page"]).select(*keys, "page", F.lit(0).alias("n"), "h.code", "h.title", "text")
    placed = placed.filter("code is not null and text <> ''")
    rows = F.array_sort(F.collect_list(F.struct("page", "n", "text")))
    titles = F.min_by("title", F.struct("page", "n"))
    return placed.groupBy(*keys, "code").agg(titles.alias("title"), F.array_sort(F.collect_set("page")).alias("pages"), F.array_join(F.transform(rows, lambda p: p["text"]), "\n").alias("text"))
