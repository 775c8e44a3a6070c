"""Rooms, doors and lengths on drawing pages; page classes.

Tables carry (doc, page, ord); ord is the original place in a list and settles every tie.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed, geometry, imperial, scores, text
from ..operators.keep import keep_first, numbered, select_pages
from ..operators.near import grid_join, nearest, suppress

PAGE = ["doc", "page"]


def rooms(blocks: DataFrame, radius: float = 200.0) -> DataFrame:
    """Room numbers with the name nearest to each: names above and to the left are preferred."""
    placed = blocks.withColumn("box", geometry.box(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1")))
    cx, cy = geometry.centre(F.col("box"))
    placed = placed.withColumns({"x": cx, "y": cy, "text": text.bare(F.col("text"))})
    numbers = placed.withColumn("confidence", text.room_number_confidence(F.col("text"))).filter("confidence is not null").select(*PAGE, "ord", F.col("text").alias("number"), "confidence", F.col("box").alias("number_box"), "x", "y")
    names = placed.filter(text.is_room_name(F.col("text"))).select(*PAGE, F.col("ord").alias("rord"), F.col("text").alias("name"), F.col("box").alias("name_box"), F.col("x").alias("rx"), F.col("y").alias("ry"))
    score = F.col("dist") - 50.0 * (2 * (F.col("ry") < F.col("y")).cast("int") + (F.col("rx") < F.col("x")).cast("int"))
    best = nearest(numbers, names, PAGE, ["ord"], radius, score, extra=F.col("name") != F.col("number"))
    box = F.when(F.col("name_box").isNull(), geometry.union_box(F.col("number_box"), F.col("number_box"))).otherwise(geometry.union_box(F.col("number_box"), F.col("name_box")))
    return best.select(*PAGE, "ord", "number", "name", "confidence", "number_box", "name_box", box.alias("box"))


def room_counts(found: DataFrame) -> DataFrame:
    return found.groupBy(*PAGE).agg(F.count("*").alias("n_rooms"), F.count_if(F.col("name").isNotNull()).alias("n_named"))


def doors(curves: DataFrame, lines: DataFrame, blocks: DataFrame) -> DataFrame:
    """Doors from swing arcs, then from labels away from all found so far; numbered by page."""
    c = F.col
    labels = blocks.filter(text.is_door_label(c("text"))).select(*PAGE, c("ord").alias("rord"), text.door_number(c("text")).alias("number"), ((c("x0") + c("x1")) / 2).alias("rx"), ((c("y0") + c("y1")) / 2).alias("ry"))
    ends = [c(k) for k in ("sx", "sy", "ex", "ey", "cx", "cy", "c1x", "c1y", "c2x", "c2y")]
    arcs = curves.withColumns({"angle": geometry.arc_angle(*ends), "radius": geometry.arc_radius(*ends[:4])}).filter(geometry.is_door_arc(c("angle"), c("radius")))
    arcs = arcs.withColumns({"direction": geometry.swing(*ends[:6]), "px": F.coalesce("cx", (c("sx") + c("ex")) / 2), "py": F.coalesce("cy", (c("sy") + c("ey")) / 2)})
    # a line with an end within 5 of an end of the arc: the first such line
    tips = arcs.select(*PAGE, "ord", F.explode(F.array(F.struct(c("sx").alias("x"), c("sy").alias("y")), F.struct(c("ex").alias("x"), c("ey").alias("y")))).alias("t")).select(*PAGE, "ord", "t.x", "t.y")
    line_ends = lines.select(*PAGE, c("ord").alias("rord"), F.explode(F.array(F.struct(c("sx").alias("x"), c("sy").alias("y")), F.struct(c("ex").alias("x"), c("ey").alias("y")))).alias("t")).select(*PAGE, "rord", c("t.x").alias("rx"), c("t.y").alias("ry"))
    touched = grid_join(tips, line_ends, PAGE, 5.0, strict=True).groupBy(*PAGE, "ord").agg(F.min("rord").alias("line"))
    arcs = arcs.join(touched, [*PAGE, "ord"], "left").withColumns({"x": c("px"), "y": c("py")})
    arcs = nearest(arcs, labels, PAGE, ["ord"], 50.0, strict=True)
    found = arcs.select(*PAGE, F.lit("arc").alias("method"), "ord", "number", "x", "y", "angle", "direction", c("radius").alias("width"), scores.door_confidence(F.lit("arc"), c("angle"), c("line").isNotNull(), c("number").isNotNull()).alias("confidence"))
    taken = found.groupBy(*PAGE).agg(F.collect_list(F.struct(F.lit(-1).cast("bigint").alias("ord"), "x", "y")).alias("taken"))
    points = labels.select(*PAGE, c("rord").alias("ord"), c("rx").alias("x"), c("ry").alias("y")).join(taken, PAGE, "left")
    kind = "array<struct<ord:bigint,x:double,y:double>>"
    alone = suppress(points.withColumn("taken", F.coalesce("taken", F.array().cast(kind))), [*PAGE, "taken"], 50.0, taken=c("taken")).filter("ord >= 0")
    more = alone.select(*PAGE, "ord").join(labels.withColumnRenamed("rord", "ord"), [*PAGE, "ord"])
    none = F.lit(None).cast("double")
    more = more.select(*PAGE, F.lit("label").alias("method"), "ord", "number", c("rx").alias("x"), c("ry").alias("y"), none.alias("angle"), F.lit("unknown").alias("direction"), none.alias("width"), scores.door_confidence(F.lit("label"), F.lit(90.0), F.lit(False), c("number").isNotNull()).alias("confidence"))
    return numbered(found.unionByName(more), "door", PAGE, [F.when(c("method") == "arc", 0).otherwise(1), "ord"])


def lengths(blocks: DataFrame) -> DataFrame:
    """Lengths on pages: texts that are one, and those inside longer texts; numbered by page."""
    t = blocks.withColumn("text", text.bare(F.col("text")))
    first = keep_first(t, [*PAGE, "text", F.floor("x0"), F.floor("y0")], ["ord"])
    whole = imperial.inches(F.col("text"))
    spans = F.when(whole.isNotNull(), F.array(F.struct(F.col("text").alias("match"), F.lit(0).alias("start"), F.length("text").alias("stop")))).otherwise(imperial.within(F.col("text")))
    each = first.withColumn("embedded", whole.isNull()).withColumn("s", F.explode(spans))
    each = each.select(*PAGE, "ord", F.col("s.start").alias("start"), F.col("s.match").alias("value_text"), imperial.inches(F.col("s.match")).alias("value_inches"), "embedded", "x0", "y0", "x1", "y1")
    sure = F.when(F.col("embedded"), imperial.confidence(F.col("value_text"), True)).otherwise(imperial.confidence(F.col("value_text")))
    return numbered(each.withColumn("confidence", F.bround(sure, 3)), "dim", PAGE, ["ord", "start"])


def classified(pages: DataFrame, col: str = "text") -> DataFrame:
    """``pages`` with type, score and scores (map)."""
    kinds = list(fixed.PAGE_WORDS)
    out = pages.withColumn("_s", scores.page_scores(F.col(col)))
    out = out.withColumns({"type": scores.page_class(F.col("_s")), "score": F.greatest(*(F.col(f"_s.{k}") for k in kinds)), "scores": F.create_map(*[x for k in kinds for x in (F.lit(k), F.col(f"_s.{k}"))])})
    return out.drop("_s")


def class_counts(pages: DataFrame) -> DataFrame:
    """Pages of every class, 0 where there are none."""
    domain = pages.sparkSession.createDataFrame([(k,) for k in fixed.PAGE_CLASSES], "type string")
    return domain.join(pages.groupBy("type").agg(F.count("*").alias("n")), "type", "left").select("type", F.coalesce("n", F.lit(0)).alias("n"))


def chosen_pages(pages: DataFrame, keys: list[str], n: int = 5) -> DataFrame:
    return select_pages(classified(pages).select(*keys, "page", "type", "score"), keys, n)
