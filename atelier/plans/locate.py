"""Where rooms are on pages: by their numbers among the texts, by recognised words, on which plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed, geometry, text
from ..operators.keep import keep_first
from ..operators.near import grid_join

c = F.col
DISCIPLINES = ["architecture", "structure", "mecanique", "electrique", "civil", "autre"]


def room_keys(id_: str = "id"):
    """Texts by which a room's number may stand on a page, best first: the id, its number, its base number, dots for dashes."""
    number = F.regexp_replace(id_, "^[A-Z]-", "")
    return F.array_distinct(F.array(c(id_), number, F.regexp_extract(number, r"^(\d+)", 1), F.replace(number, F.lit("-"), F.lit("."))))


def on_page(rooms: DataFrame, spans: DataFrame, near: float = 150.0, padding: float = 30.0, width: float = 4967.0, height: float = 3509.0) -> DataFrame:
    """Box of each room on its page: the text of its number beside the text of its name that is closest to it.

    rooms: id, name, doc, page, scale; spans: doc, page, ord, text, x0, y0, x1, y1.  Without the name nearby, the number alone.
    """
    box = geometry.box(c("x0"), c("y0"), c("x1"), c("y1"))
    cx, cy = geometry.centre(c("box"))
    s = spans.withColumn("box", box).select("doc", "page", "ord", F.upper(text.bare(c("text"))).alias("key"), "box").withColumns({"x": cx, "y": cy})
    keyed = rooms.select("doc", "page", "id", F.upper("name").alias("name"), "scale", F.posexplode(room_keys()).alias("rank", "key")).filter("key <> ''")
    hits = keyed.join(s, ["doc", "page", "key"])
    best = hits.groupBy("doc", "page", "id").agg(F.min("rank").alias("rank"))
    # dots for dashes only where nothing else was found
    hits = hits.join(best, ["doc", "page", "id", "rank"])
    names = s.select("doc", "page", c("key").alias("name_text"), c("ord").alias("rord"), c("box").alias("name_box"), c("x").alias("rx"), c("y").alias("ry"))
    pairs = grid_join(hits, names, ["doc", "page"], near, strict=True, how="left", extra=c("name_text") == c("name"))
    one = keep_first(pairs, ["doc", "page", "id"], [c("dist").asc_nulls_last(), "ord", c("rord").asc_nulls_last()])
    found = F.when(c("name_box").isNull(), c("box")).otherwise(geometry.union_box(c("box"), c("name_box"), 0.0))
    out = geometry.clamped(geometry.scaled(found, c("scale")), F.lit(width), F.lit(height), padding)
    return one.select("doc", "page", "id", out.alias("box"), c("name_box").isNotNull().alias("named"))


def from_words(words: DataFrame, rooms: DataFrame, width: float, height: float, least: int = 30) -> DataFrame:
    """Boxes from recognised words: a room takes the surest word that ends in its number on a page where it is expected,
    the first of equally sure ones.

    words: page, ord, text, conf, x0, y0, x1, y1; rooms: id, page.  Rooms that no word names get the whole page.
    """
    number = F.regexp_extract("text", r"(\d{3})[A-Z]?$", 1)
    w = words.filter((c("conf") >= least) & (text.bare(c("text")) != "")).withColumn("key", number).filter("key <> ''")
    r = rooms.withColumn("key", F.regexp_extract("id", r"(\d{3})", 1))
    seen = w.join(r, ["page", "key"]).groupBy("id", "page").agg(F.max_by(F.struct("conf", geometry.box(c("x0"), c("y0"), c("x1"), c("y1")).alias("label")), F.struct("conf", -c("ord"))).alias("m"))
    found = seen.select("id", "page", geometry.room_box(c("m.label"), F.lit(width), F.lit(height)).alias("box"), c("m.label").alias("label"), (c("m.conf") / 100).alias("confidence"), F.lit(False).alias("fallback"))
    rest = rooms.select("id", "page").join(found, ["id", "page"], "left_anti")
    whole = geometry.whole_page(F.lit(width), F.lit(height))
    none = rest.select("id", "page", whole.alias("box"), F.lit(None).cast("struct<x0:double,y0:double,x1:double,y1:double>").alias("label"), F.lit(0.0).alias("confidence"), F.lit(True).alias("fallback"))
    return found.unionByName(none)


def updated(rooms: DataFrame, boxes: DataFrame) -> DataFrame:
    return rooms.drop("box").join(boxes.select("id", "box"), "id", "left")


def sightings(room_id: str, spans: DataFrame, plans: DataFrame) -> DataFrame:
    """Pages that show a room's number, with plan and description, the first sighting of each page; preferred plans first.

    plans: page, plan_id, description, preferred.
    """
    keys = [room_id, room_id.split("-", 1)[-1]]
    hits = spans.filter(text.bare(c("text")).isin(keys))
    first = keep_first(hits, ["doc", "page"], ["ord"])
    out = first.join(plans, "page", "left").select("doc", "page", "ord", "plan_id", "description", F.coalesce("preferred", F.lit(False)).alias("preferred"), geometry.box(F.greatest(F.lit(0.0), c("x0") - 50), F.greatest(F.lit(0.0), c("y0") - 50), c("x1") + 50, c("y1") + 50).alias("clip"))
    return out.orderBy(F.desc("preferred"), "page")


def plans_of(spark) -> DataFrame:
    """The drawing set's plans by page: page, plan_id, description, preferred."""
    rows = [(page, plan, about, plan in fixed.PREFERRED_PLANS) for page, plan, about in fixed.PLANS]
    return spark.createDataFrame(rows, "page int, plan_id string, description string, preferred boolean")


def picked(seen: DataFrame, plan: str | None = None, every: bool = False) -> DataFrame:
    """Of a room's sightings those that are shown: of the plans whose id holds ``plan``, or all, or the preferred plan's, else the first page's."""
    if plan:
        return seen.filter(F.contains(F.upper("plan_id"), F.lit(plan.upper())))
    return seen if every else seen.orderBy(F.desc("preferred"), "page").limit(1)


def on_all_plans(room_id: str, boxes: DataFrame) -> DataFrame:
    """Boxes of a room on every plan, disciplines in their fixed order, then by path.  boxes: path, boxes map<string, ...> by room."""
    order = F.array(*map(F.lit, DISCIPLINES))
    kind = discipline(c("path"))
    hits = boxes.withColumn("box", F.try_element_at("boxes", F.lit(room_id))).filter("box is not null").select("path", kind.alias("discipline"), "box")
    place = F.array_position(order, c("discipline"))
    return hits.orderBy(F.when(place == 0, len(DISCIPLINES) + 1).otherwise(place), "path")


def floor_pages(rooms: DataFrame) -> DataFrame:
    """The page that shows most rooms of each floor of a block, the earlier of equals."""
    counts = rooms.groupBy("block", "floor", "page").agg(F.count("*").alias("n"))
    return counts.groupBy("block", "floor").agg(F.max_by("page", F.struct("n", -c("page"))).alias("page"))


def sampled_rooms(rooms: DataFrame, boxes: DataFrame, size: int = 30) -> DataFrame:
    """Rooms to check by eye: those with a box, by block in proportion, three of each at least, ``size`` in all."""
    from ..operators.keep import stratified

    have = rooms.join(boxes.select("id").distinct(), "id", "left_semi")
    return stratified(have, "block", "id", size).orderBy(F.xxhash64("id", F.lit(42)), "id").limit(size)


def discipline(path):
    """The first folder of a plan's path, ``autre`` without one."""
    parts = F.split(path, "/")
    return F.when(F.size(parts) >= 2, F.lower(F.element_at(parts, 1))).otherwise("autre")
