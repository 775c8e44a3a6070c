"""Queries on places: nearness, thinning, arcs, boxes.  Points are the first two components of the embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geometry, scores
from ..operators import near
from ..operators.keep import keep_first
from .base import query

c = F.col
_POINTS = "(SELECT vec_id, label, round(embedding[1]::DOUBLE * 1000, 3) AS x, round(embedding[2]::DOUBLE * 1000, 3) AS y FROM embeddings)"


def _points(t):
    at = lambda i: F.round(F.element_at("embedding", i).cast("double") * 1000, 3)
    return t.embeddings.select("vec_id", "label", at(1).alias("x"), at(2).alias("y"))


def _sides(t):
    p = _points(t)
    return p.filter("label < 5").withColumn("k", F.lit(1)), p.filter("label >= 5").select(F.lit(1).alias("k"), c("vec_id").alias("rord"), c("x").alias("rx"), c("y").alias("ry"))


@query(f"""SELECT vec_id, name_id, round(d, 6) AS dist FROM (SELECT a.vec_id, b.vec_id AS name_id, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS d,
row_number() OVER (PARTITION BY a.vec_id ORDER BY sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) - 50 * (2 * coalesce(b.y < a.y, false)::INT + coalesce(b.x < a.x, false)::INT) NULLS LAST, b.vec_id NULLS LAST) AS r
FROM (SELECT * FROM {_POINTS} WHERE label < 5) a LEFT JOIN (SELECT * FROM {_POINTS} WHERE label >= 5) b ON sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) <= 60) WHERE r = 1""")
def nearest_label(t):
    a, b = _sides(t)
    score = c("dist") - 50.0 * (2 * (c("ry") < c("y")).cast("int") + (c("rx") < c("x")).cast("int"))
    return near.nearest(a, b, ["k"], ["vec_id"], 60.0, score, under=150.0).select("vec_id", c("rord").alias("name_id"), F.round("dist", 6).alias("dist"))


@query(f"""SELECT vec_id, name_id, round(d, 6) AS dist FROM (SELECT a.vec_id, b.vec_id AS name_id, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS d, row_number() OVER (PARTITION BY a.vec_id ORDER BY sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) NULLS LAST, b.vec_id NULLS LAST) AS r
FROM (SELECT * FROM {_POINTS} WHERE label < 5) a LEFT JOIN (SELECT * FROM {_POINTS} WHERE label >= 5) b ON sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) < 25) WHERE r = 1""")
def nearest_strict_radius(t):
    a, b = _sides(t)
    return near.nearest(a, b, ["k"], ["vec_id"], 25.0, strict=True, under=0.0).select("vec_id", c("rord").alias("name_id"), F.round("dist", 6).alias("dist"))


@query(f"""SELECT a.vec_id, min(b.vec_id) AS first_id FROM (SELECT * FROM {_POINTS} WHERE label < 5) a JOIN (SELECT * FROM {_POINTS} WHERE label >= 5) b ON sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) < 30 GROUP BY 1""")
def first_within_radius(t):
    a, b = _sides(t)
    return near.grid_join(a, b, ["k"], 30.0, strict=True).groupBy("vec_id").agg(F.min("rord").alias("first_id"))


@query(f"""WITH RECURSIVE p AS (SELECT label, vec_id, x, y, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS i FROM {_POINTS}),
s AS (SELECT label, 0::BIGINT AS i, []::STRUCT(v BIGINT, x DOUBLE, y DOUBLE)[] AS kept FROM (SELECT DISTINCT label FROM p)
UNION ALL SELECT s.label, p.i, CASE WHEN len(list_filter(s.kept, lambda k: sqrt((k.x - p.x) * (k.x - p.x) + (k.y - p.y) * (k.y - p.y)) < 50)) > 0 THEN s.kept ELSE list_append(s.kept, {{'v': p.vec_id, 'x': p.x, 'y': p.y}}) END FROM s JOIN p ON p.label = s.label AND p.i = s.i + 1)
SELECT label, unnest(kept).v AS vec_id FROM (SELECT label, arg_max(kept, i) AS kept FROM s GROUP BY 1)""")
def greedy_nms(t):
    return near.suppress(_points(t), ["label"], 50.0, "vec_id").select("label", "vec_id")


@query(f"""SELECT label, vec_id, other_id, round(d, 6) AS dist FROM (SELECT a.label, a.vec_id, b.vec_id AS other_id, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS d,
row_number() OVER (PARTITION BY a.label ORDER BY sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)), a.vec_id, b.vec_id) AS r FROM {_POINTS} a JOIN {_POINTS} b ON a.label = b.label AND a.vec_id < b.vec_id AND sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) <= 20) WHERE r = 1""")
def closest_pair(t):
    p = _points(t)
    other = p.select("label", c("vec_id").alias("other_id"), c("x").alias("rx"), c("y").alias("ry"))
    pairs = near.grid_join(p, other, ["label"], 20.0, extra=c("vec_id") < c("other_id"))
    return keep_first(pairs, ["label"], ["dist", "vec_id", "other_id"]).select("label", "vec_id", "other_id", F.round("dist", 6).alias("dist"))


_ARC = "(SELECT vec_id, " + ", ".join(f"round(embedding[{i + 1}]::DOUBLE, 6) AS v{i}" for i in range(10)) + " FROM embeddings)"


def _arc(t):
    return t.embeddings.select("vec_id", *(F.round(F.element_at("embedding", i + 1).cast("double"), 6).alias(f"v{i}") for i in range(10)))


_CHORD = "sqrt((v2 - v0) * (v2 - v0) + (v3 - v1) * (v3 - v1))"
_RATIO = f"((sqrt((v6 - v0) * (v6 - v0) + (v7 - v1) * (v7 - v1)) + sqrt((v8 - v2) * (v8 - v2) + (v9 - v3) * (v9 - v3))) / 2) / ({_CHORD} / sqrt(2))"
_CROSS = "((v0 - v4) * (v3 - v5) - (v1 - v5) * (v2 - v4))"
_COS = "greatest(-1.0, least(1.0, ((v0 - v4) * (v2 - v4) + (v1 - v5) * (v3 - v5)) / (sqrt((v0 - v4) * (v0 - v4) + (v1 - v5) * (v1 - v5)) * sqrt((v2 - v4) * (v2 - v4) + (v3 - v5) * (v3 - v5)))))"


@query(f"""SELECT vec_id, round(degrees(acos({_COS})), 4) AS by_centre, CASE WHEN {_RATIO} > 0.4 AND {_RATIO} < 0.7 THEN 90.0 WHEN {_RATIO} > 0.2 AND {_RATIO} <= 0.4 THEN 45.0 WHEN {_RATIO} >= 0.7 THEN 120.0 ELSE 90.0 END::DOUBLE AS by_control,
round({_CHORD} / sqrt(2), 6) AS radius, CASE WHEN {_CROSS} > 0 THEN 'left' WHEN {_CROSS} < 0 THEN 'right' ELSE 'unknown' END AS direction FROM {_ARC}""")
def arc_geometry(t):
    v = [c(f"v{i}") for i in range(10)]
    none = F.lit(None).cast("double")
    return _arc(t).select(
        "vec_id", F.round(geometry.arc_angle(*v), 4).alias("by_centre"), geometry.arc_angle(*v[:4], none, none, *v[6:]).alias("by_control"),
        F.round(geometry.arc_radius(*v[:4]), 6).alias("radius"), geometry.swing(*v[:6]).alias("direction"),
    )


@query(f"""SELECT vec_id, round(1000 * {_CHORD} / sqrt(2), 3) AS radius, round(least(1.0, 0.5 + 0.2 * (1 - least(abs(degrees(acos({_COS})) - 90) / 20, 1.0)) + CASE WHEN v6 > 0 THEN 0.15 ELSE 0 END + CASE WHEN v7 > 0 THEN 0.15 ELSE 0 END), 4)::DOUBLE AS confidence
FROM {_ARC} WHERE degrees(acos({_COS})) BETWEEN 70 AND 110 AND 1000 * {_CHORD} / sqrt(2) BETWEEN 10 AND 500""")
def arc_filter(t):
    v = [c(f"v{i}") for i in range(10)]
    arcs = _arc(t).withColumns({"angle": geometry.arc_angle(*v), "r": 1000 * geometry.arc_radius(*v[:4])})
    return arcs.filter(geometry.is_door_arc(c("angle"), c("r"))).select("vec_id", F.round("r", 3).alias("radius"), F.round(scores.door_confidence(F.lit("arc"), c("angle"), c("v6") > 0, c("v7") > 0), 4).alias("confidence"))


_BOX = "(SELECT vec_id, least(v0, v2) * 1000 AS x0, least(v1, v3) * 1000 AS y0, greatest(v0, v2) * 1000 AS x1, greatest(v1, v3) * 1000 AS y1, v4 * 1000 AS p, v5 * 1000 AS q FROM " + _ARC + ")"


@query(f"""SELECT vec_id, round(greatest(0, least(x0, p) - 20), 4)::DOUBLE AS ux, round(greatest(0, least(y0, q) - 20), 4)::DOUBLE AS uy, round(greatest(x1, p) + 20, 4)::DOUBLE AS vx,
round(least(150.0, x1 + 30), 4)::DOUBLE AS cx, (least(150.0, x1 + 30) > greatest(0, x0 - 30) AND least(120.0, y1 + 30) > greatest(0, y0 - 30)) AS inside, round(x0 * 300 / 72, 4)::DOUBLE AS scaled FROM {_BOX}""")
def bbox_ops(t):
    v = [c(f"v{i}") * 1000 for i in range(6)]
    b = geometry.box(F.least(v[0], v[2]), F.least(v[1], v[3]), F.greatest(v[0], v[2]), F.greatest(v[1], v[3]))
    rows = _arc(t).select("vec_id", b.alias("b"), geometry.box(v[4], v[5], v[4], v[5]).alias("p"))
    union = geometry.union_box(c("b"), c("p"))
    cut = geometry.clamped(c("b"), F.lit(150.0), F.lit(120.0), 30.0)
    r = lambda x: F.round(x, 4)
    return rows.select("vec_id", r(union["x0"]).alias("ux"), r(union["y0"]).alias("uy"), r(union["x1"]).alias("vx"), r(F.least(F.lit(150.0), c("b.x1") + 30)).alias("cx"), cut.isNotNull().alias("inside"), r(geometry.scaled(c("b"), geometry.scale_factor(F.lit(300), F.lit(0.0), F.lit(1.0)))["x0"]).alias("scaled"))


@query(f"""SELECT vec_id, round(2 * 6371000 * atan2(sqrt(a), sqrt(1 - a)), 3) AS metres, 2 * 6371000 * atan2(sqrt(a), sqrt(1 - a)) <= 10000 AS on_site FROM (SELECT vec_id, pow(sin(radians(v2 - v0) / 2), 2) + cos(radians(45 + v0)) * cos(radians(45 + v2)) * pow(sin(radians(v3 - v1) / 2), 2) AS a FROM {_ARC})""")
def haversine(t):
    m = geometry.haversine(45 + c("v0"), c("v1"), 45 + c("v2"), c("v3"))
    return _arc(t).select("vec_id", F.round(m, 3).alias("metres"), (m <= 10000).alias("on_site"))
