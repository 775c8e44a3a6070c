"""Joins by nearness: an equi-join on grid cells, then the distance; never every row against every row."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .keep import keep_first
from .settle import settled

#: Points of a key that are thinned as one array.
FEW = 2_000
#: Places of a cell of the first radius of ``nearest``, about, and how often the radius is halved for that at most.
CELL, HALVINGS = 4, 16


def grid_join(left: DataFrame, right: DataFrame, keys: list[str], radius: float, strict: bool = False, how: str = "inner", extra: Column | None = None) -> DataFrame:
    """Pairs within ``radius``.  left: keys, x, y, ...; right: keys, rx, ry, ... (other names).  Adds ``dist``.

    Cells are as wide as the radius; the right side stands in its own and the eight cells around it.
    """
    cell = lambda c: F.floor(F.col(c) / radius)
    a = left.withColumns({"_gx": cell("x"), "_gy": cell("y")})
    around = lambda c: F.sequence(cell(c) - 1, cell(c) + 1)
    b = right.withColumn("_gx", F.explode(around("rx"))).withColumn("_gy", F.explode(around("ry")))
    b = b.select(*(F.col(c).alias(f"_r_{c}") if c in (*keys, "_gx", "_gy") else F.col(c) for c in b.columns))
    on = [a[c] == b[f"_r_{c}"] for c in (*keys, "_gx", "_gy")]
    dist = F.hypot(F.col("x") - F.col("rx"), F.col("y") - F.col("ry"))
    near = dist < radius if strict else dist <= radius
    cond = on[0]
    for c in (*on[1:], near, *([extra] if extra is not None else [])):
        cond = cond & c
    return a.join(b, cond, how).withColumn("dist", dist).drop("_gx", "_gy", *(f"_r_{c}" for c in (*keys, "_gx", "_gy")))


def nearest(left: DataFrame, right: DataFrame, keys: list[str], id_: list[str], radius: float, score: Column | None = None, tie: str = "rord", strict: bool = False, extra: Column | None = None, under: float | None = None) -> DataFrame:
    """Every row of left with its best row of right (least score, then tie), or with nulls.

    ``under``: how far a score may lie below ``dist`` at most (0 without a score), where score is of both places alone and
    right is no more than keys, rx, ry and the tie; then crowded places cost no more than others: see ``_widening``.
    """
    value = F.col("dist") if score is None else score
    if under is not None:
        pairs = _widening(left, right, keys, radius, value, tie, strict, under)
    else:
        pairs = grid_join(left, right, keys, radius, strict, "left", extra)
    return keep_first(pairs, [*keys, *id_], [value.asc_nulls_last(), F.col(tie).asc_nulls_last()])


def _same(keys: list[str], other: str) -> Column:
    return reduce(and_, (F.col(k).eqNullSafe(F.col(f"{other}{k}")) for k in keys))


def _widening(left: DataFrame, right: DataFrame, keys: list[str], radius: float, value: Column, tie: str, strict: bool, under: float) -> DataFrame:
    """``left`` with the best row of right for each place, by rounds of a radius that doubles.

    A place is asked once, however many rows share it, and so is a place of right, for its least tie.  The first radius is such
    that a cell holds about ``CELL`` places.  What lies beyond a radius r has a score of r - under at least, so a place whose
    best is less is settled and only the others are looked for farther away.
    """
    cell = lambda r: F.xxhash64(*keys, F.floor(F.col("rx") / r), F.floor(F.col("ry") / r))
    there = settled(right.filter("rx is not null and ry is not null").groupBy(*keys, "rx", "ry").agg(F.min(tie).alias(tie)))
    open_ = settled(left.filter("x is not null and y is not null").select(*keys, "x", "y").distinct())
    sizes = [radius / 2**i for i in range(HALVINGS)]
    n, *cells = there.agg(F.count("*"), *(F.approx_count_distinct(cell(r)) for r in sizes)).first()
    r = next((r for r, m in zip(sizes, cells) if n <= CELL * m), sizes[-1])
    best = None
    while True:
        last = r >= radius
        pairs = grid_join(open_, there, keys, r, strict and last).withColumn("_value", value)
        found = settled(keep_first(pairs, [*keys, "x", "y"], ["_value", tie]))
        done = found if last else found.filter(F.col("_value") < r - under)
        best = done if best is None else best.unionByName(done)
        if last:
            break
        place = done.select(*(F.col(k).alias(f"_d_{k}") for k in (*keys, "x", "y")))
        open_ = settled(open_.join(place, _same([*keys, "x", "y"], "_d_"), "left_anti"))
        r = min(2 * r, radius)
    best = best.drop("_value").select(*(F.col(k).alias(f"_d_{k}") for k in (*keys, "x", "y")), "rx", "ry", tie, "dist")
    return left.join(best, _same([*keys, "x", "y"], "_d_"), "left").drop(*(f"_d_{k}" for k in (*keys, "x", "y")))


def suppress(points: DataFrame, keys: list[str], radius: float, order: str = "ord", taken: Column | None = None, most: int = FEW) -> DataFrame:
    """Greedy thinning: in order, a point stays if none that stays is nearer than ``radius``; ``taken`` starts the list.

    A key of up to ``most`` points is thinned as one array (a page's labels).  A larger one is thinned in rounds over all
    its cells at once, until that many are undecided: see ``_rounds``.  Points without a place stay.
    """
    kind = "array<struct<ord:bigint,x:double,y:double>>"
    rows = points.select(*keys, F.col(order).cast("bigint").alias("_ord"), F.col("x").cast("double").alias("_x"), F.col("y").cast("double").alias("_y"), (F.array() if taken is None else taken).cast(kind).alias("_taken"))
    large = rows.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > most)
    if not large.limit(1).count():
        return _in_arrays(rows, keys, radius).withColumnRenamed("ord", order)
    rows = settled(rows)
    sized = F.col("_n").isNotNull()
    named = large.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), "_n")
    rows = rows.join(named, reduce(and_, (F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys))), "left").withColumn("_large", sized)
    small = _in_arrays(rows.filter("not _large"), keys, radius)
    apart = rows.filter("_large").select(*keys, "_ord", "_x", "_y", F.coalesce("_taken", F.array().cast(kind)).alias("_taken"))
    begun = apart.select(*keys, "_taken").distinct().select(*keys, F.explode("_taken").alias("p")).select(*keys, "p.ord", "p.x", "p.y")
    free = apart.filter(~F.coalesce(F.exists("_taken", lambda k: F.hypot(F.col("_x") - k["x"], F.col("_y") - k["y"]) < radius), F.lit(False)))
    return small.unionByName(begun).unionByName(_rounds(free.drop("_taken"), keys, radius, most)).withColumnRenamed("ord", order)


def _in_arrays(rows: DataFrame, keys: list[str], radius: float) -> DataFrame:
    """keys, ord, x, y of the points that stay; a key's points are one array."""
    each = rows.groupBy(*keys).agg(F.first("_taken").alias("_t"), F.array_sort(F.collect_list(F.struct(F.col("_ord").alias("ord"), F.col("_x").alias("x"), F.col("_y").alias("y")))).alias("_p"))
    close = lambda e: lambda k: F.hypot(e["x"] - k["x"], e["y"] - k["y"]) < radius
    kept = F.aggregate("_p", F.col("_t"), lambda acc, e: F.when(F.exists(acc, close(e)), acc).otherwise(F.array_append(acc, e)))
    return each.select(*keys, F.explode(kept).alias("p")).select(*keys, "p.ord", "p.x", "p.y")


def _rounds(rows: DataFrame, keys: list[str], radius: float, most: int) -> DataFrame:
    """The points that stay, by rounds; no task holds a key and no two points of a crowd are paired.

    Cells are so small that of a cell's points one at most can stay: the first that is undecided.  It stays where no
    neighbouring cell has an earlier undecided point that could be too near; then all points near those that stay go.  The
    first point of all stays in every round, so this ends; what order and places are like decides how soon (a few rounds
    where they have nothing to do with each other, many where the points follow a line in order).
    """
    cell = [*keys, "_gx", "_gy"]
    side = radius / 1.5
    same = lambda x, y: [F.col(f"{x}.{k}").eqNullSafe(F.col(f"{y}.{k}")) for k in cell]
    around = lambda df: df.withColumn("_gx", F.explode(F.sequence(F.col("_gx") - 2, F.col("_gx") + 2))).withColumn("_gy", F.explode(F.sequence(F.col("_gy") - 2, F.col("_gy") + 2)))
    far = lambda a, b: F.hypot(F.col(f"{a}.x") - F.col(f"{b}.x"), F.col(f"{a}.y") - F.col(f"{b}.y"))

    both = lambda conditions, last: reduce(and_, [*conditions, last])
    point = F.struct(F.col("_ord").alias("ord"), F.col("_x").alias("x"), F.col("_y").alias("y"))
    nowhere = F.coalesce(F.isnan("_x") | F.isnan("_y"), F.lit(True))
    out = rows.filter(nowhere).select(*keys, F.col("_ord").alias("ord"), F.col("_x").alias("x"), F.col("_y").alias("y"))
    open_ = settled(rows.filter(~nowhere).select(*keys, point.alias("p"), F.floor(F.col("_x") / side).alias("_gx"), F.floor(F.col("_y") / side).alias("_gy")).distinct())
    while open_.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > most).limit(1).count():
        first = settled(open_.groupBy(*cell).agg(F.min("p").alias("m"), F.count("*").alias("n")))
        near = around(first.withColumns({"_ox": F.col("_gx"), "_oy": F.col("_gy")}))
        earlier = both(same("a", "b"), ((F.col("b._ox") != F.col("a._gx")) | (F.col("b._oy") != F.col("a._gy"))) & (F.col("b.m") < F.col("a.m")) & ((F.col("b.n") > 1) | (far("a.m", "b.m") < radius)))
        stay = settled(first.alias("a").join(near.alias("b"), earlier, "left_anti"))
        out = out.unionByName(stay.select(*keys, "m.ord", "m.x", "m.y"))
        reach = around(stay.select(*cell, "m"))
        open_ = settled(open_.alias("a").join(reach.alias("b"), both(same("a", "b"), far("a.p", "b.m") < radius), "left_anti"))
    rest = open_.select(*keys, F.col("p.ord").alias("_ord"), F.col("p.x").alias("_x"), F.col("p.y").alias("_y"), F.array().cast("array<struct<ord:bigint,x:double,y:double>>").alias("_taken"))
    return out.unionByName(_in_arrays(rest, keys, radius))
