"""Boxes, arcs and places as columns.  A box is struct<x0, y0, x1, y1>."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scores import let


def box(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return F.struct(x0.cast("double").alias("x0"), y0.cast("double").alias("y0"), x1.cast("double").alias("x1"), y1.cast("double").alias("y1"))


def from_size(b: Column) -> Column:
    """From struct<x, y, width, height>."""
    return box(b["x"], b["y"], b["x"] + b["width"], b["y"] + b["height"])


def from_list(b: Column) -> Column:
    """From array<x1, y1, x2, y2>."""
    return box(b[0], b[1], b[2], b[3])


def centre(b: Column) -> tuple[Column, Column]:
    return (b["x0"] + b["x1"]) / 2, (b["y0"] + b["y1"]) / 2


def distance(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    return F.hypot(ax - bx, ay - by)


def union_box(a: Column, b: Column, padding: float = 20.0, exact: bool = True) -> Column:
    """Box about both, padded, not left or above 0.  exact=False keeps the size that the unclamped edges give."""
    x0, y0 = F.least(a["x0"], b["x0"]) - padding, F.least(a["y0"], b["y0"]) - padding
    x1, y1 = F.greatest(a["x1"], b["x1"]) + padding, F.greatest(a["y1"], b["y1"]) + padding
    cx, cy = F.greatest(F.lit(0.0), x0), F.greatest(F.lit(0.0), y0)
    return box(cx, cy, x1, y1) if exact else box(cx, cy, cx + (x1 - x0), cy + (y1 - y0))


def clamped(b: Column, width: Column, height: Column, padding: float = 0.0) -> Column:
    """A padded window inside width by height; null if nothing of it is left."""
    out = [F.greatest(F.lit(0.0), b["x0"] - padding), F.greatest(F.lit(0.0), b["y0"] - padding), F.least(width, b["x1"] + padding), F.least(height, b["y1"] + padding)]
    return F.when((out[2] > out[0]) & (out[3] > out[1]), box(*out))


def scaled(b: Column, factor: Column) -> Column:
    return box(*(b[k] * factor for k in ("x0", "y0", "x1", "y1")))


def room_box(label: Column, width: Column, height: Column, times: float = 8.0) -> Column:
    """The box of a room about its label, so many times the label's size."""
    cx, cy = centre(label)
    w, h = (label["x1"] - label["x0"]) * times / 2, (label["y1"] - label["y0"]) * times / 2
    return clamped(box(cx - w, cy - h, cx + w, cy + h), width, height)


def whole_page(width: Column, height: Column, margin: float = 100.0) -> Column:
    return box(F.lit(margin), F.lit(margin), width - margin, height - margin)


def percent_box(b: Column, width: Column, height: Column) -> Column:
    return box(F.floor(b["x0"] * width / 100), F.floor(b["y0"] * height / 100), F.floor(b["x1"] * width / 100), F.floor(b["y1"] * height / 100))


def scale_factor(dpi: Column, most_x: Column, page_width: Column) -> Column:
    """Pixels a point: of a stated dpi, else of the first of 300, 200, 150 under which the boxes fit the page."""
    tried = F.lit(1.0)
    for d in (150, 200, 300):
        tried = F.when(most_x / (d / 72) <= page_width, d / 72).otherwise(tried)
    return F.when(dpi > 0, dpi / 72).when(most_x > 2 * page_width, tried).otherwise(1.0)


def arc_angle(sx: Column, sy: Column, ex: Column, ey: Column, cx: Column, cy: Column, c1x: Column, c1y: Column, c2x: Column, c2y: Column) -> Column:
    """Degrees of an arc: by its centre if known, else by how far its control points stand from its ends."""
    ax, ay, bx, by = sx - cx, sy - cy, ex - cx, ey - cy
    m = F.hypot(ax, ay) * F.hypot(bx, by)
    by_centre = F.when(m > 0, F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), (ax * bx + ay * by) / m)))))
    chord = F.hypot(ex - sx, ey - sy)
    ratio = F.try_divide((F.hypot(c1x - sx, c1y - sy) + F.hypot(c2x - ex, c2y - ey)) / 2, chord / F.sqrt(F.lit(2.0)))
    rest = F.when(chord > 0, 90.0).otherwise(0.0)
    by_control = let(ratio, lambda r: F.when((r > 0.4) & (r < 0.7), 90.0).when((r > 0.2) & (r <= 0.4), 45.0).when(r >= 0.7, 120.0))
    return F.coalesce(by_centre, by_control, rest)


def arc_radius(sx: Column, sy: Column, ex: Column, ey: Column) -> Column:
    return F.hypot(ex - sx, ey - sy) / F.sqrt(F.lit(2.0))


def is_door_arc(angle: Column, radius: Column, least: float = 10, most: float = 500) -> Column:
    return angle.between(70, 110) & radius.between(least, most)


def swing(sx: Column, sy: Column, ex: Column, ey: Column, cx: Column, cy: Column) -> Column:
    """To which side a door opens: the sign of the turn from its start to its end about the centre."""
    cross = (sx - cx) * (ey - cy) - (sy - cy) * (ex - cx)
    return F.when(cross > 0, "left").when(cross < 0, "right").otherwise("unknown")


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column, radius: float = 6_371_000.0) -> Column:
    """Metres between two places."""
    p1, p2, dp, dl = F.radians(lat1), F.radians(lat2), F.radians(lat2 - lat1), F.radians(lon2 - lon1)
    a = F.pow(F.sin(dp / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dl / 2), 2)
    return 2 * radius * F.atan2(F.sqrt(a), F.sqrt(1 - a))
