"""Boxes under placement, rotation and perspective, and checks of their order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEG = 57.29577951308232


def placed(x: Column, place: Column, canvas: Column, image: Column) -> Column:
    """A coordinate after the text is put on the canvas; the place is kept on it."""
    return x + F.greatest(F.lit(0), F.least(place, canvas - image))


def rotated(x0: Column, y0: Column, x1: Column, y1: Column, width: Column, height: Column, degrees: Column) -> tuple[Column, Column, Column, Column]:
    """Bounds of a box after the image is turned about its centre onto a canvas that holds it whole (counter-clockwise, y down)."""
    c, s = F.cos(degrees / DEG), F.sin(degrees / DEG)
    ac, as_ = F.abs(c), F.abs(s)
    new_w, new_h = width * ac + height * as_, width * as_ + height * ac
    cx, cy = (x0 + x1) / 2.0 - width / 2.0, (y0 + y1) / 2.0 - height / 2.0
    mx, my = cx * c + cy * s + new_w / 2.0, -cx * s + cy * c + new_h / 2.0
    dx, dy = ((x1 - x0) * ac + (y1 - y0) * as_) / 2.0, ((x1 - x0) * as_ + (y1 - y0) * ac) / 2.0
    return mx - dx, my - dy, mx + dx, my + dy


def homography(width: Column, height: Column, corners: list[tuple[Column, Column]]) -> list[Column]:
    """The map from an image's corners (clockwise from the top left) to four points: a..h of (ax+by+c)/(gx+hy+1), closed form."""
    (xa, ya), (xb, yb), (xc, yc), (xd, yd) = corners
    dx1, dx2, sx = xb - xc, xd - xc, xa - xb + xc - xd
    dy1, dy2, sy = yb - yc, yd - yc, ya - yb + yc - yd
    det = dx1 * dy2 - dx2 * dy1
    g, h = (sx * dy2 - dx2 * sy) / det, (dx1 * sy - sx * dy1) / det
    return [(xb - xa + g * xb) / width, (xd - xa + h * xd) / height, xa, (yb - ya + g * yb) / width, (yd - ya + h * yd) / height, ya, g / width, h / height]


def warped(x0: Column, y0: Column, x1: Column, y1: Column, m: list[Column]) -> tuple[Column, Column, Column, Column]:
    """Bounds of a box under a homography."""
    a, b, c, d, e, f, g, h = m
    points = [((a * x + b * y + c) / (g * x + h * y + 1.0), (d * x + e * y + f) / (g * x + h * y + 1.0)) for x, y in ((x0, y0), (x1, y0), (x1, y1), (x0, y1))]
    xs, ys = [p[0] for p in points], [p[1] for p in points]
    return F.least(*xs), F.least(*ys), F.greatest(*xs), F.greatest(*ys)


def order_valid(boxes: DataFrame, keys: list[str], direction: str, position: str) -> DataFrame:
    """``keys, valid``: whether neighbouring boxes follow the direction; fewer than two are valid."""
    w = Window.partitionBy(*keys).orderBy(position)
    d = F.col(direction)
    step = F.when(d == "left_to_right", F.col("x0") - F.lag("x0").over(w)).when(d == "right_to_left", F.lag("x1").over(w) - F.col("x1")).when(d == "top_to_bottom", F.col("y0") - F.lag("y0").over(w)).otherwise(F.lag("y1").over(w) - F.col("y1"))
    return boxes.withColumn("_step", step).groupBy(*keys).agg(F.coalesce(F.bool_and(F.col("_step") >= 0), F.lit(True)).alias("valid"))
