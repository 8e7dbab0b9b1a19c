"""Sizes, crops and boxes."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import to_int

MIN_RATIO, MAX_RATIO = 0.66, 1.5


def _box(left: Column, top: Column, right: Column, bottom: Column) -> Column:
    return F.struct(*[c.cast("long").alias(n) for n, c in (("l", left), ("t", top), ("r", right), ("b", bottom))])


def ratio_crop(w: Column, h: Column, low: float = MIN_RATIO, high: float = MAX_RATIO) -> Column:
    """A centred box that brings w / h into [low, high] by trimming the long side; halves round to even."""
    ratio, zero = w / h, F.lit(0)
    new_w, new_h = F.bround(h * F.lit(high)).cast("long"), F.bround(w / F.lit(low)).cast("long")
    left, top = F.floor((w - new_w) / 2), F.floor((h - new_h) / 2)
    return (
        F.when(ratio > high, _box(left, zero, left + new_w, h))
        .when(ratio < low, _box(zero, top, w, top + new_h))
        .otherwise(_box(zero, zero, w, h))
    )


def padded_box(x: Column, y: Column, bw: Column, bh: Column, w: Column, h: Column, pad: float) -> Column:
    """The pixels of a relative box, widened by a share of its own size on each side, cut at the image's edges."""
    l, t, r, b = x * w, y * h, (x + bw) * w, (y + bh) * h
    pw, ph = (r - l) * pad, (b - t) * pad
    whole = lambda c: c.cast("long")  # noqa: E731  truncates
    return _box(F.greatest(F.lit(0), whole(l - pw)), F.greatest(F.lit(0), whole(t - ph)), F.least(w, whole(r + pw)), F.least(h, whole(b + ph)))


def resolution_tag(width: Column, height: Column) -> Column:
    """By the short side; '' for a small one or one that isn't a number."""
    w, h = to_int(width), to_int(height)
    short = F.when(w.isNotNull() & h.isNotNull(), F.least(w, h))
    return F.when(short >= 2048, "absurdres").when(short >= 1024, "highres").otherwise("")


def too_small(w: Column, h: Column, least: int) -> Column:
    return F.least(F.coalesce(w, F.lit(0)), F.coalesce(h, F.lit(0))) < least


def text_area(boxes: Column, w: Column, h: Column) -> Column:
    """The share of an image that upright boxes around the corners of `boxes` (arrays of points x, y) cover, 1 at most."""
    def area(points: Column) -> Column:
        xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
        return ((F.array_max(xs) - F.array_min(xs)) * (F.array_max(ys) - F.array_min(ys))).cast("double")

    total = F.aggregate(F.transform(F.coalesce(boxes, F.array()), area), F.lit(0.0), lambda a, x: a + F.coalesce(x, F.lit(0.0)))
    return F.when((w * h) > 0, F.least(total / (w * h), F.lit(1.0))).otherwise(0.0)
