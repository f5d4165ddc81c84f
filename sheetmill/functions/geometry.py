"""Boxes: structs x, y, w, h in shares of a page, and x0, y0, x1, y1 in pixels or points."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SHARE_BOX = T.StructType([T.StructField(n, T.DoubleType()) for n in ("x", "y", "w", "h")])
PIXEL_BOX = T.StructType([T.StructField(n, T.IntegerType()) for n in ("x0", "y0", "x1", "y1")])
# Regions of a page (x, y, w, h) in which title blocks are looked for.
BOTTOM_RIGHT = (0.65, 0.72, 0.34, 0.27)
QUARTER = (0.75, 0.75, 0.25, 0.25)
CANDIDATES = ((0.72, 0.72, 0.28, 0.28), (0.68, 0.72, 0.30, 0.26), (0.70, 0.66, 0.28, 0.34), (0.60, 0.80, 0.38, 0.18), (0.72, 0.40, 0.26, 0.56))
STRIPS = ((0.0, 0.75, 1.0, 0.25), (0.8, 0.0, 0.2, 1.0))


def whole(c: Column) -> Column:
    """Truncated towards zero."""
    return c.cast("int")


def even(c: Column) -> Column:
    """Rounded, halves to the even number."""
    return F.bround(c).cast("int")


def share_to_pixels(x, y, w, h, width, height, pad: float = 0.0) -> dict[str, Column]:
    """Truncated pixels of a padded box, clamped to the page."""
    return {
        "x0": F.greatest(F.lit(0), whole((x - pad) * width)),
        "y0": F.greatest(F.lit(0), whole((y - pad) * height)),
        "x1": F.least(width.cast("int"), whole((x + w + pad) * width)),
        "y1": F.least(height.cast("int"), whole((y + h + pad) * height)),
    }


def share_to_pixels_rounded(x, y, w, h, width, height, pad_px: int = 0) -> dict[str, Column]:
    """Rounded pixels with padding in pixels, at least one pixel wide and high."""
    width, height = width.cast("int"), height.cast("int")
    x0 = F.least(F.greatest(F.lit(0), even(x * width) - pad_px), width - 1)
    y0 = F.least(F.greatest(F.lit(0), even(y * height) - pad_px), height - 1)
    x1 = F.least(F.greatest(x0 + 1, even((x + w) * width) + pad_px), width)
    y1 = F.least(F.greatest(y0 + 1, even((y + h) * height) + pad_px), height)
    return {"x0": x0, "y0": y0, "x1": x1, "y1": y1}


def iou(a: tuple, b: tuple) -> Column:
    """Intersection over union of two boxes given as (x0, y0, x1, y1); 0 where either is not positive."""
    w = F.least(a[2], b[2]) - F.greatest(a[0], b[0])
    h = F.least(a[3], b[3]) - F.greatest(a[1], b[1])
    both = F.when((w > 0) & (h > 0), w * h).otherwise(0.0).cast("double")
    union = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - both
    return F.when((both > 0) & (union > 0), both / union).otherwise(F.lit(0.0))


def share_corners(box: Column) -> tuple:
    return box["x"], box["y"], box["x"] + box["w"], box["y"] + box["h"]


def points_to_pixels(c: Column, dpi: int) -> Column:
    return even(c * F.lit(dpi) / F.lit(72.0))


def clip_points(box: tuple, page_w: Column, page_h: Column, pad: float = 0.0) -> dict[str, Column]:
    """Rectangle in points of a padded region, clamped to the page."""
    x, y, w, h = box
    return {
        "cx0": F.greatest(F.lit(0.0), (x - pad) * page_w),
        "cy0": F.greatest(F.lit(0.0), (y - pad) * page_h),
        "cx1": F.least(page_w.cast("double"), (x + w + pad) * page_w),
        "cy1": F.least(page_h.cast("double"), (y + h + pad) * page_h),
    }


def clamp(c: Column, low=0.0, high=1.0) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high) if not isinstance(high, Column) else high, c))


def clamp_share(x, y, w, h) -> dict[str, Column]:
    """A box whose parts lie in 0 to 1 and that ends on the page."""
    x, y, w, h = clamp(x), clamp(y), clamp(w), clamp(h)
    return {"x": x, "y": y, "w": F.when(x + w > 1, 1 - x).otherwise(w), "h": F.when(y + h > 1, 1 - y).otherwise(h)}


def y_overlap(a0, a1, b0, b1) -> Column:
    """Shared height over the smaller height (1 at least)."""
    return F.greatest(F.lit(0.0), F.least(a1, b1) - F.greatest(a0, b0)) / F.greatest(F.lit(1.0), F.least(a1 - a0, b1 - b0))


def fit(width: Column, height: Column, side: int) -> dict[str, Column]:
    """Size with neither side over ``side``; never enlarged, at least 1."""
    scale = F.lit(float(side)) / F.greatest(width, height)
    small = lambda c: F.when(scale < 1, F.greatest(F.lit(1), whole(c * scale))).otherwise(c.cast("int"))
    return {"fit_w": small(width), "fit_h": small(height)}


def patches(c: Column, side: int = 28) -> Column:
    """Rounded up to a multiple of ``side``."""
    return (F.ceil(c / F.lit(float(side))) * side).cast("int")


def squared_distance(ax, ay, bx, by) -> Column:
    return (ax - bx) * (ax - bx) + (ay - by) * (ay - by)


def enlarged(width: Column, height: Column, least: int = 56, multiple: int = 28) -> dict[str, Column]:
    """Size with the shorter side scaled up to ``least``, both sides rounded up to a multiple."""
    scale = F.lit(float(least)) / F.least(width, height)
    grown = lambda c: F.when(F.least(width, height) < least, F.greatest(F.lit(1), whole(c * scale))).otherwise(c.cast("int"))
    return {"patch_w": patches(grown(width), multiple), "patch_h": patches(grown(height), multiple)}


def points_to_crop(x0, y0, x1, y1, left, top, dpi: int, ratio_w, ratio_h, width, height) -> dict[str, Column]:
    """Pixels in a crop that was rendered from (left, top) points on and resized by the ratios, clamped to its size."""
    scale = F.lit(dpi) / F.lit(72.0)
    pixel = lambda c, start, ratio, most: whole(F.greatest(F.lit(0.0), F.least(most.cast("double"), whole(c * scale - start * scale) * ratio)))
    return {"cx0": pixel(x0, left, ratio_w, width - 1), "cy0": pixel(y0, top, ratio_h, height - 1), "cx1": pixel(x1, left, ratio_w, width), "cy1": pixel(y1, top, ratio_h, height)}


def crop_to_page(x, y, w, h, left, top, page_w, page_h) -> dict[str, Column]:
    """Pixels of the page, and shares of it, of a box in pixels of a crop that starts at (left, top)."""
    px0, py0 = left + whole(x), top + whole(y)
    share = lambda c, size: c / size.cast("double")
    return {"px0": px0, "py0": py0, "px1": px0 + whole(w), "py1": py0 + whole(h), "sx": share(px0, page_w), "sy": share(py0, page_h), "sw": share(whole(w), page_w), "sh": share(whole(h), page_h)}


def region_to_page(region: tuple, x, y, w, h) -> dict[str, Column]:
    """The page's shares of a box in shares of a region, clamped to the page."""
    rx, ry, rw, rh = region
    return clamp_share(rx + x * rw, ry + y * rh, w * rw, h * rh)


def relative_crop(x0, y0, x1, y1, width, height) -> dict[str, Column]:
    """Pixels of a crop given by its corners' shares, clamped and at least one pixel wide and high."""
    low = lambda c, size: F.greatest(F.lit(0), F.least(size.cast("int") - 1, whole(c * size)))
    a, b = low(x0, width), low(y0, height)
    return {"rx0": a, "ry0": b, "rx1": F.greatest(a + 1, F.least(width.cast("int"), whole(x1 * width))), "ry1": F.greatest(b + 1, F.least(height.cast("int"), whole(y1 * height)))}
