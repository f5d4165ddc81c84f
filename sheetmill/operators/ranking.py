"""Top-1 choices, label matches and ordered merges; every order ends in an explicit ordinal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import CANDIDATES, iou, squared_distance
from ..functions.text import filled
from .grouping import PAGE

# Labels beside which title-block fields stand, and further anchors of title blocks.
DRAWING_LABELS = ("DRAWING NO", "DRAWING NO.", "DWG NO", "DWG NO.", "DRG NO", "DRG NO.", "SHEET NO", "SHEET NO.", "SHEET NUMBER", "SHEET", "DWG", "DRG", "เลขที่แบบ", "เลขที่")
TITLE_LABELS = ("TITLE", "DRAWING TITLE", "DRAWING NAME", "SHEET TITLE", "SHEET NAME", "SUBJECT", "DESCRIPTION", "ชื่อแบบ", "หัวข้อ", "ชื่อเรื่อง", "ชื่อแบบ/หัวข้อ")
MORE_ANCHORS = ("SCALE", "DATE", "PROJECT", "REV", "REVISION", "มาตราส่วน", "วันที่", "โครงการ", "แก้ไข")
LABEL_WORDS = ("DRAWING", "NO", "NUMBER", "SHEET", "เลขที่แบบ")
GRID_KEYWORDS = ("DRAWING", "TITLE", "PROJECT", "ARCHITECT", "ENGINEER", "SHEET", "NO", "NUMBER")


def greedy_distinct(candidates: Column, least: float = 0.6) -> Column:
    """Boxes of an array, without those that an earlier kept box of the same text overlaps by ``least``."""
    corners = lambda c: tuple(c[n].cast("double") for n in ("x0", "y0", "x1", "y1"))
    seen = lambda kept, c: F.exists(kept, lambda o: (o["text"] == c["text"]) & (iou(corners(o), corners(c)) >= least))
    return F.aggregate(candidates, F.slice(candidates, 1, 0), lambda kept, c: F.when(seen(kept, c), kept).otherwise(F.concat(kept, F.array(c))))


def first_row(rows: DataFrame, keys: list[str], *order) -> DataFrame:
    """The first row of each key in the given order."""
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("rank = 1").drop("rank")


def matched_label(text: Column, labels: tuple[str, ...]) -> Column:
    """The first label of the list that a line holds, null if none."""
    upper = F.upper(text)
    out = F.when(F.contains(upper, F.lit(labels[0])), labels[0])
    for label in labels[1:]:
        out = out.when(F.contains(upper, F.lit(label)), label)
    return out


def label_lines(lines: DataFrame, labels: tuple[str, ...], order: str = "line_no") -> DataFrame:
    """The first line of each page that holds a label, with the label."""
    return first_row(lines.withColumn("matched_label", matched_label(F.col("text"), labels)).filter("matched_label IS NOT NULL"), list(PAGE), order)


def anchor_score(lines: DataFrame, labels: tuple[str, ...] = tuple(dict.fromkeys(DRAWING_LABELS + TITLE_LABELS + MORE_ANCHORS))) -> DataFrame:
    """(page, score): hits of labels in lines, plus the number of different labels hit."""
    upper = F.upper("text")
    hit = F.explode(F.filter(F.array(*(F.when(F.contains(upper, F.lit(label)), label) for label in labels)), lambda x: x.isNotNull()))
    hits = lines.select(*PAGE, hit.alias("label")).groupBy(*PAGE).agg((F.count("*") + F.count_distinct("label")).alias("score"))
    return lines.select(*PAGE).distinct().join(hits, list(PAGE), "left").select(*PAGE, F.coalesce("score", F.lit(0)).cast("long").alias("score"))


def best_region(scores: DataFrame, tries: int = 3) -> DataFrame:
    """The region of the highest score of each page among the first ``tries`` (3 at least); the first on ties."""
    return first_row(scores.filter(F.col("region") < max(3, tries)), list(PAGE), F.desc("score"), "region")


def candidate_regions(pages: DataFrame) -> DataFrame:
    """Every page with each of the candidate regions; a literal array, so no join."""
    boxes = F.array(*(F.struct(F.lit(i).alias("region"), *(F.lit(v).alias(n) for n, v in zip(("rx", "ry", "rw", "rh"), box, strict=True))) for i, box in enumerate(CANDIDATES)))
    return pages.select("*", F.inline(boxes))


def grid_score(words: DataFrame, page_w: int, page_h: int, grid: int = 4, least: int = 2) -> DataFrame:
    """(page, cell, score): the cell of a grid with most keywords, one more in the bottom right quadrant; null if too few."""
    cell = lambda c, size: F.least(F.lit(grid - 1), F.floor(c * grid / size)).cast("int")
    rows = words.select(*PAGE, cell(F.col("x0"), page_w).alias("gx"), cell(F.col("y0"), page_h).alias("gy"), F.lower("text").alias("text"))
    hits = sum((F.max(F.contains(F.col("text"), F.lit(k.lower())).cast("int")) for k in GRID_KEYWORDS), F.lit(0))
    bonus = ((F.col("gx") >= grid // 2) & (F.col("gy") >= grid // 2)).cast("int")
    scores = rows.groupBy(*PAGE, "gx", "gy").agg(hits.alias("hits")).withColumn("score", F.col("hits") + bonus)
    return first_row(scores.filter(F.col("score") >= least), list(PAGE), F.desc("score"), "gy", "gx").select(*PAGE, "gx", "gy", "score")


def nearest_label(matches: DataFrame, words: DataFrame, order: str = "word_id") -> DataFrame:
    """Of each page the match nearest to a label word; without label words the lowest, then rightmost match."""
    labels = words.filter(F.upper(F.trim("text")).isin(*LABEL_WORDS)).select(*PAGE, ((F.col("x0") + F.col("x1")) / 2).alias("lx"), ((F.col("y0") + F.col("y1")) / 2).alias("ly"))
    pairs = matches.join(labels, list(PAGE), "left")
    d2 = squared_distance((F.col("x0") + F.col("x1")) / 2, (F.col("y0") + F.col("y1")) / 2, F.col("lx"), F.col("ly"))
    best = pairs.groupBy(*PAGE, order, "text", "x1", "y1").agg(F.min(d2).alias("d2"))
    return first_row(best, list(PAGE), F.asc_nulls_last("d2"), F.when(F.col("d2").isNull(), -F.col("y1")), F.when(F.col("d2").isNull(), -F.col("x1")), order)


def first_hit(crops: DataFrame, keys: list[str], order: str, hit: Column, ties: tuple[str, ...] = ()) -> DataFrame:
    """The first crop with a hit, else the first crop; of several in one place that of the smallest ``ties``."""
    return first_row(crops.withColumn("hit", hit), keys, F.desc("hit"), order, *ties)


def merge_crops(crops: DataFrame, keys: list[str], order: str, fields: list[str]) -> DataFrame:
    """Of each field the first non-empty value in crop order, of several in one place the smallest, and the crops that had any, one entry a row."""
    some = F.greatest(*(F.col(f) != "" for f in fields))
    first = [F.coalesce(F.min(F.when(F.col(f) != "", F.struct(order, f)))[f], F.lit("")).alias(f) for f in fields]
    used = F.array_join(F.array_sort(F.collect_list(F.when(some, F.col(order)))), ",").alias("crops")
    return crops.groupBy(*keys).agg(*first, used)


def ladder(attempts: DataFrame, keys: list[str], steps: int = 3, tries: int = 2, ties: tuple[str, ...] = ()) -> DataFrame:
    """The box that a ladder of detections gives: (keys, attempt, x, y, w, h), no row where no step has one.

    Each step is tried ``tries`` times and gives its first box; a box without width or height is passed over in every step
    but the last. Of several boxes of one attempt that of the smallest ``ties`` stands, then the smallest by x, y, w and h.
    """
    step = F.floor(F.col("attempt") / tries)
    first = first_row(attempts.filter("x IS NOT NULL").withColumn("step", step), [*keys, "step"], "attempt", *ties, *"xywh")
    fits = (F.col("step") >= steps - 1) | ((F.col("w") > 0) & (F.col("h") > 0))
    return first_row(first.filter(fits), keys, "attempt", *ties, *"xywh").drop("step")
