"""Regions beside labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import contains_any
from .grouping import PAGE

# Words of a label whose right edge a field starts at.
LABEL_PARTS = ("DRAWING", "DWG", "DRG", "NO", "SHEET", "NUMBER", "TITLE", "NAME", "DESCRIPTION")
LABEL_PARTS_THAI = ("เลขที่แบบ", "ชื่อแบบ", "หัวข้อ")


def right_of_label(words: DataFrame, line: list[str], width: int, height: int, extra_lines: int = 1) -> DataFrame:
    """(page, line, rx0, ry0, rx1, ry1): of each line with a label, the region right of it and ``extra_lines`` down."""
    label = contains_any(F.col("text"), LABEL_PARTS, LABEL_PARTS_THAI)
    found = words.groupBy(*PAGE, *line).agg(
        F.greatest(F.min("x0"), F.coalesce(F.max(F.when(label, F.col("x1"))), F.lit(0.0))).alias("right"),
        F.min("y0").alias("top"),
        F.max("y1").alias("bottom"),
        F.max("x1").alias("end"),
        F.count_if(label).alias("labels"),
    )
    tall = F.greatest(F.lit(8.0), F.col("bottom") - F.col("top"))
    left = F.least(F.lit(width - 1), F.greatest(F.lit(0), (F.col("right") + 4).cast("int")))
    return found.filter("labels > 0").select(
        *PAGE,
        *line,
        left.alias("rx0"),
        F.greatest(F.lit(0), F.col("top").cast("int") - (0.2 * tall).cast("int")).alias("ry0"),
        F.least(F.lit(width), F.greatest(left + 10, F.col("end").cast("int"))).alias("rx1"),
        F.least(F.lit(height), F.col("bottom").cast("int") + ((0.9 + extra_lines) * tall).cast("int")).alias("ry1"),
    )
