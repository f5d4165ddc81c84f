"""File streams through the same projections as the batch plans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as t

LINE = "pdf_path string, page_index int, line_no int, text string, at timestamp"


def line_stream(spark: SparkSession, folder: str, files_per_trigger: int = 100) -> DataFrame:
    """Lines of pages from JSON files as they arrive in a folder."""
    return spark.readStream.schema(LINE).option("maxFilesPerTrigger", files_per_trigger).json(folder)


def numbers(lines: DataFrame) -> DataFrame:
    """(pdf_path, page_index, at, number): every drawing number of every line; no state."""
    found = F.explode(t.guarded_numbers(F.col("text")))
    return lines.select("pdf_path", "page_index", "at", found.alias("number"))


def numbers_per_window(lines: DataFrame, width: str = "10 minutes", late: str = "1 hour") -> DataFrame:
    """(window, number, pages): in how many lines a number arrived in each window; state ends with the watermark."""
    return numbers(lines).withWatermark("at", late).groupBy(F.window("at", width), "number").agg(F.count("*").alias("pages"))
