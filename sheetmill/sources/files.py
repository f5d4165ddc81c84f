"""Readers of PDF folders and CSV files."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ANY_CASE, LOWER_CASE = "*.[pP][dD][fF]", "*.pdf"
PAGES = "pdf_path string, page_index int, page_count int, page_w double, page_h double"
WORDS = "pdf_path string, page_index int, word_id int, x0 double, y0 double, x1 double, y1 double, text string, block_no int, line_no int, word_no int"


def pdf_files(spark: SparkSession, folder: str, pattern: str = ANY_CASE, recursive: bool = False) -> DataFrame:
    """(path, modificationTime, length, content) of a folder's PDF files; content is only read where it is used."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", recursive).load(folder)


def pdf_files_or_below(spark: SparkSession, folder: str) -> DataFrame:
    """The files of the folder itself, else of all folders below it."""
    top = pdf_files(spark, folder)
    return top if not top.isEmpty() else pdf_files(spark, folder, LOWER_CASE, recursive=True)


def pages(files: DataFrame, count_pages: Callable[[bytes], list[tuple[float, float]]], max_pages: int | None = None) -> DataFrame:
    """A row for each page of every file. ``count_pages`` gives the pages' sizes; a file that it cannot read is skipped.

    The library that reads PDF files is the caller's; each file is read in one task, pages are spread afterwards.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for path, content in zip(batch["path"], batch["content"], strict=True):
                try:
                    sizes = count_pages(content)
                except Exception:  # a damaged file does not stop the others
                    continue
                out += [(path, i, len(sizes), w, h) for i, (w, h) in enumerate(sizes[:max_pages])]
            yield pd.DataFrame(out, columns=["pdf_path", "page_index", "page_count", "page_w", "page_h"])

    return files.select("path", "content").mapInPandas(run, PAGES)


def words(files: DataFrame, read_words: Callable[[bytes], list[tuple]]) -> DataFrame:
    """A row for each word: ``read_words`` gives (page_index, x0, y0, x1, y1, text, block, line, word) tuples."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for path, content in zip(batch["path"], batch["content"], strict=True):
                try:
                    found = read_words(content)
                except Exception:  # as above
                    continue
                out += [(path, w[0], i, *w[1:]) for i, w in enumerate(found)]
            yield pd.DataFrame(out, columns=[c.split()[0] for c in WORDS.split(", ")])

    return files.select("path", "content").mapInPandas(run, WORDS)


def spread(pages: DataFrame) -> DataFrame:
    """Pages dealt out by page, so that one long document does not keep one task busy."""
    return pages.repartition("pdf_path", "page_index")


def text_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file with a header, all columns as text, empty cells as empty strings."""
    rows = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return rows.select(*(F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in rows.columns))


def alias(df: DataFrame, *names: str, default: str = "") -> Column:
    """The first of these columns that the table has and that is not empty."""
    return F.coalesce(*(F.nullif(F.col(n), F.lit("")) for n in names if n in df.columns), F.lit(default))


def page_texts(rows: DataFrame) -> DataFrame:
    """(pdf_path, page_index, text) of a CSV table under any of its known column names; blank texts are left out."""
    if not {"text", "ocr_text"} & set(rows.columns):
        raise ValueError("no text column")
    found = rows.select(alias(rows, "pdf", "pdf_path").alias("pdf_path"), alias(rows, "page_index", "page", default="0").alias("page_index"), alias(rows, "text", "ocr_text").alias("text"))
    return found.filter(F.trim("text") != "")
