"""Writers of records: JSON lines with explicit nulls, CSV projections, overlays and run summaries."""

from __future__ import annotations

from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import filled, strip

#: Columns of the CSV file in its two forms.
CSV_COLUMNS = {
    "minimal": ("pdf_path", "page_index", "page_width", "page_height", "drawing_no", "notes"),
    "full": ("pdf_path", "page_index", "page_width", "page_height", "drawing_no", "drawing_title", "scale", "page_x", "page_total", "notes"),
}


def filled_number(number: Column, candidates: Column) -> Column:
    """A drawing number, the first candidate where it is blank, else empty."""
    return F.coalesce(filled(strip(F.coalesce(number, F.lit("")))), strip(F.get(candidates, 0)), F.lit(""))


def in_order(df: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """The rows in order over all files, by one range exchange; as they come without any."""
    return df.orderBy(*order) if order else df


def write_jsonl(df: DataFrame, path: str, drop: tuple[str, ...] = (), order: tuple[str, ...] = ()) -> None:
    """One object a row with explicit nulls, overwriting; an empty table leaves an empty file set."""
    in_order(df, order).drop(*drop).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_csv(df: DataFrame, path: str, columns: tuple[str, ...] | None = None, order: tuple[str, ...] = ()) -> None:
    """A projection with a header; nested columns as JSON text, null as an empty cell, quotes doubled."""
    chosen = in_order(df, order).select(*(columns or df.columns))
    nested = [f.name for f in chosen.schema if f.dataType.typeName() in ("struct", "array", "map")]
    flat = chosen.withColumns({n: F.coalesce(F.to_json(n), F.lit("null")) for n in nested})
    flat.write.mode("overwrite").option("header", True).option("escape", '"').option("emptyValue", "").option("nullValue", "").csv(path)


def snippet(c: Column, n: int = 200) -> Column:
    return F.substring(c, 1, n)


def free_name(columns: list[str], name: str = "renamed_path") -> str:
    """``name``, or with the first number that no column has."""
    taken, i = set(columns), 0
    while (found := name if not i else f"{name}_{i}") in taken:
        i += 1
    return found


def summary(pages: DataFrame) -> DataFrame:
    """(pdf_path, with_box, pages) of every document."""
    return pages.groupBy("pdf_path").agg(F.count("x").alias("with_box"), F.count("*").alias("pages"))


def overlay(boxes: DataFrame, label: Column, color: str = "red") -> DataFrame:
    """The data of an overlay image: a rectangle, a label and a colour a row."""
    return boxes.select("pdf_path", "page_index", "x0", "y0", "x1", "y1", label.alias("label"), F.lit(color).alias("color"))


def write_overlays(overlays: DataFrame, draw) -> None:
    """Hands every page's rectangles to ``draw(pdf_path, page_index, rows)`` on the executors."""

    def pages(rows) -> None:
        for (path, page), found in groupby(rows, key=lambda r: (r["pdf_path"], r["page_index"])):
            draw(path, page, [r.asDict() for r in found])

    overlays.repartition("pdf_path", "page_index").sortWithinPartitions("pdf_path", "page_index").foreachPartition(pages)
