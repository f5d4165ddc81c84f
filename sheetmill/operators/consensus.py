"""Consensus of detected boxes within and across documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import iou


def corners(prefix: str = "") -> tuple:
    x, y, w, h = (F.col(prefix + n) for n in "xywh")
    return x, y, x + w, y + h


def median_box(boxes: DataFrame, keys: list[str]) -> DataFrame:
    """The median of each part of a key's boxes."""
    return boxes.filter("x IS NOT NULL").groupBy(*keys).agg(*(F.median(n).alias(f"m{n}") for n in "xywh"), F.count("*").alias("boxes"))


def consensus(detected: DataFrame, least: float = 0.5, ratio: float = 0.6) -> DataFrame:
    """(pdf_path, boxes, hits, required, pair_ok, ok, mx, my, mw, mh) of every document.

    Agreed if enough boxes overlap the median box, or if the only two overlap each other; one box agrees with itself. The
    median stands also where there is no agreement; without boxes it is null.
    """
    medians = median_box(detected, ["pdf_path"])
    rows = detected.filter("x IS NOT NULL").join(medians, "pdf_path")
    w = Window.partitionBy("pdf_path").orderBy("page_index")
    before = tuple(F.lag(n).over(w) for n in "xywh")
    rows = rows.withColumns({"near": iou(corners("m"), corners()), "pair": iou((before[0], before[1], before[0] + before[2], before[1] + before[3]), corners())})
    found = rows.groupBy("pdf_path").agg(F.first("boxes").alias("boxes"), F.sum((F.col("near") >= least).cast("int")).alias("hits"), F.max("pair").alias("pair"), *(F.first(f"m{n}").alias(f"m{n}") for n in "xywh"))
    required = F.greatest(F.lit(1), F.ceil(F.col("boxes") * ratio)).cast("int")
    found = found.withColumn("required", required).withColumn("pair_ok", (F.col("boxes") == 2) & (F.coalesce("pair", F.lit(0.0)) >= least))
    found = found.withColumn("ok", (F.col("hits") >= F.col("required")) | F.col("pair_ok")).drop("pair")
    everything = detected.select("pdf_path").distinct().join(found, "pdf_path", "left")
    filled = {"boxes": F.coalesce("boxes", F.lit(0)).cast("long"), "hits": F.coalesce("hits", F.lit(0)).cast("long"), "required": F.coalesce("required", F.lit(0)), "ok": F.coalesce("ok", F.lit(False)), "pair_ok": F.coalesce("pair_ok", F.lit(False))}
    return everything.withColumns(filled)


def decision(agreed: DataFrame, no_fallback: bool = False) -> DataFrame:
    """(pdf_path, note): what a document does with its detected boxes."""
    note = (
        F.when((F.col("boxes") >= 2) & F.col("ok"), "global_bbox_reuse")
        .when((F.col("boxes") >= 2) & F.lit(no_fallback), "global_bbox_forced")
        .when(F.col("boxes") == 1, "global_bbox_single")
        .otherwise("no_fallback_initial_only" if no_fallback else "per_page_detection")
    )
    return agreed.select("pdf_path", (note if no_fallback else F.when(F.col("boxes").isNull(), None).otherwise(note)).alias("note"))


def detection_sample(pages: DataFrame, detect_pages: int = 3) -> DataFrame:
    """The pages of each document on which boxes are looked for first."""
    return pages.filter(F.col("page_index") < F.greatest(F.lit(1), F.least(F.lit(min(5, detect_pages)), F.col("page_count"))))


def global_scope(pages: DataFrame, detect_pages: int = 3) -> DataFrame:
    """(pdf_path, page_index, x, y, w, h, note) when one box serves all documents.

    Attempts are counted over (document, page) in order, ``detect_pages`` in all; the first box found serves its own and all
    later documents. Only those few attempts are ranked together; every page then reads one broadcast row.
    """
    attempts = detection_sample(pages, detect_pages).orderBy("pdf_path", "page_index").limit(detect_pages)
    found = attempts.filter("x IS NOT NULL").orderBy("pdf_path", "page_index").limit(1)
    chosen = found.select(F.col("pdf_path").alias("from_pdf"), *(F.col(n).alias(f"b{n}") for n in "xywh"))
    rows = pages.select("pdf_path", "page_index").join(F.broadcast(chosen), F.col("pdf_path") >= F.col("from_pdf"), "left")
    note = F.when(F.col("from_pdf").isNotNull(), "global_scope_bbox_reuse").otherwise("global_scope_partial;cover_no_title_block")
    return rows.select("pdf_path", "page_index", *(F.col(f"b{n}").alias(n) for n in "xywh"), note.alias("note"))


def page_boxes(pages: DataFrame, agreed: DataFrame) -> DataFrame:
    """Every page with its document's agreed box, else its own detected one."""
    chosen = agreed.select("pdf_path", F.col("ok").alias("agreed"), *(F.col(f"m{n}") for n in "xywh"))
    rows = pages.join(chosen, "pdf_path", "left")
    return rows.select("pdf_path", "page_index", *(F.when(F.col("agreed"), F.col(f"m{n}")).otherwise(F.col(n)).alias(n) for n in "xywh"))
