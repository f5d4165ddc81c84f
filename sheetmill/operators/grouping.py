"""Words to tokens, lines and regions, by windows; folds only where the state depends on all earlier words.

All functions partition by the page, so a page's words meet in one task and pages spread over the cluster.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import y_overlap
from ..functions.text import collapse_hyphen, strip

PAGE = ("pdf_path", "page_index")


def median_or(c: Column, default: float) -> Column:
    """Median of the positive values."""
    return F.coalesce(F.median(F.when(c > 0, c)), F.lit(default))


def clipped(words: DataFrame, x0: float, y0: float, x1: float, y1: float) -> DataFrame:
    """Words that share some area with a rectangle."""
    return words.filter((F.col("x0") < x1) & (F.col("x1") > x0) & (F.col("y0") < y1) & (F.col("y1") > y0))


def line_buckets(words: DataFrame, gap: float = 3.0, order: str = "word_id") -> DataFrame:
    """Adds line: a new one begins where the vertical centre moves by more than ``gap`` from the word before."""
    middle = (F.col("y0") + F.col("y1")) / 2
    rows = words.withColumn("cy", middle)
    w = Window.partitionBy(*PAGE).orderBy(F.bround("cy", 1), "x0", order)
    new = F.coalesce((F.abs(F.col("cy") - F.lag("cy").over(w)) > gap).cast("int"), F.lit(0))
    return rows.withColumn("new_line", new).withColumn("line", F.sum("new_line").over(w).cast("int")).drop("new_line")


def merged_tokens(lines: DataFrame, gap: float = 6.0, order: str = "word_id") -> DataFrame:
    """Tokens of a line: words at most ``gap`` apart join; (page, line, token, x0, y0, x1, y1, text)."""
    w = Window.partitionBy(*PAGE, "line").orderBy("x0", order)
    reach = F.max("x1").over(w.rowsBetween(Window.unboundedPreceding, -1))
    rows = lines.withColumn("new", F.coalesce((F.col("x0") - reach > gap).cast("int"), F.lit(0))).withColumn("token", F.sum("new").over(w).cast("int"))
    return box_union(rows, [*PAGE, "line", "token"], "x0", order, " ")


def box_union(words: DataFrame, keys: list[str], *by: str, more: tuple[Column, ...] = ()) -> DataFrame:
    """One box for each group, its text joined in the order of ``by[:-1]`` with ``by[-1]`` between, and more aggregates."""
    *order, glue = by
    texts = F.array_sort(F.collect_list(F.struct(*order, "text")))
    return words.groupBy(*keys).agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"), F.array_join(F.transform(texts, lambda t: t["text"]), glue).alias("text"), *more)


def pdf_lines(words: DataFrame) -> DataFrame:
    """Lines by the file's own block and line numbers; blank words widen the box only, blank lines are dropped."""
    texts = F.array_sort(F.collect_list(F.struct("word_no", "word_id", strip(F.col("text")).alias("text"))))
    text = F.array_join(F.filter(F.transform(texts, lambda t: t["text"]), lambda t: t != ""), " ")
    found = words.groupBy(*PAGE, "block_no", "line_no").agg(text.alias("text"), *(f(c).alias(f"{c}_pt") for f, c in ((F.min, "x0"), (F.min, "y0"), (F.max, "x1"), (F.max, "y1"))))
    return found.filter("text <> ''")


def merged_regions(words: DataFrame, line: list[str], gap: float = 12.0, overlap: float = 0.5, order: str = "word_id") -> DataFrame:
    """Regions of a line: a word joins the one before if it is at most ``gap`` away and shares half of the height."""
    w = Window.partitionBy(*PAGE, *line).orderBy("x0", order)
    near = (F.col("x0") - F.lag("x1").over(w) <= gap) & (y_overlap(F.col("y0"), F.col("y1"), F.lag("y0").over(w), F.lag("y1").over(w)) >= overlap)
    rows = words.withColumn("new", F.when(F.lag("x1").over(w).isNull() | near, 0).otherwise(1)).withColumn("region", F.sum("new").over(w).cast("int"))
    return box_union(rows, [*PAGE, *line, "region"], "x0", order, "", more=(F.avg("conf").alias("conf_avg"),))


def overlap_lines(words: DataFrame, overlap: float = 0.5, order: str = "word_id") -> DataFrame:
    """Words put into the first line whose middle word shares half of their height; (page, lines array of word arrays).

    Which word is the middle changes as a line grows, so this is a fold over the page's words in order.
    """
    word = F.struct("y0", "x0", order, "x1", "y1", "text")
    pages = words.groupBy(*PAGE).agg(F.array_sort(F.collect_list(word)).alias("words"))

    def put(lines: Column, w: Column) -> Column:
        middle = lambda line: F.get(line, F.floor(F.size(line) / 2).cast("int"))
        fits = F.transform(lines, lambda line: y_overlap(w["y0"], w["y1"], middle(line)["y0"], middle(line)["y1"]) >= overlap)
        at = F.array_position(fits, F.lit(True))
        grown = F.transform(lines, lambda line, i: F.when(i + 1 == at, F.concat(line, F.array(w))).otherwise(line))
        return F.when(at > 0, grown).otherwise(F.concat(lines, F.array(F.array(w))))

    kind = "array<array<struct<y0:double,x0:double,word_id:int,x1:double,y1:double,text:string>>>"
    return pages.select(*PAGE, F.aggregate("words", F.array().cast(kind), put).alias("lines"))


def drifting_lines(words: DataFrame, order: str = "word_id", text: str = "text") -> DataFrame:
    """(page, line, words): OCR words in lines along a base line that follows them by a fifth of each step.

    A word starts a line where its centre is further from the base line than 0.7 median heights (6 at least).
    """
    rows = words.withColumn("yc", F.col("y") + F.col("h") / 2)
    word = F.struct("yc", "x", order, F.col(text).alias("text"))
    pages = rows.groupBy(*PAGE).agg(F.array_sort(F.collect_list(word)).alias("words"), median_or(F.col("h"), 12.0).alias("height"))
    limit = F.greatest(F.lit(6.0), 0.7 * F.col("height"))

    def put(s: Column, w: Column) -> Column:
        new = s["base"].isNull() | (F.abs(w["yc"] - s["base"]) > limit)
        line = s["line"] + new.cast("int")
        item = F.struct(line.alias("line"), w["x"].alias("x"), w[order].alias("word"), w["text"].alias("text"))
        return F.struct(F.when(new, w["yc"]).otherwise(0.8 * s["base"] + 0.2 * w["yc"]).alias("base"), line.alias("line"), F.concat(s["done"], F.array(item)).alias("done"))

    start = F.struct(F.lit(None).cast("double").alias("base"), F.lit(-1).alias("line"), F.array().cast("array<struct<line:int,x:int,word:int,text:string>>").alias("done"))
    done = F.aggregate("words", start, put, lambda s: s["done"])
    flat = pages.select(*PAGE, F.inline(done))
    return flat.groupBy(*PAGE, "line").agg(F.transform(F.array_sort(F.collect_list(F.struct("x", "word", "text"))), lambda t: t["text"]).alias("words"))


def confident(words: DataFrame, least: float = 50.0) -> DataFrame:
    """Words of at least this confidence (missing counts as 0); all words of a page on which none is left."""
    rows = words.filter(strip(F.col("text")) != "").withColumn("sure", F.coalesce(F.col("conf"), F.lit(0.0)) >= least)
    any_sure = F.max("sure").over(Window.partitionBy(*PAGE))
    return rows.withColumn("any_sure", any_sure).filter("sure OR NOT any_sure").drop("sure", "any_sure")


def without_repeats(lines: DataFrame, text: str = "text", order: str = "line") -> DataFrame:
    """Lines that differ from the line before."""
    before = F.lag(text).over(Window.partitionBy(*PAGE).orderBy(order))
    return lines.withColumn("before", before).filter(~F.col(text).eqNullSafe(F.col("before"))).drop("before")


def clean_ocr_text(words: DataFrame) -> DataFrame:
    """(page, ocr_text): confident words in drifting lines, hyphens and spaces collapsed, repeated lines dropped."""
    lines = drifting_lines(confident(words))
    text = strip(F.regexp_replace(collapse_hyphen(F.array_join("words", " ")), r"(?U)\s+", " "))
    lines = without_repeats(lines.select(*PAGE, "line", text.alias("text")).filter("text <> ''"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", "text"))), lambda t: t["text"]), "\n")
    return lines.groupBy(*PAGE).agg(joined.alias("ocr_text"))
