"""Queries over records: coordinate chains, ladders of detections, defaults, lineage and order, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geometry as g
from ..functions import jsonx
from ..functions import text as t
from ..operators import consensus, grouping, ranking
from .box_queries import AGREED, ALL_MATCHES, DIRECT, SAMPLE, agreed, box, roi, sql_iou
from .pipelines import all_matches, detected_boxes, model_records, vector_matches
from .relations import duck, relation
from .text_queries import BARE, PAGE, SCALED, TIES, register, sql_title, with_object

# ---- coordinates -----------------------------------------------------------------------------------------------------


def sql_crop(c: str, start: str, most: str) -> str:
    return f"CAST(trunc(greatest(0, least({most}, trunc({c} * (200 / 72.0::DOUBLE) - {start}::DOUBLE * (200 / 72.0::DOUBLE)) * 0.75::DOUBLE))) AS int)"


@register("points_to_crop", f"SELECT pdf_path, page_index, word_id, {sql_crop('x0', '1500.5', '1899')} AS cx0, {sql_crop('y0', '900.25', '1599')} AS cy0, {sql_crop('x1', '1500.5', '1900')} AS cx1, {sql_crop('y1', '900.25', '1600')} AS cy1 FROM {duck('words')}")
def points_to_crop(spark, sf_dir):
    found = g.points_to_crop(*(F.col(c) for c in ("x0", "y0", "x1", "y1")), F.lit(1500.5), F.lit(900.25), 200, F.lit(0.75), F.lit(0.75), F.lit(1900), F.lit(1600))
    return relation(spark, sf_dir, "words").select(*PAGE, "word_id", *(c.alias(n) for n, c in found.items()))


@register("crop_to_page", f"SELECT pdf_path, page_index, word_id, 1549 + x AS px0, 1212 + y AS py0, 1549 + x + w AS px1, 1212 + y + h AS py1, round((1549 + x) / 2384::DOUBLE, 9) AS sx, round((1212 + y) / 1684::DOUBLE, 9) AS sy, round(w / 2384::DOUBLE, 9) AS sw, round(h / 1684::DOUBLE, 9) AS sh FROM {duck('ocr')}")
def crop_to_page(spark, sf_dir):
    found = g.crop_to_page(*box(), F.lit(1549), F.lit(1212), F.lit(2384), F.lit(1684))
    return relation(spark, sf_dir, "ocr").select(*PAGE, "word_id", *((F.round(c, 9) if n.startswith("s") else c).alias(n) for n, c in found.items()))


STRIP = "SELECT *, 0.8::DOUBLE + x * 0.2::DOUBLE AS gx, y AS gy, w * 0.2::DOUBLE AS gw, h AS gh FROM {0} WHERE x IS NOT NULL"


@register("region_to_page", f"SELECT pdf_path, page_index, round(gx, 9) AS x, round(gy, 9) AS y, round(CASE WHEN gx + gw > 1 THEN 1 - gx ELSE gw END, 9) AS w, round(CASE WHEN gy + gh > 1 THEN 1 - gy ELSE gh END, 9) AS h FROM ({STRIP.format(duck('boxes'))})")
def region_to_page(spark, sf_dir):
    found = g.region_to_page(g.STRIPS[1], *box())
    return relation(spark, sf_dir, "boxes").filter("x IS NOT NULL").select(*PAGE, *(F.round(c, 9).alias(n) for n, c in found.items()))


def sql_corner(c: str, size: str) -> str:
    return f"CAST(greatest(0, least({size} - 1, trunc({c} * {size}))) AS int)"


@register("relative_crop", f"SELECT *, greatest(rx0 + 1, CAST(least(page_w, trunc((x + w) * page_w)) AS int)) AS rx1, greatest(ry0 + 1, CAST(least(page_h, trunc((y - h) * page_h)) AS int)) AS ry1 FROM (SELECT *, {sql_corner('x', 'page_w')} AS rx0, {sql_corner('y', 'page_h')} AS ry0 FROM {duck('boxes')} WHERE x IS NOT NULL)")
def relative_crop(spark, sf_dir):
    """Every box with its crop; the lower corner is above the upper one, so crops are one pixel high."""
    x, y, w, h = box()
    found = g.relative_crop(x, y, x + w, y - h, F.col("page_w"), F.col("page_h"))
    return relation(spark, sf_dir, "boxes").filter("x IS NOT NULL").select("*", *(found[n].alias(n) for n in ("rx0", "ry0", "rx1", "ry1")))


@register("patch_size", f"SELECT pdf_path, page_index, CAST(ceil(CASE WHEN least(w, v) < 56 THEN greatest(1, trunc(w * (56.0::DOUBLE / least(w, v)))) ELSE w END / 28.0) * 28 AS int) AS patch_w, CAST(ceil(CASE WHEN least(w, v) < 56 THEN greatest(1, trunc(v * (56.0::DOUBLE / least(w, v)))) ELSE v END / 28.0) * 28 AS int) AS patch_h FROM (SELECT pdf_path, page_index, 20 + o_orderkey % 300 AS w, 10 + o_orderkey % 90 AS v FROM {duck('pages')})")
def patch_size(spark, sf_dir):
    rows = relation(spark, sf_dir, "pages")
    found = g.enlarged(20 + F.col("o_orderkey") % 300, 10 + F.col("o_orderkey") % 90)
    return rows.select(*PAGE, *(c.alias(n) for n, c in found.items()))


@register("clipped_words", f"SELECT pdf_path, page_index, word_id FROM {duck('words')} WHERE x0 < 2200 AND x1 > 1549.6 AND y0 < 1600 AND y1 > 1212.48")
def clipped_words(spark, sf_dir):
    """Words that share some area with a rectangle."""
    return grouping.clipped(relation(spark, sf_dir, "words"), 1549.6, 1212.48, 2200.0, 1600.0).select(*PAGE, "word_id")


# ---- detections ------------------------------------------------------------------------------------------------------

#: Six recorded attempts a page: two in the bottom strip, two in the right strip, two on the full page.
ATTEMPTS = "SELECT pdf_path, page_index, CAST(a AS int) AS attempt, CASE WHEN (o_orderkey + a) % 5 < 2 THEN x END AS x, CASE WHEN (o_orderkey + a) % 5 < 2 THEN y END AS y, CASE WHEN (o_orderkey + a) % 5 = 0 AND a < 4 THEN 0.0 WHEN (o_orderkey + a) % 5 < 2 THEN w END AS w, CASE WHEN (o_orderkey + a) % 5 < 2 THEN h END AS h FROM {0} {1}"
DUCK_ATTEMPTS = ATTEMPTS.format(duck("boxes"), ", (SELECT unnest(range(6)) AS a)")


@register("detection_ladder", f"SELECT pdf_path, page_index, attempt, x, w FROM (SELECT *, max(CASE WHEN x IS NOT NULL THEN attempt END) OVER (PARTITION BY pdf_path, page_index, attempt // 2 ORDER BY attempt) AS ok, row_number() OVER (PARTITION BY pdf_path, page_index, attempt // 2 ORDER BY (x IS NULL)::INT, attempt) AS r FROM ({DUCK_ATTEMPTS})) WHERE r = 1 AND x IS NOT NULL AND (attempt >= 4 OR (w > 0 AND h > 0)) QUALIFY row_number() OVER (PARTITION BY pdf_path, page_index ORDER BY attempt) = 1")
def detection_ladder(spark, sf_dir):
    """Of each step the first answer with a box; of the steps the first whose box has a size, the full page's as it is."""
    rows = relation(spark, sf_dir, "boxes").withColumn("a", F.explode(F.sequence(F.lit(0), F.lit(5))))
    attempts = rows.select(*PAGE, *TIES, F.col("a").alias("attempt"), *(F.expr(f"CASE WHEN (o_orderkey + a) % 5 = 0 AND a < 4 THEN 0.0D WHEN (o_orderkey + a) % 5 < 2 THEN {n} END" if n == "w" else f"CASE WHEN (o_orderkey + a) % 5 < 2 THEN {n} END").alias(n) for n in "xywh"))
    return ranking.ladder(attempts, PAGE, ties=TIES).select(*PAGE, "attempt", "x", "w")


PAGE_BOXES = f"SELECT b.pdf_path, b.page_index, round(CASE WHEN ok THEN mx ELSE x END, 6) AS x, round(CASE WHEN ok THEN mw ELSE w END, 6) AS w FROM (SELECT * FROM {duck('boxes')}) AS b LEFT JOIN ({AGREED}) AS c ON b.pdf_path = c.pdf_path LEFT JOIN (SELECT pdf_path AS p, median(x) AS mx, median(w) AS mw FROM {SAMPLE} WHERE x IS NOT NULL GROUP BY pdf_path) ON p = b.pdf_path"


@register("page_boxes", PAGE_BOXES)
def page_boxes(spark, sf_dir):
    """Every page's box after the consensus of its document's first pages, by the driver of detections."""
    return detected_boxes(relation(spark, sf_dir, "boxes")).select(*PAGE, F.round("x", 6).alias("x"), F.round("w", 6).alias("w"))


@register("pdf_decision_no_fallback", f"SELECT pdf_path, CASE WHEN boxes >= 2 AND ok THEN 'global_bbox_reuse' WHEN boxes >= 2 THEN 'global_bbox_forced' WHEN boxes = 1 THEN 'global_bbox_single' ELSE 'no_fallback_initial_only' END AS note FROM ({AGREED})")
def pdf_decision_no_fallback(spark, sf_dir):
    return consensus.decision(agreed(spark, sf_dir), no_fallback=True)


@register("page_notes", f"SELECT b.pdf_path, b.page_index, note || CASE WHEN x IS NULL THEN ';cover_no_title_block' ELSE '' END AS notes FROM (SELECT * FROM {duck('boxes')}) AS b JOIN (SELECT pdf_path, CASE WHEN boxes >= 2 AND ok THEN 'global_bbox_reuse' WHEN boxes = 1 THEN 'global_bbox_single' ELSE 'per_page_detection' END AS note FROM ({AGREED})) AS d ON b.pdf_path = d.pdf_path")
def page_notes(spark, sf_dir):
    """The document's decision beside every page, with a mark where the page itself has no box."""
    notes = consensus.decision(agreed(spark, sf_dir))
    cover = F.when(F.col("x").isNull(), ";cover_no_title_block").otherwise("")
    return relation(spark, sf_dir, "boxes").join(notes, "pdf_path").select(*PAGE, F.concat("note", cover).alias("notes"))


CORNERS = "x0 y0 x1 y1".split()
SAME = sql_iou(tuple(f"a.{c}" for c in CORNERS), tuple(f"b.{c}" for c in CORNERS))


@register("overlapping_matches", f"SELECT a.pdf_path, a.page_index, a.text, count(*) AS pairs FROM ({ALL_MATCHES}) AS a JOIN ({ALL_MATCHES}) AS b ON a.pdf_path = b.pdf_path AND a.page_index = b.page_index AND a.text = b.text AND a.source < b.source AND {SAME} >= 0.6 GROUP BY ALL")
def overlapping_matches(spark, sf_dir):
    """Pairs of a word's and a token's match of one text that overlap."""
    found = all_matches(roi(relation(spark, sf_dir, "words"))).select(*PAGE, "source", "text", *CORNERS)
    other = found.select(*PAGE, "text", F.col("source").alias("o_source"), *(F.col(c).alias(f"o_{c}") for c in CORNERS))
    near = g.iou(tuple(F.col(c) for c in CORNERS), tuple(F.col(f"o_{c}") for c in CORNERS)) >= 0.6
    return found.join(other, [*PAGE, "text"]).filter((F.col("source") < F.col("o_source")) & near).groupBy(*PAGE, "text").agg(F.count("*").alias("pairs"))


@register("padded_boxes", f"SELECT pdf_path, list_concat(list(x ORDER BY page_index) FILTER (WHERE page_index < 2), list_transform(range(greatest(0, any_value(page_count) - 2)), lambda i: NULL::DOUBLE)) AS xs FROM {duck('boxes')} GROUP BY pdf_path")
def padded_boxes(spark, sf_dir):
    """The first two pages' boxes, filled up with nulls to the number of pages, the smallest of documents that share a path."""
    first = F.transform(F.array_sort(F.collect_list(F.when(F.col("page_index") < 2, F.struct("page_index", *TIES, "x")))), lambda p: p["x"])
    pages = relation(spark, sf_dir, "boxes").groupBy("pdf_path").agg(first.alias("xs"), F.min("page_count").alias("n"))
    return pages.select("pdf_path", F.concat("xs", F.array_repeat(F.lit(None).cast("double"), F.greatest(F.lit(0), F.col("n") - 2))).alias("xs"))


# ---- answers and records ---------------------------------------------------------------------------------------------

VALID = "CASE WHEN json_valid({0}) AND trim({0}) LIKE '{{%' THEN {0} END"
FENCED_SQL = VALID.format(r"nullif(regexp_extract(raw, '(?is)```json\s*(\{{.*?\}})\s*```', 1), '')".replace("{{", "{").replace("}}", "}"))
BRACES_SQL = VALID.format(r"nullif(regexp_extract(raw, '(?s)\{.*?\}', 0), '')")


@register("relaxed_first_json", f"SELECT pdf_path, page_index, crop_ord, coalesce({FENCED_SQL}, {BRACES_SQL}, '{{}}') AS object FROM {duck('model')}")
def relaxed_first_json(spark, sf_dir):
    """The shortest first braces alone, which breaks nested objects."""
    return relation(spark, sf_dir, "model").select(*PAGE, "crop_ord", jsonx.relaxed_first(F.col("raw")).alias("object"))


OBJECT = f"coalesce({VALID.format('raw')}, {FENCED_SQL}, {VALID.format(chr(110) + 'ullif(regexp_extract(raw, ' + chr(39) + '(?s)' + chr(92) + '{.*' + chr(92) + '}' + chr(39) + ', 0), ' + chr(39) * 2 + ')')}, '{{}}')"


@register("default_records", f"SELECT pdf_path, page_index, crop_ord, {', '.join(f'''coalesce(json_extract_string(o, '$.{n}'), '') AS {n}''' for n in jsonx.RECORD)}, CASE WHEN o = '{{}}' THEN 'no JSON' END AS _error FROM (SELECT *, {OBJECT} AS o FROM {duck('model')})")
def default_records(spark, sf_dir):
    """An empty record with the reason where an answer holds no object."""
    rows = with_object(relation(spark, sf_dir, "model"))
    return rows.select(*PAGE, "crop_ord", *jsonx.record_or_default(F.col("raw"), F.col("object"), "no JSON"))


FIELD = "coalesce(json_extract_string(o, '$.{0}'), '')"


@register("model_records", f"SELECT pdf_path, page_index, drawing_no, {sql_title('raw_title')} AS drawing_title, CASE WHEN NOT regexp_matches({BARE}, '^\\d{{1,3}}:\\d{{1,4}}$') THEN '' ELSE CAST({SCALED.format(BARE, 1)} AS varchar) || ':' || CAST({SCALED.format(BARE, 2)} AS varchar) END AS scale, CAST(page_index + 1 AS varchar) || '/' || CAST(page_count AS varchar) AS total_page FROM (SELECT *, {FIELD.format('drawing_no')} AS drawing_no, {FIELD.format('drawing_title')} AS raw_title, {FIELD.format('scale')} AS raw_scale FROM (SELECT m.*, {OBJECT} AS o, page_count FROM (SELECT * FROM {duck('model')}) AS m JOIN (SELECT pdf_path AS p, page_index AS i, page_count FROM {duck('pages')}) ON p = pdf_path AND i = page_index WHERE crop_ord = 0))")
def records(spark, sf_dir):
    """The first crop's answer of every page as a record."""
    pages = relation(spark, sf_dir, "pages").select(*PAGE, "page_count")
    return model_records(relation(spark, sf_dir, "model").filter("crop_ord = 0").select(*PAGE, "raw").join(pages, PAGE))


@register("lineage_columns", f"SELECT pdf_path, page_index, crop_ord, split_part(pdf_path, '/', -1) AS pdf_file, replace(split_part(pdf_path, '/', -1), '.pdf', '') AS stem, true AS llm_used, 'recorded' AS model, 'typhoon_ocr|prompt=default;crop=' || crop_ord AS notes FROM {duck('model')}")
def lineage_columns(spark, sf_dir):
    rows = relation(spark, sf_dir, "model")
    notes = F.concat(F.lit("typhoon_ocr|prompt=default;crop="), F.col("crop_ord").cast("string"))
    return rows.select(*PAGE, "crop_ord", t.base_name(F.col("pdf_path")).alias("pdf_file"), t.stem(F.col("pdf_path")).alias("stem"), F.lit(True).alias("llm_used"), F.lit("recorded").alias("model"), notes.alias("notes"))


@register("text_prompts", "SELECT doc_id, 'OCR TEXT:' || chr(10) || substr(coalesce(text, ''), 1, 4000) AS prompt FROM documents")
def text_prompts(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", t.text_prompt(F.col("text")).alias("prompt"))


@register("ordered_records", f"SELECT pdf_path, page_index, word_id, text FROM ({DIRECT}) ORDER BY pdf_path, page_index, word_id")
def ordered_records(spark, sf_dir):
    """Records in the order of path, page and candidate, by one range exchange."""
    return vector_matches(roi(relation(spark, sf_dir, "words"))).select(*PAGE, "word_id", "text").orderBy(*PAGE, "word_id")
