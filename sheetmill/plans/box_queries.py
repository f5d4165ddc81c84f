"""Queries over words, boxes and regions, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geometry as g
from ..functions import text as t
from ..operators import consensus, grouping, ranking
from ..sources import sinks
from .pipelines import vector_candidates as find_candidates
from .pipelines import vector_matches
from .relations import duck, relation
from .text_queries import PAGE, TOKEN, TOKEN_MATCH, register

# ---- pages and words -------------------------------------------------------------------------------------------------


ROI = "((y0 + y1) / 2 >= 0.75 * page_h OR (x0 + x1) / 2 >= 0.80 * page_w)"

def roi(words):
    return words.filter(((F.col("y0") + F.col("y1")) / 2 >= 0.75 * F.col("page_h")) | ((F.col("x0") + F.col("x1")) / 2 >= 0.80 * F.col("page_w")))


@register("roi_words", f"SELECT pdf_path, page_index, word_id, count(*) OVER (PARTITION BY pdf_path, page_index) < 3 AS few FROM {duck('words')} WHERE {ROI}")
def roi_words(spark, sf_dir):
    from pyspark.sql import Window

    few = F.count("*").over(Window.partitionBy(*PAGE)) < 3
    return roi(relation(spark, sf_dir, "words")).select(*PAGE, "word_id", few.alias("few"))


def pixels(name: str) -> str:
    return f"CAST(round_even({name} * 100 / 72.0, 0) AS int) AS {name}_px"


DIRECT = f"SELECT pdf_path, page_index, word_id, {TOKEN} AS text, x0, y0, x1, y1 FROM {duck('words')} WHERE {ROI} AND {TOKEN_MATCH.format(TOKEN)}"


@register("vector_direct_matches", f"SELECT pdf_path, page_index, word_id, text, {', '.join(map(pixels, ('x0', 'y0', 'x1', 'y1')))} FROM ({DIRECT})")
def vector_direct_matches(spark, sf_dir):
    found = vector_matches(roi(relation(spark, sf_dir, "words")))
    return found.select(*PAGE, "word_id", "text", *(g.points_to_pixels(F.col(c), 100).alias(f"{c}_px") for c in ("x0", "y0", "x1", "y1")))


BUCKETS = f"""SELECT *, CAST(sum(CASE WHEN abs(cy - before) > 3.0 THEN 1 ELSE 0 END) OVER (PARTITION BY pdf_path, page_index ORDER BY r, x0, word_id) AS int) AS line
  FROM (SELECT *, lag(cy) OVER (PARTITION BY pdf_path, page_index ORDER BY r, x0, word_id) AS before
  FROM (SELECT *, (y0 + y1) / 2 AS cy, round_even((y0 + y1) / 2, 1) AS r FROM {duck('words')} WHERE {ROI}))"""


@register("vector_line_buckets", f"SELECT pdf_path, page_index, word_id, line FROM ({BUCKETS})")
def vector_line_buckets(spark, sf_dir):
    return grouping.line_buckets(roi(relation(spark, sf_dir, "words"))).select(*PAGE, "word_id", "line")


TOKENS = f"""SELECT pdf_path, page_index, line, CAST(token AS int) AS token, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1, string_agg(text, ' ' ORDER BY x0, word_id) AS text
  FROM (SELECT *, sum(CASE WHEN x0 - reach > 6.0 THEN 1 ELSE 0 END) OVER (PARTITION BY pdf_path, page_index, line ORDER BY x0, word_id) AS token
  FROM (SELECT *, max(x1) OVER (PARTITION BY pdf_path, page_index, line ORDER BY x0, word_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM ({BUCKETS})))
  GROUP BY pdf_path, page_index, line, token"""


@register("vector_merged_tokens", TOKENS)
def vector_merged_tokens(spark, sf_dir):
    return grouping.merged_tokens(grouping.line_buckets(roi(relation(spark, sf_dir, "words"))))


@register("vector_candidates")
def vector_candidates(spark, sf_dir):
    """Rows only: the greedy choice depends on all earlier ones; tests hold it against a plain loop."""
    return find_candidates(roi(relation(spark, sf_dir, "words")))


ALL_MATCHES = f"""SELECT pdf_path, page_index, 0 AS source, x0, y0, x1, y1, text FROM ({DIRECT})
  UNION ALL SELECT pdf_path, page_index, 1 AS source, x0, y0, x1, y1, {TOKEN} AS text FROM ({TOKENS}) WHERE {TOKEN_MATCH.format(TOKEN)}"""


@register("vector_all_matches", f"SELECT pdf_path, page_index, source, text, count(*) AS n FROM ({ALL_MATCHES}) GROUP BY ALL")
def vector_all_matches(spark, sf_dir):
    from .pipelines import all_matches

    return all_matches(roi(relation(spark, sf_dir, "words"))).groupBy(*PAGE, "source", "text").agg(F.count("*").alias("n"))


@register("pdf_lines", f"SELECT pdf_path, page_index, block_no, line_no, string_agg(trim(text), ' ' ORDER BY word_no, word_id) AS text, min(x0) AS x0_pt, min(y0) AS y0_pt, max(x1) AS x1_pt, max(y1) AS y1_pt FROM {duck('words')} GROUP BY ALL")
def pdf_lines(spark, sf_dir):
    return grouping.pdf_lines(relation(spark, sf_dir, "words"))


OVERLAP = "greatest(0.0, least(y1, py1) - greatest(y0, py0)) / greatest(1.0, least(y1 - y0, py1 - py0))"


@register(
    "region_merge",
    f"""SELECT pdf_path, page_index, line, CAST(region AS int) AS region, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1, string_agg(text, '' ORDER BY x0, word_id) AS text, round(avg(conf), 6) AS conf_avg
  FROM (SELECT *, sum(CASE WHEN px1 IS NULL OR (x0 - px1 <= 12 AND {OVERLAP} >= 0.5) THEN 0 ELSE 1 END) OVER (PARTITION BY pdf_path, page_index, line ORDER BY x0, word_id) AS region
  FROM (SELECT *, lag(x1) OVER w AS px1, lag(y0) OVER w AS py0, lag(y1) OVER w AS py1 FROM ({BUCKETS}) WINDOW w AS (PARTITION BY pdf_path, page_index, line ORDER BY x0, word_id)))
  GROUP BY pdf_path, page_index, line, region""",
)
def region_merge(spark, sf_dir):
    lines = grouping.line_buckets(roi(relation(spark, sf_dir, "words")))
    return grouping.merged_regions(lines, ["line"]).withColumn("conf_avg", F.round("conf_avg", 6))


@register("confident_words", f"SELECT pdf_path, page_index, word_id FROM (SELECT *, max(conf >= 50) OVER (PARTITION BY pdf_path, page_index) AS sure FROM {duck('ocr')}) WHERE conf >= 50 OR NOT sure")
def confident_words(spark, sf_dir):
    return grouping.confident(relation(spark, sf_dir, "ocr")).select(*PAGE, "word_id")


@register("line_height", f"SELECT pdf_path, page_index, greatest(6.0, 0.7 * coalesce(median(h) FILTER (WHERE h > 0), 12.0)) AS line_gap FROM {duck('ocr')} GROUP BY ALL")
def line_height(spark, sf_dir):
    height = grouping.median_or(F.col("h"), 12.0)
    return relation(spark, sf_dir, "ocr").groupBy(*PAGE).agg(F.greatest(F.lit(6.0), 0.7 * height).alias("line_gap"))


@register("line_repeats", f"SELECT pdf_path, page_index, word_id FROM (SELECT *, lag(text) OVER (PARTITION BY pdf_path, page_index ORDER BY word_id) AS before FROM {duck('words')}) WHERE text IS DISTINCT FROM before")
def line_repeats(spark, sf_dir):
    return grouping.without_repeats(relation(spark, sf_dir, "words"), order="word_id").select(*PAGE, "word_id")


@register("overlap_lines")
def overlap_lines(spark, sf_dir):
    """Rows only: which word is a line's middle changes as it grows; tests hold it against a plain loop."""
    words = roi(relation(spark, sf_dir, "words"))
    return grouping.overlap_lines(words).select(*PAGE, F.posexplode("lines").alias("line", "w")).select(*PAGE, "line", F.size("w").alias("words"), F.col("w")[0]["word_id"].alias("first_word"))


LABEL_LIST = "['DRAWING', 'NO', 'NUMBER', 'SHEET']"


@register(
    "nearest_label",
    f"""WITH m AS ({DIRECT}), l AS (SELECT pdf_path, page_index, (x0 + x1) / 2 AS lx, (y0 + y1) / 2 AS ly FROM {duck('words')} WHERE upper(trim(text)) IN ('DRAWING', 'NO', 'NUMBER', 'SHEET'))
  SELECT pdf_path, page_index, word_id, text FROM (SELECT m.*, (SELECT min(((m.x0 + m.x1) / 2 - lx) ** 2 + ((m.y0 + m.y1) / 2 - ly) ** 2) FROM l WHERE l.pdf_path = m.pdf_path AND l.page_index = m.page_index) AS d2 FROM m)
  QUALIFY row_number() OVER (PARTITION BY pdf_path, page_index ORDER BY d2 NULLS LAST, CASE WHEN d2 IS NULL THEN -y1 END, CASE WHEN d2 IS NULL THEN -x1 END, word_id) = 1""",
)
def nearest_label(spark, sf_dir):
    words = relation(spark, sf_dir, "words")
    return ranking.nearest_label(vector_matches(roi(words)), words).select(*PAGE, "word_id", "text")


# ---- labels and regions ----------------------------------------------------------------------------------------------


def sql_label(labels, c: str = "text") -> str:
    return "CASE " + " ".join(f"WHEN contains(upper({c}), '{x}') THEN '{x}'" for x in labels) + " END"


@register("label_lines", f"SELECT pdf_path, page_index, line_no, {sql_label(ranking.DRAWING_LABELS)} AS matched_label FROM {duck('lines')} WHERE {sql_label(ranking.DRAWING_LABELS)} IS NOT NULL QUALIFY row_number() OVER (PARTITION BY pdf_path, page_index ORDER BY line_no) = 1")
def label_lines(spark, sf_dir):
    return ranking.label_lines(relation(spark, sf_dir, "lines"), ranking.DRAWING_LABELS).select(*PAGE, "line_no", "matched_label")


ALL_LABELS = tuple(dict.fromkeys(ranking.DRAWING_LABELS + ranking.TITLE_LABELS + ranking.MORE_ANCHORS))
SCORES = f"SELECT pdf_path, page_index, CAST(count(label) + count(DISTINCT label) AS bigint) AS score FROM (SELECT l.pdf_path, l.page_index, b.label FROM {duck('lines')} AS l LEFT JOIN (SELECT unnest([{', '.join(repr(x) for x in ALL_LABELS)}]) AS label) AS b ON contains(upper(l.text), b.label)) GROUP BY ALL".replace("AS lines AS l", "AS l")


@register("anchor_score", SCORES)
def anchor_score(spark, sf_dir):
    return ranking.anchor_score(relation(spark, sf_dir, "lines"))


REGIONS = ", ".join(str((i, *box)) for i, box in enumerate(g.CANDIDATES))
IN_REGION = "(x0 + x1) / 2 >= rx * page_w AND (x0 + x1) / 2 < (rx + rw) * page_w AND (y0 + y1) / 2 >= ry * page_h AND (y0 + y1) / 2 < (ry + rh) * page_h"


@register(
    "best_region",
    f"""SELECT pdf_path, page_index, CAST(region AS int) AS region, hits AS score FROM (SELECT pdf_path, page_index, region, CAST(count(*) FILTER (WHERE {IN_REGION} AND text IN ('DRAWING', 'NO')) AS bigint) AS hits
  FROM {duck('words')}, (VALUES {REGIONS}) AS v(region, rx, ry, rw, rh) WHERE region < 3 GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY pdf_path, page_index ORDER BY hits DESC, region) = 1""",
)
def best_region(spark, sf_dir):
    inside = F.expr(IN_REGION.replace("page_w", "CAST(page_w AS double)").replace("page_h", "CAST(page_h AS double)")) & F.col("text").isin("DRAWING", "NO")
    rows = ranking.candidate_regions(relation(spark, sf_dir, "words"))
    scores = rows.groupBy(*PAGE, "region").agg(F.count_if(inside).alias("score"))
    return ranking.best_region(scores).select(*PAGE, "region", "score")


@register(
    "keyword_grid",
    f"""SELECT pdf_path, page_index, gx, gy, CAST(score AS int) AS score FROM (SELECT pdf_path, page_index, gx, gy, {' + '.join(f"max(contains(lower(text), '{k.lower()}')::INT)" for k in ranking.GRID_KEYWORDS)} + max(CASE WHEN gx >= 2 AND gy >= 2 THEN 1 ELSE 0 END) AS score
  FROM (SELECT *, least(3, floor(x0 * 4 / 2384))::INT AS gx, least(3, floor(y0 * 4 / 1684))::INT AS gy FROM {duck('words')}) GROUP BY ALL) WHERE score >= 2 QUALIFY row_number() OVER (PARTITION BY pdf_path, page_index ORDER BY score DESC, gy, gx) = 1""",
)
def keyword_grid(spark, sf_dir):
    return ranking.grid_score(relation(spark, sf_dir, "words"), 2384, 1684)


@register(
    "label_regions",
    f"""SELECT pdf_path, page_index, block_no, line_no, CAST(least(2383, greatest(0, r + 4)) AS int) AS rx0, CAST(greatest(0, y0 - trunc(0.2 * lh)) AS int) AS ry0, CAST(least(2384, greatest(least(2383, greatest(0, r + 4)) + 10, x1)) AS int) AS rx1, CAST(least(1684, y1 + trunc(1.9 * lh)) AS int) AS ry1
  FROM (SELECT pdf_path, page_index, block_no, line_no, greatest(min(x0), coalesce(max(x1) FILTER (WHERE text IN ('DRAWING', 'NO')), 0)) AS r, min(y0) AS y0, max(y1) AS y1, max(x1) AS x1, greatest(8, max(y1) - min(y0)) AS lh, count(*) FILTER (WHERE text IN ('DRAWING', 'NO')) AS labels FROM {duck('words')} GROUP BY ALL) WHERE labels > 0""",
)
def label_regions(spark, sf_dir):
    from ..operators.regions import right_of_label

    return right_of_label(relation(spark, sf_dir, "words"), ["block_no", "line_no"], 2384, 1684)


# ---- boxes -----------------------------------------------------------------------------------------------------------



def box():
    return [F.col(n) for n in "xywh"]


@register("bbox_to_abs_trunc", f"SELECT pdf_path, page_index, CAST(greatest(0, trunc((x - 0.01) * page_w)) AS int) AS x0, CAST(greatest(0, trunc((y - 0.01) * page_h)) AS int) AS y0, CAST(least(page_w, trunc((x + w + 0.01) * page_w)) AS int) AS x1, CAST(least(page_h, trunc((y + h + 0.01) * page_h)) AS int) AS y1 FROM {duck('boxes')} WHERE x IS NOT NULL")
def bbox_to_abs_trunc(spark, sf_dir):
    found = g.share_to_pixels(*box(), F.col("page_w"), F.col("page_h"), 0.01)
    return relation(spark, sf_dir, "boxes").filter("x IS NOT NULL").select(*PAGE, *(c.alias(n) for n, c in found.items()))


def sql_round(v: str, size: str) -> str:
    return f"CAST(round_even({v} * {size}, 0) AS int)"


ROUNDED = f"SELECT *, least(greatest(0, {sql_round('x', 'page_w')} - 5), page_w - 1) AS x0, least(greatest(0, {sql_round('y', 'page_h')} - 5), page_h - 1) AS y0 FROM {duck('boxes')} WHERE x IS NOT NULL"


@register("bbox_to_abs_round", f"SELECT pdf_path, page_index, x0, y0, least(greatest(x0 + 1, {sql_round('(x + w)', 'page_w')} + 5), page_w) AS x1, least(greatest(y0 + 1, {sql_round('(y + h)', 'page_h')} + 5), page_h) AS y1 FROM ({ROUNDED})")
def bbox_to_abs_round(spark, sf_dir):
    found = g.share_to_pixels_rounded(*box(), F.col("page_w"), F.col("page_h"), 5)
    return relation(spark, sf_dir, "boxes").filter("x IS NOT NULL").select(*PAGE, *(c.alias(n) for n, c in found.items()))


@register("clip_rect", f"SELECT pdf_path, page_index, round(greatest(0, (0.65 - 0.02) * page_w), 6) AS cx0, round(greatest(0, (0.72 - 0.02) * page_h), 6) AS cy0, round(least(page_w, (0.65 + 0.34 + 0.02) * page_w), 6) AS cx1, round(least(page_h, (0.72 + 0.27 + 0.02) * page_h), 6) AS cy1 FROM {duck('pages')}".replace("0.65", "0.65::DOUBLE").replace("0.72", "0.72::DOUBLE"))
def clip_rect(spark, sf_dir):
    found = g.clip_points(g.BOTTOM_RIGHT, F.col("page_w"), F.col("page_h"), 0.02)
    return relation(spark, sf_dir, "pages").select(*PAGE, *(F.round(c, 6).alias(n) for n, c in found.items()))


@register("clamp_bbox", f"SELECT pdf_path, page_index, x, y, CASE WHEN x + w > 1 THEN round(1 - x, 6) ELSE round(w, 6) END AS w, CASE WHEN y + h > 1 THEN round(1 - y, 6) ELSE round(h, 6) END AS h FROM (SELECT pdf_path, page_index, greatest(0, least(1, x * 2 - 0.6)) AS x, greatest(0, least(1, y)) AS y, greatest(0, least(1, w * 4)) AS w, greatest(0, least(1, h)) AS h FROM {duck('boxes')} WHERE x IS NOT NULL)".replace("SELECT pdf_path, page_index, x, y, CASE", "SELECT pdf_path, page_index, round(x, 6) AS x, round(y, 6) AS y, CASE"))
def clamp_bbox(spark, sf_dir):
    found = g.clamp_share(F.col("x") * 2 - 0.6, F.col("y"), F.col("w") * 4, F.col("h"))
    return relation(spark, sf_dir, "boxes").filter("x IS NOT NULL").select(*PAGE, *(F.round(c, 6).alias(n) for n, c in found.items()))


@register("fit_size", f"SELECT pdf_path, page_index, CAST(CASE WHEN 1280.0::DOUBLE / w < 1 THEN trunc(w * (1280.0::DOUBLE / w)) ELSE w END AS int) AS fit_w, CAST(CASE WHEN 1280.0::DOUBLE / w < 1 THEN greatest(1, trunc(v * (1280.0::DOUBLE / w))) ELSE v END AS int) AS fit_h, CAST(ceil(v / 28.0) * 28 AS int) AS patch_h FROM (SELECT pdf_path, page_index, page_w - o_orderkey % 1700 AS w, page_w - o_orderkey % 1700 - 200 AS v FROM {duck('pages')})")
def fit_size(spark, sf_dir):
    rows = relation(spark, sf_dir, "pages").withColumn("gw", F.col("page_w") - F.col("o_orderkey") % 1700).withColumn("gh", F.col("gw") - 200)
    found = g.fit(F.col("gw"), F.col("gh"), 1280) | {"patch_h": g.patches(F.col("gh"))}
    return rows.select(*PAGE, *(c.alias(n) for n, c in found.items()))


@register("grid_cells", f"SELECT pdf_path, page_index, CAST(gx AS int) AS gx, CAST(gy AS int) AS gy, CAST(trunc(gx * page_w / 4.0) AS int) AS x0, CAST(trunc(gy * page_h / 4.0) AS int) AS y0, gx >= 2 AND gy >= 2 AS bottom_right FROM {duck('pages')}, (SELECT unnest(range(4)) AS gx), (SELECT unnest(range(4)) AS gy)")
def grid_cells(spark, sf_dir):
    cell = F.sequence(F.lit(0), F.lit(3))
    rows = relation(spark, sf_dir, "pages").withColumn("gx", F.explode(cell)).withColumn("gy", F.explode(cell))
    corner = lambda c, size: g.whole(F.col(c) * F.col(size) / 4)
    return rows.select(*PAGE, "gx", "gy", corner("gx", "page_w").alias("x0"), corner("gy", "page_h").alias("y0"), ((F.col("gx") >= 2) & (F.col("gy") >= 2)).alias("bottom_right"))


def sql_iou(a: tuple, b: tuple) -> str:
    w = f"(least({a[2]}, {b[2]}) - greatest({a[0]}, {b[0]}))"
    h = f"(least({a[3]}, {b[3]}) - greatest({a[1]}, {b[1]}))"
    both = f"(CASE WHEN {w} > 0 AND {h} > 0 THEN {w} * {h} ELSE 0 END)"
    union = f"(({a[2]} - {a[0]}) * ({a[3]} - {a[1]}) + ({b[2]} - {b[0]}) * ({b[3]} - {b[1]}) - {both})"
    return f"(CASE WHEN {both} > 0 THEN {both} / {union} ELSE 0 END)"


def sql_corners(p: str) -> tuple:
    return f"{p}x", f"{p}y", f"({p}x + {p}w)", f"({p}y + {p}h)"


@register("iou_pairs", f"SELECT a.pdf_path, a.page_index, b.page_index AS other, round({sql_iou(sql_corners('a.'), sql_corners('b.'))}, 6) AS iou FROM (SELECT * FROM {duck('boxes')}) AS a JOIN (SELECT * FROM {duck('boxes')}) AS b ON a.pdf_path = b.pdf_path AND a.page_index + 1 = b.page_index AND a.x IS NOT NULL AND b.x IS NOT NULL")
def iou_pairs(spark, sf_dir):
    """Boxes of neighbouring pages; of documents that share a path each with each."""
    rows = relation(spark, sf_dir, "boxes").filter("x IS NOT NULL")
    after = rows.select("pdf_path", (F.col("page_index") - 1).alias("page_index"), F.col("page_index").alias("other"), *(F.col(n).alias(f"n{n}") for n in "xywh"))
    overlap = g.iou(consensus.corners(), consensus.corners("n"))
    return rows.join(after, PAGE).select(*PAGE, "other", F.round(overlap, 6).alias("iou"))


SAMPLE = f"(SELECT * FROM {duck('boxes')} WHERE page_index < greatest(1, least(3, page_count))) AS s"
MEDIAN = "median(x) AS mx, median(y) AS my, median(w) AS mw, median(h) AS mh"


@register("median_bbox", f"SELECT pdf_path, round(mx, 6) AS mx, round(my, 6) AS my, round(mw, 6) AS mw, round(mh, 6) AS mh, boxes FROM (SELECT pdf_path, {MEDIAN}, count(*) AS boxes FROM {SAMPLE} WHERE x IS NOT NULL GROUP BY pdf_path)")
def median_bbox(spark, sf_dir):
    found = consensus.median_box(consensus.detection_sample(relation(spark, sf_dir, "boxes")), ["pdf_path"])
    return found.select("pdf_path", *(F.round(f"m{n}", 6).alias(f"m{n}") for n in "xywh"), "boxes")


AGREED = f"""SELECT d.pdf_path, CAST(coalesce(boxes, 0) AS bigint) AS boxes, CAST(coalesce(hits, 0) AS bigint) AS hits, CASE WHEN boxes IS NULL THEN 0 ELSE greatest(1, CAST(ceil(boxes * 0.6::DOUBLE) AS int)) END AS required, coalesce(boxes = 2 AND pair >= 0.5, false) AS pair_ok, coalesce(hits >= greatest(1, ceil(boxes * 0.6::DOUBLE)) OR (boxes = 2 AND pair >= 0.5), false) AS ok
  FROM (SELECT DISTINCT pdf_path FROM {SAMPLE}) AS d LEFT JOIN (SELECT pdf_path, any_value(boxes) AS boxes, sum(({sql_iou(sql_corners('m'), sql_corners(''))} >= 0.5)::INT) AS hits, max({sql_iou(sql_corners('p'), sql_corners(''))}) AS pair
  FROM (SELECT *, lag(x) OVER v AS px, lag(y) OVER v AS py, lag(w) OVER v AS pw, lag(h) OVER v AS ph FROM (SELECT s.* FROM {SAMPLE} WHERE x IS NOT NULL) JOIN (SELECT pdf_path, {MEDIAN}, count(*) AS boxes FROM {SAMPLE} WHERE x IS NOT NULL GROUP BY pdf_path) USING (pdf_path) WINDOW v AS (PARTITION BY pdf_path ORDER BY page_index)) GROUP BY pdf_path) AS f ON d.pdf_path = f.pdf_path"""


def agreed(spark, sf_dir):
    return consensus.consensus(consensus.detection_sample(relation(spark, sf_dir, "boxes")))


@register("bbox_consensus", AGREED)
def bbox_consensus(spark, sf_dir):
    return agreed(spark, sf_dir).select("pdf_path", "boxes", "hits", "required", "pair_ok", "ok")


@register("pdf_decision", f"SELECT pdf_path, CASE WHEN boxes >= 2 AND ok THEN 'global_bbox_reuse' WHEN boxes = 1 THEN 'global_bbox_single' ELSE 'per_page_detection' END AS note FROM ({AGREED})")
def pdf_decision(spark, sf_dir):
    return consensus.decision(agreed(spark, sf_dir))


FIRST_BOX = f"SELECT pdf_path AS from_pdf, x AS bx FROM (SELECT * FROM {SAMPLE} ORDER BY pdf_path, page_index LIMIT 3) WHERE x IS NOT NULL ORDER BY pdf_path, page_index LIMIT 1"


@register("global_scope", f"SELECT pdf_path, page_index, bx AS x, CASE WHEN from_pdf IS NOT NULL THEN 'global_scope_bbox_reuse' ELSE 'global_scope_partial;cover_no_title_block' END AS note FROM {duck('boxes')} LEFT JOIN ({FIRST_BOX}) ON pdf_path >= from_pdf")
def global_scope(spark, sf_dir):
    return consensus.global_scope(relation(spark, sf_dir, "boxes")).select(*PAGE, "x", "note")


@register("detection_summary", f"SELECT pdf_path, count(x) AS with_box, count(*) AS pages FROM {duck('boxes')} GROUP BY pdf_path")
def detection_summary(spark, sf_dir):
    return sinks.summary(relation(spark, sf_dir, "boxes"))


#: The reference's most boxes of a page in a prompt.
MOST_BOXES = 60
LETTER = "chr(CAST(65 + {0} AS int))"


@register("box_ids", f"SELECT pdf_path, page_index, word_id, CASE WHEN n < 26 THEN {LETTER.format('n')} ELSE {LETTER.format('(n - 26) // 26')} || {LETTER.format('(n - 26) % 26')} END AS id FROM (SELECT *, word_id - 1 AS n FROM {duck('words')} WHERE word_id <= {MOST_BOXES})")
def box_ids(spark, sf_dir):
    return relation(spark, sf_dir, "words").filter(F.col("word_id") <= MOST_BOXES).select(*PAGE, "word_id", t.letter_id(F.col("word_id") - 1).alias("id"))


@register("jsonl_projection", f"SELECT pdf_path, page_index, '{{\"x\":' || CAST(x AS varchar) || ',\"w\":' || CAST(w AS varchar) || '}}' AS bbox_json FROM {duck('boxes')} WHERE x IS NOT NULL UNION ALL SELECT pdf_path, page_index, 'null' FROM {duck('boxes')} WHERE x IS NULL")
def jsonl_projection(spark, sf_dir):
    box = F.when(F.col("x").isNotNull(), F.struct("x", "w"))
    return relation(spark, sf_dir, "boxes").select(*PAGE, F.coalesce(F.to_json(box), F.lit("null")).alias("bbox_json"))


# ---- the same over all pages and words -------------------------------------------------------------------------------


@register("pages_list", f"SELECT pdf_path, page_index, page_count FROM {duck('pages')}")
def pages_list(spark, sf_dir):
    return relation(spark, sf_dir, "pages").select(*PAGE, "page_count")


@register("vector_csv_vs_jsonl", f"SELECT p.pdf_path, p.page_index, CAST(count(m.pdf_path) AS bigint) AS candidates, count(m.pdf_path) > 0 AS in_csv FROM (SELECT DISTINCT pdf_path, page_index FROM {duck('words')}) AS p LEFT JOIN ({DIRECT}) AS m USING (pdf_path, page_index) GROUP BY ALL")
def vector_csv_vs_jsonl(spark, sf_dir):
    words = relation(spark, sf_dir, "words")
    found = vector_matches(roi(words)).groupBy(*PAGE).agg(F.count("*").alias("candidates"))
    pages = words.select(*PAGE).distinct().join(found, PAGE, "left")
    return pages.select(*PAGE, F.coalesce("candidates", F.lit(0)).alias("candidates"), F.col("candidates").isNotNull().alias("in_csv"))


@register("box_class_join", f"SELECT b.pdf_path, b.page_index, b.word_id, c.field FROM (SELECT * FROM {duck('words')} WHERE word_id <= {MOST_BOXES}) AS b LEFT JOIN (SELECT pdf_path, page_index, word_id // 2 AS k, arg_max(text, word_id) AS field FROM {duck('words')} GROUP BY ALL) AS c ON c.pdf_path = b.pdf_path AND c.page_index = b.page_index AND c.k = b.word_id")
def box_class_join(spark, sf_dir):
    """All words of a page are entries, two for each id; boxes in the second half of a page have none."""
    words = relation(spark, sf_dir, "words")
    entries = words.withColumn("id", t.letter_id(F.floor(F.col("word_id") / 2).cast("int") - 1)).filter("word_id >= 2")
    fields = entries.groupBy(*PAGE, "id").agg(F.max_by("text", "word_id").alias("field"))
    boxes = words.filter(F.col("word_id") <= MOST_BOXES).select(*PAGE, "word_id", t.letter_id(F.col("word_id") - 1).alias("id"))
    return boxes.join(fields, [*PAGE, "id"], "left").select(*PAGE, "word_id", "field")


@register("box_prompt", f"SELECT pdf_path, page_index, string_agg(printf('%d: [%.4f, %.4f]', word_id, x0 / 2384, y0 / 1684), chr(10) ORDER BY word_id) AS prompt FROM {duck('words')} WHERE word_id <= {MOST_BOXES} GROUP BY ALL")
def box_prompt(spark, sf_dir):
    line = F.format_string("%d: [%.4f, %.4f]", "word_id", F.col("x0") / 2384, F.col("y0") / 1684)
    rows = relation(spark, sf_dir, "words").filter(F.col("word_id") <= MOST_BOXES).groupBy(*PAGE).agg(F.array_sort(F.collect_list(F.struct("word_id", line.alias("line")))).alias("l"))
    return rows.select(*PAGE, F.array_join(F.transform("l", lambda x: x["line"]), "\n").alias("prompt"))
