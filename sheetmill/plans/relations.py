"""Title-block relations derived from the driver's tables by SQL that Spark and DuckDB read alike.

``{orders}``, ``{customer}`` and ``{lineitem}`` stand for the tables, so that one text serves both engines. A page of words holds
those of about a hundred orders, or of a single one, so pages grow in number with the tables and not in size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

NUMBERS = " UNION ALL ".join(f"SELECT {i} AS line_no" for i in range(8))

PAGES = """
SELECT 'set/' || lpad(CAST(o_custkey AS varchar(20)), 5, '0') || '.pdf' AS pdf_path,
  CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS int) AS page_index,
  CAST(count(*) OVER (PARTITION BY o_custkey) AS int) AS page_count,
  2384 AS page_w, 1684 AS page_h, o_orderkey, o_custkey
FROM {orders}
"""

WORDS = """
SELECT 'set/w' || lpad(CAST(CAST(floor(k / 20) AS bigint) AS varchar(20)), 6, '0') || '.pdf' AS pdf_path, CAST(k % 20 AS int) AS page_index,
  CAST(row_number() OVER (PARTITION BY k ORDER BY l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
    l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS int) AS word_id,
  CAST(x AS double) AS x0, CAST(x + 8 + l_suppkey % 40 AS double) AS x1, CAST(y AS double) AS y0, CAST(y + 14 AS double) AS y1,
  CASE l_linenumber % 6
    WHEN 0 THEN substr('ASEMPT', CAST(l_partkey % 6 + 1 AS int), 1) || '-' || lpad(CAST(l_partkey % 100 AS varchar(20)), 2, '0')
    WHEN 1 THEN substr('ASEMPT', CAST(l_partkey % 6 + 1 AS int), 1) || CAST(l_partkey % 10 AS varchar(20))
    WHEN 2 THEN '-'
    WHEN 3 THEN lpad(CAST(l_partkey % 100 AS varchar(20)), 2, '0')
    WHEN 4 THEN CASE WHEN l_partkey % 2 = 0 THEN 'DRAWING' ELSE 'NO' END
    ELSE 'detail' END AS text,
  CAST(floor(l_suppkey / 10) % 6 AS int) AS block_no, CAST(l_suppkey % 10 AS int) AS line_no, l_linenumber AS word_no,
  CAST(l_partkey % 102 - 1 AS double) AS conf, 2384 AS page_w, 1684 AS page_h
FROM (SELECT *, 2 * CAST(floor(l_orderkey / 100) AS bigint) + CASE WHEN l_orderkey % 100 = 0 THEN 1 ELSE 0 END AS k, (l_partkey * 37 + l_linenumber * 11) % 2300 AS x, (l_suppkey * 7 % 60) * 28 AS y FROM {lineitem}) AS numbered
"""

OCR = f"""
SELECT pdf_path, page_index, word_id, text, conf, CAST(x0 AS int) AS x, CAST(y0 + word_id % 3 AS int) AS y, CAST(x1 - x0 AS int) AS w, 14 AS h
FROM ({WORDS}) AS words
"""

LINES = f"""
SELECT pdf_path, page_index, line_no, page_count, o_orderkey, CASE line_no
  WHEN 0 THEN 'PROJECT: ' || c_name
  WHEN 1 THEN 'DRAWING NO ' || substr('ASEMPTX', CAST(o_orderkey % 7 + 1 AS int), 1)
    || CASE o_orderkey % 3 WHEN 0 THEN '1-' WHEN 1 THEN '1 - ' ELSE '-' END || lpad(CAST(o_orderkey % 100 AS varchar(20)), 2, '0')
  WHEN 2 THEN CASE o_orderkey % 4 WHEN 0 THEN 'TITLE GROUND FLOOR PLAN' WHEN 1 THEN 'SECTION ' || c_mktsegment
    ELSE 'typical ' || lower(c_mktsegment) || ' detail' END
  WHEN 3 THEN 'SCALE 1 : ' || CAST(25 * (1 + o_orderkey % 8) AS varchar(20))
  WHEN 4 THEN 'DATE ' || CAST(1 + o_orderkey % 31 AS varchar(20)) || '/' || lpad(CAST(1 + o_custkey % 12 AS varchar(20)), 2, '0')
    || '/' || CASE o_orderkey % 3 WHEN 0 THEN '2024' WHEN 1 THEN '2567' ELSE '24' END
  WHEN 5 THEN CASE WHEN o_orderkey % 2 = 0 THEN 'SHEET ' || CAST(page_index + 1 AS varchar(20)) || ' OF ' || CAST(page_count AS varchar(20))
    ELSE 'PAGE ' || CAST(page_index + 1 AS varchar(20)) || '/' || CAST(page_count AS varchar(20)) END
  WHEN 6 THEN 'REV ' || CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE 'A' || CAST(o_orderkey % 10 AS varchar(20)) END
  ELSE CASE WHEN o_orderkey % 6 = 0 THEN '' ELSE 'STRUCTURAL NOTE S1-0' || CAST(o_orderkey % 10 AS varchar(20)) || ' S2-0'
    || CAST(o_custkey % 10 AS varchar(20)) END END AS text
FROM ({PAGES}) AS pages JOIN {{customer}} ON c_custkey = o_custkey CROSS JOIN ({NUMBERS}) AS numbers
"""

BOXES = f"""
SELECT pdf_path, page_index, page_count, page_w, page_h, o_orderkey,
  CASE WHEN o_orderkey % 7 <> 0 THEN CAST(70 + o_orderkey % 5 AS double) / 100 END AS x,
  CASE WHEN o_orderkey % 7 <> 0 THEN CAST(72 + o_custkey % 3 + 2 * (o_orderkey % 11) AS double) / 100 END AS y,
  CASE WHEN o_orderkey % 7 <> 0 THEN CAST(10 + o_orderkey % 4 AS double) / 100 END AS w,
  CASE WHEN o_orderkey % 7 <> 0 THEN CAST(6 + o_orderkey % 2 AS double) / 100 END AS h
FROM ({PAGES}) AS pages
"""

MODEL = f"""
SELECT pdf_path, page_index, crop_ord, CASE (o_orderkey + crop_ord) % 6
  WHEN 0 THEN '{{{{"drawing_no": "A1-0' || CAST(o_orderkey % 10 AS varchar(20)) || '", "scale": "1/100", "candidates": ["A1-01", "S2-02"]}}}}'
  WHEN 1 THEN '```json' || chr(10) || '{{{{"drawing_no": "", "drawing_title": "ROOF PLAN", "page": {{{{"x": "1", "total": "9"}}}}}}}}' || chr(10) || '```'
  WHEN 2 THEN 'The code is S1 - 0' || CAST(o_orderkey % 10 AS varchar(20)) || ' SCALE 1:75 sheet 2/9'
  WHEN 3 THEN '{{{{"drawing_no": "E1-07", "drawing_title": "LIGHTING"}}}} and that is all'
  WHEN 4 THEN ''
  ELSE '{{{{''drawing_no'': ''SN-08''}}}}' END AS raw, o_orderkey
FROM ({PAGES}) AS pages CROSS JOIN (SELECT 0 AS crop_ord UNION ALL SELECT 1 AS crop_ord) AS crops
"""

FIELDS = f"""
SELECT pdf_path, page_index, page_count, o_orderkey,
  CASE o_orderkey % 5 WHEN 0 THEN '1/100' WHEN 1 THEN ' 1 : 050 ' WHEN 2 THEN 'NTS' WHEN 3 THEN 'approx 1:20' ELSE '1 :75' END AS raw_scale,
  CASE o_orderkey % 5 WHEN 0 THEN 'GROUND FLOOR PLAN SHEET: 4' WHEN 1 THEN 'RB9mm @ 0.15m, BEAM DETAIL' WHEN 2 THEN '--'
    WHEN 3 THEN 'SECTION A; 2.50 x 3.00' ELSE ' ROOF  PLAN ' END AS raw_title,
  CASE o_orderkey % 6 WHEN 0 THEN '3 OF 12' WHEN 1 THEN '4/20' WHEN 2 THEN 'TOTAL PAGES 46/57' WHEN 3 THEN '9' WHEN 4 THEN 'n/a' ELSE '' END AS raw_total,
  CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE 'SN-' || lpad(CAST(o_orderkey % 100 AS varchar(20)), 2, '0') END AS drawing_no
FROM ({PAGES}) AS pages
"""

RELATIONS = {"pages": PAGES, "words": WORDS, "ocr": OCR, "lines": LINES, "boxes": BOXES, "model": MODEL, "fields": FIELDS}
TABLES = ("orders", "customer", "lineitem")


def duck(name: str) -> str:
    """The relation as a DuckDB subquery."""
    return "(" + RELATIONS[name].format(**{t: t for t in TABLES}) + ") AS " + name


def relation(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sql = RELATIONS[name]
    used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if "{" + t + "}" in sql}
    return spark.sql(sql, **used)
