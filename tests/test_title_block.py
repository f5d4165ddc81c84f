"""Golden strings, plain loops beside folds, and every query against its SQL."""

import glob
import os
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from sheetmill import queries
from sheetmill.functions import geometry as g
from sheetmill.functions import jsonx
from sheetmill.functions import text as t
from sheetmill.operators import classify, consensus, grouping, ranking
from sheetmill.sources import files, recognisers, sinks

SF = "/root/testdata/sf0.001"


def one(spark, expr, value, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(expr(F.col("c"))).first()[0]


@pytest.mark.parametrize(
    ("function", "value", "expected"),
    [
        (t.guarded_numbers, "A1-01 A1-02, sn 1 - 08 XA1-01 E1-011", ["A1-01", "A1-02", "sn 1-08"]),
        (t.consuming_numbers, "A1-01 A1-02 A1-03", ["A1-01", "A1-03"]),
        (t.normalize_token, "A 1 – 01", "A1-01"),
        (t.plain_hyphen, "SN—08", "SN-08"),
        (t.fast_number, "E-101", "E-101"),
        (t.normalize_scale, "1/100", "1:100"),
        (t.normalize_scale, " 1 : 050 ", "1:50"),
        (t.normalize_scale, "NTS", ""),
        (t.normalize_scale, "approx 1:20", ""),
        (t.scale_of, "SCALE 1 : 75", "1:75"),
        (t.clean_title, "GROUND FLOOR PLAN SHEET: 4", "GROUND FLOOR PLAN"),
        (t.clean_title, "RB9mm @ 0.15m, BEAM DETAIL", "BEAM DETAIL"),
        (t.clean_title, "--", ""),
        (t.date_of, "DATE 18/7/2567", "2024-07-18"),
        (t.date_of, "5-8-24", "2024-08-05"),
        (t.date_of, "1/1/70", "1970-01-01"),
        (t.date_of, "30/2/2024", "30/02/2024"),
        (jsonx.relaxed, 'text {"a":"b"} text', '{"a":"b"}'),
        (jsonx.relaxed, "{'a':'b'}", "{}"),
        (jsonx.relaxed, "", "{}"),
        (jsonx.relaxed, '```json\n{"a": {"b": 1}}\n```', '{"a": {"b": 1}}'),
        (t.cleanup_model_text, "a picture of a plan", ""),
    ],
)
def test_golden_strings(spark, function, value, expected):
    assert one(spark, function, value) == expected


def test_model_numbers_thai_boundaries_and_ids(spark):
    assert one(spark, lambda c: t.model_numbers(c, F.array().cast("array<string>")), "A101 and E-101") == ["A101"]
    # a combining mark ends a word, a letter does not
    assert one(spark, lambda c: F.regexp_extract(c, t.RULE_NUMBER, 1), "เลขที่SN-08") == "SN-08"
    assert one(spark, lambda c: F.regexp_extract(c, t.RULE_NUMBER, 1), "เลขที่แบบSN-08") == ""
    ids = spark.range(703).select(t.letter_id(F.col("id")).alias("x")).collect()
    assert [ids[i].x for i in (0, 25, 26, 27, 51, 52, 701, 702)] == ["A", "Z", "AA", "AB", "AZ", "BA", "ZZ", "AAA"]
    for code in ("A1-01", "A-01", "ST-02", "AR-000", "A101-02", "S10-002", "S-12", "W-005", "AR-1203", "A101"):
        assert one(spark, t.is_token_number, code)
    assert one(spark, lambda c: t.is_token_number(c, r"^zz$"), "ZZ")


@pytest.mark.parametrize(("raw", "page", "count", "expected"), [("3 OF 12", 0, 5, "3/12"), ("4/20", 0, 5, "4/20"), ("TOTAL PAGES 46/57", 0, 5, "46/57"), ("9", 4, 5, "5/9"), ("n/a", 0, 5, "1/5"), (None, 1, 5, "2/5")])
def test_pages_of_total(spark, raw, page, count, expected):
    assert one(spark, lambda c: t.page_of_total(c, F.lit(page), F.lit(count)), raw) == expected


@pytest.mark.parametrize(("page", "drawing", "expected"), [("57/57", "SN-08", "p.pdf page57_57_SN-08"), (" ", "SN-08", "p.pdf SN-08"), (None, "", "p.pdf")])
def test_derived_paths(spark, page, drawing, expected):
    assert one(spark, lambda c: t.derived_path(F.lit("p.pdf"), c, F.lit(drawing)), page) == expected


def test_geometry(spark):
    assert one(spark, lambda c: g.points_to_pixels(c, 100), 36.0, "double") == 50
    assert one(spark, lambda c: g.points_to_pixels(c, 100), 0.36, "double") == 0
    assert one(spark, lambda c: g.patches(c), 29, "int") == 56
    assert one(spark, lambda c: g.iou((c, c, c + 2, c + 2), (c + 1, c + 1, c + 3, c + 3)), 0.0, "double") == pytest.approx(1 / 7)


def words(rng, n):
    return [("p", 0, i, float(x := rng.randrange(300)), float(y := 7 * rng.randrange(12)), float(x + rng.randrange(5, 30)), float(y + 14), rng.choice("abcd"), float(rng.randrange(-1, 100))) for i in range(n)]


WORDS = "pdf_path string, page_index int, word_id int, x0 double, y0 double, x1 double, y1 double, text string, conf double"


def overlap(a, b):
    return max(0.0, min(a[6], b[6]) - max(a[4], b[4])) / max(1.0, min(a[6] - a[4], b[6] - b[4]))


def test_folds_equal_loops(spark):
    rng = random.Random(7)
    rows = words(rng, 60)
    frame = spark.createDataFrame(rows, WORDS)
    expected = []
    for w in sorted(rows, key=lambda w: (w[4], w[3], w[2])):
        line = next((x for x in expected if overlap(w, x[len(x) // 2]) >= 0.5), None)
        if line is None:
            expected.append([w])
        else:
            line.append(w)
    found = grouping.overlap_lines(frame).first().lines
    assert [[w.word_id for w in x] for x in found] == [[w[2] for w in x] for x in expected]

    ocr = frame.selectExpr("pdf_path", "page_index", "word_id", "text", "conf", "CAST(x0 AS int) x", "CAST(y0 AS int) + word_id % 3 y", "CAST(x1 - x0 AS int) w", "14 h")
    lines, base = [], None
    for w in sorted(ocr.collect(), key=lambda w: (w.y + w.h / 2, w.x, w.word_id)):
        middle = w.y + w.h / 2
        if base is None or abs(middle - base) > max(6.0, 0.7 * 14):
            lines.append([])
            base = middle
        else:
            base = 0.8 * base + 0.2 * middle
        lines[-1].append(w)
    expected = [[w.text for w in sorted(x, key=lambda w: (w.x, w.word_id))] for x in lines]
    assert [r.words for r in sorted(grouping.drifting_lines(ocr).collect(), key=lambda r: r.line)] == expected

    boxes = sorted(((r[3], r[4], r[5], r[6], r[7]) for r in rows), key=str)
    kept = []
    for b in boxes:
        def share(o, b=b):
            w, h = min(o[2], b[2]) - max(o[0], b[0]), min(o[3], b[3]) - max(o[1], b[1])
            both = w * h if w > 0 and h > 0 else 0
            return both / ((o[2] - o[0]) * (o[3] - o[1]) + (b[2] - b[0]) * (b[3] - b[1]) - both)

        if not any(o[4] == b[4] and share(o) >= 0.3 for o in kept):
            kept.append(b)
    made = spark.createDataFrame([(boxes,)], "c array<struct<x0:double,y0:double,x1:double,y1:double,text:string>>").select(ranking.greedy_distinct(F.col("c"), 0.3).alias("k")).first().k
    assert [tuple(x) for x in made] == kept and len(kept) < len(boxes)


def test_rules_take_the_first_longest_title(spark):
    lines = [["PROJECT: Tower", "abc def", "xyz uvw", "REV", "REV A2", "DATE 31/02/2024", "SN-08"]]
    fields = classify.rule_fields(F.col("lines"))
    r = spark.createDataFrame([(lines[0],)], "lines array<string>").select(*(c.alias(n) for n, c in fields.items())).first()
    assert (r.drawing_title, r.project, r.revision, r.date, r.drawing_no, r.discipline) == ("abc def", "Tower", "A2", "31/02/2024", "A2", "ARCHITECTURAL")
    empty = spark.createDataFrame([([],)], "lines array<string>").select(*(c.alias(n) for n, c in fields.items())).first()
    assert set(empty) == {""}


def test_files_and_sinks_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("a", None, 'x "y", z', [1, 2]), ("b", "", "two\nlines", None)], "pdf_path string, n string, text string, list array<int>")
    sinks.write_csv(rows, str(tmp_path / "csv"))
    back = files.text_csv(spark, str(tmp_path / "csv"))
    assert sorted(map(tuple, back.collect())) == [("a", "", 'x "y", z', "[1,2]"), ("b", "", "two\nlines", "null")]
    sinks.write_jsonl(rows, str(tmp_path / "json"), drop=("list",))
    text = "".join(open(f, encoding="utf-8").read() for f in glob.glob(f"{tmp_path}/json/part-*"))
    assert '"n":null' in text and "list" not in text
    texts = files.page_texts(back.withColumn("page", F.lit("3")))
    assert {tuple(r) for r in texts.collect()} == {("a", "3", 'x "y", z'), ("b", "3", "two\nlines")}
    assert sinks.free_name(["a", "renamed_path", "renamed_path_1"]) == "renamed_path_2"
    for name in ("a.pdf", "B.PDF", "c.txt", "bad.pdf"):
        (tmp_path / name).write_bytes(b"" if name == "bad.pdf" else b"%PDF" + name.encode())
    sizes = lambda content: [(10.0, 20.0)] * (2 if content[0] else 0)
    found = files.pages(files.pdf_files(spark, str(tmp_path)), sizes).collect()
    assert sorted((os.path.basename(r.pdf_path), r.page_index, r.page_count) for r in found) == [("B.PDF", 0, 2), ("B.PDF", 1, 2), ("a.pdf", 0, 2), ("a.pdf", 1, 2)]


def test_recorded_answers(spark):
    crops = spark.createDataFrame([("p", 0, 0, "known", None), ("p", 0, 1, "unknown", None)], "pdf_path string, page_index int, crop_ord int, prompt string, image binary")
    out = recognisers.recognise(crops, lambda: recognisers.Recorded({"known": "A1-01"})).collect()
    assert sorted((r.crop_ord, r.raw, r.status) for r in out) == [(0, "A1-01", "ok"), (1, "", "KeyError")]
    assert recognisers.base_url("host:11434/v1/", "ollama") == "http://host:11434"
    assert recognisers.answer_text({"choices": [{"message": {"content": "x"}}]}) == "x" == recognisers.answer_text({"message": {"content": "x"}})


def test_streams_count_numbers(spark, tmp_path):
    from sheetmill import streaming

    rows = [("p", 0, 0, "A1-01 S1-02", "2024-01-01 00:00:00"), ("p", 1, 0, "A1-01", "2024-01-01 00:05:00")]
    spark.createDataFrame(rows, "pdf_path string, page_index int, line_no int, text string, at string").write.json(str(tmp_path / "in"))
    stream = streaming.numbers_per_window(streaming.line_stream(spark, str(tmp_path / "in")))
    query = stream.writeStream.format("memory").queryName("numbers").outputMode("complete").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    query.awaitTermination(60)
    assert {(r.number, r.pages) for r in spark.table("numbers").collect()} == {("A1-01", 2), ("S1-02", 1)}


def rounded(v):
    return round(v, 9) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    out = queries.queries()[name](spark, SF)
    expected = con.execute(f"SELECT {', '.join(out.columns)} FROM ({queries.oracle_sql()[name]})").fetchall()
    assert sorted((tuple(rounded(r[c]) for c in out.columns) for r in out.collect()), key=str) == sorted((tuple(map(rounded, r)) for r in expected), key=str)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_has_the_columns_of_its_sql(spark, name):
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    expected = [r[0] for r in con.execute(f"DESCRIBE {queries.oracle_sql()[name]}").fetchall()]
    assert queries.queries()[name](spark, SF).columns == expected


def test_entry_runs(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_pages_with_and_without_candidates(spark):
    records = queries.queries()["vector_csv_vs_jsonl"](spark, SF).collect()
    assert {r.in_csv for r in records} == {True, False} and all(r.in_csv == (r.candidates > 0) for r in records)


def test_documents_without_a_box_require_none(spark):
    rows = [("a", 0, 3, None, None, None, None), ("b", 0, 3, 0.1, 0.1, 0.2, 0.2), ("b", 1, 3, 0.1, 0.1, 0.2, 0.2), ("b", 2, 3, 0.7, 0.7, 0.2, 0.2)]
    frame = spark.createDataFrame(rows, "pdf_path string, page_index int, page_count int, x double, y double, w double, h double")
    out = {r.pdf_path: (r.boxes, r.hits, r.required, r.ok) for r in consensus.consensus(frame).collect()}
    assert out == {"a": (0, 0, 0, False), "b": (3, 2, 2, True)}


def test_letter_ids_of_any_length(spark):
    def expected(n):
        out = ""
        n += 1
        while n:
            n, r = divmod(n - 1, 26)
            out = chr(65 + r) + out
        return out

    ns = [0, 25, 26, 701, 702, 18277, 18278, 475253, 475254, 10**12]
    out = spark.createDataFrame([(n,) for n in ns], "n long").select("n", t.letter_id(F.col("n")).alias("id")).collect()
    assert {r.n: r.id for r in out} == {n: expected(n) for n in ns}


def test_names_of_paths(spark):
    paths = ["/a/b.c.pdf", "x.PDF", ".hidden", "a/b"]
    assert [one(spark, t.stem, p) for p in paths] == ["b.c", "x", ".hidden", "b"]
    assert [one(spark, t.base_name, p) for p in paths] == ["b.c.pdf", "x.PDF", ".hidden", "b"]


def test_ordered_files_and_overlays(spark, tmp_path):
    rows = [(f"p{i % 3}", i % 5, i) for i in range(60)]
    frame = spark.createDataFrame(rows, "pdf_path string, page_index int, n int").repartition(4)
    sinks.write_jsonl(frame, str(tmp_path / "out"), drop=("n",), order=("pdf_path", "page_index", "n"))
    text = [line for f in sorted(glob.glob(f"{tmp_path}/out/part-*")) for line in open(f, encoding="utf-8")]
    assert text == sorted(text) and len(text) == 60
    folder = str(tmp_path)

    def draw(path, page, found):
        with open(f"{folder}/{path}-{page}.drawn", "x", encoding="utf-8") as f:  # a page comes once
            f.write(str(len(found)))

    sinks.write_overlays(frame, draw)
    assert [open(f, encoding="utf-8").read() for f in glob.glob(f"{folder}/*.drawn")] == ["4"] * 15


SHARED_PATHS = ("crop_merge", "fast_classify", "fast_merge", "iou_pairs")


@pytest.mark.parametrize("name", SHARED_PATHS)
def test_documents_that_share_a_path(spark, tmp_path, name):
    """Customers 12345 and 123450 share a path; what SQL decides of such pages is equal, whatever its order leaves open."""
    con = duckdb.connect()
    con.execute("CREATE TABLE customer AS SELECT k AS c_custkey, 'Customer' AS c_name, 'BUILDING' AS c_mktsegment FROM (VALUES (12345), (123450), (7)) AS v(k)")
    con.execute("CREATE TABLE orders AS SELECT 420 * (10 * i + j) + 8 + j // 3 AS o_orderkey, k AS o_custkey FROM (VALUES (12345, 0), (123450, 1), (7, 2)) AS v(k, j), range(4) AS r(i)")
    for table in ("customer", "orders"):
        con.execute(f"COPY {table} TO '{tmp_path}/{table}.parquet' (FORMAT parquet)")
    out = queries.queries()[name](spark, str(tmp_path))
    expected = con.execute(f"SELECT {', '.join(out.columns)} FROM ({queries.oracle_sql()[name]})").fetchall()
    assert len(expected) > 1
    assert sorted((tuple(rounded(r[c]) for c in out.columns) for r in out.collect()), key=str) == sorted((tuple(map(rounded, r)) for r in expected), key=str)


WHOLE_PAGES = ("ocr_rule_classify", "fast_classify", "fast_merge", "rule_scale", "rule_drawing_no")


@pytest.mark.parametrize("name", WHOLE_PAGES)
def test_long_pages_are_read_to_their_end(spark, tmp_path, name):
    """210 customers share a path, so a page has over 200 lines of each number; their texts are equal, so no order is left open."""
    con = duckdb.connect()
    con.execute("CREATE TABLE customer AS SELECT 1000000020 + 60 * j AS c_custkey, 'Customer' AS c_name, 'BUILDING' AS c_mktsegment FROM range(210) AS v(j)")
    con.execute("CREATE TABLE orders AS SELECT 130200 * (2 * j + i) + 8 AS o_orderkey, 1000000020 + 60 * j AS o_custkey FROM range(210) AS v(j), range(2) AS r(i)")
    for table in ("customer", "orders"):
        con.execute(f"COPY {table} TO '{tmp_path}/{table}.parquet' (FORMAT parquet)")
    out = queries.queries()[name](spark, str(tmp_path))
    expected = con.execute(f"SELECT {', '.join(out.columns)} FROM ({queries.oracle_sql()[name]})").fetchall()
    assert {r[:2] for r in expected} == {("set/10000.pdf", 0), ("set/10000.pdf", 1)}
    assert sorted(map(tuple, out.collect())) == sorted(expected)


def test_page_titles_of_other_letters_equal_sql(spark, tmp_path):
    import duckdb

    import __spark_entry__

    titles = ["Ç Ç Ç Ç Ç Ç", "Éau, êai. Épaè ouviourérev", "\n A title  ", "plan\x0bA; 2.5 x 3", "é mmé, wall; é5mm", "ชื่อแบบ", "a plan\rREV é", "x SCALE more", "", None]
    spark.createDataFrame([(i, t and f"<title>{t}</title>") for i, t in enumerate(titles)], "page_id long, html string").coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    expected = sorted(con.execute(__spark_entry__.oracle_sql()["page_titles"]).fetchall())
    assert sorted(map(tuple, __spark_entry__.queries()["page_titles"](spark, str(tmp_path)).collect())) == expected


def test_fast_merge_reads_each_text_once(spark):
    """The number's pattern stands for a line, a page without a number in its lines and a model's text, each once."""
    plan = queries.queries()["fast_merge"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("|MEP|") == 3


def test_five_fields_of_odd_lines(spark):
    rows = [("p", 0, 3, " ", 5), ("p", 0, 0, "  ", 4), ("p", 0, 1, "Sheet 2/9 E — 101", 4), ("p", 0, 2, "a long title ", 4), ("q", 0, 0, "x\nE", 1), ("q", 0, 1, "12 y", 1), ("r", 0, 0, None, 1)]
    lines = spark.createDataFrame(rows, "pdf_path string, page_index int, line_no int, text string, page_count int")
    out = {r.pdf_path: tuple(r)[2:] for r in classify.ocr_pages(lines).collect()}
    assert out == {"p": ("E-101", "a long title", "", "", "9"), "q": ("E\n12", "12 y", "", "", "")}
    raw = spark.createDataFrame([("p", 0, None), ("q", 0, "NOTES 3 of 4\nscale 1:5, a title")], "pdf_path string, page_index int, raw string")
    pages = classify.ocr_pages(lines, keep=("page_count",)).join(raw, ["pdf_path", "page_index"])
    merged = {r.pdf_path: tuple(r)[2:] for r in classify.fast_pages(pages, F.lit(""), merge=True).collect()}
    assert merged == {"p": ("E-101", "a long title", "", "", "9"), "q": ("E\n12", "NOTES 3 of 4", "NOTES", "1:5", "4")}
    alone = {r.pdf_path: tuple(r)[2:] for r in classify.fast_pages(pages, F.lit("")).collect()}
    assert alone == {"p": ("", "", "", "", "9"), "q": ("", "NOTES 3 of 4", "NOTES", "1:5", "4")}


def test_ties_are_settled_by_values(spark, tmp_path):
    """Rows of documents that share a path come out the same in whatever order they come in."""
    crops = [("p", 0, 0, "B-1", "x"), ("p", 0, 0, "A-1", "y"), ("p", 0, 0, "", "z")]
    boxes = [("p", 0, 0, 0.3, 0.1, 0.2, 0.2), ("p", 0, 0, 0.2, 0.1, 0.2, 0.2), ("p", 0, 1, 0.1, 0.1, 0.2, 0.2)]
    for turn in (1, -1):
        rows = spark.createDataFrame(crops[::turn], "pdf_path string, page_index int, crop_ord int, drawing_no string, title string").coalesce(1)
        assert ranking.first_hit(rows, ["pdf_path", "page_index"], "crop_ord", F.col("drawing_no") != "", ties=("drawing_no", "title")).first().drawing_no == "A-1"
        rows = spark.createDataFrame(boxes[::turn], "pdf_path string, page_index int, attempt int, x double, y double, w double, h double").coalesce(1)
        assert ranking.ladder(rows, ["pdf_path", "page_index"]).first().x == 0.2
    spark.createDataFrame([(i, k) for i, k in enumerate([12345] * 4 + [123450] * 3)], "o_orderkey long, o_custkey long").write.parquet(str(tmp_path / "orders.parquet"))
    assert queries.queries()["padded_boxes"](spark, str(tmp_path)).selectExpr("size(xs)").first()[0] == 5


def test_merged_crops_do_not_depend_on_the_order_of_rows(spark):
    """Crops of documents that share a path come out the same in whatever order they come in."""
    crops = [("p", 0, 1, "A-0", "", ""), ("p", 0, 0, "B-1", "y", ""), ("p", 0, 0, "A-1", "z", ""), ("p", 0, 0, "", "x", ""), ("q", 0, 0, "", None, "")]
    for turn in (1, -1):
        rows = spark.createDataFrame(crops[::turn], "pdf_path string, page_index int, crop_ord int, drawing_no string, title string, scale string").coalesce(1)
        merged = ranking.merge_crops(rows, ["pdf_path", "page_index"], "crop_ord", ["drawing_no", "title", "scale"]).collect()
        assert sorted(map(tuple, merged)) == [("p", 0, "A-1", "x", "", "0,0,0,1"), ("q", 0, "", "", "", "")]


#: What the SQL's order leaves open where documents share a path, settled by the key of the order.
BY_KEY = {
    "detection_ladder": (("SELECT pdf_path, page_index, CAST(a AS int)", "SELECT o_orderkey, pdf_path, page_index, CAST(a AS int)"), ("::INT, attempt)", "::INT, attempt, o_orderkey)"), ("ORDER BY attempt) = 1", "ORDER BY attempt, o_orderkey) = 1")),
    "crop_first_hit": (("SELECT pdf_path, page_index, crop_ord, coalesce(", "SELECT o_orderkey, pdf_path, page_index, crop_ord, coalesce("), ("DESC, crop_ord)", "DESC, crop_ord, o_orderkey)")),
    "padded_boxes": (("ORDER BY page_index)", "ORDER BY page_index, o_orderkey)"), ("any_value(page_count)", "min(page_count)")),
    "csv_group_lines": (("ORDER BY line_no)", "ORDER BY line_no, o_orderkey)"),),
    "rule_drawing_no": (("ORDER BY line_no)", "ORDER BY line_no, o_orderkey)"),),
    "fast_classify": (("ORDER BY line_no)", "ORDER BY line_no, o_orderkey)"), ("any_value(page_count)", "arg_min(page_count, o_orderkey)")),
    "fast_merge": (("ORDER BY line_no)", "ORDER BY line_no, o_orderkey)"), ("any_value(page_count)", "arg_min(page_count, o_orderkey)")),
}


@pytest.mark.parametrize("name", sorted(BY_KEY))
def test_shared_pages_stand_in_the_order_of_their_keys(spark, tmp_path, name):
    """Six customers share a path; the rows are those of the SQL with the order's key added to what it orders by."""
    con = duckdb.connect()
    con.execute("CREATE TABLE customer AS SELECT k AS c_custkey, 'Customer ' || k AS c_name, 'BUILDING' AS c_mktsegment FROM (VALUES (12345), (123450), (123451), (123454), (123457), (123459)) AS v(k)")
    con.execute("CREATE TABLE orders AS SELECT 1000 + i * 7919 % 997 AS o_orderkey, c_custkey AS o_custkey FROM customer, range(60) AS r(i) WHERE (i + c_custkey) % 6 = (c_custkey % 10) // 2 OR i = c_custkey % 10 QUALIFY row_number() OVER (PARTITION BY i ORDER BY c_custkey DESC) = 1")
    for table in ("customer", "orders"):
        con.execute(f"COPY {table} TO '{tmp_path}/{table}.parquet' (FORMAT parquet)")
    sql = queries.oracle_sql()[name]
    for old, new in BY_KEY[name]:
        assert old in sql
        sql = sql.replace(old, new)
    out = queries.queries()[name](spark, str(tmp_path))
    expected = con.execute(f"SELECT {', '.join(out.columns)} FROM ({sql})").fetchall()
    assert len(expected) < con.execute("SELECT count(*) FROM orders").fetchone()[0] or name.startswith("fast_")
    assert sorted((tuple(rounded(r[c]) for c in out.columns) for r in out.collect()), key=str) == sorted((tuple(map(rounded, r)) for r in expected), key=str)
