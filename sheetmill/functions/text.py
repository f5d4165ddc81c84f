"""String functions and field extractors. Missing text is the empty string, as in the records they serve.

Patterns carry ``(?U)``, which makes classes and boundaries Unicode-aware; word boundaries next to combining marks are
written as look-arounds on letters, digits and underscores.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns of drawing numbers, scales, dates and page counts.
GUARDED_NUMBER = r"(?iU)(?<![A-Z0-9])(?:A|S|E|SN)\s*\d{1,2}\s*-\s*\d{2}(?![A-Z0-9])"
CONSUMING_NUMBER = r"(?i)(^|[^A-Z0-9])((?:A|S|E|SN)[0-9]{1,2})\s*-\s*([0-9]{2})([^0-9A-Z]|$)"
MODEL_NUMBER = r"(?iU)(?<![A-Z0-9])(?:AR|SN|A|S|E)\s*\d{1,3}(?:\s*-\s*\d{2,3})?(?![A-Z0-9])"
FAST_NUMBER = r"(?iU)(?<![A-Z0-9])(?:AR|SN|A|S|E|M|P|MEP|T|C|ID)\s*-?\s*\d{1,4}(?:\s*-\s*\d{1,4})?(?![A-Z0-9])"
TOKEN_NUMBERS = (
    r"(?iU)\b[A-Z]{1,4}-?\d{1,3}(?:-\d{1,3})?\b",
    r"(?iU)\b[SWMAPCRLETBHIV]{1,4}-?\d{2,4}\b",
    r"(?iU)\b[A-Z]{1,4}\d{1,3}(?:-\d{1,3})?\b",
)
EDGE_LEFT, EDGE_RIGHT = r"(?<![\p{L}\p{N}_])", r"(?![\p{L}\p{N}_])"
RULE_NUMBER = rf"(?U){EDGE_LEFT}([A-Z]{{1,4}}[-_ ]?\d{{1,4}}[A-Z0-9]?){EDGE_RIGHT}"
SCALE = rf"(?U){EDGE_LEFT}(1\s*[:：]\s*\d{{1,4}}){EDGE_RIGHT}"
DATE = rf"(?U){EDGE_LEFT}(\d{{1,2}})[/\-](\d{{1,2}})[/\-](\d{{2,4}}){EDGE_RIGHT}"
REVISION = rf"(?U){EDGE_LEFT}([A-Z]?\d{{1,2}}){EDGE_RIGHT}"
PAGE_OF = rf"(?U){EDGE_LEFT}(\d{{1,3}})\s*(?:OF|of)\s*(\d{{1,4}}){EDGE_RIGHT}"
PAGE_SLASH = rf"(?U){EDGE_LEFT}(\d{{1,3}})\s*/\s*(\d{{1,4}}){EDGE_RIGHT}"
PAGE_TOTAL = r"(?iU)TOTAL\s+PAGES?\s*(\d{1,4})\s*/\s*(\d{1,4})"
PAGE_LONE = rf"(?U){EDGE_LEFT}(\d{{1,4}}){EDGE_RIGHT}"
MODEL_SCALE = r"(?iU)\bSCALE\b\s*[:\-]?\s*(\d+\s*:\s*\d+)"
ANY_SCALE = r"(?U)\b(\d+\s*:\s*\d+)\b"
TITLE_TAIL = r"(?iU)\b(TOTAL\s+PAGES?|SHEET\s*NO\.?|SHEET:?|PAGE\s*NO\.?|PAGE:?|SCALE|REV(?:ISION)?|DATE|PROJECT)\b.*"
SPECIFICATION = r"(?iU)(\bRB\d|Ø\d|D\d|dia\b|@\s?\d|\bmm\b|\bkg\b|\bm\.?\b|\d+\.\d+|\d+\s*[xX]\s*\d+)"
NO_SCALE = r"(?iU)\b(NOT\s*TO\s*SCALE|NTS)\b"
CAPTION = r"(?iU)\b(picture|image|photo)\b"
# Keywords that mark lines, in the order in which they are tried.
ANCHORS = ("DRAWING", "TITLE", "SCALE", "DATE", "PROJECT", "REV", "DWG")
ANCHORS_THAI = ("เลขที่แบบ", "ชื่อแบบ", "หัวข้อ", "มาตราส่วน", "วันที่", "โครงการ", "แก้ไข")
SHEET_TYPES = (("PLAN", ("PLAN", "แปลน")), ("SECTION", ("SECTION", "รูปตัด")), ("ELEVATION", ("ELEVATION", "รูปด้าน")), ("DETAIL", ("DETAIL", "รายละเอียด")))
MORE_SHEET_TYPES = (*SHEET_TYPES, ("LAYOUT", ("LAYOUT", "LAY-OUT")), ("SCHEDULE", ("SCHEDULE",)), ("NOTES", ("NOTES",)))
DISCIPLINES = ("STRUCTURAL", "ARCHITECTURAL", "ELECTRICAL", "MECHANICAL", "PLUMBING")
DISCIPLINE_LETTERS = (("A", "ARCHITECTURAL"), ("S", "STRUCTURAL"), ("E", "ELECTRICAL"), ("M", "MECHANICAL"), ("P", "PLUMBING"), ("T", "TELECOM"))
TITLE_WORDS = ("TITLE", "ชื่อแบบ", "หัวข้อ")
TITLE_STOPS = ("DRAWING", "DWG", "DRG", "SCALE", "DATE", "PROJECT", "REV", "SHEET")
TITLE_STOPS_THAI = ("เลขที่แบบ", "ชื่อแบบ", "หัวข้อ")
NUMBER_MARKS = ("DRAWING", "DWG", "DRG", "SHEET", "NO")
NUMBER_MARKS_THAI = ("เลขที่แบบ", "เลขที่")
PAGE_MARKS = ("SHEET", "PAGE")
PAGE_MARKS_THAI = ("หน้าที่", "แผ่นที่")


def strip(c: Column) -> Column:
    """Without white space of any script at the ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def filled(c: Column) -> Column:
    """Null for an empty string."""
    return F.nullif(c, F.lit(""))


def first_of(*columns: Column) -> Column:
    """The first that is neither null nor empty, else empty."""
    return F.coalesce(*(filled(c) for c in columns), F.lit(""))


def contains_any(c: Column, words: tuple[str, ...], exact: tuple[str, ...] = ()) -> Column:
    """Holds one of the words in any case, or one of the exact ones."""
    upper = F.upper(c)
    out = F.lit(False)
    for w in words:
        out = out | F.contains(upper, F.lit(w))
    for w in exact:
        out = out | F.contains(c, F.lit(w))
    return out


def collapse_hyphen(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)\s*-\s*", "-")


def plain_hyphen(c: Column, underscore: bool = True) -> Column:
    return F.translate(c, "—–_" if underscore else "—–", "---" if underscore else "--")


def normalize_token(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, "[‐‑‒–—−]", "-"), r"(?U)\s+", "")


def normalize_text(c: Column) -> Column:
    out = F.regexp_replace(F.translate(c, "\r", "\n"), r"[\t\x0b\f]+", " ")
    return strip(F.regexp_replace(F.regexp_replace(out, "\n+", "\n"), " +", " "))


def all_matches(c: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(c, F.lit(pattern), group)


def guarded_numbers(c: Column) -> Column:
    """All drawing numbers between non-alphanumerics, in order, each once; case and inner spaces stay."""
    return F.array_distinct(F.transform(all_matches(c, GUARDED_NUMBER), lambda x: collapse_hyphen(strip(x))))


def consuming_numbers(c: Column) -> Column:
    """As above with the delimiters consumed, so of codes one character apart every second one is lost; upper case."""
    pair = F.zip_with(all_matches(c, CONSUMING_NUMBER, 2), all_matches(c, CONSUMING_NUMBER, 3), lambda a, b: F.upper(F.concat(a, F.lit("-"), b)))
    return F.array_distinct(pair)


def model_numbers(raw: Column, candidates: Column) -> Column:
    """The model's own candidates, then numbers found in its text that are not among them."""
    own = F.filter(F.transform(F.coalesce(candidates, F.array().cast("array<string>")), strip), lambda x: x != "")
    found = F.transform(all_matches(raw, MODEL_NUMBER), lambda x: collapse_hyphen(strip(x)))
    return F.concat(own, F.array_except(found, own))


def fast_number(c: Column) -> Column:
    return collapse_hyphen(F.regexp_extract(c, FAST_NUMBER, 0))


def is_token_number(c: Column, own: str | None = None) -> Column:
    """Whether a token holds a drawing number: by the caller's pattern first, then by the built-in ones."""
    out = F.lit(False)
    for p in ([f"(?i){own}"] if own else []) + [*TOKEN_NUMBERS]:
        out = out | c.rlike(p)
    return out


def longest(items: Column) -> Column:
    """The longest string of an array, the first on ties; null if there is none."""
    return F.aggregate(items, F.lit(None).cast("string"), lambda best, x: F.when(best.isNull() | (F.length(x) > F.length(best)), x).otherwise(best))


def clean_title(c: Column, ascii_classes: bool = False) -> Column:
    """A title without trailing metadata and material notes; empty if too little is left.

    With ``ascii_classes`` words, digits and white space are RE2's, so those of ASCII, and only spaces go at the ends.
    """
    trim = (lambda x: F.regexp_replace(x, r"^\p{Zs}+|\p{Zs}+$", "")) if ascii_classes else strip
    of = as_re2 if ascii_classes else str
    t = trim(F.regexp_replace(trim(F.coalesce(c, F.lit(""))), of(TITLE_TAIL), ""))
    parts = F.filter(F.transform(F.split(t, "[,;\n]"), trim), lambda x: x != "")
    keep = F.filter(parts, lambda x: ~x.rlike(of(SPECIFICATION)))
    t = F.when(F.size(parts) > 1, F.coalesce(longest(keep), F.get(parts, 0))).otherwise(t)
    t = F.regexp_replace(t, of(r"(?U)\s+"), " ")
    return F.when((F.length(t) < 4) | t.rlike(of(r"(?U)^[\W_]+$")), "").otherwise(t)


def as_re2(pattern: str) -> str:
    """The pattern as RE2 reads it: classes and word ends of ASCII alone, a dot for all but a line feed."""
    word = "[0-9A-Za-z_]"
    pattern = pattern.replace("(?iU)", "(?iud)").replace("(?U)", "(?d)").replace(r"[\W_]", "[^0-9A-Za-z]")
    return pattern.replace(r"\b", f"(?:(?<={word})(?!{word})|(?<!{word})(?={word}))").replace(r"\s", r"[\t\n\f\r ]").replace(r"\d", "[0-9]")


def normalize_scale(c: Column) -> Column:
    t = strip(F.coalesce(c, F.lit("")))
    bare = F.regexp_replace(F.regexp_replace(t, r"(?U)\s*/\s*", ":"), r"(?U)\s+", "")
    part = lambda i: F.regexp_extract(bare, r"^(\d{1,3}):(\d{1,4})$", i)
    both = F.concat_ws(":", part(1).try_cast("int").cast("string"), part(2).try_cast("int").cast("string"))
    return F.when(t.rlike(NO_SCALE) | (part(1) == ""), "").otherwise(both)


def scale_of(c: Column) -> Column:
    return F.replace(F.regexp_extract(c, SCALE, 1), F.lit(" "), F.lit(""))


def model_scale(c: Column) -> Column:
    return first_of(F.regexp_extract(c, MODEL_SCALE, 1), F.regexp_extract(c, ANY_SCALE, 1))


def page_of_total(raw: Column, page_index: Column, page_count: Column) -> Column:
    """current/total from a page note, filled up with the page's place in its document."""
    raw = strip(F.coalesce(raw, F.lit("")))
    current = (page_index + 1).cast("string")
    pair = lambda p: F.when(raw.rlike(p), F.concat(F.regexp_extract(raw, p, 1), F.lit("/"), F.regexp_extract(raw, p, 2)))
    lone = F.concat(current, F.lit("/"), filled(F.regexp_extract(raw, PAGE_LONE, 1)))
    return F.coalesce(pair(PAGE_OF), pair(PAGE_SLASH), pair(PAGE_TOTAL), lone, F.concat(current, F.lit("/"), page_count.cast("string")))


def page_pair(raw: Column, i: int) -> Column:
    """Part i (1 current, 2 total) of n/m, else of SHEET n OF m."""
    slash = rf"(?U){EDGE_LEFT}(\d{{1,3}})\s*/\s*(\d{{1,3}}){EDGE_RIGHT}"
    words = r"(?iU)\bSHEET\s*(\d{1,3})\s*OF\s*(\d{1,3})\b"
    return first_of(F.regexp_extract(raw, slash, i), F.regexp_extract(raw, words, i))


def sheet_type(c: Column, types=SHEET_TYPES) -> Column:
    out = F.when(F.lit(False), "")
    for name, words in types:
        out = out.when(contains_any(c, words), name)
    return out.otherwise("")


def cleanup_model_text(c: Column) -> Column:
    """One line without code fences; empty for a caption of a picture."""
    t = strip(F.coalesce(c, F.lit("")))
    t = F.regexp_replace(strip(F.regexp_replace(t, "^```[a-zA-Z]*\n|```$", "")), r"(?U)\s+", " ")
    return F.when(t.rlike(CAPTION), "").otherwise(t)


def letter_id(n: Column) -> Column:
    """A to Z, AA to ZZ, AAA ... for 0, 1, 2 ... up to the largest number."""
    start = F.struct((n + 1).cast("long").alias("n"), F.lit("").alias("id"))

    def put(s: Column, _: Column) -> Column:
        rest = (s["n"] - 1).cast("long")
        letter = F.char((F.lit(65) + rest % 26).cast("int"))
        return F.struct(F.when(s["n"] > 0, F.floor(rest / 26).cast("long")).otherwise(s["n"]).alias("n"), F.when(s["n"] > 0, F.concat(letter, s["id"])).otherwise(s["id"]).alias("id"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(14)), start, put, lambda s: s["id"])


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, "[^/]+$", 0)


def stem(path: Column) -> Column:
    """The base name without its last suffix; a leading dot is part of the name."""
    return F.regexp_replace(base_name(path), r"(?<=.)\.[^.]*$", "")


#: Fixed value: characters of text in a prompt.
PROMPT_CHARS = 4000


def text_prompt(text: Column) -> Column:
    """The user prompt of a text model."""
    return F.concat(F.lit("OCR TEXT:\n"), F.substring(F.coalesce(text, F.lit("")), 1, PROMPT_CHARS))


def derived_path(path: Column, page: Column, drawing: Column, prefix: str = "page") -> Column:
    """The path, then a space and what is known of page and drawing; unchanged if nothing is."""
    page, drawing = strip(F.coalesce(page, F.lit(""))), strip(F.coalesce(drawing, F.lit("")))
    suffix = F.concat_ws("_", F.when(page != "", F.concat(F.lit(prefix), F.translate(page, "/", "_"))), filled(drawing))
    return F.when(suffix == "", path).otherwise(F.concat(path, F.lit(" "), suffix))


def gregorian(day: Column, month: Column, year: Column) -> Column:
    """ISO date of a day, month and Gregorian, Buddhist or two-digit year; DD/MM/year where no such day exists."""
    year = F.when(year >= 2400, year - 543).otherwise(year)
    year = F.when(year < 100, F.when(year >= 70, year + 1900).otherwise(year + 2000)).otherwise(year)
    pad = lambda c, n: F.lpad(c.cast("string"), n, "0")
    iso = F.concat(F.lpad(year.cast("string"), 4, "0"), F.lit("-"), pad(month, 2), F.lit("-"), pad(day, 2))
    return F.when(F.try_to_date(iso, "yyyy-MM-dd").isNotNull(), iso).otherwise(F.concat(pad(day, 2), F.lit("/"), pad(month, 2), F.lit("/"), year.cast("string")))


def date_of(c: Column) -> Column:
    """The first date of a text, null if it has none."""
    part = lambda i: F.regexp_extract(c, DATE, i).try_cast("int")
    return F.when(c.rlike(DATE), gregorian(part(1), part(2), part(3)))
