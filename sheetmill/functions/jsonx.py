"""JSON from models: relaxed parsing of objects that stand in fences or in other text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .geometry import clamp_share
from .text import filled, strip

FENCED = r"(?is)```json\s*(\{.*?\})\s*```"
FENCED_ANY = r"(?is)```\w*\s*(\{.*?\})\s*```"
BRACES = r"(?s)\{.*\}"
FIRST_BRACES = r"(?s)\{.*?\}"


def strict(text: Column) -> Column:
    """The text if the whole of it is one JSON object, else null.

    The parser alone would accept text after the object; in a list of one, such text is an error or a second element.
    """
    listed = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    one = F.try_variant_get(listed, "$[0]", "variant").isNotNull() & F.try_variant_get(listed, "$[1]", "variant").isNull()
    return F.when(strip(text).startswith("{") & one, text)


def relaxed(text: Column) -> Column:
    """The object of a model's answer as JSON text; ``{}`` if there is none."""
    raw = strip(F.coalesce(text, F.lit("")))
    found = [raw, *(F.regexp_extract(raw, p, i) for p, i in ((FENCED, 1), (FENCED_ANY, 1), (BRACES, 0)))]
    return F.coalesce(*(strict(filled(c)) for c in found), F.lit("{}"))


def relaxed_first(text: Column) -> Column:
    """As ``relaxed``, but of unfenced text only the shortest first braces are tried, which breaks nested objects."""
    raw = strip(F.coalesce(text, F.lit("")))
    return F.coalesce(strict(filled(F.regexp_extract(raw, FENCED, 1))), strict(filled(F.regexp_extract(raw, FIRST_BRACES, 0))), F.lit("{}"))


def value(json: Column, path: str) -> Column:
    """A field as stripped text; missing, null, 0, false and [] are empty."""
    return truthy(F.get_json_object(json, path))


def box(text: Column) -> Column:
    """The clamped ``bbox`` of an answer; null without one, or where it has no width or height."""
    raw = F.from_json(filled(F.regexp_extract(F.coalesce(text, F.lit("")), BRACES, 0)), "bbox struct<x:double,y:double,w:double,h:double>")["bbox"]
    part = clamp_share(*(F.coalesce(raw[n], F.lit(0.0)) for n in "xywh"))
    return F.when(raw.isNotNull() & (part["w"] > 0) & (part["h"] > 0), F.struct(*(part[n].alias(n) for n in "xywh")))


RECORD = ("drawing_no", "sheet_name", "drawing_title", "project", "discipline", "revision", "scale", "date")


def fields(object_: Column, names: tuple[str, ...], kind: str | None = None) -> list[Column]:
    """Fields of a JSON object as stripped texts, parsed once; missing, null, 0, false and [] are empty.

    ``object_`` has to be a column of the rows, not an expression, or it is made anew for each field.
    """
    parsed = F.from_json(object_, kind or ", ".join(f"`{n}` string" for n in names))
    return [truthy(parsed[n]).alias(n) for n in names]


def truthy(found: Column) -> Column:
    found = strip(F.coalesce(found, F.lit("")))
    return F.when(found.isin("0", "false", "[]", "{}", "null"), "").otherwise(found)


def record_or_default(text: Column, object_: Column, error: str) -> list[Column]:
    """The record's fields, all empty where an answer holds no object, and ``_error``: what went wrong, null if nothing did."""
    return [*fields(object_, RECORD), F.when((object_ == "{}") & ~strip(F.coalesce(text, F.lit(""))).startswith("{}"), error).alias("_error")]
