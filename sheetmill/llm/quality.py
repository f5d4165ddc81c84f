"""Operator 10: quality rules as a short-circuit cascade, in DataFrame functions only.

Each rule is a condition that rejects a text and the counts it needs. On a bounded sample the operator measures each rule's
cost (wall time of its counts over the sample, less that of reading it) and selectivity (share rejected), and orders the
rules by rejection per cost. The cascade is one expression in that order, each rule's counts made inside its branch, which
Spark evaluates lazily: in ``screen`` a text rejected by an early rule never pays for a later one. ``cascade`` also returns
all counts and so pays for them. The order decides only the cost and which reason is named, never the verdict, which is the
same for every order.

Words are the runs of characters other than space and 9 to 13. A repeated word is one in any window of eight words that
the text holds twice or more, the first included. Windows are compared by 64-bit hashes of their words.

Defined cases: null or empty text has no words and fails the rule on few words; texts under eight words have no window;
rows are independent, so ties, repeated rows and empty tables need no rule; other columns are ignored.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import doc_text, once, table

SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
#: Rows of the sample on which costs and selectivities are measured.
SAMPLE_ROWS = 2000


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, SPACES[1:], " " * (len(SPACES) - 1)), " ", -1), "")


def repeated_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.translate(x, SPACES, "") != "")
    return once(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def repeated_words(text: Column) -> Column:
    """Words in windows that occur twice.

    Window hashes are built from word hashes by three doublings (1, 2, 4, 8 words), and only texts in which a hash occurs
    twice are sorted.
    """

    def doubled(h: Column, span: int) -> Column:
        left = lambda x: F.greatest(F.size(x) - span, F.lit(0))
        return once(h, lambda x: F.zip_with(F.slice(x, F.lit(1), left(x)), F.slice(x, F.lit(1 + span), left(x)), lambda a, b: F.xxhash64(a, b)))

    def covered(h: Column) -> Column:
        same = lambda at, e, i, step: F.coalesce(F.get(at, i + step).getField("x") == e.getField("x"), F.lit(False))
        sorted_ = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
        twice = once(sorted_, lambda at: F.transform(F.filter(at, lambda e, i: same(at, e, i, -1) | same(at, e, i, 1)), lambda e: e.getField("i")))
        start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
        step = lambda s, i: F.struct((s["n"] + i + WINDOW - F.greatest(i, s["end"])).alias("n"), (i + WINDOW).alias("end"))
        return F.aggregate(F.sort_array(twice), start, step, lambda s: s["n"])

    h = F.transform(words(text), lambda w: F.xxhash64(w))
    for span in (1, 2, 4):
        h = doubled(h, span)
    return once(h, lambda x: F.when(F.size(F.array_distinct(x)) < F.size(x), covered(x)).otherwise(0))


#: What rules can look at, each made from the text alone.
MEASURES: dict[str, Callable[[Column], Column]] = {
    "n_words": lambda text: F.size(words(text)),
    "word_chars": lambda text: F.length(F.translate(text, SPACES, "")),
    "n_symbols": lambda text: F.length(text) - F.length(F.translate(text, SYMBOLS, "")),
    "n_dup_lines": repeated_lines,
    "n_repeat_words": repeated_words,
}


def measures(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of every whole text."""
    return doc_text(df, id_col, text_col).select("doc_id", *(make(F.col("text")).cast("long").alias(n) for n, make in MEASURES.items()))


@dataclass(frozen=True)
class Rule:
    """A condition that rejects a text, over the measures that it names."""

    name: str
    needs: tuple[str, ...]
    condition: Callable[..., Column]

    def rejects(self, measure: Callable[[str], Column]) -> Column:
        return self.condition(*map(measure, self.needs))


def of_text(text: Column) -> Callable[[str], Column]:
    """Measures made anew from the text, where and if they are needed."""
    return lambda name: MEASURES[name](text).cast("long")


BASE = (
    Rule("few words", ("n_words",), lambda n: n < 20),
    Rule("repeated windows", ("n_repeat_words", "n_words"), lambda r, n: 100 * r > 30 * n),
)
#: Bounds far from ordinary prose: words of 2 to 20 characters on average, a symbol for at most every third word, and half
#: of the lines may repeat.
RULES = (
    *BASE,
    Rule("word length", ("n_words", "word_chars"), lambda n, c: (c < 2 * n) | (c > 20 * n)),
    Rule("symbols", ("n_words", "n_symbols"), lambda n, s: 3 * s > n),
    Rule("repeated lines", ("n_dup_lines", "n_words"), lambda d, n: 10 * d > n),
)


def estimates(df: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text") -> list[tuple[Rule, float, float]]:
    """(rule, seconds, share rejected) of each rule on a sample of about ``sample_rows`` rows drawn over the whole table."""
    total = df.count()
    if not total:
        return [(r, 0.0, 0.0) for r in rules]
    drawn = doc_text(df, id_col, text_col).sample(min(1.0, sample_rows / total), seed=10).cache()
    drawn.count()
    took, share = {}, {}
    for _ in range(2):  # the second time without compiling
        start = time.perf_counter()
        drawn.agg(F.sum(F.length("text"))).collect()
        read = time.perf_counter() - start
        for r in rules:
            start = time.perf_counter()
            share[r.name] = drawn.agg(F.avg(r.rejects(of_text(F.col("text"))).cast("int"))).first()[0] or 0.0
            took[r.name] = max(time.perf_counter() - start - read, 1e-3)
    drawn.unpersist()
    return [(r, took[r.name], share[r.name]) for r in rules]


def ordered(measured: list[tuple[Rule, float, float]]) -> list[Rule]:
    """Rules by share rejected per second, the best first."""
    return [r for r, cost, share in sorted(measured, key=lambda x: (-x[2] / x[1] if x[1] else 0.0, x[1], x[0].name))]


def verdict(rules: list[Rule], measure: Callable[[str], Column]) -> Column:
    """The name of the first rule that rejects, null for a text that is kept. Rules after it are not evaluated."""
    return F.coalesce(*(F.when(r.rejects(measure), r.name) for r in rules), F.lit(None).cast("string"))


def screen(df: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df``, with all their columns, that no rule rejects: each text pays for rules up to the first that does."""
    order = ordered(estimates(df, rules, sample_rows, id_col, text_col))
    return df.filter(verdict(order, of_text(F.coalesce(F.col(text_col), F.lit("")))).isNull())


def cascade(df: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All measures of every text with reason (null if kept) and kept, the rules in the order of the estimates.

    As the measures are asked for, they are paid for; ``screen`` gives the verdict alone.
    """
    order = ordered(estimates(df, rules, sample_rows, id_col, text_col))
    return measures(df, id_col, text_col).withColumn("reason", verdict(order, F.col)).withColumn("kept", F.col("reason").isNull())


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op10_quality_rules: every document's counts and verdict."""
    few, repeats = (r.rejects(F.col) for r in BASE)
    judged = cascade(table(spark, sf_dir, "documents")).withColumn("base_failed", few | repeats)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, regexp_split_to_array(text, chr(10)) AS lines FROM d),
v AS (SELECT doc_id, i, list_aggregate(words[i:i + 7], 'string_agg', ' ') AS win
      FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM w WHERE len(words) >= 8)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM v) WHERE n > 1),
g AS (SELECT doc_id, least(8, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 8)) AS n FROM r),
p AS (SELECT doc_id, sum(n) AS n FROM g GROUP BY doc_id),
m AS (SELECT w.doc_id, len(words)::BIGINT AS n_words,
    coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    (len(list_filter(lines, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))) - len(list_distinct(list_filter(lines, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))))::BIGINT AS n_dup_lines,
    coalesce(p.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN p ON w.doc_id = p.doc_id)
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words OR word_chars < 2 * n_words OR word_chars > 20 * n_words
       OR 3 * n_symbols > n_words OR 10 * n_dup_lines > n_words) AS kept
FROM m
"""
