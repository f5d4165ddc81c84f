"""Operator 5: line dedup by a segment-partition edit join, in DataFrame functions only.

A line of at least ``min_chars`` characters goes if an equal line, or one within ``threshold`` edits, stands earlier in the
corpus, in order of (doc_id, line number). With ``short_copies`` a shorter line that is not blank goes if an equal line stands
earlier; other shorter lines stay. Lines are judged on the input.

1. Equal lines are folded into classes (128-bit hashes), each with its earliest place.
2. A class of length l is cut into threshold + 1 segments; of two lines within the threshold one segment of the shorter is
   in the longer unchanged, at a place that the lengths bound. Each class is indexed by the hashes of its segments and
   probes, for each length from l - threshold to l, the substrings that can match a segment of that length. Keys that only
   one class has are dropped before the join. With a threshold of one, keys of more than GROUP entries are not joined:
   their classes go by step 4, so the join grows with the entries. With a larger threshold all keys are joined.
3. Candidates are verified by the edit distance within a diagonal band of 2 * threshold + 1 cells, a bit for each cell, one
   step of bit operations a character: first over a few characters after the common prefix, which rules out most, then over
   all between the common prefix and the common suffix.
4. Lines that share such a key differ, if they are within one edit, in the part that the key does not cover. That part is cut
   into PIECES, and for each piece the key is joined by the hashes of all others: one piece stays open, as in step 2. Keys
   that only one entry has are dropped, those of up to GROUP entries are joined (steps 2 and 3), larger ones are cut again,
   until one character is open (of the longer line two): what shares a key then is within one edit, and the earliest place
   of a group is an aggregate. Entries are only cut while they share their key, so their number grows with the lines and
   the logarithm of their length, and no pairs of a large group are made.

Defined cases: null text is empty and stays null; empty and blank lines count as lines; null doc_ids come before all others,
rows with one doc_id in the order of a hash of their texts, and equal rows share their places, so their lines stay or go
together; an empty table gives no rows; other columns, whatever their names, are kept by ``dedup_lines``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import checkpointed, once, table

THRESHOLD, MIN_CHARS = 1, 20
#: Hash buckets by which lines that are in no candidate pair are left out before their text is shuffled again; the set of
#: buckets is broadcast and has this many rows at most.
BUCKETS = 1 << 18
#: Entries of a key that are joined with each other; larger keys are cut further, into so many pieces at a time.
GROUP, PIECES = 8, 4
KEY, PLACE = ("h1", "h2", "chars"), ("doc", "copy", "at")


def lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, copy, at, line, chars, h1, h2) of every line; copy tells rows with one doc_id apart."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.xxhash64(text).alias("copy"), F.posexplode(F.split(text, "\n", -1)).alias("at", "line"))
    return rows.withColumns({"chars": F.length("line"), "h1": F.xxhash64("line"), "h2": F.xxhash64(F.lit(1), "line")})


def segment(length: Column, i: int, m: int) -> tuple[Column, Column]:
    """Start (from 0) and width of segment i of m of a line with this length; the last ones take what is left over."""
    base, longer = F.floor(length / m).cast("int"), m - length % m
    return i * base + F.greatest(F.lit(0), i - longer), base + (F.lit(i) >= longer).cast("int")


def keys(threshold: int, min_chars: int) -> list[Column]:
    """struct(key, probe, segment) for each index entry (probe false) and each probe of a line."""
    line, chars = F.col("line"), F.col("chars")
    out = []

    def entry(probe: bool, length: Column, tag: int, *parts: Column) -> None:
        key = F.xxhash64(length, F.lit(tag), *parts)
        out.append(F.struct(F.when(length >= min_chars, key).alias("key"), F.lit(probe).alias("probe"), F.lit(tag).alias("segment")))

    for less in range(threshold + 1):
        length = chars - less
        for i in range(threshold + 1):
            start, width = segment(length, i, threshold + 1)
            rest = threshold - i
            for move in range(max(-i, less - rest), min(i, less + rest) + 1):
                entry(less > 0 or move != 0, length, i, F.substring(line, start + move + 1, width))
    return out


def band_distance(x: Column, y: Column, threshold: int) -> Column:
    """Edit distance of two arrays of characters if it is at most ``threshold``, otherwise something larger.

    Their lengths differ by at most ``threshold`` and are no shorter. Bit k stands for row j - threshold + k of column j.
    Vertical steps of +1 and -1 are two bit vectors; the diagonals on which nothing is added follow from one addition, and
    the band moves down one row with each column. The value at the band's lower edge is followed down its diagonal to the
    last row, then along that row.
    """
    t, width = threshold, 2 * threshold + 1
    full = (1 << width) - 1
    long = lambda n: F.lit(n).cast("long")
    same = F.transform(
        F.sequence(F.lit(0), F.size(y) - 1),
        lambda j: sum((F.when(F.get(x, j - t + k) == F.get(y, j), long(1 << k)).otherwise(long(0)) for k in range(width)), long(0)),
    )
    rows = F.size(x)

    def turn(s: Column, equal: Column) -> Column:
        plus, minus, column = s["plus"], s["minus"], s["column"]
        level = equal.bitwiseAND(plus) + plus
        level = level.bitwiseXOR(plus).bitwiseOR(equal).bitwiseOR(minus).bitwiseAND(long(full))
        left_minus = plus.bitwiseAND(level)
        left_plus = minus.bitwiseOR(plus.bitwiseOR(level).bitwiseXOR(long(full)))
        at = F.greatest(F.least(rows - column + t, F.lit(width - 1)), F.lit(0))
        bit = lambda v, k: F.call_function("shiftright", v, k).bitwiseAND(long(1)).cast("int")
        down = 1 - bit(level, F.lit(width - 1))
        along = bit(left_plus, at) - bit(left_minus, at)
        below = F.shiftright(level, 1)
        return F.struct(
            left_minus.bitwiseOR(below.bitwiseOR(left_plus).bitwiseXOR(long(full))).alias("plus"),
            below.bitwiseAND(left_plus).alias("minus"),
            (s["score"] + F.when(column + t <= rows, down).otherwise(along)).alias("score"),
            (column + 1).alias("column"),
        )

    start = F.struct(long(full ^ ((1 << t) - 1)).alias("plus"), long(0).alias("minus"), F.lit(t).alias("score"), F.lit(1).alias("column"))
    return F.aggregate(same, start, turn, lambda s: s["score"])


#: Characters after the common prefix that are compared first.
START = 12
#: Lengths by which a common prefix or suffix is found; together they exceed any string that a row can hold.
STEPS = tuple(1 << i for i in range(30, -1, -1))


def within(a: Column, b: Column, threshold: int) -> Column:
    """Whether two lines, the first no longer, are within the threshold, by the band distance.

    If they are, the band's path has cost threshold at most when it has read START characters of b, and reaches the band's
    lower edge there by 2 * threshold steps down; where the distance to that cell is larger, the rest need not be read.
    """
    longer = F.length(b)
    steps = F.array(*map(F.lit, STEPS))
    near = lambda x, y, most: once(F.split(x, ""), lambda x: once(F.split(y, ""), lambda y: band_distance(x, y, threshold) <= most))

    def common(limit: Column, start) -> Column:
        bits = F.length(F.bin(limit))  # longer steps than the limit cannot be taken
        same = lambda n, k: F.substring(a, start(a, n, k), k) == F.substring(b, start(b, n, k), k)
        return F.aggregate(F.slice(steps, len(STEPS) + 1 - bits, bits), F.lit(0), lambda n, k: n + F.when((n + k <= limit) & same(n, k), k).otherwise(0))

    def between(head: Column, tail: Column) -> Column:
        first, after = F.greatest(F.lit(0), head - threshold - 1), F.greatest(F.lit(0), tail - threshold - 1)
        rest = lambda line: F.substring(line, first + 1, F.length(line) - first - after)
        return near(rest(a), rest(b), threshold)

    def ends(head: Column) -> Column:
        first = F.greatest(F.lit(0), head - threshold - 1)
        begins = near(F.substring(a, first + 1, F.lit(START + threshold)), F.substring(b, first + 1, F.lit(START)), 3 * threshold)
        tail = once(F.length(a) - head, lambda limit: common(limit, lambda s, n, k: F.length(s) - n - k + 1))
        return F.when((longer - first < 2 * START + threshold) | begins, once(tail, lambda n: between(head, n))).otherwise(False)

    return once(once(F.length(a), lambda limit: common(limit, lambda s, n, k: n + 1)), ends)


def classes(rows: DataFrame) -> DataFrame:
    """(h1, h2, chars, line, first) of every different line; first is the struct (doc, copy, at) of its earliest place."""
    return rows.groupBy(*KEY).agg(F.min(F.struct(*PLACE)).alias("first"), F.first("line").alias("line"))


def shared_keys(rows: DataFrame, threshold: int, min_chars: int) -> DataFrame:
    """(h1, h2, chars, key, probe, segment, n) of every entry and probe whose key n > 1 of them have."""
    entries = classes(rows).select(*KEY, F.explode(F.array(*keys(threshold, min_chars))).alias("e"))
    entries = entries.select(*KEY, "e.*").filter("key IS NOT NULL")
    return entries.withColumn("n", F.count("*").over(Window.partitionBy("key"))).filter("n > 1")


def of_classes(rows: DataFrame, *hashes: DataFrame) -> DataFrame:
    """``classes`` of the rows in the buckets of these hashes (h1)."""
    bucket = lambda c: F.pmod(F.col(c), F.lit(BUCKETS))
    wanted = reduce(DataFrame.unionAll, [h.select(bucket("h1").alias("bucket")) for h in hashes]).distinct()
    return classes(rows.join(F.broadcast(wanted), bucket("h1") == F.col("bucket"), "left_semi"))


def opened(found: DataFrame) -> DataFrame:
    """(h1, h2, chars, first, probe, key, key2, open) of entries (h1, h2, chars, key, probe, segment, line, first) at a threshold of one.

    open is the part that the key does not cover, one character longer in a probe; key2 is a second hash of what it covers.
    """
    more = F.col("probe").cast("int")
    half = F.floor((F.col("chars") - more) / 2).cast("int")
    head = F.col("segment") == 0
    rest = F.when(head, F.substring("line", half + 1, F.col("chars"))).otherwise(F.substring("line", F.lit(1), half + more))
    covered = F.when(head, F.substring("line", F.lit(1), half)).otherwise(F.substring("line", half + more + 1, F.col("chars")))
    return found.select(*KEY, "first", "probe", "key", F.xxhash64(F.lit(1), covered).alias("key2"), rest.alias("open"))


def cut(rows: DataFrame) -> DataFrame:
    """``opened`` rows whose keys cover all pieces of the open part but one, of keys that an entry and another line have; n counts the key's rows."""
    more = F.col("probe").cast("int")
    width = F.length("open") - more
    edge = lambda i: F.floor(width * i / PIECES).cast("int")

    def piece(i: int) -> Column:
        start, end = edge(i), edge(i + 1)
        covered = (F.lit(i), F.substring("open", F.lit(1), start), F.substring("open", end + more + 1, width - end))
        child = F.struct(F.xxhash64("key", *covered).alias("key"), F.xxhash64("key2", *covered).alias("key2"), F.substring("open", start + 1, end - start + more).alias("open"))
        return F.when(end > start, child)

    parts = rows.select(*KEY, "first", "probe", F.explode(F.filter(F.array(*map(piece, range(PIECES))), lambda x: x.isNotNull())).alias("p")).select(*KEY, "first", "probe", "p.*")
    same = Window.partitionBy("key", "key2")
    counted = parts.withColumns({"n": F.count("*").over(same), "entries": F.count_if(~F.col("probe")).over(same)})
    return counted.filter("n > 1 AND entries > 0").drop("entries")


def near_places(rows: DataFrame) -> DataFrame:
    """(h1, h2, chars, place) of ``cut`` rows with one open character: the earliest place in their groups of a line within one edit."""
    chars = F.when(F.col("probe"), F.array_distinct(F.split("open", "", 2))).otherwise(F.array("open"))
    each = rows.select(*KEY, "first", "probe", "key", "key2", F.explode(chars).alias("c"))
    least = lambda probe, *of: F.min(F.when(F.col("probe") == probe, F.col("first"))).over(Window.partitionBy("key", "key2", *of))
    place = F.when(F.col("probe"), least(False, "c")).otherwise(F.least(least(False), least(True, "c")))
    return each.select(*KEY, place.alias("place")).filter("place IS NOT NULL").groupBy(*KEY).agg(F.min("place").alias("place"))


def divided(rows: DataFrame, large: DataFrame) -> tuple[list[DataFrame], list[DataFrame]]:
    """(entries to join, ``near_places``) of the entries (h1, h2, chars, key, probe, segment) of large keys."""
    few, places = [], []
    left = checkpointed(opened(of_classes(rows, large).join(large, list(KEY))))
    while not left.isEmpty():
        parts = checkpointed(cut(left))
        few.append(parts.filter(F.col("n") <= GROUP).select(*KEY, "key", "probe"))
        many = parts.filter(F.col("n") > GROUP).drop("n")
        last = F.length("open") - F.col("probe").cast("int") == 1
        places.append(near_places(many.filter(last)))
        left = many.filter(~last)
    return few, places


def near_pairs(rows: DataFrame, shared: DataFrame, threshold: int) -> DataFrame:
    """(a_*, b_*) of every two classes that share a key and are within the threshold, each pair once, a being the shorter or smaller."""
    a = shared.filter("NOT probe").select("key", *(F.col(k).alias(f"a_{k}") for k in KEY))
    b = shared.select("key", "probe", *(F.col(k).alias(f"b_{k}") for k in KEY))
    order = F.expr("b_chars > a_chars OR (b_chars = a_chars AND (b_h1, b_h2) > (a_h1, a_h2))") if threshold < 2 else F.expr("b_chars > a_chars OR (b_chars = a_chars AND (probe OR (b_h1, b_h2) > (a_h1, a_h2)) AND NOT (a_h1 = b_h1 AND a_h2 = b_h2))")
    pairs = a.join(b, "key").filter(order).filter(F.expr(f"b_chars - a_chars <= {threshold}"))
    pairs = checkpointed(pairs.select(*(f"{s}_{k}" for s in "ab" for k in KEY)).distinct())
    found = of_classes(rows, *(pairs.select(F.col(f"{s}_h1").alias("h1")) for s in "ab"))
    for s in "ab":
        side = found.select(*(F.col(k).alias(f"{s}_{k}") for k in KEY), F.col("line").alias(f"{s}_line"), F.col("first").alias(f"{s}_first"))
        pairs = pairs.join(side, [f"{s}_{k}" for k in KEY])
    return pairs.filter(within(F.col("a_line"), F.col("b_line"), threshold)).drop("a_line", "b_line")


def judged(min_chars: int, short_copies: bool) -> Column:
    """Whether a line can go at all."""
    long_enough = F.col("chars") >= min_chars
    return long_enough | F.col("line").rlike(r"\S") if short_copies else long_enough


def earliest(rows: DataFrame, threshold: int, min_chars: int, short_copies: bool) -> DataFrame:
    """(h1, h2, chars, earliest): the earliest place of every class or of one within the threshold."""
    own = classes(rows.filter(judged(min_chars, short_copies))).select(*KEY, F.col("first").alias("place"))
    if threshold > 0:
        judged_near = rows.filter(F.col("chars") >= min_chars)
        shared = checkpointed(shared_keys(judged_near, threshold, min_chars))
        few = F.col("n") <= GROUP if threshold == 1 else F.lit(True)
        small, places = divided(judged_near, shared.filter(~few).drop("n")) if threshold == 1 else ([], [])
        small = reduce(DataFrame.unionAll, small, shared.filter(few).select(*KEY, "key", "probe"))
        pairs = checkpointed(near_pairs(judged_near, small, threshold))
        for s, o in ("ab", "ba"):
            own = own.unionAll(pairs.select(*(F.col(f"{s}_{k}").alias(k) for k in KEY), F.col(f"{o}_first").alias("place")))
        own = reduce(DataFrame.unionAll, places, own)
    return own.groupBy(*KEY).agg(F.min("place").alias("earliest"))


def gone(docs: DataFrame, threshold: int, min_chars: int, id_col: str, text_col: str, short_copies: bool) -> DataFrame:
    """(doc, copy, at, earliest) of every line to remove."""
    rows = lines(docs, id_col, text_col)
    places = rows.filter(judged(min_chars, short_copies)).select(*PLACE, *KEY)
    return places.join(earliest(rows, threshold, min_chars, short_copies), list(KEY)).filter(F.col("earliest") < F.struct(*PLACE)).select(*PLACE, "earliest")


def removed_lines(docs: DataFrame, threshold: int = THRESHOLD, min_chars: int = MIN_CHARS, id_col: str = "doc_id", text_col: str = "text", short_copies: bool = False) -> DataFrame:
    """(doc_id, line_no, first_doc, first_line) of every line to remove, with the earliest line that it repeats."""
    found = gone(docs, threshold, min_chars, id_col, text_col, short_copies)
    return found.select(F.col("doc").alias("doc_id"), F.col("at").alias("line_no"), F.col("earliest.doc").alias("first_doc"), F.col("earliest.at").alias("first_line"))


def dedup_lines(docs: DataFrame, threshold: int = THRESHOLD, min_chars: int = MIN_CHARS, id_col: str = "doc_id", text_col: str = "text", short_copies: bool = False) -> DataFrame:
    """``docs`` with all its columns, the text without its removed lines; documents without any keep their text as it is."""
    found = gone(docs, threshold, min_chars, id_col, text_col, short_copies).groupBy("doc", "copy").agg(F.collect_set("at").alias("gone"))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col(id_col).cast("long").alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("hash"))
    rows = rows.join(found, F.col("id").eqNullSafe(F.col("doc")) & (F.col("hash") == F.col("copy")), "left")
    text = F.col("row").getField(text_col)
    kept = once(F.split(text, "\n", -1), lambda x: F.transform(F.array_except(F.sequence(F.lit(0), F.size(x) - 1), F.col("gone")), lambda i: F.get(x, i)))
    fresh = F.when(F.col("gone").isNull(), text).otherwise(F.array_join(kept, "\n"))
    return rows.select(*(fresh.alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5_line_dedup: every line of documents that repeats an earlier one, exactly or, from MIN_CHARS on, within one edit."""
    return removed_lines(table(spark, sf_dir, "documents"), short_copies=True)
