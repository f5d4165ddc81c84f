"""Operator 8: toxicity by two class-conditional Kneser-Ney models over the letters of words.

Words are the white-space separated parts of a text, A-Z lower-cased, without punctuation at their ends. A word is read as
its characters and an end mark after five start marks; x is the next character and h the five before it. For class c

    P_c(x | h) = (max(n_c(h x) - D, 0) + (M + D * N_c(h .)) * P(x | h)) / (n_c(h) + M)
    P(x | h) = max(n(h x) - D, 0) / n(h) + D * N(h .) / n(h) * S(x | h without its first character)

where n_c counts the class's words, n both classes' words, and N(h .) the different characters seen after h. P and S are the
backoff that both classes share: S is Kneser-Ney's, which depends on how many different characters precede an expression and
not on how often, down to single characters. M observations' worth of the shared backoff stand in each class's model, so the
two probabilities of a rare expression are almost the same, and those of one after an unseen h are. Stems and inflections
are thus learnt, not only whole words.

The score compares the two log-likelihoods of a text per word. Of most words they differ by noise that adds up in long
texts, so words whose own log-likelihoods differ by no more than a margin count as words without evidence. The margin (0
among them: the plain comparison) and the logistic curve that turns the difference into a probability are fitted on labelled
rows that the counts did not see.

The counts cover every labelled row outside the held-out fold but the quarter for the curve, and grow with them; they are
aggregated, smoothed and compared in Spark. The driver and the workers get the model alone: the differences of all expressions
and starts by their hashes, in broadcast parts of at most ``SLOTS``. A worker with more than one part reads them one after
another, once for the unknown words of TEXT_CHARS characters of texts, so what it holds, 12 * SLOTS bytes at a time, does not
depend on the input. The curve sees at most ``rows_per_class`` rows of each class, those with the smallest hash of doc_id.
All documents are scored, whole.

Defined cases: null or empty text has difference 0 and gets the curve's value there; with no labelled rows of a class every
score is the share of toxic rows (0 if there are none); null labels and null doc_ids are not learnt from, rows with null
doc_id are scored; repeated labels of a document count once, the largest label; repeated documents are scored alike; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpointed, doc_text, lean, mix, mixed, parts, table

PUNCTUATION = ".,;:!?\"'()[]{}<>|*_~`#$%&"
DISCOUNT, STRENGTH = 0.75, 20.0
ROWS_PER_CLASS = 4000
#: Margins from which the one with the least loss is taken; a larger one has to be better by so much.
MARGINS, BETTER = (0.0, 1.0, 2.0, 3.0, 4.0, 5.0), 0.003
#: Characters of an expression, the last one included.
ORDER = 6
START, STOP = "\x02" * (ORDER - 1), "\x03"
#: Expressions of a part of the model, and slices of the hash range (2^SLICE_BITS) of which parts are made, one at least.
SLOTS, SLICE_BITS = 1 << 21, 12
#: Characters of a word beyond which it is scored without being kept for the next time, and how many are kept.
KEPT_WORD, KEPT_WORDS = 40, 100_000
#: Hash buckets by which unlabelled documents are left out before texts are shuffled: at most so many broadcast rows.
BUCKETS = 1 << 18
#: Characters of words that one vectorised step handles, of texts whose words are looked up together, and the different
#: words of a class that are counted before their expressions are handed on.
STEP_CHARS, TEXT_CHARS, COUNTED_WORDS = 1 << 18, 1 << 20, 100_000
PLACES = tuple(np.uint64(mixed(500 + i) | 1) for i in range(ORDER))


def tokens(text: str) -> list[str]:
    return text.encode().lower().decode().split()  # A-Z alone


def words(text: str) -> list[str]:
    return [w for w in (x.strip(PUNCTUATION) for x in tokens(text)) if w]


def expressions(found: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(code points of every expression, a row each; the word that it is of), the words in order."""
    points = np.frombuffer("".join(START + w + STOP for w in found).encode("utf-32-le"), dtype=np.uint32)
    sizes = np.fromiter(map(len, found), np.int64, len(found)) + 1
    of = np.repeat(np.arange(len(found)), sizes)
    at = np.arange(len(of)) + of * (ORDER - 1)
    return np.lib.stride_tricks.sliding_window_view(points, ORDER)[at], of


def hashes(points: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each row of code points."""
    out = np.full(len(points), points.shape[1], dtype=np.uint64)
    for i in range(points.shape[1]):
        out += mix(points[:, i].astype(np.uint64) * PLACES[i])
    return mix(out)


def runs(found: list[str]) -> Iterator[list[str]]:
    """The words in lists of about STEP_CHARS characters."""
    part, size = [], 0
    for w in found:
        part.append(w)
        size += len(w) + ORDER
        if size > STEP_CHARS:
            yield part
            part, size = [], 0
    if part:
        yield part


def held_out(col: str) -> Column:
    return F.crc32(F.col(col).cast("string")) % 5 == 0


def marked(labels: DataFrame, label_col: str) -> DataFrame:
    """(doc_id, label, fit): the labelled rows outside the held-out fold; fit marks rows for the counts."""
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label")).filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1))
    rows = rows.groupBy("doc_id").agg(F.max("label").alias("label")).filter(~held_out("doc_id"))
    return rows.withColumn("fit", F.pmod(F.hash("doc_id"), F.lit(4)) != 0)


def count_expressions(rows: DataFrame) -> DataFrame:
    """(g, n0, n1): every expression with its count in each class, of rows (label, text)."""

    def counted(seen: tuple[Counter, Counter]) -> Iterator[pa.RecordBatch]:
        for part in runs(list(seen[0].keys() | seen[1].keys())):
            points, of = expressions(part)
            _, first, which = np.unique(hashes(points), return_index=True, return_inverse=True)
            n = [np.bincount(which, np.array([c.get(w, 0) for w in part])[of], len(first)).astype(np.int64) for c in seen]
            text = points[first].tobytes().decode("utf-32-le")
            grams = [text[i : i + ORDER] for i in range(0, len(text), ORDER)]
            yield pa.RecordBatch.from_arrays([pa.array(grams, pa.string()), pa.array(n[0]), pa.array(n[1])], names=["g", "n0", "n1"])
        for c in seen:
            c.clear()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in (part for whole in batches for part in parts(whole)):
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seen[label].update(words(text))
                if len(seen[label]) > COUNTED_WORDS:
                    yield from counted(seen)
        yield from counted(seen)

    return rows.mapInArrow(lean(run), "g string, n0 long, n1 long").groupBy("g").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def shared_backoff(kinds: DataFrame, length: int, d: float) -> DataFrame:
    """(g, s): S of every expression one character shorter than the different ones ``kinds`` (g) of this length."""
    length -= 1
    shorter = kinds.groupBy(F.substring("g", 2, length).alias("g")).agg(F.count("*").alias("c"))
    if length == 1:
        total = shorter.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("total"), F.count("*").alias("different"))
        return shorter.join(F.broadcast(total)).select("g", ((F.col("c") + 1) / (F.col("total") + F.col("different") + 1)).alias("s"))  # total is one row
    start, end = F.substring("g", 1, length - 1).alias("h"), F.substring("g", 2, length - 1).alias("e")
    starts = shorter.groupBy(start).agg(F.sum("c").alias("t"), F.count("*").alias("k"))
    lower = shared_backoff(shorter, length, d).select(F.col("g").alias("e"), F.col("s").alias("below"))
    return shorter.select("g", "c", start, end).join(starts, "h").join(lower, "e").select("g", ((F.greatest(F.col("c") - d, F.lit(0.0)) + d * F.col("k") * F.col("below")) / F.col("t")).alias("s"))


def differences(counts: DataFrame, d: float = DISCOUNT, m: float = STRENGTH) -> tuple[DataFrame, DataFrame]:
    """(g, r): log P_1 - log P_0 of every expression seen; (g, r): of any other one after the start g."""
    start = F.substring("g", 1, ORDER - 1).alias("h")
    starts = counts.groupBy(start).agg(*(F.sum(f"n{c}").alias(f"t{c}") for c in (0, 1)), *(F.count_if(F.col(f"n{c}") > 0).alias(f"k{c}") for c in (0, 1)), F.count("*").alias("k"))
    shared = shared_backoff(counts.select("g"), ORDER, d).select(F.col("g").alias("e"), "s")
    rows = counts.select("g", "n0", "n1", start, F.substring("g", 2, ORDER - 1).alias("e")).join(starts, "h").join(shared, "e")
    both = (F.greatest(F.col("n0") + F.col("n1") - d, F.lit(0.0)) + d * F.col("k") * F.col("s")) / (F.col("t0") + F.col("t1"))
    rows = rows.withColumn("p", both)
    left = {c: m + d * F.col(f"k{c}") for c in (0, 1)}
    seen = {c: (F.greatest(F.col(f"n{c}") - d, F.lit(0.0)) + left[c] * F.col("p")) / (F.col(f"t{c}") + m) for c in (0, 1)}
    other = {c: left[c] / (F.col(f"t{c}") + m) for c in (0, 1)}
    return (
        rows.select("g", (F.log(seen[1]) - F.log(seen[0])).alias("r")),
        starts.select(F.col("h").alias("g"), (F.log(other[1]) - F.log(other[0])).alias("r")),
    )


class Part:
    """Hashes in order and the differences of their expressions, of one range of hashes."""

    def __init__(self, given: Broadcast, size: int) -> None:
        self.given, self.size = given, size

    def __len__(self) -> int:
        return self.size

    def read(self, keep: bool) -> tuple[np.ndarray, np.ndarray]:
        """(hashes, differences); a worker holds on to them only if it is to keep them."""
        if keep or self.given._sc is not None or not hasattr(self.given, "_path"):  # the driver; an encrypted broadcast
            return self.given.value
        return self.given.load_from_path(self.given._path)


def slotted(rows: DataFrame, slots: int) -> list[Part]:
    """All rows (g, r) in parts of at most ``slots`` expressions, collected and broadcast one by one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                text = "".join(batch.column(0).to_pylist())
                points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).reshape(batch.num_rows, -1)
                yield pa.RecordBatch.from_arrays([pa.array(hashes(points).view(np.int64)), batch.column(1).cast(pa.float32())], names=["x", "r"])

    hashed = checkpointed(rows.select("g", "r").mapInArrow(run, "x long, r float"))
    of_range = F.call_function("shiftrightunsigned", "x", F.lit(64 - SLICE_BITS))
    ranges: list[list[int]] = []  # first and last slice, expressions
    for at, n in sorted(map(tuple, hashed.groupBy(of_range).count().collect())):  # at most a row for each slice
        if ranges and ranges[-1][2] + n <= slots:
            ranges[-1] = [ranges[-1][0], at, ranges[-1][2] + n]
        else:
            ranges.append([at, at, n])
    out = []
    for first, last, n in ranges:
        found = hashed.filter(of_range.between(first, last)).toArrow()
        x = found.column("x").to_numpy().view(np.uint64)
        order = np.argsort(x)
        out.append(Part(rows.sparkSession.sparkContext.broadcast((x[order], found.column("r").to_numpy()[order])), n))
    return out


class Models:
    """The difference of the two log-likelihoods of a word and of a text."""

    def __init__(self, seen: list[Part], starts: list[Part], margin: float = 0.0) -> None:
        self.seen, self.starts, self.margin = seen, starts, margin

    @property
    def kept(self) -> dict[str, float]:
        """Differences by token; they stay with the broadcast, so a worker has them for its next tasks."""
        return self.seen[0].given.__dict__.setdefault("kept", {}) if self.seen else {}

    @staticmethod
    def look_up(known: list[Part], hashed: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(whether it is known, its difference) of every hash; each part is read once."""
        out = [(np.zeros(len(x), bool), np.zeros(len(x))) for x in hashed]
        for part in known:
            keys, values = part.read(keep=len(known) == 1)
            for x, (hit, value) in zip(hashed, out, strict=True):
                mine = np.flatnonzero((x >= keys[0]) & (x <= keys[-1]))
                at = np.searchsorted(keys, x[mine])
                same = keys[at] == x[mine]
                hit[mine[same]] = True
                value[mine[same]] = values[at[same]]
        return out

    def of_words(self, found: list[str]) -> list[float]:
        """The difference of each word."""
        steps = []
        for part in runs(found):
            points, of = expressions(part)
            steps.append((len(part), of, hashes(points), hashes(points[:, :-1])))
        seen, starts = self.look_up(self.seen, [s[2] for s in steps]), self.look_up(self.starts, [s[3] for s in steps])
        out: list[float] = []
        for (n, of, *_), (hit, value), (_, other) in zip(steps, seen, starts, strict=True):
            out += np.bincount(of, np.where(hit, value, other), n).tolist()
        return out

    def per_word(self, texts: list[str]) -> Iterator[np.ndarray]:
        """For each text the differences of its words; unknown words of several texts are looked up together."""
        start = 0
        while start < len(texts):
            size, end = 0, start
            while end < len(texts) and size < TEXT_CHARS:
                size += len(texts[end])
                end += 1
            found = [tokens(t) for t in texts[start:end]]
            if len(self.kept) > KEPT_WORDS:
                self.kept.clear()
            known = self.kept
            fresh = list({t for f in found for t in f if t not in known})
            word = [t.strip(PUNCTUATION) for t in fresh]
            value = dict.fromkeys(word)
            value.update(zip([w for w in value if w], self.of_words([w for w in value if w]), strict=True))
            known.update((t, value[w] if w else math.nan) for t, w in zip(fresh, word, strict=True))
            for f in found:
                x = np.fromiter(map(known.__getitem__, f), np.float64, len(f))
                yield x[x == x]  # a token of punctuation is no word
            for t in fresh:
                if len(t) > KEPT_WORD:
                    del known[t]
            start = end

    def by_margin(self, texts: list[str], margins: tuple[float, ...]) -> list[list[float]]:
        """For each text and margin log P_toxic - log P_ordinary of the words with evidence, per word of the text."""
        return [[float(x[np.abs(x) > least].sum()) / max(1, len(x)) for least in margins] for x in self.per_word(texts)]

    def differences(self, texts: list[str]) -> np.ndarray:
        return np.array([x for (x,) in self.by_margin(texts, (self.margin,))], dtype=np.float64)


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3, steps: int = 50) -> tuple[float, float, float]:
    """Slope, intercept and mean loss of a weighted logistic regression on one standardised feature, by Newton's method."""
    mean, scale = float(np.average(x, weights=weight)), float(x.std()) or 1.0
    m = np.stack([(x - mean) / scale, np.ones_like(x)], axis=1)
    b = np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(m @ b, -30, 30)))
        grad = m.T @ (weight * (p - y)) + ridge * b
        b -= np.linalg.solve((m * (weight * p * (1 - p))[:, None]).T @ m + ridge * np.eye(2), grad)
    z = np.clip(m @ b, -30, 30)
    loss = float(np.average(np.log1p(np.exp(-np.where(y == 1, z, -z))), weights=weight))
    return b[0] / scale, b[1] - b[0] * mean / scale, loss


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", rows_per_class: int = ROWS_PER_CLASS, slots: int = SLOTS) -> tuple[Models | None, float, float]:
    """The models, and the slope and intercept of the curve."""
    rows = marked(labels, label_col)
    totals = {r.label: r.n for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    share = totals.get(1, 0) / max(1, sum(totals.values()))
    flat = math.log(max(share, 1e-6) / max(1 - share, 1e-6))
    if len(totals) < 2:
        return None, 0.0, flat
    bucket = F.pmod(F.xxhash64("doc_id"), F.lit(BUCKETS))
    buckets = rows.filter("fit").select(bucket.alias("bucket")).distinct()
    learnt = docs.join(F.broadcast(buckets), bucket == F.col("bucket"), "left_semi").join(rows.filter("fit"), "doc_id").select("label", "text")
    counts = checkpointed(count_expressions(learnt))
    models = Models(*(slotted(x, slots) for x in differences(counts)))
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    sample = [rows.filter(~F.col("fit") & (F.col("label") == c)).orderBy(*order).limit(rows_per_class) for c in (0, 1)]
    curve = docs.join(F.broadcast(sample[0].unionAll(sample[1])), "doc_id").select("label", "text")  # at most 2 * rows_per_class ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = models.by_margin(batch.column(1).to_pylist(), MARGINS)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64()))], names=["label", "x"])

    seen = curve.mapInArrow(run, "label int, x array<double>").collect()
    x, y = np.array([r.x for r in seen]).reshape(-1, len(MARGINS)), np.array([float(r.label) for r in seen])
    if len(set(y)) < 2:
        models.margin = 3.0
        return models, 1.0, flat
    weight = np.where(y == 1, share / (y == 1).mean(), (1 - share) / (y == 0).mean())
    curves = [logistic(x[:, i], y, weight) for i in range(len(MARGINS))]
    best = 0
    for i in range(1, len(MARGINS)):
        if curves[i][2] < curves[best][2] - BETTER:
            best = i
    models.margin = MARGINS[best]
    return models, *curves[best][:2]


def score(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text", rows_per_class: int = ROWS_PER_CLASS) -> DataFrame:
    """(doc_id, score, predicted, log_ratio) of every document."""
    rows = doc_text(docs, id_col, text_col)
    models, slope, intercept = fit(rows, labels, label_col, rows_per_class)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in parts(whole)):
            x = models.differences(batch.column(1).to_pylist()) if models else np.zeros(batch.num_rows)
            p = 1 / (1 + np.exp(-np.clip(slope * x + intercept, -500, 500)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p), pa.array((p >= 0.5).astype(np.int32)), pa.array(x)], names=["doc_id", "score", "predicted", "log_ratio"])

    return rows.mapInArrow(lean(run), "doc_id long, score double, predicted int, log_ratio double")


def keep_ordinary(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text", rows_per_class: int = ROWS_PER_CLASS) -> DataFrame:
    """The rows of ``docs``, with all their columns, that are not predicted to be toxic; no shuffle of the rows themselves."""
    models, slope, intercept = fit(doc_text(docs, id_col, text_col), labels, label_col, rows_per_class)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in parts(whole)):
            x = models.differences([t or "" for t in batch.column(at).to_pylist()]) if models else np.zeros(batch.num_rows)
            yield batch.filter(pa.array(slope * x + intercept < 0))

    return docs.mapInArrow(lean(run), docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8_toxicity: every document's score, learnt from the labels outside the held-out fold."""
    scored = score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")
