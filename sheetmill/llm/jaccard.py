"""Operator 4: n-gram Jaccard join by universe partitioning and the pigeonhole principle.

A document's set holds the hashes of its distinct word shingles. Two sets of r <= s elements with Jaccard similarity at
least t differ in at most H = (1 - t) / (1 + t) * (r + s) elements. Sets are dealt into size bands; in a band the universe of
shingles is hashed into segments, and what a set has in a segment is its segment subset. Segments are of two kinds: exact
ones (value 1) are indexed by their subset; deletion ones (value 2) by their subset and its one-deletion neighbourhood, so
they also meet when the subsets differ in one element. If the values add up to more than H, two similar sets must meet in
some segment. A set is indexed in its own band and probes it, and the next band if a partner can be there.

Allocation by cost: for each band the number of deletion segments and the slack (value beyond H + 1) are chosen by the
expected number of index entries and of chance meetings, given the band's number of sets. Once the sizes of all meetings are
known, each set leaves out its largest ones as far as its spare value goes: small subsets, empty ones above all, and those
of passages that many documents share. Sets of sizes at which only equal sets are similar have no index.

Sets that are equal (128-bit fingerprints) form one class; the join runs over classes. Index entries travel in binary blocks
by hash bucket, so a bucket is a bounded array. Where few classes meet, all pairs are candidates; where more meet, the
pairs of those that have to probe there, compared by their sketches in the task where they meet. Where very many meet, only pairs with one pivot (the class with the most
documents) are verified first; of classes that the links so far leave apart each then tries the nearest one apart from it,
in a few rounds, and what is apart after that is compared in blocks of bounded size. So the pairs of a large group are never listed, no link between different components is lost, and no cap drops
any.

Each set has a sketch: a bit for each of 2 to 4 places an element, set where an odd number of elements fall. An element that
is in one of two sets alone changes one bit, so sets whose sketches differ in more bits than similar sets can differ in
elements are not similar. All candidates are first compared by their sketches, which loses none (members of large meetings
again by sketches of 32 to 64 places an element); what is left is verified on the words of both texts, so texts travel only
for pairs and members of meetings that are near for certain or almost so.

Defined cases: null, empty or blank text has the empty set, is linked with nothing and is its own component; texts with
fewer words than a shingle have one shingle, all their words; ties cannot arise; repeated doc_ids count as one document of
each different text and keep one row per row; rows with null doc_id are counted, linked with nothing and have no component;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import LOWER, Polynomial, checkpointed, checkpointed_small, chunks, doc_text, lean, mix, mixed, partitions, parts, table, word_bounds
from .components import components

STEP = tuple(np.uint64(mixed(i) | 1) for i in range(1, 65))
PRINT_A, PRINT_B, PLACE, ELEMENT, SALT, PARITY = (np.uint64(mixed(1000 + i)) for i in range(6))
#: Classes that may meet in one index entry before pairs with a pivot stand for all pairs.
FEW = 6
#: Classes that may meet for a class that has to probe there to be compared with all others.
SOME = 64
#: Members of such meetings, about, that one task compares at a time.
BUCKET_MEMBERS = 4_000
#: Classes of one block when the rest of such a meeting is compared.
BLOCK = 256
#: Classes of one block when such a meeting's sketches are compared, and 64-bit words of differences made at a time.
SKETCH_BLOCK, SKETCH_WORDS = 2048, 1 << 21
#: The most places of a sketch; of larger sets more differences fall together, which rules out fewer pairs and loses none.
MOST_PLACES = 1 << 16
#: Index entries of a bucket, about, and entries after which blocks are sent on.
BUCKET_ENTRIES, FLUSH_ENTRIES = 150_000, 200_000
#: Rounds in which each member of a large meeting tries the nearest partner in another component before all are compared.
ROUNDS = 3
#: Places an element, and the most of a set, in the sketches of members that the first ones do not tell apart.
FINE, FINE_PLACES = 32, 1 << 18
#: Hash buckets by which documents are left out before texts are shuffled.
TEXT_BUCKETS = 1 << 18
#: Cost of verifying one chance meeting, in index entries.
MEETING_COST = 30.0
#: The least slack as a share of the value needed; it lets sets leave out meetings that passages shared by many make large.
LEAST_SLACK = 0.12


@dataclass(frozen=True)
class Threshold:
    """Similarity of at least num / den."""

    num: int
    den: int

    def gap(self, r, s):
        """The most elements in which similar sets of r and s elements can differ."""
        return (self.den - self.num) * (r + s) // (self.den + self.num)

    def largest(self, r):
        """The most elements of a set similar to one of r."""
        return r * self.den // self.num


@dataclass(frozen=True)
class Band:
    """Sizes [low, high), its segments (exact ones first) and the value that they add up to."""

    number: int
    low: int
    high: int
    exact: int
    deletion: int

    @property
    def value(self) -> int:
        return self.exact + 2 * self.deletion


def band_edges(largest: int, t: Threshold) -> list[int]:
    """Lower ends of the bands: each is so wide that a partner is in the same band or the next."""
    edges = [1]
    while edges[-1] <= largest:
        edges.append(max(edges[-1] + 1, int(edges[-1] * 1.5), t.largest(edges[-1])))
    return edges


def allocate(number: int, low: int, high: int, sets: int, t: Threshold) -> Band:
    """The cheapest numbers of exact and deletion segments for a band with this many sets."""
    top = t.gap(high - 1, high - 1)
    sizes = np.unique(np.linspace(low, high - 1, 8).astype(np.int64))
    spare = top - t.gap(sizes, np.minimum(high - 1, t.largest(sizes)))
    best = None
    for slack in sorted({math.ceil(top * x) for x in (LEAST_SLACK, 0.16, 0.2, 0.3)}):
        for deletion in sorted({0, 1, 2, (top + 1 + slack) // 4, (top + 1 + slack) // 2, (top + 2 + slack) // 2}):
            exact = top + 1 + slack - 2 * deletion
            if exact < 0 and deletion != (top + 2 + slack) // 2:
                continue
            exact = max(exact, 0)
            size = sizes / (exact + deletion)
            empty = np.exp(-size)
            # a set meets others in the empty segments that it has to probe and in its nearly empty deletion segments
            left = np.maximum(0.0, exact * empty + 2 * np.sqrt(exact * empty) - slack - spare)
            met = sets * (left * empty + deletion * ((1 + size) * empty) ** 2)
            cost = float(np.mean(exact + deletion * (1 + size) + MEETING_COST * met))
            if best is None or cost < best[0]:
                best = (cost, exact, deletion)
    return Band(number, low, high, best[1], best[2])


class ShingleSets:
    """The distinct shingle hashes of the texts of a chunk, sorted by text and hash."""

    def __init__(self, width: int) -> None:
        self.width = width
        self.poly = Polynomial()

    def of(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text of each element, its hash, number of elements of each text)."""
        n = len(offsets) - 1
        lower = LOWER[data]
        starts, ends, first = word_bounds(lower, offsets)
        word = self.poly.ranges(self.poly.prefix(lower), starts, ends) if len(starts) else np.empty(0, np.uint64)
        count = np.diff(first)
        text = np.repeat(np.arange(n), count)
        size = len(word) - self.width + 1
        if size > 0:
            full = np.zeros(size, dtype=np.uint64)
            for i in range(self.width):
                full += word[i : i + size] * STEP[i]
            inside = text[:size] == text[self.width - 1 :]
            texts, hashes = text[:size][inside], mix(full[inside])
        else:
            texts, hashes = np.empty(0, np.int64), np.empty(0, np.uint64)
        short = np.flatnonzero((count > 0) & (count < self.width))
        if len(short):
            whole = SALT * count[short].astype(np.uint64)
            for i in range(self.width - 1):
                more = count[short] > i
                whole[more] += word[first[short[more]] + i] * STEP[i]
            texts, hashes = np.concatenate([texts, short]), np.concatenate([hashes, mix(whole)])
        order = np.lexsort((hashes, texts))
        texts, hashes = texts[order], hashes[order]
        new = np.ones(len(texts), dtype=bool)
        new[1:] = (texts[1:] != texts[:-1]) | (hashes[1:] != hashes[:-1])
        texts, hashes = texts[new], hashes[new]
        return texts, hashes, np.bincount(texts, minlength=n)


def sum_by(texts: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n, dtype=np.uint64)
    np.add.at(out, texts, values)
    return out


def prints(texts: np.ndarray, hashes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit fingerprints of each set, as signed numbers."""
    a = mix(sum_by(texts, mix(hashes ^ PRINT_A), len(sizes)) + sizes.astype(np.uint64))
    b = mix(sum_by(texts, mix(hashes ^ PRINT_B), len(sizes)))
    return a.view(np.int64), b.view(np.int64)


def sketches(texts: np.ndarray, hashes: np.ndarray, sizes: np.ndarray, each: int = 2, most: int = MOST_PLACES) -> list[bytes]:
    """Of each set the parity of its elements at each of 2**k places, ``each`` or more an element within 64 and ``most``."""
    places = np.clip(1 << np.ceil(np.log2(np.maximum(each * sizes, 2))).astype(np.int64), 64, most)
    base = np.concatenate([[0], np.cumsum(places)])
    at = base[texts] + (mix(hashes ^ PARITY) & (places[texts] - 1).astype(np.uint64)).astype(np.int64)
    bits = np.packbits(np.bincount(at, minlength=base[-1]).astype(np.uint8) & 1, bitorder="little").tobytes()
    return [bits[a >> 3 : b >> 3] for a, b in zip(base[:-1].tolist(), base[1:].tolist(), strict=True)]


def folded(parts: list[bytes], size: int) -> np.ndarray:
    """Sketches as rows of 64-bit words, folded to ``size`` bytes: places that fall together add up, so do their parities."""
    out = np.empty((len(parts), size // 8), dtype=np.uint64)
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    for n in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == n)
        words = np.frombuffer(b"".join([parts[i] for i in at.tolist()]), "<u8").reshape(len(at), -1, size // 8)
        out[at] = np.bitwise_xor.reduce(words, axis=1)
    return out


def set_rows(rows: DataFrame, width: int) -> DataFrame:
    """(doc_id, n_shingles, print_a, print_b, sketch) of rows (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = ShingleSets(width)
        for batch in batches:
            for ids, data, offsets in chunks(batch.column(0), batch.column(1)):
                texts, hashes, sizes = sets.of(data, offsets)
                a, b = prints(texts, hashes, sizes)
                yield pa.RecordBatch.from_arrays([ids, pa.array(sizes.astype(np.int64)), pa.array(a), pa.array(b), pa.array(sketches(texts, hashes, sizes), pa.binary())], names=["doc_id", "n_shingles", "print_a", "print_b", "sketch"])

    return rows.mapInArrow(lean(run), "doc_id long, n_shingles long, print_a long, print_b long, sketch binary")


def entries(texts: np.ndarray, hashes: np.ndarray, sizes: np.ndarray, chosen: np.ndarray, band_of: np.ndarray, bands: list[Band], t: Threshold) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(signature, text, whether of a deletion segment) of the chosen texts in the bands given, and each text's spare value.

    Two similar sets differ in at most ``gap`` elements, so a set has to probe segments of value gap + 1; the rest is spare.
    """
    n = len(sizes)
    exact = np.array([b.exact for b in bands], dtype=np.int64)[band_of]
    segments = exact + np.array([b.deletion for b in bands], dtype=np.int64)[band_of]
    segments[~chosen] = 0
    base = np.concatenate([[0], np.cumsum(segments)])
    here = chosen[texts]
    owner, element = texts[here], hashes[here]
    place = ((mix(element ^ PLACE) >> np.uint64(32)) * segments[owner].astype(np.uint64)) >> np.uint64(32)
    at = base[owner] + place.astype(np.int64)
    element = mix(element ^ ELEMENT)
    subset = sum_by(at, element, base[-1])
    text = np.repeat(np.arange(n), segments)
    segment = np.arange(base[-1]) - base[text]
    deletion = segment >= exact[text]
    top = np.array([b.high - 1 for b in bands], dtype=np.int64)[band_of]
    value = np.array([b.value for b in bands], dtype=np.int64)[band_of]
    spare = np.maximum(0, value - 1 - t.gap(sizes, np.minimum(t.largest(sizes), top)))
    salt = mix((band_of[text].astype(np.uint64) << np.uint64(40)) + segment.astype(np.uint64) + SALT)
    signature, who, kind = mix(subset + salt), text, deletion
    lost = deletion[at]
    if lost.any():
        gone = mix(subset[at[lost]] - element[lost] + salt[at[lost]])
        signature, who, kind = np.concatenate([signature, gone]), np.concatenate([who, owner[lost]]), np.concatenate([kind, np.ones(len(gone), bool)])
    return signature, who, kind, spare


#: What an entry is: indexed in its own band (else it only probes the next one), of a deletion segment.
INDEXED, DELETION = 1, 2
ENTRY = np.dtype([("signature", "<u8"), ("print", "<i8"), ("size", "<u4"), ("spare", "<u2"), ("role", "u1")])


def index_blocks(rows: DataFrame, width: int, t: Threshold, bands: list[Band], buckets: int) -> DataFrame:
    """(bucket, block): the index entries of all sets, in binary blocks. Equal sets of one partition are sent once."""
    edges = np.array([b.low for b in bands], dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, seen, held, weight = ShingleSets(width), set(), [], 0  # a key for each different set of the partition

        def flush() -> pa.RecordBatch:
            block = np.concatenate(held)
            bucket = (mix(block["signature"] ^ PLACE) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            block, bucket = block[order], bucket[order]
            cuts = np.flatnonzero(np.diff(bucket)) + 1
            starts = np.concatenate([[0], cuts])
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(bucket[starts]), pa.array([x.tobytes() for x in np.split(block, cuts)], pa.binary())], names=["bucket", "block"])

        for batch in batches:
            for _, data, offsets in chunks(batch.column(0), batch.column(1)):
                texts, hashes, sizes = sets.of(data, offsets)
                a, b = prints(texts, hashes, sizes)
                fresh = np.zeros(len(sizes), dtype=bool)
                for i, key in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
                    if sizes[i] and key not in seen:
                        seen.add(key)
                        fresh[i] = True
                band = np.maximum(np.searchsorted(edges, sizes, side="right") - 1, 0)
                after = np.minimum(band + 1, len(bands) - 1)
                fresh &= (t.gap(sizes, sizes) > 0) | (t.largest(sizes) > sizes) | (t.largest(sizes - 1) >= sizes)  # else only equal sets are similar
                reach = fresh & (band + 1 < len(bands)) & (t.largest(sizes) >= edges[after])
                for own, chosen, where in ((True, fresh, band), (False, reach, after)):
                    if chosen.any():
                        signature, who, kind, spare = entries(texts, hashes, sizes, chosen, where, bands, t)
                        out = np.empty(len(signature), dtype=ENTRY)
                        out["signature"], out["print"], out["size"] = signature, a[who], sizes[who]
                        out["spare"] = np.minimum(spare, 0xFFFF)[who]
                        out["role"] = kind * DELETION + own * INDEXED
                        held.append(out)
                        weight += len(out)
                if weight >= FLUSH_ENTRIES:
                    yield flush()
                    weight = 0
        if held:
            yield flush()

    return rows.mapInArrow(lean(run), "bucket long, block binary")


MEETINGS = "signature long, a long, b long, role int, spare int, classes long"


def meetings(blocks: DataFrame, t: Threshold) -> DataFrame:
    """Of each bucket, the pairs that may be similar where few classes meet (a, b), and the members of larger meetings (a)."""

    def run(part: pa.Table) -> pa.Table:
        block = np.frombuffer(b"".join(part.column("block").to_pylist()), dtype=ENTRY)
        block = block[np.lexsort((-(block["role"].astype(np.int8) & INDEXED), block["print"], block["signature"]))]
        # a class once in each meeting
        new = np.ones(len(block), dtype=bool)
        new[1:] = (block["signature"][1:] != block["signature"][:-1]) | (block["print"][1:] != block["print"][:-1])
        block = block[new]
        first = np.ones(len(block), dtype=bool)
        first[1:] = block["signature"][1:] != block["signature"][:-1]
        start = np.flatnonzero(first)
        length = np.diff(np.append(start, len(block)))
        pairs = [np.empty((2, 0), np.int64)]
        for n in range(2, FEW + 1):
            at = start[length == n]
            pairs += [np.stack([at + i, at + j]) for i in range(n) for j in range(i + 1, n)]
        x, y = np.concatenate(pairs, axis=1)
        swap = block["size"][x] > block["size"][y]
        x, y = np.where(swap, y, x), np.where(swap, x, y)
        small, large = block["size"][x].astype(np.int64), block["size"][y].astype(np.int64)
        held = (block["role"] & INDEXED) > 0
        meet = (held[y] | (small == large) & held[x]) & (t.num * large <= t.den * small)
        both = np.stack([block["print"][x][meet], block["print"][y][meet]], axis=1)
        both.sort(axis=1)
        both = np.unique(both, axis=0)
        many = np.repeat(length > FEW, length)
        hot, classes = block[many], np.repeat(length, length)[many]
        zeros = np.zeros(len(both), np.int64)
        columns = {
            "signature": (zeros, np.ascontiguousarray(hot["signature"]).view(np.int64)),
            "a": (both[:, 0], hot["print"]),
            "b": (both[:, 1], np.zeros(len(hot), np.int64)),
            "role": (zeros, hot["role"]),
            "spare": (zeros, hot["spare"]),
            "classes": (zeros, classes),
        }
        kinds = {"role": np.int32, "spare": np.int32}
        return pa.table({n: pa.array(np.concatenate([v.astype(kinds.get(n, np.int64)) for v in c])) for n, c in columns.items()})

    return blocks.groupBy("bucket").applyInArrow(run, MEETINGS)


def allocated(hot: DataFrame) -> DataFrame:
    """Adds probes: whether a member of a large meeting has to probe there.

    Now that the meetings' sizes are known, each class leaves out its largest ones in exact segments as far as its spare
    value goes, in its own band and in the next one separately.
    """
    own = F.col("role").bitwiseAND(INDEXED)
    rank = F.row_number().over(Window.partitionBy("a", own, F.col("role").bitwiseAND(DELETION)).orderBy(F.desc("classes"), "signature"))
    return hot.withColumn("probes", (rank > F.col("spare")) | (F.col("role").bitwiseAND(DELETION) > 0))


def shingles(text: str, width: int) -> set[tuple[bytes, ...]]:
    """The exact set of a text."""
    words = text.encode().lower().split()
    return set(zip(*(words[i:] for i in range(width)), strict=False)) if len(words) >= width else {tuple(words)} if words else set()


def similar(x: set, y: set, t: Threshold) -> bool:
    if t.num * max(len(x), len(y)) > t.den * min(len(x), len(y)):
        return False
    both = len(x & y)
    return both > 0 and t.den * both >= t.num * (len(x) + len(y) - both)


def verified(pairs: DataFrame, texts: DataFrame, width: int, t: Threshold) -> DataFrame:
    """The pairs (a, b) of doc_ids whose texts are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, x = None, set()
        for batch in (part for whole in batches for part in parts(whole)):
            keep = []
            a, b, text_a, text_b = (c.to_pylist() for c in batch.columns)
            for i in range(len(a)):
                if a[i] != last:
                    last, x = a[i], shingles(text_a[i], width)
                keep.append(similar(x, shingles(text_b[i], width), t))
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(keep, pa.bool_())), batch.column(1).filter(pa.array(keep, pa.bool_()))], names=["a", "b"])

    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return joined.mapInArrow(lean(run), "a long, b long")


def alike(n: np.ndarray, m: np.ndarray, a: list[bytes], b: list[bytes], t: Threshold) -> np.ndarray:
    """Of each pair of sets, given their sizes and sketches, whether the sketches do not rule it out."""
    keep = np.zeros(len(a), dtype=bool)
    least = np.array([min(len(x), len(y)) for x, y in zip(a, b, strict=True)], dtype=np.int64)
    for size in np.unique(least).tolist():
        of_size = np.flatnonzero(least == size)
        step = max(1, 8 * SKETCH_WORDS // size)
        for i in range(0, len(of_size), step):
            at = of_size[i : i + step]
            x, y = (folded([p[j] for j in at.tolist()], size) for p in (a, b))
            keep[at] = np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64) <= t.gap(n[at], m[at])
    return keep


def near_by_sketch(pairs: DataFrame, named: DataFrame, t: Threshold) -> DataFrame:
    """The pairs (a, b) of nodes whose sketches do not rule them out; ``named``: (node, n, sketch)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [batch.column(c).to_numpy() for c in ("n_a", "n_b")]
            found = [batch.column(c).to_pylist() for c in ("sketch_a", "sketch_b")]
            keep = alike(*n, *found, t)
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(keep)) for c in ("a", "b")], names=["a", "b"])

    for s in "ab":
        pairs = pairs.join(named.select(F.col("node").alias(s), F.col("n").alias(f"n_{s}"), F.col("sketch").alias(f"sketch_{s}")), s)
    return pairs.mapInArrow(lean(run), "a long, b long")


def near_in_meetings(some: DataFrame, sketches: DataFrame, t: Threshold) -> DataFrame:
    """The pairs (a, b) of classes in one meeting, one of which probes there, that sizes and sketches do not rule out.

    ``some``: (signature, node, n, probes) with at most SOME members a meeting; ``sketches``: (node, n, sketch). A task
    takes the meetings of some buckets of bounded size; all their pairs are compared there, and only near ones become rows.
    """

    def run(part: pa.Table) -> pa.Table:
        signature, n, probes = (part.column(c).to_numpy() for c in ("signature", "n", "probes"))
        node, first, place = np.unique(part.column("node").to_numpy(), return_index=True, return_inverse=True)
        order = np.argsort(signature, kind="stable")
        cuts = np.flatnonzero(np.diff(signature[order])) + 1
        codes = []
        for member in np.split(order, cuts):
            ask = member[probes[member]]
            i, j = np.repeat(ask, len(member)), np.tile(member, len(ask))
            fits = (place[i] != place[j]) & (t.num * np.maximum(n[i], n[j]) <= t.den * np.minimum(n[i], n[j]))
            i, j = place[i[fits]], place[j[fits]]
            codes.append(np.unique(np.minimum(i, j) * len(node) + np.maximum(i, j)))
        x, y = np.divmod(np.unique(np.concatenate(codes)), len(node))
        n, sketch = n[first], part.column("sketch").take(pa.array(first)).to_pylist()
        keep = alike(n[x], n[y], [sketch[i] for i in x.tolist()], [sketch[i] for i in y.tolist()], t)
        return pa.table({"a": pa.array(node[x[keep]], pa.int64()), "b": pa.array(node[y[keep]], pa.int64())})

    buckets = max(partitions(some), some.count() // BUCKET_MEMBERS)
    rows = some.select("signature", "node", "n", "probes", F.pmod(F.xxhash64("signature"), F.lit(buckets)).alias("bucket")).join(sketches.select("node", "sketch"), "node")
    return rows.groupBy("bucket").applyInArrow(run, "a long, b long")


def fine_sketches(texts: DataFrame, classes: DataFrame, width: int) -> DataFrame:
    """(node, n, sketch): sketches with more places of the classes whose nodes' rows (doc_id, text) are given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = ShingleSets(width)
        for batch in batches:
            for ids, data, offsets in chunks(batch.column(0), batch.column(1)):
                texts, hashes, sizes = sets.of(data, offsets)
                columns = [ids, pa.array(sizes.astype(np.int64)), *map(pa.array, prints(texts, hashes, sizes)), pa.array(sketches(texts, hashes, sizes, FINE, FINE_PLACES), pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["node", "n_shingles", "print_a", "print_b", "fine"])

    found = texts.select("doc_id", "text").mapInArrow(run, "node long, n_shingles long, print_a long, print_b long, fine binary")
    key = ["node", "n_shingles", "print_a", "print_b"]
    return found.join(classes.select(*key), key).dropDuplicates(key).select("node", F.col("n_shingles").alias("n"), F.col("fine").alias("sketch"))


def dealt(hot: DataFrame) -> DataFrame:
    """Members of meetings in blocks (signature, i, j): those that ask in every block of members, and all as the asked.

    ``hot`` has blocks and ask_blocks of its meeting, made by ``blocked``; each of its rows is read once.
    """
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    own = lambda n: F.pmod(F.xxhash64("node"), F.greatest(F.col(n), one))
    place = lambda asks, i, j: F.struct(F.lit(asks).alias("asks"), i.alias("i"), j.alias("j"))
    asking = F.transform(F.sequence(zero, F.col("blocks") - one), lambda j: place(True, own("ask_blocks"), j))
    held = F.transform(F.filter(F.sequence(zero, F.col("ask_blocks")), lambda i: i < F.col("ask_blocks")), lambda i: place(False, i, own("blocks")))
    return hot.withColumn("place", F.explode(F.when(F.col("probes"), F.concat(asking, held)).otherwise(held))).select("*", "place.*").drop("place", "blocks", "ask_blocks")


def blocked(hot: DataFrame, block: int) -> DataFrame:
    """Adds how many blocks a meeting's members, and those that ask, are dealt into."""
    counted = hot.groupBy("signature").agg(F.ceil(F.count_if("probes") / block).cast("long").alias("ask_blocks"), F.ceil(F.count("*") / block).cast("long").alias("blocks"))
    return hot.join(counted, "signature")


def still_near(hot: DataFrame, sketches: DataFrame, t: Threshold) -> DataFrame:
    """(signature, node, partner): members that the sketches leave with a partner in another component.

    ``hot``: (signature, node, component, probes); ``sketches``: (node, n, sketch). Members that ask name the nearest such
    partner, others none.
    """

    def run(part: pa.Table) -> pa.Table:
        asks = part.column("asks").to_numpy()
        q, v = np.flatnonzero(asks), np.flatnonzero(~asks)
        found, partner = np.zeros(len(asks), dtype=bool), np.full(len(asks), -1)
        if len(q) and len(v):
            node, component, n = (part.column(c).to_numpy() for c in ("node", "component", "n"))
            parts = part.column("sketch").to_pylist()
            words = folded(parts, min(map(len, parts)))
            step = max(1, SKETCH_WORDS // (len(v) * words.shape[1]))
            for i in range(0, len(q), step):
                a = q[i : i + step]
                differ = np.bitwise_count(words[a][:, None] ^ words[v]).sum(axis=2, dtype=np.int64)
                near = (differ <= t.gap(n[a][:, None], n[v])) & (component[a][:, None] != component[v])
                some = near.any(axis=1)
                found[a] |= some
                found[v] |= near.any(axis=0)
                partner[a[some]] = v[np.where(near, differ, np.iinfo(np.int64).max).argmin(axis=1)[some]]
        some = np.flatnonzero(found)
        node = part.column("node").combine_chunks()
        return pa.table({"signature": part.column("signature").take(pa.array(some)), "node": node.take(pa.array(some)), "partner": node.take(pa.array(partner[some], mask=partner[some] < 0))})

    rows = dealt(blocked(hot, SKETCH_BLOCK).join(sketches, "node"))
    return rows.groupBy("signature", "i", "j").applyInArrow(run, "signature long, node long, partner long")


def overlaps(a: list[set], b: list[set], columns: int = 4096) -> np.ndarray:
    """Sizes of the intersections of every set of ``a`` with every set of ``b``, by products of 0-1 matrices of bounded width."""
    column: dict = {}
    for s in a:
        for x in s:
            column.setdefault(x, len(column))
    places = []
    for sets in (a, b):
        found = [np.array([column[x] for x in s if x in column], dtype=np.int64) for s in sets]
        row = np.repeat(np.arange(len(sets)), [len(f) for f in found])
        at = np.concatenate([np.empty(0, np.int64), *found])
        order = np.argsort(at, kind="stable")
        places.append((row[order], at[order]))
    both = np.zeros((len(a), len(b)), dtype=np.float32)
    for low in range(0, len(column), columns):
        part = []
        for sets, (row, at) in zip((a, b), places, strict=True):
            first, last = np.searchsorted(at, (low, low + columns))
            m = np.zeros((len(sets), columns), dtype=np.float32)
            m[row[first:last], at[first:last] - low] = 1
            part.append(m)
        both += part[0] @ part[1].T
    return both.astype(np.int64)


def rest_links(hot: DataFrame, texts: DataFrame, width: int, t: Threshold) -> DataFrame:
    """Links between members of a large meeting that are in different components so far.

    ``hot``: (signature, node, component, probes). Members that probe are compared with all members, block by block, so a
    task is of bounded size. Only links that join components not yet joined in the task are returned.
    """
    rows = dealt(blocked(hot, BLOCK).join(texts.withColumnRenamed("doc_id", "node"), "node"))

    def run(part: pd.DataFrame) -> pd.DataFrame:
        root = {c: c for c in part["component"].tolist()}

        def find(c: int) -> int:
            while root[c] != c:
                root[c] = root[root[c]]
                c = root[c]
            return c

        links = []
        side = [part[part["asks"]], part[~part["asks"]]]
        if len(side[0]) and len(side[1]):
            sets = [[shingles(x, width) for x in s["text"]] for s in side]
            size = [np.array([len(x) for x in s], dtype=np.int64) for s in sets]
            both = overlaps(*sets)
            near = (both > 0) & (t.den * both >= t.num * (size[0][:, None] + size[1] - both))
            (node_a, node_b), (of_a, of_b) = ([s[c].tolist() for s in side] for c in ("node", "component"))
            for i, j in zip(*(x.tolist() for x in np.nonzero(near)), strict=True):
                a, b = find(of_a[i]), find(of_b[j])
                if a != b:
                    root[a] = b
                    links.append((node_a[i], node_b[j]))
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    return rows.groupBy("signature", "i", "j").applyInPandas(run, "a long, b long")


def once_each(hot: DataFrame) -> DataFrame:
    """Without the meetings that have the same members, asking and asked, as another."""
    own = hot.groupBy("signature").agg(F.count("*").alias("n"), *(F.sum(F.xxhash64("node", "probes", F.lit(i)).cast("decimal(38,0)")).alias(f"h{i}") for i in (1, 2)))
    return hot.join(own.groupBy("n", "h1", "h2").agg(F.min("signature").alias("signature")).select("signature"), "signature", "left_semi")


def texts_of(rows: DataFrame, ids: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """The rows (doc_id, text) whose doc_id is in one of these columns.

    Rows of other hash buckets stay where they are; the set of buckets is broadcast and has at most TEXT_BUCKETS rows.
    """
    bucket = F.pmod(F.xxhash64("doc_id"), F.lit(TEXT_BUCKETS))
    needed = ids.select(F.explode(F.array(*columns)).alias("doc_id")).distinct()
    buckets = needed.select(bucket.alias("bucket")).distinct()
    near = rows.join(F.broadcast(buckets), bucket == F.col("bucket"), "left_semi")
    return checkpointed(near.join(needed, "doc_id"))


def similar_components(df: DataFrame, width: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document."""
    t = Threshold(num, den)
    rows = doc_text(df, id_col, text_col)
    sets = checkpointed(set_rows(rows, width))
    rows = rows.filter("doc_id IS NOT NULL")
    key = ["n_shingles", "print_a", "print_b"]
    classes = sets.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy(*key).agg(F.min("doc_id").alias("node"), F.count("*").alias("copies"), F.first("sketch").alias("sketch"))
    classes = checkpointed(classes)
    sets = sets.drop("sketch")
    largest = classes.agg(F.max("n_shingles")).first()[0] or 0
    edges = band_edges(largest, t)
    cuts = F.array(*map(F.lit, edges))
    per_band = classes.groupBy(F.size(F.filter(cuts, lambda e: e <= F.col("n_shingles"))).alias("band")).agg(F.count("*").alias("sets"), F.sum("n_shingles").alias("elements")).collect()
    count = {r.band - 1: r.sets for r in per_band}
    bands = [allocate(i, low, high, count.get(i, 0) + count.get(i - 1, 0), t) for i, (low, high) in enumerate(zip(edges, edges[1:], strict=False))]
    total = sum(r.elements for r in per_band)
    buckets = max(4 * partitions(df), total // (2 * BUCKET_ENTRIES))
    if not bands:
        return sets.select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    met = checkpointed(meetings(index_blocks(rows, width, t, bands, buckets), t))
    named = classes.select(F.col("print_a").alias("p"), "node", "copies", F.col("n_shingles").alias("n"))
    sketched = classes.select("node", F.col("n_shingles").alias("n"), "sketch")
    few = met.filter("classes = 0").select("a", "b").distinct()
    few = few.join(named.select(F.col("p").alias("a"), F.col("node").alias("x")), "a").join(named.select(F.col("p").alias("b"), F.col("node").alias("y")), "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    hot = allocated(met.filter("classes > 0"))
    hot = hot.join(hot.groupBy("signature").agg(F.max("probes").alias("needed")).filter("needed"), "signature")
    hot = checkpointed_small(hot.join(named, F.col("a") == F.col("p")).select("signature", "node", "copies", "n", "probes", "classes"))
    some, hot = hot.filter(F.col("classes") <= SOME), hot.filter(F.col("classes") > SOME)
    pivots = hot.groupBy("signature").agg(F.max(F.struct("copies", F.negative("node").alias("node"))).alias("pivot"))
    star = hot.join(pivots, "signature").select(F.col("node").alias("a"), F.negative("pivot.node").alias("b"))
    pairs = few.unionAll(star).filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    pairs = checkpointed_small(near_by_sketch(pairs, sketched, t).unionAll(near_in_meetings(some, sketched, t)).distinct())
    links = checkpointed_small(verified(pairs, texts_of(rows, pairs, ("a", "b")), width, t))
    joined = components(links)
    sketch, apart = sketched, hot
    for i in range(ROUNDS + 2) if not hot.isEmpty() else ():
        apart = apart.select("signature", "node", "probes").join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
        parts = apart.groupBy("signature", "component").agg(F.count("*").alias("n"))
        several = parts.groupBy("signature").agg(F.count("*").alias("parts")).filter("parts > 1")
        apart = checkpointed_small(apart.join(several, "signature").select("signature", "node", "component", "probes"))
        left = checkpointed_small(still_near(apart, sketch, t))
        if left.isEmpty():
            break
        apart = apart.join(left.select("signature", "node").distinct(), ["signature", "node"])
        if i == 0:
            sketch = checkpointed(fine_sketches(texts_of(rows, left, ("node",)), classes, width))
            continue
        some = left.filter("partner IS NOT NULL").select(F.least("node", "partner").alias("a"), F.greatest("node", "partner").alias("b")).distinct()
        some = checkpointed_small(some.join(pairs, ["a", "b"], "left_anti"))
        last = i > ROUNDS or some.isEmpty()
        if last:
            apart = checkpointed_small(once_each(apart))
            more = rest_links(apart, texts_of(rows, apart, ("node",)), width, t)
        else:
            pairs = pairs.unionAll(some)
            more = verified(some, texts_of(rows, some, ("a", "b")), width, t)
        links = links.unionAll(checkpointed_small(more))
        joined = components(links)
        if last:
            break
    of_class = classes.join(joined, "node", "left").select(*key, F.coalesce("component", "node").alias("component"))
    same = F.lit(True)
    for k in key:
        same = same & (sets[k] == of_class[k])
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return sets.join(of_class, same, "left").select("doc_id", sets["n_shingles"], component.alias("component_id"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op4_ngram_jaccard: components of documents that share at least 80 % of their five-word shingles."""
    return similar_components(table(spark, sf_dir, "documents"))
