"""Operator 6: removal of long repeated byte strings by enhanced suffix arrays over anchored contexts.

Every window of ``length`` bytes holds one anchor: of its k-byte strings the one with the smallest hash, the leftmost on
ties. Equal windows have equal anchors at equal places, so all occurrences of a repeated window meet under their anchor's
hash, whatever documents they are in. An anchor's context is the stretch of windows that it governs.

1. Documents are dealt into bounded groups by doc_id (one exchange, used three times). Each group sends its anchors' hashes
   by hash bucket; hashes that occur twice come back as positions. Equal texts of a group are sent once.
2. For those anchors the contexts go to their hash's bucket. Equal contexts fold into the earliest one. Where an anchor has
   several different contexts, a suffix array with common-prefix lengths is built over them; a stack scan walks its
   common-prefix intervals, and those of at least ``length`` bytes whose left extensions differ (or end) are the maximal
   repeats, each with all its occurrences. All but the earliest occurrence of each are removed, and of equal contexts all
   but the earliest.
3. The spans go back to their documents, are united there and cut out.

A window that is not the first of its content lies in a maximal repeat whose occurrences are the window's own, at a later
one; and every removed byte lies in such a window. Strings are judged on the input, so the result does not depend on order.

Defined cases: null text is empty; texts shorter than ``length`` lose nothing; of rows with equal doc_id the one with the
smaller text comes first; null doc_ids come before all others and stay null; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Polynomial, chunks, lean_cogroup, lean_group, mix, partitions, table

#: Bytes of an anchor.
ANCHOR = 36
#: Bytes of text of a group of documents, and index entries of a bucket, about.
GROUP_BYTES, BUCKET_ENTRIES = 5 << 20, 250_000
TOP = np.uint64(0xFFFFFFFF00000000)
LOW = np.uint64(0x00000000FFFFFFFF)
NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, by doubling."""
    out, size = x, 1
    while 2 * size <= width:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    more = width - size
    return np.minimum(out[: len(out) - more], out[more:]) if more else out


class Anchors:
    """The anchors of the texts of a chunk and the windows that each governs."""

    def __init__(self, length: int) -> None:
        self.length, self.poly = length, Polynomial()

    def of(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(text, hash, place, first window, last window) of each anchor, places and windows from the chunk's start."""
        none = np.empty(0, np.int64)
        if len(data) < self.length:
            return none, none.view(np.uint64), none, none, none
        hashes = self.poly.windows(self.poly.prefix(data), ANCHOR)
        text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        ends = offsets[1:][text]
        starts = np.arange(len(hashes))
        key = (hashes & TOP) | starts.astype(np.uint64)
        key[starts + ANCHOR > ends[: len(hashes)]] = NONE
        least = sliding_min(key, self.length - ANCHOR + 1)
        windows = np.flatnonzero(starts[: len(least)] + self.length <= ends[: len(least)])
        place = (least[windows] & LOW).astype(np.int64)
        new = np.ones(len(windows), dtype=bool)
        new[1:] = place[1:] != place[:-1]
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(windows)) - 1
        place = place[first]
        return text[place], hashes[place], place, windows[first], windows[last]


def split_by(key: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, list[list[np.ndarray]]]:
    """The distinct keys in order and, for each, the columns' values."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    cuts = np.flatnonzero(np.diff(key)) + 1
    starts = np.concatenate([[0], cuts]) if len(key) else np.empty(0, np.int64)
    return key[starts], [np.split(c[order], cuts) if len(key) else [] for c in columns]


def group_texts(part: pa.Table) -> tuple[np.ndarray, pa.Array, dict[int, int]]:
    """A group's doc_ids and texts in order of (doc_id, text), and for each text equal to an earlier one that one's row."""
    part = part.combine_chunks().sort_by([("doc_id", "ascending"), ("text", "ascending")])
    ids, texts = part.column("doc_id").combine_chunks(), part.column("text").combine_chunks()
    seen: dict[bytes, int] = {}
    copies = {}
    for i, t in enumerate(texts):
        key = hashlib.blake2b(t.as_buffer(), digest_size=16).digest()
        if (first := seen.setdefault(key, i)) != i:
            copies[i] = first
    return ids.to_numpy(zero_copy_only=False), texts, copies


def anchor_rows(part: pa.Table, length: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(row base, text, hash, place, window, window) of a group's different texts, chunk by chunk, places within texts."""
    ids, texts, copies = group_texts(part)
    rows = np.array([i for i in range(len(ids)) if i not in copies], dtype=np.int64)
    anchors = Anchors(length)
    for which, data, offsets in chunks(pa.array(rows), texts.take(pa.array(rows))):
        which = which.to_numpy()
        text, hashes, place, first, last = anchors.of(data, offsets)
        yield ids, which, data, offsets, text, hashes, place, first, last


OCCURRENCE = np.dtype([("hash", "<u8"), ("doc", "<i8"), ("row", "<u4"), ("group", "<u4")])


def anchor_blocks(docs: DataFrame, length: int, buckets: int) -> DataFrame:
    """(bucket, block): the hashes of all anchors with the group that holds them."""

    def run(part: pa.Table) -> pa.Table:
        group = part.column("part")[0].as_py()
        found = [np.unique(hashes, return_counts=True) for *_, hashes, _, _, _ in anchor_rows(part, length)]
        hashes = np.concatenate([h for h, _ in found]) if found else np.empty(0, np.uint64)
        count = np.concatenate([c for _, c in found]) if found else np.empty(0, np.int64)
        hashes, inverse = np.unique(hashes, return_inverse=True)
        many = np.bincount(inverse, weights=count, minlength=len(hashes)) > 1 if len(hashes) else np.empty(0, bool)
        keys, (h, m) = split_by((mix(hashes) % np.uint64(buckets)).astype(np.int64), hashes, many)
        blocks = [len(x).to_bytes(4, "little") + group.to_bytes(8, "little") + x.tobytes() + y.tobytes() for x, y in zip(h, m, strict=True)]
        return pa.table({"bucket": pa.array(keys, pa.int64()), "block": pa.array(blocks, pa.binary())})

    return docs.groupBy("part").applyInArrow(lean_group(run), "bucket long, block binary")


def repeated(blocks: DataFrame) -> DataFrame:
    """(part, hashes): for each group of documents its anchors' hashes that occur twice anywhere."""

    def run(part: pa.Table) -> pa.Table:
        hashes, many, groups = [], [], []
        for raw in part.column("block").to_pylist():
            n, group = int.from_bytes(raw[:4], "little"), int.from_bytes(raw[4:12], "little")
            hashes.append(np.frombuffer(raw, "<u8", n, 12))
            many.append(np.frombuffer(raw, bool, n, 12 + 8 * n))
            groups.append(np.full(n, group))
        hash_, many, group = np.concatenate(hashes), np.concatenate(many), np.concatenate(groups)
        order = np.argsort(hash_, kind="stable")
        hash_, many, group = hash_[order], many[order], group[order]
        same = hash_[1:] == hash_[:-1]
        twice = many.copy()
        twice[1:] |= same
        twice[:-1] |= same
        keys, (h,) = split_by(group[twice], hash_[twice])
        return pa.table({"part": pa.array(keys, pa.int64()), "hashes": pa.array([x.tobytes() for x in h], pa.binary())})

    return blocks.groupBy("bucket").applyInArrow(lean_group(run), "part long, hashes binary")


CONTEXT = np.dtype([("hash", "<u8"), ("doc", "<i8"), ("row", "<u4"), ("start", "<u4"), ("size", "<u4"), ("group", "<u4")])


def context_blocks(docs: DataFrame, twice: DataFrame, length: int, buckets: int) -> DataFrame:
    """(bucket, heads, bytes): the contexts of repeated anchors."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out_heads, out_bytes, out_keys = [], [], []
        if len(left) and len(right):
            group = left.column("part")[0].as_py()
            wanted = np.sort(np.frombuffer(b"".join(right.column("hashes").to_pylist()), "<u8"))
            heads: list[np.ndarray] = []
            bodies: list[bytes] = []
            for ids, which, data, offsets, text, hashes, _, first, last in anchor_rows(left, length):
                at = np.minimum(np.searchsorted(wanted, hashes), len(wanted) - 1)
                keep = wanted[at] == hashes
                text, hashes, first, last = text[keep], hashes[keep], first[keep], last[keep]
                head = np.empty(len(text), dtype=CONTEXT)
                head["hash"], head["doc"], head["row"], head["group"] = hashes, ids[which[text]], which[text], group
                head["start"], head["size"] = first - offsets[text], last - first + length
                heads.append(head)
                raw = data.tobytes()
                bodies += [raw[a : a + n] for a, n in zip(first.tolist(), head["size"].tolist(), strict=True)]
            head = np.concatenate(heads) if heads else np.empty(0, CONTEXT)
            key = (mix(head["hash"]) % np.uint64(buckets)).astype(np.int64)
            out_keys, (picked,) = split_by(key, np.arange(len(head)))
            out_heads = [head[p].tobytes() for p in picked]
            out_bytes = [b"".join([bodies[i] for i in p.tolist()]) for p in picked]
        return pa.table({"bucket": pa.array(out_keys, pa.int64()), "heads": pa.array(out_heads, pa.binary()), "bytes": pa.array(out_bytes, pa.binary())})

    return docs.groupBy("part").cogroup(twice.groupBy("part")).applyInArrow(lean_cogroup(run), "bucket long, heads binary, bytes binary")


class SuffixArray:
    """Suffix array and common-prefix lengths of several strings, suffixes ending with their string.

    Ranks by 7, 14, 28 ... symbols are kept: sorting doubles them, and the common prefix of two suffixes is found by
    descending through them.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        self.text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        self.remain = offsets[1:][self.text] - np.arange(len(data))
        n = len(data)
        symbol = np.zeros(n + 8, dtype=np.int64)
        symbol[:n] = data.astype(np.int64) + 1
        packed = np.zeros(n, dtype=np.int64)
        for i in range(7):
            packed = packed * 512 + np.where(self.remain > i, symbol[i : n + i], 0)
        self.ranks: list[tuple[int, np.ndarray]] = []
        depth, longest = 7, int(self.remain.max(initial=0))
        rank = np.unique(packed, return_inverse=True)[1] + 1
        while True:
            self.ranks.append((depth, rank))
            if depth >= longest:
                break
            after = np.where(self.remain > depth, np.concatenate([rank[depth:], np.zeros(min(depth, n), np.int64)])[:n], 0)
            rank = np.unique(rank * (n + 1) + after, return_inverse=True)[1] + 1
            depth *= 2
        self.order = np.argsort(rank, kind="stable")

    def common(self) -> np.ndarray:
        """Common-prefix length of each suffix with the one before it in the order; 0 for the first."""
        a, b = self.order[:-1].copy(), self.order[1:].copy()
        most = np.minimum(self.remain[a], self.remain[b])
        out = np.zeros(len(a), dtype=np.int64)
        last = len(self.remain) - 1
        for depth, rank in reversed(self.ranks):
            x, y = np.minimum(a + out, last), np.minimum(b + out, last)
            out += np.where((out + depth <= most) & (rank[x] == rank[y]), depth, 0)
        data_rank = self.symbols
        for _ in range(6):
            x, y = np.minimum(a + out, last), np.minimum(b + out, last)
            out += (out < most) & (data_rank[x] == data_rank[y])
        return np.concatenate([[0], out])


def maximal_repeats(strings: list[bytes], length: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(size, strings, places) of every maximal repeat of at least ``length`` bytes, with all its occurrences.

    A stack scan over the common-prefix lengths visits each common-prefix interval once, when it closes; an interval is a
    maximal repeat if two of its occurrences have different bytes before them, or one starts its string.
    """
    data = np.frombuffer(b"".join(strings), dtype=np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(s) for s in strings])]).astype(np.int64)
    if len(data) < 2:
        return
    array = SuffixArray.__new__(SuffixArray)
    array.symbols = data
    SuffixArray.__init__(array, data, offsets)
    order, common = array.order, array.common()
    place = order - offsets[array.text[order]]
    before = np.where(place > 0, data[order - 1].astype(np.int64), -1 - np.arange(len(order)))
    changes = np.concatenate([[0], np.cumsum(before[1:] != before[:-1])])
    deep = common >= length
    # only stretches of deep common prefixes hold intervals
    starts = np.flatnonzero(deep & ~np.concatenate([[False], deep[:-1]])) - 1
    ends = np.flatnonzero(deep & ~np.concatenate([deep[1:], [False]]))
    for low, high in zip(starts.tolist(), ends.tolist(), strict=True):
        stack: list[tuple[int, int]] = []
        values = common[low + 1 : high + 1].tolist()
        for i, value in enumerate([*values, 0], low + 1):
            left = i - 1
            while stack and stack[-1][0] > value:
                size, left = stack.pop()
                if changes[i - 1] > changes[left]:
                    at = order[left:i]
                    yield size, array.text[at], at - offsets[array.text[at]]
            if value and (not stack or stack[-1][0] < value):
                stack.append((value, left))


#: Bytes of strings, about, in one suffix array; it takes some hundred bytes for each.
ARRAY_BYTES = 1 << 19
#: What a null doc_id counts as, the least number.
NO_ID = -(1 << 63)
SPANS = "part long, spans binary"
SPAN = np.dtype([("row", "<u4"), ("start", "<u4"), ("size", "<u4")])


def removed_spans(contexts: DataFrame, length: int) -> DataFrame:
    """(part, spans): for each group of documents the byte ranges to remove."""

    def run(part: pa.Table) -> pa.Table:
        head = np.concatenate([np.frombuffer(h, CONTEXT) for h in part.column("heads").to_pylist()])
        raw = b"".join(part.column("bytes").to_pylist())
        offsets = np.concatenate([[0], np.cumsum(head["size"].astype(np.int64))])
        digest = b"".join([hashlib.blake2b(raw[a:b], digest_size=8).digest() for a, b in zip(offsets.tolist(), offsets[1:].tolist(), strict=False)])
        content = np.frombuffer(digest, "<u8")
        order = np.lexsort((head["start"], head["row"], head["doc"], content, head["hash"]))
        head, content, starts = head[order], content[order], offsets[:-1][order]
        equal = np.zeros(len(head), dtype=bool)
        equal[1:] = (head["hash"][1:] == head["hash"][:-1]) & (content[1:] == content[:-1]) & (head["size"][1:] == head["size"][:-1])
        for i in np.flatnonzero(equal).tolist():  # digests only sort: what goes is equal byte for byte
            a, b, n = int(starts[i - 1]), int(starts[i]), int(head["size"][i])
            equal[i] = raw[a : a + n] == raw[b : b + n]
        gone = [head[equal]]
        head, starts = head[~equal], starts[~equal]
        near = head["hash"][1:] == head["hash"][:-1]
        several = np.zeros(len(head), dtype=bool)
        several[1:] |= near
        several[:-1] |= near
        inner = np.flatnonzero(several)
        # ARRAY_BYTES of strings at a time, never cutting an anchor's contexts apart
        cut, upto = 0, np.cumsum(head["size"][inner].astype(np.int64))
        while cut < len(inner):
            before = int(upto[cut - 1]) if cut else 0
            end = max(cut + 1, int(np.searchsorted(upto, before + ARRAY_BYTES, side="right")))
            while end < len(inner) and head["hash"][inner[end]] == head["hash"][inner[end - 1]]:
                end += 1
            mine = head[inner[cut:end]]
            strings = [raw[a : a + n] for a, n in zip(starts[inner[cut:end]].tolist(), mine["size"].tolist(), strict=True)]
            for size, which, place in maximal_repeats(strings, length):
                first = np.lexsort((mine["start"][which] + place, mine["row"][which], mine["doc"][which]))[0]
                later = np.ones(len(which), dtype=bool)
                later[first] = False
                span = mine[which[later]].copy()
                span["start"] += place[later].astype(np.uint32)
                span["size"] = size
                gone.append(span)
            cut = end
        found = np.concatenate(gone)
        span = np.empty(len(found), dtype=SPAN)
        for c in SPAN.names:
            span[c] = found[c]
        keys, (spans,) = split_by(found["group"].astype(np.int64), span)
        return pa.table({"part": pa.array(keys, pa.int64()), "spans": pa.array([x.tobytes() for x in spans], pa.binary())})

    return contexts.groupBy("bucket").applyInArrow(lean_group(run), SPANS)


def united(spans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs that cover the spans (touching ones are one run)."""
    order = np.argsort(spans["start"], kind="stable")
    start = spans["start"][order].astype(np.int64)
    end = np.maximum.accumulate(start + spans["size"][order])
    new = np.ones(len(start), dtype=bool)
    new[1:] = start[1:] > end[:-1]
    first = np.flatnonzero(new)
    return start[first], end[np.append(first[1:], len(start)) - 1]


KEPT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept string"


def cut_out(docs: DataFrame, spans: DataFrame, length: int, with_text: bool) -> DataFrame:
    """Each document without its spans, with the column rest if there is one."""
    carried = "rest" in docs.columns

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        if len(left):
            if carried:  # rows that are equal in both columns can change places
                left = left.combine_chunks().sort_by([("doc_id", "ascending"), ("text", "ascending")])
            ids, texts, copies = group_texts(left)
            of_row = {}
            if len(right):
                span = np.frombuffer(b"".join(right.column("spans").to_pylist()), SPAN)
                keys, (split,) = split_by(span["row"].astype(np.int64), span)
                of_row = dict(zip(keys.tolist(), split, strict=True))
            for i, doc in enumerate(ids.tolist()):
                raw = texts[i].as_buffer().to_pybytes()
                kept, removed, runs = raw, 0, 0
                if i in copies and len(raw) >= length:
                    kept, removed, runs = b"", len(raw), 1
                elif i in of_row:
                    starts, ends = united(of_row[i])
                    runs, removed = len(starts), int((ends - starts).sum())
                    edges = [0, *np.stack([starts, ends], axis=1).ravel().tolist(), len(raw)]
                    kept = b"".join([raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)])
                rows.append((doc, len(raw), removed, runs, hashlib.sha256(kept).hexdigest(), kept.decode(errors="ignore") if with_text else None))
        columns = list(zip(*rows, strict=True)) if rows else [()] * 6
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        out = pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])
        return out.append_column("rest", left.column("rest")) if carried else out

    schema = f"{KEPT}, rest {docs.schema['rest'].dataType.simpleString()}" if carried else KEPT
    return docs.groupBy("part").cogroup(spans.groupBy("part")).applyInArrow(lean_cogroup(run), schema)


def remove_repeats(df: DataFrame, length: int = 100, with_text: bool = False, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) of every document.

    kept, the remaining text without bytes that no longer make a character, is null unless asked for; the digest is that of
    all remaining bytes. With ``carry`` each row keeps those columns of its own in a struct, rest.
    """
    if length < ANCHOR + 1:
        raise ValueError(f"length must be over {ANCHOR}")
    doc = F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID))
    rest = [F.struct(*carry).alias("rest")] if carry else []
    rows = df.select(doc.alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), *rest)
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(2 * partitions(df), total // GROUP_BYTES)
    buckets = max(2 * partitions(df), total // (32 * BUCKET_ENTRIES))
    docs = rows.select(F.pmod(F.xxhash64("doc_id"), F.lit(groups)).alias("part"), "*")
    twice = repeated(anchor_blocks(docs, length, buckets))
    spans = removed_spans(context_blocks(docs, twice, length, buckets), length)
    return cut_out(docs, spans, length, with_text).withColumn("doc_id", F.nullif("doc_id", F.lit(NO_ID)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6_suffix_dedup: all documents without their bytes in 100-byte strings that start earlier."""
    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept")
