"""Operator 3: vector best-fit packing of tokenised documents into sequences.

A document's ids are those of the tokenizer file plus an end id. Documents longer than a sequence are cut into full pieces
with the remainder first; only the remainders have to be packed. Each bin has three residual capacities: tokens, documents
and attention cost (the sum of squared lengths). Pieces are taken by falling length, and each goes to the bin that fits
under every constraint and leaves the least weighted residual norm; if none fits, a bin is opened. Tokens weigh so much
more than the others that these only break ties; both weights and capacities are parameters.

Pieces are packed in groups by a hash of (doc_id, piece), a group for every 25,000 documents, so a task's memory is bounded
and the work spreads; a group leaves at most a few bins less full than one packing of everything would. A piece that alone
exceeds a capacity gets a bin of its own.

Defined cases: null or empty text is the end id alone; repeated doc_ids are packed as separate documents (told apart by
nothing but their rows); equal lengths are ordered by (doc_id, piece, start); an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import json
import math
import os
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import Units, byte_chars
from .common import doc_text, lean, parts, table

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECES + ", sequence_id long, offset long"


#: Fixed value: how the byte-level pre-tokenizer of tokenizer files splits a text.
BYTE_LEVEL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters from here on may be classed differently by two libraries' versions of Unicode.
LATIN_END = "\u0250"
#: Units that a worker keeps the ids of. A worker lives on through a session's later stages, and ten times as many take some
#: 130 MB more of it and save hardly any time, since most units come once.
KEPT_UNITS = 100_000


def rank_encoding(file: dict) -> tiktoken.Encoding | None:
    """The same byte-level BPE by ranks, about ten times as fast on unseen words.

    Only if the file's merges make their tokens in the order of the ids, so that both choose the same merges, and nothing
    but the byte-level split stands before them; otherwise None.
    """
    model, split = file["model"], file["pre_tokenizer"] or {}
    vocabulary = model["vocab"]
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    made = [vocabulary.get("".join(m)) for m in merges]
    plain = split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space") and file["normalizer"] is None
    if not plain or None in made or made != sorted(made) or len(made) + 256 != made[-1] + 1:
        return None
    byte = {c: b for b, c in enumerate(byte_chars())}
    ranks = {bytes(byte[c] for c in token): i for token, i in vocabulary.items() if i <= made[-1]}
    return tiktoken.Encoding("ranks", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={})


class TokenizerIds:
    """Ids by a tokenizers file, by units of text; strings of special tokens keep their meaning."""

    _made: dict[int, TokenizerIds] = {}

    @classmethod
    def of(cls, data: str) -> TokenizerIds:
        key = hash(data)
        if key not in cls._made:
            cls._made[key] = cls(data)
        return cls._made[key]

    def __init__(self, data: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(data)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.ranked = rank_encoding(json.loads(data))
        self.units = Units(self.encode_units, KEPT_UNITS)

    def encode_units(self, units: list[str]) -> list[bytes]:
        """For each unit its ids. Latin units go through the file's merges as ranks, all others through the tokenizer."""
        latin = [self.ranked is not None and max(u, default="") < LATIN_END for u in units]
        rest = iter(self.tokenizer.encode_batch([u for u, x in zip(units, latin, strict=True) if not x], add_special_tokens=False))
        return [array("I", self.ranked.encode_ordinary(u) if x else next(rest).ids).tobytes() for u, x in zip(units, latin, strict=True)]

    def raw(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        return b"".join(self.units.values(text))


def pieces(df: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): each document's pieces of at most ``capacity`` ids, the first the shorter."""
    given = df.sparkSession.sparkContext.broadcast(tokenizer)  # one vocabulary file, 1.5 MB
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = TokenizerIds.of(given.value)
        for batch in (part for whole in batches for part in parts(whole)):
            out: list[tuple[int, int, int, int, int]] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                raw = ids_of.raw(text) + end
                n = len(raw) // 4
                at, first = 0, n % capacity or capacity
                for k in range(-(-n // capacity)):
                    length = capacity if k else first
                    out.append((doc, k, at, length, zlib.crc32(raw[4 * at : 4 * (at + length)])))
                    at += length
            columns = list(zip(*out, strict=True)) if out else [()] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return doc_text(df, id_col, text_col).mapInArrow(lean(run), PIECES)


def best_fit(lengths: np.ndarray, capacity: int, max_docs: int, max_attention: float, weights: tuple[float, float, float]) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length, given in falling order.

    A bin's residual after taking the piece is the vector (tokens, documents, attention), each as a share of its capacity;
    among the bins where no part is negative the one with the least weighted sum of squares wins, the oldest on ties.
    """
    n = len(lengths)
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    full = int(np.searchsorted(-lengths, -capacity, side="right"))  # these leave no room
    bins[:full] = np.arange(full)
    tokens, docs, attention = (np.empty(n + 1) for _ in range(3))
    names = np.empty(n + 1, np.int64)
    open_bins, made = 0, full
    least = int(lengths[-1]) if n else 0
    for i, length in enumerate(lengths[full:].tolist(), full):
        cost = float(length) * length
        t, d, a = tokens[:open_bins] - length, docs[:open_bins] - 1, attention[:open_bins] - cost
        fits = (t >= 0) & (d >= 0) & (a >= 0)
        at = -1
        if fits.any():
            norm = weights[0] * (t / capacity) ** 2 + weights[1] * (d / max_docs) ** 2 + weights[2] * (a / max_attention) ** 2
            norm[~fits] = np.inf
            at = int(norm.argmin())
        if at < 0:
            at = open_bins
            tokens[at], docs[at], attention[at], names[at] = capacity, max_docs, max_attention, made
            made += 1
            open_bins += 1
        bins[i], offsets[i] = names[at], capacity - tokens[at]
        tokens[at] -= length
        docs[at] -= 1
        attention[at] -= cost
        if tokens[at] < least or docs[at] < 1 or attention[at] < least * least:  # nothing fits any more
            open_bins -= 1
            for column in (tokens, docs, attention, names):
                column[at] = column[open_bins]
    return bins, offsets


def pack(
    found: DataFrame,
    capacity: int = 1024,
    max_docs: int | None = None,
    max_attention: float | None = None,
    weights: tuple[float, float, float] = (1.0, 1e-9, 1e-9),
    groups: int = 1,
) -> DataFrame:
    """Adds sequence_id and offset to ``pieces``. Without limits of their own, documents and attention never bind."""
    max_docs = max_docs or capacity
    max_attention = max_attention or float(capacity) * capacity

    def fill(part: pa.Table) -> pa.Table:
        part = part.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("start", "ascending")])
        bins, offsets = best_fit(part["length"].to_numpy(), capacity, max_docs, max_attention, weights)
        sequences = bins * groups + part["group_id"].to_numpy()
        return part.drop_columns("group_id").append_column("sequence_id", pa.array(sequences)).append_column("offset", pa.array(offsets))

    grouped = found.withColumn("group_id", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(groups)))
    return grouped.groupBy("group_id").applyInArrow(fill, PACKED)


def groups_for(df: DataFrame, group_docs: int = 25_000) -> int:
    """A group for every ``group_docs`` documents; the count needs no column of them."""
    return max(1, math.ceil(df.count() / group_docs))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op3_best_fit_packing: all documents in sequences of at most 1024 tokens."""
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        tokenizer = f.read()
    docs = table(spark, sf_dir, "documents")
    return pack(pieces(docs, tokenizer), groups=groups_for(docs))
