"""Operator 9: byte-level BPE encoding and decoding by a sentencepiece model written from a rank file.

The model is serialised here, field by field: piece i is the token of rank i with each byte mapped to a printable
character, its score is -i, and normalisation is the identity, so sentencepiece merges the same pairs in the same order
as the rank file asks for. Each match of the pre-token pattern is encoded on its own; ids are decoded by the inverse
byte mapping.

Texts are cut into units at single spaces between two non-space characters. No match of the pattern reaches over such a
place, so a unit's ids do not depend on its neighbours, and a worker keeps the ids of units it has seen (a bounded
dictionary; a full one is emptied, which costs time and changes nothing).

Defined cases: null or empty text has no tokens and the hash of the empty string; rows are independent, so ties, repeated
rows and empty tables need no rule; other columns are ignored and may have any name.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import doc_text, table

#: A space with no white space on either side: pre-tokens never reach over it.
SAFE_CUT = re.compile(r"(?<=\S) (?=\S)")
#: A space next to white space or at the end, where str.split(" ") would not cut safely.
UNSAFE = re.compile(r" (?:\s|\Z)")
#: A character that stands for no byte.
SEPARATOR = "\x01"
#: Units and bytes of text that a worker's dictionary holds before it is emptied.
CACHE_UNITS = 1_000_000
CACHE_CHARS = 16_000_000


def byte_chars() -> list[str]:
    """The printable character that stands for each byte: itself where printable, else the next one from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, spare = [""] * 256, 256
    for b in range(256):
        if b in printable:
            out[b] = chr(b)
        else:
            out[b] = chr(spare)
            spare += 1
    return out


def varint(n: int) -> bytes:
    out = bytearray()
    n &= (1 << 64) - 1
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def field(number: int, value: bytes | int | float | bool) -> bytes:
    """One protobuf field: bytes by length, floats as 32 bits, integers and booleans as varints."""
    if isinstance(value, bytes):
        return varint(number << 3 | 2) + varint(len(value)) + value
    if isinstance(value, float):
        return varint(number << 3 | 5) + struct.pack("<f", value)
    return varint(number << 3) + varint(int(value))


def read_ranks(data: bytes) -> list[bytes]:
    """Tokens in rank order from the lines ``base64 rank`` of a rank file."""
    tokens = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, data.splitlines())}
    return [tokens[i] for i in range(len(tokens))]


def sentencepiece_model(tokens: list[bytes]) -> bytes:
    """A serialised sentencepiece BPE model whose piece ids are the ranks; the unknown piece comes last."""
    chars = byte_chars()
    normal, unknown = 1, 2
    pieces = [field(1, "".join(chars[b] for b in t).encode()) + field(2, float(-i)) + field(3, normal) for i, t in enumerate(tokens)]
    pieces.append(field(1, b"<unk>") + field(2, 0.0) + field(3, unknown))
    bpe = 2
    trainer = field(3, bpe) + field(4, len(pieces)) + field(40, len(tokens)) + field(41, -1) + field(42, -1) + field(43, -1)
    normalizer = field(1, b"identity") + field(2, b"") + field(3, False) + field(4, False) + field(5, False)
    return b"".join(field(1, p) for p in pieces) + field(2, trainer) + field(3, normalizer)


class Units:
    """The value of each unit of a text, by a bounded dictionary over ``encode``.

    ``encode`` maps a list of different units to their values (bytes). Units after the first carry a leading space, which
    is not part of the key in ``rest``. A dictionary of more than ``most`` units is emptied before the next text.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]], most: int = CACHE_UNITS) -> None:
        self.encode, self.most = encode, most
        self.first: dict[str, bytes] = {}
        self.rest: dict[str, bytes] = {}
        self.chars = 0

    def fill(self, known: dict[str, bytes], units: list[str], lead: str) -> None:
        new = [u for u in dict.fromkeys(units) if u not in known]
        if new:
            known.update(zip(new, self.encode([lead + u for u in new]), strict=True))
            self.chars += sum(map(len, new))

    def values(self, text: str) -> list[bytes]:
        if not text:
            return []
        head, *tail = SAFE_CUT.split(text) if UNSAFE.search(text) else text.split(" ")
        if not head and tail:  # the text starts with a space
            head = " " + tail.pop(0)
        if len(self.rest) + len(self.first) > self.most or self.chars > CACHE_CHARS:
            self.first, self.rest, self.chars = {}, {}, 0
        if head not in self.first:
            self.fill(self.first, [head], "")
        out = list(map(self.rest.get, tail))
        if None in out:
            self.fill(self.rest, tail, " ")
            out = list(map(self.rest.get, tail))
        return [self.first[head], *out]


class BytePairCodec:
    """Encodes and decodes with the serialised model; one per Python worker and model."""

    _made: dict[tuple[str, str], BytePairCodec] = {}

    @classmethod
    def of(cls, ranks: bytes, pattern: str) -> BytePairCodec:
        key = (hashlib.sha256(ranks).hexdigest(), pattern)
        if key not in cls._made:
            cls._made[key] = cls(ranks, pattern)
        return cls._made[key]

    def __init__(self, ranks: bytes, pattern: str) -> None:
        import regex
        import sentencepiece

        self.tokens = read_ranks(ranks)
        self.ids = {t: i for i, t in enumerate(self.tokens)}
        self.model = sentencepiece.SentencePieceProcessor(model_proto=sentencepiece_model(self.tokens))
        self.unknown = self.model.unk_id()
        self.find = regex.compile(pattern).findall
        self.table = str.maketrans({chr(b): c for b, c in enumerate(byte_chars())})
        inverse = {c: b for b, c in enumerate(byte_chars())}
        self.pieces = [bytes(inverse[c] for c in self.model.id_to_piece(i)) for i in range(len(self.tokens))]
        self.units = Units(self.encode_units)

    def encode_pretokens(self, pretokens: list[str]) -> list[list[int]]:
        """Ids of each pre-token; one that is itself a token needs no merge."""
        raw = [p.encode() for p in pretokens]
        out: list[list[int] | None] = [[self.ids[r]] if r in self.ids else None for r in raw]
        miss = [i for i, x in enumerate(out) if x is None]
        # one call for all: no piece holds the separator, so no merge reaches over it, and it comes back as the unknown id
        joined = self.model.encode(SEPARATOR.join([raw[i].decode("latin-1").translate(self.table) for i in miss]) + SEPARATOR) if miss else []
        start = 0
        for i in miss:
            end = joined.index(self.unknown, start)
            out[i] = joined[start:end]
            start = end + 1
        return out

    def encode_units(self, units: list[str]) -> list[bytes]:
        """For each unit its ids as little-endian unsigned 32-bit numbers."""
        split = [self.find(u) for u in units]
        flat = list(dict.fromkeys(p for pretokens in split for p in pretokens))
        known = {p: struct.pack(f"<{len(ids)}I", *ids) for p, ids in zip(flat, self.encode_pretokens(flat), strict=True)}
        return [b"".join([known[p] for p in pretokens]) for pretokens in split]

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(self.units.values(text)), dtype="<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.pieces.__getitem__, ids.tolist()))


class Digests:
    """Decimal ids and decoded bytes of units, kept beside their ids."""

    def __init__(self, codec: BytePairCodec) -> None:
        self.codec = codec
        self.decimal: dict[bytes, bytes] = {}
        self.decoded: dict[bytes, bytes] = {}

    def of(self, text: str) -> tuple[int, str, str]:
        values = self.codec.units.values(text)
        if len(self.decimal) > CACHE_UNITS:
            self.decimal, self.decoded = {}, {}
        decimal = list(map(self.decimal.get, values))
        if None in decimal:
            for v in {v for v, x in zip(values, decimal, strict=True) if x is None}:
                ids = np.frombuffer(v, dtype="<u4")
                self.decimal[v] = "".join([f"{i} " for i in ids.tolist()]).encode()
                self.decoded[v] = self.codec.decode(ids)
            decimal = list(map(self.decimal.get, values))
        n = sum(map(len, values)) // 4
        ids_text = b"".join(decimal)[:-1]
        back = b"".join(map(self.decoded.__getitem__, values))
        return n, hashlib.sha256(ids_text).hexdigest(), hashlib.sha256(back).hexdigest()


def encode(df: DataFrame, ranks: bytes, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) of every text, whole."""
    given = df.sparkSession.sparkContext.broadcast((ranks, pattern))  # one vocabulary file, about 1 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = BytePairCodec.of(*given.value)
        for batch in batches:
            ids = [codec.encode(t) for t in batch.column(1).to_pylist()]
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, ids)]), pa.int32()), pa.array(np.concatenate([np.empty(0, "<u4"), *ids]).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["doc_id", "ids"])

    return doc_text(df, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>")


def decode(df: DataFrame, ranks: bytes, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, data binary): the bytes that the ids stand for; null ids give null."""
    given = df.sparkSession.sparkContext.broadcast((ranks, pattern))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = BytePairCodec.of(*given.value)
        for batch in batches:
            data = [None if ids is None else codec.decode(np.array(ids, dtype=np.int64)) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], names=["doc_id", "data"])

    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).alias("ids")).mapInArrow(run, "doc_id long, data binary")


def digests(df: DataFrame, ranks: bytes, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every text: encoded, then decoded from the ids."""
    given = df.sparkSession.sparkContext.broadcast((ranks, pattern))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = BytePairCodec.of(*given.value)
        made = Digests(codec)
        for batch in batches:
            rows = [made.of(t) for t in batch.column(1).to_pylist()]
            n, ids, back = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(back, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return doc_text(df, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9_byte_bpe: every whole text of documents through the byte-level vocabulary and back."""
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = f.read()
    return digests(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
