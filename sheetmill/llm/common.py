"""What the operators of this subpackage share: columns, checkpoints and hashing of whole Arrow batches."""

from __future__ import annotations

import ctypes
import re
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MASK = np.uint64(0xFFFFFFFFFFFFFFFF)
#: Bytes of text that one vectorised step handles; bounds a worker's memory whatever the batch holds.
CHUNK_BYTES = 1 << 19
#: Rows of a file of a small checkpoint.
ROWS_A_FILE = 2_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` cut off from its lineage by a reliable checkpoint in ``spark.checkpoint.dir``.

    A folder is made here only where the session has none and runs in one process; on a cluster that is an error.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            folder = tempfile.mkdtemp(prefix="checkpoint-")
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def checkpointed_small(df: DataFrame) -> DataFrame:
    """As ``checkpointed``, for rows of a few numbers: in one file for every ROWS_A_FILE rows, so few rows make few files.

    The rows are counted in a copy on the executors' disks, which Spark computes anew where it is lost.
    """
    kept = df.persist(StorageLevel.DISK_ONLY)
    try:
        return checkpointed(kept.coalesce(max(1, min(partitions(df), -(-kept.count() // ROWS_A_FILE)))))
    finally:
        kept.unpersist()


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often and in whatever loops ``use`` refers to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def doc_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns an operator reads as (doc_id long, text string); null text becomes empty."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def give_back(out=None):
    """``out``, after giving back to the system what the worker no longer needs; workers live on for others."""
    pa.default_memory_pool().release_unused()
    if (trim := getattr(ctypes.CDLL(None), "malloc_trim", None)) is not None:  # glibc alone has it
        trim(0)
    return out


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run``, giving back memory when a partition ends."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return wrapped


def lean_group(run: Callable[[pa.Table], pa.Table]):
    """``run`` over groups of some MB, giving back memory after each."""
    return lambda part: give_back(run(part))


def lean_cogroup(run: Callable[[pa.Table, pa.Table], pa.Table]):
    """As ``lean_group``, over two groups of one key."""
    return lambda left, right: give_back(run(left, right))


def parts(batch: pa.RecordBatch, rows: int = 256) -> Iterator[pa.RecordBatch]:
    """A batch in runs of rows, so that Python objects are made of a few texts at a time."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def chunks(ids: pa.Array, texts: pa.Array, limit: int = CHUNK_BYTES):
    """(ids, utf-8 bytes as uint8, offsets) of consecutive runs of rows with about ``limit`` bytes each.

    One text longer than the limit is a run of its own, whole. The ids stay an Arrow array, nulls included.
    """
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.empty(0, np.uint8)
    start = 0
    while start < len(ids):
        end = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        end = min(max(end, start + 1), len(ids))
        yield ids.slice(start, end - start), data[offsets[start] : offsets[end]], offsets[start : end + 1] - offsets[start]
        start = end


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit changes every output bit with probability one half."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def mixed(value: int) -> int:
    return int(mix(np.array([value & int(MASK)], dtype=np.uint64))[0])


#: A random 64-bit value for each byte, and the odd base of the rolling polynomial.
BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.empty(max(n, 1), dtype=np.uint64)
    out[0] = 1
    size = 1
    while size < n:
        step = np.uint64(pow(base, size, 1 << 64))
        more = min(size, n - size)
        out[size : size + more] = out[:more] * step
        size += more
    return out[:n]


class Polynomial:
    """Rolling hashes of byte ranges, from one prefix sum over a whole chunk."""

    def __init__(self) -> None:
        self.up = self.down = np.empty(0, np.uint64)

    def prepare(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, 2 * CHUNK_BYTES)
            self.up, self.down = powers(BASE, n), powers(INVERSE, n)

    def prefix(self, data: np.ndarray) -> np.ndarray:
        self.prepare(len(data) + 1)
        out = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(BYTE_VALUES[data] * self.up[: len(data)], out=out[1:])
        return out

    def ranges(self, prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Mixed hashes of data[starts:ends]; equal ranges get equal values wherever they stand."""
        return mix((prefix[ends] - prefix[starts]) * self.down[starts])

    def windows(self, prefix: np.ndarray, k: int) -> np.ndarray:
        """Mixed hashes of every k consecutive bytes."""
        n = len(prefix) - k
        return mix((prefix[k:] - prefix[:-k]) * self.down[:n]) if n > 0 else np.empty(0, np.uint64)


#: ASCII white space as the contracts name it: space and 9 to 13.
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word of a chunk, and for each text the index of its first word (one more at the end)."""
    space = IS_SPACE[data]
    first = np.empty(len(data), dtype=bool)
    first[:1] = True
    first[1:] = space[:-1]
    last = np.empty(len(data), dtype=bool)
    last[-1:] = True
    last[:-1] = space[1:]
    edges = offsets[1:-1]
    inner = edges[(edges > 0) & (edges < len(data))]
    first[inner] = True
    last[inner - 1] = True
    starts = np.flatnonzero(first & ~space)
    ends = np.flatnonzero(last & ~space) + 1
    return starts, ends, np.searchsorted(starts, offsets)
