"""Operator 7: embedding near-duplicates by an inverted multi-index.

Vectors are normalised and cut into two halves; each half has its own codebook, so the pairs of codes form a product grid of
cells. Every vector is indexed in the cell of its two nearest codes. As a query it visits cells in multi-sequence order (by
the sum of its halves' squared distances to the two codes; the nearest cell is its own) and is compared with everything
indexed there, in double precision. How many cells are visited is chosen by the recall on sample queries that are compared
with all vectors: the least number at which the share of their neighbours found, over all pairs and also as a mean over
queries, reaches ``target_recall``. A pair counts once whichever side finds it, so the recall is higher. Queries are added,
up to the whole sample, until ENOUGH of them have a neighbour. If MOST_CELLS cells do not reach the target, or too few queries
have a neighbour to tell, all vectors are compared with all, block by block.

Equal vectors form one class; the search runs over classes, and copies are counted, not compared. What leaves a task is a
count for each vector and a spanning forest of the links found there, never the pairs. Cells with more than ``block``
queries or vectors are dealt into blocks, every query block against every vector block, so no cap drops anything.

The codebooks are fitted on at most SAMPLE vectors, those with the smallest hash of vec_id; every vector is indexed. Codes a
half: about the root of an eighth of the classes, a power of two, 256 at most.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components link with nothing, are their own
component and are kept; shorter vectors are filled up with zeros; repeated rows are copies, and rows with one vec_id are
vectors of their own; ties between codes or cells go to the smaller number; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpointed, table
from .components import components

SAMPLE = 20_000
#: Sample queries that are asked first, how many with a neighbour are enough, and the most cells that are visited.
QUERIES, ENOUGH, MOST_CELLS = 1024, 100, 64
BLOCK = 2048


def usable(col: str) -> Column:
    good = F.forall(col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(good & F.exists(col, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Normalised rows in double precision; short vectors are filled up with zeros."""
    out = np.zeros((len(column), dims))
    flat, offsets = column.flatten().to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    offsets = offsets - offsets[0]
    if len(flat) == out.size:
        out[:] = flat.reshape(out.shape)
    else:
        for i, (a, b) in enumerate(zip(offsets, offsets[1:], strict=False)):
            out[i, : b - a] = flat[a:b]
    out /= np.abs(out).max(axis=1, keepdims=True)  # so that the norm of no finite vector overflows
    return out / np.linalg.norm(out, axis=1, keepdims=True)


def distances(x: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return (x**2).sum(axis=1)[:, None] - 2 * x @ codes.T + (codes**2).sum(axis=1)


def codebook(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """k-means from evenly spread rows; a code that nothing is nearest to stays where it is."""
    codes = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)].copy()
    for _ in range(rounds):
        near = distances(x, codes).argmin(axis=1)
        count = np.bincount(near, minlength=len(codes))
        sums = np.zeros_like(codes)
        np.add.at(sums, near, x)
        codes[count > 0] = sums[count > 0] / count[count > 0, None]
    return codes


class Grid:
    """The product grid of two codebooks."""

    def __init__(self, sample: np.ndarray, k: int) -> None:
        self.half = (sample.shape[1] + 1) // 2
        self.books = [codebook(part, k) if part.shape[1] else np.zeros((1, 0)) for part in (sample[:, : self.half], sample[:, self.half :])]

    def visit(self, x: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
        """(cells in multi-sequence order, their scores) of each row.

        The cell of the i-th and j-th nearest codes comes after the (i + 1) * (j + 1) - 1 cells that are nearer in both,
        so only cells with (i + 1) * (j + 1) <= ``cells`` can be among the first.
        """
        d = [distances(p, b) for p, b in zip((x[:, : self.half], x[:, self.half :]), self.books, strict=True)]
        order = [np.argsort(y, axis=1, kind="stable")[:, :cells] for y in d]
        near = [np.take_along_axis(y, o, axis=1) for y, o in zip(d, order, strict=True)]
        grid = np.array([(i, j) for i in range(order[0].shape[1]) for j in range(order[1].shape[1]) if (i + 1) * (j + 1) <= cells])
        score = near[0][:, grid[:, 0]] + near[1][:, grid[:, 1]]
        number = order[0][:, grid[:, 0]] * len(self.books[1]) + order[1][:, grid[:, 1]]
        first = np.lexsort((number, score), axis=1)[:, :cells]
        return np.take_along_axis(number, first, axis=1), np.take_along_axis(score, first, axis=1)

    def score(self, x: np.ndarray, cell: np.ndarray) -> np.ndarray:
        """Scores of given cells, a column for each, of each row of x."""
        d = [distances(p, b) for p, b in zip((x[:, : self.half], x[:, self.half :]), self.books, strict=True)]
        return d[0][:, cell // len(self.books[1])] + d[1][:, cell % len(self.books[1])]


def neighbours_by_rank(vectors: DataFrame, grid: Grid, queries: np.ndarray, dims: int, least: float, most: int) -> np.ndarray:
    """Of each query, how many neighbours are in its first, second ... cell, and at ``most`` in all later ones."""
    _, scores = grid.visit(queries, most)
    given = vectors.sparkSession.sparkContext.broadcast((grid, queries, scores))  # bounded by SAMPLE and MOST_CELLS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grid, queries, scores = given.value
        for batch in batches:
            x = matrix(batch.column(0), dims)
            own = grid.visit(x, 1)[0][:, 0]
            out: list[tuple[int, int, int]] = []
            for i in range(0, len(queries), QUERIES):
                near = queries[i : i + QUERIES] @ x.T
                hit = (near >= least) & (near < 1 - 1e-12)
                for q in np.flatnonzero(hit.any(axis=1)):
                    value = grid.score(queries[i + q : i + q + 1], own[hit[q]])[0]
                    # past the visited cells, whatever the size of the grid
                    rank = np.searchsorted(scores[i + q], value - 1e-12)
                    rank = np.where(rank < scores.shape[1], rank, most)
                    out += [(i + int(q), int(r), int(n)) for r, n in zip(*np.unique(rank, return_counts=True), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], pa.int64()) for k in range(3)], names=["q", "rank", "n"])

    found = vectors.select("embedding").mapInArrow(run, "q long, rank long, n long").groupBy("q", "rank").agg(F.sum("n").alias("n")).collect()
    n = np.zeros((len(queries), most + 1))
    for r in found:
        n[r.q, r.rank] += r.n
    return n


def cells_to_visit(vectors: DataFrame, grid: Grid, sample: np.ndarray, total: int, dims: int, least: float, target: float) -> int | None:
    """The least number of cells that reaches the target recall on sample queries.

    None if MOST_CELLS do not, or if too few of the sample, which is not all of the ``total`` vectors, have a neighbour.
    """
    n, asked = np.zeros((0, MOST_CELLS + 1)), 0
    while asked < len(sample) and len(n) < ENOUGH:
        queries = sample[asked : max(QUERIES, 4 * asked)]
        found = neighbours_by_rank(vectors, grid, queries, dims, least, MOST_CELLS)
        n, asked = np.concatenate([n, found[found.sum(axis=1) > 0]]), asked + len(queries)
    if len(n) < ENOUGH and asked < total:
        return None
    if not len(n):
        return 1
    over_pairs = n.sum(axis=0).cumsum() / n.sum()
    over_queries = (n.cumsum(axis=1) / n.sum(axis=1, keepdims=True)).mean(axis=0)
    reached = np.flatnonzero(np.minimum(over_pairs, over_queries)[:MOST_CELLS] >= target)
    return int(reached[0]) + 1 if len(reached) else None


FOUND = "a long, b long, n long"


def search(vectors: DataFrame, grid: Grid, cells: int, dims: int, least: float, block: int) -> DataFrame:
    """For each task's vectors (a, a, copies linked with) and a spanning forest of its links (a, b, 0)."""
    given = vectors.sparkSession.sparkContext.broadcast(grid)  # two codebooks of at most 256 codes

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grid = given.value
        for batch in batches:
            x = matrix(batch.column(2), dims)
            seen = grid.visit(x, cells)[0].astype("<i4")
            times = seen.shape[1]
            row = np.repeat(np.arange(len(x)), times)
            lists = pa.array([s.tobytes() for s in seen], pa.binary())
            data = pa.array([v.tobytes() for v in x], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(seen.ravel().astype(np.int64)), pa.array(np.tile(np.arange(times), len(x)) == 0), batch.column(0).take(pa.array(row)), batch.column(1).take(pa.array(row)), lists.take(pa.array(row)), data.take(pa.array(row))],
                names=["cell", "own", "node", "copies", "seen", "vector"],
            )

    def compare(part: pa.Table) -> pa.Table:
        asks = np.array(part.column("asks").to_pylist())
        node, copies = (part.column(c).to_numpy() for c in ("node", "copies"))
        x = np.frombuffer(b"".join(part.column("vector").to_pylist()), "<f8").reshape(len(node), dims)
        seen = np.frombuffer(b"".join(part.column("seen").to_pylist()), "<i4").reshape(len(node), -1)
        q, v = np.flatnonzero(asks), np.flatnonzero(~asks)
        label = {}
        count = np.zeros(len(node), np.int64)
        if len(q) and len(v):
            linked = np.zeros((len(q), len(v)), dtype=bool)
            for i in range(0, len(q), 256):
                linked[i : i + 256] = x[q[i : i + 256]] @ x[v].T >= least
                linked[i : i + 256] &= node[q[i : i + 256]][:, None] != node[v]
                a, b = np.nonzero(linked[i : i + 256])
                a += i
                np.add.at(count, q[a], copies[v[b]])
                # the other side does not find it: this cell counts it for both
                missed = ~(seen[v[b]] == seen[q[a], :1]).any(axis=1)
                np.add.at(count, v[b[missed]], copies[q[a[missed]]])
            some_q, some_v = np.flatnonzero(linked.any(axis=1)), np.flatnonzero(linked.any(axis=0))
            if len(some_q):
                linked = linked[np.ix_(some_q, some_v)]
                of_q, of_v = node[q[some_q]].copy(), node[v[some_v]].copy()
                far = np.iinfo(np.int64).max
                while True:
                    new_q = np.minimum(of_q, np.where(linked, of_v, far).min(axis=1))
                    new_v = np.minimum(of_v, np.where(linked.T, new_q, far).min(axis=1))
                    if (new_q == of_q).all() and (new_v == of_v).all():
                        break
                    of_q, of_v = new_q, new_v
                for n, root in zip([*node[q[some_q]].tolist(), *node[v[some_v]].tolist()], [*of_q.tolist(), *of_v.tolist()], strict=True):
                    label[n, root] = None
        some = np.flatnonzero(count)
        a = [*node[some].tolist(), *[n for n, root in label if n != root]]
        b = [*node[some].tolist(), *[root for n, root in label if n != root]]
        n = [*count[some].tolist(), *[0] * (len(a) - len(some))]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "n": pa.array(n, pa.int64())})

    rows = vectors.select("node", "copies", "embedding").mapInArrow(visits, "cell long, own boolean, node long, copies long, seen binary, vector binary")
    sizes = vectors.select("node", "copies", "embedding").mapInArrow(visits, "cell long, own boolean, node long, copies long, seen binary, vector binary")
    sizes = sizes.groupBy("cell").agg(F.count("*").alias("q"), F.count_if("own").alias("v"))
    sizes = sizes.select("cell", *(F.greatest(F.ceil(F.col(c) / block), F.lit(1)).cast("long").alias(f"{c}_blocks") for c in ("q", "v")))
    rows = rows.join(F.broadcast(sizes), "cell")  # a row for each of at most 65,536 cells
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    asks = rows.select("cell", F.lit(True).alias("asks"), F.pmod(F.xxhash64("node"), "q_blocks").alias("i"), F.explode(F.sequence(zero, F.col("v_blocks") - one)).alias("j"), "node", "copies", "seen", "vector")
    held = rows.filter("own").select("cell", F.lit(False).alias("asks"), F.explode(F.sequence(zero, F.col("q_blocks") - one)).alias("i"), F.pmod(F.xxhash64("node"), "v_blocks").alias("j"), "node", "copies", "seen", "vector")
    return asks.unionAll(held).groupBy("cell", "i", "j").applyInArrow(compare, FOUND)


def near_duplicates(df: DataFrame, least: float = 0.9, target_recall: float = 0.99, id_col: str = "vec_id", vector_col: str = "embedding", block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every vector."""
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("embedding"))
    rows = rows.withColumn("good", usable("embedding"))
    key = ["h1", "h2"]
    rows = rows.withColumns({"h1": F.expr("if(good, xxhash64(embedding), null)"), "h2": F.expr("if(good, xxhash64(embedding, 7L), null)")})
    classes = rows.filter("good").groupBy(*key).agg(F.min(F.struct("vec_id", "embedding")).alias("least"), F.count("*").alias("copies"))
    classes = checkpointed(classes.select(*key, F.col("least.vec_id").alias("node"), "copies", F.col("least.embedding").alias("embedding")))
    stats = classes.agg(F.count("*").alias("n"), F.max(F.size("embedding")).alias("dims")).first()
    links = None
    if stats.n > 1:
        dims = stats.dims
        sample = classes.orderBy(F.xxhash64("node"), "node").limit(SAMPLE).select("embedding").toArrow().column(0).combine_chunks()
        sample = matrix(sample, dims)
        codes = max(1, min(256, 2 ** round(math.log2(max(1.0, math.sqrt(stats.n / 8))))))
        grid = Grid(sample, codes)
        cells = cells_to_visit(classes, grid, sample, stats.n, dims, least, target_recall)
        if cells is None:
            grid, cells = Grid(sample, 1), 1  # one cell of all vectors, dealt into blocks
        links = checkpointed(search(classes, grid, min(cells, len(grid.books[0]) * len(grid.books[1])), dims, least, block))
    if links is not None:
        counts = links.filter("a = b").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("found"))
        classes = classes.join(counts, "node", "left").join(components(links.select("a", "b")), "node", "left")
        of_class = classes.select(*key, (F.coalesce("found", F.lit(0)) + F.col("copies") - 1).alias("n"), F.coalesce("component", "node").alias("c"))
    else:
        of_class = classes.select(*key, (F.col("copies") - 1).alias("n"), F.col("node").alias("c"))
    out = rows.select("vec_id", *key).join(of_class, key, "left")
    out = out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("c", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7_embedding_near_dup: links and components of all embeddings with a cosine of 0.9 or more."""
    return near_duplicates(table(spark, sf_dir, "embeddings"))
