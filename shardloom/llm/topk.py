"""Exact search for the vectors of the largest inner product, by branch and bound over vertical columns.

Queries and candidates meet in the cells of a grid, each a block of queries of bounded size against a block of
candidates of bounded size. Within a cell the candidates lie dimension by dimension, dimensions of much mass first.
Products are summed a few dimensions at a time; by Cauchy and Schwarz the rest of a sum cannot exceed the product of
the masses that the two vectors have left. Candidates whose sum so far plus this rest stays below a query's k-th best
are dropped, and those that survive are packed closely before the next dimensions are added. All sums are of whole
numbers and exact; the bounds are rounded up.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from shardloom.llm.common import column_of
from shardloom.session import as_written

SCALE, TOP = 64, 20
#: Most queries and candidates of a cell.
CELL_QUERIES, CELL_CANDIDATES = 16_384, 32_768
#: Queries and candidates that are multiplied at once, and dimensions per step.
TILE_QUERIES, TILE_CANDIDATES, STEP = 256, 2_048, 8
#: Below this share of pairs left, they are carried as pairs and no longer as a table.
SPARSE = 0.05
SLACK = 1 + 1e-9
FOUND = "qrow long, query_id long, vec_id long, score long"


def whole_vector(v: Column, scale: int) -> Column:
    """Components times ``scale``, rounded down; null for a vector that is null or has a null or non-finite component."""
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.when(fine, F.transform(v, lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Vectors of one length as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(len(column), dim)


class Best:
    """The best candidates of some queries so far: highest score first, ties to the smaller id, null ids last."""

    def __init__(self, n: int, k: int) -> None:
        self.n, self.k = n, k
        self.q, self.score, self.at = (np.empty(0, np.int64) for _ in range(3))
        self.least = np.full(n, -np.inf)

    def add(self, q: np.ndarray, score: np.ndarray, at: np.ndarray, order: np.ndarray) -> None:
        """``at`` are numbers of candidates, ``order`` their places by id."""
        q, score, at = (np.concatenate(x) for x in ((self.q, q), (self.score, score), (self.at, at)))
        by = np.lexsort((order[at], -score, q))
        q, score, at = q[by], score[by], at[by]
        first = np.searchsorted(q, np.arange(self.n))
        place = np.arange(len(q)) - first[q]
        keep = place < self.k
        last = place == self.k - 1
        self.least[q[last]] = score[last]
        self.q, self.score, self.at = q[keep], score[keep], at[keep]


def rest_of(v: np.ndarray) -> np.ndarray:
    """Mass left before each step of dimensions, and zero at the end: one row per vector."""
    cut = range(0, v.shape[1], STEP)
    mass = np.array([(v[:, a:a + STEP].astype(np.float64) ** 2).sum(axis=1) for a in cut]).reshape(len(cut), len(v))
    return np.concatenate([np.sqrt(np.cumsum(mass[::-1], axis=0)[::-1]) * SLACK, np.zeros((1, len(v)))])


def search_tile(q: np.ndarray, qrest: np.ndarray, c: np.ndarray, crest: np.ndarray, least: np.ndarray, own: np.ndarray,
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs ``(query, candidate, score)`` that can reach the queries' least scores; ``c`` has a row per dimension.

    ``own`` has the number of the query's own row in the tile, or a negative one.
    """
    dims, n = c.shape
    floor = least[:, None]
    alive = qrest[0][:, None] * crest[0][None, :] >= floor
    mine = np.flatnonzero((own >= 0) & (own < n))
    alive[mine, own[mine]] = False
    at = np.flatnonzero(alive.any(axis=0))
    c, crest, alive = c[:, at], crest[:, at], alive[:, at]
    sums = np.zeros((len(q), len(at)), q.dtype)
    for step, a in enumerate(range(0, dims, STEP), 1):
        sums += q[:, a:a + STEP] @ c[a:a + STEP]
        alive &= sums + qrest[step][:, None] * crest[step][None, :] >= floor
        if np.count_nonzero(alive) <= SPARSE * alive.size:
            qi, ci = np.nonzero(alive)
            s = sums[qi, ci]
            for more, b in enumerate(range(a + STEP, dims, STEP), step + 1):
                s = s + np.einsum("ij,ji->i", q[qi, b:b + STEP], c[b:b + STEP][:, ci])
                stay = s + qrest[more][qi] * crest[more][ci] >= least[qi]
                qi, ci, s = qi[stay], ci[stay], s[stay]
            return qi, at[ci], s.astype(np.int64)
        some = alive.any(axis=0)
        if np.count_nonzero(some) < 0.75 * len(some):
            at, c, crest, sums, alive = at[some], c[:, some], crest[:, some], sums[:, some], alive[:, some]
    qi, ci = np.nonzero(alive)
    return qi, at[ci], sums[qi, ci].astype(np.int64)


def search(queries: np.ndarray, qrows: np.ndarray, cands: np.ndarray, crows: np.ndarray, order: np.ndarray, k: int,
           ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(query, candidate, score)`` of the best ``k`` candidates of each query that are not its own row."""
    mass = (cands.astype(np.float64) ** 2).sum(axis=0)
    dims = np.argsort(-mass, kind="stable")
    queries, cands = queries[:, dims], cands[:, dims]
    norm = lambda v: np.sqrt((v.astype(np.float64) ** 2).sum(axis=1))
    by = np.argsort(-norm(cands), kind="stable")  # long vectors first: the bounds rise early
    limit = norm(queries).max(initial=0) * norm(cands).max(initial=0)
    if limit >= 2.0 ** 62:
        raise ValueError("scores do not fit a long")
    kind = np.float64 if limit < 2.0 ** 52 else np.int64
    flat = np.ascontiguousarray(cands[by].T.astype(kind))
    crest, place = rest_of(cands[by]), {int(r): i for i, r in enumerate(crows[by].tolist())}
    out = []
    for a in range(0, len(queries), TILE_QUERIES):
        q = queries[a:a + TILE_QUERIES].astype(kind)
        qrest, best = rest_of(q), Best(len(q), k)
        own = np.array([place.get(r, -1) for r in qrows[a:a + TILE_QUERIES].tolist()], np.int64)
        for b in range(0, flat.shape[1], TILE_CANDIDATES):
            end = b + TILE_CANDIDATES
            qi, ci, s = search_tile(q, qrest, flat[:, b:end], crest[:, b:end], best.least, np.where(own >= b, own - b, -1))
            best.add(qi, s, by[ci + b], order)
        out.append((best.q + a, best.at, best.score))
    return tuple(np.concatenate(x) for x in zip(*out))


def _cell(k: int):
    def work(queries: pa.Table, cands: pa.Table) -> pa.Table:
        names = [f.split()[0] for f in FOUND.split(", ")]
        if not queries.num_rows or not cands.num_rows:
            return pa.table({n: pa.array([], pa.int64()) for n in names})
        queries, cands = queries.combine_chunks().to_batches()[0], cands.combine_chunks().to_batches()[0]
        dim, ids = len(queries.column(queries.schema.get_field_index("v"))[0]), column_of(cands, "vec_id")
        far = np.iinfo(np.int64).max
        order = np.argsort(np.lexsort((ids.fill_null(far).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False))))
        qrows, crows = (column_of(t, "row").to_numpy() for t in (queries, cands))
        qi, ci, s = search(matrix(column_of(queries, "v"), dim), qrows, matrix(column_of(cands, "v"), dim), crows, order, k)
        return pa.table({"qrow": pa.array(qrows[qi]), "query_id": column_of(queries, "vec_id").take(pa.array(qi)),
                         "vec_id": ids.take(pa.array(ci)), "score": pa.array(s)})

    return work


def top_products(rows: DataFrame, is_query: Column, k: int = TOP, scale: int = SCALE, id_col: str = "vec_id",
                 vector_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each query the ``k`` other rows of the largest inner product.

    Components are scaled and rounded down to whole numbers first. Ties go to the smaller id, a null id last; all
    other rows if there are fewer. Vectors that are null or hold a null or non-finite component take no part; only
    vectors of one length are compared. A row is known by its place in the table, so that rows which repeat an id
    each search, and find one another. Extra columns are not read; an empty table gives an empty result. Scores must
    fit a long, else the search raises.
    """
    spark = rows.sparkSession
    v = whole_vector(F.col(vector_col), scale)
    table = as_written(rows.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"), F.coalesce(is_query, F.lit(False)).alias("asks"))
                       .filter("v is not null").withColumn("row", F.monotonically_increasing_id()), "vectors")
    sizes = table.agg(F.count(F.lit(1)).alias("n"), F.count_if("asks").alias("q")).first()
    down = max(1, ceil(sizes["q"] / CELL_QUERIES))
    across = max(ceil(sizes["n"] / CELL_CANDIDATES), ceil(2 * spark.sparkContext.defaultParallelism / down))
    dealt = lambda n: F.pmod(F.xxhash64("row"), F.lit(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    own, out = ["vec_id", "row", "v", F.size("v").alias("dim")], ["y", "x", "dim"]
    queries = table.filter("asks").select(*own, dealt(down).alias("y"), every(across).alias("x"))
    cands = table.select(*own, every(down).alias("y"), dealt(across).alias("x"))
    found = queries.groupBy(*out).cogroup(cands.groupBy(*out)).applyInArrow(_cell(k), FOUND)
    place = F.row_number().over(Window.partitionBy("qrow").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last()))
    return found.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
