"""Exact top-k inner products with block-at-a-time pruning.

Vectors become integers, floor(1024 x).  Their dimensions play the part of
terms.  Rows are cut into blocks by range of id; a block keeps the greatest and
least value of every dimension and, as its forward index, the vectors
themselves.  For a query, the sum over dimensions of the greater of
``q * greatest`` and ``q * least`` bounds every score in the block.  Blocks are
taken in the order of their bounds; one is scored whole, and a query is done
when the next bound falls below its k-th best score (at an equal bound an equal
score with a smaller id could still win).

Queries are the stated set: they go to the tasks in blocks of at most
``QUERY_BYTES``; candidates are read once per block of queries and never
shuffled.  Each task returns k rows per query at most, and the best k of those
are the result.

Rows whose vector is null, or holds a null or a non-finite component, or whose
id is null take no part; vectors of different lengths are never compared;
repeated rows are candidates as often as they occur (a query skips all rows of
its own id); fewer than k candidates give as many rows as there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telemetry_engine.llm import common as C

BLOCK_ROWS = 128
GROUP_ROWS = 16_384          # rows of a task whose blocks are ordered together
QUERY_BYTES = 8 << 20
NONE = -(1 << 62)  # below every score; its negative exists
SCHEMA = "query_id long, query long, vec_id long, score long"


def clean(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, v): rows with an id and a vector of finite components."""
    v = C.col(vector_col)
    return (vectors.select(C.col(id_col).cast("long").alias("vec_id"), v.cast("array<double>").alias("v"))
            .where(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
            .where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))))


def whole(v: np.ndarray) -> np.ndarray:
    """floor(1024 x) of doubles, as exact doubles."""
    return np.floor(v * 1024.0)


def _matrices(ids: np.ndarray, column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, matrix) for each length of vector."""
    n = np.asarray(pc.list_value_length(column))
    for k in np.unique(n):
        at = np.flatnonzero(n == k)
        flat = np.asarray(column.take(pa.array(at)).flatten(), float)
        yield ids[at], whole(flat).reshape(len(at), int(k))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T for whole numbers, exactly."""
    most = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1]
    if most < 2.0 ** 53:
        return (a @ b.T).astype(np.int64)
    big = [[int(x) for x in row] for row in b]
    return np.array([[sum(int(x) * y for x, y in zip(row, other)) for other in big] for row in a], np.int64
                    ).reshape(len(a), len(b))


class Best:
    """The k best (score, id) of each query so far."""

    def __init__(self, queries: int, k: int):
        self.score = np.full((queries, k), NONE, np.int64)
        self.id = np.full((queries, k), np.iinfo(np.int64).max, np.int64)
        self.k = k

    def kth(self) -> np.ndarray:
        return self.score[:, -1]

    def add(self, rows: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        """Scores of some queries with some vectors; ``ids`` the same for all of them."""
        s = np.concatenate([self.score[rows], score], axis=1)
        i = np.concatenate([self.id[rows], np.broadcast_to(ids, score.shape)], axis=1)
        order = np.lexsort((i, -s), axis=1)[:, :self.k]
        self.score[rows] = np.take_along_axis(s, order, 1)
        self.id[rows] = np.take_along_axis(i, order, 1)


def search(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, best: Best,
           at: np.ndarray, block_rows: int = BLOCK_ROWS) -> int:
    """Merge one group of vectors into ``best``; at: the queries' rows there.  Returns how many pairs were scored."""
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], vectors[order]
    edge = np.arange(0, len(ids), block_rows)
    high = np.maximum.reduceat(vectors, edge, axis=0)
    low = np.minimum.reduceat(vectors, edge, axis=0)
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    # floating bounds may lose a few units beyond 2**53; those are given back
    bound = up @ high.T + down @ low.T
    bound += np.abs(bound) * 2.0 ** -45
    by_bound = np.argsort(-bound, axis=1, kind="stable")
    live, scored = np.arange(len(query_ids)), 0
    for step in range(len(edge)):
        block = by_bound[live, step]
        kth = best.kth()[at[live]]
        more = (kth == NONE) | (bound[live, block] >= kth)
        live, block = live[more], block[more]
        if not len(live):
            break
        for b in np.unique(block):
            own = live[block == b]
            rows = slice(edge[b], edge[b] + block_rows)
            s = products(queries[own], vectors[rows])
            scored += s.size
            s[query_ids[own][:, None] == ids[rows][None, :]] = NONE
            best.add(at[own], s, ids[rows])
    return scored


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
          query_bytes: int = QUERY_BYTES) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of each query's k greatest inner products; ties to the smaller id.

    ``is_query``: a condition on ``vec_id``.  Equal query rows are one query; rows of one id with different
    vectors are queries of their own, each with its ranks.
    """
    spark = vectors.sparkSession
    rows = clean(vectors, id_col, vector_col)
    stated = rows.where(is_query).select("vec_id", "v", F.xxhash64("vec_id", "v").alias("query")).distinct()
    size = stated.agg(F.sum(8 * F.size("v") + 64)).first()[0] or 0
    n = max(1, -(-2 * size // query_bytes))
    out = None
    for part in range(n):
        block = stated.where(F.pmod("query", F.lit(n)) == part) if n > 1 else stated
        got = block.collect()  # at most about ``query_bytes``
        by_length: dict[int, list] = {}
        for r in got:
            by_length.setdefault(len(r["v"]), []).append(r)
        if not got:
            continue
        kept = spark.sparkContext.broadcast({
            d: (np.array([r["vec_id"] for r in own], np.int64), whole(np.array([r["v"] for r in own], float).reshape(len(own), d)),
                np.array([r["query"] for r in own], np.int64))
            for d, own in by_length.items()})

        def find(batches: Iterator[pa.RecordBatch], kept=kept) -> Iterator[pa.RecordBatch]:
            best = {d: Best(len(q[0]), k) for d, q in kept.value.items()}
            held: list[pa.RecordBatch] = []

            def flush():
                t = pa.Table.from_batches(held).combine_chunks()
                held.clear()
                for ids, v in _matrices(t.column(0).to_numpy(), t.column(1).chunk(0)):
                    if v.shape[1] in best:
                        q_ids, q, _ = kept.value[v.shape[1]]
                        search(q_ids, q, ids, v, best[v.shape[1]], np.arange(len(q_ids)))

            n_held = 0
            for b in batches:
                if b.num_rows:
                    held.append(b)
                    n_held += b.num_rows
                if n_held >= GROUP_ROWS:
                    flush()
                    n_held = 0
            if held:
                flush()
            for d, x in best.items():
                i, j = np.nonzero(x.score != NONE)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(kept.value[d][0][i]), pa.array(kept.value[d][2][i]), pa.array(x.id[i, j]), pa.array(x.score[i, j])],
                    ["query_id", "query", "vec_id", "score"])

        one = rows.mapInArrow(find, SCHEMA)
        out = one if out is None else out.unionAll(one)
    if out is None:
        out = spark.createDataFrame([], SCHEMA)
    rank = F.row_number().over(Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id"))
    return (out.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))
