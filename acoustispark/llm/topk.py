"""Exact top-k by vector-approximation files.

Every block of vectors is scanned as quantised cells first: a cell gives an upper bound of the inner product with a
query. Exact vectors are then read in the order of that bound until the k-th result is certain.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from acoustispark.llm.common import staged

CELLS = 16
_LONG = 1 << 63


def _scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact integer inner products of queries (n, d) with their own candidates (n, m, d)."""
    if not q.size or not c.size:
        return np.zeros(c.shape[:2], dtype=np.int64)
    if q.shape[1] * float(np.abs(q).max()) * float(np.abs(c).max()) < 2 ** 62:
        return np.einsum("nd,nmd->nm", q, c)
    exact = (q.astype(object)[:, None, :] * c.astype(object)).sum(axis=2)
    return np.clip(exact, -_LONG, _LONG - 1).astype(np.int64)


class VaFile:
    """A block of integer vectors with its quantised cells (at most ``CELLS`` a dimension)."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        low = vectors.min(axis=0)
        self.width = (vectors.max(axis=0) - low) // CELLS + 1
        self.low = low.astype(np.float64)
        self.cells = ((vectors - low) // self.width).astype(np.uint8)

    def bounds(self, q: np.ndarray) -> np.ndarray:
        """Upper bounds of the scores from the cells alone."""
        half = (self.width - 1) / 2.0
        mid = self.low + self.cells * self.width.astype(np.float64) + half
        qf = q.astype(np.float64)
        slack = 1e-12 * (np.abs(qf) @ (np.abs(self.low) + CELLS * self.width)) + 1e-6
        return qf @ mid.T + (np.abs(qf) @ half + slack)[:, None]

    def search(self, qid: np.ndarray, q: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(row of q, scores, ids): the k best other vectors, ties to the smaller id."""
        bound = self.bounds(q)
        bound[qid[:, None] == self.ids[None, :]] = -np.inf
        open_rows, read = np.arange(len(q)), 4 * k
        while len(open_rows):
            n = len(self.ids)
            read = min(read, n)
            b = bound[open_rows]
            top = np.argpartition(-b, read - 1, axis=1)[:, :read] if read < n else np.tile(np.arange(n), (len(b), 1))
            near = np.take_along_axis(b, top, axis=1)
            score = _scores(q[open_rows], self.vectors[top])
            still = []
            for i, row in enumerate(open_rows):
                real = near[i] > -np.inf
                s, d = score[i][real], self.ids[top[i][real]]
                order = np.lexsort((d, -s))[:k]
                unread = np.delete(b[i], top[i]).max() if read < n else -np.inf
                if unread == -np.inf or (len(order) == k and unread < s[order[-1]]):
                    yield row, s[order], d[order]
                else:
                    still.append(row)
            open_rows, read = np.array(still, dtype=np.int64), read * 4


def as_integers(vecs: DataFrame, vec_id: str, vector: str, scale: float) -> DataFrame:
    """vec_id, dim, v: floor(``scale`` * x) as packed longs, each vector of an id once; without null ids, null or non-finite components."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, dims, packed = [], [], []
            for i, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if i is None or x is None or any(c is None for c in x):
                    continue
                a = np.array(x, dtype=np.float64)
                if not np.isfinite(a).all():
                    continue
                ids.append(i)
                dims.append(len(a))
                packed.append(np.clip(np.floor(scale * a), -2.0 ** 61, 2.0 ** 61).astype("<i8").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(dims, pa.int32()), pa.array(packed, pa.binary())],
                                             names=["vec_id", "dim", "v"])
    rows = vecs.select(F.col(vec_id).cast("long"), vector).mapInArrow(run, "vec_id long, dim int, v binary")
    return rows.distinct()


def exact_topk(vecs: DataFrame, k: int = 20, every: int = 20, scale: float = 64.0, vec_id: str = "vec_id",
               vector: str = "embedding", block: int = 8192, query_block: int = 2048) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` largest integer inner products for the rows whose id is divisible by
    ``every``, against all other rows of the same dimension.

    Blocks of queries meet blocks of vectors, both of bounded size; every pair of blocks gives its own certain top
    k, and these are merged. Scores beyond a long are clipped. Of a repeated id every different vector is found and asks,
    but not among its own id's; what they find is ranked together. Rows equal in id and integers count once.
    Null or non-finite vectors take no part; fewer than k candidates give fewer rows; no queries give none.
    """
    ints = staged(as_integers(vecs, vec_id, vector, scale), "vectors")
    is_query = F.pmod("vec_id", F.lit(every)) == 0
    n = ints.agg(F.count("*").alias("n"), F.count_if(is_query).alias("q")).first()
    nb, nq = max(1, -(-n["n"] // block)), max(1, -(-n["q"] // query_block))
    side = F.xxhash64("vec_id", "v", F.lit(1))
    cand = ints.withColumn("cb", F.pmod(side, F.lit(nb))).withColumn("qb", F.explode(F.expr(f"sequence(0L, {nq - 1}L)")))
    quer = ints.where(is_query).withColumn("qb", F.pmod(F.xxhash64("vec_id", "v", F.lit(2)), F.lit(nq))).withColumn(
        "cb", F.explode(F.expr(f"sequence(0L, {nb - 1}L)")))

    def search(qt: pa.Table, ct: pa.Table) -> pa.Table:
        out: list[list] = [[], [], []]
        if qt.num_rows and ct.num_rows:
            unpack = lambda t: np.frombuffer(b"".join(t.column("v").to_pylist()), "<i8").reshape(t.num_rows, -1)
            ids, qid = ct.column("vec_id").to_numpy(), qt.column("vec_id").to_numpy()
            q, va = unpack(qt), VaFile(ids, unpack(ct))
            for lo in range(0, len(q), 256):
                for row, s, d in va.search(qid[lo:lo + 256], q[lo:lo + 256], k):
                    for col, v in zip(out, (np.full(len(s), qid[lo + row]), d, s)):
                        col.append(v)
        cat = [np.concatenate(c) if c else np.empty(0, dtype=np.int64) for c in out]
        return pa.Table.from_arrays([pa.array(c.astype(np.int64)) for c in cat], names=["query_id", "vec_id", "score"])

    key = ["dim", "qb", "cb"]
    local = quer.groupBy(*key).cogroup(cand.groupBy(*key)).applyInArrow(search, "query_id long, vec_id long, score long")
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    return local.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
