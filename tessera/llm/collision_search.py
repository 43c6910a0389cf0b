"""Approximate nearest neighbours by collision counting on single projections."""

from __future__ import annotations

from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.vectors import matrix, usable
from tessera.plans.lineage import cut

PROJECTIONS = 96
#: Share of the projections in which a vector must lie in the query's window to be verified.
SHARE = 0.88
#: Window half-widths: the first where fewer than k rows are known, and the factor of each rehashing. A search ends when the window
#: is WIDE times the distance of the k-th found: a nearer vector would miss the threshold with a probability of a few percent.
FIRST, FACTOR, WIDE = 0.5, 1.5, 1.75
#: Rows on either side of a query in each projection that are verified first, for a distance that the first window starts from.
BESIDE = 2
#: Ranks are counted in so many steps, so that a rank is a byte.
STEPS = 255
QUERY_BLOCK, DATA_BLOCK = 1024, 8192
BATCH = 32


def _augment(x: np.ndarray, most: float) -> np.ndarray:
    """Append the component that gives every vector the length ``most``, so that nearer means a larger inner product."""
    x = x / most
    rest = 1 - np.einsum("ij,ij->i", x, x)
    return np.hstack((x, np.sqrt(np.maximum(rest, 0))[:, None]))


class _Index:
    """Projections of a block, each as a sorted array, its order and the step of every row's rank in it."""

    def __init__(self, points: np.ndarray, axes: np.ndarray):
        h = points @ axes
        order = np.argsort(h, axis=0, kind="stable")
        self.sorted = np.take_along_axis(h, order, axis=0).T.copy()
        self.order = order.T.astype(np.int32)
        self.step = (np.arange(len(points)) * STEPS // len(points)).astype(np.uint8)
        self.rank = np.empty((h.shape[1], len(points)), np.uint8)
        np.put_along_axis(self.rank, order.T, self.step[None], axis=1)

    def beside(self, h: np.ndarray) -> np.ndarray:
        """For each query (rows of h) the rows next to it in the projections, several times where they are in several."""
        n, at = self.order.shape[1], np.arange(-BESIDE, BESIDE)
        places = [np.clip(np.searchsorted(self.sorted[j], h[:, j])[:, None] + at, 0, n - 1) for j in range(len(self.order))]
        return np.hstack([self.order[j][x] for j, x in enumerate(places)])

    def collisions(self, h: np.ndarray, width: np.ndarray) -> np.ndarray:
        """For each query (rows of h) and row the number of windows [h - width, h + width] that hold the row; a window is widened to whole steps."""
        m, n = self.rank.shape
        counts, inside, shifted = (np.zeros((len(h), n), np.uint8) for _ in range(3))
        for j in range(m):
            low = np.searchsorted(self.sorted[j], h[:, j] - width)
            end = np.searchsorted(self.sorted[j], h[:, j] + width, "right")
            first = self.step[np.minimum(low, n - 1)]
            size = np.where(end > low, self.step[np.maximum(end, 1) - 1] - first + np.uint8(1), np.uint8(0))
            np.subtract(self.rank[j][None, :], first[:, None], out=shifted)  # below the window it wraps round
            np.less(shifted, size[:, None], out=inside.view(bool))
            counts += inside
        return counts


def _search(group: pa.Table, k: int, most: float, seed: int) -> pa.Table:
    is_query = group.column("query").to_numpy()
    ids, x = group.column("vec_id").to_numpy(), matrix(group.column("v"))
    order = np.argsort(ids, kind="stable")
    ids, x, is_query = ids[order], x[order], is_query[order]
    q_ids, q, o_ids, o = ids[is_query], x[is_query], ids[~is_query], x[~is_query]
    out: list[list] = [[], [], []]
    if len(q) and len(o):
        axes = np.random.default_rng(seed).standard_normal((x.shape[1] + 1, PROJECTIONS))
        index = _Index(_augment(o, most), axes)
        unit = q / np.sqrt(np.einsum("ij,ij->i", q, q))[:, None]
        h = np.hstack((unit, np.zeros((len(q), 1)))) @ axes
        for s in range(0, len(q), BATCH):
            for i, (rows, scores) in enumerate(_batch(index, q[s : s + BATCH], q_ids[s : s + BATCH], h[s : s + BATCH], o, o_ids, k, most)):
                out[0].append(np.full(len(rows), q_ids[s + i]))
                out[1].append(o_ids[rows])
                out[2].append(scores)
    flat = [np.concatenate(c) if c else np.empty(0) for c in out]
    return pa.table({"query_id": flat[0].astype(np.int64), "vec_id": flat[1].astype(np.int64), "score": flat[2].astype(np.float64)})


def _batch(index: _Index, q, q_ids, h, o, o_ids, k: int, most: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """The k best rows of the block for each query of a batch, and their inner products."""
    best: list = [(np.empty(0, int), np.empty(0))] * len(q)
    seen, todo, width = np.zeros((len(q), len(o)), bool), np.arange(len(q)), np.full(len(q), FIRST)
    length = np.sqrt(np.einsum("ij,ij->i", q, q))
    need = ceil(SHARE * PROJECTIONS)

    def verify(i: int, new: np.ndarray) -> float:
        """Keep the best k; the window that their k-th asks for, from its distance on the sphere of the augmented vectors."""
        new = new[o_ids[new] != q_ids[i]]
        if len(new):
            rows = np.concatenate((best[i][0], new))
            scores = np.concatenate((best[i][1], o[new] @ q[i]))
            if len(rows) > k:
                few = np.argpartition(-scores, k - 1)
                rows, scores = (z[scores >= scores[few[k - 1]]] for z in (rows, scores))
            best[i] = rows, scores
        return WIDE * sqrt(max(0.0, 2 - 2 * best[i][1].min() / (length[i] * most))) if len(best[i][0]) >= k else np.inf

    near = index.beside(h)
    for i in todo:
        new = np.unique(near[i])
        seen[i, new] = True
        if (asked := verify(i, new)) < np.inf:
            width[i] = asked
    while len(todo):
        hit = index.collisions(h[todo], width[todo]) >= need
        hit &= ~seen[todo]
        seen[todo] |= hit
        asked = np.array([verify(i, np.flatnonzero(hit[t])) for t, i in enumerate(todo)])
        todo = todo[(width[todo] < asked) & ~seen[todo].all(axis=1)]
        width[todo] *= FACTOR
    done = []
    for i, (rows, _) in enumerate(best):
        scores = np.einsum("ij,j->i", o[rows], q[i])
        top = np.lexsort((o_ids[rows], -scores))[:k]
        done.append((rows[top], scores[top]))
    return done


def search(
    df: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", seed: int = 11,
    query_block: int = QUERY_BLOCK, data_block: int = DATA_BLOCK,
) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): for each query the k rows of largest inner product, but not the query's own id.

    All rows are dealt into blocks of about ``data_block``, the queries into blocks of about ``query_block``, and a task searches one with
    the other: it sorts the block by each of ``PROJECTIONS`` random projections, counts for each query the windows around
    its own projections that hold a row, and verifies the rows that reach the threshold. The rows next to a query in the projections
    give the first window; windows widen until the k-th found is near enough (or all rows are verified, so small tables give all
    candidates). The best of the blocks are merged.

    Vectors that are null, empty, zero or hold null or non-finite components, and rows with a null id, take no part; neither do pairs of
    different lengths. Ties go to the smaller id. Rows that repeat an id and its vector count once, as candidates and as queries; of several
    vectors of one query id the smallest asks. Extra columns are not read. Empty tables give no rows.
    """
    def take(t: DataFrame) -> DataFrame:
        t = t.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v"))
        return t.where(usable(F.col("v")) & F.col("vec_id").isNotNull())

    rows = cut(take(df).distinct(), "rows")
    asked = cut(take(queries).groupBy("vec_id").agg(F.min("v").alias("v")), "queries")
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    n, most = rows.agg(F.count("*"), F.sqrt(F.max(square))).first()
    n_o, n_q = max(1, ceil(n / data_block)), max(1, ceil(asked.count() / query_block))
    block = lambda m, salt: F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(m)).cast("int")
    each = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    data = rows.select("vec_id", "v", F.lit(False).alias("query"), block(n_o, 1).alias("o"), each(n_q).alias("q"))
    asks = asked.select("vec_id", "v", F.lit(True).alias("query"), block(n_q, 2).alias("q"), each(n_o).alias("o"))
    both = data.unionByName(asks).withColumn("d", F.size("v"))
    most = float(most or 1.0) * (1 + 1e-12)
    found = both.groupBy("o", "q", "d").applyInArrow(lambda t: _search(t, k, most, seed), "query_id long, vec_id long, score double")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
