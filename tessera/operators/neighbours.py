"""Nearest neighbours between vector tables, votes over them, and graphs made of them."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.plans.lineage import cut

BLOCK, PIVOTS = 4096, 1024
#: Tasks that compare, about, until a side of one has HELD rows; more rows make more tasks then.
TASKS, HELD = 48, 65_536
#: Queries that are compared with references of a cell at a time, and references at most.
ROWS, COLUMNS = 512, 4096


def _nearest(group: pa.Table, cells: Cells, k: int) -> pa.Table:
    """Of some queries and the references of some cells: the k nearest references of each query, none beyond its ``limit``.

    Each cell is compared with the queries that may have a near one there, the cells nearest to them first; the k found so far lower the limit.
    """
    ref = group.column("is_ref").to_numpy(zero_copy_only=False)
    ids = np.array(group.column("id").to_pylist(), object)
    x = _vectors(group.column("v").combine_chunks(), cells.pivots.shape[1])
    q, q_ids, limit = x[~ref], ids[~ref], group.column("limit").to_numpy()[~ref]
    r, r_ids, cell = x[ref], ids[ref], group.column("cell").to_numpy()[ref]
    found = [(np.empty(0, int), np.empty(0, int), np.empty(0))]
    if len(q) and len(r):
        place = np.argsort(np.argsort(r_ids.astype(str), kind="stable"))  # ties go to the smaller id
        order = np.argsort(cell, kind="stable")
        r, r_ids, place = r[order], r_ids[order], place[order]
        here, start = np.unique(cell[order], return_index=True)
        end = np.append(start[1:], len(r))
        square, own = np.einsum("ij,ij->i", r, r), np.einsum("ij,ij->i", q, q)
        right = np.hstack((r, square[:, None], np.ones((len(r), 1)))).T.copy()
        by_cell = np.concatenate([_to_pivots(q[at : at + ROWS], cells.pivots[here]).argmin(axis=1) for at in range(0, len(q), ROWS)]).argsort(kind="stable")
        for at in range(0, len(q), ROWS):
            rows = by_cell[at : at + ROWS]
            left = np.hstack((-2 * q[rows], np.ones((len(rows), 1)), own[rows, None]))
            blur = 1e-11 * (own[rows] + square.max()) + 1e-300
            d, most, slack = _to_pivots(q[rows], cells.pivots[here]), limit[rows], _slack(q[rows], cells.pivots)
            least = cells.least(d, here) - slack[:, None]
            i, j, z = np.empty(0, int), np.empty(0, int), np.empty(0)
            for c in np.argsort(d.mean(axis=0), kind="stable"):
                for s in range(start[c], end[c], COLUMNS):
                    some = np.flatnonzero(least[:, c] <= most)
                    if not len(some):
                        break
                    e = min(s + COLUMNS, end[c])
                    near = left[some] @ right[:, s:e]
                    bound = np.square(most[some])
                    if np.isinf(bound).any() and e - s > k:
                        bound = np.minimum(bound, np.partition(near, k - 1, axis=1)[:, k - 1] + blur[some])
                    a, b = np.divmod(np.flatnonzero(near <= (bound + blur[some])[:, None]), e - s)
                    if not len(a):
                        continue
                    a, b = some[a], b + s
                    i, j, z = np.append(i, a), np.append(j, b), np.append(z, np.sqrt(np.square(r[b] - q[rows[a]]).sum(axis=1)))  # exactly, for what is near enough
                    best = np.lexsort((place[j], z, i))
                    i, j, z = i[best], j[best], z[best]
                    rank = np.arange(len(i)) - np.searchsorted(i, i)
                    keep = (rank < k) & (z <= most[i])
                    i, j, z, rank = i[keep], j[keep], z[keep], rank[keep]
                    most[i[rank == k - 1]] = z[rank == k - 1]
            found.append((rows[i], j, z))
    i, j, z = (np.concatenate(y) for y in zip(*found, strict=True))
    return pa.table({"query": pa.array(q_ids[i].tolist(), pa.string()), "neighbour": pa.array(r_ids[j].tolist(), pa.string()), "distance": pa.array(z)})


def _to_pivots(v: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of vectors to pivots; with cancellation, so bounds made of them need :func:`_slack`."""
    square = np.einsum("ij,ij->i", v, v)[:, None] - 2 * v @ pivots.T + np.einsum("ij,ij->i", pivots, pivots)[None]
    return np.sqrt(np.maximum(square, 0.0))


def _slack(v: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """What rounding may add to a bound: far above the error of :func:`_to_pivots`, far below distances that matter."""
    return 1e-6 * (1e-9 + np.sqrt(np.einsum("ij,ij->i", v, v)) + np.sqrt(np.einsum("ij,ij->i", pivots, pivots)).max())


def _vectors(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dim)


def _grouped(pivots: np.ndarray, n: np.ndarray, held: int) -> np.ndarray:
    """A group for each pivot: halves along the longest axis, until one has ``held`` references at most, or one pivot."""
    group, todo, name = np.zeros(len(pivots), np.int64), [np.arange(len(pivots))], 0
    while todo:
        at = todo.pop()
        if len(at) == 1 or n[at].sum() <= held:
            group[at], name = name, name + 1
            continue
        x = pivots[at] - pivots[at].mean(axis=0)
        at = at[np.argsort(x @ np.linalg.svd(x, full_matrices=False)[2][0], kind="stable")]
        half = min(max(1, int(np.searchsorted(np.cumsum(n[at]), n[at].sum() / 2))), len(at) - 1)
        todo += [at[:half], at[half:]]
    return group


class Cells:
    """References dealt to their nearest pivot: rows (id, h, v, cell), and per cell its number, least and largest distance from the pivot, and its group."""

    def __init__(self, references: DataFrame, block: int, most: int, asked: int):
        n = references.count()
        self.held = max(block, min(HELD, ceil((n * asked / TASKS) ** 0.5)))
        picked = references.orderBy("h", "id").limit(min(most, max(1, ceil(4 * n / block)))).select("v").collect()  # at most ``most``
        self.pivots = np.array([r["v"] for r in picked], np.float64)
        pivots = self.pivots

        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                d = _to_pivots(_vectors(batch.column(2), pivots.shape[1]), pivots)
                cell = d.argmin(axis=1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32)), pa.array(d[np.arange(len(d)), cell])], names=["id", "h", "v", "cell", "d"])

        kind = dict(references.dtypes)["v"]
        self.rows = cut(references.select("id", "h", "v").mapInArrow(deal, f"id string, h long, v {kind}, cell int, d double"), "cells")
        self.n, self.near, self.far = np.zeros(len(pivots), np.int64), np.full(len(pivots), np.inf), np.full(len(pivots), -np.inf)
        for r in self.rows.groupBy("cell").agg(F.count("*").alias("n"), F.min("d").alias("a"), F.max("d").alias("b")).collect():  # one row per pivot
            self.n[r["cell"]], self.near[r["cell"]], self.far[r["cell"]] = r["n"], r["a"], r["b"]

        self.group = _grouped(self.pivots, self.n, self.held)

    def __getstate__(self) -> dict:
        """Tasks get the arrays alone."""
        return {k: x for k, x in self.__dict__.items() if k != "rows"}

    def least(self, d: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How near to the queries references of the cells ``at`` may be, by distances ``d`` to their pivots: by the ring around the pivot, and by the plane between it and the nearest."""
        return np.maximum(np.maximum(d - self.far[at], self.near[at] - d), (d - d.min(axis=1)[:, None]) / 2)


def _routed(queries: DataFrame, cells: Cells, further: bool) -> DataFrame:
    """Rows (id, h, v, limit, group, cells): queries for the group of their nearest cell, or, with their ``limit``, for all others of which ``cells`` may hold nearer references."""
    full = np.flatnonzero(cells.n > 0)
    member = cells.group[full][:, None] == np.arange(cells.group.max() + 1)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _vectors(batch.column(2), cells.pivots.shape[1])
            for at in range(0, len(v), ROWS):
                d = _to_pivots(v[at : at + ROWS], cells.pivots[full])
                own = member[d.argmin(axis=1)]
                limit = batch.column(3).slice(at, ROWS).to_numpy()
                to = own.astype(float)
                if further:
                    to = (cells.least(d, full) <= (limit + _slack(v[at : at + ROWS], cells.pivots))[:, None]).astype(float) @ member * ~own
                i, group = np.nonzero(to)
                yield pa.RecordBatch.from_arrays([*batch.take(pa.array(i + at)).columns, pa.array(group.astype(np.int32)), pa.array(to[i, group].astype(np.int32))], names=[*batch.schema.names, "group", "cells"])

    kind = dict(queries.dtypes)["v"]
    return queries.select("id", "h", "v", "limit").mapInArrow(route, f"id string, h long, v {kind}, limit double, group int, cells int")


def _compared(routed: DataFrame, cells: Cells, k: int) -> DataFrame:
    """Rows (query, neighbour, distance): in each group of cells the k nearest of each of its queries. Groups with more rows on a side than ``held`` are split on it."""
    here = {r["group"]: r["count"] for r in routed.groupBy("group").count().collect()}  # one row per group
    parts = {g: (ceil(n / cells.held), max(1, ceil(int(cells.n[cells.group == g].sum()) / cells.held))) for g, n in here.items()}
    table = routed.sparkSession.createDataFrame
    sizes = F.broadcast(table([(g, *p) for g, p in parts.items()], "group int, nq int, nr int"))  # one row per group
    of_cell = F.broadcast(table([(c, int(g), *parts[g]) for c, g in enumerate(cells.group) if g in parts], "cell int, group int, nq int, nr int"))  # one row per pivot
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    q = routed.join(sizes, "group").withColumn("bq", F.pmod("h", F.col("nq")).cast("int")).withColumn("br", every("nr"))
    r = cells.rows.join(of_cell, "cell").withColumn("br", F.pmod("h", F.col("nr")).cast("int")).withColumn("bq", every("nq"))
    side = lambda t, is_ref, limit, cell: t.select("id", "v", F.lit(is_ref).alias("is_ref"), limit.cast("double").alias("limit"), cell.cast("int").alias("cell"), "group", "bq", "br")
    both = side(q, False, F.col("limit"), F.lit(0)).unionByName(side(r, True, F.lit(0.0), F.col("cell")))
    return both.groupBy("group", "bq", "br").applyInArrow(lambda t: _nearest(t, cells, k), "query string, neighbour string, distance double")


def _limits(found: DataFrame, k: int) -> DataFrame:
    """Rows (id, limit): the distance of the k-th found, if there are so many."""
    return found.groupBy(F.col("query").alias("id")).agg(F.when(F.count("*") >= k, F.max("distance")).otherwise(float("inf")).alias("limit"))


def _best(found: DataFrame, k: int) -> DataFrame:
    return found.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy("distance", "neighbour"))).where(F.col("rank") <= k)


def _rows(t: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    return t.select(F.col(id_col).cast("string").alias("id"), F.xxhash64(id_col).alias("h"), F.col(vector_col).alias("v"))


def knn(
    queries: DataFrame, references: DataFrame, k: int, id_col: str = "OID", vector_col: str = "embedding", skip_self: bool = False, block: int = BLOCK, most_pivots: int = PIVOTS,
) -> DataFrame:
    """Rows (query, neighbour, distance, rank): the exact k nearest by Euclidean distance, ties to the smaller id.

    1. References are dealt to their nearest of at most ``most_pivots`` pivots, four for each ``block`` of them; cells near each other form groups.
    2. A query meets the group of its nearest cell. Its k-th distance there is a limit.
    3. It goes on to the groups with a cell that the limit cannot exclude, by distances to pivots; the best of all are merged.

    A task holds a group's references and some of its queries, and compares cells with the queries that may have a near one there. Clustered vectors meet a few
    cells each; where the bounds exclude nothing every query is compared with every reference, as exactness asks for, but goes to each group once: both sides are
    dealt some seven times, or rows / ``HELD`` times where that is more. Nothing is broadcast but the pivots and a row for each, so either side may
    be of any size, as may a cell, which is split. Without references there are no rows.
    """
    q, want = _rows(queries, id_col, vector_col), k + skip_self
    if references.isEmpty():
        return queries.sparkSession.createDataFrame([], "query string, neighbour string, distance double, rank int")
    cells = Cells(_rows(references, id_col, vector_col), block, most_pivots, queries.count())
    found = cut(_best(_compared(_routed(q.withColumn("limit", F.lit(float("inf"))), cells, False), cells, want), want).drop("rank"), "near")
    if len(set(cells.group[cells.n > 0].tolist())) > 1:
        further = cut(_routed(q.join(_limits(found, want), "id"), cells, True), "further")
        found = found.unionByName(_compared(further, cells, want))
    if skip_self:
        found = found.where("query <> neighbour")
    return _best(found, k)


def cells_met(queries: DataFrame, references: DataFrame, k: int, id_col: str = "OID", vector_col: str = "embedding", block: int = BLOCK, most_pivots: int = PIVOTS) -> tuple[int, float]:
    """Cells that hold references, and how many of them a query of :func:`knn` meets on average: all of its own group's at most, and those that its limit there cannot exclude."""
    q, n = _rows(queries, id_col, vector_col), queries.count()
    cells = Cells(_rows(references, id_col, vector_col), block, most_pivots, n)
    full = cells.n > 0
    size = queries.sparkSession.createDataFrame([(int(g), int((full & (cells.group == g)).sum())) for g in set(cells.group.tolist())], "group int, size int")
    first = cut(_routed(q.withColumn("limit", F.lit(float("inf"))), cells, False), "first")
    limit = _limits(_best(_compared(first, cells, k), k), k)
    own = first.join(F.broadcast(size), "group").agg(F.sum("size")).first()[0] or 0  # one row per group
    return int(full.sum()), (own + (_routed(q.join(limit, "id"), cells, True).agg(F.sum("cells")).first()[0] or 0)) / max(n, 1)


def vote(neighbours: DataFrame, labels: DataFrame, largest_wins: bool = False) -> DataFrame:
    """Majority label of each query's neighbours: label, second, confidence, margin, n_neighbors.

    Ties go to the smallest label, or to the largest. A unanimous vote has margin 1 and, with ``largest_wins``, an empty second label.
    ``labels`` has rows (neighbour, label).
    """
    n = neighbours.join(labels, "neighbour").groupBy("query", "label").agg(F.count("*").alias("votes"))
    tie = F.desc("label") if largest_wins else F.col("label")
    ranked = n.withColumn("_n", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("votes"), tie)))
    out = ranked.groupBy("query").agg(
        F.max(F.when(F.col("_n") == 1, F.col("label"))).alias("label"), F.max(F.when(F.col("_n") == 2, F.col("label"))).alias("second"),
        F.max(F.when(F.col("_n") == 1, F.col("votes"))).alias("a"), F.max(F.when(F.col("_n") == 2, F.col("votes"))).alias("b"), F.sum("votes").alias("n_neighbors"))
    if largest_wins:
        second = F.coalesce("second", F.lit(""))
    else:  # the smallest other label, with no votes
        known = labels.groupBy("label").count().select(F.col("label").alias("other"))
        first_two = known.orderBy("other").limit(2).agg(F.min("other").alias("_x"), F.max("other").alias("_y"))
        out = out.join(F.broadcast(first_two))  # one row
        second = F.coalesce("second", F.nullif(F.when(F.col("_x") == F.col("label"), F.col("_y")).otherwise(F.col("_x")), F.col("label")))
    b = F.coalesce("b", F.lit(0))
    return out.select("query", "label", second.alias("second"), (F.col("a") / F.col("n_neighbors")).alias("confidence"), ((F.col("a") - b) / F.col("n_neighbors")).alias("margin"), "n_neighbors")


def refine(cells: DataFrame, k: int = 25, least_confidence: float = 0.60, least_margin: float = 0.10) -> DataFrame:
    """Cells of (OID, embedding, CellType) against their own k neighbours: stable, relabelled or kept."""
    near = knn(cells, cells, k, skip_self=True)
    labels = cells.select(F.col("OID").cast("string").alias("neighbour"), F.col("CellType").alias("label"))
    v = vote(near, labels, largest_wins=True).join(cells.select(F.col("OID").cast("string").alias("query"), "CellType"), "query")
    sure = (F.col("confidence") >= least_confidence) & (F.col("margin") >= least_margin)
    status = F.when(F.col("label") == F.col("CellType"), "stable").when(sure, "relabelled").otherwise("kept_low_confidence")
    return v.select("query", "CellType", F.when(status == "relabelled", F.col("label")).otherwise(F.col("CellType")).alias("refined"), "confidence", "margin", status.alias("status"))


def jaccard_graph(near: DataFrame, k: int) -> DataFrame:
    """Undirected edges (a, b, weight) between neighbours: shared / (2k - shared), the mean of both directions.

    The shared neighbours of a pair come from joining each end's list, one row per cell, to the pairs.
    """
    lists = near.groupBy("query").agg(F.collect_set("neighbour").alias("l"))
    pairs = near.select("query", "neighbour").join(lists, "query").join(lists.toDF("neighbour", "m"), "neighbour")
    shared = F.size(F.array_intersect("l", "m"))
    w = pairs.select(F.least("query", "neighbour").alias("a"), F.greatest("query", "neighbour").alias("b"), (shared / (2 * k - shared)).alias("w"))
    return w.groupBy("a", "b").agg((F.sum("w") / 2).alias("weight")).where("weight > 0")


def modularity(edges: DataFrame, labels: DataFrame, resolution: float = 1.0) -> DataFrame:
    """One row: Q of a labelled weighted graph; labels has (node, community)."""
    e = edges.join(labels.toDF("a", "ca"), "a").join(labels.toDF("b", "cb"), "b")
    ends = e.select(F.explode(F.array(F.struct("ca", "weight"), F.struct(F.col("cb").alias("ca"), "weight"))).alias("x"))
    degree = ends.groupBy("x.ca").agg(F.sum("x.weight").alias("d")).agg(F.sum(F.col("d") * F.col("d")).alias("d2"), F.sum("d").alias("m2"))
    inside = e.agg(F.sum(F.when(F.col("ca") == F.col("cb"), F.col("weight")).otherwise(0.0)).alias("w"), F.sum("weight").alias("m"))
    return inside.join(F.broadcast(degree)).select((F.col("w") / F.col("m") - resolution * F.col("d2") / (F.col("m2") * F.col("m2"))).alias("q"))  # one row each
