"""Near-duplicate embeddings: comparison of tiles in the order of principal components."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.vectors import matrix, second_moments, usable
from tessera.operators.graph import connected_components
from tessera.plans.lineage import cut

BLOCK = 4096
TILE = 512
STEPS = (16, 32)
#: Single-precision partial sums may be off by less than this; pairs inside the margin go on to the exact test.
MARGIN = 1e-4


def _flood(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest index that each of n nodes reaches over the links (i, j)."""
    label = np.arange(n)
    while True:
        least, new = np.minimum(label[i], label[j]), label.copy()
        np.minimum.at(new, i, least)
        np.minimum.at(new, j, least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


class _Side:
    def __init__(self, ids: np.ndarray, counts: np.ndarray, x: np.ndarray, rotation: np.ndarray):
        self.ids, self.counts, self.x = ids, counts, x
        self.norm = np.sqrt(np.einsum("ij,ij->i", x, x))
        unit = (x / self.norm[:, None]) @ rotation
        tail = np.cumsum((unit**2)[:, ::-1], axis=1)[:, ::-1]
        self.unit = unit.astype(np.float32)
        self.tail = {k: np.sqrt(tail[:, k]).astype(np.float32) for k in STEPS if k < unit.shape[1]}


def _tile_links(a: _Side, b: _Side, i0: int, j0: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of the pairs of two tiles with the cosine: leading components first, for all pairs at once while many
    are left and singly afterwards; a pair goes when what it lacks exceeds the product of the suffix norms."""
    rows, cols = slice(i0, i0 + TILE), slice(j0, j0 + TILE)
    part, at, i, j = None, 0, None, None
    for k in a.tail:
        if i is None:
            more = a.unit[rows, at:k] @ b.unit[cols, at:k].T
            part = more if part is None else part + more
            open_ = part + np.multiply.outer(a.tail[k][rows], b.tail[k][cols]) >= threshold - MARGIN
            left = np.count_nonzero(open_)
            if not left:
                return np.empty(0, int), np.empty(0, int)
            if left < open_.size // 20:
                i, j = np.nonzero(open_)
                part = part[i, j]
        else:
            part = part + np.einsum("ij,ij->i", a.unit[rows][i, at:k], b.unit[cols][j, at:k])
            keep = part + a.tail[k][rows][i] * b.tail[k][cols][j] >= threshold - MARGIN
            i, j, part = i[keep], j[keep], part[keep]
        at = k
    if i is None:
        rest = a.unit[rows, at:] @ b.unit[cols, at:].T
        i, j = np.nonzero((rest if part is None else part + rest) >= threshold - MARGIN)
    i, j, found = i + i0, j + j0, []
    for s in range(0, len(i), 65536):
        x, y = i[s : s + 65536], j[s : s + 65536]
        found.append(np.einsum("ij,ij->i", a.x[x], b.x[y]) / (a.norm[x] * b.norm[y]) >= threshold)
    keep = np.concatenate(found) if found else np.empty(0, bool)
    return i[keep], j[keep]


def _compare(group: pa.Table, rotations: dict[int, np.ndarray], threshold: float) -> pa.Table:
    """Of a pair of blocks, or of one with itself: rows (a, null, links) and (a, b, 0), the latter a forest."""
    left = group.column("left").to_numpy()
    ids, counts, x = group.column("rep").to_numpy(), group.column("cnt").to_numpy(), matrix(group.column("v"))
    own = bool(group.column("own")[0].as_py())
    rotation = rotations[x.shape[1]]
    order = np.lexsort(((x @ rotation[:, 0]) / np.sqrt(np.einsum("ij,ij->i", x, x)), ~left))
    ids, counts, x, n = ids[order], counts[order], x[order], int(left.sum())
    a = _Side(ids[:n], counts[:n], x[:n], rotation)
    b, shift = (a, 0) if own else (_Side(ids[n:], counts[n:], x[n:], rotation), n)
    links, ends = np.zeros(len(ids), np.int64), []
    width = sqrt(max(0.0, 2 - 2 * threshold)) + MARGIN
    for i0 in range(0, len(a.ids), TILE):
        for j0 in range(i0 if own else 0, len(b.ids), TILE):
            # tiles stand in the order of the first component; those too far apart in it hold no link
            if b.unit[j0, 0] - a.unit[min(i0 + TILE, len(a.ids)) - 1, 0] > width or a.unit[i0, 0] - b.unit[min(j0 + TILE, len(b.ids)) - 1, 0] > width:
                continue
            i, j = _tile_links(a, b, i0, j0, threshold)
            if own:
                once = i < j
                i, j = i[once], j[once]
            if not len(i):
                continue
            links += np.bincount(i, b.counts[j], len(ids)).astype(np.int64)
            links += np.bincount(j + shift, a.counts[i], len(ids)).astype(np.int64)
            nodes, at = np.unique(np.concatenate((i, j + shift)), return_inverse=True)
            label = _flood(len(nodes), at[: len(i)], at[len(i) :])
            ends.append((nodes, nodes[label]))
    i, j = (np.concatenate(z) for z in zip(*ends, strict=True)) if ends else (np.empty(0, int),) * 2
    root = _flood(len(ids), i, j)
    some, moved = np.flatnonzero(links), np.flatnonzero(root != np.arange(len(ids)))
    return pa.table({
        "a": np.concatenate((ids[some], ids[moved])), "n": np.concatenate((links[some], np.zeros(len(moved), np.int64))),
        "b": pa.array(np.concatenate((ids[some], ids[root[moved]])), mask=np.arange(len(some) + len(moved)) < len(some)),
    }).select(["a", "b", "n"])


def near_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.9, block: int = BLOCK) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept; links are pairs with cosine >= threshold, in doubles.

    Equal vectors are one class. Classes are rotated onto the principal components of all vectors and placed in cells of the first two
    components; the width is the largest distance that a link can have, so only neighbouring cells are compared. A cell is dealt
    into blocks of about ``block`` classes, and a task compares two blocks, tile by tile. It returns sums of links and a forest
    instead of the pairs, so a group of thousands of near copies costs no more rows than its members.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing; neither do vectors of different
    lengths, or rows with a null id (component null, kept). Rows that repeat an id and its vector count as one vector and each get its row; where an
    id comes with several vectors, classes of which it is the smallest id count as one, with the links of all of them. Extra columns are not read. An empty table gives no rows.
    """
    d = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v"))
    good = usable(F.col("v")) & F.col("vec_id").isNotNull()
    classes = cut(d.where(good).groupBy("v").agg(F.min("vec_id").alias("rep"), F.count_distinct("vec_id").alias("cnt")), "vectors")
    rotations = {n: np.linalg.eigh(s)[1][:, ::-1].copy() for n, s in second_moments(classes).items()}
    width = sqrt(max(0.0, 2 - 2 * threshold)) + MARGIN

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = np.diff(batch.column(2).offsets.to_numpy())
            for n in np.unique(lengths):
                part = batch.filter(pa.array(lengths == n))
                x = matrix(part.column(2))
                lead = (x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]) @ rotations[int(n)][:, :2]
                cell = np.floor(lead / width).astype(np.int64)
                cells = [pa.array(np.full(len(x), n, np.int64)), pa.array(cell[:, 0]), pa.array(cell[:, -1])]
                yield pa.RecordBatch.from_arrays([*part.columns, *cells], names=["rep", "cnt", "v", "d", "x", "y"])

    kind = dict(classes.dtypes)["v"]
    placed = classes.select("rep", "cnt", "v").mapInArrow(place, f"rep long, cnt long, v {kind}, d long, x long, y long")
    sizes = {(r["d"], r["x"], r["y"]): ceil(r["count"] / block) for r in placed.groupBy("d", "x", "y").count().collect()}
    steps, plan = [s for s in product((-1, 0, 1), repeat=2) if s >= (0, 0)], []
    for (n, x, y), own in sizes.items():
        for p, q in steps:
            if other := sizes.get((n, x + p, y + q)):
                pair = f"{n}:{x}:{y}:{p}:{q}"
                plan.append((n, x, y, pair, (p, q) == (0, 0), True, own, other))
                if (p, q) != (0, 0):
                    plan.append((n, x + p, y + q, pair, False, False, other, own))
    spark = df.sparkSession
    plan = spark.createDataFrame(plan, "d long, x long, y long, pair string, same boolean, first boolean, own_n int, other_n int")
    rows = placed.join(F.broadcast(plan), ["d", "x", "y"])  # at most nine rows a cell, and a few dozen cells
    rows = rows.withColumn("s", F.pmod(F.xxhash64("rep"), F.col("own_n")).cast("int"))
    rows = rows.withColumn("t", F.explode(F.sequence(F.lit(0), F.col("other_n") - 1)))
    rows = rows.select(
        "rep", "cnt", "v", "pair", (F.col("same") & (F.col("s") == F.col("t"))).alias("own"),
        F.when(F.col("same"), F.col("s") <= F.col("t")).otherwise(F.col("first")).alias("left"),
        F.when(F.col("same"), F.least("s", "t")).when(F.col("first"), F.col("s")).otherwise(F.col("t")).alias("i"),
        F.when(F.col("same"), F.greatest("s", "t")).when(F.col("first"), F.col("t")).otherwise(F.col("s")).alias("j"),
    )
    found = rows.groupBy("pair", "i", "j").applyInArrow(lambda t: _compare(t, rotations, threshold), "a long, b long, n long")
    found = cut(found, "links")
    totals = found.where("b is null").groupBy("a").agg(F.sum("n").alias("n"))
    parts = connected_components(found.where("b is not null").select("a", "b"))
    named = classes.select("v", "rep", "cnt").join(totals, F.col("rep") == F.col("a"), "left").join(parts, F.col("rep") == F.col("node"), "left")
    named = named.select(F.col("v").alias("u"), (F.col("cnt") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("c"))
    out = d.where(good).join(named, F.col("v") == F.col("u")).select("vec_id", "n_links", F.col("c").alias("component_id"))
    out = out.union(d.where(~good).select("vec_id", F.lit(0).cast("long"), "vec_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


NEAR_VECTORS_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.9),
n AS (SELECT vec_id, count(b) AS n FROM v LEFT JOIN l ON a = vec_id GROUP BY vec_id),
c(x, y) AS (SELECT vec_id, vec_id FROM v UNION SELECT c.x, l.b FROM c JOIN l ON c.y = l.a)
SELECT x AS vec_id, n AS n_links, min(y) AS component_id, x = min(y) AS kept FROM c JOIN n ON vec_id = x GROUP BY x, n
"""
