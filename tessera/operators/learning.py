"""Components, clusters and mixtures of cell tables, by passes over all rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import ceil
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tessera.operators.graph import connected_components
from tessera.plans.lineage import collect, cut, discard, remove

#: Links that a part of a graph holds, about.
LINKS = 1 << 15
#: Points of a box in k-means, at most, and numbers that a part of its points holds, about.
BOX, VALUES = 1 << 10, 1 << 21
#: Boxes near no border of clusters are summed once for so many times the last move of any centre.
STEPS = 8


def _vectors(df: DataFrame, markers: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(markers), outputCol="_v", handleInvalid="skip").transform(df)


def pca2(df: DataFrame, markers: Sequence[str], ids: Sequence[str]) -> DataFrame:
    """Two principal components of centred markers as X and Y; the largest loading of each is positive."""
    d = _vectors(df, markers)
    d = StandardScaler(inputCol="_v", outputCol="_z", withMean=True, withStd=False).fit(d).transform(d)
    model = PCA(k=2, inputCol="_z", outputCol="_p").fit(d)
    loadings = model.pc.toArray()
    signs = [1.0 if x[abs(x).argmax()] >= 0 else -1.0 for x in loadings.T]
    p = vector_to_array("_p")
    return model.transform(d).select(*ids, (p[0] * signs[0]).alias("X"), (p[1] * signs[1]).alias("Y"))


def kmeans(df: DataFrame, markers: Sequence[str], ids: Sequence[str], k: int, restarts: int = 10, iterations: int = 300, seed: int = 1234, tol: float = 1e-4) -> DataFrame:
    """Clusters of the restart with the least cost, as strings: :func:`_starts` and :func:`_lloyd` for all restarts at once.

    Rows of equal markers are counted first; the distinct ones with their counts are packed into boxes (:func:`_boxes`). Rows without a marker are left out, infinite markers refused.
    """
    values = [F.col(f"`{m}`").cast("double") for m in markers]
    names = [f"x{i}" for i in range(len(markers))]
    there = lambda columns: reduce(lambda a, b: a & b, (c.isNotNull() & ~F.isnan(c) for c in columns))
    written = cut(df.select(*(v.alias(n) for v, n in zip(values, names, strict=True))).groupBy(*names).agg(F.count("*").cast("double").alias("_n")), "counts")
    counts = written.where(there(F.col(n) for n in names))
    rows, total, largest = counts.agg(F.count("*"), F.sum("_n"), F.max(F.greatest(F.lit(0.0), *(F.abs(n) for n in names)))).first()
    if not rows or largest == float("inf"):
        raise ValueError("k-means needs rows with markers, all of them finite")
    boxes = _boxes(counts, names, rows).persist()
    best = _lloyd(boxes, _starts(boxes, total, k, restarts, seed), total, iterations, tol)
    boxes.unpersist()
    discard(written)
    apart = F.array(*(sum(((v - float(x)) ** 2 for v, x in zip(values, c, strict=True)), F.lit(0.0)) for c in best))
    return df.where(there(values)).select(*ids, F.lit("kmeans").alias("cl_method"), (F.array_position(apart, F.array_min(apart)) - 1).cast("string").alias("cluster"))


def _boxes(counts: DataFrame, names: Sequence[str], rows: int) -> DataFrame:
    """Distinct points with counts ``_n`` as rows (stats, points, open), up to BOX near points each: count, squares about the mean, mean, least and largest coordinates; and the points.

    Points are dealt to parts of about VALUES numbers, and a part is halved at the median of its widest coordinate, again and again. ``open`` is null: for all restarts.
    """
    def pack(batches):
        got = [np.column_stack([c.to_numpy(zero_copy_only=False) for c in b.columns]) for b in batches if b.num_rows]
        todo, stats, points = [np.concatenate(got)] if got else [], [], []
        while todo:
            y = todo.pop()
            x, n = y[:, :-1], y[:, -1]
            lo, hi = x.min(axis=0), x.max(axis=0)
            if len(y) > BOX:
                y = y[np.argpartition(x[:, np.argmax(hi - lo)], len(y) // 2)]
                todo += [y[len(y) // 2 :], y[: len(y) // 2]]
                continue
            mean = n @ x / n.sum()
            stats.append(np.concatenate(((n.sum(), n @ np.square(x - mean).sum(axis=1)), mean, lo, hi)).tobytes())
            points.append(y.tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in (stats, points, [None] * len(stats))], names=["stats", "points", "open"])

    dealt = counts.select(*names, "_n").repartition(max(1, ceil(rows * (len(names) + 1) / VALUES)), *names)
    return dealt.sortWithinPartitions(*names).mapInArrow(pack, "stats binary, points binary, open binary")


def _points(batch: pa.RecordBatch, box: int, d: int) -> tuple[np.ndarray, np.ndarray]:
    """The points of a box and their counts."""
    y = np.frombuffer(batch.column(1)[int(box)].as_buffer()).reshape(-1, d + 1)
    return y[:, :-1], y[:, -1]


def _split(batch: pa.RecordBatch, c: np.ndarray, room: float = 0.0) -> tuple[np.ndarray, ...]:
    """Of each box: count, mean, squared distances to the centre nearest to the mean, that centre, and which centres may be nearest to some place in it, if none moves by more than ``room``."""
    d = c.shape[1]
    s = np.array([np.frombuffer(x) for x in batch.column(0).to_pylist()]).reshape(-1, 3 * d + 2)
    n, within, mean, lo, hi = s[:, 0], s[:, 1], s[:, 2 : 2 + d], s[:, None, 2 + d : 2 + 2 * d], s[:, None, 2 + 2 * d :]
    near = np.square(mean[:, None] - c).sum(axis=2).argmin(axis=1)
    first = c[near][:, None]
    corner = np.where(c > first, hi, lo)  # the place of the box that favours a centre most against the first
    own, other = np.square(corner - first).sum(axis=2), np.square(corner - c).sum(axis=2)
    far = np.sqrt(np.square(np.maximum(np.abs(lo - c), np.abs(hi - c))).sum(axis=2))
    far = far + far[np.arange(len(far)), near][:, None]
    return n, mean, within + n * np.square(mean - first[:, 0]).sum(axis=1), near, other - own <= 1e-9 * (other + own) + 2 * room * far


def _add(total: np.ndarray, c: np.ndarray, batch: pa.RecordBatch, i: int) -> np.ndarray:
    """Adds to ``total`` the counts, squared distances and sums of the points nearest to each centre, in boxes open for restart ``i``. The squared distances of each box."""
    n, mean, apart, near, maybe = _split(batch, c)
    mine = np.array([x is None or x[i] > 0 for x in batch.column(2).to_pylist()], bool)
    whole = mine & (maybe.sum(axis=1) == 1)
    np.add.at(total, near[whole], np.column_stack((n, apart, n[:, None] * mean))[whole])
    for b in np.flatnonzero(mine & ~whole):
        (x, n), some = _points(batch, b, c.shape[1]), np.flatnonzero(maybe[b])
        to = np.square(x[:, None] - c[some]).sum(axis=2)
        at = to.argmin(axis=1)
        to = n * to[np.arange(len(x)), at]
        total[some] += np.array([np.bincount(at, v, len(some)) for v in np.column_stack((n, to, n[:, None] * x)).T]).T
        apart[b] = to.sum()
    return apart


def _sums(boxes: DataFrame, centres: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """Per restart, a row for each centre: count, squared distances and sums of the points nearest to it. One pass, and one row from each task."""
    def sums(batches):
        total = {i: np.zeros((len(c), c.shape[1] + 2)) for i, c in centres.items()}
        for batch in batches:
            for i, c in centres.items():
                _add(total[i], c, batch, i)
        yield pa.RecordBatch.from_arrays([pa.array([_flat(total)], pa.binary())], names=["sums"])

    return _shaped(boxes.mapInArrow(sums, "sums binary"), centres)


def _flat(total: dict[int, np.ndarray]) -> bytes:
    return np.concatenate([t.ravel() for t in total.values()]).tobytes()


def _shaped(rows: DataFrame, centres: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """The sum of the tasks' rows, by restart."""
    flat = np.sum([np.frombuffer(r["sums"]) for r in rows.select("sums").collect()], axis=0)
    ends = np.cumsum([len(c) * (c.shape[1] + 2) for c in centres.values()])
    return {i: t.reshape(len(c), -1) for (i, c), t in zip(centres.items(), np.split(flat, ends[:-1]), strict=True)}


def _lloyd(boxes: DataFrame, starts: Sequence[np.ndarray], total: float, iterations: int, tol: float) -> np.ndarray:
    """The centres of the start whose rounds end in the least cost. Rounds of a start end when no centre moves by more than ``tol``, or after ``iterations``.

    A round is one pass for all starts that still move. A box that lies nearer to one centre than to all others counts as a whole, by its mean; of any other the points
    are compared with the centres that may be nearest. Boxes of which this will hold while no centre leaves its surroundings, some steps wide, are summed once
    (:func:`_settled`), and rounds go over the rest until one does. The sums are those over all points.
    """
    centres, cost, step = dict(enumerate(np.array(c, float) for c in starts)), [np.inf] * len(starts), [np.inf] * len(starts)
    held, moving = None, list(centres)
    for _ in range(iterations):
        if not moving:
            break
        now = {i: centres[i] for i in moving}
        wide = max(STEPS * step[i] / _gap(c) for i, c in now.items())
        if held is None or wide < kept / 4 or any(_far(c, at[i]) > room[i] for i, c in now.items()):
            if held is not None:
                held.unpersist()
            left, held, at, kept, settled = boxes, None, now, wide, {i: np.zeros((len(c), c.shape[1] + 2)) for i, c in now.items()}
            if wide < 1 / 8:  # else most boxes are open
                room = {i: STEPS * step[i] for i in moving}
                held, left, settled = _settled(boxes, now, room, total)
        sums, moving = _sums(left, now), []
        for i, c in now.items():
            by, t = at[i] - c, settled[i]
            t = sums[i] + np.column_stack((t[:, 0], t[:, 1] + 2 * (by * (t[:, 2:] - t[:, :1] * at[i])).sum(axis=1) + t[:, 0] * np.square(by).sum(axis=1), t[:, 2:]))
            some = t[:, 0] > 0
            centres[i], cost[i] = np.where(some[:, None], t[:, 2:] / np.where(some, t[:, 0], 1.0)[:, None], c), t[:, 1].sum()
            step[i] = _far(centres[i], c)
            if step[i] > tol:
                moving.append(i)
    if held is not None:
        held.unpersist()
    return centres[int(np.argmin(cost))]


def _gap(c: np.ndarray) -> float:
    """How far a centre is from the next one, on average."""
    apart = np.sqrt(np.square(c[:, None] - c).sum(axis=2)) + np.diag(np.full(len(c), np.inf))
    return float(apart.min(axis=1).mean()) or np.finfo(float).tiny


def _far(a: np.ndarray, b: np.ndarray) -> float:
    return float(np.sqrt(np.square(a - b).sum(axis=1).max()))


def _settled(boxes: DataFrame, centres: dict[int, np.ndarray], room: dict[int, float], total: float) -> tuple[DataFrame, DataFrame, dict[int, np.ndarray]]:
    """What is kept, the boxes in it that are open for some restart, and the sums of those that lie nearer to one centre wherever in their ``room`` the centres are."""
    size = max(centres) + 1

    def settle(batches):
        sums = {i: np.zeros((len(c), c.shape[1] + 2)) for i, c in centres.items()}
        for batch in batches:
            left = np.zeros((batch.num_rows, size), np.uint8)
            for i, c in centres.items():
                n, mean, apart, near, maybe = _split(batch, c, room[i])
                whole = maybe.sum(axis=1) == 1
                np.add.at(sums[i], near[whole], np.column_stack((n, apart, n[:, None] * mean))[whole])
                left[:, i] = ~whole
            some = np.flatnonzero(left.any(axis=1))
            yield pa.RecordBatch.from_arrays([*(batch.column(j).take(pa.array(some)) for j in (0, 1)), pa.array([x.tobytes() for x in left[some]], pa.binary()), pa.nulls(len(some), pa.binary())], names=names)
        yield pa.RecordBatch.from_arrays([*(pa.nulls(1, pa.binary()) for _ in range(3)), pa.array([_flat(sums)], pa.binary())], names=names)

    names = ["stats", "points", "open", "sums"]
    held = boxes.mapInArrow(settle, ", ".join(f"{x} binary" for x in names)).persist()
    sums = _shaped(held.where("sums is not null"), centres)
    share = min(1.0, sum(1 - t[:, 0].sum() / total for t in sums.values()))
    parts = max(boxes.sparkSession.sparkContext.defaultParallelism, ceil(share * total * (next(iter(centres.values())).shape[1] + 1) / VALUES))
    return held, held.where("sums is null").drop("sums").coalesce(parts), sums


def _starts(boxes: DataFrame, total: float, k: int, restarts: int, seed: int, steps: int = 2) -> list[np.ndarray]:
    """Up to k centres for each restart by k-means||: one point drawn by counts; in each step some 2 k more, by counts and squared distance to those drawn; of all these, k by k-means++
    and rounds among them, weighted by the points nearest to each. Steps go on, to ten at most, while fewer than k distinct points are drawn and others are left.
    """
    rngs = [np.random.default_rng(seed % 2**32 + i) for i in range(restarts)]
    drawn: dict[int, np.ndarray | None] = dict.fromkeys(range(restarts))
    for turn in range(10):
        some = {i: c for i, c in drawn.items() if c is None or turn <= steps or len(c) < k}
        known = {i: c for i, c in some.items() if c is not None}
        cost = dict.fromkeys(some, total) | ({i: t[:, 1].sum() for i, t in _sums(boxes, known).items()} if known else {})
        some = {i: c for i, c in some.items() if cost[i] > 0}
        if not some:
            break
        for i, x in _drawn(boxes, some, cost, 2.0 * k, seed, turn).items():
            drawn[i] = x[[rngs[i].integers(len(x))]] if drawn[i] is None else np.unique(np.concatenate((drawn[i], x)), axis=0)
    if missing := [i for i, c in drawn.items() if c is None]:
        raise ValueError(f"no point was drawn for restarts {missing}")
    return [_plus_plus(drawn[i], t[:, 0], k, rngs[i]) for i, t in _sums(boxes, drawn).items()]


def _drawn(boxes: DataFrame, centres: dict[int, np.ndarray | None], cost: dict[int, float], most: float, seed: int, turn: int) -> dict[int, np.ndarray]:
    """Points drawn for each restart, ``most`` on average, by count and squared distance to its centres; by count where it has none."""
    def draw(batches):
        for batch in batches:
            out = []
            for i, c in centres.items() if batch.num_rows else ():
                stats = [np.frombuffer(x) for x in batch.column(0).to_pylist()]
                d = (len(stats[0]) - 2) // 3
                rng = np.random.default_rng([seed % 2**32, i, turn, crc32(stats[0].tobytes())])
                weight = np.array([x[0] for x in stats]) if c is None else _add(np.zeros((len(c), d + 2)), c, batch, i)
                hits = rng.poisson(most * weight / cost[i])
                for b in np.flatnonzero(hits):
                    x, n = _points(batch, b, d)
                    p = n if c is None else n * np.square(x[:, None] - c).sum(axis=2).min(axis=1)
                    if p.sum() > 0:
                        out += [(i, x[j].tobytes()) for j in rng.choice(len(x), hits[b], p=p / p.sum())]
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in out], pa.int32()), pa.array([x for _, x in out], pa.binary())], names=["i", "point"])

    found: dict[int, list[np.ndarray]] = {}
    for r in boxes.mapInArrow(draw, "i int, point binary").collect():
        found.setdefault(r["i"], []).append(np.frombuffer(r["point"]))
    return {i: np.array(x) for i, x in found.items()}


def _plus_plus(points: np.ndarray, weight: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 30) -> np.ndarray:
    """k centres of a few weighted points; all points, if there are no more than k."""
    if len(points) <= k:
        return points
    apart = lambda c: np.square(points[:, None] - c).sum(axis=2)
    c = points[[rng.choice(len(points), p=weight / weight.sum())]]
    while len(c) < k and (p := weight * apart(c).min(axis=1)).sum() > 0:
        c = np.concatenate((c, points[[rng.choice(len(points), p=p / p.sum())]]))
    for _ in range(rounds):
        at = apart(c).argmin(axis=1)
        n, sums = np.bincount(at, weight, len(c)), np.array([np.bincount(at, weight * x, len(c)) for x in points.T]).T
        c = np.where(n[:, None] > 0, sums / np.where(n > 0, n, 1.0)[:, None], c)
    return c


def fit_two_normals(counts: DataFrame, least_gain: float = 1e-5, most_rounds: int = 2000) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights, means and deviations of two normal components of (x, n), n the rows with a value x: expectation-maximisation over all of them.

    The components start as the two clusters of values that Lloyd's rounds from the least and the largest value end in. A round is one aggregate of seven sums, so that
    no sample is drawn and reruns agree but for the last bits of sums. It ends where the mean log-likelihood gains less than ``least_gain``, and raises
    an error if ``most_rounds`` do not get there. Variances are at least a millionth, as one value may hold a whole component.
    """
    n = F.col("n")
    total, centre, lo, hi = counts.agg(F.sum("n"), F.sum(n * F.col("x")) / F.sum("n"), F.min("x"), F.max("x")).first()
    x = F.col("x") - F.lit(centre)
    mean = np.array([lo - centre, hi - centre])
    while True:
        low = x <= float(mean.mean())
        s = counts.agg(*(F.coalesce(F.sum(F.when(side, w)), F.lit(0.0)).cast("double") for side in (low, ~low) for w in (n, n * x, n * x * x))).first()
        k = np.array(s, float).reshape(2, 3)
        new = np.where(k[:, 0] > 0, k[:, 1] / np.maximum(k[:, 0], 1), mean)
        if np.allclose(new, mean, rtol=1e-12, atol=1e-12):
            break
        mean = new
    weight = np.maximum(k[:, 0] / total, 1e-9)
    variance = np.maximum(np.where(k[:, 0] > 0, k[:, 2] / np.maximum(k[:, 0], 1) - mean**2, 0.0), 1e-6)
    before = -np.inf
    for _ in range(most_rounds):
        log_p = [F.lit(float(np.log(w / np.sqrt(2 * np.pi * v)))) - (x - float(m)) ** 2 / (2 * float(v)) for w, m, v in zip(weight, mean, variance, strict=True)]
        top = F.greatest(*log_p)
        both = top + F.log(F.exp(log_p[0] - top) + F.exp(log_p[1] - top))
        share = [F.exp(p - both) for p in log_p]
        s = counts.agg(F.sum(n * both), *(F.sum(n * r * w) for r in share for w in (F.lit(1.0), x, x * x))).first()
        k = np.array(s[1:], float).reshape(2, 3)
        k[:, 0] = np.maximum(k[:, 0], 1e-300)
        weight, mean = k[:, 0] / total, k[:, 1] / k[:, 0]
        variance = np.maximum(k[:, 2] / k[:, 0] - mean**2, 1e-6)
        if s[0] / total - before < least_gain:
            return weight, mean + centre, np.sqrt(variance)
        before = s[0] / total
    raise ValueError(f"the mixture has not settled within {most_rounds} rounds")


def mixture_threshold(df: DataFrame, value: str, points: int = 1000) -> DataFrame:
    """Where two normal components of ``value`` are most alike above the smaller mean: one row ``threshold``, of ``points`` between its least and largest value.

    All rows count: values are first counted, then :func:`fit_two_normals` reads the counts. Null and NaN do not count; without a value the threshold is null.
    """
    spark = df.sparkSession
    d = df.select(F.col(value).cast("double").alias("x")).where("x is not null and not isnan(x)")
    counts = cut(d.groupBy("x").agg(F.count("*").alias("n")), "counts")
    lo, hi = counts.agg(F.min("x"), F.max("x")).first()
    if lo is None:
        return spark.createDataFrame([(None,)], "threshold double")
    weight, mean, spread = fit_two_normals(counts)
    x = lo + np.arange(points) * (hi - lo) / (points - 1)
    a, b = (w / s * np.exp(-((x - m) ** 2) / (2 * s * s)) for w, m, s in zip(weight, mean, spread, strict=True))
    with np.errstate(all="ignore"):
        alike = np.where(a != b, (a + b) / np.abs(a - b), 0.0)
    above = np.flatnonzero(x > mean.min())
    best = float(x[above[np.argmax(alike[above])]]) if len(above) else None
    return spark.createDataFrame([(best,)], "threshold double")


def som(df: DataFrame, markers: Sequence[str], ids: Sequence[str], k: int, side: int = 10, sigma: float = 1.0, epochs: int = 20, seed: int = 1234) -> DataFrame:
    """Clusters of a self-organising map of ``side`` x ``side`` nodes, merged to k by Ward's rule, as strings.

    Batch training: each epoch sums the cells nearest to each node, and a node becomes the mean of its neighbourhood's sums, whose width shrinks to ``sigma``. Only the
    nodes' sums reach the driver, side^2 rows. Rows with a null marker are left out. Nodes start at cells in hash order.
    """
    d = df.select(*ids, *(F.col(f"`{m}`").cast("double").alias(m) for m in markers)).dropna("any", subset=list(markers))
    scale = d.agg(*(f(m).alias(f"{k_}_{i}") for i, m in enumerate(markers) for k_, f in (("m", F.avg), ("s", F.stddev_pop)))).first()
    mean = np.array([scale[f"m_{i}"] or 0.0 for i in range(len(markers))])
    spread = np.array([scale[f"s_{i}"] or 1.0 for i in range(len(markers))])
    nodes = side * side
    first = d.orderBy(F.xxhash64(F.lit(seed), *ids), *ids).limit(nodes).select(*markers).toPandas().to_numpy(float)
    if not len(first):
        return d.select(*ids, F.lit("som").alias("cl_method"), F.lit("0").alias("cluster")).limit(0)
    book = ((first - mean) / spread)[np.arange(nodes) % len(first)]
    grid = np.array([(i, j) for i in range(side) for j in range(side)], float)
    apart = np.square(grid[:, None] - grid[None]).sum(axis=2)
    width = [sigma + (side / 2 - sigma) * (1 - e / max(epochs - 1, 1)) for e in range(epochs)]

    def nearest(batch: pa.RecordBatch, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = (np.column_stack([batch.column(batch.schema.get_field_index(m)).to_numpy(zero_copy_only=False) for m in markers]) - mean) / spread
        return x, np.argmin(np.square(book).sum(axis=1)[None] - 2 * x @ book.T, axis=1) if len(x) else np.zeros(0, int)

    names = [f"x{i}" for i in range(len(markers))]
    for e in range(epochs):
        now = book

        def sums(batches, now=now):
            total, count = np.zeros((nodes, len(markers))), np.zeros(nodes)
            for batch in batches:
                x, at = nearest(batch, now)
                np.add.at(total, at, x)
                count += np.bincount(at, minlength=nodes)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(nodes)), pa.array(count), *(pa.array(c) for c in total.T)], names=["node", "n", *names])

        got = d.select(*markers).mapInArrow(sums, "node long, n double, " + ", ".join(f"{x} double" for x in names)).groupBy("node").agg(F.sum("n").alias("n"), *(F.sum(x).alias(x) for x in names)).toPandas()
        if not len(got):
            break
        got = got.set_index("node").reindex(range(nodes)).fillna(0.0)
        pull = np.exp(-apart / (2 * width[e] ** 2))
        weight = pull @ got["n"].to_numpy()
        book = np.where(weight[:, None] > 1e-9, (pull @ got[names].to_numpy()) / np.maximum(weight, 1e-9)[:, None], book)
    label = ward(book, k)

    def assign(batches):
        for batch in batches:
            _, at = nearest(batch, book)
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(i)) for i in ids), pa.array(label[at].astype(str).tolist(), pa.string())], names=[*ids, "cluster"])

    kinds = dict(d.dtypes)
    out = d.mapInArrow(assign, ", ".join(f"{i} {kinds[i]}" for i in ids) + ", cluster string")
    return out.select(*ids, F.lit("som").alias("cl_method"), "cluster")


def ward(points: np.ndarray, k: int) -> np.ndarray:
    """Labels 0..k-1 of a few hundred points: the two clusters whose merger adds least variance are merged until k are left."""
    groups = [[i] for i in range(len(points))]
    while len(groups) > k:
        centre, n = np.array([points[g].mean(axis=0) for g in groups]), np.array([len(g) for g in groups], float)
        cost = np.square(centre[:, None] - centre[None]).sum(axis=2) * (n[:, None] * n[None]) / (n[:, None] + n[None])
        np.fill_diagonal(cost, np.inf)
        i, j = sorted(np.unravel_index(np.argmin(cost), cost.shape))
        groups[i] += groups.pop(j)
    label = np.zeros(len(points), int)
    for at, g in enumerate(sorted(groups, key=min)):
        label[g] = at
    return label


def communities(edges: DataFrame, resolution: float = 1.0, least_gain: float = 1e-6, seed: int = 1234) -> DataFrame:
    """Rows (node, community) of an undirected weighted graph (a, b, weight): local moving, splitting and contraction by modularity, to the end.

    In a round half of the nodes (the other half in the next) may move to the neighbouring community of the largest gain (the smallest name on ties), so that two do
    not swap for ever. Rounds end when two of them gain less than ``least_gain``, and the best labels stay. Then each community is split into its
    connected parts, which can only gain, and these become nodes of a smaller graph; levels end when one gains less than that. All
    steps are joins and sums; each round's table is written, so that a lost executor costs a re-read. A level's links are dealt by node once, for all its
    rounds, and a round's sums tell the modularity of the labels that it starts from. Communities are connected; each has the name of a node.
    """
    e = edges.select(F.col("a").cast("string").alias("a"), F.col("b").cast("string").alias("b"), F.col("weight").cast("double").alias("w")).where("w > 0")
    member, level = None, 0
    while True:
        loops = e.where("a = b").select("a", "b", 2 * F.col("w"))
        both = cut(e.where("a <> b").select("a", "b", "w").union(e.where("a <> b").select("b", "a", "w")).union(loops), "links")
        n, total, looped = both.agg(F.count("*"), F.sum("w"), F.coalesce(F.sum(F.when(F.col("a") == F.col("b"), F.col("w"))), F.lit(0.0))).first()
        if not total:
            break
        label = cut(both.groupBy(F.col("a").alias("node")).agg(F.sum("w").alias("k")).select("node", F.col("node").alias("community"), "k"), "communities")
        links = _dealt(both, label, n)
        kept, best, turn, idle = label, None, 0, 0
        while True:
            new, inside, squares = _moved(links, label, total, resolution, seed + 977 * level, turn)
            q = (inside + looped) / total - resolution * squares / total**2  # of ``label``
            if best is None:
                best = start = last = q
            else:
                idle = 0 if q > last + least_gain else idle + 1
                last = max(q, last)
                old, kept, best = (kept, label, q) if q > best else (label, kept, best)
                remove(old.sparkSession, old._tessera_path)
            if idle == 2:
                break
            label, turn = new, turn + 1
            if turn % 8 == 0:
                collect(label.sparkSession)
        links.unpersist()
        discard(new)
        if member is not None and best <= start + least_gain:
            break
        step = _connected_parts(both, kept)
        member = step if member is None else cut(member.select("node", F.col("community").alias("mid")).join(step.select(F.col("node").alias("mid"), "community"), "mid").select("node", "community"), "members")
        if best <= start + least_gain:
            break
        level += 1
        named = lambda x, y: step.select(F.col("node").alias(x), F.col("community").alias(y))
        c = e.join(named("a", "ca"), "a").join(named("b", "cb"), "b")
        e = cut(c.groupBy(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b")).agg(F.sum("w").alias("w")), "contracted")
    return member if member is not None else e.select(F.col("a").alias("node"), F.col("a").alias("community")).limit(0)


def _dealt(both: DataFrame, label: DataFrame, n: int) -> DataFrame:
    """Rows (a, k, b, w), kept by b for the rounds of a level: ``n`` links in both directions without loops, one of no weight from each node to itself, and a's degree k."""
    own = label.select(F.col("node").alias("a"), "k")
    links = both.where("a <> b").union(own.select("a", F.col("a").alias("b"), F.lit(0.0).alias("w"))).join(own, "a")  # a single part would have no key, and joins would deal it again
    links = links.select("a", "k", "b", "w").repartition(max(2, ceil(n / LINKS)), "b").sortWithinPartitions("b").persist()
    links.count()  # the parts are known to the rounds' plans from here on
    return links


def _moved(links: DataFrame, label: DataFrame, total: float, resolution: float, seed: int, turn: int) -> tuple[DataFrame, float, float]:
    """Labels after one round; in turns one half of the nodes or the other may move. And, of ``label``, the links within communities without loops, and the sum of squared masses.

    A label brings its community's mass to the links, so that these are shuffled to their other end only; a node's link to itself brings its own.
    """
    mass = label.groupBy("community").agg(F.sum("k").alias("mass"))
    near = links.join(label.join(mass, "community").select(F.col("node").alias("b"), F.col("community").alias("to"), "mass"), "b")
    near = near.groupBy("a", "k", "to").agg(F.sum("w").alias("w"), F.max("mass").alias("mass"), F.max(F.col("a") == F.col("b")).alias("own"))
    rest = F.col("mass") - F.when(F.col("own"), F.col("k")).otherwise(0.0)
    near = near.withColumn("gain", F.col("w") - resolution * F.col("k") * rest / total)
    best = near.groupBy("a", "k").agg(
        F.min_by(F.struct("to", "gain"), F.struct(-F.round("gain", 9), "to")).alias("x"), F.max(F.when(F.col("own"), F.struct("to", "gain", "w", "mass"))).alias("now"))
    half = F.pmod(F.xxhash64("a", F.lit(seed + 31 * (turn // 2))) + turn % 2, F.lit(2)) == 0
    go = half & (F.col("x.gain") > F.col("now.gain") + 1e-9)
    sums = Observation()
    out = best.observe(sums, F.sum("now.w").alias("inside"), F.sum(F.col("k") * F.col("now.mass")).alias("squares"))
    new = cut(out.select(F.col("a").alias("node"), F.when(go, F.col("x.to")).otherwise(F.col("now.to")).alias("community"), "k"), "communities")
    return new, sums.get["inside"], sums.get["squares"]


def _connected_parts(both: DataFrame, label: DataFrame) -> DataFrame:
    """Rows (node, community): each community's connected parts, named by their smallest nodes."""
    named = lambda x: label.select(F.col("node").alias(x), F.col("community").alias(f"c{x}"))
    inside = both.where("a < b").join(named("a"), "a").join(named("b"), "b").where("ca = cb")
    found = connected_components(inside.select("a", "b"))
    return cut(label.select("node").join(found, "node", "left").select("node", F.coalesce("component", "node").alias("community")), "parts")
