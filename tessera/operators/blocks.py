"""Pixel tables in blocks: one row per square of an image, with its pixels as an array.

A table of blocks has the keys of its pixel table (image_id, scene_id, ...), the block's place (br, bc) and ``v``, side * side doubles row by row,
null where there is no pixel (NaN counts as none). A pixel (r, c) lies in block (r div side, c div side). Steps on blocks move whole blocks, or strips of
their borders, where steps on rows shuffle each pixel with its keys.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.graph import connected_components, least_reachable
from tessera.plans.lineage import cut

SIDE = 256
AT = ("br", "bc")


def keys_of(table: DataFrame) -> list[str]:
    return [c for c in table.columns if c not in ("r", "c", "v", *AT)]


def _schema(table: DataFrame, columns: list[str]) -> str:
    kinds = dict(table.dtypes)
    return "".join(f"`{c}` {kinds[c]}, " for c in columns)


def _grids(column: pa.Array) -> np.ndarray:
    """The arrays of a column, nulls as NaN, as squares."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    side = int(round((len(flat) / max(len(column), 1)) ** 0.5))
    return flat.reshape(len(column), side, side)


def _lists(grids: list[np.ndarray], kind: pa.DataType = pa.float64()) -> pa.Array:
    sizes = np.cumsum([0, *(g.size for g in grids)])
    flat = np.concatenate([g.ravel() for g in grids]) if grids else np.zeros(0)
    values = pa.array(flat.astype(np.float64), from_pandas=True)
    return pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), values.cast(kind))


def to_blocks(px: DataFrame, side: int = SIDE) -> DataFrame:
    """Blocks of a pixel table (keys, r, c, v) with r and c from 0; of repeated places the largest value stays, null values count as no pixel. An empty table gives no blocks."""
    keys = keys_of(px)
    place = F.pmod("r", F.lit(side)) * side + F.pmod("c", F.lit(side))
    d = px.where("v is not null and r >= 0 and c >= 0").select(*keys, *(F.floor(F.col(x) / side).cast("int").alias(b) for x, b in zip(("r", "c"), AT, strict=True)), place.cast("int").alias("at"), F.col("v").cast("double").alias("v"))

    def build(group: pa.Table) -> pa.Table:  # side * side rows, but for repeated places
        out = np.full(side * side, np.nan)
        np.fmax.at(out, group.column("at").to_numpy(), group.column("v").to_numpy())
        head = group.slice(0, 1).select([*keys, *AT])
        return head.append_column("v", _lists([out]))

    return d.groupBy(*keys, *AT).applyInArrow(build, f"{_schema(d, [*keys, *AT])}v array<double>")


def from_blocks(blocks: DataFrame, kind: str = "double") -> DataFrame:
    """The pixel table again."""
    keys = keys_of(blocks)
    side = F.sqrt("_n").cast("int")
    rows = blocks.select(*keys, *AT, F.size("v").alias("_n"), F.posexplode("v").alias("_at", "v")).where("v is not null")
    r = F.col("br") * side + F.floor(F.col("_at") / side)
    return rows.select(*keys, r.cast("int").alias("r"), (F.col("bc") * side + F.col("_at") % side).cast("int").alias("c"), F.col("v").cast(kind).alias("v"))


def apply_mask(blocks: DataFrame, foreground: DataFrame) -> DataFrame:
    """v becomes 0 outside of the pixels of ``foreground`` (blocks of the same side, with any of the keys): blocks meet blocks, pixels stay in Spark's arrays."""
    shared = [k for k in keys_of(foreground) if k in keys_of(blocks)]
    j = blocks.join(foreground.select(*shared, *AT, F.col("v").alias("_in")), [*shared, *AT], "left")
    under = F.zip_with("v", "_in", lambda x, y: F.when(x.isNotNull() & y.isNull(), 0.0).otherwise(x))
    none = F.transform("v", lambda x: F.when(x.isNotNull(), 0.0))
    return j.select(*keys_of(blocks), *AT, F.when(F.col("_in").isNull(), none).otherwise(under).alias("v"))


def crop(blocks: DataFrame, r0: int, c0: int, r1: int, c1: int) -> DataFrame:
    """Pixels of a box with exclusive upper bounds, counted from its corner. Blocks off the box are not read into Python; the others give at most four pieces, which meet by their new block."""
    keys = keys_of(blocks)
    first = blocks.select(F.sqrt(F.size("v")).cast("int")).first()
    if first is None or r1 <= r0 or c1 <= c0:
        return blocks.limit(0)
    side = first[0]
    inside = blocks.where(F.col("br").between(r0 // side, (r1 - 1) // side) & F.col("bc").between(c0 // side, (c1 - 1) // side))

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, from_row = [], []
            for k, (g, br, bc) in enumerate(zip(_grids(batch.column("v")), batch.column("br").to_pylist(), batch.column("bc").to_pylist(), strict=True)):
                rows = np.arange(max(r0, br * side), min(r1, br * side + side))
                cols = np.arange(max(c0, bc * side), min(c1, bc * side + side))
                for tr in np.unique((rows - r0) // side):
                    for tc in np.unique((cols - c0) // side):
                        y, x = rows[(rows - r0) // side == tr], cols[(cols - c0) // side == tc]
                        part = g[y[0] - br * side : y[-1] + 1 - br * side, x[0] - bc * side : x[-1] + 1 - bc * side]
                        out.append((int(tr), int(tc), int((y[0] - r0) % side), int((x[0] - c0) % side), len(x), part))
                        from_row.append(k)
            head = batch.select(keys).take(pa.array(from_row, pa.int64()))
            columns = [pa.array([o[i] for o in out], pa.int32()) for i in range(5)]
            yield pa.RecordBatch.from_arrays([*head.columns, *columns, _lists([o[5] for o in out])], names=[*keys, *AT, "r0", "c0", "w", "v"])

    def put_together(group: pa.Table) -> pa.Table:  # at most four pieces
        grid = np.full((side, side), np.nan)
        for y, x, w, v in zip(*(group.column(c).to_pylist() for c in ("r0", "c0", "w", "v")), strict=True):
            part = np.array(v, float).reshape(-1, w)
            grid[y : y + len(part), x : x + w] = part
        return group.slice(0, 1).select([*keys, *AT]).append_column("v", _lists([grid]))

    moved = inside.select(*keys, *AT, "v").mapInArrow(pieces, f"{_schema(blocks, keys)}br int, bc int, r0 int, c0 int, w int, v array<double>")
    return moved.groupBy(*keys, *AT).applyInArrow(put_together, f"{_schema(blocks, keys)}br int, bc int, v array<double>")


def with_halo(blocks: DataFrame, margin: int, work: Callable, by: list[str] | None = None, alone: bool = False, kind: str = "double") -> DataFrame:
    """What ``work(br, bc, {rest of keys: padded block})`` yields as (rest of keys, array), for each block of each ``by``.

    A block goes to its own group whole and to its eight neighbours as strips of ``margin`` pixels (at most the side), so that each group holds
    one padded block per remaining key. ``alone``: also where only strips arrive, no block.
    """
    keys = keys_of(blocks)
    by = keys if by is None else by
    rest = [k for k in keys if k not in by]
    steps = [(i, j) for i in (-1, 0, 1) for j in (-1, 0, 1)]

    def strips(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, g in enumerate(_grids(batch.column("v"))):
                br, bc, side, out = batch.column("br")[k].as_py(), batch.column("bc")[k].as_py(), len(g), []
                part = {0: slice(0, side), 1: slice(side - margin, side), -1: slice(0, margin)}
                for n, (i, j) in enumerate(steps):
                    if br + i >= 0 and bc + j >= 0 and ((i, j) == (0, 0) or margin):
                        p = g[part[i], part[j]]
                        if (i, j) == (0, 0) or not np.isnan(p).all():
                            out.append((br + i, bc + j, n, side, p))
                head = batch.select(keys).take(pa.array([k] * len(out)))
                columns = [pa.array([o[c] for o in out], pa.int32()) for c in range(4)]
                yield pa.RecordBatch.from_arrays([*head.columns, *columns, _lists([o[4] for o in out])], names=[*keys, *AT, "step", "side", "v"])

    def gather(group: pa.Table) -> pa.Table:  # at most nine pieces for each of the remaining keys
        side, padded, owned = group.column("side")[0].as_py(), {}, set()
        for name, step, v in zip(zip(*(group.column(c).to_pylist() for c in rest), strict=True) if rest else [()] * len(group), group.column("step").to_pylist(), group.column("v").combine_chunks(), strict=True):
            i, j = steps[step]
            grid = padded.setdefault(name, np.full((side + 2 * margin, side + 2 * margin), np.nan))
            at = {0: slice(margin, margin + side), 1: slice(0, margin), -1: slice(margin + side, side + 2 * margin)}
            y, x = at[i], at[j]
            grid[y, x] = v.values.to_numpy(zero_copy_only=False).reshape(y.stop - y.start, x.stop - x.start)
            if step == 4:
                owned.add(name)
        br, bc = group.column("br")[0].as_py(), group.column("bc")[0].as_py()
        found = list(work(br, bc, padded)) if owned or alone else []
        head = group.slice(0, 1).select(by).to_pylist()[0]
        columns = [pa.array([head[k]] * len(found), group.schema.field(k).type) for k in by]
        columns += [pa.array([name[n] for name, _ in found], group.schema.field(k).type) for n, k in enumerate(rest_out)]
        columns += [pa.array([x] * len(found), pa.int32()) for x in (br, bc)] + [_lists([g for _, g in found], pa.int64() if kind == "long" else pa.float64())]
        return pa.Table.from_arrays(columns, names=[*by, *rest_out, *AT, "v"])

    rest_out = rest if getattr(work, "keeps_keys", True) else []
    moved = blocks.select(*keys, *AT, "v").mapInArrow(strips, f"{_schema(blocks, keys)}br int, bc int, step int, side int, v array<double>")
    return moved.groupBy(*by, *AT).applyInArrow(gather, f"{_schema(blocks, [*by, *rest_out])}br int, bc int, v array<{kind}>")


def halo_tiles(blocks: DataFrame, margin: int) -> DataFrame:
    """Each block with ``margin`` pixels around it: (keys, br, bc, v), v of side + 2 * margin squared; places that only a margin reaches are windows, too."""
    return with_halo(blocks, margin, lambda br, bc, padded: padded.items(), alone=True)


def window_rows(windows: DataFrame, margin: int) -> DataFrame:
    """The pixels of windows: (keys, r, c, v, wr, wc, lr, lc), lr and lc counted from the window's corner."""
    keys = keys_of(windows)
    d = windows.select(*keys, F.col("br").alias("wr"), F.col("bc").alias("wc"), F.sqrt(F.size("v")).cast("int").alias("_n"), F.posexplode("v").alias("_at", "v")).where("v is not null")
    d = d.withColumn("lr", F.floor(F.col("_at") / F.col("_n")).cast("int")).withColumn("lc", (F.col("_at") % F.col("_n")).cast("int"))
    place = lambda w, x: (F.col(w) * (F.col("_n") - 2 * margin) + F.col(x) - margin).cast("int")
    return d.select(*keys, place("wr", "lr").alias("r"), place("wc", "lc").alias("c"), "v", "wr", "wc", "lr", "lc")


def keep_centres(windows: DataFrame, margin: int) -> DataFrame:
    """Blocks again, each window giving its core; windows without a pixel there go."""
    keys = keys_of(windows)

    def core(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grids = [g[margin : len(g) - margin, margin : len(g) - margin] for g in _grids(batch.column("v"))]
            kept = [k for k, g in enumerate(grids) if not np.isnan(g).all()]
            yield pa.RecordBatch.from_arrays([*batch.select([*keys, *AT]).take(pa.array(kept, pa.int64())).columns, _lists([grids[k] for k in kept])], names=[*keys, *AT, "v"])

    return windows.select(*keys, *AT, "v").mapInArrow(core, f"{_schema(windows, [*keys, *AT])}v array<double>")


def extent(blocks: DataFrame) -> tuple[int, int]:
    """Largest r and c of all pixels, -1 where there is none."""

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = c = -1
        for batch in batches:
            for g, br, bc in zip(_grids(batch.column(2)), batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                y, x = np.nonzero(~np.isnan(g))
                if len(y):
                    r, c = max(r, br * len(g) + int(y.max())), max(c, bc * len(g) + int(x.max()))
        yield pa.RecordBatch.from_arrays([pa.array([r], pa.int64()), pa.array([c], pa.int64())], names=["r", "c"])

    found = blocks.select(*AT, "v").mapInArrow(ends, "r long, c long").agg(F.max("r"), F.max("c")).first()
    return (-1, -1) if found[0] is None else tuple(found)


def _window_sum(x: np.ndarray, width: int) -> np.ndarray:
    rows = sum(x[k : len(x) - width + 1 + k] for k in range(width))
    return sum(rows[:, k : x.shape[1] - width + 1 + k] for k in range(width))


def structural_similarity(blocks: DataFrame, a: str, b: str, radius: int = 3, data_range: float = 1.0) -> DataFrame:
    """Structural similarity of the images ``a`` and ``b`` of (image_id, br, bc, v) over squares, borders reflected: blocks without image_id.

    Pixels that one of them lacks do not count. Each block meets its neighbours' strips once; five products are summed in place.
    """
    both = blocks.where(F.col("image_id").isin(a, b))
    last = extent(both)
    k1, k2 = 0.01, 0.03  # fixed values of the measure
    n = (2 * radius + 1) ** 2
    f, c1, c2 = n / (n - 1), (k1 * data_range) ** 2, (k2 * data_range) ** 2

    def work(br: int, bc: int, padded: dict):
        if (a,) not in padded or (b,) not in padded:
            return
        x, y = padded[(a,)], padded[(b,)]
        side, idx, there = len(x) - 2 * radius, [], []
        for first, end in ((br * side, last[0]), (bc * side, last[1])):
            at = np.arange(first - radius, first + side + radius)
            at = np.where(at < 0, -1 - at, np.where(at > end, 2 * end + 1 - at, at)) - (first - radius)
            there.append((at >= 0) & (at < len(x)))
            idx.append(np.clip(at, 0, len(x) - 1))
        seen = there[0][:, None] & there[1][None]
        x, y = (np.where(seen, g[np.ix_(*idx)], np.nan) for g in (x, y))
        own = ~np.isnan(x) & ~np.isnan(y)
        x, y = np.where(own, x, 0.0), np.where(own, y, 0.0)
        mx, my, xx, yy, xy = (_window_sum(p, 2 * radius + 1) / n for p in (x, y, x * x, y * y, x * y))
        vx, vy, vxy = f * (xx - mx * mx), f * (yy - my * my), f * (xy - mx * my)
        s = (2 * mx * my + c1) * (2 * vxy + c2) / ((mx * mx + my * my + c1) * (vx + vy + c2))
        r, c = np.arange(side) + br * side, np.arange(side) + bc * side
        shown = own[radius : radius + side, radius : radius + side] & (r <= last[0])[:, None] & (c <= last[1])[None]
        if shown.any():
            yield (), np.where(shown, s, np.nan)

    work.keeps_keys = False
    return with_halo(both, radius, work, by=[k for k in keys_of(blocks) if k != "image_id"])


def label_components(mask: DataFrame, columns: int, eight: bool = True) -> DataFrame:
    """Blocks of components of a mask (all pixels there are): connected pixels of an image share the smallest raster number r * columns + c among them.

    Blocks are labelled where they lie, without a shuffle. Their border pixels alone meet those of the neighbours; parts that have links get
    the smallest number of their component by a join of parts, not of pixels.
    """
    keys = keys_of(mask)
    steps = [(0, 1), (1, 0)] + [(1, 1), (1, -1)] * eight

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for g, br, bc in zip(_grids(batch.column("v")), batch.column("br").to_pylist(), batch.column("bc").to_pylist(), strict=True):
                y, x = np.nonzero(~np.isnan(g))
                number = np.full((len(g) + 2, len(g) + 2), -1, np.int64)
                number[y + 1, x + 1] = np.arange(len(y))
                ends = [(np.flatnonzero(there >= 0), there[there >= 0]) for there in (number[y + 1 + i, x + 1 + j] for i, j in steps)]
                root = least_reachable(len(y), np.concatenate([p for p, _ in ends]), np.concatenate([q for _, q in ends]))
                parts = np.full(g.shape, np.nan)
                parts[y, x] = ((y + br * len(g)) * columns + x + bc * len(g))[root]
                out.append(parts)
            yield pa.RecordBatch.from_arrays([*batch.select([*keys, *AT]).columns, _lists(out, pa.int64())], names=[*keys, *AT, "v"])

    parts = cut(mask.select(*keys, *AT, "v").mapInArrow(label, f"{_schema(mask, [*keys, *AT])}v array<long>"), "parts")
    side = F.sqrt(F.size("v")).cast("int")

    def border(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, g in enumerate(_grids(batch.column("v"))):
                ring = ~np.isnan(g)
                ring[1:-1, 1:-1] = False
                y, x = np.nonzero(ring)
                head = batch.select([*keys, *AT]).take(pa.array(np.full(len(y), k)))
                br, bc = batch.column("br")[k].as_py(), batch.column("bc")[k].as_py()
                yield pa.RecordBatch.from_arrays([*head.columns, pa.array(y + br * len(g)), pa.array(x + bc * len(g)), pa.array(g[y, x].astype(np.int64))], names=[*keys, *AT, "r", "c", "part"])

    edge = parts.mapInArrow(border, f"{_schema(parts, [*keys, *AT])}r long, c long, part long")
    to = edge.select(*keys, F.col("part").alias("a"), F.col("br").alias("ar"), F.col("bc").alias("ac"), F.explode(F.array(*(F.struct((F.col("r") + i).alias("r"), (F.col("c") + j).alias("c")) for i, j in steps))).alias("n"))
    across = to.select(*keys, "a", "ar", "ac", "n.r", "n.c").join(edge.select(*keys, "r", "c", *AT, F.col("part").alias("b")), [*keys, "r", "c"]).where("ar <> br or ac <> bc")
    node = lambda x: F.struct(*keys, F.col(x).alias("n"))
    found = connected_components(across.select(node("a").alias("a"), node("b").alias("b")))
    own = edge.select(*keys, *AT, "part").distinct().join(found.select(*(F.col(f"node.{k}") for k in keys), F.col("node.n").alias("part"), F.col("component.n").alias("one")), [*keys, "part"])
    named = own.groupBy(*keys, *AT).agg(F.map_from_entries(F.collect_list(F.struct("part", "one"))).alias("names"))  # at most 4 * side parts touch a block's border
    out = parts.join(named, [*keys, *AT], "left")
    return out.select(*keys, *AT, F.when(F.col("names").isNull(), F.col("v")).otherwise(F.transform("v", lambda x: F.coalesce(F.when(x.isNotNull(), F.element_at("names", x)), x))).alias("v"))


def label_sums(blocks: DataFrame, labels: DataFrame) -> DataFrame:
    """Per key of ``blocks`` and label (not 0) of ``labels``, which shares some keys: area, mean column and row, mean value.

    Blocks of one place are joined; each gives one row per label in it, so that a label costs a row per block that it reaches into, not one per pixel.
    """
    keys = keys_of(blocks)
    shared = [k for k in keys_of(labels) if k in keys]
    j = blocks.join(labels.select(*shared, *AT, F.col("v").alias("_label")), [*shared, *AT]).select(*keys, *AT, "v", "_label")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, (g, m) in enumerate(zip(_grids(batch.column("v")), _grids(batch.column("_label")), strict=True)):
                y, x = np.nonzero(~np.isnan(g) & ~np.isnan(m) & (m != 0))
                ids, at = np.unique(m[y, x].astype(np.int64), return_inverse=True)
                total = lambda w: pa.array(np.bincount(at, w, len(ids)).astype(float))
                head = batch.select(keys).take(pa.array(np.full(len(ids), k)))
                br, bc = batch.column("br")[k].as_py() * len(g), batch.column("bc")[k].as_py() * len(g)
                yield pa.RecordBatch.from_arrays([*head.columns, pa.array(ids), total(np.ones(len(y))), total(x + bc), total(y + br), total(g[y, x])], names=[*keys, "OID", "n", "x", "y", "s"])

    each = j.mapInArrow(sums, f"{_schema(blocks, keys)}OID long, n double, x double, y double, s double")
    n = F.sum("n")
    return each.groupBy(*keys, "OID").agg(n.cast("long").alias("area"), (F.sum("x") / n).alias("X"), (F.sum("y") / n).alias("Y"), (F.sum("s") / n).alias("mean_v"))


def scene_features(blocks: DataFrame, labels: DataFrame, images: DataFrame, markers: list[str]) -> DataFrame:
    """One row per label of each scene: slide_id, scan_region, scene_id, OID, area, X, Y and the mean of each marker.

    ``blocks`` has the keys slide_id, scan_region and image_id, ``labels`` slide_id and scan_region, ``images`` (slide_id, scan_region, image_id, marker_id) says what an
    image shows. Of several images of a marker in a scene that of the smallest id counts; a marker without one is null, and a label with no
    pixel in any named image has no row. All scenes are one plan: blocks are dealt by scene and place. scene_id is ``scene`` and the region's number plus one, in two digits.
    """
    scene = ["slide_id", "scan_region"]
    one = images.where(F.col("marker_id").isin(markers)).groupBy(*scene, "marker_id").agg(F.min("image_id").alias("image_id"))
    sums = label_sums(blocks.join(one.select(*scene, "image_id").distinct(), [*scene, "image_id"], "left_semi"), labels)
    named = sums.join(one, [*scene, "image_id"])
    means = [F.max(F.when(F.col("marker_id") == m, F.col("mean_v"))).alias(m) for m in markers]
    out = named.groupBy(*scene, "OID").agg(F.max("area").alias("area"), F.max("X").alias("X"), F.max("Y").alias("Y"), *means)
    number = F.lpad((F.regexp_replace("scan_region", "S", "").cast("int") + 1).cast("string"), 2, "0")
    return out.withColumn("scene_id", F.concat(F.lit("scene"), number))
