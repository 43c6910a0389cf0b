"""What the operators on embeddings share: validity, blocks and the pairs of blocks that tasks compare."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """True for vectors that are not null, not empty, not zero and hold finite numbers only."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of a list column, all of one length, in double precision."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(n, len(flat) // n if n else 0)


def second_moments(vectors: DataFrame) -> dict[int, np.ndarray]:
    """For each length of ``v`` the mean of the outer products of unit vectors: length squared numbers, whatever the rows."""

    def run(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            lengths = np.diff(batch.column(0).offsets.to_numpy()) if len(batch.column(0)) else np.empty(0, int)
            for d in np.unique(lengths):
                x = matrix(batch.column(0).filter(pa.array(lengths == d)))
                x /= np.abs(x).max(axis=1, keepdims=True)
                x /= np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]
                sums[int(d)] = sums.get(int(d), 0) + x.T @ x
        for d, s in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(d * d, d)), pa.array(np.arange(d * d)), pa.array(s.ravel())], names=["d", "i", "x"])

    out: dict[int, np.ndarray] = {}
    for r in vectors.select("v").mapInArrow(run, "d long, i long, x double").groupBy("d", "i").agg(F.sum("x").alias("x")).collect():
        out.setdefault(r["d"], np.zeros(r["d"] ** 2))[r["i"]] = r["x"]
    return {d: s.reshape(d, d) for d, s in out.items()}
