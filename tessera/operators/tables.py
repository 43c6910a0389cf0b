"""Set operations, schemas and cross tables of whole tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.cells import quoted


def distinct_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct rows of the columns (all by default); null equals null."""
    return df.select(*map(quoted, columns or df.columns)).distinct()


def union_strict(tables: Sequence[DataFrame]) -> DataFrame:
    """Tables of one schema, one after the other; an error names the first difference in columns, their order or their types."""
    first, *rest = tables
    for n, t in enumerate(rest, 2):
        if t.columns != first.columns:
            missing, further = [c for c in first.columns if c not in t.columns], [c for c in t.columns if c not in first.columns]
            raise ValueError(f"table {n} differs: without {missing}, with {further}" if missing or further else f"table {n} has its columns in another order")
        for (c, a), (_, b) in zip(first.dtypes, t.dtypes, strict=True):
            if a != b:
                raise ValueError(f"table {n} has {c} as {b}, not {a}")
    return reduce(DataFrame.union, rest, first)


def union_relaxed(tables: Sequence[DataFrame]) -> DataFrame:
    """Tables by column name: what one lacks is null there, and numbers take the wider type; text beside numbers is an error of Spark's."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def intersect_keys(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys that both tables have; null equals null."""
    return a.select(*map(quoted, keys)).intersect(b.select(*map(quoted, keys)))


def except_keys(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys of ``a`` that ``b`` has not; null equals null."""
    return a.select(*map(quoted, keys)).subtract(b.select(*map(quoted, keys)))


def methods_wide(clusters: DataFrame, methods: Sequence[str], ids: Sequence[str] = ("sample_id", "OID")) -> DataFrame:
    """One row per cell that all methods cluster, with a column for each; of several clusters of a method the largest name."""
    return clusters.groupBy(*ids).pivot("cl_method", list(methods)).agg(F.max("cluster")).na.drop("any", subset=list(methods))


def clusters_k(clusters: DataFrame) -> DataFrame:
    """How many clusters each method has."""
    return clusters.groupBy("cl_method").agg(F.countDistinct("cluster").alias("k"))


def with_group_size(df: DataFrame, keys: Sequence[str], k: str = "n") -> DataFrame:
    """Rows with the number of rows of their group, counted and joined back, so that a large group is not gathered; null keys are a group."""
    n = df.groupBy(*map(quoted, keys)).agg(F.count("*").alias("_k"))
    on = reduce(lambda x, y: x & y, (F.col(f"x.`{c}`").eqNullSafe(F.col(f"y.`{c}`")) for c in keys))
    return df.alias("x").join(n.alias("y"), on).select(*(F.col(f"x.`{c}`") for c in df.columns), F.col("_k").alias(k))


def full_grid(counts: DataFrame, rows: str, columns: str, value: str, most: int = 1_000_000) -> DataFrame:
    """Every row name with every column name, 0 where there is no count. A grid of more than ``most`` places is an error: it is meant for labels."""
    a, b = (counts.select(quoted(c)).distinct() for c in (rows, columns))
    size = counts.agg(F.countDistinct(rows).alias("r"), F.countDistinct(columns).alias("c")).first()
    if size["r"] * size["c"] > most:
        raise ValueError(f"a grid of {size['r']} x {size['c']} places")
    names = b.agg(F.collect_list(quoted(columns)).alias("_c"))  # at most ``most`` names
    grid = a.join(F.broadcast(names)).withColumn(columns, F.explode("_c")).drop("_c")  # one row
    return grid.join(counts.select(rows, columns, value), [rows, columns], "left").fillna(0, [value])
