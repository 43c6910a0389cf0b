"""Cell tables: ids, validation, filters, normalisation and sampling. Cells are keyed by (sample_id, OID)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY = ("sample_id", "OID")


def quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def blank(c: str) -> Column:
    return quoted(c).isNull() | (F.trim(quoted(c).cast("string")) == "")


def clean_ids(df: DataFrame, ids: Sequence[str] = KEY) -> DataFrame:
    return df.withColumns({c: F.trim(quoted(c).cast("string")) for c in ids})


def id_report(df: DataFrame, ids: Sequence[str] = KEY) -> DataFrame:
    """One row per id column: rows, and rows where it is null or blank."""
    if missing := [c for c in ids if c not in df.columns]:
        raise ValueError(f"missing id columns: {missing}")
    counts = df.agg(F.count("*").alias("n_rows"), *(F.count_if(blank(c)).alias(c) for c in ids))
    return counts.select("n_rows", F.explode(F.array(*(F.struct(F.lit(c).alias("id_column"), F.col(c).alias("n_blank")) for c in ids))).alias("x")).select(
        "x.id_column", "n_rows", "x.n_blank")


def validate_ids(df: DataFrame, ids: Sequence[str] = KEY) -> DataFrame:
    """The table itself; an error if an id is missing, null or blank."""
    bad = {r["id_column"]: r["n_blank"] for r in id_report(df, ids).collect() if r["n_blank"]}
    if bad:
        raise ValueError(f"null or blank ids: {bad}")
    return df


def resolve_markers(columns: Sequence[str], markers: Sequence[str], underscores: bool = False) -> dict[str, str]:
    """marker -> column, without regard to case, with - (and _ if asked) read as a dot; errors on ambiguity and if none is found."""
    def plain(x: str) -> str:
        x = x.strip().lower().replace("-", ".")
        return x.replace("_", ".") if underscores else x

    found = {}
    for m in markers:
        hits = [c for c in columns if plain(c) == plain(m)]
        if len(hits) > 1:
            raise ValueError(f"marker {m} is ambiguous: {hits}")
        if hits:
            found[m] = hits[0]
    if not found:
        raise ValueError("no marker has a column")
    return found


def cast_report(df: DataFrame, markers: Sequence[str]) -> DataFrame:
    """One row per marker: values that are there but are no number."""
    bad = [F.count_if(quoted(m).isNotNull() & quoted(m).cast("string").try_cast("double").isNull()).alias(m) for m in markers]
    return df.agg(*bad).unpivot([], [quoted(m) for m in markers], "marker", "n_bad")


def drop_null_rows(df: DataFrame) -> DataFrame:
    """Rows without any null; :func:`null_report` says what goes."""
    return df.na.drop("any")


def null_report(df: DataFrame) -> DataFrame:
    """One row: all rows, rows with a null, and null cells."""
    nulls = sum((quoted(c).isNull().cast("int") for c in df.columns), F.lit(0))
    return df.select(nulls.alias("k")).agg(F.count("*").alias("n_rows"), F.count_if(F.col("k") > 0).alias("n_dropped"), F.coalesce(F.sum("k"), F.lit(0)).alias("n_null_cells"))


def selected_celltypes(selection: DataFrame, label: str = "CellType") -> DataFrame:
    """Labels with include = 1, not blank, distinct and sorted; none is an error."""
    chosen = selection.where((F.col("include") == 1) & ~blank(label)).select(F.trim(quoted(label)).alias(label)).distinct()
    if chosen.isEmpty():
        raise ValueError("no type is included")
    return chosen.orderBy(label)


def filter_all_zero(df: DataFrame, markers: Sequence[str]) -> DataFrame:
    """Rows whose absolute marker values do not sum to zero."""
    return df.where(sum((F.abs(quoted(m)) for m in markers), F.lit(0.0)) != 0)


def column_order(df: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Ids, then numeric columns, then all others."""
    number = ("double", "float", "int", "bigint", "smallint", "tinyint")
    numeric = [c for c, t in df.dtypes if c not in ids and (t in number or t.startswith("decimal"))]
    return df.select(*(quoted(c) for c in [*ids, *numeric, *(c for c in df.columns if c not in ids and c not in numeric)]))


def filter_confidence(df: DataFrame, least: float, column: str = "prediction_confidence") -> DataFrame:
    return df.where(quoted(column).cast("string").try_cast("double") >= least)


def status_bucket(confidence: Column, high: float = 0.80, medium: float = 0.60) -> Column:
    return F.when(confidence >= high, "high_confidence").when(confidence >= medium, "medium_confidence").otherwise("low_confidence")


def filter_status(df: DataFrame, statuses: Sequence[str], column: str = "prediction_status") -> DataFrame:
    return df.where(F.col(column).isin(*statuses))


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of each key in a stated order."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def join_annotations(cells: DataFrame, annotations: DataFrame, label: str = "CellType") -> DataFrame:
    """Inner join on the key; of several annotations of a cell the smallest counts."""
    one = annotations.groupBy(*KEY).agg(F.min(label).alias(label))
    return cells.join(one, list(KEY))


def join_selected(df: DataFrame, selection: DataFrame, label: str = "CellType") -> DataFrame:
    """Rows whose label is included (include = 1, not blank) in the selection table."""
    chosen = selection.where((F.col("include") == 1) & ~blank(label)).select(label).distinct()
    return df.join(F.broadcast(chosen), label, "left_semi")  # names of cell types: dealt by them, cells would meet in a few tasks


def zscore(df: DataFrame, markers: Sequence[str], by: str | None = "sample_id", clip: float = 5.0) -> DataFrame:
    """(x - mean) / sample deviation per group, 0 where that is null or 0, clipped.

    Group statistics are aggregated and joined back, not computed over a window, so that a few huge groups keep all tasks busy.
    """
    stats = [f(quoted(m)).alias(f"_{k}_{i}") for i, m in enumerate(markers) for k, f in (("m", F.avg), ("s", F.stddev_samp))]
    s = df.groupBy(quoted(by).alias("_by")).agg(*stats) if by else df.agg(*stats)
    joined = df.join(s, quoted(by).eqNullSafe(F.col("_by")), "left") if by else df.join(F.broadcast(s))  # one row
    def z(i: int, m: str) -> Column:
        value = F.when(F.coalesce(F.col(f"_s_{i}"), F.lit(0.0)) == 0, F.lit(0.0)).otherwise((quoted(m) - F.col(f"_m_{i}")) / F.nullif(F.col(f"_s_{i}"), F.lit(0.0)))
        return F.greatest(F.lit(-clip), F.least(F.lit(clip), value))
    return joined.withColumns({m: z(i, m) for i, m in enumerate(markers)}).select(*(quoted(c) for c in df.columns))


def sample_quotas(df: DataFrame, n: int, by: str = "sample_id") -> DataFrame:
    """Rows (group, n_group, k): k = min(round half even(n / total * n_group), n_group); all if n covers the total."""
    counts = df.groupBy(by).agg(F.count("*").alias("n_group"))
    total = counts.agg(F.sum("n_group").alias("total"))
    k = F.when(F.col("total") <= n, F.col("n_group")).otherwise(F.least(F.bround(F.lit(float(n)) / F.col("total") * F.col("n_group")).cast("long"), F.col("n_group")))
    return counts.join(F.broadcast(total)).select(by, "n_group", k.alias("k"))  # one row


def first_by_hash(df: DataFrame, quotas: DataFrame, by: str, ids: Sequence[str] = KEY, seed: int = 1234, ranges: int = 4096) -> DataFrame:
    """The first k rows of each group in the order of a seeded hash of the ids, k from ``quotas`` (by, k); no repartitioning changes them.

    Rows are counted in ranges of the hash; whole ranges are taken or left, and only the one at the limit is sorted, so that a group with a third of all
    rows is never sorted in one task.
    """
    h = F.xxhash64(*(quoted(i) for i in ids), F.lit(seed))
    d = df.withColumn("_h", h).withColumn("_r", F.shiftrightunsigned("_h", 52).cast("int") if ranges == 4096 else F.pmod("_h", F.lit(ranges)).cast("int"))
    counts = d.groupBy(quoted(by).alias("_by"), "_r").agg(F.count("*").alias("_c"))
    before = F.coalesce(F.sum("_c").over(Window.partitionBy("_by").orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # ``ranges`` rows a group
    plan = counts.withColumn("_b", before).join(quotas.select(quoted(by).alias("_q"), "k"), F.col("_by").eqNullSafe(F.col("_q"))).where("_b < k")
    d = d.join(plan.select("_by", F.col("_r").alias("_r2"), "_c", "_b", "k"), quoted(by).eqNullSafe(F.col("_by")) & (F.col("_r") == F.col("_r2")))
    whole = F.col("_b") + F.col("_c") <= F.col("k")
    edge = d.where(~whole).withColumn("_n", F.row_number().over(Window.partitionBy("_by", "_r").orderBy("_h", *(quoted(i) for i in ids)))).where("_b + _n <= k").drop("_n")
    return d.where(whole).unionByName(edge).select(*(quoted(c) for c in df.columns))


def stratified_sample(df: DataFrame, n: int = 25_000, by: str = "sample_id", seed: int = 1234) -> DataFrame:
    """The rows of :func:`sample_quotas`, the first of each group in hash order."""
    return first_by_hash(df, sample_quotas(df, n, by).select(by, "k"), by, KEY, seed)


def balanced_sample(df: DataFrame, most: int = 500, by: str = "CellType", seed: int = 1234) -> DataFrame:
    """At most so many rows of each group, the first in hash order; none or fewer switches it off."""
    if most <= 0:
        return df
    return first_by_hash(df, df.select(by).distinct().withColumn("k", F.lit(most)), by, KEY, seed)


def unpivot_markers(df: DataFrame, ids: Sequence[str], markers: Sequence[str]) -> DataFrame:
    return df.unpivot([quoted(c) for c in ids], [quoted(m).cast("double").alias(m) for m in markers], "marker", "value")
