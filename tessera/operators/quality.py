"""Checks of acquisition tables; each gives rows that say what is wrong."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def naming_report(df: DataFrame, name: str, channels: tuple[str, ...], suffix: str = ".tif") -> DataFrame:
    """Rows (check, n_failed): suffix, five fields, round and version patterns, allowed channels; each file counts at its first failure."""
    stem = F.regexp_replace(F.col(name), r"\.[A-Za-z]+$", "")
    parts = F.split(stem, "_")
    get = lambda i: F.coalesce(F.get(parts, F.lit(i)), F.lit(""))
    rules: dict[str, Column] = {
        "suffix": F.col(name).endswith(suffix), "fields": F.size(parts) == 5, "round": get(1).rlike(r"^R\d{1,2}$"), "version": get(2).rlike(r"^V\d{1,2}$"), "channel": F.upper(get(4)).isin(*channels),
    }
    first = F.array(*(F.when(~rule, F.lit(check)) for check, rule in rules.items()))
    failed = df.select(F.get(F.array_compact(first), F.lit(0)).alias("f"))
    counts = failed.agg(*(F.count_if(F.col("f") == check).alias(check) for check in rules))
    return counts.unpivot([], list(rules), "check", "n_failed")


def set_differences(df: DataFrame, group: str, value: str) -> DataFrame:
    """Rows (group, value) that other groups have and this one lacks."""
    pairs = df.select(group, value).distinct()
    groups, values = pairs.select(group).distinct(), pairs.select(value).distinct()  # names, and few
    return groups.join(values).join(pairs, [group, value], "left_anti")


def required_fields(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    return df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns)).unpivot([], list(columns), "field", "n_null")


def manifest_summary(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"), *(F.countDistinct(c).alias(f"n_{c}") for c in columns))


def not_exactly_one(df: DataFrame, by: list[str]) -> DataFrame:
    """Groups with any number of rows but one."""
    return df.groupBy(*by).agg(F.count("*").alias("n")).where("n <> 1")


def coverage_gaps(df: DataFrame, group: str, member: str) -> DataFrame:
    """Groups with fewer members than the largest."""
    n = df.groupBy(group).agg(F.countDistinct(member).alias("n"))
    return n.join(F.broadcast(n.agg(F.max("n").alias("most")))).where("n < most")  # one row


def overshoot(boxes: DataFrame, rows: int, columns: int, tolerance: int = 25) -> DataFrame:
    """Boxes that reach beyond the image by more than the tolerance."""
    by = F.greatest(F.col("maxr") - rows, F.col("maxc") - columns, -F.col("minr"), -F.col("minc"))
    return boxes.withColumn("overshoot", by).where(F.col("overshoot") > tolerance)


def low_scores(df: DataFrame, score: str, least: float) -> DataFrame:
    return df.withColumn("flagged", F.coalesce(F.col(score) < least, F.lit(True)))


def channel_counts(df: DataFrame, by: list[str], name: str, index: str) -> DataFrame:
    """Groups with another number of channel names than of channel indexes."""
    n = df.groupBy(*by).agg(F.countDistinct(name).alias("n_names"), F.countDistinct(index).alias("n_indexes"))
    return n.where("n_names <> n_indexes")
