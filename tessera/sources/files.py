"""Table files: reading and writing by suffix, dialects, and listing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SUFFIXES = (".parquet", ".csv", ".tsv", ".txt")
PEEK_LINES = 25


def _suffix(path: str) -> str:
    found = next((s for s in SUFFIXES if path.lower().rstrip("/").endswith(s)), None)
    if not found:
        raise ValueError(f"unknown kind of table: {path}")
    return found


def peek(spark: SparkSession, path: str) -> list[str]:
    return [r.value for r in spark.read.text(path).limit(PEEK_LINES).collect()]


def sniff_separator(lines: list[str]) -> str:
    """The sign among comma, semicolon and tab that stands on all of the first lines equally often (those within 4096 characters), the most frequent one
    of several; else the one that the first line has most of; a semicolon if it has none."""
    head, size = [], 0
    for x in lines:
        size += len(x) + 1
        if head and size > 4096:
            break
        head.append(x)
    if not head:
        return ";"
    steady = [s for s in ",;\t" if head[0].count(s) and len({x.count(s) for x in head if x}) == 1]
    best = max(steady or ",;\t", key=head[0].count)
    return best if head[0].count(best) else ";"


def sniff_decimal(lines: list[str], separator: str) -> str:
    """Comma or point, by what more of the numbers on the lines after the first use."""
    import re

    fields = [f.strip().strip("\"'") for x in lines[1:] for f in x.split(separator)]
    commas, points = (sum(bool(re.fullmatch(rf"-?\d*{s}\d+|-?\d+{s}", f)) for f in fields) for s in (",", r"\."))
    return "," if commas > points else "."


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A table by its suffix; text files by their own separator and decimal sign, numbers as doubles where all values are numbers."""
    if _suffix(path) == ".parquet":
        return spark.read.parquet(path)
    lines = peek(spark, path)
    separator = sniff_separator(lines)
    df = spark.read.option("header", True).option("sep", separator).csv(path)
    number = lambda c: (F.regexp_replace(c, ",", ".") if sniff_decimal(lines, separator) == "," else c).try_cast("double")
    wrong = df.agg(*(F.count_if(F.col(f"`{c}`").isNotNull() & number(F.col(f"`{c}`")).isNull()).alias(c) for c in df.columns)).first()
    return df.withColumns({c: number(F.col(f"`{c}`")) for c in df.columns if not wrong[c]})


def read_folder(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Files of one schema, one after the other in the order of their names."""
    first, *rest = (read_table(spark, p) for p in sorted(paths))
    for df in rest:
        first = first.unionByName(df)
    return first


def write_table(df: DataFrame, path: str) -> None:
    suffix = _suffix(path)
    if suffix == ".parquet":
        df.write.parquet(path)
    else:
        df.write.option("header", True).option("sep", "\t" if suffix == ".tsv" else ";").csv(path)


def write_per_sample(df: DataFrame, path: str, by: str = "sample_id") -> None:
    """One folder per sample in one pass; names keep letters, digits, dots, dashes and underscores."""
    safe = F.regexp_replace(F.trim(F.col(by).cast("string")), "[^A-Za-z0-9._-]", "_")
    df.withColumn("part", safe).write.partitionBy("part").option("header", True).csv(path)


def list_files(spark: SparkSession, path: str, pattern: str = "*.tif*") -> DataFrame:
    """Rows (path, length) of files below a folder; contents are not read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path)
    return found.select("path", "length")


def read_acquisition_json(spark: SparkSession, path: str, channel_numbers: dict[str, int] | None = None, pattern: str = "*") -> DataFrame:
    """One row per (well, item) of acquisition files: folder, well_name, marker_name, channel_id, channel_number, round_number, pixel_size.

    ``path`` names files or a folder, whose files of names like ``pattern`` are read at any depth: executors list its folders, where a
    pattern over them makes the driver do so one by one. The fields are known, so each file is opened once. The round is the place of the well's name among its folder's names, in the order in
    which they first stand in the file. ``--`` means AF. A channel that ``channel_numbers`` does not name keeps its item's place.
    """
    from pyspark.sql import Window

    schema = "resolution string, wells array<struct<wellName:string,items:array<struct<markerName:string,channel:string>>>>"
    read = spark.read.schema(schema).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    listing = "spark.sql.sources.parallelPartitionDiscovery.parallelism"  # else a task for each folder
    before = spark.conf.get(listing)
    spark.conf.set(listing, 4 * spark.sparkContext.defaultParallelism)
    try:
        d = read.json(path)
    finally:
        spark.conf.set(listing, before)
    d = d.select(F.regexp_extract(F.input_file_name(), r"([^/]+)/[^/]+$", 1).alias("folder"), "resolution", F.posexplode("wells").alias("w", "well"))
    first = F.min("w").over(Window.partitionBy("folder", "well_name"))  # a folder has some dozens of wells
    d = d.select("folder", "resolution", "w", F.col("well.wellName").alias("well_name"), F.col("well.items").alias("items")).withColumn("first", first)
    d = d.withColumn("n", F.dense_rank().over(Window.partitionBy("folder").orderBy("first"))).select("*", F.posexplode("items").alias("k", "item"))
    number = F.col("k")
    if channel_numbers:
        number = F.coalesce(F.create_map(*(F.lit(v) for kv in channel_numbers.items() for v in kv))[F.col("item.channel").cast("string")], F.col("k"))
    n = F.col("n").cast("string")
    return d.select(
        "folder", "well_name", F.when(F.col("item.markerName") == "--", "AF").otherwise(F.col("item.markerName")).alias("marker_name"), F.col("item.channel").cast("string").alias("channel_id"),
        number.cast("int").alias("channel_number"), F.concat(F.lit("R"), F.when(F.length(n) < 2, F.lpad(n, 2, "0")).otherwise(n)).alias("round_number"), F.col("resolution").cast("double").alias("pixel_size"))


def read_job_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per cycle and channel of XML job files: tile_folder, cycle_number, channel_name, exposure_time, fluorescence_channel.

    The cycle's number is what follows the last ``Cycle_`` of its tile folder. Missing elements give nulls.
    """
    schema = (
        "_TileFolderPath string, ChannelMeta array<struct<Channel:struct<_Name:string>,Plane:struct<_ExposureTime:string>,ChannelPriv:struct<_FluorescenceChannel:string>>>")
    d = spark.read.format("xml").option("rowTag", "CycleModels").schema(schema).load(path)
    cycle = F.regexp_extract("_TileFolderPath", r"Cycle_(\d+)[/\\\\]*$", 1).try_cast("int")
    d = d.select(F.col("_TileFolderPath").alias("tile_folder"), cycle.alias("cycle_number"), F.explode_outer("ChannelMeta").alias("m"))
    return d.select(
        "tile_folder", "cycle_number", F.col("m.Channel._Name").alias("channel_name"), F.col("m.Plane._ExposureTime").alias("exposure_time"),
        F.col("m.ChannelPriv._FluorescenceChannel").alias("fluorescence_channel"))
