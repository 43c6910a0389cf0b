"""From acquisition folders to one manifest of images, and the checks of both.

The manifest has fifteen columns, one row per image file; see :data:`COLUMNS`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.tiles import version_name

#: The manifest's columns with their types, those that must be there, and those that place a tile.
COLUMNS = {
    "sample": "string", "slide": "string", "round": "int", "version": "string", "scene": "string", "tile": "int", "channel": "string", "filename": "string", "path": "string",
    "stage_x_um": "double", "stage_y_um": "double", "pixel_size_um": "double", "width_px": "int", "height_px": "int", "is_reference": "boolean",
}
REQUIRED = ("sample", "round", "scene", "tile", "channel", "path", "width_px", "height_px")
STAGE = ("stage_x_um", "stage_y_um", "pixel_size_um")
PHENOCYCLER_CHANNELS = ("DAPI", "ATTO550", "CY5", "AF750")


def number(x: Column) -> Column:
    """A decimal number with point or comma; null for anything else."""
    return F.regexp_replace(F.trim(x.cast("string")), ",", ".").try_cast("double")


def _names(folder: Column, file: Column) -> dict[str, Column]:
    """What folder and file names say: <slide>_R<round>_V<version>_... and <sample>_..._S<scene>M<tile>_..._<channel>.tif."""
    found = lambda x, pattern: F.nullif(F.regexp_extract(x, pattern, 1), F.lit(""))
    round_of = lambda x: found(x, r"(?:^|_)R(\d+)(?:_|$|[A-Za-z])")
    version = found(folder, r"(?:^|_)V(\d+)(?:_|$|[A-Za-z])")
    place = r"S(\d+)M(\d+)"
    return {
        "sample": F.split(file, "_")[0], "slide": F.regexp_extract(folder, r"^(.*?)_*(?:^|_)R\d+(?:_|$|[A-Za-z])", 1),
        "round": F.coalesce(round_of(folder), round_of(file)).cast("int"), "version": F.coalesce(version_name(version), F.lit("")),
        "scene": found(file, place), "tile": F.nullif(F.regexp_extract(file, place, 2), F.lit("")).cast("int"),
        "channel": F.element_at(F.split(F.regexp_replace(file, r"(?i)\.tiff?$", ""), "_"), -1),
        "filename": file, "path": F.concat_ws("/", folder, file),
    }


def _manifest(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    values = {**values, "is_reference": F.lit(False)}
    return df.select(*(values.get(c, F.lit(None)).cast(t).alias(c) for c, t in COLUMNS.items()))


def from_mosaic_metadata(df: DataFrame) -> DataFrame:
    """Rows of (folder, tile_filename, S, M, Frame "x,y,w,h", ImagePixelSize "px,py", StageXPosition, StageYPosition)."""
    names, frame = _names(F.col("folder"), F.col("tile_filename")), F.split("Frame", ",")
    return _manifest(df, {
        **names, "scene": F.coalesce(F.col("S").cast("string"), names["scene"]), "tile": F.coalesce(F.col("M").cast("string").try_cast("int"), names["tile"]),
        "stage_x_um": number(F.col("StageXPosition")), "stage_y_um": number(F.col("StageYPosition")), "pixel_size_um": F.split("ImagePixelSize", ",")[0].try_cast("double"),
        "width_px": F.get(frame, F.lit(2)).try_cast("int"), "height_px": F.get(frame, F.lit(3)).try_cast("int")})


def from_column_map(df: DataFrame, column_map: dict[str, str]) -> DataFrame:
    """Rows of any table with stage positions; ``column_map`` names its columns for tile_filename, stage_x, stage_y, pixel_size, width and height."""
    if "tile_filename" not in column_map:
        raise ValueError("the column map names no tile_filename")
    get = lambda k, f: f(F.col(f"`{column_map[k]}`")) if k in column_map else F.lit(None)
    whole = lambda x: x.cast("string").try_cast("int")
    return _manifest(df, {
        **_names(F.col("folder"), F.col(f"`{column_map['tile_filename']}`")), "stage_x_um": get("stage_x", number), "stage_y_um": get("stage_y", number),
        "pixel_size_um": get("pixel_size", number), "width_px": get("width", whole), "height_px": get("height", whole)})


def from_file_names(files: DataFrame) -> DataFrame:
    """Rows of (folder, tile_filename) alone: no positions and no sizes."""
    return _manifest(files, _names(F.col("folder"), F.col("tile_filename")))


def build_manifest(mosaic: DataFrame | None = None, table: DataFrame | None = None, column_map: dict[str, str] | None = None, files: DataFrame | None = None, resolved: DataFrame | None = None) -> DataFrame:
    """The manifest of all folders: each folder's rows come from the first input that knows it (mosaic metadata, then a mapped table, then file names).

    ``resolved`` (slide, scene, round, version) marks the reference images. No input at all is an error. Sorted by round, scene, tile and channel.
    """
    given = [(t, f) for t, f in ((mosaic, from_mosaic_metadata), (table if column_map else None, lambda d: from_column_map(d, column_map)), (files, from_file_names)) if t is not None]
    if not given:
        raise ValueError("no input to build a manifest from")
    out, known = None, None
    for t, adapt in given:
        own = t.join(known, "folder", "left_anti") if known is not None else t
        rows, folders = adapt(own), t.select("folder").distinct()
        out = rows if out is None else out.unionByName(rows)
        known = folders if known is None else known.union(folders)
    if resolved is not None:
        r = resolved.select("slide", "scene", "round", "version").withColumn("_is", F.lit(True))
        out = out.drop("is_reference").join(r, ["slide", "scene", "round", "version"], "left").withColumn("is_reference", F.coalesce("_is", F.lit(False))).select(*COLUMNS)
    return out.orderBy("round", "scene", "tile", "channel")


def channel_table(channels: DataFrame) -> DataFrame:
    """Rows of (basename, channel) as (slide, round, version, project, user, channel); names of combined background channels are folded."""
    p = F.split("basename", "_")
    channel = F.upper(F.trim("channel"))
    folded = F.when(channel.isin("AF_FITC", "FITC_AF", "AFFITC", "FITCAF"), "AF").otherwise(channel)
    return channels.select(*(F.get(p, F.lit(i)).alias(c) for i, c in enumerate(("slide", "round", "version", "project", "user"))), folded.alias("channel")).distinct()


def tile_placement(images: DataFrame, coordinates: DataFrame) -> DataFrame:
    """Each image with its tile's coordinates (by project, scene, tile, slide) and the reference image of its tile and channel.

    A slide, scene and round with several versions is an error. The coordinates have x and y.
    """
    mixed = images.groupBy("slide", "scene", "round").agg(F.countDistinct("version").alias("n")).where("n > 1").limit(20).collect()
    if mixed:
        raise ValueError(f"several versions in one round: {[(r['slide'], r['scene'], r['round']) for r in mixed]}")
    at = ["project", "scene", "tile", "slide"]
    ref = images.where("is_reference").groupBy(*at, "channel").agg(F.min("filename").alias("ref_filename"))
    return images.join(coordinates.select(*at, "x", "y"), at).join(ref, [*at, "channel"], "left")


def join_design(tiles: DataFrame, design: DataFrame) -> DataFrame:
    """Left join of the experimental design (marker_id, ...) by slide, round and channel; the design is small, and Spark sees its size."""
    return tiles.join(design, ["slide", "round", "channel"], "left")


def broadcast_reference(files: DataFrame, by: str = "slide") -> DataFrame:
    """Every file of a slide with the path of its reference file; a slide with several reference files is an error."""
    ref = files.where("is_reference").groupBy(by).agg(F.min("path").alias("ref_path"), F.count("*").alias("n"))
    if several := [r[by] for r in ref.where("n > 1").limit(20).collect()]:
        raise ValueError(f"several reference files: {several}")
    return files.join(ref.drop("n"), by, "left")


# checks -----------------------------------------------------------------------------------------------------------

def _rows(df: DataFrame, check: str, level: str, detail: Column) -> DataFrame:
    return df.select(F.lit(check).alias("check"), F.lit(level).alias("level"), detail.cast("string").alias("detail"))


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def differing_sets(df: DataFrame, by: Sequence[str], group: str, value: Column) -> DataFrame:
    """Rows (by.., group, first) of groups whose set of values is another than that of the first group of their ``by``.

    Sets are compared by their sizes and by the values that both hold, so that none is gathered in one place.
    """
    keys = list(by)
    pairs = df.select(*keys, F.col(group), value.alias("_v")).distinct()
    first = pairs.groupBy(*keys).agg(F.min(group).alias("first")) if keys else pairs.agg(F.min(group).alias("first"))
    joined = pairs.join(first, keys) if keys else pairs.join(F.broadcast(first))  # one row
    size = pairs.groupBy(*keys, group).agg(F.count("*").alias("_n"))
    own = joined.where(F.col(group) == F.col("first")).select(*keys, "_v", F.lit(True).alias("_in"))
    both = joined.join(own, [*keys, "_v"], "left").groupBy(*keys, group, "first").agg(F.count("_in").alias("_both"), F.count("*").alias("_n"))
    of_first = size.select(*keys, F.col(group).alias("first"), F.col("_n").alias("_m"))
    return both.join(of_first, [*keys, "first"]).where("_both <> _n or _n <> _m").select(*keys, group, "first")


def qc_manifest(manifest: DataFrame, require_stage: bool = True, files: DataFrame | None = None) -> DataFrame:
    """Rows (check, level, detail): nulls of required columns, files that are not there, missing stage positions, no reference; and, as warnings,
    rounds of a slide with other (scene, tile) sets than its first and channels that a round lacks. ``files`` lists (path) of what exists.
    """
    nulls = manifest.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in REQUIRED)).unpivot([], list(REQUIRED), "c", "n").where("n > 0")
    parts = [_rows(nulls, "required", "error", F.concat_ws(": ", "c", F.col("n").cast("string")))]
    if files is not None:
        lost = manifest.join(files.select("path").distinct(), "path", "left_anti").agg(F.count("*").alias("n")).where("n > 0")
        parts.append(_rows(lost, "files", "error", F.col("n")))
    no_stage = manifest.agg(F.count_if(F.greatest(*(F.col(c).isNull() for c in STAGE))).alias("n"), F.count_if("is_reference").alias("r"), F.count("*").alias("all"))
    parts.append(_rows(no_stage.where("n > 0"), "stage", "error" if require_stage else "warning", F.col("n")))
    parts.append(_rows(no_stage.where("`all` > 0 and r = 0"), "reference", "error", F.lit("none")))
    tiles = differing_sets(manifest, ["slide"], "round", F.struct("scene", "tile"))
    parts.append(_rows(tiles, "tile_set", "warning", F.concat_ws("/", "slide", F.col("round").cast("string"))))
    pairs = manifest.select("slide", "round", "channel").distinct()
    expected = pairs.select("slide", "round").distinct().join(pairs.select("slide", "channel").distinct(), "slide")
    lacking = expected.join(pairs, ["slide", "round", "channel"], "left_anti")
    parts.append(_rows(lacking, "channels", "warning", F.concat_ws("/", "slide", F.col("round").cast("string"), "channel")))
    return _union(parts)


def qc_structure(manifest: DataFrame, register_channel: str = "DAPI") -> DataFrame:
    """Rows (check, level, detail), all warnings: rounds that a scene lacks and others of its slide have; slides with another number of rounds
    than the largest; (slide, scene, round, version) without the registration channel; (slide, scene) with one round and version only.
    """
    text = lambda *c: F.concat_ws("/", *(F.col(x).cast("string") for x in c))
    have = manifest.select("slide", "scene", "round").distinct()
    gaps = have.select("slide", "scene").distinct().join(have.select("slide", "round").distinct(), "slide").join(have, ["slide", "scene", "round"], "left_anti")
    counts = manifest.groupBy("slide").agg(F.countDistinct("round").alias("n"))
    fewer = counts.join(F.broadcast(counts.agg(F.max("n").alias("most")))).where("n < most")  # one row
    groups = manifest.groupBy("slide", "scene", "round", "version").agg(F.max((F.col("channel") == register_channel).cast("int")).alias("has"))
    single = manifest.groupBy("slide", "scene").agg(F.countDistinct("round", "version").alias("n")).where("n <= 1")
    return _union([
        _rows(gaps, "round_gap", "warning", text("slide", "scene", "round")), _rows(fewer, "round_count", "warning", text("slide", "n")),
        _rows(groups.where("has = 0"), "no_register_channel", "warning", text("slide", "scene", "round", "version")), _rows(single, "single_round", "warning", text("slide", "scene"))])


def qc_phenocycler(folders: DataFrame, metadata: DataFrame, files: DataFrame, channels: Sequence[str] = PHENOCYCLER_CHANNELS) -> DataFrame:
    """Rows (check, level, detail) of what is wrong with acquisition folders (folder, has_xpd, has_raw), their metadata (folder, round_number, marker_id, channel_id)
    and their image files (folder, file): no acquisition file, channels of other names, no raw folder, rounds of one side only, other rounds or markers than the first folder.

    A file of cycle n belongs to round n + 1; intermediate files do not count.
    """
    row = lambda df, check: _rows(df.select("folder").distinct(), check, "error", F.col("folder"))
    cycle = F.regexp_extract("file", r"Cycle(\d+)", 1).try_cast("int")
    there = files.where(F.col("file").rlike(r"\.qptiff") & ~F.col("file").rlike(r"\.intermediate\.qptiff$"))
    there = there.select("folder", F.concat(F.lit("R"), F.lpad((cycle + 1).cast("string"), 2, "0")).alias("round_number")).distinct()
    said = metadata.select("folder", "round_number").distinct()
    one_side = said.join(there, ["folder", "round_number"], "left_anti").union(there.join(said, ["folder", "round_number"], "left_anti"))
    return _union([
        row(folders.where("not has_xpd"), "xpd_file"), row(metadata.where(~F.col("channel_id").isin(*channels)), "channel_names"), row(folders.where("not has_raw"), "raw_folder"),
        row(one_side, "matching_rounds"), row(differing_sets(metadata, [], "folder", F.col("round_number")), "same_rounds"),
        row(differing_sets(metadata, [], "folder", F.col("marker_id")), "same_markers")])


def qc_comet(files: DataFrame, cycles: DataFrame) -> DataFrame:
    """Rows (check, level, detail) of slide folders (folder, file) without a job file or with any number of images but one, with another number of
    cycles (folder, cycle_number, cycle_folder) than most, and with cycle folders of another name than Cycle_<n>.
    """
    row = lambda df, check: _rows(df.select("folder").distinct(), check, "error", F.col("folder"))
    n = files.groupBy("folder").agg(F.count_if(F.col("file").endswith(".xml")).alias("xml"), F.count_if(F.col("file").endswith(".tiff")).alias("tiff"))
    k = cycles.groupBy("folder").agg(F.countDistinct("cycle_number").alias("k"))
    usual = k.groupBy("k").agg(F.count("*").alias("m")).agg(F.min_by("k", F.struct(-F.col("m"), "k")).alias("usual"))
    return _union([
        row(n.where("xml = 0"), "job_file"), row(n.where("tiff <> 1"), "image_file"), row(k.join(F.broadcast(usual)).where("k <> usual"), "cycle_count"),  # one row
        row(cycles.where(~F.col("cycle_folder").rlike(r"^Cycle_\d+$")), "cycle_folder")])
