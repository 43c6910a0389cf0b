"""Manifests from folders, and checks that have something to find."""

import pytest

from tessera.operators import manifest as M
from tessera.operators import quality as Q


def found(df):
    return sorted((r.check, r.detail) for r in df.collect())


def test_names_and_adapters(spark):
    f = spark.createDataFrame([("MVM001_R01_V3_P_U_S1M", "BM_x_S10M07_DAPI.tif", "10", None, "4,4,2040,2041", "6,52,6,52", "1,5", "2.5"), ("R02_P", "BM_S1M2_AF.TIFF", None, "9", "odd", "x", "", None)],
                              "folder string, tile_filename string, S string, M string, Frame string, ImagePixelSize string, StageXPosition string, StageYPosition string")
    a, b = M.build_manifest(mosaic=f).collect()
    assert (a.sample, a.slide, a["round"], a.version, a.scene, a.tile, a.channel) == ("BM", "MVM001", 1, "V03", "10", 7, "DAPI")
    assert (a.stage_x_um, a.stage_y_um, a.pixel_size_um, a.width_px, a.height_px, a.is_reference) == (1.5, 2.5, 6.0, 2040, 2041, False)
    assert (b.slide, b["round"], b.version, b.scene, b.tile, b.channel, b.width_px, b.stage_x_um) == ("", 2, "", "1", 9, "AF", None, None)
    t = f.select("folder", "tile_filename")
    assert M.build_manifest(mosaic=f.limit(1), files=t).count() == 2  # each folder once
    with pytest.raises(ValueError, match="no input"):
        M.build_manifest()
    with pytest.raises(ValueError, match="tile_filename"):
        M.from_column_map(t, {"stage_x": "x"})


COLUMNS = ", ".join(f"`{c}` {t}" for c, t in M.COLUMNS.items())


def rows(spark, *values):
    full = [("BM", s, r, v, sc, t, c, f"{i}.tif", f"/{i}.tif", 1.0, 1.0, 1.0, w, 10, ref) for i, (s, r, v, sc, t, c, w, ref) in enumerate(values)]
    return spark.createDataFrame(full, COLUMNS)


def test_manifest_checks(spark):
    m = rows(spark, ("A", 1, "V01", "1", 1, "DAPI", 10, False), ("A", 2, "V01", "1", 2, "CY5", None, False), ("B", 1, "V01", "1", 1, "DAPI", 10, False), ("A", 1, "V01", "2", 1, "DAPI", 10, False))
    assert found(M.qc_manifest(m, files=m.where("path <> '/2.tif'"))) == [
        ("channels", "A/1/CY5"), ("channels", "A/2/DAPI"), ("files", "1"), ("reference", "none"), ("required", "width_px: 1"), ("tile_set", "A/2")]
    assert found(M.qc_structure(m)) == [("no_register_channel", "A/1/2/V01"), ("round_count", "B/1"), ("round_gap", "A/2/2"), ("single_round", "A/2"), ("single_round", "B/1")]
    fine = rows(spark, ("A", 1, "V01", "1", 1, "DAPI", 10, True), ("A", 2, "V01", "1", 1, "DAPI", 10, False))
    assert found(M.qc_manifest(fine)) == [] and found(M.qc_structure(fine)) == []
    assert found(M.qc_manifest(m.where("false"))) == []


def test_vendor_folders(spark):
    folders = spark.createDataFrame([("a", True, True), ("b", False, True), ("c", True, False)], "folder string, has_xpd boolean, has_raw boolean")
    meta = spark.createDataFrame([("a", "R01", "CD3", "CY5"), ("b", "R01", "CD3", "FITC"), ("c", "R01", "CD4", "CY5"), ("c", "R02", "CD3", "CY5")], "folder string, round_number string, marker_id string, channel_id string")
    files = spark.createDataFrame([("a", "x_Cycle0.qptiff"), ("b", "x_Cycle0.qptiff"), ("c", "x_Cycle0.qptiff"), ("c", "x_Cycle1.intermediate.qptiff"), ("a", "x_Cycle3.txt")], "folder string, file string")
    assert found(M.qc_phenocycler(folders, meta, files)) == [("channel_names", "b"), ("matching_rounds", "c"), ("raw_folder", "c"), ("same_markers", "c"), ("same_rounds", "c"), ("xpd_file", "b")]
    files = spark.createDataFrame([("a", "j.xml"), ("a", "i.tiff"), ("b", "i.tiff"), ("b", "k.tiff"), ("c", "j.xml")], "folder string, file string")
    cycles = spark.createDataFrame([("a", 1, "Cycle_1"), ("a", 2, "Cycle_2"), ("b", 1, "Cycle_1"), ("b", 2, "cycle_2"), ("c", 1, "Cycle_1")], "folder string, cycle_number int, cycle_folder string")
    assert found(M.qc_comet(files, cycles)) == [("cycle_count", "c"), ("cycle_folder", "b"), ("image_file", "b"), ("image_file", "c"), ("job_file", "b")]


def test_placement_and_references(spark):
    images = spark.createDataFrame([("p", "A", "1", 1, "V01", 1, "DAPI", "a", "/a", True), ("p", "A", "1", 2, "V01", 1, "DAPI", "b", "/b", False), ("p", "A", "1", 2, "V01", 9, "CY5", "c", "/c", False)],
                                   "project string, slide string, scene string, round int, version string, tile int, channel string, filename string, path string, is_reference boolean")
    xy = spark.createDataFrame([("p", "1", 1, "A", 3.0, 4.0)], "project string, scene string, tile int, slide string, x double, y double")
    assert sorted((r.filename, r.x, r.ref_filename) for r in M.tile_placement(images, xy).collect()) == [("a", 3.0, "a"), ("b", 3.0, "a")]
    mixed = images.union(images.where("filename = 'b'").replace("V01", "V02"))
    with pytest.raises(ValueError, match="several versions"):
        M.tile_placement(mixed, xy)
    assert {r.ref_path for r in M.broadcast_reference(images).collect()} == {"/a"}
    with pytest.raises(ValueError, match="several reference"):
        M.broadcast_reference(images.withColumn("is_reference", images.is_reference | (images.filename == "b")))


def test_naming_counts_the_first_failure(spark):
    d = spark.createDataFrame([("a_R01_V1_x_DAPI.tif",), ("a_R1_V1_x_DAPI.png",), ("a_R01_V1_x_GFP.tif",), ("a_X_V1_x_GFP.tif",), ("a_R01.tif",)], "name string")
    assert {r.check: r.n_failed for r in Q.naming_report(d, "name", ("DAPI",)).collect()} == {"suffix": 1, "fields": 1, "round": 1, "version": 0, "channel": 1}
