import json

import pytest

from tessera.sources import files


def test_decimal_comma_and_separators(spark, tmp_path):
    p = tmp_path / "a.csv"
    p.write_text("OID;x;s.area\nc1;1,5;2,25\nc2;-3,0;1\n")
    got = [tuple(r) for r in files.read_table(spark, str(p)).orderBy("OID").collect()]
    assert got == [("c1", 1.5, 2.25), ("c2", -3.0, 1.0)]
    assert files.sniff_separator(["a\tb"]) == "\t" and files.sniff_separator([]) == ";" and files.sniff_decimal(["h", "1.5,2.5"], ",") == "."


def test_unknown_suffix_and_round_trips(spark, tmp_path):
    with pytest.raises(ValueError):
        files.read_table(spark, "x.xlsx")
    df = spark.createDataFrame([("a b", "1", 2.5), ("c", "x", 3.5)], "sample_id string, OID string, m double")
    for name in ("t.parquet", "t.csv", "t.tsv"):
        files.write_table(df, str(tmp_path / name))
        assert sorted(map(tuple, files.read_table(spark, str(tmp_path / name)).collect())) == sorted(map(tuple, df.collect()))
    files.write_per_sample(df, str(tmp_path / "per"))
    assert {p.name for p in (tmp_path / "per").glob("part=*")} == {"part=a_b", "part=c"}
    assert files.read_folder(spark, [str(tmp_path / "t.csv"), str(tmp_path / "t.tsv")]).count() == 4


def test_acquisition_json(spark, tmp_path):
    wells = lambda *names: [{"wellName": n, "items": [{"markerName": "--", "channel": "DAPI"}, {"markerName": "CD3", "channel": "CY5"}]} for n in names]
    for folder, names in (("s1", "BAB"), ("s2", "A")):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "x.xpd").write_text(json.dumps({"resolution": 0.5, "wells": wells(*names)}))
    got = sorted((r.folder, r.well_name, r.round_number, r.marker_name, r.channel_id, r.channel_number, r.pixel_size) for r in files.read_acquisition_json(spark, f"{tmp_path}/*/x.xpd", {"CY5": 7}).collect())
    row = lambda f, w, r: [(f, w, r, "AF", "DAPI", 0, 0.5), (f, w, r, "CD3", "CY5", 7, 0.5)]
    assert got == sorted([*row("s1", "B", "R01"), *row("s1", "B", "R01"), *row("s1", "A", "R02"), *row("s2", "A", "R01")])
    assert files.list_files(spark, str(tmp_path), "*.xpd").count() == 2


def test_separators_and_decimal_signs():
    assert files.sniff_separator(["a;b", "1,5;2,5"]) == ";" and files.sniff_separator(["a,b;c", "1;2"]) in ",;" and files.sniff_separator(["word"]) == ";"
    assert files.sniff_separator(["x,y,z", "1,2,3"]) == "," and files.sniff_decimal(["h", "'1,5';-2,5;3.5"], ";") == "," and files.sniff_decimal(["h", "1;2"], ";") == "."


def test_job_files(spark, tmp_path):
    (tmp_path / "j.xml").write_text('''<Job><CycleModels TileFolderPath="d:\\Cycle_9\\s1\\Cycle_003\\"><ChannelMeta><Channel Name="C1"/><Plane ExposureTime="20"/><ChannelPriv FluorescenceChannel="CY5"/></ChannelMeta>
      <ChannelMeta><Channel Name="C2"/></ChannelMeta></CycleModels><CycleModels TileFolderPath="x/none"/></Job>''')
    got = sorted((r.cycle_number or -1, r.channel_name or "", r.exposure_time, r.fluorescence_channel) for r in files.read_job_files(spark, str(tmp_path)).collect())
    assert got == [(-1, "", None, None), (3, "C1", "20", "CY5"), (3, "C2", None, None)]
