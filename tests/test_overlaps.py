"""Overlaps of tiles, and the pixel operators that have edge cases of their own."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import learning as L
from tessera.operators import overlaps as O
from tessera.operators import pixels as P
from tessera.operators import tiles as T

BOXES = "scene string, tile string, x0 double, x1 double, y0 double, y1 double"


def test_groups_of_three_and_four(spark):
    t = spark.createDataFrame([("s", "a", 0.0, 10.0, 0.0, 10.0), ("s", "b", 8.0, 18.0, 0.0, 10.0), ("s", "c", 0.0, 10.0, 8.0, 18.0), ("s", "d", 8.0, 18.0, 8.0, 18.0), ("u", "a", 0.0, 10.0, 0.0, 10.0), ("s", "e", 50.0, 60.0, 0.0, 1.0)], BOXES)
    got = {(r.scene, "".join(r.members)): (r.x0, r.x1, r.y0, r.y1) for r in O.overlap_groups(t).collect()}
    assert sorted(k for _, k in got) == ["ab", "abc", "abcd", "abd", "ac", "acd", "ad", "bc", "bcd", "bd", "cd"]
    assert got["s", "abcd"] == (8.0, 10.0, 8.0, 10.0) and got["s", "ab"] == (8.0, 10.0, 0.0, 10.0)
    scores = spark.createDataFrame([(["a", "b"], "a", None), (["a", "b"], "b", 0.0), (["a", "c"], "c", 0.4)], "members array<string>, tile string, score double")
    win = {("".join(r.members), r["rank"]): r.tile for r in O.overlap_winners(O.overlap_groups(t).where("size = 2"), scores).collect()}
    assert win["ab", 1] == "a" and win["ac", 1] == "c" and win["ac", 2] == "a"


def test_large_tiles_overlap(spark):
    t = spark.createDataFrame([("s", 1, 0.0, 0.0, 9000.0, 9000.0), ("s", 2, 8000.0, 100.0, 9000.0, 9000.0), ("s", 3, 30_000.0, 0.0, 10.0, 10.0)], "slide string, tile int, stage_x double, stage_y double, width_px double, height_px double")
    assert [(r.a, r.b, r.x0, r.x1) for r in T.tile_overlaps(t).collect()] == [(1, 2, 8000.0, 9000.0)]


def test_consensus_of_offsets(spark):
    rows = [(1, "imreg_dft", 0.0, 0.0, 1.0), (1, "cv2", 3.0, 0.0, 0.0), (1, "aa", 90.0, 0.0, 0.0), (2, "imreg_dft", 0.0, 0.0, 11.0), (2, "cv2", 1.0, 1.0, 0.0), (3, "aa", 5.0, 5.0, 0.0), (3, "thunder_no_angle", 5.0, 6.0, 0.0), (3, "chi2_no_angle", 6.0, 5.0, 0.0)]
    d = spark.createDataFrame(rows, "pair long, method string, dx double, dy double, angle double")
    got = {r.pair: (r.method, r.votes) for r in O.transform_consensus(d).collect()}
    assert got == {1: ("imreg_dft", 3), 2: (None, 1), 3: ("aa", 3)}


def test_offset_filter_names_and_boxes(spark):
    d = spark.createDataFrame([("right", 20.0, 1.0), ("right", 40.0, 1.0), ("left", -20.0, 0.0), ("left", 20.0, 0.0), ("down", 30.0, 5.0), ("up", -20.0, 1.0)], "direction string, along double, across double")
    assert [(r.direction, r.along) for r in O.pair_offset_filter(d, 0.1, 200.0, 200.0).collect()] == [("right", 20.0), ("left", -20.0), ("up", -20.0)]
    text = spark.createDataFrame([("  A–B　 ﬁ​x ",), (None,)], "t string")
    assert [r[0] for r in text.select(O.normalise_text(F.col("t"))).collect()] == ["A-B fi x", None]
    b = spark.createDataFrame([("S0", 1, 2, 30, 40)], "scan_region string, minr int, minc int, maxr int, maxc int")
    r = O.scene_offsets(O.rescale_boxes(b, 4.0, 2.0, (20, 20), (100, 200), (40, 70))).first()
    assert (r.offset_row, r.offset_col, r.global_maxr, r.global_maxc) == (4, 8, 100, 160)


def test_exact_quantiles_against_numpy(spark):
    rng = np.random.default_rng(3)
    groups = {"many": rng.lognormal(0, 3, 5000), "one": [7.0], "same": [2.0] * 50, "two": [1.0, 4.0], "ties": rng.integers(0, 4, 999).astype(float)}
    d = spark.createDataFrame([(g, float(x)) for g, v in groups.items() for x in v] + [("none", None)], "g string, v double")
    for partitions in (1, 7):
        got = {r.g: r.q for r in P.exact_quantiles(d.repartition(partitions), "g", "v", (0.0, 0.01, 0.5, 0.99, 1.0)).collect()}
        assert set(got) == set(groups)
        for g, v in groups.items():
            assert np.allclose(got[g], np.quantile(np.array(v), (0.0, 0.01, 0.5, 0.99, 1.0)), rtol=1e-12)


def brute_components(mask):
    label = {p: p for p in mask}
    changed = True
    while changed:
        changed = False
        for r, c in sorted(mask):
            least = min(label[q] for q in ((r + i, c + j) for i in (-1, 0, 1) for j in (-1, 0, 1)) if q in label)
            if least < label[r, c]:
                label[r, c], changed = least, True
    return {p: r * 30 + c for p, (r, c) in label.items()}


@pytest.mark.parametrize("share,tile", [(0.2, 256), (0.6, 256), (0.2, 7), (0.42, 4)])
def test_components_against_brute_force(spark, share, tile):
    rng = np.random.default_rng(4)
    mask = {(r, c) for r in range(25) for c in range(30) if rng.random() < share}
    d = spark.createDataFrame([(r, c) for r, c in mask], "r int, c int")
    parts = P.label_components(d, 30, tile=tile)
    want = brute_components(mask)
    assert {(x.r, x.c): x.component for x in parts.collect()} == want
    sizes = {k: list(want.values()).count(k) for k in set(want.values())}
    big = min(sizes, key=lambda k: (-sizes[k], k))
    assert {x.component for x in P.largest_component(parts).collect()} == {big} and P.largest_component(parts).count() == sizes[big]
    assert {x.component for x in P.drop_small_components(parts, 4).collect()} == {k for k, n in sizes.items() if n >= 4}


def test_components_of_several_images_and_holes(spark):
    ring = [(r, c) for r in range(5) for c in range(5) if not (1 <= r <= 3 and 1 <= c <= 3)]
    d = spark.createDataFrame([("a", r, c) for r, c in ring] + [("b", 0, 0), ("b", 2, 2)], "image_id string, r int, c int")
    parts = P.label_components(d, 30, tile=3)
    assert sorted({(x.image_id, x.component) for x in parts.collect()}) == [("a", 0), ("b", 0), ("b", 62)]
    assert {x.image_id for x in P.drop_small_components(parts, 2).collect()} == {"a"}
    assert P.significant_components(parts, 10, 10, 0.05).count() == 16 and P.significant_components(parts, 10, 10, 0.0, 0.4).count() == 18
    whole = P.fill_holes(P.largest_component(parts.where("image_id = 'a'").drop("image_id")), 30, 30)
    assert whole.count() == 25
    open_ = spark.createDataFrame([(r, c) for r, c in ring if (r, c) != (0, 2)], "r int, c int")
    assert P.fill_holes(open_, 30, 30).count() == 15


def test_boxes_go_on_over_bands_and_images(spark):
    d = spark.createDataFrame([(i, r, c, o) for i, r, c, o in [("a", 0, 5, 9), ("a", 0, 2, 4), ("a", 7, 0, 2), ("a", 8, 0, 2), ("b", 3, 3, 1)]], "image_id string, r int, c int, OID int")
    got = sorted((r.image_id, r.OID, r.scan_region, r.maxr) for r in P.boxes(d, 4).collect())
    assert got == [("a", 2, "S2", 9), ("a", 4, "S0", 1), ("a", 9, "S1", 1), ("b", 1, "S0", 4)]


def test_labels_of_windows(spark):
    d = spark.createDataFrame([(0, 0, 0, 1), (0, 0, 1, 2), (1, 0, 1, 1), (1, 0, 2, 1), (1, 0, 5, 2), (2, 0, 9, 3), (2, 0, 0, 0)], "window int, r int, c int, OID int")
    assert sorted((r.r, r.c, r.OID) for r in P.offset_labels(d).collect()) == [(0, 0, 1), (0, 1, 2), (0, 5, 4), (0, 9, 7)]


def test_versions_fill_holes_by_a_fit(spark):
    ref = [(r, c, 0.0 if 10 <= r < 20 and 10 <= c < 20 else float(100 + r + c)) for r in range(30) for c in range(30)]
    alt = [("x", r, c, (100 + r + c - 40) / 2.0) for r in range(30) for c in range(30)]
    got = {(x.r, x.c): x.v for x in P.match_versions(spark.createDataFrame(ref, "r int, c int, v double"), spark.createDataFrame(alt, "image_id string, r int, c int, v double"), 4, least=100).collect()}
    assert got[0, 0] == 100.0 and abs(got[14, 14] - 128) < 1e-6 and abs(got[10, 14] - 124 / 4) < 1e-6 and len(got) == 900


def test_threshold_switches_to_the_mixture_and_masks_are_zero(spark):
    rng = np.random.default_rng(6)
    s = np.concatenate((rng.normal(20, 3, 700), rng.normal(300, 3, 300))).clip(1)
    px = spark.createDataFrame([(n, i // 50, i % 50, float(v)) for i, x in enumerate(s) for n, v in (("MS", x), ("AF", 30.0))], "image_id string, r int, c int, v double")
    a = P.angles(px)
    simple = a.agg(F.avg("phi") + 2 * F.stddev_pop("phi")).first()[0]
    assert simple > 1.57 and 0.8 < P.angle_threshold(a).first()[0] < 1.47
    out = {(r.r, r.c): r.v for r in P.subtract_background(px).collect()}
    assert min(v for k, v in out.items() if s[k[0] * 50 + k[1]] > 200) > 200 and max(v for k, v in out.items() if s[k[0] * 50 + k[1]] < 60) <= 1
    mask = px.where("r < 10").select("r", "c")
    same = px.where("image_id = 'MS' and c < 5").select("r", "c", F.lit(0.95).alias("v"))
    cut = {(r.r, r.c): r.v for r in P.subtract_background(px, mask=mask, similarity=same).collect()}
    assert all(cut[k] == (0 if k[0] >= 10 or k[1] < 5 else v) for k, v in out.items())


def test_communities_of_cliques(spark):
    cliques = [range(0, 6), range(6, 12), range(12, 20)]
    edges = [(str(i), str(j), 1.0) for g in cliques for i in g for j in g if i < j] + [("0", "6", 0.5), ("6", "12", 0.5)]
    got = {r.node: r.community for r in L.communities(spark.createDataFrame(edges, "a string, b string, weight double")).collect()}
    assert len(got) == 20 and [len({got[str(i)] for i in g}) for g in cliques] == [1, 1, 1] and len(set(got.values())) == 3
    assert L.communities(spark.createDataFrame([], "a string, b string, weight double")).count() == 0


def test_map_finds_far_groups(spark):
    rng = np.random.default_rng(7)
    rows = [(str(i), *(rng.normal((i % 3) * 20, 1, 2).tolist())) for i in range(300)]
    d = spark.createDataFrame(rows + [("null", None, 1.0)], "OID string, m double, n double")
    got = {r.OID: r.cluster for r in L.som(d, ("m", "n"), ("OID",), 3, side=4, epochs=6).collect()}
    assert len(got) == 300 and [len({got[str(i)] for i in range(k, 300, 3)}) for k in range(3)] == [1, 1, 1] and len(set(got.values())) == 3


def test_nearest_medoid_by_warping(spark):
    h = spark.createDataFrame([("i", b, v) for b, v in enumerate([0.0, 0.0, 9.0, 0.0])] + [("j", b, v) for b, v in enumerate([5.0, 5.0, 5.0, 5.0])], "image_id string, bin int, share double")
    m = spark.createDataFrame([("peak", b, v) for b, v in enumerate([0.0, 9.0, 0.0, 0.0])] + [("flat", b, 5.0) for b in range(4)], "class string, bin int, value double")
    assert {r.image_id: (r["class"], r.distance) for r in P.nearest_medoid(h, m).collect()} == {"i": ("peak", 0.0), "j": ("flat", 0.0)}


def test_warping_together_equals_cell_by_cell(spark):
    rng = np.random.default_rng(5)

    def plain(a, b):
        cost = [0.0] + [np.inf] * len(b)
        for x in a:
            new = [np.inf] * (len(b) + 1)
            for j, y in enumerate(b, 1):
                new[j] = abs(x - y) + min(cost[j], new[j - 1], cost[j - 1])
            cost = new
        return cost[-1]

    known = {"c": rng.random(9), "a": rng.random(12), "b": rng.random(1), "far": 50 + rng.random(7)}
    images = {f"i{k}": rng.random(int(rng.choice([1, 5, 9, 20]))) for k in range(40)} | {"same": known["c"].copy()}
    for n in (1, 5, 9, 20):
        a = np.array([x for x in images.values() if len(x) == n]).reshape(-1, n)
        for v in known.values():
            want = np.array([plain(x, v) for x in a])
            assert np.array_equal(P.warp_all(a, v), want) and (P.least_warp(a, v) <= want + 1e-12).all()
    h = spark.createDataFrame([(i, b, float(x)) for i, v in images.items() for b, x in enumerate(v)], "image_id string, bin int, share double")
    m = spark.createDataFrame([(c, b, float(x)) for c, v in known.items() for b, x in enumerate(v)], "class string, bin int, value double")
    got = {r.image_id: (r["class"], r.distance) for r in P.nearest_medoid(h, m).collect()}
    assert got == {i: min(((plain(x, v), c) for c, v in known.items()))[::-1] for i, x in images.items()}
    assert P.nearest_medoid(h, m.limit(0)).count() == 0 and P.nearest_medoid(h.limit(0), m).count() == 0


def test_rectangles_of_very_different_sizes(spark):
    import random

    from tessera.operators.rectangles import meeting

    rng = random.Random(4)
    rows = [("s", k, x, x + w, y, y + h) for k in range(300) for x, y in [(rng.randrange(-300, 300), rng.randrange(-300, 300))] for w, h in [rng.choice([(0, 0), (3, 2), (16, 16), (17, 5), (100, 1), (1000, 1000)] if k % 20 == 0 else [(0, 0), (3, 2), (4, 4)])]]
    rows += [("t", 1, 0, 4, 0, 4), ("t", 2, 4, 8, 4, 8), ("t", 3, 9, 9, 9, 9), ("t", 4, 5, 2, 5, 2), ("t", None, 0, 9, 0, 9), (None, 6, 0, 9, 0, 9), ("t", 7, None, 9, 0, 9)]
    rows = [(s, k, *(None if x is None else float(x) for x in box)) for s, k, *box in rows]
    t = spark.createDataFrame(rows, "slide string, id long, x0 double, x1 double, y0 double, y1 double")
    got = [tuple(r) for r in meeting(t, t, ["slide"]).collect()]
    good = [r for r in rows if r[0] and None not in r[2:] and r[2] <= r[3] and r[4] <= r[5]]
    want = [(a[0], a[1], b[1], max(a[2], b[2]), min(a[3], b[3]), max(a[4], b[4]), min(a[5], b[5])) for a in good for b in good
            if a[0] == b[0] and max(a[2], b[2]) <= min(a[3], b[3]) and max(a[4], b[4]) <= min(a[5], b[5])]
    assert sorted(got, key=repr) == sorted(((s, a, b, *map(float, box)) for s, a, b, *box in want), key=repr)


def test_one_large_tile_does_not_bring_all_others_together(spark):
    small = [("s", k, 10.0 * (k % 40), 10.0 * (k % 40) + 9, 10.0 * (k // 40), 10.0 * (k // 40) + 9) for k in range(1600)]
    t = spark.createDataFrame([*small, ("s", 9999, 0.0, 9000.0, 0.0, 9000.0)], "slide string, tile long, x0 double, x1 double, y0 double, y1 double")
    pairs = O.pair_boxes(t, t, ("slide",))
    assert pairs.count() == 1600 + 1 + 2 * 1600
    graph = pairs._jdf.queryExecution().executedPlan()
    assert "CartesianProduct" not in graph.toString() and "BroadcastNestedLoopJoin" not in graph.toString()


def test_overlap_groups_run_to_their_end_or_refuse(spark):
    chain = [("s", k, 10.0 * k, 10.0 * k + 15, 0.0, 10.0) for k in range(15)]  # each meets the next one
    t = spark.createDataFrame(chain, "scene string, tile long, x0 double, x1 double, y0 double, y1 double")
    got = {tuple(r.members) for r in O.overlap_groups(t).collect()}
    assert got == {(k, k + 1) for k in range(14)}
    six = spark.createDataFrame([("s", k, 0.0 + k, 20.0 + k, 0.0, 9.0) for k in range(6)], "scene string, tile long, x0 double, x1 double, y0 double, y1 double")
    assert O.overlap_groups(six).count() == 2**6 - 6 - 1
    with pytest.raises(ValueError):
        O.overlap_groups(six, most_members=5)


def test_background_is_subtracted_in_one_grouping_by_pixel(spark, monkeypatch):
    monkeypatch.setattr(P, "TOGETHER", 500)
    px = spark.createDataFrame([(n, i // 50, i % 50, v) for i in range(1000) for n, v in (("MS", 20.0 + i % 7), ("AF", 30.0))], "image_id string, r int, c int, v double")
    assert P.dealt(px, px.count()).rdd.getNumPartitions() == 4
    mask = spark.createDataFrame([(r, c) for r in range(10) for c in range(50)] + [(None, 1)], "r long, c long")
    same = spark.createDataFrame([(3, 4, 0.95), (3, 4, 0.2), (3, 5, None), (15, 0, 0.1)], "r int, c int, v double")
    plain = P.subtract_background(px)
    out = P.subtract_background(px, mask=mask, similarity=same)
    assert dict(out.dtypes) == {"r": "int", "c": "int", "v": "bigint"}
    assert "hashpartitioning(r#" not in (plan := out._jdf.queryExecution().executedPlan().toString()) and "HashJoin" not in plan
    want = {(r.r, r.c): r.v if r.r < 10 and (r.r, r.c) != (3, 4) else 0 for r in plain.collect()}
    got = [tuple(r) for r in out.collect()]
    assert len(got) == 1000 and {(r, c): v for r, c, v in got} == want
