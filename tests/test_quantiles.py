"""Exact quantiles by digits against numpy."""

import numpy as np
import pytest

from tessera.operators.pixels import exact_quantiles

QS = (0.0, 0.01, 0.25, 0.5, 0.99, 1.0)
rng = np.random.default_rng(7)
GROUPS = {
    "ties": np.concatenate([np.full(600, 3.0), rng.normal(0, 1, 400), [1e9]]),
    "zeros": np.concatenate([np.zeros(900), rng.random(101)]),
    "close": 1.0 + np.arange(1000) * 2.0**-52,
    "sizes": np.concatenate([10.0 ** rng.uniform(-300, 300, 500), -(10.0 ** rng.uniform(-300, 300, 480)), [np.inf, -np.inf, 5e-324, -0.0]]),
    "one": np.array([4.25]),
    "two": np.array([-1.0, 8.0]),
    "ints": rng.integers(0, 65536, 1500).astype(float),
}


@pytest.mark.parametrize("partitions", [1, 5])
def test_against_numpy(spark, partitions):
    rows = [(g, float(x)) for g, xs in GROUPS.items() for x in xs] + [("ties", None), ("only null", None), ("one", float("nan"))]
    df = spark.createDataFrame(rows, "g string, x double").repartition(partitions)
    got = {r.g: r for r in exact_quantiles(df, "g", "x", QS).collect()}
    assert set(got) == set(GROUPS)
    for g, xs in GROUPS.items():
        with np.errstate(all="ignore"):
            want = np.quantile(xs, QS)
        finite = np.isfinite(want)
        assert got[g].n == len(xs) and np.allclose(np.array(got[g].q)[finite], want[finite], rtol=1e-12, atol=0)
        assert got[g].q[0] == xs.min() and got[g].q[-1] == xs.max()


def test_no_values_are_gathered(spark):
    df = spark.createDataFrame([("a", float(k % 7)) for k in range(500)], "g string, x double")
    plan = exact_quantiles(df, "g", "x", (0.5,))._jdf.queryExecution().executedPlan().toString()
    assert "percentile" not in plan and "collect_list(x" not in plan


def test_empty(spark):
    assert exact_quantiles(spark.createDataFrame([], "g string, x double"), "g", "x", (0.5,)).count() == 0
