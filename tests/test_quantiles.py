import numpy as np
import pytest

from candlespark.operators.quantiles import exact_percentiles

PROBS = {"p05": 0.05, "p50": 0.5, "p95": 0.95, "lowest": 0.0, "highest": 1.0}


@pytest.mark.parametrize("accuracy", [3, 100, 10_000])
def test_exact_for_any_shape_and_any_sketch(spark, accuracy):
    """A coarse sketch makes longer stretches, never other results."""
    rng = np.random.default_rng(1)
    groups = {
        "normal": rng.normal(size=3000),
        "heavy": np.concatenate([np.full(2000, 7.0), rng.pareto(1.0, 1000) * 1e6]),
        "ties": rng.integers(0, 3, 500).astype(float),
        "constant": np.full(50, 2.5),
        "one": np.array([4.0]),
        "two": np.array([1.0, 2.0]),
        None: rng.normal(size=101),
    }
    data = [(k, float(v)) for k, values in groups.items() for v in values] + [("normal", None), ("empty", None)]
    df = spark.createDataFrame(data, "k string, v double").repartition(4)
    got = {r.k: r for r in exact_percentiles(df, ["k"], "v", PROBS, accuracy).collect()}
    assert set(got) == set(groups)
    for k, values in groups.items():
        for name, p in PROBS.items():
            assert got[k][name] == pytest.approx(np.quantile(values, p), rel=1e-12), (k, name)
