import numpy as np
import pytest

from riskframe.operators.quantiles import _cells, approximate_quantiles, exact_quantiles, quantile_table

PROBABILITIES = [0.0, 0.1, 0.25, 0.3, 0.5, 0.7, 0.9, 1.0]


def columns(rng, n):
    tied = rng.integers(0, 5, n).astype(float)
    hot = np.where(rng.random(n) < 0.4, 7.0, rng.normal(0, 1e6, n))
    heavy_tail = np.exp(rng.normal(0, 12, n)) * rng.choice([-1, 1], n)
    return {"tied": tied, "hot": hot, "tail": heavy_tail, "plain": rng.random(n), "const": np.ones(n)}


@pytest.mark.parametrize("n,accuracy,max_ranked", [
    (1, 10_000, 500_000),
    (2, 10_000, 500_000),
    (1001, 10_000, 500_000),  # ranked whole
    (5001, 100, 200),         # bracketed once
    (5001, 20, 25),           # narrowed again and again
])
def test_against_numpy(spark, n, accuracy, max_ranked):
    data = columns(np.random.default_rng(n), n)
    rows = [tuple(float(v[i]) for v in data.values()) for i in range(n)] + [(None,) * len(data)] * 3
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in data)).repartition(5)
    found = exact_quantiles(df, list(data), PROBABILITIES, accuracy, max_ranked)
    for c, values in data.items():
        expected = np.quantile(values, PROBABILITIES)
        assert np.allclose(found[c], expected, rtol=1e-12, atol=1e-12), c


def test_whole_positions_are_data_values(spark):
    df = spark.createDataFrame([(float(i) / 3,) for i in range(1491)], "x double")
    found = exact_quantiles(df, ["x"], [i / 10 for i in range(11)])["x"]
    assert found == [i * 149 / 3 for i in range(11)]


def test_empty_and_missing(spark):
    df = spark.createDataFrame([(None, 1)], "x double, k int")
    assert exact_quantiles(df, ["x", "k"], [0.5]) == {"x": [None], "k": [1.0]}
    assert quantile_table(df, ["k"], [0.5]).first().quantile == 1.0


def test_approximate_is_close(spark):
    df = spark.range(10_001)
    assert approximate_quantiles(df, ["id"], [0.5])["id"][0] == pytest.approx(5000, abs=2)


@pytest.mark.parametrize("max_ranked", [500_000, 40])
def test_nan_is_missing(spark, max_ranked):
    """On either side of the limit of one task, NaN is skipped as null is."""
    rows = [(float("nan") if i % 3 == 0 else None if i % 3 == 1 else float(i * 7 % 1000),) for i in range(3000)]
    df = spark.createDataFrame(rows, "x double")
    kept = sorted(r[0] for r in rows if r[0] is not None and r[0] == r[0])
    found = exact_quantiles(df, ["x"], [0, 0.5, 1], accuracy=100, max_ranked=max_ranked)["x"]
    half = (len(kept) - 1) / 2
    middle = (kept[int(half)] + kept[int(half + 0.5)]) / 2
    assert found == pytest.approx([kept[0], middle, kept[-1]])


def test_rows_by_cuts(spark):
    """Every bracket is counted by one pass that keeps no sketches; nulls count nowhere."""
    inf = float("inf")
    values = [None, -inf, -3.0, -0.0, 0.0, 0.5, 1.0, 1.0, 2.0, inf, inf]
    df = spark.createDataFrame([(v, None) for v in values], "`x` double, `a b` double").repartition(3)
    found = _cells(df, {"x": [0.0, 1.0, inf], "a b": [5.0]})
    assert found["x"].tolist() == [2, 2, 1, 2, 1, 2, 0] and found["a b"].tolist() == [0, 0, 0]


@pytest.mark.parametrize("low,finite,high", [(400, 1001, 600), (1500, 1, 500), (0, 1, 2000), (2000, 1, 0)])
def test_infinite_values_are_ranked(spark, low, finite, high):
    values = [float("-inf")] * low + [i * 37 % 1009 / 8 for i in range(finite)] + [float("inf")] * high
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(4)
    found = exact_quantiles(df, ["x"], [0, 0.1, 0.25, 0.5, 0.7, 0.9, 1], accuracy=50, max_ranked=40)["x"]
    ranked = sorted(values)
    assert found == [ranked[len(values) // 20 * k] for k in (0, 2, 5, 10, 14, 18)] + [ranked[-1]]
