import numpy as np
import pytest

from riskframe.operators import distribution, profile
from riskframe.plans.explore import cap_and_write, profile_tables


@pytest.fixture(scope="module")
def numbers(spark):
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.normal(50, 10, 400), np.full(200, 55.0), [250.0]])
    df = spark.createDataFrame(
        [(float(v), 7) for v in values] + [(None, 7)], "x double, same int"
    )
    return values, df


def test_histogram_matches_numpy(numbers):
    values, df = numbers
    found = sorted(distribution.histogram(df).filter("feature = 'x'").collect(), key=lambda r: r.bin)
    counts, edges = np.histogram(values, 30)
    assert [r.n for r in found] == list(counts)
    assert np.allclose([r.bin_start for r in found], edges[:-1])
    flat = distribution.histogram(df).filter("feature = 'same' and n > 0").collect()
    assert [(r.bin, r.n) for r in flat] == [(15, 602)]


def test_kde_matches_the_full_sum(numbers):
    values, df = numbers
    found = sorted(distribution.kde(df).collect(), key=lambda r: r.point)
    assert {r.feature for r in found} == {"x"}
    grid = np.linspace(values.min(), values.max(), 200)
    h = len(values) ** -0.2 * values.std(ddof=1)
    kernel = np.exp(-0.5 * ((grid[:, None] - values[None, :]) / h) ** 2)
    density = kernel.sum(axis=1) / (len(values) * h * np.sqrt(2 * np.pi))
    assert np.allclose([r.x for r in found], grid)
    assert np.allclose([r.density for r in found], density, rtol=1e-9, atol=1e-15)


def test_correlation(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0, 1), (2.0, 4.1, 1), (3.0, 5.9, 1), (None, 9.0, 1)], "a double, b double, c int"
    )
    cells = {(r.x, r.y): r.correlation for r in profile.correlation_matrix(df).collect()}
    assert len(cells) == 9
    assert cells["a", "b"] == cells["b", "a"] == pytest.approx(np.corrcoef([1, 2, 3], [2, 4.1, 5.9])[0, 1])
    assert cells["a", "c"] is None and cells["c", "c"] is None
    assert [(r.x, r.y) for r in profile.redundant_pairs(df).collect()] == [("a", "b")]


def test_missing_and_constant(spark):
    df = spark.createDataFrame([(1, None, "k"), (2, None, "k"), (3, 5, "k"), (None, 5, "k")], "a int, b int, c string")
    report = [tuple(r) for r in profile.missing_report(df).collect()]
    assert report == [("b", 2, 50.0), ("a", 1, 25.0)]
    assert profile.missing_report(df.select("c")).count() == 0
    patterns = {r.pattern: r.n for r in profile.missing_pattern(df).collect()}
    assert patterns == {"010": 2, "000": 1, "100": 1}
    assert [tuple(r) for r in profile.constant_columns(df).collect()] == [("b", "5"), ("c", "k")]


def test_top_category_ties_take_the_least(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",), (None,)], "k string")
    row = profile.describe_categorical(df).first()
    assert tuple(row) == ("k", 5, 3, "a", 2)
    counted = [(r.value, r.n) for r in profile.value_counts(df).collect()]
    assert counted == [("a", 2), ("b", 2), ("c", 1)]


def test_boxplot(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 5, 100]], "x double")
    row = profile.boxplot_stats(df).first()
    assert (row.q1, row.median, row.q3) == (2.25, 3.5, 4.75)
    assert (row.whisker_low, row.whisker_high, row.outliers) == (1.0, 5.0, 1)


def test_everything_on_the_small_table(seven, tmp_path, spark):
    tables = profile_tables(seven)
    assert tables["shape"].first().n_rows == 7
    for name, table in tables.items():
        assert table.columns, name
        table.collect()
    cap_and_write(seven, str(tmp_path / "capped"))
    from riskframe.sources.files import read_transactions_csv

    back = read_transactions_csv(spark, str(tmp_path / "capped"))
    assert back.count() == 7 and max(r.Amount for r in back.collect()) == 343.75
