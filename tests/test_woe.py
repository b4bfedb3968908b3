import math

import pytest
from pyspark.sql import functions as F

from riskframe.operators import binning, woe
from riskframe.operators.scale import PopulationScaler, PopulationScalerModel
from riskframe.operators.woe import WoeEncoder, WoeEncoderModel

X = [1, 1, 1, 1, 2, 3, 4, 5, 6, 7, 8, 9]
Y = [1, 0, 1, 0, 0, 0, 1, 0, 1, 1, 0, 0]


@pytest.fixture(scope="module")
def sample(spark):
    rows = [(i, float(x), y, "abc"[i % 3] if i % 5 else None) for i, (x, y) in enumerate(zip(X, Y))]
    return spark.createDataFrame(rows, "id int, x double, is_high_risk int, kind string")


def test_worked_example(sample):
    model = WoeEncoder(inputCols=["x"], bins=4).fit(sample)
    assert model.edges() == {"x": [1.0, 3.5, 6.25, 9.0]}
    rows = [tuple(r)[1:5] + (round(r.woe, 6),) for r in model.table().orderBy("bin").collect()]
    assert rows == [
        ("1", 6, 2, 4, 0.356675), ("2", 3, 2, 1, -1.029619), ("3", 3, 1, 2, 0.356675),
    ]


def test_outside_missing_and_unseen(spark, sample):
    model = WoeEncoder(inputCols=["x"], bins=4, fillValue=7.5).fit(sample)
    new = spark.createDataFrame([(0.5,), (1.0,), (9.0,), (9.5,), (None,), (float("nan"),)], "x double")
    found = [r.x for r in model.transform(new).collect()]
    assert found[0] == found[3] == found[4] == found[5] == 7.5
    assert round(found[1], 6) == round(found[2], 6) == 0.356675
    gaps = sample.withColumn("x", F.when(F.col("id") != 2, F.col("x")))
    with_missing = WoeEncoder(inputCols=["x"], bins=4, fillValue=7.5).fit(gaps)
    seen = with_missing.transform(new).collect()[4].x
    # one event, no non-event in the missing bin
    assert seen == pytest.approx(math.log((0.5 / 7) / (1 / 5)))


def test_other_columns_pass_through(sample):
    out = WoeEncoder(inputCols=["x"], bins=4).fit(sample).transform(sample)
    assert out.columns == sample.columns


def test_constant_column_has_only_the_missing_bin(spark, sample):
    flat = sample.withColumn("x", F.lit(3.0))
    model = WoeEncoder(inputCols=["x"]).fit(flat)
    assert [r.bin for r in model.table().collect()] == ["nan"]
    assert {r.x for r in model.transform(flat).collect()} == {0.0}


def test_one_class_is_refused(sample):
    with pytest.raises(ValueError, match="both classes"):
        WoeEncoder(inputCols=["x"]).fit(sample.filter("is_high_risk = 1"))


def test_uniform_edges(sample):
    edges = binning.uniform_edges(sample, ["x"], 4)["x"]
    assert edges == pytest.approx([1 - 0.008, 3, 5, 7, 9])
    model = WoeEncoder(inputCols=["x"], bins=4, strategy="uniform").fit(sample)
    assert sum(r.n for r in model.table().collect()) == len(X)


@pytest.mark.parametrize("broadcast", [100_000, 1])
def test_categories(spark, sample, tmp_path, monkeypatch, broadcast):
    monkeypatch.setattr(woe, "MAX_BROADCAST", broadcast)
    model = WoeEncoder(inputCols=["x"], categoryCols=["kind"], bins=4).fit(sample)
    model.write().overwrite().save(str(tmp_path / "woe"))
    again = WoeEncoderModel.load(str(tmp_path / "woe"))
    table = {r.bin: r.woe for r in again.table().filter("feature = 'kind'").collect()}
    assert set(table) == {"a", "b", "c", "nan"}
    new = sample.select("id", "kind").unionByName(
        spark.createDataFrame([(99, "other")], "id int, kind string")
    )
    plain = {r.id: r.kind for r in new.collect()}
    found = {r.id: r.kind for r in again.transform(new).collect()}
    assert found == {i: table.get(k or "nan", 0.0) for i, k in plain.items()}


def test_population_scaler(spark, tmp_path):
    df = spark.createDataFrame([(1.0, 3), (2.0, 3), (4.0, 3), (5.0, 3)], "x double, k int")
    model = PopulationScaler(inputCols=["x", "k"]).fit(df)
    model.write().overwrite().save(str(tmp_path / "scaler"))
    rows = PopulationScalerModel.load(str(tmp_path / "scaler")).transform(df).collect()
    assert rows[0].x == pytest.approx(-2 / 1.5811388300841898)
    assert {r.k for r in rows} == {0.0}


def test_frequent_unseen_category(spark, monkeypatch):
    """Half of the rows hold a category that the fit has not seen; one category is broadcast."""
    monkeypatch.setattr(woe, "MAX_BROADCAST", 1)
    rows = [("abc"[i % 3], i % 2) for i in range(60)]
    fitted = WoeEncoder(categoryCols=["c"], labelCol="y", fillValue=9.0).fit(
        spark.createDataFrame(rows, "c string, y int")
    )
    by_value = {r.bin: r.woe for r in fitted.table().collect()}
    df = spark.createDataFrame([("new" if i % 2 else "abc"[i % 3],) for i in range(200)], "c string")
    found = fitted.transform(df.withColumn("was", df.c)).collect()
    assert len(found) == 200 and all(r.c == by_value.get(r.was, 9.0) for r in found)


def test_the_encoding_is_compiled(spark):
    """The JVM runs methods of more than 8000 bytes uncompiled; nine columns of ten bins stay below."""
    columns = [f"c{j}" for j in range(9)]
    df = spark.range(1000).selectExpr("id", f"int(id % 3 = 0) as is_high_risk", *[f"double((id * {7 + 2 * j}) % 997) as {c}" for j, c in enumerate(columns)])
    encoded = WoeEncoder(inputCols=columns).fit(df).transform(df)
    parts = encoded._jdf.queryExecution().debug().codegenToSeq()
    assert parts.size() and max(parts.apply(i)._3().maxMethodCodeSize() for i in range(parts.size())) < 8000


def test_nan_is_in_no_bin(spark):
    """NaN and null get the value of missing numbers, infinities lie outside the edges or in the bin they bound."""
    edges = [0.0, 1.0, float("inf")]
    df = spark.createDataFrame([(0, 0.5), (1, 7.0), (2, float("nan")), (3, None), (4, -1.0), (5, float("inf"))], "id int, x double")
    found = df.selectExpr("id", f"{binning.choose_by_bin('x', edges, [1, 2], -1)} as b").orderBy("id").collect()
    assert [r.b for r in found] == [1, 2, -1, -1, -1, 2]
