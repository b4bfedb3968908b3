import pytest
from pyspark.sql import functions as F

from riskframe.functions import scalars as S
from riskframe.operators import features as feat
from riskframe.operators import label
from riskframe.operators.stages import CustomerFeatures
from riskframe.operators.winsorize import IqrCapper, IqrCapperModel
from riskframe.schema import CUSTOMER_ID, FEATURES, LABEL, RFM, START_TIME


def by_customer(df):
    return {r[CUSTOMER_ID]: r for r in df.collect()}


def test_capping(seven, capped, tmp_path):
    assert [r.Amount for r in capped.orderBy("TransactionId").collect()] == [
        100, 50, 150, 200, -10, 343.75, 75,
    ]
    assert [r.PricingStrategy for r in capped.orderBy("TransactionId").collect()] == [
        1, 2, 1, 3, 2, 4, 1,
    ]
    model = IqrCapper().fit(seven)
    assert model.bounds()["Amount"] == (-106.25, 343.75)
    assert set(model.bounds()) == {"Amount", "Value", "PricingStrategy"}
    model.write().overwrite().save(str(tmp_path / "capper"))
    assert IqrCapperModel.load(str(tmp_path / "capper")).bounds() == model.bounds()


def test_features(capped):
    found = by_customer(feat.customer_features(capped))
    assert sorted(found) == ["C1", "C2", "C3", "C4"]
    assert len(found["C1"]) == 1 + len(FEATURES)
    c1 = found["C1"]
    assert c1.total_transaction_amount == 325
    assert c1.average_transaction_amount == pytest.approx(325 / 3)
    assert c1.std_transaction_amount == pytest.approx(38.188131, abs=1e-6)
    assert c1.transaction_count == 3
    assert c1.distinct_product_categories == 1
    assert tuple(c1)[-4:] == (0, 7, 1, 2023)
    assert found["C2"].std_transaction_amount == pytest.approx(42.426407, abs=1e-6)
    assert found["C3"].std_transaction_amount == 0
    assert found["C4"].total_transaction_amount == 343.75


def test_target_beside_features(capped):
    found = by_customer(feat.customer_features(capped, target_col="FraudResult"))
    assert {c: r.Target for c, r in found.items()} == {"C1": 1, "C2": 0, "C3": 0, "C4": 1}
    alone = by_customer(feat.customer_target_max(capped, "FraudResult"))
    assert {c: r.Target for c, r in alone.items()} == {"C1": 1, "C2": 0, "C3": 0, "C4": 1}


def test_single_transactions_have_no_deviation(seven):
    first = feat.first_per_customer(seven)
    assert {r.TransactionId for r in first.collect()} == {"T1", "T2", "T4", "T6"}
    assert {r.std_transaction_amount for r in feat.customer_features(first).collect()} == {0.0}


def test_bad_dates(seven):
    text = seven.withColumn(
        START_TIME,
        F.when(F.col("TransactionId") == "T3", "not-a-date")
        .when(F.col("TransactionId") == "T6", F.lit(None))
        .otherwise(F.col(START_TIME).cast("string")),
    )
    found = by_customer(feat.customer_features(text))
    assert sorted(found) == ["C1", "C2", "C3"]
    assert found["C1"].transaction_count == 2
    assert tuple(feat.undated_rows(text).first()) == (7, 2)
    with pytest.raises(Exception, match="not a timestamp"):
        feat.rfm(text).collect()


def test_absent_column_raises_at_once(seven):
    with pytest.raises(ValueError, match="TransactionStartTime"):
        feat.customer_features(seven.drop(START_TIME))


def test_rows_without_customer_are_left_out(seven):
    gaps = seven.withColumn(
        CUSTOMER_ID, F.when(F.col("TransactionId") != "T7", F.col(CUSTOMER_ID))
    )
    assert sorted(by_customer(feat.customer_features(gaps))) == ["C1", "C2", "C3", "C4"]
    # The latest time of all belongs to the row without a customer.
    assert by_customer(feat.rfm(gaps))["C4"].Recency == 2
    assert by_customer(feat.features_and_rfm(gaps))["C4"].Recency == 2


def test_rfm(capped):
    found = by_customer(feat.rfm(capped))
    assert {c: tuple(r)[1:] for c, r in found.items()} == {
        "C1": (1, 3, 325), "C2": (3, 2, 40), "C3": (4, 1, 200), "C4": (2, 1, 343.75),
    }
    scaled = by_customer(label.scaled_rfm(feat.rfm(capped)))
    assert [scaled["C1"][c] for c in label.SCALED] == pytest.approx(
        [-1.341641, 1.507557, 0.805837], abs=1e-6
    )
    assert [scaled["C2"][c] for c in label.SCALED] == pytest.approx(
        [0.447214, 0.301511, -1.542161], abs=1e-6
    )


def test_one_pass_equals_two(capped):
    both = by_customer(feat.features_and_rfm(capped))
    apart = by_customer(feat.customer_features(capped).join(feat.rfm(capped), CUSTOMER_ID))
    assert both == apart


def test_label_properties(capped):
    found = label.high_risk_target(capped).collect()
    assert len(found) == 4
    assert set(found[0].asDict()) == {CUSTOMER_ID, *RFM, "Cluster", LABEL}
    flags = [r[LABEL] for r in found]
    assert set(flags) == {0, 1}
    means = {}
    for r in found:
        means.setdefault(r.Cluster, []).append(r.Recency)
    means = {c: sum(v) / len(v) for c, v in means.items()}
    risky = {r.Cluster for r in found if r[LABEL] == 1}
    assert risky == {max(means, key=means.get)}


def test_nearest_centroid_ties_go_low(spark):
    points = spark.createDataFrame([(0.0, 0.0, 0.0)], list(label.SCALED))
    chosen = label.assign_cluster(points, {2: (1, 0, 0), 1: (-1, 0, 0)}).first()
    assert chosen.Cluster == 1


def test_stage_parameters(capped, tmp_path):
    stage = CustomerFeatures(keys=["request_id"])
    stage.write().overwrite().save(str(tmp_path / "stage"))
    again = CustomerFeatures.load(str(tmp_path / "stage"))
    assert by_customer(again.transform(capped)) == by_customer(feat.customer_features(capped))


def test_elapsed_days_and_times(spark):
    row = spark.sql(
        "select timestamp_ntz'2024-01-01 23:59:59' a, timestamp_ntz'2024-01-02 00:00:01' b, "
        "'2018-11-15T02:18:49Z' c, '11/15/2018' d, 1D x, cast('NaN' as double) y"
    ).select(
        S.elapsed_days("a", "b").alias("short"),
        S.elapsed_days("a", S.plus_one_day("b")).alias("long"),
        S.hour(S.lenient_timestamp("c")).alias("hour"),
        S.month(S.lenient_timestamp("d", ["MM/dd/yyyy"])).alias("month"),
        S.lenient_timestamp("d").alias("none"),
        S.clamp("y", 0, 1).alias("clamped"),
        S.nan_to_null("y").alias("null"),
        S.ratio("x", F.lit(0)).alias("ratio"),
    ).first()
    assert (row.short, row.long, row.hour, row.month, row.none) == (0, 1, 2, 11, None)
    assert row.null is None and row.ratio is None


def test_clamp_keeps_missing(spark):
    df = spark.createDataFrame([(None,), (-5.0,), (0.5,), (9.0,)], "x double")
    assert [r[0] for r in df.select(S.clamp("x", 0, 1)).collect()] == [None, 0.0, 0.5, 1.0]
