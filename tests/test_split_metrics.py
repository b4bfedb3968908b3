import hashlib
import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from riskframe.operators import metrics, split


@pytest.fixture(scope="module")
def people(spark):
    rows = [(f"k{i}", 1 if i % 7 == 0 else 0) for i in range(701)] + [("none", None)]
    return spark.createDataFrame(rows, "CustomerId string, is_high_risk int")


def ordered(df, label, seed=42):
    keys = [r.CustomerId for r in df.filter(F.col("is_high_risk") == label).collect()]
    return sorted(keys, key=lambda k: hashlib.md5(f"{k}|{seed}".encode()).hexdigest())


def test_split_is_the_first_share_by_hash(people):
    done = split.stratified_split(people).collect()
    assert len(done) == 701
    for label in (0, 1):
        by_hash = ordered(people, label)
        expected = set(by_hash[: math.ceil(0.2 * len(by_hash))])
        assert {r.CustomerId for r in done if r.is_high_risk == label and r.is_test} == expected


def by_fractions(sizes, drawn):
    """Largest remainder, one row at a time."""
    total = sum(sizes)
    quotas = [Fraction(drawn * n, total) for n in sizes]
    take = [int(q) for q in quotas]
    while sum(take) < drawn:
        lacking = [q - t if t <= q else -1 for q, t in zip(quotas, take)]
        take[lacking.index(max(lacking))] += 1
    return take


def test_shares_of_the_whole():
    rng = random.Random(4)
    for _ in range(50):
        sizes = {c: rng.randint(1, 400) for c in range(rng.randint(1, 9))}
        share = rng.choice([0.1, 0.2, 0.25, 0.33])
        found = split.test_sizes(sizes, share, "whole")
        drawn = math.ceil(round(share * sum(sizes.values()), 9))
        assert sum(found.values()) == drawn
        assert list(found.values()) == by_fractions(list(sizes.values()), drawn)
    assert split.test_sizes({0: 600, 1: 101}, 0.2, "whole") == {0: 121, 1: 20}
    assert split.test_sizes({"a": 1, "b": 1, "c": 1}, 0.5, "whole") == {"a": 1, "b": 1, "c": 0}  # ties: first come
    assert split.test_sizes({}, 0.2, "whole") == {}
    with pytest.raises(ValueError, match="shares"):
        split.test_sizes({0: 1}, 0.2, "row")


def test_split_of_the_whole(people):
    done = split.stratified_split(people, shares="whole").collect()
    for label, n in ((0, 121), (1, 20)):
        expected = set(ordered(people, label)[:n])
        assert {r.CustomerId for r in done if r.is_high_risk == label and r.is_test} == expected


def test_folds_are_even_ranges(people):
    done = split.stratified_folds(people, n_folds=5).collect()
    for label in (0, 1):
        sizes = [sum(r.fold == j and r.is_high_risk == label for r in done) for j in range(5)]
        assert max(sizes) - min(sizes) <= 1
        place = {k: i for i, k in enumerate(ordered(people, label))}
        rows = sorted((r for r in done if r.is_high_risk == label), key=lambda r: place[r.CustomerId])
        assert [r.fold for r in rows] == sorted(r.fold for r in rows)


def test_folds_of_tiny_classes(spark):
    df = spark.createDataFrame([("a", 0), ("b", 0), ("c", 1)], "CustomerId string, is_high_risk int")
    folds = {r.CustomerId: r.fold for r in split.stratified_folds(df).collect()}
    assert set(folds) == {"a", "b", "c"} and folds["a"] != folds["b"]


def test_weights_balance(people):
    done = split.balanced_weights(people).collect()
    total = {y: sum(r.weight for r in done if r.is_high_risk == y) for y in (0, 1)}
    assert total[0] == pytest.approx(total[1]) == pytest.approx(701 / 2)


def test_too_many_classes(spark):
    df = spark.range(2000).selectExpr("cast(id as string) as CustomerId", "id as is_high_risk")
    with pytest.raises(ValueError, match="classes"):
        split.class_sizes(df)


def auc_by_pairs(rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return wins / (len(pos) * len(neg))


def test_auc_with_ties(spark):
    rows = list(zip([0, 0, 1, 1, 1, 0], [0.1, 0.4, 0.4, 0.8, 0.9, 0.4]))
    df = spark.createDataFrame(rows, "label int, score double")
    assert metrics.roc_auc(df, by=[]).first().roc_auc == pytest.approx(0.8888888889)


@pytest.mark.parametrize("buckets", [2, 7, 256])
def test_auc_by_model_equals_all_pairs(spark, buckets):
    def score(i, m):
        # a third of the rows share one score
        return 0.5 if i % 3 == 0 else ((i * 7919 + m * 31) % 101) / 101

    rows = [(f"m{m}", int((i * i + m) % 5 < 2), score(i, m)) for m in range(3) for i in range(300)]
    df = spark.createDataFrame(rows, "model string, label int, score double").repartition(4)
    found = {r.model: r.roc_auc for r in metrics.roc_auc(df, buckets=buckets).collect()}
    for m in range(3):
        expected = auc_by_pairs([(y, s) for n, y, s in rows if n == f"m{m}"])
        assert found[f"m{m}"] == pytest.approx(expected, abs=1e-12)


def test_auc_of_one_class_is_null(spark):
    df = spark.createDataFrame([("m", 1, 0.5)], "model string, label int, score double")
    assert metrics.roc_auc(df).first().roc_auc is None


def test_report(spark):
    rows = [("m", 1, 1)] * 3 + [("m", 1, 0)] * 1 + [("m", 0, 1)] * 2 + [("m", 0, 0)] * 4
    df = spark.createDataFrame(rows, "model string, label int, prediction int")
    row = metrics.binary_metrics(df).first()
    assert (row.accuracy, row.precision, row.recall) == (0.7, 0.6, 0.75)
    assert row.f1 == pytest.approx(2 / 3)
    report = {r.row: r for r in metrics.classification_report(df).collect()}
    assert report["0"].precision == 0.8 and report["0"].support == 6
    assert report["accuracy"].f1 == 0.7 and report["accuracy"].support == 10
    assert report["macro avg"].precision == pytest.approx(0.7)
    assert report["weighted avg"].recall == pytest.approx(0.7)
    none = spark.createDataFrame([("m", 0, 0)], "model string, label int, prediction int")
    assert tuple(metrics.binary_metrics(none).first())[1:] == (1.0, 0.0, 0.0, 0.0)


def test_rows_without_a_key_count_nowhere(spark):
    rows = [(str(i), i % 2) for i in range(40)] + [(None, 0)] * 7
    df = spark.createDataFrame(rows, "CustomerId string, is_high_risk int")
    parts = split.stratified_split(df).groupBy("is_high_risk", "is_test").count().collect()
    assert {(r.is_high_risk, r.is_test): r["count"] for r in parts} == {
        (0, 0): 16, (0, 1): 4, (1, 0): 16, (1, 1): 4
    }
    folds = split.stratified_folds(df).groupBy("fold").count().collect()
    assert [r["count"] for r in folds] == [8] * 5


def test_infinite_scores(spark):
    inf = float("inf")
    rows = [("m", 1, inf), ("m", 0, -inf), ("m", 1, 0.5), ("m", 0, 0.5), ("m", 0, inf)]
    df = spark.createDataFrame(rows, "model string, label int, score double")
    assert metrics.roc_auc(df).first().roc_auc == pytest.approx((0.5 + 2 + 1.5) / 6)
