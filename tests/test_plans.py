"""End to end: build, train, store, score; and the shape of physical plans."""

import io
import json
import os
from contextlib import redirect_stdout

import pytest
from conftest import SMALL
from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from riskframe import queries, session
from riskframe.operators import classifiers, features, split
from riskframe.operators.woe import WoeEncoder
from riskframe.plans import runs
from riskframe.plans.build import build, write_build
from riskframe.plans.score import score_payloads, score_transactions
from riskframe.plans.train import train_all
from riskframe.schema import CUSTOMER_ID, FEATURES, LABEL, REQUEST_SCHEMA
from riskframe.sources.adapters import tx_orders
from riskframe.sources.files import read_csv, read_keyed_csv, read_transactions_csv
from riskframe.sources.payloads import explode_payloads, rejected_payloads, to_payloads
from riskframe.streaming.scoring import read_requests, score_stream


def plan(df) -> str:
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture(scope="module")
def built(spark):
    return build(tx_orders(spark, SMALL))


@pytest.fixture(scope="module")
def trained(spark, built, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("models"))
    labelled = split.align(built.features, built.label)
    grids = {
        "logistic": {"C": [1.0], "penalty": ["l1", "l2"]},
        "gbt": {"n_estimators": [3], "max_depth": [2, 3]},
    }
    families = (classifiers.LOGISTIC, classifiers.GBT)
    # a count of undated rows before must not stand in the way of a fit after
    assert features.undated_rows(tx_orders(spark, SMALL)).first().n_dropped == 0
    result = train_all(labelled, root, families, grids, n_folds=2, tags={"data": "small"})
    return root, result


def test_build_and_files(spark, built, tmp_path):
    assert built.features.columns == [CUSTOMER_ID, *FEATURES]
    target = built.target.collect()
    assert {r[LABEL] for r in target} == {0, 1}
    write_build(built, str(tmp_path))
    features_back = read_keyed_csv(spark, str(tmp_path / "model_features"))
    label_back = read_keyed_csv(spark, str(tmp_path / "is_high_risk_target"))
    assert features_back.count() == label_back.count() == len(target)
    assert dict(label_back.dtypes) == {CUSTOMER_ID: "string", LABEL: "int"}
    means = features_back.agg(*[F.avg(c).alias(c) for c in FEATURES]).first()
    assert all(abs(m) < 1e-9 for m in means)
    encoder = PipelineModel.load(str(tmp_path / "feature_encoder"))
    again = {r[CUSTOMER_ID]: r for r in encoder.transform(tx_orders(spark, SMALL)).collect()}
    for r in features_back.collect():
        assert [r[c] for c in FEATURES] == pytest.approx([again[r[CUSTOMER_ID]][c] for c in FEATURES])


def test_fit_on_train_leaves_test_rows_out(spark, built):
    result = build(tx_orders(spark, SMALL), fit_on="train")
    assert result.features.count() == built.features.count()
    fitted = [s for s in result.encoder.stages if hasattr(s, "edges")][0]
    n = sum(r.n for r in fitted.table().filter("feature = 'transaction_count'").collect())
    assert 0 < n < built.features.count()
    with pytest.raises(ValueError):
        build(tx_orders(spark, SMALL), fit_on="nothing")


def test_training(spark, trained):
    root, result = trained
    names = {"logistic_baseline", "logistic_tuned", "gbt_baseline", "gbt_tuned"}
    compared = {r.model: r for r in result.comparison.collect()}
    assert set(compared) == names
    assert all(r.roc_auc > 0.5 for r in compared.values())
    logged = runs.read_runs(spark, root).collect()
    assert {r.run_name for r in logged} == names
    assert result.best == max(sorted(compared), key=lambda m: compared[m].roc_auc)
    assert result.version == 1
    assert len({r.model_path for r in logged}) == len(logged)
    assert {r.params["class_weight"] for r in logged if "logistic" in r.run_name} == {"balanced"}
    tuned = next(r for r in logged if r.run_name == "gbt_tuned")
    assert "cv_roc_auc" in tuned.metrics and tuned.params["n_estimators"] == "3"


def test_versions_and_fallback(spark, trained, tmp_path):
    root, _ = trained
    model = runs.load_model(spark, root, "risk_classifier")
    assert runs.save_model(spark, model, root, "risk_classifier") == 2
    assert runs.load_model(spark, root, "risk_classifier", version=1).stages
    model.write().save(str(tmp_path / "local"))
    assert runs.load_model(spark, root, "absent", fallback=str(tmp_path / "local")).stages
    with pytest.raises(LookupError):
        runs.load_model(spark, root, "absent")
    with pytest.raises(LookupError):
        runs.load_model(spark, str(tmp_path / "empty"), "absent")
    # a number that another writer has claimed is passed over
    row = ("risk_classifier", 3, "elsewhere", {}, runs._now())
    other = spark.createDataFrame([row], runs.VERSION_SCHEMA)
    other.write.parquet(f"{root}/versions/risk_classifier/4")
    assert runs.save_model(spark, model, root, "risk_classifier") == 5


def test_scoring_survives_storage(spark, built, trained, tmp_path):
    root, _ = trained
    classifier = runs.load_model(spark, root, "risk_classifier", version=1)
    tx = tx_orders(spark, SMALL)
    scored = {r.customer_id: r for r in score_transactions(tx, built.encoder, classifier).collect()}
    assert len(scored) == built.features.count()
    assert all(0 <= r.risk_probability <= 1 for r in scored.values())
    built.encoder.write().overwrite().save(str(tmp_path / "encoder"))
    loaded = PipelineModel.load(str(tmp_path / "encoder"))
    again = {r.customer_id: r for r in score_transactions(tx, loaded, classifier).collect()}
    assert {c: r.risk_probability for c, r in scored.items()} == pytest.approx(
        {c: r.risk_probability for c, r in again.items()}
    )


def transaction(n, customer, **changed):
    values = {f.name: "x" for f in REQUEST_SCHEMA}
    values |= {"TransactionId": f"T{n}", CUSTOMER_ID: customer, "CountryCode": 256}
    values |= {"Amount": 10.0 * n, "Value": 10.0 * n, "PricingStrategy": 2}
    values |= {"TransactionStartTime": f"2024-01-{n:02d} 10:00:00"}
    return {k: v for k, v in (values | changed).items() if v is not ...}


PAYLOADS = [
    ("one", json.dumps([transaction(1, "a"), transaction(2, "a")])),
    ("two", json.dumps([transaction(1, "a"), transaction(2, "b")])),
    ("date", json.dumps([transaction(1, "a", TransactionStartTime="soon"), transaction(3, "a")])),
    ("cut", json.dumps([transaction(1, "a")])[:-3]),
    ("field", json.dumps([transaction(1, "a", Amount=...)])),
    ("type", json.dumps([transaction(1, "a", Amount="much")])),
    ("none", "[]"),
    ("null", None),
    ("quoted", json.dumps([transaction(1, "c", Amount="12.5", PricingStrategy="2")])),
]


def test_payloads(spark, built, trained):
    requests = spark.createDataFrame(PAYLOADS, "request_id string, payload string")
    rejected = {r.request_id: r.reason for r in rejected_payloads(requests).collect()}
    assert rejected == {
        "cut": "malformed payload", "null": "malformed payload", "none": "no transactions",
        "field": "bad or missing field", "type": "bad or missing field",
    }
    assert explode_payloads(requests).count() == 7
    assert explode_payloads(requests).filter("request_id = 'quoted'").first().Amount == 12.5
    classifier = runs.load_model(spark, trained[0], "risk_classifier", version=1)
    scored = score_payloads(requests, built.encoder, classifier)
    assert scored.columns == ["request_id", "customer_id", "risk_probability", LABEL]
    found = {(r.request_id, r.customer_id) for r in scored.collect()}
    assert found == {("one", "a"), ("two", "a"), ("two", "b"), ("date", "a"), ("quoted", "c")}


def test_packed_payloads_stay_bounded(spark):
    packed = to_payloads(tx_orders(spark, SMALL), per_request=100)
    sizes = [len(json.loads(r.payload)) for r in packed.collect()]
    assert sum(sizes) == 1500 and max(sizes) <= 100


def test_requests_are_packed_in_tasks_by_rows(spark, monkeypatch):
    """Partitions of requests follow the number of events, and Spark does not merge them by their few bytes."""
    monkeypatch.setattr(queries, "EVENTS_PER_TASK", 100)
    made = queries.requests(spark, SMALL).withColumn("part", F.spark_partition_id())
    n_events = spark.read.parquet(f"{SMALL}/events.parquet").count()
    parts = made.groupBy("request_id").agg(F.count("*").alias("n"), F.min("part").alias("part")).collect()
    assert all(r.n == 1 for r in parts)
    assert n_events // 100 * 0.8 < len({r.part for r in parts}) <= -(-n_events // 100)


def test_stream_equals_batch(spark, built, trained, tmp_path):
    classifier = runs.load_model(spark, trained[0], "risk_classifier", version=1)
    requests = spark.createDataFrame(PAYLOADS[:4], "request_id string, payload string")
    for i, part in enumerate(requests.randomSplit([0.5, 0.5], seed=1)):
        part.coalesce(1).write.mode("append").json(str(tmp_path / "in"))
    stream = read_requests(spark, str(tmp_path / "in"), max_files=1)
    run = score_stream(
        stream, built.encoder, classifier, str(tmp_path / "out"), str(tmp_path / "ckpt"), True
    )
    run.awaitTermination(300)
    columns = ["request_id", "customer_id", LABEL]
    streamed = spark.read.parquet(str(tmp_path / "out" / "scores")).select(*columns)
    batch = score_payloads(requests, built.encoder, classifier).select(*columns)
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.collect()))
    rejects = spark.read.parquet(str(tmp_path / "out" / "rejects"))
    assert [r.request_id for r in rejects.collect()] == ["cut"]


def test_csv_columns_go_by_name(spark, tmp_path):
    (tmp_path / "t.csv").write_text(
        "Amount,CustomerId,TransactionId,TransactionStartTime\n1.5,c,t,2024-01-01\n,c,u,bad\n"
    )
    rows = read_transactions_csv(spark, str(tmp_path / "t.csv")).orderBy("TransactionId").collect()
    assert (rows[0].Amount, rows[0].CustomerId, rows[1].Amount) == (1.5, "c", None)
    assert rows[1].TransactionStartTime == "bad"
    with pytest.raises(AnalysisException):
        read_transactions_csv(spark, str(tmp_path / "absent.csv"))
    folder = tmp_path / "mixed"
    folder.mkdir()
    (folder / "a.csv").write_text("TransactionId,CustomerId\nt,c\n")
    (folder / "b.csv").write_text("CustomerId,TransactionId\nc,t\n")
    with pytest.raises(Exception, match="[Hh]eader"):
        read_transactions_csv(spark, str(folder)).collect()
    with pytest.raises(ValueError, match="key column"):
        read_keyed_csv(spark, str(tmp_path / "t.csv"), "Nothing")


FITTED = {n for n in queries.all_queries() if n.split("_")[0] in ("logistic", "forest", "gbt", "class", "score")}


def test_no_python_in_plans(spark):
    for name in sorted(set(queries.all_queries()) - FITTED):
        text = plan(queries.all_queries()[name](spark, SMALL))
        assert "EvalPython" not in text and "InPandas" not in text, name
        assert "CartesianProduct" not in text, name


def scans(df) -> list[str]:
    return [line for line in plan(df).splitlines() if "ReadSchema" in line]


def test_scans(spark):
    """How often the tables are read, and what of them."""
    made = scans(features.rfm(tx_orders(spark, SMALL)))
    assert made and not any("o_" in line for line in made)  # only the stored grouping
    assert len(scans(queries.all_queries()["histogram"](spark, SMALL))) == 1
    assert len(scans(queries.all_queries()["kde"](spark, SMALL))) == 1
    assert len(scans(queries.all_queries()["class_balance"](spark, SMALL))) == 1
    read = scans(queries.all_queries()["customer_features"](spark, SMALL))
    assert len(read) == 1 and "o_orderkey" in read[0]


def test_payloads_are_parsed_once(spark):
    for name in ("payload_explode", "payload_rejects"):
        text = queries.all_queries()[name](spark, SMALL)
        tree = text._jdf.queryExecution().optimizedPlan().toString()
        assert tree.count("from_json") == 1, name


def test_group_by_combines_before_the_shuffle(spark):
    text = plan(features.customer_features(tx_orders(spark, SMALL), exact_distinct=False))
    assert text.count("hashpartitioning(CustomerId") == 1
    assert "partial_sum" in text


def test_split_and_encoding_are_projections(spark):
    """Neither the split nor the encoding shuffles the rows they are applied to."""
    table = queries.features_label(spark, SMALL)
    done = split.stratified_folds(split.stratified_split(table).filter("is_test = 0"))
    encoded = WoeEncoder(inputCols=list(FEATURES)).fit(table).transform(done)
    assert "Exchange" not in plan(encoded)


def test_staged_tables_can_be_dropped(spark):
    spark_only = session.stage(spark.range(5).toDF("x"), "five")
    path = spark_only.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    assert os.path.isdir(path) and spark_only.count() == 5
    known = session._staged[spark.sparkContext.applicationId]
    mine, others = [p for p in known if path.endswith(p.rsplit("/", 1)[1])], list(known)
    known[:] = mine
    assert session.drop_stages(spark) == 1 and not os.path.exists(path)
    session._staged[spark.sparkContext.applicationId] = [p for p in others if p not in mine]


def test_csv_types_are_inferred(spark, tmp_path):
    """Types come from all rows of all files; files that disagree are widened."""
    folder = tmp_path / "typed"
    folder.mkdir()
    head = "whole,real,mixed,zeros,time,word,none,long,nan,blank,bad day\n"
    (folder / "a.csv").write_text(
        head + "1,1.5,3,007,2024-01-02,a,,123456789012345678901,NaN, 5,2024-01-02\n-2,1e3,,12,2024-01-02 03:04:05,,,1,4,6,2024-13-45\n"
    )
    (folder / "b.csv").write_text(head + "3,.25,2.5,1,2024-01-02T03:04:05.5Z,7,,2,nan,7,2024-02-01\n")
    df = read_csv(spark, str(folder))
    assert dict(df.dtypes) == {
        "whole": "bigint", "real": "double", "mixed": "double", "zeros": "string", "time": "timestamp",
        "word": "string", "none": "string", "long": "string", "nan": "bigint", "blank": "string", "bad day": "string",
    }
    rows = {r["whole"]: r for r in df.collect()}
    assert [rows[k]["real"] for k in (1, -2, 3)] == [1.5, 1000.0, 0.25]
    assert [rows[k]["mixed"] for k in (1, -2, 3)] == [3.0, None, 2.5]
    assert [rows[k]["nan"] for k in (1, -2, 3)] == [None, 4, None]
    assert [rows[k]["zeros"] for k in (1, -2, 3)] == ["007", "12", "1"]
    assert rows[-2]["time"].isoformat() == "2024-01-02T03:04:05"
    only = tmp_path / "only.csv"
    only.write_text("a,b\n")
    assert dict(read_csv(spark, str(only)).dtypes) == {"a": "string", "b": "string"}


def test_transactions_with_more_columns(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("TransactionId,Score,CustomerId,Branch\n007,1,c,x\n8,2.5,d,y\n")
    df = read_transactions_csv(spark, str(path))
    assert dict(df.dtypes) == {"TransactionId": "string", "Score": "double", "CustomerId": "string", "Branch": "string"}
    assert {r.TransactionId: r.Score for r in df.collect()} == {"007": 1.0, "8": 2.5}
    assert dict(read_transactions_csv(spark, str(path), infer=False).dtypes)["Score"] == "string"
