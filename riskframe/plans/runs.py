"""Run records and the versioned store of models.

Both are append-only parquet tables under a folder the caller names, written and
read by Spark, so they live wherever the cluster's files live.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUN_SCHEMA = (
    "run_id string, run_name string, logged_at timestamp_ntz, params map<string,string>, "
    "metrics map<string,double>, model_path string"
)
VERSION_SCHEMA = (
    "name string, version bigint, path string, tags map<string,string>, saved_at timestamp_ntz"
)


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def log_run(
    spark: SparkSession,
    root: str,
    run_name: str,
    params: Mapping,
    metrics: Mapping[str, float],
    model_path: str | None = None,
) -> str:
    """Append one run; returns its id."""
    run_id = uuid.uuid4().hex
    texts = {k: v if isinstance(v, str) else json.dumps(v) for k, v in params.items()}
    numbers = {k: float(v) for k, v in metrics.items()}
    row = (run_id, run_name, _now(), texts, numbers, model_path)
    spark.createDataFrame([row], RUN_SCHEMA).coalesce(1).write.mode("append").parquet(
        f"{root}/runs"
    )
    return run_id


def read_runs(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(RUN_SCHEMA).parquet(f"{root}/runs")


def _versions(spark: SparkSession, root: str) -> DataFrame | None:
    """All versions of all names; None where none was ever saved."""
    reader = spark.read.schema(VERSION_SCHEMA).option("recursiveFileLookup", True)
    try:
        return reader.parquet(f"{root}/versions")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _taken(e: AnalysisException) -> bool:
    return e.getCondition() in ("PATH_ALREADY_EXISTS",)


def save_model(
    spark: SparkSession, model: PipelineModel, root: str, name: str, tags: Mapping[str, str] | None = None
) -> int:
    """Store a model as the next version of its name; returns the version.

    A version is claimed by writing its record to a path of its own; where another
    writer has it already the next number is tried.
    """
    known = _versions(spark, root)
    last = None
    if known is not None:
        last = known.filter(F.col("name") == name).agg(F.max("version")).first()[0]
    version = last or 0
    path = f"{root}/models/{name}/{uuid.uuid4().hex}"
    model.write().save(path)
    while True:
        version += 1
        row = (name, version, path, dict(tags or {}), _now())
        record = spark.createDataFrame([row], VERSION_SCHEMA).coalesce(1)
        try:
            record.write.mode("error").parquet(f"{root}/versions/{name}/{version}")
        except AnalysisException as e:
            if _taken(e):
                continue
            raise
        return version


def load_model(
    spark: SparkSession, root: str, name: str, version: int | None = None, fallback: str | None = None
) -> PipelineModel:
    """The given version of a model, or the highest; else the model at ``fallback``."""
    known = _versions(spark, root)
    found = None
    if known is not None:
        wanted = known.filter(F.col("name") == name)
        if version is not None:
            wanted = wanted.filter(F.col("version") == version)
        found = wanted.orderBy(F.desc("version")).select("path").first()
    if found is not None:
        return PipelineModel.load(found["path"])
    if fallback is not None:
        return PipelineModel.load(fallback)
    raise LookupError(f"no model {name!r} (version {version or 'any'}) under {root}")
