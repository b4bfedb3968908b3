"""Session settings and the staging of intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SCRATCH_CONF = "spark.checkpoint.dir"


def local_session(cpus: int = 8, app: str = "riskframe", **conf: str) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config(SCRATCH_CONF, tempfile.mkdtemp(prefix="riskframe-scratch-"))
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_own_scratch: dict[str, str] = {}
_staged: dict[str, list[str]] = {}


def scratch_dir(spark: SparkSession) -> str | None:
    """The shared folder for intermediate tables, or None where a cluster names none.

    Only a local session without the setting gets a folder of its own: on a
    cluster a machine-local folder is invisible to the other machines.
    """
    folder = spark.conf.get(SCRATCH_CONF, None)
    if folder is None and spark.conf.get("spark.master", "").startswith("local"):
        app = spark.sparkContext.applicationId
        if app not in _own_scratch:
            _own_scratch[app] = tempfile.mkdtemp(prefix="riskframe-scratch-")
            spark.sparkContext.setCheckpointDir(_own_scratch[app])
        folder = _own_scratch[app]
    return folder


def staged_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, for ``drop_stages`` to remove."""
    folder = scratch_dir(spark)
    if folder is None:
        raise ValueError(f"set {SCRATCH_CONF} to a folder that all executors share")
    path = f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _staged.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def stage(df: DataFrame, name: str = "stage", path: str | None = None) -> DataFrame:
    """Compute ``df`` once and return a DataFrame that reads the stored result.

    Used where a table is read by several jobs (fits, iterative training). The
    copy is a parquet table in the shared scratch folder, so it survives the loss
    of executors, prunes columns, and lets Catalyst see its true size. A cluster must
    name that folder in ``spark.checkpoint.dir``. ``drop_stages`` removes the copies.
    ``path`` is one that ``staged_path`` gave, for a copy that ends earlier.
    """
    spark = df.sparkSession
    path = path or staged_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(spark: SparkSession, *paths: str) -> None:
    """Remove copies that nothing reads any more."""
    known = _staged.get(spark.sparkContext.applicationId, [])
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    for path in paths:
        place = hadoop.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
        known.remove(path)


def drop_stages(spark: SparkSession) -> int:
    """Remove the tables staged by this application; what reads them must be done with.

    Returns how many there were.
    """
    paths = list(_staged.get(spark.sparkContext.applicationId, []))
    drop_staged(spark, *paths)
    return len(paths)
