"""Small helpers on DataFrames shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.session import stage, staged_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each made longer until no column of ``df`` has it (in any case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def cols(names: Iterable[str]) -> list:
    return [F.col(quoted(n)) for n in names]


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors share (spark.checkpoint.dir)."""
    return staged_path(spark, name)


def stored(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """``df`` written to the shared folder and read back: it cuts lineage for good.

    ``riskframe.session.drop_stages`` removes what was written.
    """
    return stage(df, name, path)


def least_hashed(df: DataFrame, names: list[str], max_rows: int, n: int | None = None) -> DataFrame:
    """At most ``max_rows`` rows, those of least hash of the named columns.

    Rows far from the least are left out before the sort, by the number of rows (``n``, if
    it is known), so that what is gathered does not grow with the partitions. Rows equal
    in the named columns share a hash, so these must tell rows apart.
    """
    (place,) = fresh(df, "_place")
    most, n = 1 << 40, df.count() if n is None else n
    hashed = df.withColumn(place, F.pmod(F.xxhash64(*cols(names)), F.lit(most)))
    if n > max_rows:
        hashed = hashed.filter(F.col(place) <= int(most * min(1.0, 1.2 * max_rows / n)))
    return hashed.orderBy(place, *cols(names)).limit(max_rows).drop(place)


def labelled_sample(
    docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, max_rows: int
) -> DataFrame:
    """(doc_id, text, label) of at most ``max_rows`` documents that have a label 0 or 1.

    The ids are chosen among the labels, by least hash, before any text is touched; they
    are at most ``max_rows`` rows, so they are broadcast and texts are not shuffled. Of
    rows that repeat an id one is taken.
    """
    known = (
        labels.filter(F.col(quoted(label)).isin(0, 1) & F.col(quoted(doc_id)).isNotNull())
        .groupBy(F.col(quoted(doc_id)).alias("doc_id"))
        .agg(F.max(F.col(quoted(label)).cast("int")).alias("label"))
    )
    chosen = least_hashed(known, ["doc_id"], max_rows)
    texts = docs.select(F.col(quoted(doc_id)).alias("doc_id"), F.col(quoted(text)).cast("binary").alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])


def hashed_sample(docs: DataFrame, doc_id: str, text: str, max_rows: int) -> DataFrame:
    """(doc_id, text) of at most ``max_rows`` documents, those of least hash of the id.

    The ids are chosen before any text is touched and broadcast, as in ``labelled_sample``.
    Rows without an id have no place; of rows that repeat one, one is taken.
    """
    ids = docs.select(F.col(quoted(doc_id)).alias("doc_id")).filter("doc_id is not null")
    chosen = least_hashed(ids, ["doc_id"], max_rows).distinct()
    texts = docs.select(F.col(quoted(doc_id)).alias("doc_id"), F.col(quoted(text)).cast("binary").alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])
