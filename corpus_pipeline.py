"""The corpus pipeline: quality rules, near-dedup, decontamination, secrets, encoding.

Every stage takes (spark, docs, sf_dir) and works on all that the one before has kept.
``run`` writes each stage's result as Parquet to the folder that the executors share and
reads it back for the next one, so a lost executor costs the stage at hand at most.

Cases, for all stages: a null text is empty, and an empty one fails the quality rules; a null
id is no node of a group, so such rows pass near-dedup; rows that repeat an id are one node and
stay or go together, rows that repeat a text follow the least id; texts of any length are taken
whole; other columns pass through, whatever their names; an empty table gives an empty one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm import byte_bpe, decontamination, near_duplicates, quality_rules, secrets
from riskframe.llm.frames import cols, fresh, quoted, stored, table
from riskframe.llm.queries import encoded_digests
from riskframe.llm.shipping import ship


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the decision list learned from ``labels``.

    The list is learned from the documents of this stage that have a label.
    """
    ship(spark)
    (held,) = fresh(docs, "statistics")
    counted = stored(quality_rules.text_statistics(docs, "text", held), "statistics")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    labelled = counted.select("doc_id", quoted(held)).join(labels, "doc_id")
    rules = quality_rules.fit_rules(labelled, "quality", held)
    return counted.filter(quality_rules.verdict(rules, held)).select(*cols(docs.columns))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies: that with the least id."""
    ship(spark)
    groups = near_duplicates.near_duplicates(docs)
    gone = groups.filter("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*cols(docs.columns))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of ``benchmark``."""
    ship(spark)
    found = decontamination.contamination(docs, table(spark, sf_dir, "benchmark"))
    hit = found.filter("n_hit > 0").select("key").distinct()
    (key,) = fresh(docs, "_key")
    keyed = docs.withColumn(key, decontamination.text_key("text"))
    clean = keyed.join(hit, keyed[quoted(key)] == hit["key"], "left_anti")
    return clean.select(*cols(docs.columns))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced, ``n_chars`` counted anew."""
    clean = secrets.redact(docs)
    if "n_chars" not in docs.columns:
        return clean
    counted = F.coalesce(F.length("text").cast("long"), F.col("n_chars"))
    return clean.select(*[counted.alias(c) if c == "n_chars" else F.col(quoted(c)) for c in docs.columns])


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded bytes."""
    ship(spark)
    return encoded_digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality rules", quality_stage),
    ("near-dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secrets_stage),
    ("encoding", encoding_stage),
]

# A learned list, MinHash and BPE are not SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
