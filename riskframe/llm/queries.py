"""The queries opN of this subpackage: each applies one operator to a whole table."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm import alignment, byte_bpe, chat, decontamination, hard_negatives, html_extraction, near_duplicates, quality_rules, secrets, sharding, subword_classifier, toxicity, warc
from riskframe.llm.frames import stored, table
from riskframe.llm.shipping import ship

Query = Callable[[SparkSession, str], DataFrame]
_registry: dict[str, Query] = {}


def query(fn: Query) -> Query:
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return fn(spark, sf_dir)

    _registry[fn.__name__] = run
    return run


def all_queries() -> dict[str, Query]:
    return dict(_registry)


def _joined(ids):
    """SHA-256 of the sorted ids, joined by commas."""
    return F.sha2(F.array_join(F.array_sort(ids), ",").cast("binary"), 256)


@query
def op4_quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = stored(quality_rules.text_statistics(docs).drop("text"), "statistics")
    labelled = counted.join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id")
    rules = quality_rules.fit_rules(labelled)
    return counted.select(
        "doc_id",
        *[F.col(f"statistics.{c}") for c in quality_rules.COUNTS[:5]],
        quality_rules.base_failed().alias("base_failed"),
        quality_rules.verdict(rules).alias("kept"),
    )


@query
def op5_benchmark_decontamination(spark, sf_dir):
    found = decontamination.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("ids").cast("long").alias("n_items"),
        _joined("ids").alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query
def op6_minhash_near_dedup(spark, sf_dir):
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"))


def encoded_digests(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """Per row: doc_id, n_tokens, and digests of the ids and of the bytes they decode to."""
    vocabulary = byte_bpe.read_ranks(ranks)
    coded = byte_bpe.encode(docs.select("doc_id", "text"), vocabulary, pattern)
    back = byte_bpe.decode(coded, vocabulary, pattern)
    return back.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op2_secret_scans(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.find_secrets(docs).drop("text")

    def of(kind: str):
        return F.filter("secrets", lambda x: x["kind"] == kind)

    base = F.filter("secrets", lambda x: x["rank"] < 3)
    return found.select(
        "doc_id",
        *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in secrets.KINDS],
        F.sha2(secrets.as_text(base).cast("binary"), 256).alias("base_sha256"),
        secrets.as_text(F.col("secrets")).alias("spans"),
    )


def _control_conversation(spark: SparkSession) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    rows = [(-7, 0, "user", said), (-7, 1, "assistant", said)]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


@query
def op3_chat_formatting(spark, sf_dir):
    """Turns of ``conversations`` as JSON records of five layouts, dealt by a hash."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    messages = F.struct(F.array(F.struct(role.alias("role"), text.alias("content"))).alias("messages"))
    speakers = F.struct(F.array(F.struct(role.alias("from"), text.alias("value"))).alias("conversations"))
    plain = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(3))
    record = (
        F.when((plain == 0) & (role == "user"), F.to_json(F.struct(text.alias("prompt"))))
        .when((plain == 0) & (role == "assistant"), F.to_json(F.struct(text.alias("completion"))))
        .when((plain == 0) & (role == "system"), F.to_json(F.struct(text.alias("system"))))
        .when((plain == 1) & ~role.isin("human", "gpt", "bot"), F.to_json(speakers))
        .otherwise(F.to_json(messages))
    )
    records = turns.unionByName(_control_conversation(spark)).select("conv_id", "turn", "role", record.alias("record"))
    shaped = chat.formatted(chat.canonical_turns(records).drop("record"))
    return chat.read_back(shaped, "conv_id", ["turn", "role"])


@query
def op8_warc(spark, sf_dir):
    archives = warc.archive(table(spark, sf_dir, "pages"))
    return warc.read_archives(archives).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query
def op9_sharding(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.shard_rows(docs, 40).select(
        F.col("key").alias("doc_id"), "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


@query
def op10_byte_bpe(spark, sf_dir):
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    return encoded_digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def _scored(spark: SparkSession, sf_dir: str, label: str, fit, least: float) -> DataFrame:
    """Scores of all documents by a model that has seen labels of two thirds of the ids."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", label)
    out = ~subword_classifier.held_out()
    model = fit(docs.filter(out), labels.filter(out))
    return subword_classifier.score(docs, model).select(
        "doc_id",
        subword_classifier.held_out().alias("held_out"),
        "score",
        (F.col("score") >= least).cast("int").alias("predicted"),
    )


@query
def op1_toxicity(spark, sf_dir):
    return _scored(spark, sf_dir, "toxic", toxicity.fit, 0.7)


@query
def op7_quality_classifier(spark, sf_dir):
    return _scored(spark, sf_dir, "quality", subword_classifier.fit, 0.5)


@query
def op11_html_extraction(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_extraction.extract(pages, html_extraction.fit(pages))


@query
def op12_cross_tokenizer_alignment(spark, sf_dir):
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    paths = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.aligned(docs, *paths, digest=True).withColumnRenamed("groups", "groups_sha256")


@query
def op13_hard_negatives(spark, sf_dir):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)
