"""Jump consistent hashing of stable keys to shards, by Spark expressions only.

A key's position is followed from jump to jump: from bucket b the key moves next at
floor((b + 1) / u), u the next number of a sequence that depends on the key alone, and
its shard is the last position below the number of shards. So no table of shards is
kept, and one more shard takes only rows that jump into it.

Rows are numbered inside their shard without a sort of whole shards: equal rows are
counted first, a shard is split into sub-buckets, and only their sizes are summed.

Cases: a null text has no bytes; a null key is a key of its own; rows that repeat a key
share a shard and get slots of their own; an empty table gives an empty result. Extra
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.frames import quoted, stored

SEED = 20_011
SUB_BUCKETS = 64
OVERHEAD = 16


def jump(key: Column, shards: int) -> Column:
    """The shard of a key, 0 to shards-1. Every step moves on by one bucket at least."""
    if shards < 1:
        raise ValueError("shards must be 1 or more")
    start = F.struct(F.lit(-1).cast("long").alias("b"), F.lit(0).cast("long").alias("j"))

    def step(acc: Column, i: Column) -> Column:
        # 52 bits of the i-th number of the key, as a fraction above 0
        u = (F.shiftrightunsigned(F.xxhash64(key, i, F.lit(SEED)), 12).cast("double") + 1) / float(1 << 52)
        far = F.least(F.floor((acc["j"] + 1).cast("double") / u), F.lit(shards).cast("long"))
        on = acc["j"] < shards
        return F.struct(F.when(on, acc["j"]).otherwise(acc["b"]).alias("b"), F.when(on, far).otherwise(acc["j"]).alias("j"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, step, lambda acc: acc["b"].cast("int"))


def shard_rows(
    df: DataFrame,
    shards: int,
    key: str = "doc_id",
    text: str = "text",
    sub_buckets: int = SUB_BUCKETS,
) -> DataFrame:
    """Per row: key, size, text_crc32, shard, slot, grown_shard (with one more shard)."""
    body = F.coalesce(F.col(quoted(text)), F.lit(""))
    facts = df.select(
        F.col(quoted(key)).alias("key"),
        (F.octet_length(body).cast("long") + OVERHEAD).alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
    )
    # equal rows once, with their number, so that a hot key is one row from here on
    alike = facts.groupBy("key", "size", "text_crc32").agg(F.count(F.lit(1)).alias("n"))
    # numbered and summed from one stored copy, so texts are read once
    placed = stored(
        alike.select(
            "*",
            jump(F.col("key"), shards).alias("shard"),
            jump(F.col("key"), shards + 1).alias("grown_shard"),
            F.pmod(F.xxhash64("key", F.lit(SEED + 1)), F.lit(sub_buckets)).cast("int").alias("sub"),
        ),
        "placed",
    )
    inside = Window.partitionBy("shard", "sub").orderBy("key", "size", "text_crc32")
    run = placed.withColumn("upto", F.sum("n").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    sizes = placed.groupBy("shard", "sub").agg(F.sum("n").alias("held"))
    before = Window.partitionBy("shard").orderBy("sub").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("shard", "sub", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("offset"))
    # one row per shard and sub-bucket: a table of fixed size
    numbered = run.join(F.broadcast(offsets), ["shard", "sub"])
    first = F.col("offset") + F.col("upto") - F.col("n")
    return numbered.select(
        "key",
        "size",
        "text_crc32",
        "shard",
        F.explode(F.sequence(first, first + F.col("n") - 1)).alias("slot"),
        "grown_shard",
    )
