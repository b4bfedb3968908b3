"""Byte-level BPE encoding and decoding of texts of any length.

Long texts are cut into chunks that overlap. Chunks are pre-tokenised in parallel; two
neighbours are stitched at a boundary that both find inside their overlap and that is
sure whatever stands around it: a visible character before it and a blank or line end
after it, since no pre-token holds a blank after another character. Chunks without such
a boundary stay together. The pieces between stitches are encoded in parallel and their
ids put in order. A text of one chunk is one piece. Decoding joins the bytes of the ids.

Cases: a null or empty text has no ids; equal rows get equal ids; an empty table gives
an empty result; other columns pass through, whatever their names.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.llm.frames import cols, fresh, quoted

CHUNK = 1 << 15
OVERLAP = 1 << 9
SLICE_BYTES = 1 << 21


@lru_cache(maxsize=4)
def _encoding(ranks: bytes, pattern: str):
    """The tokenizer, built once per worker process."""
    import tiktoken

    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})


def slices(batch: pa.RecordBatch, column: int, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``most`` bytes of the column."""
    at, size = 0, 0
    values = batch.column(column)
    lengths = pc.fill_null(pc.binary_length(values), 0).to_pylist()
    for i, n in enumerate(lengths):
        if i > at and size + n > most:
            yield batch.slice(at, i - at)
            at, size = i, 0
        size += n
    if at < len(lengths):
        yield batch.slice(at)


def read_ranks(path: str) -> bytes:
    """The vocabulary file, read by the driver; it is of fixed size and is broadcast."""
    with open(path, "rb") as f:
        return f.read()


def _encode_column(df: DataFrame, column: str, out: str, ranks, pattern: str) -> DataFrame:
    """``column`` replaced by the ids of its texts, each encoded as a whole."""
    at = df.columns.index(column)
    fields = [f for f in df.schema.fields if f.name != column]
    schema = T.StructType([*fields, T.StructField(out, T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        encode = _encoding(ranks.value, pattern).encode_to_numpy
        for batch in batches:
            for part in slices(batch, at):
                ids = [encode(t or "", disallowed_special=()) for t in part.column(at).to_pylist()]
                ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                flat = np.concatenate(ids).view(np.int32) if ids else np.zeros(0, np.int32)
                kept = [part.column(i) for i in range(part.num_columns) if i != at]
                made = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
                yield pa.RecordBatch.from_arrays([*kept, made], schema.names)

    return df.mapInArrow(run, schema)


def _sure(text: str, boundary: int) -> bool:
    """No pre-token of any text can hold both characters at this boundary."""
    before, after = text[boundary - 1], text[boundary]
    return after in " \n" and ("!" <= before <= "~" or before.isalpha())


def _boundaries(chunks: DataFrame, pattern: str, step: int) -> DataFrame:
    """Per chunk, its sure pre-token boundaries inside the overlap at either end."""
    more = T.StructType.fromDDL("head array<int>, tail array<int>")
    schema = T.StructType([*chunks.schema.fields, *more.fields])
    at = chunks.columns.index("chunk")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        token = regex.compile(pattern)
        for batch in batches:
            heads, tails = [], []
            for text in batch.column(at).to_pylist():
                head, tail = [], []
                for m in token.finditer(text):
                    e = m.end()
                    if e < len(text) and (e <= OVERLAP or e >= step) and _sure(text, e):
                        if e <= OVERLAP:
                            head.append(e)
                        if e >= step:
                            tail.append(e - step)
                heads.append(head)
                tails.append(tail)
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(heads, kind), pa.array(tails, kind)], schema.names
            )

    return chunks.mapInArrow(run, schema)


def stitch(chunks: list[tuple[str, list[int], list[int]]], step: int) -> list[str]:
    """The pieces of one text, from its chunks (text, head, tail) in order."""
    pieces, open_piece, begin = [], [], 0
    for k, (text, _, tail) in enumerate(chunks):
        last = k + 1 == len(chunks)
        common = set() if last else set(tail) & set(chunks[k + 1][1])
        if last:
            open_piece.append(text[begin:])
        elif common:
            cut = min(common)
            open_piece.append(text[begin : step + cut])
            begin = cut
        else:
            open_piece.append(text[begin:step])
            begin = 0
            continue
        pieces.append("".join(open_piece))
        open_piece = []
    return pieces


def _pieces(marked: DataFrame, step: int) -> DataFrame:
    def run(group: pa.Table) -> pa.Table:
        rows = sorted(group.select(["seq", "chunk", "head", "tail"]).to_pylist(), key=lambda r: r["seq"])
        pieces = stitch([(r["chunk"], r["head"], r["tail"]) for r in rows], step)
        key = group.column("key")[0].as_py()
        return pa.table(
            {
                "key": pa.array([key] * len(pieces), pa.string()),
                "place": pa.array(range(len(pieces)), pa.int32()),
                "piece": pa.array(pieces, pa.string()),
            }
        )

    return marked.groupBy("key").applyInArrow(run, "key string, place int, piece string")


def encode(
    df: DataFrame,
    ranks: bytes,
    pattern: str,
    text: str = "text",
    out: str = "ids",
    chunk: int = CHUNK,
) -> DataFrame:
    """``df`` with ``text`` replaced by ``out``, the token ids of the whole text."""
    if chunk <= 2 * OVERLAP:
        raise ValueError(f"chunk must exceed {2 * OVERLAP}")
    sent = df.sparkSession.sparkContext.broadcast(ranks)
    spread = df.sparkSession.conf.get("spark.sql.shuffle.partitions")
    step = chunk
    rest = [c for c in df.columns if c != text]
    body = F.coalesce(F.col(quoted(text)), F.lit(""))
    name, key = fresh(df, out + "_text", "_key")
    whole = df.select(*cols(rest), body.alias(name))
    one = _encode_column(whole.filter(F.length(quoted(name)) <= step), name, out, sent, pattern)

    long_texts = whole.filter(F.length(quoted(name)) > step).withColumn(key, F.md5(F.col(quoted(name)).cast("binary")))
    chunks = (
        long_texts.select(F.col(quoted(key)).alias("key"), F.col(quoted(name)).alias("whole"))
        .select("key", "whole", F.explode(F.sequence(F.lit(0), F.ceil(F.length("whole") / step).cast("int") - 1)).alias("seq"))
        .select("key", "seq", F.substring("whole", F.col("seq") * step + 1, F.lit(step + OVERLAP)).alias("chunk"))
        .dropDuplicates(["key", "seq"])
        .repartition(int(spread), "key", "seq")
    )
    pieces = _pieces(_boundaries(chunks, pattern, step), step).repartition(int(spread), "key", "place")
    coded = (
        _encode_column(pieces, "piece", "part", sent, pattern)
        .groupBy("key")
        .agg(F.array_sort(F.collect_list(F.struct("place", "part"))).alias("parts"))
        .select(F.col("key").alias(key), F.flatten("parts.part").alias(out))
    )
    many = long_texts.select(*cols(rest), quoted(key)).join(coded, key).select(*cols(rest), quoted(out))
    return one.unionByName(many)


def decode(df: DataFrame, ranks: bytes, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with ``out``: the bytes that the ids stand for."""
    sent = df.sparkSession.sparkContext.broadcast(ranks)
    at = df.columns.index(ids)
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        model = _encoding(sent.value, pattern)
        size = max(model.token_byte_values().__len__(), model.n_vocab)
        table = [b""] * size
        for token, rank in model._mergeable_ranks.items():
            table[rank] = token
        lengths = np.array([len(t) for t in table], np.int64)
        starts = np.cumsum(lengths) - lengths
        flat = np.frombuffer(b"".join(table), np.uint8)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                made = []
                for row in part.column(at):
                    own = row.values.to_numpy(zero_copy_only=False) if row.is_valid else np.zeros(0, np.int32)
                    n = lengths[own]
                    before = np.cumsum(n) - n
                    place = np.arange(int(n.sum())) + np.repeat(starts[own] - before, n)
                    made.append(flat[place].tobytes())
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(made, pa.binary())], schema.names)

    return df.mapInArrow(run, schema)
