"""Benchmark decontamination by winnowing.

A text's fingerprints are the least hash of every ``SPAN`` consecutive grams of ``GRAM``
words, so any two texts that share ``GRAM + SPAN - 1`` (ten) words in a row share a
fingerprint. Items of fewer words are found by the hash of all their words, looked up
among all grams of that length. Documents keep only fingerprints that a Bloom filter of
fixed size lets pass; these are joined with the items' fingerprints, and each hit is
extended over its whole diagonal by comparing words.

Cases: a null or empty text has no words, hits nothing and, as an item, is never hit. An
item without an id still marks words but is not counted or listed. Equal texts are worked out once and
get equal results. An empty table of either kind gives no hits. Extra columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.llm import bloom as B
from riskframe.llm import words as W
from riskframe.llm.frames import quoted, stored

GRAM = 5
SPAN = 6
WINDOW = GRAM + SPAN - 1
BLOOM_BITS = 1 << 22
# Working arrays of a block take some fifty times its bytes, and stay with the worker.
BLOCK_BYTES = 1 << 17

# Digits, letters after lower-casing, and everything beyond ASCII.
WORD = np.zeros(256, bool)
WORD[0x30:0x3A] = WORD[0x61:0x7B] = WORD[0x80:] = True


def block_words(block: W.Block) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of a block, and the row of each."""
    lowered = W.Block(block.first, W.LOWER[block.data], block.offsets)
    found = W.words(lowered, WORD)
    return W.hash_words(lowered.data, found.start, found.end), found.row


def winnow(grams: np.ndarray, row: np.ndarray, span: int = SPAN) -> np.ndarray:
    """Places of the grams that are the least of some run of ``span`` in one row."""
    m = len(grams) - span + 1
    if m <= 0:
        return np.zeros(0, np.int64)
    least, at = grams[:m].copy(), np.arange(m)
    for j in range(1, span):
        less = grams[j : m + j] < least
        least[less] = grams[j : m + j][less]
        at[less] = np.flatnonzero(less) + j
    return np.unique(at[row[:m] == row[span - 1 :]])


def fingerprints(hashes: np.ndarray, row: np.ndarray, short: list[int] = ()) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of a block's texts and the word each begins at."""
    grams, first = W.windows(hashes, row, GRAM)
    kept = winnow(grams, row[first])
    found, places = [grams[kept]], [first[kept]]
    for k in short:
        more, at = W.windows(hashes, row, k)
        found.append(more)
        places.append(at)
    return np.concatenate(found), np.concatenate(places)


def _heads(row: np.ndarray, n: int) -> np.ndarray:
    return np.searchsorted(row, np.arange(n + 1))


def item_table(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """Per item: key, id as text, word hashes, and its fingerprints with their places."""
    schema = "item long, id string, n_words int, hashes array<long>, seeds array<struct<f: long, at: int>>"
    kind = pa.list_(pa.struct([("f", pa.int64()), ("at", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [[], [], []]
            for block in W.blocks(batch.column(2), BLOCK_BYTES):
                hashes, row = block_words(block)
                head = _heads(row, block.n)
                for i in range(block.n):
                    own = hashes[head[i] : head[i + 1]]
                    short = [len(own)] if 0 < len(own) < WINDOW else []
                    f, at = fingerprints(own, np.zeros(len(own), np.int64), short)
                    if short:  # such an item is found by all its words only
                        f, at = f[-1:], at[-1:]
                    out[0].append(len(own))
                    out[1].append(own.view(np.int64))
                    out[2].append([{"f": int(a), "at": int(b)} for a, b in zip(f.view(np.int64), at)])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(out[0], pa.int32()),
                    pa.array(out[1], pa.list_(pa.int64())),
                    pa.array(out[2], kind),
                ],
                ["item", "id", "n_words", "hashes", "seeds"],
            )

    name, body = F.col(quoted(item_id)).cast("string"), F.col(quoted(text))
    read = items.select(
        F.xxhash64(name, body).alias("item"), name.alias("id"), body.cast("binary").alias("text")
    ).distinct()
    return read.mapInArrow(run, schema)


def _document_seeds(docs: DataFrame, bloom, short: list[int]) -> DataFrame:
    """Per row: word count, fingerprints some item may have, and its word hashes if any."""
    more = T.StructType.fromDDL("n_words long, seeds array<struct<f: long, at: int>>, hashes binary")
    schema = T.StructType([*docs.select("key", "doc_id").schema.fields, *more.fields])
    pair = pa.struct([("f", pa.int64()), ("at", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sieve = bloom.value
        for batch in batches:
            n_words, per_row, fs, ats, kept = [], [], [], [], []
            for block in W.blocks(batch.column(2), BLOCK_BYTES):
                hashes, row = block_words(block)
                head = _heads(row, block.n)
                f, at = fingerprints(hashes, row, short)
                held = sieve.passes(f)
                f, at = f[held], at[held]
                order = np.argsort(at, kind="stable")
                f, at = f[order], at[order]
                of = row[at]
                n_words.append(np.diff(head))
                per_row.append(W.counts(of, block.n))
                fs.append(f.view(np.int64))
                ats.append((at - head[of]).astype(np.int32))
                hit = per_row[-1] > 0
                kept += [hashes[head[i] : head[i + 1]].tobytes() if hit[i] else None for i in range(block.n)]
            whole = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
            ends = np.concatenate(([0], np.cumsum(whole(per_row, np.int64)))).astype(np.int32)
            seeds = pa.StructArray.from_arrays(
                [pa.array(whole(fs, np.int64)), pa.array(whole(ats, np.int32))], fields=list(pair)
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(whole(n_words, np.int64)),
                    pa.ListArray.from_arrays(pa.array(ends), seeds),
                    pa.array(kept, pa.binary()),
                ],
                schema.names,
            )

    return docs.mapInArrow(run, schema)


def _shifts(own: np.ndarray, at: np.ndarray, item: np.ndarray, item_at: np.ndarray, last: int, most: int) -> np.ndarray:
    """The diagonals on which a text and an item share a fingerprint, as shifts of the item.

    ``own`` and ``item`` are fingerprints, the others their places. A place of the item marks
    all its diagonals at once, so many equal places need no table of their pairs.
    """
    marked = np.zeros(last + most + 1, bool)  # a shift is -most to last
    order = np.argsort(own, kind="stable")
    own, at = own[order], at[order]
    low, high = np.searchsorted(own, item, "left"), np.searchsorted(own, item, "right")
    for place, a, b in zip(item_at.tolist(), low.tolist(), high.tolist()):
        marked[at[a:b] - place + most] = True
    return np.flatnonzero(marked) - most


def _extend(hits: DataFrame) -> DataFrame:
    """Words inside whole windows on the diagonals of a document's hits."""
    schema = "key string, n_hit long, ids array<string>"

    def seeds(column: pa.ListScalar) -> tuple[np.ndarray, np.ndarray]:
        return tuple(column.values.field(k).to_numpy() for k in ("f", "at"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_hit, ids = [], []
            for stored_words, own_seeds, found in zip(batch.column(1), batch.column(2), batch.column(3)):
                own = np.frombuffer(stored_words.as_py(), np.int64)
                f, at = seeds(own_seeds)
                marked, listed = np.zeros(len(own), bool), set()
                for hit in found.values:
                    item = hit["hashes"].values.to_numpy(zero_copy_only=False)
                    least = min(WINDOW, len(item))
                    for shift in _shifts(f, at, *seeds(hit["seeds"]), len(own), len(item)).tolist():
                        a, b = max(0, shift), min(len(own), shift + len(item))
                        same = own[a:b] == item[a - shift : b - shift]
                        edge = np.flatnonzero(np.diff(np.concatenate(([0], same.view(np.int8), [0]))))
                        for s, e in zip(edge[::2], edge[1::2]):
                            if e - s >= least:
                                marked[a + s : a + e] = True
                                listed.add(hit["id"].as_py())
                n_hit.append(int(marked.sum()))
                ids.append(sorted(x for x in listed if x is not None))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_hit, pa.int64()), pa.array(ids, pa.list_(pa.string()))],
                ["key", "n_hit", "ids"],
            )

    return hits.mapInArrow(run, schema)


def contamination(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    bloom_bits: int = BLOOM_BITS,
) -> DataFrame:
    """Per row of ``docs``: key, doc_id, n_words, n_hit, ids (items with a whole window in it).

    ``key`` is ``text_key(text)``.
    """
    spark = docs.sparkSession
    known = stored(item_table(items, item_id, item_text), "benchmark")
    short = sorted(
        r[0] for r in known.filter(F.col("n_words").between(1, WINDOW - 1)).select("n_words").distinct().collect()
    )
    marks = known.select("item", F.explode(_distinct_prints()).alias("f"))
    bloom = spark.sparkContext.broadcast(B.build(marks, "f", bloom_bits))
    keyed = docs.select(
        text_key(text).alias("key"),
        F.col(quoted(doc_id)).alias("doc_id"),
        F.col(quoted(text)).cast("binary").alias("text"),
    )
    base = stored(_document_seeds(keyed, bloom, short), "seeds")
    texts = stored(base.filter(F.size("seeds") > 0).dropDuplicates(["key"]).drop("doc_id", "n_words"), "texts")
    # a fingerprint counts once a text and once an item, however often either repeats it
    seeds = texts.select("key", F.explode(_distinct_prints()).alias("f"))
    pairs = seeds.join(marks, "f").select("key", "item").distinct()
    found = (
        pairs.join(known.select("item", "id", "hashes", "seeds"), "item")
        .groupBy("key")
        .agg(F.collect_list(F.struct("id", "hashes", "seeds")).alias("hits"))
    )
    extended = _extend(texts.join(found, "key").select("key", "hashes", "seeds", "hits"))
    return base.join(extended, "key", "left").select(
        "key",
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("ids", F.array().cast("array<string>")).alias("ids"),
    )


def _distinct_prints():
    return F.array_distinct(F.transform("seeds", lambda s: s["f"]))


def text_key(text: str):
    """A digest of a text; a null text is empty."""
    return F.md5(F.coalesce(F.col(quoted(text)), F.lit("")).cast("binary"))
