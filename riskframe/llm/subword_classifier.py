"""Supervised subword embeddings: hashed word and character n-gram vectors, averaged per
document, with a softmax output, trained by stochastic gradient descent in numpy.

Features of a text: every word, every pair of neighbouring words, every run of 3 to 5
bytes of a word with the blank on either side, and, for a word pair that the text has
had before, a mark that it came again; each is hashed to a bucket that has a vector. As
average and output are linear, a trained model is applied as one number per bucket.

The model is fitted on at most ``max_rows`` labelled rows, those of least hash of the
id, which reach the driver as three bytes per distinct bucket of a text (a count goes up
to 255); everything else reads whole texts of all rows.

Cases: a null or empty text has no features and gets the score of the bias alone; equal
texts get equal scores; an empty table gives an empty result; without labels of both
classes the model gives every text the share of ones (a half without labels); other
columns pass through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.llm import words as W
from riskframe.llm.frames import cols, fresh, labelled_sample, quoted

BUCKETS = 1 << 16
GRAMS = (3, 4, 5)
MAX_ROWS = 4_000
DIMENSION = 16

_GRAM = (W.randoms(256, 21) >> np.uint64(32)).astype(np.uint32)
_MOST = np.uint32(BUCKETS - 1)


def _spread(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint32(16))) * np.uint32(0x7FEB352D)
    return ((x ^ (x >> np.uint32(15))) & _MOST).astype(np.int64)


def block_features(block: W.Block) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, bucket) of all features of a block, family by family."""
    data, size = block.data, len(block.data)
    found = W.words(block, ~W.SPACE)
    if not len(found.start):
        return
    hashes = W.hash_words(data, found.start, found.end)
    low = np.uint64(BUCKETS - 1)
    yield found.row, (hashes & low).astype(np.int64)
    pairs, first = W.windows(hashes, found.row, 2)
    row = found.row[first]
    yield row, (pairs & low).astype(np.int64)
    own = pairs ^ W.mix(row.astype(np.uint64))
    order = np.argsort(own, kind="stable")
    again = order[1:][own[order[1:]] == own[order[:-1]]]
    yield row[again], np.full(len(again), int(W.mix(np.array([77], np.uint64))[0] & low), np.int64)
    # runs of bytes with blanks at their ends only; texts are parted by blanks
    n_texts = block.n
    at = block.offsets[:-1] + np.arange(n_texts) + 1
    padded = np.full(size + n_texts + 1, 0x20, np.uint8)
    place = np.arange(size) + np.repeat(np.arange(n_texts) + 1, np.diff(block.offsets))
    padded[place] = data
    blank = W.SPACE[padded]
    code = _GRAM[padded]
    inner = np.concatenate(([0], np.cumsum(blank)))
    heads = np.concatenate((at - 1, [len(padded)]))
    for n in GRAMS:
        m = len(padded) - n + 1
        total = code[:m] * np.uint32(2 * n + 1)
        for i in range(1, n):
            total = total * np.uint32(0x9E3779B1) + code[i : m + i]
        # no blank strictly inside, and not two blanks for ends of nothing
        whole = np.flatnonzero(inner[n - 1 : n - 1 + m] == inner[1 : m + 1])
        yield np.searchsorted(heads, whole, "right") - 1, _spread(total[whole])


def _sparse(block: W.Block) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per text of a block: its buckets and how often each occurs."""
    rows, buckets = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for row, bucket in block_features(block):
        rows.append(row)
        buckets.append(bucket)
    keys, counts = np.unique(np.concatenate(rows) * BUCKETS + np.concatenate(buckets), return_counts=True)
    head = np.searchsorted(keys, np.arange(block.n + 1) * BUCKETS)
    for i in range(block.n):
        a, b = head[i], head[i + 1]
        yield keys[a:b] - i * BUCKETS, counts[a:b]


@dataclass
class SubwordModel:
    """``weight`` holds what each bucket adds to the log odds; ``bias`` is their start."""

    weight: np.ndarray
    bias: float

    def scores(self, block: W.Block) -> np.ndarray:
        total, n = np.zeros(block.n), np.zeros(block.n)
        for row, bucket in block_features(block):
            total += np.bincount(row, self.weight[bucket], block.n)
            n += np.bincount(row, minlength=block.n)
        z = self.bias + total / np.maximum(n, 1)
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def train(
    texts: list[tuple[np.ndarray, np.ndarray]],
    labels: np.ndarray,
    dimension: int = DIMENSION,
    epochs: int = 12,
    rate: float = 0.5,
    seed: int = 11,
) -> SubwordModel:
    """Stochastic gradient descent over texts given as (buckets, counts)."""
    share = float(labels.mean()) if len(labels) else 0.5
    if not 0 < share < 1:
        share = min(max(share, 0.01), 0.99)
        return SubwordModel(np.zeros(BUCKETS, np.float32), float(np.log(share / (1 - share))))
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / dimension, 1 / dimension, (BUCKETS, dimension)).astype(np.float32)
    output = np.zeros((2, dimension), np.float32)
    bias = np.log([1 - share, share]).astype(np.float32)
    steps, done = epochs * len(texts), 0
    for _ in range(epochs):
        for i in rng.permutation(len(texts)):
            buckets, counts = texts[i]
            step = rate * (1 - done / steps)
            done += 1
            if not len(buckets):
                continue
            part = (counts / counts.sum(dtype=np.int64)).astype(np.float32)
            hidden = part @ vectors[buckets]
            z = output @ hidden + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            error = -p
            error[labels[i]] += 1
            back = error @ output
            output += step * np.outer(error, hidden)
            bias += 0.1 * step * error
            # a bucket's share of the average would make its step too small to learn from
            vectors[buckets] += (step * np.minimum(part * len(buckets), 1.0))[:, None] * back
    weight = vectors @ (output[1] - output[0])
    return SubwordModel(weight.astype(np.float32), float(bias[1] - bias[0]))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    max_rows: int = MAX_ROWS,
    **options,
) -> SubwordModel:
    """A model from ``docs`` and ``labels`` (doc_id, label 0 or 1), at most ``max_rows`` rows."""
    sample = labelled_sample(docs, labels, doc_id, text, label, max_rows)
    chosen = sample.select("label", "text", F.xxhash64("doc_id").alias("place"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for block in W.blocks(batch.column(1)):
                out += [
                    (b.astype(np.uint16).tobytes(), np.minimum(c, 255).astype(np.uint8).tobytes())
                    for b, c in _sparse(block)
                ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array([b for b, _ in out], pa.binary()),
                    pa.array([c for _, c in out], pa.binary()),
                ],
                ["label", "place", "buckets", "counts"],
            )

    found = chosen.mapInArrow(run, "label int, place long, buckets binary, counts binary").toArrow()
    # views of what has arrived, in the order of the hash, so that partitioning changes nothing
    read = lambda name, kind: [np.frombuffer(v.as_buffer(), kind) for v in found.column(name)]
    texts = list(zip(read("buckets", np.uint16), read("counts", np.uint8)))
    labels = found.column("label").to_numpy().astype(np.int64)
    order = np.lexsort((labels, found.column("place").to_numpy()))
    return train([texts[i] for i in order], labels[order], **options)


def score(df: DataFrame, model, text: str = "text", out: str = "score") -> DataFrame:
    """``df`` with ``out``, the probability of label 1 of every whole text.

    ``model`` is a SubwordModel, or any object with a ``scores(block)`` of one number per text.
    """
    sent = df.sparkSession.sparkContext.broadcast(model)  # of fixed size
    (raw,) = fresh(df, "_raw")
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sent.value.scores(b) for b in W.blocks(batch.column(batch.num_columns - 1), 1 << 20)]
            made = pa.array(np.concatenate(found) if found else np.zeros(0), pa.float64())
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*kept, made], schema.names)

    read = df.select(*cols(df.columns), F.col(quoted(text)).cast("binary").alias(raw))
    return read.mapInArrow(run, schema)


def held_out(doc_id: str = "doc_id"):
    """True for the third of ids that no model may learn labels from."""
    return F.coalesce(F.crc32(F.col(quoted(doc_id)).cast("string").cast("binary")) % 3 == 1, F.lit(False))
