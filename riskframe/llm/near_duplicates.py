"""Near-duplicate groups: MinHash bands, sequential Bayesian verification, exact check.

1. Every text becomes its set of five-word shingles (64-bit hashes), a digest of the set
   and a MinHash signature. Texts with equal sets form one class, represented by its
   least id; only representatives are compared.
2. Bands of the signature give buckets. The least id of a bucket, its hub, is paired with
   every other member: a linear number of pairs.
3. A pair's signatures are compared batch by batch. After each batch the posterior of the
   similarity (uniform prior) is asked for P(similarity >= threshold); below ``miss`` the
   pair is dropped. Survivors are verified on their full sets.
4. Components of the verified links. Buckets whose members then lie in several
   components are compared in full, in blocks of bounded bytes: members outside the
   bucket's largest component against all members, pairs within one component left out.
   A block applies step 3 and returns links, no candidates. So no pair of a bucket goes
   untested unless its ends are already linked.
5. Components of all links; the least id of each names it.

The bands find a pair at the threshold but for (1 - t^rows)^bands: 2e-5 at 0.75.

Cases: a text of one to four words is one shingle; a null, empty or blank text has none
and is linked with nothing. Rows that repeat an id are one node: all texts of an id, and
what any of them is linked with, are one component. A row without an id is its own group: component null, kept. An empty table
gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm import bloom as B
from riskframe.llm import words as W
from riskframe.llm.components import components
from riskframe.llm.frames import quoted, stored

SHINGLE = 5
ROWS = 5
BANDS = 40
HASHES = ROWS * BANDS
BATCH = 40
MISS = 1e-5
BLOCK = 1 << 20
BLOOM_BITS = 1 << 24

_FACTORS = (W.randoms(HASHES, 9) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def block_shingles(block: W.Block) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of a block's texts in text order, and where each text's begin."""
    lowered = W.LOWER[block.data]
    found = W.words(W.Block(block.first, lowered, block.offsets), ~W.SPACE)
    hashes = W.hash_words(lowered, found.start, found.end)
    grams, first = W.windows(hashes, found.row, SHINGLE)
    row = found.row[first]
    n_words = W.counts(found.row, block.n)
    for k in range(1, SHINGLE):  # fewer words: the whole text as one
        few = n_words[found.row] == k
        more, at = W.windows(hashes[few], found.row[few], k)
        grams, row = np.concatenate((grams, more)), np.concatenate((row, found.row[few][at]))
    order = np.argsort(row, kind="stable")
    return grams[order], np.searchsorted(row[order], np.arange(block.n + 1))


def block_signatures(grams: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """MinHash signatures, one row per text; texts without shingles have no meaning."""
    x = (W.mix(grams) >> np.uint64(32)).astype(np.uint32)
    held = np.flatnonzero(np.diff(heads) > 0)
    out = np.zeros((len(heads) - 1, HASHES), np.uint32)
    for i in range(HASHES if len(held) else 0):
        y = x * _FACTORS[i]
        y ^= y >> np.uint32(15)
        out[held, i] = np.minimum.reduceat(y, heads[held])
    return out


def signatures(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Per row: doc_id, n_shingles, a digest of the set (f1, f2) and the signature."""
    schema = "doc_id long, n_shingles long, f1 long, f2 long, signature array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in W.blocks(batch.column(1)):
                grams, heads = block_shingles(block)
                sizes = np.zeros(block.n, np.int64)
                digest = np.zeros((block.n, 2), np.int64)
                for i in range(block.n):
                    own = np.unique(grams[heads[i] : heads[i + 1]])
                    sizes[i] = len(own)
                    digest[i] = np.frombuffer(hashlib.blake2b(own.tobytes(), digest_size=16).digest(), np.int64)
                flat = block_signatures(grams, heads).view(np.int32).ravel()
                ends = np.arange(block.n + 1, dtype=np.int32) * HASHES
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(block.first, block.n),
                        pa.array(sizes),
                        pa.array(digest[:, 0].copy()),
                        pa.array(digest[:, 1].copy()),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                    ],
                    ["doc_id", "n_shingles", "f1", "f2", "signature"],
                )

    read = docs.select(F.col(quoted(doc_id)).cast("long").alias("doc_id"), F.col(quoted(text)).cast("binary"))
    return read.mapInArrow(run, schema)


def shingle_sets(docs: DataFrame, doc_id: str, text: str, wanted) -> DataFrame:
    """(id, sorted distinct shingles) of the rows whose id the Bloom filter lets pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            held = wanted.value.passes(W.mix(ids.view(np.uint64)))
            if not held.any():
                continue
            batch = batch.filter(pa.array(held))
            for block in W.blocks(batch.column(1)):
                grams, heads = block_shingles(block)
                sets = [np.unique(grams[heads[i] : heads[i + 1]]).tobytes() for i in range(block.n)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(block.first, block.n), pa.array(sets, pa.binary())], ["id", "shingles"]
                )

    read = docs.filter(F.col(quoted(doc_id)).isNotNull()).select(
        F.col(quoted(doc_id)).cast("long").alias("id"), F.col(quoted(text)).cast("binary")
    )
    return read.mapInArrow(run, "id long, shingles binary")


def least_matches(percent: int, miss: float) -> list[tuple[int, int, int]]:
    """For each batch: from, to, and the fewest matches so far at which a pair stays."""
    x = (np.arange(8192) + 0.5) / 8192
    above = x >= percent / 100
    out = []
    for n in range(BATCH, HASHES + 1, BATCH):
        m = np.arange(n + 1)[:, None]
        log = m * np.log(x) + (n - m) * np.log1p(-x)
        density = np.exp(log - log.max(axis=1, keepdims=True))
        tail = density[:, above].sum(axis=1) / density.sum(axis=1)
        out.append((n - BATCH, n, int(np.argmax(tail >= miss))))
    return out


def likely(left: np.ndarray, right: np.ndarray, bounds: list[tuple[int, int, int]]) -> np.ndarray:
    """Which pairs of signatures (row by row) survive all batches."""
    alive = np.arange(len(left))
    matches = np.zeros(len(left), np.int64)
    for a, b, least in bounds:
        matches[alive] += (left[alive, a:b] == right[alive, a:b]).sum(axis=1)
        alive = alive[matches[alive] >= least]
    out = np.zeros(len(left), bool)
    out[alive] = True
    return out


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, HASHES)


def _prune_pairs(pairs: DataFrame, classes: DataFrame, bounds) -> DataFrame:
    """Pairs (a, b) of representatives that the signatures leave likely."""
    sides = pairs
    for name in ("a", "b"):
        sides = sides.join(classes.select(F.col("rep").alias(name), F.col("signature").alias(f"s_{name}")), name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                held = likely(_matrix(part.column(2)), _matrix(part.column(3)), bounds)
                yield part.select([0, 1]).filter(pa.array(held))

    return sides.select("a", "b", "s_a", "s_b").mapInArrow(run, "a long, b long")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets are similar enough."""
    sides = pairs
    for name in ("a", "b"):
        sides = sides.join(sets.select(F.col("id").alias(name), F.col("shingles").alias(f"s_{name}")), name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = []
            for one, other in zip(batch.column(2), batch.column(3)):
                p, q = (np.frombuffer(s.as_buffer(), np.uint64) for s in (one, other))
                both = len(np.intersect1d(p, q, assume_unique=True))
                held.append(100 * both >= percent * (len(p) + len(q) - both))
            yield batch.select([0, 1]).filter(pa.array(held, pa.bool_()))

    return sides.select("a", "b", "s_a", "s_b").mapInArrow(run, "a long, b long")


def _block_links(members: DataFrame, classes: DataFrame, labels: DataFrame, sets: DataFrame, percent: int, miss: float, block: int) -> DataFrame:
    """Links across components, of buckets that hold several components.

    A bucket's members are dealt into blocks of about ``block`` bytes, and every block of
    members outside the largest component meets every block. A pair is looked at in the
    first band it shares; if that bucket is left out here, its hub or its component has
    settled the pair already. Of a member's links into one component one is returned.
    """
    bounds = least_matches(percent, miss)
    placed = stored(
        members.filter((F.col("size") > 2) & (F.col("rep") != F.col("hub")))
        .select("bucket", "band", "rep", "weight")
        .join(labels.select(F.col("node").alias("rep"), "label"), "rep", "left")
        .select("bucket", "band", "rep", "weight", F.coalesce("label", "rep").alias("component")),
        "placed",
    )
    per_component = placed.groupBy("bucket", "component").agg(F.sum("weight").alias("w"))
    mixed = stored(
        per_component.groupBy("bucket")
        .agg(F.max(F.struct("w", "component")).alias("largest"), F.sum("w").alias("total"))
        .select(
            "bucket",
            F.col("largest.component").alias("bulk"),
            F.ceil((F.col("total") - F.col("largest.w")) / block).cast("int").alias("n_i"),
            F.ceil(F.col("total") / block).cast("int").alias("n_j"),
        )
        .filter("n_i > 0"),
        "mixed",
    )
    rows = (
        placed.join(mixed, "bucket")
        .join(classes.select("rep", "signature"), "rep")
        .join(sets.select(F.col("id").alias("rep"), "shingles"), "rep")
        .withColumn("out", F.col("component") != F.col("bulk"))
    )
    own, i, j = F.xxhash64("rep"), F.sequence(F.lit(0), F.col("n_i") - 1), F.sequence(F.lit(0), F.col("n_j") - 1)
    # each row goes to its own line of blocks as an outsider, and across all lines as a member
    as_left = F.when(
        F.col("out"),
        F.transform(j, lambda x: F.struct(F.pmod(own, "n_i").cast("int").alias("i"), x.alias("j"), F.lit(True).alias("left"))),
    ).otherwise(F.array().cast("array<struct<i: int, j: int, left: boolean>>"))
    as_right = F.transform(
        i, lambda x: F.struct(x.alias("i"), F.pmod(own, "n_j").cast("int").alias("j"), F.lit(False).alias("left"))
    )
    dealt = rows.withColumn("cell", F.explode(F.concat(as_left, as_right))).select(
        "bucket", "cell.i", "cell.j", "cell.left", "band", "rep", "component", "out", "signature", "shingles"
    )

    def compare(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        side, ids, component, out = (group.column(c).to_numpy() for c in ("left", "rep", "component", "out"))
        signature = _matrix(group.column("signature").combine_chunks())
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in group.column("shingles")]
        before = group.column("band")[0].as_py() * ROWS
        right = np.flatnonzero(~side)
        links = []
        for p in np.flatnonzero(side):
            # two outsiders meet twice, once from either side
            q = right[(component[right] != component[p]) & (~out[right] | (ids[p] < ids[right]))]
            same = (signature[q, :before] == signature[p, :before]).reshape(len(q), -1, ROWS)
            q = q[~same.all(axis=2).any(axis=1)]
            q = q[likely(np.broadcast_to(signature[p], (len(q), HASHES)), signature[q], bounds)]
            if not len(q):
                continue
            sizes = np.array([len(sets[x]) for x in q])
            both = np.add.reduceat(is_in(np.concatenate([sets[x] for x in q]), sets[p]), np.cumsum(sizes) - sizes)
            q = q[100 * both >= percent * (len(sets[p]) + sizes - both)]
            _, first = np.unique(component[q], return_index=True)
            links += [(ids[p], ids[x]) for x in q[first]]
        a, b = np.array(links, np.int64).reshape(-1, 2).T
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return dealt.groupBy("bucket", "i", "j").applyInArrow(compare, "a long, b long")


def is_in(keys: np.ndarray, table: np.ndarray) -> np.ndarray:
    """1 for each key that is in a sorted table, else 0."""
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return (table[at] == keys).astype(np.int64)


def _shared_ids(base: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) between an id that comes in several rows and the classes of its texts."""
    held = base.filter("doc_id is not null and n_shingles > 0").select("doc_id", "n_shingles", "f1", "f2")
    repeated = held.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("doc_id")
    return (
        held.join(repeated, "doc_id")
        .join(classes.select("f1", "f2", "n_shingles", "rep"), ["f1", "f2", "n_shingles"])
        .filter("rep != doc_id")
        .select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
        .distinct()
    )


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    percent: int = 75,
    miss: float = MISS,
    block: int = BLOCK,
    bloom_bits: int = BLOOM_BITS,
) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept (its id names the component)."""
    bounds = least_matches(percent, miss)
    base = stored(signatures(docs, doc_id, text), "signatures")
    classes = stored(
        base.filter((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
        .groupBy("f1", "f2", "n_shingles")
        .agg(F.min("doc_id").alias("rep"), F.any_value("signature").alias("signature")),
        "classes",
    )
    band = F.expr(f"transform(sequence(0, {BANDS - 1}), b -> xxhash64(b, slice(signature, b * {ROWS} + 1, {ROWS})))")
    weight = (8 * F.col("n_shingles") + 4 * HASHES).alias("weight")
    banded = classes.select("rep", weight, F.posexplode(band).alias("band", "bucket"))
    hubs = banded.groupBy("bucket").agg(F.min("rep").alias("hub"), F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = stored(banded.join(hubs, "bucket"), "members")

    known = members.select("rep").distinct().select(_mixed("rep").alias("h"))
    wanted = docs.sparkSession.sparkContext.broadcast(B.build(known, "h", bloom_bits))
    sets = stored(shingle_sets(docs, doc_id, text, wanted), "shingles")

    star = members.filter("rep != hub").select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct()
    links = stored(_verified(_prune_pairs(star, classes, bounds), sets, percent), "links")
    links = links.union(_shared_ids(base, classes))
    labels = components(links)
    rest = stored(_block_links(members, classes, labels, sets, percent, miss, block), "links")
    labels = components(links.union(rest))

    ends = classes.select("f1", "f2", "n_shingles", "rep").join(
        labels.select(F.col("node").alias("rep"), "label"), "rep", "left"
    )
    ends = ends.select("f1", "f2", "n_shingles", F.coalesce("label", "rep").alias("component"))
    return (
        base.select("doc_id", "n_shingles", "f1", "f2")
        .join(ends, ["f1", "f2", "n_shingles"], "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def _mixed(column: str):
    """``words.mix`` of a long column, in Arrow batches (ids only)."""

    @F.pandas_udf("long")
    def mixed(ids):
        import pandas as pd

        return pd.Series(W.mix(ids.to_numpy().view(np.uint64)).view(np.int64))

    return mixed(F.col(column))
