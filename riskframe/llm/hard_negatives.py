"""Hard negatives by best-first descent in cover trees.

Vectors become whole numbers, so scores (inner products) are exact. Rows are dealt by a
hash of their id into blocks, and each block becomes a cover tree over norm-augmented
vectors: one more component lifts all of a block onto one sphere, on which a smaller
distance is a greater inner product. A node is a run of the block's rows with a centre, and
a covering radius that no row of it exceeds; children of a node are centred more than the
level's scale apart, and scales shrink from level to level.

For a query q, a node's scores lie within <q, centre> -/+ |q| * radius. The descent takes
the node of the highest bound first, skips nodes that lie outside the asked window of scores or
cannot better what is found, and works out the scores of leaves exactly.

Anchors are dealt into chunks; every chunk meets every block (a stated query set against
all rows, in blocks), first for the positives, then for the windows they set. A task has a
run of blocks and a span of chunks, and neither is broadcast. An anchor goes through the
trees of a run in turn, what it found being the least that the next tree has to better. A
meeting returns its first rows of each question, and a ranking over those gives the answer.

Cases: rows with a null id, label or vector, or with a null or non-finite component, take
no part; of rows that repeat an id, the one with the least (label, vector) does. Vectors of
different lengths are filled up with zeros. Ties of a score go to the smaller id. An anchor
without another row of its label has no positives and no rows; a negative positive score
leaves an empty window, a zero one only scores of zero. Scores beyond 53 bits raise an
error. An empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.frames import quoted, stored

BLOCK_ROWS = 4096
CHUNK_ROWS = 256
SPAN_CHUNKS, RUN_BLOCKS = 64, 8  # at most, that a task has at once
GROUPS = 4  # of tasks, at least, for each core
LEAF = 24
SHRINK = 0.25  # a level's scale, of the one above
POSITIVES = 5
NEGATIVES = 10
# a window, in per cent of the positive's score
LEAST, MOST = 30, 90


def usable(df: DataFrame, vec_id: str, label: Column, vector: str) -> DataFrame:
    """(vec_id, label, vector) of the rows that take part, components as whole numbers."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    whole = F.transform(vector, lambda x: F.floor(F.lit(256.0) * x.cast("double")).cast("long"))
    return (
        df.select(F.col(quoted(vec_id)).cast("long").alias("vec_id"), label.alias("label"), F.col(quoted(vector)).alias(vector))
        .filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col(vector).isNotNull() & sound)
        .select("vec_id", F.struct(F.col("label").cast("long").alias("label"), whole.alias("vector")).alias("row"))
        .groupBy("vec_id")
        .agg(F.min("row").alias("row"))
        .select("vec_id", "row.label", "row.vector")
    )


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    """A column of lists as a matrix of floats that are whole numbers."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    width = int(n.max()) if len(n) else 0
    if (n == width).all():
        return flat.reshape(len(n), width)
    out = np.zeros((len(n), width))
    out[np.arange(width) < n[:, None]] = flat
    return out


def scores(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products of the rows of ``x`` with one vector: whole numbers below 2^53."""
    d = min(x.shape[-1], len(q))
    return x[..., :d] @ q[:d]


def _checked(x: np.ndarray) -> np.ndarray:
    if x.size and float((x * x).sum(axis=1).max()) >= 2.0**53:
        raise ValueError("vectors are too long for exact scores")
    return x


@dataclass
class CoverTree:
    """Rows of a block in tree order, and its nodes.

    Node i holds the rows begin[i] to end[i], the first of which is its centre; its children
    are the nodes first[i] to last[i], none if it is a leaf.
    """

    ids: np.ndarray
    labels: np.ndarray
    x: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    radius: np.ndarray
    first: np.ndarray
    last: np.ndarray

    @classmethod
    def build(cls, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, leaf: int = LEAF) -> CoverTree:
        x = _checked(x)
        norm = (x * x).sum(axis=1)
        lifted = np.column_stack((x, np.sqrt(norm.max(initial=0.0) - norm)))
        order = np.lexsort((ids, norm))[::-1]  # the longest is the root's centre
        nodes = [(0, len(ids), _reach(lifted[order]), 0, 0)] if len(ids) else []
        scale = {0: nodes[0][2]} if nodes else {}
        at = 0
        while at < len(nodes):
            begin, end, radius, _, _ = nodes[at]
            if end - begin > leaf and radius > 0:
                own, level = order[begin:end], scale[at]
                while True:
                    level *= SHRINK
                    parts = _net(lifted[own], level)
                    if len(parts) > 1:
                        break
                first = len(nodes)
                order[begin:end] = own[np.concatenate(parts)]
                for part in parts:
                    scale[len(nodes)] = level
                    reach = _reach(lifted[order[begin : begin + len(part)]])
                    nodes.append((begin, begin + len(part), reach, 0, 0))
                    begin += len(part)
                nodes[at] = (nodes[first][0], end, radius, first, len(nodes))
            at += 1
        held = np.array(nodes, np.float64).reshape(-1, 5)
        begin, end, first, last = (held[:, k].astype(np.int64) for k in (0, 1, 3, 4))
        return cls(ids[order], labels[order], x[order], begin, end, held[:, 2], first, last)

    def search(self, q: np.ndarray, k: int, allowed: np.ndarray, windows: list[tuple[int, int]]) -> list[np.ndarray]:
        """For each window of scores (from, to): places of the first k allowed rows in it.

        Rows are ordered by falling score, then by id. The windows share the nodes' scores.
        """
        length = float(np.sqrt(q @ q))
        seen: dict[int, np.ndarray] = {}

        def below(node: int) -> np.ndarray:
            """Scores of a leaf's rows, or of the centres of a node's children."""
            if node not in seen:
                at, to = self.first[node], self.last[node]
                rows = self.x[self.begin[at:to]] if to else self.x[self.begin[node] : self.end[node]]
                seen[node] = scores(rows, q)
            return seen[node]

        out = []
        for low, high in windows:
            place, score = np.zeros(0, np.int64), np.zeros(0)
            heap = [(-float(high), 0)] if len(self.begin) else []
            while heap:
                bound, node = heapq.heappop(heap)
                if len(place) == k and -bound < score[-1]:
                    break
                found, first = below(node), self.first[node]
                child = None
                if self.last[node]:
                    child, centre = np.arange(first, self.last[node]), found
                    alone = self.end[child] - self.begin[child] == 1
                    rows, found = self.begin[child[alone]], found[alone]
                else:
                    rows = np.arange(self.begin[node], self.end[node])
                held = np.flatnonzero(allowed[rows] & (found >= (score[-1] if len(place) == k else low)) & (found <= high))
                if len(held) > 4 * k:  # all rows below the k-th score are out
                    held = held[found[held] >= np.partition(found[held], len(held) - k)[len(held) - k]]
                if len(held):
                    place, score = np.concatenate((place, rows[held])), np.concatenate((score, found[held]))
                    order = np.lexsort((self.ids[place], -score))[:k]
                    place, score = place[order], score[order]
                if child is not None:
                    slack = length * self.radius[child] + 1e-6 * (1 + np.abs(centre))
                    least = score[-1] if len(place) == k else low
                    more = ~alone & (centre + slack >= least) & (centre - slack <= high)
                    best = np.minimum(centre[more] + slack[more], high)
                    for c, b in zip(child[more].tolist(), best.tolist()):
                        heapq.heappush(heap, (-b, c))
            out.append(place)
        return out


def _reach(points: np.ndarray) -> float:
    """The greatest distance from the first point to any."""
    return float(np.sqrt(((points - points[0]) ** 2).sum(axis=1).max()))


def _net(points: np.ndarray, scale: float) -> list[np.ndarray]:
    """Places of the points, by the centre that covers them: the first left over is the next centre."""
    square = (points * points).sum(axis=1)
    left, parts = np.arange(len(points)), []
    while len(left):
        centre = left[0]
        apart = square[left] + square[centre] - 2 * (points[left] @ points[centre])
        near = apart <= scale * scale
        near[0] = True
        parts.append(left[near])
        left = left[~near]
    return parts


_TREE = "block int, ids binary, labels binary, x binary, width int, kind string, begin binary, end binary, radius binary, first binary, last binary"
_PARTS = ("begin", "end", "radius", "first", "last")


def _packed(x: np.ndarray) -> np.ndarray:
    """Whole numbers in the smallest type that holds them."""
    most = np.abs(x).max(initial=0.0)
    return x.astype(np.int16 if most < 2**15 else np.int32 if most < 2**31 else np.float64)


def trees(rows: DataFrame, n_blocks: int) -> DataFrame:
    """A cover tree per block of rows, its arrays as bytes."""

    def build(group: pa.Table) -> pa.Table:
        ids, labels = (group.column(c).to_numpy() for c in ("vec_id", "label"))
        tree = CoverTree.build(ids, labels, matrix(group.column("vector")))
        x = _packed(tree.x)
        parts = {p: [getattr(tree, p).tobytes()] for p in ("ids", "labels", *_PARTS)}
        own = {"block": pa.array(group.column("block")[:1].to_pylist(), pa.int32()), "x": [x.tobytes()], "width": pa.array([x.shape[1]], pa.int32()), "kind": [x.dtype.name]}
        return pa.table({**parts, **own}).select([f.split(" ")[0] for f in _TREE.split(", ")])

    dealt = rows.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)).cast("int"))
    return dealt.repartition(n_blocks, "block").groupBy("block").applyInArrow(build, _TREE)


def _tree(row: dict) -> CoverTree:
    ids, labels = (np.frombuffer(row[c], np.int64) for c in ("ids", "labels"))
    x = np.frombuffer(row["x"], row["kind"]).astype(np.float64).reshape(len(ids), row["width"])
    begin, end, first, last = (np.frombuffer(row[c], np.int64) for c in ("begin", "end", "first", "last"))
    return CoverTree(ids, labels, x, begin, end, np.frombuffer(row["radius"], np.float64), first, last)


@dataclass(frozen=True)
class Layout:
    """How many blocks and chunks there are, and how many of them a task has at once."""

    blocks: int
    chunks: int
    run: int
    span: int

    @classmethod
    def of(cls, n_blocks: int, n_chunks: int, cores: int) -> Layout:
        """Few copies of trees and anchors, yet enough tasks and bounded ones."""
        run = max(1, min(RUN_BLOCKS, int(n_blocks / (GROUPS * cores))))
        runs = -(-n_blocks // run)
        spans = min(n_chunks, max(-(-n_chunks // SPAN_CHUNKS), math.ceil(GROUPS * cores / runs)))
        return cls(n_blocks, n_chunks, run, -(-n_chunks // spans))

    @property
    def runs(self) -> int:
        return -(-self.blocks // self.run)

    @property
    def spans(self) -> int:
        return -(-self.chunks // self.span)


def _meetings(anchors: DataFrame, forest: DataFrame, layout: Layout, ask, schema: str) -> DataFrame:
    """``ask(trees of a run, anchors of a chunk)`` for every chunk of anchors and every run of trees.

    Copies of anchors and trees only pass through a shuffle: the plan holds no join that could be broadcast.
    """
    chunks = anchors.groupBy("chunk").agg(F.collect_list(F.struct(*[c for c in anchors.columns if c != "chunk"])).alias("anchors"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    span, run = (F.floor(F.col(c) / F.lit(n)).cast("int") for c, n in (("chunk", layout.span), ("block", layout.run)))
    tasks = layout.runs * layout.spans
    asked = chunks.select(every(layout.runs).alias("run"), span.alias("span"), "anchors").repartition(tasks, "run", "span")
    held = forest.select(run.alias("run"), every(layout.spans).alias("span"), *forest.columns).repartition(tasks, "run", "span")
    kinds = [f.split(" ") for f in schema.split(", ")]
    none = pa.table({n: pa.array([], pa.int64()) for n, _ in kinds})

    def meet(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        if not mine.num_rows or not theirs.num_rows:
            return none
        found = [_tree(row) for row in theirs.drop_columns(["run", "span"]).to_pylist()]
        return pa.concat_tables([none, *[ask(found, a.values) for a in mine.column("anchors")]])

    return asked.groupBy("run", "span").cogroup(held.groupBy("run", "span")).applyInArrow(meet, schema)


def _first_of(forest: list[CoverTree], q: np.ndarray, k: int, allowed, windows: list[tuple[float, float]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each window: ids and scores of the rows among which its first k are; ``allowed(tree)`` says which take part.

    Once k rows are found, only scores as high as the k-th of them are asked of the next tree.
    """
    ids, found = ([np.zeros(0, t) for _ in windows] for t in (np.int64, np.float64))
    least = [low for low, _ in windows]
    for tree in forest:
        may = allowed(tree)
        if not may.any():
            continue
        for i, place in enumerate(tree.search(q, k, may, [(low, high) for low, (_, high) in zip(least, windows)])):
            ids[i], found[i] = np.concatenate((ids[i], tree.ids[place])), np.concatenate((found[i], scores(tree.x[place], q)))
            if len(ids[i]) >= k:
                order = np.lexsort((ids[i], -found[i]))[:k]
                ids[i], found[i] = ids[i][order], found[i][order]
                least[i] = max(least[i], found[i][-1])
    return list(zip(ids, found))


def positives(anchors: DataFrame, forest: DataFrame, layout: Layout, k: int) -> DataFrame:
    """(anchor_id, positives): each anchor's first k other rows of its label, with their scores."""

    def ask(trees: list[CoverTree], asked: pa.StructArray) -> pa.Table:
        out = ([], [], [])
        ids, labels = (asked.field(c).to_numpy() for c in ("vec_id", "label"))
        for anchor, label, q in zip(ids, labels, matrix(asked.field("vector"))):
            allowed = lambda tree, anchor=anchor, label=label: (tree.labels == label) & (tree.ids != anchor)
            ((near, score),) = _first_of(trees, q, k, allowed, [(-np.inf, np.inf)])
            _put(out, (np.full(len(near), anchor), near, score.astype(np.int64)))
        return _taken(out, ("anchor_id", "positive_id", "score"))

    found = _meetings(anchors, forest, layout, ask, "anchor_id long, positive_id long, score long")
    first = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "positive_id")
    return (
        found.withColumn("place", F.row_number().over(first))
        .filter(F.col("place") <= k)
        .groupBy("anchor_id")
        .agg(F.array_sort(F.collect_list(F.struct("place", "positive_id", "score"))).alias("positives"))
    )


def _put(out: tuple, values: tuple) -> None:
    for column, value in zip(out, values):
        column.append(value)


def _taken(out: tuple, names: tuple) -> pa.Table:
    none = np.zeros(0, np.int64)
    return pa.table({n: np.concatenate([none, *v]) for n, v in zip(names, out)})


def hard_negatives(
    df: DataFrame,
    anchor: Column,
    label: Column,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    n_positives: int = POSITIVES,
    n_negatives: int = NEGATIVES,
    least: int = LEAST,
    most: int = MOST,
    block_rows: int = BLOCK_ROWS,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchor`` is a condition on ``vec_id``; ``label`` an expression on ``df``. A negative's
    score lies between ``least`` and ``most`` per cent of its positive's.
    """
    rows = stored(usable(df, vec_id, label, vector), "vectors")
    asked = rows.filter(anchor)
    n, n_anchors = (x.select("vec_id").count() for x in (rows, asked))
    n_blocks, n_chunks = max(1, -(-n // block_rows)), max(1, -(-n_anchors // chunk_rows))
    layout = Layout.of(n_blocks, n_chunks, df.sparkSession.sparkContext.defaultParallelism)
    forest = stored(trees(rows, n_blocks), "trees")
    chunk = F.pmod(F.xxhash64("vec_id"), F.lit(n_chunks)).cast("int").alias("chunk")
    anchors = stored(asked.select("vec_id", "label", "vector", chunk), "anchors")
    near = positives(anchors, forest, layout, n_positives)
    paired = stored(anchors.join(near.withColumnRenamed("anchor_id", "vec_id").hint("merge"), "vec_id"), "positives")

    def ask(trees: list[CoverTree], asked: pa.StructArray) -> pa.Table:
        out = ([], [], [], [], [])
        ids, labels, pairs = (asked.field(c).to_pylist() for c in ("vec_id", "label", "positives"))
        for anchor_id, own, q, mine in zip(ids, labels, matrix(asked.field("vector")), pairs):
            windows = [(least * p["score"] / 100, most * p["score"] / 100) for p in mine]
            for p, (other, score) in zip(mine, _first_of(trees, q, n_negatives, lambda tree, own=own: tree.labels != own, windows)):
                ends = [np.full(len(other), v) for v in (anchor_id, p["positive_id"], p["score"])]
                _put(out, (*ends, other, score.astype(np.int64)))
        return _taken(out, ("anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"))

    schema = "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"
    found = _meetings(paired, forest, layout, ask, schema)
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= n_negatives)
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
