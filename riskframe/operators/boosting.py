"""Gradient boosting of many fits at once: every pass over the rows serves all points and folds.

The method is that of ``pyspark.ml``'s ``GBTClassifier``: regression trees by variance, the first on
the labels as -1 and 1, the others on the slope of the log loss, scaled by the learning rate. There
each fit is a chain of small jobs of its own. Here a fit of at most ``LOCAL_ROWS`` rows is grown by one
task, all fits side by side in one job; a task holds about 100 bytes a row. Above that the rows are stored
as blocks (bins of the columns by fold left out, labels, margins of every fit), and one job a level finds
the histograms of all open nodes of all fits. Both ways find the same trees. Every ``KEPT_ROUNDS`` rounds the blocks are stored again with their margins, and
the trees since then are applied in each pass, so no pass gets longer as the fits go on.

Slopes are whole multiples of 1 / ``UNIT`` and their sums exact, so the trees do not depend on the order
of blocks. A tree's rows are drawn by a hash of the row's place among the rows that are fitted on.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions import sql
from riskframe.operators.forest import MOST_BINS, _mix, bin_edges
from riskframe.operators.penalized import logistic
from riskframe.operators.trees import Ensemble
from riskframe.session import drop_staged, stage, staged_path

BLOCK_ROWS, LEAST_ROWS = 20_000, 500
BLOCK_BYTES = 4_000_000
KEPT_ROUNDS = 5
MOST_SENT = 32_000_000
LOCAL_ROWS = 5_000_000
MOST_CELLS = 256
UNIT = 2.0**28
_BLOCKS = "part int, n int, first binary, held binary, y binary, codes binary, margins binary"
_SUMS = "fit int, node int, sums binary"
_SENT = "fit int, part int, n int, first long, held binary, y binary, codes binary"
_NODES = {"nodes": np.int32, "feature": np.int16, "cut": np.int16, "low": np.int32, "value": np.float64}


@dataclass(frozen=True)
class Problem:
    """One fit; rows of ``without_fold`` take no part in it."""

    rounds: int
    rate: float
    depth: int
    subsample: float
    without_fold: int | None = None


@dataclass
class Tree:
    """Nodes as columns; ``low`` is the low child, the high one comes after it (a leaf is its own)."""

    feature: list[int] = field(default_factory=lambda: [0])
    cut: list[int] = field(default_factory=lambda: [MOST_BINS])
    low: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])
    levels: int = 0

    def split(self, node: int, feature: int, cut: int, values: Sequence[float]) -> list[int]:
        made = [len(self.low), len(self.low) + 1]
        self.feature[node], self.cut[node], self.low[node] = feature, cut, made[0]
        for child, value in zip(made, values):
            self.feature.append(0)
            self.cut.append(MOST_BINS)
            self.low.append(child)
            self.value.append(value)
        return made

    def settle(self) -> None:
        """Nodes as arrays, which take less room; no more are added."""
        for k, kind in list(_NODES.items())[1:]:
            setattr(self, k, np.array(getattr(self, k), kind))

    def ends(self, codes: np.ndarray) -> np.ndarray:
        """The node of each row; ``codes`` is (column, row)."""
        n = codes.shape[1]
        feature, cut, low = np.array(self.feature, np.int64) * n, np.array(self.cut, np.uint8), np.array(self.low, np.int64)
        flat, row, node = codes.ravel(), np.arange(n), np.zeros(n, np.int64)
        for _ in range(self.levels):
            node = low.take(node) + (flat.take(feature.take(node) + row) > cut.take(node))
        return node


def _blocks(df: DataFrame, features: str, label: str, fold_col: str | None, sets: Sequence[int | None], edges: Sequence, fits: int) -> DataFrame:
    """Rows in blocks; per set of rows to fit on: who is in it, its bins, and how many of it came before."""
    cuts = [[np.array(e) for e in one] for one in edges]
    width = len(cuts[0])
    size = max(LEAST_ROWS, min(BLOCK_ROWS, BLOCK_BYTES // (8 * fits + len(sets) * width)))
    fold = F.lit(-1) if fold_col is None else F.col(sql.name(fold_col)).cast("int")
    read = df.select(
        F.spark_partition_id().alias("part"), vector_to_array(sql.name(features)).alias("x"),
        F.col(sql.name(label)).cast("double").alias("y"), fold.alias("fold"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, waiting, held_rows = np.zeros(len(sets), np.int64), [], 0

        def block(table: pa.Table) -> pa.RecordBatch:
            n = table.num_rows
            x = table.column("x").combine_chunks().flatten().to_numpy().reshape(n, width)
            of = table.column("fold").to_numpy()
            held = np.stack([np.ones(n, bool) if s is None else of != s for s in sets])
            codes = np.stack([[np.searchsorted(c, x[:, j]) for j, c in enumerate(one)] for one in cuts]).astype(np.uint8)
            y = np.where(table.column("y").to_numpy() > 0, 1, -1).astype(np.int8)
            values = [table.column("part")[0].as_py(), n, *[a.tobytes() for a in (first, held, y, codes, np.zeros(fits * n))]]
            first[:] += held.sum(axis=1)
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, [pa.int32()] * 2 + [pa.binary()] * 5)], _BLOCKS.split()[::2])

        for batch in batches:
            waiting.append(batch)
            held_rows += batch.num_rows
            if held_rows >= size:
                rows = pa.Table.from_batches(waiting)
                for at in range(0, held_rows - size + 1, size):
                    yield block(rows.slice(at, size))
                waiting = rows.slice(held_rows - held_rows % size).to_batches()
                held_rows %= size
        if held_rows:
            yield block(pa.Table.from_batches(waiting))

    return read.mapInArrow(run, _BLOCKS)


@dataclass
class _Block:
    """A stored block, read; ``margins`` has the trees ``since`` it was stored added."""

    row: dict
    sets: int
    fits: int

    def __post_init__(self):
        n = self.n = self.row["n"]
        self.first = np.frombuffer(self.row["first"], np.int64)
        self.held = np.frombuffer(self.row["held"], bool).reshape(self.sets, n)
        self.y = np.frombuffer(self.row["y"], np.int8).astype(float)
        self.codes = np.frombuffer(self.row["codes"], np.uint8).reshape(self.sets, -1, n)
        self.stored = np.frombuffer(self.row["margins"]).reshape(self.fits, n)

    def margin(self, fit: int, of: int, since: Sequence[tuple[float, Tree]]) -> np.ndarray:
        total = self.stored[fit]
        for weight, tree in since:
            total = total + weight * np.array(tree.value).take(tree.ends(self.codes[of]))
        return total

    def drawn(self, of: int, turn: int, seed: int, share: float) -> np.ndarray:
        """The rows that a tree is fitted on."""
        held = self.held[of]
        return _drawn(held, _hashed(self.row["part"], self.first[of], held), turn, seed, share)


def _hashed(part: int, first: int, held: np.ndarray) -> np.ndarray:
    """A hash of each row's place among the rows that are fitted on."""
    return _mix((np.uint64(part) << np.uint64(33)) + (first + np.cumsum(held) - 1).astype(np.uint64))


def _drawn(held: np.ndarray, hashed: np.ndarray, turn: int, seed: int, share: float) -> np.ndarray:
    if share >= 1:
        return np.flatnonzero(held)
    key = _mix(np.array([seed * 1_000_003 + turn], np.uint64))
    return np.flatnonzero(held & (_mix(hashed ^ key) / 2.0**64 < share))


def _slopes(y: np.ndarray, margin: np.ndarray) -> np.ndarray:
    return 4 * y / (1 + np.exp(np.clip(2 * y * margin, -700, 700)))


def _read(batches: Iterator[pa.RecordBatch], sets: int, fits: int) -> Iterator[_Block]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield _Block({name: batch.column(name)[i].as_py() for name in batch.schema.names}, sets, fits)


def _level(blocks: DataFrame, problems: Sequence[Problem], of: Sequence[int], grown: list, since: int, opened: dict, turn: int, seed: int, width: int, tasks: int) -> dict:
    """(fit, node): (column, bin, rows and slopes) of all open nodes, in one job."""
    sets, fits = max(of) + 1, len(problems)
    late = {i: [(1.0 if k == 0 else problems[i].rate, t) for k, t in enumerate(grown[i][:-1])][since:] for i in opened}
    now = {i: grown[i][-1] for i in opened}
    shares = {i: problems[i].subsample for i in opened}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {i: np.zeros((width, len(nodes) * MOST_BINS, 2), np.int64) for i, nodes in opened.items()}
        for block in _read(batches, sets, fits):
            for i, nodes in opened.items():
                rows = block.drawn(of[i], turn, seed, shares[i])
                place = np.full(len(now[i].low), -1)
                place[nodes] = np.arange(len(nodes))
                at = place.take(now[i].ends(block.codes[of[i]]).take(rows))
                if (at < 0).any():
                    rows, at = rows[at >= 0], at[at >= 0]
                y = block.y.take(rows)
                slope = y if turn == 0 else _slopes(y, block.margin(i, of[i], late[i]).take(rows))
                slope, at, n = np.rint(slope * UNIT), at * MOST_BINS, len(nodes) * MOST_BINS
                for j in range(width):
                    cell = at + block.codes[of[i], j].take(rows)
                    total[i][j, :, 0] += np.bincount(cell, minlength=n)
                    total[i][j, :, 1] += np.bincount(cell, slope, n).astype(np.int64)
        made = [(i, k, np.ascontiguousarray(total[i][:, a * MOST_BINS : (a + 1) * MOST_BINS]).tobytes()) for i, nodes in opened.items() for a, k in enumerate(nodes)]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made), (pa.int32(), pa.int32(), pa.binary()))], ["fit", "node", "sums"])

    def add(group: pa.Table) -> pa.Table:
        sums = sum(np.frombuffer(v, np.int64) for v in group.column("sums").to_pylist())
        return pa.table([group.column("fit")[:1], group.column("node")[:1], pa.array([sums.tobytes()], pa.binary())], ["fit", "node", "sums"])

    found, keys = blocks.mapInArrow(run, _SUMS), sum(map(len, opened.values()))
    if keys * width * MOST_BINS * 16 * tasks > MOST_SENT:  # too much for the driver to add up
        parallel = blocks.sparkSession.sparkContext.defaultParallelism
        found = found.repartition(min(keys, 2 * parallel), "fit", "node").groupBy("fit", "node").applyInArrow(add, _SUMS)
    out: dict = {}
    for r in found.toArrow().to_pylist():
        sums = np.frombuffer(r["sums"], np.int64).reshape(width, MOST_BINS, 2)
        key = r["fit"], r["node"]
        out[key] = out[key] + sums if key in out else sums
    return out


def best_splits(sums: np.ndarray) -> list[tuple[int, int, list[float]] | None]:
    """Of each node: column, cut and the means of both sides, where that lowers the variance most."""
    count, slope = sums[..., 0], sums[..., 1]
    low_n, low_s = (np.cumsum(v, axis=2)[:, :, :-1] for v in (count, slope))
    high_n, high_s = count.sum(axis=2)[:, :, None] - low_n, (slope.sum(axis=2)[:, :, None] - low_s) / UNIT
    low_s = low_s / UNIT
    parts = low_s**2 / np.maximum(low_n, 1) + high_s**2 / np.maximum(high_n, 1)
    whole = (slope[:, 0].sum(axis=1) / UNIT) ** 2 / np.maximum(count[:, 0].sum(axis=1), 1)
    gain = np.where((low_n > 0) & (high_n > 0), parts - whole[:, None, None], -1.0)
    at = gain.reshape(len(sums), -1).argmax(axis=1)
    j, cut = np.unravel_index(at, gain.shape[1:])
    every = np.arange(len(sums))
    found = gain[every, j, cut] > 1e-12 * parts[every, j, cut]
    means = [(s / np.maximum(n, 1))[every, j, cut].tolist() for s, n in ((low_s, low_n), (high_s, high_n))]
    return [(a, b, [low, high]) if f else None for f, a, b, low, high in zip(found.tolist(), j.tolist(), cut.tolist(), *means)]


@dataclass
class _Packed:
    """Columns of few bins as one of their combinations, so that one count serves them all."""

    columns: list[int]
    sizes: list[int]
    codes: np.ndarray

    @classmethod
    def of(cls, codes: np.ndarray, sizes: Sequence[int]) -> list[_Packed]:
        out: list[_Packed] = []
        for j, size in enumerate(sizes):
            if out and size * int(np.prod(out[-1].sizes)) <= MOST_CELLS:
                last = out[-1]
                out[-1] = cls([*last.columns, j], [*last.sizes, size], last.codes * np.uint8(size) + codes[j])
            else:
                out.append(cls([j], [size], codes[j]))
        return out

    def add(self, rows: np.ndarray, at: np.ndarray | None, slope: np.ndarray, to: np.ndarray) -> None:
        cells = int(np.prod(self.sizes))
        cell = self.codes.take(rows)
        cell = cell if at is None else at * cells + cell
        for k, values in enumerate((None, slope)):
            found = np.bincount(cell, values, len(to) * cells).reshape(len(to), *self.sizes)
            for a, (j, size) in enumerate(zip(self.columns, self.sizes)):
                to[:, j, :size, k] = found.sum(axis=tuple(b + 1 for b in range(len(self.sizes)) if b != a))


def _grown(problem: Problem, codes: np.ndarray, sizes: Sequence[int], y: np.ndarray, held: np.ndarray, hashed: np.ndarray, seed: int) -> Iterator[tuple[Tree, np.ndarray]]:
    """The trees of one fit in turn, each with the margins of all rows after it.

    Of two children only the one of fewer rows is counted; the other has what is left of their parent.
    """
    width, n = codes.shape
    packs, flat, row = _Packed.of(codes, sizes), codes.ravel(), np.arange(n)
    margin, bins = np.zeros(n), max(2, *sizes)

    def counted(rows: np.ndarray, at: np.ndarray | None, slope: np.ndarray, nodes: int) -> np.ndarray:
        out, slope = np.zeros((nodes, width, bins, 2), np.int64), slope.take(rows)
        for pack in packs:
            pack.add(rows, at, slope, out)
        return out

    for turn in range(problem.rounds):
        drawn = _drawn(held, hashed, turn, seed, problem.subsample)
        slope = np.rint((y if turn == 0 else _slopes(y, margin)) * UNIT)
        tree, node, opened = Tree(), np.zeros(n, np.int64), [0]
        sums = counted(drawn, None, slope, 1)
        rows = sums[0, 0, :, 0].sum()
        if rows:
            tree.value[0] = float(sums[0, 0, :, 1].sum() / UNIT / rows)
        while opened and tree.levels < problem.depth:
            splits = best_splits(sums)
            parted = [k for k, split in enumerate(splits) if split is not None]
            children = [tree.split(opened[k], *splits[k]) for k in parted]
            if not children:
                break
            tree.levels += 1
            opened = [k for both in children for k in both]
            feature, cut, low = np.array(tree.feature) * n, np.array(tree.cut, np.uint8), np.array(tree.low)
            node = low.take(node) + (flat.take(feature.take(node) + row) > cut.take(node))
            if tree.levels < problem.depth:
                whole = sums[parted]
                less = np.array([whole[k, j, : cut + 1, 0].sum() * 2 <= whole[k, j, :, 0].sum() for k, (j, cut, _) in enumerate(splits[p] for p in parted)])
                place = np.full(len(tree.low), -1)
                place[np.array(children)[np.arange(len(children)), np.where(less, 0, 1)]] = np.arange(len(children))
                at = place.take(node.take(drawn))
                own = np.flatnonzero(at >= 0)
                few = counted(drawn.take(own), at.take(own), slope, len(children))
                side = less[:, None, None, None]
                sums = np.stack([np.where(side, few, whole - few), np.where(side, whole - few, few)], axis=1).reshape(-1, width, bins, 2)
        margin = margin + (1.0 if turn == 0 else problem.rate) * np.array(tree.value).take(node)
        yield tree, margin


def _in_tasks(df: DataFrame, problems: Sequence[Problem], features: str, label: str, fold_col: str | None, seed: int, use, schema: str) -> tuple[DataFrame, list, list[int]]:
    """``use(fit, trees with margins, labels, who is fitted on)`` for every fit, each in a task that has its rows."""
    known, sets, of, edges = _sets(df, problems, features, fold_col)
    width, sizes = len(edges[0]), [[len(e) + 1 for e in one] for one in edges]
    blocks, names = _blocks(known, features, label, fold_col, sets, edges, 0), _SENT.split()[::2]

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _read(batches, len(sets), 0):
            for s in range(len(sets)):
                fits = [i for i, k in enumerate(of) if k == s]
                values = block.row["part"], block.n, int(block.first[s]), block.held[s].tobytes(), block.row["y"], block.codes[s].tobytes()
                kinds = pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 3
                yield pa.RecordBatch.from_arrays([pa.array(fits, pa.int32()), *[pa.array([v] * len(fits), t) for v, t in zip(values, kinds)]], names)

    def grow(group: pa.Table) -> pa.Table:
        fit = group.column("fit")[0].as_py()
        rows = group.drop_columns("fit").to_pylist()
        held = [np.frombuffer(r["held"], bool) for r in rows]
        hashed = np.concatenate([_hashed(r["part"], r["first"], h) for r, h in zip(rows, held)])
        y = np.concatenate([np.frombuffer(r["y"], np.int8) for r in rows]).astype(float)
        codes = np.concatenate([np.frombuffer(r["codes"], np.uint8).reshape(width, -1) for r in rows], axis=1)
        held = np.concatenate(held)
        return use(fit, _grown(problems[fit], codes, sizes[of[fit]], y, held, hashed, seed), y, held)

    dealt = blocks.mapInArrow(send, _SENT).repartition(2 * len(problems), "fit")
    return dealt.groupBy("fit").applyInArrow(grow, schema), edges, of


def fits_in_tasks(df: DataFrame) -> bool:
    """Whether a fit on these rows is grown by one task."""
    return df.count() <= LOCAL_ROWS


def held_out_scores(
    df: DataFrame, problems: Sequence[Problem], points: Sequence[dict[int, int]], features: str, label: str, fold_col: str, seed: int
) -> DataFrame:
    """(fold, point, label, score) of the rows that a fit left out; ``points`` has the rounds of each point of a fit."""

    def use(fit: int, grown: Iterator, y: np.ndarray, held: np.ndarray) -> pa.Table:
        out, left = [], np.flatnonzero(~held)
        one = (y[left] > 0).astype(np.int32)
        for turn, (_, margin) in enumerate(grown, 1):
            score = 1 / (1 + np.exp(np.clip(-2 * margin[left], -700, 700)))
            for point in [p for p, rounds in points[fit].items() if rounds == turn]:
                whole = [np.full(len(left), v, np.int32) for v in (problems[fit].without_fold, point)]
                out.append(pa.table([*whole, one, score], ["fold", "point", "label", "score"]))
        return pa.concat_tables(out)

    return _in_tasks(df, problems, features, label, fold_col, seed, use, "fold int, point int, label int, score double")[0]


def _fit_in_tasks(df: DataFrame, problems: Sequence[Problem], features: str, label: str, fold_col: str | None, seed: int) -> list[Ensemble]:
    def use(fit: int, grown: Iterator, y: np.ndarray, held: np.ndarray) -> pa.Table:
        trees = [tree for tree, _ in grown]
        parts = {"nodes": [len(t.low) for t in trees], **{k: [v for t in trees for v in getattr(t, k)] for k in list(_NODES)[1:]}}
        return pa.table([pa.array([fit], pa.int32()), *[pa.array([np.array(parts[k], kind).tobytes()]) for k, kind in _NODES.items()]], ["fit", *_NODES])

    found, edges, of = _in_tasks(df, problems, features, label, fold_col, seed, use, "fit int, " + ", ".join(f"{k} binary" for k in _NODES))
    out = {}
    for r in found.toArrow().to_pylist():
        nodes, *parts = (np.frombuffer(r[k], kind) for k, kind in _NODES.items())
        out[r["fit"]] = [Tree(*own) for own in zip(*[np.split(v, np.cumsum(nodes)[:-1]) for v in parts])]
    return [_ensemble(out[i], edges[of[i]], p.rate) for i, p in enumerate(problems)]


def _with_margins(blocks: DataFrame, problems: Sequence[Problem], of: Sequence[int], grown: list, since: int) -> DataFrame:
    sets, fits = max(of) + 1, len(problems)
    late = [[(1.0 if k == 0 else p.rate, t) for k, t in enumerate(own)][since:] for p, own in zip(problems, grown)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _read(batches, sets, fits):
            margins = np.concatenate([block.margin(i, of[i], late[i]) for i in range(fits)])
            values = {**block.row, "margins": margins.tobytes()}
            yield pa.RecordBatch.from_arrays([pa.array([v], pa.int32() if k in ("part", "n") else pa.binary()) for k, v in values.items()], list(values))

    return blocks.mapInArrow(run, _BLOCKS)


def _sets(df: DataFrame, problems: Sequence[Problem], features: str, fold_col: str | None) -> tuple[DataFrame, list, list[int], list]:
    """The rows, the folds left out, which of these each problem has, and the cuts of the columns by fold left out."""
    sets = list(dict.fromkeys(p.without_fold for p in problems))
    # null folds are left out with every fold, as a filter does
    known = df if fold_col is None or None in sets else df.filter(F.col(sql.name(fold_col)).isNotNull())
    edges = [bin_edges(known if s is None else known.filter(F.col(sql.name(fold_col)) != s), sql.name(features)) for s in sets]
    return known, sets, [sets.index(p.without_fold) for p in problems], edges


def fit_many(
    df: DataFrame, problems: Sequence[Problem], features: str = "features", label: str = "label", fold_col: str | None = None, seed: int = 42
) -> list[Ensemble]:
    """The trees of every problem: a task a fit, or all problems advance together, a job a level."""
    if fits_in_tasks(df):
        return _fit_in_tasks(df, problems, features, label, fold_col, seed)
    spark = df.sparkSession
    known, sets, of, edges = _sets(df, problems, features, fold_col)
    path, width = staged_path(spark, "boosted"), len(edges[0])
    dealt = _blocks(known, features, label, fold_col, sets, edges, len(problems)).repartition(spark.sparkContext.defaultParallelism)
    blocks = stage(dealt, path=path)
    tasks = blocks.rdd.getNumPartitions()
    grown: list[list[Tree]] = [[] for _ in problems]
    since = 0
    for turn in range(max(p.rounds for p in problems)):
        live = [i for i, p in enumerate(problems) if turn < p.rounds]
        for i in live:
            grown[i].append(Tree())
        opened = {i: [0] for i in live}
        while opened:
            found = _level(blocks, problems, of, grown, since, opened, turn, seed, width, tasks)
            more = {}
            for (i, node), sums in sorted(found.items()):
                tree, n = grown[i][-1], sums[0, :, 0].sum()
                if node == 0 and n:
                    tree.value[0] = float(sums[0, :, 1].sum() / UNIT / n)
                split = best_splits(sums[None])[0] if tree.levels < problems[i].depth else None
                if split is not None:
                    more.setdefault(i, []).extend(tree.split(node, *split))
            for i in more:
                grown[i][-1].levels += 1
            opened = {i: nodes for i, nodes in more.items() if grown[i][-1].levels < problems[i].depth}
        for i in live:
            grown[i][-1].settle()
        if (turn + 1) % KEPT_ROUNDS == 0:
            kept = staged_path(spark, "boosted")
            blocks = stage(_with_margins(blocks, problems, of, grown, since), path=kept)
            drop_staged(spark, path)
            path, since, tasks = kept, turn + 1, blocks.rdd.getNumPartitions()
    drop_staged(spark, path)
    return [_ensemble(own, edges[of[i]], problems[i].rate) for i, own in enumerate(grown)]


def _ensemble(grown: Sequence[Tree], edges: Sequence, rate: float) -> Ensemble:
    roots = np.cumsum([0, *[len(t.low) for t in grown[:-1]]])
    base = np.repeat(roots, [len(t.low) for t in grown])
    join = lambda k: np.concatenate([np.array(getattr(t, k)) for t in grown])
    own, low, feature, cut = np.arange(len(base)), base + join("low"), join("feature"), join("cut")
    inner = low != own
    threshold = np.array([edges[f][c] if more else 0.0 for f, c, more in zip(feature, cut, inner)])
    weights = np.array([1.0] + [rate] * (len(grown) - 1))
    return Ensemble(roots, low, np.where(inner, low + 1, own), feature, threshold, join("value"), np.full(len(own), 2), weights)


class _Columns(Params):
    featuresCol = Param(Params._dummy(), "featuresCol", "vectors", TypeConverters.toString)


class BoostedModel(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Adds rawPrediction, probability and prediction; nulls stay null."""

    trees = Param(Params._dummy(), "trees", "nodes of all trees, as JSON", TypeConverters.toString)

    def ensemble(self) -> Ensemble:
        return Ensemble(**{k: np.array(v) for k, v in json.loads(self.getOrDefault(self.trees)).items()})

    def _transform(self, df: DataFrame) -> DataFrame:
        one = self.ensemble()

        @F.pandas_udf("double")
        def margin(x):
            import pandas as pd

            known, out = x.notna().to_numpy(), np.full(len(x), np.nan)
            rows = np.flatnonzero(known)
            for at in range(0, len(rows), 1000):
                part = rows[at : at + 1000]
                out[part] = one.margins(np.stack(x.iloc[part].to_list()))
            return pd.Series(out).where(known, None)

        m, p = F.col("_margin"), logistic(2 * F.col("_margin"))
        return df.withColumn("_margin", margin(vector_to_array(sql.name(self.getOrDefault(self.featuresCol))))).select(
            *[F.col(sql.name(c)) for c in df.columns],
            array_to_vector(F.array(-m, m)).alias("rawPrediction"),
            array_to_vector(F.array(1 - p, p)).alias("probability"),
            (p > 0.5).cast("double").alias("prediction"),
        )


class Boosted(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Boosted trees under the log loss, each on a share of the rows."""

    labelCol = Param(Params._dummy(), "labelCol", "0 or 1", TypeConverters.toString)
    maxIter = Param(Params._dummy(), "maxIter", "trees", TypeConverters.toInt)
    stepSize = Param(Params._dummy(), "stepSize", "learning rate", TypeConverters.toFloat)
    maxDepth = Param(Params._dummy(), "maxDepth", "greatest depth", TypeConverters.toInt)
    subsamplingRate = Param(Params._dummy(), "subsamplingRate", "share of the rows of a tree", TypeConverters.toFloat)
    seed = Param(Params._dummy(), "seed", "of the draws", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", maxIter=100, stepSize=0.1, maxDepth=3, subsamplingRate=1.0, seed=42):
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label", maxIter=100, stepSize=0.1, maxDepth=3, subsamplingRate=1.0, seed=42)
        self._set(**self._input_kwargs)

    def problem(self, without_fold: int | None = None) -> Problem:
        return Problem(*[self.getOrDefault(p) for p in (self.maxIter, self.stepSize, self.maxDepth, self.subsamplingRate)], without_fold)

    def _fit(self, df: DataFrame) -> BoostedModel:
        features = self.getOrDefault(self.featuresCol)
        (found,) = fit_many(df, [self.problem()], features, self.getOrDefault(self.labelCol), seed=self.getOrDefault(self.seed))
        return BoostedModel()._set(featuresCol=features, trees=json.dumps({k: v.tolist() for k, v in vars(found).items()}))
