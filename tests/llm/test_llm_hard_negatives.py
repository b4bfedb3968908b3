"""Hard negatives against all pairs, and what cover trees promise."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.llm import hard_negatives as H

ROWS = "vec_id long, embedding array<float>, label int, rank string, anchor_id string, Block string"
EVERY = [math.nan, math.inf, -math.inf]


def made(seed: int, n: int, width: int = 6) -> list:
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(5)]
    rows = [
        (i, [round((x + rng.gauss(0, 0.2)) * 16) / 16 for x in rng.choice(centres)], rng.choice([0, 0, 0, 1, 2, 9]))
        for i in range(n)
    ]
    for i in range(0, n, 11):  # copies and ties
        rows[i] = (i, rows[0][1], rows[i][2])
    rows[20] = (20, [0.0] * width, 0)
    rows[30] = (30, [-x for x in rows[0][1]], 1)
    odd = [(n, None, 1), (n + 1, [1.0] * width, None), (n + 2, [None] + [1.0] * (width - 1), 1), (None, [1.0] * width, 1)]
    odd += [(n + 3 + i, [x] + [1.0] * (width - 1), 1) for i, x in enumerate(EVERY)]
    odd += [(n + 8, [2.0, 1.0], 2), (n + 9, [], 1), (5, [9.0] * width, 9), (6, *rows[6][1:])]
    return rows + odd


def plain(rows: list, every: int, n_positives: int, n_negatives: int, least: int, most: int) -> list:
    held = {}
    for vec_id, vector, label in rows:
        if vec_id is None or vector is None or label is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        row = ((label + 1) % 10 if vec_id % 7 == 0 else label, [math.floor(256 * x) for x in vector])
        held[vec_id] = min(held.get(vec_id, row), row)
    out = []
    for a in sorted(held):
        if a % every:
            continue
        ranked = sorted((-sum(x * y for x, y in zip(held[a][1], held[b][1])), b) for b in held if b != a)
        for p, positive in [(-s, b) for s, b in ranked if held[b][0] == held[a][0]][:n_positives]:
            fit = [(b, -s) for s, b in ranked if held[b][0] != held[a][0] and least * p <= -100 * s <= most * p]
            out += [(a, positive, i + 1, b, p, s) for i, (b, s) in enumerate(fit[:n_negatives])]
    return out


@pytest.mark.parametrize("block_rows, chunk_rows", [(4096, 256), (60, 3)])
def test_equals_all_pairs(spark, block_rows, chunk_rows):
    rows = made(1, 400)
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], ROWS).repartition(3)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    got = H.hard_negatives(df, F.col("vec_id") % 10 == 0, label, block_rows=block_rows, chunk_rows=chunk_rows)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = plain(rows, 10, 5, 10, 30, 90)
    assert len(want) > 500
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)


def test_meetings_are_not_broadcast(spark, monkeypatch):
    """Copies of anchors for each block, or of trees for each chunk, must not reach the driver."""
    rows = [(i, [float(i % 13 - 6), float(i % 7), 1.0], i % 3) for i in range(200)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    plans, kept = [], H.stored
    monkeypatch.setattr(H, "stored", lambda df, *a: plans.append(df) or kept(df, *a))
    found = H.hard_negatives(df, F.col("vec_id") % 5 == 0, F.col("label"), block_rows=30, chunk_rows=5)
    text = "".join(d._jdf.queryExecution().executedPlan().toString() for d in (*plans, found))
    assert "Broadcast" not in text and "FlatMapCoGroupsInArrow" in text


@pytest.mark.parametrize("blocks, chunks, cores", [(1, 1, 8), (1, 500, 8), (13, 3, 6), (151, 25, 8), (5000, 2000, 12), (3, 1, 64)])
def test_tasks_are_enough_and_bounded(blocks, chunks, cores):
    layout = H.Layout.of(blocks, chunks, cores)
    assert layout.run <= H.RUN_BLOCKS and layout.span <= H.SPAN_CHUNKS
    assert (layout.runs - 1) * layout.run < blocks <= layout.runs * layout.run
    assert (layout.spans - 1) * layout.span < chunks <= layout.spans * layout.span
    assert layout.runs * layout.spans >= min(blocks * chunks, H.GROUPS * cores) / 2


def test_runs_of_trees_find_what_single_trees_find(spark, monkeypatch):
    monkeypatch.setattr(H, "GROUPS", 0.01)  # few tasks are enough: runs of blocks, spans of chunks
    monkeypatch.setattr(H, "SPAN_CHUNKS", 4)
    rows = made(2, 400)
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], ROWS).repartition(3)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    got = H.hard_negatives(df, F.col("vec_id") % 10 == 0, label, block_rows=30, chunk_rows=4)
    assert sorted(tuple(r) for r in got.collect()) == sorted(plain(rows, 10, 5, 10, 30, 90))


def test_nothing_to_find(spark):
    none = spark.createDataFrame([], ROWS)
    assert H.hard_negatives(none, F.col("vec_id") % 2 == 0, F.col("label")).count() == 0
    alone = spark.createDataFrame([(2, [1.0], 1), (3, [1.0], 2)], "vec_id long, embedding array<double>, label int")
    assert H.hard_negatives(alone, F.col("vec_id") % 2 == 0, F.col("label")).count() == 0


def _trees():
    rng = np.random.default_rng(3)
    for n in (1, 2, 40, 700):
        x = np.floor(rng.normal(size=(n, 5)) * rng.choice([10, 300], size=(n, 1)))
        x[rng.random(n) < 0.2] = x[0]
        yield H.CoverTree.build(np.arange(n) * 3, rng.integers(0, 3, n), x, leaf=4), x


def test_nodes_cover_their_rows_and_scales_shrink():
    for tree, x in _trees():
        n = len(x)
        assert sorted(tree.ids // 3) == list(range(n))
        norm = (tree.x**2).sum(axis=1)
        lifted = np.column_stack((tree.x, np.sqrt(norm.max() - norm)))
        for b, e, r, first, last in zip(tree.begin, tree.end, tree.radius, tree.first, tree.last):
            assert np.sqrt(((lifted[b:e] - lifted[b]) ** 2).sum(axis=1)).max() <= r + 1e-9
            if last:
                assert tree.begin[first] == b and tree.end[last - 1] == e and (tree.begin[first + 1 : last] == tree.end[first : last - 1]).all()
                apart = np.linalg.norm(lifted[tree.begin[first:last]][:, None] - lifted[tree.begin[first:last]], axis=2)
                np.fill_diagonal(apart, np.inf)
                assert apart.min() > tree.radius[first:last].max() - 1e-9  # centres lie farther apart than children reach


def test_search_equals_a_sort_and_skips_nodes():
    rng = np.random.default_rng(4)
    for tree, x in _trees():
        for q in np.floor(rng.normal(size=(20, 5)) * 100):
            s, allowed = tree.x @ q, tree.labels != 1
            windows = [(-np.inf, np.inf), (float(np.median(s)), float(s.max()) * 0.9), (5.0, 4.0)]
            for (low, high), got in zip(windows, tree.search(q, 7, allowed, windows)):
                fit = np.flatnonzero(allowed & (s >= low) & (s <= high))
                assert list(got) == list(fit[np.lexsort((tree.ids[fit], -s[fit]))][:7])


def test_scores_beyond_exact_numbers_are_refused():
    with pytest.raises(ValueError):
        H.CoverTree.build(np.arange(2), np.arange(2), np.array([[2.0**27], [1.0]]))
