"""k-means: the same on any layout, against a plain version, and its odd cases."""

import math
import random

import pytest

from riskframe.operators import kmeans, label

COLUMNS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(7)
    middles = [(-2.0, 0.0, 1.0), (1.5, 1.5, 0.0), (0.0, -2.0, -1.0)]
    return [(f"C{i}", *(m + draw.gauss(0, 0.7) for m in middles[i % 3])) for i in range(600)]


def made(spark, rows):
    return spark.createDataFrame(rows, "id string, a double, b double, c double")


def units(row):
    return tuple(float(round(x * kmeans.UNIT)) for x in row[1:])


def apart(p, c):
    return sum((x - y) * (x - y) for x, y in zip(p, c))


def plain_lloyd(points, centres):
    while True:
        own = [min(range(len(centres)), key=lambda k: (apart(p, centres[k]), k)) for p in points]
        moved = []
        for k in range(len(centres)):
            mine = [p for p, o in zip(points, own) if o == k]
            moved.append(tuple(float(math.floor(sum(int(x) for x in xs) / len(mine) + 0.5)) for xs in zip(*mine)))
        if moved == list(centres):
            return tuple(centres), sum(math.floor(apart(p, centres[o])) for p, o in zip(points, own))
        centres = moved


def test_equals_plain_steps_from_the_same_draws(spark, rows):
    points = [units(r) for r in rows]
    names = ["_p0", "_p1", "_p2"]
    table = spark.createDataFrame([(r[0], *p) for r, p in zip(rows, points)], ["_key", *names])
    starts = kmeans.draw_starts(table, names, 3, 4, 42)
    assert all(len(set(s)) == 3 and set(s) <= set(points) for s in starts)
    found = kmeans.settle(table, names, starts, 300)
    assert [(one.centres, one.inertia) for one in found] == [plain_lloyd(points, s) for s in starts]
    assert all(one.settled and sum(one.sizes) == len(rows) for one in found)


def test_layout_does_not_matter_and_the_best_start_is_kept(spark, rows):
    fit = kmeans.fit(made(spark, rows).repartition(1), COLUMNS, "id")
    shuffled = random.Random(1).sample(rows, len(rows))
    again = kmeans.fit(made(spark, shuffled).repartition(7), COLUMNS, "id")
    assert fit == again
    assert fit.starts[fit.chosen].inertia == min(s.inertia for s in fit.starts)
    alone = kmeans.fit(made(spark, rows), COLUMNS, "id", n_starts=1)
    assert fit.starts[fit.chosen].inertia <= alone.starts[0].inertia
    assert kmeans.fit(made(spark, rows), COLUMNS, "id", random_state=1).starts != fit.starts


def test_first_centres_are_drawn_evenly_and_the_next_by_distance(spark):
    table = spark.createDataFrame([(str(i), x) for i, x in enumerate([0.0, 1.0, 3.0])], "_key string, _p0 double")
    starts = kmeans.draw_starts(table, ["_p0"], 2, 1500, 3)
    firsts = [s[0][0] for s in starts]
    assert all(abs(firsts.count(x) / 1500 - 1 / 3) < 0.05 for x in (0.0, 1.0, 3.0))
    seconds = [s[1][0] for s in starts if s[0][0] == 0.0]
    assert abs(seconds.count(3.0) / len(seconds) - 0.9) < 0.06


def test_centre_without_rows_moves_to_the_farthest(spark):
    table = spark.createDataFrame([(str(x), float(x)) for x in (0, 1, 2, 100)], "_key string, _p0 double")
    found = kmeans.settle(table, ["_p0"], [((1.0,), (1000.0,))], 300)[0]
    assert found.centres == ((1.0,), (100.0,)) and found.sizes == (3, 1)
    same = spark.createDataFrame([("a", 5.0), ("b", 5.0)], "_key string, _p0 double")
    stuck = kmeans.settle(same, ["_p0"], [((5.0,), (9.0,))], 300)[0]
    assert stuck.centres == ((5.0,), (9.0,)) and stuck.sizes == (2, 0) and stuck.settled


def test_stopped_early_keeps_centres_sizes_and_inertia_together(spark, rows):
    points = [units(r) for r in rows]
    names = ["_p0", "_p1", "_p2"]
    table = spark.createDataFrame([(r[0], *p) for r, p in zip(rows, points)], ["_key", *names])
    start = tuple(points[:3])
    found = kmeans.settle(table, names, [start], 1)[0]
    assert found.centres == start and not found.settled and found.passes == 1
    assert found.inertia == sum(math.floor(min(apart(p, c) for c in start)) for p in points)


def test_small_moves_end_the_search(spark, rows):
    exact = kmeans.fit(made(spark, rows), COLUMNS, "id", tol=0.0)
    near = kmeans.fit(made(spark, rows), COLUMNS, "id", tol=1e-2)
    assert all(a.passes <= b.passes and a.settled for a, b in zip(near.starts, exact.starts))
    assert sum(a.passes for a in near.starts) < sum(b.passes for b in exact.starts)


def test_sums_beyond_a_long(spark):
    far = 4.0e18
    table = spark.createDataFrame([(str(i), far) for i in range(5)] + [("x", -far)], "_key string, _p0 double")
    found = kmeans._step(table, ["_p0"], {0: ((far,), (-far,))})
    assert found[0][0][:2] == (5, [5 * int(far)]) and found[0][1][:2] == (1, [-int(far)])


def test_nulls_repeats_and_empty_tables(spark):
    few = [("a", 1.0, 1.0, 1.0), ("b", 1.0, 1.0, 1.0), ("c", 2.0, 2.0, 2.0), ("d", None, 1.0, 1.0), ("e", float("nan"), 0.0, 0.0)]
    fit = kmeans.fit(made(spark, few), COLUMNS, "id")
    assert [len(s.centres) for s in fit.starts] == [2, 2, 2, 2]  # two distinct points
    found = {r.id: r.Cluster for r in fit.transform(made(spark, few)).collect()}
    assert found["a"] == found["b"] != found["c"] and found["d"] is found["e"] is None
    empty = kmeans.fit(made(spark, []), COLUMNS, "id")
    assert empty.centres == {} and empty.transform(made(spark, few)).filter("Cluster is not null").isEmpty()


def test_rows_stay_in_the_engine(spark, rows):
    fit = kmeans.fit(made(spark, rows), COLUMNS, "id")
    plan = fit.transform(spark.range(9).selectExpr("id", "1D as a", "2D as b", "3D as c"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "Python" not in text


def test_label_of_an_empty_table_is_null(spark):
    columns = f"CustomerId string, {', '.join(f'{c} double' for c in label.RFM)}"
    assert label.label_rfm(spark.createDataFrame([], columns)).collect() == []
