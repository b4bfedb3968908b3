"""k-means of several starts that gives the same clusters however the rows are dealt.

``pyspark.ml`` draws its start from the partitions it meets and sums doubles in any order, so
its clusters change with the layout of the table. Here points are whole numbers (``UNIT``
of a scaled column), sums are exact, and the draws of k-means++ hang on a hash of the
row's key, so results are equal on any cluster and can be written in SQL.

All starts go through the rows together: one job for each centre drawn, and one for each step
of the starts that still move. Jobs give back one row per start and cluster.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions import sql
from riskframe.session import drop_staged, stage, staged_path

UNIT = 1_000_000
HASH_BITS = 52

Centres = tuple[tuple[float, ...], ...]


@dataclass(frozen=True)
class Start:
    """Where one start ended: centres (in units), rows of each, and the sum of squared distances."""

    centres: Centres
    sizes: tuple[int, ...] = ()
    inertia: int = 0
    passes: int = 0
    settled: bool = False


@dataclass(frozen=True)
class KMeansFit:
    columns: tuple[str, ...]
    starts: tuple[Start, ...]

    @property
    def chosen(self) -> int:
        """The start of least inertia, the first of equals."""
        return min(range(len(self.starts)), key=lambda i: (self.starts[i].inertia, i))

    @property
    def centres(self) -> dict[int, list[float]]:
        """Cluster and centre, in the scale of the columns."""
        best = self.starts[self.chosen].centres
        return {k: [x / UNIT for x in centre] for k, centre in enumerate(best)}

    def transform(self, df: DataFrame, cluster_col: str = "Cluster") -> DataFrame:
        """Adds the nearest centre, of equally near ones the lower; null where a column is null."""
        best = self.starts[self.chosen].centres
        if not best:
            return df.withColumn(cluster_col, F.lit(None).cast("int"))
        point = [_unit(c) for c in self.columns]
        known = " and ".join(f"{p} is not null" for p in point)
        return df.withColumn(cluster_col, F.expr(f"if({known}, {_nearest(point, best)}.k, null)"))


def _unit(column: str) -> str:
    return f"round({sql.as_double(column)} * {UNIT})"


def _squared(point: Sequence[str], centre: Sequence[float]) -> str:
    apart = [f"({p} - {sql.number(x)})" for p, x in zip(point, centre)]
    return " + ".join(f"{a} * {a}" for a in apart)


def _nearest(point: Sequence[str], centres: Centres) -> str:
    """struct(d, k) of the nearest centre."""
    return f"array_min(array({', '.join(f'struct({_squared(point, c)} as d, {k} as k)' for k, c in enumerate(centres))}))"


def _race(seed: int, start: int, draw: int) -> str:
    """An exponential variable of the row: least of ``race / weight`` draws a row by its weight."""
    digest = f"md5(concat_ws(':', _key, '{seed}', '{start}', '{draw}'))"
    whole = f"cast(conv(substring({digest}, 1, {HASH_BITS // 4}), 16, 10) as double)"
    return f"-ln(({whole} + 0.5D) / {float(2**HASH_BITS)!r}D)"


def draw_starts(points: DataFrame, point: Sequence[str], n_clusters: int, n_starts: int, seed: int) -> list[Centres]:
    """k-means++ by races: each further centre is a row, drawn by its squared distance to the
    centres so far. A start has fewer centres where there are fewer distinct points."""
    found: list[Centres] = [() for _ in range(n_starts)]
    for draw in range(n_clusters):
        open_ = [s for s in range(n_starts) if len(found[s]) == draw]
        if not open_:
            break
        drawn = []
        for s in open_:
            weight = f"{_nearest(point, found[s])}.d" if found[s] else "1D"
            race = f"struct({_race(seed, s, draw)} / {weight} as race, {', '.join(point)})"
            drawn.append(f"min(if({weight} > 0, {race}, null)) as s{s}")
        row = points.selectExpr(*drawn).first()
        for s in open_:
            if row[f"s{s}"] is not None:
                found[s] += (tuple(row[f"s{s}"][p] for p in point),)
    return found


# Whole numbers are summed in two parts, so that no sum of longs passes its range.
LOW_BITS = 24


def _step(points: DataFrame, point: Sequence[str], starts: dict[int, Centres]) -> dict[int, dict[int, tuple]]:
    """Of each start and cluster: rows, exact sums of the columns and of the squared distances."""
    apart = {s: [f"_d{s}_{k}" for k in range(len(c))] for s, c in starts.items()}
    distances = [f"{_squared(point, c)} as {d}" for s in starts for d, c in zip(apart[s], starts[s])]
    near = []
    for s, ds in apart.items():
        least = f"least({', '.join(ds)})" if len(ds) > 1 else ds[0]
        which = " ".join(f"when {d} = {least} then {k}" for k, d in enumerate(ds))
        near.append(f"named_struct('start', {s}, 'k', case {which} end, 'd', {least})")

    def parts(value: str) -> list:
        whole = F.floor(value)
        return [
            F.sum(F.shiftright(whole, LOW_BITS)).alias(f"high{value}"),
            F.sum(whole.bitwiseAND((1 << LOW_BITS) - 1)).alias(f"low{value}"),
        ]

    rows = (
        points.selectExpr(*point, *distances)
        .selectExpr(*point, f"inline(array({', '.join(near)}))")
        .groupBy("start", "k")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.floor("d").cast("decimal(28,0)")).alias("inertia"),
            *[a for p in point for a in parts(p)],
        )
        .collect()
    )
    found: dict[int, dict[int, tuple]] = {s: {} for s in starts}
    for r in rows:
        sums = [(r[f"high{p}"] << LOW_BITS) + r[f"low{p}"] for p in point]
        found[r["start"]][r["k"]] = (r["n"], sums, int(r["inertia"]))
    return found


def _farthest(points: DataFrame, point: Sequence[str], starts: dict[int, Centres]) -> dict[int, tuple | None]:
    """The row farthest from its centre, of each start; of equally far ones the greatest."""
    columns = ", ".join(point)
    far = [f"max(struct({_nearest(point, c)}.d as d, {columns})) as s{s}" for s, c in starts.items()]
    row = points.selectExpr(*far).first()
    return {s: tuple(row[f"s{s}"][p] for p in point) if row[f"s{s}"]["d"] > 0 else None for s in starts}


def _mean(total: int, n: int) -> float:
    return float(math.floor(float(total) / float(n) + 0.5))


def settle(
    points: DataFrame, point: Sequence[str], starts: Sequence[Centres], max_iter: int, tol: float = 0.0
) -> list[Start]:
    """Lloyd's steps of all starts until their centres stay, or ``max_iter`` passes are over.

    Centres stay where their squared moves, summed and in the scale of the columns, are ``tol``
    or less; then that move is not made, so centres, sizes and inertia belong together.

    A centre without rows moves to the row farthest from its own centre, one such centre a
    step, the lowest first; it stays where every row lies on a centre.
    """
    found = [Start(c, settled=not c) for c in starts]
    for done in range(1, max_iter + 1):
        moving = {s: one.centres for s, one in enumerate(found) if not one.settled}
        if not moving:
            break
        sums = _step(points, point, moving)
        empty = {s: c for s, c in moving.items() if len(sums[s]) < len(c)}
        far = _farthest(points, point, empty) if empty else {}
        for s, centres in moving.items():
            moved = [
                tuple(_mean(t, sums[s][k][0]) for t in sums[s][k][1]) if k in sums[s] else c
                for k, c in enumerate(centres)
            ]
            if far.get(s) is not None:
                moved[min(k for k in range(len(centres)) if k not in sums[s])] = far[s]
            sizes = tuple(sums[s][k][0] if k in sums[s] else 0 for k in range(len(centres)))
            inertia = sum(of[2] for of in sums[s].values())
            way = sum((x - y) * (x - y) for new, old in zip(moved, centres) for x, y in zip(new, old))
            stays = way <= tol * UNIT**2
            found[s] = Start(centres, sizes, inertia, done, stays)
            if not stays and done < max_iter:
                found[s] = replace(found[s], centres=tuple(moved))
    return found


def fit(
    df: DataFrame,
    columns: Sequence[str],
    key: str,
    n_clusters: int = 3,
    random_state: int = 42,
    n_starts: int = 4,
    max_iter: int = 300,
    tol: float = 1e-4,
) -> KMeansFit:
    """k-means over scaled ``columns``; ``key`` tells the rows apart. The points are stored once.

    Rows with a null or NaN in a column take no part. Rows of equal key race alike, and of
    equal races the lower point wins. An empty table gives no centres. Scaled values may
    reach 1e9 in size.
    """
    point = [f"_p{i}" for i in range(len(columns))]
    units = [f"{_unit(c)} as {p}" for c, p in zip(columns, point)]
    spark = df.sparkSession
    path = staged_path(spark, "points")
    points = stage(df.selectExpr(f"cast({sql.name(key)} as string) as _key", *units).dropna(subset=point), path=path)
    starts = draw_starts(points, point, n_clusters, n_starts, random_state)
    settled = settle(points, point, starts, max_iter, tol)
    drop_staged(spark, path)
    return KMeansFit(tuple(columns), tuple(settled))
