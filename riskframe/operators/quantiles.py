"""Quantiles with linear interpolation, exact at any size.

``percentile`` keeps every distinct value of a column in one task, so it is out of
the question for a column of unbounded size. Here the wanted order statistics are
bracketed first by ``percentile_approx`` (a mergeable sketch of bounded size), the
brackets are counted exactly, and only the values inside a bracket are ranked.
Brackets that still hold too many distinct values are narrowed again. No pass
shuffles the rows; what reaches the driver is a few numbers per quantile.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions import sql
from riskframe.session import stage

ACCURACY = 10_000
MAX_RANKED = 500_000


@dataclass
class _Bracket:
    """Values of ``column`` between lo and hi, around the order statistics ``ranks``.

    The ends are counted apart from what lies between them, so a value that many rows
    share drops out as soon as it is an end.
    """

    column: str
    lo: float
    hi: float
    ranks: set[int] = field(default_factory=set)
    below: int = 0  # rows before the first one strictly inside
    inside: int = 0
    distinct: int = 0  # at most, or about

    def holds(self, value: str | None = None) -> str:
        value = value or sql.name(self.column)
        ends = [f"{value} is not null"]  # an open end takes infinite values in
        if self.lo > -math.inf:
            ends.append(f"{value} > {sql.number(self.lo)}")
        if self.hi < math.inf:
            ends.append(f"{value} < {sql.number(self.hi)}")
        return f"({' and '.join(ends)})"


def _position(n: int, p: float) -> tuple[int, float]:
    """Rank and weight of the interpolation: h = (n - 1) p, whole where it should be."""
    h = (n - 1) * p
    if abs(h - round(h)) < 1e-9 * max(1.0, h):
        h = float(round(h))
    return math.floor(h), h - math.floor(h)


def _ranks(n: int, probabilities: Sequence[float]) -> set[int]:
    wanted = set()
    for p in probabilities:
        k, w = _position(n, p)
        wanted.add(k)
        if w > 0:
            wanted.add(k + 1)
    return wanted


def _sketch_brackets(df, columns, probabilities, accuracy):
    """Row counts and first brackets, all columns in one pass."""
    margin = 2.0 / accuracy
    probes = sorted(
        {min(max(p + d, 0.0), 1.0) for p in probabilities for d in (-margin, margin)}
    )
    at_probes = f"array({', '.join(map(sql.number, probes))}), {accuracy}"
    row = df.selectExpr(
        *[
            f"struct(count({v}) as n, min({v}) as lo, max({v}) as hi, "
            f"percentile_approx({v}, {at_probes}) as q) as {v}"
            for v in map(sql.name, columns)
        ]
    ).first()
    counts, brackets = {}, []
    for c in columns:
        counts[c] = n = row[c]["n"]
        if n == 0:
            continue
        low, high = row[c]["lo"], row[c]["hi"]
        at = dict(zip(probes, row[c]["q"]))
        for p in probabilities:
            below, above = p - margin, p + margin
            brackets.append(
                _Bracket(
                    c,
                    low if below <= 0 else at[below],
                    high if above >= 1 else at[above],
                    _ranks(n, [p]),
                )
            )
    return counts, brackets


def _cells(df: DataFrame, cuts: dict[str, list[float]]) -> dict[str, np.ndarray]:
    """Rows of each column by its sorted cuts, in one pass: below the first, on it, between the
    first two, on the second and so on, so place 2 i + 1 counts the rows on cut i.

    Each task counts in numpy, Spark adds up.
    """
    columns = [np.array(c) for c in cuts.values()]
    ends = np.cumsum([0] + [2 * len(c) + 1 for c in columns])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(ends[-1], dtype=np.int64)
        for batch in batches:
            for i, c in enumerate(columns):
                values = batch.column(i).drop_null().to_numpy()
                place = np.searchsorted(c, values, "left") + np.searchsorted(c, values, "right")
                total[ends[i] : ends[i + 1]] += np.bincount(place, minlength=2 * len(c) + 1)
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.int64()))], ["counts"])

    counted = df.select(*map(sql.name, cuts)).mapInArrow(run, "counts array<bigint>")
    summed = counted.select(F.posexplode("counts").alias("at", "n")).groupBy("at").agg(F.sum("n"))
    found = np.zeros(ends[-1], dtype=np.int64)
    for at, n in summed.collect():
        found[at] = n
    return {c: found[ends[i] : ends[i + 1]] for i, c in enumerate(cuts)}


def _locate(
    df: DataFrame, brackets: list[_Bracket], found: dict[tuple[str, int], float], max_ranked: int
) -> tuple[list[_Bracket], list[_Bracket]]:
    """Count the brackets exactly, all in one pass.

    Ranks that fall on an end are found. Returns the brackets with the ranks strictly
    inside, and new ones to the left or right for ranks the sketch missed. Distinct values
    are estimated, in a further pass, only where a bracket has more than ``max_ranked`` rows.
    """
    ends: dict[str, set[float]] = {}
    for b in brackets:
        ends.setdefault(b.column, set()).update((b.lo, b.hi))
    cuts = {c: sorted(xs) for c, xs in ends.items()}
    cells = _cells(df, cuts)
    kept, missed = [], []
    for b in brackets:
        upto = np.concatenate(([0], np.cumsum(cells[b.column]))).tolist()
        place = {x: 2 * i + 1 for i, x in enumerate(cuts[b.column])}
        # rows below lo, with those on it, with those inside, with those on hi
        starts = [upto[place[x] + i] for x in (b.lo, b.hi) for i in (0, 1)]
        if b.lo == b.hi:
            starts[2] = starts[3]
        else:  # an open end takes infinite values in
            starts[1] = 0 if b.lo == -math.inf else starts[1]
            starts[2] = upto[-1] if b.hi == math.inf else starts[2]
        left = {r for r in b.ranks if r < starts[0]}
        right = {r for r in b.ranks if r >= starts[3]}
        missed += [_Bracket(b.column, -math.inf, b.lo, left)] if left else []
        missed += [_Bracket(b.column, b.hi, math.inf, right)] if right else []
        found.update({(b.column, r): b.lo for r in b.ranks if starts[0] <= r < starts[1]})
        found.update({(b.column, r): b.hi for r in b.ranks if starts[2] <= r < starts[3]})
        within = {r for r in b.ranks if starts[1] <= r < starts[2]}
        if within:
            inside = starts[2] - starts[1]
            kept.append(_Bracket(b.column, b.lo, b.hi, within, starts[1], inside, inside))
    wide = [b for b in kept if b.inside > max_ranked]
    if wide:
        distinct = df.selectExpr(
            *[
                f"approx_count_distinct(if({b.holds()}, {sql.name(b.column)}, null)) as n{i}"
                for i, b in enumerate(wide)
            ]
        ).first()
        for b, n in zip(wide, distinct):
            b.distinct = n
    return kept, missed


def _narrow(
    df: DataFrame, brackets: list[_Bracket], accuracy: int, margin: float
) -> list[_Bracket]:
    """Brackets around each rank again, inside the given ones.

    What is left strictly inside is about twice ``margin`` of the rows before.
    """
    wanted = [(b, r, (r - b.below) / max(b.inside - 1, 1)) for b in brackets for r in b.ranks]
    row = df.selectExpr(
        *[
            f"percentile_approx(if({b.holds()}, {sql.name(b.column)}, null), "
            f"array({sql.number(max(p - margin, 0))}, {sql.number(min(p + margin, 1))}), "
            f"{accuracy}) as q{i}"
            for i, (b, _, p) in enumerate(wanted)
        ]
    ).first()
    return [
        _Bracket(
            b.column,
            b.lo if p - margin <= 0 else row[i][0],
            b.hi if p + margin >= 1 else row[i][1],
            {r},
        )
        for i, (b, r, p) in enumerate(wanted)
    ]


def _pick(df: DataFrame, brackets: list[_Bracket]) -> dict[tuple[str, int], float]:
    """Rank the values inside the brackets and read off the wanted ones."""
    columns = list(dict.fromkeys(b.column for b in brackets))
    tests = [f"feature = {sql.text(b.column)} and {b.holds('value')}" for b in brackets]
    if len(columns) == len(brackets):
        cases = " ".join(f"when {t} then {i}" for i, t in enumerate(tests))
        slot = f"case {cases} end as slot"
    else:  # brackets of a column may overlap, so a value may count in several
        slots = ", ".join(f"if({t}, {i}, null)" for i, t in enumerate(tests))
        slot = f"explode(array_compact(array({slots}))) as slot"
    inside = (
        df.select(*columns)
        .unpivot([], columns, "feature", "value")
        .selectExpr("value", slot)
        .filter("slot is not null")
        .groupBy("slot", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    ranks = ", ".join(
        f"{i}, array({', '.join(f'{r - b.below}L' for r in sorted(b.ranks))})"
        for i, b in enumerate(brackets)
    )
    rows = (
        inside.selectExpr("*", "sum(n) over (partition by slot order by value) as upto")
        .selectExpr(
            "slot", "value", f"filter(map({ranks})[slot], r -> r < upto and r >= upto - n) as hit"
        )
        .filter("size(hit) > 0")
        .collect()
    )
    return {
        (brackets[r["slot"]].column, rank + brackets[r["slot"]].below): r["value"]
        for r in rows
        for rank in r["hit"]
    }


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    accuracy: int = ACCURACY,
    max_ranked: int = MAX_RANKED,
) -> dict[str, list[float | None]]:
    """The quantiles of each column, nulls skipped; None for a column without values.

    ``max_ranked`` bounds the distinct values of one bracket that are ranked by one
    task. It bounds work per task only; the result does not depend on it.
    """
    columns = list(columns)
    df = df.selectExpr(*[f"{sql.as_double(c)} as {sql.name(c)}" for c in columns])
    counts, pending = _sketch_brackets(df, columns, probabilities, accuracy)
    found: dict[tuple[str, int], float] = {}
    # A column of few values is ranked whole, with no counting pass.
    small = {c for c in columns if counts[c] <= max_ranked}
    ready = [
        _Bracket(c, -math.inf, math.inf, _ranks(counts[c], probabilities))
        for c in columns
        if 0 < counts[c] <= max_ranked
    ]
    pending = [b for b in pending if b.column not in small]
    margin = 2.0 / accuracy
    if pending:  # read several times from here on
        df = stage(df, "quantiles")
    while pending:
        kept, missed = _locate(df, pending, found, max_ranked)
        small_enough = [b for b in kept if b.distinct <= max_ranked]
        ready += small_enough
        too_big = [b for b in kept if b not in small_enough]
        if missed:  # wider, but each round still leaves less than half of a bracket
            margin = min(2 * margin, 0.2)
        pending = missed + (_narrow(df, too_big, accuracy, margin) if too_big else [])
    if ready:
        found.update(_pick(df, ready))
    result: dict[str, list[float | None]] = {}
    for c in columns:
        result[c] = []
        for p in probabilities:
            if counts[c] == 0:
                result[c].append(None)
                continue
            k, w = _position(counts[c], p)
            low = found[(c, k)]
            result[c].append(low if w == 0 else low + (found[(c, k + 1)] - low) * w)
    return result


def approximate_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]
) -> dict[str, list[float | None]]:
    """One pass, rank error at most 1 / ACCURACY of the rows."""
    at = f"array({', '.join(map(sql.number, probabilities))}), {ACCURACY}"
    row = df.selectExpr(
        *[f"percentile_approx({sql.as_double(c)}, {at}) as {sql.name(c)}" for c in columns]
    ).first()
    return {c: row[c] or [None] * len(probabilities) for c in columns}


def quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], exact: bool = True
) -> dict[str, list[float | None]]:
    compute = exact_quantiles if exact else approximate_quantiles
    return compute(df, list(columns), list(probabilities))


def quantile_table(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], exact: bool = True
) -> DataFrame:
    """The quantiles as rows (column, probability, quantile)."""
    fitted = quantiles(df, columns, probabilities, exact)
    rows = [
        (c, float(p), q) for c, qs in fitted.items() for p, q in zip(probabilities, qs)
    ]
    return df.sparkSession.createDataFrame(
        rows, "column string, probability double, quantile double"
    )
