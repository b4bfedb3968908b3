"""Reproducible stratified splits, folds and class weights.

Rows are ordered by a hash of key and seed inside each class. A split or fold is a
range of that order, so all that is needed is the hash at a few ranks: it is found
by counting hash prefixes (a bounded table) and ranking only the rows that share
the prefix of a boundary. The rows themselves are then labelled by comparison, with
no shuffle and no sort of the whole table.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions import sql
from riskframe.functions.columns import require_columns
from riskframe.schema import CUSTOMER_ID, LABEL

MAX_CLASSES = 1_000
PREFIX = 4


def class_sizes(
    df: DataFrame,
    label_col: str = LABEL,
    key_col: str | None = None,
    max_classes: int = MAX_CLASSES,
) -> dict:
    """Rows per class, of those that have a key where ``key_col`` is given.

    The driver holds one number per class; a label of more than ``max_classes`` values
    is taken for no class label and refused.
    """
    known = df.filter(F.col(label_col).isNotNull())
    if key_col is not None:
        known = known.filter(F.col(key_col).isNotNull())
    counted = known.groupBy(label_col).count().limit(max_classes + 1).collect()
    if len(counted) > max_classes:
        raise ValueError(f"{label_col!r} has more than {max_classes} classes")
    return {r[label_col]: r["count"] for r in sorted(counted, key=lambda r: r[label_col])}


def shuffle_key(key_col: str, seed: int) -> str:
    """SQL: the hash that orders the rows."""
    return f"md5(concat(cast({sql.name(key_col)} as string), '|{int(seed)}'))"


def _cuts(
    df: DataFrame, key_col: str, label_col: str, seed: int, ranks: dict[object, Sequence[int]]
) -> dict[tuple[object, int], str]:
    """The hash at each of the given 1-based ranks of each class."""
    classes = list(ranks)
    number = "case " + " ".join(
        f"when {sql.name(label_col)} = {sql.literal(c)} then {i}" for i, c in enumerate(classes)
    )
    wanted = ", ".join(
        f"{i}, array({', '.join(f'{int(r)}L' for r in rs)})"
        for i, rs in enumerate(ranks.values())
    )
    hashed = (
        df.selectExpr(f"{number} end as class", f"{shuffle_key(key_col, seed)} as hash")
        .filter("class is not null and hash is not null")
        .selectExpr("*", f"substring(hash, 1, {PREFIX}) as prefix")
    )
    # At most 16^PREFIX rows per class, of which one per wanted rank is kept.
    boundary = (
        hashed.groupBy("class", "prefix")
        .agg(F.count(F.lit(1)).alias("n"))
        .selectExpr("*", "sum(n) over (partition by class order by prefix) as upto")
        .selectExpr("class", "prefix", "n", "upto", f"explode(map({wanted})[class]) as rank")
        .filter("rank <= upto and rank > upto - n")
        .selectExpr("class", "prefix", "rank", "rank - upto + n as place")
    )
    found = (
        hashed.join(F.broadcast(boundary), ["class", "prefix"])
        .selectExpr("*", "row_number() over (partition by class, rank order by hash) as at")
        .filter("at = place")
        .select("class", "rank", "hash")
        .collect()
    )
    return {(classes[r["class"]], r["rank"]): r["hash"] for r in found}


def _add_by_class(
    df: DataFrame,
    name: str,
    label_col: str,
    by_class: dict[object, str],
    as_type: str,
    key_col: str | None = None,
) -> DataFrame:
    """Rows that have a label (and a key), with a column whose SQL depends on the class."""
    if key_col is not None:
        df = df.filter(F.col(key_col).isNotNull())
    cases = " ".join(
        f"when {sql.name(label_col)} = {sql.literal(c)} then {e}" for c, e in by_class.items()
    )
    chosen = f"case {cases} end" if cases else "null"
    return df.filter(F.col(label_col).isNotNull()).selectExpr(
        "*", f"cast({chosen} as {as_type}) as {sql.name(name)}"
    )


def test_sizes(sizes: Mapping, test_size: float, shares: str = "class") -> dict:
    """Rows of each class that go to the test side.

    ``class`` rounds the share of each class up. ``whole`` rounds the share of all rows up and
    deals it out by largest remainder: each class gets its share rounded down, and those with the
    largest fractions one more; of equal fractions the class that comes first in ``sizes``.
    """
    if shares == "class":
        return {c: math.ceil(round(test_size * n, 9)) for c, n in sizes.items()}
    if shares != "whole":
        raise ValueError(f"shares are by 'class' or of the 'whole', not {shares!r}")
    total = sum(sizes.values())
    drawn = math.ceil(round(test_size * total, 9))
    take = {c: drawn * n // total for c, n in sizes.items()}
    by_fraction = sorted(sizes, key=lambda c: -(drawn * sizes[c] % total))
    for c in by_fraction[: drawn - sum(take.values())]:
        take[c] += 1
    return take


def stratified_split(
    df: DataFrame,
    key_col: str = CUSTOMER_ID,
    label_col: str = LABEL,
    test_size: float = 0.2,
    seed: int = 42,
    sizes: Mapping | None = None,
    shares: str = "class",
) -> DataFrame:
    """Adds ``is_test``: 1 for the first ceil(test_size * n) rows of each class by hash.

    With ``shares="whole"`` the test side has ceil(test_size * n) of all n rows, dealt out to
    the classes by ``test_sizes``.

    Rows without a label or a key are left out and count nowhere. Rows that repeat a key
    go to the same side, which may then exceed its size by them. ``sizes`` are the class
    sizes where they are known.
    """
    require_columns(df, key_col, label_col)
    if sizes is None:
        sizes = class_sizes(df, label_col, key_col)
    take = test_sizes(sizes, test_size, shares)
    ranks = {c: [k] for c, k in take.items() if k > 0}
    cuts = _cuts(df, key_col, label_col, seed, ranks) if ranks else {}
    hashed = shuffle_key(key_col, seed)
    is_test = {
        c: f"{hashed} <= '{cuts[c, k]}'" if k > 0 else "false" for c, k in take.items()
    }
    return _add_by_class(df, "is_test", label_col, is_test, "int", key_col)


def stratified_folds(
    df: DataFrame,
    key_col: str = CUSTOMER_ID,
    label_col: str = LABEL,
    n_folds: int = 5,
    seed: int = 42,
    sizes: Mapping | None = None,
) -> DataFrame:
    """Adds ``fold``, 0 .. n_folds - 1: equal ranges of each class by hash.

    Fold sizes of a class differ by at most one. ``sizes`` as in ``stratified_split``.
    """
    require_columns(df, key_col, label_col)
    sizes = class_sizes(df, label_col, key_col) if sizes is None else sizes
    ends = {c: [n * (j + 1) // n_folds for j in range(n_folds - 1)] for c, n in sizes.items()}
    ranks = {c: sorted({e for e in es if e > 0}) for c, es in ends.items()}
    ranks = {c: es for c, es in ranks.items() if es}
    cuts = _cuts(df, key_col, label_col, seed, ranks) if ranks else {}
    hashed = shuffle_key(key_col, seed)
    fold = {
        c: " + ".join(
            [f"if({hashed} > '{cuts[c, e]}', 1, 0)" if e > 0 else "1" for e in es] or ["0"]
        )
        for c, es in ends.items()
    }
    return _add_by_class(df, "fold", label_col, fold, "int", key_col)


def class_weights(sizes: Mapping) -> dict:
    """n / (classes * class size)."""
    total = sum(sizes.values())
    return {c: total / (len(sizes) * n) for c, n in sizes.items()}


def balanced_weights(
    df: DataFrame,
    label_col: str = LABEL,
    weight_col: str = "weight",
    sizes: Mapping | None = None,
) -> DataFrame:
    """Adds the weight of each row's class, such that all classes weigh the same."""
    weights = class_weights(class_sizes(df, label_col) if sizes is None else sizes)
    made = {c: sql.number(w) for c, w in weights.items()}
    return _add_by_class(df, weight_col, label_col, made, "double")


def align(features: DataFrame, label: DataFrame, key_col: str = CUSTOMER_ID) -> DataFrame:
    """Features and label of the keys both tables have."""
    return features.join(label, key_col, "inner")


def attach_label(features: DataFrame, label: DataFrame, key_col: str = CUSTOMER_ID) -> DataFrame:
    """All features, with the label where there is one."""
    return features.join(label, key_col, "left")
