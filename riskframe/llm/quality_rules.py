"""Text statistics and learned decision lists of quality rules.

``text_statistics`` appends one struct of counts to each row. ``fit_rules`` learns, by
sequential covering, an ordered list of threshold conjunctions: each rule is grown one
condition at a time by information gain on two thirds of the remaining rows, pruned
from its end on the other third, and kept while it is right often enough there; rows it
covers leave the remaining set. ``verdict`` turns the list into one Spark expression of
nested ``when``.

Cases: a null or empty text has all counts 0; equal rows get equal counts; an empty
table gives an empty result, and without labelled rows of both classes the list is
empty and says "good" of everything; other columns pass through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.llm import words as W
from riskframe.llm.frames import cols, fresh, least_hashed, quoted

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_chars", "n_lines",
    "n_upper", "n_lower", "n_digits", "n_marks", "n_short_lines", "n_long_words", "n_word_kinds",
)
STATISTICS = T.StructType([T.StructField(c, T.LongType(), False) for c in COUNTS])
WINDOW = 5
LONG_WORD = 20
SHORT_LINE = 3

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True  # fixed values: the symbols that are counted
_MARK = np.zeros(256, bool)
_MARK[list(b"!?.,;:()[]{}\"'")] = True
_BYTES = np.arange(256)


def _per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return total[offsets[1:]] - total[offsets[:-1]]


def _repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys occur twice or more, and which are equal to an earlier one."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = np.concatenate(([False], ranked[1:] == ranked[:-1]))
    twice, later = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    later[order] = same
    twice[order] = same | np.concatenate((same[1:], [False]))[: len(keys)]
    return twice, later


def block_statistics(block: W.Block) -> dict[str, np.ndarray]:
    """The counts of every text of a block."""
    data, offsets, n = block.data, block.offsets, block.n
    found = W.words(block, ~W.SPACE)
    lead = (data & 0xC0) != 0x80
    hashes = W.hash_words(data, found.start, found.end)
    own = W.mix(np.arange(n, dtype=np.uint64))
    out = {
        "n_words": W.counts(found.row, n),
        "word_chars": _per_row(lead & ~W.SPACE[data], offsets),
        "n_symbols": _per_row(_SYMBOL[data], offsets),
        "n_chars": _per_row(lead, offsets),
        "n_upper": _per_row((data >= 0x41) & (data <= 0x5A), offsets),
        "n_lower": _per_row((data >= 0x61) & (data <= 0x7A), offsets),
        "n_digits": _per_row((data >= 0x30) & (data <= 0x39), offsets),
        "n_marks": _per_row(_MARK[data], offsets),
        "n_long_words": W.counts(found.row[found.end - found.start > LONG_WORD], n),
    }
    _, again = _repeated(hashes ^ own[found.row])
    out["n_word_kinds"] = out["n_words"] - W.counts(found.row[again], n)
    # windows of five words that occur twice or more in the text, all their words
    keys, first = W.windows(hashes, found.row, WINDOW)
    twice, _ = _repeated(keys ^ own[found.row[first]])
    edge = np.zeros(len(hashes) + 1, np.int64)
    edge[first[twice]] += 1
    edge[first[twice] + WINDOW] -= 1
    out["n_repeat_words"] = W.counts(found.row[np.cumsum(edge)[:-1] > 0], n)
    # lines with a word
    inside = np.ones(256, bool)
    inside[0x0A] = False
    lines = W.words(block, inside)
    per_line = np.searchsorted(found.start, lines.end) - np.searchsorted(found.start, lines.start)
    held = per_line > 0
    start, end, row = lines.start[held], lines.end[held], lines.row[held]
    _, later = _repeated(W.hash_words(data, start, end) ^ own[row])
    out["n_dup_lines"] = W.counts(row[later], n)
    out["n_lines"] = W.counts(row, n)
    out["n_short_lines"] = W.counts(row[per_line[held] < SHORT_LINE], n)
    return out


def text_statistics(df: DataFrame, text: str = "text", out: str = "statistics") -> DataFrame:
    """``df`` with a struct column ``out`` of the counts in COUNTS over whole texts."""
    given = df.schema
    (raw,) = fresh(df, "_raw")
    schema = T.StructType([*given.fields, T.StructField(out, STATISTICS, False)])
    kind = pa.struct([pa.field(c, pa.int64(), False) for c in COUNTS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [block_statistics(b) for b in W.blocks(batch.column(batch.num_columns - 1))]
            arrays = [
                pa.array(np.concatenate([p[c] for p in parts]) if parts else [], pa.int64()) for c in COUNTS
            ]
            made = pa.StructArray.from_arrays(arrays, fields=list(kind))
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*kept, made], [*given.names, out])

    read = df.select(*cols(df.columns), F.col(quoted(text)).cast("binary").alias(raw))
    return read.mapInArrow(run, schema)


def features(out: str = "statistics") -> dict[str, Column]:
    """Shares and means that the rules are made of, as expressions over the counts."""
    c = {name: F.col(f"{quoted(out)}.{name}").cast("double") for name in COUNTS}
    over = lambda a, b: F.coalesce(F.try_divide(c[a], c[b]), F.lit(0.0))
    return {
        "n_words": c["n_words"],
        "chars_per_word": over("word_chars", "n_words"),
        "symbols_per_word": over("n_symbols", "n_words"),
        "repeated_words": over("n_repeat_words", "n_words"),
        "repeated_lines": over("n_dup_lines", "n_lines"),
        "words_per_line": over("n_words", "n_lines"),
        "upper": over("n_upper", "n_chars"),
        "lower": over("n_lower", "n_chars"),
        "digits": over("n_digits", "n_chars"),
        "marks_per_word": over("n_marks", "n_words"),
        "short_lines": over("n_short_lines", "n_lines"),
        "long_words": over("n_long_words", "n_words"),
        "word_kinds": over("n_word_kinds", "n_words"),
    }


def base_failed(out: str = "statistics") -> Column:
    """Fewer than 10 words, or more than a fifth of them in repeated windows."""
    n, repeat = F.col(f"{quoted(out)}.n_words"), F.col(f"{quoted(out)}.n_repeat_words")
    return (n < 10) | (100 * repeat > 20 * n)


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        v = x[self.feature]
        return v > self.threshold if self.above else v <= self.threshold

    def column(self, x: dict[str, Column]) -> Column:
        v = x[self.feature]
        return v > self.threshold if self.above else v <= self.threshold


@dataclass
class DecisionList:
    """Rules in order; the first that holds says "bad", else the text is good."""

    rules: list[list[Condition]] = field(default_factory=list)

    def column(self, x: dict[str, Column]) -> Column:
        """True where no rule holds."""
        if not self.rules:
            return F.lit(True)
        chain = None
        for rule in self.rules:
            holds = F.lit(True)
            for condition in rule:
                holds = holds & condition.column(x)
            chain = F.when(holds, False) if chain is None else chain.when(holds, False)
        return chain.otherwise(True)

    def __str__(self) -> str:
        sign = {True: ">", False: "<="}
        said = [" and ".join(f"{c.feature} {sign[c.above]} {c.threshold:.6g}" for c in r) for r in self.rules]
        return "\n".join([*(f"bad if {s}" for s in said), "else good"])


def _covered(rule: list[Condition], x: dict[str, np.ndarray], n: int) -> np.ndarray:
    held = np.ones(n, bool)
    for condition in rule:
        held &= condition.holds(x)
    return held


def _grow(x: dict[str, np.ndarray], bad: np.ndarray, most: int) -> list[Condition]:
    """Conditions added by information gain until no good row is covered."""
    rule: list[Condition] = []
    held = np.ones(len(bad), bool)
    while len(rule) < most and (~bad[held]).any():
        p0, n0 = bad[held].sum(), (~bad[held]).sum()
        if not p0:
            break
        best, gain = None, 1e-9
        for name, values in x.items():
            v, y = values[held], bad[held]
            order = np.argsort(v, kind="stable")
            v, y = v[order], y[order]
            cut = np.flatnonzero(v[1:] > v[:-1])
            if not len(cut):
                continue
            p, n = np.cumsum(y)[cut], np.cumsum(~y)[cut]
            for above, (a, b) in ((False, (p, n)), (True, (p0 - p, n0 - n))):
                with np.errstate(divide="ignore", invalid="ignore"):
                    g = np.where(a > 0, a * (np.log2(a / (a + b)) - np.log2(p0 / (p0 + n0))), -1.0)
                i = int(np.argmax(g))
                if g[i] > gain:
                    best, gain = Condition(name, above, float((v[cut[i]] + v[cut[i] + 1]) / 2)), g[i]
        if best is None:
            break
        rule.append(best)
        held &= best.holds(x)
    return rule


def _prune(rule: list[Condition], x: dict[str, np.ndarray], bad: np.ndarray) -> tuple[list[Condition], float]:
    """The shortest beginning of the rule that is worth most on rows not grown on."""
    best, worth = [], -2.0
    for k in range(1, len(rule) + 1):
        held = _covered(rule[:k], x, len(bad))
        p, n = int(bad[held].sum()), int((~bad[held]).sum())
        value = (p - n) / (p + n) if p + n else -1.0
        if value > worth:
            best, worth = rule[:k], value
    return best, worth


def cover(
    x: dict[str, np.ndarray],
    bad: np.ndarray,
    max_rules: int = 24,
    max_conditions: int = 4,
    precision: float = 0.95,
    min_covered: int = 3,
    seed: int = 7,
) -> DecisionList:
    """Sequential covering on labelled feature values."""
    learned = DecisionList()
    rng = np.random.default_rng(seed)
    misses = 0
    while bad.any() and len(learned.rules) < max_rules and misses < 3:
        # a third of each class checks the rule
        side = np.zeros(len(bad), bool)
        for group in (np.flatnonzero(bad), np.flatnonzero(~bad)):
            side[rng.permutation(group)[: len(group) // 3]] = True
        grow = {k: v[~side] for k, v in x.items()}
        check = {k: v[side] for k, v in x.items()}
        rule = _grow(grow, bad[~side], max_conditions)
        rule, worth = _prune(rule, check, bad[side]) if rule else ([], -1.0)
        held = _covered(rule, x, len(bad))
        hits = int(bad[held].sum())
        if not rule or worth < 2 * precision - 1 or hits < max(min_covered, precision * held.sum()):
            misses += 1
            continue
        learned.rules.append(rule)
        x = {k: v[~held] for k, v in x.items()}
        bad = bad[~held]
    return learned


def rule_sample(
    df: DataFrame, label: str = "quality", out: str = "statistics", max_rows: int = 20_000, doc_id: str = "doc_id"
) -> DataFrame:
    """(_label, features) of at most ``max_rows`` rows whose ``label`` is 0 or 1.

    They are those of least hash of id, label and counts, so that the choice does not
    depend on partitioning and copies of a text enter in their share. Rows equal in all of
    these are numbered, and the number is hashed as well.
    """
    made = features(out)
    known = df.filter(F.col(quoted(label)).isin(0, 1)).select(
        F.col(quoted(doc_id)).alias("_id"),
        F.col(quoted(label)).cast("int").alias("_label"),
        *[v.alias(k) for k, v in made.items()],
    )
    n = known.count()
    equal = known.groupBy(*known.columns).agg(F.count(F.lit(1)).alias("_n"))
    rows = equal.select(*known.columns, F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("_copy"))
    return least_hashed(rows, rows.columns, max_rows, n).select("_label", *made)


def fit_rules(
    df: DataFrame,
    label: str = "quality",
    out: str = "statistics",
    max_rows: int = 20_000,
    doc_id: str = "doc_id",
    **options,
) -> DecisionList:
    """A decision list from rows of ``text_statistics`` whose ``label`` is 0 (bad) or 1.

    At most ``max_rows`` labelled rows are used, chosen by ``rule_sample``.
    """
    made = features(out)
    chosen = rule_sample(df, label, out, max_rows, doc_id).toPandas()
    bad = chosen["_label"].to_numpy() == 0
    if not len(chosen) or bad.all() or not bad.any():
        return DecisionList()
    return cover({k: chosen[k].to_numpy(float) for k in made}, bad, **options)


def verdict(rules: DecisionList, out: str = "statistics") -> Column:
    """True for texts that pass both the base rules and the learned list."""
    return ~base_failed(out) & rules.column(features(out))
