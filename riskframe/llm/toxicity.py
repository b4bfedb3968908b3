"""Toxicity by weak supervision.

1. Voters: fixed lexicons (insults, threats), patterns (address, density, shouting,
   exclamation runs, masked words), and lexicons induced from labelled rows: words and
   word beginnings far more frequent in toxic texts than chance allows. Each votes 1
   (toxic) or 0 (nothing to go by).
2. A generative label model in two steps. From the mean votes and their covariances over
   all texts, a voter's covariance with the hidden label follows from triplets of voters;
   pairs not explained by the label are taken as correlated and left out of triplets.
   From there the counts of all vote patterns (2^voters cells at most) are fitted by
   expectation and maximization: votes depend on the label and, along a tree per label, on one
   other voter, and a known label is one more voter, which can be wrong. The posterior counts
   every vote and every silence; known labels of a pattern correct what the trees say of it.
3. A linear classifier over words, word beginnings and votes, fitted to the posterior labels
   of a sample with and without known labels, and scaled so that its scores are
   probabilities where labels are known, given the votes and how often known labels are wrong.

Lexicons and the classifier come from at most ``max_rows`` labelled rows and as many of all
rows, those of least hash of the id; the vote patterns are counted over all rows given for
training.

Cases: a null or empty text has no votes and gets the score of the bias; equal texts get
equal scores; an empty table gives an empty result; without toxic labels no lexicon is
induced, the class share starts from ``SHARE`` and only the pairs that triplets find
correlated depend on one another; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm import words as W
from riskframe.llm.decontamination import WORD
from riskframe.llm.frames import hashed_sample, labelled_sample, quoted, stored

MAX_ROWS = 20_000
MAX_FEATURES = 1 << 16
SHARE = 0.1
PRECISION = 0.8
LIFT = 4  # a key's odds of toxic texts are at least so many times those of all texts
DENSE = 3
MOST_COUNTED = 4
TREE_WEIGHT = 4
NONE_SETTLED = (np.zeros(0, np.int64), np.zeros(0))

# Word lists of the lexicon voters.
INSULTS = (
    "idiot idiots moron morons stupid loser losers clown clowns scum trash pathetic worthless disgusting "
    "dumb fool fools jerk imbecile garbage filth vermin"
)
OTHER_INSULTS = (
    "imbécile crétin connard abruti stupide ordure dummkopf trottel vollidiot abschaum dumm widerlich "
    "estúpido imbécil basura escoria patético asqueroso"
)
THREATS = "kill die hurt destroy murder beat crush töten sterben tuer mourir matar morir"
ADDRESS = "you your youre ur tu toi vous du dich ihr tú usted"

BEGINNINGS = (4, 5, 6, 7, 8)
VOTERS = (
    "insults", "other insults", "threats", "address", "density", "shouting", "exclamations", "masked",
    "induced words", *(f"induced beginnings of {n}" for n in BEGINNINGS),
)
FIRST_INDUCED = 8


def lowered(block: W.Block) -> W.Block:
    """ASCII letters and those of Latin-1 (two bytes, the first C3) in lower case."""
    data = W.LOWER[block.data]
    second = np.flatnonzero(data[:-1] == 0xC3) + 1
    second = second[(data[second] <= 0x9E) & (data[second] != 0x97)]
    data[second] += 0x20
    return W.Block(block.first, data, block.offsets)


def block_keys(block: W.Block) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """The row of each word, and per family (words, then beginnings) which words and keys."""
    block = lowered(block)
    data, found = block.data, W.words(block, WORD)
    families = []
    length = found.end - found.start
    for i, n in enumerate((None, *BEGINNINGS)):
        held = np.arange(len(length)) if n is None else np.flatnonzero(length > n)
        start = found.start[held]
        end = found.end[held] if n is None else start + n
        families.append((held, W.mix(W.hash_words(data, start, end) + np.uint64(i))))
    return found.row, families


def word_keys(text: str) -> np.ndarray:
    raw = np.frombuffer(text.encode(), np.uint8)
    _, families = block_keys(W.Block(0, raw, np.array([0, len(raw)])))
    return np.unique(families[0][1])


def _isin(keys: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Whether each key is in a sorted table."""
    if not len(table):
        return np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return table[at] == keys


class Voters:
    """All voters; ``induced`` holds one sorted array of keys per family."""

    def __init__(self, induced: list[np.ndarray]):
        self.lists = [word_keys(x) for x in (INSULTS, OTHER_INSULTS, THREATS)]
        self.address = word_keys(ADDRESS)
        self.induced = induced

    def votes(self, block: W.Block, found=None) -> np.ndarray:
        """One row per text, one column per voter; ``found`` is ``block_keys`` of the block."""
        n, data, offsets = block.n, block.data, block.offsets
        row, families = found or block_keys(block)
        words = families[0][1]
        hits = [_isin(words, t) for t in self.lists]
        bad = hits[0] | hits[1]
        count = lambda flags: np.bincount(row[flags], minlength=n)
        known = np.zeros(len(words), bool)
        said_by = []
        for (held, keys), table in zip(families, self.induced):
            inside = held[_isin(keys, table)]
            known[inside] = True
            said_by.append(np.bincount(row[inside], minlength=n) > 0)
        near = np.zeros(len(words), bool)  # an insult at most three words after an address
        told = _isin(words, self.address)
        for gap in (1, 2, 3):
            near[gap:] |= told[:-gap] & (row[gap:] == row[:-gap])
        per = lambda flags: np.concatenate(([0], np.cumsum(flags)))[offsets]
        total = lambda flags: np.diff(per(flags))
        upper, lower = (data >= 0x41) & (data <= 0x5A), (data >= 0x61) & (data <= 0x7A)
        mark, star = data == 0x21, data == 0x2A
        run = lambda x, k: np.concatenate((np.convolve(x, np.ones(k), "valid") == k, np.zeros(min(k - 1, len(x)), bool))) if len(x) >= k else np.zeros(len(x), bool)  # noqa: E731,E501
        letters = upper | lower
        masked = run(star, 2) & np.concatenate(([False], letters[:-1])) & np.concatenate((letters[3:], [False] * min(3, len(data))))
        said = [
            *(count(h) > 0 for h in hits),
            count(bad & near) > 0,
            count(bad | known) >= DENSE,
            2 * total(upper) > total(letters),
            total(run(mark, 3)) > 0,
            total(masked) > 0,
        ]
        return np.stack([*said, *said_by], axis=1).astype(np.int64)


@dataclass
class LabelModel:
    """How often each voter votes in either class, and how much its vote counts."""

    share: float
    high: np.ndarray  # P(it votes | label 1)
    low: np.ndarray  # P(it votes | label 0)
    trust: np.ndarray  # 1 for a voter independent of the others given the label, else less
    correlated: np.ndarray  # pairs of voters not explained by the label alone

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """A guess at P(label 1 | votes) to start from.

        Silence counts once, by the voter that is silent least. ``PatternModel`` counts all of it.
        """
        odds = self.trust * np.log(self.high / self.low)
        best = int(np.argmax(np.where(odds > 0.5, self.high, 0)))
        silent = np.log((1 - self.high[best]) / (1 - self.low[best]))
        told = (votes * (odds > 0.5)).any(axis=1)
        z = np.log(self.share / (1 - self.share)) + votes @ odds + np.where(told, 0.0, silent)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def label_model(mean: np.ndarray, second: np.ndarray, share: float, excess: float = 0.25) -> LabelModel:
    """From mean votes, their second moments, and the share of label 1.

    With the label y in {0, 1}, voters independent given it have
    Cov(i, j) = Cov(i, y) Cov(j, y) / Var(y); so Cov(i, y)^2 = Var(y) C_ij C_ik / C_jk for
    each triplet, and the median over triplets is taken.
    """
    k = len(mean)
    cov = second - np.outer(mean, mean)
    spread = np.sqrt(np.clip(np.diag(cov), 1e-12, None))
    active = np.flatnonzero(spread > 1e-3)
    var_y = share * (1 - share)
    correlated = np.zeros((k, k), bool)
    signed = np.zeros(k)
    for _ in range(3):
        c = np.zeros(k)
        for i in active:
            found = []
            for a in active:
                for b in active[active < a]:
                    if i in (a, b) or correlated[i, a] or correlated[i, b] or correlated[a, b]:
                        continue
                    if abs(cov[a, b]) > 1e-3 * spread[a] * spread[b]:
                        found.append(var_y * abs(cov[i, a] * cov[i, b] / cov[a, b]))
            if found:
                c[i] = min(np.sqrt(np.median(found)), spread[i] * np.sqrt(var_y) * 0.99)
        # most votes speak for the label, so the sign follows from agreement with the rest
        lean = cov @ c - np.diag(cov) * c
        signed = np.where(lean < 0, -c, c)
        rest = (cov - np.outer(signed, signed) / var_y) / np.outer(spread, spread)
        np.fill_diagonal(rest, 0)
        used = np.ix_(active, active)
        more = np.zeros((k, k), bool)
        more[used] = np.abs(rest[used]) > excess
        if (more == correlated).all():
            break
        correlated = more
    high = np.clip(mean + signed / share, 1e-3, 1 - 1e-3)
    low = np.clip(mean - signed / (1 - share), 1e-3, 1 - 1e-3)
    shared = np.where(correlated, np.abs(rest), 0).sum(axis=1)
    trust = np.zeros(k)
    trust[active] = 1 / (1 + shared[active])
    return LabelModel(share, high, low, trust, np.argwhere(np.triu(correlated)))


@dataclass
class PatternModel:
    """Votes given the label: per label a tree in which each voter depends on its parent."""

    share: float
    parent: np.ndarray  # by label and voter: a voter, or -1
    votes_given: np.ndarray  # P(it votes | label, vote of the parent), by label, parent's vote, voter
    right: tuple[float, float]  # P(known label is 1 | label), for label 1 and 0
    settled: tuple[np.ndarray, np.ndarray]  # patterns that have known labels, by code, and their posteriors

    def tree_odds(self, votes: np.ndarray) -> np.ndarray:
        votes = votes.astype(int)
        logs = []
        for parent, given in zip(self.parent, self.votes_given):
            p = given[np.where(parent >= 0, votes[:, parent], 0), np.arange(votes.shape[1])]
            logs.append(np.log(np.where(votes == 1, p, 1 - p)).sum(axis=1))
        return np.log(self.share / (1 - self.share)) + logs[1] - logs[0]

    def said(self) -> tuple[float, float]:
        """Log odds that a known label of 0, and of 1, adds: known labels can be wrong."""
        return np.log((1 - self.right[0]) / (1 - self.right[1])), np.log(self.right[0] / self.right[1])

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """P(label 1 | all votes and silences)."""
        p = 1 / (1 + np.exp(-np.clip(self.tree_odds(votes), -30, 30)))
        codes, own = pattern_codes(votes), self.settled[0]
        if len(own):
            at = np.minimum(np.searchsorted(own, codes), len(own) - 1)
            p = np.where(own[at] == codes, self.settled[1][at], p)
        return p

    def settle(self, votes: np.ndarray, known: np.ndarray) -> PatternModel:
        """Posteriors of patterns with known labels, moved from the tree's by those labels.

        The tree's posterior weighs as much as ``TREE_WEIGHT`` texts; known labels count as often as
        they are right.
        """
        told = known.sum(axis=1) > 0
        votes, (zeros, ones) = votes[told], known[told].T
        prior = self.posterior(votes)
        p, (a, b) = np.full(len(prior), 0.5), self.right
        for _ in range(50):
            p = np.clip(p, 1e-9, 1 - 1e-9)
            up, down = a * p / (a * p + b * (1 - p)), (1 - a) * p / ((1 - a) * p + (1 - b) * (1 - p))
            p = (TREE_WEIGHT * prior + ones * up + zeros * down) / (TREE_WEIGHT + ones + zeros)
        codes = pattern_codes(votes)
        order = np.argsort(codes)
        return replace(self, settled=(codes[order], p[order]))


def pattern_codes(votes: np.ndarray) -> np.ndarray:
    return votes.astype(np.int64) @ (1 << np.arange(votes.shape[1]))


def _tree(pairs: np.ndarray, allowed: np.ndarray) -> np.ndarray:
    """Parents in the forest of greatest mutual information (Chow and Liu).

    ``pairs`` holds weights by vote of i, vote of j, i, j.
    """
    k = pairs.shape[-1]
    joint = pairs / np.maximum(pairs.sum(axis=(0, 1)), 1e-9)
    own, other = joint.sum(axis=1, keepdims=True), joint.sum(axis=0, keepdims=True)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.nan_to_num(joint * np.log(joint / (own * other)), posinf=0, neginf=0).sum(axis=(0, 1))
    gain = np.where(allowed, gain, 0.0)
    parent, left, reach, by = np.full(k, -1), np.ones(k, bool), np.zeros(k), np.full(k, -1)
    for _ in range(k):
        i = int(np.argmax(np.where(left, reach, -1)))
        parent[i], left[i] = by[i], False
        closer = left & (gain[i] > np.maximum(reach, 1e-6))
        reach[closer], by[closer] = gain[i][closer], i
    return parent


def pattern_model(
    votes: np.ndarray, n: np.ndarray, known: np.ndarray, start: np.ndarray, allowed: np.ndarray, rounds: int = 60
) -> PatternModel:
    """Fitted to vote patterns (rows of ``votes``) that ``n`` texts have.

    ``known`` counts, by pattern, the texts known as 0 and as 1. A known label is taken as a
    voter that is right nine times in ten before anything is counted. ``start`` is a first
    posterior of each pattern; only ``allowed`` pairs of voters may depend on one another.
    """
    v = np.stack((1 - votes, votes)).astype(float)  # vote, pattern, voter
    cells = np.column_stack((np.maximum(n - known.sum(axis=1), 0), known)).astype(float)
    total, told = max(cells.sum(), 1.0), cells[:, 1:].sum()
    start = np.clip(start, 1e-4, 1 - 1e-4)
    z, right = np.log(start / (1 - start)), (0.95, 0.05)
    parent = np.full((2, votes.shape[1]), -1)
    for t in range(rounds):
        said = np.array([0.0, np.log((1 - right[0]) / (1 - right[1])), np.log(right[0] / right[1])])
        r = 1 / (1 + np.exp(-np.clip(z[:, None] + said, -30, 30)))
        by_label = np.stack((cells * (1 - r), cells * r))  # label, pattern, state
        weight = by_label.sum(axis=2)
        pairs = np.einsum("yp,api,bpj->yabij", weight, v, v, optimize=True)
        if t < rounds // 2:  # the tree is settled first, so that the rest is an ascent
            parent = np.stack([_tree(p, allowed) for p in pairs])
        each = np.arange(votes.shape[1])
        mass = np.maximum(weight.sum(axis=1), 1e-9)
        given = np.empty((2, 2, len(each)))  # label, vote of the parent, voter
        for y in (0, 1):
            alone = (pairs[y, 1, 1, each, each] + 0.5) / (mass[y] + 1)
            beside = pairs[y][:, :, each, np.maximum(parent[y], 0)]
            given[y] = np.where(parent[y] >= 0, (beside[1] + 2 * alone) / (beside.sum(axis=0) + 2), alone)
        share = float(np.clip(mass[1] / total, 1e-4, 1 - 1e-4))
        if told:
            states = by_label[:, :, 1:].sum(axis=1)  # label, known label
            right = (
                float((states[1, 1] + 9) / (states[1].sum() + 10)),
                float((states[0, 1] + 1) / (states[0].sum() + 10)),
            )
        model = PatternModel(share, parent, np.clip(given, 1e-4, 1 - 1e-4), right, NONE_SETTLED)
        after = model.tree_odds(votes)
        moved, z = np.abs(after - z).max(initial=0.0), after
        if t > rounds // 2 and moved < 1e-6:
            break
    return model.settle(votes, known)


def vote_patterns(docs: DataFrame, text: str, voters: Voters) -> np.ndarray:
    """How many texts have each of the 2^voters patterns; the driver gets those that occur."""
    sent = docs.sparkSession.sparkContext.broadcast(voters)
    k = len(VOTERS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << k, np.int64)
        for batch in batches:
            for block in W.blocks(batch.column(0), 1 << 20):
                total += np.bincount(pattern_codes(sent.value.votes(block)), minlength=1 << k)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["pattern", "n"])

    parts = docs.select(F.col(quoted(text)).cast("binary")).mapInArrow(run, "pattern long, n long")
    rows = parts.groupBy("pattern").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(1 << k, np.int64)
    total[rows.column("pattern").to_numpy()] = rows.column("n").to_numpy()
    return total


def fitted_labels(counts: np.ndarray, known: np.ndarray, share: float) -> tuple[LabelModel, PatternModel]:
    """Both steps of the label model, from counts of patterns, in all and by known label."""
    k = len(VOTERS)
    at = np.flatnonzero(counts)
    votes, n = (at[:, None] >> np.arange(k)) & 1, counts[at]
    rows = max(n.sum(), 1)
    first = label_model(n @ votes / rows, (votes.T * n) @ votes / rows, share)
    allowed = np.full((k, k), bool(known.sum()))
    allowed[tuple(first.correlated.T)] = True
    start = first.posterior(votes) if len(at) else np.zeros(0)
    return first, pattern_model(votes, n, known[at], start, allowed | allowed.T)


def _family_keys(block: W.Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, key) of all families, and the family of each."""
    row, families = block_keys(block)
    rows = np.concatenate([row[held] for held, _ in families])
    keys = np.concatenate([k for _, k in families])
    family = np.repeat(np.arange(len(families)), [len(k) for _, k in families])
    _, first = np.unique(W.mix(rows.astype(np.uint64)) ^ keys, return_index=True)
    return rows[first], keys[first], family[first]


def associated(sample: DataFrame, least: int = 4, most: int = MAX_FEATURES) -> tuple[np.ndarray, np.ndarray]:
    """(keys, families) that go with a weight ``y`` of a half or more beyond chance.

    Of the ``most`` keys found in most such texts, those stay whose count among all texts
    would be that uneven by chance in less than one key of e^5.
    """

    def positive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in W.blocks(batch.column(0)):
                _, keys, family = _family_keys(block)
                keys, at, n = np.unique(keys, return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64)), pa.array(family[at]), pa.array(n)], ["key", "family", "n"]
                )

    found = (
        sample.filter("y >= 0.5")
        .select("text")
        .mapInArrow(positive, "key long, family long, n long")
        .groupBy("key", "family")
        .agg(F.sum("n").alias("n"))
        .filter(F.col("n") >= least)
        .orderBy(F.desc("n"), "key")
        .limit(most)
        .toArrow()
    )
    keys = found.column("key").to_numpy().view(np.uint64)
    order = np.argsort(keys)
    keys, family, with_y = keys[order], found.column("family").to_numpy()[order], found.column("n").to_numpy()[order]
    if not len(keys):
        return keys, family
    sent = sample.sparkSession.sparkContext.broadcast(keys)

    def every(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(sent.value) + 2, np.int64)
        for batch in batches:
            total[-1] += (batch.column(1).to_numpy(zero_copy_only=False) >= 0.5).sum()
            total[-2] += batch.num_rows
            for block in W.blocks(batch.column(0)):
                _, own, _ = _family_keys(block)
                own = own[_isin(own, sent.value)]
                total[:-2] += np.bincount(np.searchsorted(sent.value, own), minlength=len(sent.value))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["at", "n"])

    counts = (
        sample.select("text", "y").mapInArrow(every, "at long, n long").groupBy("at").agg(F.sum("n").alias("n"))
    ).toArrow().sort_by("at").column("n").to_numpy()
    n, rows, positives = counts[:-2], counts[-2], counts[-1]
    p0 = np.clip(positives / max(rows, 1), 1e-6, 1 - 1e-6)
    p = np.clip(with_y / np.maximum(n, 1), 1e-9, 1 - 1e-9)
    evidence = n * (p * np.log(p / p0) + (1 - p) * np.log((1 - p) / (1 - p0)))
    odds = LIFT * p0 / (1 - p0)
    kept = (p > max(PRECISION, odds / (1 + odds))) & (evidence > np.log(len(keys)) + 5)
    return keys[kept], family[kept]


@dataclass
class ToxicityModel:
    """Log odds: bias, the weights of the keys a text holds, times how often it does, and of its votes."""

    keys: np.ndarray
    weight: np.ndarray  # of the keys, then of the voters
    bias: float
    voters: Voters
    labels: PatternModel

    def scores(self, block: W.Block) -> np.ndarray:
        row, place, n = features(block, self.keys, self.voters)
        z = self.bias + np.bincount(row, n * self.weight[place], block.n)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def features(block: W.Block, keys: np.ndarray, voters: Voters) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, place, times) by row: the keys a text holds, up to a few times, then its votes."""
    found = block_keys(block)
    words, families = found
    pairs = [np.zeros(0, np.int64)]
    width = len(keys) + len(VOTERS)
    for held, own in families:
        inside = _isin(own, keys)
        pairs.append(words[held[inside]] * width + np.searchsorted(keys, own[inside]))
    row, voter = np.nonzero(voters.votes(block, found))
    pairs.append(row * width + len(keys) + voter)
    both, n = np.unique(np.concatenate(pairs), return_counts=True)
    return both // width, both % width, np.minimum(n, MOST_COUNTED)


def _logistic(row, place, times, n_rows: int, n_keys: int, target, penalty: float = 0.5, rounds: int = 400):
    """Logistic regression on counts to soft targets, by full-batch gradient steps."""
    weight, bias = np.zeros(n_keys), float(np.log((target.mean() + 1e-3) / (1 - target.mean() + 1e-3)))
    moment, scale = np.zeros(n_keys + 1), np.zeros(n_keys + 1)
    for t in range(1, rounds + 1):
        z = bias + np.bincount(row, times * weight[place], n_rows)
        error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - target
        grad = np.append(np.bincount(place, times * error[row], n_keys) + penalty * weight, error.sum()) / n_rows
        moment = 0.9 * moment + 0.1 * grad
        scale = 0.99 * scale + 0.01 * grad**2
        step = 0.1 * (moment / (1 - 0.9**t)) / (np.sqrt(scale / (1 - 0.99**t)) + 1e-8)
        weight -= step[:-1]
        bias -= step[-1]
    return weight, bias


def _calibrate(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(a, b) so that a z + b are log odds of y.

    Targets (0 to 1) are drawn in a little (Platt), a is held near 1, and a step that does not
    lower the loss is halved.
    """
    hi, lo = (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2)
    target = lo + (hi - lo) * y

    def loss(x: np.ndarray) -> float:
        v = x[0] * z + x[1]
        return float((np.logaddexp(0, v) - target * v).sum() + 0.5 * (x[0] - 1) ** 2)

    x = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x[0] * z + x[1], -500, 500)))
        w = p * (1 - p)
        g = np.array([((p - target) * z).sum() + x[0] - 1, (p - target).sum()])
        h = np.array([[(w * z * z).sum() + 1, (w * z).sum()], [(w * z).sum(), w.sum() + 1e-3]])
        move, size = np.linalg.solve(h, g), 1.0
        while size > 1e-6 and loss(x - size * move) > loss(x):
            size /= 2
        x = x - size * move
        if np.abs(size * move).max() < 1e-8:
            break
    return (float(x[0]), float(x[1])) if x[0] > 0 else (1.0, 0.0)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    max_rows: int = MAX_ROWS,
) -> ToxicityModel:
    """A model from unlabelled ``docs`` and from ``labels`` (doc_id, label 0 or 1)."""
    spark = docs.sparkSession
    labelled = labelled_sample(docs, labels, doc_id, text, label, max_rows)
    labelled = stored(labelled.select("doc_id", "text", F.col("label").cast("double").alias("y")), "labelled")
    sample = labelled.select("text", "y")
    rows, positives = sample.agg(F.count(F.lit(1)), F.coalesce(F.sum("y"), F.lit(0.0))).first()
    known = bool(0 < positives < rows)
    share = float(np.clip(positives / rows, 0.005, 0.995)) if known else SHARE

    keys, family = associated(sample) if known else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    voters = Voters([keys[family == i] for i in range(1 + len(BEGINNINGS))])
    told = [vote_patterns(sample.filter(F.col("y") == y), "text", voters) for y in (0, 1)] if known else None
    counts = vote_patterns(docs, text, voters)
    by_label = np.stack(told, axis=1) if known else np.zeros((len(counts), 2), np.int64)
    _, model = fitted_labels(counts, by_label, share)

    sent = spark.sparkContext.broadcast((voters, model))

    def posterior(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sent.value[1].posterior(sent.value[0].votes(b)) for b in W.blocks(batch.column(0), 1 << 20)]
            y = np.concatenate(found) if found else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(y)], ["text", "known", "y"])

    others = hashed_sample(docs, doc_id, text, max_rows).join(labelled.select("doc_id"), "doc_id", "left_anti")
    both = sample.unionByName(others.select("text", F.lit(None).cast("double").alias("y")))
    soft = both.select("text", F.col("y").alias("known")).mapInArrow(posterior, "text binary, known double, y double")
    soft = stored(soft, "posterior")
    keys, _ = associated(soft.select("text", "y"))
    chosen = spark.sparkContext.broadcast((keys, voters))

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for block in W.blocks(batch.column(0), 1 << 20):
                row, place, n = features(block, *chosen.value)
                head = np.searchsorted(row, np.arange(block.n + 1))
                out += [np.repeat(place[head[i] : head[i + 1]], n[head[i] : head[i + 1]]) for i in range(block.n)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(2), pa.array(out, pa.list_(pa.int64()))], ["known", "y", "places"]
            )

    table = soft.mapInArrow(held, "known double, y double, places array<long>").toArrow()
    width = len(keys) + len(VOTERS)
    places = [np.asarray(v.as_py(), np.int64) for v in table.column("places")]
    row = np.repeat(np.arange(len(places)), [len(p) for p in places])
    place = np.concatenate([*places, np.zeros(0, np.int64)])
    target, gold = table.column("y").to_numpy(), table.column("known").to_numpy(zero_copy_only=False)
    if not len(target):
        return ToxicityModel(keys, np.zeros(width), float(np.log(share / (1 - share))), voters, model)
    times = np.ones(len(row))
    weight, bias = _logistic(row, place, times, len(places), width, target)
    if known:
        z, had = bias + np.bincount(row, weight[place], len(places)), ~np.isnan(gold)
        told = np.where(gold == 1, model.said()[1], model.said()[0])
        odds = np.log(np.clip(target, 1e-9, 1 - 1e-9) / np.clip(1 - target, 1e-9, 1 - 1e-9)) + told
        a, b = _calibrate(z[had], 1 / (1 + np.exp(-odds[had])))
        weight, bias = a * weight, a * bias + b
    return ToxicityModel(keys, weight, float(bias), voters, model)
