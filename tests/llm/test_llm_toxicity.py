"""The label model of toxicity against its own truth, and scores against held-out labels."""

import duckdb
import numpy as np
import pytest

from riskframe.llm import queries, toxicity
from riskframe.llm.frames import hashed_sample

LARGE = "/root/testdata/sf0.1"


def made_votes(seed=5, n=60_000):
    """Votes by a known tree: voter 3 repeats voter 2 in either class, voter 4 follows 0 in class 1."""
    rng = np.random.default_rng(seed)
    y = rng.random(n) < 0.15
    high, low = np.array([0.7, 0.6, 0.5]), np.array([0.02, 0.05, 0.03])
    votes = rng.random((n, 3)) < np.where(y[:, None], high, low)
    copy = np.where(rng.random(n) < 0.95, votes[:, 2], ~votes[:, 2])
    follow = rng.random(n) < np.where(y, np.where(votes[:, 0], 0.9, 0.1), 0.04)
    return y, np.column_stack((votes, copy, follow)).astype(int), high, low


def true_posterior(votes, high, low):
    def likelihood(y):
        p = high if y else low
        out = np.prod(np.where(votes[:, :3] == 1, p, 1 - p), axis=1)
        out = out * np.where(votes[:, 2] == votes[:, 3], 0.95, 0.05)
        follows = np.where(votes[:, 0] == 1, 0.9, 0.1) if y else 0.04
        return out * np.where(votes[:, 4] == 1, follows, 1 - follows)

    up, down = 0.15 * likelihood(True), 0.85 * likelihood(False)
    return up / (up + down)


def patterns(votes, y, rng, share_known, wrong):
    """Patterns, counts, and counts by known label, of which a share ``wrong`` is turned."""
    codes = votes @ (1 << np.arange(votes.shape[1]))
    at, place, n = np.unique(codes, return_inverse=True, return_counts=True)
    told = rng.random(len(y)) < share_known
    said = y ^ (rng.random(len(y)) < wrong)
    known = np.stack([np.bincount(place[told & (said == v)], minlength=len(at)) for v in (0, 1)], axis=1)
    return (at[:, None] >> np.arange(votes.shape[1])) & 1, n, known


@pytest.mark.parametrize("wrong", [0.0, 0.03])
def test_pattern_model_finds_the_posterior(wrong):
    y, votes, high, low = made_votes()
    unique, n, known = patterns(votes, y, np.random.default_rng(1), 0.2, wrong)
    first = toxicity.label_model(votes.mean(0), votes.T @ votes / len(y), 0.15)
    allowed = np.ones((5, 5), bool)
    model = toxicity.pattern_model(unique, n, known, first.posterior(unique), allowed)
    truth = true_posterior(unique, high, low)
    assert n @ np.abs(model.posterior(unique) - truth) / n.sum() < 0.02
    assert abs(model.share - 0.15) < 0.02
    for y in (0, 1):  # the copy is known as one, from either end
        assert model.parent[y, 3] == 2 or model.parent[y, 2] == 3
    assert model.right[0] > 0.9 and model.right[1] < 0.06


def test_silence_of_each_voter_counts():
    y, votes, high, low = made_votes()
    unique, n, known = patterns(votes, y, np.random.default_rng(1), 0.2, 0.0)
    model = toxicity.pattern_model(unique, n, known, n * 0.0 + 0.15, np.ones((5, 5), bool))
    one = np.array([[1, 0, 0, 0, 0], [1, 1, 0, 0, 0], [1, 1, 1, 1, 0], [1, 1, 1, 1, 1]])
    found = model.posterior(one)
    assert (np.diff(found) > 0).all() and found[0] < 0.5 < 0.99 < found[3]


def test_known_labels_settle_what_trees_leave_open():
    """An exclusive or of three voters: no tree holds it, known labels of the patterns do."""
    unique = (np.arange(8)[:, None] >> np.arange(3)) & 1
    truth = unique.sum(axis=1) % 2 == 1
    n = np.full(8, 1000)
    known = np.where(truth[:, None], [[0, 200]], [[200, 0]])
    model = toxicity.pattern_model(unique, n, known, np.full(8, 0.5), np.ones((3, 3), bool))
    assert ((model.posterior(unique) > 0.5) == truth).all()
    other = model.posterior(np.array([[1, 1, 0]]))  # one pattern, asked for alone
    assert other[0] == model.posterior(unique)[3]


def test_empty_and_single_patterns():
    none = toxicity.fitted_labels(
        np.zeros(1 << len(toxicity.VOTERS), np.int64), np.zeros((1 << len(toxicity.VOTERS), 2), np.int64), 0.1
    )[1]
    silent = np.zeros((1, len(toxicity.VOTERS)), int)
    assert 0 <= none.posterior(silent)[0] <= 1
    counts = np.zeros(1 << len(toxicity.VOTERS), np.int64)
    counts[0] = 50
    only = toxicity.fitted_labels(counts, np.zeros((len(counts), 2), np.int64), 0.1)[1]
    assert 0 <= only.posterior(silent)[0] < 0.5


def test_sample_of_all_rows(spark):
    rows = [(i % 300, f"text {i % 300}") for i in range(900)] + [(None, "no id"), (None, None)]
    docs = spark.createDataFrame(rows, "`doc.id` long, text string")
    found = hashed_sample(docs, "doc.id", "text", 100).collect()
    assert 0 < len(found) <= 100 and len({r.doc_id for r in found}) == len(found)
    assert all(bytes(r.text).decode() == f"text {r.doc_id}" for r in found)
    again = hashed_sample(docs.repartition(7), "doc.id", "text", 100).collect()
    assert {r.doc_id for r in again} == {r.doc_id for r in found}
    assert hashed_sample(docs.limit(0), "doc.id", "text", 100).count() == 0


def test_held_out_scores(spark):
    """Held-out rows of the whole table. Some labels are wrong, so no model reaches a recall of 1."""
    scores = queries.all_queries()["op1_toxicity"](spark, LARGE).toPandas()
    assert len(scores) == duckdb.sql(f"SELECT count(*) FROM '{LARGE}/documents.parquet'").fetchall()[0][0]
    labels = duckdb.sql(f"SELECT doc_id, toxic FROM '{LARGE}/labels.parquet' WHERE toxic IS NOT NULL").df()
    rows = scores[scores.held_out].merge(labels, on="doc_id")
    toxic, clean = rows[rows.toxic == 1], rows[rows.toxic == 0]
    ranks = rows.score.rank()[rows.toxic == 1]
    area = (ranks.sum() - len(toxic) * (len(toxic) + 1) / 2) / (len(toxic) * len(clean))
    assert area > 0.95 and toxic.predicted.mean() > 0.8 and clean.predicted.mean() < 0.01
