"""Alignment of two tokenizers against plain loops over their tokens."""

from __future__ import annotations

import random
from collections import Counter

import fixtures
import numpy as np
import public_tokenizers
import pytest
from brute import sha

from riskframe.llm import alignment, queries

BYTE_LEVEL = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def both():
    with open(BYTE_LEVEL, encoding="utf-8") as a, open(PIECES, "rb") as b:
        return alignment.Tokenizers(a.read(), b.read())


def plain(rows: list, both) -> list:
    """What the query returns, one token at a time; A by the library that owns the file."""
    counts, texts = Counter(), []
    for doc_id, text in rows:
        whole = b" " + (text or "").encode()
        a = both.a.encode(" " + text, add_special_tokens=False).ids if text else []
        b = both.b.encode(text) if text else []
        bytes_a, bytes_b = ([side.entries[i] for i in ids] for side, ids in ((both.side_a, a), (both.side_b, b)))
        if not text or b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            texts.append((doc_id, 0, 0, 0, [], ""))
            continue
        of_a = [i for i, x in enumerate(bytes_a) for _ in x]
        of_b = [i for i, x in enumerate(bytes_b) for _ in x]
        links = [(a[i], b[j]) for i, j in dict.fromkeys(zip(of_a, of_b))]
        groups, open_a, open_b = [], [], []
        for p, (i, j) in enumerate(zip(of_a, of_b)):
            open_a += [] if i in open_a else [i]
            open_b += [] if j in open_b else [j]
            if p + 1 == len(of_a) or of_a[p + 1] != i and of_b[p + 1] != j:
                groups.append(",".join(str(a[x]) for x in open_a) + "|" + ",".join(str(b[x]) for x in open_b))
                open_a, open_b = [], []
        counts.update(set(links))
        texts.append((doc_id, len(a), len(b), len(groups), links, ";".join(groups)))
    best = Counter()
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    return [
        (i, n_a, n_b, n, len(links), groups, sum(counts[x] == best[x[0]] for x in links), sum(counts[x] for x in links))
        for i, n_a, n_b, n, links, groups in texts
    ]


def _key(row):
    return tuple("" if x is None else str(x) for x in row)


def test_equals_loops(spark, both, monkeypatch):
    docs, rows = fixtures.documents(spark)
    rows_more = [(9001, "▁ not given back"), (9002, "<|endoftext|> </s> <s><0x41>"), (9003, "日本語 ﬁ ½ x²"), (9004, "a" * 5000)]
    docs = docs.unionByName(spark.createDataFrame(rows_more, "doc_id long, text string"), allowMissingColumns=True)
    monkeypatch.setattr(alignment, "BLOCK", 4000)  # several tables a batch
    got = [tuple(r) for r in alignment.aligned(docs, BYTE_LEVEL, PIECES).collect()]
    assert sorted(got, key=_key) == sorted(plain(rows + rows_more, both), key=_key)


def test_query_over_a_whole_table(spark, both):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    want = [(*r[:5], sha(r[5]) if r[5] else "", *r[6:]) for r in plain(rows, both)]
    found = queries.all_queries()["op12_cross_tokenizer_alignment"](spark, folder)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]
    assert sorted(tuple(r) for r in found.collect()) == sorted(want)


def test_empty_table(spark):
    assert alignment.aligned(fixtures.none(spark), BYTE_LEVEL, PIECES).count() == 0


def test_terminals_are_components():
    rng = random.Random(5)
    for _ in range(300):
        n = rng.randint(1, 40)
        ends = [np.array(sorted({n, *rng.sample(range(1, n + 1), rng.randint(0, n))})) for _ in range(2)]
        got = alignment.terminals(*ends)
        common = sorted(set(ends[0]) & set(ends[1]))
        want = [next(c for c in common if c >= e) for e in np.concatenate(ends)]
        assert [int(ends[0][t]) for t in got] == want


def test_fast_way_gives_the_same_ids(both):
    rng = random.Random(6)
    signs = [*" \t\n\r'", *"abzAZ019_-+.,!?", "é", "ß", "ñ", "²", "¼", "ĳ", "'ll", "  ", "the", "ing"]
    for text in [fixtures.prose(7, 500), *("".join(rng.choices(signs, k=rng.randint(1, 60))) for _ in range(2000))]:
        assert not alignment.UNCERTAIN.search(text)
        assert both.fast.encode_ordinary(text) == both.a.encode(text, add_special_tokens=False).ids
