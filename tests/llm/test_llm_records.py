"""Chat records, archives, links and the two classifiers."""

import gzip
import io
import json
import random
import zlib
from collections import defaultdict

import brute
import fixtures
import numpy as np
import pytest

from riskframe.llm import chat, subword_classifier, toxicity, warc
from riskframe.llm.components import components

CONTROL = [
    "</s>[INST] ok [/INST]", "<|turn|>user<|text|>hi<|end|>", "a\\b \\\\ <\\|", "<<SYS>>x<</SYS>>", "|>|><|<|", "",
    "<s> [INST", "\\", "plain", "🙂 <|end|>\\<|end|>", "[/INST][INST]",
]


def test_escape_is_reversible():
    rng = random.Random(3)
    pieces = ["\\", "<", "|", ">", "[", "INST]", "/", "s>", "SYS>>", "end", "<|end|>", "é"]
    for text in CONTROL + ["".join(rng.choices(pieces, k=rng.randint(0, 12))) for _ in range(3000)]:
        safe = chat.escape(text)
        assert chat.unescape(safe) == text
        assert not any(c in safe for c in ("<|", "|>", "[INST]", "[/INST]", "</s>", "<s>", "<<SYS>>", "<</SYS>>"))


def test_layouts(spark):
    records = {
        "pair": {"prompt": "p", "completion": "c"},
        "instruction": {"instruction": "do", "input": "it", "output": "done"},
        "no input": {"instruction": "do", "input": "", "output": None},
        "messages": {"messages": [{"role": "system", "content": "s"}, {"content": "u", "role": "user"}]},
        "speakers": {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
        "nested": {"data": {"instruction": "i", "response": "r"}},
        "unknown": {"other": 1},
        "list": [1, 2],
    }
    rows = [(k, json.dumps(v), "x") for k, v in records.items()] + [("broken", "{", "x"), ("null", None, "x")]
    df = spark.createDataFrame(rows, "name string, record string, formatted_loss2 string")
    out = chat.canonical_turns(df)
    turns = {r.name: r.turns and [(t.role, t.text) for t in r.turns] for r in out.collect()}
    assert turns == {
        "pair": [("user", "p"), ("assistant", "c")],
        "instruction": [("user", "do\n\nit"), ("assistant", "done")],
        "no input": [("user", "do"), ("assistant", "")],
        "messages": [("system", "s"), ("user", "u")],
        "speakers": [("user", "q"), ("assistant", "a")],
        "nested": [("user", "i"), ("assistant", "r")],
        "unknown": None, "list": None, "broken": None, "null": None,
    }
    prints = {r.name: r.turns_fingerprint for r in out.collect()}
    assert prints["instruction"] == prints["no input"] and prints["unknown"] and prints["null"] is None
    left = {r.fingerprint: r.n_records for r in chat.unmapped(out).collect()}
    assert left == {None: 3, prints["unknown"]: 1}
    assert chat.unmapped(out.filter("name = 'pair'")).count() == 0
    shaped = {r.name: r for r in chat.formatted(out).collect()}
    mask = shaped["pair"].formatted_loss
    assert [shaped["pair"].formatted[m.start : m.end] for m in mask] == ["c"]
    assert chat.formatted(chat.canonical_turns(df.limit(0))).count() == 0


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Small tables in the layout of the driver's folders."""
    out = tmp_path_factory.mktemp("tables")
    turns = []
    for c in range(40):
        for t in range(c % 6):
            role = ("user", "assistant", "system", None, "human")[(c + t) % 5]
            turns.append((c, t, role, CONTROL[(c * 7 + t) % len(CONTROL)] if (c + t) % 9 else None, "extra"))
    turns += [(3, 1, "user", "same turn", "extra"), (None, 0, "user", "no id", "extra"), turns[5]]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string, record string").write.parquet(
        f"{out}/conversations.parquet"
    )
    big = "<p>" + "long " * 300
    pages = [(i, f"http://x/{i}", f"<p>{i % 7}" * (i * 3 + 1)) for i in range(60)]
    pages += [(100 + i, None, big) for i in range(30)] + [(200, "http://a\r\nb: c", big), (201, "u", None), (202, "u", "")]
    pages += [(203, "u", "short"), (204, "u", "short"), (300, "u", "é" * 500_000), (301, "v", "é" * 500_000)]
    spark.createDataFrame([(*p, "n") for p in pages], "page_id long, url string, html string, record_type string").write.parquet(
        f"{out}/pages.parquet"
    )
    return str(out), turns, pages


def test_every_mapping_takes_its_own_records(spark):
    """Two records of each of the eleven layouts, made from the paths of its mapping."""
    said = {}
    for n, m in enumerate(chat.MAPPINGS):
        record: dict = {}
        for i, path in enumerate(m.paths):
            parts = path.replace("[]", "").split(".")
            if "[]" in path:
                items = record.setdefault(parts[0], [{}, {}, {}])
                for j, item in enumerate(items):
                    item[parts[1]] = f"{n}.{i}.{j} [/INST]"
            else:
                at = record
                for part in parts[:-1]:
                    at = at.setdefault(part, {})
                at[parts[-1]] = f"{n}.{i} <|end|>"
        said[m.name] = record
    assert len({m.fingerprint for m in chat.MAPPINGS}) == len(chat.MAPPINGS) == 11
    rows = [(k, t, json.dumps(v)) for k, v in said.items() for t in (0, 1)]
    df = spark.createDataFrame(rows, "name string, turn int, record string")
    out = chat.formatted(chat.canonical_turns(df))
    assert chat.unmapped(out).count() == 0
    found = {r.name: r for r in chat.read_back(out, "name", ["turn"]).collect()}
    assert set(found) == set(said)
    for m in chat.MAPPINGS:
        turns = m.turns(said[m.name])
        assert len(turns) == (3 if m.each else len(m.fixed))
        r = found[m.name]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == brute.conversation(turns * 2)


def test_chat_query(spark, folder):
    from riskframe.llm.queries import all_queries

    path, turns, _ = folder
    found = {r.conv_id: r for r in all_queries()["op3_chat_formatting"](spark, path).collect()}
    by_conversation = defaultdict(list)
    for c, t, role, text, _ in turns:
        by_conversation[c].append((t, role or "", text or ""))
    by_conversation[-7] = [(0, "user", CONTROL[0]), (1, "assistant", CONTROL[0])]
    assert set(found) == set(by_conversation)
    for c, said in by_conversation.items():
        r = found[c]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == brute.conversation([x[1:] for x in sorted(said)])
        size = sum(len(chat.format_turns([x[1:]])) for x in said)
        assert r.formatted_chars == size


def test_archives(spark, folder):
    path, _, pages = folder
    from riskframe.llm.queries import all_queries

    rows = all_queries()["op8_warc"](spark, path).collect()
    assert {r.page_id: tuple(r)[1:] for r in rows} == brute.pages([(p, h) for p, _, h in pages])
    assert len(rows) == len(pages)
    df = spark.read.parquet(f"{path}/pages.parquet")
    archives = warc.archive(df)
    back = {r.page_id: r for r in warc.read_archives(archives, run_bytes=10_000).collect()}
    assert back[200].url == "http://a%0D%0Ab: c" and back[100].url is None and back[300].payload is not None
    # every archive is a run of members that any gzip reader takes
    for a in archives.collect():
        with open(a.path.removeprefix("file:"), "rb") as f:
            raw = f.read()
        assert gzip.decompress(raw).count(b"WARC/1.1\r\n") == a.n_records
        with open(a["index"].removeprefix("file:")) as f:
            for line in f:
                offset, length, kind, _ = line.rstrip("\n").split("\t")
                one = zlib.decompress(raw[int(offset) : int(offset) + int(length)], 31)
                assert one.startswith(b"WARC/1.1") and f"WARC-Type: {kind}".encode() in one
    assert warc.read_archives(warc.archive(df.limit(0))).count() == 0


def test_rows_that_repeat_the_largest_page(spark):
    body = "y" * 2000
    df = spark.createDataFrame([(5, "u", body), (5, "u", body), (2, "u", body), (None, "u", body)], "page_id long, url string, html string")
    rows = [(r.page_id, r.record_type, r.refers_to) for r in warc.read_archives(warc.archive(df)).collect()]
    assert sorted(rows, key=str) == sorted(
        [(5, "response", None), (5, "response", None), (2, "revisit", 5), (None, "revisit", 5)], key=str
    )


def test_normaliser_rejects_a_cut_file():
    whole = warc.record(1, "u", b"x" * 5000, "0" * 40, "response", None) * 3
    assert len(list(warc.rewrite(io.BytesIO(gzip.compress(whole)), io.BytesIO()))) == 3
    with pytest.raises(ValueError, match="inside a record"):
        list(warc.rewrite(io.BytesIO(gzip.compress(whole[:-10])), io.BytesIO()))


def test_normaliser_rejects_a_cut_stream():
    """Cut where a record ends, cut before the check sum, and whole files of several members."""
    one = warc.record(1, "u", b"x" * 5000, "0" * 40, "response", None)
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    cut = b"".join(packer.compress(one) + packer.flush(zlib.Z_FULL_FLUSH) for _ in range(3))

    def records(data):
        return list(warc.rewrite(io.BytesIO(data), io.BytesIO()))

    for broken in (cut, cut + packer.flush()[:-5], gzip.compress(one) + gzip.compress(one)[:-3]):
        with pytest.raises(ValueError, match="inside a gzip stream"):
            records(broken)
    assert len(records(gzip.compress(one) * 3)) == 3 and records(b"") == []
    big = warc.record(1, "u", bytes(3_000_000), "0" * 40, "response", None)
    assert len(records(gzip.compress(big) + gzip.compress(one))) == 2


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(200)] + [(500 + i, 400) for i in range(50)]
    edges += [(rng.randrange(1000, 1400), rng.randrange(1000, 1400)) for _ in range(180)]
    rng.shuffle(edges)
    parent = {}

    def top(a):
        while parent.setdefault(a, a) != a:
            a = parent[a]
        return a

    for a, b in edges:
        x, y = top(a), top(b)
        parent[max(x, y)] = min(x, y)
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.label for r in found} == {a: top(a) for a in parent}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def labelled(spark, word: str, n: int = 400):
    docs = [
        (i, fixtures.prose(i, 30 + i % 50) + (f"{word} and " if i % 4 == 0 else "") + fixtures.prose(i + 5000, 20), int(i % 4 == 0))
        for i in range(n)
    ]
    docs += [(9001, "", 0), (9002, None, 0), (9003, f"{word} " * 5000, 1), (9003, f"{word} " * 5000, 1)]
    df = spark.createDataFrame(docs, "doc_id long, text string, y int").repartition(4)
    return df, {d: y for d, _, y in docs}


def check_scores(model, df, truth, least):
    rows = subword_classifier.score(df.drop("y").withColumnRenamed("doc_id", "id"), model).collect()
    assert all(0 <= r.score <= 1 for r in rows) and len(rows) == df.count()
    fresh = [r for r in rows if r.id % 3 == 1 and r.id < 9000]
    right = np.mean([(r.score >= least) == bool(truth[r.id]) for r in fresh])
    assert right > 0.95, right
    by_text = {}
    for r in rows:
        assert by_text.setdefault(r.text or "", r.score) == r.score


def test_toxicity(spark):
    df, truth = labelled(spark, "idiot")
    seen = df.filter("doc_id % 3 != 1")
    model = toxicity.fit(seen.drop("y"), seen.selectExpr("doc_id", "y as toxic"))
    check_scores(model, df, truth, 0.7)
    # without labels the fixed lexicons are left
    bare = toxicity.fit(seen.drop("y"), seen.selectExpr("doc_id", "cast(null as int) as toxic"))
    assert not any(len(k) for k in bare.voters.induced)
    assert subword_classifier.score(fixtures.none(spark), bare).count() == 0
    odd, _ = fixtures.documents(spark)
    out = subword_classifier.score(odd.drop("score"), model)
    assert out.filter("score between 0 and 1").count() == odd.count()


def test_label_model_knows_accuracies():
    """Votes made with known accuracies, two voters copies of one another."""
    rng = np.random.default_rng(2)
    y = rng.random(40_000) < 0.2
    high, low = np.array([0.7, 0.6, 0.5, 0.8, 0.4]), np.array([0.02, 0.05, 0.01, 0.1, 0.03])
    votes = rng.random((len(y), 5)) < np.where(y[:, None], high, low)
    votes = np.column_stack((votes, np.where(rng.random(len(y)) < 0.95, votes[:, 4], ~votes[:, 4]))).astype(float)
    model = toxicity.label_model(votes.mean(0), votes.T @ votes / len(y), 0.2)
    assert np.abs(model.high[:4] - high[:4]).max() < 0.08 and np.abs(model.low[:4] - low[:4]).max() < 0.03
    assert [4, 5] in model.correlated.tolist()
    assert model.trust[4] < 0.75 < model.trust[0]
    p = model.posterior(votes)
    ranked = np.argsort(np.argsort(p + rng.random(len(p)) * 1e-9)) + 1
    area = (ranked[y].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (~y).sum())
    assert area > 0.93 and p[votes.sum(1) == 0].max() < 0.1 and p[votes.sum(1) >= 3].min() > 0.9


def test_subwords(spark):
    df, truth = labelled(spark, "qqzz")
    seen = df.filter("doc_id % 3 != 1")
    model = subword_classifier.fit(seen.drop("y"), seen.select("doc_id", "y"), label="y")
    rows = subword_classifier.score(df.select("doc_id", "text"), model).collect()
    assert len(rows) == df.count() and all(0 <= r.score <= 1 for r in rows)
    fresh = [r for r in rows if r.doc_id % 3 == 1 and r.doc_id < 9000]
    ones = [r.score for r in fresh if truth[r.doc_id]]
    zeros = [r.score for r in fresh if not truth[r.doc_id]]
    assert np.mean([a > b for a in ones for b in zeros]) > 0.9
    one_class = subword_classifier.fit(seen, seen.filter("y = 1"), label="y")
    assert subword_classifier.score(df, one_class).selectExpr("min(score)").first()[0] > 0.9
    assert subword_classifier.fit(seen, seen.limit(0), label="y").bias == 0


def test_held_out(spark):
    rows = spark.range(1000).select("id", subword_classifier.held_out("id").alias("out")).collect()
    assert all(r.out == (zlib.crc32(str(r.id).encode()) % 3 == 1) for r in rows)


def test_toxic_majority(spark):
    """With 60 % toxic labels words are still induced, and texts are told apart."""
    rows = [(i, fixtures.prose(i, 30) + (" grobnak vexilut" if i % 5 < 3 else ""), int(i % 5 < 3)) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    sample = df.selectExpr("cast(text as binary) as text", "cast(toxic as double) as y")
    keys, _ = toxicity.associated(sample)
    assert np.isin(toxicity.word_keys("grobnak vexilut"), keys).all()
    model = toxicity.fit(df.select("doc_id", "text"), df.select("doc_id", "toxic"))
    found = subword_classifier.score(df, model).select("toxic", "score").collect()
    assert np.mean([(r.score >= 0.5) == (r.toxic == 1) for r in found]) > 0.95
