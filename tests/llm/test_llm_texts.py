"""Each operator on whole texts against a plain version, with every odd case."""

from collections import Counter

import brute
import fixtures
import pytest
from pyspark.sql import functions as F

from riskframe.llm import byte_bpe, decontamination, near_duplicates, quality_rules, secrets, sharding
from riskframe.llm import words as W
from riskframe.llm.queries import encoded_digests


def same(rows, expected):
    assert Counter(map(tuple, rows)) == Counter(expected)


def test_statistics(spark):
    df, docs = fixtures.documents(spark)
    out = quality_rules.text_statistics(df, "text", "found")
    assert out.columns == [*df.columns, "found"]
    found = out.select(
        "doc_id", *[f"found.{c}" for c in quality_rules.COUNTS[:5]], quality_rules.base_failed("found")
    ).collect()
    same(found, [(d, *brute.quality(t)) for d, t in docs])
    assert quality_rules.text_statistics(fixtures.none(spark)).count() == 0


def test_decision_list(spark):
    """Symbols mark bad texts here; the list finds that and says it as an expression."""
    rows = [(i, fixtures.prose(i, 60) + (" ###" * 40 if i % 3 == 0 else ""), i % 3 != 0) for i in range(150)]
    df = spark.createDataFrame([(i, t, int(g)) for i, t, g in rows], "doc_id long, text string, quality int")
    counted = quality_rules.text_statistics(df)
    rules = quality_rules.fit_rules(counted)
    assert 1 <= len(rules.rules) <= 3 and str(rules).endswith("else good")
    found = counted.select("quality", rules.column(quality_rules.features()).alias("good")).collect()
    assert all(bool(r.quality) == r.good for r in found)
    none = quality_rules.fit_rules(counted.filter("quality = 1"))
    assert none.rules == [] and counted.select(none.column(quality_rules.features()).alias("g")).first().g


@pytest.mark.parametrize("one_id", [False, True])
def test_decision_list_of_copies(spark, one_id):
    """Copies of one text, a third of more labelled rows than are used, are a third of the sample."""
    counted = quality_rules.text_statistics(
        spark.createDataFrame([(i, fixtures.prose(i, 40)) for i in range(1600)] + [(-1, "buy ### now " * 30)], "doc_id long, text string")
    )
    copies = counted.filter("doc_id = -1").crossJoin(spark.range(800)).select(
        (F.lit(-1) if one_id else -1 - F.col("id")).alias("doc_id"), "statistics", F.lit(0).alias("quality")
    )
    labelled = counted.filter("doc_id >= 0").select("doc_id", "statistics", F.lit(1).alias("quality")).union(copies)
    chosen = quality_rules.rule_sample(labelled, max_rows=300)
    n = {r["_label"]: r["count"] for r in chosen.groupBy("_label").count().collect()}
    assert n[0] + n[1] == 300 and 70 <= n[0] <= 130
    rules = quality_rules.fit_rules(labelled, max_rows=300)
    wrong = labelled.filter(rules.column(quality_rules.features()) != (F.col("quality") == 1)).count()
    assert rules.rules and wrong <= 24


def test_secrets(spark):
    df, docs = fixtures.documents(spark)
    out = secrets.find_secrets(df, "text", "found")
    assert out.columns == [*df.columns, "found"]
    of = lambda k: F.size(F.filter("found", lambda x: x["rank"] == k)).cast("long")
    base = F.filter("found", lambda x: x["rank"] < 3)
    found = out.select("doc_id", of(0), of(1), of(2), F.sha2(secrets.as_text(base).cast("binary"), 256)).collect()
    same(found, [(d, *brute.base_secrets(t)) for d, t in docs])
    assert secrets.find_secrets(fixtures.none(spark)).count() == 0


def test_secrets_need_no_python(spark):
    df, _ = fixtures.documents(spark)
    for made in (secrets.redact(df), sharding.shard_rows(df, 40)):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert not any(w in plan for w in ("Python", "Arrow", "Pandas"))


def entropies(text: str, window: int) -> list[float]:
    from math import log2

    out = []
    for i in range(len(text) - window + 1):
        n = Counter(text[i : i + window]).values()
        out.append(-sum(c / window * log2(c / window) for c in n))
    return out


def test_entropy_windows(spark):
    """Incremental counts give the entropy that counting each window anew gives."""
    scan = secrets.SCANS[1]
    bits = [c.bits for c in scan.classes]
    texts = ["aaaaaaaaaaaaaaaaaaaaf3A9kLq8ZxT2vB7nM4pRzzzzzzzzzzzzzzzzzzzz", "f3A9kLq8ZxT2vB7nM4pR", "short1", "ab" * 30]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for r in df.select("text", secrets.hot_windows(F.col("text"), scan.alphabet, bits).alias("h")).collect():
        for least, h in zip(bits, r.h, strict=True):
            hot = [i for i, e in enumerate(entropies(r.text, secrets.WINDOW)) if e >= least - 1e-9]
            assert (h.first, h.last) == ((hot[0], hot[-1] + secrets.WINDOW) if hot else (-1, -1))


def plain_spans(text: str) -> list[tuple]:
    """(start, end, kind) of the entropy classes, each window counted anew."""
    import re

    out = []
    for scan in secrets.SCANS:
        for m in re.finditer(scan.pattern, text):
            for c in scan.classes:
                if re.search(c.needs, m[0]) and not allowed(m[0]):
                    hot = [i for i, e in enumerate(entropies(m[0], secrets.WINDOW)) if e >= c.bits - 1e-9]
                    out += [(m.start() + hot[0], m.start() + hot[-1] + secrets.WINDOW, c.kind)] if hot else []
    return sorted(out)


def allowed(candidate: str) -> bool:
    import re

    some = r"example|sample|placeholder|changeme|dummy|lorem|0123456789|abcdefghij|xxxxx"
    ids = r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}"
    return bool(
        re.fullmatch(ids, candidate) or re.search(some, candidate, re.I)
        or re.match(r"(sha(1|224|256|384|512)|md5)[-_=]", candidate, re.I) or re.match(r"/?[A-Za-z_-]+/[A-Za-z_-]+/", candidate)
    )


def test_long_candidates(spark):
    """Runs of 100,000 characters and paths of 100,000 parts, in time that follows their length."""
    import random
    import string
    import time

    rng = random.Random(2)
    plain = string.ascii_letters + string.digits
    run = "".join(rng.choices(plain + "+/", k=100_000))
    texts = {
        "empty": "", "run": f"see {run} end", "hex": "".join(rng.choices("0123456789abcdef", k=100_000)), "flat": "a1" * 50_000,
        "base32": "".join(rng.choices(string.ascii_uppercase + "234567", k=100_000)), "letters": "".join(rng.choices(string.ascii_letters, k=100_000)),
        "path": "a/" * 100_000 + "12", "words": "some-part_of/" * 20_000 + "x1", "marked": "key " + "".join(rng.choices(plain, k=30)) + " a/b/c12 " * 5_000,
        "mixed": "aB" * 300 + run[:500] + "z" * 300 + run[500:900],
    }
    df = spark.createDataFrame(list(texts.items()), "name string, text string").coalesce(1)
    found, seconds = {}, {}
    for name in texts:
        start = time.perf_counter()
        (row,) = secrets.find_secrets(df.filter(F.col("name") == name)).collect()
        seconds[name] = time.perf_counter() - start
        found[name] = [(x.start, x.end, x.kind) for x in row.secrets if x.rank >= 3]
    for name, text in texts.items():
        assert found[name] == plain_spans(text), name
    assert max(seconds.values()) < min(seconds.values()) + 6, seconds


def random_secrets(each: int) -> list[tuple]:
    """(alphabet, length, text around a random secret without a keyword)."""
    import random
    import string

    rng, plain = random.Random(11), string.ascii_letters + string.digits
    kinds = {
        "letters and digits": (plain, (20, 24, 32)),
        "base64": (plain + "+/", (20, 24, 40)),
        "base32": (string.ascii_uppercase + "234567", (20, 32, 40)),
    }
    return [
        (kind, n, f"use {''.join(rng.choices(alphabet, k=n))} for it")
        for kind, (alphabet, lengths) in kinds.items() for n in lengths for _ in range(each)
    ]


def test_recall_of_random_secrets(spark):
    df = spark.createDataFrame(random_secrets(1000), "kind string, n int, text string").repartition(8)
    found = secrets.find_secrets(df).groupBy("kind", "n").agg(F.avg((F.size("secrets") > 0).cast("int")).alias("recall"))
    recall = {(r.kind, r.n): r.recall for r in found.collect()}
    assert all(v >= (0.95 if n == 20 else 0.97) for (_, n), v in recall.items()), recall


def test_words_are_no_secrets(spark):
    said = [
        "internationalization INTERNATIONALIZATION counterrevolutionaries",
        "getElementsByTagNameFromDocument AbstractSingletonProxyFactoryBean",
        "how-to-use-word2vec-in-python-for-beginners the_quick_brown_fox_jumps_over",
        "blog/2024/how-people-write-plain-texts supercalifragilisticexpialidocious2",
    ]
    df = spark.createDataFrame([(t,) for t in said], "text string")
    assert [r.text for r in secrets.find_secrets(df).filter(F.size("secrets") > 0).collect()] == []


def test_allow_list_and_redaction(spark):
    df, _ = fixtures.documents(spark)
    rows = {r.doc_id: r for r in secrets.redact(df).filter("doc_id is not null").collect()}
    by_text = {t: 100 - 3 * i for i, t in enumerate(fixtures.texts())}
    said = lambda start: next(rows[d].text for t, d in by_text.items() if t and t.startswith(start))
    # the base pattern takes lower-case digits only; the rest is on the allow-list as an alphabet
    assert said("key f3A9") == "key <secret> end and <secret>ABCDEF"
    assert "123e4567-e89b" in said("id 123e") and "sha256-AbCd" in said("id 123e")
    assert said("password") == "<secret>\" token:abc <secret>, passwd: token: abcdefgh"
    assert rows[by_text[fixtures.texts()[0]] + 3].text == fixtures.texts()[0]


def test_decontamination(spark):
    df, docs = fixtures.documents(spark)
    texts = fixtures.texts()
    words = texts[7].split(" ")
    items = [
        (1, " ".join(words[500:540])),
        (2, " ".join(words[19_000:19_012]).upper()),
        (3, "one TWO three"),
        (4, "x"),
        (5, ""),
        (6, None),
        (None, " ".join(words[700:712])),
        (7, " ".join(words[100:109])),
        (8, fixtures.prose(99, 50)),
        (1, " ".join(words[500:540])),
        (9, "x x x x x x x x x x x x"),
        (10, "c d e f"),
    ]
    table = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    found = decontamination.contamination(df, table)
    rows = found.select(
        "doc_id", "n_words", "n_hit", F.size("ids"), F.sha2(F.array_join("ids", ",").cast("binary"), 256), F.col("n_hit") > 0
    ).collect()
    same(rows, [(d, *r) for (d, _), r in zip(docs, brute.contamination(docs, items))])
    assert decontamination.contamination(fixtures.none(spark), table).count() == 0
    clean = decontamination.contamination(df, table.limit(0))
    assert clean.filter("n_hit > 0").count() == 0 and clean.count() == len(docs)


def test_long_repeated_words_are_decontaminated(spark):
    """A text of 100,000 equal words and one of a repeated line, with items of them."""
    line = "the same few words stand in every line of this text "
    items = [(1, "na " * 1000), (2, line * 30), (3, "na " * 9 + "end")]
    docs = [(1, "na " * 100_000), (2, line * 5_000), (3, "other " * 50 + "na " * 9 + "end"), (4, "na " * 9)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = decontamination.contamination(df, spark.createDataFrame(items, "item_id long, text string"))
    got = {r.doc_id: (r.n_words, r.n_hit, r.ids) for r in found.collect()}
    n_line = len(line.split())
    assert got == {
        1: (100_000, 100_000, ["1"]), 2: (5_000 * n_line, 5_000 * n_line, ["2"]), 3: (60, 10, ["3"]), 4: (9, 0, []),
    }


def test_winnowing_guarantee():
    """Two texts with ten words in common share a fingerprint, wherever the words stand."""
    import numpy as np

    rng = np.random.default_rng(5)
    for _ in range(200):
        shared = rng.integers(0, 1 << 60, 10).astype(np.uint64)
        marks = []
        for _ in range(2):
            a, b = rng.integers(0, 30, 2)
            text = np.concatenate((rng.integers(0, 1 << 60, a), shared, rng.integers(0, 1 << 60, b))).astype(np.uint64)
            marks.append(set(decontamination.fingerprints(text, np.zeros(len(text), np.int64))[0].tolist()))
        assert marks[0] & marks[1]


def expected_groups(docs):
    known = brute.groups([(d, t) for d, t in docs if d is not None])
    return [
        (d, *known[d], d == known[d][1]) if d is not None else (d, len(brute.shingles(t)), None, True) for d, t in docs
    ]


def test_near_duplicates(spark):
    df, docs = fixtures.documents(spark)
    found = near_duplicates.near_duplicates(df)
    same(found.collect(), expected_groups(docs))
    assert near_duplicates.near_duplicates(fixtures.none(spark)).count() == 0


def test_an_id_with_several_texts_is_one_node(spark):
    a, b, c = (fixtures.prose(i, 60) for i in (70, 71, 72))
    rows = [(3, a), (5, a), (5, b), (7, b), (9, c), (9, c), (11, c), (12, fixtures.prose(73, 60)), (12, "")]
    found = near_duplicates.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    got = sorted((r.doc_id, r.component_id, r.kept) for r in found.collect())
    assert got == [
        (3, 3, True), (5, 3, False), (5, 3, False), (7, 3, False), (9, 9, True), (9, 9, True), (11, 9, False), (12, 12, True), (12, 12, True),
    ]


@pytest.mark.parametrize("share", [0.75, 0.8])
def test_recall_of_pairs(spark, share):
    """Random pairs of sets at a similarity, of six sizes, are all linked."""
    import random

    rng, rows, pairs = random.Random(8), [], 0
    for n in (8, 20, 60, 200, 600, 2000):
        for _ in range(30):
            words = [f"w{rng.getrandbits(40)}" for _ in range(n + 4)]
            kept = -(-int(share * 2 * n * 1000) // int((1 + share) * 1000))  # same shingles of n on either side
            more = [f"w{rng.getrandbits(40)}" for _ in range(n - kept)]
            rows += [(2 * pairs, " ".join(words)), (2 * pairs + 1, " ".join(words[: kept + 4] + more))]
            pairs += 1
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    known = brute.groups(rows)
    found = {r.doc_id: r.component_id for r in near_duplicates.near_duplicates(df).collect()}
    assert found == {d: known[d][1] for d, _ in rows}
    assert sum(1 for d, c in found.items() if d != c) > pairs * 0.5


@pytest.mark.parametrize("block", [near_duplicates.BLOCK, 40_000])
def test_large_bucket(spark, block):
    """One group of near copies whose least id is not near to all; small blocks change nothing."""
    base = fixtures.prose(50, 150)
    docs = [(i, fixtures.edited(base, 1000 + i, 0.01 + 0.05 * (i % 5) / 4)) for i in range(250)]
    docs += [(1000 + i, fixtures.prose(60 + i, 100)) for i in range(50)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    same(near_duplicates.near_duplicates(df, block=block).collect(), expected_groups(docs))


def test_sharding(spark):
    import zlib

    df, docs = fixtures.documents(spark)
    rows = sharding.shard_rows(df, 7).collect()
    same(
        [(r.key, r["size"], r.text_crc32) for r in rows],
        [(d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in docs],
    )
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
        assert r.grown_shard in (r.shard, 7)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.shard_rows(fixtures.none(spark), 7).count() == 0


def plain_jump(key, shards):
    """The last position below ``shards`` on the key's way; hashes by the public library."""
    import xxhash

    def fraction(i):
        h = 42 if key is None else xxhash.xxh64_intdigest(key.to_bytes(8, "little", signed=True), 42)
        for part in (i, sharding.SEED):
            h = xxhash.xxh64_intdigest(part.to_bytes(4, "little"), h)
        return ((h >> 12) + 1) / 2**52

    at, ahead, i = -1, 0, 0
    while ahead < shards:
        i += 1
        at, ahead = ahead, int((ahead + 1) / fraction(i))
    return at


def test_sharding_equals_plain_jumps(spark):
    """Shards, grown shards and slots of ids of either sign, null and repeated ones."""
    keys = [None, 0, -1, 2**62, -(2**62), *range(1000, 1600), *[77] * 300]
    df = spark.createDataFrame([(k, f"t{i % 3}") for i, k in enumerate(keys)], "doc_id long, text string")
    for shards in (1, 2, 40):
        rows = sharding.shard_rows(df.repartition(5), shards).collect()
        assert sorted((str(r.key), r.shard, r.grown_shard) for r in rows) == sorted(
            (str(k), plain_jump(k, shards), plain_jump(k, shards + 1)) for k in keys
        )
        again = sharding.shard_rows(df.repartition(2), shards).collect()
        assert Counter(map(tuple, rows)) == Counter(map(tuple, again))  # slots as well


def test_jump_moves_only_its_share(spark):
    keys = spark.range(20_000).select(
        sharding.jump(F.col("id"), 10).alias("a"), sharding.jump(F.col("id"), 11).alias("b"), sharding.jump(F.col("id"), 1).alias("c")
    ).collect()
    assert {r.c for r in keys} == {0} and {r.a for r in keys} == set(range(10))
    moved = [r for r in keys if r.a != r.b]
    assert all(r.b == 10 for r in moved) and abs(len(moved) - 20_000 / 11) < 200
    assert max(Counter(r.a for r in keys).values()) < 2200


@pytest.mark.parametrize("chunk", [byte_bpe.CHUNK, 1100])
def test_bpe(spark, chunk, monkeypatch):
    import public_tokenizers as P

    model = brute.tokenizer()
    df, docs = fixtures.documents(spark)
    monkeypatch.setattr(byte_bpe, "CHUNK", chunk)
    monkeypatch.setattr(byte_bpe.encode, "__defaults__", ("text", "ids", chunk))
    found = encoded_digests(df, P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    same(found.collect(), [(d, *brute.tokens(t, model)) for d, t in docs])
    assert encoded_digests(fixtures.none(spark), P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN).count() == 0


def test_stitching():
    text = fixtures.prose(8, 40) + "w" * 50 + " " + fixtures.prose(9, 20)
    step, overlap = 20, 8
    for blanks in (True, False):
        chunks = []
        for at in range(0, len(text), step):
            chunk = text[at : at + step + overlap]
            ends = [i for i in range(1, len(chunk)) if blanks and chunk[i] == " " and chunk[i - 1].isalpha()]
            chunks.append((chunk, [i for i in ends if i <= overlap], [i - step for i in ends if i >= step]))
        pieces = byte_bpe.stitch(chunks, step)
        assert "".join(pieces) == text
        assert all(p[0] == " " for p in pieces[1:]) and (len(pieces) > 5) == blanks


def test_working_arrays_of_decontamination_stay_small():
    """Texts of 8 MB in one batch are fingerprinted in blocks whose arrays take some megabytes."""
    import tracemalloc

    import pyarrow as pa

    column = pa.array([b"some words of a text that goes on " * 60] * 4000, pa.binary())
    tracemalloc.start()
    try:
        for block in W.blocks(column, decontamination.BLOCK_BYTES):
            decontamination.fingerprints(*decontamination.block_words(block))
        assert tracemalloc.get_traced_memory()[1] < 32e6
    finally:
        tracemalloc.stop()
