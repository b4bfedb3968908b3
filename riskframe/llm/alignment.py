"""Alignment of two tokenizers over the same bytes, by pointer jumping.

Every text is encoded by a byte-level BPE (A) and by a piece model (B). Each token points
to the token of the other side that overlaps it and reaches farthest right, to itself if
none reaches beyond it; where ends agree, B points to A. Doubling the successors until they
settle leaves every token at the last A token of its component, whose end is a byte offset
at which both sides end: components are the groups. All of it is done for a block of texts
at once, in numpy.

A link is an occurrence of an A and a B token whose byte ranges overlap. In how many
documents an id pair is linked is summed over the corpus, and given back to each document:

1. Tasks encode blocks of texts. A block yields a row per text (counts, groups, and its
   distinct linked pairs by their place in the block's table) and that table: the block's
   distinct pairs with the number of its texts that hold each. So what is shuffled for a
   frequent pair is one row a block, not one a document.
2. Tables are summed by pair; the highest count of an A id follows (one row per A id, so it
   is bounded by the vocabulary and broadcast).
3. The counts go back to the blocks, and each block's texts sum them.

Cases: a text that is null, empty, or that either tokenizer does not give back byte by byte
(B knows no U+2581 of its own) has no tokens: zeros and empty groups. Rows are documents of
their own, so repeated rows count as often as they come; a null id is kept. An empty table
gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm import words as W
from riskframe.llm.frames import quoted, stored

BLOCK = 4 << 20  # bytes of text whose pairs share a table
SLICE = 1 << 19  # bytes of text given to the tokenizers at once

# Libraries know letters, digits and blanks from tables of different ages; of the characters
# below U+0250, none is classed otherwise by any. Texts with others go the slower way.
UNCERTAIN = re.compile("[^\t\n\r -~\u00a1-\u024f]")


def byte_of_character() -> dict[str, int]:
    """The visible characters by which a byte-level vocabulary spells bytes.

    Bytes with a visible Latin-1 character stand for themselves; the others, in order, are
    the characters from U+0100 on.
    """
    seen = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE]
    rest = [b for b in range(256) if b not in set(seen)]
    return {chr(b): b for b in seen} | {chr(0x100 + i): b for i, b in enumerate(rest)}


@dataclass
class Side:
    """A tokenizer's bytes by id, and their lengths."""

    entries: list[bytes]

    def __post_init__(self):
        self.length = np.array([len(x) for x in self.entries], np.int64)


class Tokenizers:
    """Both tokenizers, opened from the contents of their files (in each worker once)."""

    def __init__(self, byte_level: str, pieces: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(byte_level)
        self.a.encode_special_tokens = True
        self.fast = ranked(byte_level)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        spelled = byte_of_character()
        vocabulary = self.a.get_vocab(with_added_tokens=False)
        entries = [b""] * (max(vocabulary.values()) + 1)
        for entry, i in vocabulary.items():
            entries[i] = bytes(spelled[c] for c in entry) if all(c in spelled for c in entry) else entry.encode()
        self.side_a = Side(entries)
        self.side_b = Side([self._piece(i) for i in range(self.b.get_piece_size())])
        self.names_a = _names(len(self.side_a.entries), "|")
        self.names_b = _names(len(self.side_b.entries), ";")

    def _piece(self, i: int) -> bytes:
        if self.b.is_control(i):
            return b""
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of both sides, whose bytes are those of a blank and the text; none where they differ."""
        none = np.zeros(0, np.int64)
        held = [i for i, t in enumerate(texts) if t]
        out_a, out_b = [none] * len(texts), [none] * len(texts)
        some = [texts[i] for i in held]
        coded_b = self.b.encode(some, num_threads=1)
        for i, text, y in zip(held, some, coded_b):
            whole, x = b" " + text.encode(), self._encode_a(" " + text)
            one = b"".join(map(self.side_a.entries.__getitem__, x))
            other = b"".join(map(self.side_b.entries.__getitem__, y))
            if one == whole and other == whole:
                out_a[i], out_b[i] = np.array(x, np.int64), np.array(y, np.int64)
        return out_a, out_b


    def _encode_a(self, text: str) -> list[int]:
        if self.fast and not UNCERTAIN.search(text):
            return self.fast.encode_ordinary(text)
        return self.a.encode(text, add_special_tokens=False).ids


def ranked(byte_level: str):
    """The same tokenizer as a faster library has it, or None where that cannot be shown.

    It is the same where the i-th merge makes the entry with the id of its rank and the text
    is split by the pattern of byte-level vocabularies, with nothing done before or after.
    """
    import public_tokenizers
    import tiktoken

    read = json.loads(byte_level)
    model, spelled = read["model"], byte_of_character()
    split = read["pre_tokenizer"] or {}
    plain = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
    merges = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", ())]
    made = [model["vocab"].get("".join(m)) for m in merges]
    own = {k: i for k, i in model["vocab"].items() if all(c in spelled for c in k)}
    singles = sorted(own[c] for c in spelled if c in own)
    if read["normalizer"] or not plain or made != list(range(256, 256 + len(made))) or singles != list(range(256)):
        return None
    ranks = {bytes(spelled[c] for c in k): i for k, i in own.items() if i < 256 + len(made)}
    return tiktoken.Encoding("ranked", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _names(n: int, last: str) -> np.ndarray:
    """Decimal ids followed by a comma, then the same followed by ``last``."""
    return np.array([f"{i}," for i in range(n)] + [f"{i}{last}" for i in range(n)], object)


def ends_before(ends: np.ndarray) -> np.ndarray:
    """For each byte offset up to the last: how many of the rising ``ends`` lie before it."""
    out = np.zeros(int(ends[-1]) + 2, np.int64)
    out[ends + 1] = 1
    return np.cumsum(out)[:-1]


def terminals(end_a: np.ndarray, end_b: np.ndarray) -> np.ndarray:
    """For each token (A, then B): the terminal token of its component.

    Ends are rising byte offsets of tokens that cover the same bytes without gaps.
    """
    n = len(end_a)
    over_a, over_b = ends_before(end_b)[end_a], ends_before(end_a)[end_b]
    farther = end_b[over_a] > end_a
    successor = np.concatenate((np.where(farther, n + over_a, np.arange(n)), over_b))
    while True:
        twice = successor[successor]
        if np.array_equal(twice, successor):
            return successor
        successor = twice


@dataclass
class Aligned:
    """Groups and links of a block: the text of each, and what they hold."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    groups: list[str]
    link_text: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray


def align(ids_a: list[np.ndarray], ids_b: list[np.ndarray], tokenizers: Tokenizers) -> Aligned:
    """Texts' token ids cut into groups (``a1,a2|b1;a3|b2,b3``) and linked."""
    n = len(ids_a)
    n_a, n_b = (np.array([len(x) for x in ids], np.int64) for ids in (ids_a, ids_b))
    a, b = (np.concatenate([*ids, np.zeros(0, np.int64)]) for ids in (ids_a, ids_b))
    zero = np.zeros(n, np.int64)
    if not len(a):
        none = np.zeros(0, np.int64)
        return Aligned(n_a, n_b, zero, zero, [""] * n, none, none, none)
    end_a, end_b = np.cumsum(tokenizers.side_a.length[a]), np.cumsum(tokenizers.side_b.length[b])
    text_a = np.repeat(np.arange(n), n_a)
    terminal = terminals(end_a, end_b)
    n_groups = np.bincount(text_a[terminal[: len(a)] == np.arange(len(a))], minlength=n)

    # a group's A tokens, then its B tokens; the last of either has the sign that follows it
    side = np.concatenate((np.zeros(len(a), np.int64), np.ones(len(b), np.int64)))
    place = terminal * 2 + side
    order = np.argsort(place, kind="stable")
    place = place[order]
    last = np.append(place[1:] != place[:-1], True)
    names = np.empty(len(order), object)
    of_a = order < len(a)
    for mine, own, shift, table in (
        (of_a, a, 0, tokenizers.names_a),
        (~of_a, b, len(a), tokenizers.names_b),
    ):
        names[mine] = table[own[order[mine] - shift] + last[mine] * (len(table) // 2)]
    heads = np.concatenate(([0], np.cumsum(n_a + n_b)))
    names = names.tolist()
    groups = ["".join(names[s:e])[:-1] for s, e in zip(heads[:-1], heads[1:])]

    # between two neighbouring ends lie bytes of exactly one token of either side
    is_end = np.zeros(int(end_a[-1]) + 1, bool)
    is_end[end_a] = is_end[end_b] = True
    ends = np.flatnonzero(is_end)
    at_a, at_b = ends_before(end_a)[ends], ends_before(end_b)[ends]
    link_text = text_a[at_a]
    n_links = np.bincount(link_text, minlength=n)
    return Aligned(n_a, n_b, n_groups, n_links, groups, link_text, a[at_a], b[at_b])


_COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups"]
_FIELDS = "chunk long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string"


def encoded(docs: DataFrame, byte_level: str, pieces: bytes, doc_id: str, text: str, digest: bool) -> DataFrame:
    """Rows of texts (``own`` with ``times``: places in the block's table) and of tables
    (``pairs``, an A id and a B id in one number, with the texts that hold each)."""
    spark = docs.sparkSession
    files = spark.sparkContext.broadcast((byte_level, pieces))
    kinds = [pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int32())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = Tokenizers(*files.value)
        n_b = len(tokenizers.side_b.entries)
        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            for block in W.blocks(batch.column(1), BLOCK):
                rows = batch.slice(block.first, block.n)
                ids_a, ids_b = [], []
                for part in W.blocks(rows.column(1), SLICE):
                    texts = rows.column(1).slice(part.first, part.n).to_pylist()
                    one, other = tokenizers.encode([(t or b"").decode() for t in texts])
                    ids_a += one
                    ids_b += other
                found = align(ids_a, ids_b, tokenizers)
                pairs, place = np.unique(found.link_a * n_b + found.link_b, return_inverse=True)
                own, times = np.unique(found.link_text * max(len(pairs), 1) + place, return_counts=True)
                of, own = np.divmod(own, max(len(pairs), 1))
                held = np.bincount(own, minlength=len(pairs))
                ends = np.concatenate(([0], np.cumsum(np.bincount(of, minlength=block.n)))).astype(np.int32)
                groups = [_sha(g) if digest and g else g for g in found.groups]
                numbers = [found.n_a, found.n_b, found.n_groups, found.n_links]
                per_text = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x.astype(np.int32))) for x in (own, times)]
                nothing = [pa.nulls(block.n, k) for k in kinds[2:]]
                columns = [pa.array(np.full(block.n, chunk)), rows.column(0), *map(pa.array, numbers), pa.array(groups, pa.string())]
                yield pa.RecordBatch.from_arrays([*columns, *per_text, *nothing], schema_names)
                table = [pa.array([x], k) for x, k in zip((pairs, held.astype(np.int32)), kinds[2:])]
                empty = [pa.nulls(1, c.type) for c in columns[1:]] + [pa.nulls(1, k) for k in kinds[:2]]
                yield pa.RecordBatch.from_arrays([pa.array([chunk]), *empty, *table], schema_names)
                chunk += 1

    schema_names = ["chunk", *_COLUMNS, "own", "times", "pairs", "held"]
    read = docs.select(F.col(quoted(doc_id)).cast("long").alias("doc_id"), F.col(quoted(text)).cast("binary"))
    return read.mapInArrow(run, _FIELDS + ", own array<int>, times array<int>, pairs array<long>, held array<int>")


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def pair_counts(tables: DataFrame, n_b: int) -> DataFrame:
    """(pair, n, best): documents that hold the pair linked, and whether no pair of its A id has more."""
    totals = tables.groupBy("pair").agg(F.sum("held").alias("n"))
    a = F.expr(f"pair div {n_b}").alias("a")
    most = totals.groupBy(a).agg(F.max("n").alias("most"))  # a row per A id at most
    return totals.select("*", a).join(F.broadcast(most), "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _summed(key, texts: pa.Table, counts: pa.Table) -> pa.Table:
    """A block's texts with the counts of their links."""
    place = counts.column("place").to_numpy()
    n, best = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
    n[place], best[place] = counts.column("n").to_numpy(), counts.column("best").to_numpy(zero_copy_only=False)
    sums = [[], []]
    for own, times in zip(texts.column("own"), texts.column("times")):
        own, times = (x.values.to_numpy() for x in (own, times))
        sums[0].append(int(times @ best[own]) if len(own) else 0)
        sums[1].append(int(times @ n[own]) if len(own) else 0)
    out = texts.select(_COLUMNS)
    for name, values in zip(("n_best", "count_sum"), sums):
        out = out.append_column(name, pa.array(values, pa.int64()))
    return out


def aligned(
    docs: DataFrame, byte_level: str, pieces: str, doc_id: str = "doc_id", text: str = "text", digest: bool = False
) -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, groups, n_best, count_sum.

    ``byte_level`` and ``pieces`` are the paths of the two tokenizers' files, which the
    driver reads. ``groups`` is the text of the groups; with ``digest`` its SHA-256.
    """
    with open(byte_level, encoding="utf-8") as one, open(pieces, "rb") as other:
        files = one.read(), other.read()
    n_b = len(Tokenizers(*files).side_b.entries)
    base = stored(encoded(docs, *files, doc_id, text, digest), "tokens")
    tables = (
        base.filter("pairs is not null")
        .select("chunk", F.posexplode(F.arrays_zip("pairs", "held")).alias("place", "p"))
        .select("chunk", "place", F.col("p.pairs").alias("pair"), F.col("p.held").alias("held"))
    )
    counts = stored(pair_counts(tables, n_b), "pairs")
    back = tables.drop("held").join(counts, "pair").select(F.col("chunk").alias("block"), "place", "n", "best")
    texts = base.filter("pairs is null").select("chunk", *_COLUMNS, "own", "times")
    schema = _FIELDS.removeprefix("chunk long, ") + ", n_best long, count_sum long"
    return texts.groupBy("chunk").cogroup(back.groupBy("block")).applyInArrow(_summed, schema)
