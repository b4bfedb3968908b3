"""Chat records of many layouts turned into canonical turns, formatted, and read back.

The fingerprint of a JSON record is a hash of its sorted nested field paths (``[]`` for
list items). A mapping says, for one set of paths, where roles and texts are; the
fingerprint of the set selects it. The template writes a turn as

    <|turn|>role<|text|>text<|end|>

and puts a backslash into every control string inside a role or a text, and before every
backslash, so that ``unescape`` gives back what was there.

Cases: a record that is null, no JSON object, or of unknown paths has null turns (and its
fingerprint, for a report); null texts are empty, null roles too; an empty table gives an
empty result; turns with equal numbers are ordered by role and text; other columns pass
through, whatever their names.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.llm.frames import cols, fresh, quoted

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
LEARNED_ROLE = "assistant"
# the first character of a control string of this or of other templates
_CONTROL = re.compile(r"\\|<(?=\||/?s>|</?SYS>>|<SYS>>)|\[(?=/?INST\])|\|(?=>)")
_FORMATTED = re.compile(r"<\|turn\|>(.*?)<\|text\|>(.*?)<\|end\|>", re.DOTALL)


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    """Undoes ``escape``: a backslash is followed by another, or was put in."""
    return _UNDO.sub(lambda m: "\\" if m[0] == "\\\\" else "", text)


_UNDO = re.compile(r"\\\\|\\")


@dataclass(frozen=True)
class Mapping:
    """Turns of one layout: ``fixed`` lists (role, path), or ``each`` walks a list.

    A path is dotted; several joined by ``+`` give their non-empty texts, parted by an
    empty line. ``each`` is (list path, role field, text field).
    """

    name: str
    paths: tuple[str, ...]
    fixed: tuple[tuple[str, str], ...] = ()
    each: tuple[str, str, str] | None = None
    roles: dict[str, str] = field(default_factory=dict)

    @property
    def fingerprint(self) -> str:
        return digest_paths(self.paths)

    def turns(self, record: dict) -> list[tuple[str, str]]:
        out = []
        for role, path in self.fixed:
            parts = [_text(_at(record, p)) for p in path.split("+")]
            out.append((role, parts[0] if len(parts) == 1 else "\n\n".join(p for p in parts if p)))
        if self.each:
            where, role, text = self.each
            for item in _at(record, where) or []:
                said = _text(item.get(role))
                out.append((self.roles.get(said, said), _text(item.get(text))))
        return out


def _at(record, path: str):
    for part in path.split("."):
        record = record.get(part) if isinstance(record, dict) else None
    return record


def _text(value) -> str:
    return "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def field_paths(value, prefix: str = "") -> set[str]:
    """Dotted paths of all leaves; items of a list share the path of the list with []."""
    if isinstance(value, dict):
        return set().union(*(field_paths(v, f"{prefix}.{k}" if prefix else k) for k, v in value.items()), set())
    if isinstance(value, list):
        return set().union({prefix + "[]"} if not value else set(), *(field_paths(v, prefix + "[]") for v in value))
    return {prefix}


def digest_paths(paths) -> str:
    return hashlib.blake2b("\n".join(sorted(paths)).encode(), digest_size=8).hexdigest()


# Names that other layouts use for the same roles.
_SPEAKERS = {"human": "user", "gpt": "assistant", "bot": "assistant"}
MAPPINGS = (
    Mapping("prompt", ("prompt",), fixed=(("user", "prompt"),)),
    Mapping("completion", ("completion",), fixed=(("assistant", "completion"),)),
    Mapping("prompt pair", ("prompt", "completion"), fixed=(("user", "prompt"), ("assistant", "completion"))),
    Mapping("response pair", ("prompt", "response"), fixed=(("user", "prompt"), ("assistant", "response"))),
    Mapping("question", ("question", "answer"), fixed=(("user", "question"), ("assistant", "answer"))),
    Mapping("system", ("system",), fixed=(("system", "system"),)),
    Mapping(
        "instruction",
        ("instruction", "input", "output"),
        fixed=(("user", "instruction+input"), ("assistant", "output")),
    ),
    Mapping("bare instruction", ("instruction", "output"), fixed=(("user", "instruction"), ("assistant", "output"))),
    Mapping(
        "nested data",
        ("data.instruction", "data.response"),
        fixed=(("user", "data.instruction"), ("assistant", "data.response")),
    ),
    Mapping("messages", ("messages[].role", "messages[].content"), each=("messages", "role", "content")),
    Mapping(
        "conversations",
        ("conversations[].from", "conversations[].value"),
        each=("conversations", "from", "value"),
        roles=_SPEAKERS,
    ),
)

_TURNS = T.ArrayType(T.StructType([T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]))


def canonical_turns(
    df: DataFrame, record: str = "record", mappings: tuple[Mapping, ...] = MAPPINGS, out: str = "turns"
) -> DataFrame:
    """``df`` with ``out`` (array of role and text) and ``<out>_fingerprint``."""
    by_print = {m.fingerprint: m for m in mappings}
    names = [out, f"{out}_fingerprint"]
    schema = T.StructType(
        [*df.schema.fields, T.StructField(names[0], _TURNS), T.StructField(names[1], T.StringType())]
    )
    at = df.columns.index(record)
    kind = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            turns, prints = [], []
            for raw in batch.column(at).to_pylist():
                try:
                    value = json.loads(raw) if raw is not None else None
                except ValueError:
                    value = None
                found = digest_paths(field_paths(value)) if isinstance(value, dict) else None
                chosen = by_print.get(found)
                prints.append(found)
                turns.append([{"role": r, "text": t} for r, t in chosen.turns(value)] if chosen else None)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(turns, kind), pa.array(prints, pa.string())], schema.names
            )

    return df.mapInArrow(run, schema)


def unmapped(df: DataFrame, turns: str = "turns") -> DataFrame:
    """Records that no mapping took, as (fingerprint, n_records); a null fingerprint stands for
    records that are null or no JSON object. ``read_back`` leaves them out, so a job that must
    keep all its records asks for none here."""
    return (
        df.filter(F.col(quoted(turns)).isNull())
        .groupBy(F.col(quoted(f"{turns}_fingerprint")).alias("fingerprint"))
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def format_turns(turns: list[tuple[str, str]]) -> str:
    return "".join(f"{TURN}{escape(r)}{TEXT}{escape(t)}{END}" for r, t in turns)


def loss_spans(formatted: str, role: str = LEARNED_ROLE) -> list[tuple[int, int]]:
    """Code points of the (escaped) texts of the role that is learned from."""
    return [m.span(2) for m in _FORMATTED.finditer(formatted) if unescape(m[1]) == role]


def formatted(df: DataFrame, turns: str = "turns", out: str = "formatted") -> DataFrame:
    """``df`` with the formatted turns and ``<out>_loss``, spans of the loss mask."""
    spans = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    schema = T.StructType(
        [*df.schema.fields, T.StructField(out, T.StringType()), T.StructField(f"{out}_loss", spans)]
    )
    at = df.columns.index(turns)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, masks = [], []
            for found in batch.column(at).to_pylist():
                text = None if found is None else format_turns([(t["role"] or "", t["text"] or "") for t in found])
                texts.append(text)
                masks.append(None if text is None else [{"start": a, "end": b} for a, b in loss_spans(text)])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string()), pa.array(masks, kind)], schema.names
            )

    return df.mapInArrow(run, schema)


def read_back(df: DataFrame, conversation: str, order: list[str], text: str = "formatted") -> DataFrame:
    """Per conversation, digests of what its formatted fragments, in order, say.

    Rows are sorted inside partitions and read as a stream, so that a conversation of any
    length takes the memory of one batch. Columns: the conversation, n_turns,
    turns_sha256, loss_chars, loss_sha256, formatted_chars.
    """
    (name,) = fresh(df.select(*cols([conversation])), "_formatted")
    mask = F.col(quoted(f"{text}_loss"))
    spread = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    read = (
        df.filter(F.col(quoted(text)).isNotNull())
        .repartition(spread, quoted(conversation))
        .sortWithinPartitions(quoted(conversation), *cols(order), quoted(text))
        .select(quoted(conversation), F.col(quoted(text)).alias(name), mask.alias("mask"))
    )
    more = T.StructType.fromDDL(
        "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )
    schema = T.StructType([df.schema[conversation], *more.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, started, own = None, False, None
        turns = loss = None
        n = chars = size = 0
        rows: list[tuple] = []

        def flush() -> pa.RecordBatch:
            columns = list(zip(*rows)) if rows else [[]] * 6
            arrays = [pa.array(columns[0], kind), *(
                pa.array(c, t) for c, t in zip(columns[1:], (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()))
            )]
            rows.clear()
            return pa.RecordBatch.from_arrays(arrays, schema.names)

        def close() -> None:
            rows.append((own, n, turns.hexdigest(), chars, loss.hexdigest(), size))

        for batch in batches:
            kind = batch.schema.field(0).type
            for key, said, mask in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if not started or key != own:
                    if started:
                        close()
                    started, own, n, chars, size = True, key, 0, 0, 0
                    turns, loss = hashlib.sha256(), hashlib.sha256()
                size += len(said)
                for m in _FORMATTED.finditer(said):
                    turns.update(f"{unescape(m[1])}\n{unescape(m[2])}\n".encode())
                    n += 1
                for span in mask:
                    learned = unescape(said[span["start"] : span["end"]])
                    chars += len(learned)
                    loss.update(learned.encode())
            if rows:
                yield flush()
        if started:
            close()
            yield flush()

    return read.mapInArrow(run, schema)
