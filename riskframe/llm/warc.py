"""WARC archives: written, normalised from one gzip stream to a member per record, read.

``write_archives`` writes each partition's records as one monolithic gzip stream, as
many crawls were stored. ``normalise`` inflates every such file once, from start to end,
and rewrites each record as a gzip member of its own, with a sidecar index of offsets;
bodies are passed on in pieces, so memory does not follow the size of a record.
``read_archives`` goes through the index: members are independent, so a large archive is
read by many tasks.

Files go to a folder that all executors share, through pyarrow's file systems. A task
writes under a name of its own attempt and reports it; only reported files are read, so
an attempt that failed leaves nothing that counts.

Cases: a null page is empty; a null url writes no target; line ends in a url are
percent-encoded; equal payloads under ``least_revisit`` bytes are all responses, larger
ones revisit the page with the largest id (rows that repeat that id are responses too);
a null id is never the largest unless all are null, and such rows are then responses; an
empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import io
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.frames import quoted, shared_folder, stored

LEAST_REVISIT = 1000
PIECE = 1 << 18
LEVEL = 1
GZIP = 31  # zlib's window bits for a gzip wrapper
DATE = "2024-01-01T00:00:00Z"
URN = "urn:x-page:"


def typed_pages(pages: DataFrame, page_id: str, url: str, html: str, least_revisit: int) -> DataFrame:
    """page_id, url, payload, digest, record_type, refers_to."""
    raw = F.coalesce(F.col(quoted(html)).cast("binary"), F.lit(b""))
    named = pages.select(
        F.col(quoted(page_id)).cast("long").alias("page_id"),
        F.col(quoted(url)).cast("string").alias("url"),
        raw.alias("payload"),
        F.sha1(raw).alias("digest"),
        F.octet_length(raw).cast("long").alias("size"),
    )
    first = (
        named.filter(F.col("size") >= least_revisit)
        .groupBy("digest", "size")
        .agg(F.max("page_id").alias("target"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .drop("n")
    )
    revisit = F.col("target").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("target"))
    return named.join(first, ["digest", "size"], "left").select(
        "page_id",
        "url",
        "payload",
        "digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("target")).alias("refers_to"),
    )


def record(page_id, url, payload: bytes, digest: str, kind: str, refers_to) -> bytes:
    """One WARC record; a revisit keeps the HTTP head of its payload and not the payload."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    body = head.encode() + (payload if kind == "response" else b"")
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{URN}{'' if page_id is None else page_id}>"]
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    lines += [f"WARC-Date: {DATE}", "WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()]
    if kind == "revisit":
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: <{URN}{refers_to}>")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}", "", ""]
    return "\r\n".join(lines).encode() + body + b"\r\n\r\n"


def headers(block: bytes) -> dict[str, str]:
    """Header names in lower case to values, of the lines after the first."""
    found = {}
    for line in block.split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if colon:
            found[name.strip().lower().decode()] = value.strip().decode()
    return found


def _store(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def _attempt() -> str:
    task = TaskContext.get()
    return f"{task.partitionId():06d}-{task.taskAttemptId()}"


def write_archives(typed: DataFrame, folder: str, level: int = LEVEL) -> DataFrame:
    """One gzip stream per non-empty partition; rows are (path, n_records)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, out, packer, n = f"{folder}/raw-{_attempt()}.warc.gz", None, None, 0
        for batch in batches:
            for row in range(batch.num_rows):
                if out is None:
                    store, place = _store(folder)
                    store.create_dir(place, recursive=True)
                    out = store.open_output_stream(f"{place}/{path.rsplit('/', 1)[1]}", compression=None)
                    packer = zlib.compressobj(level, zlib.DEFLATED, GZIP)
                values = [batch.column(i)[row].as_py() for i in range(6)]
                out.write(packer.compress(record(*values)))
                n += 1
        if out is not None:
            out.write(packer.flush())
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([n])], ["path", "n_records"])

    ordered = typed.select("page_id", "url", "payload", "digest", "record_type", "refers_to")
    return ordered.mapInArrow(run, "path string, n_records long")


def inflated(source) -> Iterator[bytes]:
    """The bytes of a gzip file, member after member if there are several.

    A file that stops inside a member, or before its check sum, is refused.
    """
    unpacker, piece = None, source.read(PIECE)
    while True:
        while piece:
            if unpacker is None or unpacker.eof:
                unpacker = zlib.decompressobj(GZIP)
            yield unpacker.decompress(piece, PIECE)
            piece = unpacker.unused_data if unpacker.eof else unpacker.unconsumed_tail
        piece = source.read(PIECE)
        if not piece:
            if unpacker is None or unpacker.eof:
                return
            yield unpacker.flush()
            if not unpacker.eof:
                raise ValueError("the archive ends inside a gzip stream")
            piece = unpacker.unused_data


def rewrite(source, out, level: int = LEVEL) -> Iterator[tuple[int, int, str, str]]:
    """Each record of ``source`` as a member of ``out``: (offset, length, type, id)."""
    held, at = bytearray(), 0
    left, member, begun, known = -1, None, 0, {}

    def put(data: bytes) -> None:
        nonlocal at
        out.write(data)
        at += len(data)

    for piece in inflated(source):
        held += piece
        while held:
            if left < 0:
                stop = held.find(b"\r\n\r\n")
                if stop < 0:
                    break
                known = headers(bytes(held[:stop]))
                # the head, the body, and the two line ends behind it
                left = stop + 4 + int(known["content-length"]) + 4
                begun, member = at, zlib.compressobj(level, zlib.DEFLATED, GZIP)
            take = bytes(held[:left])
            del held[: len(take)]
            left -= len(take)
            put(member.compress(take))
            if left == 0:
                put(member.flush())
                yield begun, at - begun, known["warc-type"], known["warc-record-id"]
                left = -1
    if left >= 0 or held:
        raise ValueError("the archive ends inside a record")


def normalise(archives: DataFrame, folder: str, level: int = LEVEL) -> DataFrame:
    """A member per record and a sidecar index for each archive: (path, index, n_records)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, place = _store(path)
                target, goal = _store(folder)
                target.create_dir(goal, recursive=True)
                name = path.rsplit("/", 1)[1].removeprefix("raw-").removesuffix(".warc.gz") + f"-{_attempt()}"
                n = 0
                with (
                    store.open_input_stream(place, compression=None) as source,
                    target.open_output_stream(f"{goal}/{name}.warc.gz", compression=None) as out,
                    target.open_output_stream(f"{goal}/{name}.idx", compression=None) as index,
                ):
                    for entry in rewrite(source, out, level):
                        index.write(("\t".join(map(str, entry)) + "\n").encode())
                        n += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f"{folder}/{name}.warc.gz"]), pa.array([f"{folder}/{name}.idx"]), pa.array([n])],
                    ["path", "index", "n_records"],
                )

    return archives.mapInArrow(run, "path string, index string, n_records long")


def index_entries(archives: DataFrame) -> DataFrame:
    """The sidecar entries: path, offset, length, type, id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, index in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                store, place = _store(index)
                with store.open_input_stream(place, compression=None) as source:
                    text = io.TextIOWrapper(source, "utf-8")
                    while lines := text.readlines(PIECE):
                        parts = [x.rstrip("\n").split("\t") for x in lines]
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([path] * len(parts)),
                                pa.array([int(p[0]) for p in parts]),
                                pa.array([int(p[1]) for p in parts]),
                                pa.array([p[2] for p in parts]),
                                pa.array([p[3] for p in parts]),
                            ],
                            ["path", "offset", "length", "type", "id"],
                        )

    return archives.select("path", "index").mapInArrow(
        run, "path string, offset long, length long, type string, id string"
    )


def _page(urn: str | None) -> int | None:
    number = (urn or "").strip("<>").removeprefix(URN)
    return int(number) if number else None


def parse(data: bytes) -> tuple:
    """(page_id, url, payload, payload_bytes, digest, type, refers_to) of one record."""
    stop = data.index(b"\r\n\r\n")
    known = headers(data[:stop])
    body = data[stop + 4 : stop + 4 + int(known["content-length"])]
    cut = body.index(b"\r\n\r\n")
    payload, http = body[cut + 4 :], headers(body[:cut])
    kind = known["warc-type"]
    if kind == "response":
        size, digest = len(payload), hashlib.sha1(payload).hexdigest()
    else:
        size = int(http["content-length"])
        digest = base64.b32decode(known["warc-payload-digest"].removeprefix("sha1:")).hex()
    refers = _page(known.get("warc-refers-to"))
    return _page(known["warc-record-id"]), known.get("warc-target-uri"), payload, size, digest, kind, refers


def read_archives(archives: DataFrame, run_bytes: int = 4 << 20) -> DataFrame:
    """Every record of normalised archives, read member by member through the index."""
    schema = (
        "page_id long, url string, payload binary, payload_bytes long, payload_digest string, "
        "record_type string, refers_to long"
    )
    kinds = [pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_path, source = None, None
        for batch in batches:
            rows, size = [], 0
            for path, offset, length in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if path != open_path:
                    store, place = _store(path)
                    open_path, source = path, store.open_input_file(place)
                rows.append(parse(zlib.decompress(source.read_at(length, offset), GZIP)))
                size += len(rows[-1][2])
                if size >= 1 << 22:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    names = [x.split()[0] for x in schema.split(", ")]
    entries = index_entries(archives).select(
        "path", "offset", "length", F.floor(F.col("offset") / run_bytes).alias("run")
    )
    spread = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = entries.repartition(spread, "path", "run").sortWithinPartitions("path", "offset")
    return placed.select("path", "offset", "length").mapInArrow(run, schema)


def archive(
    pages: DataFrame,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    least_revisit: int = LEAST_REVISIT,
) -> DataFrame:
    """Writes ``pages`` as monolithic archives and normalises them: (path, index, n_records).

    Pages are written where the search for equal payloads leaves them, so an archive is
    as large as a partition of that join, which Spark sizes
    (spark.sql.adaptive.advisoryPartitionSizeInBytes).
    """
    spark = pages.sparkSession
    folder = shared_folder(spark, "warc")
    typed = typed_pages(pages, page_id, url, html, least_revisit)
    raw = stored(write_archives(typed, f"{folder}/raw"), "raw-archives")
    # one archive to a task
    whole = raw.repartition(max(1, raw.count()))
    return stored(normalise(whole, f"{folder}/archives"), "archives")
