"""WARC archives of Zstandard frames: one frame per record, the dictionary in a leading skippable frame.

Writing: records with equal payloads are one response, of the largest page_id, and revisits that refer to
it. Tasks write their archives to the shared folder under names no other attempt uses and return a
manifest; readers open what the manifest of the finished job lists, so archives of lost or repeated
attempts don't count. Reading: a task streams one archive at a time, loads the dictionary, decodes frame
by frame and checks each record; it holds one record in memory.

Copies are found by SHA-256 and length. Their groups are combined before the shuffle, and the join that
tells each row its response salts its keys, so a payload that a third of all rows share is spread.

Defined cases: a null payload is empty; empty payloads are equal payloads like any other from
`min_bytes` = 0. Repeated page_ids with equal payloads are all responses if they are the largest. A
null page_id counts as smallest and refers to nothing if it is alone. Null target URIs are left out.
Line breaks in a URI are percent-encoded. No rows give no archives and no records. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.storage import open_folder
from shelfline.session import materialize, shared_path

SKIPPABLE = 0x184D2A5D
ARCHIVE_BYTES = 64 << 20
DICTIONARY_BYTES = 1 << 15
#: Text from which an archive's dictionary is trained: its first records, so many bytes.
SAMPLE_BYTES = 1 << 20
SALTS = 16
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"
_FRAME = b"\x28\xb5\x2f\xfd"


class WarcError(ValueError):
    """An archive or a record that breaks the format."""


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str = DATE) -> bytes:
    """A response record, or a revisit if `refers_to` is given: its HTTP headers without the payload."""
    revisit = refers_to is not None
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload))
    block = http if revisit else http + payload
    headers = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _record_id(page_id)),
               ("WARC-Date", date), ("WARC-Payload-Digest", "sha1:" + digest(payload)),
               ("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    if url is not None:
        headers.insert(2, ("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    if revisit:
        headers[-2:-2] = [("WARC-Profile", PROFILE), ("WARC-Refers-To", _record_id(refers_to))]
    return "".join(["WARC/1.1\r\n", *(f"{k}: {v}\r\n" for k, v in headers), "\r\n"]).encode() + block + b"\r\n\r\n"


def _record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page_id(record_id: str) -> int | None:
    if not (record_id.startswith("<urn:page:") and record_id.endswith(">")):
        raise WarcError(f"unknown record id {record_id}")
    return int(record_id[10:-1]) if len(record_id) > 11 else None


def parse_record(raw: bytes) -> dict:
    """The fields of one record; raises WarcError where headers, lengths or digests don't hold."""
    head, gap, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not gap or lines[0] not in ("WARC/1.0", "WARC/1.1"):
        raise WarcError("no WARC header")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or not name.strip():
            raise WarcError(f"bad header line {line!r}")
        fields[name.strip().lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in fields:
            raise WarcError(f"{name} is missing")
    if not fields["content-length"].isascii() or not fields["content-length"].isdigit():
        raise WarcError("Content-Length is no number")
    size = int(fields["content-length"])
    block, tail = rest[:size], rest[size:]
    if len(block) != size or tail != b"\r\n\r\n":
        raise WarcError("Content-Length and record differ")
    found = {"record_type": fields["warc-type"], "record_id": fields["warc-record-id"],
             "target_uri": fields.get("warc-target-uri"), "refers_to": fields.get("warc-refers-to")}
    if found["record_type"] in ("response", "revisit"):
        http, gap, payload = block.partition(b"\r\n\r\n")
        sizes = [line.split(b":", 1)[1].strip() for line in http.split(b"\r\n") if line.lower().startswith(b"content-length:")]
        if not gap or not http.startswith(b"HTTP/") or len(sizes) != 1 or not sizes[0].isdigit():
            raise WarcError("no HTTP header with one Content-Length")
        stated = fields.get("warc-payload-digest", "").removeprefix("sha1:")
        if found["record_type"] == "response" and (len(payload) != int(sizes[0]) or digest(payload) != stated):
            raise WarcError("payload and its length or digest differ")
        if found["record_type"] == "revisit" and (payload or not found["refers_to"]):
            raise WarcError("a revisit has a payload or refers to nothing")
        found |= {"payload_bytes": int(sizes[0]), "payload_digest": stated, "payload": payload}
    return found


def archive_dictionary(samples: list[bytes]) -> bytes:
    """A dictionary trained on records, or the first record itself if there are too few to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return (samples[0] if samples else b"WARC/1.1\r\n")[:DICTIONARY_BYTES]


def dictionary_frame(dictionary: bytes) -> bytes:
    body = zstandard.ZstdCompressor().compress(dictionary)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def read_records(stream) -> Iterator[bytes]:
    """The records of an archive, one frame each, from an open file."""
    head = _exactly(stream, 4)
    dictionary, pending = None, head
    if len(head) == 4 and struct.unpack("<I", head)[0] == SKIPPABLE:
        body = _exactly(stream, struct.unpack("<I", _exactly(stream, 4))[0])
        if body[:4] == _FRAME:
            body = zstandard.ZstdDecompressor().decompressobj().decompress(body)
        dictionary, pending = zstandard.ZstdCompressionDict(body), b""
    context = zstandard.ZstdDecompressor(dict_data=dictionary)
    while True:
        pending = pending or stream.read(1 << 16)
        if not pending:
            return
        frame, parts = context.decompressobj(), []
        while not frame.eof:
            pending = pending or stream.read(1 << 16)
            if not pending:
                raise WarcError("the last frame is cut short")
            try:
                parts.append(frame.decompress(pending))
            except zstandard.ZstdError as error:
                raise WarcError(f"bad frame: {error}") from error
            pending = frame.unused_data if frame.eof else b""
        yield b"".join(parts)


def _exactly(stream, n: int) -> bytes:
    got = b""
    while len(got) < n and (more := stream.read(n - len(got))):
        got += more
    return got


def with_response(df: DataFrame, page_id: str, payload: str, min_bytes: int = 0) -> DataFrame:
    """`df` with `__refers_to`: the largest page_id of an equal payload where that is another row's, else null."""
    body = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    key = [F.sha2(body, 256).alias("__sha"), F.octet_length(body).cast("long").alias("__size")]
    groups = (df.select(*key, F.col(page_id).alias("__id")).groupBy("__sha", "__size")
              .agg(F.max("__id").alias("__largest"), F.count("*").alias("__n"))
              .where((F.col("__n") > 1) & (F.col("__size") >= min_bytes))
              .select("__sha", "__size", "__largest", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("__salt")))
    salted = df.select("*", *key, F.pmod(F.xxhash64(F.col(page_id)), F.lit(SALTS)).cast("int").alias("__salt"))
    joined = salted.join(groups, ["__sha", "__size", "__salt"], "left")
    other = ~F.col("__largest").eqNullSafe(F.col(page_id)) & F.col("__largest").isNotNull()
    return joined.select(*df.columns, F.when(other, F.col("__largest")).alias("__refers_to"))


def write_archives(df: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", payload: str = "html",
                   min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write all rows as records; the written manifest (path, records, bytes). Runs a job when called."""
    given = df.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
                      F.col(payload).alias("payload"))

    def task(batches):
        system, inner = open_folder(folder)
        system.create_dir(inner, recursive=True)
        context = TaskContext.get()
        name = f"{inner}/pages-{context.partitionId():06d}-{uuid.uuid4().hex}"
        made, out, size, count, compressor, held = [], None, 0, 0, None, []

        def start():
            nonlocal out, size, count, compressor
            dictionary = archive_dictionary(held)
            compressor = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary), write_checksum=True)
            path = f"{name}-{len(made):04d}.warc.zst"
            out, count = system.open_output_stream(path, compression=None), 0
            made.append([path, 0, 0])
            lead = dictionary_frame(dictionary)
            out.write(lead)
            size = len(lead)

        def put(raw: bytes):
            nonlocal size, count
            frame = compressor.compress(raw)
            out.write(frame)
            size, count = size + len(frame), count + 1

        def finish():
            nonlocal out, held
            out.close()
            made[-1][1:] = [count, size]
            out, held = None, []

        waiting = 0
        for batch in batches:
            for i in range(batch.num_rows):
                page, target, text, refers = (batch.column(c)[i].as_py() for c in range(4))
                raw = record_bytes(page, target, (text or "").encode(), refers)
                if out is None:
                    held.append(raw)
                    waiting += len(raw)
                    if waiting < min(SAMPLE_BYTES, archive_bytes):
                        continue
                    start()
                    for x in held:
                        put(x)
                    held, waiting = [], 0
                else:
                    put(raw)
                if size >= archive_bytes:
                    finish()
        if held:
            start()
            for x in held:
                put(x)
        if out is not None:
            finish()
        yield pa.RecordBatch.from_arrays(
            [pa.array([f"{folder}/{p.rsplit('/', 1)[1]}" for p, _, _ in made], pa.string()),
             pa.array([n for _, n, _ in made], pa.int64()), pa.array([b for _, _, b in made], pa.int64())],
            names=["path", "records", "bytes"])

    linked = with_response(given, "page_id", "payload", min_bytes)
    return materialize(linked.mapInArrow(task, "path string, records long, bytes long"), "warc-manifest")


READ_TASKS = 20_000


def read_archives(manifest: DataFrame, payloads: bool = False) -> DataFrame:
    """One row for each record of the archives that `manifest` lists; a broken record fails the read.

    The number of records read from an archive must be the manifest's, where that has a count. The archives are
    counted when called, and dealt out over as many tasks, `READ_TASKS` at most.
    """
    counted = F.col("records") if "records" in manifest.columns else F.lit(None).cast("long")
    schema = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
              "target_uri string" + ", payload binary" * payloads)
    names = [f.split()[0] for f in schema.split(", ")]

    def task(batches):
        for batch in batches:
            for path, expected in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                system, inner = open_folder(path)
                rows, held, n = [], 0, 0
                with system.open_input_stream(inner, compression=None) as stream:  # a name in .zst must not unpack it
                    for raw in read_records(stream):
                        found = parse_record(raw)
                        n += 1
                        found["page_id"] = _page_id(found["record_id"])
                        found["refers_to"] = _page_id(found["refers_to"]) if found["refers_to"] else None
                        rows.append([found.get(x) for x in names])
                        held += len(raw) if payloads else 200
                        if held >= 1 << 22:
                            yield _batch(rows, schema)
                            rows, held = [], 0
                if expected is not None and expected != n:
                    raise WarcError(f"{path} has {n} records, not {expected}")
                if rows:
                    yield _batch(rows, schema)

    files = manifest.select("path", counted.alias("records"))
    # With a number, the few bytes of the paths aren't merged into one partition.
    return files.repartition(max(1, min(files.count(), READ_TASKS)), "path").mapInArrow(task, schema)


_KINDS = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}


def _batch(rows: list[list], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(column, _KINDS[kind]) for column, (_, kind) in zip(zip(*rows), fields)],
                                      names=[n for n, _ in fields])


def archive_folder(spark) -> str:
    return shared_path(spark, "warc")
