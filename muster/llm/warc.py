"""WARC archives of Zstandard frames, with a dictionary in the leading skippable frame.

Writing: every page becomes one WARC/1.1 record in a frame of its own, compressed with a dictionary that is trained
on the first records of its archive. Of the records with equal payloads of at least `least` bytes that with the
largest page_id is the response; the others are revisits that refer to it and hold no payload. An archive is one row
(archive, records, content), bounded in bytes, so archives pass through any store that Spark reads and writes.

Reading: the dictionary is taken from the leading skippable frame, plain or itself compressed; each frame is decoded
by itself and must hold exactly one record, whose version line, required headers, Content-Length, HTTP length and
payload digest are checked. What is wrong stands in `problem` (null if nothing), and the next frame is read. A frame
that can't be decoded ends its archive, with one row that says so. Files of this format, read with the binaryFile
source, are read in the same way.

Null html: empty payload. Pages with equal page_id and payload are all responses; a null page_id never refers or is
referred to. Empty input: no archives. Other columns of the input are not stored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from muster.llm.common import written

#: Fixed values of the formats.
SKIPPABLE = 0x184D2A5D
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")

ARCHIVES = "archive string, records int, content binary"
RECORDS = "archive string, record_type string, page_id bigint, url string, payload_bytes bigint, payload_digest string, refers_to bigint, problem string"
DATE = "2024-01-01T00:00:00Z"
ID = "<urn:page:{}>"


def revisits(pages: DataFrame, least: int) -> DataFrame:
    """(page_id, payload key, refers_to) of the pages that are stored as revisits."""
    payload = F.coalesce("html", F.lit(""))
    small = pages.select("page_id", F.octet_length(payload).alias("size"), F.sha2(payload, 256).alias("key")).where(F.col("size") >= least)
    best = small.groupBy("key").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1").drop("n")
    return small.join(best, "key").where("page_id < refers_to").select("page_id", "key", "refers_to").distinct()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """The bytes of one record."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    if refers_to is None:
        block += payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {ID.format('' if page_id is None else page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {' '.join(url.split())}")
    if refers_to is not None:
        lines += [f"WARC-Refers-To: {ID.format(refers_to)}", f"WARC-Profile: {REVISIT_PROFILE}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def packed(records: list[bytes], level: int, dictionary_bytes: int, samples: int) -> bytes:
    """One archive. Too few or too small records train no dictionary; the archive then has plain frames."""
    import zstandard

    trained, lead = None, b""
    some, held = [], 0
    for r in records[:samples]:
        if held > 64 * dictionary_bytes:
            break
        some.append(r[: 8 * dictionary_bytes])  # what trains the dictionary; records are stored whole
        held += len(some[-1])
    if len(some) >= 16 and held >= 2 * dictionary_bytes:
        try:
            trained = zstandard.train_dictionary(dictionary_bytes, some, k=256, d=8)
        except zstandard.ZstdError:
            trained = None
    if trained is not None:
        body = zstandard.ZstdCompressor(level=level).compress(trained.as_bytes())
        lead = SKIPPABLE.to_bytes(4, "little") + len(body).to_bytes(4, "little") + body
        trained.precompute_compress(level=level)
    engine = zstandard.ZstdCompressor(level=level, dict_data=trained, write_checksum=True)
    return lead + b"".join(map(engine.compress, records))


def write(pages: DataFrame, least: int = 1000, level: int = 3, archive_bytes: int = 8 << 20, dictionary_bytes: int = 16 << 10, samples: int = 128) -> DataFrame:
    """The archives of the pages (page_id, url, html), each of about archive_bytes before compression."""
    keyed = pages.select("page_id", "url", "html").withColumn("key", F.sha2(F.coalesce("html", F.lit("")), 256))
    found = keyed.join(revisits(pages, least), ["page_id", "key"], "left").select("page_id", "url", "html", "refers_to")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, n = TaskContext.get().partitionId(), 0
        held: list[bytes] = []
        size = 0

        def row() -> pa.RecordBatch:
            content = packed(held, level, dictionary_bytes, samples)
            return pa.RecordBatch.from_arrays([pa.array([f"part-{task:05d}-{n:05d}.warc.zst"]), pa.array([len(held)], pa.int32()), pa.array([content], pa.binary())], ["archive", "records", "content"])

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                for page_id, url, html, refers_to in zip(*(part.column(i).to_pylist() for i in range(4)), strict=True):
                    held.append(record(page_id, url, (html or "").encode(), refers_to))
                    size += len(held[-1])
                    if size >= archive_bytes:
                        yield row()
                        held, size, n = [], 0, n + 1
        if held:
            yield row()

    return found.mapInArrow(run, ARCHIVES)


def frames(content: bytes, window: int = 32 << 10) -> Iterator[bytes]:
    """The decoded frames of an archive, one after the other; never more than one is held."""
    import zstandard

    view, at, trained = memoryview(content), 0, None
    if len(content) >= 8 and int.from_bytes(view[:4], "little") == SKIPPABLE:
        end = 8 + int.from_bytes(view[4:8], "little")
        body = bytes(view[8:end])
        if len(body) != end - 8:
            raise ValueError("the dictionary frame is cut off")
        if body[:4] == FRAME_MAGIC:
            body = zstandard.ZstdDecompressor().decompress(body)
        trained, at = zstandard.ZstdCompressionDict(body), end
    engine = zstandard.ZstdDecompressor(dict_data=trained)
    while at < len(view):
        if 0x184D2A50 <= int.from_bytes(view[at : at + 4], "little") <= 0x184D2A5F:
            at += 8 + int.from_bytes(view[at + 4 : at + 8], "little")
            continue
        one, out = engine.decompressobj(), []
        while not one.eof:
            if at >= len(view):
                raise ValueError("the last frame is cut off")
            part = view[at : at + window]
            out.append(one.decompress(part))
            at += len(part)
        at -= len(one.unused_data)
        yield b"".join(out)


def parsed(raw: bytes) -> dict:
    """The record's fields and what is wrong with it."""
    out: dict = {"record_type": None, "page_id": None, "url": None, "payload_bytes": None, "payload_digest": None, "refers_to": None, "problem": None, "payload": None}
    head, gap, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    fields = {k.strip().lower(): v.strip() for k, colon, v in (x.partition(":") for x in lines[1:]) if colon}
    number = lambda x: int(x[len("<urn:page:") : -1]) if x and x.startswith("<urn:page:") and x[10:-1].lstrip("-").isdigit() else None
    out["record_type"], out["url"] = fields.get("warc-type"), fields.get("warc-target-uri")
    out["page_id"], out["refers_to"] = number(fields.get("warc-record-id")), number(fields.get("warc-refers-to"))
    missing = [x for x in REQUIRED if x.lower() not in fields]
    length = fields.get("content-length", "")
    if lines[0] not in ("WARC/1.0", "WARC/1.1"):
        out["problem"] = "version"
    elif missing:
        out["problem"] = f"no {missing[0]}"
    elif not gap or not length.isdigit() or len(rest) != int(length) + 4 or not rest.endswith(b"\r\n\r\n"):
        out["problem"] = "length"
    if out["problem"]:
        return out
    http, gap, payload = rest[:-4].partition(b"\r\n\r\n")
    inner = {k.strip().lower(): v.strip() for k, _, v in (x.partition(b":") for x in http.split(b"\r\n")[1:])}
    said = inner.get(b"content-length", b"")
    digest = fields.get("warc-payload-digest", "")
    if out["record_type"] == "revisit":
        if not said.isdigit() or not digest.startswith("sha1:") or "warc-refers-to" not in fields:
            out["problem"] = "revisit without length, digest or reference"
            return out
        out["payload_bytes"], out["payload_digest"] = int(said), base64.b32decode(digest[5:]).hex()
        return out
    out["payload"], out["payload_bytes"], out["payload_digest"] = payload, len(payload), hashlib.sha1(payload).hexdigest()
    if not gap or said.isdigit() and int(said) != len(payload):
        out["problem"] = "HTTP length"
    elif digest.startswith("sha1:") and base64.b32encode(bytes.fromhex(out["payload_digest"])).decode() != digest[5:]:
        out["problem"] = "payload digest"
    return out


def read(archives: DataFrame, name: str = "archive", content: str = "content", payload: bool = True) -> DataFrame:
    """A row for each record of the archives; with payload, its bytes (null for revisits)."""
    schema = RECORDS + ", payload binary" * payload
    columns = [x.split()[0] for x in schema.split(", ")]
    kinds = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "refers_to": pa.int64(), "payload": pa.binary()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        held: list[dict] = []
        size = 0

        def block() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[c] for r in held], kinds.get(c, pa.string())) for c in columns], columns)

        for batch in batches:
            for i in range(batch.num_rows):
                archive, body = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                try:
                    for raw in frames(body or b""):
                        held.append(parsed(raw) | {"archive": archive})
                        size += len(raw)
                        if len(held) >= 4096 or size >= 16 << 20:
                            yield block()
                            held, size = [], 0
                except (zstandard.ZstdError, ValueError) as e:
                    held.append(parsed(b"") | {"archive": archive, "problem": f"archive: {e}"})
        if held:
            yield block()

    return archives.select(F.col(name).cast("string"), content).mapInArrow(run, schema)


def round_trip(pages: DataFrame, least: int = 1000) -> DataFrame:
    """Writes the archives to the shared folder and reads them back; per page what its record says."""
    back = read(written(write(pages, least), "warc"), payload=False)
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "problem")
