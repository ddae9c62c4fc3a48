from __future__ import annotations

import hashlib

import pytest

from muster.llm import warc
from muster.llm.common import written

SCHEMA = "page_id long, url string, html string, key string, archive string"


def rows(n: int) -> list[tuple]:
    out = [(i, f"http://h{i % 7}.example/{i}", f"<p>{i} " + "text of a page " * (i % 90) + "</p>", "k", "a") for i in range(n)]
    out += [(n + i, None, "same payload " * 100, "k", "a") for i in range(30)]
    return [*out, (n + 50, "u", "short", "k", "a"), (n + 51, "u", "short", "k", "a"), (n + 52, "u", None, "k", "a"), (n + 53, "u\r\nX: y", "", "k", "a"), (None, "u", "same payload " * 100, "k", "a"), (n + 54, "u", "é" * 200_000, "k", "a")]


def brute(data):
    last = {}
    for i, _, html, *_ in data:
        body = (html or "").encode()
        if i is not None and len(body) >= 1000:
            last[body] = max(last.get(body, i), i)
    out = []
    for i, _, html, *_ in data:
        body = (html or "").encode()
        to = last.get(body) if i is not None and last.get(body, i) > i else None
        out.append((i if i is not None else -1, len(body), hashlib.sha1(body).hexdigest(), "response" if to is None else "revisit", to))
    return sorted(out, key=str)


def test_round_trip_equals_brute_force(spark):
    data = rows(400)
    got = warc.round_trip(spark.createDataFrame(data, SCHEMA)).collect()
    assert {r.problem for r in got} == {None}
    assert sorted(((-1 if r.page_id is None else r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == brute(data)


def test_archives_have_a_dictionary_and_one_frame_per_record(spark):
    import zstandard

    archives = warc.write(spark.createDataFrame(rows(400), SCHEMA).coalesce(1), archive_bytes=1 << 18).collect()
    assert len(archives) > 1
    content = bytes(archives[0].content)
    assert int.from_bytes(content[:4], "little") == warc.SKIPPABLE
    size = int.from_bytes(content[4:8], "little")
    dictionary = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(content[8 : 8 + size]))
    assert dictionary.dict_id() != 0
    assert len(list(warc.frames(content))) == archives[0].records


def test_broken_records_and_archives_say_what_is_wrong(spark):
    import zstandard

    good = warc.record(1, "u", b"body", None)
    wrong = {
        "version": good.replace(b"WARC/1.1", b"WARC/9", 1),
        "no WARC-Date": good.replace(b"WARC-Date", b"WARC-Day", 1),
        "length": good[:-2],
        "payload digest": good.replace(b"body", b"bodi"),
        "HTTP length": good.replace(b"body", b"bodybody").replace(b"Content-Length: 71", b"Content-Length: 75"),
    }
    z = zstandard.ZstdCompressor()
    content = b"".join(z.compress(x) for x in wrong.values())
    broken = z.compress(good) + z.compress(good)[:-9]
    df = spark.createDataFrame([("a", bytearray(content)), ("b", bytearray(broken)), ("c", bytearray(b"")), ("d", None)], "path string, content binary")
    got = warc.read(df, "path").collect()
    problems = [r.problem for r in got if r.archive == "a"]
    assert problems[:4] == ["version", "no WARC-Date", "length", "payload digest"] and problems[4] is not None
    assert [(r.page_id, (r.problem or "")[:8]) for r in got if r.archive == "b"] == [(1, ""), (None, "archive:")]
    assert not [r for r in got if r.archive in "cd"]


def test_files_are_read_like_rows(spark, tmp_path):
    archives = warc.write(spark.createDataFrame(rows(50), SCHEMA))
    for r in archives.collect():
        (tmp_path / r.archive).write_bytes(bytes(r.content))
    files = spark.read.format("binaryFile").load(f"{tmp_path}/*.warc.zst")
    assert warc.read(files, "path").count() == len(rows(50))


def test_empty_table(spark):
    assert warc.read(written(warc.write(spark.createDataFrame([], SCHEMA)))).count() == 0


def test_only_valid_payload_limits(spark):
    with pytest.raises(Exception):
        list(warc.frames((warc.SKIPPABLE).to_bytes(4, "little") + (99).to_bytes(4, "little") + b"x"))
