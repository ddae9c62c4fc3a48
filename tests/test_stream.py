from __future__ import annotations

import json
import os
import time

import pytest

from muster.contracts import ATTEMPTS
from muster.streaming import jobs


def attempt(i, ended="2026-01-01 00:05:00"):
    return {f.name: None for f in ATTEMPTS} | {"schema_version": 2, "attempt_shape": "v2", "attempt_id": i, "raw_status": "accepted", "started_at_utc": "2026-01-01 00:00:00", "ended_at_utc": ended}


def test_attempts_are_taken_once_over_several_runs(spark, tmp_path):
    source, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    (tmp_path / "in").mkdir()
    for part, ids in enumerate((["a", "b", "a"], ["b", "c"])):
        (tmp_path / "in" / f"{part}.json").write_text("\n".join(json.dumps(attempt(i)) for i in ids))
        jobs.append(jobs.attempt_stream(jobs.read_attempt_stream(spark, source)), out, state).awaitTermination()
    rows = spark.read.parquet(out).collect()
    assert sorted(r.attempt_id for r in rows) == ["a", "b", "c"]
    assert {r.duration_seconds for r in rows} == {300} and {r.normalized_outcome for r in rows} == {"accepted"}


def test_next_revisions(spark):
    known = spark.createDataFrame([("d1", 1, "a"), ("d1", 2, "b")], "as_of_date string, release_revision long, revision_fingerprint string")
    candidates = spark.createDataFrame([("d1", "b", 0), ("d1", "c", 0), ("d2", "x", 0), ("d2", "y", 4), ("d2", "x", 0)], "as_of_date string, revision_fingerprint string, reason_count long")
    got = sorted((r.as_of_date, r.revision_fingerprint, r.raw_status, r.release_revision) for r in jobs.next_revision(known, candidates).collect())
    assert got == [("d1", "b", "no_new_release", None), ("d1", "c", "accepted", 3), ("d2", "x", "accepted", 1), ("d2", "y", "rejected", None)]


def test_landing_stream_lands_nothing_twice(spark, tmp_path):
    from pyspark.sql import functions as F

    schema = "as_of_date string, revision_fingerprint string, key string"
    (tmp_path / "in").mkdir()
    landed, catalog = str(tmp_path / "landed"), []

    def known():
        return spark.createDataFrame(catalog, "as_of_date string, release_revision long, revision_fingerprint string")

    def judge(batch):
        return batch.groupBy("as_of_date", "revision_fingerprint").agg(F.count(F.when(F.col("key") == "bad", 1)).alias("reason_count"))

    def land(rows, outcomes):
        rows.write.mode("append").parquet(landed)
        catalog.extend((r.as_of_date, r.release_revision, r.revision_fingerprint) for r in outcomes.where("raw_status = 'accepted'").collect())

    for part, rows in enumerate(([("d1", "a", "1"), ("d1", "a", "2")], [("d1", "a", "1"), ("d1", "b", "3"), ("d2", "x", "bad")])):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
        jobs.landing_stream(spark.readStream.schema(schema).json(str(tmp_path / "in")), known, judge, land, str(tmp_path / "state")).awaitTermination()
    got = sorted((r.as_of_date, r.release_revision, r.key) for r in spark.read.parquet(landed).collect())
    assert got == [("d1", 1, "1"), ("d1", 1, "2"), ("d1", 2, "3")]


def test_late_attempts_are_set_aside(spark, tmp_path):
    """Documents behind the watermark are in the side table, document by document, and a second run adds nothing."""
    source, taken, late, state = (str(tmp_path / x) for x in ("in", "taken", "late", "state"))
    (tmp_path / "in").mkdir()
    day = lambda d: f"2026-01-{d:02d} 00:05:00"
    parts = [[attempt("a", day(1)), attempt("b", day(2))], [attempt("c", day(9)), attempt("b", day(2))], [attempt("d", day(15))], [attempt("e", day(16)), attempt("old", day(3)), attempt("old", day(3)), attempt("a", day(1)), attempt("untimed", None)]]
    for i, part in enumerate(parts):
        path = tmp_path / "in" / f"{i}.json"
        path.write_text("\n".join(json.dumps(x) for x in part))
        os.utime(path, (1000 + i, 1000 + i))
    for _ in range(2):
        jobs.attempt_job(spark, source, taken, late, state, files=1)
        assert sorted(r.attempt_id for r in spark.read.parquet(taken).collect()) == ["a", "b", "c", "d", "e"]
        aside = spark.read.option("recursiveFileLookup", "true").schema(ATTEMPTS).parquet(late)
        assert sorted(r.attempt_id for r in aside.collect()) == ["old", "old"]


def landing_case(spark, base):
    """One run over what lies in base/in; rows of a candidate are two."""
    (base / "in").mkdir()
    candidates = spark.readStream.schema(jobs.CANDIDATE).option("maxFilesPerTrigger", 1).json(f"{base}/in")

    def run(rows_of=lambda accepted: accepted.selectExpr("*", "explode(array(1, 2)) as line"), remembered=0):
        jobs.landing_job(candidates, rows_of, f"{base}/landed", f"{base}/catalogue", f"{base}/state", remembered)
        read = lambda name: spark.read.option("recursiveFileLookup", "true").parquet(f"{base}/{name}")
        outcomes = sorted((r.as_of_date, r.revision_fingerprint, r.raw_status, r.release_revision) for r in read("catalogue").collect())
        return outcomes, sorted((r.as_of_date, r.release_revision, r.revision_fingerprint, r.line) for r in read("landed").collect())

    def arrive(i, *rows):
        path = base / "in" / f"{i}.json"
        path.write_text("\n".join(json.dumps(dict(zip(("as_of_date", "revision_fingerprint", "reason_count"), r, strict=True))) for r in rows))
        os.utime(path, (2000 + i, 2000 + i))

    return arrive, run


def test_revisions_from_state(spark, tmp_path):
    arrive, run = landing_case(spark, tmp_path)
    arrive(0, ("d1", "b", 0), ("d1", "a", 0), ("d1", "a", 0), ("d2", "x", 4))
    first = [("d1", "a", "accepted", 1), ("d1", "b", "accepted", 2), ("d2", "x", "rejected", None)]
    assert run() == (first, [("d1", 1, "a", 1), ("d1", 1, "a", 2), ("d1", 2, "b", 1), ("d1", 2, "b", 2)])
    arrive(1, ("d1", "a", 0), ("d2", "x", 0))
    arrive(2, ("d1", "c", 0))
    outcomes, landed = run()
    assert outcomes == sorted([*first, ("d1", "a", "no_new_release", None), ("d2", "x", "accepted", 1), ("d1", "c", "accepted", 3)])
    assert len(landed) == 8 and run() == (outcomes, landed)


@pytest.mark.parametrize("where", ["before", "between"])
def test_a_crash_repeats_nothing(spark, tmp_path, monkeypatch, where):
    """A batch that breaks off, be it before its rows land or between rows and catalogue, is written once when it runs again."""
    from pyspark.sql import DataFrameWriter

    arrive, run = landing_case(spark, tmp_path)
    arrive(0, ("d1", "a", 0))
    run()
    arrive(1, ("d1", "b", 0), ("d2", "x", 0))
    write = DataFrameWriter.parquet

    def broken(self, path, *args, **kwargs):
        if ("landed" if where == "before" else "catalogue") in path and "batch=1" in path:
            raise RuntimeError("the machine stops here")
        return write(self, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", broken)
    with pytest.raises(Exception, match="machine stops"):
        run()
    assert (tmp_path / "landed" / "batch=1").exists() == (where == "between")
    monkeypatch.setattr(DataFrameWriter, "parquet", write)
    outcomes, landed = run()
    assert outcomes == [("d1", "a", "accepted", 1), ("d1", "b", "accepted", 2), ("d2", "x", "accepted", 1)]
    assert landed == [("d1", 1, "a", 1), ("d1", 1, "a", 2), ("d1", 2, "b", 1), ("d1", 2, "b", 2), ("d2", 1, "x", 1), ("d2", 1, "x", 2)]


def test_forgotten_fingerprints(spark, tmp_path):
    """With a time to remember, a fingerprint that is long gone is a new revision; the last revision isn't forgotten."""
    arrive, run = landing_case(spark, tmp_path)
    arrive(0, ("d1", "a", 0))
    run(remembered=1)
    time.sleep(1)
    arrive(1, ("d1", "a", 0))
    outcomes, _ = run(remembered=1)
    assert outcomes == [("d1", "a", "accepted", 1), ("d1", "a", "accepted", 2)]
