from __future__ import annotations

import hashlib
import json

import pytest

from muster.contracts import HEADERS, LANDED, SOURCE_LISTS, STATUSES
from muster.operators import validation
from muster.sources import landing

HEAD = ",".join(HEADERS)


def line(key="100", status="Current", name="Fund", date="2020/01/15"):
    return f"{status},{key},,,{name},City,CA,,,,{date}"


def release(tmp_path, **lists):
    folder = tmp_path / "release"
    folder.mkdir()
    for i, name in enumerate(SOURCE_LISTS):
        body = lists.get({"charities-may-operate": "operate", "charities-not-operating": "operating", "charities-undetermined-status": "status"}.get(name))
        rows = body if body is not None else [line(key=str(500 + i))]
        (folder / f"{name}.csv").write_bytes(rows if isinstance(rows, bytes) else "\r\n".join([HEAD, *rows, ""]).encode("cp1252"))
    return str(folder)


def reasons(spark, path, statuses=True):
    lines = landing.list_lines(spark, path)
    found = validation.registry_reasons(lines, landing.records(lines), statuses)
    return [(r.code, r.source_list, r.line_no) for r in validation.ordered(found).collect()]


def test_a_good_release_has_no_reasons(spark, tmp_path):
    path = release(tmp_path, operate=[line(name='O"Brien "Family" Fund'), "", line(key="CT7", name="Café €"), line(key="")])
    assert reasons(spark, path) == []
    rows = {(r.source_list, r.source_line_no): r for r in landing.records(landing.list_lines(spark, path)).collect()}
    assert rows["charities-may-operate", 2]["Name"] == 'O"Brien "Family" Fund'
    assert rows["charities-may-operate", 4]["Name"] == "Café €"
    assert ("charities-may-operate", 3) not in rows


@pytest.mark.parametrize("end", [b"\r\n", b"\n", b"\r"])
def test_line_numbers_over_many_blocks(spark, tmp_path, end):
    texts = [f"row {i}" if i % 5 else "" for i in range(1, 300)]
    (tmp_path / "a.csv").write_bytes(end.join(t.encode() for t in texts) + end)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    try:
        got = sorted((r.line_no, r.text) for r in landing.list_lines(spark, str(tmp_path)).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == list(enumerate(texts, 1))


def test_lists_in_parts(spark, tmp_path):
    """A list is written by many tasks, and its lines keep its name and their order."""
    rows = [("one list", i, f"é€ {i}") for i in range(4_000)] + [("other", i, f"row {i}") for i in range(5)]
    path = str(tmp_path / "lists")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        landing.written_lists(spark.createDataFrame(rows[::-1], "file string, place long, line string").repartition(7), "head", path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(list((tmp_path / "lists").glob("file=one*/part-*"))) > 1
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = sorted(tuple(r) for r in landing.part_lines(spark, path).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == sorted([("one list", 1, "head"), ("other", 1, "head"), *((f, i + 2, line) for f, i, line in rows)])


def test_reasons_of_files(spark, tmp_path):
    path = release(tmp_path, operate=(HEAD + "\r\n" + line(name="x\x81y") + "\r\n").encode("latin-1"), operating=[line(key="7") + ",extra", "short"], status=b"\r\n" + line(key="8").encode())
    found = [x[0] for x in reasons(spark, path)]
    assert found[:4] == ["parse.decode_failed", "parse.header_mismatch", "parse.arity_mismatch", "date.blank"][: len(found[:4])] or set(found) >= {"parse.decode_failed", "parse.header_mismatch", "parse.arity_mismatch"}


def test_reasons_of_records(spark, tmp_path):
    path = release(tmp_path, operate=[line(key="100"), line(key="X1"), line(key="101", date=""), line(key="102", date="2020/02/01"), line(key="\t100 ")], status=[line(key="900", status="Strange"), line(key="100")])
    found = reasons(spark, path)
    own = "charities-may-operate"
    assert found == [
        ("date.blank", own, 4),
        ("date.mismatch", own, 5),
        ("registration.unknown_format", own, 3),
        ("registration.duplicate", own, 2),
        ("registration.duplicate", own, 6),
        ("registration.duplicate", "charities-undetermined-status", 3),
        ("set.unknown_registry_status", "charities-undetermined-status", None),
    ]
    lines = landing.list_lines(spark, path)
    verdict = validation.verdict(validation.registry_reasons(lines, landing.records(lines))).first()
    assert (verdict.verdict, verdict.reason_count) == ("source_contract_mismatch", 7)
    assert len(STATUSES) == 33


def test_fingerprint_is_that_of_compact_json(spark, tmp_path):
    path = release(tmp_path)
    files = spark.read.format("binaryFile").load(path)
    pairs = [[n, hashlib.sha256(open(f"{path}/{n}.csv", "rb").read()).hexdigest()] for n in SOURCE_LISTS]
    expected = hashlib.sha256(json.dumps(pairs, separators=(",", ":")).encode()).hexdigest()
    assert landing.release_fingerprint(files, SOURCE_LISTS).first()[0] == expected


def test_landed_table_round_trip(spark, tmp_path):
    from pyspark.sql import functions as F

    rows = landing.records(landing.list_lines(spark, release(tmp_path)))
    stamped = rows.withColumn("as_of_date", F.lit("2020-01-15")).withColumn("release_revision", F.lit(1).cast("long")).withColumn("revision_fingerprint", F.lit("f"))
    landing.landed_table(stamped, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 4 and landing.landed_faults(back).count() == 0
    landing.landed_table(stamped.withColumn("as_of_date", F.lit("2020-02-15")), str(tmp_path / "out"), "append")
    ids = "as_of_date string, release_revision long, revision_fingerprint string"
    read = landing.read_landed(spark, str(tmp_path / "out"), spark.createDataFrame([("2020-01-15", 1, "f"), ("2020-02-15", 1, "g"), ("2020-03-15", 1, "h"), (None, 1, "i")], ids))
    assert read.count() == 8 and [f.name for f in read.schema][: len(LANDED)] == [f.name for f in LANDED]
    assert {(r.as_of_date, r.revision_fingerprint) for r in read.collect()} == {("2020-01-15", "f"), ("2020-02-15", "g")}
    assert landing.read_landed(spark, str(tmp_path / "out"), spark.createDataFrame([], ids)).count() == 0
    assert landing.read_landed(spark, str(tmp_path / "out"), spark.createDataFrame([("2020-02-15", 1, "g")], ids)).count() == 4
    assert landing.landed_faults(back.withColumn("source_line_no", F.lit(1).cast("long"))).count() > 0
    with pytest.raises(Exception):
        landing.landed_table(stamped, str(tmp_path / "out"))


def stamped(spark, n, date="2020-01-15", step=1):
    from pyspark.sql import functions as F

    rows = spark.range(n).select(*(F.concat(F.lit(f"{h} "), "id").alias(h) for h in HEADERS), F.when(F.col("id") % 2 == 0, SOURCE_LISTS[0]).otherwise(SOURCE_LISTS[1]).alias("source_list"), (F.col("id") * step + 2).alias("source_line_no"))
    return rows.withColumns({"as_of_date": F.lit(date), "release_revision": F.lit(1).cast("long"), "revision_fingerprint": F.lit("f")})


def test_lines_are_numbered_over_small_blocks_in_one_scan(spark, tmp_path):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    rows = [line(key=str(i), name="x" * (i % 50)) for i in range(3000)]
    path = release(tmp_path, operate=rows, status=["", *rows[:7], ""])
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "11")
        lines = landing.list_lines(spark, path)
        plan = lines._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
        assert "FileScan text" not in plan and "monotonically" not in plan
        got = sorted((r.source_list, r.line_no, r.text) for r in lines.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    expected = []
    for name in SOURCE_LISTS:
        body = open(f"{path}/{name}.csv", "rb").read().decode("cp1252").split("\r\n")[:-1]
        expected += [(name, i + 1, text) for i, text in enumerate(body)]
    assert got == sorted(expected)


def test_one_scan_reads_forty_releases(spark, tmp_path):
    dates = [f"20{20 + i // 12}-{1 + i % 12:02d}-15" for i in range(40)]
    landing.landed_table(stamped(spark, 8).drop("as_of_date").crossJoin(spark.createDataFrame([(d,) for d in dates], "as_of_date string")), str(tmp_path / "t"))
    ids = spark.createDataFrame([(d, 1, "x") for d in dates], "as_of_date string, release_revision long, revision_fingerprint string")
    ids.write.parquet(str(tmp_path / "ids"))
    some = spark.read.parquet(str(tmp_path / "ids")).where("as_of_date < '2020-04'")
    read = landing.read_landed(spark, str(tmp_path / "t"), some)
    plan = read._jdf.queryExecution().toString()
    assert plan.split("== Physical Plan ==")[1].count("FileScan parquet") - plan.split("== Physical Plan ==")[1].count("/ids") <= 2  # the table once; the catalogue, and once more where it prunes
    assert "dynamicpruning" in plan.lower()
    assert read.count() == 24 and landing.read_landed(spark, str(tmp_path / "t"), ids).count() == 320


def test_other_columns_in_one_file_are_found(spark, tmp_path):
    from pyspark.sql import functions as F

    landing.landed_table(stamped(spark, 4), str(tmp_path / "t"))
    landing.written_landed(stamped(spark, 4, "2020-02-15").withColumn("more", F.lit(1)), str(tmp_path / "t"), "append")
    with pytest.raises(ValueError, match="more"):
        landing.read_landed(spark, str(tmp_path / "t"), spark.createDataFrame([("2020-01-15", 1, "f")], "as_of_date string, release_revision long, revision_fingerprint string"))


def test_row_groups_and_order_on_disk(spark, tmp_path, monkeypatch):
    import pyarrow.parquet as pq

    assert landing.GROUP_ROWS == 122_880
    monkeypatch.setattr(landing, "GROUP_ROWS", 1000)
    landing.landed_table(stamped(spark, 20_000), str(tmp_path / "t"))
    files = sorted((tmp_path / "t").rglob("*.parquet"))
    sizes = []
    for f in files:
        footer = pq.ParquetFile(f).metadata
        groups = [footer.row_group(i) for i in range(footer.num_row_groups)]
        sizes += [g.num_rows for g in groups]
        assert all(g.num_rows <= 1000 for g in groups) and {g.column(0).compression for g in groups} == {"ZSTD"}
        rows = pq.read_table(f, partitioning=None).to_pandas()
        assert (rows == rows.sort_values(["source_list", "source_line_no"], kind="stable")).all(axis=None)
    assert sum(sizes) == 20_000 and max(sizes) == 1000
    before = {f: f.stat().st_mtime_ns for f in files}
    with pytest.raises(Exception, match="(?i)exists"):
        landing.landed_table(stamped(spark, 5), str(tmp_path / "t"))
    assert {f: f.stat().st_mtime_ns for f in sorted((tmp_path / "t").rglob("*.parquet"))} == before


def test_order_on_disk_over_batches_and_files(spark, tmp_path):
    from pyspark.sql import functions as F

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        landing.landed_table(stamped(spark, 500), str(tmp_path / "good"))
        read = lambda name: spark.read.parquet(str(tmp_path / name)).withColumn("as_of_date", F.col("as_of_date").cast("string"))
        counts = stamped(spark, 500).groupBy("as_of_date", "release_revision", "source_list").agg(F.count("*").alias("n"))
        release = ("as_of_date", "release_revision")
        assert landing.landed_faults(read("good").drop("release_revision"), counts).count() == 0
        assert [r[0] for r in landing.landed_faults(read("good").drop("release_revision"), counts.withColumn("n", F.col("n") + 1)).collect()] == ["row_count"] * 2
        more = counts.union(spark.createDataFrame([("2020-01-15", 1, "another", 3)], counts.schema))
        assert [r[0] for r in landing.landed_faults(read("good").drop("release_revision"), more).collect()] == ["row_count"]
        mixed = stamped(spark, 500).repartition(*release, "source_list").sortWithinPartitions(*release, "source_list", F.col("source_line_no") % 100)
        landing.written_landed(mixed, str(tmp_path / "mixed"))
        assert [r[0] for r in landing.landed_faults(read("mixed").drop("release_revision")).collect()] == ["order"] * 2
        twice = stamped(spark, 500).union(stamped(spark, 1)).repartition(1).sortWithinPartitions(*release, "source_list", F.desc("source_line_no"))
        landing.written_landed(twice, str(tmp_path / "twice"))
        assert sorted(r[0] for r in landing.landed_faults(read("twice").drop("release_revision")).collect()) == ["line_numbers", "order", "order"]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_a_hot_key_is_split(spark):
    """One key on a third of the rows: the join that finds its occurrences is one that adaptive execution splits."""
    from pyspark.sql import functions as F

    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        n = 60_000
        key = F.when(F.col("id") % 3 == 0, "CT7").otherwise(F.col("id").cast("string"))
        rows = spark.range(0, n, 1, 8).select(F.lit("Current").alias("Registry Status"), key.alias("State Charity Reg#"), F.lit("2020/01/15").alias("As-of Date"), F.lit(SOURCE_LISTS[0]).alias("source_list"), F.abs(F.xxhash64("id")).alias("source_line_no"))
        found = validation.record_reasons(rows, "State Charity Reg#", "Registry Status", "As-of Date").where("code = 'registration.duplicate'")
        tasks = [r["task"] for r in found.select("line_no", F.spark_partition_id().alias("task")).collect()]
        sizes = [tasks.count(t) for t in set(tasks)]
        assert sum(sizes) == n // 3 and max(sizes) < n // 6 and len(sizes) > 2
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_attempt_documents(spark, tmp_path):
    good = [
        {"schema_version": 1, "attempt_id": "a", "status": "rejected", "as_of_date": None, "reason_count": 3},
        {"schema_version": 1, "attempt_id": "b", "as_of_date": "2020-01-15", "revision_fingerprint": "f", "status": "accepted", "release_revision": 1, "recovered": True},
        {"schema_version": 2, "attempt_id": "c", "started_at_utc": "2020-01-15T00:00:00Z", "ended_at_utc": "2020-01-15T00:00:09Z", "status": "accepted", "as_of_date": "2020-01-15", "release_revision": 1, "revision_fingerprint": "f", "reason_count": 0},
    ]
    for i, d in enumerate(good):
        (tmp_path / f"{i}.json").write_text(json.dumps(d, indent=1))
    rows = {r.attempt_id: r for r in landing.read_attempts(spark, str(tmp_path)).collect()}
    assert [rows[k].attempt_shape for k in "abc"] == ["admission_v1", "store_v1", "v2"]
    assert rows["b"].recovered and rows["a"].reason_count == 3 and rows["c"].raw_status == "accepted"
    (tmp_path / "bad.json").write_text(json.dumps({"schema_version": 2, "attempt_id": "d"}))
    with pytest.raises(Exception, match="closed forms"):
        landing.read_attempts(spark, str(tmp_path)).collect()


def test_each_attempt_is_written_in_its_own_form(spark):
    from muster.contracts import ATTEMPT_KEYS, ATTEMPTS
    from muster.queries import attempt_bodies

    rows = [
        (1, "admission_v1", "a", "rejected", "2020-01-15", None, None, 3, None, None, None),
        (1, "store_v1", "b", "accepted", None, 1, "f", None, False, None, None),
        (2, "v2", "c", "accepted", "2020-01-15", 1, "f", 0, None, None, "2020-01-15T00:00:09Z"),
    ]
    bodies = attempt_bodies(spark.createDataFrame(rows, ATTEMPTS))
    keys = [set(json.loads(r.value)) for r in bodies.collect()]
    assert keys == [set(ATTEMPT_KEYS[r[1]]) for r in rows]
    assert sorted(map(tuple, landing.attempts(bodies).collect()), key=lambda r: r[2]) == rows
    with pytest.raises(Exception, match="no known form"):
        attempt_bodies(spark.createDataFrame([(1, None, *rows[0][2:])], ATTEMPTS)).collect()


def test_classifications(spark, tmp_path):
    row = lambda k, c="eligible": json.dumps({"registration_number": k, "classification": c, "classification_version": "v"})
    path = tmp_path / "c.json"
    path.write_text("\n".join([row("1"), row("2", "unclassified")]))
    assert landing.read_classifications(spark, str(path)).count() == 2
    assert landing.read_classifications(spark, None).count() == 0
    with pytest.raises(FileNotFoundError):
        landing.read_classifications(spark, None, required=True)
    for bad in (row("1") + "\n" + row("1"), row(" 1"), row(""), row("1", "odd")):
        path.write_text(bad)
        with pytest.raises(ValueError):
            landing.read_classifications(spark, str(path))
