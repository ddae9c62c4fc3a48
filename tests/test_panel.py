from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from muster.contracts import PanelSpec
from muster.operators import metrics, panel, publish
from muster.plans import checks

SPEC = PanelSpec(at_risk=("D", "L"), claim_status="C")
DATES = ["2032-01-05", "2032-02-16", "2032-03-30", "2032-05-11", "2032-06-22"]


def frames(spark, seen: dict[tuple[str, int], str | None], dates=DATES):
    """A panel from {(key, place of the date): status}."""
    revisions = spark.createDataFrame([(d, 1, f"f{i}", 1) for i, d in enumerate(dates)], "as_of_date string, release_revision long, revision_fingerprint string, parser_contract_version long")
    promoted = panel.promote(revisions, revisions.limit(0))
    rows = [(s, k or None, "n", "c", "s", dates[i], 1, f"f{i}", "list", n + 2, None, False) for n, ((k, i), s) in enumerate(sorted(seen.items()))]
    staged = spark.createDataFrame(rows, "status string, key string, organization_name string, city string, state string, as_of_date string, release_revision long, revision_fingerprint string, source_list string, source_line_no long, current_status_date date, current_status_date_unparseable boolean")
    records = panel.promoted_records(staged, promoted)
    snapshots = panel.keyed_snapshots(records, SPEC)
    sequence = panel.observation_sequence(snapshots, panel.date_spine(promoted))
    return revisions, promoted, staged, records, snapshots, sequence


def random_panel(seed, keys=60):
    rng = random.Random(seed)
    return {(f"k{k}", i): rng.choice(["D", "L", "C", "R"]) for k in range(keys) for i in range(5) if rng.random() < 0.65}


def model_spells(seen):
    out = []
    for key in sorted({k for k, _ in seen}):
        own = {i: seen[key, i] in SPEC.at_risk for i in range(5) if (key, i) in seen}
        number, i = 0, 0
        while i < 5:
            if not own.get(i):
                i += 1
                continue
            first = i
            while own.get(i + 1):
                i += 1
            number += 1
            left = DATES[first - 1] if own.get(first - 1) is False else None
            right = DATES[i + 1] if own.get(i + 1) is False else None
            state = "observed_exit" if right else "right_censored" if i == 4 else "lost_to_observation"
            out.append((key, number, left, DATES[first], DATES[i], right, left is None, state))
            i += 1
    return out


def model_classes(seen):
    out = []
    for key in {k for k, _ in seen}:
        for i in range(4):
            a, b = seen.get((key, i)), seen.get((key, i + 1))
            if a is None and b is None:
                continue
            risk = [x in SPEC.at_risk if x else None for x in (a, b)]
            name = {
                (False, True): "delinquency_entry_observed", (None, True): "delinquent_newly_observed", (True, False): "delinquency_exit_observed", (True, True): "delinquency_still_observed",
                (True, None): "delinquent_lost_to_observation", (False, False): "observed_status_movement_other", (None, False): "newly_observed_other", (False, None): "not_observed_after_other",
            }[tuple(risk)]
            out.append((DATES[i], key, a, b, name))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_spells_and_transitions_follow_the_model(spark, seed):
    seen = random_panel(seed)
    *_, promoted, _, _, snapshots, sequence = frames(spark, seen)
    got = panel.spells(sequence).orderBy("key", "spell_number").collect()
    assert [(r.key, r.spell_number, r.onset_left, r.onset_right, r.exit_left, r.exit_right, r.is_left_censored, r.terminal_state) for r in got] == model_spells(seen)
    found = panel.transitions(sequence, promoted)
    assert sorted(((r.from_as_of_date, r.key, r.start_status, r.end_status, r.transition_class) for r in found.collect()), key=str) == model_classes(seen)
    again = panel.transitions_by_join(snapshots, promoted).select(found.columns)
    assert found.exceptAll(again).count() == again.exceptAll(found).count() == 0


def test_a_missing_release_breaks_a_spell(spark):
    *_, sequence = frames(spark, {("a", 0): "D", ("a", 1): "D", ("a", 3): "D", ("b", 0): "C", ("b", 1): "D", ("b", 2): "C", ("c", 4): "L", ("filler", 2): "C"})
    got = {(r.key, r.spell_number): (r.onset_right, r.exit_left, r.exit_right, r.terminal_state, r.is_left_censored) for r in panel.spells(sequence).collect()}
    assert got == {
        ("a", 1): (DATES[0], DATES[1], None, "lost_to_observation", True),
        ("a", 2): (DATES[3], DATES[3], None, "lost_to_observation", True),
        ("b", 1): (DATES[1], DATES[1], DATES[2], "observed_exit", False),
        ("c", 1): (DATES[4], DATES[4], None, "right_censored", True),
    }


def test_promotion_prefers_exact_pointers(spark):
    schema = "as_of_date string, release_revision long, revision_fingerprint string, parser_contract_version long"
    revisions = spark.createDataFrame([("d1", 1, "a", 1), ("d1", 2, "b", 1), ("d2", 1, "c", 1), ("d2", 2, "d", 1), ("d3", 1, "e", 1)], schema)
    pointers = spark.createDataFrame([("d1", 1, "a"), ("d2", 1, "wrong")], "as_of_date string, release_revision long, revision_fingerprint string")
    promoted = panel.promote(revisions, pointers)
    assert sorted((r.as_of_date, r.release_revision) for r in promoted.collect()) == [("d1", 1), ("d2", 2), ("d3", 1)]
    assert checks.promotion_holds(promoted, revisions, pointers).count() == 0
    wrong = promoted.withColumn("release_revision", F.lit(1).cast("long")).withColumn("revision_fingerprint", F.when(F.col("as_of_date") == "d2", "c").otherwise(F.col("revision_fingerprint")))
    assert {r.failure_reason for r in checks.promotion_holds(wrong, revisions, pointers).collect()} == {"not_highest"}


def test_dispositions_and_coverage(spark):
    _, promoted, staged, records, snapshots, _ = frames(spark, {("a", 0): "D", ("", 0): "C", ("b", 0): None, ("b", 1): "C"})
    assert sorted((r.key or "", r.disposition) for r in records.collect()) == [("", "untracked_blank_registration"), ("a", "eligible_for_keyed_path"), ("b", "eligible_for_keyed_path"), ("b", "excluded_from_typed_path_blank_status")]
    assert panel.keyless(records).count() == panel.exclusions(records).count() == 1
    assert checks.dispositions_reconcile(records, staged, promoted).count() == 0
    assert checks.coverage_reconciles(metrics.population_coverage(records), records).count() == 0
    assert checks.dispositions_reconcile(records.limit(3), staged, promoted).count() > 0
    assert checks.snapshots_reconcile(snapshots, records, SPEC).count() == 0
    assert checks.snapshots_reconcile(snapshots.withColumn("at_risk", ~F.col("at_risk")), records, SPEC).count() > 0


def test_checks_pass_on_panels_and_fail_on_mutations(spark):
    revisions, promoted, staged, records, snapshots, sequence = frames(spark, random_panel(7, 25))
    pairs, found = panel.adjacent_pairs(promoted), panel.transitions(sequence, promoted)
    spells, flat = panel.spells(sequence), panel.sequence_columns(sequence)
    matrix = metrics.transition_matrix(metrics.transition_cells(found))
    pair_metrics = metrics.pair_metrics(metrics.pair_counts(metrics.transition_cells(found)), matrix)
    for rows in (
        checks.pairs_positive(pairs), checks.transitions_classified(found), checks.transitions_complete(found, snapshots, pairs), checks.pairs_are_adjacent(found, pairs),
        checks.pairs_are_promoted(found, promoted), checks.spells_hold(spells, flat), checks.metrics_add_up(pair_metrics, found), checks.sequence_neighbours(flat, snapshots),
        checks.provenance_closed(records, ["list"]),
    ):
        assert rows.collect() == []
    assert checks.pairs_positive(pairs.withColumn("gap_days", F.lit(0))).count() == 1
    assert checks.transitions_classified(found.withColumn("transition_class", F.lit("newly_observed_other"))).count() == 1
    assert checks.transitions_complete(found.limit(10), snapshots, pairs).count() == 1
    assert checks.pairs_are_adjacent(found, pairs.limit(1)).count() == 1
    assert checks.spells_hold(spells.withColumn("is_left_censored", ~F.col("is_left_censored")), flat).count() == 1
    assert checks.metrics_add_up(pair_metrics.withColumn("net_movement", F.lit(99)), found).count() == 1
    assert checks.provenance_closed(records, ["other"]).count() == 1
    assert checks.columns_hold(records, "x", ["status"], {"key": ["k1"]}).count() >= 1
    golden = metrics.release_totals(records, SPEC)
    assert checks.totals_match(golden, golden).count() == 0 and checks.totals_match(golden, golden.limit(2)).count() > 0


def test_durations(spark):
    *_, sequence = frames(spark, {("b", 0): "C", ("b", 1): "D", ("b", 2): "C", ("c", 4): "L", ("x", 3): "C"})
    got = {r.key: (r.least_days, r.most_days) for r in panel.duration_bounds(panel.spells(sequence)).collect()}
    assert got == {"b": (0, 85), "c": (0, None)}


def test_public_view(spark, tmp_path):
    _, promoted, _, records, snapshots, _ = frames(spark, {("a", 0): "D", ("a", 4): "C", ("b", 1): "D", ("c", 4): "C", ("f", 2): "C", ("f", 3): "C"})
    known = spark.createDataFrame([("c", "unclassified", "v")], "registration_number string, classification string, classification_version string")
    classes = publish.eligibility(snapshots, known)
    orgs = publish.organizations(snapshots, classes, promoted, SPEC.attributes)
    assert {r.key: (r.latest_status, r.latest_release_observation_state) for r in orgs.collect()} == {"a": ("C", "observed"), "b": ("D", "not_observed"), "f": ("C", "not_observed")}
    grid = publish.observations(snapshots, classes, promoted, SPEC.attributes)
    assert grid.count() == 15 and grid.where("observation_state = 'observed'").count() == 5
    assert checks.public_grid_complete(grid, orgs, promoted).count() == 0
    assert checks.eligibility_complete(classes, snapshots, orgs, metrics.publication_status(promoted)).count() == 0
    assert checks.eligibility_complete(classes, snapshots, orgs.limit(1), metrics.publication_status(promoted)).count() == 1
    assert publish.lookup(grid, "a").count() == 5
    with pytest.raises(Exception, match="no such key"):
        publish.lookup(grid, "zz").collect()
    totals = metrics.release_totals(records, SPEC)
    columns, grain = tuple(totals.columns), ("as_of_date",)
    assert publish.export_faults(totals, columns, grain, True).count() == 0
    assert {r[0] for r in publish.export_faults(orgs, ("key",), ("latest_as_of_date",), True).collect()} >= {"columns", "identity_columns"}
    publish.export_csv(totals, str(tmp_path / "x"), columns, grain, single=True)
    lines = [r.value for r in spark.read.text(str(tmp_path / "x" / "rows")).collect()]
    assert lines[0].startswith('"2032-01-05",1,"f0",') and len(lines) == 5


def scanned(df):
    """Rows that the file scans of a run plan gave out."""
    df.collect()

    def walk(node):
        name = node.getClass().getSimpleName()
        if "AdaptiveSparkPlan" in name:
            return walk(node.executedPlan())
        if "QueryStage" in name:
            return walk(node.plan())
        if "FileSourceScan" in name:
            return [node.metrics().apply("numOutputRows").value()]
        return [n for i in range(node.children().size()) for n in walk(node.children().apply(i))]

    return walk(df._jdf.queryExecution().executedPlan())


def test_lookup_reads_few_row_groups(spark, tmp_path):
    from pyspark.sql import functions as F

    n = 40_000
    rows = spark.range(n).select(F.format_string("k%06d", F.col("id") * 2).alias("key"), F.lit("2020-01-15").alias("as_of_date"), F.lit(1).cast("long").alias("release_revision"), F.lit("f").alias("revision_fingerprint"))
    table = publish.keyed_table(rows, str(tmp_path / "t"), expected=2000, group_rows=2000)
    one = publish.lookup(table, "k020000")
    assert [r.key for r in one.collect()] == ["k020000"]
    read = scanned(one)
    assert len(read) == 1 and 0 < read[0] <= 2000  # one scan, one row group
    absent = publish.histories(table, ["k020001", "k050003"], strict=False)
    assert [(r.key, r.as_of_date) for r in absent.collect()] == [("k020001", None), ("k050003", None)]
    assert scanned(table.where(F.col("key").isin("k020001", "k050003"))) == [0]  # within the ranges, ruled out by the filters
    with pytest.raises(ValueError):
        publish.histories(table, [str(i) for i in range(11)])


def test_digests_stream_over_batches(spark):
    import hashlib

    from pyspark.sql import functions as F

    from muster.functions.digests import streamed_sha256

    rows = [(g, i, None if i % 7 == 3 else f"line é {i} {g}") for g in ("a", "b", None) for i in range(101)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "8")
    try:
        got = {r.g: (r.n, r.sha256) for r in streamed_sha256(spark.createDataFrame(rows, "g string, i long, t string").repartition(5), ["g"], ["i"], F.concat("t", F.lit("\n"))).collect()}
        whole = streamed_sha256(spark.createDataFrame(rows, "g string, i long, t string"), [], ["i", F.col("g")], F.col("t")).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for g in ("a", "b", None):
        text = "".join(f"{t}\n" for h, _, t in rows if h == g and t is not None)
        assert got[g] == (101, hashlib.sha256(text.encode()).hexdigest())
    order = sorted(rows, key=lambda r: (r[1], r[0] is not None, r[0] or ""))
    assert [tuple(r) for r in whole] == [(303, hashlib.sha256("".join(t or "" for *_, t in order).encode()).hexdigest())]
    assert streamed_sha256(spark.createDataFrame([], "g string, i long, t string"), ["g"], ["i"], F.col("t")).count() == 0


def test_export_digest_is_that_of_the_file(spark, tmp_path, monkeypatch):
    import hashlib

    from pyspark.sql import functions as F

    monkeypatch.setattr(publish, "PART_LINES", 40)
    df = spark.range(1000).select(F.format_string("k%04d", F.col("id")).alias("key"), (F.col("id") / 3).alias("x"), F.when(F.col("id") % 5 > 0, F.lit('a "b"')).alias("t")).repartition(7)
    empty = df.where("false")
    promoted = spark.createDataFrame([("d",)], "as_of_date string")
    found = {r.export: r for r in publish.manifest(spark, str(tmp_path / "out"), {"one": (df, ("key", "x", "t"), ("key",)), "none": (empty, ("key",), ("key",))}, promoted).collect()}
    lines = ["key,x,t"] + [f'"k{i:04d}",{i / 3:.9f},' + ('"a ""b"""' if i % 5 else "") for i in range(1000)]
    assert found["one"].row_count == 1000 and found["one"].sha256 == hashlib.sha256("".join(f"{x}\n" for x in lines).encode()).hexdigest()
    assert found["none"].row_count == 0 and found["none"].sha256 == hashlib.sha256(b"key\n").hexdigest()
    parts = sorted((tmp_path / "out" / "one.csv" / "rows").glob("part-*"))
    assert len(parts) > 20 and b"".join((tmp_path / "out" / "one.csv" / d / p.name).read_bytes() for d in ("header", "rows") for p in sorted((tmp_path / "out" / "one.csv" / d).glob("part-*"))) == "".join(f"{x}\n" for x in lines).encode()


def test_control_source(spark):
    runs = "attempt_id string, normalized_outcome string, ended_at_utc string, as_of_date string, release_revision long, revision_fingerprint string"
    promoted = spark.createDataFrame([("d", 1, "f")], "as_of_date string, release_revision long, revision_fingerprint string")
    got = {}
    for outcome in ("accepted", "recovered", "no_new_release", "rejected", None):
        for f in ("f", "g"):
            row = publish.control_source(spark.createDataFrame([("a", "accepted", "2020", "d", 1, "f"), ("b", outcome, "2021", "d", 1, f)], runs), promoted, None if f == "f" else "2026-01-01")
            assert publish.control_faults(row).count() == 0
            got[outcome, f] = tuple(row.first())
    assert got["accepted", "f"] == ("accepted", "none", "2021", False, "active", None)
    assert got["recovered", "g"] == ("accepted", "none", "2021", True, "retired", "2026-01-01")
    assert got["no_new_release", "g"][:4] == ("no_new_release", "source_not_advanced", "2021", False)
    assert got["rejected", "f"][:4] == ("rejected", "structural_rejection", "2021", True) and got[None, "f"][:4] == ("operational_error", "source_transfer_error", "2021", True)
    bad = [("odd", "none", "t", True, "active", None), ("rejected", "odd", "t", False, "retired", None), ("no_new_release", "none", "t", True, "active", "2020-01-01"), ("accepted", "none", "t", None, None, "x")]
    schema = "outcome string, reason_category string, ended_at_utc string, newer_attempt_not_accepted boolean, source_publication_state string, source_publication_retired_on string"
    faults = [sorted(r[0] for r in publish.control_faults(spark.createDataFrame([b], schema)).collect()) for b in bad]
    assert faults == [["outcome"], ["reason_category", "retirement", "warning"], ["retirement", "warning"], ["retirement", "warning"]]


def test_csv_quotes_and_nulls(spark):
    df = spark.createDataFrame([('a "b"', None, 3, None)], "s string, t string, n long, d date")
    assert publish.export_lines(df, ("s", "t", "n", "d"), ("s",)).first()[0] == '"a ""b""",,3,'


def test_empty_panel(spark):
    _, promoted, _, records, snapshots, sequence = frames(spark, {("a", 0): "D"})
    none = sequence.where("false")
    assert panel.spells(none).count() == panel.transitions(none, promoted).count() == 0
    assert metrics.transition_matrix(metrics.transition_cells(panel.transitions(none, promoted))).count() == 0


def test_exact_membership(spark):
    *_, snapshots, _ = frames(spark, random_panel(3, 20))
    a, b = metrics.membership_hash(snapshots), metrics.membership_hash(snapshots.where("key <> 'k3'"))
    differ = {r.as_of_date for r in a.exceptAll(b).collect()}
    assert differ == {r.as_of_date for r in snapshots.where("key = 'k3'").collect()}
    keys = {}
    for r in snapshots.collect():
        keys.setdefault(r.as_of_date, set()).add(r.key)
    assert {r.as_of_date: (r.n_keys, r.membership_sha256) for r in metrics.membership_digest(snapshots.union(snapshots)).collect()} == {d: (len(k), hashlib.sha256("".join(f"{x}\n" for x in sorted(k)).encode()).hexdigest()) for d, k in keys.items()}
    one, two = metrics.membership_fingerprint(snapshots), metrics.membership_fingerprint(snapshots.union(snapshots))
    assert one.exceptAll(two).count() == 0
