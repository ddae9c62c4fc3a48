"""Data-quality checks: each gives rows (check_id, failure_reason), and none if all is well.

A check recomputes what it looks at in another way than the operator does."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from muster.contracts import DISPOSITIONS, ELIGIBILITY, FLAG_CLASSES, FLAG_RESULTS, FLAG_SCOPES, FLAG_WORDS, OUTCOMES, RELEASE, TERMINAL_STATES, TRANSITION_CLASSES, PanelSpec
from muster.operators.metrics import PAIR, PAIR_GAP


def fault(df: DataFrame, check: str, reason: str | Column) -> DataFrame:
    """A row for the check if the frame has any."""
    text = F.lit(reason) if isinstance(reason, str) else reason
    return df.select(F.lit(check).alias("check_id"), text.alias("failure_reason")).distinct()


def first_reason(df: DataFrame, check: str, reasons: dict[str, Column]) -> DataFrame:
    """Rows for which some condition holds, by name; all conditions in one pass."""
    found = F.array_compact(F.array(*(F.when(F.coalesce(c, F.lit(False)), name) for name, c in reasons.items())))
    return df.select(F.explode(found).alias("r")).select(F.lit(check).alias("check_id"), F.col("r").alias("failure_reason")).distinct()


def unequal(left: DataFrame, right: DataFrame, on: Sequence[str], check: str, reason: str) -> DataFrame:
    """Whether two frames of equal columns differ: a full outer join on the grain, compared null-safely."""
    rest = [c for c in left.columns if c not in on]
    a = left.select(*on, F.struct(*rest, F.lit(1).alias("__")).alias("a"))
    b = right.select(*on, F.struct(*rest, F.lit(1).alias("__")).alias("b"))
    keys = [a[c].eqNullSafe(b[c]) for c in on]
    joined = a.join(b, keys, "full_outer")
    return fault(joined.where(~F.col("a").eqNullSafe(F.col("b"))), check, reason)


def repeated(df: DataFrame, grain: Sequence[str], check: str) -> DataFrame:
    return fault(df.groupBy(*grain).count().where("count > 1"), check, "grain_repeats")


def columns_hold(df: DataFrame, check: str, not_null: Sequence[str] = (), accepted: dict[str, Sequence] | None = None) -> DataFrame:
    """not_null and accepted_values of a table in one aggregate pass."""
    tests = {f"null:{c}": F.col(c).isNull() for c in not_null} | {f"value:{c}": F.col(c).isNotNull() & ~F.col(c).isin(*v) for c, v in (accepted or {}).items()}
    counted = df.agg(*(F.count(F.when(t, 1)).alias(f"c{i}") for i, t in enumerate(tests.values())))
    return first_reason(counted, check, {name: F.col(f"c{i}") > 0 for i, name in enumerate(tests)})


def bare(raw: str) -> Column:
    """A landed column without the space separators at its ends."""
    return F.regexp_extract(F.col(f"`{raw}`"), r"(?s)^\p{Zs}*(.*?)\p{Zs}*$", 1)


def pairs_positive(pairs: DataFrame) -> DataFrame:
    return first_reason(pairs, "adjacent_pairs_positive", {"gap": F.col("gap_days") <= 0, "order": F.col("from_as_of_date") >= F.col("to_as_of_date")})


def blank_status_excluded(records: DataFrame) -> DataFrame:
    odd = records.where(F.col("key").isNotNull() & F.col("status").isNull() & (F.col("disposition") != "excluded_from_typed_path_blank_status"))
    return fault(odd, "blank_status_excluded", "blank_status_kept")


def capture_runs_normal(runs: DataFrame) -> DataFrame:
    timed = F.col("timing_state") == "timing_available"
    rules = {
        "no_id": F.col("attempt_id").isNull(),
        "outcome": ~F.coalesce(F.col("normalized_outcome").isin(*OUTCOMES), F.lit(True)),
        "duration_without_timing": F.col("duration_seconds").isNotNull() & ~timed,
        "negative_duration": F.col("duration_seconds") < 0,
        "v1_timed": (F.col("attempt_shape") != "v2") & timed,
    }
    return first_reason(runs, "capture_runs_normal", rules).union(repeated(runs, ["attempt_id"], "capture_runs_normal"))


def dispositions_reconcile(records: DataFrame, staged: DataFrame, promoted: DataFrame) -> DataFrame:
    """One disposition per promoted record, closed vocabulary, and totals per release that agree."""
    check = "dispositions_reconcile"
    there = staged.join(promoted.select(*RELEASE), list(RELEASE), "left_semi").groupBy(*RELEASE).agg(F.count("*").alias("n"))
    here = records.groupBy(*RELEASE).agg(F.count("*").alias("n"))
    return columns_hold(records, check, ["disposition"], {"disposition": DISPOSITIONS}).union(unequal(there, here, RELEASE, check, "totals")).union(repeated(records, [*RELEASE, "source_list", "source_line_no"], check))


def coverage_reconciles(coverage: DataFrame, records: DataFrame) -> DataFrame:
    """Counts by list, status and class against the records, and totals by release against both."""
    check, group = "coverage_reconciles", [*RELEASE, "source_list", "status", "coverage_class"]
    kind = F.when(F.col("key").isNotNull() & F.col("status").isNotNull(), "keyed").otherwise("unkeyed").alias("coverage_class")
    there = records.groupBy(*RELEASE, "source_list", "status", kind).agg(F.count("*").alias("record_count"))
    here = coverage.groupBy(*RELEASE).agg(F.sum("record_count").alias("n"))
    whole = records.groupBy(*RELEASE).agg(F.count("*").alias("n"))
    return unequal(coverage.select(*group, "record_count"), there, group, check, "groups").union(unequal(here, whole, RELEASE, check, "totals"))


def snapshots_reconcile(snapshots: DataFrame, records: DataFrame, spec: PanelSpec) -> DataFrame:
    """Keyed snapshots against the records: the same lines with the same key and status, each once; totals by release and
    list; at-risk by exact membership."""
    check, line = "snapshots_reconcile", [*RELEASE, "source_list", "source_line_no"]
    keyed = records.where("key is not null and status is not null")
    here, there = (df.groupBy(*RELEASE, "source_list").agg(F.count("*").alias("n")) for df in (snapshots, keyed))
    risk = snapshots.where(~F.col("at_risk").eqNullSafe(F.array_contains(F.array(*map(F.lit, spec.at_risk)), F.col("status"))))
    return (
        columns_hold(snapshots, check, ["key", "status", "at_risk"])
        .union(unequal(snapshots.select(*line, "key", "status"), keyed.select(*line, "key", "status"), line, check, "lines"))
        .union(unequal(here, there, [*RELEASE, "source_list"], check, "totals"))
        .union(fault(risk, check, "at_risk"))
        .union(repeated(snapshots, [*RELEASE, "key"], check))
        .union(repeated(snapshots, line, check))
    )


def promotion_holds(promoted: DataFrame, revisions: DataFrame, pointers: DataFrame) -> DataFrame:
    """One revision a date; one pointed at wins; without a pointer the highest."""
    check = "promotion_holds"
    exact = pointers.join(revisions, list(RELEASE), "left_semi")
    lost = exact.join(promoted, list(RELEASE), "left_anti")
    free = revisions.join(exact.select("as_of_date"), "as_of_date", "left_anti").groupBy("as_of_date").agg(F.max("release_revision").alias("best"))
    low = promoted.join(free, "as_of_date").where("release_revision < best")
    return repeated(promoted, ["as_of_date"], check).union(fault(lost, check, "pointer_lost")).union(fault(low, check, "not_highest"))


def transitions_classified(transitions: DataFrame) -> DataFrame:
    """The class, worked out anew from a table of cases, and null columns at missing ends only."""
    a, b, s, e = (F.col(c) for c in ("observed_at_start", "observed_at_end", "start_at_risk", "end_at_risk"))
    code = F.concat(*(F.when(x.isNull(), "-").when(x, "1").otherwise("0") for x in (a, b, s, e)))
    cases = {"1101": 0, "01-1": 1, "1110": 2, "1111": 3, "101-": 4, "1100": 5, "01-0": 6, "100-": 7}
    expected = F.create_map(*(F.lit(x) for k, i in cases.items() for x in (k, TRANSITION_CLASSES[i])))
    rules = {
        "class": ~F.col("transition_class").eqNullSafe(F.try_element_at(expected, code)),
        "start_side": a != F.col("start_status").isNotNull(),
        "end_side": b != F.col("end_status").isNotNull(),
        "absent_at_both": ~a & ~b,
    }
    return first_reason(transitions, "transitions_classified", rules)


def transitions_complete(transitions: DataFrame, snapshots: DataFrame, pairs: DataFrame) -> DataFrame:
    """Exactly the keys seen at either end of each pair, once."""
    check = "transitions_complete"
    ends = [pairs.join(snapshots.select(*(F.col(c).alias(f"{side}_{c}") for c in RELEASE), "key"), [f"{side}_{c}" for c in RELEASE]).select(*PAIR, "key") for side in ("from", "to")]
    expected = ends[0].union(ends[1]).distinct()
    return unequal(transitions.select(*PAIR, "key"), expected, [*PAIR, "key"], check, "endpoints").union(repeated(transitions, [*PAIR, "key"], check))


def pairs_are_adjacent(transitions: DataFrame, pairs: DataFrame) -> DataFrame:
    """Pairs of the transitions and of the spine are the same, both ways, with equal gaps."""
    check = "pairs_are_adjacent"
    found = transitions.select(*PAIR_GAP).distinct()
    return fault(found.join(pairs, PAIR_GAP, "left_anti"), check, "invented_pair").union(fault(pairs.join(found, PAIR_GAP, "left_anti"), check, "pair_without_transitions"))


def pairs_are_promoted(transitions: DataFrame, promoted: DataFrame) -> DataFrame:
    out = None
    for side in ("from", "to"):
        own = promoted.select(*(F.col(c).alias(f"{side}_{c}") for c in RELEASE))
        lost = fault(transitions.select(*own.columns).distinct().join(own, own.columns, "left_anti"), "pairs_are_promoted", f"{side}_not_promoted")
        out = lost if out is None else out.union(lost)
    return out


def spells_hold(spells: DataFrame, sequence: DataFrame) -> DataFrame:
    """Grain, order of bounds, exclusive states, unbroken ordinals, the at-risk observations that spells cover, and all of
    them made anew: runs as islands of ordinals, bounds by joins with the releases beside."""
    check = "spells_hold"
    rules = {
        "onset_order": F.col("onset_left") >= F.col("onset_right"),
        "run_order": F.col("onset_right") > F.col("exit_left"),
        "exit_order": F.col("exit_right") <= F.col("exit_left"),
        "left_censoring": F.col("is_left_censored") != F.col("onset_left").isNull(),
        "exit_state": (F.col("terminal_state") == "observed_exit") != F.col("exit_right").isNotNull(),
        "flags": (F.col("is_right_censored") != (F.col("terminal_state") == "right_censored")) | (F.col("is_lost_to_observation") != (F.col("terminal_state") == "lost_to_observation")),
        "state": ~F.col("terminal_state").isin(*TERMINAL_STATES),
    }
    risk = sequence.where("at_risk")
    spans = spells.select("key", "spell_number", F.col("onset_right").alias("a"), F.col("exit_left").alias("b"))
    inside = risk.select("key", "as_of_date", "ordinal").join(spans, "key").where("as_of_date between a and b").groupBy("key", "spell_number")
    inside = inside.agg(F.count("*").alias("n"), F.min("ordinal").alias("low"), F.max("ordinal").alias("high"))
    covered = inside.groupBy("key").agg(F.sum("n").alias("n"))
    last = sequence.agg(F.max("ordinal").alias("panel_last"))
    island = F.col("ordinal") - F.row_number().over(Window.partitionBy("key").orderBy("ordinal"))
    runs = risk.select("key", "as_of_date", "ordinal", island.alias("island")).groupBy("key", "island").agg(F.min("as_of_date").alias("onset_right"), F.max("as_of_date").alias("exit_left"), F.min("ordinal").alias("low"), F.max("ordinal").alias("high"))
    beside = lambda name, at, bound: sequence.select("key", (F.col("ordinal") + at).alias(name), F.col("as_of_date").alias(bound))
    made = runs.join(beside("low", 1, "onset_left"), ["key", "low"], "left").join(beside("high", -1, "exit_right"), ["key", "high"], "left").crossJoin(F.broadcast(last))  # one row
    state = F.when(F.col("exit_right").isNotNull(), "observed_exit").when(F.col("high") == F.col("panel_last"), "right_censored").otherwise("lost_to_observation")
    made = made.select("key", F.row_number().over(Window.partitionBy("key").orderBy("low")).cast("bigint").alias("spell_number"), "onset_left", "onset_right", "exit_left", "exit_right", state.alias("terminal_state"))
    return (
        first_reason(spells, check, rules)
        .union(repeated(spells, ["key", "spell_number"], check))
        .union(fault(inside.where("n <> high - low + 1"), check, "broken_run"))
        .union(unequal(risk.groupBy("key").agg(F.count("*").alias("n")), covered, ["key"], check, "coverage"))
        .union(unequal(spells.select(made.columns), made, ["key", "spell_number"], check, "made_anew"))
    )


def metrics_add_up(metrics: DataFrame, transitions: DataFrame) -> DataFrame:
    """Sums of the pair metrics, and their exits and largest movement worked out from the transitions."""
    check = "metrics_add_up"
    rules = {
        "cohort": F.col("starting_at_risk_count") != F.col("observed_exit_count") + F.col("still_at_risk_count") + F.col("not_observed_count"),
        "entrants": F.col("total_entrant_count") != F.col("matched_entry_count") + F.col("newly_observed_count"),
        "ending": F.col("ending_at_risk_count") != F.col("still_at_risk_count") + F.col("total_entrant_count"),
        "net": F.col("net_movement") != F.col("ending_at_risk_count") - F.col("starting_at_risk_count"),
        "share": (F.col("starting_at_risk_count") == 0) != F.col("observed_exit_proportion").isNull(),
        "interval": (F.col("observed_exit_wilson_95_lower") > F.col("observed_exit_proportion") + 1e-9) | (F.col("observed_exit_wilson_95_upper") < F.col("observed_exit_proportion") - 1e-9),
    }
    a, b, s, e = (F.coalesce(c, F.lit(False)) for c in ("observed_at_start", "observed_at_end", "start_at_risk", "end_at_risk"))
    counts = {
        "starting_at_risk_count": s, "ending_at_risk_count": e, "observed_exit_count": a & b & s & ~e, "still_at_risk_count": a & b & s & e,
        "not_observed_count": s & ~b, "matched_entry_count": a & b & ~s & e, "newly_observed_count": e & ~a,
    }
    again = transitions.groupBy(*PAIR).agg(*(F.count(F.when(c, 1)).alias(name) for name, c in counts.items()))
    both = transitions.where("observed_at_start and observed_at_end").groupBy(*PAIR, "start_status", "end_status").agg(F.count("*").alias("n"))
    top = both.groupBy(*PAIR).agg(F.min(F.struct(-F.col("n"), "start_status", "end_status")).alias("t"))
    top = top.select(*PAIR, F.col("t.start_status").alias("largest_from_status"), F.col("t.end_status").alias("largest_to_status"), (-F.col("t.col1")).alias("largest_count"))
    own = metrics.where("largest_count is not null").select(top.columns)
    return first_reason(metrics, check, rules).union(unequal(metrics.select(again.columns), again, PAIR, check, "counts")).union(unequal(own, top, PAIR, check, "largest"))


def diagnostics_add_up(diagnostic: DataFrame, transitions: DataFrame) -> DataFrame:
    """Bounds, grain, and the three measures counted anew, a row each, from the transitions."""
    check = "diagnostics_add_up"
    rules = {"numerator": F.col("numerator_count") > F.col("denominator_count"), "value": (F.col("denominator_count") == 0) != F.col("measure_value").isNull()}
    there = F.coalesce("start_last_renewal_date_unparseable", F.lit(False)) | F.col("start_last_renewal_date").isNotNull()
    gone = F.col("end_last_renewal_date").isNull() & ~F.coalesce("end_last_renewal_date_unparseable", F.lit(False))
    seen = transitions.where("start_at_risk and observed_at_end").select(*PAIR, (~F.col("end_at_risk")).alias("leaves"), there.alias("there"), (there & gone).alias("clears"))
    parts = {"conditional_precision": "clears", "eligible_exit_sensitivity": "leaves and there", "all_exit_sensitivity": "leaves"}
    every = [seen.groupBy(*PAIR).agg(F.count(F.when(F.expr(of), 1)).alias("denominator_count"), F.count(F.when(F.expr(f"({of}) and leaves and clears"), 1)).alias("numerator_count")).withColumn("measure_name", F.lit(name)) for name, of in parts.items()]
    again = every[0].unionByName(every[1]).unionByName(every[2])
    grain = [*PAIR, "measure_name"]
    own = diagnostic.select(again.columns).join(seen.select(*PAIR).distinct(), PAIR, "left_semi")
    idle = diagnostic.join(seen.select(*PAIR).distinct(), PAIR, "left_anti").where("denominator_count <> 0 or numerator_count <> 0")
    return first_reason(diagnostic, check, rules).union(repeated(diagnostic, grain, check)).union(unequal(own, again, grain, check, "counts")).union(fault(idle, check, "counts"))


def claim_holds(claim: DataFrame, transitions: DataFrame, pairs: DataFrame, spec: PanelSpec) -> DataFrame:
    """The claim's row made anew from the transitions of the first pair alone, with what the second pair adds."""
    check = "claim_holds"
    ends = pairs.agg(F.slice(F.array_sort(F.collect_list(F.struct(*PAIR_GAP))), 1, 2).alias("p"))  # pairs are a row for each release
    first = ends.select(*(F.col("p")[0][c].alias(c) for c in PAIR_GAP), F.try_element_at("p", F.lit(2)).alias("second")).where("from_as_of_date is not null")
    own = transitions.join(F.broadcast(first.select(*PAIR)), PAIR)  # one row
    entry = F.coalesce(F.col("observed_at_start") & F.col("observed_at_end") & ~F.col("start_at_risk") & F.col("end_at_risk"), F.lit(False))
    told = F.coalesce((F.col("start_status") == spec.claim_status) & F.col("end_at_risk"), F.lit(False))
    counts = own.agg(F.count(F.when(told, 1)).alias("support_count"), F.count(F.when(entry, 1)).alias("support_denominator_count"), F.count(F.when(F.col("end_at_risk") & (entry | ~F.col("observed_at_start")), 1)).alias("total_entrant_count"))
    dates = own.where(entry).groupBy(F.col("end_current_status_date").alias("date")).agg(F.count("*").alias("n"))
    best = dates.agg(F.min(F.struct(-F.col("n"), F.col("date").isNull(), "date")).alias("d")).select(F.col("d.date").alias("dominant_status_date"), F.coalesce(-F.col("d.col1"), F.lit(0)).alias("dominant_status_date_count"))
    made = first.select(*PAIR_GAP, F.col("second.from_as_of_date").alias("next_from_as_of_date"), F.col("second.gap_days").alias("next_gap_days")).crossJoin(F.broadcast(counts)).crossJoin(F.broadcast(best))  # one row each
    shares = {"support_share": ("support_count", "support_denominator_count"), "dominant_status_date_share": ("dominant_status_date_count", "support_denominator_count")}
    rules = {name: ~F.coalesce(F.abs(F.col(name) * F.col(n) - F.col(k)) < 1e-6, F.col(name).isNull() & (F.col(n) == 0)) for name, (k, n) in shares.items()}
    return unequal(claim.select(made.columns), made, PAIR, check, "made_anew").union(first_reason(claim, check, rules))


def staging_equals_landed(staged: DataFrame, landed: DataFrame, columns: dict[str, str], required: Sequence[str] = (), forbidden: Sequence[str] = ()) -> DataFrame:
    """Every landed line is staged once, its texts trimmed and blank as null, and nothing else; names of columns that have
    to be there, and parts of names that must not."""
    check, line = "staging_equals_landed", [*RELEASE, "source_list", "source_line_no"]
    plain = landed.select(*line, *(F.when(bare(raw) != "", bare(raw)).alias(name) for raw, name in columns.items()))
    names = [f"missing:{c}" for c in required if c not in staged.columns] + [f"forbidden:{c}" for c in staged.columns if any(f in c.lower() for f in forbidden)]
    named = staged.sparkSession.createDataFrame([(check, n) for n in names], "check_id string, failure_reason string")
    return unequal(staged.select(*line, *columns.values()), plain, line, check, "lines").union(repeated(staged, line, check)).union(named)


def eligibility_complete(classes: DataFrame, snapshots: DataFrame, organizations: DataFrame, latest: DataFrame) -> DataFrame:
    check = "eligibility_complete"
    keys = snapshots.select("key").distinct()
    public = organizations.select("key")
    now = snapshots.join(F.broadcast(latest), (F.col("as_of_date") == F.col("published_as_of_date")) & (F.col("release_revision") == F.col("published_release_revision"))).select("key").distinct()  # one row
    shown = organizations.where("latest_release_observation_state = 'observed'").select("key")
    return (
        unequal(classes.select("key"), keys, ["key"], check, "keys")
        .union(columns_hold(classes, check, ["eligibility_classification"], {"eligibility_classification": ELIGIBILITY}))
        .union(unequal(public, classes.where("eligibility_classification = 'eligible'").select("key"), ["key"], check, "public_keys"))
        .union(repeated(organizations, ["key"], check))
        .union(unequal(shown, now.join(public, "key", "left_semi"), ["key"], check, "latest_flag"))
        .union(fault(latest.agg(F.count("*").alias("n")).where("n > 1"), check, "banner"))
    )


def public_grid_complete(observations: DataFrame, organizations: DataFrame, promoted: DataFrame) -> DataFrame:
    check = "public_grid_complete"
    here = observations.groupBy("key").agg(F.count("*").alias("n"))
    expected = organizations.select("key").crossJoin(F.broadcast(promoted.agg(F.count("*").alias("n"))))  # one row
    state = {"state": (F.col("observation_state") == "observed") != F.col("status").isNotNull()}
    return unequal(here, expected, ["key"], check, "rows").union(repeated(observations, ["key", *RELEASE], check)).union(first_reason(observations, check, state))


def flags_hold(flags: DataFrame) -> DataFrame:
    check = "flags_hold"
    single, pair = F.col("as_of_date").isNotNull(), F.col("pair_from_as_of_date").isNotNull()
    held = columns_hold(flags, check, ["rule_id", "rule_version", "result"], {"result": FLAG_RESULTS, "rule_class": FLAG_CLASSES, "scope": FLAG_SCOPES})
    told = F.lower(F.concat_ws(" ", "rule_id", "parameter_version", "result"))
    shape = first_reason(flags, check, {"identity": single == pair, "scope": (F.col("scope") == "release") != single, "wording": told.rlike("|".join(FLAG_WORDS))})
    return held.union(shape).union(repeated(flags, ["rule_id", "rule_version", *RELEASE, *(f"pair_{c}" for c in PAIR)], check))


def provenance_closed(records: DataFrame, lists: Sequence[str]) -> DataFrame:
    rules = {"list": ~F.coalesce(F.col("source_list").isin(*lists), F.lit(False)), "line": ~F.coalesce(F.col("source_line_no") > 0, F.lit(False)), "identity": F.greatest(*(F.col(c).isNull() for c in RELEASE))}
    return first_reason(records, "provenance_closed", rules)


def totals_match(totals: DataFrame, golden: DataFrame, on: Sequence[str] = RELEASE) -> DataFrame:
    """Totals against known ones; what is missing on a side counts as -1."""
    rest = [c for c in golden.columns if c not in on]
    a = totals.select(*on, *(F.col(c).alias(f"a_{c}") for c in rest))
    b = golden.select(*on, *(F.col(c).alias(f"b_{c}") for c in rest))
    joined = a.join(b, list(on), "full_outer")
    return first_reason(joined, "totals_match", {c: F.coalesce(f"a_{c}", F.lit(-1)) != F.coalesce(f"b_{c}", F.lit(-1)) for c in rest})


def keys_exact(staged: DataFrame, landed: DataFrame, key: str = "State Charity Reg#", federal: str = "federal_id") -> DataFrame:
    """Keys are what was landed, trimmed, line by line, and were never filled from the federal id."""
    line = [*RELEASE, "source_list", "source_line_no"]
    own = landed.select(*line, bare(key).alias("landed_key"))
    joined = staged.select(*line, "key", F.col(federal).alias("federal")).join(own, line)
    blank = F.coalesce(F.col("landed_key"), F.lit("")) == ""
    return first_reason(joined, "keys_exact", {"changed": ~blank & ~F.col("key").eqNullSafe(F.col("landed_key")), "filled": blank & F.col("key").isNotNull(), "from_federal_id": blank & (F.col("key") == F.col("federal"))})


def sequence_neighbours(sequence: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Neighbours are the nearest observations whatever their risk: counted anew by a window over the snapshots."""
    order = Window.partitionBy("key").orderBy("as_of_date")
    again = snapshots.select("key", "as_of_date", F.lag("as_of_date").over(order).alias("p"), F.lead("as_of_date").over(order).alias("n"))
    own = sequence.select("key", "as_of_date", F.col("prior_as_of_date").alias("p"), F.col("next_as_of_date").alias("n"))
    return unequal(own, again, ["key", "as_of_date"], "sequence_neighbours", "neighbours")
