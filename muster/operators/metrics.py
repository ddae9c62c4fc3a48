"""Aggregate marts over dispositions, transitions, spells and capture attempts.

Counts per pair of releases come from one grouping of the transitions (transition_cells), which has few rows and which
several marts share. All groupings here end in a row per release, pair or status, and combine before they shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from muster.contracts import RELEASE, PanelSpec
from muster.functions.digests import streamed_sha256
from muster.functions.expr import days_between, n_where, number_text, ratio, seconds_between, wilson
from muster.operators.panel import adjacent_pairs

PAIR = [*(f"from_{c}" for c in RELEASE), *(f"to_{c}" for c in RELEASE)]
PAIR_GAP = [*PAIR, "gap_days"]
KEYED = "eligible_for_keyed_path"


def is_class(name: str) -> Column:
    return F.col("transition_class") == name


def unkeyed_coverage(records: DataFrame) -> DataFrame:
    """Records without a key, by list and status; an absent status is a group of its own."""
    found = records.where(F.col("disposition") == "untracked_blank_registration")
    return found.groupBy(*RELEASE, "parser_contract_version", "source_list", "status").agg(F.count("*").alias("record_count"))


def population_coverage(records: DataFrame) -> DataFrame:
    """All promoted records by list, status, and whether they are keyed."""
    kind = F.when(F.col("disposition") == KEYED, "keyed").otherwise("unkeyed").alias("coverage_class")
    return records.groupBy(*RELEASE, "source_list", "status", kind).agg(F.count("*").alias("record_count"))


def transition_cells(transitions: DataFrame) -> DataFrame:
    """Transitions counted by all that the marts of pairs ask of them: ends, class, statuses, and the renewal dates'
    state. A few rows for each pair, so marts that need several countings are made from these."""
    state = {}
    if "start_last_renewal_date" in transitions.columns:
        populated = F.col("start_last_renewal_date").isNotNull() | F.col("start_last_renewal_date_unparseable")
        cleared = F.col("end_last_renewal_date").isNull() & ~F.coalesce("end_last_renewal_date_unparseable", F.lit(False))
        state = {"renewal_populated": F.coalesce(populated, F.lit(False)), "renewal_cleared": F.coalesce(populated & cleared, F.lit(False))}
    keys = [*PAIR_GAP, "observed_at_start", "observed_at_end", "transition_class", "start_status", "end_status", "start_at_risk", "end_at_risk"]
    return transitions.groupBy(*keys, *(c.alias(name) for name, c in state.items())).agg(F.count("*").alias("cell_count"))


def transition_matrix(cells: DataFrame) -> DataFrame:
    return cells.groupBy(*PAIR_GAP, "observed_at_start", "observed_at_end", "transition_class", "start_status", "end_status").agg(F.sum("cell_count").alias("transition_count"))


def pair_counts(cells: DataFrame) -> DataFrame:
    """Every conditional count per pair that the marts below need."""
    start, end = F.col("start_at_risk"), F.col("end_at_risk")
    at_start, at_end = F.col("observed_at_start"), F.col("observed_at_end")
    counts = {
        "starting_at_risk_count": at_start & start,
        "ending_at_risk_count": at_end & end,
        "observed_exit_count": is_class("delinquency_exit_observed"),
        "still_at_risk_count": is_class("delinquency_still_observed"),
        "not_observed_count": is_class("delinquent_lost_to_observation"),
        "matched_entry_count": is_class("delinquency_entry_observed"),
        "newly_observed_count": is_class("delinquent_newly_observed"),
    }
    if "renewal_populated" in cells.columns:
        counts |= {
            "starting_clear_count": at_start & at_end & start & F.col("renewal_cleared"),
            "exit_clear_count": is_class("delinquency_exit_observed") & F.col("renewal_cleared"),
            "exit_populated_count": is_class("delinquency_exit_observed") & F.col("renewal_populated"),
        }
    return cells.groupBy(*PAIR_GAP).agg(*(F.coalesce(F.sum(F.when(c, F.col("cell_count"))), F.lit(0)).cast("bigint").alias(name) for name, c in counts.items()))


def largest_transitions(matrix: DataFrame) -> DataFrame:
    """The most frequent movement of each pair among keys seen at both ends; ties by status, absent ones under a token."""
    token = lambda c: F.coalesce(c, F.lit("__NULL_STATUS__"))
    order = Window.partitionBy(*PAIR).orderBy(F.desc("transition_count"), token("start_status"), token("end_status"))
    ranked = matrix.where("observed_at_start and observed_at_end").withColumn("place", F.row_number().over(order)).where("place = 1")
    return ranked.select(*PAIR, F.col("start_status").alias("largest_from_status"), F.col("end_status").alias("largest_to_status"), F.col("transition_count").alias("largest_count"))


def pair_metrics(counts: DataFrame, matrix: DataFrame) -> DataFrame:
    """Movement of each pair: entrants, net movement, exit share with its interval, and the largest movement."""
    exits, start = F.col("observed_exit_count"), F.col("starting_at_risk_count")
    return counts.join(largest_transitions(matrix), PAIR, "left").select(
        *PAIR_GAP,
        "starting_at_risk_count", "ending_at_risk_count", "observed_exit_count", "still_at_risk_count", "not_observed_count", "matched_entry_count", "newly_observed_count",
        (F.col("matched_entry_count") + F.col("newly_observed_count")).alias("total_entrant_count"),
        (F.col("ending_at_risk_count") - start).alias("net_movement"),
        F.lit("starting_published_delinquent_cohort_v1").alias("observed_exit_denominator_id"),
        ratio(exits, start).alias("observed_exit_proportion"),
        "largest_from_status", "largest_to_status", "largest_count",
        F.lit("matched_observed_entry_population_v1").alias("matched_entry_denominator_id"),
        F.lit("all_entrant_population_v1").alias("total_entrant_denominator_id"),
        wilson(exits, start, "lower").alias("observed_exit_wilson_95_lower"),
        wilson(exits, start, "upper").alias("observed_exit_wilson_95_upper"),
    )


def cohort_persistence(counts: DataFrame) -> DataFrame:
    """What became of the keys at risk at each pair's start."""
    return counts.select(
        *PAIR_GAP, "starting_at_risk_count", "still_at_risk_count", "observed_exit_count", "not_observed_count",
        F.lit("starting_published_delinquent_cohort_v1").alias("persistence_denominator_id"),
        ratio(F.col("still_at_risk_count"), F.col("starting_at_risk_count")).alias("persistence_proportion"),
    )


def renewal_diagnostic(counts: DataFrame) -> DataFrame:
    """Three measures of whether a cleared renewal date goes with an exit, as rows."""

    def measure(name: str, of: str, numerator: str, denominator: str) -> Column:
        return F.struct(F.lit(name).alias("measure_name"), F.lit(of).alias("denominator_definition_id"), F.col(denominator).alias("diagnostic_eligible_count"), F.col(numerator).alias("numerator_count"), F.col(denominator).alias("denominator_count"))

    rows = counts.select(
        *PAIR_GAP,
        F.explode(
            F.array(
                measure("conditional_precision", "starting_delinquent_diagnostic_clears_v1", "exit_clear_count", "starting_clear_count"),
                measure("eligible_exit_sensitivity", "observed_exits_with_populated_start_v1", "exit_clear_count", "exit_populated_count"),
                measure("all_exit_sensitivity", "all_observed_exits_v1", "exit_clear_count", "observed_exit_count"),
            )
        ).alias("m"),
    ).select(*PAIR_GAP, F.lit("release_quality_diagnostic").alias("diagnostic_role"), "m.*")
    k, n = F.col("numerator_count"), F.col("denominator_count")
    return rows.withColumn("measure_value", ratio(k, n)).withColumn("wilson_95_lower", wilson(k, n, "lower")).withColumn("wilson_95_upper", wilson(k, n, "upper"))


def snapshot_metrics(records: DataFrame, promoted: DataFrame, spec: PanelSpec) -> DataFrame:
    """Per release and at-risk status: its count, zero if there is none, and how much of the release is keyed.

    The status counts include records without a key, unlike `at_risk` of the snapshots."""
    counts = records.groupBy(*RELEASE).agg(F.count("*").alias("total"), n_where(F.col("disposition") == KEYED).alias("keyed"), n_where(F.col("disposition") != KEYED).alias("unkeyed"))
    by_status = records.where(F.col("status").isin(*spec.at_risk)).groupBy(*RELEASE, F.col("status").alias("category")).agg(F.count("*").alias("category_count"))
    scaffold = promoted.withColumn("category", F.explode(F.array(*map(F.lit, spec.at_risk))))
    joined = scaffold.join(counts, list(RELEASE), "left").join(by_status, [*RELEASE, "category"], "left")
    share = lambda part: [ratio(F.col(part), F.col("total")).alias(f"{part}_proportion"), *(wilson(F.col(part), F.col("total"), s).alias(f"{part}_wilson_95_{s}") for s in ("lower", "upper"))]
    return joined.select(
        *RELEASE, "parser_contract_version", "category",
        *(F.coalesce(c, F.lit(0)).alias(f"{name}_count") for c, name in (("category_count", "category"), ("keyed", "keyed_record"), ("unkeyed", "unkeyed_record"), ("total", "raw_total_record"))),
        F.lit("all_promoted_release_records_v1").alias("coverage_denominator_id"),
        *share("keyed"), *share("unkeyed"),
    )


def status_age(snapshots: DataFrame) -> DataFrame:
    """How old the reported status date is; it describes and never classifies."""
    date, at = F.col("current_status_date"), F.col("as_of_date").cast("date")
    state = F.when(F.col("current_status_date_unparseable"), "invalid_nonblank").when(date.isNull(), "missing").when(date > at, "future_reported_date").otherwise("valid_reported_date")
    age = F.when(date <= at, days_between(date, at))
    return snapshots.groupBy(*RELEASE, state.alias("status_age_state"), age.alias("status_age_days")).agg(F.count("*").alias("record_count"))


def spell_censoring(spells: DataFrame) -> DataFrame:
    return spells.groupBy("terminal_state").agg(F.count("*").alias("spell_count"))


def claim_support(transitions: DataFrame, metrics: DataFrame, spec: PanelSpec) -> DataFrame:
    """For the first pair: how much of the entries came from one status, and the date most entries report."""
    both = transitions.where("observed_at_start and observed_at_end")
    support = both.where((F.col("start_status") == spec.claim_status) & F.col("end_at_risk")).groupBy(*PAIR).agg(F.count("*").alias("support"))
    dates = transitions.where(is_class("delinquency_entry_observed")).groupBy(*PAIR, F.col("end_current_status_date").alias("date")).agg(F.count("*").alias("n"))
    order = Window.partitionBy(*PAIR).orderBy(F.desc("n"), F.asc_nulls_last("date"))
    top = dates.withColumn("place", F.row_number().over(order)).where("place = 1").drop("place")
    joined = metrics.join(support, PAIR, "left").join(top, PAIR, "left")
    entries, n, dated = F.col("matched_entry_count"), F.coalesce("support", F.lit(0)), F.coalesce("n", F.lit(0))
    time = Window.partitionBy(F.lit(0)).orderBy(*PAIR)
    rows = joined.select(
        F.lit("claim_support_status_movement_v1").alias("claim_support_version"),
        *PAIR_GAP,
        F.lit(spec.claim_status).alias("matched_start_status"),
        F.lit("published_delinquent_population_v1").alias("matched_end_population"),
        n.alias("support_count"), entries.alias("support_denominator_count"), ratio(n, entries).alias("support_share"),
        "total_entrant_count",
        F.col("date").alias("dominant_status_date"), dated.alias("dominant_status_date_count"), ratio(dated, entries).alias("dominant_status_date_share"),
        F.lead("from_as_of_date").over(time).alias("next_from_as_of_date"), F.lead("to_as_of_date").over(time).alias("next_to_as_of_date"),
        F.lead("gap_days").over(time).alias("next_gap_days"), F.lead("matched_entry_count").over(time).alias("next_matched_entry_count"),
        F.row_number().over(time).alias("place"),
    )
    return rows.where("place = 1").drop("place")


def release_totals(records: DataFrame, spec: PanelSpec) -> DataFrame:
    return records.groupBy(*RELEASE).agg(F.count("*").alias("total_count"), n_where(F.col("key") != "").alias("keyed_count"), n_where(F.col("status").isin(*spec.at_risk)).alias("at_risk_count"))


def membership_fingerprint(snapshots: DataFrame) -> DataFrame:
    """Per release a fingerprint of its set of keys that needs no order: sums of two halves of each distinct key's
    SHA-256, and the count. It combines before it shuffles, so it holds at any size."""
    half = lambda at: F.conv(F.substring(F.sha2("key", 256), at, 12), 16, 10).cast("bigint")
    keys = snapshots.select(*RELEASE, "key").distinct()
    return keys.groupBy(*RELEASE).agg(F.count("*").alias("n_keys"), F.sum(half(1) % 1_000_000_007).alias("sum_a"), F.sum(half(13) % 1_000_000_007).alias("sum_b"))


#: Keys of a range of membership_hash, on average.
RANGE_KEYS = 65_536


def membership_hash(snapshots: DataFrame, range_keys: int = RANGE_KEYS) -> DataFrame:
    """Per release a SHA-256 that two releases share if and only if they have the same keys. Keys fall into ranges by
    the beginning of their own SHA-256, as many digits of it as leave about `range_keys` keys to a range of the largest
    release (two at least), so no task holds more; a range's sorted keys, each with a line feed, make its digest, and
    the digests in order make the release's, in a second step by the first two digits."""
    keys = snapshots.select(*RELEASE, "key").distinct()
    most = keys.groupBy(*RELEASE).count().agg(F.max("count")).first()[0] or 0
    digits = 2
    while most > range_keys * 16**digits and digits < 12:
        digits += 1
    joined = lambda rows: F.sha2(F.array_join(F.array_sort(F.collect_list(rows)), ""), 256)
    ranges = keys.groupBy(*RELEASE, F.substring(F.sha2("key", 256), 1, digits).alias("range")).agg(joined(F.concat("key", F.lit("\n"))).alias("digest"), F.count("*").alias("n"))
    for d in range(digits - 2, 1, -2):
        ranges = ranges.groupBy(*RELEASE, F.substring("range", 1, d).alias("range")).agg(joined(F.concat("range", "digest")).alias("digest"), F.sum("n").alias("n"))
    return ranges.groupBy(*RELEASE).agg(F.sum("n").alias("n_keys"), joined(F.concat("range", "digest")).alias("membership_sha256"))


def membership_digest(snapshots: DataFrame) -> DataFrame:
    """Per release the plain form: SHA-256 over all its sorted distinct keys, each with a line feed. A release's keys stream
    through one task in order; membership_hash spreads them over many, at the price of a form of its own."""
    keys = snapshots.select(*RELEASE, "key").distinct()
    return streamed_sha256(keys, RELEASE, ["key"], F.concat("key", F.lit("\n"))).select(*RELEASE, F.col("n").alias("n_keys"), F.col("sha256").alias("membership_sha256"))


def capture_runs(attempts: DataFrame) -> DataFrame:
    """Attempts with one vocabulary for their outcomes; what no rule reaches stays null."""
    form, raw = F.col("attempt_shape"), F.col("raw_status")
    outcome = (
        F.when((form == "admission_v1") & (raw == "rejected"), "rejected")
        .when((form == "store_v1") & (raw == "accepted") & ~F.col("recovered"), "accepted")
        .when((form == "store_v1") & (raw == "accepted") & F.col("recovered"), "recovered")
        .when((form == "store_v1") & (raw == "no_new_release"), "no_new_release")
        .when((form == "v2") & raw.isin("accepted", "no_new_release", "rejected", "recovered"), raw)
    )
    timed = (form == "v2") & F.col("started_at_utc").isNotNull() & F.col("ended_at_utc").isNotNull()
    forward = F.col("ended_at_utc").try_cast("timestamp") >= F.col("started_at_utc").try_cast("timestamp")
    return attempts.select(
        "attempt_id", "attempt_shape", F.col("schema_version").alias("source_schema_version"), "raw_status", *RELEASE, "reason_count",
        outcome.alias("normalized_outcome"),
        F.when(F.coalesce(timed, F.lit(False)), "timing_available").otherwise("timing_unavailable").alias("timing_state"),
        "started_at_utc", "ended_at_utc",
        F.when(timed & forward, seconds_between(F.col("started_at_utc"), F.col("ended_at_utc"))).alias("duration_seconds"),
    )


def release_flags(promoted: DataFrame, runs: DataFrame, records: DataFrame) -> DataFrame:
    """Three versioned rules, a row for each release or pair that one applies to."""
    text, number = F.lit(None).cast("string"), F.lit(None).cast("bigint")
    kinds = {"as_of_date": text, "release_revision": number, "revision_fingerprint": text}

    def flags(df: DataFrame, rule: str, kind: str, parameter: str, value: Column, result: Column) -> DataFrame:
        pairwise = "from_as_of_date" in df.columns
        own = [(kinds[c] if pairwise else F.col(c)).alias(c) for c in RELEASE]
        pair = [(F.col(f"{side}_{c}") if pairwise else kinds[c]).alias(f"pair_{side}_{c}") for side in ("from", "to") for c in RELEASE]
        return df.select(
            F.lit(rule).alias("rule_id"), F.lit(1).cast("bigint").alias("rule_version"), F.lit(kind).alias("rule_class"), F.lit("release_pair" if pairwise else "release").alias("scope"),
            *own, *pair, value.alias("observed_value"), F.lit(parameter).alias("parameter_version"), result.alias("result"), text.alias("supersedes_rule_id"), number.alias("supersedes_rule_version"),
        )

    known = F.col("parser_contract_version") == 1
    parser = flags(promoted, "parser_contract_version_known_v1", "deterministic", "known-parser-contract-version-1-v1", F.col("parser_contract_version").cast("string"), F.when(known, "pass").otherwise("review"))
    linked = runs.where(" and ".join(f"{c} is not null" for c in RELEASE)).groupBy(*RELEASE).agg(n_where(F.col("normalized_outcome").isin("accepted", "recovered")).alias("n"))
    n = F.coalesce("n", F.lit(0))
    capture = flags(promoted.join(linked, list(RELEASE), "left"), "capture_outcome_available_v1", "deterministic", "linked-accepted-or-recovered-capture-run-v1", n.cast("string"), F.when(n > 0, "pass").otherwise("review"))
    keyed = records.where(F.col("disposition") == KEYED).groupBy(*RELEASE).agg(F.count("*").alias("n"))
    side = lambda name: keyed.select(*(F.col(c).alias(f"{name}_{c}") for c in RELEASE), F.col("n").alias(f"{name}_n"))
    pairs = adjacent_pairs(promoted).join(side("from"), [f"from_{c}" for c in RELEASE], "left").join(side("to"), [f"to_{c}" for c in RELEASE], "left")
    start, end = F.coalesce("from_n", F.lit(0)), F.coalesce("to_n", F.lit(0))
    change = ratio(F.abs(end - start), start)
    coverage = flags(pairs, "keyed_coverage_change_fraction_v1", "heuristic_review", "absolute-relative-change-0.10-v1", number_text(change), F.when(start == 0, "not_applicable").when(change >= 0.10, "review").otherwise("pass"))
    return parser.union(capture).union(coverage)


def release_quality(promoted: DataFrame, flags: DataFrame, runs: DataFrame) -> DataFrame:
    """Per release: its flags rolled up, and the attempts that led to it. Schema changes are literal zeros by contract."""
    rule = F.concat_ws(":", "rule_id", F.col("rule_version").cast("string"), "parameter_version")
    rolled = flags.where("scope = 'release'").groupBy(*RELEASE).agg(
        F.count("*").alias("flag_count"), n_where(F.col("result") == "pass").alias("flag_pass_count"), n_where(F.col("result") == "review").alias("flag_review_count"),
        F.array_join(F.array_sort(F.collect_set(rule)), ",").alias("flag_rule_versions"),
    )
    outcome = F.col("normalized_outcome")
    captured = runs.groupBy(*RELEASE).agg(
        F.count("*").alias("capture_attempted_count"), n_where(outcome.isin("accepted", "recovered")).alias("capture_succeeded_count"),
        n_where(outcome == "rejected").alias("capture_failed_count"), n_where(outcome == "no_new_release").alias("capture_unavailable_count"),
    )
    zero = lambda *names: [F.coalesce(c, F.lit(0)).alias(c) for c in names]
    joined = promoted.join(rolled, list(RELEASE), "left").join(captured, list(RELEASE), "left")
    return joined.select(
        *RELEASE, "parser_contract_version",
        F.when(F.coalesce("flag_review_count", F.lit(0)) == 0, "accepted_healthy").otherwise("accepted_review").alias("release_health_state"),
        *zero("flag_count", "flag_pass_count", "flag_review_count"), "flag_rule_versions",
        *(F.lit(0).cast("bigint").alias(f"schema_{c}_column_count") for c in ("added", "removed", "type_changed")),
        F.lit("registry-csv-contract-v1").alias("schema_contract_version"),
        *zero("capture_attempted_count", "capture_succeeded_count", "capture_failed_count", "capture_unavailable_count"),
    )


def publication_status(promoted: DataFrame) -> DataFrame:
    """The latest release."""
    return promoted.orderBy(F.desc("as_of_date")).limit(1).select(F.col("as_of_date").alias("published_as_of_date"), F.col("release_revision").alias("published_release_revision"))
