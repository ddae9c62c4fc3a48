"""The contract of the published exports: which marts leave, with which columns under which names, and at which grain."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from muster.operators.publish import export_faults


@dataclass(frozen=True)
class Export:
    """`columns` gives for each published column the mart's own column, or a text in quotes that is always there.

    An aggregate holds no identity, and each of its columns is part of the grain or a measure; a named history has keys
    and no measures."""

    name: str
    mart: str
    columns: dict[str, str]
    grain: tuple[str, ...]
    named: bool = False

    @property
    def measures(self) -> tuple[str, ...]:
        return () if self.named else tuple(c for c in self.columns if c not in self.grain)


def _columns(text: str) -> dict[str, str]:
    """Names that are published as they are, or name=own."""
    return dict((w.split("=") * 2)[:2] for w in text.split())


# Fixed values of the published contract: names, columns in order, grains, what an aggregate may not have, and
# the control source.
DIALECT = "quoted-text-csv-v1"
CONTROL_FILE = "capture-status.json"
CONTROL_COLUMNS = ("outcome", "reason_category", "ended_at_utc", "newer_attempt_not_accepted", "source_publication_state", "source_publication_retired_on")
PROHIBITED = ("state_charity_registration_number", "organization_name", "city", "state")
_PAIR = "from_as_of_date from_release_revision from_revision_fingerprint to_as_of_date to_release_revision to_revision_fingerprint"
_RELEASE = "as_of_date release_revision revision_fingerprint"
#: Name of the export, mart, columns (a published name, or published=own), grain.
_ROWS = [
    (
        "dim_public_organizations",
        "public_organizations",
        "state_charity_registration_number=key organization_name city state latest_source_reported_status=latest_status "
        "latest_observed_as_of_date=latest_as_of_date latest_observed_release_revision=latest_release_revision "
        "official_verification_instructions latest_release_observation_state",
        "state_charity_registration_number",
    ),
    (
        "fct_public_status_observations",
        "public_observations",
        "state_charity_registration_number=key as_of_date release_revision observation_state source_reported_status=status",
        "state_charity_registration_number as_of_date release_revision",
    ),
    (
        "mart_adjacent_pair_metrics",
        "pair_metrics",
        f"{_PAIR} gap_days starting_delinquent_count=starting_at_risk_count ending_published_delinquent_count=ending_at_risk_count "
        "observed_exit_count still_delinquent_count=still_at_risk_count not_observed_count matched_observed_entry_count=matched_entry_count "
        "newly_observed_delinquent_count=newly_observed_count total_entrant_count net_delinquent_movement=net_movement "
        "observed_exit_denominator_id observed_exit_proportion largest_transition_from_status=largest_from_status "
        "largest_transition_to_status=largest_to_status largest_transition_count=largest_count matched_entry_denominator_id "
        "total_entrant_denominator_id observed_exit_wilson_95_lower observed_exit_wilson_95_upper",
        _PAIR,
    ),
    (
        "mart_claim_support",
        "claim_support",
        f"claim_support_version {_PAIR} gap_days matched_start_status matched_end_population support_count support_denominator_count "
        "support_denominator_id='matched_observed_entry_population_v1' support_share_of_matched_entries=support_share "
        "total_matched_entry_count=support_denominator_count matched_entry_denominator_id='matched_observed_entry_population_v1' "
        "total_entrant_count total_entrant_denominator_id='all_entrant_population_v1' "
        "dominant_source_reported_status_date=dominant_status_date dominant_status_date_count "
        "dominant_status_date_denominator_count=support_denominator_count "
        "dominant_status_date_denominator_id='matched_observed_entry_population_v1' dominant_status_date_share next_from_as_of_date "
        "next_to_as_of_date next_gap_days next_total_matched_entry_count=next_matched_entry_count",
        _PAIR,
    ),
    (
        "mart_last_renewal_diagnostic",
        "renewal_diagnostic",
        f"{_PAIR} gap_days diagnostic_role measure_name denominator_definition_id diagnostic_eligible_count numerator_count "
        "denominator_count measure_value wilson_95_lower wilson_95_upper",
        f"{_PAIR} measure_name",
    ),
    (
        "mart_publication_status",
        "publication_status",
        "published_as_of_date published_release_revision",
        "published_as_of_date",
    ),
    (
        "mart_registry_population_coverage",
        "population_coverage",
        f"{_RELEASE} source_list source_reported_registry_status=status coverage_class record_count",
        f"{_RELEASE} source_list source_reported_registry_status coverage_class",
    ),
    (
        "mart_release_quality",
        "release_quality",
        f"{_RELEASE} parser_contract_version release_health_state release_flag_count=flag_count release_flag_pass_count=flag_pass_count "
        "release_flag_review_count=flag_review_count release_flag_rule_versions=flag_rule_versions schema_added_column_count "
        "schema_removed_column_count schema_type_changed_column_count schema_contract_version capture_attempted_count "
        "capture_succeeded_count capture_failed_count capture_unavailable_count",
        _RELEASE,
    ),
    (
        "mart_release_snapshot_metrics",
        "snapshot_metrics",
        f"{_RELEASE} parser_contract_version published_delinquent_category=category published_delinquent_category_count=category_count "
        "keyed_record_count unkeyed_record_count raw_total_record_count keyed_coverage_denominator_id=coverage_denominator_id "
        "unkeyed_coverage_denominator_id=coverage_denominator_id keyed_coverage_proportion=keyed_proportion "
        "keyed_coverage_wilson_95_lower=keyed_wilson_95_lower keyed_coverage_wilson_95_upper=keyed_wilson_95_upper "
        "unkeyed_coverage_proportion=unkeyed_proportion unkeyed_coverage_wilson_95_lower=unkeyed_wilson_95_lower "
        "unkeyed_coverage_wilson_95_upper=unkeyed_wilson_95_upper",
        f"{_RELEASE} published_delinquent_category",
    ),
    (
        "mart_source_reported_status_age",
        "status_age",
        f"{_RELEASE} source_reported_status_age_state=status_age_state source_reported_status_age_days=status_age_days record_count",
        f"{_RELEASE} source_reported_status_age_state source_reported_status_age_days",
    ),
    (
        "mart_spell_censoring_summary",
        "spell_censoring",
        "terminal_state spell_count",
        "terminal_state",
    ),
    (
        "mart_starting_cohort_persistence",
        "cohort_persistence",
        f"{_PAIR} gap_days starting_delinquent_count=starting_at_risk_count still_delinquent_count=still_at_risk_count observed_exit_count "
        "not_observed_count persistence_denominator_id persistence_proportion",
        _PAIR,
    ),
]
EXPORTS = {name: Export(name, mart, _columns(columns), tuple(grain.split()), mart.startswith("public_")) for name, mart, columns, grain in _ROWS}


def contract_faults(entries: dict[str, Export]) -> list[str]:
    """What is wrong with the contract itself."""
    out = []
    for name, e in entries.items():
        out += [f"{name}: grain not in columns: {c}" for c in e.grain if c not in e.columns]
        out += [f"{name}: identity in an aggregate: {c}" for c in e.columns if not e.named and c in PROHIBITED]
    marts = [e.mart for e in entries.values()]
    return out + [f"mart twice: {m}" for m in sorted(set(marts)) if marts.count(m) > 1]


def source(own: str) -> Column:
    return F.lit(own[1:-1]) if own.startswith("'") else F.col(own)


def exported(mart: DataFrame, e: Export) -> DataFrame:
    """The mart's columns under their published names, and no others."""
    return mart.select(*(source(own).alias(name) for name, own in e.columns.items()))


def gate(df: DataFrame, e: Export) -> DataFrame:
    """(export, failure_reason): columns and their order, the grain, and identities in an aggregate."""
    return export_faults(df, tuple(e.columns), e.grain, not e.named, PROHIBITED).select(F.lit(e.name).alias("export"), "failure_reason")


def eligible_keys_agree(organizations: DataFrame, classes: DataFrame) -> DataFrame:
    """(export, failure_reason) unless the organizations are as many as the eligible keys."""
    n = organizations.agg(F.count("*").alias("n")).crossJoin(F.broadcast(classes.agg(F.count(F.when(F.col("eligibility_classification") == "eligible", 1)).alias("m"))))  # one row
    return n.where("n <> m").select(F.lit("dim_public_organizations").alias("export"), F.lit("eligible_keys").alias("failure_reason"))
