"""The panel's queries over the order tables, and the SQL that says the same in another way."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from muster.adapters import CARRIED, SPEC, Panel, table
from muster.contracts import ATTEMPT_KEYS, ATTEMPTS, CLASSIFICATIONS, HEADERS, LANDED, REASON_RANK, RELEASE, SOURCE_LISTS, STATUSES
from muster.functions.expr import normal_as_of_date
from muster.functions.shared import fresh_path, written
from muster.operators import exports, metrics, panel, publish, scan, validation
from muster.plans import checks
from muster.sources import landing
from muster.streaming import jobs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

ATTRIBUTES = SPEC.attributes

_PAIR = ", ".join(metrics.PAIR)
_WILSON = """CASE WHEN {n} = 0 THEN NULL ELSE greatest(0.0, least(1.0, (({k})::DOUBLE / nullif({n}, 0) + 3.8414588206941254::DOUBLE / (2.0::DOUBLE * nullif({n}, 0)) {s}
  1.959963984540054::DOUBLE * sqrt((({k})::DOUBLE / nullif({n}, 0) * (1.0::DOUBLE - ({k})::DOUBLE / nullif({n}, 0)) + 3.8414588206941254::DOUBLE / (4.0::DOUBLE * nullif({n}, 0))) / nullif({n}, 0)))
  / (1.0::DOUBLE + 3.8414588206941254::DOUBLE / nullif({n}, 0)))) END"""


def _wilson(k: str, n: str, side: str) -> str:
    return _WILSON.format(k=k, n=n, s="-" if side == "lower" else "+")


#: The panel in SQL. Dates are written out from the orders' own columns, so parsing is held against what was put in.
BASE = """
WITH ord AS (
  SELECT *, strftime(date_trunc('quarter', o_orderdate), '%Y-%m-%d') AS as_of_date FROM orders
), revisions AS (
  SELECT as_of_date, release_revision, sha256(as_of_date || ':' || release_revision) AS revision_fingerprint,
         CASE WHEN substr(as_of_date, 4, 1) IN ('3', '7') THEN 2 ELSE 1 END::BIGINT AS parser_contract_version
  FROM (SELECT DISTINCT as_of_date FROM ord), (SELECT unnest([1, 2])::BIGINT AS release_revision)
  WHERE release_revision = 1 OR substr(as_of_date, 6, 2) IN ('04', '10')
), promoted AS (
  SELECT * FROM revisions QUALIFY row_number() OVER (PARTITION BY as_of_date ORDER BY
    (release_revision = 1 AND substr(as_of_date, 6, 2) = '04' AND substr(as_of_date, 1, 4)::INT % 2 = 0) DESC, release_revision DESC) = 1
), spine AS (
  SELECT *, row_number() OVER (ORDER BY as_of_date) AS ordinal FROM promoted
), pairs AS (
  SELECT a.as_of_date AS from_as_of_date, a.release_revision AS from_release_revision, a.revision_fingerprint AS from_revision_fingerprint,
         b.as_of_date AS to_as_of_date, b.release_revision AS to_release_revision, b.revision_fingerprint AS to_revision_fingerprint,
         date_diff('day', a.as_of_date::DATE, b.as_of_date::DATE)::BIGINT AS gap_days, a.ordinal AS pair
  FROM spine a JOIN spine b ON b.ordinal = a.ordinal + 1
), plain AS (
  SELECT o.as_of_date, o_custkey, o_orderkey, o_orderdate, o_orderpriority AS source_list, (o_orderkey + 1)::BIGINT AS source_line_no,
         CASE WHEN o_orderkey % 89 <> 0 THEN o_orderstatus END AS status, CASE WHEN o_orderkey % 97 <> 0 THEN o_custkey::VARCHAR END AS key,
         'Fund "' || o_custkey || '"' AS organization_name, 'City ' || (o_custkey % 25) AS city, 'S' || (o_custkey % 50) AS state,
         CASE WHEN o_orderkey % 5 <> 0 AND o_orderkey % 7 <> 0 THEN o_orderdate::DATE END AS last_renewal_date,
         o_orderkey % 5 <> 0 AND o_orderkey % 7 = 0 AS last_renewal_date_unparseable,
         CASE WHEN o_orderkey % 6 = 0 OR o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN DATE '2199-01-05' ELSE (o_orderdate - INTERVAL 100 DAY)::DATE END AS current_status_date,
         o_orderkey % 6 <> 0 AND o_orderkey % 11 = 0 AS current_status_date_unparseable
  FROM ord o
), records AS (
  SELECT l.*, p.release_revision, p.revision_fingerprint, p.parser_contract_version,
         CASE WHEN key IS NULL THEN 'untracked_blank_registration' WHEN status IS NULL THEN 'excluded_from_typed_path_blank_status' ELSE 'eligible_for_keyed_path' END AS disposition
  FROM plain l JOIN promoted p ON l.as_of_date = p.as_of_date WHERE p.release_revision = 1 OR o_orderkey % 50 <> 0
), last_orders AS (
  SELECT * FROM plain QUALIFY row_number() OVER (PARTITION BY as_of_date, o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
), snapshots AS (
  SELECT l.*, p.release_revision, p.revision_fingerprint, p.parser_contract_version, p.ordinal, status IN ('F') AS at_risk
  FROM last_orders l JOIN spine p ON l.as_of_date = p.as_of_date
  WHERE (p.release_revision = 1 OR o_orderkey % 50 <> 0) AND key IS NOT NULL AND status IS NOT NULL
), transitions AS (
  SELECT p.*, t.key, s.key IS NOT NULL AS observed_at_start, e.key IS NOT NULL AS observed_at_end, s.status AS start_status, e.status AS end_status,
         s.at_risk AS start_at_risk, e.at_risk AS end_at_risk, s.last_renewal_date AS start_last_renewal_date, e.last_renewal_date AS end_last_renewal_date,
         s.last_renewal_date_unparseable AS start_last_renewal_date_unparseable, e.last_renewal_date_unparseable AS end_last_renewal_date_unparseable,
         s.current_status_date AS start_current_status_date, e.current_status_date AS end_current_status_date,
         s.current_status_date_unparseable AS start_current_status_date_unparseable, e.current_status_date_unparseable AS end_current_status_date_unparseable,
         CASE WHEN s.key IS NOT NULL AND e.key IS NOT NULL THEN CASE WHEN s.at_risk AND e.at_risk THEN 'delinquency_still_observed' WHEN e.at_risk THEN 'delinquency_entry_observed'
                WHEN s.at_risk THEN 'delinquency_exit_observed' ELSE 'observed_status_movement_other' END
              WHEN s.key IS NOT NULL THEN CASE WHEN s.at_risk THEN 'delinquent_lost_to_observation' ELSE 'not_observed_after_other' END
              WHEN e.at_risk THEN 'delinquent_newly_observed' ELSE 'newly_observed_other' END AS transition_class
  FROM (SELECT coalesce(a.key, b.key) AS key, coalesce(a.ordinal, b.ordinal - 1) AS pair, a AS s, b AS e
        FROM snapshots a FULL OUTER JOIN snapshots b ON a.key = b.key AND b.ordinal = a.ordinal + 1) t
  JOIN pairs p ON p.pair = t.pair
), sequence AS (
  SELECT *, lag(ordinal) OVER w AS prior_ordinal, lag(as_of_date) OVER w AS prior_as_of_date, lag(at_risk) OVER w AS prior_at_risk,
         lead(ordinal) OVER w AS next_ordinal, lead(as_of_date) OVER w AS next_as_of_date, lead(at_risk) OVER w AS next_at_risk
  FROM snapshots WINDOW w AS (PARTITION BY key ORDER BY ordinal)
), islands AS (
  SELECT *, ordinal - row_number() OVER (PARTITION BY key ORDER BY ordinal) AS island FROM snapshots WHERE at_risk
), spell_base AS (
  SELECT key, island, min(ordinal) AS f, max(ordinal) AS l, min(as_of_date) AS onset_right, max(as_of_date) AS exit_left FROM islands GROUP BY key, island
), spells AS (
  SELECT b.key, row_number() OVER (PARTITION BY b.key ORDER BY f)::BIGINT AS spell_number, p.as_of_date AS onset_left, onset_right, exit_left, n.as_of_date AS exit_right,
         p.key IS NULL AS is_left_censored, CASE WHEN n.key IS NOT NULL THEN 'observed_exit' WHEN l = (SELECT max(ordinal) FROM spine) THEN 'right_censored' ELSE 'lost_to_observation' END AS terminal_state
  FROM spell_base b LEFT JOIN snapshots p ON p.key = b.key AND p.ordinal = f - 1 LEFT JOIN snapshots n ON n.key = b.key AND n.ordinal = l + 1
), matrix AS (
  SELECT from_as_of_date, from_release_revision, from_revision_fingerprint, to_as_of_date, to_release_revision, to_revision_fingerprint, gap_days,
         observed_at_start, observed_at_end, transition_class, start_status, end_status, count(*) AS transition_count FROM transitions GROUP BY ALL
), counts AS (
  SELECT from_as_of_date, from_release_revision, from_revision_fingerprint, to_as_of_date, to_release_revision, to_revision_fingerprint, gap_days,
         count(*) FILTER (start_at_risk) AS starting_at_risk_count, count(*) FILTER (end_at_risk) AS ending_at_risk_count,
         count(*) FILTER (start_at_risk AND NOT end_at_risk) AS observed_exit_count, count(*) FILTER (start_at_risk AND end_at_risk) AS still_at_risk_count,
         count(*) FILTER (start_at_risk AND NOT observed_at_end) AS not_observed_count, count(*) FILTER (NOT start_at_risk AND end_at_risk) AS matched_entry_count,
         count(*) FILTER (NOT observed_at_start AND end_at_risk) AS newly_observed_count,
         count(*) FILTER (start_at_risk AND observed_at_end AND (start_last_renewal_date IS NOT NULL OR start_last_renewal_date_unparseable)
           AND end_last_renewal_date IS NULL AND NOT end_last_renewal_date_unparseable) AS starting_clear_count,
         count(*) FILTER (start_at_risk AND NOT end_at_risk AND (start_last_renewal_date IS NOT NULL OR start_last_renewal_date_unparseable)
           AND end_last_renewal_date IS NULL AND NOT end_last_renewal_date_unparseable) AS exit_clear_count,
         count(*) FILTER (start_at_risk AND NOT end_at_risk AND (start_last_renewal_date IS NOT NULL OR start_last_renewal_date_unparseable)) AS exit_populated_count
  FROM transitions GROUP BY ALL
), numbered AS (
  SELECT *, row_number() OVER (ORDER BY as_of_date, release_revision) - 1 AS place, count(*) OVER () AS n FROM revisions
), attempts AS (
  SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'admission_v1' WHEN event_id % 5 = 1 THEN 'store_v1' ELSE 'v2' END AS attempt_shape, 'a' || event_id AS attempt_id,
         CASE WHEN event_id % 5 < 2 THEN 1 ELSE 2 END::BIGINT AS source_schema_version, ['accepted', 'no_new_release', 'rejected', 'recovered'][event_id % 4 + 1] AS raw_status,
         r.as_of_date, r.release_revision, r.revision_fingerprint, (event_id % 3)::BIGINT AS reason_count,
         CASE WHEN event_id % 5 >= 2 AND event_id % 9 <> 0 THEN ts END AS t0, CASE WHEN event_id % 5 >= 2 THEN ts + to_seconds(event_id % 400 - 20) END AS t1
  FROM events e LEFT JOIN numbered r ON event_id % 3 <> 0 AND r.place = event_id % (SELECT any_value(n) FROM numbered)
), runs AS (
  SELECT attempt_id, attempt_shape, source_schema_version, raw_status, as_of_date, release_revision, revision_fingerprint, reason_count,
         CASE attempt_shape WHEN 'v2' THEN raw_status WHEN 'admission_v1' THEN CASE WHEN raw_status = 'rejected' THEN raw_status END
           ELSE CASE WHEN raw_status = 'accepted' THEN CASE WHEN event_id % 2 = 0 THEN 'recovered' ELSE 'accepted' END WHEN raw_status = 'no_new_release' THEN raw_status END END AS normalized_outcome,
         CASE WHEN t0 IS NOT NULL AND t1 IS NOT NULL THEN 'timing_available' ELSE 'timing_unavailable' END AS timing_state,
         strftime(t0, '%Y-%m-%d %H:%M:%S.%g') AS started_at_utc, strftime(t1, '%Y-%m-%d %H:%M:%S.%g') AS ended_at_utc,
         CASE WHEN t1 >= t0 THEN date_diff('second', t0, t1)::BIGINT END AS duration_seconds
  FROM attempts
), flags AS (
  SELECT 'parser_contract_version_known_v1' AS rule_id, 1::BIGINT AS rule_version, 'deterministic' AS rule_class, 'release' AS scope, as_of_date, release_revision, revision_fingerprint,
         NULL::VARCHAR AS pair_from_as_of_date, NULL::BIGINT AS pair_from_release_revision, NULL::VARCHAR AS pair_from_revision_fingerprint,
         NULL::VARCHAR AS pair_to_as_of_date, NULL::BIGINT AS pair_to_release_revision, NULL::VARCHAR AS pair_to_revision_fingerprint,
         parser_contract_version::VARCHAR AS observed_value, 'known-parser-contract-version-1-v1' AS parameter_version, CASE WHEN parser_contract_version = 1 THEN 'pass' ELSE 'review' END AS result
  FROM promoted
  UNION ALL
  SELECT 'capture_outcome_available_v1', 1, 'deterministic', 'release', p.as_of_date, p.release_revision, p.revision_fingerprint, NULL, NULL, NULL, NULL, NULL, NULL,
         count(r.attempt_id)::VARCHAR, 'linked-accepted-or-recovered-capture-run-v1', CASE WHEN count(r.attempt_id) > 0 THEN 'pass' ELSE 'review' END
  FROM promoted p LEFT JOIN runs r ON r.revision_fingerprint = p.revision_fingerprint AND normalized_outcome IN ('accepted', 'recovered') GROUP BY p.as_of_date, p.release_revision, p.revision_fingerprint
  UNION ALL
  SELECT 'keyed_coverage_change_fraction_v1', 1, 'heuristic_review', 'release_pair', NULL, NULL, NULL, from_as_of_date, from_release_revision, from_revision_fingerprint, to_as_of_date, to_release_revision, to_revision_fingerprint,
         (CASE WHEN a > 0 THEN abs(b - a)::DOUBLE / a END)::VARCHAR, 'absolute-relative-change-0.10-v1', CASE WHEN a = 0 THEN 'not_applicable' WHEN abs(b - a)::DOUBLE / a >= 0.10 THEN 'review' ELSE 'pass' END
  FROM (SELECT p.*, (SELECT count(*) FROM records r WHERE r.as_of_date = from_as_of_date AND disposition LIKE 'eligible%') AS a, (SELECT count(*) FROM records r WHERE r.as_of_date = to_as_of_date AND disposition LIKE 'eligible%') AS b FROM pairs p)
), classes AS (
  SELECT k.key AS key, CASE WHEN c_custkey % 11 = 0 THEN 'ambiguous_natural_person' WHEN c_custkey % 13 = 0 THEN 'unclassified' ELSE 'eligible' END AS eligibility_classification,
         CASE WHEN c_custkey % 11 = 0 OR c_custkey % 13 = 0 OR c_custkey % 17 = 0 THEN 'v1' END AS classification_version
  FROM (SELECT DISTINCT key FROM snapshots) k LEFT JOIN customer c ON c.c_custkey::VARCHAR = k.key
)
"""


def query(sql: str | None = None, stored: Sequence[str] = ()) -> Callable:
    def add(f: Callable[[Panel], DataFrame]) -> Callable[[Panel], DataFrame]:
        name = f.__name__
        QUERIES[name] = lambda spark, sf_dir: f(Panel(spark, sf_dir, stored))
        if sql is not None:
            ORACLE_SQL[name] = BASE + sql
        return f

    return add


@query("SELECT as_of_date, release_revision, revision_fingerprint, parser_contract_version FROM promoted")
def promoted_releases(p: Panel) -> DataFrame:
    return p.promoted


@query(f"SELECT {_PAIR}, gap_days FROM pairs")
def adjacent_pairs(p: Panel) -> DataFrame:
    return p.pairs


@query("""SELECT status, key, last_renewal_date, last_renewal_date_unparseable, current_status_date, current_status_date_unparseable, l.as_of_date, source_list, source_line_no
  FROM plain l JOIN promoted p ON l.as_of_date = p.as_of_date WHERE p.release_revision = 1 OR o_orderkey % 50 <> 0""")
def staged_records(p: Panel) -> DataFrame:
    kept = p.staged.join(p.promoted.select(*RELEASE), list(RELEASE), "left_semi")
    return kept.select("status", "key", *CARRIED, "as_of_date", "source_list", "source_line_no")


@query("SELECT as_of_date, release_revision, source_list, source_line_no, key, status, disposition FROM records")
def dispositions(p: Panel) -> DataFrame:
    return p.records.select("as_of_date", "release_revision", "source_list", "source_line_no", "key", "status", "disposition")


@query("SELECT as_of_date, source_list, source_line_no, disposition FROM records WHERE disposition <> 'eligible_for_keyed_path'")
def keyless_and_excluded(p: Panel) -> DataFrame:
    return panel.keyless(p.records).union(panel.exclusions(p.records)).select("as_of_date", "source_list", "source_line_no", "disposition")


@query("""SELECT as_of_date, release_revision, revision_fingerprint, parser_contract_version, source_list, status, count(*) AS record_count FROM records WHERE key IS NULL GROUP BY ALL""")
def unkeyed_coverage(p: Panel) -> DataFrame:
    return metrics.unkeyed_coverage(p.records)


@query("""SELECT as_of_date, release_revision, revision_fingerprint, source_list, status, CASE WHEN key IS NOT NULL AND status IS NOT NULL THEN 'keyed' ELSE 'unkeyed' END AS coverage_class, count(*) AS record_count FROM records GROUP BY ALL""")
def population_coverage(p: Panel) -> DataFrame:
    return metrics.population_coverage(p.records)


@query("""SELECT as_of_date, release_revision, revision_fingerprint, ordinal, key, status, at_risk, prior_ordinal, prior_as_of_date, prior_at_risk, next_ordinal, next_as_of_date, next_at_risk FROM sequence""")
def observation_sequence(p: Panel) -> DataFrame:
    return panel.sequence_columns(p.sequence).drop(*CARRIED)


_TRANSITION = ", ".join(f"{s}_{c}" for c in ("status", "at_risk", *CARRIED) for s in ("start", "end"))


@query(f"SELECT {_PAIR}, gap_days, key, observed_at_start, observed_at_end, {_TRANSITION}, transition_class FROM transitions", stored=("revisions", "promoted"))
def transitions(p: Panel) -> DataFrame:
    return p.transitions


@query("SELECT * FROM matrix")
def transition_matrix(p: Panel) -> DataFrame:
    return metrics.transition_matrix(p.cells)


_TOP = f"""SELECT {_PAIR}, start_status AS largest_from_status, end_status AS largest_to_status, transition_count AS largest_count FROM matrix WHERE observed_at_start AND observed_at_end
  QUALIFY row_number() OVER (PARTITION BY {_PAIR} ORDER BY transition_count DESC, start_status, end_status) = 1"""


@query(f"""SELECT {_PAIR}, gap_days, starting_at_risk_count, ending_at_risk_count, observed_exit_count, still_at_risk_count, not_observed_count, matched_entry_count, newly_observed_count,
  matched_entry_count + newly_observed_count AS total_entrant_count, ending_at_risk_count - starting_at_risk_count AS net_movement, 'starting_published_delinquent_cohort_v1' AS observed_exit_denominator_id,
  observed_exit_count::DOUBLE / nullif(starting_at_risk_count, 0) AS observed_exit_proportion, largest_from_status, largest_to_status, largest_count,
  'matched_observed_entry_population_v1' AS matched_entry_denominator_id, 'all_entrant_population_v1' AS total_entrant_denominator_id,
  {_wilson("observed_exit_count", "starting_at_risk_count", "lower")} AS observed_exit_wilson_95_lower, {_wilson("observed_exit_count", "starting_at_risk_count", "upper")} AS observed_exit_wilson_95_upper
  FROM counts LEFT JOIN ({_TOP}) USING ({_PAIR})""", stored=("cells",))
def pair_metrics(p: Panel) -> DataFrame:
    return metrics.pair_metrics(metrics.pair_counts(p.cells), metrics.transition_matrix(p.cells))


@query(f"""SELECT {_PAIR}, gap_days, starting_at_risk_count, still_at_risk_count, observed_exit_count, not_observed_count, 'starting_published_delinquent_cohort_v1' AS persistence_denominator_id,
  still_at_risk_count::DOUBLE / nullif(starting_at_risk_count, 0) AS persistence_proportion FROM counts""")
def cohort_persistence(p: Panel) -> DataFrame:
    return metrics.cohort_persistence(metrics.pair_counts(p.cells))


@query(f"""SELECT {_PAIR}, gap_days, 'release_quality_diagnostic' AS diagnostic_role, measure_name, denominator_definition_id, n AS diagnostic_eligible_count, k AS numerator_count, n AS denominator_count,
  k::DOUBLE / nullif(n, 0) AS measure_value, {_wilson("k", "n", "lower")} AS wilson_95_lower, {_wilson("k", "n", "upper")} AS wilson_95_upper FROM (
  SELECT *, 'conditional_precision' AS measure_name, 'starting_delinquent_diagnostic_clears_v1' AS denominator_definition_id, exit_clear_count AS k, starting_clear_count AS n FROM counts UNION ALL
  SELECT *, 'eligible_exit_sensitivity', 'observed_exits_with_populated_start_v1', exit_clear_count, exit_populated_count FROM counts UNION ALL
  SELECT *, 'all_exit_sensitivity', 'all_observed_exits_v1', exit_clear_count, observed_exit_count FROM counts)""")
def renewal_diagnostic(p: Panel) -> DataFrame:
    return metrics.renewal_diagnostic(metrics.pair_counts(p.cells))


@query(f"""SELECT r.as_of_date, r.release_revision, r.revision_fingerprint, parser_contract_version, 'F' AS category, c AS category_count, keyed AS keyed_record_count, total - keyed AS unkeyed_record_count,
  total AS raw_total_record_count, 'all_promoted_release_records_v1' AS coverage_denominator_id, keyed::DOUBLE / total AS keyed_proportion, {_wilson("keyed", "total", "lower")} AS keyed_wilson_95_lower,
  {_wilson("keyed", "total", "upper")} AS keyed_wilson_95_upper, (total - keyed)::DOUBLE / total AS unkeyed_proportion, {_wilson("total - keyed", "total", "lower")} AS unkeyed_wilson_95_lower,
  {_wilson("total - keyed", "total", "upper")} AS unkeyed_wilson_95_upper
  FROM promoted r JOIN (SELECT as_of_date, count(*) AS total, count(*) FILTER (disposition LIKE 'eligible%') AS keyed, count(*) FILTER (status = 'F') AS c FROM records GROUP BY as_of_date) USING (as_of_date)""")
def snapshot_metrics(p: Panel) -> DataFrame:
    return metrics.snapshot_metrics(p.records, p.promoted, SPEC)


@query("""SELECT as_of_date, release_revision, revision_fingerprint, CASE WHEN current_status_date_unparseable THEN 'invalid_nonblank' WHEN current_status_date IS NULL THEN 'missing'
  WHEN current_status_date > as_of_date::DATE THEN 'future_reported_date' ELSE 'valid_reported_date' END AS status_age_state,
  CASE WHEN current_status_date <= as_of_date::DATE THEN date_diff('day', current_status_date, as_of_date::DATE)::BIGINT END AS status_age_days, count(*) AS record_count FROM snapshots GROUP BY ALL""")
def status_age(p: Panel) -> DataFrame:
    return metrics.status_age(p.snapshots)


@query("""SELECT key, spell_number, onset_left, onset_right, exit_left, exit_right, is_left_censored, terminal_state = 'right_censored' AS is_right_censored,
  terminal_state = 'lost_to_observation' AS is_lost_to_observation, terminal_state FROM spells""", stored=("revisions", "promoted"))
def spells(p: Panel) -> DataFrame:
    return p.spells


@query("SELECT terminal_state, count(*) AS spell_count FROM spells GROUP BY terminal_state")
def spell_censoring(p: Panel) -> DataFrame:
    return metrics.spell_censoring(p.spells)


@query("SELECT key, spell_number, date_diff('day', onset_right::DATE, exit_left::DATE)::BIGINT AS least_days, date_diff('day', onset_left::DATE, exit_right::DATE)::BIGINT AS most_days FROM spells")
def spell_durations(p: Panel) -> DataFrame:
    return panel.duration_bounds(p.spells)


_LEADS = ", ".join(f"lead({c}) OVER o AS next_{c}" for c in ("from_as_of_date", "to_as_of_date", "gap_days", "matched_entry_count"))


@query(f"""SELECT 'claim_support_status_movement_v1' AS claim_support_version, {_PAIR}, gap_days, 'O' AS matched_start_status, 'published_delinquent_population_v1' AS matched_end_population, s AS support_count,
  matched_entry_count AS support_denominator_count, s::DOUBLE / nullif(matched_entry_count, 0) AS support_share, matched_entry_count + newly_observed_count AS total_entrant_count, d.date AS dominant_status_date,
  coalesce(d.n, 0) AS dominant_status_date_count, coalesce(d.n, 0)::DOUBLE / nullif(matched_entry_count, 0) AS dominant_status_date_share, next_from_as_of_date, next_to_as_of_date, next_gap_days, next_matched_entry_count
  FROM (SELECT *, {_LEADS}, row_number() OVER o AS place,
          (SELECT count(*) FROM transitions t WHERE t.from_as_of_date = c.from_as_of_date AND observed_at_start AND start_status = 'O' AND end_at_risk) AS s FROM counts c WINDOW o AS (ORDER BY {_PAIR})) c
  LEFT JOIN (SELECT from_as_of_date AS f, end_current_status_date AS date, count(*) AS n FROM transitions WHERE transition_class = 'delinquency_entry_observed' GROUP BY from_as_of_date, end_current_status_date
             QUALIFY row_number() OVER (PARTITION BY f ORDER BY n DESC, date NULLS LAST) = 1) d ON d.f = c.from_as_of_date WHERE place = 1""", stored=("promoted", "transitions", "cells"))
def claim_support(p: Panel) -> DataFrame:
    found = metrics.pair_metrics(metrics.pair_counts(p.cells), metrics.transition_matrix(p.cells))
    return metrics.claim_support(p.transitions, found, SPEC)


@query("SELECT as_of_date, release_revision, revision_fingerprint, count(*) AS total_count, count(key) AS keyed_count, count(*) FILTER (status = 'F') AS at_risk_count FROM records GROUP BY ALL")
def release_totals(p: Panel) -> DataFrame:
    return metrics.release_totals(p.records, SPEC)


@query("SELECT from_as_of_date, to_as_of_date, key FROM transitions WHERE observed_at_start AND NOT observed_at_end")
def membership_losses(p: Panel) -> DataFrame:
    return panel.membership_losses(p.snapshots, p.promoted)


_HALF = "CAST('0x' || substr(sha256(key), {at}, 12) AS BIGINT) % 1000000007"


@query(f"""SELECT as_of_date, release_revision, revision_fingerprint, count(*) AS n_keys, sum({_HALF.format(at=1)})::BIGINT AS sum_a, sum({_HALF.format(at=13)})::BIGINT AS sum_b
  FROM (SELECT DISTINCT as_of_date, release_revision, revision_fingerprint, key FROM snapshots) GROUP BY ALL""")
def membership_fingerprint(p: Panel) -> DataFrame:
    return metrics.membership_fingerprint(p.snapshots)


@query("""SELECT as_of_date, release_revision, revision_fingerprint, sum(n)::BIGINT AS n_keys, sha256(string_agg(r || d, '' ORDER BY r)) AS membership_sha256 FROM (
  SELECT as_of_date, release_revision, revision_fingerprint, substr(sha256(key), 1, 2) AS r, count(*) AS n, sha256(string_agg(key || chr(10), '' ORDER BY key)) AS d
  FROM (SELECT DISTINCT as_of_date, release_revision, revision_fingerprint, key FROM snapshots) GROUP BY ALL) GROUP BY ALL""", stored=("snapshots",))
def membership_hash(p: Panel) -> DataFrame:
    return metrics.membership_hash(p.snapshots)


@query("""SELECT as_of_date, release_revision, revision_fingerprint, count(*) AS n_keys, sha256(string_agg(key || chr(10), '' ORDER BY key)) AS membership_sha256
  FROM (SELECT DISTINCT as_of_date, release_revision, revision_fingerprint, key FROM snapshots) GROUP BY ALL""")
def membership_digest(p: Panel) -> DataFrame:
    return metrics.membership_digest(p.snapshots)


@query("SELECT * FROM runs")
def capture_runs(p: Panel) -> DataFrame:
    return p.runs


@query("SELECT *, NULL::VARCHAR AS supersedes_rule_id, NULL::BIGINT AS supersedes_rule_version FROM flags")
def release_flags(p: Panel) -> DataFrame:
    return metrics.release_flags(p.promoted, p.runs, p.records)


@query("""SELECT p.as_of_date, p.release_revision, p.revision_fingerprint, p.parser_contract_version, CASE WHEN f.review = 0 THEN 'accepted_healthy' ELSE 'accepted_review' END AS release_health_state,
  f.n AS flag_count, f.pass AS flag_pass_count, f.review AS flag_review_count, f.rules AS flag_rule_versions, 0::BIGINT AS schema_added_column_count, 0::BIGINT AS schema_removed_column_count,
  0::BIGINT AS schema_type_changed_column_count, 'registry-csv-contract-v1' AS schema_contract_version, coalesce(c.n, 0) AS capture_attempted_count, coalesce(c.ok, 0) AS capture_succeeded_count,
  coalesce(c.bad, 0) AS capture_failed_count, coalesce(c.none, 0) AS capture_unavailable_count
  FROM promoted p JOIN (SELECT as_of_date, count(*) AS n, count(*) FILTER (result = 'pass') AS pass, count(*) FILTER (result = 'review') AS review,
    string_agg(DISTINCT rule_id || ':' || rule_version || ':' || parameter_version, ',' ORDER BY rule_id || ':' || rule_version || ':' || parameter_version) AS rules FROM flags WHERE scope = 'release' GROUP BY as_of_date) f USING (as_of_date)
  LEFT JOIN (SELECT revision_fingerprint, count(*) AS n, count(*) FILTER (normalized_outcome IN ('accepted', 'recovered')) AS ok, count(*) FILTER (normalized_outcome = 'rejected') AS bad,
    count(*) FILTER (normalized_outcome = 'no_new_release') AS none FROM runs GROUP BY revision_fingerprint) c ON c.revision_fingerprint = p.revision_fingerprint""", stored=("promoted", "runs"))
def release_quality(p: Panel) -> DataFrame:
    runs = p.runs
    return metrics.release_quality(p.promoted, metrics.release_flags(p.promoted, runs, p.records), runs)


@query("SELECT as_of_date AS published_as_of_date, release_revision AS published_release_revision FROM promoted QUALIFY row_number() OVER (ORDER BY as_of_date DESC) = 1")
def publication_status(p: Panel) -> DataFrame:
    return metrics.publication_status(p.promoted)


@query("SELECT key, eligibility_classification, classification_version FROM classes")
def public_eligibility(p: Panel) -> DataFrame:
    return p.classes


@query(f"""SELECT s.key, organization_name, city, state, status AS latest_status, at_risk AS latest_at_risk, as_of_date AS latest_as_of_date, release_revision AS latest_release_revision,
  revision_fingerprint AS latest_revision_fingerprint, '{SPEC.instructions.replace("'", "''")}' AS official_verification_instructions,
  CASE WHEN ordinal = (SELECT max(ordinal) FROM spine) THEN 'observed' ELSE 'not_observed' END AS latest_release_observation_state
  FROM snapshots s JOIN classes c ON s.key = c.key AND eligibility_classification = 'eligible' QUALIFY row_number() OVER (PARTITION BY s.key ORDER BY ordinal DESC) = 1""")
def public_organizations(p: Panel) -> DataFrame:
    return publish.organizations(p.snapshots, p.classes, p.promoted, ATTRIBUTES, SPEC.instructions)


@query("""SELECT c.key, r.as_of_date, r.release_revision, r.revision_fingerprint, CASE WHEN s.key IS NULL THEN 'not_observed' ELSE 'observed' END AS observation_state, organization_name, city, state, status, at_risk
  FROM classes c CROSS JOIN promoted r LEFT JOIN snapshots s ON s.key = c.key AND s.as_of_date = r.as_of_date WHERE eligibility_classification = 'eligible'""", stored=("revisions", "promoted", "snapshots"))
def public_observations(p: Panel) -> DataFrame:
    return publish.observations(p.snapshots, p.classes, p.promoted, ATTRIBUTES)


@query("""SELECT w.key, g.as_of_date, g.release_revision, g.revision_fingerprint, g.observation_state, g.organization_name, g.status FROM (
    SELECT c_custkey::VARCHAR AS key FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 8) w LEFT JOIN (
    SELECT c.key, r.as_of_date, r.release_revision, r.revision_fingerprint, CASE WHEN s.key IS NULL THEN 'not_observed' ELSE 'observed' END AS observation_state, organization_name, status
    FROM classes c CROSS JOIN promoted r LEFT JOIN snapshots s ON s.key = c.key AND s.as_of_date = r.as_of_date WHERE eligibility_classification = 'eligible') g ON g.key = w.key""", stored=("promoted",))
def key_histories(p: Panel) -> DataFrame:
    """The histories of the eight customers with the largest balances, looked up in a table that is laid out by key; a key
    without a history comes with nulls."""
    wanted = table(p.spark, p.sf_dir, "customer").orderBy(F.desc("c_acctbal"), "c_custkey").limit(8).select(F.col("c_custkey").cast("string").alias("key")).collect()
    rows = publish.keyed_table(publish.observations(p.snapshots, p.classes, p.promoted, ATTRIBUTES), fresh_path(p.spark, "keyed"))
    return publish.histories(rows, [r["key"] for r in wanted], strict=False).select("key", *RELEASE, "observation_state", "organization_name", "status")


@query("""SELECT code, rank, source_list, line_no, count FROM (
  SELECT 'registration.duplicate' AS code, 120 AS rank, source_list, source_line_no AS line_no, 1::BIGINT AS count FROM plain WHERE key IS NOT NULL QUALIFY count(*) OVER (PARTITION BY key) > 1
  UNION ALL SELECT 'date.mismatch', 100, source_list, source_line_no, 1 FROM plain WHERE as_of_date <> (SELECT as_of_date FROM plain GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
  UNION ALL SELECT 'set.unknown_registry_status', 125, source_list, NULL, count(*) FROM plain WHERE status IS NOT NULL AND status NOT IN ('F', 'O') GROUP BY source_list)""")
def validation_reasons(p: Panel) -> DataFrame:
    """The orders taken as one release: customers repeat, and quarters differ."""
    return validation.record_reasons(p.raw, "State Charity Reg#", "Registry Status", "As-of Date", statuses=("F", "O"))


@query("""SELECT 'source_contract_mismatch' AS verdict, ((SELECT count(*) FROM (SELECT 1 FROM plain WHERE key IS NOT NULL QUALIFY count(*) OVER (PARTITION BY key) > 1))
  + (SELECT count(*) FROM plain WHERE as_of_date <> (SELECT as_of_date FROM plain GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)))::BIGINT AS reason_count""")
def validation_verdict(p: Panel) -> DataFrame:
    return validation.verdict(validation.record_reasons(p.raw, "State Charity Reg#", "Registry Status", "As-of Date"))


@query("SELECT source_line_no, as_of_date FROM plain")
def normalized_dates(p: Panel) -> DataFrame:
    return p.raw.select("source_line_no", normal_as_of_date(F.col("As-of Date")).alias("as_of_date"))


def list_parts(p: Panel) -> DataFrame:
    """Orders written as lists in parts, a list for each quarter and priority, and read back with their line numbers."""
    path = fresh_path(p.spark, "lists")
    name = F.concat_ws(".", "as_of_date", F.regexp_replace("source_list", "/", "-"))
    line = F.concat_ws(",", F.col("source_line_no") - 1, F.coalesce(F.nullif(F.trim(F.regexp_replace("Registry Status", " ", "")), F.lit("")), F.lit("")), F.lit('"x'))
    landing.written_lists(p.raw.select(name.alias("file"), F.col("source_line_no").alias("place"), line.alias("line")), "key,status,mark", path)
    return landing.part_lines(p.spark, path).where("line_no > 1 and text <> ''")


@query("""SELECT as_of_date || '.' || replace(source_list, '/', '-') AS source_list, line_no, text, len(string_split(text, ','))::BIGINT AS n_fields FROM (
  SELECT as_of_date, source_list, 1::BIGINT + row_number() OVER (PARTITION BY as_of_date, source_list ORDER BY source_line_no) AS line_no, o_orderkey || ',' || coalesce(status, '') || ',"x' AS text FROM plain)""")
def landing_files(p: Panel) -> DataFrame:
    """The lines of landing_lines and how many fields each has."""
    return landing.fields(list_parts(p)).select("source_list", "line_no", "text", F.size("fields").cast("bigint").alias("n_fields"))


@query("""SELECT as_of_date || '.' || replace(source_list, '/', '-') AS source_list, line_no, text FROM (
  SELECT as_of_date, source_list, 1::BIGINT + row_number() OVER (PARTITION BY as_of_date, source_list ORDER BY source_line_no) AS line_no, o_orderkey || ',' || coalesce(status, '') || ',"x' AS text FROM plain)""")
def landing_lines(p: Panel) -> DataFrame:
    """Orders written as lists in parts and read back, each line under its list's name."""
    return list_parts(p)


@query("""SELECT '"' || key || '",' || spell_number || ',' || CASE WHEN onset_left IS NULL THEN '' ELSE '"' || onset_left || '"' END || ',"' || onset_right || '","' || terminal_state || '"' AS line FROM spells""")
def export_lines(p: Panel) -> DataFrame:
    return publish.export_lines(p.spells, ("key", "spell_number", "onset_left", "onset_right", "terminal_state"), ("key", "spell_number"))


def _cell(c: str) -> str:
    """A cell of an export; its form follows its type."""
    return f"""coalesce(CASE WHEN typeof({c}) = 'VARCHAR' THEN '"' || replace({c}::VARCHAR, '"', '""') || '"' WHEN typeof({c}) = 'DOUBLE' THEN TRY_CAST(TRY_CAST({c}::VARCHAR AS DOUBLE) AS DECIMAL(20, 9))::VARCHAR ELSE {c}::VARCHAR END, '')"""


def _file_sql(name: str, rows: str, columns: dict[str, str], grain: Sequence[str], dialect: str) -> str:
    """The manifest row of an export: all its lines put together in the order of its grain."""
    line = " || ',' || ".join(_cell(own) for own in columns.values())
    order = ", ".join(f"{columns[g]} NULLS LAST" for g in grain)
    return f"""SELECT '{name}' AS export, '{name}.csv' AS file_name, count(*) AS row_count, sha256('{",".join(columns)}' || chr(10) || coalesce(string_agg({line} || chr(10), '' ORDER BY {order}), '')) AS sha256,
      '{",".join(grain)}' AS grain, '{dialect}' AS dialect FROM ({rows})"""


@query(f"""SELECT *, (SELECT count(*) FROM promoted) AS release_count FROM ({_file_sql("spells", "SELECT * FROM spells", {c: c for c in ("key", "spell_number", "terminal_state")}, ("key", "spell_number"), "")}
  UNION ALL {_file_sql("totals", "SELECT as_of_date, count(*) AS total_count FROM records GROUP BY 1", {c: c for c in ("as_of_date", "total_count")}, ("as_of_date",), "")})""")
def publication_manifest(p: Panel) -> DataFrame:
    """Two exports outside the contract, written and read back."""
    exports = {"spells": (p.spells, ("key", "spell_number", "terminal_state"), ("key", "spell_number")), "totals": (metrics.release_totals(p.records, SPEC), ("as_of_date", "total_count"), ("as_of_date",))}
    return publish.manifest(p.spark, fresh_path(p.spark, "exports"), exports, p.promoted)


@query("""SELECT attempt_id, normalized_outcome, ended_at_utc, coalesce(normalized_outcome = 'rejected' OR normalized_outcome IN ('accepted', 'recovered') AND NOT coalesce(revision_fingerprint IN (SELECT revision_fingerprint FROM promoted), false), true) AS warning
  FROM runs ORDER BY ended_at_utc DESC NULLS LAST, attempt_id DESC LIMIT 1""")
def capture_status(p: Panel) -> DataFrame:
    return publish.capture_status(p.runs, p.promoted)


@query("""SELECT CASE normalized_outcome WHEN 'recovered' THEN 'accepted' ELSE coalesce(normalized_outcome, 'operational_error') END AS outcome,
    CASE normalized_outcome WHEN 'no_new_release' THEN 'source_not_advanced' WHEN 'rejected' THEN 'structural_rejection' WHEN 'accepted' THEN 'none' WHEN 'recovered' THEN 'none' ELSE 'source_transfer_error' END AS reason_category,
    ended_at_utc, coalesce(normalized_outcome NOT IN ('no_new_release', 'accepted', 'recovered'), true)
      OR normalized_outcome IN ('accepted', 'recovered') AND NOT coalesce(revision_fingerprint IN (SELECT revision_fingerprint FROM promoted), false) AS newer_attempt_not_accepted,
    CASE WHEN v.retired_on IS NULL THEN 'active' ELSE 'retired' END AS source_publication_state, v.retired_on AS source_publication_retired_on, 0::BIGINT AS faults
  FROM (SELECT * FROM runs ORDER BY ended_at_utc DESC NULLS LAST, attempt_id DESC LIMIT 1), (SELECT NULL::VARCHAR AS retired_on UNION ALL SELECT max(as_of_date) FROM promoted) v""", stored=("promoted", "runs"))
def control_source(p: Panel) -> DataFrame:
    """The control row of the publication, active and retired at the last release, written as JSON and read back, with the
    number of its faults."""
    last = p.promoted.agg(F.max("as_of_date")).first()[0]
    out = []
    for retired_on in (None, last):
        path = f"{fresh_path(p.spark, 'control')}/{exports.CONTROL_FILE}"
        publish.control_source(p.runs, p.promoted, retired_on).coalesce(1).write.option("ignoreNullFields", "false").json(path)
        back = p.spark.read.schema("outcome string, reason_category string, ended_at_utc string, newer_attempt_not_accepted boolean, source_publication_state string, source_publication_retired_on string").json(path)
        faults = publish.control_faults(back).agg(F.count("*").alias("faults"))
        out.append(back.select(*exports.CONTROL_COLUMNS).crossJoin(F.broadcast(faults)))  # one row
    return united(out)


def attempt_bodies(attempts: DataFrame) -> DataFrame:
    """Attempts as JSON documents (value), each with the exact keys of its own form; null values are written."""
    value = F.lit(None).cast("string")
    for name, own in ATTEMPT_KEYS.items():
        body = F.struct(*(F.col("raw_status").alias(k) if k == "status" else F.col(k) for k in sorted(own)))
        value = F.when(F.col("attempt_shape") == name, F.to_json(body, {"ignoreNullFields": "false"})).otherwise(value)
    return attempts.select(F.coalesce(value, F.raise_error(F.lit("an attempt of no known form")).cast("string")).alias("value"))


@query("""SELECT source_schema_version AS schema_version, attempt_shape, attempt_id, raw_status, as_of_date, CASE WHEN attempt_shape <> 'admission_v1' THEN release_revision END AS release_revision,
  CASE WHEN attempt_shape <> 'admission_v1' THEN revision_fingerprint END AS revision_fingerprint, CASE WHEN attempt_shape <> 'store_v1' THEN reason_count END AS reason_count,
  CASE WHEN attempt_shape = 'store_v1' THEN event_id % 2 = 0 END AS recovered, strftime(t0, '%Y-%m-%d %H:%M:%S.%g') AS started_at_utc, strftime(t1, '%Y-%m-%d %H:%M:%S.%g') AS ended_at_utc FROM attempts""")
def attempt_forms(p: Panel) -> DataFrame:
    """Every attempt written as a JSON document of its own form, and all of them read back as rows of one form."""
    path = fresh_path(p.spark, "attempts")
    attempt_bodies(p.attempts()).write.text(path)
    return landing.attempts(p.spark.read.text(path))


@query("""SELECT attempt_id, attempt_shape, raw_status, source_schema_version AS schema_version FROM attempts""")
def attempt_documents(p: Panel) -> DataFrame:
    """What attempt_forms tells of each document's form."""
    return attempt_forms(p).select("attempt_id", "attempt_shape", "raw_status", "schema_version")


STORED = ("revisions", "promoted", "staged", "records", "panel_records", "snapshots", "sequence", "transitions", "cells", "spells", "runs", "classes")


@query("SELECT NULL::VARCHAR AS check_id, NULL::VARCHAR AS failure_reason WHERE false", stored=STORED)
def panel_checks(p: Panel) -> DataFrame:
    """Checks of the whole panel; no rows if all is well."""
    return united(every_panel_check(p))


@query("SELECT NULL::VARCHAR AS check_id, NULL::VARCHAR AS failure_reason WHERE false", stored=STORED)
def publication_checks(p: Panel) -> DataFrame:
    return united(every_publication_check(p))


def united(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for one in frames[1:]:
        out = out.union(one)
    return out


def every_panel_check(p: Panel) -> list[DataFrame]:
    counts = metrics.pair_counts(p.cells)
    found = metrics.pair_metrics(counts, metrics.transition_matrix(p.cells))
    flat = panel.sequence_columns(p.sequence)
    return [
        checks.pairs_positive(p.pairs),
        checks.blank_status_excluded(p.records),
        checks.capture_runs_normal(p.runs),
        checks.staging_equals_landed(p.staged, p.landed, panel.STAGED, panel.STAGED_DATES.values(), ("accepted_submission", "exact_onset", "onset_date")),
        checks.keys_exact(p.staged, p.landed),
        checks.dispositions_reconcile(p.records, p.staged, p.promoted),
        checks.coverage_reconciles(metrics.population_coverage(p.records), p.records),
        checks.promotion_holds(p.promoted, p.revisions, p.pointers),
        checks.transitions_classified(p.transitions),
        checks.transitions_complete(p.transitions, p.snapshots, p.pairs),
        checks.pairs_are_adjacent(p.transitions, p.pairs),
        checks.spells_hold(p.spells, flat),
        checks.metrics_add_up(found, p.transitions),
        checks.diagnostics_add_up(metrics.renewal_diagnostic(counts), p.transitions),
        checks.claim_holds(metrics.claim_support(p.transitions, found, SPEC), p.transitions, p.pairs, SPEC),
        checks.flags_hold(metrics.release_flags(p.promoted, p.runs, p.records)),
        checks.sequence_neighbours(flat, p.snapshots),
    ]


def every_publication_check(p: Panel) -> list[DataFrame]:
    organizations = publish.organizations(p.snapshots, p.classes, p.promoted, ATTRIBUTES, SPEC.instructions)
    grid = publish.observations(p.snapshots, p.classes, p.promoted, ATTRIBUTES)
    return [
        checks.snapshots_reconcile(p.snapshots, p.panel_records, SPEC),
        checks.eligibility_complete(p.classes, p.snapshots, organizations, metrics.publication_status(p.promoted)),
        checks.public_grid_complete(grid, organizations, p.promoted),
        checks.pairs_are_promoted(p.transitions, p.promoted),
    ]


#: What damaged() does to each frame, and the reasons that the checks must give for it.
DAMAGE_FOUND = {
    "claim_holds": ["made_anew"], "coverage_reconciles": ["groups", "totals"], "diagnostics_add_up": ["counts"], "eligibility_complete": ["latest_flag"], "keys_exact": ["changed"],
    "metrics_add_up": ["counts"], "public_grid_complete": ["rows"], "sequence_neighbours": ["neighbours"], "snapshots_reconcile": ["lines", "totals"], "spells_hold": ["coverage", "made_anew"],
    "staging_equals_landed": ["lines"], "transitions_complete": ["endpoints"],
}


@query("SELECT * FROM (VALUES " + ", ".join(f"('{c}', '{r}')" for c, reasons in DAMAGE_FOUND.items() for r in reasons) + ") AS t(check_id, failure_reason)", stored=STORED)
def damaged_panel(p: Panel) -> DataFrame:
    """The checks on frames that lack or change some rows: each must give its reasons, and no other."""
    k = F.xxhash64("key") % 3 == 0
    some = p.transitions.where(~(k & F.col("end_at_risk"))).union(p.transitions.where(k & F.col("end_at_risk") & F.col("end_at_risk").isNull()))
    less = metrics.pair_counts(metrics.transition_cells(some))
    found = metrics.pair_metrics(less, metrics.transition_matrix(p.cells))
    kept = p.snapshots.where(~k)
    organizations = publish.organizations(p.snapshots, p.classes, p.promoted, ATTRIBUTES).withColumn("latest_release_observation_state", F.when(k, "not_observed").otherwise(F.col("latest_release_observation_state")))
    flat = panel.sequence_columns(p.sequence)
    changed = p.staged.withColumn("key", F.when(k, F.concat(F.lit("0"), "key")).otherwise(F.col("key")))
    every = [
        checks.claim_holds(metrics.claim_support(some, found, SPEC), p.transitions, p.pairs, SPEC),
        checks.coverage_reconciles(metrics.population_coverage(p.records.where(~F.coalesce(k, F.lit(True)))), p.records),
        checks.diagnostics_add_up(metrics.renewal_diagnostic(metrics.pair_counts(metrics.transition_cells(p.transitions.where(~(k & F.col("start_at_risk")) | F.col("start_at_risk").isNull())))), p.transitions),
        checks.eligibility_complete(p.classes, p.snapshots, organizations, metrics.publication_status(p.promoted)),
        checks.keys_exact(changed, p.landed),
        checks.staging_equals_landed(changed, p.landed, panel.STAGED),
        checks.metrics_add_up(found, p.transitions),
        checks.public_grid_complete(publish.observations(kept, p.classes, p.promoted, ATTRIBUTES), organizations, p.promoted),
        checks.sequence_neighbours(flat, kept),
        checks.snapshots_reconcile(kept, p.panel_records, SPEC),
        checks.spells_hold(p.spells.where(~k), flat),
        checks.transitions_complete(some, p.snapshots, p.pairs),
    ]
    return united(every).distinct()


#: What damaged_rows() does to further frames, and the reasons that the checks must give for it.
ROWS_FOUND = {
    "adjacent_pairs_positive": ["gap", "order"], "blank_status_excluded": ["blank_status_kept"],
    "capture_runs_normal": ["no_id", "outcome", "duration_without_timing", "negative_duration", "v1_timed", "grain_repeats"],
    "promotion_holds": ["pointer_lost", "not_highest", "grain_repeats"], "dispositions_reconcile": ["null:disposition", "value:disposition", "totals", "grain_repeats"],
    "flags_hold": ["null:rule_version", "value:result", "value:rule_class", "identity", "scope", "wording", "grain_repeats"], "pairs_are_promoted": ["from_not_promoted", "to_not_promoted"],
    "transitions_classified": ["class", "start_side", "end_side", "absent_at_both"], "pairs_are_adjacent": ["invented_pair", "pair_without_transitions"],
    "totals_match": ["total_count", "keyed_count"], "provenance_closed": ["list", "line", "identity"],
}


@query("SELECT * FROM (VALUES " + ", ".join(f"('{c}', '{r}')" for c, reasons in ROWS_FOUND.items() for r in reasons) + ") AS t(check_id, failure_reason)", stored=STORED)
def damaged_rows(p: Panel) -> DataFrame:
    """The remaining checks on frames of which some rows are changed, lost or there twice: each must give all its reasons,
    and no other; and none for the frames as they are."""
    c = F.col
    at = lambda column, n, of: F.pmod(F.xxhash64(column), F.lit(n)) == of
    changed = lambda name, *cases: F.coalesce(*(F.when(when, value) for when, value in cases), c(name))
    lists = [r[0] for r in p.raw.select("source_list").distinct().collect()]  # a row for each list
    totals = metrics.release_totals(p.records, SPEC)
    flags = metrics.release_flags(p.promoted, p.runs, p.records)
    line = c("source_line_no")

    pairs = p.pairs.withColumn("gap_days", -c("gap_days")).withColumn("from_as_of_date", F.when(c("from_as_of_date") < "1997", F.lit("2100-01-01")).otherwise(c("from_as_of_date")))
    kept = p.records.withColumn("disposition", F.when(c("status").isNull(), "eligible_for_keyed_path").otherwise(c("disposition")))
    timed = c("timing_state") == "timing_available"
    runs = p.runs.where(c("timing_state").isNotNull()).withColumns({
        "attempt_id": F.when(at("attempt_id", 50, 1), F.lit(None).cast("string")).otherwise(c("attempt_id")), "normalized_outcome": F.when(at("attempt_id", 50, 2), "odd").otherwise(c("normalized_outcome")),
        "timing_state": F.when(at("attempt_id", 50, 3), "timing_unavailable").otherwise(c("timing_state")), "duration_seconds": F.when(timed & at("attempt_id", 50, 4), -1).otherwise(c("duration_seconds")),
        "attempt_shape": F.when(at("attempt_id", 50, 5), "store_v1").otherwise(c("attempt_shape")),
    })
    first = p.revisions.where("release_revision = 1").select(p.promoted.columns)
    second = p.revisions.where("release_revision = 2").select(p.promoted.columns)
    promoted = [second.unionByName(p.promoted.join(second.select("as_of_date"), "as_of_date", "left_anti")), first, p.promoted.unionByName(first)]
    spoiled = p.records.withColumn("disposition", changed("disposition", (line % 40 == 3, F.lit("odd")))).withColumn("disposition", F.when(line % 40 == 4, F.lit(None).cast("string")).otherwise(c("disposition")))
    spoiled = spoiled.where(line % 40 != 5).unionByName(spoiled.where(line % 40 == 6))
    odd_flags = [
        flags.withColumn("rule_version", F.lit(None).cast("bigint")).withColumn("result", F.lit("odd")).withColumn("rule_class", F.lit("odd")),
        flags.withColumn("as_of_date", F.lit("2000-01-01")), flags.withColumn("scope", F.when(c("scope") == "release", "release_pair").otherwise("release")),
        flags.withColumn("rule_id", F.concat("rule_id", F.lit("_Risk"))), flags.unionByName(flags),
    ]
    less = p.promoted.where("substr(as_of_date, 1, 4) <> '1997'")
    unclassed = p.transitions.withColumns({
        "transition_class": F.when(at("key", 9, 1), "odd").otherwise(c("transition_class")), "start_status": F.when(at("key", 9, 2), F.when(c("start_status").isNull(), "F")).otherwise(c("start_status")),
        "end_status": F.when(at("key", 9, 3), F.when(c("end_status").isNull(), "F")).otherwise(c("end_status")), "observed_at_start": c("observed_at_start") & ~at("key", 9, 4), "observed_at_end": c("observed_at_end") & ~at("key", 9, 4),
    })
    moved = p.transitions.withColumn("gap_days", F.when(c("from_as_of_date") < "1997", c("gap_days") + 1).otherwise(c("gap_days")))
    golden = totals.select(*RELEASE, (c("total_count") + 1).alias("total_count"), F.when(c("as_of_date") > "1997", c("keyed_count")).alias("keyed_count"), "at_risk_count")
    nowhere = p.records.withColumns({"source_list": F.when(line % 40 == 3, "odd").otherwise(c("source_list")), "source_line_no": F.when(line % 40 == 4, 0).otherwise(line), "revision_fingerprint": F.when(line % 40 == 5, F.lit(None).cast("string")).otherwise(c("revision_fingerprint"))})

    sound = [
        checks.pairs_positive(p.pairs), checks.blank_status_excluded(p.records), checks.capture_runs_normal(p.runs), checks.promotion_holds(p.promoted, p.revisions, p.pointers), checks.dispositions_reconcile(p.records, p.staged, p.promoted),
        checks.flags_hold(flags), checks.pairs_are_promoted(p.transitions, p.promoted), checks.transitions_classified(p.transitions), checks.pairs_are_adjacent(p.transitions, p.pairs), checks.totals_match(totals, totals), checks.provenance_closed(p.records, lists),
    ]
    broken = [
        checks.pairs_positive(pairs), checks.blank_status_excluded(kept), checks.capture_runs_normal(runs), *(checks.promotion_holds(x, p.revisions, p.pointers) for x in promoted), checks.dispositions_reconcile(spoiled, p.staged, p.promoted),
        *map(checks.flags_hold, odd_flags), checks.pairs_are_promoted(p.transitions, less), checks.transitions_classified(unclassed), checks.pairs_are_adjacent(moved, p.pairs), checks.totals_match(totals, golden), checks.provenance_closed(nowhere, lists),
    ]
    return united([*(df.select(F.concat(F.lit("sound:"), "check_id").alias("check_id"), "failure_reason") for df in sound), *broken]).distinct()


def sensitive_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan.findings(table(spark, sf_dir, "documents"), "doc_id", "text")


QUERIES["sensitive_text"] = sensitive_text


def _found_sql(rows: str, key: str, text: str, allowed: Sequence[str] = ()) -> str:
    """A row for each match of the eight detectors, with all text before it; without look-behind: what it would look at is
    matched, or taken from the pieces between."""
    body = f"coalesce({text}, '')"
    q = lambda p: p.replace("'", "''")

    def pieces(name: str, pattern: str, keep: str = "true", before: str = "before") -> str:
        return f"""SELECT '{name}' AS category, row_id, {before} AS before FROM (
          SELECT row_id, m[i] AS match, array_to_string(flatten(list_transform(list_zip(b[1:i - 1], m[1:i - 1]), lambda x: [x[1], x[2]])), '') || b[i] AS before, b[i + 1] AS after FROM (
            SELECT {key} AS row_id, regexp_extract_all({body}, '{q(pattern)}') AS m, string_split_regex({body}, '{q(pattern)}') AS b FROM {rows}), unnest(range(1, len(m) + 1)) AS t(i)) WHERE {keep}"""

    out = [pieces(name, p) for name, p in scan.PATTERNS.items() if name != "home_path"]
    out.append(pieces("home_path", "(?:^|[^A-Za-z0-9_/])" + scan.HOME_PATH, before="before || CASE WHEN match[1] = '/' THEN '' ELSE match[1] END"))
    out.append(pieces("labelled_id", scan.NINE_DIGITS, f"regexp_matches(right(before, {scan.LABEL_WINDOW}), '(?i){scan.LABEL}')"))
    counted = f"regexp_matches(lower(match), '{scan.COUNTED_END}') AND regexp_matches(lower(match), '^[0-9]+(\\s+\\S+)*\\s+(?:{'|'.join(scan.COUNTED)})(\\s+\\S+)*\\s+the\\s+same\\s+way$')"
    out.append(pieces("street_address", scan.ADDRESS, f"NOT ({counted} AND NOT regexp_matches(right(before, {scan.BEFORE}), '{scan.PLACE_BEFORE}') AND NOT regexp_matches(after, '^\\s?,'))"))
    keys = f"len(list_filter(string_split(regexp_extract(match, '^[^?#]*\\?([^#]*)', 1), '&'), lambda f: lower(url_decode(split_part(f, '=', 1))) IN {tuple(scan.JOIN_KEYS)})) > 0"
    spared = "".join(f" AND NOT regexp_matches(match, '(?i)^https?://{a.lower().replace('.', '[.]')}')" for a in allowed)
    out.append(pieces("join_url", scan.URL, keys + spared))
    return " UNION ALL ".join(out)


ORACLE_SQL["sensitive_text"] = f"SELECT category, row_id, count(*) AS finding_count FROM ({_found_sql('documents', 'doc_id', 'text')}) GROUP BY category, row_id"


def located_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines in which findings begin, of all eight detectors."""
    return scan.located(table(spark, sf_dir, "documents"), "doc_id", "text")


QUERIES["located_text"] = located_text
_LINE = "(1 + length(before) - length(replace(before, chr(10), '')))::BIGINT AS line_no"
ORACLE_SQL["located_text"] = f"SELECT category, row_id, {_LINE}, count(*) AS finding_count FROM ({_found_sql('documents', 'doc_id', 'text')}) GROUP BY ALL"

#: Hosts and paths whose links may carry keys.
ALLOWED_LINKS = ("blog.tionsh.example.net/", "m.tionsh.example.net/e", "Blog.ththsh.example.com/")


def link_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page's address on a line of its own with queries of several forms, and with an address and an id over two lines."""
    forms = ["?ein=1", "?x=1&E%69N=2", "#?ein=1", "?SSN", "/ein=4", "?x=ein&y"]
    form = F.element_at(F.array(*map(F.lit, forms)), (F.col("page_id") % len(forms) + 1).cast("int"))
    url = F.when(F.col("page_id") % 4 == 1, F.upper("url")).otherwise(F.col("url"))
    text = F.concat(F.lit("see\n"), url, form, F.lit(" at 12 Main\nStreet\nor EIN\n"), F.lpad(F.col("page_id").cast("string"), 9, "7"))
    return table(spark, sf_dir, "pages").select("page_id", text.alias("text"))


def located_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of findings in the pages' link texts; links to some places may carry keys."""
    return scan.located(link_lines(spark, sf_dir), "page_id", "text", ALLOWED_LINKS)


QUERIES["located_links"] = located_links
ORACLE_SQL["located_links"] = f"""WITH links AS (
  SELECT page_id, 'see' || chr(10) || CASE WHEN page_id % 4 = 1 THEN upper(url) ELSE url END || ['?ein=1', '?x=1&E%69N=2', '#?ein=1', '?SSN', '/ein=4', '?x=ein&y'][page_id % 6 + 1]
    || ' at 12 Main' || chr(10) || 'Street' || chr(10) || 'or EIN' || chr(10) || lpad(page_id::VARCHAR, 9, '7') AS text FROM pages)
SELECT category, row_id, {_LINE}, count(*) AS finding_count FROM ({_found_sql('links', 'page_id', 'text', ALLOWED_LINKS)}) GROUP BY ALL"""


def marts(p: Panel) -> dict[str, DataFrame]:
    """Every mart that is exported, by name."""
    counts = metrics.pair_counts(p.cells)
    found = metrics.pair_metrics(counts, metrics.transition_matrix(p.cells))
    return {
        "public_organizations": publish.organizations(p.snapshots, p.classes, p.promoted, ATTRIBUTES, SPEC.instructions),
        "public_observations": publish.observations(p.snapshots, p.classes, p.promoted, ATTRIBUTES),
        "pair_metrics": found,
        "claim_support": metrics.claim_support(p.transitions, found, SPEC),
        "renewal_diagnostic": metrics.renewal_diagnostic(counts),
        "publication_status": metrics.publication_status(p.promoted),
        "population_coverage": metrics.population_coverage(p.records),
        "release_quality": metrics.release_quality(p.promoted, metrics.release_flags(p.promoted, p.runs, p.records), p.runs),
        "snapshot_metrics": metrics.snapshot_metrics(p.records, p.promoted, SPEC),
        "status_age": metrics.status_age(p.snapshots),
        "spell_censoring": metrics.spell_censoring(p.spells),
        "cohort_persistence": metrics.cohort_persistence(counts),
    }


def _exports_sql() -> str:
    """The manifest over the marts' own SQL."""
    rows = [_file_sql(name, ORACLE_SQL[e.mart].removeprefix(BASE), e.columns, e.grain, exports.DIALECT) for name, e in sorted(exports.EXPORTS.items())]
    return f"SELECT *, (SELECT count(*) FROM promoted) AS release_count, (SELECT count(*) FROM classes WHERE eligibility_classification = 'eligible') AS eligible_count FROM ({' UNION ALL '.join(rows)})"


@query(_exports_sql(), stored=STORED)
def publication_exports(p: Panel) -> DataFrame:
    """All twelve exports written, and their manifest: file, rows, SHA-256 of its bytes, grain, releases and eligible keys."""
    frames = marts(p)
    entries = {name: (exports.exported(frames[e.mart], e), tuple(e.columns), e.grain) for name, e in exports.EXPORTS.items()}
    eligible = p.classes.agg(F.count(F.when(F.col("eligibility_classification") == "eligible", 1)).alias("eligible_count"))
    return publish.manifest(p.spark, fresh_path(p.spark, "exports"), entries, p.promoted, exports.DIALECT).crossJoin(F.broadcast(eligible))  # one row


@query("SELECT * FROM (VALUES ('mart_release_quality', 'columns'), ('mart_status_age', 'grain_not_unique'), ('dim_public_organizations', 'eligible_keys'), ('mart_named', 'identity_columns')) AS t(export, failure_reason)", stored=STORED)
def publication_gate(p: Panel) -> DataFrame:
    """The gate over all exports, which gives nothing for them, and over four broken ones."""
    frames = marts(p)
    good = {name: exports.exported(frames[e.mart], e) for name, e in exports.EXPORTS.items()}
    passed = [exports.gate(df, exports.EXPORTS[name]) for name, df in good.items()]
    age = exports.EXPORTS["mart_source_reported_status_age"]
    named = replace(exports.EXPORTS["dim_public_organizations"], name="mart_named", named=False)
    broken = [
        exports.gate(good["mart_release_quality"].drop("capture_failed_count"), exports.EXPORTS["mart_release_quality"]),
        exports.gate(good[age.name].union(good[age.name]), replace(age, name="mart_status_age")),
        exports.gate(good["dim_public_organizations"], named),
        exports.eligible_keys_agree(good["dim_public_organizations"].where("latest_release_observation_state = 'observed'"), p.classes),
    ]
    return united([*passed, exports.eligible_keys_agree(good["dim_public_organizations"], p.classes), *broken])


def _sql_list(values: Sequence[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


#: The orders as four lists of one release with a fault of every kind, and what is left of them as records.
_TOLD = f""", told AS (
  SELECT o_orderkey AS k, {_sql_list(SOURCE_LISTS)}[1 + o_orderkey % 4] AS source_list, (1 + row_number() OVER (PARTITION BY o_orderkey % 4 ORDER BY o_orderkey))::BIGINT AS line_no,
         CASE WHEN o_orderkey % 331 = 0 THEN 'CT7' WHEN o_orderkey % 313 = 0 THEN 'X' || o_orderkey WHEN o_orderkey % 97 = 0 THEN '' ELSE o_orderkey::VARCHAR END AS reg,
         CASE WHEN o_orderkey % 307 = 0 THEN '' WHEN o_orderkey % 311 = 0 THEN '1999/01/01' ELSE '2020/01/15' END AS listed
  FROM orders
), nonblank AS (
  SELECT * FROM told WHERE k % 229 <> 1
), kept AS (
  SELECT * FROM nonblank WHERE source_list <> '{SOURCE_LISTS[1]}' OR line_no % 50 <> 7
), reasons AS (
  SELECT 'parse.decode_failed' AS code, source_list, min(line_no) AS line_no, count(*) AS count FROM nonblank WHERE k % 211 = 0 GROUP BY source_list
  UNION ALL SELECT 'parse.header_mismatch', source_list, 1, 1 FROM nonblank WHERE source_list = '{SOURCE_LISTS[3]}' GROUP BY source_list
  UNION ALL SELECT 'parse.arity_mismatch', source_list, min(line_no), 1 FROM nonblank WHERE k % 223 = 0 GROUP BY source_list
  UNION ALL SELECT 'parse.line_record_mismatch', source_list, NULL, 1 FROM nonblank GROUP BY source_list HAVING count(*) <> (SELECT count(*) FROM kept WHERE kept.source_list = nonblank.source_list)
  UNION ALL SELECT 'date.blank', source_list, line_no, 1 FROM kept WHERE listed = ''
  UNION ALL SELECT 'date.mismatch', source_list, line_no, 1 FROM kept WHERE listed = '1999/01/01'
  UNION ALL SELECT 'registration.unknown_format', source_list, line_no, 1 FROM kept WHERE reg LIKE 'X%'
  UNION ALL SELECT 'registration.duplicate', source_list, line_no, 1 FROM kept WHERE reg = 'CT7' AND (SELECT count(*) FROM kept WHERE reg = 'CT7') > 1
  UNION ALL SELECT 'set.unknown_registry_status', source_list, NULL, count(*) FROM kept WHERE k % 337 = 0 GROUP BY source_list
)
"""


def faulty_reasons(p: Panel) -> DataFrame:
    """The orders written as four lists of one release with a fault of every kind, read back, and the reasons against them.

    One list has another header, lines are blank, too long or hold bytes that mean nothing, and records of one list are lost."""
    k = F.col("o_orderkey")
    text = k.cast("string")
    reg = F.when(k % 331 == 0, "CT7").when(k % 313 == 0, F.concat(F.lit("X"), text)).when(k % 97 == 0, "").otherwise(text)
    status = F.when(k % 337 == 0, "F").otherwise(F.get(F.array(*map(F.lit, STATUSES)), (k % len(STATUSES)).cast("int")))
    date = F.when(k % 307 == 0, "").when(k % 311 == 0, "1999/01/01").otherwise("2020/01/15")
    name = F.when(k % 211 == 0, "Fund \u0081").otherwise(F.concat(F.lit("Fund "), text))
    line = F.concat(F.concat_ws(",", status, reg, F.lit(""), F.lit(""), name, F.lit("City"), F.lit("CA"), F.lit(""), F.lit(""), F.lit(""), date), F.when(k % 223 == 0, ",more").otherwise(""))
    file = F.get(F.array(*map(F.lit, SOURCE_LISTS)), (k % len(SOURCE_LISTS)).cast("int"))
    rows = table(p.spark, p.sf_dir, "orders").select(file.alias("file"), k.alias("place"), F.when(k % 229 == 1, "").otherwise(line).alias("line"))
    own = F.col("file") == SOURCE_LISTS[3]
    parts = []
    for some, header in ((rows.where(~own), HEADERS), (rows.where(own), HEADERS[::-1])):
        path = fresh_path(p.spark, "faulty")
        landing.written_lists(some, ",".join(header), path)
        parts.append(landing.part_lines(p.spark, path))
    lines = landing.union_lists(parts)
    records = landing.records(lines).where((F.col("source_list") != SOURCE_LISTS[1]) | (F.col("source_line_no") % 50 != 7))
    return validation.registry_reasons(lines, records)


_RANKS = "CASE code " + " ".join(f"WHEN '{c}' THEN {r}" for c, r in REASON_RANK.items()) + " END"


@query(_TOLD + f"SELECT code, {_RANKS} AS rank, source_list, line_no::BIGINT AS line_no, count::BIGINT AS count FROM reasons")
def faulty_release(p: Panel) -> DataFrame:
    """The reasons against a release with a fault of every kind, in their order."""
    return validation.ordered(faulty_reasons(p))


@query(_TOLD + """SELECT 'all' AS reasons, 'source_contract_mismatch' AS verdict, count(*) AS reason_count FROM reasons
  UNION ALL SELECT 'repeats', CASE WHEN count(*) > 0 THEN 'structural_rejection' ELSE 'accepted' END, count(*) FROM reasons WHERE code = 'registration.duplicate'
  UNION ALL SELECT 'none', 'accepted', 0""")
def faulty_verdicts(p: Panel) -> DataFrame:
    """The verdict on all reasons of the faulty release, on its repeated keys alone, and on none."""
    found = written(faulty_reasons(p), "reasons")
    cases = {"all": found, "repeats": found.where("code = 'registration.duplicate'"), "none": found.where("code = ''")}
    return united([validation.verdict(df).select(F.lit(name).alias("reasons"), "verdict", "reason_count") for name, df in cases.items()])


@query("""SELECT r.as_of_date, r.release_revision, r.revision_fingerprint, source_list, source_line_no, coalesce(key, '') AS reg, strftime(o_orderdate, '%Y/%m/%d') AS issue_date
  FROM plain l JOIN revisions r ON l.as_of_date = r.as_of_date WHERE r.release_revision = 1 OR o_orderkey % 50 <> 0""")
def landed_releases(p: Panel) -> DataFrame:
    """Every revision's records written as landed Parquet, and all of them read back through the catalogue in one scan."""
    path = fresh_path(p.spark, "landed")
    landing.landed_table(p.landed.select(*(F.col(f"`{f.name}`") for f in LANDED), *RELEASE), path)
    back = landing.read_landed(p.spark, path, p.revisions)
    return back.select(*RELEASE, "source_list", "source_line_no", F.col("`State Charity Reg#`").alias("reg"), F.col("`Issue Date`").alias("issue_date"))


_DAMAGED = """, lying AS (
    SELECT r.as_of_date, r.release_revision, source_list, substr(r.as_of_date, 4, 1) AS y, source_line_no,
           CASE WHEN substr(r.as_of_date, 4, 1) = '8' THEN source_line_no % 5 WHEN substr(r.as_of_date, 4, 1) = '5' THEN -source_line_no ELSE source_line_no END AS line
    FROM plain l JOIN revisions r ON l.as_of_date = r.as_of_date WHERE r.release_revision = 1 OR o_orderkey % 50 <> 0
  ), there AS (
    SELECT * FROM lying WHERE NOT (y = '4' AND source_line_no % 3 = 0)
  ), lists AS (
    SELECT as_of_date, release_revision, source_list, y, count(*) AS n, count(DISTINCT line) AS lines, min(line) AS least, bool_or(y = '7' AND source_line_no % 2 = 0) AS broken FROM there GROUP BY ALL
  )
"""


@query(_DAMAGED + """SELECT 'lists' AS landed_table, CASE WHEN n <> lines THEN 'line_numbers' WHEN least < 2 THEN 'header_line' ELSE 'replacement_character' END AS failure_reason FROM lists WHERE n <> lines OR least < 2 OR broken
  UNION ALL SELECT 'lists', 'order' FROM lists WHERE y = '6' AND n > 1
  UNION ALL SELECT 'lists', 'row_count' FROM lying WHERE y = '4' GROUP BY as_of_date, release_revision, source_list HAVING bool_or(source_line_no % 3 = 0)
  UNION ALL SELECT * FROM (VALUES ('columns', 'column_order'), ('types', 'schema:source_line_no'), ('types', 'schema:FEIN')) AS t""")
def landed_table_faults(p: Panel) -> DataFrame:
    """What the read-back finds in landed tables with a fault of every kind: in some years line numbers repeat or are too
    small, names are broken, rows lie in falling order or are lost; another table has its columns in another order, and a
    third has other types and lacks a column."""
    year, line = F.substring("as_of_date", 4, 1), F.col("source_line_no")
    columns = [*(F.col(f"`{f.name}`") for f in LANDED), *RELEASE]
    whole = p.landed.withColumns({"source_line_no": F.when(year == "8", line % 5).when(year == "5", -line).otherwise(line), "Name": F.when((year == "7") & (line % 2 == 0), "Fund \ufffd").otherwise(F.col("Name"))})
    damaged = whole.where(~((year == "4") & (line % 3 == 0))).select(columns)
    path = fresh_path(p.spark, "damaged")
    landing.landed_table(damaged.where(year != "6"), path)
    falling = (*RELEASE[:2], "source_list")
    landing.written_landed(damaged.where(year == "6").repartition(*falling).sortWithinPartitions(*falling, F.desc("source_line_no")), path, "append")
    expected = whole.groupBy(*RELEASE[:2], "source_list").agg(F.count("*").alias("n"))
    read = p.spark.read.schema(f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in LANDED)}, as_of_date string, release_revision bigint").parquet(path)
    found = {"lists": landing.landed_faults(read.drop("revision_fingerprint"), expected)}
    some = p.landed.where("release_revision = 1 and source_line_no % 100 = 51")
    for name, chosen in (("columns", [columns[1], columns[0], *columns[2:]]), ("types", [c for i, c in enumerate(columns) if i not in (2, 12)] + [line.cast("string").alias("source_line_no")])):
        path = fresh_path(p.spark, name)
        landing.landed_table(some.select(chosen), path)
        found[name] = landing.landed_faults(p.spark.read.parquet(path))
    return united([df.select(F.lit(name).alias("landed_table"), "failure_reason") for name, df in found.items()])


@query("""SELECT r.*, r.release_revision = 1 AND substr(r.as_of_date, 6, 2) = '04' AND substr(r.as_of_date, 1, 4)::INT % 2 = 0 AS is_pointed_at FROM revisions r""")
def revision_catalogue(p: Panel) -> DataFrame:
    """All revisions and whether a pointer names them, both catalogues read back from where they were written."""
    paths = {name: fresh_path(p.spark, name) for name in ("revisions", "pointers")}
    p.revisions.write.parquet(paths["revisions"])
    p.pointers.write.parquet(paths["pointers"])
    named = landing.read_pointers(p.spark, paths["pointers"]).withColumn("is_pointed_at", F.lit(True))
    return landing.read_revisions(p.spark, paths["revisions"]).join(named, list(RELEASE), "left").withColumn("is_pointed_at", F.coalesce("is_pointed_at", F.lit(False)))


#: Of the streamed attempts: days of a batch, how many batches later some come, files of a batch.
STREAM_DAYS, STREAM_LAG, STREAM_FILES = 5, 3, 2

_ARRIVING = f""", timed AS (
    SELECT *, least(5, date_diff('day', (SELECT min(date_trunc('day', ts)) FROM events), date_trunc('day', ts)) // {STREAM_DAYS}) AS b
    FROM (SELECT event_id, ts FROM events WHERE event_id % 5 >= 2)
  )
"""


@query(_ARRIVING + """SELECT 'a' || event_id AS attempt_id, CASE WHEN event_id % 19 = 0 AND b <= 2 THEN 'late' ELSE 'taken' END AS side,
    (CASE WHEN event_id % 19 = 0 AND b <= 2 AND event_id % 7 = 0 THEN 2 ELSE 1 END)::BIGINT AS documents, ['accepted', 'no_new_release', 'rejected', 'recovered'][event_id % 4 + 1] AS raw_status FROM timed""")
def streamed_attempts(p: Panel) -> DataFrame:
    """The timed attempts as a stream in batches of some days: some documents come a second time, others long after the
    watermark has passed them. Each attempt is taken once; what came late is in the side table, document by document."""
    e = F.col("attempt_id").substr(2, 20).cast("bigint")
    attempts = p.attempts().where("attempt_shape = 'v2'").withColumn("e", e)
    ts = table(p.spark, p.sf_dir, "events").select(F.col("event_id").alias("e"), F.to_date("ts").alias("day"))
    first = table(p.spark, p.sf_dir, "events").agg(F.to_date(F.min("ts")).alias("zero"))
    batch = F.least(F.lit(5), F.floor(F.datediff("day", "zero") / STREAM_DAYS))
    arriving = attempts.join(ts, "e").crossJoin(F.broadcast(first)).withColumn("b", batch)  # one row
    at = F.when((F.col("e") % 19 == 0) & (F.col("b") <= 2), F.col("b") + STREAM_LAG).otherwise(F.col("b"))
    arriving = arriving.withColumn("at", F.explode(F.when(F.col("e") % 7 == 0, F.array(at, at + 1)).otherwise(F.array(at))))
    arriving = written(arriving.drop("day", "zero", "b"), "arriving")
    base = fresh_path(p.spark, "attempt-stream")
    for b in range(7):  # a batch's files are written before those of the next
        arriving.where(F.col("at") == b).drop("e", "at").repartition(STREAM_FILES).write.mode("append").json(f"{base}/in")
    jobs.attempt_job(p.spark, f"{base}/in", f"{base}/taken", f"{base}/late", f"{base}/state", files=STREAM_FILES)
    taken = p.spark.read.parquet(f"{base}/taken").select("attempt_id", F.lit("taken").alias("side"), "raw_status")
    late = p.spark.read.option("recursiveFileLookup", "true").schema(ATTEMPTS).parquet(f"{base}/late").select("attempt_id", F.lit("late").alias("side"), "raw_status")
    return taken.union(late).groupBy("attempt_id", "side", "raw_status").agg(F.count("*").alias("documents")).select("attempt_id", "side", "documents", "raw_status")


@query("""SELECT r.as_of_date, CASE WHEN s = 'accepted' THEN r.release_revision END AS release_revision, CASE WHEN s = 'rejected' THEN md5(r.revision_fingerprint) ELSE r.revision_fingerprint END AS revision_fingerprint, s AS raw_status,
    (CASE WHEN s = 'accepted' THEN (SELECT count(*) FROM plain l WHERE l.as_of_date = r.as_of_date AND (r.release_revision = 1 OR o_orderkey % 50 <> 0)) ELSE 0 END)::BIGINT AS landed_rows
  FROM revisions r, (SELECT unnest(['accepted', 'no_new_release', 'rejected']) AS s)
  WHERE s = 'accepted' OR (s = 'no_new_release' AND r.release_revision = 1 AND substr(r.as_of_date, 6, 2) IN ('01', '04')) OR (s = 'rejected' AND r.release_revision = 1 AND substr(r.as_of_date, 6, 2) = '07')""", stored=("revisions",))
def streamed_catalogue(p: Panel) -> DataFrame:
    """The quarters' revisions as a stream of candidates: first ones, then second ones beside first ones that come again,
    then faulty ones. What becomes of each, and how many rows landed for it."""
    month, revision = F.substring("as_of_date", 6, 2), F.col("release_revision")
    ids = p.revisions.select(*RELEASE)
    good, bad = F.lit(0).cast("bigint"), F.lit(3).cast("bigint")
    batches = [
        ids.where(revision == 1).withColumn("reason_count", good),
        ids.where((revision == 2) | month.isin("01", "04")).withColumn("reason_count", good),
        ids.where((revision == 1) & (month == "07")).withColumn("revision_fingerprint", F.md5("revision_fingerprint")).withColumn("reason_count", bad),
    ]
    base = fresh_path(p.spark, "landing-stream")
    for batch in batches:
        batch.select("as_of_date", "revision_fingerprint", "reason_count").coalesce(1).write.mode("append").json(f"{base}/in")  # a row for each release
    columns = [*(F.col(f"`{f.name}`") for f in LANDED), *RELEASE]
    candidates = p.spark.readStream.schema(jobs.CANDIDATE).option("maxFilesPerTrigger", 1).json(f"{base}/in")
    jobs.landing_job(candidates, lambda accepted: p.landed.join(accepted.drop("release_revision"), ["as_of_date", "revision_fingerprint"]).select(columns), f"{base}/landed", f"{base}/catalogue", f"{base}/state")
    outcomes = p.spark.read.option("recursiveFileLookup", "true").schema(jobs.OUTCOME).parquet(f"{base}/catalogue")
    counted = p.spark.read.option("recursiveFileLookup", "true").parquet(f"{base}/landed").groupBy(*RELEASE).agg(F.count("*").alias("landed_rows"))
    joined = outcomes.join(counted, list(RELEASE), "left")
    return joined.select(*RELEASE, "raw_status", F.coalesce("landed_rows", F.lit(0)).cast("bigint").alias("landed_rows"))


@query("""SELECT c_custkey::VARCHAR AS registration_number, CASE WHEN c_custkey % 11 = 0 THEN 'ambiguous_natural_person' WHEN c_custkey % 13 = 0 THEN 'unclassified' ELSE 'eligible' END AS classification, 'v1' AS classification_version
  FROM customer WHERE c_custkey % 11 = 0 OR c_custkey % 13 = 0 OR c_custkey % 17 = 0""")
def sidecar_classes(p: Panel) -> DataFrame:
    """The customers' classes written as a sidecar of JSON and read back."""
    path = fresh_path(p.spark, "sidecar")
    p.classifications().write.json(path)
    return landing.read_classifications(p.spark, path, required=True)


@query(""", sidecar AS (
    SELECT CASE WHEN c_custkey % 41 = 0 THEN '' WHEN c_custkey % 43 = 0 THEN ' ' || c_custkey ELSE c_custkey::VARCHAR END AS reg, CASE WHEN c_custkey % 47 = 0 THEN 'strange' ELSE 'eligible' END AS class
    FROM customer, range(CASE WHEN c_custkey % 53 = 0 THEN 2 ELSE 1 END))
  SELECT CASE WHEN reg = '' THEN 'blank_key' WHEN reg LIKE ' %' THEN 'untrimmed_key' ELSE 'unknown_class' END AS failure_reason FROM sidecar WHERE reg = '' OR reg LIKE ' %' OR class = 'strange'
  UNION ALL SELECT 'duplicate_key' FROM sidecar GROUP BY reg HAVING count(*) > 1""")
def sidecar_faults(p: Panel) -> DataFrame:
    """What is wrong with a sidecar where keys are blank, padded or repeated and classes unknown."""
    k = F.col("c_custkey")
    text = k.cast("string")
    key = F.when(k % 41 == 0, "").when(k % 43 == 0, F.concat(F.lit(" "), text)).otherwise(text)
    times = F.explode(F.when(k % 53 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    rows = table(p.spark, p.sf_dir, "customer").select(key.alias("registration_number"), F.when(k % 47 == 0, "strange").otherwise("eligible").alias("classification"), F.lit("v1").alias("classification_version"), times.alias("n"))
    path = fresh_path(p.spark, "sidecar")
    rows.drop("n").write.json(path)
    return landing.classification_faults(p.spark.read.schema(CLASSIFICATIONS).json(path))


@query("""SELECT sha256('[' || string_agg('["' || l || '","' || sha256(l || '|' || n || '|' || a || '|' || b) || '"]', ',' ORDER BY l) || ']') AS revision_fingerprint
  FROM (SELECT o_orderpriority AS l, count(*) AS n, min(o_orderkey) AS a, max(o_orderkey) AS b FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY 1)""")
def catalogue_fingerprint(p: Panel) -> DataFrame:
    """The fingerprint of a file for each list that says how many records it has and which are the first and last."""
    k = F.col("o_orderkey")
    lists = table(p.spark, p.sf_dir, "orders").where("o_orderpriority is not null").groupBy(F.col("o_orderpriority").alias("l")).agg(F.concat_ws("|", F.first("o_orderpriority"), F.count("*"), F.min(k), F.max(k)).alias("text"))
    names = sorted(r["l"] for r in lists.select("l").collect())  # one row for each list
    return landing.release_fingerprint(lists.select(F.concat(F.lit("/lists/"), "l", F.lit(".csv")).alias("path"), F.encode("text", "UTF-8").alias("content")), names)
