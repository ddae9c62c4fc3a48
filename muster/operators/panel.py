"""From landed records to promoted releases, observation sequences, transitions and spells.

Large inputs are shuffled once by key: the sequence has each observation's neighbours, and transitions and spells
follow from it without another join of observations. Tables with a row per release are joined without hints, so that
Spark's own size check decides what is broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from muster.contracts import RELEASE, PanelSpec
from muster.functions.expr import blank_to_null, date_of, days_between

STAGED = {
    "Registry Status": "status",
    "State Charity Reg#": "key",
    "FEIN": "federal_id",
    "SOS/FTB#": "state_file_number",
    "Name": "organization_name",
    "City": "city",
    "State": "state",
    "As-of Date": "reported_as_of_date",
}
STAGED_DATES = {"Issue Date": "issue_date", "Last Renewal": "last_renewal_date", "Date Status Set": "current_status_date"}


def staged(landed: DataFrame, columns: dict[str, str] = STAGED, dates: dict[str, str] = STAGED_DATES, carried: Sequence[str] = (*RELEASE, "source_list", "source_line_no")) -> DataFrame:
    """Trimmed text, blank as null, and each date with a flag for what is there but no date."""
    trimmed = lambda raw, name: blank_to_null(F.col(f"`{raw}`")).alias(name)
    texts = {name: f"{name}_text" for name in dates.values()}
    # each step is used more than once by the next, so texts are trimmed once and dates are parsed once
    rows = landed.select(*(trimmed(raw, name) for raw, name in columns.items()), *(trimmed(raw, texts[name]) for raw, name in dates.items()), *carried)
    rows = rows.select("*", *(date_of(F.col(text)).alias(name) for name, text in texts.items()))
    parsed = [c for name, text in texts.items() for c in (F.col(name), (F.col(text).isNotNull() & F.col(name).isNull()).alias(f"{name}_unparseable"))]
    return rows.select(*columns.values(), *parsed, *carried)


def promote(revisions: DataFrame, pointers: DataFrame) -> DataFrame:
    """One revision of each date: the one pointed at if it exists exactly, else the highest."""
    marked = pointers.select(*RELEASE).distinct().withColumn("pointed", F.lit(True))
    order = Window.partitionBy("as_of_date").orderBy(F.coalesce("pointed", F.lit(False)).desc(), F.desc("release_revision"), F.desc("revision_fingerprint"))
    ranked = revisions.join(marked, list(RELEASE), "left").withColumn("place", F.row_number().over(order))
    return ranked.where("place = 1").select(*RELEASE, "parser_contract_version")


def date_spine(promoted: DataFrame) -> DataFrame:
    """Promoted releases with their place in time, from 1, and how many there are."""
    every = Window.partitionBy(F.lit(0))
    return promoted.select(*RELEASE).withColumn("ordinal", F.row_number().over(every.orderBy("as_of_date")).cast("bigint")).withColumn("last_ordinal", F.count("*").over(every))


def adjacent_pairs(promoted: DataFrame) -> DataFrame:
    """Releases next to each other in time, with the days between."""
    order = Window.partitionBy(F.lit(0)).orderBy("as_of_date")
    ends = [F.lead(c).over(order).alias(f"to_{c}") for c in RELEASE]
    pairs = promoted.select(*(F.col(c).alias(f"from_{c}") for c in RELEASE), *ends).where(F.col("to_as_of_date").isNotNull())
    return pairs.withColumn("gap_days", days_between(F.col("from_as_of_date"), F.col("to_as_of_date")))


def promoted_records(records: DataFrame, promoted: DataFrame) -> DataFrame:
    """Records of promoted revisions, with their disposition. Every one gets exactly one."""
    return records.join(promoted, list(RELEASE)).withColumn("disposition", disposition(F.col("key"), F.col("status")))


def disposition(key: Column, status: Column) -> Column:
    blank_key = F.when(key.isNull(), "untracked_blank_registration")
    return blank_key.when(status.isNull(), "excluded_from_typed_path_blank_status").otherwise("eligible_for_keyed_path")


def keyless(records: DataFrame) -> DataFrame:
    return records.where(F.col("disposition") == "untracked_blank_registration")


def exclusions(records: DataFrame) -> DataFrame:
    return records.where(F.col("disposition").like("excluded_from_typed_path_%"))


def keyed_snapshots(records: DataFrame, spec: PanelSpec) -> DataFrame:
    """Keyed records with whether their status is at risk: exact membership, derived here and nowhere else."""
    return records.where(F.col("disposition") == "eligible_for_keyed_path").drop("disposition").withColumn("at_risk", F.col("status").isin(*spec.at_risk))


def observation_sequence(snapshots: DataFrame, spine: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    """Each observation with its release's ordinal and the key's observations before and after, at risk or not.

    (key, release) must be unique, which validation sees to; the carried columns come with the neighbours too."""
    own = ["status", "at_risk", *carried]
    rows = snapshots.join(spine, list(RELEASE)).select(*RELEASE, "ordinal", "last_ordinal", "key", *own)
    order = Window.partitionBy("key").orderBy("ordinal")
    whole = F.struct("ordinal", "as_of_date", *own)
    near = rows.withColumn("prior", F.lag(whole).over(order)).withColumn("next", F.lead(whole).over(order))
    return near


def sequence_columns(sequence: DataFrame) -> DataFrame:
    """The sequence with plain columns for its neighbours."""
    flat = [F.col(f"{side}.{c}").alias(f"{side}_{c}") for side in ("prior", "next") for c in ("ordinal", "as_of_date", "at_risk")]
    return sequence.select(*(c for c in sequence.columns if c not in ("prior", "next", "last_ordinal")), *flat)


def transition_class(at_start: Column, at_end: Column, start_risk: Column, end_risk: Column) -> Column:
    both = at_start & at_end
    return (
        F.when(both & ~start_risk & end_risk, "delinquency_entry_observed")
        .when(~at_start & at_end & end_risk, "delinquent_newly_observed")
        .when(both & start_risk & ~end_risk, "delinquency_exit_observed")
        .when(both & start_risk & end_risk, "delinquency_still_observed")
        .when(at_start & ~at_end & start_risk, "delinquent_lost_to_observation")
        .when(both, "observed_status_movement_other")
        .when(~at_start & at_end, "newly_observed_other")
        .when(at_start & ~at_end, "not_observed_after_other")
    )


def transitions(sequence: DataFrame, promoted: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    """A row for each adjacent pair of releases and key that is seen at either end. A missing end stays null.

    An observation starts the pair after it, and ends the pair before it if the key wasn't seen at that pair's start."""
    own = ["status", "at_risk", *carried]
    here = F.struct(*own)
    ahead = F.col("next.ordinal") == F.col("ordinal") + 1
    kind = sequence.select(here.alias("x")).schema["x"].dataType.simpleString()
    none = F.lit(None).cast(kind)
    followed = F.when(ahead, F.struct(*(F.col(f"next.{c}").alias(c) for c in own))).otherwise(none)
    starts = F.when(F.col("ordinal") < F.col("last_ordinal"), F.struct(F.col("ordinal").alias("pair"), here.alias("start"), followed.alias("end")))
    alone = (F.col("ordinal") > 1) & ~F.coalesce(F.col("prior.ordinal") == F.col("ordinal") - 1, F.lit(False))
    ends = F.when(alone, F.struct((F.col("ordinal") - 1).alias("pair"), none.alias("start"), here.alias("end")))
    rows = sequence.select("key", F.explode(F.array_compact(F.array(starts, ends))).alias("t")).select("key", "t.*")
    order = Window.partitionBy(F.lit(0)).orderBy("from_as_of_date")
    pairs = adjacent_pairs(promoted).withColumn("pair", F.row_number().over(order).cast("bigint"))
    at_start, at_end = F.col("start").isNotNull(), F.col("end").isNotNull()
    return rows.join(pairs, "pair").select(
        *(c for c in pairs.columns if c != "pair"),
        "key",
        at_start.alias("observed_at_start"),
        at_end.alias("observed_at_end"),
        *(F.col(f"{side}.{c}").alias(f"{side}_{c}") for c in own for side in ("start", "end")),
        transition_class(at_start, at_end, F.col("start.at_risk"), F.col("end.at_risk")).alias("transition_class"),
    )


def transitions_by_join(snapshots: DataFrame, promoted: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    """The same rows by a full outer join of both ends; the second formulation that tests hold the first against."""
    own = ["status", "at_risk", *carried]
    pairs = adjacent_pairs(promoted)

    def side(name: str, ids: str) -> DataFrame:
        rows = snapshots.select(*(F.col(c).alias(f"{ids}_{c}") for c in RELEASE), "key", *(F.col(c).alias(f"{name}_{c}") for c in own), F.lit(True).alias(f"at_{name}"))
        return pairs.join(rows, [f"{ids}_{c}" for c in RELEASE]).select(*pairs.columns, "key", f"at_{name}", *(f"{name}_{c}" for c in own))

    both = side("start", "from").join(side("end", "to"), [*pairs.columns, "key"], "full_outer")
    at_start, at_end = (F.coalesce(f"at_{x}", F.lit(False)) for x in ("start", "end"))
    return both.select(
        *pairs.columns, "key", at_start.alias("observed_at_start"), at_end.alias("observed_at_end"),
        *(f"{x}_{c}" for c in own for x in ("start", "end")),
        transition_class(at_start, at_end, F.col("start_at_risk"), F.col("end_at_risk")).alias("transition_class"),
    )


def spells(sequence: DataFrame) -> DataFrame:
    """Runs of at-risk observations in releases next to each other. A missing release ends a run, it is never bridged.

    The onset lies in (onset_left, onset_right] and the exit in (exit_left, exit_right]; a bound that wasn't observed
    is null, and the censoring says so."""
    fresh = ~F.coalesce(F.col("prior.at_risk") & (F.col("prior.ordinal") == F.col("ordinal") - 1), F.lit(False))
    order = Window.partitionBy("key").orderBy("ordinal").rowsBetween(Window.unboundedPreceding, 0)
    runs = sequence.where("at_risk").withColumn("spell_number", F.sum(fresh.cast("int")).over(order))
    bounds = runs.groupBy("key", "spell_number").agg(
        F.min("as_of_date").alias("onset_right"),
        F.max("as_of_date").alias("exit_left"),
        F.min("ordinal").alias("first"),
        F.max("ordinal").alias("last"),
        F.max("last_ordinal").alias("panel_last"),
        F.min_by("prior", "ordinal").alias("before"),
        F.max_by("next", "ordinal").alias("after"),
    )
    seen_onset = F.coalesce((F.col("before.ordinal") == F.col("first") - 1) & ~F.col("before.at_risk"), F.lit(False))
    seen_exit = F.coalesce((F.col("after.ordinal") == F.col("last") + 1) & ~F.col("after.at_risk"), F.lit(False))
    state = F.when(seen_exit, "observed_exit").when(F.col("last") == F.col("panel_last"), "right_censored").otherwise("lost_to_observation")
    return bounds.withColumn("terminal_state", state).select(
        "key",
        F.col("spell_number").cast("bigint").alias("spell_number"),
        F.when(seen_onset, F.col("before.as_of_date")).alias("onset_left"),
        "onset_right",
        "exit_left",
        F.when(seen_exit, F.col("after.as_of_date")).alias("exit_right"),
        (~seen_onset).alias("is_left_censored"),
        (F.col("terminal_state") == "right_censored").alias("is_right_censored"),
        (F.col("terminal_state") == "lost_to_observation").alias("is_lost_to_observation"),
        "terminal_state",
    )


def duration_bounds(found: DataFrame) -> DataFrame:
    """Least and most days at risk of each spell; the most is null unless both ends were observed."""
    return found.select("key", "spell_number", days_between(F.col("onset_right"), F.col("exit_left")).alias("least_days"), days_between(F.col("onset_left"), F.col("exit_right")).alias("most_days"))


def membership_losses(snapshots: DataFrame, promoted: DataFrame) -> DataFrame:
    """Keys of a release that the next one doesn't have."""
    pairs = adjacent_pairs(promoted)
    start = pairs.join(snapshots.select(*(F.col(c).alias(f"from_{c}") for c in RELEASE), "key"), [f"from_{c}" for c in RELEASE])
    end = snapshots.select(*(F.col(c).alias(f"to_{c}") for c in RELEASE), "key")
    return start.join(end, [*(f"to_{c}" for c in RELEASE), "key"], "left_anti").select("from_as_of_date", "to_as_of_date", "key")
