"""A registry panel out of the order tables: releases are quarters, keys are customers, statuses are order states.

Landed rows have the registry's form, with padding, blanks, three ways to write a date and text that is no date. Even
quarters have a second revision, and some quarters point back to the first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from muster.contracts import RELEASE, PanelSpec
from muster.functions.shared import written
from muster.operators import metrics, panel, publish

SPEC = PanelSpec(at_risk=("F",), claim_status="O", instructions="Look the key up where the list was published.")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One revision of each quarter with orders, two of even ones."""
    dates = table(spark, sf_dir, "orders").select(F.date_format(F.date_trunc("quarter", "o_orderdate"), "yyyy-MM-dd").alias("as_of_date")).where("as_of_date is not null").distinct()
    even = F.substring("as_of_date", 6, 2).isin("04", "10")
    rows = dates.withColumn("release_revision", F.explode(F.when(even, F.array(F.lit(1).cast("bigint"), F.lit(2).cast("bigint"))).otherwise(F.array(F.lit(1).cast("bigint")))))
    version = F.when(F.substring("as_of_date", 4, 1).isin("3", "7"), 2).otherwise(1).cast("bigint")
    return rows.withColumn("revision_fingerprint", F.sha2(F.concat_ws(":", "as_of_date", F.col("release_revision").cast("string")), 256)).withColumn("parser_contract_version", version)


def pointers(found: DataFrame) -> DataFrame:
    """April quarters of even years point to their first revision."""
    year = F.substring("as_of_date", 1, 4).cast("int")
    return found.where((F.col("release_revision") == 1) & (F.substring("as_of_date", 6, 2) == "04") & (year % 2 == 0)).select(*RELEASE)


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as raw list rows of one release date each."""
    k = F.col("o_orderkey")
    text = lambda c: c.cast("string")
    iso = F.date_format("o_orderdate", "yyyy-MM-dd")
    return table(spark, sf_dir, "orders").select(
        F.when(k % 89 == 0, "  ").otherwise(F.concat(F.lit(" "), "o_orderstatus", F.lit(" "))).alias("Registry Status"),
        F.when(k % 97 == 0, "").otherwise(text(F.col("o_custkey"))).alias("State Charity Reg#"),
        F.concat(F.lit("9"), F.lpad(text(k), 8, "0")).alias("FEIN"),
        F.lit("").alias("SOS/FTB#"),
        F.concat(F.lit('Fund "'), text(F.col("o_custkey")), F.lit('"')).alias("Name"),
        F.concat(F.lit("City "), text(F.col("o_custkey") % 25)).alias("City"),
        F.concat(F.lit("S"), text(F.col("o_custkey") % 50)).alias("State"),
        F.date_format("o_orderdate", "yyyy/MM/dd").alias("Issue Date"),
        F.when(k % 5 == 0, "").when(k % 7 == 0, "n/a").otherwise(F.concat(F.lit("  "), iso)).alias("Last Renewal"),
        F.when(k % 6 == 0, "").when(k % 11 == 0, "31/31/31").when(k % 13 == 0, "2199/1/5").otherwise(F.date_format(F.date_sub("o_orderdate", 100), "yyyy/M/d")).alias("Date Status Set"),
        F.date_format(F.date_trunc("quarter", "o_orderdate"), "yyyy/MM/dd").alias("As-of Date"),
        F.date_format(F.date_trunc("quarter", "o_orderdate"), "yyyy-MM-dd").alias("as_of_date"),
        F.col("o_orderpriority").alias("source_list"),
        (k + 1).cast("bigint").alias("source_line_no"),
        F.col("o_custkey").alias("__custkey"),
        F.struct("o_orderdate", "o_orderkey").alias("__order"),
    )


def landed(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The rows in each revision of their date; a second revision lacks some."""
    ids = found.select(*RELEASE)
    return rows.join(ids, "as_of_date").where((F.col("release_revision") == 1) | (F.col("source_line_no") % 50 != 1))


CARRIED = ("last_renewal_date", "last_renewal_date_unparseable", "current_status_date", "current_status_date_unparseable")


class Panel:
    """The frames of the panel; each is a plan, and nothing runs before it is asked for. Frames named in `stored` are
    written when they are first asked for, so that those made from them start from the table."""

    def __init__(self, spark: SparkSession, sf_dir: str, stored: Sequence[str] = ()) -> None:
        self.spark, self.sf_dir, self.spec, self.stored = spark, sf_dir, SPEC, frozenset(stored)

    def __getattr__(self, name: str) -> DataFrame:
        makes = vars(type(self)).get(f"_{name}")
        if makes is None:
            raise AttributeError(name)
        df = makes(self)
        vars(self)[name] = written(df, name) if name in self.stored else df
        return vars(self)[name]

    def _revisions(self) -> DataFrame:
        return revisions(self.spark, self.sf_dir)

    def _pointers(self) -> DataFrame:
        return pointers(self.revisions)

    def _promoted(self) -> DataFrame:
        return panel.promote(self.revisions, self.pointers)

    def _pairs(self) -> DataFrame:
        return panel.adjacent_pairs(self.promoted)

    def _raw(self) -> DataFrame:
        return orders(self.spark, self.sf_dir)

    def _landed(self) -> DataFrame:
        return landed(self.raw, self.revisions)

    def _staged(self) -> DataFrame:
        return panel.staged(self.landed)

    def _records(self) -> DataFrame:
        return panel.promoted_records(self.staged, self.promoted)

    def _panel_records(self) -> DataFrame:
        """Of the last order of each customer and quarter: what makes (release, key) unique."""
        last = self.raw.groupBy("as_of_date", "__custkey").agg(F.max_by(F.struct(*self.raw.columns), "__order").alias("r")).select("r.*")
        return panel.promoted_records(panel.staged(landed(last, self.revisions)), self.promoted)

    def _snapshots(self) -> DataFrame:
        return panel.keyed_snapshots(self.panel_records, SPEC)

    def _sequence(self) -> DataFrame:
        return panel.observation_sequence(self.snapshots, panel.date_spine(self.promoted), CARRIED)

    def _transitions(self) -> DataFrame:
        return panel.transitions(self.sequence, self.promoted, CARRIED)

    def _cells(self) -> DataFrame:
        return metrics.transition_cells(self.transitions)

    def _spells(self) -> DataFrame:
        return panel.spells(self.sequence)

    def _runs(self) -> DataFrame:
        return metrics.capture_runs(self.attempts())

    def _classes(self) -> DataFrame:
        return publish.eligibility(self.snapshots, self.classifications())

    def classifications(self) -> DataFrame:
        k = F.col("c_custkey")
        kind = F.when(k % 11 == 0, "ambiguous_natural_person").when(k % 13 == 0, "unclassified").when(k % 17 == 0, "eligible")
        rows = table(self.spark, self.sf_dir, "customer").select(k.cast("string").alias("registration_number"), kind.alias("classification"), F.lit("v1").alias("classification_version"))
        return rows.where("classification is not null")

    def attempts(self) -> DataFrame:
        """Events as capture attempts; most of them name a revision."""
        order = Window.partitionBy(F.lit(0)).orderBy("as_of_date", "release_revision")
        ids = self.revisions.select(*RELEASE, (F.row_number().over(order) - 1).cast("bigint").alias("place"), F.count("*").over(Window.partitionBy(F.lit(0))).alias("n"))
        size = ids.select("n").limit(1)
        e = F.col("event_id")
        events = table(self.spark, self.sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts")).crossJoin(F.broadcast(size)).withColumn("place", F.when(e % 3 != 0, e % F.col("n")))  # one row
        named = events.drop("n").join(ids.drop("n"), "place", "left")
        form = F.when(e % 5 == 0, "admission_v1").when(e % 5 == 1, "store_v1").otherwise("v2")
        raw = F.element_at(F.array(*map(F.lit, ("accepted", "no_new_release", "rejected", "recovered"))), (e % 4 + 1).cast("int"))
        late = F.timestamp_micros(F.unix_micros("ts") + ((e % 400) - 20) * 1_000_000)
        timed = form == "v2"
        at = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSS")
        return named.select(
            F.when(timed, 2).otherwise(1).cast("bigint").alias("schema_version"), form.alias("attempt_shape"), F.concat(F.lit("a"), e.cast("string")).alias("attempt_id"), raw.alias("raw_status"),
            *RELEASE, (e % 3).cast("bigint").alias("reason_count"), F.when(form == "store_v1", e % 2 == 0).alias("recovered"),
            F.when(timed & (e % 9 != 0), at(F.col("ts"))).alias("started_at_utc"), F.when(timed, at(late)).alias("ended_at_utc"),
        )
