"""The public view of the panel, and its exports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from muster.contracts import CONTROL_OUTCOMES, CONTROL_REASONS, RELEASE
from muster.functions.digests import parts_in_order, streamed_sha256
from muster.operators.metrics import publication_status

#: Columns that an aggregate export may not have.
IDENTITY = ("key", "organization_name", "city", "state", "federal_id", "state_file_number")


def eligibility(snapshots: DataFrame, classifications: DataFrame) -> DataFrame:
    """Every key ever observed with its class; a key without one is eligible."""
    known = classifications.select(F.col("registration_number").alias("key"), "classification", "classification_version")
    found = snapshots.select("key").distinct().join(known, "key", "left")
    return found.select("key", F.coalesce("classification", F.lit("eligible")).alias("eligibility_classification"), "classification_version")


def eligible(classes: DataFrame) -> DataFrame:
    return classes.where(F.col("eligibility_classification") == "eligible").select("key")


def organizations(snapshots: DataFrame, classes: DataFrame, promoted: DataFrame, attributes: Sequence[str], instructions: str = "") -> DataFrame:
    """The latest observation of each eligible key, taken whole, and whether the latest release has the key.

    The latest release is matched by date and revision, not by fingerprint."""
    order = F.struct(*RELEASE)
    latest = publication_status(promoted)
    row = F.struct(*attributes, "status", "at_risk", *RELEASE)
    marked = snapshots.join(eligible(classes), "key", "left_semi").crossJoin(F.broadcast(latest))  # one row
    current = (F.col("as_of_date") == F.col("published_as_of_date")) & (F.col("release_revision") == F.col("published_release_revision"))
    best = marked.groupBy("key").agg(F.max_by(row, order).alias("r"), F.max(current).alias("current"))
    return best.select(
        "key",
        *(F.col(f"r.{a}").alias(a) for a in attributes),
        F.col("r.status").alias("latest_status"),
        F.col("r.at_risk").alias("latest_at_risk"),
        *(F.col(f"r.{c}").alias(f"latest_{c}") for c in RELEASE),
        F.lit(instructions).alias("official_verification_instructions"),
        F.when(F.coalesce("current", F.lit(False)), "observed").otherwise("not_observed").alias("latest_release_observation_state"),
    )


def observations(snapshots: DataFrame, classes: DataFrame, promoted: DataFrame, attributes: Sequence[str]) -> DataFrame:
    """A row for each eligible key and promoted release, observed or not.

    One grouping by key gathers its observations; the grid is then made key by key, so keys and releases are never
    joined as a product of tables. The list of releases is a row per release."""
    grid = promoted.agg(F.array_sort(F.collect_list(F.struct(*RELEASE))).alias("grid"))
    seen = snapshots.join(eligible(classes), "key", "left_semi").groupBy("key").agg(F.collect_list(F.struct(F.struct(*RELEASE).alias("id"), *attributes, "status", "at_risk")).alias("seen"))
    rows = seen.crossJoin(F.broadcast(grid)).select("key", "seen", F.explode("grid").alias("g"))  # one row
    rows = rows.withColumn("found", F.filter("seen", lambda s: s["id"] == F.col("g")))
    one = F.explode_outer("found").alias("o")
    return rows.select("key", "g", one).select(
        "key",
        *(F.col(f"g.{c}").alias(c) for c in RELEASE),
        F.when(F.col("o").isNotNull(), "observed").otherwise("not_observed").alias("observation_state"),
        *(F.col(f"o.{a}").alias(a) for a in attributes),
        "o.status",
        "o.at_risk",
    )


def keyed_table(rows: DataFrame, path: str, key: str = "key", order: Sequence[str] = RELEASE, expected: int = 100_000, group_rows: int = 100_000) -> DataFrame:
    """The rows as a table that is read by key: dealt out by ranges of keys, sorted, with a Bloom filter of the keys in each
    row group. Ranges of the row groups rule out most of them, filters the rest that don't have the key."""
    sorted_rows = rows.repartitionByRange(key, *order).sortWithinPartitions(key, *order)
    options = {f"parquet.bloom.filter.enabled#{key}": "true", f"parquet.bloom.filter.expected.ndv#{key}": str(expected), "parquet.block.row.count.limit": str(group_rows)}
    sorted_rows.write.mode("errorifexists").option("compression", "zstd").options(**options).parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


#: Most keys of one lookup: each is compared with the filters of the row groups.
LOOKED_UP = 10


def histories(rows: DataFrame, keys: Sequence[str], order: Sequence[str] = RELEASE, strict: bool = True) -> DataFrame:
    """The rows of the keys in order, in one scan with the keys pushed into it. A key that isn't there fails the query, or,
    if not strict, comes back with nulls."""
    asked = list(dict.fromkeys(keys))
    if len(asked) > LOOKED_UP:
        raise ValueError(f"a lookup takes at most {LOOKED_UP} keys; join a table of more")
    wanted = rows.sparkSession.createDataFrame([(k,) for k in asked], "asked string")
    found = wanted.join(rows.where(F.col("key").isin(*asked)), F.col("asked") == F.col("key"), "left")
    there = F.when(F.col("key").isNotNull(), F.col("key")).otherwise(F.raise_error(F.lit("no such key")).cast("string")) if strict else F.col("asked")
    return found.withColumn("key", there).drop("asked").select(rows.columns).orderBy("key", *order)


def lookup(rows: DataFrame, key: str, order: Sequence[str] = RELEASE) -> DataFrame:
    """History of exactly one key, in one scan; the query fails if the key isn't there."""
    return histories(rows, [key], order)


def csv_line(df: DataFrame, columns: Sequence[str], places: int | None = None) -> Column:
    """One line of an export: text in quotes with quotes doubled, null as nothing, dates in ISO form; with `places`,
    fractions are rounded to so many."""
    kinds = dict(df.dtypes)

    def cell(name: str) -> Column:
        c = F.col(name)
        if kinds[name] == "string":
            return F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
        if kinds[name] == "date":
            return F.date_format(c, "yyyy-MM-dd")
        if kinds[name] == "double" and places is not None:
            return c.cast(f"decimal(20,{places})").cast("string")
        return c.cast("string")

    return F.concat_ws(",", *(F.coalesce(cell(c), F.lit("")) for c in columns))


def export_lines(df: DataFrame, columns: Sequence[str], grain: Sequence[str], places: int | None = None) -> DataFrame:
    """The lines of an export in the order of its grain, nulls last."""
    return df.orderBy(*(F.asc_nulls_last(c) for c in grain)).select(csv_line(df, columns, places).alias("line"))


#: Most lines of a part file: a part is read back as one value.
PART_LINES = 250_000


def export_csv(df: DataFrame, path: str, columns: Sequence[str], grain: Sequence[str], single: bool = False, places: int | None = None) -> int:
    """Writes UTF-8 lines below a plain header, and returns their number. Wide marts stay in several files in order; one
    file only for aggregates.

    The header is a file of its own that sorts first, so that parts joined in their order are the whole export."""
    seen = Observation()
    lines = export_lines(df, columns, grain, places).observe(seen, F.count(F.lit(1)).alias("n"))  # above the sort, which runs what is below it twice
    (lines.coalesce(1) if single else lines).write.mode("errorifexists").option("maxRecordsPerFile", PART_LINES).text(f"{path}/rows")
    df.sparkSession.createDataFrame([(",".join(columns),)], "line string").coalesce(1).write.mode("errorifexists").text(f"{path}/header")
    return int(seen.get["n"])


def export_digests(spark: SparkSession, base: str) -> DataFrame:
    """(file_name, sha256) of the exports below a folder, each in a folder of its name: SHA-256 over the bytes of the header
    and of all parts in the order in which they were written, as one file would have it."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(base)
    path = F.col("path")
    named = files.select(F.regexp_extract(path, "/([^/]+)/(?:header|rows)/[^/]+$", 1).alias("file_name"), "path", "content")
    first = F.when(path.contains("/header/"), 0).otherwise(1)
    return streamed_sha256(named, ["file_name"], [first, *parts_in_order(path)], F.col("content")).select("file_name", "sha256")


def export_faults(df: DataFrame, columns: Sequence[str], grain: Sequence[str], aggregate: bool, identity: Sequence[str] = IDENTITY) -> DataFrame:
    """What speaks against publishing: columns other than listed, a grain that repeats, identities in an aggregate."""
    spark = df.sparkSession
    faults = []
    if tuple(df.columns) != tuple(columns):
        faults.append("columns")
    if aggregate and set(df.columns) & set(identity):
        faults.append("identity_columns")
    fixed = spark.createDataFrame([(f,) for f in faults], "failure_reason string")
    if not set(grain) <= set(df.columns):
        return fixed
    repeated = df.groupBy(*grain).count().where("count > 1").limit(1).select(F.lit("grain_not_unique").alias("failure_reason"))
    return fixed.union(repeated)


def manifest(spark: SparkSession, base: str, entries: dict[str, tuple[DataFrame, Sequence[str], Sequence[str]]], promoted: DataFrame, dialect: str = "") -> DataFrame:
    """Writes the exports (frame, columns, grain) below a folder that is not there yet, and gives a row for each: its file,
    rows, SHA-256 of the file's bytes as they are read back, grain, dialect, and how many releases it rests on. Fractions
    are rounded to nine places, so that the bytes don't hang on a last bit."""
    rows = [(name, f"{name}.csv", export_csv(df, f"{base}/{name}.csv", columns, grain, places=9), ",".join(grain), dialect) for name, (df, columns, grain) in sorted(entries.items())]
    listed = spark.createDataFrame(rows, "export string, file_name string, row_count bigint, grain string, dialect string")
    releases = promoted.agg(F.count("*").alias("release_count"))
    return listed.join(export_digests(spark, base), "file_name").crossJoin(F.broadcast(releases)).select("export", "file_name", "row_count", "sha256", "grain", "dialect", "release_count")  # one row


def last_run(runs: DataFrame) -> DataFrame:
    """The latest attempt: the latest end, then the greatest id."""
    return runs.orderBy(F.desc_nulls_last("ended_at_utc"), F.desc("attempt_id")).limit(1)


def capture_status(runs: DataFrame, promoted: DataFrame) -> DataFrame:
    """The latest attempt and whether it calls for a warning: rejected, failed, or accepted but not published."""
    last = last_run(runs)
    published = promoted.select(*RELEASE).withColumn("published", F.lit(True))
    outcome = F.col("normalized_outcome")
    warn = outcome.isNull() | outcome.isin("rejected", "operational_error") | (outcome.isin("accepted", "recovered") & ~F.coalesce("published", F.lit(False)))
    return last.join(published, list(RELEASE), "left").select("attempt_id", "normalized_outcome", "ended_at_utc", warn.alias("warning"))


def control_source(runs: DataFrame, promoted: DataFrame, retired_on: str | None = None) -> DataFrame:
    """What the pages show of the latest capture, one row with the six columns of the control source.

    Outcomes are those of the closed vocabulary: a recovered capture counts as accepted, one that no rule reached as an
    operational error. Reasons follow from the outcome unless the runs have a reason_category. An accepted capture is
    warned of until its release is published. Retirement is the caller's decision, with a date."""
    raw = F.coalesce("normalized_outcome", F.lit("operational_error"))
    outcome = F.when(raw == "recovered", "accepted").otherwise(raw)
    implied = F.when(outcome == "accepted", "none").when(outcome == "no_new_release", "source_not_advanced").when(outcome == "rejected", "structural_rejection").otherwise("source_transfer_error")
    reason = F.coalesce("reason_category", implied) if "reason_category" in runs.columns else implied
    published = promoted.select(*RELEASE).withColumn("published", F.lit(True))
    warn = outcome.isin("rejected", "operational_error") | ((outcome == "accepted") & ~F.coalesce("published", F.lit(False)))
    return last_run(runs).join(published, list(RELEASE), "left").select(
        outcome.alias("outcome"),
        reason.alias("reason_category"),
        "ended_at_utc",
        warn.alias("newer_attempt_not_accepted"),
        F.lit("active" if retired_on is None else "retired").alias("source_publication_state"),
        F.lit(retired_on).cast("string").alias("source_publication_retired_on"),
    )


def control_faults(rows: DataFrame) -> DataFrame:
    """What speaks against a control row: outcomes and reasons outside the vocabulary, a warning that its outcome excludes or
    calls for, a retirement without a date or a date without one."""
    c = F.col
    faults = {
        "outcome": ~F.coalesce(c("outcome").isin(*CONTROL_OUTCOMES), F.lit(False)),
        "reason_category": ~F.coalesce(c("reason_category").isin(*CONTROL_REASONS), F.lit(False)),
        "warning": c("newer_attempt_not_accepted").isNull() | (c("outcome").isin("rejected", "operational_error") & ~c("newer_attempt_not_accepted")) | ((c("outcome") == "no_new_release") & c("newer_attempt_not_accepted")),
        "retirement": ~F.coalesce(c("source_publication_state").isin("active", "retired"), F.lit(False))
        | ((c("source_publication_state") == "active") & c("source_publication_retired_on").isNotNull())
        | ((c("source_publication_state") == "retired") & c("source_publication_retired_on").try_cast("date").isNull()),
    }
    found = F.filter(F.array(*(F.when(F.coalesce(bad, F.lit(True)), F.lit(name)) for name, bad in faults.items())), lambda r: r.isNotNull())
    return rows.select(F.explode(found).alias("failure_reason"))


def empty(spark: SparkSession, schema) -> DataFrame:
    """No rows, with the full schema; what an absent input is."""
    return spark.createDataFrame([], schema)
