"""Incremental jobs: the stream of capture attempts, and the landing of releases as they arrive.

Jobs take what is there now and stop; a later run goes on where the last one ended. What a micro-batch writes is kept
under its id, and written over when the batch runs again after a crash, so nothing is written twice.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from muster.contracts import ATTEMPTS, RELEASE
from muster.operators.metrics import capture_runs


def attempt_stream(attempts: DataFrame, late: str = "1 day") -> DataFrame:
    """Normalised runs of a stream of timed attempts, each once however often its document arrives within the watermark.

    Documents without an end have no event time and belong in a batch."""
    timed = attempts.withColumn("ended_at", F.col("ended_at_utc").try_cast("timestamp")).where("ended_at is not null")
    return capture_runs(timed.withWatermark("ended_at", late).dropDuplicatesWithinWatermark(["attempt_id"]))


def read_attempt_stream(spark: SparkSession, path: str, files: int | None = None) -> DataFrame:
    """Attempts as JSON lines, in the order in which their files were written; `files` bounds a micro-batch."""
    reader = spark.readStream.schema(ATTEMPTS)
    return (reader.option("maxFilesPerTrigger", files) if files else reader).json(path)


def attempt_job(spark: SparkSession, path: str, taken: str, late: str, checkpoint: str, delay: str = "1 day", files: int | None = None) -> None:
    """Attempts below a path into two tables: `taken` has each attempt's normalised run once, `late` the documents that came
    so far behind the watermark that the stream lost them, under the batch in which they came.

    The second table is made by a stream of its own, which looks for its batch's ids in the first, so either one reads
    each document once however often the job runs."""
    append(attempt_stream(read_attempt_stream(spark, path, files), delay), taken, f"{checkpoint}/taken").awaitTermination()
    kind = attempt_stream(spark.createDataFrame([], ATTEMPTS).withColumn("ended_at_utc", F.lit(None).cast("string"))).schema

    def aside(batch: DataFrame, batch_id: int) -> None:
        ids = spark.read.schema(kind).parquet(taken).select("attempt_id")
        timed = batch.where(F.col("ended_at_utc").try_cast("timestamp").isNotNull())
        timed.join(ids, "attempt_id", "left_anti").write.mode("overwrite").parquet(f"{late}/batch={batch_id}")

    read_attempt_stream(spark, path, files).writeStream.foreachBatch(aside).option("checkpointLocation", f"{checkpoint}/late").trigger(availableNow=True).start().awaitTermination()


def append(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends what is there now and stops; a later call goes on where this one ended."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


#: A candidate release: its date, the fingerprint of its lists, and how many reasons speak against it.
CANDIDATE = "as_of_date string, revision_fingerprint string, reason_count bigint"
OUTCOME = "as_of_date string, release_revision bigint, revision_fingerprint string, reason_count bigint, raw_status string"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Revisions(StatefulProcessor):
    """State of a date: its last revision, and the fingerprints that were accepted, each with its revision.

    `remembered` is after how many milliseconds a fingerprint is forgotten (0: never); the last revision never is."""

    def __init__(self, remembered: int = 0) -> None:
        self.remembered = remembered

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "revision bigint")
        self.known = handle.getMapState("known", "fingerprint string", "revision bigint", self.remembered or None)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timers) -> Iterator[pd.DataFrame]:  # noqa: N802
        """Rejected with a reason, no_new_release with a fingerprint that the date has, else the date's next revision;
        candidates of one batch in the order of their fingerprints, each once."""
        found = pd.concat(rows).sort_values(["revision_fingerprint", "reason_count"]).drop_duplicates("revision_fingerprint")
        last = self.last.get()[0] if self.last.exists() else 0
        out = []
        for fingerprint, reasons in zip(found["revision_fingerprint"], found["reason_count"], strict=True):
            if reasons > 0:
                out.append((key[0], None, fingerprint, reasons, "rejected"))
            elif self.known.containsKey((fingerprint,)):
                out.append((key[0], None, fingerprint, reasons, "no_new_release"))
            else:
                last += 1
                self.known.updateValue((fingerprint,), (last,))
                out.append((key[0], last, fingerprint, reasons, "accepted"))
        if last:
            self.last.update((last,))
        yield pd.DataFrame(out, columns=["as_of_date", "release_revision", "revision_fingerprint", "reason_count", "raw_status"]).astype({"release_revision": "Int64", "reason_count": "Int64"})

    def close(self) -> None:
        pass


def landing_job(candidates: DataFrame, rows_of: Callable[[DataFrame], DataFrame], landed: str, catalogue: str, checkpoint: str, remembered: int = 0) -> None:
    """Candidates (CANDIDATE) as they arrive: what becomes of them is decided from the state of their date and kept in
    `catalogue`; the rows of accepted ones, which `rows_of` gives for their outcomes, in `landed`. Both tables have a
    folder for each batch.

    State is kept by the stream, in RocksDB below the checkpoint, so no batch reads the catalogue again. If a batch breaks
    off between the two writes, it runs again from the state before it, decides the same, and writes over its folders."""
    spark = candidates.sparkSession

    def write(outcomes: DataFrame, batch_id: int) -> None:
        decided = outcomes.persist()
        rows_of(decided.where("raw_status = 'accepted'").select(*RELEASE)).write.mode("overwrite").option("compression", "zstd").parquet(f"{landed}/batch={batch_id}")
        decided.write.mode("overwrite").parquet(f"{catalogue}/batch={batch_id}")
        decided.unpersist()

    # state that expires would have the stream run batches without data for ever, instead of stopping
    settings = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB, "spark.sql.streaming.noDataMicroBatches.enabled": "false"}
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        decided = candidates.groupBy("as_of_date").transformWithStateInPandas(Revisions(remembered), outputStructType=OUTCOME, outputMode="Append", timeMode="ProcessingTime" if remembered else "None")
        decided.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def next_revision(known: DataFrame, candidates: DataFrame) -> DataFrame:
    """What becomes of validated candidates (as_of_date, revision_fingerprint, reason_count): rejected with a reason,
    no_new_release with a fingerprint that is known for the date, else accepted as the date's next revision."""
    last = known.groupBy("as_of_date").agg(F.max("release_revision").alias("last"))
    same = known.select("as_of_date", "revision_fingerprint").distinct().withColumn("known", F.lit(True))
    joined = candidates.dropDuplicates(["as_of_date", "revision_fingerprint"]).join(last, "as_of_date", "left").join(same, ["as_of_date", "revision_fingerprint"], "left")
    state = F.when(F.col("reason_count") > 0, "rejected").when(F.coalesce("known", F.lit(False)), "no_new_release").otherwise("accepted")
    marked = joined.withColumn("raw_status", state)
    from pyspark.sql import Window

    order = Window.partitionBy("as_of_date", "raw_status").orderBy("revision_fingerprint")
    place = F.coalesce("last", F.lit(0)) + F.row_number().over(order)
    return marked.select("as_of_date", F.when(F.col("raw_status") == "accepted", place).cast("bigint").alias("release_revision"), "revision_fingerprint", "reason_count", "raw_status")


def landing_stream(rows: DataFrame, catalog: Callable[[], DataFrame], judge: Callable[[DataFrame], DataFrame], land: Callable[[DataFrame, DataFrame], None], checkpoint: str) -> StreamingQuery:
    """Landing of release rows as they arrive (with as_of_date and revision_fingerprint), a micro-batch at a time.

    `judge` gives candidates with reason counts for a batch; `land` gets the batch's accepted rows, with their revision,
    and the outcomes. A batch that is run again finds its fingerprints known and lands nothing twice."""

    def run(batch: DataFrame, _: int) -> None:
        outcomes = next_revision(catalog(), judge(batch))
        accepted = batch.join(outcomes.where("raw_status = 'accepted'").select(*RELEASE), ["as_of_date", "revision_fingerprint"])
        land(accepted, outcomes)

    return rows.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
