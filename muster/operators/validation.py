"""Validation of a whole release: predicates that each give reasons (code, rank, source_list, line_no, count).

No reasons: the release is admitted, whole. Every check is an aggregate over the release's rows, or a join with one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from muster.contracts import CONTRACT_REASONS, HEADERS, KEY_FORM, REASON_RANK, SOURCE_LISTS, STATUSES
from muster.functions.expr import py_strip
from muster.functions.shared import written
from muster.sources.landing import UNDEFINED, fields


def reason(df: DataFrame, code: str, line: Column | None = None, count: Column | None = None, by_list: bool = True) -> DataFrame:
    return df.select(
        F.lit(code).alias("code"),
        F.lit(REASON_RANK[code]).alias("rank"),
        (F.col("source_list") if by_list else F.lit(None).cast("string")).alias("source_list"),
        (line if line is not None else F.lit(None)).cast("bigint").alias("line_no"),
        (count if count is not None else F.lit(1)).cast("bigint").alias("count"),
    )


def file_reasons(lines: DataFrame, headers: Sequence[str] = HEADERS) -> DataFrame:
    """Of lines (source_list, line_no, text): bytes that don't decode, a wrong header, the first line of wrong length."""
    cut = fields(lines)
    decode = lines.where(F.col("text").rlike(UNDEFINED)).groupBy("source_list").agg(F.min("line_no").alias("line"), F.count("*").alias("n"))
    wrong = cut.where((F.col("line_no") == 1) & (F.col("fields") != F.array(*map(F.lit, headers))))
    short = cut.where((F.col("line_no") > 1) & (F.col("text") != "") & (F.size("fields") != len(headers))).groupBy("source_list").agg(F.min("line_no").alias("line"))
    return reason(decode, "parse.decode_failed", F.col("line"), F.col("n")).union(reason(wrong, "parse.header_mismatch", F.lit(1))).union(reason(short, "parse.arity_mismatch", F.col("line")))


def count_reasons(lines: DataFrame, landed: DataFrame) -> DataFrame:
    """Lists whose nonblank lines are not as many as their records."""
    there = lines.where((F.col("line_no") > 1) & (F.col("text") != "")).groupBy("source_list").agg(F.count("*").alias("n"))
    here = landed.groupBy("source_list").agg(F.count("*").alias("m"))
    both = there.join(here, "source_list", "full_outer").where(~F.col("n").eqNullSafe(F.col("m")))
    return reason(both, "parse.line_record_mismatch")


def modal_date(rows: DataFrame, date: Column) -> DataFrame:
    """The most frequent nonblank date, ties to the smallest text; one row or none."""
    return rows.select(date.alias("date")).where("date <> ''").groupBy("date").count().orderBy(F.desc("count"), "date").limit(1).select(F.col("date").alias("modal"))


def record_reasons(rows: DataFrame, key: str, status: str, date: str, key_form: str = KEY_FORM, statuses: Sequence[str] | None = None) -> DataFrame:
    """Of records (source_list, source_line_no and the named columns): dates, forms of keys, keys that repeat (every
    occurrence), and, if asked, statuses outside the vocabulary (one reason per list, with a count)."""
    own = rows.select("source_list", F.col("source_line_no").alias("line"), *(F.coalesce(py_strip(F.col(f"`{c}`")), F.lit("")).alias(n) for c, n in ((key, "k"), (status, "s"), (date, "d"))))
    line = F.col("line")
    blank = own.where("d = ''")
    odd = own.join(F.broadcast(modal_date(own, F.col("d"))), (F.col("d") != F.col("modal")) & (F.col("d") != ""))  # one row
    keyed = own.where("k <> ''")
    unknown = keyed.where(~F.col("k").rlike(key_form))
    # counts combine before the shuffle and are written; the join is one of plain shuffles, whose hot keys adaptive execution splits
    twice = written(keyed.groupBy("k").count().where("count > 1").select("k"), "repeated")
    repeated = keyed.join(twice, "k")
    out = reason(blank, "date.blank", line).union(reason(odd, "date.mismatch", line)).union(reason(unknown, "registration.unknown_format", line)).union(reason(repeated, "registration.duplicate", line))
    if statuses is not None:
        strange = own.where((F.col("s") != "") & ~F.col("s").isin(*statuses)).groupBy("source_list").agg(F.count("*").alias("n"))
        out = out.union(reason(strange, "set.unknown_registry_status", None, F.col("n")))
    return out


def ordered(reasons: DataFrame, lists: Sequence[str] = SOURCE_LISTS) -> DataFrame:
    """By rank, then list (none first), then line."""
    place = F.when(F.col("source_list").isNull(), -1).otherwise(F.array_position(F.array(*map(F.lit, lists)), F.col("source_list")) - 1)
    return reasons.orderBy("rank", place, F.asc_nulls_first("line_no"))


def verdict(reasons: DataFrame) -> DataFrame:
    """One row: accepted, source_contract_mismatch or structural_rejection, and how many reasons."""
    mismatch = F.max(F.col("code").isin(*CONTRACT_REASONS))
    state = F.when(F.count("*") == 0, "accepted").when(mismatch, "source_contract_mismatch").otherwise("structural_rejection")
    return reasons.agg(state.alias("verdict"), F.count("*").alias("reason_count"))


def registry_reasons(lines: DataFrame, landed: DataFrame, known_statuses: bool = True) -> DataFrame:
    """All reasons against a release of list files."""
    own = record_reasons(landed, "State Charity Reg#", "Registry Status", "As-of Date", statuses=STATUSES if known_statuses else None)
    return file_reasons(lines).union(count_reasons(lines, landed)).union(own)
