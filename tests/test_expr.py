from __future__ import annotations

import datetime as dt
import math
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from muster.functions import expr


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column(F.col("v")).alias("o")).first().o


def test_trims_differ_on_tabs_and_separators(spark):
    assert one(spark, expr.zs_trim, "  \tkey  ") == "\tkey"
    assert one(spark, expr.py_strip, "  \tkey \x1f") == "key"
    assert one(spark, expr.blank_to_null, "   ") is None
    assert one(spark, expr.blank_to_null, "\t") == "\t"


DATES = ["2026-07-15", "2026/7/5", " 2026 7 5 ", "2026\\07\\15", "26-1-2", "2026-02-30", "2026", "2026-07", "today", "n/a", "", None, "2026-07/15", "2026-07-15 12:30", "2026-07-15T12:30:01.5", "0001-01-01", "20260715", "2024-02-29", "2023-02-29", "31/31/31"]


@pytest.mark.parametrize("text", DATES)
def test_dates_are_those_of_the_other_engine(spark, text):
    expected = duckdb.sql("SELECT try_cast(nullif(trim(?), '') AS DATE)", params=[text]).fetchall()[0][0] if text is not None else None
    got = one(spark, expr.safe_date, text)
    assert got == expected
    flag = one(spark, expr.nonblank_unparseable, text)
    assert flag == (bool(text and text.strip()) and expected is None)


@pytest.mark.parametrize(("text", "iso"), [("2026/07/15", "2026-07-15"), ("2026-07-15", "2026-07-15"), ("2026/02/30", None), ("2026/7/15", None), ("2026/07-15", None), ("\t2026/07/15 ", "2026-07-15"), ("", None)])
def test_as_of_dates(spark, text, iso):
    assert one(spark, expr.normal_as_of_date, text) == iso


def test_ratios_and_intervals(spark):
    rows = [(k, n) for n in (0, 1, 3, 10, 557) for k in (0, 1, n // 2, n) if k <= n]
    df = spark.createDataFrame(rows, "k long, n long").select("k", "n", expr.ratio(F.col("k"), F.col("n")).alias("r"), *(expr.wilson(F.col("k"), F.col("n"), s).alias(s) for s in ("lower", "upper")))
    for r in df.collect():
        if r.n == 0:
            assert r.r is r.lower is r.upper is None
            continue
        z, p = 1.959963984540054, r.k / r.n
        middle, spread, scale = p + z * z / (2 * r.n), z * math.sqrt(p * (1 - p) / r.n + z * z / (4 * r.n * r.n)), 1 + z * z / r.n
        assert r.r == p
        assert r.lower == pytest.approx(max(0, (middle - spread) / scale), abs=1e-12)
        assert r.upper == pytest.approx(min(1, (middle + spread) / scale), abs=1e-12)
    with pytest.raises(ValueError):
        expr.wilson(F.lit(1), F.lit(2), "middle")


def test_seconds_count_boundaries(spark):
    df = spark.createDataFrame([("2026-01-01 00:00:00.900", "2026-01-01 00:04:55.100")], "a string, b string")
    assert df.select(expr.seconds_between(F.col("a"), F.col("b"))).first()[0] == 295


def test_days(spark):
    df = spark.createDataFrame([(dt.date(2024, 2, 28), "2024-03-01")], "a date, b string")
    assert df.select(expr.days_between(F.col("a"), F.col("b"))).first()[0] == 2


def test_numbers_as_text_are_those_of_the_other_engine(spark):
    rng = random.Random(4)
    values = [rng.randrange(1, 10**6) / rng.randrange(1, 10**6) for _ in range(3000)] + [rng.random() * 10 ** rng.randint(-9, 15) for _ in range(3000)]
    values += [0.0, 1.0, 1.5, 0.1, 0.001, 2e-3, 1e-4, 9.5e-4, 2e-5, 1 / 30000, 2.0**-44, 12345678.5, 1e15]
    got = [r.t for r in spark.createDataFrame([(v,) for v in [*values, None]], "v double").select(expr.number_text(F.col("v")).alias("t")).collect()]
    assert got == [*(duckdb.execute("SELECT list_transform(?::DOUBLE[], lambda v: v::VARCHAR)", [values]).fetchone()[0]), None]


def test_dates_are_parsed_once(spark):
    """A date and its flag come from one parse, of all the forms that a date takes."""
    from muster.operators import panel

    texts = ["2020/1/5", " 5-1-1 ", "20-01-05", "0000/1/1", "2020-02-30", "2020-1/5", "2020 1 5", "2020\\1\\5", "2020-01-05T10:00", "2020-01-05 1:2:3.5 \n", "2020-01-05\u0085", "2020-01-05x", "2020", "2020-01", "+2020-01-05", "02020-01-05", "n/a", "", " ", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, d string")
    got = panel.staged(rows, {}, {"d": "d"}, ("i",))
    form = [F.regexp_extract(expr.zs_trim(F.col("d")), expr.DATE_FORM, k) for k in (1, 3, 4)]
    again = F.when(expr.zs_trim(F.col("d")).rlike(expr.DATE_FORM), F.concat_ws("-", *(F.lpad(p, n, "0") for p, n in zip(form, (4, 2, 2), strict=True))).try_cast("date"))
    flag = F.coalesce(expr.zs_trim(F.col("d")) != "", F.lit(False)) & again.isNull()
    told = [sorted(map(tuple, df.collect())) for df in (got.select("i", F.col("d").cast("string"), "d_unparseable"), rows.select("i", again.cast("string"), flag))]
    assert told[0] == told[1] and any(t[1] for t in told[0]) and any(t[2] for t in told[0])
    assert got._jdf.queryExecution().optimizedPlan().toString().count("RLIKE") == 1
