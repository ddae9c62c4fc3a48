"""Column expressions with the registry's semantics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters of Unicode category Zs, and those that Python's str.strip() takes off besides.
SPACE_SEPARATORS = "\u0020\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"
CONTROL_SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\u2028\u2029"
#: The 97.5 % point of the standard normal distribution, and its square as the interval's formula has it.
Z, Z_SQUARED = 1.959963984540054, 3.8414588206941254

DATE_FORM = r"^\s*(\d{1,4})([-/ \\])(\d{1,2})\2(\d{1,2})\s*(?:[ T]\d{1,2}:\d{1,2}(?::\d{1,2}(?:\.\d{1,9})?)?)?\s*$"


def zs_trim(c: Column) -> Column:
    """Without space separators at the ends; tabs stay. This is what staging does."""
    return F.trim(c, F.lit(SPACE_SEPARATORS))


def py_strip(c: Column) -> Column:
    """Without any white space at the ends. This is what validation does."""
    return F.trim(c, F.lit(SPACE_SEPARATORS + CONTROL_SPACES))


def blank_to_null(c: Column) -> Column:
    return F.nullif(zs_trim(c), F.lit(""))


def date_of(text: Column) -> Column:
    """A date of trimmed text: year, month and day with one of four separators, short parts allowed; null for anything else.

    One pattern tests and one takes all parts; years of up to seven digits are read, so short ones are filled up in front."""
    parts = F.regexp_replace(text, f"(?s){DATE_FORM.removesuffix('$')}.*", "000$1-$3-$4")
    return F.when(text.rlike(DATE_FORM), parts.try_cast("date"))


def safe_date(c: Column) -> Column:
    return date_of(blank_to_null(c))


def nonblank_unparseable(c: Column) -> Column:
    """Whether there is something that is no date; never null."""
    return blank_to_null(c).isNotNull() & safe_date(c).isNull()


def normal_as_of_date(c: Column) -> Column:
    """YYYY/MM/DD or YYYY-MM-DD as ISO text, if the calendar has the day."""
    form = r"^(\d{4})([/-])(\d{2})\2(\d{2})$"
    text = py_strip(c)
    date = F.concat_ws("-", *(F.regexp_extract(text, form, i) for i in (1, 3, 4))).try_cast("date")
    return F.when(text.rlike(form), F.date_format(date, "yyyy-MM-dd"))


def ratio(n: Column, of: Column) -> Column:
    """n / of in doubles; null where there is nothing to divide by."""
    return F.when(of == 0, F.lit(None).cast("double")).otherwise(n.cast("double") / F.nullif(of, F.lit(0)))


def wilson(k: Column, n: Column, side: str) -> Column:
    """Bound of the 95 % Wilson interval of k in n, within [0, 1]; null for n = 0. A null n gives 1, as least() skips nulls."""
    if side not in ("lower", "upper"):
        raise ValueError("side is lower or upper")
    size = F.nullif(n, F.lit(0)).cast("double")
    p = k.cast("double") / size
    middle = p + F.lit(Z_SQUARED) / (F.lit(2.0) * size)
    spread = F.lit(Z) * F.sqrt((p * (F.lit(1.0) - p) + F.lit(Z_SQUARED) / (F.lit(4.0) * size)) / size)
    bound = (middle - spread if side == "lower" else middle + spread) / (F.lit(1.0) + F.lit(Z_SQUARED) / size)
    return F.when(n == 0, F.lit(None).cast("double")).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), bound)))


def number_text(v: Column) -> Column:
    """A double as text with the fewest digits that tell it from others; plain between 1e-4 and 1e16, else like 2e-05."""
    tries = [F.format_string(f"%.{d}e", v) for d in (14, 15, 16)]
    digits = F.when(tries[0].cast("double") == v, tries[0]).when(tries[1].cast("double") == v, tries[1]).otherwise(tries[2])
    plain = F.regexp_replace(digits.try_cast("decimal(38,20)").cast("string"), r"0+$", "")
    short = F.regexp_replace(digits, r"\.?0*e", "e")
    fixed = (F.abs(v) >= 1e-4) & (F.abs(v) < 1e16)
    return F.when(v == 0, "0.0").when(fixed, F.regexp_replace(plain, r"\.$", ".0")).when(v.isNotNull(), short)


def seconds_between(start: Column, end: Column) -> Column:
    """Second boundaries crossed from one timestamp text to the other."""
    at = lambda c: F.unix_seconds(c.try_cast("timestamp"))
    return at(end) - at(start)


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end.cast("date"), start.cast("date")).cast("bigint")


def n_where(condition: Column) -> Column:
    """How many rows fulfil it, as a bigint that is never null."""
    return F.count(F.when(condition, F.lit(1)))
