"""Detectors for sensitive text in the rows of a table. They tell where and how often, never what.

Digits and letters of the patterns are ASCII, so that results are the same in engines without Unicode classes."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The detectors' patterns, labels and lists.
FEDERAL_ID = r"\b[0-9]{2}-[0-9]{7}\b"
NINE_DIGITS = r"\b[0-9]{9}\b"
LABEL, LABEL_WINDOW = r"(?:FEIN|EIN|Federal\s+(?:Employer|Tax)\s+ID(?:entification)?(?:\s+Number)?)", 40
PHONE = r"\b[0-9]{3}-[0-9]{3}-[0-9]{4}\b"
EMAIL = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b"
WINDOWS_PATH = r"\b[A-Za-z]:[\\/][^\s\"'<>|]*"
HOME_PATH = r"/(?:Users|home)/[^\s\"'<>|]*"
ADDRESS = r"(?i)\b[0-9]{1,6}\s+[A-Za-z0-9.'-]+(?:\s+[A-Za-z0-9.'-]+){0,3}\s+(?:St|Street|Ave|Avenue|Blvd|Boulevard|Rd|Road|Dr|Drive|Ln|Lane|Way|Ct|Court)\b"
URL = r"(?i)https?://[^\s\"'<>]+"
JOIN_KEYS = ("fein", "ein", "ssn")
COUNTED, COUNTED_END, PLACE_BEFORE, BEFORE = ("files", "records", "rows", "documents"), r"\s+the\s+same\s+way$", r"(?i)\b(?:address|mailing|located|location|street)\b", 80

#: Detectors that are one pattern.
PATTERNS = {"federal_id": FEDERAL_ID, "phone": PHONE, "email": EMAIL, "windows_path": WINDOWS_PATH, "home_path": rf"(?<![A-Za-z0-9_/]){HOME_PATH}"}
#: What a match has at least: nine digits, and a house number, a word and St.
NINE, SHORTEST_ADDRESS = 9, 6


def ascii_form(pattern: str) -> str:
    """The pattern as Java has to read it: `\\b` sees ASCII letters, digits and the underscore only ('1 Main stä' has an end
    behind 'st'), `\\s` has no vertical tab, and without case s and k have the long s and the Kelvin sign beside them."""
    if pattern.startswith("(?i)"):
        more = {"A-Za-z": "A-Za-z\u017f\u212a", "s": "[s\u017f]", "S": "[S\u017f]", "k": "[k\u212a]", "K": "[K\u212a]"}
        pattern = re.sub(r"\\.|A-Za-z|[sSkK]", lambda m: more.get(m[0], m[0]), pattern)
    word, space = "[0-9A-Za-z_]", r"\t\n\f\r "
    bound = f"(?:(?<!{word})(?={word})|(?<={word})(?!{word}))"
    pattern = re.sub(r"\\b(?=\[0-9\]|\[A-Za-z\])", f"(?<!{word})", re.sub(r"\\b$", f"(?!{word})", pattern))  # where a word begins or ends beside it, half the bound
    return pattern.replace(r"[^\s", f"[^{space}").replace(r"\s", f"[{space}]").replace(r"\b", bound)


#: Stands before each match in a marked text; where a text has it, another sign takes its place.
MARK, INSTEAD = "\u0001", "\u0002"

Keep = Callable[[Column, Column, Column], Column]


def cut(body: Column, pattern: str) -> Column:
    """The text as pieces (between, match): what is before each match, and the match; the last piece has none."""
    own = ascii_form(pattern)
    return F.arrays_zip(F.split(body, own).alias("between"), F.regexp_extract_all(body, F.lit(f"({own})"), F.lit(1)).alias("match"))


def text_before(pieces: Column, i: Column, n: int, shortest: int) -> Column:
    """The last n characters before match i (from 0). Matches have `shortest` characters at least, so few pieces do."""
    first = F.greatest(i + 1 - -(-n // shortest), F.lit(1))
    earlier = F.transform(F.slice(pieces, first, i + 1 - first), lambda x: F.concat(x["between"], x["match"]))
    return F.right(F.concat(F.array_join(earlier, ""), F.element_at(pieces, i + 1)["between"]), F.lit(n))


def address_kept(pieces: Column, i: Column, match: Column) -> Column:
    """'12 of the records the same way' and its like are counted things, no address, unless a word for a place is before or
    a comma behind."""
    low = F.lower(match)
    inside = F.regexp_replace(F.regexp_replace(low, ascii_form(COUNTED_END), ""), ascii_form(r"^[0-9]+\s+"), "")
    words = low.rlike(ascii_form(COUNTED_END)) & inside.rlike(ascii_form(rf"(^|\s)(?:{'|'.join(COUNTED)})(\s|$)"))
    return ~(words & ~text_before(pieces, i, BEFORE, SHORTEST_ADDRESS).rlike(ascii_form(PLACE_BEFORE)) & ~F.element_at(pieces, i + 2)["between"].rlike(ascii_form(r"^\s?,")))


def label_kept(pieces: Column, i: Column, match: Column) -> Column:
    """A label begins and ends in the characters before, line ends among them."""
    return text_before(pieces, i, LABEL_WINDOW, NINE).rlike(ascii_form(f"(?i){LABEL}"))


def joins(url: Column, allowed: Sequence[str]) -> Column:
    """Whether a query key of the URL, decoded, is one that joins records, unless its host and the beginning of its path are
    allowed ('host/path'; the host must be equal, both in any case)."""
    fields = F.split(F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1), "&")
    named = lambda f: F.lower(F.coalesce(F.try_url_decode(F.substring_index(f, "=", 1)), F.substring_index(f, "=", 1))).isin(*JOIN_KEYS)
    host = F.lower(F.regexp_extract(url, ascii_form(r"(?i)^https?://(?:[^/?#]*@)?([^/?#:@]*)"), 1))
    path = F.lower(F.regexp_extract(url, ascii_form(r"(?i)^https?://[^/?#]*([^?#]*)"), 1))
    good = F.lit(False)
    for one in allowed:
        name, _, prefix = one.lower().partition("/")
        good = good | ((host == name) & F.startswith(path, F.lit(f"/{prefix}")))
    return F.exists(fields, named) & ~good


def cut_rows(df: DataFrame, key: str, body: Column) -> DataFrame:
    """(row_id, body) and, for the detectors that look at each match, the text in pieces; cut once, before any use."""
    rows = df.select(F.col(key).alias("row_id"), body.alias("body"))
    return rows.select("*", *(cut(F.col("body"), p).alias(name) for name, p in {"labelled_id": NINE_DIGITS, "street_address": ADDRESS, "join_url": URL}.items()))


def keeps(allowed: Sequence[str]) -> dict[str, Keep]:
    """Which matches count, by detector."""
    return {"labelled_id": label_kept, "street_address": address_kept, "join_url": lambda pieces, i, match: joins(match, allowed)}


def number_kept(pieces: Column, keep: Keep) -> Column:
    return F.size(F.filter(pieces, lambda x, i: x["match"].isNotNull() & keep(pieces, i, x["match"])))


def marked_kept(pieces: Column, keep: Keep) -> Column:
    """The text with a mark before each match that counts."""
    mark = lambda x, i: F.when(x["match"].isNotNull() & keep(pieces, i, x["match"]), MARK).otherwise("")
    return F.array_join(F.transform(pieces, lambda x, i: F.concat(x["between"], mark(x, i), F.coalesce(x["match"], F.lit("")))), "")


def findings(df: DataFrame, key: str, text: str, allowed_urls: Sequence[str] = ()) -> DataFrame:
    """(category, key, count) of each key with findings; one pass over the text. Rows with one key, or with none, count together."""
    rows = cut_rows(df, key, F.coalesce(F.col(text), F.lit("")))
    counts = {name: F.regexp_count("body", F.lit(ascii_form(p))) for name, p in PATTERNS.items()}
    counts |= {name: number_kept(F.col(name), keep) for name, keep in keeps(allowed_urls).items()}
    each = F.explode(F.array(*(F.struct(F.lit(name).alias("category"), c.cast("bigint").alias("n")) for name, c in sorted(counts.items()))))
    some = rows.select("row_id", each.alias("f")).select("f.category", "row_id", "f.n").where("n > 0")
    return some.groupBy("category", "row_id").agg(F.sum("n").alias("finding_count"))


def located(df: DataFrame, key: str, text: str, allowed_urls: Sequence[str] = ()) -> DataFrame:
    """(category, key, line, count) of each line in which findings begin; they may reach over its end. Of rows with one key, or
    with none, equal line numbers count together.

    Each match gets a mark before it, in one pass over the text, and the marks of a line are counted; so offsets need not
    be kept, and a text with many findings costs no more than its length."""
    rows = cut_rows(df, key, F.translate(F.coalesce(F.col(text), F.lit("")), MARK, INSTEAD))
    marked = {name: F.regexp_replace("body", F.lit(f"({ascii_form(p)})"), F.lit(f"{MARK}$1")) for name, p in PATTERNS.items()}
    marked |= {name: marked_kept(F.col(name), keep) for name, keep in keeps(allowed_urls).items()}
    each = F.explode(F.array(*(F.struct(F.lit(name).alias("category"), t.alias("marked")) for name, t in sorted(marked.items()))))
    some = rows.select("row_id", each.alias("f")).select("row_id", "f.category", "f.marked").where(F.contains("marked", F.lit(MARK)))
    lines = some.select("category", "row_id", F.posexplode(F.split("marked", "\n")).alias("at", "line"))
    n = F.length("line") - F.length(F.replace("line", F.lit(MARK), F.lit("")))
    begun = lines.select("category", "row_id", (F.col("at") + 1).cast("bigint").alias("line_no"), n.cast("bigint").alias("n")).where("n > 0")
    return begun.groupBy("category", "row_id", "line_no").agg(F.sum("n").alias("finding_count"))
