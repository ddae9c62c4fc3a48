"""PII: keyed surrogates that keep type and form.

Detected are mail addresses (letters of any script), telephone numbers (international, North American, and national ones
that begin with 0), card and social-security numbers, account numbers (IBAN), IP addresses of both versions, access keys,
passwords and tokens after their names, and persons after a form of address or several ("Frau Prof. Dr. Berg"). An entity
is its type and its canonical value: the digits of a number, an address in lower case, and each word of a person's name by
itself, whatever form of address and letter case it had. So "Mrs Anna Berg", "DR ANNA BERG", "anna berg" and "Ms Berg" get
the same words. A surrogate
follows from a keyed hash (HMAC-SHA-256) of type and value, so an entity has one surrogate in all texts, and keeps the
form: separators, lengths, letter case, script, country codes, check digits, private or public address, gender of a given
name (from the form of address; for Cyrillic and Greek names from their ending). Where texts give a word several genders,
one is settled for all: female, else male. Names in scripts without a list of syllables get letters of the same block.

Collision checks: over all distinct entities, no two get the same surrogate and none gets a value that occurs as a
real entity. Whoever collides draws anew (a counter in the hash), until nothing collides. After GROWS draws the free
part of a surrogate grows with each draw: a name by a syllable, a mail address or secret by a letter; a private address
leaves its block, a telephone number its country code. Only numbers of fixed length (telephone, card and social-security
numbers, IBAN, IP addresses) then have an end, that of their form; after DISTINCT draws one may take another real value,
as long as surrogates differ. Only words and values that drew anew, or have a gender settled, are handed to the pass that
rewrites: broadcast up to BROADCAST of them, joined by text beyond.

A secret without letters and digits is a mask (`********`) and stays. What follows the name of a password is one from six
signs on, unless it is a word that prose has there (PROSE); behind other names it must hold a digit, be in quotes, or have
twelve signs. A name is found after a form of address, and in the same text wherever it occurs again, in any case, or its
last word does, in the same case or in capitals; so a word that is also a name ("The Berg is high") is replaced where a
person of that name is in the text. Initials stay. Offices ("Mr Chairman") and pronouns ("Sir, I") are no names. A name
that never has a form of address in its text stays.
Null text stays null and empty text empty; texts without entities come back unchanged. Long texts are read whole.
Repeated rows come back as often as they went in. Columns of the input stay, whatever they are called; the text column is
replaced.
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from muster.llm.common import chunks, written

#: Most exceptions that are broadcast.
BROADCAST = 20_000
#: Most draws for one entity before the check gives up with an error.
DRAWS = 60
#: Draws after which the free part of a surrogate grows, and after which one of fixed length may be another's real value.
GROWS, DISTINCT = 3, 40
#: Longest local part of a mail address and longest secret that are detected.
LONGEST = {"email": 64, "secret": 200}

#: Forms of address by gender, in the languages that are detected.
MALE = "Mr Mister Sir Herr Monsieur Señor Sr Signor Don Г-н Господин".split()
FEMALE = "Mrs Ms Miss Madam Frau Madame Mme Mademoiselle Mlle Señora Sra Srta Signora Doña Г-жа Госпожа".split()
NEUTRAL = "Dr Prof Mx Professor Doctor Doktor Professeur Доктор".split()
#: What follows a form of address without being a name, and what follows the word for a password in prose.
OFFICES = frozenset(
    "i you he she we they it the a an this that and or chairman chair chairwoman chairperson president speaker minister secretary ambassador mayor judge senator governor "
    "ich er sie wir präsident präsidentin vorsitzender vorsitzende minister ministerin bürgermeister kanzler kanzlerin président présidente ministre maire juge je nous vous "
    "presidente presidenta ministro ministra alcalde alcaldesa juez yo usted ustedes".split()
)
PROSE = frozenset("required optional protected incorrect invalid missing changed change expired policy reset manager strength length hidden unknown encrypted recovery protection forgotten needed".split())
#: Beginnings and, by gender, endings of given and family names, by script.
STEMS = {
    "LATIN": ["Al", "Ber", "Cor", "Dan", "El", "Fer", "Gal", "Hen", "Is", "Jul", "Kar", "Lor", "Mar", "Nor", "Ol", "Pet", "Ros", "Sel", "Tor", "Val"],
    "CYRILLIC": ["Ал", "Бор", "Вер", "Гал", "Дан", "Ев", "Зар", "Ил", "Кар", "Лар", "Мар", "Ник", "Ол", "Пав", "Рос", "Сав", "Тим", "Фед"],
    "GREEK": ["Αλ", "Βασ", "Γερ", "Δημ", "Ευ", "Ηλ", "Θεο", "Καλ", "Λαμ", "Μαρ", "Νικ", "Παν", "Στε", "Φωτ"],
}
MIDDLES = {"LATIN": ["an", "bel", "der", "il", "mon", "ren", "sam", "tin", "vor", "win"], "CYRILLIC": ["ан", "бел", "дар", "ил", "мон", "рен", "сам", "тим"], "GREEK": ["αν", "δορ", "ελ", "ιν", "μον", "ρεν", "σαμ"]}
ENDINGS = {
    "LATIN": {"m": ["o", "us", "en", "ard"], "f": ["a", "ina", "elle", "ia"], "n": ["is", "er", "ley", "in"]},
    "CYRILLIC": {"m": ["ов", "ин", "ий"], "f": ["ова", "ина", "ая"], "n": ["ко", "ен", "их"]},
    "GREEK": {"m": ["ος", "ης", "ας"], "f": ["ου", "η", "α"], "n": ["ι", "ις", "ω"]},
}

_TITLES = "|".join(sorted(map(re.escape, MALE + FEMALE + NEUTRAL), key=len, reverse=True))
_NAME = rf"(?!(?:{_TITLES})(?![\w\-]))[^\W\d_a-zà-ÿа-яα-ω][^\W\d_]*(?:['’\-][^\W\d_]+)*"
_INITIALS = r"(?:[^\W\d_a-zà-ÿа-яα-ω]\.[ \t]?)*"
PERSON = re.compile(rf"\b((?:{_TITLES})\.?(?:[ \t]+(?:{_TITLES})(?![\w\-])\.?)*)[ \t]+({_INITIALS}{_NAME}(?:[ \t]+{_INITIALS}{_NAME}){{0,2}})")
EMAIL = re.compile(r"[\w.%+\-]{1,64}@[^\W_](?:[^\W_]|-){0,62}(?:\.(?:[^\W_]|-){1,63})*\.[^\W\d_]{2,24}(?![\w])")
SECRET = re.compile(r"(?i)((?P<name>password|passwd|pwd|token|secret|api[_\-]?key|access[_\-]?key)[\"']?\s{0,3}[=:]\s{0,3})([\"']?)([^\s\"',;]{6,200})")
ACCESS = re.compile(r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])")
IP = re.compile(r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d)")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?(?![A-Za-z0-9])")
SSN = re.compile(r"(?<![\d\-])\d{3}-\d{2}-\d{4}(?![\d\-])")
CARD = re.compile(r"(?<![\d.])(?:\d{13,19}|\d{4}(?:[ \-]\d{4}){3})(?![\d])")
IP6 = re.compile(r"(?<![\w:.])[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){2,7}(?![\w:])")
NATIONAL = re.compile(r"(?<![\w.])(?<!\d[ ])0\d{1,4}[ /\-]\d{3,8}(?:[ \-]\d{2,4}){0,2}(?![\d])")
PHONE = re.compile(r"(?<![\w.])(?:\+\d{1,3}[ .\-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .\-]?\d{2,4}){1,4}|\(\d{3}\) ?\d{3}[ .\-]\d{4}|\d{3}[.\-]\d{3}[.\-]\d{4})(?![\d])")
_MARK = re.compile(r"[0-9@]|::")
_WORDS = ("password", "passwd", "pwd", "token", "secret", "key")

_MALE, _FEMALE = frozenset(MALE), frozenset(FEMALE)

Found = tuple[int, int, str, str, str]  # start, end, type, canonical value, gender of a name


def detect(text: str) -> list[Found]:
    """The entities of a text in order, names word by word; where two overlap, the earlier rule's stands."""
    out: list[Found] = []

    def take(start: int, end: int, kind: str, value: str, gender: str = "") -> None:
        if all(end <= a or start >= b for a, b, *_ in out):
            out.append((start, end, kind, value, gender))

    low = text.lower()
    if any(w in low for w in _WORDS):
        for m in SECRET.finditer(text):
            value = m[4]
            named = m["name"].lower() in ("password", "passwd", "pwd") and value.strip(".!?)").lower() not in PROSE
            if any(map(str.isalnum, value)) and (named or m[3] or any(map(str.isdigit, value)) or len(value) >= 12):
                take(m.start(4), m.end(4), "secret", value)
    if _MARK.search(text):
        if "@" in text:
            for m in EMAIL.finditer(text):
                take(m.start(), m.end(), "email", m[0].lower())
        if "A" in text:
            for m in ACCESS.finditer(text):
                take(m.start(), m.end(), "access_key", m[0])
        for kind, rule in (("ip", IP), ("iban", IBAN), ("ssn", SSN), ("card", CARD), ("phone", PHONE), ("phone", NATIONAL)):
            for m in rule.finditer(text):
                digits = sum(map(str.isdigit, m[0]))
                if kind == "phone" and m[0][0] == "0" and not 9 <= digits <= 12:
                    continue
                take(m.start(), m.end(), kind, re.sub(r"[^A-Z0-9.]" if kind in ("ip", "iban") else r"\D", "", m[0]))
        if ":" in text:
            for m in IP6.finditer(text):
                if (value := _ip6(m[0])) is not None:
                    take(m.start(), m.end(), "ip6", value)
    titled = []
    for m in PERSON.finditer(text):
        name = re.sub(r"['’]s$", "", m[2])
        parts = [w for w in re.split(r"[ \t]+|(?<=\.)", name) if w and not w.endswith(".")]
        if parts and parts[0].casefold() not in OFFICES and (len(parts) > 1 or len(parts[0]) > 1):
            titles = {t.rstrip(".") for t in m[1].split()}
            titled.append(("m" if titles & _MALE else "f" if titles & _FEMALE else "n", m.start(2), name, parts))
    if titled:
        genders: dict[str, str] = {}  # of given names
        again: dict[str, str] = {}  # patterns of names that may occur again
        for gender, _, _, parts in titled:
            for word in parts[:-1]:
                genders[word.casefold()] = min(genders.get(word.casefold(), "n"), gender)
            if len(parts) > 1:
                again[r"[ \t]+".join(map(re.escape, parts)).casefold()] = "(?i:" + r"[ \t]+".join(map(re.escape, parts)) + ")"
            last = parts[-1]
            again[last] = f"(?:{re.escape(last)}|{re.escape(last.upper())})"

        def words(start: int, name: str) -> None:
            for w in re.finditer(r"[^\s.]+(?:\.(?=[ \t]|$))?|\.", name):
                if not w[0].endswith("."):
                    take(start + w.start(), start + w.end(), "name", w[0].casefold(), _gender(w[0], genders.get(w[0].casefold(), "n")))

        for _, start, name, _ in titled:
            words(start, name)
        for pattern in again.values():  # the same name elsewhere in the text, without a form of address
            for m in re.finditer(rf"(?<![\w\-]){pattern}(?![\w\-])", text):
                words(m.start(), m[0])
    return sorted(out)


def _ip6(text: str) -> str | None:
    """All eight groups of an address of version 6, in full; None if the text is none, or has under three groups."""
    if sum(map(bool, text.split(":"))) < 3:
        return None
    try:
        return ipaddress.IPv6Address(text).exploded
    except ValueError:
        return None


def _gender(word: str, given: str) -> str:
    """That of the form of address for a given name; by the ending where the script has gendered endings."""
    script, last = _script(word), word[-1:].casefold()
    if script == "CYRILLIC":
        return "f" if last in "ая" else "m"
    if script == "GREEK":
        return "m" if last == "σ" else "f"
    return given


class Draw:
    """Numbers from a keyed hash of an entity and the count of the draw."""

    def __init__(self, key: bytes, kind: str, value: str, draw: int) -> None:
        self.seed = hmac.new(key, f"{kind}\0{value}\0{draw}".encode(), hashlib.sha256).digest()
        self.block, self.at, self.n = b"", 0, 0

    def below(self, n: int) -> int:
        while self.at + 4 > len(self.block):
            self.block = self.block[self.at :] + hashlib.sha256(self.seed + self.n.to_bytes(4, "big")).digest()
            self.at, self.n = 0, self.n + 1
        x = int.from_bytes(self.block[self.at : self.at + 4], "big")
        self.at += 4
        return x * n >> 32

    def of(self, choices):
        return choices[self.below(len(choices))]


@lru_cache(4096)
def _letters(block: int, lower: bool, upper: bool) -> list[str]:
    """The letters of this case among 256 characters; a case that isn't there has the others."""
    every = [c for c in map(chr, range(block * 256, block * 256 + 256)) if c.isalpha()]
    return [c for c in every if (c.islower(), c.isupper()) == (lower, upper)] or every


def _alike(draw: Draw, value: str) -> str:
    """Each letter becomes a letter of its case and block and each digit a digit; a hexadecimal value stays one."""
    plain = [c for c in value if c.isalnum()]
    hexadecimal = any(c.isdigit() for c in plain) and all(c in "0123456789abcdef" for c in plain)

    def pick(c: str) -> str:
        if c.isdigit():
            return draw.of("0123456789")
        if not c.isalpha():
            return c
        if hexadecimal and c.islower():
            return draw.of("abcdef")
        if ord(c) < 0x250:
            return draw.of("ABCDEFGHIJKLMNOPQRSTUVWXYZ" if c.isupper() else "abcdefghijklmnopqrstuvwxyz")
        return draw.of(_letters(ord(c) >> 8, c.islower(), c.isupper()))

    return "".join(map(pick, value))


def _grown(draw: Draw, kind: str, value: str, more: int) -> str:
    """The value with so many letters more at its end, within the length that is detected."""
    return value[: LONGEST[kind] - more] + "".join(draw.of("abcdefghijklmnopqrstuvwxyz") for _ in range(more))


def _luhn(digits: str) -> int:
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(map(int, reversed(digits)))) % 10


def _script(name: str) -> str:
    letter = next((c for c in name if c.isalpha()), "a")
    return unicodedata.name(letter, "LATIN").split()[0].split("-")[0]


def surrogate(key: bytes, kind: str, value: str, draw: int = 0, gender: str = "n") -> str:
    """The canonical value that stands for the entity; put into the text's form by dressed()."""
    d = Draw(key, kind, value, draw)
    more = max(0, draw - GROWS)
    if kind == "email":
        local, _, host = value.rpartition("@")
        labels = host.split(".")
        return _grown(d, kind, _alike(d, local), more) + "@" + ".".join([*(_alike(d, x) for x in labels[:-1]), labels[-1]])
    if kind == "ip":
        octets = [int(x) for x in value.split(".")]
        kept = {10: 1, 127: 1, 192: 2 if octets[1] == 168 else 0, 172: 2 if 16 <= octets[1] < 32 else 0}.get(octets[0], 0)
        if kept and more:  # the block may be used up: the largest private one, then any
            octets, kept = ([10], 1) if more < 12 else (octets, 0)
        fresh = [d.of([x for x in range(1, 224) if x not in (10, 127, 169, 172, 192)]), *(d.below(254) + 1 for _ in range(3))]
        return ".".join(map(str, octets[:kept] + fresh[kept:]))
    if kind == "ip6":
        groups = value.split(":")
        return ":".join([groups[0], *(g if g == "0000" else f"{d.of('123456789abcdef')}{d.below(4096):03x}"[4 - len(g.lstrip("0")) :].zfill(4) if len(g.lstrip("0")) < 4 and not more else f"{1 + d.below(65535):04x}" for g in groups[1:])])
    if kind == "card":
        body = value[0] + "".join(d.of("0123456789") for _ in value[1:-1])
        last = d.below(10) if _luhn(value) else next(x for x in range(10) if _luhn(body + str(x)) == 0)
        return body + str(last)
    if kind == "phone":
        kept = max(value[0] == "0", len(value) - 10) if more < 12 else 0
        return value[:kept] + "".join(d.of("23456789" if i in (0, 3) else "0123456789") for i in range(len(value) - kept))
    if kind == "ssn":
        return ("9" if more < 12 else d.of("0123456789")) + "".join(d.of("0123456789") for _ in range(8))
    if kind == "iban":
        body = _alike(d, value[4:])
        number = "".join(str(int(c, 36)) for c in body + value[:2] + "00")
        return f"{value[:2]}{98 - int(number) % 97:02d}{body}"
    if kind == "access_key":
        return value[:4] + "".join(d.of("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in value[4:])
    if kind == "name":
        script = _script(value)
        if script not in STEMS:
            return _alike(d, value + value[-1] * more).casefold()
        return (d.of(STEMS[script]) + "".join(d.of(MIDDLES[script]) for _ in range(1 + more)) + d.of(ENDINGS[script][gender])).casefold()
    return _grown(d, kind, _alike(d, value), more)


def dressed(kind: str, original: str, value: str) -> str:
    """The surrogate in the form that the original has in its text."""
    if kind in ("phone", "card", "ssn", "iban"):
        rest = iter(value)
        return "".join(next(rest, "") if c.isalnum() else c for c in original)
    if kind == "name":
        if len(original) > 1 and original.isupper():
            return value.upper()
        value = re.sub(r"σ$", "ς", value)
        return value[:1].upper() + value[1:] if original[:1].isupper() else value
    if kind == "email":
        return value.upper() if original.isupper() else value
    if kind == "ip6":
        return _in_form(original, value)
    return value


def _in_form(original: str, value: str) -> str:
    """The eight groups of an address of version 6 with the original's gap, letter case, and zeros before a group."""
    fresh, parts = value.split(":"), original.split(":")
    head, tail = original.partition("::")[::2] if "::" in original else (original, "")
    first, last = ([x for x in side.split(":") if x] for side in (head, tail))
    own = [*zip(first, fresh, strict=False), *zip(last, fresh[8 - len(last) :] if last else [], strict=True)]
    shown = [g.zfill(4) if len(o) == 4 else g.lstrip("0") or "0" for o, g in own]
    text = ":".join(shown[: len(first)]) + ("::" + ":".join(shown[len(first) :]) if "::" in original else "")
    return text.upper() if any(map(str.isupper, "".join(parts))) else text


Known = dict[tuple[str, str], tuple[int, str]]  # draw and gender by type and value


def rewritten(text: str, key: bytes, exceptions: Known) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with surrogates, and type, start and length of each in the new text."""
    out, at, spans, size = [], 0, [], 0
    for start, end, kind, value, gender in detect(text):
        draw, gender = exceptions.get((kind, value), (0, gender))
        new = dressed(kind, text[start:end], surrogate(key, kind, value, draw, gender or "n"))
        out += [text[at:start], new]
        size += start - at
        spans.append((kind, size, len(new)))
        size += len(new)
        at = end
    return "".join([*out, text[at:]]), spans


def entities(docs: DataFrame, text: str = "text") -> DataFrame:
    """(row, type, value, gender) of the distinct entities of each text; row is a hash of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", 1 << 20):
            row, found = [], []
            for i, t in enumerate(batch.column(1)):
                own = sorted({x[2:] for x in detect(t.as_py())}) if t.is_valid else ()
                row += [i] * len(own)
                found += own
            columns = list(zip(*found, strict=True)) if found else [()] * 3
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row, pa.int64())), *(pa.array(c, pa.string()) for c in columns)], ["row", "type", "value", "gender"])

    return docs.select(F.xxhash64(text).alias("row"), F.col(text).alias("text")).mapInArrow(run, "row bigint, type string, value string, gender string")


def assigned(found: DataFrame, key: bytes) -> DataFrame:
    """(type, value, gender, settled, draw, surrogate) of every distinct entity, without collisions; `settled` tells that
    texts gave it several genders."""

    @F.arrow_udf("string")
    def drawn(kind: pa.Array, value: pa.Array, draw: pa.Array, gender: pa.Array) -> pa.Array:
        return pa.array([surrogate(key, k, v, d, g or "n") for k, v, d, g in zip(*(x.to_pylist() for x in (kind, value, draw, gender)), strict=True)], pa.string())

    new = drawn("type", "value", "draw", "gender")
    real = written(found.groupBy("type", "value").agg(F.min("gender").alias("gender"), (F.min("gender") < F.max("gender")).alias("settled")), "pii-entities")
    now = written(real.withColumn("draw", F.lit(0)).withColumn("surrogate", new), "pii-draw")
    for _ in range(DRAWS):
        taken = real.select("type", F.col("value").alias("surrogate"), F.lit(True).alias("is_real"))
        first = now.groupBy("type", "surrogate").agg(F.min(F.struct("draw", "value")).alias("first"), F.count("*").alias("n"))
        bad = first.join(taken, ["type", "surrogate"], "left").where("n > 1 or is_real")
        clash = now.join(bad, ["type", "surrogate"], "left")
        other = F.coalesce("is_real", F.lit(False)) & ((F.col("draw") < DISTINCT) | (F.col("surrogate") == F.col("value")))
        again = other | (F.col("n").isNotNull() & (F.col("first.value") != F.col("value")))
        moved = written(clash.where(again).select("type", "value", "gender", "settled", (F.col("draw") + 1).alias("draw")).withColumn("surrogate", new), "pii-moved")
        if moved.isEmpty():
            return now
        now = written(now.join(moved.select("type", "value"), ["type", "value"], "left_anti").unionByName(moved), "pii-draw")
    raise RuntimeError(f"surrogates still collide after {DRAWS} draws")


def pseudonymised(docs: DataFrame, key: bytes, text: str = "text", spans: str | None = None, bound: int = BROADCAST) -> DataFrame:
    """The rows with surrogates in the text; `spans` names a column for type, start and length of each."""
    found = written(entities(docs, text), "pii-found")
    odd = assigned(found, key).where("draw > 0 or settled").select("type", "value", "draw", "gender")
    few = odd.limit(bound + 1).collect()
    columns = docs.columns
    place = columns.index(text)
    kind = pa.list_(pa.struct([("type", pa.string()), ("start", pa.int32()), ("length", pa.int32())]))
    shared = {(r["type"], r["value"]): (r["draw"], r["gender"]) for r in few} if len(few) <= bound else None
    asked, given = docs, None
    if shared is None:
        given = next(n for n in ("odd" + "_" * i for i in range(len(columns) + 2)) if n not in columns and n + "row" not in columns)
        own = found.select("row", "type", "value").join(odd, ["type", "value"]).groupBy("row").agg(F.collect_set(F.struct("type", "value", "draw", "gender")).alias(given))
        asked = docs.withColumn(given + "row", F.xxhash64(text)).join(own.withColumnRenamed("row", given + "row"), given + "row", "left").select(*columns, given)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, text, 1 << 20):
            new, marks = [], []
            for i, t in enumerate(batch.column(place)):
                known = shared if shared is not None else {(x["type"], x["value"]): (x["draw"], x["gender"]) for x in batch.column(len(columns))[i].as_py() or ()}
                plain = t.as_py()
                changed, own = rewritten(plain, key, known) if plain else (plain, [])
                new.append(changed)
                marks.append([{"type": a, "start": b, "length": c} for a, b, c in own])
            arrays = [batch.column(i) for i in range(len(columns))]
            arrays[place] = pa.array(new, pa.string())
            if spans and spans in columns:
                arrays[columns.index(spans)] = pa.array(marks, kind)
            elif spans:
                arrays.append(pa.array(marks, kind))
            yield pa.RecordBatch.from_arrays(arrays, names=[f.name for f in schema])

    shape = ArrayType(StructType([StructField("type", StringType()), StructField("start", IntegerType()), StructField("length", IntegerType())]))
    fields = [StructField(f.name, StringType()) if f.name == text else StructField(f.name, shape) if f.name == spans else f for f in docs.schema]
    schema = StructType(fields + ([StructField(spans, shape)] if spans and spans not in columns else []))
    return asked.mapInArrow(run, schema)
