"""Audit of filters that are applied one after another: what each removes in every order, and its Shapley value.

A game is played per part: the worth of a coalition of filters is the number of rows that at least one of them rejects.
All orders follow from the worths of the 2^n coalitions, so each row is looked at once, not once an order:
- a step's removals are the worth of the filters up to it less that of the filters before it;
- the potential of Hart and Mas-Colell is built up from the empty coalition,
  P(S) = (worth(S) + sum of P(S without i) over i in S) / |S|, and a filter's Shapley value is P(all) - P(all without it).
  Times |S|! the potentials are integers, and n! times the Shapley value is what the filter removes over all orders.

Spark counts rows by part and by the set of filters that reject them (combined before the shuffle); a part's row then
holds the worths as an array, of which orders and steps are differences. Parts stay rows of a table, however many.

The duplicate filter rejects a row whose text some row with a smaller id holds, anywhere in the table. Texts are compared
by SHA-256; only digests that two ids share are joined back, from a table, so that adaptive execution splits a hot one.

Null texts are empty ones. A null id has no smaller one and is none; rows that share an id don't reject each other. A
null part is the empty string. Labels are joined by id; an id labelled twice is good or toxic if one label says so, null
labels say nothing. Repeated rows count as often as they occur. No rows give no rows. Of further columns none is read.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from muster.llm.common import written

#: White space between words, and signs that stand for damage.
SPACE, SIGNS = r"[\x20\x09-\x0D]+", r"[#$%&*|]"


def text_flags(docs: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """(key, part, digest, a, b, c, d): failures of the filters that look at one text: under 200 words (a), under half of
    the words distinct (b), over 2 % capitals (c), damaged (d)."""
    plain = docs.select(F.col(key).alias("key"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    split = plain.withColumn("words", F.array_remove(F.split("text", SPACE), ""))
    n, capitals = F.size("words"), F.length(F.regexp_replace("text", "[^A-Z]+", ""))
    return split.select(
        "key",
        "part",
        F.unhex(F.sha2("text", 256)).alias("digest"),
        (n < 200).alias("a"),
        (100 * F.size(F.array_distinct("words")).cast("bigint") < 50 * n.cast("bigint")).alias("b"),
        (100 * capitals.cast("bigint") > 2 * F.length("text").cast("bigint")).alias("c"),
        F.col("text").rlike(SIGNS).alias("d"),
    )


def with_copies(rows: DataFrame) -> DataFrame:
    """rows and e: whether a smaller key has the same digest."""
    shared = rows.where("key is not null").groupBy("digest").agg(F.min("key").alias("first"), F.max("key").alias("last")).where("first < last").select("digest", "first")
    return rows.join(written(shared, "shared"), "digest", "left").withColumn("e", F.coalesce(F.col("key") > F.col("first"), F.lit(False))).drop("first", "last")


def audit(rows: DataFrame, filters: Sequence[str], losses: Sequence[str], part: str = "part") -> DataFrame:
    """Of rows with booleans `filters` (rejected or not) and `losses` (what one would miss): part, filter_order, step, kept,
    removed, redundant, unique_fails, one count for each loss, and shapley; a row for each order and step."""
    n = len(filters)
    everyone = (1 << n) - 1
    rejecting = sum((F.col(f).cast("int") * (1 << i) for i, f in enumerate(filters)), F.lit(0))
    counted = rows.groupBy(F.col(part).alias("part"), rejecting.alias("rejecting"), *losses).agg(F.count("*").alias("n"))
    hit = F.col("rejecting").bitwiseAND(F.col("coalition")) != 0
    worth = lambda of: F.sum(F.when(hit & of, F.col("n")).otherwise(F.lit(0)))
    worths = counted.withColumn("coalition", F.explode(F.sequence(F.lit(0), F.lit(everyone)))).groupBy("part", "coalition")
    worths = worths.agg(worth(F.lit(True)).alias("worth"), F.sum("n").alias("rows"), *(worth(F.col(x)).alias(f"worth_{x}") for x in losses))
    listed = F.array_sort(F.collect_list(F.struct("coalition", "worth", *(f"worth_{x}" for x in losses))))  # one of each coalition
    games = worths.groupBy("part").agg(F.max("rows").alias("rows"), listed.alias("games"))
    games = games.select("part", "rows", F.col("games.worth").alias("worth"), *(F.col(f"games.worth_{x}").alias(f"worth_{x}") for x in losses))

    def potential(known: Column, s: Column) -> Column:
        """The potentials of the coalitions below s, with that of s: (|S| - 1)! worth(S) and those without one member."""
        without = (F.when(s.bitwiseAND(F.lit(1 << i)) != 0, F.element_at(known, s - (1 << i) + 1)).otherwise(F.lit(0)) for i in range(n))
        own = F.element_at("worth", s + 1) * F.factorial(F.bit_count(s) - 1) + sum(without, F.lit(0))
        return F.concat(known, F.array(own.cast("bigint")))

    potentials = F.aggregate(F.sequence(F.lit(1), F.lit(everyone)), F.array(F.lit(0).cast("bigint")), potential)
    grand = lambda p: F.array(*(p[everyone] - n * p[everyone & ~(1 << i)] for i in range(n)))
    games = games.withColumn("potentials", potentials).withColumn("shapley", grand(F.col("potentials"))).drop("potentials")

    steps = [
        {"filter_order": "".join(filters[i].upper() for i in order), "step": step + 1, "own": own, "before": sum(1 << i for i in order[:step])}
        for order in permutations(range(n))
        for step, own in enumerate(order)
    ]
    listed = F.from_json(F.lit(json.dumps(steps)), "array<struct<filter_order: string, step: int, own: int, before: int>>")
    every = games.withColumn("x", F.explode(listed)).select(*games.columns, "x.*")
    bit = F.element_at(F.array(*(F.lit(1 << i) for i in range(n))), F.col("own") + 1)
    at = lambda game, s: F.element_at(F.col(game), s + 1)
    after = F.col("before") + bit
    removed: Column = at("worth", after) - at("worth", F.col("before"))
    return every.select(
        "part",
        "filter_order",
        "step",
        (F.col("rows") - at("worth", after)).alias("kept"),
        removed.alias("removed"),
        (at("worth", bit) - removed).alias("redundant"),
        (at("worth", F.lit(everyone)) - at("worth", F.lit(everyone) - bit)).alias("unique_fails"),
        *((at(f"worth_{x}", after) - at(f"worth_{x}", F.col("before"))).alias(x) for x in losses),
        F.element_at("shapley", F.col("own") + 1).alias("shapley"),
    )


def audited(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The five filters a to e over the documents, by source; what is lost are good and toxic documents by their labels."""
    rows = written(text_flags(docs), "flags")
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("key")).agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("bad"))
    marked = with_copies(rows).join(known, "key", "left")
    lost = {"good_lost": F.coalesce("good", F.lit(False)), "toxic_lost": F.coalesce("bad", F.lit(False))}
    return audit(marked.select("part", "a", "b", "c", "d", "e", *(c.alias(x) for x, c in lost.items())), "abcde", list(lost))
