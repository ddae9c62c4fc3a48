"""Mixing sources to target weights, by hierarchical budgeting over a domain, language and source tree.

A budget of tokens goes down the tree by weights. A node can take at most `epochs` times the tokens below it; what it
can't take goes to its siblings by their weights, and only what all siblings together can't take goes to the siblings
of their parent. So shortages are made up for as near as possible. Leaves then read their documents in epochs: each
epoch is a shuffle of the leaf, seeded by its number, and the leaf takes the first tokens of that sequence up to its
budget; the last document may be taken in part.

All of it is DataFrame functions. The shares are integers, so any engine gets the same. A leaf's running sum of tokens
is dealt over BINS ranges of the shuffle's hash, so a leaf that holds a third of all rows is no single task.

Null languages and sources are leaves of their own, named '' (as '' itself). Documents without tokens (null, empty or
blank texts) are never taken. Repeated rows count and are taken like any. A weight that isn't given is the default; a
weight of 0 gives nothing. Empty input gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from muster.llm.common import written

#: Ranges of the shuffle's hash: its first three hexadecimal digits.
BIN_DIGITS = 3
LEVELS = ("domain", "language", "origin")


def n_words(text: Column) -> Column:
    """Tokens of a text: its words between ASCII white space."""
    return F.coalesce(F.size(F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")), F.lit(0)).cast("bigint")


def shared(nodes: DataFrame, parent: list[str], child: str, budget: str) -> DataFrame:
    """Adds `share`: the parent's budget by the children's weight, none above its capacity (integers throughout)."""
    own = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    order = own.orderBy(F.when(F.col("weight") > 0, F.col("capacity") / F.col("weight")).asc_nulls_last(), child)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    ranked = (
        nodes.withColumn("cap_before", F.coalesce(F.sum("capacity").over(before), F.lit(0)))
        .withColumn("weight_left", F.sum("weight").over(own) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("filled", (F.col("weight") > 0) & (F.col("capacity") * F.col("weight_left") <= (F.col(budget) - F.col("cap_before")) * F.col("weight")))
        .withColumn("rest", F.col(budget) - F.coalesce(F.sum(F.when(F.col("filled"), F.col("capacity"))).over(own), F.lit(0)))
        .withColumn("rest_weight", F.sum(F.when(~F.col("filled"), F.col("weight")).otherwise(0)).over(own))
        .withColumn("part", F.when(F.col("filled"), F.col("capacity")).when(F.col("weight") > 0, F.expr("(rest * weight) div nullif(rest_weight, 0)")).otherwise(0))
        .withColumn("over", F.col("rest") - F.coalesce(F.sum(F.when(~F.col("filled"), F.col("part"))).over(own), F.lit(0)))
        .withColumn("place", F.row_number().over(own.orderBy(F.col("filled") | (F.col("weight") <= 0), child)))
    )
    one = ~F.col("filled") & (F.col("weight") > 0) & (F.col("place") <= F.col("over"))
    return ranked.withColumn("share", F.col("part") + one.cast("bigint")).drop("cap_before", "weight_left", "filled", "rest", "rest_weight", "part", "over", "place")


def weighted(column: str, weights: dict[str, int], default: int) -> Column:
    out = F.lit(default)
    for name, weight in weights.items():
        out = F.when(F.col(column) == name, F.lit(weight)).otherwise(out)
    return out.cast("bigint")


def budgets(leaves: DataFrame, weights: dict[str, dict[str, int]], default: int, epochs: int, budget: int | None) -> DataFrame:
    """(domain, language, origin, tokens, share) from the leaves' tokens; without a budget, as many tokens as there are."""
    base = leaves.withColumn("capacity", F.col("tokens") * epochs)
    levels: list[DataFrame] = []
    for depth in (1, 2, 3):
        keys = list(LEVELS[:depth])
        levels.append(base.groupBy(*keys).agg(F.sum("capacity").alias("capacity"), F.sum("tokens").alias("tokens")).withColumn("weight", weighted(keys[-1], weights.get(keys[-1], {}), default)))
    whole = F.lit(budget).cast("bigint") if budget is not None else F.sum("tokens").over(Window.partitionBy(F.lit(0)))
    top = levels[0].withColumn("budget", F.least(whole, F.sum("capacity").over(Window.partitionBy(F.lit(0)))))
    done = shared(top, [], "domain", "budget")
    for depth in (1, 2):
        above = list(LEVELS[:depth])
        down = levels[depth].join(done.select(*above, F.col("share").alias("budget")), above)
        done = shared(down, above, LEVELS[depth], "budget")
    return done.select(*LEVELS, "tokens", "share")


def mix(docs: DataFrame, domain: Column, weights: dict[str, dict[str, int]], default: int = 1, epochs: int = 4, budget: int | None = None, seed: str = "muster", carry: list[str] | None = None) -> DataFrame:
    """A row for each document and epoch that takes it: key columns of the leaf, epoch, tokens and taken (of them).

    docs needs doc_id, text, lang and source; `carry` names columns of docs that the result has too."""
    carry = carry or []
    marked = docs.select(
        F.col("doc_id").alias("__id"), n_words(F.col("text")).alias("__n"), domain.alias("domain"), F.coalesce("lang", F.lit("")).alias("language"), F.coalesce("source", F.lit("")).alias("origin"),
        F.struct(*carry, F.lit(0).alias("__")).alias("__row"),
    ).where("__n > 0")
    slim = written(marked.drop("__row"), "mix")
    leaves = slim.groupBy(*LEVELS).agg(F.sum("__n").alias("tokens"))
    plan = written(
        budgets(leaves, weights, default, epochs, budget)
        .where("share > 0")
        .select(*LEVELS, F.expr("share div tokens").alias("__whole"), F.expr("share % tokens").alias("__rest")),
        "mix-plan",
    )

    def shuffled(df: DataFrame) -> DataFrame:
        """The rows of leaves that get tokens, with their place in the shuffle of the epoch that is taken in part."""
        place = F.md5(F.concat_ws(":", F.lit(seed), F.col("__whole").cast("string"), F.coalesce(F.col("__id").cast("string"), F.lit(""))))
        return df.join(plan, list(LEVELS)).withColumn("__place", place).withColumn("__bin", F.substring("__place", 1, BIN_DIGITS))

    bins = shuffled(slim).groupBy(*LEVELS, "__bin").agg(F.sum("__n").alias("__sum"))
    start = Window.partitionBy(*LEVELS).orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.select(*LEVELS, "__bin", F.coalesce(F.sum("__sum").over(start), F.lit(0)).alias("__start"))
    inside = Window.partitionBy(*LEVELS, "__bin").orderBy("__place", "__id", "__n").rowsBetween(Window.unboundedPreceding, 0)
    full = shuffled(marked if carry else slim).join(bins, [*LEVELS, "__bin"])
    placed = full.withColumn("__before", F.col("__start") + F.sum("__n").over(inside) - F.col("__n"))
    last = F.greatest(F.lit(0), F.least(F.col("__n"), F.col("__rest") - F.col("__before")))
    rows = placed.withColumn("__last", last).withColumn("epoch", F.explode(F.filter(F.sequence(F.lit(0).cast("bigint"), F.col("__whole")), lambda e: (e < F.col("__whole")) | (F.col("__last") > 0))))
    taken = F.when(F.col("epoch") < F.col("__whole"), F.col("__n")).otherwise(F.col("__last"))
    kept = [F.col(f"__row.{c}").alias(c) for c in carry] if carry else [F.col("__id").alias("doc_id")]
    leaf = [] if carry else [F.col(c) for c in LEVELS]
    return rows.select(*kept, *leaf, *([] if carry else [F.col("epoch"), F.col("__n").alias("tokens"), taken.alias("taken")]))
