"""Connected components of a graph of integer ids, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from muster.llm.common import written

#: Rounds after which the search gives up with an error; it takes about the logarithm of the longest path.
ROUNDS = 60


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, class_id) of every node of an edge; class_id is the smallest id that the node is linked with.

    Each round is a join and an aggregation by node over at most as many rows as there are edges. Loops and repeated
    edges don't matter; nulls are left out; no edges give no rows."""
    now = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where((F.col(a) != F.col(b)) & F.col(a).isNotNull() & F.col(b).isNotNull()).distinct()
    now, before = written(now, "edges"), None
    for _ in range(ROUNDS):
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        small = joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b"))).distinct()
        now = written(small, "edges")
        size = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").bitwiseAND(F.lit((1 << 30) - 1)))).first())
        if size == before:
            roots = now.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("class_id"))
            return now.select(F.col("a").alias("node"), F.col("b").alias("class_id")).union(roots)
        before = size
    raise RuntimeError(f"the components didn't settle in {ROUNDS} rounds")
