"""Exact top-k by integer inner product, with a pivot-distance index.

Largest inner products are nearest neighbours once every row gets one more component that brings all rows to the same
length (a query gets 0 there). In that space each row is keyed by its nearest pivot and its distance to it. Rows are
sorted by that key over the cluster and cut into annuli: blocks of at most BLOCK rows of one pivot and a range of
distances; BLOCKS blocks in a row are a shard. A query is at a known distance from the pivot, so by the triangle
inequality nothing in an annulus is nearer than the gap between that distance and the annulus.

First pass: each query's k-th best score in a bounded sample bounds its true k-th from below; with it follows the widest
gap that may hold a better score, and so, for each pivot, the range of distances in which a query still has to look. A
join by pivot and range sends it to the shards in that range, no others. Second pass: a task takes a shard and some
queries, goes through the annuli from the smallest gap of any of them on, and skips for a query those that can't hold a score as
good as its k-th best. Scores are integers, computed exactly; bounds have a margin for rounding, so nothing is lost.

Pivots are rows of the sample; they only steer the order of work. Blocks and groups of queries have bounded sizes; equal
vectors, however many, are spread over blocks by their id.

Null vectors and those with null or non-finite components take no part; zero vectors do, and shorter ones are filled up
with zeros. Components beyond 2^90 after scaling count as 2^90; rows are ranked by their exact scores, and scores beyond a
long are shown as its greatest or least value. Ties go to the smaller id. Of rows with one id, the best score counts, be they repeated or different vectors, asked or
found: an id is found once per query, and rows with the query's own id are never its neighbours. An empty table gives no
rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from muster.llm.common import written
from muster.llm.vectors import EXACT, lists, matrix, sample, usable, whole

#: Pivots and the sample they come from; rows of a block, blocks of a task, queries of a task.
PIVOTS, SAMPLE, BLOCK, BLOCKS, QUERIES = 64, 8192, 1024, 32, 1024
#: Scores are longs.
LONG = (1 << 63) - 1
#: A score in parts of 62 bits, highest first: products of components up to 2^90 are far below 2^248.
WIDE, DIGIT = ("w3", "w2", "w1", "w0"), (1 << 62) - 1


def pivots_of(x: np.ndarray, n: int) -> np.ndarray:
    """n rows far from each other: each is the row that is farthest from those before."""
    if not len(x):
        return x
    picked = [0]
    far = ((x - x[0]) ** 2).sum(1)
    while len(picked) < min(n, len(x)) and far.max() > 0:
        picked.append(int(far.argmax()))
        far = np.minimum(far, ((x - x[picked[-1]]) ** 2).sum(1))
    return x[picked]


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of integers (held as doubles), exact; as Python integers where doubles can't hold them."""
    if np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * q.shape[1] < EXACT:
        return q @ x.T
    exact = lambda m: np.array([[int(v) for v in r] for r in m], object).reshape(m.shape)
    return exact(q).dot(exact(x).T)


def top(scores: np.ndarray, ids: np.ndarray, k: int, own: int) -> list[tuple[int, int]]:
    """Score and id of the k best ids but the own one, ties to the smaller id; an id has its best score."""
    at = np.flatnonzero(ids != own)
    if len(at) > 4 * k and scores.dtype != object:
        more = k
        while True:  # repeated ids may need further rows
            bound = np.partition(scores[at], len(at) - more)[len(at) - more]
            some = at[scores[at] >= bound]
            if more == len(at) or len(np.unique(ids[some])) >= k:
                at = some
                break
            more = min(len(at), 4 * more)
    best: dict[int, int] = {}
    for i in sorted(at.tolist(), key=lambda i: (-scores[i], ids[i])):
        best.setdefault(int(ids[i]), int(scores[i]))
        if len(best) == k:
            break
    return [(score, i) for i, score in best.items()]


def search(df: DataFrame, queries: Column, scale: int = 256, key: str = "vec_id", vector: str = "embedding", k: int = 5) -> DataFrame:
    """(query_id, rank, key, score) of each row that `queries`, a condition on `key`, marks; score is the inner product
    of the vectors with each component x taken as floor(scale * x)."""
    spark = df.sparkSession
    rows = usable(df, key, vector, True).select("key", F.transform("vector", lambda v: whole(v, scale)).alias("vector"))
    rows = written(rows.withColumn("square", F.aggregate("vector", F.lit(0.0), lambda a, v: a + v * v)), "vectors")
    most = rows.agg(F.max("square")).first()[0]
    if most is None:
        return spark.createDataFrame([], f"query_id bigint, rank int, {key} bigint, score bigint")
    known, some = sample(rows, SAMPLE)
    lifted = lambda x: np.append(x, np.sqrt(np.maximum(0, most - (x * x).sum(1)))[:, None], 1)
    pivots = pivots_of(lifted(some), PIVOTS)
    margin = 1e-6 * (1 + most)

    def distances(x: np.ndarray) -> np.ndarray:
        """To each pivot."""
        return np.sqrt(np.maximum(0, (x * x).sum(1)[:, None] + (pivots * pivots).sum(1)[None] - 2 * x @ pivots.T))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                d = distances(lifted(matrix(batch.column("vector"))))
                near = d.argmin(1)
                yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("vector"), pa.array(near.astype(np.int32)), pa.array(d[np.arange(len(d)), near])], ["key", "vector", "pivot", "distance"])

    def blocked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            t = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            d = t.column("distance").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [pa.array([(TaskContext.get().partitionId() << 32) + shard]), t.column("pivot")[:1], pa.array([d.min()]), pa.array([d.max()]), pa.array([len(d)], pa.int32()), pa.array([t.column("key").to_numpy().tobytes()], pa.binary()), pa.array([matrix(t.column("vector")).tobytes()], pa.binary())],
                ["shard", "pivot", "low", "high", "rows", "ids", "data"],
            )

        held: list[pa.RecordBatch] = []
        shard, blocks = 0, 0
        for batch in batches:
            pivot = batch.column("pivot").to_numpy()
            at = 0
            while at < batch.num_rows:
                other = held and held[0].column("pivot")[0].as_py() != pivot[at]
                if other or sum(h.num_rows for h in held) >= BLOCK:
                    yield from row(held)
                    held, blocks = [], blocks + 1
                    if other or blocks == BLOCKS:
                        shard, blocks = shard + 1, 0
                room = BLOCK - sum(h.num_rows for h in held)
                same = int(np.searchsorted(pivot[at : at + room] != pivot[at], True))
                held.append(batch.slice(at, max(1, same)))
                at += max(1, same)
        if held:
            yield from row(held)

    sorted_rows = rows.select("key", "vector").mapInArrow(keyed, "key bigint, vector array<double>, pivot int, distance double").repartitionByRange("pivot", "distance", "key").sortWithinPartitions("pivot", "distance", "key")
    blocks = written(sorted_rows.mapInArrow(blocked, "shard bigint, pivot int, low double, high double, rows int, ids binary, data binary"), "annuli")
    asked = rows.select(F.col("key").alias(key), F.col("vector").alias("__vector")).where(queries).select(F.col(key).alias("query"), F.col("__vector").alias("asked"))

    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                q = matrix(part.column("asked"))
                kth = np.full(len(q), -np.inf)
                for i, (own, s) in enumerate(zip(part.column("query").to_pylist(), products(q, some), strict=True)):
                    best = top(s, known, k, own)
                    if len(best) == k:
                        kth[i] = best[-1][0]
                far = distances(np.append(q, np.zeros((len(q), 1)), 1))
                gap = np.sqrt(np.maximum(0, (q * q).sum(1) + most - 2 * (kth - margin)))[:, None]  # wider ones hold lower scores only
                yield pa.RecordBatch.from_arrays([part.column("query"), part.column("asked"), pa.array(kth), lists(far - gap), lists(far + gap)], ["query", "asked", "kth", "near", "far"])

    uid = F.xxhash64("query", "asked")
    asked = written(asked.mapInArrow(bounded, "query bigint, asked array<double>, kth double, near array<double>, far array<double>").withColumn("uid", uid).dropDuplicates(["uid"]), "asked")
    ranges = asked.select("uid", F.posexplode(F.arrays_zip("near", "far")).alias("pivot", "x")).select("uid", "pivot", "x.near", "x.far")
    shards = blocks.groupBy("shard", "pivot").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    sent = written(ranges.join(shards, "pivot").where("low <= far and high >= near").select("uid", "shard"), "sent")
    crowds = sent.groupBy("shard").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("crowds"))
    data = blocks.join(crowds, "shard").withColumn("crowd", F.explode(F.sequence(F.lit(0), F.col("crowds") - 1))).drop("crowds")
    crowd = sent.join(crowds, "shard").join(asked.select("uid", "query", "asked", "kth"), "uid")
    crowd = crowd.select(F.col("shard").alias("of_shard"), F.pmod(F.col("uid"), "crowds").cast("int").alias("of_crowd"), "query", "asked", "kth")

    def scanned(group: pa.Table, asking: pa.Table) -> pa.Table:
        none = pa.table({name: pa.array([], pa.int64()) for name in ("query", "found", *WIDE, "score")})
        if not group.num_rows or not asking.num_rows:
            return none
        who = asking.column("query").to_numpy()
        q = matrix(asking.column("asked").combine_chunks())
        far = distances(np.append(q, np.zeros((len(q), 1)), 1))
        square = (q * q).sum(1)
        pivot, low, high = (group.column(c).to_numpy() for c in ("pivot", "low", "high"))
        gap = np.maximum(0, np.maximum(low[None] - far[:, pivot], far[:, pivot] - high[None]))
        best = (square[:, None] + most - gap * gap) / 2 + margin  # no score in the annulus is above
        order = np.argsort(gap.min(0), kind="stable")
        kth = asking.column("kth").to_numpy().copy()
        tops: list[list[tuple[int, int]]] = [[] for _ in who]
        for b in order:
            ask = np.flatnonzero(best[:, b] >= kth)
            if not len(ask):
                continue
            ids = np.frombuffer(group.column("ids")[b].as_py(), np.int64)
            x = np.frombuffer(group.column("data")[b].as_py(), np.float64).reshape(len(ids), -1)
            scores = products(q[ask], x)
            for i, s in zip(ask.tolist(), scores, strict=True):
                own = {found: score for score, found in tops[i]}
                for score, found in top(s, ids, k, who[i]):
                    own[found] = max(score, own.get(found, score))
                tops[i] = sorted(((score, found) for found, score in own.items()), key=lambda x: (-x[0], x[1]))[:k]
                if len(tops[i]) == k:
                    kth[i] = max(kth[i], tops[i][-1][0])
        out = [(int(w), found, score) for w, t in zip(who, tops, strict=True) for score, found in t]
        if not out:
            return none
        a, b, c = zip(*out, strict=True)
        parts = [[score >> 186, score >> 124 & DIGIT, score >> 62 & DIGIT, score & DIGIT] for score in c]  # in order as the scores, however wide
        columns = [a, b, *zip(*parts, strict=True), [min(max(score, -LONG - 1), LONG) for score in c]]
        return pa.table({name: pa.array(column, pa.int64()) for name, column in zip(("query", "found", *WIDE, "score"), columns, strict=True)})

    found = data.groupBy("shard", "crowd").cogroup(crowd.groupBy("of_shard", "of_crowd")).applyInArrow(scanned, ", ".join(f"{name} bigint" for name in ("query", "found", *WIDE, "score")))
    found = found.groupBy("query", "found").agg(F.max(F.struct(*WIDE, "score")).alias("s"))
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("s"), "found"))
    found = found.withColumn("score", F.col("s.score"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select(F.col("query").alias("query_id"), "rank", F.col("found").alias(key), "score")
