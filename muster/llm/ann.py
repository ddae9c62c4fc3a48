"""Approximate nearest neighbours by cosine: an inverted file of coarse centroids with product-quantised residuals.

Fitting: coarse centroids and the residuals' codebooks are trained by k-means on a bounded sample (SAMPLE rows) of the
unit vectors. Indexing: every row is put into its nearest centroid's list, with the codes of its residual. Searching:
a query goes to the lists of its PROBES nearest centroids, or more until they hold enough rows. A list is cut into
parts of about PART rows, and the queries of a list into parts of about QUERIES, so a list that holds a third of all
rows is many tasks. In a part, distances to all rows come from tables by code (asymmetric: the query is not
quantised); the RERANKED best, ties to the smaller id, are ranked anew by exact cosine in double precision.

Null, zero and non-finite vectors take no part; shorter ones are filled up with zeros. Equal vectors tie, and ties go to
the smaller id. Of rows with one id, the best score counts, be they repeated or different vectors, asked or found: an id is
found once per query, and rows with the query's own id are never its neighbours. An empty table gives no rows.

How many lists a query needs is a matter of the vectors. Those of the test tables have hardly any clusters (a cosine of
0.5 is near there), and 5 % of the lists hold 0.4 of the true neighbours, 35 % hold 0.9; so SHARE is 0.35.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from muster.llm.common import written
from muster.llm.vectors import lists, matrix, sample, usable

#: Rows that the index is fitted on; every row is indexed.
SAMPLE = 16_384
#: Least and most coarse centroids, dimensions of a code, codes of a codebook.
FEWEST, MOST, WIDTH, CODES = 1, 1024, 4, 256
#: Queries whose lists are looked for at a time.
ASKED = 256
#: Lists that a query is sent to (as a share of all, and at least), rows and queries of a part, rows reranked exactly.
SHARE, PROBES, PART, QUERIES, RERANKED = 0.35, 16, 4096, 1024, 100


def kmeans(x: np.ndarray, k: int, rounds: int = 8, seed: int = 7) -> np.ndarray:
    """k centroids; an empty one is put on the row that is farthest from its own."""
    rng = np.random.default_rng(seed)
    centroids = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near, far = nearest(x, centroids)
        size = np.bincount(near, minlength=len(centroids))
        total = np.zeros_like(centroids)
        np.add.at(total, near, x)
        full = size > 0
        centroids[full] = total[full] / size[full, None]
        if (~full).any():
            centroids[~full] = x[np.argsort(-far, kind="stable")[: int((~full).sum())]]
    return centroids


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each row the nearest centroid and the squared distance."""
    out, far = np.zeros(len(x), np.int64), np.zeros(len(x))
    own = (centroids * centroids).sum(1)
    for at in range(0, len(x), 4096):
        part = x[at : at + 4096]
        d = own[None] - 2 * part @ centroids.T
        out[at : at + 4096] = d.argmin(1)
        far[at : at + 4096] = d.min(1) + (part * part).sum(1)
    return out, far


@dataclass
class Index:
    """Centroids, codebooks by group of dimensions, and how many dimensions are padding."""

    centroids: np.ndarray
    books: list[np.ndarray]

    def parts(self, x: np.ndarray) -> list[np.ndarray]:
        pad = -x.shape[1] % WIDTH
        x = np.pad(x, ((0, 0), (0, pad)))
        return [x[:, i : i + WIDTH] for i in range(0, x.shape[1], WIDTH)]

    def codes(self, residual: np.ndarray) -> np.ndarray:
        return np.stack([nearest(p, b)[0] for p, b in zip(self.parts(residual), self.books, strict=True)], 1).astype(np.uint8)

    def tables(self, residual: np.ndarray) -> np.ndarray:
        """Squared distance of each row's part to each code, by row, group and code."""
        return np.stack([((p[:, None, :] - b[None]) ** 2).sum(2) for p, b in zip(self.parts(residual), self.books, strict=True)], 1)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled by the largest component first, so that huge and tiny ones don't overflow."""
    x = x / np.abs(x).max(1, keepdims=True) if len(x) else x
    return x / np.sqrt((x * x).sum(1, keepdims=True)) if len(x) else x


def fitted(rows: DataFrame, count: int) -> Index:
    x = unit(sample(rows, SAMPLE)[1])
    k = int(np.clip(round(np.sqrt(count) / 2), FEWEST, min(MOST, len(x))))
    index = Index(kmeans(x, k), [])
    residual = x - index.centroids[nearest(x, index.centroids)[0]]
    index.books = [kmeans(p, CODES, 6) for p in index.parts(residual)]
    return index


def cosines(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Cosine of each row with q in double precision, each by the same order of sums."""
    return (x * q).sum(1) / (np.sqrt((x * x).sum(1)) * np.sqrt((q * q).sum()))


def search(df: DataFrame, queries: Column, key: str = "vec_id", vector: str = "embedding", k: int = 5) -> DataFrame:
    """(query_id, rank, key, score) of the k nearest found of each row that `queries`, a condition on `key`, marks."""
    rows = usable(df, key, vector, False)
    count = rows.count()
    if not count:
        return df.sparkSession.createDataFrame([], f"query_id bigint, rank int, {key} bigint, score double")
    index = fitted(rows, count)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = unit(matrix(batch.column("vector")))
                near, _ = nearest(x, index.centroids)
                codes = index.codes(x - index.centroids[near])
                yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("vector"), pa.array(near.astype(np.int32)), pa.array([c.tobytes() for c in codes], pa.binary())], ["key", "vector", "list", "codes"])

    table = written(rows.mapInArrow(placed, "key bigint, vector array<double>, list int, codes binary"), "ivf")
    sizes = np.zeros(len(index.centroids), np.int64)
    for r in table.groupBy("list").count().collect():
        sizes[r["list"]] = r["count"]
    probes = max(PROBES, round(SHARE * len(sizes)))

    def probed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, ASKED) for b in batches for i in range(0, b.num_rows, ASKED)):
            x = unit(matrix(batch.column("vector")))
            order = np.argsort(((index.centroids**2).sum(1)[None] - 2 * x @ index.centroids.T), 1, kind="stable")
            own, at = [], []
            for i, o in enumerate(order):
                full = o[sizes[o] > 0]
                need = int(np.searchsorted(np.cumsum(sizes[full]), k + 1)) + 1
                at.append(full[: max(probes, need)])
                own.append(np.full(len(at[-1]), i))
            yield pa.RecordBatch.from_arrays([batch.column("uid").take(pa.array(np.concatenate(own))), pa.array(np.concatenate(at).astype(np.int32))], ["uid", "list"])

    asked = table.select(F.col("key").alias(key), F.col("vector").alias("__vector")).where(queries).select(F.col(key).alias("query"), F.col("__vector").alias("vector"))
    asked = written(asked.withColumn("uid", F.xxhash64("query", "vector")).dropDuplicates(["uid"]), "ivf-asked")
    sent = written(asked.select("uid", "vector").mapInArrow(probed, "uid bigint, list int"), "ivf-queries")
    asks = np.zeros(len(sizes), np.int64)
    for r in sent.groupBy("list").count().collect():
        asks[r["list"]] = r["count"]
    cuts = table.sparkSession.createDataFrame([(i, max(1, -(-int(n) // PART)), max(1, -(-int(a) // QUERIES))) for i, (n, a) in enumerate(zip(sizes, asks, strict=True)) if n and a], "list int, parts int, crowds int")
    cuts = F.broadcast(cuts)  # a row for each centroid: at most MOST
    data = table.join(cuts, "list").withColumn("part", F.pmod(F.xxhash64("key"), "parts").cast("int")).withColumn("crowd", F.explode(F.sequence(F.lit(0), F.col("crowds") - 1)))
    data = data.select("list", "part", "crowd", "key", "vector", "codes")
    crowd = sent.join(cuts, "list").withColumn("crowd", F.pmod(F.xxhash64("uid"), "crowds").cast("int")).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    crowd = crowd.join(asked, "uid").select(F.col("list").alias("of_list"), F.col("part").alias("of_part"), F.col("crowd").alias("of_crowd"), "query", F.col("vector").alias("asked"))

    def scanned(group: pa.Table, asking: pa.Table) -> pa.Table:
        out: list[tuple] = []
        none = pa.table({"query": pa.array([], pa.int64()), "found": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        if not group.num_rows or not asking.num_rows:
            return none
        group = group.sort_by("key")
        ids = group.column("key").to_numpy()
        unique = bool((ids[1:] != ids[:-1]).all())
        x = matrix(group.column("vector").combine_chunks())
        codes = np.frombuffer(b"".join(group.column("codes").to_pylist()), np.uint8).reshape(len(ids), -1).astype(np.int64)
        own = index.centroids[group.column("list")[0].as_py()]
        q = matrix(asking.column("asked").combine_chunks())
        tables = index.tables(unit(q) - own)
        flat = codes + np.arange(codes.shape[1]) * tables.shape[2] if len(index.books[0]) == tables.shape[2] else codes
        for query, vector, t in zip(asking.column("query").to_pylist(), q, tables, strict=True):
            d = t.reshape(-1)[flat].sum(1)
            d[ids == query] = np.inf
            if len(d) > RERANKED and unique:
                bound = np.partition(d, RERANKED - 1)[RERANKED - 1]
                best = np.flatnonzero(d <= bound)  # in order of ids
                best = best[np.argsort(d[best], kind="stable")[:RERANKED]]
            else:
                best = np.argsort(d, kind="stable")
                best = best[np.sort(np.unique(ids[best], return_index=True)[1])[:RERANKED]]
            best = best[np.isfinite(d[best])]
            scores = cosines(x[best], vector)
            top = np.lexsort((ids[best], -scores))[:k]
            out += [(query, int(ids[best[i]]), float(scores[i])) for i in top]
        if not out:
            return none
        a, b, c = zip(*out, strict=True)
        return pa.table({"query": pa.array(a, pa.int64()), "found": pa.array(b, pa.int64()), "score": pa.array(c, pa.float64())})

    found = data.groupBy("list", "part", "crowd").cogroup(crowd.groupBy("of_list", "of_part", "of_crowd")).applyInArrow(scanned, "query bigint, found bigint, score double")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "found"))
    found = found.groupBy("query", "found").agg(F.max("score").alias("score"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select(F.col("query").alias("query_id"), "rank", F.col("found").alias(key), "score")
