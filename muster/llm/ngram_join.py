"""N-gram Jaccard join by a MinHash LSH forest, with exact verification.

A document is its set of word n-grams (words between ASCII white space, unchanged; a text of fewer words is one n-gram,
a text without words has none and is like no other). Documents with equal sets form a class and go on as one.

The forest has TREES prefix tries. In each, a document is a path of DEPTH MinHash values, and a node is the documents
with the same first values. Nodes are counted from the FLOOR on, deeper ones only below crowded nodes. A document starts
with long prefixes: in each tree it stands in the first node of its path that has at most CROWD documents, else at full
depth. That gives its recall, the chance that a partner at the threshold shares one of these nodes. While it is below
the target, its prefixes are shortened: nodes may be four times as crowded, and so on, down to the floor at most. So
documents with few relatives meet them at the floor at once, and crowded prefixes are only shortened by documents that
can't reach the target elsewhere. Documents that stand in one node after equally many steps meet; since the node is
found from counts along the shared path alone, both partners stand in it.

The pairs of a bucket are never listed. A document has a hub, the smallest one that it meets; documents of one hub are
cut into blocks of bounded size; blocks that some bucket brings together are compared as a whole in one task, by matrix
products over the n-grams they share. So every pair of documents meets in one task at most, and a task returns a row per
document: how many documents it is linked with there, and the smallest one it is connected with. A hot bucket is many
block pairs, which many tasks share. Classes are the connected components of the links.

Null ids take no part in links: such rows are classes of their own (class_id null). Rows with the same id and text each
count as a document; so do rows with the same id and another text, which may be of different classes (both then show
the same class_id if that id is the smallest in both). Other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from muster.llm.common import chunks, mixed, utf8, words, written
from muster.llm.components import components

#: Words of an n-gram and least similarity.
WORDS, THRESHOLD = 5, 0.8
#: Trees of the forest, depth of its tries (four values a word of 64 bits), depth from which prefixes may be used, and the
#: recall at the threshold that ends the shortening.
TREES, DEPTH, FLOOR, RECALL = 24, 8, 4, 0.9999
#: Documents of a node at the first step; each step allows this many times more.
CROWD, FACTOR = 16, 4
#: Bounds of a block (documents and n-grams, twice the mean of a part); a document with LONG n-grams is a block itself.
BLOCK_DOCS, BLOCK_GRAMS, LONG = 512, 400_000, 50_000


def gram_sets(batch: pa.RecordBatch, text: str, n: int) -> list[np.ndarray]:
    """The sorted n-gram hashes of each row."""
    raw, bounds = utf8(batch.column(text))
    _, _, hashes, at = words(raw, bounds)
    rolled = hashes.copy()
    for k in range(1, n):
        rolled = mixed(rolled[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[k:]) if len(hashes) > k else rolled[:0]
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a >= n:
            out.append(np.unique(rolled[a : b - n + 1]))
        elif b > a:
            one = np.array([b - a], np.uint64)
            for i in range(a, b):
                one = mixed(one * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + 1] + np.uint64(1))
            out.append(one)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def functions(n: int) -> tuple[np.ndarray, np.ndarray]:
    """n hash functions of 64-bit words: x -> (x ^ a) * b, b odd."""
    base = mixed(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
    return base[:n], base[n:] | np.uint64(1)


def paths(grams: np.ndarray, trees: int) -> np.ndarray:
    """For each tree the path of DEPTH MinHash values, 16 bits each: the first four in one word, the others in the next."""
    a, b = functions(trees * DEPTH)
    least = np.full(trees * DEPTH, np.uint64(0xFFFFFFFFFFFFFFFF))
    for at in range(0, len(grams), 2048):
        np.minimum(least, ((grams[None, at : at + 2048] ^ a[:, None]) * b[:, None]).min(1), out=least)
    short = mixed(least) >> np.uint64(48)
    shift = np.array([48, 32, 16, 0], np.uint64)
    return (short.reshape(trees, 2, 4) << shift).sum(2, dtype=np.uint64)


def signed(docs: DataFrame, n: int, trees: int) -> DataFrame:
    """(key, tid, size, digest, upper, lower) of rows (key, tid, text): number of n-grams, digest of their set, and the
    upper and lower half of the path in each tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            size, digest, upper, lower = [], [], [], []
            for grams in gram_sets(batch, "text", n):
                size.append(len(grams))
                digest.append(hashlib.blake2b(grams.tobytes(), digest_size=16).digest() if len(grams) else None)
                path = paths(grams, trees).astype(np.int64) if len(grams) else None
                upper.append(None if path is None else path[:, 0])
                lower.append(None if path is None else path[:, 1])
            columns = [batch.column("key"), batch.column("tid"), pa.array(size, pa.int64()), pa.array(digest, pa.binary()), pa.array(upper, pa.list_(pa.int64())), pa.array(lower, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["key", "tid", "size", "digest", "upper", "lower"])

    return docs.select("key", "tid", "text").mapInArrow(run, "key bigint, tid bigint, size bigint, digest binary, upper array<bigint>, lower array<bigint>")


def standing(counts: dict[int, list[int]], trees: int, threshold: float, recall: float) -> list[list[tuple[int, int]]]:
    """For each step (tree, depth) of the nodes that a document stands in, from the counts along its paths (by tree, from
    the floor on; trees that aren't there have no other document at the floor)."""
    steps, crowd = [], CROWD
    while True:
        at = {t: next((d for d, n in enumerate(own, FLOOR) if n <= crowd), FLOOR + len(own) - 1) for t, own in counts.items()}
        missed = (1 - threshold**FLOOR) ** (trees - len(at))
        for d in at.values():
            missed *= 1 - threshold**d
        steps.append(sorted(at.items()))
        if 1 - missed >= recall or all(d == FLOOR for d in at.values()):
            return steps
        crowd *= FACTOR


#: Most trees that a threshold may need.
MOST_TREES = 256


def trees_for(threshold: float, recall: float, trees: int) -> int:
    """So many trees, or as many more as the recall at the threshold needs when all prefixes are as short as they get.

    A pair shares a prefix of FLOOR minima in a tree with a chance of threshold^FLOOR: 24 trees do for 0.8, 0.5 takes 143.
    A threshold that needs over MOST_TREES (under about 0.43) is an error, not a silent loss."""
    if not 0 < threshold <= 1 or not 0 <= recall < 1:
        raise ValueError("the threshold lies above 0 up to 1, the recall from 0 to below 1")
    missed = 1 - threshold**FLOOR
    need = math.ceil(math.log(1 - recall) / math.log(missed)) if 0 < missed < 1 else 1
    if need > MOST_TREES:
        raise ValueError(f"a threshold of {threshold} with a recall of {recall} takes {need} trees; at most {MOST_TREES} are built")
    return max(trees, need)


def met(sets: DataFrame, trees: int, threshold: float, recall: float) -> DataFrame:
    """(sid, bucket) of the nodes that sets (sid, upper, lower) stand in and may share."""
    member = sets.select("sid", F.posexplode(F.arrays_zip("upper", "lower")).alias("tree", "x")).select("sid", "tree", "x.upper", "x.lower")
    floor = written(member.groupBy("tree", "upper").agg(F.count("*").alias("n")).where("n > 1"), "floor")
    live = written(member.join(floor, ["tree", "upper"]), "live")
    depth = F.explode(F.array(*(F.lit(d) for d in range(FLOOR + 1, DEPTH + 1))))
    deep = live.where(F.col("n") > CROWD).select("sid", "tree", "upper", "lower", depth.alias("depth"))
    deep = deep.select("sid", "tree", "depth", F.xxhash64("tree", "depth", "upper", F.expr(f"shiftright(lower, 16 * ({DEPTH} - depth))")).alias("node"))
    below = written(deep.groupBy("node").agg(F.count("*").alias("n")), "below")
    top = live.select("sid", "tree", F.lit(FLOOR).alias("depth"), F.xxhash64("tree", F.lit(FLOOR), "upper").alias("node"), "n")
    nodes = top.unionByName(deep.join(below, "node").select(top.columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sid, bucket, step = [], [], []
            for key, path in zip(batch.column("sid").to_pylist(), batch.column("path").to_pylist(), strict=True):
                counts: dict[int, list[int]] = {}
                node = {}
                for x in sorted(path, key=lambda x: (x["tree"], x["depth"])):
                    counts.setdefault(x["tree"], []).append(x["n"])
                    node[x["tree"], x["depth"]] = x["node"]
                for i, own in enumerate(standing(counts, trees, threshold, recall)):
                    for t, d in own:
                        if counts[t][d - FLOOR] > 1:
                            sid.append(key)
                            bucket.append(node[t, d])
                            step.append(i)
            yield pa.RecordBatch.from_arrays([pa.array(sid, pa.int64()), pa.array(bucket, pa.int64()), pa.array(step, pa.int32())], ["sid", "node", "step"])

    stands = nodes.groupBy("sid").agg(F.collect_list(F.struct("tree", "depth", "n", "node")).alias("path")).mapInArrow(run, "sid bigint, node bigint, step int")
    return written(stands.select("sid", F.xxhash64("node", "step").alias("bucket")), "stands")


def linked(own: list[np.ndarray], other: list[np.ndarray] | None, threshold: float) -> np.ndarray:
    """Which pairs of the sets (of one list, or of two) are similar enough, by exact counts of common n-grams."""
    if not own or other == []:
        return np.zeros((len(own), len(own if other is None else other)), bool)
    both = own if other is None else own + other
    size = np.array([len(x) for x in both])
    who = np.repeat(np.arange(len(both)), size)
    _, column = np.unique(np.concatenate(both), return_inverse=True)
    often = np.bincount(column) > 1
    keep = often[column]  # n-grams that only one set holds add nothing to any intersection
    who, column = who[keep], (np.cumsum(often) - 1)[column[keep]]
    rows, cols = len(own), len(own) if other is None else len(other)
    common = np.zeros((rows, cols), np.float64)
    order = np.argsort(column, kind="stable")
    who, column = who[order], column[order]
    width = max(64, (4 << 20) // max(1, len(both)))
    for at in range(0, int(often.sum()), width):
        a, b = np.searchsorted(column, [at, at + width])
        m = np.zeros((len(both), min(width, int(often.sum()) - at)), np.float32)
        m[who[a:b], column[a:b] - at] = 1
        common += m[:rows] @ (m.T if other is None else m[rows:].T)
    union = size[:rows, None] + (size[None, :rows] if other is None else size[None, rows:]) - common
    found = common >= threshold * union - 1e-9
    if other is None:
        np.fill_diagonal(found, False)
    return found


def smallest(n: int, pairs: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each of n nodes the smallest id that it is connected with by the pairs."""
    label = ids.copy()
    while len(pairs):
        least = np.minimum(label[pairs[:, 0]], label[pairs[:, 1]])
        new = label.copy()
        np.minimum.at(new, pairs[:, 0], least)
        np.minimum.at(new, pairs[:, 1], least)
        if (new == label).all():
            break
        label = new
    return label


def classified(docs: DataFrame, key: str, text: str, n: int, threshold: float, trees: int, recall: float) -> tuple[DataFrame, DataFrame]:
    """Rows (key, tid, size, digest), and of each distinct set (digest, rep, tid, copies): its component and links."""
    trees = trees_for(threshold, recall, trees)
    base = docs.select(F.col(key).cast("bigint").alias("key"), F.xxhash64(text).alias("tid"), F.col(text).alias("text"))
    rows = written(signed(base, n, trees), "signatures")
    sets = rows.where("size > 0 and key is not null").groupBy("digest").agg(F.min(F.struct("key", "tid")).alias("first"), F.count("*").alias("copies"), F.min_by(F.struct("size", "upper", "lower"), F.struct("key", "tid")).alias("x"))
    sets = sets.select(F.col("first.key").alias("rep"), F.col("first.tid").alias("tid"), "copies", "digest", "x.*")
    sets = written(sets, "sets")
    # a set's number is its smallest id; further sets under that id have a hash for it
    own = sets.groupBy("rep").agg(F.min("digest").alias("own"))
    sets = sets.join(own, "rep").withColumn("sid", F.when(F.col("digest") == F.col("own"), F.col("rep")).otherwise(F.xxhash64("rep", "digest"))).drop("own")
    stands = met(sets.select("sid", "upper", "lower"), trees, threshold, recall)
    bucket = stands.groupBy("bucket").agg(F.count("*").alias("n"), F.min("sid").alias("hub")).where("n > 1").select("bucket", "hub")
    stands = written(stands.join(written(bucket, "hubs"), "bucket"), "buckets")
    slim = sets.select("sid", "rep", "tid", "copies", "digest", "size")
    home = stands.groupBy("sid").agg(F.min("hub").alias("hub")).join(slim.select("sid", "size"), "sid")
    home = home.withColumn("hub", F.when(F.col("size") < LONG, F.col("hub")))
    fill = home.groupBy("hub").agg(F.greatest(F.ceil(F.count("*") * 2 / BLOCK_DOCS), F.ceil(F.sum("size") * 2 / BLOCK_GRAMS)).alias("parts")).where("hub is not null")
    home = home.join(fill, "hub", "left").select("sid", F.when(F.col("hub").isNull(), F.xxhash64("sid", F.lit("long"))).otherwise(F.xxhash64("hub", F.pmod(F.xxhash64("sid"), "parts"))).alias("block"))
    home = written(home, "homes")
    meet = written(stands.select("sid", "bucket").join(home, "sid").select("bucket", "block").distinct(), "meet")
    pairs = meet.join(meet.withColumnRenamed("block", "other"), "bucket").where("block <= other").select("block", "other").distinct()
    pairs = written(pairs, "block-pairs")
    needed = base.where("key is not null").withColumnRenamed("key", "rep").join(slim.join(home, "sid").drop("size", "digest"), ["rep", "tid"])
    # a row for each block; a set, so that rows which are repeated are there once
    blocks = written(needed.groupBy("block").agg(F.collect_set(F.struct("sid", "copies", "text")).alias("docs")), "blocks")
    second = blocks.select(F.col("block").alias("second"), F.col("docs").alias("others"))
    both = pairs.withColumn("second", F.when(F.col("block") != F.col("other"), F.col("other"))).join(blocks, "block").join(second, "second", "left")

    def unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """Numbers, copies and n-gram sets of a block."""
        batch = pa.RecordBatch.from_arrays(column.flatten(), names=["sid", "copies", "text"])
        return *(batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("sid", "copies")), gram_sets(batch, "text", n)

    def verified(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        ids, copies, left = unpacked(group.column("docs").chunk(0).flatten())
        right = None
        if group.column("others").null_count:
            link = linked(left, None, threshold)
            links, pairs = link @ copies, np.argwhere(link)
        else:
            more, weight, right = unpacked(group.column("others").chunk(0).flatten())
            link = linked(left, right, threshold)
            links, pairs = np.concatenate([link @ weight, link.T @ copies]), np.argwhere(link) + [0, len(left)]
            ids = np.concatenate([ids, more])
        some = links > 0
        least = smallest(len(ids), pairs, ids)
        return pa.table({"sid": pa.array(ids[some], pa.int64()), "links": pa.array(links[some], pa.int64()), "least": pa.array(least[some], pa.int64())})

    links = written(both.select("block", "other", "docs", "others").groupBy("block", "other").applyInArrow(verified, "sid bigint, links bigint, least bigint"), "links")
    counted = links.groupBy("sid").agg(F.sum("links").alias("links"))
    parts = components(links, "sid", "least").select(F.col("node").alias("sid"), F.col("class_id").alias("part"))
    found = slim.join(counted, "sid", "left").join(parts, "sid", "left")
    found = found.select("digest", "rep", "tid", "copies", F.coalesce("part", "sid").alias("part"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    return rows, written(found, "classes")


def join(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = WORDS, threshold: float = THRESHOLD, trees: int = TREES, recall: float = RECALL) -> DataFrame:
    """(key, class_id, n_links) of every row: the smallest id of its class, and how many rows are similar enough to it."""
    rows, found = classified(docs, key, text, n, threshold, trees, recall)
    least = written(found.groupBy("part").agg(F.min("rep").alias("class_id")), "least")
    found = written(found.join(least, "part").select("digest", "class_id", "n_links"), "found")
    out = rows.select("key", F.when(F.col("key").isNotNull(), F.col("digest")).alias("digest")).join(found, "digest", "left")
    return out.select(F.col("key").alias(key), F.coalesce("class_id", "key").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"))


def kept(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = WORDS, threshold: float = THRESHOLD, trees: int = TREES, recall: float = RECALL) -> DataFrame:
    """One row of each class, that with the smallest id, with all columns as they were; of rows with this id and text one.

    Rows without an id or without words are in no class with others, and all stay."""
    rows, found = classified(docs, key, text, n, threshold, trees, recall)
    firsts = found.groupBy("part").agg(F.min(F.struct("rep", "tid")).alias("first")).select(F.col("first.rep").alias("key"), F.col("first.tid").alias("tid"))
    times = rows.where("size > 0 and key is not null").groupBy("key", "tid").agg(F.count("*").alias("times"))
    empty = rows.where("size = 0 and key is not null").select("key", "tid").distinct()
    stay = written(firsts.join(times, ["key", "tid"]).select("key", "tid", "times").unionByName(empty.withColumn("times", F.lit(0).cast("bigint"))), "stay")
    names = docs.columns
    own, tid, often = (next(c for c in (x + "_" * i for i in range(len(names) + 1)) if c not in names) for x in ("own", "tid", "times"))
    marked = docs.withColumn(own, F.col(key).cast("bigint")).withColumn(tid, F.xxhash64(text))
    some = marked.join(stay.select(F.col("key").alias(own), F.col("tid").alias(tid), F.col("times").alias(often)), [own, tid])
    out = some.where(F.col(often) < 2).select(names)
    if not stay.where("times > 1").isEmpty():
        out = out.union(some.where(F.col(often) > 1).dropDuplicates([own, tid]).select(names))
    return out.union(docs.where(F.col(key).isNull())) if docs.schema[key].nullable else out
