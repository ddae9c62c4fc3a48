"""SHA-256 over sequences that are longer than one row or one task's memory."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def streamed_sha256(df: DataFrame, groups: Sequence[str], order: Sequence[str | Column], content: Column) -> DataFrame:
    """Per group: its columns, n (rows), sha256 of the contents (text or bytes) one after another in their order.

    SHA-256 knows no parts, so a group's contents pass one task; they are sorted there, on disk if need be, and stream
    through the hash batch by batch. The task holds a hash and a batch, however long the group. Groups are spread over
    tasks. Null contents are empty ones; equal order columns leave the order open. No rows give no rows."""
    named = df.select(*groups, *(F.col(o).alias(f"__o{i}") if isinstance(o, str) else o.alias(f"__o{i}") for i, o in enumerate(order)), F.coalesce(content.cast("binary"), F.lit(b"")).alias("__content"))
    own = F.to_json(F.struct(*groups), {"ignoreNullFields": "false"}) if groups else F.lit("")
    rows = named.withColumn("__group", own).repartition("__group").sortWithinPartitions("__group", *(f"__o{i}" for i in range(len(order))))
    kinds = ", ".join(f"`{g}` {rows.schema[g].dataType.simpleString()}" for g in groups)
    keep = [*groups, "n", "sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, first, n, digest = None, None, 0, hashlib.sha256()

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*(first.column(g) for g in groups), pa.array([n], pa.int64()), pa.array([digest.hexdigest()], pa.string())], keep)

        for batch in batches:
            if not batch.num_rows:
                continue
            codes = batch.column("__group").dictionary_encode()
            index, names = codes.indices.to_numpy(zero_copy_only=False), codes.dictionary.to_pylist()
            column = batch.column("__content")
            content = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
            bounds = np.frombuffer(content.buffers()[1], np.int64)[content.offset : content.offset + len(content) + 1]
            data = memoryview(content.buffers()[2] or b"")
            cuts = [0, *(np.flatnonzero(index[1:] != index[:-1]) + 1).tolist(), len(index)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                name = names[index[a]]
                if name != last:
                    if last is not None:
                        yield done()
                    last, first, n, digest = name, batch.slice(a, 1), 0, hashlib.sha256()
                digest.update(data[int(bounds[a]) : int(bounds[b])])
                n += b - a
        if last is not None:
            yield done()

    return rows.select(*groups, "__group", "__content").mapInArrow(run, f"{kinds}{', ' if groups else ''}n bigint, sha256 string")


def parts_in_order(path: Column) -> list[Column]:
    """What puts the part files of one writer into the order in which it wrote them: by task, then by file of that task."""
    name = F.element_at(F.split(path, "/"), -1)
    number = lambda pattern: F.coalesce(F.nullif(F.regexp_extract(name, pattern, 1), F.lit("")).cast("bigint"), F.lit(0))
    return [number(r"^part-(\d+)-"), number(r"-c(\d+)\."), name]
