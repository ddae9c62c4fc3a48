"""Reading list files byte by byte as they are, and the small inputs beside them."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from muster.contracts import ATTEMPT_KEYS, ATTEMPTS, CLASSIFICATIONS, ELIGIBILITY, HEADERS, LANDED, POINTERS, RELEASE, REVISIONS
from muster.functions.digests import parts_in_order
from muster.functions.shared import written

#: What code page 1252 defines for the bytes 0x80 to 0x9F; the five that it leaves open stay as they are.
_BYTES = [b for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)]
_FROM = "".join(map(chr, _BYTES))
_TO = bytes(_BYTES).decode("cp1252")
UNDEFINED = "[\u0081\u008d\u008f\u0090\u009d�]"


def cp1252(raw: Column) -> Column:
    """Bytes as text; undefined bytes stay control characters, which validation looks for."""
    return F.translate(F.decode(raw.cast("binary"), "ISO-8859-1"), _FROM, _TO)


def encoded(text: Column) -> Column:
    """What cp1252() reads back as the text; a letter outside the code page fails."""
    return F.encode(F.translate(text, _TO, _FROM), "ISO-8859-1").cast("string")


def written_lists(rows: DataFrame, header: str, path: str) -> None:
    """Lists (file, place, line) as a folder of text parts each, the header first, in order of place.

    Ranges of places are dealt out, so that a long list is written by many tasks; a list's parts are in order of their names."""
    named = rows.select(F.coalesce("file", F.lit("")).alias("file"), F.lit(1).alias("below"), F.col("place").cast("bigint").alias("place"), "line")
    heads = named.select("file").distinct().select("file", F.lit(0).alias("below"), F.lit(None).cast("bigint").alias("place"), F.lit(header).alias("line"))
    order = ("file", "below", "place", "line")
    listed = heads.union(named).repartitionByRange(*order).sortWithinPartitions(*order)
    listed.select("file", encoded(F.col("line")).alias("value")).write.partitionBy("file").text(path)


def part_lines(spark: SparkSession, path: str) -> DataFrame:
    """(source_list, line_no, text) of lists that written_lists() wrote; lines are numbered through all parts of a list."""
    return _numbered(spark.read.schema("value string, file string").text(path), F.col("file"), F.col("file"))


def list_lines(spark: SparkSession, path: str) -> DataFrame:
    """(source_list, line_no, text) of every physical line of the files below a path, blank ones too.

    Files are split into blocks by Spark; a line's number is the count of lines in the file's earlier blocks (a small
    table with a row per block) and its place in its own block, so no task holds a whole file."""
    path_of = F.col("_metadata.file_path")
    return _numbered(spark.read.text(path), F.regexp_replace(F.element_at(F.split(path_of, "/"), -1), r"\.csv$", ""), path_of)


def _numbered(texts: DataFrame, name: Column, whole: Column) -> DataFrame:
    """`whole` tells which files are numbered through, in order of their paths. The files are read once: each task counts the
    lines of its blocks as they come, and these lines are written, so that what sums up the blocks before and what numbers
    the lines start from the same rows."""
    kind = "source_list string, whole string, file string, block bigint, place bigint, text string"
    names = [k.split()[0] for k in kind.split(", ")]

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, seen = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            file, block = batch.column("file").dictionary_encode(), batch.column("block").to_numpy()
            index, paths = file.indices.to_numpy(), file.dictionary.to_pylist()
            change = np.flatnonzero((index[1:] != index[:-1]) | (block[1:] != block[:-1])) + 1
            place = np.empty(len(index), np.int64)
            for i, j in zip([0, *change.tolist()], [*change.tolist(), len(index)], strict=True):
                if (paths[index[i]], block[i]) != own:
                    own, seen = (paths[index[i]], block[i]), 0
                place[i:j] = np.arange(seen, seen + j - i)
                seen += j - i
            columns = [batch.column(n) if n != "place" else pa.array(place) for n in names]
            yield pa.RecordBatch.from_arrays(columns, names)

    meta = {"source_list": name, "whole": whole, "file": F.col("_metadata.file_path"), "block": F.col("_metadata.file_block_start"), "text": cp1252(F.col("value"))}
    lines = written(texts.select(*(c.alias(n) for n, c in meta.items())).mapInArrow(counted, kind), "lines")
    order = Window.partitionBy("whole").orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = lines.groupBy("whole", "file", "block").agg(F.count("*").alias("n"))
    blocks = blocks.select("file", "block", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("before"))
    return lines.join(blocks, ["file", "block"]).select("source_list", (F.col("before") + F.col("place") + 1).alias("line_no"), "text")


def fields(lines: DataFrame) -> DataFrame:
    """Lines with their fields: cut at every comma, quotes are data."""
    return lines.withColumn("fields", F.split("text", ",", -1))


def records(lines: DataFrame, headers: Sequence[str] = HEADERS) -> DataFrame:
    """Landed records: nonblank lines below the header. Lines with another number of fields are validation's concern."""
    rows = fields(lines).where((F.col("line_no") > 1) & (F.col("text") != ""))
    return rows.select(*(F.try_element_at("fields", F.lit(i + 1)).alias(h) for i, h in enumerate(headers)), "source_list", F.col("line_no").alias("source_line_no"))


def landed_schema(spark: SparkSession, path: str) -> None:
    """Fails unless the footers of all files of a landed table agree with its schema (a distributed read of the footers)."""
    merged = spark.read.option("mergeSchema", "true").parquet(path).drop(*RELEASE).schema
    wrong = [f.name for f in merged if f.name not in LANDED.names or f.dataType != LANDED[f.name].dataType] + [n for n in LANDED.names if n not in merged.names]
    if wrong:
        raise ValueError(f"a landed table has other columns: {', '.join(sorted(wrong))}")


def read_landed(spark: SparkSession, path: str, catalogue: DataFrame) -> DataFrame:
    """Records of the catalogue's releases (date, revision, fingerprint) from one landed table, in one scan however many
    they are: the catalogue's partitions are read, others are pruned. An empty catalogue gives no rows."""
    landed_schema(spark, path)
    parts = [T.StructField("as_of_date", T.StringType()), T.StructField("release_revision", T.LongType())]
    rows = spark.read.schema(T.StructType([*LANDED.fields, *parts])).parquet(path)
    ids = catalogue.select(*RELEASE).where(F.col("as_of_date").isNotNull() & F.col("release_revision").isNotNull())
    return rows.join(ids, list(RELEASE[:2])).select(*(F.col(f"`{f.name}`") for f in LANDED), *RELEASE)


def union_lists(lists: Sequence[DataFrame]) -> DataFrame:
    """All rows of the lists by position; nothing is cast and nothing dropped."""
    out = lists[0]
    for df in lists[1:]:
        out = out.union(df)
    return out


def read_revisions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(REVISIONS).parquet(path)


def read_pointers(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(POINTERS).parquet(path)


def attempts(documents: DataFrame, text: str = "value") -> DataFrame:
    """Attempt documents in three closed forms as rows of one form. A document of no form fails the read."""
    fields_of = {f.name: f.dataType.simpleString() for f in ATTEMPTS} | {"status": "string"}
    keys = F.array_sort(F.json_object_keys(text))
    form = F.lit(None).cast("string")
    for name, own in ATTEMPT_KEYS.items():
        version = 2 if name == "v2" else 1
        same = (keys == F.array(*map(F.lit, sorted(own)))) & (F.get_json_object(text, "$.schema_version") == str(version))
        form = F.when(same, name).otherwise(form)
    names = sorted({k for own in ATTEMPT_KEYS.values() for k in own})
    parsed = F.from_json(text, T.StructType.fromDDL(", ".join(f"{n} {fields_of[n]}" for n in names)))
    checked = documents.select(parsed.alias("d"), F.coalesce(form, F.raise_error(F.lit("an attempt document has none of the closed forms")).cast("string")).alias("attempt_shape"))
    source = {"raw_status": "d.status", "attempt_shape": "attempt_shape"}
    return checked.select(*(F.col(source.get(f.name, f"d.{f.name}")).cast(f.dataType).alias(f.name) for f in ATTEMPTS))


def read_attempts(spark: SparkSession, path: str) -> DataFrame:
    return attempts(spark.read.text(path, wholetext=True))


def read_classifications(spark: SparkSession, path: str | None, required: bool = False) -> DataFrame:
    """Sidecar of eligibility classes. Repeated, blank or padded keys and unknown classes are errors."""
    if path is None:
        if required:
            raise FileNotFoundError("classifications are required")
        return spark.createDataFrame([], CLASSIFICATIONS)
    rows = spark.read.schema(CLASSIFICATIONS).json(path)
    faults = classification_faults(rows).limit(1).collect()
    if faults:
        raise ValueError(f"classifications: {faults[0][0]}")
    return rows


def classification_faults(rows: DataFrame) -> DataFrame:
    key = F.col("registration_number")
    known = F.coalesce(F.col("classification").isin(*ELIGIBILITY), F.lit(False))
    reason = F.when(key.isNull() | (F.trim(key) == ""), "blank_key").when(F.trim(key) != key, "untrimmed_key").when(~known, "unknown_class")
    repeated = rows.groupBy(key).count().where("count > 1").select(F.lit("duplicate_key").alias("failure_reason"))
    return rows.select(reason.alias("failure_reason")).where(F.col("failure_reason").isNotNull()).union(repeated)


#: Rows of a row group of a landed table.
GROUP_ROWS = 122_880


def landed_table(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Landed records with their release's identity as Zstandard Parquet, partitioned by release, in order of lines, in row
    groups of GROUP_ROWS. Ranges of lines are dealt out, so that a list of any size is written by many tasks."""
    order = (*RELEASE[:2], "source_list", "source_line_no")
    written_landed(df.repartitionByRange(*order).sortWithinPartitions(*order), path, mode)


def written_landed(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """As landed_table(), but in the order that the rows have, which has to begin with the release: the writer sorts by it
    if it doesn't, and then drops any other order."""
    df.write.mode(mode).option("compression", "zstd").option("parquet.block.row.count.limit", GROUP_ROWS).partitionBy(*RELEASE[:2]).parquet(path)


def physical_runs(rows: DataFrame, own: Sequence[str]) -> DataFrame:
    """Of a table as it lies on disk: runs of rows of one file and of equal `own` columns, with file, first row index, n,
    first and last line, and whether lines repeat, fall, or hold replacement characters within the run.

    A task reads its rows in the order of the file, so a run is followed batch by batch, and no row is shuffled."""
    broken = F.exists(F.array(*(F.col(f"`{h}`") for h in HEADERS if h in rows.columns)), lambda v: F.coalesce(v.contains("\ufffd"), F.lit(False)))
    plain = rows.select(
        F.to_json(F.struct(*own), {"ignoreNullFields": "false"}).alias("own"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("row_index"),
        F.col("source_line_no").cast("bigint").alias("line"),
        broken.alias("broken"),
    )
    kind = "own string, file string, start bigint, n bigint, first bigint, last bigint, repeats boolean, falls boolean, nulls boolean, broken boolean"
    names = [k.split()[0] for k in kind.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: list | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            own_codes, file_codes = (batch.column(c).dictionary_encode() for c in ("own", "file"))
            a, b = own_codes.indices.to_numpy(), file_codes.indices.to_numpy()
            line, null = batch.column("line").fill_null(0).to_numpy(), batch.column("line").is_null().to_numpy(zero_copy_only=False)
            bad, index = batch.column("broken").to_numpy(zero_copy_only=False), batch.column("row_index").to_numpy()
            cuts = [0, *(np.flatnonzero((a[1:] != a[:-1]) | (b[1:] != b[:-1])) + 1).tolist(), len(a)]
            done = []
            for i, j in zip(cuts[:-1], cuts[1:], strict=True):
                key = (own_codes.dictionary[a[i]].as_py(), file_codes.dictionary[b[i]].as_py())
                step = np.diff(line[i:j])
                flags = [bool((step == 0).any()), bool((step < 0).any()), bool(null[i:j].any()), bool(bad[i:j].any())]
                if now is not None and now[:2] == list(key) and now[2] + now[3] == index[i]:
                    flags[0] |= bool(line[i] == now[5])
                    flags[1] |= bool(line[i] < now[5])
                    now[3], now[5], now[6:] = now[3] + j - i, int(line[j - 1]), [x or y for x, y in zip(now[6:], flags, strict=True)]
                    continue
                if now is not None:
                    done.append(now)
                now = [*key, int(index[i]), j - i, int(line[i]), int(line[j - 1]), *flags]
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], names)
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([c]) for c in now], names)

    return plain.mapInArrow(run, kind)


def landed_faults(df: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """What a read-back of a landed table finds wrong, by release and list: column types and their order; line numbers that
    repeat, are null or below 2; rows that don't lie in the order of their lines; replacement characters; and, given the
    rows expected (the columns that tell lists apart, and n), lists with another number of rows.

    Runs of rows are summed up where they are read; what is compared is a row for each run and file. Only where rows lie
    in no order are their lines counted one by one."""
    spark = df.sparkSession
    wrong = [f"schema:{f.name}" for f in LANDED if f.name not in df.columns or df.schema[f.name].dataType != f.dataType]
    if not wrong and [c for c in df.columns if c in LANDED.names] != LANDED.names:
        wrong = ["column_order"]
    fixed = spark.createDataFrame([(w,) for w in wrong], "failure_reason string")
    if any(w.startswith("schema:") for w in wrong):
        return fixed
    own = [c for c in (*RELEASE, "source_list") if c in df.columns and (expected is None or c in expected.columns)]
    runs = physical_runs(df, own)
    place = Window.partitionBy("own").orderBy(*parts_in_order(F.col("file")), "start")
    before = F.lag("last").over(place)
    runs = runs.withColumns({"repeats": F.col("repeats") | F.coalesce(F.col("first") == before, F.lit(False)), "falls": F.col("falls") | F.coalesce(F.col("first") < before, F.lit(False))})
    found = runs.groupBy("own").agg(F.sum("n").alias("n"), F.min(F.least("first", "last")).alias("least"), *(F.max(c).alias(c) for c in ("repeats", "falls", "nulls", "broken")))
    loose = df.select(F.to_json(F.struct(*own), {"ignoreNullFields": "false"}).alias("own"), "source_line_no").join(F.broadcast(found.where("falls").select("own")), "own")  # a row for each list that lies in no order
    counted = loose.groupBy("own").agg((F.count("*") != F.count_distinct("source_line_no")).alias("twice"), F.min("source_line_no").alias("lowest"))
    joined = found.join(counted, "own", "left").withColumns({"repeats": F.coalesce("twice", "repeats"), "least": F.coalesce("lowest", "least")})
    reason = F.when(F.col("repeats") | F.col("nulls"), "line_numbers").when(F.col("least") < 2, "header_line").when(F.col("broken"), "replacement_character")
    faults = [reason, F.when(F.col("falls"), "order")]
    if expected is not None:
        want = expected.select(F.to_json(F.struct(*own), {"ignoreNullFields": "false"}).alias("own"), F.col("n").alias("wanted"))
        joined = joined.join(want, "own", "full_outer")
        faults.append(F.when(~F.col("n").eqNullSafe(F.col("wanted")), "row_count"))
    each = joined.select(F.explode(F.filter(F.array(*faults), lambda r: r.isNotNull())).alias("failure_reason"))
    return fixed.union(each)


def release_fingerprint(files: DataFrame, order: Sequence[str]) -> DataFrame:
    """SHA-256 of the lists' names and file digests as compact JSON, in the lists' order (binaryFile source: path, content)."""
    name = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.csv$", "")
    rank = F.array_position(F.array(*map(F.lit, order)), name)
    rows = files.select(rank.alias("rank"), F.array(name, F.sha2("content", 256)).alias("pair"))
    pairs = F.transform(F.array_sort(F.collect_list(F.struct("rank", "pair"))), lambda x: x["pair"])
    return rows.agg(F.sha2(F.to_json(pairs), 256).alias("revision_fingerprint"))
