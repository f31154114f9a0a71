"""A spool of files as a table: which files are owed, what they hold, and data sets that are folders."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from itertools import islice
from urllib.parse import quote, unquote

import pandas as pd
import pyarrow as pa
from pyarrow.fs import FileSelector, FileSystem, FileType, LocalFileSystem
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from sluice.operators.chunk import chunk_by_count
from sluice.shared import cut, exists, filesystem

#: Records of a file that are Python objects at a time.
RECORDS = 10_000
#: path, modified, length and content of a file.
FILES = "path string, modificationTime timestamp, length long, content binary"


@dataclass(frozen=True)
class FileSpec:
    """A kind of file: a pattern over its path below the root (** for any folders), and the table its records are of."""

    pattern: str
    table: str = "files"

    def regex(self) -> str:
        parts = re.split(r"(\*\*/|\*\*|\*|\?)", self.pattern)
        known = {"**/": "(?:.*/)?", "**": ".*", "*": "[^/]*", "?": "[^/]"}
        return "^" + "".join(known.get(p, re.escape(p)) for p in parts) + "$"


def relative(path: Column, root: str) -> Column:
    """The path below the root; schemes and leading slashes don't count."""
    return F.regexp_replace(path, "^(?:[a-z]+:/*)?/*" + _quoted(root.split(":", 1)[-1].strip("/")) + "/", "")


def _quoted(text: str) -> str:
    return "\\Q" + text.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def chosen(rel: Column, specs: Sequence[FileSpec]) -> Column:
    """The table of the first spec that a path matches; null for none."""
    out = F.lit(None).cast("string")
    for spec in reversed(specs):
        out = F.when(rel.rlike(spec.regex()), spec.table).otherwise(out)
    return out


def file_spool(spark: SparkSession, root: str, specs: Sequence[FileSpec], after: tuple | None = None, limit: int | None = None, content: bool = False) -> DataFrame:
    """Files under root that a spec matches, oldest first: path, rel, table, mtime, length (and content).

    ``after`` is the (mtime, path) of the last file taken in keep mode: files of one instant are neither lost nor sent
    twice. Without ``content`` files are listed, not read.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    rel = relative(F.col("path"), root)
    out = files.select("path", rel.alias("rel"), chosen(rel, specs).alias("table"), F.col("modificationTime").alias("mtime"), "length", *(["content"] if content else [])).where("table is not null")
    if after is not None:
        out = out.where((F.col("mtime") > F.lit(after[0])) | ((F.col("mtime") == F.lit(after[0])) & (F.col("path") > F.lit(after[1]))))
    out = out.orderBy("mtime", "path")
    return out if limit is None else out.limit(limit)


def spool_keep_cursor(files: DataFrame) -> DataFrame:
    """The (mtime, path) after a slice of files."""
    return files.agg(F.max(F.struct("mtime", "path")).alias("_last")).select("_last.*")


def spool_stream(spark: SparkSession, root: str, retention: str = "keep", files_per_trigger: int = 1000, archive: str | None = None, **options) -> DataFrame:
    """Files as a stream. Once a batch is behind, its files are deleted, moved to ``archive``, or kept."""
    clean = {"delete": {"cleanSource": "delete"}, "keep": {"cleanSource": "off"}, "archive": {"cleanSource": "archive", "sourceArchiveDir": archive}}[retention]
    if retention == "archive" and not archive:
        raise ValueError("archive needs a folder")
    return spark.readStream.format("binaryFile").schema(FILES).options(recursiveFileLookup=True, maxFilesPerTrigger=files_per_trigger, **clean, **options).load(root)


def parse_spool(files: DataFrame, parsers: dict[str, Callable[[str, bytes], Iterable[dict] | dict]]) -> tuple[DataFrame, DataFrame]:
    """Records of files by their table's parser: path, table, time, columns; and files that a parser failed on.

    A parser gives a record or several, best as a generator: a task then holds one file's bytes and its records in Arrow's
    form, and hands them on in parts once the whole file was read without a failure. A record's time is its ``time``
    field, else the file's. Files without a parser
    are one record of their path. A failed file is a row of the rejects with the reason, and nothing else stops.
    """
    schema = "path string, table string, mtime timestamp, columns map<string,string>, error string"
    kind = pa.map_(pa.string(), pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            named = batch.select(["path", "table", "mtime"])
            for i in range(batch.num_rows):  # one file's bytes at a time
                path, table, error = named.column(0)[i].as_py(), named.column(1)[i].as_py(), None
                try:
                    found = parsers[table](path, bytes(batch.column("content")[i].as_py())) if table in parsers else {"path": path}
                    found = iter([found] if isinstance(found, dict) else found)
                    held = []  # Arrow's form takes a fraction of a dict
                    while part := list(islice(found, RECORDS)):
                        held.append(pa.array([[(k, None if v is None else str(v)) for k, v in r.items()] for r in part], kind))
                except Exception as e:  # a user's parser can fail in any way; the file is reported
                    held, error = [pa.nulls(1, kind)], f"{type(e).__name__}: {e}"
                for columns in held:
                    of = named.take(pa.array([i] * len(columns)))
                    yield pa.RecordBatch.from_arrays([*of.columns, columns, pa.array([error] * len(columns), pa.string())], [*of.schema.names, "columns", "error"])

    read = files.select("path", "table", "mtime", "content").mapInArrow(run, schema)
    time = F.coalesce(F.try_element_at("columns", F.lit("time")).try_cast("timestamp"), F.col("mtime"))
    return read.where("error is null").select("path", "table", time.alias("time"), "columns"), read.where("error is not null").select("path", "table", "error")


def spool_files_of(records: DataFrame) -> DataFrame:
    """The files behind records, once each: what may be deleted when they are acknowledged."""
    return records.select("path").distinct()


def _place(path: str) -> tuple:
    """The file system of a path in a task, and the path as that names it."""
    scheme, _, rest = path.partition(":")
    if scheme == "file" or not rest:
        return LocalFileSystem(), "/" + (rest or path).lstrip("/")
    found, at = FileSystem.from_uri(f"{scheme}:{quote(rest)}")
    return found, unquote(at)


def _delete(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Deletes files; the folder of each that was there."""
    for batch in batches:
        gone = []
        for path in batch["path"]:
            files, at = _place(path)
            if files.get_file_info(at).type == FileType.File:
                files.delete_file(at)
                gone.append(path.rpartition("/")[0])
        yield pd.DataFrame({"path": pd.Series(gone, dtype=object)})


def _prune(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Deletes folders that are empty; the folder above each that was."""
    for batch in batches:
        gone = []
        for path in batch["path"]:
            files, at = _place(path)
            if files.get_file_info(at).type == FileType.Directory and not files.get_file_info(FileSelector(at)):
                files.delete_dir(at)
                gone.append(path.rpartition("/")[0])
        yield pd.DataFrame({"path": pd.Series(gone, dtype=object)})


def delete_acked(paths: DataFrame, root: str) -> int:
    """Deletes the files (column path) whose records the destination acknowledged, then folders that are left empty below root.

    Tasks delete their parts of the paths by the paths' own file system, and then, level by level, folders: no path goes
    through the driver. Files of records that wait or failed aren't among ``paths`` and stay. A path that is gone
    already counts as none, so a second run does nothing.
    """
    files, top = filesystem(paths.sparkSession, root)
    below = files.makeQualified(top).toString().rstrip("/") + "/"
    store = below.removesuffix(files.makeQualified(top).toUri().getPath().rstrip("/") + "/")  # of paths that name none
    named = F.when(F.col("path").rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), F.col("path")).otherwise(F.concat(F.lit(store), "path"))
    gone = cut(paths.select(named.alias("path")).where("path is not null").distinct().mapInPandas(_delete, "path string"))
    deleted = gone.count()
    while True:
        folders = gone.where(F.concat("path", F.lit("/")) != below).where(F.col("path").startswith(below)).distinct()
        gone = cut(folders.mapInPandas(_prune, "path string"))
        if gone.isEmpty():
            return deleted


def spool_health(spark: SparkSession, root: str) -> DataFrame:
    """One row: status (ok, empty, or unreachable where the root can't be listed), n_files, n_bytes, newest."""
    nothing = "0L AS n_files, 0L AS n_bytes, cast(null AS timestamp) AS newest"
    if not exists(spark, root):
        return spark.range(1).selectExpr("'unreachable' AS status", *nothing.split(", "))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    sums = files.agg(F.count("*").alias("n_files"), F.coalesce(F.sum("length"), F.lit(0)).alias("n_bytes"), F.max("modificationTime").alias("newest"))
    return sums.select(F.when(F.col("n_files") > 0, "ok").otherwise("empty").alias("status"), "n_files", "n_bytes", "newest")


def _in_dataset(files: DataFrame, dataset: str, rel: str) -> DataFrame:
    named = files.withColumns({"dataset": F.regexp_extract(rel, f"{dataset}/", 2), "file": F.regexp_replace(F.col(rel), f"{dataset}/", "")})
    return named.where("dataset <> ''")


def datasets(files: DataFrame, dataset: str = r"(^|.*/)(OBS[^/]+)", rel: str = "rel", after: tuple | None = None) -> DataFrame:
    """Data sets that are folders: dataset, n_files, n_bytes and newest mtime.

    ``after`` is the (mtime, dataset) of the last data set taken in keep mode; one that has grown since comes again.
    """
    out = _in_dataset(files, dataset, rel).groupBy("dataset").agg(F.count("*").alias("n_files"), F.sum("length").alias("n_bytes"), F.max("mtime").alias("mtime"))
    if after is not None:
        out = out.where((F.col("mtime") > F.lit(after[0])) | ((F.col("mtime") == F.lit(after[0])) & (F.col("dataset") > F.lit(after[1]))))
    return out


def datasets_keep_cursor(found: DataFrame) -> DataFrame:
    """The (mtime, dataset) after a slice of data sets."""
    return found.agg(F.max(F.struct("mtime", "dataset")).alias("_last")).select("_last.*")


def dataset_manifest(files: DataFrame, dataset: str = r"(^|.*/)(OBS[^/]+)", rel: str = "rel", part: int = 1000) -> DataFrame:
    """The files of data sets in parts of at most ``part``, which bounds a row: dataset, part, n_files, n_bytes, files by name."""
    parts = chunk_by_count(_in_dataset(files, dataset, rel).select("dataset", "file", "length"), part, ("file",), ("dataset",)).withColumnRenamed("batch_id", "part")
    return parts.groupBy("dataset", "part").agg(F.count("*").alias("n_files"), F.sum("length").alias("n_bytes"), F.sort_array(F.collect_list("file")).alias("files"))


def layout_files(files: DataFrame, site: Column, top: str = "spool", rel: str = "rel") -> DataFrame:
    """arcname of each file: receiver, band and name under spots or noise and the site; others keep their path.

    Noise files drop the century and the seconds from their names.
    """
    parts = F.split(rel, "/")
    name = F.element_at(parts, -1)
    noise = name.endswith("_noise.txt")
    short = F.regexp_replace(name, r"^.*?\d{2}(\d{6}_\d{4})\d{2}_noise\.txt$", "$1_noise.txt")
    placed = F.concat_ws("/", F.lit(top), F.when(noise, "noise").otherwise("spots"), site, F.element_at(parts, 1), F.try_element_at(parts, F.lit(2)), F.when(noise, short).otherwise(name))
    deep = F.size(parts) >= F.when(noise, 4).otherwise(3)
    return files.withColumn("arcname", F.when(deep, placed).otherwise(F.concat_ws("/", F.lit(top), F.col(rel))))


def write_bundles(df: DataFrame, path: str, by: Sequence[str] = ("cycle",), mode: str = "append") -> None:
    """Lines as text files by folders of their keys; each key's lines are in a file or few, since they come together."""
    df.repartition(*by).sortWithinPartitions(*by).select(*by, F.col("line").alias("value")).write.mode(mode).partitionBy(*by).text(path)


#: Fixed: folders of an epoch's payloads; stores that were written keep their number.
BUCKETS = 64


def payload_bucket(*keys: Column) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")


def freeze_payload(df: DataFrame, path: str, keys: Sequence[str] = ("deliverable_id",), epoch: int = 0) -> DataFrame:
    """Rendered rows, written once for their deliverable, so that every retry reads the same bytes; all that ``path`` has.

    An epoch's payloads lie in a fixed number of folders by hash of the keys. Writing an epoch again replaces what its
    first try left and touches no other, so what waits stays. The keys name a deliverable: where several pipelines
    share a store, the pipeline is one.
    """
    dealt = df.withColumn("bucket", payload_bucket(*[F.col(k) for k in keys]))
    dealt.repartition("bucket", *keys).write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/epoch={epoch}")
    return frozen_payloads(df.sparkSession, path, df.schema)


def frozen_payloads(spark: SparkSession, path: str, schema: StructType, places: bool = False) -> DataFrame:
    """What freeze_payload() wrote over all epochs; with ``places`` also bucket and epoch, which joins can prune by."""
    more = StructType([StructField("epoch", LongType()), StructField("bucket", IntegerType())])
    if not exists(spark, path):
        read = spark.createDataFrame([], StructType([*schema.fields, *more.fields]))
    else:
        read = spark.read.schema(StructType([*schema.fields, *more.fields])).parquet(path)
    return read if places else read.drop("epoch", "bucket")
