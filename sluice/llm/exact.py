"""Exact dedup of a stream of documents: state by digest keeps where a text was first seen, and hits are checked byte by byte.

The keyed state, in RocksDB and without expiry, is a streaming aggregate: of each digest the first row's id and place in
the source (file and row number), how many rows there are, and no text. Tasks combine rows before the shuffle, so a digest
of any number of rows is a few when it reaches its key. Of each micro-batch the digests that changed come out, and with
them its files: tasks put rows with equal bytes together, and where the digest was first seen elsewhere, the texts of both
places are read and compared as a whole. Rows that share a digest only, and not the text, are kept apart by their text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sluice.llm.common import slices
from sluice.shared import exists, filesystem

#: State on disk; without files that are allocated ahead, which for many small partitions would be most of it.
STATE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider", "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false"}
#: Of at most so many places (about 200 bytes each) a list goes to every task; more are joined.
MOST_PLACES = 100_000
_FOUND = "digest string, file string, row long, ids string, rows string, n long, best_id long, best_row long"
_SEEN = _FOUND + ", first_file string, first_row long"
_GROUP = "digest string, n long, first_id long, first_file string, first_row long"
#: Keys of this beginning are of files, not of texts: they say which files a micro-batch has.
_FILE = "file:"
_APART = "file string, row long, other string"


def same_text(text: Column) -> Column:
    """What is compared: the text as it is, null as empty."""
    return F.coalesce(text.cast("string"), F.lit(""))


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with equal bytes of a slice as one row: the place of the first, all ids and row numbers, and the greatest id."""
    for whole in batches:
        for batch in slices(_by_file(whole), 16 << 20):
            codes = batch.column("text").dictionary_encode().indices.to_pylist()
            groups: dict[int, list] = {}
            for i, code in enumerate(codes):
                groups.setdefault(code, []).append(i)
            ids, rows, digests, files = (batch.column(c).to_pylist() for c in ("doc_id", "row", "digest", "file"))
            out = []
            for at in groups.values():
                best = max(at, key=lambda i: (ids[i] is not None, ids[i] or 0, rows[i]))
                out.append((digests[at[0]], files[at[0]], rows[at[0]], ",".join("" if ids[i] is None else str(ids[i]) for i in at), ",".join(str(rows[i]) for i in at), len(at), ids[best], rows[best]))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()), strict=True)], names=[c.split()[0] for c in _FOUND.split(", ")])


def _by_file(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch cut where its file changes, so that row numbers of a group are of one file."""
    files, start = batch.column("file").dictionary_encode().indices.to_pylist(), 0
    for i in range(1, len(files) + 1):
        if i == len(files) or files[i] != files[start]:
            yield batch.slice(start, i - start)
            start = i


def _texts(spark: SparkSession, places: DataFrame, text_col: str, normal: Callable[[Column], Column]) -> DataFrame:
    """The places (file, row and more) with the texts that lie there. Only the files that are named are read."""
    files = [unquote(r.file) for r in places.select("file").distinct().toLocalIterator()]
    read = spark.read.parquet(*files)
    own = read.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"), normal(read[text_col]).alias("text"))
    few = places.limit(MOST_PLACES + 1).count() <= MOST_PLACES
    return own.join(F.broadcast(places) if few else places, ["file", "row"])


def dedup(docs: DataFrame, log: str, checkpoint: str, available_now: bool = False, id_col: str = "doc_id", text_col: str = "text", normal: Callable[[Column], Column] = same_text, digest: Callable[[Column], Column] = sha256) -> StreamingQuery:
    """A running query that takes a stream of Parquet files of documents into ``log``; classes() reads what is known by then.

    ``docs`` is the stream as it was read, since places come from its files, which have to stay. Ids can be null or
    repeat, other columns don't matter, an empty table gives an empty log. A micro-batch that is tried again overwrites
    what it had written. A weak ``digest`` costs comparisons and never merges different texts.
    """
    spark, text = docs.sparkSession, normal(F.col(text_col))
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")]
    read = docs.select(digest(text).alias("digest"), F.col(id_col).cast("long").alias("doc_id"), *place).withColumn("at", F.current_timestamp())
    keys = F.when(F.col("row") == 0, F.array("digest", F.concat(F.lit(_FILE), "file"))).otherwise(F.array("digest"))
    # the time is that of the micro-batch, the same when it is tried again, so an older place always comes first
    first = F.min(F.struct("at", "file", "row", "doc_id"))
    groups = read.withColumn("digest", F.explode(keys)).groupBy("digest").agg(F.count("*").alias("n"), first.alias("first"))
    seen = groups.select("digest", "n", F.col("first.doc_id").alias("first_id"), F.col("first.file").alias("first_file"), F.col("first.row").alias("first_row"))

    def check(changed: DataFrame, epoch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{log}/groups/epoch={epoch}")
        groups = spark.read.schema(_GROUP).parquet(f"{log}/groups/epoch={epoch}")
        files = [unquote(r.first_file) for r in groups.where(F.col("digest").startswith(_FILE)).toLocalIterator()]
        if not files:
            return
        again = spark.read.parquet(*files)
        text = normal(again[text_col])
        gathered = again.select(again[id_col].cast("long").alias("doc_id"), text.alias("text"), digest(text).alias("digest"), *place).mapInArrow(_gathered, _FOUND)
        gathered.join(groups.select("digest", "first_file", "first_row"), "digest").write.mode("overwrite").parquet(f"{log}/rows/epoch={epoch}")
        hits = spark.read.schema(_SEEN).parquet(f"{log}/rows/epoch={epoch}").where("file <> first_file OR row <> first_row")
        if hits.isEmpty():
            return
        places = hits.select("digest", "file", "row", F.lit(False).alias("is_first")).unionByName(hits.select("digest", F.col("first_file").alias("file"), F.col("first_row").alias("row"), F.lit(True).alias("is_first")).distinct())
        texts = _texts(spark, places, text_col, normal)
        mine, theirs = texts.where("not is_first"), texts.where("is_first").select("digest", F.col("text").alias("first_text"))
        apart = mine.join(theirs, "digest").where("text <> first_text").select("file", "row", F.col("text").alias("other"))
        apart.write.mode("overwrite").parquet(f"{log}/apart/epoch={epoch}")

    writer = seen.writeStream.outputMode("update").foreachBatch(check).option("checkpointLocation", checkpoint)
    old = {name: spark.conf.get(name, None) for name in STATE}
    for name, value in STATE.items():
        spark.conf.set(name, value)  # a query keeps what holds as it starts
    try:
        return (writer.trigger(availableNow=True) if available_now else writer).start()
    finally:
        for name, value in old.items():
            spark.conf.set(name, value) if value else spark.conf.unset(name)


def documents_stream(spark: SparkSession, folder: str, name: str = "documents.parquet", **options) -> DataFrame:
    """A table of ``folder`` as a stream of its files, whether it is one file or a folder of them."""
    files, at = filesystem(spark, f"{folder}/{name}")
    reader = spark.readStream.schema(spark.read.parquet(f"{folder}/{name}").schema).options(**options)
    return reader.parquet(f"{folder}/{name}") if files.getFileStatus(at).isDirectory() else reader.option("pathGlobFilter", name).parquet(folder)


def classes(spark: SparkSession, log: str) -> DataFrame:
    """doc_id, keep_id, group_size, kept and digest, a row for each document of the log.

    Of equal texts the row with the greatest id stays, exactly one even if ids repeat (then by file and row); null ids
    come last, and where all are null keep_id is. Groups are counted by their gathered rows before any shuffle.
    """
    if not exists(spark, f"{log}/rows"):
        return spark.createDataFrame([], "doc_id long, keep_id long, group_size long, kept boolean, digest string")
    rows = spark.read.schema(_SEEN).parquet(f"{log}/rows")
    if exists(spark, f"{log}/apart"):
        rows = rows.join(spark.read.schema(_APART).parquet(f"{log}/apart"), ["file", "row"], "left")
        rows = rows.withColumn("other", F.coalesce(F.concat(F.lit("="), "other"), F.lit("")))
    else:
        rows = rows.withColumn("other", F.lit(""))
    kept = rows.groupBy("digest", "other").agg(F.sum("n").alias("group_size"), F.max(F.struct("best_id", "file", "best_row")).alias("keep"))
    met = rows.select("digest", "other", "file", "ids", "rows").join(kept, ["digest", "other"])
    each = met.withColumn("one", F.explode(F.arrays_zip(F.split("ids", ",").alias("id"), F.split("rows", ",").alias("row"))))
    stays = (F.col("file") == F.col("keep.file")) & (F.col("one.row").cast("long") == F.col("keep.best_row"))
    return each.select(F.expr("try_cast(one.id AS long)").alias("doc_id"), F.col("keep.best_id").alias("keep_id"), F.col("group_size").cast("long").alias("group_size"), stays.alias("kept"), "digest")
