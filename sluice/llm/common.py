"""What the corpus operators share: column selection, hashing of ids, the folder for checkpoints."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


#: Classes whose counts are broadcast; more of them are joined.
MOST_CLASSES = 10_000
#: Steps of the hash between which a class's sample ends.
STEPS = 400


def documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: str) -> DataFrame:
    """Only the named columns, as doc_id (long), text (string) and ``more``; other columns can't clash."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *[F.col(c) for c in more])


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df has not, whatever the case of letters."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name = f"_{name}"
    return name


def id_remainder(id_col: str, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as the empty text."""
    return (F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % n).cast("int")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir; a temporary one is set only where that is unset (tests)."""
    jsc = spark.sparkContext._jsc.sc()
    if jsc.getCheckpointDir().isEmpty():
        at = spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="checkpoint-")
        spark.sparkContext.setCheckpointDir(at)
    return jsc.getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """df, computed once and kept in the shared folder, so that a lost executor costs a read."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def renewed(df: DataFrame) -> DataFrame:
    """cut() for rounds of joins: it also forgets Spark's estimate of the size, which a checkpoint keeps.

    A join is taken to be as large as the product of its sides. Over rounds the digits of that number multiply (by four
    in a round of ``stars``), until it takes the driver's memory. Here the size is unknown; adaptive plans see the true one.
    """
    spark, out = df.sparkSession, cut(df)
    return DataFrame(spark._jsparkSession.createDataFrame(out._jdf.toJavaRDD(), out._jdf.schema()), spark)


def sample(df: DataFrame, class_col: str, text_col: str, rows: int, size: int) -> DataFrame:
    """class_col and text_col of a bounded sample of distinct texts in which all classes have the same part.

    Of each class those with the least text hashes are taken, as many as rows / classes and size / classes (bytes)
    allow, to within a 100th; null classes and texts are left out, and copies of a text in a class count as one, however
    many there are. A text of over a 64th of its class's bytes counts as pieces of at most that size. The result has at
    most ``rows`` rows (with more classes than that, one each of the first by hash) and ``size`` bytes; with fewer in
    all nothing is left out. Candidates are drawn by hash at a rate that follows from the number of their class's
    distinct texts, and the hash up to which they are taken from sums by steps of the hash, so no task has a class whole.
    """
    own = df.select(F.col(class_col).cast("string").alias("class"), F.col(text_col).cast("string").alias("text")).where("class is not null and text is not null")
    classes = max(1, own.select("class").distinct().count())
    part, part_size, scale = max(1, rows // classes), size // classes, 1 << 40
    piece = max(1, part_size // 256)  # characters, of up to 4 bytes
    pieces = F.when(F.octet_length("text") <= part_size // 64, F.array("text")).otherwise(F.regexp_extract_all("text", F.lit(f"(?s).{{1,{piece}}}"), F.lit(0)))
    hashed = own.withColumn("text", F.explode(pieces)).withColumn("h", F.xxhash64("text"))
    counts = cut(hashed.groupBy("class").agg(F.approx_count_distinct("h").alias("n")))
    small = (lambda x: F.broadcast(x)) if classes <= MOST_CLASSES else (lambda x: x)
    rate = F.least(F.lit(1.0), F.lit(2 * part + 100) / F.greatest("n", F.lit(1))) * scale
    drawn = hashed.join(small(counts), "class").withColumn("step", F.floor(F.pmod("h", F.lit(scale)) / rate * STEPS).cast("int")).where(F.col("step") < STEPS)
    distinct = cut(drawn.groupBy("class", "h", "step").agg(F.min("text").alias("text")))  # in each task before the shuffle as well
    sums = distinct.groupBy("class", "step").agg(F.count("*").alias("rows"), F.sum(F.octet_length("text")).alias("bytes"))
    upto = Window.partitionBy("class").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    fits = sums.withColumns({"rows": F.sum("rows").over(upto), "bytes": F.sum("bytes").over(upto)}).where((F.col("rows") <= part) & (F.col("bytes") <= part_size))
    last = fits.groupBy("class").agg(F.max("step").alias("last"))
    chosen = distinct.join(small(last), "class").where(F.col("step") <= F.col("last"))
    if classes > rows:
        chosen = chosen.orderBy("h").limit(rows)
    return chosen.select(F.col("class").alias(class_col), F.col("text").alias(text_col))


def slices(batches: Iterable[pa.RecordBatch], limit: int, text_col: str = "text") -> Iterator[pa.RecordBatch]:
    """Batches cut to about ``limit`` bytes of text each: at most one text passes the limit.

    An Arrow batch holds a number of rows, which says little of its size; slices bound what a task holds besides it.
    """
    for batch in batches:
        texts, start, held = batch.column(text_col), 0, 0
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
        for i, size in enumerate(sizes):
            held += size
            if held >= limit:
                yield batch.slice(start, i + 1 - start)
                start, held = i + 1, 0
        if start < batch.num_rows:
            yield batch.slice(start)


def packs(batches: Iterable[pa.RecordBatch], limit: int) -> Iterator[dict[str, list]]:
    """Slices as lists by column."""
    for batch in slices(batches, limit):
        yield batch.to_pydict()


def keep_where(df: DataFrame, decide: Callable[[], Callable[[list], list]], text_col: str = "text", limit: int = 4 << 20) -> DataFrame:
    """The rows of df, as they are, whose text is decided on with true; no shuffle. ``decide`` makes the decider in a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decider = decide()
        for batch in slices(batches, limit, text_col):
            yield batch.filter(pa.array(decider(batch.column(text_col).to_pylist()), pa.bool_()))

    return df.mapInArrow(run, df.schema)


class Cache(dict):
    """A dict that fills itself by ``make`` and starts anew at ``limit`` entries, so that memory stays bounded."""

    def __init__(self, make, limit: int = 400_000):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        self[key] = value = self.make(key)
        return value
