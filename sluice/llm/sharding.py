"""Shards of near-equal bytes by histogram sort: probe boundaries, count exactly, refine, exchange once.

Rows are ordered by (hash of the text, id, a number of the row), so equal texts lie side by side and a group of any
size can still be split. Candidate boundaries are keys drawn from the open intervals; each round counts the exact
bytes and rows below every candidate in one pass, and an interval closes when its boundary is as near as a row allows
or within the tolerance. The driver sees candidates and their sums only, whose number doesn't depend on the table.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import cut, fresh

#: Keys that an open interval offers as candidates in a round, about.
PROBES = 48
#: Nearness to the ideal boundary, as a share of a shard, at which an interval closes.
TOLERANCE = 1e-4
_KEY = ("h", "d", "u")
_SCALE = 1 << 32


def keys(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """doc_id, size (UTF-8 bytes, none for null, plus 16), text_crc32 (0 for null) and the key h, d, u.

    u numbers the rows and is kept with them in the shared folder, so a row has the same key whenever it is read. It
    is ``row_col`` where the rows are numbered already.
    """
    text, own = F.col(text_col).cast("string"), F.col(id_col).cast("long")
    size = (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long").alias("size")
    crc = F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32")
    key = [F.xxhash64(text).alias("h"), F.coalesce(own, F.lit(-(1 << 63))).alias("d"), (F.col(row_col) if row_col else F.monotonically_increasing_id()).alias("u")]
    return cut(df.select(own.alias("doc_id"), size, crc, *key))


def below(columns: list[np.ndarray], probes: list[tuple]) -> np.ndarray:
    """For each row the number of probes (sorted tuples) that its key isn't below."""
    first = np.array([p[0] for p in probes], dtype=np.int64)
    if len(columns) == 1:
        return np.searchsorted(first, columns[0], side="right")
    out, to = np.searchsorted(first, columns[0], side="left"), np.searchsorted(first, columns[0], side="right")
    for at in np.unique(out[to > out]):
        rows = np.flatnonzero((out == at) & (to > at))
        out[rows] += below([c[rows] for c in columns[1:]], [p[1:] for p in probes[at : to[rows[0]]]])
    return out


def _columns(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [batch.column(c).to_numpy(zero_copy_only=False) for c in _KEY]


def count(keyed: DataFrame, probes: list[tuple]) -> tuple[list[int], list[int]]:
    """Exact bytes and rows below each probe."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, rows = np.zeros(len(probes) + 1, dtype=np.int64), np.zeros(len(probes) + 1, dtype=np.int64)
        for batch in batches:
            at = below(_columns(batch), probes)
            np.add.at(size, at, batch.column("size").to_numpy(zero_copy_only=False))
            rows += np.bincount(at, minlength=len(rows))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(rows))), pa.array(size), pa.array(rows)], ["at", "size", "rows"])

    sums = keyed.select(*_KEY, "size").mapInArrow(run, "at long, size long, rows long").groupBy("at").agg(F.sum("size"), F.sum("rows")).collect()
    size, rows = np.zeros(len(probes) + 1, dtype=np.int64), np.zeros(len(probes) + 1, dtype=np.int64)
    for at, s, n in sums:
        size[at], rows[at] = s, n
    return np.cumsum(size)[:-1].tolist(), np.cumsum(rows)[:-1].tolist()


def candidates(keyed: DataFrame, edges: list[tuple], rates: list[int]) -> list[tuple]:
    """Keys of the intervals between edges, each row drawn by a hash of its key at its interval's rate (of 2**32)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rate = np.array(rates, dtype=np.int64)
        for batch in batches:
            columns = _columns(batch)
            at = below(columns, edges) if edges else np.zeros(batch.num_rows, dtype=np.int64)
            yield batch.filter(pa.array(batch.column("draw").to_numpy(zero_copy_only=False) < rate[at]))

    drawn = keyed.select(*_KEY, F.pmod(F.xxhash64(*_KEY), F.lit(_SCALE)).alias("draw"))
    return [(r.h, r.d, r.u) for r in drawn.mapInArrow(run, drawn.schema).collect()]


def splitters(keyed: DataFrame, shards: int, tolerance: float = TOLERANCE, probes: int = PROBES) -> tuple[list[tuple], dict[tuple, tuple[int, int]]]:
    """The shards - 1 keys that begin shards 1, 2, ..., and all keys whose exact bytes and rows below are known."""
    total, n = keyed.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    known: dict[tuple, tuple[int, int]] = {}
    ideal = [total * i / shards for i in range(1, shards)]
    while n and shards > 1:
        order = sorted(known)
        sizes = [known[k][0] for k in order]
        # Interval j lies between the edges j - 1 and j; it is open if an ideal boundary lies in it and can come nearer.
        wanted: dict[int, int] = {}
        for x in ideal:
            j = bisect_right(sizes, x)
            low, high = (known[order[j - 1]] if j else (0, 0)), (known[order[j]] if j < len(order) else (total, n))
            if min(x - low[0], high[0] - x) > tolerance * total / shards and high[1] - low[1] > 1:
                wanted[j] = wanted.get(j, 0) + 1
        if not wanted:
            break
        rates = [0] * (len(order) + 1)
        for j, many in wanted.items():
            rows = (known[order[j]][1] if j < len(order) else n) - (known[order[j - 1]][1] if j else 0)
            rates[j] = min(_SCALE, -(-_SCALE * probes * many // rows))
        if new := sorted({*candidates(keyed, order, rates)} - known.keys()):
            known |= dict(zip(new, zip(*count(keyed, new), strict=True), strict=True))
        elif all(rates[j] == _SCALE for j in wanted):
            break
        else:
            probes *= 4
    order = sorted(known)
    sizes = [known[k][0] for k in order]
    chosen = []
    for x in ideal:
        near = [k for k in (bisect_right(sizes, x) - 1, bisect_right(sizes, x)) if 0 <= k < len(order)]
        chosen.append(order[min(near, key=lambda k: abs(sizes[k] - x))] if near else None)
    return [c for c in chosen if c is not None], known


def shard(df: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text", tolerance: float = TOLERANCE) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot: shards of near-equal bytes in key order, slots gapless from 0 in each.

    A shard's bytes miss the ideal by no more than the rows at its two boundaries, or the tolerance. With fewer rows
    than shards some shards are empty; an empty table gives no rows. Repeated rows have keys of their own.
    """
    return _placed(keys(df, id_col, text_col), shards, tolerance).drop("u")


def _placed(keyed: DataFrame, shards: int, tolerance: float) -> DataFrame:
    """What shard() returns, and the row number u."""
    begins, known = splitters(keyed, shards, tolerance)
    order = sorted(known)
    starts = sorted(begins)
    shard_of = [0, *(bisect_right(starts, k) for k in order)]
    rows_below = [0, *(known[k][1] for k in order)]
    first = {0: 0} | {s: known[k][1] for s, k in enumerate(starts, 1)}
    offset = [rows - first[s] for rows, s in zip(rows_below, shard_of, strict=True)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard_at, offset_at = np.array(shard_of, dtype=np.int32), np.array(offset, dtype=np.int64)
        for batch in batches:
            at = below(_columns(batch), order) if order else np.zeros(batch.num_rows, dtype=np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at), pa.array(shard_at[at]), pa.array(offset_at[at])], [*batch.schema.names, "bin", "shard", "offset"])

    placed = keyed.mapInArrow(run, "doc_id long, size long, text_crc32 long, h long, d long, u long, bin long, shard int, offset long")
    slot = F.col("offset") + F.row_number().over(Window.partitionBy("bin").orderBy(*_KEY)) - 1
    return placed.select("doc_id", "size", "text_crc32", "shard", slot.cast("long").alias("slot"), "u")


def write(df: DataFrame, path: str, shards: int = 40, id_col: str = "doc_id", text_col: str = "text", file_rows: int = 1_000_000) -> None:
    """The rows of df as files by shard, each row once: rows meet their place by a number, so ids can be null or repeat.

    A shard's files are of ``file_rows`` slots each, in order, so the exchange has as many parts as the rows need and not
    as many as there are shards.
    """
    own, part = fresh(df, "_row"), fresh(df, "_file")
    rows = cut(df.withColumn(own, F.monotonically_increasing_id()))
    placed = _placed(keys(rows, id_col, text_col, own), shards, TOLERANCE).select(F.col("u").alias(own), "shard", "slot", F.floor(F.col("slot") / file_rows).alias(part))
    rows.join(placed, own).drop(own).repartition("shard", part).sortWithinPartitions("shard", "slot").drop(part).write.option("maxRecordsPerFile", file_rows).partitionBy("shard").parquet(path)
