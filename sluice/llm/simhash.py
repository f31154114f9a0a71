"""Near copies by SimHash: fingerprints, a grid of segment popcounts, exact checks, connected components.

The 64 bits are two halves of 16 segments, and a half's embedding is the number of set bits of each segment. Flipping
a bit moves one coordinate by one, so the Manhattan distance of embeddings never exceeds the Hamming distance. Of two
fingerprints within 4 bits, one half differs in 2 or fewer: its embeddings are within 2, and some grid point lies
within 1 of both. Each fingerprint goes to its own grid point and those next to it, in either half; the pairs that
meet are checked exactly. Members of a crowded point are dealt again by a grid over the other half, as far as the
first half leaves bits of the four; what is crowded even there, by a grid over segments of single bits, where the
embedding is the fingerprint itself. Fingerprints that are equal are one row throughout.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import cut, documents, packs, renewed

BITS, SEGMENTS, WIDTH = 4, 16, 2
#: A grid point with more fingerprints than this is dealt again by more of their bits instead of paired off.
CROWD = 1024
#: Links of a task of the components.
PART = 50_000
_SHIFTS = np.arange(SEGMENTS, dtype=np.uint64) * np.uint64(WIDTH)
_PLACES = np.array([(WIDTH + 1) ** i for i in range(SEGMENTS)], dtype=np.int64)
_POINTS = (WIDTH + 1) ** SEGMENTS


def fingerprint(text: str | None, k: int = 4, seed: int = 42) -> int:
    """A bit is set if it is in over half of the shingles' hashes. No words: zero."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined, k = b" ".join(words), min(k, len(words))
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[:-1]]
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, dtype=np.int64)
    n = len(words) - k + 1
    for at in range(0, n, 65_536):
        to = min(n, at + 65_536)
        hashes = np.array([digest(joined[s : e - 1], seed) for s, e in zip(starts[at:to], ends[at + k - 1 : to + k - 1], strict=True)], dtype="<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 4) -> DataFrame:
    """doc_id and fp (the fingerprint as a signed long) of each whole text; null texts have the fingerprint of none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pack in packs(batches, 4 << 20):
            found = np.array([fingerprint(x, k) for x in pack["text"]], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pack["doc_id"], pa.int64()), pa.array(found)], ["doc_id", "fp"])

    return documents(df, id_col, text_col).mapInArrow(run, "doc_id long, fp long")


def embedding(fps: np.ndarray, half: int) -> np.ndarray:
    """Set bits of each segment of a half."""
    bits = (fps.view(np.uint64) >> np.uint64(32 * half)) & np.uint64(0xFFFFFFFF)
    return np.bitwise_count((bits[:, None] >> _SHIFTS) & np.uint64((1 << WIDTH) - 1)).astype(np.int64)


def cells(fps: np.ndarray, who: np.ndarray | None = None, grid: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Grid points and ``who`` (the fingerprints themselves): each at its own point and those at distance 1, in both
    halves. Points of grids with other numbers never meet."""
    who = fps if who is None else who
    at, names = [], []
    for half in (0, 1):
        counts = embedding(fps, half)
        own = (counts @ _PLACES + grid * _POINTS) * 2 + half
        at.append(own)
        names.append(who)
        for step, open_ in ((1, counts < WIDTH), (-1, counts > 0)):
            row, place = np.nonzero(open_)
            at.append(own[row] + 2 * step * _PLACES[place])
            names.append(who[row])
    return np.concatenate(at), np.concatenate(names)


def _steps(radius: int) -> np.ndarray:
    """All moves of at most ``radius`` (1 or 2) in the embedding of a half."""
    one = np.concatenate([np.eye(SEGMENTS, dtype=np.int64), -np.eye(SEGMENTS, dtype=np.int64)])
    moves = [np.zeros((1, SEGMENTS), dtype=np.int64), one]
    if radius > 1:
        moves.append((one[:, None, :] + one[None, :, :]).reshape(-1, SEGMENTS))
    return np.unique(np.concatenate(moves), axis=0)


_MOVES = {r: _steps(r) for r in (1, 2)}


def subcells(cell: np.ndarray, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Points of a crowded point's members in the other half's grid, and the members.

    Of two fingerprints within 4 bits that meet at a point, one half takes 0 bits where both have it as their own, 1 where
    one has, 2 where both are next to it (or have it as their own): so a member that has it as its own goes to points
    within 2 of its other half, any other to points within 1, and the two meet again.
    """
    at, who = [], []
    for half in (0, 1):
        here = np.flatnonzero((cell & 1) == half)
        own = (embedding(fps[here], half) @ _PLACES) * 2 + half == cell[here]
        for radius, rows in ((2, here[own]), (1, here[~own])):
            for lo in range(0, len(rows), 256):
                some = rows[lo : lo + 256]
                points = embedding(fps[some], 1 - half)[:, None, :] + _MOVES[radius][None, :, :]
                row, move = np.nonzero(((points >= 0) & (points <= WIDTH)).all(axis=2))
                at.append(cell[some][row] * _POINTS + points[row, move] @ _PLACES)
                who.append(fps[some][row])
    return np.concatenate([np.zeros(0, dtype=np.int64), *at]), np.concatenate([fps[:0], *who])


def runs(sorted_rows: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple]:
    """Points, the starts and sizes of their runs and columns, from rows sorted by cell; each run comes whole, once."""

    def whole(parts: list[list[np.ndarray]]):
        at, *others = (np.concatenate(x) for x in zip(*parts, strict=True))
        starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        return at, starts, np.diff(np.r_[starts, len(at)]), *others

    held: list[list[np.ndarray]] = []
    for batch in sorted_rows:
        rows = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("cell", *columns)]
        if not len(rows[0]):
            continue
        begin = int(np.searchsorted(rows[0], rows[0][-1]))  # of the last run, which can go on in the next batch
        if held and held[0][0][0] == rows[0][-1]:
            held.append(rows)
            continue
        if held or begin:
            yield whole([*held, [x[:begin] for x in rows]])
        held = [[x[begin:] for x in rows]]
    if held:
        yield whole(held)


def linked(fps: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what is within ``bits`` among a point's fingerprints: each member to the least of its component."""
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= bits
    label, before = np.arange(len(fps)), None
    while before is None or (label != before).any():
        before = label
        label = np.where(near, label[None, :], len(fps)).min(axis=1)
        label = label[label]
    member = np.flatnonzero(label != np.arange(len(fps)))
    return fps[member], fps[label[member]]


def _pairs(sorted_cells: Iterator[pa.RecordBatch], crowd: int) -> Iterator[pa.RecordBatch]:
    """Links (a, b, null) from rows sorted by point; (a, null, cell) for a member of a point with more than ``crowd``."""

    def out(a, b, cell=None):
        if len(a):
            none = pa.nulls(len(a), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), none if b is None else pa.array(b.view(np.int64)), none if cell is None else pa.array(np.full(len(a), cell))], ["a", "b", "cell"])

    last_at, last, over = None, np.empty(0, dtype=np.uint64), False
    for batch in sorted_cells:
        at = np.concatenate([np.full(len(last), last_at if last_at is not None else 0, dtype=np.int64), batch.column("cell").to_numpy()])
        who = np.concatenate([last, batch.column("fp").to_numpy().view(np.uint64)])
        starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]]) if len(at) else np.empty(0, dtype=np.int64)
        sizes = np.diff(np.r_[starts, len(at)])
        if over and len(starts) > 1:  # the run that was over the limit ends here
            yield from out(who[: sizes[0]], None, at[0])
            starts, sizes, over = starts[1:], sizes[1:], False
        # The last run can go on in the next batch: it waits, but for what is over the limit already.
        last_at, last = (at[-1], who[starts[-1] :]) if len(at) else (last_at, last)
        two = np.flatnonzero(sizes[:-1] == 2)
        a, b = who[starts[two]], who[starts[two] + 1]
        near = np.bitwise_count(a ^ b) <= BITS
        yield from out(np.maximum(a, b)[near], np.minimum(a, b)[near])
        for i in np.flatnonzero(sizes[:-1] > 2):
            run = who[starts[i] : starts[i] + sizes[i]]
            yield from out(run, None, at[starts[i]]) if len(run) > crowd else out(*linked(run))
        if over or len(last) > crowd:
            yield from out(last[1:], None, last_at)
            last, over = last[:1], True  # one member stays to tell the run by
    if over:
        yield from out(last, None, last_at)
    elif len(last) > 1:
        yield from out(*linked(last))


def bit_cells(fps: np.ndarray, radius: int = BITS // 2) -> tuple[np.ndarray, np.ndarray]:
    """Points within ``radius`` in the grid of single-bit segments, which are values within so many bits, and the members.

    Two that share one are within twice the radius, and of two within twice the radius some value is within it of both.
    """
    flips = [0, *(1 << i for i in range(64))]
    if radius > 1:
        flips += [1 << i | 1 << j for i in range(64) for j in range(i)]
    flips = np.array(flips, dtype=np.uint64)
    return (fps[:, None] ^ flips[None, :]).ravel(), np.repeat(fps, len(flips))


def links(fps: DataFrame, crowd: int = CROWD) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column fp) whose components are those of all links within 4 bits.

    Three grids, each for the members of the crowded points of the one before: a half's, both halves', single bits'. All
    members of a point of the last are links, so that the least stands for them; the work is linear in the members.
    """
    n = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def level(df: DataFrame, *columns: str) -> DataFrame:
        def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, 8192):
                    part = batch.slice(at, 8192)
                    cell, who = (subcells if len(columns) > 1 else cells)(*(part.column(c).to_numpy(zero_copy_only=False) for c in columns))
                    for lo in range(0, len(cell), 1 << 18):
                        yield pa.RecordBatch.from_arrays([pa.array(cell[lo : lo + (1 << 18)]), pa.array(who[lo : lo + (1 << 18)])], ["cell", "fp"])

        points = df.mapInArrow(spread, "cell long, fp long").repartition(n, "cell").sortWithinPartitions("cell")
        return cut(points.mapInArrow(lambda x: _pairs(x, crowd), "a long, b long, cell long").distinct())

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                point, who = bit_cells(batch.column("fp").slice(at, 64).to_numpy(zero_copy_only=False).view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(point.view(np.int64)), pa.array(who.view(np.int64))], ["point", "fp"])

    crowded = lambda found: found.where("b is null").select("cell", F.col("a").alias("fp"))
    first = level(fps, "fp")
    all_ = first.where("b is not null").select("a", "b")
    if crowded(first).isEmpty():
        return all_
    second = level(crowded(first), "cell", "fp")
    all_ = all_.unionByName(second.where("b is not null").select("a", "b"))
    if crowded(second).isEmpty():
        return all_
    points = crowded(second).select("fp").distinct().mapInArrow(meet, "point long, fp long")
    least = points.groupBy("point").agg(F.min("fp").alias("b"), F.count("*").alias("n")).where("n > 1").drop("n")
    return all_.unionByName(points.join(least, "point").where("fp <> b").select(F.col("fp").alias("a"), "b").distinct())


def packed(df: DataFrame, rows: int | None) -> DataFrame:
    """df of about so many rows in no more partitions than these fill; as it is for None.

    Components take many rounds of small tables, and of each exchange every task leaves files, however few its rows.
    """
    return df if rows is None else df.coalesce(1 + rows // PART)


def least_of(df: DataFrame, key: str, value: str, rows: int | None = None) -> DataFrame:
    """key and its least value, dealt out by another number than the key; ``rows`` as in packed().

    A join on the key then shuffles both sides for itself, and of such a join Spark can split a key that holds a large
    part of all rows; on top of an aggregate that is dealt by the same key it can't.
    """
    other = packed(df.groupBy(F.bitwise_not(F.col(key)).alias("_other")).agg(F.min(value).alias(value)), rows)
    return other.select(F.bitwise_not("_other").alias(key), value)


def stars(edges: DataFrame) -> DataFrame:
    """(a, b): all nodes in links (a, b), in either direction, but the least of each component, with that least.

    Large and small stars in turn until no node has two links or is an end of one and the start of another: rounds grow
    as the logarithm of the longest chain, every round is aggregates and joins, and only whether to go on reaches the
    driver.
    """

    def settled(df: DataFrame) -> bool:
        ends = df.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(df.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        return packed(ends, n).groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or up = 1 and down = 1").isEmpty()

    def star(df: DataFrame, large: bool) -> DataFrame:
        sides = df.unionByName(df.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else df.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        sides = packed(sides, n)
        least = least_of(sides, "a", "b", n).select("a", F.least("b", "a").alias("least"))
        joined = packed(sides.join(least, "a"), n)
        moved = joined.where("b > a" if large else "b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
        return packed((moved if large else moved.unionByName(least.select("a", F.col("least").alias("b")))).where("a <> b").distinct(), n)

    now = renewed(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    n = now.count()
    while not settled(now):
        now = renewed(star(star(now, True), False))
    return now


def components(edges: DataFrame) -> DataFrame:
    """node and root (the least node of its component) of all nodes that are in links (a, b), in either direction."""
    now = stars(edges)
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def cluster(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 4, crowd: int = CROWD) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: the least doc_id that links within 4 bits reach.

    Texts that are null or have no words have fingerprint zero and link like any other. Repeated rows stay; a null
    doc_id is in its component but never names it, unless all of them are null. An empty table gives no rows.
    """
    docs = cut(fingerprints(df, id_col, text_col, k))
    distinct = cut(docs.groupBy("fp").agg(F.min("doc_id").alias("first")))
    labels = components(links(distinct.select("fp"), crowd))
    rooted = distinct.join(labels, distinct["fp"] == labels["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    named = rooted.select("fp", "root").join(least_of(rooted, "root", "first"), "root").select("fp", F.col("first").alias("component_id"))
    return docs.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
