"""Near copies by similarity with SimHash: long fingerprints of five-word shingles, the grid, an exact check of texts.

A similarity of 0.8 puts about 15 of 100 bits of a fingerprint apart, too many for one 64-bit value to be searched, so a
text has ``WORDS64`` of them. Each half of each goes to the grid as in ``simhash``: two texts meet in a half whose
segment popcounts are within a Manhattan distance of 2. Where they meet, the bits of another of their values are
compared, then those of all. Texts that are near in these bits, directly or by others between them, are a family: the
first value begins families by a link or so of each member of a point, then all values are looked at for what meets
between families: as pairs where an outer point has no more of these than members in them, else its members are dealt
again with the bits of all values, which leave a tree of links. So rows grow with members, never with pairs. Within a family the exact Jaccard similarity of all whole texts decides, which alone makes a link. A family's sets of
shingles are put together once; a large family is cut into blocks, and tasks get pairs of blocks.

Of pairs at 0.8 the grid misses about one in fourteen, of those at 0.85 one in a hundred; groups lose less, since any
link to one of their members is enough. Texts with the same set of shingles are one throughout.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import cut, documents, fresh, packs, renewed, slices
from sluice.llm.simhash import SEGMENTS, WIDTH, embedding, least_of, packed, runs, stars

SHINGLE, WORDS64 = 5, 8
#: Similarity from which two texts are near copies, as a fraction.
SIMILAR = (4, 5)
#: Most differing bits of one 64-bit value, and share of all bits, of a pair that is checked: at 0.8 they are 9.7 and
#: 0.15 on average, and both limits lie over three standard deviations above.
NEAR, NEAR_ALL = 20, 0.22
#: A point with more members than this begins families by links to leaders within CLOSE bits, not by all its pairs.
DENSE, CLOSE = 8, 12
#: Segments of a half that say nothing of where a point is dealt: a task adds the points next to a row's in these by itself.
INNER = 10
#: Texts, and bytes of hashed shingles, of a block of a family.
BLOCK, BLOCK_BYTES = 512, 16 << 20
#: Texts' digests are broadcast up to this number (16 bytes each and a number), else joined.
BROADCAST = 500_000
_MOST = int(NEAR_ALL * 64 * WORDS64)
_PLACES = np.array([(WIDTH + 1) ** i for i in range(SEGMENTS)], dtype=np.int64)
_INNER, _POINTS = (WIDTH + 1) ** INNER, (WIDTH + 1) ** SEGMENTS
_ODD = np.random.default_rng(8).integers(0, 1 << 63, WORDS64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: str | None, k: int = SHINGLE) -> np.ndarray:
    """Ascending distinct hashes of all runs of k words; of all words if there are fewer."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    joined, k = b" ".join(words), min(k, len(words))
    ends = list(accumulate(len(w) + 1 for w in words))
    return np.unique(np.array([xxhash.xxh64_intdigest(joined[s : e - 1]) for s, e in zip([0, *ends], ends[k - 1 :], strict=False)], dtype=np.uint64))


def alike(one: np.ndarray, two: np.ndarray) -> bool:
    """Whether the Jaccard similarity of two sets of shingles is SIMILAR or more."""
    both = len(np.intersect1d(one, two, assume_unique=True))
    return SIMILAR[1] * both >= SIMILAR[0] * (len(one) + len(two) - both)


def long_fingerprint(own: np.ndarray) -> np.ndarray:
    """WORDS64 values of 64 bits from a set of shingles (not empty): a bit is set if over half of its hashes have it."""
    counts = np.zeros((WORDS64, 64), dtype=np.int64)
    for at in range(0, len(own), 255 * 64):
        part = own[at : at + 255 * 64]
        for j, odd in enumerate(_ODD):
            mixed = (part ^ (part >> np.uint64(32))) * odd
            mixed ^= mixed >> np.uint64(29)
            bits = np.unpackbits(mixed.view(np.uint8), bitorder="little").reshape(-1, 64)
            whole = len(bits) // 255 * 255
            counts[j] += bits[:whole].reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64) + bits[whole:].sum(axis=0, dtype=np.uint8)
    return np.packbits(2 * counts > len(own), axis=1, bitorder="little").view("<u8")[:, 0]


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for pack in packs(batches, 4 << 20):
        sets = [shingles(t) for t in pack["text"]]
        prints = [long_fingerprint(s).view(np.int64) if len(s) else None for s in sets]
        same = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
        columns = [pa.array(pack["doc_id"], pa.int64()), pa.array(pack["digest"], pa.string()), pa.array(same, pa.binary()), pa.array(prints, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "digest", "same", "fp"])


def _outer(values: np.ndarray, grid: int) -> tuple[np.ndarray, np.ndarray]:
    """Of both halves' grid points the values' own, as 2 * point, and those next to them outside the inner segments, as
    2 * point + 1; and the places of the values. Points of grids with other numbers never meet."""
    at, who = [], []
    for half in (0, 1):
        counts = embedding(values, half)
        own = counts @ _PLACES + (2 * grid + half) * _POINTS
        at.append(2 * own)
        who.append(np.arange(len(values)))
        for step, open_ in ((1, counts < WIDTH), (-1, counts > 0)):
            row, place = np.nonzero(open_[:, INNER:])
            at.append(2 * (own[row] + step * _PLACES[INNER + place]) + 1)
            who.append(row)
    return np.concatenate(at), np.concatenate(who)


def _spread(values: Sequence[int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Outer grid points of both halves of these values, each with the next value of the same text and its family."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                prints = np.array(part.column("fp").to_pylist(), dtype=np.int64).reshape(-1, WORDS64)
                for j in values:
                    point, who = _outer(prints[:, j], j)
                    word, family = prints[:, (j + 1) % WORDS64][who], part.column("family").to_numpy(zero_copy_only=False)[who]
                    yield pa.RecordBatch.from_arrays([pa.array(point), pa.array(word), pa.array(family)], ["at", "word", "family"])

    return run


def opened(dealt: DataFrame) -> DataFrame:
    """All grid points (cell) of rows (at, word, family) of _spread(): of an own point also those next to it in the inner segments."""
    cell, places = F.expr("at div 2"), [(WIDTH + 1) ** i for i in range(INNER)]
    count = lambda place: F.expr(f"at div {2 * place} % {WIDTH + 1}")
    around = [F.when(count(p) < WIDTH, cell + p) for p in places] + [F.when(count(p) > 0, cell - p) for p in places]
    points = F.when(F.expr("at % 2 = 1"), F.array(cell)).otherwise(F.array(cell, *around))
    return dealt.select(F.explode(points).alias("cell"), "word", "family").where("cell is not null")


def _leaders(words: np.ndarray) -> np.ndarray:
    """For each of one point's members the place of a leader within CLOSE bits: the first that none before leads."""
    leader = np.full(len(words), -1)
    while len(free := np.flatnonzero(leader < 0)):
        leader[free[np.bitwise_count(words[free] ^ words[free[0]]) <= CLOSE]] = free[0]
    return leader


def _apart(family: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether members are not known to be of one family; 0 is none."""
    return (family[i] != family[j]) | (family[i] == 0)


def _near(words: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of places in one point that are near."""
    step = max(1, (1 << 22) // len(words))
    for at in range(0, len(words), step):
        i, j = np.nonzero(np.bitwise_count(words[at : at + step, None] ^ words[None, :]) <= NEAR)
        before = j < i + at
        yield i[before] + at, j[before]


def _leads(words: np.ndarray, leader: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A link of each member to its leader, and of each leader but the first to the closest before it, if that is near."""
    heads, others = np.flatnonzero(leader == np.arange(len(words))), np.flatnonzero(leader != np.arange(len(words)))
    a, b = [others], [leader[others]]
    step = max(1, (1 << 22) // len(heads))
    for at in range(0, len(heads), step):
        bits = np.bitwise_count(words[heads[at : at + step], None] ^ words[heads][None, :])
        bits[np.arange(at, at + len(bits))[:, None] <= np.arange(len(heads))[None, :]] = 64 + 1
        closest = bits.argmin(axis=1)
        near = bits[np.arange(len(bits)), closest] <= NEAR
        a.append(heads[at : at + step][near])
        b.append(heads[closest[near]])
    return np.concatenate(a), np.concatenate(b)


def _small(starts: np.ndarray, sizes: np.ndarray, words: np.ndarray, family: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the near pairs, but of one family, of all points with at most DENSE members."""
    end = np.repeat(starts + sizes, sizes)
    place, shift = np.flatnonzero((np.repeat(sizes, sizes) > 1) & (np.repeat(sizes, sizes) <= DENSE)), 1
    while len(place := place[place + shift < end[place]]):
        bits = np.bitwise_count(words[place] ^ words[place + shift])
        near = place[(bits <= NEAR) & (bits > 0) & _apart(family, place, place + shift)]
        yield near, near + shift
        shift += 1


def _distinct(*columns: np.ndarray) -> tuple[np.ndarray, ...]:
    """Each row once, in order of the columns."""
    order = np.lexsort(columns[::-1])
    columns = tuple(c[order] for c in columns)
    new = np.ones(len(order), bool)
    new[1:] = reduce(np.logical_or, [c[1:] != c[:-1] for c in columns])
    return tuple(c[new] for c in columns)


def _members(words: np.ndarray, family: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    own, of = np.unique(np.stack([words, family.view(np.uint64)]), axis=1)
    return own, of


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b) of the points' words that begin families: of small points all near ones but of one family, of dense
    ones a link or so of each member. What meets in several points is mostly one row, as these lie side by side."""
    for _, starts, sizes, words, family in runs(batches, "word", "family"):
        words = words.view(np.uint64)
        pairs = [(words[i], words[j]) for i, j in _small(starts, sizes, words, family)]
        for i in np.flatnonzero(sizes > DENSE):
            own, of = _members(words[starts[i] : starts[i] + sizes[i]], family[starts[i] : starts[i] + sizes[i]])
            a, b = _leads(own, _leaders(own))
            other = _apart(of, a, b)
            pairs.append((own[a[other]], own[b[other]]))
        a, b = (np.concatenate([words[:0], *(p[i] for p in pairs)]) for i in (0, 1))
        a, b = _distinct(np.maximum(a, b), np.minimum(a, b))
        yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])


def _between(words: np.ndarray, family: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """Places of one point's near pairs between families, and none; if they are more than its members, no pairs, and
    the places of all that are in one. Within its largest family no two are compared."""
    known, size = np.unique(family[family != 0], return_counts=True)
    largest = family == (known[size.argmax()] if len(known) else 1)
    rest, inside = np.flatnonzero(~largest), np.zeros(len(words), bool)
    order = np.concatenate([rest, np.flatnonzero(largest)])
    a, b, found = [order[:0]], [order[:0]], 0
    step = max(1, (1 << 22) // len(words))
    for at in range(0, len(rest), step):
        i, j = np.nonzero(np.bitwise_count(words[rest[at : at + step], None] ^ words[order][None, :]) <= NEAR)
        after = j > i + at
        i, j = rest[i[after] + at], order[j[after]]
        other = _apart(family, i, j) & (words[i] != words[j])
        i, j = i[other], j[other]
        inside[i] = inside[j] = True
        found += len(i)
        if found <= len(words):
            a.append(i)
            b.append(j)
    if found > len(words):
        return order[:0], order[:0], np.flatnonzero(inside)
    return np.concatenate(a), np.concatenate(b), None


def _cross(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All near pairs (a, b, null) of the points' words between families. Of an outer point with more pairs than members in
    them, or with a point like that, (a, null, outer) for each such member instead."""
    for cell, starts, sizes, words, family in runs(batches, "word", "family"):
        words, outer = words.view(np.uint64), cell // _INNER
        pairs = [(outer[i], words[i], words[j]) for i, j in _small(starts, sizes, words, family)]
        at, who = [outer[:0]], [words[:0]]
        for i in np.flatnonzero(sizes > DENSE):
            own, of = _members(words[starts[i] : starts[i] + sizes[i]], family[starts[i] : starts[i] + sizes[i]])
            a, b, crowd = _between(own, of)
            pairs.append((np.full(len(a), outer[starts[i]]), own[a], own[b]))
            if crowd is not None:
                who.append(own[crowd])
                at.append(np.full(len(crowd), outer[starts[i]]))
        point, a, b = (np.concatenate([none, *(p[i] for p in pairs)]) for i, none in enumerate((outer[:0], words[:0], words[:0])))
        point, a, b = _distinct(point, np.maximum(a, b), np.minimum(a, b))
        ends = _distinct(np.r_[point, point], np.r_[a, b])
        each, n = np.unique(point, return_counts=True)
        many = np.union1d(each[n > np.unique(ends[0], return_counts=True)[1]], np.concatenate(at))
        again = np.isin(ends[0], many)
        at, who = _distinct(np.concatenate([*at, ends[0][again]]), np.concatenate([*who, ends[1][again]]))
        few = ~np.isin(point, many)
        a, b = _distinct(a[few], b[few])
        none = lambda x: pa.nulls(len(x), pa.int64())
        columns = [pa.array(np.r_[a, who].view(np.int64)), pa.concat_arrays([pa.array(b.view(np.int64)), none(who)]), pa.concat_arrays([none(a), pa.array(at)])]
        yield pa.RecordBatch.from_arrays(columns, ["a", "b", "outer"])


def tree(prints: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of what is within _MOST bits among long fingerprints (a row each) the places of links that join the same groups,
    fewer than there are groups; members of a group count as joined."""
    group = np.unique(group, return_inverse=True)[1]
    by, free, a, b = np.argsort(group, kind="stable"), np.ones(len(group), bool), [], []
    first = np.searchsorted(group[by], np.arange(group.max(initial=-1) + 2))
    for g in range(len(first) - 1):
        ahead = by[first[g] : first[g + 1]]
        if not free[ahead[0]]:
            continue
        free[ahead] = False
        while len(ahead) and len(left := np.flatnonzero(free)):
            step = max(1, (1 << 20) // len(left))
            here, ahead = ahead[:step], ahead[step:]
            bits = sum(np.bitwise_count(prints[here, None, j] ^ prints[None, left, j]).astype(np.uint16) for j in range(prints.shape[1]))
            near = bits <= _MOST
            hit = np.flatnonzero(near.any(axis=0))
            joined, one = np.unique(group[left[hit]], return_index=True)
            a += left[hit[one]].tolist()
            b += here[near[:, hit[one]].argmax(axis=0)].tolist()
            new = np.concatenate([here[:0], *(by[first[x] : first[x + 1]] for x in joined)])
            free[new] = False
            ahead = np.concatenate([ahead, new])
    return np.array(a, np.int64), np.array(b, np.int64)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) of nodes that join what is near in all bits at each crowded outer point (cell), from rows sorted by it."""
    for _, starts, sizes, node, family, *prints in runs(batches, "node", "family", *(f"fp{j}" for j in range(WORDS64))):
        prints = np.stack(prints, axis=1).view(np.uint64)
        for start, size in zip(starts, sizes, strict=True):
            here = slice(start, start + size)
            a, b = tree(prints[here], np.where(family[here] > 0, family[here], -1 - node[here]))
            yield pa.RecordBatch.from_arrays([pa.array(node[here][a]), pa.array(node[here][b])], ["a", "b"])


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """How many shingles each two of the sets share."""
    m = len(sets)
    ids, at = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(m), [len(s) for s in sets])
    often = np.flatnonzero(np.bincount(at, minlength=len(ids)) > 1)
    column = np.full(len(ids), -1)
    column[often] = np.arange(len(often))
    place = column[at]
    row, place = row[place >= 0], place[place >= 0]
    order = np.argsort(place, kind="stable")
    row, place = row[order], place[order]
    found = np.zeros((m, m), np.float32)
    step = max(64, (1 << 23) // max(1, m))  # columns that are held at once
    for lo in range(0, len(often), step):
        here = slice(*np.searchsorted(place, (lo, lo + step)))
        held = np.zeros((m, min(step, len(often) - lo)), np.float32)
        held[row[here], place[here] - lo] = 1
        found += held @ held.T
    return found.astype(np.int64)


def similar(sets: list[np.ndarray]) -> np.ndarray:
    """The least place that links of SIMILAR or more lead to from each of the sets."""
    size, both = np.array([len(s) for s in sets], np.int64), overlaps(sets)
    near = SIMILAR[1] * both >= SIMILAR[0] * (size[:, None] + size[None, :] - both)
    np.fill_diagonal(near, True)
    label, before = np.arange(len(sets)), None
    while before is None or (label != before).any():
        before = label
        label = np.where(near, label[None, :], len(sets)).min(axis=1)
        label = label[label]
    return label


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) of texts that are alike, from rows (family, one, two, node, own) sorted by the first three."""
    key, nodes, sets = None, [], []

    def out():
        label = similar(sets) if len(sets) > 1 else np.zeros(len(sets), np.int64)
        at = [i for i, x in enumerate(label) if x != i]
        return pa.RecordBatch.from_arrays([pa.array([nodes[i] for i in at], pa.int64()), pa.array([nodes[label[i]] for i in at], pa.int64())], ["a", "b"])

    for batch in batches:
        for *group, node, own in zip(*(batch.column(c).to_pylist() for c in ("family", "one", "two", "node", "own")), strict=True):
            if group != key:
                yield out()
                key, nodes, sets = group, [], []
            nodes.append(node)
            sets.append(np.frombuffer(own, np.uint64))
    yield out()


def _owned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as their sets of shingles."""
    for batch in batches:
        for part in slices([batch], 4 << 20):
            yield pa.RecordBatch.from_arrays([part.column("family"), part.column("node"), pa.array([shingles(t).tobytes() for t in part.column("text").to_pylist()], pa.binary())], ["family", "node", "own"])


def _digest(text: Column) -> Column:
    """A null text has the digest of an empty one with a mark, so both are told apart."""
    return F.md5(F.coalesce(F.concat(F.lit("t"), text), F.lit("")).cast("binary"))


def apart(one: str, two: str) -> Column:
    """Differing bits of two long fingerprints."""
    return reduce(Column.__add__, [F.bit_count(F.col(one)[j].bitwiseXOR(F.col(two)[j])) for j in range(WORDS64)])


def checked(families: DataFrame, sets: DataFrame, docs: DataFrame) -> DataFrame:
    """Links (a, b) between nodes of one family (node, family) whose whole texts are alike.

    Each text goes to its family once. A family beyond a block's texts or bytes is dealt to blocks, and every two of its
    blocks are one group: the rows of a family of n texts grow as n * n / BLOCK, and no pair of texts is ever a row.
    """
    needed = cut(families.join(sets, "node").select("node", "family", F.col("first.digest").alias("digest")))
    wanted = F.broadcast(needed) if needed.count() <= BROADCAST else needed
    texts = docs.join(wanted, "digest").groupBy("family", "node").agg(F.min("text").alias("text"))
    owned = cut(texts.mapInArrow(_owned, "family long, node long, own binary"))
    sizes = owned.groupBy("family").agg(F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum(F.octet_length("own")) / BLOCK_BYTES)).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    pair = F.when(F.col("blocks") == 1, F.array(F.struct(F.lit(0).alias("one"), F.lit(0).alias("two")))).otherwise(F.expr("transform(filter(sequence(0, blocks - 1), x -> x <> block), x -> struct(least(x, block) AS one, greatest(x, block) AS two))"))
    dealt = owned.join(sizes, "family").withColumn("block", block).withColumn("pair", F.explode(pair)).select("family", "pair.one", "pair.two", "node", "own")
    return dealt.repartition("family", "one", "two").sortWithinPartitions("family", "one", "two").mapInArrow(_linked, "a long, b long")


def contracted(edges: DataFrame) -> DataFrame:
    """Edges (a, b) with the same components, nearly as few as nodes: each node's to its least neighbour, and of all
    others what is left between these. In a dense group most nodes have the same least neighbour."""
    edges = renewed(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    n = edges.count()
    edges = packed(edges, n)
    sides = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = cut(packed(least_of(packed(sides, n), "a", "b", n).select("a", F.least("a", "b").alias("least")), n))
    one, two = least.select("a", F.col("least").alias("x")), least.select(F.col("a").alias("b"), F.col("least").alias("y"))
    left = packed(packed(edges.join(one, "a"), n).join(two, "b"), n).where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct()
    return left.unionByName(least.where("a <> least").select("a", F.col("least").alias("b")))


def members(stars_: DataFrame) -> DataFrame:
    """node and family, which is its least node, of all nodes in stars (a, b)."""
    return stars_.select(F.col("a").alias("node"), F.col("b").alias("family")).unionByName(stars_.select(F.col("b").alias("node"), F.col("b").alias("family")).distinct())


def keep_first(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component of near copies: that of the least id, null ids last, then of the least text digest.

    Texts that are null or have no words are copies of each other. Rows that repeat both id and text count as one, of
    which one stays, so null and repeated ids lose or repeat nothing else; all columns stay as they are.
    """
    docs = documents(df, id_col, text_col).withColumn("digest", _digest(F.col("text")))
    signed = docs.mapInArrow(_signed, "doc_id long, digest string, same binary, fp array<long>")
    rows = signed.groupBy("same", "doc_id", "digest").agg(F.first("fp").alias("fp"), F.count("*").alias("n"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), "digest", "n")
    sets = cut(rows.groupBy("same").agg(F.min(order).alias("first"), F.first("fp").alias("fp")).drop("same").withColumn("node", F.monotonically_increasing_id()))
    full = sets.where("fp is not null")
    # A node is known by its values in the grid; of nodes that share a value the least stands for all, and all meet it.
    # Values are many, so they go with numbers of nodes only; the bits of pairs that met are looked up at their nodes.
    named = full.select("node", F.explode("fp").alias("word"))
    rep = cut(named.groupBy("word").agg(F.min("node").alias("rep"), F.max("node").alias("last")))
    shared = rep.where("rep < last").select("word", F.col("rep").alias("b"))
    equal = named.join(shared, "word").where(F.col("node") != F.col("b")).select(F.col("node").alias("a"), "b")
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def near(pairs: DataFrame) -> DataFrame:
        one, two = full.select(F.col("node").alias("a"), F.col("fp").alias("fp_a")), full.select(F.col("node").alias("b"), F.col("fp").alias("fp_b"))
        return pairs.join(one, "a").join(two, "b").where(apart("fp_a", "fp_b") <= _MOST).select("a", "b")

    def points(of: DataFrame, values: Sequence[int]) -> DataFrame:
        # Points that differ in inner segments alone are dealt together, as one row of each text until they are.
        dealt = of.select("fp", "family").mapInArrow(_spread(values), "at long, word long, family long").repartition(n, F.expr(f"at div {2 * _INNER}"))
        return opened(dealt).sortWithinPartitions("cell")

    def at_nodes(met: DataFrame) -> DataFrame:
        one, two = rep.select(F.col("word").alias("a"), F.col("rep").alias("x")), rep.select(F.col("word").alias("b"), F.col("rep").alias("y"))
        return met.join(one, "a").join(two, "b").where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b"))

    # Of a large group of near copies almost all pairs meet somewhere: with its members joined by one value, few are left.
    met = cut(points(full.withColumn("family", F.lit(0).cast("long")), range(1)).mapInArrow(_meet, "a long, b long").distinct())
    begun = stars(contracted(near(at_nodes(met).unionByName(equal))))
    known = full.join(members(begun), "node", "left").select("node", "fp", F.coalesce(F.col("family") + 1, F.lit(0)).alias("family"))
    met = cut(points(known, range(WORDS64)).mapInArrow(_cross, "a long, b long, outer long").distinct())
    found = near(at_nodes(met.where("b is not null").select("a", "b"))).unionByName(begun)
    # Members that are dealt again with all bits meet at least as often as before, and no pair of them is a row.
    crowded = met.where("b is null").select(F.col("outer").alias("cell"), F.col("a").alias("word"))
    if not crowded.isEmpty():
        named = crowded.join(rep.select("word", F.col("rep").alias("node")), "word").select("cell", "node").distinct()
        all_bits = named.join(known, "node").select("cell", "node", "family", *[F.col("fp")[j].alias(f"fp{j}") for j in range(WORDS64)])
        found = found.unionByName(all_bits.repartition(n, "cell").sortWithinPartitions("cell").mapInArrow(_joined, "a long, b long").distinct())
    families = members(stars(contracted(found)))
    labels = stars(checked(families, sets, docs))
    rooted = sets.join(labels, F.col("node") == F.col("a"), "left").select("first", F.coalesce("b", "node").alias("root"))
    id_, digest, n_rows, own = (fresh(df, c) for c in ("id", "digest", "n", "own_digest"))
    first = cut(least_of(cut(rooted), "root", "first").select(F.col("first.id").alias(id_), F.col("first.digest").alias(digest), F.col("first.n").alias(n_rows)))
    keyed = df.withColumn(own, _digest(F.col(text_col).cast("string")))
    here = F.col(id_col).cast("long").eqNullSafe(F.col(id_)) & (F.col(own) == F.col(digest))
    kept = keyed.join(first.where(F.col(n_rows) == 1), here, "left_semi")
    if not (repeated := first.where(F.col(n_rows) > 1)).isEmpty():
        kept = kept.unionByName(keyed.join(repeated, here, "left_semi").dropDuplicates([id_col, own]))
    return kept.drop(own)
