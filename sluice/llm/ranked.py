"""Ranked lexical search of many items at once: term sets that items share are scored once for each document.

Documents are read once for a block of items and kept as the block's terms with their counts. Shared sets are mined from
the items: terms that occur in the same items are one set, then neighbouring sets that recur are joined, again and again.
What comes of it is a graph in which a node's accumulators, one for each document, are the sum of two others. Tasks fill
the accumulators of terms for a slice of documents, add them up along the graph, each node once, and keep the best of
each item.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import cut, slices

#: Fixed value: what a term is, in UTF-8 with A-Z in lower case; all bytes from 0x80 are parts of terms.
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
_GAP = re.compile(rb"[^0-9a-z\x80-\xff]")
#: Distinct terms over the items of a block, if it has more than one item.
BLOCK_TERMS = 500_000
#: Bytes of accumulators that a task holds, and of a text that are cut into terms at once.
ACCUMULATORS, WINDOW = 64 << 20, 1 << 20
_COUNTS = "doc_id long, n long, terms binary, counts binary"
_BEST = "item int, doc_id long, score long, part int"


def term_counts(text: bytes | None) -> tuple[int, Counter]:
    """How many terms a text has, and how often each; null has none. A long text is cut between terms."""
    data, start, found, n = (text or b"").lower(), 0, Counter(), 0
    while start < len(data):
        gap = _GAP.search(data, start + WINDOW) if start + WINDOW < len(data) else None
        end = gap.start() if gap else len(data)
        words = TERM.findall(data, start, end)
        n += len(words)
        found.update(words)
        start = end
    return n, found


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


@dataclass(frozen=True)
class Graph:
    """Nodes 0 to n_terms - 1 are terms; node n_terms + i is the sum of left[i] and right[i]; an item sums its tops."""

    n_terms: int
    left: np.ndarray
    right: np.ndarray
    levels: list[tuple[int, int]]
    tops: list[np.ndarray]

    @property
    def additions(self) -> int:
        """Of two numbers, for each document."""
        return len(self.left) + sum(max(0, len(t) - 1) for t in self.tops)


def share(items: Sequence[Sequence[int]], n_terms: int) -> Graph:
    """Mines term sets that several items hold. ``items`` has each item's distinct terms."""
    holders: dict[int, list[int]] = {}
    for i, terms in enumerate(items):
        for t in terms:
            holders.setdefault(t, []).append(i)
    same: dict[tuple, list[int]] = {}
    for t in sorted(holders):
        same.setdefault(tuple(holders[t]), []).append(t)
    left, right, known = [], [], {}

    def add(a: int, b: int) -> int:
        pair = (min(a, b), max(a, b))
        if pair not in known:
            known[pair] = n_terms + len(left)
            left.append(pair[0])
            right.append(pair[1])
        return known[pair]

    rows: list[list[int]] = [[] for _ in items]
    for held, terms in sorted(same.items(), key=lambda x: (-len(x[0]), x[0])):  # what most items hold stands first
        if len(held) == 1:
            rows[held[0]] += terms
            continue
        while len(terms) > 1:
            terms = [add(*terms[i : i + 2]) if i + 1 < len(terms) else terms[i] for i in range(0, len(terms), 2)]
        for i in held:
            rows[i].append(terms[0])
    while True:
        counts = Counter((min(p), max(p)) for row in rows for p in zip(row, row[1:]))
        again = {p: c for p, c in counts.items() if c > 1}
        if not again:
            break
        joined = False
        for i, row in enumerate(rows):
            out, at = [], 0
            while at < len(row):
                here, after = (again.get((min(p), max(p)), 0) if len(p := row[a : a + 2]) == 2 else 0 for a in (at, at + 1))
                if here and here >= after:
                    out.append(add(row[at], row[at + 1]))
                    at, joined = at + 2, True
                else:
                    out.append(row[at])
                    at += 1
            rows[i] = out
        if not joined:
            break
    depth: list[int] = []
    for a, b in zip(left, right, strict=True):
        depth.append(1 + max(depth[x - n_terms] if x >= n_terms else 0 for x in (a, b)))
    order = sorted(range(len(left)), key=lambda i: depth[i])  # a node's parts lie on lower levels
    new = {n_terms + old: n_terms + i for i, old in enumerate(order)}
    name = lambda x: new.get(x, x)
    levels, start = [], 0
    for i in range(1, len(order) + 1):
        if i == len(order) or depth[order[i]] != depth[order[start]]:
            levels.append((start, i))
            start = i
    return Graph(n_terms, np.array([name(left[i]) for i in order], np.int64), np.array([name(right[i]) for i in order], np.int64), levels, [np.array([name(x) for x in row], np.int64) for row in rows])


def accumulate(graph: Graph, scores: np.ndarray) -> np.ndarray:
    """Items x documents: ``scores`` (nodes x documents) has the terms' rows filled; sums follow level by level."""
    for start, end in graph.levels:
        scores[graph.n_terms + start : graph.n_terms + end] = scores[graph.left[start:end]] + scores[graph.right[start:end]]
    return np.array([scores[t].sum(axis=0) for t in graph.tops], np.int64).reshape(len(graph.tops), scores.shape[1])


class _Best:
    """The k best (score, doc_id) of each item among what was seen; equal scores by ascending id, null ids last."""

    def __init__(self, n_items: int, k: int):
        self.k, none = k, np.empty(0, np.int64)
        self.held = [(none, none, none) for _ in range(n_items)]
        self.least = np.ones(n_items, np.int64)

    def offer(self, scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
        hopeful = scores >= self.least[:, None]
        for i in np.flatnonzero(hopeful.any(axis=1)):
            at = np.flatnonzero(hopeful[i])
            s, d, n = (np.concatenate(x) for x in zip(self.held[i], (scores[i, at], ids[at], nulls[at]), strict=True))
            first = np.lexsort((d, n, -s))[: self.k]
            self.held[i] = s[first], d[first], n[first]
            if len(first) == self.k:
                self.least[i] = s[first[-1]]


def _count(vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.value
        for batch in slices(batches, 16 << 20):
            rows = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
                n, found = term_counts(text)
                if n:
                    known = [(number[t], c) for t, c in found.items() if t in number]
                    rows.append((doc, n, np.array([t for t, _ in known], np.int32).tobytes(), np.array([c for _, c in known], np.int32).tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [[]] * 4, (pa.int64(), pa.int64(), pa.binary(), pa.binary()), strict=True)], names=["doc_id", "n", "terms", "counts"])

    return run


def _holders(n_terms: int):
    """How many of a task's documents hold each term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(n_terms, np.int64)
        for batch in batches:
            held += np.bincount(np.frombuffer(b"".join(batch.column("terms").to_pylist()), np.int32), minlength=n_terms)
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(held[some], pa.int64())], names=["term", "df"])

    return run


def _score(shared, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        graph, weights, n_docs, n_terms = shared.value
        nodes, best = graph.n_terms + len(graph.left), _Best(len(graph.tops), k)
        step = max(1, ACCUMULATORS // (8 * (nodes + len(graph.tops))))
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                terms, counts = ([np.frombuffer(x, np.int32) for x in part.column(c).to_pylist()] for c in ("terms", "counts"))
                size = np.array([len(x) for x in terms], np.int64)
                long = np.array([50 + (50 * n * n_docs) // n_terms for n in part.column("n").to_pylist()], np.int64)
                column, term, tf = np.repeat(np.arange(part.num_rows), size), np.concatenate(terms), np.concatenate(counts).astype(np.int64)
                scores = np.zeros((nodes, part.num_rows), np.int64)
                scores[term, column] = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * long[column]))
                ids = part.column("doc_id")
                best.offer(accumulate(graph, scores), ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False).astype(np.int64))
        place = TaskContext.get().partitionId()
        for item, (s, d, n) in enumerate(best.held):
            if len(s):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(s), item), pa.int32()), pa.array(d, pa.int64(), mask=n.astype(bool)), pa.array(s, pa.int64()), pa.array(np.full(len(s), place), pa.int32())], names=["item", "doc_id", "score", "part"])

    return run


def _blocks(items: DataFrame, most: int) -> Iterator[list[tuple]]:
    """Lists of (item_id, distinct terms) of at most ``most`` terms in all, or one item; the driver holds one at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4 << 20):
            terms = [sorted(term_counts(t)[1]) for t in batch.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), pa.array(terms, pa.list_(pa.binary()))], names=["item_id", "terms"])

    kind = items.schema["item_id"].dataType.simpleString()
    block, held = [], 0
    for row in items.mapInArrow(run, f"item_id {kind}, terms array<binary>").toLocalIterator():
        if block and held + len(row.terms) > most:
            yield block
            block, held = [], 0
        block.append((row.item_id, [bytes(t) for t in row.terms]))
        held += len(row.terms)
    if block:
        yield block


def rank(docs: DataFrame, items: DataFrame, k: int = 50, doc_id: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", block_terms: int = BLOCK_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score: each item's k best documents with a score above 0, equal scores by ascending id.

    Terms are runs of ASCII letters (lower-cased), digits and all that isn't ASCII. The score sums, over the item's
    distinct terms, weight * (10^9 tf div (1000 tf + 20 m)) in whole numbers; m follows the document's length and the
    mean. Null texts have no terms and count for nothing. A null document id is ranked like any other, after equal
    scores; rows with the same id are documents of their own, and so are items. An empty table gives no rows. An item's
    columns are its id and text; others on either side don't matter. Documents are read once for each block of items.
    """
    spark = docs.sparkSession
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    asked = items.select(F.col(item_id).alias("item_id"), F.col(item_text).cast("string").alias("text"))
    kind, out = asked.schema["item_id"].dataType.simpleString(), None
    for block in _blocks(asked, block_terms):
        vocabulary = {t: i for i, t in enumerate(sorted({t for _, terms in block for t in terms}))}
        sent = spark.sparkContext.broadcast(vocabulary)
        counted = cut(own.mapInArrow(_count(sent), _COUNTS))
        n_docs, n_terms = counted.agg(F.count("*"), F.sum("n")).first()
        if not n_docs or not vocabulary:
            sent.destroy()
            continue
        weights = np.full(len(vocabulary), 0, np.int64)
        for term, df in counted.select("terms").mapInArrow(_holders(len(vocabulary)), "term int, df long").groupBy("term").agg(F.sum("df")).toLocalIterator():
            weights[term] = weight(n_docs, df)
        graph = share([[i for i in (vocabulary[t] for t in terms) if weights[i] > 0] for _, terms in block], len(vocabulary))
        shared = spark.sparkContext.broadcast((graph, weights, n_docs, n_terms))
        best = counted.mapInArrow(_score(shared, k), _BEST)
        fan = max(1, math.isqrt(counted.rdd.getNumPartitions()))
        order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
        first = best.withColumn("rank", F.row_number().over(Window.partitionBy("item", F.col("part") % fan).orderBy(*order))).where(F.col("rank") <= k)
        last = first.drop("rank", "part").withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)
        names = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(block)], f"item int, item_id {kind}")
        found = cut(last.join(names, "item").select("item_id", "rank", "doc_id", "score"))
        sent.destroy()
        shared.destroy()
        out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long") if out is None else out
