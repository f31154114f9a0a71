"""Benchmark passages in documents by a distributed positional inverted index.

``build`` makes the index: a row for each block of documents, with the sorted postings (term, position) of all their
words, where positions run through the block. It is a table like any other, so it can be written and asked again with
other benchmarks. A phrase starts with the postings of its rarest term in the block, moved back by that term's offset;
the lists of its other terms are intersected next, rarer ones first, each moved back by its own offset. Within a
tolerance of 0 positions that is the exact phrase; a wider one gives proximity matches. Items come in blocks of bounded
size, one after the other, so what the driver holds and each task is sent doesn't grow with the benchmark. A term is
known by 64 bits of its word.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import cut, documents, keep_where, packs

WINDOW = 10
#: Largest text of benchmark items, in bytes, that is sent to tasks at once; more items take more passes.
ITEM_BLOCK = 16 << 20
#: Text of the documents of an index block, in bytes, about.
DOC_BLOCK = 8 << 20
#: Postings that a search starts from at a time.
STARTS = 1 << 21
_TO_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or chr(b).isalnum() else 32 for b in range(256))
_INDEX = "row long, doc_ids binary, lengths binary, terms binary, counts binary, positions binary"


def words(text: str | None) -> list[bytes]:
    """Runs of digits, lower-cased A-Z and characters beyond ASCII."""
    return (text or "").encode().translate(_TO_WORDS).split()


class _Numbers(dict):
    """Words to numbers in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _ranked(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Ascending hashes of the distinct words, and the words of all texts, in turn, as ranks of these."""
    number, ids = _Numbers(), array("i")
    for t in texts:
        ids.extend(map(number.__getitem__, t))
    hashes, rank = np.unique(np.fromiter(map(xxhash.xxh64_intdigest, number), dtype=np.uint64, count=len(number)), return_inverse=True)
    return hashes, rank.astype(np.int32)[np.frombuffer(ids, dtype=np.int32)] if ids else np.zeros(0, dtype=np.int32)


class Phrases:
    """The windows of some items: their words as ranks of term hashes, and where each window begins and whose it is."""

    def __init__(self, items: list[tuple[str, str | None]], window: int = WINDOW):
        found = [words(text) for _, text in items]
        self.items = [item for item, _ in items]
        self.terms, self.tokens = _ranked(found)
        lengths = np.array([len(w) for w in found], dtype=np.int64)
        begin = np.cumsum(lengths) - lengths
        n_windows = np.where(lengths > 0, np.maximum(lengths - window, 0) + 1, 0)
        of = np.repeat(np.arange(len(items)), n_windows)
        start = np.repeat(begin, n_windows) + np.arange(n_windows.sum()) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
        size = np.minimum(lengths, window)[of]
        self.windows = {int(n): (start[size == n].astype(np.int32), of[size == n].astype(np.int32)) for n in np.unique(size)}


class Index:
    """Postings of a block of documents: those of term t are positions[first[t]:first[t + 1]], ascending."""

    def __init__(self, doc_ids: np.ndarray, lengths: np.ndarray, terms: np.ndarray, counts: np.ndarray, positions: np.ndarray, gap: int = WINDOW):
        """``gap`` free positions after each text keep phrases from running into the next."""
        self.doc_ids, self.lengths, self.terms, self.counts = doc_ids, lengths, terms, counts
        self.first = np.r_[0, np.cumsum(counts)]
        self.starts = np.r_[0, np.cumsum(lengths + gap)]
        self.positions = positions + np.repeat(np.arange(len(lengths)) * gap, lengths)[positions]
        self.span = int(self.starts[-1]) + gap

    @staticmethod
    def columns(doc_ids: list[int | None], texts: list[str | None]) -> tuple[np.ndarray, ...]:
        """Ids, lengths, terms, counts and positions (without gaps) of texts."""
        found = [words(t) for t in texts]
        terms, tokens = _ranked(found)
        ids = np.array([-(1 << 63) if d is None else d for d in doc_ids], dtype=np.int64)
        return ids, np.array([len(w) for w in found], dtype=np.int64), terms, np.bincount(tokens, minlength=len(terms)), np.argsort(tokens, kind="stable")

    @staticmethod
    def row(number: int, ids: np.ndarray, lengths: np.ndarray, terms: np.ndarray, counts: np.ndarray, positions: np.ndarray) -> tuple:
        """A row of the index table: positions as steps from the one before, which compress."""
        squeeze = zstandard.ZstdCompressor(level=3).compress
        planes = lambda x, kind: squeeze(x.astype(kind).view(np.uint8).reshape(len(x), 4).T.tobytes())
        return number, ids.tobytes(), planes(lengths, "<u4"), terms.tobytes(), planes(counts, "<u4"), planes(np.diff(positions, prepend=0), "<i4")

    @staticmethod
    def load(row: dict, gap: int = WINDOW) -> Index:
        def numbers(packed: bytes, kind: str) -> np.ndarray:
            planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8)
            return np.ascontiguousarray(planes.reshape(4, len(planes) // 4).T).view(kind).reshape(-1).astype(np.int64)

        return Index(np.frombuffer(row["doc_ids"], "<i8"), numbers(row["lengths"], "<u4"), np.frombuffer(row["terms"], "<u8"), numbers(row["counts"], "<u4"), np.cumsum(numbers(row["positions"], "<i4")), gap)

    def occurrences(self, phrases: Phrases, slop: int = 0) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Length, items and begins of the windows that occur: every term within ``slop`` of its place."""
        at = np.minimum(np.searchsorted(self.terms, phrases.terms), max(0, len(self.terms) - 1))
        own = np.where(self.terms[at] == phrases.terms, at, -1) if len(self.terms) else np.full(len(phrases.terms), -1)
        has = np.flatnonzero(own >= 0)
        if not len(has):
            return
        # The lists of the terms that are asked for, one after the other, keyed by (term, position).
        many = np.zeros(len(own), dtype=np.int64)
        many[has] = self.counts[own[has]]
        first = np.cumsum(many) - many
        place = np.repeat(self.first[own[has]] - first[has], many[has]) + np.arange(many.sum())
        positions = self.positions[place]
        keys = np.repeat(has, many[has]) * self.span + positions
        missing = np.r_[0, np.cumsum(many[phrases.tokens] == 0)]
        for n, (start, item) in phrases.windows.items():
            alive = np.flatnonzero(missing[start + n] == missing[start])
            for lo in range(0, len(alive), 1 << 17):
                some = alive[lo : lo + (1 << 17)]
                rarest = many[phrases.tokens[start[some][:, None] + np.arange(n)]].min(axis=1)
                for part in np.split(some, np.flatnonzero(np.diff(np.cumsum(rarest) // STARTS)) + 1):
                    phrase, begin = self._search(phrases.tokens[start[part][:, None] + np.arange(n)], many, first, positions, keys, slop)
                    yield n, item[part[phrase]], begin

    def _search(self, phrases: np.ndarray, many: np.ndarray, first: np.ndarray, positions: np.ndarray, keys: np.ndarray, slop: int) -> tuple[np.ndarray, np.ndarray]:
        rank = np.argsort(many[phrases], axis=1, kind="stable")
        rarest = np.take_along_axis(phrases, rank[:, :1], axis=1)[:, 0]
        count = many[rarest]
        phrase = np.repeat(np.arange(len(phrases)), count)
        within = np.arange(len(phrase)) - np.repeat(np.cumsum(count) - count, count)
        begin = positions[np.repeat(first[rarest], count) + within] - rank[phrase, 0]
        for j in range(1, phrases.shape[1]):
            offset = rank[phrase, j]
            term = phrases[phrase, offset].astype(np.int64)
            at = np.searchsorted(keys, term * self.span + np.maximum(begin + offset - slop, 0))
            hit = (at < len(keys)) & (keys[np.minimum(at, len(keys) - 1)] <= term * self.span + begin + offset + slop)
            phrase, begin = phrase[hit], begin[hit]
        return phrase, begin

    def doc(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, np.maximum(positions, 0), side="right") - 1


def build(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The index table of whole texts: a row for each block of documents, of about DOC_BLOCK bytes of text or of one text.

    Every row of docs is in it, those with null or empty texts too. Write it to keep it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), *[pa.binary()] * 5)
        for number, pack in enumerate(_joined(batches, DOC_BLOCK)):
            row = Index.row(number, *Index.columns(pack["doc_id"], pack["text"]))
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, kinds, strict=True)], [c.split()[0] for c in _INDEX.split(", ")])

    return documents(docs, id_col, text_col).mapInArrow(run, _INDEX)


def _joined(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[dict[str, list]]:
    """Packs of up to about ``limit`` bytes, over the bounds of batches."""
    held: dict[str, list] = {"doc_id": [], "text": []}
    size = 0
    for pack in packs(batches, limit // 4):
        for c, own in held.items():
            own.extend(pack[c])
        size += sum(len(t) for t in pack["text"] if t)
        if size >= limit * 3 // 4:
            yield held
            held, size = {"doc_id": [], "text": []}, 0
    if held["doc_id"]:
        yield held


def item_blocks(benchmark: DataFrame, item_col: str, text_col: str, limit: int) -> Iterator[list[tuple[str, str | None]]]:
    """The items in blocks of at most ``limit`` bytes of text (or one item), so many that a task can hold one.

    The items are the stated query set: the driver reads them and holds one block, and each block is one pass.
    """
    own: list[tuple[str, str | None]] = []
    held, first = 0, True
    for item, text in benchmark.select(F.col(item_col).cast("string"), F.col(text_col).cast("string")).toLocalIterator():
        size = len((text or "").encode())
        if held and held + size > limit:
            yield own
            own, held, first = [], 0, False
        own.append((item, text))
        held += size
    if own or first:
        yield own


def _each_block(df: DataFrame, blocks: Iterator[list], window: int, run_with: Callable, schema: str) -> DataFrame:
    """df by each block of items, one after the other: a block's broadcast goes before the next is made."""
    found = None
    for items in blocks:
        shared = df.sparkSession.sparkContext.broadcast(Phrases(items, window))
        part = cut(df.mapInArrow(run_with(shared), schema))
        shared.destroy()
        found = part if found is None else found.unionByName(part)
    return found


def _ids(index: Index) -> pa.Array:
    return pa.array(index.doc_ids, mask=index.doc_ids == -(1 << 63))


def matches(docs: DataFrame, benchmark: DataFrame, slop: int = 0, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", block: int = ITEM_BLOCK) -> DataFrame:
    """doc_id, item_id, position (of a word in its text), length: each place where a window of an item occurs.

    ``slop`` 0 gives exact phrases; more lets every term be so many words from its place (proximity). An item without
    words has no windows. Null texts have no words, and equal documents have matches each.
    """
    return matches_in(build(docs, id_col, text_col), benchmark, slop, window, item_id_col, item_text_col, block)


def matches_in(index: DataFrame, benchmark: DataFrame, slop: int = 0, window: int = WINDOW, item_id_col: str = "item_id", item_text_col: str = "text", block: int = ITEM_BLOCK) -> DataFrame:
    """What matches() returns, from an index that build() made."""

    def run_with(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    own, phrases = Index.load(row, window + slop), shared.value
                    number: dict[str | None, int] = {}
                    name = np.array([number.setdefault(i, len(number)) for i in phrases.items], dtype=np.int64)
                    named = list(number)
                    rows = [np.stack([begin, name[item], np.full(len(begin), n)]) for n, item, begin in own.occurrences(phrases, slop)]
                    if rows and sum(map(np.size, rows)):
                        begin, item, n = np.unique(np.concatenate(rows, axis=1), axis=1)
                        doc = own.doc(begin)
                        yield pa.RecordBatch.from_arrays([_ids(own).take(pa.array(doc)), pa.array([named[i] for i in item], pa.string()), pa.array(begin - own.starts[doc]), pa.array(n.astype(np.int32))], ["doc_id", "item_id", "position", "length"])

        return run

    schema, blocks = "doc_id long, item_id string, position long, length int", item_blocks(benchmark, item_id_col, item_text_col, block)
    first, second = next(blocks), next(blocks, None)
    if second is None:
        return index.mapInArrow(run_with(index.sparkSession.sparkContext.broadcast(Phrases(first, window))), schema)
    return _each_block(index, chain((first, second), blocks), window, run_with, schema)


def judge(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", block: int = ITEM_BLOCK) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for each row of docs, by an index kept in the shared folder.

    A word is hit if it lies in an occurrence of any window; items are those with an occurring window, in the order
    of their ids as strings. Null or empty texts and an empty benchmark give zero counts and the digest of nothing.
    Repeated rows are judged each. A null item id is an id like others (n_items counts it once) that the digest leaves out.
    """
    return judge_in(cut(build(docs, id_col, text_col)), benchmark, window, item_id_col, item_text_col, block)


def judge_in(index: DataFrame, benchmark: DataFrame, window: int = WINDOW, item_id_col: str = "item_id", item_text_col: str = "text", block: int = ITEM_BLOCK) -> DataFrame:
    """What judge() returns, from an index that build() made and that was kept."""
    blocks = item_blocks(benchmark, item_id_col, item_text_col, block)
    first, second = next(blocks), next(blocks, None)
    if second is None:
        return index.mapInArrow(_judge(index.sparkSession.sparkContext.broadcast(Phrases(first, window)), window, False), _JUDGED)
    # Each block marks its own hits; a document's marks of all blocks meet by its place in the index.
    own = cut(index.withColumn("row", F.monotonically_increasing_id()))
    marks = _each_block(own, chain((first, second), blocks), window, lambda shared: _judge(shared, window, True), "row long, place int, doc_id long, n_words long, hits array<int>, items array<string>")
    met = marks.groupBy("row", "place").agg(F.first("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), F.size(F.array_distinct(F.flatten(F.collect_list("hits")))).cast("long").alias("n_hit"), F.sort_array(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    return met.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


_JUDGED = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def _judge(shared, window: int, marks: bool):
    """The rows of one block of items: what judge() returns, or the marks that several blocks are put together from."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                index, phrases = Index.load(row, window), shared.value
                n = len(index.lengths)
                hit = np.zeros(index.span + 1, dtype=np.int32)
                items: list[set[str]] = [set() for _ in range(n)]
                for length, item, begin in index.occurrences(phrases):
                    np.add.at(hit, begin, 1)
                    np.add.at(hit, begin + length, -1)
                    for pair in np.unique(index.doc(begin) * len(phrases.items) + item).tolist():
                        items[pair // len(phrases.items)].add(phrases.items[pair % len(phrases.items)])
                covered = np.cumsum(hit)[: index.span] > 0
                if marks:
                    hits = [np.flatnonzero(covered[s : s + m]).astype(np.int32) for s, m in zip(index.starts, index.lengths, strict=False)]
                    columns = [pa.array(np.full(n, row["row"])), pa.array(np.arange(n, dtype=np.int32)), _ids(index), pa.array(index.lengths), pa.array(hits, pa.list_(pa.int32())), pa.array([list(x) for x in items], pa.list_(pa.string()))]
                    yield pa.RecordBatch.from_arrays(columns, ["row", "place", "doc_id", "n_words", "hits", "items"])
                    continue
                n_hit = np.diff(np.r_[0, np.cumsum(covered)][index.starts])
                digest = [hashlib.sha256(",".join(sorted(i for i in x if i is not None)).encode()).hexdigest() for x in items]
                yield pa.RecordBatch.from_arrays([_ids(index), pa.array(index.lengths), pa.array(n_hit, pa.int64()), pa.array([len(x) for x in items], pa.int64()), pa.array(digest), pa.array(n_hit > 0)], [c.split()[0] for c in _JUDGED.split(", ")])

    return run


def keep(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", block: int = ITEM_BLOCK) -> DataFrame:
    """The rows of docs in which no window of any item occurs; each block of rows is indexed in its task and dropped.

    Null texts have no words and stay, rows that repeat stay or go alike, and an empty benchmark keeps all. With more
    than one block of items, what a block leaves is kept in the shared folder before the next.
    """
    blocks = item_blocks(benchmark, item_id_col, item_text_col, block)
    first, second = next(blocks), next(blocks, None)
    for items in chain((first,) if second is None else (first, second), blocks):
        shared = docs.sparkSession.sparkContext.broadcast(Phrases(items, window))
        docs = keep_where(docs, _clean(shared, window), text_col, DOC_BLOCK)
        if second is not None:
            docs = cut(docs)
            shared.destroy()
    return docs


def _clean(shared, window: int):
    def decide():
        def decider(texts: list) -> list:
            index = Index(*Index.columns([0] * len(texts), texts), window)
            clean = np.ones(len(texts), dtype=bool)
            for _, _, begin in index.occurrences(shared.value):
                clean[index.doc(begin)] = False
            return clean.tolist()

        return decider

    return decide
