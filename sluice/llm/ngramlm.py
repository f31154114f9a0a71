"""N-gram language-model scores from Elias-Fano tries that are spread over the cluster.

The model, for a word w after b after a, adds up counts of all orders (count merging), and is a distribution over w:

    p(w | a b) = (c(a b w) + NU c(b w) + EPS (c(w) + 1)) / (c(a b) + NU c(b) + MU),   EPS = MU / (N + 1 (V + 1))

so with nothing known of the context it is the base share (c(w) + 1) / (N + 1 (V + 1)). Numerators are functions of
n-grams that end in w and denominators of those that end in b, so a trie by reversed n-grams (w, then b, then a), cut
by the last word, has in one piece all that the words of that piece need: each word's numerator, and the denominator
of what follows it. Documents' n-grams are dealt out once by their last word, and only their sums come back.

A piece is a trie of three levels. The children of a node are known by the rank of their word among the piece's words,
relative to their parent: a level holds, parent after parent, the children's ranks on top of the last value of the
parent before, an ascending sequence kept as Elias-Fano. Another such sequence has pointers to where each node's
children begin. A search takes the base and the bounds from the pointers and looks for the successor between them.
Levels also have quantised log10 numerators and denominators. All lie in files that are mapped, not read.

``score`` learns and scores at once, as each n-gram is dealt once for both, and leaves no model; ``fit`` stores the
pieces as a table, from which ``score_with`` scores other documents without learning anew.
"""

from __future__ import annotations

import io
import math
import os
import tempfile
import zipfile
from array import array
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import Cache, cut, documents, packs
from sluice.llm.eliasfano import Sequence

#: Of a grid these give held-out text the best shares (0.1 log10 a word better than 4 and 2000).
NU, MU = 0.25, 100.0
#: Words of a piece, about; and the share of a piece at which a word has pieces of its own, by what stands before it.
PIECE, HOT = 2_500_000, 4
#: Words, and distinct words, that a task gathers before it deals them out.
GATHER, GATHER_DISTINCT = 3_000_000, 2_000_000
END, START, OUTSIDE = 0, 1, 2
#: Words with so large a share of all are named by their rank instead of their hash; at most 1 / FREQUENT words.
FREQUENT = 5e-6
#: Quantised log10 values lie in steps of 1 / STEPS from LEAST on.
STEPS, LEAST = 2048.0, -14.0


def word_hash(word: bytes) -> int:
    """64 bits of a word; the first numbers are kept for the text's end and start."""
    return max(xxhash.xxh64_intdigest(word), OUTSIDE + 1)


def tokens(text: str | None) -> list[bytes]:
    """Runs of characters that are no ASCII white space, A-Z lower-cased."""
    return (text or "").encode().lower().split()


def unigrams(df: DataFrame, text_col: str = "text") -> DataFrame:
    """word (hash as a signed long) and n over all texts, ends of text included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, ids, ends = _numbers(), array("i"), 0

        def out():
            counts = np.bincount(np.frombuffer(ids, dtype=np.int32), minlength=len(number.hashes)) if ids else np.zeros(0, dtype=np.int64)
            words = np.append(np.array(number.hashes, dtype=np.uint64), np.uint64(END)).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(words), pa.array(np.r_[counts, ends])], ["word", "n"])

        for pack in packs(batches, 4 << 20):
            for text in pack["text"]:
                ids.extend(map(number.__getitem__, tokens(text)))
                ends += 1
            if len(ids) >= GATHER:
                yield out()
                number, ids, ends = _numbers(), array("i"), 0
        if ends:
            yield out()

    return df.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


class _numbers(dict):
    """Words to numbers in order of appearance, with the hash of each."""

    def __init__(self):
        super().__init__()
        self.hashes = array("Q")

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self.hashes)
        self.hashes.append(word_hash(word))
        return n


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(31))


def _pair(w: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One number for the hashes of a word and of the word before it."""
    return _mix(w ^ _mix(b))


def _order(w: np.ndarray, b: np.ndarray, a: np.ndarray, n: int) -> np.ndarray:
    """The order by (w, b, a), all below n."""
    if n**3 < 1 << 64:
        n_ = np.uint64(n)
        return np.argsort((w.astype(np.uint64) * n_ + b.astype(np.uint64)) * n_ + a.astype(np.uint64)).astype(np.int32)
    return np.lexsort((a, b, w)).astype(np.int32)


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Where runs of equal rows begin."""
    if not len(columns[0]):
        return np.zeros(0, dtype=np.int64)
    return np.flatnonzero(np.r_[True, np.logical_or.reduce([c[1:] != c[:-1] for c in columns])])


def _lots(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(hashes, docs, doc, w, b, a): the numbers of the words of a lot of documents, of those before, and of documents."""

    def out():
        hashes = np.concatenate([np.array([END, START], dtype=np.uint64), np.array(number.hashes, dtype=np.uint64)])
        many = np.array(lengths, dtype=np.int64)
        doc = np.repeat(np.arange(len(many), dtype=np.int32), many + 1)
        ends = np.cumsum(many + 1) - 1
        first = np.r_[0, ends[:-1] + 1]
        w = np.zeros(len(doc), dtype=np.int32)
        body = np.ones(len(doc), dtype=bool)
        body[ends] = False
        w[body] = np.frombuffer(ids, dtype=np.int32) + 2 if ids else 0
        b = np.r_[np.int32(1), w[:-1]]
        b[first] = 1
        a = np.r_[np.int32(1), b[:-1]]
        a[first] = 1
        return hashes, docs, doc, w, b, a

    number, docs, lengths, ids = _numbers(), [], [], array("i")
    for pack in packs(batches, 2 << 20):
        for doc_id, text, trains in zip(pack["doc_id"], pack["text"], pack["trains"], strict=True):
            found = tokens(text)
            ids.extend(map(number.__getitem__, found))
            docs.append((doc_id, trains, len(found)))
            lengths.append(len(found))
        if len(ids) + len(docs) >= GATHER or len(number) >= GATHER_DISTINCT:
            yield out()
            number, docs, lengths, ids = _numbers(), [], [], array("i")
    if docs:
        yield out()


def _deal(batches: Iterator[pa.RecordBatch], pieces: int, hot: np.ndarray, pairs: np.ndarray, frequent: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows (piece, lot, kind, payload): the n-grams of a lot of documents that each piece answers, and one row with ids.

    A payload has the words that it uses, as ranks of frequent ones and hashes of others, each distinct n-gram with its
    occurrences, of which in documents that are learnt from, and, apart, the numbers of the documents of these.
    """
    by_hash = np.argsort(frequent)
    sorted_ = frequent[by_hash]
    squeeze = zstandard.ZstdCompressor(level=5)
    for lot, (hashes, docs, doc, w, b, a) in enumerate(_lots(batches)):
        task = TaskContext.get()
        key = (task.partitionId() if task else 0) << 32 | lot
        trained = np.array([t for _, t, _ in docs], dtype=bool)
        doc_ids = np.array([-(1 << 63) if d is None else d for d, *_ in docs], dtype="<i8")
        lengths = np.array([m for *_, m in docs], dtype="<i8")
        yield _blobs([(int(key % pieces), key, 0, b"".join([doc_ids.tobytes(), lengths.tobytes(), trained.tobytes()]))])
        order = _order(w, b, a, len(hashes))
        w, b, a, doc = w[order], b[order], a[order], doc[order]
        del order
        starts = _changes(w, b, a)
        w, b, a = w[starts], b[starts], a[starts]
        many = np.diff(np.r_[starts, len(doc)])
        learnt = np.add.reduceat(trained[doc].astype(np.int32), starts)
        found = np.minimum(np.searchsorted(sorted_, hashes), max(0, len(sorted_) - 1))
        rank = np.where(sorted_[found] == hashes, by_hash[found], -1) if len(sorted_) else np.full(len(hashes), -1)
        piece = (_mix(hashes) % np.uint64(pieces)).astype(np.int32)[w]
        # A hot word is spread by the word before it, and a hot pair by the word before that.
        spread = np.flatnonzero(np.isin(hashes, hot)[w])
        by_pair = _pair(hashes[w[spread]], hashes[b[spread]])
        further = np.flatnonzero(np.isin(by_pair, pairs))
        by_pair[further] = _mix(by_pair[further] ^ _mix(hashes[a[spread[further]]]))
        piece[spread] = by_pair % np.uint64(pieces)
        by_piece = np.argsort(piece.astype(np.int16) if pieces < 1 << 15 else piece, kind="stable")
        cuts = np.r_[0, np.cumsum(np.bincount(piece, minlength=pieces))]
        del piece, spread, by_pair
        used, place = np.zeros(len(hashes), dtype=bool), np.zeros(len(hashes), dtype=np.int32)
        rows, held = [], 0
        for k in np.flatnonzero(np.diff(cuts)):
            own = by_piece[cuts[k] : cuts[k + 1]]
            used[:] = False
            used[w[own]] = used[b[own]] = used[a[own]] = True
            some = np.flatnonzero(used)
            known = some[rank[some] >= 0]
            known, other = known[np.argsort(rank[known])], some[rank[some] < 0]
            place[known] = np.arange(len(known))
            place[other] = np.arange(len(known), len(some))
            kind = "<u2" if max(len(some), int(many[own].max())) < 1 << 16 else "<u4"
            head = np.array([len(known), len(other), len(own), int(kind[-1])], dtype="<i8").tobytes()
            head += _planes(np.diff(rank[known], prepend=0).astype("<u4")) + hashes[other].tobytes()
            grams = squeeze.compress(b"".join([head, *(_planes(x.astype(kind)) for x in (place[w[own]], place[b[own]], place[a[own]], many[own], learnt[own]))]))
            at = np.repeat(starts[own] - np.r_[0, np.cumsum(many[own])[:-1]], many[own]) + np.arange(many[own].sum())
            of = squeeze.compress(_planes(doc[at].astype("<u2" if len(docs) < 1 << 16 else "<u4")))
            rows.append((int(k), key, 1, np.array([len(grams), len(docs)], dtype="<i8").tobytes() + grams + of))
            held += len(rows[-1][-1])
            if held > 8 << 20:
                yield _blobs(rows)
                rows, held = [], 0
        if rows:
            yield _blobs(rows)


#: Of a document in a lot: its number, sums of scores (of quantised values) and of plain shares, and known words.
_SUMS = ("<u4", "<f4", "<f8", "<u4")
_DEALT = "piece int, lot long, kind int, payload binary"


def _blobs(rows: list[tuple]) -> pa.RecordBatch:
    piece, lot, kind, payload = zip(*rows, strict=True) if rows else ((), (), (), ())
    return pa.RecordBatch.from_arrays([pa.array(piece, pa.int32()), pa.array(lot, pa.int64()), pa.array(kind, pa.int32()), pa.array(payload, pa.binary())], ["piece", "lot", "kind", "payload"])


def _planes(values: np.ndarray) -> bytes:
    """All low bytes, then all higher ones: equal high bytes of sorted numbers lie together for the compressor."""
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def _unplaned(payload: bytes, kind: str, n: int, at: int) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(payload, np.uint8, n * width, at).reshape(width, n).T).view(kind)[:, 0]


def _unpack(payload: bytes, frequent: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], bytes, str]:
    """The words, the columns of the n-grams, and the packed documents of their occurrences with the kind of numbers."""
    size, docs = map(int, np.frombuffer(payload, "<i8", 2))
    grams = zstandard.ZstdDecompressor().decompress(payload[16 : 16 + size])
    known, other, n, width = map(int, np.frombuffer(grams, "<i8", 4))
    hashes = np.concatenate([frequent[np.cumsum(_unplaned(grams, "<u4", known, 32), dtype=np.int64)], np.frombuffer(grams, "<u8", other, 32 + 4 * known)])
    at, out = 32 + 4 * known + 8 * other, []
    for _ in range(5):
        out.append(_unplaned(grams, f"<u{width}", n, at).astype(np.int32))
        at += n * width
    return hashes, out, payload[16 + size :], "<u2" if docs < 1 << 16 else "<u4"


def quantise(values: np.ndarray) -> np.ndarray:
    return np.clip(np.rint((values - LEAST) * STEPS), 0, 65535).astype(np.uint16)


def restore(codes: np.ndarray) -> np.ndarray:
    return codes / STEPS + LEAST


class Trie:
    """A piece's n-grams, last word first, in mapped files under a folder.

    Level 1 has one node for each w, level 2 for each (w, b), level 3 for each (w, b, a). A node has the log10 numerator
    of an n-gram that is known down to it and no further, and the log10 denominator of what follows such a context;
    level 3 needs no denominators. Words have their exact counts as well, for plain shares.
    """

    LEVELS, CODES = ("1", "2", "3", "b2", "b3"), ("n1", "n2", "n3", "d1", "d2")

    def __init__(self, folder: str):
        """The trie that lies in ``folder``."""
        sizes = np.load(f"{folder}/sizes.npy").reshape(-1, 2).tolist()
        self.words = self._mapped(f"{folder}/words", np.uint64)
        self.level1, self.level2, self.level3, self.begin2, self.begin3 = (Sequence(f"{folder}/{x}", *s) for x, s in zip(self.LEVELS, sizes, strict=True))
        self.codes = {c: self._mapped(f"{folder}/{c}", np.uint16) for c in self.CODES}
        self.counts = self._mapped(f"{folder}/counts", np.int64)

    @staticmethod
    def _mapped(path: str, kind: type) -> np.ndarray:
        return np.memmap(path, dtype=kind, mode="r") if os.path.getsize(path) else np.zeros(0, dtype=kind)

    @staticmethod
    def write(folder: str, words: np.ndarray, grams: np.ndarray, counts: np.ndarray, hot: Hot, eps: float) -> Trie:
        """From ascending distinct (w, b, a), ranks among ascending hashes of words, and their counts."""
        w, b, a = grams
        start2 = _changes(w, b)
        w2, b2 = w[start2], b[start2]
        start1 = _changes(w2)
        w1 = w2[start1]
        c2 = np.add.reduceat(counts, start2) if len(start2) else counts
        c1 = np.add.reduceat(c2, start1) if len(start1) else c2
        # Of hot words and pairs only a part is here: their counts are known before.
        c1 = np.maximum(c1, hot.of_words(words[w1]))
        of_hot = np.flatnonzero(np.isin(words, hot.words)[w2])
        c2[of_hot] = np.maximum(c2[of_hot], hot.of_pairs(_pair(words[w2[of_hot]], words[b2[of_hot]])))
        parent2 = np.repeat(np.arange(len(w1)), np.diff(np.r_[start1, len(w2)]))
        parent3 = np.repeat(np.arange(len(w2)), np.diff(np.r_[start2, len(w)]))
        base = eps * (c1 + 1)
        two = NU * c2 + base[parent2]
        sequences = [w1, Trie._stacked(b2, start1), Trie._stacked(a, start2), np.r_[start1, len(w2)], np.r_[start2, len(w)]]
        c1.astype(np.int64).tofile(f"{folder}/counts")
        written = [Sequence.write(f"{folder}/{x}", values) for x, values in zip(Trie.LEVELS, sequences, strict=True)]
        np.save(f"{folder}/sizes.npy", np.array([(x.n, x.bits) for x in written]))
        words.tofile(f"{folder}/words")
        codes = {"n1": base, "n2": two, "n3": counts + two[parent3], "d1": NU * c1 + MU, "d2": c2 + NU * c1[parent2] + MU}
        for name, values in codes.items():
            quantise(np.log10(values) if len(values) else values).tofile(f"{folder}/{name}")
        return Trie(folder)

    @staticmethod
    def _stacked(ranks: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """Ranks of each parent's children, plus one, on top of the last value of the parent before."""
        if not len(ranks):
            return ranks.astype(np.int64)
        last = ranks[np.r_[begin[1:], len(ranks)] - 1].astype(np.int64) + 1
        return ranks + 1 + np.repeat(np.r_[0, np.cumsum(last)[:-1]], np.diff(np.r_[begin, len(ranks)]))

    def children(self, level: int, parents: np.ndarray, ranks: np.ndarray) -> np.ndarray:
        """Places of the children with these ranks among each parent's own; -1 where there is no parent or child.

        Parents ascend, and ranks within a parent, so a search goes once through the level.
        """
        out = np.full(len(parents), -1, dtype=np.int64)
        sequence, begin = (self.level2, self.begin2) if level == 2 else (self.level3, self.begin3)
        has = np.flatnonzero((parents >= 0) & (ranks >= 0))
        if not len(has):
            return out
        low, high = begin.at(parents[has]), begin.at(parents[has] + 1)
        under = np.where(low > 0, sequence.at(np.maximum(low - 1, 0)), 0)
        wanted = under + ranks[has] + 1
        inside = wanted <= sequence.at(high - 1)  # a larger rank than the parent's last child has no successor among them
        has, wanted, low, high = has[inside], wanted[inside], low[inside], high[inside]
        place, equal = sequence.successor(wanted)
        out[has] = np.where(equal & (place >= low) & (place < high), place, -1)
        return out

    def look_up(self, w: np.ndarray, b: np.ndarray, a: np.ndarray, eps: float, hot: Hot, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Log10 numerators and denominators of ascending queries, from the deepest node that each reaches, and counts of w.

        Ranks are those of ``hashes``, the words of the queries. A hot word or pair without a node has its global count.
        """
        own = np.searchsorted(self.words, hashes)
        own = np.where(self.words[np.minimum(own, len(self.words) - 1)] == hashes, own, -1) if len(self.words) else np.full(len(hashes), -1)
        place, equal = self.level1.successor(np.maximum(own[w], 0))
        one = np.where(equal & (own[w] >= 0), place, -1)
        two = self.children(2, one, own[b])
        three = self.children(3, two, own[a])
        top = np.full(len(w), math.log10(eps))
        under = np.full(len(w), math.log10(MU))
        for places, above, below in ((one, "n1", "d1"), (two, "n2", "d2"), (three, "n3", None)):
            known = np.flatnonzero(places >= 0)
            top[known] = restore(self.codes[above][places[known]])
            if below:
                under[known] = restore(self.codes[below][places[known]])
        count = np.zeros(len(w), dtype=np.int64)
        count[one >= 0] = self.counts[one[one >= 0]]
        spread = np.flatnonzero(np.isin(hashes, hot.words)[w] & (two < 0))
        c1, c2 = hot.of_words(hashes[w[spread]]), hot.of_pairs(_pair(hashes[w[spread]], hashes[b[spread]]))
        top[spread], under[spread], count[spread] = np.log10(NU * c2 + eps * (c1 + 1)), np.log10(c2 + NU * c1 + MU), c1
        return top, under, count


class Hot(NamedTuple):
    """Hashes (ascending) and counts of words, and numbers (ascending) and counts of pairs, that are spread over pieces."""

    words: np.ndarray
    word_counts: np.ndarray
    pairs: np.ndarray
    pair_counts: np.ndarray

    def of_words(self, hashes: np.ndarray) -> np.ndarray:
        return _counts_of(self.words, self.word_counts, hashes)

    def of_pairs(self, numbers: np.ndarray) -> np.ndarray:
        return _counts_of(self.pairs, self.pair_counts, numbers)


def _counts_of(keys: np.ndarray, counts: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Counts of wanted keys; 0 for others."""
    if not len(keys):
        return np.zeros(len(wanted), dtype=np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, counts[at], 0)


def _merged(dealt: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, ascending distinct (w, b, a), counts of what is learnt, and for all dealt n-grams in turn which they are."""
    hashes = np.unique(np.concatenate([h for _, h, *_ in dealt]))
    w, b, a = (np.concatenate([np.searchsorted(hashes, h).astype(np.int32)[columns[j]] for _, h, columns, *_ in dealt]) for j in range(3))
    order = _order(w, b, a, len(hashes))
    w, b, a = w[order], b[order], a[order]
    starts = _changes(w, b, a)
    learnt = np.concatenate([columns[4] for _, _, columns, *_ in dealt])[order]
    which = np.empty(len(order), dtype=np.int32)
    which[order] = np.repeat(np.arange(len(starts), dtype=np.int32), np.diff(np.r_[starts, len(w)]))
    return hashes, np.stack([w[starts], b[starts], a[starts]]), np.add.reduceat(learnt, starts).astype(np.int64), which


def _fold(folder: str) -> bytes:
    """The files of a folder as bytes."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as files:
        for name in sorted(os.listdir(folder)):
            files.write(f"{folder}/{name}", name)
    return out.getvalue()


def _unfold(folder: str, payload: bytes) -> Trie:
    with zipfile.ZipFile(io.BytesIO(payload)) as files:
        files.extractall(folder)
    return Trie(folder)


def _build_piece(table: pa.Table, eps: float, hot: Hot, frequent: np.ndarray) -> pa.Table:
    """The trie of what a piece was dealt, as one row."""
    dealt = [(0, *_unpack(x.as_py(), frequent)) for k, x in zip(table.column("kind").to_pylist(), table.column("payload"), strict=True) if k == 1]
    piece = table.column("piece")[0].as_py()
    if not dealt:
        return pa.Table.from_batches([_blobs([])])
    hashes, grams, counts, _ = _merged(dealt)
    with tempfile.TemporaryDirectory(prefix="trie-") as folder:
        Trie.write(folder, hashes, grams, counts, hot, eps)
        return pa.Table.from_batches([_blobs([(piece, -1, 2, _fold(folder))])])


def _score_piece(table: pa.Table, eps: float, hot: Hot, frequent: np.ndarray) -> pa.Table:
    """Sums by document of the n-grams that a piece was dealt, a row for each lot, and what was passed through.

    The piece is learnt from what it was dealt, or comes with it (kind 2).
    """
    out, dealt, stored = [], [], None
    for lot, kind, payload in zip(table.column("lot").to_pylist(), table.column("kind").to_pylist(), table.column("payload"), strict=True):
        if kind == 0:
            out.append((0, lot, 0, payload.as_py()))
        elif kind == 1:
            dealt.append((lot, *_unpack(payload.as_py(), frequent)))
        else:
            stored = payload.as_py()
    del table
    if dealt:
        hashes, grams, counts, which = _merged(dealt)
        dealt = [(lot, columns[3], docs, kind) for lot, _, columns, docs, kind in dealt]
        with tempfile.TemporaryDirectory(prefix="trie-") as folder:
            learnt = counts > 0
            trie = _unfold(folder, stored) if stored is not None else Trie.write(folder, hashes, grams[:, learnt], counts[learnt], hot, eps)
            top, under, total = trie.look_up(*grams, eps, hot, hashes)
            del trie
        value = top - np.where(hashes[grams[0]] == END, 0.0, under)
        plain = np.log10(total + 1.0)
        at, squeeze = 0, zstandard.ZstdCompressor(level=3)
        for lot, many, docs, kind in dealt:
            own = np.repeat(which[at : at + len(many)], many)
            at += len(many)
            doc = _unplaned(zstandard.ZstdDecompressor().decompress(docs), kind, len(own), 0)
            here, place = np.unique(doc, return_inverse=True)
            sums = [np.bincount(place, weights=x, minlength=len(here)) for x in (value[own], plain[own], total[own] > 0)]
            out.append((0, lot, 1, squeeze.compress(b"".join(_planes(x.astype(t)) for x, t in zip((np.diff(here.astype(np.int64), prepend=0), *sums), _SUMS, strict=True)))))
    return pa.Table.from_batches([_blobs(out)])


def _gather(table: pa.Table, base: float, n_tokens: int, start: float) -> pa.Table:
    """A lot's documents from its ids and the sums of all pieces."""
    kinds, payloads = table.column("kind").to_pylist(), table.column("payload").to_pylist()
    head = payloads[kinds.index(0)]
    n = len(head) // 17
    ids, words, trained = np.frombuffer(head, "<i8", n), np.frombuffer(head, "<i8", n, 8 * n), np.frombuffer(head, bool, n, 16 * n)
    score, plain, known = np.zeros(n), np.zeros(n), np.zeros(n, dtype=np.int64)
    for kind, payload in zip(kinds, payloads, strict=True):
        if kind == 1:
            payload = zstandard.ZstdDecompressor().decompress(payload)
            m, at, columns = len(payload) // 20, 0, []
            for kind_ in _SUMS:
                columns.append(_unplaned(payload, kind_, m, at))
                at += m * columns[-1].itemsize
            doc = np.cumsum(columns[0])
            score[doc] += columns[1]
            plain[doc] += columns[2]
            known[doc] += columns[3]
    many = words + 1
    columns = [pa.array(ids, mask=ids == -(1 << 63)), pa.array(~trained), pa.array(many), pa.array(known), pa.array(np.full(n, n_tokens, dtype=np.int64)), pa.array(plain - many * base), pa.array(score - start)]
    return pa.Table.from_arrays(columns, ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])


def pair_counts(df: DataFrame, words: np.ndarray) -> DataFrame:
    """w, b (hashes as signed longs) and n of all words of ``words`` (and ends) after one of these or a text's start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = np.r_[words, np.uint64(START)]
        rank = {h: i for i, h in enumerate(words.tolist())}
        of = Cache(lambda word: rank.get(word_hash(word), -1))
        start, end, n = len(words), rank.get(END, -1), np.int64(len(hashes))
        held: dict[int, int] = {}
        for pack in packs(batches, 4 << 20):
            ids = array("i")
            for text in pack["text"]:
                ids.append(start)
                ids.extend([of[x] for x in tokens(text)])
                ids.append(end)
            at = np.frombuffer(ids, dtype=np.int32).astype(np.int64)
            b, w = at[:-1], at[1:]
            both = (b >= 0) & (w >= 0) & (w != start)
            for code, m in zip(*(x.tolist() for x in np.unique(w[both] * n + b[both], return_counts=True)), strict=True):
                held[code] = held.get(code, 0) + m
            if len(held) > 400_000:
                yield out(held, hashes)
                held = {}
        if held:
            yield out(held, hashes)

    def out(held: dict[int, int], hashes: np.ndarray) -> pa.RecordBatch:
        code = np.array(list(held), dtype=np.int64)
        w, b = (hashes[x].view(np.int64) for x in (code // len(hashes), code % len(hashes)))
        return pa.RecordBatch.from_arrays([pa.array(w), pa.array(b), pa.array(held.values(), pa.int64())], ["w", "b", "n"])

    return df.select("text").mapInArrow(run, "w long, b long, n long").groupBy("w", "b").agg(F.sum("n").alias("n"))


class Statistics(NamedTuple):
    """What all pieces share: words learnt from, distinct ones, texts, pieces, and the words and pairs that are spread."""

    n: int
    v: int
    texts: int
    pieces: int
    hot: Hot
    frequent: np.ndarray

    @property
    def eps(self) -> float:
        return MU / max(1, self.n + self.v + 1)


def statistics(docs: DataFrame, piece: int) -> Statistics:
    """Of docs (doc_id, text, trains).

    At most HOT * pieces words, and as many pairs, have so large a share to be spread, and 1 / FREQUENT words are ranked:
    that bounds the lists, which grow with the number of pieces alone.
    """
    learnt = docs.where("trains")
    counted = cut(unigrams(learnt))
    n, v = counted.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    pieces = max(1, round((docs.select(F.sum(F.octet_length("text"))).first()[0] or 0) / 6 / piece))
    share = min(FREQUENT, 1 / pieces / HOT)
    listed = counted.where((F.col("n") >= share * n) & ~F.col("word").isin(END, START)).toArrow().sort_by([("n", "descending"), ("word", "ascending")])
    words, counts = (listed.column(c).to_numpy() for c in ("word", "n"))
    frequent = words[counts >= FREQUENT * n].view(np.uint64)
    ends = counted.where(F.col("word") == END).select("n").first()
    texts = ends.n if ends else 0
    words, counts = np.append(words, END).view(np.uint64), np.append(counts, texts)
    limit = max(1, n / pieces / HOT)
    spread = counts > limit if pieces > 1 else np.zeros(len(counts), dtype=bool)
    order = np.argsort(words[spread])
    words, counts = words[spread][order], counts[spread][order]
    pairs, pair_n = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    if len(words):
        found = pair_counts(learnt, words).where(F.col("n") > limit).toArrow()
        w, b, m = (found.column(c).to_numpy() for c in ("w", "b", "n"))
        pairs = _pair(w.view(np.uint64), b.view(np.uint64))
        order = np.argsort(pairs)
        pairs, pair_n = pairs[order], m[order]
    return Statistics(n, v, texts, pieces, Hot(words, counts, pairs, pair_n), frequent)


_SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _summed(dealt: DataFrame, own: Statistics, shared) -> DataFrame:
    """Documents from what was dealt, by way of the pieces."""
    base, start = math.log10(max(1, own.n + own.v + 1)), math.log10(own.texts * (1 + NU) + MU)
    n, eps = own.n, own.eps
    summed = dealt.groupBy("piece").applyInArrow(lambda t: _score_piece(t, eps, *shared.value), _DEALT)
    return summed.groupBy("lot").applyInArrow(lambda t: _gather(t, base, n, start), _SCORED)


def _dealt(docs: DataFrame, pieces: int, shared) -> DataFrame:
    return docs.mapInArrow(lambda x: _deal(x, pieces, shared.value[0].words, shared.value[0].pairs, shared.value[1]), _DEALT)


def score(df: DataFrame, trains: str, id_col: str = "doc_id", text_col: str = "text", piece: int = PIECE) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10) of each whole text.

    ``trains`` is an SQL condition on doc_id: what it holds for is learnt from, all rows are scored. Null and empty
    texts are their end alone. Repeated rows are learnt from and scored each; with nothing to learn from, all words
    have the share 1. An empty table gives no rows. Values of the trie are rounded to 1 / 2048 of a log10.
    """
    docs = documents(df, id_col, text_col).withColumn("trains", F.expr(trains))
    own = statistics(docs, piece)
    shared = df.sparkSession.sparkContext.broadcast((own.hot, own.frequent))
    return _summed(_dealt(docs, own.pieces, shared), own, shared)


def fit(df: DataFrame, path: str, text_col: str = "text", piece: int = PIECE) -> None:
    """Learns from all texts and stores the pieces, a row each, and what they share under ``path`` (a shared folder)."""
    docs = df.select(F.lit(0).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.lit(True).alias("trains"))
    own = statistics(docs, piece)
    shared, eps = df.sparkSession.sparkContext.broadcast((own.hot, own.frequent)), own.eps
    pieces = _dealt(docs, own.pieces, shared).groupBy("piece").applyInArrow(lambda t: _build_piece(t, eps, *shared.value), _DEALT)
    pieces.write.mode("overwrite").parquet(f"{path}/pieces")
    out = io.BytesIO()
    np.savez(out, numbers=np.array(own[:4], dtype=np.int64), frequent=own.frequent, **own.hot._asdict())
    df.sparkSession.createDataFrame([(bytearray(out.getvalue()),)], "shared binary").write.mode("overwrite").parquet(f"{path}/shared")


def score_with(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """What score() returns for rows of df, none of them learnt from, by the model that fit() stored: nothing is learnt anew."""
    spark = df.sparkSession
    stored = np.load(io.BytesIO(bytes(spark.read.parquet(f"{path}/shared").first().shared)))
    own = Statistics(*stored["numbers"].tolist(), Hot(*(stored[c] for c in Hot._fields)), stored["frequent"])
    shared = spark.sparkContext.broadcast((own.hot, own.frequent))
    docs = documents(df, id_col, text_col).withColumn("trains", F.lit(False))
    pieces = spark.read.schema(_DEALT).parquet(f"{path}/pieces")
    return _summed(_dealt(docs, own.pieces, shared).unionByName(pieces), own, shared)
