"""Token counts that follow edits: a segment tree of pre-tokens for each document, kept as a table between edits.

Leaves hold short runs of pre-tokens, and inner nodes the sums of characters and tokens below. An edit descends by
characters to the leaves it touches and encodes again from the pre-token whose match could have seen the edit, a few
characters before it, until a match ends where an old pre-token ended behind the edit: from there on matches are as
before, since the pattern never looks back. Only those leaves' sums and the sums above them change.

``build`` encodes texts once and gives the trees as rows: the text, the lengths of its pre-tokens, and of each leaf the
number of pre-tokens and of tokens. ``apply`` takes such rows with edits and gives the rows after them, so a state can
be written, and edited again later, without encoding any other part of a text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.bpe import Tokenizer, _installed, tokenizer
from sluice.llm.common import documents, packs, slices

LEAF = 32
#: A match depends on no more characters than this after its end.
AHEAD = 3


class Tree:
    """The tree of one text from its stored row; ``encoded`` counts pre-tokens that edits have encoded again.

    A leaf's pre-tokens are cut out of the text when an edit comes to it, and not before.
    """

    def __init__(self, own: Tokenizer, text: str, lengths: np.ndarray, sizes: np.ndarray, tokens: np.ndarray):
        self.own, self.encoded = own, 0
        self._text, self._lengths = text, lengths.astype(np.int64)
        self._first = np.r_[0, np.cumsum(sizes, dtype=np.int64)]
        self._at = np.r_[0, np.cumsum(lengths, dtype=np.int64)][self._first]
        self._sums([None] * len(sizes), np.diff(self._at).tolist(), tokens.tolist())

    @staticmethod
    def rows(text: str, own: Tokenizer) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Lengths of pre-tokens, and pre-tokens and tokens of each leaf, of a text that is encoded whole."""
        found = own.pretokens(text)
        n = len(found)
        if not n:
            return np.zeros(0, dtype=np.int64), np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64)
        starts = np.arange(0, n, LEAF)
        tokens = np.add.reduceat(np.fromiter(map(len, map(own.cache.__getitem__, found)), dtype=np.int64, count=n), starts)
        return np.fromiter(map(len, found), dtype=np.int64, count=n), np.diff(np.r_[starts, n]), tokens

    @staticmethod
    def of(text: str, own: Tokenizer) -> Tree:
        return Tree(own, text, *Tree.rows(text, own))

    def _sums(self, leaves: list, chars: list[int], tokens: list[int]) -> None:
        self._leaves, self.size = leaves, 1 << (len(leaves) - 1).bit_length()
        self.chars, self.tokens = ([0] * self.size + x + [0] * (self.size - len(x)) for x in (chars, tokens))
        for node in range(self.size - 1, 0, -1):
            self._add(node)

    def _build(self, pretokens: list[str]) -> None:
        leaves = [pretokens[i : i + LEAF] for i in range(0, len(pretokens), LEAF)] or [[]]
        self._sums(leaves, [sum(map(len, x)) for x in leaves], [sum(len(self.own.cache[t]) for t in x) for x in leaves])

    def leaf(self, i: int) -> list[str]:
        if self._leaves[i] is not None:
            return self._leaves[i]
        ends = np.cumsum(self._lengths[self._first[i] : self._first[i + 1]]) + self._at[i]
        return [self._text[a:b] for a, b in zip([int(self._at[i]), *ends[:-1].tolist()], ends.tolist(), strict=False)] if len(ends) else []

    @property
    def leaves(self) -> list[list[str]]:
        return [self.leaf(i) for i in range(len(self._leaves))]

    def row(self) -> tuple[str, np.ndarray, np.ndarray, np.ndarray]:
        """The text and its row after edits; leaves that no edit has touched are taken over as they are, empty
        ones are left out."""
        text, lengths, sizes, tokens = [], [], [], []
        for i, own in enumerate(self._leaves):
            if not (own is None or own):
                continue  # all that was in it has gone
            tokens.append(self.tokens[self.size + i])
            if own is None:
                text.append(self._text[self._at[i] : self._at[i + 1]])
                lengths.append(self._lengths[self._first[i] : self._first[i + 1]])
            else:
                text += own
                lengths.append(np.fromiter(map(len, own), dtype=np.int64, count=len(own)))
            sizes.append(len(lengths[-1]))
        if not sizes:
            return "", np.zeros(0, dtype=np.int64), np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64)
        return "".join(text), np.concatenate(lengths), np.array(sizes), np.array(tokens)

    def _sum(self, leaf: int) -> None:
        own = self._leaves[leaf]
        self.chars[self.size + leaf] = sum(map(len, own))
        self.tokens[self.size + leaf] = sum(len(self.own.cache[t]) for t in own)

    def _add(self, node: int) -> None:
        for sums in (self.chars, self.tokens):
            sums[node] = sums[2 * node] + sums[2 * node + 1]

    def find(self, at: int) -> tuple[int, int]:
        """The leaf with the character ``at`` and where that leaf begins; the last leaf for the end of the text."""
        node, begin = 1, 0
        while node < self.size:
            node *= 2
            if at >= begin + self.chars[node]:
                begin += self.chars[node]
                node += 1
        leaf = node - self.size
        if leaf >= len(self._leaves):
            leaf = len(self._leaves) - 1
            begin = self.chars[1] - self.chars[self.size + leaf]
        return leaf, begin

    def __len__(self) -> int:
        return self.tokens[1]

    def text(self) -> str:
        return self.row()[0]

    def edit(self, start: int, end: int, text: str) -> None:
        """Characters start to end give way to text; positions beyond the text count as its end."""
        start = min(max(start, 0), self.chars[1])
        end = min(max(end, start), self.chars[1])
        first, begin = self.find(max(start - AHEAD, 0))
        touched, old, to = [first], list(self.leaf(first)), begin + self.chars[self.size + first]
        while to <= end and to < self.chars[1]:
            to = self._take(to, touched, old)
        ends = [begin + e for e in accumulate(map(len, old))]
        skip = next((i for i, e in enumerate(ends) if e > start - AHEAD), len(old))
        from_ = ends[skip - 1] if skip else begin
        while True:
            tail = "".join(old)
            region = tail[from_ - begin : start - begin] + text + tail[end - begin :]
            whole = to >= self.chars[1]
            found = self.own.pretokens(region)
            shift, behind, at = len(text) - (end - start), {e for e in ends if e >= end}, from_
            keep = None
            for i, token in enumerate(found):
                at += len(token)
                if not whole and at > to + shift - AHEAD:
                    break
                if at >= start + len(text) and at - shift in behind:
                    keep = i
                    break
            if keep is not None or whole:
                break
            to = self._take(to, touched, old)
            ends = [begin + e for e in accumulate(map(len, old))]
        fresh = found if keep is None else found[: keep + 1]
        rest = [] if keep is None else old[ends.index(at - shift) + 1 :]
        self.encoded += len(fresh)
        self._replace(touched, old[:skip] + fresh + rest)

    def _take(self, at: int, touched: list[int], old: list[str]) -> int:
        """Adds the leaf with the character ``at`` and its pre-tokens; where it ends. Leaves without any are passed over."""
        leaf, _ = self.find(at)
        touched.append(leaf)
        old += self.leaf(leaf)
        return at + self.chars[self.size + leaf]

    def _replace(self, touched: list[int], pretokens: list[str]) -> None:
        each = -(-len(pretokens) // len(touched)) or 1
        for i, leaf in enumerate(touched):
            self._leaves[leaf] = pretokens[i * each : (i + 1) * each]
        if each > 4 * LEAF:
            self._build([t for leaf in self.leaves for t in leaf])
            return
        nodes = set()
        for leaf in touched:
            self._sum(leaf)
            nodes.add((leaf + self.size) >> 1)
        while nodes and 0 not in nodes:
            for node in nodes:
                self._add(node)
            nodes = {node >> 1 for node in nodes}


#: What personal() replaces: addresses of mail and network, long numbers and keys.
_PERSONAL = regex.compile(r"[\w.+-]+@[\w-]+\.[\w.-]+|\b\d{1,3}(?:\.\d{1,3}){3}\b|\b[0-9a-fA-F]{32,}\b|\b\d(?:[ -]?\d){8,}\b")
#: What every match has in it but an address of mail, which has an @.
_DIGITS = regex.compile(r"\d[\d. -]{6}|[0-9a-fA-F]{32}")
#: Edits of a text: (start, end, text), each of the text as those before have left it.
Edits = list[tuple[int, int, str]]


def personal(text: str) -> Edits:
    """Edits, last place first, that replace personal data by a tag; none reaches over the end of a line."""
    found, at = [], 0
    if "@" not in text and not _DIGITS.search(text):
        return found
    for line in text.splitlines(keepends=True):
        if "@" in line or _DIGITS.search(line):
            found += [(at + m.start(), at + m.end(), "<redacted>") for m in _PERSONAL.finditer(line)]
        at += len(line)
    return found[::-1]


def repeated_lines(text: str) -> Edits:
    """Edits, last place first, that drop lines equal to an earlier one."""
    found, seen, at = [], set(), 0
    for line in text.splitlines(keepends=True):
        if line.strip() and line in seen:
            found.append((at, at + len(line), ""))
        seen.add(line)
        at += len(line)
    return found[::-1]


EDITS = "array<struct<start:long,end:long,text:string>>"
_EDITS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("text", pa.string())]))
#: A tree: the text, lengths of pre-tokens, pre-tokens and tokens of each leaf (unsigned, 4 bytes each); of the first
#: text the numbers of tokens and pre-tokens; edits so far, tokens after them, and pre-tokens that they encoded again.
STATE = "doc_id long, text string, lengths binary, sizes binary, tokens binary, n_tokens long, n_pretokens long, n_edits long, n_tokens_after long, n_encoded long"
_STATE = [c.split()[0] for c in STATE.split(", ")]
_bytes = lambda x: np.asarray(x).astype("<u4").tobytes()
_numbers = lambda x: np.frombuffer(x, "<u4")


def _built(batches: Iterator[pa.RecordBatch], own: Tokenizer) -> Iterator[pa.RecordBatch]:
    for pack in packs(batches, 4 << 20):
        texts = [t or "" for t in pack["text"]]
        rows = [Tree.rows(t, own) for t in texts]
        none, tokens = pa.array([0] * len(rows), pa.int64()), pa.array([int(r[2].sum()) for r in rows], pa.int64())
        columns = [pa.array(pack["doc_id"], pa.int64()), pa.array(texts, pa.string()), *(pa.array([_bytes(r[i]) for r in rows], pa.binary()) for i in range(3))]
        yield pa.RecordBatch.from_arrays([*columns, tokens, pa.array([len(r[0]) for r in rows], pa.int64()), none, tokens, none], _STATE)


def _found(batches: Iterator[pa.RecordBatch], find: Callable[[str], Edits]) -> Iterator[pa.RecordBatch]:
    for part in (x for batch in batches for x in slices([batch], 4 << 20)):
        edits = [[dict(zip(("start", "end", "text"), e, strict=True)) for e in find(t)] for t in part.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([*part.columns, pa.array(edits, _EDITS)], [*part.schema.names, "edits"])


def _applied(batches: Iterator[pa.RecordBatch], own: Tokenizer) -> Iterator[pa.RecordBatch]:
    for part in (x for batch in batches for x in slices([batch], 4 << 20)):
        columns = {c: part.column(c).to_pylist() for c in _STATE}
        for i, edits in enumerate(part.column("edits").to_pylist()):
            if not edits:
                continue
            tree = Tree(own, columns["text"][i], *(_numbers(columns[c][i]) for c in ("lengths", "sizes", "tokens")))
            for e in edits:
                tree.edit(e["start"] or 0, e["end"] or 0, e["text"] or "")
            columns["text"][i], *rest = tree.row()
            for c, x in zip(("lengths", "sizes", "tokens"), rest, strict=True):
                columns[c][i] = _bytes(x)
            columns["n_edits"][i] += len(edits)
            columns["n_tokens_after"][i] = len(tree)
            columns["n_encoded"][i] += tree.encoded
        kinds = [pa.int64(), pa.string(), *[pa.binary()] * 3, *[pa.int64()] * 5]
        yield pa.RecordBatch.from_arrays([pa.array(columns[c], k) for c, k in zip(_STATE, kinds, strict=True)], _STATE)


def build(df: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The trees (STATE) of whole texts; a null text is empty. Repeated rows have a tree each."""
    return documents(df, id_col, text_col).mapInArrow(lambda x: _built(x, tokenizer(_installed(vocabulary))), STATE)


def with_edits(state: DataFrame, find: Callable[[str], Edits]) -> DataFrame:
    """Trees and the edits that ``find`` makes of their texts."""
    return state.select(*_STATE).mapInArrow(lambda x: _found(x, find), f"{STATE}, edits {EDITS}")


def apply(state: DataFrame, vocabulary: str, edits_col: str = "edits") -> DataFrame:
    """Trees (STATE) after their edits, applied in their order, each to the text as those before have left it.

    Null edits are none, and a null text of one is empty. Only leaves that an edit touches are encoded again.
    """
    own = state.select(*_STATE, F.col(edits_col).cast(EDITS).alias("edits"))
    return own.mapInArrow(lambda x: _applied(x, tokenizer(_installed(vocabulary))), STATE)


def edited(df: DataFrame, vocabulary: str, rounds: tuple[Callable[[str], Edits], ...], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Trees (STATE) of texts after rounds of edits: build(), then with_edits() and apply() for each, in one pass.

    The rounds share one Python worker and its tokenizer; each takes up the trees that the one before has left.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(_installed(vocabulary))
        out = _built(batches, own)
        for find in rounds:
            out = _applied(_found(out, find), own)
        return out

    return documents(df, id_col, text_col).mapInArrow(run, STATE)


_COUNTS = ("n_tokens", "n_edits", "n_tokens_after", "n_chars_after", "n_pretokens", "n_encoded")


def counts(state: DataFrame) -> DataFrame:
    """doc_id, n_tokens, n_edits, n_tokens_after, n_chars_after, n_pretokens, n_encoded of each tree.

    n_encoded is how many pre-tokens the edits encoded again, of n_pretokens that the first text had.
    """
    return state.withColumn("n_chars_after", F.length("text").cast("long")).select("doc_id", *_COUNTS)


def count(df: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", edits_col: str = "edits") -> DataFrame:
    """counts() of the rows' texts after the edits that each row has; where no state is kept."""
    edits = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(edits_col).cast(EDITS).alias("edits"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(_installed(vocabulary))
        for pack in packs(batches, 4 << 20):
            rows = []
            for text, found in zip(pack["text"], pack["edits"], strict=True):
                tree = Tree.of(text or "", own)
                before, pretokens = len(tree), len(tree._lengths)
                for e in found or ():
                    tree.edit(e["start"] or 0, e["end"] or 0, e["text"] or "")
                rows.append((before, len(found or ()), len(tree), tree.chars[1], pretokens, tree.encoded))
            yield pa.RecordBatch.from_arrays([pa.array(pack["doc_id"], pa.int64()), *(pa.array(c, pa.int64()) for c in zip(*rows, strict=True))], ["doc_id", *_COUNTS])

    return edits.mapInArrow(run, "doc_id long, " + ", ".join(f"{c} long" for c in _COUNTS))
