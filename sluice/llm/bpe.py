"""Byte-level BPE through sentencepiece: the model is serialised straight from a rank file.

Every byte has a printable character of its own, a piece is the characters of its bytes, and its score is the
negative rank; sentencepiece merges the adjacent pair whose piece scores highest, leftmost first, which is the merge
order that ranks mean. Normalisation is the identity. A pre-token that is a piece as a whole is that piece, as
rank files are read; all others go through the model. Decoding maps ids back to bytes.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
import regex
import sentencepiece
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import Cache, documents, packs

#: Fixed value: the pre-token pattern of the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: From here on Unicode versions may class a character differently; such characters are asked for one by one.
_LATE = regex.compile("[԰-\U0010ffff]")


def byte_characters() -> list[str]:
    """A character for each byte: itself where it is printable and no space, else the next one from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file with a base64 token and a rank in each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, f))}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value: bytes | int) -> bytes:
    """A protocol-buffer field: bytes are length-delimited, an int is a varint."""
    return _varint(number << 3) + _varint(value) if isinstance(value, int) else _varint(number << 3 | 2) + _varint(len(value)) + value


def serialise(ranks: dict[bytes, int]) -> bytes:
    """The sentencepiece model: pieces in rank order, then the unknown piece that a model must have."""
    chars = byte_characters()
    normal, unknown, bpe = 1, 2, 2
    out = bytearray()
    for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
        piece = "".join(chars[b] for b in token).encode()
        out += _field(1, _field(1, piece) + _varint(2 << 3 | 5) + struct.pack("<f", -rank) + _field(3, normal))
    out += _field(1, _field(1, b"<unk>") + _varint(2 << 3 | 5) + struct.pack("<f", 0.0) + _field(3, unknown))
    none = (1 << 64) - 1
    out += _field(2, _field(3, bpe) + _field(4, len(ranks) + 1) + _field(40, len(ranks)) + b"".join(_field(k, none) for k in (41, 42, 43)))
    out += _field(3, _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0))
    return bytes(out)


class Tokenizer:
    """Encoding and decoding by a rank file whose ranks are 0, 1, 2, ... without gaps."""

    def __init__(self, path: str, pattern: str = PATTERN):
        self.ranks = read_ranks(path)
        self.pattern, self.table = regex.compile(pattern), [b""] * len(self.ranks)
        for token, rank in self.ranks.items():
            self.table[rank] = token
        self.chars = str.maketrans(dict(enumerate(byte_characters())))
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialise(self.ranks))
        self.cache = Cache(self._piece)
        self.classes: dict[str, str] = {}

    def _piece(self, pretoken: str) -> tuple[int, ...]:
        raw = pretoken.encode()
        if (whole := self.ranks.get(raw)) is not None:
            return (whole,)
        return tuple(self.model.encode(raw.decode("latin-1").translate(self.chars)))

    def _stand_in(self, ch: str) -> str:
        """A character that every Unicode version classes as the rank file's library classes ch."""
        import tiktoken

        if not self.classes:
            own = {bytes([b]): b for b in range(256)}
            self.probes = [(tiktoken.Encoding(k, pat_str=p, mergeable_ranks=own, special_tokens={}), to) for k, p, to in (("l", r"\p{L}+", "a"), ("n", r"\p{N}+", "1"), ("s", r"\s+", "　"))]
        if ch not in self.classes:
            self.classes[ch] = next((to for probe, to in self.probes if probe.encode_ordinary(ch)), "!")
        return self.classes[ch]

    def pretokens(self, text: str) -> list[str]:
        """The matches of the pattern, in order; together they are the whole text."""
        if not _LATE.search(text):
            return self.pattern.findall(text)
        shadow = _LATE.sub(lambda m: self._stand_in(m[0]), text)
        return [text[m.start() : m.end()] for m in self.pattern.finditer(shadow)]

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self.cache.__getitem__, self.pretokens(text))))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.table.__getitem__, ids))


@lru_cache(maxsize=4)
def tokenizer(path: str, pattern: str = PATTERN) -> Tokenizer:
    """One for each worker process; the model is built from the vocabulary once."""
    return Tokenizer(path, pattern)


def encode(df: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", pattern: str = PATTERN) -> DataFrame:
    """doc_id and ids (array of int) of each whole text. A null or empty text has no ids; repeated rows stay.

    ``vocabulary`` is the path of a rank file that is installed on every machine, or one given to addFile().
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(_installed(vocabulary), pattern)
        for pack in packs(batches, 4 << 20):
            yield pa.RecordBatch.from_arrays([pa.array(pack["doc_id"], pa.int64()), pa.array([own.encode(x or "") for x in pack["text"]], pa.list_(pa.int32()))], ["doc_id", "ids"])

    return documents(df, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>")


def decode(df: DataFrame, vocabulary: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id and the bytes that the ids stand for; null ids decode to no bytes. An id that the vocabulary has not, and a
    null among ids, stands for the replacement character."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(_installed(vocabulary))
        for batch in batches:
            found = [b"".join(own.table[i] if i is not None and 0 <= i < len(own.table) else b"\xef\xbf\xbd" for i in x or []) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.binary())], ["doc_id", "bytes"])

    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).alias("ids")).mapInArrow(run, "doc_id long, bytes binary")


def digests(df: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 (and ids): each text encoded, its ids decoded again.

    A null or empty text has 0 tokens and twice the digest of nothing.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(_installed(vocabulary))
        names = [str(i) for i in range(len(own.table))]
        for pack in packs(batches, 4 << 20):
            encoded = [own.encode(text or "") for text in pack["text"]]
            joined = [hashlib.sha256(",".join(map(names.__getitem__, ids)).encode()).hexdigest() for ids in encoded]
            decoded = [hashlib.sha256(own.decode(ids)).hexdigest() for ids in encoded]
            columns = [pa.array(pack["doc_id"], pa.int64()), pa.array(list(map(len, encoded)), pa.int64()), pa.array(joined), pa.array(decoded)]
            if with_ids:
                columns.append(pa.array(encoded, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"][: len(columns)])

    return documents(df, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids)


def _installed(vocabulary: str) -> str:
    """A bare file name is one of addFile(); a path is used as it is."""
    return vocabulary if "/" in vocabulary else SparkFiles.get(vocabulary)
