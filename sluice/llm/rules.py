"""Quality rules on repetition: how much of a text lies in n-grams and lines that it repeats.

Words are numbered within their text, and each n-gram length has a rolling hash over those numbers (a polynomial
modulo 2**64, from prefix sums); equal hashes are checked word by word, so a repeat is a repeat. A character counts
once for a length, however many repeated n-grams cover it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sluice.llm.common import documents, keep_where, packs

#: n-gram length to the largest share of word characters that may lie in repeated n-grams.
COVERAGE = {5: 0.20, 6: 0.19, 7: 0.18, 8: 0.17, 9: 0.16, 10: 0.15}
#: Largest shares of lines, and of word characters in lines, that are equal to an earlier one.
LINES, LINE_CHARS = 0.30, 0.20
#: Largest number of symbols for each word.
SYMBOLS = 0.20
_SYMBOLS = "#*$%&|<>"
_SPACES = " \t\n\x0b\x0c\r"
_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15 | 1)
#: Only texts of so many words have shares that mean something.
LEAST_WORDS = 10


def number(words: list) -> np.ndarray:
    """Each word as the number of its first place among distinct words."""
    seen: dict = {}
    return np.array([seen.setdefault(w, len(seen)) for w in words], dtype=np.int64)


def rolling(ids: np.ndarray, powers: np.ndarray, n: int) -> np.ndarray:
    """Hash of each window of n: sum of (id + 1) * m**(last - place), modulo 2**64, from one Horner pass for all places."""
    out = np.zeros(len(ids) - n + 1, dtype=np.uint64)
    for j in range(n):
        out += (ids[j : j + len(out)].astype(np.uint64) + np.uint64(1)) * powers[n - 1 - j]
    return out


_POWERS = np.array([pow(int(_MULTIPLIER), k, 1 << 64) for k in range(64)], dtype=np.uint64)


def repeated(ids: np.ndarray, n: int) -> np.ndarray:
    """For each word: whether it lies in a window of n words that the text has twice or more, the first included."""
    covered = np.zeros(len(ids) + 1, dtype=np.int64)
    if len(ids) > n:
        hashes = rolling(ids, _POWERS, n)
        order = np.argsort(hashes, kind="stable")
        same = np.flatnonzero(hashes[order[1:]] == hashes[order[:-1]])
        if len(same):
            a, b = order[same], order[same + 1]
            equal = np.ones(len(a), dtype=bool)
            for j in range(n):
                equal &= ids[a + j] == ids[b + j]
            starts = np.unique(np.concatenate([a[equal], b[equal]]))
            np.add.at(covered, starts, 1)
            np.add.at(covered, starts + n, -1)
    return np.cumsum(covered[:-1]) > 0


def measure(text: str | None) -> dict:
    """The counts of one text; a null text counts as empty."""
    text = text or ""
    words = text.encode().split() if text.isascii() else _WORDS.findall(text)
    ids, lengths = number(words), np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    chars = int(lengths.sum())
    seen, lines, dup_lines, dup_chars = set(), 0, 0, 0
    for line in text.split("\n"):
        if line.strip(_SPACES):
            lines += 1
            if line in seen:
                dup_lines += 1
                dup_chars += sum(map(len, _WORDS.findall(line)))
            seen.add(line)
    five = repeated(ids, 5)
    any_five = bool(five.any())  # a longer repeated window has a repeated one of 5 in it
    longer = {n: int(lengths[five if n == 5 else repeated(ids, n)].sum()) if any_five else 0 for n in COVERAGE}
    out = {"n_words": len(words), "word_chars": chars, "n_symbols": sum(map(text.count, _SYMBOLS)), "n_dup_lines": dup_lines, "n_repeat_words": int(five.sum())}
    return out | {"n_lines": lines, "dup_line_chars": dup_chars} | {f"repeat_chars_{n}": x for n, x in longer.items()}


def verdict(m: dict) -> tuple[bool, str | None]:
    """Whether the base rule fails, and the first rule that a text breaks (null: none)."""
    failed = m["n_words"] < LEAST_WORDS or 100 * m["n_repeat_words"] > 20 * m["n_words"]
    if failed:
        return True, "base"
    for n, most in COVERAGE.items():
        if m[f"repeat_chars_{n}"] > most * m["word_chars"]:
            return False, f"repeat_{n}"
    if m["n_dup_lines"] > LINES * m["n_lines"]:
        return False, "dup_lines"
    if m["dup_line_chars"] > LINE_CHARS * m["word_chars"]:
        return False, "dup_line_chars"
    if m["n_symbols"] > SYMBOLS * m["n_words"]:
        return False, "symbols"
    return False, None


_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "dup_line_chars", *(f"repeat_chars_{n}" for n in COVERAGE))
SCHEMA = "doc_id long, " + ", ".join(f"{c} long" for c in _COUNTS) + ", base_failed boolean, kept boolean, broken string"


def judge(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts, base_failed, kept and the broken rule of each whole text.

    Null and empty texts have zero counts and fail the base rule. A row is judged by its own text alone, so repeated
    rows get equal results and an empty table gives none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pack in packs(batches, 4 << 20):
            found = [measure(x) for x in pack["text"]]
            said = [verdict(m) for m in found]
            columns = [pa.array(pack["doc_id"], pa.int64()), *[pa.array([m[c] for m in found], pa.int64()) for c in _COUNTS]]
            columns += [pa.array([failed for failed, _ in said]), pa.array([not failed and why is None for failed, why in said]), pa.array([why for _, why in said], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", *_COUNTS, "base_failed", "kept", "broken"])

    return documents(df, id_col, text_col).mapInArrow(run, SCHEMA)


def keep(df: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows whose text no rule rejects; null and empty texts go."""
    return keep_where(df, lambda: lambda texts: [verdict(measure(x)) == (False, None) for x in texts], text_col)
