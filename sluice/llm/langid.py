"""Language identification by words first: log frequencies of known words, character n-grams for the rest.

A word that is in the table of a language scores by its log frequency there. A word that no language knows is read as
its character n-grams with edge marks: the longest order of which any n-gram is known decides, and shorter ones are
only asked if none is. What is learnt from is a bounded sample of the labelled texts in which each language has the
same part, so the tables that tasks are sent are bounded; within it every word and n-gram counts, however rare.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import documents, keep_where, packs, sample

ORDERS = (5, 4, 3, 2, 1)
#: Labelled texts that are learnt from at most, and their bytes.
SAMPLE, SAMPLE_BYTES = 20_000, 32 << 20
_WORDS = regex.compile(r"\p{L}+")


def words(text: str) -> list[str]:
    """Runs of letters, in lower case."""
    return _WORDS.findall(text.lower())


def ngrams(word: str, n: int) -> list[str]:
    """The n-grams of a word between edge marks; single characters have no marks. Long words are read whole."""
    marked = f"<{word}>" if n > 1 else word
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


def word_counts(df: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """lang, word, n over all rows with a language; counted in each task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}

        def out():
            for lang, count in held.items():
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(count)), pa.array(count.keys(), pa.string()), pa.array(count.values(), pa.int64())], ["lang", "word", "n"])
            held.clear()

        for pack in packs(batches, 4 << 20):
            for text, lang in zip(pack["text"], pack["lang"], strict=True):
                held.setdefault(lang, Counter()).update(words(text or ""))
            if sum(map(len, held.values())) > 300_000:
                yield from out()
        yield from out()

    known = df.where(F.col(lang_col).isNotNull()).select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    return known.mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def ngram_counts(counted: DataFrame, orders: tuple[int, ...] = ORDERS) -> DataFrame:
    """lang, k (the order), gram, n, from word counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out():
            lang, k, gram = zip(*held, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(k, pa.int32()), pa.array(gram, pa.string()), pa.array(held.values(), pa.int64())], ["lang", "k", "gram", "n"])
            held.clear()

        for batch in batches:
            for lang, word, n in zip(*(batch.column(c).to_pylist() for c in ("lang", "word", "n")), strict=True):
                for k in orders:
                    for gram in ngrams(word, k):
                        held[lang, k, gram] += n
                if len(held) > 500_000:
                    yield from out()
        if held:
            yield from out()

    return counted.mapInArrow(run, "lang string, k int, gram string, n long").groupBy("lang", "k", "gram").agg(F.sum("n").alias("n"))


def fit(df: DataFrame, text_col: str = "text", lang_col: str = "lang", rows: int = SAMPLE, size: int = SAMPLE_BYTES) -> dict:
    """The tables {langs, grams, shares, floors} by order (0: words), learnt from a sample of the rows with a language.

    Of each language the texts of the least hashes are learnt from, as many as its part of ``rows`` and of ``size``
    bytes allows. A gram has its log10 share in each language; where a language doesn't have it, that is the floor: half
    an occurrence in the largest language. With no rows, or no words, there are no languages.
    """
    counted = word_counts(sample(df, lang_col, text_col, rows, size), text_col, lang_col).persist()
    both = counted.select("lang", F.lit(0).alias("k"), F.col("word").alias("gram"), "n").unionByName(ngram_counts(counted)).toArrow()
    counted.unpersist()
    lang, of_lang = np.unique(both.column("lang").to_numpy(zero_copy_only=False).astype(str), return_inverse=True)
    order, n, gram = both.column("k").to_numpy(), both.column("n").to_numpy(), both.column("gram")
    model: dict = {"langs": lang.tolist(), "grams": {}, "shares": {}, "floors": {}}
    for k in (0, *ORDERS):
        own = np.flatnonzero(order == k)
        found = pc.dictionary_encode(gram.take(pa.array(own)).combine_chunks())
        found = found.combine_chunks() if isinstance(found, pa.ChunkedArray) else found
        totals = np.bincount(of_lang[own], n[own], len(lang))
        floor = math.log10(0.5 / max(1.0, totals.max(initial=0.0)))
        shares = np.full((len(found.dictionary), len(lang)), floor)
        shares[found.indices.to_numpy(), of_lang[own]] = np.log10(n[own] / totals[of_lang[own]])
        model["grams"][k], model["shares"][k], model["floors"][k] = found.dictionary.to_pylist(), shares, floor
    return model


def packed(model: dict) -> dict:
    """A model as tasks are sent it: for each order the sorted 64-bit hashes of its grams, and their shares by row.

    Python keeps over 150 bytes for each entry of a dict of texts, an array 8; each worker has a copy of its own.
    """
    out = {"langs": model["langs"], "floors": model["floors"], "hashes": {}, "shares": {}}
    for k, grams in model["grams"].items():
        hashes = np.array(list(map(_hash, grams)), dtype=np.uint64)
        order = np.argsort(hashes)
        out["hashes"][k], out["shares"][k] = hashes[order], model["shares"][k][order]
        if (np.diff(out["hashes"][k]) == 0).any():
            raise ValueError("two grams have one hash")
    return out


def _hash(gram: str) -> int:
    return xxhash.xxh3_64_intdigest(gram.encode("utf-8", "surrogatepass"))


class Grams:
    """The grams of one order by their sorted hashes."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = hashes

    def find(self, grams: list[str]) -> np.ndarray:
        """The row of each gram; -1 if it isn't known."""
        wanted = np.array(list(map(_hash, grams)), dtype=np.uint64)
        if not len(self.hashes):
            return np.full(len(wanted), -1)
        at = np.minimum(np.searchsorted(self.hashes, wanted), len(self.hashes) - 1)
        return np.where(self.hashes[at] == wanted, at, -1)

    def __contains__(self, gram: str) -> bool:
        return self.find([gram])[0] >= 0


class Scorer:
    """Scores texts by a packed model; the scores of words are rows of a matrix, which starts anew when it has grown large."""

    def __init__(self, model: dict, limit: int = 400_000):
        model = model if "hashes" in model else packed(model)
        self.langs, self.floors, self.shares, self.limit = model["langs"], model["floors"], model["shares"], limit
        self.known = {k: Grams(hashes) for k, hashes in model["hashes"].items()}
        self.rows: dict[str, int] = {}
        self.values = np.zeros((1024, len(self.langs) + 1))

    def words(self, words: list[str]) -> list[np.ndarray | None]:
        """word() of each."""
        return [self.shares[0][at] if at >= 0 else self.parts(word) for word, at in zip(words, self.known[0].find(words).tolist(), strict=True)]

    def word(self, word: str) -> np.ndarray | None:
        """Log10 shares of a word by language; None if no order knows any part of it."""
        return self.words([word])[0]

    def parts(self, word: str) -> np.ndarray | None:
        for k in ORDERS:
            grams = ngrams(word, k)
            hits = self.known[k].find(grams)
            if len(hits := hits[hits >= 0]):
                return (self.shares[k][hits].sum(axis=0) + (len(grams) - len(hits)) * self.floors[k]) / len(grams)
        return None

    def read(self, words: list[str]) -> None:
        """A row for each new word: its scores, and 1 if any part of it is known."""
        first, most = len(self.rows), len(self.rows) + len(words)
        while most > len(self.values):
            self.values = np.concatenate([self.values, np.zeros_like(self.values)])
        self.values[first:most] = 0.0
        for at, (word, found) in enumerate(zip(words, self.words(words), strict=True), first):
            if found is not None:
                self.values[at, :-1], self.values[at, -1] = found, 1.0
            self.rows[word] = at

    def score(self, text: str | None) -> tuple[str, float]:
        """The likeliest language and its share among all, by word evidence that grows with the root of the words."""
        if len(self.rows) > self.limit:
            self.rows.clear()
        found = words(text or "")
        if not found or not self.langs:
            return "und", 0.0
        self.read([w for w in dict.fromkeys(found) if w not in self.rows])  # may replace the matrix
        rows = [self.rows[w] for w in found]
        *total, known = self.values[rows].sum(axis=0)
        odds = np.exp((np.array(total) - max(total)) * math.log(10) / math.sqrt(max(1, known)))
        best = int(odds.argmax())
        return self.langs[best], float(odds[best] / odds.sum())


def predict(df: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score of each whole text.

    A text that is null or has no letter is ``und`` with score 0; so is every text if nothing was learnt. Among equal
    scores the first language by name wins. Repeated rows are scored each.
    """
    shared = df.sparkSession.sparkContext.broadcast(packed(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Scorer(shared.value)
        for pack in packs(batches, 4 << 20):
            lang, score = zip(*map(own.score, pack["text"]), strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(pack["doc_id"], pa.int64()), pa.array(lang), pa.array(score, pa.float64())], ["doc_id", "lang_pred", "score"])

    return documents(df, id_col, text_col).mapInArrow(run, "doc_id long, lang_pred string, score double")


def keep(df: DataFrame, model: dict, least: float, text_col: str = "text") -> DataFrame:
    """The rows whose text has a likeliest language with a score of ``least`` or more; ``und`` rows go."""
    shared = df.sparkSession.sparkContext.broadcast(packed(model))

    def decide():
        own = Scorer(shared.value)
        return lambda texts: [lang != "und" and score >= least for lang, score in map(own.score, texts)]

    return keep_where(df, decide, text_col)
