"""Quality scores by a generalised additive model with pairwise interactions.

Features of a text are cut into bins. Boosting goes round the features again and again, each time fitting a tree of
few leaves to one feature's bins and adding it to that feature's lookup table, so the model stays a sum of tables; then
the pairs of features that explain most of what is left get tables of their own the same way. A score is the
logistic of a sum of table entries, looked up for all rows at once.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import documents, packs
from sluice.llm.rules import number, repeated

FEATURES = (
    "log_chars", "word_length", "longest_word", "upper", "digits", "symbols", "marks", "exclamations", "bars", "high_bytes", "capital_words",
    "short_words", "distinct_words", "top_word", "same_as_last", "repeated_5", "repeated_lines", "words_a_line", "symbol_words",
)
_CLASS = np.zeros(256, dtype=np.int64)
for _k, _bytes in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#*$%&|<>", b".,;:?'\"()-", b"!", bytes(range(128, 256))), 1):
    _CLASS[list(_bytes)] = _k
#: Rows that a fit takes at most; those with the least hash of their id, so the same ones each time.
SAMPLE = 20_000
BINS, ROUNDS, PAIR_ROUNDS, PAIRS, RATE, SMOOTH = 48, 250, 100, 8, 0.08, 2.0


def features(text: str | None) -> list[float]:
    """Numbers of a whole text that don't depend on its language; a null text is empty, an empty one all zeros."""
    raw = (text or "").encode()
    words = raw.split()
    if not words:
        return [0.0] * len(FEATURES)
    by_class = np.bincount(_CLASS[np.frombuffer(raw, dtype=np.uint8)], minlength=7) / len(raw)
    lengths, ids = np.fromiter(map(len, words), dtype=np.int64, count=len(words)), number(words)
    counts, n = np.bincount(ids), len(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    seen = Counter(lines)
    marked = sum(w[-1:] in b"#*$%&|<>" for w in words)
    return [
        float(np.log1p(len(raw))), float(lengths.mean()), float(np.log1p(lengths.max())), *(float(x) for x in by_class[1:6]), raw.count(b"|") / len(raw), float(by_class[6]),
        sum(map(bytes.isupper, words)) / n, float((lengths < 3).mean()), len(counts) / n, float(counts.max()) / n, float((ids[1:] == ids[:-1]).mean()) if n > 1 else 0.0,
        float(repeated(ids, 5).mean()), 1 - len(seen) / len(lines), float(np.log1p(n / len(lines))), marked / n,
    ]


def _tree(g: np.ndarray, h: np.ndarray, leaves: int = 3) -> np.ndarray:
    """Newton steps by bin from a tree that cuts the bins into ``leaves`` runs, the best cut first."""
    cuts = [0, len(g)]
    gain = lambda a, b: (a * a) / (b + SMOOTH)
    for _ in range(leaves - 1):
        best = (1e-9, None)
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            gs, hs = np.cumsum(g[lo:hi])[:-1], np.cumsum(h[lo:hi])[:-1]
            if len(gs):
                won = gain(gs, hs) + gain(g[lo:hi].sum() - gs, h[lo:hi].sum() - hs) - gain(g[lo:hi].sum(), h[lo:hi].sum())
                if won.max() > best[0]:
                    best = (won.max(), lo + 1 + int(won.argmax()))
        if best[1] is None:
            break
        cuts = sorted({*cuts, best[1]})
    out = np.zeros(len(g))
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        out[lo:hi] = g[lo:hi].sum() / (h[lo:hi].sum() + SMOOTH)
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """Steps by cell from a tree of four leaves, one cut in each feature, and the gain over no cut."""
    gs, hs = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    total = [(x[-1:, -1:], x[-1:, :], x[:, -1:], x) for x in (gs, hs)]
    quarters = [[x, row - x, col - x, all_ - row - col + x] for all_, row, col, x in ((t[0], t[1], t[2], t[3]) for t in total)]
    value = sum(a * a / (b + SMOOTH) for a, b in zip(*quarters, strict=True))
    i, j = np.unravel_index(value.argmax(), value.shape)
    out = np.empty_like(g)
    for (a, b), at in zip(zip(*quarters, strict=True), ((slice(None, i + 1), slice(None, j + 1)), (slice(i + 1, None), slice(None, j + 1)), (slice(None, i + 1), slice(j + 1, None)), (slice(i + 1, None), slice(j + 1, None))), strict=True):
        out[at] = a[i, j] / (b[i, j] + SMOOTH)
    return out, float(value[i, j] - gs[-1, -1] ** 2 / (hs[-1, -1] + SMOOTH))


def train(x: np.ndarray, y: np.ndarray) -> dict:
    """Bin edges and tables from features and labels (0 or 1). With one label only, or no rows, the score is its share."""
    n = len(y)
    share = (y.sum() + 1) / (n + 2)
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) if n else np.zeros(0) for f in range(len(FEATURES))]
    model = {"edges": edges, "start": float(np.log(share / (1 - share))), "tables": [np.zeros(len(e) + 1) for e in edges], "pairs": []}
    if not 0 < y.sum() < n:
        return model
    bins = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(edges)]
    total = np.full(n, model["start"])

    def slopes():
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for f, own in enumerate(bins):
            g, h = slopes()
            step = RATE * _tree(np.bincount(own, g, len(edges[f]) + 1), np.bincount(own, h, len(edges[f]) + 1))
            model["tables"][f] += step
            total += step[own]
    coarse = [np.searchsorted(e[3::4], x[:, f], side="right") for f, e in enumerate(edges)]
    sizes = [len(e[3::4]) + 1 for e in edges]

    def grid(i, j, values):
        return np.bincount(coarse[i] * sizes[j] + coarse[j], values, sizes[i] * sizes[j]).reshape(sizes[i], sizes[j])

    g, h = slopes()
    gains = sorted(((_pair_tree(grid(i, j, g), grid(i, j, h))[1], i, j) for i, j in combinations(range(len(edges)), 2) if sizes[i] > 1 and sizes[j] > 1), reverse=True)
    model["pairs"] = [(i, j, np.zeros((sizes[i], sizes[j]))) for _, i, j in gains[:PAIRS]]
    for _ in range(PAIR_ROUNDS):
        for i, j, table in model["pairs"]:
            g, h = slopes()
            step = RATE * _pair_tree(grid(i, j, g), grid(i, j, h))[0]
            table += step
            total += step[coarse[i], coarse[j]]
    return model


def evaluate(model: dict, x: np.ndarray) -> np.ndarray:
    """Scores of rows of features by additions of table entries."""
    total = np.full(len(x), model["start"])
    for f, (edges, table) in enumerate(zip(model["edges"], model["tables"], strict=True)):
        total += table[np.searchsorted(edges, x[:, f], side="right")]
    for i, j, table in model["pairs"]:
        total += table[np.searchsorted(model["edges"][i][3::4], x[:, i], side="right"), np.searchsorted(model["edges"][j][3::4], x[:, j], side="right")]
    return 1 / (1 + np.exp(-total))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", label_id_col: str = "doc_id", label_col: str = "quality") -> dict:
    """The model of at most ``sample`` labelled rows of ``docs``; null labels and ids are left out.

    The sample is that of the least id hashes among labelled rows, and ids are all that is looked up by broadcast. Rows
    that repeat an id count as one.
    """
    named = labels.select(F.col(label_id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label")).where("doc_id is not null and label is not null")
    have = docs.select(F.col(id_col).cast("long").alias("doc_id"))
    chosen = named.join(have, "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pack in packs(batches, 4 << 20):
            yield pa.RecordBatch.from_arrays([pa.array(pack["label"], pa.int32()), pa.array([features(t) for t in pack["text"]], pa.list_(pa.float64()))], ["label", "x"])

    rows = documents(docs, id_col, text_col).join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text")).mapInArrow(run, "label int, x array<double>").collect()
    rows = sorted((list(r.x), r.label) for r in rows)  # the order of rows has no say
    return train(np.array([x for x, _ in rows], dtype=np.float64).reshape(-1, len(FEATURES)), np.array([y for _, y in rows], dtype=np.float64))


def score(df: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """doc_id, score (0 to 1) and predicted (1 from the threshold on) of each whole text.

    Null and empty texts have all features zero and a score like any other; repeated rows are scored each.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pack in packs(batches, 4 << 20):
            found = evaluate(shared.value, np.array([features(t) for t in pack["text"]], dtype=np.float64))
            yield pa.RecordBatch.from_arrays([pa.array(pack["doc_id"], pa.int64()), pa.array(found), pa.array((found >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

    return documents(df, id_col, text_col).mapInArrow(run, "doc_id long, score double, predicted int")
