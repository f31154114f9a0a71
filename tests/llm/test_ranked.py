"""Ranked search: against SQL and brute force, in blocks, with shared sets, and on odd rows."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from sluice.llm import queries, ranked
from tests import oracle

DOCS = "doc_id long, text string, score long, n long, item_id string"
ITEMS = "item_id long, text string, doc_id int, rank int"


def tokens(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(docs, items, k):
    words = [(i, tokens(t)) for i, t in docs]
    words = [(i, w) for i, w in words if w]
    n_docs, total, df = len(words), sum(len(w) for _, w in words), Counter(t for _, w in words for t in set(w))
    out = []
    for item, text in items:
        scored = []
        for doc, w in words:
            tf, m = Counter(w), 50 + (50 * len(w) * n_docs) // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 20 * m)) for t in set(tokens(text)) if tf[t])
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, r, doc, -s) for r, (s, _, _, doc) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=str)


def test_query_agrees_with_sql(spark, sf_dir):
    oracle.compare(queries.op12_ranked_search(spark, sf_dir), oracle.connect(sf_dir), queries.oracle_sql()["op12_ranked_search"])


def texts(seed, n, words=40):
    r = random.Random(seed)
    return [" ".join(r.choice(["The", "of", "a-b", "été", "X1", "漢字", *[f"w{i}" for i in range(30)]]) for _ in range(r.randrange(words))) for _ in range(n)]


@pytest.mark.parametrize("block", [1, 60, 10**6])
def test_brute_force(spark, block):
    """Ties, repeated and null ids, null, empty and long texts on both sides; blocks of any size give the same rows."""
    docs = [*enumerate(texts(1, 120)), (5, "x1 the"), (5, "x1 the"), (None, "of of été"), (None, None), (900, None), (901, ""), (902, "--"), (903, "The " * 400_000), (904, "w1 " * 3 + "q" * 3_000_000)]
    items = [*enumerate(texts(2, 25)), (3, "the x1"), (None, "of"), (50, None), (51, ""), (52, "unheard"), (53, "w1 w2 w1")]
    df = spark.createDataFrame([(i, t, 1, 2, "c") for i, t in docs], DOCS).repartition(7)
    found = ranked.rank(df, spark.createDataFrame([(i, t, 1, 2) for i, t in items], ITEMS), 9, block_terms=block)
    assert sorted(map(tuple, found.collect()), key=str) == brute(docs, items, 9)


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b", 1, 2, "c")], DOCS), spark.createDataFrame([(1, "a", 1, 2)], ITEMS)
    for d, i in ((docs.limit(0), items), (docs, items.limit(0)), (docs, items.limit(0).union(spark.createDataFrame([(1, None, 1, 2)], ITEMS)))):
        found = ranked.rank(d, i)
        assert found.columns == ["item_id", "rank", "doc_id", "score"] and found.count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_graph_gives_each_items_sum(seed):
    """Sums along the graph equal plain sums; what items share costs fewer additions than item by item."""
    r = random.Random(seed)
    themes = [r.sample(range(200), 15) for _ in range(8)]
    items = [sorted({*sum(r.sample(themes, 3), []), *r.sample(range(200), 4)}) for _ in range(60)] + [[], [7]]
    graph, small = ranked.share(items, 200), np.random.default_rng(seed).integers(0, 1000, (200, 11))
    scores = np.zeros((200 + len(graph.left), 11), np.int64)
    scores[:200] = small
    assert (ranked.accumulate(graph, scores) == np.array([small[t].sum(axis=0) for t in items])).all()
    assert graph.additions < 0.6 * sum(max(0, len(t) - 1) for t in items)


def test_terms_of_long_texts():
    text = ("Ab é1 " * 300_000 + "c" * 2_500_000 + " z").encode()
    assert ranked.term_counts(text) == (600_002, Counter({b"ab": 300_000, "é1".encode(): 300_000, b"c" * 2_500_000: 1, b"z": 1}))
