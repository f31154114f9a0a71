"""The tree of conversations' beginnings: against SQL, brute force in all shapes and sizes of components, and on odd rows."""

import hashlib
import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

from sluice.llm import prefixtree, queries
from tests import oracle

TURNS = "conv_id long, turn long, role string, text string, depth int, node string, n_convs int"


def tree(df, small=8192):
    return prefixtree.tree(df, F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6, F.col("conv_id") - F.col("conv_id") % 100, small=small)


def brute(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            digest = hashlib.sha256(f"{len(role or '')}:{role or ''}{text or ''}".encode()).digest()
            own.setdefault(c, []).append(((turn is not None, turn or 0, digest), role or "", text or ""))
    own = {c: [x[1:] for x in sorted(v, key=lambda x: x[0])] for c, v in own.items()}
    members = {}
    ends = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        whole = own.get(c - int(math.fmod(c, 100)), [])[:h] + turns[h:]
        for d in range(len(whole) + 1):
            members.setdefault(tuple(whole[:d]), []).append(c)
        ends.setdefault(tuple(whole), []).append(c)
    nodes = {k: [min(v), len(k), min(members[k[:-1]]) if k else None, len(v), 0, 0, 0] for k, v in members.items()}
    for k in nodes:
        if k:
            nodes[k[:-1]][4] += 1
    for k, n in nodes.items():
        for d in range(len(k) + 1):
            up = nodes[k[:d]]
            up[5] += n[4] == 0
            up[6] += (n[3] - 1) * (len(k[-1][1]) if k else 0)
    return sorted((*n, hashlib.sha256(",".join(map(str, sorted(ends.get(k, [])))).encode()).hexdigest()) for k, n in ((k, [n[0], n[1], -1 if n[2] is None else n[2], *n[3:]]) for k, n in nodes.items()))


def got(df):
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in df.collect())


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], TURNS).repartition(5)


def test_query_agrees_with_sql(spark, sf_dir):
    oracle.compare(queries.op13_prefix_tree(spark, sf_dir), oracle.connect(sf_dir), queries.oracle_sql()["op13_prefix_tree"])


def branching(seed):
    """Few words, so that beginnings are shared; some conversations are missing, some lack turns, one is long."""
    r = random.Random(seed)
    convs = r.sample(range(330), 60) + [100, 0]
    rows = [(c, t, r.choice(["u", "a"]), r.choice(["", "x", "yy", "zzz é"])) for c in sorted(set(convs)) for t in range(r.randrange(1, 7))]
    return rows + [(7, t, "u", "x" * (t % 3)) for t in range(10, 60)]


@pytest.mark.parametrize("small", [70, 8192])
def test_components_of_any_size(spark, small):
    rows = branching(3)
    assert got(tree(table(spark, rows), small=small)) == brute(rows)


def test_assumed_sizes_stay_small_over_steps(spark, monkeypatch):
    """Each step of the search joins what the last one found: the size that Spark assumes must not grow by its square."""
    real, bits = prefixtree.cut, []

    def cut(df):
        out = real(df)
        bits.append(int(out._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()).bit_length())
        return out

    monkeypatch.setattr(prefixtree, "cut", cut)
    rows = branching(3)
    assert got(tree(table(spark, rows), small=70)) == brute(rows) and max(bits) < 2048


def test_odd_rows(spark):
    """Null turns, roles, texts and ids, ties, repeated rows, long texts, negative ids, and copies of a conversation."""
    rows = [(1, None, "u", "n"), (1, 0, None, None), (1, 0, "u", None), (1, 0, "u", "b"), (1, 0, "u", "b"), (None, 1, "u", "lost"), (-150, 0, "u", "x" * 300_000), (-150, 1, "", "1:uy")]
    rows += [(100 + i, t, "u", f"turn {t}") for i in range(40) for t in range(4)]
    assert got(tree(table(spark, rows), small=60)) == brute(rows)


def test_empty_table(spark):
    found = tree(table(spark, [(1, 1, "u", "x")]).where("false"))
    assert found.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"] and found.count() == 0


def test_many_ends_are_hashed_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(prefixtree, "CHUNK", 100)
    rows = [(c, 0, "u", "same") for c in range(1, 300)]
    assert got(prefixtree.tree(table(spark, rows), F.lit(0), F.col("conv_id"))) == sorted([(1, 0, -1, 299, 1, 1, 298 * 4, hashlib.sha256().hexdigest()), (1, 1, 1, 299, 0, 1, 298 * 4, hashlib.sha256(",".join(map(str, range(1, 300))).encode()).hexdigest())])


def test_hashes_that_meet_are_told_apart(spark, monkeypatch):
    """Running hashes that say nothing at first are noticed and made anew."""
    real = prefixtree._prefixes
    monkeypatch.setattr(prefixtree, "_prefixes", lambda t, salt: real(t, salt) if salt else real(t, 0).withColumns({x: F.lit(0).cast("long") for x in ("a", "b", "own_a", "own_b")}))
    rows = branching(5)[:60]
    assert got(tree(table(spark, rows))) == brute(rows)


@pytest.mark.parametrize("n, chain", [(1, 0.5), (2, 0.0), (300, 0.0), (300, 0.9), (300, 1.0)])
def test_decompose(n, chain):
    r = random.Random(n)
    parents = [-1] + [i - 1 if r.random() < chain else r.randrange(i) for i in range(1, n)]
    values = [(r.randrange(9), i) for i in range(n)]
    plain = [list(v) for v in values]
    for v in range(n - 1, 0, -1):
        for k in (0, 1):
            plain[parents[v]][k] += plain[v][k]
    assert prefixtree.decompose(parents, values) == [tuple(v) for v in plain]
