"""The tree of shared beginnings of conversations, with sums over subtrees by centroid decomposition.

A node is a sequence of first turns; its name is (least conversation that starts with it, number of turns). Sequences are
told apart by running hashes, checked turn by turn: rows of a node have to agree in the last turn and in the node before.
Positions and running hashes come from sorted ranges and the sums before them, so a conversation of any length is split.

Sums over subtrees: a component of the parent-edge forest is cut at its centroid, whose subtree's total is added to the
centroid and to the nodes on the path from it to the component's top; what is left of the component and the centroid's
children's subtrees are components again. Large components are cut by Spark, all at once in each round, as runs of nodes
of one conversation; the centroid's depth is found by bisection. Small ones are cut further by tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import cut, renewed

#: Nodes of a component that a task cuts by itself, and bytes of ids that are hashed at once.
SMALL, CHUNK = 8192, 1 << 20
#: Turns of another conversation that one can begin with.
MOST_LEAD = 5


def _turns(conversations: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """conv_id, turn, the SHA-256 of role and text, and the text's code points; texts go no further."""
    said = F.coalesce(F.col(text).cast("string"), F.lit(""))
    who = F.coalesce(F.col(role).cast("string"), F.lit(""))
    digest = F.unhex(F.sha2(F.concat(F.char_length(who).cast("string"), F.lit(":"), who, said), 256))
    return conversations.select(F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"), digest.alias("digest"), F.char_length(said).cast("long").alias("chars")).where("conv_id is not null")


def _numbered(turns: DataFrame) -> DataFrame:
    """turns with part and pos (from 1 in each conversation)."""
    order = [F.col("turn").asc_nulls_first(), F.col("digest")]
    ranged = cut(turns.repartitionByRange(F.col("conv_id"), *order).sortWithinPartitions(F.col("conv_id"), *order).withColumn("part", F.spark_partition_id()))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("conv_id", "part").agg(F.count("*").alias("n")).select("conv_id", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return ranged.join(starts, ["conv_id", "part"]).withColumn("pos", F.row_number().over(Window.partitionBy("conv_id", "part").orderBy(*order)) + F.col("start")).drop("start", "turn")


def rebuilt(conversations: DataFrame, lead: Column, of: Column, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Conversations begun anew, and all their turns: (conv_id, n_turns) and (conv_id, part, depth, digest, chars).

    Conversation c takes the first ``lead`` (at most MOST_LEAD, an expression of conv_id) turns of conversation ``of``,
    all if it has fewer, none if it is absent, then its own after its first ``lead``. Turns go by turn, null first;
    those of one number by the SHA-256 of their role and text.
    """
    turns = cut(_numbered(_turns(conversations, conv_id, turn, role, text)))
    convs = turns.groupBy("conv_id").agg(F.max("pos").alias("n")).select("conv_id", "n", lead.cast("long").alias("h"), of.cast("long").alias("base"))
    first = turns.where(F.col("pos") <= MOST_LEAD).select(F.col("conv_id").alias("base"), "pos", "digest", "chars").join(convs.select("base").distinct(), "base", "left_semi")
    counts = first.groupBy("base").agg(F.count("*").alias("has"))
    convs = convs.join(counts, "base", "left").withColumn("taken", F.least("h", F.coalesce("has", F.lit(0)))).select("conv_id", "base", "h", "taken", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n_turns"))
    convs = cut(convs)
    own = turns.join(convs.select("conv_id", "h", "taken"), "conv_id").where("pos > h").select("conv_id", "part", (F.col("pos") - F.col("h") + F.col("taken")).alias("depth"), "digest", "chars")
    led = convs.where("taken > 0").join(first, "base").where("pos <= taken").select("conv_id", F.lit(-1).alias("part"), F.col("pos").alias("depth"), "digest", "chars")
    return convs.select("conv_id", "n_turns"), led.unionByName(own.withColumn("depth", F.col("depth").cast("long")))


def _prefixes(turns: DataFrame, salt: int) -> DataFrame:
    """turns with a and b, hashes of all turns up to each, and own_a and own_b, those of the turn itself."""
    hashed = turns.withColumns({f"own_{x}": F.xxhash64(F.lit(2 * salt + i), F.col("depth"), F.col("digest"), F.lit(i)) for i, x in enumerate("ab")})
    to = Window.partitionBy("conv_id", "part").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = hashed.groupBy("conv_id", "part").agg(*[F.bit_xor(f"own_{x}").alias(x) for x in "ab"])
    starts = parts.select("conv_id", "part", *[F.coalesce(F.bit_xor(x).over(before), F.lit(0)).alias(f"start_{x}") for x in "ab"])
    met = hashed.join(starts, ["conv_id", "part"])
    return met.withColumns({x: F.bit_xor(f"own_{x}").over(to).bitwiseXOR(F.col(f"start_{x}")) for x in "ab"}).drop("start_a", "start_b", "part")


def _named(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes (conv_id, depth, n_convs, chars, up_a, up_b) without the root, and the node of each turn (conv_id, depth, node)."""
    salt = 0
    while True:
        rows = cut(_prefixes(turns, salt))
        up = F.struct(F.col("a").bitwiseXOR(F.col("own_a")).alias("a"), F.col("b").bitwiseXOR(F.col("own_b")).alias("b"), F.col("digest").alias("digest"))
        nodes = cut(rows.groupBy("depth", "a", "b").agg(F.min("conv_id").alias("node"), F.count("*").alias("n_convs"), F.max("chars").alias("chars"), F.min(up).alias("least"), F.max(up).alias("most")))
        if nodes.where("least <> most").isEmpty():  # by induction over depth, a node's rows are then the same sequence
            break
        salt += 1
    paths = cut(rows.select("conv_id", "depth", "a", "b").join(nodes.select("depth", "a", "b", "node"), ["depth", "a", "b"]).select("conv_id", "depth", "node"))
    return nodes.select(F.col("node").alias("conv_id"), "depth", "n_convs", "chars"), paths


def _ends(paths: DataFrame, convs: DataFrame) -> DataFrame:
    """conv_id, depth, ends_sha256 of nodes at which conversations end: ids in order, joined to chunks, chunks hashed in order.

    A hash can't be split, so one task reads a node's chunks one after the other; ids are sorted and joined by ranges.
    """
    ends = paths.join(convs.select("conv_id", F.col("n_turns").alias("depth")), ["conv_id", "depth"]).select("node", "depth", "conv_id")

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, held, size = None, [], 0

        def out(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [[]] * 4, (pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True)], names=["node", "depth", "first", "ids"])

        for batch in batches:
            rows = []
            for n, d, c in zip(*(batch.column(x).to_pylist() for x in ("node", "depth", "conv_id")), strict=True):
                if held and (node != (n, d) or size > CHUNK):
                    rows.append((*node, held[0], ",".join(map(str, held))))
                    held, size = [], 0
                node = (n, d)
                held.append(c)
                size += 20
            yield out(rows)
        if held:
            yield out([(*node, held[0], ",".join(map(str, held)))])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None

        def out(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [[]] * 3, (pa.int64(), pa.int64(), pa.string()), strict=True)], names=["conv_id", "depth", "ends_sha256"])

        for batch in batches:
            rows = []
            for n, d, ids in zip(*(batch.column(x).to_pylist() for x in ("node", "depth", "ids")), strict=True):
                if node == (n, d):
                    state.update(b",")
                else:
                    if node:
                        rows.append((*node, state.hexdigest()))
                    node, state = (n, d), hashlib.sha256()
                state.update(ids.encode())
            yield out(rows)
        if node:
            yield out([(*node, state.hexdigest())])

    joined = ends.repartitionByRange("node", "depth", "conv_id").sortWithinPartitions("node", "depth", "conv_id").mapInArrow(chunks, "node long, depth long, first long, ids string")
    return joined.repartition("node", "depth").sortWithinPartitions("node", "depth", "first").mapInArrow(digests, "conv_id long, depth long, ends_sha256 string")


# ---- sums over subtrees --------------------------------------------------------------------------------------------


def decompose(parents: list[int], values: list[tuple]) -> list[tuple]:
    """Sums of values over the subtree of each node of a tree; a parent stands before its children, the top has -1.

    Each component is cut at its centroid, the deepest node with at least half of it below; the total below goes to the
    centroid and up its path to the top.
    """
    width = len(values[0]) if values else 0
    sums = [[0] * width for _ in parents]
    todo = [list(range(len(parents)))] if parents else []
    while todo:
        nodes = todo.pop()
        top, size = nodes[0], dict.fromkeys(nodes, 1)
        for v in reversed(nodes[1:]):
            size[parents[v]] += size[v]
        centroid = top
        for v in nodes:  # nodes with half of all below them lie on one path
            if 2 * size[v] >= len(nodes):
                centroid = v
        part = {centroid: centroid}  # the child of the centroid whose subtree a node is in
        for v in nodes:
            if v not in part and (p := parents[v]) in part and v != top:
                part[v] = v if p == centroid else part[p]
        total = [sum(values[v][k] for v in part) for k in range(width)]
        at = centroid
        while True:
            for k in range(width):
                sums[at][k] += total[k]
            if at == top:
                break
            at = parents[at]
        below: dict[int, list[int]] = {}
        for v in nodes:
            if v != centroid:
                below.setdefault(part.get(v, -1), []).append(v)
        todo += below.values()
    return [tuple(s) for s in sums]


def _small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """decompose() for the components of a task, which come one after the other, each by depth."""
    names, held, at = ["conv_id", "depth", "n_leaves", "saved_tokens"], [], None

    def sums(rows):
        place = {(r[2], r[3]): i for i, r in enumerate(rows)}
        found = decompose([place.get((r[4], r[3] - 1), -1) if i else -1 for i, r in enumerate(rows)], [(r[5], r[6]) for r in rows])
        return [(r[2], r[3], *s) for r, s in zip(rows, found, strict=True)]

    def out(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (list(zip(*rows)) or [[]] * 4)], names=names)

    for batch in batches:
        done = []
        for row in zip(*(batch.column(c).to_pylist() for c in ("top", "top_depth", "conv_id", "depth", "parent_conv_id", "leaf", "saved")), strict=True):
            if at != row[:2]:
                done += sums(held)
                at, held = row[:2], []
            held.append(row)
        yield out(done)
    yield out(sums(held))


def _cut_large(runs: DataFrame, paths: DataFrame, nodes: DataFrame, small: int) -> tuple[DataFrame, list[DataFrame]]:
    """Components of at most ``small`` nodes, as runs, and what centroids of the larger ones added to nodes.

    ``runs`` are (top, top_depth, conv_id, low, high): the nodes (conv_id, low..high) of the component with that top. Of
    the nodes of a depth that have at least half of a component below them there is one or none, and none below a depth
    without; so steps that double, then bisection, find the centroid: a
    join of runs and one depth of paths each.
    """
    name, added, done = ["top", "top_depth"], [], None
    at_depth = lambda d, alias: paths.select("conv_id", F.col("depth").alias(d), F.col("node").alias(alias))
    while True:
        sizes = cut(runs.groupBy(*name).agg(F.sum(F.col("high") - F.col("low") + 1).alias("n"), F.max("high").alias("deepest")).where(F.col("n") > small))
        if sizes.isEmpty():
            return (runs if done is None else cut(done.unionByName(runs))), added
        stays = runs.join(sizes.select(*name), name, "left_anti").select(*[(F.col(c) + 0).alias(c) for c in runs.columns])  # a union can't carry on how checkpoints lie
        done = cut(stays if done is None else done.unionByName(stays))
        large = cut(runs.join(sizes.select(*name), name, "left_semi"))
        search = renewed(sizes.select(*name, "n", F.col("top_depth").alias("low_d"), F.col("deepest").alias("high_d"), F.col("top").alias("centroid"), F.lit(1).cast("long").alias("step")))
        while not search.where("low_d < high_d").isEmpty():
            probe = search.withColumn("d", F.least(F.expr("(low_d + high_d + 1) div 2"), F.expr("low_d + step"))).where("low_d < high_d")
            deep = large.join(probe.select(*name, "n", "d"), name).where("high >= d").select(*name, "n", "conv_id", "d", (F.col("high") - F.greatest("low", "d") + 1).alias("size"))
            heavy = deep.join(at_depth("d", "node"), ["conv_id", "d"]).groupBy(*name, "n", "node").agg(F.sum("size").alias("below")).where(2 * F.col("below") >= F.col("n"))
            best = heavy.groupBy(*name).agg(F.min("node").alias("found"))  # two halves of equal size: either will do
            step = search.join(probe.select(*name, "d"), name, "left").join(best, name, "left")
            met, missed = F.col("found").isNotNull(), F.col("found").isNull() & F.col("d").isNotNull()
            search = renewed(step.select(*name, "n", F.when(met, F.col("d")).otherwise(F.col("low_d")).alias("low_d"), F.when(missed, F.col("d") - 1).otherwise(F.col("high_d")).alias("high_d"), F.when(met, F.col("found")).otherwise(F.col("centroid")).alias("centroid"), (F.col("step") * 2).alias("step")))
        split = search.select(*name, F.col("low_d").alias("d"), "centroid")
        met = large.join(split, name).join(at_depth("d", "on"), ["conv_id", "d"], "left")
        met = cut(met.withColumn("through", (F.col("high") >= F.col("d")) & F.coalesce(F.col("on") == F.col("centroid"), F.lit(False))))
        below = met.where("through")
        total = nodes.join(below.select(*name, "centroid", "d", "conv_id", "low", "high"), "conv_id").where("depth BETWEEN greatest(low, d) AND high").groupBy(*name, "centroid", "d").agg(F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
        total = cut(total)
        # the path from the centroid to the top: beginnings of the centroid's own conversation
        added.append(cut(total.join(paths.select(F.col("conv_id").alias("centroid"), "depth", "node"), "centroid").where("depth BETWEEN top_depth AND d").select(F.col("node").alias("conv_id"), "depth", "n_leaves", "saved_tokens")))
        above = met.where("not through OR low < d").select(*name, "conv_id", "low", F.when(F.col("through"), F.col("d") - 1).otherwise(F.col("high")).alias("high"))
        child = below.where("high > d").withColumn("e", F.col("d") + 1).join(at_depth("e", "child"), ["conv_id", "e"])
        children = child.select(F.col("child").alias("top"), F.col("e").alias("top_depth"), "conv_id", F.greatest("low", "e").alias("low"), "high")
        runs = cut(above.unionByName(children))


def tree(conversations: DataFrame, lead: Column, of: Column, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", small: int = SMALL) -> DataFrame:
    """A row for each node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``lead`` and ``of`` say with which turns of which conversation one begins (see rebuilt()). Null roles and texts are
    empty, repeated rows are turns of their own, rows without a conversation's id belong to none, an empty table has no
    nodes. saved_tokens sums, over the subtree, (n_convs - 1) times the code points of a node's last text. ends_sha256 is
    of the ids of conversations that end at the node. Other columns don't matter.
    """
    convs, turns = rebuilt(conversations, lead, of, conv_id, turn, role, text)
    top, n_convs = convs.agg(F.min("conv_id"), F.count("*")).first()
    if top is None:
        return conversations.sparkSession.createDataFrame([], "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string")
    long = lambda x: F.lit(x).cast("long")
    nodes, paths = _named(turns)
    paths = paths.unionByName(convs.select("conv_id", long(0).alias("depth"), long(top).alias("node")))
    above = paths.select("conv_id", (F.col("depth") + 1).alias("depth"), F.col("node").alias("parent_conv_id"))
    root = conversations.sparkSession.createDataFrame([(top, 0, n_convs, 0, None)], "conv_id long, depth long, n_convs long, chars long, parent_conv_id long")
    all_ = root.unionByName(nodes.join(above, ["conv_id", "depth"]))
    children = all_.where("depth > 0").groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children"))
    all_ = cut(all_.join(children, ["conv_id", "depth"], "left").fillna(0, ["n_children"]))
    weighed = all_.select("conv_id", "depth", "parent_conv_id", (F.col("n_children") == 0).cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"))
    # a conversation's nodes are one run of depths: once it is the least that starts so, it is for all longer beginnings
    runs = cut(all_.groupBy("conv_id").agg(F.min("depth").alias("low"), F.max("depth").alias("high")).select(long(top).alias("top"), long(0).alias("top_depth"), "conv_id", "low", "high"))
    runs, added = _cut_large(runs, paths, weighed, small)
    placed = weighed.join(runs, "conv_id").where("depth BETWEEN low AND high").select("top", "top_depth", "conv_id", "depth", "parent_conv_id", "leaf", "saved")
    sums = placed.repartition("top", "top_depth").sortWithinPartitions("top", "top_depth", "depth").mapInArrow(_small, "conv_id long, depth long, n_leaves long, saved_tokens long")
    for more in added:
        sums = sums.unionByName(more)
    sums = sums.groupBy("conv_id", "depth").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    out = all_.join(sums, ["conv_id", "depth"]).join(_ends(paths, convs), ["conv_id", "depth"], "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))
