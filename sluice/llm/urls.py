"""URL filters: rules on hosts and paths, and for the rest the ratio of two character language models.

Each model is a Markov chain of variable order over the characters of a URL: the share of a character after the
longest known context is mixed with that of the next shorter one, down to equal shares. One is learnt from accepted
URLs and one from rejected ones; a URL is allowed if the mean difference of log-likelihoods for each character is at
or above a threshold that is calibrated on labelled URLs left out of the fit. All other labelled URLs are learnt from, and
every context counts, however rare. The models are tables: no task and no driver has one whole.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import cut

#: Verdict, host, start of the path. The longest that fits wins.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))
ORDER = 4
#: Weight of the shorter context, in occurrences.
MIX = 2.0
#: Rows, and bytes of URLs, that are scored together; distinct grams that a task counts before it hands them on.
LOT, LOT_BYTES, HELD = 16_384, 4 << 20, 400_000
START = "\x02"
#: Bins of the calibration, over mean differences of log10 from -SPAN to SPAN.
BINS, SPAN = 2000, 2.0


def after_scheme(url: Column) -> Column:
    """What follows the first ://; empty for null or no ://."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty for null or no ://."""
    return _lower(F.regexp_extract(after_scheme(url), "^[^/?#]*", 0))


def path(url: Column) -> Column:
    """What follows the host up to ?, # or the end; empty for null or no ://."""
    return F.regexp_extract(after_scheme(url), "^[^/?#]*([^?#]*)", 1)


def _lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def ruled(host_: Column, path_: Column, rules: tuple = RULES) -> Column:
    """The longest rule that fits as a struct (rule, verdict); null if none does."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, name, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host_ == name) | host_.endswith(f".{name}")) & path_.startswith(start)
        out = F.when(fits, F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def grams(url: str, order: int = ORDER) -> list[str]:
    """Each character after its context; the first characters follow start marks."""
    marked = START * order + url
    return [marked[at - order : at + 1] for at in range(order, len(marked))]


def mean_step(url: str | None, step: Callable[[str], float], order: int = ORDER) -> float:
    """Mean over the characters of a URL; 0 for none."""
    return sum(map(step, grams(url, order))) / len(url) if url else 0.0


def fit(labelled: DataFrame, order: int = ORDER) -> DataFrame:
    """gram, allow, block: how often all distinct URLs of the rows (verdict, url) have each longest gram, by verdict.

    Counts of shorter grams are sums of these, since every character has a gram of each length.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {"allow": Counter(), "block": Counter()}
        for batch in batches:
            for verdict, url in zip(batch.column("verdict").to_pylist(), batch.column("url").to_pylist(), strict=True):
                held[verdict].update(grams(url, order))
            if sum(map(len, held.values())) > HELD:
                yield from out(held)
        yield from out(held)

    def out(held: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
        found = list(held["allow"].keys() | held["block"].keys())
        columns = [pa.array(found, pa.string()), *[pa.array([held[v][g] for g in found], pa.int64()) for v in ("allow", "block")]]
        yield pa.RecordBatch.from_arrays(columns, ["gram", "allow", "block"])
        for counts in held.values():
            counts.clear()

    distinct = labelled.where("url is not null and verdict in ('allow', 'block')").groupBy("verdict", "url").count()
    return distinct.select("verdict", "url").mapInArrow(run, "gram string, allow long, block long").groupBy("gram").agg(F.sum("allow").alias("allow"), F.sum("block").alias("block"))


def steps(model: DataFrame, asked: DataFrame, order: int = ORDER) -> DataFrame:
    """gram, step (log10 of the shares' ratio) of the grams of the model and of ``asked``: level by level, from single
    characters to the longest contexts, each a join of grams with their contexts and with the level before."""
    none = F.lit(0).cast("long")
    counts = cut(model.unionByName(asked.select("gram", none.alias("allow"), none.alias("block"))).groupBy("gram").agg(F.sum("allow").alias("allow"), F.sum("block").alias("block")))

    def level(k: int) -> DataFrame:
        return counts.groupBy(F.expr(f"right(gram, {k})").alias("gram")).agg(F.sum("allow").alias("allow"), F.sum("block").alias("block"))

    def share(verdict: str, shorter: Column, total: Column) -> Column:
        return ((F.col(verdict) + MIX * shorter) / (total + MIX)).alias(f"{verdict}_share")

    allow, block, letters = level(1).agg(F.coalesce(F.sum("allow"), none), F.coalesce(F.sum("block"), none), F.count_if(F.col("allow") + F.col("block") > 0) + 1).first()
    shares = level(1).select("gram", *[share(v, 1 / F.lit(float(letters)), F.lit(n)) for v, n in (("allow", allow), ("block", block))])
    for k in range(2, order + 2):
        own = level(k).withColumns({"context": F.expr(f"left(gram, {k - 1})"), "shorter": F.expr(f"right(gram, {k - 1})")})
        totals = own.groupBy("context").agg(F.sum("allow").alias("allow_total"), F.sum("block").alias("block_total"))
        below = shares.select(F.col("gram").alias("shorter"), F.col("allow_share").alias("allow_below"), F.col("block_share").alias("block_below"))
        shares = own.join(totals, "context").join(below, "shorter").select("gram", *[share(v, F.col(f"{v}_below"), F.col(f"{v}_total")) for v in ("allow", "block")])
    return shares.select("gram", F.log10(F.col("allow_share") / F.col("block_share")).alias("step"))


class Markov:
    """One class's model in memory: shares of characters after contexts."""

    def __init__(self, grams: dict[str, int], alphabet: int):
        self.grams, self.alphabet, self.contexts = grams, alphabet, Counter()
        for gram, n in grams.items():
            self.contexts[gram[:-1]] += n
        self.share = lru_cache(200_000)(self._share)

    def _share(self, gram: str) -> float:
        shorter = 1 / self.alphabet if len(gram) == 1 else self.share(gram[1:])
        total = self.contexts.get(gram[:-1], 0)
        return (self.grams.get(gram, 0) + MIX * shorter) / (total + MIX)


class Ratio:
    """Both classes' models from the counts {verdict: {gram: n}} of all lengths, where they fit in memory; steps() has the same of tables."""

    def __init__(self, counts: dict[str, dict[str, int]], order: int = ORDER):
        self.order = order
        alphabet = len({g for grams in counts.values() for g in grams if len(g) == 1}) + 1
        self.allow, self.block = (Markov(counts.get(verdict, {}), alphabet) for verdict in ("allow", "block"))
        self.step = lru_cache(200_000)(lambda gram: math.log10(self.allow.share(gram) / self.block.share(gram)))

    def score(self, url: str | None) -> float:
        """Mean difference of log10-likelihoods for each character; 0 for no characters."""
        return mean_step(url, self.step, self.order)


def in_lots(df: DataFrame, rows: int = LOT, size: int = LOT_BYTES) -> DataFrame:
    """df with a number ``lot``: rows that follow each other in a task, at most ``rows`` and, but for one long URL, ``size`` bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lot, held, held_bytes = TaskContext.get().partitionId() << 32, 0, 0
        for batch in batches:
            lots = []
            for n in pc.fill_null(pc.binary_length(batch.column("url")), 0).to_pylist():
                if held and (held >= rows or held_bytes + n > size):
                    lot, held, held_bytes = lot + 1, 0, 0
                lots.append(lot)
                held, held_bytes = held + 1, held_bytes + n
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lots, pa.int64())], [*batch.schema.names, "lot"])

    return cut(df.mapInArrow(run, df.withColumn("lot", F.lit(0).cast("long")).schema))


def score(df: DataFrame, model: DataFrame, id_col: str = "page_id", url_col: str = "url", *more: str, order: int = ORDER) -> DataFrame:
    """page_id, url, ``more`` and score of every row; the rows stay, repeated ones as well.

    Rows are dealt to lots, and the steps are joined to the distinct grams of each lot, so a task has those of one lot and
    never the model.
    """
    own = in_lots(df.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), *more))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lot, found = None, set()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([lot] * len(found), pa.int64()), pa.array(list(found), pa.string())], ["lot", "gram"])

        for batch in batches:
            for at, url in zip(batch.column("lot").to_pylist(), batch.column("url").to_pylist(), strict=True):
                if at != lot:
                    yield out()
                    lot, found = at, set()
                found.update(grams(url or "", order))
        yield out()

    def run(rows: pa.Table, known: pa.Table) -> pa.Table:
        step = dict(zip(known.column("gram").to_pylist(), known.column("step").to_pylist(), strict=True)).__getitem__
        found = [mean_step(x, step, order) for x in rows.column("url").to_pylist()]
        return rows.drop_columns(["lot"]).append_column("score", pa.array(found, pa.float64()))

    # A lot lies in one partition, so each of its grams is one row.
    asked = cut(own.select("lot", "url").mapInArrow(ask, "lot long, gram string"))
    known = asked.join(steps(model, asked.select("gram").distinct(), order), "gram")
    schema = own.drop("lot").withColumn("score", F.lit(0.0)).schema
    return own.groupBy("lot").cogroup(known.select("lot", "gram", "step").groupBy("lot")).applyInArrow(run, schema)


def calibrate(scored: DataFrame) -> float:
    """The threshold with the least sum of both classes' error shares over scored rows (verdict, score).

    Scores are counted in bins of equal width, so the driver gets a fixed number of sums; scores beyond the span count
    in the last bins, where no threshold is. 0 if a class has no rows.
    """
    at = F.least(F.greatest(F.floor((F.col("score") + SPAN) / (2 * SPAN) * BINS), F.lit(0)), F.lit(BINS - 1)).cast("int")
    counts = {"allow": np.zeros(BINS), "block": np.zeros(BINS)}
    for verdict, i, n in scored.groupBy("verdict", at.alias("at")).count().collect():
        counts[verdict][i] = n
    if not all(c.sum() for c in counts.values()):
        return 0.0
    lost = np.r_[0, np.cumsum(counts["allow"])] / counts["allow"].sum()
    passed = 1 - np.r_[0, np.cumsum(counts["block"])] / counts["block"].sum()
    errors = (lost + passed)[1:-1]
    best = np.flatnonzero(errors <= errors.min() + 1e-12)
    return float(-SPAN + 2 * SPAN * (best[len(best) // 2] + 1) / BINS)


def judge(df: DataFrame, rules: tuple = RULES, id_col: str = "page_id", url_col: str = "url", held: int = 5) -> DataFrame:
    """page_id, host, path, rule, verdict, score of every row.

    The URLs that a rule fits are the labels: those with crc32(url) mod ``held`` equal to 0 calibrate the threshold,
    all others are learnt from. Null and empty URLs have empty parts, no rule, score 0 and so the verdict of 0. Rows
    with no rule get the models' verdict; without labels of both classes scores are judged at 0.
    """
    url = F.col(url_col).cast("string")
    parts = df.select(F.col(id_col).cast("long").alias("page_id"), url.alias("url"), host(url).alias("host"), path(url).alias("path"))
    parts = parts.withColumn("by_rule", ruled(F.col("host"), F.col("path"), rules))
    parts = parts.withColumn("calibrates", F.crc32(F.col("url").cast("binary")) % held == 0)
    model = fit(parts.where("by_rule is not null and not calibrates").select("url", F.col("by_rule.verdict").alias("verdict")))
    scored = cut(score(parts, model, "page_id", "url", "host", "path", "by_rule", "calibrates"))
    threshold = calibrate(scored.where("by_rule is not null and calibrates").select(F.col("by_rule.verdict").alias("verdict"), "score"))
    verdict = F.coalesce("by_rule.verdict", F.when(F.col("score") >= threshold, "allow").otherwise("block"))
    return scored.select("page_id", "host", "path", F.col("by_rule.rule").alias("rule"), verdict.alias("verdict"), "score")
