"""Delivery state as folds over logs: cursors, waiting deliverables, dead letters, attempts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.fields import backoff
from sluice.shared import cut
from sluice.sources.queue import first_n


#: The defaults of retries.
@dataclass(frozen=True)
class RetryPolicy:
    base: float = 2.0
    cap_sec: float = 300.0
    max_attempts: int = 12
    skip_permanent: bool = True


def current_cursors(acks: DataFrame, keys: Sequence[str] = ("source_id", "dest_id", "table_name"), ts: str = "ts", seq: str = "seq") -> DataFrame:
    """The latest acknowledged cursor of each key; reading an acknowledgement twice changes nothing."""
    return acks.groupBy(*keys).agg(F.max_by("cursor", F.struct(ts, seq)).alias("cursor"), F.max(ts).alias("last_ack"))


def _next(ts: Column, attempts: Column, policy: RetryPolicy) -> Column:
    return ts + F.make_dt_interval(secs=backoff(attempts, policy.base, policy.cap_sec).cast("decimal(18,6)"))


def _attempt(outcome: Column, records: Column) -> list[Column]:
    return [F.col("ts"), F.col("pipeline"), outcome.alias("outcome"), records.alias("records"), F.col("n_bytes"), F.nullif(F.col("reason"), F.lit("")).alias("error")]


#: What can become of a batch.
KINDS = ("acked", "partial_ack", "retry_later", "permanent")


def known_kind(kind: Column) -> Column:
    """The kind; reading a row of one that isn't known fails, so that nothing vanishes between the outputs of a fold."""
    return F.when(kind.isin(*KINDS), kind).otherwise(F.raise_error(F.concat(F.lit("unknown outcome kind: "), F.coalesce(kind, F.lit("null")))).cast("string"))


def same(keys: Sequence[str], left: str = "l", right: str = "r") -> Column:
    """Rows of two frames (by alias) with equal keys; null equals null."""
    return reduce(Column.__and__, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


def first_gaps(outcomes: DataFrame, policy: RetryPolicy = RetryPolicy(), keys: Sequence[str] = ("pipeline",), order: str = "deliverable_id") -> DataFrame:
    """keys and gap: of each key the first batch whose rows weren't all settled.

    Settled are batches that were taken, that wait as a deliverable with their rows, or that are dead and skipped. A
    partial_ack that names no cursor, or one before its batch's, leaves rows that only the queue still has.
    """
    kind, accepted = known_kind(F.col("kind")), F.col("accepted_cursor")
    left = (kind == "partial_ack") & (accepted.isNull() | (accepted < F.col("cursor_after")))
    gap = left if policy.skip_permanent else left | (kind == "permanent")
    return outcomes.where(gap).groupBy(*keys).agg(F.min(order).alias("gap"))


def apply_outcomes(outcomes: DataFrame, policy: RetryPolicy = RetryPolicy(), keys: Sequence[str] = ("pipeline",), compat: bool = False, run: Sequence[str] = (), order: str = "deliverable_id") -> dict[str, DataFrame]:
    """First attempts, folded: new cursors, deliverables, dead letters and attempts, each a filter over outcomes.

    acked advances to the batch's cursor, partial_ack to the accepted one, or nowhere if it names none; retry_later
    waits; permanent is dead, and with skip_permanent its cursor moves on, so that the same rows aren't offered at once
    again. Cursors stop at the first gap of their key in batch order (first_gaps()): what a later batch acknowledges
    moves none past rows that aren't settled, which the next slice offers again. ``run`` are columns that tell slices
    apart, each of which began at the cursor that the one before left. ``compat`` has the older rule, in which each
    batch stands alone and a partial_ack without a cursor takes its batch's. A kind that isn't known fails.
    """
    kind, at = known_kind(F.col("kind")), F.col("ts")
    advances = kind.isin("acked", "partial_ack", *(["permanent"] if policy.skip_permanent else []))
    accepted = F.coalesce("accepted_cursor", "cursor_after") if compat else F.col("accepted_cursor")
    to = F.when(kind == "partial_ack", accepted).otherwise(F.col("cursor_after"))
    records = F.when(kind == "partial_ack", F.col("records") - F.coalesce("rejected", F.lit(0))).otherwise(F.col("records"))
    moved = outcomes.where(advances & to.isNotNull())
    if not compat:
        within = [*keys, *run]
        met = moved.alias("l").join(first_gaps(outcomes, policy, within, order).alias("r"), same(within), "left")
        moved = met.where(F.col("r.gap").isNull() | (F.col(f"l.{order}") <= F.col("r.gap"))).select("l.*")
    return {
        "cursors": moved.select(*keys, to.alias("cursor"), "ts", F.col("deliverable_id").alias("seq")),
        "deliverables": outcomes.where(kind == "retry_later").select(F.col("deliverable_id").alias("id"), *keys, at.alias("enqueued_at"), F.lit(0).alias("attempts"), _next(at, F.lit(0), policy).alias("next_attempt_at"), "cursor_after"),
        "dead_letters": outcomes.where(kind == "permanent").select("ts", *keys, "deliverable_id", F.coalesce(F.nullif(F.col("reason"), F.lit("")), F.lit("permanent_failure")).alias("final_error")),
        "attempts": outcomes.select(*_attempt(kind, records)),
    }


def settled_cursors(outcomes: DataFrame, policy: RetryPolicy = RetryPolicy(), keys: Sequence[str] = ("pipeline",), run: Sequence[str] = ()) -> DataFrame:
    """keys and cursor: how far each key's rows are settled without a gap, from a log of first attempts."""
    return apply_outcomes(outcomes, policy, keys, run=run)["cursors"].groupBy(*keys).agg(F.max("cursor").alias("cursor"))


def apply_replays(outcomes: DataFrame, deliverables: DataFrame, policy: RetryPolicy = RetryPolicy(), once: bool = False) -> dict[str, DataFrame]:
    """Replays of waiting deliverables, folded; a deliverable that waits on keeps all its columns, its cursor too.

    A deliverable is known by its pipeline and id. A retry that reaches max_attempts is dead; partial_ack of a replay
    counts as acked; a kind that isn't known fails. Deliverables without an outcome wait as they are. Each of the four
    outputs joins for itself; with ``once`` the joined rows are kept in the shared folder and all four read them.
    """
    waiting = deliverables.select("id", "pipeline", "enqueued_at", "attempts", "next_attempt_at", "cursor_after")
    tried = outcomes.select(F.col("deliverable_id").alias("id"), "pipeline", known_kind(F.col("kind")).alias("kind"), "reason", "n_bytes", "ts")
    met = waiting.alias("l").join(tried.alias("r"), same(["id", "pipeline"]), "left").select("l.*", "r.kind", "r.reason", "r.n_bytes", "r.ts")
    attempts = F.col("attempts") + 1
    fate = F.when(F.col("kind").isNull(), "waits").when((F.col("kind") == "retry_later") & (attempts >= policy.max_attempts), "dead_letter").when(F.col("kind").isin("retry_later", "permanent"), F.col("kind")).otherwise("acked")
    met = met.withColumn("fate", fate)
    met = cut(met) if once else met
    return {
        "cursors": met.where("fate = 'acked'").select("pipeline", F.col("cursor_after").alias("cursor"), "ts", F.col("id").alias("seq")),
        "deliverables": met.where("fate = 'waits'").select(*waiting.columns).unionByName(met.where("fate = 'retry_later'").select("id", "pipeline", "enqueued_at", attempts.cast("int").alias("attempts"), _next(F.col("ts"), attempts, policy).alias("next_attempt_at"), "cursor_after")),
        "dead_letters": met.where("fate in ('permanent', 'dead_letter')").select("ts", "pipeline", F.col("id").alias("deliverable_id"), _final(F.col("fate")).alias("final_error")),
        "attempts": met.where("fate <> 'waits'").select(*_attempt(F.col("fate"), F.lit(None).cast("long"))),
    }


def _final(fate: Column) -> Column:
    return F.coalesce(F.nullif(F.col("reason"), F.lit("")), F.when(fate == "permanent", "permanent_failure").otherwise("max_attempts"))


def fold_replays(deliverables: DataFrame, replays: DataFrame, policy: RetryPolicy = RetryPolicy(), run: str = "run") -> dict[str, DataFrame]:
    """A whole log of replays (outcomes and the number of their run) folded at once, as apply_replays() run by run would.

    The last outcome decides, and how many there were is the number of attempts: one aggregate by pipeline and id.
    """
    tried = replays.withColumn("kind", known_kind(F.col("kind"))).groupBy(F.col("deliverable_id").alias("id"), "pipeline").agg(F.count("*").cast("int").alias("tries"), F.max_by(F.struct("kind", "reason", "n_bytes", "ts"), run).alias("last"))
    waiting = deliverables.select("id", "pipeline", "enqueued_at", "attempts", "next_attempt_at", "cursor_after")
    met = waiting.alias("l").join(tried.alias("r"), same(["id", "pipeline"]), "left").select("l.*", "r.tries", "r.last.*")
    attempts = (F.col("attempts") + F.coalesce("tries", F.lit(0))).cast("int")
    fate = F.when(F.col("kind").isNull(), "waits").when((F.col("kind") == "retry_later") & (attempts >= policy.max_attempts), "dead_letter").when(F.col("kind").isin("retry_later", "permanent"), F.col("kind")).otherwise("acked")
    met = met.withColumns({"attempts": attempts, "fate": fate})
    again = F.when(F.col("fate") == "waits", F.col("next_attempt_at")).otherwise(_next(F.col("ts"), F.col("attempts"), policy))
    return {
        "cursors": met.where("fate = 'acked'").select("pipeline", F.col("cursor_after").alias("cursor"), "ts", F.col("id").alias("seq")),
        "deliverables": met.where("fate IN ('waits', 'retry_later')").select("id", "pipeline", "enqueued_at", "attempts", again.alias("next_attempt_at"), "cursor_after"),
        "dead_letters": met.where("fate IN ('permanent', 'dead_letter')").select("ts", "pipeline", F.col("id").alias("deliverable_id"), _final(F.col("fate")).alias("final_error")),
    }


def due(deliverables: DataFrame, now: Column, one_each: bool = False) -> DataFrame:
    """Deliverables whose time has come, oldest first; one of each pipeline if asked."""
    ready = deliverables.where(F.col("next_attempt_at") <= now)
    return first_n(ready, ["next_attempt_at", "id"], 1, ("pipeline",)) if one_each else ready.orderBy("pipeline", "next_attempt_at", "id")


def requeue(deliverables: DataFrame, now: Column, policy: RetryPolicy = RetryPolicy()) -> DataFrame:
    """The same deliverables after another failure, every other column as it was."""
    attempts = (F.col("attempts") + 1).cast("int")
    return deliverables.withColumns({"next_attempt_at": _next(now, attempts, policy), "attempts": attempts})


def dead_letter_counts(dead: DataFrame, by: Sequence[str] = ("pipeline", "final_error")) -> DataFrame:
    return dead.groupBy(*by).agg(F.count("*").alias("n_dead"))


def trim_attempts(attempts: DataFrame, n: int = 10_000, keys: tuple[str, ...] = (), seq: str = "seq") -> DataFrame:
    """The newest n attempts of all or of each key."""
    return first_n(attempts, [F.col(seq).desc()], n, keys)


recent_attempts = trim_attempts


def delivery_status(pipelines: DataFrame, cursors: DataFrame, deliverables: DataFrame, dead: DataFrame, newest: DataFrame | None = None, key: str = "pipeline") -> DataFrame:
    """A row for each pipeline: cursor, waiting and dead counts, and how many ids the cursor is behind."""
    out = pipelines.select(key).distinct().join(cursors.select(key, "cursor"), key, "left")
    out = out.join(deliverables.groupBy(key).agg(F.count("*").alias("n_waiting")), key, "left").join(dead.groupBy(key).agg(F.count("*").alias("n_dead")), key, "left")
    out = out.fillna(0, ["n_waiting", "n_dead"])
    return out if newest is None else out.join(newest.select(key, "newest"), key, "left").withColumn("lag", F.col("newest") - F.coalesce("cursor", F.lit(0))).drop("newest")


def reset_cursor(cursors: DataFrame, which: DataFrame, keys: Sequence[str] = ("source_id", "dest_id", "table_name")) -> DataFrame:
    """Cursors without those of the given keys."""
    return cursors.join(which.select(*keys), list(keys), "left_anti")


def kick(deliverables: DataFrame) -> DataFrame:
    """All deliverables due at once."""
    return deliverables.withColumn("next_attempt_at", F.timestamp_seconds(F.lit(0)))


def split_partial(batch: DataFrame, accepted_cursor: int, rejected: DataFrame, id_col: str = "id") -> tuple[DataFrame, DataFrame]:
    """The accepted part of a batch (up to the cursor, without rejected ids) and its rejected rows."""
    bad = rejected.select(id_col).distinct()
    return batch.where(F.col(id_col) <= accepted_cursor).join(bad, id_col, "left_anti"), batch.join(bad, id_col, "left_semi")


def attempts_rollup(attempts: DataFrame, by: Sequence[str] = ("dest_id", "outcome"), ts: str = "ts") -> DataFrame:
    """Attempts and the latest time by each of ``by``, with totals where a column is null."""
    return attempts.rollup(*by).agg(F.count("*").alias("n_attempts"), F.max(ts).alias("latest"))


def first_success(attempts: DataFrame, keys: Sequence[str] = ("batch_id",), server: str = "server", pos: str = "pos", ok: str = "ok") -> DataFrame:
    """Of servers tried in order the first that took the batch, whether any did, and how many were tried up to then."""
    good = F.when(F.col(ok), F.col(pos))
    agg = attempts.groupBy(*keys).agg(F.min(F.when(F.col(ok), F.struct(pos, server)))[server].alias("server"), F.coalesce(F.bool_or(ok), F.lit(False)).alias("delivered"), F.coalesce(F.min(good) + 1, F.count("*")).alias("n_tried"))
    return agg
