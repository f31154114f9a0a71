"""Leases on deliverables, so that of several runners one sends each: a log of claims, and who holds what by it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.operators.state import due, same

#: What a claim is of; at and until are its times, and a release ends its owner's lease at ``at``.
KEYS = ("pipeline", "id")
CLAIM = "pipeline string, id long, owner string, kind string, at timestamp, until timestamp"


def claim(wanted: DataFrame, owner: str, now: Column, seconds: float, keys: Sequence[str] = KEYS) -> DataFrame:
    """Claims on all of ``wanted`` for so many seconds, to be appended to the log; holders() then says which held."""
    return wanted.select(*keys, F.lit(owner).alias("owner"), F.lit("claim").alias("kind"), now.alias("at"), (now + F.make_dt_interval(secs=F.lit(seconds).cast("decimal(18,6)"))).alias("until"))


def release(held: DataFrame, owner: str, now: Column, keys: Sequence[str] = KEYS) -> DataFrame:
    """Ends an owner's leases before their time."""
    return held.select(*keys, F.lit(owner).alias("owner"), F.lit("release").alias("kind"), now.alias("at"), now.alias("until"))


def holders(claims: DataFrame, now: Column, keys: Sequence[str] = KEYS) -> DataFrame:
    """keys, owner and until of what is leased at ``now``, the same whoever asks.

    Claims count in order of time, then of owner. One takes hold if nobody has a lease at its time, or its owner has,
    which prolongs it; the others are as if they had never been made. A lease is free again from ``until`` on. Null
    keys are keys like any other; claims with a null owner or time count for nothing. The claims of one deliverable are
    read as a list: as many as it was tried by runners, which drop_ended() keeps short.
    """
    log = claims.where("owner IS NOT NULL AND at IS NOT NULL AND until IS NOT NULL").where(F.col("at") <= now)
    ordered = F.sort_array(F.collect_list(F.struct("at", "owner", "kind", "until")))
    free = F.struct(F.lit(None).cast("string").alias("owner"), F.lit(None).cast("timestamp").alias("until"))

    def settle(held: Column, c: Column) -> Column:
        own, open_ = c["owner"] == held["owner"], held["until"].isNull() | (held["until"] <= c["at"])
        taken = F.struct(c["owner"].alias("owner"), F.when(own & ~open_, F.greatest(held["until"], c["until"])).otherwise(c["until"]).alias("until"))
        ends = (c["kind"] == "release") & F.coalesce(own, F.lit(False))
        return F.when(ends, F.struct(held["owner"].alias("owner"), F.least(held["until"], c["at"]).alias("until"))).when((c["kind"] == "claim") & (open_ | own), taken).otherwise(held)

    last = log.groupBy(*keys).agg(F.aggregate(ordered, free, settle).alias("held"))
    return last.select(*keys, "held.owner", "held.until").where(F.col("until") > now)


def claimable(deliverables: DataFrame, claims: DataFrame, now: Column, keys: Sequence[str] = KEYS) -> DataFrame:
    """Deliverables that are due and that nobody holds."""
    held = holders(claims, now, keys)
    return due(deliverables, now).alias("l").join(held.alias("r"), same(keys), "left_anti")


def claimed(deliverables: DataFrame, claims: DataFrame, owner: str, now: Column, keys: Sequence[str] = KEYS) -> DataFrame:
    """Deliverables that an owner holds: what it may send now. No two owners have one in common."""
    held = holders(claims, now, keys).where(F.col("owner") == owner)
    return deliverables.alias("l").join(held.alias("r"), same(keys), "left_semi")


def drop_ended(claims: DataFrame, now: Column, keys: Sequence[str] = KEYS) -> DataFrame:
    """Claims of deliverables that somebody holds; of the others nothing in the log matters any more."""
    return claims.alias("l").join(holders(claims, now, keys).alias("r"), same(keys), "left_semi")
