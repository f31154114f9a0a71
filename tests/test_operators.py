"""Cases of single operators: ties, nulls, cursors that must lose nothing, and plans that must stay distributed."""

import random
import weakref
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from sluice.functions import fields, geo, lines
from sluice.operators import bundles, chunk, cycles, dedup, joins, predicates, state
from sluice.sources import queue, spool
from sluice.streaming import delivery

T0 = datetime(2026, 5, 7, 0, 42)


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns or df.columns) for r in df.collect())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_best_of_keeps_groups_under_a_limit(spark):
    """Group A {1, 10 best}, group B {2}: a limit of one may not lose A, whatever is shipped first."""
    df = spark.createDataFrame([(1, "a", 0.0), (2, "b", 1.0), (10, "a", 5.0)], "id long, g string, v double")
    got, cursor = [], 0
    for _ in range(3):
        one = dedup.best_of(df, ["g"], "v", cursor, 1).collect()
        got += [r.id for r in one]
        cursor = max([cursor, *(r.first_id for r in one)])
    assert got == [10, 2]
    assert [r.id for r in dedup.best_of(df, ["g"], "v", 0, 1, compat=True).collect()] == [2]


def test_best_of_ties_and_nulls(spark):
    df = spark.createDataFrame([(3, "a", 1.0), (2, "a", 1.0), (5, "b", None), (4, "b", None), (7, "c", None), (8, "c", -9.0)], "id long, g string, v double")
    assert rows(dedup.best_of(df, ["g"], "v"), "g", "id") == [("a", 2), ("b", 4), ("c", 8)]
    assert rows(dedup.best_of(df, ["g"], "v"), "g", "id") == rows(dedup.best_of_window(df, ["g"], "v"), "g", "id")
    assert "partial_max_by" in plan(dedup.best_of(df, ["g"], "v"))


def test_best_of_random(spark):
    rng = random.Random(5)
    data = [(i, rng.randrange(9), rng.choice([None, 0.0, 1.0, 2.0]), rng.randrange(3)) for i in range(1, 200)]
    df = spark.createDataFrame(data, "id long, g int, v double, station int")
    cursor = 4
    expected = []
    for key in {(g, s) for _, g, _, s in data}:
        own = [r for r in data if (r[1], r[3]) == key]
        if min(r[0] for r in own) > cursor:
            expected.append(max(own, key=lambda r: (r[2] is not None, r[2] or 0, -r[0]))[0])
    assert [r[0] for r in rows(dedup.best_of(df, ["g"], "v", cursor, keys=("station",)), "id")] == sorted(expected)


def test_best_spot_passes_incomplete_rows(spark):
    data = [(1, T0, "K1A", 14.09705, -5.0), (2, T0 + timedelta(seconds=30), "K1A", 14.09704, -3.0), (3, T0, "K1A", 14.0972, -9.0), (4, T0, "", 14.0, 1.0), (5, T0, "K2B", None, 1.0), (6, T0, "K1A", 14.09702, -3.0)]
    df = spark.createDataFrame(data, "pos long, time timestamp, call string, mhz double, snr double")
    assert [r[0] for r in rows(dedup.best_spot(df), "pos")] == [2, 3, 4, 5]


def test_report_lines(spark):
    data = [(T0, 77.0, -1.0, 0.2, 10.140101, "KC1KOP", "FN41", 23, 0, 3, "F2"), (T0, 0.125, -12.5, 0.2, 14.0971, "K1ABC", "FN42aa", 30, -1, 2, "W2"), (T0, 1.0, 0.0, 0.0, 7.0, "<...>", "", 1, 0, 2, "")]
    df = spark.createDataFrame(data, "time timestamp, sync double, snr double, dt double, mhz double, call string, grid string, power long, drift long, kind long, mode string")
    got = {r.call: r.line for r in bundles.render_lines(df).collect()}
    assert got == {
        "KC1KOP": "260507 0042  77.0  -1  0.20   10.1401010 KC1KOP         FN41   23  0    3",
        "K1ABC": "260507 0042  0.12 -12  0.20   14.0971000 K1ABC          FN42aa 30 -1    2",
    }


def test_extended_line_has_its_fields(spark):
    data = [(T0, 14.0971, "K1ABC", "FN42", 30, 0, 2, 0.5, -12.0, 0.2, "AC0G/B1", "EM38ww", 1, 2, 3, 0.5, 4, 5, 6, 20)]
    df = spark.createDataFrame(data, "time timestamp, mhz double, call string, grid string, power long, drift long, kind long, sync double, snr double, dt double, site_call string, site_grid string, cycles int, jitter int, blocksize int, metric double, decodetype int, ipass int, nhardmin int, band int")
    at = df.withColumns({"tx_lat": geo.grid_lat(F.col("grid")), "tx_lon": geo.grid_lon(F.col("grid")), "rx_lat": geo.grid_lat(F.col("site_grid")), "rx_lon": geo.grid_lon(F.col("site_grid"))})
    ends = [F.col(c) for c in ("tx_lat", "tx_lon", "rx_lat", "rx_lon")]
    at = at.withColumn("a", geo.angle(*ends)).withColumns(geo.path_geometry(*ends, F.col("a")))
    line = bundles.extended_lines(at).first().line.split()
    assert len(line) == 34 and line[:2] == ["260507", "0042"] and line[13] == "500"
    assert line[20:23] == ["20", "EM38ww", "AC0G/B1"] and 1500 < int(line[23]) < 2000


def test_noise_line(spark):
    got = spark.range(1).select(lines.noise_line(F.lit(-150.126), F.lit(None), F.lit(3)).alias("x")).first().x
    assert got == " ".join([" 0.00"] * 12 + ["-150.13", " 0.00", "3"])


def test_geometry(spark):
    df = spark.createDataFrame([("FN42", "JN58"), ("none", "JN58"), (None, "JN58"), ("FN42aa", "FN42aa"), ("zz99", "JN58")], "tx string, rx string")
    at = [geo.grid_lat(F.col("tx")), geo.grid_lon(F.col("tx")), geo.grid_lat(F.col("rx")), geo.grid_lon(F.col("rx"))]
    got = df.select(*(c.alias(n) for n, c in geo.path_geometry(*at, geo.angle(*at)).items())).collect()
    assert 5900 < got[0].km < 6300 and 0 <= got[0].rx_az < 360
    assert got[1].km is None and got[2].km is None and got[4].km is None and got[3].km == 0
    assert [r[0] for r in spark.createDataFrame([(28.074,), (50.313,), (144.174,), (0.05,)], "f double").select(geo.band_of(F.col("f"))).collect()] == [10, 6, 2, 9999]
    assert spark.range(1).select(geo.band_of(F.lit(28.074), compat=True)).first()[0] == 9999


def test_payload_predicates(spark):
    df = spark.createDataFrame([(1, '{"m": "ft8", "n": 3}'), (2, '{"m": "ft4"}'), (3, '{"n": "x"}'), (4, "{oops"), (5, None)], "id long, payload_json string")
    good, bad = predicates.quarantine(df)
    assert rows(bad, "id") == [(4,), (5,)]
    where = lambda *c: [r[0] for r in rows(predicates.payload_where(good, list(c)), "id")]
    assert where(("m", "!=", "ft8")) == [2] and where(("n", ">=", 3)) == [1] and where(("m", "NOT IN", ["ft4"])) == [1] and where(("m", "IN", ["ft4", "ft8"])) == [1, 2]
    for wrong in (("m", "LIKE", "x"), ("m", "IN", []), ("a b", "=", 1)):
        with pytest.raises(ValueError):
            predicates.payload_where(good, [wrong])
    assert predicates.ceiling(df, "id", None).count() == 0


def test_record_times(spark):
    df = spark.createDataFrame([('{"time": "2026-05-12T12:00:00Z"}', "x"), ('{"decode_time": "2026-05-12T12:00:00+00:00"}', "x"), ('{"utc": "2026-05-12T14:00:00+02:00"}', "x"), ("{}", "2026-05-12T12:00:00"), ("{}", "never")], "p string, q string")
    got = df.select(F.unix_timestamp(fields.record_time(fields.parsed(F.col("p")), F.col("q"), F.timestamp_seconds(F.lit(7)))).alias("t")).collect()
    assert [r.t for r in got] == [1778587200] * 4 + [7]


def _cycles(spark, seen):
    data = [(T0 + timedelta(minutes=2 * c), r) for c, rs in enumerate(seen) for r in rs]
    return spark.createDataFrame(data, "cycle timestamp, reporter string")


def test_ceiling_is_the_complete_prefix(spark):
    expected = ["B4", "B5 "]
    at = lambda minutes, seconds=0: F.lit(T0 + timedelta(minutes=minutes, seconds=seconds))
    top = lambda seen, now: [r.ceiling for r in cycles.shippable_ceiling(cycles.cycle_complete(_cycles(spark, seen), expected), now).collect()]
    full, part = ["B4", "B5"], ["B4", "XX"]
    assert top([full, full, part], at(6)) == [T0 + timedelta(minutes=2)]
    assert top([full, part, full], at(5)) == [T0]
    assert top([part, full, full], at(3, 29)) == [] and top([part, full], at(3, 31)) == [T0]
    assert top([full], at(1)) == []  # the running cycle never ships
    assert rows(cycles.cycle_complete(_cycles(spark, [part]), []), "complete") == [(True,)]


def test_missing_by_list_and_table(spark):
    seen = _cycles(spark, [["B4"], ["B4", "B5"]])
    table = spark.createDataFrame([("B4",), ("B5",)], "reporter string")
    assert rows(joins.missing_reporters(seen, ["B4", "B5"])) == rows(joins.missing_reporters(seen, table)) == [(T0, "B5")]


def test_chunks(spark):
    df = spark.range(1, 1001).withColumn("size", F.lit(90)).withColumn("s", F.col("id") % 3)
    got = rows(chunk.chunk_by_count(df, 64, ("id",)), "id", "batch_id")
    assert got == [(i, (i - 1) // 64) for i in range(1, 1001)]
    assert "SinglePartition" not in plan(chunk.chunk_by_count(df, 64, ("id",))).split("BroadcastExchange")[0]
    packed = chunk.chunk_by_bytes(df, 600, 100, "size", ("id",), ("s",)).groupBy("s", "packet").agg(F.count("*").alias("n"), F.sum("size").alias("b")).collect()
    assert sum(r.n for r in packed) == 1000 and max(r.b for r in packed) <= 500
    one = spark.createDataFrame([(1, 9, 0), (2, 900, 0), (3, 9, 0)], "id long, size int, s int")
    assert rows(chunk.chunk_by_bytes(one, 600, 100, "size", ("id",), ("s",)), "id", "packet") == [(1, 0), (2, 1), (3, 2)]
    with pytest.raises(ValueError):
        chunk.chunk_by_bytes(one, 100, 100, "size", ("id",), ("s",))


def test_delivery_until_dead(spark):
    """A failed batch waits, keeps its cursor over retries, and is dead at the third replay."""
    policy = state.RetryPolicy(max_attempts=3)
    kinds = "deliverable_id long, pipeline string, kind string, reason string, accepted_cursor long, records long, rejected long, n_bytes long, cursor_after long, ts timestamp"
    said = lambda kind: spark.createDataFrame([(1, "p", kind, "down", None, 5, 0, 10, 42, T0)], kinds)
    folded = state.apply_outcomes(said("retry_later"), policy)
    waiting = folded["deliverables"]
    assert folded["cursors"].count() == 0 and rows(waiting, "id", "attempts", "cursor_after") == [(1, 0, 42)]
    for n in (1, 2):
        waiting = state.apply_replays(said("retry_later"), waiting, policy)["deliverables"]
        assert rows(waiting, "attempts", "cursor_after", "next_attempt_at") == [(n, 42, T0 + timedelta(seconds=2**n))]
    assert rows(state.apply_replays(said("acked"), waiting, policy)["cursors"], "cursor") == [(42,)]
    last = state.apply_replays(said("retry_later"), waiting, policy)
    assert last["deliverables"].count() == 0 and rows(last["dead_letters"], "final_error") == [("down",)]
    assert rows(state.apply_outcomes(said("permanent"), policy)["cursors"], "cursor") == [(42,)]
    assert state.apply_outcomes(said("permanent"), state.RetryPolicy(skip_permanent=False))["cursors"].count() == 0


def test_cursor_folds_are_idempotent(spark):
    acks = spark.createDataFrame([("p", 5, T0, 1), ("p", 9, T0, 2), ("q", 1, T0, 3)], "pipeline string, cursor long, ts timestamp, seq long")
    assert rows(state.current_cursors(acks.unionByName(acks), ["pipeline"]), "pipeline", "cursor") == [("p", 9), ("q", 1)]


def test_owed_pushes_its_cursor_down(spark, tmp_path):
    df = spark.range(100).select("id", F.lit("d").alias("target_db"), F.lit("t").alias("target_table"), F.lit(1).alias("schema_version"), F.lit("{}").alias("payload_json"), F.lit("").alias("queued_at"))
    df.write.parquet(str(tmp_path / "q"))
    owed = queue.owed(queue.route(queue.read_queue(spark, str(tmp_path / "q")), "d", "t"), 40, 5)
    assert [r.id for r in owed.collect()] == [41, 42, 43, 44, 45]
    assert "GreaterThan(id,40)" in plan(owed) and "EqualTo(target_table,t)" in plan(owed) and "TakeOrderedAndProject" in plan(owed)


def test_spool(spark, tmp_path):
    root = tmp_path / "spool"
    for i, name in enumerate(["HF1/14M/210508_1200_wd_spots.txt", "HF1/14M/noise/20210508_120000_noise.txt", "HF1/7M/210508_1200_wd_spots.txt", "HF1/7M/readme.md"]):
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(f"a {i}\nb {i}\n" if i != 2 else "bad")
        import os

        os.utime(path, (1_700_000_000 + 10 - i, 1_700_000_000 + 10 - i))
    specs = [spool.FileSpec("**/noise/*.txt", "noise"), spool.FileSpec("**/*.txt", "spots")]
    files = spool.file_spool(spark, str(root), specs, content=True)
    assert [(r.rel, r.table) for r in files.collect()] == [("HF1/7M/210508_1200_wd_spots.txt", "spots"), ("HF1/14M/noise/20210508_120000_noise.txt", "noise"), ("HF1/14M/210508_1200_wd_spots.txt", "spots")]

    def lines_of(path, content):
        if content == b"bad":
            raise ValueError("bad file")
        return [{"line": x, "time": "2021-05-08T12:00:00Z" if x.startswith("a") else None} for x in content.decode().splitlines()]

    records, rejects = spool.parse_spool(files, {"spots": lines_of, "noise": lines_of})
    assert records.count() == 4 and rejects.count() == 1 and "bad file" in rejects.first().error
    assert spool.spool_files_of(records).count() == 2
    named = {r.rel: r.arcname for r in spool.layout_files(files, F.lit("S")).collect()}
    assert named["HF1/14M/noise/20210508_120000_noise.txt"] == "spool/noise/S/HF1/14M/210508_1200_noise.txt"
    last = spool.spool_keep_cursor(files.orderBy("mtime").limit(2)).first()
    assert [r.rel for r in spool.file_spool(spark, str(root), specs, after=(last.mtime, last.path)).collect()] == ["HF1/14M/210508_1200_wd_spots.txt"]


def test_acked_files_go_and_empty_folders_with_them(spark, tmp_path):
    for name in ("a/x/1.txt", "a/x/2.txt", "a/3.txt", "b/y/4.txt"):
        (tmp_path / "s" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "s" / name).write_text("1")
    root = str(tmp_path / "s")
    files = spool.file_spool(spark, root, [spool.FileSpec("**")])
    assert spool.delete_acked(files.where("rel in ('a/x/1.txt', 'b/y/4.txt')"), root) == 2
    assert (tmp_path / "s/a/x/2.txt").exists() and (tmp_path / "s/a/x").exists() and not (tmp_path / "s/b").exists()
    assert spool.delete_acked(spark.createDataFrame([(f"{root}/a/x/2.txt",), (f"{root}/gone.txt",), (f"{root}/a/3.txt",)], "path string"), root) == 2
    assert (tmp_path / "s").exists() and not (tmp_path / "s/a").exists()
    assert rows(spool.spool_health(spark, root), "status", "n_files") == [("empty", 0)]
    assert rows(spool.spool_health(spark, f"{root}/none"), "status", "n_files") == [("unreachable", 0)]


def test_data_sets_grow(spark):
    files = spark.createDataFrame([("OBS1/a/1", 5, T0), ("OBS1/2", 6, T0 + timedelta(1)), ("x/OBS2/b", 1, T0), ("plain", 9, T0)], "rel string, length long, mtime timestamp")
    assert rows(spool.datasets(files), "dataset", "n_files", "n_bytes") == [("OBS1", 2, 11), ("OBS2", 1, 1)]
    last = spool.datasets_keep_cursor(spool.datasets(files.where("rel <> 'OBS1/2'"))).first()
    assert (last.mtime, last.dataset) == (T0, "OBS2") and rows(spool.datasets(files, after=(last.mtime, last.dataset)), "dataset") == [("OBS1",)]
    assert rows(spool.dataset_manifest(files, part=1), "dataset", "part") == [("OBS1", 0), ("OBS1", 1), ("OBS2", 0)]


def test_anchor_stays_over_restarts(spark, tmp_path):
    df = spark.range(1, 11)
    assert rows(queue.stored_anchor(df, str(tmp_path / "a"))) == [(10,)]
    assert rows(queue.stored_anchor(spark.range(1, 21), str(tmp_path / "a"))) == [(10,)]


def test_partial_ack_loses_no_row(spark):
    """Of 5 rows 3 are accepted: the next slice begins at the fourth; without an accepted cursor none is passed over."""
    df = spark.range(1, 6).select("id", F.lit(0).alias("batch_id"))
    for accepted, after in ((3, [(3,)]), (None, [])):
        sent = delivery.deliver(df, lambda batch, rows, a=accepted: delivery.Sent("partial_ack", accepted_cursor=a, rejected=2), pipeline=F.lit("p"), now=T0)
        assert rows(sent, "pipeline", "kind", "records", "rejected", "cursor_after", "ts") == [("p", "partial_ack", 5, 2, 5, T0)]
        folded = state.apply_outcomes(sent)
        assert rows(folded["cursors"], "cursor") == after and rows(folded["attempts"], "records") == [(3,)]
    assert rows(state.apply_outcomes(sent, compat=True)["cursors"], "cursor") == [(5,)]


def test_replay_sends_what_was_frozen(spark, tmp_path):
    frozen = spool.freeze_payload(spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (2, 3, "c")], "deliverable_id long, id long, line string"), str(tmp_path / "f"))
    due = spark.createDataFrame([(1, "p"), (3, "p")], "id long, pipeline string")

    def send(deliverable, rows):
        assert "".join(rows["line"]) == "ab" and deliverable == 1
        return "acked"

    assert rows(delivery.replay(due, frozen, send, now=T0), "deliverable_id", "kind", "records") == [(1, "acked", 2), (3, "permanent", 0)]


def test_numbers_within_keys(spark):
    df = spark.range(2000).select("id", F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 5 > 0, F.lit(None)).otherwise(F.col("id").cast("string")).alias("k"))
    seen = {}
    for i, k, n in sorted(rows(chunk.numbered(df.repartition(7), ("id",), "n", ("k",)), "id", "k", "n")):
        assert n == seen.get(k, 0)
        seen[k] = n + 1
    assert sum(seen.values()) == 2000


def test_locators_of_other_lengths(spark):
    df = spark.createDataFrame([("FN42aa",), ("FN42",), ("FN42aa11",), ("FN42z",), ("FN42zz",), ("F",), ("",), (None,), ("ZZ99",)], "g string")
    got = [r[0] for r in df.select(geo.grid_lat(F.col("g"))).collect()]
    assert got[1] == got[2] == got[3] == got[4] == 42.5 and round(got[0], 4) == 42.0208 and got[5:] == [None] * 4


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "c1", "x"), (2, "c2", "y"), (3, "c1", "z")], "deliverable_id long, cycle string, line string")
    spool.write_bundles(df, str(tmp_path / "out"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "out")).where("cycle = 'c1'").collect()) == ["x", "z"]
    frozen = spool.freeze_payload(df, str(tmp_path / "frozen"))
    assert rows(frozen, "deliverable_id", "line") == rows(df, "deliverable_id", "line")


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "id long, g string, v double, ts timestamp, reporter string")
    assert dedup.best_of(empty, ["g"], "v").count() == 0
    assert cycles.shippable_ceiling(cycles.cycle_complete(empty.withColumn("cycle", F.col("ts")), ["a"]), F.lit(T0)).count() == 0
    assert chunk.chunk_by_count(empty, 5, ("id",)).count() == 0
    assert rows(queue.start_anchor(empty)) == [(0,)]
    assert joins.orphans(empty.withColumn("target_table", F.col("g")), spark.createDataFrame([], "target_table string"), spark.createDataFrame([], "target_table string, cursor long")).count() == 0


def test_rows_of_outcomes(spark):
    df = spark.createDataFrame([Row(batch_id=1, server="a", pos=0, ok=False), Row(batch_id=1, server="b", pos=1, ok=True), Row(batch_id=2, server="a", pos=0, ok=False)])
    assert rows(state.first_success(df), "batch_id", "server", "delivered", "n_tried") == [(1, "b", True, 2), (2, None, False, 1)]


def test_cursors_stop_at_the_first_gap(spark):
    """Batch 0 is partly taken, without a cursor or with one, and batch 1 acknowledged: no row of batch 0 is passed."""
    for accepted, want in ((None, [("q", 9)]), (4, [("p", 4), ("q", 9)]), (10, [("p", 20), ("q", 9)])):
        log = spark.createDataFrame([(0, "p", "partial_ack", "", accepted, 10, 3, None, 10, T0), (1, "p", "acked", "", None, 10, 0, None, 20, T0), (0, "q", "acked", "", None, 9, 0, None, 9, T0)], delivery.OUTCOME)
        assert rows(state.settled_cursors(log), "pipeline", "cursor") == want
    # the next slice began at the cursor, so its acknowledgement counts again
    both = log.withColumn("slice", F.lit(0)).unionByName(log.where("deliverable_id = 1").withColumn("slice", F.lit(1)))
    gap = both.withColumn("accepted_cursor", F.lit(4))
    assert rows(state.settled_cursors(gap, run=("slice",)), "pipeline", "cursor") == [("p", 20), ("q", 9)]
    dead = spark.createDataFrame([(0, None, "permanent", "", None, 1, 0, None, 5, T0), (1, None, "acked", "", None, 1, 0, None, 6, T0)], delivery.OUTCOME)
    assert rows(state.settled_cursors(dead), "cursor") == [(6,)] and rows(state.settled_cursors(dead, state.RetryPolicy(skip_permanent=False)), "cursor") == []


def test_replays_keep_pipelines_apart(spark):
    """Two pipelines wait with the same id: what one of them did says nothing of the other."""
    waiting = spark.createDataFrame([(0, p, T0, 0, T0, c) for p, c in (("a", 7), ("b", 8), (None, 9))], state_schema())
    tried = spark.createDataFrame([(0, "a", "acked", "", None, 1, 0, None, None, T0), (0, None, "permanent", "x", None, 1, 0, None, None, T0)], delivery.OUTCOME)
    for folded in (state.apply_replays(tried, waiting), state.fold_replays(waiting, tried.withColumn("run", F.lit(1)))):
        assert rows(folded["cursors"], "pipeline", "cursor") == [("a", 7)]
        assert rows(folded["deliverables"], "pipeline", "attempts") == [("b", 0)]
        assert rows(folded["dead_letters"], "pipeline", "final_error") == [(None, "x")]


def state_schema():
    from sluice.types import DELIVERABLE

    return DELIVERABLE


def test_a_log_of_replays_folds_like_its_runs(spark):
    """Runs folded one after the other and the whole log at once give the same state."""
    policy, waiting = state.RetryPolicy(max_attempts=3), spark.createDataFrame([(i, "p", T0, 0, T0, i) for i in range(6)], state_schema())
    said = [["retry_later"] * 6, [None, "acked", "permanent", "retry_later", "retry_later", "partial_ack"], [None, None, None, "retry_later", "acked", None]]
    now, ended = waiting, {"cursors": [], "dead_letters": []}
    log = None
    for n, kinds in enumerate(said):
        one = spark.createDataFrame([(i, "p", k, "", None, 1, 0, None, None, T0 + timedelta(minutes=n)) for i, k in enumerate(kinds) if k], delivery.OUTCOME)
        log = one.withColumn("run", F.lit(n)) if log is None else log.unionByName(one.withColumn("run", F.lit(n)))
        folded = state.apply_replays(one, now, policy)
        now = folded["deliverables"]
        for part in ended:
            ended[part] += [tuple(map(str, r)) for r in folded[part].collect()]
    whole = state.fold_replays(waiting, log, policy)
    names = ("id", "attempts", "next_attempt_at", "cursor_after")
    assert rows(whole["deliverables"], *names) == rows(now, *names)
    for part in ended:
        assert sorted(tuple(map(str, r)) for r in whole[part].collect()) == sorted(ended[part])


def test_payloads_of_epochs_stay(spark, tmp_path):
    """A later epoch deletes nothing of an earlier one; the same epoch again leaves one copy; folders are bounded."""
    path, keys = str(tmp_path / "f"), ("pipeline", "deliverable_id")
    make = lambda ids, text: spark.createDataFrame([(p, i, i * 10, text) for p in "ab" for i in ids], "pipeline string, deliverable_id long, id long, line string")
    spool.freeze_payload(make(range(200), "x"), path, keys, 0)
    spool.freeze_payload(make([500], "lost"), path, keys, 1)
    frozen = spool.freeze_payload(make([501], "y"), path, keys, 1)
    assert frozen.count() == 402 and rows(frozen.where("deliverable_id >= 500"), "pipeline", "deliverable_id", "line") == [("a", 501, "y"), ("b", 501, "y")]
    assert len(list((tmp_path / "f").glob("epoch=*/bucket=*"))) <= 2 * spool.BUCKETS
    due = spark.createDataFrame([(501, "a"), (3, "b"), (3, "c")], "id long, pipeline string")
    places = spool.frozen_payloads(spark, path, frozen.schema, places=True)
    seen = delivery.replay(due, places, lambda i, r: "acked", now=T0)
    assert rows(seen, "deliverable_id", "pipeline", "kind", "records") == [(3, "b", "acked", 1), (3, "c", "permanent", 0), (501, "a", "acked", 1)]


def test_columns_that_operators_use_inside_stay(spark):
    """_part, _count, _offset, _n and _pipeline of a user come through numbering and delivery."""
    df = spark.createDataFrame([(i, "p", i, i, i, i) for i in range(7)], "id long, _pipeline string, _part long, _count long, _offset long, _n long")
    cut = chunk.chunk_by_count(df, 3, ("id",))
    assert rows(cut, "batch_id", "_part", "_count", "_offset", "_n") == [(i // 3, i, i, i, i) for i in range(7)]

    def send(i, rows):
        assert list(rows["_pipeline"]) == ["p"] * len(rows) and list(rows["_n"]) == list(rows["id"])
        return "acked"

    assert rows(delivery.deliver(cut, send, now=T0), "deliverable_id", "kind", "reason", "records") == [(0, "acked", "", 3), (1, "acked", "", 3), (2, "acked", "", 1)]


def test_digital_rows_of_one_time_and_frequency_by_number(spark):
    data = [(10, "K1A"), (9, "K1A"), (100, "K0B")]
    df = spark.createDataFrame([(T0, "FT8", "s", "rx", 20, 14074000, *r) for r in data], "ts timestamp, mode string, rx_site string, receiver string, band int, frequency long, id long, call string")
    content = bundles.bundle_digital(df, ["id", "call", "frequency"], "ts", order=("call", "id")).first().content
    assert [line.split('"id":')[1] for line in content.splitlines()] == ["100}", "9}", "10}"]


def test_parsed_files_are_handed_on_in_parts(spark):
    """A file's records are never all Python objects at once, and none is handed on of a file that fails at its end."""

    def many(path, content):
        alive = set()
        for i in range(30_000):
            record = Held({"n": i})
            alive.add(id(record))
            weakref.finalize(record, alive.discard, id(record))
            if len(alive) > 20_000:
                raise MemoryError("too many at once")
            yield record
            del record
        if content == b"bad":
            raise ValueError("bad end")

    class Held(dict):
        pass

    files = spark.createDataFrame([("a", "t", T0, bytearray(b"good")), ("b", "t", T0, bytearray(b"bad"))], "path string, table string, mtime timestamp, content binary").coalesce(1)
    records, rejects = spool.parse_spool(files, {"t": many})
    assert records.groupBy("path", "time").count().collect() == [Row(path="a", time=T0, count=30_000)]
    assert rows(rejects) == [("b", "t", "ValueError: bad end")]
