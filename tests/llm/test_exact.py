"""Streaming exact dedup: against brute force, over epochs, with a digest that collides, and on odd rows."""

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sluice.llm import exact, queries
from tests import oracle


def run(spark, folder, at, **how):
    exact.dedup(exact.documents_stream(spark, str(folder), maxFilesPerTrigger=1), f"{at}/log", f"{at}/progress", available_now=True, **how).awaitTermination()
    return exact.classes(spark, f"{at}/log")


def expected(rows):
    """Per row: id, greatest id of its text, number of rows; and how many rows stay."""
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    keep = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    return Counter((i, keep[t or ""], len(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows), len(groups)


def got(df):
    rows = df.collect()
    return Counter((r.doc_id, r.keep_id, r.group_size, r.digest) for r in rows), sum(r.kept for r in rows)


def test_query_agrees_with_sql(spark, sf_dir):
    oracle.compare(queries.op11_stream_dedup(spark, sf_dir), oracle.connect(sf_dir), queries.oracle_sql()["op11_stream_dedup"])


ROWS = [(1, "a"), (2, "b"), (3, "a"), (None, "a"), (4, None), (5, ""), (6, "x" * 300_000), (7, "x" * 300_000 + "y"), (2, "b"), (None, "n"), (None, "n")]
LATER = [(9, "a"), (0, "b"), (10, "c"), (11, "x" * 300_000)]


def written(spark, folder, rows, mode="append"):
    schema = "doc_id long, text string, digest string, row long, file int, epoch string, _seen int"
    spark.createDataFrame([(i, t, "d", 1, 2, "e", 3) for i, t in rows], schema).coalesce(1).write.mode(mode).parquet(f"{folder}/documents.parquet")


def test_state_outlives_a_run(spark, tmp_path):
    """Copies of a later run meet what an earlier one saw; a run without new files changes nothing."""
    written(spark, tmp_path, ROWS)
    assert got(run(spark, tmp_path, tmp_path / "s")) == expected(ROWS)
    written(spark, tmp_path, LATER)
    for _ in range(2):
        assert got(run(spark, tmp_path, tmp_path / "s")) == expected(ROWS + LATER)
    state = spark.read.format("statestore").load(f"{tmp_path}/s/progress")
    assert state.where("not startswith(key.digest, 'file:')").count() == len({t or "" for _, t in ROWS + LATER})  # one entry for each text, none expired


def test_bytes_are_checked_on_hits(spark, tmp_path):
    """Under a digest that all texts share, texts are kept apart by their bytes alone, within and over epochs."""
    for rows in (ROWS, LATER):
        written(spark, tmp_path, rows)
    found = run(spark, tmp_path, tmp_path / "s", digest=lambda t: F.lit("same"))
    want, stay = expected(ROWS + LATER)
    assert Counter((r.doc_id, r.keep_id, r.group_size) for r in found.collect()) == Counter({k[:3]: 0 for k in want}) + sum((Counter({k[:3]: v}) for k, v in want.items()), Counter())
    assert found.where("kept").count() == stay


def test_many_places_are_joined(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(exact, "MOST_PLACES", 1)
    for rows in (ROWS, LATER):
        written(spark, tmp_path, rows)
    assert got(run(spark, tmp_path, tmp_path / "s")) == expected(ROWS + LATER)


def test_normalised_texts(spark, tmp_path):
    rows = [(1, "A b"), (2, "a B"), (3, "a c")]
    written(spark, tmp_path, rows)
    found = run(spark, tmp_path, tmp_path / "s", normal=lambda t: F.lower(exact.same_text(t)))
    assert {(r.doc_id, r.keep_id, r.kept) for r in found.collect()} == {(1, 2, False), (2, 2, True), (3, 3, True)}


def test_empty_table(spark, tmp_path):
    written(spark, tmp_path, [])
    found = run(spark, tmp_path, tmp_path / "s")
    assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "digest"] and found.count() == 0


@pytest.mark.parametrize("n", [0, 1])
def test_a_repeated_epoch_leaves_one_copy(spark, tmp_path, n):
    """An epoch whose commit was lost is tried again and overwrites its rows."""
    for rows in (ROWS, LATER):
        written(spark, tmp_path, rows)
    run(spark, tmp_path, tmp_path / "s")
    commits = sorted((tmp_path / "s/progress/commits").glob("[0-9]*"), key=lambda p: int(p.name))
    if n:
        commits[-1].unlink()
        (commits[-1].parent / f".{commits[-1].name}.crc").unlink(missing_ok=True)
    assert got(run(spark, tmp_path, tmp_path / "s")) == expected(ROWS + LATER)
