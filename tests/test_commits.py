"""The log of commits: attempts that fail, overtake each other or come twice; days by index; compaction."""

from __future__ import annotations

import os
import time
from datetime import date, datetime, timedelta
from pathlib import Path
from threading import Thread

import pytest
from pyspark.sql import functions as F
from tests.conftest import rows
from tests.test_gold import at, buckets, small

from citypulse.plans import incremental as inc
from citypulse.session import folder_of
from citypulse.sources import commits
from citypulse.sources.tables import run_after, watermark_of, write_by_city, write_run
from citypulse.streaming import silver

LINE = '{"meta_city":"%s","meta_scraped_at":"%s","line":"S1","delay":%d}'


def values(spark, *lines):
    return spark.createDataFrame([(line,) for line in lines], "value STRING")


@pytest.fixture
def write(fresh):
    return silver.BatchWriter(silver.TRANSIT, fresh("silver"), fresh("quarantine"))


def delays(spark, write, **span):
    return sorted(r.delay for r in silver.read_silver(spark, write.path, silver.TRANSIT, **span).collect())


# --- create once ---------------------------------------------------------------
def test_a_name_is_created_once(spark, fresh):
    path = fresh()
    assert commits.put(spark, path, "batch-a-0", attempt="x", days=["2024-01-01"])
    assert not commits.put(spark, path, "batch-a-0", attempt="y", days=["2024-01-02"])
    assert [(r.name, r.attempt, r.days) for r in commits.entries(spark, path).collect()] == [("batch-a-0", "x", ["2024-01-01"])]
    assert [p.name for p in Path(f"{path}-log").iterdir() if not p.name.startswith(".")] == ["batch-a-0.json"]


def test_of_many_at_once_one_creates_the_name(spark, fresh):
    path, won = fresh(), []
    threads = [Thread(target=lambda i=i: commits.put(spark, path, "first", attempt=f"a{i}") and won.append(f"a{i}")) for i in range(12)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(won) == 1 and commits.entries(spark, path).first().attempt == won[0]


def test_the_rename_of_other_stores_refuses_to_overwrite(spark, fresh):
    root = Path(fresh())
    root.mkdir()
    for name in ("a", "b"):
        (root / name).write_text(name)
    to = folder_of(spark, f"{root}/final")[0]
    commits._rename(spark, folder_of(spark, f"{root}/a")[0], to)
    with pytest.raises(FileExistsError):
        commits._rename(spark, folder_of(spark, f"{root}/b")[0], to)
    assert (root / "final").read_text() == "a" and (root / "b").exists()


def test_no_log_yet(spark, fresh):
    path = fresh()
    assert commits.entries(spark, path) is None and commits.live(spark, path) is None
    assert commits.clear(spark, path, "batch") == [] and watermark_of(spark, path) is None


# --- micro-batches ---------------------------------------------------------------
def test_a_reader_during_a_replay_sees_each_row_once(spark, write):
    batch = values(spark, LINE % ("A", "2024-01-01T00:00:00", 1), LINE % ("B", "2024-01-02T00:00:00", 2), "{")
    write(batch, 0)
    before = silver.read_silver(spark, write.path, silver.TRANSIT)
    folders = sorted(os.listdir(write.path))
    write(batch, 0)
    assert sorted(os.listdir(write.path)) == folders and before.count() == 2
    assert delays(spark, write) == [1, 2] and write.quarantined == {"no_city": 1}
    assert silver.read_quarantine(spark, write.path, write.quarantine).count() == 1


def test_a_crash_between_data_and_commit_leaves_nothing_that_counts(spark, write, monkeypatch):
    batch = values(spark, LINE % ("A", "2024-01-01T00:00:00", 1), "{")

    def fail(*_, **__):
        raise OSError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(commits, "put", fail)
        with pytest.raises(OSError):
            write(batch, 0)
    assert len(os.listdir(write.path)) == 1 and delays(spark, write) == [] and not write.quarantined
    write(batch, 0)
    write(values(spark, LINE % ("A", "2024-01-01T00:00:00", 2)), 1)
    assert len(os.listdir(write.path)) == 3 and delays(spark, write) == [1, 2]
    assert len(os.listdir(write.quarantine)) == 2 and silver.read_quarantine(spark, write.path, write.quarantine).count() == 1


def test_an_attempt_that_is_overtaken_does_not_count(spark, write, monkeypatch):
    """The same batch runs twice at once: the second to commit finds the name taken."""
    batch = values(spark, LINE % ("A", "2024-01-01T00:00:00", 1), "{")
    real, nested = commits.put, []

    def overtaken(*args, **entry):
        if not nested:
            nested.append(True)
            write(batch, 0)
        return real(*args, **entry)

    monkeypatch.setattr(commits, "put", overtaken)
    write(batch, 0)
    assert len(os.listdir(write.path)) == 2 and delays(spark, write) == [1] and write.quarantined == {"no_city": 1}


def test_a_value_at_the_clocks_limit_is_in_one_place(spark, fresh, monkeypatch):
    """The time runs on between the two writes of a batch; its clock does not."""
    write = silver.BatchWriter(silver.TRANSIT, fresh("silver"), fresh("quarantine"), tolerance="0 seconds")
    ahead = datetime.now() + timedelta(hours=0)
    times = [(ahead + timedelta(seconds=s)).isoformat(timespec="seconds") for s in range(-2, 8)]
    batch = values(spark, *(LINE % ("A", t, i) for i, t in enumerate(times)))
    real = write_by_city

    def slow(*args, **options):
        time.sleep(3)
        real(*args, **options)
        time.sleep(3)

    monkeypatch.setattr(silver, "write_by_city", slow)
    write(batch, 0)
    bad = [int(v.split('"delay":')[1].rstrip("}")) for (v, _) in silver.read_quarantine(spark, write.path, write.quarantine).collect()]
    kept = delays(spark, write)
    assert sorted(kept + bad) == list(range(10)) and kept and bad
    entry = commits.entries(spark, write.path).first()
    limit = datetime.fromisoformat(entry.clock).replace(tzinfo=None)
    assert kept == [i for i, t in enumerate(times) if datetime.fromisoformat(t) <= limit]
    assert {r.ingestion_time.timestamp() for r in silver.read_silver(spark, write.path, silver.TRANSIT).collect()} == {
        datetime.fromisoformat(entry.clock).timestamp()
    }


def test_commits_hold_the_bounds_of_their_batch(spark, write):
    write(values(spark, LINE % ("A", "2024-01-02T03:00:00", 1), LINE % ("A", "2024-01-01T23:59:59.5", 1)), 0)
    write(values(spark, "{"), 1)
    write(values(spark, *["x"]).limit(0), 2)
    found = {r.name[-1]: (r.oldest, r.newest, r.days) for r in commits.entries(spark, write.path).collect()}
    assert found["0"] == ("2024-01-01T23:59:59.500000", "2024-01-02T03:00:00.000000", ["2024-01-01", "2024-01-02"])
    assert found["1"] == found["2"] == (None, None, [])


def test_a_batch_without_one_usable_value_is_quarantined_as_a_whole(spark, write):
    for n, bad in enumerate((["{"], [LINE % ("A", "x", 1)], [LINE % ("A", "2999-01-01T00:00:00", 1), "[]", "{"], [])):
        write(spark.createDataFrame([(b,) for b in bad], "value STRING").repartition(2), n)
        write(values(spark, *bad, "").limit(len(bad)), 10 + n)
    reasons = silver.read_quarantine(spark, write.path, write.quarantine).groupBy("reason").count()
    assert rows(reasons) == [("ahead", 2), ("malformed", 6), ("no_time", 2)] and delays(spark, write) == []
    assert write.quarantined == {"no_city": 6, "no_time": 2, "ahead": 2}


# --- bounds without data files --------------------------------------------------------
EDGES = ("2024-01-01T00:00:00", "2024-01-01T00:29:59", "2024-01-01T00:30:00", "2024-01-01T03:10:00")


@pytest.mark.parametrize("floor", [None, "2023-12-31T23:30:00", "2024-01-01T00:00:00", "2024-01-01T03:00:00", "2024-01-02T00:00:00"])
def test_bounds_from_commits_are_those_of_the_rows(spark, write, floor):
    floor = floor and at(floor)
    for n, when in enumerate(EDGES):
        write(values(spark, LINE % ("A", when, n), "{"), n)
        table = silver.read_silver(spark, write.path, silver.TRANSIT)
        for options in ({}, {"flush": True}, {"hold_back": "1 hour"}):
            scanned = inc.run_bounds([inc.rows_after(table, floor)], floor, **options)
            known = inc.committed_bounds(spark, [write.path, write.path + "-none"], floor, **options)
            if scanned != known:  # a gap after the floor: nothing to write all the same
                assert scanned.ceiling is None and inc.rows_before(inc.rows_after(table, floor), known.ceiling).isEmpty()
    assert inc.committed_bounds(spark, [], floor) == inc.Bounds(floor, None)


def test_bounds_and_totals_read_commits_only(spark, write):
    write(values(spark, LINE % ("A", EDGES[0], 1), LINE % ("A", EDGES[3], 1), LINE % ("B", "x", 1), "{"), 0)
    write(values(spark, "{"), 1)
    silver.compact(spark, write.path, silver.TRANSIT)
    totals = inc.committed_totals(spark, {"transit": write.path, "weather": write.path + "-none"})
    assert rows(totals) == [("transit", 2, 1, at(EDGES[3]), at("2024-01-01T03:00:00"))]
    for df in (totals, commits.span_of(spark, [write.path])):
        assert df.inputFiles() and all(f.endswith(".json") for f in df.inputFiles())


def test_a_run_over_a_gap_writes_nothing_and_says_so(spark, fresh):
    path, flat = fresh("gold"), small(spark, EDGES[0], EDGES[3])
    inc.append_increment(spark, *flat, gold_path=path)
    floor = watermark_of(spark, path)
    known = inc.Bounds(floor, at("2024-01-01T03:00:00"))
    assert inc.append_increment(spark, *flat, gold_path=path, bounds=known) == inc.Bounds(floor, None)
    assert watermark_of(spark, path) == floor == at(EDGES[0])


# --- values that come back from quarantine ------------------------------------------------
def test_values_taken_from_quarantine_are_in_one_place(spark, write):
    write(values(spark, LINE % ("A", EDGES[0], 1), LINE % ("A", "2999-01-01T00:00:00", 2), "{"), 0)
    write(values(spark, LINE % ("B", "soon", 3)), 1)
    assert write.retry(spark) == 3 and delays(spark, write) == [1]
    reasons = silver.read_quarantine(spark, write.path, write.quarantine).select("reason")
    assert rows(reasons) == [("ahead",), ("malformed",), ("no_time",)]
    mended = lambda df: df.selectExpr(f"replace(replace(value, 'soon', '{EDGES[3]}'), '2999', '2023') AS value")
    assert write.retry(spark, mended) == 3 and delays(spark, write) == [1, 2, 3]
    assert rows(silver.read_quarantine(spark, write.path, write.quarantine)) == [("{", "malformed")]
    assert write.retry(spark, lambda df: df.filter("reason != 'malformed'")) == 1
    assert write.retry(spark) == 0 and delays(spark, write) == [1, 2, 3]
    assert silver.read_quarantine(spark, write.path, write.quarantine).isEmpty()


def test_a_retry_that_fails_or_is_overtaken_changes_nothing(spark, write, monkeypatch):
    write(values(spark, LINE % ("A", "x", 1)), 0)
    mended = lambda df: df.selectExpr(f"replace(value, '\"x\"', '\"{EDGES[0]}\"') AS value")
    real, done = commits.put, []

    def lost(*_, **__):
        raise OSError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(commits, "put", lost)
        with pytest.raises(OSError):
            write.retry(spark, mended)
    assert delays(spark, write) == [] and silver.read_quarantine(spark, write.path, write.quarantine).count() == 1

    def raced(*args, **entry):
        if not done:
            done.append(True)
            write.retry(spark, mended)
        return real(*args, **entry)

    monkeypatch.setattr(commits, "put", raced)
    with pytest.raises(commits.Conflict):
        write.retry(spark, mended)
    assert delays(spark, write) == [1] and silver.read_quarantine(spark, write.path, write.quarantine).isEmpty()


# --- days by index -----------------------------------------------------------------
def test_one_day_of_a_year_lists_the_folders_of_that_day(spark, write, monkeypatch):
    year = [date(2024, 1, 1) + timedelta(days=i) for i in range(366)]
    rows_of = values(spark, *(LINE % (c, f"{day}T12:00:00", i) for i, day in enumerate(year) for c in "AB"))
    write(rows_of, 0)
    write(values(spark, LINE % ("A", "2024-03-01T00:00:00", 1000)), 1)
    listed = []
    real = commits.folders
    monkeypatch.setattr(commits, "folders", lambda *a: listed.append(real(*a)) or listed[-1])
    got = silver.read_silver(spark, write.path, silver.TRANSIT, date(2024, 3, 1), date(2024, 3, 1))
    assert sorted(r.delay for r in got.collect()) == [60, 60, 1000] and [len(x) for x in listed] == [2]
    assert len(got.inputFiles()) == 3 and set(got.select("scraped_date").distinct().collect()[0]) == {date(2024, 3, 1)}
    assert delays(spark, write, first=date(2024, 12, 30)) == [364, 364, 365, 365]
    assert delays(spark, write, last=date(2023, 12, 31)) == []


# --- runs of the wide table ----------------------------------------------------------
TIMES = ("2024-01-01T00:05:00", "2024-01-02T00:35:00", "2024-01-02T05:05:00")


def test_rows_of_a_failed_run_never_count_whatever_it_covered(spark, fresh):
    """A first attempt that flushes two days fails; a marked one covers less."""
    path = fresh("gold")
    _, rows_of = inc.closed_buckets(*small(spark, *TIMES), flush=True)
    write_run(rows_of, path, commits.attempt_of(run_after(None)))
    assert inc.read_gold(spark, path) is None
    inc.append_increment(spark, *small(spark, *TIMES[:2]), gold_path=path)
    assert buckets(inc.read_gold(spark, path)) == ["2024-01-01 00:00:00"]
    inc.append_increment(spark, *small(spark, *TIMES), gold_path=path)
    inc.append_increment(spark, *small(spark, *TIMES), gold_path=path, flush=True)
    assert buckets(inc.read_gold(spark, path)) == ["2024-01-01 00:00:00", "2024-01-02 00:30:00", "2024-01-02 05:00:00"]


def test_of_two_runs_at_once_one_is_committed(spark, fresh, monkeypatch):
    path = fresh("gold")
    inc.append_increment(spark, *small(spark, TIMES[0], "2024-01-01T00:35:00"), gold_path=path)
    real, nested = inc.write_run, []

    def raced(*args):
        if not nested:
            nested.append(True)
            inc.append_increment(spark, *small(spark, *TIMES), gold_path=path, flush=True)
        return real(*args)

    monkeypatch.setattr(inc, "write_run", raced)
    with pytest.raises(commits.Conflict):
        inc.append_increment(spark, *small(spark, *TIMES), gold_path=path)
    want = ["2024-01-01 00:00:00", "2024-01-02 00:30:00", "2024-01-02 05:00:00"]
    assert buckets(inc.read_gold(spark, path)) == want and watermark_of(spark, path) == at("2024-01-02T05:00:00")


# --- compaction -----------------------------------------------------------------------
def files(df) -> int:
    return len(df.inputFiles())


def test_compaction_bounds_files_a_day_and_changes_no_reader(spark, write):
    for n in range(5):
        write(values(spark, *(LINE % (c, f"2024-01-0{d}T0{n}:00:00", n) for c in "AB" for d in (1, 2))), n)
    table = silver.read_silver(spark, write.path, silver.TRANSIT)
    before = rows(table)
    assert files(table) == 20
    assert silver.compact(spark, write.path, silver.TRANSIT, last=date(2024, 1, 1)) == 1
    after = silver.read_silver(spark, write.path, silver.TRANSIT)
    assert rows(after) == before == rows(table) and files(after) == 12
    assert files(silver.read_silver(spark, write.path, silver.TRANSIT, last=date(2024, 1, 1))) == 2
    write(values(spark, LINE % ("A", "2024-01-01T09:00:00", 9)), 5)
    assert silver.compact(spark, write.path, silver.TRANSIT) == 2 and silver.compact(spark, write.path, silver.TRANSIT) == 0
    assert files(silver.read_silver(spark, write.path, silver.TRANSIT)) == 4 and delays(spark, write).count(9) == 1
    assert len(delays(spark, write)) == 21


def test_rows_that_come_during_a_compaction_stay(spark, write, monkeypatch):
    for n in range(2):
        write(values(spark, LINE % ("A", "2024-01-01T00:00:00", n)), n)
    real, done = commits.put, []

    def late(spark_, path, name, **entry):
        if name.startswith("swap") and not done:
            done.append(True)
            write(values(spark, LINE % ("A", "2024-01-01T00:00:00", 2)), 2)
        return real(spark_, path, name, **entry)

    monkeypatch.setattr(commits, "put", late)
    silver.compact(spark, write.path, silver.TRANSIT)
    assert delays(spark, write) == [0, 1, 2]


def test_of_two_compactions_at_once_one_is_committed(spark, write, monkeypatch):
    for n in range(2):
        write(values(spark, LINE % ("A", "2024-01-01T00:00:00", n)), n)
    real, done = commits.put, []

    def raced(spark_, path, name, **entry):
        if not done:
            done.append(True)
            silver.compact(spark, write.path, silver.TRANSIT)
        return real(spark_, path, name, **entry)

    monkeypatch.setattr(commits, "put", raced)
    with pytest.raises(commits.Conflict):
        silver.compact(spark, write.path, silver.TRANSIT)
    assert delays(spark, write) == [0, 1]


def test_what_does_not_count_is_cleared_away_when_it_is_old(spark, write):
    for n in range(2):
        write(values(spark, LINE % ("A", "2024-01-01T00:00:00", n)), n)
    write_by_city(silver.read_silver(spark, write.path, silver.TRANSIT), f"{write.path}/batch=dead-1", partition_by=silver.LAYOUT)
    silver.compact(spark, write.path, silver.TRANSIT)
    assert commits.clear(spark, write.path, "batch") == [] and len(os.listdir(write.path)) == 4
    assert len(commits.clear(spark, write.path, "batch", timedelta(seconds=-5))) == 3
    assert len(os.listdir(write.path)) == 1 and delays(spark, write) == [0, 1]


def test_the_wide_table_is_compacted_and_goes_on(spark, fresh):
    path = fresh("gold")
    for n in range(1, 5):
        inc.append_increment(spark, *small(spark, *(f"2024-01-01T0{i}:00:00" for i in range(n + 1))), gold_path=path)
    before = rows(inc.read_gold(spark, path))
    assert files(inc.read_gold(spark, path)) == 4 and len(before) == 4
    assert inc.compact_gold(spark, path) == 1
    assert files(inc.read_gold(spark, path)) == 1 and rows(inc.read_gold(spark, path)) == before
    assert watermark_of(spark, path) == at("2024-01-01T03:00:00")
    inc.append_increment(spark, *small(spark, *(f"2024-01-01T0{i}:00:00" for i in range(6))), gold_path=path)
    assert len(buckets(inc.read_gold(spark, path))) == 5
    hours = inc.read_gold(spark, path, first=date(2024, 1, 1), last=date(2024, 1, 1)).select(F.max("hour_of_day")).first()
    assert hours[0] == 4
