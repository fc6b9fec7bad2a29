"""Sums that late rows still change, and roll-ups kept from them."""

from __future__ import annotations

import json
from datetime import date, datetime

import pytest
from tests.conftest import plan_of, rows
from tests.test_gold import buckets, small, traffic, transit, weather

from citypulse import jobs
from citypulse import schemas as S
from citypulse.plans import amend, analytics
from citypulse.plans.gold import gold_wide
from citypulse.sources import commits
from citypulse.streaming import silver

TIMES = ("2024-01-01T00:05:00", "2024-01-01T00:35:00", "2024-01-02T01:05:00", "2024-01-03T00:05:00")


def near(df) -> list[tuple]:
    return rows(df.selectExpr(*[f"rint({c} * 1e9) / 1e9 AS {c}" if t == "double" else c for c, t in df.dtypes]))


def wide(spark, *times):
    return near(gold_wide(*small(spark, *times)).select(*S.wide_columns()))


def amended(spark, path, **options):
    return near(amend.read_amended(spark, path, with_open=True, **options).select(*S.wide_columns()))


def test_rows_of_any_time_change_their_buckets(spark, fresh):
    path = fresh("sums")
    assert amend.read_amended(spark, path) is None
    amend.add_sums(spark, path, *small(spark, *TIMES[2:]))
    t, w, d = small(spark, *TIMES[:2])
    assert amend.add_sums(spark, path, t, w, d) == ["2024-01-01"]
    assert amended(spark, path) == wide(spark, *TIMES)
    late = transit(spark, ("A", TIMES[0], "S1", 3_000), ("Z", TIMES[0], "Bus 1", 0), ("Y", TIMES[0], None, 1))
    amend.add_sums(spark, path, t.limit(0), w.limit(0), late)
    assert amended(spark, path) == near(gold_wide(*small(spark, *TIMES)[:2], small(spark, *TIMES)[2].unionByName(late)).select(*S.wide_columns()))
    closed = amend.read_amended(spark, path)
    assert "2024-01-03 00:00:00" not in buckets(closed) and "2024-01-02 01:00:00" in buckets(closed)


def test_means_of_nulls_and_rows_of_no_slot(spark, fresh):
    path = fresh("sums")
    t = traffic(spark, ("A", TIMES[0], "grid_0_0", None, None), ("A", TIMES[0], "elsewhere", 0.5, 30), (None, TIMES[0], "grid_0_0", 0.5, 30))
    w, d = weather(spark, ("B", TIMES[1], "grid_1_1", None, 2.0)), transit(spark, ("C", TIMES[0], None, None), ("C", "x", "S1", 1))
    amend.add_sums(spark, path, t, w, d)
    assert amended(spark, path) == near(gold_wide(t, w, d).select(*S.wide_columns()))


def test_compaction_merges_sums_and_changes_no_value(spark, fresh):
    path = fresh("sums")
    for time in TIMES[:2] * 2:
        amend.add_sums(spark, path, *small(spark, time))
    before, size = amended(spark, path), amend.read_sums(spark, path).count()
    assert amend.compact_sums(spark, path) == 1 and amended(spark, path) == before
    assert amend.read_sums(spark, path).count() == size // 2
    amend.add_sums(spark, path, *small(spark, TIMES[2]))
    assert len(amended(spark, path)) > len(before)


def test_of_two_runs_at_once_one_adds_its_sums(spark, fresh, monkeypatch):
    path, real, nested = fresh("sums"), amend.write_by_city, []

    def raced(*args, **options):
        if not nested:
            nested.append(True)
            amend.add_sums(spark, path, *small(spark, TIMES[0]))
        real(*args, **options)

    monkeypatch.setattr(amend, "write_by_city", raced)
    with pytest.raises(commits.Conflict):
        amend.add_sums(spark, path, *small(spark, TIMES[0]))
    assert amended(spark, path) == wide(spark, TIMES[0])


# --- from the flat tables' logs, and roll-ups ------------------------------------
def values(spark, name: str, *times: str):
    """A batch of two cities' values of a source."""
    sample = {
        "traffic": {"grid_id": "grid_0_0", "current_speed": 30, "free_flow_speed": 60, "congestion_ratio": 0.5},
        "weather": {"grid_id": "grid_0_0", "temp": 4.5, "rain_1h_mm": 0.5},
    }
    out = []
    for i, t in enumerate(times):
        for city in "AB":
            meta = {"meta_city": city, "meta_scraped_at": t}
            out.append(meta | ({"line": "S1", "delay": 100 * i} if name == "transit" else {"samples": [sample[name]]}))
    return spark.createDataFrame([(json.dumps(v),) for v in out], "value STRING")


class Lake:
    def __init__(self, spark, path):
        self.spark, self.path, self.batch = spark, path, 0

    def write(self, *times, names=tuple(jobs.SOURCES)):
        for name in names:
            writer = silver.BatchWriter(jobs.SOURCES[name], f"{self.path}/silver/{name}", f"{self.path}/quarantine/{name}")
            writer(values(self.spark, name, *times), self.batch)
        self.batch += 1

    def gold(self):
        return gold_wide(*[silver.read_silver(self.spark, f"{self.path}/silver/{n}", s) for n, s in jobs.SOURCES.items()])


@pytest.fixture
def lake(spark, fresh):
    return Lake(spark, fresh("lake"))


def test_each_batch_is_taken_once_even_if_it_is_compacted_between(spark, lake):
    lake.write(*TIMES[:2])
    assert jobs.amend_job(spark, lake.path) == ["2024-01-01"] and jobs.amend_job(spark, lake.path) == []
    lake.write(*TIMES[1:3])
    lake.write(TIMES[0], names=("transit",))
    jobs.compact_job(spark, lake.path, date(2024, 1, 31))
    assert jobs.amend_job(spark, lake.path) == ["2024-01-01", "2024-01-02"]
    assert amended(spark, f"{lake.path}/sums") == near(lake.gold().select(*S.wide_columns()))
    assert jobs.amend_job(spark, lake.path) == []


def test_a_roll_up_reads_changed_days_only(spark, lake, monkeypatch):
    lake.write(*TIMES)
    jobs.amend_job(spark, lake.path)
    lake.write(TIMES[2], "2024-01-02T05:00:00", names=("transit",))
    read, real = [], commits.folders
    monkeypatch.setattr(commits, "folders", lambda *a: read.append(real(*a)) or read[-1])
    assert jobs.amend_job(spark, lake.path) == ["2024-01-02"]
    of_sums = [f for found in read for f in found if "/sums/" in f]
    assert of_sums and all(f.endswith("bucket_date=2024-01-02") for f in of_sums)
    rollup = amend.read_rollup(spark, f"{lake.path}/rollup")
    assert len({f.rsplit("/", 2)[0] for f in rollup.inputFiles()}) == 2


@pytest.mark.parametrize("as_of", [datetime(2024, 2, 1), datetime(2024, 1, 31, 0, 20), datetime(2024, 1, 31, 13, 0), datetime(2024, 3, 1)])
def test_reports_from_the_roll_up_equal_those_of_the_wide_table(spark, lake, as_of):
    lake.write(*TIMES, "2024-01-02T12:50:00", "2024-01-01T13:10:00")
    jobs.amend_job(spark, lake.path)
    lake.write(TIMES[0], "2024-01-01T13:40:00")
    jobs.amend_job(spark, lake.path)
    paths = f"{lake.path}/sums", f"{lake.path}/rollup"
    got = amend.hourly_patterns(spark, *paths, as_of)
    assert near(got) == near(analytics.hourly_patterns(lake.gold(), as_of))
    assert near(amend.heatmap(spark, paths[1])) == near(analytics.heatmap(lake.gold()))


def test_raw_rows_are_summed_before_the_shuffle(spark):
    plan = plan_of(amend.slot_sums(*small(spark, *TIMES)))
    assert plan.index("partial_sum") > plan.index("Exchange") and "Join" not in plan


def test_no_new_batch(spark, fresh, lake):
    assert jobs.amend_job(spark, lake.path) == []
    assert commits.untaken(spark, fresh(), "sums", fresh()) == []
