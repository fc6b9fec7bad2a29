from __future__ import annotations

from datetime import date
from pathlib import Path

from tests.test_gold import at, buckets

from citypulse import jobs
from citypulse.sources.serving import ParquetServing
from citypulse.sources.tables import read_table
from citypulse.streaming import bronze

DOC = '{"meta_city":"A","meta_scraped_at":"%s","samples":[{"grid_id":"grid_0_0",%s}]}'
TRAFFIC = '"current_speed":30,"free_flow_speed":60,"congestion_ratio":0.5,"confidence":1.0'
WEATHER = '"temp":4.5,"rain_1h_mm":0.5'
DEPARTURE = '{"meta_city":"A","meta_scraped_at":"%s","line":"Bus 5","delay":600}'


def collect(root: Path, name: str, *times: str) -> None:
    """What the three collectors leave in the landing folders."""
    lines = {
        "TomTom": [DOC % (t, TRAFFIC) for t in times],
        "OWM": [DOC % (t, WEATHER) for t in times],
        "DB": [DEPARTURE % t for t in times] + ["broken {"],
    }
    for folder, text in lines.items():
        path = root / folder / "2024/01/01"
        path.mkdir(parents=True, exist_ok=True)
        (path / f"{name}_{folder}_data.jsonl").write_text("\n".join(text))


def run(spark, landing: str, lake: str, target) -> None:
    """All jobs once, with topic folders in the place of Kafka."""
    topics = f"{lake}/topics"
    bronze.write_topic_files(bronze.routed_lines(spark, landing), topics, f"{lake}/checkpoints/route").awaitTermination()
    streams = {
        name: spark.readStream.schema("value STRING, dead_letter BOOLEAN").parquet(f"{topics}/topic={topic}")
        for name, topic in jobs.TOPICS.items()
    }
    dropped = jobs.silver_job(spark, streams, lake)
    assert dropped["traffic"] == {} and set(dropped["transit"]) <= {"no_city"}
    jobs.gold_job(spark, lake)
    jobs.publish_job(spark, lake, target)


def test_landing_to_serving_in_two_runs(spark, fresh):
    landing, lake = fresh("landing"), fresh("lake")
    target = ParquetServing(spark, fresh("serving"))
    collect(Path(landing), "000500", "2024-01-01T00:05:00", "2024-01-01T00:15:00", "2024-01-01T00:35:00")
    run(spark, landing, lake, target)
    row = target.read().collect()
    assert [r.time_bucket for r in row] == [at("2024-01-01T00:00:00")]
    assert (row[0].grid_0_0_congestion, row[0].grid_0_0_speed, row[0].grid_0_0_rain, row[0].grid_0_0_temp) == (
        0.5, 30.0, 0.5, 4.5
    )
    assert (row[0].bus_avg_delay, row[0].bus_stress_index, row[0].rail_avg_delay) == (600.0, 1.0, None)
    collect(Path(landing), "013500", "2024-01-01T00:45:00", "2024-01-01T01:35:00")
    run(spark, landing, lake, target)
    run(spark, landing, lake, target)
    assert buckets(target.read()) == ["2024-01-01 00:00:00", "2024-01-01 00:30:00"]
    quarantined = read_table(spark, f"{lake}/quarantine/transit", "value STRING, reason STRING")
    assert quarantined.count() == 2


def test_a_run_with_nothing_closed_reads_no_flat_table(spark, fresh, monkeypatch):
    landing, lake = fresh("landing"), fresh("lake")
    collect(Path(landing), "000500", "2024-01-01T23:05:00", "2024-01-01T23:35:00", "2024-01-02T00:05:00")
    run(spark, landing, lake, ParquetServing(spark, fresh("serving")))
    read, real = [], jobs.silver.read_silver
    monkeypatch.setattr(jobs.silver, "read_silver", lambda *a: read.append(a[3:]) or real(*a))
    assert jobs.gold_job(spark, lake).ceiling is None and read == []
    assert jobs.gold_job(spark, lake, flush=True).ceiling == at("2024-01-02T00:30:00")
    assert set(read) == {(date(2024, 1, 1), date(2024, 1, 2))}


def test_the_retry_job_takes_what_can_be_used_by_now(spark, fresh):
    landing, lake = fresh("landing"), fresh("lake")
    collect(Path(landing), "000500", "2024-01-01T00:05:00")
    run(spark, landing, lake, ParquetServing(spark, fresh("serving")))
    assert jobs.retry_job(spark, lake) == {"traffic": (0, 0), "weather": (0, 0), "transit": (1, 1)}
    mended = DEPARTURE % "2024-01-01T00:06:00"
    assert jobs.retry_job(spark, lake, lambda df: df.selectExpr(f"'{mended}' AS value"))["transit"] == (1, 0)
    assert jobs.silver.read_silver(spark, f"{lake}/silver/transit", jobs.silver.TRANSIT).count() == 2


def test_jobs_on_an_empty_lake(spark, fresh):
    lake = fresh("lake")
    assert jobs.gold_job(spark, lake).ceiling is None
    assert jobs.publish_job(spark, lake, ParquetServing(spark, fresh("serving"))) is False


def test_sources_meet_their_topics():
    assert jobs.TOPICS == {"traffic": "raw-traffic", "weather": "raw-weather", "transit": "raw-db"}


def test_credentials_come_from_a_file(tmp_path):
    path = tmp_path / "db.properties"
    path.write_text("user=u\npassword=a=b\n\n")
    assert jobs._properties(str(path)) == {"user": "u", "password": "a=b"}
    assert jobs._properties(None) == {}
