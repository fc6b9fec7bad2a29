"""How the flat tables' input is built: by time before it becomes text, and dealt out over all tasks."""

from __future__ import annotations

import pytest
from tests.conftest import optimized_of, rows

from checks import fixtures as X
from checks import queries as Q
from citypulse.operators.nesting import to_lines

TYPES = ("view", "click", "signup", "purchase", "error")
TIMES = ("2024-01-14 23:59:59.999999", "2024-01-15 00:00:00", "2024-01-20 10:00:00", None)


@pytest.fixture
def sf_dir(spark, fresh):
    """Events on both sides of the cut and without a time, some of them twice, some without ids or a value."""
    made = [
        (n if n % 11 else None, TIMES[n % 4], n % 7 if n % 5 else None, TYPES[n % 5 if n % 3 else 0], n * 1.5 if n % 13 else None, "{}")
        for n in range(200)
    ]
    events = spark.createDataFrame(made + made[:40], "event_id BIGINT, at STRING, user_id BIGINT, event_type STRING, value DOUBLE, props STRING")
    path = fresh("events")
    events.selectExpr("event_id", "CAST(at AS TIMESTAMP_NTZ) AS ts", "user_id", "event_type", "value", "props").coalesce(1).write.parquet(
        f"{path}/events.parquet"
    )
    return path


@pytest.fixture
def batches(spark, sf_dir, monkeypatch):
    """What each of the two micro-batches of a source is given."""
    given = {}
    monkeypatch.setattr(
        Q.silver, "BatchWriter", lambda source, path, bad: lambda batch, n: given.update({(path.rsplit("/", 1)[1], n): batch})
    )
    Q._lake(spark, sf_dir)
    return given


def test_no_text_is_made_to_find_its_time(batches):
    assert len(batches) == 6
    for batch in batches.values():
        filters = [line for line in optimized_of(batch).splitlines() if "Filter" in line]
        assert filters and not any("get_json_object" in line or "StructsToJson" in line for line in filters)


def test_one_file_split_is_built_by_many_tasks(spark, batches):
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert {batch.rdd.getNumPartitions() for batch in batches.values()} == {tasks}


@pytest.mark.parametrize("name", ["traffic", "weather", "transit"])
def test_both_batches_have_every_value_with_a_time_once(spark, sf_dir, batches, name):
    made = {"traffic": X.traffic_documents, "weather": X.weather_documents, "transit": Q.departure_records}[name](spark, sf_dir)
    halves = [rows(batches[name, n]) for n in (0, 1)]
    assert sorted(halves[0] + halves[1]) == rows(to_lines(made.filter("meta_scraped_at IS NOT NULL")))
    assert halves[0] and all('"meta_scraped_at":"2024-01-14T' in value for (value,) in halves[0])
    assert halves[1] and not any('"meta_scraped_at":"2024-01-14T' in value for (value,) in halves[1])
