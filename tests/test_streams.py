from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from tests.conftest import plan_of, rows

from citypulse import schemas as S
from citypulse.plans.gold import gold_wide
from citypulse.plans.incremental import rows_after
from citypulse.sources.tables import read_table
from citypulse.streaming import silver
from citypulse.streaming.gold import gold_stream, write_gold_stream
from tests.test_gold import at, buckets, small, traffic, transit, weather

GOOD = '{"meta_city":"%s","meta_scraped_at":"2024-01-01T00:00:00","line":"S1","delay":%d}'


def topic(fresh, *batches):
    path = Path(fresh("topic"))
    path.mkdir(parents=True)
    for n, lines in enumerate(batches):
        (path / f"{n}.txt").write_text("\n".join(lines))
    return path


def run(spark, path, table, checkpoint, quarantine, **options):
    stream = spark.readStream.option("maxFilesPerTrigger", 1).text(str(path))
    writer = silver.BatchWriter(silver.TRANSIT, table, quarantine, **options)
    silver.drain_all([(stream, writer, checkpoint)])
    return writer.quarantined


def test_batches_resume_and_bad_values_go_to_quarantine(spark, fresh):
    path = topic(fresh, [GOOD % ("A", 1), "not json", "5"], [GOOD % ("B", 2), '{"raw":"x"}'], [GOOD % ("A", 3)])
    table, checkpoint, quarantine = fresh("silver"), fresh("checkpoint"), fresh("quarantine")
    assert run(spark, path, table, checkpoint, quarantine) == {"no_city": 3}
    (path / "9.txt").write_text(GOOD % ("C", 4))
    run(spark, path, table, checkpoint, quarantine)
    run(spark, path, table, checkpoint, quarantine)
    got = silver.read_silver(spark, table, silver.TRANSIT)
    assert rows(got.select("meta_city", "delay")) == [("A", 1), ("A", 3), ("B", 2), ("C", 4)]
    assert got.filter("ingestion_time IS NULL OR ts IS NULL").count() == 0
    bad = read_table(spark, quarantine, "value STRING, reason STRING")
    assert rows(bad.select("value", "reason")) == [("5", "malformed"), ("not json", "malformed"), ('{"raw":"x"}', "no_city")]
    assert len(list(Path(quarantine).glob("batch=*"))) == 2


def test_replayed_batch_leaves_its_rows_once(spark, fresh):
    table = fresh("silver")
    write = silver.BatchWriter(silver.TRANSIT, table, fresh("quarantine"))
    batch = spark.createDataFrame([(GOOD % ("A", 1),), (GOOD % ("B", 2),)], "value STRING")
    for batch_id in (0, 0, 1, 1):
        write(batch, batch_id)
    assert silver.read_silver(spark, table, silver.TRANSIT).count() == 4


def test_a_new_checkpoint_is_refused_and_overwrites_nothing(spark, fresh):
    path = topic(fresh, [GOOD % ("A", 1)], [GOOD % ("A", 2)])
    table, quarantine = fresh("silver"), fresh("quarantine")
    run(spark, path, table, fresh("checkpoint"), quarantine)
    more = topic(fresh, [GOOD % ("A", 3)])
    with pytest.raises(StreamingQueryException, match="another checkpoint"):
        run(spark, more, table, fresh("checkpoint"), quarantine)
    run(spark, more, table, fresh("checkpoint"), quarantine, adopt=True)
    assert rows(silver.read_silver(spark, table, silver.TRANSIT).select("delay")) == [(1,), (2,), (3,)]


LINE = '{"meta_city":%s,"meta_scraped_at":%s,"line":"S1","delay":1}'


def test_every_value_is_kept_or_quarantined_with_its_reason(spark, fresh):
    good = LINE % ('"A"', '"2024-01-01T00:00:00"')
    values = [
        good, LINE % ("null", '"2024-01-01T00:00:00"'), LINE % ('"A"', "null"), LINE % ('"A"', '"x"'),
        LINE % ('"A"', '"2999-01-01T00:00:00"'), good + good, good + " x}", good + "\t", "{", None,
    ]
    write = silver.BatchWriter(silver.TRANSIT, fresh("silver"), fresh("quarantine"))
    write(spark.createDataFrame([(v,) for v in values], "value STRING"), 0)
    kept = silver.read_silver(spark, write.path, silver.TRANSIT).count()
    bad = read_table(spark, write.quarantine, "value STRING, reason STRING").groupBy("reason").count()
    assert kept == 2
    assert dict(rows(bad)) == {"no_city": 1, "no_time": 2, "ahead": 1, "malformed": 4}
    assert sum(write.quarantined.values()) == 8


def test_days_are_read_by_folder_and_can_be_compacted(spark, fresh):
    write = silver.BatchWriter(silver.TRANSIT, fresh("silver"), fresh("quarantine"))
    for n, day in enumerate(("2024-01-01", "2024-01-02", "2024-01-03")):
        write(spark.createDataFrame([(LINE % ('"A"', f'"{day}T00:00:00"'),)], "value STRING"), n)
    table = silver.read_silver(spark, write.path, silver.TRANSIT)
    late = rows_after(table, at("2024-01-02T10:00:00"))
    assert "PartitionFilters: [isnotnull(scraped_date" in plan_of(late) and late.count() == 1
    assert silver.compact(spark, write.path, silver.TRANSIT) == 0  # each day lies in one folder


def test_no_batch_yet(spark, fresh):
    got = silver.read_silver(spark, fresh("silver"), silver.TRAFFIC)
    assert got.count() == 0 and "congestion_ratio" in got.columns


def streams(spark, fresh, *sources):
    out = []
    for df in sources:
        path = fresh("flat")
        df.write.parquet(path)
        out.append((path, spark.readStream.schema(df.schema).parquet(path)))
    return out


def drained(spark, fresh, sources, **options):
    out = fresh("gold")
    df = gold_stream(*[s for _, s in streams(spark, fresh, *sources)], **options)
    write_gold_stream(df, out, fresh("checkpoint")).awaitTermination()
    return read_table(spark, out, S.wide_schema())


TIMES = ("2024-01-01T00:05:00", "2024-01-01T00:45:00", "2024-01-01T01:05:00")


def test_stream_equals_batch(spark, fresh):
    sources = small(spark, *TIMES)
    got = drained(spark, fresh, sources)
    closed = gold_wide(*sources).filter(F.col("time_bucket") < F.lit("2024-01-01 01:00:00").cast("timestamp_ntz"))
    assert rows(got) == rows(closed.select(*S.wide_columns()))


def test_delay_holds_buckets_back(spark, fresh):
    assert buckets(drained(spark, fresh, small(spark, *TIMES), delay="30 minutes")) == ["2024-01-01 00:00:00"]


def test_slowest_source_decides_with_one_watermark_per_source(spark, fresh):
    fast = traffic(spark, *[("A", t, "grid_0_0", 0.5, 30) for t in TIMES])
    slow = weather(spark, ("A", "2024-01-01T00:35:00", "grid_0_0", 0.0, 9.5))
    bus = transit(spark, *[("A", t, "S1", 60) for t in TIMES])
    assert len(buckets(drained(spark, fresh, (fast, slow, bus)))) == 2
    assert buckets(drained(spark, fresh, (fast, slow, bus), per_source=True)) == ["2024-01-01 00:00:00"]


def test_later_runs_add_buckets_and_drop_late_rows(spark, fresh):
    sources = small(spark, *TIMES)
    inputs = streams(spark, fresh, *sources)
    out, checkpoint = fresh("gold"), fresh("checkpoint")

    def drain():
        df = gold_stream(*[spark.readStream.schema(d.schema).parquet(p) for (p, _), d in zip(inputs, sources)])
        write_gold_stream(df, out, checkpoint).awaitTermination()
        return buckets(read_table(spark, out, S.wide_schema()))

    assert drain() == ["2024-01-01 00:00:00", "2024-01-01 00:30:00"]
    for (path, _), df in zip(inputs, small(spark, "2024-01-01T00:10:00", "2024-01-01T02:05:00")):
        df.write.mode("append").parquet(path)
    assert drain() == ["2024-01-01 00:00:00", "2024-01-01 00:30:00", "2024-01-01 01:00:00"]


def test_stream_refuses_other_zones(spark, fresh):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        with pytest.raises(ValueError, match="timeZone"):
            gold_stream(*[s for _, s in streams(spark, fresh, *small(spark, *TIMES))])
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
