from __future__ import annotations

import itertools
import json

import pytest
from pyspark.sql import functions as F
from tests.conftest import rows

from citypulse.functions import scalars as sc
from citypulse.functions.buckets import bucket_start, with_bucket, with_calendar
from citypulse.operators.city_index import city_congestion_index
from citypulse.operators.features import KEYS, transit_stats


@pytest.mark.parametrize(
    "ratio, status",
    [(0.69, "congested"), (0.6999999, "congested"), (0.70, "heavy_traffic"), (0.8499, "heavy_traffic"),
     (0.85, "flowing"), (1.2, "flowing")],
)
def test_status_bands(spark, ratio, status):
    assert spark.range(1).select(sc.traffic_status(F.lit(ratio))).first()[0] == status


def test_congestion_ratio_guards_and_rounding(spark):
    pairs = [(30, 60, 0.5), (10, 0, 1.0), (10, None, 1.0), (1, 3, 0.33), (2, 3, 0.67), (0, 50, 0.0), (None, 50, None)]
    df = spark.createDataFrame(pairs, "c INT, f INT, want DOUBLE")
    for row in df.select(sc.congestion_ratio(F.col("c"), F.col("f")).alias("got"), "want").collect():
        assert row.got == row.want


def test_ratio_equals_python_where_not_near_a_tie(spark):
    df = spark.range(1, 131).withColumnRenamed("id", "c").crossJoin(spark.range(1, 131).withColumnRenamed("id", "f"))
    got = df.select("c", "f", sc.congestion_ratio(F.col("c"), F.col("f")).alias("r")).collect()
    off = [r for r in got if r.r != round(r.c / r.f, 2) and abs((r.c * 100 / r.f) % 1 - 0.5) > 1e-9]
    assert not off


def test_naive_timestamps(spark):
    texts = ["2024-01-02T03:04:05.678901", "2024-01-02T03:04:05", "x", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t STRING")
    got = [r[0] for r in df.select(sc.naive_timestamp(F.col("t")).cast("string")).collect()]
    assert got == ["2024-01-02 03:04:05.678901", "2024-01-02 03:04:05", None, None, None]


def test_json_object_test(spark):
    cases = {
        "not json": False, "5": False, "[1]": False, "null": False, "{}": True, '{"raw":"x"}': True,
        '{"a":1} trailing': False, '{"a":1': False, ' {"a":1} ': True, "{'a':1}": False, '{"a":{"b":[1,2]}}': True,
        '{"a":1}{"b":2}': False, '{"a":1} x}': False, '{"a":1},}': False, '{"a":1},': False, '{"a":1},{"b":2}': False,
        '{"a":1}],[{"b":2}': False, '{"a":1}, "w": {"b":2}': False, '{"a":1}\t': True, "": False,
    }
    df = spark.createDataFrame([(k,) for k in cases], "v STRING")
    got = {r[0]: r[1] for r in df.select("v", F.coalesce(sc.is_json_object(F.col("v")), F.lit(False))).collect()}
    assert got == cases


PIECES = (
    "{", "}", "[", "]", ",", ":", '"a"', "1", "01", " ", "\n", "x", "NaN", "null", "\\", "{}", '{"a":1}', "{'a':1}",
    '{"a":NaN}', '{"a":{"b":[1,2]}}', '{"a":"\t"}', "/*c*/", f'"{sc.MARK}"', f'{{"{sc.MARK}":true}}',
)


def _is_object(text: str) -> bool:
    def refused(_):
        raise ValueError

    try:
        return isinstance(json.loads(text, parse_constant=refused), dict) and sc.MARK not in text
    except ValueError:
        return False


def test_one_decode_tells_whole_objects_from_all_other_text(spark):
    """Everything that can be put together of three pieces, against Python's reader."""
    texts = {"".join(p) for n in range(4) for p in itertools.product(PIECES, repeat=n)}
    texts |= {'{"a":1}] x', '{"a":1}],["x"', '{"a":1},{"%s":true}] x' % sc.MARK, '{"a":1},"%s"] x' % sc.MARK}
    df = spark.createDataFrame([(t,) for t in texts], "t STRING").repartition(8)
    read = df.select("t", sc.read_object(F.col("t"), "a STRING", strict=True).alias("read"))
    got = read.select("t", sc.is_json_object(F.col("t")).alias("tested"), sc.whole_object(F.col("read")).alias("whole"))
    off = [r.t for r in got.collect() if {r.tested, r.whole is not None} != {_is_object(r.t)}]
    assert off == [] and len(texts) > 10_000


def test_grid_id_prefix(spark):
    df = spark.createDataFrame([("0_0",), ("grid_2_1",), (None,)], "g STRING")
    assert [r[0] for r in df.select(sc.normalise_grid_id(F.col("g"))).collect()] == ["grid_0_0", "grid_2_1", None]


def test_modes_are_case_sensitive(spark):
    want = {"Bus 5": "bus", "STR 10": "bus", "bus 7": "rail", "S1": "rail", "Ferry 62": "rail", None: None}
    df = spark.createDataFrame([(k,) for k in want], "line STRING")
    assert {r[0]: r[1] for r in df.select("line", sc.transit_mode(F.col("line"))).collect()} == want


def test_bucket_does_not_follow_daylight_saving(spark):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        df = spark.range(1).select(F.timestamp_seconds(F.lit(1761442200)).alias("ts"))
        assert df.select(F.unix_timestamp(bucket_start(F.col("ts")))).first()[0] == 1761442200
        naive = spark.createDataFrame([("2024-03-31T02:40:00",), ("2024-10-27T02:10:00",)], "meta_scraped_at STRING")
        got = with_bucket(naive).select(F.col("time_bucket").cast("string")).collect()
        assert [r[0] for r in got] == ["2024-03-31 02:30:00", "2024-10-27 02:00:00"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_rows_without_time_have_no_bucket(spark):
    df = spark.createDataFrame([("x",), (None,), ("2024-01-07T10:29:59.999999",)], "meta_scraped_at STRING")
    got = with_calendar(with_bucket(df)).select(F.col("time_bucket").cast("string"), "hour_of_day", "day_of_week")
    assert rows(got) == [("2024-01-07 10:00:00", 10, 1)]


def test_bucket_width_is_a_parameter(spark):
    df = spark.createDataFrame([("2024-01-07T10:29:59",)], "meta_scraped_at STRING")
    assert str(with_bucket(df, "10 minutes").first().time_bucket) == "2024-01-07 10:20:00"


def test_stress_threshold_null_delay_and_missing_mode(spark):
    lines = [("A", "S1", 300), ("A", "S1", 301), ("A", "S1", None), ("A", None, 900), ("B", "Bus 1", 600)]
    df = spark.createDataFrame(lines, "meta_city STRING, line STRING, delay INT").withColumn(
        "time_bucket", F.lit("2024-01-01").cast("timestamp_ntz")
    )
    got = {r.meta_city: r for r in transit_stats(df).collect()}
    assert got["A"].rail_avg_delay == 300.5
    assert got["A"].rail_stress_index == pytest.approx(1 / 3)
    assert got["A"].bus_avg_delay is None and got["A"].bus_stress_index is None
    assert got["B"].rail_stress_index is None and got["B"].bus_stress_index == 1.0
    assert set(KEYS) <= set(transit_stats(df).columns)


def test_city_index_confidence_and_bands(spark):
    samples = [
        ("A", "t", 10, 100, 0.5), ("A", "t", 84, 100, 0.51),
        ("B", "t", 10, 0, 0.9), ("C", "t", 10, 100, 0.5), ("D", "t", 697, 1000, 1.0),
    ]
    df = spark.createDataFrame(
        samples, "meta_city STRING, meta_scraped_at STRING, current_speed INT, free_flow_speed INT, confidence DOUBLE"
    )
    got = {r.meta_city: (r.average_congestion_ratio, r.status_label) for r in city_congestion_index(df).collect()}
    # D: 0.697 rounds to 0.7, but the band looks at the unrounded value.
    assert got == {
        "A": (0.84, "heavy_traffic"), "B": (1.0, "flowing"), "C": (1.0, "flowing"), "D": (0.7, "congested")
    }
