from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from tests.conftest import optimized_of, plan_of, rows

from citypulse import schemas as S
from citypulse.operators import parsing
from citypulse.operators.city_index import cycle_summary
from citypulse.operators.nesting import nest_traffic, to_lines, untimed
from citypulse.operators.payloads import departures, normalise_flat, traffic_samples, weather_samples
from citypulse.operators.spatial import grid_points


def values(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value STRING")


DOC = '{"meta_city":"A","meta_scraped_at":"2024-01-01T00:00:00","extra":1,"samples":%s}'


def test_bytes_and_text_parse_alike(spark):
    text = values(spark, DOC % '[{"grid_id":"grid_0_0","current_speed":5,"lat":1.5}]')
    raw = text.select(F.col("value").cast("binary").alias("value"))
    assert rows(parsing.parse_values(raw, S.TRAFFIC_DOCUMENT)) == rows(parsing.parse_values(text, S.TRAFFIC_DOCUMENT))


def test_empty_null_and_absent_samples_give_no_rows(spark):
    raw = values(spark, DOC % "[]", DOC % "null", '{"meta_city":"A","meta_scraped_at":"t"}', "not json", "")
    assert parsing.flatten_traffic(raw).count() == 0


def test_wrong_type_nulls_the_field_only(spark):
    raw = values(spark, DOC % '[{"grid_id":"grid_0_0","current_speed":5.5,"free_flow_speed":7,"confidence":1}]')
    row = parsing.flatten_traffic(raw).first()
    assert (row.current_speed, row.free_flow_speed, row.confidence) == (None, 7, 1.0)


def test_explode_equals_plain_explode(spark):
    raw = values(spark, DOC % '[{"grid_id":"a"},null,{"grid_id":"b"}]', DOC % "[]")
    docs = parsing.parse_values(raw, S.TRAFFIC_DOCUMENT)
    plain = docs.select("meta_city", "meta_scraped_at", F.explode("samples").alias("s")).select(
        "meta_city", "meta_scraped_at", "s.*"
    )
    assert rows(parsing.explode_samples(docs)) == rows(plain)


def test_json_is_parsed_once(spark):
    plan = optimized_of(parsing.flatten_traffic(values(spark, DOC % "[]").repartition(2)))
    assert plan.count("from_json(") == 1


def test_flat_rows_keep_nulls_and_stamps(spark):
    raw = values(spark, '{"meta_city":"A","meta_scraped_at":"x","line":null,"delay":null}', "oops")
    got = parsing.flatten_transit(raw)
    assert got.filter("meta_city IS NULL").count() == 1
    row = got.filter("meta_city IS NOT NULL").first()
    assert (row.line, row.delay, row.ts, row.scraped_date) == (None, None, None, None)
    assert row.ingestion_time is not None


def test_unusable_values_are_the_complement(spark):
    texts = [
        "not json", "5", "[1]", "null", '{"raw":"x","_source_file":"f"}', '{"meta_city":null}', DOC % "[]",
        '{"meta_city":"1"}', "", DOC % "[]" + DOC % "[]", DOC % "[]" + "," + DOC % "[]", DOC % "[]" + " x}",
        DOC % "[]" + ",", DOC % "[]" + ",}", DOC % "[]" + "\t", "[" + DOC % "[]" + "]",
        DOC % "[]" + "] x", DOC % "[]" + "],[",
    ]
    raw = values(spark, *texts)
    got = {r.value: r.reason for r in parsing.unusable_values(raw, "1 day").collect()}
    good = [DOC % "[]", DOC % "[]" + "\t"]
    reasons = {'{"raw":"x","_source_file":"f"}': "no_city", '{"meta_city":null}': "no_city", '{"meta_city":"1"}': "no_time"}
    assert got == {t: reasons.get(t, "malformed") for t in texts if t not in good}
    parsed = parsing.parse_values(raw, S.DEPARTURE_RECORD)
    fault = parsing.value_fault(F.col("meta_city"), F.col("meta_scraped_at"), "1 day")
    assert parsed.filter(fault.isNull()).count() == len(good)


def test_every_text_is_decoded_once(spark):
    raw, asked = values(spark, DOC % "[]"), responses(spark, '{"main":{"temp":1.5}}')
    for df in (parsing.flatten_transit(raw), parsing.flatten_weather(raw), weather_samples(asked), traffic_samples(asked)):
        assert optimized_of(df).count("from_json(") + optimized_of(df).count("json_object_keys(") == 1


def test_a_wrong_type_or_a_mark_within_a_value(spark):
    texts = '{"meta_city":"A","delay":"x","line":"S1"}', '{"meta_city":"A","_end_of_value":true}', '{"delay":{"a":1},"line":7}'
    read = parsing.parse_values(values(spark, *texts), S.DEPARTURE_RECORD)
    assert [(r.meta_city, r.delay, r.line) for r in read.collect()] == [("A", None, "S1"), (None,) * 3, (None, None, "7")]


def responses(spark, *payloads):
    df = spark.createDataFrame([(p,) for p in payloads], "payload STRING")
    return df.select(
        F.lit("A").alias("meta_city"), F.lit("2024-01-01T00:00:00").alias("meta_scraped_at"), F.lit("grid_0_0").alias("grid_id"),
        F.lit(1.0).alias("lat"), F.lit(2.0).alias("lon"), "payload",
    )


def test_traffic_payloads(spark):
    got = traffic_samples(
        responses(
            spark,
            '{"flowSegmentData":{"currentSpeed":30,"freeFlowSpeed":60,"confidence":0.9}}',
            '{"flowSegmentData":{"currentSpeed":30}}',
            '{"flowSegmentData":{"currentSpeed":5.5,"freeFlowSpeed":11,"confidence":1}}',
            '{"error":"x"}', None, "nope",
        )
    ).select("current_speed", "free_flow_speed", "congestion_ratio", "confidence")
    assert rows(got) == sorted([(30, 60, 0.5, 0.9), (30, 0, 1.0, 0.0), (None, 11, 0.5, 1.0)], key=repr)


def test_weather_payload_rain(spark):
    body = '{"main":{"temp":1.5,"humidity":80},"weather":[{"main":"Rain","description":"d"}],"wind":{"speed":2}%s}'
    got = weather_samples(
        responses(
            spark, body % ',"rain":{"1h":0.5}', body % ',"rain":{}', body % "", body % ',"rain":{"1h":null}',
            body % ',"rain":"much"', "{}", None, "", "null",
        )
    )
    assert sorted(got.select("rain_1h_mm").toPandas().rain_1h_mm.fillna(-1)) == [-1, 0, 0, 0, 0.5]
    bare = weather_samples(responses(spark, '{"visibility":10}')).first()
    assert (bare.temp, bare.weather_main, bare.rain_1h_mm, bare.visibility) == (None, None, 0.0, 10)


def test_departures_missing_and_null(spark):
    entries = '[{"line":{"name":"S1"},"delay":60,"tripId":"1"},{"line":null,"delay":null,"tripId":"2"},{"tripId":"3"}]'
    got = departures(responses(spark, entries, '{"departures":%s}' % entries, '{"departures":null}', '{"x":1}', None))
    per_shape = [("S1", 60, "1"), (None, None, "2"), (None, 0, "3")]
    assert rows(got.select("line", "delay", "raw_id")) == sorted(per_shape * 2, key=repr)


def test_flat_input_drops_failed_probes(spark):
    flat = spark.createDataFrame(
        [("0_0", 0, 0, 0.0), ("0_1", 0, 0, 0.5), ("grid_0_2", 5, 0, 0.0), ("1_0", None, None, None)],
        "grid_id STRING, current_speed INT, free_flow_speed INT, confidence DOUBLE",
    )
    assert [r[0] for r in rows(normalise_flat(flat).select("grid_id"))] == ["grid_0_1", "grid_0_2", "grid_1_0"]


def test_samples_without_a_time_are_told_apart(spark):
    rows_in = samples(spark, 5).withColumn("meta_scraped_at", F.when(F.col("lat") > 2, "x").otherwise(F.col("meta_scraped_at")))
    assert untimed(rows_in).count() == 2
    assert nest_traffic(rows_in).select(F.explode("samples")).count() == 3


def test_no_join_before_rows_are_split(spark):
    plan = plan_of(nest_traffic(samples(spark, 5), parts=4))
    assert plan.count("Join") == 1 and "_part" in plan.split("Join", 1)[1].split("\n")[0]
    assert "Join" not in plan_of(nest_traffic(samples(spark, 5)))


def test_cycles_count_scrapes_and_not_documents(spark):
    rows_in = samples(spark, 40).unionByName(samples(spark, 9, "B"))
    departures = spark.createDataFrame([("A", "2024-01-01T00:00:00")], "meta_city STRING, meta_scraped_at STRING")
    whole, split = (cycle_summary(nest_traffic(rows_in, parts=p), nest_traffic(rows_in), departures) for p in (1, 6))
    assert rows(whole) == rows(split)
    assert {r.source: r.records_collected for r in split.collect()} == {"traffic": 2, "weather": 2, "transit": 1}


def test_grid_points_of_the_cities(spark):
    boxes = spark.createDataFrame(list(S.CITY_BBOXES.items()), "city STRING, bbox STRING")
    points = grid_points(boxes)
    assert points.count() == 45
    first = points.filter("city = 'Hamburg' AND grid_id = 'grid_0_1'").first()
    assert (round(first.lat, 6), round(first.lon, 6)) == (53.545, 9.825)
    assert grid_points(boxes, size=5).count() == 125


def test_bad_boxes_give_no_points(spark):
    boxes = spark.createDataFrame([("a,b,c,d",), ("1,2,3",), ("1,2,3,4,5",), ("",), (None,), (" 1, 2 ,3,4",)], "bbox STRING")
    assert grid_points(boxes).count() == 9


def samples(spark, n, city="A"):
    return spark.range(n).select(
        F.lit(city).alias("meta_city"), F.lit("2024-01-01T00:00:00").alias("meta_scraped_at"),
        F.concat(F.lit("grid_"), F.col("id") % 9).alias("grid_id"), F.col("id").cast("double").alias("lat"),
        F.lit(60).alias("current_speed"), F.lit(100).alias("free_flow_speed"), F.lit(0.9).alias("confidence"),
    )


@pytest.mark.parametrize("parts", [1, 20])
def test_a_scrape_becomes_as_many_documents_as_asked_for(spark, parts):
    rows_in = samples(spark, 1000).unionByName(samples(spark, 9, "B")).repartition(4)
    docs = nest_traffic(rows_in, parts=parts)
    sizes = docs.select("meta_city", "part", "part_count", F.size("samples").alias("n")).collect()
    assert sum(r.n for r in sizes if r.meta_city == "A") == 1000
    assert sum(r.meta_city == "A" for r in sizes) == parts and sum(r.n for r in sizes if r.meta_city == "B") == 9
    assert {r.part_count for r in sizes} == {parts}
    assert {r[0] for r in docs.select("average_congestion_ratio").collect()} == {0.6}
    again = nest_traffic(rows_in.repartition(7), parts=parts)
    assert again.exceptAll(docs).count() == 0
    back = parsing.flatten_traffic(to_lines(docs)).select("meta_city", "grid_id", "lat")
    assert back.exceptAll(rows_in.select("meta_city", "grid_id", "lat")).count() == 0
    assert back.count() == 1009
