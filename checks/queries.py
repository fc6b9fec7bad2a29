"""Every operator as a query over the given tables: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures as X
from citypulse import schemas as S
from citypulse.functions.buckets import with_bucket, with_calendar
from citypulse.functions.scalars import congestion_ratio, speed_ratio, traffic_status
from citypulse.jobs import SOURCES, gold_job
from citypulse.operators import payloads
from citypulse.operators.city_index import city_congestion_index, cycle_summary
from citypulse.operators.features import (
    bucket_bounds,
    master_keys,
    traffic_pivot,
    transit_stats,
    weather_pivot,
    with_mode,
)
from citypulse.operators.nesting import nest_traffic, nest_weather, to_lines
from citypulse.operators.parsing import explode_samples, parse_values, stamp
from citypulse.operators.spatial import grid_points
from citypulse.plans import amend, analytics
from citypulse.plans.gold import gold_wide, gold_wide_join
from citypulse.plans.incremental import append_increment, closed_buckets, committed_totals, compact_gold, read_gold
from citypulse.plans.publish import publish
from citypulse.session import fresh_path
from citypulse.sources import commits
from citypulse.sources.landing import read_landing, read_lines, route, write_landing
from citypulse.sources.serving import ParquetServing
from citypulse.sources.tables import read_table, run_after, write_by_city, write_run
from citypulse.streaming import bronze, gold as gold_streaming, silver

Query = Callable[[SparkSession, str], DataFrame]

META = ("meta_city", "meta_scraped_at")
SCRAPE = ("event_id", *META)
TRAFFIC_COLS = (
    *META, "grid_id", "lat", "lon", "current_speed", "free_flow_speed", "congestion_ratio", "confidence",
)
WEATHER_COLS = (
    *META, "grid_id", "lat", "lon", "temp", "humidity", "wind_speed", "rain_1h_mm", "weather_main", "description",
)
TRANSIT_COLS = (*META, "line", "delay", "direction", "planned_time")


def comparable(df: DataFrame) -> DataFrame:
    """Doubles to nine places, ties to even: the order of float sums differs between engines.

    Means of two-decimal readings hit a tie of nine places only from 256 rows on.
    """
    return df.selectExpr(
        *[f"rint({name} * 1e9) / 1e9 AS {name}" if kind == "double" else name for name, kind in df.dtypes]
    )


def rounded(query: Query) -> Query:
    return lambda spark, sf_dir: comparable(query(spark, sf_dir))


# --- landing files and topics -----------------------------------------------
def departure_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.transit(spark, sf_dir).select(*TRANSIT_COLS)


def bronze_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing -> topics as a stream, drained three times.

    Some departures arrive after the first drain, half of them in files with an old time. The last
    drain finds every file done.
    """
    root, out, checkpoint = (fresh_path(spark, label) for label in ("landing", "topics", "checkpoint"))
    records = X.transit(spark, sf_dir)

    def drain() -> None:
        messages = bronze.routed_lines(spark, root, max_files=64)
        bronze.write_topic_files(messages, out, checkpoint).awaitTermination()

    write_landing(X.traffic_documents(spark, sf_dir), f"{root}/TomTom")
    write_landing(X.weather_documents(spark, sf_dir), f"{root}/OWM")
    write_landing(records.filter("event_id % 2 = 0").select(*TRANSIT_COLS), f"{root}/DB")
    drain()
    write_landing(records.filter("event_id % 4 = 1").select(*TRANSIT_COLS), f"{root}/DB/restored")
    X.make_old(spark, f"{root}/DB/restored")
    write_landing(records.filter("event_id % 4 = 3").select(*TRANSIT_COLS), f"{root}/DB")
    drain()
    drain()
    topics = spark.read.schema("value STRING, dead_letter BOOLEAN, topic STRING").parquet(out)
    fields = F.from_json("value", f"{S.META}, line STRING, samples ARRAY<STRUCT<grid_id: STRING>>")
    return topics.select("topic", fields.alias("f")).select(
        "topic", "f.meta_city", "f.meta_scraped_at", "f.line", F.size("f.samples").alias("sample_count")
    ).withColumn("sample_count", F.when(F.col("sample_count") >= 0, F.col("sample_count")))


def _raw_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = fresh_path(spark, "raw-landing")
    X.raw_lines(spark, sf_dir).select("value").write.text(f"{root}/DB")
    return route(read_lines(spark, root, "*.txt"))


def bronze_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good lines with their own field and the two provenance fields."""
    fields = F.from_json("value", "k INT, _source_file STRING, _ingested_at STRING")
    good = _raw_landing(spark, sf_dir).filter("NOT dead_letter").select("topic", fields.alias("f"))
    return good.select(
        "topic",
        "f.k",
        F.col("f._source_file").endswith(".txt").alias("has_source_file"),
        F.col("f._ingested_at").try_cast("timestamp_ntz").isNotNull().alias("has_ingested_at"),
    )


def bronze_dead_letter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bad lines, whole, without an ingestion time."""
    fields = F.from_json("value", "raw STRING, _source_file STRING, _ingested_at STRING")
    bad = _raw_landing(spark, sf_dir).filter("dead_letter").select("topic", fields.alias("f"))
    return bad.select(
        "topic",
        "f.raw",
        F.col("f._source_file").endswith(".txt").alias("has_source_file"),
        F.col("f._ingested_at").isNotNull().alias("has_ingested_at"),
    )


def landing_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "landing-json")
    write_landing(departure_records(spark, sf_dir), path)
    return read_landing(spark, path, S.DEPARTURE_RECORD)


# --- parsing and payloads ---------------------------------------------------
def parse_traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_values(to_lines(X.traffic_documents(spark, sf_dir)), S.TRAFFIC_DOCUMENT)
    speeds = F.aggregate("samples", F.lit(0), lambda acc, s: acc + F.coalesce(s["current_speed"], F.lit(0)))
    return parsed.select(*META, F.size("samples").alias("sample_count"), speeds.alias("speed_sum"))


def parse_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_values(to_lines(X.weather_documents(spark, sf_dir)), S.WEATHER_DOCUMENT)
    warmest = F.array_max(F.transform("samples", lambda s: s["temp"]))
    return parsed.select(*META, F.size("samples").alias("sample_count"), warmest.alias("max_temp"))


def parse_transit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_values(to_lines(departure_records(spark, sf_dir)), S.DEPARTURE_RECORD)


def explode_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode_samples(parse_values(to_lines(X.traffic_documents(spark, sf_dir)), S.TRAFFIC_DOCUMENT))


def nest_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sample of every document, beside what its document says."""
    documents = nest_traffic(X.traffic(spark, sf_dir).select("event_id", *TRAFFIC_COLS), SCRAPE)
    each = documents.withColumn("sample_count", F.size("samples")).withColumn("s", F.explode("samples"))
    return each.select(
        *SCRAPE, "meta_type", "grid_size", "average_congestion_ratio", "status_label", "part", "part_count",
        "sample_count", *[F.col(f"s.{c}") for c in TRAFFIC_COLS[2:]],
    )


def weather_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sample of every document; a scrape is split into three."""
    documents = nest_weather(X.weather(spark, sf_dir).select("event_id", *WEATHER_COLS), SCRAPE, parts=3)
    each = documents.withColumn("s", F.explode("samples"))
    return each.select(*SCRAPE, "meta_type", "grid_size", "part_count", *[F.col(f"s.{c}") for c in WEATHER_COLS[2:]])


def normalise_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat rows, half of them with the short cell id, zeros for unanswered probes."""
    short = F.when(F.col("event_id") % 2 == 0, F.expr("substr(grid_id, 6)")).otherwise(F.col("grid_id"))
    unanswered = {"current_speed": 0, "free_flow_speed": 0, "congestion_ratio": 1.0, "confidence": 0.0}
    flat = X.traffic(spark, sf_dir).withColumn("grid_id", short).fillna(unanswered)
    return payloads.normalise_flat(flat).select(*TRAFFIC_COLS)


def payload_traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payloads.traffic_samples(X.traffic_responses(spark, sf_dir))


def payload_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payloads.weather_samples(X.weather_responses(spark, sf_dir))


def payload_transit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payloads.departures(X.departure_responses(spark, sf_dir))


def congestion_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratio, rounded ratio and status of every event's pair of numbers."""
    current = F.floor("value").cast("int")
    free = (F.col("event_id") % 120).cast("int")
    return X.events(spark, sf_dir).select(
        "event_id",
        congestion_ratio(current, free).alias("congestion_ratio"),
        traffic_status(speed_ratio(current, free)).alias("status_label"),
    )


def grid_of_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid_points(X.boxes(spark, sf_dir))


# --- flat tables ------------------------------------------------------------
def _silver_stream(
    spark: SparkSession, lines: DataFrame, source: silver.Source, columns: tuple[str, ...]
) -> DataFrame:
    """Values -> flat table, in several micro-batches, the second run finding nothing new."""
    topic = X.write_topic(lines, fresh_path(spark, "topic"))
    table, checkpoint, quarantine = (fresh_path(spark, label) for label in ("silver", "checkpoint", "quarantine"))
    for _ in range(2):
        stream = spark.readStream.option("maxFilesPerTrigger", 2).text(topic)
        silver.drain_all([(stream, silver.BatchWriter(source, table, quarantine), checkpoint)])
    return silver.read_silver(spark, table, source).select(*columns)


def silver_traffic_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver_stream(spark, to_lines(X.traffic_documents(spark, sf_dir)), silver.TRAFFIC, TRAFFIC_COLS)


def silver_weather_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver_stream(spark, to_lines(X.weather_documents(spark, sf_dir)), silver.WEATHER, WEATHER_COLS)


def silver_transit_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver_stream(spark, to_lines(departure_records(spark, sf_dir)), silver.TRANSIT, TRANSIT_COLS)


def silver_partition_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """City-partitioned write and read; cities are numbers here and must stay text."""
    numbered = X.transit(spark, sf_dir).withColumn("meta_city", F.length("meta_city").cast("string"))
    path = fresh_path(spark, "by-city")
    write_by_city(stamp(numbered.select(*TRANSIT_COLS)), path)
    return read_table(spark, path, S.SILVER_TRANSIT).select(*TRANSIT_COLS)


def silver_replay_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same micro-batch written twice leaves its rows once; another checkpoint's batches add to them.

    Half of the departures come in a batch that is replayed, the others from two streams with a
    checkpoint each, both of which begin with batch 0. All of them lie there once more from an attempt that was
    never committed.
    """
    records = X.transit(spark, sf_dir)
    path, quarantine = fresh_path(spark, "replay"), fresh_path(spark, "quarantine")
    write = silver.BatchWriter(silver.TRANSIT, path, quarantine, adopt=True)
    for _ in range(2):
        write(to_lines(records.filter("event_id % 2 = 0").select(*TRANSIT_COLS)), 0)
    for rest in (1, 3):
        part = records.filter(f"event_id % 4 = {rest}").select(*TRANSIT_COLS)
        topic = X.write_topic(to_lines(part), fresh_path(spark, "topic"), files=1)
        silver.drain_all([(spark.readStream.text(topic), write, fresh_path(spark, "checkpoint"))])
    stray = f"{path}/batch={commits.attempt_of('batch-direct-1')}"
    write_by_city(stamp(records.select(*TRANSIT_COLS)), stray, partition_by=silver.LAYOUT)
    return silver.read_silver(spark, path, silver.TRANSIT).select(*TRANSIT_COLS)


def silver_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches, a compaction of all days they share, a fourth batch, what no longer counts cleared away."""
    records = X.transit(spark, sf_dir)
    path, quarantine = fresh_path(spark, "compacted"), fresh_path(spark, "quarantine")
    write = silver.BatchWriter(silver.TRANSIT, path, quarantine)
    for part in range(4):
        if part == 3:
            silver.compact(spark, path, silver.TRANSIT)
            commits.clear(spark, path, "batch", timedelta(0))
        write(to_lines(records.filter(f"event_id % 4 = {part}").select(*TRANSIT_COLS)), part)
    return silver.read_silver(spark, path, silver.TRANSIT).select(*TRANSIT_COLS)


def silver_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some days of a flat table, read by the log's index of days."""
    path, quarantine = fresh_path(spark, "span"), fresh_path(spark, "quarantine")
    silver.BatchWriter(silver.TRANSIT, path, quarantine)(to_lines(departure_records(spark, sf_dir)), 0)
    days = date(2024, 1, 10), date(2024, 1, 19)
    return silver.read_silver(spark, path, silver.TRANSIT, *days).select(*TRANSIT_COLS)


def silver_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Departures without a time, with a time far ahead, without a city, and broken: by reason, and the good ones."""
    path, quarantine = fresh_path(spark, "silver"), fresh_path(spark, "quarantine")
    silver.BatchWriter(silver.TRANSIT, path, quarantine)(X.faulty_departures(spark, sf_dir), 0)
    bad = read_table(spark, quarantine, "value STRING, reason STRING").select("reason")
    good = silver.read_silver(spark, path, silver.TRANSIT).select(F.lit("none").alias("reason"))
    return bad.unionByName(good).groupBy("reason").agg(F.count("*").alias("values"))


def silver_retried(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faulty departures, taken once more with those that were sent twice in one value cut in half: as in silver_quarantine."""
    path, quarantine = fresh_path(spark, "silver"), fresh_path(spark, "quarantine")
    write = silver.BatchWriter(silver.TRANSIT, path, quarantine)
    write(X.faulty_departures(spark, sf_dir), 0)
    once = "IF(reason = 'malformed', left(value, length(value) DIV 2), value) AS value"
    write.retry(spark, lambda values: values.selectExpr(once))
    bad = silver.read_quarantine(spark, path, quarantine).select("reason")
    good = silver.read_silver(spark, path, silver.TRANSIT).select(F.lit("none").alias("reason"))
    return bad.unionByName(good).groupBy("reason").agg(F.count("*").alias("values"))


# --- buckets and features ---------------------------------------------------
def _bucketed(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    return [with_bucket(df) for df in X.sources(spark, sf_dir)]


def bucket_30min(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Buckets straight from the text time."""
    rows = X.traffic(spark, sf_dir).select("event_id", *META, "grid_id")
    return with_bucket(rows).select("event_id", "meta_city", "grid_id", "ts", "time_bucket")


def bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bucket_bounds(*X.sources(spark, sf_dir))


def _lake(spark: SparkSession, sf_dir: str, after_each: Callable[[str], object] = lambda _: None) -> str:
    """Flat tables written as two micro-batches a source, the second one with the rows behind the cut."""
    lake = fresh_path(spark, "lake")
    records = {
        "traffic": X.traffic_documents(spark, sf_dir),
        "weather": X.weather_documents(spark, sf_dir),
        "transit": X.spread(departure_records(spark, sf_dir)),
    }
    for number, half in enumerate((_before_cut, _after_cut)):
        for name, source in SOURCES.items():
            timed = records[name].withColumn("ts", F.col("meta_scraped_at").cast("timestamp_ntz"))
            part = to_lines(half(timed).drop("ts"))
            silver.BatchWriter(source, f"{lake}/silver/{name}", f"{lake}/quarantine/{name}")(part, number)
        after_each(lake)
    return lake


def bounds_committed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same bounds from the commits of the flat tables."""
    lake = _lake(spark, sf_dir)
    return committed_totals(spark, {name: f"{lake}/silver/{name}" for name in SOURCES})


def calendar_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = with_calendar(with_bucket(X.transit(spark, sf_dir)))
    return keys.select("event_id", "time_bucket", "hour_of_day", "day_of_week")


def transit_mode_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_mode(X.transit(spark, sf_dir)).select("event_id", "line", "mode")


def transit_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transit_stats(with_bucket(X.transit(spark, sf_dir)))


def traffic_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traffic_pivot(with_bucket(X.traffic(spark, sf_dir)))


def weather_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weather_pivot(with_bucket(X.weather(spark, sf_dir)))


def key_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return master_keys(*_bucketed(spark, sf_dir))


def city_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return city_congestion_index(X.traffic(spark, sf_dir), SCRAPE)


def cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Traffic scrapes are split over four documents, weather scrapes are whole."""
    traffic = nest_traffic(X.traffic(spark, sf_dir).select("event_id", *TRAFFIC_COLS), SCRAPE, parts=4)
    weather = nest_weather(X.weather(spark, sf_dir).select("event_id", *WEATHER_COLS), SCRAPE)
    return cycle_summary(traffic, weather, departure_records(spark, sf_dir), keys=SCRAPE)


# --- wide table -------------------------------------------------------------
def _with_strays(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    traffic, weather, transit = X.sources(spark, sf_dir)
    return [X.with_strays(traffic), weather, transit]


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_wide(*_with_strays(spark, sf_dir))


def wide_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_wide_join(*_with_strays(spark, sf_dir))


def gold_closed_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return closed_buckets(*X.sources(spark, sf_dir))[1]


def _before_cut(df: DataFrame) -> DataFrame:
    return df.filter(F.col("ts") < F.lit(X.CUT).cast("timestamp_ntz"))


def _after_cut(df: DataFrame) -> DataFrame:
    return df.filter(F.col("ts") >= F.lit(X.CUT).cast("timestamp_ntz"))


def gold_incremental_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run up to the cut, one over all buckets that fails before its commit, a run over everything, and one that finds nothing new."""
    path = fresh_path(spark, "gold")
    all_rows = X.sources(spark, sf_dir)
    floor = append_increment(spark, *[_before_cut(df) for df in all_rows], gold_path=path).floor
    _, stray = closed_buckets(*all_rows, floor, flush=True)
    write_run(stray, path, commits.attempt_of(run_after(floor)))
    append_increment(spark, *all_rows, gold_path=path)
    append_increment(spark, *all_rows, gold_path=path)
    return read_gold(spark, path).select(*S.wide_columns())


def gold_scheduled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scheduled job after each of two micro-batches a source, and once more: bounds from the commits."""
    lake = _lake(spark, sf_dir, lambda lake: gold_job(spark, lake))
    gold_job(spark, lake)
    return read_gold(spark, f"{lake}/gold").select(*S.wide_columns())


def gold_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run up to the cut and one over everything, brought into one folder a day."""
    path = fresh_path(spark, "gold")
    all_rows = X.sources(spark, sf_dir)
    append_increment(spark, *[_before_cut(df) for df in all_rows], gold_path=path)
    append_increment(spark, *all_rows, gold_path=path)
    compact_gold(spark, path)
    commits.clear(spark, path, "run", timedelta(0))
    return read_gold(spark, path).select(*S.wide_columns())


def gold_late_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Departures before the cut arrive after their buckets were written, and stay out."""
    path = fresh_path(spark, "gold-late")
    traffic, weather, transit = X.sources(spark, sf_dir)
    on_time = [_before_cut(traffic), _before_cut(weather), transit.filter(F.lit(False))]
    append_increment(spark, *on_time, gold_path=path)
    append_increment(spark, traffic, weather, transit, gold_path=path)
    return read_gold(spark, path).select(*S.wide_columns())


def gold_amended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Departures come after their buckets were written, and change them; the first two runs' sums are compacted."""
    path = fresh_path(spark, "sums")
    traffic, weather, transit = X.sources(spark, sf_dir)
    amend.add_sums(spark, path, _before_cut(traffic), _before_cut(weather), transit.limit(0))
    amend.add_sums(spark, path, _after_cut(traffic), _after_cut(weather), transit.filter("event_id % 2 = 0"))
    amend.compact_sums(spark, path)
    amend.add_sums(spark, path, traffic.limit(0), weather.limit(0), transit.filter("event_id % 2 = 1"))
    return amend.read_amended(spark, path).select(*S.wide_columns())


def _rolled_up(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Paths of sums and their roll-up, brought up to date after the first rows and after all."""
    path, rollup = fresh_path(spark, "sums"), fresh_path(spark, "rollup")
    traffic, weather, transit = _with_strays(spark, sf_dir)
    amend.add_sums(spark, path, _before_cut(traffic), weather.limit(0), transit)
    amend.maintain(spark, path, rollup)
    amend.add_sums(spark, path, _after_cut(traffic), weather, transit.limit(0))
    amend.maintain(spark, path, rollup)
    return path, rollup


def rollup_hourly_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return amend.hourly_patterns(spark, *_rolled_up(spark, sf_dir), datetime.fromisoformat(X.AS_OF))


def rollup_heatmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return amend.heatmap(spark, _rolled_up(spark, sf_dir)[1])


def stream_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide table from three streams of flat rows."""
    streams = []
    for name, df in zip(("traffic", "weather", "transit"), _with_strays(spark, sf_dir)):
        path = fresh_path(spark, f"flat-{name}")
        df.write.parquet(path)
        streams.append(spark.readStream.schema(df.schema).parquet(path))
    out, checkpoint = fresh_path(spark, "gold-stream"), fresh_path(spark, "checkpoint")
    gold_streaming.write_gold_stream(
        gold_streaming.gold_stream(*streams), out, checkpoint
    ).awaitTermination()
    return read_table(spark, out, S.wide_schema())


def publish_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish the stored table of what closed before the cut, then the rest, then nothing."""
    target, path = ParquetServing(spark, fresh_path(spark, "serving")), fresh_path(spark, "gold")
    all_rows = X.sources(spark, sf_dir)
    append_increment(spark, *[_before_cut(df) for df in all_rows], gold_path=path)
    publish(read_gold(spark, path), target)
    append_increment(spark, *all_rows, gold_path=path)
    publish(read_gold(spark, path), target)
    publish(read_gold(spark, path), target)
    return target.read().select(*S.wide_columns())


# --- reports ----------------------------------------------------------------
def report(function: Callable[..., DataFrame], *args, **kwargs) -> Query:
    return lambda spark, sf_dir: function(wide(spark, sf_dir), *args, **kwargs)


def stored_report(function: Callable[..., DataFrame], *args, **kwargs) -> Query:
    """A report over the wide table as it is stored, by date; every bucket is closed."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = fresh_path(spark, "gold")
        append_increment(spark, *_with_strays(spark, sf_dir), gold_path=path, flush=True)
        return function(read_gold(spark, path), *args, **kwargs)

    return query


QUERIES: dict[str, Query] = {
    "bronze_route": bronze_route,
    "bronze_provenance": bronze_provenance,
    "bronze_dead_letter": bronze_dead_letter,
    "landing_json_roundtrip": landing_json_roundtrip,
    "parse_traffic": parse_traffic,
    "parse_weather": parse_weather,
    "parse_transit": parse_transit,
    "explode_samples": explode_documents,
    "nest_samples": nest_samples,
    "nest_weather": weather_nested,
    "normalise_flat": normalise_flat,
    "payload_traffic": payload_traffic,
    "payload_weather": payload_weather,
    "payload_transit": payload_transit,
    "congestion_ratio": congestion_ratios,
    "grid_points": grid_of_boxes,
    "silver_traffic_stream": silver_traffic_stream,
    "silver_weather_stream": silver_weather_stream,
    "silver_transit_stream": silver_transit_stream,
    "silver_partition_roundtrip": silver_partition_roundtrip,
    "silver_replay_idempotent": silver_replay_idempotent,
    "silver_quarantine": silver_quarantine,
    "silver_retried": silver_retried,
    "silver_compacted": silver_compacted,
    "silver_span": silver_span,
    "bucket_30min": bucket_30min,
    "bucket_bounds": bounds,
    "bucket_bounds_committed": bounds_committed,
    "calendar_features": calendar_features,
    "transit_mode_split": transit_mode_split,
    "transit_stats": transit_features,
    "traffic_pivot": traffic_features,
    "weather_pivot": weather_features,
    "master_keys": key_spine,
    "gold_wide_join": wide_join,
    "gold_wide": wide,
    "gold_closed_buckets": gold_closed_buckets,
    "gold_incremental_two_runs": gold_incremental_two_runs,
    "gold_scheduled": gold_scheduled,
    "gold_compacted": gold_compacted,
    "gold_amended": gold_amended,
    "gold_late_data": gold_late_data,
    "gold_stream": stream_gold,
    "publish_incremental": publish_incremental,
    "city_congestion_index": city_index,
    "cycle_summary": cycles,
    "q_congestion_by_hour": report(analytics.congestion_by_hour),
    "q_temp_over_time": stored_report(analytics.temp_over_time, "2024-01-01", X.AS_OF),
    "q_speed_over_time": stored_report(analytics.speed_over_time, "2024-01-01", X.AS_OF),
    "q_congestion_over_time": stored_report(analytics.congestion_over_time, "2024-01-01", X.AS_OF),
    "q_congestion_avg": stored_report(analytics.congestion_avg, X.AS_OF),
    "q_rail_stress": stored_report(analytics.rail_stress, X.AS_OF),
    "q_weather_vs_traffic": stored_report(analytics.weather_vs_traffic, X.AS_OF),
    "q_rain_correlation": stored_report(analytics.rain_congestion_correlation, X.AS_OF, "30 days"),
    "q_bus_vs_rail": stored_report(analytics.bus_vs_rail, X.AS_OF),
    "q_hourly_patterns": stored_report(analytics.hourly_patterns, X.AS_OF),
    "rollup_hourly_patterns": rollup_hourly_patterns,
    "rollup_heatmap": rollup_heatmap,
    "q_first_rows": report(analytics.first_rows),
    "q_row_count": report(analytics.row_count),
    "q_city_rows": report(analytics.city_rows, "Hamburg"),
    "q_heatmap": report(analytics.heatmap),
    "q_city_comparison": report(analytics.city_comparison),
    "q_peak_hours": report(analytics.peak_hours),
    "q_delay_trend": report(analytics.delay_trend),
}


def queries() -> dict[str, Query]:
    return {name: rounded(query) for name, query in QUERIES.items()}
