"""Sample records for the checks, derived from all rows of the ``events`` table.

One event stands for one scrape of one city: a view or click is a traffic scrape, a signup a
weather scrape, a purchase or error a departure. A grid scrape has nine probes, some of which
came back empty (null readings). ``oracles`` states the same records in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citypulse import schemas as S
from citypulse.functions.scalars import congestion_ratio

CITIES = ("Hamburg", "Berlin", "Frankfurt", "Munich", "Cologne")
LINES = ("Bus 5", "STR 10", "S1", "U3", "bus 7")
CUT = "2024-01-15"
AS_OF = "2024-01-31 00:00:00"


EVENTS = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def _pick(values: tuple[str, ...], index: str) -> str:
    """SQL: value at an index, null past the end."""
    quoted = ", ".join(f"'{v}'" for v in values)
    return f"get(array({quoted}), CAST({index} AS INT))"


def _scrapes(spark: SparkSession, sf_dir: str, *types: str) -> DataFrame:
    return events(spark, sf_dir).filter(F.col("event_type").isin(*types)).selectExpr(
        "event_id",
        "user_id",
        "value",
        "ts",
        f"{_pick(CITIES, 'user_id % 5')} AS meta_city",
        f'date_format(ts, "{ISO}") AS meta_scraped_at',
    )


def _probes(scrapes: DataFrame) -> DataFrame:
    """Nine probes per scrape; ``k`` numbers a probe, ``answered`` says it has readings.

    ``cur`` and ``free`` are the speeds a traffic probe answers with.
    """
    cells = ", ".join(f"'{c}'" for c in S.grid_ids())
    return scrapes.selectExpr("*", f"posexplode(array({cells})) AS (n, grid_id)").selectExpr(
        "*",
        "CAST(48.0 + n * 0.25 AS DOUBLE) AS lat",
        "CAST(8.0 + n * 0.5 AS DOUBLE) AS lon",
        "event_id + n AS k",
        "(event_id + n) % 23 <> 0 AS answered",
        "CAST(floor(value) AS INT) + n AS cur",
        "IF((event_id + n) % 17 = 0, 0, CAST(20 + user_id % 100 AS INT)) AS free",
    )


PROBE = ("event_id", "meta_city", "meta_scraped_at", "grid_id", "lat", "lon")
STOP = ("event_id", "meta_city", "meta_scraped_at")


def traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat traffic rows."""
    ratio = congestion_ratio(F.col("cur"), F.col("free"))
    return _probes(_scrapes(spark, sf_dir, "view", "click")).select(
        *PROBE,
        "ts",
        F.expr("IF(answered, cur, NULL) AS current_speed"),
        F.expr("IF(answered, free, NULL) AS free_flow_speed"),
        F.when(F.col("answered"), ratio).alias("congestion_ratio"),
        F.expr("IF(answered, CAST(k % 10 AS DOUBLE) / 10, NULL) AS confidence"),
    )


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat weather rows."""
    return _probes(_scrapes(spark, sf_dir, "signup")).selectExpr(
        *PROBE,
        "ts",
        "IF(answered, value / 10 + n, NULL) AS temp",
        "IF(answered, CAST(40 + k % 60 AS INT), NULL) AS humidity",
        "IF(answered, CAST(k % 30 AS DOUBLE) / 2, NULL) AS wind_speed",
        "IF(answered, IF(k % 4 = 0, value / 100, 0D), NULL) AS rain_1h_mm",
        "IF(answered, IF(k % 4 = 0, 'Rain', 'Clear'), NULL) AS weather_main",
        "IF(answered, IF(k % 4 = 0, 'light rain', 'clear sky'), NULL) AS description",
    )


def transit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat departures. Lines and delays are null at times, and one "bus" is in lower case."""
    return _scrapes(spark, sf_dir, "purchase", "error").selectExpr(
        *STOP,
        "ts",
        f"{_pick(LINES, 'event_id % 6')} AS line",
        "IF(event_id % 13 <> 0, CAST(floor(value * 5) AS INT), NULL) AS delay",
        f"concat('to ', {_pick(CITIES, 'event_id % 5')}) AS direction",
        "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\") AS planned_time",
    )


def spread(rows: DataFrame) -> DataFrame:
    """The rows dealt out evenly. Few file splits hold many events, and each event grows into a whole document."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _documents(spark: SparkSession, sf_dir: str, types: tuple[str, ...], sample: dict[str, str]) -> DataFrame:
    """One nested document per scrape, with the nine probes ``n`` as its samples."""
    cells = ", ".join(f"'{c}'" for c in S.grid_ids())
    fields = {"grid_id": f"get(array({cells}), n)", "lat": "48D + n * 0.25D", "lon": "8D + n * 0.5D"}
    fields |= {name: f"IF((event_id + n) % 23 <> 0, {value}, NULL)" for name, value in sample.items()}
    struct = ", ".join(f"'{name}', {value}" for name, value in fields.items())
    return spread(_scrapes(spark, sf_dir, *types)).selectExpr(
        "meta_city", "meta_scraped_at", f"transform(sequence(0, 8), n -> named_struct({struct})) AS samples"
    )


def traffic_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of ``traffic`` as the collector nests them."""
    cur = "(CAST(floor(value) AS INT) + n)"
    free = "IF((event_id + n) % 17 = 0, 0, CAST(20 + user_id % 100 AS INT))"
    sample = {
        "current_speed": cur,
        "free_flow_speed": free,
        "congestion_ratio": f"IF({free} > 0, rint(try_divide(CAST({cur} AS DOUBLE), {free}) * 100) / 100, 1D)",
        "confidence": "CAST((event_id + n) % 10 AS DOUBLE) / 10",
    }
    return _documents(spark, sf_dir, ("view", "click"), sample)


def weather_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of ``weather`` as the collector nests them."""
    wet = "(event_id + n) % 4 = 0"
    sample = {
        "temp": "value / 10 + n",
        "humidity": "CAST(40 + (event_id + n) % 60 AS INT)",
        "wind_speed": "CAST((event_id + n) % 30 AS DOUBLE) / 2",
        "rain_1h_mm": f"IF({wet}, value / 100, 0D)",
        "weather_main": f"IF({wet}, 'Rain', 'Clear')",
        "description": f"IF({wet}, 'light rain', 'clear sky')",
    }
    return _documents(spark, sf_dir, ("signup",), sample)


def with_strays(traffic_rows: DataFrame) -> DataFrame:
    """The rows, and some of them again under ids that are no cells: names of modes, a foreign cell."""
    stray = "CASE event_id % 3 WHEN 0 THEN 'bus' WHEN 1 THEN 'rail' ELSE 'grid_9_9' END"
    strays = traffic_rows.filter("event_id % 5 = 0 AND grid_id = 'grid_0_0'").withColumn("grid_id", F.expr(stray))
    return traffic_rows.unionByName(strays)


def sources(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return traffic(spark, sf_dir), weather(spark, sf_dir), transit(spark, sf_dir)


# --- API responses ----------------------------------------------------------
def traffic_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses to traffic probes; an unanswered one has an error object instead, or was cut off."""
    flow = """to_json(named_struct('flowSegmentData', named_struct(
        'currentSpeed', cur, 'freeFlowSpeed', free, 'confidence', CAST(k % 10 AS DOUBLE) / 10)))"""
    error = f"""IF(k % 2 = 0, '{{"error":"Point too far from road"}}', left({flow}, length({flow}) - 2))"""
    return _probes(_scrapes(spark, sf_dir, "view", "click")).selectExpr(
        *PROBE, f"IF(answered, {flow}, {error}) AS payload"
    )


def weather_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses to weather probes: without a rain entry when dry, absent or broken when unanswered."""
    body = """to_json(named_struct(
        'main', named_struct('temp', value / 10 + n, 'humidity', 40 + k % 60),
        'weather', array(named_struct(
            'main', IF(k % 4 = 0, 'Rain', 'Clear'), 'description', IF(k % 4 = 0, 'light rain', 'clear sky'))),
        'wind', named_struct('speed', CAST(k % 30 AS DOUBLE) / 2),
        'rain', IF(k % 4 = 0, named_struct('1h', value / 100), NULL),
        'visibility', 1000 + k % 9000))"""
    return _probes(_scrapes(spark, sf_dir, "signup")).selectExpr(
        *PROBE,
        f"""CASE WHEN answered THEN {body} WHEN k % 3 = 0 THEN NULL
              WHEN k % 3 = 1 THEN left({body}, length({body}) - 3) ELSE '{{"cod":500,"message":"x"' END AS payload""",
    )


def departure_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses with two departures: one as in ``transit``, one without a delay and a line.

    Every other response is a bare array instead of an object. Some were cut off.
    """
    first = """concat('{"line":', IF(line IS NULL, 'null', concat('{"name":"', line, '"}')),
        ',"direction":"', direction, '","plannedWhen":"', planned_time, '","delay":', coalesce(delay, 'null'),
        ',"platform":"', event_id % 12, '","tripId":"t', event_id, '"}')"""
    second = """concat('{"direction":"depot","tripId":"u', event_id, '"}')"""
    array = f"concat('[', {first}, ',', {second}, ']')"
    return (
        transit(spark, sf_dir)
        .withColumn("delay", F.col("delay").cast("string"))
        .selectExpr(*STOP, "event_id AS id", f"{array} AS entries")
        .selectExpr(*STOP, "id", "IF(id % 2 = 0, concat('{\"departures\":', entries, '}'), entries) AS whole")
        .selectExpr(*STOP, "IF(id % 29 = 0, left(whole, length(whole) - 3), whole) AS payload")
    )


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One text line per event: objects, some with a tab behind; arrays, scalars, ``null``, cut-off
    objects, plain text; two objects, text or a comma behind an object.
    """
    return events(spark, sf_dir).selectExpr(
        "event_id",
        """CASE event_type
             WHEN 'view' THEN IF(event_id % 4 = 0, concat(props, chr(9)), props)
             WHEN 'click' THEN CASE event_id % 5
               WHEN 0 THEN concat(props, props) WHEN 1 THEN concat(props, ' x}') WHEN 2 THEN concat(props, ',}')
               WHEN 3 THEN concat(props, ',') ELSE concat('[', props, ']') END
             WHEN 'signup' THEN CAST(event_id AS STRING)
             WHEN 'purchase' THEN left(props, length(props) - 1)
             ELSE IF(user_id % 2 = 0, 'null', concat('not json ', event_id)) END AS value""",
    )


def faulty_departures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Departures as JSON values: some without a time, far ahead, without a city, or with text behind."""
    at = """CASE event_id % 10 WHEN 0 THEN 'x' WHEN 1 THEN NULL WHEN 2 THEN '2999-01-01T00:00:00' ELSE meta_scraped_at END"""
    record = f"""to_json(named_struct('meta_city', IF(event_id % 10 = 3, NULL, meta_city), 'meta_scraped_at', {at},
        'line', line, 'delay', delay))"""
    return transit(spark, sf_dir).selectExpr(f"IF(event_id % 10 = 4, concat({record}, {record}), {record}) AS value")


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bounding box per event, some malformed."""
    return events(spark, sf_dir).selectExpr("event_id", "user_id % 170 AS west", "user_id % 80 AS south").selectExpr(
        "event_id",
        """CASE WHEN event_id % 11 = 0 THEN 'a,b,c,d' ELSE concat_ws(',',
             concat(west, '.', lpad(event_id % 1000, 3, '0')), concat(south, '.5'), concat(west + 1, '.25'),
             IF(event_id % 7 = 0, NULL, concat(south + 2, '.', lpad(event_id % 100, 2, '0')))) END AS bbox""",
    )


# --- files ------------------------------------------------------------------
def make_old(spark: SparkSession, path: str, days: int = 400) -> None:
    """Set the times of all files of a folder back, as those of restored files are."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files = store.listFiles(folder, True)
    while files.hasNext():
        file = files.next()
        store.setTimes(file.getPath(), file.getModificationTime() - days * 86_400_000, -1)


def write_topic(lines: DataFrame, path: str, files: int = 4) -> str:
    """Stand-in for a topic: text files with one value per line, several micro-batches' worth."""
    lines.select("value").repartition(files).write.text(path)
    return path
