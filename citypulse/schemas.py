"""Record layouts and the fixed values every stage shares."""

from __future__ import annotations

# --- fixed values -----------------------------------------------------------
# Cities and their bounding boxes, "minLon,minLat,maxLon,maxLat".
CITY_BBOXES = {
    "Hamburg": "9.725,53.395,10.325,53.695",
    "Berlin": "13.088,52.338,13.761,52.675",
    "Frankfurt": "8.480,50.000,8.800,50.230",
    "Munich": "11.360,48.060,11.722,48.248",
    "Cologne": "6.772,50.830,7.162,51.085",
}
# Landing folder -> topic, and source -> landing folder.
FOLDER_TOPICS = {"TomTom": "raw-traffic", "OWM": "raw-weather", "DB": "raw-db"}
SOURCE_FOLDERS = {"traffic": "TomTom", "weather": "OWM", "transit": "DB"}
# Cells per side of a city's sampling grid.
GRID_SIZE = 3
# Document types written by the collectors.
TRAFFIC_META_TYPE = "tomtom_grid_flow"
WEATHER_META_TYPE = "owm_grid_weather"
# A line whose name contains one of these runs on the road, any other on rails.
ROAD_MARKERS = ("Bus", "STR")
# A departure counts as stressed when it is later than this many seconds.
STRESS_SECONDS = 300
# Samples count towards the city index above this confidence.
MIN_CONFIDENCE = 0.5
# Upper ends (exclusive) of the city status bands; at or above both: flowing.
CONGESTED_BELOW = 0.7
HEAVY_BELOW = 0.85
# Width of a feature bucket and of one collection cycle.
BUCKET_WIDTH = "30 minutes"
CYCLE_WIDTH = "10 minutes"
# Kafka records read per source and micro-batch.
MAX_OFFSETS = 2_000_000
# ----------------------------------------------------------------------------


def grid_ids(size: int = GRID_SIZE) -> list[str]:
    """Cell ids of a ``size`` x ``size`` grid, longitude index first."""
    return [f"grid_{i}_{j}" for i in range(size) for j in range(size)]


# Layouts are DDL strings: ``from_json`` and ``DataFrameReader.schema`` take them as is.
TRAFFIC_SAMPLE = (
    "grid_id STRING, lat DOUBLE, lon DOUBLE, current_speed INT, free_flow_speed INT, "
    "congestion_ratio DOUBLE, confidence DOUBLE"
)
WEATHER_SAMPLE = (
    "grid_id STRING, lat DOUBLE, lon DOUBLE, temp DOUBLE, humidity INT, wind_speed DOUBLE, "
    "rain_1h_mm DOUBLE, weather_main STRING, description STRING"
)
DEPARTURE_FIELDS = "line STRING, delay INT, direction STRING, planned_time STRING"
META = "meta_city STRING, meta_scraped_at STRING"


def _document(sample: str) -> str:
    fields = ", ".join(f.strip().replace(" ", ": ", 1) for f in sample.split(","))
    return f"{META}, samples ARRAY<STRUCT<{fields}>>"


TRAFFIC_DOCUMENT = _document(TRAFFIC_SAMPLE)
WEATHER_DOCUMENT = _document(WEATHER_SAMPLE)
DEPARTURE_RECORD = f"{META}, {DEPARTURE_FIELDS}"

# Flat tables. ``ts`` is the parsed scrape time; ``scraped_date`` is there because Parquet
# keeps usable statistics for DATE, so incremental runs skip old row groups by it.
STAMPS = "ts TIMESTAMP_NTZ, scraped_date DATE, ingestion_time TIMESTAMP"
SILVER_TRAFFIC = f"{META}, {TRAFFIC_SAMPLE}, {STAMPS}"
SILVER_WEATHER = f"{META}, {WEATHER_SAMPLE}, {STAMPS}"
SILVER_TRANSIT = f"{META}, {DEPARTURE_FIELDS}, {STAMPS}"


def wide_columns(cells: list[str] | None = None) -> list[str]:
    """Columns of the wide feature table, in order."""
    cells = cells or grid_ids()
    return (
        ["meta_city", "time_bucket"]
        + [f"{c}_{m}" for c in cells for m in ("congestion", "speed")]
        + [f"{c}_{m}" for c in cells for m in ("rain", "temp")]
        + ["rail_avg_delay", "rail_stress_index", "bus_avg_delay", "bus_stress_index"]
        + ["hour_of_day", "day_of_week"]
    )


def wide_schema(cells: list[str] | None = None) -> str:
    """DDL of the wide feature table: fixed, whatever ids a run happens to see."""
    types = {"meta_city": "STRING", "time_bucket": "TIMESTAMP_NTZ", "hour_of_day": "INT", "day_of_week": "INT"}
    return ", ".join(f"{c} {types.get(c, 'DOUBLE')}" for c in wide_columns(cells))
