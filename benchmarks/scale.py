"""Skewed data at two sizes: one hot city, one hot half hour.

    python -m benchmarks.scale --copies 10 40 --sf 0.1

Every event is repeated ``copies`` times. A third of all rows goes to one city and a third to
one half hour. At each size the tables are written by the library's own writer to the shared
folder; the wide table is built from them with both plans and the results are compared; samples are
nested into documents and counted per cycle, and written as flat tables from their JSON. The last
line has each time's growth as a power of the number of rows.
"""

from __future__ import annotations

import argparse
import json
import math
import statistics
import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures as X
from checks.compare import TESTDATA
from citypulse import schemas as S
from citypulse.functions.scalars import round_half_even
from citypulse.operators.city_index import cycle_summary
from citypulse.operators.nesting import nest_traffic, nest_weather, to_lines
from citypulse.operators.parsing import stamp
from citypulse.plans.gold import gold_wide, gold_wide_join
from citypulse.session import fresh_path
from citypulse.sources.tables import read_table, write_by_city
from citypulse.streaming import silver

HOT_CITY, HOT_TIME = "Hamburg", "2024-01-10T08:"
PARTS = 64


def session(cpus: int) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(4 * cpus))
        .config("spark.sql.session.timeZone", "UTC")
        # As small against the data as the default is at full size, so that the hot city splits.
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4m")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def skewed(df: DataFrame, copies: int) -> DataFrame:
    copy = F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
    draw: Column = F.pmod(F.xxhash64("event_id", "copy"), F.lit(3))
    minute = F.lpad((F.col("event_id") % 30).cast("string"), 2, "0")
    return (
        df.drop("ts")
        .withColumn("copy", copy)
        .withColumn("draw", draw)
        .withColumn("meta_city", F.when(F.col("draw") == 0, HOT_CITY).otherwise(F.col("meta_city")))
        .withColumn(
            "meta_scraped_at",
            F.when(F.col("draw") == 1, F.concat(F.lit(HOT_TIME), minute, F.lit(":00"))).otherwise(
                F.col("meta_scraped_at")
            ),
        )
        .drop("event_id", "copy", "draw")
    )


def timed(work: Callable[[], DataFrame | None], runs: int = 3) -> float:
    times = []
    for _ in range(runs + 1):
        start = time.perf_counter()
        df = work()
        if df is not None:
            df.write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times[1:]), 2)


def measure(spark: SparkSession, sf: str, copies: int, cpus: int) -> dict[str, object]:
    out: dict[str, object] = {"copies": copies, "sf": float(sf)}
    tables = []
    schemas = (S.SILVER_TRAFFIC, S.SILVER_WEATHER, S.SILVER_TRANSIT)
    for name, df, schema in zip(("traffic", "weather", "transit"), X.sources(spark, f"{TESTDATA}/sf{sf}"), schemas):
        path = fresh_path(spark, f"scale-{name}")
        write_by_city(stamp(skewed(df.repartition(cpus), copies)), path)
        table = read_table(spark, path, schema)
        out[f"{name}_rows"] = table.count()
        out[f"{name}_files"] = len(table.inputFiles())
        tables.append(table)
    out["gold_wide_sec"] = timed(lambda: gold_wide(*tables))
    out["gold_wide_join_sec"] = timed(lambda: gold_wide_join(*tables))
    traffic, weather = (df.drop("ts", "scraped_date", "ingestion_time") for df in tables[:2])
    out["nest_samples_sec"] = timed(lambda: nest_traffic(traffic, parts=PARTS))
    paths = []
    for name, df in (("t", nest_traffic(traffic, parts=PARTS)), ("w", nest_weather(weather, parts=PARTS))):
        paths.append(fresh_path(spark, f"scale-docs-{name}"))
        df.write.parquet(paths[-1])
    nested = [spark.read.parquet(p) for p in paths]
    out["cycle_summary_sec"] = timed(lambda: cycle_summary(*nested, tables[2]))
    lines = fresh_path(spark, "scale-lines")
    to_lines(nested[0]).write.parquet(lines)

    def silver_write() -> None:
        writer = silver.BatchWriter(silver.TRAFFIC, fresh_path(spark, "scale-silver"), fresh_path(spark, "scale-bad"))
        writer(spark.read.parquet(lines), 0)

    out["silver_write_sec"] = timed(silver_write, runs=1)
    keys = ("meta_city", "time_bucket")
    close = [
        [c if c in keys else round_half_even(F.col(c).cast("double"), 6).alias(c) for c in df.columns]
        for df in (gold_wide(*tables), gold_wide_join(*tables))
    ]
    left, right = gold_wide(*tables).select(*close[0]), gold_wide_join(*tables).select(*close[1])
    out["rows_that_differ"] = left.exceptAll(right).count() + right.exceptAll(left).count()
    return out


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.1")
    parser.add_argument("--copies", type=int, nargs="+", default=[10, 40])
    parser.add_argument("--cpus", type=int, default=8)
    args = parser.parse_args()
    spark = session(args.cpus)
    found = [measure(spark, args.sf, copies, args.cpus) for copies in args.copies]
    for one in found:
        print(json.dumps(one), flush=True)
    for a, b in zip(found, found[1:]):
        more = math.log(b["traffic_rows"] / a["traffic_rows"])
        growth = {k.removesuffix("_sec"): round(math.log(b[k] / a[k]) / more, 2) for k in a if k.endswith("_sec")}
        print(json.dumps({"growth_as_power_of_rows": growth}), flush=True)


if __name__ == "__main__":
    main()
