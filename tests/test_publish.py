from __future__ import annotations

from datetime import datetime
from types import SimpleNamespace

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.sql import functions as F
from tests.test_gold import at, buckets, small

from citypulse import schemas as S
from citypulse import session
from citypulse.plans import analytics
from citypulse.plans import publish as publish_module
from citypulse.plans.gold import gold_wide
from citypulse.plans.publish import publish, unpublished
from citypulse.sources.serving import JdbcTable, ParquetServing

TIMES = ("2024-01-01T00:05:00", "2024-01-01T23:45:00", "2024-01-02T01:05:00")


def test_strictly_newer_rows_are_published(spark):
    gold = gold_wide(*small(spark, *TIMES))
    assert unpublished(gold, None).count() == 3
    assert buckets(unpublished(gold, at("2024-01-01T23:30:00"))) == ["2024-01-02 01:00:00"]


def test_parquet_serving_takes_each_bucket_once(spark, fresh):
    target = ParquetServing(spark, fresh("serving"))
    assert target.watermark() is None
    assert publish(gold_wide(*small(spark, *TIMES[:2])), target)
    assert publish(gold_wide(*small(spark, *TIMES)), target)
    assert not publish(gold_wide(*small(spark, *TIMES)), target)
    assert len(buckets(target.read())) == 3
    assert target.watermark() == at("2024-01-02T01:00:00")


def test_parquet_serving_survives_a_failure_before_the_marker(spark, fresh, monkeypatch):
    target = ParquetServing(spark, fresh("serving"))
    publish(gold_wide(*small(spark, *TIMES[:1])), target)

    def fail(*_):
        raise OSError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(ParquetServing, "commit", fail)
        with pytest.raises(OSError):
            publish(gold_wide(*small(spark, *TIMES[:2])), target)
    assert target.watermark() == at("2024-01-01T00:00:00")
    assert len(buckets(target.read())) == 1
    assert publish(gold_wide(*small(spark, *TIMES)), target)
    assert buckets(target.read()) == ["2024-01-01 00:00:00", "2024-01-01 23:30:00", "2024-01-02 01:00:00"]


def test_publication_computes_its_input_once_and_leaves_no_stage(spark, fresh, monkeypatch):
    staged = []
    real = publish_module.fresh_path
    monkeypatch.setattr(publish_module, "fresh_path", lambda *a: staged.append(real(*a)) or staged[-1])
    counted = spark.sparkContext.accumulator(0)

    def seen(batches):
        counted.add(1)
        yield from batches

    gold = gold_wide(*small(spark, *TIMES)).coalesce(1)
    assert publish(gold.mapInArrow(seen, gold.schema), ParquetServing(spark, fresh("serving")))
    assert counted.value == 1
    assert len(staged) == 1 and not session.exists(spark, staged[0])


class FakeJdbc:
    """Stands for a database: no such thing is started for a test. Tables are lists of rows."""

    def __init__(self, spark):
        self.spark, self.tables, self.calls, self.broken = spark, {}, [], None

    def table(self) -> JdbcTable:
        fake = self

        class Reader:
            def jdbc(self, url, query, properties):
                fake.calls.append((query, properties))
                name = query.split(" FROM ")[1].split(")")[0]
                if name not in fake.tables:
                    raise missing("42P01")
                column = query.split('"')[1]
                values = [r[column] for r in fake.tables[name]]
                return SimpleNamespace(first=lambda: (max(values, default=None),))

        class Session:
            read = Reader()

            def createDataFrame(self, *args):
                return fake.spark.createDataFrame(*args)

        return JdbcTable(Session(), "jdbc:x:", "features", {"user": "u"})


class FakeCause:
    def __init__(self, state, cause=None):
        self.state, self.cause = state, cause

    def getSQLState(self):
        return self.state

    def getCause(self):
        return self.cause


def missing(state: str) -> Py4JJavaError:
    error = Py4JJavaError.__new__(Py4JJavaError)
    Exception.__init__(error, "from the database")
    error.java_exception = FakeCause(None, FakeCause(state))
    error.exception_cmd = ""
    return error


@pytest.fixture
def database(spark, monkeypatch):
    fake = FakeJdbc(spark)
    frame = type(spark.range(1))
    original = frame.write

    def write(df):
        writer = original.__get__(df)

        class Writer:
            def __getattr__(self, name):
                return getattr(writer, name)

            def jdbc(self, url, table, mode, properties):
                assert (url, mode, properties) == ("jdbc:x:", "append", {"user": "u"})
                if fake.broken == table:
                    raise OSError("lost")
                fake.tables.setdefault(table, []).extend(r.asDict() for r in df.collect())

        return Writer()

    monkeypatch.setattr(frame, "write", property(write))
    return fake


def test_jdbc_watermark_is_computed_in_the_database_and_read_without_a_zone(database):
    target = database.table()
    assert target.watermark_query("newest", "features_runs") == '(SELECT MAX("newest") AS max_ts FROM features_runs) tmp'
    assert JdbcTable(None, "jdbc:none:", "features", quote="`").watermark_query("a", "b").count("`") == 2
    database.tables["features_runs"] = [{"newest": at("2024-01-01T00:30:00")}]
    assert target.watermark() == at("2024-01-01T00:30:00")
    assert database.calls[-1][1] == {"user": "u", "preferTimestampNTZ": "true"}
    assert target.properties == {"user": "u"}


def test_jdbc_first_publication_and_what_follows(spark, database):
    target = database.table()
    assert target.watermark() is None
    assert publish(gold_wide(*small(spark, *TIMES[:2])), target)
    assert publish(gold_wide(*small(spark, *TIMES)), target)
    assert not publish(gold_wide(*small(spark, *TIMES)), target)
    assert len(database.tables["features"]) == 3 and len(database.tables["features_runs"]) == 2


def test_jdbc_rows_of_a_failed_run_do_not_count(spark, database):
    target = database.table()
    publish(gold_wide(*small(spark, *TIMES[:1])), target)
    database.broken = "features_runs"
    with pytest.raises(OSError):
        publish(gold_wide(*small(spark, *TIMES[:2])), target)
    database.broken = None
    assert publish(gold_wide(*small(spark, *TIMES)), target)
    complete = {r["run"] for r in database.tables["features_runs"]}
    served = sorted(r["time_bucket"] for r in database.tables["features"] if r["run"] in complete)
    assert served == [at("2024-01-01T00:00:00"), at("2024-01-01T23:30:00"), at("2024-01-02T01:00:00")]
    assert len(database.tables["features"]) == 4
    assert target.visible_query() == 'SELECT * FROM features WHERE "run" IN (SELECT "run" FROM features_runs)'


def test_jdbc_table_without_markers_goes_on_from_its_rows(database):
    database.tables["features"] = [{"time_bucket": at("2024-01-01T00:30:00")}]
    assert database.table().watermark() == at("2024-01-01T00:30:00")


def test_any_other_database_error_is_no_first_publication(database, monkeypatch):
    monkeypatch.setitem(globals(), "missing", lambda _: denied)
    denied = missing.__globals__["Py4JJavaError"].__new__(Py4JJavaError)
    Exception.__init__(denied, "denied")
    denied.java_exception, denied.exception_cmd = FakeCause("28000"), ""
    with pytest.raises(Py4JJavaError):
        database.table().watermark()


def test_shared_folder_comes_from_the_session():
    class Conf(dict):
        def get(self, key, default=None):
            return dict.get(self, key, default)

    class Session:
        def __init__(self, **conf):
            self.conf = Conf({k.replace("__", "."): v for k, v in conf.items()})

    named = Session(**{"spark__checkpoint__dir": "hdfs://n/shared/", "spark__master": "yarn"})
    assert session.shared_folder(named) == "hdfs://n/shared"
    assert session.fresh_path(named, "x") != session.fresh_path(named, "x")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Session(**{"spark__master": "yarn"}))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Session(**{"spark__master": "local-cluster[2,1,1024]"}))
    assert "citypulse-" in session.shared_folder(Session(**{"spark__master": "local[2]"}))


def test_relative_reports_default_to_now(spark):
    gold = gold_wide(*small(spark, "2020-01-01T00:00:00", datetime.now().isoformat()))
    assert analytics.congestion_avg(gold).count() == 1
    assert analytics.rail_stress(gold, as_of="2020-01-01 12:00:00").count() == 2
    assert analytics.congestion_over_time(gold).count() == 1
    assert analytics.temp_over_time(gold, end="2020-01-01 12:00:00").count() == 1
    assert analytics.speed_over_time(gold, "2019-12-31", "2020-01-02").count() == 1


def test_strict_and_known_means(spark):
    gold = gold_wide(*small(spark, "2024-01-01T00:05:00"))
    assert gold.select(analytics.strict_mean(S.grid_ids(), "congestion")).first()[0] is None
    assert gold.select(analytics.known_mean(S.grid_ids(), "congestion")).first()[0] == 0.5
    by_hour = analytics.congestion_by_hour(gold).first()
    assert by_hour.hour == "0" and by_hour.avg_congestion == pytest.approx(0.5 / 9)


def test_city_rows_can_be_limited(spark):
    gold = gold_wide(*small(spark, *TIMES))
    assert analytics.city_rows(gold, "A").count() == 3
    assert [r.time_bucket for r in analytics.city_rows(gold, "A", 1).collect()] == [at("2024-01-01T00:00:00")]


def test_correlation_of_constant_values_is_null(spark):
    gold = gold_wide(*small(spark, *TIMES))
    got = analytics.rain_congestion_correlation(gold, as_of="2024-01-03 00:00:00")
    assert [(r.buckets, r.correlation) for r in got.collect()] == [(3, None)]
    rising = gold.withColumn("grid_0_0_rain", F.unix_timestamp(F.col("time_bucket").cast("timestamp")).cast("double"))
    moved = rising.withColumn("grid_0_0_congestion", F.col("grid_0_0_rain") * -2)
    assert analytics.rain_congestion_correlation(moved, as_of="2024-01-03 00:00:00").first().correlation == pytest.approx(-1)
