"""Session settings, CSV, profile, run tables, incremental log."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from duelist.operators import decision, profile
from duelist.plans import fixtures
from duelist.plans.periodic import report_by_period
from duelist.sources import session, tables
from duelist.sources.runs import RunTables
from duelist.streaming.scored_log import append_new, scored_rows


def test_object_store_settings_hold_no_credentials():
    conf = session.object_store_conf("https://store.example")
    assert conf["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert conf["spark.hadoop.fs.s3a.endpoint"] == "https://store.example"
    assert not [k for k in conf if "key" in k.lower() or "secret" in k.lower()]


def test_shared_dir_is_the_one_the_session_names(spark):
    assert session.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_engine_conf():
    assert session.engine_conf(400)["spark.sql.shuffle.partitions"] == "400"
    assert session.engine_conf()["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_transaction_columns():
    assert tables.TRANSACTION_COLUMNS[0] == "transaction_id" and tables.TRANSACTION_COLUMNS[-1] == "fraud"
    assert len(tables.TRANSACTION_COLUMNS) == 13


def test_csv(spark, sf_dir, folder):
    rows = fixtures.event_transactions(spark, sf_dir).select(*tables.TRANSACTION_COLUMNS)
    tables.write_csv(rows, folder)
    back = tables.read_csv(spark, folder, tables.TRANSACTION_SCHEMA)
    assert rows.exceptAll(back).count() == 0 and back.count() == rows.count()
    assert dict(tables.read_csv(spark, folder).dtypes)["fraud"] == "int"


def test_bad_csv(spark, folder):
    spark.createDataFrame([("a", "x")], "k string, n string").write.mode("overwrite").option("header", True).csv(folder)
    with pytest.raises(Exception, match="MALFORMED_RECORD|malformed"):
        tables.read_csv(spark, folder, "k string, n int").collect()
    assert tables.read_csv(spark, folder, "k string, n int", mode="PERMISSIVE").first()["n"] is None


def test_profile(spark):
    df = spark.createDataFrame([(1, None), (2, "b")], "n int, `odd$name` string")
    rows = {r["name"]: r for r in profile.column_profile(df).collect()}
    assert (rows["odd$name"]["nulls"], rows["odd$name"]["has_nulls"], rows["n"]["type"]) == (1, True, "int")
    assert profile.preview(df, "n", 1).first()["n"] == 1


def test_run_tables_start_empty(spark, folder):
    runs = RunTables(spark, f"{folder}/new")
    assert runs.read("metrics").count() == 0
    row = spark.createDataFrame([("r", "auc", 0.5, 0)], "run_id string, name string, value double, step int")
    runs.append("metrics", row.withColumn("logged_at", F.current_timestamp()))
    assert runs.read("metrics").first()["value"] == 0.5


def test_log_takes_every_row_once(spark, sf_dir, folder):
    """Two ticks with late rows in the second; the report is that of the whole table."""
    events = fixtures.table(spark, sf_dir, "events")
    source, log, checkpoint = (f"{folder}/{n}" for n in ("in", "log", "checkpoint"))
    models = fixtures.rule_models("event_id", "is_error")

    def tick():
        stream = spark.readStream.schema(events.schema).parquet(source)
        rows = stream.selectExpr("event_id", "ts", "cast(event_type = 'error' AS int) AS is_error")
        append_new(scored_rows(rows, "event_id", "ts", "is_error", *models), log, checkpoint)

    events.filter("event_id % 3 > 0").write.parquet(source)
    tick()
    events.filter("event_id % 3 = 0").write.mode("append").parquet(source)
    tick()
    tick()  # nothing new
    rows = spark.read.parquet(log)
    assert rows.count() == events.count()
    whole = report_by_period(fixtures.scored_events(spark, sf_dir), "ts", "is_error")
    columns = ["period_start", "champion_auc", "challenger_auc", "status", "winner"]
    incremental = decision.ab_report(rows, "is_error", ["period_start"])
    assert sorted(map(str, incremental.select(*columns).collect())) == sorted(map(str, whole.select(*columns).collect()))


def test_rows_without_time_have_a_report_of_their_own(spark):
    rows = [("2024-01-01 10:20:00", "champion", 1, 0.9), ("2024-01-01 10:40:00", "champion", 0, 0.1), (None, "champion", 1, 0.5)]
    for kind in ("timestamp", "timestamp_ntz"):
        df = spark.createDataFrame(rows, "t string, ab_group string, y int, score double").selectExpr(
            f"cast(t AS {kind}) AS t", "ab_group", "y", "score", "1D AS prediction"
        )
        sizes = {str(r["period_start"]): r["champion_sample_size"] for r in report_by_period(df, "t", "y").collect()}
        assert sizes == {"2024-01-01 10:00:00": 2, "None": 1}
