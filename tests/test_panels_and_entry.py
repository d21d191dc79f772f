import datetime as dt

from pyspark.sql import functions as F

from tidewater.plans import panels, registry

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_device_filter_reaches_the_scan(spark, tmp_dir):
    registry.fact(spark, SF).write.parquet(f"{tmp_dir}/fact")
    fact = spark.read.parquet(f"{tmp_dir}/fact")
    q = panels.device_series(fact, "temp", F.lit(dt.datetime(2024, 1, 30, 23)).cast("timestamp"), devices=[1, 2])
    plan = _plan(q)
    assert "PushedFilters" in plan and "In(iot_device_id" in plan
    assert "ReadSchema: struct<iot_device_id:int,event_time:timestamp,temp:double>" in plan


def test_metric_choice_reads_one_column(spark, tmp_dir):
    registry.fact(spark, SF).write.parquet(f"{tmp_dir}/fact")
    fact = spark.read.parquet(f"{tmp_dir}/fact")
    plan = _plan(panels.metric_by_minute(fact, "wind_gust"))
    assert "ReadSchema: struct<country_code:string,event_time:timestamp,wind_speed:double,wind_gust:double>" in plan
    unknown = panels.metric_by_minute(fact, "nope", F.lit(dt.datetime(2024, 2, 1)).cast("timestamp"))
    assert unknown.filter(F.col("value").isNotNull()).count() == 0
    assert panels.validate_metric("temp") == "temp"


def test_panels_prune_days(spark):
    for name in ("panel_series_temp", "panel_ingestion_lag", "panel_events_ingested", "panel_latest_event_time"):
        plan = _plan(registry.queries()[name](spark, SF))
        scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
        if name == "panel_ingestion_lag":  # late readings may be of any day: the bound reaches the row groups
            assert all("GreaterThanOrEqual(ingestion_time" in line for line in scans), plan
        else:
            assert scans and all("event_time_date" in line.split("PartitionFilters: [", 1)[1].split("]")[0] for line in scans), plan


def test_reducers(spark):
    s = spark.createDataFrame([(1, "a", 1.0), (2, "a", 3.0), (3, "a", None), (1, "b", 5.0)],
                              "time int, metric string, value double")
    red = {r.metric: r for r in panels.series_reducers(s).collect()}
    assert (red["a"].mean, red["a"].last, red["a"].max) == (2.0, None, 3.0)
    lnn = {r.metric: r.value for r in panels.last_not_null(s).collect()}
    assert lnn == {"a": 3.0, "b": 5.0}


def test_entry_and_registry(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["hour_bucket", "iot_device_id", "country_code"]
    assert set(E.oracle_sql()) <= set(E.queries())
    own = {n for n in E.queries() if n != "pipeline" and not n.startswith("op")}
    assert own <= set(E.oracle_sql())
