"""A single device holding a third of all rows: results stay exact and the
plans reduce rows before the shuffle."""

from pyspark.sql import functions as F

from tidewater.operators import rollup
from tidewater.operators.dedup import latest_per_key
from tidewater.plans.warehouse import dedup_batch, replay
from tidewater.sources import telemetry

SF = "/root/testdata/sf0.001"


def _skewed(spark):
    """Every reading also re-sent under device 7 one second later, so device 7
    holds over a third of all rows (some of them exact copies)."""
    r = telemetry.load_measurements(spark, SF)
    hot = r.withColumn("iot_device_id", F.lit(7)).withColumn(
        "event_time", F.col("event_time") + F.expr("INTERVAL 1 SECOND"))
    return r.unionByName(hot)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_device_results_exact(spark):
    r = _skewed(spark)
    n_hot = r.filter("iot_device_id = 7").count()
    assert n_hot * 3 >= r.count()
    wh = replay(r, deduplicate=True)
    expected = dedup_batch(r).count()
    assert wh.fact.count() == expected
    h = rollup.hourly_rollup(wh.fact)
    assert h.agg(F.sum(F.col("avg_temp").isNotNull().cast("int"))).first()[0] == h.count()
    latest = latest_per_key(r, ["iot_device_id"], "event_time").filter("iot_device_id = 7").first()
    assert latest.event_time == r.filter("iot_device_id = 7").agg(F.max("event_time")).first()[0]


def test_reduction_happens_before_the_shuffle(spark):
    r = _skewed(spark)
    top1 = _plan(latest_per_key(r, ["iot_device_id"], "event_time"))
    assert "WindowGroupLimit" in top1 and "Partial" in top1
    agg = _plan(rollup.hourly_rollup(replay(r, deduplicate=True).fact))
    assert "partial_sum" in agg and "partial_max" in agg


def test_fact_load_splits_a_hot_device(spark):
    from tidewater.operators import facts, scd2

    batch = dedup_batch(_skewed(spark))
    ts = F.lit("2030-01-01").cast("timestamp")
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        dev = scd2.stage_versions(scd2.device_states(batch), scd2.DEVICE, ts)
        cty = scd2.stage_versions(scd2.country_states(batch), scd2.COUNTRY, ts)
        # several map tasks, so that there is something to split
        loaded = facts.load_fact(batch.repartition(16), dev, cty, "content")
        assert len(loaded.collect()) == batch.count()
        plan = _plan(loaded)
        assert "skew=true" in plan, plan
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_two_current_versions_are_an_error(spark):
    import pytest

    from tidewater.operators import facts, scd2

    batch = dedup_batch(telemetry.load_measurements(spark, SF))
    dev = scd2.stage_versions(scd2.device_states(batch), scd2.DEVICE, F.lit("2030-01-01").cast("timestamp"))
    cty = scd2.stage_versions(scd2.country_states(batch), scd2.COUNTRY, F.lit("2030-01-01").cast("timestamp"))
    with pytest.raises(Exception, match="two current versions"):
        facts.load_fact(batch, dev.unionByName(dev), cty).collect()
