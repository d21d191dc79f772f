import datetime as dt

from pyspark.sql import Window, functions as F

from tidewater.operators import scd2
from tidewater.plans.warehouse import BATCH_COL, per_batch_states, weekly_batch
from tidewater.schemas import DIM_DEVICE
from tidewater.sources import telemetry

T1 = dt.datetime(2024, 1, 1)
T2 = dt.datetime(2024, 1, 2)


def _stage(spark, rows, ts):
    states = spark.createDataFrame(rows, "iot_device_id int, latitude double, longitude double, timezone string")
    return scd2.stage_versions(states, scd2.DEVICE, ts)


def _apply(spark, batches):
    dim = spark.createDataFrame([], DIM_DEVICE)
    for rows, ts in batches:
        dim = scd2.scd2_merge(dim, _stage(spark, rows, ts), scd2.DEVICE)
    return dim


def test_truth_table(spark):
    first = [(1, 1.0, 1.0, "A"), (2, 2.0, 2.0, "B"), (3, 3.0, 3.0, None), (4, 4.0, 4.0, "D")]
    second = [(1, 1.0, 1.0, "A"),       # unchanged
              (2, 2.5, 2.0, "B"),       # changed
              (3, 3.0, 3.0, "C"),       # NULL -> value is a change
              (5, 5.0, 5.0, "E")]       # new key; 4 absent -> untouched
    dim = _apply(spark, [(first, T1), (second, T2)])
    rows = {(r.iot_device_id, r.is_current): r for r in dim.collect()}
    assert len(rows) == 7
    assert rows[(1, True)].effective_start == T1 and rows[(1, True)].effective_end is None
    assert rows[(2, False)].effective_end == T2 and rows[(2, True)].effective_start == T2
    assert rows[(2, True)].latitude == 2.5
    assert rows[(3, False)].timezone is None and rows[(3, True)].timezone == "C"
    assert rows[(4, True)].effective_start == T1
    assert rows[(5, True)].effective_start == T2
    import hashlib

    assert rows[(5, True)].device_sk == hashlib.md5(b"5||2024-01-02 00:00:00").hexdigest()


def test_value_to_null_is_a_change(spark):
    dim = _apply(spark, [([(1, 1.0, 1.0, "A")], T1), ([(1, 1.0, 1.0, None)], T2)])
    assert dim.filter("is_current").first().timezone is None
    assert dim.count() == 2


def test_same_batch_twice_is_idempotent(spark):
    rows = [(1, 1.0, 1.0, "A"), (2, 2.0, 2.0, "B")]
    once = _apply(spark, [(rows, T1)])
    twice = scd2.scd2_merge(once, _stage(spark, rows, T2), scd2.DEVICE)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def _invariants(dim, key="iot_device_id"):
    assert dim.filter("is_current").groupBy(key).count().filter("count > 1").count() == 0
    w = Window.partitionBy(key).orderBy("effective_start")
    gaps = dim.withColumn("next_start", F.lead("effective_start").over(w)).filter(
        F.col("next_start").isNotNull() & ~F.col("effective_end").eqNullSafe(F.col("next_start"))
    )
    assert gaps.count() == 0
    assert dim.filter(F.col("is_current") & F.col("effective_end").isNotNull()).count() == 0


def test_incremental_equals_bulk_on_test_data(spark):
    readings = telemetry.load_measurements(spark, "/root/testdata/sf0.001")
    states = per_batch_states(readings, weekly_batch())
    bulk_dev = scd2.scd2_history(states.select("iot_device_id", BATCH_COL, *scd2.DEVICE.tracked), scd2.DEVICE, BATCH_COL)
    bulk_cty = scd2.scd2_history(states.select("iot_device_id", BATCH_COL, *scd2.COUNTRY.tracked), scd2.COUNTRY, BATCH_COL)

    r = readings.withColumn(BATCH_COL, weekly_batch())
    batches = sorted(x[0] for x in r.select(BATCH_COL).distinct().collect())
    dev = spark.createDataFrame([], DIM_DEVICE)
    from tidewater.schemas import DIM_COUNTRY

    cty = spark.createDataFrame([], DIM_COUNTRY)
    for b in batches:
        part = r.filter(F.col(BATCH_COL) == F.lit(b))
        dev = scd2.scd2_merge(dev, scd2.stage_versions(scd2.device_states(part), scd2.DEVICE, b), scd2.DEVICE).checkpoint()
        cty = scd2.scd2_merge(cty, scd2.stage_versions(scd2.country_states(part), scd2.COUNTRY, b), scd2.COUNTRY).checkpoint()
    assert dev.exceptAll(bulk_dev).count() == 0 and bulk_dev.exceptAll(dev).count() == 0
    assert cty.exceptAll(bulk_cty).count() == 0 and bulk_cty.exceptAll(cty).count() == 0
    _invariants(dev)
    _invariants(cty)
    assert dev.filter(~F.col("is_current")).count() > 0  # mobile devices produced history


def test_event_time_versions_ignore_late_older_batches(spark):
    def stage(rows):
        df = spark.createDataFrame(rows, "iot_device_id int, latitude double, longitude double, timezone string, "
                                         "_state_time timestamp")
        return scd2.stage_versions(df, scd2.DEVICE, effective_from="event_time")

    dim = spark.createDataFrame([], DIM_DEVICE)
    dim = scd2.scd2_merge(dim, stage([(1, 1.0, 1.0, "A", T2)]), scd2.DEVICE, ignore_older=True)
    # a late batch carrying an older position must not replace the newer one
    dim = scd2.scd2_merge(dim, stage([(1, 9.0, 9.0, "Z", T1)]), scd2.DEVICE, ignore_older=True)
    rows = dim.collect()
    assert len(rows) == 1 and rows[0].latitude == 1.0 and rows[0].effective_start == T2
    later = T2 + dt.timedelta(hours=1)
    dim = scd2.scd2_merge(dim, stage([(1, 2.0, 2.0, "B", later)]), scd2.DEVICE, ignore_older=True)
    cur = dim.filter("is_current").first()
    assert cur.latitude == 2.0 and cur.effective_start == later
    assert dim.filter(~F.col("is_current")).first().effective_end == later


def test_changing_keys(spark):
    dim = _apply(spark, [([(1, 1.0, 1.0, "A"), (2, 2.0, 2.0, None)], T1)])
    stage = _stage(spark, [(1, 1.0, 1.0, "A"), (2, 2.0, 2.0, "B"), (3, 3.0, 3.0, "C")], T2)
    assert sorted(r.iot_device_id for r in scd2.changing_keys(dim, stage, scd2.DEVICE).collect()) == [2, 3]
    same = _stage(spark, [(1, 1.0, 1.0, "A"), (2, 2.0, 2.0, None)], T2)
    assert scd2.changing_keys(dim, same, scd2.DEVICE).isEmpty()
