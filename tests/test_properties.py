import datetime as dt
import hashlib

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tidewater.operators import scd2
from tidewater.plans import registry
from tidewater.plans.warehouse import BATCH_COL, replay
from tidewater.schemas import DIM_DEVICE
from tidewater.sources import telemetry

BASE = dt.datetime(2024, 3, 1)

state = st.tuples(st.sampled_from([1.0, 2.0, None]), st.sampled_from(["A", "B", None]))
batches = st.lists(st.dictionaries(st.integers(1, 4), state, min_size=1, max_size=4), min_size=1, max_size=4)


def model(seq):
    """Plain-Python SCD2: the truth table applied batch by batch."""
    rows = []  # [key, lat, tz, start, end, current]
    for i, batch in enumerate(seq):
        ts = BASE + dt.timedelta(days=i)
        for key, (lat, tz) in sorted(batch.items()):
            cur = [r for r in rows if r[0] == key and r[5]]
            if cur and (cur[0][1], cur[0][2]) == (lat, tz):
                continue
            if cur:
                cur[0][4], cur[0][5] = ts, False
            rows.append([key, lat, tz, ts, None, True])
    return sorted(
        (hashlib.md5(f"{k}||{s:%Y-%m-%d %H:%M:%S}".encode()).hexdigest(), k, lat, tz, s, e, c)
        for k, lat, tz, s, e, c in rows
    )


def _rows(df):
    return sorted(
        (r.device_sk, r.iot_device_id, r.latitude, r.timezone, r.effective_start, r.effective_end, r.is_current)
        for r in df.collect()
    )


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seq=batches)
def test_incremental_and_bulk_match_model(spark, seq):
    dim = spark.createDataFrame([], DIM_DEVICE)
    states = []
    for i, batch in enumerate(seq):
        ts = BASE + dt.timedelta(days=i)
        rows = [(k, lat, 0.0, tz) for k, (lat, tz) in sorted(batch.items())]
        states += [(k, lat, 0.0, tz, ts) for k, lat, _, tz in rows]
        stage = scd2.stage_versions(
            spark.createDataFrame(rows, "iot_device_id int, latitude double, longitude double, timezone string"),
            scd2.DEVICE, ts)
        dim = scd2.scd2_merge(dim, stage, scd2.DEVICE)
    expected = model(seq)
    assert _rows(dim) == expected
    st_df = spark.createDataFrame(states, f"iot_device_id int, latitude double, longitude double, timezone string, {BATCH_COL} timestamp")
    assert _rows(scd2.scd2_history(st_df, scd2.DEVICE, BATCH_COL)) == expected


def test_weekly_batches_through_the_job_match_replay(spark):
    sf = "/root/testdata/sf0.001"
    wh = registry._incremental(spark, sf)
    bulk = replay(telemetry.load_measurements(spark, sf), deduplicate=True)
    for name in ("dim_device", "dim_country", "fact", "staging"):
        a, b = getattr(wh, name), getattr(bulk, name).select(*getattr(wh, name).columns)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name
