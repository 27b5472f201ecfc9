"""Hand-made edge cases for each rule (boundaries, resets, NULLs, lookups,
timestamp and JSON decoding)."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from citystream import schemas
from citystream.functions.time import event_time
from citystream.operators import advisory, alerts, bunching, enrich, gridlock, quality
from citystream.sources import kafka, lookups

T0 = 1704067200000  # 2024-01-01T00:00:00Z


def air(spark, rows):
    """rows: (seq, zone, aqi, minute)"""
    data = [(f"S{seq}", zone, 1.0, 1.0, 1.0, aqi, "", seq, T0 + int(minute * 60000))
            for seq, zone, aqi, minute in rows]
    df = spark.createDataFrame(
        data, "sensor_id string, zone string, pm25 double, pm10 double, no2 double, aqi double, "
              "timestamp string, seq long, timestamp_ms long")
    return df.withColumn("event_time", F.timestamp_millis("timestamp_ms"))


def signals(spark, waits, junction="JN-1"):
    data = [(junction, "North", None if w is None else float(w), i, T0 + i * 1000)
            for i, w in enumerate(waits)]
    return spark.createDataFrame(
        data, "junction_id string, zone string, avg_wait_sec double, seq long, timestamp_ms long")


def buses(spark, rows):
    """rows: (seq, bus, route, lat, lon, t_ms)"""
    return spark.createDataFrame(
        [(b, r, la, lo, t, s) for s, b, r, la, lo, t in rows],
        "bus_id string, route_id string, lat double, lon double, timestamp_ms long, seq long")


# ---------------------------------------------------------------- AQI / DLQ

def test_aqi_alert_boundary(spark):
    df = air(spark, [(1, "North", 300.0, 0), (2, "North", 301.0, 0), (3, "North", None, 0)])
    out = alerts.aqi_alerts(df).collect()
    assert [(r.seq, r.aqi, r.incident_type) for r in out] == [(2, 301.0, "AQI_EMERGENCY")]


def test_dlq_reasons_boundaries(spark):
    df = air(spark, [(1, "N", -1.0, 0), (2, "N", 0.0, 0), (3, "N", 500.0, 0),
                     (4, "N", 501.0, 0), (5, "N", None, 0)])
    got = {r.seq: r.error_reason for r in quality.dead_letters(df).collect()}
    assert got == {1: "AQI_OUT_OF_RANGE", 4: "AQI_OUT_OF_RANGE", 5: "NULL_AQI_VALUE"}
    assert sorted(r.seq for r in quality.valid_records(df).collect()) == [2, 3]
    s = quality.summary(df).first()
    assert (s.total_processed, s.total_failed, s.failure_pct) == (5, 3, 60.0)


def test_dlq_report_on_no_input(spark):
    empty = air(spark, [(1, "N", 1.0, 0)]).limit(0)
    s = quality.summary(empty).first()
    assert (s.total_processed, s.total_failed, s.failure_pct) == (0, 0, 0.0)


def test_dlq_envelope_nests_payload(spark):
    df = air(spark, [(1, "N", None, 0)])
    env = quality.dead_letter_envelope(quality.dead_letters(df)).first()
    assert env.original_payload.sensor_id == "S1" and env.error_reason == "NULL_AQI_VALUE"
    assert env.failed_at is not None


# ---------------------------------------------------------------- gridlock

def _gridlock_seqs(spark, waits, **kw):
    return sorted(r.seq for r in gridlock.gridlock_alerts(signals(spark, waits), **kw).collect())


@pytest.mark.parametrize("kw", [{}, {"block": 2}])
def test_gridlock_reset_after_alert(spark, kw):
    assert _gridlock_seqs(spark, [200.0] * 7, **kw) == [2, 5]


@pytest.mark.parametrize("kw", [{}, {"block": 2}])
def test_gridlock_interrupted(spark, kw):
    assert _gridlock_seqs(spark, [200, 200, 10, 200, 200, 200], **kw) == [5]


def test_gridlock_boundary_and_null(spark):
    assert _gridlock_seqs(spark, [180.0, 180.0, 180.0]) == []
    assert _gridlock_seqs(spark, [200, 200, None, 200, 200, 200]) == [5]


# ---------------------------------------------------------------- bunching

LAT, LON = 18.85, 47.52
FAR = 0.01  # ~1.1 km


def _bunch(spark, rows, **kw):
    out = bunching.bunching_alerts(buses(spark, rows), **kw).collect()
    return sorted((r.seq, r.bus_1, r.bus_2, r.timestamp_ms, r.distance_m) for r in out)


KW = [{}, {"block": 2}]


@pytest.mark.parametrize("kw", KW)
def test_bunching_exactly_five_minutes_no_alert(spark, kw):
    rows = [(1, "A", "R1", LAT, LON, 0), (2, "B", "R1", LAT, LON, 0),
            (3, "B", "R1", LAT, LON, 300000)]
    assert _bunch(spark, rows, **kw) == []


@pytest.mark.parametrize("kw", KW)
def test_bunching_over_five_minutes_alerts_current_bus_first(spark, kw):
    rows = [(1, "B", "R1", LAT, LON, 0), (2, "A", "R1", LAT, LON, 0),
            (3, "B", "R1", LAT, LON, 300001)]
    assert _bunch(spark, rows, **kw) == [(3, "B", "A", 300001, 0.0)]


@pytest.mark.parametrize("kw", KW)
def test_bunching_restart_after_alert(spark, kw):
    rows = [(1, "A", "R1", LAT, LON, 0), (2, "B", "R1", LAT, LON, 0),
            (3, "B", "R1", LAT, LON, 300001),           # alert, episode closed
            (4, "B", "R1", LAT, LON, 400000),           # opens a new episode
            (5, "A", "R1", LAT, LON, 700000),           # 300000 after: no alert
            (6, "A", "R1", LAT, LON, 700001)]           # alert
    assert [r[0] for r in _bunch(spark, rows, **kw)] == [3, 6]


@pytest.mark.parametrize("kw", KW)
def test_bunching_broken_by_far_event(spark, kw):
    rows = [(1, "A", "R1", LAT, LON, 0), (2, "B", "R1", LAT, LON, 0),
            (3, "B", "R1", LAT + FAR, LON, 100000),
            (4, "B", "R1", LAT, LON, 400000)]
    assert _bunch(spark, rows, **kw) == []


def test_bunching_other_route_never_pairs(spark):
    rows = [(1, "A", "R1", LAT, LON, 0), (2, "B", "R2", LAT, LON, 0),
            (3, "B", "R2", LAT, LON, 400000), (4, "A", "R1", LAT, LON, 800000)]
    assert _bunch(spark, rows) == []


def test_bunching_stale_partner_position_counts(spark):
    # B reported once; A keeps reporting next to B's last known position
    rows = [(1, "B", "R1", LAT, LON, 0), (2, "A", "R1", LAT, LON + 0.001, 10),
            (3, "A", "R1", LAT, LON + 0.001, 400000)]
    got = _bunch(spark, rows)
    assert [(r[0], r[1], r[2]) for r in got] == [(3, "A", "B")]
    assert 100 < got[0][4] < 110


def test_haversine_same_point_is_zero(spark):
    from citystream.functions.geo import haversine_m
    v = spark.range(1).select(haversine_m(F.lit(LAT), F.lit(LON), F.lit(LAT), F.lit(LON))).first()[0]
    assert v == 0.0


# ---------------------------------------------------------------- windows / advisories

def test_sliding_window_membership(spark):
    df = air(spark, [(1, "North", 100.0, 7.5)])
    wins = advisory.rolling_aqi(df).collect()
    assert len(wins) == 10
    assert sorted(w.window_start for w in wins)[0] == "2023-12-31 23:58:00"
    assert all(w.window_start <= "2024-01-01 00:07:30" < w.window_end for w in wins)


def test_advisory_boundary_and_null_only(spark):
    df = air(spark, [(1, "North", 100.0, 0), (2, "North", 200.0, 0),   # average exactly 150
                     (3, "South", None, 30), (4, "South", None, 30),   # only NULLs
                     (5, "East", 151.0, 60), (6, "Zone-A", 400.0, 60)])  # no profile row
    adv = advisory.health_advisories(df, lookups.zone_profile_side(spark)).collect()
    assert {r.zone for r in adv} == {"East"}
    assert all(r.rolling_avg_aqi == r.alert_level == 151.0 for r in adv)
    assert all((r.population, r.number_of_schools) == (98250, 7) for r in adv)
    rolling = advisory.rolling_aqi(df).filter("zone = 'South'").collect()
    assert rolling and all(r.rolling_avg_aqi is None and r.aqi_readings == 0 for r in rolling)


def test_exact_mean_rounding_half_up(spark):
    # 0.87875 is not representable; the exact mean must still round up
    df = spark.createDataFrame([("w", 0.878), ("w", 0.8795)], "ward_id string, pf double")
    from citystream.functions.exact import rounded_mean, units
    got = (df.groupBy("ward_id").agg(F.sum(units("pf")).alias("u"), F.count("pf").alias("n"))
             .select(rounded_mean("u", "n").alias("m")).first().m)
    assert got == 0.8788


# ---------------------------------------------------------------- lookups

def test_unknown_route_defaults(spark):
    b = buses(spark, [(1, "A", "R106", LAT, LON, 0), (2, "B", "R101", LAT, LON, 0)])
    got = {r.route_id: (r.route_name, r.scheduled_arrival_time, r.terminal)
           for r in enrich.enrich_bus(b, lookups.route_schedule_side(spark)).collect()}
    assert got["R106"] == ("UNKNOWN", "N/A", "N/A")
    assert got["R101"] == ("Route One", "08:00:00", "Terminal One")


def test_duplicate_lookup_key_last_row_wins(spark):
    d = tempfile.mkdtemp(prefix="citystream-test-")
    path = os.path.join(d, "routes.csv")
    with open(path, "w") as f:
        f.write("route_id,route_name,scheduled_arrival_time,terminal\n"
                "R101,Old Name,07:00:00,Old Terminal\n"
                "R102,Route Two,08:15:00,Terminal Two\n"
                "R101,New Name,07:30:00,New Terminal\n")
    b = buses(spark, [(1, "A", "R101", LAT, LON, 0), (2, "B", "R101", LAT, LON, 0)])
    out = enrich.enrich_bus(b, lookups.route_schedule_side(spark, path)).collect()
    assert len(out) == 2
    assert {(r.route_name, r.terminal) for r in out} == {("New Name", "New Terminal")}


def test_last_row_wins_over_files_and_splits(spark, tmp_path):
    """Files of unlike size (tasks take the largest first) in many small splits."""
    head = "route_id,route_name,scheduled_arrival_time,terminal\n"
    line = lambda i, tag: f"R{i % 7},{tag} {i:04d},08:00:00,Terminal\n"
    (tmp_path / "a.csv").write_text(head + "".join(line(i, "first") for i in range(2000)))
    (tmp_path / "b.csv").write_text(head + "".join(line(i, "second") for i in range(300)))
    (tmp_path / "c.csv").write_text(head + "".join(line(i, "third") for i in range(3)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        side = lookups.route_schedule(spark, str(tmp_path))
        assert spark.read.csv(str(tmp_path), schema=schemas.ROUTE_SCHEDULE, header=True).rdd.getNumPartitions() > 8
        got = {r.route_id: r.route_name for r in side.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    second = {i % 7: f"second {i:04d}" for i in range(300)}
    assert got == {f"R{k}": f"third {k:04d}" if k < 3 else name for k, name in second.items()}


# ---------------------------------------------------------------- decoding

def test_timestamp_normaliser(spark):
    df = spark.createDataFrame(
        [("1704067200123",), ("2024-01-01T00:00:00",), ("2024-01-01T00:00:00Z",),
         ("2024-01-01T05:30:00+05:30",), ("garbage",), (None,)], "timestamp string")
    got = [r[0] for r in df.select(F.unix_millis(event_time("timestamp"))).collect()]
    assert got == [1704067200123, T0, T0, T0, None, None]


def test_malformed_json_keeps_text(spark):
    env = spark.createDataFrame(
        [(bytearray(b"k"), bytearray(b'{"sensor_id":"S1","aqi":42,"timestamp":"1704067200000"}'),
          "t", 0, 1, None),
         (bytearray(b"k"), bytearray(b"{bad"), "t", 0, 2, None)],
        schemas.KAFKA_ENVELOPE)
    rows = {r.seq: r for r in kafka.decode(env, "air_quality").collect()}
    assert rows[1].aqi == 42.0 and rows[1]._corrupt_record is None
    assert rows[1].event_time is not None
    assert rows[2].sensor_id is None and rows[2]._corrupt_record == "{bad"
    # a record without AQI is a dead letter, never an alert
    assert quality.dead_letters(kafka.decode(env, "air_quality")).filter("seq = 2").count() == 1


def test_values_are_parsed_once(spark):
    """A filter on what was decoded does not copy the parser, and no record is lost to it."""
    from citystream.plans import catalog
    for name in ("dlq_dirty", "dlq_envelope", "zone_rolling_aqi_dirty"):
        plan = catalog.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json(") - (name == "dlq_envelope") == 1, name


def test_empty_values_are_dead_letters(spark):
    env = spark.createDataFrame([(b"k", v, "t", 0, i, None) for i, v in enumerate([None, b"", b"{}", b"[]", b"null", b"7"])], schemas.KAFKA_ENVELOPE)
    decoded = kafka.decode(env, "air_quality")
    assert sorted(r.seq for r in decoded.collect()) == list(range(6))
    assert sorted(r.seq for r in quality.dead_letters(decoded).collect()) == list(range(6))


# ---------------------------------------------------------------- dirty values

def test_times_that_are_no_time(spark):
    texts = ["99999999999999999999", "9" * 400, "-1", "12:30", "2024-01-01", "2024-13-45", "2024-01-01 00:00:00.5", " 1704067200000 ", "1e12", ""]
    df = spark.createDataFrame([(t,) for t in texts], "timestamp string")
    got = [r[0] for r in df.select(F.unix_millis(event_time("timestamp"))).collect()]
    assert got == [None, None, -1, None, T0, None, T0 + 500, T0, None, None]


def test_values_that_are_no_number(spark):
    from citystream.operators import energy
    bad = [float("nan"), float("inf"), -float("inf"), 1e14, 1e300, None]
    rows = [("w", v, v, v) for v in bad] + [("w", 1.5, 230.0, 0.9), ("w", 2.25, 231.0, 0.95)]
    df = spark.createDataFrame(rows, "ward_id string, kwh_reading double, voltage double, power_factor double")
    got = energy.ward_energy(df.withColumn("event_time", F.timestamp_millis(F.lit(T0)))).first()
    assert (got.total_kwh_consumed, got.avg_power_factor) == (3.75, 0.925)
    only = energy.ward_energy(df.limit(6).withColumn("event_time", F.timestamp_millis(F.lit(T0)))).first()
    assert only.total_kwh_consumed is None and only.avg_power_factor is None


def test_reading_without_time_is_in_no_window(spark):
    df = air(spark, [(1, "North", 400.0, 0), (2, "North", 100.0, 5)])
    spoilt = df.withColumn("event_time", F.when(F.col("seq") == 2, F.col("event_time")))
    wins = advisory.rolling_aqi(spoilt).collect()
    assert len(wins) == 10 and all(w.window_start and w.rolling_avg_aqi == 100.0 for w in wins)
    assert advisory.health_advisories(spoilt, lookups.zone_profile_side(spark)).count() == 0
    assert {r.seq: r.error_reason for r in quality.dead_letters(spoilt).collect()} == {1: "UNPARSEABLE_TIMESTAMP"}


def test_bunching_across_the_date_line_and_near_a_pole(spark):
    """Grid columns wrap around; a pair over the line or beside a pole is found."""
    for lat, a, b in ((0.0, 179.9995, -179.9995), (89.9999, 10.0, -170.0), (-60.0, 0.0, 0.003)):
        rows = [(1, "A", "R", lat, a, 0), (2, "B", "R", lat, b, 10), (3, "A", "R", lat, a, 300011)]
        assert [r[0] for r in _bunch(spark, rows)] == [3], lat
