"""Streams over several micro-batches equal the batch queries; state carries
across batches; rows behind the watermark are dropped."""

import os
import tempfile
import time

import pyarrow.compute as pc
import pyarrow.parquet as pq
import pytest

from oracle_util import SF_SMALL, compare, duck
import __spark_entry__ as E
from citystream.streaming import jobs


def _split_events(parts):
    """Write `events` rows into files events_000.parquet, ... one per
    (lo, hi) event_id range, with increasing modification times."""
    d = tempfile.mkdtemp(prefix="citystream-stream-")
    t = pq.read_table(f"{SF_SMALL}/events.parquet")
    now = time.time()
    for i, (lo, hi) in enumerate(parts):
        mask = pc.and_(pc.greater_equal(t["event_id"], lo), pc.less(t["event_id"], hi))
        path = os.path.join(d, f"events_{i:03d}.parquet")
        pq.write_table(t.filter(mask), path)
        os.utime(path, (now + i, now + i))
    return {"path": d, "glob": "events_*.parquet", "max_files_per_trigger": 1}


@pytest.fixture(scope="module")
def three_batches():
    return _split_events([(0, 300), (300, 650), (650, 10 ** 9)])


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


ORACLE = E.oracle_sql()


@pytest.mark.parametrize("job,oracle", [
    (jobs.gridlock_stream, "gridlock"),
    (jobs.bunching_stream, "bus_bunching"),
    (jobs.aqi_alert_stream, "aqi_alerts"),
    (jobs.dlq_stream, "dlq_records"),
    (jobs.enrich_stream, "bus_enriched"),
    (jobs.health_advisory_stream, "health_advisory"),
    (jobs.ward_energy_stream, "stream_ward_energy"),
])
def test_stream_equals_batch_over_three_batches(spark, con, three_batches, job, oracle):
    problems, n, _ = compare(job(spark, three_batches), con, ORACLE[oracle])
    assert not problems, problems


def test_late_rows_are_dropped(spark):
    # batch 1: minutes 0..~35; batch 2: one reading at event 900 (~105 min);
    # batch 3: a replayed copy of event 10 (minute ~1), now behind the watermark
    src = _split_events([(0, 300), (900, 901), (10, 11)])
    out = jobs.ward_energy_stream(spark, src, window="15 minutes", watermark="2 minutes")
    first = {r.ward_id: r for r in out.filter("window_start = '2024-01-01 00:00:00'").collect()}
    with_late = {r.ward_id: r for r in jobs.ward_energy_stream(
        spark, _split_events([(0, 300)]), window="15 minutes", watermark="2 minutes")
        .filter("window_start = '2024-01-01 00:00:00'").collect()}
    assert first == with_late        # the late copy was dropped, not counted twice


def test_incident_stream_over_three_batches(spark, con, three_batches):
    problems, n, _ = compare(jobs.incident_stream(spark, three_batches), con, ORACLE["incidents"])
    assert not problems, problems


def test_dirty_feed_stream_equals_batch(spark, con, three_batches):
    problems, n, _ = compare(jobs.dlq_stream(spark, three_batches | {"dirty": True}), con, ORACLE["dlq_dirty"])
    assert not problems, problems


def test_ingest_time_fallback(spark, con, three_batches):
    """With the fallback unreadable times take the broker's, so none is a dead letter for its time."""
    got = jobs.dlq_stream(spark, three_batches | {"dirty": True, "ingest_time_fallback": True})
    reasons = {r.error_reason for r in got.select("error_reason").distinct().collect()}
    assert "MALFORMED_JSON" in reasons and "UNPARSEABLE_TIMESTAMP" not in reasons


@pytest.mark.parametrize("tile_m", [150.0, 50_000.0])
def test_bunching_stream_in_tiles_of_any_size(spark, con, three_batches, tile_m):
    problems, n, _ = compare(jobs.bunching_stream(spark, three_batches, tile_m=tile_m), con, ORACLE["bus_bunching"])
    assert not problems, problems


class Value:
    """A ValueState in memory."""

    def __init__(self):
        self.held = None

    def exists(self):
        return self.held is not None

    def get(self):
        return self.held

    def update(self, value):
        self.held = value

    def clear(self):
        self.held = None


class Handle:
    def __init__(self):
        self.timers = []

    def getValueState(self, name, schema):
        return Value()

    def registerTimer(self, at):
        self.timers.append(at)


def chain(spark, batches, expiry_ms=None, watermarks=None, tile_m=1000.0):
    """Alerts (seq, bus_1) of the three processors, fed with micro-batches in memory, and the processors."""
    import pandas as pd
    from citystream.streaming import stateful as S

    def made(kind, *args):
        p = kind(*args)
        p.init(Handle())
        return p

    class Now:
        def __init__(self, at):
            self.at = at

        def getCurrentWatermarkInMs(self):
            return self.at

    trackers, tiles, folds, alerts = {}, {}, {}, []
    for k, batch in enumerate(batches):
        now = Now((watermarks or [0] * len(batches))[k])
        rows = S.with_lane(batch, 2).toPandas()
        tracked = []
        for key, part in rows.groupby(["route_id", "lane"]):
            tracked += trackers.setdefault(key, made(S.BusTracker, expiry_ms)).handleInputRows(key, iter([part]), now)
        for key, p in trackers.items():
            if any(t <= now.at for t in p.handle.timers):
                p.handle.timers = [t for t in p.handle.timers if t > now.at]
                tracked += p.handleExpiredTimer(key, now, None)
        out = pd.concat(tracked, ignore_index=True).astype(object)
        records = [tuple(None if v is pd.NA or v != v else v for v in r) for r in out.itertuples(index=False)]
        seen = []
        for key, part in S.to_tiles(spark.createDataFrame(records, S.TRACKED), tile_m=tile_m).toPandas().groupby(["route_id", "tile"]):
            seen += tiles.setdefault(key, made(S.TileWatch)).handleInputRows(key, iter([part]), now)
        if seen:
            for key, part in pd.concat(seen, ignore_index=True).groupby("route_id"):
                for a in folds.setdefault(key, made(S.PairFold)).handleInputRows((key, 0), iter([part]), now):
                    alerts += [(int(r["seq"]), r["bus_1"]) for _, r in a.iterrows()]
    return sorted(alerts), trackers, tiles, folds


BUS = "route_id string, bus_id string, lat double, lon double, timestamp_ms long, seq long"


def test_a_pair_that_crosses_tiles_keeps_its_episode(spark):
    """Two buses drive side by side through many tiles, then part and meet again."""
    from citystream.operators import bunching
    rows = [("R", "AB"[i % 2], 1.0, 1.0 + 0.0004 * i if i < 40 else 1.016 + (i % 2) * 0.1 if i < 44 else 1.02, 60_000 * i, i) for i in range(60)]
    bus = spark.createDataFrame(rows, BUS)
    batch = sorted((r.seq, r.bus_1) for r in bunching.bunching_alerts(bus).collect())
    assert len(batch) > 5
    for size in (1, 7, 60):
        for tile_m in (300.0, 1000.0):
            parts = [spark.createDataFrame(rows[k:k + size], BUS) for k in range(0, 60, size)] if size > 1 else [spark.createDataFrame(rows[k:k + 1], BUS) for k in range(0, 24)]
            got, _, tiles, folds = chain(spark, parts, tile_m=tile_m)
            assert got == [a for a in batch if a[0] < (60 if size > 1 else 24)]
            assert len(tiles) > 3


def test_a_silent_bus_is_forgotten(spark):
    """At its bound in event time a bus goes, its episode with it; memory follows."""
    rows = [("R", "A", 1.0, 1.0, 0, 0), ("R", "B", 1.0, 1.0, 10, 1), ("R", "C", 5.0, 5.0, 400_000, 2), ("R", "A", 1.0, 1.0, 500_000, 3)]
    parts = [spark.createDataFrame([r], BUS) for r in rows]
    marks = [0, 0, 390_000, 390_000]
    kept, *_ = chain(spark, parts)
    assert kept == [(3, "A")]
    alerts, trackers, tiles, folds = chain(spark, parts, expiry_ms=300_000, watermarks=marks)
    assert alerts == []
    assert sorted(b for p in trackers.values() for b in p.buses.get()["bus_id"]) == ["A", "C"]
    assert all(len(p.episodes.get()) == 0 for p in folds.values())


def test_expiry_on_a_replay(spark, con, three_batches):
    """With a bound that no bus reaches all alerts stay."""
    problems, n, _ = compare(jobs.bunching_stream(spark, three_batches, expiry_ms=10 ** 9), con, ORACLE["bus_bunching"])
    assert not problems, problems


def test_swapped_files_give_the_same_alerts(spark, con):
    """Files 2 and 3 arrive in each other's place; held back, events give the alerts of those in order."""
    delay = 7000 * 210
    src = _split_events([(0, 300), (400, 500), (300, 400), (500, 10 ** 9)])
    last = max(pq.read_table(f"{SF_SMALL}/events.parquet")["event_id"].to_pylist())
    upto = f" WHERE timestamp_ms <= {1704067200000 + last * 7000 - delay}"
    compared = 0
    for job, oracle in ((jobs.gridlock_stream, "gridlock"), (jobs.bunching_stream, "bus_bunching")):
        problems, n, _ = compare(job(spark, src, reorder=f"{delay // 1000} seconds"), con, f"SELECT * FROM ({ORACLE[oracle]}){upto}")
        assert not problems, problems
        compared += n
    assert compared


def test_detectors_survive_missing_values(spark):
    """Rows without junction, bus, place or time: batch and stream give the same alerts."""
    import pandas as pd
    from pyspark.sql import functions as F
    from citystream.operators import bunching, gridlock
    from citystream.streaming import stateful
    waits = [200.0, 200.0, None, 200.0, 200.0, float("nan"), 200.0, 200.0, 200.0]
    rows = [("J" if i % 9 < 9 else None, "N", w, None if i == 8 else 1000 * i, i) for i, w in enumerate(waits)] + [(None, "N", 300.0, 5, 50 + i) for i in range(3)]
    sig = spark.createDataFrame(rows, "junction_id string, zone string, avg_wait_sec double, timestamp_ms long, seq long")
    assert [(r.junction_id, r.timestamp_ms, r.seq) for r in gridlock.gridlock_alerts(sig).collect()] == [("J", None, 8)]
    p = stateful.GridlockProcessor()
    p.count = type("S", (), {"exists": lambda s: False, "update": lambda s, v: None, "clear": lambda s: None})()
    got = pd.concat(p.handleInputRows(("J",), iter([sig.filter("junction_id = 'J'").toPandas()]), None))
    assert got["seq"].tolist() == [8] and got["timestamp_ms"].isna().all()

    t = [0, 10, None, 300011, 400000, 900000]
    bus_rows = [("R", "AB"[i % 2], None if i == 4 else 1.0, 1.0, x, i) for i, x in enumerate(t)] + [("R", None, 1.0, 1.0, 5, 90), (None, "A", 1.0, 1.0, 5, 91)]
    bus = spark.createDataFrame(bus_rows, "route_id string, bus_id string, lat double, lon double, timestamp_ms long, seq long")
    batch = [(r.seq, r.bus_1) for r in bunching.bunching_alerts(bus).collect()]

    alerts, *_ = chain(spark, [bus.filter(F.col("seq").between(k, k + 1)) for k in range(0, 92, 2) if bus.filter(F.col("seq").between(k, k + 1) & F.col("route_id").isNotNull() & F.col("bus_id").isNotNull()).count()])
    assert alerts == batch == [(3, "B")]


def test_bunching_memory_follows_near_pairs():
    """6000 buses of one tile, of which two are near: no room for all pairs of buses."""
    import tracemalloc
    import numpy as np
    import pandas as pd
    from citystream.streaming import stateful as S
    n = 6000
    bus = [f"B{i:05d}" for i in range(n)] + ["B00000", "B00001"]
    feed = pd.DataFrame({"bus_id": bus, "seq": range(n + 2), "timestamp_ms": [0] * n + [10 ** 6] * 2, "lat": [0.0, 0.0] + [0.01 * i for i in range(2, n)] + [0.0, 0.0],
                         "lon": [180.0, -179.9999] + [10.0] * (n - 2) + [180.0, -179.9999]})
    feed["was_lat"], feed["was_lon"] = [np.nan] * n + [0.0, 0.0], [np.nan] * n + [180.0, -179.9999]
    feed["ordinal"] = list(range(n)) + [1, 2]
    feed["here"], feed["asked"], feed["left"] = True, True, feed["was_lat"].notna()
    watch, fold = S.TileWatch(), S.PairFold()
    watch.init(Handle())
    fold.init(Handle())
    tracemalloc.start()
    seen = pd.concat(watch.handleInputRows(("R", 0), iter([feed]), None))
    got = pd.concat(fold.handleInputRows(("R", 0), iter([seen]), None))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [(r["bus_1"], r["bus_2"], r["seq"]) for _, r in got.iterrows()] == [("B00000", "B00001", n)]
    assert len(watch.places.get()) == n and len(fold.episodes.get()) == 1     # opened again by the last event
    assert peak < 40 * 2 ** 20


def test_a_depot_is_told_piece_by_piece():
    """A micro-batch of 900 buses at one place: 2 million near rows, of which the open ends alone are told,
    in bounded pieces, and the next micro-batch goes on with them (F5, F6)."""
    import tracemalloc
    import numpy as np
    import pandas as pd
    from citystream.streaming import stateful as S
    buses = 900

    def feed(turns):
        seq = np.arange(turns[0] * buses, turns[-1] * buses + buses)
        bus, turn = seq % buses, seq // buses
        # every bus is away in the second and the fourth turn
        lat = np.where(turn % 3 == 1, 1.0 + 0.004 * (bus + 1), 1.0)
        was = np.where(turn == 0, np.nan, np.where(turn % 3 == 2, 1.0 + 0.004 * (bus + 1), 1.0))
        return pd.DataFrame({"bus_id": [f"B{b:04d}" for b in bus], "seq": seq, "timestamp_ms": seq * 1000, "lat": lat, "lon": 10.0, "was_lat": was, "was_lon": np.where(np.isnan(was), np.nan, 10.0),
                             "ordinal": bus + turn, "here": True, "asked": True, "left": turn > 0})

    watch, fold = S.TileWatch(), S.PairFold()
    watch.init(Handle())
    fold.init(Handle())
    whole = list(watch.handleInputRows(("R", 0), iter([feed([0, 1, 2, 3, 4])]), None))
    assert max(map(len, whole)) <= S.B.BATCH_ROWS
    alerts = [a for part in whole for a in fold.handleInputRows(("R", 0), iter([part]), None)]
    assert sum(a["bus_1"].notna().sum() for a in alerts) == sum(map(len, alerts)) > 0
    # micro-batch by micro-batch, the same alerts
    watch, fold, cut = S.TileWatch(), S.PairFold(), []
    watch.init(Handle())
    fold.init(Handle())
    told = 0
    for turn in range(5):
        parts = list(watch.handleInputRows(("R", 0), iter([feed([turn])]), None))
        told += sum(map(len, parts))
        if parts:
            cut += fold.handleInputRows(("R", 0), iter(parts), None)
    key = ["seq", "bus_1", "bus_2"]
    a, b = (pd.concat(x)[key].sort_values(key).reset_index(drop=True) for x in (alerts, cut))
    assert a.equals(b) and sum(map(len, whole)) < told
    tracemalloc.start()
    watch = S.TileWatch()
    watch.init(Handle())
    for _ in watch.handleInputRows(("R", 0), iter([feed([0, 1, 2, 3, 4])]), None):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 250 * 2 ** 20


def test_restart_goes_on_where_it_stopped(spark, tmp_path):
    """File 1, stop, file 2 on the same folder: each row once."""
    from pyspark.sql import functions as F
    first = _split_events([(0, 400)])
    base = str(tmp_path / "job")
    assert jobs.aqi_alert_stream(spark, first, base).count() > 0
    again = jobs.aqi_alert_stream(spark, first, base).count()
    t = pq.read_table(f"{SF_SMALL}/events.parquet")
    pq.write_table(t.filter(pc.greater_equal(t["event_id"], 400)), os.path.join(first["path"], "events_001.parquet"))
    whole = jobs.aqi_alert_stream(spark, first, base)
    assert whole.count() > again
    problems, n, _ = compare(whole, duck(SF_SMALL), ORACLE["aqi_alerts"])
    assert not problems, problems


def test_lake_console_and_totals_side_by_side(spark, three_batches, tmp_path, capfd):
    """Three live queries on one topic; one that fails or stops ends the wait."""
    from citystream.streaming import sinks
    queries = jobs.start_all_meters(spark, three_batches, str(tmp_path), {"processingTime": "1 second"})
    try:
        assert len({q.id for q in queries}) == 3 and all(q.isActive for q in queries)
        assert not sinks.await_any(spark, 1)
        for q in queries:
            q.processAllAvailable()
        queries[1].stop()
        assert sinks.await_any(spark, 30)
    finally:
        for q in queries:
            q.stop()
        spark.streams.resetTerminated()
    assert spark.read.parquet(str(tmp_path / "lake/out")).count() == 1000
    said = capfd.readouterr().out
    assert "--- smart_meters, batch 0 ---" in said and "--- batch 0 ---" in said


def test_totals_in_another_format(spark, con, three_batches):
    got = jobs.ward_energy_stream(spark, three_batches, form="orc")
    problems, n, _ = compare(got, con, ORACLE["stream_ward_energy"])
    assert not problems, problems


def test_alerts_of_a_depot_are_told_as_lists():
    """Alerts that a tile has settled pass to the sink as a row per event and piece (F4, F5)."""
    import numpy as np
    import pandas as pd
    from citystream.streaming import stateful as S
    n = 200
    seq = np.arange(5 * n)
    bus, turn = seq % n, seq // n
    # every bus is away in the second and the last turn
    lat = np.where(turn % 3 == 1, 1.0 + 0.004 * (bus + 1), 1.0)
    was = np.where(turn == 0, np.nan, np.where(turn % 3 == 2, 1.0 + 0.004 * (bus + 1), 1.0))
    feed = pd.DataFrame({"bus_id": [f"B{b:03d}" for b in bus], "seq": seq, "timestamp_ms": seq * 4000, "lat": lat, "lon": 10.0, "was_lat": was, "was_lon": np.where(np.isnan(was), np.nan, 10.0),
                         "ordinal": turn + 1, "here": True, "asked": True, "left": turn > 0})
    watch, fold = S.TileWatch(), S.PairFold()
    watch.init(Handle())
    fold.init(Handle())
    told = pd.concat(watch.handleInputRows(("R", 0), iter([feed]), None))
    alerts = pd.concat(fold.handleInputRows(("R", 0), iter([told]), None))
    settled = told[told["pair"].isna()]
    assert 0 < len(settled) < settled["others"].map(len).sum() / 10
    assert len(alerts) >= settled["others"].map(len).sum() and (alerts["distance"] == 0.0).all() and (alerts["bus_1"] != alerts["bus_2"]).all()
