"""One-pass fan-out, bounded drains, lag and record writers over several micro-batches."""

import json
import os

import pyarrow.compute as pc
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from oracle_util import SF_SMALL, compare, duck
from test_streaming import _split_events
from citystream.streaming import jobs, sinks
from citystream.streaming.lag import ProgressLog, offsets_behind, rows_behind
from citystream.streaming.runs import RunTable

ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("dying", ["lake", "totals", "late"])
def test_each_sink_once_after_a_crash_between_sinks(spark, con, tmp_path, monkeypatch, dying):
    """Killed in the second micro-batch right behind one sink, then started again."""
    src, base = _split_events([(0, 300), (300, 650), (650, 10 ** 9)]), str(tmp_path)
    append = RunTable.append

    def dies(table, rows, batch_id):
        done = append(table, rows, batch_id)
        if batch_id == 1 and table.root.endswith(dying):
            raise OSError("killed")
        return done
    with monkeypatch.context() as m:
        m.setattr(RunTable, "append", dies)
        with pytest.raises(Exception):
            jobs.meters_once_stream(spark, src, base)
    query = jobs.start_meters_once(spark, src, base)
    sinks.run_to_end(query)
    scanned = [p["numInputRows"] for p in query.recentProgress]
    assert sum(scanned) == 350          # the killed batch is in the lake and isn't scanned again, the last one is scanned once
    tables = jobs.MeterTables(spark, base)
    for df, sql in ((tables.totals(), ORACLE["ward_energy_15m"]), (tables.lake.read().drop("event_time", "timestamp_ms", "seq"), ORACLE["stream_lake"])):
        problems, *_ = compare(df, con, sql)
        assert not problems, problems
    assert tables.late.read().count() == 0 and tables.console.last() == 2


def test_late_rows_are_kept_with_a_reason(spark, tmp_path):
    """On-time and late rows are the input; totals equal those of the job that drops late rows."""
    src = _split_events([(0, 300), (900, 901), (10, 12), (905, 907)])
    tables = jobs.meters_once_stream(spark, src, str(tmp_path))
    late = tables.late.read()
    assert [(r.seq, r.error_reason) for r in late.orderBy("seq").collect()] == [(10, "LATE"), (11, "LATE")]
    lake = tables.lake.read()
    assert lake.count() == 305
    on_time = tables.pieces.read().agg(F.sum("pf_n")).first()[0]
    assert on_time + late.count() == lake.count()
    dropped = {(r.ward_id, r.window_start): r for r in jobs.ward_energy_stream(spark, src).collect()}
    kept = {(r.ward_id, r.window_start): r for r in tables.totals().collect()}
    assert dropped and all(kept[k] == r for k, r in dropped.items())


def test_two_drains_of_a_growing_topic(spark, tmp_path):
    src, base = _split_events([(0, 300), (300, 400)]), str(tmp_path)
    first = [r.offset for r in jobs.drain_topic(spark, "signals", src, base).collect()]
    assert sorted(first) == list(range(300 + 100))
    assert jobs.drain_topic(spark, "signals", src, base).count() == 0
    t = pq.read_table(f"{SF_SMALL}/events.parquet")
    pq.write_table(t.filter(pc.greater_equal(t["event_id"], 400)), os.path.join(src["path"], "events_009.parquet"))
    second = [r.offset for r in jobs.drain_topic(spark, "signals", src, base).collect()]
    assert sorted(first + second) == list(range(t.num_rows))


def test_drain_of_an_empty_topic(spark, tmp_path):
    src = _split_events([(-2, -1)])
    assert jobs.drain_topic(spark, "signals", src, str(tmp_path)).count() == 0


def test_lag_falls_and_differs_by_admission(spark):
    src = _split_events([(0, 300), (300, 650), (650, 800), (800, 10 ** 9)])
    got = jobs.lag_stream(spark, src, admission={"HIGH_PRIORITY": 4, "STANDARD_PRIORITY": 1})
    by_job = {}
    for r in got.orderBy("batch_id").collect():
        by_job.setdefault(r.job, []).append((r.input_rows, r.behind_rows))
    assert by_job == {"HIGH_PRIORITY": [(1000, 0)], "STANDARD_PRIORITY": [(300, 700), (350, 350), (150, 200), (200, 0)]}


def test_lag_from_the_offsets_of_a_topic(spark):
    log = ProgressLog()
    latest = json.dumps({"t": {"0": 120, "1": 40, "2": 7}})
    log.enter("a", "r", 0, [(50, None, json.dumps({"t": {"0": 100, "1": 40}}), latest), (3, None, '{"logOffset": 1}', None)])
    log.enter("b", "r", 0, [(50, None, "not json", latest)])
    table = log.table(spark)
    got = {(r.job, r.partition): r.lag for r in offsets_behind(table).collect()}
    assert got == {("a", 0): 20, ("a", 1): 0, ("a", 2): 7, ("b", 0): 120, ("b", 1): 40, ("b", 2): 7}
    assert [(r.job, r.read_rows, r.behind_rows) for r in rows_behind(table, 53).orderBy("job").collect()] == [("a", 53, 0), ("b", 50, 3)]
    assert rows_behind(ProgressLog().table(spark), 5).count() == 0


def test_groups_are_jobs_of_their_own(spark, con):
    src = _split_events([(0, 300), (300, 10 ** 9)])
    problems, *_ = compare(jobs.progress_stream(spark, src), con, ORACLE["feed_progress"])
    assert not problems, problems


def test_writers_of_records(spark, con, tmp_path):
    """The jobs that publish to topics, with a folder in the topic's place."""
    src, options = _split_events([(0, 300), (300, 10 ** 9)]), {"format": "json", "path": str(tmp_path / "topics")}
    for name, start in (("a", jobs.start_health_advisory_kafka), ("d", jobs.start_dlq_kafka), ("i", jobs.start_incidents_kafka)):
        sinks.run_to_end(start(spark, src, str(tmp_path / name), options))

    def topic(name):
        return spark.read.schema("key string, value string").json(str(tmp_path / "topics" / name))

    def values(name, like):
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in like.schema.fields)
        return topic(name).select(F.from_json("value", schema).alias("v")).select("v.*")
    q = E.queries()
    problems, *_ = compare(values("city.incidents", q["incidents"](spark, SF_SMALL)), con, ORACLE["incidents"])
    assert not problems, problems
    dead = q["dlq_records"](spark, SF_SMALL)
    schema = "original_payload struct<sensor_id string, zone string, pm25 double, pm10 double, no2 double, aqi double, timestamp string>, error_reason string, source_topic string"
    got = topic("city.dlq").select("key", F.from_json("value", schema).alias("v")).select("key", "v.original_payload.*", "v.error_reason", "v.source_topic")
    assert got.filter(~F.col("key").eqNullSafe(F.col("sensor_id"))).count() == 0
    want = sorted(map(str, dead.drop("seq", "raw_value").select(*got.columns[1:]).collect()))
    assert sorted(map(str, got.drop("key").collect())) == want and want
    # an upsert topic: the last record of a window holds; each is of a window of the final result or was corrected
    last = {tuple(r[c] for c in ("zone", "window_start")) for r in values("city.health_advisories", q["health_advisory"](spark, SF_SMALL)).collect()}
    final = {(r.zone, r.window_start) for r in q["health_advisory"](spark, SF_SMALL).collect()}
    assert final and final <= last
    assert topic("city.health_advisories").filter("key IS NULL OR key <> get_json_object(value, '$.zone')").count() == 0
