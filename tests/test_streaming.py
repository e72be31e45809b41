"""Streams: late rows on both sides of the watermark, duplicates inside the
watermark."""
import datetime as dt

from roadlens.sources.readers import shared_dir
from roadlens.streaming import feeds as R

SCHEMA = "event_id long, ts timestamp, event_type string, value double"


def _land(spark, base, i, rows):
    # one file per delivery, written in order: the file source then replays deliveries in order
    import time
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.option("timestampFormat", R.TS_FORMAT).json(f"{base}/f{i}")
    time.sleep(0.05)


def test_window_late_rows(spark):
    base = shared_dir(spark, "t-late")
    t0 = dt.datetime(2024, 1, 1, 0, 0)
    h = lambda m: t0 + dt.timedelta(minutes=m)
    _land(spark, base, 0, [(1, h(5), "a", 1.0), (2, h(70), "a", 1.0)])
    _land(spark, base, 1, [(3, h(200), "a", 1.0)])           # watermark -> 190 min
    _land(spark, base, 2, [(4, h(195), "a", 1.0), (5, h(30), "a", 1.0), (6, h(300), "a", 1.0)])
    s = R.read_feed_stream(spark, f"{base}/*", SCHEMA, max_files_per_trigger=1)
    out = R.windowed_counts(s, "ts", "1 hour", "10 minutes", shared_dir(spark, "t-win"), shared_dir(spark, "t-ck"))
    got = {(r.window_start.hour, r.n) for r in out.collect()}
    # row 5 (00:30) arrives after the watermark reached 03:10: dropped (00:00 window keeps 1);
    # row 4 (03:15) is inside the watermark: counted; the 05:00 window stays open (watermark 04:50)
    assert got == {(0, 1), (1, 1), (3, 2)}


def test_dedup_within_watermark(spark):
    base = shared_dir(spark, "t-dup")
    t0 = dt.datetime(2024, 1, 1, 0, 0)
    _land(spark, base, 0, [(1, t0, "a", 1.0), (2, t0, "a", 2.0)])
    _land(spark, base, 1, [(1, t0 + dt.timedelta(minutes=1), "a", 1.0)])
    s = R.read_feed_stream(spark, f"{base}/*", SCHEMA, max_files_per_trigger=1)
    out = R.ingest_feed_stream(s, ["event_id"], "ts", "1 hour", shared_dir(spark, "t-br"), shared_dir(spark, "t-ck2"))
    assert sorted(r.event_id for r in out.collect()) == [1, 2]


def test_latest_snapshot_restarts(spark):
    base, table, ck = (shared_dir(spark, n) for n in ("t-snap", "t-state", "t-ck3"))
    t0 = dt.datetime(2024, 1, 1, 0, 0)

    def run():
        s = R.read_feed_stream(spark, f"{base}/*", SCHEMA, max_files_per_trigger=1)
        return {r.event_id: r.value for r in R.latest_snapshot(s, "event_id", "ts", table, ck).collect()}
    _land(spark, base, 0, [(1, t0, "a", 1.0), (2, t0, "a", 2.0)])
    assert run() == {1: 1.0, 2: 2.0}
    _land(spark, base, 1, [(2, t0 + dt.timedelta(hours=1), "a", 5.0)])
    assert run() == {1: 1.0, 2: 5.0}
    assert run() == {1: 1.0, 2: 5.0}
