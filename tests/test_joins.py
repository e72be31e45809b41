"""Interval cover against brute force; the snapshot store's parts."""
import datetime as dt
import random

from pyspark.sql import functions as F

from roadlens.operators import joins as G
from roadlens.plans import workzones as W
from roadlens.streaming import feeds as R


def test_interval_cover(spark):
    rnd = random.Random(1)
    day = lambda n: dt.date(1970, 1, 1) + dt.timedelta(days=n)
    iv = [(i, day(s), day(s + rnd.choice([0, 1, 5, 64, 700, 9000]))) for i, s in enumerate(rnd.randint(-900, 900) for _ in range(150))]
    iv += [(500, day(5), day(2)), (501, None, day(9)), (502, day(1), None)]
    pts = [(i, day(rnd.randint(-1000, 1200))) for i in range(300)] + [(900, None)]
    got = G.interval_cover(spark.createDataFrame(pts, "id long, t date"), "t", spark.createDataFrame(iv, "k long, s date, e date"), "s", "e", "k", "n", "first")
    for r in got.collect():
        own = [k for k, s, e in iv if r.t and s and e and s <= r.t <= e]
        assert (r.n, r.first) == (len(own), min(own, default=None))
    assert got.count() == len(pts)


def test_interval_cover_lists_no_pairs(spark):
    """1,000 intervals that all hold 1,000 days: rows in proportion to both, not to the pairs."""
    iv = spark.range(1000).select("id", F.lit("2020-01-01").cast("date").alias("s"), F.lit("2024-01-01").cast("date").alias("e"))
    pts = spark.range(1000).select(F.col("id").alias("p"), F.date_add(F.lit("2020-06-01").cast("date"), F.col("id").cast("int")).alias("t"))
    out = G.interval_cover(pts, "t", iv, "s", "e", "id")
    assert {(r.active, r.first) for r in out.collect()} == {(1000, 0)}
    plan = out._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_zone_stats_have_all_codes(spark):
    rows = [(1, k, 10.0 * k, d, i) for k, d, i in ((1, "2", 1), (2, "NULL", 0), (3, None, 4), (4, "1", 0), (5, "x", None), (5, "0", 2))]
    s = W.zone_crash_stats(spark.createDataFrame(rows, "road_event_id long, severity int, distance double, deaths string, injuries long"), deaths="deaths", injuries="injuries").first()
    assert (s.crash_count, s.incap_injury_count, s.fatal_count, s.no_injury_count, s.death_cnt_sum, s.injury_cnt_sum) == (6, 1, 1, 2, 3.0, 7.0)
    assert (s.distance_min, s.distance_max) == (10.0, 50.0)
    assert "death_cnt_sum" not in W.zone_crash_stats(spark.createDataFrame(rows, "road_event_id long, severity int, distance double, a string, b long"), deaths="deaths").columns


SCHEMA = "k long, t long, v string"


def test_snapshot_rewrites_touched_parts_only(spark):
    from roadlens.sources.readers import shared_dir
    table = shared_dir(spark, "t-parts")
    frame = lambda rows: spark.createDataFrame(rows, SCHEMA)
    state = lambda: {r.k: r.v for r in R.read_snapshot(spark, table, frame([]).schema, 16).collect()}
    assert state() == {}
    first = R.merge_snapshot(frame([(i, 1, "a") for i in range(200)]), 0, "k", "t", table, 16)
    assert first == 16
    for epoch in (1, 1, 2):  # the second is a retry
        assert R.merge_snapshot(frame([(7, 2 + epoch, f"b{epoch}"), (7, 0, "old"), (500, 1, "new")]), epoch, "k", "t", table, 16) <= 2
        want = {i: "a" for i in range(200)} | {7: f"b{epoch}", 500: "new"}
        assert state() == want
    versions = R._part_versions(spark, table, 16)
    assert sum(map(len, versions.values())) <= 16 + 2 and max(map(len, versions.values())) == 2
    assert R.merge_snapshot(frame([]), 3, "k", "t", table, 16) == 0 and state() == want
    try:
        R.read_snapshot(spark, table, frame([]).schema, 32)
        raise AssertionError
    except ValueError:
        pass
