"""Grid joins equal brute force for any cell size; plan assertions."""
import math
import random

import pytest
from pyspark.sql import functions as F

from roadlens.functions.geo import point_in_ring
from roadlens.operators import spatial as S


def _points(spark, n, seed, prefix):
    rnd = random.Random(seed)
    rows = [(i, float(rnd.randint(0, 2000)), float(rnd.randint(0, 2000))) for i in range(n)]
    return spark.createDataFrame(rows, f"{prefix}_id long, x double, y double"), rows


@pytest.mark.parametrize("cell", [None, 150.0, 400.0])
def test_within_pairs_equals_brute_force(spark, cell):
    L, lr = _points(spark, 200, 1, "l")
    R, rr = _points(spark, 200, 2, "r")
    got = {(r.l_id, r.r_id) for r in S.within_pairs(L, R, "l_id", "r_id", 150.0, cell=cell).collect()}
    exp = {(a[0], b[0]) for a in lr for b in rr if math.hypot(a[1] - b[1], a[2] - b[2]) <= 150.0}
    assert got == exp


def test_nearest_ties_and_limits(spark):
    L = spark.createDataFrame([(1, 0.0, 0.0), (2, 1000.0, 1000.0), (3, 50.0, 0.0)], "l_id long, x double, y double")
    # two stations at exactly 100 m from point 1; point 3 is 50 m from both
    R = spark.createDataFrame([(10, 100.0, 0.0), (11, -100.0, 0.0), (12, 0.0, 100.001)], "r_id long, x double, y double")
    first = {r.l_id: r.r_id for r in S.nearest_within(L, R, "l_id", "r_id", 100.0).collect()}
    assert first == {1: 10, 2: None, 3: 10}
    alls = sorted((r.l_id, r.r_id) for r in S.nearest_within(L, R, "l_id", "r_id", 100.0, ties="all").collect()
                  if r.r_id is not None)
    assert alls == [(1, 10), (1, 11), (3, 10)]


def test_nearest_unbounded_empty_and_single(spark):
    L = spark.createDataFrame([(1, 0.0, 0.0), (2, 5000.0, 0.0)], "l_id long, x double, y double")
    R1 = spark.createDataFrame([(7, 9000.0, 9000.0)], "r_id long, x double, y double")
    got = {r.l_id: r.r_id for r in S.nearest_unbounded(L, R1, "l_id", "r_id").collect()}
    assert got == {1: 7, 2: 7}
    R0 = spark.createDataFrame([], "r_id long, x double, y double")
    assert {r.r_id for r in S.nearest_unbounded(L, R0, "l_id", "r_id").collect()} == {None}


def test_point_in_polygon_concave_and_overlap(spark):
    # concave "U" polygon (id 1) and a square overlapping its right arm (id 2)
    u = [(0, 0), (30, 0), (30, 30), (20, 30), (20, 10), (10, 10), (10, 30), (0, 30)]
    sq = [(25, 5), (40, 5), (40, 20), (25, 20)]
    polys = spark.createDataFrame([(1, [{"x": float(a), "y": float(b)} for a, b in u]),
                                   (2, [{"x": float(a), "y": float(b)} for a, b in sq])],
                                  "pid long, ring array<struct<x:double,y:double>>")
    pts = spark.createDataFrame([(1, 15.0, 20.0), (2, 5.0, 5.0), (3, 27.0, 15.0), (4, 50.0, 50.0), (5, 35.0, 10.0)],
                                "id long, x double, y double")
    got = {r.id: r.pid for r in S.point_in_polygon(pts, polys, "id", "pid", "ring", 7.0).collect()}
    assert got == {1: None, 2: 1, 3: 1, 4: None, 5: 2}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_spatial_plans_have_no_nested_loop_or_python(spark):
    L, _ = _points(spark, 50, 3, "l")
    R, _ = _points(spark, 50, 4, "r")
    for df in (S.within_pairs(L, R, "l_id", "r_id", 100.0), S.nearest_within(L, R, "l_id", "r_id", 100.0)):
        p = _plan(df)
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p and "PythonUDF" not in p


def test_salted_joins_equal_unsalted(spark):
    # a hot cell: half of the left points sit in one 150 m cell
    L, lr = _points(spark, 200, 8, "l")
    hot = spark.createDataFrame([(1000 + i, 10.0 + i % 7, 20.0 + i % 5) for i in range(200)], "l_id long, x double, y double")
    L = L.unionByName(hot)
    R, rr = _points(spark, 100, 9, "r")
    a = {(r.l_id, r.r_id) for r in S.within_pairs(L, R, "l_id", "r_id", 150.0).collect()}
    b = {(r.l_id, r.r_id) for r in S.within_pairs(L, R, "l_id", "r_id", 150.0, salt=4).collect()}
    assert a == b
    n1 = {(r.l_id, r.r_id) for r in S.nearest_within(L, R, "l_id", "r_id", 150.0).collect()}
    n4 = {(r.l_id, r.r_id) for r in S.nearest_within(L, R, "l_id", "r_id", 150.0, salt=4).collect()}
    assert n1 == n4


@pytest.mark.parametrize("name", ["build_crash_table", "build_segment_table", "county_risk", "roc_auc", "threshold_sweep",
                                  "what_if_variants", "space_time_match", "point_in_polygon", "range_interval_join"])
def test_composed_plans_have_no_nested_loop_or_python(spark, name):
    import __spark_entry__ as E
    p = _plan(E.queries()[name](spark, "/root/testdata/sf0.001"))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p and "PythonUDF" not in p


def test_nearest_holds_no_pairs_and_broadcasts_no_cells(spark):
    """The search for the least distance neither sorts pairs nor builds them up, and cells are not broadcast."""
    L, lr = _points(spark, 300, 21, "l")
    R, rr = _points(spark, 200, 22, "r")
    line = F.array(F.struct("x", "y"), F.struct((F.col("x") + 90).alias("x"), (F.col("y") + 40).alias("y"))).alias("g")
    lines = R.select("r_id", line)
    for df in (S.nearest_within(L, R, "l_id", "r_id", 200.0), S.nearest_within(L, R, "l_id", "r_id", 200.0, ties="all"),
               S.nearest_line_within(L, lines, "l_id", "r_id", "g", 200.0)):
        p = _plan(df)
        assert "BroadcastHashJoin" not in p and "REPARTITION_BY_NUM" in p
        assert "functions=[min(CASE WHEN isnotnull(_rkey" in p  # the first join ends in plain numbers
    got = {(r.l_id, r.r_id) for r in S.nearest_within(L, R, "l_id", "r_id", 200.0, ties="all").collect()}
    exp = set()
    for a in lr:
        d = [(round(math.hypot(a[1] - b[1], a[2] - b[2]), 6), b[0]) for b in rr]
        near = [x for x in d if x[0] <= 200.0]
        exp |= {(a[0], k) for v, k in near if v == min(near)[0]} or {(a[0], None)}
    assert got == exp


def test_nearest_with_repeated_and_null_keys(spark):
    # the key 1 comes three times: its rows share a cell, so they share a least distance
    L = spark.createDataFrame([(1, 10.0, 10.0), (1, 10.0, 10.0), (1, 12.0, 10.0), (None, 90.0, 90.0), (4, None, 5.0)], "l_id long, x double, y double")
    R = spark.createDataFrame([(7, 12.0, 13.0), (7, 12.0, 13.0), (None, 95.0, 90.0)], "r_id long, x double, y double")
    key = lambda r: tuple((v is not None, v or 0) for v in r)
    first = sorted((tuple(r) for r in S.nearest_within(L, R, "l_id", "r_id", 100.0, cell=1000.0).where("distance < 4 OR distance IS NULL").collect()), key=key)
    assert first == [(None, None, None), (1, 7, 3.0), (4, None, None)]
    alls = sorted((tuple(r) for r in S.nearest_within(L, R.where("r_id = 7"), "l_id", "r_id", 50.0, ties="all").collect()), key=key)
    assert alls == [(None, None, None), (1, 7, 3.0), (1, 7, 3.0), (4, None, None)]


def test_space_time_match_sorts_no_pairs(spark):
    P = spark.createDataFrame([(1, 0.0, 0.0, 5), (2, 900.0, 0.0, 5), (3, 0.0, 1.0, 50)], "p long, x double, y double, t int")
    Z = spark.createDataFrame([(9, 30.0, 0.0, 1, 9), (8, 40.0, 0.0, 1, 9), (7, 1.0, 0.0, 6, 9)], "z long, x double, y double, a int, b int")
    df = S.space_time_match(P, Z, "p", "z", 100.0, "t", "a", "b")
    assert "SortAggregate" not in _plan(df)
    assert sorted((r.p, r.z, r.distance) for r in df.collect()) == [(1, 8, 40.0), (2, None, None), (3, None, None)]


def test_pairs_of_crashes_and_zones_are_not_dealt_again(spark):
    from roadlens.plans import workzones as W
    c = spark.createDataFrame([(1, 0.0, 0.0, True, 3), (2, 5.0, 0.0, True, 4), (3, 1.0, 0.0, False, 5)], "id long, x double, y double, junction boolean, code int")
    z = spark.createDataFrame([(10, 3.0, 4.0), (11, 0.0, 400.0)], "road_event_id long, x double, y double")
    pairs = W.match_crashes_to_workzones(c, z)
    assert sorted((r.id, r.road_event_id, r.distance, r.code) for r in pairs.select("id", "road_event_id", "distance", "code").collect() if r.road_event_id == 10) == [
        (1, 10, 5.0, 3), (2, 10, math.hypot(2, 4), 4)]
    joins = [at for at in range(len(_plan(pairs))) if _plan(pairs).startswith("Join ", at)]
    assert "_cx" in _plan(pairs)[joins[0]:joins[0] + 80]  # the join by cell comes last: no pair is shuffled for another


def test_pairs_are_spread_over_all_tasks(spark):
    # few bytes on both sides, but many pairs: they must not be listed by one or two tasks
    L, _ = _points(spark, 300, 10, "l")
    R, _ = _points(spark, 300, 11, "r")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "5")
    try:
        pairs = S.within_pairs(L, R, "l_id", "r_id", 100.0)
        assert pairs.select(F.spark_partition_id().alias("p")).distinct().count() == 5
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_rounding_many_equals_bround(spark):
    from roadlens.catalog.base import r6, r_many
    values = [0.0, -0.0, 0.0005, 0.0015, 0.0025, 1.0005, 2.6745, 499.9995, 12.3455, 1e6, 1e12, 1e300, -3.1415, -0.0004, float("inf"), float("nan"), None]
    values += [math.sqrt(i) for i in range(3000)] + [i / 2000 for i in range(3000)] + [math.nextafter(i / 2000, 9e9) for i in range(3000)]
    rows = spark.createDataFrame([(v,) for v in values], "d double").select(r6("d", 3).alias("a"), r_many("d", 3).alias("b")).collect()
    assert [repr(r.a) for r in rows] == [repr(r.b) for r in rows]


def test_pairs_at_the_radius_and_without_a_place(spark):
    rows = [(1, 0.0, 0.0), (2, float("nan"), 0.0), (3, None, 0.0), (4, float("inf"), 0.0)]
    L = spark.createDataFrame(rows, "l_id long, x double, y double")
    R = spark.createDataFrame([(10, 30.0, 40.0), (11, 30.0, math.nextafter(40.0, 41)), (12, 30.0, math.nextafter(40.0, 39)), (13, 0.0, 0.0)] + [(i + 20, x, y) for i, x, y in rows[1:3]],
                              "r_id long, x double, y double")
    got = {(r.l_id, r.r_id) for r in S.within_pairs(L, R, "l_id", "r_id", 50.0).collect()}
    exact = {k for k, x, y in [(10, 30.0, 40.0), (11, 30.0, math.nextafter(40.0, 41)), (12, 30.0, math.nextafter(40.0, 39)), (13, 0.0, 0.0)] if math.sqrt(x ** 2 + y ** 2) <= 50.0}
    assert got == {(1, k) for k in exact}
