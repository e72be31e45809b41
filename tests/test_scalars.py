"""Edge rows for the scalar quirks (FIXTURES.md part C)."""
import math

from pyspark.sql import functions as F

from roadlens.functions import cleaning as D
from roadlens.functions import features as E
from roadlens.functions import temporal as T
from roadlens.functions.binning import TRAINING, bin_right_closed, profile_bin


def test_bin_right_closed_edges(spark):
    # Q1: (a, b], lowest edge excluded, out of range / null / NaN -> null
    df = spark.createDataFrame([(v,) for v in [-1.0, 0.0, 0.5, 2.0, 2.0001, 4.0, 10.0, 10.5, None, math.nan]], "v double")
    out = df.select("v", bin_right_closed("v", [0, 2, 4, 10], ["a", "b", "c"]).alias("b")).collect()
    got = {(None if r.v is None else ("nan" if math.isnan(r.v) else r.v)): r.b for r in out}
    assert got == {-1.0: None, 0.0: None, 0.5: "a", 2.0: "a", 2.0001: "b", 4.0: "b", 10.0: "c", 10.5: None,
                   None: None, "nan": None}


def test_temperature_profiles_differ(spark):
    # Q15: training bins are right-closed with 90, serving uses < 85
    df = spark.createDataFrame([(85.0,), (90.0,), (32.0,)], "t double")
    r = df.select(bin_right_closed("t", *TRAINING["temp"]).alias("tr"), profile_bin("t", "temp", "serving").alias("sv")).collect()
    assert [(x.tr, x.sv) for x in r] == [("warm", "hot"), ("warm", "hot"), ("freezing", "cold")]


def test_weather_text(spark):
    # Q3: null -> clear, order rain, snow, fog, cloudy; 'Police' contains 'ice'
    rows = [(None,), ("",), ("RAIN / Snow",), ("Misty",), ("Overcast",), ("Police",), ("Fair",)]
    df = spark.createDataFrame(rows, "w string")
    got = [r[0] for r in df.select(E.weather_category("w")).collect()]
    assert got == ["clear", "clear", "rain", "fog", "cloudy", "snow", "clear"]


def test_numeric_text(spark):
    rows = [("NULL",), ("[5E-1]",), ("−3.5",), ("12abc",), (" 7 ",), (None,)]
    df = spark.createDataFrame(rows, "s string")
    r = df.select(D.to_numeric_null_token("s").alias("a"), D.strip_brackets_to_number("s").alias("b"),
                  D.scrub_numeric_text("s").alias("c"), D.safe_number("s", -1.0).alias("d")).collect()
    assert [x.a for x in r] == [None, None, None, None, 7.0, None]
    assert [x.b for x in r][1] == 0.5
    assert [x.c for x in r][2] == -3.5 and [x.c for x in r][3] == 12.0
    assert [x.d for x in r] == [-1.0, -1.0, -1.0, -1.0, 7.0, -1.0]


def test_junction_notnull_counts_false(spark):
    # Q4
    df = spark.createDataFrame([(None,), (False,), (True,)], "j boolean")
    r = df.select(E.notnull_flag("j").alias("a"), E.notnull_flag("j", "true").alias("b")).collect()
    assert [(x.a, x.b) for x in r] == [(0, 0), (1, 0), (1, 1)]


def test_weekday_monday_zero(spark):
    # Q20: 2024-01-01 is a Monday
    df = spark.createDataFrame([("2024-01-01 10:00:00",), ("2024-01-06 23:59:00",)], "s string").select(
        F.to_timestamp_ntz("s").alias("t"))
    r = df.select(*[v.alias(k) for k, v in T.calendar("t").items()]).collect()
    assert (r[0].day_of_week, r[0].is_weekend) == (0, 0) and (r[1].day_of_week, r[1].is_weekend) == (5, 1)


def test_duration_days_floors(spark):
    df = spark.createDataFrame([("2024-01-01 23:00:00", "2024-01-02 01:00:00"), ("2024-01-02 01:00:00", "2024-01-01 23:00:00")],
                               "a string, b string").select(F.to_timestamp_ntz("a").alias("a"), F.to_timestamp_ntz("b").alias("b"))
    r = df.select(T.duration_days("b", "a").alias("d")).collect()
    assert [x.d for x in r] == [0, -1]


def test_rates_zero_denominators(spark):
    # Q14: zero lanes -> null lane risk instead of inf; zero VMT -> rate 0
    df = spark.createDataFrame([(1000.0, 10.0, "some-lanes-closed", 0), (None, 10.0, "some-lanes-closed", 2)],
                               "aadt double, days double, impact string, lanes int")
    r = df.select(E.traffic_risk("aadt", "days", "impact", "lanes")["lane_closure_risk"].alias("l")).collect()
    assert r[0].l is None and r[1].l is None
    v = spark.createDataFrame([(0.0, 1.0, 3, 1)], "aadt double, miles double, c long, h long")
    rr = v.select(E.vmt_and_rates("aadt", "miles", "c", "h")["crash_rate_per_100m_vmt"].alias("r")).first()
    assert rr.r == 0.0


def test_rule_score_clipped(spark):
    df = spark.createDataFrame([(1, 1, 23, 1, 1, 80.0, 90000.0)], "a int, l int, h int, r int, w int, s double, t double")
    assert df.select(E.rule_severity_score("a", "l", "h", "r", "w", "s", "t")).first()[0] == 1.0


def test_lighting_boundaries(spark):
    import datetime as dt
    base = dt.datetime(2023, 1, 15, 12, 0)
    m = lambda k: base + dt.timedelta(minutes=k)
    sun = (m(0), m(600), m(-25), m(625), m(-55), m(655), m(-85), m(685))
    times = [m(0), m(600), m(-1), m(601), m(-25), m(625), m(-30), m(-86), None]
    rows = [(t, *sun) for t in times]
    df = spark.createDataFrame(rows, "t timestamp_ntz, sr timestamp_ntz, ss timestamp_ntz, cb timestamp_ntz, ce timestamp_ntz, "
                                     "nb timestamp_ntz, ne timestamp_ntz, ab timestamp_ntz, ae timestamp_ntz")
    c = [r[0] for r in df.select(T.lighting_condition("t", "sr", "ss", "cb", "ce", "nb", "ne", "ab", "ae")).collect()]
    assert c == ["daylight", "daylight", "civil_twilight_dawn", "civil_twilight_dusk", "civil_twilight_dawn",
                 "civil_twilight_dusk", "nautical_twilight_dawn", "dark", "unknown"]


def test_mix_of_large_and_negative_keys(spark):
    from roadlens.operators import splits
    df = spark.createDataFrame([(10 ** 15,), (2 ** 63 - 1,), (-1,), (-2,), (3_500_000_000,)], "k long")
    folds = [r.fold for r in splits.group_kfold(df, "k", 5, salt=3).collect()]
    assert all(0 <= f < 5 for f in folds)


def test_roc_auc_of_large_counts(spark):
    from pyspark.sql import functions as F
    from roadlens.operators import evaluate
    big = spark.range(2).select(F.col("id").alias("score"), F.when(F.col("id") == 1, 10 ** 10).otherwise(0).alias("pos"),
                                F.when(F.col("id") == 0, 10 ** 10).otherwise(0).alias("neg"))
    real, evaluate.score_table = evaluate.score_table, lambda *a: big
    try:
        assert evaluate.roc_auc(big, "y", "p").first().auc == 1.0
    finally:
        evaluate.score_table = real


def test_combine_pages_reads_past_a_short_page(spark):
    from roadlens.sources import readers
    path = readers.shared_dir(spark, "t-pages")
    rows = [(p, i) for p, n in enumerate((5, 2, 5)) for i in range(n)]
    spark.createDataFrame(rows, "page int, i int").write.partitionBy("page").parquet(path)
    assert readers.combine_pages(spark, path).count() == 12


def test_numbers_of_text_and_words_are_those_of_a_cast(spark):
    from roadlens.functions import cleaning as D
    texts = ["NULL", "null", "", " ", "3", " 4.5 ", "-1e3", "+7", ".5", "NaN", "nan", "nAn ", " nan", "nanx", "inf", "-Infinity", "INF", "infinite", "1d", "2f", "0x1p3", "abc", "Zed",
             "n", "N/A", "é1", "1é", "\t8", "e5", "d", "f1", None]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    own = D.safe_number("s", -1.0)
    rows = df.select(own.alias("a"), F.coalesce(F.col("s").try_cast("double"), F.lit(-1.0)).alias("b")).collect()
    assert [repr(r.a) for r in rows] == [repr(r.b) for r in rows]
    assert "CASE WHEN" in df.select(own)._jdf.queryExecution().optimizedPlan().toString()  # words are not parsed


def test_zone_sums_parse_no_numbers(spark):
    from roadlens.plans import workzones as W
    pairs = spark.createDataFrame([(1, 4, 3.0, "2", 5), (1, 1, 5.0, "NULL", None), (1, 9, 7.0, None, 2)], "road_event_id long, severity int, distance double, d string, i long")
    s = W.zone_crash_stats(pairs, deaths="d", injuries="i")
    r = s.first()
    assert (r.crash_count, r.death_cnt_sum, r.injury_cnt_sum, r.distance_mean) == (3, 2.0, 7.0, 5.0)
    assert "try_cast(cast(i" not in s._jdf.queryExecution().optimizedPlan().toString()
