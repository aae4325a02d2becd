"""Scores, categories, reports, rankings and chart data on small tables."""

import pytest
from pyspark.sql import Row, Window
from pyspark.sql import functions as F

from closepass.functions import numeric, risk
from closepass.operators import aggregates as agg
from closepass.operators import charts, ranking, reports

EMPTY = "des string, fullname string, h double, dist double, v_rel double, cd timestamp_ntz, approach_year long"


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).cast("double").alias(k) for k, v in values.items()])
    return df.select(column.alias("x")).first()["x"]


def capped(spark, h, dist, v):
    return one(spark, risk.capped_risk_score(), h=h, dist=dist, v_rel=v)


def test_capped_score(spark):
    # each part alone, at the value where it ends
    assert capped(spark, 30, 0.1, 0) == capped(spark, 31, 2.0, 0) == 0.0
    assert capped(spark, 29, 0.1, 0) == 1.33 and capped(spark, 30, 0.09, 0) == pytest.approx(4.0)
    assert capped(spark, 30, 0.1, 60) == capped(spark, 30, 0.1, 61) == pytest.approx(19.8)
    assert capped(spark, -50, 0.05, 1) == 100.0 < one(spark, risk.risk_score(), h=-50, dist=0.05, v_rel=1)
    for hole in ((None, 0.01, 3), (12, None, 3), (12, 0.01, None), (float("nan"), 0.01, 3)):
        assert capped(spark, *hole) == 0.0


def test_score_value(spark):
    # (30 - 21.5) * 1.33 + (0.1 - 0.0625) * 400 + 44 * 0.33
    assert one(spark, risk.risk_score(), h=21.5, dist=0.0625, v_rel=44.0) == pytest.approx(40.83, abs=0.011)


def test_sql_function_equals_column(spark, approaches):
    name = risk.register_sql_functions(spark)
    rows = approaches.select(
        F.expr(f"{name}(h, dist, v_rel)").alias("a"), risk.capped_risk_score().alias("b")
    )
    assert rows.filter(~F.col("a").eqNullSafe(F.col("b"))).count() == 0


def test_binary_rounding(spark):
    assert one(spark, numeric.dround("x", 2), x=1.005) == 1.0
    assert one(spark, numeric.dround("x", 2), x=2.5) == 2.5
    assert one(spark, numeric.dround("x", 0), x=-2.5) == -3.0
    assert one(spark, numeric.dround("x", 2), x=None) is None


def test_to_number(spark):
    texts = ["1", " -1.5e3 ", ".5", "5.", "+2", "1d", "1.5f", "nan", "inf", "", "0x10", "1_0", None, "1e400", "-1e999"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(numeric.to_number("t")).collect()]
    assert got == [1.0, -1500.0, 0.5, 5.0, 2.0] + [None] * 10


def test_clip_and_segment(spark):
    assert [one(spark, numeric.clip("x", 5, 20), x=v) for v in (1, 7, 50, None)] == [5, 7, 20, None]
    segments = [one(spark, risk.temporal_segment("y"), y=v) for v in (2025, 2026, None)]
    assert segments == ["historical", "future", None]


def test_categories(spark, small):
    rows = {
        r["des"]: (r["a"], r["b"], r["c"], r["d"])
        for r in small.select(
            "des",
            risk.risk_category().alias("a"),
            risk.coarse_risk_category().alias("b"),
            risk.size_category().alias("c"),
            risk.speed_category().alias("d"),
        ).collect()
    }
    assert rows["below18"] == ("VERY_HIGH", "HIGH_RISK", "Very Large (>1km)", "Very Fast (>30 km/s)")
    assert rows["on18"] == ("HIGH", "MEDIUM_RISK", "Large (140m-1km)", "Fast (20-30 km/s)")
    assert rows["on20"] == ("MEDIUM", "LOW_RISK", "Large (140m-1km)", "Moderate (10-20 km/s)")
    assert rows["on22"] == ("LOW", "LOW_RISK", "Medium (30-140m)", "Very Fast (>30 km/s)")
    assert rows["on25"] == ("LOW", "LOW_RISK", "Small (<30m)", "Slow (<10 km/s)")


def test_risky_objects_order(small):
    # the scores are 49.75, 45.95, 22.6, 20.54 and 19.9
    rows = reports.risky_objects(small, 3).collect()
    assert [r["des"] for r in rows] == ["on25", "below18", "on18"]
    assert [r["risk_score"] for r in rows] == pytest.approx([49.75, 45.95, 22.6], abs=0.01)
    assert reports.risky_objects(small, None).count() == 5


def test_distribution_invariants(small):
    for r in agg.yearly_trends(small).collect():
        assert r["closest_approach_au"] <= r["avg_distance_au"] <= r["farthest_approach_au"]
        assert r["unique_objects"] <= r["total_approaches"]
    for r in agg.velocity_distribution(small).collect():
        assert r["min_velocity"] <= r["avg_velocity"] <= r["max_velocity"]
    d = agg.distance_statistics(small).first()
    assert d["closest_ever"] <= d["mean_distance"] <= d["farthest"]
    assert d["median_distance"] == 0.0999
    shares = [r["percentage"] for r in agg.size_share(small).collect()]
    assert sum(shares) == pytest.approx(100, abs=0.2)
    assert [r["size_category"] for r in agg.size_distribution(small).collect()] == [
        "Very Large (>1km)", "Large (140m-1km)", "Medium (30-140m)", "Small (<30m)",
    ]


def test_approximate_median_is_close(approaches):
    exact = agg.distance_statistics(approaches).first()
    rough = agg.distance_statistics(approaches, approximate=True).first()
    assert rough["median_distance"] == pytest.approx(exact["median_distance"], rel=0.01)
    assert exact.asDict().keys() == rough.asDict().keys()


def test_trend_stats_ties(spark):
    rows = [(f"d{i}", y) for y, n in ((2000, 3), (2001, 5), (2002, 5), (2003, 1)) for i in range(n)]
    df = spark.createDataFrame(rows, "des string, approach_year long")
    r = agg.trend_stats(df, recent=2).first()
    assert (r["avg_approaches_recent"], r["peak_year"]) == (3.0, 2002)


def test_null_profile_and_completeness(spark):
    df = spark.createDataFrame([("", 1.0, None, 2.0), (None, None, None, 2.0)], "des string, h double, dist double, v_rel double")
    profile = {r[0]: (r[1], r[2]) for r in agg.null_profile(df).collect()}
    assert profile == {"des": (1, 50.0), "h": (1, 50.0), "dist": (2, 100.0), "v_rel": (0, 0.0)}
    filled = {r[0]: (r[2], r[3]) for r in agg.completeness(df).collect()}
    assert filled == {"des": (0, 0.0), "h": (1, 50.0), "dist": (0, 0.0), "v_rel": (2, 100.0)}


def test_completeness_equals_union_of_counts(approaches):
    parts = None
    for c in ("des", "h", "dist", "v_rel"):
        filled = F.col(c).isNotNull() & (F.col(c) != "") if c == "des" else F.col(c).isNotNull()
        part = approaches.agg(
            F.lit(c).alias("column_name"),
            F.count("*").alias("total_count"),
            F.count(F.when(filled, 1)).alias("non_null_count"),
        )
        parts = part if parts is None else parts.unionByName(part)
    got = agg.completeness(approaches).drop("completeness_pct")
    assert sorted(got.collect()) == sorted(parts.collect())


def test_repeat_approaches_equal_self_join(spark, approaches):
    odd = spark.createDataFrame(
        [("one", 1.0, 0.1), ("no_h", None, 0.1), ("no_h", None, 0.2), ("mixed", None, 0.1),
         ("mixed", 2.0, 0.3), (None, 1.0, 0.1), (None, 1.0, 0.2)],
        "des string, h double, dist double",
    )
    df = approaches.select("des", "h", "dist").unionByName(odd)
    a, b = df.alias("a"), df.alias("b")
    joined = (
        a.join(b, F.col("a.des") == F.col("b.des"))
        .filter("a.h IS NOT NULL")
        .groupBy("a.des")
        .agg(F.count("a.des").alias("approaches"), F.min("a.dist").alias("closest"))
        .filter("approaches > 1")
    )
    assert sorted(agg.repeat_approaches(df).collect()) == sorted(joined.collect())


def test_percent_rank_equals_window(spark, approaches):
    rows = approaches.filter("h IS NOT NULL AND dist IS NOT NULL")
    expected = (
        rows.withColumn("p", F.percent_rank().over(Window.orderBy(F.desc("h"))))
        .orderBy("dist", "des", "h", "v_rel")
        .limit(40)
        .collect()
    )
    got = ranking.distance_rank_with_size_percentile(approaches, 40).orderBy("distance_rank").collect()
    assert [r["size_percentile"] for r in got] == [r["p"] for r in expected]
    assert [r["distance_rank"] for r in got] == list(range(1, 41))
    single = ranking.distance_rank_with_size_percentile(rows.limit(1)).first()
    assert (single["distance_rank"], single["size_percentile"]) == (1, 0.0)


def test_best_per_object(spark):
    rows = [("a", 20.0, 0.2, 10.0, 2000), ("a", 20.0, 0.05, 10.0, 2001), ("b", 22.0, 0.3, 5.0, 1999)]
    df = spark.createDataFrame(rows * 50, "des string, h double, dist double, v_rel double, approach_year long").withColumn(
        "cd", F.make_timestamp_ntz("approach_year", F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    )
    got = ranking.best_per_object(df).collect()
    assert [(r["des"], r["distance_au"]) for r in got] == [("a", 0.05), ("b", 0.3)]


def test_record_holders_keep_ties(spark):
    df = spark.createDataFrame(
        [("a", 10.0, 0.1, 5.0), ("b", 10.0, 0.2, 9.0), ("c", None, 0.1, 9.0)],
        "des string, h double, dist double, v_rel double",
    ).withColumn("cd", F.lit("2000-01-01").cast("timestamp_ntz"))
    got = sorted((r["record_type"], r["des"], r["velocity_kms"]) for r in reports.record_holders(df).collect())
    assert got == [
        ("Closest Approach", "a", 5.0), ("Closest Approach", "c", 9.0),
        ("Fastest Object", "b", 9.0), ("Fastest Object", "c", 9.0),
        ("Largest Object", "a", 10.0), ("Largest Object", "b", 10.0),
    ]


def test_source_window_limit(spark, approaches):
    rows = approaches.drop("fullname")
    got = reports.limited_source_window(rows, 200).collect()
    dates = [r["cd"] for r in got]
    assert len(got) == 200 and dates == sorted(dates)
    first = rows.filter("dist <= 0.2").orderBy("cd").limit(200).select("cd").collect()
    assert dates == [r["cd"] for r in first]


def test_histogram(spark):
    df = spark.createDataFrame([(0.0,), (0.1,), (0.95,), (1.0,), (None,)], "x double")
    rows = charts.histogram(df, "x", 10).orderBy("bin").collect()
    assert [r["count"] for r in rows] == [1, 1, 0, 0, 0, 0, 0, 0, 0, 2]
    assert rows[0]["low"] == 0.0 and rows[-1]["high"] == pytest.approx(1.0)
    same = charts.histogram(spark.createDataFrame([(3.0,)] * 4, "x double"), "x", 4).orderBy("bin")
    assert [(r["low"], r["count"]) for r in same.collect()] == [(2.5, 0), (2.75, 0), (3.0, 4), (3.25, 0)]
    assert charts.histogram(spark.createDataFrame([], "x double"), "x", 4).count() == 0


def test_cumulative_frames(spark):
    df = spark.createDataFrame([(2000, "LOW"), (2000, "HIGH"), (2002, "LOW"), (None, "LOW")], "year long, risk_category string")
    got = {(r[0], r[1]): r[2] for r in charts.cumulative_frames(df).collect()}
    assert got[(2000, "LOW")] == 1 and got[(2002, "LOW")] == 2
    assert got[(2002, "HIGH")] == 1 and got[(2002, "VERY_HIGH")] == 0
    assert len(got) == 8
    assert charts.frame(df, 2000).count() == 2


def test_segments(spark):
    rows = [("historical", 2000 + i % 3, 40.0 + i) for i in range(20)] + [("future", 2030, 90.0)]
    df = spark.createDataFrame(rows, "segment string, approach_year long, risk_score double")
    r = agg.segment_comparison(df).first()
    assert (r["historical_high_risk"], r["future_high_risk"], r["risk_trend"]) == (9, 1, "Increasing")
    assert agg.segment_comparison(df.filter("segment = 'future'")).count() == 0
    assert {x["segment"] for x in agg.risk_trend(df).collect()} == {"historical"}


def test_measure_stats_single_value(spark):
    df = spark.createDataFrame([("a", 2.0), ("b", 1.0), ("b", 4.0)], "k string, x double")
    got = {r["k"]: r for r in agg.measure_stats(df, "x", ["k"]).collect()}
    assert (got["a"]["std"], got["a"]["median"], got["a"]["n"]) == (0.0, 2.0, 1)
    assert (got["b"]["mean"], got["b"]["median"]) == (2.5, 2.5)


def test_group_speedup(spark):
    df = spark.createDataFrame([("csv", 4.0), ("csv", 6.0), ("parquet", 1.0)], "format string, mean_time double")
    got = [tuple(r) for r in agg.group_speedup(df, "format", "mean_time", "csv").orderBy("rank").collect()]
    assert got == [("parquet", 1.0, 1, 5.0, 5.0), ("csv", 5.0, 2, 1.0, 5.0)]


def test_empty_table(spark):
    df = spark.createDataFrame([], EMPTY)
    for operator in (
        reports.risky_objects, reports.dangerous_objects, reports.record_holders,
        ranking.best_per_object, ranking.distance_rank_with_size_percentile,
        agg.yearly_trends, agg.size_distribution, agg.velocity_distribution,
        agg.monthly_distribution, agg.repeat_approaches, agg.size_share,
    ):
        assert operator(df).count() == 0
    assert agg.data_quality(df).first()["total_records"] == 0
    assert agg.completeness(df).first()["completeness_pct"] is None
    assert agg.distance_statistics(df).first()["median_distance"] is None


def test_rows_are_rows(small):
    assert isinstance(reports.nearest(small, 1).first(), Row)
