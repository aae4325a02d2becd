"""Tables compared, looked at as of a time, counted by sketches, binned in round widths."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from closepass.operators import aggregates as agg
from closepass.operators import versions
from closepass.operators.charts import rounded_histogram
from closepass.operators.comparison import row_differences, same_rows
from closepass.operators.selection import exact_quantiles

NAN = float("nan")
ROWS = [("a", 1.0, 1), ("a", 1.0, 1), (None, None, 2), ("", None, 2), ("b", NAN, None), ("b", 0.0, None)]
KIND = "t string, x double, n int"


def test_same_rows(spark):
    a = spark.createDataFrame(ROWS, KIND)
    turned = spark.createDataFrame([("b", -0.0, None) if r == ("b", 0.0, None) else r for r in ROWS[::-1]], KIND)
    assert same_rows(a, turned.select("n", "x", "t").repartition(3)) and row_differences(a, turned).count() == 0
    for k, other in enumerate([("a", 1.0, 2), ("", 1.0, 1), (None, None, 1), ("a", NAN, 1)]):
        b = spark.createDataFrame([other, *ROWS[1:]], KIND)
        assert not same_rows(a, b), k
    fewer = spark.createDataFrame(ROWS[1:], KIND)
    assert not same_rows(a, fewer)
    assert [tuple(r) for r in row_differences(a, fewer).collect()] == [("a", 1.0, 1, 2, 1)]
    # NULLs that only change their column, and columns that only change their values
    pair = "x int, y int"
    assert not same_rows(spark.createDataFrame([(None, 1)], pair), spark.createDataFrame([(1, None)], pair))
    assert not same_rows(spark.createDataFrame([(1, 2), (3, 4)], pair), spark.createDataFrame([(1, 4), (3, 2)], pair))
    assert same_rows(a.limit(0), a.limit(0)) and not same_rows(a.limit(0), a)
    with pytest.raises(ValueError, match="Different columns"):
        same_rows(a, a.drop("n"))


def test_as_of_a_time(spark):
    day = lambda d: datetime.datetime(2020, 1, d)
    history = spark.createDataFrame(
        [(1, day(2), ["id", "x"]), (2, day(5), ["id", "x"]), (3, day(9), ["id", "x", "added"])],
        "version int, committed_at timestamp_ntz, columns array<string>",
    )
    rows = spark.createDataFrame([(1, 1.0, None, 1), (2, 2.0, None, 1), (3, 3.0, "z", 3)], "id int, x double, added string, version int")
    assert versions.as_of_time(rows, day(6), history).columns == ["id", "x"]
    assert versions.as_of_time(rows, day(9), history).columns == ["id", "x", "added"]
    assert versions.as_of_time(rows, day(8), history).count() == 2
    with pytest.raises(ValueError, match="No version"):
        versions.as_of_time(rows, day(1), history)
    asked = spark.createDataFrame([(day(d),) for d in (1, 2, 4, 5, 20)] + [(None,)], "time timestamp_ntz")
    got = {r["time"] and r["time"].day: (r["version"], r["records"]) for r in versions.counts_at(rows, asked, history).collect()}
    assert got == {1: (None, 0), 2: (1, 2), 4: (1, 2), 5: (2, 2), 20: (3, 3), None: (None, 0)}


def test_sketches_of_years_merge(spark):
    rows = spark.range(60_000).select(
        (F.col("id") % 20_011).cast("string").alias("des"), (2000 + F.col("id") % 7).alias("approach_year")
    )
    sketches = agg.yearly_sketches(rows)
    ranges = spark.createDataFrame([(2000, 2000), (2001, 2004), (2000, 2006), (1990, 1995), (2004, 2001)], "first_year long, last_year long")
    got = {(r.first_year, r.last_year): r.objects for r in agg.distinct_in_ranges(sketches, ranges).collect()}
    assert set(got) == {(2000, 2000), (2001, 2004), (2000, 2006)}
    for (a, b), estimate in got.items():
        exact = rows.where(F.col("approach_year").between(a, b)).select("des").distinct().count()
        assert abs(estimate - exact) <= exact * agg.SKETCH_ERROR
    assert all(r.rows > 8000 and len(r.sketch) <= 17_000 for r in sketches.collect())


@pytest.mark.parametrize("at_most", [2, 15, 20])
@pytest.mark.parametrize("low,high", [(0.0, 1.0), (-3.7, 912.0), (1e-7, 3e-7), (5.0, 5.0), (-1e6, -0.5e6)])
def test_rounded_bins(spark, low, high, at_most):
    random.seed(1)
    values = [low, high, *(random.uniform(low, high) for _ in range(300))]
    got = rounded_histogram(spark.createDataFrame([(v,) for v in values] + [(None,)], "x double"), "x", at_most).orderBy("bin").collect()
    assert [r.bin for r in got] == list(range(len(got)))
    assert sum(r["count"] for r in got) == len(values)
    assert len(got) <= at_most
    for r in got:
        assert r["count"] == sum(r.low <= v < r.high for v in values)
    if at_most == 20 and high > low:
        assert len(got) >= 8


def test_rounded_bins_of_odd_tables(spark):
    assert rounded_histogram(spark.createDataFrame([(None,)], "x double"), "x", 15).count() == 0
    with pytest.raises(ValueError):
        rounded_histogram(spark.range(1), "id", 1)
    with pytest.raises(Exception, match="Value without a bin"):
        rounded_histogram(spark.createDataFrame([(1.0,), (NAN,)], "x double"), "x", 15).collect()


def test_summaries_merge_over_cells(spark):
    rng = random.Random(2)
    rows = [("a", rng.lognormvariate(0, 3) * rng.choice((-1, 1))) for _ in range(3000)] + [("b", 5.0), ("c", NAN), ("d", 1.0), ("d", NAN), ("e", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {r.g: r for r in exact_quantiles(df, "x", [0.5], ["g"], summary=True, conditions=["__v < 1D"]).collect()}
    plain = df.where("x is not null").groupBy("g").agg(
        F.count("*").alias("rows"), F.avg("x").alias("mean"), F.stddev_samp("x").alias("std"), F.min("x").alias("min"), F.max("x").alias("max"),
        F.count_if(F.col("x") < 1).alias("below"), F.median(F.when(~F.isnan("x"), F.col("x"))).alias("median"),
    )
    want = {r.g: r for r in plain.collect()}
    assert set(got) == set(want)
    for g, r in want.items():
        s = got[g].summary
        assert (s.rows, s.counts) == (r.rows, [r.below])
        mine, theirs = [s.mean, s.min, s.max, s.std, got[g].quantiles[0]], [r.mean, r.min, r.max, r.std, r.median]
        assert [x is None for x in mine] == [x is None for x in theirs]
        assert [x for x in mine if x is not None] == pytest.approx([x for x in theirs if x is not None], rel=1e-12, nan_ok=True)
    assert got["b"].summary.std is None and got["c"].quantiles == [None]
    empty = exact_quantiles(df.limit(0), "x", [0.5], summary=True).first()
    assert empty.summary is None and agg.distance_statistics(df.limit(0).withColumnRenamed("x", "dist")).first()[0] == 0
