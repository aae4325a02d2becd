"""Values at the ends: infinite numbers, dates in another session zone, ranks without a global window."""

import datetime

import pytest

from closepass.operators import aggregates as agg
from closepass.operators import charts, cleaning
from closepass.operators.selection import exact_quantiles, ordered_positions


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "x double")


def test_quantiles_with_infinite_values(spark):
    inf = float("inf")
    df = numbers(spark, inf, -inf, 1.0, 2.0, inf, float("nan"), None)
    row = exact_quantiles(df, "x", [0.0, 0.25, 0.5, 1.0]).first()
    assert row["n"] == 5 and row["quantiles"] == [-inf, 1.0, 2.0, inf]


def test_histogram_refuses_values_without_a_bin(spark):
    for odd in (float("inf"), float("nan")):
        with pytest.raises(Exception, match="without a bin"):
            charts.histogram(numbers(spark, 1.0, odd), "x", 4).collect()


def test_dates_do_not_depend_on_the_session_zone(spark):
    df = spark.createDataFrame(
        [("2024-Mar-10 02:30",), ("2023-FEB-3 7:05",), ("2024-Feb-30 01:00",), ("2024-Foo-01 01:00",), ("bad",), (None,)],
        "cd string",
    )
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = [r[0] for r in df.select(cleaning.parse_date("cd")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == [datetime.datetime(2024, 3, 10, 2, 30), datetime.datetime(2023, 2, 3, 7, 5), None, None, None, None]


def test_positions(spark):
    values = [3.5, None, -2.0, 0.0, float("inf"), 3.5, float("-inf"), float("nan"), 3.5000001]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, x double")
    got = {r["i"]: r["p"] for r in ordered_positions(df, "x", ["i"], "p").collect()}
    assert [i for i, _ in sorted(got.items(), key=lambda e: e[1])] == [1, 6, 2, 3, 0, 5, 8, 4, 7]
    assert sorted(got.values()) == list(range(1, 10))


def test_sketches_on_few_values_are_exact(spark):
    df = spark.createDataFrame([("a", float(i)) for i in range(1, 102)] + [("b", 5.0)], "g string, x double")
    box = {r["g"]: r for r in agg.box_summary(df, "x", "g", approximate=True).collect()}
    assert tuple(box["a"])[1:] == (1.0, 26.0, 51.0, 76.0, 101.0, 101)
    stats = {r["g"]: r for r in agg.measure_stats(df, "x", ["g"], approximate=True).collect()}
    assert (stats["a"]["median"], stats["b"]["std"], stats["b"]["n"]) == (51.0, 0.0, 1)


def test_pivot_keeps_other_columns_in_one(spark):
    df = spark.createDataFrame([("a", 1, 2.0), ("a", 2, 4.0), ("a", None, 6.0)], "g string, y long, x double")
    row = agg.pivot_mean(df, "g", "y", [1, 3], "x").first()
    assert tuple(row) == ("a", 2.0, None, 5.0)
