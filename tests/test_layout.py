"""Tables read by their footers, and a layout that leaves out row groups."""

import datetime

import pytest
from pyspark.sql import functions as F

from closepass.operators import reports
from closepass.sinks.files import morton, save_clustered
from closepass.sources.files import read_parquet
from closepass.sources.footers import footer_summary


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_footers_tell_counts_and_extremes(spark, tmp_path):
    rows = [(k, k % 7 - 3 if k % 5 else None, datetime.date(2000, 1, 1 + k % 28), float(k), f"t{k}", 2000 + k % 3) for k in range(1000)]
    df = spark.createDataFrame(rows, "id long, n int, day date, x double, t string, year int").repartition(4)
    df.write.partitionBy("year").parquet(str(tmp_path / "t"))
    whole = footer_summary(spark, str(tmp_path / "t"), ["id", "n", "day"])
    assert "PushedAggregation: [COUNT(*), MIN(id)" in plan(whole)
    assert tuple(whole.first()) == (1000, 0, 999, -3, 3, datetime.date(2000, 1, 1), datetime.date(2000, 1, 28))
    years = footer_summary(spark, str(tmp_path / "t"), ["n"], by="year")
    assert "PushedGroupBy: [year]" in plan(years)
    expected = df.groupBy("year").agg(F.count("*"), F.min("n"), F.max("n")).collect()
    assert sorted(map(tuple, years.collect())) == sorted(map(tuple, expected))
    # a footer leaves NaN out or not by its place, so it is not asked
    nan = spark.createDataFrame([(1.0,), (float("nan"),)], "x double")
    nan.coalesce(1).write.parquet(str(tmp_path / "nan"))
    with pytest.raises(ValueError, match="No exact extremes of x"):
        footer_summary(spark, str(tmp_path / "nan"), ["x"])
    assert footer_summary(spark, str(tmp_path / "nan")).first()["n"] == 2
    df.select("n").where("false").write.parquet(str(tmp_path / "none"))
    assert tuple(footer_summary(spark, str(tmp_path / "none"), ["n"]).first()) == (0, None, None)
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_morton_order(spark):
    grid = spark.range(64).select((F.col("id") % 8).cast("int").alias("a"), F.floor(F.col("id") / 8).cast("int").alias("b"))
    got = {(r.a, r.b): r.z for r in grid.select("a", "b", morton([F.col("a"), F.col("b")], 3).alias("z")).collect()}
    assert sorted(got.values()) == list(range(64))
    for (a, b), z in got.items():
        assert z == sum(((a >> k & 1) << (2 * k + 1)) | ((b >> k & 1) << 2 * k) for k in range(3))


def rows_read(df) -> int:
    """Rows that the scans of a query gave to it, after row groups were left out."""
    df._jdf.collectToPython()
    final = df._jdf.queryExecution().executedPlan()
    leaves = []

    def walk(node):
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            return walk(node.executedPlan())
        if "QueryStage" in name:
            return walk(node.plan())
        if name.startswith("Scan"):
            leaves.append(node.metrics().apply("numOutputRows").value())
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(final)
    return sum(leaves)


def test_clustered_tables_leave_out_row_groups(spark, approaches, tmp_path):
    rows = approaches.unionByName(approaches.withColumn("des", F.concat(F.lit("x"), "des")))
    path = save_clustered(rows, str(tmp_path / "t"), row_group_bytes=4096)
    table = read_parquet(spark, path)
    n = rows.count()
    assert table.count() == n
    for query in (reports.dangerous_objects, lambda df: df.filter("h < 17 AND dist < 0.1"), lambda df: df.filter("des = 'x17'")):
        got = query(table)
        assert sorted(map(str, got.select("des", "dist").collect())) == sorted(map(str, query(rows).select("des", "dist").collect()))
        assert rows_read(got) * 3 < n
