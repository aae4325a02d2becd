"""Selection by counting against brute force, with heavily repeated keys and rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from closepass.functions.numeric import hash_key, mix_key
from closepass.operators import sampling
from closepass.operators.selection import exact_quantiles, first_rows


def skewed_values(rng, n):
    """A third of all values is one value; the rest spans signs and magnitudes."""
    values = [0.25] * (n // 3)
    while len(values) < n:
        kind = rng.randrange(5)
        if kind == 0:
            values.append(rng.uniform(-5, 5))
        elif kind == 1:
            values.append(rng.choice([-1, 1]) * 10 ** rng.uniform(-12, 12))
        elif kind == 2:
            values.append(0.0)
        elif kind == 3:
            values.append(float(rng.randrange(10)))
        else:
            values.append(1.0 + rng.randrange(1000) * 2.0**-50)
    rng.shuffle(values)
    return values


@pytest.mark.parametrize("n", [1, 2, 3, 10, 1001, 5000])
def test_quantiles_equal_sorted_positions(spark, n):
    rng = random.Random(n)
    values = skewed_values(rng, n)
    df = spark.createDataFrame([(v,) for v in values], "x double")
    probabilities = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    row = exact_quantiles(df, "x", probabilities).first()
    assert row["n"] == n
    expected = np.quantile(np.array(values), probabilities)
    assert row["quantiles"] == pytest.approx(list(expected), rel=1e-12, abs=1e-300)


@pytest.mark.parametrize("few_groups", [True, False])
def test_grouped_quantiles(spark, few_groups):
    rng = random.Random(7)
    rows = [("hot", v) for v in skewed_values(rng, 3000)]
    rows += [(f"g{i % 20}", rng.gauss(0, 1)) for i in range(1500)] + [(None, 1.5), (None, 2.5)]
    rows += [("hot", None), ("empty", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    found = {r["g"]: r["quantiles"] for r in exact_quantiles(df, "x", [0.5], ["g"], few_groups).collect()}
    groups = {}
    for g, v in rows:
        if v is not None:
            groups.setdefault(g, []).append(v)
    assert found.keys() == groups.keys()
    for g, values in groups.items():
        assert found[g][0] == pytest.approx(float(np.median(values)), rel=1e-12)


def test_quantiles_of_nothing(spark):
    assert exact_quantiles(spark.createDataFrame([], "x double"), "x", [0.5]).first()["n"] is None


def hot_rows(n=6000):
    """A third of the rows are copies of one row, another hot key differs in one column."""
    rng = random.Random(3)
    rows = [("hot", 1.0, 5)] * (n // 3)
    rows += [("key", rng.random(), 6) for _ in range(n // 3)]
    rows += [(f"k{rng.randrange(500)}", rng.random(), rng.randrange(7)) for _ in range(n // 3)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("quota", [0, 1, 17, 2500, 5999, 6000, 9000])
def test_first_rows_equal_sort_and_limit(spark, quota):
    rows = hot_rows()
    df = spark.createDataFrame(rows, "des string, dist double, day int")
    result = first_rows(
        df, levels=[F.col("day"), F.col("des")], order=[F.col("dist")], quota=quota
    )
    expected = sorted(rows, key=lambda r: (r[2], r[0], r[1]))[:quota]
    assert sorted(tuple(r) for r in result.collect()) == sorted(expected)


@pytest.mark.parametrize("few_groups", [True, False])
def test_first_rows_per_group(spark, few_groups):
    rows = hot_rows()
    df = spark.createDataFrame(rows, "des string, dist double, day int")
    result = first_rows(
        df,
        levels=[F.col("des")],
        order=[F.col("dist")],
        quota=lambda total: F.floor(total / 3),
        groups=["day"],
        few_groups=few_groups,
    )
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    expected = []
    for g in groups.values():
        expected += sorted(g, key=lambda r: (r[0], r[1]))[: len(g) // 3]
    assert sorted(tuple(r) for r in result.collect()) == sorted(expected)


def test_random_sample_size_and_determinism(spark):
    df = spark.createDataFrame(hot_rows(), "des string, dist double, day int")
    one = sorted(tuple(r) for r in sampling.sample_random(df, 1000).collect())
    two = sorted(
        tuple(r) for r in sampling.sample_random(df.repartition(13, "dist"), 1000).collect()
    )
    assert len(one) == 1000
    assert one == two
    other = sorted(tuple(r) for r in sampling.sample_random(df, 1000, seed=1).collect())
    assert other != one
    assert sampling.sample_random(df, 10_000).count() == 6000


def test_stratified_sample(spark):
    df = spark.createDataFrame(hot_rows(), "des string, dist double, day int").withColumn(
        "risk_category", F.when(F.col("day") < 3, "LOW").otherwise("HIGH")
    )
    sizes = {r["risk_category"]: r["n"] for r in df.groupBy("risk_category").agg(F.count("*").alias("n")).collect()}
    got = sampling.sample_stratified(df, 4000).groupBy("risk_category").count().collect()
    assert {r[0]: r[1] for r in got} == {c: min(s, 1000) for c, s in sizes.items()}
    assert sampling.sample_stratified(df, 6000).count() == 6000


def test_temporal_sample_and_missing_dates(spark):
    rows = [(f"d{i}", f"{2000 + i % 4}-01-01 00:00:00" if i % 10 else None, float(i)) for i in range(1000)]
    df = spark.createDataFrame(rows, "des string, cd string, dist double").withColumn(
        "cd", F.col("cd").cast("timestamp_ntz")
    )
    got = sampling.sample_temporal(df, 500)
    assert got.columns == ["des", "cd", "dist"]
    counts = {r[0]: r[1] for r in got.groupBy(F.year("cd")).count().collect()}
    assert counts == {2000: 100, 2001: 100, 2002: 100, 2003: 100}
    assert sampling.sample_temporal(df, 1000).count() == 1000


def test_fallbacks_and_unknown_strategy(spark):
    df = spark.createDataFrame(hot_rows(), "des string, dist double, day int")
    assert sampling.sample(df, 100, "stratified").count() == 100
    assert sampling.sample(df, 100, "temporal").count() == 100
    assert sampling.sample(df, 100, "random").count() == 100
    with pytest.raises(ValueError, match="Unknown sampling strategy"):
        sampling.sample(df, 100, "best")


def test_scatter_sample(spark, approaches):
    assert sampling.scatter_sample(approaches, 50).count() == 50
    seeded = sampling.scatter_sample(approaches, 50, seed=1)
    assert seeded.collect() == sampling.scatter_sample(approaches.repartition(5), 50, seed=1).collect()


def test_sampling_key_spreads_rows(approaches):
    key = mix_key(approaches, ["cd", "dist", "v_rel"], seed=42)
    groups = approaches.groupBy(F.shiftright(key, 42).alias("g")).count().collect()
    total = sum(r["count"] for r in groups)
    assert len(groups) == 16
    assert all(abs(r["count"] - total / 16) < 5 * (total / 16) ** 0.5 for r in groups)


@pytest.mark.parametrize(
    "value",
    ["id", "1e12 + id * 1e-3", "id * 1e-15", "timestamp_micros(id)", "timestamp_micros(id * 60000000)", "'t' || id"],
)
def test_sample_is_no_run_of_neighbours(spark, value):
    rows = spark.range(20_000).selectExpr("id", f"{value} AS v").select("v", "id")
    assert rows.select(hash_key(rows, ["v"], 1)).distinct().count() == 20_000
    ids = sorted(r.id for r in sampling.sample_random(rows, 200, identity=["v"]).collect())
    assert len(ids) == 200 and sum(b - a == 1 for a, b in zip(ids, ids[1:])) < 20


def test_sampling_key_of_many_wide_columns(spark):
    wide = spark.range(100).select(*(((F.col("id") - 50) * (2**56) + i).alias(f"c{i}") for i in range(40)))
    assert wide.select(mix_key(wide, wide.columns, 1)).distinct().count() == 100


def test_sampling_key_without_numbers(spark):
    df = spark.createDataFrame([(f"a{i}",) for i in range(2000)], "des string")
    assert sampling.sample_random(df, 100).distinct().count() == 100


def test_sample_is_the_same_in_any_time_zone(spark, approaches):
    rows = approaches.select("des", "orbit_id", "cd", "dist", "v_rel")
    expected = sorted(sampling.sample_random(rows, 200).collect())
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert sorted(sampling.sample_random(rows, 200).collect()) == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
