"""Ranking operators."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from closepass.functions.numeric import dround, mix_key
from closepass.functions.risk import raw_risk_score, risk_category, risk_score
from closepass.operators.reports import (
    IDENTITY,
    TIES,
    asc,
    discovery_columns,
    named,
    not_null,
    top_rows,
)
from closepass.schema import present


def distance_rank_with_size_percentile(df: DataFrame, limit: int = 25) -> DataFrame:
    """Nearest rows, their position, and the ``percent_rank`` of h (falling) over all rows.

    A global ``percent_rank`` window would sort the whole table in one task.  Only
    ``limit`` rows are reported, so rows are counted per value of h, map-side first,
    and every value is added to the largest reported h below it: at most
    ``limit + 1`` counters.  The percentile of a reported h is then the rows above it
    over all rows less one.
    """
    rows = df.filter(not_null("h", "dist"))
    nearest = top_rows(rows, named(rows, "des", "h", "dist", "v_rel"), [asc("dist")], limit, TIES)
    # At most ``limit`` rows, taken once: their values of h are the marks, and they are the result.
    position = F.row_number().over(Window.orderBy(*[asc(c) for c in ("dist", *TIES)]))
    placed = nearest.select("*", position.cast("bigint").alias("distance_rank"))
    top = placed.agg(F.collect_list(F.struct(*placed.columns)).alias("t")).scalar()
    below = F.expr("array_max(transform(filter(__top, t -> t.h < h), t -> t.h))")
    counters = (
        rows.groupBy("h")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("__top", top)
        .groupBy(below.alias("mark"))
        .agg(F.sum("n").alias("n"))
        .agg(F.collect_list(F.struct("mark", "n")).alias("__counters"))
    )
    everything = "aggregate(__counters, 0L, (t, c) -> t + c.n)"
    above = "aggregate(filter(__counters, c -> c.mark >= h), 0L, (t, c) -> t + c.n)"
    percentile = f"coalesce(try_divide(CAST({above} AS double), {everything} - 1), 0D)"
    return (
        counters.withColumn("__top", top)
        .select("__counters", F.inline("__top"))
        .select("*", F.expr(percentile).alias("size_percentile"))
        .drop("__counters")
    )


def best_per_object(df: DataFrame, ordered: bool = True) -> DataFrame:
    """The approach of the highest unrounded score of every object.

    ``row_number = 1`` lets Spark keep one row per object and task before the
    shuffle, so an object with very many approaches is no hot spot.
    """
    rows = df.filter(not_null("h", "dist", "v_rel"))
    ties = [F.col(n).asc_nulls_last() for n in ("h", "dist", "v_rel", "cd")]
    w = Window.partitionBy("des").orderBy(F.desc("__raw"), *ties)
    best = (
        rows.select(*present(rows, "des", "fullname", "h", "dist", "v_rel", "cd"))
        .withColumn("__raw", raw_risk_score())
        .withColumn("__rn", F.row_number().over(w))
        .filter("__rn = 1")
    )
    outputs = {
        **named(rows, "des", "fullname", "h"),
        "distance_au": dround("dist", 6),
        "velocity_kms": dround("v_rel", 2),
        "approach_date": F.col("cd"),
        "risk_score": risk_score(),
        "risk_category": risk_category(),
    }
    best = best.select(*[c.alias(n) for n, c in outputs.items()])
    return best.orderBy(F.desc("risk_score"), "des") if ordered else best


def discovery_sample(
    df: DataFrame,
    per_year: int = 50,
    first_year: int = 1900,
    last_year: int = 2100,
    seed: int = 42,
    identity: Sequence[str] = IDENTITY,
) -> DataFrame:
    """Up to ``per_year`` scored rows of every year, chosen in a reproducible random order.

    The small constant quota is applied per task before the shuffle.
    """
    rows = df.filter(
        F.col("approach_year").between(first_year, last_year) & not_null("h", "dist", "v_rel")
    )
    keyed = rows.select(
        *TIES,
        "approach_year",
        mix_key(rows, present(rows, *identity), seed).alias("__key"),
    )
    w = Window.partitionBy("approach_year").orderBy("__key", *[asc(n) for n in TIES])
    return (
        keyed.withColumn("__rn", F.row_number().over(w))
        .filter(F.col("__rn") <= per_year)
        .select(*[c.alias(n) for n, c in discovery_columns().items()])
        .orderBy("year", F.desc("risk_score"), "object_name")
    )


def top_per_segment(risk_rows: DataFrame, limit: int = 8) -> DataFrame:
    """Highest scores of every segment."""
    ties = [F.col(n).asc_nulls_last() for n in ("des", "distance_au", "approach_year")]
    w = Window.partitionBy("segment").orderBy(F.desc("risk_score"), *ties)
    return (
        risk_rows.filter(F.col("segment").isNotNull())
        .withColumn("position", F.row_number().over(w).cast("bigint"))
        .filter(F.col("position") <= limit)
        .select("segment", "position", "des", "risk_score", "risk_category")
    )
