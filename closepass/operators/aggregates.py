"""Counts, distributions and statistics.

Categories, years and months are few by construction; rows are combined map-side
before any shuffle, so a year or category that holds most rows costs nothing extra.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from closepass.functions.numeric import count_if, dround, fixed_text, share
from closepass.functions.risk import (
    risk_category,
    risk_score,
    size_category,
    speed_category,
)
from closepass.operators.selection import exact_quantiles, ordered_positions


def _rows() -> Column:
    return F.count(F.lit(1))


# --- counts -------------------------------------------------------------------------


def simple_count(df: DataFrame) -> DataFrame:
    return df.agg(_rows().alias("total_approaches"))


def filtered_count(df: DataFrame, h_below: float = 20.0) -> DataFrame:
    return df.filter(F.col("h") < h_below).agg(_rows().alias("total_approaches"))


def dataset_overview(df: DataFrame) -> DataFrame:
    return df.agg(
        _rows().alias("total_records"),
        F.count_distinct("des").alias("unique_objects"),
        F.min("approach_year").alias("earliest_year"),
        F.max("approach_year").alias("latest_year"),
        F.count("h").alias("records_with_magnitude"),
        F.count("dist").alias("records_with_distance"),
    )


def data_quality(df: DataFrame) -> DataFrame:
    return df.agg(
        _rows().alias("total_records"),
        F.count("des").alias("valid_designations"),
        F.count("h").alias("valid_magnitudes"),
        F.count("dist").alias("valid_distances"),
        F.count("v_rel").alias("valid_velocities"),
        F.count("cd").alias("valid_dates"),
        F.min("approach_year").alias("earliest_year"),
        F.max("approach_year").alias("latest_year"),
    )


def table_stats(df: DataFrame) -> DataFrame:
    """Row count and date range; column names and types are ``df.dtypes``."""
    return df.agg(
        _rows().alias("row_count"), F.min("cd").alias("min_date"), F.max("cd").alias("max_date")
    )


def null_profile(df: DataFrame) -> DataFrame:
    """NULL count and percentage of every column, from one pass."""
    names = df.columns
    one = df.agg(
        _rows().alias("__total"), *[F.count(F.col(c)).alias(f"__v{i}") for i, c in enumerate(names)]
    )
    cells = []
    for i, name in enumerate(names):
        nulls = F.col("__total") - F.col(f"__v{i}")
        cells += [F.lit(name), nulls, share(nulls, F.col("__total"))]
    return one.select(
        F.stack(F.lit(len(names)), *cells).alias("column_name", "null_count", "null_pct")
    )


def completeness(df: DataFrame) -> DataFrame:
    """Filled rows of the four main columns, from one pass; an empty ``des`` is not filled."""
    filled = {
        "des": count_if(F.col("des").isNotNull() & (F.col("des") != "")),
        "h": F.count("h"),
        "dist": F.count("dist"),
        "v_rel": F.count("v_rel"),
    }
    one = df.agg(_rows().alias("__total"), *[c.alias(f"__{n}") for n, c in filled.items()])
    cells = []
    for name in filled:
        have = F.col(f"__{name}")
        cells += [F.lit(name), F.col("__total"), have, share(have, F.col("__total"))]
    return one.select(
        F.stack(F.lit(len(filled)), *cells).alias(
            "column_name", "total_count", "non_null_count", "completeness_pct"
        )
    )


def summary_metrics(df: DataFrame) -> DataFrame:
    """Headline numbers as (metric, value text), from one pass."""
    one = df.agg(
        _rows().alias("total"),
        F.count_distinct("des").alias("objects"),
        F.min("dist").alias("closest"),
        F.min("h").alias("largest"),
        F.max("v_rel").alias("fastest"),
        count_if(F.col("dist") < 0.01).alias("very_close"),
    )
    # Metric names of the report.
    cells = [
        F.lit("Total NEO Approaches"), F.col("total").cast("string"),
        F.lit("Unique Objects"), F.col("objects").cast("string"),
        F.lit("Closest Approach (AU)"), fixed_text(dround("closest", 8), 8),
        F.lit("Largest Object (H mag)"), fixed_text(dround("largest", 2), 2),
        F.lit("Fastest Object (km/s)"), fixed_text(dround("fastest", 2), 2),
        F.lit("Very Close Approaches (<0.01 AU)"), F.col("very_close").cast("string"),
    ]
    return one.select(F.stack(F.lit(6), *cells).alias("metric", "value"))


# --- per year and month -------------------------------------------------------------


def _per_year(df: DataFrame, name: str, metrics: dict[str, Column]) -> DataFrame:
    years = df.filter(F.col("approach_year").isNotNull()).groupBy(
        F.col("approach_year").alias(name)
    )
    return years.agg(*[c.alias(n) for n, c in metrics.items()])


def yearly_counts(df: DataFrame, limit: int = 10) -> DataFrame:
    metrics = {"count": _rows(), "avg_dist": dround(F.avg("dist"), 6)}
    return _per_year(df, "approach_year", metrics).orderBy(F.desc("approach_year")).limit(limit)


def yearly_discoveries(df: DataFrame, limit: int = 20) -> DataFrame:
    metrics = {
        "approaches": _rows(),
        "avg_distance_au": dround(F.avg("dist"), 6),
        "closest_approach_au": dround(F.min("dist"), 6),
        "unique_objects": F.count_distinct("des"),
    }
    return _per_year(df, "year", metrics).orderBy(F.desc("year")).limit(limit)


def yearly_all(df: DataFrame) -> DataFrame:
    """Every year, oldest first."""
    metrics = {
        "total_approaches": _rows(),
        "unique_objects": F.count_distinct("des"),
        "avg_distance": dround(F.avg("dist"), 6),
        "closest_approach": dround(F.min("dist"), 6),
    }
    return _per_year(df, "year", metrics).orderBy("year")


#: Precision of the sketches: 2^14 registers.
SKETCH_BITS = 14
#: Relative error that an estimate stays below in 997 of 1000 cases: three standard errors of 1.04 / sqrt(registers).
SKETCH_ERROR = 3 * 1.04 / 2 ** (SKETCH_BITS / 2)


def yearly_sketches(df: DataFrame, column: str = "des") -> DataFrame:
    """``(year, rows, sketch)``: a mergeable sketch of the distinct values of each year, to be stored.

    A sketch has at most 16 KB, so a table of them answers questions about any range of years without the events.
    """
    sketch = F.hll_sketch_agg(column, SKETCH_BITS).alias("sketch")
    years = df.filter(F.col("approach_year").isNotNull() & F.col(column).isNotNull())
    return years.groupBy(F.col("approach_year").alias("year")).agg(_rows().alias("rows"), sketch)


def distinct_in_ranges(sketches: DataFrame, ranges: DataFrame) -> DataFrame:
    """``ranges`` (first_year, last_year) with the estimated number of distinct values in each; ``SKETCH_ERROR`` bounds it.

    Only ranges that hold a year of the sketches have a row.
    """
    each = F.explode(F.expr("CASE WHEN first_year <= last_year THEN sequence(first_year, last_year) ELSE array() END"))
    years = ranges.select("first_year", "last_year").distinct().select("*", each.alias("__year"))
    inside = years.join(sketches, F.col("__year") == F.col("year"))
    merged = inside.groupBy("first_year", "last_year").agg(F.hll_union_agg("sketch").alias("s"))
    return merged.select("first_year", "last_year", F.hll_sketch_estimate("s").alias("objects"))


def yearly_by_date(df: DataFrame) -> DataFrame:
    """Every year of the date column itself, for tables without ``approach_year``."""
    dated = df.filter(F.col("cd").isNotNull()).withColumn(
        "approach_year", F.year(F.to_date("cd")).cast("bigint")
    )
    return yearly_all(dated)


def years_range(df: DataFrame, first_year: int = 1950, last_year: int = 1970) -> DataFrame:
    rows = df.filter(F.col("approach_year").between(first_year, last_year))
    metrics = {
        "approaches": _rows(),
        "avg_distance": dround(F.avg("dist"), 6),
        "closest_approach": dround(F.min("dist"), 6),
    }
    return _per_year(rows, "approach_year", metrics).orderBy("approach_year")


def yearly_trends(
    df: DataFrame, first_year: int = 1900, last_year: int = 2030, limit: int = 25
) -> DataFrame:
    rows = df.filter(F.col("approach_year").between(first_year, last_year))
    metrics = {
        "total_approaches": _rows(),
        "unique_objects": F.count_distinct("des"),
        "avg_distance_au": dround(F.avg("dist"), 6),
        "closest_approach_au": dround(F.min("dist"), 6),
        "farthest_approach_au": dround(F.max("dist"), 6),
        "avg_velocity_kms": dround(F.avg("v_rel"), 2),
        "avg_magnitude": dround(F.avg("h"), 2),
        "large_objects": count_if(F.col("h") < 22),
        "close_approaches": count_if(F.col("dist") < 0.05),
    }
    return _per_year(rows, "year", metrics).orderBy(F.desc("year")).limit(limit)


def trend_stats(
    df: DataFrame, recent: int = 10, limit: int = 25, first_year: int = 1900, last_year: int = 2030
) -> DataFrame:
    """Mean count of the newest years, and the year of the highest count.

    Among years of equal count the newest wins.
    """
    counts = _per_year(
        df.filter(F.col("approach_year").between(first_year, last_year)), "year", {"total": _rows()}
    )
    newest = counts.orderBy(F.desc("year")).limit(limit)
    position = F.row_number().over(Window.orderBy(F.desc("year")))
    return newest.withColumn("__p", position).agg(
        dround(F.avg(F.when(F.col("__p") <= recent, F.col("total"))), 2).alias(
            "avg_approaches_recent"
        ),
        F.max_by("year", F.struct("total", "year")).alias("peak_year"),
    )


def monthly_distribution(df: DataFrame) -> DataFrame:
    rows = df.filter(F.col("cd").isNotNull())
    return (
        rows.groupBy(F.month(F.to_date("cd")).cast("bigint").alias("month"))
        .agg(
            _rows().alias("approach_count"),
            dround(F.avg("dist"), 6).alias("avg_distance"),
            count_if(F.col("dist") < 0.05).alias("close_approaches"),
        )
        .orderBy("month")
    )


def partition_counts(df: DataFrame) -> DataFrame:
    """Rows per year partition; the number of rows is the partition count."""
    return df.groupBy("approach_year").agg(_rows().alias("records")).orderBy("approach_year")


def partition_scan(df: DataFrame, first_year: int, last_year: int) -> DataFrame:
    """Rows per year of a year range; on a year-partitioned table only those years are read."""
    return partition_counts(df.filter(F.col("approach_year").between(first_year, last_year)))


# --- per category -------------------------------------------------------------------


def _per_category(
    df: DataFrame, name: str, label: Column, metrics: dict[str, Column], order: Column
) -> DataFrame:
    return (
        df.groupBy(label.alias(name))
        .agg(*[c.alias(n) for n, c in metrics.items()], order.alias("__order"))
        .orderBy("__order")
        .drop("__order")
    )


def velocity_distribution(df: DataFrame) -> DataFrame:
    metrics = {
        "object_count": _rows(),
        "min_velocity": dround(F.min("v_rel"), 2),
        "max_velocity": dround(F.max("v_rel"), 2),
        "avg_velocity": dround(F.avg("v_rel"), 2),
        "avg_distance_au": dround(F.avg("dist"), 6),
        "avg_magnitude": dround(F.avg("h"), 2),
        "close_approaches": count_if(F.col("dist") < 0.05),
    }
    rows = df.filter(F.col("v_rel") > 0)
    return _per_category(rows, "velocity_category", speed_category(), metrics, F.min("v_rel"))


def _size_distribution(df: DataFrame, metrics: dict[str, Column]) -> DataFrame:
    rows = df.filter(F.col("h").isNotNull())
    return _per_category(rows, "size_category", size_category(), metrics, F.min("h"))


def size_distribution(df: DataFrame) -> DataFrame:
    return _size_distribution(
        df,
        {
            "object_count": _rows(),
            "closest_ever_au": dround(F.min("dist"), 6),
            "avg_distance_au": dround(F.avg("dist"), 6),
            "avg_velocity_kms": dround(F.avg("v_rel"), 2),
            "brightest_magnitude": dround(F.min("h"), 2),
            "dimmest_magnitude": dround(F.max("h"), 2),
            "close_approaches": count_if(F.col("dist") < 0.05),
        },
    )


def size_distribution_basic(df: DataFrame) -> DataFrame:
    return _size_distribution(
        df,
        {
            "count": _rows(),
            "closest_ever_au": dround(F.min("dist"), 6),
            "avg_velocity_kms": dround(F.avg("v_rel"), 2),
        },
    )


def size_distribution_with_range(df: DataFrame) -> DataFrame:
    return _size_distribution(
        df,
        {
            "count": _rows(),
            "closest_approach_au": dround(F.min("dist"), 6),
            "avg_velocity_kms": dround(F.avg("v_rel"), 2),
            "brightest": dround(F.min("h"), 2),
            "dimmest": dround(F.max("h"), 2),
        },
    )


def size_share(df: DataFrame) -> DataFrame:
    """Percentage of each size category; the window runs over the four category rows."""
    counts = (
        df.filter(F.col("h").isNotNull())
        .groupBy(size_category().alias("size_category"))
        .agg(_rows().alias("object_count"))
    )
    total = F.sum("object_count").over(Window.partitionBy())
    return counts.withColumn("percentage", share(F.col("object_count"), total, 1))


def category_counts(df: DataFrame, column: str = "risk_category") -> DataFrame:
    """Rows per value, most frequent first."""
    return (
        df.groupBy(column)
        .agg(_rows().alias("count"))
        .orderBy(F.desc("count"), F.col(column).asc_nulls_last())
    )


def pivot_mean(
    df: DataFrame, rows: str, columns: str, column_values: Sequence, value: str, digits: int = 6,
    rest: str = "other",
) -> DataFrame:
    """Mean per row label and column value; the values are given, so no job looks them up.

    The column ``rest`` is the mean of the rows with any other value or none.
    """
    names = [str(v) for v in column_values] + [rest]
    label = F.when(F.col(columns).isin(*column_values), F.col(columns).cast("string")).otherwise(rest)
    wide = df.select(rows, label.alias("__label"), value).groupBy(rows).pivot("__label", names).agg(F.avg(value))
    return wide.select(rows, *[dround(F.col(f"`{n}`"), digits).alias(n) for n in names])


# --- statistics ---------------------------------------------------------------------


def distance_statistics(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Distance summary with median and sample deviation.

    The exact median is found by counting (see ``selection``); ``approximate`` takes
    a sketch instead, one scan in all.
    """
    near = {"very_close_approaches": 0.01, "close_approaches": 0.05, "notable_approaches": 0.1}
    if approximate:
        one = df.filter(F.col("dist").isNotNull()).agg(
            F.struct(
                _rows().alias("rows"), F.avg("dist").alias("mean"), F.stddev_samp("dist").alias("std"),
                F.min("dist").alias("min"), F.max("dist").alias("max"),
                F.array(*[count_if(F.col("dist") < limit) for limit in near.values()]).alias("counts"),
            ).alias("summary"),
            F.percentile_approx("dist", 0.5, 10_000).alias("median"),
        )
    else:
        conditions = [f"__v < {limit}D" for limit in near.values()]
        one = exact_quantiles(df, "dist", [0.5], summary=True, conditions=conditions)
        one = one.select("summary", F.col("quantiles")[0].alias("median"))
    return one.select(
        F.coalesce("summary.rows", F.lit(0)).alias("total_approaches"),
        dround(F.col("summary.min"), 8).alias("closest_ever"),
        dround(F.col("summary.max"), 6).alias("farthest"),
        dround(F.col("summary.mean"), 6).alias("mean_distance"),
        dround(F.col("median"), 6).alias("median_distance"),
        dround(F.col("summary.std"), 6).alias("std_distance"),
        *[F.coalesce(F.col("summary.counts")[k], F.lit(0)).alias(n) for k, n in enumerate(near)],
    )


def distance_statistics_short(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Distance summary without the deviation, under its own column names."""
    full = distance_statistics(df, approximate)
    return full.select(
        "total_approaches",
        F.col("closest_ever").alias("closest_approach_au"),
        F.col("farthest").alias("farthest_approach_au"),
        F.col("mean_distance").alias("mean_distance_au"),
        F.col("median_distance").alias("median_distance_au"),
        "very_close_approaches",
        "close_approaches",
        "notable_approaches",
    )


def measure_stats(
    df: DataFrame, value: str, groups: Sequence[str], few_groups: bool = False, approximate: bool = False
) -> DataFrame:
    """Mean, median, extremes, sample deviation (0 for one value) and count per group.

    ``approximate`` takes the median from a sketch, one scan in all.
    """
    names = (*groups, "mean", "median", "min", "max", "std", "n")
    if approximate:
        stats = {
            "mean": dround(F.avg(value), 6),
            "min": F.min(value),
            "max": F.max(value),
            "std": dround(F.coalesce(F.stddev_samp(value), F.lit(0.0)), 6),
            "n": _rows(),
            "median": dround(F.percentile_approx(value, 0.5, 10_000), 6),
        }
        rows = df.filter(F.col(value).isNotNull())
        return rows.groupBy(*groups).agg(*[c.alias(n) for n, c in stats.items()]).select(*names)
    one = exact_quantiles(df, value, [0.5], groups, few_groups, summary=True)
    return one.select(
        *groups,
        dround(F.col("summary.mean"), 6).alias("mean"),
        dround(F.col("quantiles")[0], 6).alias("median"),
        F.col("summary.min").alias("min"),
        F.col("summary.max").alias("max"),
        dround(F.coalesce(F.col("summary.std"), F.lit(0.0)), 6).alias("std"),
        F.col("summary.rows").alias("n"),
    )


def box_summary(
    df: DataFrame, value: str, group: str, few_groups: bool = False, approximate: bool = False
) -> DataFrame:
    """Minimum, quartiles and maximum per group; ``approximate`` takes them from a sketch in one scan."""
    marks = [0.0, 0.25, 0.5, 0.75, 1.0]
    if approximate:
        rows = df.filter(F.col(value).isNotNull() & ~F.isnan(value))
        quantiles = rows.groupBy(group).agg(
            F.percentile_approx(value, marks, 10_000).alias("quantiles"), _rows().alias("n")
        )
    else:
        quantiles = exact_quantiles(df, value, marks, [group], few_groups)
    names = ("min", "q1", "median", "q3", "max")
    return quantiles.select(
        group, *[dround(F.col("quantiles")[i], 6).alias(n) for i, n in enumerate(names)], "n"
    )


def group_speedup(df: DataFrame, group: str, value: str, baseline: str) -> DataFrame:
    """Mean per group, rank (smallest first), ratio to a baseline group and overall ratio.

    The groups are counted per cell of the mean and numbered inside their cell, so they
    need not meet in one task.  A NULL mean ranks first.
    """
    means = df.groupBy(group).agg(F.avg(value).alias("__mean"))
    facts = (
        means.agg(
            F.struct(
                F.max(F.when(F.col(group) == baseline, F.col("__mean"))).alias("base"),
                F.max("__mean").alias("slowest"),
                F.min("__mean").alias("fastest"),
            ).alias("s")
        )
        .select("s")
        .scalar()
    )
    placed = ordered_positions(means, "__mean", [F.col(group).asc_nulls_last()], "rank")
    return placed.select(
        group,
        dround("__mean", 6).alias("mean_value"),
        "rank",
        dround(F.try_divide(facts["base"], F.col("__mean")), 4).alias("speedup"),
        dround(F.try_divide(facts["slowest"], facts["fastest"]), 4).alias("slowest_over_fastest"),
    )


def repeat_approaches(df: DataFrame) -> DataFrame:
    """Objects with repeated approaches: self-join counts without the self-join.

    Joining the table to itself on ``des`` pairs every row that has ``h`` with every
    row of the object, so the pair count is the product of two counts.  A product
    beyond a 64-bit count raises.
    """
    counts = df.groupBy("des").agg(
        F.count("h").alias("__a"),
        _rows().alias("__b"),
        F.min(F.when(F.col("h").isNotNull(), F.col("dist"))).alias("closest"),
    )
    return (
        counts.filter(
            F.col("des").isNotNull()
            & (F.col("__a") > 0)
            & ((F.col("__a") > 1) | (F.col("__b") > 1))
        )
        .select("des", (F.col("__a") * F.col("__b")).alias("approaches"), "closest")
    )


def key_findings(
    df: DataFrame, top_n: int = 20, first_year: int = 1900, last_year: int = 2030
) -> DataFrame:
    """Headline findings as (finding, value).

    One scan makes a row per year; the findings come from those rows.
    """
    complete = F.col("h").isNotNull() & F.col("dist").isNotNull() & F.col("v_rel").isNotNull()
    sizes = F.when(F.col("h").isNotNull(), size_category())
    per_year = df.groupBy("approach_year").agg(
        _rows().alias("n"),
        count_if(complete).alias("complete"),
        F.max(F.when(complete, risk_score())).alias("score"),
        F.count("h").alias("sized"),
        F.collect_set(sizes).alias("sizes"),
        F.min("dist").alias("closest"),
    )
    in_range = F.when(F.col("approach_year").between(first_year, last_year), F.col("approach_year"))
    one = per_year.agg(
        F.least(F.sum("complete"), F.lit(top_n)).cast("double").alias("risky_objects"),
        F.max("score").alias("highest_risk_score"),
        F.max(in_range).cast("double").alias("latest_year"),
        F.max_by("n", in_range).cast("double").alias("latest_year_approaches"),
        F.sum("sized").cast("double").alias("sized_objects"),
        F.size(F.array_distinct(F.flatten(F.collect_list("sizes"))))
        .cast("double")
        .alias("size_categories"),
        dround(F.min("closest"), 8).alias("closest_approach"),
    )
    cells = []
    for name in one.columns:
        cells += [F.lit(name), F.col(name)]
    return one.select(F.stack(F.lit(len(one.columns)), *cells).alias("finding", "value"))


# --- scored rows --------------------------------------------------------------------


def score_summary(df: DataFrame, score: Column, name: str = "risk_score") -> DataFrame:
    """Rows per rounded score value with its category."""
    return (
        df.groupBy(risk_category().alias("risk_category"), score.alias(name))
        .agg(_rows().alias("count"))
    )


def risk_trend(risk_rows: DataFrame, min_rows: int = 5) -> DataFrame:
    """Mean score per segment and year, for segments of enough rows and years."""
    per_year = (
        risk_rows.filter(F.col("segment").isNotNull() & F.col("approach_year").isNotNull())
        .groupBy("segment", "approach_year")
        .agg(F.avg("risk_score").alias("__mean"), _rows().alias("__n"))
    )
    w = Window.partitionBy("segment")
    return (
        per_year.withColumn("__rows", F.sum("__n").over(w))
        .withColumn("__years", F.count(F.lit(1)).over(w))
        .filter((F.col("__rows") > min_rows) & (F.col("__years") > 1))
        .select("segment", "approach_year", dround("__mean", 4).alias("avg_risk"))
        .orderBy("segment", "approach_year")
    )


def segment_comparison(risk_rows: DataFrame, high_risk: float = 50.0) -> DataFrame:
    """Historical against future: mean score, high scores, and the direction.

    No row if either segment is empty.
    """

    def mean(segment: str) -> Column:
        return F.avg(F.when(F.col("segment") == segment, F.col("risk_score")))

    def high(segment: str) -> Column:
        return count_if((F.col("segment") == segment) & (F.col("risk_score") > high_risk))

    one = risk_rows.agg(
        mean("historical").alias("h_mean"),
        mean("future").alias("f_mean"),
        high("historical").alias("historical_high_risk"),
        high("future").alias("future_high_risk"),
    )
    return one.filter(F.col("h_mean").isNotNull() & F.col("f_mean").isNotNull()).select(
        dround("h_mean", 4).alias("historical_avg_risk"),
        dround("f_mean", 4).alias("future_avg_risk"),
        "historical_high_risk",
        "future_high_risk",
        F.when(F.col("f_mean") > F.col("h_mean"), "Increasing")
        .otherwise("Decreasing")
        .alias("risk_trend"),
    )


def segment_counts(df: DataFrame, segment: Column) -> DataFrame:
    """Rows per segment; NULL for rows that belong to neither."""
    return df.groupBy(segment.alias("segment")).agg(_rows().alias("count"))

