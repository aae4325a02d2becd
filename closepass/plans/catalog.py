"""The registered queries: name -> (spark, sf_dir) -> DataFrame."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from closepass.functions.numeric import dround
from closepass.functions.risk import (
    capped_risk_score,
    risk_category,
    risk_score,
    temporal_segment,
)
from closepass.operators import aggregates as agg
from closepass.operators import charts, cleaning, ranking, reports, sampling, versions
from closepass.operators.comparison import row_differences
from closepass.plans import inputs
from closepass.sources.files import json_array_texts
from closepass.sources.footers import footer_summary
from closepass.sources.payload import payload_texts

Query = Callable[[SparkSession, str], DataFrame]

# The test dates end in 2001, so cut-off years differ from the defaults.
LAST_PAST, FIRST_FUTURE = 1998, 1999
RECENT = "1999-01-01"
YEARS = (1995, 1996, 1997, 1998, 1999, 2000, 2001)


def _plain(operator: Callable[..., DataFrame], **options) -> Query:
    """A query that needs no object names."""
    return lambda spark, sf: operator(inputs.approaches(spark, sf), **options)


def _listed(
    operator: Callable[..., DataFrame],
    limit: int,
    key: str = "des",
    name: str = "fullname",
    **options,
) -> Query:
    """A top-k list: reduce, name the k rows, and put them in order again."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        rows = operator(inputs.approaches(spark, sf), limit=limit, **options)
        columns = [rows.columns[0], name, *rows.columns[1:]]
        placed = rows.withColumn("__p", F.monotonically_increasing_id())
        listed = inputs.with_names(placed, spark, sf, few_rows=True, key=key, name=name)
        return listed.orderBy("__p").limit(limit).select(*[F.col(f"`{c}`") for c in columns])

    return run


def _risk_rows(spark: SparkSession, sf: str) -> DataFrame:
    return charts.risk_dashboard(inputs.approaches(spark, sf), LAST_PAST, FIRST_FUTURE)


def _dedupe_key(spark: SparkSession, sf: str) -> DataFrame:
    rows = inputs.approaches(spark, sf)
    others = [F.col(c).asc_nulls_last() for c in rows.columns if c not in ("des", "cd")]
    return cleaning.dedupe_by_key(rows, order=others)


def _cd_string(spark: SparkSession, sf: str) -> DataFrame:
    rows = inputs.approaches(spark, sf)
    return cleaning.with_date_text(rows).groupBy("cd").agg(F.count(F.lit(1)).alias("records"))


def _record_holders(spark: SparkSession, sf: str) -> DataFrame:
    held = reports.record_holders(inputs.approaches(spark, sf))
    return inputs.with_names(held, spark, sf)


def _best_per_object(spark: SparkSession, sf: str) -> DataFrame:
    best = ranking.best_per_object(inputs.approaches(spark, sf), ordered=False)
    return inputs.with_names(best, spark, sf).orderBy(F.desc("risk_score"), "des")


def _risk_dashboard(spark: SparkSession, sf: str) -> DataFrame:
    return inputs.with_names(_risk_rows(spark, sf), spark, sf)


def _score_counts(score: Callable[[], object]) -> Query:
    """Scores of all rows, as rows per category and score."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        rows = inputs.approaches(spark, sf)
        if score is risk_score:
            rows = rows.filter(F.col("h").isNotNull())
        return agg.score_summary(rows, score())

    return run


def _risk_category_counts(spark: SparkSession, sf: str) -> DataFrame:
    rows = inputs.approaches(spark, sf).filter(reports.not_null("h", "dist"))
    return agg.category_counts(rows.select(risk_category().alias("risk_category")))


def _temporal_segment(spark: SparkSession, sf: str) -> DataFrame:
    segment = temporal_segment("approach_year", LAST_PAST, FIRST_FUTURE)
    return agg.segment_counts(inputs.approaches(spark, sf), segment)


def _clip(spark: SparkSession, sf: str) -> DataFrame:
    """Marker sizes of all rows, counted."""
    rows = inputs.approaches(spark, sf).filter(F.col("h").isNotNull())
    return (
        rows.select(
            charts.marker_size_by_score(risk_score()).alias("score_marker"),
            charts.marker_size_by_magnitude("h").alias("size_marker"),
            charts.marker_size_by_score(risk_score(), high=30.0).alias("wide_marker"),
        )
        .groupBy("score_marker", "size_marker", "wide_marker")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def _with_category(spark: SparkSession, sf: str) -> DataFrame:
    rows = inputs.approaches(spark, sf).filter(reports.not_null("h", "dist"))
    return rows.withColumn("risk_category", risk_category())


def _sample_stratified(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.sample_stratified(_with_category(spark, sf), 8000, few_groups=True)


def _pivot_mean(spark: SparkSession, sf: str) -> DataFrame:
    rows = _with_category(spark, sf)
    return agg.pivot_mean(rows, "risk_category", "approach_year", YEARS, "dist")


def _cumulative_frames(spark: SparkSession, sf: str) -> DataFrame:
    rows = _with_category(spark, sf).withColumnRenamed("approach_year", "year")
    return charts.cumulative_frames(rows)


def _box_summary(spark: SparkSession, sf: str) -> DataFrame:
    return agg.box_summary(_with_category(spark, sf), "dist", "risk_category", few_groups=True)


def _group_speedup(spark: SparkSession, sf: str) -> DataFrame:
    events = inputs.table(spark, sf, "events")
    return agg.group_speedup(events, "event_type", "value", baseline="click")


def _measure_stats(spark: SparkSession, sf: str) -> DataFrame:
    return agg.measure_stats(inputs.table(spark, sf, "events"), "value", ["event_type"])


def _versioned(spark: SparkSession, sf: str) -> DataFrame:
    """Approaches in three loads by year."""
    year = F.col("approach_year")
    return inputs.approaches(spark, sf).withColumn("version", F.when(year <= 1997, 1).when(year == 1998, 2).otherwise(3))


def _as_of_version(spark: SparkSession, sf: str) -> DataFrame:
    rows = versions.as_of(_versioned(spark, sf), 2)
    return rows.groupBy("approach_year").agg(
        F.count(F.lit(1)).alias("records"), F.count("h").alias("with_h"), F.min("dist").alias("closest")
    )


def _payload_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = payload_texts(inputs.payload_texts(spark, sf), "text", "order", inputs.PAYLOAD_COLUMNS)
    return rows.withColumnsRenamed({"_file": "order", "_row": "row"})


def _json_records(spark: SparkSession, sf: str) -> DataFrame:
    rows = json_array_texts(inputs.record_texts(spark, sf), "text")
    return rows.select("des", "fullname", "cd", "dist", "h", "approach_year")


def _history(spark: SparkSession, sf: str) -> DataFrame:
    """The versions of the loads, each committed with its last date."""
    return _versioned(spark, sf).groupBy("version").agg(F.max("cd").alias("committed_at"))


def _as_of_times(spark: SparkSession, sf: str) -> DataFrame:
    """The version and size of the table at the date of every order."""
    asked = inputs.table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").alias("time"))
    return versions.counts_at(_versioned(spark, sf), asked, _history(spark, sf))


def _row_differences(spark: SparkSession, sf: str) -> DataFrame:
    """What the objects' magnitudes and marks of two years differ in."""
    rows = inputs.approaches(spark, sf)
    years = [rows.filter(F.col("approach_year") == y).select("h", "t_sigma_f") for y in (1996, 1997)]
    return row_differences(*years)


def _objects_by_sketch(spark: SparkSession, sf: str) -> DataFrame:
    """Objects of ranges of years: the exact number, and whether that of the sketches is within its bound."""
    rows = inputs.approaches(spark, sf)
    years = rows.select(F.col("approach_year").alias("first_year")).distinct().filter("first_year < 2001")
    ranges = years.withColumn("last_year", F.lit(2000).cast("bigint"))
    by_sketch = agg.distinct_in_ranges(agg.yearly_sketches(rows), ranges)
    each = ranges.select("*", F.explode(F.expr("sequence(first_year, last_year)")).alias("y"))
    exact = rows.select("des", F.col("approach_year").alias("y")).distinct().join(each, "y")
    exact = exact.groupBy("first_year", "last_year").agg(F.count_distinct("des").alias("n"))
    near = F.abs(F.col("objects") - F.col("n")) <= F.col("n") * agg.SKETCH_ERROR
    return by_sketch.join(exact, ["first_year", "last_year"]).select("first_year", "last_year", F.col("n").alias("objects"), near.alias("within_bound"))


def _footer_summary(spark: SparkSession, sf: str) -> DataFrame:
    return footer_summary(spark, f"{sf}/lineitem.parquet", ["l_orderkey", "l_partkey"])


QUERIES: dict[str, Query] = {
    # reading
    "payload_rows": _payload_rows,
    "json_records": _json_records,
    "as_of_times": _as_of_times,
    "row_differences": _row_differences,
    "window_full": _plain(reports.full_source_window),
    "window_limited": _plain(reports.limited_source_window, limit=10_000),
    "version_counts": lambda spark, sf: versions.version_counts(_versioned(spark, sf)),
    "as_of_version": _as_of_version,
    "partition_scan": _plain(agg.partition_scan, first_year=1996, last_year=1998),
    "limited_scan": _plain(reports.limited_scan, order=("cd", "des", "dist")),
    "table_stats": _plain(agg.table_stats),
    "footer_summary": _footer_summary,
    # cleaning
    "clean": lambda spark, sf: cleaning.clean(inputs.raw_approaches(spark, sf)),
    "dedupe_key": _dedupe_key,
    "cd_string": _cd_string,
    "null_profile": _plain(agg.null_profile),
    # filtered lists
    "dangerous_objects": _listed(reports.dangerous_objects, 10),
    "recent_close": _listed(
        reports.recent_close_approaches, 15, since=RECENT, max_dist=0.01
    ),
    "complex_filter": _listed(reports.large_and_near, 25),
    "complex_filtering": _listed(reports.nearest_with_category, 50),
    "presentation_top": _listed(
        reports.presentation_top, 10, key="Object", name="Name"
    ),
    "risky_objects": _listed(reports.risky_objects, 20),
    "risk_top100": _listed(reports.risk_overview, 100),
    "top_risks_v0": _listed(reports.top_risks_first_version, 20),
    "top_size_proximity": _listed(reports.top_by_size_and_distance, 20),
    "nearest10": _listed(reports.nearest, 10),
    "top5_udf": _listed(reports.top_by_sql_function, 5),
    "timeline_slice": _plain(reports.timeline_slice, first_year=1996, last_year=1999),
    "record_holders": _record_holders,
    "scatter_sample": _plain(sampling.scatter_sample, limit=1000, seed=42),
    # scores and categories
    "risk_score": _score_counts(risk_score),
    "risk_score_capped": _score_counts(capped_risk_score),
    "risk_category": _risk_category_counts,
    "temporal_segment": _temporal_segment,
    "clip": _clip,
    # aggregates
    "simple_count": _plain(agg.simple_count),
    "filtered_count": _plain(agg.filtered_count),
    "aggregation": _plain(agg.yearly_counts),
    "yearly_discoveries": _plain(agg.yearly_discoveries),
    "yearly_all": _plain(agg.yearly_all),
    "yearly_by_date": _plain(agg.yearly_by_date),
    "objects_by_sketch": _objects_by_sketch,
    "yearly_trends": _plain(agg.yearly_trends),
    "years_range": _plain(agg.years_range, first_year=1996, last_year=1998),
    "trend_stats": _plain(agg.trend_stats, recent=3),
    "monthly_distribution": _plain(agg.monthly_distribution),
    "partition_counts": _plain(agg.partition_counts),
    "velocity_analysis": _plain(agg.velocity_distribution),
    "size_distribution": _plain(agg.size_distribution),
    "size_distribution_basic": _plain(agg.size_distribution_basic),
    "size_distribution_nb": _plain(agg.size_distribution_with_range),
    "size_share": _plain(agg.size_share),
    "distance_statistics": _plain(agg.distance_statistics),
    "distance_statistics_nb": _plain(agg.distance_statistics_short),
    "dataset_overview": _plain(agg.dataset_overview),
    "data_quality": _plain(agg.data_quality),
    "completeness": _plain(agg.completeness),
    "summary_metrics": _plain(agg.summary_metrics),
    "key_findings": _plain(agg.key_findings),
    "complex_join": _plain(agg.repeat_approaches),
    "risk_counts": lambda spark, sf: agg.category_counts(_risk_rows(spark, sf)),
    "risk_trend": lambda spark, sf: agg.risk_trend(_risk_rows(spark, sf)),
    "segment_comparison": lambda spark, sf: agg.segment_comparison(_risk_rows(spark, sf)),
    "pivot_mean": _pivot_mean,
    "group_speedup": _group_speedup,
    "measure_stats": _measure_stats,
    # ranking and sampling
    "analytical_window": _plain(ranking.distance_rank_with_size_percentile),
    "risk_rank": _plain(reports.risk_ranking),
    "risk_best_per_object": _best_per_object,
    "section_top": lambda spark, sf: ranking.top_per_segment(_risk_rows(spark, sf)),
    "discovery_sample": _plain(ranking.discovery_sample),
    "sample_random": _plain(sampling.sample_random, size=5000),
    "sample_stratified": _sample_stratified,
    "sample_temporal": _plain(sampling.sample_temporal, size=7000),
    # chart data
    "cumulative_frames": _cumulative_frames,
    "histogram_dist": _plain(charts.histogram, column="dist", bins=50),
    "histogram_h": _plain(charts.histogram, column="h", bins=50),
    "histogram_dist_round": _plain(charts.rounded_histogram, column="dist", at_most=15),
    "histogram_h_round": _plain(charts.rounded_histogram, column="h", at_most=20),
    "histogram_risk": lambda spark, sf: charts.histogram(_risk_rows(spark, sf), "risk_score", 20),
    "box_summary": _box_summary,
    "risk_dashboard": _risk_dashboard,
}
