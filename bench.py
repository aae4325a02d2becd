"""Headline queries, timed.  Prints one JSON line.

The approaches table is written once as Parquet (load step, reported but not part of
the total); each query then runs once to warm up and three times for its mean, into a
sink that takes all rows.
"""

import json
import os
import statistics
import tempfile
import time

from pyspark.sql import functions as F

from closepass.functions.risk import risk_category
from closepass.operators import aggregates as agg
from closepass.operators import charts, cleaning, ranking, reports, sampling
from closepass.plans import inputs
from closepass.session import local_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

QUERIES = {
    # the five queries of the published numbers
    "simple_count": agg.simple_count,
    "filtered_count": agg.filtered_count,
    "aggregation": agg.yearly_counts,
    "complex_filtering": reports.nearest_with_category,
    "analytical_window": ranking.distance_rank_with_size_percentile,
    # further headline queries
    "risky_objects": reports.risky_objects,
    "yearly_trends": agg.yearly_trends,
    "size_distribution": agg.size_distribution,
    "velocity_analysis": agg.velocity_distribution,
    "distance_statistics": agg.distance_statistics,
    "monthly_distribution": agg.monthly_distribution,
    "record_holders": reports.record_holders,
    "completeness": agg.completeness,
    "summary_metrics": agg.summary_metrics,
    "complex_join": agg.repeat_approaches,
    "risk_best_per_object": ranking.best_per_object,
    "discovery_sample": ranking.discovery_sample,
    "sample_random": lambda df: sampling.sample_random(df, 5000),
    "sample_stratified": lambda df: sampling.sample_stratified(
        df.filter("h is not null").withColumn("risk_category", risk_category()),
        8000,
        few_groups=True,
    ),
    "histogram_dist": lambda df: charts.histogram(df, "dist"),
    # the dearest ones
    "window_full": reports.full_source_window,
    "dedupe_key": lambda df: cleaning.dedupe_by_key(df, order=["dist", "v_rel", "h", "orbit_id"]),
    "sample_temporal": lambda df: sampling.sample_temporal(df, 7000),
    "box_summary": lambda df: agg.box_summary(df, "dist", "approach_year", few_groups=True),
    "risk_dashboard": charts.risk_dashboard,
}


def main() -> None:
    spark = local_session(CPUS, memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    cores = spark.sparkContext.defaultParallelism
    with tempfile.TemporaryDirectory(prefix="closepass-bench-") as folder:
        start = time.perf_counter()
        rows = inputs.named_approaches(spark, SF_DIR).repartition(cores)
        rows.write.parquet(f"{folder}/approaches.parquet")
        load = time.perf_counter() - start
        table = spark.read.parquet(f"{folder}/approaches.parquet")
        total_rows = table.agg(F.count(F.lit(1))).first()[0]

        times = {}
        for name, query in QUERIES.items():
            runs = []
            for _ in range(RUNS + 1):
                start = time.perf_counter()
                query(table).write.format("noop").mode("overwrite").save()
                runs.append(time.perf_counter() - start)
            times[name] = round(statistics.mean(runs[1:]), 4)
    print(
        json.dumps(
            {
                "metric": "sum of mean query times",
                "value": round(sum(times.values()), 4),
                "unit": "sec",
                "queries": times,
                "load": round(load, 3),
                "rows": total_rows,
                "sf": os.path.basename(SF_DIR.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
