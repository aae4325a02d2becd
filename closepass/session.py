"""Session settings this package is written for."""

from pyspark.sql import SparkSession

# Catalyst's run-time choices do the per-size work: coalescing small shuffles,
# splitting skewed join partitions, and broadcasting a side it has measured.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "snappy",
}


def local_session(cpus: int | str = "*", memory: str = "8g", **settings: str) -> SparkSession:
    """One-machine session for tests and the bench."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("closepass")
    own = {
        "spark.ui.enabled": "false",
        "spark.driver.memory": memory,
        "spark.sql.shuffle.partitions": "8",
    }
    for key, value in {**SETTINGS, **own, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
