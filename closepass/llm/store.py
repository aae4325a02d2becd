"""Intermediate tables in the folder that all executors share."""

import ctypes
import tempfile
import uuid

import pyarrow as pa

from pyspark.sql import DataFrame, SparkSession

FOLDER_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """A new folder name below the cluster's checkpoint folder.

    A session on one machine without that setting, as in tests, gets a temporary folder.  Elsewhere
    a machine-local folder would lose rows, so the setting is then required.
    """
    root = spark.conf.get(FOLDER_SETTING, None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"{FOLDER_SETTING} must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="closepass-")
    return f"{root.rstrip('/')}/closepass-llm/{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """`df` written once as Parquet in the shared folder and read again: lineage ends here.

    The folder's owner removes it once the results are taken.
    """
    spark = df.sparkSession
    folder = shared_folder(spark)
    df.write.option("compression", "zstd").parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = "1000"  # texts that a Python worker holds at once


def give_back() -> None:
    """Returns freed memory to the system, which a reused Python worker would keep."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def mapped(df: DataFrame, run, schema) -> DataFrame:
    """`df.mapInArrow` with batches of whole texts small enough for a task's memory.

    The batch size is a setting of the session; one that the user has chosen stays.
    """
    conf = df.sparkSession.conf
    if conf.get(BATCH_SETTING) == "10000":  # Spark's default
        conf.set(BATCH_SETTING, BATCH_ROWS)

    def tidy(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return df.mapInArrow(tidy, schema)
