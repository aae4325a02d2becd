"""Tables with a version column: rows of a later load have a higher version."""

import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def as_of(df: DataFrame, version: int, column: str = "version") -> DataFrame:
    """The table as it was at a version."""
    return df.filter(F.col(column) <= version)


def version_counts(df: DataFrame, column: str = "version") -> DataFrame:
    """Rows that each version added, and rows in all up to it; versions are few."""
    counts = df.groupBy(F.col(column).alias("version")).agg(F.count(F.lit(1)).alias("records"))
    return counts.withColumn("total", F.sum("records").over(Window.orderBy("version")))


def with_added_column(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows of both; a column that only one has is NULL in the other's rows."""
    return before.unionByName(after, allowMissingColumns=True)


def version_at(asked: DataFrame, history: DataFrame, time: str = "time") -> DataFrame:
    """``asked`` with the version that stood at its time: that of the greatest commit time not after it, else NULL.

    ``history`` has one row a version: ``version``, ``committed_at``, and may have ``columns``.  Versions are few, as each
    is a load, so they are looked up in one array; ``asked`` may be any table and is not shuffled.
    """
    known = history.agg(F.collect_list(F.struct("committed_at", "version")).alias("h")).scalar()
    standing = F.array_max(F.filter("__known", lambda v: v["committed_at"] <= F.col(time)))
    found = asked.withColumn("__known", known).withColumn("version", standing["version"])
    return found.drop("__known")


def counts_at(df: DataFrame, asked: DataFrame, history: DataFrame, time: str = "time", column: str = "version") -> DataFrame:
    """``asked`` with the standing version and the rows that the table had then; 0 before the first version."""
    totals = version_counts(df, column).select(F.col("version").alias("__v"), "total")
    at = version_at(asked, history, time)
    # a version without rows of its own has those of the one before it
    known = totals.agg(F.collect_list(F.struct("__v", "total")).alias("t")).scalar()
    upto = F.array_max(F.filter("__totals", lambda t: t["__v"] <= F.col("version")))
    found = at.withColumn("__totals", known).withColumn("records", F.coalesce(upto["total"], F.lit(0)))
    return found.drop("__totals")


def as_of_time(df: DataFrame, when: datetime.datetime | str, history: DataFrame, column: str = "version") -> DataFrame:
    """The table as it was at a time: the rows up to the version that stood then, with the columns that it had.

    ``history.columns`` lists the columns of each version, so one added later is absent.  ValueError if no version stood yet.
    """
    standing = (
        history.filter(F.col("committed_at") <= F.lit(when).cast(history.schema["committed_at"].dataType))
        .orderBy(F.desc("committed_at"), F.desc("version"))
        .select("version", "columns")
        .first()
    )
    if standing is None:
        raise ValueError(f"No version at {when}")
    return as_of(df, standing["version"], column).select(*[c for c in df.columns if c in standing["columns"]])
