"""Counts and extremes of Parquet tables from the footers of their files.

Parquet keeps, for each row group, its rows and the extremes of its columns.  Spark's second-generation Parquet
reader answers an aggregate from these without reading a row group, if the session asks for it.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Types whose extremes in a footer are those of the values.  Doubles are not among them: a footer leaves NaN out, or not,
#: by its place in the file.  Texts may be cut there, and timestamps are not kept by every writer.
EXACT = {"tinyint", "smallint", "int", "bigint", "date", "boolean"}


def footer_summary(
    spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] = (), by: str | None = None
) -> DataFrame:
    """``n`` rows and ``min_<c>``, ``max_<c>`` of whole-number or date columns, in all or by a partition column.

    The reader's settings are those of a session of its own, on the same context, so the caller's stay as they are.
    ValueError for a column whose extremes a footer does not tell exactly.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,text")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    paths = [path] if isinstance(path, str) else list(path)
    rows = own.read.parquet(*paths)
    kinds = dict(rows.dtypes)
    for c in columns:
        if kinds[c] not in EXACT:
            raise ValueError(f"No exact extremes of {c} ({kinds[c]}) in a footer")
    figures = [F.count(F.lit(1)).alias("n")]
    for c in columns:
        figures += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    # The reader adds up the counts of row groups, which is NULL where there is none, though a count counts as never NULL.
    n = F.coalesce(F.nullif("n", F.lit(-1)), F.lit(0)).alias("n")
    found = rows.groupBy(*([by] if by else [])).agg(*figures)
    return found.select(*[n if c == "n" else F.col(c) for c in found.columns])
