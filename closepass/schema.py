"""Declared schemas.  Nothing in this package infers a schema from data."""

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Column names of the approaches table.
NUMERIC_COLUMNS = ("jd", "dist", "dist_min", "dist_max", "v_rel", "v_inf", "h")
TEXT_COLUMNS = ("des", "fullname", "t_sigma_f")

#: Typed approaches table.
APPROACHES = T.StructType(
    [
        T.StructField("des", T.StringType()),
        T.StructField("fullname", T.StringType()),
        T.StructField("cd", T.TimestampNTZType()),
        T.StructField("dist", T.DoubleType()),
        T.StructField("dist_min", T.DoubleType()),
        T.StructField("dist_max", T.DoubleType()),
        T.StructField("v_rel", T.DoubleType()),
        T.StructField("v_inf", T.DoubleType()),
        T.StructField("h", T.DoubleType()),
        T.StructField("orbit_id", T.StringType()),
        T.StructField("t_sigma_f", T.StringType()),
        T.StructField("jd", T.DoubleType()),
        T.StructField("approach_year", T.LongType()),
    ]
)

#: One payload document: a list of column names and row-major string rows.
PAYLOAD = T.StructType(
    [
        T.StructField("signature", T.StructType([T.StructField("version", T.StringType())])),
        T.StructField("count", T.LongType()),
        T.StructField("fields", T.ArrayType(T.StringType())),
        T.StructField("data", T.ArrayType(T.ArrayType(T.StringType()))),
    ]
)

#: Columns of the payload rows, all text.
RAW_COLUMNS = (
    "des",
    "orbit_id",
    "jd",
    "cd",
    "dist",
    "dist_min",
    "dist_max",
    "v_rel",
    "v_inf",
    "t_sigma_f",
    "h",
    "fullname",
)


def present(df: DataFrame, *names: str) -> list[str]:
    """The given names that exist in ``df``, in the given order."""
    have = set(df.columns)
    return [n for n in names if n in have]
