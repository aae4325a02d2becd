"""Approaches tables derived from the star-schema test tables.

A ``lineitem`` row is one approach of the object ``l_partkey``; ``part`` names the
objects.  Names are attached after a query has reduced its rows where they do not
decide anything, so a top-k list joins k rows and not the whole table.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def approaches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All approaches, without ``fullname``."""
    li = table(spark, sf_dir, "lineitem")
    dist = F.col("l_extendedprice") / F.lit(210000.0)
    v_rel = F.col("l_quantity") * F.lit(1.3)
    days = F.datediff(F.col("l_shipdate").cast("date"), F.lit("1970-01-01").cast("date"))
    h = F.when(F.col("l_suppkey") % 50 != 0, 14.0 + (F.col("l_partkey") % 160) / F.lit(10.0))
    sigma = F.when(F.col("l_linenumber") != 7, F.concat("l_returnflag", "l_linestatus"))
    return li.select(
        F.col("l_partkey").cast("string").alias("des"),
        F.col("l_suppkey").cast("string").alias("orbit_id"),
        F.col("l_shipdate").alias("cd"),
        (days + F.lit(2440587.5)).alias("jd"),
        dist.alias("dist"),
        (dist * (F.lit(1.0) - F.col("l_tax"))).alias("dist_min"),
        (dist * (F.lit(1.0) + F.col("l_tax"))).alias("dist_max"),
        v_rel.alias("v_rel"),
        (v_rel * (F.lit(1.0) - F.col("l_discount"))).alias("v_inf"),
        h.alias("h"),
        sigma.alias("t_sigma_f"),
        F.year("l_shipdate").cast("bigint").alias("approach_year"),
    )


def with_names(
    rows: DataFrame,
    spark: SparkSession,
    sf_dir: str,
    few_rows: bool = False,
    key: str = "des",
    name: str = "fullname",
) -> DataFrame:
    """Attach the object's name; every object has a row in ``part``.

    ``few_rows`` marks a result bounded by a literal limit: it is broadcast and the
    name table only scanned.  Otherwise the optimizer chooses the join.
    """
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("__k"), F.col("p_name").alias(name)
    )
    small = F.broadcast(rows) if few_rows else rows
    return part.join(small, F.col("__k") == F.col(key).cast("bigint")).drop("__k")


def named_approaches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All approaches with ``fullname``."""
    return with_names(approaches(spark, sf_dir), spark, sf_dir)


def raw_approaches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows as dirty text, before cleaning."""
    li = table(spark, sf_dir, "lineitem")
    supplier = F.col("l_suppkey")
    dist = (F.col("l_extendedprice") / F.lit(210000.0)).cast("string")
    h = (14.0 + (F.col("l_partkey") % 160) / F.lit(10.0)).cast("string")
    return li.select(
        F.concat(F.lit("  "), F.col("l_partkey").cast("string"), F.lit(" ")).alias("des"),
        supplier.cast("string").alias("orbit_id"),
        F.when((F.col("l_linenumber") == 7) & (F.col("l_tax") == 0), "bad")
        .otherwise(F.date_format("l_shipdate", "yyyy-MMM-dd HH:mm"))
        .alias("cd"),
        F.when(supplier % 37 == 0, "-0.001")
        .when(supplier % 41 == 0, "invalid")
        .otherwise(dist)
        .alias("dist"),
        (F.col("l_quantity") * F.lit(1.3)).cast("string").alias("v_rel"),
        F.when(supplier % 50 == 0, "nan").when(supplier % 47 == 0, "").otherwise(h).alias("h"),
        F.when(F.col("l_linenumber") == 7, "None")
        .otherwise(F.concat("l_returnflag", "l_linestatus"))
        .alias("t_sigma_f"),
    )


#: Columns of the derived payload documents.
PAYLOAD_COLUMNS = ("des", "orbit_id", "cd", "t_sigma_f", "h", "fullname")


def payload_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(order, text)``: the lines of each order as one payload document; an order has few lines."""
    line = F.col("l_linenumber")
    cells = {
        "des": F.col("l_partkey").cast("string"),
        "orbit_id": F.col("l_suppkey").cast("string"),
        "cd": F.date_format("l_shipdate", "yyyy-MM-dd"),
        "t_sigma_f": F.concat(F.lit('] "'), "l_returnflag", F.lit('",['), "l_linestatus"),
        "h": F.when(F.col("l_suppkey") % 50 != 0, (F.col("l_partkey") % 160).cast("string")),
    }
    row = F.array(*cells.values(), line.cast("string"))
    rows = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("order"))
    rows = rows.agg(F.array_sort(F.collect_list(F.struct(line.alias("line"), row.alias("row")))).alias("rows"))
    document = F.struct(
        F.array(*[F.lit(c) for c in (*cells, "line")]).alias("fields"), F.transform("rows", lambda r: r["row"]).alias("data")
    )
    return rows.select("order", F.to_json(document, {"ignoreNullFields": "false"}).alias("text"))


def record_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``text``: the approaches of each object and year as one JSON array of records."""
    rows = approaches(spark, sf_dir).select("des", "cd", "dist", "h", "approach_year")
    groups = rows.groupBy("des", "approach_year").agg(F.collect_list(F.struct(*rows.columns)).alias("r"))
    return groups.select(F.to_json("r").alias("text"))
