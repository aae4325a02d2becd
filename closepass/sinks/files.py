"""Writers for the three file formats and the year-partitioned layout."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from closepass.functions.numeric import dround, share

FORMATS = ("csv", "parquet", "json")


def save(df: DataFrame, fmt: str, path: str, mode: str = "overwrite", strict: bool = True) -> str:
    """Write one format; ValueError for an unknown format or, if strict, an empty table."""
    if fmt not in FORMATS:
        raise ValueError(f"Unsupported format: {fmt}. Use one of: {list(FORMATS)}")
    if strict and df.isEmpty():
        raise ValueError("Cannot save empty DataFrame")
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    elif fmt == "parquet":
        writer.parquet(path)
    else:
        writer.option("ignoreNullFields", False).json(path)
    return path


def save_all(
    df: DataFrame, base_path: str, formats: Sequence[str] = FORMATS, mode: str = "overwrite"
) -> dict[str, str]:
    """Write every format.

    With Parquet among the formats the rows are computed once: it is written first and the others are copied from
    it, so nothing is cached and a lost executor costs one file copy at most.  Without it each
    format computes them again.
    """
    paths = {}
    rows = df
    for fmt in sorted(formats, key=lambda f: f != "parquet"):
        paths[fmt] = save(rows, fmt, f"{base_path}.{fmt}", mode, strict=not paths)
        if fmt == "parquet":
            rows = df.sparkSession.read.schema(df.schema).parquet(paths[fmt])
    return {f: paths[f] for f in formats}


def save_by_year(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    column: str = "approach_year",
    rows_per_file: int = 2_000_000,
) -> str:
    """Year-partitioned Parquet with snappy compression.

    ``rebalance`` gathers a year's rows into few files and splits a year that holds
    much of the table over several tasks; ``rows_per_file`` keeps a file near 128 MB.
    """
    (
        df.hint("rebalance", column)
        .write.mode(mode)
        .option("compression", "snappy")
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy(column)
        .parquet(path)
    )
    return path


def morton(cells: Sequence[Column], bits: int) -> Column:
    """The bits of some whole numbers below 2^bits, interleaved, the first number's first."""
    z = F.lit(0).cast("bigint")
    for b in range(bits):
        for k, cell in enumerate(cells):
            bit = F.shiftright(cell, b).bitwiseAND(F.lit(1)).cast("bigint")
            z = z.bitwiseOR(F.shiftleft(bit, b * len(cells) + len(cells) - 1 - k))
    return z


def save_clustered(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    columns: Sequence[str] = ("h", "dist"),
    lookup: str = "des",
    by: str = "approach_year",
    bits: int = 5,
    rows_per_file: int = 2_000_000,
    row_group_bytes: int = 32 << 20,
) -> str:
    """Year-partitioned Parquet whose row groups hold rows near to each other in ``columns``.

    Each column is cut into 2^bits cells of about equally many rows (marks from a sketch; NULL is in the last cell) and rows are
    ordered, inside a year, by the interleaved bits of their cells.  A condition on either column then leaves out most
    row groups by their extremes.  ``lookup`` gets a bloom filter, by which a search for one value leaves out
    the row groups without it.  Rows are dealt by ranges of the whole order, so neither a large year nor a cell
    that holds much of the table is one task's.
    """
    shares = [k / (1 << bits) for k in range(1, 1 << bits)]

    def cell(k: int, c: str) -> Column:
        below = F.size(F.filter(f"__m{k}", lambda m: m < F.col(c)))
        return F.when(F.col(c).isNull(), F.lit((1 << bits) - 1)).otherwise(below).cast("int").alias(f"__z{k}")

    marks = {f"__m{k}": df.agg(F.percentile_approx(c, shares, 10_000).alias("m")).scalar() for k, c in enumerate(columns)}
    placed = df.withColumns(marks).select("*", *[cell(k, c) for k, c in enumerate(columns)])
    z = morton([F.col(f"__z{k}") for k in range(len(columns))], bits)
    order = [by, "__z", *columns, lookup]
    (
        placed.withColumn("__z", z)
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(*df.columns)
        .write.mode(mode)
        .option("compression", "snappy")
        .option("maxRecordsPerFile", rows_per_file)
        .option("parquet.block.size", row_group_bytes)
        .option(f"parquet.bloom.filter.enabled#{lookup}", "true")
        .partitionBy(by)
        .parquet(path)
    )
    return path


def storage_footprint(
    spark: SparkSession, paths: dict[str, str], baseline: str = "csv"
) -> DataFrame:
    """Bytes, MB, files, partitions and ratio to a baseline format, per stored format.

    Only file sizes are listed, contents are not read.
    """
    listing = None
    for name, path in paths.items():
        files = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", True)
            .load(path)
            .select(F.lit(name).alias("format"), "path", "length")
        )
        listing = files if listing is None else listing.unionByName(files)
    folder = F.regexp_extract("path", r"/([^/=]+=[^/]+)/[^/]+$", 1)
    data = listing.filter(~F.regexp_extract("path", r"([^/]+)$", 1).rlike(r"^[._]"))
    sizes = data.groupBy("format").agg(
        F.sum("length").alias("size_bytes"),
        F.count(F.lit(1)).alias("files"),
        F.count_distinct(F.when(folder != "", folder)).alias("partitions"),
    )
    base = sizes.filter(F.col("format") == baseline).agg(F.max("size_bytes").alias("b")).scalar()
    ratio = F.try_divide(base.cast("double"), F.col("size_bytes").cast("double"))
    return sizes.select(
        "format",
        "size_bytes",
        dround(F.col("size_bytes") / (1024.0 * 1024.0), 2).alias("size_mb"),
        "files",
        "partitions",
        dround(ratio, 2).alias("compression_ratio"),
        share(base - F.col("size_bytes"), base, 1).alias("space_saved_pct"),
    )


def best_format(footprint: DataFrame, baseline: str = "csv") -> DataFrame:
    """The format of the highest compression ratio, as one row."""
    others = footprint.filter(F.col("format") != baseline)
    return others.orderBy(F.desc("compression_ratio"), "format").limit(1)
