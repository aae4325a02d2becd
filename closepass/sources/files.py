"""CSV, Parquet and JSON tables under a declared schema."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from closepass.schema import APPROACHES
from closepass.sources.arrays import read_json_array


def read_csv(spark: SparkSession, path: str, schema: StructType = APPROACHES) -> DataFrame:
    """CSV with a header; columns are matched by name.

    Files of one folder must have one header: a file with another order of columns raises.
    """
    header = spark.read.option("header", True).csv(path).columns
    names = [c for c in header if c in schema.fieldNames()]
    by_position = StructType(
        [schema[c] if c in names else StructField(c, StringType()) for c in header]
    )
    rows = spark.read.schema(by_position).option("header", True).option("enforceSchema", False).csv(path)
    return _complete(rows, schema)


def _complete(rows: DataFrame, schema: StructType) -> DataFrame:
    have = set(rows.columns)
    return rows.select(
        *[
            F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def read_parquet(spark: SparkSession, path: str, schema: StructType = APPROACHES) -> DataFrame:
    """Parquet file, folder or year-partitioned folder; columns absent from files are NULL."""
    return spark.read.schema(schema).parquet(path)


def read_json(
    spark: SparkSession,
    path: str,
    schema: StructType = APPROACHES,
    multi_line: bool = False,
    split: bool = False,
) -> DataFrame:
    """One record per line, or one array of records per file with ``multi_line``, which is one task a file.

    ``split`` reads such arrays with many tasks a file; their records must be flat.
    """
    if split:
        return read_json_array(spark, path, schema)
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)


def json_array_texts(texts: DataFrame, text: str, schema: StructType = APPROACHES) -> DataFrame:
    """Records of a table of texts, each one JSON array of records; a text that is none has no row."""
    records = F.from_json(text, ArrayType(schema))
    return texts.select(F.inline(records))


READERS = {".csv": read_csv, ".parquet": read_parquet, ".json": read_json}


def _missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def load_table(
    spark: SparkSession,
    path: str,
    schema: StructType = APPROACHES,
    view: str | None = "approaches",
    **options,
) -> DataFrame:
    """Read by file suffix and register a view of the result."""
    suffix = "." + path.rstrip("/").rsplit("/", 1)[-1].rpartition(".")[2].lower()
    try:
        if suffix not in READERS:
            spark.read.text(path)  # a path that is not there is reported first
            raise ValueError(f"Unsupported file format: {suffix}")
        rows = READERS[suffix](spark, path, schema, **options)
    except AnalysisException as error:
        if _missing(error):
            raise FileNotFoundError(f"Data file not found: {path}") from error
        raise
    if view:
        rows.createOrReplaceTempView(view)
    return rows


def replace_table(
    spark: SparkSession, path: str, table: str, schema: StructType = APPROACHES
) -> DataFrame:
    """Load a file into a managed table, replacing a table of that name."""
    load_table(spark, path, schema, view=None).write.mode("overwrite").saveAsTable(table)
    return spark.table(table)


def latest_file(spark: SparkSession, folder: str, pattern: str = "*", by: str = "time") -> str:
    """Path of the newest file, by modification time or by name.

    The listing never reads file contents.
    """
    listing = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .load(folder)
        .select("path", "modificationTime")
    )
    newest = F.max_by("path", F.struct("modificationTime", "path"))
    found = listing.agg((newest if by == "time" else F.max("path")).alias("path")).first()["path"]
    if found is None:
        raise FileNotFoundError(f"No file matches {pattern} in {folder}")
    return found
