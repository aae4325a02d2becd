"""One huge JSON array read by many tasks.

Spark's readers take a file that holds one document in one task.  Here the file is read as text cut after every
closing bracket of a record, which any number of tasks can do, and a record is what stands between two cuts.  A
bracket inside a string cuts a record in two.  Whether a cut is inside a string follows from the number of
quotes before it: each block of the file is counted first, the counts of earlier blocks are added up (one narrow row a
block), and only the text of blocks that hold such a cut is shuffled, by block, to put its records together again.
All other text passes from the scan to the parser.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from closepass.schema import APPROACHES, RAW_COLUMNS

BLOCK = ["_file", "_block"]
#: Members of a payload, found outside of strings: a quote that ends a key is not escaped.
FIELDS = r'^\s*[{,](?:.*[,{])?\s*"fields"\s*:\s*(\[.*)$'
DATA = r'^\s*[{,](?:.*[,{])?\s*"data"\s*:\s*\[\s*(.*)$'


def _pieces(spark: SparkSession, path: str | Sequence[str], closing: str) -> DataFrame:
    """Text between two closing brackets, with its file, block and a number that rises with its place in the block."""
    return (
        spark.read.option("lineSep", closing)
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_id"),
            F.col("value").alias("text"),
        )
    )


def _odd(text: Column) -> Column:
    """Whether a piece of JSON has an odd number of quotes that are not escaped."""
    plain = F.when(F.contains(text, F.lit("\\")), F.regexp_replace(text, r"\\.", "")).otherwise(text)
    return (F.length(plain) - F.length(F.replace(plain, F.lit('"'), F.lit("")))) % 2 == 1


def _whole(pieces: DataFrame, closing: str) -> DataFrame:
    """``pieces`` with those of one record put together: _file, _row (rising with the place in the file), text."""
    blocks = (
        pieces.select(*BLOCK, "_id", _odd(F.col("text")).alias("_odd"))
        .groupBy(*BLOCK)
        .agg(
            F.min("_id").alias("_first"),
            F.count_if("_odd").alias("_n"),
            F.max(F.when(F.col("_odd"), F.col("_id"))).alias("_last"),
        )
    )
    earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    place = F.col("_block") + F.col("_last") - F.col("_first")
    blocks = blocks.select(
        *[F.col(c).alias(f"{c}_") for c in BLOCK],
        "_first",
        (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) % 2 == 1).alias("_opens_inside"),
        # the piece that opened the string which the block begins in
        F.last(place, ignorenulls=True).over(earlier).alias("_opener"),
        (F.col("_n") > 0).alias("_has_odd"),
    )
    placed = (
        pieces.join(blocks, (F.col("_file") == F.col("_file_")) & (F.col("_block") == F.col("_block_")))
        # Both readings must have cut the files alike.
        .withColumn("_at", F.col("_id") - F.col("_first"))
        .withColumn(
            "_row",
            F.when(
                (F.shiftright("_id", 33) == F.shiftright("_first", 33)) & (F.col("_at") >= 0), F.col("_block") + F.col("_at")
            ).otherwise(F.raise_error(F.lit("the file was split in another way between two readings of it"))),
        )
    )
    broken = F.col("_has_odd") | F.col("_opens_inside")
    passing = placed.filter(~broken).select("_file", "_row", "text")
    before = Window.partitionBy(*BLOCK).orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    states = placed.filter(broken).select("*", _odd(F.col("text")).alias("_odd"))
    states = states.select(
        "*",
        F.coalesce(F.count_if("_odd").over(before), F.lit(0)).alias("_odd_before"),
        F.coalesce(F.last(F.when(F.col("_odd"), F.col("_row")), ignorenulls=True).over(before), F.col("_opener")).alias("_opened"),
    )
    inside = (F.col("_odd_before") + F.col("_opens_inside").cast("int")) % 2 == 1
    record = F.when(inside, F.col("_opened")).otherwise(F.col("_row"))
    parts = F.array_sort(F.collect_list(F.struct("_row", "text")))
    joined = (
        states.select("_file", record.alias("_record"), "_row", "text")
        .groupBy("_file", "_record")
        .agg(F.array_join(F.transform(parts, lambda p: p["text"]), closing).alias("text"))
        .select("_file", F.col("_record").alias("_row"), "text")
    )
    return passing.unionByName(joined)


def read_json_array(spark: SparkSession, path: str | Sequence[str], schema: StructType = APPROACHES) -> DataFrame:
    """Records of files that hold one array of flat objects each; one file is read by many tasks.

    Values are numbers, texts, booleans or null, as in a table; a nested object is not read.  Fields that are absent or of
    another type are NULL, as with Spark's own reader.
    """
    objects = _whole(_pieces(spark, path, "}"), "}").select(F.regexp_extract("text", r"(?s)^\s*[\[,]?\s*(\{.*)$", 1).alias("text"))
    record = F.from_json(F.concat("text", F.lit("}")), schema)
    return objects.filter("text <> ''").select(record.alias("r")).select("r.*")


def parse_large_payload(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str] = RAW_COLUMNS,
    strict: bool = True,
) -> DataFrame:
    """Rows of payload files as ``parse_payload`` gives them, one file read by many tasks.

    ``_row`` rises with the row's place in its file, with gaps.  Cells are texts, numbers or null.  Members of the
    document may stand in any order.  ``strict`` checks all documents first and raises ValueError.
    """
    pieces = _whole(_pieces(spark, path, "]"), "]")
    dot = "(?s)"
    fields = F.regexp_extract("text", dot + FIELDS, 1)
    data = F.regexp_extract("text", dot + DATA, 1)
    opens_data = F.contains("text", F.lit('"data"')) & F.col("text").rlike(dot + DATA)
    has_fields = F.contains("text", F.lit('"fields"')) & F.col("text").rlike(dot + FIELDS)
    plain = F.regexp_extract("text", r"(?s)^\s*,?\s*(\[.*)$", 1)
    marked = pieces.select(
        "_file", "_row", F.when(opens_data, data).otherwise(plain).alias("row"), opens_data.alias("_data"),
        F.when(has_fields, fields).alias("_fields"),
    )
    if strict:
        checks = marked.groupBy("_file").agg(
            F.count("_fields").alias("fields"), F.count_if("_data").alias("data"), F.count_if(F.col("row").startswith("[")).alias("rows")
        )
        checks = checks.agg(
            F.expr("count_if(fields = 0 OR data = 0)").alias("bad"), F.expr("count_if(fields > 0 AND data > 0 AND rows = 0)").alias("empty")
        ).first()
        if checks["bad"]:
            raise ValueError("Invalid API response format")
        if checks["empty"]:
            raise ValueError("API returned empty dataset")
    texts = "array<string>"
    names = marked.filter("_fields IS NOT NULL").select(
        F.col("_file").alias("_of"), F.from_json(F.concat("_fields", F.lit("]")), texts).alias("fields")
    )
    positions = F.struct(*[F.array_position("fields", c).alias(c) for c in columns])
    names = names.select("_of", positions.alias("at"))  # one row a file
    rows = marked.filter(F.col("row").startswith("[")).select(
        "_file", "_row", F.from_json(F.concat("row", F.lit("]")), texts).alias("row")
    )
    cells = [
        F.when(F.col(f"at.{c}") > 0, F.try_element_at("row", F.col(f"at.{c}").cast("int"))).alias(c)
        for c in columns
    ]
    return rows.join(names, F.col("_file") == F.col("_of")).select(*cells, "_file", "_row")
