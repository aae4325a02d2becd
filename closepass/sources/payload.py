"""Payload documents: ``{"fields": [...], "data": [[...], ...]}``."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from closepass.functions.numeric import count_if
from closepass.schema import PAYLOAD, RAW_COLUMNS
from closepass.sources.arrays import parse_large_payload


def parse_payload(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str] = RAW_COLUMNS,
    strict: bool = True,
    split: bool = False,
) -> DataFrame:
    """Rows of one or many payload files, all columns text, absent columns NULL.

    Adds ``_file`` and ``_row``, the source order that ``dedupe_by_key`` needs.  Files
    are read in parallel; one file is one document and one task, unless ``split`` is set: then any number of
    tasks read a file, and ``_row`` has gaps.  Column positions are looked up once per document, not once per row.

    ``strict`` checks all documents first and raises ValueError; without it a bad
    document fails the job when its rows are computed.
    """
    if split:
        return parse_large_payload(spark, path, columns, strict)
    documents = spark.read.schema(PAYLOAD).option("multiLine", True).json(path)
    malformed = F.col("fields").isNull() | F.col("data").isNull()
    empty = F.size("data") == 0
    if strict:
        checks = documents.agg(
            count_if(malformed).alias("bad"), count_if(~malformed & empty).alias("empty")
        ).first()
        if checks["bad"]:
            raise ValueError("Invalid API response format")
        if checks["empty"]:
            raise ValueError("API returned empty dataset")
    return _rows(documents.select(F.col("_metadata.file_path").alias("_file"), "fields", "data"), columns)


def payload_texts(texts: DataFrame, text: str, key: str, columns: Sequence[str] = RAW_COLUMNS) -> DataFrame:
    """Rows of a table of payload documents, one whole document a row: ``columns``, ``_file`` (its ``key``) and ``_row``.

    A text that is no payload fails the job when its rows are computed; a NULL text has no row.
    """
    documents = texts.filter(F.col(text).isNotNull()).select(F.col(key).alias("_file"), F.from_json(text, PAYLOAD).alias("d"))
    return _rows(documents.select("_file", "d.fields", "d.data"), columns)


def _rows(documents: DataFrame, columns: Sequence[str]) -> DataFrame:
    malformed = F.col("fields").isNull() | F.col("data").isNull()
    empty = F.size("data") == 0
    positions = F.struct(*[F.array_position("fields", c).alias(c) for c in columns])
    rows = documents.select(
        "_file",
        positions.alias("at"),
        F.posexplode(
            F.when(malformed, F.raise_error(F.lit("Invalid API response format")))
            .when(empty, F.raise_error(F.lit("API returned empty dataset")))
            .otherwise(F.col("data"))
        ).alias("_row", "row"),
    )
    cells = [
        F.when(F.col(f"at.{c}") > 0, F.try_element_at("row", F.col(f"at.{c}").cast("int"))).alias(c)
        for c in columns
    ]
    return rows.select(*cells, "_file", "_row")
