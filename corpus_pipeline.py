"""The corpus pipeline: toxicity, near duplicates, benchmark decontamination, secrets, packing.

Every stage takes (spark, docs, sf_dir) and works on all documents that the one before it kept; all but the last
return the columns of documents.  Rows that share a doc_id are one document to the second and third stage: they
stay or go together, except that of rows equal in doc_id and text any one stays, with its other columns.  Other columns may have any names.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from closepass.llm import decontamination, near_duplicates, packing, secrets, toxicity
from closepass.llm.store import stored
from closepass.llm.tokens import default_path

ORACLE_SQL = None  # a fitted classifier, sketches and a tokenizer are not SQL


def _unused(docs: DataFrame, name: str) -> str:
    """`name`, made longer until no column of `docs` has it."""
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    return name


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores below 0.5."""
    return toxicity.without_toxic(docs, toxicity.fit(toxicity.training_rows(spark, sf_dir)))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least doc_id of each class of near duplicates; a row without one is a document too."""
    key = _unused(docs, "class_id")
    kept = near_duplicates.near_duplicates(docs).select(F.col("class_id").alias(key)).distinct()
    rows = docs.join(kept, near_duplicates.document_id() == F.col(key), "left_semi")
    return rows.dropDuplicates(["doc_id", "text"])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontamination.contamination(docs, items).where("n_hit > 0")
    key = _unused(docs, "found")
    found = found.select(F.col("doc_id").alias(key)).distinct()
    return docs.join(found, docs["doc_id"].eqNullSafe(found[key]), "left_anti")


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked in their texts."""
    return secrets.without_secrets(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their ids and their places in packed sequences."""
    return packing.packed(docs, default_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", mask_secrets),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of `sf_dir`, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
