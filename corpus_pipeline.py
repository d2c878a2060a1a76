"""A corpus pipeline of five stages, each an operator of veinstone.llm.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet in the
shared folder and read again as the next one's docs. All but the last return the columns of
`documents`: the quality rules drop rejected documents, the near-duplicate stage keeps one
document of each class, personal data is replaced in the text, documents are repeated to the
target weights of their sources, and the last stage encodes the texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veinstone.llm import mixing, neardup, pieces, pii, quality
from veinstone.llm.common import discard, fresh, table, written
from veinstone.llm.queries import PIECES


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule rejects."""
    return quality.filter_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return neardup.deduplicate(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind; n_chars follows a changed text."""
    (was,) = fresh(docs, "text")
    clean = pii.redact(docs.withColumn(was, F.length("text")))
    changed = F.length("text") != F.col(was)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.when(changed, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return clean.select(*docs.columns)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to their sources' target weights, in random order."""
    return mixing.replicate(docs).select(*docs.columns)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every document."""
    return pieces.encode(docs, PIECES)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("source_mixing", source_mixing),
    ("sentencepiece", sentencepiece),
]

#: The near-duplicate stage and the CRF cannot be put in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        before, docs = docs, stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs, name)
            if k:
                discard(before)
    return docs
