"""A training corpus from documents: graded, deduplicated, decontaminated, redacted and packed.

Every stage takes (spark, docs, folder) and works on all that its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.credentials import HANDFUL, redact_secrets
from tidemill.llm.decontaminate import without_leaks
from tidemill.llm.packing import pack_documents
from tidemill.llm.quality import accepted_documents, fit_on_ratings, graded_labels
from tidemill.llm.queries import tokenizer_file
from tidemill.llm.simhash import one_of_each
from tidemill.session import pin_utc, scratch_path


def quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The documents that the ordinal model accepts."""
    labels = spark.read.parquet(f"{folder.rstrip('/')}/labels.parquet")
    return accepted_documents(docs, fit_on_ratings(docs, graded_labels(labels), n_grades=3))


def near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each SimHash component."""
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The documents that leak no benchmark item."""
    return without_leaks(docs, spark.read.parquet(f"{folder.rstrip('/')}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The same documents with their secrets replaced."""
    repo = F.concat_ws("/", "source", "lang")
    return redact_secrets(docs, repo=repo, owner=F.col("source"), length_col="n_chars", most_owners=HANDFUL, examples=True)


def packing(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Where every piece of every document stands in sequences of 2,048 tokens."""
    return pack_documents(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("secret scans", secrets),
    ("best-fit packing", packing),
]

#: neither the model nor the tokenizer can be said in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, each written as Parquet and read again."""
    pin_utc(spark)
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
