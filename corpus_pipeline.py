"""The pipeline over ``documents``: stages of the text operators, each written and read again.

A stage is (spark, docs, sf_dir) -> DataFrame and works on all rows its predecessor kept. All but the
last return the columns of ``documents``; the last adds ``ids``, the tokens of each text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tradeloom.llm import bpe, decontamination, jaccard, secrets, toxicity
from tradeloom.llm.queries import vocabulary_path
from tradeloom.session import ship, work_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score one half or more go; the model learns from the labels of those that are here."""
    return toxicity.keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that share 80 % of their 5-word shingles the one with the least id stays."""
    return jaccard.keep_first(docs, size=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more are benchmark passages go."""
    return decontamination.remove_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets give way to a mark; every document stays."""
    return secrets.redact(docs, secrets.train(secrets.labelled_samples(docs)))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each text's token ids are added; a text that its ids do not decode to would be left out."""
    path = vocabulary_path()
    coded = bpe.decode(bpe.encode(docs, path), path, text_col="_decoded")
    return coded.where("coalesce(text, '') = _decoded").drop("_decoded")


STAGES = [
    ("toxicity", drop_toxic),
    ("near copies", drop_near_copies),
    ("decontamination", decontaminate),
    ("secrets", hide_secrets),
    ("tokens", tokenise),
]

#: No SQL for trained models and tokens; tests/llm/test_pipeline.py holds run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written to the shared folder and read again as the next one's input."""
    ship(spark)
    docs, path = spark.read.parquet(f"{sf_dir}/documents.parquet"), work_dir(spark, "pipeline")
    for number, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{path}/{number}")
        docs = spark.read.parquet(f"{path}/{number}")
    return docs
