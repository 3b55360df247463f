"""The corpus pipeline: language ID, SimHash near-duplicates, secrets, mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the one before has kept. The result
of a stage is written to the shared folder and read again, so a stage starts from files.
"""

from pyspark.sql import DataFrame, SparkSession

from farelens.llm.common import stored_table
from farelens.llm.histogram_packing import pack
from farelens.llm.language_id import keep_identified
from farelens.llm.mixing import sample_mixture
from farelens.llm.secrets import mask_secrets
from farelens.llm.simhash import drop_near_duplicates


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the language models reject go."""
    return keep_identified(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return drop_near_duplicates(docs, shingle=3, distance=3)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; every document stays."""
    return mask_secrets(docs, scope=200)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are sampled to the target weights of source, language and topic."""
    return sample_mixture(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in sequences of 4096 tokens."""
    return pack(docs, window=4096)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("mixing", mixing),
    ("packing", packing),
]
#: No stage but the sampling could be written in SQL; tests/llm/test_pipeline.py is the check.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored_table(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
