"""The training-data pipeline over ``documents``: toxicity, SimHash near-duplicates,
benchmark decontamination, secrets, BPE. Each stage's result is written as Parquet and
read back as the next one's input.

Defined results: rows with null or empty texts are clean documents (copies of each other
for the near-duplicate stage); every stage but the last returns exactly the columns it got;
an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starloom.llm import bpe, decontaminate, secret_scan, simhash_dedup, toxicity
from starloom.llm.common import table
from starloom.llm.queries import TOXIC_AT, token_columns, toxicity_model, vocabulary
from starloom.session import materialize, scratch, temporary_stages


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go; without labels of both classes there is no
    model and every document stays."""
    model = toxicity_model(spark, sf_dir)
    return docs if model.base is not None else toxicity.drop_toxic(docs, model, TOXIC_AT)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates stays, the one with the smallest id."""
    return simhash_dedup.keep_one(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays."""
    return secret_scan.mask(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with the digests of the ids and of the decoded text."""
    return bpe.encode_decode(docs, vocabulary()).select("doc_id", *token_columns(), "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_dedup", drop_near_duplicates),
    ("decontaminate", drop_benchmark),
    ("secrets", mask_secrets),
    ("bpe", tokenize),
]

#: A trained network decides the first stage, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table; the last stage's rows. What a stage stages on
    its way, and its input, are removed once its result is written."""
    docs, held = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        written = scratch(spark, f"pipeline-{name}")
        with temporary_stages(spark) as made:
            docs = materialize(stage(spark, docs, sf_dir), path=written, keep=True)
            if held:
                made.append(held)
        held = written
    return docs
