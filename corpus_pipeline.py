"""Training-data pipeline over ``documents``: five stages, each written as Parquet and read by the next.

toxicity    documents that the lexicon scores 0.3 or more go
near_dups   one document of each group of SimHash near-duplicates stays (3-word shingles, 3 bits)
leaks       documents that hold a benchmark item go
secrets     secrets in the texts are masked; every document stays
packing     the rest is packed into sequences of 4096 tokens at the sources' own shares
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from retort.llm import decontaminate, packing, secrets, simhash, toxicity
from retort.llm.common import materialize
from retort.llm.queries import documents, tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), max_rows=20000)
    return toxicity.drop_toxic(docs, model, threshold=0.3)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, shingle=3, radius=3)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.mask_secrets(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_path(), eos=2, window=4096)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dups", drop_near_duplicates),
    ("leaks", drop_leaks),
    ("secrets", mask_secrets),
    ("packing", pack),
]

#: The stages run learned weights, fingerprints and a tokenizer: not SQL. Tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of the last stage."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
