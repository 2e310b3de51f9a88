"""Testdata adapters: turn the driver's tables into the pipeline's inputs.

Each adapter is a pure DataFrame transformation of the given tables, so its
work grows with them. The same rules are written as SQL in
``retort.plans.oracle`` for the DuckDB check.

compounds   part x the 18 inline samples (joined on p_partkey % 18); every
            part row is one collected compound. A chain that spells
            p_partkey div 18 in binary (C for 0, N for 1) makes SMILES as
            distinct as the rows, but that every tenth value repeats the one
            before it; p_size 50 / 49 / 48 mark a missing, an empty and a
            malformed (unbalanced) SMILES so the cleaning steps have work to do.
patents     documents as patent rows (title = first line, abstract = text).
answers     assistant turns of conversations as landed answers.
vectors     embeddings (64-d) as router logits / node features.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retort import constants as K
from retort.session import read_table

SAMPLES = K.INDUSTRIAL_SAMPLES + K.PHARMA_SAMPLES
N_SAMPLES = len(SAMPLES)
# plan order of sources (first wins on duplicate SMILES)
SOURCE_ORDER = ["PROMO", "STANDARD", "SMALL", "MEDIUM", "LARGE", "ECONOMY"]


def samples_df(spark: SparkSession) -> DataFrame:
    """The 18 inline sample compounds as a tiny literal table."""
    rows = [(i, s, n, list(a)) for i, (s, n, a) in enumerate(SAMPLES)]
    return spark.createDataFrame(
        rows, "sample_idx INT, sample_smiles STRING, sample_name STRING, sample_apps ARRAY<STRING>")


def source_rank(col) -> F.Column:
    expr = F.lit(len(SOURCE_ORDER))
    for i, name in reversed(list(enumerate(SOURCE_ORDER))):
        expr = F.when(col == name, F.lit(i)).otherwise(expr)
    return expr


def compounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read_table(spark, sf_dir, "part")
    # 18 fixed rows: a size-bounded broadcast
    s = F.broadcast(samples_df(spark))
    joined = part.join(s, (part.p_partkey % N_SAMPLES) == s.sample_idx)
    k = (F.col("p_partkey") / N_SAMPLES).cast("bigint")
    k = k - F.when(k % 10 == 9, 1).otherwise(0)
    suffix = F.when(k == 0, "").otherwise(F.translate(F.bin(k), "01", "CN"))
    smiles = (F.when(F.col("p_size") == 50, F.lit(None).cast("string"))
              .when(F.col("p_size") == 49, F.lit(""))
              .when(F.col("p_size") == 48, F.concat("sample_smiles", F.lit(")")))
              .otherwise(F.concat("sample_smiles", suffix)))
    return joined.select(
        F.col("p_partkey").alias("row_id"),
        smiles.alias("smiles"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("source"),
        source_rank(F.col("p_type")).alias("source_rank"),
        F.col("p_partkey").alias("ordinal"),
        F.format_string("CMP_%08d", F.col("p_partkey")).alias("compound_id"),
        F.concat("sample_apps", F.split("p_name", " "), F.array("p_type", "p_brand")).alias("applications"),
    )


# vocabulary of the generated patent prose, passed to the relevance filter
# in place of the chemistry words (which never occur in it)
TEXT_SUBJECT_WORDS = ["the", "der", "les", "los"]
TEXT_USE_WORDS = ["and", "und", "des", "las"]
TEXT_TITLE_WORDS = ["the", "die", "le", "el"]
TEXT_FIELD_WORDS = ["of", "von", "et", "por"]


def patents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as the patent table of the relevance query."""
    d = read_table(spark, sf_dir, "documents")
    first_line = F.substring_index(F.col("text"), "\n", 1)
    day = F.date_add(F.lit("2017-06-01").cast("date"), (F.col("doc_id") % 2000).cast("int"))
    cpc_code = (F.when(F.col("doc_id") % 5 == 0, F.lit("C07D"))
                .when(F.col("doc_id") % 7 == 0, F.lit("A61K31"))
                .when(F.col("doc_id") % 11 == 0, F.lit("A01N25"))
                .otherwise(F.lit("G06F")))
    return d.select(
        F.format_string("US-%07d", F.col("doc_id")).alias("publication_number"),
        F.col("doc_id"),
        first_line.alias("title"),
        F.col("text").alias("abstract"),
        day.alias("filing_date"),
        F.date_add(day, 30).alias("publication_date"),
        F.upper(F.col("lang")).alias("country_code"),
        F.array(F.struct(F.col("source").alias("name"))).alias("assignee_harmonized"),
        F.array(F.struct(cpc_code.alias("code")), F.struct(F.lit("Y02P").alias("code"))).alias("cpc"),
    )


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """assistant turns of conversations as landed answers ``(key, raw_text)``."""
    c = read_table(spark, sf_dir, "conversations")
    return (c.where(F.col("role") == "assistant")
            .select(F.format_string("%d:%d", "conv_id", "turn").alias("key"),
                    F.col("conv_id"), F.col("turn"), F.col("text").alias("raw_text")))
