"""The registered queries of this package: each reads its whole table and gives the operator's full result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from retort.llm import decontaminate, fingerprint, oracle, packing, periodic, pii, quality, ranking, secrets, simhash, substring, tokens, toxicity, warc
from retort.session import scratch_path

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir), shingle=3, radius=3)


def op2_warc_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "archive")
    warc.write_archive(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    return warc.digest(warc.resolved(warc.read_archive(spark, path)))


def op3_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), tokenizer_path(), eos=2, window=4096)


def op4_quartile_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(documents(spark, sf_dir))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), max_rows=20000)
    return toxicity.score(docs, model, threshold=0.3)


def op6_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.find_secrets(documents(spark, sf_dir)))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(documents(spark, sf_dir), tokenizer_path(), limit=2048)


def op9_pii_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find_pii(documents(spark, sf_dir)))


def op10_super_kmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.digest(substring.remove_repeats(documents(spark, sf_dir), window=50))


def op11_lexical_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.rank(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), k=50)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digest(periodic.periodic_runs(documents(spark, sf_dir), plant=True))


def op13_quality_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.digest(quality.judge(quality.ledger(documents(spark, sf_dir))))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_simhash_dedup, op2_warc_chain, op3_mixture_packing, op4_quartile_digest, op5_toxicity, op6_benchmark_leaks, op7_secret_scan,
                            op8_token_counts, op9_pii_anchors, op10_super_kmers, op11_lexical_ranking, op12_periodic_runs, op13_quality_ledger)
}
ORACLE: dict[str, str] = {
    "op11_lexical_ranking": oracle.RANKING,
    "op13_quality_ledger": oracle.quality(quality.RULES, quality.PROSE.name, quality.PROSE.mask, quality.PROSE.rules, quality.BITS),
}
