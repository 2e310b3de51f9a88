"""SMILES token sequences: vocabulary, ids, encode/decode.

The vocabulary is the distinct token set of a corpus. Encoding and decoding
join it on the token (the id) and regroup by row key, whatever its size; only
the fixed fallback list is looked up in place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retort import constants as K
from retort.functions.smiles import encode, tokenize
from retort.operators.indexing import dense_index


def special_tokens_df(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(enumerate(K.SPECIAL_TOKENS)), "id BIGINT, token STRING")


def default_vocab(spark: SparkSession) -> DataFrame:
    """The fixed fallback vocabulary (specials, then the 33 listed tokens in
    their listed order)."""
    toks = K.SPECIAL_TOKENS + K.DEFAULT_VOCAB
    return spark.createDataFrame(list(enumerate(toks)), "id BIGINT, token STRING")


def build_vocab(df: DataFrame, col: str = "smiles", pattern: str = K.SMILES_PATTERN) -> DataFrame:
    """D6 + E10: specials (ids 0..3), then the corpus's distinct tokens in
    code-point order with dense ids from 4."""
    toks = df.select(F.explode(tokenize(col, pattern)).alias("token")).distinct()
    corpus = dense_index(toks, [F.col("token")], name="id", start=len(K.SPECIAL_TOKENS))
    return special_tokens_df(df.sparkSession).unionByName(corpus.select("id", "token"))


def encode_tokens(df: DataFrame, vocab: DataFrame | None = None, col: str = "smiles", key: str = "row_id",
                  special: bool = True, pattern: str = K.SMILES_PATTERN) -> DataFrame:
    """C8 + G4: token ids (unknown -> <unk>), optionally in <bos> .. <eos>.

    Without ``vocab`` the fixed fallback list is used in place. A vocabulary
    table of any size is joined on the token, and each row's ids are put back
    in order (``key`` must be unique). Returns the input columns plus ``ids``.
    """
    toks = tokenize(col, pattern)
    if vocab is None:
        fixed = F.array(*[F.lit(t) for t in K.SPECIAL_TOKENS + K.DEFAULT_VOCAB])
        at = F.transform(toks, lambda t: F.coalesce(F.array_position(fixed, t), F.lit(0)))
        ids = F.transform(at, lambda i: F.when(i > 0, i - 1).otherwise(F.lit(K.UNK_ID)).cast("bigint"))
        return df.withColumn("ids", encode(ids, special))
    long = df.select(key, F.posexplode(toks).alias("pos", "token"))
    hit = long.join(vocab.select("token", "id"), "token", "left")
    out = _in_order(df, hit, key, F.coalesce("id", F.lit(K.UNK_ID).cast("bigint")), "ids", "array<bigint>")
    return out.withColumn("ids", encode(F.col("ids"), special))


def decode_tokens(df: DataFrame, vocab: DataFrame, col: str = "ids", key: str = "row_id", skip_special: bool = True) -> DataFrame:
    """Ids back to text by a join on the id; specials skipped, unknown
    ids give ''. Returns the input columns plus ``decoded``."""
    long = df.select(key, F.posexplode(col).alias("pos", "id"))
    if skip_special:
        long = long.where(F.col("id") >= len(K.SPECIAL_TOKENS))
    hit = long.join(vocab.select("id", "token"), "id", "left")
    out = _in_order(df, hit, key, F.coalesce("token", F.lit("")), "_tokens", "array<string>")
    return out.withColumn("decoded", F.array_join("_tokens", "")).drop("_tokens")


def _in_order(df: DataFrame, hit: DataFrame, key: str, value, name: str, kind: str) -> DataFrame:
    """``df`` with each row's values of ``hit`` as an array by ``pos`` (a row's own tokens: a bounded group)."""
    per_row = hit.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("pos", value.alias("v")))).alias("_p"))
    return df.join(per_row, key, "left").withColumn(name, F.coalesce(F.transform("_p", lambda s: s["v"]), F.array().cast(kind))).drop("_p")
