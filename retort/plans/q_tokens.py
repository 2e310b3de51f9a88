"""Queries: SMILES tokens, vocabulary, encode/decode, label pairing
(G3, G4, D6, E10, C8, C9, C10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from retort import constants as K
from retort.functions.smiles import tokenize
from retort.operators import clean as C
from retort.operators import tokens as TK
from retort.plans import adapters as A
from retort.plans import oracle as O
from retort.plans.catalog import register
from retort.plans.oracle import BASE

PAT = O._q(K.SMILES_PATTERN)
SPECIALS = ", ".join(f"({i}, {O._q(t)})" for i, t in enumerate(K.SPECIAL_TOKENS))
DEFAULT_LIST = O._list(K.SPECIAL_TOKENS + K.DEFAULT_VOCAB)

VOCAB = BASE.rstrip() + f""",
corpus AS (SELECT DISTINCT unnest(regexp_extract_all(smiles, {PAT}, 1)) AS token FROM cleaned),
vocab AS (
  SELECT CAST(id AS BIGINT) AS id, token FROM (VALUES {SPECIALS}) s(id, token)
  UNION ALL
  SELECT CAST(row_number() OVER (ORDER BY token) + {len(K.SPECIAL_TOKENS) - 1} AS BIGINT) AS id, token FROM corpus)
"""


def _cleaned(spark, sf):
    return C.clean_compounds(A.compounds(spark, sf))


@register("tokenize", BASE + f"""
SELECT row_id, array_to_string(regexp_extract_all(smiles, {PAT}, 1), ' ') AS tokens,
       CAST(len(regexp_extract_all(smiles, {PAT}, 1)) AS BIGINT) AS n_tokens
FROM present""")
def q_tokenize(spark, sf):
    df = C.drop_missing(A.compounds(spark, sf), ["smiles"])
    toks = tokenize("smiles")
    return df.select("row_id", F.array_join(toks, " ").alias("tokens"), F.size(toks).cast("bigint").alias("n_tokens"))


@register("build_vocab", VOCAB + "SELECT id, token FROM vocab")
def q_build_vocab(spark, sf):
    return TK.build_vocab(_cleaned(spark, sf))


@register("encode_tokens", BASE + f"""
SELECT row_id, array_to_string(list_concat([{K.BOS_ID}],
         list_transform(regexp_extract_all(smiles, {PAT}, 1),
                        lambda t: CASE WHEN list_contains({DEFAULT_LIST}, t) THEN list_position({DEFAULT_LIST}, t) - 1 ELSE {K.UNK_ID} END),
         [{K.EOS_ID}]), ' ') AS ids
FROM cleaned""")
def q_encode_tokens(spark, sf):
    df = TK.encode_tokens(_cleaned(spark, sf))
    return df.select("row_id", F.array_join("ids", " ").alias("ids"))


@register("encode_tokens_join", BASE + f"""
SELECT row_id, array_to_string(list_concat([{K.BOS_ID}],
         list_transform(regexp_extract_all(smiles, {PAT}, 1),
                        lambda t: CASE WHEN list_contains({DEFAULT_LIST}, t) THEN list_position({DEFAULT_LIST}, t) - 1 ELSE {K.UNK_ID} END),
         [{K.EOS_ID}]), ' ') AS ids
FROM cleaned""")
def q_encode_tokens_join(spark, sf):
    df = TK.encode_tokens(_cleaned(spark, sf), TK.default_vocab(spark))
    return df.select("row_id", F.array_join("ids", " ").alias("ids"))


@register("decode_roundtrip", VOCAB + f"""
SELECT row_id, array_to_string(regexp_extract_all(smiles, {PAT}, 1), '') AS decoded,
       CAST(len(regexp_extract_all(smiles, {PAT}, 1)) + 2 AS BIGINT) AS n_ids
FROM cleaned""")
def q_decode_roundtrip(spark, sf):
    df = _cleaned(spark, sf)
    vocab = TK.build_vocab(df)
    enc = TK.encode_tokens(df, vocab)
    dec = TK.decode_tokens(enc, vocab)
    return dec.select("row_id", "decoded", F.size("ids").cast("bigint").alias("n_ids"))


@register("with_labels", BASE.rstrip() + """,
classes AS (
  SELECT CAST(row_number() OVER (ORDER BY label) - 1 AS BIGINT) AS label_id, label
  FROM (SELECT DISTINCT unnest(applications) AS label FROM cleaned)),
hot AS (
  SELECT row_id, label_id FROM (SELECT row_id, unnest(list_distinct(applications)) AS label FROM cleaned)
  JOIN classes USING (label)),
per_row AS (SELECT row_id, array_to_string(list_sort(list(label_id)), ' ') AS labels FROM hot GROUP BY row_id)
SELECT c.row_id, c.smiles, coalesce(p.labels, '') AS labels
FROM cleaned c LEFT JOIN per_row p ON c.row_id = p.row_id""")
def q_with_labels(spark, sf):
    df = _cleaned(spark, sf)
    hot = C.multi_hot(df, C.label_classes(df))
    per_row = hot.groupBy("row_id").agg(
        F.array_join(F.array_sort(F.collect_list("label_id")), " ").alias("labels"))
    return (df.select("row_id", "smiles").join(per_row, "row_id", "left")
            .select("row_id", "smiles", F.coalesce("labels", F.lit("")).alias("labels")))
