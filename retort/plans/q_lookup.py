"""Queries: reference lookup, caps, samples, splits, batches (C6, E3, E5,
E6, E7, D13)."""

from __future__ import annotations

from pyspark.sql import functions as F

from retort import constants as K
from retort.functions import text as T
from retort.operators import lookup as L
from retort.plans import adapters as A
from retort.plans import oracle as O
from retort.plans.catalog import register
from retort.plans.oracle import BASE
from retort.session import read_table

CAP_TARGET = 4000
SAMPLE_N = 2000


def _bucket_sql(key: str, seed: int = K.SPLIT_SEED) -> str:
    return f"(CAST(('0x' || substr(md5('{seed}:' || CAST({key} AS VARCHAR)), 1, 8)) AS BIGINT) % 10000)"


SPLIT_SQL = f"""CASE WHEN {_bucket_sql('o_orderkey')} < 8000 THEN 'train'
            WHEN {_bucket_sql('o_orderkey')} < 9000 THEN 'val' ELSE 'test' END"""


@register("train_split", f"""
SELECT split, count(*) AS n FROM (SELECT {SPLIT_SQL} AS split FROM orders) GROUP BY split""")
def q_train_split(spark, sf):
    o = read_table(spark, sf, "orders").select("o_orderkey")
    return L.split_counts(L.split(o, "o_orderkey"))


@register("split_rows", f"""
SELECT o_orderkey, {SPLIT_SQL} AS split FROM orders""")
def q_split_rows(spark, sf):
    o = read_table(spark, sf, "orders").select("o_orderkey")
    return L.split(o, "o_orderkey")


@register("batches", f"""
SELECT o_orderkey, CAST((row_number() OVER (ORDER BY md5('{K.SPLIT_SEED}:' || CAST(o_orderkey AS VARCHAR)), o_orderkey) - 1)
                        // {K.BATCH_SIZE} AS BIGINT) AS batch
FROM orders""")
def q_batches(spark, sf):
    o = read_table(spark, sf, "orders").select("o_orderkey")
    return L.assign_batches(o, "o_orderkey", K.BATCH_SIZE, seed=K.SPLIT_SEED)


@register("batches_eval", f"""
SELECT batch, count(*) AS n FROM (
  SELECT CAST((row_number() OVER (ORDER BY o_orderkey) - 1) // {K.BATCH_SIZE} AS BIGINT) AS batch
  FROM orders WHERE {SPLIT_SQL} = 'val') GROUP BY batch""")
def q_batches_eval(spark, sf):
    o = L.split(read_table(spark, sf, "orders").select("o_orderkey"), "o_orderkey").where(F.col("split") == "val")
    return L.assign_batches(o, "o_orderkey", K.BATCH_SIZE).groupBy("batch").agg(F.count(F.lit(1)).alias("n"))


@register("sample_n", f"""
SELECT o_orderkey, o_custkey FROM orders
ORDER BY md5('{K.SPLIT_SEED}:' || CAST(o_orderkey AS VARCHAR)), o_orderkey LIMIT {SAMPLE_N}""")
def q_sample_n(spark, sf):
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return L.sample_n(o, SAMPLE_N, "o_orderkey")


@register("cap_per_key", f"""
SELECT l_suppkey, l_orderkey, l_linenumber FROM (
  SELECT l_suppkey, l_orderkey, l_linenumber,
         row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber) AS rn
  FROM lineitem)
WHERE rn <= greatest(5, {CAP_TARGET} // (SELECT count(DISTINCT l_suppkey) FROM lineitem) + 5)
ORDER BY l_suppkey, rn LIMIT {CAP_TARGET}""")
def q_cap_per_key(spark, sf):
    li = read_table(spark, sf, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber")
    n_keys = li.agg(F.count_distinct("l_suppkey")).first()[0]
    return L.cap(li, "l_suppkey", ["l_orderkey", "l_linenumber"], L.per_key_cap(n_keys, CAP_TARGET), CAP_TARGET)


TERMS_SQL = """terms AS (
  SELECT DISTINCT CASE WHEN p_size % 2 = 0 THEN p_name || ' (' || p_brand || ')' ELSE lower(p_type) END AS term
  FROM part)"""


@register("lookup_reference", BASE.rstrip() + ",\n" + TERMS_SQL + """,
stripped AS (SELECT term, coalesce(nullif(regexp_replace(regexp_replace(term, '\\s*\\([^)]*\\)\\s*$', ''), '^\\s+|\\s+$', '', 'g'), ''), term) AS st
             FROM terms),
ref_firsts AS (SELECT lower(regexp_replace(name, '^\\s+|\\s+$', '', 'g')) AS k, arg_min(compound_id, ordinal) AS compound_id
           FROM compounds GROUP BY 1)
SELECT term, compound_id FROM stripped LEFT JOIN ref_firsts ON lower(regexp_replace(st, '^\\s+|\\s+$', '', 'g')) = k""")
def q_lookup_reference(spark, sf):
    p = read_table(spark, sf, "part")
    term = F.when(F.col("p_size") % 2 == 0, F.concat("p_name", F.lit(" ("), "p_brand", F.lit(")"))) \
        .otherwise(F.lower("p_type"))
    terms = p.select(term.alias("term")).distinct().withColumn("st", T.strip_paren("term"))
    out = L.lookup_reference(terms, A.compounds(spark, sf), term_col="st")
    return out.select("term", "compound_id")
