"""Queries: shingle similarity search."""

from __future__ import annotations

from pyspark.sql import functions as F

from retort.operators import similarity as S
from retort.plans.catalog import register
from retort.session import read_table

THRESHOLD = 90
K = S.SHINGLE_WORDS

SHINGLES_SQL = f"""WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[ \\t\\n\\r]+'), lambda x: length(x) > 0) AS words
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(words) >= {K}
                      THEN list_distinct(list_transform(range(1, len(words) - {K - 2}), lambda i: array_to_string(words[i:i + {K - 1}], ' ')))
                      ELSE [array_to_string(words, ' ')] END AS sh
  FROM w WHERE len(words) > 0),
long AS (SELECT doc_id, len(sh) AS s, unnest(sh) AS g FROM sets),
shared AS (
  SELECT a.doc_id AS ref_id, b.doc_id AS doc_id, count(*) AS i, any_value(a.s) AS sa, any_value(b.s) AS sb
  FROM long a JOIN long b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id)
"""


PAIRS_SQL = SHINGLES_SQL + f"""
SELECT ref_id, doc_id, round(i / (sa + sb - i), 6) AS jaccard FROM shared WHERE i * 100 >= (sa + sb - i) * {THRESHOLD}"""


@register("similar_docs", PAIRS_SQL)
def q_similar_docs(spark, sf):
    d = read_table(spark, sf, "documents")
    out = S.similar(d, threshold=THRESHOLD)
    return out.select("ref_id", "doc_id", F.round("jaccard", 6).alias("jaccard"))


@register("similar_lsh", PAIRS_SQL)
def q_similar_lsh(spark, sf):
    d = read_table(spark, sf, "documents")
    return S.similar_lsh(d, threshold=THRESHOLD).select("ref_id", "doc_id", F.round("jaccard", 6).alias("jaccard"))


@register("similar_sets", SHINGLES_SQL + f""",
classes AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY list_sort(sh)) AS set_id, len(sh) AS s FROM sets),
links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM classes a JOIN shared p ON p.ref_id = a.doc_id JOIN classes b ON b.doc_id = p.doc_id
          WHERE a.set_id = a.doc_id AND b.set_id = b.doc_id AND p.i * 100 >= (p.sa + p.sb - p.i) * {THRESHOLD}),
degree AS (SELECT id, count(*) AS n FROM (SELECT a AS id FROM links UNION ALL SELECT b FROM links) GROUP BY id)
SELECT c.doc_id, c.set_id, coalesce(d.n, 0) AS n_links FROM classes c LEFT JOIN degree d ON d.id = c.set_id""")
def q_similar_sets(spark, sf):
    """A row a document: the set of shingles it has (named by the least document that has it) and the number of
    other sets similar to that. Copies are never paired."""
    members, pairs = S.similar_sets(read_table(spark, sf, "documents"), threshold=THRESHOLD)
    names = members.groupBy("set").agg(F.min("id").alias("set_id"))
    degree = pairs.select(F.explode(F.array("a", "b")).alias("set")).groupBy("set").agg(F.count(F.lit(1)).alias("n"))
    return members.join(names, "set").join(degree, "set", "left").select(
        F.col("id").alias("doc_id"), "set_id", F.coalesce("n", F.lit(0)).alias("n_links"))


REF_THRESHOLD, REF_N = 5, 3


@register("similar_refs", f"""WITH texts AS (SELECT 'd' AS side, doc_id AS id, text FROM documents UNION ALL SELECT 'r', item_id, text FROM benchmark),
w AS (SELECT side, id, list_filter(regexp_split_to_array(lower(text), '[ \\t\\n\\r]+'), lambda x: length(x) > 0) AS words FROM texts),
sets AS (SELECT side, id, CASE WHEN len(words) >= {K}
                      THEN list_distinct(list_transform(range(1, len(words) - {K - 2}), lambda i: array_to_string(words[i:i + {K - 1}], ' ')))
                      ELSE [array_to_string(words, ' ')] END AS sh FROM w WHERE len(words) > 0),
long AS (SELECT side, id, len(sh) AS s, unnest(sh) AS g FROM sets),
shared AS (SELECT a.id AS ref_id, b.id AS doc_id, count(*) AS i, any_value(a.s) AS sa, any_value(b.s) AS sb
           FROM long a JOIN long b ON a.g = b.g AND a.side = 'r' AND b.side = 'd' GROUP BY a.id, b.id)
SELECT ref_id, doc_id, round(i / (sa + sb - i), 6) AS jaccard FROM shared WHERE i * 100 >= (sa + sb - i) * {REF_THRESHOLD}
QUALIFY row_number() OVER (PARTITION BY ref_id ORDER BY i / (sa + sb - i) DESC, doc_id) <= {REF_N}""")
def q_similar_refs(spark, sf):
    """The three documents nearest to each benchmark passage, from five per cent up."""
    items = read_table(spark, sf, "benchmark").select(F.col("item_id").alias("doc_id"), "text")
    out = S.similar(read_table(spark, sf, "documents"), refs=items, threshold=REF_THRESHOLD, n=REF_N)
    return out.select("ref_id", "doc_id", F.round("jaccard", 6).alias("jaccard"))
