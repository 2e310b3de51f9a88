"""Queries: cleaning, dedupe, tag reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from retort.functions import text as T
from retort.operators import clean as C
from retort.plans import adapters as A
from retort.plans.catalog import register
from retort.plans.oracle import BASE, clean_tags_sql


def cleaned(spark, sf):
    return C.clean_compounds(A.compounds(spark, sf))


@register("top_tags", BASE + """
SELECT tag, count(*) AS n
FROM (SELECT unnest(applications) AS tag FROM cleaned) WHERE length(tag) > 0
GROUP BY tag ORDER BY n DESC, tag LIMIT 10""")
def q_top_tags(spark, sf):
    return C.top_tags(cleaned(spark, sf))


@register("count_by_source", BASE + """
SELECT source, count(*) AS n FROM cleaned GROUP BY source""")
def q_count_by_source(spark, sf):
    return C.count_by_source(cleaned(spark, sf))


@register("avg_tags", BASE + """
SELECT round(avg(CAST(len(applications) AS DOUBLE)), 6) AS avg_tags FROM cleaned""")
def q_avg_tags(spark, sf):
    return C.avg_tags(cleaned(spark, sf))


@register("dedupe_first", BASE + """
SELECT smiles, compound_id, source, name FROM cleaned""")
def q_dedupe_first(spark, sf):
    return cleaned(spark, sf).select("smiles", "compound_id", "source", "name")


@register("drop_missing", BASE + """
SELECT count(*) AS n_rows, count(DISTINCT smiles) AS n_smiles FROM present""")
def q_drop_missing(spark, sf):
    df = C.drop_missing(A.compounds(spark, sf), ["smiles"])
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("smiles").alias("n_smiles"))


@register("clean_tags", BASE + f"""
SELECT row_id,
       array_to_string({clean_tags_sql('applications')}, '|') AS from_list,
       array_to_string({clean_tags_sql("string_split(array_to_string(applications, ','), ',')")}, '|') AS from_csv
FROM compounds""")
def q_clean_tags(spark, sf):
    df = A.compounds(spark, sf)
    return df.select(
        "row_id",
        F.array_join(T.clean_tags("applications"), "|").alias("from_list"),
        F.array_join(T.clean_tags_from_string(F.array_join("applications", ",")), "|").alias("from_csv"),
    )


@register("label_classes", BASE + """
SELECT CAST(row_number() OVER (ORDER BY label) - 1 AS BIGINT) AS label_id, label
FROM (SELECT DISTINCT unnest(applications) AS label FROM cleaned)""")
def q_label_classes(spark, sf):
    return C.label_classes(cleaned(spark, sf))


@register("multi_hot", BASE + """,
classes AS (
  SELECT CAST(row_number() OVER (ORDER BY label) - 1 AS BIGINT) AS label_id, label
  FROM (SELECT DISTINCT unnest(applications) AS label FROM cleaned))
SELECT row_id, label_id
FROM (SELECT row_id, unnest(list_distinct(applications)) AS label FROM cleaned)
JOIN classes USING (label)""")
def q_multi_hot(spark, sf):
    df = cleaned(spark, sf)
    return C.multi_hot(df, C.label_classes(df))


@register("multi_hot_rows", BASE + """,
classes AS (
  SELECT row_number() OVER (ORDER BY label) - 1 AS label_id, label
  FROM (SELECT DISTINCT unnest(applications) AS label FROM cleaned)),
bits AS (SELECT row_id, label_id FROM (SELECT row_id, unnest(list_distinct(applications)) AS label FROM cleaned) JOIN classes USING (label))
SELECT c.row_id, coalesce(string_agg(CAST(label_id AS VARCHAR), ' ' ORDER BY label_id), '') AS hot
FROM cleaned c LEFT JOIN bits b ON c.row_id = b.row_id GROUP BY c.row_id""")
def q_multi_hot_rows(spark, sf):
    df = cleaned(spark, sf)
    return C.multi_hot_rows(df, C.label_classes(df)).select("row_id", F.array_join("hot", " ").alias("hot"))


@register("parse_list", BASE + """
SELECT row_id, array_to_string(from_json(replace(lit, '''', '"'), '["VARCHAR"]'), '|') AS parsed
FROM (SELECT row_id, '[' || array_to_string(list_transform(applications, lambda x: '''' || x || ''''), ', ') || ']' AS lit
      FROM compounds)""")
def q_parse_list(spark, sf):
    df = A.compounds(spark, sf).select("row_id", T.list_literal("applications").alias("lit"))
    return df.select("row_id", F.array_join(T.parse_list("lit"), "|").alias("parsed"))


# one-hot over the first five sources; the sixth falls into the 'Unknown' slot
ONE_HOT_CATS = A.SOURCE_ORDER[:5] + ["Unknown"]


def _one_hot_sql(col: str, cats) -> str:
    known = cats[:-1]
    hits = ", ".join(f"CASE WHEN {col} = '{c}' THEN 1 ELSE 0 END" for c in known)
    miss = f"CASE WHEN {col} IN ({', '.join(repr(c) for c in known)}) THEN 0 ELSE 1 END"
    return f"concat_ws(' ', {hits}, {miss})"


@register("one_hot", f"""
SELECT p_partkey, {_one_hot_sql('p_type', ONE_HOT_CATS)} AS one_hot FROM part""")
def q_one_hot(spark, sf):
    from retort.session import read_table
    p = read_table(spark, sf, "part")
    v = T.one_hot(F.col("p_type"), ONE_HOT_CATS)
    return p.select("p_partkey", F.array_join(F.transform(v, lambda x: x.cast("int").cast("string")), " ")
                    .alias("one_hot"))
