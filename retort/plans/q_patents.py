"""Queries: patent relevance, newest-first scan, candidates, identities,
id formats (A6, B4, B6, B7, C4, E2, E4, G5, G6, G13, G15)."""

from __future__ import annotations

from pyspark.sql import functions as F

from retort import constants as K
from retort.functions import text as T
from retort.operators import patents as P
from retort.plans import adapters as A
from retort.plans import oracle as O
from retort.plans.catalog import register
from retort.session import read_table, spread

PATENTS = f"""patents AS (
  SELECT printf('US-%07d', doc_id) AS publication_number, doc_id,
         split_part(text, chr(10), 1) AS title, text AS abstract,
         DATE '2017-06-01' + CAST(doc_id % 2000 AS INTEGER) AS filing_date,
         DATE '2017-06-01' + CAST(doc_id % 2000 AS INTEGER) + 30 AS publication_date,
         upper(lang) AS country_code,
         [{{'name': source}}] AS assignee_harmonized,
         [{{'code': CASE WHEN doc_id % 5 = 0 THEN 'C07D' WHEN doc_id % 7 = 0 THEN 'A61K31'
                        WHEN doc_id % 11 = 0 THEN 'A01N25' ELSE 'G06F' END}}, {{'code': 'Y02P'}}] AS cpc
  FROM documents)"""

FILTER_ARGS = dict(country="EN", since=K.PATENT_SINCE, subject=A.TEXT_SUBJECT_WORDS, use=A.TEXT_USE_WORDS,
                   title_words=A.TEXT_TITLE_WORDS, fields=A.TEXT_FIELD_WORDS)


def _alt(ws):
    return "(?:" + "|".join(ws) + ")"


RELEVANT = f"""relevant AS (
  SELECT * FROM patents
  WHERE country_code = 'EN' AND publication_date >= DATE '{K.PATENT_SINCE}'
    AND abstract IS NOT NULL AND length(abstract) > {K.PATENT_MIN_ABSTRACT} AND length(title) > {K.PATENT_MIN_TITLE}
    AND ((regexp_matches(lower(abstract), '\\b{_alt(A.TEXT_SUBJECT_WORDS)}\\s+\\w+\\b')
          AND regexp_matches(lower(abstract), '\\b{_alt(A.TEXT_USE_WORDS)}\\b'))
      OR (regexp_matches(lower(title), '\\b{_alt(A.TEXT_TITLE_WORDS)}\\b')
          AND regexp_matches(lower(abstract), '\\b{_alt(A.TEXT_FIELD_WORDS)}\\b'))
      OR len(list_filter(cpc, lambda c: starts_with(c.code, 'C07') OR starts_with(c.code, 'A61K')
                                         OR starts_with(c.code, 'A01N'))) > 0))"""

SCAN_LIMIT = 2 * 100


@register("patent_filter", O.with_ctes(PATENTS, RELEVANT) + "SELECT publication_number FROM relevant")
def q_patent_filter(spark, sf):
    return P.relevant_patents(A.patents(spark, sf), **FILTER_ARGS).select("publication_number")


@register("patent_scan", O.with_ctes(PATENTS, RELEVANT) + f"""
SELECT publication_number, title, CAST(filing_date AS VARCHAR) AS filing_date,
       assignee_harmonized[1].name AS assignee, array_to_string(list_transform(cpc, lambda c: c.code), ',') AS cpc_codes
FROM relevant ORDER BY filing_date DESC NULLS LAST, publication_number LIMIT {SCAN_LIMIT}""")
def q_patent_scan(spark, sf):
    df = P.scan_patents(A.patents(spark, sf), SCAN_LIMIT, **FILTER_ARGS)
    return df.select("publication_number", "title", F.col("filing_date").cast("string").alias("filing_date"),
                     F.col("assignee_harmonized")[0]["name"].alias("assignee"),
                     F.array_join(F.transform("cpc", lambda c: c["code"]), ",").alias("cpc_codes"))


@register("newest_limit", O.with_ctes(PATENTS) + f"""
SELECT publication_number, CAST(filing_date AS VARCHAR) AS filing_date
FROM patents ORDER BY filing_date DESC NULLS LAST, publication_number LIMIT {SCAN_LIMIT}""")
def q_newest_limit(spark, sf):
    df = P.newest(A.patents(spark, sf), "filing_date", SCAN_LIMIT)
    return df.select("publication_number", F.col("filing_date").cast("string").alias("filing_date"))


def patent_candidates(spark, sf):
    p = spread(A.patents(spark, sf))
    return p.select("publication_number", "doc_id", P.candidates(T.join_text("title", "abstract")).alias("cands"))


@register("candidates")
def q_candidates(spark, sf):
    return patent_candidates(spark, sf).select("doc_id", F.array_join("cands", "|").alias("candidates"))


@register("candidates_ctx")
def q_candidates_ctx(spark, sf):
    """G6 alone: the context-pattern captures, stripped, non-blank, first 5."""
    p = spread(A.patents(spark, sf))
    c = P.candidates(T.join_text("title", "abstract"), patterns=[])
    return p.select("doc_id", F.array_join(c, "|").alias("candidates"))


@register("first_n")
def q_first_n(spark, sf):
    return P.first_n(patent_candidates(spark, sf), "cands", 3).select("doc_id", "pos", "name")


@register("first_assignee", """
SELECT doc_id, coalesce(list_filter(a, lambda s: s.name IS NOT NULL AND length(s.name) > 0)[1].name, 'Unknown') AS assignee
FROM (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN []::STRUCT(name VARCHAR)[]
                                     WHEN 1 THEN [{'name': NULL::VARCHAR}, {'name': ''}, {'name': source}]
                                     ELSE [{'name': source}] END AS a
      FROM documents)""")
def q_first_assignee(spark, sf):
    d = read_table(spark, sf, "documents")
    st = lambda c: F.struct(c.alias("name"))
    a = (F.when(F.col("doc_id") % 3 == 0, F.array().cast("array<struct<name:string>>"))
         .when(F.col("doc_id") % 3 == 1, F.array(st(F.lit(None).cast("string")), st(F.lit("")), st(F.col("source"))))
         .otherwise(F.array(st(F.col("source")))))
    return d.select("doc_id", T.first_assignee(a).alias("assignee"))


@register("format_ids", """
SELECT p_partkey, 'CID_' || CAST(p_partkey AS VARCHAR) AS cid, printf('PATENT_SAMPLE_%06d', p_partkey) AS patent_sample,
       printf('SAMPLE_DRUG_%06d', p_partkey) AS sample_drug, printf('DB_UNKNOWN_%06d', p_partkey) AS db_unknown,
       'AI_' || printf('US-%07d', p_partkey) || '_' || left(p_name, 8) AS ai_id
FROM part""")
def q_format_ids(spark, sf):
    p = read_table(spark, sf, "part")
    ids = P.format_ids(F.col("p_partkey"), F.format_string("US-%07d", F.col("p_partkey")), F.col("p_name"))
    return p.select("p_partkey", *[c.alias(k) for k, c in ids.items()])


def sdf_props(spark, sf):
    """part rows as SDF property records with gaps (absent = NULL)."""
    p = read_table(spark, sf, "part")
    sz = F.col("p_size")
    nul = F.lit(None).cast("string")
    return p.select(
        F.col("p_partkey").alias("mol_idx"),
        F.when(sz % 3 == 0, nul).otherwise(F.format_string("DB%05d", "p_partkey")).alias("DRUGBANK_ID"),
        F.when(sz % 2 == 0, F.format_string("DBX%05d", "p_partkey")).alias("DATABASE_ID"),
        F.when(sz % 4 == 0, F.col("p_name")).alias("GENERIC_NAME"),
        F.when(sz % 5 == 0, F.upper("p_name")).alias("COMMON_NAME"),
        nul.alias("DRUG_NAME"),
        F.when(sz % 7 == 0, F.concat("p_brand", F.lit("|"), "p_name", F.lit("\n"), "p_type"))
         .when(sz % 7 == 1, F.lit("")).alias("SYNONYMS"),
        F.when(sz % 6 == 1, F.concat(F.lit(" "), "p_type", F.lit(" |x"))).alias("SYSTEMATIC_NAME"),
        nul.alias("INTERNATIONAL_BRAND_NAME"),
        F.when(sz % 11 == 0, F.col("p_name")).alias("NAME"))


SDF_PROPS = """props AS (
  SELECT p_partkey AS mol_idx,
         CASE WHEN p_size % 3 = 0 THEN NULL ELSE printf('DB%05d', p_partkey) END AS DRUGBANK_ID,
         CASE WHEN p_size % 2 = 0 THEN printf('DBX%05d', p_partkey) END AS DATABASE_ID,
         CASE WHEN p_size % 4 = 0 THEN p_name END AS GENERIC_NAME,
         CASE WHEN p_size % 5 = 0 THEN upper(p_name) END AS COMMON_NAME,
         NULL::VARCHAR AS DRUG_NAME,
         CASE WHEN p_size % 7 = 0 THEN p_brand || '|' || p_name || chr(10) || p_type WHEN p_size % 7 = 1 THEN '' END AS SYNONYMS,
         CASE WHEN p_size % 6 = 1 THEN ' ' || p_type || ' |x' END AS SYSTEMATIC_NAME,
         NULL::VARCHAR AS INTERNATIONAL_BRAND_NAME,
         CASE WHEN p_size % 11 = 0 THEN p_name END AS NAME
  FROM part)"""


def _piece(e):
    first = f"split_part(split_part(coalesce({e}, ''), chr(10), 1), '|', 1)"
    return f"nullif({O.ptrim_sql(first)}, '')"


@register("identity_chain", O.with_ctes(SDF_PROPS) + f""",
ids AS (SELECT *, coalesce(DRUGBANK_ID, DATABASE_ID, printf('DB_UNKNOWN_%06d', mol_idx)) AS ident FROM props),
names AS (SELECT *, coalesce(GENERIC_NAME, COMMON_NAME, DRUG_NAME, ident) AS name0 FROM ids),
resolved AS (SELECT *, CASE WHEN name0 = ident
                            THEN coalesce({_piece('SYNONYMS')}, {_piece('SYSTEMATIC_NAME')}, {_piece('INTERNATIONAL_BRAND_NAME')}, NAME, ident)
                            ELSE name0 END AS nm FROM names)
SELECT mol_idx, ident AS compound_id,
       CASE WHEN nm IS NOT NULL AND nm <> '' AND nm <> ident THEN nm ELSE 'DrugBank Compound ' || ident END AS name
FROM resolved""")
def q_identity_chain(spark, sf):
    return P.resolve_identity(sdf_props(spark, sf)).select("mol_idx", "compound_id", "name")


def _strip_artifacts_sql(e):
    out = O.ptrim_sql(e)
    for pre in K.ARTIFACT_PREFIXES:
        out = O.ptrim_sql(f"replace({out}, {O._q(pre)}, '')")
    return out


@register("strip_artifacts", f"""
SELECT key, {_strip_artifacts_sql('raw')} AS cleaned
FROM (SELECT printf('%d:%d', conv_id, turn) AS key,
             CASE turn % 3 WHEN 0 THEN 'translate to SMILES: ' || text WHEN 1 THEN ' SMILES: ' || text ELSE text END AS raw
      FROM conversations WHERE role = 'assistant')""")
def q_strip_artifacts(spark, sf):
    a = A.answers(spark, sf)
    raw = (F.when(F.col("turn") % 3 == 0, F.concat(F.lit("translate to SMILES: "), "raw_text"))
           .when(F.col("turn") % 3 == 1, F.concat(F.lit(" SMILES: "), "raw_text"))
           .otherwise(F.col("raw_text")))
    return a.select("key", T.strip_artifacts(raw).alias("cleaned"))


# mentions: a part name per line item, in two spellings, and a name with no entry
_MENTION_SQL = ("CASE WHEN l_linenumber % 7 = 0 THEN p_name || ' salt' WHEN l_linenumber % 2 = 0 THEN upper(p_name) "
                "ELSE ' ' || p_name || chr(9) END")


@register("resolve_names", O.with_ctes(O.samples_cte(), O.COMPOUNDS) + f""",
dict AS (
  SELECT nkey AS name, smiles FROM (
    SELECT nkey, smiles, row_number() OVER (PARTITION BY nkey ORDER BY source_rank, ordinal) AS rn
    FROM (SELECT lower({O.ptrim_sql('name')}) AS nkey, smiles, source_rank, ordinal
          FROM compounds WHERE smiles IS NOT NULL AND length(smiles) > 0))
  WHERE rn = 1),
mentions AS (
  SELECT l_orderkey, l_linenumber, {_MENTION_SQL} AS name FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT m.l_orderkey, m.l_linenumber, m.name, d.smiles
FROM mentions m JOIN dict d ON lower({O.ptrim_sql('m.name')}) = d.name""")
def q_resolve_names(spark, sf):
    li = read_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    part = read_table(spark, sf, "part").select("p_partkey", "p_name")
    mention = (F.when(F.col("l_linenumber") % 7 == 0, F.concat("p_name", F.lit(" salt")))
               .when(F.col("l_linenumber") % 2 == 0, F.upper("p_name"))
               .otherwise(F.concat(F.lit(" "), "p_name", F.lit("\t"))))
    m = li.join(part, li.l_partkey == part.p_partkey).select("l_orderkey", "l_linenumber", mention.alias("name"))
    out = P.resolve_names(m, P.name_dictionary(A.compounds(spark, sf)))
    return out.select("l_orderkey", "l_linenumber", "name", "smiles")
