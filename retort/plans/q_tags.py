"""Queries: categories, rule tags, answer parsing and gates, SMILES checks
(B3, B5, C1-C3, C5, D4, D12 heavy atoms, G7-G12, G14, G17)."""

from __future__ import annotations

from pyspark.sql import functions as F

from retort import constants as K
from retort.functions import text as T
from retort.functions.smiles import valid_smiles
from retort.operators import clean as C
from retort.operators import tags as G
from retort.operators.seen import SeenSet
from retort.plans import adapters as A
from retort.plans import oracle as O
from retort.plans.catalog import register
from retort.plans.oracle import BASE, clean_tags_sql
from retort.session import read_table, scratch_path, spread
from retort.sources import collect as SC

HINT = "array_to_string(applications, ' ')"


def _cleaned(spark, sf):
    return C.clean_compounds(A.compounds(spark, sf))


@register("hint_category", BASE + f"""
SELECT row_id, {O.hint_category_sql(HINT)} AS category FROM compounds""")
def q_hint_category(spark, sf):
    df = A.compounds(spark, sf)
    return df.select("row_id", G.hint_category(F.array_join("applications", " ")).alias("category"))


@register("name_categories", BASE + f"""
SELECT row_id, array_to_string({O.name_categories_sql(HINT)}, '|') AS categories FROM compounds""")
def q_name_categories(spark, sf):
    df = spread(A.compounds(spark, sf).select("row_id", "applications"))
    return df.select("row_id", F.array_join(G.name_categories(F.array_join("applications", " ")), "|")
                     .alias("categories"))


def _keyword_table(spark):
    """The keyword mapping as the table form takes it."""
    rows = [(i, cat, w) for i, (cat, words) in enumerate(K.APPLICATION_MAPPING) for w in words]
    return spark.createDataFrame(rows, "cat_rank INT, category STRING, keyword STRING")


def _table_categories(spark, sf):
    df = A.compounds(spark, sf).select("row_id", F.array_join("applications", " ").alias("hint"))
    return G.categories_by_join(df, "row_id", "hint", _keyword_table(spark))


@register("hint_category_table", BASE + f"""
SELECT row_id, {O.hint_category_sql(HINT)} AS category FROM compounds""")
def q_hint_category_table(spark, sf):
    return _table_categories(spark, sf).select("row_id", F.col("first_category").alias("category"))


@register("name_categories_table", BASE + f"""
SELECT row_id, array_to_string({O.name_categories_sql(HINT)}, '|') AS categories FROM compounds""")
def q_name_categories_table(spark, sf):
    return _table_categories(spark, sf).select("row_id", F.array_join("categories", "|").alias("categories"))


@register("smiles_valid", BASE + f"""
SELECT smiles, valid FROM ({O.smiles_view("(SELECT DISTINCT smiles FROM present)")})""")
def q_smiles_valid(spark, sf):
    df = C.drop_missing(A.compounds(spark, sf), ["smiles"]).select("smiles").distinct()
    return df.select("smiles", valid_smiles("smiles").alias("valid"))


@register("heavy_atoms", BASE + f"""
SELECT smiles, CAST(heavy AS BIGINT) AS heavy FROM ({O.smiles_view("cleaned")})""")
def q_heavy_atoms(spark, sf):
    df = _cleaned(spark, sf)
    return df.select("smiles", G.heavy_atoms("smiles").cast("bigint").alias("heavy"))


STAGE_COUNTS = BASE + f""",
per_key AS (SELECT smiles, count(*) AS c FROM compounds GROUP BY smiles),
checked AS ({O.smiles_view("per_key")})
SELECT CAST(sum(c) AS BIGINT) AS raw,
       CAST(coalesce(sum(c) FILTER (WHERE smiles IS NOT NULL AND length(smiles) > 0), 0) AS BIGINT) AS non_null,
       count(*) FILTER (WHERE smiles IS NOT NULL AND length(smiles) > 0) AS deduped,
       count(*) FILTER (WHERE smiles IS NOT NULL AND length(smiles) > 0 AND NOT valid) AS invalid,
       count(*) FILTER (WHERE smiles IS NOT NULL AND length(smiles) > 0)
         - count(*) FILTER (WHERE smiles IS NOT NULL AND length(smiles) > 0 AND NOT valid) AS final
FROM checked"""


@register("stage_counts", STAGE_COUNTS)
def q_stage_counts(spark, sf):
    return C.profile_stages(A.compounds(spark, sf))


@register("stage_counts_written", f"""
SELECT c.*, c.final AS written FROM ({STAGE_COUNTS}) c""")
def q_stage_counts_written(spark, sf):
    """The counters as they come with the write of the clean table, beside the rows that it holds."""
    path = scratch_path(spark, "clean")
    counts = C.write_profiled(A.compounds(spark, sf), path)
    return counts.withColumn("written", F.lit(spark.read.parquet(path).count()).cast("bigint"))


@register("rule_tags", BASE + f"""
SELECT row_id, array_to_string({O.rule_tags_sql('smiles', 'valid', 'heavy', 'name', O._q(K.CHEMBL_HINT))}, '|') AS tags
FROM ({O.smiles_view("cleaned")})""")
def q_rule_tags(spark, sf):
    df = _cleaned(spark, sf)
    tags = G.rule_tags("smiles", name="name", hint=F.lit(K.CHEMBL_HINT))
    return df.select("row_id", F.array_join(tags, "|").alias("tags"))


@register("rule_tags_error", BASE + f"""
SELECT row_id, array_to_string({O.rule_tags_sql('smiles', 'valid', 'heavy', None, 'source', 'gemini_api_error')}, '|') AS tags
FROM ({O.smiles_view("cleaned")})""")
def q_rule_tags_error(spark, sf):
    df = _cleaned(spark, sf)
    tags = G.rule_tags("smiles", hint="source", error_context="gemini_api_error")
    return df.select("row_id", F.array_join(tags, "|").alias("tags"))


# ---------------------------------------------------------------- answers
ANSWERS = """answers AS (
  SELECT printf('%d:%d', conv_id, turn) AS key, conv_id, turn, text AS raw_text
  FROM conversations WHERE role = 'assistant'),
first_answers AS (
  SELECT conv_id, arg_min(raw_text, turn) AS raw_text FROM answers GROUP BY conv_id)"""


def _first_answers(spark, sf):
    a = A.answers(spark, sf)
    return a.groupBy("conv_id").agg(F.min(F.struct("turn", "raw_text"))["raw_text"].alias("raw_text"))


@register("parse_answer", O.with_ctes(ANSWERS) + f"""
SELECT key, array_to_string({O.parse_answer_sql('raw_text')}, '|') AS tags FROM answers""")
def q_parse_answer(spark, sf):
    a = A.answers(spark, sf)
    return a.select("key", F.array_join(T.parse_answer("raw_text"), "|").alias("tags"))


@register("parse_tags_csv", O.with_ctes(ANSWERS) + f"""
SELECT key, array_to_string({O.parse_tags_csv_sql('raw_text')}, '|') AS tags FROM answers""")
def q_parse_tags_csv(spark, sf):
    a = A.answers(spark, sf)
    return a.select("key", F.array_join(T.parse_tags_csv("raw_text"), "|").alias("tags"))


@register("gate_tags", O.with_ctes(ANSWERS) + f""",
st AS (SELECT key, raw_text, {O.answer_status_sql('raw_text')} AS status,
              {O.parse_answer_sql('raw_text')} AS answer,
              regexp_extract(raw_text, '^[A-Za-z]+', 0) AS hint FROM answers)
SELECT key, status,
       array_to_string({O.gate_sql('answer', 'status', 'chembl')}, '|') AS chembl,
       array_to_string({O.gate_sql('answer', 'status', 'drugbank')}, '|') AS drugbank,
       array_to_string({O.gate_sql('answer', 'status', 'pubchem', 'hint')}, '|') AS pubchem
FROM st""")
def q_gate_tags(spark, sf):
    a = A.answers(spark, sf).select(
        "key", G.answer_status("raw_text").alias("status"), T.parse_answer("raw_text").alias("answer"),
        F.regexp_extract("raw_text", "^[A-Za-z]+", 0).alias("hint"))
    return a.select(
        "key", "status",
        F.array_join(G.gate_tags("answer", "status", "chembl"), "|").alias("chembl"),
        F.array_join(G.gate_tags("answer", "status", "drugbank"), "|").alias("drugbank"),
        F.array_join(G.gate_tags("answer", "status", "pubchem", hint="hint"), "|").alias("pubchem"))


@register("annotate", BASE.rstrip() + ",\n" + ANSWERS + f""",
joined AS ({O.smiles_view("(SELECT c.*, a.raw_text FROM cleaned c LEFT JOIN first_answers a ON c.row_id = a.conv_id)")}),
st AS (SELECT *, {O.answer_status_sql('raw_text')} AS status,
              CASE WHEN raw_text IS NULL
                   THEN {O.rule_tags_sql('smiles', 'valid', 'heavy', 'name', O._q(K.CHEMBL_HINT))}
                   ELSE {O.parse_answer_sql('raw_text')} END AS answer FROM joined)
SELECT row_id, status,
       array_to_string({O.gate_sql('answer', "(CASE WHEN status = 'missing' THEN 'ok' ELSE status END)", 'chembl')}, '|') AS tags
FROM st""")
def q_annotate(spark, sf):
    out = G.annotate(_cleaned(spark, sf), _first_answers(spark, sf), answer_key="conv_id")
    return out.select("row_id", "status", F.array_join("tags", "|").alias("tags"))


@register("compound_dataset", BASE.rstrip() + ",\n" + ANSWERS + f""",
landed AS (SELECT conv_id, arg_min(raw_text, turn) AS raw_text, arg_min(CASE WHEN turn % 5 = 0 THEN 'error' ELSE 'ok' END, turn) AS landed
           FROM answers GROUP BY conv_id),
joined AS ({O.smiles_view("(SELECT c.*, a.raw_text, a.landed FROM cleaned c LEFT JOIN landed a ON c.row_id = a.conv_id)")}),
st AS (SELECT *, CASE WHEN landed = 'error' THEN 'error' ELSE {O.answer_status_sql('raw_text')} END AS status,
              CASE WHEN raw_text IS NULL
                   THEN {O.rule_tags_sql('smiles', 'valid', 'heavy', 'name', O._q(K.CHEMBL_HINT))}
                   ELSE {O.parse_answer_sql('raw_text')} END AS answer FROM joined WHERE valid)
SELECT smiles, compound_id, name, source, status,
       array_to_string({clean_tags_sql(O.gate_sql('answer', "(CASE WHEN status = 'missing' THEN 'ok' ELSE status END)", 'chembl'))}, '|') AS applications
FROM st""")
def q_compound_dataset(spark, sf):
    """The collection job end to end: sources in plan order, falsy and invalid SMILES out, each SMILES once,
    landed answers with their status, rule tags where none landed, gate, clean tags."""
    comp = A.compounds(spark, sf)
    plan = [(src, lambda s=src: comp.where(F.col("source") == s), None) for src in A.SOURCE_ORDER]
    rows = SC.collect_sources(plan).drop("plan_source")
    rows = C.dedupe_first(C.drop_missing(rows, ["smiles"]))
    rows = rows.where(valid_smiles("smiles"))
    landed = A.answers(spark, sf).withColumn("landed", F.when(F.col("turn") % 5 == 0, "error").otherwise("ok"))
    landed = landed.groupBy("conv_id").agg(F.min(F.struct("turn", "raw_text", "landed")).alias("a")).select("conv_id", "a.raw_text", "a.landed")
    out = G.annotate(rows, landed, answer_key="conv_id", landed_status="landed")
    return out.select("smiles", "compound_id", "name", "source", "status", F.array_join(T.clean_tags("tags"), "|").alias("applications"))


def json_answers(spark, sf):
    """Landed free-text answers built from part rows: JSON arrays (with
    non-string items), comma lists, broken JSON and plain text."""
    p = read_table(spark, sf, "part")
    m = F.col("p_size") % 5
    raw = (F.when(m == 0, F.concat(F.lit('Here: ["'), F.col("p_type"), F.lit('", " '), F.col("p_name"),
                                   F.lit(' ", '), F.col("p_size").cast("string"), F.lit("]")))
           .when(m == 1, F.concat_ws(", ", F.col("p_name"), F.col("p_type"), F.col("p_brand")))
           .when(m == 2, F.concat(F.lit('["broken '), F.col("p_name")))
           .when(m == 3, F.concat(F.lit("["), F.col("p_size").cast("string"), F.lit(', "'),
                                  F.upper(F.col("p_type")), F.lit(" "), F.col("p_name"), F.lit('", "ab"] tail')))
           .otherwise(F.col("p_name")))
    return p.select(F.col("p_partkey").alias("key"), raw.alias("raw_text"))


JSON_ANSWERS = """json_answers AS (
  SELECT p_partkey AS key,
         CASE p_size % 5
           WHEN 0 THEN 'Here: ["' || p_type || '", " ' || p_name || ' ", ' || CAST(p_size AS VARCHAR) || ']'
           WHEN 1 THEN concat_ws(', ', p_name, p_type, p_brand)
           WHEN 2 THEN '["broken ' || p_name
           WHEN 3 THEN '[' || CAST(p_size AS VARCHAR) || ', "' || upper(p_type) || ' ' || p_name || '", "ab"] tail'
           ELSE p_name END AS raw_text
  FROM part)"""


@register("parse_tags_json", O.with_ctes(JSON_ANSWERS) + f"""
SELECT key, array_to_string({O.parse_tags_json_sql('raw_text')}, '|') AS tags FROM json_answers""")
def q_parse_tags_json(spark, sf):
    a = json_answers(spark, sf)
    return a.select("key", F.array_join(T.parse_tags_json("raw_text"), "|").alias("tags"))


# vocabulary of the generated prose for the keyword rules
TEXT_RULES = [
    ("english_text", ["the ", " and ", " of "]),
    ("german_text", ["der ", " und ", " die "]),
    ("french_text", ["les ", " des ", " et "]),
    ("spanish_text", ["los ", " las ", " por "]),
]


@register("keyword_flags", f"""
SELECT doc_id, array_to_string(CASE WHEN len(f) > 0 THEN f ELSE ['{K.PATENT_DEFAULT_TAG}'] END, '|') AS tags
FROM (SELECT doc_id, list_filter([{", ".join(f"CASE WHEN {O._contains_any_sql('lower(text)', ws)} THEN {O._q(t)} END" for t, ws in TEXT_RULES)}],
                                 lambda x: x IS NOT NULL) AS f
      FROM documents)""")
def q_keyword_flags(spark, sf):
    d = spread(read_table(spark, sf, "documents").select("doc_id", "text"))
    return d.select("doc_id", F.array_join(T.keyword_flags("text", rules=TEXT_RULES), "|").alias("tags"))


@register("exclude_seen", BASE + """
SELECT row_id, smiles FROM present
WHERE source <> 'PROMO' AND smiles NOT IN (SELECT smiles FROM present WHERE source = 'PROMO')
QUALIFY row_number() OVER (PARTITION BY smiles ORDER BY source_rank, ordinal) = 1""")
def q_exclude_seen(spark, sf):
    df = C.drop_missing(A.compounds(spark, sf), ["smiles"])
    seen = df.where(F.col("source") == "PROMO")
    later = df.where(F.col("source") != "PROMO")
    return G.exclude_seen(later, seen, order=("source_rank", "ordinal")).select("row_id", "smiles")


@register("seen_across_runs", BASE + """
SELECT 1 AS run, row_id, smiles FROM present WHERE source = 'PROMO'
QUALIFY row_number() OVER (PARTITION BY smiles ORDER BY source_rank, ordinal) = 1
UNION ALL
SELECT 2, row_id, smiles FROM present WHERE smiles NOT IN (SELECT smiles FROM present WHERE source = 'PROMO')
QUALIFY row_number() OVER (PARTITION BY smiles ORDER BY source_rank, ordinal) = 1""")
def q_seen_across_runs(spark, sf):
    """Three collections over one seen-set: a source, then everything, then everything again (nothing is new)."""
    df = C.drop_missing(A.compounds(spark, sf), ["smiles"])
    path = scratch_path(spark, "seen")
    seen = SeenSet(spark, path, path.rsplit("/", 1)[1].replace("-", "_"), buckets=16)
    runs = [seen.admit(rows, order=("source_rank", "ordinal")).select(F.lit(i + 1).alias("run"), "row_id", "smiles")
            for i, rows in enumerate((df.where(F.col("source") == "PROMO"), df, df))]
    spark.sql(f"DROP TABLE {seen.name}")  # its files stay
    return runs[0].unionByName(runs[1]).unionByName(runs[2])


@register("strip_paren", """
SELECT p_partkey AS term_id, term, coalesce(nullif(regexp_replace(regexp_replace(term, '\\s*\\([^)]*\\)\\s*$', ''), '^\\s+|\\s+$', '', 'g'), ''), term) AS cleaned
FROM (SELECT p_partkey, CASE WHEN p_size = 1 THEN '(' || p_brand || ')'
                             WHEN p_size % 2 = 0 THEN p_name || ' (' || p_brand || ')'
                             ELSE p_name END AS term FROM part)""")
def q_strip_paren(spark, sf):
    p = read_table(spark, sf, "part")
    term = (F.when(F.col("p_size") == 1, F.concat(F.lit("("), "p_brand", F.lit(")")))
            .when(F.col("p_size") % 2 == 0, F.concat("p_name", F.lit(" ("), "p_brand", F.lit(")")))
            .otherwise(F.col("p_name")))
    t = p.select(F.col("p_partkey").alias("term_id"), term.alias("term"))
    return t.select("term_id", "term", T.strip_paren("term").alias("cleaned"))


@register("url_term", """
SELECT p_partkey AS term_id, replace(url_encode(concat_ws(' ', p_name, p_brand, p_type)), '%2F', '/') AS url_term
FROM part""")
def q_url_term(spark, sf):
    p = read_table(spark, sf, "part")
    term = F.concat_ws(" ", "p_name", "p_brand", "p_type")
    return p.select(F.col("p_partkey").alias("term_id"), T.url_term(term).alias("url_term"))


@register("prompt_column", f"""
SELECT doc_id,
       concat_ws(' ', 'Chemical Name: ' || name, 'Patent Title: ' || title,
                 CASE WHEN text IS NOT NULL THEN 'Context: ' || left(text, {K.PROMPT_CONTEXT_CHARS}) || '...' END) AS prompt
FROM (SELECT doc_id, source AS name, split_part(text, chr(10), 1) AS title, text FROM documents)""")
def q_prompt_column(spark, sf):
    d = read_table(spark, sf, "documents")
    title = F.substring_index("text", "\n", 1)
    return d.select("doc_id", T.prompt([("Chemical Name: ", F.col("source")), ("Patent Title: ", title)],
                                       context=F.col("text")).alias("prompt"))
