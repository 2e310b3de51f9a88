"""Queries: sinks and sources round-trips, sample cycling, multi-source
collection and the streaming seen-set (A1-A5, A7-A10, J1).

Each query lands its input files from the driver's tables (written by
Spark into a fresh folder under the shared checkpoint folder) and reads
them back through the source under test.
"""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from retort import constants as K
from retort.operators import clean as C
from retort.operators import lookup as L
from retort.operators import patents as P
from retort.operators import tags as G
from retort.plans import adapters as A
from retort.plans import oracle as O
from retort.plans.catalog import register
from retort.plans.oracle import BASE
from retort.plans.q_patents import SDF_PROPS, _piece, sdf_props
from retort.session import read_table, scratch_path
from retort.sources import collect as SC
from retort.sources import files as SF
from retort.sources.csv_ranges import read_csv
from retort.streaming.collect import collect_recent, collect_stream

BROKEN_SIZE = 46   # records landed without their end marker
NO_STRUCT_SIZE = 47


@register("csv_roundtrip", BASE + """
SELECT smiles, array_to_string(applications, '|') AS tags, true AS parse_ok FROM cleaned""")
def q_csv_roundtrip(spark, sf):
    root = scratch_path(spark, "csv")
    good, bad = os.path.join(root, "good"), os.path.join(root, "bad")
    SF.write_compounds(C.clean_compounds(A.compounds(spark, sf)).select("smiles", "applications", "source"),
                       good, "csv")
    SF.write_compounds(read_table(spark, sf, "part").select("p_partkey", "p_name"), bad, "csv")
    df = SF.read_compound_csvs(spark, [good, bad, os.path.join(root, "missing")])
    return df.select("smiles", F.array_join("applications", "|").alias("tags"), "parse_ok")


#: Bytes of a range of the CSV written here: a scan task's file has some, so values cross their ends.
CSV_RANGE = 16 << 20


@register("csv_line_breaks", """
SELECT doc_id, md5(text) AS text_md5, source, len(string_split(text, chr(10))) AS n_lines FROM documents""")
def q_csv_line_breaks(spark, sf):
    """Texts of many lines as quoted values of CSV files, one a scan task, read back in several byte ranges each."""
    path = os.path.join(scratch_path(spark, "csv"), "texts")
    docs = read_table(spark, sf, "documents").select("doc_id", "text", "source")
    docs.write.option("header", True).option("escape", '"').csv(path)
    df = read_csv(spark, path, range_bytes=CSV_RANGE)
    return df.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.md5(F.col("text").cast("binary")).alias("text_md5"), "source",
                     F.size(F.split("text", "\n")).cast("bigint").alias("n_lines"))


def _sdf_text(spark, sf):
    props = sdf_props(spark, sf)
    comp = A.compounds(spark, sf).select(F.col("row_id").alias("mol_idx"), F.col("smiles").alias("SMILES"))
    part = read_table(spark, sf, "part").select(F.col("p_partkey").alias("mol_idx"), "p_size", "p_name")
    df = props.join(comp, "mol_idx").join(part, "mol_idx")
    fields = [f for f in SF.SDF_FIELDS if f in df.columns]
    blocks = [F.when(F.col(f).isNotNull(), F.concat(F.lit(f"> <{f}>\n"), F.col(f), F.lit("\n\n"))).otherwise(F.lit(""))
              for f in fields]
    end = F.when(F.col("p_size") == BROKEN_SIZE, F.lit("")).otherwise(F.lit("M  END\n"))
    header = F.concat(F.col("p_name"), F.lit("\n  retort\n\n  0  0  0  0  0  0  0  0  0  0999 V2000\n"), end)
    return df.select("mol_idx", F.concat(header, *blocks, F.lit("$$$$")).alias("value"))


@register("sdf_props", O.with_ctes(SDF_PROPS).rstrip() + ",\n" + O.samples_cte() + ",\n" + O.COMPOUNDS + f""",
ids AS (SELECT *, coalesce(DRUGBANK_ID, DATABASE_ID, printf('DB_UNKNOWN_%06d', mol_idx)) AS ident FROM props),
names AS (SELECT *, coalesce(GENERIC_NAME, COMMON_NAME, DRUG_NAME, ident) AS name0 FROM ids),
resolved AS (SELECT *, CASE WHEN name0 = ident
                            THEN coalesce({_piece('SYNONYMS')}, {_piece('SYSTEMATIC_NAME')}, {_piece('INTERNATIONAL_BRAND_NAME')}, NAME, ident)
                            ELSE name0 END AS nm FROM names)
SELECT r.mol_idx, r.ident AS compound_id,
       CASE WHEN nm IS NOT NULL AND nm <> '' AND nm <> ident THEN nm ELSE 'DrugBank Compound ' || ident END AS name,
       coalesce(c.smiles, '') AS smiles
FROM resolved r JOIN compounds c ON c.row_id = r.mol_idx JOIN part p ON p.p_partkey = r.mol_idx
WHERE p.p_size <> {BROKEN_SIZE}""")
def q_sdf_props(spark, sf):
    path = scratch_path(spark, "sdf")
    _sdf_text(spark, sf).orderBy("mol_idx").select("value").write.text(path)
    recs = SF.sdf_columns(SF.read_sdf(spark, path))
    out = P.resolve_identity(recs)
    return out.select("mol_idx", "compound_id", "name", F.coalesce("SMILES", F.lit("")).alias("smiles"))


def _land_molecule_pages(spark, sf, path, which=None):
    df = A.compounds(spark, sf)
    struct = F.when(F.col("_size") == NO_STRUCT_SIZE, F.lit(None).cast("struct<canonical_smiles:string>")) \
        .otherwise(F.struct(F.col("smiles").alias("canonical_smiles")))
    part = read_table(spark, sf, "part").select(F.col("p_partkey").alias("row_id"), F.col("p_size").alias("_size"))
    m = df.join(part, "row_id").select(
        (F.col("row_id") / 100).cast("bigint").alias("page"), "row_id",
        F.struct(struct.alias("molecule_structures"),
                 F.format_string("CHEMBL%d", F.col("row_id")).alias("molecule_chembl_id"),
                 F.when(F.col("_size") != 45, F.col("name")).alias("pref_name")).alias("m"))
    if which is not None:
        m = m.where(F.col("page") % 2 == which)
    # a page holds at most 100 molecules: a bounded group
    pages = m.groupBy("page").agg(F.array_sort(F.collect_list(F.struct("row_id", "m"))).alias("_ms"))
    pages = pages.select("page", F.transform("_ms", lambda s: s["m"]).alias("molecules"))
    pages.write.mode("append").json(path)


@register("json_pages_explode", BASE + f"""
SELECT 'CHEMBL' || CAST(c.row_id AS VARCHAR) AS compound_id, c.smiles,
       CASE WHEN p.p_size <> 45 THEN c.name ELSE 'CHEMBL' || CAST(c.row_id AS VARCHAR) END AS name
FROM compounds c JOIN part p ON p.p_partkey = c.row_id
WHERE p.p_size <> {NO_STRUCT_SIZE} AND c.smiles IS NOT NULL AND length(c.smiles) > 0""")
def q_json_pages_explode(spark, sf):
    path = scratch_path(spark, "pages")
    _land_molecule_pages(spark, sf, path)
    m = SF.read_molecule_pages(spark, path)
    return C.drop_missing(m, ["smiles"]).select("compound_id", "smiles", "name")


PROP_TARGET = 4000


def _land_property_pages(spark, sf, path):
    df = A.compounds(spark, sf)
    part = read_table(spark, sf, "part").select(F.col("p_partkey").alias("row_id"), "p_size")
    p = df.join(part, "row_id").select(
        F.col("source").alias("term"), (F.col("row_id") / 100).cast("bigint").alias("page"), "row_id",
        F.struct(F.col("row_id").alias("CID"), F.col("smiles").alias("CanonicalSMILES"),
                 F.when(F.col("p_size") % 9 != 0, F.col("name")).alias("Title")).alias("prop"))
    pages = p.groupBy("term", "page").agg(F.array_sort(F.collect_list(F.struct("row_id", "prop"))).alias("_ps"))
    pages.select("term", F.struct(F.transform("_ps", lambda s: s["prop"]).alias("Properties")).alias("PropertyTable")) \
        .write.json(path)


@register("property_pages", BASE + f""",
props AS (
  SELECT c.source AS term, c.row_id AS cid, c.smiles,
         CASE WHEN p.p_size % 9 <> 0 THEN c.name ELSE 'PubChem CID ' || CAST(c.row_id AS VARCHAR) END AS name
  FROM compounds c JOIN part p ON p.p_partkey = c.row_id
  WHERE c.smiles IS NOT NULL AND length(c.smiles) > 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY term ORDER BY cid) AS rn FROM props)
SELECT term, cid, smiles, name FROM ranked
WHERE rn <= greatest(5, {PROP_TARGET} // (SELECT count(DISTINCT term) FROM props) + 5)
ORDER BY term, rn LIMIT {PROP_TARGET}""")
def q_property_pages(spark, sf):
    path = scratch_path(spark, "props")
    _land_property_pages(spark, sf, path)
    props = C.drop_missing(SF.read_property_pages(spark, path), ["smiles"])
    n_terms = props.agg(F.count_distinct("term")).first()[0]
    capped = L.cap(props, "term", ["cid"], L.per_key_cap(n_terms, PROP_TARGET), PROP_TARGET)
    return capped.select("term", "cid", "smiles", "name")


@register("identifier_pages", BASE + """
SELECT source AS term, min(row_id) AS reference_cid FROM compounds GROUP BY source""")
def q_identifier_pages(spark, sf):
    path = scratch_path(spark, "ids")
    df = A.compounds(spark, sf)
    pages = df.groupBy(F.col("source").alias("term"), (F.col("row_id") / 100).cast("bigint").alias("page")) \
        .agg(F.array_sort(F.collect_list("row_id")).alias("cids"))
    pages.select("term", "page", F.struct(F.col("cids").alias("CID"), F.lit(None).cast("string").alias("ListKey"))
                 .alias("IdentifierList")).write.json(path)
    ids = SF.read_identifier_pages(spark, path)
    # first CID of the term's first page
    return ids.groupBy("term").agg(F.min("reference_cid").alias("reference_cid"))


@register("sample_cycle_dedupe", O.with_ctes(
    O.samples_cte(), O.COMPOUNDS,
    "pharma AS (SELECT * FROM samples WHERE sample_idx >= 8)",
    "seen AS (SELECT DISTINCT smiles FROM compounds WHERE source = 'PROMO' AND smiles IS NOT NULL)",
    f"cyc AS (SELECT i, CAST(i % {len(K.PHARMA_SAMPLES)} AS INTEGER) + 8 AS sample_idx "
    f"FROM range((SELECT count(*) FROM part)) t(i))") + f"""
SELECT sample_smiles AS smiles, array_to_string(arg_min(sample_apps, i), '|') AS applications,
       '{K.PHARMA_SOURCE}' AS source, printf('SAMPLE_DRUG_%06d', min(i)) AS compound_id, arg_min(sample_name, i) AS name
FROM cyc JOIN pharma USING (sample_idx)
WHERE sample_smiles NOT IN (SELECT smiles FROM seen)
GROUP BY sample_smiles""")
def q_sample_cycle_dedupe(spark, sf):
    n = read_table(spark, sf, "part").count()
    seen = A.compounds(spark, sf).where((F.col("source") == "PROMO") & F.col("smiles").isNotNull())
    out = SC.sample_compounds(spark, "pharma", n, seen)
    return out.select("smiles", F.array_join("applications", "|").alias("applications"), "source",
                      "compound_id", "name")


COLLECT_PLAN = [("promo", "PROMO", 100), ("broken", None, None), ("standard", "STANDARD", 50), ("small", "SMALL", None),
                ("medium", "MEDIUM", None), ("large", "LARGE", 200), ("economy", "ECONOMY", None)]


@register("collect_union", BASE + """,
plan(rank, pname, src, cap) AS (VALUES (0, 'promo', 'PROMO', 100), (2, 'standard', 'STANDARD', 50), (3, 'small', 'SMALL', 1000000000),
  (4, 'medium', 'MEDIUM', 1000000000), (5, 'large', 'LARGE', 200), (6, 'economy', 'ECONOMY', 1000000000)),
ranked AS (SELECT c.*, row_number() OVER (PARTITION BY c.source ORDER BY ordinal) AS rn FROM compounds c)
SELECT pname AS plan_source, CAST(rank AS INTEGER) AS source_rank, count(*) AS n, min(ordinal) AS min_ordinal, max(ordinal) AS max_ordinal
FROM ranked JOIN plan ON ranked.source = plan.src WHERE rn <= cap GROUP BY pname, rank""")
def q_collect_union(spark, sf):
    comp = A.compounds(spark, sf)

    def build(src):
        if src is None:
            return lambda: spark.read.parquet(os.path.join(sf, "no_such_table.parquet"))
        return lambda: comp.where(F.col("source") == src)

    plan = [(name, build(src), cap) for name, src, cap in COLLECT_PLAN]
    u = SC.collect_sources(plan)
    return u.groupBy("plan_source", "source_rank").agg(
        F.count(F.lit(1)).alias("n"), F.min("ordinal").alias("min_ordinal"), F.max("ordinal").alias("max_ordinal"))


@register("landed_responses", f"""
WITH a AS (SELECT text AS raw_text, CASE WHEN turn % 5 = 0 THEN 'error' ELSE 'ok' END AS landed
           FROM conversations WHERE role = 'assistant')
SELECT status, count(*) AS n
FROM (SELECT CASE WHEN landed = 'error' THEN 'error' ELSE {O.answer_status_sql('raw_text')} END AS status FROM a)
GROUP BY status""")
def q_landed_responses(spark, sf):
    path = scratch_path(spark, "responses")
    a = A.answers(spark, sf).select("key", "raw_text",
                                    F.when(F.col("turn") % 5 == 0, F.lit("error")).otherwise(F.lit("ok")).alias("status"))
    a.write.parquet(path)
    r = SF.read_responses(spark, path)
    st = G.answer_status("raw_text", "status")
    return r.groupBy(st.alias("status")).agg(F.count(F.lit(1)).alias("n"))


@register("stream_dedupe", BASE.rstrip() + f""",
v AS ({O.smiles_view(f"(SELECT c.smiles FROM compounds c JOIN part p ON p.p_partkey = c.row_id WHERE p.p_size <> {NO_STRUCT_SIZE} AND c.smiles IS NOT NULL AND length(c.smiles) > 0)")})
SELECT DISTINCT smiles FROM v WHERE valid""")
def q_stream_dedupe(spark, sf):
    root = scratch_path(spark, "stream")
    landing, sink, ckpt = (os.path.join(root, x) for x in ("landing", "sink", "checkpoint"))
    # two landing rounds, two incremental runs on one checkpoint
    _land_molecule_pages(spark, sf, landing, which=0)
    collect_stream(spark, landing, sink, ckpt)
    _land_molecule_pages(spark, sf, landing, which=1)
    collect_stream(spark, landing, sink, ckpt)
    return spark.read.parquet(sink).select("smiles")


_LATE = "row_id % 4 = 3 AND row_id % 5 = 0"


@register("stream_watermark", BASE.rstrip() + f""",
v AS ({O.smiles_view("(SELECT row_id, smiles FROM present)")})
SELECT 'kept' AS side, smiles, 1 AS n FROM v WHERE valid AND NOT ({_LATE}) GROUP BY smiles
UNION ALL
SELECT 'late', smiles, count(*) FROM v WHERE valid AND {_LATE} GROUP BY smiles""")
def q_stream_watermark(spark, sf):
    """Four landings an hour apart, the last with rows that are ten days late; a delay of twelve hours."""
    root = scratch_path(spark, "stream")
    landing, sink, late, ckpt = (os.path.join(root, x) for x in ("landing", "sink", "late", "checkpoint"))
    df = C.drop_missing(A.compounds(spark, sf), ["smiles"])
    hours = F.when(F.expr(_LATE), -240).otherwise(F.col("row_id") % 4)
    rows = df.select("row_id", (F.lit(1735689600) + hours * 3600).cast("timestamp").alias("landed"), (F.col("row_id") / 100).cast("bigint").alias("page"), F.struct(
        F.struct(F.col("smiles").alias("canonical_smiles")).alias("molecule_structures"), F.col("compound_id").alias("molecule_chembl_id"), F.col("name").alias("pref_name")).alias("m"))
    for turn in range(4):
        # a page holds at most 100 molecules: a bounded group
        pages = rows.where(F.col("row_id") % 4 == turn).groupBy("page", "landed").agg(F.collect_list("m").alias("molecules"))
        pages.write.mode("append").json(landing)
        collect_recent(spark, landing, sink, late, ckpt, delay="12 hours")
    count = lambda path, side: spark.read.parquet(path).groupBy("smiles").agg(F.count(F.lit(1)).cast("int").alias("n")).select(F.lit(side).alias("side"), "smiles", "n")
    return count(sink, "kept").unionByName(count(late, "late"))
