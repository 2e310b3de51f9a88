"""File sources and sinks: compound CSVs, SDF, landed JSON pages, landed
answers (A1-A5, A8, A10).

JSON, SDF and answer readers declare their schema up front; CSV takes column
names from each path's header. All read in splittable ranges, CSV records that
span lines too; nothing is parsed on the driver.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retort.functions.text import list_literal, parse_list, ptrim
from retort.sources.csv_ranges import read_csv

log = logging.getLogger("retort.sources")

COMPOUND_COLUMNS = ["smiles", "applications"]


# ------------------------------------------------------------------ A8 sink
def write_compounds(df: DataFrame, path: str, fmt: str = "parquet") -> bool:
    """Write a dataset (no index column); skip when empty; report an
    error instead of raising. CSV cannot hold arrays, so list columns are
    written as Python list literals (what the CSV readers expect)."""
    try:
        if df.limit(1).count() == 0:
            log.warning("no data to save: dataset is empty")
            return False
        if fmt == "csv":
            out = df
            for name, dtype in df.dtypes:
                if dtype.startswith("array"):
                    out = out.withColumn(name, list_literal(F.col(name)))
            out.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
        else:
            df.write.mode("overwrite").format(fmt).save(path)
        return True
    except Exception as e:  # reported, not raised
        log.error("error saving dataset to %s: %s", path, e)
        return False


# ------------------------------------------------------------------ A1
def read_compound_csvs(spark: SparkSession, paths, multi_line: bool = True, ranges: bool = True) -> DataFrame:
    """A1: read each CSV alone; a path that cannot be read or lacks
    ``smiles``/``applications`` is skipped with a warning; the rest are
    concatenated (required columns only). Nothing valid -> typed empty
    frame. ``applications`` is parsed from its list literal; rows whose
    literal does not parse get ``applications`` NULL and ``parse_ok``
    false (quarantine) instead of failing the job. Quoted line breaks in any
    column are read, in many tasks a file (``csv_ranges``). ``ranges`` false
    leaves that to Spark's reader, one task a file; ``multi_line`` false
    too splits files at any line break, which is right only where no value
    holds one (the sink escapes those of list columns, and keeps those of
    strings)."""
    frames = []
    for p in ([paths] if isinstance(paths, str) else list(paths)):
        try:
            if ranges and multi_line:
                df = read_csv(spark, p)
            else:
                df = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"').csv(p)
            cols = df.columns
        except Exception as e:
            log.warning("could not process file %s: %s", p, e)
            continue
        if not all(c in cols for c in COMPOUND_COLUMNS):
            log.warning("skipping file %s: it lacks 'smiles' or 'applications'", p)
            continue
        frames.append(df.select(*COMPOUND_COLUMNS))
    schema = "smiles STRING, applications STRING"
    if not frames:
        log.error("no valid data could be loaded from the provided file paths")
        raw = spark.createDataFrame([], schema)
    else:
        raw = frames[0]
        for f in frames[1:]:
            raw = raw.unionByName(f)
    raw = raw.dropna(subset=COMPOUND_COLUMNS)
    parsed = parse_list(F.col("applications"))
    return raw.select("smiles", parsed.alias("applications"), parsed.isNotNull().alias("parse_ok"))


# ------------------------------------------------------------------ A2
def read_sdf(spark: SparkSession, path: str, cap: int | None = None, keep_broken: bool = False) -> DataFrame:
    """A2: one row per SDF record (records end with ``$$$$``), with its
    property map and 0-based record index in file order.

    Read as text with ``$$$$`` as the line separator, so files split across
    tasks without losing records; either line end is read. A property given
    twice keeps its last value. Records without an ``M  END`` line are broken:
    skipped, or kept with ``ok`` false by ``keep_broken``. ``cap`` keeps
    records by their index.
    """
    text = F.regexp_replace(F.regexp_replace("value", "\r\n?", "\n"), "^\n", "")
    raw = (spark.read.option("lineSep", "$$$$").text(path)
           .select(text.alias("rec"), F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"))
           .where(F.length(ptrim(F.col("rec"))) > 0)
           .withColumn("_mid", F.monotonically_increasing_id()))
    # the rows of a byte range are numbered in a row; one total for each range places the ranges
    blocks = raw.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_from"))
    before = F.sum("_n").over(Window.orderBy("_file", "_block")) - F.col("_n")
    idx = raw.join(blocks.withColumn("_before", before), ["_file", "_block"]).withColumn("mol_idx", F.col("_before") + F.col("_mid") - F.col("_from"))
    if cap is not None:
        idx = idx.where(F.col("mol_idx") < cap)
    # "> <NAME> ..." up to a blank line; cut with plain string functions, so long values cost no regex stack
    items = F.transform(F.filter(F.split("rec", "\n>(?=[^\n]*<)"), lambda x, i: i > 0), lambda x: F.struct(
        ptrim(F.regexp_extract(x, "<([^>\n]+)>", 1)).alias("k"), _sdf_value(F.substring_index(x, "\n", 1), x).alias("v")))
    props = F.map_from_entries(F.filter(items, lambda e, i: ~F.exists(F.filter(items, lambda o, j: j > i), lambda o: o["k"] == e["k"])))
    ok = F.col("rec").contains("M  END")
    out = idx.select("mol_idx", F.when(ok, props).alias("props"), ok.alias("ok"))
    return out if keep_broken else out.where("ok").drop("ok")


def _sdf_value(head, item):
    """The lines after an item's header, up to the first blank one."""
    rest = F.substr(item, F.length(head) + 2)
    value = F.when(F.startswith(rest, F.lit("\n")), "").otherwise(F.substring_index(rest, "\n\n", 1))
    return F.regexp_replace(value, "\n$", "")


SDF_FIELDS = ["DRUGBANK_ID", "DATABASE_ID", "GENERIC_NAME", "COMMON_NAME", "DRUG_NAME", "SYNONYMS",
              "SYSTEMATIC_NAME", "INTERNATIONAL_BRAND_NAME", "NAME", "CAS_NUMBER", "UNII", "SMILES"]


def sdf_columns(df: DataFrame, fields=SDF_FIELDS) -> DataFrame:
    """Property map -> one column per known property (absent = NULL)."""
    return df.select("mol_idx", *[F.try_element_at("props", F.lit(f)).alias(f) for f in fields])


# ------------------------------------------------------------------ A3-A5
BAD_PAGE = "_corrupt_record"

MOLECULE_PAGE = T.StructType([
    T.StructField("page", T.LongType()),
    T.StructField(BAD_PAGE, T.StringType()),
    T.StructField("molecules", T.ArrayType(T.StructType([
        T.StructField("molecule_structures", T.StructType([T.StructField("canonical_smiles", T.StringType())])),
        T.StructField("molecule_chembl_id", T.StringType()),
        T.StructField("pref_name", T.StringType()),
    ]))),
])

PROPERTY_PAGE = T.StructType([
    T.StructField("term", T.StringType()),
    T.StructField("PropertyTable", T.StructType([T.StructField("Properties", T.ArrayType(T.StructType([
        T.StructField("CID", T.LongType()),
        T.StructField("CanonicalSMILES", T.StringType()),
        T.StructField("Title", T.StringType()),
    ])))])),
])

IDENTIFIER_PAGE = T.StructType([
    T.StructField("term", T.StringType()),
    T.StructField("IdentifierList", T.StructType([
        T.StructField("CID", T.ArrayType(T.LongType())),
        T.StructField("ListKey", T.StringType()),
    ])),
])


def explode_molecule_pages(pages: DataFrame, keep=()) -> DataFrame:
    """A3 body: one row per molecule; a NULL structure object gives NULL
    SMILES (no failure); missing id -> CHEMBL_UNKNOWN_<page>_<offset>;
    missing name -> the id. A page without its number counts as page 0; an
    empty page has no rows. The stream takes the same rows. ``keep`` names
    columns of the page that its rows carry on."""
    m = pages.select(F.coalesce("page", F.lit(0)).alias("page"), F.posexplode("molecules").alias("offset", "m"), *keep)
    ident = F.coalesce(F.col("m.molecule_chembl_id"),
                       F.format_string("CHEMBL_UNKNOWN_%d_%d", F.col("page"), F.col("page") * 100))
    return m.select("page", "offset",
                    F.col("m.molecule_structures.canonical_smiles").alias("smiles"),
                    ident.alias("compound_id"),
                    F.coalesce(F.col("m.pref_name"), ident).alias("name"), *keep)


def read_molecule_pages(spark: SparkSession, path: str, pretty: bool = False) -> DataFrame:
    """A3: landed molecule pages: one JSON page per line, or with ``pretty``
    one (indented) page per file. Lines that are no page: ``bad_pages``."""
    return explode_molecule_pages(_pages(spark, path, pretty))


def bad_pages(spark: SparkSession, path: str, pretty: bool = False) -> DataFrame:
    """Quarantine of A3: (file, text) of lines (with ``pretty``: files) that are no JSON."""
    lines = spark.read.option("wholetext", pretty).text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("text"))
    return lines.where((F.length(ptrim(F.col("text"))) > 0) & F.try_parse_json("text").isNull())


def _pages(spark: SparkSession, path: str, pretty: bool) -> DataFrame:
    return (spark.read.schema(MOLECULE_PAGE).option("multiLine", pretty).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", BAD_PAGE).json(path))


def read_property_pages(spark: SparkSession, path: str) -> DataFrame:
    """A4: landed property pages -> (term, pos, cid, smiles, name); a missing
    title becomes 'PubChem CID <cid>'."""
    pages = spark.read.schema(PROPERTY_PAGE).json(path)
    p = pages.select("term", F.posexplode("PropertyTable.Properties").alias("pos", "p"))
    return p.select("term", "pos", F.col("p.CID").alias("cid"), F.col("p.CanonicalSMILES").alias("smiles"),
                    F.coalesce(F.col("p.Title"), F.format_string("PubChem CID %d", F.col("p.CID"))).alias("name"))


def read_identifier_pages(spark: SparkSession, path: str) -> DataFrame:
    """A5: (term, reference_cid = first CID or NULL, list_key)."""
    pages = spark.read.schema(IDENTIFIER_PAGE).json(path)
    return pages.select("term", F.try_element_at("IdentifierList.CID", F.lit(1)).alias("reference_cid"),
                        F.col("IdentifierList.ListKey").alias("list_key"))


# ------------------------------------------------------------------ A10
RESPONSES = "key STRING, raw_text STRING, status STRING"


def read_responses(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A10: landed model answers ``(key, raw_text, status)``."""
    return spark.read.schema(RESPONSES).format(fmt).load(path)
