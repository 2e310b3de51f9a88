"""Patent path: relevance filter, newest-first scan, candidate names, name
resolution, identity and id formats (A6, B4, B6, B7, C4, E2, E4, G5, G6).

Regex notes. The relevance filter reproduces the original warehouse SQL,
whose regex engine has ASCII ``\\b``/``\\w``/``\\s``; Java's ``\\b`` is not
ASCII-only, so the boundaries are written as explicit ASCII look-arounds.
Candidate extraction reproduces Python ``re`` (Unicode classes), so those
patterns run with ``(?iU)``.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retort import constants as K
from retort.functions.text import bind, first_assignee, join_text, ptrim

_W = "[A-Za-z0-9_]"
_B = f"(?<!{_W})"
_E = f"(?!{_W})"
_S = "[\\t\\n\\f\\r ]"


def _alt(words) -> str:
    return "(?:" + "|".join(words) + ")"


def relevance_patterns(subject=K.PATENT_ABSTRACT_SUBJECT, use=K.PATENT_ABSTRACT_USE,
                       title_words=K.PATENT_TITLE_WORDS, fields=K.PATENT_ABSTRACT_FIELDS):
    """The four ASCII-boundary patterns of the relevance filter."""
    return (f"{_B}{_alt(subject)}{_S}+{_W}+{_E}", f"{_B}{_alt(use)}{_E}",
            f"{_B}{_alt(title_words)}{_E}", f"{_B}{_alt(fields)}{_E}")


def relevant_patents(df: DataFrame, country: str = K.PATENT_COUNTRY, since: str = K.PATENT_SINCE,
                     subject=K.PATENT_ABSTRACT_SUBJECT, use=K.PATENT_ABSTRACT_USE,
                     title_words=K.PATENT_TITLE_WORDS, fields=K.PATENT_ABSTRACT_FIELDS,
                     cpc_prefixes=K.PATENT_CPC_PREFIXES, min_abstract: int = K.PATENT_MIN_ABSTRACT,
                     min_title: int = K.PATENT_MIN_TITLE) -> DataFrame:
    """Country, date, length and NULL predicates (pushed to the scan
    where the columns are stored), then the text/CPC test."""
    p1, p2, p3, p4 = relevance_patterns(subject, use, title_words, fields)
    abstract, title = F.lower("abstract"), F.lower("title")
    cpc_hit = F.exists("cpc", lambda c: _starts_any(c["code"], cpc_prefixes))
    text_hit = ((abstract.rlike(p1) & abstract.rlike(p2))
                | (title.rlike(p3) & abstract.rlike(p4))
                | cpc_hit)
    return (df.where((F.col("country_code") == country)
                     & (F.col("publication_date") >= F.lit(since).cast("date"))
                     & F.col("abstract").isNotNull()
                     & (F.length("abstract") > min_abstract)
                     & (F.length("title") > min_title))
            .where(text_hit))


def _starts_any(col: Column, prefixes) -> Column:
    cond = F.lit(False)
    for p in prefixes:
        cond = cond | col.startswith(p)
    return cond


def newest(df: DataFrame, col: str = "filing_date", n: int = 2 * 2000,
           tie: str = "publication_number") -> DataFrame:
    """Newest first (NULL dates last), first ``n`` rows; a top-k
    (TakeOrderedAndProject), never a full sort."""
    return df.orderBy(F.col(col).desc_nulls_last(), F.col(tie).asc()).limit(n)


PATENT_COLUMNS = ["publication_number", "title", "abstract", "filing_date", "assignee_harmonized", "cpc"]


def scan_patents(df: DataFrame, limit: int, **filter_args) -> DataFrame:
    """Relevance filter, the six projected columns, newest ``limit``."""
    return newest(relevant_patents(df, **filter_args).select(*PATENT_COLUMNS), "filing_date", limit)


# Java's regex engine recurses once per iteration of a repeated group, so
# "(?:\s+[a-z]+)*" overflows the task stack on long texts, and a run of words
# without digits after it is searched again from each of its words. All starts
# within a run end alike, so the run is taken once, possessively, with the
# digits if they follow; runs that do not end in digits are then dropped.
_JVM_EQUIVALENT = {
    r"\b[A-Z][a-z]*(?:\s+[a-z]+)*\s+\d+\b": (r"\b[A-Z][a-z\s]*+(?:(?<=\s)\d+\b)?", r"(?U)\d$"),
}


#: What a text must hold, folded, for a pattern to match it: one of some words, or what a cheaper pattern finds.
#: Patterns that are not listed run on every text.
_NEEDS = {
    r"\b\d+[a-z]?-[a-z\-]+-\d+[a-z]?\b": ("-",),
    r"\b(?:compound|drug|molecule|chemical)\s+\w+\b": ("compound", "drug", "molecule", "chemical"),
    r"compound\s+([A-Z]\w*)": ("compound",),
    r"formula\s+([A-Z][A-Za-z0-9]+)": ("formula",),
    r"(\w+(?:ine|anol|acid|ate|ide))\s+(?:was|is|can|has)": r"(?U)(?:ine|anol|acid|ate|ide)\s+(?:was|is|can|has)",
    r"synthesis\s+of\s+(\w+)": ("synthesis",),
    r"preparation\s+of\s+(\w+)": ("preparation",),
    r"active\s+ingredient\s+(\w+)": ("ingredient",),
    r"therapeutic\s+agent\s+(\w+)": ("therapeutic",),
    r"drug\s+(\w+)": ("drug",),
    r"molecule\s+([A-Z]\w*)": ("molecule",),
}


def folded(t: Column) -> Column:
    """Lower-cased text, with the four other letters that match an ASCII letter when case is ignored as that letter."""
    return F.lower(F.translate(t, "\u017f\u0131\u0130\u212a", "siik"))


def pattern_matches(t: Column, p: str, group: int = 0) -> Column:
    """All matches of one pattern, Python-``re`` semantics."""
    pattern, ends = _JVM_EQUIVALENT.get(p, (p, None))
    found = F.regexp_extract_all(t, F.lit("(?iU)" + pattern), group)
    return F.filter(found, lambda x: x.rlike(ends)) if ends else found


def _matches(t: Column, fold: Column, p: str, group: int) -> Column:
    """``pattern_matches``, run only on texts that hold what the pattern needs."""
    found = pattern_matches(t, p, group)
    needs = _NEEDS.get(p)
    if needs is None:
        return found
    there = fold.rlike(needs) if isinstance(needs, str) else reduce(or_, [F.contains(fold, F.lit(w)) for w in needs])
    return F.when(t.isNull(), F.lit(None)).when(there, found).otherwise(F.array().cast("array<string>"))


def candidates(text, patterns=K.CHEMICAL_PATTERNS, indicators=K.CHEMICAL_INDICATORS, n: int = 5) -> Column:
    """G5 + G6: candidate chemical names from free text, Python-``re``
    semantics (case-insensitive, Unicode classes).

    Pattern matches (stripped, 3 < length < 50) in pattern order, unique;
    then the indicator captures (stripped, non-blank); unique in first-seen
    order; first ``n``.
    """
    t = text if isinstance(text, Column) else F.col(text)

    def found(b: Column) -> Column:
        g5 = [F.filter(F.transform(_matches(b["t"], b["fold"], p, 0), ptrim),
                       lambda x: (F.length(x) > 3) & (F.length(x) < 50)) for p in patterns]
        g6 = [F.filter(F.transform(_matches(b["t"], b["fold"], p, 1), ptrim),
                       lambda x: F.length(x) > 0) for p in indicators]
        return F.slice(F.array_distinct(F.concat(*g5, *g6)), 1, n)

    # the text is put together and folded once a row
    return bind(t, lambda s: bind(F.struct(s.alias("t"), folded(s).alias("fold")), found))


def first_n(df: DataFrame, array_col: str, n: int, name: str = "name") -> DataFrame:
    """The first ``n`` items of an array column as rows (with ``pos``)."""
    rest = [c for c in df.columns if c != array_col]
    # the _outer form keeps Catalyst from inferring a size(array) > 0 filter
    # and pushing it below an upstream repartition, which would evaluate an
    # expensive array expression twice; empty arrays give pos NULL, dropped here
    return (df.select(*rest, F.posexplode_outer(array_col).alias("pos", name))
            .where(F.col("pos") < n))


def normalise_name(col) -> Column:
    c = col if isinstance(col, Column) else F.col(col)
    return F.lower(ptrim(c))


def resolve_names(df: DataFrame, dictionary: DataFrame, col: str = "name") -> DataFrame:
    """C4 (re-aimed): name -> SMILES by lookup on the normalised name;
    names without an entry are dropped. ``dictionary`` is ``(name, smiles)``
    with one row per normalised name."""
    d = dictionary.select(normalise_name("name").alias("_nkey"), "smiles")
    return df.withColumn("_nkey", normalise_name(col)).join(d, "_nkey").drop("_nkey")


def name_dictionary(compounds: DataFrame, name: str = "name", order=("source_rank", "ordinal")) -> DataFrame:
    """Dictionary for C4: one ``(name, smiles)`` per normalised name, the
    first compound in plan order that has a SMILES (partial aggregate, so
    a name held by many compounds is reduced map-side)."""
    from retort.operators.clean import dedupe_first, drop_missing
    present = drop_missing(compounds.select(name, "smiles", *order), ["smiles"])
    keyed = present.select(normalise_name(name).alias("_nkey"), *order, "smiles")
    return dedupe_first(keyed, key="_nkey", order=order).select(F.col("_nkey").alias("name"), "smiles")


def patent_compound_id(pub, name) -> Column:
    """AI_{publication}_{first 8 characters of the name}."""
    return F.concat(F.lit("AI_"), pub, F.lit("_"), F.left(name, F.lit(8)))


def format_ids(idx, pub=None, name=None) -> dict:
    """The id formats of the sources, from an integer column."""
    out = {
        "cid": F.concat(F.lit("CID_"), idx.cast("string")),
        "patent_sample": F.format_string(K.INDUSTRIAL_ID_FORMAT, idx),
        "sample_drug": F.format_string(K.PHARMA_ID_FORMAT, idx),
        "db_unknown": F.format_string("DB_UNKNOWN_%06d", idx),
    }
    if pub is not None:
        out["ai_id"] = patent_compound_id(pub, name)
    return out


def _first_piece(col) -> Column:
    """'a|b\\nc' -> 'a': cut at the first newline, then the first pipe,
    strip (NULL -> '')."""
    c = F.coalesce(col, F.lit(""))
    return ptrim(F.substring_index(F.substring_index(c, "\n", 1), "|", 1))


def resolve_identity(df: DataFrame, idx: str = "mol_idx") -> DataFrame:
    """Id and name default chains of an SDF record's properties.

    id   = DRUGBANK_ID, else DATABASE_ID, else DB_UNKNOWN_<idx>
    name = GENERIC_NAME, else COMMON_NAME, else DRUG_NAME, else id; when
           that is still the id: first piece of SYNONYMS, SYSTEMATIC_NAME,
           INTERNATIONAL_BRAND_NAME (first non-empty), else NAME, else id.
    A property absent from the record is NULL here.
    """
    ident = F.coalesce(F.col("DRUGBANK_ID"), F.col("DATABASE_ID"),
                       F.format_string("DB_UNKNOWN_%06d", F.col(idx)))
    name0 = F.coalesce(F.col("GENERIC_NAME"), F.col("COMMON_NAME"), F.col("DRUG_NAME"), ident)
    fallback = F.coalesce(
        F.nullif(_first_piece(F.col("SYNONYMS")), F.lit("")),
        F.nullif(_first_piece(F.col("SYSTEMATIC_NAME")), F.lit("")),
        F.nullif(_first_piece(F.col("INTERNATIONAL_BRAND_NAME")), F.lit("")),
        F.col("NAME"), ident)
    name = F.when(name0 == ident, fallback).otherwise(name0)
    display = F.when((name.isNotNull()) & (name != "") & (name != ident), name) \
        .otherwise(F.concat(F.lit("DrugBank Compound "), ident))
    return df.withColumn("compound_id", ident).withColumn("name", display)


def patent_record(df: DataFrame) -> DataFrame:
    """Output columns of a patent compound (dates as text, '' when NULL)."""
    return df.select(
        "smiles", "name", "applications", F.lit(K.PATENT_SOURCE).alias("source"),
        "publication_number",
        F.coalesce(F.col("filing_date").cast("string"), F.lit("")).alias("filing_date"),
        patent_compound_id(F.col("publication_number"), F.col("name")).alias("compound_id"),
        F.col("title").alias("patent_title"),
        first_assignee("assignee_harmonized").alias("assignee"))


__all__ = ["relevant_patents", "newest", "scan_patents", "candidates", "first_n", "resolve_names", "name_dictionary",
           "resolve_identity", "format_ids", "patent_record", "join_text"]
