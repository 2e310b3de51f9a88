"""DuckDB SQL for the adapters and the queries (the correctness oracle).

The adapters are CTEs written from the same fixed values as
``retort.plans.adapters``; each query is ``WITH <adapters> SELECT ...``.
"""

from __future__ import annotations

from retort import constants as K
from retort.plans import adapters as A


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _list(items) -> str:
    return "[" + ", ".join(_q(x) for x in items) + "]::VARCHAR[]"


def samples_cte() -> str:
    rows = ",\n    ".join(
        f"({i}, {_q(s)}, {_q(n)}, {_list(a)})" for i, (s, n, a) in enumerate(A.SAMPLES))
    return f"samples(sample_idx, sample_smiles, sample_name, sample_apps) AS (VALUES\n    {rows})"


def _source_rank(col: str) -> str:
    whens = " ".join(f"WHEN {_q(n)} THEN {i}" for i, n in enumerate(A.SOURCE_ORDER))
    return f"CASE {col} {whens} ELSE {len(A.SOURCE_ORDER)} END"


COMPOUNDS = f"""compounds AS (
  SELECT p_partkey AS row_id,
         CASE WHEN p_size = 50 THEN NULL
              WHEN p_size = 49 THEN ''
              WHEN p_size = 48 THEN sample_smiles || ')'
              ELSE sample_smiles || CASE WHEN k = 0 THEN '' ELSE translate(bin(k), '01', 'CN') END
         END AS smiles,
         p_name AS name, p_type AS source,
         {_source_rank('p_type')} AS source_rank,
         p_partkey AS ordinal,
         printf('CMP_%08d', p_partkey) AS compound_id,
         list_concat(sample_apps, string_split(p_name, ' '), [p_type, p_brand]) AS applications
  FROM (SELECT *, p_partkey // {A.N_SAMPLES} - CASE WHEN p_partkey // {A.N_SAMPLES} % 10 = 9 THEN 1 ELSE 0 END AS k FROM part)
  JOIN samples ON p_partkey % {A.N_SAMPLES} = sample_idx)"""

# python-strip-like trim of ASCII blanks, lower, drop blanks, distinct, sort
def clean_tags_sql(expr: str) -> str:
    return (f"list_sort(list_distinct(list_filter(list_transform({expr}, "
            f"lambda x: lower(regexp_replace(CAST(x AS VARCHAR), '^\\s+|\\s+$', '', 'g'))), lambda x: length(x) > 0)))")


CLEAN = f"""present AS (
  SELECT * FROM compounds WHERE smiles IS NOT NULL AND length(smiles) > 0),
firsts AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY smiles ORDER BY source_rank, ordinal) AS rn FROM present)
  WHERE rn = 1),
cleaned AS (
  SELECT row_id, smiles, name, source, source_rank, ordinal, compound_id,
         coalesce({clean_tags_sql('applications')}, []::VARCHAR[]) AS applications
  FROM firsts)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


BASE = with_ctes(samples_cte(), COMPOUNDS, CLEAN)


# ---------------------------------------------------------------- helpers
def ptrim_sql(e: str) -> str:
    return f"regexp_replace({e}, '^\\s+|\\s+$', '', 'g')"


def _contains_any_sql(low: str, words) -> str:
    return "(" + " OR ".join(f"contains({low}, {_q(w.lower())})" for w in words) + ")"


def hint_category_sql(e: str, mapping=K.APPLICATION_MAPPING) -> str:
    low = f"lower({e})"
    whens = " ".join(f"WHEN {_contains_any_sql(low, ws)} THEN {_q(c)}" for c, ws in mapping)
    return f"(CASE WHEN {e} IS NULL OR length({e}) = 0 THEN 'unknown' {whens} ELSE 'unknown' END)"


def name_categories_sql(e: str, mapping=K.APPLICATION_MAPPING) -> str:
    low = f"lower({e})"
    items = ", ".join(f"CASE WHEN {_contains_any_sql(low, ws)} THEN {_q(c)} END" for c, ws in mapping)
    return f"(CASE WHEN {e} IS NULL THEN []::VARCHAR[] ELSE list_filter([{items}], lambda x: x IS NOT NULL) END)"


ORGANIC = ["B", "C", "N", "O", "S", "P", "F", "I", "Cl", "Br", "b", "c", "n", "o", "s", "p", "*"]
BONDS = ["-", "=", "#", ":", "/", "\\", "~", "$"]
RING_RE = "%[0-9]{2}|[0-9]"


def toks_sql(e: str, pattern: str = K.SMILES_PATTERN_FIXED) -> str:
    return f"regexp_extract_all({e}, {_q(pattern)}, 1)"


def kind_sql(t: str) -> str:
    org = ", ".join(_q(x) for x in ORGANIC)
    bonds = ", ".join(_q(x) for x in BONDS)
    return (f"(CASE WHEN starts_with({t}, '[') THEN 'atom' WHEN {t} IN ({org}) THEN 'atom' "
            f"WHEN {t} IN ({bonds}) THEN 'bond' WHEN {t} = '(' THEN 'open' WHEN {t} = ')' THEN 'close' "
            f"WHEN {t} = '.' THEN 'dot' WHEN regexp_full_match({t}, '{RING_RE}') THEN 'ring' ELSE 'other' END)")


def kinds_sql(toks: str) -> str:
    return f"list_transform({toks}, lambda t: {kind_sql('t')})"


def valid_sql(s: str, toks: str, kinds: str) -> str:
    """Structural SMILES check over precomputed token/kind lists."""
    d = f"list_transform({kinds}, lambda k: CASE k WHEN 'open' THEN 1 WHEN 'close' THEN -1 ELSE 0 END)"
    lo = f"coalesce(list_min(list_transform(range(1, len({kinds}) + 1), lambda i: list_sum({d}[1:i]))), 0)"
    rings = f"list_filter({toks}, lambda t: regexp_full_match(t, '{RING_RE}'))"
    paired = (f"coalesce(list_bool_and(list_transform(list_distinct({rings}), "
              f"lambda r: len(list_filter({rings}, lambda x: x = r)) % 2 = 0)), true)")
    dangling = (f"coalesce(list_bool_or(list_transform(range(1, len({kinds})), "
                f"lambda i: {kinds}[i] = 'bond' AND {kinds}[i + 1] IN ('close', 'dot', 'bond'))), false)")
    return (f"({s} IS NOT NULL AND length({s}) > 0 "
            f"AND length(array_to_string({toks}, '')) = length({s}) "
            f"AND NOT list_contains({kinds}, 'other') "
            f"AND coalesce({kinds}[1] = 'atom', false) "
            f"AND coalesce({kinds}[-1] NOT IN ('bond', 'open', 'dot'), false) "
            f"AND coalesce(list_sum({d}), 0) = 0 AND {lo} >= 0 AND {paired} AND NOT {dangling})")


def heavy_sql(toks: str, kinds: str) -> str:
    return (f"len(list_filter(range(1, len({toks}) + 1), lambda i: {kinds}[i] = 'atom' "
            f"AND NOT regexp_full_match({toks}[i], '\\[[0-9]*H([^a-z].*)?\\]')))")


def smiles_view(src: str, col: str = "smiles") -> str:
    """SELECT src.*, toks, kinds, valid, heavy."""
    inner = f"SELECT *, {toks_sql(col)} AS toks FROM {src}"
    mid = f"SELECT *, {kinds_sql('toks')} AS kinds FROM ({inner})"
    return (f"SELECT *, {valid_sql(col, 'toks', 'kinds')} AS valid, {heavy_sql('toks', 'kinds')} AS heavy "
            f"FROM ({mid})")


def structure_sql(s: str, valid: str, heavy: str) -> str:
    bio = f"(contains({s}, 'N') AND (contains({s}, 'C(=O)') OR contains({s}, 'c1') OR contains({s}, 'n1')) AND {heavy} > 5)"
    small = f"(contains({s}, 'O') AND {heavy} < 10 AND {heavy} > 1)"
    return (f"(CASE WHEN NOT {valid} OR {heavy} <= 0 THEN NULL WHEN {bio} THEN {_q(K.STRUCTURE_BIOACTIVE)} "
            f"WHEN {small} THEN {_q(K.STRUCTURE_SMALL)} ELSE {_q(K.STRUCTURE_GENERIC)} END)")


def slug_sql(e: str) -> str:
    return f"replace(lower({e}), ' ', '_')"


def rule_tags_sql(s: str, valid: str, heavy: str, name: str | None, hint: str | None,
                  error_context: str | None = None) -> str:
    parts = []
    if error_context is not None:
        parts.append(f"[{_q(K.ERROR_TAG_FORMAT % error_context)}]")
    if hint is not None:
        cat = hint_category_sql(hint)
        parts.append(f"(CASE WHEN {hint} IS NULL OR length({hint}) = 0 THEN []::VARCHAR[] "
                     f"ELSE [{slug_sql(hint)}, CASE WHEN {cat} <> 'unknown' THEN {cat} END] END)")
    if name is not None:
        parts.append(name_categories_sql(name))
    base = f"list_filter(list_concat({', '.join(parts)}), lambda x: x IS NOT NULL)" if parts else "[]::VARCHAR[]"
    st = structure_sql(s, valid, heavy)
    withs = f"(CASE WHEN len({base}) <= 1 AND {st} IS NOT NULL THEN list_append({base}, {st}) ELSE {base} END)"
    out = f"list_sort(list_distinct({withs}))"
    return f"(CASE WHEN len({out}) > 0 THEN {out} ELSE [{_q(K.FALLBACK_EMPTY)}] END)"


def answer_status_sql(raw: str) -> str:
    low = f"lower({ptrim_sql(raw)})"
    return (f"(CASE WHEN {raw} IS NULL THEN 'missing' WHEN length({low}) = 0 THEN 'empty' "
            f"WHEN contains({low}, {_q(K.UNKNOWN_APPLICATION)}) THEN 'unknown' ELSE 'ok' END)")


def parse_answer_sql(raw: str) -> str:
    low = f"lower({ptrim_sql(raw)})"
    items = f"list_filter(list_transform(string_split({low}, ','), lambda x: {ptrim_sql('x')}), lambda x: length(x) > 0)"
    return (f"(CASE WHEN {raw} IS NULL OR length({low}) = 0 OR contains({low}, {_q(K.UNKNOWN_APPLICATION)}) "
            f"THEN ['unknown_from_gemini'] WHEN len({items}) = 0 THEN ['unknown_from_gemini'] ELSE {items} END)")


def gate_sql(ans: str, status: str, variant: str, hint: str | None = None) -> str:
    failed = f"({status} IN ('empty', 'error', 'unknown') OR {ans} IS NULL OR len({ans}) = 0)"
    confirmed = f"(CASE WHEN {status} = 'unknown' THEN [{_q(K.UNKNOWN_CONFIRMED)}] ELSE []::VARCHAR[] END)"
    if variant == "pubchem":
        cat = hint_category_sql(hint)
        fail = f"list_concat([{hint}, {cat}], {confirmed})"
        ok = f"list_concat({ans}, [{hint}, CASE WHEN {cat} <> 'unknown' THEN {cat} END])"
    else:
        on_fail, on_ok = K.GATE_VARIANTS[variant]
        fail = f"list_concat({_list(on_fail)}, {confirmed})"
        ok = f"list_concat({ans}, {_list(on_ok)})"
    tags = f"(CASE WHEN {failed} THEN {fail} ELSE {ok} END)"
    kept = f"list_filter({tags}, lambda x: x IS NOT NULL AND length({ptrim_sql('x')}) > 0)"
    return f"list_sort(list_distinct({kept}))"


def _answer_item_sql(x: str) -> str:
    return f"replace(lower({x}), ' ', '_')"


def parse_tags_csv_sql(text: str) -> str:
    unquoted = f"regexp_replace({ptrim_sql('x')}, '^[\"'']+|[\"'']+$', '', 'g')"
    items = f"list_transform(string_split({text}, ','), lambda x: {_answer_item_sql(unquoted)})"
    kept = f"list_filter({items}, lambda x: length(x) BETWEEN 3 AND 50)[1:5]"
    return f"(CASE WHEN len({kept}) > 0 THEN {kept} ELSE [{_q(K.UNKNOWN_APPLICATION)}] END)"


def parse_tags_json_sql(text: str) -> str:
    arr_txt = (f"(CASE WHEN regexp_matches({text}, '(?s)\\[.*?\\]') "
               f"THEN '[' || regexp_extract({text}, '(?s)\\[(.*?)\\]', 1) || ']' END)")
    parsed = f"(CASE WHEN json_valid({arr_txt}) THEN CAST(json_extract({arr_txt}, '$[*]') AS JSON[]) END)"
    strings = f"list_filter({parsed}, lambda v: json_type(v) = 'VARCHAR')"
    items = f"list_transform({strings}, lambda v: {ptrim_sql("json_extract_string(v, '$')")})"
    items = f"list_transform(list_filter({items}, lambda x: length(x) > 0), lambda x: {_answer_item_sql('x')})"
    kept = f"list_filter({items}, lambda x: length(x) BETWEEN 3 AND 50)[1:5]"
    from_json = f"(CASE WHEN len({kept}) > 0 THEN {kept} ELSE [{_q(K.UNKNOWN_APPLICATION)}] END)"
    return (f"(CASE WHEN {parsed} IS NOT NULL THEN {from_json} "
            f"WHEN contains({text}, ',') THEN {parse_tags_csv_sql(text)} "
            f"ELSE [{_q(K.UNKNOWN_APPLICATION)}] END)")
