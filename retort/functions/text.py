"""String, list and JSON column functions (Column in, Column out).

All are JVM built-ins, so they stay inside whole-stage codegen; no Python
runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from retort import constants as K

# Python's str.strip() removes every Unicode blank; Spark's trim() only U+0020.
_WS_EDGES = r"(?U)^\s+|\s+$"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def bind(value: Column, fn) -> Column:
    """``fn`` of a value that the row works out once, however often ``fn`` names it, also inside lambdas."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def ptrim(col) -> Column:
    """Trim like Python ``str.strip()`` (all Unicode whitespace)."""
    return F.regexp_replace(_c(col), _WS_EDGES, "")


def strip_chars(col, chars: str) -> Column:
    """Like Python ``str.strip(chars)`` for a small set of literal characters."""
    cls = "".join("\\" + ch for ch in chars)
    return F.regexp_replace(_c(col), f"^[{cls}]+|[{cls}]+$", "")


def clean_tag_array(arr) -> Column:
    """trim + lower, drop blanks, unique, code-point sorted (G2 on a list)."""
    cleaned = F.transform(_c(arr), lambda x: F.lower(ptrim(x.cast("string"))))
    kept = F.filter(cleaned, lambda x: F.length(x) > 0)
    return F.array_sort(F.array_distinct(kept))


def clean_tags(col) -> Column:
    """List or comma string -> sorted unique lowercase tags; else empty.

    Dispatches on the column's type when the plan is analysed: a string
    column is split on commas first.
    """
    c = _c(col)
    return F.when(c.isNull(), F.array().cast("array<string>")).otherwise(clean_tag_array(c))


def clean_tags_from_string(col) -> Column:
    c = _c(col)
    return F.when(c.isNull(), F.array().cast("array<string>")).otherwise(
        clean_tag_array(F.split(c, ",")))


def parse_list(col) -> Column:
    """G1: parse a Python list literal of strings (``"['a', \"it's\"]"``).

    Malformed input gives NULL (the row can be quarantined) instead of
    aborting the job.
    """
    return F.from_json(_c(col), "array<string>", {"allowSingleQuotes": "true", "mode": "PERMISSIVE"})


def list_literal(arr) -> Column:
    """Render an array<string> as a list literal that ``parse_list`` reads back: JSON, so quotes,
    backslashes and line breaks inside items are escaped."""
    return F.to_json(_c(arr))


def _answer_item(x: Column) -> Column:
    return F.replace(F.lower(x), F.lit(" "), F.lit("_"))


def parse_tags_csv(col) -> Column:
    """Split on commas, strip blanks then quotes, lower, spaces -> '_',
    keep length 3..50, first 5; nothing left -> ['unknown_application']."""
    items = F.transform(F.split(_c(col), ","),
                        lambda x: _answer_item(strip_chars(ptrim(x), "\"'")))
    kept = F.slice(F.filter(items, lambda x: F.length(x).between(3, 50)), 1, 5)
    return F.when(F.size(kept) > 0, kept).otherwise(F.array(F.lit(K.UNKNOWN_APPLICATION)))


def _json_array_text(col) -> Column:
    inner = F.regexp_extract(_c(col), r"(?s)\[(.*?)\]", 1)
    found = F.regexp_like(_c(col), F.lit(r"(?s)\[.*?\]"))
    return F.when(found, F.concat(F.lit("["), inner, F.lit("]")))


def parse_tags_json(col) -> Column:
    """G7 + G8: tags from a free-text answer.

    The first ``[...]`` (non-greedy, dot-all) is parsed as JSON; only string
    items count (numbers are not turned into strings); each is stripped,
    lower-cased, blanks -> '_', kept when 3..50 long, first 5 kept; an
    empty result is ['unknown_application']. Without a parseable array the
    comma fallback applies when the text has a comma, else the unknown tag.
    """
    text = _c(col)
    arr = F.try_variant_get(F.try_parse_json(_json_array_text(text)), "$", "array<variant>")
    strings = F.filter(arr, lambda v: F.schema_of_variant(v) == F.lit("STRING"))
    items = F.transform(strings, lambda v: ptrim(F.variant_get(v, "$", "string")))
    items = F.transform(F.filter(items, lambda x: F.length(x) > 0), _answer_item)
    kept = F.slice(F.filter(items, lambda x: F.length(x).between(3, 50)), 1, 5)
    from_json = F.when(F.size(kept) > 0, kept).otherwise(F.array(F.lit(K.UNKNOWN_APPLICATION)))
    return (F.when(arr.isNotNull(), from_json)
            .when(F.contains(text, F.lit(",")), parse_tags_csv(text))
            .otherwise(F.array(F.lit(K.UNKNOWN_APPLICATION))))


def parse_answer(col) -> Column:
    """Comma answer -> tags; blank or holding the unknown marker -> the
    sentinel ['unknown_from_gemini']."""
    low = F.lower(ptrim(_c(col)))
    items = F.filter(F.transform(F.split(low, ","), ptrim), lambda x: F.length(x) > 0)
    sentinel = F.array(F.lit("unknown_from_gemini"))
    return (F.when(low.isNull() | (F.length(low) == 0) | F.contains(low, F.lit(K.UNKNOWN_APPLICATION)), sentinel)
            .when(F.size(items) == 0, sentinel)
            .otherwise(items))


def keyword_flags(col, rules=K.PATENT_KEYWORD_RULES, default=K.PATENT_DEFAULT_TAG) -> Column:
    """One tag per rule whose substrings occur in the lower-cased text,
    in rule order; none -> [default]."""
    low = F.lower(_c(col))
    flags = [F.when(_any_contains(low, words), F.lit(tag)) for tag, words in rules]
    hits = F.filter(F.array(*flags), lambda x: x.isNotNull())
    return F.when(F.size(hits) > 0, hits).otherwise(F.array(F.lit(default)))


def _any_contains(low: Column, words) -> Column:
    cond = F.lit(False)
    for w in words:
        cond = cond | F.contains(low, F.lit(w))
    return cond


def strip_paren(col) -> Column:
    """Drop one trailing parenthetical; keep the original if that
    leaves nothing."""
    c = _c(col)
    cleaned = ptrim(F.regexp_replace(c, r"\s*\([^)]*\)\s*$", ""))
    return F.coalesce(F.nullif(cleaned, F.lit("")), c)


def strip_artifacts(col, prefixes=K.ARTIFACT_PREFIXES) -> Column:
    """Remove generator prompt echoes, trimming after each step."""
    out = ptrim(_c(col))
    for p in prefixes:
        out = ptrim(F.replace(out, F.lit(p), F.lit("")))
    return out


def prompt(parts, max_chars: int = K.PROMPT_CONTEXT_CHARS, context=None) -> Column:
    """Prompt text from (label, column) parts; NULL parts are skipped.

    ``context`` (optional) is cut to ``max_chars`` characters.
    """
    pieces = [F.when(_c(c).isNotNull(), F.concat(F.lit(label), _c(c))) for label, c in parts]
    if context is not None:
        pieces.append(F.when(_c(context).isNotNull(),
                             F.concat(F.lit("Context: "), F.left(_c(context), F.lit(max_chars)), F.lit("..."))))
    return F.concat_ws(" ", *pieces)


def first_assignee(col, default: str = "Unknown") -> Column:
    """First assignee struct with a non-blank name, else 'Unknown'."""
    named = F.filter(_c(col), lambda s: s["name"].isNotNull() & (F.length(s["name"]) > 0))
    return F.coalesce(F.try_element_at(named, F.lit(1))["name"], F.lit(default))


def url_term(col) -> Column:
    """Percent-encode a term as a URL path segment ('/' kept)."""
    # form encoding differs from path quoting on ' ', '*', '~' and '/'
    enc = F.url_encode(_c(col))
    for a, b in (("+", "%20"), ("*", "%2A"), ("%7E", "~"), ("%2F", "/")):
        enc = F.replace(enc, F.lit(a), F.lit(b))
    return enc


def join_text(title, abstract) -> Column:
    """G18: 'title abstract'."""
    return F.concat_ws(" ", _c(title), _c(abstract))


def one_hot(col, cats) -> Column:
    """One-hot double array over ``cats``; misses go to the last
    ('Unknown') slot."""
    # a look-up in constant arrays: a comparison for each slot makes code that the JVM is too slow to compile
    known = list(cats[:-1])
    slots = [F.array(*[F.lit(float(x == y)) for y in known], F.lit(0.0)) for x in known]
    place = F.array_position(F.array(*[F.lit(x) for x in known]), _c(col))
    miss = F.array(*[F.lit(0.0) for _ in known], F.lit(1.0))
    return F.element_at(F.array(*slots, miss), F.when(place > 0, place).otherwise(len(known) + 1).cast("int"))


def slug(col) -> Column:
    return F.replace(F.lower(_c(col)), F.lit(" "), F.lit("_"))
