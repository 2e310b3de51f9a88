"""Application tagging: keyword categories, rule tags, answer gates (C1-C3,
C5, B5, G11).

The keyword dictionary is small and fixed, so category lookups compile to
one CASE expression per row (no join, no shuffle). A dictionary given as a
table is joined on one anchor gram a keyword and verified in place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retort import constants as K
from retort.functions.smiles import token_kind, tokenize, valid_smiles
from retort.functions.text import bind, parse_answer, ptrim, slug
from retort.operators.clean import dedupe_first
from retort.operators.lookup import latest
from retort.session import scratch_path, spread


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _contains_any(low: Column, words) -> Column:
    cond = F.lit(False)
    for w in words:
        cond = cond | F.contains(low, F.lit(w.lower()))
    return cond


def hint_category(col, mapping=K.APPLICATION_MAPPING) -> Column:
    """First category (in mapping order) with a keyword contained in the
    lower-cased hint; NULL/empty hint or no match -> 'unknown'."""
    low = F.lower(_c(col))
    expr = F.lit("unknown")
    for cat, words in reversed(mapping):
        expr = F.when(_contains_any(low, words), F.lit(cat)).otherwise(expr)
    return F.when(low.isNull() | (F.length(low) == 0), F.lit("unknown")).otherwise(expr)


def name_categories(col, mapping=K.APPLICATION_MAPPING) -> Column:
    """Every category with a keyword in the lower-cased name, in mapping
    order (empty for NULL)."""
    def named(low: Column) -> Column:
        hits = F.array(*[F.when(_contains_any(low, words), F.lit(cat)) for cat, words in mapping])
        return F.when(low.isNull(), F.array().cast("array<string>")).otherwise(F.filter(hits, lambda x: x.isNotNull()))

    # the filter is not compiled: an unbound name would be put together and lower-cased once a keyword
    return bind(F.lower(_c(col)), named)


#: Letters of the grams that keywords are filed under; shorter keywords are filed under themselves.
ANCHOR = 3


def _grams(text: Column, n: int) -> Column:
    """Different n-letter grams of a text, linear in its length (none where it is shorter)."""
    views = lambda c: [F.slice(c, j + 1, F.greatest(F.size(c) - (n - 1), F.lit(0))).alias(str(j)) for j in range(n)]
    return bind(F.split(text, ""), lambda c: F.array_distinct(F.transform(
        F.arrays_zip(*views(c)), lambda z: F.concat(*[z[str(j)] for j in range(n)]))))


def keyword_index(dim: DataFrame) -> DataFrame:
    """Each different keyword once, filed under an anchor: of its 3-letter grams the one that the fewest keywords
    have (ties by text), or itself where it is shorter. (anchor, keyword, entries), where ``entries`` are the
    (cat_rank, category) it stands for. A gram all keywords have is nobody's anchor but for want of others."""
    words = (dim.where(F.length("keyword") > 0).groupBy(F.lower("keyword").alias("keyword"))
             .agg(F.collect_set(F.struct("cat_rank", "category")).alias("entries")))  # one keyword's categories
    own = F.when(F.length("keyword") < ANCHOR, F.array("keyword")).otherwise(_grams(F.col("keyword"), ANCHOR))
    grams = words.select("keyword", F.explode(own).alias("anchor"))
    counts = grams.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"))
    filed = grams.join(counts, "anchor").groupBy("keyword").agg(F.min(F.struct("n", "anchor"))["anchor"].alias("anchor"))
    return words.join(filed, "keyword").select("anchor", "keyword", "entries")


def categories_by_join(df: DataFrame, key: str, col: str, dim: DataFrame) -> DataFrame:
    """C2/C3 against a keyword table ``(cat_rank, category, keyword)`` of any
    size. Each keyword is filed under one anchor gram (``keyword_index``); the
    grams of a hint, one for each letter, meet the anchors in one join, and
    the candidates are verified in the hint itself. A hint that many rows
    have is searched once.

    Returns ``(key, first_category, categories)``; rows without a hit get
    'unknown' and an empty list. Of repeated keys each row gets the categories
    of all the key's hints. The index is written once in the checkpoint folder, so the planner
    knows its size: a small one is broadcast and no gram is shuffled, a large one is joined by gram.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "keyword-index")
    keyword_index(dim).write.parquet(path)
    index = spark.read.parquet(path)
    low = F.lower(F.col(col))
    hints = df.where(F.length(col) > 0).select(low.alias("hint")).distinct()
    text = F.col("hint")
    sizes = [r[0] for r in index.select(F.length("anchor")).distinct().collect()]  # ANCHOR numbers at most
    grams = F.concat(F.array().cast("array<string>"), *[_grams(text, n) for n in sorted(sizes)])
    met = spread(hints).select("hint", F.explode_outer(grams).alias("anchor")).join(index, "anchor")
    hits = met.where(F.contains(text, F.col("keyword"))).select("hint", F.explode("entries").alias("e"))
    found = hits.groupBy("hint").agg(F.collect_set("e").alias("entries"))  # at most the categories there are
    rows = df.select(key, low.alias("hint")).join(found, "hint").select(key, "entries")
    per_key = rows.groupBy(key).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("entries")))).alias("entries"))
    none = F.array().cast("array<string>")
    return df.select(key).join(per_key, key, "left").select(
        key, F.coalesce(F.try_element_at("entries", F.lit(1))["category"], F.lit("unknown")).alias("first_category"),
        F.coalesce(F.col("entries")["category"], none).alias("categories"))


def heavy_atoms(smiles) -> Column:
    """Heavy-atom count: atom tokens that are not bracket hydrogens."""
    toks = tokenize(_c(smiles), K.SMILES_PATTERN_FIXED)
    heavy = F.filter(toks, lambda t: (token_kind(t) == "atom") & ~t.rlike(r"^\[[0-9]*H([^a-z].*)?\]$"))
    return F.size(heavy)


def structure_class(smiles) -> Column:
    """The structure tag of the rule fallback (NULL when none applies)."""
    s = _c(smiles)

    def tag(x: Column) -> Column:
        n = x["n"]
        bio = (F.contains(s, F.lit("N"))
               & (F.contains(s, F.lit("C(=O)")) | F.contains(s, F.lit("c1")) | F.contains(s, F.lit("n1")))
               & (n > 5))
        small = F.contains(s, F.lit("O")) & (n < 10) & (n > 1)
        return (F.when(~x["ok"] | (n <= 0), F.lit(None).cast("string"))
                .when(bio, F.lit(K.STRUCTURE_BIOACTIVE))
                .when(small, F.lit(K.STRUCTURE_SMALL))
                .otherwise(F.lit(K.STRUCTURE_GENERIC)))

    return bind(F.struct(valid_smiles(s).alias("ok"), heavy_atoms(s).alias("n")), tag)


def rule_tags(smiles, name=None, hint=None, error_context=None, mapping=K.APPLICATION_MAPPING) -> Column:
    """Rule-based tags when no model answer is available.

    error tag, hint slug, hint category, categories named in the name; with
    at most one tag so far a structure class from the SMILES is added.
    Unique and sorted; nothing at all -> ['unknown_application_fallback'].
    """
    parts = []
    if error_context is not None:
        parts.append(F.array(F.lit(K.ERROR_TAG_FORMAT % error_context)))
    if hint is not None:
        h = _c(hint)
        cat = F.nullif(hint_category(h, mapping), F.lit("unknown"))
        parts.append(F.when(h.isNull() | (F.length(h) == 0), F.array().cast("array<string>"))
                     .otherwise(F.array(slug(h), cat)))
    if name is not None:
        parts.append(name_categories(_c(name), mapping))
    present = lambda arr: F.filter(arr, lambda x: x.isNotNull())
    base = present(F.concat(*parts)) if parts else F.array().cast("array<string>")
    with_struct = bind(base, lambda b: F.when(F.size(b) <= 1, F.concat(b, present(F.array(structure_class(smiles))))).otherwise(b))
    return bind(F.array_sort(F.array_distinct(with_struct)),
                 lambda out: F.when(F.size(out) > 0, out).otherwise(F.array(F.lit(K.FALLBACK_EMPTY))))


def gate_tags(answer, status, variant: str, hint=None, mapping=K.APPLICATION_MAPPING) -> Column:
    """Sentinel gate. ``status`` is 'ok' / 'empty' / 'error' / 'unknown'.

    chembl / drugbank: failure -> the variant's default tags (+ the
    'confirmed unknown' tag for 'unknown'); success -> answer + the
    variant's tags. pubchem: failure -> [hint, category(hint)] (+ confirmed
    unknown); success -> answer + hint + category when known. The result is
    non-blank, unique and sorted.
    """
    st = _c(status)
    ans = _c(answer)
    failed = st.isin("empty", "error", "unknown") | ans.isNull() | (F.size(ans) == 0)
    confirmed = F.when(st == "unknown", F.array(F.lit(K.UNKNOWN_CONFIRMED))).otherwise(
        F.array().cast("array<string>"))
    if variant == "pubchem":
        h = _c(hint)
        cat = hint_category(h, mapping)
        fail = F.concat(F.array(h, cat), confirmed)
        ok = F.concat(ans, F.array(h, F.nullif(cat, F.lit("unknown"))))
    else:
        on_fail, on_ok = K.GATE_VARIANTS[variant]
        fail = F.concat(F.array(*[F.lit(t) for t in on_fail]), confirmed)
        ok = F.concat(ans, F.array(*[F.lit(t) for t in on_ok]))
    tags = F.when(failed, fail).otherwise(ok)
    kept = F.filter(tags, lambda x: x.isNotNull() & (F.length(ptrim(x)) > 0))
    return F.array_sort(F.array_distinct(kept))


def answer_status(raw_text, landed_status=None) -> Column:
    """Status of a landed answer: missing / error / empty / unknown / ok."""
    low = F.lower(ptrim(_c(raw_text)))
    st = (F.when(_c(raw_text).isNull(), F.lit("missing"))
          .when(F.length(low) == 0, F.lit("empty"))
          .when(F.contains(low, F.lit(K.UNKNOWN_APPLICATION)), F.lit("unknown"))
          .otherwise(F.lit("ok")))
    if landed_status is not None:
        st = F.when(_c(landed_status) == "error", F.lit("error")).otherwise(st)
    return st


def annotate(df: DataFrame, answers: DataFrame, key: str = "row_id", answer_key: str = "key", landed_status: str | None = None,
             variant: str = "chembl", hint: str = K.CHEMBL_HINT, order=()) -> DataFrame:
    """Enrich each compound with its landed answer (``raw_text`` and, where
    given, the status it landed with); without one, the rule fallback (G11)
    stands in for the model; then the source's gate. A key answered more than
    once takes the last landed answer, by the columns of ``order``; without
    those, or on a tie, the greatest text, so that rows never multiply."""
    columns = ["raw_text"] + ([landed_status] if landed_status else [])
    joined = df.join(latest(answers.withColumnRenamed(answer_key, key), key, order, columns), key, "left")
    status = answer_status("raw_text", landed_status)
    answer = F.when(status == "missing", rule_tags("smiles", name="name", hint=F.lit(hint))).otherwise(parse_answer("raw_text"))
    joined = joined.select(*df.columns, status.alias("status"), answer.alias("_answer"))
    gate_status = F.when(F.col("status") == "missing", F.lit("ok")).otherwise(F.col("status"))
    return joined.withColumn("tags", gate_tags("_answer", gate_status, variant)).drop("_answer")


def exclude_seen(df: DataFrame, seen: DataFrame, key: str = "smiles", order=()) -> DataFrame:
    """C1 + E1: rows whose key was not collected before (left anti join), each
    key once: the first in ``order`` where that is given."""
    left = df.join(seen.select(key).distinct(), key, "left_anti")
    return dedupe_first(left, key, order) if order else left.dropDuplicates([key])
