"""Cleaning, deduplication and reporting."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from retort.functions.smiles import valid_smiles
from retort.functions.text import clean_tags
from retort.operators.indexing import dense_index


def require_columns(df: DataFrame, cols) -> DataFrame:
    """B1: keep only ``cols``; raise if one is missing."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df.select(*cols)


def drop_missing(df: DataFrame, cols, blank: bool = True) -> DataFrame:
    """B2: drop rows with NULL (and, with ``blank``, empty-string) fields."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
        if blank and dict(df.dtypes)[c] == "string":
            cond = cond & (F.length(F.col(c)) > 0)
    return df.where(cond)


def union_sources(dfs) -> DataFrame:
    """UNION ALL by name; columns a source lacks become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def dedupe_first(df: DataFrame, key: str = "smiles", order=("source_rank", "ordinal")) -> DataFrame:
    """One row per ``key``: the first in ``order`` (keep='first').

    Written as ``min(struct(order..., row))`` per key rather than a
    ``row_number`` window: the aggregate is partial (map-side), so a key
    holding a third of all rows is reduced inside each map task before the
    shuffle instead of landing whole in one window task.
    """
    return df.groupBy(key).agg(_first_row(df, key, order).alias("_first")).select(*_row_columns(df, key))


def _first_row(df: DataFrame, key: str, order) -> Column:
    payload = [c for c in df.columns if c != key and c not in order]
    return F.min(F.struct(*order, *payload))


def _row_columns(df: DataFrame, key: str) -> list[Column]:
    return [F.col(c) if c == key else F.col("_first")[c].alias(c) for c in df.columns]


def with_clean_tags(df: DataFrame, col: str = "applications") -> DataFrame:
    """G2 applied to a frame's tag column."""
    return df.withColumn(col, clean_tags(col))


def clean_compounds(df: DataFrame) -> DataFrame:
    """Source filter (no falsy SMILES), keep-first dedupe, tag cleaning."""
    return with_clean_tags(dedupe_first(drop_missing(df, ["smiles"])))


def count_by_source(df: DataFrame) -> DataFrame:
    """Rows per source."""
    return df.groupBy("source").agg(F.count(F.lit(1)).alias("n"))


def top_tags(df: DataFrame, n: int = 10, col: str = "applications") -> DataFrame:
    """The ``n`` most frequent tags; ties broken by tag (code point)."""
    tags = df.select(F.explode(col).alias("tag")).where(F.length("tag") > 0)
    counts = tags.groupBy("tag").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), F.asc("tag")).limit(n)


def avg_tags(df: DataFrame, col: str = "applications") -> DataFrame:
    """D3: mean tag count per compound, empty lists counted as 0."""
    size = F.size(F.coalesce(F.col(col), F.array().cast("array<string>")))
    return df.agg(F.round(F.avg(size.cast("double")), 6).alias("avg_tags"))


def profile_stages(df: DataFrame, key: str = "smiles") -> DataFrame:
    """Raw, after null/empty drop, after dedupe, invalid, final counts.

    A partial aggregate per key (one shuffle, map-side combined), then a
    global aggregate over the keys; validity is evaluated once per key.
    """
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_c"))
    present = F.col(key).isNotNull() & (F.length(key) > 0)
    return per_key.agg(
        F.sum("_c").alias("raw"),
        F.coalesce(F.sum(F.when(present, F.col("_c"))), F.lit(0)).alias("non_null"),
        F.count_if(present).alias("deduped"),
        F.count_if(present & ~valid_smiles(F.col(key))).alias("invalid"),
    ).select("raw", "non_null", "deduped", "invalid",
             (F.col("deduped") - F.col("invalid")).alias("final"))


def write_profiled(df: DataFrame, path: str, key: str = "smiles", order=("source_rank", "ordinal")) -> DataFrame:
    """D4 with the write: the deduplicated, valid rows go to ``path`` as Parquet, and the stage counters of
    ``profile_stages`` are observed on that same job, so no scan or job is made for them.

    The aggregate that keeps each key's first row also counts its rows, and all counters are observed
    behind it, in the stage that writes. There a task's counts are taken once; in a stage before a
    shuffle, the tasks that run again after an executor was lost would count twice. Null and empty keys are counted in ``raw`` only
    and not written; an empty frame writes no row and counts zeros. ``path`` must not exist. Returns one row: raw,
    non_null, deduped, invalid, final (all long). Columns called ``_first``, ``_rows`` or ``_valid`` in ``df`` are kept."""
    spark = df.sparkSession
    present = F.col(key).isNotNull() & (F.length(key) > 0)
    keyed = (df.groupBy(key).agg(_first_row(df, key, order).alias("_first"), F.count(F.lit(1)).alias("_rows"))
             .withColumn("_valid", present & valid_smiles(F.col(key))))
    seen = Observation()
    n = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    keyed = keyed.observe(seen, n(F.col("_rows")).alias("raw"), n(F.when(present, F.col("_rows"))).alias("non_null"),
                          F.count_if(present).alias("deduped"), F.count_if(present & ~F.col("_valid")).alias("invalid"))
    keyed.where("_valid").select(*_row_columns(df, key)).write.option("compression", "zstd").parquet(path)
    got = seen.get
    row = [got[c] for c in ("raw", "non_null", "deduped", "invalid")]
    return spark.createDataFrame([(*row, row[2] - row[3])], "raw long, non_null long, deduped long, invalid long, final long")


def label_classes(df: DataFrame, col: str = "applications") -> DataFrame:
    """Distinct labels in code-point order with a dense 0-based id."""
    labels = df.select(F.explode(col).alias("label")).distinct()
    return dense_index(labels, [F.col("label")], name="label_id").select("label_id", "label")


def multi_hot(df: DataFrame, classes: DataFrame, key: str = "row_id", col: str = "applications") -> DataFrame:
    """D7 (long form): one ``(key, label_id)`` row per set bit.

    A dense 0/1 vector per row does not scale with the number of classes;
    the long form is the sparse matrix. ``classes`` is joined by label (a
    shuffle join; Spark broadcasts it when its size is small).
    """
    hot = df.select(key, F.explode(F.array_distinct(col)).alias("label"))
    return hot.join(classes, "label").select(key, "label_id")


def multi_hot_rows(df: DataFrame, classes: DataFrame, key: str = "row_id", col: str = "applications",
                   width: int = 1 << 20) -> DataFrame:
    """D7 (wide form): each row's 0/1 vector over all classes as the ascending places of its ones,
    ``(key, segment, hot)``. A segment covers ``width`` classes and counts its places from its own start,
    so a vector has an int index for any number of classes; a row always has segment 0, empty if the row
    has no label. Rows with one key are one vector."""
    bits = multi_hot(df, classes, key, col).select(
        key, F.floor(F.col("label_id") / width).cast("int").alias("segment"), (F.col("label_id") % width).cast("int").alias("place"))
    every = df.select(key, F.lit(0).alias("segment"), F.lit(None).cast("int").alias("place"))
    return bits.unionByName(every).groupBy(key, "segment").agg(F.sort_array(F.collect_set("place")).alias("hot"))
