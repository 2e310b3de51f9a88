"""Lookups, caps, samples, splits and batches.

Hash-based splits and samples use ``md5(seed:key)`` so membership is a pure
function of the key: reproducible across runs, engines and executor loss,
with no global sort except where an order is the feature.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retort import constants as K
from retort.operators.indexing import dense_index, running_total
from retort.functions.text import ptrim


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def lookup_reference(terms: DataFrame, refs: DataFrame, term_col: str = "term", name_col: str = "name",
                     value_col: str = "compound_id", order_col: str = "ordinal") -> DataFrame:
    """Each term's first reference (by ``order_col``) whose normalised
    name equals the normalised term; NULL when none. The reference side is
    reduced to one row per name before the join (partial aggregate)."""
    norm = lambda c: F.lower(ptrim(_c(c)))
    first = (refs.groupBy(norm(name_col).alias("_k"))
             .agg(F.min(F.struct(order_col, value_col))[value_col].alias(value_col)))
    return (terms.withColumn("_k", norm(term_col)).join(first, "_k", "left").drop("_k"))


def hash_bucket(key, seed: int = K.SPLIT_SEED, buckets: int = 10000) -> Column:
    """Deterministic bucket in [0, buckets) from md5('seed:key')."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), _c(key).cast("string")))
    return (F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint") % buckets)


def split(df: DataFrame, key: str, seed: int = K.SPLIT_SEED, test_fraction: float = K.SPLIT_TEST_FRACTION,
          col: str = "split") -> DataFrame:
    """Train / val / test; ``test_fraction`` is held out and halved."""
    b = hash_bucket(key, seed)
    train_cut = int(round((1 - test_fraction) * 10000))
    val_cut = train_cut + int(round(test_fraction * 10000 / 2))
    return df.withColumn(col, F.when(b < train_cut, F.lit("train"))
                         .when(b < val_cut, F.lit("val")).otherwise(F.lit("test")))


def split_counts(df: DataFrame, col: str = "split") -> DataFrame:
    """Rows per split."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def sample_n(df: DataFrame, n: int, key: str, seed: int = K.SPLIT_SEED) -> DataFrame:
    """E5: a fixed-size seeded sample when there are more than ``n`` rows
    (all rows otherwise): the ``n`` smallest ``md5(seed:key)``; a top-k,
    not a full sort."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    return df.withColumn("_h", h).orderBy("_h", key).limit(n).drop("_h")


def cap(df: DataFrame, key: str, order, per_key: int, total: int) -> DataFrame:
    """At most ``per_key`` rows per key (first in ``order``), then the
    first ``total`` rows over keys in key order (a null key comes first).

    ``row_number() <= per_key`` is planned as a WindowGroupLimit, which
    drops rows per key before and after the shuffle, so a hot key costs
    ``per_key`` rows per map task, not its full size. The overall target is
    an allowance a key: what the keys before it leave, from counts and a
    running total over keys. No task sees all rows, however large ``total``.
    """
    counts = df.groupBy(F.col(key).alias("_key")).agg(F.least(F.count(F.lit(1)), F.lit(per_key)).alias("_n"))
    left = running_total(counts, ["_key"], "_n", "_before").where(F.col("_before") < total)
    left = left.select("_key", F.least("_n", F.lit(total) - F.col("_before")).alias("_may"))
    w = Window.partitionBy(key).orderBy(*order)
    ranked = df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= per_key)
    return ranked.join(left, F.col(key).eqNullSafe(F.col("_key"))).where(F.col("_rn") <= F.col("_may")).drop("_rn", "_key", "_may")


def per_key_cap(n_keys: int, target: int) -> int:
    """Per-term allowance: max(5, target // terms + 5)."""
    return max(5, (target // n_keys if n_keys else target) + 5)


def assign_batches(df: DataFrame, key: str, size: int = K.BATCH_SIZE, seed: int | None = None,
                   col: str = "batch") -> DataFrame:
    """Consecutive batches of ``size`` rows; in key order (evaluation)
    or in a seeded hash order (training shuffle). The last batch may be
    short. Positions come from a distributed dense index."""
    if seed is None:
        order = [F.col(key)]
    else:
        df = df.withColumn("_h", F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))))
        order = [F.col("_h"), F.col(key)]
    out = dense_index(df, order, name="_idx")
    out = out.withColumn(col, (F.col("_idx") / size).cast("bigint")).drop("_idx")
    return out.drop("_h") if seed is not None else out


def latest(df: DataFrame, key: str, order=(), columns=None) -> DataFrame:
    """One row a key: the greatest in ``order`` (the last landed, say), ties by the other ``columns``, so the
    choice never depends on partitioning. One aggregate, partial in each task; nulls come first in order."""
    order = [order] if isinstance(order, str) else list(order)
    rest = [c for c in (columns or df.columns) if c != key and c not in order]
    if not order + rest:
        return df.select(key).distinct()
    best = df.groupBy(key).agg(F.max(F.struct(*order, *rest)).alias("_best"))
    return best.select(key, *[F.col("_best")[c].alias(c) for c in order + rest if c in (columns or df.columns)])


def with_labels(df: DataFrame, labels: DataFrame, key: str = "row_id", order=()) -> DataFrame:
    """Pair rows with their label vectors on a stable row key (never
    on position). A key labelled more than once takes its ``latest`` labels."""
    return df.join(latest(labels, key, order), key, "left")
