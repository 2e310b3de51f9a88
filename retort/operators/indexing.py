"""Distributed dense row numbering (zipWithIndex on DataFrames).

A global ``row_number()`` without ``partitionBy`` moves every row into one
task. Instead: range-sort, count rows per partition, turn the (tiny,
one-row-per-partition) counts into offsets, and add each row's position
inside its partition. The sorted, id-tagged frame is checkpointed to the
shared checkpoint folder first so both uses see the same partitioning, and
a lost executor recomputes from the checkpoint, not from a re-sampled sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retort.session import ensure_checkpoint_dir


def dense_index(df: DataFrame, order_cols, name: str = "idx", start: int = 0) -> DataFrame:
    """Add ``name`` = 0-based (plus ``start``) position in ``order_cols`` order.

    ``order_cols`` must give a total order for the numbering to be
    deterministic.
    """
    ensure_checkpoint_dir(df.sparkSession)
    tagged = (df.orderBy(*order_cols)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_mid", F.monotonically_increasing_id())
              .checkpoint(eager=True))
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition: a bounded broadcast
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    pos = F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), 33)
    return (tagged.join(F.broadcast(offsets), "_pid")
            .withColumn(name, F.col("_off") + pos + F.lit(start))
            .drop("_pid", "_mid", "_off"))


def running_total(df: DataFrame, order_cols, value: str, name: str = "before") -> DataFrame:
    """Add ``name`` = the sum of ``value`` over all rows before this one in ``order_cols`` order, a total order. Like
    ``dense_index`` without a global window: sums for each range of the sorted rows, then within the range."""
    ensure_checkpoint_dir(df.sparkSession)
    tagged = df.orderBy(*order_cols).withColumn("_pid", F.spark_partition_id()).checkpoint(eager=True)
    sums = tagged.groupBy("_pid").agg(F.sum(value).alias("_sum"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition: a bounded broadcast
    offsets = sums.select("_pid", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_off"))
    own = Window.partitionBy("_pid").orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, -1)
    return (tagged.withColumn("_own", F.coalesce(F.sum(value).over(own), F.lit(0)))
            .join(F.broadcast(offsets), "_pid").withColumn(name, F.col("_off") + F.col("_own")).drop("_pid", "_own", "_off"))
