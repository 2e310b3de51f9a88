"""A seen-set that lives across runs (C1): which keys were collected before, without rereading or reshuffling them.

The keys lie in a table bucketed by key. Beside it lies a Bloom filter in blocks: a key belongs to one block of 32,768
bits and sets a few of them. A run

1. joins its own new keys with the blocks: a key with an unset bit was never seen;
2. checks the others, the seen ones and a few false hits, by an exact anti join. The seen table is already
   partitioned by key, so only those hits are shuffled, to its buckets;
3. appends its new keys and the blocks' bits they set.

The bits are written before the keys. A run that is lost in between leaves bits without keys, which cost a look
into the table and drop nothing. All of it is Spark's own tables and aggregates.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from retort.operators.clean import dedupe_first
from retort.session import scratch_path

#: Bits of a block, as Spark's bitmap aggregates have them.
BLOCK_BITS = 32768
BITS = "block long, bits binary"


class SeenSet:
    """Keys collected so far, under ``path`` (shared storage), opened as table ``name`` of this session.

    ``expected`` keys and ``bits`` a key size the filter, ``buckets`` the table; all three belong to the path and
    must be given alike by every run. More keys than expected cost false hits, never a wrong answer."""

    def __init__(self, spark: SparkSession, path: str, name: str, buckets: int = 64, expected: int = 10_000_000, bits: int = 12, probes: int = 4):
        self.spark, self.name, self.buckets, self.probes = spark, name, buckets, probes
        self.blocks = max(1, math.ceil(expected * bits / BLOCK_BITS))
        self.bits_path = f"{path}/bits-{self.blocks}-{probes}"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} (key STRING) USING parquet CLUSTERED BY (key) INTO {buckets} BUCKETS LOCATION '{path}/keys-{buckets}'")

    def _block(self) -> Column:
        return F.pmod(F.xxhash64("key"), F.lit(self.blocks))

    def _places(self) -> Column:
        """The key's bits within its block."""
        return F.array(*[F.pmod(F.xxhash64("key", F.lit(i + 1)), F.lit(BLOCK_BITS)) for i in range(self.probes)])

    def filter(self) -> DataFrame:
        """(block, bits) of all runs so far."""
        try:
            rows = self.spark.read.schema(BITS).parquet(self.bits_path)
        except AnalysisException:  # no run yet
            rows = self.spark.createDataFrame([], BITS)
        return rows.groupBy("block").agg(F.bitmap_or_agg("bits").alias("bits"))

    def keys(self) -> DataFrame:
        return self.spark.table(self.name)

    def tested(self, rows: DataFrame, key: str) -> DataFrame:
        """``rows`` with ``_maybe``: false where the filter proves the key new."""
        holds = F.expr(f"forall(places, p -> (cast(conv(hex(substring(bits, cast(p div 8 as int) + 1, 1)), 16, 10) as int) "
                       f">> cast(p % 8 as int)) & 1 = 1)")
        asked = rows.select(F.col(key).alias("key"), F.struct(*rows.columns).alias("row")).withColumn("block", self._block()).withColumn("places", self._places())
        known = asked.join(self.filter(), "block", "left")
        return known.select("row.*", F.coalesce(holds, F.lit(False)).alias("_maybe"))

    def unseen(self, df: DataFrame, key: str = "smiles", order=()) -> DataFrame:
        """Rows whose key no earlier run had, each key once: the first in ``order`` where that is given. Rows
        with a null key are left out."""
        rows = df.where(F.col(key).isNotNull())
        rows = dedupe_first(rows, key, order) if order else rows.dropDuplicates([key])
        path = scratch_path(self.spark, "seen-tested")
        self.tested(rows, key).write.parquet(path)
        tested = self.spark.read.parquet(path)
        new = tested.where("not _maybe").drop("_maybe")
        return new.unionByName(self._exact(tested.where("_maybe").drop("_maybe"), key))

    def _exact(self, maybe: DataFrame, key: str) -> DataFrame:
        seen = self.keys().select(F.col("key").alias("_seen"))
        return maybe.join(seen, maybe[key] == seen["_seen"], "left_anti")

    def add(self, rows: DataFrame, key: str = "smiles") -> None:
        """Record the keys of ``rows``, new ones each once."""
        keys = rows.select(F.col(key).alias("key")).repartition(self.buckets, "key")  # a file a bucket
        bits = keys.select(self._block().alias("block"), F.explode(self._places()).alias("p"))
        bits.groupBy("block").agg(F.bitmap_construct_agg("p").alias("bits")).write.mode("append").parquet(self.bits_path)
        keys.write.insertInto(self.name)

    def admit(self, df: DataFrame, key: str = "smiles", order=()) -> DataFrame:
        """``unseen`` rows, written once and recorded: the next run will not see them again."""
        path = scratch_path(self.spark, "seen-admitted")
        self.unseen(df, key, order).write.parquet(path)
        new = self.spark.read.parquet(path)
        self.add(new, key)
        return new
