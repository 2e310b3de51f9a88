"""A seen-set across runs: no false drop, no reshuffle of what was seen."""

import random
import re

import pytest
from pyspark.sql import functions as F

from retort.operators.seen import SeenSet


def keys(df):
    return sorted(r.smiles for r in df.collect())


@pytest.mark.parametrize("expected", [20, 100_000])  # the first filter is far too small: many false hits
def test_runs_admit_each_key_once(spark, tmp_path, expected):
    rng, seen = random.Random(expected), set()
    s = SeenSet(spark, str(tmp_path), f"seen_{expected}", buckets=4, expected=expected)
    for run in range(4):
        offered = [(f"C{rng.randrange(4000)}", i) for i in range(1500)] + [(None, 1), ("", 2), ("é" * 50, 3)]
        df = spark.createDataFrame(offered, "smiles string, block int").repartition(3)
        got = s.admit(df, order=("block",))
        new = {k for k, _ in offered if k is not None} - seen
        assert keys(got) == sorted(new) and got.columns == ["smiles", "block"]
        first = {k: min(i for k2, i in offered if k2 == k) for k in new}
        assert {r.smiles: r.block for r in got.collect()} == first
        seen |= new
    assert s.admit(spark.createDataFrame([(k, 0) for k in seen], "smiles string, block int")).count() == 0
    assert s.admit(spark.createDataFrame([], "smiles string")).count() == 0
    again = SeenSet(spark, str(tmp_path), f"seen_{expected}_again", buckets=4, expected=expected)  # another session opens the path
    assert again.keys().count() == len(seen) and again.unseen(spark.createDataFrame([(k,) for k in seen] + [("new",)], "smiles string")).count() == 1
    for t in (s.name, again.name):
        spark.sql(f"DROP TABLE {t}")


def test_lost_runs_drop_nothing(spark, tmp_path):
    s = SeenSet(spark, str(tmp_path), "seen_lost", buckets=4, expected=1000)
    df = spark.createDataFrame([(f"C{i}",) for i in range(50)], "smiles string")
    bits = df.select(F.col("smiles").alias("key")).select(s._block().alias("block"), F.explode(s._places()).alias("p"))
    bits.groupBy("block").agg(F.bitmap_construct_agg("p").alias("bits")).write.parquet(s.bits_path)  # bits without keys
    assert s.unseen(df).count() == 50
    spark.sql("DROP TABLE seen_lost")


def test_filter_proves_most_new_keys_new(spark, tmp_path):
    s = SeenSet(spark, str(tmp_path), "seen_rate", buckets=4, expected=20000)
    s.add(spark.range(20000).select(F.concat(F.lit("A"), "id").alias("smiles")))
    tested = s.tested(spark.range(20000).select(F.concat(F.lit("B"), "id").alias("smiles")), "smiles")
    assert tested.where("_maybe").count() < 600
    assert s.tested(spark.range(20000).select(F.concat(F.lit("A"), "id").alias("smiles")), "smiles").where("not _maybe").count() == 0
    spark.sql("DROP TABLE seen_rate")


def test_the_seen_table_is_not_exchanged(spark, tmp_path):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        s = SeenSet(spark, str(tmp_path), "seen_plan", buckets=8)
        s.add(spark.range(100).select(F.col("id").cast("string").alias("smiles")))
        maybe = spark.range(50, 150).select(F.col("id").cast("string").alias("smiles"))
        joined = s._exact(maybe, "smiles")
        assert joined.count() == 50
        plan = joined._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].splitlines()
        scan = next(i for i, x in enumerate(plan) if "FileScan" in x and "Bucketed: true" in x)
        depth = lambda x: re.search(r"[A-Za-z]", x).start()
        above, at = [], depth(plan[scan])
        for x in reversed(plan[:scan]):
            if re.search("[A-Za-z]", x) and depth(x) < at:
                at = depth(x)
                above.append(x)
        join = next(i for i, x in enumerate(above) if "SortMergeJoin" in x)
        assert not any("Exchange" in x for x in above[:join]) and sum("Exchange" in x for x in plan) == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.sql("DROP TABLE seen_plan")
