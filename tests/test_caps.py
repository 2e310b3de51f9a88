"""Caps over keys with an overall target."""

import random

import pytest
from pyspark.sql import functions as F

from retort.operators import indexing as I
from retort.operators import lookup as L


@pytest.mark.parametrize("per_key,total", [(3, 10), (5, 1), (2, 0), (1000, 130), (4, 10**9)])
def test_cap_matches_a_walk_over_keys(spark, per_key, total):
    rng = random.Random(per_key)
    rows = [(rng.choice([None, *"abcdefghij"]) if i % 3 else "hot", i, rng.random()) for i in range(400)]
    got = L.cap(spark.createDataFrame(rows, "key string, id long, v double").repartition(5), "key", ["v", "id"], per_key, total)
    want, left = [], total
    for k in sorted({r[0] for r in rows}, key=lambda k: (k is not None, k or "")):
        take = sorted((r for r in rows if r[0] == k), key=lambda r: (r[2], r[1]))[:min(per_key, left)]
        left -= len(take)
        want += take
    assert got.columns == ["key", "id", "v"] and sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_no_task_sees_all_rows(spark):
    df = spark.range(100000).select((F.col("id") % 977).alias("key"), "id")
    got = L.cap(df, "key", ["id"], 90, 10_000_000)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "GlobalLimit" not in plan and "TakeOrdered" not in plan
    assert got.count() == 977 * 90
    assert L.cap(df.limit(0), "key", ["id"], 3, 5).count() == 0


def test_running_total(spark):
    rng = random.Random(1)
    rows = [(i, rng.randrange(9)) for i in range(5000)]
    got = I.running_total(spark.createDataFrame(rows, "id long, n long").repartition(7), ["id"], "n").collect()
    want, total = {}, 0
    for i, n in rows:
        want[i], total = total, total + n
    assert {r.id: r.before for r in got} == want
