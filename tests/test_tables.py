"""Keyword tables of any size, repeated answers and labels, routing expressions."""

import math
import random
import string
import time

import pytest
from pyspark.sql import functions as F

from retort import constants as K
from retort.operators import lookup as L
from retort.operators import tags as G
from retort.operators import vectors as V

KEYWORDS = "cat_rank int, category string, keyword string"


def brute(hint, dim):
    if not hint:
        return "unknown", []
    hits = sorted({(r, c) for r, c, k in dim if k and k.lower() in hint.lower()})
    return (hits[0][1] if hits else "unknown"), [c for _, c in hits]


def categories(spark, hints, dim):
    df = spark.createDataFrame(list(enumerate(hints)), "row_id long, hint string")
    out = G.categories_by_join(df, "row_id", "hint", spark.createDataFrame(dim, KEYWORDS))
    return {r.row_id: (r.first_category, r.categories) for r in out.collect()}


def test_a_hundred_thousand_keywords(spark):
    rng = random.Random(3)
    syllables = ["".join(rng.choice(string.ascii_lowercase) for _ in range(3)) for _ in range(60)]
    dim = [(i % 40, f"c{i % 40}", "".join(rng.choices(syllables, k=rng.randint(2, 4)))) for i in range(100000)]
    hints = ["".join(rng.choices(syllables, k=rng.randint(1, 12))).upper() for _ in range(150)] + [None, ""]
    spark.createDataFrame(dim[:1], KEYWORDS).count()
    start = time.time()
    got = categories(spark, hints, dim)
    assert time.time() - start < 60
    assert got == {i: brute(h, dim) for i, h in enumerate(hints)}


@pytest.mark.parametrize("broadcast", ["-1", "10m"])
def test_short_odd_and_repeated_keywords(spark, broadcast):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        dim = [(2, "b", "a"), (1, "a", "AB"), (1, "a", "ab"), (0, "z", "aaa"), (3, "c", "\U0001f600é"), (3, "c", "x.y*"), (4, "d", ""), (5, "e", "aaaa"), (6, "f", "aab")]
        hints = ["aaa", "ab", "b", "xaab \U0001f600É", "x.y*", "xzyy", "", None, "aaaab", "A", "\U0001f600é" * 3000]
        assert categories(spark, hints, dim) == {i: brute(h, dim) for i, h in enumerate(hints)}
        assert categories(spark, hints, []) == {i: ("unknown", []) for i in range(len(hints))} if broadcast == "-1" else True
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_a_small_index_is_not_shuffled_by_gram(spark):
    df = spark.createDataFrame([(1, "some hint")], "row_id long, hint string")
    out = G.categories_by_join(df, "row_id", "hint", spark.createDataFrame([(0, "a", "hint")], KEYWORDS))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(anchor" not in plan


def test_repeated_answers_do_not_multiply_rows(spark):
    df = spark.createDataFrame([(1, "CCO", "n"), (2, "CC", "m")], "row_id long, smiles string, name string")
    answers = spark.createDataFrame([(1, "old use", 1), (1, "new use", 2), (1, None, 0), (3, "x", 1)], "key long, raw_text string, landed_at int")
    out = {r.row_id: r for r in G.annotate(df, answers, order="landed_at").collect()}
    assert len(out) == 2 and "new use" in out[1].tags and "old use" not in out[1].tags
    unordered = G.annotate(df, answers.drop("landed_at"))
    assert unordered.count() == 2 and "old use" in {r.row_id: r for r in unordered.collect()}[1].tags
    labels = spark.createDataFrame([(1, [0, 1], 1), (1, [1, 0], 2), (1, [1, 1], None)], "row_id long, labels array<int>, at int")
    assert [(r.row_id, r.labels) for r in L.with_labels(df, labels, order="at").orderBy("row_id").collect()] == [(1, [1, 0]), (2, None)]


def test_gates_grow_in_line_with_experts(spark):
    """Nothing is worked out again for each expert: 64 experts cost a row what 64 numbers cost."""
    x = [math.sin(i) for i in range(64)]
    df = spark.createDataFrame([(i, [v + i for v in x]) for i in range(200)], "token_id int, logits array<double>")
    routes = df.select("token_id", V.softmax_array("logits").alias("probs")).withColumn("gates", V.top_k_gate("probs", k=3))
    start = time.time()
    loads = V.routing_load(routes, n_experts=64).collect()
    assert time.time() - start < 30
    top = sorted(range(64), key=lambda i: -x[i])[:3]
    assert sorted(r.expert_id for r in loads if r.f_i == 1) == sorted(top) and sum(r.f_i for r in loads) == 3
    e = [math.exp(v) for v in x]
    r = routes.first()
    assert r.probs == pytest.approx([v / sum(e) for v in e]) and [g.expert_id for g in r.gates] == top
    kept = sum(g.prob for g in r.gates)
    assert [g.weight for g in r.gates] == pytest.approx([g.prob / (kept + K.GATE_EPS) for g in r.gates])
    assert routes.where(F.size("gates") != 3).count() == 0
