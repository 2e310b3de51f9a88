"""Graph layers over one bucketed adjacency."""

import re

import numpy as np
import pytest

from retort.operators import vectors as V


def brute(n, edges, x, layers):
    a = np.eye(n)
    for s, d in edges:
        if s != d:
            a[s, d] = a[d, s] = 1
    scale = 1 / np.sqrt(a.sum(axis=1))
    a = scale[:, None] * a * scale[None, :]
    for _ in range(layers):
        x = np.maximum(a @ x, 0)
    return x


@pytest.mark.parametrize("hub", [V.HUB_EDGES, 7])
def test_layers_with_a_hub(spark, hub):
    rng = np.random.default_rng(6)
    n = 90
    edges = [(0, i) for i in range(1, 70)] + rng.integers(0, n, (60, 2)).tolist() + [(5, 5), (3, 0)]
    x = rng.normal(size=(n, 3))
    nodes = spark.createDataFrame([(i, k, float(x[i, k])) for i in range(n) for k in range(3)], "node long, dim int, value double")
    e = spark.createDataFrame([tuple(map(int, p)) for p in edges], "src long, dst long")
    got = np.zeros((n, 3))
    for r in V.gcn_propagate(nodes, e, layers=3, hub=hub).collect():
        got[r.node, r.dim] = r.value
    assert np.abs(got - brute(n, edges, x, 3)).max() < 1e-9
    adj, hubs = V.normalized_adjacency(nodes, e, hub=hub)
    most = adj.groupBy("src", "share").count().agg({"count": "max"}).first()[0]
    assert (most < 30 and hubs.count() >= 1) if hub == 7 else (most >= 70 and hubs.count() == 0)


def test_layers_do_not_exchange_the_edges(spark):
    nodes = spark.range(40).selectExpr("id as node", "0 as dim", "double(id) as value")
    e = spark.range(40).selectExpr("id as src", "(id * 7 + 1) % 40 as dst")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = V.gcn_propagate(nodes, e, layers=3)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    lines = plan.split("\n")
    depth = [re.search(r"[A-Za-z]", x).start() if x.strip() else 0 for x in lines]
    scans = [i for i, x in enumerate(lines) if "FileScan" in x and "Bucketed: true" in x]
    assert len(scans) == 3
    for i in scans:
        above, at = [], i
        while "Join" not in lines[at]:
            at = next(k for k in range(at - 1, -1, -1) if depth[k] < depth[at])
            above.append(lines[at])
        assert not any("Exchange" in x for x in above), above
