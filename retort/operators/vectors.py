"""Vector jobs: softmax routing, top-k gates, load balance, expert
recombination, linear scoring, pooling, graph convolution, BCE loss
(E8, E9, E11, D8-D11, I1).

Per-token quantities (softmax, top-k) live in one row per token as arrays,
so they are computed in place without a shuffle. What a lambda names is bound
first: a lambda works out an outer expression anew for each element. Quantities that combine
rows (pooling, load, propagation, loss) are group-bys with partial
aggregation. A weight table is reduced to one array by a scalar subquery
(a model's matrix: parameters, not data).
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retort import constants as K
from retort.functions.text import bind
from retort.session import ensure_checkpoint_dir, scratch_path

#: Edges of one vertex that a share of it holds.
HUB_EDGES = 1 << 16


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def softmax_array(logits) -> Column:
    """E8 on one token's logits: exp(x - max) / sum(exp(x - max))."""
    def exps(x: Column) -> Column:
        return bind(F.array_max(x), lambda m: F.transform(x, lambda v: F.exp(v - m)))

    def shares(e: Column) -> Column:
        return bind(F.aggregate(e, F.lit(0.0), lambda acc, v: acc + v), lambda s: F.transform(e, lambda v: v / s))

    return bind(bind(F.transform(_c(logits), lambda v: v.cast("double")), exps), shares)


def softmax(df: DataFrame, group: str, logit: str, out: str = "prob") -> DataFrame:
    """E8 on long-form logits ``(group, ..., logit)``: softmax within group."""
    w = Window.partitionBy(group)
    m = F.max(logit).over(w)
    e = F.exp(F.col(logit) - m)
    return df.withColumn(out, e / F.sum(e).over(w))


def top_k_gate(probs, k: int = K.TOP_K, eps: float = K.GATE_EPS) -> Column:
    """The k largest probabilities (ties: lower expert id) with weights
    p / (sum of the kept p + eps); array of (expert_id, prob, weight)."""
    items = F.transform(_c(probs), lambda v, i: F.struct((-v).alias("neg"), i.alias("expert_id"), v.alias("prob")))

    def weighted(kept: Column) -> Column:
        total = F.aggregate(kept, F.lit(0.0), lambda acc, s: acc + s["prob"]) + F.lit(eps)
        return bind(total, lambda t: F.transform(kept, lambda s: F.struct(
            s["expert_id"].alias("expert_id"), s["prob"].alias("prob"), (s["prob"] / t).alias("weight"))))

    return bind(F.slice(F.array_sort(items), 1, k), weighted)


def routing_load(routes: DataFrame, n_experts: int = K.NUM_EXPERTS, coeff: float = K.LOAD_BALANCE_COEFF,
                 token: str = "token_id", probs: str = "probs", gates: str = "gates") -> DataFrame:
    """D10 per expert: f_i = selections / tokens, p_i = mean probability.

    ``routes`` has one row per token with ``probs`` (array) and ``gates``
    (top-k array). Returns (expert_id, f_i, p_i, term = coeff * E * f_i * p_i).
    """
    sel = bind(_c(gates), lambda gs: F.transform(F.sequence(F.lit(0), F.lit(n_experts - 1)),
                                                 lambda e: F.size(F.filter(gs, lambda g: g["expert_id"] == e)).cast("double")))
    per = routes.select(F.posexplode(F.arrays_zip(sel.alias("s"), _c(probs).alias("p"))).alias("expert_id", "z"))
    agg = per.groupBy("expert_id").agg(F.avg("z.s").alias("f_i"), F.avg("z.p").alias("p_i"))
    return agg.withColumn("term", F.lit(coeff * n_experts) * F.col("f_i") * F.col("p_i"))


def routing_loss(loads: DataFrame, layer: str | None = None) -> DataFrame:
    """Balance loss = sum of the per-expert terms (over layers too)."""
    return loads.agg(F.sum("term").alias("routing_loss"))


def combine(routes: DataFrame, outputs: DataFrame, token: str = "token_id") -> DataFrame:
    """Sum over each token's chosen experts of weight * expert output.

    ``routes``: (token, gates array of (expert_id, weight)); ``outputs``:
    long (token, expert_id, dim, value). Joined on (token, expert_id),
    summed per (token, dim) with partial aggregation.
    """
    chosen = routes.select(token, F.explode(_c("gates")).alias("g")) \
        .select(token, F.col("g.expert_id").alias("expert_id"), F.col("g.weight").alias("weight"))
    j = chosen.join(outputs, [token, "expert_id"])
    return j.groupBy(token, "dim").agg(F.sum(F.col("weight") * F.col("value")).alias("value"))


def with_weights(df: DataFrame, W: DataFrame, name: str = "weights") -> DataFrame:
    """Add a weight table ``(k, w, b)`` as one array of structs by ``k``: a scalar subquery, so the table is
    worked out inside the query and no value passes through the driver's code."""
    rows = W.agg(F.array_sort(F.collect_list(F.struct("k", "w", "b"))).alias("rows")).scalar()
    return df.select("*", rows.alias(name))


def linear(x, rows) -> Column:
    """Scores x . w_k + b_k for each weight row, as an array in order of ``k``. ``rows`` is an array of
    structs (k, w, b), as ``with_weights`` adds it."""
    return bind(F.transform(_c(x), lambda v: v.cast("double")), lambda xv: F.transform(
        _c(rows), lambda r: F.aggregate(F.zip_with(xv, r["w"], lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v) + r["b"]))


def mean_pool(nodes: DataFrame, graph: str, vec: str) -> DataFrame:
    """Mean node vector per graph, long form (graph, dim, value)."""
    long = nodes.select(graph, F.posexplode(vec).alias("dim", "v"))
    return long.groupBy(graph, "dim").agg(F.avg(F.col("v").cast("double")).alias("value"))


def centroid_weights(df: DataFrame, label: str, vec: str) -> DataFrame:
    """Per-label centroid c as weights (w = c, b = -|c|^2 / 2): the linear
    form of a nearest-centroid classifier."""
    pooled = mean_pool(df, label, vec)
    per = pooled.groupBy(label).agg(F.array_sort(F.collect_list(F.struct("dim", "value"))).alias("_v"))
    w = F.transform("_v", lambda s: s["value"])
    b = F.aggregate(w, F.lit(0.0), lambda acc, v: acc + v * v) * F.lit(-0.5)
    return per.select(F.col(label).alias("k"), w.alias("w"), b.alias("b"))


def normalized_adjacency(nodes: DataFrame, edges: DataFrame, node: str = "node", hub: int = HUB_EDGES) -> tuple[DataFrame, DataFrame]:
    """(adjacency, hubs) of D^-1/2 (A + I) D^-1/2, written once as a table bucketed by source vertex.

    adjacency: (src, share, dst, norm). A vertex with more than ``hub`` edges is a hub and its edges are dealt
    to several shares, so none is one task's; hubs: (src, shares), one row for ``hub`` edges at most."""
    spark = nodes.sparkSession
    ensure_checkpoint_dir(spark)
    e = edges.select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")) \
        .where(F.col("a") != F.col("b")).distinct()
    both = e.select(F.col("a").alias("src"), F.col("b").alias("dst")) \
        .unionByName(e.select(F.col("b").alias("src"), F.col("a").alias("dst")))
    ids = nodes.select(F.col(node).alias("src")).distinct()
    adj = both.unionByName(ids.select("src", F.col("src").alias("dst")))
    deg = adj.groupBy("dst").agg(F.count(F.lit(1)).alias("deg"))
    shares = F.ceil(F.col("ds") / hub)
    adj = (adj.join(deg.withColumnRenamed("dst", "src").withColumnRenamed("deg", "ds"), "src")
           .join(deg.withColumnRenamed("deg", "dd"), "dst")
           .select("src", F.pmod(F.xxhash64("dst"), shares).cast("int").alias("share"), "dst",
                   (F.lit(1.0) / F.sqrt(F.col("ds") * F.col("dd"))).alias("norm")))
    # bucketed by what the layers join on: they move the values to the edges, not the edges
    buckets, path = int(spark.conf.get("spark.sql.shuffle.partitions")), scratch_path(spark, "adjacency")
    table = re.sub(r"\W", "_", path.rsplit("/", 1)[-1]) + f"_{uuid.uuid4().hex[:12]}"
    adj.repartition(buckets, "src", "share").write.bucketBy(buckets, "src", "share").format("parquet").option("path", path).saveAsTable(table)
    adj = spark.table(table)
    hubs = deg.where(F.col("deg") > hub).select(F.col("dst").alias("src"), F.ceil(F.col("deg") / hub).cast("int").alias("shares"))
    return adj, hubs.checkpoint(eager=True)


def gcn_propagate(nodes: DataFrame, edges: DataFrame, layers: int = 2, node: str = "node",
                  weights=None, hub: int = HUB_EDGES) -> DataFrame:
    """H <- ReLU(D^-1/2 (A + I) D^-1/2 h W), ``layers`` times.

    ``nodes``: long (node, dim, value); ``edges``: (src, dst) undirected
    pairs, either direction, duplicates and self pairs ignored. ``weights``
    (optional) is a small long table (dim_in, dim_out, w); identity when
    None. The edges are exchanged once for any number of layers; a layer
    moves the values to them and aggregates the messages partially.
    """
    adj, hubs = normalized_adjacency(nodes, edges, node, hub)
    h = nodes.select(F.col(node).alias("src"), "dim", F.col("value").cast("double").alias("value"))
    for _ in range(layers):
        if weights is not None:
            h = (h.join(weights.withColumnRenamed("dim_in", "dim"), "dim")
                 .groupBy("src", "dim_out").agg(F.sum(F.col("value") * F.col("w")).alias("value"))
                 .withColumnRenamed("dim_out", "dim"))
        dealt = h.join(hubs, "src", "left").select(
            "src", F.explode(F.sequence(F.lit(0), F.coalesce("shares", F.lit(1)) - 1)).alias("share"), "dim", "value")
        msg = adj.join(dealt, ["src", "share"]).groupBy("dst", "dim").agg(F.sum(F.col("norm") * F.col("value")).alias("value"))
        h = msg.select(F.col("dst").alias("src"), "dim", F.greatest(F.col("value"), F.lit(0.0)).alias("value"))
    return h.withColumnRenamed("src", node)


def bce_with_logits(z: Column, y: Column) -> Column:
    """Numerically stable BCE-with-logits per cell."""
    return F.greatest(z, F.lit(0.0)) - z * y + F.log1p(F.exp(-F.abs(z)))


def bce_loss(cells: DataFrame, batch: str = "batch", z: str = "z", y: str = "y") -> DataFrame:
    """Mean over each batch's (row, label) cells, then the unweighted
    mean over batches (a short last batch counts as one batch)."""
    per = cells.groupBy(batch).agg(F.avg(bce_with_logits(F.col(z), F.col(y))).alias("batch_loss"))
    return per.agg(F.count(F.lit(1)).alias("n_batches"), F.avg("batch_loss").alias("loss"))
