"""Queries: routing, gates, load balance, expert recombination, linear
scores, pooling, graph convolution, BCE loss on ``embeddings`` / ``labels``
(E8, E9, E11, D8-D11, I1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from retort import constants as K
from retort.operators import lookup as L
from retort.operators import vectors as V
from retort.plans.catalog import register
from retort.session import read_table

E = K.NUM_EXPERTS
OUT_DIM = 16     # expert e's output: components 16e .. 16e+15
NODE_DIM = 64    # node features for the graph convolution
SCALE = 10.0     # logit scale of the scored components


def _weights(emb, layer: int = 0):
    """Router of a layer: one weight row for each expert, over the whole vector."""
    return V.centroid_weights(emb.select((F.floor(F.col("vec_id") / E**layer) % E).cast("int").alias("k"), "embedding"), "k", "embedding")


def _routes(spark, sf, layer: int = 0):
    emb = read_table(spark, sf, "embeddings")
    emb = V.with_weights(emb, _weights(emb, layer))
    probs = V.softmax_array(F.transform(V.linear("embedding", "weights"), lambda v: v * SCALE))
    return emb.select(F.col("vec_id").alias("token_id"), probs.alias("probs")) \
        .withColumn("gates", V.top_k_gate("probs"))


def _linear_sql(key: str, name: str = "") -> str:
    """CTEs cent, wb and scored(vec_id, k, score) of a nearest-centroid linear form by ``key``."""
    return f"""cent{name} AS (
  SELECT k, list(value ORDER BY i) AS w
  FROM (SELECT {key} AS k, i, avg(CAST(embedding[i] AS DOUBLE)) AS value
        FROM (SELECT *, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings) GROUP BY k, i)
  GROUP BY k),
wb{name} AS (SELECT k, w, -0.5 * list_sum(list_transform(w, lambda v: v * v)) AS b FROM cent{name}),
scored{name} AS (SELECT e.vec_id, wb{name}.k AS k,
       list_sum(list_transform(range(1, len(wb{name}.w) + 1), lambda i: CAST(e.embedding[i] AS DOUBLE) * wb{name}.w[i])) + wb{name}.b AS score
FROM embeddings e, wb{name})"""


PROBS_SQL = f"""logits AS (SELECT vec_id, list(score * {SCALE} ORDER BY k) AS x FROM scored GROUP BY vec_id),
ex AS (SELECT vec_id, list_transform(x, lambda v: exp(v - list_max(x))) AS e FROM logits),
probs AS (SELECT vec_id, CAST(i - 1 AS INTEGER) AS expert_id, e[i] / list_sum(e) AS prob
          FROM (SELECT vec_id, e, unnest(range(1, len(e) + 1)) AS i FROM ex)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY prob DESC, expert_id) AS rn FROM probs),
gates AS (SELECT vec_id, expert_id, CAST(rn - 1 AS INTEGER) AS rank, prob,
                 prob / (sum(prob) OVER (PARTITION BY vec_id) + {K.GATE_EPS}) AS weight
          FROM ranked WHERE rn <= {K.TOP_K})"""


def _probs_sql(layer: int = 0, name: str = "") -> str:
    return _linear_sql(f"CAST((vec_id // {E**layer}) % {E} AS INTEGER)", name) + ",\n" + PROBS_SQL.replace("FROM scored", f"FROM scored{name}")


@register("softmax", "WITH " + _probs_sql() + """
SELECT vec_id, expert_id, round(prob, 6) AS prob FROM probs""")
def q_softmax(spark, sf):
    r = _routes(spark, sf)
    return r.select(F.col("token_id").alias("vec_id"), F.posexplode("probs").alias("expert_id", "p")) \
        .select("vec_id", "expert_id", F.round("p", 6).alias("prob"))


@register("top_k_gate", "WITH " + _probs_sql() + """
SELECT vec_id, rank, expert_id, round(weight, 6) AS weight FROM gates""")
def q_top_k_gate(spark, sf):
    r = _routes(spark, sf)
    return r.select(F.col("token_id").alias("vec_id"), F.posexplode("gates").alias("rank", "g")) \
        .select("vec_id", "rank", F.col("g.expert_id").alias("expert_id"), F.round("g.weight", 6).alias("weight"))


@register("routing_load", "WITH " + _probs_sql() + f"""
SELECT expert_id, round(f_i, 6) AS f_i, round(p_i, 6) AS p_i, round({K.LOAD_BALANCE_COEFF * E} * f_i * p_i, 6) AS term
FROM (SELECT expert_id, count(*) FILTER (WHERE rn <= {K.TOP_K}) / count(*) AS f_i, avg(prob) AS p_i
      FROM ranked GROUP BY expert_id)""")
def q_routing_load(spark, sf):
    loads = V.routing_load(_routes(spark, sf))
    return loads.select("expert_id", *[F.round(c, 6).alias(c) for c in ("f_i", "p_i", "term")])


@register("routing_loss", "WITH " + ",\n".join(
    _probs_sql(layer, str(layer)).replace("logits AS", f"logits{layer} AS").replace("FROM logits", f"FROM logits{layer}")
    .replace("ex AS", f"ex{layer} AS").replace("FROM ex", f"FROM ex{layer}")
    .replace("probs AS", f"probs{layer} AS").replace("FROM probs", f"FROM probs{layer}")
    .replace("ranked AS", f"ranked{layer} AS").replace("FROM ranked", f"FROM ranked{layer}")
    .replace("gates AS", f"gates{layer} AS")
    for layer in (0, 1)) + f""",
loads AS (
  SELECT layer, expert_id, count(*) FILTER (WHERE rn <= {K.TOP_K}) / count(*) AS f_i, avg(prob) AS p_i
  FROM (SELECT 0 AS layer, * FROM ranked0 UNION ALL SELECT 1 AS layer, * FROM ranked1) GROUP BY layer, expert_id)
SELECT round(sum({K.LOAD_BALANCE_COEFF * E} * f_i * p_i), 6) AS routing_loss FROM loads""")
def q_routing_loss(spark, sf):
    layers = [V.routing_load(_routes(spark, sf, layer)) for layer in (0, 1)]
    both = layers[0].unionByName(layers[1])
    return V.routing_loss(both).select(F.round("routing_loss", 6).alias("routing_loss"))


@register("combine_experts", "WITH " + _probs_sql() + f""",
outputs AS (SELECT vec_id, CAST((i - 1) // {OUT_DIM} AS INTEGER) AS expert_id, CAST((i - 1) % {OUT_DIM} AS INTEGER) AS dim,
                   CAST(embedding[i] AS DOUBLE) AS value
            FROM (SELECT vec_id, embedding, unnest(range(1, {E * OUT_DIM} + 1)) AS i FROM embeddings))
SELECT g.vec_id, o.dim, round(sum(g.weight * o.value), 6) AS value
FROM gates g JOIN outputs o ON g.vec_id = o.vec_id AND g.expert_id = o.expert_id
GROUP BY g.vec_id, o.dim""")
def q_combine_experts(spark, sf):
    emb = read_table(spark, sf, "embeddings")
    outputs = (emb.select(F.col("vec_id").alias("token_id"), F.posexplode(F.slice("embedding", 1, E * OUT_DIM))
                          .alias("i", "v"))
               .select("token_id", (F.col("i") / OUT_DIM).cast("int").alias("expert_id"),
                       (F.col("i") % OUT_DIM).cast("int").alias("dim"), F.col("v").cast("double").alias("value")))
    out = V.combine(_routes(spark, sf), outputs)
    return out.select(F.col("token_id").alias("vec_id"), "dim", F.round("value", 6).alias("value"))


@register("mean_pool", """
SELECT label, CAST(i - 1 AS INTEGER) AS dim, round(avg(CAST(embedding[i] AS DOUBLE)), 6) AS value
FROM (SELECT label, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)
GROUP BY label, i""")
def q_mean_pool(spark, sf):
    emb = read_table(spark, sf, "embeddings")
    return V.mean_pool(emb, "label", "embedding").select("label", "dim", F.round("value", 6).alias("value"))


@register("linear_score", "WITH " + _linear_sql("label") + """
SELECT vec_id, k AS label, round(score, 6) AS score FROM scored""")
def q_linear_score(spark, sf):
    emb = read_table(spark, sf, "embeddings")
    emb = V.with_weights(emb, V.centroid_weights(emb, "label", "embedding"))
    ks = F.transform("weights", lambda r: r["k"])
    return emb.select("vec_id", F.explode(F.arrays_zip(ks.alias("k"), V.linear("embedding", "weights").alias("s"))).alias("z")) \
        .select("vec_id", F.col("z.k").alias("label"), F.round("z.s", 6).alias("score"))


GCN_LAYERS = 2


def _adjacency_sql() -> str:
    """CTEs up to adj(src, dst, norm) and the node features h0(node, dim, value)."""
    return _gcn_sql(0).split("\nSELECT node")[0].rstrip().rstrip(",")


def _gcn_sql(n_layers: int = GCN_LAYERS) -> str:
    layers = []
    prev = "h0"
    for n in range(1, n_layers + 1):
        layers.append(f"""h{n} AS (
  SELECT a.dst AS node, h.dim, greatest(sum(a.norm * h.value), 0.0) AS value
  FROM adj a JOIN {prev} h ON h.node = a.src GROUP BY a.dst, h.dim)""")
        prev = f"h{n}"
    return f"""WITH n AS (SELECT max(vec_id) + 1 AS n FROM embeddings),
raw AS (SELECT vec_id AS src, (vec_id + 1) % (SELECT n FROM n) AS dst FROM embeddings
        UNION ALL SELECT vec_id, (3 * vec_id + 1) % (SELECT n FROM n) FROM embeddings),
und AS (SELECT DISTINCT least(src, dst) AS a, greatest(src, dst) AS b FROM raw WHERE src <> dst),
adj0 AS (SELECT a AS src, b AS dst FROM und UNION ALL SELECT b, a FROM und
         UNION ALL SELECT DISTINCT vec_id, vec_id FROM embeddings),
deg AS (SELECT dst, count(*) AS deg FROM adj0 GROUP BY dst),
adj AS (SELECT a.src, a.dst, 1.0 / sqrt(ds.deg * dd.deg) AS norm
        FROM adj0 a JOIN deg ds ON ds.dst = a.src JOIN deg dd ON dd.dst = a.dst),
h0 AS (SELECT vec_id AS node, CAST(i - 1 AS INTEGER) AS dim, CAST(embedding[i] AS DOUBLE) AS value
       FROM (SELECT vec_id, embedding, unnest(range(1, {NODE_DIM} + 1)) AS i FROM embeddings)),
{",\n".join(layers)}
SELECT node AS vec_id, dim, round(value, 6) AS value FROM {prev}"""


def _graph(spark, sf):
    """Node features (long form) and edges of the embeddings' ring-and-chord graph."""
    emb = read_table(spark, sf, "embeddings")
    n = emb.agg((F.max("vec_id") + 1).alias("n")).scalar()
    edges = emb.select(F.col("vec_id").alias("src"), ((F.col("vec_id") + 1) % n).alias("dst")).unionByName(
        emb.select(F.col("vec_id").alias("src"), ((F.col("vec_id") * 3 + 1) % n).alias("dst")))
    nodes = emb.select(F.col("vec_id").alias("node"), F.posexplode(F.slice("embedding", 1, NODE_DIM))
                       .alias("dim", "value"))
    return emb, nodes, edges


@register("gcn_propagate", _gcn_sql())
def q_gcn_propagate(spark, sf):
    _, nodes, edges = _graph(spark, sf)
    h = V.gcn_propagate(nodes, edges, layers=GCN_LAYERS)
    return h.select(F.col("node").alias("vec_id"), "dim", F.round("value", 6).alias("value"))


GCN_OUT = 16   # output width of the weighted layer: the vectors below this id are its columns


@register("gcn_layers", _adjacency_sql() + f""",
w AS (SELECT CAST(i - 1 AS INTEGER) AS dim, CAST(vec_id AS INTEGER) AS dim_out, CAST(embedding[i] AS DOUBLE) AS w
      FROM (SELECT vec_id, embedding, unnest(range(1, {NODE_DIM} + 1)) AS i FROM embeddings WHERE vec_id < {GCN_OUT})),
hw AS (SELECT node, dim_out AS dim, sum(value * w) AS value FROM h0 JOIN w USING (dim) GROUP BY node, dim_out),
h1 AS (SELECT a.dst AS node, h.dim, greatest(sum(a.norm * h.value), 0.0) AS value FROM adj a JOIN hw h ON h.node = a.src GROUP BY a.dst, h.dim),
pooled AS (SELECT label, dim, avg(value) AS value FROM h1 JOIN embeddings ON vec_id = node GROUP BY label, dim)
SELECT label, dim, round(value, 6) AS value FROM pooled""")
def q_gcn_layers(spark, sf):
    """One weighted layer, ReLU, then the mean over each label's nodes."""
    emb, nodes, edges = _graph(spark, sf)
    w = emb.where(F.col("vec_id") < GCN_OUT).select(F.col("vec_id").cast("int").alias("dim_out"), F.posexplode(F.slice("embedding", 1, NODE_DIM)).alias("dim_in", "w"))
    h = V.gcn_propagate(nodes, edges, layers=1, weights=w.select("dim_in", "dim_out", F.col("w").cast("double").alias("w")))
    h = h.join(emb.select(F.col("vec_id").alias("node"), "label"), "node")
    return h.groupBy("label", "dim").agg(F.round(F.avg("value"), 6).alias("value"))


def _cells(spark, sf):
    """Logits of both labels from the whole vector (nearest-centroid form, by vec_id parity), with targets."""
    emb = read_table(spark, sf, "embeddings")
    emb = V.with_weights(emb, V.centroid_weights(emb.select((F.col("vec_id") % 2).cast("int").alias("k"), "embedding"), "k", "embedding"))
    lab = read_table(spark, sf, "labels")
    j = emb.join(lab, emb.vec_id == lab.doc_id).select("vec_id", V.linear("embedding", "weights").alias("logits"), "quality", "toxic")
    j = L.assign_batches(j, "vec_id", K.BATCH_SIZE)
    z = lambda i: (F.col("logits")[i] * SCALE)
    return j.select("batch", F.explode(F.array(
        F.struct(z(0).alias("z"), F.col("quality").cast("double").alias("y")),
        F.struct(z(1).alias("z"), F.col("toxic").cast("double").alias("y")))).alias("c")).select("batch", "c.z", "c.y")


@register("bce_loss", "WITH " + _linear_sql("CAST(vec_id % 2 AS INTEGER)") + f""",
logits AS (SELECT vec_id, list(score ORDER BY k) AS x FROM scored GROUP BY vec_id),
j AS (
  SELECT vec_id, x, quality, toxic,
         (row_number() OVER (ORDER BY vec_id) - 1) // {K.BATCH_SIZE} AS batch
  FROM logits JOIN labels ON vec_id = doc_id),
cells AS (SELECT batch, x[1] * {SCALE} AS z, CAST(quality AS DOUBLE) AS y FROM j
          UNION ALL SELECT batch, x[2] * {SCALE}, CAST(toxic AS DOUBLE) FROM j),
per AS (SELECT batch, avg(greatest(z, 0.0) - z * y + ln(1 + exp(-abs(z)))) AS l FROM cells GROUP BY batch)
SELECT count(*) AS n_batches, round(avg(l), 6) AS loss FROM per""")
def q_bce_loss(spark, sf):
    out = V.bce_loss(_cells(spark, sf))
    return out.select("n_batches", F.round("loss", 6).alias("loss"))
