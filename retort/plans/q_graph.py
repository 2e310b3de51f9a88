"""Queries: molecular graph tables.

Molecules are every present compound record (``mol_id = row_id``), so the
work grows with ``part``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from retort import constants as K
from retort.operators import clean as C
from retort.operators import molgraph as M
from retort.plans import adapters as A
from retort.plans import oracle as O
from retort.plans.catalog import register
from retort.plans.oracle import BASE

BR = O._q(M.BRACKET_RE)


def _one_hot_sql(e: str, cats) -> str:
    known = cats[:-1]
    items = [f"CASE WHEN {e} = {O._q(c)} THEN 1 ELSE 0 END" for c in known]
    items.append(f"CASE WHEN {e} IN ({', '.join(O._q(c) for c in known)}) THEN 0 ELSE 1 END")
    return "[" + ", ".join(items) + "]"


def _implicit_h_sql() -> str:
    whens = []
    for el, vals in M.ALLOWED_VALENCES.items():
        arom = f"greatest({vals[0]} - used, 0)"
        pick = "0"
        for v in reversed(vals):
            pick = f"CASE WHEN used <= {v} THEN {v} - used ELSE {pick} END"
        whens.append(f"WHEN element = {O._q(el)} THEN (CASE WHEN aromatic THEN {arom} ELSE {pick} END)")
    return f"(CASE WHEN bracket THEN 0 {' '.join(whens)} ELSE 0 END)"


_W = "PARTITION BY mol_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
_G = "PARTITION BY mol_id, depth, branch ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"

GRAPH = BASE.rstrip() + f""",
mols AS ({O.smiles_view("(SELECT row_id AS mol_id, smiles FROM present)")}),
tok AS MATERIALIZED (
  SELECT mol_id, CAST(i - 1 AS INTEGER) AS pos, toks[i] AS tok, kinds[i] AS kind
  FROM (SELECT mol_id, toks, kinds, unnest(range(1, len(toks) + 1)) AS i FROM mols WHERE valid)),
s1 AS (
  SELECT *, sum(CASE kind WHEN 'open' THEN 1 WHEN 'close' THEN -1 ELSE 0 END) OVER ({_W}) AS run,
         lag(tok) OVER (PARTITION BY mol_id ORDER BY pos) AS prev_tok,
         lag(kind) OVER (PARTITION BY mol_id ORDER BY pos) AS prev_kind,
         CASE WHEN kind = 'atom' THEN CAST(sum(CASE WHEN kind = 'atom' THEN 1 ELSE 0 END) OVER ({_W}) - 1 AS INTEGER) END AS atom_idx
  FROM tok),
s2 AS (
  SELECT mol_id, pos, tok, kind, CASE WHEN kind = 'close' THEN run + 1 ELSE run END AS depth,
         prev_tok, prev_kind, atom_idx, false AS is_anchor FROM s1),
u AS (
  SELECT * FROM s2
  UNION ALL
  SELECT mol_id, pos, '(' AS tok, 'anchor' AS kind, depth - 1 AS depth, NULL AS prev_tok, NULL AS prev_kind,
         NULL AS atom_idx, true AS is_anchor FROM s2 WHERE kind = 'open'),
u2 AS (SELECT *, sum(CASE WHEN kind = 'open' THEN 1 ELSE 0 END) OVER (PARTITION BY mol_id, depth ORDER BY pos
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS branch FROM u),
u3 AS (SELECT *, last_value(CASE WHEN kind = 'atom' THEN atom_idx WHEN kind = 'dot' THEN -1 END IGNORE NULLS)
                   OVER ({_G}) AS bp FROM u2),
u4 AS (SELECT *, max(CASE WHEN is_anchor THEN coalesce(bp, -1) END) OVER (PARTITION BY mol_id, pos) AS bp_open FROM u3),
u5 AS (
  SELECT *, last_value(CASE WHEN kind = 'atom' THEN atom_idx WHEN kind = 'dot' THEN -1
                            WHEN kind = 'open' THEN bp_open END IGNORE NULLS) OVER ({_G}) AS prev,
         coalesce(first_value(CASE WHEN kind IN ('close', 'dot') THEN pos - 1 END IGNORE NULLS)
                    OVER (PARTITION BY mol_id, depth, branch ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING),
                  max(pos) OVER (PARTITION BY mol_id)) AS sub_end
  FROM u4),
st AS MATERIALIZED (SELECT * FROM u5 WHERE NOT is_anchor),
atoms0 AS MATERIALIZED (
  SELECT mol_id, atom_idx, pos, tok, sym, element, sym <> element AS aromatic, bracket,
         CAST(CASE WHEN NOT bracket OR length(cpart) = 0 THEN 0
                   WHEN length(digits) > 0 THEN sgn * CAST(digits AS INTEGER) ELSE sgn * length(cpart) END AS INTEGER) AS charge,
         CAST(CASE WHEN bracket AND hpart = 'H' THEN 1 WHEN bracket AND length(hpart) > 1 THEN CAST(substr(hpart, 2, 5) AS INTEGER)
                   ELSE 0 END AS INTEGER) AS explicit_h,
         bracket AND length(regexp_extract(tok, {BR}, 3)) > 0 AS chiral
  FROM (SELECT *, CASE WHEN sym = '*' THEN '*' ELSE upper(substr(sym, 1, 1)) || substr(sym, 2, 2) END AS element,
               CASE WHEN substr(cpart, 1, 1) = '-' THEN -1 ELSE 1 END AS sgn,
               regexp_extract(cpart, '(\\d+)$', 1) AS digits
        FROM (SELECT mol_id, atom_idx, pos, tok, starts_with(tok, '[') AS bracket,
                     CASE WHEN starts_with(tok, '[') THEN regexp_extract(tok, {BR}, 2) ELSE tok END AS sym,
                     regexp_extract(tok, {BR}, 4) AS hpart, regexp_extract(tok, {BR}, 5) AS cpart
              FROM st WHERE kind = 'atom'))),
chain AS (
  SELECT mol_id, prev AS src, atom_idx AS dst, CASE WHEN prev_kind = 'bond' THEN prev_tok END AS symbol,
         false AS ring_closure, pos AS sub_start, sub_end
  FROM st WHERE kind = 'atom' AND prev IS NOT NULL AND prev >= 0),
labels AS (
  SELECT *, CAST((row_number() OVER (PARTITION BY mol_id, tok ORDER BY pos) + 1) // 2 AS INTEGER) AS pair,
         CASE WHEN prev_kind = 'bond' THEN prev_tok END AS sym
  FROM st WHERE kind = 'ring'),
ring AS (
  SELECT mol_id, arg_min(prev, pos) AS src, arg_max(prev, pos) AS dst, arg_min(sym, pos) AS symbol,
         true AS ring_closure, NULL::INTEGER AS sub_start, NULL::INTEGER AS sub_end
  FROM labels GROUP BY mol_id, tok, pair),
b0 AS MATERIALIZED (SELECT * FROM chain UNION ALL SELECT * FROM ring),
clos AS (
  SELECT r.mol_id, ps.pos AS ps, pd.pos AS pd FROM ring r
  JOIN atoms0 ps ON ps.mol_id = r.mol_id AND ps.atom_idx = r.src
  JOIN atoms0 pd ON pd.mol_id = r.mol_id AND pd.atom_idx = r.dst),
b1 AS (
  SELECT b.*, b.ring_closure OR EXISTS (
           SELECT 1 FROM clos c WHERE c.mol_id = b.mol_id
             AND ((c.ps BETWEEN b.sub_start AND b.sub_end) <> (c.pd BETWEEN b.sub_start AND b.sub_end))) AS in_ring
  FROM b0 b),
b2 AS (
  SELECT b.*, CASE WHEN symbol IS NULL THEN (CASE WHEN sa.aromatic AND da.aromatic AND in_ring THEN 'AROMATIC' ELSE 'SINGLE' END)
                   WHEN symbol IN ('-', '/', '\\') THEN 'SINGLE' WHEN symbol = '=' THEN 'DOUBLE'
                   WHEN symbol = '#' THEN 'TRIPLE' WHEN symbol = ':' THEN 'AROMATIC' ELSE 'Unknown' END AS bond_type
  FROM b1 b JOIN atoms0 sa ON sa.mol_id = b.mol_id AND sa.atom_idx = b.src
            JOIN atoms0 da ON da.mol_id = b.mol_id AND da.atom_idx = b.dst),
b3 AS MATERIALIZED (SELECT *, CASE bond_type WHEN 'AROMATIC' THEN 1.5 WHEN 'DOUBLE' THEN 2.0 WHEN 'TRIPLE' THEN 3.0 WHEN 'SINGLE' THEN 1.0
                 ELSE (CASE WHEN symbol = '$' THEN 4.0 ELSE 1.0 END) END AS bond_order FROM b2),
ends AS (SELECT mol_id, src AS atom_idx, bond_type, bond_order FROM b3
         UNION ALL SELECT mol_id, dst AS atom_idx, bond_type, bond_order FROM b3),
per_atom AS (
  SELECT mol_id, atom_idx, count(*) AS degree, sum(bond_order) AS valence_sum,
         count(*) FILTER (WHERE bond_type = 'TRIPLE') AS n_triple, count(*) FILTER (WHERE bond_type = 'DOUBLE') AS n_double,
         count(*) FILTER (WHERE bond_type = 'AROMATIC') AS n_arom
  FROM ends GROUP BY mol_id, atom_idx),
atoms1 AS (
  SELECT a.*, coalesce(p.degree, 0) AS degree, CAST(floor(coalesce(p.valence_sum, 0)) AS INTEGER) AS used,
         coalesce(p.n_triple, 0) AS n_triple, coalesce(p.n_double, 0) AS n_double, coalesce(p.n_arom, 0) AS n_arom
  FROM atoms0 a LEFT JOIN per_atom p USING (mol_id, atom_idx)),
atoms AS MATERIALIZED (
  SELECT *, explicit_h + implicit_h AS total_h,
         CASE WHEN n_triple > 0 OR n_double >= 2 THEN 'SP' WHEN n_double > 0 OR n_arom > 0 OR aromatic THEN 'SP2'
              ELSE 'SP3' END AS hybridization,
         (n_triple + n_double + n_arom) > 0 AS unsaturated
  FROM (SELECT *, CAST({_implicit_h_sql()} AS INTEGER) AS implicit_h FROM atoms1)),
bonds AS (
  SELECT b.mol_id, b.src, b.dst, b.symbol, b.bond_type, b.ring_closure, b.in_ring,
         b.bond_type = 'AROMATIC' OR (b.bond_type = 'SINGLE' AND su.unsaturated AND du.unsaturated) AS conjugated
  FROM b3 b JOIN atoms su ON su.mol_id = b.mol_id AND su.atom_idx = b.src
            JOIN atoms du ON du.mol_id = b.mol_id AND du.atom_idx = b.dst),
bonds2 AS (
  SELECT mol_id, src, dst, symbol, bond_type, ring_closure, in_ring, conjugated FROM bonds
  UNION ALL
  SELECT mol_id, dst AS src, src AS dst, symbol, bond_type, ring_closure, in_ring, conjugated FROM bonds)
"""


def _graph(spark, sf):
    mols = C.drop_missing(A.compounds(spark, sf), ["smiles"]).select(F.col("row_id").alias("mol_id"), "smiles")
    return M.graph(mols)


def _mols(spark, sf):
    return C.drop_missing(A.compounds(spark, sf), ["smiles"]).select(F.col("row_id").alias("mol_id"), "smiles")


@register("atoms", GRAPH + """
SELECT mol_id, atom_idx, element, aromatic, charge, explicit_h, chiral FROM atoms0""")
def q_atoms(spark, sf):
    return M.atoms(_mols(spark, sf)).select("mol_id", "atom_idx", "element", "aromatic", "charge",
                                             "explicit_h", "chiral")


@register("bonds", GRAPH + """
SELECT mol_id, src, dst, coalesce(symbol, '') AS symbol, ring_closure FROM bonds2""")
def q_bonds(spark, sf):
    b = _graph(spark, sf)[1]
    return b.select("mol_id", "src", "dst", F.coalesce("symbol", F.lit("")).alias("symbol"), "ring_closure")


@register("bond_features", GRAPH + f"""
SELECT mol_id, src, dst, bond_type, conjugated, in_ring,
       array_to_string(list_concat({_one_hot_sql('bond_type', K.BOND_TYPES)},
                                   [CAST(conjugated AS INTEGER), CAST(in_ring AS INTEGER)]), ' ') AS features
FROM bonds2""")
def q_bond_features(spark, sf):
    b = _graph(spark, sf)[1]
    feats = F.array_join(F.transform("features", lambda x: x.cast("bigint").cast("string")), " ")
    return b.select("mol_id", "src", "dst", "bond_type", "conjugated", "in_ring", feats.alias("features"))


@register("atom_features", GRAPH + f"""
SELECT mol_id, atom_idx, hybridization, CAST(degree AS BIGINT) AS degree,
       array_to_string(list_concat({_one_hot_sql('element', K.ATOM_TYPES)},
                                   [charge, CAST(aromatic AS INTEGER), CAST(degree AS INTEGER), total_h, CAST(chiral AS INTEGER)],
                                   {_one_hot_sql('hybridization', K.HYBRIDIZATIONS)}), ' ') AS features
FROM atoms""")
def q_atom_features(spark, sf):
    a = _graph(spark, sf)[0]
    feats = F.array_join(F.transform("features", lambda x: x.cast("bigint").cast("string")), " ")
    return a.select("mol_id", "atom_idx", "hybridization", F.col("degree").cast("bigint").alias("degree"),
                    feats.alias("features"))


@register("hydrogens", GRAPH + """
SELECT mol_id, atom_idx, total_h, implicit_h FROM atoms""")
def q_hydrogens(spark, sf):
    a = _graph(spark, sf)[0]
    return a.select("mol_id", "atom_idx", "total_h", "implicit_h")


_WEIGHTS = "MAP {" + ", ".join(f"{O._q(k)}: {float(v)}" for k, v in K.ATOMIC_WEIGHTS.items()) + "}"


@register("mol_weight", GRAPH + f"""
SELECT mol_id, CAST(count(*) FILTER (WHERE element <> 'H') AS BIGINT) AS num_atoms,
       CASE WHEN count(*) FILTER (WHERE w IS NULL) = 0 THEN CAST(round(sum(w + total_h * {K.ATOMIC_WEIGHTS['H']}), 3) AS DOUBLE) END
         AS molecular_weight
FROM (SELECT *, {_WEIGHTS}[element] AS w FROM atoms) GROUP BY mol_id""")
def q_mol_weight(spark, sf):
    return M.molecule_stats(_graph(spark, sf)[0])


@register("graph_sizes", GRAPH + """
SELECT a.mol_id, a.n_nodes, coalesce(b.n_edges, 0) AS n_edges
FROM (SELECT mol_id, count(*) AS n_nodes FROM atoms GROUP BY mol_id) a
LEFT JOIN (SELECT mol_id, count(*) AS n_edges FROM bonds2 GROUP BY mol_id) b USING (mol_id)""")
def q_graph_sizes(spark, sf):
    a, b = _graph(spark, sf)
    g = M.assemble(a, b)
    return g.select("mol_id", F.size("x").cast("bigint").alias("n_nodes"),
                    F.size("edge_index").cast("bigint").alias("n_edges"))
