"""Molecular graph tables from SMILES, built with windows.

SMILES is a depth-first listing, so atoms and bonds follow from running
counts over each molecule's tokens; no per-row parser runs. All windows
are partitioned by ``mol_id`` first, so one hash shuffle of the molecules
on ``mol_id`` serves every window and aggregate below (a hash partitioning on
``mol_id`` satisfies any clustering that starts with it). A molecule is
small, so no window group grows with the data.

Bond rule. depth = open parentheses so far; branch = opens so far at that
depth. An atom bonds to the last atom before it in the same
(depth, branch) group; the first atom of a branch bonds to the branch
point, the last atom before the '(' one level up (found through an
"anchor" row at that level). A '.' breaks the chain. Ring labels pair
up in order per label; each end is the atom the label follows.

Approximations (no chemistry toolkit): aromaticity as written (lower
case); implicit hydrogens from default valences; hybridisation from bond
orders (triple or two doubles SP, double/aromatic SP2, else SP3);
conjugated = aromatic, or single between two unsaturated atoms; in-ring
= ring closure, or a tree bond crossed by a closure (bridge test on the
depth-first tree: some closure has exactly one end in the child's
subtree). That test is linear: both labels of a closure carry its mark, a
running exclusive-or of the marks stands beside every token, and a subtree
is a stretch of tokens, so its own exclusive-or is that of two running
values. Closures within the subtree cancel; what is left is nonzero if one
crosses. A mark has 128 hashed bits: crossing closures that cancel each
other would take marks that add up to nothing by chance, 2^-128 a bond.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retort import constants as K
from retort.functions.smiles import token_kind, tokenize, valid_smiles
from retort.functions.text import bind, one_hot
from retort.session import scratch_path

BRACKET_RE = K.BRACKET_ATOM
BOND_NAME = {"-": "SINGLE", "/": "SINGLE", "\\": "SINGLE", "=": "DOUBLE", "#": "TRIPLE", ":": "AROMATIC"}
BOND_ORDER = {"AROMATIC": 1.5, "DOUBLE": 2.0, "TRIPLE": 3.0, "SINGLE": 1.0}
ALLOWED_VALENCES = {"B": [3], "C": [4], "N": [3, 5], "O": [2], "P": [3, 5], "S": [2, 4, 6],
                    "F": [1], "Cl": [1], "Br": [1], "I": [1]}
#: Hash seeds of a closure's mark, 64 bits each.
MARKS = (0, 1)


def _w(*parts):
    return Window.partitionBy("mol_id", *parts)


def _shuffle_partitions(spark) -> int:
    try:
        return int(spark.conf.get("spark.sql.shuffle.partitions"))
    except (TypeError, ValueError):
        return spark.sparkContext.defaultParallelism


def token_rows(mols: DataFrame, col: str = "smiles") -> DataFrame:
    """(mol_id, pos, tok, kind) for valid molecules, single-backslash pattern.

    Molecules (one short row each) are hash-partitioned on ``mol_id`` before
    the CPU-heavy validation and tokenisation, so that work runs in parallel
    and the token rows inherit the partitioning every later window needs: the
    one shuffle moves molecules, not tokens. The validity test sits inside
    the outer generator, where Catalyst cannot push it below the shuffle.
    """
    spark = mols.sparkSession
    m = mols.select("mol_id", col).repartition(_shuffle_partitions(spark), "mol_id")
    toks = F.when(valid_smiles(F.col(col)), tokenize(col, K.SMILES_PATTERN_FIXED))
    return (m.select("mol_id", F.posexplode_outer(toks).alias("pos", "tok"))
            .where(F.col("pos").isNotNull())
            .withColumn("kind", token_kind(F.col("tok"))))


def _structure(tokens: DataFrame) -> DataFrame:
    """Per token: depth, branch, atom index, the atom it attaches to
    (``prev``), the bond symbol written before it, a ring label's ``pair`` and
    whether a closure crosses into the subtree that begins here (``crossed``)."""
    step = F.when(F.col("kind") == "open", 1).when(F.col("kind") == "close", -1).otherwise(0)
    by_pos = _w().orderBy("pos")
    so_far = by_pos.rowsBetween(Window.unboundedPreceding, 0)
    # one select for the windows of an order: each further one would copy all rows once more
    t = tokens.select("*", F.sum(step).over(so_far).alias("_run"), F.lag("tok").over(by_pos).alias("prev_tok"),
                      F.lag("kind").over(by_pos).alias("prev_kind"), F.sum((F.col("kind") == "atom").cast("int")).over(so_far).alias("_atoms"))
    t = (t
         # a ')' belongs to the branch it closes
         .withColumn("depth", F.when(F.col("kind") == "close", F.col("_run") + 1).otherwise(F.col("_run")))
         .withColumn("atom_idx", F.when(F.col("kind") == "atom", F.col("_atoms") - 1))
         .drop("_run", "_atoms"))
    # every '(' also yields an anchor row one level up, generated from the
    # same row (a self-union would recompute the windows above); mol_id stays a
    # column of its own, or the partitioning by it would be lost from here on
    cols = ["pos", "tok", "kind", "depth", "prev_tok", "prev_kind", "atom_idx"]
    me_row = F.struct(*[F.col(c) for c in cols], F.lit(False).alias("is_anchor"))
    anchor = F.struct(F.col("pos"), F.lit("(").alias("tok"), F.lit("anchor").alias("kind"),
                      (F.col("depth") - 1).alias("depth"), F.lit(None).cast("string").alias("prev_tok"),
                      F.lit(None).cast("string").alias("prev_kind"), F.lit(None).cast("int").alias("atom_idx"),
                      F.lit(True).alias("is_anchor"))
    both = F.when(F.col("kind") == "open", F.array(me_row, anchor)).otherwise(F.array(me_row))
    u = t.select("mol_id", F.explode(both).alias("_r")).select("mol_id", "_r.*")
    # branch = opens so far at this depth (anchors sit one level up, never opens)
    u = u.withColumn("branch", F.sum((F.col("kind") == "open").cast("int")).over(
        _w("depth").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)))
    grp = _w("depth", "branch").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    # value an atom leaves for later atoms of its group: (index, token); a
    # dot leaves index -1
    me = F.struct(F.col("atom_idx").alias("idx"), F.col("tok").alias("tok"))
    dot = F.struct(F.lit(-1).alias("idx"), F.lit(None).cast("string").alias("tok"))
    val = F.when(F.col("kind") == "atom", me).when(F.col("kind") == "dot", dot)
    u = u.withColumn("_bp", F.last(val, ignorenulls=True).over(grp))
    # hand the anchor's value (the branch point) to its '(' row
    u = u.withColumn("_bp_open", F.max(F.when(F.col("is_anchor"), F.coalesce("_bp", dot))).over(_w("pos")))
    val2 = val.when(F.col("kind") == "open", F.col("_bp_open"))
    u = u.withColumn("prev_atom", F.last(val2, ignorenulls=True).over(grp))
    u = u.withColumn("prev", F.col("prev_atom")["idx"])
    # ring labels pair up in order; a label that follows no atom has no place in the tree
    ring = F.col("kind") == "ring"
    u = u.withColumn("pair", F.when(ring, ((F.row_number().over(_w("tok").orderBy("pos")) + 1) / 2).cast("int")))
    mark = lambda i: F.when(ring & (F.col("prev") >= 0), F.xxhash64("tok", "pair", F.lit(i))).otherwise(F.lit(0).cast("bigint"))
    u = u.select("*", *[F.bit_xor(mark(i)).over(so_far).alias(f"_mark{i}") for i in MARKS],
                 *[F.bit_xor(mark(i)).over(_w()).alias(f"_all{i}") for i in MARKS])
    # subtree of an atom: up to the first ')' or '.' after it in its group, else to the last token
    marks = [f"_mark{i}" for i in MARKS]
    # (read backwards: a frame that reaches to the end of its group is worked out anew for each row)
    ahead = _w("depth", "branch").orderBy(F.desc("pos")).rowsBetween(Window.unboundedPreceding, -1)
    end = F.last(F.when(F.col("kind").isin("close", "dot"), F.struct(*marks)), ignorenulls=True).over(ahead)
    last = F.struct(*[F.col(f"_all{i}").alias(m) for i, m in zip(MARKS, marks)])
    u = u.withColumn("_end", end).withColumn("_end", F.coalesce("_end", last))
    u = u.withColumn("crossed", reduce(or_, [F.col(m) != F.col("_end")[m] for m in marks]))
    return u.where(~F.col("is_anchor")).drop("_bp", "_bp_open", "_end", "is_anchor", *marks, *[f"_all{i}" for i in MARKS])


def _bond_symbol(prev_tok: Column, prev_kind: Column) -> Column:
    return F.when(prev_kind == "bond", prev_tok)


def atoms(mols: DataFrame, col: str = "smiles") -> DataFrame:
    """H1: one row per atom, in order: mol_id, atom_idx, pos, token,
    symbol, element, aromatic, charge, explicit H, chiral."""
    t = token_rows(mols, col).where(F.col("kind") == "atom")
    t = t.withColumn("atom_idx", (F.row_number().over(_w().orderBy("pos")) - 1).cast("int"))
    return _atom_props(t)


def _atom_props(t: DataFrame) -> DataFrame:
    tok = F.col("tok")
    br = tok.startswith("[")
    bracket = F.when(br, tok)  # null for other atoms, on which no pattern is run
    sym = F.coalesce(F.regexp_extract(bracket, BRACKET_RE, 2), tok)
    element = F.when(sym == "*", F.lit("*")).otherwise(
        F.concat(F.upper(F.substring(sym, 1, 1)), F.substring(sym, 2, 2)))
    hpart = F.regexp_extract(bracket, BRACKET_RE, 4)
    hcount = F.when(br & (hpart == "H"), 1).when(br & (F.length(hpart) > 1),
                                                  F.substring(hpart, 2, 5).try_cast("int")).otherwise(0)
    cpart = F.regexp_extract(bracket, BRACKET_RE, 5)
    sign = F.when(F.substring(cpart, 1, 1) == "-", -1).otherwise(1)
    digits = F.regexp_extract(cpart, r"(\d+)$", 1)
    charge = F.when(~br | (F.length(cpart) == 0), 0).when(F.length(digits) > 0, sign * digits.try_cast("int")) \
        .otherwise(sign * F.length(cpart))
    chiral = br & (F.length(F.regexp_extract(bracket, BRACKET_RE, 3)) > 0)
    return t.select("mol_id", "atom_idx", "pos", "tok", sym.alias("symbol"), element.alias("element"),
                    (sym != element).alias("aromatic"), charge.cast("int").alias("charge"),
                    hcount.cast("int").alias("explicit_h"), br.alias("bracket"), chiral.alias("chiral"))


def _chain_and_ring_bonds(s: DataFrame) -> DataFrame:
    """One row per bond: mol_id, src, dst, endpoint tokens, symbol,
    ring_closure, in_ring."""
    chain = (s.where((F.col("kind") == "atom") & F.col("prev").isNotNull() & (F.col("prev") >= 0))
             .select("mol_id", F.col("prev").alias("src"), F.col("atom_idx").alias("dst"),
                     F.col("prev_atom")["tok"].alias("src_tok"), F.col("tok").alias("dst_tok"),
                     _bond_symbol(F.col("prev_tok"), F.col("prev_kind")).alias("symbol"),
                     F.lit(False).alias("ring_closure"), F.col("crossed").alias("in_ring")))
    end = F.struct("pos", "prev_atom", _bond_symbol(F.col("prev_tok"), F.col("prev_kind")).alias("sym"))
    ring = (s.where(F.col("kind") == "ring").groupBy("mol_id", "tok", "pair").agg(F.min(end).alias("a"), F.max(end).alias("b"))
            .select("mol_id", F.col("a.prev_atom.idx").alias("src"), F.col("b.prev_atom.idx").alias("dst"),
                    F.col("a.prev_atom.tok").alias("src_tok"), F.col("b.prev_atom.tok").alias("dst_tok"),
                    F.coalesce("a.sym", "b.sym").alias("symbol"), F.lit(True).alias("ring_closure"),
                    F.lit(True).alias("in_ring")))
    return chain.unionByName(ring)


def _tok_aromatic(tok: Column) -> Column:
    """Aromatic as written: a lower-case organic atom or bracket symbol."""
    sym = F.when(tok.startswith("["), F.regexp_extract(tok, BRACKET_RE, 2)).otherwise(tok)
    return bind(sym, lambda s: (F.length(s) > 0) & (s == F.lower(s)) & (s != "*"))


def graph(mols: DataFrame, col: str = "smiles"):
    """(atoms with features, bonds with features) for ``mols(mol_id, smiles)``.

    atoms: mol_id, atom_idx, element, ..., degree, total_h, hybridization,
           features ARRAY<DOUBLE>(21)
    bonds: mol_id, src, dst (both directions), bond_type, conjugated,
           in_ring, features ARRAY<DOUBLE>(7)

    One shuffle of molecules serves ``_structure``, one of atoms and bond ends
    the rest: every step is a window or aggregate keyed by ``mol_id`` first.
    """
    # the structure feeds chain bonds, ring bonds and atoms: written once in the
    # shared checkpoint folder, of the tokens that these read
    path = scratch_path(mols.sparkSession, "molecule-structure")
    kept = _structure(token_rows(mols, col)).where(F.col("kind").isin("atom", "ring"))
    kept.select("mol_id", "pos", "tok", "kind", "prev_tok", "prev_kind", "atom_idx", "prev_atom", "prev", "pair", "crossed").write.parquet(path)
    s = mols.sparkSession.read.parquet(path)
    b = _chain_and_ring_bonds(s)
    sym = F.col("symbol")
    implicit = F.when(_tok_aromatic(F.col("src_tok")) & _tok_aromatic(F.col("dst_tok")) & F.col("in_ring"),
                      F.lit("AROMATIC")).otherwise(F.lit("SINGLE"))
    # constant maps: a branch for each symbol makes code that the JVM is too slow to compile
    table = lambda d: F.create_map(*[F.lit(x) for kv in d.items() for x in kv])
    btype = F.when(sym.isNull(), implicit).otherwise(F.coalesce(F.try_element_at(table(BOND_NAME), sym), F.lit("Unknown")))
    known = F.try_element_at(table(BOND_ORDER), F.col("bond_type"))
    order = F.coalesce(known, F.when(sym == "$", 4.0).otherwise(1.0))
    b = b.withColumn("bond_type", btype).withColumn("order", order)
    # atom rows and bond-end rows side by side, windowed per atom
    a0 = _atom_props(s.where(F.col("kind") == "atom"))
    ends = b.select("mol_id", F.explode(F.array(
        F.struct(F.col("src").alias("atom_idx"), F.col("src").alias("src"), F.col("dst").alias("dst")),
        F.struct(F.col("dst").alias("atom_idx"), F.col("src").alias("src"), F.col("dst").alias("dst")))).alias("e"),
        "symbol", "bond_type", "order", "ring_closure", "in_ring")
    ends = ends.select("mol_id", "e.atom_idx", "e.src", "e.dst", "symbol", "bond_type", "order",
                       "ring_closure", "in_ring", F.lit(True).alias("_end"))
    rows = a0.unionByName(ends, allowMissingColumns=True).withColumn("_end", F.coalesce("_end", F.lit(False)))
    per_atom = _w("atom_idx")
    is_end = F.col("_end")
    ends_of = lambda t: F.count_if(is_end & (F.col("bond_type") == t)).over(per_atom).alias(f"_n_{t}")
    rows = rows.select("*", F.count_if(is_end).over(per_atom).alias("degree"), F.sum(F.when(is_end, F.col("order"))).over(per_atom).alias("_valences"),
                       ends_of("TRIPLE"), ends_of("DOUBLE"), ends_of("AROMATIC"))
    rows = (rows
            .withColumn("valence_sum", F.coalesce("_valences", F.lit(0.0)))
            .withColumnsRenamed({"_n_TRIPLE": "n_triple", "_n_DOUBLE": "n_double", "_n_AROMATIC": "n_arom"})
            .drop("_valences")
            .withColumn("unsaturated", (F.col("n_triple") + F.col("n_double") + F.col("n_arom")) > 0))
    a = rows.where(~is_end).drop("src", "dst", "symbol", "bond_type", "order", "ring_closure", "in_ring", "_end")
    a = a.withColumn("implicit_h", implicit_h(F.col("element"), F.col("aromatic"), F.col("valence_sum"),
                                              F.col("bracket")))
    a = a.withColumn("total_h", F.col("explicit_h") + F.col("implicit_h"))
    hyb = (F.when((F.col("n_triple") > 0) | (F.col("n_double") >= 2), F.lit("SP"))
           .when((F.col("n_double") > 0) | (F.col("n_arom") > 0) | F.col("aromatic"), F.lit("SP2"))
           .otherwise(F.lit("SP3")))
    a = a.withColumn("hybridization", hyb)
    a = a.withColumn("features", F.concat(
        one_hot(F.col("element"), K.ATOM_TYPES),
        F.array(F.col("charge").cast("double"), F.col("aromatic").cast("double"), F.col("degree").cast("double"),
                F.col("total_h").cast("double"), F.col("chiral").cast("double")),
        one_hot(F.col("hybridization"), K.HYBRIDIZATIONS)))
    # the two ends of each bond meet again per (mol_id, src, dst)
    bd = (rows.where(is_end).groupBy("mol_id", "src", "dst")
          .agg(F.first("symbol", ignorenulls=True).alias("symbol"), F.first("bond_type").alias("bond_type"),
               F.first("ring_closure").alias("ring_closure"), F.first("in_ring").alias("in_ring"),
               F.bool_and("unsaturated").alias("_both_unsat")))
    bd = bd.withColumn("conjugated", (F.col("bond_type") == "AROMATIC")
                       | ((F.col("bond_type") == "SINGLE") & F.col("_both_unsat")))
    bd = bd.withColumn("features", F.concat(one_hot(F.col("bond_type"), K.BOND_TYPES),
                                            F.array(F.col("conjugated").cast("double"),
                                                    F.col("in_ring").cast("double"))))
    cols = ["symbol", "bond_type", "ring_closure", "conjugated", "in_ring", "features"]
    both = bd.select("mol_id", F.explode(F.array(F.struct(F.col("src").alias("s"), F.col("dst").alias("d")),
                                                 F.struct(F.col("dst").alias("s"), F.col("src").alias("d")))).alias("p"),
                     *cols)
    return a, both.select("mol_id", F.col("p.s").alias("src"), F.col("p.d").alias("dst"), *cols)


def implicit_h(element: Column, aromatic: Column, valence_sum: Column, bracket: Column) -> Column:
    """H6: implicit hydrogens of organic-subset atoms from default valences
    (aromatic atoms: first valence only); bracket atoms have none."""
    used = F.floor(valence_sum).cast("int")
    most = max(map(len, ALLOWED_VALENCES.values()))
    # one constant map, not a branch for each element: the JVM is too slow to compile so many
    table = F.create_map(*[x for el, vals in ALLOWED_VALENCES.items()
                           for x in (F.lit(el), F.array(*[F.lit(v) for v in vals + vals[-1:] * (most - len(vals))]))])

    def free(v: Column) -> Column:
        pick = F.lit(0)
        for i in reversed(range(most)):
            pick = F.when(used <= v[i], v[i] - used).otherwise(pick)
        return F.when(v.isNull(), F.lit(0)).when(aromatic, F.greatest(v[0] - used, F.lit(0))).otherwise(pick)

    return F.when(bracket, F.lit(0)).otherwise(bind(F.try_element_at(table, element), free)).cast("int")


def bonds(mols: DataFrame, col: str = "smiles") -> DataFrame:
    """H2 + H4: bonds in both directions with their features."""
    return graph(mols, col)[1]


def molecule_stats(atoms_df: DataFrame, weights=K.ATOMIC_WEIGHTS) -> DataFrame:
    """Heavy-atom count and molecular weight per molecule.

    ``weights`` is a small fixed table, so it is a literal map lookup."""
    wmap = F.create_map(*[x for k, v in weights.items() for x in (F.lit(k), F.lit(float(v)))])
    w = F.try_element_at(wmap, F.col("element"))
    heavy = F.col("element") != "H"
    total = F.sum(w + F.col("total_h") * F.lit(weights["H"]))
    return atoms_df.groupBy("mol_id").agg(
        F.count_if(heavy).cast("bigint").alias("num_atoms"),
        # an element without a weight makes the molecule's weight unknown
        F.when(F.count_if(w.isNull()) == 0, F.round(total, 3)).alias("molecular_weight"))


def assemble(atoms_df: DataFrame, bonds_df: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """H5: one row per molecule: ordered node features, edge index and edge
    features; molecules without bonds keep empty edge lists."""
    nodes = atoms_df.groupBy("mol_id").agg(F.array_sort(F.collect_list(F.struct("atom_idx", "features"))).alias("_n"))
    edges = bonds_df.groupBy("mol_id").agg(
        F.array_sort(F.collect_list(F.struct("src", "dst", "features"))).alias("_e"))
    g = nodes.join(edges, "mol_id", "left").select(
        "mol_id",
        F.transform("_n", lambda s: s["features"]).alias("x"),
        F.coalesce(F.transform("_e", lambda s: F.array(s["src"], s["dst"])),
                   F.array().cast("array<array<int>>")).alias("edge_index"),
        F.coalesce(F.transform("_e", lambda s: s["features"]), F.array().cast("array<array<double>>")).alias("edge_attr"))
    if labels is not None:
        g = g.join(labels, "mol_id", "left")
    return g
