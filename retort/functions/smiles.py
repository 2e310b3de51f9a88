"""SMILES column functions: tokenise, encode, classify tokens, validate."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from retort import constants as K

ORGANIC_ATOMS = ["B", "C", "N", "O", "S", "P", "F", "I", "Cl", "Br", "b", "c", "n", "o", "s", "p", "*"]
BOND_TOKENS = ["-", "=", "#", ":", "/", "\\", "~", "$"]


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def tokenize(col, pattern: str = K.SMILES_PATTERN) -> Column:
    """All pattern matches, in order; unmatched characters vanish.

    The default is the published pattern (a single backslash is dropped);
    pass ``SMILES_PATTERN_FIXED`` to keep stereo bonds.
    """
    return F.regexp_extract_all(_c(col), F.lit(pattern), 1)


def encode(ids, special: bool = True) -> Column:
    """Optionally wrap token ids in <bos> ... <eos>."""
    ids = _c(ids)
    if not special:
        return ids
    return F.concat(F.array(F.lit(K.BOS_ID)), ids, F.array(F.lit(K.EOS_ID)))


def token_kind(tok) -> Column:
    """atom / bond / open / close / dot / ring / other."""
    t = _c(tok)
    return (F.when(t.startswith("["), F.lit("atom"))
            .when(t.isin(ORGANIC_ATOMS), F.lit("atom"))
            .when(t.isin(BOND_TOKENS), F.lit("bond"))
            .when(t == "(", F.lit("open"))
            .when(t == ")", F.lit("close"))
            .when(t == ".", F.lit("dot"))
            .when(t.rlike(r"^(%[0-9]{2}|[0-9])$"), F.lit("ring"))
            .otherwise(F.lit("other")))


def valid_smiles(col) -> Column:
    """B3 (re-aimed): structural SMILES check, all in one expression.

    True when the string is non-empty, every character is consumed by the
    (single-backslash) token pattern, no token is stray ('+', '@', '>' ...
    outside brackets), it starts with an atom, parentheses never go below
    zero and end balanced, no branch or string ends on a bond, every branch
    holds an atom, brackets are well formed, every ring label occurs an even
    number of times and no ring closes onto its own atom or the next one.
    No valence or aromaticity check is made.
    """
    s = _c(col)
    # one-element arrays bind the tokens and their kinds, so each is worked out once a row
    toks = F.array(F.struct(s.alias("s"), tokenize(s, K.SMILES_PATTERN_FIXED).alias("t")))
    kinds = F.transform(toks, lambda b: F.struct(b["s"].alias("s"), b["t"].alias("t"), F.transform(b["t"], token_kind).alias("k")))
    return F.coalesce(F.element_at(F.transform(kinds, lambda b: _structure_ok(b["s"], b["t"], b["k"])), 1), F.lit(False))


def _structure_ok(s: Column, toks: Column, kinds: Column) -> Column:
    covered = F.length(F.array_join(toks, "")) == F.length(s)
    no_other = ~F.array_contains(kinds, "other")
    first_atom = F.try_element_at(kinds, F.lit(1)) == F.lit("atom")
    last_ok = ~F.try_element_at(kinds, F.lit(-1)).isin("bond", "open", "dot")
    step = lambda k: F.when(k == "open", 1).when(k == "close", -1).otherwise(0)
    depth = F.aggregate(
        kinds, F.struct(F.lit(0).alias("d"), F.lit(0).alias("lo")),
        lambda acc, k: F.struct((acc["d"] + step(k)).alias("d"), F.least(acc["lo"], acc["d"] + step(k)).alias("lo")),
        lambda acc: (acc["d"] == 0) & (acc["lo"] >= 0))
    # a bond directly before ')' or '.' is dangling; a branch starts with an atom
    pairs = F.zip_with(kinds, F.slice(kinds, 2, F.greatest(F.size(kinds) - 1, F.lit(0))), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    no_bad_pair = ~F.exists(pairs, lambda p: F.coalesce(((p["a"] == "bond") & p["b"].isin("close", "dot", "bond"))
                                                      | ((p["a"] == "open") & p["b"].isin("close", "open")), F.lit(False)))
    brackets = F.forall(toks, lambda t: ~t.startswith("[") | t.rlike(K.BRACKET_ATOM))
    return (s.isNotNull() & (F.length(s) > 0) & covered & no_other & F.coalesce(first_atom, F.lit(False))
            & F.coalesce(last_ok, F.lit(False)) & depth & no_bad_pair & brackets & _rings_ok(toks, kinds))


def _rings_ok(toks: Column, kinds: Column) -> Column:
    """Ring labels pair up in order; the two ends of a pair lie on different atoms that are not neighbours
    in the chain already."""
    ends = F.filter(F.transform(kinds, lambda k, i: F.when(k == "ring", F.struct(
        F.element_at(toks, i + 1).alias("label"), i.alias("pos")))), lambda e: e.isNotNull())

    def pair_ok(a: Column, b: Column) -> Column:
        # between the ends lies an atom (else they are on one), and a second one or a break of the chain (else
        # they are neighbours)
        between = F.filter(F.slice(kinds, a["pos"] + 2, b["pos"] - a["pos"] - 1), lambda k: k.isin("atom", "close", "dot"))
        return b.isNotNull() & F.array_contains(between, "atom") & (F.size(between) > 1)

    def label_ok(own: Column) -> Column:
        return F.forall(F.transform(own, lambda e, j: F.when(j % 2 == 0, pair_ok(e, F.try_element_at(own, j + 2))).otherwise(True)), lambda ok: ok)

    labels = F.array_distinct(F.transform(ends, lambda e: e["label"]))
    groups = F.transform(labels, lambda r: F.filter(ends, lambda e: e["label"] == r))
    return F.forall(F.transform(groups, label_ok), lambda ok: ok)
