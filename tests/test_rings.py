"""Ring membership: linear in the molecule, equal to trying each bond's removal."""

import random

from retort.operators import molgraph as M


def in_ring(spark, smiles):
    rows = [(i, s) for i, s in enumerate(smiles)]
    b = M.graph(spark.createDataFrame(rows, "mol_id int, smiles string"))[1].where("src < dst")
    return {(r.mol_id, r.src, r.dst): r.in_ring for r in b.select("mol_id", "src", "dst", "in_ring").collect()}


def random_smiles(rnd, n):
    """A molecule with branches and closures that may join any two places, also of different branches, and its bonds."""
    out, bonds, last, points, labels = ["C"], [], 0, [], {}
    for i in range(1, n):
        if rnd.random() < 0.25 and len(labels) < 9:
            label = next(x for x in range(1, 10) if x not in labels)
            labels[label] = last
            out.append(str(label))
        elif labels and rnd.random() < 0.4:
            label = rnd.choice(list(labels))
            if labels[label] != last:
                bonds.append((labels.pop(label), last))
                out.append(str(label))
        if rnd.random() < 0.25:
            out.append("(")
            points.append(last)
        elif points and out[-1] != "(" and rnd.random() < 0.3:
            out.append(")")
            last = points.pop()
        out.append("C")
        bonds.append((last, i))
        last = i
    for label, atom in labels.items():
        out += ["C", str(label)]
        bonds += [(last, n), (atom, n)]
        last, n = n, n + 1
    return "".join(out) + ")" * len(points), bonds


def bridges(edges):
    """Edges whose removal parts their two ends, by trying each."""
    out = set()
    for k, (a, b) in enumerate(edges):
        near = {}
        for j, (x, y) in enumerate(edges):
            if j != k:
                near.setdefault(x, []).append(y)
                near.setdefault(y, []).append(x)
        seen, todo = {a}, [a]
        while todo:
            for y in near.get(todo.pop(), []):
                if y not in seen:
                    seen.add(y)
                    todo.append(y)
        if b not in seen:
            out.add((a, b))
    return out


def test_random_molecules_equal_bridges(spark):
    rnd = random.Random(5)
    mols = [random_smiles(rnd, rnd.randint(3, 40)) for _ in range(300)]
    found = in_ring(spark, [s for s, _ in mols])
    valid = {m for m, _, _ in found}
    assert len(valid) > 100 and len(set(found.values())) == 2
    for m in valid:
        smiles, bonds = mols[m]
        bonds = [(min(b), max(b)) for b in bonds]
        cut = bridges(bonds)
        assert {e: found.get((m, *e)) for e in bonds} == {e: e not in cut for e in bonds}, smiles


def test_large_molecules(spark):
    units = 16000
    chain = "C1CCCCC1" * units
    found = in_ring(spark, [chain, "C%10" + chain + "C%10", "C" * 100000])
    count = lambda m, v: sum(1 for k, x in found.items() if k[0] == m and x is v)
    assert (count(0, True), count(0, False)) == (6 * units, units - 1)
    assert (count(1, True), count(1, False)) == (6 * units + units + 2, 0)
    assert (count(2, True), count(2, False)) == (0, 99999)


def test_the_structure_shuffles_molecules_once(spark):
    """Anchors keep the partitioning by molecule, so no window of the structure exchanges tokens."""
    from retort.operators import molgraph as M
    mols = spark.createDataFrame([(1, "c1ccccc1C(=O)O"), (2, "C1CC1.CN")], "mol_id long, smiles string")
    plan = M._structure(M.token_rows(mols))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
