"""The n documents nearest to each reference, against a comparison of every pair."""

import random

import pytest

from retort.operators import similarity as S


def shingles(text, k=5):
    w = [x for x in text.lower().split() if x]
    return {" ".join(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {" ".join(w)} if w else set()


def brute(docs, refs, n, threshold):
    sets = [(d, shingles(t)) for d, t in docs if t]
    out = []
    for r, t in refs:
        a = shingles(t or "")
        hits = [(-len(a & b) / len(a | b), d) for d, b in sets if a and b and len(a & b) * 100 >= len(a | b) * threshold]
        out += [(r, d, round(-j, 9)) for j, d in sorted(hits)[:n]]
    return sorted(out)


def found(df):
    return sorted((r.ref_id, r.doc_id, round(r.jaccard, 9)) for r in df.collect())


def texts(rng, number):
    words = [f"w{i}" for i in range(40)]
    base = [[rng.choice(words) for _ in range(rng.randint(0, 60))] for _ in range(12)]
    out = []
    for i in range(number):
        t = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2, 8])):
            if t:
                t[rng.randrange(len(t))] = rng.choice(words)
        out.append((i, " ".join(t)))
    return out


@pytest.mark.parametrize("n,threshold,steps", [(3, 5, S.STEPS), (10, 40, S.STEPS), (1, 90, S.STEPS), (50, 1, ()), (4, 20, (95, 60))])
def test_nearest_matches_brute_force(spark, n, threshold, steps):
    rng = random.Random(n)
    docs, refs = texts(rng, 250) + [(1000, None), (1001, " ")], texts(rng, 30) + [(500, ""), (501, None), (502, "none has these words at all")]
    got = S.nearest(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(refs, "doc_id long, text string"), n, threshold, steps=steps)
    assert found(got) == brute(docs, refs, n, threshold)


def test_a_group_of_ten_thousand_copies(spark):
    rng = random.Random(1)
    copy = " ".join(f"c{i}" for i in range(30))
    docs = [(i, copy) for i in range(10000)] + [(20000 + i, t) for i, t in texts(rng, 50)]
    refs = [(1, copy), (2, copy), (3, copy + " and more"), (4, docs[-1][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    asked = spark.createDataFrame(refs, "doc_id long, text string")
    got = S.similar(df, asked, threshold=20, n=7)
    assert found(got) == brute(docs, refs, 7, 20)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    assert S.nearest(none, some, 3).count() == 0 and S.nearest(some, none, 3).count() == 0


def test_only_prefixes_travel(spark):
    """Of each different set the rows exchanged are its prefix's, not all its shingles; with references only what they may share."""
    rng = random.Random(5)
    words = [f"v{i}" for i in range(5000)]
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 300)))) for i in range(60)]
    docs += [(100 + i, t) for i, t in docs] + [(300, " \n "), (301, None), (302, "ÀB  c"), (303, "àb\tC")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = S._sets(df, None, "doc_id", "text", 5)
    sets = {frozenset(shingles(t)) for _, t in docs if t and t.strip()}
    assert {(r.set, r["size"]) for r in rows.select("set", "size").collect()}.__len__() == len(sets) == 61
    assert sum(r["size"] for r in rows.dropDuplicates(["set"]).collect()) == sum(map(len, sets))
    ranked = S._ranked(rows, 90)
    assert ranked.count() == sum(len(s) - -(-90 * len(s) // 100) + 1 for s in sets)
    asked = S._sets(df, spark.createDataFrame([(1, docs[0][1])], "doc_id long, text string"), "doc_id", "text", 5)
    assert S._ranked(asked, 5, asked=True).where("not is_ref").count() < sum(map(len, sets)) / 10
