"""SimHash near-duplicates and repeated windows against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash

from retort.llm import components, simhash, substring

from .conftest import pairs

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute_simhash(text):
    w = WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    if not w:
        return 0
    grams = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(rows, radius=3):
    fps = [brute_simhash(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                parent[find(i)] = find(j)
    ids = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            ids[find(i)] = min(d, ids.get(find(i), d))
    return sorted(((d, f"{f:016x}", ids.get(find(i))) for i, ((d, _), f) in enumerate(zip(rows, fps))), key=str)


@pytest.mark.parametrize("tile", [simhash.TILE, 20])
def test_simhash_matches_brute_force(documents, tile):
    got = sorted(map(tuple, simhash.near_duplicates(documents, tile=tile).collect()), key=str)
    assert got == brute_components(pairs(documents))


def test_simhash_on_awkward_rows(awkward):
    got = sorted(map(tuple, simhash.near_duplicates(awkward).collect()), key=str)
    assert got == brute_components(pairs(awkward))
    assert simhash.near_duplicates(awkward.limit(0)).count() == 0


def test_forest_connects_what_all_pairs_connect(monkeypatch):
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 63, 6, dtype=np.uint64)
    x = np.unique(np.concatenate([b ^ (np.uint64(1) << rng.integers(0, 64, 40).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 40).astype(np.uint64)) for b in base]))

    def classes(edges):
        label = list(range(len(x)))
        for a, b in edges:
            la, lb = label[a], label[b]
            label = [la if v == lb else v for v in label]
        return {frozenset(i for i, v in enumerate(label) if v == k) for k in set(label)}

    every = [(i, j) for i in range(len(x)) for j in range(i) if int(x[i] ^ x[j]).bit_count() <= 3]
    for fine in (simhash.FINE, 10):  # by two counts, by four
        monkeypatch.setattr(simhash, "FINE", fine)
        found = simhash.forest(x, x, 3, True).tolist()
        assert len(found) < len(x) and classes(found) == classes(every)
        assert all(int(x[a] ^ x[b]).bit_count() <= 3 for a, b in found)
        half = len(x) // 2
        across = [(a, b + half) for a, b in simhash.forest(x[:half], x[half:], 3, False).tolist()]
        assert classes(across) == classes([(i, j) for i, j in every if j < half <= i])


def test_links_in_tiles_of_many_rows(spark, monkeypatch):
    """Tiles of several rows each give the links of one tile; a group of near copies among random ones."""
    rng = np.random.default_rng(9)
    x = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    x = np.unique(np.r_[x, x[:900] ^ np.uint64(5), x[:1] ^ (np.uint64(1) << np.arange(64, dtype=np.uint64))])
    df = spark.createDataFrame([(v,) for v in x.view(np.int64).tolist()], "fp long")
    monkeypatch.setattr(simhash, "TILE", 16)
    got = [sorted(map(tuple, simhash.classes(df, 3, tile).collect())) for tile in (1 << 20, 200, 50)]
    assert got[0] == got[1] == got[2]
    monkeypatch.undo()
    assert got[0] == sorted(map(tuple, simhash.classes(df, 3).collect()))
    v = x.tolist()
    near = {(i, j) for i in range(len(v)) for j in np.flatnonzero(np.bitwise_count(x ^ x[i]) <= 3).tolist()}
    label = dict(got[0])
    signed = x.view(np.int64).tolist()
    assert all(label[signed[i]] == label[signed[j]] for i, j in near)
    assert len(set(label.values())) == len(x) - 900 - 64


def test_exchange_of_tiles_is_bounded():
    """Bytes that the tiles of n random fingerprints send: eight a fingerprint for each tile compared with."""
    for n, most in ((2_300_000, 64), (23_000_000, 64), (230_000_000, 256)):
        assert 8 * n * -(-n // simhash.tile_size(n)) <= 8 * n * most
        assert simhash.TILE <= simhash.tile_size(n) <= simhash.LARGEST


def test_components_of_a_long_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(200, 260)] + [(3, 3), (None, 5), (7, 200)]
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {**{i: 100 for i in range(100, 141)}, 7: 7, **{i: 7 for i in range(200, 260)}}
    assert components.connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_keep_one_orders_rows_that_differ_elsewhere(spark):
    rows = [(1, "one text of some words", f"s{i}", "k", [f"x{i}"], {"a": i}) for i in range(6)] + [(1, "one text of some words", "s0", "k", ["x0"], {"a": 0})]
    schema = "doc_id long, text string, source string, _row_key string, tags array<string>, m map<string, int>"
    kept = {str(simhash.keep_one(spark.createDataFrame(part, schema).repartition(n)).collect()) for part, n in ((rows, 1), (rows[::-1], 4), (rows[3:] + rows[:3], 7))}
    assert len(kept) == 1 and simhash.keep_one(spark.createDataFrame(rows, schema)).columns == ["doc_id", "text", "source", "_row_key", "tags", "m"]


def test_keep_one_keeps_the_smallest_of_each_group(documents, awkward):
    want = {c for _, _, c in brute_components(pairs(documents))}
    kept = simhash.keep_one(documents.unionByName(documents.limit(9)))
    assert kept.columns == documents.columns
    rows = kept.collect()
    assert len(rows) == len(want) and {r.doc_id for r in rows} == want
    rest = simhash.keep_one(awkward)
    assert rest.columns == awkward.columns
    assert sorted(r.doc_id for r in rest.collect() if r.doc_id is not None).count(4) == 1
    assert rest.where("doc_id = 5").count() == 0
    assert simhash.keep_one(awkward.limit(0)).count() == 0


def brute_repeats(rows, window):
    late = substring.LAST
    words = [(d if d is not None else late, WORDS.findall(t)) for d, t in rows]
    first = {}
    for d, w in words:
        for i in range(len(w) - window + 1):
            key = " ".join(w[i : i + window])
            first[key] = min(first.get(key, late + 1), d)
    out = []
    for (doc_id, _), (d, w) in zip(rows, words):
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[" ".join(w[i : i + window])] < d:
                gone[i : i + window] = [True] * window
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((doc_id, len(w), len(w) - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("hot", [5000, 2])
def test_repeats_match_brute_force(documents, hot):
    got = sorted(map(tuple, substring.digest(substring.remove_repeats(documents, hot=hot)).collect()), key=str)
    assert got == brute_repeats(pairs(documents), 50)


@pytest.mark.parametrize("hot", [5000, 0])
def test_repeats_of_crowded_passages(spark, hot):
    rnd = random.Random(3)
    base = [rnd.choice("abcdef") for _ in range(300)]
    rows = [(None, None), (1, ""), (2, "x y"), (2, "x y"), (None, " ".join(base[100:150]))]
    for i in range(40):
        s = rnd.randrange(250)
        rows.append((i, "\t".join([rnd.choice("xyz")] * rnd.randrange(5) + base[s : s + rnd.randrange(90)] + [rnd.choice("ab") for _ in range(rnd.randrange(20))])))
    rows += rows[10:20] + [(50 + i, "m " * (40 + i) + "n o p " + "m " * 30) for i in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, substring.digest(substring.remove_repeats(df, window=8, gram=3, hot=hot)).collect()), key=str)
    assert got == brute_repeats([(d, t or "") for d, t in rows], 8)


def test_repeats_on_awkward_rows(awkward):
    got = sorted(map(tuple, substring.digest(substring.remove_repeats(awkward)).collect()), key=str)
    assert got == brute_repeats(pairs(awkward), 50)
    assert substring.remove_repeats(awkward.limit(0)).count() == 0


def test_windows_get_names_by_sorting():
    rng = np.random.default_rng(2)
    for window in (1, 2, 3, 7, 8, 50):
        x = np.r_[rng.integers(0, 2, 150), np.zeros(120, np.int64), np.tile([0, 1, 2], 40)]
        names = substring.names_of(x, window)
        want = [tuple(x[i : i + window].tolist()) for i in range(len(x) - window + 1)]
        assert len(names) == len(want) and len(set(names.tolist())) == len(set(want)) == len(set(zip(names.tolist(), want)))


@pytest.mark.parametrize("hot", [substring.HOT, 400])
def test_one_word_said_on_and_on(spark, hot):
    """Super-k-mers longer than their bound are cut and lose no window."""
    rows = [(i, "m " * (3000 + 7 * i) + f"x{i % 3} " + "m " * (i % 4) + "end") for i in range(9)] + [(20, "a b " * 900), (21, "z " + "a b " * 700)]
    got = sorted(map(tuple, substring.digest(substring.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), hot=hot)).collect()), key=str)
    assert got == brute_repeats(rows, 50)
    m, start, n = substring.super_kmers([b"m"] * 3000, 50, 12)
    assert n.max() <= substring.LONGEST and n.sum() == 2951 and (start[1:] == (start + n)[:-1]).all() and len(set(m)) == 1
