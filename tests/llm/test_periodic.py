"""Periodic runs against a search of every period at every place."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from retort.llm import periodic

from .conftest import pairs


def brute_runs(words, least=24):
    """(start, length, period), by the definition: every maximal stretch of each period, the smallest kept."""
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, 3 * q):
                found.setdefault((i, j - i + q), q)  # a larger period of one stretch is a multiple
            i = j + 1
    return sorted((s, length, q) for (s, length), q in found.items())


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_row(doc_id, text):
    words = [w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", text or "")]
    n = len(words)
    if doc_id is not None and n and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        g = zlib.crc32(str(doc_id).encode()) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    best = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *best, sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)),
            sha(" ".join(w for i, w in enumerate(words) if i not in dropped)))


@pytest.mark.parametrize("letters", [1, 2, 3])
def test_runs_of_random_words(letters):
    rng = random.Random(letters)
    for _ in range(400):
        parts = []
        while len(parts) < 120:
            root = [rng.randrange(letters) for _ in range(rng.randint(1, 9))]
            parts += root * rng.choice([1, 1, 2, 5, 9]) + [rng.randrange(letters) for _ in range(rng.randint(0, 4))]
        words = parts[: rng.randint(0, 160)]
        for least in (3, 24):
            got = list(zip(*(x.tolist() for x in periodic.runs_of(np.array(words, np.int64), least))))
            assert got == brute_runs(words, least)


def test_every_document_matches_brute_force(documents):
    got = sorted(map(tuple, periodic.digest(periodic.periodic_runs(documents, plant=True)).collect()))
    want = sorted(brute_row(d, t) for d, t in pairs(documents))
    assert got == want and sum(r[1] > 0 for r in got) > 10


def test_runs_of_different_documents_stay_apart(spark):
    rows = [(i, "a b " * 6) for i in range(50)]  # 12 words each: no run, though 600 words in a row would be one
    got = periodic.periodic_runs(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()
    assert all(r.runs == [] and r.kept.split() == ["a", "b"] * 6 for r in got)


def test_awkward_rows(awkward):
    # the long texts repeat 977 words in order: one run of 61 periods
    got = periodic.periodic_runs(awkward).collect()
    assert sorted((r.doc_id, r.n_words) for r in got if r.doc_id is not None) == sorted((d, len((t or "").split())) for d, t in pairs(awkward) if d is not None)
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert [tuple(r) for r in by[3].runs] == [(0, 60000, 977)] and by[3].kept.split() == [f"word{i}" for i in range(977)]
    assert [tuple(r) for r in by[-9].runs] == [(0, 60000, 977)] and by[-9].kept.endswith("word976 tail")
    assert by[7].runs == [] and by[1].kept == ""
    digests = periodic.digest(periodic.periodic_runs(awkward, plant=True))
    small = [(d, t) for d, t in pairs(awkward) if len(t) < 1000]
    assert {brute_row(d, t) for d, t in small} <= {tuple(r) for r in digests.collect()}
    assert digests.count() == awkward.count() and periodic.digest(periodic.periodic_runs(awkward.limit(0))).count() == 0


def test_one_word_said_on_and_on(spark):
    r = periodic.periodic_runs(spark.createDataFrame([(1, "go " * 300000)], "doc_id long, text string")).first()
    assert [tuple(x) for x in r.runs] == [(0, 300000, 1)] and r.kept == "go"
