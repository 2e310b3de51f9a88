"""Ranked search against a score of every document for every item."""

import math
import random
import re
import tracemalloc
from collections import Counter
from pathlib import Path
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from retort.llm import ranking as R
from retort.llm.common import materialize

from .conftest import pairs

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, items, k=50):
    docs = [(d, Counter(TERM.findall((t or "").translate(LOW)))) for d, t in rows]
    n_docs, n_terms = sum(bool(c) for _, c in docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item, text in set(items):
        found = []
        wanted = set(TERM.findall((text or "").translate(LOW)))
        for d, c in docs:
            m = 100 - 50 + 50 * sum(c.values()) * n_docs // n_terms if c else 0
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in wanted if c[t])
            if score > 0:
                found.append((-score, d is None, d or 0, d))
        out += [(item, i + 1, d, -s) for i, (s, _, _, d) in enumerate(sorted(found, key=lambda r: r[:3])[:k])]
    return sorted(out, key=str)


def ranked(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("sizes", [{}, {"item_bytes": 1500, "cells": 1 << 14}])
def test_matches_brute_force(spark, documents, sf_dir, sizes):
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    assert ranked(R.rank(documents, items, **sizes)) == brute(pairs(documents), [(r.item_id, r.text) for r in items.collect()])


def test_many_shards_with_ties_and_few_results(spark):
    rng = random.Random(5)
    words = [f"w{int(rng.paretovariate(0.7)) % 300}" for _ in range(4000)]
    rows = [(rng.randrange(500), " ".join(rng.choices(words, k=rng.randint(0, 30)))) for _ in range(900)]
    rows += rows[:40]  # repeated rows rank apart
    items = [(i, " ".join(rng.choices(words, k=rng.randint(0, 12)))) for i in range(30)] + [(3, "w1 W2 w1"), (3, "w1 W2 w1"), (99, "nowhere"), (None, "w1-w2")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    for k, cells in ((5, 1 << 13), (50, 1 << 13), (50, 1 << 24)):
        got = R.rank(docs, spark.createDataFrame(items, "item_id long, text string"), k=k, cells=cells)
        assert ranked(got) == brute(rows, items, k)


def test_awkward_rows(spark, awkward):
    items = [(1, "The SAME words; word5 word976"), (2, None), (3, ""), (4, "!?"), (5, "éa ñ \U0001f600 x")]
    table = spark.createDataFrame([(*i, 1, 2, 3) for i in items], "item_id long, text string, rank int, item int, doc_id int")
    assert ranked(R.rank(awkward, table)) == brute(pairs(awkward), items)
    assert R.rank(awkward.limit(0), table).count() == 0 and R.rank(awkward, table.limit(0)).count() == 0
    nothing = spark.createDataFrame([(1, None), (2, " .,")], "doc_id long, text string")
    assert R.rank(nothing, table).count() == 0


def test_summaries_bound_every_document_of_their_block(spark, documents, sf_dir):
    """Blocks hold their lists' documents once each, and are skipped only below a true bound."""
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    q = R.Queries.build(items)
    shared = spark.sparkContext.broadcast(q)
    rows = R.postings(documents, shared, 4096).cache()
    stats = R.Statistics.gather(rows, len(q.vocabulary))
    floor = R.first_bounds(rows, shared, stats, 50)
    partners, blocks = q.partners(), 0
    for row in R.build_index(rows, shared, stats, floor).collect():
        a = {c: np.frombuffer(row[c], kind) for c, kind in R.ARRAYS.items()}
        x = R.matrix(len(row.doc_id), len(stats.weight), a["ends"], a["term"], a["impact"])
        lists, cells = np.r_[0, a["list_ends"]], np.r_[0, a["summary_ends"]]
        ends = np.r_[0, a["block_ends"]]
        for j, t in enumerate(a["list_term"].tolist()):
            summary = a["summary"][cells[j] : cells[j + 1]].reshape(lists[j + 1] - lists[j], -1)
            members = [a["block_docs"][ends[b] : ends[b + 1]] for b in range(lists[j], lists[j + 1])]
            assert sorted(np.concatenate(members).tolist()) == np.flatnonzero(x[:, t]).tolist() and max(map(len, members)) <= R.BLOCK
            for s, docs in zip(summary, members):
                assert (s == x[np.ix_(docs, partners[t])].max(axis=0)).all()
            blocks += len(members)
    assert blocks > 100


class Plain:
    """A table whose mapInArrow gives the function itself."""

    def select(self, *columns):
        return self

    def mapInArrow(self, function, schema):
        return function


def test_a_worker_holds_one_shard_and_few_terms():
    """Peaks over many texts: a matrix and what is made of it, whatever the number of texts; packed rows are small."""
    rng = np.random.default_rng(3)
    words = np.array([f"word{i}" for i in range(20000)])
    draw = lambda n: " ".join(words[(20000 * rng.random(n) ** 3).astype(int)])
    q = R.Queries.build([(i, draw(60)) for i in range(100)])
    size, shared = len(q.vocabulary), SimpleNamespace(value=q)
    batch = pa.RecordBatch.from_arrays([pa.array(range(8000), pa.int64()), pa.array([draw(150) for _ in range(8000)])], names=["doc_id", "text"])

    def run(function, batches):
        tracemalloc.start()
        out = list(function(batches))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return out, peak / 1e6

    rows, cutting = run(R.postings(Plain(), shared, R.CELLS // size), [batch])
    weight = np.full(size, 3000, np.int64)
    stats = R.Statistics(8000, 8000 * 150, weight)
    floor = np.ones(100, np.int64)
    index, building = run(R.build_index(Plain(), shared, stats, floor, packed=True), rows)
    found, searching = run(R.search_index(Plain(), shared, stats, floor, 50), index)
    assert len(rows) >= 2 and found[0].num_rows == 5000
    assert cutting < 30 and building < 90 and searching < 60, (cutting, building, searching)
    plain = list(R.build_index(Plain(), shared, stats, floor)(rows))
    assert sum(r.nbytes for r in index) < 0.6 * sum(r.nbytes for r in plain)
    for a, kind in R.ARRAYS.items():
        for x, y in zip(index, plain):
            assert (R.unpack(x.column(a)[0], kind) == np.frombuffer(y.column(a)[0].as_py(), kind)).all()


def test_row_groups_of_large_rows(spark):
    rows = [(i, random.Random(i).randbytes(1 << 20)) for i in range(40)]
    table = materialize(spark.createDataFrame(rows, "i long, x binary").coalesce(1), "large-rows", 4 << 20)
    files = [pq.ParquetFile(p) for p in Path(table.inputFiles()[0].removeprefix("file://")).parent.glob("*.parquet")]
    groups = [f.metadata.row_group(g).num_rows for f in files for g in range(f.metadata.num_row_groups)]
    assert max(groups) <= 6 and sorted(map(tuple, table.collect())) == rows


def test_items_of_many_terms_are_searched_in_runs(spark):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(rng.choices(words, k=40))) for i in range(300)]
    items = [(i, " ".join(rng.sample(words, 30))) for i in range(9)] + [(50, " ".join(words)), (51, "w1")]
    assert [len(x) for x in R.narrow(items, 4 * 900)] == [4, 4, 1, 1, 1]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert ranked(R.rank(docs, spark.createDataFrame(items, "item_id long, text string"), k=5, item_pairs=4 * 900)) == brute(rows, items, 5)
