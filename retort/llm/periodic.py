"""Periodic runs of words by a dictionary of basic factors.

A run is a stretch of words with smallest period q, at least three periods long, that no neighbouring word
extends. For each power of two, l, the dictionary names the l words from every place on: equal names, equal
words. Names of 2l words are those of pairs of names. At each length the *successor* of a place is the next
place with its name; within a run whose period is at most l, successors stand exactly q apart and so form an
arithmetic progression:

* a run of period q, l/2 < q <= l, has at least 3q > q + l words, so its first place has its factor again q
  words on;
* an occurrence nearer than q would give the run a second period below q over q + l words, and by the theorem
  of Fine and Wilf a smaller period than its smallest.

So the places whose successor is d away, l/2 < d <= l, fall into stretches of consecutive places, and a
stretch from i to j is a maximal run of words i to j + l + d with smallest period d. Each period belongs to one
length only: no run is proposed twice. Only one length's names are held at a time, and places whose factor
occurs once are left out of all further lengths.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retort.llm.common import bytes_of, per_text

LEAST_WORDS = 24
LEAST_PERIODS = 3


def runs_of(ids: np.ndarray, least_words: int = LEAST_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs of the numbers ``ids``, by start, then period."""
    found = []
    name, at, size = ids, np.arange(len(ids)), 1  # names of the places ``at`` in order, others have none
    while len(at):
        order = np.argsort(name, kind="stable")
        same = name[order[1:]] == name[order[:-1]]
        gap = np.zeros(len(at), np.int64)  # to the successor
        gap[order[:-1][same]] = (at[order[1:]] - at[order[:-1]])[same]
        near = (gap > size // 2) & (gap <= size)
        place, gap = at[near], gap[near]
        if len(place):
            first = np.r_[True, (np.diff(place) != 1) | (np.diff(gap) != 0)]
            last = np.r_[first[1:], True]
            period = gap[first]
            found.append((place[first], place[last] - place[first] + size + period, period))
        # names of twice the size, where both halves occur more than once
        again = np.zeros(len(at), bool)
        again[order[1:][same]] = True
        again[order[:-1][same]] = True
        fresh = np.r_[True, ~same]
        names = np.empty(len(at), np.int64)
        names[order] = np.cumsum(fresh) - 1
        at, names = at[again], names[again]
        second = np.searchsorted(at, at + size)
        second[second == len(at)] = 0
        whole = at[second] == at + size if len(at) else np.empty(0, bool)
        name = names[whole] * (len(fresh) + 1) + names[second[whole]]
        at, size = at[whole], size * 2
    start, length, period = (np.concatenate([f[i] for f in found]) if found else np.empty(0, np.int64) for i in range(3))
    enough = length >= np.maximum(least_words, LEAST_PERIODS * period)
    start, length, period = start[enough], length[enough], period[enough]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def stretched(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The planted periods of the contract: by its id a document may repeat a stretch of its words to the end."""
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def periodic_runs(docs: DataFrame, plant: bool = False, least_words: int = LEAST_WORDS) -> DataFrame:
    """(doc_id, n_words, runs array<struct<start, length, period>>, kept) of every row: all runs of its words by
    start, then period, and the text without repeats, its words joined by single spaces. A word is dropped if
    a run holds it after that run's first period. ``plant`` repeats words first, as ``stretched`` does.

    Words are separated by ASCII blanks. A null text has no words, like an empty one; a null id plants
    nothing; repeated rows have a row each; an empty table gives none; other columns are not read. The texts
    of a slice are searched together; a word is told apart by its document, so no run spans two."""
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batch):
        ids = batch.column("doc_id").cast(pa.int64())
        texts = [t.split() for t in bytes_of(batch)]
        if plant:
            texts = [stretched(w, d) for w, d in zip(texts, ids.to_pylist())]
        sizes = np.array([len(w) for w in texts], np.int64)
        number: dict[bytes, int] = {}
        words = np.fromiter((number.setdefault(w, len(number)) for t in texts for w in t), np.int64, int(sizes.sum()))
        owner = np.repeat(np.arange(len(texts)), sizes)
        start, length, period = runs_of(words + owner * len(number), least_words)
        first = np.cumsum(sizes) - sizes
        doc = owner[start]
        start = start - first[doc]
        gone = np.zeros(len(words) + 1, np.int64)
        np.add.at(gone, first[doc] + start + period, 1)
        np.add.at(gone, first[doc] + start + length, -1)
        gone = np.cumsum(gone) > 0
        hit = np.bincount(doc, minlength=len(texts)) > 0
        kept = [b" ".join([x for x, g in zip(t, gone[f : f + n].tolist()) if not g] if some else t) for t, f, n, some in zip(texts, first, sizes, hit)]
        ends = np.r_[0, np.cumsum(np.bincount(doc, minlength=len(texts)))].astype(np.int32)
        runs = pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays([pa.array(x) for x in (start, length, period)], fields=list(run_type.value_type)))
        return pa.RecordBatch.from_arrays([ids, pa.array(sizes), runs, pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "runs", "kept"])

    return per_text(docs, "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, kept string", run)


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns from ``periodic_runs``. Exponents are compared as whole numbers: a run of length
    and period (x, p) exceeds (y, q) if x * q > y * p."""
    better = "aggregate(runs, named_struct('start', bigint(null), 'length', bigint(null), 'period', bigint(null)), " \
             "(a, r) -> if(a.start is null or r.length * a.period > a.length * r.period, r, a))"
    lines = F.concat_ws("", F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))))
    return found.withColumn("best", F.expr(better)).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("kept").cast("binary"), 256).alias("collapsed_sha256"))
