"""Quartile bucket digests of whole texts.

A window of five bytes gives six triplets that hold its first byte; each is hashed into one of ``BUCKETS``
counters. A bucket's code is the quartile of all counters that it lies in (two bits). The digest is the
length on a log scale and the codes in hex. Two digests are compared by a bounded difference score: code
steps of 1, 2 and 3 cost 1, 2 and 6, lengths cost by octave, and the likeness is 1 less the score over
what independent codes score on average (0 at least).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retort.llm.common import byte_slices, materialize, texts_of

BUCKETS = 512
SHIFT = np.uint32(32 - BUCKETS.bit_length() + 1)
#: Offsets of the triplets in a window, and one table of hash terms for each place in a triplet.
TRIPLETS = ((0, 1, 2), (0, 1, 3), (0, 2, 3), (0, 1, 4), (0, 2, 4), (0, 3, 4))
TERMS = np.random.default_rng(20240229).integers(0, 1 << 32, (3, 256), dtype=np.uint32)
SALTS = np.arange(1, 7, dtype=np.uint32) * np.uint32(0x9E3779B1)
STEP = np.array([0, 1, 2, 6])
#: Mean cost of two independent codes.
CHANCE = 1.625
#: Eighths of an octave of length that cost as much as independent codes.
LENGTHS = 60


def digest(data: bytes) -> bytes:
    """One byte of length, then BUCKETS / 4 bytes of codes."""
    x = np.frombuffer(data + bytes(max(0, 5 - len(data))) if data else b"", np.uint8)
    counts = np.zeros(BUCKETS, np.int64)
    for i in range(0, max(0, len(x) - 4), 1 << 20):
        part = x[i : i + (1 << 20) + 4]
        a, b, c = (t[part] for t in TERMS)
        n = len(part) - 4
        for (p, q, r), salt in zip(TRIPLETS, SALTS):
            counts += np.bincount((a[p : p + n] + b[q : q + n] + c[r : r + n] + salt) >> SHIFT, minlength=BUCKETS)
    q1, q2, q3 = np.sort(counts)[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    codes = (counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)
    packed = codes[0::4] << 6 | codes[1::4] << 4 | codes[2::4] << 2 | codes[3::4]
    return bytes([min(255, round(8 * np.log2(len(data) + 1)))]) + packed.astype(np.uint8).tobytes()


def likeness(a: bytes, b: bytes) -> float:
    """1 for equal digests, 0 for those as different as unrelated texts or more."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    cost = 0
    for shift in (0, 2, 4, 6):
        cost += STEP[np.abs((x[1:] >> shift & 3).astype(np.int64) - (y[1:] >> shift & 3))].sum()
    score = cost / BUCKETS / CHANCE + abs(int(x[0]) - int(y[0])) / LENGTHS
    return float(max(0.0, 1 - score))


def edit(text: str, following: str) -> str:
    """``text`` with its last half replaced by the first as many code points of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compare(text: str, fp: bytes, following: str, following_fp: bytes) -> tuple:
    data = edit(text, following).encode("utf-8", "surrogatepass")
    changed = digest(data)
    return len(text), hashlib.sha256(data).hexdigest(), fp, changed, likeness(fp, changed), likeness(fp, following_fp)


RESULT = "n_chars long, edited_sha256 string, fp binary, edited_fp binary, near_edited double, near_next double"
RESULT_TYPES = (pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64())


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every row.

    The next document is the one after it by descending doc_id (nulls last, equal ids by text), and the
    first after the last. Rows are range-partitioned by id and sorted, so each meets its successor in the
    same task; only the rows at the ends of partitions are matched up afterwards. A null text is empty; a
    single row is its own next; an empty table gives none; other columns are not read."""
    order = [F.col("doc_id").desc_nulls_last(), F.col("text")]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.repartitionByRange(order[0]).sortWithinPartitions(*order)

    def run(batches):
        part = TaskContext.get().partitionId()
        last, out = None, []

        def batch_of(found):
            cols = list(zip(*found)) if found else [[] for _ in range(10)]
            types = (pa.int32(), pa.string(), pa.int64(), *RESULT_TYPES, pa.string())
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types)],
                                              names=["part", "role", "doc_id", *[f.split()[0] for f in RESULT.split(", ")], "text"])

        none = (None,) * len(RESULT_TYPES)
        for batch in batches:
            for piece in byte_slices(batch, "text"):
                for doc_id, text in zip(piece.column("doc_id").to_pylist(), texts_of(piece)):
                    fp = digest(text.encode("utf-8", "surrogatepass"))
                    if last is None:
                        out.append((part, "first", doc_id, None, None, fp, None, None, None, text))
                    else:
                        out.append((part, "row", last[0], *_compare(last[1], last[2], text, fp), None))
                    last = doc_id, text, fp
                yield batch_of(out)
                out = []
        if last is not None:
            yield batch_of([(part, "last", last[0], None, None, last[2], *none[3:], last[1])])

    found = materialize(rows.mapInArrow(run, f"part int, role string, doc_id long, {RESULT}, text string"), "digests")
    # One first and one last row for each partition that has rows.
    first = found.where("role = 'first'").select("part", F.col("text").alias("following"), F.col("fp").alias("following_fp"))
    places = found.where("role = 'first'").select("part")
    after = F.lead("part").over(Window.orderBy("part"))
    start = F.first("part").over(Window.orderBy("part"))
    places = places.select(F.col("part").alias("here"), F.coalesce(after, start).alias("part"))
    ends = found.where("role = 'last'").select(F.col("part").alias("here"), "doc_id", "text", "fp")
    ends = ends.join(places, "here").join(first, "part").select("doc_id", "text", "fp", "following", "following_fp")

    def finish(batches):
        for b in batches:
            cols = [b.column(c).to_pylist() for c in ("text", "fp", "following", "following_fp")]
            made = [_compare(*x) for x in zip(*cols)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id")] + [pa.array(list(c), t) for c, t in zip(zip(*made) if made else [[]] * 6, RESULT_TYPES)],
                                             names=["doc_id", *[f.split()[0] for f in RESULT.split(", ")]])

    done = found.where("role = 'row'").drop("part", "role", "text").unionByName(ends.mapInArrow(finish, f"doc_id long, {RESULT}"))
    text = lambda c: F.lower(F.hex(c))
    return done.select("doc_id", "n_chars", "edited_sha256", text("fp").alias("fingerprint"), text("edited_fp").alias("edited_fingerprint"), "near_edited", "near_next")
