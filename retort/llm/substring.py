"""Substring dedup by super-k-mer partitioning: words of 50-word windows that an earlier document has too.

Each window has a minimiser, the least hash of its word m-grams. Consecutive windows that share one form a
super-k-mer, which travels as a single packed string to the bucket of its minimiser; equal windows have
equal minimisers, so they meet there, where sorting finds for each window its earliest document, exactly.

* Exact copies of a text are one text: every copy but the earliest loses all its windows.
* Minimisers that only one text has cannot hold shared windows; a first pass over (minimiser, text) counts
  finds them, so only super-k-mers of shared minimisers are packed and sent.
* A bucket with more words than ``hot`` (a boilerplate passage that a third of the rows hold) is not
  gathered in one task: its windows are keyed by their 128-bit hash and go through an aggregated minimum and
  a join, both of which split.
* A super-k-mer is cut at ``LONGEST`` windows (one word said on and on would be a single one), and a bucket
  is sorted as numbers of words, so a task holds ``hot`` words whatever the texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retort.llm.common import byte_slices, bytes_of, materialize

#: Words of the m-grams that minimisers are taken from.
GRAM = 12
#: Windows of a super-k-mer at most; longer ones are cut.
LONGEST = 512
#: Words in the super-k-mers of one minimiser that a task sorts at once.
HOT = 1 << 17
ODD = np.uint64(0x9E3779B97F4A7C15)
LAST = (1 << 63) - 1


def super_kmers(words: list[bytes], window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(minimiser, first window, windows) of the super-k-mers of one text of at least ``window`` words."""
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = len(words) - gram + 1
    g = np.zeros(n, np.uint64)
    for j in range(gram):
        g = g * ODD + h[j : j + n]
    g ^= g >> np.uint64(29)
    g *= np.uint64(0xBF58476D1CE4E5B9)
    g ^= g >> np.uint64(32)
    width, least, have = window - gram + 1, g, 1  # the least of ``width`` m-grams, by doubling
    while have * 2 <= width:
        least, have = np.minimum(least[:-have], least[have:]), have * 2
    if have < width:
        step = width - have
        least = np.minimum(least[:-step], least[step:])
    first = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
    n = np.diff(np.r_[first, len(least)])
    # a long one goes in parts that share window - 1 words, so each window is in one part
    parts = -(-n // LONGEST)
    at = np.repeat(first, parts) + LONGEST * (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts))
    return np.repeat(least[first], parts).view(np.int64), at, np.minimum(LONGEST, np.repeat(first + n, parts) - at)


def names_of(words: np.ndarray, window: int) -> np.ndarray:
    """A name for the ``window`` words from each place on: equal names, equal words. ``words`` are numbers;
    the names of 1, 2, 4, ... words are paired and sorted, the last pair overlaps."""
    have = 1
    while have < window:
        step = min(have, window - have)
        left, right = words[:-step], words[step:]
        order = np.lexsort((right, left))
        a, b = left[order], right[order]
        rank = np.cumsum(np.r_[0, (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
        words = np.empty(len(left), np.int64)
        words[order] = rank
        have += step
    return words


def _settle(rows, window: int):
    """Of one minimiser's (text, rank, start, packed): (text, from, to) of words that a window covers which
    an earlier rank has. All windows are named by sorting their words, so equal ones meet exactly."""
    if len({r[0] for r in rows}) < 2:
        return
    number: dict[bytes, int] = {}
    words = [[number.setdefault(w, len(number)) for w in r[3].split(b" ")] for r in rows]
    n = np.array([len(w) for w in words])
    flat = np.fromiter((x for w in words for x in w), np.int64, int(n.sum()))
    begin = np.cumsum(n) - n
    names = names_of(flat, window)
    own = np.repeat(np.arange(len(rows)), n - window + 1)  # windows inside one packed string
    place = np.arange(len(own)) - np.repeat(np.cumsum(n - window + 1) - (n - window + 1), n - window + 1)
    name = names[begin[own] + place]
    rank = np.array([r[1] for r in rows], np.int64)
    best = np.full(int(names.max()) + 1, LAST, np.int64)
    np.minimum.at(best, name, rank[own])
    late = np.flatnonzero(best[name] < rank[own])
    if not len(late):
        return
    first = np.r_[True, (own[late][1:] != own[late][:-1]) | (place[late][1:] != place[late][:-1] + 1)]
    heads = late[first]
    tails = late[np.r_[np.flatnonzero(first)[1:] - 1, len(late) - 1]]
    for i, x, y in zip(own[heads].tolist(), place[heads].tolist(), place[tails].tolist()):
        yield rows[i][0], rows[i][2] + x, rows[i][2] + y + window


def _earliest(groups, window: int):
    """``_settle`` over (minimiser, text, rank, start, packed) rows sorted by minimiser. One minimiser's rows
    are held at a time: ``hot`` words at most."""
    rows, at = [], None
    for r in groups:
        if r[0] != at:
            yield from _settle(rows, window)
            rows, at = [], r[0]
        rows.append(r[1:])
    yield from _settle(rows, window)


def remove_repeats(docs: DataFrame, window: int = 50, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) of every row; ``kept`` is the text of the words left, joined by
    single spaces.

    A word goes when a window of ``window`` words that covers it also starts in a document with a smaller
    doc_id; windows are those of the input. Words are separated by ASCII blanks, unchanged otherwise. A null
    or empty text has no words; a null doc_id counts as larger than any; rows with one doc_id are judged
    apart and do not remove each other's words; an empty table gives none; other columns are not read."""
    rank = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))
    body = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), rank.alias("rank"), body.alias("text"), F.unhex(F.md5(body.cast("binary"))).alias("text_key"))
    # One row for each distinct text: the earliest of its copies stands for them.
    texts = materialize(rows.groupBy("text_key").agg(F.min("rank").alias("rank")), "substring-texts")

    def cut(batches):
        for batch in batches:
            for part in byte_slices(batch, "text"):
                out = []
                for key, text in zip(part.column("text_key").to_pylist(), bytes_of(part)):
                    words = text.split()
                    if len(words) >= window:
                        m, start, n = super_kmers(words, window, gram)
                        out.append(([key] * len(m), m, start, n))
                keys = [k for x in out for k in x[0]]
                cols = [np.concatenate([x[i] for x in out]) if out else np.empty(0, np.int64) for i in (1, 2, 3)]
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(cols[0]), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64())],
                                                 names=["text_key", "minimiser", "start", "windows"])

    # Copies give the same super-k-mers, so a minimiser is shared if more than one distinct text has it.
    pieces = rows.select("text_key", "text").mapInArrow(cut, "text_key binary, minimiser long, start long, windows long")
    pieces = materialize(pieces, "super-k-mers")
    shared = pieces.groupBy("minimiser").agg(F.min(F.xxhash64("text_key")).alias("a"), F.max(F.xxhash64("text_key")).alias("b"), F.sum(F.col("windows") + F.lit(window - 1)).alias("n")).where("a != b").select("minimiser", "n")
    wanted = pieces.join(materialize(shared, "shared-minimisers"), "minimiser").select("text_key", F.struct("minimiser", "start", "windows", (F.col("n") > hot).alias("hot")).alias("piece"))
    wanted = wanted.groupBy("text_key").agg(F.collect_set("piece").alias("pieces"))  # of one text at most
    wanted = materialize(wanted.join(texts, "text_key"), "wanted-pieces")

    def pack(batches):
        for batch in batches:
            for part in byte_slices(batch, "text"):
                out = []
                for key, place, text, pieces in zip(part.column("text_key").to_pylist(), part.column("rank").to_pylist(), bytes_of(part), part.column("pieces").to_pylist()):
                    words = text.split()
                    out += [(p["minimiser"], p["hot"], key, place, p["start"], b" ".join(words[p["start"] : p["start"] + p["windows"] + window - 1])) for p in pieces]
                cols = list(zip(*out)) if out else [[]] * 6
                types = (pa.int64(), pa.bool_(), pa.binary(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types)], names=["minimiser", "hot", "text_key", "rank", "start", "packed"])

    # The text of each stays with its earliest row; a repeated row packs the same strings again, which settle as one text.
    packed = rows.join(wanted, ["text_key", "rank"]).select("text_key", "rank", "text", "pieces").mapInArrow(
        pack, "minimiser long, hot boolean, text_key binary, rank long, start long, packed binary")

    def sort(batches):
        def stream():
            for b in batches:
                yield from zip(*(b.column(c).to_pylist() for c in ("minimiser", "text_key", "rank", "start", "packed")))

        out = []
        for x in _earliest(stream(), window):
            out.append(x)
            if len(out) >= 20000:
                yield spans_of(out)
                out = []
        yield spans_of(out)

    def spans_of(out):
        cols = list(zip(*out)) if out else [[]] * 3
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, (pa.binary(), pa.int64(), pa.int64()))], names=["text_key", "a", "b"])

    packed = materialize(packed, "packed-super-k-mers")
    columns = ("minimiser", "text_key", "rank", "start", "packed")
    bucketed = packed.where("not hot").select(*columns).repartition("minimiser").sortWithinPartitions("minimiser")
    spans = bucketed.mapInArrow(sort, "text_key binary, a long, b long")

    def unpack(batches):
        """A row for each different window of a super-k-mer, with the runs of words that it covers there:
        a word said a thousand times over is one window in a thousand places."""
        for batch in batches:
            for part in byte_slices(batch, "packed", 1 << 20):
                out = []
                for key, place, start, data in zip(*(part.column(c).to_pylist() for c in ("text_key", "rank", "start", "packed"))):
                    words, runs = data.split(b" "), {}
                    for i in range(len(words) - window + 1):
                        own = runs.setdefault(xxhash.xxh3_128_digest(b" ".join(words[i : i + window])), [])
                        if own and own[-1]["b"] >= start + i:
                            own[-1]["b"] = start + i + window
                        else:
                            own.append({"a": start + i, "b": start + i + window})
                    out += [(h, key, place, own) for h, own in runs.items()]
                cols = list(zip(*out)) if out else [[]] * 4
                run = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, (pa.binary(), pa.binary(), pa.int64(), run))], names=["key", "text_key", "rank", "runs"])

    windows = packed.where("hot").mapInArrow(unpack, "key binary, text_key binary, rank long, runs array<struct<a: long, b: long>>")
    least = windows.groupBy("key").agg(F.min("rank").alias("least"))
    late = windows.join(least, "key").where("least < rank").select("text_key", F.explode("runs").alias("r")).select("text_key", "r.a", "r.b")
    covered = spans.unionByName(late).groupBy("text_key").agg(F.collect_list(F.struct("a", "b")).alias("spans"))  # of one text at most
    covered = materialize(covered, "covered-words")

    def keep(batches):
        for batch in batches:
            for part in byte_slices(batch, "text"):
                n, removed, kept = [], [], []
                copy = part.column("later_copy").to_pylist()
                for text, later, spans in zip(bytes_of(part), copy, part.column("spans").to_pylist()):
                    words = text.split()
                    n.append(len(words))
                    if later and len(words) >= window:
                        words = []
                    elif spans:
                        gone = np.zeros(len(words) + 1, np.int64)
                        np.add.at(gone, [s["a"] for s in spans], 1)
                        np.add.at(gone, [s["b"] for s in spans], -1)
                        words = [w for w, c in zip(words, np.cumsum(gone).tolist()) if c == 0]
                    removed.append(n[-1] - len(words))
                    kept.append(b" ".join(words))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                                                 names=["doc_id", "n_words", "n_removed", "kept"])

    first = texts.select("text_key", F.col("rank").alias("first"))
    full = rows.join(first, "text_key").withColumn("later_copy", F.col("rank") > F.col("first")).join(covered, "text_key", "left")
    return full.select("doc_id", "text", "later_copy", "spans").mapInArrow(keep, "doc_id long, n_words long, n_removed long, kept string")


def digest(kept: DataFrame) -> DataFrame:
    """The contract's columns from ``remove_repeats``."""
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
