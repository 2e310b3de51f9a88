"""Ranked lexical search with per-term geometric blocking, exact.

An item's score for a document is a sum over the item's terms of weight times impact, whole numbers all. The
documents are indexed in *shards* (the rows of a slice of texts), each small enough for one task. The arrays of a
shard are stored compressed, so that Spark holds, writes and sends a fraction of them and a worker opens one shard at a time:

* A shard holds its documents' impacts by term, and posting lists for the terms that can decide. A list is
  cut into blocks by geometry: its documents go to the most similar of a few pivots of the list (by sketches,
  random projections of their weighted impacts), and each pivot's documents make blocks.
* A block stores its *summary*: coordinate by coordinate the greatest impact of its documents, over the terms
  of all items that hold the list's term. A summary times an item's weights bounds the score of every
  document in the block.
* A search takes an item's terms by what they can add at most. Terms that cannot reach the 50th best score
  together need not be opened; in the lists of the others a block is skipped if its summary's bound is below
  that score, which rises as results come in. All other blocks' documents are scored in full.

The 50th best score starts from a bounded sample of shards: the 50th best of any part is a true lower bound
of the whole's, so the sample decides speed and never results. Items are the query set, taken in blocks of
bounded bytes and pairs of terms; all documents are searched for each. Statistics cover all documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retort.llm.common import byte_slices, bytes_of, materialize

#: Text bytes of the items searched for at a time: bounds the vocabulary and weights that are broadcast.
ITEM_BYTES = 1 << 20
#: Pairs of terms of one item, over the items searched for at a time: bounds the width of all summaries together.
ITEM_PAIRS = 1 << 22
#: Text bytes of documents cut into terms at a time: bounds the terms that a worker holds as objects.
TEXT_BYTES = 1 << 20
#: Documents times terms of a shard's impact matrix.
CELLS = 1 << 23
#: Documents whose rows of the matrix are made into sketches at a time.
ROWS = 256
#: Bytes of a row group of the stored shards: a reader and a writer hold one.
GROUP_BYTES = 16 << 20
#: Documents of a block; lists up to this long are a single block.
BLOCK = 48
#: Dimensions of the sketches that documents are clustered by.
SKETCH = 24
#: Documents, about, whose shards give the first lower bounds.
SEEDS = 1 << 14
#: Rows of one item that meet in a task before the last: the best of each share go on.
SHARES = 64
LAST = (1 << 63) - 1
#: Lower-cased term characters; all other ASCII characters part terms.
TABLE = bytes(ord(chr(c).lower()) if c < 128 and chr(c).isalnum() else 32 if c < 128 else c for c in range(256))


def terms(text: bytes) -> list[bytes]:
    return text.translate(TABLE).split()


@dataclass
class Queries:
    """A block of items over a common vocabulary; ``parts`` are their different terms."""
    ids: list
    parts: list[np.ndarray]
    vocabulary: dict[bytes, int]

    @classmethod
    def build(cls, rows: list[tuple]) -> Queries:
        vocabulary: dict[bytes, int] = {}
        parts = [np.array(sorted({vocabulary.setdefault(t, len(vocabulary)) for t in terms((text or "").encode())}), np.int64) for _, text in rows]
        return cls([i for i, _ in rows], parts, vocabulary)

    def partners(self) -> list[np.ndarray]:
        """For each term the terms of the items that hold it, itself among them."""
        found: list[list[np.ndarray]] = [[] for _ in self.vocabulary]
        for p in self.parts:
            for t in p.tolist():
                found[t].append(p)
        return [f[0] if len(f) == 1 else np.unique(np.concatenate(f)) for f in found]


def narrow(rows: list[tuple], pairs: int) -> Iterator[list[tuple]]:
    """Items in runs of at most ``pairs`` pairs of terms of one item (one item at least)."""
    run, total = [], 0
    for row in rows:
        more = len(set(terms((row[1] or "").encode()))) ** 2
        if run and total + more > pairs:
            yield run
            run, total = [], 0
        run.append(row)
        total += more
    if run:
        yield run


# ------------------------------------------------------------------ stored arrays
def pack(x: np.ndarray) -> bytes:
    return x.nbytes.to_bytes(8, "little") + pa.compress(x.tobytes(), codec="zstd", asbytes=True)


def unpack(cell: pa.BinaryScalar, kind: type) -> np.ndarray:
    data = cell.as_buffer()
    size = int.from_bytes(data[:8].to_pybytes(), "little")
    return np.frombuffer(pa.decompress(data[8:], size, codec="zstd"), kind) if size else np.empty(0, kind)


# ------------------------------------------------------------------ postings
POSTINGS = "doc_id array<long>, n binary, ends binary, term binary, tf binary"


def counted(part: pa.RecordBatch, number: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Term counts of all texts, and ascending keys (text times len(number), plus term) of the numbered terms with their counts."""
    n, keys, times = [], [], []
    for some in byte_slices(part, "text", TEXT_BYTES):
        words = [terms(t) for t in bytes_of(some)]
        here = np.array([len(w) for w in words], np.int64)
        ids = np.fromiter(map(number.get, chain.from_iterable(words), repeat(-1)), np.int64, int(here.sum()))
        key = np.repeat(np.arange(len(n), len(n) + len(here)), here) * len(number) + ids
        key, tf = np.unique(key[ids >= 0], return_counts=True)
        n += here.tolist()
        keys.append(key)
        times.append(tf)
    return np.array(n, np.int64), np.concatenate(keys), np.concatenate(times)


def postings(docs: DataFrame, queries, most: int) -> DataFrame:
    """Shards of at most ``most`` documents: ids, term counts n, and by document the vocabulary's terms in it."""
    def cut(batches):
        number = queries.value.vocabulary
        for batch in batches:
            for piece in byte_slices(batch, "text"):
                step = math.ceil(piece.num_rows / math.ceil(piece.num_rows / most))
                for k in range(0, piece.num_rows, step):
                    part = piece.slice(k, step)
                    n, key, tf = counted(part, number)
                    ends = np.searchsorted(key // len(number), np.arange(len(n)), side="right")
                    doc_id = part.column("doc_id").cast(pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [pa.ListArray.from_arrays(pa.array([0, len(n)], pa.int32()), doc_id),
                         *[pa.array([pack(x)], pa.binary()) for x in (n, ends.astype(np.int64), (key % len(number)).astype(np.int32), tf.astype(np.int64))]],
                        names=["doc_id", "n", "ends", "term", "tf"])

    return docs.select("doc_id", "text").mapInArrow(cut, POSTINGS)


def shards(batches):
    """The rows of ``postings`` one by one: (ids, n, ends, term, tf)."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield (batch.column("doc_id")[i].values, *[unpack(batch.column(c)[i], kind) for c, kind in (("n", np.int64), ("ends", np.int64), ("term", np.int32), ("tf", np.int64))])


@dataclass
class Statistics:
    """N, L and the weights of the vocabulary's terms, over all documents."""
    documents: int
    words: int
    weight: np.ndarray

    @classmethod
    def gather(cls, rows: DataFrame, size: int) -> Statistics:
        def count(batches):
            total = np.zeros(size + 2, np.int64)
            for _, n, _, term, _ in shards(batches):
                total[:size] += np.bincount(term, minlength=size)
                total[size:] += ((n > 0).sum(), n.sum())
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["term", "n"])

        sums = rows.mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()  # a row a term of the item block
        total = dict(map(tuple, sums))
        documents, words = (total.get(size + i, 0) for i in range(2))
        weight = [math.floor(1000 * math.log((2 * documents + 2) / (2 * total.get(t, 0) + 1))) for t in range(size)]
        return cls(documents, words, np.array(weight, np.int64))

    def impacts(self, n: np.ndarray, ends: np.ndarray, tf: np.ndarray) -> np.ndarray:
        lengths, which = np.unique(n, return_inverse=True)
        m = np.array([100 - 50 + 50 * x * self.documents // max(1, self.words) for x in lengths.tolist()], np.int64)[which]
        m = np.repeat(m, np.diff(ends, prepend=0))
        return 1000000000 * tf // (1000 * tf + 20 * m)


def matrix(docs: int, size: int, ends: np.ndarray, term: np.ndarray, impact: np.ndarray) -> np.ndarray:
    x = np.zeros((docs, size), np.int32)
    x[np.repeat(np.arange(docs), np.diff(ends, prepend=0)), term] = impact
    return x


# ------------------------------------------------------------------ results so far
class Best:
    """The ``k`` best (score, doc_id) of each item, equal scores by id, null ids last, and the score to reach."""

    def __init__(self, items: int, k: int, floor: np.ndarray):
        self.k, self.floor = k, np.maximum(floor, 1)
        self.score = [np.empty(0, np.int64)] * items
        self.key = [np.empty(0, np.int64)] * items
        self.null = [np.empty(0, bool)] * items

    def add(self, item: int, score: np.ndarray, key: np.ndarray, null: np.ndarray) -> None:
        good = score >= self.floor[item]
        if not good.any():
            return
        score, key, null = (np.concatenate([old[item], new[good]]) for old, new in ((self.score, score), (self.key, key), (self.null, null)))
        order = np.lexsort((null, key, -score))[: self.k]
        self.score[item], self.key[item], self.null[item] = score[order], key[order], null[order]
        if len(order) == self.k:
            self.floor[item] = max(self.floor[item], score[order[-1]])

    def rows(self) -> pa.RecordBatch:
        item = np.repeat(np.arange(len(self.score)), [len(s) for s in self.score])
        score, key, null = (np.concatenate([*x, x[0][:0]]) if x else np.empty(0, np.int64) for x in (self.score, self.key, self.null))
        return pa.RecordBatch.from_arrays([pa.array(item, pa.int64()), pa.array(key, pa.int64(), mask=null.astype(bool)), pa.array(score, pa.int64())], names=["item", "doc_id", "score"])


FOUND = "item long, doc_id long, score long"


def keys_of(ids: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    null = ids.is_null().to_numpy(zero_copy_only=False)
    return ids.fill_null(LAST).to_numpy(zero_copy_only=False).astype(np.int64), null


def best_of(found: DataFrame, k: int) -> DataFrame:
    """The k best rows of each item with their ``rank``, first among shares of each item's rows, then overall."""
    order = (F.desc("score"), F.asc_nulls_last("doc_id"))
    share = F.pmod(F.xxhash64("doc_id", "score"), F.lit(SHARES))
    few = found.withColumn("share", share).withColumn("rank", F.row_number().over(Window.partitionBy("item", "share").orderBy(*order))).where(F.col("rank") <= k)
    return few.drop("share").withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)


def first_bounds(rows: DataFrame, queries, stats: Statistics, k: int) -> np.ndarray:
    """For each item the k-th best score within shards of about SEEDS documents, 0 where fewer documents match."""
    items = len(queries.value.ids)
    sample = rows.where(F.pmod(F.xxhash64("ends", "term"), F.lit(max(1, stats.documents // SEEDS))) == 0)

    def score(batches):
        best = Best(items, k, np.zeros(items, np.int64))
        for ids, n, ends, term, tf in shards(batches):
            x = matrix(len(n), len(stats.weight), ends, term, stats.impacts(n, ends, tf))
            key, null = keys_of(ids)
            for i, p in enumerate(queries.value.parts):
                best.add(i, x[:, p] @ stats.weight[p], key, null)
            del x  # before the next one is made
        yield best.rows()

    last = best_of(sample.mapInArrow(score, FOUND), k).where(F.col("rank") == k).select("item", "score").collect()  # a row an item
    out = np.zeros(items, np.int64)
    for item, s in last:
        out[item] = s
    return out


# ------------------------------------------------------------------ index
ARRAYS = {"ends": np.int64, "term": np.int32, "impact": np.int32, "list_term": np.int32, "list_ends": np.int64, "block_ends": np.int64,
          "block_docs": np.int32, "summary_ends": np.int64, "summary": np.int32}
INDEX = "doc_id array<long>, " + ", ".join(f"{a} binary" for a in ARRAYS)


def opened(x_max: np.ndarray, part: np.ndarray, weight: np.ndarray, floor: int) -> np.ndarray:
    """The terms of an item whose lists can hold a document of score ``floor``, greatest addend first: the others
    add up to less, so a document that has only those is out."""
    most = x_max[part] * weight[part]
    order = np.argsort(most, kind="stable")
    return part[order[np.searchsorted(np.cumsum(most[order]), floor):]][::-1]


def blocks_of(docs: np.ndarray, sketch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A posting list's documents dealt into blocks of similar ones: (documents in block order, block starts)."""
    if len(docs) <= BLOCK:
        return docs, np.zeros(1, np.int64)
    pivots = sketch[docs[:: BLOCK]]
    nearest = np.argmax(sketch[docs] @ pivots.T, axis=1)
    order = np.argsort(nearest, kind="stable")
    group = nearest[order]
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    within = np.arange(len(docs)) - np.repeat(first, np.diff(np.r_[first, len(docs)]))
    return docs[order], np.flatnonzero(within % BLOCK == 0)


def build_index(rows: DataFrame, queries, stats: Statistics, floor: np.ndarray, packed: bool = False) -> DataFrame:
    """The stored shards: impacts by document, and blocked posting lists with summaries of the terms that some
    item has to open at its first bound. The arrays are plain, or ``packed`` as the search reads them."""
    size = len(stats.weight)

    def build(batches):
        q, partners = queries.value, queries.value.partners()
        rng = np.arange(size * SKETCH, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        signs = np.where((rng ^ rng >> np.uint64(29)) >> np.uint64(40) & np.uint64(1), 1, -1).reshape(size, SKETCH)
        signs = signs.astype(np.float32) * (stats.weight * 1e-6).astype(np.float32)[:, None]
        for ids, n, ends, term, tf in shards(batches):
            impact = stats.impacts(n, ends, tf)
            x = matrix(len(n), size, ends, term, impact)
            x_max = x.max(axis=0, initial=0).astype(np.int64)
            sketch = np.concatenate([x[k : k + ROWS].astype(np.float32) @ signs for k in range(0, max(1, len(n)), ROWS)])
            sketch /= np.maximum(np.linalg.norm(sketch, axis=1, keepdims=True), 1e-9)
            wanted = np.zeros(size, bool)
            for p, f in zip(q.parts, np.maximum(floor, 1).tolist()):
                wanted[opened(x_max, p, stats.weight, f)] = True
            wanted &= x_max > 0
            by_term = np.argsort(term, kind="stable")
            owner = np.repeat(np.arange(len(n)), np.diff(ends, prepend=0))[by_term]
            start = np.searchsorted(term[by_term], np.arange(size + 1))
            out = {"list_term": np.flatnonzero(wanted).astype(np.int32)}
            docs, starts, sums, counts, widths = [], [], [], [], []
            base = 0
            for t in out["list_term"].tolist():
                members, first = blocks_of(owner[start[t] : start[t + 1]], sketch)
                summary = np.maximum.reduceat(x[np.ix_(members, partners[t])], first, axis=0)
                docs.append(members)
                starts.append(np.r_[first[1:], len(members)] + base)
                sums.append(summary.ravel())
                counts.append(len(first))
                widths.append(summary.size)
                base += len(members)
            del x  # before the next one is made
            whole = lambda parts: np.concatenate([*parts, np.empty(0, np.int32)])
            out |= {"ends": ends, "term": term, "impact": impact, "list_ends": np.cumsum(counts), "block_ends": whole(starts),
                    "block_docs": whole(docs), "summary_ends": np.cumsum(widths), "summary": whole(sums)}
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(n)], pa.int32()), ids),
                                              *[pa.array([(pack if packed else np.ndarray.tobytes)(out[a].astype(kind))], pa.binary()) for a, kind in ARRAYS.items()]],
                                             names=["doc_id", *ARRAYS])

    return rows.mapInArrow(build, INDEX)


def search_index(index: DataFrame, queries, stats: Statistics, floor: np.ndarray, k: int) -> DataFrame:
    """(item, doc_id, score) of each task's k best documents of each item with the first bound's score at least;
    ``index`` is packed."""
    size = len(stats.weight)

    def search(batches):
        q, partners = queries.value, queries.value.partners()
        best = Best(len(q.ids), k, floor)
        places: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                a = {c: unpack(batch.column(c)[i], kind) for c, kind in ARRAYS.items()}
                key, null = keys_of(batch.column("doc_id")[i].values)
                x = matrix(len(key), size, a["ends"], a["term"], a["impact"])
                x_max = x.max(axis=0, initial=0).astype(np.int64)
                number = {t: j for j, t in enumerate(a["list_term"].tolist())}
                for item, p in enumerate(q.parts):
                    scored = np.zeros(len(key), bool)
                    weights = stats.weight[p]
                    for t in opened(x_max, p, stats.weight, int(best.floor[item])).tolist():
                        j = number.get(t)
                        if j is None:  # a term that no document of the shard has
                            continue
                        if partners[t] is not p and (item, t) not in places:
                            places[item, t] = np.searchsorted(partners[t], p)
                        first, last = (int(a["list_ends"][j - 1]) if j else 0), int(a["list_ends"][j])
                        low, high = (int(a["summary_ends"][j - 1]) if j else 0), int(a["summary_ends"][j])
                        summary = a["summary"][low:high].reshape(last - first, -1)
                        bound = (summary if partners[t] is p else summary[:, places[item, t]]) @ weights
                        for b in (first + np.flatnonzero(bound >= best.floor[item])[np.argsort(-bound[bound >= best.floor[item]], kind="stable")]).tolist():
                            if bound[b - first] < best.floor[item]:
                                break  # the bound rose meanwhile; the blocks after this have no more
                            docs = a["block_docs"][(int(a["block_ends"][b - 1]) if b else 0) : int(a["block_ends"][b])]
                            docs = docs[~scored[docs]]
                            if len(docs):
                                scored[docs] = True
                                best.add(item, x[np.ix_(docs, p)] @ weights, key[docs], null[docs])
                del a, x  # before the next ones are made
        yield best.rows()

    return index.mapInArrow(search, FOUND)


# ------------------------------------------------------------------ operator
RANKED = "item_id long, rank int, doc_id long, score long"


def rank(docs: DataFrame, items: DataFrame, k: int = 50, item_bytes: int = ITEM_BYTES, cells: int = CELLS, item_pairs: int = ITEM_PAIRS) -> DataFrame:
    """(item_id, rank, doc_id, score) of the ``k`` best documents of each item, scores above 0 only, equal scores by
    ascending doc_id.

    Terms are runs of ASCII letters and digits and of all other characters beyond ASCII, A to Z in lower case.
    A null text has no terms, like an empty one, and is found by nothing; an item without terms finds
    nothing. A null doc_id comes after all others; rows with one doc_id are documents of their own. Repeated
    rows of ``items`` count once; rows with one item_id and other texts are searched apart. Empty tables give
    no rows; other columns are not read."""
    spark = docs.sparkSession
    items = items.select(F.col("item_id").cast("long").alias("item_id"), "text").where(F.length("text") > 0).distinct()
    blocks = math.ceil((items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) / item_bytes)
    out = None
    for b in range(blocks):
        block = [tuple(r) for r in items.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == b).collect()]  # item_bytes, about
        for run in narrow(sorted(block, key=str), item_pairs):
            built = Queries.build(run)
            if not built.vocabulary:
                continue
            queries = spark.sparkContext.broadcast(built)
            size = len(built.vocabulary)
            rows = materialize(postings(docs, queries, max(16, cells // size)), "postings", GROUP_BYTES)
            stats = Statistics.gather(rows, size)
            floor = first_bounds(rows, queries, stats, k)
            index = materialize(build_index(rows, queries, stats, floor, packed=True), "blocked-index", GROUP_BYTES)
            found = best_of(search_index(index, queries, stats, floor, k), k)
            names = spark.createDataFrame(list(enumerate(built.ids)), "item long, item_id long")
            part = found.join(F.broadcast(names), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
            out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], RANKED) if out is None else out
