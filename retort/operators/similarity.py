"""Set-similarity search on word shingles (C7, re-aimed from a remote 2-D
similarity service).

Exact Jaccard >= t by prefix filtering: order every shingle alike in all sets;
a set of size s only needs its first s - ceil(t*s) + 1 shingles indexed,
because two sets with Jaccard >= t must share one of those. Candidates come
from an equi-join on prefix shingles (plus the size filter
t*|A| <= |B| <= |A|/t and a bound by place) and are verified exactly with
``array_intersect``. Any one order will do; here it is by counts of a fixed
number of cells of hashes, so common shingles sort last and rarely enter a
prefix, and every row orders its own: only prefixes travel, never all
shingles. Documents with one and the same set share its row, so a thousand
copies of a text are one set to join.

``similar_lsh`` finds candidates by banded min-hash instead and verifies
them the same way.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import blake2b, md5

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retort.session import scratch_path, spread

SHINGLE_WORDS = 5
#: Greatest probability that ``similar_lsh`` misses a pair at its threshold, and the bands it may take for
#: bands of more than one row.
MISS_RATE = 3e-6
MOST_BANDS = 48
#: Words, or hashes, that Python works on at a time.
WORDS = 1 << 20
#: Cells that shingles are counted in to tell common ones, and numbers in one row of a partial sum.
CELLS, SEGMENT = 1 << 20, 1 << 14
_BLANKS = "[ \\t\\n\\r]+"


def words(text) -> Column:
    """Lower-cased text split on blanks, empties dropped."""
    t = text if isinstance(text, Column) else F.col(text)
    return F.filter(F.split(F.lower(t), _BLANKS), lambda w: F.length(w) > 0)


def _mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit numbers."""
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(factor)
    return x ^ (x >> np.uint64(33))


def _pieces(column: pa.Array, limit: int = WORDS) -> Iterator[pa.Array]:
    """Stretches of a list column with at most ``limit`` items (one row at least)."""
    ends = np.cumsum(pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start, base = 0, 0
    while start < len(column):
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield column.slice(start, stop - start)
        start, base = stop, int(ends[stop - 1])


def shingle_sets(words_column: pa.Array, k: int = SHINGLE_WORDS) -> Iterator[np.ndarray]:
    """For each row of words (empty ones don't count) the ascending 64-bit hashes of its different k-word shingles; fewer
    than k words: one shingle; none: no hash. Each different word is hashed once, shingles from their words' hashes."""
    lengths = pc.fill_null(pc.list_value_length(words_column), 0).to_numpy(zero_copy_only=False)
    coded = pc.list_flatten(words_column).dictionary_encode()
    different, code = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False)
    hashes = np.array([int.from_bytes(blake2b(w.encode(), digest_size=8).digest(), "little") for w in different], np.uint64)
    there = np.array([w != "" for w in different], bool)[code]
    number = np.bincount(np.repeat(np.arange(len(lengths)), lengths)[there], minlength=len(lengths))
    x = hashes[code[there]]
    grams, whole = x, max(0, len(x) - k + 1)
    for j in range(1, k):
        grams = _mix(grams[:whole]) + x[j : j + whole]
    grams = _mix(grams[:whole])
    for start, n in zip((np.cumsum(number) - number).tolist(), number.tolist()):
        if n >= k:
            own = np.sort(grams[start : start + n - k + 1])
            yield own[np.r_[True, own[1:] != own[:-1]]]
        else:
            own = x[start : start + n]
            for _ in range(n - 1):
                own = np.r_[_mix(own[:1]) + own[1], own[2:]]
            yield _mix(own ^ np.uint64(n))


def _lists(parts: list[np.ndarray], kind) -> pa.Array:
    ends = np.cumsum([0, *map(len, parts)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(parts) if parts else [], kind))


def _prefix_len(size: Column, pct: int) -> Column:
    # s - ceil(pct * s / 100) + 1, in integers
    return size - F.floor((size * pct + 99) / 100).cast("int") + 1


def _hashed(df: DataFrame, key: str, text: str, k: int, side: str) -> DataFrame:
    """(id, side, set, size, h) per document with at least one word, the work spread over the cluster first. ``h``:
    its shingles' hashes, ``set``: a 128-bit hash of those."""
    present = df.select(F.col(key).alias("id"), F.lit(side).alias("side"), text).where(F.col(text).rlike(r"[^ \t\n\r]"))
    split = spread(present).select("id", "side", F.split(F.lower(text), _BLANKS).alias("w"))
    schema = T.StructType(split.schema.fields[:2]).add("set", T.BinaryType()).add("size", T.IntegerType()).add("h", T.ArrayType(T.LongType()))

    def run(batches):
        for batch in batches:
            at = 0
            for part in _pieces(batch.column("w")):
                sets = list(shingle_sets(part, k))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(part)), batch.column(1).slice(at, len(part)), pa.array([md5(s.tobytes()).digest() for s in sets], pa.binary()),
                     pa.array([len(s) for s in sets], pa.int32()), _lists([s.view(np.int64) for s in sets], pa.int64())], names=schema.names)
                at += len(part)

    return split.mapInArrow(run, schema)


def _sets(corpus: DataFrame, refs: DataFrame | None, key: str, text: str, k: int) -> DataFrame:
    """(id, side, set, size, h) of all documents, written once in the checkpoint folder."""
    docs = _hashed(corpus, key, text, k, "d")
    if refs is not None:
        docs = docs.unionByName(_hashed(refs, key, text, k, "r"))
    return corpus.sparkSession.read.parquet(_written(docs, "shingle-sets"))


def _arrays(batch: pa.RecordBatch, column: str = "h") -> list[np.ndarray]:
    """The rows of a list column as views of one array."""
    values, lengths = pc.list_flatten(batch.column(column)).to_numpy(zero_copy_only=False), pc.list_value_length(batch.column(column)).to_numpy(zero_copy_only=False)
    return np.split(values, np.cumsum(lengths)[:-1]) if len(lengths) else []


def _cells(rows: DataFrame) -> np.ndarray:
    """How many shingles of ``rows`` fall in each of ``CELLS`` cells of hashes: a fixed size whatever the input, added up
    by Spark in segments of one partial sum a task."""
    def run(batches):
        total = np.zeros(CELLS)
        for batch in batches:
            total += np.bincount(pc.list_flatten(batch.column("h")).to_numpy(zero_copy_only=False) & (CELLS - 1), minlength=CELLS)
        yield pa.RecordBatch.from_arrays([pa.array(range(CELLS // SEGMENT), pa.int32()), pa.array(list(total.reshape(-1, SEGMENT)), pa.list_(pa.float64()))], names=["segment", "part"])

    tasks = rows.select("h").coalesce(rows.sparkSession.sparkContext.defaultParallelism)
    sums = tasks.mapInArrow(run, "segment int, part array<double>").groupBy("segment").agg(Summarizer.sum(array_to_vector("part")).alias("total"))
    total = np.zeros(CELLS, np.int64)
    for r in sums.collect():  # CELLS numbers
        total[r.segment * SEGMENT : (r.segment + 1) * SEGMENT] = r.total.toArray()
    return total


def _ranked(rows: DataFrame, pct: int, asked: bool = False) -> DataFrame:
    """(set, size, is_ref, is_doc, g, rn): of each different set the prefix that a pair of ``pct`` per cent shares something
    of, each shingle with its place. Shingles are ordered by how full their cell is, then by hash: one order for
    all sets, in which common shingles come last. ``asked``: without the shingles whose cell no reference has."""
    cells = _cells(rows)
    wanted = _cells(rows.where("side = 'r'")) > 0 if asked else None

    def run(batches):
        for batch in batches:
            g, rn = [], []
            for h in _arrays(batch):
                cell = h & (CELLS - 1)
                order = np.lexsort((h, cells[cell]))[: len(h) - (len(h) * pct + 99) // 100 + 1]
                place = np.arange(1, len(order) + 1, dtype=np.int32)
                if wanted is not None:
                    kept = wanted[cell[order]]
                    order, place = order[kept], place[kept]
                g.append(h[order])
                rn.append(place)
            ref = pc.equal(batch.column("side"), "r")
            yield pa.RecordBatch.from_arrays([batch.column("set"), batch.column("size"), ref, pc.invert(ref), _lists(g, pa.int64()), _lists(rn, pa.int32())],
                                             names=["set", "size", "is_ref", "is_doc", "g", "rn"])

    each = rows.select("side", "set", "size", "h").mapInArrow(run, "set binary, size int, is_ref boolean, is_doc boolean, g array<bigint>, rn array<int>")
    sets = each.groupBy("set").agg(F.first("size").alias("size"), F.bool_or("is_ref").alias("is_ref"), F.bool_or("is_doc").alias("is_doc"),
                                   F.first(F.struct("g", "rn")).alias("p"))
    path = _written(sets.select("set", "size", "is_ref", "is_doc", "p.g", "p.rn"), "prefixes")
    long = rows.sparkSession.read.parquet(path).select("set", "size", "is_ref", "is_doc", F.explode(F.arrays_zip("g", "rn")).alias("z"))
    return long.select("set", "size", "is_ref", "is_doc", "z.g", "z.rn")


def _verified(cand: DataFrame, rows: DataFrame, pct: int) -> DataFrame:
    """(a, b, jaccard) of candidate pairs of sets that reach the threshold. Only sets of a candidate travel."""
    spark = rows.sparkSession
    cand = spark.read.parquet(_written(cand, "candidates"))
    met = cand.select(F.col("a").alias("set")).union(cand.select(F.col("b"))).distinct()
    sets = spark.read.parquet(_written(rows.select("set", "h").join(met, "set", "left_semi").dropDuplicates(["set"]), "candidate-sets"))
    v = (cand.join(sets.select(F.col("set").alias("a"), F.col("h").alias("ha")), "a")
         .join(sets.select(F.col("set").alias("b"), F.col("h").alias("hb")), "b"))
    v = v.select("a", "b", F.size(F.array_intersect("ha", "hb")).alias("i"), F.size("ha").alias("sa"), F.size("hb").alias("sb"))
    v = v.where(F.col("i") * 100 >= (F.col("sa") + F.col("sb") - F.col("i")) * pct)
    return v.select("a", "b", (F.col("i") / (F.col("sa") + F.col("sb") - F.col("i"))).alias("jaccard"))


def _band_keys(rows: DataFrame, bands: int, per_band: int) -> DataFrame:
    """(set, band): the keys of each set's bands, of ``per_band`` min-hashes each. A min-hash is the least of the set's
    hashes, scrambled with a seed of its own."""
    seeds = _mix(np.arange(1, bands * per_band + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    def run(batches):
        for batch in batches:
            at = 0
            for h in _pieces(batch.column("h")):
                values, lengths = pc.list_flatten(h).to_numpy(zero_copy_only=False).view(np.uint64), pc.list_value_length(h).to_numpy(zero_copy_only=False)
                first = np.cumsum(lengths) - lengths  # no set is empty
                keys = np.tile(_mix(np.arange(1, bands + 1, dtype=np.uint64)), (len(h), 1))
                for i, seed in enumerate(seeds):
                    keys[:, i // per_band] = _mix(keys[:, i // per_band]) + np.minimum.reduceat(_mix(values ^ seed), first)
                yield pa.RecordBatch.from_arrays([batch.column("set").slice(at, len(h)), _lists(list(keys.view(np.int64)), pa.int64())], names=["set", "bands"])
                at += len(h)

    each = rows.select("set", "h").mapInArrow(run, "set binary, bands array<bigint>")
    return each.dropDuplicates(["set"]).select("set", F.explode("bands").alias("band"))


def _band_candidates(rows: DataFrame, bands: int, per_band: int) -> DataFrame:
    """Pairs (a < b) of different sets that agree on all min-hashes of some band."""
    keys = rows.sparkSession.read.parquet(_written(_band_keys(rows, bands, per_band), "bands"))
    a, b = keys.withColumnRenamed("set", "a"), keys.withColumnRenamed("set", "b")
    return a.join(b, "band").where(F.col("a") < F.col("b")).select("a", "b").distinct()


def _prefix_pairs(rows: DataFrame, pct: int) -> DataFrame:
    """Pairs (a < b, jaccard) of different sets that reach the threshold."""
    prefixes = _ranked(rows, pct)
    return _verified(_bounded_candidates(prefixes, prefixes, pct).where("a < b"), rows, pct)


def _expanded(members: DataFrame, pairs: DataFrame, refs: bool, n: int | None) -> DataFrame:
    """Pairs of sets (and each set with itself) as pairs of documents. With ``n`` and no references, each
    document's n best of those with larger ids."""
    # a set that one document has pairs with itself for nothing
    own = members.groupBy("set").agg(F.bool_or(F.col("side") == "r").alias("is_ref"), F.bool_or(F.col("side") == "d").alias("is_doc"), F.count(F.lit(1)).alias("n"))
    same = own.where("is_ref and is_doc" if refs else "n > 1").select(F.col("set").alias("a"), F.col("set").alias("b"), F.lit(1.0).alias("jaccard"))
    if not refs:
        pairs = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "jaccard"))
    pairs = pairs.unionByName(same)
    left = members.where(F.col("side") == ("r" if refs else "d")).select(F.col("id").alias("ref_id"), F.col("set").alias("a"))
    right = members.where(F.col("side") == "d").select(F.col("id").alias("doc_id"), F.col("set").alias("b"))
    out = pairs.join(left, "a").join(right, "b")
    if not refs:
        out = out.where(F.col("ref_id") < F.col("doc_id"))
    out = out.select("ref_id", "doc_id", "jaccard")
    if n is not None:
        wn = Window.partitionBy("ref_id").orderBy(F.desc("jaccard"), "doc_id")
        out = out.withColumn("_r", F.row_number().over(wn)).where(F.col("_r") <= n).drop("_r")
    return out


def similar_sets(corpus: DataFrame, threshold: int = 90, key: str = "doc_id", text: str = "text",
                 k: int = SHINGLE_WORDS) -> tuple[DataFrame, DataFrame]:
    """C7 without expansion: membership (id, set) and pairs of different sets
    (a < b, jaccard). No copy is paired with a copy."""
    rows = _sets(corpus, None, key, text, k)
    return rows.select("id", "set"), _prefix_pairs(rows, int(threshold))


#: Thresholds that ``nearest`` tries first: references that have their n documents at one leave the search.
STEPS = (60,)


def _bounded_candidates(refs: DataFrame, docs: DataFrame, pct: int) -> DataFrame:
    """Pairs (a, b) of ranked sets (set, size, g, rn) that can reach ``pct``: they share a shingle of their prefixes,
    their sizes allow it, and so do the shingles left after the first they share (position filter: of a and b at
    places i and j at most 1 + min(|a| - i, |b| - j) are common)."""
    cut = lambda df, s, p: df.where(F.col("rn") <= _prefix_len(F.col("size"), pct)).select(
        F.col("set").alias(p), F.col("size").alias(f"s{p}"), F.col("rn").alias(f"i{p}"), "g")
    near = (F.col("sb") * 100 >= F.col("sa") * pct) & (F.col("sa") * 100 >= F.col("sb") * pct)
    most = F.least(F.col("sa") - F.col("ia"), F.col("sb") - F.col("ib")) + 1
    room = most * (100 + pct) >= (F.col("sa") + F.col("sb")) * pct
    met = cut(refs, "sa", "a").join(cut(docs, "sb", "b"), "g").where(near & room & (F.col("a") != F.col("b")))
    return met.select("a", "b").distinct()


def nearest(corpus: DataFrame, refs: DataFrame, n: int, threshold: int = 90, key: str = "doc_id", text: str = "text",
            k: int = SHINGLE_WORDS, steps=STEPS) -> DataFrame:
    """C7 with a maximum: the ``n`` documents most similar to each reference, (ref_id, doc_id, jaccard), from
    ``threshold`` per cent up, ties by doc_id.

    The bound rises where results fill: the search begins at the highest of ``steps``, whose prefixes are the
    shortest, and only references that lack documents at one threshold go on to the next. Sets are
    ranked, not documents: of the n best documents each is among its set's first n, and its set among the
    first n sets by similarity and least id, so copies beyond those are never paired. What comes out, and
    what is written on the way, grows with the references times n at most, and with the corpus."""
    spark = corpus.sparkSession
    rows = _sets(corpus, refs, key, text, k)
    members = rows.select("id", "side", "set")
    scratch = lambda df, name: spark.read.parquet(_written(df, name))
    by_id = Window.partitionBy("set").orderBy("id")
    docs = members.where("side = 'd'")
    first = scratch(docs.withColumn("rn", F.row_number().over(by_id)).where(F.col("rn") <= n).select(F.col("set").alias("b"), F.col("id").alias("doc_id")), "first-members")
    sizes = scratch(docs.groupBy(F.col("set").alias("b")).agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("least")), "set-sizes")

    # only shingles of a reference can be shared with one; the order is by the corpus and the references alike
    ranked = _ranked(rows, int(threshold), asked=True)
    ref_sets = members.groupBy(F.col("set").alias("a")).agg(F.bool_or(F.col("side") == "r").alias("is_ref"), F.bool_or(F.col("side") == "d").alias("is_doc")).where("is_ref")
    ref_sets = scratch(ref_sets.select("a", "is_doc"), "reference-sets")
    same = ref_sets.where("is_doc").select("a", F.col("a").alias("b"), F.lit(1.0).alias("jaccard"))
    asked, found = ref_sets.select("a"), None
    order = Window.partitionBy("a").orderBy(F.desc("jaccard"), "least")
    so_far = Window.partitionBy("a").orderBy(F.desc("jaccard")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    levels = [s for s in sorted(steps, reverse=True) if s > threshold] + [int(threshold)]
    for level in levels:
        mine = ranked.where("is_ref").join(asked.withColumnRenamed("a", "set"), "set", "left_semi")
        pairs = _verified(_bounded_candidates(mine, ranked.where("is_doc"), level), rows, level)
        pairs = pairs.unionByName(same.join(asked, "a", "left_semi")).join(sizes, "b")
        best = pairs.withColumn("have", F.sum("n").over(so_far)).withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= n)
        done = scratch(best.select("a", "b", "jaccard", "have"), f"nearest-{level}")
        if level == levels[-1]:
            found = done if found is None else found.unionByName(done)
            break
        full = done.groupBy("a").agg(F.max("have").alias("have")).where(F.col("have") >= n).select("a")
        part = done.join(full, "a", "left_semi")
        found = part if found is None else found.unionByName(part)
        asked = scratch(asked.join(full, "a", "left_anti"), "asked")
        if asked.isEmpty():
            break
    rows = found.join(first, "b").withColumn("rn", F.row_number().over(Window.partitionBy("a").orderBy(F.desc("jaccard"), "doc_id"))).where(F.col("rn") <= n)
    asking = members.where("side = 'r'").select(F.col("id").alias("ref_id"), F.col("set").alias("a"))
    return asking.join(rows, "a").select("ref_id", "doc_id", "jaccard")


def _written(df: DataFrame, name: str) -> str:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return path


def similar(corpus: DataFrame, refs: DataFrame | None = None, threshold: int = 90, n: int | None = None,
            key: str = "doc_id", text: str = "text", k: int = SHINGLE_WORDS) -> DataFrame:
    """Pairs (ref_id, doc_id, jaccard) with Jaccard >= threshold/100.

    ``refs`` None means a self-join of ``corpus`` (pairs with ref_id <
    doc_id). ``n`` keeps each reference's n most similar documents (ties by
    id, see ``nearest``); None keeps all. Copies are expanded in the last step only;
    ``similar_sets`` leaves them together.
    """
    if refs is not None and n is not None:
        return nearest(corpus, refs, n, threshold, key, text, k)
    rows = _sets(corpus, refs, key, text, k)
    if refs is None:
        return _expanded(rows.select("id", "side", "set"), _prefix_pairs(rows, int(threshold)), False, n)
    prefixes = _ranked(rows, int(threshold), asked=True)
    met = _bounded_candidates(prefixes.where("is_ref"), prefixes.where("is_doc"), int(threshold))
    return _expanded(rows.select("id", "side", "set"), _verified(met, rows, int(threshold)), True, n)


def banding(threshold: int, rows: int | None = None) -> tuple[int, int]:
    """(bands, rows) that miss a pair of Jaccard threshold/100 with probability ``MISS_RATE`` at most (more
    similar pairs less): four rows a band, or fewer where that would take more than ``MOST_BANDS`` bands."""
    if not 0 < threshold <= 100:
        raise ValueError("min-hash needs a threshold from 1 to 100; similar takes any")
    for r in (4, 3, 2, 1) if rows is None else (rows,):
        differ = 1 - (threshold / 100) ** r
        bands = math.ceil(math.log(MISS_RATE) / math.log(differ)) if differ > 0 else 1
        if bands <= MOST_BANDS:
            break
    return bands, r


def similar_lsh(corpus: DataFrame, threshold: int = 90, key: str = "doc_id", text: str = "text",
                k: int = SHINGLE_WORDS, bands: int | None = None, rows: int | None = None) -> DataFrame:
    """C7 by banded min-hash, every candidate verified exactly: pairs like
    ``similar``'s. A pair of Jaccard j is missed with probability
    (1 - j^rows)^bands; by default both follow from the threshold, so that
    no pair it asks for is missed with more than ``MISS_RATE`` (12 bands of
    4 rows at 90). ``similar`` misses none."""
    derived, rows = banding(int(threshold), rows)
    members = _sets(corpus, None, key, text, k)
    pairs = _verified(_band_candidates(members, bands or derived, rows), members, int(threshold))
    return _expanded(members.select("id", "side", "set"), pairs, False, None)
