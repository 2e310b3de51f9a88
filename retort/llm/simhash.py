"""SimHash near-duplicates by tiled exact comparison.

Distinct fingerprints are dealt into tiles by their population count (set bits). Two fingerprints within
``radius`` bits differ by at most ``radius`` in population count, so only tiles whose counts are that
close are compared, with numpy exclusive-or and bit counts; inside a pair of tiles the same bound on the
counts of the fingerprints' halves or quarters skips more. Every pair within the radius is compared, none
is estimated. Tiles grow with the number of fingerprints, so that each travels to some 64 others at most
(``tile_size``), and come in rows of a few thousand, so that no row grows with them.

The rows compared are distinct fingerprints, so exact copies cost one row. A pair of tiles gives a
spanning forest of its links, at most one fewer than the rows in it, so a large group of near copies
never becomes all its pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retort.llm.common import bytes_of, materialize, per_text
from retort.llm.components import connected_components

#: Fingerprints in a tile at least, and in a row of one; the most in a tile.
TILE = 16384
LARGEST = 1 << 20
#: Tiles above this size are told apart by four counts, others by two.
FINE = 1 << 15
#: Pairs of fingerprints for a task, before the counts of their parts are looked at.
TASK_CELLS = 1 << 34
#: Cells of one comparison block.
CELLS = 1 << 22


def simhash(text: bytes, shingle: int = 3) -> int:
    """64-bit SimHash of word shingles, repeats included; 0 for a text without words."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, 42)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = (ends - np.fromiter(map(len, words), np.int64, len(words)) - 1).tolist()
    digest, set_bits, n = xxhash.xxh64_intdigest, np.zeros(64, np.int64), len(words) - shingle + 1
    stops = (ends - 1).tolist()[shingle - 1 :]
    for i in range(0, n, 1 << 14):
        h = np.array([digest(joined[a:b], 42) for a, b in zip(starts[i : i + (1 << 14)], stops[i : i + (1 << 14)])], "<u8")
        set_bits += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, columns: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``columns`` of ``docs`` (longs) and ``fp``, the fingerprint as a signed long."""
    def run(batch):
        fp = np.array([simhash(t, shingle) for t in bytes_of(batch)], np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([batch.column(c).cast(pa.int64()) for c in columns] + [pa.array(fp)], names=[*columns, "fp"])

    return per_text(docs, ", ".join(f"{c} long" for c in columns) + ", fp long", run, (*columns, "text"))


def _counts(x: np.ndarray, parts: int) -> np.ndarray:
    """Population counts of ``parts`` equal stretches of each fingerprint."""
    width = 64 // parts
    mask = np.uint64((1 << width) - 1)
    return np.stack([np.bitwise_count((x >> np.uint64(i * width)) & mask) for i in range(parts)], axis=1).astype(np.int16)


def _cells(x: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fingerprints ordered by their counts: (order, the different counts, where each begins)."""
    counts = _counts(x, parts)
    order = np.lexsort(counts.T[::-1])
    counts = counts[order]
    begin = np.flatnonzero(np.r_[True, (counts[1:] != counts[:-1]).any(axis=1)]) if len(x) else np.empty(0, np.int64)
    return order, counts[begin], np.r_[begin, len(x)]


def forest(a: np.ndarray, b: np.ndarray, radius: int, same: bool) -> np.ndarray:
    """Places (in a, in b) of links that connect what all links within ``radius`` connect.
    ``same``: b is a. The differences of the counts of a fingerprint's stretches add up to at most the
    differing bits, so only cells of counts that are that close are compared."""
    parts = 4 if min(len(a), len(b)) > FINE else 2
    shift = 0 if same else len(a)
    parent = np.arange(len(a) + (0 if same else len(b)))

    def root(x):
        top = parent[x]
        while (parent[top] != top).any():
            top = parent[top]
        parent[x] = top
        return top

    order_a, cells_a, at_a = _cells(a, parts)
    order_b, cells_b, at_b = _cells(b, parts)
    sorted_b, out = b[order_b], []
    for i, cell in enumerate(cells_a):
        near = np.flatnonzero(np.abs(cells_b - cell).sum(axis=1) <= radius)
        if not len(near):
            continue
        cols = np.concatenate([np.arange(at_b[k], at_b[k + 1]) for k in near])
        rows, there = order_a[at_a[i] : at_a[i + 1]], sorted_b[cols]
        step = max(1, CELLS // len(cols))
        for j in range(0, len(rows), step):
            here = rows[j : j + step]
            r, c = np.nonzero(np.bitwise_count(a[here][:, None] ^ there[None, :]) <= radius)
            u, v = here[r], order_b[cols[c]] + shift
            while len(u):
                ru, rv = root(u), root(v)
                apart = ru != rv
                u, v, ru, rv = u[apart], v[apart], ru[apart], rv[apart]
                # each larger root goes under one smaller root, by the link that shows it
                hi, first = np.unique(np.maximum(ru, rv), return_index=True)
                parent[hi] = np.minimum(ru, rv)[first]
                out.append(np.stack([u[first], v[first] - shift], axis=1))
    return np.concatenate(out) if out else np.empty((0, 2), np.int64)


def tile_size(n: int) -> int:
    """Fingerprints in a tile: a 64th of all, from ``TILE`` to ``LARGEST``. A fingerprint travels to each
    tile that its own is compared with, so it is exchanged some 64 times at most until tiles are largest,
    and n / LARGEST times from there on."""
    return min(LARGEST, max(TILE, -(-n // 64)))


def links(distinct: DataFrame, radius: int, tile: int | None = None) -> DataFrame:
    """(src, dst): links of distinct fingerprints (column ``fp``) that connect all pairs within ``radius``."""
    spark = distinct.sparkSession
    counted = distinct.select("fp", F.bit_count("fp").alias("p"))
    sizes = {r.p: r.n for r in counted.groupBy("p").agg(F.count("*").alias("n")).collect()}  # 65 rows at most
    tile = tile or tile_size(sum(sizes.values()))
    per = [math.ceil(sizes.get(p, 0) / tile) for p in range(65)]
    first = [sum(per[:p]) for p in range(66)]  # tiles are numbered by population count
    lowest = [first[max(0, p - radius)] for p in range(65)]
    highest = [first[min(65, p + radius + 1)] - 1 for p in range(65)]
    if not sizes:
        return spark.createDataFrame([], "src long, dst long")
    size = [sizes.get(p, 0) for p in range(65)]
    cells = sum(n * sum(size[p : p + radius + 1]) for p, n in enumerate(size))
    pairs = sum(n * (highest[p] - first[p] + 1) for p, n in enumerate(per))
    tasks = min(pairs, max(32, math.ceil(cells / TASK_CELLS)))
    of = lambda values: F.element_at(F.array(*map(F.lit, values)), F.col("p") + 1)
    number = of(first[:65]) + F.pmod(F.xxhash64("fp"), of([max(1, n) for n in per])).cast("int")
    part = F.pmod(F.hash("fp"), F.lit(math.ceil(tile / TILE)))  # rows of some TILE fingerprints, whatever a tile's size
    tiles = counted.select("p", number.alias("tile"), part.alias("part"), "fp").groupBy("p", "tile", "part").agg(F.collect_list("fp").alias("fps"))
    tiles = materialize(tiles, "tiles")
    left = tiles.select(F.col("tile").alias("t"), F.explode(F.sequence("tile", of(highest))).alias("u"), F.lit(0).alias("side"), "fps")
    right = tiles.select(F.explode(F.sequence(of(lowest), F.col("tile"))).alias("t"), F.col("tile").alias("u"), F.lit(1).alias("side"), "fps").where("t < u")
    dealt = left.unionByName(right).repartition(tasks, "t", "u").sortWithinPartitions("t", "u", "side")

    def compare(parts):
        a, b = (np.concatenate([x for s, x in parts if s == side] or [np.empty(0, np.uint64)]) for side in (0, 1))
        same = not len(b)
        b = a if same else b
        found = forest(a, b, radius, same)
        return pa.RecordBatch.from_arrays([pa.array(a[found[:, 0]].view(np.int64)), pa.array(b[found[:, 1]].view(np.int64))], names=["src", "dst"])

    def run(batches):
        pair, held = None, []
        for batch in batches:
            keys = zip(batch.column("t").to_pylist(), batch.column("u").to_pylist(), batch.column("side").to_pylist())
            for i, (t, u, side) in enumerate(keys):
                if (t, u) != pair and held:
                    yield compare(held)
                    held = []
                pair = (t, u)
                held.append((side, batch.column("fps")[i].values.to_numpy(zero_copy_only=False).view(np.uint64)))
        if held:
            yield compare(held)

    return dealt.mapInArrow(run, "src long, dst long")


def classes(fps: DataFrame, radius: int, tile: int | None = None) -> DataFrame:
    """(fp, label): every distinct fingerprint and the least fingerprint that links reach from it."""
    distinct = fps.select("fp").distinct()
    linked = connected_components(links(distinct, radius, tile))
    return distinct.join(linked.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("component", "fp").alias("label"))


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 3, tile: int | None = None) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row.

    ``component_id`` is the smallest doc_id reachable over links of at most ``radius`` differing bits. Null
    and empty texts have fingerprint zero and link like any other. A null doc_id never names a component
    unless all of it is null. Repeated rows give a row each; an empty table gives none; other columns are
    not read."""
    fps = materialize(fingerprints(docs, shingle), "simhash")
    labels = materialize(classes(fps, radius, tile), "simhash-classes")
    least = fps.groupBy("fp").agg(F.min("doc_id").alias("doc_id"))
    named = labels.join(least, "fp").groupBy("label").agg(F.min("doc_id").alias("component_id"))
    named = labels.join(named, "label").select("fp", "component_id")
    return fps.join(named, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, radius: int = 3) -> DataFrame:
    """The rows of ``docs``, one of each group of near-duplicates: that with the smallest doc_id (nulls
    last; of equal ids the one with the least text hash, then the one with the least hash of all its
    columns; wholly equal rows are one). All columns are kept, whatever their names."""
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), "text")
    fps = materialize(fingerprints(keyed, shingle, ("doc_id", "th")), "simhash")
    labels = classes(fps, radius)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")
    best = fps.groupBy("fp").agg(F.min(order).alias("row"))
    best = labels.join(best, "fp").groupBy("label").agg(F.min("row").alias("row"))
    key = lambda i, t: F.concat_ws("#", F.coalesce(i.cast("string"), F.lit("null")), t.cast("string"))
    best = materialize(best.select(key(F.col("row.doc_id"), F.col("row.th")).alias("key")), "simhash-kept")
    nested = lambda f: isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))
    whole = F.xxhash64(*[F.to_json(F.struct(f.name)) if nested(f) else F.col(f.name) for f in docs.schema.fields])
    rows = docs.select(key(F.col("doc_id").cast("long"), F.xxhash64("text")).alias("key"), whole.alias("hash"), F.struct(*docs.columns).alias("row"))
    return rows.join(best, "key").groupBy("key").agg(F.min_by("row", "hash").alias("row")).select("row.*")
