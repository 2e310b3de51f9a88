"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

An item of m characters that occurs in a text with at most e edits shares at least ``m - q + 1 - q * e`` of
its q-grams with the text, on diagonals (place in the text less place in the item) that differ by e at
most. Shared q-grams are counted in bands of 2(e + 1) diagonals that overlap by half, so any such region
lies whole in one band. Bands that reach the bound are verified by an alignment within the band; others
cannot hold the item. Neighbouring bands of an item are verified together. Letters are compared in lower case
and any white space as one kind of blank. Of the grams, q is the item's own: the longest up to ``Q`` with which
its full number of edits leaves a shared gram. A text's place counts once in a band, however often the item
repeats the gram there, which keeps the work on rules and other repeated letters in line with the text.

The items are the query set. They are broadcast in blocks of some ``block_bytes``, and the documents are read once,
however many blocks there are: a worker builds one block's index at a time and runs a stretch of texts through it.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retort.llm.common import byte_slices, texts_of

Q = 8
MAX_EDITS = 0.10
BLOCK_BYTES = 4 << 20
#: Of several blocks, texts that a worker holds while it takes one block after the other.
STRETCH_BYTES = 64 << 20
BITS = 20
#: Letters searched at a time, and postings that they meet.
LETTERS = 1 << 20
POSTINGS = 1 << 20
#: Diagonals aligned at a time.
LANES = 1 << 12
BETWEEN = chr(0xFFFF)
MULTIPLIER = np.uint64(0x100000001B3)


def _folding() -> np.ndarray:
    table = np.arange(1 << 16, dtype=np.uint32)
    for c in range(1 << 16):
        s = chr(c)
        if s.isspace():
            table[c] = 32
        elif len(low := s.lower()) == 1:
            table[c] = min(ord(low), (1 << 21) - 1)
    return table


_fold: list[np.ndarray] = []


def fold(text: str) -> np.ndarray:
    """Code points in lower case, blanks alike; one for each of the text's."""
    if not _fold:
        _fold.append(_folding())
    x = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(x < 1 << 16, _fold[0][np.minimum(x, (1 << 16) - 1)], x)


def gram_hashes(x: np.ndarray, q: int) -> np.ndarray:
    """A hash of the q letters from each place on: those of lengths a and b give that of length a + b."""
    if len(x) < q:
        return np.empty(0, np.uint64)
    power, have = x.astype(np.uint64), 1  # hashes of ``have`` letters, a power of two
    out, n, k = None, 0, q
    while k:
        if k & 1:
            out = power if out is None else out[: len(power) - n] * MULTIPLIER ** np.uint64(have) + power[n:]
            n += have
        if k := k >> 1:
            power, have = power[:-have] * MULTIPLIER ** np.uint64(have) + power[have:], have * 2
    out = out[: len(x) - q + 1]
    return (out ^ out >> np.uint64(31)) * np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Grams:
    """Postings of the grams of ``q`` letters of the items that are filtered by that length. A posting is a stretch of
    an item's places with the gram, from ``low`` to ``high``, no two neighbours more than a half band apart: a run of
    one letter is a single posting, not one for each of its places."""
    q: int
    grams: np.ndarray
    first: np.ndarray
    item: np.ndarray
    low: np.ndarray
    high: np.ndarray
    seen: np.ndarray
    reach: int

    @classmethod
    def build(cls, q: int, numbers: list[int], items: list[np.ndarray], edits: np.ndarray) -> Grams:
        hashes = [gram_hashes(items[k], q) for k in numbers]
        h = np.concatenate(hashes)
        item = np.repeat(np.array(numbers, np.int64), [len(x) for x in hashes])
        place = np.concatenate([np.arange(len(x)) for x in hashes])
        order = np.lexsort((place, item, h))
        h, item, place = h[order], item[order], place[order]
        starts = np.r_[True, (h[1:] != h[:-1]) | (item[1:] != item[:-1]) | (np.diff(place) > edits[item[1:]] + 1)]
        at = np.flatnonzero(starts)
        last = np.r_[at[1:], len(h)] - 1
        grams, first = np.unique(h[at], return_index=True)
        seen = np.zeros(1 << BITS, bool)
        seen[grams >> np.uint64(64 - BITS)] = True
        return cls(q, grams, np.r_[first, len(at)], item[at].astype(np.int32), place[at].astype(np.int32), place[last].astype(np.int32), seen,
                   max(len(items[k]) + int(edits[k]) for k in numbers) + q)

    def matches(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of ``x`` that hold a known gram, and its number."""
        h = gram_hashes(x, self.q)
        at = np.flatnonzero(self.seen[h >> np.uint64(64 - BITS)])
        if not len(at) or not len(self.grams):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        g = np.minimum(np.searchsorted(self.grams, h[at]), len(self.grams) - 1)
        true = self.grams[g] == h[at]
        return at[true], g[true]


@dataclass
class Index:
    """q-gram postings of a block of items. Items without an edit to spare are looked up as they are."""
    ids: list
    items: list[np.ndarray]
    edits: np.ndarray
    bound: np.ndarray
    reach: np.ndarray
    grams: list[Grams]

    @classmethod
    def build(cls, rows: list[tuple], q: int = Q, max_edits: float = MAX_EDITS) -> Index:
        rows = [(i, x) for i, t in rows if len(x := fold(t or "")) >= 1]
        ids, items = [i for i, _ in rows], [x for _, x in rows]
        m = np.array([len(x) for x in items], np.int64)
        edits = np.floor(max_edits * m + 1e-9).astype(np.int64)
        # the longest gram, up to q, that an item with all its edits still shares with the text
        own = np.maximum(1, np.minimum(q, m // (edits + 1)))
        numbers = {int(n): np.flatnonzero((own == n) & (edits > 0)).tolist() for n in np.unique(own[edits > 0])}
        return cls(ids, items, edits, m - own + 1 - own * edits, m + 2 * (edits + 1), [Grams.build(n, ks, items, edits) for n, ks in numbers.items()])

    def candidates(self, x: np.ndarray) -> list[tuple[int, int, int]]:
        """(item, first, last diagonal) of stretches of bands of the letters ``x`` that reach the bound; bands that
        follow one another are one stretch. Of several texts in a row a band may count letters of two, never
        fewer of one."""
        out = []
        for grams in self.grams:
            at, g = grams.matches(x)
            n = grams.first[g + 1] - grams.first[g]
            before, i = np.r_[0, np.cumsum(n)], 0
            found = []
            while i < len(at):  # parts of bounded postings, that overlap by what an item can reach
                j = max(int(np.searchsorted(before, before[i] + POSTINGS, side="right")) - 1, int(np.searchsorted(at, at[i] + 2 * grams.reach)), i + 1)
                found.append(self._bands(grams, at[i:j], g[i:j], n[i:j]))
                i = len(at) if j >= len(at) else int(np.searchsorted(at, at[j] - grams.reach))
            out += self._stretches(np.concatenate([*found, np.empty((0, 3), np.int64)]))
        return out

    def _bands(self, grams: Grams, at: np.ndarray, g: np.ndarray, n: np.ndarray) -> np.ndarray:
        """(item, from, to) of bands that hold places enough; band b begins at diagonal b * (edits + 1)."""
        post = np.repeat(grams.first[g] - np.cumsum(n) + n, n) + np.arange(n.sum())
        item, place = grams.item[post].astype(np.int64), np.repeat(at, n)
        # what a stretch of text as long as the item holds of it: a coarse count that drops most postings
        length = self.reach[item]
        slot = (item * np.int64(0x9E3779B1) + place // length) & ((1 << 20) - 1)
        held = np.bincount(slot, minlength=1 << 20)
        enough = held[slot] + np.maximum(held[(slot + 1) & ((1 << 20) - 1)], held[(slot - 1) & ((1 << 20) - 1)]) >= self.bound[item]
        post, item, place = post[enough], item[enough], place[enough]
        if not len(post):
            return np.empty((0, 3), np.int64)
        half = self.edits[item] + 1
        low = (place - grams.high[post]) // half - 1
        high = (place - grams.low[post]) // half + 1
        # a place counts once for each band between: differences, summed by (item, band)
        base = low.min()
        width = np.int64(high.max() - base + 2)
        key, which = np.unique(np.concatenate([item * width + low - base, item * width + high - base]), return_inverse=True)
        count = np.cumsum(np.bincount(which, np.repeat([1, -1], len(post)), len(key)).astype(np.int64))
        held = np.flatnonzero(count[:-1] >= self.bound[np.minimum(key[:-1] // width, len(self.bound) - 1)])
        owner = key[held] // width
        return np.stack([owner, key[held] - owner * width + base, key[held + 1] - owner * width + base], 1)

    def _stretches(self, bands: np.ndarray) -> list[tuple[int, int, int]]:
        out: list[tuple[int, int, int]] = []
        for k, a, b in sorted(map(tuple, bands.tolist())):
            if out and out[-1][0] == k and a <= out[-1][2]:
                out[-1] = (k, out[-1][1], max(b, out[-1][2]))
            else:
                out.append((k, a, b))
        return [(k, a * (int(self.edits[k]) + 1), (b + 1) * (int(self.edits[k]) + 1)) for k, a, b in out]

    def regions(self, texts: list[str]) -> list[list[tuple]]:
        """For each text, (item id, start, end, edits) of the items in it, one for each place."""
        out, i = [], 0
        while i < len(texts):
            j, n = i, 0
            while j < len(texts) and (j == i or n + len(texts[j]) < LETTERS):
                n += len(texts[j]) + 1
                j += 1
            out += self._regions(texts[i:j])
            i = j
        return out

    def _regions(self, texts: list[str]) -> list[list[tuple]]:
        x = fold(BETWEEN.join(texts))
        first = np.cumsum([0] + [len(t) + 1 for t in texts])
        found: list[dict[int, list[tuple[int, int, int]]]] = [{} for _ in texts]
        for k, start, end in self.candidates(x):
            edits, item = int(self.edits[k]), self.items[k]
            a = max(0, int(np.searchsorted(first, start, side="right")) - 1)
            while a < len(texts) and first[a] < end + len(item):
                own = x[first[a] : first[a + 1] - 1]
                low, high = max(start - int(first[a]), -edits - 1), min(end - int(first[a]), len(own) + 1)
                if low < high:
                    found[a].setdefault(k, []).extend(places(item, own, low, high - low, edits))
                a += 1
        for k in np.flatnonzero(self.edits == 0).tolist():  # whole occurrences
            item = self.items[k]
            at = np.arange(max(0, len(x) - len(item) + 1))
            for j, c in enumerate(item):
                at = at[x[at + j] == c]
            for start in at.tolist():
                a = int(np.searchsorted(first, start, side="right")) - 1
                start -= int(first[a])
                if start + len(item) <= len(texts[a]):
                    found[a].setdefault(k, []).append((start, start + len(item), 0))
        return [self._apart(hits) for hits in found]

    def _apart(self, found: dict[int, list[tuple[int, int, int]]]) -> list[tuple]:
        """Of overlapping places of one item, the one with the fewest edits."""
        out = []
        for k, hits in found.items():
            last = -1
            for start, end, edits in sorted(hits, key=lambda r: (r[1], r[2])):
                if start >= last:
                    out.append((self.ids[k], start, end, edits))
                    last = end
                elif out[-1][3] > edits:
                    out[-1], last = (self.ids[k], start, end, edits), end
        return sorted(out, key=lambda r: (r[1], r[2], str(r[0])))


def costs(item: np.ndarray, x: np.ndarray, diagonal: int, width: int, edits: int) -> np.ndarray | None:
    """For each diagonal of [diagonal, diagonal + width] the least cost of ``item`` against a region of ``x`` that ends
    there, or None where all are above ``edits``. Unit costs; the ends of the text's region are free."""
    m = len(item)
    step = np.arange(width + 1, dtype=np.int32)
    lanes = diagonal + step
    # costs by diagonal; cell (i, d) stands before x[i + d]
    row = np.where((lanes >= 0) & (lanes <= len(x)), 0, m + 1).astype(np.int32)
    window = np.full(m + width + 1, 0xFFFFFFFF, np.uint32)  # what lies outside the text equals nothing
    a, b = max(0, diagonal), min(len(x), diagonal + len(window))
    if a < b:
        window[a - diagonal : b - diagonal] = x[a:b]
    for i in range(m):
        new = row + (window[i : i + width + 1] != item[i])  # from (i, d): item[i] against x[i + d]
        np.minimum(new[:-1], row[1:] + 1, out=new[:-1])  # from (i, d + 1): item[i] left out
        row = np.minimum.accumulate(new - step) + step  # from (i + 1, d - 1): a letter of x put in
        if i % 16 == 15 and row.min() > edits:
            return None
    ends = lanes + m
    return np.where((ends >= 0) & (ends <= len(x)), row, m + 1)


def places(item: np.ndarray, x: np.ndarray, diagonal: int, width: int, edits: int) -> list[tuple[int, int, int]]:
    """Places (start, end, edits) of ``item`` in ``x`` along diagonals [diagonal, diagonal + width). Within fewer
    diagonals than the item has letters all places overlap and the best one stands for them; a wider stretch is
    aligned at once, and again around each end that it may have, one after the other."""
    if width < len(item) - 2 * edits:
        hit = align(item, x, diagonal, width, edits)
        return [hit] if hit else []
    m, ends = len(item), []
    for d in range(diagonal, diagonal + width, LANES):  # a path strays from its end's diagonal by the edits at most
        n = min(LANES, diagonal + width - d)
        cost = costs(item, x, d - edits, n + 2 * edits, edits)
        if cost is not None:
            ends.append(np.flatnonzero(cost[edits : edits + n] <= edits) + d + m)
    ends = np.concatenate([*ends, np.empty(0, np.int64)])
    out, i, base = [], 0, 0
    while i < len(ends):
        end = int(ends[i]) - base
        hit = align(item, x[base : base + end + 4 * (edits + 1) + m], end - m - edits, 4 * (edits + 1), edits)
        if hit:
            out.append((hit[0] + base, hit[1] + base, hit[2]))
            base += hit[1]
        # a place apart from this one ends so much later
        i = max(i + 1, int(np.searchsorted(ends, base + m - edits)) if hit else 0)
    return out


def align(item: np.ndarray, x: np.ndarray, diagonal: int, width: int, edits: int) -> tuple[int, int, int] | None:
    """The best place (start, end, edits) of ``item`` in ``x`` along diagonals [diagonal, diagonal + width),
    or None above ``edits``. Unit costs; the ends of the text's region are free."""
    last, m = len(x) - 1, len(item)
    step = np.arange(width + 1)

    if last < 0:
        return None
    lanes = diagonal + step
    whole = lanes[(lanes >= 0) & (lanes + m <= len(x))]
    for start in whole[(x[whole] == item[0]) & (x[whole + m - 1] == item[-1])].tolist():
        if np.array_equal(x[start : start + m], item):  # an alignment without edits
            return start, start + m, 0
    row = costs(item, x, diagonal, width, edits)
    if row is None:
        return None
    ends = lanes + m
    best = int(row.min())
    if best > edits:
        return None
    end = int(ends[int(row.argmin())])
    # the start: the least cost over the prefixes of x[:end] read backwards
    from_end = x[max(0, end - m - edits) : end][::-1]
    back = np.arange(len(from_end) + 1)
    for i, c in enumerate(item[::-1]):
        new = np.r_[i + 1, np.minimum(back[:-1] + (from_end != c), back[1:] + 1)]
        back = np.minimum.accumulate(new - np.arange(len(new))) + np.arange(len(new))
    length = min((int(k) for k in np.flatnonzero(back == back.min())), key=lambda k: abs(k - m))
    return end - length, end, int(back.min())


def _blocks(benchmark: DataFrame, block_bytes: int) -> list:
    """The items in broadcast blocks of (item ids, text): a text is in one block, once, with all its ids. The driver
    holds one block at a time; an index, which is some 25 times larger, is built by the workers and not sent."""
    items = (benchmark.where(F.length("text") > 0).groupBy("text")
             .agg(F.collect_set(F.struct(F.col("item_id").cast("long").alias("id"))).alias("ids")))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = math.ceil(size / block_bytes)
    blocks = (items.where(F.pmod(F.xxhash64("text"), F.lit(n)) == b).collect() for b in range(n))
    return [benchmark.sparkSession.sparkContext.broadcast([(tuple(i.id for i in r.ids), r.text) for r in rows]) for rows in blocks]


def _searched(blocks: list, q: int, max_edits: float, batches):
    """(slice, the regions of each of its texts) for every slice of the batches. One scan and one worker serve all
    blocks: of several, a worker holds a single index at a time and takes each over a stretch of slices."""
    only = Index.build(blocks[0].value, q, max_edits) if len(blocks) == 1 else None

    def search(parts):
        found = [[[] for _ in range(part.num_rows)] for part in parts]
        for block in blocks:
            index = only or Index.build(block.value, q, max_edits)
            for part, regions in zip(parts, found):
                for own, more in zip(regions, index.regions(texts_of(part))):
                    own += more
        return zip(parts, found)

    held, size = [], 0
    for part in (part for batch in batches for part in byte_slices(batch, "text")):
        held.append(part)
        size += part.nbytes
        if only or size >= STRETCH_BYTES:
            yield from search(held)
            held, size = [], 0
    if held:
        yield from search(held)


REGIONS = "doc_id long, item_id long, start long, end long, edits long"


def leaks(docs: DataFrame, benchmark: DataFrame, q: int = Q, max_edits: float = MAX_EDITS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, item_id, start, end, edits) of every benchmark item in every whole text, code points.

    An item may have ``max_edits`` of its length in edits; one too short for a whole edit counts only where it
    occurs as it is. Null and empty texts and items give nothing;
    repeated documents give their regions each, repeated items once; items with one text give its regions each;
    empty tables give none; other columns are not read."""
    blocks = _blocks(benchmark, block_bytes)
    if not blocks:
        return docs.sparkSession.createDataFrame([], REGIONS)

    def run(batches):
        for part, found in _searched(blocks, q, max_edits, batches):
            rows = [(d, i, *r) for d, regions in zip(part.column("doc_id").to_pylist(), found) for ids, *r in regions for i in ids]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in (zip(*rows) if rows else [[]] * 5)], names=["doc_id", "item_id", "start", "end", "edits"])

    return docs.select("doc_id", "text").mapInArrow(run, REGIONS)


def drop_leaks(docs: DataFrame, benchmark: DataFrame, q: int = Q, max_edits: float = MAX_EDITS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with all their columns."""
    blocks = _blocks(benchmark, block_bytes)
    if not blocks:
        return docs

    def run(batches):
        for part, found in _searched(blocks, q, max_edits, batches):
            yield part.filter(pa.array([not regions for regions in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
