"""Mixture-controlled packing: deficit round-robin over one queue of tokens for each source.

In round r a source may spend its quantum of ``window * share`` tokens plus the fraction it could not
spend before (its deficit). After r rounds source s has therefore served

    C_s(r) = min(T_s, floor(r * quantum_s))

tokens of its T_s, and the rounds laid end to end are the stream that windows are cut from. Since the
state after any round is this closed form, every task places its own documents exactly, with the deficits
that earlier windows and other partitions carry over, and no task walks the stream. Shares are exact: the
weights are the token counts.

Sources whose quantum is below ``GRAIN`` tokens share one queue of the round-robin, which is filled by a
round-robin of its own over groups of them (``Mixture``). There all is served in grains of ``GRAIN`` tokens,
so that small sources aren't cut into crumbs, and each begins its first grain at an offset of its own. A
place in the stream takes one closed form of at most 65 queues a level, so a million sources cost little
more than ten. A window holds the share of each larger source to within a grain and a token for each of
them; when a queue runs dry the others fill the windows, so only the last one is short.

Tokens are encoded once, kept as 16 or 32 bit ids in a compressed table in the shared folder. Queue
positions come from sums for each (task, source), not from a sort, so a source with a third of all rows
costs no more than any other. The driver holds one number for each source of the mixture.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retort.llm.common import byte_slices, materialize
from retort.llm.tokens import _small, encoder
from retort.operators.indexing import dense_index

#: Target shares are held as integers of this resolution (shares of all tokens are the counts themselves).
RESOLUTION = 1 << 60
#: Least tokens that a source with a smaller quantum serves at once.
GRAIN = 64
#: A group of queues is cut into this many of about equal weight; rounds looked at together.
FAN = 32
ROUNDS = 1 << 13
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class RoundRobin:
    """Closed form of the rounds over a few queues. ``totals`` and ``weights`` by queue, in the order they
    are served; ``grains`` by queue (default: ``GRAIN`` for those with a quantum below it, else 1)."""

    def __init__(self, totals: list[int], weights: list[int], window: int, grains: list[int] | None = None):
        self.window, self.D = window, sum(map(int, weights))
        least = min(GRAIN, window)
        if grains is None:
            grains = [least if int(w) * window < GRAIN * self.D else 1 for w in weights]
        # products that don't fit into 64 bits are Python's integers: shares are exact at every size
        large = max((max(map(int, totals)) + least) * self.D, self.D**2, self.D * window) >= 1 << 62
        self.dtype = object if large else np.int64
        self.T, self.w, self.grain = (np.array(list(map(int, x)), self.dtype) for x in (totals, weights, grains))
        #: What a queue may spend beforehand, so that small queues of one size don't all serve in one round.
        self.ahead = np.array([i * 39 % int(g) for i, g in enumerate(grains)], self.dtype)
        self.dense = self.w * window >= self.grain * self.D

    def served(self, r: np.ndarray) -> np.ndarray:
        """C_s(r): queues by rounds."""
        spent = np.asarray(r).astype(self.dtype) * self.window
        q = spent // self.D
        rest = spent - q * self.D
        w, grain = self.w[:, None], self.grain[:, None]
        return np.minimum(self.T[:, None], (q * w + rest * w // self.D + self.ahead[:, None]) // grain * grain)

    def round_of(self, queue, token):
        """The round that serves the token at this place of the queue (or of each queue)."""
        grain = self.grain[queue]
        return -(-((token // grain + 1) * grain - self.ahead[queue]) * self.D // (self.window * self.w[queue])) - 1

    def move(self, queue: np.ndarray, first: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
        """Runs of ``n`` tokens of ``queue`` from its place ``first`` on, as the rounds lay them end to end:
        (run, start in it, length, place in the stream) of its parts."""
        first, n = first.astype(self.dtype), n.astype(self.dtype)
        grain, dense = self.grain[queue], self.dense[queue]
        begin, end = self.round_of(queue, first), self.round_of(queue, first + n - 1)
        # a queue whose quantum makes a grain serves in every round; others serve a grain in some
        parts = np.where(dense, end - begin, (first + n - 1) // grain - first // grain).astype(np.int64) + 1
        run = np.repeat(np.arange(len(n)), parts)
        k = (np.arange(len(run)) - np.repeat(np.cumsum(parts) - parts, parts)).astype(self.dtype)
        q, g = queue[run], grain[run]
        r = np.where(dense[run], begin[run] + k, self.round_of(q, (first[run] // g + k) * g))
        order, out = np.argsort(r, kind="stable"), []
        for i in range(0, len(order), ROUNDS):
            some = order[i : i + ROUNDS]
            rounds, back = np.unique(r[some], return_inverse=True)
            before, after = self.served(rounds), self.served(rounds + 1)
            ahead = np.cumsum(after - before, axis=0) - (after - before) + before.sum(axis=0)
            own, of = q[some], run[some]
            c0, c1 = before[own, back], after[own, back]
            lo, hi = np.maximum(first[of], c0), np.minimum((first + n)[of], c1)
            has = (lo < hi).astype(bool)
            out.append([x[has].astype(np.int64) for x in (of, lo - first[of], hi - lo, ahead[own, back] + lo - c0)])
        return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.empty(0, np.int64),) * 4


class Mixture:
    """Round-robins over round-robins, so that a place is found from a few queues however many there are.

    The root serves each queue with a quantum of ``GRAIN`` tokens or more itself, and all the others as one
    queue, which is in turn a round-robin of at most ``2 * FAN`` queues or groups of them of about equal
    weight, and so on. Below the root all is served in grains, so a group's parts are cut at grains only."""

    def __init__(self, totals: list[int], weights: list[int], window: int):
        self.window = window
        self.leaves = n = len(totals)
        self.T, self.w = list(map(int, totals)), list(map(int, weights))
        self.parent, self.slot, self.children = [-1] * n, [0] * n, {}
        order = np.array(sorted(range(n), key=lambda i: (-self.w[i], i)), np.int64)
        total = sum(self.w)
        large = sum(self.w[i] * window >= min(GRAIN, window) * total for i in order.tolist())
        self.root = self._node([*order[:large].tolist(), *([self._group(order[large:])] if large < n else [])]) if n else -1
        depth = np.zeros(len(self.T), np.int64)
        for node in sorted(self.children, reverse=True):  # a parent is made after its children
            depth[self.children[node]] = depth[node] + 1
        self.depth, self.parent, self.slot = depth, np.array(self.parent, np.int64), np.array(self.slot, np.int64)
        self._rounds: dict[int, RoundRobin] = {}

    def _node(self, children: list[int]) -> int:
        me = len(self.T)
        self.T.append(sum(self.T[c] for c in children))
        self.w.append(sum(self.w[c] for c in children))
        self.parent.append(-1)
        self.slot.append(0)
        self.children[me] = children
        for i, c in enumerate(children):
            self.parent[c], self.slot[c] = me, i
        return me

    def _group(self, queues: np.ndarray) -> int:
        """The node of these queues, which are ordered by falling weight."""
        if len(queues) == 1:
            return int(queues[0])
        if len(queues) <= 2 * FAN:
            return self._node(queues.tolist())
        w = [self.w[i] for i in queues.tolist()]
        total = sum(w)
        large = sum(x * FAN >= total for x in w)
        ahead = list(accumulate(w[large:], initial=0))
        group = np.array([x * FAN // ahead[-1] for x in ahead[:-1]], np.int64)
        cuts = np.flatnonzero(np.diff(group)) + 1
        return self._node([*queues[:large].tolist(), *(self._group(x) for x in np.split(queues[large:], cuts))])

    def rounds(self, node: int) -> RoundRobin:
        if node not in self._rounds:
            if len(self._rounds) >= 4096:
                self._rounds.clear()
            grain = min(GRAIN, self.window)
            own = self.children[node]
            grains = [1 if node == self.root and c < self.leaves and self.w[c] * self.window >= grain * self.w[node] else grain for c in own]
            self._rounds[node] = RoundRobin([self.T[c] for c in own], [self.w[c] for c in own], self.window, grains)
        return self._rounds[node]

    def place(self, queue: np.ndarray, first: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
        """Pieces of documents that take ``n`` tokens of ``queue`` from its place ``first`` on:
        (document, start in it, length, place in the stream), by document and start."""
        doc, start, length, node, at = np.arange(len(n)), np.zeros(len(n), np.int64), n, queue, first
        for level in range(int(self.depth[queue].max(initial=0)), 0, -1):
            here = self.depth[node] == level
            moved = [[x[~here] for x in (doc, start, length, node, at)]]
            which = np.flatnonzero(here)
            parents = self.parent[node[which]]
            which = which[np.argsort(parents, kind="stable")]
            for some in np.split(which, np.flatnonzero(np.diff(np.sort(parents))) + 1):
                if len(some):
                    up = int(self.parent[node[some[0]]])
                    run, skip, size, to = self.rounds(up).move(self.slot[node[some]], at[some], length[some])
                    moved.append([doc[some][run], start[some][run] + skip, size, np.full(len(run), up), to])
            doc, start, length, node, at = (np.concatenate(x) for x in zip(*moved))
        # a run that crosses a window's end goes on in the next window
        room = self.window - at % self.window
        over = length > room
        doc, start, length, at = (np.concatenate(x) for x in (
            (doc, doc[over]), (start, (start + room)[over]), (np.where(over, room, length), (length - room)[over]), (at, (at + room)[over])))
        order = np.lexsort((start, doc))
        doc, start, length, at = doc[order], start[order], length[order], at[order]
        # runs that follow one another in the stream within a window are one piece
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (at[1:] != (at + length)[:-1]) | (at[1:] % self.window == 0)
        head = np.flatnonzero(new)
        length = np.add.reduceat(length, head) if len(head) else length
        return doc[head], start[head], length, at[head]


def encode(docs: DataFrame, path: str, eos: int) -> DataFrame:
    """Every document's ids with ``eos`` after them, and its place in its source's queue of the task:
    (run, queue, before, doc_id, n, ids), written once."""
    dtype = "<u2" if _small(path) else "<u4"

    def run(batches):
        enc, task = encoder(path, dtype), TaskContext.get().partitionId()
        end = np.array([eos], dtype).tobytes()
        width = len(end)
        used: dict[str, int] = defaultdict(int)
        for batch in batches:
            for part in byte_slices(batch, "text"):
                queues = part.column("queue").to_pylist()
                ids = enc.ids_of(part.column("text"), end)
                sizes = pc.binary_length(ids).to_numpy() // width
                before = []
                for q, n in zip(queues, sizes.tolist()):
                    before.append(used[q])
                    used[q] += n
                yield pa.RecordBatch.from_arrays(
                    [pa.array([task] * len(ids), pa.int32()), part.column("queue"), pa.array(before, pa.int64()),
                     part.column("doc_id").cast(pa.int64()), pa.array(sizes, pa.int64()), ids],
                    names=["run", "queue", "before", "doc_id", "n", "ids"])

    queue = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("queue")
    out = docs.select("doc_id", "text", queue).mapInArrow(
        run, "run int, queue string, before long, doc_id long, n long, ids binary")
    return materialize(out, "packing-ids")


def pack(docs: DataFrame, path: str, eos: int, window: int = 4096, targets: dict[str | None, float] | None = None,
         with_ids: bool = False) -> DataFrame:
    """Pieces of all documents: which ids of which document lie where in which sequence.

    ``targets`` gives sources' shares of a window (default: their shares of all tokens; sources not named
    get theirs of the rest). ``with_ids`` adds the piece's ids (array). A null or empty text is the end id
    alone; a null source is a queue of its own; repeated rows are packed each; an empty table gives no
    pieces. All sequences but the last are full."""
    ids = encode(docs, path, eos)
    sums = ids.groupBy("queue", "run").agg(F.sum("n").alias("n"))
    queues = dense_index(sums.groupBy("queue").agg(F.sum("n").alias("total")), ["queue"], "place")
    queues = materialize(queues.select("queue", "place", "total"), "packing-queues")
    base = sums.select("queue", "run", (F.sum("n").over(Window.partitionBy("queue").orderBy("run")) - F.col("n")).alias("base"))
    base = materialize(base.join(queues.select("queue", "place"), "queue"), "packing-base")
    totals = [n for _, n in sorted(map(tuple, queues.select("place", "total").collect()))]
    weights = totals
    if targets:
        wanted = {"" if k is None else f"={k}": v for k, v in targets.items() if v > 0}
        named = {r.place: wanted[r.queue] for r in queues.where(F.col("queue").isin(list(wanted))).collect()}
        free = sum(n for i, n in enumerate(totals) if i not in named)
        rest = max(1e-9, 1 - sum(named.values()))
        shares = [named[i] if i in named else rest * n / free for i, n in enumerate(totals)]
        whole = sum(shares)
        weights = [max(1, round(x / whole * RESOLUTION)) for x in shares]
    mixture = Mixture(totals, weights, window)
    dtype = "<u2" if _small(path) else "<u4"

    def run(batches):
        for batch in batches:
            for part in byte_slices(batch, "ids", 4 << 20):
                queue = part.column("place").to_numpy()
                first = np.add(part.column("before").to_numpy(), part.column("base").to_numpy())
                n = part.column("n").to_numpy()
                doc, start, length, at = mixture.place(queue, first, n)
                tokens = [np.frombuffer(x, dtype).astype("<u4") for x in part.column("ids").to_pylist()]
                cuts = [tokens[d][a : a + k] for d, a, k in zip(doc.tolist(), start.tolist(), length.tolist())]
                cols = [part.column("doc_id").take(pa.array(doc)), pa.array(start), pa.array(length),
                        pa.array([zlib.crc32(c.tobytes()) for c in cuts], pa.int64()), pa.array(n[doc]),
                        pa.array(at // window), pa.array(at % window)]
                fields = [f.split()[0] for f in PIECES.split(", ")]
                if with_ids:
                    cols.append(pa.array([c.astype(np.int32) for c in cuts], pa.list_(pa.int32())))
                    fields.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names=fields)

    return ids.join(base, ["queue", "run"]).mapInArrow(run, PIECES + (", ids array<int>" if with_ids else ""))
