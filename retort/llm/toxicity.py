"""Toxicity by a weighted lexicon, matched by Aho-Corasick over folded text.

Folding undoes look-alike letters and digits written for letters. The lexicon holds whole words and word
stems (many rare words with one beginning), each weighted by the log-odds of the labels. A phrase that
holds a term but is typical of clean texts is an exception; matches inside it do not count. The weight
found in a text is divided by its number of words and mapped to a probability by logistic regression.

Learning uses at most ``max_rows`` labelled rows (those with the least crc32 of doc_id): a documented
bound, so the model's cost does not grow with the corpus. Scoring is one pass over whole texts.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retort.llm.common import byte_slices, materialize, per_text, texts_of

# Letters that look alike, and digits and signs written for letters.
LOOK_ALIKE = dict(zip("аеорсухіјѕԁһкмтвнαοενικρτυχ", "aeopcyxijsdhkmtbhaoevikptux"))
WRITTEN_FOR = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}
FOLD = str.maketrans(LOOK_ALIKE | {k: v for k, v in WRITTEN_FOR.items() if k not in "!@$"})
SIGNS = re.compile(r"(?<=[^\W\d_])[@$!](?=[^\W\d_])")
WORD = re.compile(r"[^\W\d_]+")
STEMS = (4, 7)


def fold(text: str) -> list[str]:
    """The words of a text, lower case, with look-alikes and substitutions undone."""
    text = SIGNS.sub(lambda m: WRITTEN_FOR[m[0]], text.lower())
    return WORD.findall(text.translate(FOLD))


@dataclass(frozen=True)
class Model:
    """``words`` and ``stems`` to weights, exception phrases (word pairs), intercept and slope."""
    words: dict[str, float]
    stems: dict[str, float]
    exceptions: frozenset[str]
    intercept: float
    slope: float

    def automaton(self):
        a = ahocorasick.Automaton()
        for w, x in self.words.items():
            a.add_word(f" {w} ", (0, x))
        for s, x in self.stems.items():
            a.add_word(f" {s}", (1, x))
        for p in self.exceptions:
            a.add_word(f" {p} ", (2, len(p) + 2))
        a.make_automaton()
        return a

    def hits(self, words: list[str], automaton) -> list[tuple[int, float]]:
        """(place of the word's first letter in the joined words, weight) outside exceptions."""
        joined, found, spared = f" {' '.join(words)} ", [], []
        if not len(automaton):
            return []
        for end, (kind, x) in automaton.iter(joined):
            if kind == 2:
                spared.append((end - x + 2, end))
            else:
                start = joined.rindex(" ", 0, end if kind == 0 else end + 1) + 1
                found.append((start, x))
        if not spared:
            return found
        spans: list[list[int]] = []  # exceptions that overlap are one span
        for a, b in sorted(spared):
            if spans and a <= spans[-1][1]:
                spans[-1][1] = max(spans[-1][1], b)
            else:
                spans.append([a, b])
        starts = [a for a, _ in spans]
        inside = lambda s: (i := bisect_right(starts, s)) and s < spans[i - 1][1]
        return [(s, x) for s, x in found if not inside(s)]

    def feature(self, words: list[str], automaton) -> float:
        return math.log1p(100 * sum(x for _, x in self.hits(words, automaton)) / max(1, len(words)))

    def score(self, words: list[str], automaton) -> float:
        z = self.intercept + self.slope * self.feature(words, automaton)
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, z))))


def weight(n1, n0, toxic: int, clean: int):
    """Smoothed log-odds; the clean side's prior grows with the rows, so chance finds stay below it."""
    return np.log((n1 + 0.5) / (toxic + 1)) - np.log((n0 + 0.5 + 2e-4 * clean) / (clean + 1))


def held_out(doc_id):
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


#: A term is kept if its log-odds are clear, or fair with many of the toxic rows holding it.
CLEAR, FAIR = 4.0, 2.0


def learn(docs: DataFrame, labels: DataFrame, max_rows: int = 20000, exceptions: frozenset[str] = frozenset()) -> Model:
    """Fit on labelled rows outside the held-out quarter. Repeated labels of a document count once (toxic
    if any says so); null labels and documents without text teach nothing. Without rows of both classes
    the lexicon is empty and every score is the base rate."""
    use = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    use = use.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).orderBy(F.crc32(F.col("doc_id").cast("string").cast("binary")), "doc_id").limit(max_rows)
    use = F.broadcast(materialize(use, "toxicity-labels"))  # max_rows pairs of integers
    sample = materialize(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(use, "doc_id").select("text", "toxic"), "toxicity-sample")

    def count(batches):
        seen = (Counter(), Counter())
        rows = [0, 0]
        for batch in batches:
            for text, y in zip(texts_of(batch), batch.column("toxic").to_pylist()):
                rows[y] += 1
                seen[y].update(set(fold(text)))
        words = list(seen[0].keys() | seen[1].keys()) + [""]  # the empty word holds the rows
        yield pa.RecordBatch.from_arrays([pa.array(words), pa.array([seen[1][w] for w in words[:-1]] + [rows[1]], pa.int64()), pa.array([seen[0][w] for w in words[:-1]] + [rows[0]], pa.int64())], names=["term", "n1", "n0"])

    words = sample.mapInArrow(count, "term string, n1 long, n0 long").groupBy("term").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))
    words = materialize(words, "toxicity-words")
    rows = words.where("term = ''").first()
    toxic, clean = (rows.n1, rows.n0) if rows else (0, 0)
    if not toxic or not clean:
        p = (toxic + 0.5) / (toxic + clean + 1) if toxic + clean else 1e-6
        return Model({}, {}, frozenset(exceptions), math.log(p / (1 - p)), 0.0)
    odds = lambda: F.log((F.col("n1") + 0.5) / (toxic + 1)) - F.log((F.col("n0") + 0.5 + 2e-4 * clean) / (clean + 1))
    telling = (odds() >= CLEAR) | ((odds() >= FAIR) & (F.col("n1") >= 5 + 0.02 * toxic))
    known = {r.term: r.n1 for r in words.where((F.length("term") > 2) & telling).collect()}
    cut = words.select(F.explode(F.transform(F.sequence(F.lit(STEMS[0]), F.lit(STEMS[1])), lambda k: F.when(F.length("term") > k, F.substring("term", F.lit(1), k)))).alias("term"), "n1", "n0").where("term is not null")
    cut = cut.groupBy("term").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"), F.max("n1").alias("most"), F.sum((F.col("n1") > 0).cast("int")).alias("words"))
    stems = {r.term: r.n1 for r in cut.where(telling & (F.col("words") >= 4) & (F.col("most") <= 0.5 * F.col("n1"))).collect()}
    kept = set()
    for root in (s for s in stems if s[:-1] not in stems):
        while children := [c for c in stems if c[:-1] == root and stems[c] >= 0.9 * stems[root]]:
            root = children[0]
        kept.add(root)
    counts = {r.term: (r.n1, r.n0) for r in cut.where(F.col("term").isin(*kept)).collect()} if kept else {}
    terms = {w for w in known if not any(w.startswith(s) and w != s for s in kept)}
    pairs = {r.term: (r.n1, r.n0) for r in words.where(F.col("term").isin(*terms)).collect()} if terms else {}
    lexicon = {w: float(weight(*n, toxic, clean)) for w, n in pairs.items()}
    stemmed = {s: float(weight(*n, toxic, clean)) for s, n in counts.items()}
    model = Model(lexicon, stemmed, frozenset(exceptions), 0.0, 1.0)
    model = Model(lexicon, stemmed, frozenset(exceptions) | _exceptions(sample, model, toxic, clean), 0.0, 1.0)

    def features(batches):
        a = model.automaton()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([model.feature(fold(t), a) for t in texts_of(batch)], pa.float64()), batch.column("toxic")], names=["x", "y"])

    fitted = sample.mapInArrow(features, "x double, y int").groupBy("x", "y").count().toPandas()  # max_rows rows at most
    a, b = _logistic(fitted["x"].to_numpy(), fitted["y"].to_numpy(float), fitted["count"].to_numpy(float))
    return Model(lexicon, stemmed, model.exceptions, a, b)


def _exceptions(sample: DataFrame, model: Model, toxic: int, clean: int) -> frozenset[str]:
    """Word pairs around matches that clean texts have three times or more and toxic ones hardly."""
    def around(batches):
        a = model.automaton()
        for batch in batches:
            seen = Counter()
            for text, y in zip(texts_of(batch), batch.column("toxic").to_pylist()):
                words = fold(text)
                joined = f" {' '.join(words)} "
                i, at = -1, 0  # the number of the word at a hit, counted on from the hit before
                for start, _ in sorted(model.hits(words, a)):
                    i, at = i + joined.count(" ", at, start), start
                    for pair in (words[max(0, i - 1) : i + 1], words[i : i + 2]):
                        if len(pair) == 2:
                            seen[" ".join(pair), y] += 1
            yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in seen], pa.string()), pa.array([y for _, y in seen], pa.int32()), pa.array(list(seen.values()), pa.int64())], names=["pair", "y", "n"])

    n = sample.mapInArrow(around, "pair string, y int, n long").groupBy("pair").agg(F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("n1"), F.sum(F.when(F.col("y") == 0, F.col("n")).otherwise(0)).alias("n0"))
    return frozenset(r.pair for r in n.where((F.col("n0") >= 3) & (F.col("n0") * toxic > 20 * F.col("n1") * clean)).collect())


def _logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """Intercept and slope by Newton's method with a small ridge."""
    X, beta = np.stack([np.ones_like(x), x], 1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(X @ beta, -30, 30)))
        grad = X.T @ (n * (y - p)) - 0.1 * beta
        hess = (X * (n * p * (1 - p))[:, None]).T @ X + 0.1 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])


def score(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row, from its text alone.

    A null or empty text has the score of a text without matches; repeated rows give a row each; an empty
    table gives none; other columns are not read."""
    def run(batch):
        a = _automaton(model)
        s = [model.score(fold(t), a) for t in texts_of(batch)]
        return pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(s, pa.float64())], names=["doc_id", "score"])

    scored = per_text(docs, "doc_id long, score double", run)
    return scored.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


_built: list = []


def _automaton(model: Model):
    """The model's automaton, built once in a worker."""
    if not _built or _built[0] != model:
        _built[:] = [model, model.automaton()]
    return _built[1]


def drop_toxic(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` whose text scores below ``threshold``, with all their columns."""
    def run(batches):
        a = model.automaton()
        for batch in batches:
            for part in byte_slices(batch, "text"):
                yield part.filter(pa.array([model.score(fold(t), a) < threshold for t in texts_of(part)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
