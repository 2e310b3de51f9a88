"""Secret scans: Boolean trigram queries from each rule's regex, an inverted index, then verification.

Each task indexes a slice of texts as one segment: for the trigrams that some rule asks for, the sorted
rows holding them. A rule's query intersects and unites those postings; only rows that satisfy it are
matched by the regex. A rule whose regex has no mandatory trigram matches every row. Segments need no
shuffle, and a trigram that is common in one source fills only the postings of its own segments.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from re import _constants as sre
from re import _parser as sre_parse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retort.llm.common import byte_slices, per_text, texts_of

#: Alternatives followed while a mandatory run of a regex is spelt out.
MAX_ALTERNATIVES = 64


@dataclass(frozen=True)
class Rule:
    """A kind, its regex, and the least length of the match or of one group. A match that is too short
    is dropped; the search goes on after it. The span starts where the group ``begin`` does."""
    kind: str
    pattern: str
    least: int = 0
    group: int = 0
    begin: int = 0

    def find(self, text: str):
        for m in _compiled(self.pattern).finditer(text):
            if len(m[self.group]) >= self.least:
                yield m.start(self.begin), m.end()


#: The base kinds, in their order, and those the scan adds.
BASE_RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", r"[0-9a-f]+", 24),
)
#: What may stand around a line of a key (indents, quotes, comment and diff marks), line ends as they are
#: or escaped, a line's rest, and the base64 alphabet.
AROUND = r"""[\x20\t"',;>|#*+-]*+"""
BREAK = r"(?:[\r\n]|\\[rn])"
REST = r"""(?=[\x20\t"',;+]*+(?:[\r\n\\]|\Z))"""
B64 = r"[A-Za-z0-9+/]"
#: A key's text from its BEGIN line to its END line, which is the next mark of five dashes; where there is
#: none, the header and base64 lines that follow, or base64 pieces too long for words on the same line.
KEY_BODY = (
    r"(?:[^-]*+(?:-(?!----)[^-]*+)*+-{5,}+END [A-Z0-9 ]*PRIVATE KEY-----"
    rf"|(?:{AROUND}(?:{BREAK}{AROUND})++(?:[A-Z][A-Za-z]*+-[A-Z][A-Za-z-]*+:[^\r\n\\]*+|{B64}++={{0,2}}{REST})"
    rf"|(?:[\x20\t]*+{B64}{{32,}}+={{0,2}})++(?:[\x20\t]++{B64}++={{0,2}}(?=\s*+\Z))?)*+)"
)
#: The base64url alphabet of a token's parts.
PART = r"[A-Za-z0-9_-]"
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY-----" + KEY_BODY),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36,}+"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}+"),
    # Looked for only at the left end of a run that two more parts follow, so each run is read a fixed
    # number of times; characters of the run before eyJ are not in the span.
    Rule("jwt", rf"(?<!{PART})(?={PART}++\.{PART}{{8,}}+\.{PART}{{8}}){PART}*?()eyJ{PART}{{8,}}+\.{PART}{{8,}}+\.{PART}{{8,}}+", begin=1),
)
RULES = BASE_RULES + MORE_RULES
KINDS = tuple(r.kind for r in RULES)

_cache: dict[str, re.Pattern] = {}


def _compiled(pattern: str) -> re.Pattern:
    if pattern not in _cache:
        _cache[pattern] = re.compile(pattern, re.ASCII)
    return _cache[pattern]


def trigram_query(pattern: str) -> list[list[frozenset[str]]]:
    """The trigrams a match must hold: an AND of clauses, each an OR of sets that must be present whole.
    Empty: nothing is mandatory. Trigrams are in lower case, which only widens the candidates."""
    clauses: list[list[frozenset[str]]] = []

    def close(run: set[str]) -> None:
        if run and all(len(s) >= 3 for s in run):
            clauses.append([frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in sorted(run)])

    def spell(op, arg) -> set[str] | None:
        """The strings an item stands for, or None where they are many."""
        if op is sre.LITERAL:
            return {chr(arg).lower()}
        if op is sre.IN and len(arg) <= 8 and all(k is sre.LITERAL for k, _ in arg):
            return {chr(v).lower() for _, v in arg}
        if op is sre.SUBPATTERN:
            return spell_all(arg[-1])
        if op is sre.BRANCH:
            parts = [spell_all(b) for b in arg[1]]
            return None if any(p is None for p in parts) else set().union(*parts)
        if op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[1] <= 1:
            inner = spell_all(arg[2])
            return None if inner is None else inner | ({""} if arg[0] == 0 else set())
        return None

    def spell_all(seq) -> set[str] | None:
        run = {""}
        for op, arg in seq:
            part = spell(op, arg)
            if part is None or len(run) * len(part) > MAX_ALTERNATIVES:
                return None
            run = {a + b for a in run for b in part}
        return run

    run: set[str] = {""}
    for op, arg in sre_parse.parse(pattern):
        part = spell(op, arg)
        if part is None or len(run) * len(part) > MAX_ALTERNATIVES:
            close(run)
            run = {""} if part is None else part
        else:
            run = {a + b for a in run for b in part}
    close(run)
    return clauses


class SegmentIndex:
    """Postings of the wanted trigrams over one slice of texts."""

    def __init__(self, wanted: list[str]):
        self.place = {g: i for i, g in enumerate(wanted)}
        self.table = np.zeros(1 << 24, np.uint8)  # one entry for each three bytes: 1 + the trigram's place
        for g, i in self.place.items():
            a, b, c = g.encode("ascii")
            self.table[a << 16 | b << 8 | c] = i + 1
        self.fold = np.arange(256, dtype=np.uint8)
        self.fold[65:91] += 32

    def postings(self, column: pa.Array) -> list[np.ndarray]:
        column = column.cast(pa.large_binary())
        offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        empty = [np.empty(0, np.int64)] * len(self.place)
        if not len(column) or offsets[-1] - offsets[0] < 3:
            return empty
        data = self.fold[np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]].astype(np.uint32)
        ids = self.table[data[:-2] << 16 | data[1:-1] << 8 | data[2:]]
        at = np.flatnonzero(ids)
        ends = offsets[1:] - offsets[0]
        row = np.searchsorted(ends, at, side="right")
        whole = at + 3 <= ends[row]  # not across two texts
        row, ids = row[whole], ids[at][whole]
        return [np.unique(row[ids == i + 1]) for i in range(len(self.place))]

    def candidates(self, query: list[list[frozenset[str]]], postings: list[np.ndarray], n: int) -> np.ndarray:
        rows = np.arange(n)
        for clause in query:
            either = [np.empty(0, np.int64)]
            for grams in clause:
                both = None
                for g in grams:
                    p = postings[self.place[g]]
                    both = p if both is None else np.intersect1d(both, p, assume_unique=True)
                either.append(both)
            rows = np.intersect1d(rows, np.unique(np.concatenate(either)), assume_unique=True)
        return rows


_indexes: dict[tuple, tuple] = {}


def _plan(rules: tuple[Rule, ...]):
    if rules not in _indexes:
        queries = [trigram_query(r.pattern) for r in rules]
        wanted = sorted({g for q in queries for clause in q for grams in clause for g in grams})
        if len(wanted) > 255:
            raise ValueError("the rules ask for more than 255 trigrams; scan them in several calls")
        _indexes[rules] = queries, SegmentIndex(wanted)
    return _indexes[rules]


def scan(column: pa.Array, texts: list[str], rules: tuple[Rule, ...]) -> list[list[tuple[str, int, int]]]:
    """The spans of each text (code points), through the segment's index."""
    queries, index = _plan(rules)
    postings = index.postings(column)
    spans: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    for rule, query in zip(rules, queries):
        for row in index.candidates(query, postings, len(texts)):
            spans[row] += [(rule.kind, a, b) for a, b in rule.find(texts[row])]
    return spans


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, spans: array of (kind, start, end)) of every whole text, code points, end exclusive,
    ordered by start and the rules' order.

    A null or empty text has no spans; repeated rows give a row each; an empty table gives none; columns
    beyond ``doc_id`` and ``text`` are ignored. Spans of different kinds may overlap."""
    rank = {r.kind: i for i, r in enumerate(rules)}
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batch):
        found = scan(batch.column("text"), texts_of(batch), rules)
        rows = [[{"kind": k, "start": a, "end": b} for k, a, b in sorted(x, key=lambda s: (s[1], rank[s[0]]))] for x in found]
        return pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(rows, kind)], names=["doc_id", "spans"])

    return per_text(docs, "doc_id long, spans array<struct<kind: string, start: long, end: long>>", run)


def mask_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with each secret of ``text`` replaced by ``mask`` (overlapping spans by one), ``n_chars``
    (where present) set anew, and every other column and row kept. Null and clean texts stay as they are."""
    names, schema = docs.columns, docs.schema

    def cover(text: str, spans) -> str:
        out, at = [], 0
        for _, a, b in sorted(spans, key=lambda s: s[1]):
            if a >= at:
                out += [text[at:a], mask]
            at = max(at, b)
        return "".join(out) + text[at:]

    def run(batches):
        for batch in batches:
            for part in byte_slices(batch, "text"):
                texts = texts_of(part)
                new = [cover(t, s) if s else None for t, s in zip(texts, scan(part.column("text"), texts, rules))]
                i = names.index("text")
                kept = part.column("text").to_pylist()
                cols = list(part.columns)
                cols[i] = pa.array([k if n is None else n for k, n in zip(kept, new)], cols[i].type)
                if "n_chars" in names:
                    j = names.index("n_chars")
                    old = cols[j].to_pylist()
                    cols[j] = pa.array([o if n is None else len(n) for o, n in zip(old, new)], cols[j].type)
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return docs.mapInArrow(run, schema)


def digest(spans: DataFrame) -> DataFrame:
    """The contract's columns from ``find_secrets``."""
    joined = lambda col: F.array_join(F.transform(col, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("spans", lambda s: s["kind"].isin(*[r.kind for r in BASE_RULES]))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return spans.select("doc_id", *[count(r.kind).alias(f"n_{r.kind}") for r in BASE_RULES],
                        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
