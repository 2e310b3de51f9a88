"""Exact token counts of a word's character prefixes by dynamic programming over its bytes.

In byte-pair encoding the tokens of a string, up to any token, are the tokens of the string up to there, and
tokens follow one another exactly if each two neighbours are their own encoding. So the encoding of a prefix is
that of a shorter one and one more token that agrees with the last: a step looks at one candidate for each token
length, and nothing is encoded twice. The last token of a prefix carries the end-of-word mark and is found the same way.
"""

from __future__ import annotations

import functools
import json
import re
import unicodedata
from collections.abc import Iterator

CONTRACTIONS = frozenset(("'s", "'t", "'re", "'ve", "'m", "'ll", "'d"))
BEGUN = frozenset(c[:2] for c in CONTRACTIONS if len(c) == 3)
SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_LETTERS = {b: chr(b) for b in SHOWN} | {b: chr(256 + i) for i, b in enumerate(x for x in range(256) if x not in SHOWN)}


@functools.cache
def followers() -> frozenset[str]:
    """Characters that may join or move before the one to their left under NFC, besides those with a combining class."""
    pairs = (unicodedata.decomposition(chr(c)).split() for c in range(0xC0, 0x30000))
    return frozenset([chr(int(p[1], 16)) for p in pairs if len(p) == 2 and not p[0].startswith("<")]
                     + [chr(c) for c in (*range(0x1161, 0x1176), *range(0x11A8, 0x11C3))])


class PrefixCounter:
    """Counts of the prefixes of single words for a tokenizer that ``WordEncoder`` takes."""

    def __init__(self, tok):
        model = json.loads(tok.to_str())["model"]
        merges = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.rank = {tuple(m): i for i, m in enumerate(merges)}
        self.suffix = model.get("end_of_word_suffix") or ""
        self.ends = frozenset(t[: len(t) - len(self.suffix)] for t in model["vocab"] if t.endswith(self.suffix)) - {""}
        self.plain = frozenset(t for t in model["vocab"] if not self.suffix or not t.endswith(self.suffix))
        self.reach = max(map(len, self.ends | self.plain))
        special = sorted((t.content for t in tok.get_added_tokens_decoder().values()), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special)) or r"(?!)")
        self.tok, self.seen, self.kinds, self.normals, self.wholes = tok, {}, {}, {}, {}

    def merged(self, symbols: list[str]) -> list[str]:
        while len(symbols) > 1:
            best, at = min((self.rank.get(p, len(self.rank)), i) for i, p in enumerate(zip(symbols, symbols[1:])))
            if best == len(self.rank):
                break
            symbols = [*symbols[:at], symbols[at] + symbols[at + 1], *symbols[at + 2 :]]
        return symbols

    def agree(self, left: str | None, right: str, end: bool) -> bool:
        """Whether ``left`` and ``right`` (at a word's end or not) are the encoding of their text."""
        key = left, right, end
        if (known := self.seen.get(key)) is None:
            if len(self.seen) > 1_000_000:
                self.seen.clear()
            tail = self.suffix if end else ""
            want = [right + tail] if left is None else [left, right + tail]
            known = self.seen[key] = self.merged([*(left or ""), *right[:-1], right[-1] + tail]) == want
        return known

    def kind(self, c: str) -> str:
        """L(etter), N(umber), O(ther) or blank, as the pre-tokenizer cuts them."""
        if (k := self.kinds.get(c)) is None:
            cut = self.tok.pre_tokenizer.pre_tokenize_str
            k = self.kinds[c] = " " if not cut(c) else "L" if len(cut("a" + c)) == 1 else "O" if len(cut("!" + c)) == 1 else "N"
        return k

    def normal(self, text: str) -> str:
        if len(text) > 1 or text not in self.normals:
            n = self.tok.normalizer.normalize_str(text) if self.tok.normalizer else text
            if len(text) > 1:
                return n
            self.normals[text] = n
        return self.normals[text]

    def whole(self, piece: str) -> int:
        if piece not in self.wholes:
            self.wholes[piece] = len(self.tok.model.tokenize("".join(BYTE_LETTERS[b] for b in piece.encode())))
        return self.wholes[piece]

    def walk(self, word: str) -> Iterator[tuple[int, int, int]]:
        """(characters, tokens, floor) of each non-empty prefix; no longer prefix has fewer than ``floor`` tokens."""
        at = base = 0
        while at < len(word):
            special = self.special.search(word, at)
            begin, stop = (special.start(), special.end() - 1) if special else (len(word), len(word))
            run, before, held = _Runs(self, base), base, base
            k = at
            while k < stop:
                e = k + 1
                while e < stop and (unicodedata.combining(word[e]) or word[e] in followers()):
                    e += 1
                low = run.floor()
                for j in range(k + 1, e + 1):
                    # a prefix that ends inside a cluster is normalized without the cluster's rest
                    state = run.state() if j < e else None
                    for c in self.normal(word[k:j]):
                        run.push(c)
                    count = run.count()
                    if j <= begin:
                        before, held = count, low
                    if j < e:
                        run.restore(state)
                    yield j, count, min(low, held) if j > begin else low
                k = e
            if special:
                at, base = special.end(), before + 1
                yield at, base, base
            else:
                at = stop


class _Runs:
    """Tokens of a text that grows by a character, cut into runs as the pre-tokenizer does."""

    def __init__(self, counter: PrefixCounter, base: int):
        self.k, self.base, self.pending = counter, base, None
        self.open("")

    def open(self, kind: str) -> None:
        #: last token and number of tokens of the run up to each byte, without the end mark
        self.kind, self.last, self.n, self.tail = kind, [None], [0], ""

    def state(self):
        return self.base, self.pending, self.kind, self.last, self.n, self.tail, len(self.n)

    def restore(self, state) -> None:
        self.base, self.pending, self.kind, self.last, self.n, self.tail, size = state
        del self.last[size:], self.n[size:]

    def find(self, end: bool) -> tuple[str, int]:
        """The last token of the run, and the number of its tokens."""
        k, tail, tokens = self.k, self.tail, self.k.ends if end else self.k.plain
        done = len(self.n) - end  # bytes of the run; without the end mark, the one that is being added too
        for size in range(min(k.reach, done), 0, -1):
            t = tail[-size:]
            if t in tokens and k.agree(None, t, end):
                left = self.last[done - size]
                if left is None or k.agree(left, t, end):
                    return t, self.n[done - size] + 1
        raise ValueError("this tokenizer's merges do not spell every string")

    def count(self) -> int:
        return self.base + (self.find(True)[1] if self.tail else 0)

    def floor(self) -> int:
        """The least number of tokens that the text may have whatever follows: some token of it ends within
        reach of the end, and the tokens up to there stay."""
        if self.pending:
            return self.pending[0]
        return self.base + min(self.n[-self.k.reach :])

    def push(self, c: str) -> None:
        kind = self.k.kind(c)
        if self.pending:
            base, seen = self.pending[0], self.pending[1] + c
            self.pending = (base, seen) if seen in BEGUN else None
            if seen in CONTRACTIONS:
                self.base = base + self.k.whole(seen)
                self.open("")
                return
        if kind == " " or kind != self.kind or kind == "N":
            self.base = self.count()
            self.open(kind)
            if kind == " ":
                return
            if c == "'":
                self.pending = (self.base, c)
        for b in c.encode():
            self.tail = (self.tail + BYTE_LETTERS[b])[-self.k.reach :]
            t, n = self.find(False)
            self.last.append(t)
            self.n.append(n)
