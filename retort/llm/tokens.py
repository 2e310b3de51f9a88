"""Token counts and ids by the library's own tokenizer, one encoding for each distinct word.

The pre-tokenizer drops white space and no token spans it, so a text's tokens are those of its
ASCII-blank-separated words in order. Words repeat, so each worker keeps a bounded table of words it
has seen and gives only new ones to the library, plain ones many in a call. The table is a cache: its size
changes time, never results. A slice's texts are cut into words, its words numbered and their ids laid end
to end by Arrow; Python sees each distinct word of a slice once.
"""

from __future__ import annotations

import functools
import os
import re
from array import array
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from retort.llm.common import bytes_of, per_text
from retort.llm.prefixes import BYTE_LETTERS, PrefixCounter

#: Words a worker keeps, in each of two generations.
CACHED_WORDS = 300_000
#: Stops cut from a new word's end, and the ASCII letters and digits they may follow. Apostrophes begin
#: contractions; characters of special strings are left out too, when an encoder is made.
STOPS = b"!\"#$%&()*+,-./:;=?@[\\]^_`{}~"
#: Words of ASCII and Latin-1 letters only: the tokenizer's normalizer lowers them and its pre-tokenizer
#: keeps them whole, so they go straight to the library's model, byte by byte as its alphabet spells them.
LETTERS = re.compile(rb"(?:[a-zA-Z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+").fullmatch
#: Checked when an encoder is made, so that a tokenizer of another kind is refused.
PROBE = "Once  upon a Time, the\tÉlan's <|endoftext|> cost: 12.50\n(naïve) ß! x.y <|EndOfText|> ÀÖØöø"
#: Plain words given to the library as one string.
TOGETHER = 1024
#: Characters whose prefix counts a worker keeps.
CACHED_PREFIXES = 2_000_000
#: Bytes of words between blanks as the model's alphabet spells them.
SPELLED = BYTE_LETTERS | {32: " "}
ALNUM = frozenset(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")


class WordEncoder:
    """Words (bytes without ASCII blanks) -> little-endian ids of ``dtype`` as bytes."""

    def __init__(self, path: str, dtype: str = "<u4", cached: int = CACHED_WORDS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.model = self.tok.model
        self.dtype, self.cached = np.dtype(dtype), cached
        self.code = {2: "H", 4: "I"}[self.dtype.itemsize]
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.inside: dict[bytes, tuple[np.ndarray, np.ndarray]] = {}
        self.kept = 0
        special = "".join(t.content for t in self.tok.get_added_tokens_decoder().values()).encode()
        self.stops = bytes(c for c in STOPS if c not in special)
        #: The model alone, over words between blanks, and the ids that it ends a word with (none: not marked).
        self.blanks, suffix = Tokenizer(self.model), getattr(self.model, "end_of_word_suffix", None)
        self.blanks.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        vocab = self.blanks.get_vocab(with_added_tokens=False)
        self.final = np.zeros(max(vocab.values(), default=0) + 1, bool)
        self.final[[i for t, i in vocab.items() if suffix and t.endswith(suffix)]] = True
        probe = " ".join([PROBE, *(f"ab{chr(c)} É{chr(c) * 3} 7{chr(c)}." for c in self.stops), "ab" + self.stops.decode()])
        if np.frombuffer(self.ids(probe.encode()), self.dtype).tolist() != self.tok.encode(probe, add_special_tokens=False).ids:
            raise ValueError(f"{path}: this tokenizer does not take a text word by word")

    @staticmethod
    def words(text: bytes) -> list[bytes]:
        """The words, A-Z in lower case as the tokenizer's normalizer has them. Special strings are
        matched before it, in their own case, so a text that may hold one keeps its case."""
        return text.split() if b"<|" in text else text.lower().split()

    def learn(self, words: Iterable[bytes]) -> dict[bytes, bytes]:
        """The table, holding every word of ``words`` (distinct)."""
        if len(self.young) > self.cached:
            self.old, self.young = self.young, {}
        young, old, stops = self.young, self.old, self.stops
        new, ended = set(), []
        for w in set(words).difference(young):
            ids = old.get(w)
            if ids is not None:
                young[w] = ids
                continue
            # a stop after a letter or digit is a piece of its own
            stem = w.rstrip(stops)
            if len(stem) < len(w) and stem and (stem[-1] in ALNUM or len(stem) > 1 and stem[-2] == 0xC3 and stem[-1] not in (0x97, 0xB7)):
                stop = w[len(stem):]
                ended.append((w, stem, stop))
                for part in (stem, stop):
                    if part not in young:
                        if (ids := old.get(part)) is None:
                            new.add(part)
                        else:
                            young[part] = ids
            else:
                new.add(w)
        code = self.code
        plain = [w for w in new if w.isalpha() or LETTERS(w)]
        for i in range(0, len(plain), TOGETHER):
            part = plain[i : i + TOGETHER]
            young.update(zip(part, self.letters(part)))
        new = list(new.difference(plain))
        for i in range(0, len(new), 4096):
            part = new[i : i + 4096]
            encoded = self.tok.encode_batch_fast([w.decode("utf-8", "replace") for w in part], add_special_tokens=False)
            for w, e in zip(part, encoded):
                young[w] = array(code, e.ids).tobytes()
        for w, stem, stop in ended:
            young[w] = young[stem] + young[stop]
        return young

    def letters(self, words: list[bytes]) -> list[bytes]:
        """The ids of words that ``LETTERS`` takes. The last token of each word bears the end-of-word mark and
        no other does; where the model has no mark, each word goes by itself."""
        spelled = b" ".join(words).decode().lower().encode().decode("latin-1").translate(SPELLED)
        ids = np.array(self.blanks.encode_batch_fast([spelled], add_special_tokens=False)[0].ids, self.dtype)
        ends = np.flatnonzero(self.final[ids]) + 1
        if len(ends) != len(words) or ends[-1] != len(ids):
            return [array(self.code, [t.id for t in self.model.tokenize(w)]).tobytes() for w in spelled.split(" ")]
        packed, cuts = ids.tobytes(), (ends * self.dtype.itemsize).tolist()
        return [packed[a:b] for a, b in zip([0, *cuts], cuts)]

    def ids(self, text: bytes) -> bytes:
        words = self.words(text)
        return b"".join(map(self.learn(words).__getitem__, words))

    @functools.cached_property
    def counter(self) -> PrefixCounter:
        return PrefixCounter(self.tok)

    def prefixes(self, word: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Byte ends and exact token counts of a word's character prefixes, worked out once for each distinct word."""
        if word not in self.inside:
            text = word.decode()
            counts = np.fromiter((n for _, n, _ in self.counter.walk(text)), np.int64, len(text))
            if counts[-1] != len(self.learn([word])[word]) // self.dtype.itemsize:
                raise ValueError("this tokenizer's prefixes do not follow from its merges")
            if self.kept > CACHED_PREFIXES:
                self.inside, self.kept = {}, 0
            starts = np.flatnonzero(np.frombuffer(word, np.uint8) & 0xC0 != 0x80)
            self.inside[word] = np.append(starts[1:], len(word)), counts
            self.kept += len(text)
        return self.inside[word]

    def fit_inside(self, word: bytes, limit: int) -> int:
        """Bytes of the word's longest character prefix with at most ``limit`` tokens; counts may fall again
        as a prefix grows, so the walk ends where no longer prefix can fit."""
        text, best = word.decode(), 0
        for k, n, floor in self.counter.walk(text):
            if n <= limit:
                best = k
            elif floor > limit:
                break
        return len(text[:best].encode())

    def ids_of(self, texts: pa.Array, end: bytes = b"") -> pa.Array:
        """The ids of each text (null: none) with ``end`` after them."""
        lists = words_of(texts)
        ends = np.asarray(lists.offsets, np.int64)[1:] - lists.offsets[0].as_py()
        coded = lists.flatten().dictionary_encode()
        words = coded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
        table = self.learn(words)
        known = pa.array([*map(table.__getitem__, words), end], pa.binary())
        # a word more in every text, its end
        laid = known.take(pa.array(np.insert(coded.indices.to_numpy(), ends, len(words))))
        at = np.frombuffer(laid.buffers()[1], np.int32)[np.append(0, ends + np.arange(1, len(ends) + 1))]
        return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(at), laid.buffers()[2]])


def words_of(texts: pa.Array) -> pa.ListArray:
    """``WordEncoder.words`` of every text (null: none), with an empty word for blanks at a text's begin or end."""
    texts = pc.fill_null(texts, "")
    return pc.ascii_split_whitespace(pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts)))


@functools.lru_cache(maxsize=4)
def encoder(path: str, dtype: str = "<u4") -> WordEncoder:
    """One encoder for each worker process and vocabulary."""
    return WordEncoder(path, dtype)


class PrefixTable:
    """Exact token counts of the prefixes of one text, by dynamic programming over its words:
    count(prefix through word i) = count(prefix through word i-1) + tokens of word i.

    ``ends`` are byte offsets of word ends and ``counts`` the tokens up to them; blanks add nothing, so
    the two arrays give the count of every prefix that ends outside a word. A prefix that ends within
    a word adds the count of that word's own prefix, from a table made once for each distinct word
    (``prefixes.py``); nothing is encoded again."""

    def __init__(self, text: bytes, enc: WordEncoder, words: list[bytes] | None = None, table: dict[bytes, bytes] | None = None):
        self._words, self._ends = enc.words(text) if words is None else words, None
        table, n = (enc.learn(self._words) if table is None else table).__getitem__, len(self._words)
        self.text, self.enc = text, enc
        self.counts = np.cumsum(np.fromiter(map(len, map(table, self._words)), np.int64, n) // enc.dtype.itemsize)

    @property
    def total(self) -> int:
        return int(self.counts[-1]) if len(self.counts) else 0

    @property
    def ends(self) -> np.ndarray:
        if self._ends is None:
            folded = self.text if b"<|" in self.text else self.text.lower()
            ends, at = np.empty(len(self._words), np.int64), 0
            for i, w in enumerate(self._words):
                at = folded.index(w, at) + len(w)
                ends[i] = at
            self._ends = ends
        return self._ends

    def count(self, n_bytes: int) -> int:
        """Tokens of ``text[:n_bytes]`` (a cut between characters)."""
        i = int(np.searchsorted(self.ends, n_bytes, side="right"))
        done = int(self.counts[i - 1]) if i else 0
        inside = n_bytes - self.start(i) if i < len(self._words) else 0
        if inside <= 0:
            return done
        ends, counts = self.enc.prefixes(self._words[i])
        k = int(np.searchsorted(ends, inside))
        if ends[k] != inside:
            raise ValueError(f"{n_bytes} is not between characters")
        return done + int(counts[k])

    def start(self, i: int) -> int:
        """The byte offset of word ``i``."""
        return int(self.ends[i]) - len(self._words[i])

    def fit(self, limit: int) -> int:
        """Words of the longest prefix of whole words with at most ``limit`` tokens."""
        return int(np.searchsorted(self.counts, limit, side="right"))

    def fit_bytes(self, limit: int) -> int:
        """Bytes of the longest prefix of whole characters with at most ``limit`` tokens, blanks after it
        included. The first word that does not fit holds its end: any prefix beyond has that word's tokens."""
        i = self.fit(limit)
        if i == len(self._words):
            return len(self.text)
        return self.start(i) + self.enc.fit_inside(self._words[i], limit - (int(self.counts[i - 1]) if i else 0))


def token_counts(docs: DataFrame, path: str, limit: int) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit, fit_words, fit_bytes) of every whole text.

    ``fit_words`` and ``fit_bytes`` answer the truncation question: the words of the longest prefix of whole
    words, and the bytes of the longest prefix of whole characters, that keep to ``limit`` tokens. A null or empty text has 0 bytes and 0 tokens; repeated rows give a row
    each; an empty table gives none; columns beyond ``doc_id`` and ``text`` are ignored."""
    def run(batch):
        enc, size, total, fit, fit_bytes = encoder(path, "<u2" if _small(path) else "<u4"), [], [], [], []
        texts = bytes_of(batch)
        split = [enc.words(t) for t in texts]
        known = enc.learn(set().union(*split))
        for t, words in zip(texts, split):
            table = PrefixTable(t, enc, words, known)
            size.append(len(t))
            total.append(table.total)
            fit.append(table.fit(limit))
            fit_bytes.append(table.fit_bytes(limit))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id").cast(pa.int64()), pa.array(size, pa.int64()), pa.array(total, pa.int64()),
             pa.array([n > limit for n in total], pa.bool_()), pa.array(fit, pa.int64()),
             pa.array(fit_bytes, pa.int64())],
            names=["doc_id", "n_bytes", "n_tokens", "over_limit", "fit_words", "fit_bytes"])

    return per_text(docs, "doc_id long, n_bytes long, n_tokens long, over_limit boolean, fit_words long, fit_bytes long", run)


@functools.lru_cache(maxsize=4)
def _small(path: str) -> bool:
    """Whether every id of the vocabulary fits 16 bits."""
    return encoder(path).tok.get_vocab_size(with_added_tokens=True) <= 1 << 16
