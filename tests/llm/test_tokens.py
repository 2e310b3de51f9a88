"""Token counts and packing against the tokenizer itself."""

import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from retort.llm import packing, tokens
from retort.llm.queries import tokenizer_path

from .conftest import pairs

ODD = ["<|endoftext|>a<|startoftext|>", "<|EndOfText|> Word", "İstanbul İ ẞ ΣΣ Σ", "éa. café... n×. 3÷! a b\x1cc\x85d", "it's 'tis we'll. don't!", "ﬁx ½ 中文. กำ;", "a.,b.;:c?!", "(x). \"y\", z'.", "\U0001f600. ‍,"]


@pytest.fixture(scope="module")
def tok():
    t = Tokenizer.from_file(tokenizer_path())
    return lambda text: t.encode(text, add_special_tokens=False).ids


def test_counts_match_the_library(spark, documents, awkward, tok):
    odd = spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string")
    for df in (documents, awkward, odd):
        got = tokens.token_counts(df, tokenizer_path(), limit=7).collect()
        want = sorted(((d, len(t.encode()), len(n := tok(t)), len(n) > 7) for d, t in pairs(df)), key=str)
        assert sorted((tuple(r)[:4] for r in got), key=str) == want
    assert tokens.token_counts(awkward.limit(0), tokenizer_path(), 7).count() == 0


def test_plain_words_by_the_model(tok):
    import random
    rnd, enc = random.Random(2), tokens.WordEncoder(tokenizer_path(), "<u4")
    letters = "abcdefghijklmnopqrstuvwxyzABCXYZàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿßÀÉÖØÞ"
    for _ in range(4000):
        word = "".join(rnd.choice(letters) for _ in range(rnd.randrange(1, 15)))
        assert np.frombuffer(enc.ids(word.encode()), "<u4").tolist() == tok(word), word


def test_plain_words_go_to_the_library_together(tok):
    """Thousands of new words are a handful of calls, not one each; a model without an end mark still takes them singly."""
    import itertools

    class Counted:
        def __init__(self, inner):
            self.inner, self.calls = inner, 0

        def __getattr__(self, name):
            self.calls += name in ("tokenize", "encode_batch_fast", "encode")
            return getattr(self.inner, name)

    words = ["".join(x) + tail for x, tail in zip(itertools.product("aeÉïNt", repeat=5), itertools.cycle(["", ".", "$$$", "),"]))]
    want = [np.array(tok(w), "<u4").tobytes() for w in words]
    enc = tokens.WordEncoder(tokenizer_path(), "<u4")
    for name in ("tok", "model", "blanks"):
        setattr(enc, name, Counted(getattr(enc, name)))
    assert enc.ids_of(pa.array([" ".join(words)]))[0].as_py() == b"".join(want)
    assert sum(getattr(enc, name).calls for name in ("tok", "model", "blanks")) < len(words) / 100
    enc = tokens.WordEncoder(tokenizer_path(), "<u4")
    enc.final[:] = False
    assert enc.ids_of(pa.array(words[:500])).to_pylist() == want[:500]


def test_ids_of_odd_texts(tok, texts):
    rnd = np.random.default_rng(3)
    parts = ["\t", " ", "  ", "\n", "\x0b", "\x1c", "\x85", "it's", "'", "ab", "É", "×", "7", "<|endoftext|>", "<|", "|>", "e\u0301", "\u0338", "İ", "Σ", "中", *"!\"#$%&()*+,-./:;=?@[\\]^_`{}~"]
    odd = ["", " ", None, *ODD, *WHOLE, *list(texts.values())[:20]] + ["".join(rnd.choice(parts, rnd.integers(1, 12))) for _ in range(3000)]
    enc = tokens.WordEncoder(tokenizer_path(), "<u4", cached=500)
    got = enc.ids_of(pa.array(["left out", *odd, "left out"])[1:-1], b"\2\0\0\0")  # a slice of a batch
    assert got.validate(full=True) is None
    for text, ids in zip(odd, got.to_pylist()):
        assert np.frombuffer(ids, "<u4").tolist() == [*tok(text or ""), 2], text
    for none in ([None, ""], [" "]):
        assert enc.ids_of(pa.array(none, pa.string()), b"\2\0\0\0").to_pylist() == [b"\2\0\0\0"] * len(none)
    raw = pa.array([b"caf\xe9 A\xff\xc3 b", b"\xc3. \xe9"], pa.binary())  # Spark's strings may hold any bytes
    text = pa.Array.from_buffers(pa.string(), len(raw), raw.buffers())
    assert enc.ids_of(text).to_pylist() == [enc.ids(x) for x in raw.to_pylist()]


def test_tokenizers_that_keep_blanks_are_refused():
    import public_tokenizers
    with pytest.raises(ValueError):
        tokens.WordEncoder(public_tokenizers.path("byte_bpe_50k.json"))


def test_every_prefix_of_a_text(texts, tok):
    enc = tokens.WordEncoder(tokenizer_path(), "<u2", cached=50)  # so small that it is emptied again and again
    for text in [*ODD, *sorted(texts.values(), key=len)[:25]]:
        text = text[:300]
        table = tokens.PrefixTable(text.encode(), enc)
        for k in range(len(text) + 1):
            assert table.count(len(text[:k].encode())) == len(tok(text[:k])), (text, k)
        for limit in (0, 1, 5, 1000):
            words = table.fit(limit)
            assert (int(table.counts[words - 1]) if words else 0) <= limit
            assert words == len(table.counts) or table.counts[words] > limit


WHOLE = ["中文字符没有空格的长文本" * 8, "aGVsbG8gd29ybGQhIQ+/" * 8, "function(a,b){return'x'==a?b:can't()}" * 4, "e\u0301a\u0323\u0302o\u0302\u0323" * 4,
         "\u1112\u1161\u11ab\u1100\u1173\u11af" * 5, "we'll'retry''s'vd'x're'", "İİẞΣσß<|endoftext|>ab<|endof<|startoftext|>", "a\x85b\xa0c\u2003d", "กำลังหิวข้าว" * 3,
         "supercalifragilisticexpialidocious" * 3]


def test_every_prefix_inside_a_word(tok):
    import random
    rnd, enc = random.Random(6), tokens.WordEncoder(tokenizer_path(), "<u2")
    parts = ["'", "'", "r", "e", "l", "the", "ing", "é", "e\u0301", "\u0323", "中", "7", "!", "<|", "<|endoftext|>", "\xa0", "İ", "😀", "한", "\u1161", "K", " "]
    texts = WHOLE + ["".join(rnd.choice(parts) for _ in range(rnd.randrange(1, 30))) for _ in range(400)]
    for text in texts:
        table = tokens.PrefixTable(text.encode(), enc)
        counts = [len(tok(text[:k])) for k in range(len(text) + 1)]
        assert [table.count(len(text[:k].encode())) for k in range(len(text) + 1)] == counts, text
        for limit in {0, 1, 2, 7, counts[-1] - 1, counts[-1]} - {-1}:
            best = max(k for k, n in enumerate(counts) if n <= limit)
            assert table.fit_bytes(limit) == len(text[:best].encode()), (text, limit)


def test_long_words_are_encoded_once(tok, monkeypatch):
    enc, text = tokens.WordEncoder(tokenizer_path(), "<u2"), "中文字符没有空格的长文本" * 2000
    table = tokens.PrefixTable(text.encode(), enc)
    monkeypatch.setattr(enc, "learn", lambda words: enc.young)  # the library is not asked again
    fit = table.fit_bytes(2048)
    assert table.fit(2048) == 0 and fit > 0 and len(tok(text.encode()[:fit].decode())) <= 2048 < len(tok(text.encode()[: fit + 3].decode()))
    for n in (3, 30000, 3 * len(text) - 3):
        assert table.count(n) == len(tok(text.encode()[:n].decode()))


def check_packing(rows, ids, window):
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert set(by_doc) == set(ids)
    for d, pieces in by_doc.items():
        at = 0
        for p in sorted(pieces, key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids[d])
            assert p.ids_crc32 == zlib.crc32(ids[d][at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids[d])
    assert sorted(by_seq) == list(range(len(by_seq)))
    for k, spans in by_seq.items():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at == window or k == len(by_seq) - 1


@pytest.mark.parametrize("window,targets", [(4096, None), (256, {"src0": 0.5, "src1": 0.2}), (64, {"src0": 1.0})])
def test_packing_places_each_id_once(documents, tok, window, targets):
    ids = {d: np.array([*tok(t), 2], "<u4") for d, t in pairs(documents)}
    rows = packing.pack(documents.repartition(3), tokenizer_path(), 2, window, targets).collect()
    check_packing(rows, ids, window)
    source = {r.doc_id: r.source for r in documents.collect()}
    total = sum(map(len, ids.values()))
    if targets is None:
        share = sum(len(x) for d, x in ids.items() if source[d] == "src0") / total
        for k in range(total // window - 1):
            assert abs(sum(r.length for r in rows if r.sequence_id == k and source[r.doc_id] == "src0") - share * window) <= packing.GRAIN + 1
    elif targets["src0"] == 0.5:
        first = sum(r.length for r in rows if r.sequence_id == 3 and source[r.doc_id] == "src0")
        assert abs(first - 128) <= packing.GRAIN + 1


def test_packing_of_awkward_rows(awkward, tok):
    df = awkward.where("doc_id is not null and doc_id != 5")
    ids = {d: np.array([*tok(t), 2], "<u4") for d, t in pairs(df)}
    check_packing(packing.pack(df, tokenizer_path(), 2).collect(), ids, 4096)
    rows = packing.pack(awkward, tokenizer_path(), 2, with_ids=True).collect()
    assert sum(r.length for r in rows) == sum(len(tok(t)) + 1 for _, t in pairs(awkward)) == sum(len(r.ids) for r in rows)
    assert packing.pack(awkward.limit(0), tokenizer_path(), 2).count() == 0


def test_round_robin_carries_deficits():
    rr = packing.RoundRobin([1000, 10, 500], [700000, 7000, 341576], 64)
    served = rr.served(np.arange(200))
    assert (np.diff(served, axis=1) >= 0).all() and (served[:, -1] == [1000, 10, 500]).all()
    assert (served[:, 3] - [3 * 64 * w / sum(rr.w) for w in rr.w] > -packing.GRAIN).all()
    for q, n in enumerate((1000, 10, 500)):
        for token in (0, 1, n // 2, n - 1):
            r = rr.round_of(q, token)
            assert rr.served(np.array([r]))[q, 0] <= token < rr.served(np.array([r + 1]))[q, 0]


def brute_stream(mixture, node):
    """Deficit round-robin by hand: the (queue, token) stream of a node."""
    if node < mixture.leaves:
        return [(node, i) for i in range(mixture.T[node])]
    rr, own = mixture.rounds(node), mixture.children[node]
    streams = [brute_stream(mixture, c) for c in own]
    total = sum(mixture.w[c] for c in own)
    deficit, at, out = [Fraction(int(x)) for x in rr.ahead], [0] * len(own), []
    while any(at[i] < len(x) for i, x in enumerate(streams)):
        for i, c in enumerate(own):
            deficit[i] += Fraction(mixture.window * mixture.w[c], total)
            spend = int(deficit[i]) // int(rr.grain[i]) * int(rr.grain[i])
            deficit[i] -= spend
            out += streams[i][at[i] : at[i] + spend]
            at[i] += spend
    return out


@pytest.mark.parametrize("scale", [1, 1 << 40])  # weights of 64 bits and beyond
def test_mixture_is_round_robin_over_a_thousand_sources(scale):
    rng = np.random.default_rng(5)
    totals = [20000, 3000, *rng.integers(1, 150, 1000).tolist()]
    mixture = packing.Mixture(totals, [n * scale for n in totals], 256)
    stream = brute_stream(mixture, mixture.root)
    assert len(stream) == sum(totals)
    where = {x: i for i, x in enumerate(stream)}
    docs = [(q, a, min(90, n - a)) for q, n in enumerate(totals) for a in range(0, n, 90)]
    order = rng.permutation(len(docs))
    queue, first, n = (np.array([docs[i][k] for i in order], np.int64) for k in range(3))
    got = {}
    for part in np.array_split(np.arange(len(docs)), 7):  # any slice places its own documents
        for d, start, length, at in zip(*(x.tolist() for x in mixture.place(queue[part], first[part], n[part]))):
            assert at // 256 == (at + length - 1) // 256
            got |= {(int(queue[part][d]), int(first[part][d]) + start + i): at + i for i in range(length)}
    assert got == where


def test_shares_with_many_small_sources():
    """A third of all tokens in one source beside 100,000 small ones: its share in each window, and little memory."""
    import tracemalloc

    small = [64 + i % 90 for i in range(100_000)]
    hot = sum(small) // 2
    mixture = packing.Mixture([hot, *small], [hot, *small], 4096)
    first = np.arange(0, hot, 400)
    _, _, length, at = mixture.place(np.zeros(len(first), np.int64), first, np.minimum(400, hot - first))
    held = np.bincount(at // 4096, weights=length)
    last = (hot + sum(small)) // 4096
    assert abs(held[: last - 20] / 4096 - 1 / 3).max() <= (packing.GRAIN + 2) / 4096
    tracemalloc.start()
    queue = np.arange(1, 5001) * 20
    _, _, length, _ = mixture.place(queue, np.zeros(5000, np.int64), np.array(small)[queue - 1])
    assert length.sum() == np.array(small)[queue - 1].sum() and tracemalloc.get_traced_memory()[1] < 300 << 20
    tracemalloc.stop()
