"""Quality rules, their ledger, policies and ablations."""

import re
from collections import Counter

from pyspark.sql import functions as F

from retort.llm import quality as Q

from .conftest import pairs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text)
    grams = list(zip(words, words[1:], words[2:]))
    times = Counter(grams)
    covered = {i + j for i, g in enumerate(grams) if times[g] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)), "n_lines": len(lines),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
            "n_letter_words": sum(any(c.isascii() and c.isalpha() or ord(c) > 127 for c in w) for w in words),
            "n_letters": len(re.findall("[A-Za-z]", text)), "n_capitals": len(re.findall("[A-Z]", text))}


def brute_bits(m):
    n = m["n_words"]
    checks = [n < 50, 100 * m["n_repeat_words"] > 50 * n, 10 * m["n_symbols"] > n, m["word_chars"] < 3 * n, m["word_chars"] > 10 * n,
              100 * m["n_dup_lines"] > 50 * m["n_lines"], 100 * m["n_letter_words"] < 80 * n, 100 * m["n_capitals"] > 50 * m["n_letters"], n > 100000]
    return sum(1 << i for i, c in enumerate(checks) if c)


def expected(rows):
    return sorted(((d, *(m := brute(t)).values(), brute_bits(m)) for d, t in rows), key=str)


def test_ledger_matches_brute_force(documents, awkward):
    for docs in (documents, awkward):
        assert sorted(map(tuple, Q.ledger(docs).collect()), key=str) == expected(pairs(docs))
    assert Q.ledger(awkward.limit(0)).count() == 0


def test_long_and_repetitive_texts(spark):
    texts = ["x " * 400000, " ".join(f"w{i}" for i in range(200000)), "\n" * 5000, "a b\n" * 30000, "é# " * 70]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(map(tuple, Q.ledger(docs).collect()), key=str) == expected(enumerate(texts))


def test_policies_read_the_same_ledger(documents):
    rows = Q.ledger(documents).cache()
    bits = {r.doc_id: r.failed for r in rows.collect()}
    for policy in Q.POLICIES:
        for r in Q.judge(rows, policy).collect():
            left = [name for name in policy.rules if bits[r.doc_id] & Q.BITS[name]]
            assert (r.kept, r.sole_rule, r.policy) == (not left, left[0] if len(left) == 1 else None, policy.name)
    assert [1 << i for i in range(len(Q.RULES))] == list(Q.BITS.values())


def test_ablations_match_rules_left_out(documents):
    rows = Q.ledger(documents).cache()
    bits = [r.failed for r in rows.collect()]
    got = {(r.policy, r.rule): tuple(r)[2:] for r in Q.ablations(rows).collect()}
    for p in Q.POLICIES:
        for rule in p.rules:
            b = Q.BITS[rule]
            want = (len(bits), sum(bool(x & b) for x in bits), sum(x & p.mask == b for x in bits), sum(not x & p.mask for x in bits), sum(not x & p.mask & ~b for x in bits))
            assert got[p.name, rule] == want
    assert len(got) == sum(len(p.rules) for p in Q.POLICIES)
    assert {tuple(r)[2:] for r in Q.ablations(rows.limit(0)).collect()} == {(0,) * 5}


def test_junk_goes_and_prose_stays(spark, documents, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = Q.digest(Q.judge(Q.ledger(documents))).join(labels, "doc_id").where("not base_failed")
    got = {(r.quality, r.kept): r.n for r in rows.groupBy("quality", "kept").agg(F.count("*").alias("n")).collect()}
    assert got.get((1, False), 0) == 0 and got.get((0, True), 0) == 0 and got[1, True] > 0
