"""Secrets, personal data, toxicity, benchmark leaks and fingerprints against brute force."""

import hashlib
import random
import re
import time
import tracemalloc
import zlib

import numpy as np
import pytest

from retort.llm import decontaminate, fingerprint, pii, secrets, toxicity

from .conftest import pairs

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def listed(spans, kinds):
    return ",".join(f"{k}:{a}:{b}" for a, k, b in sorted(spans, key=lambda s: (s[0], kinds.index(s[1]))))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_secrets(text):
    out = []
    for kind, pattern, least, group in (("assign", ASSIGN, 6, 2), ("access", "AKIA[A-Z0-9]+", 20, 0), ("hex", "[0-9a-f]+", 24, 0)):
        out += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text, re.A) if len(m[group]) >= least]
    return listed(out, ["assign", "access", "hex"])


def luhn(digits):
    total = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits)))
    return total % 10 == 0


def brute_pii(text):
    out = [(m.start(), "email", m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), "ip", m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for kind, pattern, low, high in (("card", r"[0-9]([\x20-]?[0-9])+", 14, 19), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 10, 15)):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if low <= len(digits) <= high and (kind == "phone" or luhn(digits)):
                out.append((m.start(), kind, m.end()))
    return listed(out, ["email", "ip", "card", "phone"])


def test_trigram_queries():
    query = secrets.trigram_query(ASSIGN)
    assert len(query) == 1 and frozenset({"sec", "ecr", "cre", "ret"}) in query[0]
    assert frozenset({"api", "pi_", "i_k", "_ke", "key"}) in query[0] and frozenset({"api", "pik", "ike", "key"}) in query[0]
    assert secrets.trigram_query("AKIA[A-Z0-9]+") == [[frozenset({"aki", "kia"})]]
    assert secrets.trigram_query("[0-9a-f]+") == [] and secrets.trigram_query("a?b") == []
    assert secrets.trigram_query("abc[xy]{0,3}def") == [[frozenset({"abc"})], [frozenset({"def"})]]


SECRETS = ["PASSWORD='abcdef' secret:abc token=abcdefg", "apikey=sec_ret=toolong1 api_key : \"x.y/z+1\"", "AKIA" + "A1" * 8, "AKIA12", "pass word=abcdefg",
           "f" * 24 + "g" + "0" * 23, "ſecret=abcdefg Key", "passwdpassword==abcdef", "", "ghp_" + "a" * 36]


def test_secret_scan(spark, documents, awkward):
    crafted = spark.createDataFrame(list(enumerate(SECRETS)), "doc_id long, text string")
    for df in (documents, awkward, crafted):
        got = secrets.digest(secrets.find_secrets(df)).collect()
        want = sorted(((d, sha(brute_secrets(t))) for d, t in pairs(df)), key=str)
        assert sorted(((r.doc_id, r.base_sha256) for r in got), key=str) == want
        for r in got:
            assert r.n_assign + r.n_access + r.n_hex <= (r.spans.count(",") + 1 if r.spans else 0)
    assert any("forge:" in r.spans for r in secrets.digest(secrets.find_secrets(crafted)).collect())
    assert secrets.find_secrets(awkward.limit(0)).count() == 0


def test_masking_keeps_rows_and_clean_texts(documents, awkward):
    for df in (documents, awkward):
        masked = secrets.mask_secrets(df)
        assert masked.columns == df.columns and masked.count() == df.count()
        assert sum(r.n_assign + r.n_access + r.n_hex for r in secrets.digest(secrets.find_secrets(masked)).collect()) == 0
    before = {r.doc_id: r for r in documents.collect()}
    for r in secrets.mask_secrets(documents).collect():
        assert (r == before[r.doc_id]) == (brute_secrets(before[r.doc_id].text) == "" and "[SECRET]" not in r.text)
        assert r.n_chars == (len(r.text) if "[SECRET]" in r.text else before[r.doc_id].n_chars)


def check_masked(spark, cases):
    """``cases``: (text, the text masked)."""
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "doc_id long, text string").coalesce(1)
    got = {r.doc_id: r.text for r in secrets.mask_secrets(df).collect()}
    for i, (text, want) in enumerate(cases):
        assert got[i] == want, text


def test_masking_takes_whole_keys(spark):
    rnd = random.Random(3)
    body = ["".join(rnd.choice("ABCwxyz0189+/") for _ in range(64)) for _ in range(40)] + ["Qd+/7w=="]
    rule = next(r for r in secrets.RULES if r.kind == "private_key")
    assert secrets.trigram_query(rule.pattern) == secrets.trigram_query("-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----")
    cases = [("the line -----BEGIN PRIVATE KEY----- starts a key", "the line [SECRET] starts a key")]
    for label in ("", "RSA ", "OPENSSH "):
        begin, end = f"-----BEGIN {label}PRIVATE KEY-----", f"-----END {label}PRIVATE KEY-----"
        for ends in ("\n", "\r\n", "\\n", "\n    ", "\n> ", '\\n" +\n  "', " ", "\n\n"):
            cases += [("before " + ends.join([begin, *body, end]) + " after the key", "before [SECRET] after the key"),
                      ("before " + ends.join([begin, *body]), "before [SECRET]")]
        head = ["Proc-Type: 4,ENCRYPTED", "DEK-Info: AES-128-CBC,0123", ""]
        cases += [("\n".join(["a", begin, *head, *body, "", "some words after it"]), "a\n[SECRET]\n\nsome words after it"),
                  ("\n".join([begin, *body[:3], "words of a text", begin, *body, end, "b"]), "[SECRET]\nwords of a text\n[SECRET]\nb"),
                  ("\n".join("-" + x for x in (begin, *body, end)), "-[SECRET]")]
    check_masked(spark, cases)
    many = "-----BEGIN RSA PRIVATE KEY-----\nAAAA\n" * 50000
    assert sum(1 for _ in rule.find(many)) == 50000 and sum(1 for _ in rule.find("-----BEGIN " + "A " * 500000)) == 0


def test_masking_takes_long_tokens(spark):
    rules = {r.kind: r for r in secrets.RULES}
    long, short = "Ab1_-" * 2000, "Ab1_-cd89"
    cases = []
    for parts in ((long, short, short), (short, long, short), (short, short, long), (long, long, long)):
        cases += [(f"a {x}eyJ{'.'.join(parts)}. b", f"a {x}[SECRET]. b") for x in ("", "id_", "x.", "eyJshort.y.")]
    cases += [("a ghp_" + "a1B" * 3000 + " b", "a [SECRET] b"), ("a xoxb-" + "a1-" * 3000 + " b", "a [SECRET] b")]
    cases += [(t, t) for t in ("a eyJ" + long, f"a eyJ{long}.{long}", "eyJabc.eyJabc.eyJabc")]
    check_masked(spark, cases)
    for kind, capped in (("jwt", "eyJ[a-z]{8,9}"), ("chat", "xox[abprs]-[a-z]{10,255}"), ("forge", "gh[pousr]_[a-z]{36,255}")):
        assert secrets.trigram_query(rules[kind].pattern) == secrets.trigram_query(capped)
    old = re.compile(r"eyJ[A-Za-z0-9_-]{8,4096}\.[A-Za-z0-9_-]{8,4096}\.[A-Za-z0-9_-]{8,4096}")
    rnd = random.Random(4)
    for _ in range(20000):
        text = "".join(rnd.choice(["eyJ", "abcdefgh", ".", ".", "a", " ", "_-"]) for _ in range(rnd.randrange(40)))
        assert list(rules["jwt"].find(text)) == [m.span() for m in old.finditer(text)], text
    for hard in ("eyJ" * 400000, "eyJ" * 200000 + "." + "eyJ" * 200000, "eyJabcdefgh." * 100000 + "a"):
        assert all(b > a for a, b in rules["jwt"].find(hard))


PII = ["a@b@c.d.e-f..g x@y", "1.2.3.4.5.6.7.8 256.1.1.1 01.002.3.4", "4111 1111-1111 1111 and 4111111111111112", "+49 (170) 123.45.67-89 +1 2", "+1234567890123456",
       "http://u@h.org/p ftp://x/~ann IBAN: DE89 3704 0044 0532 0130 00.", "@", "9" * 300, "0" * 16, "1-2-3-4-5-6-7-8-9-0-1-2-3-4"]


def test_pii(spark, documents, awkward):
    crafted = spark.createDataFrame(list(enumerate(PII)), "doc_id long, text string")
    for df in (documents, awkward, crafted):
        got = pii.digest(pii.find_pii(df)).collect()
        assert sorted(((r.doc_id, r.base_sha256) for r in got), key=str) == sorted(((d, sha(brute_pii(t))) for d, t in pairs(df)), key=str)
    extra = {r.doc_id: r.spans for r in pii.digest(pii.find_pii(crafted)).collect()}[5]
    assert "url:" in extra and "account:" in extra
    assert pii.find_pii(awkward.limit(0)).count() == 0


DE, AT, BE, ES = "DE89 3704 0044 0532 0130 00", "AT61 1904 3002 3457 3201", "BE68 5390 0754 7034", "ES91 2100 0418 4502 0005 1332"


def test_accounts_behind_cues():
    def accounts(text):
        return [text[a:b] for k, a, b in pii.find(text) if k == "account"]

    for code in (DE, AT, BE, ES):
        for x in (code, code.replace(" ", "")):
            for cue in ('"iban": "', "IBAN=", "IBAN (", "IBAN\t", "iban\n  ", "IBAN" + " " * 50, "Account number: ", "{'iban':'", "IBAN no. ", "IBAN"):
                for after in (" BIC", " 1234 and", " BIC GENODEF1", '"}', ")", ".", "", "\nBIC: X"):
                    assert accounts(f"a {cue}{x}{after}") == [x], (cue, x, after)
            assert accounts(f"IBAN {x[:-1]}{(int(x[-1]) + 1) % 10}") == []
    for text in ("Account: 12345678", "account no. 12345678", "ACCT #12345678", '"account": "12345678"', "accountNumber=12345678.", "acct\n12345678"):
        assert accounts(text) == ["12345678"], text
    assert accounts("account 12-34-56 12345678, x") == ["12-34-56 12345678"]
    for text in ("account 12345", "account 100000.50", "account on 12345678", "account: 2024-01-15", "account 1234567x", "IBAN 12345678"):
        assert accounts(text) == [], text
    assert len(pii.find("account" + " :" * 300000 + "iban" * 100000)) == 0


def test_pii_on_random_strings():
    rnd = random.Random(1)
    for _ in range(3000):
        text = "".join(rnd.choice("ab1290.@+- ()") for _ in range(rnd.randrange(60)))
        assert listed([(a, k, b) for k, a, b in pii.find(text) if k in pii.BASE_KINDS], list(pii.BASE_KINDS)) == brute_pii(text), text


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = toxicity.learn(docs, labels)
    rows = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 4 == 2) and r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for d, r in rows.items())
    held = [(rows[r.doc_id].score, r.toxic) for r in labels.collect() if rows[r.doc_id].held_out]
    good, bad = [s for s, y in held if y], [s for s, y in held if not y]
    assert np.mean([(g > b) + (g == b) / 2 for g in good for b in bad]) > 0.75
    assert np.mean([b >= 0.3 for b in bad]) < 0.03


def test_toxicity_folds_and_spares(awkward, spark):
    model = toxicity.Model({"idiot": 5.0}, {"lowei": 5.0}, frozenset({"no idiot"}), -3.0, 3.0)
    a = model.automaton()
    say = lambda t: model.score(toxicity.fold(t), a) >= 0.3
    assert say("you 1d10t") and say("an іdіot") and say("Loweiung") and say("id!ot")
    assert not say("no idiot here") and not say("idiotic") and not say("") and not say("flowei")
    got = toxicity.score(awkward, model).collect()
    assert len(got) == awkward.count() and {r.doc_id for r in got if r.predicted} == {7}
    kept = toxicity.drop_toxic(awkward, model)
    assert kept.columns == awkward.columns and kept.count() == awkward.count() - 1
    empty = toxicity.learn(awkward, spark.createDataFrame([], "doc_id long, toxic int"))
    assert not empty.words and toxicity.score(awkward.limit(0), empty).count() == 0
    odd = spark.createDataFrame([(3, None), (None, 1), (7, 1), (7, 0), (4, 0)], "doc_id long, toxic int")
    assert toxicity.score(awkward, toxicity.learn(awkward, odd)).count() == awkward.count()


def test_toxicity_is_linear_in_matches():
    model = toxicity.Model({"idiot": 2.0, "fool": 1.0}, {"moro": 1.5}, frozenset({"dear idiot", "idiot fool", "fool s day"}), 0.0, 1.0)
    automaton, rnd = model.automaton(), random.Random(1)

    def plain(words):
        joined = f" {' '.join(words)} "
        spared = [(m.start() + 1, m.start() + len(p)) for p in model.exceptions for m in re.finditer(f"(?=({re.escape(f' {p} ')}))", joined)]
        return sorted((m.start() + 1, x) for w, x, tail in [(w, x, " ") for w, x in model.words.items()] + [(s, x, "") for s, x in model.stems.items()]
                      for m in re.finditer(f"(?=({re.escape(f' {w}{tail}')}))", joined) if not any(a <= m.start() + 1 < b for a, b in spared))

    for n in (0, 3, 200):
        for _ in range(30):
            words = [rnd.choice(["dear", "idiot", "fool", "s", "day", "moron", "x", "moro"]) for _ in range(n)]
            assert sorted(model.hits(words, automaton)) == plain(words)
    words = [rnd.choice(["dear", "idiot", "fool", "s"]) for _ in range(300000)]
    start = time.time()
    model.score(words, automaton)
    assert time.time() - start < 20


def test_long_schemes_keep_their_head():
    text = "see " + "x" * 40 + "://user:pass@host.example/path and a://b"
    spans = [s for s in pii.find(text) if s[0] == "url"]
    assert spans and spans[0][1] == 4


def edit_distance(item, x):
    row = np.zeros(len(x) + 1, int)
    for i, c in enumerate(item):
        new = np.r_[i + 1, np.minimum(row[:-1] + (x != c), row[1:] + 1)]
        row = np.minimum.accumulate(new - np.arange(len(new))) + np.arange(len(new))
    return int(row.min())


def test_leaks_match_full_alignment(spark, documents, sf_dir):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    index, rnd, hosts = decontaminate.Index.build(items), random.Random(5), [t for _, t in pairs(documents)]
    for _ in range(60):
        i, text = rnd.choice(items)
        s = list(text)
        for _ in range(rnd.randrange(0, int(0.13 * len(s)))):
            k, op = rnd.randrange(len(s)), rnd.random()
            if op < 0.4:
                s[k] = rnd.choice("abcdeé ")
            elif op < 0.7:
                s.insert(k, rnd.choice("abc\n"))
            else:
                del s[k]
        text = rnd.choice(hosts)[: rnd.randrange(0, 500)] + "".join(s) + rnd.choice(["", rnd.choice(hosts)[:200]])
        k = index.ids.index(i)
        best = edit_distance(index.items[k], decontaminate.fold(text))
        hits = [h for h in index.regions(["x", text, ""])[1] if h[0] == i]
        assert bool(hits) == (best <= index.edits[k])
        assert not hits or min(h[3] for h in hits) == best


@pytest.mark.parametrize("size", [9, 10, 12, 15, 19, 20, 22, 29, 30, 31, 40])
def test_short_items_have_their_whole_budget(size):
    rnd = random.Random(size)
    item = "".join(rnd.choice("abcdefgh ") for _ in range(size - 2)) + "yz"
    index = decontaminate.Index.build([(1, item), (2, "some other item that is not there at all, anywhere")])
    assert index.edits[0] == size // 10
    for _ in range(60):
        s = list(item)
        for _ in range(rnd.randint(0, size // 10 + 1)):
            k = rnd.randrange(len(s))
            s[k : k + 1] = rnd.choice([[], ["#"], [s[k], "#"]])
        text = "#" * rnd.randint(0, 9) + "".join(s) + "#" * rnd.randint(0, 9)
        best = edit_distance(index.items[0], decontaminate.fold(text))
        hits = index.regions([text])[0]
        assert bool(hits) == (best <= size // 10) and (not hits or hits[0][3] == best)


def test_rules_in_items_and_texts():
    """A line of dashes in every item and long ones in the text: bounded work, every place found."""
    rnd = random.Random(1)
    prose = lambda n: " ".join("".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 8))) for _ in range(n))
    items = [(i, prose(20) + "\n" + "-" * 80 + "\n" + prose(20)) for i in range(50)]
    index = decontaminate.Index.build(items)
    changed = items[9][1][:60] + "x" + items[9][1][61:]
    head = prose(100) + "-" * 20000
    text = head + items[7][1] + "-" * 20000 + prose(50) + changed
    tracemalloc.start()
    start = time.time()
    hits = index.regions([text])[0]
    assert time.time() - start < 30 and tracemalloc.get_traced_memory()[1] < 300 << 20
    tracemalloc.stop()
    assert [(k, e) for k, _, _, e in hits] == [(7, 0), (9, 1)] and hits[0][1:3] == (len(head), len(head) + len(items[7][1]))
    for unit, size in (("-", 80), ("-=", 40), ("abc ", 30)):
        item, n = unit * size, 50
        found = decontaminate.Index.build([(1, item)]).regions([item * n])[0]
        assert found == [(1, i * len(item), (i + 1) * len(item), 0) for i in range(n)]


def test_leaks_and_their_removal(spark, documents, awkward, sf_dir):
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    items = {r.item_id: r.text for r in bench.collect()}
    exact = {(d, i) for d, t in pairs(documents) for i, x in items.items() if x in t}
    for block_bytes in (4 << 20, 2000):
        rows = decontaminate.leaks(documents, bench, block_bytes=block_bytes).collect()
        assert {(r.doc_id, r.item_id) for r in rows} >= exact and exact
        text = dict(pairs(documents))
        assert all(text[r.doc_id][r.start : r.end].split() == items[r.item_id].split() for r in rows if r.edits == 0)
    kept = decontaminate.drop_leaks(documents, bench)
    assert kept.columns == documents.columns
    assert {r.doc_id for r in kept.collect()} == {d for d, _ in pairs(documents)} - {r.doc_id for r in rows}
    odd = spark.createDataFrame([(1, None), (2, ""), (None, "the same words are here twice over"), (4, "x@y")], "item_id long, text string")
    found = decontaminate.leaks(awkward, odd).collect()
    assert sorted(((r.doc_id, r.item_id) for r in found), key=str) == [(4, None), (5, None), (5, None), (6, 4)]
    assert decontaminate.drop_leaks(awkward, odd).count() == awkward.count() - 4
    assert decontaminate.leaks(awkward, odd.limit(0)).count() == 0 and decontaminate.leaks(awkward.limit(0), odd).count() == 0


def test_fingerprints(documents, awkward):
    for df in (documents, awkward.where("doc_id is not null")):
        rows = sorted({(d, t) for d, t in pairs(df)}, key=lambda r: (-r[0], r[1]))
        if len(rows) != df.count():
            continue
        want = {}
        for i, (d, t) in enumerate(rows):
            following = rows[(i + 1) % len(rows)][1]
            e, fp = fingerprint.edit(t, following), fingerprint.digest(t.encode())
            other = fingerprint.digest(e.encode())
            want[d] = (len(t), sha(e), fp.hex(), other.hex(), fingerprint.likeness(fp, other), fingerprint.likeness(fp, fingerprint.digest(following.encode())))
        assert {r.doc_id: tuple(r)[1:] for r in fingerprint.fingerprints(df).collect()} == want


def test_fingerprints_order_edits_before_other_texts(documents):
    rows = fingerprint.fingerprints(documents).collect()
    assert np.mean([r.near_edited > r.near_next for r in rows]) > 0.95
    assert all(0 <= x <= 1 for r in rows for x in (r.near_edited, r.near_next))


def test_fingerprints_on_awkward_rows(awkward):
    rows = fingerprint.fingerprints(awkward).collect()
    assert len(rows) == awkward.count()
    same = [r for r in rows if r.doc_id in (4, 5)]
    assert len({r.fingerprint for r in same}) == 1 and any(r.near_next == 1 for r in same)
    assert fingerprint.edit("abcde", "xyz") == "abcxy" and fingerprint.edit("abcd", "x") == "abx" and fingerprint.edit("", "x") == ""
    assert fingerprint.fingerprints(awkward.limit(0)).count() == 0


@pytest.mark.parametrize("text", [b"", b"a", b"abcd", b"\x00" * 9])
def test_short_digests(text):
    assert len(fingerprint.digest(text)) == 1 + fingerprint.BUCKETS // 4
    assert fingerprint.likeness(fingerprint.digest(text), fingerprint.digest(text)) == 1


def test_leaks_read_once_for_any_blocks(spark):
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(2, 9)))
    items = [" ".join(word() for _ in range(12)) for _ in range(40)]
    docs = [(i, " ".join([word() for _ in range(30)] + [items[i % 40]] * (i % 3 == 0) + [items[i * 7 % 40]] * (i % 5 == 0))) for i in range(200)]
    bench = spark.createDataFrame([(k, t) for k, t in enumerate(items)] + [(100 + k, items[0]) for k in range(3)] + [(None, items[1])], "item_id long, text string")
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(2)
    one, many = (decontaminate.leaks(df, bench, block_bytes=n) for n in (4 << 20, 700))
    rows = sorted(map(tuple, one.collect()), key=str)
    assert rows == sorted(map(tuple, many.collect()), key=str)
    assert {(d, i) for d, i, *_ in rows} == {(d, i) for d, t in docs for i, x in [*enumerate(items), *[(100 + k, items[0]) for k in range(3)], (None, items[1])] if x in t}
    dropped = decontaminate.drop_leaks(df, bench, block_bytes=700)
    for plan in (many, dropped):
        assert plan._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    assert sorted(r.doc_id for r in dropped.collect()) == [d for d, t in docs if not any(x in t for x in items)]
