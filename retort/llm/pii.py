"""Personal data by anchor expansion: Aho-Corasick finds at-signs, schemes, plus-signs, digits and account
cues in one pass; a deterministic parser at each anchor expands to the boundaries and validates."""

from __future__ import annotations

import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retort.llm.common import per_text, texts_of

#: The base kinds in their order, then the added ones.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = BASE_KINDS + ("url", "account")

# The characters of local parts, digits, and the account cues.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
SCHEME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")
DIGITS = "0123456789"
CUES = ("iban", "IBAN", "Iban", "account", "Account", "ACCOUNT", "acct", "Acct", "ACCT")

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
RUN = re.compile(r"[0-9]+")
SPACED = re.compile(r"[0-9](?:[\x20-]?[0-9])*")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
HOST = re.compile(r"[A-Za-z0-9._~%@:-]+(?:/[^\s<>\"']*)?")
#: What stands between a cue and an account, of any length: blanks, marks, quotes, brackets, a word for "number".
AFTER_CUE = re.compile(r"""[\s:#.=,;"'`()\[\]{}<>*_-]*+(?:(?:no|nr|num|number|code|id)(?![A-Za-z])[\s:#.=,;"'`()\[\]{}<>*_-]*+)?+""", re.I)
#: As much as an IBAN may take; its end is found by length and check digits.
IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?:[\x20\xa0-]?[A-Z0-9]){11,30}")
IBAN_LENGTH = {c[:2]: int(c[2:]) for c in (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DK18 DO28 EE20 EG29 ES24 FI18 FO18 FR27 GB22 GE22 GI23 GL18 "
    "GR27 GT28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 MK19 MR27 MT31 MU30 NL18 NO15 "
    "PK24 PL28 PS29 PT25 QA29 RO24 RS22 SA24 SC31 SE24 SI19 SK24 SM27 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20").split()}
#: A plain number after account or acct: six digits at least, no part of an amount or a word, no date.
PLAIN = re.compile(r"(?![0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9-]))[0-9](?:[\x20-]?[0-9])*+(?![A-Za-z0-9]|[.,][0-9])")
PLAIN_DIGITS = 6
PERSONAL_PATH = re.compile(r"/(?:~|@|u/|user/|users/|profile/|in/)[^/\s]+")

_automaton = None


def anchors():
    """The automaton; each anchor gives its kind and length."""
    global _automaton
    if _automaton is None:
        a = ahocorasick.Automaton()
        a.add_word("@", ("at", 1))
        a.add_word("://", ("scheme", 3))
        for d in DIGITS:
            a.add_word(d, ("digit", 1))
            a.add_word("+" + d, ("plus", 2))
        for c in CUES:
            a.add_word(c, ("iban" if c.lower() == "iban" else "account", len(c)))
        a.make_automaton()
        _automaton = a
    return _automaton


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def iban_ok(code: str) -> bool:
    s = re.sub(r"[\x20\xa0-]", "", code)
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def iban_end(text: str, at: int) -> int | None:
    """Where the IBAN at this place ends: at its country's length if that is a whole one, else at the longest
    end of a group that is."""
    if not (m := IBAN.match(text, at)):
        return None
    ends, size = [], 0
    for i in range(at, m.end()):
        if text[i] not in " \xa0-":
            size += 1
            if size >= 15 and not (text[i + 1 : i + 2].isascii() and text[i + 1 : i + 2].isalnum()):
                ends.append((size == IBAN_LENGTH.get(m[0][:2]), i + 1))
    return next((e for _, e in sorted(ends, reverse=True) if iban_ok(text[at:e])), None)


def find(text: str) -> list[tuple[str, int, int]]:
    """Spans of one text (code points, end exclusive), by start and the order of KINDS.

    Each parser keeps where its last match ended, so matches of a kind never overlap; a match that fails
    validation still uses up its characters. Work is linear in the text for every parser."""
    spans: list[tuple[str, int, int]] = []
    email_end = ip_end = card_end = phone_end = 0
    for end, (kind, size) in anchors().iter(text):
        at = end - size + 1
        if kind == "digit":
            if at >= ip_end:
                chain = DOTTED.match(text, at)
                ip_end = chain.end()
                if ip_end - at >= 7 and chain[0].count(".") >= 3:
                    parts = list(RUN.finditer(text, at, ip_end))
                    for i in range(0, len(parts) - 3, 4):
                        four = parts[i : i + 4]
                        if all(len(p[0].lstrip("0")) <= 3 and int(p[0].lstrip("0") or 0) <= 255 for p in four):
                            spans.append(("ip", four[0].start(), four[3].end()))
            if at >= card_end:
                chain = SPACED.match(text, at)
                card_end = chain.end()
                if card_end - at >= 14:
                    digits = chain[0].replace(" ", "").replace("-", "")
                    if 14 <= len(digits) <= 19 and luhn(digits):
                        spans.append(("card", at, card_end))
        elif kind == "at":
            left = at
            while left > email_end and text[left - 1] in LOCAL:
                left -= 1
            if left < at and (m := DOMAIN.match(text, at + 1)):
                email_end = m.end()
                spans.append(("email", left, email_end))
        elif kind == "plus":
            if at >= phone_end and (m := PHONE.match(text, at)):
                phone_end = m.end()
                if 10 <= sum(c in DIGITS for c in m[0]) <= 15:
                    spans.append(("phone", at, phone_end))
        elif kind == "scheme":
            left = at  # back to the last sign that no scheme has: each letter is passed once
            while left > 0 and text[left - 1] in SCHEME:
                left -= 1
            if left < at and text[left].isalpha() and (m := HOST.match(text, at + 3)):
                right = at + 3 + len(m[0].rstrip(".,;:!?)]"))
                rest = text[at + 3 : right]
                if "@" in rest.split("/")[0] or PERSONAL_PATH.search(rest):
                    spans.append(("url", left, right))
        else:
            left = AFTER_CUE.match(text, end + 1).end()
            right = iban_end(text, left)
            if right is None and kind == "account" and (m := PLAIN.match(text, left)) and sum(c in DIGITS for c in m[0]) >= PLAIN_DIGITS:
                right = m.end()
            if right is not None:
                spans.append(("account", left, right))
    rank = {k: i for i, k in enumerate(KINDS)}
    return sorted(spans, key=lambda s: (s[1], rank[s[0]], s[2]))


def find_pii(docs: DataFrame) -> DataFrame:
    """(doc_id, spans: array of (kind, start, end)) of every whole text.

    A null or empty text has no spans; repeated rows give a row each; an empty table gives none; columns
    beyond ``doc_id`` and ``text`` are ignored. Spans of different kinds may overlap."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batch):
        rows = [[{"kind": k, "start": a, "end": b} for k, a, b in find(t)] for t in texts_of(batch)]
        return pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(rows, kind)], names=["doc_id", "spans"])

    return per_text(docs, "doc_id long, spans array<struct<kind: string, start: long, end: long>>", run)


def digest(spans: DataFrame) -> DataFrame:
    """The contract's columns from ``find_pii``."""
    joined = lambda col: F.array_join(F.transform(col, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return spans.select("doc_id", *[count(k).alias(f"n_{k}") for k in BASE_KINDS],
                        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
