"""Personal data by anchor expansion.

An Aho-Corasick automaton finds the anchors of a text in one pass: at-signs,
plus signs, digits, URL schemes and identifier cues. A deterministic local
parser grows every anchor to the boundary of its kind and validates it.

Base kinds: ``email``, ``ip``, ``card`` (Luhn), ``phone``; leftmost,
non-overlapping per kind, failing matches dropped without a retry. Added
kinds: ``url`` (a URL that carries a user name and password), ``iban`` (mod 97), ``account``
and ``ssn`` (a number after its cue), ``secret`` (a quoted or bare key after
its cue). Positions are code points, end exclusive.

Defined results: a null text counts as empty and has no spans (redaction keeps
it null); repeated rows each get a row; an empty table gives no rows; other
columns of the input are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankflow.llm.common import digest, prepare, text_rows, texts_of

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "url", "iban", "account", "ssn", "secret")
ORDER = {k: i for i, k in enumerate(KINDS)}

LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP_RUN, IP = re.compile(r"[0-9.]+"), re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
URL_USER = re.compile(r"[^\s/@:]+:[^\s/@]+@[A-Za-z0-9.-]+[^\s\"'<>]*")
CUE_GAP = r"[ \t]*(?:number|no\.?|id)?[ \t]*[:=#]?[ \t]*"
ACCOUNT = re.compile(CUE_GAP + r"([0-9](?:[ -]?[0-9]){5,16})(?![0-9])")
SSN = re.compile(CUE_GAP + r"([0-9]{3}-[0-9]{2}-[0-9]{4})(?![0-9-])")
IBAN = re.compile(CUE_GAP + r"([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30})(?![A-Z0-9])")
SECRET = re.compile(r"[ \t]*[:=][ \t]*[\"']?([A-Za-z0-9_/+-]{16,})")
CUES = {"account": ("account", "acct"), "ssn": ("ssn",), "iban": ("iban",), "secret": ("token", "api_key", "apikey", "secret", "password")}
PARSERS = {"account": ACCOUNT, "ssn": SSN, "iban": IBAN, "secret": SECRET}


@lru_cache(maxsize=1)
def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for ch in "0123456789":
        found.add_word(ch, ("digit", 1))
    found.add_word("@", ("at", 1))
    found.add_word("+", ("plus", 1))
    found.add_word("://", ("scheme", 3))
    for kind, words in CUES.items():
        for w in words:
            for form in {w, w.upper(), w.capitalize()}:
                found.add_word(form, (kind, len(form)))
    found.make_automaton()
    return found


def _digits(s: str) -> str:
    return "".join(c for c in s if c.isdigit())


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def iban_ok(s: str) -> bool:
    s = s.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def spans(text: str | None) -> list[tuple[int, str, int]]:
    """All (start, kind, end), by start and then by kind as listed in ``KINDS``."""
    out: list[tuple[int, str, int]] = []
    if not text:
        return out
    email_end = ip_end = card_end = phone_end = 0
    for last, (anchor, width) in automaton().iter(text):
        if anchor == "digit":
            if last >= ip_end:
                ip_end = IP_RUN.match(text, last).end()
                for m in IP.finditer(text, last, ip_end):
                    if all(len(p) <= 3 and int(p) <= 255 for p in (p.lstrip("0") or "0" for p in m[0].split("."))):
                        out.append((m.start(), "ip", m.end()))
            if last >= card_end:
                m = CARD.match(text, last)
                card_end = m.end() if m else last + 1
                if m and 12 <= m.end() - m.start() and 12 <= len(d := _digits(m[0])) <= 19 and luhn(d):
                    out.append((m.start(), "card", m.end()))
        elif anchor == "at":
            m, start = DOMAIN.match(text, last + 1), last
            while m and start > email_end and text[start - 1] in LOCAL:
                start -= 1
            if m and start < last:
                email_end = m.end()
                out.append((start, "email", email_end))
        elif anchor == "plus":
            if last >= phone_end and (m := PHONE.match(text, last)):
                phone_end = m.end()
                if 9 <= len(_digits(m[0])) <= 15:
                    out.append((last, "phone", phone_end))
        elif anchor == "scheme":
            start = last - 2
            while start > 0 and text[start - 1].isascii() and text[start - 1].isalpha():
                start -= 1
            if start < last - 2 and (m := URL_USER.match(text, last + 1)):
                out.append((start, "url", m.end()))
        else:
            before = last - width
            if before >= 0 and (text[before].isalnum() or text[before] == "_"):
                continue
            m = PARSERS[anchor].match(text, last + 1)
            if m and (anchor != "iban" or iban_ok(m[1])):
                out.append((m.start(1), anchor, m.end(1)))
    out.sort(key=lambda s: (s[0], ORDER[s[1]], s[2]))
    return out


def joined(found: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, k, e in found)


def redact(text: str | None) -> str | None:
    """The text with every span replaced by its kind in brackets; overlapping spans become one."""
    found = spans(text)
    if not found:
        return text
    out, at = [], 0
    for start, kind, end in found:
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def query(docs: DataFrame) -> DataFrame:
    """Counts, the digest of the base spans and all spans of every whole text."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for t in texts_of(b):
                found = spans(t)
                base = [x for x in found if x[1] in BASE]
                rows.append(([sum(x[1] == k for x in base) for k in BASE], digest(joined(base).encode()), joined(found)))
            counts = [pa.array([r[0][i] for r in rows], pa.int64()) for i in range(len(BASE))]
            rest = [pa.array([r[i] for r in rows], pa.string()) for i in (1, 2)]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *counts, *rest], ["doc_id", *(f"n_{k}" for k in BASE), "base_sha256", "spans"]
            )

    return text_rows(docs).mapInArrow(run, SCHEMA)


def redacted(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` with the spans of ``text`` replaced; ``n_chars``, if there, is counted anew."""
    prepare(docs.sparkSession)

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        return texts.map(redact, na_action="ignore")

    out = docs.withColumn("text", clean(F.col("text").cast("string")))
    if "n_chars" in docs.columns:
        n = F.char_length("text")
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(n).cast(docs.schema["n_chars"].dataType))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
