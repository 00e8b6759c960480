"""Spelling variants against brute force over all pairs of words, and defined results for odd input."""

import random
import zlib
from collections import Counter

import pytest

from rankflow.llm import spelling

WORD = set("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ") | {chr(c) for c in range(0xC0, 0x100)}


def _runs(text):
    out, run = [], ""
    for c in (text or "") + " ":
        if c in WORD:
            run += c.lower() if c < "\x80" else c
        elif run:
            out.append(run)
            run = ""
    return out


def _near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(docs):
    n = Counter()
    for i, text in docs:
        for run in _runs(text):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            n[run] += 1
    words = {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}
    near = {w: [x for x in words if abs(len(x) - len(w)) <= 1 and _near(w, x)] for w in words}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 2 * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, words[w], len(near[w]), form[w], words[form[w]] if form[w] else None, root))
    return out


def _rows(df):
    rows = [(r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def _texts(seed, n_docs):
    rng = random.Random(seed)
    base = ["".join(rng.choice("aeiorstn") for _ in range(rng.randint(5, 7))) for _ in range(60)] + ["façade", "éclair", "Éclair", "straße"]
    docs = []
    for i in range(n_docs):
        words = []
        for _ in range(120):
            w = rng.choice(base)
            if rng.random() < 0.3:
                k = rng.randrange(len(w))
                w = rng.choice([w[:k] + w[k + 1 :], w[:k] + rng.choice("aeiou") + w[k:], w[:k] + rng.choice("rstn") + w[k + 1 :], w.upper()])
            words.append(w)
        docs.append((i, rng.choice([" ", "-", "\n"]).join(words)))
    return docs


def test_variants_equal_brute_force(spark):
    docs = _texts(1, 60)
    want = brute(docs)
    got = _rows(spelling.query(spark.createDataFrame(docs, "doc_id long, text string")))
    assert got == want and len(want) > 100 and sum(r[3] is not None for r in want) > 50


@pytest.mark.parametrize("sample, cell, block", [(60, 5, 16_000), (400, 20, 7), (0, 10, 16_000)])
def test_cells_and_blocks_lose_no_pair(spark, monkeypatch, sample, cell, block):
    monkeypatch.setattr(spelling, "SAMPLE", sample)
    monkeypatch.setattr(spelling, "CELL", cell)
    monkeypatch.setattr(spelling, "BLOCK", block)
    monkeypatch.setattr(spelling, "LEAF", 4)
    docs = _texts(2, 40)
    assert _rows(spelling.query(spark.createDataFrame(docs, "doc_id long, text string"))) == brute(docs)


def test_boxes_prune(monkeypatch):
    rng = random.Random(4)
    words = sorted({"".join(rng.choice("abcdefghijklmnopqrst") for _ in range(6)) for _ in range(1500)})
    words = sorted({*words, *(w[:3] + "z" + w[4:] for w in words[::3])})
    tree = spelling.Tree(words)
    met = []
    spelled = spelling.Tree._spelled
    monkeypatch.setattr(spelling.Tree, "_spelled", lambda self, c, a, b, longer: (met.append(len(a)), spelled(self, c, a, b, longer))[1])
    found = {(int(x), int(y)) for a, b in tree.near(spelling.letters(words)) for x, y in zip(a, b)}
    assert found == {(i, j) for i, a in enumerate(words) for j, b in enumerate(words) if i != j and sum(x != y for x, y in zip(a, b)) == 1}
    assert sum(met) < len(words) ** 2 / 100


def test_odd_rows(spark):
    long = "wonderful " * 30_000
    docs = [
        (1, None), (2, ""), (3, "table table table tables tables tables tables tables tables"), (3, "table table table"), (None, "stone stone stone"),
        (4, long), (5, "a" * 70_000 + " " + "b" * 9), (6, "b" * 9), (7, "b" * 9), (8, "b" * 10 + " " + "b" * 10 + " " + "b" * 10), (9, "12345 67890 ×÷×÷× ×÷×÷× ×÷×÷×"),
        # a tie: two forms equally common
        (10, "bread bread bread " + "breed " * 6 + "broad " * 6),
    ]
    extra = [(i, t, 7, "x") for i, t in docs]
    df = spark.createDataFrame(extra, "doc_id long, text string, n long, word string")
    assert _rows(spelling.query(df)) == brute(docs)
    assert spelling.query(df.limit(0)).collect() == []
    assert spelling.query(spark.createDataFrame([(1, None)], "doc_id long, text string")).collect() == []
