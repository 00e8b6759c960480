"""Token alignment against whole-text tokenization with plain decoded bytes, and defined results for odd input."""

import bisect
import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from rankflow.llm import alignment, blocks

A, B = public_tokenizers.path(alignment.MODEL_A), public_tokenizers.path(alignment.MODEL_B)


@pytest.fixture(scope="module")
def models():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def brute(models, docs):
    a, b = models
    chars = alignment.byte_level()
    names = {i: t for t, i in a.get_vocab().items()}

    def bytes_b(i):
        return bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()

    found, counts = [], Counter()
    for i, text in docs:
        raw = (" " + (text or "")).encode()
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        parts_a, parts_b = [bytes(chars[c] for c in names[x]) for x in ids_a], [bytes_b(x) for x in ids_b]
        if not text or b"".join(parts_a) != raw or b"".join(parts_b) != raw:
            found.append((i, 0, 0, "", []))
            continue
        ends_a = [sum(map(len, parts_a[: k + 1])) for k in range(len(parts_a))] if len(parts_a) < 500 else _ends(parts_a)
        ends_b = _ends(parts_b)
        groups, links, x, y = [], [], 0, 0
        for cut in sorted(set(ends_a) & set(ends_b)):
            p, q = bisect.bisect_right(ends_a, cut), bisect.bisect_right(ends_b, cut)
            groups.append(",".join(map(str, ids_a[x:p])) + "|" + ",".join(map(str, ids_b[y:q])))
            links.append((ids_a[p - 1], ids_b[q - 1]))
            x, y = p, q
        counts.update(links)
        found.append((i, len(ids_a), len(ids_b), ";".join(groups), links))
    most = Counter()
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    return sorted(
        (
            (i, n_a, n_b, len(links), len(links), sum(counts[k] == most[k[1]] for k in links), sum(counts[k] for k in links),
             hashlib.sha256(groups.encode()).hexdigest() if groups else "")
            for i, n_a, n_b, groups, links in found
        ),
        key=str,
    )


def _ends(parts):
    out, at = [], 0
    for p in parts:
        at += len(p)
        out.append(at)
    return out


def _rows(df):
    return sorted(((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect()), key=str)


HOSTILE = [
    "hello world", " leading", "trailing ", "  two  spaces  ", "line\nbreak\n\nand\r\nmore\n", "tab\tand nbsp　wide", " sep \u0085next",
    "日本語 テキスト 𝄞 clef 👩‍👩‍👧 family", "é é ñandú œuvre ﬁ ½", "<s> </s> <unk> <0x41> <|endoftext|> [INST]", "don't we'll I'm it's'", "a" * 5000,
    "1234567890 3.14159 1e-9", "a.b,c..d, e.,f½,٣,.x_y.z é.à,", "x▁y has the mark", "\u0000 nul \u001f unit", "ᚠᛇᚻ \U0010ffff ", "." * 300 + " " * 300 + "!" * 300, "\n", " ", "\t", "a\n b \n c",
]


def test_hostile_texts_equal_whole_text_tokenization(spark, models, monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK_CHARS", 4000)
    docs = list(enumerate(HOSTILE))
    assert _rows(alignment.query(spark.createDataFrame(docs, "doc_id long, text string"))) == brute(models, docs)
    zero = {i for i, n_a, *_ in brute(models, docs) if not n_a}
    assert zero == {HOSTILE.index("x▁y has the mark")}


def test_random_texts_equal_whole_text_tokenization(models, monkeypatch):
    monkeypatch.setattr(alignment, "REMEMBERED", 50)
    rng = random.Random(5)
    alphabet = "abcdeéñ日\U0001f600 .,'\n\t  "
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 200))) for _ in range(400)]
    align = alignment.Aligner(A, B)
    got = []
    for lo in range(0, len(texts), 40):
        part = texts[lo : lo + 40]
        for t in part:
            chunks = alignment.CUT.split(" " + t)
            assert "".join(chunks) == " " + t
        got += list(align.documents(part))
    want = {r[0]: r for r in brute(models, list(enumerate(texts)))}
    for i, (n_a, n_b, n_groups, sha, links) in enumerate(got):
        assert (n_a, n_b, n_groups, len(links), sha) == (want[i][1], want[i][2], want[i][3], want[i][4], want[i][7])


def test_documents_table_equals_whole_text_tokenization(spark, models):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    assert _rows(alignment.query(df)) == brute(models, docs)


def test_odd_rows(spark, models):
    docs = [(1, None), (2, ""), (3, "same text"), (3, "same text"), (None, "same text"), (4, "long word " * 20_000), (5, "ties tied")]
    df = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in docs], "doc_id long, text string, block long, pairs string, total int")
    assert _rows(alignment.query(df)) == brute(models, docs)
    assert alignment.query(df.limit(0)).collect() == []
    assert _rows(alignment.query(spark.createDataFrame([(1, None)], "doc_id long, text string"))) == [(1, 0, 0, 0, 0, 0, 0, "")]
