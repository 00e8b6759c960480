"""Texts are encoded by the distinct chunks of a block and terms are counted a batch at a time, with the results of the plain way."""

import random

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest

from rankflow.llm import packing

MARKS = [chr(c) for c in [*range(1, 0x180)]] + list("abcdefghij   \n\t\x0b\x0c.,'<|") * 9 + ["Σ", "　", "\U0001f600", "<|endoftext|>"]


def drawn(seed: int, n: int) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choices(MARKS, k=rng.randint(0, 60))) for _ in range(n)]


@pytest.mark.parametrize("texts", [["", ""], ["one two"], ["a\x0bb \x0c", "a b"], [" ", "One one x", "一 one"], drawn(1, 400)])
@pytest.mark.parametrize("many", [1, 10**9])
def test_blocks_equal_the_tokenizer(texts, many, monkeypatch):
    monkeypatch.setattr(packing, "MANY", many)
    enc = packing.Encoder(public_tokenizers.path(packing.TOKENIZER))
    for _ in range(2):
        ids, sizes = enc.joined(texts)
        want = [[*enc.tokenizer.encode(t, add_special_tokens=False).ids, packing.END_ID] for t in texts]
        assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == want


def test_a_chunk_of_a_block_is_encoded_once():
    enc = packing.Encoder(public_tokenizers.path(packing.TOKENIZER))
    met, tokenize, encode = [], enc.pieces.tokenize, enc.odd_chunk
    enc.pieces.tokenize = lambda p: met.append(p) or tokenize(p)
    enc.odd_chunk = lambda c: met.append(c) or encode(c)
    enc.joined(["word, 一 Word,"] * 50 + ["一 word,"] * 50)
    assert sorted(met) == [",", "word", "一"]


def test_forgotten_pieces_are_encoded_again(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 5)
    enc = packing.Encoder(public_tokenizers.path(packing.TOKENIZER))
    texts = drawn(2, 30)
    for part in (texts[:10], texts[10:], texts):
        assert [x.tolist() for x in enc.encode(part)] == [[*enc.tokenizer.encode(t, add_special_tokens=False).ids, packing.END_ID] for t in part]


def test_batches_together(monkeypatch):
    monkeypatch.setattr(packing, "CHARS", 10)
    batches = [pa.RecordBatch.from_arrays([pa.array(x, pa.string())], ["text"]) for x in ([], ["12345", None], ["123456"], ["1"], [], [None])]
    assert [[b.num_rows for b in held] for held in packing.together(iter(batches))] == [[2, 1], [1, 1]]


def test_terms_of_many_documents_at_once():
    rng = np.random.default_rng(6)
    docs = [rng.integers(0, 1 << 16 if n % 2 else 60, n).astype("<u2") for n in [1, 2, 6, 7, 300, 1, 50, 4000]]
    doc, terms, tfs = packing.counted_all(docs)
    for i, d in enumerate(docs):
        t, n = packing.counted(d)
        assert (terms[doc == i].tolist(), tfs[doc == i].tolist()) == (t.tolist(), n.tolist())
    corpus = packing.Corpus(rng.integers(0, 4, 1 << 16), 100, 5000)
    assert corpus.prefixes_of(docs) == [corpus.prefixes(d) for d in docs]
    assert packing.Corpus(np.ones(1 << 16, np.int64), 100, 5000).prefixes_of(docs[:3]) == [[""]] * 3
