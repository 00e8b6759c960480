"""Pieces are encoded once, terms and scores are worked out in bulk, with the results of the plain way."""

import numpy as np
import public_tokenizers

from rankflow.llm import packing


def test_pieces_are_encoded_once():
    enc = packing.Encoder(public_tokenizers.path(packing.TOKENIZER))
    met, tokenize = [], enc.pieces.tokenize
    enc.pieces.tokenize = lambda p: met.append(p) or tokenize(p)
    for text in ("Word word, word. w1", "WORD, word2"):
        got = enc.encode([text])[0].tolist()
        assert got == [*enc.tokenizer.encode(text, add_special_tokens=False).ids, packing.END_ID]
    assert sorted(met) == [",", ".", "1", "2", "w", "word"]


def test_strongest_terms_with_ties():
    rng = np.random.default_rng(3)
    corpus = packing.Corpus(np.full(1 << 16, 5, np.int64), 100, 5000)
    for n in (3, 6, 7, 40, 200):
        doc = rng.integers(0, 90, n).astype("<u2")
        terms, tfs = packing.counted(doc)
        w = corpus.weight(terms, tfs, n)
        top = terms[np.lexsort((terms, -w))[: packing.DEPTH]].tolist()
        assert corpus.prefixes(doc) == [".".join(map(str, top[: i + 1])) for i in range(len(top))]
        assert dict(zip(terms.tolist(), tfs.tolist())) == {t: doc.tolist().count(t) for t in set(doc.tolist())}


def test_scores_add_up_in_the_terms_order():
    rng = np.random.default_rng(4)
    docs = [rng.integers(0, 2000, rng.integers(1, 300)).astype("<u2") for _ in range(200)]
    index = packing.Index(docs)
    index.used[:20] = True
    for seed in range(40):
        terms = packing.counted(docs[seed])[0]
        want = np.add.reduce(index.rows[[index.row[t] for t in terms if index.row[t] >= 0]], axis=0)
        for t in terms:
            a, b = index.first[t], index.first[t + 1]
            if index.row[t] < 0 and b - a > 1:
                want[index.docs[a:b]] += index.weights[a:b]
        want[index.used] = 0
        found = np.flatnonzero(want)
        assert index.neighbours(seed).tolist() == found[np.argsort(-want[found], kind="stable")].tolist()
