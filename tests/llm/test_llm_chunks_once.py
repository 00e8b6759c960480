"""Chunks of a block are aligned and spelled once, with the results of single texts."""

import public_tokenizers

from rankflow.llm import alignment

TEXTS = [None, "", "one two, two. one", "  one\t two \n", "x▱y one", "été ÉTÉ two", "one\x0b two\x0c" * 3]


def test_chunks_of_a_block_are_aligned_once():
    models = [public_tokenizers.path(m) for m in (alignment.MODEL_A, alignment.MODEL_B)]
    align, met = alignment.Aligner(*models), []
    aligned = align.aligned
    align.aligned = lambda chunks: met.extend(chunks) or aligned(chunks)
    columns, pairs, at = align.block(TEXTS)
    assert len(met) == len(set(met))
    single = [alignment.Aligner(*models).block([t]) for t in TEXTS]
    assert columns["groups_sha256"] == [c["groups_sha256"][0] for c, _, _ in single]
    for name in ("n_a", "n_b", "n_groups", "n_links"):
        assert columns[name].tolist() == [c[name][0] for c, _, _ in single]
    assert pairs[at].tolist() == [p for _, ps, i in single for p in ps[i].tolist()]
    assert sorted(set(at.tolist())) == list(range(len(pairs)))
