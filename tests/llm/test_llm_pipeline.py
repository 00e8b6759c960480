"""The pipeline's rows against the stages worked out in plain Python."""

import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conftest import SF_SMALL
from rankflow.llm import langid, mixing, packing, pii
from test_llm_results import brute_fingerprint


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "near-duplicates", "PII", "mixing", "packing"]


def test_pipeline_rows(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    # 1: what has a language stays
    known = {r.doc_id for r in langid.query(docs).collect() if r.lang_pred != "und" and r.lead >= langid.KEEP_LEAD}
    assert {i for i, r in rows.items() if r.lang and len(r.text.split()) > 20} <= known
    # 2: the first of every group of fingerprints linked at three bits
    ids = sorted(known)
    fp = np.array([brute_fingerprint(rows[i].text) for i in ids], np.uint64)
    near = np.bitwise_count(fp[:, None] ^ fp[None]) <= 3
    group = np.arange(len(ids))
    while True:
        new = np.array([group[near[k]].min() for k in range(len(ids))])
        if (new == group).all():
            break
        group = new
    kept = {ids[k] for k in set(group.tolist())}
    # 3: personal data replaced; 4: copies by the sources' rates, from the kept texts
    clean = {i: pii.redact(rows[i].text) for i in kept}
    assert not any(pii.spans(t) for t in clean.values() if "[" not in t)
    table = spark.createDataFrame([(i, clean[i], rows[i].source) for i in kept], "doc_id long, text string, source string")
    copies = {r.doc_id: r.copies for r in mixing.query(table).collect()}
    # 5: every id of every copy in one piece
    tok = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    tokens = {i: np.array([*tok.encode(t, add_special_tokens=False).ids, packing.END_ID], "<u4") for i, t in clean.items()}
    out = corpus_pipeline.run(spark, SF_SMALL).collect()
    covered, filled = {}, {}
    for r in out:
        assert r.ids_crc32 == zlib.crc32(tokens[r.doc_id][r.start : r.start + r.length].tobytes())
        covered.setdefault(r.doc_id, np.zeros(len(tokens[r.doc_id]), int))[r.start : r.start + r.length] += 1
        filled[r.sequence_id] = filled.get(r.sequence_id, 0) + r.length
    assert set(covered) == {i for i, n in copies.items() if n}
    assert all((covered[i] == copies[i]).all() for i in covered)
    assert all(n == packing.WINDOW or n & (n - 1) == 0 for n in filled.values())


def test_filtering_stages_keep_whole_rows(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").withColumn("note", F.col("doc_id") * 2)
    for _, stage in corpus_pipeline.STAGES[:2]:
        out = stage(spark, docs, SF_SMALL)
        assert out.columns == docs.columns
        whole = [tuple(r) for r in docs.collect()]
        kept = [tuple(r) for r in out.collect()]
        assert len(set(kept)) == len(kept) > 0.5 * len(whole) and set(kept) <= set(whole)
