"""Nulls, empty and long texts, repeated rows, empty tables and clashing columns, for every operator and stage."""

import hashlib

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from rankflow.llm import chat, kdtree, langid, licenses, mih, mixing, packing, pii, simhash, substrings

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
QUERIES = {
    "op1": langid.query, "op2": mixing.query, "op3": substrings.query, "op5": packing.query,
    "op8": licenses.query, "op9": simhash.query, "op10": pii.query,
}
CLASHING = [
    "size", "score", "target", "copies", "bucket", "shard", "key", "whole", "steps", "lo", "hi", "n", "m", "k", "fp", "th", "tn",
    "component_id", "fingerprint", "lang_pred", "p", "u", "word", "part", "own", "before", "weight", "kept", "node", "root", "a.b",
]
LONG = " ".join(f"word{i % 977} mot" for i in range(30_000))
ROWS = [
    (1, "the cat sat on the mat with the other cat of the house", "en", "a", 1),
    (2, "the cat sat on the mat with the other cat of the house", "en", "a", None),
    (2, "the cat sat on the mat with the other cat of the house", "en", "a", None),
    (3, None, "en", "b", 0), (4, "", None, "b", 0), (5, " \t\n ", "fr", None, 3), (6, "12 345 - !!", "fr", "c", 9),
    (None, "le chat est dans la maison avec les autres", "fr", None, 4), (None, None, None, None, None),
    (7, LONG, "fr", "c", len(LONG)), (8, "le chat est dans la maison avec les autres chats", None, "é", 1),
    (9, "x\u0000y \U0001f600 ñ", "es", "", 5),
]


def rows_of(spark, clashing=False):
    df = spark.createDataFrame(ROWS, DOCS)
    return df.withColumns({c: F.lit("clash") for c in CLASHING}) if clashing else df


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_odd_rows_and_clashing_columns(spark, name):
    plain = [tuple(r) for r in QUERIES[name](rows_of(spark)).collect()]
    clash = [tuple(r) for r in QUERIES[name](rows_of(spark, True)).collect()]
    assert sorted(plain, key=str) == sorted(clash, key=str)
    if name != "op5":
        assert len(plain) == len(ROWS)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_documents(spark, name):
    assert QUERIES[name](spark.createDataFrame([], DOCS)).collect() == []


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES, ids=lambda s: s[0])
def test_stages_on_odd_and_empty_rows(spark, stage):
    name, run = stage
    odd, empty = rows_of(spark, True), spark.createDataFrame([], DOCS)
    out = run(spark, odd, "")
    assert run(spark, empty, "").collect() == []
    found = out.collect()
    if name == "packing":
        assert sum(r.length for r in found if r.doc_id == 3) == 1
    else:
        assert out.columns == odd.columns
        assert out.schema["n_chars"].dataType == odd.schema["n_chars"].dataType
        assert all(r["size"] == "clash" for r in found)


def test_defined_results(spark):
    by = {name: QUERIES[name](rows_of(spark)).collect() for name in QUERIES}
    langs = {(r.doc_id, r.lang_pred) for r in by["op1"]}
    assert {(3, "und"), (4, "und"), (5, "und"), (6, "und")} <= langs
    assert all(r.size == 0 and r.taken == 0 for r in by["op2"] if r.doc_id in (3, 4, 5))
    nothing = hashlib.sha256(b"").hexdigest()
    assert all((r.n_bytes, r.n_removed, r.kept_sha256) == (0, 0, nothing) for r in by["op3"] if r.doc_id in (3, 4))
    assert {r.component_id for r in by["op9"] if r.doc_id in (3, 4, 5)} == {3}
    assert {r.fingerprint for r in by["op9"] if r.doc_id in (3, 4, 5)} == {"0" * 16}
    assert {r.component_id for r in by["op9"] if r.doc_id == 2} == {1}
    assert all(r.base_sha256 == nothing and r.spans == "" for r in by["op10"] if r.doc_id in (3, 4))


VECTORS = "vec_id long, embedding array<float>, label int"


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i * 50, [float(i % 3), float(i % 5) - 2, 1.0], i) for i in range(20)]
    odd = [(7, None, 0), (8, [], 0), (9, [nan, 1.0, 1.0], 0), (10, [inf, 1.0, 1.0], 0), (11, [None, 1.0, 1.0], 0),
           (None, [1.0, 1.0, 1.0], 0), (12, [1.0], 0), (200, [0.0, -2.0, 1.0], 1), (13, [0.0, 0.0, 0.0], 0)]
    df = spark.createDataFrame(rows + odd, VECTORS).withColumns({c: F.lit("x") for c in ("v", "query_id", "score", "shard", "block", "floor", "rank")})
    near, top = mih.query(df).collect(), kdtree.query(df).collect()
    assert {r.query_id for r in near} == {i * 50 for i in range(0, 20, 2)}
    assert {r.query_id for r in top} == {i * 50 for i in range(20)}
    bad = {7, 8, 9, 10, 11, 12, None}
    assert not bad & {r.vec_id for r in near + top}
    assert 13 not in {r.vec_id for r in near}
    empty = spark.createDataFrame([], VECTORS)
    assert mih.query(empty).collect() == [] and kdtree.query(empty).collect() == []


def test_odd_conversations(spark):
    shape = "conv_id long, turn long, role string, text string"
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", None), (1, 1, "assistant", None), (2, None, None, ""), (None, 0, "user", "a<|end|>b"),
            (3, 0, "user", "x" * 50_000), (3, 1, "assistant", "␛<|turn|>")]
    found = {r.conv_id: r for r in chat.query(spark.createDataFrame(rows, shape).withColumn("node", F.lit("x"))).collect()}
    assert set(found) == {1, 2, None, 3, -1}
    assert (found[1].n_turns, found[1].loss_chars) == (3, 0)
    assert found[2].turns_sha256 == hashlib.sha256(b"\n\n").hexdigest()
    assert found[3].loss_sha256 == hashlib.sha256("␛<|turn|>".encode()).hexdigest()
    assert [r.conv_id for r in chat.query(spark.createDataFrame([], shape)).collect()] == [-1]
