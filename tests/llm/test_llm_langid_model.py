"""The backoff model: plain scores, and small languages beside large ones."""

import math
import zlib
from collections import Counter

from pyspark.sql import functions as F

from rankflow.llm import langid

DOCS = "/root/testdata/sf0.01/documents.parquet"


def _plain_scores(model, text):
    """Sums over the words, straight from the definition."""
    words = langid.LETTERS.findall(text.lower())
    total = [0.0] * len(model.langs)
    for word, n in Counter(words).items():
        index, logs = model.words
        rows = [logs[index[word]]] if word in index else []
        for size in range(langid.LONGEST, 0, -1):
            if rows:
                break
            index, logs = model.grams[size - 1]
            rows = [logs[index[g]] for g in langid.grams(word, size) if g in index]
        for i in range(len(total)):
            total[i] += n * (sum(float(r[i]) for r in rows) / len(rows) if rows else 0.0)
    return total


def test_scores_equal_the_definition(spark):
    docs = spark.read.parquet(DOCS)
    model = langid.fit(docs)
    for r in docs.orderBy("doc_id").limit(40).collect() + [type("R", (), {"text": "Unseenword xqzv ÿÿÿ the"})()]:
        if not r.text or len(r.text) > 5000:
            continue
        scores = _plain_scores(model, r.text)
        lang, _, _ = langid.Scorer(model).predict(r.text)
        assert math.isclose(max(scores), scores[model.langs.index(lang)], rel_tol=1e-5)


def test_counts_of_words_and_ngrams(spark):
    docs = spark.createDataFrame([(i, "aba ab", "xx") for i in range(40)] + [(100 + i, "abc", "yy") for i in range(8)], "doc_id long, text string, lang string")
    model = langid.fit(docs)
    assert set(model.words[0]) == {"aba", "ab", "abc"}
    assert [set(index) for index, _ in model.grams] == [
        {"a", "b", "c"}, {"^a", "ab", "ba", "a$", "b$", "bc", "c$"}, {"^ab", "aba", "ba$", "ab$", "abc", "bc$"}, {"^aba", "aba$", "^ab$", "^abc", "abc$"}
    ]


def test_a_small_language_keeps_its_words_and_its_texts(spark):
    """Six training texts of a made-up language beside hundreds of the others."""
    docs = spark.read.parquet(DOCS).select("doc_id", "text", "lang")
    made = [f"{a}{b}{c}" for a in ("zu", "vok", "tri", "glo") for b in ("mba", "rka", "ndi", "lho", "shu") for c in ("x", "ka", "q", "to")]
    ids = [i for i in range(900_000, 900_400)]
    texts = [(i, " ".join(made[(i * 7 + k * (1 + i % 5)) % len(made)] for k in range(60)), "zz") for i in ids]
    trained = [r for r in texts if zlib.crc32(str(r[0]).encode()) % 4 != 2][:6]
    held = [r for r in texts if zlib.crc32(str(r[0]).encode()) % 4 == 2][:60]
    both = docs.unionByName(spark.createDataFrame(trained + held, "doc_id long, text string, lang string"))
    model = langid.fit(both.where(~((F.col("lang") == "zz") & langid.held_out(F.col("doc_id")))))
    own = {w for _, t, _ in trained for w in t.split()}
    assert own <= set(model.words[0]) and len(own) > 40
    found = langid.query(both).where(F.col("doc_id") >= 900_000).collect()
    assert len(found) == 66 and all(r.lang_pred == "zz" for r in found)


def test_a_cut_per_language(spark):
    """With two words a language the smaller one keeps its two as well."""
    docs = spark.createDataFrame(
        [(i, "one two three four", "aa") for i in range(50)] + [(200 + i, "uno due", "bb") for i in range(4)], "doc_id long, text string, lang string"
    )
    model = langid.fit(docs, words=2, grams=3)
    assert {"uno", "due"} <= set(model.words[0]) and len(model.words[0]) == 4
    assert all(len(index) <= 6 for index, _ in model.grams)


def test_filter_does_not_shrink_with_languages(spark):
    """Forty languages: no text has a large share of the sum, but each leads by its own words."""
    import numpy as np

    rng = np.random.default_rng(6)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    lexicon = {f"l{i:02}": ["".join(rng.choice(letters, rng.integers(3, 8))) for _ in range(60)] for i in range(40)}
    rows = [(i, " ".join(rng.choice(lexicon[lang], 30)), lang) for i, lang in enumerate(sorted(lexicon) * 8)]
    rows += [(5000, "", None), (5001, "12 34", None), (5002, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r.doc_id for r in langid.keep_known(docs).collect()} == set(range(len(rows) - 3))
    one = spark.createDataFrame([r for r in rows if r[2] in ("l00", None)], docs.schema)
    assert langid.keep_known(one).count() == 8
