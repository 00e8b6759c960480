"""Language identification by word-first backoff.

A known word scores its smoothed log frequency in every language. An unseen
word falls back to its character n-grams: the mean log frequency of its known
4-grams (with word marks), else of its 3-grams, 2-grams and single characters.
A text's language has the largest sum over its words; its score is the mean
share of that language in the words' own probabilities (0 to 1). The filter goes
by the lead instead: by how much that sum, per word, exceeds the runner-up's. A
share shrinks as languages are added, a lead does not.

The model is fitted on a hash sample of the labelled rows that are not held
out (``ROWS_PER_LANG`` rows of each language are expected). Spark counts its
words and n-grams; of each language the ``WORDS`` commonest words and the
``GRAMS`` commonest n-grams of each length are kept, with their counts in all
languages, so the model grows with the number of languages and a small
language keeps its own words. Counts are brought to the same total per
language before they are smoothed: what a language lacks costs the same in
all. Every row is predicted, over its whole text.

Defined results: ``und`` with score 0 for a null text, a text without a letter,
or when no labelled row exists; equal sums go to the language first in code
point order; a null doc_id is neither held out nor learned from; repeated rows
each get a row; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankflow.llm.common import prepare, saved, texts_of

ROWS_PER_LANG, WORDS, GRAMS = 1500, 15_000, 8_000
LONGEST, SMOOTHING = 4, 0.5
#: scores of words that a worker remembers
REMEMBERED = 200_000
UNKNOWN = "und"
#: least lead (log units a word) of a text that the filter keeps
KEEP_LEAD = 0.1
LETTERS = re.compile(r"[^\W\d_]+")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame, rows_per_lang: int = ROWS_PER_LANG) -> DataFrame:
    """(lang, text) of a hash sample of the labelled rows, about ``rows_per_lang`` per language."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string")).where(
        F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))
    )
    # a number per language, as many as the model has columns
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    share = F.lit(0.0)
    if sizes:
        share = F.element_at(F.create_map(*[F.lit(x) for lang, n in sorted(sizes.items()) for x in (lang, rows_per_lang / n)]), F.col("lang"))
    u = F.pmod(F.xxhash64(F.lit("langid"), "doc_id"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    return rows.where((u < share) & F.col("text").isNotNull()).select("lang", "text")


def grams(word: str, n: int) -> list[str]:
    marked = f"^{word}$" if n > 1 else word
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


class Model:
    """Log frequencies of words and n-grams by language; rows of a matrix, found by a dictionary."""

    def __init__(self, words: list[tuple[str, str, int]], parts: list[tuple[str, int, str, int]] | None = None):
        """``words``: (language, word, count); ``parts``: (language, length, n-gram, count), by default those of the words."""
        if parts is None:
            parts = [(lang, n, g, c) for lang, word, c in words for n in range(1, LONGEST + 1) for g in grams(word, n)]
        self.langs = sorted({lang for lang, _, _ in words})
        self.words = self._logs(words)
        self.grams = [self._logs([(lang, g, c) for lang, size, g, c in parts if size == n]) for n in range(1, LONGEST + 1)]

    def _logs(self, counts: list[tuple[str, str, int]]) -> tuple[dict[str, int], np.ndarray]:
        at = {lang: i for i, lang in enumerate(self.langs)}
        index: dict[str, int] = {}
        for _, item, _ in counts:
            index.setdefault(item, len(index))
        m = np.zeros((len(index), len(at)))
        for lang, item, n in counts:
            m[index[item], at[lang]] += n
        if not index:
            return {}, m.astype(np.float32)
        total = m.sum(0)
        m = m * (total.max() / np.maximum(total, 1)) + SMOOTHING
        return index, np.log(m / m.sum(0)).astype(np.float32)


class Scorer:
    """Scores texts with a model; remembers the rows of words met before."""

    def __init__(self, model: Model):
        self.model, self.langs = model, model.langs
        self.forget()

    def forget(self) -> None:
        index, logs = self.model.words
        self.rows = dict(index)
        self.used = len(logs)
        self.logs = np.concatenate((logs, np.zeros((REMEMBERED, len(self.langs)), np.float32)))
        if not self.langs:
            return
        e = np.exp(self.logs - self.logs.max(1, keepdims=True))
        self.share = e / e.sum(1, keepdims=True)

    def learn(self, words: list[str]) -> None:
        """Scores unseen words: each by its longest n-grams of which any is known."""
        at = {w: self.used + i for i, w in enumerate(words)}
        todo = words
        for n in range(LONGEST, 0, -1):
            index, logs = self.model.grams[n - 1]
            get, found, sizes, rows, rest = index.get, [], [], [], []
            for w in todo:
                known = [i for g in grams(w, n) if (i := get(g)) is not None]
                if known:
                    found += known
                    sizes.append(len(known))
                    rows.append(at[w])
                else:
                    rest.append(w)
            if rows:
                n_known = np.array(sizes)
                self.logs[rows] = np.add.reduceat(logs[found], np.cumsum(n_known) - n_known) / n_known[:, None].astype(np.float32)
            todo = rest
            if not todo:
                break
        self.logs[[at[w] for w in todo]] = 0
        new = self.logs[self.used : self.used + len(words)]
        e = np.exp(new - new.max(1, keepdims=True))
        self.share[self.used : self.used + len(words)] = e / e.sum(1, keepdims=True)
        self.rows.update(at)
        self.used += len(words)

    def predict(self, text: str | None) -> tuple[str, float, float]:
        """(language, score, lead); the lead of an only language is infinite."""
        words = LETTERS.findall(text.lower()) if text else []
        # the pattern also lets number signs such as a half through
        if not self.langs or not any(c.isalpha() for w in words for c in w):
            return UNKNOWN, 0.0, 0.0
        total, shares, n = np.zeros(len(self.langs)), np.zeros(len(self.langs)), len(words)
        counts = Counter(words)
        items = list(counts.items())
        for lo in range(0, len(items), REMEMBERED // 2):
            part = items[lo : lo + REMEMBERED // 2]
            if self.used + len(part) > len(self.logs):
                self.forget()
            if new := [w for w, _ in part if w not in self.rows]:
                self.learn(new)
            get = self.rows.__getitem__
            rows = [get(w) for w, _ in part]
            c = np.array([k for _, k in part], np.float64)
            total += c @ self.logs[rows]
            shares += c @ self.share[rows]
        best = int(total.argmax())
        lead = total[best] - np.delete(total, best).max(initial=-np.inf)
        return self.langs[best], float(min(max(shares[best] / n, 0.0), 1.0)), float(lead / n)


def _commonest(counts: DataFrame, of: list[str], items: list[str], most: int) -> DataFrame:
    """The rows of ``counts`` whose items are among the ``most`` commonest of any group ``of``."""
    rank = F.row_number().over(Window.partitionBy(*of).orderBy(F.desc("n"), *items))
    kept = counts.withColumn("rank", rank).where(F.col("rank") <= most).select(*items).distinct()
    return counts.join(kept, items)


def _grams(word: str, size: int) -> Column:
    """``grams`` as an array of (size, gram); null where the word is too short."""
    marked = F.concat(F.lit("^"), word, F.lit("$")) if size > 1 else F.col(word)
    starts = F.sequence(F.lit(1), F.length(marked) - F.lit(size - 1))
    every = F.transform(starts, lambda i: F.struct(F.lit(size).alias("size"), F.substr(marked, i, F.lit(size)).alias("gram")))
    return F.when(F.length(marked) >= size, every)


def fit(docs: DataFrame, words: int = WORDS, grams: int = GRAMS) -> Model:
    """Word and n-gram counts by language, added up by Spark; the commonest of each language reach the driver."""
    word = F.explode(F.regexp_extract_all(F.lower("text"), F.lit("(\\p{L}+)"), 1))
    counts = saved(training_rows(docs).select("lang", word.alias("word")).groupBy("lang", "word").agg(F.count("*").alias("n")))
    parts = F.array_compact(F.array(*[_grams("word", n) for n in range(1, LONGEST + 1)]))
    found = counts.select("lang", "n", F.inline(F.flatten(parts)))
    found = found.groupBy("lang", "size", "gram").agg(F.sum("n").alias("n"))
    kept = _commonest(counts, ["lang"], ["word"], words).collect()
    kept_grams = _commonest(found, ["lang", "size"], ["size", "gram"], grams).collect()
    return Model([(r.lang, r.word, r.n) for r in kept], [(r.lang, r["size"], r.gram, r.n) for r in kept_grams])


_SCORERS: dict[int, Scorer] = {}


def _scorer(shared) -> Scorer:
    """One scorer per worker process and model."""
    if shared.id not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[shared.id] = Scorer(shared.value)
    return _SCORERS[shared.id]


def predictor(docs: DataFrame):
    """A function from a text column to ``struct<lang_pred, score, lead>``, fitted on ``docs``."""
    prepare(docs.sparkSession)
    shared = _Shared(docs.sparkSession.sparkContext.broadcast(fit(docs)))

    @F.arrow_udf("struct<lang_pred: string, score: double, lead: double>")
    def predict(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = _scorer(shared)
        for part in texts:
            found = [scorer.predict(part[i].as_py()) for i in range(len(part))]
            yield pa.StructArray.from_arrays(
                [pa.array([x[0] for x in found], pa.string()), *(pa.array([x[i] for x in found], pa.float64()) for i in (1, 2))],
                ["lang_pred", "score", "lead"],
            )

    return predict


class _Shared:
    """A broadcast model with the number that names it."""

    def __init__(self, broadcast):
        self.broadcast, self.id = broadcast, broadcast._jbroadcast.id()

    @property
    def value(self):
        return self.broadcast.value


def query(docs: DataFrame) -> DataFrame:
    predict = predictor(docs)
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), predict(F.col("text").cast("string")).alias("p"))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "p.lang_pred", "p.score", "p.lead")


def keep_known(docs: DataFrame, least: float = KEEP_LEAD) -> DataFrame:
    """All columns of the rows whose text has a language that leads by at least this much a word."""
    predict = predictor(docs)
    found = docs.withColumn("__lang", predict(F.col("text").cast("string")))
    return found.where((F.col("__lang.lang_pred") != UNKNOWN) & (F.col("__lang.lead") >= least)).select(
        *[F.col(f"`{c}`") for c in docs.columns]
    )
