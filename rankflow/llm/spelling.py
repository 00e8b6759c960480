"""Spelling variants: K-d trees over letter counts.

One inserted, deleted or replaced letter moves a word's vector of letter
counts by at most two (L1). Words of one length are an index: a K-d tree
whose splits, fitted on a hash sample of about ``SAMPLE`` words, cut them
into cells. A word visits every cell of its own length, and of the next one,
whose box it can reach with one letter changed, or added. Inside a cell a tree
with tight boxes prunes again; what is left is compared by counts (a matrix
product) and then letter by letter. Each pair of words meets in one cell only.
Where cells would hold more than ``BLOCK`` words they are dealt into blocks,
all of which a visitor searches; no pair is left out.

Words are counted by Spark over all texts. A word's form is the commonest
near word that is at least twice as common; roots follow forms by pointer
doubling (a form is twice as common as its word, so chains are short).

Defined results: a null or empty text has no words, a null ``doc_id`` counts
as the empty text in the rule that damages words; repeated rows count again;
an empty table gives no rows; ties of ``n`` go to the word that is smaller in
code point order; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankflow.llm.common import prepare, saved, text_rows

RUN = "[A-Za-z\\u00C0-\\u00FF]+"
LEAST_POINTS, LEAST_COUNT, RATIO, DAMAGE = 5, 3, 2, 97
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: words that the splits are fitted on, words of a cell aimed at, words of a block, words of a leaf
SAMPLE, CELL, BLOCK, LEAF = 40_000, 4_000, 16_000, 64
#: dimensions: a letter each, the accented ones share six; counts above four compare as four
DIMS, LEVELS = 32, 4
#: bytes that one comparison of candidate pairs holds
ROOM = 1 << 24


# ------------------------------------------------------------------- words
def words(docs: DataFrame) -> DataFrame:
    """(word, n): all damaged and undamaged runs of the texts, counted."""
    run = F.explode(F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(RUN), F.lit(0))).alias("run")
    runs = text_rows(docs).select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("d"), run)
    hashed = runs.select("run", F.crc32(F.concat("d", F.lit(":"), "run").cast("binary")).alias("h"))
    cut = F.expr("concat(left(run, cast(h % length(run) as int)), substr(run, cast(h % length(run) as int) + 2))")
    word = hashed.select(F.when(F.col("h") % DAMAGE == 0, cut).otherwise(F.col("run")).alias("word"))
    long_enough = word.where(F.length("word") >= LEAST_POINTS)
    return long_enough.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_COUNT)


# ------------------------------------------------------------------- cells
def letters(words: list[str]) -> np.ndarray:
    """Code points of words of one length, a row each."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def counts(codes: np.ndarray) -> np.ndarray:
    """Letter-count vectors."""
    dim = np.where((codes >= 97) & (codes <= 122), codes.astype(np.int64) - 97, 26 + codes % 6)
    at = np.arange(len(codes))[:, None] * DIMS + dim
    return np.bincount(at.ravel(), minlength=len(codes) * DIMS).reshape(-1, DIMS).astype(np.int32)


def split(v: np.ndarray) -> tuple[int, int] | None:
    """The (letter, count) that halves the rows best: rows up to that count, rows above it."""
    best = None
    for d in np.argsort(-v.var(0), kind="stable")[:8]:
        at = int(np.median(v[:, d]))
        for t in (at - 1, at):
            low = int((v[:, d] <= t).sum())
            if 0 < low < len(v) and (best is None or abs(2 * low - len(v)) < best[0]):
                best = (abs(2 * low - len(v)), int(d), t)
    return None if best is None else best[1:]


class Cells:
    """Per word length, a K-d tree of (letter, count) splits; its leaves, the cells, are numbered over all lengths."""

    def __init__(self, sample: list[str], total: int):
        share = len(sample) / max(total, 1)
        by_length: dict[int, list[str]] = {}
        for w in sample:
            by_length.setdefault(len(w), []).append(w)
        self.trees: dict[int, int | tuple] = {}
        self.n = 0
        for n in sorted(by_length):
            self.trees[n] = self._grown(counts(letters(by_length[n])), max(CELL * share, 2))
        #: a cell's words are dealt into so many blocks, all of which its visitors search
        self.blocks = max(-(-total // (max(self.n, 1) * BLOCK)), 1)

    def _grown(self, v: np.ndarray, size: float):
        cut = split(v) if len(v) > size else None
        if cut is None:
            self.n += 1
            return self.n - 1
        low = v[:, cut[0]] <= cut[1]
        return (*cut, self._grown(v[low], size), self._grown(v[~low], size))

    def visits(self, v: np.ndarray, length: int, longer: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(cell, rows, whether it is their home): the cells of words with ``length`` letters that the rows reach.

        A near word has one letter more of one kind, and if it is no longer, one fewer of another; a side of a
        cell's box costs the letters that it lies away. A length that the sample lacks is one cell.
        """
        rows = np.arange(len(v))
        none = np.zeros(len(v), np.int64)
        stack = [(self.trees.get(length, -length), rows, none, none, {})]
        while stack:
            node, rows, up, down, box = stack.pop()
            if isinstance(node, int):
                yield node, rows, (up + down == 0) & (longer == 0)
                continue
            d, t, low, high = node
            lo, hi = box.get(d, (0, 1 << 30))
            x = v[rows, d]
            was_up, was_down = np.maximum(lo - x, 0), np.maximum(x - hi, 0)
            for child, side in ((low, (lo, t)), (high, (t + 1, hi))):
                u = up - was_up + np.maximum(side[0] - x, 0)
                w = down - was_down + np.maximum(x - side[1], 0)
                keep = (u <= 1) & (w <= 1 - longer)
                if keep.any():
                    stack.append((child, rows[keep], u[keep], w[keep], box | {d: side}))


def merged(batches: Iterator[pa.RecordBatch], rows: int = 8192, size: int = 1 << 23) -> Iterator[pa.RecordBatch]:
    """Fewer, larger batches, of so many rows or bytes."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= rows or sum(b.nbytes for b in held) >= size:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held = []
    if sum(b.num_rows for b in held):
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


VISIT = "cell long, block int, asks int, word string, n long"
#: a row of a cell: a word of it, a word of it that asks, a visitor
HELD, ASKS, VISITS = 0, 1, 2


def _visits(cells: Cells):
    """Rows by ``VISIT``: every word lies in its home cell, and asks there and in the cells that it reaches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in merged(batches):
            words, n = batch.column("word"), batch.column("n")
            word = words.to_pylist()
            sizes = np.array([len(w) for w in word], np.int64)
            for size in np.unique(sizes):
                rows = np.flatnonzero(sizes == size)
                v = counts(letters([word[i] for i in rows]))
                same = list(cells.visits(v, int(size), 0))
                home = np.zeros(len(rows), np.int64)
                for cell, at, is_home in same:
                    home[at[is_home]] = cell
                block = np.array([zlib.crc32(word[i].encode()) % cells.blocks for i in rows], np.int32)
                every = np.arange(len(rows))
                out = [(home, block, HELD, every)]
                # a pair of one length meets in the later of its two homes
                asking = [(np.full(len(at), cell), np.where(home[at] == cell, ASKS, VISITS), at) for cell, at, _ in same]
                asking = [(c[keep], kind[keep], at[keep]) for c, kind, at in asking if len(keep := np.flatnonzero(home[at] <= c))]
                asking += [(np.full(len(at), cell), VISITS, at) for cell, at, _ in cells.visits(v, int(size) + 1, 1)]
                out += [(c, b, kind, at) for c, kind, at in asking for b in range(cells.blocks)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([c for c, *_ in out])),
                        pa.array(np.concatenate([np.broadcast_to(np.int32(b), at.shape) if np.isscalar(b) else b for _, b, _, at in out])),
                        pa.array(np.concatenate([np.broadcast_to(np.asarray(kind, np.int32), at.shape) for *_, kind, at in out])),
                        words.take(where := pa.array(np.concatenate([rows[at] for *_, at in out]))),
                        n.take(where),
                    ],
                    ["cell", "block", "asks", "word", "n"],
                )

    return run


# ------------------------------------------------------------ search in a cell
def steps(v: np.ndarray) -> np.ndarray:
    """Counts as unit steps: the inner product of two rows is the sum of the smaller counts."""
    return np.concatenate([(v >= k) for k in range(1, LEVELS + 1)], 1).astype(np.float32)


class Tree:
    """K-d tree over words of one length, with tight boxes."""

    def __init__(self, words: list[str]):
        self.codes = letters(words)
        self.v = counts(self.codes)
        self.root = self._node(np.arange(len(words)))

    def _node(self, rows: np.ndarray):
        v = self.v[rows]
        cut = split(v) if len(rows) > LEAF else None
        parts = None
        if cut:
            low = v[:, cut[0]] <= cut[1]
            parts = (self._node(rows[low]), self._node(rows[~low]))
        s = None if parts else steps(v)
        return v.min(0), v.max(0), rows, s, parts

    def near(self, codes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(asking row, own row) of words that differ by one letter; the asking ones have as many letters or one fewer."""
        longer = self.codes.shape[1] - codes.shape[1]
        v, reach = counts(codes), 2 - longer
        mine = steps(v)
        total = mine.sum(1)
        stack = [(self.root, np.arange(len(codes)))]
        while stack:
            (lo, hi, rows, s, parts), asking = stack.pop()
            x = v[asking]
            up, down = np.maximum(lo - x, 0).sum(1), np.maximum(x - hi, 0).sum(1)
            asking = asking[(up <= 1) & (down <= 1 - longer)]
            if not len(asking):
                continue
            if parts:
                stack += [(p, asking) for p in parts]
                continue
            step = max(ROOM // (4 * len(rows)), 1)
            for i in range(0, len(asking), step):
                part = asking[i : i + step]
                apart = total[part][:, None] + s.sum(1)[None, :] - 2 * (mine[part] @ s.T)
                a, b = np.nonzero(apart <= reach)
                yield from self._spelled(codes, part[a], rows[b], longer)

    def _spelled(self, codes, a, b, longer) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        step = max(ROOM // max(self.codes.shape[1], 1), 1)
        for i in range(0, len(a), step):
            x, y = codes[a[i : i + step]], self.codes[b[i : i + step]]
            if not longer:
                ok = (x != y).sum(1) == 1
            else:
                # equal letters from the left and from the right must cover the shorter word
                left = np.cumprod(x == y[:, :-1], 1).sum(1)
                right = np.cumprod((x == y[:, 1:])[:, ::-1], 1).sum(1)
                ok = left + right >= x.shape[1]
            yield a[i : i + step][ok], b[i : i + step][ok]


PAIR = "word string, n long, near string, near_n long"


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of one block after the other: rows come sorted by block, its words before those that ask."""
    place, held, held_n, tree = None, [], [], None
    for batch in merged(batches):
        cell, block, asks, n = (batch.column(c).to_numpy() for c in ("cell", "block", "asks", "n"))
        word = batch.column("word").to_pylist()
        edge = np.flatnonzero((np.diff(cell) != 0) | (np.diff(block) != 0) | (np.diff(asks) != 0)) + 1
        for lo, hi in zip([0, *edge], [*edge, len(word)]):
            if lo == hi:
                continue
            if (cell[lo], block[lo]) != place:
                place, held, held_n, tree = (cell[lo], block[lo]), [], [], None
            if asks[lo] == HELD:
                held += word[lo:hi]
                held_n.append(n[lo:hi])
                continue
            if not held:
                continue
            if tree is None:
                tree, own, own_n = Tree(held), pa.array(held, pa.string()), np.concatenate(held_n)
            sizes = np.array([len(w) for w in word[lo:hi]])
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size) + lo
                asked = [word[i] for i in at]
                mine, mine_n = pa.array(asked, pa.string()), n[at]
                for a, b in tree.near(letters(asked)):
                    left, right = mine.take(pa.array(a)), own.take(pa.array(b))
                    out = pa.RecordBatch.from_arrays([left, pa.array(mine_n[a]), right, pa.array(own_n[b])], ["word", "n", "near", "near_n"])
                    # both words of a pair ask in a home that they share
                    yield out.filter(pc.less(left, right)) if asks[lo] == ASKS else out


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n): every pair of near words once, in either order. ``words`` (word, n) is read several times."""
    spark = words.sparkSession
    total = words.count()
    u = F.pmod(F.xxhash64(F.lit("spelling"), "word"), F.lit(1 << 40))
    sample = words.where(u < int((1 << 40) * min(SAMPLE / max(total, 1), 1.0))).select("word")
    cells = Cells([r.word for r in sample.collect()], total)
    parts = max(cells.n * cells.blocks, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = words.mapInArrow(_visits(cells), VISIT).repartition(parts, "cell", "block")
    return rows.sortWithinPartitions("cell", "block", "asks").mapInArrow(_search, PAIR)


# ------------------------------------------------------------------- forms
def roots(forms: DataFrame) -> DataFrame:
    """(word, root): forms followed to the last one, by pointer doubling."""
    known = saved(forms.select("word", F.col("form").alias("root")))
    while True:
        further = known.select(F.col("word").alias("root"), F.col("root").alias("next"))
        longer = saved(known.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        known = longer.select("word", "root")
        if longer.where("moved").isEmpty():
            return known


def variants(words: DataFrame) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of a saved frame (word, n)."""
    both = near_pairs(words).select(F.inline(F.array(
        F.struct("word", F.struct((-F.col("near_n")).alias("less"), "near").alias("best")),
        F.struct(F.col("near").alias("word"), F.struct((-F.col("n")).alias("less"), F.col("word").alias("near")).alias("best")),
    )))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min("best").alias("best"))
    is_form = -F.col("best.less") >= RATIO * F.col("n")
    found = saved(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("best.near")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n"),
    ))
    return found.join(roots(found.where("form IS NOT NULL")), "word", "left").withColumn("root", F.coalesce("root", "word"))


def query(docs: DataFrame) -> DataFrame:
    prepare(docs.sparkSession)
    return variants(saved(words(docs))).select("word", "n", "n_near", "form", "form_n", "root")


#: the same rows in SQL: words share what is left when a letter is taken out
ORACLE = f"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda x: list_reduce(list_prepend(x, range(8)), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, CAST(3988292384 AS BIGINT)) ELSE c // 2 END)) AS t
),
runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS d, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents
),
per_doc AS (SELECT d, run, count(*) AS c FROM runs GROUP BY d, run),
bytes AS (
  SELECT d, run, c, flatten(list_transform(string_split(d || ':' || run, ''), lambda x:
    CASE WHEN unicode(x) < 128 THEN [unicode(x)] ELSE [192 + unicode(x) // 64, 128 + unicode(x) % 64] END)) AS b
  FROM per_doc
),
hashed AS (
  SELECT d, run, c, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(b, lambda x: CAST(x AS BIGINT))),
    lambda a, x: xor(a // 256, t[xor(a, x) % 256 + 1])), CAST(4294967295 AS BIGINT)) AS h FROM bytes, crc
),
words AS (
  SELECT word, CAST(sum(c) AS BIGINT) AS n FROM (
    SELECT c, CASE WHEN h % {DAMAGE} = 0 THEN left(run, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) AS INT) + 2) ELSE run END AS word FROM hashed
  ) WHERE length(word) >= {LEAST_POINTS} GROUP BY word HAVING sum(c) >= {LEAST_COUNT}
),
cut AS (
  SELECT word, n, i, left(word, CAST(i AS INT) - 1) || substr(word, CAST(i AS INT) + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
),
near AS (
  SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest WHERE a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM words a JOIN cut b ON a.word = b.rest
  UNION SELECT b.word, b.n, a.word, a.n FROM words a JOIN cut b ON a.word = b.rest
),
best AS (
  SELECT word, count(*) AS n_near, max(near_n) AS most FROM near GROUP BY word
),
forms AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, b.most,
    (SELECT min(m.near) FROM near m WHERE m.word = w.word AND m.near_n = b.most AND b.most >= {RATIO} * w.n) AS form
  FROM words w LEFT JOIN best b USING (word)
),
chain AS (
  SELECT word, form AS at FROM forms WHERE form IS NOT NULL
  UNION ALL SELECT c.word, f.form FROM chain c JOIN forms f ON f.word = c.at WHERE f.form IS NOT NULL
),
ends AS (SELECT c.word, c.at AS root FROM chain c JOIN forms f ON f.word = c.at WHERE f.form IS NULL)
SELECT f.word, f.n, f.n_near, f.form, CASE WHEN f.form IS NOT NULL THEN f.most END AS form_n, coalesce(e.root, f.word) AS root
FROM forms f LEFT JOIN ends e USING (word)"""
