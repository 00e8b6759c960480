"""Lexical retrieval packing into training windows.

Documents are tokenized once; document counts per term, their number and mean
length are taken over the whole corpus. A document's key is its strongest
corpus-wide BM25 term; a key with more than a shard of text is split by the
next terms, ``DEPTH`` in all, and what is still too big by a hash of the row.
Keys are dealt by hash into shards of about so much text, each with a BM25 inverted index.
Each window starts with a seed document; its terms retrieve the unused
neighbours, which fill the window greedily, best first. A document that is
longer than what is left of a window goes on in the next one, so that windows
are full. What is left at a shard's end is cut into sequences whose lengths
are powers of two.

Defined results: a null text is an empty one, a document of the single end id;
every id lies in exactly one piece; repeated rows are packed as documents of
their own; equal scores go to the earlier row of the shard (doc_id, then text
hash); an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from itertools import accumulate, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import Split

from rankflow.llm import blocks
from rankflow.llm.common import prepare, saved, text_rows

WINDOW, END_ID = 4096, 2
SHARD_BYTES = 8 << 20
#: strongest terms by which a key that is too big is split, one after the other
DEPTH = 6
K1, B = 1.2, 0.75
#: pieces, and odd chunks, whose ids a worker remembers
REMEMBERED = 350_000
#: characters of texts that are encoded at once: the longer, the fewer chunks stand in several
CHARS = 12_000_000
#: texts of these characters only: white space as str.split() sees it, lower case one by one
PLAIN = re.compile("[^\\t\\n\\r\\x20-\\x7e\\u00a1-\\u012f\\u0131-\\u017f]")
BLANK = "[ \\t\\n\\r]+"
#: pieces of plain lower-case chunks between line feeds, as the tokenizer's own pattern cuts them, and the line feeds
PIECE = re.compile("\n|'(?:s|t|re|ve|m|ll|d)|[a-z\u00aa\u00b5\u00ba\u00df-\u00f6\u00f8-\u017f]+|[0-9\u00b2\u00b3\u00b9\u00bc-\u00be]|[^\na-z0-9\u00aa\u00b2\u00b3\u00b5\u00b9\u00ba\u00bc-\u00be\u00df-\u00f6\u00f8-\u017f]+")
SHOWN = {*range(33, 127), *range(161, 173), *range(174, 256)}
#: byte-level alphabet: bytes without a visible character take the code points from 256 on, in order
HIDDEN = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in SHOWN)}
ALPHABET = np.array([HIDDEN.get(b, b) for b in range(256)], "<u2")
TOKENIZER = "word_bpe_49k.json"
#: so many new pieces are encoded as one text
MANY = 100


def shown(text: str) -> str:
    """The text's bytes in the byte-level alphabet."""
    return ALPHABET[np.frombuffer(text.encode(), np.uint8)].tobytes().decode("utf-16-le")


class _Pieces(blocks.Numbers):
    """Pieces by number, and their ids; pieces are numbered as they are met and encoded by ``learn``. Line feeds, number 0, have none."""

    def __init__(self, model):
        super().__init__()
        self.tokenize = model.tokenize
        # the model alone, on pieces between line feeds, which are no part of any
        self.bare = Tokenizer(model)
        self.bare.pre_tokenizer = Split(chr(HIDDEN[10]), "isolated")
        self.between = [t.id for t in model.tokenize(chr(HIDDEN[10]))]
        #: the pieces' ids behind each other, where each begins, and how many it has
        self.ids, self.starts, self.sizes = np.zeros(0, "<u2"), np.zeros(1, np.int32), np.zeros(1, np.int32)
        self["\n"] = 0

    def learn(self) -> None:
        new = [*islice(reversed(self), len(self) - len(self.sizes))][::-1]
        if not new:
            return
        if len(new) < MANY or len(self.between) != 1:
            found = [[t.id for t in self.tokenize(shown(p))] for p in new]
            ids, sizes = [i for x in found for i in x], [len(x) for x in found]
        else:
            ids = np.array(self.bare.encode_batch_fast([shown("\n".join([*new, ""]))], add_special_tokens=False)[0].ids)
            sizes = np.diff(np.flatnonzero(ids == self.between[0]), prepend=-1) - 1
            ids = ids[ids != self.between[0]]
        sizes = np.asarray(sizes, np.int32)
        self.starts = np.concatenate((self.starts, len(self.ids) + np.cumsum(sizes, dtype=np.int32) - sizes))
        self.sizes = np.concatenate((self.sizes, sizes))
        self.ids = np.concatenate((self.ids, np.array(ids, "<u2")))


def spread(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The stretches of the values behind each other."""
    at = np.repeat(starts - (np.cumsum(sizes, dtype=np.int32) - sizes), sizes)
    at += np.arange(len(at), dtype=np.int32)
    return values[at]


class Encoder:
    """Ids of whole texts; equal to the tokenizer's, which never joins across white space.

    Arrow splits the texts and numbers their chunks, and each distinct chunk of
    the texts given is encoded once. Plain chunks are cut into pieces, all at
    once, and the tokenizer's model encodes each piece that is not remembered;
    any other chunk goes through the whole tokenizer, and is remembered as well.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.pieces = _Pieces(self.tokenizer.model)
        self.odd: dict[str, np.ndarray] = {}

    def odd_chunk(self, chunk: str) -> np.ndarray:
        if chunk not in self.odd:
            self.odd[chunk] = np.array(self.tokenizer.encode(chunk, add_special_tokens=False).ids, "<u2")
        return self.odd[chunk]

    def chunks(self, items: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The chunks' ids behind each other, and how many each has."""
        if len(self.pieces) > REMEMBERED:
            self.pieces = _Pieces(self.tokenizer.model)
        if len(self.odd) > REMEMBERED:
            self.odd = {}
        # a line feed behind each chunk
        line, odd = (pc.binary_join(pa.ListArray.from_arrays([0, len(items)], items), pa.scalar("\n", items.type))[0].as_py() + "\n" if len(items) else ""), {}
        # a special token is matched before the case is folded
        if "<|" in line or PLAIN.search(line):
            listed = line.split("\n")[:-1]
            odd = {i: self.odd_chunk(c) for i, c in enumerate(listed) if "<|" in c or PLAIN.search(c)}
            line = "\n".join([*("" if i in odd else c for i, c in enumerate(listed)), ""])
        found = PIECE.findall(line.lower())
        number = np.fromiter(map(self.pieces.__getitem__, found), np.int32, len(found))
        self.pieces.learn()
        size = self.pieces.sizes[number]
        ids = spread(self.pieces.ids, self.pieces.starts[number], size)
        sizes = np.diff(np.cumsum(size, dtype=np.int32)[number == 0], prepend=np.int32(0))
        if odd:
            at, more = np.cumsum(sizes) - sizes, [len(x) for x in odd.values()]
            ids = np.insert(ids, np.repeat(at[[*odd]], more), np.concatenate([*odd.values()]))
            sizes[[*odd]] = more
        return ids, sizes

    def joined(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The texts' ids behind each other, the end id behind each, and how many each has."""
        # these two are white space to Arrow alone
        plain = not any("\x0b" in t or "\x0c" in t for t in texts)
        column = pa.array(texts, pa.large_string())
        words = pc.ascii_split_whitespace(column) if plain else pc.split_pattern_regex(column, BLANK)
        coded = words.flatten().dictionary_encode()
        ids, sizes = self.chunks(coded.dictionary)
        # the end is one chunk more, behind each text's
        ids, sizes = np.append(ids, np.uint16(END_ID)), np.append(sizes, np.int32(1))
        starts, n = np.cumsum(sizes, dtype=np.int32) - sizes, np.diff(words.offsets.to_numpy())
        code = np.insert(coded.indices.to_numpy(), np.cumsum(n), len(sizes) - 1)
        size = sizes[code]
        return spread(ids, starts[code], size), np.add.reduceat(size, np.cumsum(n + 1) - n - 1)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if not texts:
            return []
        ids, sizes = self.joined(texts)
        return np.split(ids, np.cumsum(sizes)[:-1])


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per worker process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def counted(doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(terms, how often) of a document."""
    s = np.sort(doc, kind="stable")
    edge = np.ones(len(s) + 1, bool)
    np.not_equal(s[1:], s[:-1], out=edge[1:-1])
    at = edge.nonzero()[0]
    return s[at[:-1]], at[1:] - at[:-1]


def counted_all(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(documents, terms, how often), in this order, of documents together."""
    sizes = [len(d) for d in docs]
    key = np.repeat(np.arange(len(docs), dtype=np.uint32 if len(docs) < 1 << 16 else np.uint64) << 16, sizes)
    key |= np.concatenate(docs)
    key.sort()
    edge = np.ones(len(key) + 1, bool)
    np.not_equal(key[1:], key[:-1], out=edge[1:-1])
    at = edge.nonzero()[0]
    key = key[at[:-1]]
    return (key >> 16).astype(np.int64), (key & 0xFFFF).astype(np.int64), at[1:] - at[:-1]


class Corpus:
    """What BM25 takes from all documents: documents per term, their number and mean length."""

    def __init__(self, df: np.ndarray, n: int, tokens: int):
        self.df, self.mean = df, tokens / max(n, 1)
        self.idf = np.log(1 + (n - df + 0.5) / (df + 0.5)).astype(np.float32)

    def weight(self, terms: np.ndarray, tfs: np.ndarray, sizes: np.ndarray | int) -> np.ndarray:
        norm = K1 * (1 - B + B * sizes / self.mean)
        return (self.idf[terms] * tfs * (K1 + 1) / (tfs + norm)).astype(np.float32)

    def prefixes(self, doc: np.ndarray) -> list[str]:
        """The strongest terms that another document has too: the first, the first two and so on."""
        return self.prefixes_of([doc])[0]

    def prefixes_of(self, docs: list[np.ndarray]) -> list[list[str]]:
        if not docs:
            return []
        doc, terms, tfs = counted_all(docs)
        shared = self.df[terms] > 1
        doc, terms, tfs = doc[shared], terms[shared], tfs[shared]
        w = self.weight(terms, tfs, np.array([len(d) for d in docs])[doc])
        ends = np.searchsorted(doc, np.arange(len(docs) + 1)).tolist()
        # those that may be among the strongest, equal ones included
        least = np.array([np.partition(w[a:b], -DEPTH)[-DEPTH] if b - a > DEPTH else -np.inf for a, b in zip(ends, ends[1:])])
        best = np.flatnonzero(w >= least[doc])
        best = best[np.lexsort((terms[best], -w[best], doc[best]))]
        ends, terms, out = np.searchsorted(doc[best], np.arange(len(docs) + 1)).tolist(), list(map(str, terms[best].tolist())), []
        for a, b in zip(ends, ends[1:]):
            out.append(list(accumulate(terms[a : min(b, a + DEPTH)], "{}.{}".format)) or [""])
        return out


class Index:
    """BM25 inverted index of a shard; without the figures of a corpus, the shard is the corpus."""

    def __init__(self, docs: list[np.ndarray], corpus: Corpus | None = None):
        terms, tfs, sizes = [], [], np.array([len(d) for d in docs])
        for d in docs:
            t, n = counted(d)
            terms.append(t)
            tfs.append(n)
        self.ends = np.cumsum([len(t) for t in terms])
        term, tf = np.concatenate(terms), np.concatenate(tfs).astype(np.float32)
        doc = np.repeat(np.arange(len(docs), dtype=np.int32), [len(t) for t in terms])
        df = np.bincount(term, minlength=1 << 16)
        corpus = corpus or Corpus(df, len(docs), int(sizes.sum()))
        weight = corpus.weight(term, tf, sizes[doc])
        self.term = term
        order = np.argsort(term, kind="stable")
        self.docs, self.weights = doc[order], weight[order]
        self.first = np.concatenate(([0], np.cumsum(df)))
        self.used = np.zeros(len(docs), bool)
        self.n = len(docs)
        # terms in over an eighth of the documents: their weights as whole rows, at most 8 times the index
        common = np.flatnonzero(df > len(docs) / 8)
        self.row = np.full(1 << 16, -1, np.int32)
        self.row[common] = np.arange(len(common))
        self.rows = np.zeros((len(common), len(docs)), np.float32)
        for i, t in enumerate(common.tolist()):
            a, b = self.first[t], self.first[t + 1]
            self.rows[i, self.docs[a:b]] = self.weights[a:b]

    def neighbours(self, seed: int) -> np.ndarray:
        """Unused documents by falling score for the terms of the seed."""
        lo, hi = (self.ends[seed - 1] if seed else 0), self.ends[seed]
        terms = self.term[lo:hi].astype(np.int64)
        row = self.row[terms]
        score = np.add.reduce(self.rows[row[row >= 0]], axis=0)
        begin, end = self.first[terms], self.first[terms + 1]
        rest = (row < 0) & (end - begin > 1)  # a term of the seed alone finds nothing
        begin, size = begin[rest], end[rest] - begin[rest]
        at = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())
        # one after the other, in the terms' order
        np.add.at(score, self.docs[at], self.weights[at])
        score[self.used] = 0
        found = np.flatnonzero(score)
        return found[np.argsort(-score[found], kind="stable")]


def fill(docs: list[np.ndarray], window: int = WINDOW, corpus: Corpus | None = None) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset): a shard's pieces, windows full but for the last."""
    index, sizes = Index(docs, corpus), [len(d) for d in docs]
    out: list[tuple[int, int, int, int, int]] = []
    used, seed, begun, seq = index.used, 0, 0, 0
    current: int | None = None  # a document cut by the last window
    while True:
        if current is None:
            while seed < len(docs) and used[seed]:
                seed += 1
            if seed == len(docs):
                break
            current, begun = seed, 0
            used[seed] = True
        free, queue = window, [current]
        while free and queue:
            d = queue.pop(0)
            at = begun if d == current else 0
            if d != current and used[d]:
                continue
            used[d] = True
            n = min(free, sizes[d] - at)
            out.append((d, at, n, seq, window - free))
            free -= n
            if at + n < sizes[d]:
                current, begun = d, at + n
                break
            current = None if d == current else current
            if not queue and free:
                # the next look-up is by the document placed last; without a match the next seed follows
                queue = [x for x in index.neighbours(d).tolist()]
                if not queue:
                    while seed < len(docs) and used[seed]:
                        seed += 1
                    queue = [seed] if seed < len(docs) else []
        else:
            current = None
        seq += 1
    return out


def cut_tail(pieces: list[tuple[int, int, int, int, int]], window: int = WINDOW) -> list[tuple[int, int, int, int, int]]:
    """The last sequence, if it is not full, as sequences of powers of two."""
    if not pieces:
        return pieces
    last = pieces[-1][3]
    at = len(pieces)
    while at and pieces[at - 1][3] == last:
        at -= 1
    tail, total = pieces[at:], sum(p[2] for p in pieces[at:])
    if total == window:
        return pieces
    out, seq, size, filled = pieces[:at], last, 1 << (total.bit_length() - 1), 0
    for d, start, n, _, _ in tail:
        while n:
            k = min(n, size - filled)
            out.append((d, start, k, seq, filled))
            start, n, filled, total = start + k, n - k, filled + k, total - k
            if filled == size and total:
                seq, filled, size = seq + 1, 0, 1 << (total.bit_length() - 1)
    return out


SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def together(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    """Batches that follow each other, about ``CHARS`` bytes of text in all, without empty ones."""
    held, size = [], 0
    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        size += pc.sum(pc.binary_length(b.column("text"))).as_py() or 0
        if size >= CHARS:
            yield held
            held, size = [], 0
    if held:
        yield held


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, h, size, ids): every row's tokens as little-endian 16-bit numbers, and its bytes of text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in together(batches):
            texts = [x or "" for b in held for x in b.column("text").to_pylist()]
            ids, sizes = encoder(path).joined(texts)
            ends = 2 * np.cumsum(np.concatenate(([0], sizes)))
            made = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(texts), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(ids)])
            lo = 0
            for b in held:
                columns = [b.column("doc_id"), b.column("h"), b.column("size"), made.slice(lo, b.num_rows).cast(pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "h", "size", "ids"])
                lo += b.num_rows

    # rows without a doc_id have nothing but their place to tell equal texts apart
    place = F.coalesce("doc_id", F.monotonically_increasing_id())
    hashed = F.xxhash64(F.lit("pack"), place, F.col("text"))
    size = (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long")
    rows = text_rows(docs).withColumn("h", hashed).withColumn("size", size)
    return rows.mapInArrow(run, "doc_id long, h long, size long, ids binary")


def tokens_of(column: pa.Array) -> Iterator[np.ndarray]:
    for x in column:
        yield np.frombuffer(x.as_py(), "<u2")


def corpus_of(made: DataFrame) -> Corpus:
    """Figures of all documents; a row per term of the vocabulary reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n, tokens = np.zeros(1 << 16, np.int64), 0, 0
        for b in batches:
            if b.num_rows:
                docs = list(tokens_of(b.column("ids")))
                df += np.bincount(counted_all(docs)[1], minlength=1 << 16)
                n, tokens = n + len(docs), tokens + sum(map(len, docs))
        at = np.flatnonzero(df)
        columns = [pa.array([*at.tolist(), -1, -2], pa.int32()), pa.array([*df[at].tolist(), n, tokens], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["term", "n"])

    found = made.select("ids").mapInArrow(run, "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))
    counts = {r.term: r.n for r in found.collect()}
    df = np.zeros(1 << 16, np.int64)
    for t, n in counts.items():
        if t >= 0:
            df[t] = n
    return Corpus(df, counts.get(-1, 0), counts.get(-2, 0))


def dealt(made: DataFrame, corpus: Corpus, shard_bytes: int) -> DataFrame:
    """Rows with their shard; what reaches the driver is a row per key with more than a shard of text."""

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = corpus.prefixes_of(list(tokens_of(b.column("ids"))))
            yield pa.RecordBatch.from_arrays([b.column("size"), pa.array(found, pa.list_(pa.string()))], ["size", "prefixes"])

    keyed = saved(made.select("size", "ids").mapInArrow(prefixes, "size long, prefixes array<string>"))
    sizes = keyed.select("size", F.explode("prefixes").alias("prefix")).groupBy("prefix").agg(F.sum("size").alias("size"))
    hot = {r.prefix for r in sizes.where(F.col("size") > shard_bytes).select("prefix").collect()}

    def below(found: list[str]) -> tuple[str, str | None]:
        """The longest prefix that is too big, and the next one, if there is one."""
        deep = sum(p in hot for p in found)  # what is above one that is too big is too big as well
        return (found[deep - 1] if deep else "root"), (found[deep] if deep < len(found) else None)

    def parents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, int] = {}
        for b in batches:
            for found, size in zip(b.column("prefixes").to_pylist(), b.column("size").to_pylist()):
                at = below(found)[0]
                total[at] = total.get(at, 0) + size
        columns = [pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["parent", "size"])

    totals = keyed.select("prefixes", "size").mapInArrow(parents, "parent string, size long")
    bins, first = {}, 0
    for r in totals.groupBy("parent").agg(F.sum("size").alias("size")).orderBy("parent").collect():
        bins[r.parent] = (first, -(-r.size // shard_bytes))
        first += bins[r.parent][1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            shards = []
            for found, h in zip(corpus.prefixes_of(list(tokens_of(b.column("ids")))), b.column("h").to_pylist()):
                parent, key = below(found)
                lo, n = bins[parent]
                shards.append(lo + (h if key is None else zlib.crc32(key.encode())) % n)
            columns = [b.column("doc_id"), b.column("h"), b.column("ids"), pa.array(shards, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "h", "ids", "shard"])

    return made.mapInArrow(place, "doc_id long, h long, ids binary, shard long")


def packed(docs: DataFrame, tokenizer: str | None = None, window: int = WINDOW, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per piece (the columns of ``SCHEMA``)."""
    prepare(docs.sparkSession)
    made = saved(encoded(docs, tokenizer or public_tokenizers.path(TOKENIZER)))
    corpus = corpus_of(made)

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by([("doc_id", "ascending"), ("h", "ascending")])
        ids, shard = t.column("doc_id").to_pylist(), t.column("shard")[0].as_py()
        tokens = list(tokens_of(t.column("ids")))
        pieces = cut_tail(fill(tokens, window, corpus), window)
        d, start, n, seq, offset = (np.array(x, np.int64) for x in zip(*pieces))
        crc = [zlib.crc32(tokens[i][a : a + k].astype("<u4").tobytes()) for i, a, k, _, _ in pieces]
        total = np.array([len(x) for x in tokens], np.int64)
        columns = [pa.array(ids, pa.int64()).take(pa.array(d)), start, n, crc, total[d], (shard << 32) + seq, offset]
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        return pa.table({k: c if isinstance(c, pa.Array) else pa.array(c, pa.int64()) for k, c in zip(names, columns)})

    return dealt(made, corpus, shard_bytes).groupBy("shard").applyInArrow(run, SCHEMA)


def query(docs: DataFrame) -> DataFrame:
    return packed(docs)
