"""Cross-tokenizer alignment: where the tokens of two tokenizers end together.

Tokenizer A is a byte-level BPE read with ``tokenizers``, B a BPE with byte
fallback read with ``sentencepiece``. A's character offsets and the spans of
B's protos are coarse cuts; where a cut falls inside a character (several
tokens share it), and at byte-fallback tokens, the tokens' decoded bytes place
the ends. Decoded bytes must add up to the text.

Neither tokenizer joins a character that is no white space with a space or a
line break after it, nor a Latin letter with a full stop or comma after it
(A's pattern, and no piece of B holds one so; checked when the model is read),
so texts are cut there and a worker remembers how such a chunk aligns. Chunks of over ``LONG`` characters
are not remembered, and at ``REMEMBERED`` chunks those not met since the last
time are forgotten.

How often a pair of ids ends together is counted by Spark over all texts, and
looked up again per block of documents (``blocks``).

Defined results: null and empty texts, and texts that one of the tokenizers
does not give back byte for byte, have no tokens (zeros, empty digest);
repeated rows count and return each; a null ``doc_id`` is kept; an empty table
gives no rows; ties for the best pair all count; other columns are not read.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankflow.llm import blocks as B
from rankflow.llm.common import prepare, saved, text_rows

MODEL_A, MODEL_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
LONG, REMEMBERED = 200, 250_000
#: chunks that are read as one text
TOGETHER = 1000
SPACE = "▁"
#: in front of a space or line break after a character that is no white space, and of a full stop or comma after a Latin letter
CUT = re.compile(r"(?<=\S)(?=[ \n])|(?<=[A-Za-zÀ-ÖØ-öø-ÿ])(?=[.,])")


def byte_level() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Aligner:
    """Both tokenizers, and the chunks met before."""

    def __init__(self, a: str, b: str):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_file(a)
        # their strings in a text are plain text
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b)
        chars = byte_level()
        found = {i: bytes(chars[c] for c in t) for t, i in self.a.get_vocab(with_added_tokens=False).items()}
        self.bytes_a = [found.get(i, b"") for i in range(max(self.a.get_vocab_size(), *found) + 1)]
        self.bytes_b = []
        for i in range(self.b.get_piece_size()):
            piece, fallback = self.b.id_to_piece(i), self.b.is_byte(i)
            self.bytes_b.append(bytes([int(piece[3:5], 16)]) if fallback else piece.replace(SPACE, " ").encode())
            text = piece.replace(SPACE, " ")
            if not fallback and (len(CUT.split(text)) > 1 or ("\n" in text and len(text) > 1)):
                raise ValueError(f"the piece {piece} stands across a cut")
        self.fallback = np.array([self.b.is_byte(i) for i in range(self.b.get_piece_size())])
        # the ids with what stands behind them in the groups' text: inside a group, and at the end of its part
        spelled = [f"{i}{mark}" for n, end in ((len(self.bytes_a), "|"), (len(self.bytes_b), ";")) for i in range(n) for mark in (",", end)]
        self.spelled = pa.array(spelled, pa.large_string())
        self.known: dict[str, tuple | None] = {}
        self.older: dict[str, tuple | None] = {}

    def cuts(self, text: str) -> tuple[np.ndarray, ...] | None:
        """A's ids and the byte offsets at which they end, and B's, of a text that begins with a space; None if either is not the text."""
        raw = text.encode()
        encoding = self.a.encode(text, add_special_tokens=False)
        # B puts the space in front itself
        pieces = self.b.encode(text[1:], return_type="proto").pieces
        ids_a, ids_b = encoding.ids, [p.id for p in pieces]
        parts_a, parts_b = list(map(self.bytes_a.__getitem__, ids_a)), list(map(self.bytes_b.__getitem__, ids_b))
        if b"".join(parts_a) != raw or b"".join(parts_b) != raw:
            return None
        spans = np.array(encoding.offsets, np.int64).reshape(-1, 2)
        ends_a, ends_b = spans[:, 1], np.array([p.end for p in pieces], np.int64) + 1
        if len(raw) != len(text):
            points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
            sizes = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
            # a character that the next token shares, or that is spelled in bytes, is not over yet: decoded bytes tell
            shared = np.append(spans[1:, 0] < spans[:-1, 1], False)
            ends_a = np.where(shared, np.cumsum([len(x) for x in parts_a]), np.cumsum(sizes)[ends_a - 1])
            ends_b = np.where(self.fallback[ids_b], np.cumsum([len(x) for x in parts_b]), ends_b)
        return np.array(ids_a, np.int64), ends_a, np.array(ids_b, np.int64), ends_b

    def aligned(self, chunks: list[str]) -> list[tuple | None]:
        """Per chunk (tokens of A, of B, groups, their text with a semicolon behind each, linked pairs as numbers A * 65536 + B), or None.

        Chunks are read as one text; where that does not come back, in halves.
        """
        if not chunks:
            return []
        # so that no chunk stands where B puts a space in front, and one that follows a letter does so
        lead = " x"
        found = self.cuts(lead + "".join(chunks))
        if found is None:
            half = len(chunks) // 2
            return [None] if not half else self.aligned(chunks[:half]) + self.aligned(chunks[half:])
        ids_a, ends_a, ids_b, ends_b = found
        ends, i, j = np.intersect1d(ends_a, ends_b, assume_unique=True, return_indices=True)
        pairs = (ids_a[i] * 65536 + ids_b[j]).tobytes()
        last = np.searchsorted(ends, np.cumsum([len(lead), *[len(c.encode()) for c in chunks]]), side="right").tolist()
        # tokens of A and B up to each group's start
        i, j = np.concatenate(([0], i + 1)), np.concatenate(([0], j + 1))
        code = np.empty(len(ids_a) + len(ids_b), np.int64)
        code[np.arange(len(ids_a)) + np.repeat(j[:-1], np.diff(i))] = 2 * ids_a
        code[np.arange(len(ids_b)) + np.repeat(i[1:], np.diff(j))] = 2 * (len(self.bytes_a) + ids_b)
        code[i[1:] + j[:-1] - 1] += 1
        code[i[1:] + j[1:] - 1] += 1
        text = self.spelled.take(pa.array(code))
        ends = np.frombuffer(text.buffers()[1], np.int64)[i + j].tolist()
        data, i, j = text.buffers()[2].to_pybytes(), i.tolist(), j.tolist()
        return [
            (i[hi] - i[lo], j[hi] - j[lo], hi - lo, data[ends[lo] : ends[hi]], pairs[8 * lo : 8 * hi])
            for lo, hi in zip(last, last[1:])
        ]

    def remember(self, chunks: set[str]) -> dict[str, tuple | None]:
        """Aligns the chunks that are not remembered; returns the long ones."""
        if len(self.known) > REMEMBERED:
            # what was not met since the last time goes
            self.older, self.known = self.known, {}
        new, passing = [], {}
        for c in chunks:
            if c in self.older:
                self.known[c] = self.older[c]
            else:
                new.append(c)
        # a chunk that ends in white space stands at the end of a text, one without any at its start after a letter
        whole = [c for c in new if not c[-1].isspace() and c[0] in " \n"]
        parts = [whole[lo : lo + TOGETHER] for lo in range(0, len(whole), TOGETHER)] + [[c] for c in new if c[-1].isspace() or c[0] not in " \n"]
        for part in parts:
            for c, found in zip(part, self.aligned(part)):
                (self.known if len(c) <= LONG else passing)[c] = found
        return passing

    def found(self, chunks: Iterable[str]) -> list[tuple | None]:
        """What ``aligned`` gives of each chunk."""
        passing = self.remember({c for c in chunks if c not in self.known})
        known, older = self.known, self.older
        # a block may forget what it needs itself
        return [known[c] if c in known else passing[c] if c in passing else older[c] for c in chunks]

    def block(self, texts: list[str | None]) -> tuple[dict[str, np.ndarray | list[str]], np.ndarray, np.ndarray]:
        """Columns of all texts' figures, the distinct linked pairs, and which of them each link is.

        Figures, groups and pairs are worked out once per distinct chunk and dealt
        to the places where the chunk stands.
        """
        number, at, sizes = B.Numbers(), array("i"), []
        for text in texts:
            chunks = CUT.split(" " + text) if text else []
            at.extend(map(number.__getitem__, chunks))
            sizes.append(len(chunks))
        parts = self.found(number)
        at, sizes = np.array(at, np.int32), np.array(sizes, np.int64)
        # a text with a chunk that does not come back byte for byte has no tokens
        lost = B.sums(np.array([p is None for p in parts], np.int64)[at], sizes) > 0
        at, sizes = at[~np.repeat(lost, sizes)], np.where(lost, 0, sizes)
        parts = [p or (0, 0, 0, b"", b"") for p in parts]
        columns = {c: B.sums(np.array([p[k] for p in parts], np.int64)[at], sizes) for k, c in enumerate(("n_a", "n_b", "n_groups"))}
        # a pair per group
        columns["n_links"], of = columns["n_groups"], np.array([p[2] for p in parts], np.int64)
        groups = pa.array([p[3] for p in parts], pa.large_binary()).take(pa.array(at))
        ends = np.frombuffer(groups.buffers()[1], np.int64)[np.concatenate(([0], np.cumsum(sizes)))].tolist()
        data = memoryview(groups.buffers()[2] or b"")
        columns["groups_sha256"] = [hashlib.sha256(data[lo : hi - 1]).hexdigest() if hi > lo else "" for lo, hi in zip(ends, ends[1:])]
        pairs, place = np.unique(np.frombuffer(b"".join([p[4] for p in parts]), np.int64), return_inverse=True)
        lists = pa.LargeListArray.from_arrays(np.concatenate(([0], np.cumsum(of))), pa.array(place.astype(np.int32)))
        links = lists.take(pa.array(at)).flatten().to_numpy()
        # pairs of texts without tokens only are none
        held = np.bincount(links, minlength=len(pairs)) > 0
        return columns, pairs[held], (np.cumsum(held) - 1).astype(np.int32)[links]

    def documents(self, texts: list[str | None]) -> Iterator[tuple[int, int, int, str, list[int]]]:
        """(n_a, n_b, n_groups, groups_sha256, linked pairs) of each text."""
        columns, pairs, at = self.block(texts)
        ends = [0, *np.cumsum(columns["n_links"]).tolist()]
        linked = pairs[at].tolist()
        for n_a, n_b, n_groups, sha, lo, hi in zip(*(columns[c] for c in ("n_a", "n_b", "n_groups", "groups_sha256")), ends, ends[1:]):
            yield int(n_a), int(n_b), int(n_groups), sha, linked[lo:hi]


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(a: str, b: str) -> Aligner:
    """One per worker process."""
    if (a, b) not in _ALIGNERS:
        _ALIGNERS[a, b] = Aligner(a, b)
    return _ALIGNERS[a, b]


DOCS = ("doc_id", "n_a", "n_b", "n_groups", "n_links")
ROW = (
    "block long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
    "groups_sha256 array<string>, pairs array<long>, times array<long>, at binary"
)


def _encoded(find: Callable[[], Aligner]):
    """One row per block of documents: their figures, the distinct linked pairs, and which of them each document's links are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align = find()
        for block, rows in B.grouped(batches):
            columns, pairs, at = align.block([t for _, t in rows])
            yield pa.RecordBatch.from_pylist([{
                "block": block, "doc_id": [i for i, _ in rows], **columns,
                "pairs": pairs, "times": np.bincount(at, minlength=len(pairs)), "at": B.packed(at),
            }], schema=SCHEMA)

    return run


_LONGS = pa.list_(pa.int64())
SCHEMA = pa.schema([
    ("block", pa.int64()), *[(c, _LONGS) for c in DOCS], ("groups_sha256", pa.list_(pa.string())),
    ("pairs", _LONGS), ("times", _LONGS), ("at", pa.binary()),
])
OUT = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of documents again, with the counts of their links added up."""
    for batch in batches:
        for i in range(batch.num_rows):
            col = {c: batch.column(c)[i] for c in (*DOCS, "groups_sha256", "at", "total", "best")}
            sizes = np.asarray(col["n_links"].values)
            ends = np.concatenate(([0], np.cumsum(sizes)))
            at = B.unpacked(col["at"].as_py(), "int32")
            sums = []
            for c in ("best", "total"):
                of = col[c].values
                of = np.zeros(0, np.int64) if of is None else of.to_numpy(zero_copy_only=False).astype(np.int64)
                run = np.concatenate(([0], np.cumsum(of[at]) if len(at) else []))
                sums.append(pa.array((run[ends[1:]] - run[ends[:-1]]).astype(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [*[col[c].values for c in DOCS], *sums, col["groups_sha256"].values], [*DOCS, "n_best", "count_sum", "groups_sha256"]
            )


def aligned(docs: DataFrame, a: str, b: str) -> DataFrame:
    """Figures of every document's alignment; ``a`` and ``b`` are the tokenizers' files, on every worker."""
    prepare(docs.sparkSession)
    encoded = saved(text_rows(docs).mapInArrow(_encoded(lambda: aligner(a, b)), ROW))
    counts = pair_counts(encoded)
    return _with_counts(encoded, counts)


def pair_counts(encoded: DataFrame) -> DataFrame:
    """(pair, total, best): how many links hold the ids linked, and whether that is the most of the pair's B id."""
    rows = encoded.select(F.inline(F.arrays_zip("pairs", "times")))
    counts = saved(rows.groupBy(F.col("pairs").alias("pair")).agg(F.sum("times").alias("total")))
    most = counts.groupBy((F.col("pair") % 65536).alias("b")).agg(F.max("total").alias("most"))
    found = counts.withColumn("b", F.col("pair") % 65536).join(most, "b")
    return found.select("pair", "total", (F.col("total") == F.col("most")).cast("long").alias("best"))


def _with_counts(encoded: DataFrame, counts: DataFrame) -> DataFrame:
    back = B.looked_up(encoded, "pairs", counts, "pair", ["total", "best"])
    return encoded.select("block", *DOCS, "groups_sha256", "at").join(back, "block", "left").drop("block").mapInArrow(_summed, OUT)


def query(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    return aligned(docs, public_tokenizers.path(MODEL_A), public_tokenizers.path(MODEL_B))
