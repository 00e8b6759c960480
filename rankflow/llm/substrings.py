"""Removal of repeated byte strings by a sharded, hash-compared suffix sort.

A byte goes when a string of ``LENGTH`` bytes that covers it also starts
anywhere else, in the same document or another. Matches never cross documents.

1. Anchors. Of the 128-byte grams of a string, the one with the least hash is
   its anchor, so equal strings share an anchor at the same place. The starts
   that share an anchor occurrence form a range of neighbours; the range and
   the bytes it reaches are its context. Only a key (the gram's hash), the
   context's hash and its place leave a document: one row per 140 bytes or so.
2. Contexts that occur twice as a whole are repeated at every start. Contexts
   whose anchor never recurs hold no repeat. Only the rest, at the edges of
   repeats, are fetched, one representative for each distinct context.
3. The rest is dealt by anchor into shards. In a shard the suffixes from the
   anchors, and the reversed prefixes before them, are sorted by mergesort;
   two are compared by their longest common extension, found by binary search
   over prefix polynomial hashes. Neighbours in both orders bound how far a
   context is shared to either side; where one partner reaches both bounds
   these are the repeats, otherwise the starts in between are looked up by
   their own hashes. Matches of this step are verified on their bytes; step 2
   decides by two 62-bit hashes of whole contexts.
   An anchor with over ``HOT`` distinct contexts does not enter a shard: its
   strings are grouped by a 128-bit digest instead, which Spark adds up before
   the shuffle.

Defined results: a null text counts as empty bytes; a text shorter than
``LENGTH`` is kept whole; repeated rows are copies of each other, each with a
row of its own, also without a doc_id; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankflow.llm.common import digest, prepare, runs, saved, text_rows

LENGTH, GRAM = 400, 128
#: distinct contexts of one anchor, and of a shard
HOT, SHARD = 4_000, 3_000
#: bytes hashed at a time, so that the arrays stay in the cache (a longer text is a block of its own)
BLOCK = 192 << 10
PRIME = np.uint64((1 << 31) - 1)
BASES = (1_103_515_245, 1_566_083_941)


def _fold(x: np.ndarray) -> np.ndarray:
    """x mod 2^31 - 1 for x below 2^63."""
    high = x >> np.uint64(31)
    x = x & PRIME
    x += high
    np.right_shift(x, np.uint64(31), out=high)
    x &= PRIME
    x += high
    x -= (x >= PRIME) * PRIME
    return x


class _Powers:
    """Powers of the bases and of their inverses, made longer when needed."""

    def __init__(self) -> None:
        self.of = {b: np.ones(1, np.uint64) for base in BASES for b in (base, pow(base, -1, int(PRIME)))}

    def get(self, base: int, n: int) -> np.ndarray:
        have = self.of[base]
        while len(have) < n:
            have = np.concatenate((have, _fold(have * np.uint64(pow(base, len(have), int(PRIME))))))
        self.of[base] = have
        return have[:n]


_POWERS = _Powers()


class Prefixes:
    """Prefix polynomial hashes of a buffer; the hash of any piece in constant time."""

    def __init__(self, buf: np.ndarray):
        self.sums, self.inverse = [], []
        for base in BASES:
            terms = _fold((buf.astype(np.uint64) + np.uint64(1)) * _POWERS.get(base, len(buf)))
            sums = np.zeros(len(buf) + 1, np.uint64)
            np.cumsum(terms, out=sums[1:])
            self.sums.append(_fold(sums))
            self.inverse.append(_POWERS.get(pow(base, -1, int(PRIME)), len(buf) + 1))

    def one(self, which: int, at: np.ndarray, end: np.ndarray) -> np.ndarray:
        s = self.sums[which]
        return _fold((s[end] + PRIME - s[at]) * self.inverse[which][at])

    def both(self, at: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.one(0, at, end) << np.uint64(31)) | self.one(1, at, end)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def anchors(buf: np.ndarray, first: np.ndarray, size: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """Of texts laid end to end: (text, start, span, lead, key, context, more) per anchor occurrence.

    The strings that start at start .. start + span share the gram at
    start + lead. In a periodic stretch the next occurrence with the same
    context follows at once: it is one row, which ``more`` others follow.
    """
    none = tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.int64, np.uint64, np.uint64, np.int64))
    n, width = len(buf), length - gram + 1
    if n < length:
        return none
    pre = Prefixes(buf)
    s = pre.sums[0]
    grams = _fold((s[gram:] + PRIME - s[:-gram]) * pre.inverse[0][: n - gram + 1])
    key = (_mix(grams) & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    # least key of every ``width`` grams in a row, from running minima within blocks of that size
    pad = -len(key) % width
    blocks = np.concatenate((key, np.full(pad, np.uint64(0xFFFFFFFFFFFFFFFF)))).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = n - length + 1
    at = (np.minimum(behind[:starts], ahead[width - 1 : width - 1 + starts]) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    text = np.repeat(np.arange(len(size)), size)
    ok = (np.repeat(first + size, size) - np.arange(n) >= length)[:starts]
    where = np.flatnonzero(ok)
    if not len(where):
        return none
    own, text = at[where], text[where]
    new = np.flatnonzero(np.concatenate(([True], (own[1:] != own[:-1]) | (text[1:] != text[:-1]))))
    last = np.append(new[1:], len(where)) - 1
    a, b, p = where[new], where[last], own[new]
    keys = _mix(pre.both(p, p + gram))
    whole = _mix(pre.both(a, b + length)) ^ _mix(((p - a).astype(np.uint64) << np.uint64(32)) | (b - a).astype(np.uint64))
    text = text[new]
    follows = np.zeros(len(new), bool)
    follows[1:] = (text[1:] == text[:-1]) & (whole[1:] == whole[:-1]) & (keys[1:] == keys[:-1]) & (a[1:] == b[:-1] + 1)
    head = np.flatnonzero(~follows)
    more = np.diff(np.append(head, len(new))) - 1
    return tuple(x[head] for x in (text, a - first[text], b - a, p - a, keys, whole)) + (more,)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[bytes]]]:
    """Rows and texts (as bytes), about ``BLOCK`` bytes at a time."""
    rows, texts, total = [], [], 0
    for b in batches:
        col, rest = b.column("text"), [b.column(i).to_pylist() for i in range(b.num_columns) if b.schema.names[i] != "text"]
        for i, row in enumerate(zip(*rest)):
            t = (col[i].as_py() or "").encode()
            if texts and total + len(t) > BLOCK:
                yield rows, texts
                rows, texts, total = [], [], 0
            rows.append(row)
            texts.append(t)
            total += len(t)
    if texts:
        yield rows, texts


def occurrences(rows: DataFrame, length: int = LENGTH) -> DataFrame:
    """Step 1 over (doc_id, th, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for who, texts in _blocks(batches):
            size = np.array([len(t) for t in texts])
            text, start, span, lead, key, whole, more = anchors(
                np.frombuffer(b"".join(texts), np.uint8), np.cumsum(size) - size, size, length
            )
            ids, th = pa.array([w[0] for w in who], pa.int64()), pa.array([w[1] for w in who], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(key.view(np.int64)), pa.array(whole.view(np.int64)), ids.take(pa.array(text)), th.take(pa.array(text)),
                    pa.array(start.astype(np.int32)), pa.array(span.astype(np.int16)), pa.array(lead.astype(np.int16)),
                    pa.array(more.astype(np.int32)),
                ],
                ["key", "whole", "doc_id", "th", "start", "span", "lead", "more"],
            )

    return rows.select("doc_id", "th", "text").mapInArrow(
        run, "key long, whole long, doc_id long, th long, start int, span short, lead short, more int"
    )


def extension(pre: Prefixes, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Length of the longest common extension of i and j, ``most`` at most, by binary search on hashes."""
    lo, hi = np.zeros(len(i), np.int64), most.astype(np.int64).copy()
    while np.any(open_ := lo < hi):
        mid = (lo + hi + 1) >> 1
        same = pre.both(i, i + mid) == pre.both(j, j + mid)
        lo = np.where(open_ & same, mid, lo)
        hi = np.where(open_ & ~same, mid - 1, hi)
    return lo


def merge_sort(n: int, before: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """The numbers below n in the order of ``before`` (strict), bottom up; all merges of a level at once."""
    order, width, at = np.arange(n), 1, np.arange(n)
    while width < n:
        run = at // width
        left = run % 2 == 0
        other = np.where(left, (run + 1) * width, (run - 1) * width)
        lo, hi = np.minimum(other, n), np.minimum(other + width, n)
        base = lo.copy()
        while np.any(open_ := lo < hi):
            mid = (lo + hi) >> 1
            k = np.flatnonzero(open_)
            x, y = order[k], order[mid[k]]
            # of equal ones the left run's come first
            y_first = np.where(left[k], before(y, x), ~before(x, y))
            lo[k] = np.where(y_first, mid[k] + 1, lo[k])
            hi[k] = np.where(y_first, hi[k], mid[k])
        start = at - at % width
        place = np.where(left, start, start - width) + (at - start) + (lo - base)
        new = np.empty(n, np.int64)
        new[place] = order
        order, width = new, width * 2
    return order


def suffix_order(buf: np.ndarray, pre: Prefixes, at: np.ndarray, size: np.ndarray, group: np.ndarray):
    """Order of the pieces (at, size) by group and then bytes, and each one's extension to the one before."""

    def before(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        most = np.minimum(size[x], size[y])
        same = group[x] == group[y]
        n = extension(pre, at[x], at[y], np.where(same, most, 0))
        end = n == most
        cx, cy = (buf[np.minimum(at[k] + n, len(buf) - 1)] for k in (x, y))
        return np.where(same, np.where(end, size[x] < size[y], cx < cy), group[x] < group[y])

    order = merge_sort(len(at), before)
    shared = np.zeros(len(at), np.int64)
    x, y = order[1:], order[:-1]
    shared[1:] = extension(pre, at[x], at[y], np.where(group[x] == group[y], np.minimum(size[x], size[y]), 0))
    return order, shared


def shared_starts(contexts: list[bytes], lead: np.ndarray, span: np.ndarray, group: np.ndarray, wanted: np.ndarray, length: int = LENGTH):
    """(context, lo, hi) ranges of starts that recur in another context of the same group, for the wanted contexts.

    The contexts of a group are distinct and hold their common gram at ``lead``.
    """
    n = len(contexts)
    size = np.array([len(c) for c in contexts], np.int64)
    first = np.cumsum(size) - size
    buf = np.frombuffer(b"".join(contexts), np.uint8)
    total = len(buf)
    pre, back = Prefixes(buf), Prefixes(np.ascontiguousarray(buf[::-1]))
    right_at, right_n = first + lead, size - lead
    left_at, left_n = total - (first + lead), lead.copy()
    left_buf = np.ascontiguousarray(buf[::-1])
    partners: list[list[np.ndarray]] = []
    reach = []
    for b, p, at, most in ((buf, pre, right_at, right_n), (left_buf, back, left_at, left_n)):
        order, shared = suffix_order(b, p, at, most, group)
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        prev, nxt = order[np.maximum(place - 1, 0)], order[np.minimum(place + 1, n - 1)]
        up, down = shared[place], np.append(shared, 0)[place + 1]
        reach.append(np.maximum(up, down))
        partners += [prev, nxt]
    right, left = reach
    # a start that is d before the anchor recurs only if d <= left and length - d <= right
    lo = np.maximum(np.maximum(length - right, lead - span), 0)
    hi = np.minimum(left, lead)
    open_ = np.flatnonzero(wanted & (lo <= hi))
    found: list[tuple[int, int, int]] = []
    unresolved: list[int] = []
    if not len(open_):
        return found
    mine: dict[int, list[tuple[int, int]]] = {i: [] for i in open_.tolist()}
    for other in partners:
        j = other[open_]
        ok = (group[j] == group[open_]) & (j != open_)
        i, j = open_[ok], j[ok]
        r = extension(pre, right_at[i], right_at[j], np.minimum(right_n[i], right_n[j]))
        l_ = extension(back, left_at[i], left_at[j], np.minimum(left_n[i], left_n[j]))
        for x, y, a, b in zip(i.tolist(), j.tolist(), l_.tolist(), r.tolist()):
            if a + b < length:
                continue
            cx, cy, px, py = contexts[x], contexts[y], int(lead[x]), int(lead[y])
            if cx[px - a : px + b] != cy[py - a : py + b]:  # hashes collided: count the equal bytes instead
                b = next((k for k in range(b) if cx[px + k] != cy[py + k]), b)
                a = next((k for k in range(a) if cx[px - 1 - k] != cy[py - 1 - k]), a)
            if a + b >= length:
                mine[x].append((max(length - b, 0), a))
    for x, parts in mine.items():
        at, end = int(lo[x]), int(hi[x])
        for a, b in sorted(parts):
            if a > at:
                break
            at = max(at, b + 1)
        for a, b in parts:
            found.append((x, int(lead[x]) - min(b, end), int(lead[x]) - max(a, int(lo[x]))))
        if at <= end:
            unresolved.append(x)
    if unresolved:
        found += _by_windows(contexts, pre, first, lead, span, group, np.array(unresolved), lo, hi, length)
    return [(x, a, b) for x, a, b in found if a <= b]


def _by_windows(contexts, pre, first, lead, span, group, ask, lo, hi, length):
    """Exact ranges of the contexts ``ask``: every start in doubt is looked up by its hash among the group's strings."""
    found = []
    for g in np.unique(group[ask]):
        own = np.flatnonzero(group == g)
        asked = ask[group[ask] == g]
        d_lo, d_hi = int(lo[asked].min()), int(hi[asked].max())
        for d in range(d_lo, d_hi + 1):  # at most ``length`` rounds
            at = own[(lead[own] >= d) & (lead[own] - span[own] <= d)]
            who = asked[(lo[asked] <= d) & (hi[asked] >= d)]
            if len(at) < 2 or not len(who):
                continue
            h = pre.both(first[at] + lead[at] - d, first[at] + lead[at] - d + length)
            order = np.argsort(h, kind="stable")
            hs = h[order]
            same = np.zeros(len(hs), bool)
            same[1:] |= hs[1:] == hs[:-1]
            same[:-1] |= hs[1:] == hs[:-1]
            at_pos = {int(at[k]): pos for pos, k in enumerate(order) if same[pos]}
            for x in who.tolist():
                pos = at_pos.get(x)
                if pos is None:
                    continue
                mine = contexts[x][lead[x] - d : lead[x] - d + length]
                a, b = np.searchsorted(hs, hs[pos], "left"), np.searchsorted(hs, hs[pos], "right")
                if any(y != x and contexts[y][lead[y] - d : lead[y] - d + length] == mine for y in at[order[a:b]].tolist()):
                    found.append((x, int(lead[x]) - d, int(lead[x]) - d))
    return found


CONTEXT = "key long, whole long, n long, doc_id long, th long, start int, span short, lead short, bytes binary"
RANGE = "doc_id long, th long, lo int, hi int"


def _contexts(rows: DataFrame, chosen: DataFrame, length: int) -> DataFrame:
    """The chosen contexts with their bytes."""
    per_text = chosen.groupBy("doc_id", "th").agg(
        F.collect_list(F.struct("key", "whole", "n", "start", "span", "lead")).alias("items")
    )
    hit = rows.alias("r").join(
        per_text.alias("c"), F.col("r.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("r.th") == F.col("c.th"))
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for i in range(b.num_rows):
                data = b.column("text")[i].as_py().encode()
                for x in b.column("items")[i].as_py():
                    piece = data[x["start"] : x["start"] + x["span"] + length]
                    out.append(x | {"doc_id": b.column("doc_id")[i].as_py(), "th": b.column("th")[i].as_py(), "bytes": piece})
            names = [c.split()[0] for c in CONTEXT.split(", ")]
            types = [pa.int64()] * 5 + [pa.int32(), pa.int16(), pa.int16(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array([o[c] for o in out], t) for c, t in zip(names, types)], names)

    return hit.select("r.doc_id", "r.th", "r.text", "c.items").mapInArrow(cut, CONTEXT)


def _sorted_ranges(contexts: DataFrame, shards: int, length: int) -> DataFrame:
    """Step 3 for the anchors that fit a shard."""

    def run(t: pa.Table) -> pa.Table:
        key, whole = t.column("key").to_numpy(), t.column("whole").to_numpy()
        # repeated rows of the input send the same context again
        _, once = np.unique(np.stack((key, whole)), axis=1, return_index=True)
        t, key = t.take(pa.array(once)), key[once]
        lead, span = (t.column(c).to_numpy().astype(np.int64) for c in ("lead", "span"))
        _, group = np.unique(key, return_inverse=True)
        found = shared_starts(t.column("bytes").to_pylist(), lead, span, group, t.column("n").to_numpy() == 1, length)
        at = pa.array([f[0] for f in found], pa.int64())
        start = t.column("start").to_numpy().astype(np.int64)
        lo, hi = ([int(start[f[0]]) + f[k] for f in found] for k in (1, 2))
        return pa.table({
            "doc_id": t.column("doc_id").take(at), "th": t.column("th").take(at),
            "lo": pa.array(lo, pa.int32()), "hi": pa.array([h + length for h in hi], pa.int32()),
        })

    dealt = contexts.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int"))
    return dealt.groupBy("shard").applyInArrow(run, RANGE)


def _digest_ranges(contexts: DataFrame, length: int) -> DataFrame:
    """Step 3 for anchors with very many contexts: strings grouped by digest, added up before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                whats = [hashlib.md5(r["bytes"][i : i + length]).digest() for i in range(r["span"] + 1)]
                m = len(whats)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(whats, pa.binary()), pa.array([r["whole"]] * m, pa.int64()), pa.array([r["n"]] * m, pa.int64()),
                     pa.array([r["doc_id"]] * m, pa.int64()), pa.array([r["th"]] * m, pa.int64()),
                     pa.array(range(r["start"], r["start"] + m), pa.int32())],
                    ["what", "whole", "n", "doc_id", "th", "lo"],
                )

    strings = contexts.dropDuplicates(["key", "whole"]).mapInArrow(run, "what binary, whole long, n long, doc_id long, th long, lo int")
    again = strings.groupBy("what").agg(F.count("*").alias("m")).where("m > 1")
    return strings.where("n = 1").join(again, "what").select("doc_id", "th", "lo", (F.col("lo") + length).alias("hi"))


def repeated_ranges(rows: DataFrame, length: int = LENGTH, hot: int = HOT) -> DataFrame:
    """(doc_id, th, lo, hi): byte ranges of (doc_id, th, text) that repeated strings cover, overlaps included."""
    found = occurrences(rows, length)
    times = F.sum(F.col("more") + 1)
    keys = found.groupBy("key").agg(times.alias("rows"), F.min("whole").alias("a"), F.max("whole").alias("b"))
    again = keys.where("rows > 1").select(F.col("key").alias("k"), (F.col("a") != F.col("b")).alias("mixed"))
    back = saved(found.join(again, F.col("key") == F.col("k")).drop("k"))
    whole = (
        back.where("mixed").groupBy("key", "whole")
        .agg(times.alias("n"), F.min(F.struct("doc_id", "th", "start", "span", "lead")).alias("r"))
    )
    whole = saved(whole.select("key", "whole", "n", "r.*"))
    end = (F.col("start") + F.col("span") + F.col("more") * (F.col("span") + 1) + length).cast("int").alias("hi")
    # a context that recurs as a whole is repeated throughout
    sure = back.where("not mixed").select("doc_id", "th", F.col("start").alias("lo"), end)
    twice = whole.where("n > 1").select(F.col("key").alias("k"), F.col("whole").alias("w"))
    sure = sure.union(
        back.where("mixed").join(twice, (F.col("key") == F.col("k")) & (F.col("whole") == F.col("w")))
        .select("doc_id", "th", F.col("start").alias("lo"), end)
    )
    crowded = whole.groupBy(F.col("key").alias("k")).agg(F.count("*").alias("m"))
    contexts = saved(_contexts(rows, whole, length))
    large = saved(crowded.where(F.col("m") > hot).select("k"))
    n = whole.count()
    parts = [sure]
    if large.isEmpty():
        parts.append(_sorted_ranges(contexts, max(1, -(-n // SHARD)), length))
    else:
        parts.append(_sorted_ranges(contexts.join(large, F.col("key") == F.col("k"), "left_anti"), max(1, -(-n // SHARD)), length))
        parts.append(_digest_ranges(contexts.join(large, F.col("key") == F.col("k"), "left_semi"), length))
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def removed(docs: DataFrame, length: int = LENGTH, hot: int = HOT, keep_text: bool = False) -> DataFrame:
    """One row per document: what goes, and the digest (and with ``keep_text`` the bytes) of what stays."""
    prepare(docs.sparkSession)
    rows = text_rows(docs).select("doc_id", F.xxhash64("text").alias("th"), "text")
    ranges = repeated_ranges(rows, length, hot)
    per_text = ranges.groupBy("doc_id", "th").agg(F.collect_set(F.struct("lo", "hi")).alias("cut"))
    hit = rows.alias("r").join(
        per_text.alias("c"), F.col("r.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("r.th") == F.col("c.th")), "left"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for i in range(b.num_rows):
                data = (b.column("text")[i].as_py() or "").encode()
                cut = b.column("cut")[i].values
                n_spans = n_removed = 0
                kept = data
                if cut is not None and len(cut):
                    # numbers only: a monotonous text has a range at every byte
                    lo, hi = (cut.field(c).to_numpy() for c in ("lo", "hi"))
                    edge = np.bincount(lo, minlength=len(data) + 1) - np.bincount(hi, minlength=len(data) + 1)
                    gone = np.cumsum(edge[:-1]) > 0
                    n_spans, n_removed = len(runs(gone)[0]), int(gone.sum())
                    kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
                out.append((b.column("doc_id")[i].as_py(), len(data), n_removed, n_spans, digest(kept), kept if keep_text else b""))
            cols = list(zip(*out)) or [()] * 6
            arrays = [pa.array(c, t) for c, t in zip(cols, [pa.int64()] * 4 + [pa.string(), pa.binary()])]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
            k = 6 if keep_text else 5
            yield pa.RecordBatch.from_arrays(arrays[:k], names[:k])

    return hit.select("r.doc_id", "r.text", "c.cut").mapInArrow(run, SCHEMA + (", kept binary" if keep_text else ""))


def query(docs: DataFrame) -> DataFrame:
    return removed(docs)
