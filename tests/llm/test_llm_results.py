"""Operators against brute force, exact round trips and held-out accuracy."""

import random
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conftest import SF_MEDIUM, SF_SMALL
from rankflow.llm import chat, graph, kdtree, langid, licenses, mih, mixing, packing, pii, simhash, substrings


def docs(spark, sf=SF_SMALL):
    return spark.read.parquet(f"{sf}/documents.parquet")


# 1


def test_language_accuracy_and_blindness(spark):
    d = docs(spark, SF_MEDIUM)
    found = langid.query(d).join(d.select("doc_id", "lang"), "doc_id").toPandas()
    held = found[found.held_out]
    assert ((held.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 4 == 2))).all()
    assert (held.lang == held.lang_pred).mean() >= 0.97
    assert found.score.between(0, 1).all()
    # labels of held-out rows, and sources, change nothing
    changed = d.withColumn("lang", F.when(langid.held_out(F.col("doc_id")), F.lit("zz")).otherwise(F.col("lang"))).withColumn("source", F.lit("x"))
    again = langid.query(changed).toPandas().set_index("doc_id")
    assert (again.lang_pred == found.set_index("doc_id").lang_pred.reindex(again.index)).all()


def test_word_first_then_shorter_grams():
    model = langid.Model([("en", "house", 5), ("fr", "maison", 5)])
    s = langid.Scorer(model)
    assert s.predict("house")[:2] == ("en", pytest.approx(1.0, abs=0.1))
    assert s.predict("maisonette")[0] == "fr"  # known 4-grams
    assert s.predict("ous")[0] == "en"  # a 3-gram
    assert s.predict("ß")[:2] == ("en", 0.5)  # nothing known: a tie


# 2


def brute_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target, open_ = {}, set(order)
    left = 1.5 * sum(sizes.values())
    while True:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > 2 * sizes[s]}
        if not over:
            return target | {s: left * weight[s] / total for s in open_}
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        open_ -= over


def test_mix_targets_and_copies(spark):
    d = docs(spark, SF_MEDIUM).withColumn("source", F.when(F.col("doc_id") % 3 == 0, "src0").when(F.col("doc_id") % 7 == 0, None).otherwise(F.col("source")))
    found = mixing.query(d).join(d.select("doc_id", "source", "text"), "doc_id").toPandas()
    assert (found["size"] == found.text.map(lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")))).all()
    found["source"] = found.source.where(found.source.notna(), None)
    sizes = {s: 0 for s in set(found.source)}
    for s, n in zip(found.source, found["size"]):
        sizes[s] += n
    want = brute_targets(sizes)
    assert all(abs(t - want[s]) < 1e-6 * want[s] for s, t in zip(found.source, found.target))
    assert all(n == sizes[s] for s, n in zip(found.source, found.source_size))
    taken = {s: 0 for s in sizes}
    for s, n in zip(found.source, found.taken):
        taken[s] += n
    assert all(abs(taken[s] - want[s]) <= max(found["size"].max(), 0.02 * want[s]) for s in sizes)
    assert (found.taken <= 2 * found["size"]).all()
    # the share of documents with the extra copy is the fraction: within four standard deviations
    for s, g in found.groupby("source", dropna=False):
        rate = g.target.iloc[0] / g.source_size.iloc[0]
        extra, p = (g.copies - int(rate)).mean(), rate - int(rate)
        assert set(g.copies - int(rate)) <= {0, 1}
        assert abs(extra - p) <= 4 * (p * (1 - p) / len(g)) ** 0.5
    again = mixing.query(d.repartition(7)).toPandas().set_index("doc_id").taken
    assert (again == found.set_index("doc_id").taken.reindex(again.index)).all()


# 3


def brute_removed(texts, length):
    seen = {}
    for d, t in enumerate(texts):
        for i in range(len(t) - length + 1):
            seen.setdefault(t[i : i + length], []).append((d, i))
    gone = [np.zeros(len(t), bool) for t in texts]
    for places in seen.values():
        if len(places) > 1:
            for d, i in places:
                gone[d][i : i + length] = True
    return gone


def copied_texts():
    rng = random.Random(11)
    pool = ["".join(rng.choices("abcdefgh é", k=900)) for _ in range(4)]
    out = []
    for _ in range(40):
        parts = []
        for _ in range(rng.randint(1, 3)):
            p = rng.choice(pool)
            lo = rng.randint(0, 400)
            piece = list(p[lo : lo + rng.randint(300, 520)])
            if rng.random() < 0.4:
                piece[rng.randrange(len(piece))] = "#"
            parts += ["".join(rng.choices("xyz ", k=rng.randint(0, 120))), "".join(piece)]
        out.append("".join(parts))
    calm = ["q" * 1300, "ab" * 900, "r" * 700 + pool[1], "r" * 420, "Z" * 399, "Z" * 400, "=" * 401]
    return out + calm + ["short", "", pool[0] * 3, out[0]]


@pytest.mark.parametrize("hot", [4_000, 2])
def test_repeated_bytes(spark, hot):
    texts = copied_texts()
    want = brute_removed([t.encode() for t in texts], substrings.LENGTH)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = {r.doc_id: r for r in substrings.removed(df, hot=hot, keep_text=True).collect()}
    for d, (t, gone) in enumerate(zip(texts, want)):
        data = np.frombuffer(t.encode(), np.uint8)
        assert found[d].n_removed == gone.sum()
        assert found[d].n_spans == (np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum()
        assert bytes(found[d].kept) == data[~gone].tobytes()


def test_suffix_order_is_lexicographic():
    rng = random.Random(2)
    buf = np.frombuffer(bytes(rng.choices(b"ab", k=3000)), np.uint8)
    at = np.array(rng.sample(range(2500), 400))
    size = np.array([rng.randint(0, 500) for _ in at])
    group = np.array([rng.randint(0, 2) for _ in at])
    order, shared = substrings.suffix_order(buf, substrings.Prefixes(buf), at, size, group)
    raw = buf.tobytes()
    pieces = [(group[i], raw[at[i] : at[i] + size[i]]) for i in order]
    assert pieces == sorted(pieces)
    for k in range(1, len(pieces)):
        (ga, a), (gb, b) = pieces[k - 1], pieces[k]
        n = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b))) if ga == gb else 0
        assert shared[k] == n


# 4 and 6


def random_vectors(spark, n=3000, d=24, copies=200):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(n, d)).astype(np.float32)
    x[n - copies :] = x[0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<float>")
    return x.astype(np.float64), df


def test_neighbours_recall_and_scores(spark):
    x, df = random_vectors(spark)
    found = mih.neighbours(df).toPandas()
    hits = 0
    for q, g in found.groupby("query_id"):
        far = np.sqrt(((x - x[q]) ** 2).sum(1))
        far[q] = np.inf
        want = np.lexsort((np.arange(len(x)), far))[:10]
        g = g.sort_values("rank")
        assert g["rank"].tolist() == list(range(1, 11))
        assert np.allclose(far[g.vec_id], g.score, rtol=0, atol=1e-12)
        assert list(zip(g.score, g.vec_id)) == sorted(zip(g.score, g.vec_id))
        hits += len(set(want) & set(g.vec_id))
    assert hits >= 0.9 * 10 * found.query_id.nunique()
    assert found.query_id.nunique() == 30


def test_codes_within_radius():
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 256, (2000, 8)).astype(np.uint8)
    codes[:300] = codes[0] ^ (rng.random((300, 8)) < 0.2)
    index = mih.Index(codes)
    for r in (3, 9, 20, 27):
        far = np.bitwise_count(codes ^ codes[5]).sum(1)
        rows, d = index.within(codes[5], r)
        assert rows.tolist() == np.flatnonzero(far <= r).tolist() and (d == far[rows]).all()


@pytest.mark.parametrize("shard_rows", [30_000, 700])
def test_top_products_exact(spark, shard_rows):
    x, df = random_vectors(spark)
    ints = np.floor(256 * x).astype(np.int64)
    found = kdtree.top_products(df, shard_rows=shard_rows).toPandas()
    assert found.query_id.nunique() == 60
    for q, g in found.groupby("query_id"):
        score = ints @ ints[q]
        order = [i for i in np.lexsort((np.arange(len(x)), -score)) if i != q][:5]
        g = g.sort_values("rank")
        assert g.vec_id.tolist() == order and g.score.tolist() == score[order].tolist()


# 5


def test_packing_round_trip(spark):
    d = docs(spark)
    texts = {r.doc_id: r.text for r in d.collect()} | {-1: None, -2: "", -3: "a<|endoftext|>B İ \x1c z 12² it's", -4: "word " * 30_000}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    tok = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    ids = {i: np.array([*tok.encode(t or "", add_special_tokens=False).ids, 2], "<u4") for i, t in texts.items()}
    found = packing.packed(df, shard_bytes=200_000).collect()
    covered, sequences = {i: [] for i in ids}, {}
    for r in found:
        covered[r.doc_id].append((r.start, r.length))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())
        assert r.doc_tokens == len(ids[r.doc_id])
    for i, parts in covered.items():
        at = 0
        for start, n in sorted(parts):
            assert start == at and n > 0
            at += n
        assert at == len(ids[i])
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= packing.WINDOW and at & (at - 1) == 0  # full, or a power of two: no padding


def test_encoder_equals_the_tokenizer(spark):
    tok = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    enc = packing.Encoder(public_tokenizers.path(packing.TOKENIZER))
    rng = random.Random(8)
    marks = [chr(c) for c in [*range(9, 14), *range(32, 0x250), 0x300, 0x301, 0x3A3, 0x2028, 0x3000, 0x1F600]]
    texts = ["".join(rng.choices(marks, k=30)) for _ in range(3000)]
    texts += ["".join(rng.choices(["'s", "'LL", "don't", "It's", "a1", "x²y", "\u00c9t\u00e9", "\u0130", "<|", "endoftext", "|>", " ", "\u00a0", "\u00ad"], k=12)) for _ in range(2000)]
    texts += [r.text for r in docs(spark).collect()]
    for t, got in zip(texts, enc.encode(texts)):
        assert got.tolist() == [*tok.encode(t, add_special_tokens=False).ids, packing.END_ID], repr(t)


def test_neighbours_share_a_window():
    words = lambda a, b: np.array([*range(a, b), 2], "<u2")
    shard = [words(1000, 1500), words(5000, 5500), words(1000, 1490), words(5010, 5500), words(9000, 9400)]
    pieces = packing.fill(shard, 1024)
    assert [p[0] for p in pieces][:2] == [0, 2]
    assert {p[0] for p in pieces if p[3] == 1} >= {1} or pieces[2][0] in (1, 3)


def test_near_copies_meet_whatever_the_shards(spark):
    rng = random.Random(5)
    vocabulary = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(4000)]
    rows = []
    for i in range(300):
        text = rng.choices(vocabulary, k=60)
        rows += [(i, " ".join(text)), (1000 + i, " ".join([*text[:30], rng.choice(vocabulary), *text[31:]]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for shard_bytes in (5_000, 50_000, 8 << 20):  # 60 shards, 6, 1
        windows = {}
        for r in packing.packed(df, shard_bytes=shard_bytes).collect():
            windows.setdefault(r.doc_id, set()).add(r.sequence_id)
        met = sum(bool(windows[i] & windows[1000 + i]) for i in range(300))
        assert met >= 225, (shard_bytes, met)


def test_one_term_in_all_documents_is_split(spark):
    rows = [(i, "zyxwvut " * 50 + f"word{i % 7} " * (i % 5)) for i in range(400)]
    made = packing.encoded(spark.createDataFrame(rows, "doc_id long, text string"), public_tokenizers.path(packing.TOKENIZER)).cache()
    sizes = [r["count"] for r in packing.dealt(made, packing.corpus_of(made), 10_000).groupBy("shard").count().collect()]
    assert sum(sizes) == 400 and max(sizes) < 120


# 7


def test_chat_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{SF_MEDIUM}/conversations.parquet')")
    got = chat.query(spark.read.parquet(f"{SF_MEDIUM}/conversations.parquet")).toPandas()
    want = con.execute(chat.ORACLE).df()
    cols = sorted(want.columns)
    assert sorted(map(tuple, got[cols].values.tolist())) == sorted(map(tuple, want[cols].values.tolist()))


@pytest.mark.parametrize("most", [2000, 2])
def test_prefix_tree(spark, most):
    rows = []
    told = {1: ["a", "b"], 2: ["a", "b", "c"], 3: ["a", "x"], 4: ["z"], 5: ["a", "b"], 6: ["a", "b", "c", "d"]}
    for conv, texts in told.items():
        rows += [(conv, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(texts)]
    made = chat.turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    trees = chat.sequences(made, most=most).collect()
    leaves = 0
    for t in trees:
        assert len(t.ids) == len(t.position_ids)
        assert len({n.node for n in t.nodes}) == len(t.nodes)  # shared turns stand once
        for i, n in enumerate(t.nodes):
            chain = [n]
            while chain[0].parent >= 0:
                chain.insert(0, t.nodes[chain[0].parent])
            assert n.parent < i  # depth-first: ancestors come before
            seen = [x for v in n.visible for x in range(v.lo, v.hi)]
            assert seen == [x for c in chain for x in range(c.begin, c.stop)]
            assert [t.position_ids[x] for x in seen] == list(range(len(seen)))
            leaves += n.leaf
    assert leaves == 5  # conversations 1 and 5 are one path
    if most == 2000:
        assert sum(len(t.nodes) for t in trees) == 6


@pytest.mark.parametrize("most, slices", [(10, 32), (10, 2), (25, 32)])
def test_hot_prefixes_stand_once_per_tree(spark, monkeypatch, most, slices):
    monkeypatch.setattr(chat, "SLICE", slices)
    shared = ["prompt", "hello", "more"]
    told = {i: ["prompt", f"q{i}"] for i in range(55)}
    told |= {100 + i: [*shared, f"r{i}", "end"] for i in range(33)}
    told |= {200: shared[:1], 201: shared[:2], 202: shared, 203: ["other"], 204: ["other", "one"]}
    rows = [(c, i, "user", t) for c, texts in told.items() for i, t in enumerate(texts)]
    made = chat.turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    trees = chat.sequences(made, most=most).collect()
    per_tree = [sum(n.leaf for n in t.nodes) for t in trees]
    assert sum(per_tree) == len(told) and max(per_tree) <= most
    tops = [sum(n.parent < 0 for n in t.nodes) for t in trees]
    assert max(tops) == 1  # conversations that share nothing are not put together
    copies = len(trees) - 1  # all but the tree under "other" repeat the prompt
    paths = 55 + 33 + 3
    least = -(-paths // most)
    assert least <= copies <= (least if slices == 32 else 2 * least)


def test_escapes_round_trip():
    rng = random.Random(3)
    for _ in range(5000):
        t = "".join(rng.choices(["<", "|", ">", "s", "/", "[", "]", "INST", "␛", "<|", "</s>", "<<SYS>>"], k=12))
        e = chat.escape(t)
        assert chat.unescape(e) == t and not any(c in e for c in chat.CONTROLS)


# 8

PLAIN = re.compile(r"licensed under cc by-nc 4\.0|gnu general public license, version 3|apache license, version 2\.0|released under the mit license", re.I)


def test_license_notices(spark):
    d = docs(spark, SF_MEDIUM)
    found = {r.doc_id: r for r in licenses.query(d).collect()}
    texts = {r.doc_id: r.text for r in d.collect()}
    assert all(found[i].n_notices == len(PLAIN.findall(t)) for i, t in texts.items())
    assert sum(r.n_notices for r in found.values()) > 0


def test_license_wording():
    name = lambda t: [(x[2], x[3]) for x in licenses.scan(t)]
    assert name("Released under the MIT license.") == [("MIT", 0)]
    assert name("licensed  under the GNU General\tPublic License, version 2") == [("GPL-2.0", 0)]
    assert name("This work is licensed under the GNU General Public License, version 9") == []
    assert name("a driving license and a dog license") == []
    assert name("Licensed under CC BY-SA 4.0") == [("CC-BY-SA-4.0", 0)]


def test_license_notices_in_a_long_line():
    rng = random.Random(8)
    names = ["Licensed under the Apache License, Version 2.0", "Released under the MIT License", licenses.NOTICES[2][2]]
    parts, want = [], 0
    for i in range(350):  # a cue every 300 characters
        parts += ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) + " " for _ in range(45)]
        if i % 5 == 0:
            parts.append(names[want % 3] + " ")
            want += 1
        else:
            parts.append("a licensed trade ")
    found = licenses.scan("".join(parts))
    assert want > 50 and [x[2] for x in found] == [("Apache-2.0", "MIT", "MIT")[i % 3] for i in range(want)]
    assert all(x[3] == 0 for x in found)


WRAPPED = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one""",
    "GPL-3.0": """This file is licensed under the GNU General Public
License, version 3""",
    "Apache-2.0": """Licensed under the Apache License,
Version 2.0 (the "License");""",
}


@pytest.mark.parametrize("lead", ["", "# ", " * "])
@pytest.mark.parametrize("name", WRAPPED)
def test_wrapped_notices(name, lead):
    text = "some code\n" + "\n".join(lead + x for x in WRAPPED[name].splitlines()) + "\nmore code"
    assert [x[2] for x in licenses.scan(text)] == [name]


GNU = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU {} as published by
the Free Software Foundation, either version {} of the License, or
(at your option) any later version."""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer."""
STANDARD = [
    (GNU.format("General Public License", 3), "GPL-3.0"),
    (GNU.format("General Public License", 2), "GPL-2.0"),
    (GNU.format("Lesser General Public License", "2.1"), "LGPL-2.1"),
    (GNU.format("Lesser General Public License", 3), "LGPL-3.0"),
    (GNU.format("Affero General Public License", 3), "AGPL-3.0"),
    (BSD, "BSD-2-Clause"),
    (BSD + "\n3. Neither the name may be used to endorse or promote products", "BSD-3-Clause"),
    ("Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided", "ISC"),
    ("This is free and unencumbered software released into the\npublic domain.", "Unlicense"),
    ("The MIT License (MIT)\n\nCopyright", "MIT"),
    ("I know the MIT License well", ""),
    ("SPDX-License-Identifier: GPL-2.0-only WITH Linux-syscall-note", "GPL-2.0-only"),
    ("SPDX-License-Identifier: (MIT OR Apache-2.0)", "MIT,Apache-2.0"),
    ("All rights\nreserved.", "All-rights-reserved"),
]


@pytest.mark.parametrize("lead", ["", "# ", " * "])
@pytest.mark.parametrize("text, want", STANDARD)
def test_standard_notices(text, want, lead):
    assert ",".join(x[2] for x in licenses.scan("\n".join(lead + x for x in text.splitlines()))) == want


PLANTED = {"GPL": r"gnu general public license, version", "NC": r"cc by-nc 4\.0", "MIT": r"released under the mit", "Apache": r"apache license, version 2", "All-r": "all rights reserved"}


def test_all_planted_license_lines(spark):
    found, texts = {r.doc_id: r for r in licenses.query(docs(spark, SF_MEDIUM)).collect()}, docs(spark, SF_MEDIUM).collect()
    for name, line in PLANTED.items():
        want = {t.doc_id: len(re.findall(line, t.text, re.I)) for t in texts}
        told = {i: len(list(filter(None, r.reserved.split(",")))) if name == "All-r" else sum(name in x for x in r.notices.split(",")) for i, r in found.items()}
        assert told == want and sum(want.values()) > 0, name


# 9


def brute_fingerprint(text):
    w = (text or "").encode().lower().split()
    grams = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h)) if h else 0


def test_simhash_components(spark):
    d = docs(spark, SF_MEDIUM)
    extra = [(100_000 + i, t) for i, t in enumerate([None, "", "  ", "One", "one", "one two", "ONE TWO"])]
    both = d.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))
    texts = {r.doc_id: r.text for r in both.collect()}
    ids = sorted(texts)
    fp = np.array([brute_fingerprint(texts[i]) for i in ids], np.uint64)
    near = np.bitwise_count(fp[:, None] ^ fp[None]) <= 3
    label = np.arange(len(ids))
    while True:
        new = np.array([label[near[i]].min() for i in range(len(ids))])
        if (new == label).all():
            break
        label = new
    found = {r.doc_id: r for r in simhash.query(both).collect()}
    assert all(found[i].fingerprint == f"{f:016x}" for i, f in zip(ids, fp.tolist()))
    assert all(found[i].component_id == ids[k] for i, k in zip(ids, label.tolist()))


def test_links_of_clustered_fingerprints(spark, monkeypatch):
    """Many fingerprints a few bits from each other: chains, crowded buckets, blocks."""
    monkeypatch.setattr(simhash, "BLOCK_MEMBERS", 16)
    rng = np.random.default_rng(9)
    centre = rng.integers(0, 1 << 63, 6, dtype=np.uint64)
    flips = (np.uint64(1) << rng.integers(0, 64, (600, 4)).astype(np.uint64))
    fp = np.unique(np.bitwise_xor.reduce(flips, axis=1) ^ centre[rng.integers(0, 6, 600)])
    near = np.bitwise_count(fp[:, None] ^ fp[None]) <= 3
    a, b = np.nonzero(near)
    x, y = graph.local_forest(fp.view(np.int64)[a], fp.view(np.int64)[b])
    want = dict(zip(x.tolist(), y.tolist()))
    df = spark.createDataFrame([(int(f),) for f in fp.view(np.int64)], "fp long")
    got = {r.node: r.root for r in graph.components(simhash.links(df)).collect()}
    assert {k: v for k, v in got.items() if k != v} == want


# 10

BASE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def brute_spans(text):
    out = []
    for kind, pattern in BASE.items():
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 12 <= len(digits) <= 19 and pii.luhn(digits), "phone": 9 <= len(digits) <= 15,
            }[kind]
            if ok:
                out.append((m.start(), kind, m.end()))
    return sorted(out, key=lambda s: (s[0], list(BASE).index(s[1])))


def test_base_spans():
    rng = random.Random(5)
    texts = ["".join(rng.choices("a1@.+-  ()%2345@.9é\n,0", k=rng.randint(0, 50))) for _ in range(20_000)]
    texts += ["".join(rng.choices("4111 -.+0", k=rng.randint(0, 60))) for _ in range(10_000)]
    for t in texts:
        assert [s for s in pii.spans(t) if s[1] in pii.BASE] == brute_spans(t), t


def test_base_spans_of_documents(spark):
    d = docs(spark, SF_MEDIUM)
    texts = {r.doc_id: r.text for r in d.collect()}
    for r in pii.query(d).collect():
        want = pii.joined(brute_spans(texts[r.doc_id]))
        assert [s for s in r.spans.split(",") if s and s.split(":")[0] in pii.BASE] == [s for s in want.split(",") if s]
        assert r.base_sha256 == pii.digest(want.encode())


def test_added_spans_and_redaction():
    kinds = lambda t: [k for _, k, _ in pii.spans(t) if k not in pii.BASE]
    assert kinds('token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"') == ["secret"]
    assert kinds("IBAN: GB82 WEST 1234 5698 7654 32 ok") == ["iban"]
    assert kinds("IBAN: GB83 WEST 1234 5698 7654 32 ok") == []
    assert kinds("SSN 078-05-1120") == ["ssn"] and kinds("account no. 12345678") == ["account"]
    assert kinds("see https://bob:pw@example.com/x now") == ["url"]
    assert kinds("a token of love, secretly; mission 123-45-6789") == []
    assert pii.redact("mail a@b.cd now") == "mail [EMAIL] now"
    assert pii.redact("https://bob:pw@example.com/x") == "[URL]"
