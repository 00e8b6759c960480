"""License notices by conditional compression.

A candidate block is the text around one license cue, across line breaks (words
skip them, and comment signs). A block is
compressed on its own and once with each template as a raw zstandard
dictionary; templates are ranked by how much smaller that makes the block, and
the winners, those with at least ``WINNER`` of the best reduction, are confirmed
by exact wording: the notice must stand in the block with at most ``TOLERANCE`` of its words changed,
left out or put in, and with all the words that tell it from other licenses
unchanged. Where confirmed notices overlap, the one with the fewest differing
words counts, then the one with the best reduction.

Defined results: a null or empty text has no notices; repeated rows each get a
row; equal reductions go to the template first in the list; a notice repeated
in a text is listed at each place; an empty table gives no rows; other columns
are not read. Positions are code points, end exclusive. Headings count only
where nothing else stands on their lines. The opening sentence of the BSD
licenses is the two-clause one if conditions follow it without the clause on
endorsement. Each identifier of an SPDX expression is a notice. Reservations of
all rights are no licenses and are listed on their own.
"""

from __future__ import annotations

import re
from bisect import bisect
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from rankflow.llm.common import prepare, text_rows, texts_of

# License name, the words that must be there unchanged, and the notice's wording.
NOTICES: tuple[tuple[str, str, str], ...] = (
    ("Apache-2.0", "apache 2.0", "Licensed under the Apache License, Version 2.0"),
    ("MIT", "mit", "Released under the MIT License"),
    ("MIT", "permission hereby granted free charge", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("GPL-3.0", "gnu general public 3", "Licensed under the GNU General Public License, version 3"),
    ("GPL-2.0", "gnu general public 2", "Licensed under the GNU General Public License, version 2"),
    ("LGPL-3.0", "gnu lesser public 3", "Licensed under the GNU Lesser General Public License, version 3"),
    ("AGPL-3.0", "gnu affero public 3", "Licensed under the GNU Affero General Public License, version 3"),
    ("MPL-2.0", "mozilla public 2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0"),
    ("BSD-3-Clause", "redistribution source binary", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("GPL-2.0", "gnu general public 2", "redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License"),
    ("GPL-3.0", "gnu general public 3", "redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("LGPL-2.1", "gnu lesser public 2.1", "redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License"),
    ("LGPL-3.0", "gnu lesser public 3", "redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("AGPL-3.0", "gnu affero public 3", "redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("GPL-2.0", "gnu general public 2", "under the terms of the GNU General Public License version 2 as published by the Free Software Foundation"),
    ("GPL-3.0", "gnu general public 3", "under the terms of the GNU General Public License version 3 as published by the Free Software Foundation"),
    ("LGPL-2.1", "gnu lesser public 2.1", "Licensed under the GNU Lesser General Public License, version 2.1"),
    ("ISC", "permission use copy modify distribute fee hereby granted", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("Unlicense", "free unencumbered public domain", "This is free and unencumbered software released into the public domain"),
    ("CC-BY-4.0", "creative commons attribution 4.0", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-SA-4.0", "creative commons attribution-sharealike 4.0", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("CC-BY-NC-4.0", "creative commons attribution-noncommercial 4.0", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("MIT", "mit", "MIT License"),
    ("MIT", "mit", "The MIT License"),
    ("MIT", "mit", "The MIT License (MIT)"),
    ("BSD-2-Clause", "bsd 2-clause", "BSD 2-Clause License"),
    ("BSD-3-Clause", "bsd 3-clause", "BSD 3-Clause License"),
    ("ISC", "isc", "ISC License"),
    ("CC-BY-4.0", "cc by 4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-SA-4.0", "cc by-sa 4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-NC-4.0", "cc by-nc 4.0", "Licensed under CC BY-NC 4.0"),
    ("All-rights-reserved", "all rights reserved", "All rights reserved."),
)
HEADINGS = {"MIT License", "The MIT License", "The MIT License (MIT)", "BSD 2-Clause License", "BSD 3-Clause License", "ISC License"}
RESERVED, BSD = "All-rights-reserved", "redistribution source binary"
SPDX_TAG = re.compile(r"SPDX-License-Identifier:[ \t]*", re.I)
#: a license, or an exception to one, in an SPDX expression
SPDX_ID = re.compile(r"[( \t]*(?:(AND|OR|WITH)[ \t]+)?[( \t]*([A-Za-z0-9](?:[A-Za-z0-9.+-]*[A-Za-z0-9+])?)[ \t]*\)*", re.I)
#: single words, as a line break may stand between any two
CUES = ("licens", "licenc", "hereby", "redistribution", "unencumbered", "reserved")
#: characters of a candidate block on either side of its cue
REACH = 400
TOLERANCE, LEVEL = 0.2, 3
#: share of a block's best reduction that a template needs to be confirmed
WINNER = 0.5
WORD = re.compile(r"[^\W_]+(?:[.-][^\W_]+)*")


def words(text: str) -> list[tuple[str, int, int]]:
    return [(m[0].lower(), m.start(), m.end()) for m in WORD.finditer(text)]


@lru_cache(maxsize=1)
def templates():
    """(name, needed words, notice words, compressor, whether a heading) per notice."""
    return [(name, needed.split(), [w for w, _, _ in words(notice)], compressor(notice), notice in HEADINGS) for name, needed, notice in NOTICES]


@lru_cache(maxsize=256)
def compressor(notice: str) -> zstandard.ZstdCompressor:
    data = zstandard.ZstdCompressionDict(notice.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_content_size=False)


def alone_on_lines(text: str, a: int, b: int) -> bool:
    """Whether no other word stands on the lines of a stretch."""
    end = text.find("\n", b)
    return not WORD.search(text, text.rfind("\n", 0, a) + 1, a) and not WORD.search(text, b, len(text) if end < 0 else end)


def bsd(text: str, b: int) -> str:
    """Which of the BSD licenses goes on after its opening sentence."""
    rest = " ".join(w for w, _, _ in words(text[b : b + 2500])).split("redistribution and use in source")[0]
    return "BSD-2-Clause" if "list of conditions" in rest and "endorse or promote" not in rest else "BSD-3-Clause"


def spdx(text: str) -> Iterator[tuple[int, int, str]]:
    """(start, end, identifier) of the licenses in SPDX lines; the first one has the tag with it."""
    for tag in SPDX_TAG.finditer(text):
        start, at, first = tag.start(), tag.end(), True
        while (m := SPDX_ID.match(text, at)) and first == (m[1] is None):
            if first or m[1].upper() != "WITH":
                yield (start if first else m.start(2)), m.end(2), m[2]
            at, first = m.end(), False


def blocks(text: str) -> list[tuple[int, int]]:
    """The stretch around every cue, across line breaks."""
    low = text.lower()
    if len(low) != len(text):  # a letter whose lower case is longer
        low = "".join(c if len(c.lower()) != 1 else c.lower() for c in text)
    found = []
    for cue in CUES:
        at = low.find(cue)
        while at >= 0:
            found.append((max(0, at - REACH), min(len(text), at + REACH)))
            at = low.find(cue, at + 1)
    return sorted(set(found))


def words_within(text: str, lo: int, hi: int) -> list[tuple[str, int, int]]:
    """Words of a stretch, without those that its ends cut."""
    told = [(m[0].lower(), m.start(), m.end()) for m in WORD.finditer(text, lo, hi)]
    if told and lo and told[0][1] == lo and WORD.match(text[lo - 1]):
        del told[0]
    if told and told[-1][2] == hi and WORD.match(text[hi : hi + 1]):
        del told[-1]
    return told


def differences(block: list[str], notice: list[str]) -> list[tuple[int, int, int]]:
    """(differing words, begin, end) for every end in the block: word edit distance of the notice to the best stretch that ends there."""
    cost = [(i, 0) for i in range(len(notice) + 1)]
    out = []
    for j, word in enumerate(block):
        new = [(0, j + 1)]
        for i, w in enumerate(notice):
            new.append(min((cost[i][0] + (w != word), cost[i][1] if i else j), (cost[i + 1][0] + 1, cost[i + 1][1]), (new[i][0] + 1, new[i][1])))
        cost = new
        out.append((cost[-1][0], cost[-1][1], j + 1))
    return out


def confirm(block: list[tuple[str, int, int]], needed: list[str], notice: list[str]) -> list[tuple[int, int, int]]:
    """(begin, end, differing words) in characters of the block, non-overlapping, fewest differences first."""
    line = [w for w, _, _ in block]
    if not set(needed) <= set(line):
        return []
    most = int(TOLERANCE * len(notice))
    taken: list[tuple[int, int, int]] = []
    for d, lo, hi in sorted(x for x in differences(line, notice) if x[0] <= most and x[1] < x[2]):
        if set(needed) <= set(line[lo:hi]) and all(hi <= a or lo >= b for a, b, _ in taken):
            taken.append((lo, hi, d))
    return [(block[lo][1], block[hi - 1][2], d) for lo, hi, d in taken]


def winners(sizes: list[int]) -> list[tuple[int, int]]:
    """The (change in size, template) that are confirmed, best first: templates that make the block smaller, by ``WINNER`` of the best reduction at least."""
    ranked = sorted((size, i) for i, size in enumerate(sizes))
    return [(size, i) for size, i in ranked if size < 0 and size <= WINNER * ranked[0][0]]


def scan(text: str | None) -> list[tuple[int, int, str, int, float]]:
    """(start, end, license, differing words, size reduction) by start."""
    out: list[tuple[int, int, str, int, float]] = []
    if not text:
        return out
    plain = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)
    hits = []
    for lo, hi in blocks(text):
        told = words_within(text, lo, hi)
        there = {w for w, _, _ in told}
        if not any(there.issuperset(t[1]) for t in templates()):
            continue
        data = text[lo:hi].encode()
        alone = len(plain.compress(data))
        for size, i in winners([len(t[3].compress(data)) - alone for t in templates()]):
            name, needed, notice, _, heading = templates()[i]
            for a, b, d in confirm(told, needed, notice):
                if not heading or alone_on_lines(text, a, b):
                    hits.append((d, size, i, a, b, bsd(text, b) if " ".join(needed) == BSD else name, alone))
    for a, b, name in spdx(text):
        lo, hi = max(0, a - REACH), min(len(text), b + REACH)
        data = text[lo:hi].encode()
        alone = len(plain.compress(data))
        size = len(compressor(f"SPDX-License-Identifier: {name}").compress(data)) - alone
        hits.append((0, size, len(NOTICES), a, b, name, alone))
    starts: list[int] = []
    ends: list[int] = []
    for d, size, _, a, b, name, alone in sorted(hits):
        at = bisect(starts, a)
        if (at == 0 or ends[at - 1] <= a) and (at == len(starts) or starts[at] >= b):
            starts.insert(at, a)
            ends.insert(at, b)
            out.append((a, b, name, d, round(-size / max(alone, 1), 6)))
    return sorted(out)


SCHEMA = "doc_id long, n_notices long, licenses string, notices string, best_reduction double, reserved string"


def query(docs: DataFrame) -> DataFrame:
    """One row per document: number of notices, the licenses in code point order, the notices as
    license:start:end:differing words, and the reservations of all rights as start:end:differing words."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            every = [scan(t) for t in texts_of(b)]
            found = [[x for x in f if x[2] != RESERVED] for f in every]
            kept = [[x for x in f if x[2] == RESERVED] for f in every]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("doc_id"),
                    pa.array([len(f) for f in found], pa.int64()),
                    pa.array([",".join(sorted({x[2] for x in f})) for f in found], pa.string()),
                    pa.array([",".join(f"{n}:{s}:{e}:{d}" for s, e, n, d, _ in f) for f in found], pa.string()),
                    pa.array([max((x[4] for x in f), default=0.0) for f in found], pa.float64()),
                    pa.array([",".join(f"{s}:{e}:{d}" for s, e, _, d, _ in f) for f in kept], pa.string()),
                ],
                ["doc_id", "n_notices", "licenses", "notices", "best_reduction", "reserved"],
            )

    return text_rows(docs).mapInArrow(run, SCHEMA)
