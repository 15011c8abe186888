"""License scans by conditional compression: blocks against notices as raw dictionaries, then exact wording."""

from __future__ import annotations

import re
from collections import Counter
from difflib import SequenceMatcher

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The usual notices of common licenses, by SPDX identifier.
NOTICES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0 Universal."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version.",
    ),
    ("ISC", "Released under the ISC License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction',
    ),
    ("MIT", "Released under the MIT License."),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
#: Words that any notice has; text without them is not compressed.
CUES = re.compile(r"licen[cs]|copyright|permission|public domain|creative commons|\bcc[ -]?by|\bcc0|redistribut|spdx", re.I)
#: The greatest share of a notice's words that may differ.
MOST_DIFFERENT = 0.2

WORD = re.compile(r"[^\W_]+(?:[.\-][^\W_]+)*")
FOUND = "array<struct<license:string,start:int,length:int,saved:double,missing:array<string>,added:array<string>>>"


def blocks(text: str, reach: int) -> list[tuple[int, int]]:
    """Spans around cues: whole lines, of long lines ``reach`` characters to either side; lines that follow join."""
    out: list[list[int]] = []
    for m in CUES.finditer(text):
        lo = max(text.rfind("\n", 0, m.start()) + 1, m.start() - reach)
        hi = text.find("\n", m.end())
        hi = min(len(text) if hi < 0 else hi, m.end() + reach)
        if out and lo <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [(a, b) for a, b in out]


def words_at(text: str) -> list[tuple[str, int, int]]:
    return [(m[0].casefold(), m.start(), m.end()) for m in WORD.finditer(text)]


def wording(notice: list[str], block: list[str]) -> tuple[int, int, list[str], list[str]] | None:
    """First and last + 1 word of the notice in the block, words it misses and words added in between; None if none."""
    pairs = SequenceMatcher(None, notice, block, autojunk=False).get_matching_blocks()
    best, left = None, 0
    runs = [p for p in pairs if p.size]
    for i in range(len(runs)):  # the matched runs of one place: those with few words added between
        j = i
        while j + 1 < len(runs) and runs[j + 1].b - (runs[j].b + runs[j].size) <= max(2, len(notice) // 5):
            j += 1
        matched = sum(r.size for r in runs[i : j + 1])
        if best is None or matched > left:
            best, left = (i, j), matched
    if best is None:
        return None
    here = runs[best[0] : best[1] + 1]
    first, last = here[0].b, here[-1].b + here[-1].size
    in_notice = {x for r in here for x in range(r.a, r.a + r.size)}
    in_block = {x for r in here for x in range(r.b, r.b + r.size)}
    missing = [w for i, w in enumerate(notice) if i not in in_notice]
    added = [block[i] for i in range(first, last) if i not in in_block]
    return first, last, missing, added


class Scanner:
    """The notices ready to compress and compare; made once in each task."""

    def __init__(self, notices=NOTICES):
        self.notices = [(name, [w for w, _, _ in words_at(text)]) for name, text in notices]
        self.counts = [Counter(notice) for _, notice in self.notices]
        plain = {"level": 9, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
        self.plain = zstandard.ZstdCompressor(**plain)
        self.given = [
            zstandard.ZstdCompressor(
                dict_data=zstandard.ZstdCompressionDict(text.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT), **plain
            )
            for _, text in notices
        ]
        self.reach = max(len(text) for _, text in notices) + 200

    def scan(self, text: str | None) -> list[tuple[str, int, int, float, list[str], list[str]]]:
        """License, start, length, share saved, missing and added words of every notice found in a text."""
        out = {}
        for lo, hi in blocks(text or "", self.reach):
            # A notice may go on in lines without a cue: if the lines with cues hold none, or not all words of one that
            # stands with those around, these are added.
            at = max(0, lo - self.reach)
            block, wide = text[lo:hi], text[at : hi + self.reach]
            found = self._block(block, lo)
            if not found or set(self._possible(words_at(wide))) - set(self._possible(words_at(block))):
                alone = {x[:3]: x for x in found}
                more = [alone.get(x[:3], x) for x in self._block(wide, at)]
                found = more + [x for x in found if all(x[1] + x[2] <= y[1] or y[1] + y[2] <= x[1] for y in more)]
            for x in found:
                out.setdefault((x[1], x[0]), x)
        return [out[k] for k in sorted(out)]

    def _possible(self, found: list[tuple[str, int, int]]) -> list[int]:
        """The notices that may stand by the words of a block in any order; no other can."""
        held = Counter(w for w, _, _ in found)
        out = []
        for i, (_, notice) in enumerate(self.notices):
            lost = {w: n - held[w] for w, n in self.counts[i].items() if n > held[w]}
            if sum(lost.values()) <= MOST_DIFFERENT * len(notice) and not any(c.isdigit() for w in lost for c in w):
                out.append(i)
        return out

    def _block(self, block: str, at: int) -> list:
        out, parts = [], [(block, at)]
        while parts:
            block, at = parts.pop()
            best = self._best(block)
            if best is None:
                continue
            share, start, end, name, missing, added = best
            out.append((name, at + start, end - start, share, missing, added))
            # A block may hold more than one notice: look at what is before and after this one.
            parts += [x for x in ((block[:start], at), (block[end:], at + end)) if CUES.search(x[0])]
        return out

    def _best(self, block: str) -> tuple[float, int, int, str, list[str], list[str]] | None:
        """Share saved, start, end, license, missing and added words of the notice that matches a block best."""
        found = words_at(block)
        raw = block.encode("utf-8", "surrogatepass")
        alone = len(self.plain.compress(raw))
        saved = sorted(((alone - len(self.given[i].compress(raw))) / alone, -i) for i in self._possible(found))[::-1]
        confirmed = []
        # Exact wording decides, whatever a notice saves: a long one saves more by chance than a short one that is there.
        for share, i in saved:
            name, notice = self.notices[-i]
            w = wording(notice, [w for w, _, _ in found])
            if w is None:
                continue
            first, last, missing, added = w
            # Numbers tell versions apart: none may be missing or added.
            if len(missing) + len(added) <= MOST_DIFFERENT * len(notice) and not any(c.isdigit() for x in missing + added for c in x):
                confirmed.append((len(missing) + len(added), -len(notice), -share, first, last, name, missing, added))
        if not confirmed:
            return None
        _, _, share, first, last, name, missing, added = min(confirmed)
        return -share, found[first][1], found[last - 1][2], name, missing, added


def licenses_in(text: Column) -> Column:
    """The notices found in a text, in order."""

    @F.pandas_udf(FOUND)
    def scan(texts: pd.Series) -> pd.Series:
        scanner = Scanner()
        names = ("license", "start", "length", "saved", "missing", "added")
        return pd.Series([[dict(zip(names, x, strict=True)) for x in scanner.scan(t)] for t in texts], dtype=object)

    return scan(text)


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for every license notice in the texts of ``docs``.

    A block of text around the words that notices use is compressed alone and with each notice as a raw dictionary, but
    for notices that its words rule out. All others are compared with it word by word; one stands if at most a fifth of
    its words differ and no number does. What is left of the block is searched again. Nothing is shuffled.

    Defined results: null and empty texts have no notice; a null id is kept; repeated rows are each searched; notices
    that match equally well go by fewest differing words, then the longest, then what they save; an empty table gives
    no rows; other columns are ignored.

    Returns doc_id, place (0 for the first of the text), license, start and length in characters, saved (share of the
    block's compressed size), missing and added words.
    """
    return docs.select(
        F.col(id_col).alias("doc_id"), F.posexplode(licenses_in(F.col(text_col))).alias("place", "n")
    ).select("doc_id", "place", "n.license", "n.start", "n.length", "n.saved", "n.missing", "n.added")
