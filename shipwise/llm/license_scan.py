"""License scans by conditional compression.

Candidate blocks are parts of a text that run from one piece of a template's
wording (three of its words in order, or two with a naming word) to the next,
over line ends and with at most ``gap`` other words between, and hold a
license word; they reach to the ends of their lines where these are near.
Each distinct block is compressed with zstandard alone and with every template
as raw dictionary; a template that knows the block's wording saves most of its
size, and templates are ranked by that reduction.  The winner is confirmed by
an exact comparison of words: within the part of the block that aligns best
with one of the template's wordings, the words may differ by at most
``differences`` of the part's words, the part must hold enough of the wording,
and the wording's naming words must be in it or right behind it (only wordings
that name a license or its version have any).  The rest of the block is looked
at again, so a block may hold several notices.  A whole line with a license
word is also compared as such, with all of a template's text.  A notice that
its own sentence denies or puts in the past ("is not", "were once", "no
longer", up to ``said`` words before it, or inside it beyond the wording's own)
counts for nothing.  An SPDX line is a wording of its template; an
expression of several ids is read as a line for each.

Distinct blocks are compared once, however often they occur, and their verdict
is joined back; a hot block is one row of that join.  Rows: null and empty
texts have no block; equal blocks get equal verdicts; a tie in reduction goes
to the first template; repeated rows and null ids stay rows of their own;
other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from difflib import SequenceMatcher

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shipwise.llm.tables import pick


@dataclass(frozen=True)
class Wording:
    """``names``: words that a notice in this wording must hold; ``barred``: words of another
    license or version, which it must not."""

    text: str
    names: tuple[str, ...] = ()
    barred: tuple[str, ...] = ()


#: Words that deny a notice or put it in the past.
DENIALS = frozenset("not never isn aren wasn weren cannot once formerly previously longer".split())
_GPL_OTHERS = ("lesser", "affero")
_BSD_OTHERS = ("0", "2", "4", "zero", "two", "simplified")
_BSD_TERMS = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
              "following conditions are met")
_BSD_CLAUSES = (": 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
                "following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of "
                "conditions and the following disclaimer in the documentation and/or other materials provided with the "
                "distribution. ")
#: Public license notices.
TEMPLATES = {
    "Apache-2.0": (
        Wording("Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use "
                "this file except in compliance with the License. You may obtain a copy of the License at "
                "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
                "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
                "CONDITIONS OF ANY KIND, either express or implied.", ("apache", "license"), ("1",)),
        Wording("Unless required by applicable law or agreed to in writing, "
                "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
                "CONDITIONS OF ANY KIND, either express or implied."),
        Wording("Licensed under the Apache License, Version 2.0.", ("apache", "license"), ("1",))),
    "MIT": (
        Wording("Released under the MIT License.", ("mit",)),
        Wording("This project is licensed under the MIT License.", ("mit",)),
        Wording("Permission is hereby "
                "granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to "
                "deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
                "publish, distribute, sublicense, and/or sell copies of the Software.")),
    "GPL-3.0": (
        Wording("This work is licensed under the GNU General Public License, version 3.", ("gnu", "general", "public", "3"), _GPL_OTHERS),
        Wording("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
                "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
                "any later version.", ("gnu", "general", "public", "3"), _GPL_OTHERS)),
    "GPL-2.0": (
        Wording("This work is licensed under the GNU General Public License, version 2.", ("gnu", "general", "public", "2"), _GPL_OTHERS),
        Wording("This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
                "License as published by the Free Software Foundation; either version 2 of the License.",
                ("gnu", "general", "public", "2"), _GPL_OTHERS)),
    "LGPL-3.0": (
        Wording("This work is licensed under the GNU Lesser General Public License, version 3.",
                ("gnu", "lesser", "general", "public"), ("2",)),
        Wording("This library is free software; you can redistribute it under the terms of the GNU Lesser General "
                "Public License as published by the Free Software Foundation.", ("gnu", "lesser", "general", "public"), ("2",))),
    "LGPL-2.1": (
        Wording("This work is licensed under the GNU Lesser General Public License, version 2.1.",
                ("gnu", "lesser", "general", "public", "2", "1"), ("3",)),
        Wording("This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
                "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) "
                "any later version.", ("gnu", "lesser", "general", "public", "2", "1"), ("3",))),
    "AGPL-3.0": (
        Wording("This work is licensed under the GNU Affero General Public License, version 3.",
                ("gnu", "affero", "general", "public", "3")),
        Wording("This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
                "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
                "any later version.", ("gnu", "affero", "general", "public", "3"))),
    "ISC": (
        Wording("Licensed under the ISC License.", ("isc",)),
        Wording("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
                "granted, provided that the above copyright notice and this permission notice appear in all copies.")),
    "BSL-1.0": (
        Wording("Distributed under the Boost Software License, Version 1.0.", ("boost", "software")),),
    "Unlicense": (
        Wording("This is free and unencumbered software released into the public domain.", ("unencumbered",)),),
    "CC0-1.0": (
        Wording("To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to this "
                "work to the public domain worldwide under the CC0 1.0 Universal license.", ("cc", "0")),),
    "EPL-2.0": (
        Wording("This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0.",
                ("eclipse", "public", "2")),),
    "BSD-3-Clause": (
        Wording("Licensed under the BSD 3-Clause License.", ("bsd",), _BSD_OTHERS),
        Wording("Released under the BSD License.", ("bsd",), _BSD_OTHERS),
        Wording(_BSD_TERMS),
        Wording(_BSD_TERMS + _BSD_CLAUSES + "3. Neither the name of the copyright holder nor the names of its contributors may be "
                "used to endorse or promote products derived from this software without specific prior written permission.",
                ("neither", "endorse"))),
    "BSD-2-Clause": (
        Wording("Licensed under the BSD 2-Clause License.", ("bsd", "2")),
        Wording(_BSD_TERMS + _BSD_CLAUSES + "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\"",
                ("binary", "disclaimer", "provided", "by"), ("neither", "endorse"))),
    "CC-BY-4.0": (
        Wording("Licensed under CC BY 4.0.", ("cc", "by", "4"), ("sa", "nc", "nd")),
        Wording("licensed under a Creative Commons Attribution 4.0 International License.", ("creative", "commons", "attribution", "4"),
                ("sharealike", "share", "noncommercial", "non", "noderivatives", "noderivs"))),
    "CC-BY-SA-4.0": (
        Wording("Licensed under CC BY-SA 4.0.", ("cc", "by", "sa", "4"), ("nc",)),
        Wording("licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
                ("creative", "commons", "attribution", "sharealike", "4"), ("noncommercial", "non"))),
    "CC-BY-NC-4.0": (
        Wording("Licensed under CC BY-NC 4.0.", ("cc", "by", "nc", "4"), ("sa", "nd")),
        Wording("licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
                ("creative", "commons", "attribution", "noncommercial", "4"), ("sharealike", "share", "noderivatives", "noderivs"))),
    "MPL-2.0": (
        Wording("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", ("mozilla", "public"), ("1",)),
        Wording("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a "
                "copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
                ("mozilla", "public"), ("1",))),
}
#: Words of an id that another license's id adds to it.
_LONGER_IDS = {"CC-BY-4.0": ("sa", "nc", "nd"), "CC-BY-SA-4.0": ("nc",), "CC-BY-NC-4.0": ("sa", "nd")}
TEMPLATES = {name: (*wordings, Wording(f"SPDX-License-Identifier: {name}", ("spdx", *re.findall(r"[a-z]+|\d+", name.lower())),
                                       _LONGER_IDS.get(name, ()))) for name, wordings in TEMPLATES.items()}
#: Words of which a candidate block holds one (in lower case).
MARKS = r"licen[cs]e|copyright|permission[^a-z0-9]+is|redistribution|creative[^a-z0-9]+commons|public[^a-z0-9]+domain"
_MARKS, _LINES = re.compile(MARKS), re.compile(r"[^\r\n]+")
#: At an end of a block: its line goes on.
CUT = "\x1f"


@dataclass(frozen=True)
class LicenseParams:
    """``least``: share of a part's compressed size that a template must save; ``cover``: share of
    a wording's words that a part must hold (``enough`` words suffice); ``gap``: most other words
    between two pieces of a block; ``reach``: words behind a part that may name its version;
    ``said``: words before a part that may deny it."""

    least: float = 0.25
    differences: float = 0.25
    level: int = 19
    cover: float = 0.75
    enough: int = 24
    gap: int = 8
    reach: int = 3
    said: int = 4


def words(text: str) -> list[str]:
    return re.findall(r"[a-z]+|\d+", text.lower())


def _placed(text: str) -> list[tuple[str, int, int]]:
    # A-Z only, so that places are those of the text
    return [(m.group().lower(), m.start(), m.end()) for m in re.finditer(r"[A-Za-z]+|\d+", text)]


_EXPRESSION = re.compile(r"(SPDX-License-Identifier:[ \t]*)([^\r\n]*?[ \t)](?:OR|AND)[ \t(][^\r\n]*)")


def _expanded(m: re.Match) -> str:
    return "\n".join(m.group(1) + one.strip(" \t()") for one in re.split(r"\b(?:OR|AND)\b", m.group(2)))


def denied(text: str, placed: list[tuple[str, int, int]], at: int, said: int) -> bool:
    """Does one of the ``said`` words before word ``at``, in its sentence, deny what follows?"""
    return any(w in DENIALS and not re.search(r"[.;!?]\s", text[end:placed[at][1]]) for w, _, end in placed[max(0, at - said):at])


class Blocks:
    """Finds the candidate blocks of a text."""

    def __init__(self, templates: dict[str, tuple[Wording, ...]], p: LicenseParams) -> None:
        self.p, self.pieces = p, set()
        for w in (w for ws in templates.values() for w in ws):
            own, named = words(w.text), {n for n in w.names if n == "cc" or len(n) > 2 and n != "license"}
            self.pieces.update(zip(own, own[1:], own[2:]))
            self.pieces.update(x for x in zip(own, own[1:]) if named & set(x))

    def of(self, text: str) -> list[str]:
        text = _EXPRESSION.sub(_expanded, text)
        placed = _placed(text)
        own = [w for w, _, _ in placed]
        runs: list[list[int]] = []  # first word, word after the last
        for i in range(len(own)):
            n = next((len(x) for x in (tuple(own[i:i + 3]), tuple(own[i:i + 2])) if x in self.pieces), 0)
            if n and runs and i - runs[-1][1] <= self.p.gap:
                runs[-1][1] = max(runs[-1][1], i + n)
            elif n:
                runs.append([i, i + n])
        out, lines = [], [m.span() for m in _LINES.finditer(text)]
        at = 0
        taken: list[tuple[int, int]] = []
        for k, (a, b) in enumerate(runs):
            lo, hi = placed[a][1], placed[b - 1][2]
            while lines[at][1] < lo:
                at += 1
            last = at
            while lines[last][1] < hi:
                last += 1
            before, behind = text[lines[at][0]:lo], text[hi:lines[last][1]]
            cut = CUT + ("not " if denied(text, placed, a, self.p.said) else "")  # what is cut off may deny the notice
            start = cut if len(words(before)) > self.p.gap or taken and taken[-1][1] > lines[at][0] else before
            # two blocks share no words
            shared = k + 1 < len(runs) and placed[runs[k + 1][0]][1] < lines[last][1]
            end = CUT if shared or len(words(behind)) > self.p.gap else behind
            taken.append((lo, hi))
            out.append((start + text[lo:hi] + end).strip(" \t\r\n"))
        # marked lines in no block, as they are
        k = 0
        for lo, hi in lines:
            while k < len(taken) and taken[k][1] <= lo:
                k += 1
            if k == len(taken) or taken[k][0] >= hi:
                out.append(text[lo:hi].strip(" "))
        return [x for x in out if _MARKS.search(x.lower())]


class Matcher:
    def __init__(self, templates: dict[str, tuple[Wording, ...]], p: LicenseParams) -> None:
        self.p = p
        self.alone = zstandard.ZstdCompressor(level=p.level, write_content_size=False)
        self.wordings = {n: [(w, SequenceMatcher(None, "", words(w.text), autojunk=False)) for w in ws] for n, ws in templates.items()}
        whole = {n: " ".join(w.text for w in ws) for n, ws in templates.items()}
        self.words = {n: words(text) for n, text in whole.items()}
        self.given = {n: zstandard.ZstdCompressor(level=p.level, write_content_size=False, dict_data=zstandard.ZstdCompressionDict(
            text.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)) for n, text in whole.items()}
        #: A window holds any part twice.
        self.window = int(2 * max(len(m.b) for ws in self.wordings.values() for _, m in ws) * (1 + p.differences))

    def ranked(self, block: str, least: float | None = None) -> list[tuple[float, str]]:
        """(share of the compressed size saved, template), best first."""
        raw = block.encode()
        size = len(self.alone.compress(raw))
        saved = [(1 - len(c.compress(raw)) / size, n) for n, c in self.given.items()]
        return sorted((x for x in saved if x[0] >= (self.p.least if least is None else least)), key=lambda x: -x[0])

    def saved(self, part: str, name: str) -> float:
        raw = part.encode()
        return 1 - len(self.given[name].compress(raw)) / len(self.alone.compress(raw))

    def differences(self, block: str, name: str) -> int:
        """Words of the block outside the template's best alignment (a word missing between two
        aligned ones counts too)."""
        a, b = words(block), self.words[name]
        same = [m for m in SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks() if m.size]
        out, end = len(a) - sum(m.size for m in same), None
        for m in same:
            if end is not None and m.a == end[0]:
                out += m.b - end[1]
            end = (m.a + m.size, m.b + m.size)
        return out

    @staticmethod
    def aligned(own: list[str], matcher: SequenceMatcher) -> tuple[int, int, int, int]:
        """(first word, word after the last, aligned words, differences) of the part that has most
        aligned words over differences; words of either side between aligned ones are differences."""
        matcher.set_seq1(own)
        best, now, end = (0, 0, 0, 0), None, (0, 0)
        for m in matcher.get_matching_blocks():
            if not m.size:
                continue
            lost = m.a - end[0] + m.b - end[1]
            if now is None or now[2] - now[3] <= lost:
                now = (m.a, m.a + m.size, m.size, 0)
            else:
                now = (now[0], m.a + m.size, now[2] + m.size, now[3] + lost)
            end = (m.a + m.size, m.b + m.size)
            best = max(best, now, key=lambda x: x[2] - x[3])
        return best

    def part(self, own: list[str], name: str) -> tuple[int, int, int, int] | None:
        """The best confirmed part of any wording of the template, as of aligned()."""
        held, found = set(own), None
        for w, matcher in self.wordings[name]:
            if not held.issuperset(w.names):
                continue
            a, b, same, d = self.aligned(own, matcher)
            if sum(x in DENIALS for x in own[a:b]) > sum(x in DENIALS for x in matcher.b):
                continue
            near = set(own[a:b + self.p.reach])
            if (same >= min(self.p.cover * len(matcher.b), self.p.enough) and d <= self.p.differences * (b - a)
                    and near.issuperset(w.names) and not near.intersection(w.barred)
                    and (found is None or same - d > found[2] - found[3])):
                found = a, b, same, d
        return found

    def line(self, line: str) -> tuple[str, float, int] | None:
        """The verdict on a whole line."""
        own = words(line)
        if DENIALS.intersection(own):
            return None
        for saved, name in self.ranked(line):
            if any(w.names and set(w.names) <= set(own) and not set(w.barred) & set(own) for w, _ in self.wordings[name]):
                d = self.differences(line, name)
                if d <= self.p.differences * len(own):
                    return name, saved, d
        return None

    def _in(self, block: str, placed: list[tuple[str, int, int]], lo: int, hi: int) -> Iterator[tuple[str, float, int, int, int]]:
        """(license, reduction, differences, start, end in the block) of the notices in words lo to hi; a denied one has no license."""
        while lo < hi:
            end = min(hi, lo + self.window)
            own = [w for w, _, _ in placed[lo:end]]
            for _, name in self.ranked(block[placed[lo][1]:placed[end - 1][2]], 0):
                if found := self.part(own, name):
                    a, b, _, d = found
                    start, stop = placed[lo + a][1], placed[lo + b - 1][2]
                    saved = self.saved(block[start:stop], name)
                    if saved >= self.p.least:
                        yield from self._in(block, placed, lo, lo + a)
                        yield "" if denied(block, placed, lo + a, self.p.said) else name, saved, d, start, stop
                        lo += b
                        break
            else:
                lo = hi if end == hi else lo + self.window // 2

    def notices(self, block: str) -> list[tuple[str, float, int]]:
        """(license, reduction, differences) of each confirmed notice of the block."""
        placed = _placed(block)
        found = list(self._in(block, placed, 0, len(placed)))
        out = [x[:3] for x in found if x[0]]
        for m in _LINES.finditer(block):
            line = m.group()
            if CUT not in line and _MARKS.search(line.lower()) and not any(s < m.end() and e > m.start() for *_, s, e in found):
                if verdict := self.line(line.strip(" ")):
                    out.append(verdict)
        return out


def _judge(p: LicenseParams):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Matcher(TEMPLATES, p)
        for batch in batches:
            found = [(d, *x) for d, b in zip(batch.column("digest").to_pylist(), batch.column("block").to_pylist(), strict=True)
                     for x in m.notices(b)]
            digest, name, saved, diff = zip(*found, strict=True) if found else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(digest, pa.binary()), pa.array(name, pa.string()), pa.array(saved, pa.float64()), pa.array(diff, pa.int64())],
                names=["digest", "license", "reduction", "differences"])
    return run


def _blocks(p: LicenseParams):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Blocks(TEMPLATES, p)
        for batch in batches:
            blocks = [finder.of(t) for t in batch.column("text").to_pylist()]
            row = pa.array([i for i, bs in enumerate(blocks) for _ in bs], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("id").take(row), batch.column("t").take(row),
                                              pa.array([b for bs in blocks for b in bs], pa.string())], names=["id", "t", "block"])
    return run


def candidate_blocks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     params: LicenseParams = LicenseParams()) -> DataFrame:
    """row key (id, two hashes of the text), block, digest: one row for each candidate block."""
    rows = pick(docs, id=id_col, text=text_col).where(F.lower("text").rlike(MARKS)).select("id", F.xxhash64("text").alias("t"), "text")
    blocks = rows.mapInArrow(_blocks(params), f"id {rows.schema['id'].dataType.simpleString()}, t long, block string")
    return blocks.withColumn("digest", F.unhex(F.sha2("block", 256)))


def confirmed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              params: LicenseParams = LicenseParams()) -> DataFrame:
    """id, t, block, license, reduction, differences for each confirmed notice."""
    blocks = candidate_blocks(docs, id_col, text_col, params)
    distinct = blocks.groupBy("digest").agg(F.first("block").alias("block"))
    verdict = distinct.mapInArrow(_judge(params), "digest binary, license string, reduction double, differences long")
    return blocks.join(verdict, "digest").drop("digest")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         params: LicenseParams = LicenseParams()) -> DataFrame:
    """id, n_blocks (confirmed notices), licenses (names, sorted, comma-joined), reduction (the best one,
    0 to 1) and differences (the least) for every row."""
    found = confirmed(docs, id_col, text_col, params).groupBy("id", "t").agg(
        F.count("*").alias("n"), F.array_sort(F.collect_set("license")).alias("names"),  # at most one name per template
        F.max("reduction").alias("r"), F.min("differences").alias("d"))
    rows = pick(docs, id=id_col, text=text_col).select("id", F.xxhash64("text").alias("t"))
    # of repeated rows each carries the blocks of one
    copies = rows.groupBy("id", "t").agg(F.count("*").alias("copies"))
    out = (copies.join(found.withColumnsRenamed({"id": "i", "t": "u"}), F.col("id").eqNullSafe(F.col("i")) & (F.col("t") == F.col("u")), "left")
           .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))))
    n = F.coalesce((F.col("n") / F.col("copies")).cast("long"), F.lit(0).cast("long"))
    return out.select("id", n.alias("n_blocks"), F.coalesce(F.array_join("names", ","), F.lit("")).alias("licenses"),
                      F.coalesce("r", F.lit(0.0)).alias("reduction"), F.col("d").alias("differences"))
