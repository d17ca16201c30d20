"""Licence scans by conditional compression.

A candidate block is compressed alone and with each template as a raw zstandard
dictionary; the template that saves the most describes the block best. All templates, best first, are then
confirmed by their wording: the words of the template that the block lacks, and the words it adds,
from an exact comparison in order. The words from the first to the last of a confirmed template leave the
block and the rest, also of the same lines, is scanned again, so a block or a line may hold several notices.

A candidate block is a run of lines with a hint word, or lines between and beside
them of which most words belong to the templates' wording. Documents without a
hint word are left out by the scan itself. Blocks much longer than any template are
read in overlapping windows of words, whole, also inside a line.

Defined cases: a null or empty text has no block; a block without a confirmed template is
a row with a null licence; ties go to the larger saving, then to the alphabetically
first template; repeated rows give repeated findings; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import difflib
import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, query, table

RANKED = 4  # among so many, best saving first, the right one is expected in a short block; the others are compared too
LACKING = 0.2  # largest share of a template's words that a confirmed block may lack
FOREIGN = 0.25  # largest share of words that a line beside a hint may have outside all templates
# Hint words, and the public wording of common notices by licence.
HINTS = (r"licen[cs]e|copyright|rights reserved|permission is hereby|permission to use|warrant(y|ies)|spdx"
         r"|public domain|\bcc[ -](by|0)|creative commons|redistribution")
TEMPLATES = {
    "all-rights-reserved": ["All rights reserved."],
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."],
    "bsd-3-clause": [
        "Released under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met:"],
    "cc-by-4.0": ["Licensed under CC BY 4.0.",
                  "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "cc-by-nc-4.0": ["Licensed under CC BY-NC 4.0.",
                     "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International "
                     "License."],
    "cc-by-sa-4.0": ["Licensed under CC BY-SA 4.0.",
                     "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International "
                     "License."],
    "cc0-1.0": ["To the extent possible under law, the author has dedicated all copyright and related rights to "
                "this work to the public domain worldwide."],
    "gpl-2.0": ["This work is licensed under the GNU General Public License, version 2."],
    "gpl-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "SPDX-License-Identifier: GPL-3.0-only",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."],
    "isc": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
            "is hereby granted, provided that the above copyright notice and this permission notice appear in all "
            "copies."],
    "lgpl-3.0": ["This work is licensed under the GNU Lesser General Public License, version 3."],
    "mit": [
        "Released under the MIT License.",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction, including '
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        "copies or substantial portions of the Software."],
    "mpl-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
}
_HINT = re.compile(HINTS, re.IGNORECASE)
_WORD = re.compile(r"\w+(?:\.\w+)*")


def words(text: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(text)]


class Scanner:
    """The templates, ready to compress with and to compare."""

    def __init__(self, templates: dict[str, list[str]]):
        self.templates = []
        for name in sorted(templates):
            for i, wording in enumerate(templates[name]):
                if not _HINT.search(wording):
                    raise ValueError(f"template {name} #{i} has no hint word")
                raw = zstandard.ZstdCompressionDict(wording.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                self.templates.append((name, i, words(wording), _packer(raw)))
        self.plain = _packer(None)
        self.wording = {w for _, _, ws, _ in self.templates for w in ws}
        self.longest = max((len(ws) for _, _, ws, _ in self.templates), default=0)

    def blocks(self, text: str) -> Iterator[list[tuple[int, int, str]]]:
        """Candidate blocks as (line number, place in the line, the line from there)."""
        run: list[tuple[int, str, bool]] = []
        for n, line in enumerate(text.split("\n")):
            ws = words(line)
            hint = bool(_HINT.search(line))
            if hint or (ws and sum(w not in self.wording for w in ws) <= FOREIGN * len(ws)):
                run.append((n, line, hint))
                continue
            yield from self._windows(run)
            run = []
        yield from self._windows(run)

    def _windows(self, run: list[tuple[int, str, bool]]) -> Iterator[list[tuple[int, int, str]]]:
        if not any(hint for _, _, hint in run):
            return
        lines = [piece for n, line, _ in run for piece in self._pieces(n, line)]
        sizes = [len(words(line)) for _, _, line in lines]
        start = 0
        while True:
            end, held = start, 0
            while end < len(lines) and (end == start or held + sizes[end] <= 4 * self.longest):
                held += sizes[end]
                end += 1
            yield _joined(lines[start:end])
            if end == len(lines):
                return
            back, kept = end, 0
            while back > start + 1 and kept + sizes[back - 1] <= 2 * self.longest:
                back -= 1
                kept += sizes[back]
            start = back

    def _pieces(self, n: int, line: str) -> Iterator[tuple[int, int, str]]:
        """A line, cut before every so many words: windows overlap by more than a template with its additions."""
        ends = [m.start() for m in _WORD.finditer(line)][max(1, self.longest // 2)::max(1, self.longest // 2)]
        for a, e in zip([0, *ends], [*ends, len(line)]):
            yield n, a, line[a:e]

    def rank(self, block: str) -> list[tuple[float, int]]:
        """(share of the compressed size that a template saves, template), the largest first."""
        raw = block.encode()
        alone = len(self.plain.compress(raw))
        saved = [(1.0 - len(t[3].compress(raw)) / alone, i) for i, t in enumerate(self.templates)]
        return sorted(saved, key=lambda s: (-s[0], s[1]))

    def confirm(self, block: list[tuple[int, int, str]]) -> tuple | None:
        """(template, saving, lacking, added, first word, last word) of the best confirmed template; places in the block."""
        best = None
        owner = [(k, m.start(), m.end(), m.group().lower()) for k, (_, _, line) in enumerate(block)
                 for m in _WORD.finditer(line)]
        here = [w for *_, w in owner]
        known = set(here)
        for saving, i in self.rank("\n".join(line for _, _, line in block)):
            want = self.templates[i][2]
            if sum(w not in known for w in want) > LACKING * len(want):
                continue
            same = [m for m in difflib.SequenceMatcher(None, here, want, False).get_matching_blocks() if m.size]
            held = {k for m in same for k in range(m.b, m.b + m.size)}
            missing = [w for k, w in enumerate(want) if k not in held]
            lacking = len(missing)
            if lacking > LACKING * len(want) or any(c.isdigit() for w in missing for c in w):
                continue  # another version is another licence
            first, last = same[0].a, same[-1].a + same[-1].size
            added = last - first - (len(want) - lacking)
            if added > LACKING * len(want):
                continue
            found = ((len(want) - 2 * lacking - added), saving, -i, lacking, added, owner[first], owner[last - 1])
            if best is None or found[:3] > best[:3]:
                best = found
        return best and (-best[2], best[1], best[3], best[4], best[5], best[6])

    def scan(self, text: str) -> list[tuple]:
        """(line, lines, licence, template, saving, lacking, added) of each finding; licence None: not confirmed."""
        found_at, unknown = {}, {}
        for block in self.blocks(text):
            todo = [block]
            while todo:
                part = todo.pop()
                hints = [(n, at + m.start()) for n, at, line in part for m in _HINT.finditer(line)]
                if not hints:
                    continue
                found = self.confirm(part)
                if found is None:
                    saving, i = self.rank("\n".join(line for _, _, line in part))[0]
                    row = (part[0][0], part[-1][0] - part[0][0] + 1, None, None, round(saving, 6), None, None)
                    unknown.setdefault(row[:2], []).append((row, hints))
                    continue
                i, saving, lacking, added, (k, start, _, _), (e, _, end, _) = found
                (first, at, line), (last, to, rest) = part[k], part[e]
                row = (first, last - first + 1, self.templates[i][0], self.templates[i][1], round(saving, 6),
                       lacking, added)
                score = len(self.templates[i][2]) - 2 * lacking - added
                found_at[(first, at + start), (last, to + end), i] = (-score, row)
                todo += [part[:k] + [(first, at, line[:start])], [(last, to + end, rest[end:])] + part[e + 1:]]
        spans, out = [], []
        for (a, z, i), (_, row) in sorted(found_at.items(), key=lambda f: (f[1][0], f[0])):
            if all(z <= b or e <= a for b, e in spans):  # windows overlap, and one may hold a part of a notice
                spans.append((a, z))
                out.append(row)
        for rows in unknown.values():  # a hint that another window confirms is no unknown notice
            out += [row for row, hints in rows if not all(any(a <= h < z for a, z in spans) for h in hints)][:1]
        return sorted(out, key=lambda r: (r[0], r[1], r[2] or ""))


def _joined(pieces: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """The pieces of each line as one."""
    out = pieces[:1]
    for n, at, line in pieces[1:]:
        if n == out[-1][0]:
            out[-1] = (n, out[-1][1], out[-1][2] + line)
        else:
            out.append((n, at, line))
    return out


def _packer(raw: zstandard.ZstdCompressionDict | None) -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=6, dict_data=raw, write_content_size=False, write_dict_id=False)


def scan_licenses(docs: DataFrame, templates: dict[str, list[str]] | None = None, text: str = "text",
                  id_col: str = "doc_id") -> DataFrame:
    """One row per finding: id, line, n_lines, license (null: not confirmed), template, saving, lacking, added."""
    bounded_batches(docs.sparkSession)
    given = TEMPLATES if templates is None else templates
    ident = docs.schema[id_col].dataType
    kind = T.StructType([
        T.StructField(id_col, ident), T.StructField("line", T.IntegerType()), T.StructField("n_lines", T.IntegerType()),
        T.StructField("license", T.StringType()), T.StructField("template", T.IntegerType()),
        T.StructField("saving", T.DoubleType()), T.StructField("lacking", T.IntegerType()),
        T.StructField("added", T.IntegerType())])
    types = (pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.float64(), pa.int32(), pa.int32())

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(given)
        for b in batches:
            places, rows = [], []
            for i, t in enumerate(b.column(1).to_pylist()):
                found = scanner.scan(t)
                places += [i] * len(found)
                rows += found
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(places)), *[pa.array(c, t) for c, t in zip(zip(*rows), types)]],
                    names=kind.names)
    hinted = docs.where(F.col(text).rlike(f"(?i){HINTS}"))
    return hinted.select(F.col(id_col), F.col(text).alias("body")).mapInArrow(scan, kind)


@query("op10_license_scan")
def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All licence notices of all documents, and the candidate blocks without a known wording."""
    return scan_licenses(table(spark, sf_dir, "documents"))
