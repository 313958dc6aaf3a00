"""License scans by conditional compression.

A document's candidate blocks are the stretches that share three-word runs with any
template. Each block is compressed with every template as a raw zstandard dictionary;
templates are ranked by how much they reduce the block's size, and the first whose
wording the block holds wins: the block's words are aligned with the template's,
and what is missing, added or changed is reported. Words left over on either side of
a confirmed wording are a block again, so neighbouring notices are all found.

Texts are scanned whole, in the task that reads them. Templates are a bounded list that is
part of the task.

Defined results: null and empty texts, and blocks that no template confirms, give no
row; a null doc_id is reported as it is; repeated rows are reported each; equal
reductions are ranked by template id; other columns are ignored.
"""

from __future__ import annotations

import difflib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEVEL = 9
RUN = 3
#: Words between two shared runs of one block, least share of a template's words, and
#: least reduction of a block's compressed size.
GAP, COVERED, GAIN = 12, 0.8, 0.1
WORD = re.compile(r"[^\W_]+")

#: Public notices by which licenses are declared.
TEMPLATES = {
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this
file except in compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the
License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND,
either express or implied. See the License for the specific language governing permissions
and limitations under the License.""",
    "bsd-2-clause": """Redistribution and use in source and binary forms, with or without modification, are
permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of
conditions and the following disclaimer in the documentation and/or other materials provided
with the distribution.""",
    "bsd-3-clause-end": """Neither the name of the copyright holder nor the names of its contributors may be
used to endorse or promote products derived from this software without specific prior written
permission.""",
    "cc-by-4.0": "Licensed under CC BY 4.0.",
    "cc-by-4.0-long": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-nc-4.0-long": """This work is licensed under a Creative Commons Attribution-NonCommercial 4.0
International License.""",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "gpl-2.0-header": """This program is free software; you can redistribute it and/or modify it under the terms
of the GNU General Public License as published by the Free Software Foundation; either version 2
of the License, or (at your option) any later version.""",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-header": """This program is free software: you can redistribute it and/or modify it under the terms
of the GNU General Public License as published by the Free Software Foundation, either version 3
of the License, or (at your option) any later version.""",
    "gpl-warranty": """This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;
without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the
GNU General Public License for more details.""",
    "isc": """Permission to use, copy, modify, and/or distribute this software for any purpose with or
without fee is hereby granted, provided that the above copyright notice and this permission notice
appear in all copies.""",
    "lgpl-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "mit": "Released under the MIT License.",
    "mit-text": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software
and associated documentation files (the "Software"), to deal in the Software without restriction,
including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense,
and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,
subject to the following conditions: The above copyright notice and this permission notice shall be
included in all copies or substantial portions of the Software.""",
    "mpl-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy
of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    "unlicense": "This is free and unencumbered software released into the public domain.",
}

FOUND = "doc_id long, first_word long, n_words long, license string, gain double, runner_up string, \
covered double, missing long, added long, exact boolean, differences string"


@dataclass
class Template:
    name: str
    words: list[str]
    compressor: zstandard.ZstdCompressor


class Scanner:
    """Templates prepared for matching and compressing."""

    def __init__(self, templates: dict[str, str]):
        options = {"level": LEVEL, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
        self.plain = zstandard.ZstdCompressor(**options)
        self.templates = []
        self.ids: dict[str, int] = {}
        for name, text in sorted(templates.items()):
            words = WORD.findall(text.lower())
            raw = zstandard.ZstdCompressionDict(
                " ".join(words).encode().rjust(8), dict_type=zstandard.DICT_TYPE_RAWCONTENT
            )
            self.templates.append(Template(name, words, zstandard.ZstdCompressor(dict_data=raw, **options)))
            for w in words:
                self.ids.setdefault(w, len(self.ids))
        self.runs = np.unique(
            np.concatenate(
                [self.codes(np.array([self.ids[w] for w in t.words], np.int64)) for t in self.templates]
            )
        )

    def codes(self, ids: np.ndarray) -> np.ndarray:
        """Numbers of the three-word runs; -1 where a word is in no template."""
        if len(ids) < RUN:
            return np.zeros(0, np.int64)
        n = len(self.ids)
        a, b, c = ids[:-2], ids[1:-1], ids[2:]
        return np.where((a >= 0) & (b >= 0) & (c >= 0), (a * n + b) * n + c, -1)

    def blocks(self, words: list[str]):
        """Stretches (begin, end) of words around runs that templates have."""
        ids = np.fromiter((self.ids.get(w, -1) for w in words), np.int64, len(words))
        at = np.flatnonzero(np.isin(self.codes(ids), self.runs))
        if not len(at):
            return
        cut = np.flatnonzero(np.diff(at) > GAP) + 1
        for part in np.split(at, cut):
            begin, end = int(part[0]), int(part[-1]) + RUN
            # Words of the templates next to the runs belong to the block.
            while begin and ids[begin - 1] >= 0:
                begin -= 1
            while end < len(words) and ids[end] >= 0:
                end += 1
            yield begin, end

    def ranked(self, words: list[str]) -> list[tuple[float, Template]]:
        """Templates by their reduction of the block's compressed size."""
        data = " ".join(words).encode()
        size = len(self.plain.compress(data))
        gains = [(1 - len(t.compressor.compress(data)) / size, t) for t in self.templates]
        return sorted((x for x in gains if x[0] >= GAIN), key=lambda x: (-x[0], x[1].name))

    def aligned(self, block: list[str], template: Template):
        """Matching stretches around the longest one, as (begin, end, shared words); all 0 where no word is shared.

        Parts of words alone can make a block smaller by a template.
        """
        n = len(template.words)
        match = difflib.SequenceMatcher(None, block, template.words, autojunk=False)
        best = match.find_longest_match()
        if not best.size:
            return 0, 0, 0
        slack = n // 4 + 1
        low = max(0, best.a - best.b - slack)
        high = min(len(block), best.a - best.b + n + slack)
        match = difflib.SequenceMatcher(None, block[low:high], template.words, autojunk=False)
        same = [m for m in match.get_matching_blocks() if m.size]
        return low + same[0].a, low + same[-1].a + same[-1].size, sum(m.size for m in same)

    def confirm(self, block: list[str]):
        """The best ranked finding in a block whose wording is confirmed, or None."""
        ranking = self.ranked(block)
        for gain, template in ranking:
            low, high, shared = self.aligned(block, template)
            if shared < COVERED * len(template.words) or high - low > len(template.words) / COVERED:
                continue
            match = difflib.SequenceMatcher(None, template.words, block[low:high], autojunk=False)
            changes = [
                sign + " ".join(part)
                for tag, i, j, k, m in match.get_opcodes()
                if tag != "equal"
                for sign, part in (("-", template.words[i:j]), ("+", block[low + k : low + m]))
                if part
            ]
            others = [t.name for _, t in ranking if t is not template]
            return (
                low,
                high - low,
                template.name,
                gain,
                others[0] if others else None,
                shared / len(template.words),
                len(template.words) - shared,
                high - low - shared,
                not changes,
                "; ".join(changes),
            )
        return None

    def scan(self, text: str):
        """Findings in the order of their first words."""
        words = WORD.findall(text.lower())
        waiting = list(self.blocks(words))
        found = []
        while waiting:
            begin, end = waiting.pop()
            if end - begin < RUN:
                continue
            hit = self.confirm(words[begin:end])
            if hit:
                low, size = begin + hit[0], hit[1]
                found.append((low, *hit[1:]))
                waiting += [(begin, low), (low + size, end)]
        return sorted(found)


def scan_documents(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """One row per license wording found: where, which, and how its wording differs."""
    given = TEMPLATES if templates is None else templates
    names = [part.split()[0] for part in FOUND.split(",")]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.bool_(), pa.string()]

    def scanned(batches):
        scanner = Scanner(given)
        for batch in batches:
            rows = []
            for start in range(0, len(batch), 1024):
                part = batch.slice(start, 1024)
                ids = part.column("doc_id").to_pylist()
                for id, text in zip(ids, part.column("text").to_pylist(), strict=True):
                    rows += [(id, *found) for found in scanner.scan(text)]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(x), t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], names
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(scanned, FOUND)
