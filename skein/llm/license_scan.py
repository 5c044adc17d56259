"""License scans by patience alignment.

A text and the notices are words (lower-cased, outer punctuation off). Windows of twice a notice's length, a quarter of
the notice apart, are aligned with it: anchors are the words that occur once in both, of which the longest increasing
subsequence is kept; the gaps between anchors are aligned in the same way, after their common beginnings and ends. The
coverage of a notice is the share of its words that are aligned; `coverage` or more counts, `long_coverage` of a notice
of `LONG` words and more, which an edit or two do not make another. Windows in which the notice's words, counted with
their multiplicity, cannot reach it are passed over; that bound is exact.

Of all spans found anywhere in a text those hold that overlap no better one: the more words of the notice are aligned,
less five for each that is missing (so a notice wins over one that is a part of it), then the longer, then the earlier. One row for a text and license: its best span that holds. Null text counts as empty and
gives no row; a very long text is scanned whole; repeated rows and null ids are scanned row by row; an empty table gives
none; other columns are not looked at.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm.common import chunks, small_batches, table, texts

#: License names, their usual notices, and whole texts where these are short (public texts).
NOTICES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
        the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by
        applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
        WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
        governing permissions and limitations under the License.""",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
        persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and
        this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS
        PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
        MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT
        HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
        ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ],
    "ISC": [
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS
        PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES
        OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
        CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
        CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
        SOFTWARE.""",
    ],
    "BSD-2-Clause": [
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice,
        this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
        distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
        WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR
        PURPOSE ARE DISCLAIMED.""",
    ],
    "BSD-3-Clause": [
        "Licensed under the 3-Clause BSD License.",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice,
        this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
        distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
        promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY
        THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO,
        THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.""",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
        License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
        version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
        implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more
        details.""",
    ],
    "LGPL-3.0": [
        """This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General
        Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any
        later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even
        the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License
        for more details.""",
    ],
    "AGPL-3.0": [
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General
        Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any
        later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even
        the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License
        for more details.""",
    ],
    "MPL-2.0": [
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
        distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
}

#: Fixed value: characters taken off a word's ends.
PUNCTUATION = ".,;:!?()[]{}\"'`*_<>/-"


#: Words of a notice from which on `long_coverage` will do.
LONG = 20


def words_of(text: str) -> list[str]:
    return [w for w in (x.strip(PUNCTUATION) for x in text.lower().split()) if w]


def increasing(values: list[int]) -> list[int]:
    """Positions of a longest strictly increasing subsequence."""
    tails: list[int] = []
    ends: list[int] = []
    before = [-1] * len(values)
    for i, v in enumerate(values):
        k = bisect_left(tails, v)
        tails[k : k + 1] = [v]
        ends[k : k + 1] = [i]
        before[i] = ends[k - 1] if k else -1
    out, i = [], ends[-1] if ends else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Pairs of positions of equal words, increasing in both."""
    out: list[tuple[int, int]] = []
    stack = [(0, len(a), 0, len(b))]
    while stack:
        a0, a1, b0, b1 = stack.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 >= a1 or b0 >= b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {w: j for j, w in enumerate(b[b0:b1], b0) if in_b[w] == 1}
        once = [(i, place[w]) for i, w in enumerate(a[a0:a1], a0) if in_a[w] == 1 and w in place]
        anchors = [once[k] for k in increasing([j for _, j in once])]
        if not anchors:
            continue
        out += anchors
        edges = [(a0 - 1, b0 - 1), *anchors, (a1, b1)]
        stack += [(i + 1, k, j + 1, n) for (i, j), (k, n) in zip(edges, edges[1:], strict=False)]
    return sorted(out)


class Scanner:
    def __init__(self, notices: dict[str, list[str]], coverage: float, long_coverage: float):
        self.notices = [(name, i, words_of(t)) for name, ts in notices.items() for i, t in enumerate(ts)]
        self.need = [(long_coverage if len(w) >= LONG else coverage) * len(w) for _, _, w in self.notices]
        self.counts = [Counter(w) for _, _, w in self.notices]
        self.vocabulary = {w for _, _, ws in self.notices for w in ws}
        self.sizes = {(name, i): len(w) for name, i, w in self.notices}

    def windows(self, words: list[str], at: list[int], k: int) -> Iterator[tuple[int, int]]:
        """Windows of notice k that could reach its coverage; `at`: positions of the vocabulary's words."""
        counts, n = self.counts[k], len(self.notices[k][2])
        size, step, need = 2 * n, max(1, n // 4), self.need[k]
        own = [i for i in at if words[i] in counts]
        inside: Counter[str] = Counter()
        shared = lo = hi = 0
        coming = 0  # windows are numbered; those before this one are done with
        for i in own:
            for j in range(max(coming, -((size - 1 - i) // step)), i // step + 1):
                start = j * step
                while hi < len(own) and own[hi] < start + size:
                    w = words[own[hi]]
                    inside[w] += 1
                    shared += inside[w] <= counts[w]
                    hi += 1
                while lo < hi and own[lo] < start:
                    w = words[own[lo]]
                    shared -= inside[w] <= counts[w]
                    inside[w] -= 1
                    lo += 1
                if shared >= need:
                    yield start, min(start + size, len(words))
            coming = max(coming, i // step + 1)

    def spans(self, text: str) -> list[tuple[str, float, int, int, int]]:
        """(license, coverage, notice, first word, end word) of every window that covers its notice."""
        words = words_of(text)
        known = self.vocabulary.intersection(words)
        hopeful = [k for k, c in enumerate(self.counts) if sum(n for w, n in c.items() if w in known) >= self.need[k]]
        at = [i for i, w in enumerate(words) if w in known] if hopeful else []
        out = []
        for k in hopeful:
            name, i, notice = self.notices[k]
            for start, end in self.windows(words, at, k):
                pairs = align(words[start:end], notice)
                if pairs and len(pairs) >= self.need[k]:
                    out.append((name, len(pairs) / len(notice), i, start + pairs[0][0], start + pairs[-1][0] + 1))
        return out

    def scan(self, text: str) -> list[tuple[str, float, int, int, int]]:
        """The best span that holds of each license found."""
        best: dict[str, tuple] = {}
        starts: list[int] = []
        ends: list[int] = []  # of the spans that hold, which do not overlap
        worth = lambda f: (6 * f[1] - 5) * self.sizes[f[0], f[2]]
        for f in sorted(set(self.spans(text)), key=lambda f: (-worth(f), f[3] - f[4], f[3], f[0], f[2])):
            i = bisect_left(ends, f[3] + 1)
            if i == len(starts) or starts[i] >= f[4]:
                starts.insert(i, f[3])
                ends.insert(i, f[4])
                best.setdefault(f[0], f)
        return sorted(best.values())


def scan_licenses(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", notices: dict[str, list[str]] | None = None, coverage: float = 0.85, long_coverage: float = 0.7) -> DataFrame:
    """doc_id, license, coverage, notice (its number), first_word and end_word (exclusive) of every license found."""
    notices = NOTICES if notices is None else notices

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(notices, coverage, long_coverage)
        types = [pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64()]
        names = ["doc_id", "license", "coverage", "notice", "first_word", "end_word"]
        for chunk in chunks(batches, 1):
            rows = [(i, *f) for i, t in zip(chunk.column(0).to_pylist(), texts(chunk.column(1)), strict=True) for f in scanner.scan(t)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return small_batches(rows).mapInArrow(run, "doc_id long, license string, coverage double, notice long, first_word long, end_word long")


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))
