"""License scans: winnowed template fingerprints, then banded alignment.

Templates are cut into words (lower-cased letters and digits). The smallest of
every ``WINDOW`` consecutive hashes of ``K`` words is a fingerprint in an
inverted index fingerprint -> (template, place); of a template of fewer than
``SHORT`` words every pair of neighbours is one. The index is a parameter of
bounded size and travels with the tasks. A document's grams are looked up in
it. Hits of one template on nearby diagonals form a candidate region, which is
aligned with the template word by word inside a band of ``BAND`` diagonals (a
quarter of the template's words, if that is less) around the hits: the alignment maximises matching words, and among those of
equal matches takes the shortest span. Regions whose matched words reach
``coverage`` of the template are reported with their spans.

What is found for certain: a region that holds two neighbouring words of a
short template, or ``K + WINDOW - 1`` = 5 of a longer one, in a row. With a
fifth of the words replaced a short template always keeps such a pair (fewer
than half of its pairs can go); of the longer ones every run of 20 words with
at most three replaced does. Only a short template whose words are all kept
apart by others can be missed.

Scale: one scan of whole texts, no shuffle; work per document grows with its
words and hits. A license that a third of the documents carry costs each of
them its own alignment.

Defined results: null, empty and word-less texts match nothing; a row per
match, so repeated rows are reported each; a match found inside a longer match
that covers more words of another template is reported as well; an empty table
gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from corvid.llm.common import WordIds, gram_hashes, raw_bytes, slices, text_frame

K, WINDOW, BAND, SHORT = 3, 3, 12, 15
OUT = "doc_id long, license string, start long, end long, matched long, template_words long, " \
      "coverage double"

#: notices and license texts to look for (fixed values)
TEMPLATES = {
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "all-rights-reserved": "All rights reserved.",
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this
software and associated documentation files (the "Software"), to deal in the Software without
restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions: The above copyright notice and
this permission notice shall be included in all copies or substantial portions of the Software.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or
without fee is hereby granted, provided that the above copyright notice and this permission notice
appear in all copies.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification,
are permitted provided that the following conditions are met: 1. Redistributions of source code must
retain the above copyright notice, this list of conditions and the following disclaimer. 2.
Redistributions in binary form must reproduce the above copyright notice, this list of conditions and
the following disclaimer in the documentation and/or other materials provided with the
distribution.""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this
file except in compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing,
software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR
CONDITIONS OF ANY KIND, either express or implied.""",
    "GPL-3.0": """This program is free software: you can redistribute it and/or modify it under the terms
of the GNU General Public License as published by the Free Software Foundation, either version 3 of
the License, or (at your option) any later version.""",
    "ISC-whole": """Permission to use, copy, modify, and/or distribute this software for any purpose
with or without fee is hereby granted, provided that the above copyright notice and this permission
notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES
WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO
EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY
DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE.""",
    "MIT-whole": """Permission is hereby granted, free of charge, to any person obtaining a copy of
this software and associated documentation files (the "Software"), to deal in the Software without
restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions: The above copyright notice and
this permission notice shall be included in all copies or substantial portions of the Software. THE
SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.
IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION
WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "Unlicense": """This is free and unencumbered software released into the public domain. Anyone is
free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code
form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event
will the authors be held liable for any damages arising from the use of this software. Permission is
granted to anyone to use this software for any purpose, including commercial applications, and to
alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this
software must not be misrepresented; you must not claim that you wrote the original software. If you
use this software in a product, an acknowledgment in the product documentation would be appreciated
but is not required. 2. Altered source versions must be plainly marked as such, and must not be
misrepresented as being the original software. 3. This notice may not be removed or altered from any
source distribution.""",
}


def words_of(data: bytes | None) -> list[bytes]:
    import re

    return re.findall(rb"[0-9a-z\x80-\xff]+", (data or b"").lower())


def gram_size(words: int) -> int:
    return min(2, words) if words < SHORT else K


def fingerprints(ids) -> list[tuple[int, int]]:
    """(hash, place) of the winnowed grams of a template, of all its grams if
    it is short."""
    grams = gram_hashes(ids, gram_size(len(ids)))
    if len(ids) < SHORT:
        return [(int(g), j) for j, g in enumerate(grams)]
    width = min(WINDOW, len(grams))
    places = {min(range(i, i + width), key=lambda j: (grams[j], j))
              for i in range(len(grams) - width + 1)}
    return [(int(grams[j]), j) for j in sorted(places)]


def align(template: list, words: list, start: int, end: int, low: int, high: int):
    """(matched, first, last): most template words that can be matched in order
    with ``words[start:end]`` on diagonals low..high (word minus template
    place), and the tightest span [first, last) among these."""
    best, rank = (0, 0, 0), (0, 0)
    width = high - low + 1
    # cell d of a row: best (matches, first matched word) up to word i + low + d
    row = [(0, 0)] * width
    for i, t in enumerate(template):
        new = [(0, 0)] * width
        for d in range(width):
            at = i + low + d
            up = row[d + 1] if d + 1 < width else (0, 0)  # template word unmatched
            left = new[d - 1] if d else (0, 0)            # document word unmatched
            cell = max(up, left)
            if start <= at < end and words[at] == t:
                count, first = row[d]
                here = (count + 1, first if count else at)
                cell = max(cell, here)
                if (here[0], here[1] - at) > rank:
                    best, rank = (here[0], here[1], at + 1), (here[0], here[1] - at)
            new[d] = cell
        row = new
    return best


def band(size: int) -> int:
    return min(BAND, max(2, size // 4))


def regions(hits: list[tuple[int, int]], size: int):
    """Hits (word, place) of one template grouped: a group's diagonals stay
    within the band of its first and its words within one template length."""
    open_groups: list[list] = []
    for word, place in sorted(hits):
        diagonal = word - place
        for group in reversed(open_groups):
            if abs(diagonal - group[0]) <= band(size) and word - group[2] <= size:
                group[1].append(diagonal)
                group[2] = word
                break
        else:
            open_groups.append([diagonal, [diagonal], word])
    return [(min(g[1]), max(g[1])) for g in open_groups]


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None,
                  id_col: str = "doc_id", text_col: str = "text",
                  coverage: float = 0.8) -> DataFrame:
    """A row per match: doc_id, license, [start, end) in words, matched words,
    words of the template, coverage."""
    texts = {k: words_of(v.encode()) for k, v in (templates or TEMPLATES).items()}
    texts = {k: v for k, v in texts.items() if v}

    def run(batches):
        from collections import defaultdict

        import numpy as np
        import pyarrow as pa

        known = WordIds()
        index: dict = defaultdict(list)
        sizes = sorted({gram_size(len(v)) for v in texts.values()})
        for name, words in texts.items():
            for value, place in fingerprints(known.of(words)):
                index[gram_size(len(words)), value].append((name, place))
        sieve = np.zeros(1 << 16, bool)
        for _, value in index:
            sieve[value & 0xFFFF] = True
        for batch in slices(batches):
            rows = []
            for doc_id, data in zip(batch.column("doc_id").to_pylist(), raw_bytes(batch)):
                words = words_of(data)
                ids, hits = known.of(words), defaultdict(list)
                for k in sizes:
                    grams = gram_hashes(ids, k)
                    for at in np.flatnonzero(sieve[grams & np.uint64(0xFFFF)]).tolist():
                        for name, place in index.get((k, int(grams[at])), ()):
                            hits[name].append((at, place))
                for name, found in hits.items():
                    template, seen = texts[name], set()
                    for low, high in regions(found, len(template)):
                        wide = band(len(template))
                        match = align(template, words, max(0, low - wide),
                                      min(len(words), high + len(template) + wide),
                                      low - wide, high + wide)
                        if match[0] >= coverage * len(template) and match not in seen:
                            seen.add(match)
                            rows.append((doc_id, name, match[1], match[2], match[0],
                                         len(template), match[0] / len(template)))
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(),
                     pa.float64())
            names = [x.split()[0] for x in OUT.split(", ")]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names)

    return text_frame(docs, id_col, text_col).mapInArrow(run, OUT)
