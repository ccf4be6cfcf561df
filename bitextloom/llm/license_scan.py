"""Licence scans: word-bigram Dice coefficient against licence templates, pruned by size."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator, Sequence
from math import ceil

import pyarrow as pa
from pyspark.sql import DataFrame

from bitextloom.llm.tables import text_or_empty

THRESHOLD = 0.8

# The public wording of licence notices and short licences.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("MIT notice", "Released under the MIT License."),
    ("Apache-2.0 notice", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0 notice", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0 notice", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0 notice", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        'Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT "
        "SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION "
        "OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE "
        'IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED '
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
        "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER "
        "IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
        "PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "Apache-2.0 header",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the '
        "specific language governing permissions and limitations under the License.",
    ),
    (
        "GPL-3.0-or-later header",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public "
        "License for more details. You should have received a copy of the GNU General Public License along with this "
        "program. If not, see https://www.gnu.org/licenses/.",
    ),
    ("MIT notice", "This project is licensed under the MIT License."),
    ("MIT notice", "This software is distributed under the terms of the MIT license."),
    ("MIT notice", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0 notice", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0 notice", "This project is licensed under the Apache License 2.0."),
    ("Apache-2.0 notice", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD notice", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("GPL-2.0 notice", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-SA-4.0 notice", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0 notice", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    (
        "MPL-2.0 header",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    (
        "GPL-2.0-or-later header",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any "
        "later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public "
        "License for more details. You should have received a copy of the GNU General Public License along with this "
        "program; if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA "
        "02110-1301 USA.",
    ),
    (
        "AGPL-3.0-or-later header",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
        "any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; "
        "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero "
        "General Public License for more details. You should have received a copy of the GNU Affero General Public License "
        "along with this program. If not, see https://www.gnu.org/licenses/.",
    ),
    (
        "LGPL-2.1-or-later header",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your "
        "option) any later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU "
        "Lesser General Public License for more details. You should have received a copy of the GNU Lesser General Public "
        "License along with this library; if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth "
        "Floor, Boston, MA 02110-1301 USA.",
    ),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
        'with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS '
        "OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
        "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
        "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
        "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
        "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR "
        "OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
        "with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used "
        "to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE "
        'IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, '
        "BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. "
        "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, "
        "EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; "
        "LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN "
        "CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
        "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ),
    (
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software. Permission is granted to anyone to use this software "
        "for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the "
        "following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you "
        "wrote the original software. If you use this software in a product, an acknowledgment in the product documentation "
        "would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not "
        "be misrepresented as being the original software. 3. This notice may not be removed or altered from any source "
        "distribution.",
    ),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
        "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
        "purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the "
        "author or authors of this software dedicate any and all copyright interest in the software to the public domain. "
        "We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. "
        "We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to "
        "this software under copyright law.",
    ),
    (
        "BSL-1.0",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
        'accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, '
        "execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to "
        "whom the Software is furnished to do so, all subject to the following: The copyright notices in the Software and "
        "this entire statement, including the above license grant, this restriction and the following disclaimer, must be "
        "included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such "
        "copies or derivative works are solely in the form of machine-executable object code generated by a source language "
        "processor.",
    ),
)

# Words are runs of ASCII letters and digits and of all other characters but ASCII punctuation and white space.
WORDS = re.compile("[0-9a-z\x80-\U0010ffff]+")
LOWER = {c: c + 32 for c in range(65, 91)}
LEVELS = ("line", "block", "text", "window")
SCHEMA = "license string, level string, position int, n_bigrams int, dice double"


def words(text: str) -> list[str]:
    """Normalised text: A-Z lower-cased, punctuation and white space are breaks."""
    return WORDS.findall(text.translate(LOWER))


def bigrams(tokens: list[str]) -> set[tuple[str, str]]:
    return set(zip(tokens, tokens[1:]))


class Templates:
    """Templates in the order of their sizes in bigrams, and which of them hold a bigram.

    2 min(a, b) / (a + b) >= t bounds b by a: from a t / (2 - t) to a (2 - t) / t. So the templates that a set of some size can
    match are neighbours, found by halving.
    """

    def __init__(self, templates: Sequence[tuple[str, str]], threshold: float) -> None:
        self.threshold, self.ratio = threshold, threshold / (2 - threshold)
        found = [(name, words(text)) for name, text in templates]
        ordered = sorted(((name, bigrams(w), len(w)) for name, w in found if len(w) > 1), key=lambda t: len(t[1]))
        self.sets = [(name, own) for name, own, _ in ordered]
        self.sizes, self.lengths = [len(own) for _, own in self.sets], [length for _, _, length in ordered]
        self.holders: dict[tuple[str, str], list[int]] = {}
        for number, (_, own) in enumerate(self.sets):
            for gram in own:
                self.holders.setdefault(gram, []).append(number)
        self.least = self.sizes[0] * self.ratio - 1e-9 if self.sizes else float("inf")

    def dice(self, size: int, common: int, number: int) -> float:
        return 2 * common / (size + self.sizes[number])

    def matches(self, tokens: list[str]) -> Iterator[tuple[str, int, float]]:
        # There are fewer bigrams than words; only then are they worth making.
        if len(tokens) - 1 < self.least:
            return
        own = bigrams(tokens)
        low, high = bisect_left(self.sizes, len(own) * self.ratio - 1e-9), bisect_right(self.sizes, len(own) / self.ratio + 1e-9)
        for number in range(low, high):
            name, template = self.sets[number]
            dice = self.dice(len(own), len(own & template), number)
            if dice >= self.threshold:
                yield name, len(own), dice

    def windows(self, tokens: list[str]) -> Iterator[tuple[str, int, int, float]]:
        """(license, first word, bigrams, dice) of the best among windows that overlap, each of as many words as its template.

        A window that matches has at least t / (2 - t) of the template's bigrams, so only starts with that many hits ahead are
        looked at; elsewhere one look-up a word is all.
        """
        hits: dict[int, list[int]] = {}
        grams = list(zip(tokens, tokens[1:]))
        for place, gram in enumerate(grams):
            for number in self.holders.get(gram, ()):
                hits.setdefault(number, []).append(place)
        for number, places in sorted(hits.items()):
            length, needed = self.lengths[number], ceil(self.sizes[number] * self.ratio - 1e-9)
            if len(places) < needed or len(tokens) <= length:
                continue
            good = [found for low, high in dense_starts(places, needed, length, len(tokens)) for found in self.slide(grams, number, low, high)]
            for island in islands(good, length):
                dice, start, size = max(island, key=lambda g: (g[0], -g[1]))
                yield self.sets[number][0], start, size, dice

    def slide(self, grams: list[tuple[str, str]], number: int, low: int, high: int) -> Iterator[tuple[float, int, int]]:
        """(dice, start, bigrams) of the windows that start in [low, high] and reach the threshold."""
        template, width = self.sets[number][1], self.lengths[number] - 1
        held = Counter(grams[low : low + width])
        common = sum(gram in template for gram in held)
        for start in range(low, high + 1):
            dice = self.dice(len(held), common, number)
            if dice >= self.threshold:
                yield dice, start, len(held)
            if start < high:
                gone, new = grams[start], grams[start + width]
                held[gone] -= 1
                if not held[gone]:
                    del held[gone]
                    common -= gone in template
                held[new] += 1
                common += held[new] == 1 and new in template


def dense_starts(places: list[int], needed: int, length: int, n: int) -> list[tuple[int, int]]:
    """Merged ranges of starts whose window of `length` words has `needed` of the places or more."""
    ranges: list[list[int]] = []
    for first, last in zip(places, places[needed - 1 :]):
        low, high = max(0, last - length + 2), min(first, n - length)
        if low <= high:
            if ranges and low <= ranges[-1][1] + 1:
                ranges[-1][1] = max(ranges[-1][1], high)
            else:
                ranges.append([low, high])
    return [tuple(r) for r in ranges]


def islands(good: list[tuple[float, int, int]], length: int) -> list[list[tuple[float, int, int]]]:
    """Windows by start, in groups of which neighbours overlap."""
    groups: list[list[tuple[float, int, int]]] = []
    for window in good:
        if groups and window[1] - groups[-1][-1][1] <= length:
            groups[-1].append(window)
        else:
            groups.append([window])
    return groups


def units(text: str) -> Iterator[tuple[str, int, list[str]]]:
    """(level, position, words): each line, each block of several lines between blank ones, the text of several blocks."""
    lines = [words(line) for line in text.split("\n")]
    blocks: list[list[int]] = [[]]
    for i, line in enumerate(lines):
        if line:
            yield "line", i, line
            blocks[-1].append(i)
        elif blocks[-1]:
            blocks.append([])
    blocks = [b for b in blocks if b]
    for number, block in enumerate(blocks):
        if len(block) > 1:
            yield "block", number, [w for i in block for w in lines[i]]
    if len(blocks) > 1:
        yield "text", 0, [w for line in lines for w in line]


def scan_licenses(docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """One row per match: doc_id, license, level (line, block, text, window), position of the unit, n_bigrams, dice.

    A unit matches each template with Dice >= `threshold` over sets of word bigrams; every level speaks for itself, so a
    block may match and the whole text too. A window has as many words as the template and stands anywhere in the text, across
    lines and blocks; of windows that overlap the best counts, the first of equals, and its position is its first word. So a licence of
    several paragraphs amid code is found, and a notice inside a longer line. Several wordings of a licence are templates
    each. Null and empty texts, texts
    without words and units of one word match nothing; repeated rows give repeated matches. One narrow
    pass: the templates are a parameter and travel with the tasks.
    """
    known = Templates(templates, threshold)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, found = [], []
            for row, text in enumerate(batch.column("text").to_pylist()):
                whole = []
                for level, position, tokens in units(text):
                    if level == "line":
                        whole += tokens
                    for name, size, dice in known.matches(tokens):
                        rows.append(row)
                        found.append((name, level, position, size, dice))
                for name, position, size, dice in known.windows(whole):
                    rows.append(row)
                    found.append((name, "window", position, size, dice))
            columns = list(zip(*found)) or [()] * 5
            kinds = (pa.string(), pa.string(), pa.int32(), pa.int32(), pa.float64())
            arrays = [batch.column("doc_id").take(pa.array(rows, pa.int32())), *map(pa.array, columns, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "license", "level", "position", "n_bigrams", "dice"])

    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(scan, f"doc_id {kind}, {SCHEMA}")
