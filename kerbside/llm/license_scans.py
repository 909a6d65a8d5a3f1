"""License scans: Dice coefficient over word bigrams against templates, pruned by size bounds.

Segments that the layout gives (lines, paragraphs, the whole text) are compared as they are. A notice that spans
paragraphs, or stands inside a line or a file, is no such segment; so each template also looks for the windows of words
that suit it best. A window of n bigrams, c of them the template's, reaches a Dice coefficient t with a template of
size s just if 2c - t n >= t s. So every bigram counts 2 - t if it is the template's and -t if not, and the windows are
the segments of maximal sum, which start and end where the template's bigrams are dense.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import limit_batches, pick
from kerbside.llm.text_arrays import byte_table, chunks, flags, joined, words_of

DICE = 0.75

# The customary notices of public licences, and their one-line forms.
BSD_DISCLAIMER = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the '
        "specific language governing permissions and limitations under the License.",
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
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
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU "
        "General Public License for more details.",
    ),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    (
        "GPL-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU "
        "General Public License for more details.",
    ),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    (
        "AGPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU "
        "Affero General Public License for more details.",
    ),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    (
        "LGPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU "
        "Lesser General Public License for more details.",
    ),
    (
        "LGPL-2.1",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at "
        "your option) any later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU "
        "Lesser General Public License for more details.",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
        "with the distribution.",
    ),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
        "with the distribution. " + BSD_DISCLAIMER,
    ),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
        "with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used "
        "to endorse or promote products derived from this software without specific prior written permission. "
        + BSD_DISCLAIMER,
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
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("proprietary", "All rights reserved."),
)

MATCHES = "doc_id long, license string, level string, first_line int, last_line int, bigrams int, dice double"
_LOWER = byte_table()
#: Words are letters and digits; bytes of other scripts belong to words.
_GAP = flags((0, 47), (58, 64), (91, 96), (123, 127))


class Templates:
    """Bigram sets of templates, by size."""

    def __init__(self, templates: Sequence[tuple[str, str]], least: float):
        self.least = least
        rows = []
        for name, text in templates:
            data = np.frombuffer(text.encode(), np.uint8)
            words = words_of(data, np.array([0, len(data)]), _LOWER, _GAP)
            grams = np.unique(joined(words.hashes, 2))
            if len(grams):
                rows.append((len(grams), name, grams))
        rows.sort(key=lambda row: row[:2])
        self.sizes = [row[0] for row in rows]
        self.rows = rows
        self.grams = np.unique(np.concatenate([row[2] for row in rows])) if rows else np.zeros(0, np.uint64)
        # Dice >= t needs an overlap of t / (2 - t) of either side at least.
        self.ratio = least / (2 - least)
        self.fewest = self.ratio * self.sizes[0] if rows else 1
        self.largest = self.sizes[-1] / self.ratio if rows else 0

    def known(self, grams: np.ndarray) -> np.ndarray:
        if not len(self.grams):
            return np.zeros(len(grams), bool)
        places = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1)
        return self.grams[places] == grams

    def best(self, grams: np.ndarray) -> tuple[float, str, int, int] | None:
        """(dice, name, size, common bigrams) of the most similar template, of equals the first by size and name."""
        size, found = len(grams), None
        at = bisect.bisect_left(self.sizes, size * self.ratio - 1e-9)
        while at < len(self.rows) and self.sizes[at] * self.ratio <= size + 1e-9:
            other, name, template = self.rows[at]
            common = len(np.intersect1d(grams, template, assume_unique=True))
            dice = 2 * common / (size + other)
            if dice >= self.least and (found is None or dice > found[0]):
                found = (dice, name, size, common)
            at += 1
        return found


    def windows(self, grams: np.ndarray, hits: np.ndarray) -> Iterator[tuple[int, float, int, int, int, str]]:
        """(common bigrams, dice, first word, end word, size, name) of windows of one text; ``hits`` are the places of known bigrams."""
        known = grams[hits]
        for size, name, template in self.rows:
            places = np.minimum(np.searchsorted(template, known), size - 1)
            own = hits[template[places] == known]
            if len(own) < self.ratio * size - 1e-9:
                continue
            for a, b in _maximal(own, 2 - self.least, self.least):
                window = np.unique(grams[a:b])
                common = len(np.intersect1d(window, template, assume_unique=True))
                dice = 2 * common / (len(window) + size)
                if dice >= self.least:
                    yield common, dice, a, b + 1, len(window), name


def _maximal(places: np.ndarray, gain: float, loss: float) -> list[tuple[int, int]]:
    """(first, end) of all maximal segments, where the places count ``gain`` and all others minus ``loss``.

    Each place is looked at once: segments are merged into the one before as long as that raises the sum.
    """
    done: list[tuple[float, float, int, int]] = []  # sum before, sum after, first, end
    total, last = 0.0, int(places[0])
    for place in places.tolist():
        total -= loss * (place - last)
        one = (total, total + gain, place, place + 1)
        total, last = total + gain, place + 1
        while done:
            at = len(done) - 1
            while at >= 0 and done[at][0] >= one[0]:
                at -= 1
            if at < 0 or done[at][1] >= one[1]:
                break
            one = (done[at][0], one[1], done[at][2], one[3])
            del done[at:]
        done.append(one)
    return [(first, end) for _, _, first, end in done]


def _matches(templates: Templates):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for first, end, data, offsets in chunks(batch.column(1)):
                out += _of_chunk(templates, batch.column(0).slice(first, end - first), data, offsets)
            if out:
                kinds = (pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.float64())
                columns = [pa.array(column, kind) for column, kind in zip(zip(*out), kinds)]
                names = [part.split(" ")[0] for part in MATCHES.split(", ")]
                yield pa.record_batch(columns, names=names)

    return run


def _of_chunk(templates: Templates, ids: pa.Array, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple]:
    words = words_of(data, offsets, _LOWER, _GAP)
    if len(words.hashes) < 2:
        return
    breaks = np.concatenate(([0], np.cumsum(data == 10)))
    lines = breaks[words.starts] + words.rows  # numbers rise over texts as well
    blank = np.zeros(len(data) + 1, np.int64)
    # A blank line: a line end whose line holds nothing but white space.
    ends = np.flatnonzero(data == 10)
    if len(ends):
        begins = np.concatenate(([0], ends[:-1] + 1))
        begins = np.maximum(begins, offsets[np.searchsorted(offsets, ends, "right") - 1])
        seen = np.concatenate(([0], np.cumsum(data > 32)))
        blank[ends[seen[ends] == seen[begins]] + 1] = 1
    paragraphs = np.cumsum(blank)[words.starts] + words.rows
    grams = joined(words.hashes, 2)
    hit = templates.known(grams)
    levels = (("line", lines), ("paragraph", paragraphs), ("text", words.rows))
    seen_before: set[tuple[int, int]] = set()
    segments: dict[int, list[tuple[int, int, tuple[int, float]]]] = {}

    def matched(a: int, b: int, level: str, name: str, size: int, dice: float) -> tuple:
        row = int(words.rows[a])
        zero = int(breaks[offsets[row]]) + row
        return (ids[row].as_py(), name, level, int(lines[a]) - zero, int(lines[b - 1]) - zero, size, dice)

    for level, group in levels:
        starts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
        ends_ = np.concatenate((starts[1:], [len(group)]))
        hits = np.concatenate(([0], np.cumsum(hit)))
        counts = hits[np.maximum(ends_ - 1, starts)] - hits[starts]
        for at in np.flatnonzero(counts >= templates.fewest - 1e-9).tolist():
            a, b = int(starts[at]), int(ends_[at])
            if (a, b) in seen_before:
                continue
            seen_before.add((a, b))
            found = templates.best(np.unique(grams[a : b - 1]))
            if found:
                segments.setdefault(int(words.rows[a]), []).append((a, b, (found[3], found[0])))
                yield matched(a, b, level, found[1], found[2], found[0])
    # Bigrams across two texts belong to none.
    grams[words.rows[1:] != words.rows[:-1]] = 0
    hits = np.flatnonzero(templates.known(grams))
    texts = words.rows[hits]
    counts = np.bincount(texts, minlength=len(offsets) - 1)
    for row in np.flatnonzero(counts >= templates.fewest - 1e-9).tolist():
        at = hits[np.searchsorted(texts, row) : np.searchsorted(texts, row, "right")]
        taken = segments.get(row, [])
        for common, dice, a, b, size, name in sorted(templates.windows(grams, at), key=lambda w: (-w[0], -w[1], w[2:])):
            # What overlaps a better segment or window is the same notice, or a part of it.
            if not any(a < end and start < b and (common, dice) <= other for start, end, other in taken):
                taken.append((a, b, (common, dice)))
                yield matched(a, b, "window", name, size, dice)


def scan_licenses(
    docs: DataFrame,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    least: float = DICE,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(doc_id, license, level, first_line, last_line, bigrams, dice): segments that are licence notices.

    Texts are compared as words in lower case, without marks. Segments are every line, every paragraph
    (lines between blank lines) and the whole text; a segment that equals one of a lower level is not
    repeated. Level ``window`` has windows of words, over lines and paragraphs and within them, that share more
    bigrams with a template, or as many at a higher coefficient, than every segment and window they overlap. A segment is compared with the templates whose number of bigrams allows a Dice
    coefficient of ``least``, and only if enough of its bigrams occur in any template; the best template
    counts, of equals the smaller one, then the first by name. Lines count from 0.

    Null or empty texts, and segments of fewer than two words, match nothing. Repeated rows match
    repeatedly; a null id is kept. Texts are read whole. Without templates, or on an empty table,
    there are no rows. Other columns are not looked at.
    """
    docs = pick(docs, doc_id=doc_id, text=text).select(F.col("doc_id").cast("long"), "text")
    limit_batches(docs.sparkSession)
    return docs.mapInArrow(_matches(Templates(templates, least)), MATCHES)
