"""Licence scan: passages compared to licence templates by Dice over word bigrams.

Texts and templates are lower-cased words. A passage is any run of sentences in a
row, so that a notice is found inside other text or next to another one and a
whole licence as one piece; its words are at most ``STRETCH`` times its
template's. Two sets of sizes a and b can reach a Dice coefficient t only if b
lies between a*t/(2-t) and a*(2-t)/t, and then share at least b*t/(2-t), so a
template is compared only with texts and windows that share as many of its
bigrams. Of all passages that reach the threshold those are kept that do not
overlap and together exceed it by the most bigrams.
The scan is a narrow step: one pass over the texts, nothing is shuffled.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from importlib import resources

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import ID, TEXT, text_or_empty

THRESHOLD = 0.8
STRETCH = 2
WORD = re.compile(r"\w+")
SENTENCE = re.compile(r"[^\n]*?(?:[.!?](?=\s|$)|\n|$)")

# Fixed: wordings of public licences and of the notices that name them.
NOTICES = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This project is licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, "
        "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in "
        "all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", "
        "WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN "
        "NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR "
        "OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT "
        "OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Released under the Apache License 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
        "file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed "
        "to in writing, software distributed under the License is distributed on an \"AS IS\" "
        "BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the "
        "License for the specific language governing permissions and limitations under the "
        "License.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License v3.0.",
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version. This program is "
        "distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even "
        "the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
        "GNU General Public License for more details. You should have received a copy of the GNU "
        "General Public License along with this program. If not, see "
        "<https://www.gnu.org/licenses/>.",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation; either "
        "version 2 of the License, or (at your option) any later version.",
    ),
    "LGPL-3.0": (
        "This work is licensed under the GNU Lesser General Public License, version 3.",
    ),
    "AGPL-3.0": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
    ),
    "BSD-3-Clause": (
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met: 1. Redistributions of source "
        "code must retain the above copyright notice, this list of conditions and the following "
        "disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation "
        "and/or other materials provided with the distribution. 3. Neither the name of the "
        "copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission.",
    ),
    "BSD-2-Clause": (
        "Released under the BSD 2-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met: 1. Redistributions of source "
        "code must retain the above copyright notice, this list of conditions and the following "
        "disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation "
        "and/or other materials provided with the distribution.",
    ),
    "ISC": (
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with "
        "or without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies.",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If "
        "a copy of the MPL was not distributed with this file, You can obtain one at "
        "https://mozilla.org/MPL/2.0/.",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain.",
    ),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International "
        "License.",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 "
        "International License.",
    ),
    "CC0-1.0": ("This work is released under CC0 1.0 Universal.",),
}

# Whole texts, in files of their names.
TEXTS = (
    "Apache-2.0", "GPL-3.0", "GPL-2.0", "LGPL-3.0", "LGPL-2.1", "LGPL-2.0", "MPL-2.0", "CC0-1.0",
    "Unlicense",
)

DISCLAIMER = (
    " THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS "
    "OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF "
    "MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE "
    "COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, "
    "EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
    "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED "
    "AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING "
    "NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED "
    "OF THE POSSIBILITY OF SUCH DAMAGE."
)
ISC_DISCLAIMER = (
    " THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS "
    "SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL "
    "THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY "
    "DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF "
    "CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE "
    "OR PERFORMANCE OF THIS SOFTWARE."
)
# The notice of version 2 and its relatives; {0} the work, {1} the licence, {2} the version.
OLDER_GNU = (
    "This {0} is free software; you can redistribute it and/or modify it under the terms of the "
    "GNU {1} as published by the Free Software Foundation; either version {2} of the License, or "
    "(at your option) any later version. This {0} is distributed in the hope that it will be "
    "useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or "
    "FITNESS FOR A PARTICULAR PURPOSE. See the GNU {1} for more details. You should have received "
    "a copy of the GNU {1} along with this {0}; if not, write to the Free Software Foundation, "
    "Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA."
)
GENERAL = "General Public License"
AFFERO_13 = (
    "13. Remote Network Interaction; Use with the GNU General Public License. Notwithstanding any "
    "other provision of this License, if you modify the Program, your modified version must "
    "prominently offer all users interacting with it remotely through a computer network (if your "
    "version supports such interaction) an opportunity to receive the Corresponding Source of your "
    "version by providing access to the Corresponding Source from a network server at no charge, "
    "through some standard or customary means of facilitating copying of software. This "
    "Corresponding Source shall include the Corresponding Source for any work covered by version 3 "
    "of the GNU General Public License that is incorporated pursuant to the following paragraph."
)


def _all_templates() -> dict[str, tuple[str, ...]]:
    """The notices, then the longer wordings and the whole texts of the same licences."""
    found = {name: list(texts) for name, texts in NOTICES.items()}

    def add(name: str, text: str) -> None:
        found.setdefault(name, []).append(text)

    program = NOTICES["GPL-3.0"][-1]
    for name, kind in (("LGPL-3.0", "Lesser"), ("AGPL-3.0", "Affero")):
        notice = program.replace(f"GNU {GENERAL}", f"GNU {kind} {GENERAL}")
        add(name, notice)
        add(name, notice.split(" This program is distributed")[0])
    for name, work, kind, version in (
        ("GPL-2.0", "program", "", "2"),
        ("LGPL-2.1", "library", "Lesser ", "2.1"),
        ("LGPL-2.0", "library", "Library ", "2"),
    ):
        notice = OLDER_GNU.format(work, kind + GENERAL, version)
        add(name, notice)
        if name != "GPL-2.0":  # its first sentence is among the notices
            add(name, notice.split(f" This {work} is distributed")[0])
    add("GPL-3.0", program.split(" This program is distributed")[0])
    for name in ("BSD-3-Clause", "BSD-2-Clause"):
        add(name, NOTICES[name][-1] + DISCLAIMER)
    add("ISC", NOTICES["ISC"][-1] + ISC_DISCLAIMER)
    folder = resources.files("clickloom.llm") / "licences"
    for name in TEXTS:
        add(name, (folder / f"{name}.txt").read_text("utf-8"))
    # The Affero text is made from that of version 3: another name and another section 13.
    start, _, end = found["GPL-3.0"][-1].partition("  13. Use with the GNU Affero")
    start, end = (re.sub(rf"GNU\s+{GENERAL}|GNU GENERAL PUBLIC LICENSE", f"GNU Affero {GENERAL}", part)
                  for part in (start, end.partition("  14. ")[2]))
    add("AGPL-3.0", f"{start}  {AFFERO_13}\n\n  14. {end}")
    return {name: tuple(texts) for name, texts in found.items()}


TEMPLATES = _all_templates()


def words_of(text: str) -> list[str]:
    """Words of the normalised text; ``licence`` is spelt ``license``."""
    return WORD.findall(text.lower().replace("licence", "license"))


def bigrams(text: str) -> set[tuple[str, str]]:
    """Neighbouring words of the normalised text."""
    words = words_of(text)
    return set(zip(words, words[1:]))


class Templates:
    """Templates in order of size, and a row of flags each over the bigrams that any has."""

    def __init__(self, texts: dict[str, tuple[str, ...]], threshold: float):
        rows = [(bigrams(t), name, k) for name, ts in texts.items() for k, t in enumerate(ts)]
        self.rows = sorted(((len(b), name, k, b) for b, name, k in rows), key=lambda r: r[:3])
        self.sizes = [r[0] for r in self.rows]
        self.threshold = threshold
        self.number: dict[tuple[str, str], int] = {}
        for row in self.rows:
            for pair in sorted(row[3]):
                self.number.setdefault(pair, len(self.number))
        self.has = np.zeros((len(self.rows), len(self.number) + 1), bool)  # the last: unknown
        for flags, row in zip(self.has, self.rows):
            flags[[self.number[pair] for pair in row[3]]] = True
        sizes = np.array(self.sizes)
        self.need = np.where(sizes > 0, np.ceil(sizes * threshold / (2 - threshold) - 1e-9), np.inf)
        self.reach = [STRETCH * len(words_of(texts[r[1]][r[2]])) for r in self.rows]

    def best(self, own: set) -> tuple[float, str, int] | None:
        """The template of the largest coefficient, if it reaches the threshold; ties by name."""
        low = len(own) * self.threshold / (2 - self.threshold) - 1e-9
        high = len(own) * (2 - self.threshold) / self.threshold + 1e-9
        found = None
        for at in range(bisect_left(self.sizes, low), bisect_right(self.sizes, high)):
            size, name, k, template = self.rows[at]
            if not size:
                continue
            dice = 2 * len(own & template) / (len(own) + size)
            if dice >= self.threshold and (found is None or (-dice, name, k) < found):
                found = (-dice, name, k)
        return found and (-found[0], found[1], found[2])

    def scan(self, text: str) -> list[tuple[int, int, str, int, float]]:
        """(start, end, licence, template, dice) of the passages, in order."""
        parts, first, words = [], [], []
        for m in SENTENCE.finditer(text):
            own = words_of(m[0])
            if own:
                parts.append(m.span())
                first.append(len(words))
                words += own
        pairs = list(zip(words, words[1:]))
        known = list({n for n in map(self.number.get, pairs) if n is not None})
        rows = np.flatnonzero(self.has[:, known].sum(1) >= self.need)
        if not len(rows):
            return []
        out = []
        for i, j in self._passages(pairs, np.array([*first, len(words)]), rows):
            start, end = parts[i][0], parts[j][1]
            hit = self.best(bigrams(text[start:end]))
            if hit:
                out.append(self._row(text, start, end, hit))
        return out

    def _passages(self, pairs: list, first: np.ndarray, rows: np.ndarray) -> list[tuple[int, int]]:
        """First and last part of the passages that exceed the threshold by the most in sum.

        From the last part to the first: the best sum from a part on is that from
        the next part on, or that of a passage from here and of what is behind it.
        A passage starts with a part that has bigrams of its template, as it would
        score no less without it.
        """
        t, parts, total = self.threshold, len(first) - 1, len(pairs)
        before, last = np.empty(total, "i8"), {}
        for n, pair in enumerate(pairs):
            before[n] = last.get(pair, -1)
            last[pair] = n
        unknown = len(self.number)
        codes = np.fromiter((self.number.get(pair, unknown) for pair in pairs), "i8", total)
        starts = []
        for row in rows:
            hits = self.has[row][codes]
            so_far = np.concatenate([[0], np.cumsum(hits)])
            left = so_far[np.minimum(first[:-1], total)]
            here = so_far[np.minimum(first[1:], total)] - left
            ahead = so_far[np.minimum(first[:-1] + self.reach[row], total)] - left
            starts.append((here > 0) & (ahead >= self.need[row]))
        sums, chosen = np.zeros(parts + 1), [None] * parts
        for i in range(parts - 1, -1, -1):
            sums[i] = sums[i + 1]
            for row, can in zip(rows, starts):
                if not can[i]:
                    continue
                begin = first[i]
                end = min(begin + self.reach[row], total)
                behind = np.searchsorted(first, end + 1, "right")
                ends = np.arange(i + 1, behind)  # the part behind the passage
                ends = ends[first[ends] - 1 > begin]
                if not len(ends):
                    continue
                new = before[begin:end] < begin
                at = first[ends] - 2 - begin
                size = np.cumsum(new)[at]
                shared = np.cumsum(new & self.has[row][codes[begin:end]])[at]
                over = 2 * shared - t * (size + self.sizes[row])
                found = np.where(over >= -1e-9, over + 1e-6 + sums[ends], -1.0)
                top = found.argmax()
                if found[top] > sums[i]:
                    sums[i], chosen[i] = found[top], ends[top]
        out, i = [], 0
        while i < parts:
            if chosen[i] is None:
                i += 1
            else:
                out.append((i, chosen[i] - 1))
                i = chosen[i]
        return out

    @staticmethod
    def _row(text: str, start: int, end: int, hit) -> tuple:
        passage = text[start:end]
        start += len(passage) - len(passage.lstrip())
        return start, start + len(passage.strip()), hit[1], hit[2], hit[0]


def scan(
    docs: DataFrame,
    templates: dict[str, tuple[str, ...]] = TEMPLATES,
    threshold: float = THRESHOLD,
    id_col: str = ID,
    text_col: str = TEXT,
) -> DataFrame:
    """One row per passage: id, start, end, licence, template, dice.

    Offsets are code points, the end exclusive; ``template`` numbers the
    wordings of a licence. Documents without passages, null and empty texts
    give no rows; repeated rows give repeated rows; other columns are ignored.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, start long, end long, licence string, template int, dice double"

    def run(batches):
        own = Templates(templates, threshold)
        for batch in batches:
            row, found = [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                hits = own.scan(text)
                row += [i] * len(hits)
                found += hits
            columns = list(zip(*found)) or [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(row, pa.int64())),
                    *(pa.array(c, k) for c, k in zip(columns, kinds)),
                ],
                names=[id_col, "start", "end", "licence", "template", "dice"],
            )

    rows = docs.select(id_col, text_or_empty(text_col).alias("_text"))
    return rows.mapInArrow(run, schema)
