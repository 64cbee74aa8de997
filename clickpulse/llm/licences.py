"""Licence scan: Dice coefficient over word bigrams against templates.

A text is normalised to lower-case words of letters and digits.  The whole
text, its blocks between blank lines and its single lines are compared with
every template: ``2 * shared / (a + b)`` over the word bigrams, repeats
included, from ``MIN_DICE`` on.  A coefficient of t is only possible for sizes
from ``t / (2 - t)`` to ``(2 - t) / t`` of the template's, so other templates
are pruned; and a unit whose own bigrams are known to too few templates is
left out before it is compared at all.

So that a licence of several paragraphs, or inside a line, is found too, every
run of as many words as a template has is compared with it, whatever the lines:
the shared bigrams are counted while the window slides, only where enough of
its bigrams are the template's.  Of windows that overlap each other or a unit
with a licence, the one with the best coefficient counts.

Every row is scanned alone, so nothing is shuffled.  Cases: a null or empty
text has no licence; a template of one word has no bigram and never matches;
of equal coefficients the larger template wins, then the name that sorts
first; repeated rows are scanned one by one; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickpulse.llm.common import map_arrow, slices, texts_of
from clickpulse.llm.licence_texts import TEXTS

MIN_DICE = 0.8

#: Public licence texts and the notices that name them.
TEMPLATES = {
    "all-rights-reserved": ("All rights reserved.",),
    "agpl-3.0": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
        Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or
        (at your option) any later version. This program is distributed in the hope that it will be useful, but
        WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR
        PURPOSE. See the GNU Affero General Public License for more details. You should have received a copy of
        the GNU Affero General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."""),
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing,
        software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR
        CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing
        permissions and limitations under the License."""),
    "bsd-2-clause": (
        "Released under the BSD 2-Clause License.",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided
        that the following conditions are met: 1. Redistributions of source code must retain the above copyright
        notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must
        reproduce the above copyright notice, this list of conditions and the following disclaimer in the
        documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE
        COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT
        LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.
        IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
        SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE
        GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY
        THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE)
        ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    "bsd-3-clause": (
        "Released under the BSD 3-Clause License.",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided
        that the following conditions are met: 1. Redistributions of source code must retain the above copyright
        notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must
        reproduce the above copyright notice, this list of conditions and the following disclaimer in the
        documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor
        the names of its contributors may be used to endorse or promote products derived from this software without
        specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT
        LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.
        IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
        SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE
        GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY
        THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE)
        ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    "cc-by-4.0": ("Licensed under CC BY 4.0.",
                  "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "cc-by-nc-4.0": ("Licensed under CC BY-NC 4.0.",
                     "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "cc-by-sa-4.0": ("Licensed under CC BY-SA 4.0.",
                     "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "cc0-1.0": ("Released under CC0 1.0.",
                "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    "gpl-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        """This program is free software; you can redistribute it and/or modify it under the terms of the GNU
        General Public License as published by the Free Software Foundation, either version 2 of the License, or
        (at your option) any later version. This program is distributed in the hope that it will be useful, but
        WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR
        PURPOSE. See the GNU General Public License for more details. You should have received a copy of
        the GNU General Public License along with this program; if not, write to the Free Software
        Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA.""",
        """This program is free software; you can redistribute it and/or modify it under the terms of the GNU
        General Public License as published by the Free Software Foundation, either version 2 of the License, or
        (at your option) any later version. This program is distributed in the hope that it will be useful, but
        WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR
        PURPOSE. See the GNU General Public License for more details. You should have received a copy of
        the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."""),
    "gpl-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
        General Public License as published by the Free Software Foundation, either version 3 of the License, or
        (at your option) any later version. This program is distributed in the hope that it will be useful, but
        WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR
        PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU
        General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."""),
    "isc": (
        "Released under the ISC License.",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
        hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
        THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
        INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE
        FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS
        OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING
        OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    "lgpl-2.1": (
        "This work is licensed under the GNU Lesser General Public License, version 2.1.",
        """This library is free software; you can redistribute it and/or modify it under the terms of the GNU
        Lesser General Public License as published by the Free Software Foundation, either version 2.1 of the License, or
        (at your option) any later version. This library is distributed in the hope that it will be useful, but
        WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR
        PURPOSE. See the GNU Lesser General Public License for more details. You should have received a copy of
        the GNU Lesser General Public License along with this library; if not, write to the Free Software
        Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA.""",
        """This library is free software; you can redistribute it and/or modify it under the terms of the GNU
        Lesser General Public License as published by the Free Software Foundation, either version 2.1 of the License, or
        (at your option) any later version. This library is distributed in the hope that it will be useful, but
        WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR
        PURPOSE. See the GNU Lesser General Public License for more details. You should have received a copy of
        the GNU Lesser General Public License along with this library. If not, see <https://www.gnu.org/licenses/>."""),
    "lgpl-3.0": (
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
        Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or
        (at your option) any later version. This program is distributed in the hope that it will be useful, but
        WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR
        PURPOSE. See the GNU Lesser General Public License for more details. You should have received a copy of
        the GNU Lesser General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."""),
    "mit": (
        "Released under the MIT License.",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "Software"), to deal in the Software without restriction, including
        without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
        copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
        following conditions: The above copyright notice and this permission notice shall be included in all
        copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY
        KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A
        PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR
        ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
        OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    "mpl-2.0": (
        "Licensed under the Mozilla Public License, Version 2.0.",
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was
        not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""),
    "unlicense": (
        "Released under the Unlicense.",
        """This is free and unencumbered software released into the public domain.
        Anyone is free to copy, modify, publish, use, compile, sell, or
        distribute this software, either in source code form or as a compiled
        binary, for any purpose, commercial or non-commercial, and by any
        means.
        In jurisdictions that recognize copyright laws, the author or authors
        of this software dedicate any and all copyright interest in the
        software to the public domain. We make this dedication for the benefit
        of the public at large and to the detriment of our heirs and
        successors. We intend this dedication to be an overt act of
        relinquishment in perpetuity of all present and future rights to this
        software under copyright law.
        THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND,
        EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
        MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.
        IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR
        OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
        ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR
        OTHER DEALINGS IN THE SOFTWARE.
        For more information, please refer to <http://unlicense.org/>"""),
}
for _name, _text in TEXTS.items():
    TEMPLATES[_name] += (_text,)


_WORD = re.compile(r"[^\W_]+")
_BLANK = re.compile(r"\n[^\S\n]*\n\s*")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def bigrams(words: list[str]) -> Counter:
    return Counter(zip(words, words[1:]))


def dice(a: Counter, b: Counter) -> float:
    total = a.total() + b.total()
    return 2 * (a & b).total() / total if total else 0.0


class Templates:
    """Bigrams of the templates, by size, and the bigrams that any of them has."""

    def __init__(self, templates: dict[str, tuple[str, ...]]):
        self.all = sorted(((bigrams(words_of(t)), name) for name, texts in templates.items() for t in texts),
                          key=lambda x: (-x[0].total(), x[1]))
        self.ids = {g: i for i, g in enumerate(dict.fromkeys(g for b, _ in self.all for g in b))}
        self.sizes = [b.total() for b, _ in self.all]
        #: per template, how often it has each known bigram; the last is for all others
        self.counts = [np.zeros(len(self.ids) + 1, np.int32) for _ in self.all]
        for count, (b, _) in zip(self.counts, self.all):
            for g, n in b.items():
                count[self.ids[g]] = n

    def known(self, words: list[str]) -> np.ndarray:
        """Per bigram of the words its number, -1 for an unknown one."""
        return np.fromiter(map(self.ids.get, zip(words, words[1:]), repeat(-1)), np.int64, max(0, len(words) - 1))

    def best(self, words: list[str], n_known: int, least: float) -> tuple[float, int] | None:
        """Coefficient and number of the best template, if that is ``least`` or more."""
        n = len(words) - 1
        if n < 1 or not self.all:
            return None
        need = least / (2 - least)
        low, high = need * n - 1e-9, n / need + 1e-9
        if low > self.sizes[0] or n_known < low:
            return None
        mine = bigrams(words)
        score, which = 0.0, 0
        for k, size in enumerate(self.sizes):
            if low <= size <= high:
                d = dice(mine, self.all[k][0])
                if d > score:
                    score, which = d, k
        return (score, which) if score >= least else None

    def windows(self, grams: np.ndarray, least: float):
        """(coefficient, template, start, end) of the windows of the templates'
        sizes with ``least`` or more."""
        total = int(np.count_nonzero(grams >= 0))
        for k, n in enumerate(self.sizes):
            if not 0 < n <= len(grams) or total < least * n - 1e-9:
                continue
            sums = np.concatenate(([0], np.cumsum(self.counts[k][grams] > 0)))
            starts = np.flatnonzero(sums[n:] - sums[:-n] >= least * n - 1e-9)
            left, shared, at = None, 0, -1
            for s in starts.tolist():
                if at < 0 or s - at >= n:  # start anew
                    left = self.counts[k].copy()
                    inner, outer = grams[s:s + n].tolist(), ()
                    shared = 0
                else:
                    inner, outer = grams[at + n:s + n].tolist(), grams[at:s].tolist()
                for g in inner:
                    shared += left[g] > 0
                    left[g] -= 1
                for g in outer:
                    left[g] += 1
                    shared -= left[g] > 0
                at = s
                if shared / n >= least:
                    yield float(shared / n), k, s, s + n


def licences(text: str | None, templates: Templates, least: float = MIN_DICE) -> dict[str, float]:
    """Names of the licences in a text and the largest coefficient of each."""
    out: dict[str, float] = {}
    if not text:
        return out
    lines = [words_of(x) for x in text.split("\n")]
    words = [w for x in lines for w in x]
    grams = templates.known(words)
    sums = np.concatenate(([0], np.cumsum(grams >= 0))).tolist()
    if not sums[-1]:
        return out
    units, at = [], 0  # (first word, words)
    for x in lines:
        units.append((at, x))
        at += len(x)
    blocks = _BLANK.split(text)
    if len(lines) > 1:
        units.append((0, words))
        if len(blocks) > 1:
            at = 0
            for x in blocks:
                n = len(words_of(x))
                if "\n" in x:
                    units.append((at, words[at:at + n]))
                at += n
    found = []  # (coefficient, template, first bigram, end, is it a unit?)
    for a, x in units:
        if len(x) > 1:
            b = a + len(x) - 1
            got = templates.best(x, sums[b] - sums[a], least)
            if got:
                found.append((*got, a, b, True))
    found += [(*w, False) for w in templates.windows(grams, least)]
    taken = np.zeros(len(grams), bool)
    for score, k, a, b, unit in sorted(found, key=lambda f: (-f[0], f[1], not f[4], f[2])):
        if unit or not taken[a:b].any():
            name = templates.all[k][1]
            out[name] = max(score, out.get(name, 0.0))
            taken[a:b] = True
    return out


_compiled: dict = {}


def scan_licences(docs: DataFrame, templates: dict[str, tuple[str, ...]] = TEMPLATES, *, least: float = MIN_DICE,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, licence (the best; null: none), dice, and licences: all names
    found, sorted and comma-joined."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([rows.schema["doc_id"], T.StructField("licence", T.StringType()),
                           T.StructField("dice", T.DoubleType()), T.StructField("licences", T.StringType())])

    def run(batches):
        key = repr(templates)
        if key not in _compiled:
            _compiled[key] = Templates(templates)
        known = _compiled[key]
        for b in slices(batches):
            found = [licences(t, known, least) for t in texts_of(b.column(1))]
            best = [min(((-d, n) for n, d in f.items()), default=(None, None)) for f in found]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([n for _, n in best], pa.string()),
                 pa.array([-d if d is not None else None for d, _ in best], pa.float64()),
                 pa.array([",".join(sorted(f)) for f in found], pa.string())], schema.names)

    return map_arrow(rows, run, schema)
