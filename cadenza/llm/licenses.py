"""Licence scans: normalised text against licence templates by Dice over word bigrams.

Words are A-Z lower-cased runs of letters and digits.  A template and a passage are
sets of word bigrams; Dice = 2 |both| / (|a| + |b|).  Passages of a text are its
lines and, per template, the runs of words from the template's first to its last
bigram found with gaps of at most ``GAP`` words.  Size bounds prune: Dice is at most
``2 min / (a + b)``, so a template is only compared with passages whose number of
bigrams lies within ``t / (2 - t)`` and ``(2 - t) / t`` of its own, and only if the
whole text has at least ``t / (2 - t)`` of the template's bigrams.

Templates go to the tasks with the code; documents are never shuffled.  Null texts
and texts without a template's bigram have no match.  An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cadenza.llm import words as W
from cadenza.llm.license_texts import TEXTS

THRESHOLD = 0.8
GAP = 6

# Licence notices and short licence texts, as their stewards publish them.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at http://www.boost.org/LICENSE_1_0.txt)"),
]

_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. ")
_BSD_ADS = "3. All advertising materials mentioning features or use of this software must display the following acknowledgement: This product includes software developed by the copyright holder. "
_BSD_NAMES = "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. "
_BSD_END = ("THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. "
            "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
            "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_MIT = next(t for n, t in TEMPLATES if n == "MIT" and t.startswith("Permission"))
_ISC = next(t for n, t in TEMPLATES if n == "ISC")
_EPL = "This program and the accompanying materials are made available under the terms of the Eclipse Public License {} which {} available at "
TEMPLATES += [
    ("BSD-2-Clause", _BSD + _BSD_END),
    ("BSD-3-Clause", _BSD + "3. " + _BSD_NAMES + _BSD_END),
    ("BSD-4-Clause", _BSD + _BSD_ADS + "4. " + _BSD_NAMES + _BSD_END),
    ("0BSD", _ISC.replace(", provided that the above copyright notice and this permission notice appear in all copies", "")),
    ("MIT-0", _MIT.replace(", subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software", "")),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."),
    ("EPL-1.0", "All rights reserved. " + _EPL.format("v1.0", "accompanies this distribution, and is") + "http://www.eclipse.org/legal/epl-v10.html"),
    ("EPL-2.0", _EPL.format("2.0", "is") + "https://www.eclipse.org/legal/epl-2.0/"),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("CC0-1.0", "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide. This software is distributed without any warranty. You should have received a copy of the CC0 Public Domain Dedication along with this software. If not, see http://creativecommons.org/publicdomain/zero/1.0/."),
]
# GNU lines and notices of each version
_NOTICE = "This {0} is free software{4} you can redistribute it and/or modify it under the terms of the GNU {1} as published by the Free Software Foundation, {3}version {2} of the License{5}. This {0} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {1} for more details."
_LATER = ", or (at your option) any later version"
for _id, _name, _version in [("GPL-1.0", "General Public License", "1"), ("GPL-2.0", "General Public License", "2"), ("GPL-3.0", "General Public License", "3"),
                             ("LGPL-2.0", "Library General Public License", "2"), ("LGPL-2.1", "Lesser General Public License", "2.1"),
                             ("LGPL-3.0", "Lesser General Public License", "3"), ("AGPL-3.0", "Affero General Public License", "3")]:
    TEMPLATES += [(_id, f"{start} the GNU {_name}, version {_version}.") for start in ("This work is licensed under", "Licensed under", "Released under")]
    TEMPLATES += [(_id, f"Licensed under the GNU {_name} v{_version}{end}.") for end in ([""] if "." in _version else ["", ".0"])]
    TEMPLATES += [(_id, _NOTICE.format(what, _name, _version, *how)) for what in ("program", "library") for how in (("either ", ":", _LATER), ("", ":", ""))]
# short lines of the others
for _id, _names in [("BSD-2-Clause", ["BSD 2-Clause License"]), ("BSD-3-Clause", ["BSD 3-Clause License"]), ("ISC", ["ISC License"]), ("MIT", ["MIT License"]),
                    ("MPL-1.1", ["Mozilla Public License, version 1.1"]), ("MPL-2.0", ["Mozilla Public License, version 2.0", "Mozilla Public License 2.0"]),
                    ("EPL-1.0", ["Eclipse Public License, version 1.0", "Eclipse Public License 1.0"]), ("EPL-2.0", ["Eclipse Public License, version 2.0", "Eclipse Public License 2.0"]),
                    ("Apache-1.1", ["Apache License, Version 1.1"]), ("Apache-2.0", ["Apache License, Version 2.0", "Apache License 2.0"]),
                    ("GFDL-1.2", ["GNU Free Documentation License, version 1.2"]), ("GFDL-1.3", ["GNU Free Documentation License, version 1.3"])]:
    TEMPLATES += [(_id, f"{start} the {name}.") for name in _names for start in ("Licensed under", "Released under")]
# Creative Commons: every kind and version
for _version, _area in [("1.0", "Generic"), ("2.0", "Generic"), ("2.5", "Generic"), ("3.0", "Unported"), ("4.0", "International")]:
    for _kind, _name in [("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-ND", "Attribution-NoDerivatives"), ("BY-NC", "Attribution-NonCommercial"),
                         ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"), ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives")]:
        TEMPLATES += [(f"CC-{_kind}-{_version}", f"Licensed under CC {_kind} {_version}."),
                      (f"CC-{_kind}-{_version}", f"This work is licensed under a Creative Commons {_name} {_version} {_area} License.")]
TEMPLATES += [("CC0-1.0", "Licensed under CC0 1.0."), ("CC0-1.0", "Licensed under CC0 1.0 Universal."), *TEXTS.items()]
TEMPLATES = list(dict.fromkeys(TEMPLATES))


def bigrams(hashes: np.ndarray) -> np.ndarray:
    """Distinct bigram hashes, sorted; a single word counts as one bigram."""
    return np.unique(W.ngrams(hashes, 2) if len(hashes) > 1 else hashes)


def dice(a: np.ndarray, b: np.ndarray) -> float:
    return 2 * len(np.intersect1d(a, b, assume_unique=True)) / (len(a) + len(b)) if len(a) + len(b) else 0.0


class Templates:
    def __init__(self, templates: list[tuple[str, str]], threshold: float):
        self.names, self.threshold = [n for n, _ in templates], threshold
        self.sets = []
        for _, _, buf, off in W.text_blocks(pa.array([t for _, t in templates])):
            w = W.words(buf, off, W.ALNUM)
            self.sets += [bigrams(w.hash[w.bounds[i]: w.bounds[i + 1]]) for i in range(len(off) - 1)]
        self.sizes = np.array([len(s) for s in self.sets], np.int64)
        self.known = np.unique(np.concatenate([*self.sets, np.empty(0, np.uint64)]))
        self.has = np.zeros((len(self.known), len(self.sets)), bool)
        for i, s in enumerate(self.sets):
            self.has[np.searchsorted(self.known, s), i] = True

    def candidates(self, n: int, among: list[int]) -> list[int]:
        """Templates that a passage of ``n`` bigrams can reach the threshold with, by size alone."""
        t = self.threshold
        return [i for i in among if 2 * min(n, len(self.sets[i])) >= t * (n + len(self.sets[i]))]

    def within_reach(self, ids: np.ndarray) -> list[int]:
        """Templates that some passage of a text with these known bigrams can reach the threshold with: a passage
        of ``n`` bigrams that shares ``o`` of them has ``n >= o``, so its Dice is at most ``2 o / (o + size)``."""
        o = self.has[np.unique(ids)].sum(axis=0)
        return np.flatnonzero(2 * o >= self.threshold * (o + self.sizes) - 1e-9).tolist()


def matches_in(tp: Templates, hashes: np.ndarray, hits: np.ndarray, line: np.ndarray) -> list[tuple[int, float, int, int]]:
    """``(template, dice, first word, end word)`` of the passages of one text that reach the threshold.

    ``hits``: positions of bigrams that some template has; ``line``: the line of each word.
    """
    grams = W.ngrams(hashes, 2)
    ids = np.searchsorted(tp.known, grams[hits])
    every = tp.within_reach(ids)
    if not every:
        return []
    passages: dict[tuple[int, int], list[int]] = {}
    for ln in np.unique(line[hits]).tolist():
        a, z = np.searchsorted(line, [ln, ln + 1])
        passages.setdefault((int(a), int(z)), []).extend(every)
    for i in every:
        own = hits[tp.has[ids, i]]
        if len(own):
            for run in np.split(own, np.flatnonzero(np.diff(own) > GAP) + 1):
                passages.setdefault((int(run[0]), int(run[-1]) + 2), []).append(i)
    found = []
    for (a, z), among in passages.items():
        near = tp.candidates(z - a - 1, among)  # repeats can only make the set smaller
        own = bigrams(hashes[a:z])
        if len(own) < z - a - 1:
            near = tp.candidates(len(own), among)
        for i in dict.fromkeys(near):
            d = dice(own, tp.sets[i])
            if d >= tp.threshold:
                found.append((i, d, a, z))
    # best first; passages that overlap a better one of the same text go
    kept: list[tuple[int, float, int, int]] = []
    for m in sorted(found, key=lambda m: (-m[1], m[2] - m[3], m[2], m[0])):
        if all(m[3] <= k[2] or m[2] >= k[3] for k in kept):
            kept.append(m)
    return sorted(kept, key=lambda m: m[2])


def scan(docs: DataFrame, templates: list[tuple[str, str]] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """Per row: ``doc_id, license`` (of the best match, else null), ``dice`` (0 if none) and ``matches``
    (licence, dice, first and end word of the passage, in text order)."""
    templates = TEMPLATES if templates is None else templates
    item = pa.struct([("license", pa.string()), ("dice", pa.float64()), ("from_word", pa.int64()), ("to_word", pa.int64())])

    def run(batches):
        tp = Templates(templates, threshold)
        for b in batches:
            best, score, found = [], [], []
            for _, _, buf, off in W.text_blocks(b.column("text")):
                w = W.words(buf, off, W.ALNUM)
                grams = W.ngrams(w.hash, 2)
                at = np.searchsorted(tp.known, grams)
                at[at == len(tp.known)] = 0
                hit = np.flatnonzero((tp.known[at] == grams) & W.inside_rows(w.bounds, 2)) if len(tp.known) else np.empty(0, int)
                row = np.searchsorted(w.bounds, hit, side="right") - 1
                cut = np.searchsorted(row, np.arange(len(off)))
                ends = np.flatnonzero(buf == 10) if len(hit) else np.empty(0, int)
                for i in range(len(off) - 1):
                    own = []
                    if cut[i] < cut[i + 1]:
                        lo, hi = int(w.bounds[i]), int(w.bounds[i + 1])
                        line = np.searchsorted(ends, w.start[lo:hi])
                        own = matches_in(tp, w.hash[lo:hi], hit[cut[i]: cut[i + 1]] - lo, line)
                    top = max(own, key=lambda m: m[1], default=None)
                    best.append(tp.names[top[0]] if top else None)
                    score.append(top[1] if top else 0.0)
                    found.append([{"license": tp.names[m[0]], "dice": m[1], "from_word": m[2], "to_word": m[3]} for m in own])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(best, pa.string()), pa.array(score, pa.float64()),
                                              pa.array(found, pa.list_(item))], names=["doc_id", "license", "dice", "matches"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id bigint, license string, dice double, matches array<struct<license:string,dice:double,from_word:bigint,to_word:bigint>>")
