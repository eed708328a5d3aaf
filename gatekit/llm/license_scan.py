"""Licence scan: passages against licence templates by Dice coefficient over word bigrams.

Text and templates are normalised alike: words are runs of letters and digits, A-Z
lowered. The similarity of a passage and a template is ``2 |P and T| / (|P| + |T|)`` over
their sets of word bigrams. A passage of ``|P|`` bigrams can reach ``at`` only if
``at / (2 - at) <= |P| / |T| <= (2 - at) / at``, and shares at least
``at / (2 - at) |T|`` bigrams with it then: a template of which the document holds fewer is
pruned, and only windows of such sizes are compared. All passages are reported that do not
overlap a better one, of all templates, until no window of what is left reaches ``at``; the
best one stands beside them.

A notice shares most bigrams with the notices of other licences, so a passage has to hold
the name and version of its template too (``NAMED``). The templates are whole texts of short
licences, the notices that longer ones ask for, and tags with a licence's short identifier.

Cases: a null or blank text, and texts of fewer bigrams than a template needs, match
nothing. Ties go to the earlier template, then the earlier passage. Repeated rows give
repeated results. An empty table gives an empty result. Other columns are ignored. Texts are
read whole, however long; a start costs as many steps as its windows have distinct bigrams.
"""
from __future__ import annotations

from bisect import bisect
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatekit.llm.common import steps, text_bytes
from gatekit.llm.textops import U, fold, words

AT = 0.8
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""
_GPL = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."""
_ISC_END = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_ZERO_BSD = f"Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. {_ISC_END}"
_BSD_2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_3 = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."""
_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_UNLICENSE = """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."""
_MPL = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""
_EPL_2 = """This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"""
_EPL_1 = """This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html"""
_BOOST = """Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at https://www.boost.org/LICENSE_1_0.txt)"""
_BY_POST = "if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA."
#: The notice that the GNU licences ask for: licence, its name, its version, the work, its end.
_GNU = [
    ("GPL-2.0", "GNU General Public License", "2", "program", _BY_POST), ("LGPL-2.1", "GNU Lesser General Public License", "2.1", "library", _BY_POST),
    ("LGPL-3.0", "GNU Lesser General Public License", "3", "program", "If not, see <https://www.gnu.org/licenses/>."),
    ("AGPL-3.0", "GNU Affero General Public License", "3", "program", "If not, see <https://www.gnu.org/licenses/>."),
]
#: Short identifiers of licences that files name in a tag.
_TAGS = [
    "MIT-0", "MIT", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "0BSD", "ISC", "Zlib", "BSL-1.0", "Unlicense", "MPL-2.0", "EPL-1.0", "EPL-2.0",
    "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0",
]


def _gnu(name: str, version: str, work: str, end: str) -> str:
    return (f"This {work} is free software; you can redistribute it and/or modify it under the terms of the {name} as published by the Free Software Foundation; "
            f"either version {version} of the License, or (at your option) any later version. This {work} is distributed in the hope that it will be useful, "
            f"but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {name} for more details. "
            f"You should have received a copy of the {name} along with this {work}; {end}")


def _tag(license: str) -> str:
    return f"SPDX-License-Identifier: {license}"


#: (licence, template): wordings of public licences and of usual notices (fixed values).
TEMPLATES = [
    ("MIT", _MIT), ("MIT", "Released under the MIT License."), ("MIT", "This project is licensed under the MIT License."),
    ("Apache-2.0", _APACHE), ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", _GPL), ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", f"{_ISC} {_ISC_END}"), ("ISC", _ISC), ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("0BSD", _ZERO_BSD), ("BSD-2-Clause", f"{_BSD_2} {_BSD_END}"), ("BSD-3-Clause", f"{_BSD_2} {_BSD_3} {_BSD_END}"),
    ("Unlicense", _UNLICENSE), ("Zlib", _ZLIB), ("MPL-2.0", _MPL), ("EPL-2.0", _EPL_2), ("EPL-1.0", _EPL_1), ("BSL-1.0", _BOOST),
    *((license, _gnu(*notice)) for license, *notice in _GNU), *((license, _tag(license)) for license in _TAGS),
]
#: What a passage has to hold for a template that names its licence: neighbouring words of
#: the licence's name and version, without which other licences share the rest.
NAMED = {
    "Released under the MIT License.": ["MIT License"], "This project is licensed under the MIT License.": ["MIT License"],
    _APACHE: ["Apache License Version 2.0"], "Licensed under the Apache License, Version 2.0.": ["Apache License Version 2.0"],
    _GPL: ["GNU General Public License", "version 3"],
    "This work is licensed under the GNU General Public License, version 3.": ["GNU General Public License version 3"],
    "Licensed under CC BY-NC 4.0.": ["CC BY-NC 4.0"],
    "This work is licensed under a Creative Commons Attribution 4.0 International License.": ["Creative Commons Attribution 4.0"],
    "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.": ["Creative Commons Attribution-ShareAlike 4.0"],
    _ZERO_BSD: ["hereby granted the software"], _UNLICENSE: ["unencumbered software", "public domain"], _MPL: ["Mozilla Public License v 2.0"],
    _EPL_2: ["Eclipse Public License 2.0"], _EPL_1: ["Eclipse Public License v1.0"], _BOOST: ["Boost Software License Version 1.0"],
    **{_gnu(name, version, *rest): [name, f"version {version} of"] for _, name, version, *rest in _GNU}, **{_tag(license): [_tag(license)] for license in _TAGS},
}
_NOT_WORD = np.zeros(256, bool)
_NOT_WORD[[c for c in range(128) if not chr(c).isalnum()]] = True


def bigrams(data: np.ndarray, offsets: np.ndarray):
    """(words, bigram hashes, document of each, index of its first word)."""
    w = words(data, offsets, lower=True, separators=_NOT_WORD)
    doc = w.doc
    at = np.flatnonzero(doc[1:] == doc[:-1]) if len(doc) > 1 else np.zeros(0, np.int64)
    return w, fold([w.hash[at], w.hash[at + 1]]) if len(at) else np.zeros(0, U), doc[at], at


def _set(text: str) -> np.ndarray:
    raw = text.encode()
    return np.unique(bigrams(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[1])


@lru_cache(maxsize=4)
def _compiled(templates: tuple[tuple[str, str], ...]) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """The bigrams of each template, those of them that a passage has to hold, and all."""
    own = [_set(t) for _, t in templates]
    asked = [np.unique(np.concatenate([np.zeros(0, U), *map(_set, NAMED.get(t, []))])) for _, t in templates]
    return own, asked, np.unique(np.concatenate([np.zeros(0, U), *own]))


def _in(values: np.ndarray, sorted_set: np.ndarray) -> np.ndarray:
    return sorted_set[np.minimum(np.searchsorted(sorted_set, values), len(sorted_set) - 1)] == values


def windows(grams: np.ndarray, hit: np.ndarray, size: int, at: float, needed: np.ndarray | None = None) -> list[tuple[float, int, int]]:
    """(Dice, first, last bigram) of the best window from each start, last start first, of
    those that begin and end with a shared bigram and reach ``at``; ``hit`` marks the
    bigrams of the template, which has ``size``. A window's set consists of the first
    occurrences from its start on; they are kept as a linked list while the start moves
    from the end of the text to its beginning, so a start costs as many steps as its
    windows have distinct bigrams, however often the text repeats them."""
    n = len(grams)
    codes = np.unique(grams, return_inverse=True)[1]
    first = [-1] * (int(codes.max()) + 1 if n else 0)
    after, before, head = [n] * (n + 1), [n] * (n + 1), n
    code, shares = codes.tolist(), hit.tolist()
    need, asked = (0, shares) if needed is None or not len(needed) else (len(needed), np.isin(grams, needed).tolist())
    spare = 2 * size * (1 / at - 1) + 1e-9  # with more bigrams that are not shared none reaches ``at``
    out = []
    for a in range(n - 1, -1, -1):
        after[a], before[head], head = head, a, a
        old, first[code[a]] = first[code[a]], a
        if old >= 0:
            x, y = before[old], after[old]
            after[x], before[y] = y, x
        if not shares[a]:
            continue
        shared = misses = 0
        k, own, left = a, None, need
        while k < n:
            if shares[k]:
                shared += 1
                left -= need > 0 and asked[k]
                d = 2 * shared / (shared + misses + size)
                if d >= at and not left and (own is None or d > own[0]):
                    own = (d, a, k)
            else:
                misses += 1
                if misses > spare:
                    break
            k = after[k]
        if own:
            out.append(own)
    return out


def best_window(grams: np.ndarray, hit: np.ndarray, size: int, at: float) -> tuple[float, int, int] | None:
    """The best of the windows, the earliest one of equals."""
    return max(windows(grams, hit, size, at), key=lambda x: (x[0], -x[1]), default=None)


def _apart(grams: np.ndarray, hits: list[tuple[int, np.ndarray]], sizes: list[int], at: float, needed: list[np.ndarray] | None = None) -> list[tuple[float, int, int, int]]:
    """(Dice, template, first, last bigram) of the windows of a document, best first, that
    share no word; what lies between them is searched again until nothing is found."""
    parts, picked = [(0, len(grams))], []
    while parts:
        rest = []
        for x, y in parts:
            found = []
            for t, hit in hits:
                mine = hit[x:y]
                if needed and not np.isin(needed[t], grams[x:y]).all():
                    continue
                least = int(np.ceil(sizes[t] * at / (2 - at) - 1e-9))
                if mine.sum() >= least and len(np.unique(grams[x:y][mine])) >= least:
                    found += [(-d, t, x + a, x + k) for d, a, k in windows(grams[x:y], mine, sizes[t], at, needed and needed[t])]
            begins, ends = [], []  # of the windows taken, ascending
            for d, t, a, k in sorted(found):
                i = bisect(begins, a)
                if (i and ends[i - 1] + 1 >= a) or (i < len(begins) and k + 1 >= begins[i]):
                    continue
                begins.insert(i, a)
                ends.insert(i, k)
                picked.append((-d, t, a, k))
            if begins:  # bigrams of the words between
                rest += [(u, v) for u, v in zip([x, *(k + 2 for k in ends)], [*(a - 1 for a in begins), y]) if v > u]
        parts = rest
    return sorted(picked, key=lambda m: (-m[0], m[1], m[2]))


def scan_all(data: np.ndarray, offsets: np.ndarray, templates: tuple[tuple[str, str], ...], at: float, named: bool = True) -> list[list[tuple[str, float, int, int]]]:
    """The matches of each document of a step, best first: licence, Dice, start, end (code points).
    With ``named`` a passage has to hold the name of its licence (``NAMED``) too."""
    w, grams, doc, first = bigrams(data, offsets)
    out: list[list[tuple[str, float, int, int]]] = [[] for _ in range(len(offsets) - 1)]
    begin = np.searchsorted(doc, np.arange(len(offsets)))
    (compiled, asked, every), hits = _compiled(templates), {}
    at_any = np.flatnonzero(_in(grams, every)) if len(every) and len(grams) else np.zeros(0, np.int64)
    some, of = grams[at_any], doc[at_any]  # what no template holds is looked at once
    part = np.searchsorted(of, np.arange(len(offsets)))
    for t, template in enumerate(compiled):
        if not len(template) or not len(some):
            continue
        own = _in(some, template)
        least = int(np.ceil(len(template) * at / (2 - at) - 1e-9))
        for d in np.flatnonzero(np.bincount(of[own], minlength=len(out)) >= least).tolist():
            hit = np.zeros(begin[d + 1] - begin[d], bool)
            i, j = part[d], part[d + 1]
            hit[at_any[i:j][own[i:j]] - begin[d]] = True
            hits.setdefault(d, []).append((t, hit))
    for d, own in hits.items():
        found = _apart(grams[begin[d]:begin[d + 1]], own, [len(t) for t in compiled], at, asked if named else None)
        if found:
            points = np.cumsum((data[offsets[d]:offsets[d + 1]] & 0xC0) != 0x80)
            for dice, t, a, k in found:
                s, e = w.start[first[begin[d] + a]] - offsets[d], w.end[first[begin[d] + k] + 1] - offsets[d]
                out[d].append((templates[t][0], dice, int(points[s]) - 1, int(points[e - 1])))
    return out


def scan(data: np.ndarray, offsets: np.ndarray, templates: tuple[tuple[str, str], ...], at: float) -> list[tuple[str, float, int, int] | None]:
    """The best match of each document of a step, by the Dice coefficient alone."""
    return [m[0] if m else None for m in scan_all(data, offsets, templates, at, named=False)]


_MATCHES = pa.list_(pa.struct([("license", pa.string()), ("dice", pa.float64()), ("start", pa.int64()), ("end", pa.int64())]))


def _scanner(templates: tuple[tuple[str, str], ...], at: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offs = text_bytes(b.column(1))
            rows = [r for i, j in steps(offs) for r in scan_all(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i], templates, at)]
            cols = [pa.array([r[0][k] if r else None for r in rows], kind) for k, kind in enumerate((pa.string(), pa.float64(), pa.int64(), pa.int64()))]
            every = pa.array([[dict(zip(("license", "dice", "start", "end"), m)) for m in r] for r in rows], _MATCHES)
            yield pa.RecordBatch.from_arrays([b.column(0), *cols, every], names=["doc_id", "license", "dice", "start", "end", "matches"])
    return run


def scan_documents(docs: DataFrame, id: str = "doc_id", text: str = "text", templates: list[tuple[str, str]] = TEMPLATES, at: float = AT) -> DataFrame:
    """Per row: doc_id, license, dice, start, end of the best match, null without one, and
    matches, the same of all matches that do not overlap, best first."""
    rows = docs.select(F.col(id).alias("doc_id"), F.col(text).cast("string").alias("__text"))
    return rows.mapInArrow(_scanner(tuple(map(tuple, templates)), at), f"doc_id {rows.schema[0].dataType.simpleString()}, license string, dice double, "
                           "start long, end long, matches array<struct<license:string,dice:double,start:bigint,end:bigint>>")
