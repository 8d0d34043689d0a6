"""License scans: min-hash bands over overlapping windows retrieve templates, exact containment verifies them.

Windows of twice a template's shingles, one template's length apart, hold every
occurrence whole, so that a window with the required share of a template has a
known least similarity to it; the number of bands follows from that and from the
chance of a miss that is allowed. Every window of every text is hashed; only the
templates that a band retrieves for it are compared with it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tableferry.llm import texts

_BSD_CONDITIONS = """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL,
EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE,
DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE
POSSIBILITY OF SUCH DAMAGE."""

#: Public license notices, standard headers and texts.
TEMPLATES = {
    "MIT (text)": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to
use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES
OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE
LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "BSD-2-Clause (text)": f"{_BSD_CONDITIONS}\n{_BSD_DISCLAIMER}",
    "BSD-3-Clause (text)": f"""{_BSD_CONDITIONS}
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived
from this software without specific prior written permission.
{_BSD_DISCLAIMER}""",
    "ISC (text)": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "Zlib (text)": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be
held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and
redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use
this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution.""",
    "Apache-2.0 (header)": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS"
BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
governing permissions and limitations under the License.""",
    **{
        f"{name} (header)": f"""This program is free software: you can redistribute it and/or modify it under the terms of the
{title} as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.
This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {title} for more details.
You should have received a copy of the {title} along with this program. If not, see <https://www.gnu.org/licenses/>."""
        for name, title in {
            "GPL-3.0": "GNU General Public License",
            "LGPL-3.0": "GNU Lesser General Public License",
            "AGPL-3.0": "GNU Affero General Public License",
        }.items()
    },
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "MIT": "Released under the MIT License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "BSD": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
SHINGLE_WORDS = 5
CONTAINMENT = 0.8
MISS = 1e-6
_SALTS = np.random.Generator(np.random.PCG64(8)).integers(0, 1 << 31, 512, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def bands_for(containment: float, shingles: int, miss: float) -> int:
    """Bands of one row that find a window holding so much of a template, but for a chance of ``miss``.

    A window of ``2 n + 1`` shingles that holds ``c n`` of a template's ``n`` has a
    similarity of at least ``c n / (2 n + 1 + n - c n)``.
    """
    shared = math.ceil(containment * shingles)
    similarity = shared / (3 * shingles + 1 - shared)
    return math.ceil(math.log(miss) / math.log(1 - similarity))


class Templates:
    """Shingles and band values of each template."""

    def __init__(self, templates: dict[str, str], containment: float, miss: float):
        self.names = list(templates)
        values = [t.encode() for t in templates.values()]
        data = np.frombuffer(b"".join(values), np.uint8)
        starts = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int64)
        words, rows = texts.trimmed_hashes(data, starts)
        if (np.diff(rows) < SHINGLE_WORDS).any():
            raise ValueError(f"a template has fewer than {SHINGLE_WORDS} words")
        hashed, at = texts.row_sets(*texts.shingles(words, rows, SHINGLE_WORDS))
        self.sets = [hashed[a:b] for a, b in zip(at[:-1], at[1:])]
        #: Templates by number of shingles: those share windows.
        self.sizes = {n: [i for i, s in enumerate(self.sets) if len(s) == n] for n in sorted({len(s) for s in self.sets})}
        self.bands = {n: bands_for(containment, n, miss) for n in self.sizes}
        if max(self.bands.values()) > len(_SALTS):
            raise ValueError(f"these settings need more than {len(_SALTS)} bands")


def _retrieved(hashed: np.ndarray, at: np.ndarray, n: int, known: Templates) -> Iterator[tuple[int, np.ndarray]]:
    """Each template of ``n`` shingles, and the windows (start of each in ``hashed``) that share a band with it.

    Windows start at every ``n``-th shingle of a row and have up to ``2 n + 1``: two runs of ``n`` and one more.
    """
    runs = -(-np.diff(at) // n)
    row = np.repeat(np.arange(len(runs)), runs)
    if not len(row):
        return
    start = at[row] + n * (np.arange(len(row)) - (np.cumsum(runs) - runs)[row])
    # The run after each counts if it is in the same row; a window without one more shingle takes its first again.
    joined = row[1:] == row[:-1]
    last = np.where(start + 2 * n < at[row + 1], start + 2 * n, start)
    # Half the bits find all that the whole ones find, and a few windows more.
    short = (hashed >> np.uint64(32)).astype(np.uint32)
    own = [(known.sets[i] >> np.uint64(32)).astype(np.uint32) for i in known.sizes[n]]
    hit = np.zeros((len(own), len(row)), bool)
    for salt in _SALTS[: known.bands[n]]:
        # A product with an odd number permutes the hashes, which are random already.
        value = short * salt
        run = value if n == 1 else np.minimum.reduceat(value, start)
        least = np.minimum(run, value[last])
        np.minimum(least[:-1], run[1:], out=least[:-1], where=joined)
        for t, shingles in enumerate(own):
            hit[t] |= least == (shingles * salt).min()
    for t, i in enumerate(known.sizes[n]):
        yield i, start[hit[t]]


def _found(hashed: np.ndarray, at: np.ndarray, known: Templates, containment: float) -> list[tuple[int, int, int, int, float]]:
    """Matches in the rows' shingles: row, template, first and last shingle in the row, share."""
    out = []
    for n in known.sizes:
        for i, windows in _retrieved(hashed, at, n, known):
            spans: list[list] = []
            for start in windows.tolist():
                row = int(np.searchsorted(at, start, "right")) - 1
                part = hashed[start : min(start + 2 * n + 1, at[row + 1])]
                inside = np.flatnonzero(np.isin(part, known.sets[i]))
                share = len(np.unique(part[inside])) / n
                if share < containment:
                    continue
                a, b = start - int(at[row]) + int(inside[0]), start - int(at[row]) + int(inside[-1])
                if spans and spans[-1][0] == row and a <= spans[-1][3]:
                    spans[-1][3:] = max(b, spans[-1][3]), max(share, spans[-1][4])
                else:
                    spans.append([row, i, a, b, share])
            out += map(tuple, spans)
    return sorted(out)


def license_scan(
    documents: DataFrame,
    templates: dict[str, str] | None = None,
    containment: float = CONTAINMENT,
    miss: float = MISS,
) -> DataFrame:
    """``(doc_id, license, first_word, last_word, containment)`` per place of a template in a document.

    Words are lower-cased and lose punctuation at their ends; containment is the share
    of a template's five-word shingles in the window. Overlapping finds of one template
    are one place; different templates may share words. Null, empty and short texts give
    no rows, repeated rows are scanned alike, null ids are kept; an empty table gives no rows.
    Texts of any length are scanned whole. No templates, or one of fewer than five words, are an error.
    """
    templates = TEMPLATES if templates is None else templates
    if not templates:
        raise ValueError("there are no templates")
    Templates(templates, containment, miss)
    kind = dict(documents.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Templates(templates, containment, miss)
        for batch in batches:
            for block in texts.blocks(batch):
                words, rows = texts.trimmed_hashes(*texts.flat(block.column("text")))
                hashed, at = texts.shingles(words, rows, SHINGLE_WORDS)
                found = _found(hashed, at, known, containment)
                out = [(row, known.names[i], a, b + SHINGLE_WORDS - 1, share) for row, i, a, b, share in found]
                row, name, a, b, share = zip(*out) if out else ((), (), (), (), ())
                yield pa.RecordBatch.from_arrays(
                    [
                        block.column("doc_id").take(pa.array(row, pa.int64())),
                        pa.array(name, pa.string()),
                        pa.array(a, pa.int64()),
                        pa.array(b, pa.int64()),
                        pa.array(share, pa.float64()),
                    ],
                    ["doc_id", "license", "first_word", "last_word", "containment"],
                )

    return documents.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, license string, first_word bigint, last_word bigint, containment double"
    )
