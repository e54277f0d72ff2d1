"""License scans: MinHash bands over overlapping windows of a text retrieve templates, exact shingle containment verifies them."""

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import PLACES, U, mix, quoted, shingle_hashes, text_slices, word_hashes

K, PERCENT = 5, 80
#: Shingles of a window: its bands, rows of a band, and the step between a text's windows; a template has a window at every shingle. A template
#: takes the widest windows of which a text that holds PERCENT of it surely has one. A stretch of a text that is as long as a window and a
#: step is retrieved if it is unchanged; of 24 shingles, a window that shares 0.6 with a template's is so with probability 0.99998.
WINDOWS = {24: (24, 2, 6), 8: (8, 2, 2), 3: (4, 1, 1), 1: (1, 1, 1)}
#: Bands of all templates that go to the tasks at once; more templates are scanned in more passes.
MOST_BANDS = 500_000

#: Texts of public licenses, and notices that name them.
TEMPLATES = {
    "mit-notice": "Released under the MIT License.",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "all-rights-reserved": "All rights reserved.",
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "isc": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "bsd-2-clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "bsd-3-clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution.""",
    "unlicense": """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "bsl-1.0": """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:

The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "apache-2.0-header": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.""",
    "gpl-3.0-header": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.

You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.""",
    "mpl-2.0-header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
}


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    done = 1
    while 2 * done <= width:
        x = np.minimum(x[:-done], x[done:])
        done *= 2
    return np.minimum(x[: len(x) - (width - done)], x[width - done :]) if width > done else x


def window_bands(shingles: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """The band values of the windows of `width` shingles at starts, one row for each window."""
    bands, rows, _ = WINDOWS[width]
    out = np.zeros((len(starts), bands), U)
    with np.errstate(over="ignore"):
        for b in range(bands):
            for r in range(rows):
                low = sliding_min(mix(shingles ^ mix(np.array([b * rows + r + 1], U))), width)
                out[:, b] += low[starts] * PLACES[r]
            out[:, b] = mix(out[:, b] + U(b + (width << 8)))
    return out


def shingles_of(texts: pa.Array, k: int):
    for i, j, data, offs in text_slices(texts):
        h, rows, _, _ = word_hashes(data, offs)
        yield i, j, shingle_hashes(h, rows, k)


def width_for(n: int, percent: int) -> int:
    """The widest windows of which a text with `percent` of n shingles surely has one that is in a stretch of its own."""
    need = -(-percent * n // 100)
    return max(w for w in WINDOWS if w == 1 or w <= need and (w < 8 or need >= w + WINDOWS[w][2]))


def template_table(templates: dict, percent: int, k: int) -> list:
    """(name, sorted distinct shingles, the bands by which it is found, width of its windows); without words there is none."""
    out = []
    for name, wording in templates.items():
        for _, _, (x, _) in shingles_of(pa.array([wording]), k):
            if len(x):
                width = width_for(len(np.unique(x)), percent)
                out.append((name, np.unique(x), np.unique(window_bands(x, np.arange(len(x) - width + 1), width)), width))
    return out


def scan_licenses(docs: DataFrame, templates: dict = TEMPLATES, percent: int = PERCENT, text: str = "text") -> DataFrame:
    """(doc_id, license, n_shared, n_template): templates of which a row's text holds `percent` of the distinct 5-word shingles or more.

    Words are [^\\x20\\x09-\\x0D]+ with A-Z lower-cased. A template of fewer than five words is one shingle of its own length, and is
    looked for among the text's shingles of that length. A template is a candidate where a window of the text shares a band with one of
    its windows; what is found is verified on full sets. Null or empty texts match nothing; texts of any length are taken whole;
    repeated rows and rows without an id give rows of their own; other columns are ignored.
    """
    found = None
    for k, some in sorted(by_length(templates).items()):
        passes, size = [[]], 0
        for t in template_table(some, percent, k):
            if size + len(t[2]) > MOST_BANDS and passes[-1]:
                passes.append([])
                size = 0
            passes[-1].append(t)
            size += len(t[2])
        for table in passes:
            one = one_pass(docs, table, percent, text, k)
            found = one if found is None else found.unionByName(one)
    return docs.sparkSession.createDataFrame([], FOUND) if found is None else found


def by_length(templates: dict) -> dict:
    """The templates by the words of their shingles: five, or all words of a shorter one."""
    out: dict = {}
    for name, wording in templates.items():
        if n := len(re.findall(r"[^\x20\x09-\x0D]+", wording or "")):
            out.setdefault(min(n, K), {})[name] = wording
    return out


FOUND = "doc_id long, license string, n_shared long, n_template long"


def one_pass(docs: DataFrame, table: list, percent: int, text: str, k: int) -> DataFrame:
    known = {w: np.unique(np.concatenate([t[2] for t in table if t[3] == w])) for w in {t[3] for t in table}}

    def among(x, some):
        return some[np.minimum(np.searchsorted(some, x), len(some) - 1)] == x

    def run(batches):
        for batch in batches:
            rows = []
            for i, j, (x, row) in shingles_of(batch.column(1), k):
                bounds = np.searchsorted(row, np.arange(j - i + 1))
                for width, bands in known.items():
                    if len(x) < width:
                        continue
                    starts = np.arange(0, len(x) - width + 1, WINDOWS[width][2])
                    starts = np.union1d(starts, (bounds[1:] - width)[bounds[1:] - bounds[:-1] >= width])
                    starts = starts[row[starts] == row[starts + width - 1]]
                    own = window_bands(x, starts, width)
                    a, b = np.nonzero(among(own, bands))
                    for name, full, mine, w in table:
                        if w == width and len(a):
                            for r in np.unique(row[starts[a[among(own[a, b], mine)]]]):
                                shared = int(np.isin(full, x[bounds[r] : bounds[r + 1]]).sum())
                                if 100 * shared >= percent * len(full):
                                    rows.append((i + int(r), name, shared, len(full)))
            if rows:
                at, *cols = zip(*sorted(rows), strict=True)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), pa.array(cols[0]), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64())], ["doc_id", "license", "n_shared", "n_template"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), quoted(text).alias("text")).mapInArrow(run, FOUND)
