"""Licence texts and notices found by the Dice coefficient over word bigrams.

A text is normalised to lower-cased words (letters, digits, and dots or hyphens inside, so that
version numbers stay whole). A template with n distinct bigrams can only match a span of m with

    Dice = 2 * common / (n + m) >= t    so    m <= n * (2 - t) / t  and  common >= n * t / (2 - t)

These bounds prune templates and spans before any set is compared: a template is looked at only
where enough of its bigrams stand close enough together. As bigrams outside the
template only lower the coefficient, the best span starts and ends at one of its bigrams, and its first bigram does
not come again in it: without the first place it would have as many in common. All
such spans within the bounds are compared; a place lies in as many of them as the template has bigrams at most. Of overlapping findings the best stays: more
bigrams in common, then a higher coefficient, then an earlier start, then the name. Templates of one word are not
allowed. Equal findings in different places are each reported.

Null or empty texts hold nothing. Texts are read whole; a line end is no border, so a notice may
run over lines. Repeated rows get equal results.
"""

from __future__ import annotations

import re
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from mainspool.llm.common import append, per_worker

THRESHOLD = 0.8

_WORD = re.compile(r"[^\W_]+(?:[.\-][^\W_]+)*")

# The parts that the two- and the three-clause licence share, and the third clause.
_BSD_CONDITIONS = """Redistribution and use in source and binary forms, with or without modification, are permitted
    provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright
    notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the
    above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other
    materials provided with the distribution."""
_BSD_THIRD = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
    promote products derived from this software without specific prior written permission."""
_BSD_DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
    WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR
    PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT,
    INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE
    GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF
    LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT
    OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

# The GNU licences' names, versions and what their notices call the work; the attribution licences' parts.
_GNU = {
    "GPL-2.0": ("General Public License", "2", "program"),
    "GPL-3.0": ("General Public License", "3", "program"),
    "LGPL-2.1": ("Lesser General Public License", "2.1", "library"),
    "LGPL-3.0": ("Lesser General Public License", "3", "library"),
    "AGPL-3.0": ("Affero General Public License", "3", "program"),
}
_CC = {
    "BY": "Attribution",
    "BY-SA": "Attribution-ShareAlike",
    "BY-NC": "Attribution-NonCommercial",
    "BY-ND": "Attribution-NoDerivatives",
    "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
    "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}
_GNU_WARRANTY = """This {work} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
    implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details."""
_GNU_LATER = """This {work} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as
    published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version."""
_GNU_ONLY = """This {work} is free software; you can redistribute it and/or modify it under the terms of version {version} of
    the GNU {name} as published by the Free Software Foundation."""


def _families() -> dict[str, str]:
    """The headers, notices and statements of licences that differ in name and version."""
    out = {}
    for spdx, (name, version, work) in _GNU.items():
        for kind, grant in (("or-later", _GNU_LATER), ("only", _GNU_ONLY)):
            out[f"{spdx}-{kind}"] = f"{grant} {_GNU_WARRANTY}".format(name=name, version=version, work=work)
        out[f"{spdx} notice"] = f"This work is licensed under the GNU {name}, version {version}."
    for spdx, name in _CC.items():
        out[f"CC-{spdx}-4.0 notice"] = f"Licensed under CC {spdx} 4.0."
        out[f"CC-{spdx}-4.0 statement"] = f"This work is licensed under a Creative Commons {name} 4.0 International License."
    return out


# Public licence texts and the customary short notices, by SPDX name.
TEMPLATES = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "Software"), to deal in the Software without restriction, including without
        limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
        Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
        The above copyright notice and this permission notice shall be included in all copies or substantial portions of
        the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT
        NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO
        EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN
        ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR
        OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
        hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE
        SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
        IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
        INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER
        IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
        PERFORMANCE OF THIS SOFTWARE.""",
    "BSD-2-Clause": f"{_BSD_CONDITIONS} {_BSD_DISCLAIMER}",
    "BSD-3-Clause": f"{_BSD_CONDITIONS} {_BSD_THIRD} {_BSD_DISCLAIMER}",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be
        held liable for any damages arising from the use of this software. Permission is granted to anyone to use this
        software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject
        to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that
        you wrote the original software. If you use this software in a product, an acknowledgment in the product
        documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such,
        and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from
        any source distribution.""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
        Unless required by applicable law or agreed to in writing, software distributed under the License is distributed
        on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for
        the specific language governing permissions and limitations under the License.""",
    "Unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to copy,
        modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled
        binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright
        laws, the author or authors of this software dedicate any and all copyright interest in the software to the public
        domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and
        successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future
        rights to this software under copyright law. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND,
        EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE
        AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN
        AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR
        OTHER DEALINGS IN THE SOFTWARE.""",
    "Unlicense opening": """This is free and unencumbered software released into the public domain. Anyone is free to copy,
        modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled
        binary, for any purpose, commercial or non-commercial, and by any means.""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL
        was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "MIT notice": "Released under the MIT License.",
    "MIT notice (licensed)": "Licensed under the MIT License.",
    "BSD-3-Clause notice": "Licensed under the BSD 3-Clause License.",
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "MPL-2.0 notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC0-1.0 statement": "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    **_families(),
}


def normalise(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


class Scanner:
    """Templates as sets of bigrams, each numbered, and the bounds that follow from the threshold."""

    def __init__(self, templates: dict[str, str], threshold: float = THRESHOLD):
        self.threshold = threshold
        self.names = sorted(templates)
        bags = [{*zip(w, w[1:])} for w in (normalise(templates[n]) for n in self.names)]
        if any(not b for b in bags):
            raise ValueError("a template needs two words")
        bigrams = sorted(set().union(*bags))
        self.number = {b: k for k, b in enumerate(bigrams)}
        self.words = {w: k for k, w in enumerate(sorted({w for b in bigrams for w in b}))}
        self.codes = {self.words[a] * len(self.words) + self.words[b]: k for (a, b), k in self.number.items()}
        self.sorted_codes = np.array(sorted(self.codes), np.int64)
        self.of_code = np.array([self.codes[c] for c in sorted(self.codes)], np.int64)
        self.sets = [np.array(sorted(self.number[b] for b in bag)) for bag in bags]
        self.size = np.array([len(b) for b in bags])
        self.least = np.ceil(self.size * threshold / (2 - threshold) - 1e-9).astype(int)
        self.most = np.floor(self.size * (2 - threshold) / threshold + 1e-9).astype(int)
        self.member = np.zeros((len(bags), len(bigrams)), bool)
        for k, s in enumerate(self.sets):
            self.member[k, s] = True

    def scan(self, text: str | None) -> list[dict]:
        words = normalise(text)
        look = self.words.get
        ids = np.fromiter((look(w, -1) for w in words), np.int64, len(words))
        pairs = np.flatnonzero((ids[:-1] >= 0) & (ids[1:] >= 0))
        if not len(pairs):
            return []
        code = ids[pairs] * len(self.words) + ids[pairs + 1]
        at = np.searchsorted(self.sorted_codes, code).clip(max=len(self.sorted_codes) - 1)
        hit = self.sorted_codes[at] == code
        places, bigrams = pairs[hit], self.of_code[at[hit]]
        if not len(places):
            return []
        found = []
        for k in range(len(self.names)):
            own = self.member[k, bigrams]
            if own.sum() >= self.least[k]:
                found += self._spans(k, places[own], bigrams[own], words)
        found.sort(key=lambda f: (-f[1], -f[0], f[2], f[4]))
        out: list[tuple] = []
        taken = np.zeros(len(words), bool)
        for f in found:
            if not taken[f[2] : f[3]].any():
                taken[f[2] : f[3]] = True
                out.append(f)
        return [{"license": n, "dice": d, "first_word": a, "words": b - a} for d, _, a, b, n in sorted(out, key=lambda f: f[2])]

    def _spans(self, k: int, places: np.ndarray, bigrams: np.ndarray, words: list[str]) -> list[tuple]:
        """The best span from each start; (dice, bigrams, first word, end word, name)."""
        out = []
        n, least, most = int(self.size[k]), int(self.least[k]), int(self.most[k])
        where, which = places.tolist(), bigrams.tolist()
        later: list[int] = []  # how many different bigrams come from each place on
        seen: set[int] = set()
        for b in reversed(which):
            seen.add(b)
            later.append(len(seen))
        later.reverse()
        again, last_of = [len(where)] * len(where), {}  # where each place's bigram comes again
        for i in reversed(range(len(where))):
            again[i] = last_of.get(which[i], len(where))
            last_of[which[i]] = i
        for i, start in enumerate(where):
            if later[i] < least:
                break
            stop = again[i]
            common, distinct, best, last = set(), set(), None, start
            for place, b in zip(islice(where, i, stop), islice(which, i, stop)):
                for p in range(last, place):
                    distinct.add((words[p], words[p + 1]))
                last = place
                distinct.add((words[place], words[place + 1]))
                if len(distinct) > most:
                    break
                common.add(b)
                dice = 2 * len(common) / (n + len(distinct))
                if dice >= self.threshold and (best is None or dice > best[0]):
                    best = (dice, len(common), start, place + 2, self.names[k])
                if len(common) == later[i]:
                    break
            if best:
                out.append(best)
        return out


def scan_licenses(docs: DataFrame, text: str = "text", templates: dict[str, str] | None = None, threshold: float = THRESHOLD, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``licenses``, an array of (license, dice, first_word, words) in text order."""
    templates = TEMPLATES if templates is None else templates
    key = hash((tuple(sorted(templates.items())), threshold))
    kind = pa.list_(pa.struct([("license", pa.string()), ("dice", pa.float64()), ("first_word", pa.int64()), ("words", pa.int64())]))

    def run(texts: pa.Array) -> list[pa.Array]:
        scanner = per_worker(("licences", key), lambda: Scanner(templates, threshold))
        return [pa.array([scanner.scan(t) for t in texts.to_pylist()], kind)]

    return append(docs, "licenses array<struct<license:string,dice:double,first_word:bigint,words:bigint>>", run, text, keep=keep)
