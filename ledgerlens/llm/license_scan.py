"""License scan: normalised text against licence templates by the Dice
coefficient over word bigrams.

Texts and templates are normalised to lower-case words of letters and digits.
Dice of a passage and a template is twice the number of bigrams they share
(each as often as in both) over the sum of their numbers of bigrams. A passage
of p bigrams can reach the threshold d against a template of t bigrams only if
t * d / (2 - d) <= p <= t * (2 - d) / d, and only if it holds t * d / (2 - d) of
the template's bigrams: templates whose bigrams a text has too few of, within
any passage of the allowed size, are pruned before any coefficient is
computed.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerlens.llm.common import text_chunks
from ledgerlens.llm.textops import LOWER, WORD_MULT, mix, span_hashes, word_spans

DICE = 0.8
#: A match of a template of at most this many bigrams must begin and end like
#: it, word for word: so short a notice differs from prose by its words alone.
SHORT = 3

_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
    "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
    "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
    "to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
    "the following conditions are met:"
)
_BSD_2 = (
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
    "disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
    "the following disclaimer in the documentation and/or other materials provided with the distribution."
)
_BSD_3 = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission."
)
_BSD_AS_IS = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)


def _gnu(subject: str, licence: str, version: str) -> str:
    """The notice that the GNU licences ask to be put on a program's files."""
    return (
        f"{subject} is free software: you can redistribute it and/or modify it under the terms of the GNU {licence} as "
        f"published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version."
    )


def _gnu_warranty(licence: str) -> str:
    return (
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
        f"warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {licence} for more details."
    )


_GPL, _LGPL, _AGPL = "General Public License", "Lesser General Public License", "Affero General Public License"
_APACHE = (
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
    "with the License. You may obtain a copy of the License at"
)

#: Short licence notices, the notices for files and the permission
#: paragraphs of common licences, and the full text of the short ones, as
#: published. Of overlapping matches the better one stays, of equals the longer,
#: so a full text goes before its first paragraph, and a notice of one version
#: before that of another.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        _MIT,
        f"{_MIT} The above copyright notice and this permission notice shall be included in all copies or substantial "
        f"portions of the Software. {_AS_IS}",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        _APACHE,
        f"{_APACHE} http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY '
        "KIND, either express or implied. See the License for the specific language governing permissions and limitations "
        "under the License.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        _gnu("This program", _GPL, "3"),
        f"{_gnu('This program', _GPL, '3')} {_gnu_warranty(_GPL)}",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        _gnu("This program", _GPL, "2"),
        _gnu("This program", _GPL, "2").replace("software: you", "software; you"),
        f"{_gnu('This program', _GPL, '2')} {_gnu_warranty(_GPL)}",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License version 2 as published by the Free Software Foundation.",
    ],
    "LGPL-2.1": [_gnu("This library", _LGPL, "2.1"), f"{_gnu('This library', _LGPL, '2.1')} {_gnu_warranty(_LGPL).replace('program', 'library')}"],
    "LGPL-3.0": [_gnu("This library", _LGPL, "3"), f"{_gnu('This library', _LGPL, '3')} {_gnu_warranty(_LGPL).replace('program', 'library')}"],
    "AGPL-3.0": [_gnu("This program", _AGPL, "3"), f"{_gnu('This program', _AGPL, '3')} {_gnu_warranty(_AGPL)}"],
    "BSD": [_BSD, "Released under the BSD License."],
    "BSD-2-Clause": [f"{_BSD} {_BSD_2}", f"{_BSD} {_BSD_2} {_BSD_AS_IS}"],
    "BSD-3-Clause": [f"{_BSD} {_BSD_2} {_BSD_3}", f"{_BSD} {_BSD_2} {_BSD_3} {_BSD_AS_IS}"],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "0BSD": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."],
    "Zlib": [
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software. Permission is granted to anyone to use this software "
        "for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the "
        "following restrictions:",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
        "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
        "purpose, commercial or non-commercial, and by any means.",
    ],
    "BSL-1.0": [
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
        'accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, '
        "execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to "
        "whom the Software is furnished to do so, all subject to the following:",
    ],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at",
    ],
}

_NOT_WORD = np.ones(256, bool)
_NOT_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = False


def bigrams(data: np.ndarray, offs: np.ndarray):
    """(bigram hashes, first bigram and one behind the last of each text)."""
    data = LOWER[data]
    starts, ends, first = word_spans(data, offs, _NOT_WORD[data])
    w = span_hashes(data, starts, ends)
    pairs = mix(w[:-1] * WORD_MULT[0] + w[1:] * WORD_MULT[1]) if len(w) else w
    return pairs, first[:-1], np.maximum(first[:-1], first[1:] - 1)


def compiled(templates: dict[str, list[str]]) -> list[tuple[str, np.ndarray, Counter]]:
    out = []
    for name, texts in templates.items():
        for text in texts:
            raw = np.frombuffer(text.encode(), np.uint8)
            pairs = bigrams(raw, np.array([0, len(raw)]))[0]
            if len(pairs):
                out.append((name, pairs, Counter(pairs.tolist())))
    return out


def passages(pairs: np.ndarray, hits: np.ndarray, size: int, wanted: Counter, dice: float) -> list[tuple[float, int, int]]:
    """(Dice, first bigram, one behind the last) of the best passages of a
    text against one template, none overlapping; ``hits`` are the places of
    the template's bigrams. The best passages begin and end at a hit."""
    least, most = size * dice / (2 - dice), size * (2 - dice) / dice
    found = []
    for k, a in enumerate(hits):
        shared, left = 0, dict(wanted)
        for b in hits[k:]:
            length = b - a + 1
            if length > most:
                break
            key = int(pairs[b])
            if left[key]:
                left[key] -= 1
                shared += 1
                if shared >= least and length >= least and 2 * shared >= dice * (size + length):
                    found.append((2 * shared / (size + length), int(a), int(b) + 1))
    best = []
    for d, a, b in sorted(found, key=lambda x: (-x[0], x[1], x[2])):
        if all(b <= x or a >= y for _, x, y in best):
            best.append((d, a, b))
    return best


def scan_text(pairs: np.ndarray, templates, known: np.ndarray, dice: float) -> list[tuple[str, float, int, int]]:
    """(licence, Dice, first word, last word) of a text's passages; where
    templates overlap, the better match stays, and of equals the longer."""
    if not len(pairs):
        return []
    at = np.minimum(np.searchsorted(known, pairs), len(known) - 1)
    hit = np.flatnonzero(known[at] == pairs)
    if not len(hit):
        return []
    found = []
    values = pairs[hit]
    for name, own, wanted in templates:
        places = hit[np.isin(values, own)]
        if len(places) >= len(own) * dice / (2 - dice):
            for d, a, b in passages(pairs, places, len(own), wanted, dice):
                if len(own) > SHORT or d == 1.0:
                    found.append((name, d, a, b))
    best = []
    for name, d, a, b in sorted(found, key=lambda x: (-x[1], x[2] - x[3], x[2], x[0])):
        if all(b <= x or a >= y for _, _, x, y in best):
            best.append((name, d, a, b))
    return sorted(best, key=lambda x: x[2])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", dice: float = DICE, templates: dict[str, list[str]] | None = None) -> DataFrame:
    """Per row: the id, ``license`` and ``dice`` of the best match (null and 0
    without one; the first of equals), ``n_matches`` and ``matches``: an array
    of (license, dice, first_word, last_word) in text order.

    Whole texts are read, each by itself. A null or empty text has no match.
    """
    ready = compiled(TEMPLATES if templates is None else templates)
    known = np.unique(np.concatenate([p for _, p, _ in ready])) if ready else np.zeros(1, np.uint64)
    id_type = docs.schema[id_col].dataType.simpleString()
    item = pa.struct([("license", pa.string()), ("dice", pa.float64()), ("first_word", pa.int32()), ("last_word", pa.int32())])

    def run(batches):
        for batch in batches:
            for a, b, data, offs in text_chunks(batch.column(1)):
                pairs, first, last = bigrams(data, offs)
                got = [scan_text(pairs[x:y], ready, known, dice) for x, y in zip(first, last)]
                top = [max(m, key=lambda x: x[1]) if m else (None, 0.0) for m in got]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        pa.array([t[0] for t in top], pa.string()),
                        pa.array([t[1] for t in top], pa.float64()),
                        pa.array([len(m) for m in got], pa.int32()),
                        pa.array([[dict(license=n, dice=d, first_word=x, last_word=y) for n, d, x, y in m] for m in got], pa.list_(item)),
                    ],
                    names=[id_col, "license", "dice", "n_matches", "matches"],
                )

    return docs.select(docs[id_col], docs[text_col]).mapInArrow(
        run,
        f"`{id_col}` {id_type}, license string, dice double, n_matches int, "
        "matches array<struct<license: string, dice: double, first_word: int, last_word: int>>",
    )


def normalised_words(text: str) -> list[str]:
    """The words a text is compared by."""
    return [w.decode() for w in re.findall(rb"[0-9a-z\x80-\xff]+", bytes(LOWER[np.frombuffer(text.encode(), np.uint8)]))]
