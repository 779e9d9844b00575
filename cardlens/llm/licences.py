"""Licence notices in documents, by the Dice coefficient over word bigrams.

Every stretch of a document may be a notice; the best one for a template begins and ends with bigrams of the
template. A stretch and a template, both normalised to terms, are compared by their sets of bigrams: twice the
common ones over the sum of both sizes. A stretch that is too short or too long for a template cannot reach the threshold, whatever it
says, so the size bounds prune most templates before anything is compared.
"""

from __future__ import annotations

import bisect
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cardlens.llm.common import known_terms, slices, terms

_AS_IS = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
    "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
    "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
    "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
    "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR "
    "OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
    "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
    "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
    "with the distribution. "
)
_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
    "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
    "permit persons to whom the Software is furnished to do so, subject to the following conditions:"
)
# The wording of common licences and licence notices, by SPDX identifier.
TEMPLATES: dict[str, list[str]] = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License.",
    ],
    "MIT": [
        "Released under the MIT License.",
        "This project is licensed under the MIT License.",
        "Licensed under the MIT License.",
        f"{_MIT[:-1]}.",
        f"{_MIT} The above copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, "
        "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
        "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
        "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
        "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files, to deal in the Software without restriction.",
    ],
    "ISC": [
        "Licensed under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE "
        "IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
        "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER "
        "IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
        "PERFORMANCE OF THIS SOFTWARE.",
    ],
    "BSD-2-Clause": ["Licensed under the BSD 2-Clause License.", _BSD + _AS_IS],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, "
        "or (at your option) any later version.",
    ],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2."],
    "LGPL-3.0": ["This work is licensed under the GNU Lesser General Public License, version 3."],
    "AGPL-3.0": ["This work is licensed under the GNU Affero General Public License, version 3."],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ],
    "BSD-3-Clause": [
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met.",
        f"{_BSD}3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
        f"promote products derived from this software without specific prior written permission. {_AS_IS}",
    ],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-ND-4.0": [
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    ],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0."],
    "CC0-1.0": ["Released under CC0 1.0 Universal.", "This work is dedicated to the public domain under CC0 1.0."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
}
_WORD = re.compile(r"\S+")
_CUT = re.compile(r"(?<=[.!?])\s+|\n+")


def bigrams(words: list[str]) -> set[tuple[str, str]]:
    return set(zip(words, words[1:]))


def dice(a: set, b: set) -> float:
    return 2 * len(a & b) / (len(a) + len(b)) if a or b else 0.0


@dataclass(frozen=True)
class Templates:
    """Templates ready to be compared, in the order of their identifiers."""

    names: list[str]
    grams: list[set]
    least: float

    @staticmethod
    def of(templates: dict[str, list[str]], least: float) -> Templates:
        rows = [(name, bigrams(terms(text))) for name, texts in sorted(templates.items()) for text in texts]
        rows = [(name, grams) for name, grams in rows if grams]
        return Templates([n for n, _ in rows], [g for _, g in rows], least)

    def bounds(self, number: int) -> tuple[int, int]:
        """The numbers of bigrams a stretch must have to reach the threshold with a template."""
        n, t = len(self.grams[number]), self.least
        return math.ceil(n * t / (2 - t) - 1e-9), math.floor(n * (2 - t) / t + 1e-9)

    def find(self, text: str) -> Iterator[tuple[str, float, int, int]]:
        """Name, coefficient and character span of each notice: the best match of stretches that overlap."""
        words: list[str] = []
        spans: list[tuple[int, int]] = []
        for raw in _WORD.finditer(text):
            more = terms(raw.group())
            words += more
            spans += [raw.span()] * len(more)
        pairs = list(zip(words, words[1:]))
        where: dict[tuple[str, str], list[int]] = {}
        for i, pair in enumerate(pairs):
            where.setdefault(pair, []).append(i)
        alike: list[tuple[float, int, int, int, str]] = []
        for number, (wanted, name) in enumerate(zip(self.grams, self.names)):
            low, _ = self.bounds(number)
            if sum(g in where for g in wanted) < low:
                continue  # a stretch that reaches the threshold shares as many bigrams
            n = len(wanted)
            foreign = math.floor(n * (2 / self.least - 2) + 1e-9)  # bigrams that are not the template's
            for begin in sorted(i for g in wanted for i in where.get(g, ())):
                seen: set[tuple[str, str]] = set()
                common = 0
                for end in range(begin, len(pairs)):
                    pair = pairs[end]
                    if pair in seen:
                        if pair == pairs[begin]:
                            break  # the same bigrams follow without this one
                        continue
                    seen.add(pair)
                    if pair not in wanted:
                        if len(seen) - common > foreign:
                            break
                        continue
                    common += 1
                    value = 2 * common / (len(seen) + n)
                    if value >= self.least:
                        alike.append((-value, -n, spans[begin][0], spans[end + 1][1], name))
        taken: list[tuple[int, int]] = []
        for value, _, begin, end, name in sorted(alike):
            at = bisect.bisect_left(taken, (begin, end))
            if (at == len(taken) or end <= taken[at][0]) and (not at or taken[at - 1][1] <= begin):
                taken.insert(at, (begin, end))
                yield name, -value, begin, end


def scan(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", templates: dict[str, list[str]] | None = None, least: float = 0.8
) -> DataFrame:
    """``doc_id``, ``licence``, ``dice``, ``begin`` and ``end`` of every notice in each document.

    A notice is a stretch whose coefficient is ``least`` or more; of stretches that overlap, and of licences
    that one stretch resembles, the best is reported (ties: the longer template, the first stretch, the first name). Texts are
    scanned whole, those without a notice have no row, nor have null and empty ones; rows that repeat a
    document are each reported; an empty table or an empty set of templates has an empty result. Other columns play no part.
    """
    schema = "doc_id long, licence string, dice double, begin long, end long"
    given = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    known_templates = Templates.of(TEMPLATES if templates is None else templates, least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = known_templates
        if not ready.names:
            return
        number = {t: i + 1 for i, t in enumerate(sorted({w for g in ready.grams for pair in g for w in pair}))}
        width = len(number) + 1
        pairs = sorted({number[a] * width + number[b] for g in ready.grams for a, b in g})
        pairs = np.array(pairs or [-1])
        needed = min((ready.bounds(i)[0] for i in range(len(ready.grams))), default=0)
        known = known_terms(number)
        for batch in slices(batches, "text", 1 << 20):
            rows = []
            given_texts = pa.compute.fill_null(batch["text"], "")
            for doc, whole, ids in zip(batch["doc_id"].to_pylist(), given_texts, known.ids(given_texts)):
                ids = ids.astype(np.int64)
                both = np.flatnonzero((ids[1:] > 0) & (ids[:-1] > 0))
                if len(both) < needed:
                    continue
                seen = np.unique(ids[both] * width + ids[both + 1])
                # A notice shares at least as many bigrams with its template as the lower size bound.
                if np.isin(seen, pairs).sum() >= needed:
                    rows += [(doc, *found) for found in ready.find(whole.as_py())]
            if rows:
                kinds = (pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["doc_id", "licence", "dice", "begin", "end"])

    return given.mapInArrow(run, schema)
