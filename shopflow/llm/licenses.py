"""License scans by MinHash bands over overlapping text windows.

Templates and texts are sequences of 5-word shingles (words lower-cased, without
punctuation at their ends). A size class holds the templates of more than L/2
and at most L shingles; its windows are 2L shingles long and start every L, so each passage of
up to L + 1 shingles lies whole in a window. A window that contains at least ``CONTAINMENT`` of a template's
shingles has a Jaccard similarity of at least ``j`` with it, and the class uses
so many one-row bands that at least one agrees with probability ``1 - MISS`` or more:
``(1 - j) ** bands <= MISS``. Windows whose bands agree are verified
by exact shingle containment, over the window and one more stride on both sides.

Words lose comment marks at their ends, and words of marks only are left out, so
notices in source comments match; positions count all white-space separated words.
Ids of ``SPDX-License-Identifier`` lines are matches too. The GNU licenses' family and version and the BSD
licenses' clauses are read from the matched words; clauses of any length, up to the disclaimer, the next BSD sentence or the
text's end (``BSD``: no disclaimer and no clause that tells).

Defined results: null texts and texts under five words match nothing. Repeated rows are
scanned each. Other columns are ignored. An empty table gives no rows.
The work is map-only, on whole texts, without a shuffle; the templates are a fixed, small table.
"""

from __future__ import annotations

import math
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopflow.llm.common import map_text, ship

#: License notices and headers, by SPDX identifier.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
                   "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
                   "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
                   "either express or implied."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
            "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
            "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
                         "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
                     "conditions are met"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
            "the above copyright notice and this permission notice appear in all copies."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION"),
    ("GPL-2.0-or-later", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as "
                         "published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as "
                "published by the Free Software Foundation."),
    ("LGPL-2.1-or-later", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
                          "published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("AGPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as "
                          "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("MPL-2.0", "\"Contributor\" means each individual or legal entity that creates, contributes to the creation of, or owns Covered Software."),
    ("CC0-1.0", "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the "
                "public domain worldwide."),
    ("CC0-1.0", "The laws of most jurisdictions throughout the world automatically confer exclusive Copyright and Related Rights (defined below) upon the "
                "creator and subsequent owner(s) (each and all, an \"owner\") of an original work of authorship and/or a database (each, a \"Work\")."),
    ("EPL-1.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this "
                "distribution, and is available at http://www.eclipse.org/legal/epl-v10.html"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at "
                "https://www.eclipse.org/legal/epl-2.0/"),
    ("Zlib", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it "
             "freely, subject to the following restrictions"),
    ("BSL-1.0", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying "
                "documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software"),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
NGRAM = 5
CONTAINMENT = 0.75
MISS = 1e-5
#: Punctuation and comment marks that words lose at their ends; what is nothing else is no word.
EDGE = b".,;:!?()[]{}<>\"'`*#/-%|"
#: Notices that differ in a word or two are told apart by the words themselves.
GNU = re.compile(rb"(?:(lesser|library|affero) )?general public license")
GNU_TERMS = re.compile(rb"terms of the gnu (?:(lesser|library|affero) )?general public license")
GNU_VERSION = re.compile(rb"(?:version|v) ?([123](?:\.\d)?)\b")
SPDX = re.compile(rb"spdx-license-identifier:?[ \t]*([^\r\n]*)", re.I)
SPDX_ID = re.compile(rb"[A-Za-z0-9][A-Za-z0-9.+-]*")
#: The words that begin the BSD licenses' disclaimer, where their clauses end.
DISCLAIMER = [b"this", b"software", b"is", b"provided"]
U64 = np.uint64
SCHEMA = "doc_id bigint, n_matches bigint, licenses string, matches string, containment double"


def lexed(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words, and the place of each among the text's white-space separated words."""
    from xxhash import xxh3_64_intdigest

    words = [w.strip(EDGE) for w in text.encode().lower().split()]
    at = [i for i, w in enumerate(words) if w]
    return np.fromiter((xxh3_64_intdigest(words[i]) for i in at), U64, len(at)), np.array(at, np.int64)


def word_hashes(text: str) -> np.ndarray:
    return lexed(text)[0]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def shingled(words: np.ndarray) -> np.ndarray:
    """Hash of the five words at each position but the last four."""
    k = max(0, len(words) - NGRAM + 1)
    total = np.zeros(k, U64)
    for i in range(NGRAM):
        total = total * U64(0x9E3779B97F4A7C15) + mixed(words[i : i + k] + U64(i))
    return mixed(total)


def bands_for(j: float) -> int:
    """One-row bands of which one agrees with probability 1 - MISS or more, at Jaccard ``j``."""
    return 1 if j >= 1 else math.ceil(math.log(MISS) / math.log(1 - j))


class Matcher:
    """Templates by size class, with their band values."""

    def __init__(self, templates=TEMPLATES, containment: float = CONTAINMENT):
        with np.errstate(over="ignore"):
            self.templates = [(name, np.unique(shingled(word_hashes(text)))) for name, text in templates]
            self.containment = containment
            self.classes: dict[int, tuple[int, list[int]]] = {}
            for i, (_, s) in enumerate(self.templates):
                size = 1 << max(0, math.ceil(math.log2(len(s))))
                t, c = len(s), math.ceil(containment * len(s) - 1e-9)
                j = 1.0 if size == 1 else c / (2 * size + t - c)
                bands, members = self.classes.get(size, (0, []))
                self.classes[size] = (max(bands, bands_for(j)), [*members, i])
            n = max(b for b, _ in self.classes.values())
            self.odd = mixed(np.arange(1, n + 1, dtype=U64) * U64(0xC2B2AE3D27D4EB4F)) | U64(1)
            # per class: the template values of each band, and a table of their low bits that most windows fail
            self.values = {size: [np.array([(self.templates[i][1] * self.odd[b]).min() for i in members], U64) for b in range(bands)]
                           for size, (bands, members) in self.classes.items()}
            self.low = {size: [self._table(v) for v in values] for size, values in self.values.items()}

    @staticmethod
    def _table(values: np.ndarray) -> np.ndarray:
        table = np.zeros(1 << 16, bool)
        table[(values >> U64(48)).astype(np.int64)] = True
        return table

    def candidates(self, h: np.ndarray) -> set[tuple[int, int, int]]:
        """(template, from, to) of the windows of the shingle stream that agree with a template in a band."""
        out = set()
        if not len(h):
            return out
        least = min((s for s in self.classes if s > 1), default=1)
        n_blocks = -(-len(h) // least)
        padded = np.full(n_blocks * least, np.iinfo(np.uint64).max, U64)
        for b in range(len(self.odd)):
            values = h * self.odd[b]
            if 1 in self.classes and b < self.classes[1][0]:
                self._agreeing(out, 1, b, values, len(h))
            padded[: len(h)] = values
            blocks, size = padded.reshape(-1, least).min(axis=1), least
            while size <= max(self.classes):
                if size in self.classes and b < self.classes[size][0]:
                    self._agreeing(out, size, b, np.minimum(blocks, np.r_[blocks[1:], blocks[-1:]]), len(h))
                blocks = np.minimum(blocks[::2], np.r_[blocks[1::2], blocks[-1:]][: len(blocks[::2])])
                size *= 2
        return out

    def _agreeing(self, out, size, b, windows, end):
        for w in np.flatnonzero(self.low[size][b][(windows >> U64(48)).astype(np.int64)]):
            for k in np.flatnonzero(self.values[size][b] == windows[w]):
                at = int(w) * size
                out.add((self.classes[size][1][k], at, min(end, at + (2 * size if size > 1 else 1))))

    def scan(self, texts: list[str]) -> list[list[tuple[str, int, int, float]]]:
        """Per text: (license, first word, last word + 1, containment), merged per template, by position."""
        with np.errstate(over="ignore"):
            lexes = [lexed(t) for t in texts]
            each, places = [shingled(h) for h, _ in lexes], [p for _, p in lexes]
            starts = np.cumsum([0, *map(len, each)])
            stream = np.concatenate(each) if each else np.empty(0, U64)
            found: list[dict[int, list[tuple[int, int, float]]]] = [{} for _ in texts]
            for i, a, b in sorted(self.candidates(stream)):
                name, wanted = self.templates[i]
                stride = max(1, (b - a) // 2)
                for d in range(int(np.searchsorted(starts, a, "right")) - 1, int(np.searchsorted(starts, b - 1, "right"))):
                    low, high = max(0, a - stride - int(starts[d])), min(len(each[d]), b + stride - int(starts[d]))
                    if low >= high:
                        continue
                    part = each[d][low:high]
                    at = np.flatnonzero(np.isin(part, wanted))
                    share = len(np.unique(part[at])) / len(wanted)
                    if share >= self.containment:
                        found[d].setdefault(i, []).append(
                            (int(places[d][low + int(at[0])]), int(places[d][low + int(at[-1]) + NGRAM - 1]) + 1, share))
        return [self._merged(f) for f in found]

    def _merged(self, found) -> list[tuple[str, int, int, float]]:
        return merged((self.templates[i][0], *span) for i, spans in found.items() for span in spans)


def merged(matches) -> list[tuple[str, int, int, float]]:
    """Overlapping (license, first, end, share) of one license as one, by position."""
    out: dict[str, list[list]] = {}
    for name, *span in matches:
        out.setdefault(name, []).append(span)
    joined = []
    for name, spans in out.items():
        held: list[list] = []
        for a, b, share in sorted(spans):
            if held and a < held[-1][1]:
                held[-1][1:] = [max(held[-1][1], b), max(held[-1][2], share)]
            else:
                held.append([a, b, share])
        joined += [(name, a, b, s) for a, b, s in held]
    return sorted(joined, key=lambda m: (m[1], m[0]))


def clauses(words: list[bytes], starts: list[int]) -> dict[int, tuple[bytes, bool]]:
    """Per BSD sentence, by its first word: the text up to the disclaimer, the next BSD sentence or the end, and whether a disclaimer ends it."""
    out = {}
    for a, end in zip(starts, [*starts[1:], len(words)]):
        own = [w for w in (x.strip(EDGE).lower() for x in words[a:end]) if w]
        at = next((i for i in range(len(own) - 3) if own[i] == DISCLAIMER[0] and own[i : i + 4] == DISCLAIMER), -1)
        out[a] = b" ".join(own[:at] if at >= 0 else own), at >= 0
    return out


def exact_name(name: str, words: list[bytes], a: int, b: int, bsd: dict[int, tuple[bytes, bool]]) -> str:
    """The license that the matched words name: GNU family and version, BSD clauses."""
    plain = lambda i, j: b" ".join(w for w in (x.strip(EDGE) for x in words[max(0, i) : j]) if w).lower()
    if name == "BSD":
        text, ended = bsd[a]
        if b"advertising materials mentioning" in text:
            return "BSD-4-Clause"
        if b"endorse or promote" in text:
            return "BSD-3-Clause"
        return "BSD-2-Clause" if ended else "BSD"
    if "GPL" in name:
        own = plain(a - 4, b + 20)
        family, version = GNU_TERMS.search(own) or GNU.search(own), GNU_VERSION.search(own)
        if family and version:
            letter = {b"affero": "A", b"lesser": "L", b"library": "L"}.get(family[1], "")
            number = version[1].decode()
            return f"{letter}GPL-{number if '.' in number else number + '.0'}" + ("-or-later" if b"any later version" in own else "")
    return name


def identifiers(text: str) -> list[tuple[str, int, int, float]]:
    """License ids of the SPDX-License-Identifier lines, with the words of the line."""
    raw = text.encode()
    out = []
    for m in SPDX.finditer(raw):
        first = len(raw[: m.start()].split())
        end = first + len(m[0].split())
        out += [(x[0].decode().rstrip("-."), first, end, 1.0) for x in SPDX_ID.finditer(m[1]) if x[0] not in (b"AND", b"OR", b"WITH")]
    return out


def named(matches: list[tuple[str, int, int, float]], text: str) -> list[tuple[str, int, int, float]]:
    """The matches of a text under their exact names, with its SPDX lines."""
    out = []
    if matches:
        words = text.encode().split()
        bsd = clauses(words, sorted({a for n, a, _, _ in matches if n == "BSD"}))
        out = [(exact_name(n, words, a, b, bsd), a, b, s) for n, a, b, s in matches]
    if "spdx-license-identifier" in text.lower():
        out += identifiers(text)
    return merged(out)


_MATCHER: list[Matcher] = []


def _scan(ids, texts):
    if not _MATCHER:
        _MATCHER.append(Matcher())
    found = [named(f, t) for f, t in zip(_MATCHER[0].scan(texts), texts)]
    return {"doc_id": ids, "n_matches": list(map(len, found)), "licenses": [",".join(sorted({m[0] for m in f})) for f in found],
            "matches": [",".join(f"{n}:{a}:{b}" for n, a, b, _ in f) for f in found],
            "containment": [max((m[3] for m in f), default=0.0) for f in found]}


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: its license matches as license:first word:end word, and the best containment."""
    ship(docs.sparkSession)
    return map_text(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), _scan, SCHEMA)
