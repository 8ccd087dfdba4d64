import random
import textwrap

import numpy as np

from shopflow.llm import licenses
from shopflow.llm.common import table

from .helpers import awkward, nothing


def brute(m, text):
    """Licenses of which some window of twice the template's shingles holds the wanted share."""
    out = set()
    with np.errstate(over="ignore"):
        h = licenses.shingled(licenses.word_hashes(text))
        for name, wanted in m.templates:
            t = len(wanted)
            for i in range(len(h)):
                if h[i] in wanted and len(np.intersect1d(h[i : i + t + 1], wanted)) >= licenses.CONTAINMENT * t:
                    out.add(name)
                    break
    return out


def test_planted_templates():
    rng, m = random.Random(1), licenses.Matcher()
    filler = lambda n: " ".join(f"f{rng.randrange(10**6)}" for _ in range(n))
    texts, names = [], []
    for name, t in licenses.TEMPLATES:
        for n in (0, 3, 50, 400):
            texts.append(f"{filler(n)} {t.upper() if n == 3 else t}\n{filler(n)}")
            names.append(name)
    found = m.scan([*texts, "", filler(500)])
    for f, name, text in zip(found, names, texts):
        assert name in {x[0] for x in f}
        assert {x[0] for x in f} == brute(m, text)
    assert found[-1] == found[-2] == []


def test_edited_templates_against_brute_force():
    rng, m, missed, n = random.Random(2), licenses.Matcher(), 0, 0
    for name, t in licenses.TEMPLATES:
        for edits in (0, 1, 2):
            for _ in range(4):
                w = t.split()
                for _ in range(edits):
                    w[rng.randrange(len(w))] = "changed"
                text = " ".join([*(f"a{rng.randrange(999)}" for _ in range(rng.randrange(30))), *w, *(f"b{rng.randrange(999)}" for _ in range(20))])
                want, got = brute(m, text), {x[0] for x in m.scan([text])[0]}
                assert got >= want
                n += len(want)
    assert n > 50


def test_bands():
    for j in (0.2, 0.375, 0.9):
        assert (1 - j) ** licenses.bands_for(j) <= licenses.MISS


def test_spans_are_words():
    text = "one two Released under the MIT License. three Released under the MIT License."
    words = text.split()
    f = licenses.Matcher().scan([text])[0]
    assert [" ".join(words[a:b]) for _, a, b, _ in f] == ["Released under the MIT License."] * 2


def test_table(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    m = licenses.Matcher()
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in licenses.scan(docs).collect():
        assert set(filter(None, r.licenses.split(","))) == brute(m, texts[r.doc_id])
    assert licenses.scan(awkward(spark)).count() == 11 and licenses.scan(nothing(spark)).count() == 0


def names(text):
    return licenses._scan([1], [text])["licenses"][0]


def test_commented_headers():
    for name, t in licenses.TEMPLATES:
        for mark in ("# ", "// ", " * ", "-- ", ";; ", "#"):
            text = "\n".join(mark + x for x in textwrap.wrap(t, 72))
            assert name in {x[0] for x in licenses.Matcher().scan([text])[0]}, (name, mark)
    words = "# a\n# Released under\n# the MIT\n# License.\nb"
    (_, a, b, _), = licenses.Matcher().scan([words])[0]
    assert words.split()[a:b] == "Released under # the MIT # License.".split()


def test_families_are_told_apart():
    notice = "# This {what} is free software: you can redistribute it and/or modify it\n# under the terms of the GNU {kind}General Public License as published by\n" \
             "# the Free Software Foundation, either version {n} of the License, or\n# (at your option) any later version."
    for what, kind, n, want in (("program", "", 2, "GPL-2.0"), ("program", "", 3, "GPL-3.0"), ("library", "Lesser ", "2.1", "LGPL-2.1"),
                                ("library", "Lesser ", 3, "LGPL-3.0"), ("program", "Affero ", 3, "AGPL-3.0")):
        assert names(notice.format(what=what, kind=kind, n=n)) == want + "-or-later"
    common = next(t for n, t in licenses.TEMPLATES if n == "BSD") + ": 1. Redistributions of source code must retain the above copyright notice. "
    third = "3. Neither the name of the holder nor the names of its contributors may be used to endorse or promote products. "
    assert names(common + "THIS SOFTWARE IS PROVIDED BY") == "BSD-2-Clause"
    assert names(common + third + "THIS SOFTWARE IS PROVIDED BY") == "BSD-3-Clause"
    assert names(common) == "BSD"
    long = "2. " + "clause words without end " * 400
    assert names(common + long + third + "THIS SOFTWARE IS PROVIDED BY") == "BSD-3-Clause"
    assert names(common + long + "THIS SOFTWARE IS PROVIDED BY x. " + third) == "BSD-2-Clause"
    assert names(common + long + "THIS SOFTWARE IS PROVIDED BY x. " + common + third + "THIS SOFTWARE IS PROVIDED BY") == "BSD-2-Clause,BSD-3-Clause"
    assert names("// SPDX-License-Identifier: (MIT OR GPL-2.0-only) */\nint x;") == "GPL-2.0-only,MIT"
