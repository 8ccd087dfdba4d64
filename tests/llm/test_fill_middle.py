import hashlib
import random
import re

import numpy as np

from shopflow.llm import fill_middle

from .helpers import DOCS, awkward, nothing


def brute(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(units)
    i, j = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = "".join(units[:i]), "".join(units[i:j]), "".join(units[j:])
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    if h[3] % 100 < 20:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def texts():
    rng = random.Random(3)
    alphabet = ["a", "Z", "z", "A", "@", "[", "`", "{", "0", " ", "\n", "\x00", "\x7f", "é", "ß", "日", "😀", "́", "<", "P", ">", "S", "M", "K"]
    return ["".join(rng.choices(alphabet, k=rng.randrange(0, 40))) for _ in range(600)]


def test_units_and_cuts_on_all_kinds_of_text():
    with np.errstate(over="ignore"):
        for i, text in enumerate(texts()):
            assert fill_middle.cut_text(text, fill_middle.draws(i)) == brute(i, text)


def test_every_cut_position():
    for text in ("ab1cd éf日gh!", "😀" * 9, "abcdefgh", "abcdefghi jklmnopq", "a b c d e f g h i", ""):
        data, units = text.encode(), re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
        with np.errstate(over="ignore"):
            ends = fill_middle.unit_ends(data)
        upto = np.cumsum(np.bitwise_count(ends), dtype=np.int64)
        assert upto[-1] == len(units)
        for k in range(len(units) + 1):
            assert data[: fill_middle.select(ends, upto, k)].decode() == "".join(units[:k])


def test_round_trip_and_edges(spark):
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts())] + [(7, "has <P> inside", "en", "s", 0), (8, "<S", "en", "s", 0), (9, "x<M", "en", "s", 0)]
    docs = spark.createDataFrame(rows, DOCS)
    got = fill_middle.transform(docs)
    outputs = sorted((r.doc_id, r.n, r.form, r.prefix_chars or 0, r.middle_chars or 0, r.output) for r in got.collect())
    assert outputs == sorted((i, *(x or 0 if k in (2, 3) else x for k, x in enumerate(brute(i, t)))) for i, t, *_ in rows)
    assert {r.form for r in got.collect()} == {"plain", "psm", "spm"}
    want = sorted((i, hashlib.sha256(t.encode()).hexdigest()) for i, t, *_ in rows)
    assert sorted((r.doc_id, r.restored_sha256) for r in fill_middle.digests(got).collect()) == want


def test_awkward_rows(spark):
    docs = awkward(spark)
    got = fill_middle.digests(fill_middle.transform(docs)).collect()
    key = lambda r: (r[0] is None, r[0] or 0, str(r[1:]))
    want = [(r.doc_id, *brute(r.doc_id, r.text)[:4], hashlib.sha256(brute(r.doc_id, r.text)[4].encode()).hexdigest(),
             hashlib.sha256((r.text or "").encode()).hexdigest()) for r in docs.collect()]
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert fill_middle.transform(nothing(spark)).count() == 0


def test_shares_are_parameters(spark):
    docs = spark.createDataFrame([(i, "one two three", "en", "s", 0) for i in range(200)], DOCS)
    assert {r.form for r in fill_middle.transform(docs, plain_share=0, suffix_first_share=100).collect()} == {"spm"}
    assert {r.form for r in fill_middle.transform(docs, plain_share=100).collect()} == {"plain"}
    assert fill_middle.transform(docs, seed="2").exceptAll(fill_middle.transform(docs)).count() > 0
