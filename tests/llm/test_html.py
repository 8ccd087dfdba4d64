import html as references
import random
import re

import pytest

from shopflow.llm import html_crf as H


@pytest.fixture(scope="module")
def pages():
    import duckdb

    return [r for r in duckdb.connect().execute("SELECT page_id, html FROM read_parquet('/root/testdata/sf0.01/pages.parquet') ORDER BY page_id").fetchall()]


@pytest.fixture(scope="module")
def field(pages):
    return H.fitted([h for _, h in pages[:120]])


def article(page):
    """The article's blocks by plain cutting, for the given pages' template."""
    out = []
    for x in re.split(r"</?(?:p|h1)\b[^>]*>", re.search(r"<article>(.*?)</article>", page, re.S)[1]):
        x = " ".join(references.unescape(re.sub(r"<[^>]*>", "", x.replace("<br>", " "))).split())
        if x:
            out.append(x)
    return "\n".join(out)


def test_held_out_pages(pages, field):
    assert all(H.main_text(h, field) == article(h) for _, h in pages[120:])


def test_held_out_templates(pages, field):
    rng, right, n = random.Random(77), 0, 0
    for _, h in pages[120:]:
        parts = H.blocks(h)
        made, want = H.made_page([b[0] for b, y in zip(parts, H.own_labels(parts)) if y][:30], rng)
        got = field.decode(H.features(made))
        right += sum(a == b for a, b in zip(got, want))
        n += len(want)
    assert right / n > 0.98


def test_page_parts(field):
    page = ('<html><head><title>T</title><style>p{}</style><body><header><h1>Site</h1></header><nav><a href=x>Home</a></nav><div class="sidebar"><p>Popular posts of '
            'this week are here.</p></div><article><h1>Title</h1><script>var t="</p>";</script><p>A &amp; B&nbsp;text<br>next <b>li</b>ne.<p>Open paragraph.<ul><li>one<li>two'
            '</ul><form><label>Name</label><textarea>x</textarea></form><aside>Side note here.</aside><section class="comments"><p>Great post, thanks a lot!</p></section>'
            '</article><div class="cookie-notice">We use cookies.</div><footer>&copy; x</footer>')
    assert H.main_text(page, field) == "Title\nA & B text next line.\nOpen paragraph.\none\ntwo"


@pytest.mark.parametrize("page,want", [
    ("", []), ("plain text", ["plain text"]), ("<p>a<p>b", ["a", "b"]), ("<!-- <p>no</p> --><p>yes</p>", ["yes"]), ("<p>1 < 2</p>", ["1 < 2"]), ("<script>x", []),
    ("<td title='a>b'>c</td>", ["c"]), ("<p title='open>text</p>", ["text"]), ("</div></p>x", ["x"]), ("<div>a<div>b</div>c</div>", ["a", "b", "c"]), ("<b>a</b><i>b</i>", ["ab"]),
    ("<p>a\n\t b&#10;c</p>", ["a b c"]), ("<head><title>t</title><body>b", ["b"]),
])
def test_blocks(page, want):
    assert [b[0] for b in H.blocks(page)] == want


@pytest.mark.parametrize("page", [
    "<div>x" * 100_000, "<i>x</b>" * 100_000, "<a" * 500_000, "<!a" * 500_000, "<" + "a" * 1_000_000, "".join(f'<p class="c{chr(97 + i % 26)}q{chr(97 + i // 26 % 26)}z{i}">x' for i in range(50_000)),
    '<div class="' + "".join(f"{a}{b}{c} " for a in "abcdefgh" for b in "abcdefgh" for c in "abcdefgh") + '">' + "a<p>b</p>" * 20_000, "<a title='\"" * 100_000 + ">",
])
def test_long_misnested_pages(page, field):
    """Half a megabyte in seconds; time four times as long per doubling would take minutes."""
    import time

    start = time.monotonic()
    H.main_text(page, field)
    assert time.monotonic() - start < 20


@pytest.mark.parametrize("page,want", [
    ("<p>Let <math><mi>x</mi><annotation>\\x</annotation></math> be", ["Let x be"]), ("<p>a</p><!-- <p>b</p>", ["a"]), ("<p>a<!-->b", ["ab"]), ("<p>a</p>x<!--", ["a", "x"]),
    ("<p>&#" + "9" * 6000 + ";", ["\ufffd"]), ("<p>&#00000000065;", ["A"]),
])
def test_rare_markup(page, want):
    assert [b[0] for b in H.blocks(page)] == want


def test_shared_ancestors_give_the_features_of_the_path(pages):
    """Scores, labels and sums by nodes against features listed for each block."""
    f = H.Field()
    for _, h in pages[:10]:
        parts = H.blocks(h)
        listed = []
        for fs in H.features(parts):
            node = next(x for x in fs if isinstance(x, H.Node))
            path, up = [], node
            while up.parent is not None:
                path.append(up)
                up = up.parent
            listed.append([x for x in fs if x is not node] + node.own + sorted({f"in={x.tag}" for x in path} | {f"name={w}" for x in path for w in x.words}))
        rng = random.Random(4)
        f.weights = {x: rng.uniform(-1, 1) for fs in listed for x in fs}
        assert f.unary(H.features(parts)) == pytest.approx(f.unary(listed))
        at = [rng.uniform(-1, 1) for _ in listed]
        assert f.summed(H.features(parts), at) == pytest.approx(f.summed(listed, at), abs=1e-9)


def test_sample_holds_different_pages(spark):
    rows = spark.createDataFrame([(1, "<p>a")] * 50 + [(2, "<p>b"), (2, "<p>c"), (None, "<p>d"), (3, ""), (4, None)], "page_id long, html string")
    assert sorted(H.sampled(rows, 10)) == ["<p>a", "<p>b", "<p>c", "<p>d"] and len(H.sampled(rows, 2)) == 2


def test_gradient_is_the_slope():
    """Forward-backward against a sum over all label sequences."""
    import itertools
    import math

    rng = random.Random(8)
    f = H.Field()
    page = [[rng.choice("abcd") for _ in range(2)] for _ in range(5)]
    f.weights = {k: rng.uniform(-1, 1) for k in "abcd"}
    f.moves = [[rng.uniform(-1, 1) for _ in "xx"] for _ in "xx"]
    u = f.unary(page)
    value = lambda y: sum(s for s, b in zip(u, y) if b) + sum(f.moves[a][b] for a, b in zip(y, y[1:]))
    every = list(itertools.product((0, 1), repeat=5))
    z = sum(math.exp(value(y)) for y in every)
    at, _ = f.gradient(page, [0, 1, 1, 0, 1])
    for i, want in enumerate([0, 1, 1, 0, 1]):
        assert abs(at[i] - (want - sum(math.exp(value(y)) for y in every if y[i]) / z)) < 1e-9
    assert tuple(f.decode(page)) == max(every, key=value)


def test_table(spark, pages):
    rows = [*[(i, f"http://x/{i}", h) for i, h in pages[:40]], (900, None, None), (901, "u", ""), (None, "u", "<p>x"), (902, "u", "<div>" * 3000 + "deep"), (1, "http://x/1", pages[1][1])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS text", "2 AS n_chars")
    got = H.extract(df).collect()
    assert len(got) == len(rows)
    by = {r.page_id: r for r in got}
    for i, h in pages[:40]:
        assert by[i].text == article(h) and by[i].n_chars == len(by[i].text)
    assert by[900].text == "" and by[901].text == "" and by[900].url is None
    assert H.extract(df.limit(0)).count() == 0
