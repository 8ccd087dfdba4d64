"""Main text of web pages by a linear-chain conditional random field over leaf blocks.

A page becomes its leaf blocks in page order: runs of text between the edges of
block elements, each with its ancestors' tags and class or id words. The field has two
labels, text and rest, with weights for block features (ancestors, own tag, link share,
length, punctuation, position) and for label changes. It is trained on the
driver on a bounded sample of ``SAMPLE`` labelled pages, by gradients of the exact
conditional likelihood (forward-backward), and pages are decoded by Viterbi in Arrow batches.

Labelled pages: a sampled page that has an ``article`` or ``main`` element labels its own blocks
(inside, but not in navigation, asides, forms, footers, adverts or comments there; an article's own header holds its title).
As these all look alike, each one's texts are also set into made-up templates with other
containers (sidebars, notices, adverts, forms, reader comments, menus) of known labels.

Defined results: null or empty html gives an empty text, as does a page without text blocks. Scripts,
styles, heads, comments and other elements that are not shown give no blocks. Unclosed or
misnested tags are closed as far as needed. Character references are decoded; white space inside a block is one
space; blocks are joined by one line feed. Text of formulas stays, their hidden annotations go. Numeric references beyond any character
give U+FFFD. Time grows with a page's length, also on misnested or unclosed markup: blocks share their ancestors. Repeated rows are each extracted. A null url stays null. Other columns are
ignored. An empty table gives no rows. Decoding is map-only.
"""

from __future__ import annotations

import html as references
import math
import random
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopflow.llm.common import ship

SAMPLE = 200
EPOCHS = 6
SCHEMA = "page_id bigint, url string, text string, n_chars bigint"

#: Comments; well-formed tags; tags with a stray quote; other markup. Names and attributes give nothing back, so no part is read again and again.
MARKUP = re.compile(r"""<!--(?:-?>|.*?-->|.*)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^<>"']|"[^"<]*"|'[^'<]*')*+)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)([^>]*+)>|<[!?/][^>]*+>""", re.S)
#: Numeric references too long for any character.
TOO_LONG = re.compile(r"&#(?:0*[1-9][0-9]{7,}|[xX]0*[1-9a-fA-F][0-9a-fA-F]{6,});?")
NAMES = re.compile(r"""(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
NAME_WORD = re.compile(r"[a-z]+")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is not shown as text.
HIDDEN = frozenset("head script style noscript template iframe svg object canvas audio video annotation annotation-xml textarea select".split())
#: Of those, the ones whose content is not markup.
RAW = frozenset("script style noscript iframe textarea".split())
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html label legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split())
#: What an opening tag closes first, up to the nearest of the bounds.
IMPLIED = {
    "li": ({"li", "p"}, {"ul", "ol", "menu", "div", "td", "section", "article", "nav"}), "dt": ({"dt", "dd", "p"}, {"dl"}), "dd": ({"dt", "dd", "p"}, {"dl"}),
    "tr": ({"tr", "td", "th", "p"}, {"table"}), "td": ({"td", "th", "p"}, {"tr", "table"}), "th": ({"td", "th", "p"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
INLINE_BOUND = frozenset("article aside body button div footer form header html li main nav section table td th blockquote".split())
OUTSIDE = frozenset("nav aside form footer".split())
OUTSIDE_WORDS = frozenset("ad ads advert sidebar comment comments menu nav notice cookie promo share related newsletter".split())



class Node:
    """An open element with its ancestors, shared by all blocks below it.

    ``fresh`` holds the features that no ancestor has, so the features of a path are those of its chain of nodes.
    """

    __slots__ = ("parent", "tag", "words", "fresh", "depth", "number", "inside", "outside", "cut")

    def __init__(self, parent: Node | None, tag: str, words: tuple[str, ...], fresh: tuple[str, ...], number: int):
        self.parent, self.tag, self.words, self.fresh, self.number = parent, tag, words, fresh, number
        self.depth = parent.depth + 1 if parent else 0
        own = tag in OUTSIDE or not OUTSIDE_WORDS.isdisjoint(words)
        self.outside = own or bool(parent and parent.outside)  # any element of the path is no main text
        if tag in ("article", "main"):
            self.inside, self.cut = True, bool(parent and parent.outside)
        else:
            self.inside = bool(parent and parent.inside)
            self.cut = self.inside and (own or parent.cut)

    @property
    def own(self) -> list[str]:
        return [f"ownname={w}" for w in self.words]


Block = tuple[str, Node, int]  # text, innermost element that is a block or has names, characters in links


def unescaped(text: str) -> str:
    return references.unescape(TOO_LONG.sub("\ufffd", text) if "&#" in text else text)


def blocks(page: str) -> list[Block]:
    """Leaf blocks of a page in page order, in time that grows with the page's length."""
    out: list[Block] = []
    stack: list[tuple[str, Node, tuple[str, ...]]] = []  # tag, node, features counted in ``seen``
    places: dict[str, list[int]] = {}  # tag -> its places on the stack
    seen: dict[str, int] = {}  # feature -> open elements that have it
    held: list[str] = []
    root = Node(None, "-", (), (), 0)
    numbers, links, in_link, hidden = 0, 0, 0, 0

    def flush():
        nonlocal links
        text = " ".join("".join(held).split())
        if text:
            out.append((text, stack[-1][1] if stack else root, min(len(text), links)))
        held.clear()
        links = 0

    def close(k: int):
        nonlocal in_link, hidden
        while len(stack) > k:
            tag, _, counted = stack[-1]
            if tag in BLOCK:
                flush()  # the text belongs to the element that ends here
            stack.pop()
            places[tag].pop()
            for f in counted:
                seen[f] -= 1
            in_link -= tag == "a"
            hidden -= tag in HIDDEN

    def nearest(tags) -> int:
        return max((places[t][-1] for t in tags if places.get(t)), default=-1)

    at, shut = 0, page.rfind(">") + 1  # no markup ends later, but for an open comment
    while at < len(page):
        m = MARKUP.search(page, at, shut) if at < shut else None
        end = m.start() if m else page.find("<!--", at)
        end = len(page) if end < 0 else end
        if end > at and not hidden:
            piece = unescaped(page[at:end])
            held.append(piece)
            if in_link:
                links += len(piece.strip())
        if not m:
            break
        at = m.end()
        tag = (m.group(2) or m.group(5) or "").lower()
        if not tag:
            if page.startswith("<!--", m.start()) and not page.endswith("-->", 0, at):
                break  # a comment without an end
            continue
        closing, attributes = m.group(1) or m.group(4), m.group(3) or m.group(6) or ""
        if closing:
            if tag == "p" and not places.get("p"):
                flush()
            k = nearest((tag,))
            if k >= 0 and (tag in BLOCK or k > nearest(INLINE_BOUND)):
                close(k)
            continue
        if tag == "br":
            if not hidden:
                held.append(" ")
            continue
        if tag in RAW:
            found = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = found.end() if found else len(page)
            continue
        if tag in BLOCK:
            flush()
            closes, bounds = IMPLIED.get(tag, ({"p"}, INLINE_BOUND))
            k = nearest(closes)
            if k >= 0 and k > nearest(bounds):
                close(k)
        if tag == "body" and hidden:  # an unclosed head ends here
            close(0)
        if tag not in VOID and not attributes.rstrip().endswith("/"):
            words = tuple(w for n in NAMES.findall(attributes) for w in NAME_WORD.findall("".join(n).lower())) if attributes else ()
            node, counted = stack[-1][1] if stack else root, ()
            if tag in BLOCK or words:
                counted = tuple(dict.fromkeys((f"in={tag}", *(f"name={w}" for w in words))))
                numbers += 1
                node = Node(node, tag, words, tuple(f for f in counted if not seen.get(f)), numbers)
                for f in counted:
                    seen[f] = seen.get(f, 0) + 1
            places.setdefault(tag, []).append(len(stack))
            stack.append((tag, node, counted))
            in_link += tag == "a"
            hidden += tag in HIDDEN
    flush()
    return out


def features(page: list[Block]) -> list[list[str | Node]]:
    """Features of each block: names, and its node for those of its path."""
    out, n = [], len(page)
    for i, (text, node, links) in enumerate(page):
        size, words = len(text), text.count(" ") + 1
        f = ["bias", f"own={node.tag}", f"len={min(8, int(math.log2(size + 1)))}", f"words={min(6, int(math.log2(words)))}",
             f"links={int(4 * links / size)}", f"at={4 * i // n}", f"depth={min(6, node.depth)}", node]
        if node.depth > 1:
            f.append(f"pair={node.parent.tag}>{node.tag}")
        if text[-1] in ".!?…\"”":
            f.append("sentence")
        if "©" in text:
            f.append("copyright")
        if i == 0:
            f.append("first")
        if i == n - 1:
            f.append("last")
        out.append(f)
    return out


class Field:
    """Weights of a two-label linear-chain field (0 rest, 1 text)."""

    def __init__(self):
        self.weights: dict[str, float] = {}  # for label 1 against label 0
        self.moves = [[0.0, 0.0], [0.0, 0.0]]

    def unary(self, page: list[list[str | Node]]) -> list[float]:
        """Score of label 1 per block; each node's part is worked out once."""
        get, chain, whole = self.weights.get, {}, {}

        def part(node: Node) -> float:
            if node not in whole:
                open_, up = [], node
                while up is not None and up not in chain:
                    open_.append(up)
                    up = up.parent
                total = chain[up] if up is not None else 0.0
                for x in reversed(open_):
                    total = chain[x] = total + sum(get(f, 0.0) for f in x.fresh)
                whole[node] = total + sum(get(f, 0.0) for f in node.own)
            return whole[node]

        return [sum(part(f) if isinstance(f, Node) else get(f, 0.0) for f in fs) for fs in page]

    @staticmethod
    def summed(page: list[list[str | Node]], at: list[float]) -> dict[str, float]:
        """Per feature the sum of the blocks' values, those of nodes passed up their chains."""
        total: dict[str, float] = {}
        nodes: dict[Node, float] = {}
        for fs, g in zip(page, at):
            for f in fs:
                where = nodes if isinstance(f, Node) else total
                where[f] = where.get(f, 0.0) + g
        for node, g in nodes.items():
            for f in node.own:
                total[f] = total.get(f, 0.0) + g
        for node in list(nodes):
            up = node.parent
            while up is not None and up not in nodes:
                nodes[up] = 0.0
                up = up.parent
        for node in sorted(nodes, key=lambda x: -x.number):  # an element is numbered after its parent
            g = nodes[node]
            for f in node.fresh:
                total[f] = total.get(f, 0.0) + g
            if node.parent is not None:
                nodes[node.parent] += g
        return total

    def decode(self, page: list[list[str]]) -> list[int]:
        """Most probable labels (Viterbi)."""
        u = self.unary(page)
        if not u:
            return []
        best, back, t = [0.0, u[0]], [], self.moves
        for s in u[1:]:
            step = [int(best[1] + t[1][b] > best[0] + t[0][b]) for b in (0, 1)]
            back.append(step)
            best = [best[step[0]] + t[step[0]][0], best[step[1]] + t[step[1]][1] + s]
        label = [0 if best[0] > best[1] else 1]
        for step in reversed(back):
            label.append(step[label[-1]])
        return label[::-1]

    def gradient(self, page: list[list[str]], labels: list[int]):
        """Observed minus expected label-1 counts per block, and per move, by forward-backward."""
        u, t, n = self.unary(page), self.moves, len(page)

        def plus(a, b):
            m = max(a, b)
            return m + math.log(math.exp(a - m) + math.exp(b - m))

        fw = [(0.0, u[0])]
        for s in u[1:]:
            a, b = fw[-1]
            fw.append((plus(a + t[0][0], b + t[1][0]), plus(a + t[0][1], b + t[1][1]) + s))
        bw = [(0.0, 0.0)]
        for s in reversed(u[1:]):
            a, b = bw[-1]
            bw.append((plus(t[0][0] + a, t[0][1] + s + b), plus(t[1][0] + a, t[1][1] + s + b)))
        bw.reverse()
        z = plus(*fw[-1])
        at = [labels[i] - math.exp(fw[i][1] + bw[i][1] - z) for i in range(n)]
        moves = [[0.0, 0.0], [0.0, 0.0]]
        for i in range(1, n):
            moves[labels[i - 1]][labels[i]] += 1
            for a in (0, 1):
                for b in (0, 1):
                    moves[a][b] -= math.exp(fw[i - 1][a] + t[a][b] + (u[i] if b else 0.0) + bw[i][b] - z)
        return at, moves

    def train(self, pages: list[tuple[list[list[str]], list[int]]], epochs: int = EPOCHS, rate: float = 0.3, decay: float = 1e-4, seed: int = 3) -> Field:
        """Adaptive stochastic gradients over the pages."""
        rng, seen, move_seen = random.Random(seed), {}, [[1e-8, 1e-8], [1e-8, 1e-8]]
        pages = [p for p in pages if p[0]]
        for _ in range(epochs):
            rng.shuffle(pages)
            for page, labels in pages:
                at, moves = self.gradient(page, labels)
                for f, g in self.summed(page, at).items():
                    g -= decay * self.weights.get(f, 0.0)
                    seen[f] = seen.get(f, 1e-8) + g * g
                    self.weights[f] = self.weights.get(f, 0.0) + rate * g / math.sqrt(seen[f])
                for a in (0, 1):
                    for b in (0, 1):
                        g = moves[a][b] - decay * self.moves[a][b]
                        move_seen[a][b] += g * g
                        self.moves[a][b] += rate * g / math.sqrt(move_seen[a][b])
        return self


def own_labels(page: list[Block]) -> list[int] | None:
    """Labels from a page's own ``article`` or ``main``; None without one."""
    if not any(node.inside for _, node, _ in page):
        return None
    return [int(node.inside and not node.cut) for _, node, _ in page]


#: Containers of main text, and containers and texts around it, in common page templates.
TEXT_CONTAINERS = ('<article>', '<main>', '<div class="content">', '<div class="post-body">', '<div id="main-content">', '<section class="article-text">',
                   '<div class="entry-content">', '<main><article>', '<div class="story">', '<article class="post">')
REST_CONTAINERS = ('<nav>', '<aside>', '<aside class="sidebar">', '<div class="sidebar">', '<div class="ad">', '<div class="advert">', '<div class="ads banner">',
                   '<div class="cookie-notice">', '<div class="notice">', '<div class="notice" role="alert">', '<section class="comments">', '<div id="comments">',
                   '<div class="comment">', '<ul class="comment-list">', '<form>', '<form class="newsletter">', '<header>', '<div class="header">', '<footer>',
                   '<div class="footer">', '<div class="related">', '<div class="share">', '<ul class="menu">', '<div class="breadcrumbs">', '<div class="promo">')
AROUND = ("Home", "About us", "Contact", "Log in", "Subscribe", "Next", "Share this", "Related posts", "Accept all cookies", "Search", "Terms of use", "Read more",
          "Leave a comment", "Sign up for our newsletter", "Advertisement")


def closed(opening: str) -> str:
    return "".join(f"</{t}>" for t in reversed(re.findall(r"<(\w+)", opening)))


def made_page(texts: list[str], rng: random.Random) -> tuple[list[Block], list[int]]:
    """A page in a made-up template: ``texts`` in a text container, others around and sometimes inside it."""
    esc = references.escape

    def rest(opening: str) -> str:
        items = []
        for _ in range(rng.randint(1, 4)):
            text = rng.choice(AROUND) if rng.random() < 0.4 or not texts else " ".join(rng.choice(texts).split()[: rng.choice((3, 8, 20, 60))]) or "-"
            kind = "li" if opening.startswith(("<nav", "<ul")) or rng.random() < 0.2 else "label" if opening.startswith("<form") else rng.choice(("p", "p", "div", "a", "span"))
            mark = f"\x01{esc(text)}"
            items.append(f'<li><a href="#">{mark}</a></li>' if kind == "li" else f'<a href="#">{mark}</a><br>' if kind == "a" else f"<{kind}>{mark}</{kind}>")
        return opening + "".join(items) + closed(opening)

    shell = lambda n: "".join(rest(rng.choice(REST_CONTAINERS)) for _ in range(n))
    opening = rng.choice(TEXT_CONTAINERS)
    body = []
    for i, t in enumerate(texts):
        tag = rng.choice(("h1", "h2")) if i == 0 and rng.random() < 0.8 else rng.choice(("p",) * 8 + ("li", "blockquote", "h2", "div", "pre"))
        body.append(f"<{tag}>{esc(t)}</{tag}>")
        if rng.random() < 0.25:  # lists and tables of short texts are text too
            some = [esc(" ".join(rng.choice(texts).split()[: rng.choice((1, 2, 5, 12))])) for _ in range(rng.randint(2, 5))]
            body.append(rng.choice((
                "<ul>" + "".join(f"<li>{x}</li>" for x in some) + "</ul>", "<ol>" + "".join(f"<li><p>{x}</p></li>" for x in some) + "</ol>",
                "<table><tr>" + "".join(f"<td>{x}</td>" for x in some) + "</tr></table>", "<blockquote>" + "".join(f"<p>{x}</p>" for x in some) + "</blockquote>",
                "<dl>" + "".join(f"<dt>{x}</dt><dd>{x}</dd>" for x in some) + "</dl>", f'<figure><figcaption>{some[0]}</figcaption></figure><p><a href="#">{some[1]}</a></p>')))
        if rng.random() < 0.12:
            body.append(rest(rng.choice(REST_CONTAINERS)))
    page = f"<html><head><title>x</title></head><body>{shell(rng.randint(1, 3))}{opening}{''.join(body)}{closed(opening)}{shell(rng.randint(1, 4))}</body></html>"
    cut_marks, labels = [], []
    for text, path, links in blocks(page):
        labels.append(int("\x01" not in text))
        text = " ".join(text.replace("\x01", " ").split())
        if text:
            cut_marks.append((text, path, links))
        else:
            labels.pop()
    return cut_marks, labels


def fitted(pages: list[str], seed: int = 5) -> Field:
    """The field trained on sample pages and their texts in made-up templates."""
    rng, labelled = random.Random(seed), []
    for page in pages:
        parts = blocks(page)
        labels = own_labels(parts)
        if labels is None:
            continue
        labelled.append((features(parts), labels))
        texts = [b[0] for b, y in zip(parts, labels) if y]
        made, y = made_page(texts, rng)
        labelled.append((features(made), y))
    if not labelled:  # no labelled page at all: made-up texts alone
        for i in range(60):
            made, y = made_page([" ".join(rng.choice(("word", "some", "text", "here,", "end.")) for _ in range(rng.randint(4, 60))) for _ in range(6)], rng)
            labelled.append((features(made), y))
    return Field().train(labelled)


def main_text(page: str, field: Field) -> str:
    parts = blocks(page)
    return "\n".join(b[0] for b, y in zip(parts, field.decode(features(parts))) if y)


def sampled(rows: DataFrame, sample: int) -> list[str]:
    """The ``sample`` different pages with the least hashed ids. Keys are picked first, so only those pages reach the driver."""
    keyed = rows.where("html <> ''").select(F.xxhash64("page_id").alias("k"), F.xxhash64("html").alias("h"), "html")
    keys = keyed.select("k", "h").distinct().orderBy("k", "h").limit(sample)
    picked = keyed.join(F.broadcast(keys), ["k", "h"]).groupBy("k", "h").agg(F.min("html").alias("html"))
    return [r["html"] for r in sorted(picked.collect(), key=lambda r: (r["k"], r["h"]))]


def extract(pages: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages`` (page_id, url, html)."""
    ship(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    field = fitted(sampled(rows, sample))

    def run(batches):
        for b in batches:
            if b.num_rows:
                texts = [main_text(h, field) if h else "" for h in b.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1).cast(pa.string()), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                                                 ["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(run, SCHEMA)
