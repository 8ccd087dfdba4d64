"""Secret scans by assignment-aware lexing.

Every whole text is scanned in three base patterns (assignments to sensitive
names, access keys, long hexadecimal runs). On top of them the text is lexed
into name-literal pairs: a target (name, quoted key, or subscripts, perhaps with a
type annotation), the last assignment operator, and what it assigns: a quoted literal
(also over line ends, in parts that are joined, or indented as a block), quoted arguments of
a call, or a bare value; pairs inside bare values, such as url parameters, count too. A
``value`` key inside a named object, or beside a ``key``, ``name`` or ``id`` that holds a name (objects, tag
attributes), has that name. A bare value that names a constant, defined before or after, takes
that constant's literal (transitively), and each literal is
scored by how sensitive its target name is and how random the literal looks; under names such as
``passphrase``, four or more plain words count as well. References such as ``${NAME}``, ``$NAME`` or ``<name>`` are no literals.
Literals at or above the threshold that no base finding covers are added. No length is
bounded: a literal ends where its syntax ends. A single-quoted or double-quoted one that runs over line ends must be
followed by a line's end or a closing mark; a literal without end is none. Pairs inside a found literal are part of it.

Defined results: a null or empty text has no findings. Repeated rows are
scanned each. Other columns are ignored by :func:`scan` and kept by
:func:`redact`. Positions are code points, ends exclusive. An empty table
gives an empty result. All work is map-only: no shuffle, so no hot key.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections import Counter
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopflow.llm.common import map_text, ship

KINDS = ("assign", "access", "hex", "literal")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # maximal runs, so the length test can stand in the pattern
#: Target and assignment operator: a name or quoted key, subscripts (the last quoted one names the target), a type annotation.
HEAD = re.compile(
    r"""(?<![\w.$-])([A-Za-z_$][\w.$-]*+)["']?(?:[ \t]*\[[ \t]*(?:["']([^"'\n\]]+)["']|[\w.$-]*)[ \t]*\])*+[ \t]*"""
    r"""(?::[ \t]*([A-Za-z_&*][\w.&'*?|,<>\[\] \t]*+)(?==(?![=~>])))?(:=|=>|[?+]?=(?![=~])|:(?!:|//))"""
)
#: What may stand between an operator and a quoted literal (also line ends), a string prefix, and the opening quote.
OPENING = re.compile(r"""((?:[ \t(]|\\?\r?\n)*+)[rbufRBUF@$]{0,2}(\"{3}|'{3}|["'`])""")
QUOTED = {q: re.compile(rf"(?:[^{q}\\\n]|\\.)*+{q}", re.S) for q in "\"'"}
#: What joins the next part to a literal: an operator, or nothing but white space (with line ends only inside brackets or after a backslash).
JOIN = re.compile(r"""[ \t\r\n\\]*+(?:\+|&|\.\.?|\|\|)[ \t\r\n\\(]*+[rbufRBUF@$]{0,2}(["'])""")
NEXT = re.compile(r"""(?:[ \t]|\\\r?\n)*+[rbufRBUF@$]{0,2}(["'])""")
NEXT_INSIDE = re.compile(r"""[ \t\r\n\\]*+[rbufRBUF@$]{0,2}(["'])""")
#: What follows a literal that ran over line ends.
CLOSED = re.compile(r"[ \t]*(?:[;,)\]}>/]|\r?\n|\Z)")
SPACE = re.compile(r"[ \t]*+")
#: Bare values, and those in a url, where a parameter ends at the next one.
BARE = {False: re.compile(r"""[^\s"'`,;(){}\[\]<>]+"""), True: re.compile(r"""[^\s"'`,;(){}\[\]<>&#]+""")}
NAME = re.compile(r"[A-Za-z_$][\w.$-]*+")
ARGUMENT = r""""(?:[^"\\\n]|\\.)*+"|'(?:[^'\\\n]|\\.)*+'"""
CALL = re.compile(rf"\(\s*+(?:(?:{ARGUMENT}|[\w.+-]++)\s*+,?\s*+)*+\)")
ARGUMENTS = re.compile(ARGUMENT)
CONSTANT_NAME = re.compile(r"[A-Z][A-Z0-9_]*")
BLOCK = re.compile(r"[ \t]*[|>][-+0-9]*[ \t]*\r?\n([ \t]+)(\S.*(?:\n(?:\1.*|[ \t\r]*+(?=\n)))*+)")
KEY_AFTER = re.compile(r"[ \t]*(?::|=)")
#: An object or an indented group opens behind an operator; what ends the reach of a name for the ``value`` keys behind it.
OPENED = re.compile(r"\s*+\{|[ \t]*+\r?\n(?=[ \t]+\S)")
ENDED = re.compile(r"[}>]|\n[ \t\r]*+\n")
KEY_NAMES, VALUE_NAMES = {"key", "name", "id"}, {"value", "val", "default", "data", "content", "plaintext"}
NAME_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")
#: Fixed weights of the parts of a sensitive target name.
WEIGHTS = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "mnemonic": 0.8, "pwd": 0.9, "secret": 1.0, "token": 0.9, "apikey": 1.0,
    "credential": 0.9, "credentials": 0.9, "bearer": 0.8, "auth": 0.6, "authorization": 0.7, "private": 0.5,
    "access": 0.4, "api": 0.4, "key": 0.4, "signing": 0.4, "encryption": 0.4, "salt": 0.4, "cookie": 0.4, "session": 0.4,
}
#: Values that stand for "no secret here".
PLACEHOLDERS = {"null", "none", "true", "false", "undefined", "changeme", "example", "placeholder", "redacted", "xxxxxxxx", "your_password", "your-token"}
#: References to values that stand elsewhere, and format fields.
REFERENCE = re.compile(r"\$\{.*\}|\$\(.*\)|\$[A-Za-z_]\w*|\{\{.*\}\}|\{\w*\}|<[^<>]*>|%\(\w+\)s|%\w+%?|<%.*%>", re.S)
PHRASE = re.compile(r"[a-z]{3,}(?:[ -][a-z]{3,}){3,}")
PHRASE_NAMES = ("passphrase", "mnemonic")
THRESHOLD = 0.75
MIN_LITERAL = 6
SCHEMA = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, n_literal bigint, base_sha256 string, spans string"


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base findings, sorted by start then kind."""
    out = []
    if "=" in text or ":" in text:
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def name_score(name: str) -> float:
    """Sensitivity of a target name: the weights of its parts, at most 1."""
    parts = [p.lower() for p in NAME_PART.findall(name)]
    joined = ["".join(parts[i : i + 2]) for i in range(len(parts) - 1)]
    return min(1.0, sum(WEIGHTS.get(p, 0.0) for p in {*parts, *joined}))


def classes_of(value: str) -> int:
    """Character classes of a literal: lower case, upper case, digits, others."""
    return sum(bool(re.search(p, value)) for p in ("[a-z]", "[A-Z]", "[0-9]", r"[^A-Za-z0-9\s]"))


def literal_score(value: str) -> float:
    """Randomness of a literal between 0 and 1: entropy, length and character classes."""
    if len(value) < MIN_LITERAL or value.lower() in PLACEHOLDERS or REFERENCE.fullmatch(value):
        return 0.0
    n = len(value)
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(value).values())
    classes = classes_of(value)
    if " " in value and classes < 3:  # a sentence, not a credential
        return 0.0
    return min(1.0, entropy / 4) * (0.4 + 0.2 * min(3, classes))


def lines_with_pairs(text: str):
    """(start, line) of the lines that hold ``=`` or ``:``; each line is met once."""
    at = 0
    while True:
        hits = [p for p in (text.find("=", at), text.find(":", at)) if p >= 0]
        if not hits:
            return
        p = min(hits)
        start = text.rfind("\n", at, p) + 1 or at
        end = text.find("\n", p)
        end = len(text) if end < 0 else end
        yield start, text[start:end]
        at = end + 1


class Reach:
    """Places in a text that are asked for again and again, each searched once."""

    def __init__(self, text: str):
        self.text = text
        self.marks: dict[str, tuple[int, int]] = {}
        self.runs: dict[bool, tuple[int, int]] = {}

    def find(self, mark: str, at: int) -> int:
        """First place of ``mark`` from ``at`` on, or -1."""
        low, place = self.marks.get(mark, (1, 0))
        if not (low <= at and (place < 0 or at <= place)):
            place = self.text.find(mark, at)
            self.marks[mark] = at, place
        return place

    def bare(self, at: int, in_url: bool) -> tuple[int, int] | None:
        """(start, end) of the bare value at ``at``."""
        start = SPACE.match(self.text, at).end()
        low, end = self.runs.get(in_url, (1, 0))
        if not low <= start < end:
            m = BARE[in_url].match(self.text, start)
            if not m:
                return None
            end = m.end()
            self.runs[in_url] = start, end
        return start, end

    def closing(self, quote: str, start: int, sensitive: bool) -> int:
        """Place of the quote that closes a literal begun at ``start``, or -1."""
        if quote not in QUOTED:
            return self.find(quote, start) if sensitive or len(quote) == 3 else -1
        if m := QUOTED[quote].match(self.text, start):
            return m.end() - 1
        end, line = self.find(quote, start), self.find("\n", start)
        if end < 0 or line < 0 or end < line:
            return end
        return end if sensitive and CLOSED.match(self.text, end + 1) else -1


#: start, end, whether bare, and the joined parts if the literal is not the text between.
Literal = tuple[int, int, bool, str | None]


def literals_at(reach: Reach, at: int, sensitive: bool, in_url: bool) -> list[Literal]:
    """The literals behind an operator that ends at ``at``: one, or a call's quoted arguments."""
    text = reach.text
    if m := OPENING.match(text, at):
        start, quote, over = m.end(), m.group(2), "\n" in m.group(1)
        end = reach.closing(quote, start, sensitive)
        if end < 0 or over and KEY_AFTER.match(text, end + len(quote)):
            return []
        parts, behind = [(start, end)], end + len(quote)
        following = NEXT_INSIDE if "(" in m.group(1) else NEXT
        while j := JOIN.match(text, behind) or following.match(text, behind):
            stop = reach.closing(j.group(1), j.end(), False)
            if stop < 0 or KEY_AFTER.match(text, stop + 1):
                break
            parts.append((j.end(), stop))
            behind = stop + 1
        return [(start, parts[-1][1], False, "".join(text[a:b] for a, b in parts) if len(parts) > 1 else None)]
    if sensitive and (m := BLOCK.match(text, at)):
        start, end = m.span(2)
        return [(start, start + len(m[2].rstrip()), False, None)]
    if run := reach.bare(at, in_url):
        start, end = run
        if text[end : end + 1] == "(" and (n := NAME.match(text, start)) and n.end() == end:
            call = CALL.match(text, end) if sensitive else None
            found = ARGUMENTS.finditer(text, *call.span()) if call else ()
            inner = [(m.start() + 1, m.end() - 1) for m in found]
            return [(a, b, False, None) for a, b in inner if not re.search(r"\s", text[a:b]) and classes_of(text[a:b]) > 2 and not CONSTANT_NAME.fullmatch(text, a, b)]
        return [(start, end, True, None)]
    return []


def literal_spans(text: str, threshold: float = THRESHOLD) -> list[tuple[int, int, float]]:
    """(start, end, score) of literals that reach sensitive names, directly or through constants."""
    reach = Reach(text)
    constants: dict[str, tuple[int, int, str | None]] = {}
    out: dict[tuple[int, int], float] = {}
    chained: list[str] = []  # targets of a = b = literal that still wait for the literal
    hot = False  # whether one of them is sensitive
    waiting: list[tuple[list[str], str, tuple[int, int]]] = []  # names whose constant may come later
    holder: tuple[list[str], int] | None = None  # names for the value keys to come, and how far that is known to hold
    covered = 0

    def add(names: list[str], start: int, end: int, value: str | None) -> bool:
        s = max(map(name_score, names))
        if end <= start or s < threshold:
            return False
        value = text[start:end] if value is None else value
        phrase = any(x in n.lower() for n in names for x in PHRASE_NAMES) and PHRASE.fullmatch(value)
        score = s * (1.0 if phrase else literal_score(value))
        if score >= threshold * 0.6:
            out[start, end] = max(score, out.get((start, end), 0.0))
        return score >= threshold * 0.6

    for at, line in lines_with_pairs(text):
        for m in HEAD.finditer(text, at, at + len(line)):
            if m.start() < covered:
                continue
            names = [m.group(2) or m.group(1)]
            if m.group(3) and not m.group(3)[-1].isspace() and not text[m.end() : m.end() + 1].isspace():  # note: key=value
                names.append(m.group(3))
            key = names[0].lower()
            if holder:
                holder = None if ENDED.search(text, holder[1], max(holder[1], m.start())) else (holder[0], max(holder[1], m.end()))
                if holder and key in VALUE_NAMES:
                    names += holder[0]
            sensitive = hot = hot or max(map(name_score, names)) >= threshold
            found = literals_at(reach, m.end(), sensitive, text[m.start() - 1 : m.start()] in ("?", "&"))
            if found and found[0][2] and (h := HEAD.match(text, found[0][0])) and h.end(1) == found[0][1] and h.group(4) == "=":
                chained += names
                continue
            if not found and sensitive and (o := OPENED.match(text, m.end())):
                holder = names, o.end()
            names, chained, hot = names + chained, [], False
            for start, end, bare, value in found:
                n = NAME.match(text, start)
                word = text[start:end] if n and n.end() == end else ""
                if bare and word in constants:
                    start, end, value = constants[word]
                elif bare and word:
                    waiting.append((names, word, (start, end)))
                if word and key in KEY_NAMES and name_score(word) >= threshold:
                    holder = [word], end + (not bare)
                constants |= dict.fromkeys(names, (start, end, value))
                if sensitive and add(names, start, end, value) and start >= m.end():
                    covered = max(covered, end)
    known: dict[str, tuple[int, int, str | None]] = {}
    for names, word, span in waiting:
        trail, at = [], word
        while at not in known and at in constants and at not in trail[-1:]:
            known[at] = constants[at]  # also ends circles
            trail.append(at)
            a, b, _ = constants[at]
            n = NAME.match(text, a)
            at = text[a:b] if n and n.end() == b else ""
        if trail:  # all that leads to a literal leads to the same
            known.update(dict.fromkeys(trail, known[at if at in known else trail[-1]]))
        if word in known and known[word][:2] != span and add(names, *known[word]):
            out.pop(span, None)
    return [(a, b, s) for (a, b), s in sorted(out.items())]


def find(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(base findings, all findings) as (start, kind, end)."""
    base = base_spans(text)
    if "=" not in text and ":" not in text:
        return base, base
    starts, reached = [s for s, _, _ in base], list(accumulate((e for _, _, e in base), max, initial=-1))
    added = [(a, 3, b) for a, b, _ in literal_spans(text) if reached[bisect_right(starts, a)] < b]
    return base, sorted(base + added)


def joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def _scan(ids, texts):
    found = [find(t) for t in texts]
    count = lambda j: [sum(k == j for _, k, _ in a) for _, a in found]
    return {"doc_id": ids, "n_assign": count(0), "n_access": count(1), "n_hex": count(2), "n_literal": count(3),
            "base_sha256": [hashlib.sha256(joined(b).encode()).hexdigest() for b, _ in found], "spans": [joined(a) for _, a in found]}


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: counts per kind, the digest of the base findings and all spans."""
    ship(docs.sparkSession)
    return map_text(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), _scan, SCHEMA)


def masked(text: str, mask: str = "[SECRET]") -> str:
    """``text`` with the union of its findings replaced by ``mask``."""
    out, at = [], 0
    for s, _, e in find(text)[1]:
        if s >= at:
            out += [text[at:s], mask]
        at = max(at, e)
    return "".join(out) + text[at:] if out else text


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every finding masked in ``text``; ``n_chars`` follows where it exists.

    Null texts stay null; all columns and rows stay.
    """
    ship(docs.sparkSession)
    schema, at = docs.schema, docs.columns.index("text")

    def run(batches):
        import pyarrow as pa

        for b in batches:
            texts = [None if t is None else masked(t) for t in b.column(at).to_pylist()]
            yield b.set_column(at, b.schema.field(at), pa.array(texts, type=b.schema.field(at).type))

    out = docs.mapInArrow(run, schema)
    return out.withColumn("n_chars", F.length("text").cast(schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
