"""Fill-in-middle transformation, cut by arithmetic on 64-bit words of UTF-8.

A text's units are its runs of ASCII letters and its other single code points.
Its bytes are viewed as little-endian uint64 words, and a few additions and
masks mark every byte that ends a unit, eight bytes at a time (SWAR): a byte
ends a unit unless the next byte continues its code point or both are letters.
``bitwise_count`` gives the units of each word, a search in their running sum
finds the word that holds a cut, and a multiplication with 0x0101... ranks the
marks within that word.

Each document's cuts and form come from a hash of its id alone, so a retry or
another partitioning gives the same output. The work is map-only.

Defined results: null text is empty, and empty text stays plain. A text that
holds a sentinel stays plain. A null ``doc_id`` is hashed as no digits.
Repeated rows are transformed each. Other columns are ignored. An empty table
gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopflow.llm.common import map_text, ship

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Shares in percent of the documents left plain, and of suffix-first forms among the others.
PLAIN_SHARE, SUFFIX_FIRST_SHARE = 10, 20
SEED = "1"
OUTPUT = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"

U64, ALL = np.uint64, 0xFFFFFFFFFFFFFFFF
ONES, HIGH = 0x0101010101010101, 0x8080808080808080


def unit_ends(data: bytes) -> np.ndarray:
    """Words with the high bit of each byte that ends a unit of ``data``."""
    n = len(data)
    words = np.zeros(n // 8 + 2, "<u8")
    words.view(np.uint8)[:n] = np.frombuffer(data, np.uint8)
    high = U64(HIGH)
    low = (words | U64(0x20 * ONES)) & U64(0x7F * ONES)  # letters in lower case, without the high bits
    letter = (low + U64(0x1F * ONES)) & ~(low + U64(0x05 * ONES)) & ~words & high  # 'a' or more, not above 'z', ASCII
    inner = words & ~(words << U64(1)) & high  # 10xxxxxx

    def following(marks: np.ndarray) -> np.ndarray:
        return (marks[:-1] >> U64(8)) | (marks[1:] << U64(56))

    ends = high & ~following(inner) & ~(letter[:-1] & following(letter))
    ends[-1] &= U64((1 << 8 * (n % 8)) - 1)  # bytes behind the text
    return ends


def select(ends: np.ndarray, upto: np.ndarray, k: int) -> int:
    """Bytes of the first ``k`` units; ``upto`` is the running sum of the words' units."""
    if k == 0:
        return 0
    w = int(np.searchsorted(upto, k))
    k -= int(upto[w - 1]) if w else 0
    counts = ((int(ends[w]) >> 7) * ONES) & ALL  # marks up to each byte of the word
    reached = ((counts | HIGH) - k * ONES) & HIGH
    return 8 * w + 8 - reached.bit_count() + 1


def draws(doc_id: int | None, seed: str = SEED) -> tuple[int, ...]:
    """Four 32-bit numbers of a document."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(digest[i : i + 8], 16) for i in range(0, 32, 8))


def cut_text(text: str, h: tuple[int, ...], plain_share: int = PLAIN_SHARE, suffix_first_share: int = SUFFIX_FIRST_SHARE):
    """(n, form, prefix_chars, middle_chars, output) of one text."""
    data = text.encode()
    ends = unit_ends(data)
    upto = np.cumsum(np.bitwise_count(ends), dtype=np.int64)
    n = int(upto[-1])
    if not text or h[2] % 100 >= 100 - plain_share or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    i, j = (select(ends, upto, k) for k in sorted((h[0] % (n + 1), h[1] % (n + 1))))
    prefix, middle, suffix = data[:i].decode(), data[i:j].decode(), data[j:].decode()
    if h[3] % 100 < suffix_first_share:
        form, output = "spm", SUFFIX + suffix + PREFIX + prefix + MIDDLE + middle
    else:
        form, output = "psm", PREFIX + prefix + SUFFIX + suffix + MIDDLE + middle
    return n, form, len(prefix), len(middle), output


def transform(docs: DataFrame, *, seed: str = SEED, plain_share: int = PLAIN_SHARE,
              suffix_first_share: int = SUFFIX_FIRST_SHARE) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every row of ``docs`` (doc_id, text)."""
    ship(docs.sparkSession)

    def run(keys, texts):
        ids = keys.to_pylist()
        with np.errstate(over="ignore"):
            rows = [cut_text(t, draws(i, seed), plain_share, suffix_first_share) for i, t in zip(ids, texts)]
        names = ("n", "form", "prefix_chars", "middle_chars", "output")
        return {"doc_id": keys, **{name: [r[k] for r in rows] for k, name in enumerate(names)}}

    return map_text(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, OUTPUT)


def restored(form: Column, output: Column) -> Column:
    """The text, from an output and its form alone.

    The parts hold no sentinel, and none can arise over their edges: every
    sentinel begins with its only ``<`` and ends with its only ``>``.
    """
    body, last = F.substring(output, 4, 2**31 - 1), F.substring_index(output, MIDDLE, -1)

    def between(a: str, b: str) -> Column:
        return F.substring_index(F.substring_index(output, a, -1), b, 1)

    psm = F.concat(F.substring_index(body, SUFFIX, 1), last, between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), last, F.substring_index(body, PREFIX, 1))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def digests(outputs: DataFrame) -> DataFrame:
    """The rows of ``transform`` with checksums of the output and of the text rebuilt from it."""
    return outputs.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                          F.sha2(restored(F.col("form"), F.col("output")), 256).alias("restored_sha256"))


SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (
  SELECT doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS units, CAST('0x' || h[1:8] AS BIGINT) AS h1,
         CAST('0x' || h[9:16] AS BIGINT) AS h2, CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM d),
c AS (
  SELECT *, len(units) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS i, greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS j,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (
  SELECT doc_id, text, n, form, array_to_string(units[1:i], '') AS pre, array_to_string(units[i + 1:j], '') AS mid,
         array_to_string(units[j + 1:], '') AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        WHEN 'spm' THEN '<S>' || suf || '<P>' || pre || '<M>' || mid ELSE text END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""
