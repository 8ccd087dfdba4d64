"""Token ids of whole texts with a public byte-level BPE tokenizer.

The tokenizers library merges each distinct word once; texts are then put
together from the cached words: a batch of texts is split and coded by its distinct
space-separated units, each of which is looked up once, and the ids of all its texts are gathered
by one index. A space that is followed by a character
other than white space always starts a new word of the byte-level pattern,
so a text can be split there without changing its ids. Texts that contain the
string of an added token are encoded whole. Both caches have a
fixed number of entries, so a worker's memory is bounded at every size.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

END_ID = 2
VOCABULARY = "byte_bpe_50k.json"
#: Entries of the caches of words and of space-separated units.
WORD_CACHE, UNIT_CACHE = 600_000, 400_000
#: Marks that often end a unit; alone they are one word of the pattern.
MARKS = frozenset(".,;:!?")
#: A space inside or at the end of white space: no split there.
INNER_SPACE = re.compile(r" (?:\s|\Z)")


class _Cache(dict):
    def __init__(self, make, most):
        self.make, self.most = make, most

    def __missing__(self, key):
        value = self.make(key)
        if len(self) < self.most:
            self[key] = value
        return value


def byte_letters() -> dict[int, str]:
    """The printable stand-ins of bytes in byte-level BPE: printable bytes stay, the rest follow from 256 on."""
    keep = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in set(keep)]
    return {**{b: chr(b) for b in keep}, **{b: chr(256 + i) for i, b in enumerate(rest)}}


class Encoder:
    """Ids of a text as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        import public_tokenizers
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # the cached words know no added tokens; see encode_whole
        self.whole = Tokenizer.from_file(path)
        added = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.added_strings = [t for t in added if t]
        self.added = re.compile("|".join(map(re.escape, added))).search if added else lambda text: None
        self.model = self.tokenizer.model
        self.id_bytes = [i.to_bytes(4, "little") for i in range(self.whole.get_vocab_size(with_added_tokens=True) + 1)]
        self.letters = byte_letters()
        self.split = regex.compile(public_tokenizers.PATTERN).findall
        self.words = _Cache(self._word, WORD_CACHE)
        self.units = _Cache(lambda u: self._unit(" " + u), UNIT_CACHE)

    def _word(self, w: str) -> bytes:
        if w.isascii() and w[1:].isalpha():  # only a leading space is spelled otherwise
            spelled = self.letters[32] + w[1:] if w[0] == " " else w
        else:
            spelled = w.encode().decode("latin-1").translate(self.letters)
        return b"".join([self.id_bytes[t.id] for t in self.model.tokenize(spelled)])

    def _unit(self, u: str) -> bytes:
        if not u:
            return b""
        if max(u) < "ɐ":
            if u[0] == " ":  # letters, perhaps with one mark behind them: no need to search for the pattern
                if u[1:].isalpha():
                    return self.words[u]
                if u[-1] in MARKS and u[1:-1].isalpha():
                    return self.words[u[:-1]] + self.words[u[-1]]
            return b"".join(map(self.words.__getitem__, self.split(u)))
        return np.array(self.tokenizer.encode(u, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def encode_whole(self, text: str) -> bytes:
        """The library's own ids; a text with an added token's string goes through the untouched tokenizer."""
        if self.added(text):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        return self.encode(text)

    def encode(self, text: str) -> bytes:
        """Ids with the strings of added tokens as ordinary text."""
        parts = text.split(" ")
        if INNER_SPACE.search(text):
            merged = parts[:1]
            for p in parts[1:]:
                if not p or p[0].isspace():
                    merged[-1] += " " + p
                else:
                    merged.append(p)
            parts = merged
        return self._unit(parts[0]) + b"".join(map(self.units.__getitem__, parts[1:]))


    def encode_batch(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (null: empty), each with the end id behind them, in one array, and where each text's ids end."""
        texts = texts.fill_null("")
        parts = pc.split_pattern(texts, " ")
        at = parts.offsets.to_numpy().astype(np.int64)
        coded = parts.values[at[0] : at[-1]].dictionary_encode()
        at, index, names = at - at[0], coded.indices.to_numpy(), coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        inner = np.array([not u or u[0].isspace() for u in names], bool)  # units after an inner space: no split there
        units = [b"" if x else self.units[u] for u, x in zip(names, inner.tolist())]
        first, sizes, n = at[:-1], np.diff(at), len(texts)
        flags = inner[index]
        flags[first] = False
        whole = np.logical_or.reduceat(flags, first)
        for t in self.added_strings:
            whole |= pc.match_substring(texts, t).to_numpy(zero_copy_only=False)
        heads = [self.encode_whole(texts[i].as_py()) if whole[i] else self._unit(names[index[first[i]]]) for i in range(n)]
        # of each text: its head, its other units (none if it was encoded whole), the end id
        nothing, end = len(names), len(names) + 1
        lists = [*units, b"", end_id.to_bytes(4, "little"), *heads]
        chosen = np.empty(len(index) + n, np.int64)
        chosen[np.arange(len(index)) + np.repeat(np.arange(n), sizes)] = np.where(np.repeat(whole, sizes), nothing, index)
        begins = first + np.arange(n)
        chosen[begins] = end + 1 + np.arange(n)
        chosen[at[1:] + np.arange(n)] = end
        ids = np.frombuffer(b"".join(lists), "<u4")
        lengths = np.fromiter(map(len, lists), np.int64, len(lists)) // 4
        starts = np.cumsum(lengths) - lengths
        got = lengths[chosen]
        upto = np.cumsum(got)
        kind = np.int32 if upto[-1] < 2**31 and len(ids) < 2**31 else np.int64
        place = np.arange(upto[-1], dtype=kind)
        place += np.repeat((starts[chosen] - (upto - got)).astype(kind), got)
        return ids[place], upto[at[1:] + np.arange(n)]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker process and vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def batch_ids(texts: pa.Array, path: str, end_id: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
    """Little-endian ids of a batch of texts, each with the end id behind them, and the end of each text's ids."""
    if not len(texts):
        return np.empty(0, "<u4"), np.empty(0, np.int64)
    return encoder(path).encode_batch(texts, end_id)


def document_ids(texts: list[str], path: str, end_id: int = END_ID) -> list[bytes]:
    """Ids of each text with the end id behind them, as bytes."""
    ids, ends = batch_ids(pa.array(texts, pa.string()), path, end_id)
    return [ids[a:z].tobytes() for a, z in zip([0, *ends.tolist()], ends.tolist())]
