"""Byte-pair encoding by longest matches and a pair-compatibility table; decoding by an offset table.

A token sequence is what the merges produce if and only if every two neighbours are compatible: merging
their joined bytes from scratch gives those two tokens again. So one pass of an Aho-Corasick automaton
gives the longest token at every position of a pre-token, and encoding walks from one to the next, checks
the pair, takes the next shorter token where the pair is not compatible, and steps back where none is left.
A position once given up is never tried again, which keeps the walk linear. Compatibility is read off the
merges that formed the two tokens along their common border and kept in a table.

Each task keeps the encodings of the pre-tokens it has met, up to ``KEPT`` of them, then starts afresh.
The vocabulary (a few MB) is read on the driver and broadcast.

Defined cases: a null text is the empty text and has no tokens; special tokens named in the vocabulary are
found in texts as they stand; repeated rows are encoded alike; other columns are kept, except that columns
named like an output are replaced.
"""

from __future__ import annotations

import json
import re
import struct
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from geoloom.llm import common

KEPT = 400_000
PIECE_BYTES = 2 << 20

#: The pattern that splits text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: The same for texts in which the standard classes mean the same, which `re` runs three times as fast.
PLAIN_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"""


def _ranges(points: list[int]) -> str:
    out, first = [], None
    for i, p in enumerate(points):
        first = p if first is None else first
        if i + 1 == len(points) or points[i + 1] != p + 1:
            out.append(f"{re.escape(chr(first))}-{re.escape(chr(p))}")
            first = None
    return "".join(out)


@lru_cache(None)
def splitter():
    """A function from text to its pre-tokens."""
    unlike = [
        p
        for p in range(sys.maxunicode + 1)
        if (c := chr(p)).isalnum() and unicodedata.category(c) in ("No", "Nl", "So", "Mn", "Mc", "Cn") or 0x1C <= p <= 0x1F
    ]
    special = re.compile(f"[{_ranges(unlike)}]").search
    plain, exact = re.compile(PLAIN_PATTERN).findall, regex.compile(PATTERN).findall
    return lambda text: exact(text) if special(text) else plain(text)


@lru_cache(None)
def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in vocabulary files: printable Latin-1 stands for itself."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Tokens, merges and the tables derived from them."""

    def __init__(self, content: str):
        given = json.loads(content)
        letters = byte_letters()
        ids: dict[str, int] = given["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in given.get("added_tokens", [])}
        size = 1 + max([*ids.values(), *self.special.values()])
        self.token: list[bytes] = [b""] * size
        for text, i in ids.items():
            self.token[i] = bytes(letters[c] for c in text)
        for text, i in self.special.items():
            self.token[i] = text.encode()
        self.merged: dict[tuple[int, int], int] = {}  # by the pair: when it is merged
        self.parts: dict[int, tuple[int, int]] = {}
        self.made = [0] * size  # when a token is made; single bytes are there from the start
        for k, pair in enumerate(given["model"]["merges"], 1):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            a, b, c = ids[left], ids[right], ids[left + right]
            self.merged[a, b] = k
            if c not in self.parts:
                self.parts[c], self.made[c] = (a, b), k
        automaton = ahocorasick.Automaton()
        for i in ids.values():
            automaton.add_word(self.token[i].decode("latin-1"), (len(self.token[i]), i))
        automaton.make_automaton()
        self.matches, self.greedy = automaton.iter, automaton.iter_long
        known = {self.token[i]: i for i in ids.values()}
        self.shorter = [-1] * size  # longest token that is a proper prefix
        for i in ids.values():
            t = self.token[i]
            self.shorter[i] = next((known[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in known), -1)
        self.length = [len(t) for t in self.token]
        self.pairs: dict[tuple[int, int], bool] = {}
        self.offsets = np.zeros(size + 1, np.int64)
        np.cumsum(self.length, out=self.offsets[1:])
        self.bytes = np.frombuffer(b"".join(self.token), np.uint8)

    def compatible(self, left: int, right: int) -> bool:
        """Whether the merges leave the border between the two tokens as it is."""
        key = left, right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= KEPT:
                self.pairs.clear()
            known = self.pairs[key] = self._border_holds(left, right)
        return known

    def _border_holds(self, left: int, right: int) -> bool:
        never = len(self.merged) + 1
        ends, begins = [(left, never)], [(right, never)]  # pieces at the border, and when each is used up
        while ends[-1][0] in self.parts:
            t = ends[-1][0]
            ends.append((self.parts[t][1], self.made[t]))
        while begins[-1][0] in self.parts:
            t = begins[-1][0]
            begins.append((self.parts[t][0], self.made[t]))
        i, j = len(ends) - 1, len(begins) - 1
        while True:
            (a, a_until), (b, b_until) = ends[i], begins[j]
            when = self.merged.get((a, b), never)
            # Of merges with one rank the leftmost is first: inside the left token before the border.
            if when < a_until and when <= b_until and when < never:
                return False
            if i == 0 and j == 0:
                return True
            if j == 0 or i > 0 and a_until <= b_until:
                i -= 1
            else:
                j -= 1

    def encode(self, piece: bytes) -> list[int]:
        """Ids of one pre-token."""
        letters = piece.decode("latin-1")
        walk = [match[1][1] for match in self.greedy(letters)]
        known = self.pairs
        for pair in zip(walk, walk[1:]):
            held = known.get(pair)
            if not (self.compatible(*pair) if held is None else held):
                break
        else:  # the longest tokens one after another are compatible already
            return walk
        n = len(piece)
        longest = [0] * n
        for end, (size, i) in self.matches(letters):
            longest[end - size + 1] = i
        open_ = bytearray(b"\x01") * (n + 1)
        length, shorter, compatible = self.length, self.shorter, self.compatible
        out: list[int] = []
        at, token = 0, longest[0] if n else 0
        while at < n:
            end = at + length[token]
            fits = open_[end]
            if fits and out:
                fits = known.get((out[-1], token))
                if fits is None:
                    fits = compatible(out[-1], token)
            if fits:
                out.append(token)
                at = end
                token = longest[at] if at < n else 0
            elif shorter[token] >= 0:
                token = shorter[token]
            else:
                open_[at] = 0
                token = out.pop()
                at -= length[token]
                # The token was tried here already; go on with the next shorter one.
                while shorter[token] < 0 and out:
                    open_[at] = 0
                    token = out.pop()
                    at -= length[token]
                token = shorter[token]
        return out

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """Texts of consecutive runs of ids, copied out of the token bytes by offset."""
        sizes = self.offsets[ids + 1] - self.offsets[ids]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        source = np.repeat(self.offsets[ids] - (ends - sizes), sizes) + np.arange(total)
        data = self.bytes[source].tobytes()
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        return [data[a:b].decode("utf-8", "replace") for a, b in zip(bounds[:-1], bounds[1:])]


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Encodings(dict):
    """Ids of pre-tokens as little-endian 32-bit integers, made when first asked for."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= KEPT:
            self.clear()
        ids = _packed(self.vocabulary.encode(piece.encode()))
        if len(piece) <= 64:
            self[piece] = ids
        return ids


_loaded: dict[str, tuple[Vocabulary, Encodings]] = {}


def loaded(content: str) -> tuple[Vocabulary, Encodings]:
    """Tables of a vocabulary, built once in a Python worker."""
    key = f"{len(content)}:{hash(content)}"
    if key not in _loaded:
        _loaded.clear()
        vocabulary = Vocabulary(content)
        _loaded[key] = vocabulary, Encodings(vocabulary)
    return _loaded[key]


def token_bytes(texts: list[str], vocabulary: Vocabulary, encodings: Encodings) -> list[bytes]:
    split, known = splitter(), encodings.__getitem__
    marks = sorted(vocabulary.special, key=len, reverse=True)
    cut = re.compile("(" + "|".join(map(re.escape, marks)) + ")").split if marks else None
    out = []
    for text in texts:
        if cut and any(m in text for m in marks):
            pieces = cut(text)
            out.append(
                b"".join(
                    _packed([vocabulary.special[p]]) if k % 2 else b"".join(map(known, split(p)))
                    for k, p in enumerate(pieces)
                )
            )
        else:
            out.append(b"".join(map(known, split(text))))
    return out


def read(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()


def _columns(df: DataFrame, outputs: list[str]) -> list[str]:
    return [c for c in df.columns if c not in outputs]


def _schema(df: DataFrame, kept: list[str], outputs: str) -> str:
    named = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name in kept]
    return ", ".join([*named, outputs])


def encode(documents: DataFrame, vocabulary: str, text: str = "text", decoded: bool = False) -> DataFrame:
    """The other columns with ``tokens`` (ids, little-endian 32-bit); with ``decoded`` also the text they give.

    ``vocabulary`` is the path of a byte-level vocabulary file, readable by the driver.
    """
    content = documents.sparkSession.sparkContext.broadcast(read(vocabulary))
    outputs = ["tokens", "decoded"][: 1 + decoded]
    kept = [c for c in _columns(documents, outputs) if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, encodings = loaded(content.value)
        for batch in common.slices(batches, text, PIECE_BYTES):
            tokens = token_bytes([t or "" for t in batch.column(text).to_pylist()], tables, encodings)
            made = [pa.array(tokens, pa.binary())]
            if decoded:
                ids = np.frombuffer(b"".join(tokens), "<u4").astype(np.int64)
                made.append(pa.array(tables.decode(ids, np.array([len(t) // 4 for t in tokens], np.int64))))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *made], names=[*kept, *outputs])

    types = ", ".join(["tokens binary", "decoded string"][: 1 + decoded])
    source = documents.select(*kept, text)
    return source.mapInArrow(run, _schema(documents, kept, types))


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """The other columns with ``decoded``, the text of ``tokens`` (null: empty)."""
    content = encoded.sparkSession.sparkContext.broadcast(read(vocabulary))
    kept = [c for c in _columns(encoded, ["decoded"]) if c != "tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, _ = loaded(content.value)
        for batch in batches:
            tokens = [t or b"" for t in batch.column("tokens").to_pylist()]
            ids = np.frombuffer(b"".join(tokens), "<u4").astype(np.int64)
            texts = tables.decode(ids, np.array([len(t) // 4 for t in tokens], np.int64))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(texts, pa.string())], names=[*kept, "decoded"])

    return encoded.select(*kept, "tokens").mapInArrow(run, _schema(encoded, kept, "decoded string"))
