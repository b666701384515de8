"""Document fingerprints by one-permutation MinHash.

Every word shingle of a text is hashed once. The leading bits of a hash choose one of ``BINS`` bins, a bin
keeps its least hash. Empty bins are filled by optimal densification: each bin has its own random order of
all bins and takes the value of the first filled one, so two sets with the same filled bins borrow alike.
Of each bin ``BITS`` low-order bits of the mixed value are stored, two bins to a byte. Of two fingerprints
the share of equal bins, corrected for bins that agree by chance (1 / 2**BITS of the unequal ones),
estimates the Jaccard similarity of the shingle sets; its standard error is at most 0.034 plus what borrowed
bins add.

``edited`` compares every document with an edit of itself: its last third replaced by the beginning of the
document that follows in descending order of ids (the first follows the last). The documents are dealt out
once by ranges of that order and walked through within a range, each row waiting for the next; the last row
of a range meets the first of the next range in a second, small step.

Defined cases: a null text is empty; a text of fewer than ``SIZE`` words is one shingle; without words the
fingerprint is empty, which is like another empty one (1.0) and unlike all others (0.0); rows without an id
come last; rows that repeat an id come in the order of a hash of their texts; a lone document follows itself;
texts are used whole, however long; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.llm import common, wordhash

SIZE = 5
BINS = 256
BITS = 4
PIECE_BYTES = 2 << 20
PIECE_ROWS = 2048

_SHIFT = np.uint64(64 - (BINS - 1).bit_length())
_EMPTY = np.iinfo(np.uint64).max
_STEP = np.uint64(0xD1B54A32D192ED03)
_RANDOM = np.random.RandomState(13)
#: Of every bin: the place of each bin in its random order.
_ORDER = _RANDOM.rand(BINS, BINS).argsort(axis=1).astype(np.uint16)
_SALT = _RANDOM.randint(1, 1 << 62, BINS).astype(np.uint64)


def shingle_hashes(column: pa.Array, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of every text, and the row of each."""
    data, bounds = wordhash.flat(column)
    starts, ends, counts = wordhash.words(data, bounds, wordhash.SPACES)
    sums = wordhash.prefix_sums(wordhash.ASCII_LOWER[data])
    word = wordhash.mix(wordhash.between(sums, starts, ends) + (ends - starts).astype(np.uint64))
    number = np.diff(counts)
    row = np.repeat(np.arange(len(number)), number)
    rolled = np.zeros(max(len(word) - size + 1, 0), np.uint64)
    for k in range(size):
        rolled = rolled * _STEP + word[k : k + len(rolled)]
    inside = row[: len(rolled)] == row[size - 1 :] if len(rolled) else np.zeros(0, bool)
    hashes, rows = [rolled[inside]], [row[: len(rolled)][inside]]
    for r in np.flatnonzero((number > 0) & (number < size)):
        whole = number[r : r + 1].astype(np.uint64)
        for w in word[counts[r] : counts[r + 1]]:
            whole = whole * _STEP + w
        hashes.append(whole)
        rows.append(np.array([r]))
    return wordhash.mix(np.concatenate(hashes)), np.concatenate(rows)


def densify(filled: np.ndarray) -> np.ndarray:
    """The bin whose value each bin has: itself if filled, else the first filled one in its order."""
    source = np.arange(len(filled))
    full = np.flatnonzero(filled)
    empty = np.flatnonzero(~filled)
    if len(full) and len(empty):
        source[empty] = full[_ORDER[np.ix_(empty, full)].argmin(axis=1)]
    return source


def fingerprints(texts: list[str]) -> list[bytes]:
    """Packed low-order bits of every text."""
    out = []
    with np.errstate(over="ignore"):
        for a, b in _pieces(texts):
            hashes, rows = shingle_hashes(pa.array(texts[a:b], pa.string()))
            table = np.full((b - a, BINS), _EMPTY, np.uint64)
            np.minimum.at(table.ravel(), rows * BINS + (hashes >> _SHIFT).astype(np.int64), hashes)
            filled = table != _EMPTY
            some = filled.any(axis=1)
            for r in np.flatnonzero(some & ~filled.all(axis=1)):
                table[r] = table[r, densify(filled[r])]
            low = wordhash.mix(table ^ _SALT).astype(np.uint8) & np.uint8((1 << BITS) - 1)
            packed = (low[:, 0::2] << np.uint8(BITS)) | low[:, 1::2]
            out.extend(p.tobytes() if s else b"" for p, s in zip(packed, some))
    return out


def _pieces(texts: list[str]) -> Iterator[tuple[int, int]]:
    first, held = 0, 0
    for i, text in enumerate(texts):
        held += len(text)
        if held >= PIECE_BYTES or i + 1 - first >= PIECE_ROWS:
            yield first, i + 1
            first, held = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


def likeness(a: bytes, b: bytes) -> float:
    """Estimated Jaccard similarity of the shingle sets of two fingerprints."""
    if not a or not b:
        return float(a == b)
    x = np.frombuffer(a, np.uint8) ^ np.frombuffer(b, np.uint8)
    low = np.uint8((1 << BITS) - 1)
    share = (np.count_nonzero((x & low) == 0) + np.count_nonzero(x >> np.uint8(BITS) == 0)) / BINS
    chance = 1 / (1 << BITS)
    return min(max((share - chance) / (1 - chance), 0.0), 1.0)


def edit(text: str, following: str) -> str:
    """The last third of the text replaced by as much of the beginning of the following one."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


_NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
_RESULT = (
    "doc_id bigint, n_chars bigint, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, "
    "near_edited double, near_next double"
)


def _compared(ids: list, texts: list[str], marks: list[bytes], following: list[str], marks_next: list[bytes]) -> list[pa.Array]:
    changed = [edit(t, f) for t, f in zip(texts, following)]
    marks_changed = fingerprints(changed)
    return [
        pa.array(ids, pa.int64()),
        pa.array([len(t) for t in texts], pa.int64()),
        pa.array([hashlib.sha256(t.encode()).digest() for t in changed], pa.binary()),
        pa.array(marks, pa.binary()),
        pa.array(marks_changed, pa.binary()),
        pa.array([likeness(a, b) for a, b in zip(marks, marks_changed)], pa.float64()),
        pa.array([likeness(a, b) for a, b in zip(marks, marks_next)], pa.float64()),
    ]


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one range against the row after each; the last one leaves with its text, the first one too."""
    names = [*_NAMES, "head", "tail"]
    held_ids, held, held_marks, first, number = [], [], [], None, None
    for piece in common.slices(batches, "text", PIECE_BYTES):
        texts = held + [t or "" for t in piece.column("text").to_pylist()]
        ids, number = held_ids + piece.column("doc_id").to_pylist(), piece.column("part")[0].as_py()
        marks = held_marks + fingerprints(texts[len(held) :])
        n = len(texts) - 1
        if n:
            arrays = _compared(ids[:-1], texts[:-1], marks[:-1], texts[1:], marks[1:])
            heads = [None] * n
            if first is None:
                first = heads[0] = texts[0]
            arrays += [pa.array(heads, pa.string()), pa.nulls(n, pa.string()), pa.array([number] * n, pa.int32())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*names, "part"])
        held_ids, held, held_marks = ids[-1:], texts[-1:], marks[-1:]
    if held:
        nothing = [pa.nulls(1, t) for t in (pa.binary(), pa.binary(), pa.float64(), pa.float64())]
        arrays = [pa.array(held_ids, pa.int64()), pa.array([len(held[0])], pa.int64()), nothing[0]]
        arrays += [pa.array(held_marks, pa.binary()), *nothing[1:], pa.array([held[0] if first is None else None], pa.string())]
        arrays += [pa.array(held, pa.string()), pa.array([number], pa.int32())]
        yield pa.RecordBatch.from_arrays(arrays, names=[*names, "part"])


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, following = batch.column("tail").to_pylist(), batch.column("following").to_pylist()
        ids = batch.column("doc_id").to_pylist()
        yield pa.RecordBatch.from_arrays(
            _compared(ids, texts, fingerprints(texts), following, fingerprints(following)), names=_NAMES
        )


def edited(documents: DataFrame) -> DataFrame:
    """doc_id, n_chars, fingerprints of the text and of its edit, and how like they and the next document's are."""
    spark = documents.sparkSession
    tie = F.xxhash64("text")
    order = F.col("doc_id").desc_nulls_last()
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    dealt = rows.repartitionByRange(common.partitions(spark), order, tie, F.rand(13)).sortWithinPartitions(order, tie, "text")
    walked = dealt.withColumn("part", F.spark_partition_id()).mapInArrow(_walk, f"{_RESULT}, head string, tail string, part int")
    walked = common.stored(walked, "walked")
    # One number per range: which range comes after which.
    parts = sorted(r.part for r in walked.select("part").distinct().collect())
    after = spark.createDataFrame(list(zip(parts, parts[1:] + parts[:1])), "part int, next int")
    heads = walked.filter("head is not null").select(F.col("part").alias("next"), F.col("head").alias("following"))
    tails = walked.filter("tail is not null").select("doc_id", "tail", "part").join(after, "part").join(heads, "next")
    last = tails.select("doc_id", "tail", "following").mapInArrow(_ends, _RESULT)
    return walked.filter("tail is null").select(*_NAMES).unionByName(last)
