"""Token counts under a unigram model, with one dynamic program over a trie of pre-tokens.

A pre-token is cut into the pieces of least total cost, fewest pieces among equals. The cost of a piece is
``log2(rank + 2)`` in thousandths, its rank in the vocabulary file standing for its frequency; the vocabulary
is given and nothing of it is trained. The least cost of a prefix depends on the prefix alone, so distinct
pre-tokens are inserted into a trie and every node is computed once: in sorted order that is a walk that
keeps the nodes of the current path and goes back to the common prefix. Counts at terminal nodes are stored
and summed per document.

Each task keeps the counts of the pre-tokens it has met, up to ``KEPT`` of them, then starts afresh.

Defined cases: null and empty texts have no tokens; repeated rows are counted alike; other columns stay, but
for those named like an output.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterable, Iterator
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from geoloom.llm import bpe, common

KEPT = 1_000_000
PIECE_BYTES = 2 << 20
COUNT_BITS = 40  # a sum holds the cost above and the number of pieces below these bits


def pieces(ranks: str) -> dict[bytes, int]:
    """Weight of every piece of a rank file: its cost above ``COUNT_BITS``, and one piece."""
    out = {}
    for line in ranks.split("\n"):
        if line:
            piece, rank = line.split()
            cost = round(1000 * math.log2(int(rank) + 2))
            out[base64.b64decode(piece)] = (cost << COUNT_BITS) + 1
    return out


class Counter(dict):
    """Token counts of pre-tokens."""

    def __init__(self, ranks: str):
        super().__init__()
        self.weights = pieces(ranks)
        self.longest = max(map(len, self.weights))

    def learn(self, texts: Iterable[str]) -> None:
        """Insert distinct pre-tokens into the trie and store the counts of its terminal nodes."""
        weight, longest = self.weights.get, self.longest
        last, path = b"", [0]  # least sums of the prefixes of the pre-token before
        for key, text in sorted((t.encode(), t) for t in texts):
            shared = len(commonprefix((last, key)))
            del path[shared + 1 :]
            for end in range(shared + 1, len(key) + 1):
                least = None
                for begin in range(end - 1, max(end - longest, 0) - 1, -1):
                    held = weight(key[begin:end])
                    if held is not None:
                        held += path[begin]
                        if least is None or held < least:
                            least = held
                path.append(least)
            last = key
            self[text] = path[-1] & ((1 << COUNT_BITS) - 1)


_loaded: dict[int, Counter] = {}


def counter(ranks: str) -> Counter:
    """The counter of a rank file, one in a Python worker."""
    key = hash(ranks)
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Counter(ranks)
    return _loaded[key]


def count_tokens(documents: DataFrame, ranks: str, text: str = "text") -> DataFrame:
    """The other columns with ``n_pretokens`` and ``n_tokens``; ``ranks`` is a file the driver can read."""
    content = documents.sparkSession.sparkContext.broadcast(bpe.read(ranks))
    outputs = ["n_pretokens", "n_tokens"]
    kept = [c for c in documents.columns if c not in [*outputs, text]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, split = counter(content.value), bpe.splitter()
        for batch in common.slices(batches, text, PIECE_BYTES):
            texts = [split(t) if t else [] for t in batch.column(text).to_pylist()]
            new = set().union(*texts).difference(counts)
            if len(counts) + len(new) > KEPT:
                counts.clear()
                new = set().union(*texts)
            counts.learn(new)
            known = counts.__getitem__
            sums = [sum(map(known, t)) for t in texts]
            arrays = [pa.array(np.array([len(t) for t in texts], np.int64)), pa.array(np.array(sums, np.int64))]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *arrays], names=[*kept, *outputs])

    types = [f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema.fields if f.name in kept]
    return documents.select(*kept, text).mapInArrow(run, ", ".join([*types, "n_pretokens bigint", "n_tokens bigint"]))
