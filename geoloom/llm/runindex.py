"""Repeated passages by matching statistics against a run-length compressed Burrows-Wheeler index.

A byte is removed if it lies in a string of ``length`` bytes that also starts earlier: in a document of
smaller id, or earlier in the same one. The work is laid out for corpora where most text is unique:

1. Every window of ``length`` bytes has an anchor, the smallest hash of its ``GRAM``-byte grams; equal
   windows have equal anchors. Each document gives one row per anchor occurrence with a fingerprint of all
   windows around it. A map task sends each (anchor, surroundings) pair once per piece of input.
2. Rows meet by anchor, sorted. Equal surroundings: all windows there repeat the first such place, which
   settles whole copies. An anchor that occurs with one surrounding only is unique; nothing more is done.
3. Only where an anchor occurs in different surroundings their bytes (under twice ``length``) are fetched
   and meet again by anchor. The first surroundings of every anchor form a reference, for which a run-length
   Burrows-Wheeler index with positions sampled at run ends is built; the others stream through it, and
   their matching statistics tell which windows occur in the reference, that is, earlier. Windows not in
   any reference are compared among themselves.
4. An anchor with more than ``CROWD`` different surroundings does not go to one task: its windows are rows
   of their own, reduced to the earliest place by partial aggregation.

Positions are bytes. Decisions travel as (doc_id, start, windows) and are applied to each document once.

Defined cases: null and empty texts keep nothing and lose nothing; texts shorter than ``length`` are kept;
rows that repeat a doc_id and its text are the same document, so places in them precede each other by position
only; rows that repeat a doc_id with another text are documents of their own, in the order of their texts' MD5;
a null doc_id comes before all others; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.llm import common, wordhash

GRAM = 32
CROWD = 4096
PIECE_BYTES = 4 << 20
STREAM_BYTES = 4 << 20
_STEP = np.uint64(0xD1B54A32D192ED03)

DUPLICATE, FETCH, CROWDED = 0, 1, 2


# --- anchors -----------------------------------------------------------------------------------------------


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    n, least, size = len(x) - width + 1, x, 1
    while size * 2 <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    return np.minimum(least[:n], least[width - size : width - size + n])


def runs(data: np.ndarray, bounds: np.ndarray, length: int) -> dict[str, np.ndarray]:
    """Runs of windows with one anchor place: row, start in the row, windows, anchor, surroundings."""
    size = np.diff(bounds)
    count = np.maximum(size - length + 1, 0)
    if not count.any():
        return {k: np.zeros(0, np.int64) for k in ("row", "start", "windows", "anchor", "around")}
    sums = wordhash.prefix_sums(data)
    at = np.arange(len(data) - GRAM + 1)
    gram = wordhash.mix(wordhash.between(sums, at, at + GRAM))
    # Upper hash bits, then the position: the leftmost of equal ones, whatever the piece.
    ranked = (gram >> np.uint64(32) << np.uint64(32)) | at.astype(np.uint64)
    smallest = (_sliding_min(ranked, length - GRAM + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    row = np.repeat(np.arange(len(size)), count)
    begin = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + bounds[row]
    anchor = smallest[begin]
    new = np.ones(len(row), bool)
    new[1:] = anchor[1:] != anchor[:-1]
    head = np.flatnonzero(new)
    windows = np.diff(np.append(head, len(row)))
    row, begin, anchor = row[head], begin[head], anchor[head]
    end = begin + windows - 1
    around = wordhash.between(sums, begin, begin + length)
    around = around * _STEP + wordhash.between(sums, end, end + length)
    around = wordhash.mix((around * _STEP + windows.astype(np.uint64)) * _STEP + (anchor - begin).astype(np.uint64))
    return {
        "row": row,
        "start": begin - bounds[row],
        "windows": windows,
        "anchor": gram[anchor].view(np.int64),
        "around": around.view(np.int64),
    }


def _order_ids(ids: pa.Array) -> np.ndarray:
    return ids.cast(pa.int64()).fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)


def places(documents: DataFrame, length: int) -> DataFrame:
    """Anchor rows; places that repeat an earlier one of the same piece are settled at once (around null).

    From here on ``doc_id`` is a document's place in the order of documents.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in common.slices(batches, "text", PIECE_BYTES):
                data, bounds = wordhash.flat(batch.column("text"))
                found = runs(data, bounds, length)
                ids = _order_ids(batch.column("doc_id"))[found["row"]]
                order = np.lexsort((found["start"], ids, found["around"], found["anchor"]))
                anchor, around = found["anchor"][order], found["around"][order]
                ids, start = ids[order], found["start"][order]
                same = np.zeros(len(order), bool)
                same[1:] = (anchor[1:] == anchor[:-1]) & (around[1:] == around[:-1])
                head = np.maximum.accumulate(np.where(same, 0, np.arange(len(order)))) if len(order) else order
                later = same & ((ids != ids[head]) | (start != start[head]))
                once = ~same | later  # a repeated row of the same place is told nothing new
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.where(later, ids * 31 + start, anchor)[once]),
                        pa.array(around[once], mask=later[once]),
                        pa.array(ids[once]),
                        pa.array(start[once].astype(np.int32)),
                        pa.array(found["windows"][order][once].astype(np.int16)),
                    ],
                    names=["anchor", "around", "doc_id", "start", "windows"],
                )

    schema = "anchor bigint, around bigint, doc_id bigint, start int, windows smallint"
    return documents.select(F.col("place").alias("doc_id"), "text").mapInArrow(run, schema)


_DECISION = "doc_id bigint, start int, windows smallint, decision tinyint, anchor bigint"
_FIELDS = ("anchor", "around", "doc_id", "start", "windows")


def decide(rows: DataFrame) -> DataFrame:
    """What to do with every place, from all places of its anchor.

    A partition comes sorted and is read once; of the anchor that a batch ends with, the first place of
    each surrounding is carried into the next batch, ``CROWD`` places at most.
    """

    def told(cells: dict[str, np.ndarray], rows: np.ndarray, decision: np.ndarray) -> pa.RecordBatch:
        arrays = [pa.array(cells[c][rows]) for c in ("doc_id", "start", "windows")]
        arrays += [pa.array(decision[rows]), pa.array(cells["anchor"][rows])]
        return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "start", "windows", "decision", "anchor"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] | None = None
        crowded = False  # whether the anchor of the held rows has been found crowded; they are told then
        for batch in batches:
            settled = np.asarray(batch.column("around").is_null())
            cells = {c: batch.column(c).fill_null(0).to_numpy() for c in _FIELDS}
            if settled.any():
                yield told(cells, np.flatnonzero(settled), np.full(len(settled), DUPLICATE, np.int8))
            cells = {c: v[~settled] for c, v in cells.items()}
            carried = len(held["anchor"]) if held else 0
            if held:
                cells = {c: np.concatenate([held[c], v]) for c, v in cells.items()}
            n = len(cells["anchor"])
            if not n:
                continue
            new_anchor, new_around = np.ones(n, bool), np.ones(n, bool)
            new_anchor[1:] = cells["anchor"][1:] != cells["anchor"][:-1]
            new_around[1:] = new_anchor[1:] | (cells["around"][1:] != cells["around"][:-1])
            first = np.maximum.accumulate(np.where(new_around, np.arange(n), 0))
            moved = (cells["doc_id"] != cells["doc_id"][first]) | (cells["start"] != cells["start"][first])
            decision = np.where(~new_around & moved, DUPLICATE, -1).astype(np.int8)
            heads = np.flatnonzero(new_around)
            group = np.cumsum(new_anchor)[heads] - 1
            kinds = np.bincount(group)
            many = kinds > CROWD
            many[0] |= crowded
            last = group == group[-1]
            several = kinds[group] > 1
            decision[heads[several & ~last]] = FETCH
            decision[heads[many[group]]] = CROWDED
            if crowded:
                decision[:carried] = -1
            out = np.flatnonzero(decision >= 0)
            if len(out):
                yield told(cells, out, decision)
            crowded = bool(many[group[-1]])
            stay = heads[last][-1:] if crowded else heads[last]
            held = {c: v[stay] for c, v in cells.items()}
        if held and not crowded and len(held["anchor"]) > 1:
            n = len(held["anchor"])
            yield told(held, np.arange(n), np.full(n, FETCH, np.int8))

    return rows.mapInArrow(run, _DECISION)


# --- surroundings that differ ------------------------------------------------------------------------------


def surroundings(documents: DataFrame, decisions: DataFrame, length: int) -> DataFrame:
    """Bytes around the places to fetch, and every window of crowded places as a row of hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in common.slices(batches, "text", PIECE_BYTES):
                data, bounds = wordhash.flat(batch.column("text"))
                wanted = batch.column("wanted")
                flat = wanted.flatten()
                row = np.repeat(np.arange(batch.num_rows), np.diff(wanted.offsets.to_numpy()))
                start, windows, anchor, decision = (
                    flat.field(k).to_numpy() for k in ("start", "windows", "anchor", "decision")
                )
                ids = batch.column("place").to_numpy()[row]
                begin = bounds[row] + start
                fits = start + windows + length - 1 <= (bounds[row + 1] - bounds[row])
                fetch = np.flatnonzero((decision == FETCH) & fits)
                text = data.tobytes()
                around = [text[b : b + w + length - 1] for b, w in zip(begin[fetch], windows[fetch].astype(int))]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(anchor[fetch]),
                        pa.nulls(len(fetch), pa.int64()),
                        pa.array(ids[fetch]),
                        pa.array(start[fetch]),
                        pa.array(around, pa.binary()),
                    ],
                    names=["anchor", "second", "doc_id", "start", "around"],
                )
                crowd = np.flatnonzero((decision == CROWDED) & fits)
                if len(crowd):
                    times = windows[crowd].astype(np.int64)
                    each = np.repeat(crowd, times)
                    nth = np.arange(len(each)) - np.repeat(np.cumsum(times) - times, times)
                    at = begin[each] + nth
                    one = wordhash.between(wordhash.prefix_sums(data), at, at + length)
                    two = wordhash.between(wordhash.prefix_sums(data, wordhash.BYTE_VALUES[::-1]), at, at + length)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(wordhash.mix(one).view(np.int64)),
                            pa.array(wordhash.mix(two).view(np.int64)),
                            pa.array(ids[each]),
                            pa.array((start[each] + nth).astype(np.int32)),
                            pa.nulls(len(each), pa.binary()),
                        ],
                        names=["anchor", "second", "doc_id", "start", "around"],
                    )

    wanted = (
        decisions.filter(F.col("decision") != DUPLICATE)
        .groupBy(F.col("doc_id").alias("place"))
        .agg(F.collect_list(F.struct("start", "windows", "anchor", "decision")).alias("wanted"))
    )
    joined = documents.select("place", "text").join(wanted, "place")
    schema = "anchor bigint, second bigint, doc_id bigint, start int, around binary"
    return joined.mapInArrow(run, schema)


def ordered(documents: DataFrame) -> DataFrame:
    """doc_id, text and place: a number in the order of documents, the same for rows that are the same document."""
    rows = documents.select("doc_id", "text")
    number = F.col("doc_id").cast("bigint")
    if documents.groupBy("doc_id").count().filter("count > 1").isEmpty():
        # Ids in their order, a null id before all others.
        return rows.withColumn("place", F.coalesce(number, F.lit(-(2**63)).cast("bigint")))
    spark = documents.sparkSession
    rows = rows.withColumns({"number": number, "mark": F.md5(F.coalesce("text", F.lit("")))})
    dealt = rows.select("number", "mark").distinct().repartitionByRange(common.partitions(spark), "number", "mark")
    dealt = dealt.sortWithinPartitions("number", "mark").select(
        F.monotonically_increasing_id().alias("at"), "number", "mark"
    )
    dealt = common.stored(dealt, "places")  # numbers rise with the range and within it
    same = F.col("x.number").eqNullSafe(F.col("y.number")) & (F.col("x.mark") == F.col("y.mark"))
    joined = rows.alias("x").join(dealt.alias("y"), same).select("x.doc_id", "x.text", F.col("y.at").alias("place"))
    return common.stored(joined, "ordered")


class RunLengthIndex:
    """Run-length compressed Burrows-Wheeler transform of byte strings, with positions at run ends.

    Each string ends with a separator of its own, so strings sort by their bytes and then by number.
    """

    def __init__(self, strings: list[bytes]):
        self.data = np.frombuffer(b"".join(s + b"\0" for s in strings), np.uint8)
        ends = np.cumsum([len(s) + 1 for s in strings]) - 1
        symbol = self.data.astype(np.int64) + len(strings)
        symbol[ends] = np.arange(len(strings))
        order = _suffix_order(symbol, max(map(len, strings)) + 1)
        before = symbol[order - 1]  # of the first position: the last separator
        byte = np.where(before < len(strings), -1, before - len(strings))
        new = np.ones(len(order), bool)
        new[1:] = byte[1:] != byte[:-1]
        self.start = np.flatnonzero(new)
        self.size = np.diff(np.append(self.start, len(order)))
        self.byte = byte[self.start]
        self.at_start = order[self.start]
        self.at_end = order[self.start + self.size - 1]
        # Row of the first suffix that begins with a byte; separators come first.
        count = np.bincount(symbol[symbol >= len(strings)] - len(strings), minlength=256)
        self.base = len(strings) + np.concatenate([[0], np.cumsum(count)[:-1]])
        # Runs by byte: their numbers, and how often the byte occurs before each.
        self.by_byte = np.argsort(self.byte, kind="stable")
        sizes = self.size[self.by_byte]
        head = np.searchsorted(self.byte[self.by_byte], np.arange(-1, 257))
        total = np.concatenate([[0], np.cumsum(sizes)])
        self.first_run = head[1:]  # of byte b: [first_run[b], first_run[b + 1])
        occurs = np.empty(len(sizes), np.int64)
        occurs[self.by_byte] = total[:-1] - total[head[self.byte[self.by_byte] + 1]]
        self.occurs = occurs
        # One sorted key per run finds the next run of a byte after a row.
        self.key = self.byte[self.by_byte].astype(np.int64) * (len(order) + 1) + self.start[self.by_byte]
        self.rows = len(order)
        with np.errstate(over="ignore"):
            self.sums = wordhash.prefix_sums(self.data)

    def _step(self, run: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Row of the suffix one byte longer."""
        return self.base[self.byte[run]] + self.occurs[run] + row - self.start[run]

    def matching_statistics(self, strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Length of the longest match with the index from every position, strings end to end, and bounds.

        All strings advance together, from their last byte to their first. Where the run at hand holds
        another byte, the match goes on from the end of the run before or the start of the run after that
        holds it, whichever shares more with what has been read.
        """
        sizes = np.array([len(s) for s in strings], np.int64)
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        text = np.frombuffer(b"".join(strings), np.uint8)
        sums = wordhash.prefix_sums(text)
        out = np.zeros(len(text), np.int32)
        order = np.argsort(-sizes, kind="stable")
        row = np.zeros(len(order), np.int64)
        place = np.zeros(len(order), np.int64)
        matched = np.zeros(len(order), np.int64)
        end = bounds[1:][order]
        longest = int(sizes.max()) if len(sizes) else 0
        active = np.searchsorted(-sizes[order], -np.arange(1, longest + 1), side="right")
        for back, n in zip(range(1, longest + 1), active):
            at = end[:n] - back
            c = text[at].astype(np.int64)
            k, p, m = row[:n], place[:n], matched[:n]
            run = np.searchsorted(self.start, k, side="right") - 1
            jump = np.flatnonzero(self.byte[run] != c)
            p = p - 1
            if len(jump):
                cj, kj, mj = c[jump], k[jump], m[jump]
                after = np.searchsorted(self.key, cj * (self.rows + 1) + kj, side="left")
                low, high = self.first_run[cj], self.first_run[cj + 1]
                has_after, has_before = after < high, after > low
                next_run = self.by_byte[np.minimum(after, len(self.by_byte) - 1)]
                prev_run = self.by_byte[np.maximum(after - 1, 0)]
                tail = at[jump] + 1
                with_next = np.where(has_after, self._shared(sums, tail, self.at_start[next_run], mj), -1)
                with_prev = np.where(has_before, self._shared(sums, tail, self.at_end[prev_run], mj), -1)
                take_next = with_next >= with_prev
                best = np.maximum(with_next, with_prev)
                none = best < 0
                run[jump] = np.where(take_next, next_run, prev_run)
                k = k.copy()
                k[jump] = np.where(take_next, self.start[next_run], self.start[prev_run] + self.size[prev_run] - 1)
                p[jump] = np.where(take_next, self.at_start[next_run], self.at_end[prev_run]) - 1
                m = m.copy()
                m[jump] = np.maximum(best, 0)
                lost = jump[none]
            k = self._step(run, k)
            m = m + 1
            if len(jump) and len(lost):
                k[lost], p[lost], m[lost] = 0, self.at_start[0], 0
            row[:n], place[:n], matched[:n] = k, p, m
            out[at] = m
        return out, bounds

    def _shared(self, sums: np.ndarray, at: np.ndarray, place: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many bytes the strings from ``at`` and the index from ``place`` share, ``most`` at most."""
        low, high = np.zeros_like(most), np.minimum(most, len(self.data) - place)
        while (open_ := low < high).any():
            middle = (low + high + 1) >> 1
            same = wordhash.between(sums, at, np.minimum(at + middle, len(sums) - 1)) == wordhash.between(
                self.sums, place, place + middle
            )
            low = np.where(open_ & same, middle, low)
            high = np.where(open_ & ~same, middle - 1, high)
        return low


def _suffix_order(symbol: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in order, by doubling the compared length up to ``depth``."""
    rank = np.unique(symbol, return_inverse=True)[1].astype(np.int64)
    n, step = len(symbol), 1
    while step < depth:
        following = np.zeros(n, np.int64)
        following[: n - step] = rank[step:] + 1
        key = rank * (n + 1) + following
        order = np.argsort(key, kind="stable")
        changed = np.ones(n, np.int64)
        changed[0] = 0
        changed[1:] = key[order][1:] != key[order][:-1]
        rank[order] = np.cumsum(changed)
        step *= 2
        if rank[order[-1]] == n - 1:
            break
    return np.argsort(rank, kind="stable")


def _repeats(anchor: np.ndarray, ids: np.ndarray, start: np.ndarray, around: list[bytes], length: int):
    """Windows that occur earlier, for whole anchors sorted by place: row, window."""
    keep = np.ones(len(anchor), bool)
    keep[1:] = (anchor[1:] != anchor[:-1]) | (ids[1:] != ids[:-1]) | (start[1:] != start[:-1])
    kept = np.flatnonzero(keep)
    is_first = np.ones(len(kept), bool)
    is_first[1:] = anchor[kept][1:] != anchor[kept][:-1]
    reference, streamed = kept[is_first], kept[~is_first]
    if not len(streamed):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    index = RunLengthIndex([around[i] for i in reference])
    statistics, bounds = index.matching_statistics([around[i] for i in streamed])
    windows = np.diff(bounds) - length + 1
    row = np.repeat(np.arange(len(streamed)), windows)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(windows) - windows, windows)
    at = bounds[row] + nth
    marked = statistics[at] >= length
    # The rest is in no reference: compare it with itself, earliest place first.
    rest = np.flatnonzero(~marked)
    sums = wordhash.prefix_sums(np.frombuffer(b"".join(around[i] for i in streamed), np.uint8))
    window = wordhash.between(sums, at[rest], at[rest] + length)
    order = np.argsort(window, kind="stable")
    again = np.zeros(len(rest), bool)
    again[order[1:]] = window[order][1:] == window[order][:-1]
    marked[rest[again]] = True
    return streamed[row[marked]], nth[marked]


def matched(contexts: DataFrame, length: int) -> DataFrame:
    """Runs of windows in fetched surroundings that occur earlier."""

    def marks(tables: list[pa.RecordBatch]) -> pa.RecordBatch:
        whole = pa.Table.from_batches(tables).combine_chunks()
        anchor, ids, start = (whole.column(c).to_numpy() for c in ("anchor", "doc_id", "start"))
        row, nth = _repeats(anchor, ids, start, whole.column("around").to_pylist(), length)
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (nth[1:] != nth[:-1] + 1)
        head = np.flatnonzero(new)
        size = np.diff(np.append(head, len(row)))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(ids[row[head]]),
                pa.array((start[row[head]] + nth[head]).astype(np.int32)),
                pa.array(size.astype(np.int16)),
            ],
            names=["doc_id", "start", "windows"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            waiting: list[pa.RecordBatch] = []
            size = 0
            for batch in batches:
                if not batch.num_rows:
                    continue
                anchor = batch.column("anchor").to_numpy()
                size += batch.column("around").nbytes
                if size >= STREAM_BYTES and (anchor != anchor[-1]).any():
                    cut = int(np.flatnonzero(anchor != anchor[-1])[-1]) + 1  # the last anchor may go on
                    yield marks([*waiting, batch.slice(0, cut)])
                    waiting, size = [batch.slice(cut)], 0
                else:
                    waiting.append(batch)
            if waiting:
                yield marks(waiting)

    dealt = contexts.repartition(common.partitions(contexts.sparkSession), "anchor")
    rows = dealt.select("anchor", "doc_id", "start", "around").sortWithinPartitions("anchor", "doc_id", "start")
    return rows.mapInArrow(run, "doc_id bigint, start int, windows smallint")


# --- the operator ------------------------------------------------------------------------------------------


def repeated_windows(documents: DataFrame, length: int = 100) -> DataFrame:
    """doc_id (the place of ``ordered`` documents), start, windows: runs of windows that also start earlier."""
    spark = documents.sparkSession
    dealt = places(documents, length).repartition(common.partitions(spark), "anchor")
    decisions = decide(dealt.sortWithinPartitions("anchor", "around", "doc_id", "start"))
    decisions = common.stored(decisions, "decisions")
    contexts = common.stored(surroundings(documents, decisions, length), "surroundings")
    crowd = contexts.filter("second is not null").select("anchor", "second", "doc_id", "start")
    earliest = crowd.groupBy("anchor", "second").agg(F.min(F.struct("doc_id", "start")).alias("first"))
    later = crowd.join(earliest, ["anchor", "second"]).filter(F.struct("doc_id", "start") != F.col("first"))
    return (
        decisions.filter(F.col("decision") == DUPLICATE)
        .select("doc_id", "start", "windows")
        .unionByName(matched(contexts.filter("second is null"), length))
        .unionByName(later.select("doc_id", "start", F.lit(1).cast("smallint").alias("windows")))
    )


def deduplicate(documents: DataFrame, length: int = 100) -> DataFrame:
    """doc_id, n_bytes, removed spans (start, end in bytes) and the remaining bytes of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, "text", PIECE_BYTES):
            data, bounds = wordhash.flat(batch.column("text"))
            marks = batch.column("marks")
            first = marks.offsets.to_numpy()
            flat = marks.flatten()
            begin_of, size_of = flat.field("start").to_numpy(), flat.field("windows").to_numpy()
            empty = np.asarray(marks.is_null())
            where = np.concatenate([[0], np.cumsum(np.where(empty, 0, np.diff(first)))])
            kept, spans = [], []
            for i in range(batch.num_rows):
                text = data[bounds[i] : bounds[i + 1]]
                a, b = where[i], where[i + 1]
                if a == b:
                    kept.append(text.tobytes())
                    spans.append([])
                    continue
                cover = np.zeros(len(text) + 1, np.int32)
                start = np.minimum(begin_of[a:b], len(text))
                np.add.at(cover, start, 1)
                np.add.at(cover, np.minimum(start + size_of[a:b].astype(np.int64) + length - 1, len(text)), -1)
                gone = np.cumsum(cover[:-1]) > 0
                kept.append(text[~gone].tobytes())
                edge = np.flatnonzero(np.diff(np.concatenate([[0], gone, [0]])))
                spans.append([{"start": int(x), "end": int(y)} for x, y in zip(edge[::2], edge[1::2])])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(np.diff(bounds)),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                    pa.array(kept, pa.binary()),
                ],
                names=["doc_id", "n_bytes", "spans", "kept"],
            )

    documents = ordered(documents)
    marks = (
        repeated_windows(documents, length)
        .groupBy(F.col("doc_id").alias("place"))
        .agg(F.collect_list(F.struct("start", "windows")).alias("marks"))
    )
    joined = documents.join(marks, "place", "left").drop("place")
    kind = documents.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(run, f"doc_id {kind}, n_bytes bigint, spans array<struct<start:int,end:int>>, kept binary")
