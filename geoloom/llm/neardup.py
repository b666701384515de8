"""Near-duplicate documents: MinHash with tensored banding, exact verification, connected components.

A document is its set of distinct word shingles. n x n hash tables would need a band of MinHash values each;
here two collections of n half-bands are computed and the key of table (i, j) is the pair of half-band i of
the first and half-band j of the second, so the number of MinHash values is about the square root of what
independent tables need. n follows from the threshold: a pair at the threshold has no table in common with
probability ``LOST`` at most (8 tables a collection for 0.85, 10 for 0.8).

Work is cut step by step, and no step emits all pairs of a bucket:

1. Documents with equal sets become one class, by partial aggregation.
2. A class of which less than two half-bands occur in other classes has no table in common with any and leaves.
3. A class's core is the number of its shingles that other candidates have as well. Overlap with anybody is
   at most the smaller core, which bounds similarity from above, exactly; classes that cannot reach the
   threshold with any size present in a bucket leave the bucket.
4. In each bucket all classes are compared with the one of the largest bound (a star), on full sets.
5. Where classes of different components still share a half-band of the first collection, they are
   compared, each pair in the first such bucket, again on full sets. Pairs inside a component cannot change the result.
   Sets are compared by the 64-bit hashes of their shingles.
   Cores are also counted by ``BLOCKS`` blocks of shingle hashes: the overlap of two sets is at most the sum
   over the blocks of the smaller count, which rules most near misses out before their sets are read.

Defined cases: a null or empty text has an empty set and is linked with nothing; rows that repeat a doc_id
are documents of their own, each with the component of its own text; a null doc_id takes no part in links; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.llm import common, wordhash
from geoloom.llm.graph import components

ROWS = 2
LOST = 8e-5
BLOCKS = 64
PIECE_BYTES = 2 << 20

_RANDOM = np.random.RandomState(7)
_MOST = 256  # hash functions, of which as many are used as there are MinHash values
_XOR = _RANDOM.randint(1, 1 << 62, _MOST).astype(np.uint64)[:, None]
_ODD = (_RANDOM.randint(1, 1 << 62, _MOST).astype(np.uint64) * np.uint64(2) + np.uint64(1))[:, None]
_STEP = np.uint64(0xD1B54A32D192ED03)


def shingle_sets(column: pa.Array, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text."""
    data, bounds = wordhash.flat(column)
    starts, ends, counts = wordhash.words(data, bounds, wordhash.SPACES)
    sums = wordhash.prefix_sums(wordhash.ASCII_LOWER[data])
    word = wordhash.mix(wordhash.between(sums, starts, ends) + (ends - starts).astype(np.uint64))
    rolled = np.zeros(max(len(word) - size + 1, 0), np.uint64)
    for k in range(size):
        rolled = rolled * _STEP + word[k : k + len(rolled)]
    rolled = wordhash.mix(rolled)
    found = []
    for a, b in zip(counts[:-1], counts[1:]):
        if b - a >= size:
            found.append(np.unique(rolled[a : b - size + 1]))
        elif b > a:
            whole = np.uint64(b - a)
            for w in word[a:b]:
                whole = whole * _STEP + w
            found.append(wordhash.mix(np.array([whole], np.uint64)))
        else:
            found.append(np.zeros(0, np.uint64))
    return found


def tables_for(percent: int) -> int:
    """Half-bands of each collection: both miss a pair at the threshold with probability ``LOST`` together."""
    return min(_MOST // (2 * ROWS), max(1, math.ceil(math.log(LOST / 2) / math.log(1 - (min(percent, 99) / 100) ** ROWS))))


def _bands(shingles: np.ndarray, tables: int) -> np.ndarray:
    number = 2 * tables * ROWS
    mins = np.empty(number, np.uint64)
    mins.fill(np.iinfo(np.uint64).max)
    for a in range(0, len(shingles), 4096):
        hashed = (shingles[None, a : a + 4096] ^ _XOR[:number]) * _ODD[:number]
        hashed ^= hashed >> np.uint64(29)
        np.minimum(mins, (hashed * _STEP).min(axis=1), out=mins)
    joined = np.zeros(2 * tables, np.uint64)
    for k in range(ROWS):
        joined = joined * _STEP + wordhash.mix(mins[k::ROWS])
    return joined


def _marks(shingles: np.ndarray) -> tuple:
    """Two halves of a set fingerprint."""
    return shingles.sum(dtype=np.uint64), wordhash.mix(shingles ^ _STEP).sum(dtype=np.uint64)


def sketches(documents: DataFrame, size: int, tables: int) -> DataFrame:
    """doc_id, text_hash, n_shingles, the set's fingerprint, and the half-bands of both collections."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in common.slices(batches, "text", PIECE_BYTES):
                sets = shingle_sets(batch.column("text"), size)
                marks = np.zeros((len(sets), 2), np.uint64)
                bands = np.zeros((len(sets), 2 * tables), np.uint64)
                for i, s in enumerate(sets):
                    if len(s):
                        marks[i] = _marks(s)
                        bands[i] = _bands(s, tables)
                halves = bands.view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").cast(pa.int64()),
                        batch.column("text_hash"),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(marks[:, 0].view(np.int64)),
                        pa.array(marks[:, 1].view(np.int64)),
                        *[
                            pa.ListArray.from_arrays(
                                pa.array(np.arange(len(sets) + 1, dtype=np.int32) * tables),
                                pa.array(np.ascontiguousarray(h).ravel()),
                            )
                            for h in (halves[:, :tables], halves[:, tables:])
                        ],
                    ],
                    names=["doc_id", "text_hash", "n_shingles", "mark_a", "mark_b", "a", "b"],
                )

    schema = "doc_id bigint, text_hash bigint, n_shingles bigint, mark_a bigint, mark_b bigint, a array<bigint>, b array<bigint>"
    return documents.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(run, schema)


def full_sets(documents: DataFrame, ids: DataFrame, size: int) -> DataFrame:
    """Shingles and fingerprint of the sets of the documents whose ids are in ``ids`` (doc)."""
    names = ["doc", "n_shingles", "mark_a", "mark_b", "shingles"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in common.slices(batches, "text", PIECE_BYTES):
                sets = shingle_sets(batch.column("text"), size)
                lengths = np.zeros(len(sets) + 1, np.int32)
                np.cumsum([len(s) for s in sets], out=lengths[1:])
                values = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
                marks = np.array([_marks(s) for s in sets], np.uint64).reshape(-1, 2).view(np.int64)
                shingles = pa.ListArray.from_arrays(pa.array(lengths), pa.array(values.view(np.int64)))
                counts = pa.array(np.diff(lengths).astype(np.int64))
                arrays = [batch.column("doc"), counts, pa.array(marks[:, 0]), pa.array(marks[:, 1]), shingles]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    wanted = documents.select(F.col("doc_id").cast("bigint").alias("doc"), "text").join(ids, "doc", "left_semi")
    # Rows that repeat an id with another text come along; the fingerprint tells the class's own set.
    return wanted.mapInArrow(run, "doc bigint, n_shingles bigint, mark_a bigint, mark_b bigint, shingles array<bigint>")


def _half_keys(side: str, number: int):
    return F.transform(F.col(side), lambda v, i: F.xxhash64(i + number, v))


def _table_keys(tables: int):
    pairs = F.transform("a", lambda v, i: F.transform("b", lambda w, j: F.xxhash64(i * tables + j, v, w)))
    return F.flatten(pairs)


def candidates(classes: DataFrame, tables: int) -> DataFrame:
    """Classes that may share a table with others, with their rows."""
    halves = classes.select("rep", F.explode(F.concat(_half_keys("a", 0), _half_keys("b", tables))).alias("key"))
    shared = halves.groupBy("key").count().filter("count > 1").select("key")
    twice = halves.join(shared, "key").groupBy("rep").count().filter("count > 1").select("rep")
    return classes.join(twice, "rep", "left_semi")


def _reach(core: str, n: str, percent: int):
    """Largest partner a class can have: overlap is at most its core."""
    return F.floor(F.col(core) * (100 + percent) / percent) - F.col(n)


def links(documents: DataFrame, classes: DataFrame, size: int, percent: int, tables: int) -> DataFrame:
    """Verified links (u, v) between classes that connect whatever is connected."""
    near = common.stored(candidates(classes, tables), "near")
    members = near.select("rep", "doc", F.explode(_table_keys(tables)).alias("key"))
    crowded = members.groupBy("key").count().filter("count > 1").select("key")
    members = common.stored(members.join(crowded, "key"), "members")
    ids = members.select("doc").distinct()
    members = members.select("rep", "key")
    sets = common.stored(full_sets(documents, ids, size), "sets")
    own = ["doc", "n_shingles", "mark_a", "mark_b"]
    sets = sets.join(near.select("rep", *own), own).select("rep", "n_shingles", "shingles")
    sets = sets.dropDuplicates(["rep"]) if repeated(documents) else sets
    each = sets.select("rep", F.explode("shingles").alias("s"))
    common_to = each.groupBy("s").agg(F.count("*").alias("held")).filter("held > 1").select("s")
    block = F.pmod("s", F.lit(BLOCKS)).alias("block")
    core = each.join(common_to, "s").groupBy("rep", block).agg(F.count("*").alias("held"))
    core = core.groupBy("rep").agg(
        F.sum("held").alias("core"), F.map_from_entries(F.collect_list(F.struct("block", "held"))).alias("blocks")
    )
    core = core.join(near.select("rep", "n_shingles", "a", "b"), "rep").withColumn("reach", _reach("core", "n_shingles", percent))
    counts = F.transform(
        F.sequence(F.lit(0), F.lit(BLOCKS - 1)),
        lambda b: F.coalesce(F.try_element_at("blocks", b.cast("bigint")), F.lit(0)).cast("int"),
    )
    core = core.filter(F.col("core") * 100 >= F.col("n_shingles") * percent).withColumn("blocks", counts)
    core = common.stored(core, "core")
    alive = members.join(core.select("rep", "n_shingles", "core", "reach"), "rep")
    for _ in range(2):
        sizes = alive.groupBy("key").agg(
            F.min("n_shingles").alias("least"), F.max("reach").alias("most"), F.count("*").alias("held")
        )
        alive = (
            alive.join(sizes, "key")
            .filter((F.col("held") > 1) & (F.col("reach") >= F.col("least")) & (F.col("most") >= F.col("n_shingles")))
            .drop("least", "most", "held")
        )
    alive = common.stored(alive, "alive")
    best = F.max(F.struct("reach", (-F.col("rep")).alias("back"), "n_shingles")).alias("best")
    lead = alive.groupBy("key").agg(best).select(
        "key", (-F.col("best.back")).alias("lead"), F.col("best.n_shingles").alias("lead_n"), F.col("best.reach").alias("lead_reach")
    )
    star = (
        alive.join(lead, "key")
        .filter((F.col("lead") != F.col("rep")) & (F.col("lead_n") <= F.col("reach")) & (F.col("n_shingles") <= F.col("lead_reach")))
        .select(F.least("lead", "rep").alias("u"), F.greatest("lead", "rep").alias("v"))
        .distinct()
    )
    star = common.stored(verified(star, sets, percent), "star")
    linked = star.filter("linked").select("u", "v")
    parts = components(linked)
    label = F.coalesce(F.col("component"), F.col("rep"))
    held = core.join(alive.select("rep").distinct(), "rep", "left_semi")
    held = held.join(parts.withColumnRenamed("id", "rep"), "rep", "left").withColumn("component", label)
    # Whoever shares a table shares a half-band of the first collection: a bucket for each to look into, not for each table.
    spread = held.select("*", F.posexplode("a").alias("i", "half")).withColumn("key", F.xxhash64("i", "half"))
    mixed = spread.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo != hi")
    spread = spread.join(mixed.select("key"), "key")
    x, y = spread.alias("x"), spread.alias("y")
    before = [(F.col("x.i") > k) & (F.get(F.col("x.a"), F.lit(k)) == F.get(F.col("y.a"), F.lit(k))) for k in range(tables - 1)]
    most = F.aggregate(F.zip_with("x.blocks", "y.blocks", lambda p, q: F.least(p, q)), F.lit(0), lambda total, k: total + k)
    across = x.join(
        y,
        (F.col("x.key") == F.col("y.key"))
        & (F.col("x.rep") < F.col("y.rep"))
        & (F.col("x.component") != F.col("y.component"))
        & (F.col("x.n_shingles") <= F.col("y.reach"))
        & (F.col("y.n_shingles") <= F.col("x.reach"))
        & ~reduce(Column.__or__, before)
        & (most * (100 + percent) >= (F.col("x.n_shingles") + F.col("y.n_shingles")) * percent),
    ).select(F.col("x.rep").alias("u"), F.col("y.rep").alias("v"))
    across = across.join(star.select("u", "v"), ["u", "v"], "left_anti")
    return linked.unionByName(verified(across, sets, percent).filter("linked").select("u", "v"))


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """u, v, and whether 100 * intersection >= percent * union on the full sets."""
    left = sets.select(F.col("rep").alias("u"), F.col("shingles").alias("su"))
    right = sets.select(F.col("rep").alias("v"), F.col("shingles").alias("sv"))
    both = pairs.join(left, "u").join(right, "v")
    shared = F.size(F.array_intersect("su", "sv"))
    union = F.size("su") + F.size("sv") - shared
    return both.select("u", "v", (shared * 100 >= union * percent).alias("linked"))


def repeated(documents: DataFrame) -> bool:
    """Whether an id occurs twice; a class's set may then be read from several rows."""
    return not documents.groupBy("doc_id").count().filter("count > 1").isEmpty()


def near_duplicates(documents: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """Of every document: doc_id, n_shingles, component_id (the smallest id of its component) and kept.

    Kept are documents whose id is the component's. ``class`` tells apart components of one smallest id (null:
    linked with nothing and without words), ``text_hash`` rows of one id.
    """
    tables = tables_for(percent)
    rows = common.stored(sketches(documents, size, tables), "sketches")
    key = ["n_shingles", "mark_a", "mark_b"]
    classes = (
        rows.filter("n_shingles > 0")
        .groupBy(*key)
        .agg(F.min("doc_id").alias("doc"), F.first("a").alias("a"), F.first("b").alias("b"))
        .filter("doc is not null")
    )
    # Numbers are given once, when the table is written.
    classes = common.stored(classes.withColumn("rep", F.monotonically_increasing_id()), "classes")
    parts = components(links(documents, classes, size, percent, tables)).withColumnRenamed("id", "rep")
    parts = classes.select("rep", "doc").join(parts, "rep")
    least = parts.groupBy("component").agg(F.min("doc").alias("component_id"))
    parts = parts.select("rep", "component").join(least, "component")
    of_class = classes.join(parts, "rep", "left").select(
        *key, F.coalesce("component", "rep").alias("class"), F.coalesce("component_id", "doc").alias("component_id")
    )
    joined = rows.select("doc_id", "text_hash", *key).join(of_class, key, "left")
    component = F.coalesce("component_id", "doc_id")
    return joined.select(
        "doc_id",
        "n_shingles",
        F.when(F.col("n_shingles") > 0, component).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(F.col("n_shingles") > 0, component.eqNullSafe(F.col("doc_id"))).otherwise(True).alias("kept"),
        "class",
        "text_hash",
    )
