"""Toxicity score: a character n-gram linear classifier on naive Bayes log-count ratios.

Features are the hashed n-grams of characters (code points, A-Z lower-cased) that a text has, each scaled by
the log ratio of how often documents of either class have it; a logistic regression is fitted on the scaled features.
Features whose ratio is within ``SIGMAS`` standard errors of zero are left out, so words that both classes
use weigh nothing however long the text; all others are used.

Counting runs on Spark over the labelled rows: per task into two arrays, then summed per bucket. The fit is
Spark's on sparse rows, which are never gathered. The rows
are at most ``PER_CLASS`` of each class, taken in the order of a hash of the id; the intercept is then moved
to the class shares among all labelled rows. Weights (one array of ``BUCKETS`` floats) go to all tasks;
scoring reads whole texts and is one pass without a shuffle.

Defined cases: null and empty texts score the intercept; a document labelled twice counts by each label;
null labels are no labels; without rows of both classes every score is the share of toxic labels (0 if
there are none); other columns, among them any labels in the documents, are never features.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from geoloom import session
from geoloom.llm import common, wordhash

BUCKET_BITS = 20
BUCKETS = 1 << BUCKET_BITS
GRAMS = (4, 5, 6)
#: Bound of the sample of labelled rows, of each class.
PER_CLASS = 20_000
SIGMAS = 3.0
LEAST_DOCUMENTS = 5
SMOOTHING = 1.0
RIDGE = 1e-4
STEPS = 500
PIECE_BYTES = 1 << 16
#: Size of the row groups of the rows to fit on.
GROUP_BYTES = 1 << 20
#: Tasks of a step of the fit, whose rows are bounded: the gradients of so few go to the driver without a shuffle.
FIT_TASKS = 5


class Model(NamedTuple):
    """``weights`` by bucket, those of features not used being 0."""

    weights: np.ndarray
    intercept: float


def grams(data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n-gram size: row and bucket of every run of that many characters (code points) of a text."""
    sums = wordhash.prefix_sums(wordhash.ASCII_LOWER[data])
    starts = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))  # where each character begins
    row_of = np.repeat(np.arange(len(bounds) - 1), np.diff(np.searchsorted(starts[:-1], bounds)))
    for n in GRAMS:
        inside = np.flatnonzero(row_of[: max(len(starts) - n, 0)] == row_of[n - 1 :])  # none runs into the next text
        hashed = wordhash.mix(wordhash.between(sums, starts[inside], starts[inside + n]) + np.uint64(n))
        yield row_of[inside], (hashed >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def features(data: np.ndarray, bounds: np.ndarray, used: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Row and bucket of every distinct feature of every text, of the used ones if given."""
    pairs = []
    for row, bucket in grams(data, bounds):
        if used is not None:
            keep = np.flatnonzero(used[bucket])
            row, bucket = row[keep], bucket[keep]
        pairs.append(row << BUCKET_BITS | bucket)
    pairs = np.unique(np.concatenate(pairs))
    return pairs >> BUCKET_BITS, pairs & (BUCKETS - 1)


def _counts(labelled: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Number of documents that have a feature, by class and bucket, and number of documents by class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, BUCKETS + 1), np.int64)  # the last cell counts the documents
        with np.errstate(over="ignore"):
            for batch in common.slices(batches, "text", PIECE_BYTES):
                label = batch.column("label").to_numpy()
                row, bucket = features(*wordhash.flat(batch.column("text")))
                np.add.at(total, (label[row], bucket), 1)
                total[:, BUCKETS] += np.bincount(label, minlength=2)
        at = np.flatnonzero(total.any(axis=0))
        for a in range(0, len(at), 65_536):
            part = at[a : a + 65_536]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part), pa.array(total[0, part]), pa.array(total[1, part])], names=["bucket", "clean", "toxic"]
            )

    parts = labelled.mapInArrow(run, "bucket bigint, clean bigint, toxic bigint")
    sums = parts.groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).toArrow()
    counts = np.zeros((2, BUCKETS + 1), np.float64)
    for k, name in enumerate(("clean", "toxic")):
        counts[k, sums.column("bucket").to_numpy()] = sums.column(name).to_numpy()
    return counts[:, :BUCKETS], counts[:, BUCKETS]


def _ratios(counts: np.ndarray, documents: np.ndarray) -> np.ndarray:
    """Log ratio of the shares of documents that have a feature; 0 where it may be chance."""
    smooth = counts + SMOOTHING
    share = smooth / (documents[:, None] + 2 * SMOOTHING)
    ratio = np.log(share[1] / share[0])
    error = np.sqrt(1 / smooth[0] + 1 / smooth[1])
    telling = (counts.sum(axis=0) >= LEAST_DOCUMENTS) & (np.abs(ratio) > SIGMAS * error)
    return np.where(telling, ratio, 0.0)


def _fit(labelled: DataFrame, ratios: np.ndarray) -> tuple[np.ndarray, float]:
    """Weight of each used bucket, in their order, and intercept; classes weigh as they occur."""
    spark = labelled.sparkSession
    used = np.flatnonzero(ratios)
    shared = spark.sparkContext.broadcast((used, ratios[used]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, scale = shared.value
        wanted = np.zeros(BUCKETS, bool)
        wanted[at] = True
        with np.errstate(over="ignore"):
            for batch in common.slices(batches, "text", PIECE_BYTES):
                n = batch.num_rows
                row, bucket = features(*wordhash.flat(batch.column("text")), wanted)
                ends = pa.array(np.searchsorted(row, np.arange(n + 1)).astype(np.int32))
                place = np.searchsorted(at, bucket)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("label").cast(pa.float64()),
                        pa.array(np.zeros(n, np.int8)),
                        pa.array(np.full(n, len(at), np.int32)),
                        pa.ListArray.from_arrays(ends, pa.array(place.astype(np.int32))),
                        pa.ListArray.from_arrays(ends, pa.array(scale[place])),
                    ],
                    names=["label", "type", "size", "indices", "values"],
                )

    parts = "type tinyint, size int, indices array<int>, values array<double>"
    rows = labelled.select("text", "label").mapInArrow(run, f"label double, {parts}")
    # A vector is stored as the struct of these fields, so it is read back as a vector.
    # Small row groups bound what a task holds of the nested columns, when it writes and when it reads them.
    path = session.new_path(spark, "gram-rows")
    rows = rows.select("label", F.struct("type", "size", "indices", "values").alias("features"))
    rows.write.option("parquet.block.size", GROUP_BYTES).parquet(path)
    schema = StructType([StructField("label", DoubleType()), StructField("features", VectorUDT())])
    fitted = LogisticRegression(
        family="binomial", regParam=RIDGE, elasticNetParam=0.0, maxIter=STEPS, standardization=False
    ).fit(spark.read.schema(schema).parquet(path).coalesce(FIT_TASKS))
    session.discard(spark, path)
    return fitted.coefficients.toArray(), fitted.intercept


def sample(labels: DataFrame, allowed: Column) -> tuple[DataFrame, float]:
    """doc_id and label of the rows to learn from, and the share of toxic ones among all allowed rows."""
    known = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & allowed)
    known = known.select("doc_id", F.col("toxic").cast("int").alias("label"))
    share = known.agg(F.avg("label")).first()[0] or 0.0
    order = [F.xxhash64("doc_id"), "doc_id"]
    parts = [known.filter(F.col("label") == k).orderBy(*order).limit(PER_CLASS) for k in (0, 1)]
    return parts[0].unionByName(parts[1]), share


def train(documents: DataFrame, labels: DataFrame, allowed: Column) -> Model:
    """Fit on the labelled documents for which ``allowed`` (an expression on doc_id) holds."""
    chosen, share = sample(labels, allowed)
    # At most 2 * PER_CLASS ids.
    labelled = common.stored(documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"), "labelled")
    counts, sizes = _counts(labelled.select("text", "label"))
    if not sizes.all():
        share = min(max(share, 1e-9), 1 - 1e-9)
        return Model(np.zeros(BUCKETS, np.float32), float(np.log(share / (1 - share))))
    ratios = _ratios(counts, sizes)
    at = np.flatnonzero(ratios)
    weights, bias = np.zeros(BUCKETS, np.float32), float(np.log(sizes[1] / sizes[0]))
    if len(at):
        weight, bias = _fit(labelled, ratios)
        weights[at] = weight * ratios[at]
    shift = np.log(share / (1 - share)) - np.log(sizes[1] / sizes[0])
    return Model(weights, float(bias + shift))


def score(documents: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The documents with ``score``, the probability of label 1."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in documents.columns if c != "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, intercept = shared.value
        used = weights != 0
        with np.errstate(over="ignore"):
            for batch in common.slices(batches, text, PIECE_BYTES):
                row, bucket = features(*wordhash.flat(batch.column(text)), used)
                margin = np.bincount(row, weights[bucket], minlength=batch.num_rows) + intercept
                scores = 1 / (1 + np.exp(-np.clip(margin, -500, 500)))
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(scores)], names=[*kept, "score"])

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema.fields if f.name in kept)
    return documents.select(*kept).mapInArrow(run, f"{types}, score double")


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1
