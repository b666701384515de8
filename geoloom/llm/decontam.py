"""Benchmark passages in documents, found by winnowed word fingerprints.

Both sides keep, of every ten consecutive words, the smallest hash of a five-word gram. Two texts that
share ten words share the ten words' smallest gram hash, so a join on kept hashes finds every shared
span. A hit is then extended: the words themselves are compared around it.

Everything is DataFrame expressions. Items shorter than a window are one window of their own length;
only if the benchmark has such items do documents also produce grams of those (at most nine) lengths.

Defined cases: texts are used whole, however long; a null text or id counts as a text without words or as an id like any other; rows that
repeat id and text are counted once and returned as often as they occur; an empty benchmark leaves all
documents clean; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.llm import common

WINDOW = 10
GRAM = 5
#: A benchmark of at most this many bytes of text is sent to every task; a larger one is shuffled.
BROADCAST_BYTES = 2 << 20
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of a text; null has none. Only the ends of the split can be empty."""
    return F.filter(F.split(common.lower_ascii(F.coalesce(text, F.lit(""))), SEPARATORS), lambda w: w != "")


def grams(column: Column, length: int, salt: int = 0) -> Column:
    """Hash of every ``length`` consecutive words, by position."""
    last = F.size(column) - length
    hashed = F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.xxhash64(*([F.lit(salt)] if salt else []), *[F.get(column, i + k) for k in range(length)]),
    )
    return F.when(last >= 0, hashed).otherwise(F.array().cast("array<bigint>"))


def winnowed(hashes: Column) -> Column:
    """Smallest gram hash of every window, by window position."""
    width = WINDOW - GRAM + 1
    last = F.size(hashes) - width
    smallest = F.transform(
        F.sequence(F.lit(0), last), lambda i: F.least(*[F.get(hashes, i + k) for k in range(width)])
    )
    return F.when(last >= 0, smallest).otherwise(F.array().cast("array<bigint>"))


def windows(benchmark: DataFrame) -> tuple[DataFrame, list[int]]:
    """Fingerprints of the benchmark (fp, item_id, item_words, at, length), and the lengths of short items.

    ``item_words`` are the words of the item around the fingerprint that a window with it can have, so what a
    fingerprint carries does not grow with its item.
    """
    items = benchmark.select("item_id", words(F.col("text")).alias("item_words")).filter(F.size("item_words") > 0)
    short = items.filter(F.size("item_words") < WINDOW)
    lengths = sorted(r[0] for r in short.select(F.size("item_words")).distinct().collect())
    hashed = items.filter(F.size("item_words") >= WINDOW).withColumn("g", grams(F.col("item_words"), GRAM))
    width = WINDOW - GRAM + 1
    prints = hashed.withColumn("m", winnowed(F.col("g"))).select(
        "item_id",
        "item_words",
        F.explode(
            F.array_distinct(
                F.transform(
                    "m",
                    lambda v, i: F.struct(
                        v.alias("fp"),
                        (i + F.array_position(F.slice(F.col("g"), i + 1, width), v).cast("int") - 1).alias("at"),
                    ),
                )
            )
        ).alias("p"),
    )
    first = F.greatest(F.col("p.at") - (WINDOW - GRAM), F.lit(0))
    around = F.slice("item_words", first + 1, F.col("p.at") + WINDOW - first)
    found = prints.select("p.fp", "item_id", around.alias("item_words"), (F.col("p.at") - first).alias("at"), F.lit(WINDOW).alias("length"))
    for n in lengths:
        whole = short.filter(F.size("item_words") == n)
        found = found.unionByName(
            whole.select(
                grams(F.col("item_words"), n, salt=n)[0].alias("fp"),
                "item_id",
                "item_words",
                F.lit(0).alias("at"),
                F.lit(n).alias("length"),
            )
        )
    return found, lengths


def _starts(lengths: list[int]) -> Column:
    """Where a window of the item begins in the document, around one shared fingerprint."""
    here = F.filter(F.sequence(F.lit(0), F.size("g") - 1), lambda i: F.get(F.col("g"), i) == F.col("fp"))
    first = F.greatest(F.lit(0), F.col("at") - (WINDOW - GRAM))
    last = F.least(F.col("at"), F.size("item_words") - WINDOW)
    begins = F.transform(F.sequence(first, last), lambda j: j)
    pairs = F.flatten(
        F.transform(
            here, lambda i: F.transform(begins, lambda j: F.struct((i - F.col("at") + j).alias("i"), j.alias("j")))
        )
    )
    held = F.filter(
        pairs,
        lambda p: (p["i"] >= 0)
        & (p["i"] <= F.size("w") - WINDOW)
        & (F.slice(F.col("w"), F.greatest(p["i"], F.lit(0)) + 1, WINDOW) == F.slice(F.col("item_words"), p["j"] + 1, WINDOW)),
    )
    long = F.when((F.size("g") > 0) & (last >= first), F.transform(held, lambda p: p["i"]))
    if not lengths:
        return long
    whole = F.filter(
        F.sequence(F.lit(0), F.greatest(F.size("w") - F.col("length"), F.lit(0))),
        lambda i: F.slice(F.col("w"), i + 1, F.col("length")) == F.col("item_words"),
    )
    return F.when(F.col("length") < WINDOW, whole).otherwise(long)


def contamination(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, text_hash, n_words, spans (start and length in words) and items of every document."""
    found, lengths = windows(benchmark)
    docs = documents.select(
        "doc_id", F.xxhash64("text").alias("text_hash"), words(F.col("text")).alias("w")
    ).withColumn("g", grams(F.col("w"), GRAM))
    prints = [winnowed(F.col("g")), *[grams(F.col("w"), n, salt=n) for n in lengths]]
    prints = F.array_distinct(F.flatten(F.array(*prints)) if lengths else prints[0])
    size = benchmark.select(F.sum(F.octet_length("text"))).first()[0] or 0
    if size <= BROADCAST_BYTES:
        # Each document also meets the one row without a fingerprint, so none is lost in the join.
        none = documents.sparkSession.range(1).select(
            *[F.lit(None).cast(f.dataType).alias(f.name) for f in found.schema.fields]
        )
        mine = docs.withColumn("mine", F.explode(F.concat(F.array(F.lit(None).cast("bigint")), prints)))
        hits = mine.join(F.broadcast(found.unionByName(none)), F.col("mine").eqNullSafe(F.col("fp")))
        copies = F.sum(F.when(F.col("fp").isNull(), 1))
    else:
        sent = docs.select("doc_id", "text_hash", F.explode(prints).alias("fp"))
        met = sent.join(found, "fp").distinct()
        met = met.withColumnsRenamed({"doc_id": "met_id", "text_hash": "met_hash"})
        same = F.col("doc_id").eqNullSafe(F.col("met_id")) & (F.col("text_hash") == F.col("met_hash"))
        hits = docs.withColumn("row", F.monotonically_increasing_id()).join(met, same, "left")
        copies = F.count_distinct("row")
    spans = F.when(
        F.col("fp").isNotNull(),
        F.transform(_starts(lengths), lambda s: F.struct(s.alias("start"), F.col("length").alias("length"))),
    )
    hits = hits.withColumn("spans", spans)
    item = F.when(F.size("spans") > 0, F.coalesce(F.col("item_id").cast("string"), F.lit("")))
    grouped = hits.groupBy("doc_id", "text_hash").agg(
        F.max(F.size("w")).cast("bigint").alias("n_words"),
        copies.alias("copies"),
        F.array_distinct(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.collect_set(item)).alias("items"),
    )
    return grouped.select(
        "doc_id", "text_hash", "n_words", "spans", "items", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    ).drop("col")


def hit_words(spans: Column) -> Column:
    """Number of different words covered."""
    return F.size(
        F.array_distinct(
            F.flatten(F.transform(spans, lambda s: F.sequence(s["start"], s["start"] + s["length"] - 1)))
        )
    )
