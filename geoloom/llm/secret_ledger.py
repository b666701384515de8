"""Secret scan over a ledger of content-addressed blobs.

Every version of a file is addressed by the SHA-256 of its text. The ledger (Parquet, append-only) holds
for each blob the rules it has been scanned with, as ``name@version``, and what they found. A scan reads
the ledger, scans only (blob, rule version) pairs that are missing, each blob once however many paths and
versions carry it, appends the result, and joins the findings back to all paths.

DataFrame expressions only. Positions come from splitting the text at the matches: a match begins after
all pieces and matches before it. Lengths are in code points.

Defined cases: a null text is the empty text; the empty text has no findings; texts are scanned whole, however
long; spans that begin together come in the order of the rules; repeated rows get the blob's findings each; an
entry of a rule version that is not asked for stays in the ledger and out of the result; an empty table gives an empty result; other columns ride along untouched, except that
columns named ``blob`` or ``found`` are replaced.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom import session


class Rule(NamedTuple):
    """``pattern`` finds leftmost matches; those whose ``group`` has under ``least`` characters are dropped."""

    name: str
    version: int
    pattern: str
    group: int
    least: int

    @property
    def id(self) -> str:
        return f"{self.name}@{self.version}"


def either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c.lower()}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(map(either_case, ["password", "passwd", "secret", "token", "api_?key"]))
ASSIGN = Rule("assign", 1, f"({_NAMES})[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 8)
ACCESS = Rule("access", 1, "AKIA[A-Z0-9]+", 0, 16)
HEX = Rule("hex", 1, "[0-9a-f]{32,}", 0, 32)  # a run of 32 or more, found without stopping at shorter ones
PEM = Rule("pem", 1, "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1)
FORGE = Rule("forge", 1, "gh[pousr]_[A-Za-z0-9]{36,}", 0, 40)
BASE = (ASSIGN, ACCESS, HEX)
RULES = (*BASE, PEM, FORGE)

SALTS = 16
BLOCK = 128
FOUND = "array<struct<start:int,rank:int,kind:string,end:int>>"


def matches(text: Column, rule: Rule, rank: int) -> Column:
    """Spans of a rule in a text, by position."""
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    judged = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    gaps = F.split(text, rule.pattern, -1)  # one more than matches
    sizes = F.zip_with(gaps, whole, lambda g, w: F.struct(F.length(g).alias("gap"), F.coalesce(F.length(w), F.lit(0)).alias("size")))

    # Positions are running sums, taken block by block, so no array grows by more than a block a step.
    def running(blocks, total):
        start = F.struct(F.lit(0).alias("at"), F.array(F.lit(0)).alias("sums"))
        step = lambda s, x: F.struct((s["at"] + total(x)).alias("at"), F.concat(s["sums"], F.array(s["at"] + total(x))).alias("sums"))
        return F.aggregate(blocks, start, step, lambda s: s["sums"])

    add = lambda x: x["gap"] + x["size"]
    last = F.greatest(F.ceil(F.size(sizes) / BLOCK), F.lit(1)).cast("int") - 1
    blocks = F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(sizes, b * BLOCK + 1, BLOCK))
    ends = F.transform(blocks, lambda block: F.struct(block.alias("block"), running(block, add).alias("sums")))
    offsets = running(ends, lambda e: F.element_at(e["sums"], -1))

    def spans(e, offset):
        return F.transform(
            e["block"],
            lambda x, i: F.struct(
                (offset + F.get(e["sums"], i) + x["gap"]).alias("start"),
                F.lit(rank).alias("rank"),
                F.lit(rule.id).alias("kind"),
                (offset + F.get(e["sums"], i) + add(x)).alias("end"),
            ),
        )

    located = F.flatten(F.zip_with(ends, F.slice(offsets, 1, F.size(ends)), spans))
    long = F.zip_with(located, judged, lambda span, j: F.struct(span.alias("span"), (F.length(j) >= rule.least).alias("kept")))
    kept = F.transform(F.filter(long, lambda x: x["kept"]), lambda x: x["span"])
    return F.when(text.rlike(rule.pattern), kept).otherwise(F.array()).cast(FOUND)


def entries(spark: SparkSession, ledger: str) -> DataFrame | None:
    """What the ledger holds; None before the first scan."""
    try:
        return spark.read.schema(f"blob binary, rules array<string>, found {FOUND}").parquet(ledger)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def scan(versions: DataFrame, ledger: str, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``versions`` without the text, with ``blob`` and ``found``; the ledger at that path gains what was new.

    Paths are dealt by row number, so a table that is recomputed differently must not be passed: read it from
    storage or store it first.
    """
    spark = versions.sparkSession
    content = F.coalesce(F.col(text), F.lit(""))
    address = F.unhex(F.sha2(content, 256))
    blobs = versions.select(address.alias("blob"), content.alias("content")).dropDuplicates(["blob"])
    every = F.array(*[F.lit(r.id) for r in rules])
    known = entries(spark, ledger)
    if known is None:
        todo = blobs.withColumn("todo", every)
    else:
        done = known.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("done"))
        left = F.array_except(every, F.coalesce(F.col("done"), F.array().cast("array<string>")))
        todo = blobs.join(done, "blob", "left").withColumn("todo", left).filter(F.size("todo") > 0)
    spans = [
        F.when(F.array_contains("todo", r.id), matches(F.col("content"), r, rank)).otherwise(F.array().cast(FOUND))
        for rank, r in enumerate(rules)
    ]
    new = todo.select("blob", F.col("todo").alias("rules"), F.array_sort(F.concat(*spans)).alias("found"))
    new.write.mode("append").parquet(ledger)
    # The ledger names rule versions; spans of other versions than those asked for stay behind.
    wanted = F.transform(
        F.filter("found", lambda f: f["kind"].isin([r.id for r in rules])),
        lambda f: f.withField("kind", F.substring_index(f["kind"], "@", 1)),
    )
    found = (
        entries(spark, ledger)
        .filter(F.arrays_overlap("rules", every))
        .select("blob", wanted.alias("found"))
        .groupBy("blob")
        .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("found")))).alias("found"))
    )
    # A blob may have any share of all paths: they are dealt over SALTS keys, and so are its findings.
    salted = found.filter(F.size("found") > 0).select(
        F.col("blob").alias("of"), "found", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    )
    others = [c for c in versions.columns if c not in (text, "blob", "found")]
    paths = versions.select(*others, address.alias("blob"), F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).alias("dealt"))
    joined = paths.join(salted, (F.col("blob") == F.col("of")) & (F.col("dealt") == F.col("salt")), "left")
    return joined.select(*others, "blob", F.coalesce("found", F.array().cast(FOUND)).alias("found"))


def digest(found: Column) -> Column:
    """``kind:start:end`` of the spans, comma-joined."""
    return F.array_join(F.transform(found, lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"])), ",")


def of_kind(found: Column, *kinds: str) -> Column:
    return F.filter(found, lambda f: f["kind"].isin(*kinds))


def masked(text: Column, found: Column, mask: str = "*") -> Column:
    """The text with every found character replaced; overlapping spans count once."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state, f):
        begin = F.greatest(f["start"], state["at"])
        size = F.greatest(f["end"] - begin, F.lit(0))
        kept = F.substr(text, state["at"] + 1, F.greatest(begin - state["at"], F.lit(0)))
        return F.struct(
            F.greatest(state["at"], f["end"]).alias("at"),
            F.concat(state["out"], kept, F.repeat(F.lit(mask), size)).alias("out"),
        )

    joined = F.aggregate(found, start, step, lambda s: F.concat(s["out"], F.substr(text, s["at"] + 1)))
    return F.when(F.size(found) > 0, joined).otherwise(text)


def new_ledger(spark: SparkSession) -> str:
    return session.new_path(spark, "ledger")
