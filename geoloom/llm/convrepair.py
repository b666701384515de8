"""Conversation structure repair over a suffix-shared automaton of role and fault signatures.

A conversation's signature has one letter per turn: the role's initial (``s``, ``u``, ``a``, else ``o``; in
capitals if the turn is truncated), or ``d`` for a turn that must go (blank, or role and text seen before).
Turns are kept (cost 0), given the role user or assistant (2), deleted (3) or inserted without text (2) until
the roles read ``(s?(ua)+)?``; a truncated turn that is not deleted costs 1 more. Among the cheapest repairs
the one whose audit (the initials of its edits) is least in ASCII is taken.

What a repair of the rest of a conversation costs depends on that rest and on the state of the grammar alone,
so signatures are minimised from the end: a node of the automaton is a distinct rest of any signature. Its
cost-to-go and best edit are computed once for each of the four states and serve all conversations that end
alike. Signatures are made distinct and cut from the end into at most ``LEVELS`` pieces; the nodes of a level,
distinct by what follows them, are sorted by their reversed letters, so that a walk with the current path of
nodes meets every shared one once, and the next level continues from the costs found.

Edits at one node differ in their letter, so the least letter among the cheapest decides; no audits are compared.

No conversation is gathered: its turns are numbered by ranges (as many as there are partitions), signatures
hold a byte a turn, and edits return to the turns by a join on their number. The SHA-256 of a repaired text
alone is bound to one task per conversation, since the hash is sequential; it reads the sorted turns as a
stream and holds one batch of them.

Defined cases: null role and text are one space, roles count by their first letter; a null conv_id is a
conversation like any other; turns come in the order of turn (null first), role and the text's MD5, so rows
repeated in the input follow one another; equality of texts is that of role and SHA-256; a conversation without
turns needs no edit; an empty table gives an empty result; other columns are ignored; texts are used whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geoloom.llm import common

#: Characters that are blank, and those that end a whole text.
BLANK = r"\x20\x09-\x0D"
ENDING = ".!?"

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
PIECE, LEVELS = 64, 16
#: States of the grammar: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
#: Cost and script of what is still due at the end of a conversation, by state.
END_COSTS, END_SCRIPTS = [0, 2 * INSERT, INSERT, 0], ["", "ua", "a", ""]
#: Scripts spell edits out: K keep, D delete, U and A new role, u and a insert. Audits have their initials.
TO_AUDIT = ("uaUA", "IIRR")


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, copies) with faults put in by the CRC-32 of ``conv_id:turn``, modulo 20."""
    space = F.lit(" ")
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")])
    fault = F.crc32(key.cast("binary")) % 20
    text = F.coalesce("text", space)
    rows = conversations.select("conv_id", "turn", "role", text.alias("text"), fault.alias("fault")).filter("fault != 0")
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", f"[{ENDING}]", "")).otherwise(F.col("text"))
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("fault") == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
        text.alias("text"),
        F.when(F.col("fault") == 3, 2).otherwise(1).alias("copies"),
    )


def _prepared(turns: DataFrame) -> DataFrame:
    copies = F.col("copies") if "copies" in turns.columns else F.lit(1)
    space = F.lit(" ")
    return turns.select(
        "conv_id",
        "turn",
        F.coalesce("role", space).alias("role"),
        F.coalesce("text", space).alias("text"),
        copies.alias("copies"),
    ).withColumn("mark", F.sha2("text", 256))


def _same(a: str, b: str, columns: list[str]) -> Column:
    same = F.lit(True)
    for c in columns:
        same = same & F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
    return same


def diagnosed(turns: DataFrame) -> DataFrame:
    """Light rows, one per turn: conv_id, turn, role, mark, part, pos, initial, fault (first of its faults)."""
    spark = turns.sparkSession
    rows = _prepared(turns).select(
        "conv_id",
        "turn",
        "role",
        "mark",
        F.md5("text").alias("tie"),
        (~F.col("text").rlike(f"[^{BLANK}]")).alias("blank"),
        (~F.col("text").rlike(f"[{ENDING}][{BLANK}]*\\z")).alias("truncated"),
        F.explode(F.array_repeat(F.lit(0), F.col("copies"))).alias("copy"),
    ).drop("copy")
    order = ["conv_id", "turn", "role", "tie"]
    dealt = rows.repartitionByRange(common.partitions(spark), *order, F.rand(17)).sortWithinPartitions(*order)
    number = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    dealt = common.stored(dealt.withColumn("part", F.spark_partition_id()).withColumn("pos", number), "turns")
    same = ["conv_id", "role", "mark"]
    seen = dealt.filter(~F.col("blank")).groupBy(*same).agg(F.count("*").alias("n"), F.min(F.struct("part", "pos")).alias("first"))
    seen = seen.filter("n > 1").drop("n")
    place = F.struct("x.part", "x.pos")
    joined = dealt.alias("x").join(seen.alias("y"), _same("x", "y", same), "left")
    repeated = F.col("y.first").isNotNull() & (F.col("y.first") != place)
    fault = F.when(F.col("x.blank"), "blank").when(repeated, "duplicate").when(F.col("x.truncated"), "truncated")
    initial = F.substring("x.role", 1, 1)
    return joined.select(
        *[f"x.{c}" for c in ("conv_id", "turn", "role", "mark", "part", "pos")], initial.alias("initial"), fault.alias("fault")
    )


def _letter() -> Column:
    known = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("o")
    gone = F.col("fault").isin("blank", "duplicate")
    return F.when(gone, "d").when(F.col("fault") == "truncated", F.upper(known)).otherwise(known)


def summaries(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per conversation: counts of faults, gaps, illegal pairs and signature; and per range its turns before."""
    here = Window.partitionBy("conv_id", "part").orderBy("pos")
    pair = F.concat("before", "initial")
    marked = rows.select(
        "conv_id",
        "part",
        "pos",
        "turn",
        "initial",
        "fault",
        _letter().alias("letter"),
        F.lag("initial").over(here).alias("before"),
        F.lag("turn").over(here).alias("turn_before"),
    )
    count = [F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")]
    new = F.col("turn").isNotNull() & ~F.col("turn").eqNullSafe(F.col("turn_before"))
    chunks = marked.groupBy("conv_id", "part").agg(
        *count,
        F.count_if(F.col("before").isNotNull() & ~pair.isin("su", "ua", "au")).alias("illegal"),
        F.count_if(new).alias("turns"),
        F.min("turn").alias("least"),
        F.max("turn").alias("most"),
        F.count("*").alias("rows"),
        F.min("pos").alias("first_pos"),
        F.min_by("initial", "pos").alias("first"),
        F.max_by("initial", "pos").alias("last"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "letter"))), lambda x: x["letter"]), "").alias("letters"),
    )
    ahead = Window.partitionBy("conv_id").orderBy("part")
    chunks = chunks.withColumn("last_before", F.lag("last").over(ahead)).withColumn("most_before", F.lag("most").over(ahead))
    chunks = chunks.withColumn("rows_before", F.coalesce(F.sum("rows").over(ahead.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    chunks = common.stored(chunks, "chunks")
    broken = F.col("last_before").isNotNull() & ~F.concat("last_before", "first").isin("su", "ua", "au")
    shared = F.coalesce(F.col("least") == F.col("most_before"), F.lit(False))  # a turn on both sides of a border
    gaps = F.coalesce(F.max("most") - F.min("least") + 1 - F.sum(F.col("turns") - shared.cast("int")), F.lit(0))
    whole = F.array_sort(F.collect_list(F.struct("part", "letters")))
    per = chunks.groupBy("conv_id").agg(
        gaps.alias("gaps"),
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")],
        F.sum(F.col("illegal") + broken.cast("int")).alias("illegal"),
        F.array_join(F.transform(whole, lambda x: x["letters"]), "").alias("signature"),
    )
    return per, chunks.select("conv_id", "part", "first_pos", "rows_before")


class Walk:
    """Costs-to-go and best edits of nodes, along the current path from the end of a piece."""

    def __init__(self):
        self.known = {}
        self.after, self.path, self.letters = object(), [], ""  # no node is after this one

    def step(self, letter: str, costs: tuple) -> tuple:
        """Costs by state before a turn, and by state the script and the next state of the best edit."""
        if (letter, costs) not in self.known:
            late = TRUNCATED if letter.isupper() else 0
            role, made = letter.lower(), []
            for state in range(4):
                due, script = (ASSISTANT, "A") if state == USER else (USER, "U")
                options = [(costs[state] + DELETE, "D", "D", state)]
                if role != "d":
                    fits = due if role == script.lower() else SYSTEM if role == "s" and state == START else None
                    if fits is not None:
                        options.append((costs[fits] + KEEP + late, "K", "K", fits))
                    options.append((costs[due] + REROLE + late, "R", script, due))
                made.append(min(options))
            # Inserting leads to another state before the same turn; two in a row reach every state.
            for _ in range(2):
                for state in range(4):
                    due, script = (ASSISTANT, "a") if state == USER else (USER, "u")
                    made[state] = min(made[state], (made[due][0] + INSERT, "I", script, due))
            least = min(m[0] for m in made)
            self.known[letter, costs] = tuple(m[0] - least for m in made), least, tuple((m[2], m[3]) for m in made)
        return self.known[letter, costs]

    def solve(self, after: str | None, end: list[int], reversed_letters: str) -> tuple[list, list, list]:
        """Costs, scripts and states at the end of the piece, by the state before it."""
        if after != self.after:
            low = min(end)
            self.after, self.letters, self.path = after, "", [(tuple(c - low for c in end), low, None)]
        shared = len(commonprefix((self.letters, reversed_letters)))
        del self.path[shared + 1 :]
        for letter in reversed_letters[shared:]:
            costs, total, _ = self.path[-1]
            less, least, edits = self.step(letter, costs)
            self.path.append((less, total + least, edits))
        self.letters = reversed_letters
        scripts, states = [], []
        for state in range(4):
            script = []
            for _, _, edits in self.path[:0:-1]:
                while edits[state][0] in "ua":
                    script.append(edits[state][0])
                    state = edits[state][1]
                script.append(edits[state][0])
                state = edits[state][1]
            scripts.append("".join(script))
            states.append(state)
        costs, total, _ = self.path[-1]
        return [c + total for c in costs], scripts, states


_SOLVED = "node string, costs array<bigint>, scripts array<string>, states array<int>"


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    walk = Walk()
    for batch in batches:
        solved = [walk.solve(*r) for r in zip(*[batch.column(c).to_pylist() for c in ("after", "end", "letters")])]
        arrays = [batch.column("node")]
        for i, kind in enumerate((pa.int64(), pa.string(), pa.int32())):
            arrays.append(pa.array([s[i] for s in solved], pa.list_(kind)))
        yield pa.RecordBatch.from_arrays(arrays, names=["node", "costs", "scripts", "states"])


def repairs(signatures: DataFrame) -> DataFrame:
    """signature, cost and script of the best repair, of distinct signatures (column signature)."""
    spark = signatures.sparkSession
    backwards = F.reverse("signature")
    rows = common.stored(signatures.select("signature", backwards.alias("back"), F.sha2("signature", 256).alias("key")), "signatures")
    longest = rows.agg(F.max(F.length("signature"))).first()[0] or 0
    size = max(PIECE, -(-longest // LEVELS))
    count = F.ceil(F.length("back") / size).cast("int")
    levels = F.sequence(F.lit(1), count)
    # A node is what a signature has from some place to its end; pieces are the way to the next node.
    pieces = rows.filter("back != ''").select("key", "back", F.explode(levels).alias("level")).select(
        "key",
        "level",
        F.sha2(F.substring("back", F.lit(1), F.col("level") * size), 256).alias("node"),
        F.when(F.col("level") > 1, F.sha2(F.substring("back", F.lit(1), (F.col("level") - 1) * size), 256)).alias("after"),
        F.substring("back", (F.col("level") - 1) * size + 1, F.lit(size)).alias("letters"),
    )
    nodes = common.stored(pieces.select("level", "node", "after", "letters").distinct(), "nodes")
    solved, last = None, None
    for level in range(1, -(-longest // size) + 1):
        here = nodes.filter(F.col("level") == level)
        if last is None:
            here = here.withColumn("end", F.array(*map(F.lit, END_COSTS)).cast("array<bigint>"))
        else:
            here = here.join(last.select(F.col("node").alias("after"), F.col("costs").alias("end")), "after")
        order = ["after", "letters"]
        here = here.select("node", "after", "end", "letters")
        here = here.repartitionByRange(common.partitions(spark), *order).sortWithinPartitions(*order)
        last = common.stored(here.mapInArrow(_solve, _SOLVED), "solved")
        solved = last if solved is None else solved.unionByName(last)
    nothing = rows.filter("back = ''").select("signature", F.lit(0).cast("bigint").alias("cost"), F.lit("").alias("script"))
    if solved is None:
        return nothing
    way = F.array_sort(F.collect_list(F.struct((-F.col("level")).alias("at"), "costs", "scripts", "states")))
    ways = pieces.select("key", "level", "node").join(solved, "node").groupBy("key").agg(way.alias("way"))
    start = F.struct(F.lit(START).alias("state"), F.lit("").alias("script"))
    done = F.aggregate(
        "way",
        start,
        lambda s, p: F.struct(
            F.get(p["states"], s["state"]).alias("state"), F.concat(s["script"], F.get(p["scripts"], s["state"])).alias("script")
        ),
    )
    ends = F.array(*map(F.lit, END_SCRIPTS))
    best = ways.select("key", F.get(F.get("way", F.lit(0))["costs"], F.lit(START)).alias("cost"), done.alias("done"))
    best = best.select("key", "cost", F.concat("done.script", F.get(ends, F.col("done.state"))).alias("script"))
    return rows.select("signature", "key").join(best, "key").select("signature", "cost", "script").unionByName(nothing)


def _roles(script: Column, first: Column) -> Column:
    """Role of an inserted or renamed turn, by its letter in the script."""
    return F.when(script.isin("u", "U"), "user").when(script.isin("a", "A"), "assistant").otherwise(first)


def repaired(turns: DataFrame, rows: DataFrame, places: DataFrame, plans: DataFrame) -> DataFrame:
    """conv_id, at, lines: what stands for every turn that stays, inserted turns in front of it included."""
    edits = plans.filter("script != ''").select(
        "conv_id", F.posexplode(F.regexp_extract_all("script", F.lit("[ua]*[KDUA]|[ua]+$"), F.lit(0))).alias("at", "edit")
    )
    inserted = F.transform(F.split(F.regexp_extract("edit", "^[ua]*", 0), ""), lambda x: F.when(x == "u", "user:").when(x == "a", "assistant:"))
    edits = edits.select("conv_id", "at", F.filter(inserted, lambda x: x.isNotNull()).alias("inserted"), F.substring("edit", -1, 1).alias("edit"))
    # A conversation's turns stand side by side in a range.
    at = (F.col("x.pos") - F.col("y.first_pos") + F.col("y.rows_before")).cast("int").alias("at")
    numbered = rows.alias("x").join(places.alias("y"), _same("x", "y", ["conv_id", "part"]))
    numbered = numbered.select(*[f"x.{c}" for c in ("conv_id", "turn", "role", "mark")], at)
    kept = edits.filter(F.col("edit").isin("K", "U", "A"))
    light = numbered.alias("x").join(kept.alias("y"), _same("x", "y", ["conv_id", "at"])).select(
        *[f"x.{c}" for c in ("conv_id", "turn", "role", "mark", "at")], "y.inserted", "y.edit"
    )
    key = ["conv_id", "turn", "role", "mark"]
    # Of equal turns one at most stays, so the text of any of them will do.
    texts = _prepared(turns).filter("copies > 0").dropDuplicates(key)
    role = _roles(F.col("y.edit"), F.col("x.role"))
    line = F.concat(role, F.lit(":"), F.col("x.text"))
    stay = texts.alias("x").join(light.alias("y"), _same("x", "y", key)).select(
        "y.conv_id", "y.at", F.concat_ws("\n", F.col("y.inserted"), line).alias("lines")
    )
    # Insertions before a deleted turn or at the end stand alone.
    alone = edits.filter(~F.col("edit").isin("K", "U", "A") & (F.size("inserted") > 0)).select(
        "conv_id", "at", F.concat_ws("\n", "inserted").alias("lines")
    )
    return stay.unionByName(alone)


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the lines of each conversation, which come one after another."""
    current, held = None, None

    def row(conv, digest):
        return pa.RecordBatch.from_arrays([pa.array(conv, pa.int64()), pa.array(digest, pa.string())], names=["conv_id", "repaired_sha256"])

    for batch in batches:
        convs, digests = [], []
        for conv, lines in zip(batch.column("conv_id").to_pylist(), batch.column("lines").to_pylist()):
            if held is None or conv != current:
                if held is not None:
                    convs.append(current)
                    digests.append(held.hexdigest())
                current, held = conv, hashlib.sha256(lines.encode())
            else:
                held.update(b"\n")
                held.update(lines.encode())
        yield row(convs, digests)
    if held is not None:
        yield row([current], [held.hexdigest()])


def repair(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per conversation its faults and best repair (with audit), and the repaired lines (conv_id, at, lines).

    ``turns`` has conv_id, turn, role and text, and may have ``copies``, how often a turn stands in a row.
    """
    rows = common.stored(diagnosed(turns), "diagnosed")
    per, places = summaries(rows)
    per = common.stored(per, "conversations")
    plans = per.join(repairs(per.select("signature").distinct()), "signature").withColumn("audit", F.translate("script", *TO_AUDIT))
    plans = common.stored(plans.drop("signature"), "plans")
    return plans, repaired(turns, rows, places, plans.select("conv_id", "script"))


def digests(lines: DataFrame) -> DataFrame:
    """conv_id and repaired_sha256 of repaired lines."""
    rows = lines.select(F.col("conv_id").cast("bigint").alias("conv_id"), "at", "lines")
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "at")
    return rows.mapInArrow(_hashes, "conv_id bigint, repaired_sha256 string")


def audits(conversations: DataFrame, turns: DataFrame) -> DataFrame:
    """Every conv_id of ``conversations`` with the repair of its ``turns`` and the hash of the repaired text."""
    plans, lines = repair(turns)
    everyone = conversations.select("conv_id").distinct()
    joined = everyone.alias("c").join(plans.alias("p"), _same("c", "p", ["conv_id"]), "left")
    joined = joined.select("c.conv_id", *[f"p.{c}" for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")])
    joined = joined.alias("c").join(digests(lines).alias("p"), _same("c", "p", ["conv_id"]), "left")
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return joined.select(
        "c.conv_id",
        *[F.coalesce(F.col(f"c.{c}"), F.lit(0)).cast("bigint").alias(c) for c in numbers],
        F.coalesce("c.audit", F.lit("")).alias("audit"),
        F.coalesce("p.repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )
