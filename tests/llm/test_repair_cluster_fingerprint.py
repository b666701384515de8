"""Conversation repair, centroid clustering and fingerprints against brute force."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from geoloom.llm import centroids, convrepair, fingerprints

# --- conversation repair -----------------------------------------------------------------------------------


def _damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        if fault == 1:
            text = ""
        if fault == 2:
            text = re.sub("[.!?]", "", text)
        if fault == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    return out


def _best(letters):
    """Cost and audit of the cheapest repair, by trying every edit at every turn."""
    due = {0: 2, 1: 2, 2: 3, 3: 2}

    @lru_cache(None)
    def rest(i, state, inserted):
        options = [(0, "")] if i == len(letters) and state in (0, 3) else []
        if inserted < 3:
            cost, audit = rest(i, due[state], inserted + 1)
            options.append((cost + 2, "I" + audit))
        if i < len(letters):
            role, fault = letters[i]
            cost, audit = rest(i + 1, state, 0)
            options.append((cost + 3, "D" + audit))
            if fault not in ("blank", "duplicate"):
                late = fault == "truncated"
                cost, audit = rest(i + 1, due[state], 0)
                options.append((cost + 2 + late, "R" + audit))
                if role == {2: "u", 3: "a"}[due[state]]:
                    options.append((cost + late, "K" + audit))
                if role == "s" and state == 0:
                    cost, audit = rest(i + 1, 1, 0)
                    options.append((cost + late, "K" + audit))
        return min(options) if options else (10**9, "")

    return rest(0, 0, 0)


def _repair(rows, conv):
    mine = [r for r in _damaged(rows) if r[0] == conv]
    mine.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).hexdigest()))
    seen, letters = set(), []
    for _, _, role, text in mine:
        bare = text.strip("\x20\x09\x0a\x0b\x0c\x0d")
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else None if bare[-1] in ".!?" else "truncated"
        seen.add((role, text))
        letters.append((role[:1], fault))
    turns = [r[1] for r in mine if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    counts = [sum(f == x for _, f in letters) for x in ("blank", "duplicate", "truncated")]
    illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(letters, letters[1:]))
    cost, audit = _best(tuple(letters))
    lines, at, before = [], 0, None
    for x in audit:
        due = "assistant" if before == "user" else "user"
        if x == "I":
            lines.append(due + ":")
            before = due
            continue
        role, text = mine[at][2:]
        at += 1
        if x != "D":
            before = role if x == "K" else due
            lines.append(f"{before}:{text}")
            before = {"u": "user", "a": "assistant"}.get(before[:1], before)
    digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return (conv, gaps, *counts, illegal, cost, audit, digest)


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def _conversations():
    rnd = random.Random(3)
    roles = ["system", "user", "assistant", "user", "assistant", "user", "assistant", "tool", None, "", "sage", "agent"]
    texts = ["Yes.", "No", "Why?", " \t\n", "", None, "é🙂!", "So. \x0b", "a ", "Yes.", "x" * 50_000 + ".", "line\nline"]
    rows = []
    for conv in [None, *range(60)]:
        for turn in range(rnd.randint(1, 9)):
            clean = conv is None or conv % 3
            role = ["user", "assistant"][turn % 2] if clean else rnd.choice(roles)
            text = f"Turn {turn}." if clean and rnd.random() < 0.8 else rnd.choice(texts)
            rows.append((conv, None if rnd.random() < 0.03 else turn * rnd.choice([1, 1, 2]), role, text))
    rows += [(100, t, rnd.choice(roles[:7]), rnd.choice([f"t{t}.", f"t{t}", "again."])) for t in range(150)]
    rows += [(101, 5, "user", "same.")] * 40
    return rows


@pytest.mark.parametrize("piece", [64, 3])
def test_repaired_conversations(spark, piece, monkeypatch, tmp_path):
    monkeypatch.setattr(convrepair, "PIECE", piece)
    rows = _conversations()
    extra = [(*r, 1, "f", "n", "x") for r in rows]
    schema = "conv_id bigint, turn bigint, role string, text string, copies int, fault string, mark string, at string"
    spark.createDataFrame(extra, schema).repartition(5).write.parquet(str(tmp_path / "c"))
    table = spark.read.parquet(str(tmp_path / "c"))
    got = convrepair.audits(table, convrepair.damaged(table)).select(*COLUMNS).collect()
    want = [_repair(rows, conv) for conv in {r[0] for r in rows}]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert {x for r in got for x in r.audit} == set("KRDI")


def test_all_turns_of_a_conversation_lost(spark):
    lost = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    table = spark.createDataFrame([(lost, 0, "user", "gone.")], "conv_id bigint, turn bigint, role string, text string")
    got = convrepair.audits(table, convrepair.damaged(table)).select(*COLUMNS).collect()
    assert [tuple(r) for r in got] == [(lost, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    nothing = table.filter("conv_id < 0")
    assert convrepair.audits(nothing, convrepair.damaged(nothing)).count() == 0


def test_shared_ends_are_solved_once():
    walk = convrepair.Walk()
    rnd = random.Random(4)
    ends = sorted({"".join(rnd.choice("suaoSUAOd") for _ in range(rnd.randint(1, 7))) for _ in range(400)})
    kinds = {"d": "blank"}
    for back in ends:
        costs, scripts, states = walk.solve(None, convrepair.END_COSTS, back)
        letters = tuple((x.lower(), kinds.get(x, "truncated" if x.isupper() else None)) for x in back[::-1])
        script = scripts[0] + convrepair.END_SCRIPTS[states[0]]
        assert (costs[0], script.translate(str.maketrans(*convrepair.TO_AUDIT))) == _best(letters)
    assert len(walk.known) < 300  # edits repeat however many ends there are


# --- centroid clustering -----------------------------------------------------------------------------------


def _clusters(rows, k=8, rounds=10, scale=1024):
    kept = []
    for i, v in rows:
        if i is not None and v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v):
            kept.append((i, [int(np.floor(float(np.float32(x)) * scale)) for x in v]))
    places = [v for _, v in sorted(kept, key=lambda r: (hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))[:k]]
    for t in range(rounds + 1):
        own = []
        for _, v in kept:
            away = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in places]
            own.append((min(away), away.index(min(away))))
        if t < rounds:
            for j in range(len(places)):
                mine = [v for (_, v), (_, c) in zip(kept, own) if c == j]
                if mine:
                    places[j] = [sum(x) // len(mine) for x in zip(*mine)]
    total = sum(d for d, _ in own)
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in places]
    return [(i, c, d, sum(x for x, y in own if y == c), total, digest[c]) for (i, _), (d, c) in zip(kept, own)]


def _vectors(scale):
    rnd = random.Random(int(scale))
    homes = [[rnd.uniform(-1, 1) for _ in range(64)] for _ in range(5)]
    rows = [(i, [scale * (x + rnd.gauss(0, 0.3)) for x in homes[i % 5]]) for i in range(90)]
    odd = [None, [], [1.0] * 63, [0.5] * 63 + [None], [0.5] * 63 + [float("nan")], [float("inf")] * 64]
    return rows + [(200 + i, v) for i, v in enumerate(odd)] + [(7, rows[7][1]), (7, rows[8][1]), (None, rows[3][1])]


@pytest.mark.parametrize("scale", [1.0, 20000.0])
def test_clusters(spark, scale):
    rows = _vectors(scale)
    table = spark.createDataFrame([(i, v, 1, 2.0) for i, v in rows], "vec_id bigint, embedding array<float>, cluster int, v double")
    got = centroids.clusters(table.repartition(4)).collect()
    assert sorted(map(tuple, got)) == sorted(_clusters(rows))
    few = [r for r in rows[:3]]
    got = centroids.clusters(spark.createDataFrame(few, "vec_id bigint, embedding array<float>")).collect()
    assert sorted(map(tuple, got)) == sorted(_clusters(few))
    none = centroids.clusters(table.filter("vec_id < 0"))
    assert none.count() == 0 and none.columns[-1] == "centroid_sha256"


def test_vectors_too_large_take_no_part(spark):
    rows = [(1, [1.0] * 64), (2, [1e30] * 64)]
    got = centroids.clusters(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")).collect()
    assert [r.vec_id for r in got] == [1]


def test_products_follow_changes():
    rnd = np.random.RandomState(2)
    for top in (1 << 10, 1 << 26):
        v, old = rnd.randint(-top, top, (30, 64)), rnd.randint(-top, top, (8, 64))
        new = np.where(rnd.rand(8, 64) < 0.2, rnd.randint(-top, top, (8, 64)), old)
        assert (centroids.advance(v @ old.T, v, new - old) == v @ new.T).all()


# --- fingerprints ------------------------------------------------------------------------------------------


def _texts():
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choice(["an", "er", "on", "th", "ou", "É", "in"]) for _ in range(rnd.randint(1, 3)))
    prose = [" ".join(word() for _ in range(n)) for n in (1, 2, 4, 5, 6, 40, 300, 2000)]
    return [None, "", " \n", "🙂", "one two", *prose, prose[-1], prose[6].upper(), "x" * 9000, "a " * 4000, prose[5] + "  é"]


def _plain(text):
    """Fingerprint of one text, bin by bin."""
    hashes, _ = fingerprints.shingle_hashes(pa.array([text], pa.string()))
    least = {}
    for h in map(int, hashes):
        least[h >> 56] = min(h, least.get(h >> 56, h))
    if not least:
        return b""
    bits = []
    for i in range(fingerprints.BINS):
        source = i if i in least else min(least, key=lambda j: fingerprints._ORDER[i][j])
        value = np.array([least[source]], np.uint64) ^ fingerprints._SALT[i]
        bits.append(int(fingerprints.wordhash.mix(value)[0]) & 15)
    return bytes(16 * a + b for a, b in zip(bits[::2], bits[1::2]))


def test_fingerprints_bin_by_bin():
    texts = [t or "" for t in _texts()]
    with np.errstate(over="ignore"):
        assert fingerprints.fingerprints(texts) == [_plain(t) for t in texts]


def test_likeness_estimates_similarity():
    rnd = random.Random(9)
    words = [f"w{i}" for i in range(5000)]
    errors = []
    for n in (60, 300, 1500):
        for share in (0.0, 0.3, 0.5, 0.8, 0.95, 1.0):
            a = [rnd.choice(words) for _ in range(n)]
            b = a[: int(n * share)] + [rnd.choice(words) for _ in range(n - int(n * share))]
            x, y = ({tuple(t[i : i + 5]) for i in range(n - 4)} for t in (a, b))
            p, q = fingerprints.fingerprints([" ".join(a), " ".join(b)])
            errors.append(fingerprints.likeness(p, q) - len(x & y) / len(x | y))
    assert max(map(abs, errors)) < 0.13 and abs(np.mean(errors)) < 0.02


def test_edited_documents(spark, tmp_path):
    texts = _texts()
    rows = [(i * 3, t) for i, t in enumerate(texts)] + [(None, "last of all")]
    full = [(i, t, "h", "t", 1, "f") for i, t in rows]
    schema = "doc_id bigint, text string, head string, tail string, part int, fingerprint string"
    spark.createDataFrame(full, schema).repartition(3).write.parquet(str(tmp_path / "d"))
    got = fingerprints.edited(spark.read.parquet(str(tmp_path / "d"))).collect()
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0)))
    want = []
    for (i, t), (_, following) in zip(order, order[1:] + order[:1]):
        third = len(t) // 3
        changed = t[: len(t) - third] + following[:third]
        a, b, c = fingerprints.fingerprints([t, changed, following])
        near = fingerprints.likeness(a, b), fingerprints.likeness(a, c)
        want.append((i, len(t), hashlib.sha256(changed.encode()).digest(), a, b, *near))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_lone_repeated_and_no_documents(spark):
    schema = "doc_id bigint, text string"
    alone = fingerprints.edited(spark.createDataFrame([(4, "abc def ghi")], schema)).collect()
    assert [(r.doc_id, r.near_next, bytes(r.edited_sha256)) for r in alone] == [(4, 1.0, hashlib.sha256(b"abc def abc").digest())]
    same = spark.createDataFrame([(1, "one two three four five six")] * 50 + [(1, "other")], schema).repartition(7)
    assert fingerprints.edited(same).groupBy("near_next").count().filter(F.col("near_next") == 1.0).first()["count"] == 49
    assert fingerprints.edited(same.filter("doc_id < 0")).count() == 0
