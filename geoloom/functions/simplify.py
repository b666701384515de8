"""Line simplification by the Douglas-Peucker rule.

For several tolerances (one per zoom, say) one Arrow pass computes for every vertex the largest
tolerance that still keeps it; after that each tolerance is a JVM-side filter on that weight.  For one
tolerance ``simplified_at`` is an expression without Python, which is also the SQL function.

Of vertices equally far from a chord (within a billionth) the first one splits it.  A closed ring keeps
its ends, its first split and the better of the next two splits (the earlier one, if they are equal).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoloom.functions import geometry as geo

# Weight of vertices that no tolerance may remove; a finite stand-in for infinity.
KEEP = 1e300
# Distances from this share of the largest on count as equal to it.
ALIKE = 1 - 1e-9


def vertex_weights(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weight w per vertex (simplifying with tolerance t keeps exactly the vertices with w > t), and its level."""
    n = len(x)
    weights, levels = np.zeros(n), np.zeros(n, np.int64)
    if n == 0:
        return weights, levels
    weights[0] = weights[-1] = KEEP
    pending = [(0, n - 1, KEEP, 1)]
    while pending:
        lo, hi, limit, level = pending.pop()
        if hi - lo < 2:
            continue
        dx, dy = x[hi] - x[lo], y[hi] - y[lo]
        px, py = x[lo + 1 : hi] - x[lo], y[lo + 1 : hi] - y[lo]
        norm = dx * dx + dy * dy
        if norm > 0:
            t = np.clip((px * dx + py * dy) / norm, 0.0, 1.0)
            dist = np.hypot(px - t * dx, py - t * dy)
        else:
            dist = np.hypot(px, py)
        top = float(dist.max())
        split = lo + 1 + int(np.argmax(dist >= top * ALIKE))
        weight = min(limit, top)
        weights[split], levels[split] = weight, level
        pending.append((lo, split, weight, level + 1))
        pending.append((split, hi, weight, level + 1))
    return weights, levels


def ring_weights(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """As above, but a closed ring always keeps four points, so it stays a ring."""
    weights, levels = vertex_weights(x, y)
    closed = len(x) >= 4 and x[0] == x[-1] and y[0] == y[-1]
    if closed:
        inner = 1 + np.lexsort((levels[1:-1], -weights[1:-1]))[:2]
        weights[inner] = KEEP
    return weights


@F.arrow_udf(T.ArrayType(T.ArrayType(T.DoubleType())))
def part_weights(xs: pa.Array, ys: pa.Array) -> pa.Array:
    """Works on the flat coordinate buffers; the result reuses the input's list offsets."""
    rings = xs.values
    x = rings.values.to_numpy(zero_copy_only=False)
    y = ys.values.values.to_numpy(zero_copy_only=False)
    weights = np.zeros(len(x))
    bounds = rings.offsets.to_numpy()
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        weights[lo:hi] = ring_weights(x[lo:hi], y[lo:hi])
    flat = pa.ListArray.from_arrays(rings.offsets, pa.array(weights))
    return pa.ListArray.from_arrays(xs.offsets, flat)


def weights_column(geom: str) -> Column:
    """``array<array<double>>`` of vertex weights, shaped like the geometry's parts.

    Points need no weights and send nothing to Python.
    """
    axis = lambda c: F.expr(
        f"CASE WHEN {geom}.kind NOT LIKE '%POINT' "
        f"THEN transform({geom}.parts, r -> transform(r, p -> p.{c})) "
        "ELSE CAST(array() AS ARRAY<ARRAY<DOUBLE>>) END"
    )
    return part_weights(axis("x"), axis("y"))


def simplified(geom: str, weights: str, tolerance: str) -> str:
    """SQL text: the geometry with only the vertices whose weight exceeds the tolerance."""
    r, i, p, j = geo._lambda(4)
    return (
        f"CASE WHEN {geom}.kind LIKE '%POINT' THEN {geom} "
        f"WHEN {geom} IS NOT NULL THEN named_struct('kind', {geom}.kind, 'parts', "
        f"transform({geom}.parts, ({r}, {i}) -> "
        f"filter({r}, ({p}, {j}) -> {weights}[{i}][{j}] > {tolerance}))) END"
    )


def with_weights(df: DataFrame, geom: str = "geom", out: str = "weights") -> DataFrame:
    return df.withColumn(out, weights_column(geom))


def simplify_text(df: DataFrame, wkt: str, tolerance: str, out: str) -> DataFrame:
    """WKT simplified in a new column; empty text is NULL, text that does not parse stays as it is."""
    parsed = geo.once(df, _g=geo.parse_wkt(wkt))
    weighed = with_weights(parsed, "_g", "_w")
    shape = geo.let(simplified("_g", "_w", tolerance), geo.to_wkt)
    usable = f"{tolerance} IS NOT NULL AND NOT isnan({tolerance})"
    text = F.expr(f"nullif(CASE WHEN {usable} THEN coalesce({shape}, {wkt}) ELSE {wkt} END, '')")
    return weighed.withColumn(out, text).drop("_g", "_w")


def _farthest(ring: str, lo: str, hi: str) -> str:
    """``struct<at, d>``: the vertex between two others that is farthest from their chord."""
    p, d, j = geo._lambda(3)
    chord = f"named_struct('a', {ring}[{lo}], 'b', {ring}[{hi}])"
    away = geo.let(chord, lambda c: f"transform(slice({ring}, {lo} + 2, {hi} - {lo} - 1), {p} -> {geo._point_segment(p, c)})")
    first = lambda ds, top: f"array_position(transform({ds}, {d} -> {d} >= {top} * {ALIKE!r}D), true)"
    return geo.let(
        away,
        lambda ds: geo.let(
            f"array_max({ds})", lambda top: f"named_struct('at', CAST({lo} + {first(ds, top)} AS INT), 'd', {top})"
        ),
    )


def simplified_at(geom: str, tolerance: str) -> str:
    """SQL text: the geometry simplified by one tolerance, without Python.

    Stretches between kept vertices are split side by side, level by level, so a line costs its length times
    the depth of the splits. The rules are those of ``vertex_weights``.
    """
    r, s, acc, k, v = geo._lambda(5)
    stretch = lambda lo, hi, go: (
        f"named_struct('lo', CAST({lo} AS INT), 'hi', CAST({hi} AS INT), 'open', coalesce({go}, false) AND {hi} - {lo} >= 2)"
    )
    last = f"(size({r}) - 1)"

    def split(m: str) -> str:
        parts = f"array({stretch(f'{s}.lo', f'{m}.at', 'true')}, {stretch(f'{m}.at', f'{s}.hi', 'true')})"
        return f"CASE WHEN {m}.d > {tolerance} THEN {parts} ELSE array({stretch(f'{s}.lo', f'{s}.hi', 'false')}) END"

    # A ring keeps its first split and the better of the next two, whatever the tolerance.
    def ring_start(m: str) -> str:
        left = f"CASE WHEN {m}.at >= 2 THEN {_farthest(r, '0', f'{m}.at')} END"
        right = f"CASE WHEN {last} - {m}.at >= 2 THEN {_farthest(r, f'{m}.at', last)} END"

        def both(x: str, y: str) -> str:
            weight = lambda z: f"CASE WHEN {z} IS NULL THEN -1D ELSE least({m}.d, {z}.d) END"
            wide, deep = f"{m}.d > {tolerance}", lambda z: f"({m}.d > {tolerance} AND {z}.d > {tolerance})"
            first = [stretch("0", f"{x}.at", deep(x)), stretch(f"{x}.at", f"{m}.at", deep(x)), stretch(f"{m}.at", last, wide)]
            second = [stretch("0", f"{m}.at", wide), stretch(f"{m}.at", f"{y}.at", deep(y)), stretch(f"{y}.at", last, deep(y))]
            return f"CASE WHEN {weight(x)} >= {weight(y)} THEN array({', '.join(first)}) ELSE array({', '.join(second)}) END"

        return geo.let(left, lambda x: geo.let(right, lambda y: both(x, y)))

    closed = f"size({r}) >= 4 AND {r}[0] = element_at({r}, -1)"
    start = f"CASE WHEN {closed} THEN {geo.let(_farthest(r, '0', last), ring_start)} ELSE array({stretch('0', last, 'true')}) END"
    state = lambda segs: geo.let(
        segs, lambda x: f"named_struct('open', exists({x}, {v} -> {v}.open), 'segs', {x})"
    )
    halves = geo.let(_farthest(r, f"{s}.lo", f"{s}.hi"), split)
    onward = f"flatten(transform({acc}.segs, {s} -> CASE WHEN {s}.open THEN {halves} ELSE array({s}) END))"
    walked = f"aggregate({r}, {state(start)}, ({acc}, {k}) -> CASE WHEN {acc}.open THEN {state(onward)} ELSE {acc} END, {acc} -> {acc}.segs)"
    kept = f"concat(transform({walked}, {s} -> {r}[{s}.lo]), array(element_at({r}, -1)))"
    return (
        f"CASE WHEN {geom}.kind LIKE '%POINT' THEN {geom} "
        f"WHEN {geom} IS NOT NULL THEN named_struct('kind', {geom}.kind, 'parts', transform({geom}.parts, {r} -> {kept})) END"
    )


def wkt_simplified(wkt: str, tolerance: str) -> str:
    """SQL text: ``simplify_text`` as one expression, which works on any argument."""
    shape = geo.let(geo.let(geo.parse_wkt(wkt), lambda g: simplified_at(g, tolerance)), geo.to_wkt)
    usable = f"{tolerance} IS NOT NULL AND NOT isnan({tolerance})"
    return f"nullif(CASE WHEN {usable} THEN coalesce({shape}, {wkt}) ELSE {wkt} END, '')"
