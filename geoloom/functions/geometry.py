"""Geometry as Spark SQL expression text.

Every function takes and returns SQL expression strings, so one definition serves
``F.expr``/``selectExpr``, SQL functions and join conditions, and Catalyst sees nothing but
built-in expressions.  A geometry is ``struct<kind, parts: array<array<struct<x, y>>>>``:
points and lines hold one part, polygons the shell first and then their holes.  Multi-part kinds
hold the parts of all members; the rings of a MULTIPOLYGON's shells turn one way, those of its
holes the other, and every shell is followed by its holes.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.rules import EARTH_RADIUS_M

_names = count()


def let(value: str, body) -> str:
    """Evaluate ``value`` once and use it by name inside ``body``."""
    v = f"v{next(_names)}"
    return f"get(transform(array({value}), {v} -> {body(v)}), 0)"


def once(df: DataFrame, **columns: str) -> DataFrame:
    """Add costly columns so that they are evaluated once per row.

    Catalyst copies an ordinary projected expression into every filter above it (also into
    the null checks it infers for joins).  The output of a generator is not copied.
    """
    made = F.struct(*[F.expr(text).alias(name) for name, text in columns.items()])
    kept = [c for c in df.columns if c not in columns]
    return df.select(*[F.col(f"`{c}`") for c in kept], F.inline(F.array(made)))


def _lambda(n: int = 1) -> list[str]:
    return [f"v{next(_names)}" for _ in range(n)]


# --- construction and text ------------------------------------------------------------------


def point(x: str, y: str) -> str:
    return (
        f"CASE WHEN {x} IS NOT NULL AND {y} IS NOT NULL THEN named_struct('kind', 'POINT', "
        f"'parts', array(array(named_struct('x', {x}, 'y', {y})))) END"
    )


def line(points: str) -> str:
    return f"named_struct('kind', 'LINESTRING', 'parts', array({points}))"


def polygon(ring: str) -> str:
    return f"named_struct('kind', 'POLYGON', 'parts', array({ring}))"


def box(x0: str, y0: str, x1: str, y1: str) -> str:
    corner = lambda x, y: f"named_struct('x', {x}, 'y', {y})"
    ring = ", ".join(
        [corner(x0, y0), corner(x1, y0), corner(x1, y1), corner(x0, y1), corner(x0, y0)]
    )
    return polygon(f"array({ring})")


POLYGONAL, LINEAR = "('POLYGON', 'MULTIPOLYGON')", "('LINESTRING', 'MULTILINESTRING')"


def parse_wkt(wkt: str) -> str:
    """WKT text to geometry.

    Points, lines, polygons and their multi-part kinds are read; further coordinates (Z, M) are left
    out.  Empty shapes, collections and text that is not well-formed are NULL.

    Shapes of one part with plain blanks are split by single characters, which takes no pattern.
    """
    return let(wkt, _parsed)


def _parsed(wkt: str) -> str:
    p, c, r, q = _lambda(4)
    kind = rf"regexp_extract({wkt}, r'(?i)^\s*((MULTI)?(POINT|LINESTRING|POLYGON))\s*(ZM|Z|M)?\s*\(', 1)"
    body = rf"regexp_extract({wkt}, r'(?s)\((.*)\)\s*$', 1)"

    def rings(k: str) -> str:
        inner = rf"regexp_extract({body}, r'(?s)^\s*\((.*)\)\s*$', 1)"
        # Every member's shell gets a mark; the parentheses around members go.
        members = rf"regexp_replace(regexp_replace({body}, r'\(\s*\(', '(#'), r'\)\s*\)', ')')"
        rings_of_members = rf"regexp_extract({members}, r'(?s)^\s*\((.*)\)\s*$', 1)"
        return (
            f"CASE WHEN {k} IN ('POLYGON', 'MULTILINESTRING') THEN split({inner}, r'\\)\\s*,\\s*\\(') "
            f"WHEN {k} = 'MULTIPOLYGON' THEN split({rings_of_members}, r'\\)\\s*,\\s*\\(') "
            f"WHEN {k} = 'MULTIPOINT' THEN split(regexp_replace({body}, r'[()]', ''), ',') ELSE array({body}) END"
        )

    coordinate = (
        rf"get(transform(array(split({p}, r'\s+')), {c} -> CASE WHEN size({c}) BETWEEN 2 AND 4 THEN "
        f"named_struct('x', try_cast(get({c}, 0) AS DOUBLE), "
        f"'y', try_cast(get({c}, 1) AS DOUBLE)) END), 0)"
    )

    def parts(k: str) -> str:
        split_points = rf"split(trim(TRIM(LEADING '#' FROM {r})), r'\s*,\s*')"
        points = f"transform({split_points}, {p} -> {coordinate})"
        turned = let(points, lambda ring: f"CASE WHEN ({_signed_area(ring)} >= 0) = startswith({r}, '#') THEN {ring} ELSE reverse({ring}) END")
        return f"transform({rings(k)}, {r} -> CASE WHEN {k} = 'MULTIPOLYGON' THEN {turned} ELSE {points} END)"

    def checked(k: str, ps: str) -> str:
        finite = f"abs({q}.x) < double('Infinity') AND abs({q}.y) < double('Infinity')"
        bad = f"exists(flatten({ps}), {q} -> NOT coalesce({finite}, false))"
        shape = (
            f"CASE {k} WHEN 'POINT' THEN size({ps}) = 1 AND size({ps}[0]) = 1 "
            f"WHEN 'LINESTRING' THEN size({ps}) = 1 AND size({ps}[0]) >= 2 "
            f"WHEN 'MULTIPOINT' THEN forall({ps}, {r} -> size({r}) = 1) "
            f"WHEN 'MULTILINESTRING' THEN forall({ps}, {r} -> size({r}) >= 2) "
            f"ELSE forall({ps}, {r} -> size({r}) >= 4 AND {r}[0] = element_at({r}, -1)) END"
        )
        return (
            f"CASE WHEN {bad} THEN NULL WHEN {shape} "
            f"THEN named_struct('kind', {k}, 'parts', {ps}) END"
        )

    # Capitals need no conversion, which is costly.
    capital = lambda k: f"CASE WHEN {k} IN ('POINT', 'LINESTRING', 'POLYGON') THEN {k} ELSE upper({k}) END"
    anyhow = let(
        let(kind, capital),
        lambda k: f"CASE WHEN {k} <> '' THEN {let(parts(k), lambda ps: checked(k, ps))} END",
    )
    number = "[-+.0-9eE, ]+"
    plain = (
        rf"{wkt} rlike r'^((POINT|LINESTRING) ?\({number}\)|POLYGON ?\(\({number}\)\))$' "
        f"AND NOT contains({wkt}, '  ') AND NOT contains({wkt}, ' ,')"
    )
    pair = let(
        f"split({p}, ' ')",
        lambda c: (
            f"CASE WHEN size({c}) BETWEEN 2 AND 4 THEN named_struct('x', try_cast(get({c}, 0) AS DOUBLE), "
            f"'y', try_cast(get({c}, 1) AS DOUBLE)) END"
        ),
    )
    text = f"trim(substring_index(substring_index({wkt}, '(', -1), ')', 1))"
    ring = f"array(transform(split(replace({text}, ', ', ','), ','), {p} -> {pair}))"
    simple = let(f"trim(substring_index({wkt}, '(', 1))", lambda k: let(ring, lambda ps: checked(k, ps)))
    return f"CASE WHEN {plain} THEN {simple} ELSE {anyhow} END"


def _xy(p: str) -> str:
    return f"concat(CAST({p}.x AS STRING), ' ', CAST({p}.y AS STRING))"


def to_wkt(g: str) -> str:
    p, r = _lambda(2)
    ring = lambda pts: f"array_join(transform({pts}, {p} -> {_xy(p)}), ', ')"
    rings = f"array_join(transform({g}.parts, {r} -> concat('(', {ring(r)}, ')')), ', ')"
    points = f"array_join(transform({g}.parts, {r} -> concat('(', {_xy(f'{r}[0]')}, ')')), ', ')"
    members = (
        f"array_join(transform({g}.parts, ({r}, i) -> concat(CASE WHEN i = 0 THEN '((' "
        f"WHEN {is_shell(g, r, 'i')} THEN '), ((' ELSE ', (' END, {ring(r)}, ')')), '')"
    )
    return (
        f"CASE {g}.kind WHEN 'POINT' THEN concat('POINT (', {_xy(f'{g}.parts[0][0]')}, ')') "
        f"WHEN 'LINESTRING' THEN concat('LINESTRING (', {ring(f'{g}.parts[0]')}, ')') "
        f"WHEN 'POLYGON' THEN concat('POLYGON (', {rings}, ')') "
        f"WHEN 'MULTIPOINT' THEN concat('MULTIPOINT (', {points}, ')') "
        f"WHEN 'MULTILINESTRING' THEN concat('MULTILINESTRING (', {rings}, ')') "
        f"WHEN 'MULTIPOLYGON' THEN concat('MULTIPOLYGON (', {members}, '))') END"
    )


def point_wkt(lon: str, lat: str) -> str:
    """``POINT(lon lat)``; NULL only when a coordinate is NULL (zero is a coordinate)."""
    return f"concat('POINT(', CAST({lon} AS STRING), ' ', CAST({lat} AS STRING), ')')"


# --- decomposition --------------------------------------------------------------------------


def edges(g: str) -> str:
    """All segments as ``struct<a, b>``; a point becomes one segment of length zero."""
    r, p, q = _lambda(3)
    return (
        f"flatten(transform({g}.parts, {r} -> CASE WHEN size({r}) = 1 "
        f"THEN array(named_struct('a', {r}[0], 'b', {r}[0])) "
        f"ELSE zip_with(slice({r}, 1, size({r}) - 1), slice({r}, 2, size({r}) - 1), "
        f"({p}, {q}) -> named_struct('a', {p}, 'b', {q})) END))"
    )


def bbox(g: str) -> str:
    return let(
        f"flatten({g}.parts)",
        lambda pts: (
            f"named_struct('x0', array_min({pts}.x), 'y0', array_min({pts}.y), "
            f"'x1', array_max({pts}.x), 'y1', array_max({pts}.y))"
        ),
    )


def bbox_overlap(a: str, b: str, grow: str = "0D") -> str:
    return (
        f"({a}.x0 <= {b}.x1 + {grow} AND {b}.x0 <= {a}.x1 + {grow} "
        f"AND {a}.y0 <= {b}.y1 + {grow} AND {b}.y0 <= {a}.y1 + {grow})"
    )


# --- measures -------------------------------------------------------------------------------


def _sum(array: str, term) -> str:
    e, acc, v = _lambda(3)
    return f"aggregate(transform({array}, {e} -> {term(e)}), 0D, ({acc}, {v}) -> {acc} + {v})"


def _signed_area(ring: str) -> str:
    """Shoelace around the first vertex, which keeps precision for small far-away rings."""
    p, q = _lambda(2)
    o = f"{ring}[0]"
    cross = (
        f"({p}.x - {o}.x) * ({q}.y - {o}.y) - ({q}.x - {o}.x) * ({p}.y - {o}.y)"
    )
    terms = (
        f"zip_with(slice({ring}, 1, size({ring}) - 1), slice({ring}, 2, size({ring}) - 1), "
        f"({p}, {q}) -> {cross})"
    )
    return f"{_sum(terms, lambda t: t)} / 2"


def _ring_area(ring: str) -> str:
    return f"abs({_signed_area(ring)})"


def is_shell(g: str, ring: str, index: str) -> str:
    """The first ring is a shell; in a MULTIPOLYGON so is every ring that turns as it does."""
    turns_alike = f"({_signed_area(ring)} >= 0) = ({_signed_area(f'{g}.parts[0]')} >= 0)"
    return f"({index} = 0 OR ({g}.kind = 'MULTIPOLYGON' AND {turns_alike}))"


def _ring_area_m2(ring: str) -> str:
    p, q = _lambda(2)
    base = f"2 * sin(radians({ring}[0].y))"
    term = (
        f"radians({q}.x - {p}.x) * (sin(radians({p}.y)) + sin(radians({q}.y)) - {base})"
    )
    terms = (
        f"zip_with(slice({ring}, 1, size({ring}) - 1), slice({ring}, 2, size({ring}) - 1), "
        f"({p}, {q}) -> {term})"
    )
    scale = EARTH_RADIUS_M * EARTH_RADIUS_M / 2
    return f"abs({_sum(terms, lambda t: t)}) * {scale!r}D"


def _polygon_sum(g: str, ring_measure) -> str:
    r, i = _lambda(2)
    signed = (
        f"transform({g}.parts, ({r}, {i}) -> "
        f"CASE WHEN {is_shell(g, r, i)} THEN {ring_measure(r)} ELSE -({ring_measure(r)}) END)"
    )
    total = _sum(signed, lambda t: t)
    return f"CASE WHEN {g}.kind IN {POLYGONAL} THEN {total} WHEN {g}.kind IS NOT NULL THEN 0D END"


def area(g: str) -> str:
    """Planar area in squared coordinate units."""
    return _polygon_sum(g, _ring_area)


def area_m2(g: str) -> str:
    """Area on the sphere in square metres."""
    return _polygon_sum(g, _ring_area_m2)


def length(g: str) -> str:
    """Planar length, the perimeter for polygons."""
    seg = lambda e: f"hypot({e}.b.x - {e}.a.x, {e}.b.y - {e}.a.y)"
    return f"CASE WHEN {g} IS NOT NULL THEN {_sum(edges(g), seg)} END"


def haversine_m(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    return (
        f"{2 * EARTH_RADIUS_M!r}D * asin(sqrt(least(1D, "
        f"pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * "
        f"cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2))))"
    )


def length_m(g: str) -> str:
    """Great-circle length in metres."""
    seg = lambda e: haversine_m(f"{e}.a.x", f"{e}.a.y", f"{e}.b.x", f"{e}.b.y")
    return f"CASE WHEN {g} IS NOT NULL THEN {_sum(edges(g), seg)} END"


# --- predicates -----------------------------------------------------------------------------


def _turn(a: str, b: str, c: str) -> str:
    return (
        f"signum(({b}.x - {a}.x) * ({c}.y - {a}.y) - ({b}.y - {a}.y) * ({c}.x - {a}.x))"
    )


def _segments_touch(s: str, t: str) -> str:
    """Closed segments share a point: boxes overlap and neither lies on one side of the other."""
    return (
        f"(greatest({s}.a.x, {s}.b.x) >= least({t}.a.x, {t}.b.x) "
        f"AND greatest({t}.a.x, {t}.b.x) >= least({s}.a.x, {s}.b.x) "
        f"AND greatest({s}.a.y, {s}.b.y) >= least({t}.a.y, {t}.b.y) "
        f"AND greatest({t}.a.y, {t}.b.y) >= least({s}.a.y, {s}.b.y) "
        f"AND {_turn(f'{s}.a', f'{s}.b', f'{t}.a')} * {_turn(f'{s}.a', f'{s}.b', f'{t}.b')} <= 0 "
        f"AND {_turn(f'{t}.a', f'{t}.b', f'{s}.a')} * {_turn(f'{t}.a', f'{t}.b', f'{s}.b')} <= 0)"
    )


def _segments_cross(s: str, t: str) -> str:
    """The interiors of both segments meet in one point."""
    return (
        f"({_turn(f'{s}.a', f'{s}.b', f'{t}.a')} * {_turn(f'{s}.a', f'{s}.b', f'{t}.b')} < 0 "
        f"AND {_turn(f'{t}.a', f'{t}.b', f'{s}.a')} * {_turn(f'{t}.a', f'{t}.b', f'{s}.b')} < 0)"
    )


def _on_edge(p: str, es: str) -> str:
    e = _lambda()[0]
    return (
        f"exists({es}, {e} -> {p}.x >= least({e}.a.x, {e}.b.x) AND {p}.x <= greatest({e}.a.x, {e}.b.x) "
        f"AND {p}.y >= least({e}.a.y, {e}.b.y) AND {p}.y <= greatest({e}.a.y, {e}.b.y) "
        f"AND {_turn(f'{e}.a', f'{e}.b', p)} = 0)"
    )


def _odd_crossings(p: str, es: str) -> str:
    """Even-odd rule over all rings, so holes count as outside."""
    e, acc = _lambda(2)
    x_at = f"({e}.b.x - {e}.a.x) * ({p}.y - {e}.a.y) / ({e}.b.y - {e}.a.y) + {e}.a.x"
    hit = (
        f"CASE WHEN ({e}.a.y > {p}.y) <> ({e}.b.y > {p}.y) "
        f"THEN CASE WHEN {p}.x < {x_at} THEN 1 ELSE 0 END ELSE 0 END"
    )
    return f"(aggregate({es}, 0, ({acc}, {e}) -> {acc} + {hit}) % 2 = 1)"


def _flag(body: str) -> str:
    return f"coalesce({body}, false)"


def _with_boxes(a: str, b: str, ba: str | None, bb: str | None, body) -> str:
    """``body`` of the names of both boxes, which are computed unless they are given."""
    if ba and bb:
        return body(ba, bb)
    return let(bbox(a), lambda x: let(bbox(b), lambda y: body(x, y)))


def _edges_near(es: str, box_: str) -> str:
    """Edges whose own box meets a box: all that can touch what lies in it."""
    e = _lambda()[0]
    return (
        f"filter({es}, {e} -> greatest({e}.a.x, {e}.b.x) >= {box_}.x0 AND least({e}.a.x, {e}.b.x) <= {box_}.x1 "
        f"AND greatest({e}.a.y, {e}.b.y) >= {box_}.y0 AND least({e}.a.y, {e}.b.y) <= {box_}.y1)"
    )


def _with_edges(g: str, given: str | None, body) -> str:
    """``body`` of the name of a geometry's edges; ``given`` names them where they are at hand."""
    return let(f"coalesce({given}, {edges(g)})" if given else edges(g), body)


def intersects(
    a: str, b: str, ba: str | None = None, bb: str | None = None, ea: str | None = None, eb: str | None = None
) -> str:
    """Closed geometries share a point; FALSE when one is NULL.

    ``ba`` and ``bb`` name boxes already at hand (they may be larger than the geometry), ``ea`` and
    ``eb`` edges (NULL where they are not).  Only edges near the other geometry are compared with each
    other; without an edge of ``b`` near ``a``, one vertex of ``a`` decides.
    """
    s, t, r = _lambda(3)

    def of_point(p: str, g: str, es: str) -> str:
        return let(
            f"{p}.parts[0][0]", lambda v: f"({g}.kind IN {POLYGONAL} AND {_odd_crossings(v, es)}) OR {_on_edge(v, es)}"
        )

    def body(xa: str, xb: str, x: str, y: str) -> str:
        inside_b = f"({b}.kind IN {POLYGONAL} AND exists({a}.parts, {r} -> {_odd_crossings(f'{r}[0]', xb)}))"
        inside_a = f"({a}.kind IN {POLYGONAL} AND exists({b}.parts, {r} -> {_odd_crossings(f'{r}[0]', xa)}))"
        return let(
            _edges_near(xb, x),
            lambda near: (
                f"CASE WHEN size({near}) = 0 THEN {b}.kind IN {POLYGONAL} AND {_odd_crossings(f'{a}.parts[0][0]', xb)} "
                f"ELSE {inside_b} OR {inside_a} OR "
                f"exists({_edges_near(xa, y)}, {s} -> exists({near}, {t} -> {_segments_touch(s, t)})) END"
            ),
        )

    def gated(x: str, y: str) -> str:
        exact = _with_edges(a, ea, lambda xa: _with_edges(b, eb, lambda xb: body(xa, xb, x, y)))
        return (
            f"CASE WHEN NOT {bbox_overlap(x, y)} THEN false "
            f"WHEN {a}.kind = 'POINT' THEN {_with_edges(b, eb, lambda xb: of_point(a, b, xb))} "
            f"WHEN {b}.kind = 'POINT' THEN {_with_edges(a, ea, lambda xa: of_point(b, a, xa))} ELSE {exact} END"
        )

    return _flag(_with_boxes(a, b, ba, bb, gated))


def within(
    a: str, b: str, ba: str | None = None, bb: str | None = None, ea: str | None = None, eb: str | None = None
) -> str:
    """``a`` lies in ``b`` and reaches its interior; contact with the boundary alone is not enough.

    Boxes and edges at hand are named as for ``intersects``.
    """
    s, t, p, r = _lambda(4)
    mid = lambda e: (
        f"named_struct('x', ({e}.a.x + {e}.b.x) / 2, 'y', ({e}.a.y + {e}.b.y) / 2)"
    )

    def in_polygon(ea: str, eb: str, near: str) -> str:
        # Location of every vertex and edge middle: 0 outside, 1 on the boundary, 2 inside.
        probes = f"concat(flatten({a}.parts), transform({ea}, {s} -> {mid(s)}))"
        where = (
            f"transform({probes}, {p} -> CASE WHEN {_on_edge(p, eb)} THEN 1 "
            f"WHEN {_odd_crossings(p, eb)} THEN 2 ELSE 0 END)"
        )
        crossing = f"exists({ea}, {s} -> exists({near}, {t} -> {_segments_cross(s, t)}))"
        hole_in_a = (
            f"({a}.kind IN {POLYGONAL} AND exists({b}.parts, {r} -> "
            f"{_odd_crossings(f'{r}[0]', ea)} AND NOT {_on_edge(f'{r}[0]', ea)}))"
        )
        return let(
            where,
            lambda w: (
                f"(array_min({w}) > 0 AND ({a}.kind IN {POLYGONAL} OR array_max({w}) = 2) "
                f"AND NOT {crossing} AND NOT {hole_in_a})"
            ),
        )

    def in_area(xb: str, x: str) -> str:
        # With no edge of b near it, all of a lies on one side of b's boundary.
        apart = lambda near: (
            f"CASE WHEN size({near}) = 0 THEN {_odd_crossings(f'{a}.parts[0][0]', xb)} "
            f"ELSE {_with_edges(a, ea, lambda xa: in_polygon(xa, xb, near))} END"
        )
        return let(_edges_near(xb, x), apart)

    def on_line(ea: str, eb: str) -> str:
        end = lambda i: f"element_at({b}.parts[0], {i})"
        at_end = f"({a}.parts[0][0] = {end(1)} OR {a}.parts[0][0] = {end(-1)})"
        closed = f"{end(1)} = {end(-1)}"
        return f"({on_lines(ea, eb)} AND ({a}.kind <> 'POINT' OR {closed} OR NOT {at_end}))"

    def on_lines(ea: str, eb: str) -> str:
        probes = f"concat(flatten({a}.parts), transform({ea}, {s} -> {mid(s)}))"
        return f"forall({probes}, {p} -> {_on_edge(p, eb)})"

    def gated(x: str, y: str) -> str:
        inside = (
            f"({x}.x0 >= {y}.x0 AND {x}.x1 <= {y}.x1 AND {x}.y0 >= {y}.y0 AND {x}.y1 <= {y}.y1)"
        )
        lined = lambda test: _with_edges(a, ea, lambda xa: _with_edges(b, eb, lambda xb: test(xa, xb)))
        return (
            f"CASE WHEN NOT {inside} THEN false "
            f"WHEN {b}.kind IN {POLYGONAL} THEN {_with_edges(b, eb, lambda xb: in_area(xb, x))} "
            f"WHEN {a}.kind IN {POLYGONAL} THEN false "
            f"WHEN {b}.kind = 'LINESTRING' THEN {lined(on_line)} "
            f"WHEN {b}.kind = 'MULTILINESTRING' THEN {lined(on_lines)} "
            f"ELSE {a}.kind IN ('POINT', 'MULTIPOINT') AND forall({a}.parts, {r} -> "
            f"exists({b}.parts, {p} -> {p}[0] = {r}[0])) END"
        )

    return _flag(_with_boxes(a, b, ba, bb, gated))


def contains(
    a: str, b: str, ba: str | None = None, bb: str | None = None, ea: str | None = None, eb: str | None = None
) -> str:
    return within(b, a, bb, ba, eb, ea)


def _point_segment(p: str, e: str) -> str:
    length2 = f"(pow({e}.b.x - {e}.a.x, 2) + pow({e}.b.y - {e}.a.y, 2))"
    along = (
        f"(({p}.x - {e}.a.x) * ({e}.b.x - {e}.a.x) + ({p}.y - {e}.a.y) * ({e}.b.y - {e}.a.y))"
    )
    t = f"coalesce(greatest(0D, least(1D, {along} / nullif({length2}, 0D))), 0D)"
    return let(
        t,
        lambda f: (
            f"hypot({p}.x - {e}.a.x - {f} * ({e}.b.x - {e}.a.x), "
            f"{p}.y - {e}.a.y - {f} * ({e}.b.y - {e}.a.y))"
        ),
    )


def _spans(es: str) -> str:
    """Edges as start, extent and squared length, for distances to many points."""
    e = _lambda()[0]
    dx, dy = f"({e}.b.x - {e}.a.x)", f"({e}.b.y - {e}.a.y)"
    return f"transform({es}, {e} -> named_struct('x', {e}.a.x, 'y', {e}.a.y, 'dx', {dx}, 'dy', {dy}, 'l', {dx} * {dx} + {dy} * {dy}))"


def _point_span(p: str, s: str) -> str:
    along = f"(({p}.x - {s}.x) * {s}.dx + ({p}.y - {s}.y) * {s}.dy)"
    t = f"coalesce(greatest(0D, least(1D, {along} / nullif({s}.l, 0D))), 0D)"
    return let(t, lambda f: f"hypot({p}.x - {s}.x - {f} * {s}.dx, {p}.y - {s}.y - {f} * {s}.dy)")


def distance(
    a: str, b: str, ba: str | None = None, bb: str | None = None, ea: str | None = None, eb: str | None = None
) -> str:
    """Planar minimum distance; NULL when a geometry is NULL.  Boxes and edges at hand are named as for ``intersects``."""
    p, e = _lambda(2)

    def nearest(points: str, es: str) -> str:
        return let(
            _spans(es),
            lambda ss: f"array_min(transform({points}, {p} -> array_min(transform({ss}, {e} -> {_point_span(p, e)}))))",
        )

    vertices = lambda g: f"flatten({g}.parts)"
    apart = (
        f"CASE WHEN {a}.kind IN ('POINT', 'MULTIPOINT') THEN {_with_edges(b, eb, lambda xb: nearest(vertices(a), xb))} "
        f"WHEN {b}.kind IN ('POINT', 'MULTIPOINT') THEN {_with_edges(a, ea, lambda xa: nearest(vertices(b), xa))} "
        f"ELSE least({_with_edges(b, eb, lambda xb: nearest(vertices(a), xb))}, "
        f"{_with_edges(a, ea, lambda xa: nearest(vertices(b), xa))}) END"
    )
    pa, pb = f"{a}.parts[0][0]", f"{b}.parts[0][0]"
    return (
        f"CASE WHEN {a} IS NULL OR {b} IS NULL THEN NULL "
        f"WHEN {a}.kind = 'POINT' AND {b}.kind = 'POINT' "
        f"THEN hypot({pa}.x - {pb}.x, {pa}.y - {pb}.y) "
        f"WHEN {intersects(a, b, ba, bb, ea, eb)} THEN 0D ELSE {apart} END"
    )


def buffer_point(g: str, d: str, segments: int = 32) -> str:
    """Polygon around a point; other kinds have no polygon form here and give NULL."""
    i = _lambda()[0]
    p = f"{g}.parts[0][0]"
    angle = f"radians({i} % {segments} * {360 / segments!r}D)"
    ring = (
        f"transform(sequence(0, {segments}), {i} -> named_struct("
        f"'x', {p}.x + {d} * cos({angle}), 'y', {p}.y + {d} * sin({angle})))"
    )
    return f"CASE WHEN {g}.kind = 'POINT' AND {d} > 0 THEN {polygon(ring)} END"


def _rings_apart(g: str) -> str:
    """Rings that are simple one by one also form polygons; see ``is_valid``."""
    r, e, s, t, i, k, m, n, o, p = _lambda(10)
    shells = f"transform({g}.parts, ({r}, {i}) -> CASE WHEN {is_shell(g, r, i)} THEN 1 ELSE 0 END)"
    # A ring's polygon is the number of shells up to it.
    numbered = lambda flags: (
        f"transform({g}.parts, ({r}, {i}) -> named_struct('i', {i}, 'shell', {flags}[{i}] = 1, "
        f"'poly', aggregate(slice({flags}, 1, {i} + 1), 0, ({m}, {n}) -> {m} + {n}), "
        f"'pts', {r}, 'box', {bbox(line(r))}, 'es', filter({edges_of_ring(r)}, {e} -> {e}.a <> {e}.b)))"
    )

    def strips(rings: str) -> str:
        """Crossings of different rings, and the vertices at which two rings meet."""
        every = (
            f"flatten(transform({rings}, {r} -> transform({r}.es, {e} -> named_struct("
            f"'a', {e}.a, 'b', {e}.b, 'i', {r}.i, 'poly', {r}.poly))))"
        )

        def cut(es: str) -> str:
            shape = (
                f"named_struct('lo', array_min(transform({es}, {e} -> {e}.a.x)), "
                f"'hi', array_max(transform({es}, {e} -> {e}.a.x)), "
                f"'n', CAST(greatest(1, floor(sqrt(size({es})) / 2)) AS INT))"
            )

            def within_strips(b: str) -> str:
                left = f"({b}.lo + ({b}.hi - {b}.lo) * {k} / {b}.n)"
                right = f"({b}.lo + ({b}.hi - {b}.lo) * ({k} + 1) / {b}.n)"
                inside = (
                    f"filter({es}, {s} -> ({k} = 0 OR greatest({s}.a.x, {s}.b.x) >= {left}) "
                    f"AND ({k} = {b}.n - 1 OR least({s}.a.x, {s}.b.x) <= {right}))"
                )
                # What a pair of edges shows: 2 they cross or share a part, 1 the first begins on the second.
                along = lambda v, w: (
                    f"(greatest(least({s}.a.{v}, {s}.b.{v}), least({t}.a.{v}, {t}.b.{v})) "
                    f"{w} least(greatest({s}.a.{v}, {s}.b.{v}), greatest({t}.a.{v}, {t}.b.{v})))"
                )
                lined = f"({_turn(f'{s}.a', f'{s}.b', f'{t}.a')} = 0 AND {_turn(f'{s}.a', f'{s}.b', f'{t}.b')} = 0)"
                shared = f"({lined} AND ({along('x', '<')} OR {along('y', '<')}))"
                seen = (
                    f"CASE WHEN {s}.i = {t}.i OR NOT ({along('x', '<=')} AND {along('y', '<=')}) THEN 0 "
                    f"WHEN {_segments_cross(s, t)} OR {shared} THEN 2 "
                    f"WHEN {_turn(f'{t}.a', f'{t}.b', f'{s}.a')} = 0 AND {_on_edge(f'{s}.a', f'array({t})')} THEN 1 ELSE 0 END"
                )
                found = lambda c: (
                    f"flatten(transform({c}, {s} -> filter(transform({c}, {t} -> named_struct('what', {seen}, "
                    f"'i', least({s}.i, {t}.i), 'j', greatest({s}.i, {t}.i), 'one', {s}.poly = {t}.poly, 'p', {s}.a)), "
                    f"{m} -> {m}.what > 0)))"
                )
                return f"array_distinct(flatten(transform(sequence(0, {b}.n - 1), {k} -> {let(inside, found)})))"

            return let(shape, within_strips)

        return let(every, cut)

    def placed(rings: str, meets: str) -> str:
        in_box = f"({p}.x >= {o}.box.x0 AND {p}.x <= {o}.box.x1 AND {p}.y >= {o}.box.y0 AND {p}.y <= {o}.box.y1)"
        in_ring = f"({in_box} AND {_odd_crossings(p, f'{o}.es')})"
        # Rings of a polygon meet once at most, so one vertex off the other ring tells its side.
        pair = f"{m}.i = least({r}.i, {o}.i) AND {m}.j = greatest({r}.i, {o}.i)"
        off = f"filter({r}.pts, {p} -> NOT exists({meets}, {m} -> {pair} AND {m}.p = {p}))"
        sided = (
            f"forall(slice({off}, 1, 1), {p} -> {in_ring} = {o}.shell)"
        )
        holes = (
            f"forall(filter({rings}, {r} -> NOT {r}.shell), {r} -> "
            f"forall(filter({rings}, {o} -> {o}.poly = {r}.poly AND {o}.i <> {r}.i), {o} -> {sided}))"
        )
        # Polygons may meet often: every vertex, and the middle of every edge whose ends both meet something.
        met = lambda v: f"exists({meets}, {m} -> ({m}.i = {r}.i OR {m}.j = {r}.i) AND {m}.p = {v})"
        middle = f"named_struct('x', ({e}.a.x + {e}.b.x) / 2, 'y', ({e}.a.y + {e}.b.y) / 2)"
        probes = (
            f"concat(filter({r}.pts, {p} -> NOT {met(p)}), "
            f"transform(filter({r}.es, {e} -> {met(f'{e}.a')} AND {met(f'{e}.b')}), {e} -> {middle}))"
        )
        taken = (
            f"exists({rings}, {o} -> {o}.shell AND {o}.poly <> {r}.poly AND {in_ring} AND NOT "
            f"exists(filter({rings}, {n} -> NOT {n}.shell AND {n}.poly = {o}.poly), {o} -> {in_ring}))"
        )
        apart = (
            f"({g}.kind <> 'MULTIPOLYGON' OR forall(filter({rings}, {r} -> {r}.shell), {r} -> "
            f"forall({probes}, {p} -> NOT {taken})))"
        )
        return f"({holes} AND {apart})"

    def judged(rings: str, meets: str) -> str:
        twice = f"transform(filter({meets}, {m} -> {m}.one), {m} -> named_struct('i', {m}.i, 'j', {m}.j))"
        once_each = let(twice, lambda x: f"size(array_distinct({x})) = size({x})")
        return (
            f"CASE WHEN exists({meets}, {m} -> {m}.what = 2) OR NOT {once_each} THEN false "
            f"ELSE {placed(rings, meets)} END"
        )

    return let(shells, lambda f: let(numbered(f), lambda rings: let(strips(rings), lambda meets: judged(rings, meets))))


def is_valid(g: str) -> str:
    """Usable shape: a line has two distinct points, rings have area and do not cross themselves.

    Rings of one polygon meet in single points only, two of them at most once; holes lie in their
    shell and beside each other; the polygons of a MULTIPOLYGON share no area and no part of an edge.

    Edges are compared within vertical strips, about half the square root of their number, so
    a ring of n vertices costs about n to the power 1.5 instead of n squared.
    """
    r, p, s, t, i, k = _lambda(6)

    def simple(es: str) -> str:
        # Neighbouring edges share an end; they are bad only when they fold back on each other.
        neighbours = f"({t}.i = {s}.i + 1 OR ({s}.i = 0 AND {t}.i = size({es}) - 1))"
        folds = (
            f"({_turn(f'{s}.a', f'{s}.b', f'{t}.a')} = 0 AND {_turn(f'{s}.a', f'{s}.b', f'{t}.b')} = 0 "
            f"AND ({s}.b.x - {s}.a.x) * ({t}.b.x - {t}.a.x) + ({s}.b.y - {s}.a.y) * ({t}.b.y - {t}.a.y) < 0)"
        )
        clash = (
            f"CASE WHEN {t}.i <= {s}.i THEN false WHEN {neighbours} THEN {folds} "
            f"ELSE {_segments_touch(s, t)} END"
        )
        shape = (
            f"named_struct('lo', array_min(transform({es}, {s} -> {s}.a.x)), "
            f"'hi', array_max(transform({es}, {s} -> {s}.a.x)), "
            f"'n', CAST(greatest(1, floor(sqrt(size({es})) / 2)) AS INT))"
        )

        def strip(b: str) -> str:
            left = f"({b}.lo + ({b}.hi - {b}.lo) * {k} / {b}.n)"
            right = f"({b}.lo + ({b}.hi - {b}.lo) * ({k} + 1) / {b}.n)"
            # The outer strips are open, so rounding at their outer sides loses no edge.
            inside = (
                f"filter({es}, {s} -> ({k} = 0 OR greatest({s}.a.x, {s}.b.x) >= {left}) "
                f"AND ({k} = {b}.n - 1 OR least({s}.a.x, {s}.b.x) <= {right}))"
            )
            return let(inside, lambda c: f"exists({c}, {s} -> exists({c}, {t} -> {clash}))")

        return let(shape, lambda b: f"NOT exists(sequence(0, {b}.n - 1), {k} -> {strip(b)})")

    distinct_edges = lambda ring: (
        f"transform(filter({edges_of_ring(ring)}, {s} -> {s}.a <> {s}.b), "
        f"({s}, {i}) -> named_struct('a', {s}.a, 'b', {s}.b, 'i', {i}))"
    )
    ring_ok = let(
        distinct_edges(r),
        lambda es: f"size({es}) >= 3 AND {_ring_area(r)} > 0 AND {simple(es)}",
    )
    return _flag(
        f"CASE WHEN {g}.kind IN ('POINT', 'MULTIPOINT') THEN true "
        f"WHEN {g}.kind IN {LINEAR} THEN forall({g}.parts, {r} -> exists({r}, {p} -> {p} <> {r}[0])) "
        f"WHEN NOT forall({g}.parts, {r} -> {ring_ok}) THEN false "
        f"WHEN size({g}.parts) = 1 THEN true ELSE {_rings_apart(g)} END"
    )


def edges_of_ring(ring: str) -> str:
    p, q = _lambda(2)
    return (
        f"zip_with(slice({ring}, 1, size({ring}) - 1), slice({ring}, 2, size({ring}) - 1), "
        f"({p}, {q}) -> named_struct('a', {p}, 'b', {q}))"
    )


def map_points(g: str, x, y) -> str:
    """Apply ``x(p)`` and ``y(p)`` to every vertex."""
    r, p = _lambda(2)
    return (
        f"CASE WHEN {g} IS NOT NULL THEN named_struct('kind', {g}.kind, 'parts', "
        f"transform({g}.parts, {r} -> transform({r}, {p} -> "
        f"named_struct('x', {x(p)}, 'y', {y(p)})))) END"
    )


# --- the WKT column functions offered to users ----------------------------------------------


def _on_wkt(wkt: str, body) -> str:
    return let(parse_wkt(wkt), body)


def wkt_area(wkt: str) -> str:
    return _on_wkt(wkt, area)


def wkt_length(wkt: str) -> str:
    return _on_wkt(wkt, length)


def wkt_is_valid(wkt: str) -> str:
    return _on_wkt(wkt, is_valid)


def wkt_distance(a: str, b: str) -> str:
    return _on_wkt(a, lambda ga: _on_wkt(b, lambda gb: distance(ga, gb)))


def wkt_intersects(a: str, b: str) -> str:
    return _on_wkt(a, lambda ga: _on_wkt(b, lambda gb: intersects(ga, gb)))


def wkt_within(a: str, b: str) -> str:
    return _on_wkt(a, lambda ga: _on_wkt(b, lambda gb: within(ga, gb)))


def wkt_contains(a: str, b: str) -> str:
    return wkt_within(b, a)


def wkt_buffer(wkt: str, d: str) -> str:
    return _on_wkt(wkt, lambda g: let(buffer_point(g, d), to_wkt))
