"""Tile addresses, boxes and tolerances as SQL expression text."""

from __future__ import annotations

from geoloom.functions.geometry import edges, let, map_points
from geoloom.functions.geometry import _lambda, _odd_crossings, _turn
from geoloom.rules import MAX_MERCATOR_LAT, MERCATOR_RADIUS_M

EXTENT = 4096
TILE_SIZE = 256
BUFFER = 64


def world_x(lon: str, z: str) -> str:
    """Horizontal position in tile widths from the left edge of the world."""
    return f"(({lon} + 180D) / 360D * pow(2D, {z}))"


def world_y(lat: str, z: str) -> str:
    """Vertical position in tile heights from the top, latitude clamped to the square world."""
    clamped = f"greatest(-{MAX_MERCATOR_LAT}D, least({MAX_MERCATOR_LAT}D, {lat}))"
    return f"((1D - asinh(tan(radians({clamped}))) / pi()) / 2D * pow(2D, {z}))"


def _index(position: str, z: str) -> str:
    return f"CAST(greatest(0D, least(pow(2D, {z}) - 1, CAST(floor({position}) AS DOUBLE))) AS INT)"


def tile_x(lon: str, z: str) -> str:
    return _index(world_x(lon, z), z)


def tile_y(lat: str, z: str) -> str:
    return _index(world_y(lat, z), z)


def lon_left(x: str, z: str) -> str:
    return f"({x} / pow(2D, {z}) * 360D - 180D)"


def lat_top(y: str, z: str) -> str:
    return f"degrees(atan(sinh(pi() * (1D - 2D * {y} / pow(2D, {z})))))"


def tile_box(z: str, x: str, y: str) -> str:
    return (
        f"named_struct('x0', {lon_left(x, z)}, 'y0', {lat_top(f'({y} + 1)', z)}, "
        f"'x1', {lon_left(f'({x} + 1)', z)}, 'y1', {lat_top(y, z)})"
    )


def buffered_box(b: str, buffer: int = BUFFER, tile_size: int = TILE_SIZE) -> str:
    """Grow a box on every side by ``buffer / tile_size`` of its own width and height."""
    f = repr(buffer / tile_size) + "D"
    w, h = f"({b}.x1 - {b}.x0)", f"({b}.y1 - {b}.y0)"
    return (
        f"named_struct('x0', {b}.x0 - {f} * {w}, 'y0', {b}.y0 - {f} * {h}, "
        f"'x1', {b}.x1 + {f} * {w}, 'y1', {b}.y1 + {f} * {h})"
    )


def pyramid_tolerance(z: str) -> str:
    """Tolerance of the zoom pyramid: halves per zoom from 0.001 degrees at zoom 1."""
    return f"CASE WHEN {z} > 1 THEN 0.001D / pow(2D, {z} - 1) ELSE 0.001D END"


def tile_tolerance(base: str, z: str) -> str:
    """Tolerance inside a tile: the layer's base at zoom 14, doubling per zoom below it."""
    return f"({base} * pow(2D, 14 - {z}))"


def to_tile_coords(g: str, b: str, projection: str = "linear") -> str:
    """Vertices in 0..4096 tile units with y pointing down."""
    if projection == "linear":
        y = lambda p: f"(1D - ({p}.y - {b}.y0) / ({b}.y1 - {b}.y0)) * {EXTENT}D"
    elif projection == "mercator":
        my = lambda v: f"asinh(tan(radians({v})))"
        y = lambda p: (
            f"({my(f'{b}.y1')} - {my(f'{p}.y')}) / ({my(f'{b}.y1')} - {my(f'{b}.y0')}) * {EXTENT}D"
        )
    else:
        raise ValueError(f"Unsupported projection: {projection}")
    x = lambda p: f"({p}.x - {b}.x0) / ({b}.x1 - {b}.x0) * {EXTENT}D"
    return map_points(g, x, y)


def reproject(g: str, source_epsg: int, target_epsg: int) -> str:
    """Closed-form conversion between EPSG:4326 and EPSG:3857."""
    if {source_epsg, target_epsg} - {4326, 3857}:
        raise ValueError(f"Unsupported CRS pair: {source_epsg} to {target_epsg}")
    if source_epsg == target_epsg:
        return g
    r = f"{MERCATOR_RADIUS_M!r}D"
    if target_epsg == 3857:
        return map_points(
            g,
            lambda p: f"radians({p}.x) * {r}",
            lambda p: f"asinh(tan(radians({p}.y))) * {r}",
        )
    return map_points(
        g,
        lambda p: f"degrees({p}.x / {r})",
        lambda p: f"degrees(atan(sinh({p}.y / {r})))",
    )


def edge_meets_box(e: str, b: str) -> str:
    """The segment and the closed box share a point: boxes overlap, corners on both sides."""
    corner = lambda x, y: f"named_struct('x', {b}.{x}, 'y', {b}.{y})"
    turns = ", ".join(
        _turn(f"{e}.a", f"{e}.b", corner(x, y)) for x in ("x0", "x1") for y in ("y0", "y1")
    )
    sides = let(f"array({turns})", lambda t: f"array_min({t}) <= 0 AND array_max({t}) >= 0")
    return (
        f"(greatest({e}.a.x, {e}.b.x) >= {b}.x0 AND least({e}.a.x, {e}.b.x) <= {b}.x1 "
        f"AND greatest({e}.a.y, {e}.b.y) >= {b}.y0 AND least({e}.a.y, {e}.b.y) <= {b}.y1 "
        f"AND {sides})"
    )


def meets_box(g: str, b: str) -> str:
    """The geometry and the closed box share a point."""
    e = _lambda()[0]
    corner = f"named_struct('x', {b}.x0, 'y', {b}.y0)"
    surrounds = lambda es: (
        f"({g}.kind IN ('POLYGON', 'MULTIPOLYGON') AND {let(corner, lambda p: _odd_crossings(p, es))})"
    )
    p = f"{g}.parts[0][0]"
    in_box = f"({p}.x BETWEEN {b}.x0 AND {b}.x1 AND {p}.y BETWEEN {b}.y0 AND {b}.y1)"
    general = let(
        edges(g), lambda es: f"(exists({es}, {e} -> {edge_meets_box(e, b)}) OR {surrounds(es)})"
    )
    return f"coalesce(CASE WHEN {g}.kind = 'POINT' THEN {in_box} ELSE {general} END, false)"


def morton(x: str, y: str, bits: int) -> str:
    """Interleave tile indices, so near tiles get near keys."""
    terms = [
        f"shiftleft(CAST(shiftright({v}, {i}) & 1 AS BIGINT), {2 * i + o})"
        for i in range(bits)
        for o, v in ((0, x), (1, y))
    ]
    return "(" + " | ".join(terms) + ")"
