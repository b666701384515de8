"""Tile payloads: features are encoded one by one, and sorted ones are put together while they stream by.

Spark quantises, groups and sorts the features; this helper only writes and reads the bytes.  No task holds the
features of a tile as objects: the bytes written so far and the distinct values of one layer are what it keeps.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator
from itertools import repeat

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Field keys and command ids of the public vector-tile 2.1 format.
GEOM_TYPES = {"POINT": 1, "LINESTRING": 2, "POLYGON": 3, "MULTIPOINT": 1, "MULTILINESTRING": 2, "MULTIPOLYGON": 3}
MOVE_TO, LINE_TO, CLOSE_PATH = 1, 2, 7


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append((n & 0x7F) | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, payload: bytes) -> bytes:
    return _varint(number << 3 | 2) + _varint(len(payload)) + payload


def _packed(number: int, values) -> bytes:
    return _field(number, b"".join(map(_varint, values)))


def _zigzag(n: int) -> int:
    return n << 1 if n >= 0 else (-n << 1) - 1


def _ring_turn(ring) -> int:
    return sum(ax * by - bx * ay for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1]))


def _commands(kind: str, parts, shells) -> list[int]:
    out, cx, cy = [], 0, 0

    def draw(command, points):
        nonlocal cx, cy
        out.append(len(points) << 3 | command)
        for x, y in points:
            out.extend((_zigzag(x - cx), _zigzag(y - cy)))
            cx, cy = x, y

    if kind == "MULTIPOINT":
        draw(MOVE_TO, [p for part in parts for p in part])
        return out
    drawn = False  # whether the holes that follow have a shell
    for part, is_shell in zip(parts, shells):
        points = [p for i, p in enumerate(part) if i == 0 or p != part[i - 1]]
        if kind == "POINT":
            draw(MOVE_TO, points[:1])
        elif kind.endswith("LINESTRING"):
            if len(points) > 1:
                draw(MOVE_TO, points[:1])
                draw(LINE_TO, points[1:])
        else:
            if points[0] == points[-1]:
                points = points[:-1]
            turn = _ring_turn(points)
            usable = len(points) >= 3 and turn != 0
            drawn = usable if is_shell else drawn
            if not usable or not drawn:
                continue
            # Shells have a positive turn in tile space (y down), holes a negative one.
            if (turn > 0) != is_shell:
                points.reverse()
            draw(MOVE_TO, points[:1])
            draw(LINE_TO, points[1:])
            out.append(1 << 3 | CLOSE_PATH)
    return out


def _value(v) -> bytes:
    if isinstance(v, bool):
        return _varint(7 << 3) + _varint(int(v))
    if isinstance(v, int):
        return _varint(5 << 3) + _varint(v) if v >= 0 else _varint(6 << 3) + _varint(_zigzag(v))
    if isinstance(v, float):
        return _varint(3 << 3 | 1) + struct.pack("<d", v)
    return _field(1, str(v).encode())


TILES = T.StructType(
    [
        T.StructField("z", T.IntegerType()),
        T.StructField("x", T.IntegerType()),
        T.StructField("y", T.IntegerType()),
        T.StructField("data", T.BinaryType()),
        T.StructField("feature_count", T.LongType()),
    ]
)
# Rows that go out together: as many features, or tiles of so many bytes.
BATCH_ROWS, BATCH_BYTES = 4096, 8 << 20


@F.arrow_udf(T.BinaryType())
def encode_features(kinds: pa.Array, rings: pa.Array, shells: pa.Array, xs: pa.Array, ys: pa.Array) -> pa.Array:
    """Type and geometry fields of features; rings end at places in xs.  NULL for shapes that collapse."""
    points = list(zip(xs.flatten().to_pylist(), ys.flatten().to_pylist()))
    starts = (xs.offsets.to_numpy() - xs.offsets.to_numpy()[0]).tolist() if len(xs) else []
    out = []
    for kind, start, ends, outer in zip(kinds.to_pylist(), starts, rings.to_pylist(), shells.to_pylist()):
        parts = [points[start + a : start + b] for a, b in zip([0, *ends[:-1]], ends)]
        commands = _commands(kind, parts, outer)
        out.append(_varint(3 << 3) + _varint(GEOM_TYPES[kind]) + _packed(4, commands) if commands else None)
    return pa.array(out, pa.binary())


class _VectorLayer:
    """A layer message that grows by features."""

    def __init__(self, name: str):
        self.keys, self.values, self.known, self.features = {}, {}, {}, 0
        self.data = bytearray(_varint(15 << 3) + _varint(2) + _field(1, name.encode()))

    def _tags(self, text: str) -> bytes:
        found = self.known.get(text)
        if found is None:
            tags = []
            for key, value in json.loads(text).items():
                if value is not None:
                    tags.append(self.keys.setdefault(key, len(self.keys)))
                    tags.append(self.values.setdefault(_value(value), len(self.values)))
            if len(self.known) >= BATCH_ROWS:
                self.known.clear()
            found = self.known[text] = _packed(2, tags) if tags else b""
        return found

    def add(self, feature_id: int | None, text: str, body: bytes) -> None:
        message = b"" if feature_id is None or feature_id < 0 else _varint(1 << 3) + _varint(feature_id)
        self.data += _field(2, message + self._tags(text) + body)
        self.features += 1

    def ended(self, extent: int = 4096) -> bytearray:
        """The layer framed as a complete tile message."""
        for key in self.keys:
            self.data += _field(3, key.encode())
        for value in self.values:
            self.data += _field(4, value)
        self.data += _varint(5 << 3) + _varint(extent)
        self.data[:0] = _varint(3 << 3 | 2) + _varint(len(self.data))
        return self.data


class _TextLayer:
    """A FeatureCollection that grows by features; those without a text are counted only."""

    def __init__(self, name: str):
        self.name, self.features, self.data = name, 0, bytearray(b'{"type":"FeatureCollection","features":[')
        self.between = b""

    def add(self, feature_id: int | None, text: str, body: str | None) -> None:
        if body is not None:
            self.data += self.between + body.encode()
            self.between = b","
        self.features += 1

    def ended(self) -> bytearray:
        self.data += b"]}"
        return self.data


def _vector_tile(done: list[tuple[str, bytearray]]) -> bytearray:
    whole = done.pop(0)[1]
    while done:
        whole += done.pop(0)[1]
    return whole


def _text_tile(done: list[tuple[str, bytearray]]) -> bytearray:
    if len(done) == 1:
        return done.pop()[1]
    whole = bytearray()
    while done:
        name, data = done.pop(0)
        whole += (b"," if whole else b"{") + b'"' + name.encode() + b'":'
        whole += data
    whole += b"}"
    return whole


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    """Rows of TILES; the bytes of a tile that is alone are not copied."""
    z, x, y, data, counts = map(list, zip(*rows))
    if len(rows) == 1:
        at = pa.array([0, len(data[0])], pa.int32()).buffers()[1]
        payload = pa.BinaryArray.from_buffers(pa.binary(), 1, [None, at, pa.py_buffer(data[0])])
    else:
        payload = pa.array(map(bytes, data), pa.binary())
    i = pa.int32()
    return pa.RecordBatch.from_arrays([pa.array(z, i), pa.array(x, i), pa.array(y, i), payload, pa.array(counts, pa.int64())], [f.name for f in TILES])


def _put_together(batches: Iterator[pa.RecordBatch], make, join, collapsed: bool) -> Iterator[pa.RecordBatch]:
    """Tiles of rows (``ROW``) that come sorted by tile and layer; rows without a body count only if ``collapsed``."""
    tile, name, layer, done, ready, held = None, None, None, [], [], 0

    def finished():
        nonlocal ready, held
        done.append((name, layer.ended()))
        ready.append((*tile, data := join(done), count))
        held += len(data)
        if held >= BATCH_BYTES or len(ready) >= BATCH_ROWS:
            out, ready, held = ready, [], 0
            yield _batch(out)

    count = 0
    for batch in batches:
        columns = (batch.column(i).to_pylist() for i in range(7))
        for z, x, y, of, feature_id, text, body in zip(*columns):
            if body is None and not collapsed:
                continue
            if tile != (z, x, y):
                if tile is not None:
                    yield from finished()
                tile, name, layer, count = (z, x, y), of, make(of), 0
            elif name != of:
                done.append((name, layer.ended()))
                name, layer = of, make(of)
            layer.add(feature_id, text, body)
            count += 1
    if tile is not None:
        yield from finished()
    if ready:
        yield _batch(ready)


def _vector_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _put_together(batches, _VectorLayer, _vector_tile, False)


def _text_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _put_together(batches, _TextLayer, _text_tile, True)


ROW = ["z", "x", "y", "layer", "feature_id", "properties", "body"]


def write_tiles(features: DataFrame, vector: bool) -> DataFrame:
    """``z, x, y, data, feature_count`` of features (``ROW``), sorted by id within a layer.

    A tile is written by one task, from rows that Spark sorts on disk if need be.
    """
    order = ["z", "x", "y", "layer", F.col("feature_id").isNull(), F.coalesce("feature_id", F.lit(0)), "body", "properties"]
    rows = features.select(*ROW).repartition("z", "x", "y").sortWithinPartitions(*order)
    return rows.mapInArrow(_vector_tiles if vector else _text_tiles, TILES)


def _arrow(schema: T.StructType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(schema)


# --- reading back ---------------------------------------------------------------------------

FEATURE = T.ArrayType(
    T.StructType(
        [
            T.StructField("layer", T.StringType()),
            T.StructField("id", T.LongType()),
            T.StructField("type", T.IntegerType()),
            T.StructField("xs", T.ArrayType(T.IntegerType())),
            T.StructField("ys", T.ArrayType(T.IntegerType())),
        ]
    )
)


def _number(data: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        byte = data[at]
        n |= (byte & 0x7F) << shift
        at, shift = at + 1, shift + 7
        if byte < 0x80:
            return n, at


def _message(data: bytes):
    at = 0
    while at < len(data):
        tag, at = _number(data, at)
        if tag & 7 == 2:
            size, at = _number(data, at)
            yield tag >> 3, data[at : at + size]
            at += size
        elif tag & 7 == 0:
            value, at = _number(data, at)
            yield tag >> 3, value
        else:
            at += 8 if tag & 7 == 1 else 4


def _vertices(packed: bytes) -> tuple[list[int], list[int]]:
    at, x, y, xs, ys = 0, 0, 0, [], []
    while at < len(packed):
        command, at = _number(packed, at)
        if command & 7 == CLOSE_PATH:
            continue
        for _ in range(command >> 3):
            dx, at = _number(packed, at)
            dy, at = _number(packed, at)
            x += (dx >> 1) ^ -(dx & 1)
            y += (dy >> 1) ^ -(dy & 1)
            xs.append(x)
            ys.append(y)
    return xs, ys


def _features(data) -> Iterator[tuple]:
    """(layer, id, type, xs, ys) of the features of a tile, one after another."""
    for _, layer in _message(memoryview(data).cast("B")):
        name = next(str(v, "utf-8") for k, v in _message(layer) if k == 1)
        for key, body in _message(layer):
            if key == 2:
                feature = dict(_message(bytes(body)))
                yield (name, feature.get(1), feature[3], *_vertices(feature[4]))


_NAMES = ("layer", "id", "type", "xs", "ys")


def read_tile(data: bytes) -> list[dict]:
    return [dict(zip(_NAMES, f)) for f in _features(data)]


@F.arrow_udf(T.LongType())
def count_features(data: pa.Array) -> pa.Array:
    """Number of features that can be read from tiles."""
    return pa.array([sum(1 for _ in _features(d.as_buffer())) if d.is_valid else None for d in data], pa.int64())


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = _arrow(FEATURES)
    schema = pa.schema(list(schema))

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    rows = []
    for tiles in batches:
        z, x, y = (tiles.column(i).to_pylist() for i in range(3))
        for i, data in enumerate(tiles.column(3)):
            for address, feature in zip(repeat((z[i], x[i], y[i])), _features(data.as_buffer())):
                rows.append(address + feature)
                if len(rows) >= BATCH_ROWS:
                    yield batch(rows)
                    rows = []
    if rows:
        yield batch(rows)


FEATURES = T.StructType([*TILES.fields[:3], *FEATURE.elementType.fields])


def read_features(tiles: DataFrame) -> DataFrame:
    """Features of tiles as rows (``z, x, y, layer, id, type, xs, ys``), read while they stream by."""
    return tiles.select("z", "x", "y", "data").filter("data IS NOT NULL").mapInArrow(_read, FEATURES)


@F.arrow_udf(FEATURE)
def read_tiles(data: pa.Array) -> pa.Array:
    """Features (layer, id, type, xs, ys) of tiles, as arrays; crowded tiles are better read by ``read_features``."""
    return pa.array([read_tile(d.as_py()) for d in data], _arrow(FEATURE))
