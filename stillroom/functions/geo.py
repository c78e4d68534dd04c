"""Points, lines and polygons as nested arrays, so that every operation stays a built-in expression.

A value is ``struct<kind, shapes>``; ``shapes`` nests shape → ring → vertex. A point is one shape of one
ring of one vertex. Longitude comes first, as in well-known text.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

VERTEX = T.StructType([T.StructField("lon", T.DoubleType()), T.StructField("lat", T.DoubleType())])
#: Columns, and rows, of the grid under the space-filling curve.
GRID = 1 << 16
GEOGRAPHY = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("shapes", T.ArrayType(T.ArrayType(T.ArrayType(VERTEX)))),
    ]
)

# The nesting of brackets each kind of well-known text has, after number text is dropped and
# neighbours are merged ("r" vertex lists, "p" a bracket of vertex lists).
OUTLINES = {
    "point": ("r",),
    "linestring": ("r",),
    "multipoint": ("r", "p"),
    "multilinestring": ("p",),
    "polygon": ("p",),
    "multipolygon": ("(p)",),
}
AREAL = ("polygon", "multipolygon")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_geography(data_type: T.DataType) -> bool:
    """True for the struct layout above, whatever its nullability flags."""
    return data_type.simpleString() == GEOGRAPHY.simpleString()


def _let(value: Column, body) -> Column:
    """Bind a value to a name inside one expression, so that using it several times computes it once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _outline(body: Column) -> Column:
    brackets = F.regexp_replace(body, r"[^(),]+", "")
    lists = F.regexp_replace(F.regexp_replace(brackets, r"\(,*\)", "r"), r"r,(?=r)", "")
    return F.regexp_replace(F.regexp_replace(lists, r"\(r\)", "p"), r"p,(?=p)", "")


def _malformed(text: Column, as_type) -> Column:
    return F.raise_error(F.concat(F.lit("malformed geography text: "), text)).cast(as_type)


def _vertex(text: Column, whole: Column) -> Column:
    def numbers(parts: Column) -> Column:
        bad = _malformed(whole, "double")
        lat = F.when(F.get(parts, F.lit(2)).isNull(), F.get(parts, F.lit(1)).try_cast("double"))
        return F.struct(
            F.coalesce(F.get(parts, F.lit(0)).try_cast("double"), bad).alias("lon"), F.coalesce(lat, bad).alias("lat")
        )

    return _let(F.split(F.trim(text), r"\s+"), numbers)


def wkt_to_geo(text: Column | str) -> Column:
    """``CAST(text AS GEOGRAPHY)``; NULL stays NULL and malformed text raises."""
    text = _col(text)

    def split_kind(whole: Column) -> Column:
        kind = F.lower(F.regexp_extract(whole, r"^\s*([A-Za-z]+)", 1))
        body = F.trim(F.regexp_replace(whole, r"^\s*[A-Za-z]+\s*", ""))
        return F.struct(whole.alias("whole"), kind.alias("kind"), body.alias("body"))

    def check(v: Column) -> Column:
        fitting = F.concat_ws(" ", v["kind"], v["outline"]).isin([f"{name} {o}" for name, allowed in OUTLINES.items() for o in allowed])
        single = (v["kind"] != "point") | ~v["body"].contains(",")
        empty = (F.lower(v["body"]) == "empty") & v["kind"].isin(*OUTLINES)
        return F.when(empty, F.lit("empty")).when(fitting & single, v["kind"])

    def levels(v: Column) -> Column:
        # Bring every kind to three levels, then take the levels apart from the outside in.
        flat = F.regexp_replace(v["body"], r"^[\s(]+|[\s)]+$", "")
        many_points = F.regexp_replace(F.regexp_replace(flat, r"[()]", ""), r"\s*,\s*", ")),((")
        many_lines = F.regexp_replace(flat, r"\)\s*,\s*\(", ")),((")
        levelled = F.when(v["kind"] == "multipoint", many_points).when(v["kind"] == "multilinestring", many_lines).otherwise(flat)
        return F.transform(
            F.split(levelled, r"\)\s*\)\s*,\s*\(\s*\("),
            lambda shape: F.transform(
                F.split(shape, r"\)\s*,\s*\("),
                lambda ring: F.transform(F.split(ring, ","), lambda vertex: _vertex(vertex, v["whole"])),
            ),
        )

    def value(v: Column) -> Column:
        none = F.array().cast(GEOGRAPHY["shapes"].dataType)
        shapes = (
            F.when(v["found"] == "empty", none)
            .when(v["found"].isNotNull(), levels(v))
            .otherwise(_malformed(v["whole"], none_type))
        )
        return F.struct(v["kind"].alias("kind"), shapes.alias("shapes"))

    none_type = GEOGRAPHY["shapes"].dataType
    parsed = _let(
        split_kind(text),
        lambda a: _let(
            F.struct(a["whole"].alias("whole"), a["kind"].alias("kind"), a["body"].alias("body"), _outline(a["body"]).alias("outline")),
            lambda b: _let(
                F.struct(b["whole"].alias("whole"), b["kind"].alias("kind"), b["body"].alias("body"), check(b).alias("found")), value
            ),
        ),
    )
    return F.when(text.isNotNull(), parsed)


def geo_to_wkt(geo: Column | str) -> Column:
    """Well-known text of a value, for export."""
    geo = _col(geo)
    kind, shapes = geo["kind"], geo["shapes"]

    def vertex(v: Column) -> Column:
        return F.concat_ws(" ", v["lon"].cast("string"), v["lat"].cast("string"))

    def ring(r: Column) -> Column:
        return F.concat(F.lit("("), F.array_join(F.transform(r, vertex), ", "), F.lit(")"))

    def shape(s: Column) -> Column:
        return F.concat(F.lit("("), F.array_join(F.transform(s, ring), ", "), F.lit(")"))

    def wrapped(inner: Column) -> Column:
        return F.concat(F.lit("("), F.array_join(inner, ", "), F.lit(")"))

    first = F.get(shapes, F.lit(0))
    text = (
        F.when(F.size(shapes) == 0, F.lit("empty"))
        .when(kind.isin("point", "linestring"), ring(F.get(first, F.lit(0))))
        .when(kind == "polygon", shape(first))
        .when(kind.isin("multipoint", "multilinestring"), wrapped(F.transform(shapes, lambda s: ring(F.get(s, F.lit(0))))))
        .otherwise(wrapped(F.transform(shapes, shape)))
    )
    return F.concat(kind, F.lit(" "), text)


def point(lon: Column | str, lat: Column | str) -> Column:
    vertex = F.struct(_col(lon).cast("double").alias("lon"), _col(lat).cast("double").alias("lat"))
    return F.struct(F.lit("point").alias("kind"), F.array(F.array(F.array(vertex))).alias("shapes"))


def longitude(geo: Column | str) -> Column:
    """Longitude of the first vertex; NULL for an empty value."""
    return F.get(F.get(F.get(_col(geo)["shapes"], F.lit(0)), F.lit(0)), F.lit(0))["lon"]


def latitude(geo: Column | str) -> Column:
    return F.get(F.get(F.get(_col(geo)["shapes"], F.lit(0)), F.lit(0)), F.lit(0))["lat"]


def in_box(lon: Column | str, lat: Column | str, min_lon: float, max_lon: float, min_lat: float, max_lat: float) -> Column:
    """Bounding-box test on two doubles, borders included; both ranges push down to the scan. A box whose west lies east
    of its east reaches over the date line."""
    across = _col(lon).between(min_lon, max_lon) if min_lon <= max_lon else (_col(lon) >= min_lon) | (_col(lon) <= max_lon)
    return across & _col(lat).between(min_lat, max_lat)


def cell(lon: Column | str, lat: Column | str) -> Column:
    """The place of a point on a space-filling curve (32 bits: those of its column and row in a grid of 65,536 each way,
    interleaved), so that points that lie near each other have near places. NULL where a coordinate is."""

    def spread(value: Column) -> Column:
        for by, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
            value = value.bitwiseOR(F.shiftleft(value, by)).bitwiseAND(F.lit(mask).cast("long"))
        return value

    def step(value: Column, low: float, width: float) -> Column:
        return F.least(F.greatest(F.floor((value - low) / width * GRID), F.lit(0)), F.lit(GRID - 1)).cast("long")

    x, y = step(_col(lon), -180.0, 360.0), step(_col(lat), -90.0, 180.0)
    return F.shiftleft(spread(x), 1).bitwiseOR(spread(y))


def box_cells(min_lon: float, max_lon: float, min_lat: float, max_lat: float, most: int = 64) -> list[tuple[int, int]]:
    """Ranges of places on the curve of ``cell`` that cover a box, about ``most`` of them, in order. A box whose west lies
    east of its east reaches over the date line."""
    if min_lon > max_lon:
        parts = [*box_cells(min_lon, 180.0, min_lat, max_lat, most // 2), *box_cells(-180.0, max_lon, min_lat, max_lat, most // 2)]
        return _merged_ranges(parts)
    if min_lat > max_lat:
        return []

    def step(value: float, low: float, width: float) -> int:
        return min(max(math.floor((value - low) / width * GRID), 0), GRID - 1)

    west, east = step(min_lon, -180.0, 360.0), step(max_lon, -180.0, 360.0)
    south, north = step(min_lat, -90.0, 180.0), step(max_lat, -90.0, 180.0)
    inside, open_quads, size = [], [(0, 0, 0)], GRID  # (first place, column, row) of quads of one size
    while open_quads and size > 1 and len(inside) + len(open_quads) < most:
        size //= 2
        halves, open_quads = open_quads, []
        for first, x, y in halves:
            for k, (dx, dy) in enumerate(((0, 0), (0, size), (size, 0), (size, size))):
                a, b, start = x + dx, y + dy, first + k * size * size
                if a > east or a + size - 1 < west or b > north or b + size - 1 < south:
                    continue
                whole = west <= a and a + size - 1 <= east and south <= b and b + size - 1 <= north
                if whole:
                    inside.append((start, start + size * size - 1))
                else:
                    open_quads.append((start, a, b))
    return _merged_ranges([*inside, *((start, start + size * size - 1) for start, _, _ in open_quads)])


def _merged_ranges(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for low, high in sorted(ranges):
        if merged and low <= merged[-1][1] + 1:
            merged[-1] = merged[-1][0], max(merged[-1][1], high)
        else:
            merged.append((low, high))
    return merged


def ring_area(ring: Column) -> Column:
    """Signed flat area of one ring: positive when its vertices run counter-clockwise."""
    origin = F.get(ring, F.lit(0))
    shifted = F.concat(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))

    def cross(a: Column, b: Column) -> Column:
        ax, ay = a["lon"] - origin["lon"], a["lat"] - origin["lat"]
        bx, by = b["lon"] - origin["lon"], b["lat"] - origin["lat"]
        return ax * by - bx * ay

    return F.aggregate(F.zip_with(ring, shifted, cross), F.lit(0.0), lambda total, x: total + x) / 2


def signed_areas(geo: Column | str) -> Column:
    """Signed area of every ring, nested by shape."""
    return F.transform(_col(geo)["shapes"], lambda shape: F.transform(shape, ring_area))


def _map_rings(geo: Column, change) -> Column:
    shapes = F.transform(geo["shapes"], lambda shape: F.transform(shape, change))
    changed = F.struct(geo["kind"].alias("kind"), shapes.alias("shapes"))
    return F.when(geo["kind"].isin(*AREAL), changed).otherwise(geo)


def invert_vertex_order(geo: Column | str) -> Column:
    """Turn every polygon ring around; other kinds and NULL pass through."""
    return _map_rings(_col(geo), lambda ring: F.reverse(ring))


def auto_vertex_order(geo: Column | str) -> Column:
    """Interior to the left for flat-earth input: outer rings counter-clockwise, holes clockwise."""

    def oriented(ring: Column, position: Column) -> Column:
        area = ring_area(ring)
        wrong = F.when(position == 0, area < 0).otherwise(area > 0)
        return F.when(wrong, F.reverse(ring)).otherwise(ring)

    return _map_rings(_col(geo), oriented)
