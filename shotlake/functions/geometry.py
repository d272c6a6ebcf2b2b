"""Planar predicates on polygons kept as array<array<struct<x, y>>> (rings, holes among them), and distances."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RINGS = "array<array<struct<x:double,y:double>>>"


def box_rings(minx: Column, miny: Column, maxx: Column, maxy: Column) -> Column:
    """A box as a polygon."""
    point = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    return F.array(F.array(point(minx, miny), point(maxx, miny), point(maxx, maxy), point(minx, maxy), point(minx, miny)))


def edges(rings: Column) -> Column:
    """array<struct<ax, ay, bx, by>> of all rings; a ring that isn't closed is."""

    def of(ring: Column) -> Column:
        n = F.size(ring)
        at = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
        link = lambda a, b: F.struct(a["x"].alias("ax"), a["y"].alias("ay"), b["x"].alias("bx"), b["y"].alias("by"))
        return F.transform(at, lambda i: link(ring[i], ring[F.pmod(i + 1, n)]))

    return F.flatten(F.transform(rings, of))


def parity(edges_: Column, x: Column, y: Column) -> Column:
    """Whether an odd number of edges crosses the ray from the point to greater x."""

    def crosses(e: Column) -> Column:
        return ((e["ay"] > y) != (e["by"] > y)) & (x < _x_at(e, y))

    return F.size(F.filter(edges_, lambda e: F.coalesce(crosses(e), F.lit(False)))) % 2 == 1


def _x_at(e: Column, y: Column) -> Column:
    return (e["bx"] - e["ax"]) * (y - e["ay"]) / F.when(e["by"] != e["ay"], e["by"] - e["ay"]) + e["ax"]


def _touches(e: Column, x: Column, y: Column) -> Column:
    turn = (e["bx"] - e["ax"]) * (y - e["ay"]) - (e["by"] - e["ay"]) * (x - e["ax"])
    within = x.between(F.least(e["ax"], e["bx"]), F.greatest(e["ax"], e["bx"])) & y.between(F.least(e["ay"], e["by"]), F.greatest(e["ay"], e["by"]))
    return (turn == 0) & within


def contains(edges_: Column, x: Column, y: Column) -> Column:
    """Whether the point lies inside, the boundary not counted (even-odd rule, so holes are outside)."""
    return F.coalesce(parity(edges_, x, y) & ~F.exists(edges_, lambda e: _touches(e, x, y)), F.lit(False))


#: Share of a cell's height, from its south side, at which its reference point lies on the east side: no likely corner.
LEVEL = 0.6180339887498949


def parity_in_cell(near: Column, known: Column, east: Column, level: Column, x: Column, y: Column) -> Column:
    """parity for a point of a cell, from the edges that meet the closed cell and the parity of (east, level) on its
    east side: the ray is followed to that side and along it to the known point, and leaves the cell nowhere. Where an
    edge crosses the side is asked once, so that ray and side agree on it."""

    def crosses(e: Column) -> Column:
        straddles = (e["ax"] > east) != (e["bx"] > east)
        at = F.when(e["bx"] == east, e["by"]).otherwise((e["by"] - e["ay"]) * (east - e["ax"]) / F.when(straddles, e["bx"] - e["ax"]) + e["ay"])
        below = y < at
        top_is_east = F.when(e["ay"] > e["by"], e["ax"]).otherwise(e["bx"]) > east
        beyond = F.when(straddles, below != top_is_east).otherwise(e["ax"] > east)
        along = ((e["ay"] > y) != (e["by"] > y)) & (x < _x_at(e, y)) & ~beyond
        aside = straddles & (below != (level < at))
        return F.coalesce(along, F.lit(False)) != F.coalesce(aside, F.lit(False))

    return (F.size(F.filter(near, crosses)) % 2 == 1) != known


def contains_in_cell(near: Column, known: Column, east: Column, level: Column, x: Column, y: Column) -> Column:
    """contains for a point of a cell, by parity_in_cell."""
    return F.coalesce(parity_in_cell(near, known, east, level, x, y) & ~F.exists(near, lambda e: _touches(e, x, y)), F.lit(False))


def sides_of_180(rings: Column) -> Column:
    """array of rings: a polygon with an edge of more than 180 degrees of longitude is taken to cross the 180th meridian the
    short way, and given twice, as it lies beyond the east end of the map and beyond the west one; others once. Polygons that
    hold a pole aren't known as such."""
    steps = F.transform(rings, lambda r: F.transform(r, lambda p: p["x"]))
    wide = F.exists(steps, lambda xs: F.exists(F.sequence(F.lit(1), F.greatest(F.size(xs) - 1, F.lit(1))), lambda i: F.abs(F.get(xs, i) - F.get(xs, i - 1)) > 180))
    moved = lambda by: F.transform(rings, lambda r: F.transform(r, lambda p: F.struct((F.when(p["x"] < 0, p["x"] + 360).otherwise(p["x"]) + by).alias("x"), p["y"].alias("y"))))
    return F.when(F.coalesce(wide, F.lit(False)), F.array(moved(0.0), moved(-360.0))).otherwise(F.array(rings.cast(RINGS)))


def edge_meets_box(e: Column, minx: Column, miny: Column, maxx: Column, maxy: Column) -> Column:
    """Whether a segment and a closed box have a point in common, by separating axes: that across the segment is asked only
    where it is aslant."""
    dx, dy = e["bx"] - e["ax"], e["by"] - e["ay"]
    side = lambda x, y: dx * (y - e["ay"]) - dy * (x - e["ax"])
    corners = [side(x, y) for x in (minx, maxx) for y in (miny, maxy)]
    apart = (
        (F.greatest(e["ax"], e["bx"]) < minx)
        | (F.least(e["ax"], e["bx"]) > maxx)
        | (F.greatest(e["ay"], e["by"]) < miny)
        | (F.least(e["ay"], e["by"]) > maxy)
        | ((dx != 0) & (dy != 0) & ((F.least(*corners) > 0) | (F.greatest(*corners) < 0)))
    )
    return ~apart


def extent(rings: Column) -> dict[str, Column]:
    """minx, miny, maxx, maxy of a polygon."""
    xs, ys = (F.flatten(F.transform(rings, lambda r: F.transform(r, lambda p: p[c]))) for c in ("x", "y"))
    return {"minx": F.array_min(xs), "miny": F.array_min(ys), "maxx": F.array_max(xs), "maxy": F.array_max(ys)}


# The WGS84 ellipsoid.
MAJOR, FLATTENING = 6378137.0, 1 / 298.257223563
MINOR = MAJOR * (1 - FLATTENING)
MEAN_RADIUS = 6371000.0

#: Steps of Vincenty's inverse formula (1975), with the longitude iterated ROUNDS times. {lat1} to {lon2} are
#: degrees; expressions are of the SQL that Spark and other engines share.
ROUNDS = 5


def distance_steps(lat1: str, lon1: str, lat2: str, lon2: str) -> list[tuple[str, str]]:
    """(name, expression) in order, each using earlier names; the last is distance_m."""
    f = repr(FLATTENING)
    num = lambda x: f"CAST({x!r} AS DOUBLE)"
    f = num(FLATTENING)
    steps = [
        ("v_l", f"radians({lon2} - {lon1})"),
        ("v_u1", f"atan((1 - {f}) * tan(radians({lat1})))"),
        ("v_u2", f"atan((1 - {f}) * tan(radians({lat2})))"),
        ("v_s1", "sin(v_u1)"),
        ("v_c1", "cos(v_u1)"),
        ("v_s2", "sin(v_u2)"),
        ("v_c2", "cos(v_u2)"),
        ("v_lam0", "v_l"),
    ]
    for i in range(1, ROUNDS + 1):
        lam = f"v_lam{i - 1}"
        steps += [
            (f"v_ss{i}", f"sqrt((v_c2 * sin({lam})) * (v_c2 * sin({lam})) + (v_c1 * v_s2 - v_s1 * v_c2 * cos({lam})) * (v_c1 * v_s2 - v_s1 * v_c2 * cos({lam})))"),
            (f"v_cs{i}", f"v_s1 * v_s2 + v_c1 * v_c2 * cos({lam})"),
            (f"v_sg{i}", f"atan2(v_ss{i}, v_cs{i})"),
            (f"v_sa{i}", f"CASE WHEN v_ss{i} = 0 THEN 0 ELSE v_c1 * v_c2 * sin({lam}) / v_ss{i} END"),
            (f"v_ca{i}", f"1 - v_sa{i} * v_sa{i}"),
            (f"v_cm{i}", f"CASE WHEN v_ca{i} = 0 THEN 0 ELSE v_cs{i} - 2 * v_s1 * v_s2 / v_ca{i} END"),
            (f"v_k{i}", f"{f} / 16 * v_ca{i} * (4 + {f} * (4 - 3 * v_ca{i}))"),
            (f"v_lam{i}", f"v_l + (1 - v_k{i}) * {f} * v_sa{i} * (v_sg{i} + v_k{i} * v_ss{i} * (v_cm{i} + v_k{i} * v_cs{i} * (2 * v_cm{i} * v_cm{i} - 1)))"),
        ]
    i = ROUNDS
    second = num((MAJOR**2 - MINOR**2) / MINOR**2)
    steps += [
        ("v_uu", f"v_ca{i} * {second}"),
        ("v_a", "1 + v_uu / 16384 * (4096 + v_uu * (-768 + v_uu * (320 - 175 * v_uu)))"),
        ("v_b", "v_uu / 1024 * (256 + v_uu * (-128 + v_uu * (74 - 47 * v_uu)))"),
        ("v_ds", f"v_b * v_ss{i} * (v_cm{i} + v_b / 4 * (v_cs{i} * (2 * v_cm{i} * v_cm{i} - 1) - v_b / 6 * v_cm{i} * (4 * v_ss{i} * v_ss{i} - 3) * (4 * v_cm{i} * v_cm{i} - 3)))"),
        ("distance_m", f"{num(MINOR)} * v_a * (v_sg{i} - v_ds)"),
    ]
    return steps


def earth_centred(lat: Column, lon: Column) -> list[Column]:
    """x, y, z in metres of a point on the ellipsoid. No way along the ellipsoid is shorter than the straight line."""
    square = FLATTENING * (2 - FLATTENING)
    normal = F.lit(MAJOR) / F.sqrt(1 - F.lit(square) * F.sin(F.radians(lat)) * F.sin(F.radians(lat)))
    flat = normal * F.cos(F.radians(lat))
    return [flat * F.cos(F.radians(lon)), flat * F.sin(F.radians(lon)), normal * (1 - square) * F.sin(F.radians(lat))]


def bent(straight: Column) -> Column:
    """The way along the ellipsoid between points of a straight distance of at most some kilometres: an arc of the earth's
    mean radius. The ellipsoid's radii differ from that by up to 1 %: below 0.2 micrometres at a kilometre, far less below."""
    return straight * (1 + straight * straight / (24 * MEAN_RADIUS**2))


def with_distance(df: DataFrame, lat1: str, lon1: str, lat2: str, lon2: str) -> DataFrame:
    """df and distance_m between two points on the ellipsoid. The result passes through explode, so that filters on
    it stay above the steps instead of being unfolded into all of them."""
    names = df.columns
    for name, expression in distance_steps(lat1, lon1, lat2, lon2):
        df = df.withColumn(name, F.expr(expression))
    return df.select(*names, F.explode(F.array("distance_m")).alias("distance_m"))
