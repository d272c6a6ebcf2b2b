"""One-degree tiles named after their top-left corner: [N|S]dd_[E|W]ddd."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the form of a tile's name.
TILE = r"^([NS])(\d{2})_([EW])(\d{3})$"


def corner_tile(x: Column, y: Column) -> Column:
    """Name of the tile whose west edge is x and whose north edge is y, whole degrees."""
    north, east = F.abs(y).cast("int"), F.abs(x).cast("int")
    # not format_string, which reads its form anew for every row
    return F.concat(F.when(y < 0, "S").otherwise("N"), F.when(north < 10, "0").otherwise(""), north.cast("string"), F.when(x < 0, "_W").otherwise("_E"), F.when(east < 10, "00").when(east < 100, "0").otherwise(""), east.cast("string"))


def tile_of(lon: Column, lat: Column) -> Column:
    """Tile of a point: west and north edges belong to it, east and south ones don't. Null for null or NaN."""
    there = lon.isNotNull() & lat.isNotNull() & ~F.isnan(lon) & ~F.isnan(lat)
    return F.when(there, corner_tile(F.floor(lon), F.ceil(lat)))


def tile_bounds(tile: Column, strict: bool = False) -> dict[str, Column]:
    """minx, miny, maxx, maxy of a tile id. An id of another form gives nulls, or with strict an error."""
    if strict:
        tile = F.when(tile.rlike(TILE), tile).otherwise(F.raise_error(F.concat(F.lit("not a tile id: "), F.coalesce(tile, F.lit("null")))).cast("string"))
    number = lambda sign, i, low: F.when(F.regexp_extract(tile, TILE, sign) == low, -1).otherwise(1) * F.regexp_extract(tile, TILE, i).try_cast("int")
    x, y = number(3, 4, "W"), number(1, 2, "S")
    return {"minx": x, "miny": y - 1, "maxx": x + 1, "maxy": y}


def curve(lon: Column, lat: Column) -> Column:
    """Place of a point on the Morton curve of its tile: sixteen bits of each coordinate's share of a degree, taken in
    turn, so that points near each other on the curve are near each other on the ground."""

    def apart(share: Column) -> Column:
        v = F.least(F.floor(share * 65_536), F.lit(65_535).cast("long"))
        for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
            v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask).cast("long"))
        return v

    return apart(lon - F.floor(lon)).bitwiseOR(F.shiftleft(apart(lat - F.floor(lat)), 1))
