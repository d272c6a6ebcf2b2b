"""The plan of a build: which granules belong to which tiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shotlake.functions.tiles import corner_tile
from shotlake.operators.spatial import covering_cells, covering_tiles


def plan_tiles(regions: DataFrame, granules: DataFrame, accessed, apart: tuple[str, ...] = ()) -> DataFrame:
    """Rows of granules for each tile that covers the regions and that a polygon of theirs meets, with tile_id and
    cmr_access_time. Tiles are generated from each polygon's extent; nothing is compared with all tiles. A granule's
    polygon that crosses the 180th meridian meets the tiles on both sides of it. apart: as in catalog.roll_up."""
    polygons = granules.withColumn("rings", F.explode("polygons"))
    cells = covering_cells(polygons, across=True).withColumn("tile_id", corner_tile(F.col("minx"), F.col("maxy")))
    wanted = covering_tiles(regions).select("tile_id")
    plan = cells.join(wanted, "tile_id", "left_semi").drop("rings", "minx", "miny", "maxx", "maxy", "inside")
    return plan.dropDuplicates(["tile_id", "granule_key", *apart]).withColumn("cmr_access_time", F.lit(accessed).cast("timestamp"))


def open_tiles(plan: DataFrame, stored: DataFrame) -> DataFrame:
    """Tiles of the plan without data yet, in order."""
    return plan.select("tile_id").distinct().join(stored.select("tile_id").distinct(), "tile_id", "left_anti").orderBy("tile_id")
