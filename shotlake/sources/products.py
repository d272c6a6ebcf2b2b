"""Stored product tables, bucketed so that assembling them moves none of their rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shotlake.functions.tiles import tile_bounds
from shotlake.operators.build import KEY, whole_rows, with_tile

#: Buckets of every product table; tables that are assembled together have the same.
BUCKETS = 64


def one_of_each(df: DataFrame, product: str, buckets: int | None = BUCKETS) -> DataFrame:
    """A product's rows with their tile_id, dealt to buckets by key: of rows with one key the greatest, whole ones before
    others. Without buckets rows stay where they are, if those of a key lie together."""
    rows = with_tile(df)
    rest = [c for c in rows.columns if c not in KEY]
    rows = rows.select(*KEY, F.struct(whole_rows(rows, product).alias("_whole"), *rest).alias("r"))
    if buckets:
        rows = rows.repartition(buckets, *KEY)
    return rows.groupBy(*KEY).agg(F.max("r").alias("r")).select(*KEY, *[F.col(f"r.{c}") for c in rest])


def write_product(df: DataFrame, product: str, table: str, path: str | None = None, buckets: int = BUCKETS, dealt: bool = False) -> None:
    """Store a product's table with its tile_id, bucketed by what products meet by and sorted within buckets, so that row
    groups hold few tiles. Of rows with one key the greatest is kept, whole ones before others. With a path the table's files
    lie there, and stay when it is dropped. dealt: df has tile_id and was dealt by KEY into as many partitions as there are
    buckets, so that its rows need not move."""
    rows = one_of_each(df, product, None if dealt else buckets)
    writer = rows.write.mode("overwrite").format("parquet").bucketBy(buckets, *KEY).sortBy(*KEY).option("compression", "zstd")
    (writer.option("path", path) if path else writer).saveAsTable(table)


def read_product(spark: SparkSession, table: str, tiles: list[str] | None = None) -> DataFrame:
    """A stored product, narrowed to tiles: by name, and by the box around them. Both reach the scan, where they skip row
    groups."""
    df = spark.table(table)
    if tiles is None:
        return df
    if not tiles:
        return df.where(F.lit(False))
    named = spark.createDataFrame([(t,) for t in tiles], "tile_id string").select(*[c.alias(n) for n, c in tile_bounds(F.col("tile_id"), strict=True).items()])
    box = named.agg(F.min("minx"), F.min("miny"), F.max("maxx"), F.max("maxy")).first()
    lon, lat = F.col("lon_lowestmode"), F.col("lat_lowestmode")
    return df.where(F.col("tile_id").isin(tiles) & (lon >= float(box[0])) & (lon < float(box[2])) & (lat > float(box[1])) & (lat <= float(box[3])))
