"""Upkeep of plans: merge versions, audit."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KEY = ["tile_id", "granule_key"]


def latest(old: DataFrame, new: DataFrame) -> DataFrame:
    """Both versions of a plan as one: of each tile and granule the row accessed last; of equal times the greater
    hash, then the new one."""
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    order = Window.partitionBy(*KEY).orderBy(F.desc("cmr_access_time"), F.desc("granule_hash"), F.desc("_new"))
    return both.withColumn("_rank", F.row_number().over(order)).where("_rank = 1").drop("_rank", "_new")


def duplicates(plan: DataFrame) -> DataFrame:
    """(tile_id, granule_key, count) of keys that occur more than once."""
    return plan.groupBy(*KEY).count().where("count > 1")


def missing_granules(current: DataFrame, existing: DataFrame) -> DataFrame:
    """Rows of the current plan that the existing one lacks."""
    return current.join(existing.select(*KEY), KEY, "left_anti")


def drifted(current: DataFrame, existing: DataFrame) -> DataFrame:
    """(tile_id, granule_key, hash_existing, hash_current) of granules whose files changed."""
    both = current.select(*KEY, F.col("granule_hash").alias("hash_current")).join(existing.select(*KEY, F.col("granule_hash").alias("hash_existing")), KEY)
    return both.where("hash_current <> hash_existing").select(*KEY, "hash_existing", "hash_current")


def is_covered(required: DataFrame, existing: DataFrame) -> bool:
    """Whether every required tile exists. Each tile is joined once: a tile's shots would be one key's work."""
    return required.select("tile_id").distinct().join(existing.select("tile_id").distinct(), "tile_id", "left_anti").isEmpty()


def tile_status(required: DataFrame, planned: DataFrame, stored: DataFrame) -> DataFrame:
    """Every tile of the three, with flags required, planned, stored."""
    parts = [df.select("tile_id").distinct().withColumn("what", F.lit(w)) for w, df in (("required", required), ("planned", planned), ("stored", stored))]
    tags = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return tags.groupBy("tile_id").agg(*[F.bool_or(F.col("what") == w).alias(w) for w in ("required", "planned", "stored")])


def summary(status: DataFrame) -> DataFrame:
    """One row of counts; stored_unplanned above 0 is an error of the lake."""
    return status.agg(
        F.count_if("required").alias("required"),
        F.count_if(F.col("required") & F.col("stored")).alias("existing"),
        F.count_if(F.col("required") & ~F.col("stored")).alias("missing"),
        F.count_if(F.col("required") & ~F.col("planned")).alias("unplanned"),
        F.count_if(F.col("stored") & ~F.col("planned")).alias("stored_unplanned"),
    )
