"""Granule listings: pages of JSON entries to one row per product file."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shotlake.functions.geometry import RINGS
from shotlake.functions.granules import let

ENTRY = (
    "online_access_flag boolean, data_center string, producer_granule_id string, title string, granule_size string, "
    "polygons array<array<string>>, links array<struct<href:string,title:string>>"
)


def read_pages(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Entries of landed listing pages (feed.entry[]): a file is one page, or with `lines` each of its lines is."""
    pages = spark.read.schema(f"feed struct<entry:array<struct<{', '.join(':'.join(x.split(' ', 1)) for x in _split(ENTRY))}>>>").option("multiLine", not lines).json(path)
    return pages.select(F.explode("feed.entry").alias("e")).select("e.*")


def _split(ddl: str) -> list[str]:
    out, depth = [""], 0
    for c in ddl:
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            out.append("")
        else:
            out[-1] += c
    return [x.strip() for x in out]


def ring_of(text: Column) -> Column:
    """Points of "lat lon lat lon ...", as x and y."""

    def points(number: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(number) - 2, F.lit(2))
        return F.transform(at, lambda i: F.struct(F.get(number, i + 1).cast("double").alias("x"), F.get(number, i).cast("double").alias("y")))

    return let(F.split(F.trim(text), r"\s+"), points)


def parse_entries(entries: DataFrame, cloud: bool = True, keep: Iterable[str] = ()) -> DataFrame:
    """(granule_name, granule_url, granule_size, polygons) of entries that are online and have polygons, and their columns
    in keep.

    The name is the producer's for data centres with LP, the title's second part between dots for those with
    ORNL (which wins); entries of other centres are left out. The URL is the first s3:// link, or without cloud
    the first whose title begins with Download; none gives null. polygons are the outer rings, each a polygon.
    """
    center = F.col("data_center")
    name = F.when(center.contains("ORNL"), F.get(F.split("title", r"\.", 3), F.lit(1))).when(center.contains("LP"), F.col("producer_granule_id"))
    fits = (lambda x: x["href"].startswith("s3://")) if cloud else (lambda x: x["title"].startswith("Download"))
    url = F.try_element_at(F.filter("links", fits), F.lit(1))["href"]
    polygons = F.transform("polygons", lambda p: F.array(ring_of(p[0]))).cast(f"array<{RINGS}>")
    rows = entries.where(F.col("online_access_flag") & (F.size("polygons") > 0))
    rows = rows.select(name.alias("granule_name"), F.nullif(url, F.lit("")).alias("granule_url"), F.col("granule_size").cast("double").alias("granule_size"), polygons.alias("polygons"), *keep)
    return rows.where("granule_name is not null")
