"""The lake's tables: footprints by tile and year, plans by tile, regions, and exchange with local frames."""

from __future__ import annotations

from collections.abc import Iterable
from urllib.parse import unquote

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, IntegerType, StringType, StructField, StructType

from shotlake.functions.geometry import RINGS
from shotlake.functions.tiles import curve
from shotlake.schema import lake_schema
from shotlake.sources.scratch import exists, remove

#: Rows of a row group, and partitions that one statement adds to a table.
GROUP_ROWS, BATCH = 10_000, 100


def read_lake(spark: SparkSession, root: str, tiles: Iterable[str] | None = None, years: Iterable[int] | None = None, schema: StructType | None = None) -> DataFrame:
    """The footprints under root, narrowed to tiles and years by their partitions."""
    df = spark.read.schema(schema or lake_schema()).parquet(root)
    if tiles is not None:
        df = df.where(F.col("tile_id").isin(list(tiles)))
    if years is not None:
        df = df.where(F.col("year").isin(list(years)))
    return df


def read_parts(spark: SparkSession, root: str, parts: Iterable[tuple[str, int]]) -> DataFrame:
    """Only the folders of the given (tile, year)."""
    return spark.read.option("basePath", root).parquet(*[f"{root}/tile_id={t}/year={y}" for t, y in parts])


def read_plan(spark: SparkSession, root: str, tiles: Iterable[str] | None = None, schema: StructType | None = None) -> DataFrame:
    """The plan under root, narrowed to tiles by its partitions."""
    df = (spark.read.schema(schema) if schema else spark.read).parquet(root)
    return df if tiles is None else df.where(F.col("tile_id").isin(list(tiles)))


def write_lake(df: DataFrame, root: str, order: str | None = None, spread: bool = True) -> None:
    """Write footprints by tile and year, replacing just the partitions that df holds. Rows are rebalanced by tile and
    year, so that light partitions share a task and a heavy one is several tasks and files, each of them in order: along
    a curve through the tile, where df has coordinates, so that the row groups of a file cover little ground each and a
    box of coordinates skips most of them. Rows that lie together by tile already need not be spread, only ordered."""
    if spread:
        df = df.hint("rebalance", "tile_id", "year")
    if order is None and {"lon_lowestmode", "lat_lowestmode"} <= set(df.columns):
        df = df.withColumn("_curve", curve(F.col("lon_lowestmode"), F.col("lat_lowestmode")))
        df = df.sortWithinPartitions("tile_id", "year", "_curve", "shot_number").drop("_curve")
    else:
        df = df.sortWithinPartitions("tile_id", "year", order or "shot_number")
    _overwrite(df, root, "tile_id", "year")


def write_plan(df: DataFrame, root: str) -> None:
    """Write a plan by tile, replacing just the tiles that df holds."""
    _overwrite(df.hint("rebalance", "tile_id").sortWithinPartitions("tile_id", "granule_key"), root, "tile_id")


def write_result(df: DataFrame, path: str) -> None:
    """Write a query's result as one table."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)


def _overwrite(df: DataFrame, root: str, *by: str) -> None:
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
    writer.option("parquet.block.row.count.limit", str(GROUP_ROWS)).partitionBy(*by).parquet(root)


def part_folder(tile: str, year: int | None) -> str:
    """The folder of a tile and year under a lake's root."""
    return f"tile_id={tile}/year={'__HIVE_DEFAULT_PARTITION__' if year is None else year}"


def add_files(spark: SparkSession, staged: str, root: str, apart: Iterable[str] = ()) -> None:
    """Move the data files of the partitions under staged to those under root, beside the files that are there, but for the
    folders in apart. A move that was broken off is made good by another: what has been moved is no longer under staged."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(staged).getFileSystem(spark._jsc.hadoopConfiguration())
    apart, made = set(apart), set()
    found = fs.listFiles(path(staged), True)
    while found.hasNext():
        at = found.next().getPath()
        folder = f"{at.getParent().getParent().getName()}/{at.getParent().getName()}"
        if not folder.startswith("tile_id=") or folder in apart:
            continue
        if folder not in made:
            fs.mkdirs(path(f"{root}/{folder}"))
            made.add(folder)
        if not fs.rename(at, path(f"{root}/{folder}/{at.getName()}")):
            raise OSError(f"{at} couldn't be moved to {root}/{folder}")


def merge_updates(spark: SparkSession, updates: str, root: str) -> None:
    """Put updated partitions over those of the lake; others stay. updates isn't touched, so that a merge that was
    broken off is made good by another."""
    write_lake(spark.read.parquet(updates), root)


def set_aside(spark: SparkSession, root: str, stale: DataFrame, archive: str) -> DataFrame:
    """Move the tiles in stale (tile_id) to archive and return their names, to be built anew. They leave the lake only
    when the archive holds all of them; a move that was broken off can be repeated."""
    lake = spark.read.parquet(root)
    moved = lake.join(stale.select("tile_id").distinct(), "tile_id", "left_semi")
    # of 64,800 tiles on the globe
    names = [r["tile_id"] for r in moved.select("tile_id").distinct().collect()]
    if names:
        write_lake(lake.where(F.col("tile_id").isin(names)), archive)
    for name in names:
        remove(spark, f"{root}/tile_id={name}")
    return spark.createDataFrame([(n,) for n in names], "tile_id string")


def create_table(spark: SparkSession, table: str, root: str, schema: StructType) -> None:
    """Make root an external table without partitions, unless there is one; a column `geometry` is left out."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields if f.name != "geometry")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet PARTITIONED BY (tile_id, year) LOCATION '{root}'")


def _spec(tile: str, year: int | None) -> str:
    name = tile.replace("\\", "\\\\").replace("'", "\\'")
    return f"PARTITION (tile_id = '{name}', year = {'null' if year is None else int(year)})"


def register(spark: SparkSession, table: str, root: str, ledger: str, schema: StructType | None = None, batch: int = BATCH) -> list[tuple[str, int | None]]:
    """Register the data files under root that the ledger lacks, and return the partitions they lie in.

    A table that doesn't exist is made, with the schema given or else the first file's; columns that only later files
    have are ignored. New files are found by an anti-join of names with the ledger, a stored table of paths; their
    partitions are added in batches, and after each its files are put on the ledger, so that a run that was broken off
    goes on where it ended. Partitions that hold no new file aren't touched.
    """
    fresh = not spark.catalog.tableExists(table)
    listed = data_files(spark, root)
    if fresh:
        if schema is None:
            first = listed.where(F.col("path").contains("/year=")).agg(F.min("path")).first()[0]
            schema = spark.read.option("basePath", root).parquet(first).schema
            kinds = {"tile_id": StringType(), "year": IntegerType()}
            schema = StructType([StructField(f.name, kinds.get(f.name, f.dataType)) for f in schema.fields])
        create_table(spark, table, root, schema)
    known = spark.read.schema("path string").parquet(ledger) if not fresh and exists(spark, ledger) else spark.createDataFrame([], "path string")
    staged = f"{ledger}-new"
    write_result(new_files(listed, known).select("path", "tile_id", "year"), staged)
    new = spark.read.schema("path string, tile_id string, year int").parquet(staged)
    if fresh:  # a ledger of an earlier table of this name says nothing of this one
        write_result(known, ledger)
    parts = [(r[0], r[1]) for r in new.select("tile_id", "year").distinct().orderBy("tile_id", "year").collect()]  # of 64,800 tiles, by years
    for k in range(0, len(parts), batch):
        some = parts[k : k + batch]
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(_spec(*p) for p in some)}")
        asked = F.broadcast(spark.createDataFrame(some, "_tile string, _year int"))
        new.join(asked, (F.col("tile_id") == F.col("_tile")) & F.col("year").eqNullSafe(F.col("_year")), "left_semi").select("path").write.mode("append").parquet(ledger)
    spark.sql(f"REFRESH TABLE {table}")
    return parts


def _parts(spark: SparkSession, table: str) -> set[tuple[str, int | None]]:
    found = (dict(x.split("=", 1) for x in p.split("/")) for p in partitions(spark, table))
    return {(unquote(p["tile_id"]), int(p["year"]) if p["year"].isdigit() else None) for p in found}


def _point(spark: SparkSession, table: str, part: tuple[str, int | None], location: str, known: set) -> None:
    where = f"'{location}'"
    spark.sql(f"ALTER TABLE {table} {_spec(*part)} SET LOCATION {where}" if part in known else f"ALTER TABLE {table} ADD {_spec(*part)} LOCATION {where}")


def swap_updates(spark: SparkSession, table: str, updates: str) -> list[tuple[str, int | None]]:
    """Let the table's partitions that updates holds anew lie there from now on, and add those it lacks; others stay. No
    row is copied: each partition changes from old to new at once, and the old files stay for readers that have begun."""
    files = data_files(spark, updates).where(F.col("path").contains("/year="))
    folder = F.regexp_replace("path", "/[^/]*$", "")
    held = [(r[0], r[1], r[2]) for r in files.groupBy("tile_id", "year").agg(F.min(folder)).orderBy("tile_id", "year").collect()]  # of 64,800 tiles, by years
    known = _parts(spark, table)
    for tile, year, location in held:
        _point(spark, table, (tile, year), location, known)
    spark.sql(f"REFRESH TABLE {table}")
    return [(t, y) for t, y, _ in held]


def set_aside_parts(spark: SparkSession, table: str, stale: DataFrame, archive: str) -> list[str]:
    """Hand the tiles in stale (tile_id) from one table to another, archive, and return their names, to be built anew. The
    files stay where they are: archive's partitions of a tile are replaced by the table's, all years of it leave the
    table at once, and only then. A hand-over that was broken off can be repeated."""
    names = {r[0] for r in stale.select("tile_id").distinct().collect()}
    moved = sorted((p for p in _parts(spark, table) if p[0] in names), key=str)
    for tile in sorted({t for t, _ in moved}):
        places = {}
        for part in (p for p in moved if p[0] == tile):
            told = spark.sql(f"DESCRIBE TABLE EXTENDED {table} {_spec(*part)}").where("col_name = 'Location'").first()
            places[part] = told["data_type"]
        kept = _parts(spark, archive)
        for part in sorted((p for p in kept if p[0] == tile and p not in places), key=str):
            spark.sql(f"ALTER TABLE {archive} DROP IF EXISTS {_spec(*part)}")
        for part, location in places.items():
            _point(spark, archive, part, location, kept)
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(_spec(*p) for p in places)}")
    for t in (table, archive):
        spark.sql(f"REFRESH TABLE {t}")
    return sorted({t for t, _ in moved})


def from_footers(spark: SparkSession, root: str, columns: list[str], by: list[str] | None = None, schema: StructType | None = None) -> DataFrame:
    """(by, n, least_<column>, most_<column>) of the footprints under root, by partition columns or over all, from the footers
    of files alone: no row is read. For numeric columns without NaN. The result belongs to a session of its own, in
    which parquet is read by the reader that can do this."""
    session = spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    df = session.read.schema(schema or lake_schema()).parquet(root)
    ends = [(f, n, c) for c in columns for f, n in ((F.min, "least"), (F.max, "most"))]
    # files answer by all of their partition columns or by none
    parts = df.groupBy("tile_id", "year").agg(F.count("*").alias("n"), *[f(c).alias(f"{n}_{c}") for f, n, c in ends])
    return parts.groupBy(*by or []).agg(F.sum("n").alias("n"), *[f(f"{n}_{c}").alias(f"{n}_{c}") for f, n, c in ends])


def partitions(spark: SparkSession, table: str) -> list[str]:
    """Partitions from the catalog, without opening a file."""
    return [r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]


def data_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, tile_id, year) of the data files under root, from their names alone: no file is opened."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).load(root).select("path")
    part = lambda name: F.regexp_extract("path", f"/{name}=([^/]+)/", 1)
    return files.select("path", part("tile_id").alias("tile_id"), part("year").try_cast("int").alias("year"))


def new_files(listed: DataFrame, known: DataFrame) -> DataFrame:
    """Data files (path) of the listing that aren't in the ledger yet."""
    data = listed.where(F.col("path").endswith(".parquet") & F.col("path").contains("/year="))
    return data.dropDuplicates(["path"]).join(known.select("path"), "path", "left_anti")


def read_regions(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """(region_id, part_id, rings) of the (multi)polygons of GeoJSON files, degrees; others are left out. A file is
    one collection, or with `lines` one in each line. A ring with coordinates beyond the globe is an error."""
    raw = spark.read.schema("features array<struct<id:string,geometry:struct<type:string,coordinates:string>>>").option("multiLine", not lines).json(path)
    f = raw.select(F.explode("features").alias("f")).select(F.col("f.id").alias("region_id"), F.col("f.geometry.type").alias("kind"), F.col("f.geometry.coordinates").alias("c"))
    poly, multi = "array<array<array<double>>>", "array<array<array<array<double>>>>"
    parts = F.when(F.col("kind") == "Polygon", F.array(F.from_json("c", poly))).when(F.col("kind") == "MultiPolygon", F.from_json("c", multi))
    f = f.select("region_id", F.posexplode(parts).alias("part_id", "p"))
    rings = F.transform("p", lambda r: F.transform(r, lambda q: F.struct(q[0].alias("x"), q[1].alias("y")))).cast(RINGS)
    beyond = F.exists(rings, lambda r: F.exists(r, lambda q: (F.abs(q["x"]) > 180) | (F.abs(q["y"]) > 90)))
    return f.select("region_id", "part_id", F.when(beyond, F.raise_error(F.lit("coordinates aren't degrees"))).otherwise(rings).alias("rings"))


#: A point as little-endian WKB: byte order, kind, coordinates.
_POINT = np.dtype([("order", "u1"), ("kind", "<u4"), ("x", "<f8"), ("y", "<f8")])


@F.pandas_udf(BinaryType())
def point_wkb(lon: pd.Series, lat: pd.Series) -> pd.Series:
    """Points as little-endian WKB, for export; null where a coordinate is null or NaN."""
    points = np.zeros(len(lon), _POINT)
    points["order"] = points["kind"] = 1
    points["x"], points["y"] = lon.to_numpy("float64", na_value=np.nan), lat.to_numpy("float64", na_value=np.nan)
    out = pd.Series(points.view("V21").tolist(), dtype=object)
    return out.where(~(np.isnan(points["x"]) | np.isnan(points["y"])), None)


@F.pandas_udf(StructType([StructField("x", DoubleType()), StructField("y", DoubleType())]))
def point_from_wkb(wkb: pd.Series) -> pd.DataFrame:
    """Coordinates of points as little-endian WKB; nulls for null and for anything else."""
    fits = wkb.map(lambda b: b is not None and len(b) == 21 and bytes(b[:5]) == b"\x01\x01\x00\x00\x00").astype(bool)
    points = np.frombuffer(b"".join(wkb[fits]), _POINT)
    out = pd.DataFrame({"x": np.nan, "y": np.nan}, index=wkb.index).astype(object)
    out.loc[fits, "x"], out.loc[fits, "y"] = points["x"], points["y"]
    return out.where(fits, None)


def point_text(lon: Column, lat: Column) -> Column:
    """Points as WKT; null where a coordinate is null."""
    return F.concat(F.lit("POINT ("), lon.cast("string"), F.lit(" "), lat.cast("string"), F.lit(")"))


def point_from_text(text: Column) -> Column:
    """struct<x, y> of a point as WKT; null for anything else."""
    number = r"\s*([-+0-9.eE]+)\s*"
    part = lambda i: F.regexp_extract(text, rf"^(?i:POINT)\s*\({number}\s{number}\)$", i).try_cast("double")
    return F.when(part(1).isNotNull() & part(2).isNotNull(), F.struct(part(1).alias("x"), part(2).alias("y")))


def rings_text(rings: Column) -> Column:
    """A polygon's rings as WKT."""
    ring = lambda r: F.concat(F.lit("("), F.array_join(F.transform(r, lambda p: F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string"))), ", "), F.lit(")"))
    return F.concat(F.lit("POLYGON ("), F.array_join(F.transform(rings, ring), ", "), F.lit(")"))


def rings_from_text(text: Column) -> Column:
    """Rings of a polygon as WKT; null for anything else."""
    inner = F.regexp_extract(text, r"(?i)^\s*POLYGON\s*\(\s*(\(.*\))\s*\)\s*$", 1)
    numbers = lambda p, i: F.get(F.split(F.trim(p), r"\s+"), F.lit(i)).try_cast("double")
    point = lambda p: F.struct(numbers(p, 0).alias("x"), numbers(p, 1).alias("y"))
    rings = F.transform(F.regexp_extract_all(inner, F.lit(r"\(([^()]*)\)"), F.lit(1)), lambda r: F.transform(F.split(r, ","), point))
    return F.when(inner != "", rings.cast(RINGS))


def to_local(df: DataFrame, columns: list[str], limit: int) -> pd.DataFrame:
    """At most limit rows as a local frame, with the point as WKB in hex. A column that is missing is an error."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"no such columns: {', '.join(missing)}")
    geometry = F.hex(point_wkb("lon_lowestmode", "lat_lowestmode")).alias("geometry")
    return df.select(*columns, geometry).limit(limit).toPandas()


def from_local(spark: SparkSession, frame: pd.DataFrame) -> DataFrame:
    """A local frame as a table; a column `geometry` of points, as WKB in hex or as WKT, becomes lon_lowestmode and
    lat_lowestmode."""
    df = spark.createDataFrame(frame)
    if "geometry" not in df.columns:
        return df
    point = F.coalesce(point_from_text(F.col("geometry")), point_from_wkb(F.expr("try_to_binary(geometry, 'hex')")))
    return df.withColumn("_p", point).withColumns({"lon_lowestmode": F.col("_p.x"), "lat_lowestmode": F.col("_p.y")}).drop("_p", "geometry")


def shape(df: DataFrame) -> DataFrame:
    """(n_rows, n_columns): what a collect would bring."""
    return df.agg(F.count("*").alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def first_rows(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first n rows in an order."""
    return df.orderBy(*order).limit(n)


def describe(df: DataFrame, like: str | None = None) -> DataFrame:
    """A table's columns as a table: column_name, column_type, level, unit, description; those whose name is like a
    pattern, if there is one."""
    rows = [(f.name, f.dataType.simpleString(), *[f.metadata.get(k) for k in ("level", "unit", "description")]) for f in df.schema.fields]
    found = df.sparkSession.createDataFrame(rows, "column_name string, column_type string, level string, unit string, description string")
    return found.where(F.col("column_name").like(like)) if like else found


def profile(df: DataFrame, like: str) -> DataFrame:
    """Of each numeric column whose name is like a pattern: column_name, column_type, n (values), least, most."""
    kinds = [(r["column_name"], r["column_type"]) for r in describe(df, like).collect() if r["column_type"] in ("int", "bigint", "float", "double")]
    asked = [F.struct(F.lit(c).alias("column_name"), F.lit(k).alias("column_type"), F.count(c).alias("n"), F.min(F.col(c).cast("double")).alias("least"), F.max(F.col(c).cast("double")).alias("most")) for c, k in kinds]
    return df.agg(F.array(*asked).alias("all")).select(F.explode("all").alias("c")).select("c.*")
