"""Footprints from product tables: clip, join, fill, derive, filter."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from shotlake.functions.tiles import corner_tile, tile_of
from shotlake.schema import ANCILLARY, PRODUCTS, product_fields, unrolled

# Degrade flags that pass the quality filter.
GOOD_DEGRADE = [0, 3, 8, 10, 13, 18, 20, 23, 28, 30, 33, 38, 40, 43, 48, 60, 63, 68]
#: Microseconds of 2018-01-01T00:00:00Z, from which delta_time counts.
EPOCH_US = 1_514_764_800_000_000


def quality(df: DataFrame) -> Column:
    """Whether a shot passes the quality filter; null inputs don't."""
    c = df
    good = (
        (c["quality_flag"] == 1)
        & c["sensitivity"].between(0.9, 1.0)
        & (c["sensitivity_a2"] > 0.95)
        & (c["sensitivity_a2"] <= 1.0)
        & c["degrade_flag"].isin(GOOD_DEGRADE)
        & (c["surface_flag"] == 1)
    )
    return F.coalesce(good, F.lit(False))


def absolute_time(delta: Column) -> Column:
    """Timestamp of seconds since 2018 began, to the microsecond."""
    return F.timestamp_micros((F.lit(EPOCH_US) + F.round(delta * 1_000_000)).cast("long"))


def whole(df: DataFrame, names: list[str]) -> Column:
    """Whether no column, and no bin of a profile, is null or NaN."""
    tests = []
    for n in names:
        kind = df.schema[n].dataType
        if isinstance(kind, ArrayType):
            # null where a bin is null and none is NaN; compiled, as a lambda for each bin isn't
            tests.append(F.coalesce(~F.array_contains(n, float("nan")), F.lit(False)))
        else:
            tests.append(F.col(n).isNotNull() & (~F.isnan(n) if kind.typeName() in ("float", "double") else F.lit(True)))
    return reduce(lambda a, b: a & b, tests)


#: Tasks that one granule in one tile can be dealt to, and shots of a tile that are dealt to one task.
SPLITS, SPLIT_SHOTS = 8, 100_000
#: Rows of a plan, of some 100 bytes each, that are sent to every task.
MOST_SENT = 1_000_000
KEY = ["tile_id", "granule_key", "shot_number"]
PLACE = ["beam_name", "lat_lowestmode", "lon_lowestmode"]


def with_tile(df: DataFrame) -> DataFrame:
    """df with the tile of its coordinates, unless it has one."""
    return df if "tile_id" in df.columns else df.withColumn("tile_id", tile_of(F.col("lon_lowestmode"), F.col("lat_lowestmode")))


def whole_rows(df: DataFrame, product: str) -> Column:
    """Whether a row of a product has all that it needs, ancillary values aside, as these are the granule's."""
    names = [f.name for f in product_fields(product) if f.name in df.columns and f.name not in ANCILLARY]
    return whole(df, [*KEY, *PLACE, *names])


def _tagged(df: DataFrame, product: str) -> DataFrame:
    """A product's whole rows: key, and place and variables as a struct named after it."""
    df = with_tile(df)
    names = [f.name for f in product_fields(product) if f.name in df.columns and f.name not in ANCILLARY]
    return df.where(whole_rows(df, product)).select(*KEY, F.struct(*PLACE, *names).alias(product))


def _due(ancillary: dict[str, DataFrame], plan: DataFrame) -> DataFrame:
    """Per tile and granule: <product>.due, and the granule's ancillary values as <product>.<name>."""
    due = plan.select("tile_id", "granule_key", *[F.col(f"{p}_url").isNotNull().alias(f"{p}.due") for p in ancillary]).dropDuplicates(["tile_id", "granule_key"])
    for p, df in ancillary.items():
        names = [f.name for f in product_fields(p) if f.name in ANCILLARY and f.name in df.columns]
        if names:
            last = df.join(plan.select("granule_key").distinct(), "granule_key", "left_semi").groupBy("granule_key").agg(*[F.max_by(n, "beam_name").alias(f"{p}.{n}") for n in names])
            due = due.join(last, "granule_key", "left")
    return due


def _usable(product: str, due: DataFrame) -> Column:
    """Whether the plan's row lets the product's rows count: it is due, and its granule has its ancillary values."""
    own = [f"`{c}`" for c in due.columns if c.startswith(f"{product}.") and not c.endswith(".due")]
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() & ~F.isnan(c) for c in own], F.col(f"`{product}.due`"))


def row_counts(products: dict[str, DataFrame]) -> DataFrame:
    """(product, granule_key, tile_id, n): rows of each product by granule and tile."""
    x, y = F.floor("lon_lowestmode").alias("x"), F.ceil("lat_lowestmode").alias("y")
    parts = [df.groupBy("granule_key", x, y).agg(F.count("*").alias("n")).withColumn("product", F.lit(p)) for p, df in products.items()]
    return reduce(lambda a, b: a.unionByName(b), parts).select("product", "granule_key", corner_tile(F.col("x"), F.col("y")).alias("tile_id"), "n")


def tile_splits(counts: DataFrame) -> DataFrame:
    """(tile_id, splits): tasks of SPLIT_SHOTS shots that each tile of row_counts is worth, by the product that has most rows
    there."""
    sums = counts.groupBy("tile_id", "product").agg(F.sum("n").alias("n"))
    return sums.groupBy("tile_id").agg(F.ceil(F.max("n") / SPLIT_SHOTS).cast("int").alias("splits"))


def assemble(products: dict[str, DataFrame], plan: DataFrame, splits: DataFrame | None = None) -> DataFrame:
    """One row per shot that all of its granule's available products have in the same tile.

    products: name to table of product_fields (some or all). plan: tile_id, granule_key, a <product>_url each. A
    product without a URL for the granule and tile isn't used; its columns are typed NULLs. A granule without any
    gives no rows. Place and beam are the first available product's; a shot that a product holds twice counts once, with
    the greater of its rows. An ancillary value is that of the granule's last beam by name, whether or not that has rows
    in the tile; without one the granule's rows of the product aren't whole.

    The products' rows, profiles still as arrays, are put together as one table with a struct for each product, which is
    dealt once, by tile, granule and a part of its shots, joined with the plan, and grouped by shot. With splits (as
    tile_splits gives them, of 64,800 tiles on the globe) it is dealt by tile and a part of its shots, whatever their granule,
    so that the result can be stored by tile where it is; the plan is then sent to every task, if it has at most MOST_SENT rows.
    """
    parts = {p: _tagged(df, p) for p, df in products.items()}
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts.values())
    meet = ["tile_id", "granule_key", "part"]
    due = _due(products, plan)
    told = [c for c in due.columns if "." in c]
    if splits is None:
        rows = rows.withColumn("part", F.pmod(F.xxhash64("shot_number"), F.lit(SPLITS)).cast("int")).repartition(*meet)
        rows = rows.join(due.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SPLITS - 1)))), meet)
    else:
        rows = rows.join(F.broadcast(splits), "tile_id").withColumn("part", F.pmod(F.xxhash64("shot_number"), F.col("splits")).cast("int")).drop("splits")
        few = plan.limit(MOST_SENT + 1).count() <= MOST_SENT
        rows = rows.repartition("tile_id", "part").join(F.broadcast(due) if few else due, ["tile_id", "granule_key"])
    rows = rows.where(reduce(lambda a, b: a & b, [F.col(p).isNull() | _usable(p, due) for p in products]))
    shots = rows.groupBy(*meet, "shot_number").agg(*[F.max(p).alias(p) for p in products], *[F.max(f"`{c}`").alias(c) for c in told])
    return _finished(shots, parts)


def assemble_stored(products: dict[str, DataFrame], plan: DataFrame, ancillary: dict[str, DataFrame] | None = None) -> DataFrame:
    """What assemble gives, of tables that sources.products has stored: bucketed by the same key, each shot once.

    A shot needs every product that is due, so it is in the first of these. From that, the others are left joins, which
    leave the rows where their buckets are; a plan of which some granules lack the first product is one such chain for
    each product that comes first somewhere. ancillary: the tables as a whole, where products are narrowed to tiles. A
    plan of at most MOST_SENT rows is sent to every task; a larger one makes the first product's rows move to it.
    """
    parts = {p: _tagged(df, p) for p, df in products.items()}
    due = _due(ancillary or products, plan)
    first = F.coalesce(*[F.when(F.col(f"`{p}.due`"), F.lit(p)) for p in products])
    asked = due.agg(F.count("*"), F.collect_set(first)).first()  # of the four products
    leading = set(asked[1])
    if asked[0] <= MOST_SENT:
        due = F.broadcast(due)
    names, chains = list(products), []
    for i, p in enumerate(names):
        if p in leading or i + 1 == len(names) and not chains:
            rows = parts[p].join(due.where(first == p), ["tile_id", "granule_key"]).where(_usable(p, due))
            for q in names[i + 1 :]:
                rows = rows.join(parts[q], KEY, "left").withColumn(q, F.when(_usable(q, due), F.col(q)))
            chains.append(rows.withColumns({q: F.lit(None).cast(parts[q].schema[q].dataType) for q in names[:i]}))
    return _finished(reduce(lambda a, b: a.unionByName(b), chains), parts)


def _finished(shots: DataFrame, parts: dict[str, DataFrame]) -> DataFrame:
    """Shots that have all products that are due, with these unrolled, absent ones filled, time and year derived."""
    shots = shots.where(reduce(lambda a, b: a & b, [F.col(p).isNotNull() == F.col(f"`{p}.due`") for p in parts]))
    columns = [F.col("shot_number"), F.col("tile_id"), *[F.coalesce(*[F.col(p)[c] for p in parts]).alias(c) for c in PLACE]]
    known = set()
    for p, part in parts.items():
        held = part.schema[p].dataType.names
        for f in product_fields(p):
            if f.name in held:
                source = F.col(p)[f.name]
            elif f"{p}.{f.name}" in shots.columns:
                source = F.when(F.col(p).isNotNull(), F.col(f"`{p}.{f.name}`"))
            else:
                continue
            for i, out in enumerate(unrolled([f])):
                columns.append((F.get(source, F.lit(i)) if isinstance(f.dataType, ArrayType) else source).alias(out.name))
                known.add(out.name)
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for p in PRODUCTS for f in unrolled(product_fields(p)) if f.name not in known]
    out = shots.select(*columns, *missing, F.col("granule_key").alias("granule"))
    out = out.withColumn("absolute_time", absolute_time(F.col("delta_time")))
    return out.withColumn("year", F.year("absolute_time"))


def filtered_tiles(plan: DataFrame, products: list[str]) -> DataFrame:
    """(tile_id, filtered): a tile is quality-filtered unless one of its granules lacks a product's URL."""
    lacks = reduce(lambda a, b: a | b, [F.col(f"{p}_url").isNull() for p in products])
    return plan.groupBy("tile_id").agg((~F.bool_or(lacks)).alias("filtered"))


def quality_filter(shots: DataFrame, plan: DataFrame, products: list[str]) -> DataFrame:
    """Shots that pass the quality filter, and all shots of tiles that aren't filtered."""
    # of 64,800 tiles on the globe
    tiles = F.broadcast(filtered_tiles(plan, products))
    return shots.join(tiles, "tile_id").where(~F.col("filtered") | quality(shots)).drop("filtered")
