"""The catalog of granules: listings of products rolled up to one row per granule."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shotlake.functions.granules import granule_key, hash_list, start_time
from shotlake.schema import PRODUCTS

# Fixed value: granules that are never used.
DENIED = ("O33765_03",)


def product_tokens(text: str, known: tuple[str, ...] = PRODUCTS) -> list[str]:
    """Products of a comma list: trimmed, in any case, in order, each once. Empty or unknown ones are errors."""
    by_name = {k.lower(): k for k in known}
    found = [t.strip().lower() for t in text.split(",") if t.strip()]
    unknown = [t for t in found if t not in by_name]
    if not found or unknown:
        raise ValueError(f"unknown products: {', '.join(unknown)}" if unknown else "no product is named")
    return list(dict.fromkeys(by_name[t] for t in found))


def union_listings(listings: dict[str, DataFrame]) -> DataFrame:
    """Listings of products as one table, with product and its place in the order."""
    parts = [df.withColumn("product", F.lit(p)).withColumn("product_order", F.lit(i)) for i, (p, df) in enumerate(listings.items())]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def roll_up(listing: DataFrame, required: list[str] | None = None, products: tuple[str, ...] = PRODUCTS, start_year: int | None = None, end_year: int | None = None, denied: tuple[str, ...] = DENIED, apart: tuple[str, ...] = ()) -> DataFrame:
    """One row per granule that has every required product (all, if none are named).

    Takes granule_name, granule_url, granule_size, polygons, product, product_order. Gives granule_key,
    granule_size (sum), granule_names (by product, then name), a <product>_url each, polygons (of the first product)
    and granule_hash. Years count only if both are given. apart: more columns of the listing, which tell granules of one
    key apart, as where orbits have more digits than names have room for; they stay in the result.
    """
    required = list(products) if required is None else required
    extra = [p for p in required if p not in products]
    if extra:
        raise ValueError(f"required products are not among the products: {', '.join(extra)}")
    named = listing.withColumn("granule_key", granule_key(F.col("granule_name"))).where("granule_key is not null")
    if denied:
        named = named.where(~F.col("granule_key").isin(list(denied)))
    if start_year is not None and end_year is not None:
        first, last = F.to_timestamp(F.lit(f"{start_year}-01-01 00:00:00")), F.to_timestamp(F.lit(f"{end_year}-12-31 23:59:59"))
        named = named.where(start_time(F.col("granule_name")).between(first, last))
    url = lambda p: F.expr(f"min_by(granule_url, granule_name) FILTER (WHERE product = '{p}' AND granule_url IS NOT NULL)").alias(f"{p}_url")
    rolled = named.groupBy("granule_key", *apart).agg(
        F.sum("granule_size").alias("granule_size"),
        F.array_sort(F.collect_list(F.struct("product_order", "granule_name"))).alias("names"),
        F.collect_set("product").alias("present"),
        *[url(p) for p in products],
        F.min_by("polygons", F.struct("product_order", "granule_name")).alias("polygons"),
    )
    whole = F.size(F.array_except(F.array(*[F.lit(p) for p in required]).cast("array<string>"), F.col("present"))) == 0
    rolled = rolled.where(whole).withColumn("granule_names", F.transform("names", lambda n: n["granule_name"]))
    return rolled.withColumn("granule_hash", hash_list(F.col("granule_names"))).drop("names", "present")
