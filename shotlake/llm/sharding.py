"""Sharding by a two-pass external shuffle, in native expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shotlake.llm.common import SEED, input_size, materialise
from shotlake.llm.expressions import let

SHARDS = 40
#: Stored bytes and rows of input that one bucket is meant to hold: what a task has in memory at once.
BUCKET_BYTES, BUCKET_ROWS = 4 << 20, 2048
#: Copies of a repeated row that a task makes.
RUN = 65_536


def shard_of(key: Column, shards: int, seed: int = SEED) -> Column:
    """The shard that gives key the highest seeded hash. With one more shard, rows move only into that one.
    A null key has a shard of its own choice like any other."""
    scores = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: F.struct(F.xxhash64(F.lit(seed), s, key).alias("h"), s.alias("s")))
    return F.array_max(scores)["s"]


def fisher_yates(n: Column, *seeds: Column) -> Column:
    """A permutation of 0 to n - 1: from the last place down, each is swapped with one at or before it that a hash of
    the seeds and the place draws."""

    def swap(a: Column, i: Column) -> Column:
        def at(j: Column) -> Column:
            far, near = F.array(F.get(a, i)), F.array(F.get(a, j))
            return F.when(i == j, a).otherwise(F.concat(F.slice(a, F.lit(1), j), far, F.slice(a, j + 2, i - j - 1), near, F.slice(a, i + 2, F.size(a))))

        return let(F.pmod(F.xxhash64(*seeds, i), (i + 1).cast("long")).cast("int"), at)

    start = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    places = F.when(n > 1, F.sequence(n - 1, F.lit(1), F.lit(-1))).otherwise(F.array().cast("array<int>"))
    return F.aggregate(places, start, swap)


def planned(docs: DataFrame, id_col: str, shards: int, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES, bucket_rows: int = BUCKET_ROWS) -> list[int]:
    """Buckets of each shard, from its rows and the input's bytes a row: a shard that holds a frequent id has more."""
    key = F.coalesce(docs[id_col].cast("string"), F.lit("null"))
    rows = {r["shard"]: r["count"] for r in docs.groupBy(shard_of(key, shards, seed).alias("shard")).count().collect()}  # of so many shards
    each = min(bucket_rows, max(1, bucket_bytes * sum(rows.values()) // max(1, input_size(docs))))
    return [max(1, -(-rows.get(s, 0) // each)) for s in range(shards)]


def spread(docs: DataFrame, id_col: str, shards: int, seed: int, parts: list[int], bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Pass 1: (shard, part, hash, record) of every row, by hashes of the whole row. Rows that are equal in every column
    and more than a bucket holds are counted instead, and made again from one of them, each with a number that its
    hashes take in, so that they spread like others."""
    key = F.coalesce(docs[id_col].cast("string"), F.lit("null"))
    content = F.xxhash64(F.lit(seed + 1), key, *_hashable(docs))
    record = F.struct(*[docs[f"`{c}`"] for c in docs.columns])
    rows = docs.select(shard_of(key, shards, seed).alias("shard"), key.alias("key"), content.alias("content"), record.alias("record"))
    of = lambda *more: F.pmod(F.xxhash64("content", *more) if more else F.col("content"), F.element_at(F.lit(parts), F.col("shard") + 1))

    def dealt(df: DataFrame, *more: str) -> DataFrame:
        return df.select("shard", of(*more).alias("part"), F.xxhash64(F.lit(seed + 2), "key", "content", *more).alias("hash"), "record")

    often = materialise(rows.groupBy("content").count().where(F.col("count") > bucket_rows).select(F.col("content").alias("often")), "often")
    if often.isEmpty():
        return dealt(rows)
    alike = rows.join(often, F.col("content") == F.col("often"), "left_semi").withColumn("other", F.xxhash64(F.lit(seed + 3), *_hashable(docs, "record.")))
    alike = alike.groupBy("shard", "key", "content", "other").agg(F.any_value("record").alias("record"), F.count("*").alias("n"))
    # a run of copies is a row until it has been dealt to a task of its own
    runs = alike.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / RUN)))).repartition("content", "run")
    copies = runs.withColumn("copy", F.explode(F.sequence(F.col("run") * RUN, F.least(F.col("run") * RUN + RUN, F.col("n")) - 1)))
    return dealt(rows.join(often, F.col("content") == F.col("often"), "left_anti")).unionByName(dealt(copies, "copy"))


def shuffle_shards(docs: DataFrame, id_col: str = "doc_id", shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(shard, slot, record): every row of docs as the struct record, in a seeded random order within its shard.

    Pass 1 scatters rows into the buckets of their shard: the shard by seeded hashes of the id, the bucket by one of
    the whole row, so that rows of one id, or of none, spread over the buckets of its shard; so do rows that are equal
    in every column, once they would fill a bucket. Pass 2 gathers a bucket in memory, sorts it by hash and permutes it
    by a Fisher-Yates shuffle that the seed and the bucket decide: the slots are the same however the input is
    partitioned. slot counts from 0 without gaps in each shard: the sizes of the buckets before it plus the place
    within the bucket. The rows' columns keep their names inside record, so none can clash. Nulls are kept; equal rows
    are kept as often as they occur (two 64-bit hashes tell rows apart that are repeated so often); an empty table
    gives none.
    """
    rows = spread(docs, id_col, shards, seed, planned(docs, id_col, shards, seed, bucket_bytes, bucket_rows), bucket_rows)
    sizes = rows.groupBy("shard", "part").count()
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("shard", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    buckets = rows.groupBy("shard", "part").agg(F.collect_list(F.struct("hash", "record")).alias("rows"))
    by_hash = lambda a, b: F.when(a["hash"] < b["hash"], -1).when(a["hash"] > b["hash"], 1).otherwise(0)
    mixed = let(F.array_sort("rows", by_hash), lambda r: F.transform(fisher_yates(F.size(r), F.lit(seed), F.col("shard"), F.col("part")), lambda k: F.get(r, k)))
    placed = buckets.select("shard", "part", mixed.alias("rows")).join(sizes, ["shard", "part"]).select("shard", "base", F.posexplode("rows").alias("place", "row"))
    return placed.select("shard", (F.col("base") + F.col("place")).alias("slot"), F.col("row.record").alias("record"))


def _hashable(docs: DataFrame, inside: str = "") -> list[Column]:
    """Columns as xxhash64 takes them: those that hold maps or variants as JSON."""
    odd = lambda f: "map<" in f.dataType.simpleString() or "variant" in f.dataType.simpleString()
    at = lambda f: F.col(f"{inside}`{f.name}`") if inside else docs[f"`{f.name}`"]
    return [F.to_json(F.struct(at(f).alias("c"))) if odd(f) else at(f) for f in docs.schema.fields]


def write_shards(docs: DataFrame, path: str, files: int = 8, **options) -> None:
    """Write shuffle_shards as Parquet: a folder for each shard with up to `files` files, each written by a task of its
    own; in the order of their names they are read in the order of slots. A column of docs named shard or slot is
    written as record_shard or record_slot."""
    own = {c: f"record_{c}" if c.lower() in ("shard", "slot") else c for c in docs.columns}
    shards = options.get("shards", SHARDS)
    out = shuffle_shards(docs, **options).select("shard", "slot", *[F.col(f"record.`{c}`").alias(n) for c, n in own.items()])
    # as many slots in each file, counted for the mean shard
    each = max(1, -(-docs.count() // (shards * files)))
    file = F.least(F.floor(F.col("slot") / each), F.lit(files - 1)).cast("int")
    dealt = out.repartitionById(shards * files, F.col("shard") * files + file)
    dealt.sortWithinPartitions("shard", "slot").write.mode("overwrite").partitionBy("shard").parquet(path)
