"""What the operators share: input columns, scratch tables, size estimates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shotlake.sources.scratch import new_path

#: Seed of every seeded hash unless a caller gives another.
SEED = 42


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole documents table."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only (doc_id, text), null text as empty; other columns, whatever their names, are left behind."""
    return docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet into the shared folder and read it back: lineage is cut, a lost executor costs at most
    the tasks that it ran, and the shuffle files behind df are removed."""
    spark, cleanup = df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    path, was = new_path(spark, name), spark.conf.get(cleanup, "false")
    spark.conf.set(cleanup, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(cleanup, was)
    return spark.read.schema(df.schema).parquet(path)


def size_hint(df: DataFrame) -> int:
    """Catalyst's estimate of df in bytes: for a scan, the size of its files; 0 where it knows none."""
    found = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return found if found < 1 << 60 else 0


def input_size(df: DataFrame) -> int:
    """size_hint, or where the planner knows none (a table made from rows, say) the length of df's rows as JSON."""
    found = size_hint(df)
    if not found:
        width = F.octet_length(F.to_json(F.struct(*[df[f"`{c}`"].alias(f"c{i}") for i, c in enumerate(df.columns)])))
        found = df.agg(F.coalesce(F.sum(width.cast("long")), F.lit(0).cast("long"))).first()[0]
    return found


def partitions_for(df: DataFrame, bytes_each: int) -> int:
    """Partitions that keep each near bytes_each of the input, at least the session's shuffle partitions."""
    spark = df.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(1_000_000, -(-input_size(df) // bytes_each)))


def unit_hash(*cols: Column, seed: int = SEED) -> Column:
    """Seeded hash of cols as a non-negative long below 2^63."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *cols), 1)

