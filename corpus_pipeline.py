"""A corpus from raw documents: stages that each apply one operator of shotlake.llm to all that came before.

Toxic documents go; of documents that are alike one stays; secrets are masked; sources are mixed to tempered
weights, which repeats documents of small sources and drops none; token ids are packed into sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shotlake.llm import jaccard_join, mixing, packing, secret_scan, toxicity
from shotlake.llm.common import documents, materialise


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain, fitted on the labelled ones among docs, doesn't call toxic. A null or empty text is not
    toxic, a null id stays, repeated rows are judged alike, an empty table gives an empty one; columns of any names are
    kept, as the row travels as a struct."""
    chain = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, chain).where("not toxic").select("record.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least doc_id of each group of linked ones; of rows with one id that are linked by it, one
    of each text. Documents without an id stay, and so do those without words but for repeated rows of one id."""
    found = materialise(jaccard_join.join_components(docs), "groups")
    # written, so that its size is known: few ids are broadcast, and the texts stay where they are
    gone = materialise(found.where("doc_id <> component_id").select(F.col("doc_id").alias("_gone")), "gone")
    kept = docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")
    again = found.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("_again"))
    again = materialise(again, "again")
    if again.isEmpty():
        return kept
    # only rows whose id is repeated are compared as a whole
    single = kept.join(again, kept["doc_id"] == again["_again"], "left_anti")
    return single.unionByName(kept.join(again, kept["doc_id"] == again["_again"], "left_semi").dropDuplicates(["doc_id", "text"]))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked; all other columns, null ids and repeated rows as they are, null texts null."""
    return secret_scan.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document at least once, small sources more often. A null source is a source, documents without tokens come
    once, of repeated rows each counts; an empty table gives an empty one; further columns are kept."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences. A null text is empty: its end is a piece of one token;
    null ids stay null, repeated rows are packed as often; an empty table gives none; other columns end here."""
    return packing.pack(docs)


#: (name, function of (spark, docs, sf_dir)); each result is written and read again as the next one's docs.
STAGES = [
    ("toxicity", drop_toxic),
    ("jaccard_join", drop_near_duplicates),
    ("secret_scan", mask_secrets),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: The first stage learns a model and the last tokenises, which SQL can't express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply STAGES to the documents; all but the last result are written to the shared folder. Odd rows (null ids and
    texts, repeated rows, empty tables) pass as each stage says."""
    docs = documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialise(docs, name)
    return docs
