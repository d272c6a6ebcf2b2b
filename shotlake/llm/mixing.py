"""Mixing sources to target weights by temperature, in native expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shotlake.llm.common import SEED, materialise

#: A token of the shares: a run of characters other than ASCII white space.
TOKEN = r"[^\x20\x09-\x0D]+"
#: No source is repeated more often than this, if no entropy is asked for.
MAX_REPETITION = 1.5
#: Documents meant for one block of a permutation.
BLOCK = 4096


def counted(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(doc_id, source, n_tokens), written once: only these columns are moved. Null text counts 0 tokens; null
    sources are one source of their own."""
    n = F.regexp_count(F.coalesce(docs[text_col], F.lit("")), F.lit(TOKEN)).cast("long")
    return materialise(docs.select(docs[id_col].cast("long").alias("doc_id"), docs[source_col].cast("string").alias("source"), n.alias("n_tokens")), "mixing")


def weights(rows: DataFrame, target_entropy: float | None = None, max_repetition: float = MAX_REPETITION, budget: int | None = None) -> DataFrame:
    """One row per source with tokens: source, tokens, share, exponent, weight, budget, epochs, rest.

    weight is share ** exponent, normalised. The exponent lies in [0, 1] and is the largest that gives
    target_entropy (in nats; 1 if the shares already have more), or else the smallest that repeats no source more
    than max_repetition times. Without a budget of tokens, the mixture is the least that holds every document
    once. A source's budget is met by `epochs` whole permutations and `rest` tokens of a further one.

    Sources stay rows of a table, however many there are. Those of equal size are counted together, and the bisection
    asks that table for sums over it; only the sums, the least and the largest size reach the driver.
    """
    shares = materialise(rows.groupBy("source").agg(F.sum("n_tokens").alias("tokens")).where("tokens > 0"), "shares")
    alike = materialise(shares.groupBy("tokens").agg(F.count("*").alias("n")), "sizes")
    least, most, total = alike.agg(F.min("tokens"), F.max("tokens"), F.sum(F.col("tokens") * F.col("n"))).first()
    share = F.col("tokens") / F.lit(float(total or 1))

    def sums(exponents: list[float]) -> list[tuple[float, float]]:
        """Of each exponent the sum of share ** exponent over all sources, and that of its products with ln share."""
        raised = [F.col("n") * F.pow(share, F.lit(a)) for a in exponents]
        got = alike.agg(*[F.sum(r).alias(f"s{i}") for i, r in enumerate(raised)], *[F.sum(r * F.log(share)).alias(f"l{i}") for i, r in enumerate(raised)]).first()
        return list(zip(got[: len(raised)], got[len(raised) :]))

    def met(exponents: list[float]) -> list[bool]:
        if target_entropy is not None:
            return [math.log(s) - a * x / s >= target_entropy for a, (s, x) in zip(exponents, sums(exponents))]
        if budget is None:
            # the source repeated least, the largest, is taken once, and the smallest is repeated most
            return [(most / least) ** (1 - a) <= max_repetition for a in exponents]
        return [(least / total) ** (a - 1) / s * budget / total <= max_repetition for a, (s, _) in zip(exponents, sums(exponents))]

    exponent = normal = 1.0
    if total:
        # the condition holds for small exponents where an entropy is asked for, for large ones with a limit
        small = target_entropy is not None
        lo, hi = 0.0, 1.0
        if met([1.0 if small else 0.0])[0]:
            lo = hi = 1.0 if small else 0.0
        while lo < (lo + hi) / 2 < hi:
            # four halvings at a time: all places where they can come to are asked for together
            places = [lo + (hi - lo) * k / 16 for k in range(17)]
            holds = met(places[1:-1])
            a, b = 0, 16
            while b - a > 1:
                k = (a + b) // 2
                a, b = (k, b) if holds[k - 1] == small else (a, k)
            lo, hi = places[a], places[b]
        exponent = lo if small else hi
        normal = sums([exponent])[0][0]
    raised = F.pow(share, F.lit(exponent))
    # the largest source is taken once, if there is no budget
    wanted = raised * F.lit(float(total or 0) * ((most or 1) / (total or 1)) ** (1 - exponent)) if budget is None else raised / F.lit(normal) * F.lit(float(budget))
    each = shares.select("source", "tokens", share.alias("share"), F.lit(exponent).alias("exponent"), (raised / F.lit(normal)).alias("weight"), F.round(wanted).cast("long").alias("budget"))
    epochs = F.floor(F.col("budget") / F.col("tokens")).cast("int")
    return each.withColumn("epochs", epochs).withColumn("rest", F.col("budget") - F.col("epochs") * F.col("tokens"))


def _order(epoch: Column, seed: int, *key: Column) -> Column:
    """A seeded hash of 60 bits that other engines can give as well: the first digits of an MD5."""
    parts = [F.coalesce(c.cast("string"), F.lit("null")) for c in (F.lit(seed), epoch, *key)]
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts).cast("binary")), 1, 15), 16, 10).cast("long")


def positions(rows: DataFrame, mixture: DataFrame, seed: int = SEED, block: int = BLOCK) -> DataFrame:
    """The mixture as budgeted block permutations of each source's documents: one row per use of a document, with
    doc_id, source, n_tokens, epoch, block, slot (in the block), start (the source's tokens before it) and
    position in [0, 1).

    An epoch is a permutation: a seeded hash deals documents into blocks of about `block`, and orders them within
    a block. In the last epoch a document is used while tokens are left when it starts. Sorting by position
    interleaves the sources so that each prefix has their weights. A hot source is many blocks, and only the sums
    of blocks are ordered by source. Sources without tokens are used once.
    """
    sizes = rows.groupBy("source").count().withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("count") / block)).cast("int"))
    plan = sizes.join(mixture, sizes["source"].eqNullSafe(mixture["source"]), "left").select(sizes["source"].alias("of"), "blocks", "budget", F.coalesce("epochs", F.lit(1)).alias("epochs"), F.coalesce("rest", F.lit(0).cast("long")).alias("rest"))
    plan = materialise(plan, "mixing-plan")
    last = F.col("epochs") + F.when(F.col("rest") > 0, 0).otherwise(-1)
    used = rows.join(F.broadcast(plan) if _few(plan) else plan, rows["source"].eqNullSafe(plan["of"])).where(last >= 0)
    used = used.select("doc_id", "source", "n_tokens", "blocks", "budget", "epochs", "rest", F.explode(F.sequence(F.lit(0), last)).alias("epoch"))
    mixed = _order(F.col("epoch"), seed, F.col("doc_id"), F.col("n_tokens"))
    used = used.withColumn("order", mixed).withColumn("block", F.floor(F.col("order") / F.lit(2.0**60) * F.col("blocks")).cast("int"))
    sums = used.groupBy("source", "epoch", "block").agg(F.sum("n_tokens").alias("sum"))
    before = Window.partitionBy("source", "epoch").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("source").alias("s"), F.col("epoch").alias("e"), F.col("block").alias("b"), F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("source", "epoch", "block").orderBy("order", "doc_id", "n_tokens")
    earlier = within.rowsBetween(Window.unboundedPreceding, -1)
    used = used.withColumn("slot", F.row_number().over(within) - 1).withColumn("inner", F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0)))
    used = used.join(sums, used["source"].eqNullSafe(sums["s"]) & (F.col("epoch") == F.col("e")) & (F.col("block") == F.col("b")))
    at = F.col("base") + F.col("inner")
    used = used.withColumn("in_epoch", at).where((F.col("epoch") < F.col("epochs")) | (F.col("in_epoch") < F.col("rest")))
    whole = F.col("in_epoch") + F.col("epoch") * ((F.col("budget") - F.col("rest")) / F.greatest(F.col("epochs"), F.lit(1))).cast("long")
    whole = F.when(F.col("epochs") == 0, F.col("in_epoch")).otherwise(whole)
    return used.select(
        "doc_id",
        "source",
        "n_tokens",
        "epoch",
        "block",
        F.col("slot").cast("int").alias("slot"),
        F.coalesce(whole, F.col("in_epoch")).alias("start"),
        (F.coalesce(whole, F.lit(0)) / F.coalesce(F.col("budget"), F.lit(1))).alias("position"),
    )


#: Sources up to which their plan is broadcast; beyond, the join shuffles.
FEW_SOURCES = 10_000


def _few(plan: DataFrame) -> bool:
    return plan.limit(FEW_SOURCES + 1).count() <= FEW_SOURCES


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", target_entropy: float | None = None, max_repetition: float = MAX_REPETITION, budget: int | None = None, seed: int = SEED) -> DataFrame:
    """docs with its columns, each row as often as the mixture uses it.

    Whole epochs repeat every row of a source where it lies. Rows of the last epoch are those whose (order, id,
    tokens) come before the first unused one, found from ids and counts alone: texts are not shuffled.
    Null ids and sources are kept, repeated rows are used alike, an empty table gives none.
    """
    rows = counted(docs, id_col, source_col, text_col)
    mixture = weights(rows, target_entropy, max_repetition, budget)
    uses = positions(rows, mixture, seed)
    at = _order(F.col("epoch"), seed, F.col("doc_id"), F.col("n_tokens"))
    # of each source the last epoch, and in that the greatest row in its order
    key = F.struct(F.col("epoch").alias("last"), at.alias("o"), F.coalesce("doc_id", F.lit(-(1 << 63))).alias("d"), F.col("n_tokens").alias("n"))
    ends = uses.groupBy("source").agg(F.max(key).alias("k")).select(F.col("source").alias("_of"), "k.last", F.struct("k.o", "k.d", "k.n").alias("end"))
    ends = materialise(ends, "mixing-ends")
    source, text = docs[source_col].cast("string"), F.coalesce(docs[text_col], F.lit(""))
    record = F.struct(*[docs[f"`{c}`"] for c in docs.columns])
    all_rows = docs.select(source.alias("_source"), docs[id_col].cast("long").alias("doc_id"), F.regexp_count(text, F.lit(TOKEN)).cast("long").alias("n_tokens"), record.alias("record"))
    joined = all_rows.join(F.broadcast(ends) if _few(ends) else ends, all_rows["_source"].eqNullSafe(ends["_of"]))
    mine = F.struct(_order(F.col("last"), seed, F.col("doc_id"), F.col("n_tokens")).alias("o"), F.coalesce("doc_id", F.lit(-(1 << 63))).alias("d"), F.col("n_tokens").alias("n"))
    times = F.col("last") + F.when(mine <= F.col("end"), 1).otherwise(0)
    return joined.select("record", F.explode(F.array_repeat(F.lit(0), times.cast("int"))).alias("_")).select("record.*")
