"""Source divergence audit: how the sources of a language differ from each other and from it in their use of terms."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shotlake.llm.common import materialise

#: Of UTF-8 bytes, which cuts texts as the same classes of code points do: letters of ASCII and all that lies beyond it.
TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LEAST_DOCS, TOP, PRIOR, UNIT = 30, 50, 5, 1_000_000_000
#: Terms fall into so many buckets of a language by their hash; a range of buckets with about CHUNK kept terms is one part
#: of the pairs' work, and BLOCK sources with BLOCK others are one task of it.
BUCKETS, CHUNK, BLOCK = 16_384, 65_536, 8
#: Distinct terms that a task counts before it hands them on, and bytes of a text that are cut into terms at once.
HELD, PIECE = 1 << 18, 1 << 20


def _terms(text: bytes) -> Iterator[list[bytes]]:
    text, at = text.lower(), 0  # of bytes, only A to Z
    while len(text) - at > PIECE:
        end = at + PIECE
        last = TERM.match(text, end)
        end = last.end() if last else end
        yield TERM.findall(text, at, end)
        at = end
    yield TERM.findall(text, at)


def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (lang, source, text as bytes): (lang, source, term, n, docs), several rows of a term where a task has many.
    Each group also gives a row with an empty term."""
    groups: dict[tuple, tuple[Counter, Counter]] = {}
    held = 0

    def handed() -> pa.RecordBatch:
        rows = [(*g, t, n, docs[t]) for g, (all_, docs) in groups.items() for t, n in [(b"", 0), *all_.items()]]
        names = ("lang", "source", "term", "n", "docs")
        columns = list(zip(*rows)) if rows else [()] * 5
        kinds = (pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    for batch in batches:
        langs, sources, texts = (batch.column(i) for i in range(3))
        for lang, source, text in zip(langs.to_pylist(), sources.to_pylist(), texts):
            group = groups.get((lang, source))
            if group is None:
                group = groups[lang, source] = (Counter(), Counter())
            before, found = len(group[0]), set()
            for terms in _terms(text.as_buffer().to_pybytes()):
                group[0].update(terms)
                found.update(terms)
            group[1].update(found)
            held += len(group[0]) - before
            if held > HELD:
                yield handed()
                groups, held = {}, 0
    yield handed()


def price(counts: np.ndarray, total: int, kept: int) -> np.ndarray:
    """1 + floor(UNIT * (count + PRIOR) / (total + PRIOR * kept)), by three long divisions that stay within 64 bits."""
    d, r, q = total + PRIOR * kept, counts + PRIOR, np.zeros(len(counts), np.int64)
    for _ in range(3):
        r = r * 1000
        q, r = q * 1000 + r // d, r % d
    return q + 1


def gallop(needles: np.ndarray, hay: np.ndarray) -> np.ndarray:
    """For each needle the first place in hay that isn't below it; both ascend, from 0. All needles at once step away from
    where their rank would put them, twice as far each time, until they have passed their place, and halve what lies between."""
    hay = np.concatenate([[-1], hay, [np.iinfo(np.int64).max]])
    low, step = np.arange(len(needles)) * (len(hay) - 1) // max(len(needles), 1), 1
    while (over := hay[low] >= needles).any():
        low = np.where(over, np.maximum(low - step, 0), low)
        step *= 2
    high, step = low + 1, 1
    while (under := hay[high] < needles).any():
        low, high = np.where(under, high, low), np.where(under, np.minimum(high + step, len(hay) - 1), high)
        step *= 2
    while (high - low > 1).any():
        middle = (low + high) // 2
        under = hay[middle] < needles
        low, high = np.where(under, middle, low), np.where(under, high, middle)
    return low


def difference(a: tuple, b: tuple) -> tuple[int, int]:
    """Sum of |p - q| over the terms that a or b has, and how many these are. a, b: ascending ids, prices, price of a
    term that is absent."""
    if len(a[0]) > len(b[0]):
        a, b = b, a
    at = gallop(a[0], b[0])
    both = np.zeros(len(at), bool)
    inside = at < len(b[0])
    both[inside] = b[0][at[inside]] == a[0][inside]
    shared = np.abs(a[1][both] - b[1][at[both]]).sum()
    one_sided = np.abs(a[1][~both] - b[2]).sum() + np.abs(b[1] - a[2]).sum() - np.abs(b[1][at[both]] - a[2]).sum()
    return int(shared + one_sided), len(a[0]) + len(b[0]) - int(both.sum())


_PAIR = "lang string, a string, b string, value long, there long, apart long, kept long"


def _merge(left: pa.Table, right: pa.Table) -> pa.Table:
    """Each unordered pair of the groups in left and right, or within left if there is no right."""

    def groups(table: pa.Table) -> list[tuple]:
        out = []
        for r in range(table.num_rows):
            source, total, kept = (table.column(c)[r].as_py() for c in ("source", "total", "kept"))
            ids, counts = (table.column(c)[r].values.to_numpy(zero_copy_only=False) if table.column(c)[r].is_valid else np.empty(0, np.int64) for c in ("ids", "counts"))
            none = int(price(np.zeros(1, np.int64), total, kept)[0]) if kept else 0
            out.append((source, total, kept, (ids, price(counts, total, kept) if len(ids) else np.empty(0, np.int64), none)))
        return out

    mine, others, rows = groups(left), groups(right), []
    for i, x in enumerate(mine):
        for y in others if right.num_rows else mine[i + 1 :]:
            value, there = difference(x[3], y[3])
            rows.append((left.column("lang")[0].as_py(), x[0], y[0], value, there, abs(x[3][2] - y[3][2]), x[2]))
    columns = list(zip(*rows)) if rows else [()] * 7
    kinds = [pa.string()] * 3 + [pa.int64()] * 4
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=[c.split()[0] for c in _PAIR.split(", ")])


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP, chunk: int = CHUNK, block: int = BLOCK) -> DataFrame:
    """(lang, source, part, item, value, rank) over all rows of docs (text, lang, source; nulls as '').

    A language keeps the terms that at least least_docs of its documents hold. Every group (lang, source) and every
    language gives a kept term the price 1 + floor(10^9 * (count + 5) / (total + 5 * kept terms)). Part `pair`: every other
    source of the language by the summed differences of prices. Part `term`: the top terms that a group prices above its
    language. Rank counts from 1 by value descending, then by item.

    Repeated rows count as documents of their own, and doc_id isn't looked at. A language without kept terms gives all its
    pairs the value 0 and no terms; an empty table gives no rows; further columns are left behind.

    Counting combines within each task, then by (lang, source, term); the terms of a language are numbered by hashed
    buckets; a pair of groups meets once for each range of buckets, as two sorted arrays of (term id, count) that are
    merged by galloping. A common term or a large source is one row in all that follows the first aggregation.
    """
    text = lambda c: F.coalesce(docs[c], F.lit(""))
    rows = docs.select(text("lang").alias("lang"), text("source").alias("source"), text("text").cast("binary").alias("text"))
    counts = rows.mapInArrow(count_terms, "lang string, source string, term binary, n long, docs long")
    counts = counts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    counts = counts.withColumn("bucket", F.pmod(F.xxhash64("term"), F.lit(BUCKETS))).repartition("lang", "bucket")
    one = Window.partitionBy("lang", "bucket", "term")
    known = counts.withColumn("first", (F.row_number().over(one.orderBy("source")) == 1).cast("long"))
    known = known.withColumns({"holders": F.sum("docs").over(one), "lang_n": F.sum("n").over(one)})
    named = F.octet_length("term") > 0
    known = known.where((F.col("holders") >= least_docs) | ~named)
    place = F.dense_rank().over(Window.partitionBy("lang", "bucket").orderBy("term"))
    known = known.withColumn("id", F.shiftleft("bucket", 32) + place).select("lang", "source", "term", "n", "first", "lang_n", "bucket", "id")
    known = materialise(known, "terms")
    terms = known.where(named)

    langs = terms.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.sum("first").alias("kept"))
    totals = terms.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = known.where(~named).select("lang", "source").join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.na.fill(0, ["total", "lang_total", "kept"])
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = groups.withColumn("block", F.floor(number / block).cast("int"))
    groups = groups.withColumn("blocks", F.max("block").over(Window.partitionBy("lang")) + 1)
    groups = materialise(groups.withColumn("chunks", F.least(F.ceil(F.col("kept") / chunk), F.lit(BUCKETS))), "groups")

    own = groups.select("lang", "source", "chunks")
    arrays = terms.join(own, ["lang", "source"]).withColumn("chunk", F.expr(f"bucket * chunks div {BUCKETS}"))
    arrays = arrays.groupBy("lang", "source", "chunk").agg(F.array_sort(F.collect_list(F.struct("id", "n"))).alias("terms"))
    arrays = arrays.select("lang", "source", "chunk", F.col("terms.id").alias("ids"), F.col("terms.n").alias("counts"))
    every = groups.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest("chunks", F.lit(1)) - 1)).alias("chunk"))
    every = materialise(every.join(arrays, ["lang", "source", "chunk"], "left").select("lang", "chunk", "source", "total", "kept", "block", "blocks", "ids", "counts"), "arrays")
    data = ["source", "total", "kept", "ids", "counts"]
    left = every.select("lang", "chunk", F.col("block").alias("one"), F.explode(F.sequence("block", F.col("blocks") - 1)).alias("other"), *data)
    fresh = [F.col(c).alias(c) for c in ["lang", "chunk", *data]]  # the sides of a cogroup may not share columns
    right = every.where("block > 0").select(*fresh, "block").select("lang", "chunk", F.explode(F.sequence(F.lit(0), F.col("block") - 1)).alias("one"), F.col("block").alias("other"), *data)
    task = ["lang", "chunk", "one", "other"]
    merged = left.groupBy(*task).cogroup(right.groupBy(*task)).applyInArrow(_merge, _PAIR)
    merged = merged.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("there").alias("there"), F.max("apart").alias("apart"), F.max("kept").alias("kept"))
    merged = merged.withColumn("value", F.col("value") + (F.col("kept") - F.col("there")) * F.col("apart"))
    way = lambda x, y: F.struct(F.col(x).alias("source"), F.col(y).alias("item"))
    pairs = merged.select("lang", F.explode(F.array(way("a", "b"), way("b", "a"))).alias("w"), "value").select("lang", "w.source", F.lit("pair").alias("part"), "w.item", "value")
    ranked = lambda df: df.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))

    cost = lambda n, total: F.expr(f"1 + (CAST({n} + {PRIOR} AS DECIMAL(19, 0)) * {UNIT}) div ({total} + {PRIOR} * kept)")
    priced = terms.join(groups.select("lang", "source", "total", "lang_total", "kept"), ["lang", "source"])
    priced = priced.withColumn("value", cost("n", "total") - cost("lang_n", "lang_total")).where("n > 0 AND value > 0")
    priced = priced.select("lang", "source", F.lit("term").alias("part"), F.col("term").cast("string").alias("item"), "value")
    return ranked(pairs).unionByName(ranked(priced).where(F.col("rank") <= top))
