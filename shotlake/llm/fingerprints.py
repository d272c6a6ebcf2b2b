"""Document fingerprints by winnowing, in native expressions."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shotlake.llm.common import partitions_for, unit_hash
from shotlake.llm.expressions import let, upto

#: Units of a gram and grams of a window: texts that share K + W - 1 units in a row share a fingerprint.
K, W = 4, 5
#: A unit: up to 24 characters of the scripts below U+0E00, or one other character, between white space.
UNIT = r"[\x21-\x7E\u00A1-\u0DFF]{1,24}|[^\x20\x09-\x0D]"
#: Stored bytes of text that a range of neighbours holds.
RANGE_BYTES = 8 << 20
#: Ranges at most: what their bounds need on the driver.
MOST_RANGES = 1 << 17
#: Keys that are sampled for each range.
SAMPLED = 20
#: The rolling hash: a polynomial of this base over the units' hashes, modulo this prime.
BASE, PRIME = 0x2C1B3C6D, (1 << 31) - 1


def rolled(units: Column, k: int) -> Column:
    """The rolling hashes of all grams of k of the units' hashes: the sum of hash times BASE to the power of the units
    that follow in the gram, modulo PRIME. A gram of a + b units is one of a, moved on by b units, plus one of b, so
    each length is made of the half as long ones that neighbours share: log k steps a gram, none of which hashes anew."""

    def longer(x: Column, y: Column, nx: int, ny: int) -> Column:
        return F.transform(upto(F.size(x) - ny), lambda i: (F.get(x, i) * F.lit(pow(BASE, ny, PRIME)) + F.get(y, i + nx)) % F.lit(PRIME))

    if k == 1:
        return units
    half = k // 2
    even = let(rolled(units, half), lambda g: longer(g, g, half, half))
    return let(even, lambda g: longer(g, units, k - 1, 1)) if k % 2 else even


def winnow(text: Column, k: int = K, w: int = W) -> Column:
    """Selected grams as array<struct<hash long, position long>>, by ascending position.

    Each gram of k units has a rolling hash of 31 bits. Of every w grams in a row the smallest hash is selected, of
    equal ones the rightmost. A text of fewer than k units is one gram; one without units (null, empty, white space)
    has no fingerprint. Fewer than w grams make one window.
    """
    low = F.lit(0xFFFFFFFF)

    def grams(units: Column) -> Column:
        def of(h: Column) -> Column:
            one = F.aggregate(h, F.lit(0).cast("long"), lambda a, x: (a * F.lit(BASE) + x) % F.lit(PRIME))
            return F.when(F.size(h) == 0, F.array().cast("array<bigint>")).when(F.size(h) < k, F.array(one)).otherwise(rolled(h, k))

        return let(F.transform(units, lambda u: F.pmod(F.xxhash64(u), F.lit(PRIME))), of)

    def placed(hashes: Column) -> Column:
        # the hash above, the position's complement below: the least is the smallest hash's rightmost place
        return F.transform(hashes, lambda h, i: F.shiftleft(h, 32).bitwiseOR(low - i))

    def least(values: Column) -> Column:
        windows = F.transform(upto(F.size(values) - (w - 1)), lambda i: F.least(*[values[i + j] for j in range(w)]))
        return F.when(F.size(values) == 0, values).when(F.size(values) < w, F.array(F.array_min(values))).otherwise(F.array_distinct(windows))

    units = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(UNIT), F.lit(0))
    selected = let(grams(units), lambda g: let(placed(g), least))
    return F.transform(selected, lambda x: F.struct(F.shiftrightunsigned(x, 32).alias("hash"), (low - x.bitwiseAND(low)).alias("position")))


def written(selected: Column) -> Column:
    """A fingerprint as text: hash in hex, @, position; space between."""
    return F.array_join(F.transform(selected, lambda s: F.concat(F.lower(F.hex(s["hash"])), F.lit("@"), s["position"].cast("string"))), " ")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of the hashes of two fingerprints; 1 where both are empty."""
    both = lambda x, y: F.when((F.size(x) == 0) & (F.size(y) == 0), F.lit(1.0)).otherwise(F.size(F.array_intersect(x, y)) / F.size(F.array_union(x, y)).cast("double"))
    return let(F.transform(a, lambda s: s["hash"]), lambda x: let(F.transform(b, lambda s: s["hash"]), lambda y: both(x, y)))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, w: int = W) -> DataFrame:
    """(doc_id, text, fingerprint) of every row: one scan, no shuffle. Null text counts as empty; repeated rows
    repeat; an empty table gives none; other columns are dropped."""
    text = F.coalesce(docs[text_col], F.lit(""))
    return docs.select(docs[id_col].cast("long").alias("doc_id"), text.alias("text"), winnow(docs[text_col], k, w).alias("fingerprint"))


_KEYS = "array<struct<o:bigint,h:bigint>>"


def _search(value: Column, ascending: list[tuple[int, int]]) -> Column:
    """How many of the ascending keys are below or equal to value, by bisection."""
    if not ascending:
        return F.lit(0)
    steps = len(ascending).bit_length() + 1
    bounds = F.from_json(F.lit(json.dumps([{"o": o, "h": h} for o, h in ascending])), _KEYS)  # one literal, however many there are

    def halve(b: Column, s: Column) -> Column:
        mid = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        right = F.get(b, mid) <= value
        open_ = s["lo"] < s["hi"]
        return F.struct(F.when(open_ & right, mid + 1).otherwise(s["lo"]).alias("lo"), F.when(open_ & ~right, mid).otherwise(s["hi"]).alias("hi"))

    start = F.struct(F.lit(0).alias("lo"), F.lit(len(ascending)).alias("hi"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, lambda s, _: halve(bounds, s))["lo"]


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, next_text): each row and the text of the row after it by descending doc_id, after the last
    that of the first. Null ids come last; rows of one id, or of none, follow each other by their texts' hashes.

    Rows are dealt once, by ranges of (id, hash), whose bounds come from a sample of SAMPLED keys a range; a frequent id
    is several ranges, and only rows that are equal in both stay together. The first row of each range also goes, as a
    guest, to the range before it. Only the sample, and the ranges' bounds and first keys, at most MOST_RANGES, reach the
    driver; no result depends on the sample.
    """
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    rows = rows.withColumn("key", F.struct(F.coalesce(F.col("doc_id"), F.lit(-(1 << 63))).alias("o"), F.xxhash64("text").alias("h")))
    n = min(MOST_RANGES, partitions_for(docs, RANGE_BYTES))
    # chosen by the key, before texts are read for more than their hash
    share = min(1.0, SAMPLED * n / max(1, docs.count()))
    some = rows.where(unit_hash(F.col("key.o"), F.col("key.h")) < F.lit(min(int(share * 2**63), 2**63 - 1))).select("key").distinct().collect() if n > 1 else []
    keys = sorted((r["key"]["o"], r["key"]["h"]) for r in some)
    cuts = sorted({keys[len(keys) * i // n] for i in range(1, n)}) if keys else []
    rows = rows.withColumn("range", _search(F.col("key"), cuts))
    first = sorted(((r["range"], (r["top"]["o"], r["top"]["h"])) for r in rows.groupBy("range").agg(F.max("key").alias("top")).collect()), reverse=True)
    if not first:
        return rows.select("doc_id", "text", F.col("text").alias("next_text"))
    before = [first[i - 1][0] for i in range(len(first))][::-1]
    tops = [top for _, top in first][::-1]
    place = _search(F.col("key"), tops)
    is_top = F.get(F.from_json(F.lit(json.dumps([{"o": o, "h": h} for o, h in tops])), _KEYS), place - 1) == F.col("key")
    goes = F.get(F.from_json(F.lit(json.dumps(before)), "array<bigint>"), place - 1)
    homes = F.array(F.struct(F.col("range").cast("long").alias("range"), F.lit(False).alias("guest")))
    guests = F.array(F.struct(goes.alias("range"), F.lit(True).alias("guest")))
    rows = rows.select("doc_id", "text", "key", F.explode(F.when(is_top, F.concat(homes, guests)).otherwise(homes)).alias("at"))
    order = Window.partitionBy("at.range").orderBy(F.col("at.guest"), F.desc("key"))
    return rows.select("doc_id", "text", F.col("at.guest").alias("guest"), F.lead("text").over(order).alias("next_text")).where(~F.col("guest")).drop("guest")


def compare_with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, w: int = W) -> DataFrame:
    """For each row: its text, its edited text (the last third of its code points replaced by as many first ones
    of the next row), the fingerprints of both and of the next text."""
    rows = with_next(docs, id_col, text_col)
    n = F.length("text")
    m = F.floor(n / 3).cast("int")
    rows = rows.withColumn("edited", F.concat(F.substring(F.col("text"), F.lit(1), n - m), F.substring(F.col("next_text"), F.lit(1), m)))
    own, edited, following = (winnow(F.col(c), k, w) for c in ("text", "edited", "next_text"))
    return rows.select("doc_id", "text", "edited", "next_text", F.transform(F.array(F.struct(own.alias("own"), edited.alias("edited"), following.alias("following"))), lambda s: s)[0].alias("fingerprints"))
