"""Hard negatives of anchor vectors, by exact integer products that score many candidates with each multiplication."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shotlake.llm.common import materialise

SCALE, POSITIVES, NEGATIVES, LEAST_PERCENT = 256, 5, 5, 80
#: Rows of one wide integer, and candidates and anchors that meet in one task.
PACKED, CANDIDATES, ANCHORS = 2048, 8192, 16_384
#: A score beyond this counts as this; one beyond a long is returned as the nearest long.
MOST = 10**38 - 1


class Packed:
    """Candidates' components, biased to be no less than 0, in separate fields of wide integers: one integer for each
    component and each PACKED candidates. A field is wide enough for the sum of all products with an anchor's components,
    themselves biased, so that no field reaches the next."""

    def __init__(self, rows: np.ndarray, least_anchor: int, most_anchor: int, packed: int = PACKED):
        self.rows, self.width = rows.shape
        low, high = int(rows.min(initial=0)), int(rows.max(initial=0))
        self.bias, self.anchor_bias = -low, -min(least_anchor, 0)
        lifted = max(most_anchor, 0) + self.anchor_bias
        bits = max(((high - low) * lifted * self.width).bit_length(), (high - low).bit_length(), 1)
        self.bytes = 4 if bits <= 32 else -(-bits // 64) * 8
        # the largest number that removing the biases can meet
        bound = (high - low + self.bias + 1) * (lifted + self.anchor_bias + 1) * (self.width + 1)
        self.kind = np.int64 if rows.dtype != object and bound < 1 << 60 else object
        shifted = rows - low
        self.sums = shifted.sum(1) if self.width else np.zeros(self.rows, shifted.dtype)
        self.parts = []
        for k in range(0, self.rows, packed):
            part = shifted[k : k + packed]
            self.parts.append((len(part), [int.from_bytes(self._fields(part[:, d]), "little") for d in range(self.width)]))

    def _fields(self, values: np.ndarray) -> bytes:
        if self.bytes <= 8 and values.dtype != object:
            return values.astype("<u4" if self.bytes == 4 else "<u8").tobytes()
        return b"".join(int(v).to_bytes(self.bytes, "little") for v in values)

    def scores(self, anchor: list[int]) -> np.ndarray:
        """The inner products of anchor with all rows: one multiplication for each component and wide integer."""
        lifted = [a + self.anchor_bias for a in anchor]
        out = []
        for count, wide in self.parts:
            total = 0
            for a, w in zip(lifted, wide):
                if a:
                    total += a * w
            raw = total.to_bytes(count * self.bytes, "little")
            if self.bytes <= 8:
                out.append(np.frombuffer(raw, "<u4" if self.bytes == 4 else "<u8"))
            else:
                out.append(np.array([int.from_bytes(raw[i : i + self.bytes], "little") for i in range(0, len(raw), self.bytes)], object))
        found = np.concatenate(out).astype(self.kind) if out else np.empty(0, np.int64)
        # sum (a - A)(c - C) of biased a and c = field - A * sum(c) - C * sum(a - A)
        return found - self.sums.astype(self.kind) * self.anchor_bias - sum(anchor) * self.bias


def best(scores: np.ndarray, chosen: np.ndarray, n: int) -> np.ndarray:
    """Places of the n highest scores among the chosen places (ascending), ties by place."""
    if len(chosen) > n:
        least = np.partition(-scores[chosen], n - 1)[n - 1]
        chosen = chosen[-scores[chosen] <= least]
    return chosen[np.argsort(-scores[chosen], kind="stable")][:n]


def _matrix(table: pa.Table, width: int) -> np.ndarray:
    """Rows of integer components. They come as doubles, each of them whole."""
    flat = table.column("parts").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    if len(flat) and np.abs(flat).max() >= 1 << 30:
        return np.array([int(v) for v in flat], object).reshape(table.num_rows, width)
    return flat.astype(np.int64).reshape(table.num_rows, width)


def _in_order(table: pa.Table) -> pa.Table:
    return table.sort_by([("vec_id", "ascending"), ("seq", "ascending")])


def _meet(anchors: pa.Table, rows: pa.Table, found: callable) -> pa.Table:
    """found(anchor's row, scores, rows' seq, rows' labels) gives (slot, places); one output row for each place."""
    if not anchors.num_rows or not rows.num_rows:
        return _OUT.empty_table()
    width = rows.column("width")[0].as_py()
    rows, anchors = _in_order(rows), _in_order(anchors)
    asked = _matrix(anchors, width)
    packed = Packed(_matrix(rows, width), int(asked.min(initial=0)), int(asked.max(initial=0)))
    ids, seqs, labels = (rows.column(c).to_numpy() for c in ("vec_id", "seq", "label"))
    out = []
    for r in range(anchors.num_rows):
        one = {c: anchors.column(c)[r].as_py() for c in anchors.column_names if c != "parts"}
        scores = packed.scores([int(v) for v in asked[r]])
        for slot, places in found(one, scores, seqs, labels):
            out += [(one["seq"], slot, int(ids[k]), int(seqs[k]), max(-MOST, min(MOST, int(scores[k])))) for k in places]
    columns = list(zip(*out)) if out else [()] * 5
    columns[4] = [str(v) for v in columns[4]]
    return pa.table([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string()))], schema=_OUT)


_OUT = pa.schema([("anchor", pa.int64()), ("slot", pa.int32()), ("vec_id", pa.int64()), ("seq", pa.int64()), ("score", pa.string())])
_OUT_SQL = "anchor long, slot int, vec_id long, seq long, score string"


def _positives(anchors: pa.Table, rows: pa.Table, n: int) -> pa.Table:
    def found(one, scores, seqs, labels):
        yield 0, best(scores, np.flatnonzero((labels == one["label"]) & (seqs != one["seq"])), n)

    return _meet(anchors, rows, found)


def _negatives(anchors: pa.Table, rows: pa.Table, n: int, least_percent: int) -> pa.Table:
    def found(one, scores, seqs, labels):
        other = labels != one["label"]
        for positive in one["positives"]:
            most = int(positive["score"])
            least = -(-least_percent * most // 100)
            yield positive["slot"], best(scores, np.flatnonzero(other & (scores >= least) & (scores <= most)), n)

    return _meet(anchors, rows, found)


def mine(vectors: DataFrame, relabel_every: int = 7, labels: int = 10, anchor_every: int = 100, positives: int = POSITIVES, negatives: int = NEGATIVES, least_percent: int = LEAST_PERCENT, candidates: int = CANDIDATES, anchors: int = ANCHORS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of vectors (vec_id, embedding, label).

    Rows with a null label, a null vector, or a null or non-finite component take no part, nor do rows without an id, which a
    result couldn't name. Where vec_id is divisible by relabel_every, the label first becomes (label + 1) % labels. Components
    become floor(256 * x); a score is the inner product of these, exact below 10^38 and returned as the nearest long. Vectors
    of different lengths have no inner product and don't meet. Anchors are the rows whose vec_id is divisible by anchor_every;
    an anchor's positives are its highest other rows of its label, and under each positive it gets the highest rows of
    another label whose score is at least least_percent of the positive's and at most that. Ties go to the smaller vec_id.
    A component so large that 256 * x isn't finite counts as not finite.
    Repeated rows are rows of their own; an empty table gives no rows; further columns are left behind.

    Rows and anchors are dealt evenly into blocks by a hash of the row's number, and each block of anchors meets each block
    of rows in a task, so neither a label nor a repeated vector is a key of any shuffle. A task holds both blocks.
    """
    x = vectors.select(vectors["vec_id"].cast("long").alias("vec_id"), vectors["embedding"].cast("array<double>").alias("v"), vectors["label"].cast("long").alias("label"))
    whole = F.forall("v", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c * SCALE) < float("inf")), F.lit(False)))
    x = x.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()).where(whole)
    label = F.when(F.col("vec_id") % relabel_every == 0, (F.col("label") + 1) % labels).otherwise(F.col("label"))
    # doubles: 256 x is exact, and so is its floor
    parts = F.transform("v", lambda c: F.when(F.abs(c) < 2.0**53, F.floor(c * SCALE).cast("double")).otherwise(c * SCALE))
    x = materialise(x.select("vec_id", label.alias("label"), parts.alias("parts"), F.size("v").alias("width"), F.monotonically_increasing_id().alias("seq")), "vectors")
    asked = x.where(F.col("vec_id") % anchor_every == 0)
    n = x.agg(F.count("*").alias("rows"), F.count_if(F.col("vec_id") % anchor_every == 0).alias("anchors")).first()
    blocks, groups = max(1, -(-n["rows"] // candidates)), max(1, -(-n["anchors"] // anchors))
    block = lambda count: F.pmod(F.xxhash64("seq"), F.lit(count)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    cell = ["width", "block", "group"]
    fresh = [F.col(c).alias(c) for c in x.columns]  # the sides of a cogroup may not share columns
    rows = x.withColumn("block", block(blocks)).withColumn("group", every(groups)).select(*fresh, "block", "group")

    def met(df: DataFrame, task: callable) -> DataFrame:
        df = df.withColumn("group", block(groups)).withColumn("block", every(blocks))
        out = df.groupBy(*cell).cogroup(rows.groupBy(*cell)).applyInArrow(task, _OUT_SQL)
        return out.withColumn("score", F.col("score").cast("decimal(38,0)"))

    order = [F.desc("score"), "vec_id", "seq"]
    place = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    near = met(asked, lambda a, b: _positives(a, b, positives)).withColumn("slot", place("anchor")).where(F.col("slot") <= positives)
    near = materialise(near.select("anchor", "slot", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    wanted = near.groupBy(F.col("anchor").alias("seq")).agg(F.collect_list(F.struct("slot", F.col("positive_score").cast("string").alias("score"))).alias("positives"))

    far = met(asked.join(wanted, "seq"), lambda a, b: _negatives(a, b, negatives, least_percent)).withColumn("rank", place("anchor", "slot")).where(F.col("rank") <= negatives)
    ids = asked.select(F.col("seq").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    long = lambda c: F.greatest(F.least(F.col(c), F.lit(2**63 - 1).cast("decimal(38,0)")), F.lit(-(2**63)).cast("decimal(38,0)")).cast("long")
    out = far.select("anchor", "slot", "rank", F.col("vec_id").alias("negative_id"), long("score").alias("negative_score")).join(near, ["anchor", "slot"]).join(ids, "anchor")
    return out.select("anchor_id", "positive_id", "rank", "negative_id", long("positive_score").alias("positive_score"), "negative_score")
