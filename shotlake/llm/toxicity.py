"""Toxicity by a classifier chain over hashed words and word beginnings."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shotlake.llm.common import SEED
from shotlake.llm.linear import Sparse, fit, predict

#: Labelled rows that the models are fitted on at most, columns that they keep at most, folds, rejection.
TRAIN, COLUMNS, FOLDS, THRESHOLD = 6_000, 8_192, 3, 0.35
#: Standard deviations by which a column's presence must tell a category from chance to be kept.
MARGIN = 4.0
#: Rounds of a fit.
ROUNDS = 150
#: Hashed columns; bytes of the word beginnings that are features beside whole words.
BITS, BEGINNINGS = 22, (3, 4, 5, 6)
#: Words whose features a worker remembers before it starts afresh.
REMEMBERED = 1_000_000

#: Kinds of toxic rows that the earlier models of the chain predict, and columns that tell kinds apart at most.
KINDS, TELLING = 2, 512
NAMES = [*[f"kind_{k + 1}" for k in range(KINDS)], "toxic"]

_LETTERS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def words_of(text: str) -> set[bytes]:
    """Distinct words in lower case: runs of ASCII letters and characters beyond ASCII."""
    return set(text.lower().encode().translate(_LETTERS).split())


def hashed(word: bytes) -> set[int]:
    mask = (1 << BITS) - 1
    return {zlib.crc32(word) & mask} | {zlib.crc32(b"^" + word[:k]) & mask for k in BEGINNINGS if len(word) >= k}


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = [np.fromiter({h for w in words_of(t.as_py()) for h in hashed(w)}, np.int32) for t in b.column("text")]
        yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(found, pa.list_(pa.int32()))], [*b.schema.names[:-1], "features"])


class Chain:
    """Models of the categories in order; each sees the probabilities of those before it."""

    def __init__(self, columns: list[int], models: list[np.ndarray]):
        self.place, self.models = {c: i for i, c in enumerate(columns)}, models

    def predict(self, rows: list[np.ndarray]) -> np.ndarray:
        x = Sparse(rows, None, len(self.place))
        dense = np.zeros((len(rows), 0))
        for w in self.models:
            dense = np.concatenate([dense, predict(x, dense, w)[:, None]], 1)
        return dense


def _worth(kinds: int, code: np.ndarray, row: np.ndarray, y: np.ndarray) -> np.ndarray:
    """By how many standard deviations each column's presence tells rows with y from chance; -1 for columns that one
    row alone has."""
    total, hit, p = np.bincount(code, minlength=kinds), np.bincount(code, y[row], kinds), y.mean()
    return np.where(total > 1, (hit - p * total) / np.sqrt(total * max(p * (1 - p), 1e-9) + 1), -1)


def kinds_of(features: list[np.ndarray], toxic: np.ndarray, k: int = KINDS, telling: int = TELLING, rounds: int = 20) -> np.ndarray:
    """A 0/1 matrix of which toxic rows are of which of k kinds. The labels name no categories but the last, so the
    earlier ones are learned: toxic rows are clustered by the columns that speak most for toxicity, rare ones weighing
    more, by spherical k-means from the rows that are farthest apart."""
    out = np.zeros((len(features), k))
    rows = np.flatnonzero(toxic > 0)
    columns, code = np.unique(np.concatenate(features), return_inverse=True)
    row = np.repeat(np.arange(len(features)), [len(f) for f in features])
    worth = _worth(len(columns), code, row, toxic)
    best = np.argsort(-worth, kind="stable")[:telling]
    best = best[worth[best] >= MARGIN]
    if len(rows) < k or not len(best):
        return out
    place, at = np.full(len(columns), -1), np.full(len(features), -1)
    place[best], at[rows] = np.arange(len(best)), np.arange(len(rows))
    hit = (at[row] >= 0) & (place[code] >= 0)
    x = np.zeros((len(rows), len(best)))
    x[at[row[hit]], place[code[hit]]] = 1
    x *= np.log1p(len(rows) / np.maximum(x.sum(0), 1))
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    centres = x[[int(np.argmax(x @ x.sum(0)))]]
    while len(centres) < k:
        centres = np.concatenate([centres, x[[int(np.argmin((x @ centres.T).max(1)))]]])
    for _ in range(rounds):
        mine = (x @ centres.T).argmax(1)
        centres = np.stack([x[mine == j].sum(0) if (mine == j).any() else centres[j] for j in range(k)])
        centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-9)
    out[rows, (x @ centres.T).argmax(1)] = 1
    return out


def fit_chain(features: list[np.ndarray], labels: np.ndarray, columns: int = COLUMNS, folds: int = FOLDS) -> Chain:
    """Fit a chain on rows of hashed features and a matrix of 0/1 labels, one column a category.

    Later models see out-of-fold probabilities of earlier categories, so that they meet errors like those at
    prediction. The columns kept are those whose presence speaks most for the last category, by MARGIN at least: what
    is common in harmless texts must not outweigh a few toxic words in a long one.
    """
    n, flat = len(features), np.concatenate(features)
    kinds, code = np.unique(flat, return_inverse=True)
    code = code.astype(np.int32)
    del flat
    row = np.repeat(np.arange(n, dtype=np.int32), [len(f) for f in features])
    worth = _worth(len(kinds), code, row, labels[:, -1])
    best = np.argsort(-worth, kind="stable")[:columns]
    kept = np.sort(best[worth[best] >= MARGIN])
    place = np.full(len(kinds), -1)
    place[kept] = np.arange(len(kept))
    bounds = np.cumsum([0, *[len(f) for f in features]])
    rows = [c[c >= 0] for c in (place[code[a:b]] for a, b in zip(bounds, bounds[1:]))]
    del code, row, place
    fold = np.arange(n) % folds
    dense, models = np.zeros((n, 0)), []
    everything = Sparse(rows, None, len(kept))
    for k, y in enumerate(labels.T):
        models.append(fit(everything, dense, y, rounds=ROUNDS))
        if k + 1 < labels.shape[1]:
            out = np.zeros(n)
            for f in range(folds):
                inside, outside = np.flatnonzero(fold != f), np.flatnonzero(fold == f)
                if len(inside) and len(outside):
                    w = fit(Sparse([rows[i] for i in inside], None, len(kept)), dense[inside], y[inside], rounds=ROUNDS)
                    out[outside] = predict(Sparse([rows[i] for i in outside], None, len(kept)), dense[outside], w)
            dense = np.concatenate([dense, out[:, None]], 1)
    return Chain(kinds[kept].tolist(), models)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", rows: int = TRAIN) -> Chain | None:
    """A chain fitted on at most `rows` labelled rows, chosen by a seeded hash of their ids; None without any.
    Labels that are null or of ids not in docs are not used."""
    labels = labels.select(labels[id_col].alias("_id"), labels[label_col].alias("_y")).where("_id is not null and _y is not null")
    total = labels.count()
    if not total:
        return None
    share = int(min(1.0, rows / total) * (1 << 40))
    mixed = F.xxhash64(F.lit(SEED), "_id").bitwiseAND(F.lit((1 << 40) - 1))
    chosen = labels.where(mixed < F.lit(share)).orderBy(mixed, "_id", "_y").limit(rows)
    text = F.coalesce(docs[text_col], F.lit(""))
    # at most `rows` rows of two numbers
    joined = docs.select(docs[id_col].alias("_doc"), text.alias("text")).join(F.broadcast(chosen), F.col("_doc") == F.col("_id"))
    joined = joined.select(F.col("_doc").cast("long").alias("id"), (F.col("_y") > 0).cast("int").alias("toxic"), "text")
    found = joined.mapInArrow(_features, "id long, toxic int, features array<int>").toArrow().sort_by([("id", "ascending"), ("toxic", "ascending")])
    if not found.num_rows:
        return None
    features = [v.values.to_numpy(zero_copy_only=False) for v in found["features"]]
    toxic = found["toxic"].to_numpy().astype(float)
    return fit_chain(features, np.concatenate([kinds_of(features, toxic), toxic[:, None]], 1))


def score(docs: DataFrame, chain: Chain | None, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(record, p_kind_1, p_kind_2, p_toxic, toxic): every row of docs as the struct record, scored over its
    whole text; toxic where the last probability reaches the threshold.

    A null or empty text gets what the models give for no words. Without a chain, probabilities are null and no
    row is toxic. The rows' columns keep their names inside record; no row moves.
    """
    record = F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("record")
    names = [f"p_{c}" for c in NAMES]
    if chain is None:
        return docs.select(record, *[F.lit(None).cast("double").alias(c) for c in names], F.lit(False).alias("toxic"))
    rows = docs.select(record, F.coalesce(docs[text_col], F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, tuple[int, ...]] = {}

        def places(word: bytes) -> tuple[int, ...]:
            p = known.get(word)
            if p is None:
                if len(known) >= REMEMBERED:
                    known.clear()
                p = known[word] = tuple(chain.place[h] for h in hashed(word) if h in chain.place)
            return p

        for b in batches:
            found = [np.fromiter({p for w in words_of(t.as_py()) for p in places(w)}, np.int64) for t in b.column(1)]
            p = chain.predict(found)
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, pa.float64()) for c in p.T], pa.array(p[:, -1] >= threshold, pa.bool_())], ["record", *names, "toxic"])

    kind = rows.schema["record"].dataType.simpleString()
    return rows.mapInArrow(run, f"record {kind}, " + ", ".join(f"{c} double" for c in names) + ", toxic boolean")
