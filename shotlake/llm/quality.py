"""Quality by a weak-label model: labellers that vote, their accuracies by EM, a hashed linear scorer."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shotlake.llm.common import SEED, id_and_text, materialise
from shotlake.llm.linear import Sparse, fit

#: Rows that the scorer is fitted on at most, its hashed columns, the score that keeps a document.
TRAIN, BITS, KEEP = 6_000, 16, 0.5
ROUNDS = 60
REMEMBERED = 500_000
_MARKS = re.compile(rb"[#$%&*|{}<>~^=\\!@_]")
_UPPER = re.compile(rb"[A-Z]|\xc3[\x80-\x9e]")
_LOWER = re.compile(rb"[a-z]|\xc3[\x9f-\xbf]")

#: Labellers by what they look at: (name, bad below, good from, good to, bad above).
LABELLERS = [
    ("length", 5, 30, math.inf, math.inf),
    ("upper", -1, -1, 0.2, 0.5),
    ("marks", -1, -1, 0.01, 0.04),
    ("distinct", 0.12, 0.25, math.inf, math.inf),
    ("top_word", -1, -1, 0.15, 0.25),
    ("word_length", 2, 3, 9, 14),
    ("lines", -1, -1, 0.2, 0.5),
    ("stops", 0.005, 0.02, 0.25, 0.6),
]


def measures(data: bytes) -> tuple[list[float], list[bytes]]:
    """What LABELLERS look at, in their order, and the words; nan where a text is too short to tell."""
    words = data.split()
    n = len(words)
    if not n:
        return [0.0] + [math.nan] * (len(LABELLERS) - 1), words
    upper, lower = len(_UPPER.findall(data)), len(_LOWER.findall(data))
    count = Counter(words)
    lines = [x for x in data.split(b"\n") if x.strip()]
    ends = data.count(b". ") + data.count(b".\n") + data.endswith(b".") + data.count(b"? ") + data.count(b"! ")
    return [
        n,
        upper / (upper + lower) if upper + lower else math.nan,
        len(_MARKS.findall(data)) / len(data),
        len(count) / math.sqrt(n) / 6 if n >= 30 else math.nan,
        count.most_common(1)[0][1] / n if n >= 30 else math.nan,
        sum(map(len, words)) / n,
        1 - len(set(lines)) / len(lines) if len(lines) >= 4 else math.nan,
        ends / n if n >= 40 else math.nan,
    ], words


def votes(values: list[float]) -> str:
    """A letter for each labeller: g(ood), b(ad) or a(bstains)."""
    out = []
    for v, (_, low, a, b, high) in zip(values, LABELLERS):
        out.append("a" if math.isnan(v) else "b" if v < low or v > high else "g" if a <= v <= b else "a")
    return "".join(out)


def accuracies(patterns: list[str], counts: np.ndarray, rounds: int = ROUNDS) -> tuple[float, np.ndarray, np.ndarray]:
    """(share of good, P(vote | class) as labeller x class x vote, posterior of good by pattern), by EM.

    Labellers are taken as independent given the class, and an abstention as no evidence. EM starts from the belief
    that one bad vote makes a text bad, which also says which class is the good one.
    """
    code = np.array([["gba".index(c) for c in p] for p in patterns])
    post = np.where((code == 1).any(1), 0.1, np.where((code == 0).any(1), 0.9, 0.5))
    for _ in range(rounds):
        share = (counts @ post + 1) / (counts.sum() + 2)
        table = np.ones((code.shape[1], 2, 3))
        for j in range(code.shape[1]):
            for c, p in enumerate((post, 1 - post)):
                hit = np.bincount(code[:, j], counts * p, 3)[:2] + 1
                table[j, c, :2] = hit / hit.sum()
        logs = [np.log(s) + sum(np.log(table[j, c][code[:, j]]) for j in range(code.shape[1])) for c, s in enumerate((share, 1 - share))]
        post = 1 / (1 + np.exp(np.clip(logs[1] - logs[0], -60, 60)))
    return float(share), table, post


def _shape(word: bytes) -> bytes:
    """A word's runs of character kinds: A, a, 0, marks as they are."""
    kinds = re.sub(rb"[A-Z]|\xc3[\x80-\x9e]", b"A", word)
    kinds = re.sub(rb"[a-z]|\xc3[\x9f-\xbf]|[\x80-\xff]+", b"a", kinds)
    return re.sub(rb"(.)\1+", rb"\1", re.sub(rb"[0-9]", b"0", kinds))[:8]


class Features:
    """Hashed columns: shares of word shapes, and steps of the measures."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def _column(self, name: bytes) -> int:
        return zlib.crc32(name) & ((1 << BITS) - 1)

    def of(self, values: list[float], words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        known, places = self.known, []
        if len(known) > REMEMBERED:
            known.clear()
        for w in words:
            p = known.get(w)
            if p is None:
                p = known[w] = self._column(b"shape " + _shape(w))
            places.append(p)
        columns, counts = np.unique(np.array(places, np.int64), return_counts=True)
        steps = [self._column(b"%s %d" % (name.encode(), -1 if math.isnan(v) else min(40, int(v * 20 if name not in ("length", "word_length") else math.log2(v + 1) * 2)))) for (name, *_), v in zip(LABELLERS, values)]
        return np.concatenate([columns, np.array(steps, np.int64)]), np.concatenate([counts / max(1, len(words)), np.ones(len(steps))])


_MEASURED = "doc_id long, order long, votes string, columns array<long>, shares array<double>"


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    features = Features()
    for b in batches:
        found = [measures(t.as_py()) for t in b.column(1).cast(pa.binary())]
        pairs = [features.of(*f) for f in found]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array([votes(f[0]) for f in found], pa.string()), pa.array([p[0] for p in pairs], pa.list_(pa.int64())), pa.array([p[1] for p in pairs], pa.list_(pa.float64()))], ["doc_id", "order", "votes", "columns", "shares"])


def weak_labels(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, dict[str, float]]:
    """(doc_id, order, votes, columns, shares) of every row, written once, and the posterior of good of each pattern of
    votes. Texts are read here only: what the scorer needs of them is a few hashed columns. Patterns are counted over
    all rows; there are at most 3 ** len(LABELLERS) of them."""
    mixed = F.xxhash64(F.lit(SEED), "doc_id", F.octet_length("text")).bitwiseAND(F.lit((1 << 40) - 1))
    rows = id_and_text(docs, id_col, text_col).select("doc_id", "text", mixed.alias("order"))
    measured = materialise(rows.mapInArrow(_measured, _MEASURED), "votes")
    counts = {r["votes"]: r["count"] for r in measured.groupBy("votes").count().collect()}
    patterns = sorted(counts)
    if not patterns:
        return measured, {}
    return measured, dict(zip(patterns, accuracies(patterns, np.array([counts[p] for p in patterns], float))[2].tolist()))


def train(measured: DataFrame, posterior: dict[str, float], rows: int = TRAIN) -> np.ndarray | None:
    """The scorer's weights, fitted to the posteriors of at most `rows` rows of measured, chosen and ordered by a hash of
    id and length, so that no partitioning changes them."""
    total = measured.count()
    if not total:
        return None
    share = int(min(1.0, rows / total) * (1 << 40))
    found = measured.where(F.col("order") < F.lit(share)).orderBy("order", "doc_id", "votes", "columns", "shares").limit(rows).toArrow()
    if not found.num_rows:
        return None
    x = Sparse([np.asarray(v.values) for v in found["columns"]], [np.asarray(v.values) for v in found["shares"]], 1 << BITS)
    y = np.array([posterior.get(v, 0.5) for v in found["votes"].to_pylist()])
    return fit(x, np.zeros((len(y), 0)), y, rounds=150, rate=0.2)


def classify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: float = KEEP, rows: int = TRAIN) -> DataFrame:
    """(doc_id, votes, posterior, score, keep) of every row, from its whole text.

    posterior is the weak-label model's probability of good given the votes, score the linear scorer's; a
    document is kept while its score reaches `keep`. A null or empty text is a text without words. Null ids stay
    null; repeated rows repeat; an empty table gives none; other columns are dropped.
    """
    measured, posterior = weak_labels(docs, id_col, text_col)
    weights = train(measured, posterior, rows)
    schema = "doc_id long, votes string, posterior double, score double, keep boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            columns, shares = b.column("columns"), b.column("shares")
            row = np.repeat(np.arange(b.num_rows), np.diff(columns.offsets.to_numpy()))
            z = np.zeros(b.num_rows)
            if weights is not None:
                z = np.bincount(row, weights[columns.flatten().to_numpy()] * shares.flatten().to_numpy(), b.num_rows) + weights[-1]
            score = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
            cast = b.column("votes").to_pylist()
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("votes"), pa.array([posterior.get(v, 0.5) for v in cast], pa.float64()), pa.array(score), pa.array(score >= keep)], ["doc_id", "votes", "posterior", "score", "keep"])

    return measured.mapInArrow(run, schema)
