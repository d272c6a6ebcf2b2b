"""Packing of token ids into sequences of bounded length, balanced by estimated cost."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shotlake.llm.tokens import VOCABULARY

#: Tokens of a sequence.
CAPACITY = 2048
#: Cost of a piece of n tokens: LINEAR * n + QUADRATIC * n * n.
LINEAR, QUADRATIC = 1.0, 1.0 / 4096
#: Documents that a task packs together; what they hold of ids is bounded by WINDOW * CAPACITY.
WINDOW = 8192
#: Id that ends a document.
END_ID = 1

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_cost double"


def assign(lengths: list[int], capacity: int = CAPACITY, linear: float = LINEAR, quadratic: float = QUADRATIC) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of documents of the given lengths.

    A document's whole multiples of the capacity fill sequences of their own. What is left is taken in
    descending length (ties: given order) to the lowest-cost sequence that has room for it whole; where none
    has, the lowest-cost sequence with any capacity left takes what fits and the rest goes on. There are as many
    sequences as the tokens need, so that only the last can be short.
    """
    pieces, rests, used = [], [], 0
    for d, n in enumerate(lengths):
        for start in range(0, n - n % capacity, capacity):
            pieces.append((d, start, capacity, used, 0))
            used += 1
        if n % capacity:
            rests.append((n % capacity, d))
    m = -(-sum(r for r, _ in rests) // capacity)
    room, cost = np.full(m, capacity, np.int64), np.zeros(m)
    if m:
        room[-1] = sum(r for r, _ in rests) - capacity * (m - 1)
    rests.sort(key=lambda x: -x[0])
    for n, d in rests:
        start = lengths[d] - n
        while n:
            whole = room >= n
            at = int(np.argmin(np.where(whole if whole.any() else room > 0, cost, np.inf)))
            take = min(n, int(room[at]))
            pieces.append((d, start, take, used + at, -int(room[at])))
            room[at] -= take
            cost[at] += linear * take + quadratic * take * take
            start, n = start + take, n - take
    top: dict[int, int] = {}
    for _, _, _, s, o in pieces:
        top[s] = min(top.get(s, 0), o)
    return [(d, a, n, s, o - top[s]) for d, a, n, s, o in pieces]


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY, capacity: int = CAPACITY, linear: float = LINEAR, quadratic: float = QUADRATIC, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, sequence_cost.

    A document is its ids (no special tokens added) and end_id, so a null or empty text is one token. Each task
    packs its own rows in windows of `window` documents, without a shuffle; all sequences but the last of a
    window are full. sequence_id holds the partition and the sequence's number there. A null id stays null,
    repeated rows are packed as often as they occur, an empty table gives none, and other columns are dropped.
    """
    from shotlake.llm.common import id_and_text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        from pyspark import TaskContext

        from shotlake.llm.tokens import Words, little_endian

        words, end, first = Words(vocabulary), little_endian([end_id]), TaskContext.get().partitionId() << 32
        held: list[tuple[int, bytes]] = []

        def packed() -> pa.RecordBatch:
            nonlocal first
            found = assign([len(ids) // 4 for _, ids in held], capacity, linear, quadratic)
            cost: dict[int, float] = {}
            for _, _, n, s, _ in found:
                cost[s] = cost.get(s, 0.0) + linear * n + quadratic * n * n
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array([held[d][0] for d, *_ in found], pa.int64()),
                    pa.array([a for _, a, *_ in found], pa.int64()),
                    pa.array([n for _, _, n, *_ in found], pa.int64()),
                    pa.array([zlib.crc32(memoryview(held[d][1])[4 * a : 4 * (a + n)]) for d, a, n, *_ in found], pa.int64()),
                    pa.array([len(held[d][1]) // 4 for d, *_ in found], pa.int64()),
                    pa.array([first + x[3] for x in found], pa.int64()),
                    pa.array([x[4] for x in found], pa.int64()),
                    pa.array([cost[x[3]] for x in found], pa.float64()),
                ],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_cost"],
            )
            first += len(cost)
            held.clear()
            return out

        size = 0
        for batch in batches:
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                held.append((key, words.ids(value.as_py()) + end))
                size += len(held[-1][1])
                if len(held) >= window or size >= 4 * window * capacity:
                    yield packed()
                    size = 0
        if held:
            yield packed()

    return id_and_text(docs, id_col, text_col).mapInArrow(run, SCHEMA)
