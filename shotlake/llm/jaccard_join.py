"""N-gram Jaccard join: documents whose word shingles are alike, by adaptive multi-match prefixes.

Shingles are 64-bit hashes. The prefix principle needs one order of all shingles, rarest first. Shingles of one
document alone can match nothing, so only those of two or more are kept ("shared"): they decide how far a prefix
reaches, and the intersection of two documents is that of their shared shingles.

1. Tasks turn blocks of documents into shingle sets and scatter each block's distinct shingles over hash ranges, as
   packed rows. However common a shingle, a block sends it once, with the number of its holders there.
2. Each range counts its shingles and returns the shared ones, with their counts, to their blocks.
3. Each block orders its documents' shared shingles. Documents whose prefix holds none are done.
4. Equal sets become one class. Classes that have a prefix shingle in common meet under the least class among
   those that hold it. A group is cut into parts, each of which meets by itself and with a few pivots of the group;
   multi-match prefixes give candidates, which are verified exactly.
5. Where a group of several parts isn't connected yet, the parts of its largest connected set meet the rest, and the
   rest's parts each other: a group of near copies costs what it has members, not their square. Or, by estimated cost,
   its prefixes are lengthened, and two shared tokens are asked for.
6. All links go to connected components.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shotlake.llm.common import id_and_text, materialise, partitions_for
from shotlake.llm.components import components

WORDS, PERCENT = 5, 80
#: Text and documents of a block; stored bytes of input for each range of hashes.
BLOCK_BYTES, BLOCK_DOCS, RANGE_BYTES = 2 << 20, 65_535, 8 << 20
#: Ranges at most, and text of a block for each range, up to MOST_BLOCK_BYTES: rows stay a few tokens long at least.
MOST_RANGES, BLOCK_BYTES_A_RANGE, MOST_BLOCK_BYTES = 1 << 18, 256, 64 << 20
#: Longest multiple match that is tried; classes in one part of a group; estimated cost of a verification, in probes.
MOST_MATCHES, PART, VERIFY = 8, 64, 60
#: Classes that all parts of a group have in common.
PIVOTS = 8

_SEED = np.random.default_rng(20240229)
_BYTE = _SEED.integers(0, 2**64, 256, np.uint64)
_BYTE[65:91] = _BYTE[97:123]  # A-Z as a-z
_BASE = 0x9E3779B97F4A7C15
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOW48 = np.uint64((1 << 48) - 1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Shingles:
    """Sets of word shingles as hashes. PIECE bounds what is expanded to 8 bytes a byte at once."""

    PIECE = 4 << 20

    def __init__(self, words: int = WORDS):
        self.words = words
        self.powers = self.inverse = np.ones(1, np.uint64)

    def _reach(self, n: int) -> None:
        if len(self.powers) < n:
            n = max(n, 1 << 16)
            one = np.ones(n, np.uint64)
            one[1:] = np.uint64(_BASE)
            self.powers = np.multiply.accumulate(one)
            one[1:] = np.uint64(pow(_BASE, -1, 1 << 64))
            self.inverse = np.multiply.accumulate(one)

    def hashes(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(hash, start) of each word of the bytes."""
        space = _SPACE[data]
        edge = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).view(np.int8)))
        starts, ends = edge[::2], edge[1::2]
        self._reach(len(data) + 1)
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * self.powers[: len(data)], dtype=np.uint64)))
        return _mix((sums[ends] - sums[starts]) * self.inverse[starts] + (ends - starts).astype(np.uint64)), starts

    def words_of(self, text: bytes) -> np.ndarray:
        """Word hashes of one text, a piece at a time; pieces end at white space."""
        data = np.frombuffer(text, np.uint8)
        if len(data) <= self.PIECE:
            return self.hashes(data)[0]
        found, at = [], 0
        while at < len(data):
            end = min(at + self.PIECE, len(data))
            if end < len(data):
                gaps = np.flatnonzero(_SPACE[data[at:end]])
                while not len(gaps) and end < len(data):
                    end = min(end + self.PIECE, len(data))
                    gaps = np.flatnonzero(_SPACE[data[at:end]])
                end = at + int(gaps[-1]) + 1 if len(gaps) and end < len(data) else end
            found.append(self.hashes(data[at:end])[0])
            at = end
        return np.concatenate(found)

    def of_words(self, h: np.ndarray) -> np.ndarray:
        """Hashes of the shingles of a sequence of word hashes: sorted, distinct."""
        w = min(self.words, len(h))
        if not w:
            return np.empty(0, np.uint64)
        n = len(h) - w + 1
        s = np.full(n, w, np.uint64)
        for k in range(w):
            s = s * np.uint64(0xD6E8FEB86659FD93) + h[k : k + n]
        return np.unique(_mix(s))

    def block(self, texts: list[bytes]) -> list[np.ndarray]:
        """of_words of each text; short texts are hashed together."""
        out: list[np.ndarray] = []
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and size + len(texts[end]) < self.PIECE:
                size += len(texts[end]) + 1
                end += 1
            if end == at:
                out.append(self.of_words(self.words_of(texts[at])))
                at += 1
                continue
            h, starts = self.hashes(np.frombuffer(b"\n".join(texts[at:end]), np.uint8))
            first = np.searchsorted(starts, np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts[at:end]]))))
            out += [self.of_words(h[a:b]) for a, b in zip(first, first[1:])]
            at = end
        return out


#: Holders in a block above which a token is common there.
COMMON = 8
#: A block's row: ids, sizes and digests of its documents; of its common tokens the owners and how many (counts). A
#: range's row: tokens, each as often as it has owners; or common tokens, with their counts and their places (starts)
#: among the block's. On the way back counts are those over all blocks.
_SCATTERED = pa.schema([("part", pa.int32()), ("block", pa.int64()), *[(n, pa.binary()) for n in ("ids", "sizes", "digests", "owners", "tokens", "counts", "starts")]])


def _row(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([columns], schema=_SCATTERED)


def _scatter(ranges: int, words: int, block_bytes: int):
    """Blocks of documents to a row of each block, and for each range a row of its tokens there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(words)

        def block(ids: list, texts: list[bytes]) -> Iterator[pa.RecordBatch]:
            sets = shingles.block(texts)
            digests = b"".join(hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets)
            name = int.from_bytes(hashlib.blake2b(np.array([x if x is not None else -(1 << 63) for x in ids], np.int64).tobytes() + digests, digest_size=8).digest(), "little", signed=True)
            missing = np.array([x is None for x in ids])
            numbers = np.array([0 if x is None else x for x in ids], np.int64)
            sizes = np.array([len(s) for s in sets], np.int64)
            seen: set[bytes] = set()
            kept = []
            for i, s in enumerate(sets):  # copies within a block take part once
                d = digests[16 * i : 16 * i + 16]
                if len(s) and not missing[i] and d not in seen:
                    seen.add(d)
                    kept.append(i)
            tokens = np.concatenate([sets[i] for i in kept]) if kept else np.empty(0, np.uint64)
            order = np.argsort(tokens)
            tokens, owners = tokens[order], np.repeat(np.array(kept, np.uint16), sizes[kept])[order]
            first = np.flatnonzero(np.concatenate(([True], tokens[1:] != tokens[:-1]))[: len(tokens)])
            counts = np.diff(np.append(first, len(tokens)))
            often = np.repeat(counts > COMMON, counts)
            first, counts = first[counts > COMMON], counts[counts > COMMON].astype(np.uint16)
            yield _row(part=name % ranges, block=name, ids=numbers.tobytes(), sizes=np.where(missing, -1 - sizes, sizes).tobytes(), digests=digests, owners=owners[often].tobytes(), counts=counts.tobytes())

            def spread(t: np.ndarray) -> Iterator[tuple[int, slice, bytes]]:
                part = ((t >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int32)
                low, starts = (t & _LOW48).view(np.uint8).reshape(-1, 8)[:, :6], np.flatnonzero(np.diff(part, prepend=-1))
                for a, b in zip(starts, [*starts[1:], len(t)]):
                    yield int(part[a]), slice(a, b), low[a:b].tobytes()

            mine = owners[~often]
            for part, at, low in spread(tokens[~often]):
                yield _row(part=part, block=name, owners=mine[at].tobytes(), tokens=low)
            place = np.arange(len(first), dtype=np.uint32)
            for part, at, low in spread(tokens[first]):
                yield _row(part=part, block=name, counts=counts[at].tobytes(), starts=place[at].tobytes(), tokens=low)

        ids, texts, size = [], [], 0
        for batch in batches:
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                ids.append(key)
                texts.append(value.as_py())
                size += len(texts[-1])
                if size >= block_bytes or len(ids) >= BLOCK_DOCS:
                    yield from block(ids, texts)
                    ids, texts, size = [], [], 0
        if ids:
            yield from block(ids, texts)

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each range, the tokens that more than one document has, with 16-bit counts; block rows pass."""
    held: dict[int, list[dict]] = {}
    for batch in batches:
        plain = [i for i, x in enumerate(batch.column(2)) if x.is_valid]
        if plain:
            yield batch.take(pa.array(plain))
        for r in batch.to_pylist():
            if r["ids"] is None:
                held.setdefault(r["part"], []).append(r)
    for part in list(held):
        rows = held.pop(part)
        n = [len(r["tokens"]) // 6 for r in rows]
        wide = np.zeros((sum(n), 8), np.uint8)
        wide[:, :6] = np.frombuffer(b"".join(r["tokens"] for r in rows), np.uint8).reshape(-1, 6)
        tokens = wide.view(np.uint64).ravel()
        _, back = np.unique(tokens, return_inverse=True)
        holders = np.concatenate([np.ones(k) if r["counts"] is None else np.frombuffer(r["counts"], np.uint16) for r, k in zip(rows, n)])
        count = np.minimum(np.bincount(back, holders), 65535).astype(np.uint16)[back]
        # within 48 bits a range tells its tokens apart; the range above them keeps ranges apart
        tokens = tokens ^ (np.uint64(part & 0xFFFF) << np.uint64(48))
        at = 0
        for r, k in zip(rows, n):
            keep = np.flatnonzero(count[at : at + k] > 1)
            if len(keep):
                where = {"owners": np.frombuffer(r["owners"], np.uint16)[keep].tobytes()} if r["counts"] is None else {"starts": np.frombuffer(r["starts"], np.uint32)[keep].tobytes()}
                yield _row(part=part, block=r["block"], tokens=tokens[at + keep].tobytes(), counts=count[at + keep].tobytes(), **where)
            at += k


_DOCUMENT = "doc_id long, n_shingles long, digest binary, reach int, shared array<long>"


def _prefixes(percent: int):
    """Of each block, its documents: size, digest, how many of the shared tokens lie in the prefix that must
    have a match (0: none can link), and if any, all shared tokens, rarest first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain: dict[int, dict] = {}
        parts: dict[int, list] = {}
        for batch in batches:
            for r in batch.to_pylist():
                if r["ids"] is not None:
                    plain[r["block"]] = r
                else:
                    parts.setdefault(r["block"], []).append(r)
        for block in list(plain):
            mine = plain.pop(block)
            ids, sizes, digests = np.frombuffer(mine["ids"], np.int64), np.frombuffer(mine["sizes"], np.int64), mine["digests"]
            got = parts.pop(block, [])
            few, common = ([r for r in got if (r["owners"] is None) == c] for c in (False, True))
            of = lambda rows, c, kind: np.frombuffer(b"".join(r[c] for r in rows), kind)
            # common tokens once for each of their owners
            many = np.frombuffer(mine["counts"], np.uint16).astype(np.int64)
            at = of(common, "starts", np.uint32)
            begin, many = (np.cumsum(many) - many)[at], many[at]
            theirs = np.frombuffer(mine["owners"], np.uint16)[np.repeat(begin - (np.cumsum(many) - many), many) + np.arange(many.sum())]
            owners = np.concatenate([of(few, "owners", np.uint16), theirs])
            tokens, counts = (np.concatenate([of(few, c, kind), np.repeat(of(common, c, kind), many)]) for c, kind in (("tokens", np.uint64), ("counts", np.uint16)))
            order = np.lexsort((tokens, counts, owners))
            owners, tokens = owners[order], tokens[order].view(np.int64)
            first = np.searchsorted(owners, np.arange(len(ids) + 1))
            missing, n = sizes < 0, np.where(sizes < 0, -1 - sizes, sizes)
            reach, shared = np.zeros(len(ids), np.int32), []
            for i in range(len(ids)):
                a, b = first[i], first[i + 1]
                k = int(n[i]) - -(-percent * int(n[i]) // 100) + 1 - (int(n[i]) - (b - a))
                reach[i] = max(0, k) if b > a else 0
                shared.append(tokens[a:b] if reach[i] else None)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64(), mask=missing),
                    pa.array(n, pa.int64()),
                    pa.array([digests[16 * i : 16 * i + 16] for i in range(len(ids))], pa.binary()),
                    pa.array(reach, pa.int32()),
                    pa.array(shared, pa.list_(pa.int64())),
                ],
                ["doc_id", "n_shingles", "digest", "reach", "shared"],
            )

    return run


class Group:
    """Classes that meet: finds links between them until those that are connected are known to be. label: what they
    are known to be part of before."""

    def __init__(self, sizes: list[int], reach: list[int], shared: list[np.ndarray], percent: int = PERCENT, label: list[int] | None = None):
        self.n, self.k, self.percent = np.array(sizes), np.array(reach), percent
        self.label = np.arange(len(sizes)) if label is None else np.array(label)
        flat = np.concatenate(shared)
        self.owner = np.repeat(np.arange(len(shared)), [len(x) for x in shared])
        rank = np.concatenate([np.arange(len(x)) for x in shared])
        _, code = np.unique(flat, return_inverse=True)
        self.codes = np.split(code, np.cumsum([len(x) for x in shared])[:-1])
        order = np.argsort(code, kind="stable")
        self.owner, self.rank = self.owner[order], rank[order]
        self.start = np.searchsorted(code[order], np.arange(code.max() + 2))

    def _posted(self, codes: np.ndarray) -> np.ndarray:
        """Places in the index of the given tokens' lists, in a row."""
        a, n = self.start[codes], self.start[codes + 1] - self.start[codes]
        return np.repeat(a - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())

    def _matches(self, x: int) -> int:
        """The multiple match with the least estimated cost: probes of the longer prefix, and verifications, each
        of which must have used up so many of the probes."""
        most = max(1, min(MOST_MATCHES, -(-self.percent * int(self.n[x]) // 100)))
        lists = self.start[self.codes[x] + 1] - self.start[self.codes[x]]
        probes = np.cumsum(lists)[np.minimum(np.arange(self.k[x] - 1, self.k[x] + most - 1), len(lists) - 1)]
        return int(np.argmin(probes + VERIFY * probes / np.arange(1, most + 1))) + 1

    def links(self, left: np.ndarray, right: np.ndarray) -> Iterator[tuple[int, int]]:
        """Links between a left and a right class that join what was apart; flags say which classes are which."""
        for x in np.argsort(self.n, kind="stable"):
            if not left[x]:
                continue
            m = self._matches(x)
            at = self._posted(self.codes[x][: self.k[x] + m - 1])
            at = at[self.rank[at] < self.k[self.owner[at]] + m - 1]
            hits = np.bincount(self.owner[at], minlength=len(self.n))
            small, large = np.minimum(self.n, self.n[x]), np.maximum(self.n, self.n[x])
            tried = np.flatnonzero((hits >= m) & right & (self.label != self.label[x]) & (100 * small >= self.percent * large))
            if not len(tried):
                continue
            if len(tried) > 16:
                both = np.bincount(self.owner[self._posted(self.codes[x])], minlength=len(self.n))[tried]
            else:
                mine = np.sort(self.codes[x])
                both = np.array([len(np.intersect1d(mine, self.codes[y], assume_unique=True)) for y in tried])
            for y in tried[100 * both >= self.percent * (self.n[x] + self.n[tried] - both)]:
                if self.label[y] != self.label[x]:
                    self.label[self.label == self.label[y]] = self.label[x]
                    yield int(x), int(y)


def _verify(percent: int):
    """Rows sorted by group (hub, i, j) to links (a, b): classes of part i with those of part j, or among themselves.
    Where a group has several parts that haven't met (`large`), also each class with the one that it turned out to be
    connected to (a, b, hub): a pivot if that can be."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(rows: list[dict]) -> pa.RecordBatch:
            g = Group([r["n_shingles"] for r in rows], [r["reach"] for r in rows], [np.asarray(r["shared"], np.int64) for r in rows], percent, [r["known"] for r in rows])
            i, j = rows[0]["i"], rows[0]["j"]
            part = np.array([r["part"] for r in rows])
            found = [(rows[x]["class"], rows[y]["class"], None) for x, y in g.links(part == i, part == j)]
            if rows[0]["large"]:
                named: dict[int, tuple[bool, int]] = {}
                for label, r in zip(g.label.tolist(), rows):
                    named[label] = min(named.get(label, (True, r["class"])), (not r["pivot"], r["class"]))
                found += [(r["class"], named[label][1], r["hub"]) for label, r in zip(g.label.tolist(), rows)]
            return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in range(3)], ["a", "b", "hub"])

        held: list[dict] = []
        for batch in batches:
            for r in batch.to_pylist():
                if held and (held[0]["hub"], held[0]["i"], held[0]["j"]) != (r["hub"], r["i"], r["j"]):
                    yield links(held)
                    held = []
                held.append(r)
        if held:
            yield links(held)

    return run


def shingle_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, digest, reach, shared) of every row, written to the shared folder (steps 1 to 3)."""
    ranges = min(MOST_RANGES, partitions_for(docs, RANGE_BYTES))
    block_bytes = min(max(BLOCK_BYTES, ranges * BLOCK_BYTES_A_RANGE), MOST_BLOCK_BYTES)
    scattered = id_and_text(docs, id_col, text_col).mapInArrow(_scatter(ranges, words, block_bytes), _ddl(_SCATTERED))
    counted = scattered.repartitionById(ranges, "part").mapInArrow(_shared, _ddl(_SCATTERED))
    return materialise(counted.repartition(ranges, "block").mapInArrow(_prefixes(percent), _DOCUMENT), "shingles")


def _ddl(schema: pa.Schema) -> str:
    names = {"int32": "int", "int64": "long", "binary": "binary"}
    return ", ".join(f"{f.name} {names[str(f.type)]}" for f in schema)


def _classes(rows: DataFrame, *more: Column) -> DataFrame:
    """(digest, class, more) of all rows that can link: class is the least doc_id of the digest's rows, also of those
    that sent no tokens because their block holds a copy."""
    return rows.where("n_shingles > 0 and doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("class"), *more)


def class_links(rows: DataFrame, percent: int = PERCENT, part: int = PART) -> DataFrame:
    """Links (a, b) between classes, each named by its least doc_id: enough to connect all that are linked.

    A pair of classes that is similar shares a prefix token, and so meets in the group of that token's least class,
    the hub. A group of more than `part` classes is cut into parts. First, each part meets by itself, together with a
    few pivots that all parts of the group have: copies of one text, in whatever parts, connect through a pivot among
    them. Where a group isn't connected by that, the links of all groups are put together, and it is dealt once more.
    A group that still isn't connected costs its rest (all but its largest connected set) times the whole group,
    if its parts meet each other. Or its prefixes are lengthened by a token: a similar pair has two of these in common,
    of which one isn't the group's commonest, and so meets among the holders of another one. That is done where the
    estimated cost, the squares of these holders, is less.
    """
    classes = _classes(rows, F.any_value("n_shingles").alias("n_shingles"), F.max("reach").alias("reach"), F.max_by("shared", "reach").alias("shared"))
    classes = materialise(classes.where("reach > 0").drop("digest"), "classes")
    n = partitions_for(rows, RANGE_BYTES)

    def met(pieces: DataFrame) -> DataFrame:
        """pieces: hub, class, part, i, j, known, pivot, large."""
        full = pieces.join(classes, "class").repartition(n, "hub", "i", "j").sortWithinPartitions("hub", "i", "j")
        return materialise(full.mapInArrow(_verify(percent), "a long, b long, hub long"), "links")

    def slot(count: str, deal: int = 0) -> Column:
        return F.pmod(F.xxhash64(F.lit(deal), "class"), count).cast("int")

    def sets(held: DataFrame) -> DataFrame:
        """Of groups (hub, class, known) that aren't connected: the largest set (main), its size n and the group's (all)."""
        sizes = held.groupBy("hub", "known").agg(F.count("*").alias("n")).groupBy("hub").agg(F.max_by("known", F.struct("n", "known")).alias("main"), F.max("n").alias("n"), F.sum("n").alias("all"))
        return materialise(sizes.where(F.col("n") < F.col("all")), "apart")

    def by_parts(members: DataFrame, deal: int = 0) -> tuple[DataFrame, DataFrame]:
        """Of groups (hub, class, known), dealt into parts in one of many ways: links, and the classes of those with
        several parts, with what they were found to be connected to."""
        drawn = [F.min(F.struct(F.xxhash64(F.lit(deal * PIVOTS + k), "class").alias("h"), "class"))["class"] for k in range(PIVOTS - 1)]
        groups = members.groupBy("hub").agg(F.ceil(F.count("*") / part).cast("int").alias("parts"), F.array_distinct(F.array(F.min("class"), *drawn)).alias("pivots"))
        own = members.join(materialise(groups, "groups"), "hub").withColumn("large", F.col("parts") > 1).withColumn("pivot", F.col("large") & F.array_contains("pivots", F.col("class")))
        everywhere = F.when(F.col("pivot"), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array(slot("parts", deal)))
        own = own.select("hub", "class", "known", F.explode(everywhere).alias("part"), "pivot", "large")
        found = met(own.select("*", F.col("part").alias("i"), F.col("part").alias("j")))
        held = found.where("hub is not null").groupBy("hub", F.col("a").alias("class")).agg(F.min("b").alias("known"))
        return found.select("a", "b"), held

    def elsewhere(found: DataFrame, held: DataFrame, apart: DataFrame) -> DataFrame:
        """The classes of groups that aren't connected, with the component that all links so far, those of other groups
        too, make them part of."""
        mine = held.join(apart.select("hub"), "hub", "left_semi").select("hub", "class")
        both = mine.join(components(found), F.col("class") == F.col("node"), "left")
        return materialise(both.select("hub", "class", F.coalesce("component", "class").alias("known")), "held")

    def parts_with_parts(held: DataFrame, apart: DataFrame) -> DataFrame:
        """Links between the main set's parts and the rest's, and among the rest's."""
        sizes = apart.select("hub", "main", F.ceil(F.col("n") / part).cast("int").alias("of_main"), F.ceil((F.col("all") - F.col("n")) / part).cast("int").alias("of_rest"))
        both = held.join(sizes, "hub").withColumns({"pivot": F.lit(False), "large": F.lit(False)})
        rest = F.sequence(F.col("of_main"), F.col("of_main") + F.col("of_rest") - 1)
        others = F.sequence(F.lit(0), F.col("of_main") + F.col("of_rest") - 1)
        columns = ["hub", "class", "known", "pivot", "large", "part"]
        first = both.where("known = main").withColumn("part", slot("of_main")).select(*columns, F.col("part").alias("i"), F.explode(rest).alias("j"))
        last = both.where("known <> main").withColumn("part", F.col("of_main") + slot("of_rest")).select(*columns, F.explode(others).alias("other"))
        last = last.select(*columns, F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"))
        return met(first.unionByName(last)).select("a", "b")

    posts = classes.select("class", F.explode(F.slice("shared", F.lit(1), F.col("reach"))).alias("token"))
    hubs = posts.groupBy("token").agg(F.min("class").alias("hub"), F.count("*").alias("holders")).where("holders > 1").drop("holders")
    members = materialise(posts.join(hubs, "token").select("hub", "class").distinct(), "members")
    found, held = by_parts(members.withColumn("known", F.col("class")))
    apart = sets(held)
    for again in (True, False):
        if apart.isEmpty():
            return found
        held = elsewhere(found, held, apart)
        apart = sets(held)
        if again and not apart.isEmpty():
            # dealt anew, most of what is connected through several others comes to meet
            found = found.unionByName(by_parts(held.join(apart.select("hub"), "hub", "left_semi"), 1)[0])
    if apart.isEmpty():
        return found

    longer = held.join(apart, "hub").join(classes.select("class", F.slice("shared", F.lit(1), F.col("reach") + 1).alias("tokens")), "class")
    longer = materialise(longer.select("hub", "class", "known", F.explode("tokens").alias("token")), "longer")
    holders = longer.groupBy("hub", "token").agg(F.count("*").alias("c"))
    costs = holders.groupBy("hub").agg(F.max_by("token", F.struct("c", "token")).alias("usual"), (F.sum(F.col("c") * F.col("c")) - F.max(F.col("c") * F.col("c"))).alias("cost"))
    chosen = apart.join(costs, "hub").withColumn("lengthen", F.col("cost") < (F.col("all") - F.col("n")) * F.col("all"))
    chosen = materialise(chosen, "chosen")
    plain, lengthened = chosen.where("not lengthen"), chosen.where("lengthen")
    if not plain.isEmpty():
        found = found.unionByName(parts_with_parts(held, plain))
    if not lengthened.isEmpty():
        again = longer.join(lengthened.select("hub", "usual"), "hub").where("token <> usual").join(holders.where("c > 1"), ["hub", "token"])
        again = materialise(again.select(F.xxhash64("hub", "token").alias("hub"), "class", "known").distinct(), "members")
        more, held = by_parts(again)
        found, apart = found.unionByName(more), sets(held)
        if not apart.isEmpty():
            found = found.unionByName(parts_with_parts(held, apart))
    return found


def join_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row.

    Words are runs of characters other than ASCII white space, A-Z lowered. Two documents link when their sets of
    `words`-word shingles have a Jaccard similarity of percent / 100 or more, compared as whole numbers; a text of
    fewer words is one shingle. component_id is the least doc_id reachable by links, the row's own for one
    without. Null, empty and blank texts have no shingles and link with nothing. A row with a null id links with
    nothing and has a null component; rows of one id are one node; an empty table gives none; other columns are
    dropped.
    """
    rows = shingle_classes(docs, id_col, text_col, words, percent)
    found = components(materialise(class_links(rows, percent), "links"))
    classes = _classes(rows)
    named = classes.join(found, classes["class"] == found["node"], "left").select(F.col("digest").alias("of"), F.coalesce("component", "class").alias("component"))
    named = materialise(named, "named")  # so that a text with many copies is only a hot join key, which is split
    joined = rows.select("doc_id", "n_shingles", "digest").join(named, (F.col("digest") == F.col("of")) & (F.col("n_shingles") > 0), "left")
    return joined.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))
