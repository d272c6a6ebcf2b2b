"""Near-duplicate vectors by product quantisation: inverted lists, residual codes, exact rerank."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shotlake.llm.common import SEED, materialise, partitions_for
from shotlake.llm.components import components

#: Cosine of a link; lists that a vector searches.
COSINE, PROBES = 0.95, 6
#: Vectors that an index is fitted on at most; lists at most; members of a list, and queries to it, that meet in a task.
TRAIN, MOST_LISTS, PART, ASKING = 32_768, 4096, 4096, 16_384
#: Stored bytes for each partition of a search.
SEARCH_BYTES = 4 << 20
#: Subspaces and codewords of each.
SUBSPACES, WORDS = 8, 256


def kmeans(x: np.ndarray, k: int, rounds: int = 8, seed: int = SEED) -> np.ndarray:
    """k centroids (fewer rows: fewer), by Lloyd's rounds from a seeded choice of rows."""
    c = x[np.random.default_rng(seed).permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        at = nearest(x, c, 1)[:, 0]
        n = np.bincount(at, minlength=len(c))
        sums = np.stack([np.bincount(at, x[:, j], len(c)) for j in range(x.shape[1])], 1)
        c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], c)
    return c


def nearest(x: np.ndarray, c: np.ndarray, k: int) -> np.ndarray:
    """The k nearest centroids of each row, nearest first; a block of rows at a time."""
    k, out = min(k, len(c)), []
    norms = (c * c).sum(1)
    for a in range(0, len(x), 4096):
        d = norms - 2 * x[a : a + 4096] @ c.T
        if k == 1:
            out.append(d.argmin(1)[:, None])
        else:
            some = np.argpartition(d, k - 1, axis=1)[:, :k]
            out.append(np.take_along_axis(some, np.argsort(np.take_along_axis(d, some, 1), axis=1, kind="stable"), 1))
    return np.concatenate(out) if out else np.empty((0, k), np.int64)


def merged(c: np.ndarray, n: np.ndarray, reach: float) -> np.ndarray:
    """Centroids c of n members each: the most populous one left takes in those within reach of it, as their mean."""
    left, out = np.ones(len(c), bool), []
    for k in np.argsort(-n, kind="stable"):
        if left[k]:
            near = left & (((c - c[k]) ** 2).sum(1) <= reach * reach)
            near[k] = True
            left &= ~near
            out.append(np.average(c[near], axis=0, weights=np.maximum(n[near], 1e-9)))
    return np.stack(out)


def searched(x: np.ndarray, c: np.ndarray, probes: int, reach: float) -> list[list[int]]:
    """Of each row, the lists that it searches, its own first: the `probes` nearest, and all others with a centroid
    within 2 * reach unless the plane between the cells of both is further than reach. No vector within reach of
    the row is missed that lies within reach of its own centroid."""
    first, out = nearest(x, c, probes), []
    norms = (c * c).sum(1)
    apart = np.sqrt(np.maximum(norms[:, None] + norms - 2 * c @ c.T, 0))
    for a in range(0, len(x), 4096):
        y, f = x[a : a + 4096], first[a : a + 4096]
        d = np.maximum((y * y).sum(1)[:, None] + norms - 2 * y @ c.T, 0)
        own = np.take_along_axis(d, f[:, :1], 1)
        more = (d <= (2 * reach) ** 2 + 1e-9) & (d - own <= 2 * reach * apart[f[:, 0]] + 1e-9)
        np.put_along_axis(more, f, False, 1)
        out += [[*p, *np.flatnonzero(m).tolist()] for p, m in zip(f.tolist(), more)]
    return out


class Index:
    """Coarse centroids, and codewords of the residuals' subspaces, fitted on unit vectors. Centroids within `reach`
    of a more populous one are merged into it, so that a hot region is one list however many seeds fell into it."""

    def __init__(self, sample: np.ndarray, lists: int, subspaces: int = SUBSPACES, words: int = WORDS, reach: float = 0.0):
        self.dim = sample.shape[1]
        self.width = -(-self.dim // subspaces)
        self.subspaces = subspaces
        self.coarse = kmeans(sample, lists)
        if reach:
            self.coarse = merged(self.coarse, np.bincount(nearest(sample, self.coarse, 1)[:, 0], minlength=len(self.coarse)), reach)
        rest = self._split(sample - self.coarse[nearest(sample, self.coarse, 1)[:, 0]])
        self.words = [kmeans(rest[:, m], words) for m in range(subspaces)]

    def _split(self, x: np.ndarray) -> np.ndarray:
        wide = np.zeros((len(x), self.subspaces * self.width))
        wide[:, : self.dim] = x
        return wide.reshape(len(x), self.subspaces, self.width)

    def encode(self, x: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(codes, error): the codewords of each row's residual in its list, and the length of what they miss."""
        rest = self._split(x - self.coarse[at])
        codes = np.stack([nearest(rest[:, m], self.words[m], 1)[:, 0] for m in range(self.subspaces)], 1).astype(np.uint8)
        miss = sum(((rest[:, m] - self.words[m][codes[:, m]]) ** 2).sum(1) for m in range(self.subspaces))
        return codes, np.sqrt(miss)

    def distances(self, queries: np.ndarray, at: int, codes: np.ndarray) -> np.ndarray:
        """Asymmetric squared distances of queries to a list's coded members, by table lookups."""
        rest = self._split(queries - self.coarse[at])
        total = np.zeros((len(queries), len(codes)))
        for m in range(self.subspaces):
            w = self.words[m]
            table = (rest[:, m] ** 2).sum(1)[:, None] + (w * w).sum(1) - 2 * rest[:, m] @ w.T
            total += table[:, codes[:, m]]
        return total


def _read(column: pa.Array) -> list[np.ndarray | None]:
    """Finite vectors other than zero, in double precision; None for all others."""
    out: list[np.ndarray | None] = []
    for v in column:
        x = None if v.as_py() is None or v.values.null_count else np.asarray(v.values.to_numpy(zero_copy_only=False), np.float64)
        if x is not None:
            top = np.abs(x).max(initial=0.0)
            x = x / top if np.isfinite(top) and top > 0 else None
        out.append(None if x is None else x / np.sqrt((x * x).sum()))
    return out


def _unit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        units = _read(b.column(1))
        yield pa.RecordBatch.from_arrays(
            [
                b.column(0),
                pa.array([None if u is None else hashlib.blake2b(u.tobytes(), digest_size=16).digest() for u in units], pa.binary()),
                pa.array([0 if u is None else len(u) for u in units], pa.int32()),
                pa.array([None if u is None else u.tobytes() for u in units], pa.binary()),
            ],
            ["vec_id", "digest", "dim", "unit"],
        )


def _indexed(indexes: dict[int, Index], probes: int, reach: float):
    """Rows sorted by length: a list's number holds its length in the upper half."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            dims = whole.column(3).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(dims)) + 1).tolist(), whole.num_rows]
            for s, e in zip(cuts, cuts[1:]):
                if s == e:
                    continue
                b, index, base = whole.slice(s, e - s), indexes[int(dims[s])], int(dims[s]) << 32
                x = np.frombuffer(b"".join(b.column(2).to_pylist())).reshape(b.num_rows, -1)
                lists = searched(x, index.coarse, probes, reach)
                home = np.array([p[0] for p in lists])
                codes, miss = index.encode(x, home)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), b.column(2), pa.array(home + base, pa.int64()), pa.array([[k + base for k in p] for p in lists], pa.list_(pa.int64())), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(miss, pa.float64())],
                    ["class", "copies", "unit", "list", "probes", "codes", "miss"],
                )

    return run


def _search(indexes: dict[int, Index], cosine: float):
    """Rows sorted by (list, part, asking, query) to (a, b, n): a's n links found (b null), or a link that joins what
    was apart among these rows (n 0)."""
    reach = np.sqrt(2 - 2 * cosine)

    class Part:
        """Members of one part of a list; queries meet them as they come, so that memory doesn't grow with their number."""

        def __init__(self, batches: list[pa.RecordBatch]):
            t = pa.Table.from_batches(batches)
            self.list, self.ids, self.copies = t["list"][0].as_py(), t["class"].to_numpy(), t["copies"].to_numpy()
            self.index, self.at = indexes[self.list >> 32], self.list & 0xFFFFFFFF
            self.x = np.frombuffer(b"".join(t["unit"].to_pylist())).reshape(len(self.ids), -1)
            self.codes = np.frombuffer(b"".join(t["codes"].to_pylist()), np.uint8).reshape(len(self.ids), -1)
            self.limit = (reach + t["miss"].to_numpy() + 1e-9) ** 2
            self.probes = [set(p) for p in t["probes"].to_pylist()]
            self.place = {c: i for i, c in enumerate(self.ids.tolist())}
            self.label = np.arange(len(self.ids))
            self.back: dict[int, np.ndarray] = {}

        def finds(self, home: int) -> np.ndarray:
            """Which members search the list `home`."""
            if home not in self.back:
                self.back[home] = np.array([home in p for p in self.probes])
            return self.back[home]

        def linked(self, x: np.ndarray) -> np.ndarray:
            near = self.index.distances(x, self.at, self.codes) <= self.limit
            rows, columns = np.flatnonzero(near.any(1)), np.flatnonzero(near.any(0))
            if len(rows):
                exact = x[rows] @ self.x[columns].T
                # the order of sums decides nothing
                for i, j in np.argwhere(np.abs(exact - cosine) < 1e-12):
                    exact[i, j] = np.einsum("j,j->", self.x[columns[j]], x[rows[i]])
                near[np.ix_(rows, columns)] &= exact >= cosine
            return near

        def meet(self, queries: pa.RecordBatch) -> pa.RecordBatch:
            ids, copies, homes = queries["class"].to_numpy(), queries["copies"].to_numpy(), queries["home"].to_numpy()
            near = self.linked(np.frombuffer(b"".join(queries["unit"].to_pylist())).reshape(len(ids), -1))
            a, b, n = [], [], []
            for k in np.flatnonzero(near.any(1)):
                q, y = int(ids[k]), np.flatnonzero(near[k])
                y = y[self.ids[y] != q]
                if not len(y):
                    continue
                a.append(q)
                b.append(None)
                n.append(int(self.copies[y].sum()))
                for z in y[~self.finds(int(homes[k]))[y]]:  # the member will not find this one
                    a.append(int(self.ids[z]))
                    b.append(None)
                    n.append(int(copies[k]))
                me = self.label[self.place[q]] if q in self.place else -1
                labels, at = np.unique(self.label[y], return_index=True)
                for z in y[at[labels != me]]:
                    a.append(q)
                    b.append(int(self.ids[z]))
                    n.append(0)
                if len(labels) > 1 or me >= 0 and labels[0] != me:
                    self.label[np.isin(self.label, labels)] = me if me >= 0 else labels[0]
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(n, pa.int64())], ["a", "b", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        key = part = None
        for batch in batches:
            lists, parts, asking = (batch.column(c).to_numpy() for c in ("list", "part", "asking"))
            query = batch.column("query").to_numpy(zero_copy_only=False).astype(np.int8)
            cuts = [0, *(np.flatnonzero(np.diff(lists) | np.diff(parts) | np.diff(asking) | np.diff(query)) + 1).tolist(), batch.num_rows]
            for s, e in zip(cuts, cuts[1:]):
                if s == e:
                    continue
                if key != (lists[s], parts[s], asking[s]):
                    key, held, part = (lists[s], parts[s], asking[s]), [], None
                if not query[s]:
                    held.append(batch.slice(s, e - s))
                    continue
                if part is None and held:
                    part, held = Part(held), []
                if part is not None:
                    for k in range(s, e, 256):
                        yield part.meet(batch.slice(k, min(256, e - k)))

    return run


_INDEXED = "class long, copies long, unit binary, list long, probes array<long>, codes binary, miss double"


def _met(indexed: DataFrame, indexes: dict[int, Index], cosine: float, part: int, asking: int) -> DataFrame:
    """(a, b, n) as _search gives them, of all rows of indexed. A list's members are cut into parts and the queries to
    it likewise; each pair of parts meets in a task, so that none holds more than `part` members, and a hot list is
    many tasks."""
    parts = indexed.groupBy("list").agg(F.ceil(F.count("*") / part).cast("int").alias("parts"))
    asked = indexed.select(F.explode("probes").alias("list")).groupBy("list").agg(F.ceil(F.count("*") / asking).cast("int").alias("askings"))
    # as many rows as there are lists
    plan = F.broadcast(parts.join(asked, "list"))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda n: F.pmod(F.xxhash64("class"), n).cast("int")
    members = indexed.join(plan, "list").select("list", own("parts").alias("part"), each("askings").alias("asking"), F.lit(False).alias("query"), "class", "copies", "unit", F.col("list").alias("home"), "probes", "codes", "miss")
    queries = indexed.withColumnRenamed("list", "home").withColumn("list", F.explode("probes")).join(plan, "list")
    queries = queries.select("list", each("parts").alias("part"), own("askings").alias("asking"), F.lit(True).alias("query"), "class", "copies", "unit", "home", F.lit(None).cast("array<long>").alias("probes"), F.lit(None).cast("binary").alias("codes"), F.lit(None).cast("double").alias("miss"))
    met = members.unionByName(queries).repartition(partitions_for(indexed, SEARCH_BYTES), "list", "part", "asking").sortWithinPartitions("list", "part", "asking", "query")
    return materialise(met.mapInArrow(_search(indexes, cosine), "a long, b long, n long"), "links")


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = COSINE, probes: int = PROBES, train: int = TRAIN, part: int = PART, asking: int = ASKING) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row.

    Vectors whose cosine in double precision is `cosine` or more are linked; those of different lengths never are.
    Equal unit vectors are one class. Each length has lists and codewords of its own, of which all tasks have all. Every
    class is in the inverted list of its nearest centroid, as codes of its residual; it searches the `probes` nearest lists, and of the others those that `searched` can't rule out for
    members close to their centroid. Centroids within the link radius are one, so that a hot group is one list. A
    member is a candidate while its asymmetric distance, less what its codes miss, can still reach the cosine, so
    that within the lists searched none is lost; candidates are verified exactly. A pair is a link if either finds
    the other. Only an index is fitted on a sample, of about `train` classes chosen by a hash and one of each length. n_links counts every link, so the work
    in a group of near copies is the square of its size; it is cut into tasks of `part` members and `asking` queries.

    component_id is the least vec_id reachable, kept says that it is the row's own. Vectors that are null, zero
    or hold null or non-finite components link with nothing. A null id links with nothing and has a null component;
    rows of one id are one node; an empty table gives none.
    """
    rows = vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[vector_col].cast("array<double>").alias("v"))
    rows = materialise(rows.mapInArrow(_unit_rows, "vec_id long, digest binary, dim int, unit binary"), "vectors")
    usable = rows.where("dim > 0 and vec_id is not null")
    classes = materialise(usable.groupBy("digest", "dim").agg(F.min("vec_id").alias("class"), F.count("*").alias("copies"), F.any_value("unit").alias("unit")), "classes")
    # a number for each length of vectors
    totals = {r["dim"]: r["count"] for r in classes.groupBy("dim").count().collect()}
    reach, every = float(np.sqrt(2 - 2 * cosine)), max(1, sum(totals.values()))
    mixed = F.xxhash64(F.lit(SEED), "class").bitwiseAND(F.lit((1 << 40) - 1))
    # each length's share of about `train` rows, and its first row in any case
    some = classes.select("dim", mixed.alias("mixed"), "digest", "unit").where(F.col("mixed") < F.lit(int(min(1.0, train / every) * (1 << 40))))
    first = classes.groupBy("dim").agg(F.min_by(F.struct(mixed.alias("mixed"), "digest", "unit"), F.struct(mixed, "digest")).alias("r")).select("dim", "r.*")
    chosen = {r["digest"]: r for r in some.unionByName(first).collect()}.values()
    samples: dict[int, list] = {}
    for r in sorted(chosen, key=lambda r: (r["dim"], r["mixed"], r["digest"])):
        samples.setdefault(r["dim"], []).append(np.frombuffer(r["unit"]))
    indexes = {d: Index(np.stack(x), max(1, min(MOST_LISTS, len(x), int(2 * totals[d] ** 0.5))), reach=reach) for d, x in samples.items()}
    indexed = materialise(classes.select("class", "copies", "unit", "dim").mapInArrow(_indexed(indexes, probes, reach), _INDEXED), "indexed")
    found = _met(indexed, indexes, cosine, part, asking)
    counts = found.where("b is null").groupBy("a").agg(F.sum("n").alias("others"))
    groups = components(found.where("b is not null").select("a", "b"))
    named = classes.select("digest", "dim", "class", "copies").join(counts, F.col("class") == F.col("a"), "left").join(groups, F.col("class") == F.col("node"), "left")
    named = named.select(F.col("digest").alias("of"), (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n"), F.coalesce("component", "class").alias("c"), F.col("dim").alias("d"))
    joined = rows.select("vec_id", "digest", "dim").join(named, (F.col("digest") == F.col("of")) & (F.col("dim") == F.col("d")) & F.col("vec_id").isNotNull(), "left")
    return joined.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("c", "vec_id").alias("component_id"), F.coalesce(F.coalesce("c", "vec_id") == F.col("vec_id"), F.lit(True)).alias("kept"))
