"""Near-duplicate vectors by p-stable hashing, and nearest neighbours by a hierarchical k-means tree."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalens.llm.common import partitions_for, saved, whole_runs
from catalens.llm.components import cells, connected_components, forest, run_pairs

# ---------------------------------------------------------------- near-duplicates

COSINE, WIDTH, MISSED, PER_BUCKET, BLOCK, SKETCH = 0.98, 6.0, 1e-4, 32, 512, 256


def usable(vector: Column) -> Column:
    """Whether a vector has components, all of them finite numbers, and not all zero."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & good & F.exists(vector, lambda x: x != 0), F.lit(False))


def hash_plan(rows: int, cosine: float = COSINE, width: float = WIDTH, missed: float = MISSED, per_bucket: int = PER_BUCKET) -> tuple[float, int, int]:
    """Width of a quantisation step, projections in a key and tables, for so many vectors of one label.

    Unit vectors at ``cosine`` are r = sqrt(2 - 2 cosine) apart; a projection on a normal vector falls into the same
    step of width c r with probability p(c) (Datar et al. 2004). Keys take as many projections as bring a bucket of
    vectors in random directions down to ``per_bucket``, and tables enough that a pair at the threshold is missed with
    probability ``missed``.
    """
    r = math.sqrt(2 - 2 * cosine)
    w = width * r
    p = math.erf(width / math.sqrt(2)) - 2 / (math.sqrt(2 * math.pi) * width) * (1 - math.exp(-width * width / 2))
    bits = max(0.5, 2.047 - math.log2(w))  # entropy of a standard normal in steps of w
    k = max(3, min(24, math.ceil(math.log2(max(2, rows / per_bucket)) / bits)))
    return w, k, max(1, math.ceil(math.log(missed) / math.log(1 - p**k)))


def sketch_radius(cosine: float, bits: int = SKETCH) -> int:
    """Sign bits in which vectors at ``cosine`` differ: their mean, and 8 standard deviations more (missed: below 1e-9)."""
    p = math.acos(cosine) / math.pi
    return math.ceil(bits * p + 8 * math.sqrt(bits * p * (1 - p)))


class Projections:
    """Quantised random projections of unit vectors of any length: keys in ``tables`` tables of k steps each, and sign sketches."""

    def __init__(self, w: float, k: int, tables: int, seed: int):
        self.w, self.k, self.tables, self.seed = w, k, tables, seed
        self.drawn: dict[int, tuple] = {}

    def _of(self, dim: int) -> tuple:
        if dim not in self.drawn:
            rng, n = np.random.default_rng([self.seed, dim]), self.k * self.tables
            self.drawn[dim] = rng.standard_normal((dim, n)), rng.uniform(0, self.w, n), (rng.integers(1, 1 << 62, (self.tables, self.k), dtype=np.int64) << 1) | 1, rng.standard_normal((dim, SKETCH))
        return self.drawn[dim]

    def keys(self, x: np.ndarray) -> np.ndarray:
        a, b, mix, _ = self._of(x.shape[1])
        step = np.floor((x @ a + b) / self.w).astype(np.int64).reshape(len(x), self.tables, self.k)
        with np.errstate(over="ignore"):
            key = (step * mix).sum(2) * np.int64(0x9E3779B97F4A7C1) + np.arange(self.tables) * np.int64(0x5851F42D4C957F2D) + x.shape[1]
        return key ^ (key >> 29)

    def sketches(self, x: np.ndarray) -> np.ndarray:
        return np.packbits(x @ self._of(x.shape[1])[3] > 0, axis=1)


def _units(column: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, unit vectors in double precision) for each length of vector."""
    size = column.value_lengths().to_numpy()
    ends, flat = np.cumsum(size), column.flatten().to_numpy()
    for dim in np.unique(size).tolist():
        rows = np.flatnonzero(size == dim)
        x = flat[(ends[rows] - dim)[:, None] + np.arange(dim)].astype(np.float64)
        x /= np.abs(x).max(1, keepdims=True)
        yield rows, x / np.sqrt((x * x).sum(1, keepdims=True))


def _hashed(projections: Projections):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                label, cls = (part.column(part.schema.get_field_index(c)).to_numpy() for c in ("label_hash", "cls"))
                for rows, x in _units(part.column(part.schema.get_field_index("vector"))):
                    key = projections.keys(x)
                    with np.errstate(over="ignore"):
                        key += label[rows][:, None] * np.int64(0x2545F4914F6CDD1D)
                    tables = key.shape[1]
                    sketch = np.repeat(projections.sketches(x), tables, 0)
                    yield pa.RecordBatch.from_arrays([pa.array(np.repeat(cls[rows], tables)), pa.array(key.reshape(-1)), pa.array(np.tile(np.arange(tables, dtype=np.int32), len(rows))), pa.FixedSizeBinaryArray.from_buffers(pa.binary(SKETCH // 8), len(sketch), [None, pa.py_buffer(sketch.tobytes())]).cast(pa.binary())], names=["cls", "bucket", "tab", "sketch"])

    return run


def _plausible(apart: int):
    """The rows of each cell that have a mate in it whose sketch differs in ``apart`` bits at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in whole_runs(batches, ["bucket", "cell"]):
            bucket, cell, home = (part[c].to_numpy() for c in ("bucket", "cell", "home"))
            n = len(bucket)
            new = np.ones(n, bool)
            new[1:] = (bucket[1:] != bucket[:-1]) | (cell[1:] != cell[:-1])
            bits = np.frombuffer(b"".join(part["sketch"].to_pylist()), "<u8").reshape(n, -1)
            use = np.zeros(n, bool)
            for i, j in run_pairs(np.flatnonzero(new), n):
                near = (np.bitwise_count(bits[i] ^ bits[j]).sum(1, dtype=np.int64) <= apart) & ((home[i] < 0) | (home[i] != home[j]))
                use[i[near]] = use[j[near]] = True
            yield from part.select(["cls", "bucket", "tab", "cell", "home"]).filter(pa.array(use)).to_batches()

    return run


def _bucket_links(cosine: float, projections: Projections):
    """For each row of a cell: copies of its near vectors that no earlier table has shown, and a link to the smallest reachable one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in whole_runs(batches, ["bucket", "cell"], 5_000):
            bucket, cell, cls, copies, tab, home = (part[c].to_numpy() for c in ("bucket", "cell", "cls", "copies", "tab", "home"))
            n = len(cls)
            new = np.ones(n, bool)
            new[1:] = (bucket[1:] != bucket[:-1]) | (cell[1:] != cell[:-1])
            run_of = np.cumsum(new) - 1
            links, label = np.zeros(n, np.int64), np.arange(n)
            for rows, x in _units(part["vector"].combine_chunks()):
                keys = projections.keys(x)
                kind = run_of[rows] * projections.tables + tab[rows]  # keys of different kinds may have met by chance
                order = np.argsort(kind, kind="stable")
                for spot in np.split(order, np.flatnonzero(np.diff(kind[order])) + 1):
                    if len(spot) < 2:
                        continue
                    at, h, t = rows[spot], home[rows[spot]], int(tab[rows[spot[0]]])
                    i, j = np.nonzero(np.triu(x[spot] @ x[spot].T >= cosine, 1))
                    keep = (h[i] < 0) | (h[i] != h[j])
                    i, j = i[keep], j[keep]
                    if not len(i):
                        continue
                    fresh = np.ones(len(i), bool)
                    for earlier in range(t):
                        fresh &= keys[spot[i], earlier] != keys[spot[j], earlier]
                    np.add.at(links, at[i[fresh]], copies[at[j[fresh]]])
                    np.add.at(links, at[j[fresh]], copies[at[i[fresh]]])
                    label[at] = at[forest(len(at), i, j)]
            use = np.flatnonzero((links > 0) | (label != np.arange(n)))
            if len(use):
                yield pa.RecordBatch.from_arrays([pa.array(cls[use]), pa.array(cls[label[use]]), pa.array(links[use])], names=["a", "b", "n"])

    return run


def near_vectors(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", cosine: float = COSINE, seed: int = 7, cap: int = BLOCK) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept; links join vectors of one label with a cosine of at least ``cosine``.

    Copies (equal label and components) are one class from the start: they count as links of each other, and only a
    class's representative is hashed and compared. What is dealt by table and bucket are keys and sketches of 256 sign
    bits; a vector itself goes only to the buckets where another one's sketch is near its own. Vectors that are null,
    zero, or hold null or non-finite components, and those without a label, link with nothing, as do vectors of
    different lengths. Repeated rows, equal ids included, are vectors of their own. A null id is returned, but names no
    component unless all of the class's ids are null. Other columns play no part, whatever their names. An empty table
    gives an empty one.
    """
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("vector"), F.col(label).alias("label"))
    able = F.coalesce(F.col("label").isNotNull() & usable(F.col("vector")), F.lit(False))
    classes = saved(rows.filter(able).groupBy("label", "vector").agg(F.min("vec_id").alias("first"), F.count("*").alias("copies")).withColumn("cls", F.monotonically_increasing_id()))
    largest = classes.groupBy("label").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    w, k, tables = hash_plan(largest, cosine)
    projections = Projections(w, k, tables, seed)
    hashed = classes.select("cls", "vector", F.xxhash64("label").alias("label_hash")).mapInArrow(_hashed(projections), "cls long, bucket long, tab int, sketch binary")
    dealt = cells(hashed, "bucket", "cls", cap).repartition("bucket", "cell").sortWithinPartitions("bucket", "cell")
    few = dealt.select("cls", "bucket", "tab", "cell", "home", "sketch").mapInArrow(_plausible(sketch_radius(cosine)), "cls long, bucket long, tab int, cell long, home int")
    met = few.join(classes.select("cls", "copies", "vector"), "cls").repartition("bucket", "cell").sortWithinPartitions("bucket", "cell")
    found = saved(met.mapInArrow(_bucket_links(cosine, projections), "a long, b long, n long"))
    links = found.groupBy("a").agg(F.sum("n").alias("others"))
    component = connected_components(found.select("a", "b"))
    of_class = classes.join(links, F.col("cls") == F.col("a"), "left").drop("a").join(component, F.col("cls") == F.col("id"), "left").withColumn("group", F.coalesce("component_id", "cls")).drop("component_id", "id")
    smallest = of_class.groupBy("group").agg(F.min("first").alias("component_id"))
    answers = of_class.join(smallest, "group").select("label", "vector", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    whole = rows.withColumn("able", able).join(answers.withColumn("able", F.lit(True)), ["able", "label", "vector"], "left")
    return whole.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op4_near_vectors(embeddings: DataFrame) -> DataFrame:
    """Per vector: vec_id, n_links, component_id, kept; see ``near_vectors`` for odd rows."""
    return near_vectors(embeddings)


# ---------------------------------------------------------------- nearest neighbours

#: The tree is fitted on at most so many vectors; each node splits into BRANCH; a leaf of the tree stands for LEAF rows or so.
FIT_ROWS, BRANCH, LEAF, CALIBRATION, RECALL = 20_000, 8, 200, 100, 0.97
#: Neighbouring leaves are searched as one group: of about so many components at most, of so many rows at least where tasks are to spare.
GROUP_VALUES, GROUP_ROWS = 1 << 23, 8192
#: A task routes so many queries at once, and compares so many with so many rows.
ROUTED, ASKED, COMPARED = 64, 1024, 2048


class KMeansTree:
    """Nodes with centres; children of each inner node; leaves numbered."""

    def __init__(self, sample: np.ndarray, leaf_rows: int, branch: int = BRANCH, seed: int = 11):
        self.centres: list[np.ndarray] = []
        self.children: list[list[int]] = []
        self.leaf: list[int] = []
        self.n_leaves = 0
        self.rng = np.random.default_rng(seed)
        self._grow(sample, max(2, leaf_rows), branch)
        self.points = np.array(self.centres)
        self.leaf_nodes = np.flatnonzero(np.array(self.leaf) >= 0)  # leaves are numbered in the order of their nodes
        self.parent = np.zeros(len(self.centres), np.int64)
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []  # of each level, its nodes, and where each parent's children begin
        open_ = [0]
        while open_ := [node for node in open_ if self.children[node]]:
            sizes = [len(self.children[node]) for node in open_]
            below = [child for node in open_ for child in self.children[node]]
            self.parent[below] = np.repeat(open_, sizes)
            self.levels.append((np.array(below), np.cumsum([0, *sizes[:-1]])))
            open_ = below

    def _grow(self, x: np.ndarray, leaf_rows: int, branch: int) -> int:
        node = len(self.centres)
        self.centres.append(x.mean(0) if len(x) else np.zeros(x.shape[1]))
        self.children.append([])
        self.leaf.append(-1)
        parts = self._split(x, branch) if len(x) > leaf_rows else []
        if len(parts) < 2:
            self.leaf[node] = self.n_leaves
            self.n_leaves += 1
            return node
        for p in parts:
            self.children[node].append(self._grow(p, leaf_rows, branch))
        return node

    def _split(self, x: np.ndarray, branch: int) -> list[np.ndarray]:
        distinct = np.unique(x, axis=0)
        if len(distinct) < 2:
            return []
        centres = distinct[self.rng.choice(len(distinct), min(branch, len(distinct)), replace=False)]
        for _ in range(8):
            near = squared(x, centres).argmin(1)
            centres = np.stack([x[near == c].mean(0) if (near == c).any() else centres[c] for c in range(len(centres))])
        near = squared(x, centres).argmin(1)
        return [x[near == c] for c in range(len(centres)) if (near == c).any()]

    def assign(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each vector, by the nearest child from the root down."""
        out = np.full(len(x), -1)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if not self.children[node]:
                out[rows] = self.leaf[node]
                continue
            near = squared(x[rows], self.points[self.children[node]]).argmin(1)
            todo += [(child, rows[near == c]) for c, child in enumerate(self.children[node]) if (near == c).any()]
        return out

    def best_bins(self, query: np.ndarray, leaves: int) -> list[int]:
        """The first ``leaves`` leaves by best-bin-first: always the open branch whose centre is nearest goes on."""
        return self._best_bins(squared(query[None], self.points)[0], [(0.0, 0)], leaves)

    def _best_bins(self, near: np.ndarray, queue: list[tuple[float, int]], leaves: int) -> list[int]:
        out: list[int] = []
        heapq.heapify(queue)
        while queue and len(out) < leaves:
            _, node = heapq.heappop(queue)
            while children := self.children[node]:
                d = near[children]
                order = d.argsort(kind="stable").tolist()
                for c in order[1:]:
                    heapq.heappush(queue, (float(d[c]), children[c]))
                node = children[order[0]]
            out.append(self.leaf[node])
        return out

    def visited(self, queries: np.ndarray, leaves: int) -> np.ndarray:
        """For each query and leaf, whether the leaf is among the first ``leaves`` by best-bin-first.

        A leaf is reached from an open branch by nearest children. No branch is taken before those that lead to it, so
        the largest distance among these tells its turn; only leaves behind the branch at which the search ends share
        their turn, and are put in order one by one.
        """
        if leaves >= self.n_leaves:
            return np.ones((len(queries), self.n_leaves), bool)
        near = squared(queries, self.points)
        turn = np.full(near.shape, -np.inf)
        for nodes, starts in self.levels:
            sizes = np.diff(starts, append=len(nodes))
            d = near[:, nodes]
            least = d == np.repeat(np.minimum.reduceat(d, starts, axis=1), sizes, axis=1)
            count = least.cumsum(1, dtype=np.int32)
            least &= count - np.repeat(count[:, starts] - least[:, starts], sizes, axis=1) == 1  # of equal children the first
            before = turn[:, self.parent[nodes]]
            turn[:, nodes] = np.where(least, before, np.maximum(before, d))
        at = turn[:, self.leaf_nodes]
        last = np.partition(at, leaves - 1, axis=1)[:, leaves - 1 : leaves]
        seen = at < last
        lack, level = leaves - seen.sum(1), at == last
        whole = level.sum(1) == lack
        seen[whole] |= level[whole]
        finite = np.isfinite(near).all(1)
        for i in np.flatnonzero(~whole | ~finite).tolist():
            if finite[i]:
                branches = np.flatnonzero((turn[i] == last[i]) & (turn[i, self.parent] < last[i])).tolist()
                seen[i, self._best_bins(near[i], [(float(near[i, b]), b) for b in branches], int(lack[i]))] = True
            else:  # squares beyond doubles have no order
                seen[i] = False
                seen[i, self._best_bins(near[i], [(0.0, 0)], leaves)] = True
        return seen


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * a).sum(1)[:, None] - 2 * a @ b.T + (b * b).sum(1)


def exact(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision, component differences first."""
    d = x - q
    return np.sqrt(np.einsum("ij,ij->i", d, d))


def extended(x: np.ndarray) -> np.ndarray:
    """Vectors with 1 and their squared length behind them: a product with (-2 q, q q, 1) is the squared distance to q."""
    out = np.empty((len(x), x.shape[1] + 2))
    out[:, :-2], out[:, -2] = x, 1
    out[:, -1] = np.einsum("ij,ij->i", out[:, :-2], out[:, :-2])
    return out


def nearest_rows(own: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, bounds: np.ndarray, seen: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, vec_id, distance) of each query's k nearest rows, ties to the smaller id, among the rows of the leaves that it has ``seen``.

    ``rows`` are ``extended`` and lie leaf by leaf between ``bounds``. A product of matrices leaves out the rows that are
    further than k others by more than its rounding; the distances of all others are measured by ``exact``'s rule.
    """
    dim = queries.shape[1]
    rounding = 8 * (dim + 4) * np.finfo(float).eps
    square = np.einsum("ij,ij->i", queries, queries)
    factors = np.concatenate([-2 * queries, square[:, None], np.ones((len(queries), 1))], axis=1)
    most = np.full(len(queries), np.inf)  # a row whose squared distance is larger is none of a query's k nearest
    out: tuple[list, list, list] = ([np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)])
    waiting, limit = 0, max(1 << 14, 4 * k * len(queries))

    def settle() -> int:
        out[0][:], out[1][:], out[2][:] = _best(out, k)
        count = np.bincount(out[0][0], minlength=len(queries))
        full = count >= k
        most[full] = np.fmin(most[full], out[2][0][count.cumsum()[full] - 1] ** 2 * (1 + rounding))
        return len(out[0][0])

    for leaf in np.flatnonzero(seen.any(0) & (np.diff(bounds) > 0)).tolist():
        asks = np.flatnonzero(seen[:, leaf])
        for at in range(int(bounds[leaf]), int(bounds[leaf + 1]), COMPARED):
            upto = min(at + COMPARED, int(bounds[leaf + 1]))
            y, y_ids = rows[at:upto], ids[at:upto]
            near = factors[asks] @ y.T
            slack = rounding * (square[asks] + y[:, -1].max()) + np.finfo(float).tiny
            order = y_ids.argsort(kind="stable")
            low, high = (y_ids.searchsorted(own[asks], side, sorter=order) for side in ("left", "right"))
            for i in np.flatnonzero(high > low).tolist():
                near[i, order[low[i] : high[i]]] = np.inf
            new = np.flatnonzero(np.isinf(most[asks]))
            if len(new) and len(y) >= k:
                bound = np.partition(near[new], k - 1, axis=1)[:, k - 1] + slack[new]
                most[asks[new]] = np.where(np.isfinite(bound), bound, np.inf)
            far = near > (most[asks] + slack)[:, None]  # what is no number is measured as well
            i, j = np.divmod(np.flatnonzero(~far), len(y))
            other = y_ids[j] != own[asks[i]]
            i, j = asks[i[other]], j[other]
            for part in range(0, len(i), 1 << 14):
                of, row = i[part : part + (1 << 14)], j[part : part + (1 << 14)]
                out[0].append(of)
                out[1].append(y_ids[row])
                out[2].append(exact(queries[of], y[row, :dim]))
                waiting += len(of)
                if waiting > limit:
                    waiting = settle()
    settle()
    return own[out[0][0]], out[1][0], out[2][0]


def _matrix(column: pa.ListArray, dim: int) -> np.ndarray:
    return column.flatten().to_numpy().astype(np.float64).reshape(-1, dim)


def _found(query: np.ndarray, vec: np.ndarray, score: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(query), pa.array(vec), pa.array(score)], names=["query_id", "vec_id", "score"])


def _best(out: tuple[list, list, list], k: int) -> tuple[list, list, list]:
    """The k nearest of each query among (query, vec, score) parts."""
    q, v, d = map(np.concatenate, out)
    order = np.lexsort([v, d, q])
    q, v, d = q[order], v[order], d[order]
    first = np.ones(len(q), bool)
    first[1:] = q[1:] != q[:-1]
    start = np.maximum.accumulate(np.where(first, np.arange(len(q)), 0))
    keep = np.arange(len(q)) - start < k
    return [q[keep]], [v[keep]], [d[keep]]


def search(df: DataFrame, queries: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", k: int = 10, recall: float = RECALL, fit_rows: int = FIT_ROWS, leaf: int = LEAF, calibration: int = CALIBRATION, group_values: int = GROUP_VALUES, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found of each query by Euclidean distance, rows of its own id left out.

    ``queries`` has the columns of ``df``. The tree is fitted on a sample of at most about ``fit_rows`` rows, and every
    row is put into a leaf. About ``calibration`` queries are answered exactly over all rows; the leaves that a search
    visits, by best bin first, are as many as find ``recall`` of those answers. Neighbouring leaves are a group, and a
    large leaf takes part in several, so that no task holds more rows than a group's; a query goes once to each group in
    which it visits a leaf, with the leaves that it visits there, so that what is sent follows the groups, not the
    visits. Vectors that are null, zero or hold null or non-finite components take no part; nor do rows with a null id.
    Vectors of different lengths have no distance: each length is searched by itself, with a tree of its own. Repeated
    rows are candidates as often as they come; a repeated query is answered once, and a query id that comes with several
    vectors has one list for all of them. Ties go to the smaller vec_id. Fewer candidates than k give as many rows. Other
    columns play no part.
    """
    kind = "array<float>" if all(t.select(F.col(vector)).dtypes[0][1] == "array<float>" for t in (df, queries)) else "array<double>"
    clean = lambda t: t.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast(kind).alias("v")).filter(F.col("vec_id").isNotNull() & usable(F.col("v")))
    rows, asked = clean(df), saved(clean(queries).dropDuplicates())
    lengths = [(r["dim"], r["n"]) for r in rows.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n")).collect()]  # a row for each length of vector
    parts = [_found_of_length(rows.filter(F.size("v") == dim), asked.filter(F.size("v") == dim), dim, n, k, recall, fit_rows, leaf, calibration, kind, group_values, group_rows) for dim, n in sorted(lengths)]
    return ranked(reduce(DataFrame.unionByName, parts), k) if parts else df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")


def _drawn(seed: int, share: float) -> Column:
    """Whether a row is in a sample of that share, by its id and vector."""
    return F.pmod(F.xxhash64("vec_id", F.col("v").cast("array<double>"), F.lit(seed)), F.lit(1 << 30)) <= share * (1 << 30)


def _found_of_length(rows: DataFrame, asked: DataFrame, dim: int, n: int, k: int, recall: float, fit_rows: int, leaf: int, calibration: int, kind: str, group_values: int, group_rows: int) -> DataFrame:
    """(query_id, vec_id, score) of the k best of each visited group, among vectors of one length."""
    spark = rows.sparkSession
    drawn = rows.filter(_drawn(3, min(1.0, fit_rows / n))).select("v").limit(2 * fit_rows).collect() or rows.select("v").limit(1).collect()
    sample = np.array([r["v"] for r in drawn])
    tree = spark.sparkContext.broadcast(KMeansTree(sample, max(2, round(leaf * len(sample) / n))))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tree.value.assign(_matrix(batch.column(1), dim)))], names=["vec_id", "v", "leaf"])

    placed = saved(rows.mapInArrow(place, f"vec_id long, v {kind}, leaf long").withColumn("row", F.monotonically_increasing_id()))
    visits = _calibrated(asked, placed, tree, dim, k, recall, calibration)

    size = np.zeros(tree.value.n_leaves, np.int64)
    for r in placed.groupBy("leaf").agg(F.count("*").alias("n")).collect():  # at most as many as the sample has rows
        size[r["leaf"]] = r["n"]
    parallel = partitions_for(spark)
    groups = max(math.ceil(n * dim / group_values), min(parallel, math.ceil(n / group_rows)))
    per = math.ceil(n / groups)
    ends = size.cumsum()
    # of each group, the leaves that have rows in it
    first = [int(np.searchsorted(ends, g * per, "right")) for g in range(groups)]
    last = [int(np.searchsorted(ends - size, (g + 1) * per, "left")) for g in range(groups)]

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ASKED):
                part = batch.slice(at, ASKED)
                v = _matrix(part.column(1), dim)
                seen = np.concatenate([tree.value.visited(v[i : i + ROUTED], visits) for i in range(0, len(v), ROUTED)])
                seen[:, size == 0] = False
                for g in range(groups):
                    here = seen[:, first[g] : last[g]]
                    to = np.flatnonzero(here.any(1))
                    if len(to):
                        bits = np.packbits(here[to], axis=1)
                        leaves = pa.FixedSizeBinaryArray.from_buffers(pa.binary(bits.shape[1]), len(to), [None, pa.py_buffer(bits.tobytes())]).cast(pa.binary())
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(to), g, np.int32)), part.column(0).take(pa.array(to)), part.column(1).take(pa.array(to)), leaves], names=["group", "vec_id", "v", "leaves"])

    spans = spark.createDataFrame([(i, int(e - s), int(s)) for i, (s, e) in enumerate(zip(size, ends)) if s], "leaf long, start long, size long")
    spot = F.col("start") + F.pmod(F.xxhash64("row"), F.col("size"))
    stored = placed.join(F.broadcast(spans), "leaf").select(F.floor(spot / per).cast("int").alias("group"), F.lit(False).alias("asks"), "leaf", "vec_id", "v", F.lit(None).cast("binary").alias("leaves"))
    routed = asked.repartition(parallel).mapInArrow(route, f"group int, vec_id long, v {kind}, leaves binary")
    visiting = routed.select("group", F.lit(True).alias("asks"), F.lit(-1).cast("long").alias("leaf"), "vec_id", "v", "leaves")

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a group's rows come first, leaf by leaf, then the queries that visit it
        now, held = None, []
        store: tuple | None = None
        for batch in batches:
            group, asks = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))  # none is null
            new = np.ones(len(group), bool)
            new[1:] = (group[1:] != group[:-1]) | (asks[1:] != asks[:-1])
            bounds = np.append(np.flatnonzero(new), len(group)).tolist()
            for s, e in zip(bounds[:-1], bounds[1:]):
                if group[s] != now:
                    now, held, store = int(group[s]), [], None
                if not asks[s]:
                    held.append(batch.slice(s, e - s))
                    continue
                leaves = last[now] - first[now]
                if held:
                    in_leaf, ids = (np.concatenate([b.column(i).to_numpy() for b in held]) for i in (2, 3))
                    x = np.concatenate([b.column(4).flatten().to_numpy().reshape(-1, dim) for b in held])
                    held = []
                    store = ids, extended(x), np.searchsorted(in_leaf, np.arange(first[now], last[now] + 1))
                    del x
                for at in range(s, e, ASKED) if store else ():
                    part = batch.slice(at, min(ASKED, e - at))
                    bits = np.frombuffer(b"".join(part.column(5).to_pylist()), np.uint8).reshape(part.num_rows, -1)
                    yield _found(*nearest_rows(part.column(3).to_numpy(), _matrix(part.column(4), dim), *store, np.unpackbits(bits, axis=1, count=leaves).astype(bool), k))

    both = stored.unionByName(visiting).repartitionById(groups, "group").sortWithinPartitions("group", "asks", "leaf")
    return both.select("group", "asks", "leaf", "vec_id", "v", "leaves").mapInArrow(answer, "query_id long, vec_id long, score double")


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The k smallest of each query; at most k for each vector from each part come in."""
    best = F.expr("row_number() over (partition by query_id order by score, vec_id)")
    return found.withColumn("rank", best).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def brute_force(asked: list[tuple[int, np.ndarray]], rows: DataFrame, k: int, dim: int) -> DataFrame:
    """Exact answers of a bounded list of queries, by comparing all rows (vec_id, v) with each in one pass."""

    own, queries = np.array([q for q, _ in asked], np.int64), np.array([v for _, v in asked])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _found(*nearest_rows(own, queries, batch.column(0).to_numpy(), extended(_matrix(batch.column(1), dim)), np.array([0, batch.num_rows]), np.ones((len(own), 1), bool), k))

    return ranked(rows.mapInArrow(scan, "query_id long, vec_id long, score double"), k)


def _calibrated(asked: DataFrame, placed: DataFrame, tree, dim: int, k: int, recall: float, calibration: int) -> int:
    """How many leaves, best bin first, hold ``recall`` of the true neighbours of a sample of the queries."""
    total = asked.count()
    share = min(1.0, calibration / max(1, total))
    few = [(r["vec_id"], np.array(r["v"])) for r in asked.filter(_drawn(5, share)).limit(2 * calibration).collect()]
    if not few:
        return tree.value.n_leaves
    found = brute_force(few, placed.select("vec_id", "v"), k, dim).select("query_id", "vec_id")  # k rows for each of few queries
    truth = placed.select("vec_id", "leaf").join(F.broadcast(found), "vec_id").select("query_id", "leaf").collect()
    place = {q: {leaf: i for i, leaf in enumerate(tree.value.best_bins(v, tree.value.n_leaves))} for q, v in few}
    ranks = sorted(place[r["query_id"]][r["leaf"]] for r in truth)
    return ranks[min(len(ranks) - 1, math.ceil(recall * len(ranks)) - 1)] + 1 if ranks else tree.value.n_leaves


def op8_neighbours(embeddings: DataFrame) -> DataFrame:
    """The 10 nearest found of each row whose id is divisible by 100; see ``search`` for odd rows."""
    return search(embeddings, embeddings.filter(F.col("vec_id") % 100 == 0))
