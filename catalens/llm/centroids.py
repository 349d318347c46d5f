"""Exact k-means over integer vectors, with centroids ruled out by PCA-rotated lower bounds.

Vectors are rotated to the principal axes of all of them; of each are stored the leading rotated coordinates and the
norm of the rest. For a vector x and a centroid c, both rotated, |x - c|^2 is at least the squared distance of their
leading coordinates plus the squared difference of their residual norms. The centroid of least bound is measured first,
exactly and in integers; centroids whose bound, less a slack far above any rounding error, exceeds that distance are out,
and the others are measured exactly as well. So the rotation decides how much work is saved and never what is found.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalens.llm.common import saved

CLUSTERS, ROUNDS, DIM, SCALE, SEED = 8, 10, 64, 1024, 3
#: Leading axes hold this share of the variance, and are at most half of all.
SHARE = 0.9
#: Rounding errors are below 1e-13 of the squared lengths.
SLACK = 1e-9
#: Components in integers up to which squared distances fit a long.
LARGEST = 1 << 27


def _matrix(batch: pa.RecordBatch, name: str) -> np.ndarray:
    col = batch.column(batch.schema.get_field_index(name))
    return col.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1) if batch.num_rows else np.zeros((0, 1))


def integers(df: DataFrame, vec_id: str, vector: str, dim: int = DIM, scale: int = SCALE) -> DataFrame:
    """(vec_id, q array<int>): floor(scale x component) of vectors with exactly ``dim`` components, none null or not finite."""
    v = F.col(vector)
    whole = v.isNotNull() & (F.size(v) == dim) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    kept = df.filter(F.coalesce(whole, F.lit(False))).select(F.col(vec_id).cast("long").alias("vec_id"), v.cast("array<double>").alias("v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.floor(scale * _matrix(batch, "v"))
            if np.abs(x).max(initial=0) > LARGEST:
                raise ValueError(f"a component beyond {LARGEST // scale}: squared distances would not fit a long")
            q = pa.ListArray.from_arrays(np.arange(0, x.size + 1, dim, dtype=np.int32), pa.array(x.astype(np.int32).reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), q], names=["vec_id", "q"])

    return kept.mapInArrow(run, "vec_id long, q array<int>")


def first_centroids(vectors: DataFrame, clusters: int = CLUSTERS, seed: int = SEED) -> np.ndarray:
    """The vectors whose ``seed:id`` has the smallest sha256; of one id those of smaller components, of null ids only where others are too few."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = vectors.orderBy(key.asc_nulls_last(), "q").limit(clusters).select("q").collect()
    return np.array([r.q for r in first], np.int64) if first else np.zeros((0, 0), np.int64)


def principal_axes(vectors: DataFrame, dim: int = DIM) -> tuple[np.ndarray, np.ndarray, int]:
    """(mean, orthonormal axes as columns by falling variance, how many are leading); dim^2 + dim + 1 sums come to the driver."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(dim * dim + dim + 1)
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch, "q").astype(np.float64)
                total += np.concatenate([(x.T @ x).reshape(-1), x.sum(0), [len(x)]])
        if total[-1]:
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], names=["sums"])

    found = vectors.mapInArrow(sums, "sums array<double>").select(F.posexplode("sums").alias("at", "s")).groupBy("at").agg(F.sum("s").alias("s"))
    total = np.zeros(dim * dim + dim + 1)
    for at, s in found.collect():
        total[at] = s
    n = max(total[-1], 1)
    mean = total[dim * dim : -1] / n
    spread, axes = np.linalg.eigh(total[: dim * dim].reshape(dim, dim) / n - np.outer(mean, mean))
    spread, axes = np.maximum(spread[::-1], 0), axes[:, ::-1]
    held = np.cumsum(spread) / max(spread.sum(), 1e-300)
    return mean, axes, min(int(np.searchsorted(held, SHARE)) + 1, max(1, dim // 2))


class Rotation:
    """Leading rotated coordinates and residual norms of integer vectors."""

    def __init__(self, mean: np.ndarray, axes: np.ndarray, leading: int):
        self.mean, self.axes, self.leading = mean, axes, leading

    def __call__(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        y = (q - self.mean) @ self.axes
        return y[:, : self.leading], np.sqrt((y[:, self.leading :] ** 2).sum(1))


def rotated(vectors: DataFrame, rotation: Rotation) -> DataFrame:
    """``vectors`` with columns lead (coordinates) and rest (residual norm)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                lead, rest = rotation(_matrix(batch, "q"))
                lead = pa.ListArray.from_arrays(np.arange(0, lead.size + 1, rotation.leading, dtype=np.int32), pa.array(np.ascontiguousarray(lead).reshape(-1)))
                yield pa.RecordBatch.from_arrays([*batch.columns, lead, pa.array(rest)], names=["vec_id", "q", "lead", "rest"])

    return vectors.mapInArrow(run, "vec_id long, q array<int>, lead array<double>, rest double")


def nearest(q: np.ndarray, lead: np.ndarray, rest: np.ndarray, centroids: np.ndarray, rotation: Rotation) -> tuple[np.ndarray, np.ndarray, int]:
    """(number of the nearest centroid, squared distance) of each row, ties to the smaller number; and how many distances were measured."""
    c_lead, c_rest = rotation(centroids)
    size, c_size = (lead * lead).sum(1) + rest * rest, (c_lead * c_lead).sum(1) + c_rest * c_rest
    near = (lead * lead).sum(1)[:, None] + (c_lead * c_lead).sum(1) - 2 * lead @ c_lead.T
    bound = near + (rest[:, None] - c_rest) ** 2 - SLACK * (size[:, None] + c_size + 1)
    rows, first = np.arange(len(q)), bound.argmin(1)

    def measured(i: np.ndarray, k: np.ndarray | int) -> np.ndarray:
        d = q[i] - centroids[k]
        return (d * d).sum(1)

    best, which, done = measured(rows, first), first.copy(), len(q)
    for k in range(len(centroids)):
        left = np.flatnonzero((bound[:, k] <= best) & (first != k))
        d = measured(left, k)
        better = (d < best[left]) | ((d == best[left]) & (k < which[left]))
        best[left[better]], which[left[better]] = d[better], k
        done += len(left)
    return which, best, done


def _assigned(batches: Iterator[pa.RecordBatch], centroids: np.ndarray, rotation: Rotation) -> Iterator[tuple]:
    for batch in batches:
        for at in range(0, batch.num_rows, 20_000):
            part = batch.slice(at, 20_000)
            q = _matrix(part, "q").astype(np.int64)
            which, best, _ = nearest(q, _matrix(part, "lead"), part.column(3).to_numpy(), centroids, rotation)
            yield part, q, which, best


def cluster_sums(vectors: DataFrame, centroids: np.ndarray, rotation: Rotation) -> dict[int, list[int]]:
    """For each centroid that has vectors: the sums of their components, of their squared distances, and their count."""
    k, dim = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, dim + 2), object)
        for _, q, which, best in _assigned(batches, centroids, rotation):
            for c in np.unique(which).tolist():
                mine = which == c
                d = best[mine]
                total[c] += np.array([*q[mine].sum(0).tolist(), (int((d >> 31).sum()) << 31) + int((d & 0x7FFFFFFF).sum()), len(d)], object)
        used = [c for c in range(k) if total[c, -1]]
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array([list(map(str, total[c])) for c in used], pa.list_(pa.string()))], names=["cluster", "sums"])

    each = vectors.mapInArrow(run, "cluster int, sums array<string>").select("cluster", F.posexplode("sums").alias("at", "s"))
    found: dict[int, list[int]] = {}
    for c, at, s in each.groupBy("cluster", "at").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect():  # k x (dim + 2) numbers at most
        found.setdefault(c, [0] * (dim + 2))[at] = int(s)
    return found


def moved(centroids: np.ndarray, sums: dict[int, list[int]]) -> np.ndarray:
    """Centroids with vectors become the floor of their mean, exactly; the others stay."""
    out = centroids.copy()
    for c, (*parts, _, n) in sums.items():
        out[c] = [s // n for s in parts]
    return out


OUT = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def cluster(df: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED, dim: int = DIM, scale: int = SCALE, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per kept vector: its cluster and squared distance after ``rounds`` rounds, sums of these, and its centroid's digest.

    Vectors that are null, of another length, or hold a null or a component that isn't finite are left out. Repeated rows
    count as often as they come; a null id stays null. With fewer vectors than ``clusters`` there are as many clusters as
    vectors; an empty table gives an empty result. Sums beyond a long are null, and components whose distances would not
    fit one raise an error. Rounds end early once no centroid moves, which changes nothing.
    """
    spark = df.sparkSession
    vectors = integers(df, vec_id, vector, dim, scale)
    centroids = first_centroids(vectors, clusters, seed)
    if not len(centroids):
        return spark.createDataFrame([], OUT)
    rotation = Rotation(*principal_axes(vectors, dim))
    stored = saved(rotated(vectors, rotation))
    sums: dict[int, list[int]] = {}
    for _ in range(rounds):
        sums = cluster_sums(stored, centroids, rotation)
        was, centroids = centroids, moved(centroids, sums)
        if (was == centroids).all():
            break
    else:
        sums = cluster_sums(stored, centroids, rotation)
    long = lambda n: n if n < 1 << 63 else None
    own = [long(sums[c][-2]) if c in sums else 0 for c in range(len(centroids))]
    total = long(sum(s[-2] for s in sums.values()))
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, which, best in _assigned(batches, centroids, rotation):
            mine = which.tolist()
            columns = [part.column(0), pa.array(which, pa.int32()), pa.array(best), pa.array([own[c] for c in mine], pa.int64()), pa.array([total] * len(mine), pa.int64()), pa.array([digest[c] for c in mine], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"])

    return stored.mapInArrow(run, OUT)


def op12_centroids(embeddings: DataFrame) -> DataFrame:
    """Per kept vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    return cluster(embeddings)


def _oracle() -> str:
    parts = [
        f"""WITH kept AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE len(embedding) = {DIM} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIM}),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id) NULLS LAST, q) - 1 AS k, q FROM kept QUALIFY k < {CLUSTERS})"""
    ]
    for r in range(ROUNDS + 1):
        parts.append(f"""a{r} AS MATERIALIZED (SELECT rid, min({{'d': d, 'k': k}}) AS best FROM
  (SELECT rid, k, list_sum(list_transform(list_zip(a.q, c.q), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM kept a CROSS JOIN c{r} c) GROUP BY rid)""")
        if r < ROUNDS:
            parts.append(f"""m{r} AS (SELECT k, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS q FROM
  (SELECT best.k AS k, i, sum(q[i]) AS s, count(*) AS n FROM a{r} JOIN kept USING (rid), unnest(range(1, {DIM + 1})) u(i) GROUP BY best.k, i) GROUP BY k),
c{r + 1} AS MATERIALIZED (SELECT c.k, coalesce(m.q, c.q) AS q FROM c{r} c LEFT JOIN m{r} m USING (k))""")
    return ",\n".join(parts) + f"""
SELECT vec_id, best.k::INTEGER AS cluster, best.d AS distance, sum(best.d) OVER (PARTITION BY best.k)::BIGINT AS cluster_inertia, sum(best.d) OVER ()::BIGINT AS inertia, sha256(array_to_string(c.q, ',')) AS centroid_sha256
FROM a{ROUNDS} JOIN kept USING (rid) JOIN c{ROUNDS} c ON c.k = best.k"""


ORACLE = _oracle()
