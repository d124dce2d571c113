"""Centroid clustering with geometric drift tightening.

Vectors become integers, centroids stay integers (floors of means), and all distances
that decide are exact.  A vector carries its cluster, an upper bound of its distance to
the cluster's centroid and a lower bound of its distance to every other one.

1. The first round measures every vector against every centroid.
2. Sums, counts and the largest upper bound of each cluster come from one partially
   aggregated grouping; they give the new centroids and the radius of the sphere around the
   old centroid that holds all the cluster's vectors.
3. When centroid j moves from p to q, no vector x of a sphere comes closer by more than
   max(|x - p| - |x - q|).  That is at most |p - q| cos t, t being the least angle at the
   middle of p and q between the move and the sphere: a point where the difference is 2a lies
   inside a branch of the hyperbola with foci p and q, and so inside its asymptotes.  The
   sphere's centre, p and q span a plane, so the angle is that to the centre less
   that under which the radius is seen.  Lower bounds of a cluster are loosened by
   the largest of these figures, not by the largest full drift.
4. Vectors whose bounds leave no doubt keep their cluster; the others are measured against their
   own centroid, and if still in doubt against all centroids.

State is written after each round in the shared folder: a lost executor costs reading it
again.  Through the driver go one row a cluster and round, whatever the number of vectors.

Vectors with another number of components, or with null or non-finite ones, are left out;
null vectors too.  Components beyond 2^27 after scaling count as 2^27 (exact sums end there).
Repeated rows and ids are vectors of their own; a null id comes last among the first
centroids.  Fewer vectors than ``k`` make fewer clusters; none give no rows.  Other
columns may have any names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

#: Components are clamped here, so that squared distances of up to 64 of them fit 64 bits.
MOST = 1 << 27
#: Up to here products in float64 are exact.
FLOAT_MOST = 1 << 22
#: Relative room for rounding when bounds are compared.
ROOM = 1e-9


@dataclass(frozen=True)
class Settings:
    k: int = 16
    rounds: int = 3
    dim: int = 64
    scale: int = 64
    seed: int = 1


def integer_vectors(vectors: DataFrame, s: Settings, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id and v (integers) of the vectors that are kept."""
    x = F.transform(F.col(embedding), lambda e: e.cast("double"))
    fine = (F.size(embedding) == s.dim) & F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    most = F.lit(float(MOST))
    whole = F.transform(x, lambda e: F.floor(F.greatest(F.least(e * float(s.scale), most), -most)).cast("int"))
    return vectors.where(F.col(embedding).isNotNull() & fine).select(F.col(vec_id).cast("long").alias("vec_id"), whole.alias("v"))


def first_centroids(kept: DataFrame, s: Settings) -> np.ndarray:
    """The vectors of the smallest SHA-256 of ``seed:vec_id``, in that order."""
    hashed = kept.withColumn("h", F.sha2(F.concat(F.lit(f"{s.seed}:"), F.col("vec_id").cast("string")), 256))
    return np.array([r.v for r in hashed.orderBy(F.col("h").asc_nulls_last(), "v").limit(s.k).collect()], np.int64).reshape(-1, s.dim)


def squared(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of ``v`` to all rows of ``c``."""
    if max(np.abs(v).max(initial=0), np.abs(c).max(initial=0)) <= FLOAT_MOST:
        a, b = v.astype(np.float64), c.astype(np.float64)
        return ((a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * (a @ b.T)).astype(np.int64)
    return np.stack([((v - x) ** 2).sum(1) for x in c], 1)


def own_squared(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of each row of ``v`` to the same row of ``c``."""
    d = v - c
    return np.einsum("ij,ij->i", d, d)


def loosening(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """For each cluster i, whose vectors lie in the sphere around old[i] with radius[i],
    by how much at most any of them has come closer to a centroid j other than i."""
    old, new = old.astype(float), new.astype(float)
    out = np.zeros(len(old))
    drift = np.sqrt(((new - old) ** 2).sum(1))
    middle = (old + new) / 2
    for i in range(len(old)):
        to = old[i] - middle
        far = np.sqrt((to**2).sum(1))
        seen = (drift > 0) & (far > radius[i])
        cosine = np.ones(len(old))
        along = (to[seen] * (new - old)[seen]).sum(1) / (far[seen] * drift[seen])
        angle = np.arccos(np.clip(along, -1, 1)) - np.arcsin(radius[i] / far[seen])
        cosine[seen] = np.minimum(1.0, np.maximum(0.0, np.cos(np.maximum(0.0, angle))) + 1e-7)
        bound = drift * cosine
        bound[i] = 0
        out[i] = bound.max()
    return out


@dataclass(frozen=True)
class Round:
    """What a task needs to know of a round: centroids, and how bounds change with them."""

    centroids: np.ndarray
    drift: np.ndarray
    loosen: np.ndarray
    half: np.ndarray  # half the distance to the nearest other centroid

    @classmethod
    def after(cls, old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> Round:
        gaps = np.sqrt(squared(new, new).astype(float))
        np.fill_diagonal(gaps, np.inf)
        return cls(new, np.sqrt(((new - old).astype(float) ** 2).sum(1)), loosening(old, new, radius), gaps.min(1) / 2)


def nearest(v: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cluster (the smallest of ties), distance to it, distance to the next centroid."""
    d = squared(v, c)
    a = d.argmin(1)
    best = d[np.arange(len(v)), a]
    if len(c) == 1:
        return a, np.sqrt(best.astype(float)), np.full(len(v), np.inf)
    d[np.arange(len(v)), a] = np.iinfo(np.int64).max
    return a, np.sqrt(best.astype(float)), np.sqrt(d.min(1).astype(float))


def reassign(v: np.ndarray, a: np.ndarray, upper: np.ndarray, lower: np.ndarray, r: Round) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Clusters and bounds after a round, and how many vectors were scanned."""
    a, upper = a.copy(), upper + r.drift[a]
    lower = np.maximum(lower - r.loosen[a], 0.0)
    sure = lambda i: upper[i] * (1 + ROOM) + ROOM < np.maximum(lower[i], r.half[a[i]]) * (1 - ROOM)
    left = np.flatnonzero(~sure(np.arange(len(a))))
    upper[left] = np.sqrt(own_squared(v[left], r.centroids[a[left]]).astype(float))
    left = left[~sure(left)]
    if len(left):
        a[left], upper[left], lower[left] = nearest(v[left], r.centroids)
    return a, upper, lower, len(left)


def _matrix(column: pa.ListArray, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dim)


STATE = "vec_id long, v array<int>, a int, upper double, lower double"


def first_round(kept: DataFrame, centroids: np.ndarray, s: Settings) -> DataFrame:
    """Every vector with its cluster and bounds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            a, upper, lower = nearest(_matrix(b.column(1), s.dim), centroids)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(a, pa.int32()), pa.array(upper), pa.array(lower)], ["vec_id", "v", "a", "upper", "lower"])

    return kept.mapInArrow(run, STATE)


def next_round(state: DataFrame, r: Round, s: Settings, last: bool) -> DataFrame:
    """The state after a move of the centroids; ``last`` gives vec_id, a and d (the
    squared distance) instead."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v, (a, upper, lower) = _matrix(b.column(1), s.dim), (b.column(i).to_numpy(zero_copy_only=False) for i in (2, 3, 4))
            new, upper, lower, _ = reassign(v, a, upper, lower, r)
            if last:
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(new, pa.int32()), pa.array(own_squared(v, r.centroids[new]))], ["vec_id", "a", "d"])
            else:
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(new, pa.int32()), pa.array(upper), pa.array(lower)], ["vec_id", "v", "a", "upper", "lower"])

    return state.select("vec_id", "v", "a", "upper", "lower").mapInArrow(run, "vec_id long, a int, d long" if last else STATE)


def moved(state: DataFrame, centroids: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """The new centroids, and the radius of each cluster around its old one."""
    sums = [F.sum(F.col("v")[i].cast("long")).alias(f"s{i}") for i in range(s.dim)]
    new, radius = centroids.copy(), np.zeros(len(centroids))
    for r in state.groupBy("a").agg(F.count("*").alias("n"), F.max("upper").alias("far"), *sums).collect():  # a row a cluster
        new[r.a] = [r[f"s{i}"] // r.n for i in range(s.dim)]
        radius[r.a] = r.far * (1 + ROOM) + ROOM
    return new, radius


def cluster_vectors(vectors: DataFrame, s: Settings = Settings(), vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id, cluster, distance (squared), cluster_inertia, inertia (sums of distance, at most
    2^63 - 1) and centroid_sha256 of every kept vector."""
    spark = vectors.sparkSession
    kept = integer_vectors(vectors, s, vec_id, embedding)
    centroids = first_centroids(kept, s)
    if not len(centroids):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    if s.rounds < 1:
        raise ValueError("at least one round")
    state = written(first_round(kept, centroids, s))
    for i in range(s.rounds):
        new, radius = moved(state, centroids, s)
        r, centroids, last = Round.after(centroids, new, radius), new, i == s.rounds - 1
        state = written(next_round(state, r, s, last))
    total = {x.a: int(x.t) for x in state.groupBy("a").agg(F.sum(F.col("d").cast("decimal(38,0)")).alias("t")).collect()}  # a row a cluster
    most, hashes = (1 << 63) - 1, [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    of = spark.createDataFrame([(a, min(t, most), min(sum(total.values()), most), hashes[a]) for a, t in total.items()], "a int, cluster_inertia long, inertia long, centroid_sha256 string")
    out = state.join(F.broadcast(of), "a")
    return out.select("vec_id", F.col("a").alias("cluster"), F.col("d").alias("distance"), "cluster_inertia", "inertia", "centroid_sha256")


def oracle(s: Settings = Settings()) -> str:
    """The same in SQL, every vector against every centroid in each round."""
    parts = [
        f"kept AS (SELECT vec_id, row_number() OVER () AS r, list_transform(embedding, lambda x: CAST(floor({s.scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings "
        f"WHERE len(embedding) = {s.dim} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {s.dim})",
        f"c0 AS (SELECT row_number() OVER (ORDER BY sha256('{s.seed}:' || vec_id)) - 1 AS j, v AS c FROM kept QUALIFY j < {s.k})",
    ]
    for i in range(s.rounds + 1):
        parts.append(
            f"d{i} AS (SELECT r, j, list_sum(list_transform(list_zip(v, c), lambda x: (x[1] - x[2]) * (x[1] - x[2]))) AS d FROM kept, c{i}), "
            f"a{i} AS (SELECT r, j, d FROM d{i} QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, j) = 1)"
        )
        if i < s.rounds:
            parts.append(
                f"s{i} AS (SELECT j, i, sum(v[i]) AS t, count(*) AS n FROM a{i} JOIN kept USING (r), range(1, {s.dim + 1}) AS q(i) GROUP BY j, i), "
                f"m{i} AS (SELECT j, list(CAST((t - ((t % n + n) % n)) // n AS BIGINT) ORDER BY i) AS c FROM s{i} GROUP BY j), "
                f"c{i + 1} AS (SELECT j, coalesce(m{i}.c, c{i}.c) AS c FROM c{i} LEFT JOIN m{i} USING (j))"
            )
    n = s.rounds
    return (
        f"WITH {', '.join(parts)} SELECT vec_id, CAST(j AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY j) AS BIGINT) AS cluster_inertia, "
        f"CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256 FROM a{n} JOIN kept USING (r) JOIN c{n} USING (j)"
    )
