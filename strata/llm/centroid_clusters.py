"""Centroid clustering of integer vectors, with the threshold algorithm.

Finding a vector's nearest centroid is a top-1 query over one list for each
dimension, in which the centroids stand sorted by their value there. Every list
is entered at the vector's own value and walked outward, the nearer side first,
one step in all dimensions at a time. A centroid that is met for the first time
gets its exact distance. No centroid that is still unmet can be nearer than the
sum of the squared distances at the frontiers of all lists, so the walk ends
when that sum strictly exceeds the best exact distance (on a tie an unmet
centroid with a smaller number could still win).

All numbers are integers, so distances, sums and new centroids are exact. The
centroids (``k`` rows) travel to every task; vectors stay where they are. A
round sends one partial sum for each task, centroid and dimension.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, scratch, table

#: Components beyond this are held at it: squared distances of up to 64
#: dimensions then fit into a long.
MOST = 1 << 27
SCALE, DIM, K, ROUNDS, SEED = 64, 64, 16, 3, 1
#: Vectors that walk together.
WALK = 2048


def integer_vectors(vectors: DataFrame, dim: int = DIM, scale: int = SCALE) -> DataFrame:
    """(vec_id, vector array<long>) of the rows (vec_id, embedding; others
    ignored) whose embedding has exactly ``dim`` components, none NULL or
    non-finite: floor(``scale`` * x) of each, held within +-``MOST``."""
    x = F.col("embedding").cast("array<double>")
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    least, most = F.lit(float(-MOST)), F.lit(float(MOST))
    floor = F.transform("x", lambda v: F.floor(F.greatest(least, F.least(most, v * F.lit(float(scale))))))
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"))
            .where((F.size("x") == dim) & finite).select("vec_id", floor.alias("vector")))


def first_centroids(vectors: DataFrame, k: int = K, seed: int = SEED) -> np.ndarray:
    """The ``k`` vectors of smallest sha256 of ``<seed>:<vec_id>``, in that
    order; ties (repeated ids) by the vector. Rows without vec_id start none."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = (vectors.where("vec_id IS NOT NULL").select(key.alias("key"), "vector")
            .orderBy("key", "vector").limit(k).collect())  # k rows
    return np.array([r["vector"] for r in rows], dtype=np.int64)


class Lists:
    """The centroids sorted by value, once for each dimension."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        self.k, self.dim = centroids.shape
        order = np.argsort(centroids, axis=0, kind="stable")
        far = np.int64(1) << 40  # beyond every end: never the nearer side
        ends = np.full((1, self.dim), far)
        self.number = np.vstack([ends, order, ends])
        self.value = np.vstack([-ends, np.take_along_axis(centroids, order, axis=0), ends])

    def enter(self, x: np.ndarray) -> np.ndarray:
        """For each vector and dimension the first place whose value is not below."""
        at = np.empty(x.shape, dtype=np.int64)
        for d in range(self.dim):
            at[:, d] = np.searchsorted(self.value[1:-1, d], x[:, d], side="left") + 1
        return at

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Number of and squared distance to the nearest centroid of each row
        of ``x`` (ties: the smaller number), and how many distances it took."""
        n = len(x)
        best = np.full(n, np.iinfo(np.int64).max)
        found = np.full(n, self.k, dtype=np.int64)
        met = np.zeros((n, self.k), dtype=bool)
        high = self.enter(x)
        low = high - 1
        rows, columns = np.arange(n), np.arange(self.dim)
        taken = 0
        for _ in range(self.k):
            own = x[rows]
            below, above = own - self.value[low, columns], self.value[high, columns] - own
            down = below <= above
            step = np.where(down, below, above)
            number = np.where(down, self.number[low, columns], self.number[high, columns])
            low, high = low - down, high + ~down
            fresh = np.zeros((len(rows), self.k), dtype=bool)
            np.put_along_axis(fresh, number, True, axis=1)
            fresh &= ~met
            at, c = np.nonzero(fresh)
            met |= fresh
            gap = own[at] - self.centroids[c]
            distance = np.einsum("ij,ij->i", gap, gap)
            taken += len(at)
            order = np.lexsort((c, distance, at))
            first = order[np.concatenate([[True], at[order][1:] != at[order][:-1]])] if len(order) else order
            who, d, number = rows[at[first]], distance[first], c[first]
            nearer = (d < best[who]) | ((d == best[who]) & (number < found[who]))
            best[who[nearer]], found[who[nearer]] = d[nearer], number[nearer]
            frontier = np.einsum("ij,ij->i", step, step)
            on = (frontier <= best[rows]) & ~met.all(axis=1)
            if not on.any():
                break
            rows, low, high, met = rows[on], low[on], high[on], met[on]
        return found, best, taken


def _walk(pdf: pd.DataFrame, lists: Lists) -> Iterator[tuple[pd.DataFrame, np.ndarray, np.ndarray, np.ndarray]]:
    for a in range(0, len(pdf), WALK):
        part = pdf.iloc[a:a + WALK]
        x = np.stack(part["vector"].to_numpy()).astype(np.int64)
        found, distance, _ = lists.nearest(x)
        yield part, x, found, distance


def _sums(centroids: np.ndarray):
    """Vectors -> the count and component sums of each centroid, of one task."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lists = Lists(centroids)
        total = np.zeros(centroids.shape, dtype=np.int64)
        count = np.zeros(len(centroids), dtype=np.int64)
        held = 0

        def done() -> pd.DataFrame:
            c, d = (i.ravel() for i in np.indices(centroids.shape))
            return pd.DataFrame({"cluster": c, "component": d, "total": total.ravel().copy(), "n": count[c]})
        for pdf in frames:
            for _, x, found, _ in _walk(pdf, lists):
                np.add.at(total, found, x)
                count += np.bincount(found, minlength=len(count))
                held += len(x)
                if held >= 1 << 33:  # the sums still fit
                    yield done()
                    total[:], count[:], held = 0, 0, 0
        if held:
            yield done()
    return run


def _assign(centroids: np.ndarray):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lists = Lists(centroids)
        for pdf in frames:
            for part, _, found, distance in _walk(pdf, lists):
                yield pd.DataFrame({"vec_id": part["vec_id"], "cluster": found, "distance": distance})
    return run


def moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: each the componentwise exact
    floor(sum / count) of the vectors nearest to it; those of none stay."""
    partial = vectors.select("vector").mapInPandas(_sums(centroids), "cluster int, component int, total long, n long")
    rows = partial.groupBy("cluster", "component").agg(
        F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")).where("n > 0").collect()
    out = centroids.copy()  # k * dim rows came back
    for r in rows:
        out[r["cluster"], r["component"]] = int(r["total"]) // r["n"]
    return out


def cluster(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, seed: int = SEED) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, vector) of equal lengths -> their (vec_id, cluster, distance)
    and the final centroids, after ``rounds`` rounds of assigning and moving.

    Repeated rows are vectors of their own. With fewer than ``k`` vectors with a
    vec_id each of them starts a centroid; with none nothing can be assigned,
    and no rows come out. Rows with a NULL vec_id are assigned like any other.
    """
    spark = vectors.sparkSession
    with scratch(spark):
        held = materialise(vectors, "cluster-vectors")
        centroids = first_centroids(held, k, seed)
        if not len(centroids):
            return spark.createDataFrame([], "vec_id long, cluster int, distance long"), centroids
        for _ in range(rounds):
            centroids = moved(held, centroids)
        assigned = materialise(held.mapInPandas(_assign(centroids), "vec_id long, cluster int, distance long"),
                               "clusters", lasting=True)
    return assigned, centroids


def centroid_name(centroid: np.ndarray) -> str:
    """sha256 of the components as decimal integers joined by commas."""
    return hashlib.sha256(",".join(str(int(v)) for v in centroid).encode()).hexdigest()


def op11_centroid_clusters(spark, sf_dir: str) -> DataFrame:
    """16 clusters of all valid 64-component ``embeddings``, after three rounds."""
    assigned, centroids = cluster(integer_vectors(table(spark, sf_dir, "embeddings")))
    per = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()
    sums = {r["cluster"]: int(r["d"]) for r in per}  # a row a centroid
    names = [centroid_name(c) for c in centroids] or [""]

    def of(values: list, kind: str) -> Column:
        return F.get(F.lit(values), F.col("cluster")).cast(kind)
    return assigned.select(
        "vec_id", "cluster", "distance",
        of([str(sums.get(i, 0)) for i in range(len(names))], "long").alias("cluster_inertia"),
        F.lit(str(sum(sums.values()))).cast("long").alias("inertia"), of(names, "string").alias("centroid_sha256"))


def _oracle(k: int = K, rounds: int = ROUNDS) -> str:
    """DuckDB SQL: the rounds spelt out, every vector against every centroid."""
    def nearest(i: int) -> str:
        return f"""a{i} AS (
  SELECT rid, c AS cluster, d AS distance FROM (
    SELECT *, row_number() OVER (PARTITION BY rid ORDER BY d, c) AS r FROM (
      SELECT v.rid, t.c, sum((v.x - t.x) * (v.x - t.x)) AS d
      FROM v JOIN c{i} t USING (i) GROUP BY ALL)) WHERE r = 1)"""

    def moved_(i: int) -> str:
        return f"""s{i} AS (SELECT cluster AS c, i, sum(x) AS s, count(*) AS n FROM v JOIN a{i - 1} USING (rid) GROUP BY ALL),
c{i} AS (SELECT o.c, o.i, CASE WHEN n IS NULL THEN o.x
  ELSE ((s - (((s % n) + n) % n)) // n)::BIGINT END AS x FROM c{i - 1} o LEFT JOIN s{i} USING (c, i))"""
    steps = [nearest(0)]
    for i in range(1, rounds + 1):
        steps += [moved_(i), nearest(i)]
    body = ",\n".join(steps)
    return f"""
WITH e AS (
  SELECT row_number() OVER () AS rid, vec_id, embedding AS e FROM embeddings
  WHERE len(embedding) = {DIM} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), v AS (
  SELECT rid, unnest(range({DIM})) AS i, unnest(list_transform(e, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT)) AS x FROM e
), c0 AS (
  SELECT c, i, x FROM v JOIN (
    SELECT rid, row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id), e) - 1 AS c FROM e WHERE vec_id IS NOT NULL
  ) USING (rid) WHERE c < {k}
), {body}, z AS (
  SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY c
)
SELECT vec_id, cluster::INTEGER AS cluster, distance::BIGINT AS distance,
       (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
       (sum(distance) OVER ())::BIGINT AS inertia, centroid_sha256
FROM a{rounds} JOIN e USING (rid) JOIN z ON z.c = cluster
"""


ORACLE_OP11 = _oracle()
