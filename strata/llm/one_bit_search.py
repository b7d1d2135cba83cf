"""Nearest neighbours by largest inner product, with one-bit codes.

Every vector is padded with zeros to ``BITS`` dimensions, rotated at random
and reduced to the signs of its coordinates. With the code go the vector's
norm and the inner product ``f`` of its rotated direction with its code's, the
two corrections for an unbiased estimate of any inner product:

    <o, q>  ~  |o| * <code, rotated q> / (sqrt(BITS) * f)

whose error is below ``|o| |q| * sqrt((1 - f**2) / f**2) * ERROR / sqrt(BITS - 1)``
but for a chance that falls as exp(-ERROR**2 / 2). A vector is reranked with
its original components unless that bound shows that enough others are nearer.

All rows are indexed. Queries and rows are dealt into blocks, and each pair of
blocks is one group of bounded size that sends on its nearest ``k`` a query.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, table

BITS = 512
#: Standard deviations of the estimate's error that the bound covers.
ERROR = 3.0
ROWS_BLOCK, QUERY_BLOCK = 8192, 2048
K = 20


def rotation(dim: int, bits: int = BITS, seed: int = 20) -> np.ndarray:
    """(bits', dim): the columns of a random rotation that meet a padded vector."""
    bits = max(bits, -(-dim // 64) * 64)
    q, _ = np.linalg.qr(np.random.default_rng(seed + dim).standard_normal((bits, dim)))
    return q


def _index(batches):
    turns: dict[int, np.ndarray] = {}
    for pdf in batches:
        rows = []
        for vec_id, uid, v in zip(pdf["vec_id"], pdf["uid"], pdf["vector"]):
            v = np.asarray(v, dtype=np.float64)
            norm = float(np.sqrt(v @ v))
            if not norm or not np.isfinite(norm):  # the square under- or overflows
                top = np.abs(v).max()
                norm = float(top * np.sqrt(((v / top) ** 2).sum()))
            turn = turns.get(len(v))
            if turn is None:
                turn = turns[len(v)] = rotation(len(v))
            z = turn @ (v / norm)
            rows.append((vec_id, uid, len(v), norm, float(np.abs(z).sum() / np.sqrt(len(z))),
                         np.packbits(z > 0).tobytes(), v.astype("<f8").tobytes()))
        yield pd.DataFrame(rows, columns=["vec_id", "uid", "dim", "norm", "f", "code", "vector"])


def _inner(rows: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products in double precision, summed from the first component on."""
    total = np.zeros(len(rows))
    for d in range(rows.shape[1]):
        total += rows[:, d] * q[d]
    return total


def _search(k: int, error: float):
    def run(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(rows):
            return pd.DataFrame({"query": [], "query_id": [], "vec_id": [], "score": []})
        dim = int(rows["dim"].iloc[0])
        turn = rotation(dim)
        bits = len(turn)
        signs = np.unpackbits(np.frombuffer(b"".join(rows["code"]), np.uint8).reshape(len(rows), -1), axis=1)
        signs = signs.astype(np.float32) * 2 - 1
        vectors = np.frombuffer(b"".join(rows["vector"]), "<f8").reshape(len(rows), dim)
        norm, f, ids = (rows[c].to_numpy() for c in ("norm", "f", "vec_id"))
        scale = (norm / (np.sqrt(bits) * f)).astype(np.float32)
        wide = (norm * np.sqrt(np.maximum(0, 1 - f ** 2)) / f * error / np.sqrt(bits - 1)).astype(np.float32)
        wanted = np.frombuffer(b"".join(queries["vector"]), "<f8").reshape(len(queries), dim)
        turned = (wanted @ turn.T).astype(np.float32)
        out = []
        for low in range(0, len(queries), 128):
            guess = (turned[low:low + 128] @ signs.T) * scale
            for i in range(len(guess)):
                own = ids != queries["vec_id"].iloc[low + i]
                off = wide * np.float32(queries["norm"].iloc[low + i])
                sure = np.where(own, guess[i] - off, -np.inf)
                least = np.partition(sure, -k)[-k] if len(sure) > k else -np.inf
                at = np.flatnonzero(own & (guess[i] + off >= least))
                score = _inner(vectors[at], wanted[low + i])
                best = np.lexsort((ids[at], -score))[:k]
                out.append(pd.DataFrame({"query": queries["uid"].iloc[low + i], "query_id": queries["vec_id"].iloc[low + i],
                                         "vec_id": ids[at][best], "score": score[best]}))
        return pd.concat(out)
    return run


def nearest(vectors: DataFrame, every: int, k: int = K, error: float = ERROR) -> DataFrame:
    """(vec_id, embedding), others ignored: the ``k`` nearest rows of each row
    whose vec_id is divisible by ``every``.

    Nearness is the inner product; ties go to the smaller vec_id. Columns
    query_id, rank, vec_id, score. A row is no candidate for its own vec_id.
    Rows with a NULL vec_id or a vector that is NULL, empty, zero or holds a
    NULL or non-finite component take no part; vectors of different lengths do
    not meet. Fewer candidates than ``k`` are all returned. Rows repeated with
    vec_id and vector count once.
    """
    v = F.col("embedding").cast("array<double>")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    valid = (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("vector"))
             .where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & (F.size("vector") > 0))
             .where(finite & F.exists("vector", lambda x: x != 0)).distinct()
             .withColumn("uid", F.monotonically_increasing_id()))
    index = materialise(valid.mapInPandas(
        _index, "vec_id long, uid long, dim int, norm double, f double, code binary, vector binary"), "one-bit-codes")
    queries = index.where(F.col("vec_id") % every == 0)
    row_blocks = max(1, -(-index.count() // ROWS_BLOCK))
    query_blocks = max(1, -(-queries.count() // QUERY_BLOCK))

    def dealt(df: DataFrame, own: str, n: int, other: str, others: int) -> DataFrame:
        return (df.withColumn(own, F.pmod(F.xxhash64("uid"), F.lit(n)).cast("int"))
                .withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1)))))
    key = ["dim", "qb", "rb"]
    left = dealt(queries.select("dim", "uid", "vec_id", "norm", "vector"), "qb", query_blocks, "rb", row_blocks)
    right = dealt(index, "rb", row_blocks, "qb", query_blocks)
    found = (left.groupBy(*key).cogroup(right.groupBy(*key))
             .applyInPandas(_search(k, error), "query long, query_id long, vec_id long, score double"))
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op9_one_bit_neighbours(spark, sf_dir: str) -> DataFrame:
    """The 20 nearest of all ``embeddings`` to each whose vec_id is divisible by 20."""
    return nearest(table(spark, sf_dir, "embeddings"), every=20)


ORACLE_OP9 = """
WITH v AS (
  SELECT vec_id, embedding AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), p AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         list_reduce(list_prepend(0.0::DOUBLE, list_transform(list_zip(q.e, c.e), lambda z: z[1]::DOUBLE * z[2]::DOUBLE)),
                     lambda a, b: a + b) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p
) WHERE rank <= 20
"""
