"""Approximate nearest neighbours with randomly rotated one-bit codes.

A vector minus the centre is filled up with zeros to ``BITS`` dimensions and
rotated at random; the signs of its components are its code, packed to bits. Two scalars correct it: the distance to the centre
and the inner product of the unit vector with its code. Together they give an
unbiased estimate of the inner product with any query, and an error bound that
holds with high probability. A block keeps, per query, the vectors whose upper
bound reaches the k-th largest lower bound, and ranks these by the vectors
themselves.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.llm.common import hashed_sample, stored

BITS = 512  # of a code at least
ERROR = 2.5  # width of the bound, in standard deviations of the estimate
SAMPLE = 10_000  # rows from which the centre is taken
ROWS, QUERIES = 16_384, 1_024  # per block


def rotation(dim: int, bits: int | None = None, seed: int = 5) -> np.ndarray:
    """A random rotation of vectors that are filled up with zeros to ``bits`` dimensions (rows: the ``dim`` that count).

    The same for the same seed. Inner products stay as they are; the more bits, the narrower the error bounds.
    """
    bits = max(bits or dim, dim)
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((bits, dim)))
    return (q * np.sign(np.diag(r))).T


def encode(x: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed code, distance to the centre, and inner product of unit vector and code, per row of ``x``."""
    d = (x - centre) @ turn
    norm = np.sqrt((d * d).sum(axis=1))
    bits = d >= 0
    fit = np.abs(d).sum(axis=1) / np.sqrt(d.shape[1]) / np.where(norm > 0, norm, 1)
    return np.packbits(bits, axis=1), norm, np.where(norm > 0, fit, 1.0)


def estimate(query: np.ndarray, centre: np.ndarray, turn: np.ndarray, code: np.ndarray, norm: np.ndarray, fit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products (queries x rows) and how far the true ones may be off."""
    dim = turn.shape[1]
    signs = np.unpackbits(code, axis=1, count=dim).astype(np.float32)
    q = (query @ turn).astype(np.float32)
    # <q, sign code> = 2 <q, bits> - sum(q)
    raw = (2 * (q @ signs.T) - q.sum(axis=1, keepdims=True)) / np.sqrt(dim)
    value = (query @ centre)[:, None] + raw * (norm / fit)[None]
    spread = np.sqrt(np.maximum(1 - fit * fit, 0)) / fit / np.sqrt(max(dim - 1, 1)) * norm
    return value, ERROR * np.sqrt((query * query).sum(axis=1))[:, None] * spread[None]


def usable(vec: Column) -> Column:
    """Neither NULL nor empty, no NULL or non-finite component, and not zero."""
    bad = F.exists(vec, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.coalesce(vec.isNotNull() & ~bad & F.exists(vec, lambda v: v != 0), F.lit(False))


def vectors(df: DataFrame, vec_id: str = "vec_id", vec: str = "embedding") -> DataFrame:
    """``vec_id, vec`` (doubles) of the rows that take part."""
    rows = df.select(F.col(f"`{vec_id}`").cast("bigint").alias("vec_id"), F.col(f"`{vec}`").cast("array<double>").alias("vec"))
    return rows.where(usable(F.col("vec")) & F.col("vec_id").isNotNull())


def centre_of(rows: DataFrame, sample: int = SAMPLE) -> np.ndarray | None:
    """Mean of at most ``sample`` vectors, those with the smallest hashes of their ids."""
    got = hashed_sample(rows, "vec_id", sample).select("vec").collect()
    dims = {len(r["vec"]) for r in got}
    if not dims:
        return None
    dim = max(dims, key=lambda d: sum(len(r["vec"]) == d for r in got))
    return np.mean([r["vec"] for r in got if len(r["vec"]) == dim], axis=0)


def index(rows: DataFrame, centre: np.ndarray, turn: np.ndarray) -> DataFrame:
    """``vec_id, vec, code, norm, fit`` of every vector that has the index's dimension."""
    dim = len(centre)

    def work(parts):
        for b in parts:
            x = np.array(b.column(1).flatten()).reshape(-1, dim)
            code, norm, fit = encode(x, centre, turn)
            yield pa.record_batch(
                [b.column(0), b.column(1), pa.array([c.tobytes() for c in code], pa.binary()), pa.array(norm), pa.array(fit)],
                names=["vec_id", "vec", "code", "norm", "fit"],
            )

    return rows.where(F.size("vec") == dim).mapInArrow(work, "vec_id long, vec array<double>, code binary, norm double, fit double")


def _matrix(pdf_column, dim: int) -> np.ndarray:
    return np.vstack(pdf_column.to_numpy()) if len(pdf_column) else np.zeros((0, dim))


def block_search(ids, x, code, norm, fit, query_ids, query, centre, turn, k: int) -> list[tuple[int, int, float]]:
    """``(query_id, vec_id, score)`` of each query's ``k`` best in a block, the query itself left out; equal scores by id."""
    out: list[tuple[int, int, float]] = []
    for at in range(0, len(query), 64):
        qs, names = query[at : at + 64], query_ids[at : at + 64]
        value, off = estimate(qs, centre, turn, code, norm, fit)
        low, high = value - off, value + off
        own = names[:, None] == ids[None]
        low[own], high[own] = -np.inf, -np.inf
        for i, name in enumerate(names):
            least = -np.partition(-low[i], k - 1)[k - 1] if len(ids) > k else -np.inf
            chosen = np.flatnonzero((high[i] >= least) & ~own[i])
            # Row sums run in the same order for each row, so equal vectors have equal scores.
            exact = (x[chosen] * qs[i]).sum(axis=1)
            if len(chosen) > 4 * k:  # all that reach the k-th score, ties included, before sorting
                floor = -np.partition(-exact, k - 1)[k - 1]
                chosen, exact = chosen[exact >= floor], exact[exact >= floor]
            order = np.lexsort((ids[chosen], -exact))[:k]
            out += [(int(name), int(ids[c]), float(s)) for c, s in zip(chosen[order], exact[order], strict=True)]
    return out


def search(df: DataFrame, k: int = 20, every: int = 20, vec_id: str = "vec_id", vec: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row whose id is divisible by ``every`` its ``k`` nearest other rows.

    Nearness is the inner product in double precision, ties go to the smaller
    id; with fewer rows all are returned. Vectors that are NULL, empty, zero, or
    hold NULL or non-finite components take no part, nor do NULL ids or vectors
    of another dimension than most of the sample. Of rows with the same id the
    one with the smallest hash of its vector counts.

    Every vector is indexed. Queries and rows are dealt into blocks of bounded
    size by hashes of their ids, and each pair of blocks is one group: what a
    block returns is bounded by ``k`` per query, whatever it holds. A query's
    blocks are then merged by rank.
    """
    spark = df.sparkSession
    rows = vectors(df, vec_id, vec).groupBy("vec_id").agg(F.min_by("vec", F.xxhash64("vec")).alias("vec"))
    rows = stored(rows, "vectors")
    empty = "query_id long, rank int, vec_id long, score double"
    centre = centre_of(rows)
    if centre is None:
        return spark.createDataFrame([], empty)
    dim, turn = len(centre), rotation(len(centre), BITS)
    indexed = stored(index(rows, centre, turn), "codes")
    n = indexed.count()
    row_blocks, query_blocks = -(-n // ROWS), -(-n // (every * QUERIES))

    def dealt(salt: int, blocks: int) -> Column:
        return F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(max(blocks, 1))).cast("int")

    def spread(blocks: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(max(blocks, 1) - 1)))

    held = indexed.select(
        dealt(1, row_blocks).alias("rb"), spread(query_blocks).alias("qb"), "vec_id", "vec", "code", "norm", "fit"
    )
    asked = indexed.where(F.col("vec_id") % every == 0).select(
        spread(row_blocks).alias("rb"), dealt(2, query_blocks).alias("qb"), "vec_id", "vec"
    )

    def work(_key, left, right):
        import pandas as pd

        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})
        code = np.frombuffer(b"".join(left["code"]), dtype=np.uint8).reshape(len(left), -1)
        found = block_search(
            left["vec_id"].to_numpy(), _matrix(left["vec"], dim), code, left["norm"].to_numpy(), left["fit"].to_numpy(),
            right["vec_id"].to_numpy(), _matrix(right["vec"], dim), centre, turn, k,
        )
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    found = held.groupBy("rb", "qb").cogroup(asked.groupBy("rb", "qb")).applyInPandas(work, "query_id long, vec_id long, score double")
    by_score = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
