"""Whitening of embeddings by a polarisation covariance.

For two columns, Var(a + b) = Var(a) + Var(b) + 2 Cov(a, b). So it is enough to
add up squares: of each centred dimension, and of each centred sum of two
dimensions. Entries are made whole numbers first, so every sum is exact and the
covariance does not depend on how rows are dealt out. It is assembled on the
driver from one number per pair of dimensions and goes to ``eigh``.

Squares stay small because values are centred at a whole number near the mean,
m = round(S / n), with r = S - n m left over: for u = x - m, the exact n^2 fold
variance is n sum(u^2) - r^2, and likewise for sums of two dimensions.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.common import stored

COMPONENTS = 8
SCALE, OFFSET = 1024, 100_000
#: Entries up to this size become whole numbers without loss of their place.
LARGEST = float(1 << 42)
#: Components with less of the trace than this are noise of the arithmetic.
LEAST_SHARE = 1e-13
_BLOCK = 4_096


@dataclass(frozen=True)
class Whitening:
    """The fit of the vectors of one length: ``centre`` + ``rest`` / n is the mean; ``axes``: dimensions x components."""

    n: int
    sums: list[int]
    axes: np.ndarray
    values: np.ndarray
    trace: float

    @property
    def explained(self) -> np.ndarray:
        return self.values / self.trace if self.trace else self.values


def usable(column: str = "embedding") -> Column:
    """Whether a vector is there, has entries, and all of them are finite and not too large to be whole numbers."""
    v = F.col(f"`{column}`")
    entry_ok = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) <= LARGEST)
    return F.coalesce((F.size(v) > 0) & F.forall(v, entry_ok), F.lit(False))


def whole_numbers(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, dims, x`` of the usable rows: ``floor(1024 c) + 100000`` per entry as a long."""
    x = F.transform(F.col(f"`{vector}`"), lambda c: F.floor(c.cast("double") * F.lit(float(SCALE))).cast("bigint") + F.lit(OFFSET))
    kept = rows.where(usable(vector))
    return kept.select(F.col(f"`{vec_id}`").cast("bigint").alias("vec_id"), F.size(f"`{vector}`").alias("dims"), x.alias("x"))


def _matrices(batch: pa.RecordBatch):
    """(rows, matrix of whole numbers) per length of vectors in a batch with columns dims and x."""
    dims = batch["dims"].to_numpy(zero_copy_only=False)
    for d in np.unique(dims).tolist():
        rows = np.flatnonzero(dims == d)
        mine = batch["x"].take(pa.array(rows)) if len(rows) < batch.num_rows else batch["x"]
        yield d, rows, mine.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), d)


def _exact_sum(a: np.ndarray) -> list[int]:
    """Column sums as whole numbers of any size."""
    most = int(np.abs(a).max(initial=0))
    if most * max(len(a), 1) < 1 << 62:
        return a.sum(axis=0, dtype=np.int64).tolist()
    return [int(v) for v in a.astype(object).sum(axis=0)]


def sums(x: DataFrame) -> DataFrame:
    """``dims, i, n, s``: rows and the exact sum per length and dimension."""

    def work(parts):
        found: dict[int, tuple[int, list[int]]] = {}
        for b in parts:
            for d, rows, m in _matrices(b):
                n, s = found.get(d, (0, [0] * d))
                found[d] = n + len(rows), [p + q for p, q in zip(s, _exact_sum(m), strict=True)]
        for d, (n, s) in found.items():
            columns = [pa.array([d] * d, pa.int32()), pa.array(range(d), pa.int32()), pa.array([n] * d, pa.int64()), _decimals(s)]
            yield pa.record_batch(columns, names=["dims", "i", "n", "s"])

    parts = x.select("dims", "x").mapInArrow(work, "dims int, i int, n long, s decimal(38,0)")
    return parts.groupBy("dims", "i").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))


def _decimals(values: list[int]) -> pa.Array:
    from decimal import Decimal

    return pa.array([Decimal(v) for v in values], pa.decimal128(38, 0))


def _square_sums(m: np.ndarray, i: int) -> list[int]:
    """Sums of squares of dimension ``i`` alone, and of its sums with each later dimension."""
    u = m[:, i : i + 1] + m[:, i:]
    u[:, 0] = m[:, i]
    most = int(np.abs(u).max(initial=0))
    if most * most * max(len(u), 1) < 1 << 62:
        return np.einsum("rk,rk->k", u, u).tolist()
    big = u.astype(object)
    return [int(v) for v in (big * big).sum(axis=0)]


def square_sums(x: DataFrame, centres: dict[int, list[int]]) -> DataFrame:
    """``dims, i, j, q``: for i = j the exact sum of squares of the centred dimension, for i < j of the sum of both.

    ``centres``: a whole number per dimension, by length. A task holds one number per pair of dimensions.
    """

    def work(parts):
        found: dict[int, list[list[int]]] = {}
        for b in parts:
            for at in range(0, b.num_rows, _BLOCK):
                for d, _, m in _matrices(b.slice(at, _BLOCK)):
                    u = m - np.array(centres[d], dtype=np.int64)
                    q = found.setdefault(d, [[0] * (d - i) for i in range(d)])
                    for i in range(d):
                        q[i] = [p + s for p, s in zip(q[i], _square_sums(u, i), strict=True)]
        for d, q in found.items():
            for i, row in enumerate(q):
                columns = [pa.array([v] * (d - i), pa.int32()) for v in (d, i)] + [pa.array(range(i, d), pa.int32()), _decimals(row)]
                yield pa.record_batch(columns, names=["dims", "i", "j", "q"])

    parts = x.select("dims", "x").mapInArrow(work, "dims int, i int, j int, q decimal(38,0)")
    return parts.groupBy("dims", "i", "j").agg(F.sum("q").alias("q"))


def fit(x: DataFrame, components: int = COMPONENTS) -> dict[int, Whitening]:
    """The whitening of each length of vectors in ``x`` (``whole_numbers``).

    What comes to the driver is one number per pair of dimensions, however many
    rows there are.
    """
    found: dict[int, tuple[int, dict[int, int]]] = {}
    for r in sums(x).collect():
        found.setdefault(r.dims, (r.n, {}))[1][r.i] = int(r.s)
    total = {d: (n, [s[i] for i in range(d)]) for d, (n, s) in found.items()}
    # The whole number next to the mean, ties upwards.
    centres = {d: [(2 * s + n) // (2 * n) for s in ss] for d, (n, ss) in total.items()}
    squares: dict[int, dict[tuple[int, int], int]] = {d: {} for d in total}
    for r in square_sums(x, centres).collect() if total else []:
        squares[r.dims][r.i, r.j] = int(r.q)
    return {d: _whitening(n, s, centres[d], squares[d], components) for d, (n, s) in total.items()}


def covariance(n: int, sums_: list[int], centre: list[int], squares: dict[tuple[int, int], int]) -> np.ndarray:
    """The covariance with divisor n, from exact variances of dimensions and of sums of two."""
    d = len(sums_)
    rest = [s - n * m for s, m in zip(sums_, centre, strict=True)]
    own = [n * squares[i, i] - rest[i] ** 2 for i in range(d)]  # n^2 times the variance
    out = np.empty((d, d))
    for i in range(d):
        out[i, i] = own[i] / (n * n)
        for j in range(i + 1, d):
            both = n * squares[i, j] - (rest[i] + rest[j]) ** 2
            out[i, j] = out[j, i] = (both - own[i] - own[j]) / (2 * n * n)
    return out


def _whitening(n: int, sums_: list[int], centre: list[int], squares: dict, components: int) -> Whitening:
    v = covariance(n, sums_, centre, squares)
    values, axes = np.linalg.eigh(v)
    trace = float(np.trace(v))
    order = [i for i in np.argsort(values)[::-1][:components] if values[i] > trace * LEAST_SHARE]
    axes = axes[:, order]
    # Either sign is right; the entry of largest size is made positive, so runs agree.
    signs = np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(len(order))]) if len(order) else np.ones(0)
    return Whitening(n, sums_, axes * signs, values[order], trace)


def _deviation(n: int, sums_: list[int], m: np.ndarray) -> list[int | None]:
    """Per row the exact sum of ``(n x - S)^2`` over its dimensions; NULL where that is beyond a long."""
    s = np.array(sums_, dtype=object)
    bound = n * max(int(np.abs(m).max(initial=0)), 1) + max(map(abs, sums_))
    if bound < 1 << 62:
        y = m * np.int64(n) - s.astype(np.int64)
        if int(np.abs(y).max(initial=0)) ** 2 * m.shape[1] < 1 << 63:
            return (y * y).sum(axis=1).tolist()
    y = m.astype(object) * n - s
    return [v if v < 1 << 63 else None for v in (y * y).sum(axis=1).tolist()]


def project(x: DataFrame, fits: dict[int, Whitening]) -> DataFrame:
    """``vec_id, dims, n, deviation, w``: the whitened values of each row of ``x``, one per component."""

    def work(parts):
        for b in parts:
            for d, rows, m in _matrices(b):
                f = fits[d]
                centre = [(2 * s + f.n) // (2 * f.n) for s in f.sums]
                rest = np.array([(s - f.n * c) / f.n for s, c in zip(f.sums, centre, strict=True)])
                w = ((m - np.array(centre, dtype=np.int64)) - rest) @ f.axes / np.sqrt(f.values)
                yield pa.record_batch(
                    [
                        b["vec_id"].take(pa.array(rows)), pa.array([d] * len(rows), pa.int32()), pa.array([f.n] * len(rows), pa.int64()),
                        pa.array(_deviation(f.n, f.sums, m), pa.int64()),
                        pa.FixedSizeListArray.from_arrays(pa.array(w.ravel()), w.shape[1]).cast(pa.list_(pa.float64()))
                        if w.shape[1] else pa.array([[]] * len(rows), pa.list_(pa.float64())),
                    ],
                    names=["vec_id", "dims", "n", "deviation", "w"],
                )

    return x.mapInArrow(work, "vec_id long, dims int, n long, deviation long, w array<double>")


def identity_errors(rows: DataFrame, components: int = COMPONENTS) -> dict[int, float]:
    """Per length the largest absolute entry of the whitened values' covariance, as measured, minus the identity."""
    w = [F.get("w", F.lit(i)) for i in range(components)]
    pairs = [(i, j) for i in range(components) for j in range(i, components)]
    moments = rows.groupBy("dims").agg(
        F.max(F.size("w")).alias("k"),
        *(F.avg(w[i]).alias(f"m{i}") for i in range(components)),
        *(F.avg(w[i] * w[j]).alias(f"p{i}_{j}") for i, j in pairs),
    )
    return {
        r.dims: max((abs(r[f"p{i}_{j}"] - r[f"m{i}"] * r[f"m{j}"] - (i == j)) for i, j in pairs if j < r.k), default=0.0)
        for r in moments.collect()
    }


def whiten(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` per usable row and component.

    Rows whose vector is NULL, empty, or holds NULL, non-finite or immense
    entries are dropped. All others are the fit list and get their values, rows
    with repeated or NULL ids each for itself. Vectors of different lengths
    have nothing in common: each length has a fit of its own. Components
    without variance have no rows, so a table of one vector gives none. Other
    columns are not looked at.
    """
    x = stored(whole_numbers(rows, vec_id, vector), "whole-vectors")
    fits = fit(x, components)
    if not fits:
        return rows.sparkSession.createDataFrame([], RESULT)
    found = stored(project(x, fits), "whitened")
    errors = identity_errors(found, components)
    facts = [(d, [float(v) for v in f.explained], errors[d]) for d, f in fits.items()]
    facts = rows.sparkSession.createDataFrame(facts, "dims int, explained array<double>, identity_error double")
    # One row per length of vectors.
    return (
        found.join(F.broadcast(facts), "dims")
        .select("vec_id", "n", "deviation", "explained", "identity_error", F.posexplode("w").alias("_i", "whitened"))
        .select("vec_id", (F.col("_i") + 1).alias("component"), "n", "deviation", "whitened", F.get("explained", F.col("_i")).alias("explained"), "identity_error")
    )


RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
