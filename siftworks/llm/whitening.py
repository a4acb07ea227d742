"""Embedding whitening by Chebyshev-filtered subspace iteration.

The leading eigenvectors of the covariance V of whole-number vectors.  A block of
directions is filtered: a Chebyshev polynomial in V, evaluated by its three-term
recurrence, damps what lies between 0 and the smallest Ritz value of the block.  QR and
Rayleigh-Ritz follow; where a direction would be blown up beyond all others, those that have
converged are locked and kept out of the filter.  This goes on until the residuals
|V q - e q| of the wanted directions certify them to rounding error.  V is never formed:
each step is one pass over the stored rows that sums X'(X Q) of the centred rows, one small
matrix per task, added up by a second level of tasks before the driver sees at most
``FAN_IN`` of them.

Entries are floor(scale * c) + offset as whole numbers; sums are exact, and a row is
centred as (x - floor(mean)) - fraction, so nothing is lost to the size of the mean.

Defined cases: rows whose vector is null or holds null or non-finite entries take no
part, nor do rows whose vector has another length than most (of equally many, the
longer one); a missing id stays a missing id and repeated rows count each time;
directions whose eigenvalue is nothing but rounding (1e-12 of the trace) are left out,
so equal rows, a single row or no rows give no components; fewer dimensions than
components give as many as there are; equal eigenvalues give some orthonormal basis of
their space.  Entries beyond 2^43 after scaling raise an error.  ``deviation`` is exact;
where it passes a long it is null and ``deviation_wide`` has it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftworks.llm.frames import stored

COMPONENTS = 8
SCALE = 1024
OFFSET = 100_000
# Directions beyond the wanted ones that are carried along.
GUARDS = 16
MAX_DEGREE = 30
MAX_ROUNDS = 100
# Residuals relative to the largest eigenvalue: what is accepted when rounds stop helping,
# and what ends the search at once.
CERTIFIED = 1e-11
EXACT = 2e-15
# From here on a direction is locked.
LOCKED = 1e-14
# Matrices that are sent to the driver at once.
FAN_IN = 32
LARGEST = 1 << 43


@dataclass
class Whitener:
    """A fitted model: everything a task needs to whiten a row."""

    n: int
    floor_mean: np.ndarray  # long: floor(S / n)
    rest: np.ndarray  # long: S - n * floor(S / n)
    components: np.ndarray  # (dimensions, components)
    eigenvalues: np.ndarray
    trace: float
    residuals: np.ndarray
    passes: int

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.floor_mean) - self.rest / max(self.n, 1)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return (self.centred(x) @ self.components) / np.sqrt(self.eigenvalues)

    def deviations(self, x: np.ndarray) -> list[int]:
        """Exact sums of (n x - S)^2 of each row."""
        from_floor = x - self.floor_mean
        estimate = (((self.n * from_floor.astype(np.float64)) - self.rest) ** 2).sum(axis=1)
        with np.errstate(over="ignore"):
            # Arithmetic modulo 2^64 is exact for results that fit.
            v = from_floor * np.int64(self.n) - self.rest
            out = (v * v).sum(axis=1).tolist()
        for i in np.flatnonzero(estimate > 2.0**62).tolist():
            out[i] = sum((self.n * a - b) ** 2 for a, b in zip(from_floor[i].tolist(), self.rest.tolist(), strict=True))
        return out


def usable(rows: DataFrame, scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """(vec_id, x): the finite vectors of the common length as whole numbers, stored."""
    finite = F.forall(
        "embedding",
        lambda c: F.coalesce(~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")), F.lit(False)),
    )
    small = F.forall("embedding", lambda c: F.abs(scale * c.cast("double")) < float(LARGEST))
    error = F.raise_error(F.lit("an entry is too large to be scaled exactly"))
    x = F.transform("embedding", lambda c: F.floor(scale * c.cast("double")).cast("long") + offset)
    fine = stored(
        rows.filter(F.col("embedding").isNotNull() & finite).select(
            "vec_id", F.when(small, x).otherwise(error.cast("array<bigint>")).alias("x")
        ),
        "whitening-rows",
    )
    lengths = fine.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    common = lengths.orderBy(F.desc("n"), F.desc("d")).first()
    return fine if common is None else fine.filter(F.size("x") == common["d"])


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Each batch with its vectors as rows of a matrix of longs."""
    for batch in batches:
        if batch.num_rows:
            lists = batch.column(batch.schema.get_field_index("x"))
            yield batch, lists.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _sums(fine: DataFrame) -> tuple[int, list[int]]:
    """Exact number of rows and sum of each dimension."""

    def partial(batches):
        n, total = 0, None
        for _, x in _matrices(batches):
            part = x.sum(axis=0).tolist()
            total = part if total is None else [a + b for a, b in zip(total, part, strict=True)]
            n += len(x)
        if n:
            values = pa.array([str(v) for v in [n, *total]])
            yield pa.RecordBatch.from_arrays([pa.array(range(-1, len(total)), pa.int32()), values], names=["dim", "part"])

    parts = fine.select("x").mapInArrow(partial, "dim int, part string")
    added = parts.groupBy("dim").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total")).collect()
    by_dim = {r["dim"]: int(r["total"]) for r in added}
    n = by_dim.pop(-1, 0)
    return n, [by_dim[i] for i in range(len(by_dim))]


def _added(parts: DataFrame, size: int, many: bool) -> np.ndarray:
    """The sum of binary rows of ``size`` doubles, by a level of tasks if there are many."""

    def add(batches):
        total = np.zeros(size)
        for batch in batches:
            for value in batch.column(0):
                total += np.frombuffer(value.as_buffer(), np.float64)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["part"])

    if many:
        parts = parts.repartition(FAN_IN).mapInArrow(add, "part binary")
    total = np.zeros(size)
    for row in parts.collect():
        total += np.frombuffer(row["part"], np.float64)
    return total


class _Covariance:
    """V times a block of directions, as passes over the rows."""

    def __init__(self, fine: DataFrame, n: int, sums: list[int]):
        self.rows, self.n, self.passes = fine.select("x"), n, 0
        self.floor_mean = np.array([s // n for s in sums], np.int64)
        self.rest = np.array([s - n * (s // n) for s in sums], np.int64)
        self.many = fine.rdd.getNumPartitions() > FAN_IN
        self.trace = 0.0

    def times(self, q: np.ndarray) -> np.ndarray:
        floor_mean, fraction, shape = self.floor_mean, self.rest / self.n, q.shape

        def partial(batches):
            total, squares, seen = np.zeros(shape), 0.0, False
            for _, x in _matrices(batches):
                c = (x - floor_mean) - fraction
                total += c.T @ (c @ q)
                squares += float((c * c).sum())
                seen = True
            if seen:
                out = np.append(total.ravel(), squares).tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([out], pa.binary())], names=["part"])

        total = _added(self.rows.mapInArrow(partial, "part binary"), q.size + 1, self.many)
        self.passes += 1
        self.trace = float(total[-1]) / self.n
        return total[:-1].reshape(shape) / self.n


def _degree(top: float, last: float, bound: float) -> tuple[int, bool]:
    """Of the filter: enough to help the last wanted direction, not so much that the top one
    swamps the others; and whether it is the latter that decides."""
    half = max(bound / 2, 1e-300)
    grows = [float(np.arccosh(max(e / half - 1.0, 1.0 + 1e-12))) for e in (top, last)]
    helps = 18.0 / max(grows[1], 1e-6)
    swamps = 18.0 / max(grows[0] - grows[1], 1e-6)
    return int(max(2, min(MAX_DEGREE, helps, swamps))), swamps < min(MAX_DEGREE, helps)


def _filtered(
    v: _Covariance, locked: np.ndarray, q: np.ndarray, vq: np.ndarray, top: float, bound: float, degree: int
) -> np.ndarray:
    """The Chebyshev polynomial of the degree in V on q, scaled to 1 at ``top``.

    ``vq`` is V q, known from the Rayleigh-Ritz step.
    """

    def free(y: np.ndarray) -> np.ndarray:
        return y - locked @ (locked.T @ y)

    half = centre = bound / 2
    sigma = first = half / (top - centre)
    before, now = q, free((vq - centre * q) * (sigma / half))
    for _ in range(1, degree):
        following = 1.0 / (2.0 / first - sigma)
        after = 2.0 * (following / half) * (v.times(now) - centre * now) - (sigma * following) * before
        before, now, sigma = now, free(after), following
    now = now / np.maximum(np.linalg.norm(now, axis=0), 1e-300)
    return free(now)


def fit(fine: DataFrame, k: int = COMPONENTS, seed: int = 7) -> Whitener:
    """The leading components of the rows of ``usable``, certified by their residuals."""
    n, sums = _sums(fine)
    d = len(sums)
    if not n or not d:
        none = np.zeros(d, np.int64)
        return Whitener(n, none, none, np.zeros((d, 0)), np.zeros(0), 0.0, np.zeros(0), 0)
    v = _Covariance(fine, n, sums)
    wanted, block = min(k, d), min(d, k + GUARDS)
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, block)))[0]
    best, stalled, fixed = np.inf, 0, 0
    for _ in range(MAX_ROUNDS):
        vq = v.times(q)
        h = q.T @ vq
        ritz, turn = np.linalg.eigh((h + h.T) / 2)
        ritz, turn = np.maximum(ritz[::-1], 0.0), turn[:, ::-1]
        q, vq = q @ turn, vq @ turn
        residuals = np.linalg.norm(vq - q * ritz, axis=0)
        if v.trace <= 0.0 or ritz[0] <= 0.0:
            break
        worst = float(residuals[fixed:wanted].max() / ritz[0])
        stalled = stalled + 1 if worst > best / 2 else 0
        best = min(best, worst)
        if worst <= EXACT or block == d or (best <= CERTIFIED and stalled >= 2):
            break
        # What is wanted lies above the smallest Ritz value; so does all that is carried.
        bound = max(float(ritz[-1]), 1e-14 * float(ritz[0]))
        if ritz[fixed] <= bound * (1 + 1e-14):
            break  # one eigenvalue only: any directions will do
        degree, swamped = _degree(float(ritz[fixed]), float(ritz[wanted - 1]), bound)
        if swamped:
            converged = residuals[: wanted - 1] <= LOCKED * ritz[0]
            fixed = max(fixed, int(np.argmin(np.append(converged, False))))
            degree, _ = _degree(float(ritz[fixed]), float(ritz[wanted - 1]), bound)
        top = float(ritz[fixed])
        y = _filtered(v, q[:, :fixed], q[:, fixed:], vq[:, fixed:], top, bound, degree)
        q = np.linalg.qr(np.hstack([q[:, :fixed], y]))[0]
    else:
        if best > CERTIFIED:
            raise RuntimeError(f"residual {best:.1e} after {MAX_ROUNDS} rounds: components are not certified")
    keep = np.flatnonzero(ritz[:wanted] > 1e-12 * max(v.trace, 0.0))
    keep = keep if v.trace > 0 else keep[:0]
    return Whitener(n, v.floor_mean, v.rest, q[:, keep], ritz[keep], v.trace, residuals[keep], v.passes)


def whitened(fine: DataFrame, model: Whitener) -> DataFrame:
    """(vec_id, x, whitened): each row's coordinates along the components."""
    schema = "vec_id long, deviation decimal(38,0), whitened array<double>"

    def project(batches):
        for batch, x in _matrices(batches):
            w = model.whitened(x)
            ends = pa.array(np.arange(len(x) + 1) * w.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(batch.schema.get_field_index("vec_id")),
                    pa.array(model.deviations(x), pa.decimal128(38, 0)),
                    pa.ListArray.from_arrays(ends, pa.array(w.ravel())),
                ],
                names=["vec_id", "deviation", "whitened"],
            )

    return fine.select("vec_id", "x").mapInArrow(project, schema)


def identity_error(fine: DataFrame, model: Whitener) -> float:
    """Largest entry of the covariance of the whitened rows minus the identity."""
    k = len(model.eigenvalues)
    if not k:
        return 0.0

    def partial(batches):
        total = np.zeros((k + 1, k))
        for _, x in _matrices(batches):
            w = model.whitened(x)
            total[:k] += w.T @ w
            total[k] += w.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["part"])

    parts = fine.select("x").mapInArrow(partial, "part binary")
    total = _added(parts, (k + 1) * k, fine.rdd.getNumPartitions() > FAN_IN).reshape(k + 1, k) / model.n
    return float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max())


def whitening_digest(embeddings: DataFrame) -> DataFrame:
    fine = usable(embeddings.select("vec_id", "embedding"))
    model = fit(fine)
    error = identity_error(fine, model)
    shares = F.array(*[F.lit(float(e / model.trace)) for e in model.eigenvalues]).cast("array<double>")
    return whitened(fine, model).select(
        "vec_id",
        "deviation",
        F.posexplode("whitened").alias("at", "value"),
    ).select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        F.col("deviation").try_cast("long").alias("deviation"),
        F.col("value").alias("whitened"),
        F.get(shares, F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"),
        F.col("deviation").alias("deviation_wide"),
    )
