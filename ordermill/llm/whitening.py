"""Embedding whitening by Chebyshev-filtered subspace iteration.

Vectors are put on a grid of integers, x = floor(SCALE * c) + OFFSET, so
that equal vectors, counts and sums are exact. The fit list holds each
distinct x once; it is stored in the shared folder and every pass is a
Spark job over it: a task adds up its share of X'XQ (X centred before it is
multiplied, Q a block of a few dozen vectors) and Spark sums the shares cell
by cell, so the driver sees no more than dimension x block numbers.

One cycle: QR and Rayleigh-Ritz of the block (one pass), then a Chebyshev
polynomial of V by its three-term recurrence (one pass a degree). The
polynomial is small on [low, cut] and grows steeply above: cut is the
lowest Ritz value of the block, low starts at 0 and then is a bound from
Lanczos steps whose vector rides along in the passes of the first cycle.
The wanted pairs are certified by their residuals |Vq - eq|: the iteration
ends once these are at the rounding of the arithmetic.

Defined results: rows whose vector is null or holds a null or an entry that
is not finite (or is beyond 2**46, where x has no exact double) are
dropped; so are vectors of another length than the most common one (of
equally common ones the longest), the empty vector among them. Repeated
rows and equal vectors are rows of the result but one of the fit. Components
whose variance is below RANK of the largest are not there (none if there is
one distinct vector), so an empty table gives an empty result. A deviation
beyond a 64-bit integer is null. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.common import map_arrow, stored

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
#: Vectors of the block besides the wanted ones, and the degree of the polynomial.
GUARD, DEGREE = 32, 10
#: Residuals below this share of the largest eigenvalue (times the root of the dimension) are certified ...
CERTIFIED = 1e-14
#: ... and so are those that no longer halve from one cycle to the next and are below this.
FLOOR = 1e-11
#: A variance below this share of the largest counts as none.
RANK = 1e-10
MAX_CYCLES = 200
_LARGEST = float(1 << 46)


def grid(embeddings: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, x) of the rows whose vector is whole, all of one length."""
    whole = F.coalesce(F.forall(vector, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < _LARGEST)), F.lit(False))
    rows = embeddings.select("vec_id", vector).where(whole & (F.size(vector) > 0))
    x = F.transform(vector, lambda c: F.floor(c.cast("double") * float(SCALE)).cast("bigint") + F.lit(OFFSET).cast("bigint"))
    length = rows.groupBy(F.size(vector).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.where(F.size(vector) == (length.d if length else 0)).select("vec_id", x.alias("x"))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


@dataclass
class Center:
    """The exact mean, sums / n, as a whole part and a rest."""

    n: int
    sums: list[int]
    whole: np.ndarray = field(init=False)
    rest: np.ndarray = field(init=False)

    def __post_init__(self):
        self.whole = np.array([s // self.n for s in self.sums], np.int64)
        self.rest = np.array([s % self.n for s in self.sums], np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - sums / n; the subtraction of the whole part is exact."""
        return (x - self.whole) - self.rest / self.n

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - sums)^2, exact."""
        c = x - self.whole
        if c.size == 0:
            return []
        if x.shape[1] * (self.n * (int(np.abs(c).max()) + 1)) ** 2 < 1 << 63:
            return ((self.n * c - self.rest) ** 2).sum(axis=1).tolist()
        wide = ((self.n * c.astype(object) - self.rest.astype(object)) ** 2).sum(axis=1)
        return [int(v) if v < 1 << 63 else None for v in wide]


def _moments(points: DataFrame) -> tuple[int, list[int]]:
    """How many points there are and the exact sum of each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, None
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch)
                high, low = x >> 32, x & 0xFFFFFFFF  # sums of either fit 64 bits
                part = [(int(a) << 32) + int(b) for a, b in zip(high.sum(axis=0), low.sum(axis=0))]
                sums = part if sums is None else [a + b for a, b in zip(sums, part)]
                n += batch.num_rows
        if n:
            values = [Decimal(v) for v in (n, *sums)]
            yield pa.RecordBatch.from_arrays([pa.array(range(-1, len(sums)), pa.int32()), pa.array(values, pa.decimal128(38, 0))], ["cell", "v"])

    found = dict(points.mapInArrow(run, "cell int, v decimal(38,0)").groupBy("cell").agg(F.sum("v")).collect())
    return int(found.pop(-1, 0)), [int(found[i]) for i in sorted(found)]


def _summed(points: DataFrame, center: Center, share: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """The sum over all points of ``share(centred points)``, ``size`` numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = share(center.centred(_matrix(batch)))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], ["cell", "v"])

    out = np.zeros(size)
    found = points.mapInArrow(run, "cell int, v double").groupBy("cell").agg(F.sum("v").alias("v")).toArrow()
    out[found.column("cell").to_numpy()] = found.column("v").to_numpy()
    return out


def _apply(points: DataFrame, center: Center, block: np.ndarray) -> np.ndarray:
    """V times a block: one pass."""
    return _summed(points, center, lambda c: (c.T @ (c @ block)).ravel(), block.size).reshape(block.shape) / center.n


class _Lanczos:
    """Steps of the Lanczos process whose products come with the block's."""

    def __init__(self, start: np.ndarray):
        self.basis, self.diagonal, self.off = [start / np.linalg.norm(start)], [], []

    def step(self, product: np.ndarray) -> None:
        q = self.basis[-1]
        self.diagonal.append(float(q @ product))
        known = np.stack(self.basis)
        w = product - known.T @ (known @ product)
        w -= known.T @ (known @ w)
        self.off.append(float(np.linalg.norm(w)))
        self.basis.append(w / self.off[-1] if self.off[-1] > 0 else np.zeros_like(w))

    def low(self) -> float:
        """A bound below the smallest eigenvalue, as far as the steps tell."""
        m = len(self.diagonal)
        t = np.diag(self.diagonal) + np.diag(self.off[:m - 1], 1) + np.diag(self.off[:m - 1], -1)
        values, vectors = np.linalg.eigh(t)
        return max(0.0, float(values[0] - self.off[-1] * abs(vectors[-1, 0]) - 1e-3 * abs(values[-1])))


def _filter(block: np.ndarray, product: np.ndarray, low: float, cut: float, top: float, degree: int,
            apply: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The Chebyshev polynomial of V on the block, scaled to about 1 at ``top``."""
    half, middle = (cut - low) / 2, (cut + low) / 2
    scale = first = half / (top - middle)
    before, now = block, (product - middle * block) * (first / half)
    for _ in range(degree - 1):
        following = 1 / (2 / first - scale)
        before, now = now, (apply(now) - middle * now) * (2 * following / half) - (scale * following) * before
        scale = following
    return now


@dataclass
class Whitening:
    center: Center
    vectors: np.ndarray  # dimension x components
    values: np.ndarray
    explained: np.ndarray
    identity_error: float
    residual: float  # the largest |Vq - eq| / e1
    passes: int

    @property
    def components(self) -> int:
        return len(self.values)


def _eigenpairs(points: DataFrame, center: Center, components: int, guard: int, degree: int, seed: int):
    d = len(center.sums)
    size, wanted = min(d, components + guard), min(d, components)
    rng = np.random.default_rng(seed)
    block = np.linalg.qr(rng.standard_normal((d, size)))[0]
    lanczos, low, last, passes = _Lanczos(rng.standard_normal(d)), 0.0, np.inf, 0

    def apply(y: np.ndarray, ride: bool = False) -> np.ndarray:
        nonlocal passes
        passes += 1
        if not ride:
            return _apply(points, center, y)
        both = _apply(points, center, np.column_stack([y, lanczos.basis[-1]]))
        lanczos.step(both[:, -1])
        return both[:, :-1]

    for cycle in range(MAX_CYCLES):
        riding = cycle == 0 and size < d
        product = apply(block, riding)
        small = block.T @ product
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        block, product = block @ turn, product @ turn
        top = max(float(values[0]), 0.0)
        k = int((values[:wanted] > RANK * top).sum()) if top > 0 else 0
        if k == 0:
            return block[:, :0], values[:0], 0.0, passes
        residual = float(np.linalg.norm(product[:, :k] - block[:, :k] * values[:k], axis=0).max()) / top
        if residual <= CERTIFIED * np.sqrt(d) or (residual <= FLOOR and residual > last / 2) or size == d:
            return block[:, :k], values[:k], residual, passes
        last = residual
        cut = max(float(values[-1]), low + 1e-6 * top)
        block = np.linalg.qr(_filter(block, product, low, cut, top, degree, lambda y: apply(y, riding)))[0]
        if riding:
            low = min(lanczos.low(), 0.999 * cut)
    raise RuntimeError(f"whitening is not certified after {MAX_CYCLES} cycles: residual {last:.3g} of the largest eigenvalue")


def fit(points: DataFrame, components: int = COMPONENTS, guard: int = GUARD, degree: int = DEGREE, seed: int = 7) -> Whitening | None:
    """Fit on the distinct x of points (vec_id, x as of ``grid``); None if there are none."""
    points = stored(points.select("x").distinct(), "whitening-fit")
    n, sums = _moments(points)
    if not n:
        return None
    center = Center(n, sums)
    vectors, values, residual, passes = _eigenpairs(points, center, components, guard, degree, seed)
    trace = float(_summed(points, center, lambda c: np.array([np.einsum("ij,ij->", c, c)]), 1)[0]) / n
    k = len(values)
    model = Whitening(center, vectors, values, values / trace if k else values, 0.0, residual, passes)
    if k:
        scaled = vectors / np.sqrt(values)

        def second(c: np.ndarray) -> np.ndarray:
            y = c @ scaled
            return np.concatenate([(y.T @ y).ravel(), y.sum(axis=0)])

        found = _summed(points, center, second, k * k + k) / n
        covariance = found[:k * k].reshape(k, k) - np.outer(found[k * k:], found[k * k:])
        model.identity_error = float(np.abs(covariance - np.eye(k)).max())
    return model


def transform(points: DataFrame, model: Whitening) -> DataFrame:
    """One row per row of points (vec_id, x): vec_id, deviation, whitened (one entry for each component)."""
    center, scaled = model.center, model.vectors / np.sqrt(model.values)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = _matrix(batch)
        y = center.centred(x) @ scaled
        at = np.arange(len(y) + 1, dtype=np.int32) * y.shape[1]
        return pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), pa.array(center.deviation(x), pa.int64()), pa.ListArray.from_arrays(pa.array(at), pa.array(y.ravel()))],
            ["vec_id", "deviation", "whitened"])

    kind = points.schema["vec_id"].dataType.simpleString()
    return map_arrow(points, run, f"vec_id {kind}, deviation bigint, whitened array<double>")


def whiten(embeddings: DataFrame, components: int = COMPONENTS, vector: str = "embedding") -> DataFrame:
    """One row per whole vector and component: vec_id, component (from 1, by
    falling variance), n, deviation, whitened, explained, identity_error."""
    points = grid(embeddings, vector)
    model = fit(points, components)
    kind = points.schema["vec_id"].dataType.simpleString()
    if model is None or not model.components:
        return embeddings.sparkSession.createDataFrame(
            [], f"vec_id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double")
    rows = transform(points, model).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    explained = F.array(*[F.lit(float(v)) for v in model.explained])
    return rows.select("vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(model.center.n).cast("bigint").alias("n"),
                       "deviation", "whitened", F.get(explained, F.col("at")).alias("explained"),
                       F.lit(model.identity_error).alias("identity_error"))
