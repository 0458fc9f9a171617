"""Whitening of embeddings by mixed-precision eigenvectors of their covariance.

Vectors become whole numbers, x = floor(64 c) + 1,000,000, so that counts, sums and products
are exact and independent of the order in which tasks end. The covariance is summed up
distributedly from vectors centred at the rounded mean; what is left of the centring is taken
off as an exact fraction. Only tables of the width of a vector, or its square, reach the driver.

The eigenvectors are found there in single precision and corrected by the iteration of Ogita
and Aishima: each round, a few matrix products in higher precision, squares the error. Pairs of
eigenvalues too close for it form clusters; the matrix, shifted and restricted to a cluster, is
solved for itself, where the differences are no longer small against the values.
"""

from __future__ import annotations

from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import ship

#: c becomes floor(SCALE c) + OFFSET.
SCALE, OFFSET = 64, 1_000_000
#: Most components that are returned.
COMPONENTS = 32
#: Eigenvalues under this share of the greatest are noise of rounding: no direction to whiten.
FLOOR = 1e-12
#: Numbers (rows times width) that are multiplied at a time.
BLOCK = 1 << 20
#: Higher precision: 64 bits of mantissa on x86; elsewhere what the platform has.
WIDE = np.longdouble

_MOST = 2**62


def usable(df: DataFrame) -> DataFrame:
    """vec_id and ``c`` (doubles) of the vectors that take part.

    Left out are vectors that are null, empty or hold null or non-finite entries, and those of
    another width than most have (of two equally frequent widths the greater one is taken).
    """
    entries = F.col("embedding")
    finite = ~F.exists(entries, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    fine = df.where(F.col("embedding").isNotNull() & (F.size("embedding") > 0) & F.coalesce(finite, F.lit(False)))
    fine = fine.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("c"))
    widths = fine.groupBy(F.size("c").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    return fine.where(F.size("c") == (widths["width"] if widths else 0))


def _blocks(column: pa.Array, width: int):
    """(first row, x as int64 rows) of a list column, BLOCK numbers at a time."""
    flat = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    step = max(1, BLOCK // width)
    for first in range(0, len(flat), step):
        yield first, np.floor(SCALE * flat[first : first + step]).astype(np.int64) + OFFSET


@dataclass
class Moments:
    """Count, sums, whole number nearest to each mean, and products of x minus these."""

    n: int
    sums: list[int]
    centre: np.ndarray
    products: list[list[int]]

    @property
    def rest(self) -> list[int]:
        """n times (mean - centre), exactly."""
        return [s - self.n * int(m) for s, m in zip(self.sums, self.centre, strict=True)]

    def covariance(self) -> np.ndarray:
        """The covariance with divisor n in higher precision, each entry rounded once or twice."""
        rest, n = self.rest, self.n
        return np.array([[_wide(Fraction(p * n - rest[i] * rest[j], n * n)) for j, p in enumerate(row)] for i, row in enumerate(self.products)], WIDE)


def _wide(value: Fraction):
    """A fraction in higher precision: the nearest double and what it lacks."""
    near = float(value)
    return WIDE(near) + WIDE(float(value - Fraction(near)))


def _sums(batches, width):
    n, total = 0, [0] * width
    for batch in batches:
        for _, x in _blocks(batch.column(0), width):
            n += len(x)
            total = [a + int(b) for a, b in zip(total, x.sum(0), strict=True)]
    yield pa.RecordBatch.from_arrays([pa.array(range(-1, width), pa.int32()), pa.array([n, *total], pa.int64())], ["i", "v"])


def _products(batches, centre):
    """Per task: sums of y_i y_j for j <= i. Doubles hold them exactly while they are small."""
    width = len(centre)
    total = np.zeros((width, width), object)
    for batch in batches:
        for _, x in _blocks(batch.column(0), width):
            y = x - centre
            most = int(np.abs(y).max(initial=0))
            if most * most * len(y) < 2**53:
                d = y.astype(float)
                part = (d.T @ d).astype(np.int64).astype(object)
            else:
                y = y.astype(object)
                part = y.T @ y
            total = total + part
    i, j = np.tril_indices(width)
    values = [str(v) for v in total[i, j]]
    yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(values)], ["i", "j", "v"])


def moments(vectors: DataFrame) -> Moments | None:
    """Exact moments of ``vectors`` (c); nothing if there are none."""
    first = vectors.select(F.size("c").alias("width")).first()
    if first is None:
        return None
    width, only = first["width"], vectors.select("c")
    rows = only.mapInArrow(lambda b: _sums(b, width), "i int, v long").groupBy("i").agg(F.sum(F.col("v").cast("decimal(20,0)")).alias("v"))
    by_place = {r["i"]: int(r["v"]) for r in rows.collect()}
    n, sums = by_place[-1], [by_place[i] for i in range(width)]
    centre = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)
    rows = only.mapInArrow(lambda b: _products(b, centre), "i int, j int, v string").groupBy("i", "j").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v"))
    products = [[0] * width for _ in range(width)]
    for r in rows.collect():
        products[r["i"]][r["j"]] = products[r["j"]][r["i"]] = int(r["v"])
    return Moments(n, sums, centre, products)


def clusters(values: np.ndarray, gap: float) -> list[np.ndarray]:
    """Places of the falling ``values`` that hang together by differences up to ``gap``."""
    cut = np.flatnonzero(values[:-1] - values[1:] > gap) + 1
    return [part for part in np.split(np.arange(len(values)), cut) if len(part) > 1]


def refined(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """One round of Ogita and Aishima: better eigenvectors, eigenvalues, and the distance under
    which two eigenvalues were too close to be told apart in this round."""
    r = np.eye(len(a), dtype=a.dtype) - x.T @ x
    s = x.T @ (a @ x)
    # Symmetric to the last digit: what differs would come back divided by small gaps.
    r, s = (r + r.T) / 2, (s + s.T) / 2
    values = np.diag(s) / (1 - np.diag(r))
    off = s - np.diag(values)
    # Frobenius norms bound the spectral ones.
    gap = float(2 * (np.sqrt((off * off).sum()) + np.sqrt((a * a).sum()) * np.sqrt((r * r).sum())))
    apart = values[None, :] - values[:, None]
    far = np.abs(apart) > gap
    e = np.where(far, (s + values[None, :] * r) / np.where(far, apart, 1), r / 2)
    np.fill_diagonal(e, np.diag(r) / 2)
    return x + x @ e, values, gap


def eigenvectors(a: np.ndarray, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Falling eigenvalues of a symmetric matrix and their unit eigenvectors, in columns.

    Starts in single precision. In each round the eigenvalues that the iteration could not tell
    apart are solved in their own small space, shifted to their middle; equal eigenvalues stay
    with any basis of their space. The rounds end when they change no more than rounding does.
    What remains is the rounding of the matrix over the gap: eigenvalues that differ by a share g
    of the greatest have eigenvectors right to about 1e-19 / g.
    """
    a = np.asarray(a, WIDE)
    size = np.abs(a).max(initial=0) or WIDE(1)
    a = a / size
    _, x = np.linalg.eigh(a.astype(np.float32))
    x = x[:, ::-1].astype(WIDE)
    tiny, before = float(np.finfo(WIDE).eps) * len(a), float("inf")
    for _ in range(rounds):
        new, values, gap = refined(a, x)
        order = np.argsort(-values, kind="stable")
        new, values = new[:, order], values[order]
        change = float(np.abs(new - x[:, order]).max(initial=0))
        x = new
        groups = clusters(values, max(gap, tiny))
        for group in groups:
            # In the subspace, made orthogonal to working precision first.
            part = x[:, group]
            part = part @ (WIDE(1.5) * np.eye(len(group), dtype=WIDE) - (part.T @ part) / 2)
            middle = values[group].mean()
            inner = part.T @ (a @ part) - middle * (part.T @ part)
            inner = (inner + inner.T) / 2
            scale = np.abs(inner).max()
            if scale > tiny:
                _, turn = np.linalg.eigh((inner / scale).astype(float))
                x[:, group] = part @ turn[:, ::-1].astype(WIDE)
        if not groups and (change < 8 * tiny or before < 1e-3 and change > before / 4):
            break
        before = float("inf") if groups else change
    x = x / np.sqrt((x * x).sum(0))
    values = (x * (a @ x)).sum(0)
    order = np.argsort(-values, kind="stable")
    return values[order] * size, x[:, order]


def _centred(x, found):
    """x minus the mean, in doubles: the whole part is exact before the fraction comes off."""
    return (x - found.centre).astype(float) - np.array([float(Fraction(r, found.n)) for r in found.rest])


def _deviations(x, found) -> list[int]:
    """Sum over dimensions of (n x - S) squared, exactly."""
    y, rest, n = x - found.centre, found.rest, found.n
    most = n * int(np.abs(y).max(initial=0)) + max(map(abs, rest), default=0)
    if most * most * len(rest) < _MOST:
        d = n * y - np.array(rest, np.int64)
        return (d * d).sum(1).tolist()
    return [sum((n * int(v) - r) ** 2 for v, r in zip(row, rest, strict=True)) for row in y]


def _checked(batches, found, directions):
    """Per task: sums and products of the whitened values."""
    width = directions.shape[1]
    total, products = np.zeros(width), np.zeros((width, width))
    for batch in batches:
        for _, x in _blocks(batch.column(0), len(found.sums)):
            z = _centred(x, found) @ directions
            total += z.sum(0)
            products += z.T @ z
    i, j = (a.ravel() for a in np.indices((width + 1, width)))
    values = np.concatenate([products, total[None]]).ravel()
    yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(values)], ["i", "j", "v"])


def identity_error(vectors: DataFrame, found: Moments, directions: np.ndarray) -> float:
    """Largest entry of the whitened values' covariance minus the identity, measured on all rows."""
    width = directions.shape[1]
    rows = vectors.select("c").mapInArrow(lambda b: _checked(b, found, directions), "i int, j int, v double")
    table = np.zeros((width + 1, width))
    for r in rows.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        table[r["i"], r["j"]] = r["v"]
    mean = table[width] / found.n
    return float(np.abs(table[:width] / found.n - np.outer(mean, mean) - np.eye(width)).max())


SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whitened(df: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Whitened components of ``df`` (vec_id, embedding), a row per vector and component.

    Returns vec_id, component (from 1, by falling eigenvalue), n, deviation, whitened,
    explained, identity_error. Vectors that cannot take part (see ``usable``) are left out;
    all others are fitted and returned. ``deviation`` is exact; one that does not fit into a
    long is an error, not a wrong number, and so is an entry beyond 2**56.

    Directions in which the vectors do not vary have no whitened values, so there are fewer
    components than asked for where the rank is lower, and no rows if all vectors are equal or
    there are none. Components of equal eigenvalues are any basis of their space. Repeated rows
    count as often as they stand there; a null vec_id is kept. Other columns are ignored.
    """
    spark = df.sparkSession
    ship(spark)
    vectors = usable(df)
    found = moments(vectors)
    if found is None:
        return spark.createDataFrame([], SCHEMA)
    covariance = found.covariance()
    values, basis = eigenvectors(covariance)
    kept = int((values > FLOOR * max(values[0], 0)).sum()) if values[0] > 0 else 0
    kept = min(components, kept)
    if not kept:
        return spark.createDataFrame([], SCHEMA)
    directions = (basis[:, :kept] / np.sqrt(values[:kept])).astype(float)
    explained = (values[:kept] / np.trace(covariance)).astype(float)
    error = identity_error(vectors, found, directions)
    width, names = len(found.sums), [part.split()[0] for part in SCHEMA.split(", ")]

    def rows(batches):
        for batch in batches:
            for first, x in _blocks(batch.column(1), width):
                count = len(x)
                z = _centred(x, found) @ directions
                ids = batch.column(0)[first : first + count].take(pa.array(np.repeat(np.arange(count), kept)))
                deviation = np.repeat(np.array(_deviations(x, found), object), kept)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids, pa.array(np.tile(np.arange(1, kept + 1), count), pa.int32()), pa.array(np.full(count * kept, found.n)),
                        pa.array(deviation.tolist(), pa.int64()), pa.array(z.ravel()), pa.array(np.tile(explained, count)),
                        pa.array(np.full(count * kept, error)),
                    ],
                    names,
                )

    return vectors.mapInArrow(rows, SCHEMA)
