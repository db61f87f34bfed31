"""Whitening of vectors by their leading principal components, found by spectrum slicing.

Entries become whole numbers, so that sums and products of the fit list are exact whatever the order of tasks, and the
covariance is rounded once per entry. Tasks send sums of their rows, which are added up in a shuffle; the driver gets
one covariance (the square of the dimension, however many rows there are) for each length of vector.

Spectrum slicing (``leading``): the signs of D in L D L' of the covariance less a shift count its eigenvalues above the
shift (Sylvester). Bisection by these counts goes on until an interval holds one eigenvalue, Rayleigh quotient iteration then
converges cubically, and two more counts around the result certify that it is the one with that number. Eigenvalues
that bisection cannot part are found as a group by inverse iteration of a block and parted inside its span.

Odd input: rows whose vector is null or holds a null or non-finite entry (or one whose whole number no long can hold) are
dropped. Vectors of different lengths are whitened apart, each length with its own fit. Repeated rows are all returned, the fit has each vector once.
An empty vector and components without variance give no rows. An extra column cannot clash: only id and vector are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusforge.llm.storage import stored
from corpusforge.llm.wordarrays import tidy

EPS = float(np.finfo(float).eps)
EXACT = float(1 << 53)  # whole numbers up to here are exact as doubles
LIMB = 32
LARGEST = 1e17  # entries beyond have no whole number in a long

# --- eigenvalues by slices of the spectrum ------------------------------------------------------


def above(a: np.ndarray, shift: float) -> int:
    """Number of eigenvalues of the symmetric ``a`` above ``shift``: positive ones in D of L D L' (Bunch and Kaufman)."""
    m = a - shift * np.eye(len(a))
    tiny = EPS * max(float(np.abs(a).max(initial=0.0)), abs(shift)) + np.finfo(float).tiny
    ratio = (1 + 17**0.5) / 8
    positive = 0
    while len(m):
        n = len(m)
        first = abs(m[0, 0])
        r = 1 + int(np.argmax(np.abs(m[1:, 0]))) if n > 1 else 0
        low = abs(m[r, 0]) if r else 0.0
        single = True
        if max(first, low) <= tiny:
            m = m[1:, 1:]  # a zero pivot: the shift is an eigenvalue, which is not above it
            continue
        if first < ratio * low:
            others = np.abs(m[r])
            others[r] = 0
            row = float(others.max())
            if first * row >= ratio * low * low:
                pass
            elif abs(m[r, r]) >= ratio * row:
                _swap(m, 0, r)
            else:
                single = False
                _swap(m, 1, r)
        if single:
            positive += m[0, 0] > 0
            column = m[1:, 0]
            m = m[1:, 1:] - np.outer(column, column / m[0, 0])
        else:
            block, columns = m[:2, :2], m[2:, :2]
            positive += 1  # such a block has one eigenvalue of either sign
            m = m[2:, 2:] - columns @ np.linalg.solve(block, columns.T)
    return int(positive)


def _swap(m: np.ndarray, i: int, j: int) -> None:
    m[[i, j]] = m[[j, i]]
    m[:, [i, j]] = m[:, [j, i]]


def _solve(a: np.ndarray, shift: float, x: np.ndarray, scale: float) -> np.ndarray:
    """Solution of ``(a - shift) y = x``; a shift that hits an eigenvalue is moved by a rounding error."""
    for step in (0, 1, 2, 4, 8):
        try:
            y = np.linalg.solve(a - (shift + step * EPS * scale) * np.eye(len(a)), x)
        except np.linalg.LinAlgError:
            continue
        if np.isfinite(y).all():
            return y
    raise ArithmeticError("no shift near the eigenvalue can be solved for")


class _Spectrum:
    """Counts above the shifts tried so far; each narrows the intervals of all eigenvalues."""

    def __init__(self, a: np.ndarray):
        self.a = a
        self.scale = float(np.abs(a).sum(axis=1).max())  # no eigenvalue is larger
        edge = self.scale * (1 + 8 * EPS) + np.finfo(float).tiny
        self.counts = {-edge: len(a), edge: 0}

    def count(self, shift: float) -> int:
        if shift not in self.counts:
            self.counts[shift] = above(self.a, shift)
        return self.counts[shift]

    def bracket(self, j: int) -> tuple[float, float]:
        """Nearest shifts around eigenvalue ``j``, from 1 downwards."""
        return max(s for s, c in self.counts.items() if c >= j), min(s for s, c in self.counts.items() if c < j)

    def isolate(self, j: int, width: float) -> tuple[float, float, int, int]:
        """(low, high, number of the first eigenvalue between, and of the last): one, or more within ``width``."""
        while True:
            low, high = self.bracket(j)
            first, last = self.count(high) + 1, self.count(low)
            middle = (low + high) / 2
            if first == last or high - low <= width or not low < middle < high:
                return low, high, first, last
            self.count(middle)


def leading(a: np.ndarray, k: int, apart: float = 1e-8) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of the symmetric ``a``, falling, and unit eigenvectors as columns.

    ``apart``: eigenvalues closer than this share of the largest are found as one group, and then inside its span.
    """
    n = len(a)
    k = min(k, n)
    values, vectors = np.zeros(k), np.zeros((n, k))
    spectrum = _Spectrum(a)
    if spectrum.scale == 0:
        return values, np.eye(n)[:, :k]
    j = 1
    while j <= k:
        low, high, first, last = spectrum.isolate(j, apart * spectrum.scale)
        if first == last:
            value, vector = _quotient_iteration(spectrum, j)
            values[j - 1], vectors[:, j - 1] = value, vector
        else:
            group = _group(spectrum, (low + high) / 2, last - first + 1)
            inner = group.T @ (a @ group) - (low + high) / 2 * np.eye(group.shape[1])
            if np.abs(inner).max() > 64 * EPS * spectrum.scale:  # below, the group is one eigenvalue and any basis serves
                _, turn = leading((inner + inner.T) / 2, group.shape[1], apart)
                group = group @ np.linalg.qr(turn)[0]
            for at in range(first, min(last, k) + 1):
                vector = group[:, at - first]
                values[at - 1], vectors[:, at - 1] = vector @ (a @ vector), vector
        j = last + 1
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(k)])
    return values, vectors * np.where(signs == 0, 1, signs)


def _quotient_iteration(spectrum: _Spectrum, j: int) -> tuple[float, np.ndarray]:
    """Eigenvalue ``j``, alone in its bracket, by Rayleigh quotients; counts around it certify the number."""
    a, scale = spectrum.a, spectrum.scale
    enough = 16 * EPS * scale * len(a) ** 0.5
    while True:
        low, high = spectrum.bracket(j)
        shift = (low + high) / 2
        x = np.random.default_rng(j).standard_normal(len(a))
        for step in range(12):
            x = _solve(a, shift, x, scale)
            x /= np.linalg.norm(x)
            image = a @ x
            value = float(x @ image)
            error = float(np.linalg.norm(image - value * x))
            if error <= enough:
                # one more solve at the found value leaves only rounding
                x = _solve(a, value, x, scale)
                x /= np.linalg.norm(x)
                value = float(x @ (a @ x))
                if above(a, value - 4 * enough) >= j and above(a, value + 4 * enough) < j:
                    return value, x
                break
            if step and low < value < high:
                shift = value  # the first step stays where the count has put it
        middle = (low + high) / 2
        if not low < middle < high:
            return value, x
        spectrum.count(middle)  # led astray by a neighbour: start again from a narrower bracket


def _group(spectrum: _Spectrum, shift: float, size: int) -> np.ndarray:
    """Orthonormal basis of the ``size`` eigenvectors next to ``shift``."""
    basis = np.random.default_rng(size).standard_normal((len(spectrum.a), size))
    for _ in range(4):
        basis, _ = np.linalg.qr(_solve(spectrum.a, shift, basis, spectrum.scale))
    return basis


# --- exact sums ---------------------------------------------------------------------------------


def exact_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a' b`` of whole numbers as Python integers: in doubles where they are exact, else in parts for which they are."""
    if not a.size or not b.size:
        return np.zeros((a.shape[1], b.shape[1]), object)
    tops = [max(abs(int(x.max())), abs(int(x.min()))) for x in (a, b)]
    if tops[0] * tops[1] * len(a) < EXACT:
        return (a.T.astype(float) @ b.astype(float)).astype(np.int64).astype(object)
    if tops[0] * tops[1] * 2 < EXACT:
        half = len(a) // 2
        return exact_product(a[:half], b[:half]) + exact_product(a[half:], b[half:])
    if tops[0] < tops[1]:
        return exact_product(b, a).T
    return exact_product(a >> 24, b) * (1 << 24) + exact_product(a & ((1 << 24) - 1), b)


def _matrices(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    """Vectors of a batch by their length, each as a matrix."""
    column = batch.column("x")
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    for length in np.unique(lengths):
        rows = column.filter(pa.array(lengths == length))
        yield rows.flatten().to_numpy().reshape(-1, length)


SUMS = "dim int, row int, high array<long>, low array<long>"
_SUMS = pa.schema([("dim", pa.int32()), ("row", pa.int32()), ("high", pa.list_(pa.int64())), ("low", pa.list_(pa.int64()))])


def _sum_rows(totals: dict[tuple[int, int], np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Integers as two limbs, which tasks can add up without overflow."""
    for (dim, row), numbers in totals.items():
        limbs = [(numbers >> LIMB).astype(np.int64).tolist()], [(numbers & ((1 << LIMB) - 1)).astype(np.int64).tolist()]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(([dim], [row], *limbs), _SUMS, strict=True)], schema=_SUMS)


@tidy
def _vector_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number of vectors and their sums per dimension."""
    totals: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        for x in _matrices(batch):
            ones = np.ones((len(x), 1), np.int64)
            sums = exact_product(np.hstack([ones, x]), ones)[:, 0]
            totals[x.shape[1], -1] = totals.get((x.shape[1], -1), 0) + sums
    yield from _sum_rows(totals)


@tidy
def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of what the tasks have sent, row by row of each matrix; memory is that of the rows dealt to this task."""
    totals: dict[tuple[int, int], list[np.ndarray]] = {}
    for batch in batches:
        for dim, row, high, low in zip(*(batch.column(c) for c in _SUMS.names), strict=True):
            limbs = [np.array(c.values.to_numpy(), np.int64) for c in (high, low)]
            known = totals.setdefault((dim.as_py(), row.as_py()), [np.zeros_like(c) for c in limbs])
            for total, limb in zip(known, limbs, strict=True):
                total += limb
    for key, (high, low) in totals.items():
        yield from _sum_rows({key: high.astype(object) * (1 << LIMB) + low.astype(object)})


def _collected(partial: DataFrame) -> dict[tuple[int, int], np.ndarray]:
    """Added sums on the driver: one row per row of the upper triangle, whatever the number of vectors."""
    table = partial.repartition("dim", "row").mapInArrow(_added, SUMS).toArrow()
    columns = (table.column(c).to_pylist() for c in _SUMS.names)
    return {
        (dim, row): np.array(high, dtype=object) * (1 << LIMB) + np.array(low, dtype=object)
        for dim, row, high, low in zip(*columns, strict=True)
    }


# --- the model ----------------------------------------------------------------------------------


@dataclass(frozen=True)
class Model:
    """Fit of all vectors of one length."""

    n: int
    sums: list[int]  # exact
    values: np.ndarray  # eigenvalues, falling
    vectors: np.ndarray  # components as columns
    explained: np.ndarray

    @property
    def centre(self) -> np.ndarray:
        """Means, rounded to whole numbers: vectors less these are small and exact."""
        return np.array([_rounded(s, self.n) for s in self.sums], np.int64)

    @property
    def rest(self) -> list[int]:
        """``sums - n * centre``: at most half of ``n`` each."""
        return [s - self.n * int(c) for s, c in zip(self.sums, self.centre, strict=True)]

    def whitened(self, x: np.ndarray) -> np.ndarray:
        means = np.array([r / self.n for r in self.rest])
        return ((x - self.centre).astype(float) - means) @ self.vectors / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum over dimensions of ``(n x - sums)**2``, exact."""
        z = x - self.centre
        top = max(abs(int(z.max(initial=0))), abs(int(z.min(initial=0))))
        rest, n = self.rest, self.n
        if top * max(top, n) * x.shape[1] < 1 << 62:
            squares, crossed = (z * z).sum(axis=1).tolist(), (z @ np.array(rest, np.int64)).tolist()
        else:
            wide = z.astype(object)
            squares, crossed = (wide * wide).sum(axis=1).tolist(), (wide @ np.array(rest, object)).tolist()
        constant = sum(r * r for r in rest)
        return [n * n * s - 2 * n * c + constant for s, c in zip(squares, crossed, strict=True)]


def _rounded(total: int, n: int) -> int:
    return (2 * total + n) // (2 * n)


def fit(distinct: DataFrame, components: int) -> dict[int, Model]:
    """A model for each length of the vectors ``x`` of ``distinct``, from two passes: sums, then centred products."""
    sums = {dim: (int(row[0]), [int(s) for s in row[1:]]) for (dim, _), row in _collected(distinct.mapInArrow(_vector_sums, SUMS)).items()}
    centres = {dim: np.array([_rounded(s, n) for s in row], np.int64) for dim, (n, row) in sums.items()}

    @tidy
    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for x in _matrices(batch):
                dim = x.shape[1]
                z = x - centres[dim]
                totals[dim] = totals.get(dim, 0) + exact_product(z, z)
        for dim, gram in totals.items():
            yield from _sum_rows({(dim, row): gram[row, row:] for row in range(dim)})

    grams = _collected(distinct.mapInArrow(products, SUMS))
    models = {}
    for dim, (n, row) in sums.items():
        rest = [s - n * int(c) for s, c in zip(row, centres[dim], strict=True)]
        cov = np.zeros((dim, dim))
        for i in range(dim):
            # whole numbers up to the division, which rounds once
            cov[i, i:] = cov[i:, i] = [(n * int(g) - rest[i] * t) / (n * n) for g, t in zip(grams[dim, i], rest[i:], strict=True)]
        values, vectors = leading(cov, components)
        trace = float(np.trace(cov))
        some = values > 4 * dim * EPS * max(trace, 0.0)
        values, vectors = values[some], vectors[:, some]
        models[dim] = Model(n, row, values, vectors, values / trace if len(values) else values)
    return models


def identity_errors(distinct: DataFrame, models: dict[int, Model]) -> dict[int, float]:
    """By length: the largest absolute entry of the covariance of the whitened fit list less the identity."""

    @tidy
    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for x in _matrices(batch):
                w = models[x.shape[1]].whitened(x)
                w = np.hstack([np.ones((len(w), 1)), w])
                totals[x.shape[1]] = totals.get(x.shape[1], 0) + w.T @ w
        for dim, total in totals.items():
            i, j = np.triu_indices(len(total))
            columns = [[dim] * len(i), i, j, total[i, j]]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, wire, strict=True)], schema=wire)

    wire = pa.schema([("dim", pa.int32()), ("i", pa.int32()), ("j", pa.int32()), ("total", pa.float64())])
    added = distinct.mapInArrow(products, "dim int, i int, j int, total double").groupBy("dim", "i", "j").agg(F.sum("total").alias("total"))
    errors = dict.fromkeys(models, 0.0)
    found = {(r["dim"], r["i"], r["j"]): r["total"] for r in added.toLocalIterator()}
    for (dim, i, j), total in found.items():
        if i:  # row 0 holds the sums; the whitened list has means of rounding size, which still come off
            n = models[dim].n
            entry = total / n - found[dim, 0, i] / n * (found[dim, 0, j] / n)
            errors[dim] = max(errors[dim], abs(entry - (i == j)))
    return errors


def whiten(
    df: DataFrame, components: int = 16, scale: int = 64, shift: int = 1_000_000, id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """One row per vector and component: ``(vec_id, component, n, deviation, whitened, explained, identity_error)``.

    Entries c become ``floor(scale * c) + shift``. ``n``: distinct vectors in the fit; ``deviation``: sum over dimensions of
    (n x - sum)**2 as decimal, exact; ``whitened``: the centred vector along the component over the root of its variance;
    ``explained``: that variance's share of the trace.
    """
    sound = F.forall(vector, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < LARGEST / scale * 64))
    x = F.transform(vector, lambda c: F.floor(c.cast("double") * scale).cast("long") + F.lit(shift))
    rows = df.filter(F.col(vector).isNotNull() & (F.size(vector) > 0) & sound).select(F.col(id).alias("vec_id"), x.alias("x"))
    distinct = stored(rows.select("x").distinct(), "fit-list")
    models = fit(distinct, components)
    errors = identity_errors(distinct, models)
    out = f"{rows.select('vec_id').schema.simpleString()[7:-1]}, component int, n long, deviation string, whitened double, explained double, identity_error double"

    @tidy
    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("x")
            lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False)
            for dim in np.unique(lengths):
                model, at = models[int(dim)], np.flatnonzero(lengths == dim)
                x = column.take(pa.array(at)).flatten().to_numpy().reshape(-1, dim)
                k = len(model.values)
                whitened = model.whitened(x)
                numbers = pa.array(np.repeat(np.arange(len(at)), k))
                columns = [
                    batch.column("vec_id").take(pa.array(at)).take(numbers),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))),
                    pa.array(np.full(len(at) * k, model.n)),
                    pa.array([str(d) for d in model.deviations(x)], pa.string()).take(numbers),
                    pa.array(whitened.ravel()),
                    pa.array(np.tile(model.explained, len(at))),
                    pa.array(np.full(len(at) * k, errors[int(dim)])),
                ]
                names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(projected, out).withColumn("deviation", F.col("deviation").cast("decimal(38,0)"))
