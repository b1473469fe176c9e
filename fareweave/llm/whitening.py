"""Vectors whitened along their leading principal components, found by Jacobi-Davidson.

The covariance is never formed. All the driver asks of the table is the product of the
covariance with a thin block of directions: each task centres its rows, multiplies them
twice and returns sums, which Spark adds up. The driver holds directions only (width times
a few dozen): it keeps an orthonormal search space, takes Ritz pairs from it, locks those
whose residual has reached double precision, and widens the space by the solutions of the
projected correction equations, which MINRES solves for all unlocked pairs at once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareweave.storage import materialize

GUARD = 8  # directions beside the wanted ones
WIDEST = 4  # the search space is cut back beyond this many times the wanted directions
INNER_STEPS, INNER_SHARE = 10, 0.05  # of MINRES: steps at most, and the part of a residual that may stay
OUTER_STEPS = 200
EPS = float(np.finfo(np.float64).eps)
SLICE_VALUES = 1 << 18  # entries that a task widens to doubles at once
LARGEST = 2.0**53  # scaled entries beyond count as this: doubles are no longer whole numbers apart
LOW = np.int64(0xFFFFFFFF)

Apply = Callable[[np.ndarray], np.ndarray]


def finite(vector: Column) -> Column:
    """Whether a vector can take part: not null, and without null or non-finite entries. Zero vectors take part."""
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(vector.isNotNull() & whole, F.lit(False))


def _orthonormal(new: np.ndarray, *bases: np.ndarray) -> np.ndarray:
    """Orthonormal columns that span what ``new`` adds to the bases."""
    for _ in range(2):
        sizes = np.linalg.norm(new, axis=0)
        new = new[:, sizes > 0] / sizes[sizes > 0]
        for basis in bases:
            new = new - basis @ (basis.T @ new)
        u, s, _ = np.linalg.svd(new, full_matrices=False)
        new = u[:, s > 1e-10]
    return new


def _minres(apply: Apply, shifts: np.ndarray, locked: np.ndarray, ritz: np.ndarray, residuals: np.ndarray) -> np.ndarray:
    """A step for each Ritz vector u of value e: (I-P)(V-eI)(I-P) t = -r, where P projects on u and all locked vectors.

    The columns are independent equations that share the products with V.
    """

    def project(x: np.ndarray) -> np.ndarray:
        x = x - locked @ (locked.T @ x)
        return x - ritz * (ritz * x).sum(axis=0)

    right = project(-residuals)
    first = np.linalg.norm(right, axis=0)
    open_ = first > 0
    beta = np.where(open_, first, 1.0)
    v, v_old = right / beta, np.zeros_like(right)
    w, w_old, x = np.zeros_like(right), np.zeros_like(right), np.zeros_like(right)
    eta = np.where(open_, first, 0.0)
    c = c_old = np.ones(len(first))
    s = s_old = np.zeros(len(first))
    for _ in range(INNER_STEPS):
        if not open_.any():
            break
        product = project(apply(v) - v * shifts)
        alpha = (v * product).sum(axis=0)
        v_new = product - alpha * v - beta * v_old
        beta_new = np.linalg.norm(v_new, axis=0)
        delta = c * alpha - c_old * s * beta
        rho1 = np.hypot(delta, beta_new)
        rho2, rho3 = s * alpha + c_old * c * beta, s_old * beta
        open_ = open_ & (rho1 > 0)
        safe = np.where(open_, rho1, 1.0)
        c_new, s_new = delta / safe, beta_new / safe
        w_new = np.where(open_, (v - rho3 * w_old - rho2 * w) / safe, 0.0)
        x = x + c_new * eta * w_new
        eta = -s_new * eta
        open_ = open_ & (np.abs(eta) > INNER_SHARE * first) & (beta_new > EPS * np.abs(shifts))
        # A closed equation stands still: its vectors are zero from here on.
        v_old, v = v, np.where(open_, v_new / np.where(open_, beta_new, 1.0), 0.0)
        w_old, w, c_old, c, s_old, s, beta = w, w_new, c, c_new, s, s_new, beta_new
    return x


@dataclass(frozen=True)
class Spectrum:
    """Leading eigenpairs, largest first, and the largest residual among them."""

    values: np.ndarray
    vectors: np.ndarray
    residual: float


def jacobi_davidson(apply: Apply, width: int, wanted: int, seed: int = 0) -> Spectrum:
    """The ``wanted`` largest eigenpairs of a symmetric operator without negative eigenvalues.

    Ends when the residuals of all pairs, measured with a product of their own, are at most
    4 * width * eps times the largest eigenvalue.
    """
    random = np.random.default_rng(seed)
    wanted = min(wanted, width)
    space = _orthonormal(random.normal(size=(width, min(width, wanted + GUARD))))
    images = apply(space)
    locked, locked_images = np.zeros((width, 0)), np.zeros((width, 0))
    for _ in range(OUTER_STEPS):
        inner = space.T @ images
        values, turn = np.linalg.eigh((inner + inner.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        space, images = space @ turn, images @ turn
        top = max(values[0] if len(values) else 0.0, *(locked * locked_images).sum(axis=0), 0.0)
        good = 4 * width * EPS * top
        residuals = images - space * values
        fit = np.linalg.norm(residuals, axis=0) <= good
        n = int(np.argmin(fit)) if not fit.all() else len(fit)
        n = min(n, wanted - locked.shape[1])
        locked, locked_images = np.hstack([locked, space[:, :n]]), np.hstack([locked_images, images[:, :n]])
        space, images, values, residuals = space[:, n:], images[:, n:], values[n:], residuals[:, n:]
        if locked.shape[1] == wanted:
            # Measured afresh, and put in order: values locked one after the other may be equal but for rounding.
            locked = _orthonormal(locked)
            locked_images = apply(locked)
            inner = locked.T @ locked_images
            values, turn = np.linalg.eigh((inner + inner.T) / 2)
            values, turn = values[::-1], turn[:, ::-1]
            locked, locked_images = locked @ turn, locked_images @ turn
            worst = float(np.linalg.norm(locked_images - locked * values, axis=0).max(initial=0.0))
            if worst <= good:
                return Spectrum(values, locked, worst)
            space, images = locked, locked_images
            locked, locked_images = np.zeros((width, 0)), np.zeros((width, 0))
            residuals = images - space * values
        targets = slice(0, wanted - locked.shape[1])
        steps = _minres(apply, values[targets], locked, space[:, targets], residuals[:, targets])
        if space.shape[1] > WIDEST * (wanted + GUARD):
            space, images = space[:, : wanted + GUARD], images[:, : wanted + GUARD]
        # A direction by chance beside the steps: a space that misses an eigenvector altogether stays open to it.
        new = _orthonormal(np.hstack([steps, random.normal(size=(width, 1))]), locked, space)
        if new.shape[1]:
            space, images = np.hstack([space, new]), np.hstack([images, apply(new)])
        else:
            images = apply(space)
    raise ArithmeticError(f"no convergence within {OUTER_STEPS} steps")


def _slices(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Whole numbers of a few rows at a time."""
    step = max(1, SLICE_VALUES // width)
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            yield part, np.frombuffer(b"".join(part.column("x").to_pylist()), np.int64).reshape(-1, width)


@dataclass(frozen=True)
class Fit:
    """How many vectors there are, and their sums: exactly base * n + rest in each dimension, 0 <= rest < n."""

    n: int
    base: np.ndarray
    rest: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.base).astype(np.float64) - self.rest / self.n

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """The sum over dimensions of (n*x - S)^2, exactly; None where a long cannot hold it."""
        apart = x - self.base
        most = self.n * (int(np.abs(apart).max(initial=0)) + 1)
        if apart.shape[1] * most * most < 2**63:
            return ((apart * self.n - self.rest) ** 2).sum(axis=1).tolist()
        exact = ((apart.astype(object) * self.n - self.rest.astype(object)) ** 2).sum(axis=1)
        return [int(v) if v < 2**63 else None for v in exact]


def _added(parts: DataFrame) -> np.ndarray:
    """The sums, place by place, of the lists that tasks return."""
    summed = parts.select(F.posexplode("part").alias("pos", "value")).groupBy("pos").agg(F.sum("value").alias("value"))
    rows = sorted(tuple(r) for r in summed.collect())
    return np.array([v for _, v in rows])


class Table:
    """The stored whole-number vectors of one width."""

    def __init__(self, stored: DataFrame, width: int, fit: Fit) -> None:
        self.rows = stored.where(F.col("width") == width)
        self.width, self.fit = width, fit

    def _sums(self, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """The sum over all rows of what ``of`` makes of centred ones; within a task without loss of low digits."""
        width, fit = self.width, self.fit

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = lost = None
            for _, x in _slices(batches, width):
                part = of(fit.centred(x)).ravel()
                if total is None:
                    total, lost = part, np.zeros_like(part)
                else:
                    part = part - lost
                    new = total + part
                    total, lost = new, (new - total) - part
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], names=["part"])

        return _added(self.rows.select("x").mapInArrow(run, "part array<double>"))

    def product(self, directions: np.ndarray) -> np.ndarray:
        """Covariance times directions."""
        return self._sums(lambda c: c.T @ (c @ directions)).reshape(directions.shape) / self.fit.n

    def trace(self) -> float:
        return float(self._sums(lambda c: np.array([(c * c).sum()]))[0]) / self.fit.n

    def identity_error(self, onto: np.ndarray) -> float:
        """The largest entry of the covariance of the whitened rows minus the identity."""
        k, n = onto.shape[1], self.fit.n
        sums = self._sums(lambda c: np.concatenate([(z := c @ onto).sum(axis=0), (z.T @ z).ravel()]))
        means, squares = sums[:k] / n, sums[k:].reshape(k, k) / n
        return float(np.abs(squares - np.outer(means, means) - np.eye(k)).max())


def _whole_numbers(rows: DataFrame, id_col: str, vector_col: str, scale: float, offset: int) -> DataFrame:
    """(id, width, x): each entry as floor(scale * entry) + offset, packed."""
    wide = F.col(vector_col).cast("array<double>")
    kept = rows.where(finite(F.col(vector_col))).select(
        F.col(id_col).alias("id"), F.size(vector_col).alias("width"), wide.alias("vector")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("vector")
            values = lists.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(batch.column("width").to_numpy())
            with np.errstate(over="ignore"):
                scaled = np.clip(np.floor(values * scale), -LARGEST, LARGEST)
            x = (scaled.astype(np.int64) + offset).tobytes()
            offsets = np.concatenate([[0], ends]) * 8
            packed = pa.array([x[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("width"), packed], names=["id", "width", "x"])

    id_type = rows.schema[id_col].dataType
    schema = T.StructType([T.StructField("id", id_type), T.StructField("width", T.IntegerType()), T.StructField("x", T.BinaryType())])
    return kept.where("width > 0").mapInArrow(run, schema)


def _fits(stored: DataFrame) -> dict[int, Fit]:
    """The exact sums of each width. Sums travel in halves of 32 bits and meet as decimals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list] = {}
        for batch in batches:
            widths = batch.column("width").to_numpy()
            for width in np.unique(widths).tolist():
                mine = batch.filter(pa.array(widths == width))
                for part, x in _slices(iter([mine]), width):
                    known = sums.setdefault(width, [0, np.zeros(width, np.int64), np.zeros(width, np.int64)])
                    known[0] += part.num_rows
                    known[1] += (x >> 32).sum(axis=0)
                    known[2] += (x & LOW).sum(axis=0)
        for width, (n, high, low) in sums.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([width] * width, pa.int32()), pa.array(range(width), pa.int32()),
                    pa.array([n] * width, pa.int64()), pa.array(high), pa.array(low),
                ],
                names=["width", "pos", "n", "high", "low"],
            )

    parts = stored.select("width", "x").mapInArrow(run, "width int, pos int, n long, high long, low long")
    exact = [F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in ("high", "low")]
    totals = parts.groupBy("width", "pos").agg(F.sum("n").alias("n"), *exact).collect()
    fits = {}
    for width in {r.width for r in totals}:
        rows = sorted((r for r in totals if r.width == width), key=lambda r: r.pos)
        pairs = [divmod((int(r.high) << 32) + int(r.low), r.n) for r in rows]
        fits[width] = Fit(rows[0].n, np.array([q for q, _ in pairs], np.int64), np.array([r for _, r in pairs], np.int64))
    return fits


def whiten(
    rows: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    components: int = 32,
    scale: float = 64.0,
    offset: int = 1_000_000,
) -> DataFrame:
    """Rows (``id_col``, component, n, deviation, whitened, explained, identity_error) of each usable vector.

    Entries become whole numbers x = floor(scale * entry) + offset (scaled entries beyond 2^53
    count as that). Over all n usable vectors, ``whitened`` is x minus its mean, projected on
    the component's eigenvector of the covariance, over the root of its eigenvalue. Components count from 1
    by falling eigenvalue; there are at most ``components``, and none without variance (an
    eigenvalue within rounding of zero cannot be whitened), so equal vectors, or a single
    one, give no rows. ``explained`` is the eigenvalue over the trace, ``deviation`` the exact
    sum over dimensions of (n*x - S)^2, null where a long cannot hold it, ``identity_error``
    the largest entry of the covariance of ``whitened`` minus the identity, measured over all rows.

    Null vectors and those with null, NaN or infinite entries take no part; zero vectors do.
    Vectors of different widths are fitted apart, each width on its own vectors; empty ones
    give no rows. Null ids are kept; repeated ids and equal vectors count as often as they
    stand there. Other columns are ignored. An empty table gives an empty table.

    The whole numbers are stored once in the shared folder and read again by each product.
    """
    stored = materialize(_whole_numbers(rows, id_col, vector_col, scale, offset), "whole-numbers")
    fields = [
        ("component", T.IntegerType()), ("n", T.LongType()), ("deviation", T.LongType()), ("whitened", T.DoubleType()),
        ("explained", T.DoubleType()), ("identity_error", T.DoubleType()),
    ]
    id_field = T.StructField(id_col, rows.schema[id_col].dataType)
    schema = T.StructType([id_field, *(T.StructField(n, t) for n, t in fields)])
    out = rows.sparkSession.createDataFrame([], schema)
    for width, fit in sorted(_fits(stored).items()):
        table = Table(stored, width, fit)
        spectrum = jacobi_davidson(table.product, width, components)
        some = spectrum.values > 16 * width * EPS * max(spectrum.values[0], 0.0)
        if some.any():
            out = out.unionByName(_whitened(table, spectrum.values[some], spectrum.vectors[:, some], id_col, schema))
    return out


def _whitened(table: Table, values: np.ndarray, vectors: np.ndarray, id_col: str, schema: T.StructType) -> DataFrame:
    onto = vectors / np.sqrt(values)
    k, n, width, fit = len(values), table.fit.n, table.width, table.fit
    explained, error = values / table.trace(), table.identity_error(onto)
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _slices(batches, width):
            rows = part.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("id").take(pa.array(np.repeat(np.arange(rows), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * k, n, dtype=np.int64)),
                    pa.array(fit.deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(rows), k))),
                    pa.array((fit.centred(x) @ onto).ravel()),
                    pa.array(np.tile(explained, rows)),
                    pa.array(np.full(rows * k, error)),
                ],
                names=names,
            )

    return table.rows.select("id", "x").mapInArrow(run, schema)
