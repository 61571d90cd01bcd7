"""Whitening of embeddings: the leading principal components by Jacobi-Davidson, and every vector in their coordinates.

Vectors are put on a grid of whole numbers, floor(64 c) + 1000000, so that sums and deviations are exact. Their covariance is
never built: all that is asked of it are products with a few columns, and each product is one pass over the packed
vectors. A task centres its vectors, multiplies them, and sends as many numbers as the result has; Spark adds them up by
cell, so the driver gets one number for each cell whatever the number of tasks.

The search space starts with random columns. A round takes the Ritz pairs of the space (Rayleigh-Ritz), locks the leading
ones whose residual is at double precision, and extends the space by corrections for the others: the equation
(I - QQ') (V - theta) (I - QQ') t = -residual, Q being the locked and the current Ritz vectors, is solved by a few steps of MINRES, for all columns
together, so that a step is one pass. A space that has grown too large is cut back to its leading Ritz vectors.

Defined cases: vectors that are null or hold null or non-finite entries are left out, and so are empty ones; vectors of each
length are fitted among themselves; entries beyond the grid's 2**53 count as 2**53; a direction without spread, as of
equal vectors, a single vector or fewer vectors than dimensions, is no component; a deviation that no long holds is null;
repeated rows and ids count each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import forget, ship, stage

SCALE, OFFSET = 64, 1_000_000  # fixed values of the grid
FURTHEST = 2.0**53
PACKED = 2048
LONG = 2**63 - 1
#: A residual is at double precision when it is within so many roundings of the largest eigenvalue, per root of the dimensions.
ROUNDINGS = 32
#: An eigenvalue below this share of the trace is rounding.
LEAST_SHARE = 1e-13

Product = Callable[[np.ndarray], np.ndarray]


class Fit(NamedTuple):
    """Vectors of one length: their number, whole-number sums, the mean as a whole ``base`` and ``rest`` / n, whether longs hold their
    deviations, and the components (columns) with their eigenvalues, shares of the trace, and the identity's error."""

    n: int
    base: np.ndarray
    rest: np.ndarray
    exact: bool
    vectors: np.ndarray
    values: np.ndarray
    explained: np.ndarray
    identity_error: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.base) - np.array(self.rest / self.n, float)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over the dimensions of (n x - S) squared, exact."""
        y = x - self.base
        if self.exact:
            y = self.n * y - self.rest.astype(np.int64)
            return (y * y).sum(axis=1).tolist()
        y = self.n * y.astype(object) - self.rest
        return [s if s <= LONG else None for s in (y * y).sum(axis=1)]

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.vectors / np.sqrt(self.values))


def _sound(v: Column) -> Column:
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & (F.size(v) > 0), F.lit(False))


def _by_length(vectors: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of the vectors of each length, and these on the grid."""
    lengths = vectors.value_lengths().to_numpy()
    for length in np.unique(lengths):
        at = np.nonzero(lengths == length)[0]
        c = vectors.take(pa.array(at)).flatten().to_numpy().reshape(-1, length)
        yield at, np.clip(np.floor(SCALE * c), -FURTHEST, FURTHEST).astype(np.int64) + OFFSET


def _packed(rows: DataFrame) -> DataFrame:
    """length, block: up to PACKED vectors on the grid, row after row as bytes."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), PACKED):
                for _, x in _by_length(batch["v"].slice(start, PACKED)):
                    yield pa.RecordBatch.from_pydict({"length": pa.array([x.shape[1]], pa.int32()), "block": [x.tobytes()]})

    return rows.select("v").mapInArrow(pack, "length int, block binary")


def _sums(packed: DataFrame) -> dict[int, list]:
    """By length, for each dimension: number, sum, least and greatest, all exact."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list] = {}
        for batch in batches:
            for length, block in zip(batch["length"].to_pylist(), batch["block"], strict=True):
                x = np.frombuffer(block.as_py(), np.int64).reshape(-1, length)
                own = [len(x), x.sum(axis=0, dtype=np.int64 if np.abs(x).max() < 2**50 else object).astype(object), x.min(axis=0), x.max(axis=0)]
                if (had := total.get(length)) is None:
                    total[length] = own
                else:
                    total[length] = [had[0] + own[0], had[1] + own[1], np.minimum(had[2], own[2]), np.maximum(had[3], own[3])]
        for length, (n, sums, least, most) in total.items():
            yield pa.RecordBatch.from_pydict({
                "length": pa.array([length] * length, pa.int32()), "at": pa.array(range(length), pa.int32()), "n": pa.array([n] * length, pa.int64()),
                "s": pa.array([Decimal(int(s)) for s in sums], pa.decimal128(38, 0)), "least": pa.array(least), "most": pa.array(most)})

    found: dict[int, list] = {}
    each = packed.mapInArrow(add, "length int, at int, n long, s decimal(38,0), least long, most long").groupBy("length", "at").agg(
        F.sum("n").alias("n"), F.sum("s").alias("s"), F.min("least").alias("least"), F.max("most").alias("most"))
    for r in each.orderBy("length", "at").collect():  # one row for each dimension
        found.setdefault(r["length"], []).append((r["n"], int(r["s"]), r["least"], r["most"]))
    return found


def _started(dimensions: list) -> Fit:
    """What the sums alone give."""
    n = dimensions[0][0]
    base = [s // n for _, s, _, _ in dimensions]
    rest = [s - n * b for (_, s, _, _), b in zip(dimensions, base, strict=True)]
    furthest = [n * max(most - b + 1, b + 1 - least) for (_, _, least, most), b in zip(dimensions, base, strict=True)]
    exact = sum(y * y for y in furthest) <= LONG
    none = np.zeros((len(base), 0))
    return Fit(n, np.array(base, np.int64), np.array(rest, object), exact, none, np.zeros(0), np.zeros(0), 0.0)


def _total(blocks: DataFrame, fit: Fit, size: int, part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over all vectors of ``part`` of the centred ones, ``size`` numbers a task and as many for the driver."""
    d = len(fit.base)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for block in batch["block"]:
                total += part(fit.centred(np.frombuffer(block.as_py(), np.int64).reshape(-1, d))).ravel()
        yield pa.RecordBatch.from_pydict({"cell": pa.array(range(size), pa.int32()), "value": pa.array(total)})

    sums = blocks.select("block").mapInArrow(add, "cell int, value double").groupBy("cell").agg(F.sum("value").alias("value")).toArrow()
    found = np.zeros(size)
    found[sums["cell"].to_numpy()] = sums["value"].to_numpy()
    return found


def minres(product: Product, theta: np.ndarray, q: np.ndarray, residual: np.ndarray, steps: int, reduction: float = 0.01) -> np.ndarray:
    """Columns t, orthogonal to ``q``, that about solve (I - qq') (V - theta) (I - qq') t = -residual, each with its own theta.

    One product a step serves all columns; a column that is solved stands still.
    """
    def away(t: np.ndarray) -> np.ndarray:
        return t - q @ (q.T @ t)

    def norms(t: np.ndarray) -> np.ndarray:
        return np.sqrt((t * t).sum(axis=0))

    start = away(-residual)
    left = norms(start)
    aim, alive = reduction * left, left > 0
    v, v_old = start / np.where(alive, left, 1), np.zeros_like(start)
    solution, w, w_old = (np.zeros_like(start) for _ in range(3))
    beta, c, c_old, s, s_old = np.zeros(len(theta)), np.ones(len(theta)), np.ones(len(theta)), np.zeros(len(theta)), np.zeros(len(theta))
    for _ in range(steps):
        if not alive.any():
            break
        image = away(product(v) - v * theta)
        alpha = (v * image).sum(axis=0)
        image -= v * alpha + v_old * beta
        beta_new = norms(image)
        # Rotations that keep the tridiagonal matrix triangular.
        diagonal = c * alpha - c_old * s * beta
        above, above_two = s * alpha + c_old * c * beta, s_old * beta
        pivot = np.hypot(diagonal, beta_new)
        alive &= pivot > 0
        safe = np.where(alive, pivot, 1)
        c_old, c, s_old, s = c, diagonal / safe, s, beta_new / safe
        w, w_old = (v - w_old * above_two - w * above) / safe, w
        solution += np.where(alive, c * left, 0) * w
        left = np.where(alive, -s * left, left)
        alive &= (np.abs(left) > aim) & (beta_new > 0)
        v, v_old, beta = image / np.where(beta_new > 0, beta_new, 1), v, beta_new
    return solution


def _extended(space: np.ndarray, more: np.ndarray) -> np.ndarray:
    """Orthonormal columns that ``more`` adds to the orthonormal ``space``."""
    kept = []
    for column in more.T:
        size = np.linalg.norm(column)
        for _ in range(3):
            for known in (space, *([np.stack(kept, 1)] if kept else [])):
                column = column - known @ (known.T @ column)
        rest = np.linalg.norm(column)
        if size > 0 and rest > 1e-10 * size:
            kept.append(column / rest)
    return np.stack(kept, 1) if kept else np.zeros((len(space), 0))


def jacobi_davidson(product: Product, d: int, wanted: int, guard: int = 8, steps: int = 8, rounds: int = 200) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of a symmetric matrix of d rows that is known by its products, falling, and their vectors."""
    wanted = min(d, wanted)
    size = min(d, wanted + guard)
    locked, locked_image = np.zeros((d, 0)), np.zeros((d, 0))
    space = np.linalg.qr(np.random.default_rng(11).standard_normal((d, size)))[0]
    image = product(space)
    for _ in range(rounds):
        small = space.T @ image
        theta, turn = np.linalg.eigh((small + small.T) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        ritz, ritz_image = space @ turn, image @ turn
        residual = ritz_image - ritz * theta
        residual -= locked @ (locked.T @ residual)
        largest = max([np.abs(theta[:1]).max(initial=0.0), *np.abs((locked * locked_image).sum(axis=0))])
        small_enough = np.sqrt((residual * residual).sum(axis=0)) <= ROUNDINGS * np.finfo(float).eps * np.sqrt(d) * largest
        missing = wanted - locked.shape[1]
        # Leading pairs only, so that none is passed over.
        done = min(missing, len(theta) if small_enough.all() else int(np.argmin(small_enough)))
        locked, locked_image = np.hstack([locked, ritz[:, :done]]), np.hstack([locked_image, ritz_image[:, :done]])
        if done == missing:
            break
        space, image, ritz, theta, residual = ritz[:, done:], ritz_image[:, done:], ritz[:, done:], theta[done:], residual[:, done:]
        if space.shape[1] > 3 * size:
            space, image = space[:, :size], image[:, :size]
        active = min(missing - done, space.shape[1])
        known = np.hstack([locked, space])
        correction = minres(product, theta[:active], np.hstack([locked, ritz[:, :active]]), residual[:, :active], steps)
        more = _extended(known, correction)
        if not more.shape[1] and known.shape[1] < d:  # the corrections say nothing new
            more = _extended(known, np.random.default_rng(known.shape[1]).standard_normal((d, active)))
        space, image = np.hstack([space, more]), np.hstack([image, product(more)]) if more.shape[1] else image
    else:
        raise ArithmeticError(f"{wanted - locked.shape[1]} of {wanted} components did not converge in {rounds} rounds")
    # Once more among the locked ones, as they came in several rounds.
    small = locked.T @ locked_image
    theta, turn = np.linalg.eigh((small + small.T) / 2)
    return theta[::-1].copy(), (locked @ turn)[:, ::-1].copy()


def fit(packed: DataFrame, components: int = 32) -> dict[int, Fit]:
    """Of packed vectors, by length. The driver holds a few columns of as many numbers as the vectors have dimensions."""
    fits = {}
    for length, dimensions in _sums(packed).items():
        blocks, start = packed.filter(F.col("length") == length), _started(dimensions)

        def product(columns: np.ndarray, blocks=blocks, start=start) -> np.ndarray:
            total = _total(blocks, start, columns.size, lambda c: c.T @ (c @ columns))
            return total.reshape(columns.shape) / start.n

        trace = _total(blocks, start, length, lambda c: (c * c).sum(axis=0)).sum() / start.n
        values, vectors = jacobi_davidson(product, length, components) if trace > 0 else (np.zeros(0), np.zeros((length, 0)))
        spread = values > LEAST_SHARE * trace
        found = start._replace(values=values[spread], vectors=vectors[:, spread], explained=values[spread] / trace if trace > 0 else values)
        fits[length] = found._replace(identity_error=_identity_error(blocks, found))
    return fits


def _identity_error(blocks: DataFrame, found: Fit) -> float:
    """Largest absolute entry of the whitened vectors' covariance minus the identity, over all vectors."""
    k = len(found.values)
    if not k:
        return 0.0
    turn = found.vectors / np.sqrt(found.values)
    mean = _total(blocks, found, k, lambda c: (c @ turn).sum(axis=0)) / found.n

    def moments(c: np.ndarray) -> np.ndarray:
        w = c @ turn - mean
        return w.T @ w

    return float(np.abs(_total(blocks, found, k * k, moments).reshape(k, k) / found.n - np.eye(k)).max())


def whiten(rows: DataFrame, components: int = 32, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per sound vector and component, numbered by falling eigenvalue: id, component, n, deviation, whitened, explained, identity_error."""
    ship(rows.sparkSession)
    given = rows.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("v")).filter(_sound(F.col("v")))
    packed = stage(_packed(given), "packed")
    fits = fit(packed, components)
    forget(packed)
    schema = T.StructType([given.schema["id"], T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()),
                           T.StructField("deviation", T.LongType()), *[T.StructField(c, T.DoubleType()) for c in ("whitened", "explained", "identity_error")]])
    sent = rows.sparkSession.sparkContext.broadcast(fits)  # a few columns a length

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(start, PACKED) for whole in batches for start in range(0, len(whole), PACKED)):
            for at, x in _by_length(batch["v"]):
                own = sent.value[x.shape[1]]
                k, rows_here = len(own.values), len(at)
                if k:
                    each = np.repeat(np.arange(rows_here), k)
                    yield pa.RecordBatch.from_arrays([
                        batch["id"].take(pa.array(at[each])), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows_here)),
                        pa.array(np.full(len(each), own.n)), pa.array(own.deviations(x), pa.int64()).take(pa.array(each)),
                        pa.array(own.whitened(x).ravel()), pa.array(np.tile(own.explained, rows_here)),
                        pa.array(np.full(len(each), own.identity_error))], names=schema.names)

    return given.mapInArrow(project, schema)
