"""Whitening of embeddings by a randomised range finder and Rayleigh-Ritz.

Entries become whole numbers, x = floor(64 c) + 1000000, so that counts and sums
are exact: n x - S is a long, and a row divided by n is centred to the last bit
before anything is multiplied. A pass over all rows multiplies the covariance V
with a block Q of directions: each task adds up y (y'Q) of its own rows, Spark
adds up the tasks' blocks by entry, and the driver gets one block of d times l.

Q begins as a random block, ``OVERSAMPLING`` wider than what is wanted, and each
power pass replaces it by an orthonormal basis of VQ. The same product gives the
Ritz pairs of Q and their residuals. They are taken once the wanted pairs are
proven: their residuals are ``PRECISE`` times smaller than the gaps around them,
and the trace that the block leaves over is smaller than the least wanted value,
so that no larger one can be hidden. Where this fails after ``PASSES`` passes, as
with flat spectra, Q is expanded to full dimension: one more pass gives V itself
and Rayleigh-Ritz is its whole decomposition.

Defined cases: rows whose vector is null, or holds null or non-finite entries,
are dropped, as are vectors of another length than most have (of two lengths
that are equally frequent the greater counts; an empty vector has no entries and
is dropped); repeated rows count as often as they come; null ids stay; further
columns are ignored; components without variance can't be whitened and are left
out, so equal vectors, or a single one, give no component; an empty table gives
an empty result; of equal eigenvalues any basis is right, and it is the same for
all rows. Entries of 2**40 or more in magnitude, and deviations beyond a long,
raise OverflowError, for their exact sums don't fit.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import replayable, ship

SCALE, SHIFT = 64, 1_000_000
OVERSAMPLING = 16  # directions beyond the wanted ones
PASSES = 4  # power passes before the block is expanded
PRECISE = 1e-11  # residual against gap of a pair that is taken
SEED = 11
LARGEST = 2.0**40


@dataclass
class Whitener:
    """n, S and the components (columns), by falling eigenvalue; explained are shares of the trace."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    values: np.ndarray
    trace: float
    expanded: bool
    passes: int
    identity_error: float = 0.0
    map: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        self.map = self.components / np.sqrt(self.values)

    @property
    def explained(self) -> np.ndarray:
        return self.values / self.trace if self.trace else self.values


def _vectors(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, places, x) of the usable rows of a batch, by length."""
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # null entries are NaN
    starts = np.cumsum(lengths) - lengths
    for d in np.unique(lengths[lengths > 0]):
        at = np.nonzero(lengths == d)[0]
        rows = flat[starts[at][:, None] + np.arange(d)]
        usable = np.isfinite(rows).all(axis=1)
        at, rows = at[usable], rows[usable]
        if (np.abs(rows) >= LARGEST).any():
            raise OverflowError("entries of 2**40 or more have no exact sums")
        yield int(d), at, np.floor(SCALE * rows).astype(np.int64) + SHIFT


def _of_length(column: pa.Array, d: int) -> tuple[np.ndarray, np.ndarray]:
    return next(((at, x) for length, at, x in _vectors(column) if length == d), (np.zeros(0, np.int64), np.zeros((0, d), np.int64)))


def _totals(rows: DataFrame) -> tuple[int, np.ndarray]:
    """Count and exact sums of the vectors of the most frequent length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count: dict[int, int] = {}
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for d, at, x in _vectors(b[1]):
                count[d] = count.get(d, 0) + len(at)
                sums[d] = sums.get(d, 0) + x.sum(axis=0)
        for d, s in sums.items():
            yield pa.record_batch([pa.array([d] * (d + 1), pa.int32()), pa.array(range(-1, d), pa.int32()), pa.array([count[d], *s.tolist()], pa.int64())], ["d", "i", "v"])

    found = rows.mapInArrow(run, "d int, i int, v long").groupBy("d", "i").agg(F.sum("v").alias("v")).persist()
    top = found.where("i = -1 and v > 0").orderBy(F.desc("v"), F.desc("d")).first()
    if top is None:
        found.unpersist()
        return 0, np.zeros(0, np.int64)
    sums = np.zeros(top.d, np.int64)
    for r in found.where((F.col("d") == top.d) & (F.col("i") >= 0)).collect():  # a row for each dimension
        sums[r.i] = r.v
    found.unpersist()
    return top.v, sums


def _added(rows: DataFrame, part, shape: tuple[int, int], d: int) -> np.ndarray:  # noqa: ANN001
    """Sum over all rows of part(x), a block of the given shape for the x of a batch; added up by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            x = _of_length(b[1], d)[1]
            if len(x):
                total = part(x) if total is None else total + part(x)
        if total is not None:
            i, j = np.indices(shape)
            yield pa.record_batch([pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(total.ravel(), pa.float64())], ["i", "j", "v"])

    out = np.zeros(shape)
    for r in rows.mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():  # a row for each entry of the block
        out[r.i, r.j] = r.v
    return out


def _pairs(block: np.ndarray, image: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rayleigh-Ritz: (values, vectors, residuals) of the block, by falling value; image = V block."""
    small = block.T @ image
    values, inner = np.linalg.eigh((small + small.T) / 2)
    order = np.argsort(-values, kind="stable")
    values, inner = values[order], inner[:, order]
    vectors = block @ inner
    return values, vectors, np.linalg.norm(image @ inner - vectors * values, axis=0)


def _proven(values: np.ndarray, residuals: np.ndarray, wanted: int, trace: float) -> bool:
    left = max(0.0, trace - values.sum())  # no value outside the block is greater
    if left >= values[wanted - 1]:
        return False
    below = np.append(values[1:], left)[:wanted]
    gap = np.minimum(values[:wanted] - np.maximum(below, left), np.append(np.inf, -np.diff(values))[:wanted])
    return bool((residuals[:wanted] <= PRECISE * gap).all())


def fit(rows: DataFrame, most: int = 32) -> Whitener | None:
    """The whitener of all usable rows (id, vector); None if there are none."""
    n, sums = _totals(rows)
    if not n:
        return None
    d = len(sums)
    wanted, width = min(most, d), min(d, most + OVERSAMPLING)

    def centred(x: np.ndarray) -> np.ndarray:
        return (n * x - sums) / n  # exact up to the division

    trace = _added(rows, lambda x: np.square(centred(x)).sum().reshape(1, 1), (1, 1), d)[0, 0] / n
    block = np.linalg.qr(np.random.default_rng(SEED).standard_normal((d, width)))[0]
    found = None
    passes = 0
    while found is None and width < d and passes < PASSES:
        image = _added(rows, lambda x, q=block: (lambda y: y.T @ (y @ q))(centred(x)), (d, width), d) / n
        passes += 1
        values, vectors, residuals = _pairs(block, image)
        if _proven(values, residuals, wanted, trace):
            found = values, vectors
        else:
            block = np.linalg.qr(image)[0]
    expanded = found is None
    if found is None:  # residuals fail, or there is no room to sample: all directions
        whole = _added(rows, lambda x: (lambda y: y.T @ y)(centred(x)), (d, d), d) / n
        found = _pairs(np.eye(d), whole)[:2]
    values, vectors = found[0][:wanted], found[1][:, :wanted]
    held = values > max(found[0][0], 0.0) * d * np.finfo(float).eps * 4
    model = Whitener(n, sums, vectors[:, held], values[held], float(trace), expanded, passes)
    k = model.map.shape[1]
    if k:
        spread = _added(rows, lambda x: (lambda w: w.T @ w)(centred(x) @ model.map), (k, k), d) / n
        model.identity_error = float(np.abs(spread - np.eye(k)).max())
    return model


def apply(rows: DataFrame, model: Whitener) -> DataFrame:
    """(id, deviation, whitened) of the usable rows; whitened has one entry for each component."""
    name, kind = rows.columns[0], rows.schema[0].dataType.simpleString()
    n, sums, project = model.n, model.sums, model.map
    d = len(sums)
    fits = 2**62 // d

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, x = _of_length(b[1], d)
            y = n * x - sums
            if len(y) and int(np.abs(y).max()) ** 2 > fits:
                raise OverflowError("deviations don't fit a long")
            white = (y / n) @ project
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(white) + 1) * white.shape[1], pa.int32()), pa.array(white.ravel()))
            yield pa.record_batch([b[0].take(pa.array(at)), pa.array(np.square(y).sum(axis=1), pa.int64()), lists], [name, "deviation", "whitened"])

    return rows.mapInArrow(run, f"`{name}` {kind}, deviation long, whitened array<double>")


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", most: int = 32) -> tuple[DataFrame, Whitener | None]:
    """(id, deviation, whitened) of the usable rows of vectors, and the whitener that was fitted to all of them."""
    ship(vectors.sparkSession)
    rows = replayable(vectors.select(id_col, vector_col))  # read once for each pass
    model = fit(rows, most)
    if model is None:
        kind = vectors.schema[id_col].dataType.simpleString()
        return vectors.sparkSession.createDataFrame([], f"`{id_col}` {kind}, deviation long, whitened array<double>"), None
    return apply(rows, model), model


def components(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", most: int = 32) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error): a row for each usable row and component."""
    rows, model = whiten(vectors, id_col, vector_col, most)
    shares = F.array(*(F.lit(float(x)) for x in model.explained)) if model is not None else F.array().cast("array<double>")
    told = rows.select(id_col, "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return told.select(
        id_col,
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(model.n if model else 0).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("at")).alias("explained"),
        F.lit(model.identity_error if model else 0.0).alias("identity_error"),
    )
