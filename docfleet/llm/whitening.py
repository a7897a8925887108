"""Embedding whitening by incremental eigendecomposition.

* Updates. Each task keeps a spectrum: count, exact sums, mean, eigenvalues and eigenvectors of the
  scatter of the vectors it has seen. A vector is a centred rank-one update: its projections on the
  eigenvectors make a secular equation, whose roots are the new eigenvalues. Equal eigenvalues are
  turned so that one of them carries the whole projection, and directions without a projection are
  left alone (deflation); the others get their eigenvectors from the roots.
* Combination. Spectra meet ``FAN_IN`` at a time as a tree. One takes the other by successive rank-one
  updates, one per eigenvector and one for the distance of the means.
* Refinement. All rows, centred by the exact sums, are projected on the combined basis in a distributed
  pass; the eigenvectors of that projected covariance turn the basis into the components
  (Rayleigh-Ritz). The basis is complete, so one pass gives them to double precision.

What the driver holds is one basis of dimension x dimension doubles, whatever the number of rows.

An entry c becomes the long x = floor(scale * c) + shift. Defined results: vectors that are null or hold
null or non-finite entries are dropped; an entry beyond +-2^52 after scaling is held there. Vectors of
different length make fit lists of their own; an empty vector has no components. Repeated rows count as
often as they occur, and a row without vec_id is a row. A component whose eigenvalue is not above
``FLAT`` of the trace (constant data, fewer rows than dimensions) has no direction: its whitened
values are null and it takes no part in identity_error. deviation is a decimal of 38 digits, null beyond
them. Other columns take no part and may have any name. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from docfleet.llm.words import tidy
from docfleet.llm.work import Work

SCALE, SHIFT = 1024, 100_000
MOST = 1 << 52
COMPONENTS = 8
ROWS_PER_TASK = 8_192
FAN_IN = 8
FLAT = 1e-12
SPECTRUM = "_node bigint, n bigint, sums array<decimal(38,0)>, mean array<double>, roots array<double>, basis array<double>"
EPS = np.finfo(np.float64).eps


# ---------------------------------------------------------------- one rank-one update


def secular_roots(d: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + sum(z_j^2 / (d_j - x)) = 0 for rising, distinct d and z without zeros.

    The second result has d_j - x_i in row i, column j: every root is sought as its distance from the
    nearer of its two poles, so that these differences are accurate to the last digits.
    """
    k, z2 = len(d), z * z
    total = z2.sum()
    gap = np.append(np.diff(d), total)
    middle = d + gap / 2
    left = 1 + (z2 / (d - middle[:, None])).sum(1) >= 0
    here = np.arange(k)
    origin = np.where(left | (here == k - 1), here, here + 1)
    delta = d - d[origin][:, None]
    below = delta[here, here]  # the pole left of the root, and right of it (a bound for the last)
    above = np.append(delta[here[:-1], here[:-1] + 1], total)
    low = np.where(left, below, below + gap / 2)
    high = np.where(left, below + gap / 2, above)
    x = (low + high) / 2
    lower, ones = np.tri(k), np.ones(k)  # poles left of the root; row sums are products with ones
    for _ in range(60):
        apart = delta - x[:, None]
        apart[apart == 0] = np.finfo(float).tiny
        terms = z2 / apart
        slopes = terms / apart
        left_sum, f = (terms * lower) @ ones, 1 + terms @ ones
        open_ = np.abs(f) > 4 * EPS * k * (f - 2 * left_sum)
        low, high = np.where(f < 0, x, low), np.where(f < 0, high, x)
        open_ &= high - low > 2 * EPS * np.maximum(np.abs(low), np.abs(high))
        if not open_.any():
            break
        # the sums left and right of the root as one pole each, and a constant
        a, b = below - x, above - x
        left_slope, slope = (slopes * lower) @ ones, slopes @ ones
        right_slope = slope - left_slope
        c = f - a * left_slope - b * right_slope
        p, q = (a + b) * f - a * b * slope, a * b * f
        with np.errstate(all="ignore"):
            root = np.sqrt(np.maximum(p * p - 4 * q * c, 0))
            step = np.where(p <= 0, (p - root) / (2 * c), 2 * q / (p + root))
            # no pole right of the last root
            step[-1] = a[-1] + left_slope[-1] * a[-1] * a[-1] / (f[-1] - a[-1] * left_slope[-1])
        new = x + step
        good = np.isfinite(new) & (new > low) & (new < high)
        x = np.where(open_, np.where(good, new, (low + high) / 2), x)
    apart = delta - x[:, None]
    apart[apart == 0] = np.finfo(float).tiny
    return d[origin] + x, apart


def rank_one(roots: np.ndarray, basis: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (rising) and eigenvectors of ``basis @ diag(roots) @ basis.T + outer(v, v)``."""
    z = v @ basis
    norm = np.sqrt(z @ z)
    if norm == 0:
        return roots, basis
    roots, basis = roots.copy(), basis.copy()
    least = 8 * EPS * max(roots[-1], norm * norm)
    same = np.diff(roots) <= least
    if same.any():
        ends = np.flatnonzero(~np.append(same, False)) + 1
        for a, b in zip([0, *ends[:-1].tolist()], ends.tolist()):
            size = np.sqrt(z[a:b] @ z[a:b])
            if b - a > 1 and size > 0:
                # a reflection of equal eigenvalues' vectors puts the whole projection on the last one
                h = z[a:b].copy()
                h[-1] += size if h[-1] >= 0 else -size
                basis[:, a:b] -= np.outer(basis[:, a:b] @ h, 2 * h / (h @ h))
                z[b - 1] = -size if z[b - 1] >= 0 else size
                z[a : b - 1] = 0
                roots[a:b] = roots[b - 1]
    live = np.flatnonzero(np.abs(z) * norm > least)
    d, z = roots[live], z[live]
    if len(live) == 1:
        roots[live] = d + z * z
    elif len(live):
        found, apart = secular_roots(d, z)
        # the z for which these roots are exact: over the poles below, then over the poles above
        lower = np.tri(len(d), dtype=bool)
        between = d - d[:, None]
        over = np.where(lower, np.roll(between, -1, axis=0), between)
        over[-1] = 1
        exact = np.copysign(np.sqrt(np.abs(np.prod(apart / over, axis=0))), z)
        vectors = exact / apart
        vectors /= np.sqrt((vectors * vectors).sum(1))[:, None]
        roots[live], basis[:, live] = found, basis[:, live] @ vectors.T
    order = np.argsort(roots, kind="stable")
    return roots[order], np.ascontiguousarray(basis[:, order])


@dataclass
class Spectrum:
    """Count, exact sums, mean and eigendecomposition of the scatter about the mean."""

    n: int
    sums: list[int]
    mean: np.ndarray
    roots: np.ndarray
    basis: np.ndarray

    @classmethod
    def empty(cls, d: int) -> Spectrum:
        return cls(0, [0] * d, np.zeros(d), np.zeros(d), np.eye(d))

    def add(self, rows: np.ndarray) -> None:
        """Rows of longs, one centred rank-one update each."""
        step = max(1, (1 << 62) // MOST)
        for at in range(0, len(rows), step):
            self.sums = [a + b for a, b in zip(self.sums, rows[at : at + step].sum(0).tolist())]
        for row in rows.astype(np.float64):
            apart = row - self.mean
            if self.n:
                self.roots, self.basis = rank_one(self.roots, self.basis, apart * np.sqrt(self.n / (self.n + 1)))
            self.n += 1
            self.mean = self.mean + apart / self.n

    def take(self, other: Spectrum) -> None:
        """The other spectrum by successive rank-one updates."""
        if not other.n:
            return
        apart = other.mean - self.mean
        both = self.n + other.n
        for root, vector in zip(other.roots[::-1], other.basis.T[::-1]):
            if root > 0:
                self.roots, self.basis = rank_one(self.roots, self.basis, vector * np.sqrt(root))
        if self.n:
            self.roots, self.basis = rank_one(self.roots, self.basis, apart * np.sqrt(self.n / both * other.n))
        self.mean = self.mean + apart * (other.n / both)
        self.sums, self.n = [a + b for a, b in zip(self.sums, other.sums)], both


# ---------------------------------------------------------------- Spark


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("_x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _row(node: int, s: Spectrum) -> dict:
    return {"_node": [node], "n": [s.n], "sums": [s.sums], "mean": [s.mean.tolist()], "roots": [s.roots.tolist()], "basis": [s.basis.ravel().tolist()]}


_ROW = pa.schema([
    ("_node", pa.int64()), ("n", pa.int64()), ("sums", pa.list_(pa.decimal128(38, 0))), ("mean", pa.list_(pa.float64())),
    ("roots", pa.list_(pa.float64())), ("basis", pa.list_(pa.float64())),
])


def _spectrum(row: dict) -> Spectrum:
    d = len(row["mean"])
    return Spectrum(row["n"], [int(s) for s in row["sums"]], np.array(row["mean"]), np.array(row["roots"]), np.array(row["basis"]).reshape(d, d))


def _spectra(d: int):
    def spectra(batches):
        own = Spectrum.empty(d)
        for batch in batches:
            own.add(_matrix(batch))
        if own.n:
            yield pa.RecordBatch.from_pydict(_row(TaskContext.get().partitionId(), own), _ROW)

    return spectra


def _combine(key, rows: pa.Table) -> pa.Table:
    parts = [_spectrum(r) for r in rows.sort_by("_node").to_pylist()]
    for other in parts[1:]:
        parts[0].take(other)
    return pa.Table.from_pydict(_row(key[0].as_py(), parts[0]), _ROW)


def _products(n: int, sums: list[int], basis: np.ndarray):
    def products(batches):
        d = len(sums)
        total = np.zeros((d, d))
        for batch in batches:
            y = centred(_matrix(batch), n, sums)[0] @ basis
            total += y.T @ y
        yield pa.RecordBatch.from_pydict({"_node": [TaskContext.get().partitionId()], "m": [total.ravel().tolist()]}, pa.schema([("_node", pa.int64()), ("m", pa.list_(pa.float64()))]))

    return products


def _sum(key, rows: pa.Table) -> pa.Table:
    rows = rows.sort_by("_node")
    total = reduce(np.add, (np.array(m) for m in rows.column("m").to_pylist()))
    return pa.table({"_node": pa.array([key[0].as_py()], pa.int64()), "m": pa.array([total.tolist()], pa.list_(pa.float64()))})


def centred(x: np.ndarray, n: int, sums: list[int]) -> tuple[np.ndarray, list[int]]:
    """x - S/n in doubles, and the exact sum of (n*x - S)^2 of each row."""
    most = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) * n + max(map(abs, sums), default=0)
    if most * most * max(1, len(sums)) < 1 << 63:
        apart = x * n - np.array(sums, np.int64)
        return apart / n, (apart * apart).sum(1).tolist()
    apart = x.astype(object) * n - np.array(sums, object)
    return (apart / n).astype(np.float64), (apart * apart).sum(1).tolist()


def _tree(rows: DataFrame, merge, schema: str, work: Work, name: str) -> dict | None:
    """Rows numbered in _node, merged ``FAN_IN`` at a time until one is left."""
    rows = work.save(rows, f"{name}0")
    nodes, level = rows.count(), 0
    while nodes > 1:
        level += 1
        up = rows.withColumn("_up", F.floor(F.col("_node") / FAN_IN).cast("bigint"))
        rows = work.save(up.groupBy("_up").applyInArrow(lambda key, t: merge(key, t.drop(["_up"])), schema), f"{name}{level}")
        nodes = rows.count()
    return next((r.asDict() for r in rows.take(1)), None)


@dataclass
class Model:
    """Exact count and sums, components (columns) by falling eigenvalue, the eigenvalues and their sum."""

    n: int
    sums: list[int]
    components: np.ndarray
    values: np.ndarray
    trace: float


def fit(x: DataFrame, d: int, work: Work, name: str = "fit") -> Model:
    """The components of vectors (_x array<bigint>) that all have ``d`` entries."""
    whole = _spectrum(_tree(x.select("_x").mapInArrow(tidy(_spectra(d)), SPECTRUM), _combine, SPECTRUM, work, f"{name}_spectra"))
    basis = np.linalg.qr(whole.basis)[0]  # many updates leave it orthonormal but for rounding
    products = x.select("_x").mapInArrow(tidy(_products(whole.n, whole.sums, basis)), "_node bigint, m array<double>")
    projected = np.array(_tree(products, _sum, "_node bigint, m array<double>", work, f"{name}_products")["m"]).reshape(d, d) / whole.n
    values, turn = np.linalg.eigh((projected + projected.T) / 2)
    return Model(whole.n, whole.sums, (basis @ turn)[:, ::-1], values[::-1], float(np.trace(projected)))


def _whiten(model: Model, k: int):
    flat = model.values[:k] <= FLAT * model.trace
    scale = 1 / np.sqrt(np.where(flat, 1, model.values[:k]))

    def whiten(batches):
        for batch in batches:
            apart, squares = centred(_matrix(batch), model.n, model.sums)
            out = apart @ model.components[:, :k] * scale
            mask = np.broadcast_to(flat, out.shape).ravel()
            values = pa.array(out.ravel(), pa.float64(), mask=mask)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, out.size + 1, k), pa.int32()), values)
            exact = pa.array([s if s < 10**38 else None for s in squares], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), exact, lists], ["vec_id", "deviation", "whitened"])

    return whiten


def _identity_error(white: DataFrame, n: int, used: list[int]) -> float:
    """Largest entry of the whitened columns' covariance minus the identity."""
    at = lambda i: F.get("whitened", F.lit(i))
    pairs = [(i, j) for i in used for j in used if i <= j]
    if not pairs:
        return 0.0
    means = white.agg(*[F.avg(at(i)).alias(f"m{i}") for i in used]).first()
    centred_ = {i: at(i) - F.lit(float(means[f"m{i}"])) for i in used}
    sums = white.agg(*[F.sum(centred_[i] * centred_[j]).alias(f"s{i}_{j}") for i, j in pairs]).first()
    return max(abs(sums[f"s{i}_{j}"] / n - (i == j)) for i, j in pairs)


def longs(vectors: DataFrame, column: str = "embedding", scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """vec_id and _x, the vector in longs, of the rows that take part."""
    bad = lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf"))
    held = lambda c: F.greatest(F.least(c.cast("double") * scale, F.lit(float(MOST))), F.lit(float(-MOST)))
    usable = vectors.select("vec_id", F.col(column).alias("_v")).filter(F.col("_v").isNotNull()).filter(~F.exists("_v", bad))
    return usable.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.transform("_v", lambda c: F.floor(held(c)).cast("bigint") + shift).alias("_x")
    )


def whiten(vectors: DataFrame, k: int = COMPONENTS, column: str = "embedding", scale: int = SCALE, shift: int = SHIFT, work: Work | None = None) -> DataFrame:
    """Per row that takes part: vec_id, n, deviation, whitened (array of up to ``k``), explained (array) and identity_error."""
    spark = vectors.sparkSession
    work = work or Work(spark, "whitening")
    x = work.save(longs(vectors, column, scale, shift), "longs")
    lengths = sorted(r["d"] for r in x.select(F.size("_x").alias("d")).distinct().collect() if r["d"])
    out = spark.createDataFrame([], "vec_id bigint, n bigint, deviation decimal(38,0), whitened array<double>, explained array<double>, identity_error double")
    for d in lengths:
        own = x.filter(F.size("_x") == d)
        parts = -(-own.count() // ROWS_PER_TASK)
        if own.rdd.getNumPartitions() < parts:
            own = own.repartition(parts)
        model = fit(own, d, work, f"fit{d}")
        few = min(k, d)
        white = work.save(
            own.mapInArrow(tidy(_whiten(model, few)), "vec_id bigint, deviation decimal(38,0), whitened array<double>"), f"white{d}"
        )
        used = [i for i in range(few) if model.values[i] > FLAT * model.trace]
        explained = [float(e / model.trace) if model.trace > 0 else 0.0 for e in model.values[:few]]
        out = out.unionAll(white.select(
            "vec_id", F.lit(model.n).cast("bigint").alias("n"), "deviation", "whitened", F.array(*map(F.lit, explained)).alias("explained"),
            F.lit(_identity_error(white, model.n, used)).alias("identity_error"),
        ))
    return out
