"""Embedding whitening: pivoted Cholesky of the centred scatter, one-sided Jacobi on its factor.

Vectors are put on a grid of 1/``GRID`` (``floor(GRID * c)``), and the fit list holds every distinct
grid vector once, so repeated vectors do not pull the axes. Three passes over the fit list, each one
aggregation of small partial results per task: its size and sums; the scatter of the vectors minus
their mean; the covariance of the whitened fit list, which states how far it is from the identity.
Only the scatter, whose size is the square of the dimension and not of the rows, is solved on the
driver: a Cholesky factor with complete pivoting stops at the numerical rank, and plane rotations make
the columns of that triangular factor orthogonal. The factor is never multiplied out: its rotated
columns' squared norms are the eigenvalues and the columns over their norms the components, with a
relative precision that an eigenvalue routine on the scatter does not give for the small ones.

Scale: equal vectors are combined before the one shuffle, which moves distinct vectors by the hash of
their whole content, so a vector that fills a third of the rows costs nothing more. Application is a
map over all rows.

Defined results: a row whose vector is null, or holds null or non-finite entries, is left out. The
dimension is a parameter; by default the one most rows have (the larger of two equally common), and
rows of another are left out. Grid values beyond 64 bits are held at its ends. Components without
spread (beyond the rank of the scatter) are not returned: a single distinct vector, or no row at all,
gives no rows. A deviation beyond 64 bits is null. Repeated rows and null ids are rows of their own.
Extra columns are left alone.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tillroll.llm.common import written

GRID = 256
LONG = 2**63 - 1


@dataclass(frozen=True)
class Whitening:
    """What a fit knows; rows of ``components`` are unit vectors, by falling eigenvalue."""

    n: int
    sums: list[int]
    eigenvalues: np.ndarray
    components: np.ndarray
    trace: float


def pivoted_cholesky(scatter: np.ndarray) -> np.ndarray:
    """(d, rank) factor L with ``L @ L.T == scatter``: lower triangular up to the order of its rows."""
    left, d = np.array(scatter, dtype=np.float64), len(scatter)
    factor = np.zeros((d, d))
    floor = np.finfo(np.float64).eps * d * max(left.diagonal().max(initial=0.0), 0.0)
    open_rows = np.arange(d)
    for k in range(d):
        pivot = open_rows[np.argmax(left.diagonal()[open_rows])]
        if left[pivot, pivot] <= floor:
            return factor[:, :k]
        open_rows = open_rows[open_rows != pivot]
        root = np.sqrt(left[pivot, pivot])
        factor[pivot, k] = root
        factor[open_rows, k] = left[open_rows, pivot] / root
        left[np.ix_(open_rows, open_rows)] -= np.outer(factor[open_rows, k], factor[open_rows, k])
    return factor


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, components) of ``factor @ factor.T``: rotate its columns until all are orthogonal."""
    columns = np.array(factor.T)  # a row each, so that a rotation touches two stretches of memory
    r = len(columns)
    for _ in range(sweeps):
        rotated = False
        for i in range(r - 1):
            for j in range(i + 1, r):
                a, b = columns[i], columns[j]
                aa, bb, ab = a @ a, b @ b, a @ b
                if abs(ab) <= 1e-15 * np.sqrt(aa * bb):
                    continue
                rotated = True
                zeta = (bb - aa) / (2.0 * ab)
                t = np.copysign(1.0, zeta) / (abs(zeta) + np.hypot(1.0, zeta))
                c = 1.0 / np.hypot(1.0, t)
                columns[i], columns[j] = c * a - c * t * b, c * t * a + c * b
        if not rotated:
            break
    eigenvalues = np.einsum("ij,ij->i", columns, columns)
    order = np.argsort(-eigenvalues, kind="stable")
    eigenvalues = eigenvalues[order]
    return eigenvalues, columns[order] / np.sqrt(eigenvalues)[:, None]


def _matrix(column: pa.Array) -> np.ndarray:
    """Grid vectors of one batch, a row each."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<i8").reshape(len(column), -1)


def on_grid(
    vectors: DataFrame, dimension: int, id_column: str = "vec_id", vector_column: str = "embedding",
) -> DataFrame:
    """(vec_id, x) of the valid rows, x the grid vector as little-endian 64-bit integers."""
    valid = vectors.select(
        F.col(id_column).alias("vec_id"), F.col(vector_column).cast("array<double>").alias("c")
    ).where(F.size("c") == dimension)

    def run(batches):
        for batch in batches:
            lists = batch.column(1)
            c = lists.flatten().to_numpy(zero_copy_only=False).reshape(len(batch), dimension)
            with np.errstate(invalid="ignore", over="ignore"):
                good = np.isfinite(c).all(axis=1)  # a null entry arrives as not a number
                x = np.floor(GRID * c[good])
            low, high = x < -(2.0**63), x >= 2.0**63
            x = np.where(low | high, 0.0, x).astype("<i8")
            x[low], x[high] = -LONG - 1, LONG
            yield pa.RecordBatch.from_arrays([
                batch.column(0).filter(pa.array(good)),
                pa.array([row.tobytes() for row in x], pa.binary()),
            ], ["vec_id", "x"])

    kind = valid.schema["vec_id"].dataType.simpleString()
    return valid.mapInArrow(run, f"vec_id {kind}, x binary")


def common_dimension(vectors: DataFrame, vector_column: str = "embedding") -> int:
    """The length most vectors have, the larger of equally common ones; 0 without any vector."""
    sizes = vectors.where(F.col(vector_column).isNotNull()).groupBy(
        F.size(vector_column).alias("size")
    ).count()
    row = sizes.agg(F.max(F.struct("count", "size")).alias("most")).first()["most"]
    return row["size"] if row else 0


def _partial_sums(batches, dimension: int):
    n, sums = 0, [0] * dimension
    for batch in batches:
        x = _matrix(batch.column(0))
        n += len(x)
        if len(x) and np.abs(x.astype(np.float64)).max() * len(x) < 2.0**62:
            sums = [a + int(b) for a, b in zip(sums, x.sum(axis=0))]
        else:
            sums = [a + int(b) for a, b in zip(sums, x.astype(object).sum(axis=0))] if len(x) else sums
    at = np.arange(-1, dimension)
    values = [str(v) for v in [n, *sums]]
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(values)], ["at", "value"])


def _partial_products(batches, project, width: int):
    """Upper triangle of the sum of outer products of ``project(x)``."""
    total = np.zeros((width, width))
    for batch in batches:
        if len(batch):
            c = project(_matrix(batch.column(0)))
            total += c.T @ c
    i, j = np.triu_indices(width)
    yield pa.RecordBatch.from_arrays(
        [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], ["i", "j", "value"]
    )


def _summed_products(fit: DataFrame, project, width: int) -> np.ndarray:
    parts = fit.select("x").mapInArrow(
        partial(_partial_products, project=project, width=width), "i int, j int, value double"
    )
    total = np.zeros((width, width))
    # width * (width + 1) / 2 rows, whatever the number of vectors
    for i, j, value in parts.groupBy("i", "j").agg(F.sum("value")).collect():
        total[i, j] = total[j, i] = value
    return total


def centred(x: np.ndarray, mean: np.ndarray) -> np.ndarray:
    return x.astype(np.float64) - mean


def _whiten(x: np.ndarray, mean: np.ndarray, axes: np.ndarray) -> np.ndarray:
    return centred(x, mean) @ axes


def fit(distinct: DataFrame, dimension: int) -> Whitening | None:
    """The whitening of ``distinct(x)``, each grid vector once; None without any spread."""
    parts = distinct.select("x").mapInArrow(
        partial(_partial_sums, dimension=dimension), "at int, value string"
    )
    # Exact in 38 digits; dimension + 1 rows reach the driver.
    rows = parts.groupBy("at").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect()
    known = {r["at"]: int(r["value"]) for r in rows}
    n = known.get(-1, 0)
    if n == 0:
        return None
    sums = [known[k] for k in range(dimension)]
    mean = np.array([s / n for s in sums])
    covariance = _summed_products(distinct, partial(centred, mean=mean), dimension) / n
    factor = pivoted_cholesky(covariance)
    if not factor.shape[1]:
        return None
    eigenvalues, components = one_sided_jacobi(factor)
    return Whitening(n, sums, eigenvalues, components, float(np.trace(covariance)))


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Exact sum over dimensions of ``(n * x - S) ** 2``; null beyond 64 bits."""
    widest = n * int(max(abs(int(x.min())), abs(int(x.max())))) + max(map(abs, sums))
    if widest**2 * x.shape[1] <= LONG:
        away = x * np.int64(n) - np.array(sums, dtype=np.int64)
        return np.einsum("ij,ij->i", away, away).tolist()
    away = x.astype(object) * n - np.array(sums, dtype=object)
    return [d if d <= LONG else None for d in (away * away).sum(axis=1)]


def apply(placed: DataFrame, whitening: Whitening, most: int | None = None) -> DataFrame:
    """(vec_id, deviation, whitened): every row of ``placed(vec_id, x)`` on the first components."""
    k = len(whitening.eigenvalues[:most])
    mean = np.array([s / whitening.n for s in whitening.sums])
    axes = (whitening.components[:k] / np.sqrt(whitening.eigenvalues[:k])[:, None]).T
    n, sums = whitening.n, whitening.sums

    def run(batches):
        for batch in batches:
            if not len(batch):
                continue
            x = _matrix(batch.column(1))
            flat = _whiten(x, mean, axes)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(_deviations(x, n, sums), pa.int64()),
                pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * k, flat.ravel()),
            ], ["vec_id", "deviation", "whitened"])

    kind = placed.schema["vec_id"].dataType.simpleString()
    return placed.mapInArrow(run, f"vec_id {kind}, deviation long, whitened array<double>")


def identity_error(distinct: DataFrame, whitening: Whitening, most: int | None = None) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity."""
    k = len(whitening.eigenvalues[:most])
    mean = np.array([s / whitening.n for s in whitening.sums])
    axes = (whitening.components[:k] / np.sqrt(whitening.eigenvalues[:k])[:, None]).T
    covariance = _summed_products(distinct, partial(_whiten, mean=mean, axes=axes), k) / whitening.n
    return float(np.abs(covariance - np.eye(k)).max())


def whiten(
    vectors: DataFrame, most: int | None = None, dimension: int | None = None,
    id_column: str = "vec_id", vector_column: str = "embedding",
) -> tuple[DataFrame, Whitening | None, float]:
    """(every valid row whitened, the fit, its identity error) on the first ``most`` components."""
    dimension = common_dimension(vectors, vector_column) if dimension is None else dimension
    placed = on_grid(vectors, dimension, id_column, vector_column)
    found = None
    if dimension:
        distinct = written(placed.select("x").distinct(), "fit")
        found = fit(distinct, dimension)
    if found is None:
        kind = placed.schema["vec_id"].dataType.simpleString()
        nothing = vectors.sparkSession.createDataFrame(
            [], f"vec_id {kind}, deviation long, whitened array<double>"
        )
        return nothing, None, 0.0
    return apply(placed, found, most), found, identity_error(distinct, found, most)


def op11_whitening(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows, found, error = whiten(vectors, most=4)
    shares = (found.eigenvalues[:4] / found.trace).tolist() if found else []
    each = rows.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return each.select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"),
        F.lit(found.n if found else 0).cast("long").alias("n"), "deviation", "whitened",
        F.get(F.lit(shares).cast("array<double>") if shares else F.array().cast("array<double>"),
              F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
