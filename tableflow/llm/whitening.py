"""Embedding whitening from a weighted covariance of the distinct vectors.

Vectors become whole numbers on a grid (``floor(scale * c) + offset`` of every entry), so that nearly equal
ones are one vector. Equal vectors are grouped first, map-side too, so a vector that a third of all rows have
reaches its group as a few rows. The distinct vectors, each weighted by one or by its multiplicity, give exact sums
per dimension; their covariance is a weighted, centred GEMM of every task over its batches, and tasks'
moments are merged in a tree. The eigenvectors are found on the driver, from a matrix whose size the
dimension alone decides (``MOST_DIMENSIONS`` at most). Each distinct vector is projected once, and rows
get the result back by a join on 128 bits of their vector's hash, which adaptive execution can split
where a vector is hot. How far the whitened vectors' covariance is from the identity is measured, not assumed.

Defined cases: rows whose vector is null, empty, or holds a null or non-finite entry are dropped, and so
are those with an entry whose grid value passes 2^52, and vectors of another length than most distinct ones
have (the longer on a tie). Every other row is reported, repeated ids and null ids too. Only components with an eigenvalue above
``LEAST_EIGENVALUE`` of the greatest are returned, since others cannot be whitened: none for a single distinct
vector or an empty table. The greatest entry of a component is positive (the first of equal ones); components with equal
eigenvalues are one basis of many. A deviation that passes 2^63 is null. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableflow.llm.shared import stored

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 16
MOST_DIMENSIONS = 2048
LEAST_EIGENVALUE = 1e-10
#: partial results that one task merges
FAN = 16

_MOMENTS = "task long, weight double, mean array<double>, scatter array<double>"


def grid_vector(vector: str, scale: int, offset: int) -> Column:
    """The vector's entries on the grid; null if it has none or one that has no place there."""
    entries = F.col(vector)
    most = float(2**52)
    fits = F.forall(entries, lambda c: F.coalesce(F.abs(c.cast("double") * scale) < most, F.lit(False)))
    on_grid = F.transform(entries, lambda c: F.floor(c.cast("double") * scale) + F.lit(offset).cast("long"))
    return F.when((F.size(entries) > 0) & fits, on_grid)


def _names(x: str) -> list[Column]:
    """128 bits that name a vector."""
    return [F.xxhash64(x).alias("key"), F.xxhash64(F.lit(1), x).alias("more")]


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column without nulls, all of one length."""
    return column.flatten().to_numpy().reshape(-1, width)


class Moments:
    """Weight, weighted mean and scatter about it; two are merged without loss of the centring."""

    def __init__(self, weight: float, mean: np.ndarray, scatter: np.ndarray):
        self.weight, self.mean, self.scatter = weight, mean, scatter

    @classmethod
    def of(cls, rows: np.ndarray, weights: np.ndarray) -> Moments:
        total = weights.sum()
        mean = weights @ rows / total
        centred = rows - mean
        return cls(float(total), mean, (centred * weights[:, None]).T @ centred)

    def add(self, other: Moments) -> Moments:
        weight = self.weight + other.weight
        gap = other.mean - self.mean
        mean = self.mean + gap * (other.weight / weight)
        scatter = self.scatter + other.scatter + np.outer(gap, gap) * (self.weight * other.weight / weight)
        return Moments(weight, mean, scatter)

    def row(self, task: int) -> pa.RecordBatch:
        lists = [pa.array([values.tolist()], pa.list_(pa.float64())) for values in (self.mean, self.scatter.ravel())]
        columns = [pa.array([task], pa.int64()), pa.array([self.weight], pa.float64()), *lists]
        return pa.RecordBatch.from_arrays(columns, ["task", "weight", "mean", "scatter"])


def _merged(rows: pa.Table) -> Moments | None:
    """One from all rows, in the order of their tasks."""
    total = None
    for row in rows.sort_by("task").to_pylist():
        width = len(row["mean"])
        own = Moments(row["weight"], np.array(row["mean"]), np.array(row["scatter"]).reshape(width, width))
        total = own if total is None else total.add(own)
    return total


def _merge_rows(rows: pa.Table) -> pa.Table:
    task = rows.column("task")[0].as_py() // FAN
    return pa.Table.from_batches([_merged(rows).row(task)])


def moments(vectors: DataFrame, values: Callable[[pa.RecordBatch], np.ndarray]) -> Moments | None:
    """Moments of ``values`` of the batches, weighted by the column ``weight``; None without rows."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if len(batch):
                own = Moments.of(values(batch), batch.column("weight").to_numpy().astype(np.float64))
                total = own if total is None else total.add(own)
        if total is not None:
            yield total.row(TaskContext.get().partitionId())

    found = vectors.mapInArrow(partial, _MOMENTS)
    tasks = vectors.rdd.getNumPartitions()
    while tasks > FAN:
        found = found.groupBy(F.expr(f"task div {FAN}")).applyInArrow(_merge_rows, _MOMENTS)
        tasks = -(-tasks // FAN)
    return _merged(found.toArrow())


def exact_sums(vectors: DataFrame, width: int) -> tuple[int, list[int]]:
    """Total weight and the weighted sum of each dimension, as whole numbers."""
    cells = vectors.select("weight", F.posexplode("x").alias("at", "x"))
    parts = [F.sum(F.expr(f"weight * {part}")).alias(name) for name, part in (("high", "(x >> 20)"), ("low", "(x & 1048575)"))]
    rows = {row["at"]: (row["high"] << 20) + row["low"] for row in cells.groupBy("at").agg(*parts).collect()}
    total = vectors.agg(F.sum("weight")).first()[0] or 0
    return total, [rows[at] for at in range(width)] if rows else []


def principal(covariance: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as rows) of the components that can be whitened, greatest first."""
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1].T
    good = (values > LEAST_EIGENVALUE * max(values[0], 0)) & (np.arange(len(values)) < most)
    values, vectors = values[good], vectors[good]
    sign = np.sign(vectors[np.arange(len(vectors)), np.abs(vectors).argmax(1)])
    return values, vectors * sign[:, None]


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Exact sum over the dimensions of (n * x - sum)^2 of each row; None if it passes 2^63."""
    floor, rest = (np.array(part, np.int64) for part in zip(*(divmod(s, n) for s in sums)))
    apart = x - floor
    bound = (n * max(int(np.abs(apart).max(initial=0)), 1) + n) ** 2 * len(sums)
    if bound < 2**63:
        return ((n * apart - rest) ** 2).sum(1).tolist()
    exact = [sum((n * a - r) ** 2 for a, r in zip(row, rest.tolist())) for row in apart.tolist()]
    return [value if value < 2**63 else None for value in exact]


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - sum / n in doubles, without loss by the size of x."""
    floor, rest = (np.array(part, np.int64) for part in zip(*(divmod(s, n) for s in sums)))
    return (x - floor).astype(np.float64) - rest / n


def whiten(
    rows: DataFrame,
    id_column: str = "vec_id",
    vector: str = "embedding",
    components: int = COMPONENTS,
    scale: int = SCALE,
    offset: int = OFFSET,
    by_count: bool = False,
) -> DataFrame:
    """id, n, deviation, whitened (array), explained (array), identity_error of every row with a vector.

    ``n`` is the total weight of the fit: of the distinct vectors, or of all rows if ``by_count``.
    """
    gridded = rows.select(F.col(id_column).alias("id"), grid_vector(vector, scale, offset).alias("x"))
    gridded = gridded.where("x is not null")
    weight = F.count("*") if by_count else F.lit(1).cast("long")
    vectors = stored(gridded.groupBy("x").agg(weight.alias("weight")))
    lengths = vectors.groupBy(F.size("x").alias("width")).count()
    most = lengths.orderBy(F.desc("count"), F.desc("width")).first()
    schema = "id {}, n long, deviation long, whitened array<double>, explained array<double>, identity_error double"
    empty = rows.sparkSession.createDataFrame([], schema.format(gridded.schema["id"].dataType.simpleString()))
    if most is None:
        return empty
    width = most["width"]
    if width > MOST_DIMENSIONS:
        raise ValueError(f"vectors of {width} entries; the covariance is kept for up to {MOST_DIMENSIONS}")
    vectors, gridded = (frame.where(F.size("x") == width) for frame in (vectors, gridded))
    n, sums = exact_sums(vectors, width)
    fitted = moments(vectors, lambda batch: _centred(_matrix(batch.column("x"), width), n, sums))
    covariance = fitted.scatter / n
    values, axes = principal(covariance, components)
    if not len(values):
        return empty
    projection = (axes / np.sqrt(values)[:, None]).T
    names = vectors.select(*_names("x"), "x", "weight")

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("x"), width)
            white = _centred(x, n, sums) @ projection
            edges = pa.array(np.arange(len(x) + 1) * white.shape[1], pa.int32())
            columns = [batch.column("key"), batch.column("more"), batch.column("weight")]
            columns.append(pa.array(deviations(x, n, sums), pa.int64()))
            columns.append(pa.ListArray.from_arrays(edges, pa.array(white.ravel())))
            yield pa.RecordBatch.from_arrays(columns, ["key", "more", "weight", "deviation", "whitened"])

    schema = "key long, more long, weight long, deviation long, whitened array<double>"
    white = stored(names.mapInArrow(project, schema))
    measured = moments(white, lambda batch: _matrix(batch.column("whitened"), len(values)))
    error = float(np.abs(measured.scatter / n - np.eye(len(values))).max())
    share = (values / np.trace(covariance)).tolist()
    found = gridded.select("id", *_names("x")).join(white.drop("weight"), ["key", "more"])
    return found.select(
        "id",
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.array(*[F.lit(value) for value in share]).alias("explained"),
        F.lit(error).alias("identity_error"),
    )


def op12_whitening(spark, sf_dir):
    white = whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    cells = white.select("*", F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "cell"))
    return cells.select(
        F.col("id").alias("vec_id"),
        (F.col("at") + 1).alias("component"),
        "n",
        "deviation",
        F.col("cell.whitened").alias("whitened"),
        F.col("cell.explained").alias("explained"),
        "identity_error",
    )
