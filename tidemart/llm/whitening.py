"""Whitening of embeddings along their principal axes, from factors of the centred rows.

Vectors become whole numbers, so sums and centred numerators are exact.  The distinct vectors are centred and
factored in blocks; the triangular factors of the blocks are stacked and factored again until one is
left.  That one small matrix, as wide as the vectors, has the singular values and right vectors of
all rows (`bidiagonal`), which give the whitening directions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from tidemart.llm.bidiagonal import right_vectors
from tidemart.llm.grams import small_batches
from tidemart.llm.text import stored

#: A vector entry counts this many steps per unit.
STEPS = 256
COMPONENTS = 4
#: Triangular factors that one task stacks.
FAN_IN = 64
#: Whole numbers that may pass this are taken without limit of size, one by one.
SAFE = 1 << 62


def with_steps(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """Add `x`, the entries times `STEPS`, floored, to rows whose vector has neither nulls nor non-finite entries.

    Other rows are left out, and so are empty vectors and those of another length than most have (of equally
    many, the longer): they share no axes with the rest.  Steps beyond a long count as its ends.
    """
    entries = F.transform(F.col(vector), lambda c: c.cast("double"))
    fine = F.forall(entries, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    usable = rows.where(F.col(vector).isNotNull()).where(fine & (F.size(vector) > 0))
    lengths = usable.groupBy(F.size(vector).alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    return usable.where(F.size(vector) == (lengths["d"] if lengths else 0)).withColumn(
        "x", F.transform(entries, lambda c: F.floor(c * STEPS).cast("long")))


def matrix(column: pa.Array) -> np.ndarray:
    """A list column without nulls as rows of whole numbers."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, total = 0, 0
    for batch in batches:
        if batch.num_rows:
            x = matrix(batch.column("x"))
            x = x if _reach(x, batch.num_rows) < SAFE else x.astype(object)
            n, total = n + batch.num_rows, total + x.sum(axis=0).astype(object)
    if n:
        yield pa.RecordBatch.from_pydict({
            "n": [n], "total": pa.array([[Decimal(t) for t in total]], pa.list_(pa.decimal128(38, 0)))})


def _reach(x: np.ndarray, times: int) -> int:
    return times * max(int(x.max(initial=0)), -int(x.min(initial=0)), 1)


def _numerators(x: np.ndarray, n: int, total: list[int]) -> np.ndarray:
    """n * x - total, exact: as numbers of 64 bits if they fit, else without limit of size."""
    if _reach(x, n) + max(map(abs, total)) < SAFE:
        return n * x - np.array(total, np.int64)
    return x.astype(object) * n - np.array(total, object)


def _centred(x: np.ndarray, n: int, total: list[int]) -> np.ndarray:
    """x minus the mean, rounded once."""
    return (_numerators(x, n, total) / n).astype(np.float64)


def _triangle(rows: np.ndarray) -> np.ndarray:
    """The triangular factor R of a QR factorisation, filled up to a square."""
    r = np.linalg.qr(rows, mode="r")
    return np.vstack((r, np.zeros((r.shape[1] - len(r), r.shape[1])))) if len(r) < r.shape[1] else r


def _factor(n: int, total: list[int]) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def factor(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = None
        for batch in batches:
            if batch.num_rows:
                own = _centred(matrix(batch.column("x")), n, total)
                r = _triangle(own if r is None else np.vstack((r, own)))
        if r is not None:
            yield pa.RecordBatch.from_pydict({"block": [TaskContext.get().partitionId()], "r": [r.ravel().tolist()]})
    return factor


def _stack(blocks: pa.Table) -> pa.Table:
    d = int(np.sqrt(len(blocks.column("r")[0])))
    rows = np.vstack([np.array(r).reshape(d, d) for r in blocks.sort_by("block").column("r").to_pylist()])
    return pa.table({"block": [blocks.column("block")[0].as_py() // FAN_IN], "r": [_triangle(rows).ravel().tolist()]})


@dataclass
class Whitener:
    """What whitening needs: counts and sums of the fit list, axes over the roots of their variances, and shares."""

    n: int
    total: list[int]
    axes: np.ndarray
    explained: list[float]
    identity_error: float = 0.0


def fit(steps: DataFrame, components: int = COMPONENTS) -> Whitener:
    """The largest `components` axes of the distinct vectors `x`, each counted once; variances have the divisor n.

    Axes without variance, up to rounding, are left out: a single distinct vector has none.  The driver gets one sum
    and one triangle as wide as the vectors, whatever the number of rows.
    """
    small_batches(steps.sparkSession)
    distinct = stored(steps.select("x").distinct(), "distinct")
    sums = distinct.mapInArrow(_sums, "n long, total array<decimal(38,0)>")
    n = sums.agg(F.sum("n")).first()[0] or 0
    if not n:
        return Whitener(0, [], np.zeros((0, 0)), [])
    by_place = sums.select(F.posexplode("total").alias("at", "s")).groupBy("at").agg(F.sum("s").alias("s"))
    total = [int(r["s"]) for r in sorted(by_place.collect(), key=lambda r: r["at"])]
    blocks = stored(distinct.mapInArrow(_factor(n, total), "block long, r array<double>"), "triangles")
    while (left := blocks.count()) > 1:
        group = F.floor(F.col("block") / FAN_IN) if left > FAN_IN else F.col("block") * 0
        blocks = stored(blocks.groupBy(group).applyInArrow(_stack, "block long, r array<double>"), "triangles")
    d = len(total)
    triangle = np.array(blocks.first()["r"]).reshape(d, d)
    squares, axes = right_vectors(triangle, components)
    found = Whitener(n, total, axes / np.sqrt(squares / n), (squares / np.square(triangle).sum()).tolist())
    found.identity_error = _identity_error(distinct, found)
    return found


def _identity_error(distinct: DataFrame, fitted: Whitener) -> float:
    """The largest entry, without sign, of the whitened fit list's covariance minus the identity."""
    k = fitted.axes.shape[1]
    if not k:
        return 0.0

    def moments(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # products about the origin: the rows are centred already, and their mean's rounding is taken off below
        first, second = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            if batch.num_rows:
                y = _centred(matrix(batch.column("x")), fitted.n, fitted.total) @ fitted.axes
                first, second = first + y.sum(axis=0), second + y.T @ y
        yield pa.RecordBatch.from_pydict({"m": [np.concatenate((first, second.ravel())).tolist()]})

    parts = distinct.mapInArrow(moments, "m array<double>").select(F.posexplode("m").alias("at", "m"))
    m = np.array([r["m"] for r in sorted(parts.groupBy("at").agg(F.sum("m").alias("m")).collect(), key=lambda r: r["at"])]) / fitted.n
    covariance = m[k:].reshape(k, k) - np.outer(m[:k], m[:k])
    return float(np.abs(covariance - np.eye(k)).max())


def _deviations(x: np.ndarray, n: int, total: list[int]) -> list[int | None]:
    """The sum over dimensions of (n * x - total)^2, exact; null beyond the range of a long."""
    parts = _numerators(x, n, total)
    if parts.dtype == object or _reach(parts, 1) ** 2 * parts.shape[1] >= SAFE:
        exact = np.square(parts.astype(object)).sum(axis=1).tolist()
        return [v if v < 1 << 63 else None for v in exact]
    return np.square(parts).sum(axis=1).tolist()


def whiten(steps: DataFrame, fitted: Whitener) -> DataFrame:
    """One row per row of `steps` and component: its columns but `x`, then `component` (from 1), `n`, `deviation`
    (from the mean, times n squared), `whitened`, `explained` (share of the trace) and `identity_error`.

    Every row is whitened, repeated ones as often as they come; rows are not shuffled.  Columns of these names are
    replaced.  Without variance there is no component, and without components there are no rows.
    """
    added = [("component", T.IntegerType()), ("n", T.LongType()), ("deviation", T.LongType()), ("whitened", T.DoubleType()),
             ("explained", T.DoubleType()), ("identity_error", T.DoubleType())]
    kept = [c for c in steps.columns if c != "x" and c not in dict(added)]
    schema = T.StructType([*(steps.schema[c] for c in kept), *(T.StructField(c, kind) for c, kind in added)])
    k = len(fitted.explained)

    def project(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows or not k:
                continue
            x = matrix(batch.column("x"))
            y = _centred(x, fitted.n, fitted.total) @ fitted.axes
            rows = pa.array(np.repeat(np.arange(len(x)), k))
            deviation = pa.array(_deviations(x, fitted.n, fitted.total), pa.int64())
            yield pa.RecordBatch.from_arrays([
                *(batch.column(c).take(rows) for c in kept), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                pa.array(np.full(len(rows), fitted.n)), deviation.take(rows), pa.array(y.ravel()),
                pa.array(np.tile(fitted.explained, len(x))), pa.array(np.full(len(rows), fitted.identity_error))], schema.names)

    return steps.select(*kept, "x").mapInArrow(project, schema)
