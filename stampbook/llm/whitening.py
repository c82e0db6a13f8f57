"""Whitening of embeddings along their principal components, found by mixed-precision refinement.

The covariance is summed in exact integers by Spark; its d x d matrix is solved in single precision, and the
eigenvectors are corrected by matrix multiplications in higher precision until they hold to double precision.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stampbook.llm import arrays as A
from stampbook.llm.columns import spread

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
LARGEST = float(1 << 24)  # larger entries could leave the exact integers
MOST_STEPS = 30
WIDE = np.longdouble

_EXACT = 1 << 53  # a product of doubles below it is exact
_LIMB = 48
_GROUPS = 256


def _integers(column: pa.Array) -> np.ndarray:
    """The vectors of a batch as rows of longs floor(1024 c) + 100000; they all have one length."""
    flat = np.asarray(column.flatten(), np.float64)
    return (np.floor(flat * SCALE).astype(np.int64) + SHIFT).reshape(len(column), len(flat) // max(1, len(column)))


def _limbs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two longs for each integer, value = high * 2^48 + low, so that sums of a group of either never overflow."""
    return (values >> _LIMB).astype(np.int64), (values & ((1 << _LIMB) - 1)).astype(np.int64)


def _record(key: int, values: np.ndarray) -> dict:
    high, low = _limbs(values)
    return {"key": key, "high": high, "low": low}


_SUMS = "key int, high array<long>, low array<long>"
_SUMS_ARROW = pa.schema([("key", pa.int32()), ("high", pa.list_(pa.int64())), ("low", pa.list_(pa.int64()))])


def _batch(records: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(records, _SUMS_ARROW)


def _added(parts: DataFrame) -> DataFrame:
    """The sum of all rows of one key, in two steps so that no group holds a row of every task."""

    def add(table: pa.Table) -> pa.Table:
        total = {c: np.sum([np.asarray(x.values) for chunk in table[c].chunks for x in chunk], axis=0) for c in ("high", "low")}
        carry = total["low"] >> _LIMB
        record = {"key": table["key"][0].as_py(), "high": total["high"] + carry, "low": total["low"] - (carry << _LIMB)}
        return pa.Table.from_pylist([record], _SUMS_ARROW)

    salted = parts.withColumn("_part", F.pmod(F.spark_partition_id(), F.lit(_GROUPS)))
    return salted.groupBy("key", "_part").applyInArrow(add, _SUMS).groupBy("key").applyInArrow(add, _SUMS)


def _whole(row) -> np.ndarray:
    return np.array([(h << _LIMB) + low for h, low in zip(row["high"], row["low"], strict=True)], object)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each length of vectors: the sums of the entries, then the number of vectors."""
    for batch in batches:
        sizes = np.asarray(batch["v"].value_lengths())
        records = []
        for size in np.unique(sizes):
            x = _integers(batch["v"].filter(pa.array(sizes == size)))
            records.append(_record(int(size), np.append(x.sum(axis=0), len(x))))
        yield _batch(records)


def _products(middle: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sums of the products of all pairs of centred entries, one row of the matrix each; exact."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, bound = np.zeros((len(middle), len(middle)), np.int64), 0
        for batch in batches:
            y = _integers(batch["v"]) - middle
            largest = max(1, int(np.abs(y).max(initial=0)))
            if largest * largest >= _EXACT:
                y = y.astype(object)  # very large entries: integers without a limit
                yield _batch([_record(i, row) for i, row in enumerate(y.T @ y)])
                continue
            rows = max(1, _EXACT // (largest * largest))
            for a in range(0, len(y), rows):
                part = y[a : a + rows].astype(np.float64)
                bound += len(part) * largest * largest
                if bound >= 1 << 62:
                    yield _batch([_record(i, row) for i, row in enumerate(total)])
                    total, bound = np.zeros_like(total), len(part) * largest * largest
                total += (part.T @ part).astype(np.int64)
        yield _batch([_record(i, row) for i, row in enumerate(total)])

    return of


def _covariance(products: np.ndarray, sums: np.ndarray, n: int) -> np.ndarray:
    """Of integers centred by an integer: products / n less the rest of the mean, rounded once."""
    square = n * n
    return np.array([[(n * products[i, j] - sums[i] * sums[j]) / square for j in range(len(sums))] for i in range(len(sums))], np.float64)


def _clusters(values: np.ndarray, gap: float) -> list[np.ndarray]:
    """Numbers of the eigenvalues that no gap parts from one another, for each such run of two or more."""
    order = np.argsort(values)
    runs = np.split(order, np.flatnonzero(np.diff(values[order]) > gap) + 1)
    return [run for run in runs if len(run) > 1]


def refined_eigenvectors(matrix: np.ndarray, steps: int = MOST_STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix, to double precision.

    Single-precision eigenvectors X are corrected by X + X E (Ogita and Aishima): with R = I - X'X, S = X'AX
    and the values S_ii / (1 - R_ii), E_ij is (S_ij + value_j R_ij) / (value_j - value_i), or R_ij / 2 where the
    values lie closer than the error of S and R can tell. Such clusters are solved on their own: X_J is turned
    by the eigenvectors of X_J'(A - mean I)X_J, whose entries are as small as the cluster is wide. The error
    squares in each step; the loop ends when it falls no longer.
    """
    size = len(matrix)
    scale = float(np.abs(matrix).max(initial=0)) or 1.0
    a = (matrix / scale).astype(WIDE)
    x = np.linalg.eigh((matrix / scale).astype(np.float32))[1].astype(WIDE)
    one, width, last = np.eye(size, dtype=WIDE), float(np.linalg.norm(a.astype(np.float64), 2)), np.inf
    best = x, np.diag(x.T @ a @ x)
    for _ in range(steps):
        r = one - x.T @ x
        s = x.T @ (a @ x)
        values = np.diag(s) / (1 - np.diag(r))
        error = float(np.linalg.norm((s - np.diag(values)).astype(np.float64), 2)) + width * float(np.linalg.norm(r.astype(np.float64), 2))
        if error < last:
            best = x, values
        if error >= last / 2 and error < 1e-14 * max(width, 1e-300) or error == 0:
            break
        last = min(last, error)
        apart = values[None, :] - values[:, None]
        near = np.abs(apart) <= 2 * error
        e = np.where(near, r / 2, (s + values[None, :] * r) / np.where(near, 1, apart))
        x = x + x @ e
        for run in _clusters(values, 2 * error):
            inner, mean = x[:, run], values[run].mean()
            small = inner.T @ (a @ inner) - mean * (inner.T @ inner)
            size_ = float(np.abs(small).max()) or 1.0
            turn = np.linalg.eigh(((small + small.T) / (2 * size_)).astype(np.float64))[1]
            x[:, run] = inner @ turn.astype(WIDE)
    x, values = best
    order = np.argsort(-values, kind="stable")
    x = x[:, order] / np.sqrt((x[:, order] ** 2).sum(axis=0))
    sign = np.sign(x[np.abs(x).argmax(axis=0), np.arange(size)]) if size else np.zeros(0)
    return (values[order] * scale).astype(np.float64), (x * np.where(sign == 0, 1, sign)).astype(np.float64)


def _projected(middle: np.ndarray, rest: np.ndarray, exact_rest: np.ndarray, n: int, axes: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """deviation and the whitened components of each vector."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = _integers(batch["v"]) - middle
            largest = n * int(np.abs(y).max(initial=0)) + max(int(abs(x)) for x in exact_rest)
            from_mean = y * n - exact_rest.astype(np.int64) if largest * largest * len(middle) < 1 << 63 else y.astype(object) * n - exact_rest
            deviation = (from_mean * from_mean).sum(axis=1)
            wide = pa.array(deviation).cast(pa.decimal128(38, 0)) if deviation.dtype == np.int64 else pa.array([int(v) if v < 10**38 else None for v in deviation], pa.decimal128(38, 0))
            z = (y - rest) @ axes
            lists = pa.FixedSizeListArray.from_arrays(pa.array(z.ravel()), z.shape[1]).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_pydict({"_row": A.loose(batch["_row"]), "deviation": wide, "z": lists})

    return of


def _usable(vector: Column) -> Column:
    return vector.isNotNull() & F.coalesce(F.forall(vector, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) <= LARGEST), F.lit(False))), F.lit(False))


def whiten(vectors: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """All columns but the vector, and n, deviation, components: an array of (component, whitened, explained), identity_error.

    Each entry c counts as the integer floor(1024 c) + 100000. deviation is the exact sum of (n x - S)^2 over the
    dimensions (null from 10^38). whitened is the distance from the mean along a component, over its standard deviation; all rows
    use the same components, numbered by falling eigenvalue, whose entry of greatest size is positive.
    Rows without a vector, or with null, infinite or NaN entries, or entries beyond 2^24 in size, are dropped
    and count for nothing; so are vectors of another length than the most frequent one (the shorter of two as
    frequent). Directions in which the vectors don't differ have no component; if they differ in none, and for
    an empty table, there are no rows. Repeated rows count and are returned as often as they occur.
    """
    vector = F.col(f"`{column}`").cast("array<double>")
    others = [F.col(f"`{c}`") for c in vectors.columns if c.lower() != column.lower()]
    rows = vectors.where(_usable(vector)).select(F.struct(*(others or [F.lit(None).cast("int").alias("_none")])).alias("_row"), vector.alias("v"))
    kind = rows.schema["_row"].dataType.simpleString()
    schema = f"_row {kind}, deviation decimal(38,0), z array<double>"
    names = ("n", "deviation", "components", "identity_error")

    totals = _added(rows.select("v").mapInArrow(_sums, _SUMS)).select("*", F.element_at("low", -1))
    found = totals.withColumnRenamed(totals.columns[-1], "n").where("key > 0").orderBy(F.desc("n"), "key").limit(1).collect()
    axes = np.zeros((0, 0))
    if found:
        exact = _whole(found[0])
        n, sums, size = int(exact[-1]), exact[:-1], len(exact) - 1
        middle = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)  # the mean, rounded
        exact_rest = np.array([s - n * int(m) for s, m in zip(sums, middle, strict=True)], object)
        rest = np.array([r / n for r in exact_rest], np.float64)
        rows = rows.where(F.size("v") == size)
        products = np.zeros((size, size), object)
        for r in _added(rows.select("v").mapInArrow(_products(middle), _SUMS)).collect():  # one row for each dimension
            products[r["key"]] = _whole(r)
        values, axes = refined_eigenvectors(_covariance(products, exact_rest, n))
        many = min(components, int((values > size * 1e-16 * max(values[0], 0)).sum()))
        explained, axes = (values / values.sum() if many else values)[:many], axes[:, :many] / np.sqrt(values[:many]) if many else axes[:, :0]
    if not axes.size:
        empty = "array<struct<component:int,whitened:double,explained:double>>"
        none = rows.select("_row", F.lit(0).cast("long").alias("n"), F.lit(0).cast("decimal(38,0)").alias("deviation"), F.array().cast(empty).alias("components"), F.lit(0.0).alias("identity_error"))
        return spread(none.where(F.lit(False)), "_row", *names) if others else spread(none.where(F.lit(False)), "_row", *names).drop("_none")

    projected = rows.mapInArrow(_projected(middle, rest, exact_rest, n, axes), schema)
    pairs = list(combinations_with_replacement(range(many), 2))
    covariances = projected.agg(*[F.covar_pop(F.get("z", F.lit(i)), F.get("z", F.lit(j))).alias(f"c{i}_{j}") for i, j in pairs]).first()
    error = max(abs(covariances[f"c{i}_{j}"] - (i == j)) for i, j in pairs)
    each = F.transform("z", lambda z, i: F.struct((i + 1).cast("int").alias("component"), z.alias("whitened"), F.get(F.array(*[F.lit(float(x)) for x in explained]), i).alias("explained")))
    out = projected.select("_row", F.lit(n).cast("long").alias("n"), "deviation", each.alias("components"), F.lit(float(error)).alias("identity_error"))
    return spread(out, "_row", *names) if others else spread(out, "_row", *names).drop("_none")


def op13(embeddings: DataFrame) -> DataFrame:
    """One row for each vector and component; a deviation beyond a long is null (the operator's is a decimal)."""
    found = whiten(embeddings.select("vec_id", "embedding"))
    parts = found.select("vec_id", "n", F.expr("try_cast(deviation AS bigint)").alias("deviation"), "identity_error", F.explode("components").alias("_c"))
    return parts.select("vec_id", "_c.component", "n", "deviation", "_c.whitened", "_c.explained", "identity_error")
