"""Whitening of embeddings by the covariance of the distinct vectors, weighted by how often they occur.

Every entry c becomes the integer ``floor(1024 * c) + 100000``. Equal integer
vectors are one group, and only groups are worked on: sums, covariance and
projection read each distinct vector once, weighted with its count (or with one).
The rows get their results back by a join.

1. Rows become a packed vector and its 128-bit digest; groups are counted with
   partial aggregation, so a vector that makes up a third of the rows is one row
   per task, and written.
2. Sums per dimension are exact. The covariance is a product of matrices per
   batch, of vectors centred before, added up in a fixed number of buckets.
3. The eigenvectors of one dimension x dimension matrix are found on the driver.
4. Each group is projected once, and the covariance of what came out is measured.
5. Groups of more than a thousandth of all rows (at most a thousand) go back to
   their rows by broadcast, all others by a shuffled join.

Rows: a vector that is null, or holds a null or an entry that isn't finite, takes
no part. The dimension is the length that most other vectors have (ties: the
greater); vectors of another length take no part either. Entries are held at
+-2^62, where a long ends. Null and repeated ids are rows like others. Where the
variance along a component vanishes (less than 1e-13 of the largest), ``whitened``
is null. Empty vectors take no part, and tables without vectors give no rows. Columns other than the two that are
named are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from wrenchline.llm.common import Stages

SCALE, SHIFT = 1024, 100_000
#: Partial matrices are added up in so many groups before the driver adds those.
BUCKETS = 16
#: Groups of more than one part in so many of all rows are broadcast; there are at most as many of them.
HOT_PARTS = 1000
#: Beside the largest eigenvalue a smaller one than this share counts as none.
VANISHING = 1e-13
_LIMIT = float(2**62)
_WIDTHS = (np.int16, np.int32, np.int64)


def pack(lists: pa.ListArray) -> list[bytes | None]:
    """The integer vectors without their shift, each in the narrowest width that holds it after a byte that tells which.

    None for a vector with an entry that is null or not finite. No list is null or empty.
    """
    starts = lists.offsets.to_numpy()
    at, lengths = starts[:-1] - starts[0], np.diff(starts)
    entries = lists.values.to_numpy(zero_copy_only=False)[starts[0] : starts[-1]].astype(np.float64)
    finite = np.isfinite(entries)  # nulls have become nan
    plain = integers(np.where(finite, entries, 0)) - SHIFT
    low, high = np.minimum.reduceat(plain, at), np.maximum.reduceat(plain, at)
    taken = np.logical_and.reduceat(finite, at)
    out: list[bytes | None] = [None] * len(lists)
    for i, width in enumerate(_WIDTHS):
        fits = taken & (low >= np.iinfo(width).min) & (high <= np.iinfo(width).max)
        if fits.any():
            kind = np.dtype(width).newbyteorder("<")
            raw, mark = plain.astype(kind).tobytes(), bytes([i])
            for row in np.flatnonzero(fits).tolist():
                first = at[row] * kind.itemsize
                out[row] = mark + raw[first : first + lengths[row] * kind.itemsize]
        taken &= ~fits
    return out


def unpack(packed: list[bytes]) -> np.ndarray:
    """The integer vectors, one a row."""
    sizes = {len(p) for p in packed}
    if len(sizes) == 1 and len({p[0] for p in packed}) == 1:
        width = np.dtype(_WIDTHS[packed[0][0]]).newbyteorder("<")
        bytes_ = np.frombuffer(b"".join(packed), dtype=np.uint8).reshape(len(packed), -1)
        return np.ascontiguousarray(bytes_[:, 1:]).view(width).astype(np.int64) + SHIFT
    rows = [np.frombuffer(p, dtype=np.dtype(_WIDTHS[p[0]]).newbyteorder("<"), offset=1) for p in packed]
    return np.stack([r.astype(np.int64) for r in rows]) + SHIFT


def integers(entries: np.ndarray) -> np.ndarray:
    """floor(1024 * c) + 100000."""
    with np.errstate(over="ignore"):  # ends at the limit
        scaled = np.floor(entries.astype(np.float64) * SCALE)
    return np.clip(scaled, -_LIMIT, _LIMIT).astype(np.int64) + SHIFT


def packed_rows(vectors: DataFrame, id_column: str, column: str) -> DataFrame:
    """Per row that takes part: id, ``size``, ``packed`` and ``digest`` (128 bits of it)."""
    kind = vectors.schema[id_column].dataType.simpleString()

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            packed = pack(batch.column(1))
            keep = [i for i, p in enumerate(packed) if p is not None]
            rows = pa.array(keep, pa.int64())
            packed = [packed[i] for i in keep]
            digests = [hashlib.blake2b(p, digest_size=16).digest() for p in packed]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), batch.column(2).take(rows), pa.array(packed, pa.binary()), pa.array(digests, pa.binary())],
                names=[id_column, "size", "packed", "digest"],
            )

    entries = F.col(column).cast("array<double>").alias("entries")
    source = vectors.select(F.col(id_column), entries, F.size(column).alias("size")).where("size > 0")
    return source.mapInArrow(run, f"`{id_column}` {kind}, size int, packed binary, digest binary")


def group_rows(rows: DataFrame, stages: Stages) -> tuple[DataFrame, int, int]:
    """Distinct vectors of the commonest length with ``n_rows``, their dimension and the number of rows."""
    groups = stages.save(rows.groupBy("size", "packed", "digest").agg(F.count("*").alias("n_rows")), "distinct_vectors")
    lengths = groups.groupBy("size").agg(F.sum("n_rows").alias("n"))
    top = lengths.orderBy(F.desc("n"), F.desc("size")).limit(1).collect()
    dimension, n = (top[0]["size"], top[0]["n"]) if top else (0, 0)
    return groups.where(F.col("size") == dimension), dimension, n


def _weighed(groups: DataFrame, weights: str) -> DataFrame:
    if weights not in ("counts", "one"):
        raise ValueError("weights are 'counts' or 'one'")
    return groups.select("packed", (F.col("n_rows") if weights == "counts" else F.lit(1).cast("bigint")).alias("weight"))


def exact_sums(weighed: DataFrame, dimension: int) -> tuple[int, list[int]]:
    """Sum of the weights and weighted sums per dimension, as whole numbers without rounding.

    A batch whose sums a long may not hold is added up in Python numbers.
    """

    def run(batches: Iterator[pa.RecordBatch]):
        total, sums = 0, [0] * dimension
        for batch in batches:
            if batch.num_rows:
                x = unpack(batch.column(0).to_pylist())
                w = batch.column(1).to_numpy().astype(np.int64)
                total += int(w.sum())
                if max(abs(int(x.max())), abs(int(x.min()))) * int(w.sum()) < 2**62:
                    part = (w @ x).tolist()
                else:
                    part = (w.astype(object) @ x.astype(object)).tolist()
                sums = [a + b for a, b in zip(sums, part, strict=True)]
        yield pa.RecordBatch.from_pydict(
            {"place": pa.array(range(-1, dimension), pa.int32()), "part": pa.array([str(v) for v in (total, *sums)])}
        )

    parts = weighed.mapInArrow(run, "place int, part string")
    rows = parts.groupBy("place").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total")).collect()
    totals = {r.place: int(r.total) for r in rows}
    return totals[-1], [totals[i] for i in range(dimension)]


def deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exact: as longs where they hold it, as Python numbers where not."""
    largest = max(abs(int(x.max())), abs(int(x.min()))) * n + max(map(abs, sums))
    if largest < 2**62:
        return x * n - np.array(sums, dtype=np.int64)
    return x.astype(object) * n - np.array(sums, dtype=object)


def squared_length(dev: np.ndarray) -> list[int]:
    largest = max(abs(int(dev.max())), abs(int(dev.min()))) if dev.size else 0
    if largest * largest * dev.shape[1] < 2**62:
        return (dev * dev).sum(axis=1).tolist()
    wide = dev.astype(object)
    return (wide * wide).sum(axis=1).tolist()


def _added(parts: DataFrame, shape: tuple[int, ...]) -> np.ndarray:
    """Sum of the partial arrays, bucket by bucket and then over the buckets."""

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            for blob in batch.column("blob"):
                total += np.frombuffer(blob.as_py()).reshape(shape)
        yield pa.RecordBatch.from_pydict({"bucket": [key[0].as_py()], "blob": [total.tobytes()]}, _BLOBS)

    total = np.zeros(shape)
    for row in sorted(parts.groupBy("bucket").applyInArrow(run, "bucket int, blob binary").collect()):
        total += np.frombuffer(row.blob).reshape(shape)
    return total


_BLOBS = pa.schema([("bucket", pa.int32()), ("blob", pa.binary())])


def _partial(frame: DataFrame, shape: tuple[int, ...], product) -> np.ndarray:
    """Sums ``product(batch)`` over all batches of all tasks."""

    def run(batches):
        from pyspark import TaskContext

        total = np.zeros(shape)
        for batch in batches:
            if batch.num_rows:
                total += product(batch)
        bucket = TaskContext.get().partitionId() % BUCKETS
        yield pa.RecordBatch.from_pydict({"bucket": [bucket], "blob": [total.tobytes()]}, _BLOBS)

    return _added(frame.mapInArrow(run, "bucket int, blob binary"), shape)


@dataclass(frozen=True)
class Whitener:
    """What is fitted: weight and sums of the fit list, and the leading components of its covariance."""

    n: int
    sums: list[int]
    components: np.ndarray
    variances: np.ndarray
    trace: float

    def whiten(self, x: np.ndarray) -> tuple[np.ndarray, list[int]]:
        """Projections over the standard deviations (nan where there is none), and squared lengths of n * x - S."""
        dev = deviations(x, self.n, self.sums)
        centred = dev.astype(np.float64) / self.n
        with np.errstate(divide="ignore", invalid="ignore"):
            scale = np.where(self.present, 1 / np.sqrt(np.where(self.present, self.variances, 1)), np.nan)
        return (centred @ self.components) * scale, squared_length(dev)

    @property
    def present(self) -> np.ndarray:
        return self.variances > VANISHING * max(float(self.variances.max(initial=0)), 0.0)

    @property
    def explained(self) -> list[float | None]:
        return [float(v) / self.trace if self.trace > 0 else None for v in self.variances]


def fit(groups: DataFrame, dimension: int, n_components: int, weights: str = "counts") -> Whitener:
    """Covariance of the weighted distinct vectors, divisor n, and its leading components."""
    weighed = _weighed(groups, weights)
    n, sums = exact_sums(weighed, dimension)

    def product(batch):
        x = unpack(batch.column(0).to_pylist())
        centred = deviations(x, n, sums).astype(np.float64) / n
        return (centred * batch.column(1).to_numpy()[:, None]).T @ centred

    covariance = _partial(weighed, (dimension, dimension), product) / n
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    order = np.argsort(-values, kind="stable")[:n_components]
    return Whitener(n, sums, vectors[:, order], np.maximum(values[order], 0), float(np.trace(covariance)))


def identity_error(whitened: DataFrame, model: Whitener, weights: str = "counts") -> float | None:
    """Largest entry, in absolute value, of the covariance of ``whitened`` minus the identity."""
    present = np.flatnonzero(model.present)
    if not len(present):
        return None
    k, n = len(present), model.n
    weight = F.col("n_rows") if weights == "counts" else F.lit(1).cast("bigint")
    frame = whitened.select("whitened", weight.alias("weight"))

    def values(batch):
        w = np.array(batch.column(0).to_pylist(), dtype=np.float64)[:, present]
        return w, batch.column(1).to_numpy()

    def total(batch):
        w, count = values(batch)
        return count @ w

    mean = _partial(frame, (k,), total) / n

    def product(batch):
        w, count = values(batch)
        centred = w - mean
        return (centred * count[:, None]).T @ centred

    covariance = _partial(frame, (k, k), product) / n
    return float(np.abs(covariance - np.eye(k)).max())


def _whitened(groups: DataFrame, model: Whitener) -> DataFrame:
    """Per distinct vector: digest, number of rows, squared length of n * x - S, whitened components."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                w, squares = model.whiten(unpack(batch.column(0).to_pylist()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1), batch.column(2), pa.array([str(s) for s in squares]),
                     pa.array([[None if np.isnan(v) else v for v in row] for row in w.tolist()], pa.list_(pa.float64()))],
                    names=["digest", "n_rows", "deviation", "whitened"],
                )

    out = groups.select("packed", "digest", "n_rows").mapInArrow(
        run, "digest binary, n_rows bigint, deviation string, whitened array<double>"
    )
    return out.withColumn("deviation", F.expr("try_cast(deviation as decimal(38,0))"))


def _empty(spark: SparkSession, id_column: str, kind: DataType) -> DataFrame:
    columns = "n bigint, deviation decimal(38,0), whitened array<double>, explained array<double>, identity_error double"
    return spark.createDataFrame([], f"`{id_column}` {kind.simpleString()}, {columns}")


def whiten(
    vectors: DataFrame, spark: SparkSession, n_components: int = 8, weights: str = "counts",
    id_column: str = "vec_id", column: str = "embedding",
) -> DataFrame:
    """One row per row that takes part.

    Columns: the id, ``n`` (weight of the fit list), ``deviation`` (squared length
    of n * x - S as decimal, null beyond 38 digits), ``whitened`` and ``explained``
    (arrays by component), ``identity_error``. With ``weights="one"`` every
    distinct vector counts once in the fit.
    """
    stages = Stages(spark)
    rows = packed_rows(vectors, id_column, column)
    groups, dimension, n_rows = group_rows(rows, stages)
    if not n_rows or not dimension:
        return _empty(spark, id_column, vectors.schema[id_column].dataType)
    model = fit(groups, dimension, n_components, weights)
    results = stages.save(_whitened(groups, model), "whitened_vectors")
    error = identity_error(results, model, weights)
    hot = F.col("n_rows") * HOT_PARTS > n_rows
    keys = rows.where(F.col("size") == dimension).select(id_column, "digest")
    common = F.broadcast(results.where(hot).drop("n_rows"))
    joined = keys.join(common, "digest").unionByName(
        keys.join(common.select("digest"), "digest", "left_anti").join(results.where(~hot).drop("n_rows"), "digest")
    )
    return joined.select(
        id_column,
        F.lit(model.n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.lit([float("nan") if e is None else e for e in model.explained]).cast("array<double>").alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )


def digest(vectors: DataFrame, spark: SparkSession) -> DataFrame:
    """One row per vector and component, with the deviation as a long (null where that cannot hold it)."""
    rows = whiten(vectors, spark)
    return rows.select(
        "vec_id", "n", F.expr("try_cast(deviation as bigint)").alias("deviation"), "explained", "identity_error",
        F.posexplode("whitened").alias("place", "whitened"),
    ).select(
        "vec_id",
        (F.col("place") + 1).cast("int").alias("component"),
        "n",
        "deviation",
        "whitened",
        F.nanvl(F.element_at("explained", F.col("place") + 1), F.lit(None).cast("double")).alias("explained"),
        "identity_error",
    )
