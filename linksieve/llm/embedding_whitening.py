"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

The leading eigenvectors of the covariance V of all vectors come from products V·Q with a thin
block Q. A product is one pass over the stored vectors: every task sums centred x·(xᵀQ) over its
rows, and one more task adds up the sums. A pass has a few tasks for every core, however many files or
splits the vectors come in, so what that task reads depends on the cluster and the size of Q, not on the
number of rows. Neither V nor any row reaches the driver, only the product, which has the size of Q.

A round filters the block by a Chebyshev polynomial of V. The polynomial stays within -1 and 1 on
the interval of the unwanted spectrum, zero to the lowest Ritz value of the block, and grows
fastest beyond it; its three-term recurrence takes one pass per degree. QR makes the block
orthonormal again, and Rayleigh-Ritz, one more pass, turns it into approximate eigenvectors. The
same pass gives their residuals |V·q - e·q|, which bound the error of every eigenvalue; rounds
end when the wanted residuals are certified to be at the level of rounding, or no longer fall.

Vectors are taken as integers x = floor(1024 c) + 100000, so sums and deviations are exact.

Rows whose vector is null or holds null or non-finite entries are left out; so are entries for
which 1024 c is beyond the range of a long, and vectors of another length than the commonest (the
longer one at a tie), which have no place in the same covariance. Repeated rows count as often as
they stand there, the key may be null or repeat, other columns are not read. A component without
variance (as with one row, or equal rows) has no whitened value and is not returned; an empty
table gives an empty one. ``deviation`` is null where it exceeds a long.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linksieve.llm.texts import column
from linksieve.session import scratch_path

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
#: Further columns of the block, which set how far the unwanted spectrum lies below the wanted one.
GUARD = 12
#: A round raises the last wanted direction by so much over the unwanted ones, within these degrees of the filter.
GAIN, DEGREES = 1e4, (4, 40)
#: Residuals, as shares of the largest eigenvalue, that certify the wanted vectors.
CERTIFIED = 1e-14
ROUNDS = 60
#: Rows that a task multiplies at a time, and tasks of a pass for each core.
BLOCK = 4096
TASKS = 4


def integer_vectors(df: DataFrame, vector: str, key: str) -> DataFrame:
    """``key`` and ``x``, the scaled integers of every vector without a missing entry."""
    scaled = F.transform(column(vector), lambda c: F.floor(F.lit(float(SCALE)) * c.cast("double")))
    whole = F.forall(
        column(vector),
        lambda c: F.coalesce(F.abs(F.lit(float(SCALE)) * c.cast("double")) < F.lit(2.0**62), F.lit(False)),
    )
    # NaN is greater than any number to Spark, so the one test finds it too
    return df.filter(column(vector).isNotNull() & whole & (F.size(column(vector)) > 0)).select(
        column(key).alias("key"), F.transform(scaled, lambda f: f.cast("long") + F.lit(SHIFT)).alias("x")
    )


def _blocks(batches, size: int):
    """The vectors of Arrow batches as integer matrices."""
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK):
            part = batch.slice(start, BLOCK)
            yield part, part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


class Vectors:
    """Stored integer vectors of one length: their exact sums, and products with their covariance."""

    def __init__(self, table: DataFrame, size: int):
        # some hundred passes, each with a result for every task: many small splits would take most of the time
        self.table = table.coalesce(TASKS * table.sparkSession.sparkContext.defaultParallelism)
        self.size = size

        def run(batches):
            count, high, low, least, most = 0, 0, 0, None, None
            for _, x in _blocks(batches, size):
                count += len(x)
                high = high + (x >> 32).sum(axis=0)  # halves of entries: within a long for 2^31 rows of a task
                low = low + (x & 0xFFFFFFFF).sum(axis=0)
                least = x.min(axis=0) if least is None else np.minimum(least, x.min(axis=0))
                most = x.max(axis=0) if most is None else np.maximum(most, x.max(axis=0))
            if count:
                columns = [np.arange(size), np.full(size, count), high, low, least, most]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns], names=["i", "n", "high", "low", "least", "most"]
                )

        made = self.table.select("x").mapInArrow(run, "i long, n long, high long, low long, least long, most long")
        parts = made.repartition(1)  # a row per task and dimension
        wide = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("n", "high", "low")]
        rows = parts.groupBy("i").agg(*wide, F.min("least").alias("least"), F.max("most").alias("most")).collect()
        ordered = sorted(rows, key=lambda r: r.i)  # a row per dimension
        self.n = int(ordered[0].n)
        self.sums = [int(r.high) * 2**32 + int(r.low) for r in ordered]
        self.widest = max(r.most - r.least for r in ordered)
        #: The mean as an integer and a fraction, so that centring loses nothing of the integers.
        self.floor = np.array([s // self.n for s in self.sums], np.int64)
        self.rest = np.array([(s % self.n) / self.n for s in self.sums])

    def _summed(self, contribution, rows: int, width: int) -> np.ndarray:
        """The sum of ``contribution`` (``rows`` x ``width`` matrix of a centred block) over all blocks."""
        size, floor, rest = self.size, self.floor, self.rest

        def run(batches):
            total = np.zeros((rows, width))
            for _, x in _blocks(batches, size):
                total += contribution((x - floor) - rest)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(rows), pa.int32()), *(pa.array(total[:, j]) for j in range(width))],
                names=["i", *(f"c{j}" for j in range(width))],
            )

        schema = "i int, " + ", ".join(f"c{j} double" for j in range(width))
        made = self.table.select("x").mapInArrow(run, schema)
        added = made.repartition(1).groupBy("i").agg(*(F.sum(f"c{j}").alias(f"c{j}") for j in range(width)))
        found = added.toPandas().sort_values("i")  # the size of a block, whatever the table's
        return found[[f"c{j}" for j in range(width)]].to_numpy()

    def times_covariance(self, block: np.ndarray) -> np.ndarray:
        """V·Q in one pass."""
        return self._summed(lambda x: x.T @ (x @ block), self.size, block.shape[1]) / self.n

    def deviation_total(self) -> float:
        """The trace of V."""
        return float(self._summed(lambda x: np.array([[np.einsum("ij,ij->", x, x)]]), 1, 1)[0, 0]) / self.n

    def identity_error(self, weights: np.ndarray) -> float:
        """Largest entry of the covariance of the projections on ``weights``, less the identity."""
        width = weights.shape[1]

        def contribution(x):
            z = x @ weights
            return np.vstack([z.T @ z, z.sum(axis=0)])

        total = self._summed(contribution, width + 1, width) / self.n
        covariance = total[:width] - np.outer(total[width], total[width])
        return float(np.abs(covariance - np.eye(width)).max(initial=0.0))


def filtered(vectors: Vectors, block: np.ndarray, low: float, top: float, degree: int) -> np.ndarray:
    """A Chebyshev polynomial of V times the block; ``low`` ends the unwanted spectrum, ``top`` the whole."""
    centre = half = low / 2
    # scaled to one at the top, so no power overflows
    sigma = first = half / (top - centre)
    before, now = block, (vectors.times_covariance(block) - centre * block) * (sigma / half)
    for _ in range(degree - 1):
        following = 1 / (2 / first - sigma)
        product = vectors.times_covariance(now)
        before, now = now, 2 * (following / half) * (product - centre * now) - sigma * following * before
        sigma = following
    return now


def leading_eigenpairs(
    vectors: Vectors, components: int = COMPONENTS, guard: int = GUARD
) -> tuple[np.ndarray, np.ndarray, float]:
    """Eigenvalues, falling, unit eigenvectors in columns, and the largest residual as a share of the first."""
    size = vectors.size
    width = min(size, components + guard)
    wanted = min(size, components)
    if width == size:
        block = np.eye(size)
    else:
        block = np.linalg.qr(np.random.default_rng(0).standard_normal((size, width)))[0]
    least, best = np.inf, None
    for _ in range(ROUNDS):
        product = vectors.times_covariance(block)
        small = block.T @ product
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        block, product = block @ turn, product @ turn
        if values[0] <= 0:
            return np.zeros(wanted), block[:, :wanted], 0.0
        residuals = np.linalg.norm(product - block * values, axis=0)[:wanted]
        worst = float(residuals.max() / values[0])
        if best is not None and worst > least / 2 and least < 1e-11:
            break  # rounding is all that is left
        if worst < least:
            least, best = worst, (values[:wanted], block[:, :wanted])
        if worst <= CERTIFIED or width == size:
            break
        low = max(float(values[-1]), 0.0)
        if low <= 1e-13 * values[0]:
            block = product  # the block holds all of the spectrum that is not zero: one power step
        else:
            reach = np.arccosh(max(2 * float(values[wanted - 1]) / low - 1, 1 + 1e-9))
            degree = int(np.clip(np.ceil(np.arccosh(GAIN) / reach), *DEGREES))
            block = filtered(vectors, block, low, float(values[0]), degree)
        block = np.linalg.qr(block)[0]
    values, directions = best
    return np.maximum(values, 0.0), directions, least


def whiten(
    df: DataFrame, vector: str = "embedding", key: str = "vec_id", components: int = COMPONENTS
) -> DataFrame:
    """A row per vector and component: key, ``component``, ``n``, ``deviation``, ``whitened``, ``explained``,
    ``identity_error`` and ``residual`` (the certificate: largest |V·q - e·q| as a share of the first e)."""
    spark = df.sparkSession
    key_type = df.schema[key].dataType.simpleString()
    schema = (
        f"`{key}` {key_type}, component int, n long, deviation long, whitened double, explained double, "
        "identity_error double, residual double"
    )
    path = scratch_path(spark, "vectors")
    integer_vectors(df, vector, key).withColumn("size", F.size("x")).write.parquet(path)
    stored = spark.read.parquet(path)
    commonest = stored.groupBy("size").count().orderBy(F.desc("count"), F.desc("size")).first()
    if commonest is None:
        return spark.createDataFrame([], schema)
    size = commonest["size"]
    table = stored.filter(F.col("size") == size).select("key", "x")
    vectors = Vectors(table, size)
    values, directions, residual = leading_eigenpairs(vectors, components)
    kept = values > 1e-12 * values[0] if values[0] > 0 else np.zeros(len(values), bool)
    values, directions = values[kept], directions[:, kept]
    if not len(values):
        return spark.createDataFrame([], schema)
    weights = directions / np.sqrt(values)
    explained = values / vectors.deviation_total()
    error = vectors.identity_error(weights)
    n, sums, floor, rest = vectors.n, vectors.sums, vectors.floor, vectors.rest
    # sums of squares of n x - S that are sure to fit a long are summed as longs
    fits = (n * vectors.widest) ** 2 * size < 2**63
    count = len(values)

    def run(batches):
        for part, x in _blocks(batches, size):
            white = ((x - floor) - rest) @ weights
            if fits:
                apart = n * (x - floor) - np.array([s - n * int(f) for s, f in zip(sums, floor)], np.int64)
                deviation = pa.array(np.einsum("ij,ij->i", apart, apart), pa.int64())
            else:
                exact = [sum((n * c - s) ** 2 for c, s in zip(row, sums)) for row in x.tolist()]
                deviation = pa.array([e if e < 2**63 else None for e in exact], pa.int64())
            rows = np.repeat(np.arange(len(x)), count)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("key").take(pa.array(rows)),
                    pa.array(np.tile(np.arange(1, count + 1), len(x)), pa.int32()),
                    pa.array(np.full(len(rows), n), pa.int64()),
                    deviation.take(pa.array(rows)),
                    pa.array(white.ravel()),
                    pa.array(np.tile(explained, len(x))),
                    pa.array(np.full(len(rows), error)),
                    pa.array(np.full(len(rows), residual)),
                ],
                names=[key, "component", "n", "deviation", "whitened", "explained", "identity_error", "residual"],
            )

    return table.mapInArrow(run, schema)

