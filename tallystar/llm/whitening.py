"""Whitening of embeddings from exact second moments, by bit-sliced scatter.

Entries become integers.  A block of rows is turned on its side: every dimension, less
its smallest value, is split into bit planes, and each plane packs one bit of 64 rows
into a word.  The cross-product of two dimensions is then the sum over their planes p
and q of 2^(p+q) times the ones that the two planes share, an AND and a popcount.  Sums
and cross-products stay integers until they are centred; only the centred matrix, of one
row per dimension, reaches the driver and ``eigh``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystar.llm.common import stored

#: Fixed values of the contract: x = floor(64 c) + 1000000, components returned.
SCALE = 64
LIFT = 1_000_000
COMPONENTS = 16
#: Entries must fit a long once scaled; rows with larger ones are dropped like non-finite ones.
LARGEST = 2.0**61
#: Rows whose planes are held at once, a multiple of 64.
BLOCK_ROWS = 4096
#: Eigenvalues below this share of the trace are those of a direction without spread.
SPREAD = 1e-12
#: Moments travel in two parts, so that sums of them fit Spark's decimals.
HALF = 10**18


class Fit(NamedTuple):
    """What whitening needs, numbers per dimension or per component."""

    n: int
    sums: list[int]
    values: np.ndarray  # eigenvalues, falling
    axes: np.ndarray  # dimensions x components
    trace: float


# Integer vectors -----------------------------------------------------------------


def _entries(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Length per row (0 where the vector is to be dropped), and all entries as doubles."""
    lengths = np.zeros(len(vectors), dtype=np.int64)
    if not len(vectors):
        return lengths, np.zeros(0)
    sizes = np.asarray(vectors.value_lengths().fill_null(0), dtype=np.int64)
    flat = vectors.flatten().cast(pa.float64())  # null vectors have no entries here
    values = np.asarray(flat.fill_null(float("nan")), dtype=np.float64)
    bad = ~(np.abs(values) * SCALE < LARGEST)
    ends = np.cumsum(sizes)
    wrong = np.concatenate(([0], np.cumsum(bad)))
    clean = wrong[ends] == wrong[ends - sizes]
    lengths[clean] = sizes[clean]
    return lengths, values[np.repeat(clean, sizes)]


def _integers(values: np.ndarray) -> np.ndarray:
    return np.floor(values * SCALE).astype(np.int64) + LIFT


def _vectors(name: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, values = _entries(batch.column(name))
            raw = _integers(values).tobytes()
            ends = np.cumsum(lengths) * 8
            kept = [k for k in range(len(lengths)) if lengths[k]]
            packed = [raw[ends[k] - 8 * lengths[k] : ends[k]] for k in kept]
            yield pa.RecordBatch.from_arrays(
                [pa.array(lengths[kept].astype(np.int32)), pa.array(packed, pa.binary())],
                names=["width", "x"])

    return run


def fit_list(embeddings: DataFrame, vector: str = "embedding") -> DataFrame:
    """(width, x): each distinct integer vector once, as little-endian longs.

    Copies meet in the map-side half of the aggregate, so a vector that a third of all
    rows repeat is one row per task before anything is shuffled.
    """
    found = embeddings.select(F.col(f"`{vector}`").alias("vector")).mapInArrow(
        _vectors("vector"), "width int, x binary")
    return found.groupBy("width", "x").agg(F.lit(1).alias("one")).drop("one")


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, dtype="<i8").reshape(-1, width)


# Bit-sliced scatter --------------------------------------------------------------


def planes(shifted: np.ndarray, bits: list[int]) -> np.ndarray:
    """Bit planes of non-negative numbers (rows x dimensions), 64 rows to a word.

    Planes follow one another by dimension, lowest bit first; ``bits`` has how many each
    dimension takes.
    """
    sliced = np.concatenate([
        (shifted[:, d, None] >> np.arange(n, dtype=np.int64) & 1).astype(np.uint8).T
        for d, n in enumerate(bits)])
    words = np.zeros((len(sliced), -(-sliced.shape[1] // 64)), dtype=np.uint64)
    if not len(sliced):
        return words
    packed = np.packbits(sliced, axis=1)
    words.view(np.uint8)[:, : packed.shape[1]] = packed
    return words


def scatter(sliced: np.ndarray, bits: list[int]) -> list[list[int]]:
    """Cross-products of all dimensions, upper triangle, from their planes."""
    first = np.concatenate(([0], np.cumsum(bits)))
    shared = np.zeros((len(sliced), len(sliced)), dtype=np.int64)
    for k in range(len(sliced)):
        shared[k, k:] = np.bitwise_count(sliced[k] & sliced[k:]).sum(axis=1, dtype=np.int64)
    shared = np.triu(shared) + np.triu(shared, 1).T
    cross = [[0] * len(bits) for _ in bits]
    for i in range(len(bits)):
        for j in range(i, len(bits)):
            counts = shared[first[i] : first[i + 1], first[j] : first[j + 1]].tolist()
            cross[i][j] = sum(
                c << p + q for p, row in enumerate(counts) for q, c in enumerate(row))
    return cross


def _scatter(width: int, lowest: list[int], bits: list[int], block_rows: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [0] * width
        cross = [[0] * width for _ in range(width)]
        rows = 0

        def add(block: np.ndarray) -> None:
            shifted = block - np.array(lowest, dtype=np.int64)
            for d, total in enumerate(_column_sums(shifted)):
                sums[d] += total
            for mine, found in zip(cross, scatter(planes(shifted, bits), bits), strict=True):
                mine[:] = [a + b for a, b in zip(mine, found, strict=True)]

        waiting: list[np.ndarray] = []
        held = 0
        for batch in batches:
            matrix = _matrix(batch.column("x"), width)
            rows += len(matrix)
            waiting.append(matrix)
            held += len(matrix)
            while held >= block_rows:
                joined = np.concatenate(waiting)
                add(joined[:block_rows])
                waiting, held = [joined[block_rows:]], held - block_rows
        if held:
            add(np.concatenate(waiting))
        if rows:
            # One row per pair of dimensions; number -1 stands for a sum, and for the rows.
            entries = [(-1, -1, rows)] + [(-1, d, s) for d, s in enumerate(sums)]
            entries += [(i, j, cross[i][j]) for i in range(width) for j in range(i, width)]
            i, j, value = zip(*entries, strict=True)
            high, low = zip(*(divmod(v, HALF) for v in value), strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(i, pa.int32()), pa.array(j, pa.int32()),
                 pa.array(map(str, high), pa.string()), pa.array(low, pa.int64())],
                names=["i", "j", "high", "low"])

    return run


def _column_sums(matrix: np.ndarray) -> list[int]:
    """Exact sums of non-negative columns: high and low halves cannot overflow."""
    high, low = (matrix >> 32).sum(axis=0), (matrix & 0xFFFFFFFF).sum(axis=0)
    return [(int(h) << 32) + int(x) for h, x in zip(high, low, strict=True)]


def _extent(width: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = high = None
        for batch in batches:
            if not batch.num_rows:
                continue
            matrix = _matrix(batch.column("x"), width)
            least, most = matrix.min(axis=0), matrix.max(axis=0)
            low = least if low is None else np.minimum(low, least)
            high = most if high is None else np.maximum(high, most)
        if low is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(width, dtype=np.int32)), pa.array(low), pa.array(high)],
                names=["d", "low", "high"])

    return run


def centred(n: int, sums: list[int], cross: list[list[int]]) -> np.ndarray:
    """Covariance with divisor n from exact integers; each entry is rounded once."""
    width = len(sums)
    out = np.empty((width, width))
    for i in range(width):
        for j in range(i, width):
            out[i, j] = out[j, i] = (n * cross[i][j] - sums[i] * sums[j]) / (n * n)
    return out


def fit(vectors: DataFrame, components: int = COMPONENTS, block_rows: int = BLOCK_ROWS) -> Fit | None:
    """Moments and axes of a stored fit list of one width; None where it is empty."""
    first = vectors.select("width").first()
    if first is None:
        return None
    width = first["width"]
    extent = vectors.select("x").mapInArrow(_extent(width), "d int, low long, high long")
    extent = extent.groupBy("d").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    rows = sorted(extent.collect())  # a row per dimension
    lowest = [r["low"] for r in rows]
    bits = [(r["high"] - r["low"]).bit_length() for r in rows]
    # Sums of all tasks are added in Spark.
    found = vectors.select("x").mapInArrow(
        _scatter(width, lowest, bits, block_rows), "i int, j int, high string, low long")
    part = lambda name: F.sum(F.col(name).cast("decimal(28,0)")).alias(name)
    totals = found.groupBy("i", "j").agg(part("high"), part("low")).collect()  # a row per pair of dimensions
    at = {(r["i"], r["j"]): int(r["high"]) * HALF + int(r["low"]) for r in totals}
    n = at[-1, -1]
    shifted = [at[-1, d] for d in range(width)]
    cross = [[at[min(i, j), max(i, j)] for j in range(width)] for i in range(width)]
    values, axes = np.linalg.eigh(centred(n, shifted, cross))
    trace = float(sum(Fraction(n * cross[d][d] - shifted[d] ** 2, n * n) for d in range(width)))
    order = np.argsort(-values, kind="stable")[:components]
    order = [k for k in order if values[k] > SPREAD * trace]
    sums = [s + n * low for s, low in zip(shifted, lowest, strict=True)]
    return Fit(n, sums, values[order], axes[:, order], trace)


# Whitened rows -------------------------------------------------------------------


def _deviations(matrix: np.ndarray, model: Fit) -> tuple[np.ndarray, list[int]]:
    """n*x - S as doubles, each rounded once, and the exact sums of their squares."""
    width = matrix.shape[1]
    middle = [s // model.n for s in model.sums]
    rest = [s - model.n * m for s, m in zip(model.sums, middle, strict=True)]
    near = matrix - np.array(middle, dtype=np.int64)
    reach = max(int(np.abs(near).max(initial=0)) + 1, 1) * model.n
    if reach * reach * width < 2**63:
        exact = near * model.n - np.array(rest, dtype=np.int64)
        return exact.astype(np.float64), (exact * exact).sum(axis=1).tolist()
    wide = [[v * model.n - r for v, r in zip(row, rest, strict=True)] for row in near.tolist()]
    return np.array(wide, dtype=np.float64).reshape(-1, width), [sum(v * v for v in row) for row in wide]


def project(matrix: np.ndarray, model: Fit) -> np.ndarray:
    deviations, _ = _deviations(matrix, model)
    return deviations / model.n @ model.axes / np.sqrt(model.values)


def _spread(width: int, model: Fit) -> Callable:
    """Rows, means and centred squares of a task's whitened rows, merged block by block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = (0, None, None)
        for batch in batches:
            if batch.num_rows:
                block = project(_matrix(batch.column("x"), width), model)
                mean = block.mean(axis=0)
                off = block - mean
                state = merged(state, (len(block), mean, off.T @ off))
        if state[0]:
            yield pa.RecordBatch.from_arrays(
                [pa.array([state[0]], pa.int64()), pa.array([state[1].tolist()], pa.list_(pa.float64())),
                 pa.array([state[2].ravel().tolist()], pa.list_(pa.float64()))],
                names=["n", "mean", "squares"])

    return run


def merged(a: tuple, b: tuple) -> tuple:
    """Two sets' (rows, means, centred squares) as one set's."""
    if not a[0]:
        return b
    n = a[0] + b[0]
    gap = b[1] - a[1]
    return n, a[1] + gap * (b[0] / n), a[2] + b[2] + np.outer(gap, gap) * (a[0] * b[0] / n)


def _merge_states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    state = (0, None, None)
    for batch in batches:
        for row in batch.to_pylist():
            mean = np.array(row["mean"])
            state = merged(state, (row["n"], mean, np.array(row["squares"]).reshape(len(mean), -1)))
    if state[0]:
        yield pa.RecordBatch.from_arrays(
            [pa.array([state[0]], pa.int64()), pa.array([state[1].tolist()], pa.list_(pa.float64())),
             pa.array([state[2].ravel().tolist()], pa.list_(pa.float64()))],
            names=["n", "mean", "squares"])


_STATE = "n long, mean array<double>, squares array<double>"


def identity_error(vectors: DataFrame, model: Fit) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity.

    Each task sends one state of 16 x 16 numbers; eight tasks merge them, then one.
    """
    width, k = len(model.sums), len(model.values)
    if not k:
        return 0.0
    states = vectors.select("x").mapInArrow(_spread(width, model), _STATE)
    few = states.repartition(8).mapInArrow(_merge_states, _STATE).coalesce(1)
    rows = few.mapInArrow(_merge_states, _STATE).collect()
    covariance = np.array(rows[0]["squares"]).reshape(k, k) / rows[0]["n"]
    return float(np.abs(covariance - np.eye(k)).max())


def _whiten(model: Fit, error: float) -> Callable:
    width, k = len(model.sums), len(model.values)
    explained = model.values / model.trace if k else model.values

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, values = _entries(batch.column("vector"))
            right = lengths == width
            clean = lengths > 0
            fits = np.repeat(right[clean], lengths[clean])
            matrix = _integers(values[fits]).reshape(-1, width)
            n = len(matrix)
            if not n or not k:
                continue
            deviations, squares = _deviations(matrix, model)
            whitened = deviations / model.n @ model.axes / np.sqrt(model.values)
            ids = batch.column("vec_id").filter(pa.array(right))
            each = pa.array(np.repeat(np.arange(n), k))
            small = pa.array([s if s < 2**63 else None for s in squares], pa.int64())
            exact = pa.array([str(s) for s in squares], pa.string())
            yield pa.RecordBatch.from_arrays(
                [ids.take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)),
                 pa.array(np.full(n * k, model.n)), small.take(each), exact.take(each),
                 pa.array(whitened.ravel()), pa.array(np.tile(explained, n)),
                 pa.array(np.full(n * k, error))],
                names=["vec_id", "component", "n", "deviation", "deviation_digits",
                       "whitened", "explained", "identity_error"])

    return run


_RESULT = ("vec_id long, component int, n long, deviation long, deviation_digits string, "
           "whitened double, explained double, identity_error double")


def whiten(
    embeddings: DataFrame, vector: str = "embedding", key: str = "vec_id",
    components: int = COMPONENTS, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """One row per remaining row and component: see the contract's columns.

    Rows whose vector is null or empty, or holds a null, a non-finite number or one of
    2^55 or more, are dropped.  Vectors must agree in length: those that differ from the
    most common length among distinct vectors, the longer on a tie, are dropped too.
    Components are fewer than asked where the vectors have fewer dimensions, or no spread
    in them: with all vectors alike there are none, and no rows.  ``deviation`` is null
    where the exact number exceeds a long; ``deviation_digits`` has it whatever its size.
    A null id stays null, repeated rows repeat, other columns are not read, and an empty
    table gives an empty result.
    """
    vectors = stored(fit_list(embeddings, vector))
    widths = vectors.groupBy("width").count().orderBy(F.desc("count"), F.desc("width")).first()
    spark = embeddings.sparkSession
    if widths is None:
        return spark.createDataFrame([], _RESULT)
    vectors = vectors.where(F.col("width") == widths["width"])
    model = fit(vectors, components, block_rows)
    error = identity_error(vectors, model)
    rows = embeddings.select(
        F.col(f"`{key}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").alias("vector"))
    return rows.mapInArrow(_whiten(model, error), _RESULT)
