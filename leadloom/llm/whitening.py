"""Whitening of embeddings: shifted CholeskyQR of the centred rows, then the SVD of R."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage

#: An entry c is taken as the whole number floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 64, 1_000_000
#: Entries beyond this have no exact whole number in a double and count as not finite.
LARGEST = 2.0**45
COMPONENTS = 16
#: Gram passes at most, and how far from the identity the last Gram matrix may be.
MAX_PASSES, ORTHOGONAL = 8, 1e-13
#: Bytes of rows that are held as doubles at a time.
SLICE_BYTES = 8 << 20

_EPS = float(np.finfo(float).eps)


def whole_vectors(column: pa.Array, dim: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the rows whose vector is whole and finite, and their quantised vectors (all of length ``dim``)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.diff(np.asarray(column.offsets))
    valid = np.ones(len(column), bool) if not column.null_count else np.asarray(column.is_valid())
    values = column.flatten()  # leaves out null vectors
    lengths = np.where(valid, lengths, 0)
    flat = np.asarray(values.cast(pa.float64()).fill_null(np.nan)) if len(values) else np.zeros(0)
    good = np.abs(flat) < LARGEST  # NaN compares as false
    begin = np.cumsum(lengths) - lengths
    bad = np.concatenate([[0], np.cumsum(~good)])
    rows = np.flatnonzero(valid & (lengths > 0) & (bad[begin + lengths] == bad[begin]))
    if dim is None:
        return rows, lengths[rows]
    rows = rows[lengths[rows] == dim]
    flat = flat[begin[rows][:, None] + np.arange(dim)]
    return rows, np.floor(SCALE * flat).astype(np.int64) + OFFSET


def _row_slices(n: int, dim: int) -> Iterator[slice]:
    step = max(1, SLICE_BYTES // (8 * dim))
    return (slice(i, i + step) for i in range(0, n, step))


def _unpack(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of a binary column, each ``dim`` long integers."""
    raw = np.frombuffer(column.buffers()[2], np.uint8) if len(column) else np.zeros(0, np.uint8)
    first = column.offset
    offsets = np.frombuffer(column.buffers()[1], np.int32)[first : first + len(column) + 1] if len(column) else [0, 0]
    return raw[offsets[0] : offsets[-1]].view("<i8").reshape(-1, dim)


def _dimension(vectors: DataFrame, vec_col: str) -> int:
    """The commonest length of whole vectors, of equally common ones the shorter; 0 without any."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, counts = np.unique(whole_vectors(batch.column(0))[1], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())], ["size", "n"])

    sizes = vectors.select(F.col(vec_col)).mapInArrow(task, "size long, n long").groupBy("size").agg(F.sum("n").alias("n"))
    found = sizes.orderBy(F.col("n").desc(), "size").first()
    return int(found["size"]) if found else 0


def fit_list(vectors: DataFrame, vec_col: str, dim: int) -> DataFrame:
    """Each different quantised vector once, as the bytes of its long integers in column ``x``."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, x = whole_vectors(batch.column(0), dim)
            packed = np.unique(np.ascontiguousarray(x).view(f"V{8 * dim}").ravel())  # copies meet here first
            offsets = np.arange(len(packed) + 1, dtype=np.int32) * (8 * dim)
            buffers = [None, pa.py_buffer(offsets), pa.py_buffer(packed.tobytes())]
            yield pa.RecordBatch.from_arrays([pa.Array.from_buffers(pa.binary(), len(packed), buffers)], ["x"])

    return vectors.select(F.col(vec_col)).mapInArrow(task, "x binary").distinct()


def _sums(fitted: DataFrame, dim: int) -> tuple[int, np.ndarray]:
    """Number of rows and the exact sum of each dimension."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(dim, np.int64)
        for batch in batches:
            x = _unpack(batch.column(0), dim)
            n, total = n + len(x), total + x.sum(0)
        places = np.arange(-1, dim)
        yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(np.append(n, total))], ["place", "total"])

    rows = fitted.mapInArrow(task, "place long, total long").groupBy("place").agg(F.sum("total").alias("total")).collect()
    found = {r["place"]: r["total"] for r in rows}
    return found.get(-1, 0), np.array([found.get(i, 0) for i in range(dim)], np.int64)


def apart(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n x - S, exact: what wraps around in the product comes back in the difference."""
    if len(x) and np.abs(x.astype(np.float64) * n - sums).max() >= 2.0**62:
        raise OverflowError("vectors are too far apart for whole numbers of 64 bits")
    return x * np.int64(n) - sums


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - S / n, rounded once: the numerator is whole."""
    return apart(x, n, sums).astype(np.float64) / n


def triangular_solve(rows: np.ndarray, r: np.ndarray) -> np.ndarray:
    """``rows`` times the inverse of the upper triangular ``r``, by substitution."""
    result = np.empty_like(rows)
    for j in range(r.shape[1]):
        result[:, j] = (rows[:, j] - result[:, :j] @ r[:j, j]) / r[j, j]
    return result


def _gram(fitted: DataFrame, dim: int, n: int, sums: np.ndarray, project, width: int) -> np.ndarray:
    """The Gram matrix of the projected centred rows. Tasks send one matrix each; Spark adds them up by place."""
    upper = np.triu_indices(width)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            x = _unpack(batch.column(0), dim)
            for part in _row_slices(len(x), dim):
                rows = project(centred(x[part], n, sums))
                total += rows.T @ rows
        places = np.arange(len(upper[0]))
        yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(total[upper])], ["place", "value"])

    added = fitted.mapInArrow(task, "place long, value double").groupBy("place").agg(F.sum("value").alias("value")).toArrow()
    result = np.zeros((width, width))
    order = np.argsort(added["place"].to_numpy())
    result[upper] = added["value"].to_numpy()[order]
    return np.triu(result) + np.triu(result, 1).T


def _factor(gram: np.ndarray, n: int, shifted: bool) -> np.ndarray:
    """The upper Cholesky factor; shifted where asked or where rounding leaves no definite matrix."""
    d = len(gram)
    shift = 11 * (n * d + d * (d + 1)) * _EPS * max(np.linalg.norm(gram, 2), np.finfo(float).tiny)
    if not shifted:
        try:
            return np.linalg.cholesky(gram).T
        except np.linalg.LinAlgError:
            pass
    while True:
        try:
            return np.linalg.cholesky(gram + shift * np.eye(d)).T
        except np.linalg.LinAlgError:
            shift *= 10


def shifted_cholesky_qr(fitted: DataFrame, dim: int, n: int, sums: np.ndarray) -> np.ndarray:
    """R of the QR decomposition of the centred rows.

    Each pass solves the rows through the factors so far, takes their Gram matrix and
    factors it; the first factor is shifted so that it exists. R is the product of all
    factors. It ends when the rows are orthonormal, apart from directions without any spread.
    """
    factors: list[np.ndarray] = []

    def project(rows: np.ndarray) -> np.ndarray:
        for r in factors:
            rows = triangular_solve(rows, r)
        return rows

    product = np.eye(dim)
    for k in range(MAX_PASSES):
        gram = _gram(fitted, dim, n, sums, project, dim)
        if not gram.any():
            return np.zeros((dim, dim))
        values = np.linalg.eigvalsh(gram) if k else np.zeros(1)
        if k and np.minimum(abs(values - 1), abs(values)).max() <= ORTHOGONAL * dim:
            break
        r = _factor(gram, n, shifted=k == 0)
        factors = [*factors, r]
        product = r @ product
    return product


def whiten(
    vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """Per whole row and component: ``vec_id``, ``component``, ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``.

    Entries become whole numbers x first. Mean and covariance V are of the different x
    vectors, each counted once: ``n`` of them. ``component`` numbers the eigenvectors of V from 1 by
    falling eigenvalue, their largest entry positive; ``whitened`` is the centred x along it
    over the root of the eigenvalue; ``deviation`` the exact squared distance of n x from the
    sums; ``explained`` the eigenvalue's share of the trace; ``identity_error`` the largest entry
    of the whitened covariance less the identity, over all components returned.

    Rows whose vector is null, empty, or holds a null or an entry that is not finite (or beyond
    2**45) are left out, and so are those of another length than the commonest (of equally common ones
    the shorter). Directions without spread have no component, so equal vectors alone and an empty table give
    no rows. Repeated rows and rows without an id are all returned; other columns are not read. Raises where
    ``deviation`` or a sum would not fit a long.
    """
    spark = vectors.sparkSession
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    dim = _dimension(vectors, vec_col)
    if not dim:
        return spark.createDataFrame([], schema)
    fitted = stage(fit_list(vectors, vec_col, dim))
    n, sums = _sums(fitted, dim)
    r = shifted_cholesky_qr(fitted, dim, n, sums)
    _, sigma, right = np.linalg.svd(r)
    spread = sigma[:components] > dim * _EPS * max(sigma[0], np.finfo(float).tiny)
    width = int(spread.sum())
    if not width:
        return spark.createDataFrame([], schema)
    axes = right[:width].T
    axes = axes * np.sign(axes[np.abs(axes).argmax(0), np.arange(width)])
    explained = sigma[:width] ** 2 / (sigma**2).sum()
    scaled = axes * (np.sqrt(n) / sigma[:width])
    whitened_gram = _gram(fitted, dim, n, sums, lambda rows: rows @ scaled, width)
    error = float(np.abs(whitened_gram / n - np.eye(width)).max())

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, x = whole_vectors(batch.column(1), dim)
            ids = batch.column(0)
            for part in _row_slices(len(rows), dim):
                away = apart(x[part], n, sums)
                if float(np.abs(away).max()) ** 2 * dim >= 2.0**63:
                    if max(sum(int(v) ** 2 for v in row) for row in away) >= 1 << 63:
                        raise OverflowError("deviation does not fit a long")
                m = len(away)
                columns = [
                    ids.take(pa.array(np.repeat(rows[part], width))),
                    pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * width, n)),
                    pa.array(np.repeat((away * away).sum(1), width)),
                    pa.array((away.astype(np.float64) / n @ scaled).ravel()),
                    pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * width, error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in schema.split(", ")])

    narrow = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col))
    return narrow.mapInArrow(task, schema)
