"""The centroid set that every point must see.

A centroid table is small by construction (k rows), but k is a user parameter,
so its size is *checked* before it is pulled to the driver and shipped to the
tasks: ``CentroidSet.from_frame`` aggregates the row count and vector length
first and refuses (or blocks, see ``blocks``) anything larger than the bounds
below. Everything shipped to executors is therefore bounded by k x d x 8 bytes,
known before it is sent.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.vectors import DimensionError, as_vector
from .nearest import Held, batch_matrix

# k x d above this is not inlined into the SQL plan as literals (plan size,
# codegen method size); the Arrow engine takes over.
SQL_INLINE_MAX_VALUES = 4096
# One broadcast block carries at most this many bytes of centroid coordinates;
# larger sets are split into several blocks a task scans one after another.
BROADCAST_BLOCK_BYTES = 64 << 20
# Sets up to this size travel inside the task closure (no broadcast round trip).
CLOSURE_MAX_BYTES = 1 << 20
# Hard bound on what the driver collects at all (k x d x 8 bytes).
DRIVER_MAX_BYTES = 2 << 30


@dataclass(frozen=True)
class CentroidSet:
    """k centroids sorted by id (ties go to the lowest id)."""

    ids: np.ndarray  # int64, shape (k,)
    vectors: np.ndarray  # float64, shape (k, d)
    labels: np.ndarray | None = None  # optional label per centroid (keyed layout)

    @property
    def k(self) -> int:
        return int(self.ids.shape[0])

    @property
    def d(self) -> int | None:
        return int(self.vectors.shape[1]) if self.k else None

    @property
    def nbytes(self) -> int:
        return int(self.vectors.nbytes)

    def label_values(self) -> np.ndarray:
        return self.ids if self.labels is None else self.labels

    @classmethod
    def of(cls, rows, labels=None) -> CentroidSet:
        """From (id, vector) pairs held on the driver."""
        rows = list(rows)
        if labels is not None:
            labels = list(labels)
            order = sorted(range(len(rows)), key=lambda i: (labels[i], rows[i][0]))
        else:
            order = sorted(range(len(rows)), key=lambda i: rows[i][0])
        ids = np.array([int(rows[i][0]) for i in order], dtype=np.int64)
        vecs = [list(rows[i][1]) for i in order]
        if vecs:
            lens = {len(v) for v in vecs}
            if len(lens) != 1:
                raise DimensionError(f"Centroids of different lengths: {sorted(lens)}")
            if any(x is None for v in vecs for x in v):
                raise DimensionError("centroid with a NULL coordinate")
            arr = np.array(vecs, dtype=np.float64).reshape(len(vecs), lens.pop())
        else:
            arr = np.zeros((0, 0), dtype=np.float64)
        lab = None if labels is None else np.array([int(labels[i]) for i in order], dtype=np.int64)
        return cls(ids, arr, lab)

    @classmethod
    def from_arrays(cls, ids: np.ndarray, vectors: np.ndarray, labels: np.ndarray | None = None) -> CentroidSet:
        """From aligned arrays, sorted by id (by label, then id, in the keyed layout)."""
        order = np.argsort(ids, kind="stable") if labels is None else np.lexsort((ids, labels))
        return cls(ids[order], np.ascontiguousarray(vectors[order]), None if labels is None else labels[order])

    @classmethod
    def from_frame(cls, df: DataFrame, id_col: str = "cluster_id", dims: str = "dims",
                   label_col: str | None = None, max_bytes: int = DRIVER_MAX_BYTES) -> CentroidSet:
        """Collect a centroid table (as Arrow columns) after checking its size with one aggregate."""
        stats = df.agg(F.count(F.lit(1)).alias("k"), F.max(F.size(dims)).alias("d")).collect()[0]
        k, d = int(stats["k"]), int(stats["d"] or 0)
        if k * d * 8 > max_bytes:
            raise ValueError(f"centroid table of {k} x {d} values exceeds {max_bytes} bytes")
        return cls._collected(df, id_col, dims, label_col)

    @classmethod
    def from_few(cls, df: DataFrame, most: int, id_col: str = "cluster_id", dims: str = "dims", label_col: str | None = None) -> CentroidSet:
        """Collect a table known to have ``most`` rows at most (a top-k, a generation of so many centroids) in one pass; more rows raise."""
        return cls._collected(df.limit(most + 1), id_col, dims, label_col, most)

    @classmethod
    def _collected(cls, df, id_col, dims, label_col, most=None) -> CentroidSet:
        cols = [F.col(id_col).cast("bigint").alias("i"), as_vector(dims).alias("v")]
        if label_col is not None:
            cols.append(F.col(label_col).cast("bigint").alias("l"))
        got = df.select(*cols).toArrow().combine_chunks()
        if most is not None and got.num_rows > most:
            raise ValueError(f"more than {most} centroid rows")
        if not got.num_rows:
            return cls.of([])
        column = got["v"].chunk(0)
        if column.null_count:
            raise DimensionError("centroid without a vector")
        lens = np.diff(column.offsets.to_numpy())
        if (lens != lens[0]).any():
            raise DimensionError(f"Centroids of different lengths: {sorted(set(lens.tolist()))}")
        return cls.from_arrays(got["i"].to_numpy(), batch_matrix(column, int(lens[0])), got["l"].to_numpy() if label_col is not None else None)

    def to_frame(self, spark: SparkSession, id_col: str = "cluster_id", dims: str = "dims") -> DataFrame:
        """k rows back as a DataFrame (a bounded, driver-held table)."""
        rows = [(int(i), [float(x) for x in v]) for i, v in zip(self.ids, self.vectors)]
        return spark.createDataFrame(rows, f"{id_col} bigint, {dims} array<double>")

    def to_records(self, spark: SparkSession) -> DataFrame:
        """The keyed layout's records (id, dims, cluster_id) as a DataFrame."""
        rows = [(int(i), [float(x) for x in v], int(c)) for i, v, c in zip(self.ids, self.vectors, self.label_values())]
        return spark.createDataFrame(rows, "id bigint, dims array<double>, cluster_id bigint")

    def blocks(self, block_bytes: int | None = None) -> list[tuple[int, int]]:
        """Row ranges of at most ``block_bytes`` (BROADCAST_BLOCK_BYTES) each."""
        block_bytes = BROADCAST_BLOCK_BYTES if block_bytes is None else block_bytes
        if self.k == 0:
            return []
        per_row = max(1, (self.d or 1) * 8)
        step = max(1, block_bytes // per_row)
        return [(s, min(self.k, s + step)) for s in range(0, self.k, step)]

    def shipped(self, spark: SparkSession) -> list[tuple[int, object]]:
        """(offset, handle) of each block: within the closure if the set is small, else broadcast block by block. ``nearest.streamed`` reads them."""
        cut = [(s, np.ascontiguousarray(self.vectors[s:e])) for s, e in self.blocks()]
        if self.nbytes <= CLOSURE_MAX_BYTES:
            return [(s, Held(v)) for s, v in cut]
        return [(s, spark.sparkContext.broadcast(v)) for s, v in cut]
