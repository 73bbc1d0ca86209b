"""NumPy kernels run inside Spark tasks (Arrow batches): the distance arg-min of one batch over blocks of centroids.

``Nearest`` takes most distances from one matrix product per block, |x|^2 - 2 x.c + |c|^2, whose error has a known
bound. Only centroids that lie within twice that bound of the best can be the nearest one; for these (mostly a single
one for each point) the distance is computed again term by term, in the order of the sequential loop. So labels and distances are
those of ``nearest``, the sequential form, to the last bit, whatever the matrix product's own order of summation.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from ..functions.vectors import DimensionError

# Distances of one product, which bounds the scratch memory (8 bytes each, some more for masks).
PRODUCT_VALUES = 1 << 21
UNIT = 2.0 ** -53
# Squared norms beyond this could overflow; such rows take the sequential form.
SAFE = 1e280


def batch_matrix(arr: pa.Array, d: int) -> np.ndarray:
    """list<double|float> Arrow column -> (n, d) float64, without Python rows."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    n = len(arr)
    if n == 0:
        return np.zeros((0, d))
    if arr.null_count:
        raise DimensionError("NULL vector in input")
    offsets = arr.offsets.to_numpy(zero_copy_only=False)
    lens = np.diff(offsets)
    if (lens != d).any():
        raise DimensionError(f"Vectors of {int(lens.min())} to {int(lens.max())} coordinates, not {d}")
    flat = arr.values.slice(int(offsets[0]), n * d)
    if flat.null_count:
        raise DimensionError("NULL coordinate in input")
    return flat.to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(n, d)


def sequential_distance(xt: np.ndarray, ct: np.ndarray) -> np.ndarray:
    """Squared distances of paired columns of two (d, n) arrays, terms added in dimension order (as the SQL expression does)."""
    total = np.zeros(xt.shape[1])
    for i in range(xt.shape[0]):
        t = xt[i] - ct[i]
        total = t * t if i == 0 else total + t * t
    return total


class Nearest:
    """Running arg-min of one batch of points ``x`` (n, d) over blocks of centroids in the order of their ids.

    NaN distances lose to any number; among equal distances the first centroid wins; with NaN distances only, the first
    centroid. ``index`` and ``distance`` hold the outcome so far; ``beyond`` (with ``second``) a lower bound, safe against rounding, of the distance
    (not squared) to every other centroid, 0 where nothing is known."""

    def __init__(self, x: np.ndarray, second: bool = False):
        self.x = np.ascontiguousarray(x)
        n, self.d = x.shape
        self.xt = np.ascontiguousarray(x.T)
        self.index = np.zeros(n, np.int64)
        self.distance = np.full(n, np.nan)
        self.best = np.full(n, np.inf)
        self.unset = np.ones(n, bool)
        self.norm2 = np.einsum("ij,ij->i", self.x, self.x)
        self.plain = self.norm2 < SAFE  # neither NaN nor large
        self.second = np.full((n, 2), np.inf) if second else None  # the two least approximate distances less |x|^2
        self.slack = np.zeros(n)
        self.sure = self.plain.copy()

    def block(self, offset: int, c: np.ndarray) -> None:
        """Centroids ``c`` (k, d), numbered from ``offset`` on."""
        if not len(c):
            return
        c2 = np.einsum("ij,ij->i", c, c)
        rows = np.flatnonzero(self.plain) if self.d and (c2 < SAFE).all() else np.zeros(0, np.int64)
        if len(rows):
            far = np.sqrt(c2.max(initial=0.0))
            twice, step = np.ascontiguousarray(-2.0 * c.T), max(1, PRODUCT_VALUES // max(1, len(c)))
            ct = np.ascontiguousarray(c.T)
            for i in range(0, len(rows), step):
                self._product(rows[i:i + step], offset, ct, twice, c2, far)
        if len(rows) < len(self.x):
            odd = np.ones(len(self.x), bool)
            odd[rows] = False
            self._sequential(np.flatnonzero(odd), offset, c)

    def _product(self, rows, offset, ct, twice, c2, far):
        whole = len(rows) == len(self.x)
        approx = (self.x if whole else self.x[rows]) @ twice
        approx += c2
        norm2 = self.norm2[rows]
        # a bound of each term's error: products and sums of d + 2 roundings, of the product form and of the sequential one
        slack = 8 * (self.d + 8) * UNIT * (np.sqrt(norm2) + far) ** 2 + 1e-290
        least = approx.min(axis=1)
        if self.second is not None:
            two = np.partition(approx, 1, axis=1)[:, :2] if approx.shape[1] > 1 else np.column_stack((approx, np.full(len(rows), np.inf)))
            self.second[rows] = np.sort(np.concatenate((self.second[rows], two), axis=1), axis=1)[:, :2]
            self.slack[rows] = np.maximum(self.slack[rows], slack)
        np.minimum(least, self.best[rows] - norm2, out=least)
        at, col = np.nonzero(approx <= (least + slack)[:, None])
        if not len(at):
            return
        exact = sequential_distance(self.xt[:, rows[at]], ct[:, col])
        first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        if len(first) < len(at):  # several candidates: the least, the first among equals
            if self.second is not None:
                self.sure[rows[at[np.flatnonzero(at[1:] == at[:-1])]]] = False
            low = np.minimum.reduceat(exact, first)
            hit = np.flatnonzero(exact == np.repeat(low, np.diff(np.append(first, len(at)))))
            first = hit[np.flatnonzero(np.append(True, at[hit][1:] != at[hit][:-1]))]
        self._take(rows[at[first]], exact[first], offset + col[first])

    def _sequential(self, rows, offset, c):
        xt = self.xt[:, rows]
        self.sure[rows] = False
        for j in range(len(c)):
            with np.errstate(all="ignore"):
                self._take(rows, sequential_distance(xt, np.broadcast_to(c[j][:, None], xt.shape)), np.full(len(rows), offset + j))

    def _take(self, rows, exact, index):
        better = (exact < self.best[rows]) | (exact == self.best[rows]) & self.unset[rows]
        rows, exact, index = rows[better], exact[better], index[better]
        self.best[rows] = self.distance[rows] = exact
        self.unset[rows] = False
        self.index[rows] = index

    def beyond(self) -> np.ndarray:
        """A lower bound of the distance to every centroid but the nearest."""
        low = self.second[:, 1] + self.norm2 - self.slack
        return np.where(self.sure & (low > 0), np.sqrt(np.maximum(low, 0.0)), 0.0)


def nearest(xt: np.ndarray, blocks) -> tuple[np.ndarray, np.ndarray]:
    """The sequential form of ``Nearest`` for points given transposed (d, n): (index into the sorted centroids, squared distance).
    ``blocks`` yields (offset, centroid rows sorted by id). Tests hold ``Nearest`` against it."""
    found = Nearest(np.ascontiguousarray(xt.T))
    found.plain[:] = False
    for offset, c in blocks:
        found.block(offset, c)
    return found.index, found.distance


class Held:
    """Stands in for a broadcast handle where the value travels in the closure."""

    def __init__(self, value):
        self.value = value

    def destroy(self) -> None:
        """Nothing is kept anywhere."""


def streamed(blocks):
    """(offset, centroid rows) one block after the other; a broadcast block is read when its turn comes and dropped before the next,
    so a worker holds one at a time."""
    for offset, handle in blocks:
        value = handle.value
        yield offset, value
        if not isinstance(handle, Held):
            del value
            vars(handle).pop("_value", None)  # read again from the executor's file at the next batch

