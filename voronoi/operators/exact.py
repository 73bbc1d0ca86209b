"""Sums of vectors that don't depend on the order of the rows.

A double is a whole multiple of a power of two, so it splits without error into limbs, whole numbers that count
multiples of 2**(32 j). Sums of limbs are sums of integers: they come out the same for every order, grouping and
number of tasks, and no rounding happens before the end, where the mean is the double nearest to the exact quotient.

``ExactSums`` is the accumulator of a task: one slot for each key it has seen, grown as keys appear and given out
(``flush``) when it has grown to its bound. ``partials`` and ``merged`` are the two halves of a keyed sum as Spark stages:
one array row for each key and task, then a shuffle by key and a merge that holds one key at a time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..functions.vectors import DimensionError
from .nearest import batch_matrix

BITS = 32
# State that a task holds before it gives out what it has.
FLUSH_BYTES = 64 << 20
# Partial rows of a loop's step that the driver merges itself.
DRIVER_BYTES = 8 << 20
# Size of one batch of partial rows.
OUT_BYTES = 4 << 20
# Rows whose limbs are summed as doubles at a time: 2**32 * 2**20 stays below 2**53.
MAX_ROWS = 1 << 20

NAN, POS, NEG = 1, 2, 4


class _NanKey:
    """The key of all NaN, which equals no other key."""


NAN_KEY = _NanKey


def _limb_of(x: float) -> int:
    """The limb that holds the leading bit of a positive number."""
    return (int(np.frexp(x)[1]) - 1) // BITS


class ExactSums:
    """Exact per-key sums of vectors of ``d`` coordinates, and the number of vectors."""

    def __init__(self, d: int):
        self.d = d
        self.clear()

    def clear(self) -> None:
        self.slots: dict = {}
        self.n = np.zeros(0, np.int64)
        self.limbs: dict[int, np.ndarray] = {}
        self.special = np.zeros((0, self.d), np.uint8)

    @property
    def nbytes(self) -> int:
        return self.n.size * (64 + self.d * (1 + 8 * len(self.limbs)))

    def _places(self, keys) -> np.ndarray:
        slots = self.slots
        at = np.fromiter((slots.setdefault(k, len(slots)) for k in keys), np.int64, len(keys))
        if len(slots) > self.n.size:
            more = max(len(slots), 2 * self.n.size) - self.n.size
            self.n = np.append(self.n, np.zeros(more, np.int64))
            self.special = np.vstack((self.special, np.zeros((more, self.d), np.uint8)))
            self.limbs = {j: np.vstack((v, np.zeros((more, self.d), np.int64))) for j, v in self.limbs.items()}
        return at

    def _limb(self, j: int) -> np.ndarray:
        if j not in self.limbs:
            self.limbs[j] = np.zeros((self.n.size, self.d), np.int64)
        return self.limbs[j]

    def add(self, keys: list, index: np.ndarray, x: np.ndarray, sign: int = 1) -> None:
        """Vectors ``x``; the key of row i is ``keys[index[i]]``, keys differ. ``sign=-1`` takes them away again (finite ones)."""
        for i in range(0, len(x), MAX_ROWS):
            self._add(keys, index[i:i + MAX_ROWS], x[i:i + MAX_ROWS], sign)

    def _add(self, keys, index, x, sign):
        present, index = np.unique(index, return_inverse=True)
        at = self._places([keys[p] for p in present.tolist()])
        self.n[at] += sign * np.bincount(index, minlength=len(present))
        if not self.d:
            return
        order = np.argsort(index, kind="stable")
        first = np.searchsorted(index[order], np.arange(len(present)))
        rest = x[order]
        odd = ~np.isfinite(rest)
        if odd.any():
            marks = np.where(np.isnan(rest), NAN, np.where(rest > 0, POS, NEG)).astype(np.uint8)
            self.special[at] |= np.bitwise_or.reduceat(np.where(odd, marks, 0).astype(np.uint8), first, axis=0)
            rest[odd] = 0.0
        size = np.abs(rest)
        top = float(size.max(initial=0.0))
        if top == 0.0:
            return
        low = _limb_of(float(size[size > 0].min())) - 53 // BITS - 1
        for j in range(_limb_of(top), low - 1, -1):
            whole = np.trunc(np.ldexp(rest, -BITS * j))
            rest -= np.ldexp(whole, BITS * j)
            self._limb(j)[at] += sign * np.add.reduceat(whole, first, axis=0).astype(np.int64)
            if not rest.any():
                break

    def rows(self):
        """(key, n, lowest limb, limbs of all coordinates one after the other, marks or None) of each key, carried so that merged sums fit."""
        if not self.slots:
            return
        low, top = (min(self.limbs), max(self.limbs) + 1) if self.limbs else (0, 0)
        stack = np.zeros((top - low + 1, len(self.slots), self.d), np.int64)
        for j, v in self.limbs.items():
            stack[j - low] = v[:len(self.slots)]
        for j in range(len(stack) - 1):
            carry = stack[j] >> BITS
            stack[j] -= carry << BITS
            stack[j + 1] += carry
        for key, s in self.slots.items():
            marks = self.special[s]
            yield key, int(self.n[s]), low, np.ascontiguousarray(stack[:, s].T).reshape(-1), marks.tobytes() if marks.any() else None


class ExactSum:
    """The merged sum of one key: integers on a common scale."""

    def __init__(self):
        self.n, self.low, self.total, self.marks, self.parts = 0, 0, None, 0, 0

    def add(self, n: int, low: int, limbs: np.ndarray, marks: bytes | None, d: int) -> None:
        self.parts += 1
        per = len(limbs) // d if d else 0
        values = [0] * d
        for j in range(per - 1, -1, -1):
            values = [(v << BITS) + x for v, x in zip(values, limbs[j::per].tolist())]
        self.plus(n, low, values)
        if marks is not None:
            got = np.frombuffer(marks, np.uint8)
            self.marks = got if isinstance(self.marks, int) else self.marks | got

    def plus(self, n: int, low: int, values: list[int]) -> None:
        self.n += n
        if self.total is None:
            self.low, self.total = low, values
            return
        if low < self.low:
            self.total = [t << BITS * (self.low - low) for t in self.total]
            self.low = low
        up = BITS * (low - self.low)
        self.total = [t + (v << up) for t, v in zip(self.total, values)]

    @classmethod
    def of(cls, row) -> ExactSum:
        """From a row of ``merged`` with ``exact``."""
        made = cls()
        made.plus(row["n"], row["low"], [int(t, 16) for t in row["total"]])
        if row["marks"] is not None:
            made.marks = np.frombuffer(row["marks"], np.uint8)
        return made

    def with_(self, other: ExactSum | None) -> ExactSum:
        """The sum of both, as a new one."""
        made = ExactSum()
        for x in (self, other):
            if x is not None and x.total is not None:
                made.plus(x.n, x.low, list(x.total))
                if not isinstance(x.marks, int):
                    made.marks = x.marks if isinstance(made.marks, int) else made.marks | x.marks
        return made

    def mean(self) -> list[float]:
        """Each coordinate's sum over the number, rounded once."""
        shift = BITS * self.low
        out = [_quotient(t << shift if shift > 0 else t, self.n << -shift if shift < 0 else self.n) for t in self.total or []]
        if not isinstance(self.marks, int):
            for i, m in enumerate(self.marks.tolist()):
                if m:
                    out[i] = float("inf") if m == POS else float("-inf") if m == NEG else float("nan")
        return out


def _quotient(a: int, b: int) -> float:
    try:
        return a / b
    except OverflowError:
        return float("inf") if a > 0 else float("-inf")


def plain_key(v):
    """Keys as Spark groups them: NULL is a key, all NaN are one, and so are the two zeros."""
    if isinstance(v, float):
        return NAN_KEY if v != v else v + 0.0
    return v


def part_schema(key: T.StructField) -> T.StructType:
    return T.StructType([
        T.StructField("key", key.dataType), T.StructField("n", T.LongType()), T.StructField("d", T.IntegerType()), T.StructField("low", T.IntegerType()),
        T.StructField("limbs", T.ArrayType(T.LongType())), T.StructField("marks", T.BinaryType())])


def part_batches(sums: ExactSums, key_type: pa.DataType):
    """The accumulator's rows as Arrow batches of bounded size; it is empty afterwards."""
    cols: list[list] = [[], [], [], [], [], []]
    size = 0

    def out():
        types = (key_type, pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["key", "n", "d", "low", "limbs", "marks"])

    for key, n, low, limbs, marks in sums.rows():
        for c, v in zip(cols, (float("nan") if key is NAN_KEY else key, n, sums.d, low, limbs, marks)):
            c.append(v)
        size += limbs.nbytes + 64
        if size > OUT_BYTES:
            yield out()
            cols, size = [[], [], [], [], [], []], 0
    if cols[0]:
        yield out()
    sums.clear()


def partials(df: DataFrame, key: str, dims: str, d: int | None = None) -> DataFrame:
    """One row for each key and task (more where a task's keys outgrow its bound): the exact sums of its vectors. Keys of any type
    that Arrow can encode as a dictionary; vectors of another length than the first (or ``d``), NULL vectors and NULL coordinates raise."""

    bound = FLUSH_BYTES

    def run(batches):
        sums = None if d is None else ExactSums(d)
        key_type = None
        for batch in batches:
            if not batch.num_rows:
                continue
            coded = batch.column(0).dictionary_encode(null_encoding="encode")
            key_type = batch.schema.field(0).type
            if sums is None:
                sums = ExactSums(vector_length(batch.column(1)))
            places: dict = {}  # two codes may be one key: both zeros, all NaN
            of_code = np.array([places.setdefault(plain_key(v), len(places)) for v in coded.dictionary.to_pylist()], np.int64)
            sums.add(list(places), of_code[coded.indices.to_numpy(zero_copy_only=False)], batch_matrix(batch.column(1), sums.d))
            if sums.nbytes > bound:
                yield from part_batches(sums, key_type)
        if sums is not None and sums.slots:
            yield from part_batches(sums, key_type)

    return df.select(key, dims).mapInArrow(run, part_schema(df.schema[key]))


def vector_length(column: pa.Array) -> int:
    """The length of a batch's first vector."""
    if column.null_count:
        raise DimensionError("NULL vector in input")
    return int(column.offsets[1].as_py() - column.offsets[0].as_py())


def merged(parts: DataFrame, key: str, dims: str = "dims", n: str = "n_points", exact: bool = False) -> DataFrame:
    """(key, n, mean vector) from ``partials``: rows of a key meet in one task, as many as there were tasks at most, and are merged as a
    sorted stream, one key at a time. With ``exact`` (key, n, lowest limb, coordinates' sums in hexadecimal, marks, rows merged) instead."""
    types = [pa.int64(), pa.int32(), pa.list_(pa.string()), pa.binary(), pa.int64()] if exact else [pa.int64(), pa.list_(pa.float64())]
    names = ["n", "low", "total", "marks", "parts"] if exact else [n, dims]

    def run(batches):
        held, current, found, d = ExactSum(), None, False, None
        rows: list[tuple] = []
        key_type = None

        def row():
            if exact:
                return current, held.n, held.low, [hex(t) for t in held.total or []], None if isinstance(held.marks, int) else held.marks.tobytes(), held.parts
            return current, held.n, held.mean()

        def out():
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), [key_type, *types])], names=[key, *names])
            rows.clear()
            return batch

        for batch in batches:
            key_type = batch.schema.field(0).type
            limbs = batch.column(4)
            offsets, flat = limbs.offsets.to_numpy(), limbs.values.to_numpy()
            for i, (k, count, width, low, marks) in enumerate(zip(*(batch.column(c).to_pylist() for c in (0, 1, 2, 3, 5)))):
                if found and plain_key(k) != plain_key(current):
                    rows.append(row())
                    held, d = ExactSum(), None
                if d is not None and width != d:
                    raise DimensionError(f"Vectors of {d} and of {width} coordinates")
                current, found, d = k, True, width
                held.add(count, low, flat[offsets[i]:offsets[i + 1]], marks, width)
            if rows:
                yield out()
        if found:
            rows.append(row())
            yield out()

    first = T.StructField(key, parts.schema["key"].dataType)
    if exact:
        rest = [T.StructField("n", T.LongType()), T.StructField("low", T.IntegerType()), T.StructField("total", T.ArrayType(T.StringType())), T.StructField("marks", T.BinaryType()), T.StructField("parts", T.LongType())]
    else:
        rest = [T.StructField(n, T.LongType()), T.StructField(dims, T.ArrayType(T.DoubleType()))]
    return parts.repartition("key").sortWithinPartitions("key").mapInArrow(run, T.StructType([first, *rest]))


class Merge:
    """Collects the exact sums of a loop's steps, as {key: ExactSum}.

    The first step's partial rows are merged by Spark, which also counts them. As long as a step's rows are few bytes together
    (DRIVER_BYTES, by that count) the later ones are collected as they are and merged here, which saves a shuffle and a stage a step; beyond that Spark
    merges every step. Sums of integers come out the same either way."""

    def __init__(self):
        self.few = False

    def __call__(self, parts: DataFrame, d: int) -> dict:
        out: dict = {}
        if not self.few:
            rows = merged(parts, "key", exact=True).collect()
            limbs = max((len(r["total"][0]) // (BITS // 4) + 2 for r in rows if r["total"]), default=1)
            self.few = sum(r["parts"] for r in rows) * (64 + 8 * d * limbs) <= DRIVER_BYTES
            return {r["key"]: ExactSum.of(r) for r in rows}
        got = parts.toArrow()
        limbs = got["limbs"].combine_chunks()
        if got.num_rows:
            limbs = limbs.chunk(0) if isinstance(limbs, pa.ChunkedArray) else limbs
            offsets, flat = limbs.offsets.to_numpy(), limbs.values.to_numpy()
        for i, (key, n, low, marks) in enumerate(zip(*(got[c].to_pylist() for c in ("key", "n", "low", "marks")))):
            out.setdefault(key, ExactSum()).add(n, low, flat[offsets[i]:offsets[i + 1]], marks, d)
        return out
