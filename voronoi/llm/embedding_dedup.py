"""Near-duplicate embeddings by Euclidean p-stable hashing and exact cosine checks.

A normalised vector x has, in each of ``tables`` tables, the key floor((a_i . x + b_i) / w) for ``bits`` Gaussian a_i and uniform b_i. Vectors
at a cosine of 0.9 are sqrt(0.2) apart; with w = 2 one projection puts them in one cell with probability 0.82, and 104 tables of 18
find such a pair with probability 0.95 (closer pairs are practically never missed, unrelated ones share a key once in 2e5 tables).

Equal vectors are one node. Nodes that share a key are compared block by block; of a pair's common tables only the first counts it,
so that no list of pairs is needed to count each link once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable
from .components import components
from .textvec import mix

U = np.uint64
TABLES, BITS, WIDTH = 104, 18, 2.0
#: Nodes of one bucket that are compared with as many others in one piece of work.
BLOCK = 512


def projections(dim: int, tables: int, bits: int, width: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gaussian directions (dim, tables * bits), offsets, and multipliers that fold a table's cells into 64 bits."""
    rng = np.random.Generator(np.random.PCG64([dim, tables, bits]))
    return rng.standard_normal((dim, tables * bits)), rng.uniform(0, width, tables * bits), rng.integers(0, 2**63, bits, dtype=np.uint64) * U(2) + U(1)


def keys_of(unit: np.ndarray, tables: int, bits: int, width: float) -> np.ndarray:
    """(rows, tables) keys of unit vectors of one dimension."""
    a, b, by = projections(unit.shape[1], tables, bits, width)
    out = np.empty((len(unit), tables), dtype=np.uint64)
    salt = mix(np.arange(1, tables + 1, dtype=np.uint64) * U(0x9E3779B97F4A7C15) + U(unit.shape[1]))
    for i in range(0, len(unit), 2048):
        cell = np.floor((unit[i:i + 2048] @ a + b) / width).astype(np.int64).astype(np.uint64).reshape(-1, tables, bits)
        out[i:i + 2048] = mix((cell * by).sum(axis=2, dtype=np.uint64) + salt)
    return out


def _vectors(column: pa.Array) -> list[np.ndarray | None]:
    """Each row's vector as doubles; None if it is null, empty, zero or holds null or non-finite components."""
    column = column.cast(pa.list_(pa.float64()))
    values = np.asarray(column.values.fill_null(float("nan")).to_numpy(zero_copy_only=False))
    offsets, valid = column.offsets.to_numpy(), column.is_valid().to_numpy(zero_copy_only=False)
    out: list[np.ndarray | None] = []
    for i in range(len(column)):
        v = values[offsets[i]:offsets[i + 1]]
        out.append(v if valid[i] and len(v) and np.isfinite(v).all() and v.any() else None)
    return out


def _node(v: np.ndarray) -> int:
    """A vector's 64-bit name; equal vectors have equal names."""
    words = (v + 0.0).view(np.uint64)
    at = mix(np.arange(1, len(v) + 1, dtype=np.uint64))
    return int(mix(np.array([mix(words * U(0x9E3779B97F4A7C15) ^ at).sum(dtype=np.uint64) + U(len(v))], dtype=np.uint64))[0].astype(np.int64))


def _name(batches):
    for batch in batches:
        vectors = _vectors(batch.column(1))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([None if v is None else _node(v) for v in vectors], pa.int64()), pa.array([None if v is None else v.tobytes() for v in vectors], pa.binary())],
            names=["id", "node", "vector"],
        )


def _unit(raw: bytes) -> np.ndarray:
    v = np.frombuffer(raw, dtype=np.float64)
    v = v / np.abs(v).max()  # components near the ends of the range neither overflow nor vanish
    return v / np.sqrt(v @ v)


def _keyed(tables: int, bits: int, width: float):
    def run(batches):
        for batch in batches:
            units = [_unit(x) for x in batch.column("vector").to_pylist()]
            by_dim: dict[int, list[int]] = {}
            for i, u in enumerate(units):
                by_dim.setdefault(len(u), []).append(i)
            keys = np.empty((len(units), tables), dtype=np.uint64)
            for at in by_dim.values():
                keys[at] = keys_of(np.stack([units[i] for i in at]), tables, bits, width)
            yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("copies"), batch.column("vector"), pa.array([k.tobytes() for k in keys], pa.binary())], names=["node", "copies", "vector", "keys"])

    return run


def _exploded(batches):
    """(key, node) for each table."""
    for batch in batches:
        keys = [np.frombuffer(k, dtype=np.int64) for k in batch.column("keys").to_pylist()]
        if keys:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.repeat(batch.column("node").to_numpy(), len(keys[0])))], names=["key", "node"])


class _Found:
    """What a task has found: link counts by node, and links that span the parts found so far."""

    def __init__(self):
        self.counts: dict[int, int] = {}
        self.links: set[tuple[int, int]] = set()

    def add(self, key: int, rows: list, cosine: float) -> None:
        """Compare the left rows with the right ones (a bucket of one block has all rows on both sides)."""
        by_dim: dict[int, list] = {}
        for r in rows:
            by_dim.setdefault(len(r[3]), []).append(r)
        for same in by_dim.values():
            left = [r for r in same if r[0] != 1]
            right = [r for r in same if r[0] != 0]
            if left and right and (len(left) > 1 or len(right) > 1):
                self._compare(key, left, right, left[0][0] == 2, cosine)

    def _compare(self, key: int, left: list, right: list, own: bool, cosine: float) -> None:
        x, y = np.stack([_unit(r[3]) for r in left]), np.stack([_unit(r[3]) for r in right])
        linked = x @ y.T >= cosine
        if own:
            np.fill_diagonal(linked, False)
        a, b = np.nonzero(linked)
        if own:
            a, b = a[a < b], b[a < b]
        if not len(a):
            return
        kx, ky = np.stack([np.frombuffer(r[4], dtype=np.int64) for r in left]), np.stack([np.frombuffer(r[4], dtype=np.int64) for r in right])
        table = int(np.flatnonzero(kx[0] == key)[0])
        if table:  # pairs that share an earlier table are counted there
            new = np.ones(len(a), dtype=bool)
            for i in range(0, len(a), 4096):
                new[i:i + 4096] = ~(kx[a[i:i + 4096], :table] == ky[b[i:i + 4096], :table]).any(axis=1)
            a, b = a[new], b[new]
            if not len(a):
                return
        nx, ny = [r[1] for r in left], [r[1] for r in right]
        cx, cy = np.array([r[2] for r in left]), np.array([r[2] for r in right])
        for node, n in zip(nx, np.bincount(a, weights=cy[b], minlength=len(nx)).astype(int)):
            if n:
                self.counts[node] = self.counts.get(node, 0) + int(n)
        for node, n in zip(ny, np.bincount(b, weights=cx[a], minlength=len(ny)).astype(int)):
            if n:
                self.counts[node] = self.counts.get(node, 0) + int(n)
        # a link of each node to the least one that it reaches within this piece
        label = np.arange(len(nx) + len(ny)) if not own else np.arange(len(nx))
        names = nx if own else nx + ny
        b = b if own else b + len(nx)
        while True:
            low = np.minimum(label[a], label[b])
            before = label.copy()
            np.minimum.at(label, a, low)
            np.minimum.at(label, b, low)
            if (label == before).all():
                break
        self.links.update((names[i], names[j]) for i, j in enumerate(label.tolist()) if i != j)

    def batch(self) -> pa.RecordBatch:
        links = list(self.links)
        n = len(self.counts)
        out = pa.RecordBatch.from_arrays(
            [
                pa.array([*self.counts, *[u for u, _ in links]], pa.int64()),
                pa.array([None] * n + [v for _, v in links], pa.int64()),
                pa.array([*self.counts.values(), *[0] * len(links)], pa.int64()),
            ],
            names=["u", "v", "n"],
        )
        self.counts, self.links = {}, set()
        return out


def _compared(cosine: float):
    """Rows come sorted by (key, x, y): one piece of work after another."""

    def run(batches):
        found, piece, rows = _Found(), None, []
        for batch in batches:
            for key, x, y, *row in zip(*[c.to_pylist() for c in batch.columns]):
                if (key, x, y) != piece:
                    if len(rows) > 1:
                        found.add(piece[0], rows, cosine)
                    piece, rows = (key, x, y), []
                    if len(found.counts) + len(found.links) > 200_000:
                        yield found.batch()
                rows.append(row)
        if len(rows) > 1:
            found.add(piece[0], rows, cosine)
        yield found.batch()

    return run


def near_embeddings(vectors: DataFrame, cosine: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding", tables: int = TABLES, bits: int = BITS, width: float = WIDTH) -> DataFrame:
    """One row per row: vec_id, n_links (other rows linked directly), component_id (least vec_id that links reach, its own included), kept.

    Vectors that are null, empty or zero or hold null or non-finite components link with nothing, nor do vectors of different lengths. Rows
    that repeat an id are vectors like any other; a null id is never the least. An empty table gives no rows."""
    rows = durable(vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>")).mapInArrow(_name, "id long, node long, vector binary"))
    nodes = rows.where("node is not null").groupBy("node").agg(F.count("*").alias("copies"), F.min("vector").alias("vector"))
    keyed = durable(nodes.mapInArrow(_keyed(tables, bits, width), "node long, copies long, vector binary, keys binary"))
    keys = keyed.select("keys", "node").mapInArrow(_exploded, "key long, node long")
    shared = durable(keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"))
    members = keys.join(shared, "key").withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    members = members.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks").cast("long")).cast("int"))
    # side 0 left, 1 right, 2 both; a block meets itself and every later one
    each = F.explode(F.expr("transform(sequence(0, blocks - 1), o -> struct(least(block, o) as x, greatest(block, o) as y, if(o = block, 2, if(block < o, 0, 1)) as side))"))
    work = members.select("key", "node", each.alias("w")).select("key", "w.x", "w.y", "w.side", "node")
    work = work.join(keyed, "node").select("key", "x", "y", "side", "node", "copies", "vector", "keys").repartition("key", "x", "y").sortWithinPartitions("key", "x", "y")
    found = durable(work.mapInArrow(_compared(cosine), "u long, v long, n long"))
    counts = found.where("v is null").groupBy(F.col("u").alias("node")).agg(F.sum("n").alias("links"))
    per = keyed.select("node", "copies").join(counts, "node", "left").join(components(found.where("v is not null").select("u", "v")), "node", "left")
    per = durable(per.select("node", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "node").alias("root")))
    rooted = durable(rows.select("id", "node").join(per, "node", "left"))
    least = durable(rooted.where("root is not null").groupBy("root").agg(F.min("id").alias("least"), F.count("*").alias("n")).where("n > 1"))
    out = rooted.join(least, "root", "left")
    component = F.when(F.col("least").isNull(), F.col("id")).otherwise(F.col("least"))
    return out.select(F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
