"""Exact deduplication by composable polynomial fingerprints.

A text of bytes b_1..b_n has, for each of four fixed bases B modulo the prime 2**31 - 1, the value sum(b_i * B**(n-i)). Chunks are
hashed by themselves, many at a time, and combine by length-shifted arithmetic: hash(x + y) = hash(x) * B**len(y) + hash(y). So
a huge document is cut into pieces which separate tasks hash, and the pieces' hashes are folded in order. Rows of equal
length and fingerprint are then compared chunk by chunk with the row that stays, so that a collision never joins two texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable, maybe_in, positional, split_by, trimmed
from .textvec import row_slices, utf8

P = (1 << 31) - 1
#: Random bases; 1024 products of a byte and a value below 2**31 stay exact in a double.
BASES = (1103027687, 1693418539, 911382323, 1972592201)
CHUNK = 1024
#: A text longer than this is hashed in pieces by several tasks; texts are compared in pieces of COMPARE bytes.
PIECE = 8 << 20
COMPARE = 1 << 16
#: Rows of one group that are compared with one copy of the text that stays.
SALT_ROWS = 1000

FP = "n_bytes long, f1 long, f2 long"


def _powers(base: int, step: int, n: int) -> np.ndarray:
    """base**(step*k) mod P for k < n."""
    out, by = np.empty(n, dtype=np.uint64), pow(base, step, P)
    value = 1
    for k in range(n):
        out[k] = value
        value = value * by % P
    return out


_IN_CHUNK = np.stack([_powers(b, 1, CHUNK)[::-1] for b in BASES], axis=1).astype(np.float64)


def _chunk_values(data: np.ndarray, lens: np.ndarray, chunks: np.ndarray) -> np.ndarray:
    """The four values of each chunk of the rows that lie one after another in ``data``. A row ends where a chunk ends, and the
    zeros before it add nothing."""
    values = np.empty((int(chunks.sum()), len(BASES)), dtype=np.uint64)
    if len(lens) == 1:  # a long row: some chunks at a time
        head = int(chunks[0] * CHUNK - lens[0])
        for c in range(0, len(values), 1024):
            d = min(c + 1024, len(values))
            part = np.zeros((d - c) * CHUNK)
            a, b = c * CHUNK - head, d * CHUNK - head
            part[max(0, -a):] = data[max(0, a):b]
            values[c:d] = (part.reshape(-1, CHUNK) @ _IN_CHUNK).astype(np.uint64) % P
    else:
        part = np.zeros(len(values) * CHUNK)
        part[np.arange(len(data)) + np.repeat(np.cumsum(chunks) * CHUNK - np.cumsum(lens), lens)] = data
        values[:] = (part.reshape(-1, CHUNK) @ _IN_CHUNK).astype(np.uint64) % P
    return values


def hashes(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The four values of each row's bytes, as an array of shape (rows, 4)."""
    out = np.zeros((len(offsets) - 1, len(BASES)), dtype=np.uint64)
    for i, j in row_slices(offsets, 1 << 20):
        lens = np.diff(offsets[i:j + 1])
        chunks = -(-lens // CHUNK)
        if not chunks.any():
            continue
        values = _chunk_values(data[offsets[i]:offsets[j]], lens, chunks)
        upto = np.cumsum(chunks)
        behind = np.repeat(upto, chunks) - 1 - np.arange(len(values))  # chunks after this one in its row
        full = np.flatnonzero(chunks)
        for k, base in enumerate(BASES):
            shifted = values[:, k] * _powers(base, CHUNK, int(chunks.max()))[behind] % P
            out[i + full, k] = np.add.reduceat(shifted, (upto - chunks)[full]) % P
    return out


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The four values as two longs."""
    v = values.astype(np.int64)
    return (v[:, 0] << 31) | v[:, 1], (v[:, 2] << 31) | v[:, 3]


def combine(x: tuple[int, tuple[int, ...]], y: tuple[int, tuple[int, ...]]) -> tuple[int, tuple[int, ...]]:
    """(length, values) of the text x + y, from those of x and y."""
    return x[0] + y[0], tuple((a * pow(b, y[0], P) + c) % P for a, b, c in zip(x[1], BASES, y[1]))


def _hash_rows(keys: list[str], mask: int):
    def run(batches):
        for batch in batches:
            data, offsets = utf8(batch.column("bytes"))
            f1, f2 = pack(hashes(data, offsets) & np.uint64(mask))
            cols = [batch.column(k) for k in keys] + [pa.array(np.diff(offsets)), pa.array(f1), pa.array(f2)]
            yield pa.RecordBatch.from_arrays(cols, names=[*keys, "n_bytes", "f1", "f2"])

    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", piece: int = PIECE, mask: int = P) -> DataFrame:
    """id, sha, n_bytes, f1, f2 per row. ``mask`` keeps fewer bits of each value, to make collisions in tests."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256).alias("sha"),
        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("bytes"),
    )
    short = rows.where(F.octet_length("bytes") <= piece).mapInArrow(trimmed(_hash_rows(["id", "sha"], mask)), f"id long, sha string, {FP}")
    pieces = (
        rows.where(F.octet_length("bytes") > piece)
        .select("id", "sha", F.posexplode(F.expr(f"transform(sequence(0, cast((octet_length(bytes) - 1) / {piece} as int)), k -> substring(bytes, k * {piece} + 1, {piece}))")).alias("no", "bytes"))
        .repartition(F.col("id"), F.col("sha"), F.col("no"))
        .mapInArrow(trimmed(_hash_rows(["id", "sha", "no"], P)), f"id long, sha string, no int, {FP}")
        .groupBy("id", "sha", "no").agg(F.max("n_bytes").alias("n_bytes"), F.max("f1").alias("f1"), F.max("f2").alias("f2"), F.count("*").alias("copies"))
    )
    # fold the pieces in order; all but the last are ``piece`` long, the last one's shift comes from its own length
    whole = pieces.groupBy("id", "sha").agg(F.sort_array(F.collect_list(F.struct("no", "n_bytes", "f1", "f2"))).alias("p"), F.max("copies").alias("copies"))

    def folded(base: int, part: str) -> str:
        by = pow(base, piece, P)
        last = "element_at(p, -1).n_bytes"
        power = f"aggregate(sequence(0, 30), named_struct('r', 1L, 'b', {base}L), (s, k) -> named_struct('r', if(shiftrightunsigned({last}, k) & 1L = 1L, s.r * s.b % {P}L, s.r), 'b', s.b * s.b % {P}L)).r"
        head = f"aggregate(slice(p, 1, size(p) - 1), 0L, (h, x) -> (h * {by}L + {part.replace('@', 'x')}) % {P}L)"
        return f"(({head} * {power} + {part.replace('@', 'element_at(p, -1)')}) % {P}L)"

    hi, lo = "shiftright(@.{0}, 31)", "(@.{0} & %dL)" % P
    v = [F.expr(folded(b, part.format(f))).bitwiseAND(F.lit(mask)) for b, part, f in zip(BASES, (hi, lo, hi, lo), ("f1", "f1", "f2", "f2"))]
    long = whole.select(
        "id", "sha", F.expr("aggregate(p, 0L, (n, x) -> n + x.n_bytes)").alias("n_bytes"),
        F.shiftleft(v[0], 31).bitwiseOR(v[1]).alias("f1"), F.shiftleft(v[2], 31).bitwiseOR(v[3]).alias("f2"),
        F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_copy"),
    ).drop("_copy")
    return short.unionByName(long)


def _equal_to_kept(docs: DataFrame, pending: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """pending (rid, id, sha, gid, kid, ksha, n) with ``same``: whether the row's text is that of the row that stays."""
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    texts = maybe_in(texts, F.coalesce(F.col("id"), F.lit(-1)), pending, F.coalesce(F.col("id"), F.lit(-1)))
    texts = texts.withColumn("sha", F.sha2("text", 256))
    # each text once, though its row may be repeated
    wanted = pending.groupBy("id", "sha").agg(F.max("gid").alias("gid"), F.max("kid").alias("kid"), F.max("ksha").alias("ksha"), F.max("n").alias("n"))
    wanted = wanted.withColumn("salts", F.ceil(F.col("n") / SALT_ROWS).cast("int"))
    joined = texts.alias("t").join(wanted.alias("w"), F.col("t.id").eqNullSafe(F.col("w.id")) & (F.col("t.sha") == F.col("w.sha")))
    cut = F.expr(f"transform(sequence(0, cast(greatest(octet_length(text) - 1, 0) / {COMPARE} as int)), k -> substring(cast(text as binary), k * {COMPARE} + 1, {COMPARE}))")
    rows = durable(joined.select("t.id", "t.sha", "t.text", "w.gid", "w.kid", "w.ksha", "w.salts"))
    pieces = rows.select("id", "sha", "gid", F.pmod(F.xxhash64("id", "sha"), F.col("salts")).cast("int").alias("salt"), F.posexplode(cut).alias("no", "piece"))
    stays = rows.where(F.col("id").eqNullSafe(F.col("kid")) & (F.col("sha") == F.col("ksha"))).dropDuplicates(["gid"])
    stays = stays.select("gid", "salts", F.posexplode(cut).alias("no", "kept_piece"))
    stays = stays.select("gid", "no", "kept_piece", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    verdict = pieces.join(stays, ["gid", "salt", "no"]).groupBy("id", "sha").agg(F.bool_and(F.col("piece") == F.col("kept_piece")).alias("same"))
    return pending.alias("p").join(verdict.alias("v"), F.col("p.id").eqNullSafe(F.col("v.id")) & (F.col("p.sha") == F.col("v.sha"))).select("p.*", "v.same")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", piece: int = PIECE, mask: int = P) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, n_bytes.

    Texts are equal when their bytes are; null counts as empty. Of equal texts the row with the largest id stays (null ids come
    last; of rows with that id one stays). Other columns are not read; an empty table gives no rows."""
    rows = durable(fingerprints(docs, id_col, text_col, piece, mask).withColumn("rid", F.monotonically_increasing_id()))
    fp = ["n_bytes", "f1", "f2"]
    pending, settled = rows, None
    while True:
        # the table of groups is written first, so that the join can split a group that holds many rows
        groups = durable(pending.groupBy(fp).agg(F.max(F.struct("id", "rid", "sha")).alias("k"), F.count("*").alias("n")).where("n > 1"))
        marked = pending.join(groups, fp, "left").select(
            "rid", "id", "sha", *fp, F.coalesce("k.rid", "rid").alias("gid"), F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("k.id")).alias("kid"),
            F.col("k.sha").alias("ksha"), F.coalesce("n", F.lit(1)).alias("n"),
        )
        marked = durable(marked)
        checked = durable(_equal_to_kept(docs, marked.where("n > 1"), id_col, text_col))
        pending = checked.where("not same").select("rid", "id", "sha", *fp)
        done = checked.where("same").drop("same")
        collided = not pending.isEmpty()
        if collided:  # other texts with this fingerprint form groups of their own
            others = durable(checked.where("not same").groupBy("gid").agg(F.count("*").alias("others")))
            done = done.join(others, "gid", "left").withColumn("n", F.col("n") - F.coalesce("others", F.lit(0))).drop("others")
        done = marked.where("n = 1").unionByName(done)
        settled = done if settled is None else settled.unionByName(done)
        if not collided:
            break
    return settled.select(F.col("id").alias("doc_id"), F.col("kid").alias("keep_id"), F.col("n").alias("group_size"), (F.col("rid") == F.col("gid")).alias("kept"), F.col("sha").alias("text_sha256"), "n_bytes")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``exact_dedup`` keeps, with all their columns, whatever their names. Only rows whose id may be among the dropped
    are shuffled.

    Of rows with equal texts the one with the largest id stays; rows that repeat that id and text are copies too, one of them (which one is
    open, should their other columns differ) stays. Null texts count as empty, null ids as less than any; an empty table gives no rows."""
    from pyspark.sql import Window

    plain, (id_col, text_col), named = positional(docs, id_col, text_col)
    made = durable(exact_dedup(plain, id_col, text_col))
    per = made.groupBy(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha")).agg(F.sum(F.col("kept").cast("int")).alias("_stay"), F.count("*").alias("_all"))
    lost = per.where("_stay < _all")
    own = F.coalesce(F.col(id_col).cast("long"), F.lit(-1))
    maybe, rest = split_by(plain, own, lost, F.coalesce(F.col("_id"), F.lit(-1)))
    maybe = maybe.withColumn("_own_sha", F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256))
    joined = maybe.join(lost, F.col(id_col).cast("long").eqNullSafe(F.col("_id")) & (F.col("_own_sha") == F.col("_sha")), "left")
    stay = joined.where("_sha is null").select(*plain.columns)
    one = joined.where("_stay > 0").withColumn("_n", F.row_number().over(Window.partitionBy("_id", "_sha").orderBy(F.lit(0)))).where("_n <= _stay").select(*plain.columns)
    return named(rest.select(*plain.columns).unionByName(stay).unionByName(one))
