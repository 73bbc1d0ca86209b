"""Jaccard self-join of documents on word shingles, by PartEnum signatures.

Two sets of sizes a and b with 100 * intersection >= t * union differ in at most k = (100 - t) * (a + b) / (100 + t) features. Sets are
dealt to bands of like size, each set to its own band and, if a larger partner can lie there, to the next. In a band whose pairs
differ in at most k features, the domain of features is partitioned by hash: differences touch k partitions at most, so similar
sets agree on all others. For small k the signatures are all pairs of k + 2 partitions, for larger k each of k + 1 + e partitions. Two
sets that can be linked therefore share a signature.

An empty partition would be shared by sets with nothing in common, so it makes no signature. This loses no pair: of the partitions
at least e + 1 agree, so a set with at most e empty ones shares one that isn't empty; a set with more also sends signatures of another
partitioning of the domain, and so on.

Equal sets are one node. Candidates never become all pairs of a group: each task and then each bucket links a signature's nodes to its
least node. These links are checked exactly. Where the checked links leave a candidate group in several parts, the nodes of different
parts that share a signature are compared by sketches, block by block. Of what these don't rule out each part sends a few pairs, which
are checked exactly; their links join parts, and the next round asks for more pairs of the parts that are left, until a round has none
that it held back. So the pairs sent grow with the parts, not with their square, and none that could join two parts is left out.

Signatures are made again where the texts lie, so that only texts of pairs that are checked travel. Sets that outgrow the sketch have a wide one
besides, which travels for pairs that the other one lets pass, before their texts do.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import durable, maybe_in, positional, shuffle_partitions, split_by, trimmed
from .components import components
from .textvec import lower, mix, row_slices, shingles, utf8, word_hashes, word_spans

U = np.uint64
#: Ratio of a size band's ends; above any 100 / t in use, so that linked sets are at most one band apart.
BAND = 1.5
#: Partitionings of the domain after which an empty partition makes a signature all the same.
TURNS = 4
#: Signatures held by a task before it sends them on, and in a bucket on the average.
FLUSH = 250_000
#: Sets in a block when parts of a group are compared, and bits of a set's sketch.
BLOCK, SKETCH = 512, 2048
#: Pairs of a part that the first round sends from a block, and how many times as many the next one does.
FIRST, MORE = 1, 16


#: What the two functions below have found; a plain table, so that kernels that use them travel by value.
_KNOWN: dict[tuple, object] = {}


def band_starts(limit: int) -> list[int]:
    """Least sizes of the bands, up to one beyond ``limit``."""
    if (limit,) not in _KNOWN:
        _KNOWN[(limit,)] = _band_starts(limit)
    return _KNOWN[(limit,)]


def _band_starts(limit: int) -> list[int]:
    starts = [1]
    while starts[-1] <= limit:
        starts.append(max(starts[-1] + 1, math.ceil(starts[-1] * BAND)))
    return [*starts, math.ceil(starts[-1] * BAND) + 1]


def band_plan(start: int, end: int, t: int) -> tuple[int, int, bool]:
    """(partitions, e, whether signatures are pairs of partitions) of the band with sizes start..end-1."""
    if (start, end, t) not in _KNOWN:
        _KNOWN[start, end, t] = _band_plan(start, end, t)
    return _KNOWN[start, end, t]


def _band_plan(start: int, end: int, t: int) -> tuple[int, int, bool]:
    k = (100 - t) * 2 * (end - 1) // (100 + t)
    if k == 0:
        return 1, 0, False
    if k <= 4:
        return k + 2, 0, True
    least, e = start * t / 100, 0
    while e < k:
        n = k + 1 + e
        empty = n * math.exp(-least / n)
        if e >= empty + 3 * math.sqrt(empty):
            break
        e += 1
    return k + 1 + e, e, False


def signatures(features: np.ndarray, t: int) -> np.ndarray:
    """The signatures of one set, given as sorted 64-bit features."""
    n = len(features)
    if not n:
        return np.zeros(0, dtype=np.uint64)
    starts = band_starts(1 << (n * 2).bit_length())
    own = int(np.searchsorted(starts, n, "right")) - 1
    out = []
    for j in (own, own + 1) if n * 100 // t >= starts[own + 1] else (own,):
        parts, e, pairs = band_plan(starts[j], starts[j + 1], t)
        for turn in range(TURNS):
            h = features if turn == 0 else np.sort(mix(features + U(turn)))
            at = ((h >> U(32)) * U(parts)) >> U(32)
            begin = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
            which, sums = at[begin], np.add.reduceat(mix(h ^ U(0xA24BAED4963EE407)), begin)
            salt = mix(np.array([(j * TURNS + turn + 1) * 2 + pairs], dtype=np.uint64))[0]
            if pairs:
                full = np.zeros(parts, dtype=np.uint64)
                full[which.astype(np.int64)] = sums
                a, b = np.triu_indices(parts, 1)
                some = np.isin(a, which) | np.isin(b, which)
                made, empty, allowed = mix(full[a] + full[b] + U(0x9E3779B97F4A7C15) * (a * parts + b + 1).astype(np.uint64) + salt), int((~some).sum()), 0
                made = made if turn == TURNS - 1 else made[some]
            else:
                made, empty, allowed = mix(sums + U(0x9E3779B97F4A7C15) * (which + U(1)) + salt), parts - len(which), e
                if turn == TURNS - 1 and empty > allowed:
                    rest = np.setdiff1d(np.arange(parts), which.astype(np.int64)).astype(np.uint64)
                    made = np.concatenate((made, mix(U(0x9E3779B97F4A7C15) * (rest + U(1)) + salt)))
            out.append(made)
            if empty <= allowed:
                break
    return np.concatenate(out)


def sets_of(column: pa.Array, n: int):
    """The shingle sets of a column of texts, some rows at a time."""
    data, offsets = utf8(column)
    for i, j in row_slices(offsets, 1 << 20):
        part, own = lower(data[offsets[i]:offsets[j]]), offsets[i:j + 1] - offsets[i]
        starts, ends, firsts = word_spans(part, own)
        yield from shingles(word_hashes(part, starts, ends), firsts, n)


def node_of(features: np.ndarray) -> int:
    """A set's 64-bit name."""
    return int(mix(np.array([features.size], dtype=np.uint64) * U(0xD6E8FEB86659FD93) + mix(features).sum(dtype=np.uint64))[0].astype(np.int64))


def _nodes(n: int):
    def run(batches):
        for batch in batches:
            sets = [(len(s), node_of(s), sketch(s).tobytes(), wide_sketch(s)) if len(s) else (0, None, None, None) for s in sets_of(batch.column(1), n)]
            cols = zip(*sets) if sets else [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.binary(), pa.binary())))], names=["id", "n_shingles", "node", "sketch", "wide"])

    return trimmed(run)


def _star(sig: np.ndarray, node: np.ndarray, big: np.ndarray):
    """Of each signature's nodes: (signature, node, whether the signature has more than two nodes) of its least node, and of its second one
    if it has just two; and the links (least node, other node) of the larger ones."""
    order = np.lexsort((node, sig))
    sig, node, big = sig[order], node[order], big[order]
    if not len(sig):
        return sig, node, big, np.zeros((0, 2), np.int64)
    first = np.append(True, sig[1:] != sig[:-1])
    group = np.cumsum(first) - 1
    large = np.bitwise_or.reduceat(big, np.flatnonzero(first))
    new = first | np.append(True, node[1:] != node[:-1])
    large |= np.bincount(group[new]) > 2
    hub = node[first][group]
    far = new & ~first & large[group]
    links = np.unique(np.stack((hub[far], node[far]), axis=1), axis=0) if far.any() else np.zeros((0, 2), np.int64)
    stay = new & (first | ~large[group])
    return sig[stay], node[stay], large[group[stay]], links


def _signature_blocks(n: int, t: int, buckets: int):
    """Blocks of signatures: the 48 leading bits of each, the place of its node in the block's list of nodes, and whether it has more than two."""
    schema = pa.schema([("bucket", pa.int32()), ("sigs", pa.binary()), ("nodes", pa.binary()), ("places", pa.binary()), ("big", pa.binary()), ("links", pa.binary())])

    def flushed(sigs: list, nodes: list):
        sig = np.concatenate(sigs) >> U(16) << U(16)
        sig, node, big, links = _star(sig, np.concatenate(nodes), np.zeros(len(sig), bool))
        bucket = (mix(sig) % U(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        sig, node, big, bucket = sig[order], node[order], big[order], bucket[order]
        which = np.unique(bucket)
        ends = np.searchsorted(bucket, which, "right")
        starts = np.concatenate(([0], ends[:-1]))
        spread = np.array_split(links, len(which))
        rows, size = [], 0
        for b, i, j, x in zip(which.tolist(), starts.tolist(), ends.tolist(), spread):
            known, place = np.unique(node[i:j], return_inverse=True)
            own = np.ascontiguousarray(sig[i:j].view(np.uint8).reshape(-1, 8)[:, 2:])
            rows.append((b, own.tobytes(), known.tobytes(), place.astype(np.uint32 if len(known) > 1 << 16 else np.uint16).tobytes(), np.packbits(big[i:j]).tobytes(), x.tobytes()))
            size += own.nbytes
            if len(rows) >= 256 or size > 2 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    def run(batches):
        sigs, nodes, held = [], [], 0
        for batch in batches:
            for features in sets_of(batch.column(0), n):
                if len(features):
                    made = signatures(features, t)
                    sigs.append(made)
                    nodes.append(np.full(len(made), node_of(features), dtype=np.int64))
                    held += len(made)
                    if held >= FLUSH:
                        yield from flushed(sigs, nodes)
                        sigs, nodes, held = [], [], 0
        if held:
            yield from flushed(sigs, nodes)

    return trimmed(run)


def _block_entries(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(signatures, nodes, whether they have more than two nodes) of one block."""
    own = np.frombuffer(row["sigs"], np.uint8).reshape(-1, 6)
    sig = np.zeros((len(own), 8), np.uint8)
    sig[:, 2:] = own
    known = np.frombuffer(row["nodes"], np.int64)
    place = np.frombuffer(row["places"], np.uint32 if len(known) > 1 << 16 else np.uint16)
    return sig.view(np.uint64).ravel(), known[place], np.unpackbits(np.frombuffer(row["big"], np.uint8), count=len(own)).astype(bool)


def _bucket_links(table: pa.Table) -> pa.Table:
    """The links of one bucket, its own and those that tasks had found; ``open`` where a signature has more than two nodes, so that the
    link's check doesn't settle what else shares it; and rows with these signatures."""
    made = [_block_entries(r) for b in table.to_batches() for r in b.to_pylist()]
    given = np.frombuffer(b"".join(x.as_py() for x in table.column("links")), np.int64).reshape(-1, 2)
    sig, node, big, links = _star(*(np.concatenate(c) for c in zip(*made)))
    second = np.flatnonzero(np.append(False, sig[1:] == sig[:-1]))
    pairs = np.stack((node[second - 1], node[second]), axis=1)
    both = np.concatenate((links, given, pairs))
    is_open = np.arange(len(both)) < len(both) - len(pairs)
    linked = np.unique(np.column_stack((both, is_open)), axis=0) if len(both) else np.zeros((0, 3), np.int64)
    large = sig[big].view(np.int64)
    pad = lambda x, kind, front: pa.concat_arrays([pa.nulls(len(linked if front else large), kind), x][:: 1 if front else -1])
    return pa.table({
        "u": pad(pa.array(linked[:, 0], pa.int64()), pa.int64(), False), "v": pad(pa.array(linked[:, 1], pa.int64()), pa.int64(), False),
        "open": pad(pa.array(linked[:, 2] != 0), pa.bool_(), False), "sig": pad(pa.array(large, pa.int64()), pa.int64(), True),
    })


def similar(a: np.ndarray, b: np.ndarray, t: int) -> bool:
    common = np.intersect1d(a, b, assume_unique=True).size
    return 100 * common >= t * (a.size + b.size - common)


def _checked(n: int, t: int):
    def run(batches):
        for batch in batches:
            ok = [similar(a, b, t) for a, b in zip(sets_of(batch.column(3), n), sets_of(batch.column(4), n))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(ok, pa.bool_())], names=["u", "v", "open", "ok"])

    return run


def sketch(features: np.ndarray, cells: int = SKETCH) -> np.ndarray:
    """Parities of the numbers of features in ``cells`` cells, as 64-bit words. Two sketches differ in no more bits than their sets do in
    features, so that a pair with too many differing bits can be ruled out."""
    odd = np.bincount((mix(features ^ U(0x5851F42D4C957F2D)) % U(cells)).astype(np.int64), minlength=cells) & 1
    return np.packbits(odd.astype(bool)).view(np.uint64)


def wide_sketch(features: np.ndarray) -> bytes | None:
    """A sketch of two to four cells a feature, where that is more than SKETCH: in fewer cells sets with nothing in common differ by too few bits."""
    cells = 1 << (2 * len(features) - 1).bit_length()
    return sketch(features, cells).tobytes() if cells > SKETCH else None


def folded(words: np.ndarray, cells: int) -> np.ndarray:
    """A sketch made from a larger one: both numbers of cells are powers of two, so cells with equal remainders become one."""
    return np.bitwise_xor.reduce(words.reshape(-1, cells // 64), axis=0)


def may_be_similar(x: np.ndarray, x_size: np.ndarray, y: np.ndarray, y_size: np.ndarray, t: int) -> np.ndarray:
    """Row by row: False only for sets that can't be linked, by their sizes and sketches."""
    differ = np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)
    return (differ * (100 + t) <= (100 - t) * (x_size + y_size)) & (100 * np.minimum(x_size, y_size) >= t * np.maximum(x_size, y_size))


def _words(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint64).reshape(len(column), SKETCH // 64)


def _ruled_out(t: int):
    """Pairs (u, v) with whether they may be linked."""

    def run(batches):
        for batch in batches:
            may = may_be_similar(_words(batch.column("sketch_u")), batch.column("size_u").to_numpy(), _words(batch.column("sketch_v")), batch.column("size_v").to_numpy(), t)
            yield pa.RecordBatch.from_arrays([batch.column("u"), batch.column("v"), batch.column("open"), pa.array(may, pa.bool_())], names=["u", "v", "open", "may"])

    return run


def _wide_ruled_out(t: int):
    """As ``_ruled_out``, for pairs with wide sketches, as wide as the narrower of the two."""

    def run(batches):
        for batch in batches:
            may = []
            for a, b, m, k in zip(*(batch.column(c).to_pylist() for c in ("wide_u", "wide_v", "size_u", "size_v"))):
                cells = min(len(a), len(b)) * 8
                x, y = (folded(np.frombuffer(w, np.uint64), cells)[None] for w in (a, b))
                may.append(bool(may_be_similar(x, np.array([m]), y, np.array([k]), t)[0]))
            yield pa.RecordBatch.from_arrays([batch.column("u"), batch.column("v"), batch.column("open"), pa.array(may, pa.bool_())], names=["u", "v", "open", "may"])

    return run


def _signed(n: int, t: int):
    """(sig, node) for every signature of a column of texts."""

    def run(batches):
        def rows(made: list, nodes: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(made)), pa.array(np.repeat(np.array(nodes, np.int64), [len(x) for x in made]))], names=["sig", "node"])

        for batch in batches:
            made, nodes, held = [], [], 0
            for x in sets_of(batch.column(0), n):
                if len(x):
                    made.append((np.unique(signatures(x, t) >> U(16)) << U(16)).view(np.int64))  # as the blocks have them
                    nodes.append(node_of(x))
                    held += len(made[-1])
                    if held >= 1 << 16:
                        yield rows(made, nodes)
                        made, nodes, held = [], [], 0
            if held:
                yield rows(made, nodes)

    return run


def _open_pairs(t: int, most: int):
    """Pairs (u, v) of different parts that may be linked, from rows sorted by (sig, x, y); side 0 is compared with side 1, side 2 with
    itself. A part sends ``most`` pairs of a block, half of them (or one) those most alike, half those of the least nodes; where a block
    had others, a row has the signature as ``more``."""

    def compare(rows: list, out: set) -> bool:
        node, part, size = (np.array([r[k] for r in rows]) for k in (1, 2, 3))
        bits = np.frombuffer(b"".join(r[4] for r in rows), dtype=np.uint64).reshape(len(rows), -1)
        side = np.array([r[0] for r in rows])
        found = []
        for i in np.flatnonzero(side != 1):
            j = np.flatnonzero(side == 1) if side[i] == 0 else np.arange(i + 1, len(rows))
            j = j[part[j] != part[i]]
            j = j[may_be_similar(bits[j], size[j], bits[i], size[i], t)]
            if len(j):
                found.append((np.full(len(j), i), j, np.bitwise_count(bits[j] ^ bits[i]).sum(axis=1, dtype=np.int64) / (size[j] + size[i])))
        if not found:
            return False
        i, j, alike = (np.concatenate(c) for c in zip(*found))
        u, v = np.minimum(node[i], node[j]), np.maximum(node[i], node[j])
        sent, own, pair = np.zeros(len(i), bool), np.concatenate((part[i], part[j])), np.tile(np.arange(len(i)), 2)
        for few, keys in ((max(1, most // 2), (v[pair], u[pair], alike[pair])), (most // 2, (v[pair], u[pair]))):
            order = np.lexsort((*keys, own))
            begin = np.flatnonzero(np.append(True, own[order][1:] != own[order][:-1]))
            rank = np.arange(len(order)) - np.repeat(begin, np.diff(np.append(begin, len(order))))
            sent[pair[order[rank < few]]] = True
        out.update(zip(u[sent].tolist(), v[sent].tolist()))
        return not sent.all()

    def run(batches):
        out, held, piece, rows = set(), set(), None, []

        def batch_of() -> pa.RecordBatch:
            made = [(u, v, None) for u, v in out] + [(None, None, x) for x in held]
            return pa.RecordBatch.from_pydict({c: pa.array([m[k] for m in made], pa.int64()) for k, c in enumerate(("u", "v", "more"))})

        for batch in batches:
            for sig, x, y, *row in zip(*[c.to_pylist() for c in batch.columns]):
                if (sig, x, y) != piece:
                    if len(rows) > 1 and compare(rows, out):
                        held.add(piece[0])
                    piece, rows = (sig, x, y), []
                    if len(out) + len(held) > 100_000:
                        yield batch_of()
                        out.clear()
                        held.clear()
                rows.append(row)
        if len(rows) > 1 and compare(rows, out):
            held.add(piece[0])
        yield batch_of()

    return run


def _open_signatures(checked: DataFrame, linked: DataFrame, signed_of, marks: DataFrame, large: DataFrame) -> DataFrame:
    """(sig, node) of the signatures that lie in several parts (components of the checked links).

    Such a signature, if it has more than two nodes, holds a refused link between two parts: its nodes reach its least node by links of the tasks and of the bucket, and
    these can't all stay in one part. So the signatures of the nodes on such links tell which ones lie in several parts. ``large`` has the
    signatures of more than two nodes; the others are settled by the check of their one link. Every node of a signature found has a link, so ``marks`` has it."""
    nodes = durable(_parted(marks.select("node"), linked))
    end = lambda c: nodes.select(F.col("node").alias(c), F.col("part").alias(f"part_{c}"))
    across = checked.where("not ok and open").join(end("u"), "u").join(end("v"), "v").where("part_u <> part_v")
    ends = durable(across.select(F.explode(F.array("u", "v")).alias("node")).distinct())
    first = signed_of(ends, large).join(nodes, "node")
    shared = durable(first.groupBy("sig").agg(F.min("part").alias("a"), F.max("part").alias("b")).where("a <> b").select("sig"))
    # the bitmap is only a first sieve, so that few signatures are shuffled; the join decides
    return durable(signed_of(nodes, shared).join(shared, "sig").select("sig", "node").distinct())


def _parted(nodes: DataFrame, linked: DataFrame) -> DataFrame:
    """``nodes`` with their part: the root of their links, or themselves."""
    return nodes.join(linked.select("node", F.col("root").alias("part")), "node", "left").withColumn("part", F.coalesce("part", "node"))


def _open_links(signed: DataFrame, linked: DataFrame, marks: DataFrame, t: int, most: int) -> DataFrame:
    """(u, v, more) of the nodes that share a signature and lie in different parts, block by block (see ``_open_pairs``)."""
    parted = durable(_parted(signed, linked))
    sizes = durable(parted.groupBy("sig").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"), F.min("part").alias("a"), F.max("part").alias("b")).where("a <> b").select("sig", "blocks"))
    members = parted.join(sizes, "sig").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks").cast("long")).cast("int"))
    # a block meets itself and every later one
    each = F.explode(F.expr("transform(sequence(0, blocks - 1), o -> struct(least(block, o) as x, greatest(block, o) as y, if(o = block, 2, if(block < o, 0, 1)) as side))"))
    work = members.select("sig", "node", "part", each.alias("w")).select("sig", "w.x", "w.y", "w.side", "node", "part").join(marks, "node")
    work = work.select("sig", "x", "y", "side", "node", "part", "size", "sketch").repartition("sig", "x", "y").sortWithinPartitions("sig", "x", "y")
    return work.mapInArrow(trimmed(_open_pairs(t, most)), "u long, v long, more long")


def _merged(linked: DataFrame, more: DataFrame) -> DataFrame:
    """(node, root) after the links ``more`` have joined parts of ``linked``."""
    part = lambda c: linked.select(F.col("node").alias(c), F.col("root").alias(f"part_{c}"))
    parts = more.join(part("u"), "u", "left").join(part("v"), "v", "left").select(F.coalesce("part_u", "u").alias("u"), F.coalesce("part_v", "v").alias("v"))
    joined = durable(components(parts).select(F.col("node").alias("part"), F.col("root").alias("joined")))
    # nodes without a checked link are parts of their own
    parts = linked.select("node", F.col("root").alias("part")).unionByName(joined.select(F.col("part").alias("node"), "part").join(linked, "node", "left_anti").select("node", "part"))
    return parts.join(joined, "part", "left").select("node", F.coalesce("joined", "part").alias("root"))


def _rooted(docs: DataFrame, n: int, t: int, id_col: str, text_col: str) -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, node (its set's name, null without one), root (the least node that links reach)."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    nodes = durable(rows.mapInArrow(_nodes(n), "id long, n_shingles long, node long, sketch binary, wide binary"))
    per_band = (100 - t) / (100 + t) * 2 * BAND * 2
    total = nodes.agg(F.sum(F.col("n_shingles") * per_band + 3)).first()[0] or 0
    buckets = max(shuffle_partitions(spark), math.ceil(total / FLUSH))
    blocks = rows.select("text").mapInArrow(_signature_blocks(n, t, buckets), "bucket int, sigs binary, nodes binary, places binary, big binary, links binary")
    found = durable(blocks.groupBy("bucket").applyInArrow(trimmed(_bucket_links), "u long, v long, open boolean, sig long"))
    large = found.where("sig is not null").select("sig")
    found = durable(found.where("sig is null").groupBy(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).agg(F.max("open").alias("open")))
    wanted = durable(found.select(F.explode(F.array("u", "v")).alias("node")).distinct())
    known = nodes.join(wanted, "node").groupBy("node").agg(F.min("id").alias("id"), F.max("n_shingles").alias("size"), F.max("sketch").alias("sketch"), F.max("wide").alias("wide"))
    marks = durable(known)  # a node's least id, from which its text is found again

    def with_node(batches):
        for batch in batches:
            ids = [node_of(s) if len(s) else None for s in sets_of(batch.column(1), n)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ids, pa.int64())], names=["id", "text", "node"])

    def asked_rows(asked: DataFrame) -> DataFrame:
        """The rows whose id may be among ``own`` of ``asked``, without a shuffle."""
        return maybe_in(rows.withColumn("key", F.coalesce("id", F.lit(-1))), F.col("key"), asked.select("own"), F.coalesce("own", F.lit(-1))).select("id", "text")

    def signed_of(some: DataFrame, sigs: DataFrame) -> DataFrame:
        """(sig, node) of at least the nodes ``some``, with at least those of their signatures that are among ``sigs``; no text is shuffled."""
        asked = some.join(marks.select("node", F.col("id").alias("own")), "node")
        made = asked_rows(asked).select("text").mapInArrow(trimmed(_signed(n, t)), "sig long, node long")
        return maybe_in(made, F.col("sig"), sigs, F.col("sig"), 1 << 26)

    def texts_of(some: DataFrame) -> DataFrame:
        """``some`` (node and more) with the text of each node: only texts whose id may be asked for leave the scan, and each is shuffled once."""
        asked = some.join(marks.select("node", F.col("id").alias("own")), "node")
        own = asked_rows(asked)
        # merged, not broadcast, and by the node alone, so that repeated rows of a node meet in the same shuffle
        same = F.col("id").between(F.col("own"), F.col("own")) | (F.col("id").isNull() & F.col("own").isNull())
        held = own.mapInArrow(trimmed(with_node), "id long, text string, node long").join(asked.hint("merge"), "node").where(same)
        return durable(held.dropDuplicates(["node"]).select(*some.columns, "text"))

    def check(pairs: DataFrame) -> DataFrame:
        """(u, v, ok): by sizes and sketches, by wide sketches, then by the texts of the pairs that are left."""
        side = lambda df, c, cols: df.select(F.col("node").alias(c), *[F.col(x).alias(f"{x}_{c}") for x in cols])
        sized = pairs.join(side(marks, "v", ("size", "sketch")), "v").join(side(marks, "u", ("size", "sketch")), "u")
        may = durable(sized.mapInArrow(trimmed(_ruled_out(t)), "u long, v long, open boolean, may boolean"))
        wide = marks.where("wide is not null")
        both = may.where("may").join(side(wide, "v", ("size", "wide")), "v").join(side(wide, "u", ("size", "wide")), "u")
        apart = durable(both.mapInArrow(trimmed(_wide_ruled_out(t)), "u long, v long, open boolean, may boolean").where("not may").select("u", "v"))
        may = durable(may.join(apart.withColumn("apart", F.lit(True)), ["u", "v"], "left").select("u", "v", "open", (F.col("may") & F.col("apart").isNull()).alias("may")))
        asked = may.where("may")
        own = texts_of(asked.select(F.explode(F.array("u", "v")).alias("node")).distinct())
        left = asked.join(side(own, "v", ("text",)), "v").join(side(own, "u", ("text",)), "u").select("u", "v", "open", "text_u", "text_v")
        return durable(left.mapInArrow(trimmed(_checked(n, t)), "u long, v long, open boolean, ok boolean").unionByName(may.where("not may").select("u", "v", "open", F.lit(False).alias("ok"))))

    checked = check(found)
    roots, most = durable(components(checked.where("ok").select("u", "v"))), FIRST
    signed = None if checked.where("not ok and open").isEmpty() else _open_signatures(checked, roots, signed_of, marks, large)
    while signed is not None:
        pairs = durable(_open_links(signed, roots, marks, t, most))
        new = check(pairs.where("more is null").select("u", "v").distinct().withColumn("open", F.lit(True)).join(checked.select("u", "v"), ["u", "v"], "left_anti"))
        roots = durable(_merged(roots, new.where("ok")))
        held = durable(pairs.where("more is not null").select(F.col("more").alias("sig")).distinct())
        if held.isEmpty():
            break
        # the other signatures have sent all their pairs
        signed, checked, most = durable(signed.join(held, "sig")), durable(checked.unionByName(new)), most * MORE
    return durable(nodes.join(roots, "node", "left").select("id", "n_shingles", "node", F.coalesce("root", "node").alias("root")))


def jaccard_groups(docs: DataFrame, n: int = 3, t: int = 90, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (the least doc_id that links reach, the row's own included).

    Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; a text of fewer than ``n`` words is one shingle; null, empty and blank
    texts have no shingles and link with nothing. Rows with equal sets are linked, also rows that repeat an id; a null id is
    never the least. An empty table gives no rows; other columns aren't read."""
    rooted = _rooted(docs, n, t, id_col, text_col)
    least = durable(rooted.where("root is not null").groupBy("root").agg(F.min("id").alias("least"), F.count("*").alias("n")).where("n > 1"))
    return rooted.join(least, "root", "left").select(F.col("id").alias("doc_id"), "n_shingles", F.when(F.col("least").isNull(), F.col("id")).otherwise(F.col("least")).alias("component_id"))


def keep_one(docs: DataFrame, n: int = 5, t: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that remain when of each group of linked rows one stays, with all their columns, whatever their names.

    The row with the least id stays, null ids after all others; of several rows with this id the one whose set has the least name, and of rows that
    repeat id and set the one with the least hash over all columns (one of them if they agree in that too). Rows are told apart by id and set, so another row
    with the id of a dropped one isn't touched. Documents without words stay; an empty table gives no rows."""
    plain, (id_col, text_col), named = positional(docs, id_col, text_col)
    rooted = _rooted(plain, n, t, id_col, text_col)
    first = F.struct(F.col("id").isNull().alias("none"), "id", "node")
    groups = rooted.where("root is not null").groupBy("root").agg(F.min(first).alias("first"), F.count("*").alias("n")).where("n > 1")
    kept = durable(groups.select("root", "first.id", "first.node"))
    # every set of a group of several rows, with the row that stays
    sets = durable(rooted.where("root is not null").select("node", "root").distinct().join(kept.select("root", F.col("id").alias("kept_id"), F.col("node").alias("kept_node")), "root").select(F.col("node").alias("own_node"), "kept_id", "kept_node"))
    at = plain.columns.index(text_col)

    def with_node(batches):
        for batch in batches:
            ids = [node_of(s) if len(s) else None for s in sets_of(batch.column(at), n)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids, pa.int64())], names=[*batch.schema.names, "node"])

    # only rows whose id is some grouped row's are looked at
    ids = durable(rooted.join(kept.select("root"), "root").select("id").distinct())
    maybe, rest = split_by(plain, F.coalesce(F.col(id_col).cast("long"), F.lit(-1)), ids, F.coalesce("id", F.lit(-1)))
    marked = maybe.select(*plain.columns).mapInArrow(trimmed(with_node), T.StructType([*plain.schema.fields, T.StructField("node", T.LongType())]))
    joined = marked.join(sets, F.col("node") == F.col("own_node"), "left")
    alone = joined.where("own_node is null")
    firsts = joined.where("own_node = kept_node").where(F.col(id_col).cast("long").eqNullSafe(F.col("kept_id"))).withColumn("hash", F.xxhash64(*plain.columns))
    # rows that repeat the one that stays: partial aggregates leave one for each task
    least = durable(firsts.groupBy("node").agg(F.min("hash").alias("least")))
    one = firsts.join(least, "node").where("hash = least").dropDuplicates(["node"])
    return named(rest.select(*plain.columns).unionByName(alone.select(*plain.columns)).unionByName(one.select(*plain.columns)))
