"""Removal of repeated byte strings, by suffix arrays of shards.

A byte goes when a string of LENGTH bytes covers it that also starts in a document with a smaller id. Comparing every suffix of the
corpus with every other shard would grow with the square of the corpus, so each window of LENGTH bytes is filed under its anchor: the
run of GRAM bytes in it with the least hash, the leftmost of equals. Equal windows have equal anchors, so only windows of one anchor need
be compared, and windows in a row mostly share theirs: an anchor's windows travel as one context of LENGTH bytes and some more.

1. Anchors that occur once in the corpus are dropped, by a Bloom filter of the others (of bounded size; a false positive only costs work).
2. A task that meets a context again, in a larger document, knows that all its windows go. Only the context's first document travels,
   so a passage that a third of all documents share is a single entry for each task.
3. A bucket of anchors packs its distinct contexts into shards, but for those none of whose windows' hashes occurs once more. Each shard's suffix array is sorted by Larsson-Sadakane refinement, doubling
   the depth for those groups that aren't single yet; common prefixes of neighbours come by Kasai's rule. Neighbours with LENGTH
   bytes in common form a run, whose least document counts. Shards are merged by binary search of each one's runs in the merged table.
4. The spans found are joined with their documents.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable, shuffle_partitions, split_by, trimmed
from .textvec import mix, row_slices, utf8, word_hashes

U = np.uint64
LENGTH, GRAM = 50, 20
#: Bytes of text looked at together; a longer row goes in pieces that overlap.
STEP = 1 << 19
_PLACE = 20  # bits of a place within such a piece
#: Keys that a task gathers before it sends them on, and bytes of its contexts with all that is held beside them.
FLUSH_KEYS, FLUSH_BYTES = 4_000_000, 40 << 20
#: Bytes looked at together when contexts are compared or copied, which bounds the scratch memory (some 20 times as much).
COPY_BYTES = 1 << 20
#: Text for each bucket of contexts, keys for each bucket of anchors, bytes of contexts in a shard.
BUCKET_TEXT, BUCKET_KEYS, SHARD = 4 << 20, 2_000_000, 2 << 20
#: Bound of the filter of anchors that occur again.
FILTER_BYTES = 128 << 20


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the GRAM bytes from each place on."""
    two = data[:-1].astype(np.uint16) | data[1:].astype(np.uint16) << np.uint16(8)
    four = two[:-2].astype(np.uint32) | two[2:].astype(np.uint32) << np.uint32(16)
    eight = four[:-4].astype(np.uint64) | four[4:].astype(np.uint64) << U(32)
    n = len(data) - GRAM + 1
    return mix(eight[:n] * U(0x9E3779B97F4A7C15) + eight[8:8 + n] * U(0xC2B2AE3D27D4EB4F) + four[16:16 + n].astype(np.uint64) * U(0xD6E8FEB86659FD93))


def pieces(offsets: np.ndarray):
    """(first byte, end byte, rows, their first bytes, their ends, bytes of the row before the piece) of pieces of up to STEP bytes."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + STEP, "right")) - 1)
        a, b = int(offsets[i]), int(offsets[j])
        if b - a <= STEP:
            yield a, b, np.arange(i, j), offsets[i:j], offsets[i + 1:j + 1], 0
        else:
            for c in range(a, b - LENGTH + 1, STEP - LENGTH + 1):
                d = min(b, c + STEP)
                yield c, d, np.array([i]), np.array([c]), np.array([d]), c - a
        i = j


def anchors(data: np.ndarray, offsets: np.ndarray):
    """For some rows at a time, arrays by anchor: (hash, first and last window start as bytes of ``data``, row, place of the first window in
    the row, bytes from there to the anchor)."""
    for a, b, rows, begins, ends, base in pieces(offsets):
        if b - a < LENGTH:
            continue
        hashes = gram_hashes(data[a:b])
        low = (hashes >> U(_PLACE) << U(_PLACE)) | np.arange(len(hashes), dtype=np.uint64)
        width = LENGTH - GRAM + 1
        reach = 1
        while reach * 2 <= width:
            low = np.minimum(low[:-reach], low[reach:])
            reach *= 2
        low = np.minimum(low[:len(low) - (width - reach)], low[width - reach:])
        edge = np.zeros(b - a + 1, dtype=np.int32)
        long = ends - begins >= LENGTH
        edge[begins[long] - a] += 1
        edge[ends[long] - a - LENGTH + 1] -= 1
        start = np.flatnonzero(np.cumsum(edge)[:b - a] > 0)
        if not len(start):
            continue
        at = (low[start] & U((1 << _PLACE) - 1)).astype(np.int64)
        new = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (start[1:] != start[:-1] + 1))))
        first, last = start[new], start[np.concatenate((new[1:] - 1, [len(start) - 1]))]
        row = np.searchsorted(begins, first + a, "right") - 1
        yield hashes[at[new]], first + a, last + a, rows[row], first + a - begins[row] + base, at[new] - first


def _shares(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys >> U(32)) * U(buckets) >> U(32)).astype(np.int64)


def _parted(order_by: np.ndarray):
    """(sorting order, distinct values, start and end of each in that order)."""
    order = np.argsort(order_by, kind="stable")
    which, begin = np.unique(order_by[order], return_index=True)
    return order, which, begin, np.append(begin[1:], len(order))


def _all_anchors(buckets: int):
    names = ["bucket", "keys", "again"]

    def blocks(parts: list):
        keys, n = np.unique(np.concatenate(parts), return_counts=True)
        order, which, begin, _ = _parted(_shares(mix(keys), buckets))  # mixed: anchors are minima, so their own leading bits are mostly zero
        keys, n = keys[order], n[order]
        rows = [(int(w), keys[i:j].tobytes(), np.packbits(n[i:j] > 1).tobytes()) for w, i, j in zip(which, begin, np.append(begin[1:], len(keys)))]
        for k in range(0, len(rows), 256):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[k:k + 256]), (pa.int32(), pa.binary(), pa.binary()))], names=names)

    def run(batches):
        parts, held = [], 0
        for batch in batches:
            for keys, *_ in anchors(*utf8(batch.column(0))):
                parts.append(keys)
                held += len(keys)
                if held >= FLUSH_KEYS:
                    yield from blocks(parts)
                    parts, held = [], 0
        if held:
            yield from blocks(parts)

    return run


def _filter_shard(max_bits: int):
    """A bucket's bits of the anchors that occur again."""

    def run(table: pa.Table) -> pa.Table:
        keys = [np.frombuffer(k, dtype=np.uint64) for k in table.column("keys").to_pylist()]
        again = [np.unpackbits(np.frombuffer(a, dtype=np.uint8), count=len(k)).astype(bool) for k, a in zip(keys, table.column("again").to_pylist())]
        each = np.sort(np.concatenate(keys))
        more = np.unique(np.concatenate([each[1:][each[1:] == each[:-1]], *[k[a] for k, a in zip(keys, again)]]))
        bits = min(max_bits, 64 * max(1, math.ceil(len(more) * 16 / 64)))
        made = np.zeros(bits, dtype=bool)
        made[_filter_place(more, U(bits)).astype(np.int64)] = True
        return pa.table({"bucket": pa.array([table.column("bucket")[0].as_py()], pa.int32()), "bits": pa.array([np.packbits(made, bitorder="little").tobytes()], pa.binary())})

    return run


def _filter_place(keys: np.ndarray, bits) -> np.ndarray:
    """A place that has nothing to do with the bucket of a key."""
    return ((mix(keys ^ U(0x5851F42D4C957F2D)) >> U(32)) * bits) >> U(32)


class Again:
    """The filter of anchors that may occur more than once."""

    def __init__(self, shards: list[bytes]):
        sizes = np.array([len(s) for s in shards], dtype=np.int64)
        self.bits, self.starts, self.sizes = np.frombuffer(b"".join(shards), dtype=np.uint8), np.cumsum(sizes) - sizes, sizes * 8

    def has(self, keys: np.ndarray) -> np.ndarray:
        bucket = _shares(mix(keys), len(self.sizes))
        at = _filter_place(keys, self.sizes[bucket].astype(np.uint64)).astype(np.int64)
        byte = self.bits[np.minimum(self.starts[bucket] + (at >> 3), len(self.bits) - 1)]
        return (self.sizes[bucket] > 0) & ((byte >> (at & 7).astype(np.uint8)) & 1 == 1)


def merged(begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the bytes that the spans cover."""
    order = np.argsort(begins, kind="stable")
    begins, ends = begins[order], np.maximum.accumulate(ends[order])
    new = np.concatenate(([True], begins[1:] > ends[:-1]))
    return begins[new], ends[np.append(np.flatnonzero(new)[1:] - 1, len(ends) - 1)]


def _merged_by(rid: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Rows (rid, begin, end) of the merged spans of each row."""
    if not len(rid):
        return np.zeros((0, 3), dtype=np.int64)
    order, which, i, j = _parted(rid)
    out = []
    for w, a, b in zip(which, i, j):
        x, y = merged(begins[order[a:b]], ends[order[a:b]])
        out.append(np.stack((np.full(len(x), w), x, y), axis=1))
    return np.concatenate(out)


_BLOCK = pa.schema([("bucket", pa.int32()), ("text", pa.binary()), ("lens", pa.binary()), ("leads", pa.binary()), ("doc", pa.binary()), ("rid", pa.binary()), ("begin", pa.binary()), ("spans", pa.binary())])


class _Held:
    """A task's contexts in columns: all texts one after the other, and by context its bucket, lead, document, row and place."""

    def __init__(self):
        self.texts: list[np.ndarray] = []
        self.columns: list[list[np.ndarray]] = [[] for _ in range(7)]  # length, bucket, lead, document, row, place, hash
        self.nbytes = 0

    def add(self, data, starts, lens, bucket, lead, doc, rid, place) -> None:
        if not len(starts):
            return
        begin = np.cumsum(lens) - lens
        text = _copied(data, starts, lens)
        name = mix(word_hashes(text, begin, begin + lens) ^ lead.astype(np.uint64))
        self.texts.append(text)
        row = (lens.astype(np.uint8), bucket.astype(np.int32), lead.astype(np.uint8), doc, rid, place, name)
        for column, values in zip(self.columns, row):
            column.append(values)
        self.nbytes += text.nbytes + sum(v.nbytes for v in row)

    def first_documents(self):
        """(text, start and length of each context, bucket, lead, document, row, place) of the contexts of each one's first document, and the
        spans (row, begin, end) of the others: a context that an earlier document of this task holds goes as a whole.

        Contexts are told apart by a hash and compared with the first of the same hash; one that differs counts as a context of its own."""
        text = np.concatenate(self.texts)
        lens, bucket, lead, doc, rid, place, name = (np.concatenate(c) for c in self.columns)
        self.__init__()
        lens = lens.astype(np.int64)
        starts = np.cumsum(lens) - lens
        order = np.lexsort((doc, name))
        new = np.append(True, name[order][1:] != name[order][:-1])
        first = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
        later = doc[order] > doc[first]
        later[later] = _equal(text, starts, lens, lead, order[later], first[later])
        gone, stay = order[later], order[~later]
        spans = np.stack((rid[gone], place[gone], place[gone] + lens[gone]), axis=1)
        stay = stay[np.argsort(bucket[stay], kind="stable")]
        return text, starts[stay], lens[stay], bucket[stay], lead[stay], doc[stay], rid[stay], place[stay], spans


def _copied(data: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The spans of ``data`` one after the other."""
    upto = np.cumsum(lens)
    out = np.empty(int(upto[-1]) if len(upto) else 0, np.uint8)
    i = 0
    while i < len(lens):
        base = upto[i] - lens[i]
        j = max(i + 1, int(np.searchsorted(upto, base + COPY_BYTES, "right")))
        n = lens[i:j]
        at = np.arange(int(upto[j - 1] - base)) + np.repeat(starts[i:j] - (upto[i:j] - n - base), n)
        out[base:upto[j - 1]] = data[at]
        i = j
    return out


def _equal(text, starts, lens, lead, a, b) -> np.ndarray:
    """Whether contexts a[i] and b[i] are equal in text and lead."""
    same = (lens[a] == lens[b]) & (lead[a] == lead[b])
    pairs = np.flatnonzero(same)
    step = max(1, COPY_BYTES // 128)
    for i in range(0, len(pairs), step):
        k = pairs[i:i + step]
        n = lens[a[k]]
        upto = np.cumsum(n)
        within = np.arange(int(upto[-1])) - np.repeat(upto - n, n)
        differs = text[np.repeat(starts[a[k]], n) + within] != text[np.repeat(starts[b[k]], n) + within]
        same[k] = np.add.reduceat(differs, upto - n) == 0
    return same


def _contexts(buckets: int, shared):
    """A task's contexts, each with its first document only, and the spans that it can tell by itself."""

    def blocks(held: _Held):
        text, starts, lens, bucket, lead, doc, rid, place, spans = held.first_documents()
        own = _merged_by(*spans.T)
        which, begin = np.unique(bucket, return_index=True)
        if not len(which):
            which, begin = np.array([0]), np.array([0])
        end = np.append(begin[1:], len(bucket))
        shares = np.linspace(0, len(own), len(which) + 1).astype(int)
        rows, size = [], 0

        def out():
            batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _BLOCK)], schema=_BLOCK)
            rows.clear()
            return batch

        for w, i, j, x, y in zip(which.tolist(), begin.tolist(), end.tolist(), shares[:-1].tolist(), shares[1:].tolist()):
            part = _copied(text, starts[i:j], lens[i:j]).tobytes()
            rows.append((w, part, lens[i:j].astype(np.uint8).tobytes(), lead[i:j].tobytes(), doc[i:j].tobytes(), rid[i:j].tobytes(), place[i:j].tobytes(), own[x:y].tobytes()))
            size += len(part)
            if size > 2 * COPY_BYTES or len(rows) >= 64:
                yield out()
                size = 0
        if rows:
            yield out()

    def run(batches):
        again, held = Again(shared.value), _Held()
        for batch in batches:
            ids, rids = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            data, offsets = utf8(batch.column(2))
            for keys, first, last, row, place, lead in anchors(data, offsets):
                hit = np.flatnonzero(again.has(keys))
                held.add(data, first[hit], last[hit] + LENGTH - first[hit], _shares(mix(keys[hit]), buckets), lead[hit], ids[row[hit]], rids[row[hit]], place[hit])
                if held.nbytes >= FLUSH_BYTES:
                    yield from blocks(held)
        if held.nbytes:
            yield from blocks(held)

    return run


def suffix_array(data: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes in the order of their first ``depth`` bytes, rank of each): Larsson-Sadakane refinement. Suffixes equal to that
    depth have one rank, the place of their group; what lies beyond the end sorts first."""
    n = len(data)
    padded = np.concatenate((data, np.zeros(8, dtype=np.uint8))).astype(np.uint64)
    word = np.zeros(n, dtype=np.uint64)
    at = min(7, depth)
    for k in range(at):
        word |= padded[k:k + n] << U(56 - 8 * k)
    word |= np.minimum(np.arange(n, 0, -1), at).astype(np.uint64)  # bytes that there are
    order = np.argsort(word, kind="stable")
    sorted_words = word[order]
    new = np.concatenate(([True], sorted_words[1:] != sorted_words[:-1]))
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    while at < depth:
        step = min(at, depth - at)
        size = np.diff(np.append(np.flatnonzero(new), n))
        open_ = np.repeat(size > 1, size)  # places in groups that aren't single
        if not open_.any():
            break
        place = np.flatnonzero(open_)
        suffix = order[place]
        after = np.where(suffix + step < n, rank[np.minimum(suffix + step, n - 1)] + 1, 0)
        key = rank[suffix].astype(np.uint64) << U(32) | after.astype(np.uint64)
        turn = np.argsort(key, kind="stable")  # groups stay where they are, as the rank leads
        suffix, key = suffix[turn], key[turn]
        order[place] = suffix
        fresh = np.concatenate(([True], key[1:] != key[:-1]))
        new[place] = fresh
        rank[suffix] = np.maximum.accumulate(np.where(fresh, place, 0))
        at += step
    return order, rank


def common_prefixes(data: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """Bytes, up to ``most``, that each suffix has in common with the one before it in ``order``. Kasai's rule: if the bytes before the
    two are equal, the answer is that of the place before, less one; only the other places are compared byte by byte."""
    n = len(data)
    before = np.full(n, -1, dtype=np.int64)
    before[order[1:]] = order[:-1]
    i = np.arange(n)
    follows = (i > 0) & (before > 0)
    follows[1:] &= data[:-1] == data[np.maximum(before[1:], 1) - 1]
    # the suffix before this one must also be the one before its predecessor, moved on by one
    follows[1:] &= before[:-1] == before[1:] - 1
    out = np.zeros(n, dtype=np.int64)
    left = np.flatnonzero(~follows & (before >= 0))
    reach = most + 64
    while len(left):
        a, b = left + out[left], before[left] + out[left]
        inside = (a < n) & (b < n)
        left, a, b = left[inside], a[inside], b[inside]
        left = left[data[a] == data[b]]
        out[left] += 1
        left = left[out[left] < reach]
    lead = np.maximum.accumulate(np.where(follows, 0, i))
    full = np.where(follows, np.maximum(out[lead] - (i - lead), 0), out)
    # a chain that runs past the bound is compared anew from where the bound bites
    late = np.flatnonzero(follows & (out[lead] >= reach) & (full < most))
    while len(late):
        a, b = late + full[late], before[late] + full[late]
        inside = (a < n) & (b < n)
        late, a, b = late[inside], a[inside], b[inside]
        late = late[data[a] == data[b]]
        full[late] += 1
        late = late[full[late] < most]
    return np.minimum(full, most)[order]


def _least_documents(contexts: list[bytes], docs: np.ndarray) -> list[np.ndarray]:
    """For every context the least document of each of its windows, among all contexts."""
    lens = np.array([len(c) for c in contexts])
    upto = np.cumsum(lens)
    cuts = [0]
    while cuts[-1] < len(contexts):
        cuts.append(max(cuts[-1] + 1, int(np.searchsorted(upto, (upto[cuts[-1] - 1] if cuts[-1] else 0) + SHARD, "right"))))
    shards, table, least = [], None, None
    for i, j in zip(cuts[:-1], cuts[1:]):
        data = np.frombuffer(b"".join(contexts[i:j]), dtype=np.uint8)
        n = lens[i:j]
        begin = np.cumsum(n) - n
        windows = n - LENGTH + 1
        at = np.arange(int(windows.sum())) - np.repeat(np.cumsum(windows) - windows, windows) + np.repeat(begin, windows)
        owner = np.full(len(data), np.iinfo(np.int64).max)
        owner[at] = np.repeat(docs[i:j], windows)
        order, _ = suffix_array(data, LENGTH)
        run = np.flatnonzero(common_prefixes(data, order, LENGTH) < LENGTH)  # where a run of equal windows starts
        if not len(run) or run[0]:
            run = np.concatenate(([0], run))
        low = np.minimum.reduceat(owner[order], run)
        of = np.empty(len(data), dtype=np.int64)
        of[order] = np.repeat(np.arange(len(run)), np.diff(np.append(run, len(order))))
        shards.append((of[at], low, windows, data, order, run))
    if len(shards) > 1:  # merge the shards' runs by binary search; a byte after each keeps zero bytes at its end apart
        named = []
        for of, low, _, data, order, run in shards:
            real = np.unique(of)
            first = order[run[real]]
            inside = first + LENGTH <= len(data)
            real, first = real[inside], first[inside]
            text = np.empty((len(real), LENGTH + 1), dtype=np.uint8)
            text[:, :LENGTH] = data[first[:, None] + np.arange(LENGTH)]
            text[:, LENGTH] = 1
            names = np.ascontiguousarray(text).view(f"S{LENGTH + 1}").ravel()
            named.append((real, names))
            if table is None:
                table, least = names, low[real]
                continue
            place = np.searchsorted(table, names)
            known = table[np.minimum(place, len(table) - 1)] == names
            least[place[known]] = np.minimum(least[place[known]], low[real[known]])
            table, least = np.insert(table, place[~known], names[~known]), np.insert(least, place[~known], low[real[~known]])
        for (_, low, *_), (real, names) in zip(shards, named):
            low[real] = least[np.searchsorted(table, names)]
    out = []
    for of, low, windows, *_ in shards:
        out += np.split(low[of], np.cumsum(windows)[:-1])
    return out


def window_hashes(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A hash of the LENGTH bytes from each start on."""
    out = np.empty(len(starts), dtype=np.uint64)
    order = [*range(0, LENGTH - 8, 8), LENGTH - 8]
    for i in range(0, len(data) - LENGTH + 1, STEP // 8):  # little at a time stays in the processor's cache
        part = data[i:i + STEP // 8 + LENGTH - 1]
        two = part[:-1].astype(np.uint16) | part[1:].astype(np.uint16) << np.uint16(8)
        four = two[:-2].astype(np.uint32) | two[2:].astype(np.uint32) << np.uint32(16)
        eight = mix(four[:-4].astype(np.uint64) | four[4:].astype(np.uint64) << U(32))
        n = len(part) - LENGTH + 1
        made = eight[:n].copy()
        for k, at in enumerate(order[1:], 1):
            made += eight[at:at + n] * U((0x9E3779B97F4A7C15 * (2 * k + 1)) % (1 << 64) | 1)
        x, y = np.searchsorted(starts, (i, i + n))
        out[x:y] = made[starts[x:y] - i]
    return out


def _windows(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Where the windows of contexts start."""
    n = lens - LENGTH + 1
    return np.arange(int(n.sum())) + np.repeat(starts - (np.cumsum(n) - n), n)


def _distinct(data, starts, lens, lead, names) -> tuple[np.ndarray, np.ndarray]:
    """(first of the entries of each distinct context, its number by entry). ``names`` are hashes; an entry that differs from the first of its
    hash counts as a context of its own."""
    order = np.argsort(names, kind="stable")
    new = np.append(True, names[order][1:] != names[order][:-1])
    first = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    late = np.flatnonzero(~new)
    new[late[~_equal(data, starts, lens, lead, order[late], first[late])]] = True
    of_first = np.empty(len(order), dtype=np.int64)
    of_first[order[new]] = np.arange(int(new.sum()))
    which = np.empty(len(order), dtype=np.int64)
    which[order] = of_first[np.where(new, order, first)]
    return order[new], which


def _meet(names: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Which contexts may have a window that occurs once more, from the hashes of all their windows; the others' windows need no search."""
    each = np.sort(names)
    more = each[1:][each[1:] == each[:-1]]
    bits = 1 << max(10, (16 * len(more)).bit_length())
    again = np.zeros(bits, dtype=bool)
    again[(more & U(bits - 1)).astype(np.int64)] = True
    found = again[(names & U(bits - 1)).astype(np.int64)]
    maybe = np.flatnonzero(found)
    found[maybe] = more[np.minimum(np.searchsorted(more, names[maybe]), len(more) - 1)] == names[maybe]
    return np.logical_or.reduceat(found, np.cumsum(windows) - windows)


def _bucket_spans(table: pa.Table) -> pa.Table:
    """(rid, begin, end) of the bytes that go, from one bucket's contexts."""
    ints = lambda c, t=np.int64: np.frombuffer(b"".join(table.column(c).to_pylist()), dtype=t)
    lens, leads, doc, rid, begin = ints("lens", np.uint8).astype(np.int64), ints("leads", np.uint8), ints("doc"), ints("rid"), ints("begin")
    found = [ints("spans").reshape(-1, 3)]
    data = ints("text", np.uint8)
    if len(lens):
        ends = np.cumsum(lens)
        starts = ends - lens
        # the first and the last window hold all bytes of a context, which is shorter than two
        two = window_hashes(data, np.stack((starts, ends - LENGTH), axis=1).ravel()).reshape(-1, 2)
        name = mix(two[:, 0] * U(0xD6E8FEB86659FD93) + two[:, 1]) + (lens << 8 | leads).astype(np.uint64)
        of, which = _distinct(data, starts, lens, leads, name)
        least = np.full(len(of), np.iinfo(np.int64).max)
        np.minimum.at(least, which, doc)
        order = np.argsort(of)  # as they stand in the text
        windows = lens[of] - LENGTH + 1
        meets = np.zeros(len(of), dtype=bool)
        meets[order] = _meet(window_hashes(data, _windows(starts[of[order]], lens[of[order]])), windows[order])
        low, upto = np.repeat(least, windows), np.cumsum(windows)
        if meets.any():
            searched = [data[i:i + n].tobytes() for i, n in zip(starts[of[meets]].tolist(), lens[of[meets]].tolist())]
            low[np.repeat(meets, windows)] = np.concatenate(_least_documents(searched, least[meets]))
        # a context that an earlier document has goes as a whole; of a first document's the windows that occur elsewhere in an earlier one
        later = np.flatnonzero(doc > least[which])
        found.append(np.stack((rid[later], begin[later], begin[later] + lens[later]), axis=1))
        own = np.flatnonzero((doc == least[which]) & (np.minimum.reduceat(low, upto - windows) < least)[which])
        n = windows[which[own]]
        entry = np.repeat(own, n)
        window = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        goes = low[(upto - windows)[which[entry]] + window] < doc[entry]
        entry, window = entry[goes], window[goes]
        if len(entry):
            new = np.flatnonzero(np.concatenate(([True], (entry[1:] != entry[:-1]) | (window[1:] != window[:-1] + 1))))
            last = np.append(new[1:] - 1, len(entry) - 1)
            e = entry[new]
            found.append(np.stack((rid[e], begin[e] + window[new], begin[e] + window[last] + LENGTH), axis=1))
    rows = np.concatenate(found)
    return pa.table({c: pa.array(rows[:, k], pa.int64()) for k, c in enumerate(("rid", "begin", "end"))})


def _cut(batches):
    for batch in batches:
        data, offsets = utf8(batch.column("text"))
        spans = batch.column("spans")
        counts = spans.value_lengths().fill_null(0).to_numpy()
        upto = np.concatenate(([0], np.cumsum(counts)))
        begins, ends = (spans.flatten().field(k).to_numpy() for k in (0, 1))
        n_removed, n_spans, kept = [], [], []
        for i, j in row_slices(offsets, COPY_BYTES):
            base, raw = offsets[i], data[offsets[i]:offsets[j]]
            shift = np.repeat(offsets[i:j] - base, counts[i:j])
            edge = np.zeros(len(raw) + 1, dtype=np.int32)
            np.add.at(edge, begins[upto[i]:upto[j]] + shift, 1)
            np.add.at(edge, ends[upto[i]:upto[j]] + shift, -1)
            gone = np.cumsum(edge[:-1]) > 0
            first = gone.copy()  # of a run; spans that touch are one, those of two rows aren't
            first[1:] &= ~gone[:-1]
            begin = offsets[i:j][np.diff(offsets[i:j + 1]) > 0] - base
            first[begin] = gone[begin]
            row = np.concatenate(([0], np.cumsum(gone)))[offsets[i:j + 1] - base]
            n_removed.append(np.diff(row))
            n_spans.append(np.diff(np.concatenate(([0], np.cumsum(first)))[offsets[i:j + 1] - base]))
            left, at = raw[~gone].tobytes(), (offsets[i:j + 1] - base - row).tolist()
            kept += [left[x:y] for x, y in zip(at[:-1], at[1:])]
        digests = [hashlib.sha256(k).hexdigest() for k in kept]
        together = lambda parts: pa.array(np.concatenate(parts) if parts else [], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(np.diff(offsets), pa.int64()), together(n_removed), together(n_spans), pa.array(digests, pa.string()), pa.array(kept, pa.binary())],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
        )


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(rid, begin, end): byte spans to remove, some overlapping; rid names a row by its id and text."""
    spark = docs.sparkSession
    rows = _rows(docs, id_col, text_col)
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    key_buckets = max(shuffle_partitions(spark), math.ceil(size / 16 / BUCKET_KEYS))
    blocks = rows.select("text").mapInArrow(trimmed(_all_anchors(key_buckets)), "bucket int, keys binary, again binary")
    shards = [b""] * key_buckets
    made = blocks.groupBy("bucket").applyInArrow(trimmed(_filter_shard(FILTER_BYTES * 8 // key_buckets)), "bucket int, bits binary")
    for r in durable(made).toLocalIterator():  # FILTER_BYTES together at most
        shards[r.bucket] = bytes(r.bits)
    shared = spark.sparkContext.broadcast(shards)
    buckets = max(shuffle_partitions(spark), math.ceil(size / BUCKET_TEXT))
    contexts = rows.select("order", "rid", "text").mapInArrow(trimmed(_contexts(buckets, shared)), "bucket int, text binary, lens binary, leads binary, doc binary, rid binary, begin binary, spans binary")
    spans = durable(contexts.groupBy("bucket").applyInArrow(trimmed(_bucket_spans), "rid long, begin long, end long"))
    shared.destroy()  # no task needs it again
    return spans


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = F.col(id_col).cast("long")
    return docs.select(own.alias("id"), F.coalesce(own, F.lit(2**63 - 1)).alias("order"), F.xxhash64(own, text).alias("rid"), text.alias("text"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256, kept (the bytes left).

    Texts are UTF-8 bytes, null is empty. A null id counts as larger than any; rows that repeat an id don't remove each other's bytes. Other
    columns aren't read; an empty table gives no rows."""
    spans = repeated_spans(docs, id_col, text_col)
    by_row = durable(spans.groupBy("rid").agg(F.collect_list(F.struct("begin", "end")).alias("spans")))
    maybe, rest = split_by(_rows(docs, id_col, text_col), F.col("rid"), by_row, F.col("rid"))
    none = F.lit(None).cast("array<struct<begin:bigint,end:bigint>>")
    cut = maybe.join(by_row, "rid", "left").select("id", "text", "spans").unionByName(rest.select("id", "text", none.alias("spans")))
    return cut.mapInArrow(trimmed(_cut), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
