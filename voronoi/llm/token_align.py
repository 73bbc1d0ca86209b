"""Alignment of the tokens of two tokenizers: divide and conquer at shared cuts.

Both tokenizers cut the same bytes (a blank and the text). An interval of tokens is divided at an offset where a token of either side
ends, looked for from its middle outwards by bisecting the other side's ends, and both halves are divided in the same way; an interval without such an offset
is a group. All intervals of a slice of texts are divided together, one step at a time. Within a group every stretch between two
neighbouring ends is the overlap of exactly one token of each side: a link.

How often two ids are linked is counted over the whole corpus: tasks sum their links, one aggregate adds them. The pairs that occur
most often, as many as MAX_PAIRS, travel to the tasks; the links of the others are joined by pair, of which each has few.
"""

from __future__ import annotations

import array
import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import ForcedBpe, read_spec
from .common import durable
from .textvec import row_slices, utf8

#: Bytes of text aligned at a time; a longer text is aligned in parts of about this size.
SLICE = 512 << 10
#: Pairs that are sent to every task (17 bytes each).
MAX_PAIRS = 4_000_000
#: Links that a task gathers before it sums them, and pairs that it holds.
HELD_LINKS, HELD_PAIRS = 4_000_000, 2_000_000
#: Bounds of the cache of encoded fragments in each task, as in the other tokenizer's.
CACHE_ENTRIES, CACHE_CHARS = 400_000, 48
#: Fragments longer than this are cut between characters that no piece holds side by side.
LONG_CHARS = 4096
_FRAGMENT = re.compile(" +[^ ]*")


class Pieces:
    """Encoder with a sentence-piece model that adds a blank in front and no special tokens.

    A piece holds a blank only at its start, so a text may be cut before every run of blanks; each fragment's first blank is the one that
    the model adds. The model is refused where this doesn't hold."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = self.model.get_piece_size()
        pieces = [self.model.id_to_piece(i) for i in range(n)]
        plain = [p for i, p in enumerate(pieces) if not (self.model.is_byte(i) or self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_unused(i))]
        if any("▁" in p.lstrip("▁") or "\n" in p for p in plain):
            raise ValueError("a model whose pieces hold blanks only at their start, and no line breaks, is needed")
        self.pairs = {p[i:i + 2].replace("▁", " ") for p in plain for i in range(len(p) - 1)}
        raw = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.lens = np.array([len(r) for r in raw])
        self.starts = np.concatenate(([0], np.cumsum(self.lens)))[:-1]
        self.bytes = np.frombuffer(b"".join(raw), dtype=np.uint8)
        self.blank = np.array([self.model.piece_to_id("▁")], dtype="<u4").tobytes()
        self.cache: dict[str, bytes] = {" ": self.blank}

    def _long(self, fragment: str) -> bytes:
        """Ids of a long fragment, cut between characters that no piece holds side by side."""
        cuts = [0, *(i for i in range(1, len(fragment)) if fragment[i - 1:i + 1] not in self.pairs), len(fragment)]
        parts = [fragment[a:b] for a, b in zip(cuts, cuts[1:])]
        first = [] if parts[0] == " " else self.model.encode(parts[0][1:])
        rest = self.model.encode(["\n" + p for p in parts[1:]], num_threads=1)
        ids = [*first, *(i for r in rest for i in r[2:])]  # the blank in front and the line break stand alone
        return (self.blank if parts[0] == " " else b"") + array.array("I", ids).tobytes()

    def _learn(self, fragments: list[str]) -> None:
        """Fills the cache with short fragments, all encoded by one call."""
        if len(self.cache) + len(fragments) > CACHE_ENTRIES:
            self.cache = {" ": self.blank}
        for f, ids in zip(fragments, self.model.encode([f[1:] for f in fragments], num_threads=1)):
            self.cache[f] = array.array("I", ids).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids, as little-endian unsigned 32-bit integers, of texts that begin with the blank that the model adds."""
        split = [_FRAGMENT.findall(t) for t in texts]
        new = {f for s in split for f in s if f not in self.cache}
        once = {f: self._long(f) if len(f) > LONG_CHARS else array.array("I", self.model.encode(f[1:])).tobytes() for f in new if len(f) > CACHE_CHARS}
        short = [f for f in new if f not in once]
        for i in range(0, len(short), CACHE_ENTRIES // 8):
            self._learn(short[i:i + CACHE_ENTRIES // 8])
        get = self.cache.get
        return [b"".join([get(f) or once.get(f) or array.array("I", self.model.encode(f[1:])).tobytes() for f in s]) for s in split]


def ragged(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each length, one after the other."""
    upto = np.cumsum(lens)
    return np.arange(int(upto[-1]) if len(upto) else 0) + np.repeat(starts - (upto - lens), lens)


def shared_cuts(a_ends: np.ndarray, b_ends: np.ndarray, lasts: np.ndarray) -> np.ndarray:
    """Indexes, in order, of the tokens of the first side whose ends divide groups.

    Ends grow through all texts; ``lasts`` are the indexes of the texts' last tokens, at whose ends the other side has one too. Every
    interval [lo, hi) tries its inner ends from the middle outwards, in rings that double, and takes the nearest at which a token of the other side ends."""
    cuts = [lasts]
    lo, hi = np.concatenate(([0], lasts[:-1] + 1)), lasts + 1
    ring = np.zeros(len(lo), dtype=np.int64)
    while True:
        inner = hi - lo > 1
        lo, hi, ring = lo[inner], hi[inner], ring[inner]
        if not len(lo):
            return np.sort(np.concatenate(cuts))
        mid = (lo + hi - 2) >> 1
        near, far = (1 << ring) - 1, (2 << ring) - 2  # offsets 0, then 1-2, 3-6, 7-14, ...
        left = np.maximum(mid - far, lo)
        n_left = np.maximum(mid - near - left + 1, 0)
        right = mid + np.maximum(near, 1)
        n_right = np.maximum(np.minimum(mid + far, hi - 2) - right + 1, 0)
        found = []
        for first, n, nearest_last in ((left, n_left, True), (right, n_right, False)):
            at, own = ragged(first, n), np.repeat(np.arange(len(lo)), n)
            end = a_ends[at]
            hit = np.flatnonzero(b_ends[np.searchsorted(b_ends, end)] == end)
            hit = hit if nearest_last else hit[::-1]  # of repeated indexes the last one counts
            best = np.full(len(lo), -1)
            best[own[hit]] = at[hit]
            found.append(best)
        below, above = found
        cut = np.where((above < 0) | (below >= 0) & (mid - below <= above - mid), below, above)
        has = cut >= 0
        own = cut[has]
        cuts.append(own)
        go = ~has & ((n_left + n_right > 0) | (ring == 0))
        lo, hi, ring = np.concatenate((lo[has], own + 1, lo[go])), np.concatenate((own + 1, hi[has], hi[go])), np.concatenate((np.zeros(2 * len(own), np.int64), ring[go] + 1))


def _digits(n: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows of the ids' decimal forms, zeros behind them and at least one; their lengths)"""
    lens = np.array([len(str(i)) for i in range(n)])
    table = np.zeros((n, int(lens.max(initial=1)) + 1), np.uint8)
    for i in range(n):
        table[i, :lens[i]] = np.frombuffer(b"%d" % i, np.uint8)
    return table, lens


class Aligner:
    """Tokens, groups and links of texts under a byte-level BPE (A) and a sentence-piece model (B)."""

    def __init__(self, spec: str, model: bytes):
        self.a, self.b = ForcedBpe(spec), Pieces(model)
        self.n_b = len(self.b.lens)
        if len(self.a.lens) * self.n_b >= 1 << 32:
            raise ValueError("pairs of ids must fit 32 bits")
        self.digits, self.widths = _digits(max(len(self.a.lens), self.n_b))

    def encode(self, parts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Ids of both sides for parts that begin with a blank; None where the tokens' bytes aren't the part's. A byte-level side
        gives back every byte, so that its length is enough."""
        out = []
        for part, two in zip(parts, self.b.encode([p.decode() for p in parts])):
            a, b = (np.frombuffer(x, dtype="<u4").astype(np.int64) for x in (self.a._plain(part), two))
            lens = self.b.lens[b]
            same = int(self.a.lens[a].sum()) == len(part) == int(lens.sum()) and self.b.bytes[ragged(self.b.starts[b], lens)].tobytes() == part
            out.append((a, b) if same else None)
        return out

    def align(self, texts: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[int, int, int, bytes, np.ndarray]]:
        """For each text's ids (none empty): numbers of tokens of A and B and of groups, the groups' string, its links as a * n_b + b."""
        na, nb = (np.array([len(t[k]) for t in texts]) for k in (0, 1))
        a, b = (np.concatenate([t[k] for t in texts]) for k in (0, 1))
        ea, eb = np.cumsum(self.a.lens[a]), np.cumsum(self.b.lens[b])
        lasts = np.cumsum(na) - 1
        cuts = shared_cuts(ea, eb, lasts)
        # by byte: whether a token ends there, and how many have ended before
        is_a, is_b = np.zeros(int(ea[-1]) + 1, bool), np.zeros(int(ea[-1]) + 1, bool)
        is_a[ea] = is_b[eb] = True
        before_a, before_b = np.cumsum(is_a, dtype=np.int32) - is_a, np.cumsum(is_b, dtype=np.int32) - is_b
        b_cuts = before_b[ea[cuts]]
        # A's tokens of a group, then B's: places in the order of the groups' string
        from_a, from_b = np.append(0, cuts[:-1] + 1), np.append(0, b_cuts[:-1] + 1)
        place_a = np.arange(len(a)) + np.repeat(from_b, cuts + 1 - from_a)
        place_b = np.arange(len(b)) + np.repeat(cuts + 1, b_cuts + 1 - from_b)
        ids, sep = np.empty(len(a) + len(b), np.int64), np.full(len(a) + len(b), ord(","), np.uint8)
        ids[place_a], ids[place_b] = a, b
        sep[place_a[cuts]] = ord("|")
        sep[place_b[b_cuts]] = ord(";")
        lens = self.widths[ids]
        said = self.digits[ids]
        said[np.arange(len(ids)), lens] = sep
        said = said.reshape(-1)
        said = said[said != 0]
        said_to = np.cumsum(lens + 1)[np.cumsum(na + nb) - 1]
        # links: the stretches between neighbouring ends of either side
        ends = np.flatnonzero(is_a | is_b)
        links = (a[before_a[ends]] * self.n_b + b[before_b[ends]]).astype(np.uint32)
        groups_to = np.searchsorted(cuts, lasts) + 1
        links_to = np.cumsum(na + nb) - groups_to  # an end that both sides share counts once
        out, s0, l0, g0 = [], 0, 0, 0
        for x, y, s1, l1, g1 in zip(na.tolist(), nb.tolist(), said_to.tolist(), links_to.tolist(), groups_to.tolist()):
            out.append((x, y, g1 - g0, said[s0:s1 - 1].tobytes(), links[l0:l1]))
            s0, l0, g0 = s1, l1, g1
        return out


def parts_of(text: bytes, step: int = SLICE) -> list[bytes]:
    """A text in parts of about ``step`` bytes, cut between a letter and a blank, where tokens of both sides end whatever stands around."""
    out, at = [], 0
    while len(text) - at > step:
        m = _CUT.search(text, at + step)
        if not m:
            break
        out.append(text[at:m.start() + 1])
        at = m.start() + 1
    return [*out, text[at:]]


_CUT = re.compile(b"[A-Za-z] ")

_PART = [("row", pa.int64()), ("doc_id", pa.int64()), ("single", pa.bool_()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("links", pa.binary())]
_PART_DDL = "row long, doc_id long, single boolean, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary"


def align_parts(docs: DataFrame, spec: str, model: bytes, id_col: str = "doc_id", text_col: str = "text", step: int = SLICE) -> DataFrame:
    """One row for each part of each text: its numbers, its links, and with the last part the digest of the text's groups.

    ``row`` names a row of ``docs`` within what a run of this has written; the frame must be written once and read from there."""

    def run(batches):
        aligner = Aligner(spec, model)
        names = iter(range(TaskContext.get().partitionId() << 40, 1 << 63))
        batch_of = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows) if rows else [[]] * len(_PART), _PART)], names=[n for n, _ in _PART])
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            ids = batch.column(0).to_pylist()
            for i, j in row_slices(offsets, step):
                rows, whole = [], []
                for k in range(i, j):
                    text = b" " + data[offsets[k]:offsets[k + 1]].tobytes() if offsets[k] < offsets[k + 1] else b""
                    parts = parts_of(text, step)
                    if len(parts) == 1 and text:
                        whole.append((next(names), ids[k], text))
                    elif len(parts) == 1 or any(aligner.encode([p])[0] is None for p in parts):  # a pass of its own, so that no part of a refused text is given out
                        rows.append((next(names), ids[k], True, 0, 0, 0, 0, "", b""))
                    else:
                        name, sha = next(names), hashlib.sha256()
                        for at, p in enumerate(parts):
                            na, nb, ng, said, links = aligner.align(aligner.encode([p]))[0]
                            last = at == len(parts) - 1
                            sha.update(said if last else said + b";")
                            yield batch_of([(name, ids[k], False, na, nb, ng, len(links), sha.hexdigest() if last else None, links.tobytes())])
                coded = []
                for (name, doc, _), made in zip(whole, aligner.encode([w[2] for w in whole])):
                    if made is None:
                        rows.append((name, doc, True, 0, 0, 0, 0, "", b""))
                    else:
                        coded.append((name, doc, made))
                if coded:
                    for (name, doc, _), (na, nb, ng, said, links) in zip(coded, aligner.align([c[2] for c in coded])):
                        rows.append((name, doc, True, na, nb, ng, len(links), hashlib.sha256(said).hexdigest(), links.tobytes()))
                yield batch_of(rows)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, _PART_DDL)


def _sums(batches):
    """Links to (pair, number), summed within the task as far as it holds them."""
    keys, counts = np.zeros(0, np.uint32), np.zeros(0, np.int64)
    held: list[np.ndarray] = []

    def merged():
        new, n = np.unique(np.concatenate(held), return_counts=True)
        held.clear()
        both, at = np.unique(np.concatenate((keys, new)), return_inverse=True)
        total = np.zeros(len(both), np.int64)
        np.add.at(total, at, np.concatenate((counts, n)))
        return both, total

    out = lambda: pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(counts)], names=["pair", "n"])
    n = 0
    for batch in batches:
        for links in batch.column(0):
            held.append(np.frombuffer(links.as_buffer() or b"", dtype="<u4"))
            n += len(held[-1])
            if n >= HELD_LINKS:
                keys, counts = merged()
                n = 0
                if len(keys) > HELD_PAIRS:
                    yield out()
                    keys, counts = keys[:0], counts[:0]
        if held:
            held[:] = [np.concatenate(held)]  # a copy: the batch can go
    if held:
        keys, counts = merged()
    if len(keys):
        yield out()


def pair_counts(parts: DataFrame, n_b: int) -> DataFrame:
    """(pair, n, best): how often two ids are linked over all texts, and whether it is the highest number for the id of B."""
    pairs = parts.select("links").where("n_links > 0").mapInArrow(_sums, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    pairs = durable(pairs)
    top = pairs.groupBy((F.col("pair") % n_b).alias("b")).agg(F.max("n").alias("top"))  # as many rows at most as B has ids
    return durable(pairs.withColumn("b", F.col("pair") % n_b).join(F.broadcast(top), "b").select("pair", "n", (F.col("n") == F.col("top")).alias("best")))


def _frequent(pairs: DataFrame, most: int) -> int:
    """The least power of two such that no more than ``most`` pairs are as frequent."""
    bins = pairs.groupBy(F.floor(F.log2("n") + 1e-9).cast("int").alias("k")).count().collect()  # 64 rows at most
    left, k = sum(r["count"] for r in bins), 0
    while left > most:
        left -= sum(r["count"] for r in bins if r["k"] == k)
        k += 1
    return 1 << k


def align_texts(docs: DataFrame, spec: str, model: bytes, id_col: str = "doc_id", text_col: str = "text", max_pairs: int = MAX_PAIRS, step: int = SLICE) -> DataFrame:
    """One row per row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    ``spec`` and ``model`` are the contents of the tokenizers' files. Null and empty texts, and texts that either side doesn't give back byte by byte, have no tokens:
    zeros and an empty string; they count for no pair. Equal rows each count. Ids may be null or repeated; other columns are not read. Long texts are aligned
    in parts; a text of many megabytes without a letter before a blank is one part."""
    n_b = len(Pieces(model).lens)
    parts = durable(align_parts(docs, spec, model, id_col, text_col, step))
    pairs = pair_counts(parts, n_b)
    least = _frequent(pairs, max_pairs)
    table = pairs.where(F.col("n") >= least).toArrow()
    order = np.argsort(keys := table["pair"].to_numpy().astype(np.uint32))
    sent = docs.sparkSession.sparkContext.broadcast((keys[order], table["n"].to_numpy()[order], table["best"].to_numpy(zero_copy_only=False)[order]))

    def found(links):
        """(distinct pairs of a part, how often each, place among the frequent pairs, whether it is one)"""
        own, n = np.unique(np.frombuffer(links.as_buffer() or b"", dtype="<u4"), return_counts=True)
        keys = sent.value[0]
        at = np.searchsorted(keys, own)
        if not len(keys):
            return own, n, at, np.zeros(len(own), bool)
        at = np.minimum(at, len(keys) - 1)
        return own, n, at, keys[at] == own

    def score(batches):
        for batch in batches:
            sums, best = [], []
            for links in batch.column(batch.schema.get_field_index("links")):
                _, n, at, known = found(links)
                sums.append(int((n * sent.value[1][at])[known].sum()) if known.any() else 0)
                best.append(int((n * sent.value[2][at])[known].sum()) if known.any() else 0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(best, pa.int64()), pa.array(sums, pa.int64())], names=[*batch.schema.names[:-1], "n_best", "count_sum"])

    def unknown(batches):
        for batch in batches:
            for row, links in zip(batch.column(0).to_pylist(), batch.column(1)):
                own, n, _, known = found(links)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(int((~known).sum()), row, np.int64)), pa.array(own[~known].astype(np.int64)), pa.array(n[~known])], names=["row", "pair", "k"])

    made = parts.mapInArrow(score, _PART_DDL.replace("links binary", "n_best long, count_sum long"))
    if least > 1:
        rare = parts.select("row", "links").mapInArrow(unknown, "row long, pair long, k long").join(pairs.where(F.col("n") < least).hint("merge"), "pair")
        more = rare.groupBy("row").agg(F.sum(F.col("k") * F.col("best").cast("long")).alias("more_best"), F.sum(F.col("k") * F.col("n")).alias("more_sum"))
        # a part of its own, so that a text of many parts gets it once
        made = made.unionByName(more.select("row", F.lit(None).cast("long").alias("doc_id"), F.lit(False).alias("single"), *(F.lit(0).cast("long").alias(c) for c in ("n_a", "n_b", "n_groups", "n_links")), F.lit(None).cast("string").alias("groups_sha256"), F.col("more_best").alias("n_best"), F.col("more_sum").alias("count_sum"))).withColumn("single", F.lit(False))
    made = durable(made)
    sent.destroy()  # no task needs it again
    numbers = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    whole = made.where("single").select("doc_id", *numbers, "groups_sha256")
    joined = made.where("not single").groupBy("row").agg(F.max("doc_id").alias("doc_id"), *(F.sum(c).alias(c) for c in numbers), F.max("groups_sha256").alias("groups_sha256"))
    return whole.unionByName(joined.drop("row"))


def read_model(path: str) -> bytes:
    """The model file, read once on the driver and sent to the tasks with the code (less than a megabyte, whatever the corpus)."""
    with open(path, "rb") as f:
        return f.read()


__all__ = ["Aligner", "Pieces", "align_parts", "align_texts", "pair_counts", "parts_of", "read_model", "read_spec", "shared_cuts"]
