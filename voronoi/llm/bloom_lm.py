"""Language-model scoring with a log-frequency Bloom filter.

The counts of words and word pairs in the training documents are quantised to levels: level i stands for a count of LEVELS[i] or more. An
n-gram of level q is entered in a Bloom filter q times, together with the numbers 1 to q; its level is read back by probing 1, 2, ... until
one is absent. The filter consists of shards by the n-gram's hash, each built by one task, and is broadcast.

A word's probability after another interpolates the pair's relative frequency with the smoothed frequency of the word. The weight of
the pairs is the Good-Turing estimate of the share of pairs that were seen before, 1 - (pairs seen once) / (all pairs).

The filter is bounded. Where it can't hold all levels, n-grams of the lowest counts are left out of it; a token of which the filter lacks
a word or the pair is scored after a join with the written counts, to the same level, so that scores don't depend on the bound (but for
the filter's false positives).

The exact base score needs every word's exact count. The most frequent words' counts (a bounded table) are broadcast; the other words of a
document are joined with the table of all counts.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable, shuffle_partitions, trimmed
from .textvec import lower, mix, row_slices, utf8, word_hashes, word_spans

U = np.uint64
#: Stand for the end of a text and what stands before its first word.
END, START = U(0x9D39247E33776D41), U(0x2AF7398005AAA5C7)
#: Least counts of the levels.
STEP = 1.3
#: Probes for each entry, and bits: 1.6 % of absent entries are found.
PROBES, ENTRY_BITS = 6, 8.7
#: Bound of the filter; pairs and words of low counts are looked up in the written counts as far as it would grow beyond.
MAX_BYTES = 256 << 20
#: Words whose exact counts are broadcast.
TOP_WORDS = 1 << 19
#: N-grams whose levels a task keeps (a power of 2), and n-grams probed together.
KNOWN, PROBED = 1 << 20, 1 << 16
#: Tokens that a task counts before it sends the counts on, and distinct n-grams of a bucket on the average.
FLUSH, BUCKET = 1_500_000, 750_000


def level_counts(most: int) -> np.ndarray:
    out = [1]
    while out[-1] < most:
        out.append(max(out[-1] + 1, math.ceil(out[-1] * STEP)))
    return np.array(out, dtype=np.int64)


LEVELS = level_counts(1 << 50)


def level_bounds() -> tuple[np.ndarray, np.ndarray]:
    """(least count, greatest count) of each level from 0."""
    return np.concatenate(([0], LEVELS)), np.concatenate(([0], LEVELS[1:] - 1, LEVELS[-1:]))


def tokens(column: pa.Array):
    """(rows i to j of the column, hashes of their words and ends, index of each row's first token) for some rows at a time."""
    data, offsets = utf8(column)
    for i, j in row_slices(offsets, 1 << 20):
        part, own = lower(data[offsets[i]:offsets[j]]), offsets[i:j + 1] - offsets[i]
        starts, ends, firsts = word_spans(part, own)
        yield i, j, np.insert(word_hashes(part, starts, ends), firsts[1:], END), firsts + np.arange(len(firsts))


def pair_hashes(words: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of the word before each token, hash of the pair)."""
    before = np.empty_like(words)
    before[1:] = words[:-1]
    before[firsts[:-1]] = START
    return before, mix(before * U(0xD6E8FEB86659FD93) + words)


def _merged(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(keys) else counts


def _bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(keys ^ U(0x5851F42D4C957F2D)) % U(buckets)).astype(np.int64)


def _count(buckets: int):
    """Blocks of counts: (bucket, order 1 or 2, sorted keys, counts)."""
    names = ["bucket", "n", "keys", "counts"]

    def blocks(order: int, parts: list):
        keys, counts = _merged(np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts]))
        bucket = _bucket_of(keys, buckets)
        at = np.argsort(bucket, kind="stable")
        keys, counts, bucket = keys[at], counts[at].astype(np.int32), bucket[at]
        which = np.unique(bucket)
        ends = np.searchsorted(bucket, which, "right")
        rows = [(int(b), order, keys[i:j].tobytes(), counts[i:j].tobytes()) for b, i, j in zip(which, np.concatenate(([0], ends[:-1])), ends)]
        for k in range(0, len(rows), 256):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[k:k + 256]), (pa.int32(), pa.int32(), pa.binary(), pa.binary()))], names=names)

    def run(batches):
        held, parts = 0, {1: [], 2: []}
        for batch in batches:
            for _, _, words, firsts in tokens(batch.column(0)):
                _, pairs = pair_hashes(words, firsts)
                for order, keys in ((1, words), (2, pairs)):
                    parts[order].append(np.unique(keys, return_counts=True))
                held += len(words)
                if held >= FLUSH:
                    for order in (1, 2):
                        yield from blocks(order, parts[order])
                    held, parts = 0, {1: [], 2: []}
        if held:
            for order in (1, 2):
                yield from blocks(order, parts[order])

    return run


def _merge_bucket(table: pa.Table) -> pa.Table:
    """One bucket's exact counts of words and pairs, with what is known of all of them."""
    order = table.column("n").to_numpy()
    keys, counts = table.column("keys").to_pylist(), table.column("counts").to_pylist()

    def of(n: int):
        at = np.flatnonzero(order == n)
        k = np.frombuffer(b"".join(keys[i] for i in at), dtype=np.uint64)
        return _merged(k, np.frombuffer(b"".join(counts[i] for i in at), dtype=np.int32).astype(np.int64))

    (words, n_words), (pairs, n_pairs) = of(1), of(2)
    by_level = lambda n: np.bincount(np.searchsorted(LEVELS, n, "right"), minlength=len(LEVELS) + 1).tolist()
    return pa.table(
        {
            "bucket": pa.array([table.column("bucket")[0].as_py()], pa.int32()), "words": pa.array([words.tobytes()], pa.binary()), "word_counts": pa.array([n_words.tobytes()], pa.binary()),
            "pairs": pa.array([pairs.tobytes()], pa.binary()), "pair_counts": pa.array([n_pairs.tobytes()], pa.binary()),
            "n_tokens": pa.array([int(n_words.sum())], pa.int64()), "n_words": pa.array([len(words)], pa.int64()), "once": pa.array([int((n_pairs == 1).sum())], pa.int64()),
            "word_levels": pa.array([by_level(n_words)], pa.list_(pa.int64())), "pair_levels": pa.array([by_level(n_pairs)], pa.list_(pa.int64())),
        }
    )


_MERGED = "bucket int, words binary, word_counts binary, pairs binary, pair_counts binary, n_tokens long, n_words long, once long, word_levels array<long>, pair_levels array<long>"


def probe_hashes(keys: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """What the places of (key, level) are made of: a hash and the step from one place to the next."""
    h = mix(keys + U(level * 0x9E3779B97F4A7C15 % (1 << 64)))
    return h, mix(h ^ U(0xA24BAED4963EE407)) | U(1)


def probe(h: np.ndarray, step: np.ndarray, i: int, bits: np.ndarray | np.uint64) -> np.ndarray:
    """The i-th place of the keys with these ``probe_hashes`` in a shard of so many bits."""
    return (((h + U(i) * step) >> U(32)) * bits) >> U(32)


def _shard(least: int):
    """A bucket's shard: words and pairs of ``least`` or more."""

    def run(batches):
        for batch in batches:
            for bucket, *cols in zip(*[batch.column(c).to_pylist() for c in ("bucket", "words", "word_counts", "pairs", "pair_counts")]):
                w, nw, p, np_ = (np.frombuffer(c, dtype=d) for c, d in zip(cols, (np.uint64, np.int64, np.uint64, np.int64)))
                keys, counts = np.concatenate((w, p)), np.concatenate((nw, np_))
                keys, counts = keys[counts >= least], counts[counts >= least]
                level = np.searchsorted(LEVELS, counts, "right")
                bits = max(64, 64 * math.ceil(int(level.sum()) * ENTRY_BITS / 64))
                made = np.zeros(bits // 8, dtype=np.uint8)
                for q in range(1, int(level.max(initial=0)) + 1):
                    own = probe_hashes(keys[level >= q], q)
                    for i in range(PROBES):
                        at = probe(*own, i, U(bits))
                        np.bitwise_or.at(made, (at >> U(3)).astype(np.int64), U(1).astype(np.uint8) << (at & U(7)).astype(np.uint8))
                yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([made.tobytes()], pa.binary())], names=["bucket", "bits"])

    return run


class Filter:
    """The shards of a log-frequency Bloom filter. The levels of frequent n-grams, which take the most probes, are kept once they are found."""

    def __init__(self, bits: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
        self.bits, self.starts, self.sizes = bits, starts, sizes  # sizes in bits, starts in bytes
        self.known, self.known_level = np.zeros(KNOWN, dtype=np.uint64), np.zeros(KNOWN, dtype=np.uint8)  # level 0: nothing is kept here

    def level(self, keys: np.ndarray) -> np.ndarray:
        """The level of each key, 0 if it is absent."""
        out = np.zeros(len(keys), dtype=np.int64)
        for i in range(0, len(keys), PROBED):
            part = keys[i:i + PROBED]
            place = (part & U(KNOWN - 1)).astype(np.int64)
            level = np.where(self.known[place] == part, self.known_level[place], 0)
            new = np.flatnonzero(level == 0)
            level[new] = self._probed(part[new])
            # of two n-grams with one place the more frequent one stays
            new = new[level[new] > self.known_level[place[new]]]
            self.known[place[new]] = part[new]
            new = new[self.known[place[new]] == part[new]]
            self.known_level[place[new]] = level[new]
            out[i:i + PROBED] = level
        return out

    def _probed(self, keys: np.ndarray) -> np.ndarray:
        """The level of each key by repeated probes, for ever fewer keys."""
        out = np.zeros(len(keys), dtype=np.uint8)
        bucket = _bucket_of(keys, len(self.sizes))
        start, size = self.starts[bucket], self.sizes[bucket].astype(np.uint64)
        left = np.arange(len(keys))
        for q in range(1, len(LEVELS) + 1):
            h, step = probe_hashes(keys, q)
            for i in range(PROBES):
                at = probe(h, step, i, size)
                hit = np.flatnonzero((self.bits[start + (at >> U(3)).astype(np.int64)] >> (at & U(7)).astype(np.uint8)) & 1)
                if len(hit) < len(left):
                    keys, left, start, size, h, step = (x[hit] for x in (keys, left, start, size, h, step))
            if not len(left):
                break
            out[left] = q
        return out


class BloomLm:
    """A trained model: what a task needs to score texts is in ``shared`` (arrays, broadcast)."""

    def __init__(self, train: DataFrame, text_col: str, max_bytes: int = MAX_BYTES, top_words: int = TOP_WORDS):
        spark = train.sparkSession
        sizes = train.select(F.coalesce(F.octet_length(text_col), F.lit(0)).alias("b")).agg(F.sum("b"), F.count("*")).first()
        self.n_docs = sizes[1]
        buckets = max(shuffle_partitions(spark), math.ceil((sizes[0] or 0) / 6 / BUCKET))
        counted = train.select(text_col).mapInArrow(trimmed(_count(buckets)), "bucket int, n int, keys binary, counts binary")
        self.table = durable(counted.groupBy("bucket").applyInArrow(trimmed(_merge_bucket), _MERGED))
        totals = self.table.agg(F.sum("n_tokens"), F.sum("n_words"), F.sum("once")).first()
        self.n_tokens, self.n_words, once = (int(x or 0) for x in totals)
        self.pair_weight = 1 - once / self.n_tokens if self.n_tokens else 0.0
        self.below = float(self.n_tokens + 0.5 * (self.n_words + 1))
        # how many n-grams there are of each level: the filter's size and the table of frequent words for any least count
        levels = self.table.select(F.posexplode(F.arrays_zip("word_levels", "pair_levels")).alias("level", "n")).groupBy("level").agg(F.sum("n.word_levels"), F.sum("n.pair_levels")).collect()
        words, pairs = np.zeros(len(LEVELS) + 1, dtype=np.int64), np.zeros(len(LEVELS) + 1, dtype=np.int64)
        for level, w, p in levels:  # a few hundred rows
            words[level], pairs[level] = w, p
        above = lambda n: np.cumsum(n[::-1])[::-1]
        least = lambda fits: int(LEVELS[max(0, int(np.argmax(fits)) - 1)]) if fits.any() else int(LEVELS[-1])
        self.least = least(above((words + pairs) * np.arange(len(words))) * ENTRY_BITS / 8 <= max_bytes)
        self.top_least = least(above(words) <= top_words)
        self.shared = spark.sparkContext.broadcast(self._arrays(buckets))

    def _arrays(self, buckets: int) -> dict:
        shards = [b""] * buckets
        for r in self.table.mapInArrow(trimmed(_shard(self.least)), "bucket int, bits binary").toLocalIterator():  # max_bytes together
            shards[r.bucket] = bytes(r.bits)
        shards = [s or bytes(8) for s in shards]
        sizes = np.array([len(s) for s in shards], dtype=np.int64)
        top = self.words().where(F.col("count") >= self.top_least).toArrow()  # top_words rows at most
        key, count = top["word"].to_numpy().astype(np.int64).astype(np.uint64), top["count"].to_numpy()
        order = np.argsort(key)
        return {
            "bits": np.frombuffer(b"".join(shards), dtype=np.uint8), "starts": np.cumsum(sizes) - sizes, "sizes": sizes * 8,
            "top": key[order], "top_counts": count[order].astype(np.int64),
        }

    def release(self) -> None:
        """Frees what the tasks hold, once what ``score`` gives is written."""
        self.shared.destroy()

    def words(self) -> DataFrame:
        """(word hash, exact count) of all training words."""

        def run(batches):
            for batch in batches:
                for w, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    keys, counts = np.frombuffer(w, dtype=np.int64), np.frombuffer(n, dtype=np.int64)
                    for i in range(0, len(keys), 100_000):
                        yield pa.RecordBatch.from_arrays([pa.array(keys[i:i + 100_000]), pa.array(counts[i:i + 100_000])], names=["word", "count"])

        return self.table.select("words", "word_counts").mapInArrow(trimmed(run), "word long, count long")

    def below_filter(self) -> DataFrame:
        """(order 1 or 2, hash, level) of the training words and pairs that the filter doesn't hold."""
        least = self.least

        def run(batches):
            for batch in batches:
                for order, keys, counts in ((1, 0, 1), (2, 2, 3)):
                    for k, n in zip(batch.column(keys).to_pylist(), batch.column(counts).to_pylist()):
                        n = np.frombuffer(n, dtype=np.int64)
                        k, n = np.frombuffer(k, dtype=np.int64)[n < least], n[n < least]
                        level = np.searchsorted(LEVELS, n, "right").astype(np.int32)
                        for i in range(0, len(k), 100_000):
                            part = k[i:i + 100_000]
                            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), order, np.int32)), pa.array(part), pa.array(level[i:i + 100_000])], names=["order", "key", "found"])

        return self.table.select("words", "word_counts", "pairs", "pair_counts").mapInArrow(trimmed(run), "order int, key long, found int")

    def rest(self, scored: DataFrame, rid: str, open_col: str = "_open") -> DataFrame:
        """(rid, rest): the score of the tokens that ``score`` left open, by a join of their words and pairs with the counts below the filter."""
        t = scored.where(F.size(open_col) > 0).select(rid, F.posexplode(open_col).alias("at", "t")).select(rid, "at", "t.*")
        # what is to be looked up: the pair, the word and the word before it, each only if the filter and the frequent words lack it
        asked = F.filter(
            F.array(*[F.struct(F.lit(part).alias("part"), F.lit(order).alias("order"), F.col(key).alias("key"), F.col(level).alias("known")) for part, order, key, level in ((0, 2, "pair", "pair_level"), (1, 1, "word", "word_level"), (2, 1, "before", "before_level"))]),
            lambda x: (x.part == 0) | (x.known == -1),
        )
        asked = t.select(rid, "at", "tf", "pair_level", "word_level", "before_level", F.explode(asked).alias("q")).select(rid, "at", "tf", "pair_level", "word_level", "before_level", "q.part", "q.order", "q.key")
        found = asked.join(self.below_filter(), ["order", "key"], "left").withColumn("found", F.coalesce("found", F.lit(0)))
        of = lambda part, name: F.when(F.max(name) >= 0, F.max(name)).otherwise(F.coalesce(F.max(F.when(F.col("part") == part, F.col("found"))), F.lit(0))).alias(name)
        one = found.groupBy(rid, "at").agg(F.max("tf").alias("tf"), of(0, "pair_level"), of(1, "word_level"), F.max("before_level").alias("before_known"), F.max(F.when(F.col("part") == 2, F.col("found"))).alias("before_found"))
        low, high = (F.array(*[F.lit(float(x)) for x in of_level]) for of_level in level_bounds())
        at = lambda table, level: F.element_at(table, level + 1)
        before = F.when(F.col("before_known") >= 0, F.col("before_known")).otherwise(F.coalesce("before_found", F.lit(0)))
        after = F.when(F.col("before_known") == -2, F.lit(float(max(1, self.n_docs)))).otherwise(F.greatest(at(high, before), F.lit(1.0)))
        alone = (at(low, F.col("word_level")) + 0.5) / self.below
        pair = F.least(at(low, F.col("pair_level")) / after, F.lit(1.0))
        return one.select(rid, (F.col("tf") * F.log10((1 - self.pair_weight) * alone + self.pair_weight * pair)).alias("s")).groupBy(rid).agg(F.sum("s").alias("rest"))

    def score(self, docs: DataFrame, text_col: str, out_names: tuple[str, ...] = ("_n", "_known", "_base", "_score", "_rare", "_open")) -> DataFrame:
        """``docs`` (whose other columns must be few and small) with the number of tokens; of the words whose counts are broadcast the
        known tokens and their base score; the model's score of the tokens whose words and pair the filter holds; the other words' hashes;
        and the tokens that are still to be scored by ``rest``: none if the filter holds all n-grams. Their levels are -1 where they are
        to be looked up, that of the word before the first one is -2."""
        from pyspark.sql import types as T

        shared, below, n_docs, weight, least = self.shared, self.below, self.n_docs, self.pair_weight, self.least
        at, keep = docs.columns.index(text_col), [c for c in docs.columns if c != text_col]
        whole = least <= 1
        open_kind = pa.struct([("pair", pa.int64()), ("word", pa.int64()), ("before", pa.int64()), ("pair_level", pa.int32()), ("word_level", pa.int32()), ("before_level", pa.int32()), ("tf", pa.int64())])

        def open_tokens(row, n, is_open, pairs, words, before, *levels):
            """Lists of n rows: each distinct open pair of a row once, with its number."""
            at = np.flatnonzero(is_open)
            at = at[np.lexsort((pairs[at], row[at]))]
            first = np.flatnonzero(np.concatenate(([True], (pairs[at][1:] != pairs[at][:-1]) | (row[at][1:] != row[at][:-1])))) if len(at) else np.zeros(0, np.int64)
            tf, at = np.diff(np.append(first, len(at))), at[first]
            fields = [pa.array(x[at].astype(np.int64)) for x in (pairs, words, before)] + [pa.array(x[at].astype(np.int32)) for x in levels] + [pa.array(tf.astype(np.int64))]
            ends = np.concatenate(([0], np.cumsum(np.bincount(row[at], minlength=n)))).astype(np.int32)
            return pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays(fields, fields=list(open_kind)))

        def run(batches):
            s = shared.value
            lm, top, top_counts = Filter(s["bits"], s["starts"], s["sizes"]), s["top"], s["top_counts"]
            low, high = level_bounds()
            for batch in batches:
                cols: tuple[list, ...] = ([], [], [], [], [], [])
                for i, j, words, firsts in tokens(batch.column(at)):
                    row = np.repeat(np.arange(j - i), np.diff(firsts))
                    each, back = np.unique(words, return_inverse=True)
                    place = np.minimum(np.searchsorted(top, each), max(0, len(top) - 1))
                    is_top = top[place] == each if len(top) else np.zeros(len(each), dtype=bool)
                    exact = np.log10((np.where(is_top, top_counts[place] if len(top) else 0, 0) + 0.5) / below)
                    level = lm.level(each)
                    if len(top) and not whole:
                        level = np.where(is_top & (level == 0), np.searchsorted(LEVELS, top_counts[place], "right"), level)
                    before, pairs = pair_hashes(words, firsts)
                    alone = (low[level][back] + 0.5) / below
                    # relative frequency of the pair: least count of its level over the greatest of its first word's
                    first_level = np.zeros(len(words), dtype=np.int64)
                    first_level[1:] = level[back][:-1]
                    after = np.maximum(high[first_level], 1).astype(float)
                    after[firsts[:-1]] = max(1, n_docs)
                    # a pair is in the filter only if its words are
                    maybe = np.flatnonzero((level[back] > 0) & ((first_level > 0) | (before == START)))
                    pair_level = np.zeros(len(words), dtype=np.int64)
                    pair_level[maybe] = lm.level(pairs[maybe])
                    pair = np.minimum(low[pair_level] / after, 1.0)
                    score = np.log10((1 - weight) * alone + weight * pair)
                    known = is_top[back]
                    n = j - i
                    # with n-grams below the filter, level 0 means that the count is still to be looked up
                    asked = [np.where((x == 0) & (not whole), -1, x) for x in (pair_level, level[back], first_level)]
                    asked[2][firsts[:-1]] = -2
                    is_open = (asked[0] == -1) | (asked[1] == -1) | (asked[2] == -1)
                    score[is_open] = 0
                    cols[5].append(open_tokens(row, n, is_open, pairs, words, before, *asked))
                    cols[0].append(np.diff(firsts))
                    cols[1].append(np.bincount(row[known], minlength=n))
                    cols[2].append(np.bincount(row[known], weights=exact[back][known], minlength=n))
                    cols[3].append(np.bincount(row, weights=score, minlength=n))
                    rare = words[~known].astype(np.int64)
                    cols[4].append(pa.ListArray.from_arrays(np.concatenate(([0], np.cumsum(np.bincount(row[~known], minlength=n)))).astype(np.int32), pa.array(rare)))
                made = [pa.array(np.concatenate(c).astype(t)) if c else pa.array([], pa.from_numpy_dtype(t)) for c, t in zip(cols[:4], (np.int64, np.int64, float, float))]
                made.append(pa.concat_arrays(cols[4]) if cols[4] else pa.array([], pa.list_(pa.int64())))
                made.append(pa.concat_arrays(cols[5]) if cols[5] else pa.array([], pa.list_(open_kind)))
                yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + made, names=[*keep, *out_names])

        fields = [f for f in docs.schema.fields if f.name != text_col]
        open_tokens_type = T.StructType([T.StructField(f.name, T.LongType() if f.type == pa.int64() else T.IntegerType()) for f in open_kind])
        kinds = (T.LongType(), T.LongType(), T.DoubleType(), T.DoubleType(), T.ArrayType(T.LongType()), T.ArrayType(open_tokens_type))
        return docs.mapInArrow(trimmed(run), T.StructType([*fields, *[T.StructField(n, k) for n, k in zip(out_names, kinds)]]))


def fold(id_col: Column, folds: int = 5) -> Column:
    """crc32 of the id as text, mod ``folds``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 5, held: int = 1, **how) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (both log10).

    The model and the exact counts come from the rows whose fold isn't ``held``. A null text is empty: one end token. Without training rows
    the base is that of an unseen token. Rows that repeat an id are scored one by one; an empty table gives no rows."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), (fold(F.col(id_col), folds) == held).alias("held_out"))
    lm = BloomLm(rows.where("not held_out").select("text"), "text", **how)
    scored = durable(lm.score(rows, "text").withColumn("rid", F.monotonically_increasing_id()))
    lm.release()
    rare = scored.where("size(_rare) > 0").select("rid", F.explode("_rare").alias("word")).groupBy("rid", "word").agg(F.count("*").alias("tf"))
    counts = lm.words()
    joined = rare.join(counts, "word", "left").withColumn("c", F.coalesce("count", F.lit(0)))
    rest = joined.groupBy("rid").agg(F.sum(F.col("tf") * F.log10((F.col("c") + 0.5) / lm.below)).alias("base"), F.sum(F.when(F.col("c") > 0, F.col("tf")).otherwise(0)).alias("known"))
    out = scored.drop("_rare", "_open").join(rest, "rid", "left")
    if lm.least > 1:
        out = out.join(lm.rest(scored, "rid"), "rid", "left").withColumn("_score", F.col("_score") + F.coalesce("rest", F.lit(0.0)))
    return out.select(
        "doc_id", "held_out", F.col("_n").alias("n_tokens"), (F.col("_known") + F.coalesce("known", F.lit(0))).alias("n_known"), F.lit(lm.n_tokens).cast("long").alias("train_tokens"),
        (F.col("_base") + F.coalesce("base", F.lit(0.0))).alias("base_score"), F.col("_score").alias("score"),
    )
