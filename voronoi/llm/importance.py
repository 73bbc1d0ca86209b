"""Quality classifier by importance resampling.

Two generative models of hashed n-grams are counted: one of the raw text, over all documents, one of the target text, over the
documents of a bounded labelled sample that are labelled good. A document's log importance is the sum over its n-grams of the log
ratio of the two models. Documents are sampled without replacement in proportion to a power of that importance, by Gumbel top-k: the
k documents with the largest ``sharpness * log importance + Gumbel noise``. k is the number of documents whose log importance
is on the good side of the cut that best parts the labelled sample.

The n-grams are words, and runs of one to three word shapes: case, digits, signs, the sign at the end, whether the word repeats.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import durable, trimmed
from .textvec import lower, mix, row_slices, utf8, word_hashes, word_spans

U = np.uint64
#: Hash buckets of words and of runs of shapes.
WORD_BUCKETS, SHAPE_BUCKETS = 1 << 14, 1 << 14
BUCKETS = WORD_BUCKETS + SHAPE_BUCKETS
#: Labelled rows used at most, taken in the order of a hash of the id.
SAMPLE = 20_000
#: Power of the importance in the sampling weights.
SHARPNESS = 8.0
SMOOTHING = 1.0
#: Weight of a good document lost against a bad one kept, when the cut is chosen.
LOSS = 2.0

_B = np.arange(256)
_UPPER = (_B >= 65) & (_B <= 90)
_LETTER = _UPPER | (_B >= 97) & (_B <= 122) | (_B >= 128)
_DIGIT = (_B >= 48) & (_B <= 57)


def _among(mask: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    upto = np.concatenate(([0], np.cumsum(mask[data], dtype=np.int32)))
    return upto[ends] - upto[starts]


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each n-gram, its row) of rows of bytes."""
    starts, ends, firsts = word_spans(data, offsets)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
    word = word_hashes(lower(data), starts, ends)
    n = ends - starts
    upper, letters, digits = (_among(m, data, starts, ends) for m in (_UPPER, _LETTER, _DIGIT))
    last = data[ends - 1].astype(np.uint64)
    same = np.zeros(len(word), dtype=bool)
    same[1:] = (word[1:] == word[:-1]) & (row[1:] == row[:-1])
    case = np.where(upper == 0, 0, np.where((upper > 1) & (upper == letters), 2, np.where((upper == 1) & _UPPER[data[starts]], 1, 3)))
    signs = np.minimum(n - letters - digits, 3)
    shape = np.where(_LETTER[data[ends - 1]] | _DIGIT[data[ends - 1]], U(0), last)
    for part, size in ((case, 4), (np.minimum(digits, 1), 2), (signs, 4), (np.minimum(letters, 1), 2), (same, 2)):
        shape = shape * U(size) + part.astype(np.uint64)
    buckets, rows = [(mix(word) % U(WORD_BUCKETS)).astype(np.int64)], [row]
    run = np.zeros(len(shape), dtype=np.uint64)
    for k in range(3):
        m = len(shape) - k
        if m <= 0:
            break
        run = mix(run[:m] * U(0x9E3779B97F4A7C15) + shape[k:] + U(k + 1))
        whole = row[:m] == row[k:]
        buckets.append(WORD_BUCKETS + (run[whole] % U(SHAPE_BUCKETS)).astype(np.int64))
        rows.append(row[:m][whole])
    return np.concatenate(buckets), np.concatenate(rows)


def _parts(column: pa.Array):
    """(first row, offsets from 0, bytes) of some rows at a time."""
    data, offsets = utf8(column)
    for i, j in row_slices(offsets, 1 << 20):
        yield i, j, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]


def _count(batches):
    """Counts of a task's n-grams: in all its texts, and in those labelled good."""
    raw, target = np.zeros(BUCKETS, dtype=np.int64), np.zeros(BUCKETS, dtype=np.int64)
    for batch in batches:
        good = np.asarray(batch.column(1).fill_null(False).to_numpy(zero_copy_only=False), dtype=bool)
        for i, j, data, offsets in _parts(batch.column(0)):
            bucket, row = grams(data, offsets)
            raw += np.bincount(bucket, minlength=BUCKETS)
            target += np.bincount(bucket[good[i:j][row]], minlength=BUCKETS)
    some = np.flatnonzero(raw)
    for k in range(0, len(some), 8192):
        s = some[k:k + 8192]
        yield pa.RecordBatch.from_arrays([pa.array(s.astype(np.int32)), pa.array(raw[s]), pa.array(target[s])], names=["bucket", "raw", "target"])


def labelled_sample(labels: DataFrame, id_col: str = "doc_id", quality_col: str = "quality", limit: int = SAMPLE) -> DataFrame:
    """(label_id, good) of at most ``limit`` labelled rows; an id with both labels counts as good if any label is."""
    per = labels.where(F.col(id_col).isNotNull() & F.col(quality_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("label_id")).agg(F.max(F.col(quality_col).cast("int") == 1).alias("good"))
    return per.orderBy(F.xxhash64("label_id"), "label_id").limit(limit)


class Model:
    """Log ratio of target to raw for each bucket; the cut between the labelled good and bad; both kept on the driver (some 100 KB)."""

    def __init__(self, ratios: np.ndarray):
        self.ratios = ratios

    @classmethod
    def fit(cls, docs: DataFrame, sample: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model | None:
        """None if no document is labelled good."""
        rows = docs.select(F.col(id_col).cast("long").alias("label_id"), F.col(text_col).alias("text")).join(F.broadcast(sample), "label_id", "left")
        counts = rows.select("text", "good").mapInArrow(trimmed(_count), "bucket int, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
        raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
        for r in counts.collect():  # BUCKETS rows at most
            raw[r.bucket], target[r.bucket] = r.raw, r.target
        if not target.any():
            return None
        out = np.zeros(BUCKETS)
        for part in (slice(0, WORD_BUCKETS), slice(WORD_BUCKETS, BUCKETS)):
            p = (target[part] + SMOOTHING) / (target[part].sum() + SMOOTHING * len(target[part]))
            q = (raw[part] + SMOOTHING) / (raw[part].sum() + SMOOTHING * len(raw[part]))
            out[part] = np.log(p / q)
        return cls(out)

    def score(self, docs: DataFrame, text_col: str, out_col: str) -> DataFrame:
        """``docs`` with the log importance of each text as a further column; a text without words has 0."""
        ratios, at, names = self.ratios, docs.columns.index(text_col), [*docs.columns, out_col]

        def run(batches):
            for batch in batches:
                out = np.zeros(batch.num_rows)
                for i, j, data, offsets in _parts(batch.column(at)):
                    bucket, row = grams(data, offsets)
                    out[i:j] = np.bincount(row, weights=ratios[bucket], minlength=j - i)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], names=names)

        return docs.mapInArrow(trimmed(run), T.StructType([*docs.schema.fields, T.StructField(out_col, T.DoubleType())]))


def gumbel(id_col: Column, text: Column) -> Column:
    """Gumbel noise from a hash of the id, or of the text where the id is null."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit("gumbel"), F.coalesce(id_col.cast("long"), F.xxhash64(F.coalesce(text, F.lit(""))))), 11)
    return -F.log(-F.log((bits.cast("double") + 0.5) / float(1 << 53)))


def best_cut(scores: list[tuple[float, bool]], loss: float = LOSS) -> float:
    """The score from which a document counts as good, with the least share of errors on labelled scores; midway between two."""
    if not scores:
        return -np.inf
    s = np.array(sorted(scores))
    good = s[:, 1] > 0
    if good.all() or not good.any():
        return -np.inf
    lost = np.concatenate(([0], np.cumsum(good))) / good.sum()  # cut before the i-th score
    kept = (np.sum(~good) - np.concatenate(([0], np.cumsum(~good)))) / np.sum(~good)
    i = int(np.argmin(loss * lost + kept))
    if i == 0:
        return -np.inf
    return float(s[i - 1, 0] + s[i, 0]) / 2 if i < len(s) else float(s[-1, 0]) + 1


def kth_largest(df: DataFrame, col: str, k: int, bins: int = 1000) -> float:
    """The k-th largest value, by histograms over ever smaller ranges; at most ``bins`` values reach the driver."""
    lo, hi = df.agg(F.min(col), F.max(col)).first()
    above = 0  # values beyond hi
    while True:
        inside = df.where((F.col(col) >= lo) & (F.col(col) <= hi))
        step = (hi - lo) / bins
        if step <= 0 or lo + step == lo:
            return lo
        at = F.least(F.floor((F.col(col) - lo) / step), F.lit(bins - 1))
        counts = {r[0]: (r[1], r[2], r[3]) for r in inside.groupBy(at.alias("b")).agg(F.count("*"), F.min(col), F.max(col)).collect()}
        for b in sorted(counts, reverse=True):
            n, low, high = counts[b]
            if above + n >= k:
                break
            above += n
        if n <= bins:
            rows = sorted((r[0] for r in df.where((F.col(col) >= low) & (F.col(col) <= high)).select(col).collect()), reverse=True)
            return rows[k - above - 1]
        if low == high:
            return low
        lo, hi = low, high


class Resampled:
    """The outcome of fitting: ``scored`` (doc_id, log_importance, key, label) and the least key that is taken."""

    def __init__(self, docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sharpness: float = SHARPNESS, sample: int = SAMPLE, k: int | None = None):
        self.id_col, self.text_col, self.sharpness = id_col, text_col, sharpness
        some = durable(labelled_sample(labels, limit=sample))
        self.model = Model.fit(docs, some, id_col, text_col)
        self.least = -np.inf
        if self.model is None:
            return
        ids = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
        self.scored = durable(self._key(ids, "doc_id", "text").drop("text").join(F.broadcast(some.withColumnRenamed("label_id", "doc_id")), "doc_id", "left"))
        labelled = self.scored.where("good is not null").groupBy("doc_id", "good").agg(F.max("log_importance").alias("s"))
        self.cut = best_cut([(r.s, bool(r.good)) for r in labelled.collect()])  # as many rows as the sample
        total, over = self.scored.agg(F.count("*"), F.sum((F.col("log_importance") >= F.lit(float(self.cut))).cast("long"))).first()
        k = (over or 0) if k is None else k
        if 0 < k < total:
            self.least = kth_largest(self.scored, "key", k)
        elif k <= 0:
            self.least = np.inf

    def _key(self, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
        scored = self.model.score(docs, text_col, "log_importance")
        return scored.withColumn("key", F.col("log_importance") * self.sharpness + gumbel(F.col(id_col), F.col(text_col)))

    def decisions(self, docs: DataFrame) -> DataFrame:
        """One row per row: doc_id, log_importance, key, kept."""
        if self.model is None:
            return docs.select(F.col(self.id_col).cast("long").alias("doc_id"), F.lit(0.0).alias("log_importance"), F.lit(0.0).alias("key"), F.lit(True).alias("kept"))
        return self.scored.select("doc_id", "log_importance", "key", (F.col("key") >= F.lit(float(self.least))).alias("kept"))

    def taken(self, docs: DataFrame) -> DataFrame:
        """The rows of ``docs`` that are taken, with all their columns; decided row by row, without a join."""
        if self.model is None:
            return docs
        names = docs.columns
        plain = docs.toDF(*[f"c{i}" for i in range(len(names))])  # any column names will do
        keyed = self._key(plain, f"c{names.index(self.id_col)}", f"c{names.index(self.text_col)}")
        return keyed.where(F.col("key") >= F.lit(float(self.least))).drop("log_importance", "key").toDF(*names)


def resample(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """One row per row of ``docs``: doc_id, log_importance, key, kept.

    Null and empty texts have log importance 0. Rows that tie with the last one taken are taken too; rows that repeat an id and text share
    one decision. Without documents labelled good all stay; an empty table gives no rows."""
    return Resampled(docs, labels, **how).decisions(docs)
