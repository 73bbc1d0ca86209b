"""Importance resampling against a plain version: n-grams, both models, log importance, cut, Gumbel keys and what is kept."""

import collections
import math
import re
import struct

import numpy as np
import xxhash

from voronoi.llm import importance, textvec

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
M = (1 << 64) - 1


def mix(x):
    x ^= x >> 33
    x = x * 0xFF51AFD7ED558CCD & M
    x ^= x >> 33
    x = x * 0xC4CEB9FE1A85EC53 & M
    return x ^ x >> 33


def plain_grams(text):
    """Buckets of a text's n-grams, word by word."""
    words = WORD.findall((text or "").encode())
    out, shapes, before = [], [], None
    for w in words:
        low = bytes(b + 32 if 65 <= b <= 90 else b for b in w)
        out.append(mix(int(textvec.word_hashes(np.frombuffer(low, np.uint8), np.array([0]), np.array([len(low)]))[0])) % importance.WORD_BUCKETS)
        upper = sum(65 <= b <= 90 for b in w)
        letters = sum(65 <= b <= 90 or 97 <= b <= 122 or b >= 128 for b in w)
        digits = sum(48 <= b <= 57 for b in w)
        case = 0 if not upper else 2 if upper > 1 and upper == letters else 1 if upper == 1 and 65 <= w[0] <= 90 else 3
        last = w[-1]
        shape = 0 if 65 <= last <= 90 or 97 <= last <= 122 or last >= 128 or 48 <= last <= 57 else last
        for part, size in ((case, 4), (min(digits, 1), 2), (min(len(w) - letters - digits, 3), 4), (min(letters, 1), 2), (low == before, 2)):
            shape = shape * size + int(part)
        shapes.append(shape)
        before = low
    for i in range(len(shapes)):
        run = 0
        for k, shape in enumerate(shapes[i:i + 3]):
            run = mix((run * 0x9E3779B97F4A7C15 + shape + k + 1) & M)
            out.append(importance.WORD_BUCKETS + run % importance.SHAPE_BUCKETS)
    return collections.Counter(out)


def plain_noise(i, text):
    first = xxhash.xxh64(b"gumbel", seed=42).intdigest()
    own = i if i is not None else xxhash.xxh64((text or "").encode(), seed=42).intdigest()
    bits = xxhash.xxh64(struct.pack("<Q", own & M), seed=first).intdigest() >> 11
    return -math.log(-math.log((bits + 0.5) / (1 << 53)))


def plain_cut(scores):
    """Every midway cut tried."""
    goods, bads = [s for s, g in scores if g], [s for s, g in scores if not g]
    if not goods or not bads:
        return -math.inf
    values = sorted(s for s, _ in scores)
    cuts = [-math.inf, *((a + b) / 2 for a, b in zip(values, values[1:])), values[-1] + 1]
    return min(cuts, key=lambda c: (importance.LOSS * sum(s < c for s in goods) / len(goods) + sum(s >= c for s in bads) / len(bads), cuts.index(c)))


def test_importance_is_the_plain_one(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    extra = spark.createDataFrame([(None, "a text of its own"), (7001, None), (7002, ""), (7003, "ONE One one one 1st 2-nd end."), (7003, "ONE One one one 1st 2-nd end.")], "doc_id long, text string")
    docs = docs.unionByName(extra)
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    rows = [tuple(r) for r in docs.collect()]
    good = {}
    for r in labels.collect():
        if r.doc_id is not None and r.quality is not None:
            good[r.doc_id] = good.get(r.doc_id, False) or r.quality == 1
    grams = [plain_grams(t) for _, t in rows]
    raw, target = np.zeros(importance.BUCKETS), np.zeros(importance.BUCKETS)
    for (i, _), g in zip(rows, grams):
        for b, n in g.items():
            raw[b] += n
            target[b] += n * bool(good.get(i))
    ratios = np.zeros(importance.BUCKETS)
    for part in (slice(0, importance.WORD_BUCKETS), slice(importance.WORD_BUCKETS, importance.BUCKETS)):
        p, q = ((x[part] + importance.SMOOTHING) / (x[part].sum() + importance.SMOOTHING * len(x[part])) for x in (target, raw))
        ratios[part] = np.log(p / q)
    scores = [sum(n * ratios[b] for b, n in g.items()) for g in grams]
    per = {}
    for (i, _), s in zip(rows, scores):
        if i in good:
            per[i] = max(per.get(i, -math.inf), s)
    cut = plain_cut([(s, good[i]) for i, s in per.items()])
    keys = [s * importance.SHARPNESS + plain_noise(i, t) for (i, t), s in zip(rows, scores)]
    k = sum(s >= cut for s in scores)
    least = sorted(keys, reverse=True)[k - 1]
    fitted = importance.Resampled(docs, labels)
    assert math.isclose(fitted.cut, cut, abs_tol=1e-6) and math.isclose(fitted.least, least, abs_tol=1e-6)
    got = sorted(((r.doc_id is not None, r.doc_id or 0, r.log_importance, r.key, r.kept) for r in fitted.decisions(docs).collect()))
    want = sorted(((i is not None, i or 0, s, key, key >= least - 1e-9) for (i, _), s, key in zip(rows, scores, keys)))
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a[:2] == b[:2] and a[4] == b[4] and math.isclose(a[2], b[2], abs_tol=1e-6) and math.isclose(a[3], b[3], abs_tol=1e-6)
    assert 0 < sum(a[4] for a in got) < len(got)
