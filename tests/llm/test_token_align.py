"""The alignment of two tokenizers against plain versions and the tokenizers' own libraries."""

import collections
import hashlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from voronoi.llm import bpe, token_align

SPEC = token_align.read_spec(public_tokenizers.path("byte_bpe_50k.json"))
MODEL = token_align.read_model(public_tokenizers.path("piece_bpe_32k.model"))
SCHEMA = "doc_id long, text string, row long, pair long, n long, links string"


@pytest.fixture(scope="module")
def tools():
    a = Tokenizer.from_str(SPEC)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_proto=MODEL)


def token_bytes(tools, text):
    """[(id, bytes)] of either side, from the libraries alone."""
    a, b = tools
    back = {c: x for x, c in enumerate(bpe.byte_chars())}
    one = [(i, bytes(back[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    two = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text)]
    return one, two


def plain(tools, text):
    """(ids of A, ids of B, groups' string, links) by walking over all ends."""
    raw = b" " + (text or "").encode()
    sides = token_bytes(tools, text) if text else ([], [])
    if not text or any(b"".join(x for _, x in s) != raw for s in sides):
        return [], [], "", collections.Counter()
    spans = []
    for s in sides:
        at, out = 0, []
        for i, x in s:
            out.append((i, at, at + len(x)))
            at += len(x)
        spans.append(out)
    a, b = spans
    groups, links = [], collections.Counter()
    shared = sorted({e for *_, e in a} & {e for *_, e in b})
    begin = 0
    for end in shared:
        x, y = ([(i, s, e) for i, s, e in side if begin <= s and e <= end] for side in (a, b))
        groups.append(",".join(str(i) for i, *_ in x) + "|" + ",".join(str(i) for i, *_ in y))
        for i, s, e in x:
            links.update((i, j) for j, t, f in y if s < f and t < e)
        begin = end
    return [i for i, *_ in a], [j for j, *_ in b], ";".join(groups), links


def wanted(tools, rows):
    made = [plain(tools, r[1]) for r in rows]
    counts = collections.Counter()
    for *_, links in made:
        counts.update(links)
    top = collections.Counter()
    for (_, j), n in counts.items():
        top[j] = max(top[j], n)
    return collections.Counter(
        (r[0], len(a), len(b), said.count(";") + 1 if a else 0, sum(links.values()), sum(k for p, k in links.items() if counts[p] == top[p[1]]), sum(k * counts[p] for p, k in links.items()), hashlib.sha256(said.encode()).hexdigest() if a else "")
        for r, (a, b, said, links) in zip(rows, made))


def random_text(rng, n):
    parts = ["the ", "tion", " of ", "é", "ß", "日本", "語", "  ", " ", "\n", "\t", ".", ",", "'s", '"', "123", "🙂", "ABC", "<s>", "</s>", "<|endoftext|>", "<0x0A>", "x", "word", "naïve", "\r\n", "\x00b", " ", "é", "ing"]
    return "".join(rng.choice(parts, n))


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(2)
    out = [(i, random_text(rng, int(rng.integers(0, 50)))) for i in range(250)]
    out += [(None, "a row without id"), (900, None), (901, ""), (902, " "), (903, "a "), (904, "has▁the sign"), (905, "twice the row"), (905, "twice the row"), (906, " ".join(random_text(rng, 3) for _ in range(1500))), (907, "日本語テスト" * 300), (908, "x" * 900), (909, "word ▁ word " * 200)]
    return [(*r, 1, 2, 3, "x") for r in out]


def test_pieces_encode_as_the_library_does(tools, rows, monkeypatch):
    rng = np.random.default_rng(8)
    texts = [r[1] for r in rows if r[1] and "▁" not in r[1]] + [random_text(rng, int(rng.integers(1, 40))) for _ in range(4000)]
    for long, cached, entries in ((token_align.LONG_CHARS, 48, 400_000), (3, 3, 64), (5, 10, 8)):
        monkeypatch.setattr(token_align, "LONG_CHARS", long)
        monkeypatch.setattr(token_align, "CACHE_CHARS", cached)
        monkeypatch.setattr(token_align, "CACHE_ENTRIES", entries)
        pieces = token_align.Pieces(MODEL)
        made = [m for i in range(0, len(texts), 100) for m in pieces.encode([" " + t for t in texts[i:i + 100]])]
        for t, m in zip(texts, made):
            assert not t or np.frombuffer(m, "<u4").tolist() == tools[1].encode(t), t


def test_shared_cuts():
    rng = np.random.default_rng(4)
    for _ in range(300):
        ea, eb, lasts, at = [], [], [], 0
        for _ in range(int(rng.integers(1, 5))):
            n = int(rng.integers(1, 80))
            for ends, p in ((ea, rng.random()), (eb, rng.random())):
                ends += [at + x for x in range(1, n) if rng.random() < p] + [at + n]
            lasts.append(len(ea) - 1)
            at += n
        got = token_align.shared_cuts(np.array(ea), np.array(eb), np.array(lasts))
        assert got.tolist() == [i for i, e in enumerate(ea) if e in set(eb)]


@pytest.mark.parametrize("how", [{}, {"max_pairs": 300}, {"max_pairs": 0, "step": 700}, {"step": 200}])
def test_align_texts(spark, tools, rows, how):
    """Whole, with only some pairs sent, with none sent, and with texts aligned in parts."""
    got = token_align.align_texts(spark.createDataFrame(rows, SCHEMA).repartition(3), SPEC, MODEL, **how)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert collections.Counter(tuple(r) for r in got.collect()) == wanted(tools, rows)


def test_sums_flush(spark, rows, monkeypatch):
    held = [np.array([3, 3, 5], "<u4"), np.array([5], "<u4"), np.array([7, 3], "<u4")]
    import pyarrow as pa
    for links, pairs in ((1, 1), (4, 1), (100, 100)):
        monkeypatch.setattr(token_align, "HELD_LINKS", links)
        monkeypatch.setattr(token_align, "HELD_PAIRS", pairs)
        total = collections.Counter()
        for b in token_align._sums(pa.RecordBatch.from_arrays([pa.array([h.tobytes()], pa.binary())], names=["links"]) for h in held):
            total.update(dict(zip(b.column(0).to_pylist(), b.column(1).to_pylist())) if links < 100 else dict(zip(b.column(0).to_pylist(), b.column(1).to_pylist())))
        assert total == {3: 3, 5: 2, 7: 1}


def test_empty(spark):
    assert token_align.align_texts(spark.createDataFrame([], SCHEMA), SPEC, MODEL).count() == 0
