"""The conversation trie against a plain version: nulls, ties, repeated rows, absent lenders, empty tables, clashing columns."""

import collections
import hashlib
import re
import zlib

import duckdb
import numpy as np
import pytest

from voronoi.llm import prefix_trie

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "conv_id long, turn long, role string, text string, path string, g long, depth int, n_convs long"


def wanted(rows, group=20, lent=4):
    turns = collections.defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            turns[c].append(((turn is not None, turn or 0), bytes.fromhex(digest), role, text))
    own = {c: [x[2:] for x in sorted(t)] for c, t in turns.items()}
    made = {}
    for c in own:
        base = c - (c % group if c >= 0 else -(-c % group))
        h = zlib.crc32(str(c).encode()) % lent
        made[c] = tuple(own.get(base, [])[:h] + own[c][h:])
    nodes = collections.defaultdict(list)
    for c, t in made.items():
        for d in range(len(t) + 1):
            nodes[t[:d]].append(c)
    kids = collections.Counter(p[:-1] for p in nodes if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, members in nodes.items():
        words = len(WORD.findall(p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(members) - 1) * words
    return collections.Counter(
        (min(m), len(p), min(nodes[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p], hashlib.sha256(",".join(str(c) for c in sorted(m) if made[c] == p).encode()).hexdigest())
        for p, m in nodes.items())


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(5)
    out = []
    for c in [*range(0, 130), 1000, 1007, 2003, -5, -20, -27]:
        for turn in range(int(rng.integers(1, 7))):
            text = ["hello there", "how are you", "", None, "x " * 40][int(rng.integers(0, 5))] if rng.random() < 0.8 else f"own {c} {turn}"
            out.append((c, turn, ["user", "assistant", None][turn % 3], text))
    out += [(300 + k, t, "user", f"same {t}") for k in range(700) for t in range(3)]  # copies of one conversation, several blocks of ids
    out += [(40, None, "user", "first of all"), (41, 2, "user", "tie a"), (41, 2, "user", "tie b"), (42, 1, "user", "twice"), (42, 1, "user", "twice"), (None, 0, "user", "no id"), (43, 9, "user", "long " * 100_000)]
    out += [(c, t, "user", f"deep {t}" if t < at else f"own {c}") for c, at in ((1100, 150), (1101, 90), (1102, 150), (1103, 149)) for t in range(150)]  # far deeper than the others
    return [(*r, "p", 7, 3, 9) for r in out]


def test_trie(spark, rows, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK", 16)
    got = prefix_trie.conversation_trie(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert collections.Counter(tuple(r) for r in got.collect()) == wanted(rows)


@pytest.mark.parametrize("group,lent,most", [(1, 4, 10**6), (5, 2, 60)])
def test_other_parameters(spark, rows, group, lent, most):
    """Also with tasks that may peel little by themselves, so that more levels are aggregates."""
    rows = rows[:2600]
    got = prefix_trie.conversation_trie(spark.createDataFrame(rows, SCHEMA), group, lent, most)
    assert collections.Counter(tuple(r) for r in got.collect()) == wanted(rows, group, lent)


def test_no_broadcast_parents(spark, rows, monkeypatch):
    """All parents joined, and all parents broadcast."""
    for share in (0, 10**9):
        monkeypatch.setattr(prefix_trie, "HOT_SHARE", share)
        got = prefix_trie.conversation_trie(spark.createDataFrame(rows[:60], SCHEMA))
        assert collections.Counter(tuple(r) for r in got.collect()) == wanted(rows[:60])


def test_empty(spark):
    none = prefix_trie.conversation_trie(spark.createDataFrame([], SCHEMA))
    assert none.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"] and none.count() == 0


def test_turnless(spark):
    """A lone conversation whose turns all go, with no lender, belongs to the root."""
    c = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 == 3)
    got = prefix_trie.conversation_trie(spark.createDataFrame([(c, 0, "user", "a", "", 0, 0, 0)], SCHEMA)).collect()
    assert [tuple(r) for r in got] == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]


def test_oracle_sql(rows):
    """The SQL agrees with the plain version, negative ids and ties included."""
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", [r[:4] for r in rows[:400]])
    cols = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert collections.Counter(con.sql(f"SELECT {', '.join(cols)} FROM ({prefix_trie.SQL})").fetchall()) == wanted(rows[:400])
