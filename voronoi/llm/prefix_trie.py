"""Prefix trie of conversations by truncation peeling.

A conversation is its sequence of turns; every distinct sequence of first d turns is a node of depth d. The nodes are found from the
deepest level upwards: the nodes of a level are the surviving ones of the level below, with their last turn stripped, merged with the
conversations that end here. Regrouping a level both finds its nodes and sums what they hold, so no conversation is ever
expanded into all of its prefixes. A node's row is all that moves on, so thousands of equal conversations travel as one row. Deep levels,
where the paths below a prefix are few, are peeled within a task for each prefix; the levels above are one aggregate each.

A path is a string of fixed-width units, one for each turn: 128 bits of a digest of role and text, and 64 bits that hold the number of
words. Stripping a turn is cutting off a unit. Two different turns share a unit with probability 2**-128.
"""

from __future__ import annotations

import base64
import collections
import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable, shuffle_partitions

WORD = r"[^\x20\x09-\x0D]+"
#: Characters of a unit: 24 bytes in base 64.
UNIT = 32
#: Conversations of which some twentieth lends its first turns, and the turns lent, in ``rebuilt``.
GROUP, LENT = 20, 4
#: Ids of one row of ``_ended``; bounds the rows of a batch.
BLOCK = 256
#: Turns of the paths below one prefix that a task peels by itself (32 bytes each).
TASK_TURNS = 500_000
#: A parent with more children than all nodes divided by this is broadcast: fewer than this many.
HOT_SHARE = 2_000


def unit(role: Column, text: Column) -> Column:
    """The unit of a turn; null role and text count as empty."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    words = F.regexp_count(text, F.lit(WORD)).cast("long")
    return F.base64(F.unhex(F.concat(digest, F.lpad(F.hex(words), 16, "0"))))


def _words(path: Column) -> Column:
    """The number of words of a path's last turn."""
    return F.conv(F.substring(F.hex(F.unbase64(F.right(path, F.lit(UNIT)))), 33, 16), 16, 10).cast("long")


def paths(turns: DataFrame, by: Column | None = None) -> DataFrame:
    """(conv_id, path) from (conv_id, turn, role, text): turns in the order of ``turn``, null first, equal ones by their digest.

    Rows without conv_id belong to no conversation and are left out. ``by``: a column of conv_id to partition by."""
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", unit(F.col("role"), F.col("text")).alias("u")).where("conv_id is not null")
    if by is not None:
        rows = rows.withColumn("g", by).repartition("g")
    keys = ["conv_id"] if by is None else ["g", "conv_id"]
    ordered = F.sort_array(F.collect_list(F.struct("turn", "u")))
    return rows.groupBy(*keys).agg(F.array_join(F.transform(ordered, lambda t: t["u"]), "").alias("path"))


def rebuilt(turns: DataFrame, group: int = GROUP, lent: int = LENT) -> DataFrame:
    """(conv_id, path): conversation c gets the first h turns of conversation c - c % group (all if fewer, none if there is none), then
    its own turns after its first h; h is the unsigned crc32 of c's decimal form modulo ``lent``.

    Both parts of the join are already partitioned by the lending conversation, so there is one shuffle, of units and not of texts."""
    c = F.col("conv_id")
    base = c - c % group
    own = paths(turns, base)
    heads = own.where(c == F.col("g")).select("g", F.substring("path", 1, (lent - 1) * UNIT).alias("head"))
    h = (F.crc32(c.cast("string").cast("binary")) % lent).cast("int") * UNIT
    head = F.coalesce(F.col("head"), F.lit(""))
    path = F.concat(F.substring(head, F.lit(1), h), F.substring(F.col("path"), h + 1, F.length("path")))
    return own.join(heads.hint("shuffle_hash"), "g", "left").select("conv_id", path.alias("path"))


def _blocks(batches):
    """Sorted rows (path, conv_id) to rows (path, first id, ids joined by commas, number of ids), at most BLOCK ids each."""
    key, ids = None, []
    made: list[tuple] = []

    def flush():
        made.append((key, ids[0], ",".join(map(str, ids)), len(ids)))

    def out():
        cols = list(zip(*made)) if made else [(), (), (), ()]
        made.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.string(), pa.int64()))], names=["path", "first", "ids", "n"])

    for batch in batches:
        for path, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if ids and (path != key or len(ids) >= BLOCK):
                flush()
                ids = []
            key = path
            ids.append(conv)
        yield out()
    if ids:
        flush()
        yield out()


def _digests(batches):
    """Sorted rows of ``_blocks`` to one row for each path: (path, least id, number of ids, SHA-256 of all ids)."""
    key, least, n, sha = None, 0, 0, None
    made: list[tuple] = []

    def out():
        cols = list(zip(*made)) if made else [(), (), (), ()]
        made.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.int64(), pa.string()))], names=["path", "conv_id", "n_convs", "ends_sha256"])

    for batch in batches:
        for path, first, ids, count in zip(*(c.to_pylist() for c in batch.columns[:4])):
            if sha is None or path != key:
                if sha is not None:
                    made.append((key, least, n, sha.hexdigest()))
                key, least, n, sha = path, first, 0, hashlib.sha256()
            else:
                sha.update(b",")
            sha.update(ids.encode())
            n += count
        yield out()
    if sha is not None:
        made.append((key, least, n, sha.hexdigest()))
        yield out()


def _ended(convs: DataFrame) -> DataFrame:
    """(path, conv_id, n_convs, ends_sha256, depth) of every path at which a conversation ends.

    The digest of a path's ids in order is a chain, so one task has to read them; it reads them as a stream of blocks, made in parallel by a
    range partitioning that splits one path's ids, and holds a batch of blocks at a time."""
    n = shuffle_partitions(convs.sparkSession)
    blocks = convs.select("path", "conv_id").repartitionByRange(n, "path", "conv_id").sortWithinPartitions("path", "conv_id").mapInArrow(_blocks, "path string, first long, ids string, n long")
    made = blocks.repartition(n, "path").sortWithinPartitions("path", "first").mapInArrow(_digests, "path string, conv_id long, n_convs long, ends_sha256 string")
    return made.withColumn("depth", (F.length("path") / UNIT).cast("int")).sortWithinPartitions("depth")


def _depth(ended: DataFrame, most: int) -> int:
    """The depth from which tasks peel by themselves: the least power of two such that the paths that share so many turns hold ``most``
    turns together at most; beyond the deepest path if there is none."""
    deepest = ended.agg(F.max("depth")).first()[0]
    depth = 2
    while deepest is not None and depth <= deepest:
        below = ended.where(F.col("depth") >= depth).groupBy(F.substring("path", 1, depth * UNIT)).agg(F.sum("depth").alias("turns")).agg(F.max("turns")).first()[0]
        if below <= most:
            break
        depth *= 2
    return depth


def _peel(depth: int):
    """Kernel over rows of ``_ended`` that share their first ``depth`` turns, sorted by these: the nodes from that depth on, with their
    parents but for those of depth ``depth``, which survive with their path."""
    none = hashlib.sha256(b"").hexdigest()

    def words(path):
        return int.from_bytes(base64.b64decode(path[-UNIT:])[16:], "big")

    def group(rows):
        """Peels the paths of one prefix: {path: [least id, members, children, leaves, saved, ends, children's rows]} of one level after the other."""
        ending = collections.defaultdict(list)
        for path, conv, n, ends, d in rows:
            ending[d].append((path, conv, n, ends))
        level, d = {}, max(ending)
        while True:
            up = {}
            for path, conv, n, ends in ending.get(d, ()):  # newly ended conversations
                up[path] = [conv, n, 0, 0, 0, ends, []]
            for path, (conv, n, kids, leaves, saved, ends, below) in level.items():  # survivors, stripped of their last turn
                node = up.setdefault(path[:d * UNIT], [conv, 0, 0, 0, 0, none, []])
                node[0] = min(node[0], conv)
                node[1] += n
                node[2] += 1
                node[3] += leaves
                node[4] += saved
                node[6].append((conv, d + 1, n, kids, leaves, saved, ends))
            for path, node in up.items():
                node[3] = node[3] or 1
                node[4] += (node[1] - 1) * words(path)
                for conv, at, *rest in node[6]:
                    yield None, conv, at, node[0], *rest
                node[6] = ()
            level = up
            if d == depth:
                for path, node in level.items():
                    yield path, node[0], d, None, *node[1:6]
                return
            d -= 1

    def run(batches):
        made, rows, key = [], [], None
        out = lambda: pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*made) if made else [[]] * len(_NODE), _NODE)], names=[n for n, _ in _NODE])
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                prefix = row[0][:depth * UNIT]
                if rows and prefix != key:
                    made.extend(group(rows))
                    rows = []
                key = prefix
                rows.append(row)
                if len(made) >= 4096:
                    yield out()
                    made.clear()
        if rows:
            made.extend(group(rows))
        yield out()

    return run


_NODE = [("path", pa.string()), ("conv_id", pa.int64()), ("depth", pa.int32()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string())]
_NODE_DDL = "path string, conv_id long, depth int, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def trie(convs: DataFrame, most_turns: int = TASK_TURNS) -> DataFrame:
    """The nodes of the trie of (conv_id, path) rows with unique conv_ids.

    conv_id (the least of the node's members), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256. No
    conversations give no node. From the depth on at which no prefix holds more than ``most_turns`` turns, tasks peel all levels by themselves;
    above it each level is one aggregate over all that survives, so hot prefixes are summed before they are shuffled."""
    spark = convs.sparkSession
    ended = durable(_ended(durable(convs)))
    depth = _depth(ended, most_turns)
    deep = ended.where(F.col("depth") >= depth).select("path", "conv_id", "n_convs", "ends_sha256", "depth").withColumn("p", F.substring("path", 1, depth * UNIT))
    peeled = durable(deep.repartition(shuffle_partitions(spark), "p").sortWithinPartitions("p").drop("p").mapInArrow(_peel(depth), _NODE_DDL))
    none = hashlib.sha256(b"").hexdigest()
    zero = F.lit(0).cast("long")
    levels = [peeled.where("path is not null").drop("parent_conv_id")]
    for d in range(depth - 1, -1, -1):
        stripped = F.col("path").substr(F.lit(1), F.lit(d * UNIT))
        rows = ended.where(F.col("depth") == d).select("path", "conv_id", "n_convs", zero.alias("n_children"), zero.alias("n_leaves"), zero.alias("saved_tokens"), "ends_sha256")
        rows = rows.unionByName(levels[-1].select(stripped.alias("path"), "conv_id", "n_convs", F.lit(1).cast("long").alias("n_children"), "n_leaves", "saved_tokens", F.lit(None).cast("string").alias("ends_sha256")))
        sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
        found = rows.groupBy("path").agg(F.min("conv_id").alias("conv_id"), *sums, F.max("ends_sha256").alias("ends_sha256"))
        words = _words(F.col("path")) if d else zero
        levels.append(durable(found.select(
            "path", "conv_id", F.lit(d).alias("depth"), "n_convs", "n_children",
            F.when(F.col("n_children") == 0, F.lit(1).cast("long")).otherwise(F.col("n_leaves")).alias("n_leaves"),
            (F.col("saved_tokens") + (F.col("n_convs") - 1) * words).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"),
        )))
    nodes = levels[0]
    for level in levels[1:]:
        nodes = nodes.unionByName(level)
    return _with_parents(nodes).unionByName(peeled.where("path is null").select(*COLUMNS)).withColumn("depth", F.col("depth").cast("long"))


def _with_parents(nodes: DataFrame) -> DataFrame:
    """Parents with very many children (fewer than HOT_SHARE, as every child counts once) are broadcast, the others joined by path."""
    total = nodes.count()
    hot = F.col("n_children") * HOT_SHARE > total
    parents = nodes.where("n_children > 0")
    up = lambda df: df.select(F.col("path").alias("up"), F.col("conv_id").alias("parent_conv_id"))
    below = nodes.where("depth > 0").withColumn("up", F.col("path").substr(F.lit(1), F.length("path") - UNIT))
    near = below.join(F.broadcast(up(parents.where(hot))), "up", "left")
    found = near.where("parent_conv_id is not null")
    rest = near.where("parent_conv_id is null").drop("parent_conv_id").join(up(parents.where(~hot)).hint("merge"), "up")
    top = nodes.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    made = [df.select(*COLUMNS) for df in (found, rest, top)]
    return made[0].unionByName(made[1]).unionByName(made[2])


def conversation_trie(turns: DataFrame, group: int = GROUP, lent: int = LENT, most_turns: int = TASK_TURNS) -> DataFrame:
    """The trie of the conversations rebuilt from (conv_id, turn, role, text); other columns are not read.

    Null roles and texts count as empty; rows without conv_id are left out; a conversation without turns belongs to the root alone; equal
    rows of a conversation are turns of their own; turns with equal numbers are ordered by their digests. Texts of any length
    leave the scan as digests. A conversation's path is one value (32 characters a turn)."""
    return trie(rebuilt(turns, group, lent), most_turns)


SQL = r"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, turn,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, ''))) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
bits AS (
  SELECT conv_id, conv_id::varchar AS s, list_transform(range(8 * length(conv_id::varchar)), lambda k: ((ascii(substr(conv_id::varchar, k // 8 + 1, 1)) >> (k % 8)::integer) & 1)::bigint) AS b
  FROM (SELECT DISTINCT conv_id FROM t)),
c AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base,
    xor(list_reduce(b, lambda a, x: CASE WHEN xor(a, x) & 1 = 1 THEN xor(xor(a, x) >> 1, 3988292384) ELSE xor(a, x) >> 1 END, 4294967295::bigint), 4294967295::bigint) % 4 AS h
  FROM bits),
own AS (
  SELECT c.conv_id, t.i, t.role, t.text FROM c JOIN t ON t.conv_id = c.base AND t.i <= c.h
  UNION ALL
  SELECT c.conv_id, t.i, t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id AND t.i > c.h),
r AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY i) AS depth, length(role)::varchar || ':' || role || text AS turn,
    len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words FROM own),
paths AS (
  SELECT conv_id, depth, words, string_agg(md5(turn), '') OVER (PARTITION BY conv_id ORDER BY depth) AS path, max(depth) OVER (PARTITION BY conv_id) AS last FROM r
  UNION ALL
  SELECT c.conv_id, 0, 0, '', coalesce(m.last, 0) FROM c LEFT JOIN (SELECT conv_id, max(depth) AS last FROM r GROUP BY conv_id) m USING (conv_id)),
n AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(words) AS own_tokens,
    sha256(coalesce(string_agg(conv_id::varchar, ',' ORDER BY conv_id) FILTER (WHERE depth = last), '')) AS ends_sha256
  FROM paths GROUP BY path, depth),
kids AS (SELECT substr(path, 1, 32 * (depth - 1)::integer) AS path, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
full_n AS (SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM n LEFT JOIN kids k USING (path)),
sub AS (
  SELECT substr(path, 1, 32 * d::integer) AS path, sum((n_children = 0)::integer) AS n_leaves, sum(own_tokens) AS saved_tokens
  FROM (SELECT *, unnest(range(depth + 1)) AS d FROM full_n) GROUP BY 1)
SELECT a.conv_id, a.depth, p.conv_id AS parent_conv_id, a.n_convs, a.n_children, s.n_leaves::bigint AS n_leaves, s.saved_tokens::bigint AS saved_tokens, a.ends_sha256
FROM full_n a JOIN sub s USING (path) LEFT JOIN n p ON a.depth > 0 AND p.path = substr(a.path, 1, 32 * (a.depth - 1)::integer)
"""
