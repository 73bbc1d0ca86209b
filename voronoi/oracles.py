"""DuckDB SQL equivalents of ``catalog.QUERIES`` (the correctness oracle).

Written independently of the Spark code: vectors are unnested to long form
(id, pos, x) and every vector operation is a join on ``pos`` plus an aggregate;
the iterations are recursive CTEs whose state is the long-form centroid table
of each step (see ``loop_sql``).
"""

from __future__ import annotations

from .catalog import C_SEEDS, E_SEEDS, FIXED_STEPS, L_CENTROIDS, TOL


def R6(x: str) -> str:
    # + 0.0 turns a rounded -0.0 into 0.0, as Spark's decimal rounding does
    return f"(round({x}, 6) + 0.0)"


E_LONG = ("SELECT vec_id AS id, CAST(unnest(embedding) AS DOUBLE) AS x, "
          "generate_subscripts(embedding, 1) - 1 AS pos FROM embeddings")
E_SEED_IDS = f"SELECT vec_id FROM embeddings ORDER BY vec_id LIMIT {E_SEEDS}"
C_POINTS = "SELECT c_custkey AS id, CAST(c_nationkey AS DOUBLE) AS x1, c_acctbal / 1000.0 AS x2 FROM customer"
C_LONG = (f"SELECT id, 0 AS pos, x1 AS x FROM ({C_POINTS}) UNION ALL "
          f"SELECT id, 1 AS pos, x2 AS x FROM ({C_POINTS})")
C_SEEDS_SQL = f"SELECT id, x1, x2 FROM ({C_POINTS}) ORDER BY id LIMIT {C_SEEDS}"
C_KEYED = f"SELECT id, x1, x2, row_number() OVER (ORDER BY id) AS cl FROM ({C_SEEDS_SQL})"


def loop_sql(points: str, seeds: str, max_iter: int, stop: str, tail: str) -> str:
    """Lloyd loop as a recursive CTE.

    points: (id, pos, x); seeds: (cid, pos, x). Each recursive step assigns
    points to the nearest centroid (ties: lowest cid), averages per (cid, pos),
    and decides ``go`` for the next step: ``tol`` (some centroid moved by
    >= TOL, NaN = converged), ``exact`` (some coordinate changed) or ``none``.
    The CTE ``loop`` holds every step; ``tail`` selects from it.
    """
    t2 = repr(TOL * TOL)
    move = "sum((n.x - o.x) * (n.x - o.x))"
    flag = {
        "tol": f"(NOT isnan({move}) AND {move} >= {t2})",
        "exact": "bool_or(n.x <> o.x)",
        "none": "true",
    }[stop]
    go = "true" if stop == "none" else "coalesce((SELECT bool_or(moved) FROM mv), false)"
    return f"""
WITH RECURSIVE
pts AS ({points}),
seeds AS ({seeds}),
loop(it, cid, pos, x, go) AS (
  SELECT 0, cid, pos, x, true FROM seeds
  UNION ALL
  SELECT * FROM (
    WITH cur AS (SELECT it, cid, pos, x FROM loop WHERE go AND it < {max_iter}),
    dist AS (SELECT p.id, c.cid, sum((p.x - c.x) * (p.x - c.x)) AS d2
             FROM pts p JOIN cur c ON p.pos = c.pos GROUP BY p.id, c.cid),
    lab AS (SELECT id, cid FROM (SELECT id, cid, row_number() OVER (PARTITION BY id ORDER BY d2, cid) AS rn
                                 FROM dist) WHERE rn = 1),
    nw AS (SELECT l.cid, p.pos, avg(p.x) AS x FROM lab l JOIN pts p ON p.id = l.id GROUP BY l.cid, p.pos),
    mv AS (SELECT n.cid, {flag} AS moved FROM nw n JOIN cur o ON o.cid = n.cid AND o.pos = n.pos GROUP BY n.cid),
    nxt AS (SELECT max(it) + 1 AS it FROM cur)
    SELECT nxt.it, nw.cid, nw.pos, nw.x, {go} AS go FROM nw, nxt
  )
),
last_it AS (SELECT max(it) AS it FROM loop)
{tail}
"""


def _labels_tail(id_name: str, offset: int = 0) -> str:
    return f"""
, fin AS (SELECT cid, pos, x FROM loop WHERE it = (SELECT it FROM last_it) - {offset}),
d AS (SELECT p.id, f.cid, sum((p.x - f.x) * (p.x - f.x)) AS d2 FROM pts p JOIN fin f ON p.pos = f.pos
      GROUP BY p.id, f.cid),
lab AS (SELECT id, cid FROM (SELECT id, cid, row_number() OVER (PARTITION BY id ORDER BY d2, cid) AS rn
                             FROM d) WHERE rn = 1)
"""


E_SEEDS_LONG = f"SELECT id AS cid, pos, x FROM ({E_LONG}) WHERE id IN ({E_SEED_IDS})"
C_SEEDS_LONG = (f"SELECT id AS cid, 0 AS pos, x1 AS x FROM ({C_SEEDS_SQL}) UNION ALL "
                f"SELECT id AS cid, 1 AS pos, x2 AS x FROM ({C_SEEDS_SQL})")
C_KEYED_LONG = (f"SELECT cl AS cid, 0 AS pos, x1 AS x FROM ({C_KEYED}) UNION ALL "
                f"SELECT cl AS cid, 1 AS pos, x2 AS x FROM ({C_KEYED})")


def _cluster_sizes_sql() -> str:
    dims = ["l_quantity", "l_extendedprice / 1000.0", "l_discount * 100.0"]
    structs = []
    for cid, vec in L_CENTROIDS:
        terms = [f"(x{i + 1} - CAST({v!r} AS DOUBLE)) * (x{i + 1} - CAST({v!r} AS DOUBLE))" for i, v in enumerate(vec)]
        structs.append(f"{{'d': {' + '.join(terms)}, 'c': CAST({cid} AS BIGINT)}}")
    return f"""
WITH p AS (SELECT {dims[0]} AS x1, {dims[1]} AS x2, {dims[2]} AS x3 FROM lineitem),
a AS (SELECT x1, x2, x3, least({', '.join(structs)}).c AS cid FROM p)
SELECT cid AS cluster_id, count(*) AS n_points, {R6('avg(x1)')} AS m1, {R6('avg(x2)')} AS m2, {R6('avg(x3)')} AS m3
FROM a GROUP BY cid
"""


C_ONE_STEP = f"""
c AS ({C_POINTS}),
s AS (SELECT id AS cid, x1, x2 FROM ({C_SEEDS_SQL})),
lab AS (SELECT id, cid FROM (
  SELECT c.id, s.cid, row_number() OVER (PARTITION BY c.id ORDER BY
         (c.x1 - s.x1) * (c.x1 - s.x1) + (c.x2 - s.x2) * (c.x2 - s.x2), s.cid) AS rn
  FROM c CROSS JOIN s) WHERE rn = 1),
nw AS (SELECT l.cid, count(*) AS n, avg(c.x1) AS x1, avg(c.x2) AS x2 FROM lab l JOIN c ON c.id = l.id GROUP BY l.cid)
"""

C_KEYED_STEP = f"""
c AS ({C_POINTS}),
s AS ({C_KEYED}),
lab AS (SELECT id, cl FROM (
  SELECT c.id, s.cl, row_number() OVER (PARTITION BY c.id ORDER BY
         (c.x1 - s.x1) * (c.x1 - s.x1) + (c.x2 - s.x2) * (c.x2 - s.x2), s.cl, s.id) AS rn
  FROM c CROSS JOIN s) WHERE rn = 1),
nw AS (SELECT l.cl, avg(c.x1) AS x1, avg(c.x2) AS x2 FROM lab l JOIN c ON c.id = l.id GROUP BY l.cl),
reloc AS (SELECT s.id, s.cl, nw.x1, nw.x2 FROM s JOIN nw ON nw.cl = s.cl),
chg AS (SELECT s.id, s.cl FROM s JOIN nw ON nw.cl = s.cl WHERE s.x1 <> nw.x1 OR s.x2 <> nw.x2)
"""

_MOVE2 = "(s.x1 - nw.x1) * (s.x1 - nw.x1) + (s.x2 - nw.x2) * (s.x2 - nw.x2)"

ORACLE_SQL: dict[str, str] = {
    "parse_points": """
SELECT c_custkey, CAST(c_nationkey AS DOUBLE) AS d1, c_acctbal AS d2, CAST(2 AS BIGINT) AS n_dims
FROM customer WHERE c_mktsegment <> 'HOUSEHOLD'""",
    "parse_mixed_points": """
SELECT c_custkey, CAST(CASE c_mktsegment WHEN 'FURNITURE' THEN 1 WHEN 'BUILDING' THEN 3 ELSE 2 END AS BIGINT) AS n_dims,
       CASE WHEN c_mktsegment = 'FURNITURE' THEN c_acctbal ELSE CAST(c_nationkey AS DOUBLE) END AS d1,
       CASE WHEN c_mktsegment <> 'FURNITURE' THEN c_acctbal END AS d2,
       CASE WHEN c_mktsegment = 'BUILDING' THEN CAST(c_custkey AS DOUBLE) END AS d3
FROM customer""",
    "parse_centroids": """
SELECT c_custkey AS cluster_id, CAST(c_nationkey AS DOUBLE) AS d1, c_acctbal AS d2 FROM customer""",
    "parse_keyed": """
SELECT c_custkey AS id, CAST(c_nationkey AS DOUBLE) AS d1, c_acctbal AS d2,
       CAST(CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN c_nationkey ELSE -1 END AS BIGINT) AS cluster_id
FROM customer WHERE c_mktsegment <> 'MACHINERY'""",
    "format_labelled_points": """
SELECT CAST(c_nationkey AS VARCHAR) || chr(9) || CAST(CAST(c_custkey AS DOUBLE) AS VARCHAR) || ' '
       || CAST(CAST(c_nationkey AS DOUBLE) AS VARCHAR) AS value FROM customer""",
    "format_centroids": """
SELECT CAST(c_custkey AS VARCHAR) || ' ' || CAST(CAST(c_nationkey AS DOUBLE) AS VARCHAR) || ' '
       || CAST(floor(c_acctbal) AS VARCHAR) AS value FROM customer""",
    "format_fractions": """
SELECT CAST(c_nationkey AS VARCHAR) || chr(9) || CAST(c_acctbal AS VARCHAR) || ' ' || CAST(c_nationkey / 4.0::DOUBLE AS VARCHAR) AS value FROM customer
UNION ALL
SELECT CAST(c_custkey AS VARCHAR) || ' ' || CAST(c_acctbal AS VARCHAR) || ' ' || CAST(c_nationkey / 4.0::DOUBLE AS VARCHAR) FROM customer""",
    "keyed_roundtrip": """
SELECT c_custkey AS id, CAST(c_nationkey AS DOUBLE) AS d1, c_acctbal AS d2, CAST(c_nationkey AS BIGINT) AS cluster_id
FROM customer""",
    "squared_distance": f"""
WITH e AS ({E_LONG}),
f AS (SELECT v.vec_id AS id, m.first_id FROM embeddings v JOIN (SELECT label, min(vec_id) AS first_id FROM embeddings GROUP BY label) m
      ON v.label IS NOT DISTINCT FROM m.label)
SELECT a.id AS vec_id, {R6('sum((a.x - b.x) * (a.x - b.x))')} AS dist2
FROM e a JOIN f ON f.id = a.id JOIN e b ON b.id = f.first_id AND b.pos = a.pos GROUP BY a.id""",
    "euclidean_distance": f"""
WITH e AS ({E_LONG}),
f AS (SELECT v.vec_id AS id, m.first_id FROM embeddings v JOIN (SELECT label, min(vec_id) AS first_id FROM embeddings GROUP BY label) m
      ON v.label IS NOT DISTINCT FROM m.label)
SELECT a.id AS vec_id, {R6('sqrt(sum((a.x - b.x) * (a.x - b.x)))')} AS dist
FROM e a JOIN f ON f.id = a.id JOIN e b ON b.id = f.first_id AND b.pos = a.pos GROUP BY a.id""",
    "distance_matrix": f"""
WITH e AS ({E_LONG})
SELECT p.id AS vec_id, c.id AS cluster_id, {R6('sqrt(sum((p.x - c.x) * (p.x - c.x)))')} AS distance
FROM e p JOIN e c ON c.pos = p.pos WHERE c.id IN ({E_SEED_IDS}) GROUP BY p.id, c.id""",
    "vector_add": f"""
WITH e AS ({E_LONG}),
f AS (SELECT v.vec_id AS id, m.first_id FROM embeddings v JOIN (SELECT label, min(vec_id) AS first_id FROM embeddings GROUP BY label) m
      ON v.label IS NOT DISTINCT FROM m.label)
SELECT a.id AS vec_id, CAST(a.pos AS INTEGER) AS pos, {R6('a.x + b.x')} AS value
FROM e a JOIN f ON f.id = a.id JOIN e b ON b.id = f.first_id AND b.pos = a.pos""",
    "vector_scale": f"""
SELECT vec_id, CAST(pos AS INTEGER) AS pos, {R6('x / (label + 1)')} AS value FROM (
  SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS x, generate_subscripts(embedding, 1) - 1 AS pos
  FROM embeddings)""",
    "dimension_check": """
SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(min(len(embedding)) AS BIGINT) AS min_dims,
       CAST(max(len(embedding)) AS BIGINT) AS max_dims,
       CAST(sum(CASE WHEN embedding IS NULL OR len(list_filter(embedding, lambda v: v IS NULL)) > 0 THEN 1 ELSE 0 END)
            AS BIGINT) AS n_null
FROM embeddings""",
    "assign_nearest": f"""
WITH e AS ({E_LONG}),
d AS (SELECT p.id, c.id AS cid, sum((p.x - c.x) * (p.x - c.x)) AS d2 FROM e p JOIN e c ON c.pos = p.pos
      WHERE c.id IN ({E_SEED_IDS}) GROUP BY p.id, c.id)
SELECT id AS vec_id, cid AS cluster_id, {R6('d2')} AS dist2 FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY d2, cid) AS rn FROM d) WHERE rn = 1""",
    "assign_by_cross": f"""
WITH c AS ({C_POINTS}), s AS ({C_KEYED}),
d AS (SELECT c.id, s.cl, s.id AS sid, (c.x1 - s.x1) * (c.x1 - s.x1) + (c.x2 - s.x2) * (c.x2 - s.x2) AS d2
      FROM c CROSS JOIN s)
SELECT id, CAST(cl AS BIGINT) AS cluster_id, {R6('sqrt(d2)')} AS distance FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY d2, cl, sid) AS rn FROM d) WHERE rn = 1""",
    "assign_by_min": f"""
WITH e AS ({E_LONG}),
d AS (SELECT p.id, c.id AS cid, sum((p.x - c.x) * (p.x - c.x)) AS d2 FROM e p JOIN e c ON c.pos = p.pos
      WHERE c.id IN ({E_SEED_IDS}) GROUP BY p.id, c.id)
SELECT id AS vec_id, cid AS cluster_id FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY d2, cid) AS rn FROM d) WHERE rn = 1""",
    "update_centroids": """
SELECT CAST(label AS BIGINT) AS cluster_id, count(*) AS n_points, CAST(pos AS INTEGER) AS pos,
       (round(avg(x), 6) + 0.0) AS coord FROM (
  SELECT label, CAST(unnest(embedding) AS DOUBLE) AS x, generate_subscripts(embedding, 1) - 1 AS pos
  FROM embeddings) GROUP BY label, pos""",
    "vector_mean_sql": """
SELECT half, count(*) AS n_points, CAST(pos AS INTEGER) AS pos, (round(avg(x), 6) + 0.0) AS coord FROM (
  SELECT CASE WHEN label <> 3 THEN label / 2.0::DOUBLE END AS half, CAST(unnest(embedding) AS DOUBLE) AS x, generate_subscripts(embedding, 1) - 1 AS pos
  FROM embeddings) GROUP BY half, pos""",
    "cluster_sizes": _cluster_sizes_sql(),
    "integer_centroid_mean": """
SELECT l_returnflag, count(*) AS n_points,
       CAST(sum(CAST(l_quantity AS BIGINT)) // count(*) AS BIGINT) AS m1,
       CAST(sum(CAST(l_linenumber AS BIGINT)) // count(*) AS BIGINT) AS m2
FROM lineitem GROUP BY l_returnflag""",
    "integer_mean_signed": """
SELECT l_linenumber, count(*) AS n_points, CAST(trunc(sum(CAST(l_quantity AS INTEGER) - 26) / count(*)) AS BIGINT) AS m1,
       CAST(trunc(sum(CAST(l_quantity AS INTEGER) - 40) / count(*)) AS BIGINT) AS m2
FROM lineitem GROUP BY l_linenumber""",
    "moved_centroids": f"""
WITH {C_ONE_STEP}
SELECT nw.cid AS cluster_id, nw.n AS n_points, {R6('nw.x1')} AS d1, {R6('nw.x2')} AS d2, {R6(_MOVE2)} AS move2
FROM nw JOIN s ON s.cid = nw.cid
WHERE NOT isnan({_MOVE2}) AND {_MOVE2} >= {TOL * TOL!r}""",
    "changed_centroids": f"""
WITH {C_KEYED_STEP}
SELECT id, CAST(cl AS BIGINT) AS cluster_id FROM chg""",
    "relocate_centroids": f"""
WITH {C_KEYED_STEP}
SELECT id, CAST(cl AS BIGINT) AS cluster_id, {R6('x1')} AS d1, {R6('x2')} AS d2 FROM reloc""",
    "gate_on_any_change": f"""
WITH {C_KEYED_STEP}
SELECT id, CAST(cl AS BIGINT) AS cluster_id, {R6('x1')} AS d1, {R6('x2')} AS d2 FROM reloc
WHERE EXISTS (SELECT 1 FROM chg)""",
    "kmeans_fixed_n": loop_sql(C_LONG, C_SEEDS_LONG, FIXED_STEPS, "none", f"""
SELECT cid AS cluster_id, {R6('max(CASE WHEN pos = 0 THEN x END)')} AS d1,
       {R6('max(CASE WHEN pos = 1 THEN x END)')} AS d2, CAST(max(it) AS BIGINT) AS steps
FROM loop WHERE it = (SELECT it FROM last_it) GROUP BY cid"""),
    "kmeans_converged": loop_sql(E_LONG, E_SEEDS_LONG, 100, "tol", f"""
SELECT cid AS cluster_id, CAST(pos AS INTEGER) AS pos, {R6('x')} AS coord, CAST(it AS BIGINT) AS steps
FROM loop WHERE it = (SELECT it FROM last_it)"""),
    "kmeans_labels": loop_sql(E_LONG, E_SEEDS_LONG, 100, "tol", _labels_tail("vec_id") + """
SELECT id AS vec_id, cid AS cluster_id FROM lab"""),
    "kmeans_sizes": loop_sql(E_LONG, E_SEEDS_LONG, 100, "tol", _labels_tail("vec_id") + """
SELECT cid AS cluster_id, count(*) AS n_points FROM lab GROUP BY cid"""),
    "kmeans_keyed": loop_sql(C_LONG, C_KEYED_LONG, 100, "exact", _labels_tail("id", 1) + """
SELECT id, CAST(cid AS BIGINT) AS cluster_id, CAST((SELECT it FROM last_it) AS BIGINT) AS steps FROM lab"""),
}
ORACLE_SQL["vector_mean_udaf"] = ORACLE_SQL["update_centroids"]
