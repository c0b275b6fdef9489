"""DuckDB twins of the registered queries (same column names, types and values).

Plain SQL over the parquet views, as the correctness check.  Loops become recursive CTEs and
sums of plain numbers DuckDB's own decimal sums.  Three things are shared with the library: the
fixed values of the queries, the keyed draw, and the 6-decimal snap of float means.
"""

from __future__ import annotations

from lumen.functions.draws import sql_keyed_uniform as U
from lumen.functions.numeric import sql_snap as S
from lumen.plans import queries as Q

EPOCH = f"TIMESTAMP '{Q.EPOCH}'"
HOURS = f"floor(date_diff('microsecond', {EPOCH}, ts) / 3600000000.0)::BIGINT"
K = Q.JOURNEY_HOPS


#: 2^75: times this, the tables' amounts are whole numbers, which HUGEINT sums exactly.
SCALE = float(1 << 75)


def _dsum(col: str) -> str:
    return f"(CAST(sum(CAST({col} * {SCALE:.1f}::DOUBLE AS HUGEINT)) AS DOUBLE) / {SCALE:.1f}::DOUBLE)"


def _davg(col: str) -> str:
    return f"({_dsum(col)} / count({col}))"


def _mean_vectors(where: str = "") -> str:
    """CTEs x and m: each label's mean vector over as many dimensions as its vectors have."""
    return f"""x AS (
  SELECT label, i, avg(embedding[i]::DOUBLE) AS m
  FROM (SELECT label, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings {where})
  GROUP BY label, i
), m AS (SELECT label, list(m ORDER BY i) AS c FROM x GROUP BY label)"""


def _dist2(a: str, b: str) -> str:
    return (f"list_reduce(list_transform(range(1, greatest(len({a}), len({b})) + 1), "
            f"lambda k: ({a}[k]::DOUBLE - {b}[k]) * ({a}[k]::DOUBLE - {b}[k])), lambda s, t: s + t)")


JOURNEYS = f"""
WITH RECURSIVE e AS (
  SELECT event_id, user_id, event_type,
         lead(event_id) OVER w AS next_event_id,
         lead(event_type) OVER w AS next_event_type
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
),
j(journey_id, user_id, depth, event_id, active, weight) AS (
  SELECT event_id, user_id, 0, event_id, true, 1.0::DOUBLE FROM events WHERE event_type = 'signup'
  UNION ALL
  SELECT j.journey_id, j.user_id, j.depth + 1,
         CASE WHEN j.depth < {K} THEN e.next_event_id END,
         CASE WHEN j.depth < {K} THEN e.next_event_type <> 'error' ELSE false END,
         CASE WHEN j.depth >= {K} OR e.next_event_type = 'error' THEN 0.0::DOUBLE
              ELSE j.weight * (CASE e.next_event_type WHEN 'view' THEN 0.9::DOUBLE
                                                      WHEN 'purchase' THEN 0.7::DOUBLE
                                                      ELSE 1.0::DOUBLE END) END
  FROM j JOIN e ON e.event_id = j.event_id
  WHERE j.active AND (j.depth >= {K} OR e.next_event_id IS NOT NULL)
)
"""

ORACLES = {
    "journey_trace": JOURNEYS + "SELECT journey_id, depth, event_id, active, weight FROM j",

    "journey_score": JOURNEYS + f"""
, last AS (
  SELECT *, row_number() OVER (PARTITION BY journey_id ORDER BY depth DESC) AS rn FROM j
)
SELECT user_id, count(*) AS n_journeys, {S('avg(weight)')} AS avg_weight, max(depth) AS max_depth
FROM last WHERE rn = 1 GROUP BY user_id
""",

    "cooldown_chain": f"""
WITH RECURSIVE j(journey_id, user_id, depth, event_id, ts, weight, active) AS (
  SELECT event_id, user_id, 0, event_id, ts, 1.0::DOUBLE, true FROM events WHERE event_type = 'signup'
  UNION ALL
  SELECT journey_id, user_id, depth + 1, nxt.event_id, nxt.ts,
         CASE nxt.event_type WHEN 'error' THEN 0.0::DOUBLE ELSE weight * (CASE nxt.event_type WHEN 'view' THEN 0.9::DOUBLE
           WHEN 'purchase' THEN 0.7::DOUBLE ELSE 1.0::DOUBLE END) END,
         nxt.event_type <> 'error' AND depth + 1 < {Q.CHAIN_STEPS}
  FROM (SELECT j.journey_id, j.user_id, j.depth, j.weight,
               min({{'ts': e.ts, 'event_id': e.event_id, 'event_type': e.event_type}}) AS nxt
        FROM j JOIN events e ON e.user_id = j.user_id
         AND e.ts > j.ts + to_seconds((floor((1.0 - j.weight) * 10 + 1e-9)::BIGINT + 1) * {Q.CHAIN_HOUR})
        WHERE j.active GROUP BY j.journey_id, j.user_id, j.depth, j.weight)
)
SELECT journey_id, depth, event_id, {S('weight')} AS weight, active FROM j
""",

    "redraw_until_accept": f"""
WITH RECURSIVE n AS (SELECT max(p_partkey) + 1 AS n FROM part),
d(c_custkey, draws, p_partkey) AS (
  SELECT c_custkey, 1, floor({U('redraw', 'c_custkey', '1')} * n.n)::BIGINT FROM customer CROSS JOIN n
  UNION ALL
  SELECT d.c_custkey, d.draws + 1, floor({U('redraw', 'd.c_custkey', 'd.draws + 1')} * n.n)::BIGINT
  FROM d CROSS JOIN n LEFT JOIN part p ON p.p_partkey = d.p_partkey
  WHERE NOT coalesce(p.p_size <= {Q.REDRAW_MAX_SIZE}, false)
)
SELECT d.c_custkey, d.draws, d.p_partkey
FROM d JOIN part p ON p.p_partkey = d.p_partkey WHERE p.p_size <= {Q.REDRAW_MAX_SIZE}
""",

    "date_spine_counts": """
WITH c AS (SELECT date_trunc('hour', ts) AS h, count(*) AS n FROM events GROUP BY 1),
s AS (SELECT unnest(generate_series((SELECT min(h) FROM c), (SELECT max(h) FROM c), INTERVAL 1 HOUR)) AS h)
SELECT strftime(s.h, '%Y-%m-%d %H:%M:%S') AS hour, coalesce(c.n, 0) AS n_events
FROM s LEFT JOIN c ON c.h = s.h
""",

    "replicate_rows": f"""
SELECT o_orderpriority, CAST(i AS INTEGER) AS instalment, count(*) AS n,
       {S(_dsum('o_totalprice') + f" / {float(Q.INSTALMENTS)}")} AS amount
FROM orders CROSS JOIN range(0, {Q.INSTALMENTS}) t(i)
GROUP BY 1, 2
""",

    "grid_cells": f"""
WITH cells AS (
  SELECT h % 24 AS col, floor(h / 24.0)::BIGINT AS row, count(*) AS n, {S(_davg('value'))} AS avg_value
  FROM (SELECT {HOURS} AS h, value FROM events) GROUP BY 1, 2
)
SELECT col, row, (col + 0.5) / 24.0 AS u, (row + 0.5) / (SELECT max(row) + 1 FROM cells) AS v, n, avg_value
FROM cells
""",

    "keyed_uniform": f"""
SELECT source, floor({U('draw', 'doc_id', 'i')} * 10.0)::BIGINT AS bucket, count(*) AS n
FROM documents CROSS JOIN range(0, {Q.DRAWS_PER_DOC}) t(i)
GROUP BY 1, 2
""",

    "weighted_split": f"""
WITH d AS (
  SELECT doc_id, CASE WHEN u < 0.8 THEN 'train' WHEN u < 0.95 THEN 'valid' ELSE 'test' END AS split
  FROM (SELECT doc_id, {U('split', 'doc_id')} AS u FROM documents)
)
SELECT split, count(*) AS n_docs, count(l.doc_id) AS n_labelled,
       CAST(sum(l.quality) AS DOUBLE) / count(l.doc_id) AS quality_rate
FROM d LEFT JOIN labels l ON l.doc_id = d.doc_id
GROUP BY split
""",

    "default_members_union": f"""
SELECT n_nationkey AS nation_id, n_name AS name, coalesce(r_name, '{Q.DEFAULT_REGION}') AS region_name,
       false AS is_default
FROM nation LEFT JOIN region ON n_regionkey = r_regionkey
UNION ALL
SELECT * FROM (VALUES {", ".join(f"({k}, '{n}', '{Q.DEFAULT_REGION}', true)" for k, n in Q.DEFAULT_MEMBERS)})
  AS t(nation_id, name, region_name, is_default)
""",

    "param_join": f"""
WITH p AS (SELECT {S(_davg('o_totalprice') + f" * {Q.THRESHOLD_FACTOR}")} AS threshold FROM orders)
SELECT o_orderpriority, count(*) AS n_above, max(threshold) AS threshold
FROM orders CROSS JOIN p WHERE o_totalprice > threshold
GROUP BY 1
""",

    "nearest_zone": f"""
WITH {_mean_vectors()},
z AS (
  SELECT m.label AS zone, any_value(m.c) AS c, {S("avg(sqrt(" + _dist2("e.embedding", "m.c") + "))")} AS radius
  FROM embeddings e JOIN m ON m.label = e.label GROUP BY m.label
), d AS (SELECT e.vec_id, z.zone, z.radius, sqrt({_dist2("e.embedding", "z.c")}) AS d FROM embeddings e CROSS JOIN z),
b AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, zone) AS rn FROM d WHERE d <= radius)
SELECT e.vec_id, b.zone, {S("b.d")} AS distance FROM embeddings e LEFT JOIN b ON b.vec_id = e.vec_id AND b.rn = 1
""",

    "nearest_centroid": f"""
WITH {_mean_vectors()},
d AS (SELECT e.vec_id, m.label AS nearest, {_dist2("e.embedding", "m.c")} AS d2 FROM embeddings e CROSS JOIN m),
b AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d2, nearest) AS rn FROM d WHERE d2 IS NOT NULL AND NOT isnan(d2))
SELECT e.label, b.nearest, count(*) AS n FROM embeddings e LEFT JOIN b ON b.vec_id = e.vec_id AND b.rn = 1 GROUP BY 1, 2
""",

    "nearest_supplied_part": f"""
WITH p AS (SELECT p_partkey, p_retailprice AS x, {Q.SIZE_SCALE}::DOUBLE * p_size AS y, {Q.REACH}::DOUBLE + p_size AS reach FROM part),
d AS (SELECT a.p_partkey, min({{'d': sqrt((a.x - e.x) * (a.x - e.x) + (a.y - e.y) * (a.y - e.y)), 'entry': e.p_partkey}}) AS best
      FROM p a JOIN p e ON a.p_partkey % 3 <> 0 AND e.p_partkey % 3 = 0
       AND sqrt((a.x - e.x) * (a.x - e.x) + (a.y - e.y) * (a.y - e.y)) <= e.reach GROUP BY a.p_partkey)
SELECT p.p_partkey, d.best.entry AS entry, {S('d.best.d')} AS distance FROM p LEFT JOIN d USING (p_partkey) WHERE p.p_partkey % 3 <> 0
""",

    "shipments_in_window": """
WITH w AS (SELECT o_custkey, o_orderpriority, o_orderdate::DATE AS day,
                  lead(o_orderdate::DATE) OVER (PARTITION BY o_custkey ORDER BY o_orderdate::DATE, o_orderkey) AS until FROM orders),
s AS (SELECT o_custkey, l_shipdate::DATE AS ship_day FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
SELECT o_orderpriority, count(*) AS n, sum(ship_day - day)::BIGINT AS days, max(until - day)::BIGINT AS longest
FROM s JOIN w ON w.o_custkey = s.o_custkey AND w.day <= s.ship_day AND s.ship_day < w.until GROUP BY 1
""",

    "cheapest_supply": f"""
WITH RECURSIVE s AS (SELECT l_partkey AS part, -1 - l_suppkey AS supplier, min(1 + round(l_discount * 100))::BIGINT AS cost
                     FROM lineitem GROUP BY 1, 2),
e AS (SELECT part AS src, supplier AS dst, cost FROM s UNION ALL SELECT supplier, part, cost FROM s),
r(node, cost, hops) USING KEY (node) AS (
  SELECT -1 - s_suppkey, 0::BIGINT, 0::BIGINT FROM supplier WHERE s_nationkey = {Q.START_NATION}
  UNION
  SELECT o.node, o.best.cost, o.best.hops
  FROM (SELECT e.dst AS node, min({{'cost': r.cost + e.cost, 'hops': r.hops + 1}}) AS best FROM r JOIN e ON e.src = r.node GROUP BY e.dst) o
  LEFT JOIN recurring.r v ON v.node = o.node
  WHERE v.node IS NULL OR o.best < {{'cost': v.cost, 'hops': v.hops}}
)
SELECT node, cost, hops FROM r
""",

    # both loops as one: a row is a draw, and the next row draws again or buys
    "restock_walk": f"""
WITH RECURSIVE n AS (SELECT max(p_partkey) + 1 AS n FROM part),
d(s_suppkey, round, draws, balance, candidate) AS (
  SELECT s_suppkey, 1, 1::BIGINT, s_acctbal, floor({U('restock', 's_suppkey', '1', '1')} * n.n)::BIGINT
  FROM supplier CROSS JOIN n WHERE s_acctbal >= 0
  UNION ALL
  SELECT s_suppkey, round, draws, balance, floor({U('restock', 's_suppkey', 'round', 'draws')} * n)::BIGINT
  FROM (SELECT d.s_suppkey, n.n, CASE WHEN p.p_size <= {Q.REDRAW_MAX_SIZE} THEN d.round + 1 ELSE d.round END AS round,
               CASE WHEN p.p_size <= {Q.REDRAW_MAX_SIZE} THEN 1 ELSE d.draws + 1 END AS draws,
               CASE WHEN p.p_size <= {Q.REDRAW_MAX_SIZE} THEN d.balance - p.p_retailprice ELSE d.balance END AS balance
        FROM d CROSS JOIN n LEFT JOIN part p ON p.p_partkey = d.candidate)
  WHERE balance >= 0 AND round <= {Q.RESTOCK_ROUNDS}
),
b AS (SELECT s_suppkey, round, draws, p_partkey, balance - p_retailprice AS balance
      FROM d JOIN part ON p_partkey = candidate WHERE p_size <= {Q.REDRAW_MAX_SIZE})
SELECT s_suppkey, 0 AS round, NULL::BIGINT AS draws, NULL::BIGINT AS p_partkey, {S('s_acctbal')} AS balance, s_acctbal >= 0 AS active FROM supplier
UNION ALL SELECT s_suppkey, round, draws, p_partkey, {S('balance')}, balance >= 0 AND round < {Q.RESTOCK_ROUNDS} FROM b
""",

    "event_walk": f"""
WITH RECURSIVE e AS (SELECT event_id, user_id, ts, event_type AS kind, floor(value / {Q.VALUE_CLASS})::BIGINT AS class,
                            lead(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS following FROM events),
m AS (SELECT class, max({{'user_id': user_id, 'ts': ts, 'event_id': event_id}}).event_id AS latest FROM e GROUP BY class),
w(walk, depth, event_id, kind, class, active) AS (
  SELECT event_id, 0, event_id, kind, class, true FROM e WHERE kind = 'signup'
  UNION ALL
  SELECT s.walk, s.depth + 1, t.event_id, coalesce(t.kind, 'end'), t.class, t.event_id IS NOT NULL AND s.depth + 1 < {Q.WALK_STEPS}
  FROM (SELECT w.*, w.kind IN ('view', 'signup', 'click', 'purchase') AS goes,
               CASE WHEN w.kind IN ('view', 'signup') THEN e.following WHEN w.kind = 'click' THEN w.event_id + {Q.CLICK_STRIDE} ELSE m.latest END AS next_id
        FROM w LEFT JOIN e ON e.event_id = w.event_id LEFT JOIN m ON m.class = w.class AND w.kind = 'purchase' WHERE w.active) s
  LEFT JOIN e t ON t.event_id = s.next_id AND s.goes
  WHERE NOT s.goes OR t.event_id IS NOT NULL
)
SELECT walk, depth, event_id, kind, active FROM w
""",

    # the same construction by running sums over all items at once
    "supplier_draws": f"""
WITH i AS (SELECT s_suppkey AS item, greatest(round(s_acctbal * 100)::BIGINT, 0) AS weight FROM supplier),
p AS (SELECT item, weight, count(*) OVER () AS n, (sum(weight) OVER ())::BIGINT AS w FROM i WHERE weight > 0),
u AS (SELECT item, n * weight AS units, n, w FROM p),
l AS (SELECT item, w - units AS gap, (sum(w - units) OVER (ORDER BY item))::BIGINT - (w - units) AS gap_at, row_number() OVER (ORDER BY item) - 1 AS slot
      FROM u WHERE units <= w),
h AS (SELECT item, (sum(units - w) OVER (ORDER BY item))::BIGINT AS high, row_number() OVER (ORDER BY item) AS rank, lead(item) OVER (ORDER BY item) AS next,
             (sum(units - w) OVER (ORDER BY item))::BIGINT - (units - w) AS low FROM u WHERE units > w),
s AS (
  SELECT slot, (SELECT any_value(w) FROM u) - gap AS own, l.item, CASE WHEN gap = 0 THEN l.item ELSE h.item END AS other
  FROM l LEFT JOIN h ON h.low <= l.gap_at AND l.gap_at < h.high
  UNION ALL
  SELECT (SELECT count(*) FROM l) + rank - 1, (SELECT any_value(w) FROM u) - coalesce((SELECT min(gap_at + gap) FROM l WHERE gap_at < high AND high < gap_at + gap) - high, 0),
         item, coalesce(next, item) FROM h),
o AS (SELECT o_orderkey, floor({U('supplier', 'o_orderkey', "'slot'")} * (SELECT any_value(n) FROM u))::BIGINT AS slot,
             {U('supplier', 'o_orderkey', "'unit'")} * (SELECT any_value(w) FROM u)::DOUBLE AS unit FROM orders)
SELECT CASE WHEN unit < own THEN item ELSE other END AS s_suppkey, count(*) AS n_orders, min(o_orderkey) AS first_order
FROM o JOIN s USING (slot) GROUP BY 1
""",

    "instalment_plan": f"""
WITH RECURSIVE r(o_orderkey, instalment, cents) AS (
  SELECT o_orderkey, 0, round(o_totalprice * 100)::BIGINT FROM orders
  UNION ALL
  SELECT o_orderkey, instalment + 1, cents - least(cents, greatest(cents // 4, {Q.LEAST_INSTALMENT})) FROM r WHERE cents > 0
)
SELECT o_orderkey, instalment, cents FROM r
""",

    "document_folds": f"""
WITH RECURSIVE n AS (SELECT count(*) AS n, (ceil(sqrt(count(*))))::BIGINT AS a FROM documents),
s AS (SELECT n, a, (n + a - 1) // a AS b FROM n),
p(doc_id, x, walks) AS (
  SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1, 0 FROM documents
  UNION ALL
  SELECT doc_id, r3 * b + c4, walks + 1 FROM (
    SELECT *, (c2 + floor({U('folds', '3', 'r3')} * b)::BIGINT) % b AS c4 FROM (
      SELECT *, (r1 + floor({U('folds', '2', 'c2')} * a)::BIGINT) % a AS r3 FROM (
        SELECT *, (c0 + floor({U('folds', '1', 'r1')} * b)::BIGINT) % b AS c2 FROM (
          SELECT *, (x // b + floor({U('folds', '0', 'x % b')} * a)::BIGINT) % a AS r1, x % b AS c0 FROM p, s
          WHERE walks = 0 OR x >= n))))
)
SELECT doc_id, x AS position, floor(x * {Q.FOLDS} / n)::INTEGER AS fold FROM p, s WHERE walks > 0 AND x < n
""",

    "next_event_after": f"""
WITH err AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'error'),
pairs AS (
  SELECT e.event_id, p.event_id AS pid, p.ts AS pts, e.ts,
         row_number() OVER (PARTITION BY e.event_id ORDER BY p.ts, p.event_id) AS rn
  FROM err e JOIN events p ON p.user_id = e.user_id AND p.event_type = 'purchase'
   AND date_diff('microsecond', e.ts, p.ts) > {Q.ERROR_GAP_US}
)
SELECT e.event_id, pairs.pid AS next_event_id, date_diff('microsecond', e.ts, pairs.pts) / 1e6 AS gap_s
FROM err e LEFT JOIN pairs ON pairs.event_id = e.event_id AND pairs.rn = 1
""",

    "latest_per_key": """
SELECT o_custkey, o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_totalprice
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
      FROM orders)
WHERE rn = 1
""",

    "rows_at_group_max": """
WITH m AS (SELECT o_custkey, max(o_orderdate) AS d FROM orders GROUP BY 1)
SELECT o.o_custkey, o.o_orderkey, strftime(o.o_orderdate, '%Y-%m-%d') AS o_orderdate
FROM orders o JOIN m ON o.o_custkey = m.o_custkey AND o.o_orderdate = m.d
""",

    "dedup_by_key": """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey) AS rn
      FROM lineitem)
WHERE rn = 1
""",

    "vec_normalize": f"""
WITH v AS (SELECT vec_id, CAST(embedding[1:{Q.TRUNCATE_DIMS}] AS DOUBLE[]) AS v FROM embeddings),
l AS (SELECT vec_id, v, sqrt(list_reduce(list_transform(v, lambda x: x * x), lambda a, b: a + b)) AS len_before FROM v),
u AS (SELECT vec_id, len_before, CASE WHEN len_before > 0 THEN list_transform(v, lambda x: x / len_before) END AS u FROM l)
SELECT vec_id, {S('len_before')} AS len_before,
       {S('sqrt(list_reduce(list_transform(u, lambda x: x * x), lambda a, b: a + b))')} AS len_after
FROM u
""",

    "frame_vectors": f"""
WITH v AS (SELECT vec_id, CAST(embedding[1:3] AS DOUBLE[]) AS a, CAST(embedding[4:6] AS DOUBLE[]) AS b FROM embeddings),
w AS (
  SELECT *, [a[1] + b[1], a[2] + b[2], a[3] + b[3]] AS s,
         [a[2] * b[3] - a[3] * b[2], a[3] * b[1] - a[1] * b[3], a[1] * b[2] - a[2] * b[1]] AS n,
         sqrt(b[1] * b[1] + b[2] * b[2] + b[3] * b[3]) AS lb FROM v
), u AS (
  SELECT *, sqrt(n[1] * n[1] + n[2] * n[2] + n[3] * n[3]) AS ln,
         CASE WHEN lb > 0 THEN [b[1] / lb, b[2] / lb, b[3] / lb] END AS ub FROM w
), t AS (
  SELECT *, CASE WHEN ln > 0 THEN [n[1] / ln, n[2] / ln, n[3] / ln] END AS un,
         ub[1] * a[1] + ub[2] * a[2] + ub[3] * a[3] AS along FROM u
), o AS (
  SELECT *, CASE WHEN un[1] * a[1] + un[2] * a[2] + un[3] * a[3] < 0 THEN 1.0 ELSE -1.0 END AS side FROM t
)
SELECT vec_id, greatest(abs(s[1]), abs(s[2]), abs(s[3])) < {Q.NEAR_ZERO} AS cancels,
       {", ".join(f"{S(f's[{k}]')} AS s{k}, {S(f'n[{k}]')} AS n{k}, {S(f'side * un[{k}]')} AS o{k}, {S(f'a[{k}] - 2.0::DOUBLE * along * ub[{k}]')} AS m{k}" for k in (1, 2, 3))}
FROM o
""",

    "vec_remove_direction": f"""
WITH {_mean_vectors()},
cl AS (SELECT label, c, sqrt(list_reduce(list_transform(c, lambda x: x * x), lambda a, b: a + b)) AS l FROM m),
nd AS (SELECT label, CASE WHEN l > 0 THEN list_transform(c, lambda x: x / l) END AS n FROM cl),
j AS (
  SELECT e.vec_id, CAST(e.embedding AS DOUBLE[]) AS v, nd.n FROM embeddings e JOIN nd ON nd.label = e.label
), d AS (
  SELECT *, list_reduce(list_transform(range(1, len(v) + 1), lambda k: n[k] * v[k]), lambda a, b: a + b) AS dv FROM j
), w AS (
  SELECT *, list_transform(range(1, len(v) + 1), lambda k: v[k] - (dv * 1.0::DOUBLE) * n[k]) AS w FROM d
)
SELECT vec_id, {S('dv')} AS dot_before,
       {S('list_reduce(list_transform(range(1, len(w) + 1), lambda k: n[k] * w[k]), lambda a, b: a + b)')} AS dot_after,
       {S('sqrt(list_reduce(list_transform(w, lambda x: x * x), lambda a, b: a + b))')} AS len_after,
       dv < 0 AS flipped
FROM w
""",

    "plane_projection": f"""
WITH {_mean_vectors("WHERE label IN (0, 1)")},
c AS (
  SELECT any_value(c) FILTER (WHERE label = 0) AS c0, any_value(c) FILTER (WHERE label = 1) AS c1 FROM m
), b1 AS (
  SELECT c0, c1, sqrt(list_reduce(list_transform(c0, lambda x: x * x), lambda a, b: a + b)) AS l0 FROM c
), b2 AS (SELECT c1, list_transform(c0, lambda x: x / l0) AS e1 FROM b1),
b3 AS (
  SELECT e1, list_transform(range(1, len(c1) + 1),
           lambda k: c1[k] - (list_reduce(list_transform(range(1, len(c1) + 1), lambda m: e1[m] * c1[m]),
                                          lambda a, b: a + b) * 1.0::DOUBLE) * e1[k]) AS r FROM b2
), b4 AS (
  SELECT e1, list_transform(r, lambda x: x / sqrt(list_reduce(list_transform(r, lambda y: y * y), lambda a, b: a + b))) AS e2
  FROM b3
)
SELECT vec_id,
       {S('list_reduce(list_transform(range(1, len(e1) + 1), lambda k: embedding[k]::DOUBLE * e1[k]), lambda a, b: a + b)')} AS along,
       {S('list_reduce(list_transform(range(1, len(e2) + 1), lambda k: embedding[k]::DOUBLE * e2[k]), lambda a, b: a + b)')} AS across
FROM embeddings CROSS JOIN b4
""",

    "linear_blend": f"""
WITH p AS (SELECT p_brand, p_size::DOUBLE AS s, p_retailprice AS pr FROM part),
lim AS (SELECT min(s) AS s0, max(s) AS s1, min(pr) AS p0, max(pr) AS p1 FROM p)
SELECT p_brand,
       {S(f"avg({Q.BLEND[0]}::DOUBLE * CASE WHEN s1 > s0 THEN (s - s0) / (s1 - s0) END + {Q.BLEND[1]}::DOUBLE * CASE WHEN p1 > p0 THEN (pr - p0) / (p1 - p0) END)")} AS avg_score
FROM p CROSS JOIN lim GROUP BY p_brand
""",

    "guarded_metrics": f"""
SELECT c_mktsegment, count(*) AS n, count(*) FILTER (WHERE c_acctbal < 0) AS n_guarded,
       {S('avg(CASE WHEN c_acctbal >= 0 THEN sqrt(c_acctbal) END)')} AS avg_root,
       {S('avg(CASE WHEN c_acctbal > 0 THEN 1000.0::DOUBLE / c_acctbal END)')} AS avg_inverse
FROM customer GROUP BY 1
""",

    "route_and_union": f"""
WITH r AS (
  SELECT CASE event_type WHEN 'purchase' THEN 'purchase' WHEN 'view' THEN 'view' WHEN 'click' THEN 'click'
              ELSE 'other' END AS route,
         CASE event_type WHEN 'purchase' THEN value * 0.7::DOUBLE WHEN 'view' THEN value * 0.01::DOUBLE
                         WHEN 'click' THEN 0.05::DOUBLE ELSE 0.0::DOUBLE END AS amount
  FROM events
)
SELECT route, count(*) AS n, {S(_dsum('amount'))} AS total FROM r GROUP BY route
""",

    "group_averages": f"""
WITH o AS (
  SELECT l_returnflag, l_orderkey, {_davg('l_quantity')} AS q, {_davg('l_extendedprice')} AS p,
         {_davg('l_discount')} AS d
  FROM lineitem GROUP BY 1, 2
)
SELECT l_returnflag, {S('avg(q)')} AS avg_qty, {S('avg(p)')} AS avg_price, {S('avg(d)')} AS avg_disc
FROM o GROUP BY 1
""",

    "quantize_histogram": f"""
WITH m AS (SELECT max(l_extendedprice) AS mx FROM lineitem)
SELECT CASE WHEN l_extendedprice >= 0 AND mx > 0 THEN floor(sqrt(l_extendedprice / mx) * {float(Q.QUANT_LEVELS)})::BIGINT END AS level,
       count(*) AS n
FROM lineitem CROSS JOIN m GROUP BY 1
""",

    "cyclic_piecewise": f"""
WITH p AS (SELECT event_type, (hour(ts) + minute(ts) / 60.0) / 4.0 AS h FROM events),
d AS (SELECT event_type, least(abs(h), 6.0 - abs(h)) AS a, least(abs(h - 2.0), 6.0 - abs(h - 2.0)) AS b,
             least(abs(h - 4.0), 6.0 - abs(h - 4.0)) AS c FROM p)
SELECT event_type, {", ".join(S(f"avg({Q.WAVE[0]}::DOUBLE + ({Q.WAVE[1]}::DOUBLE - {Q.WAVE[0]}::DOUBLE) * greatest(0.0, least(1.0, 2.0 - {x})))") + f" AS {x}" for x in "abc")}
FROM d GROUP BY 1
""",

    "parity_cells": f"""
SELECT CASE WHEN (floor({HOURS} / 6.0)::BIGINT + user_id) % 2 = 0 THEN 'A' ELSE 'B' END AS arm,
       count(*) AS n, {S(_davg('value'))} AS avg_value
FROM events GROUP BY 1
""",

    "ordered_documents": """
SELECT conv_id, count(*) AS n_turns, string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS transcript
FROM conversations GROUP BY conv_id
""",

    "framed_export": f"""
SELECT 0::BIGINT AS line_no, '{"|".join(Q.NATION_COLUMNS)}' AS line
UNION ALL
SELECT row_number() OVER (ORDER BY n_nationkey) AS line_no, concat_ws('|', {", ".join(Q.NATION_COLUMNS)}) AS line
FROM nation
""",

    "lineitem_export": """
WITH t AS (SELECT l_orderkey, l_linenumber, concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, strftime(l_shipdate, '%Y-%m-%d')) AS line FROM lineitem)
SELECT row_number() OVER o - 1 AS line_no, (sum(strlen(line) + 1) OVER o)::BIGINT - (strlen(line) + 1) AS byte_start, line
FROM t WINDOW o AS (ORDER BY l_orderkey, l_linenumber, line ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
""",
}
