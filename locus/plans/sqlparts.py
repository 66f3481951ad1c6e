"""Shared pieces of the oracle SQL (DuckDB dialect, tables pre-registered).

Each oracle restates a query from the base tables, independently of the
Spark code: fixtures as CTEs, iterative operators as recursive CTEs whose
state is a list of centres.
"""

from __future__ import annotations

K_MIN, K_MAX = 5, 20
MAX_ITER = 100

PT = """pt AS (
  SELECT CAST(row_number() OVER (ORDER BY x, y, p_partkey) AS BIGINT) AS point_id, x, y
  FROM (SELECT p_partkey, CAST(CAST(p_size * 1000 AS BIGINT) AS DOUBLE) AS x,
               CAST(CAST(round((p_retailprice - 900) * 500) AS BIGINT) AS DOUBLE) AS y
        FROM part) d)"""

# The distinct points, under the same name.
PTD = """pt AS (
  SELECT CAST(row_number() OVER (ORDER BY x, y) AS BIGINT) AS point_id, x, y
  FROM (SELECT DISTINCT CAST(CAST(p_size * 1000 AS BIGINT) AS DOUBLE) AS x,
               CAST(CAST(round((p_retailprice - 900) * 500) AS BIGINT) AS DOUBLE) AS y
        FROM part) d)"""

LTW = """ltw AS (
  SELECT CAST(row_number() OVER (ORDER BY x, y) AS BIGINT) AS point_id, x, y, w
  FROM (SELECT CAST(CAST(l_quantity * 1000 AS BIGINT) AS DOUBLE) AS x,
               CAST(CAST(floor(l_extendedprice) AS BIGINT) AS DOUBLE) AS y,
               count(*) AS w
        FROM lineitem GROUP BY 1, 2) d)"""


def spread_init(src: str, k_min: int, k_max: int, name: str = "init") -> str:
    """Centres 1 + floor(i*n/k) of ``src`` for every k, as lists {c, x, y}."""
    return f"""{name} AS (
  SELECT g.k, list({{'c': g.i + 1, 'x': p.x, 'y': p.y}} ORDER BY g.i) AS cs
  FROM (SELECT r.k, s.i FROM range({k_min}, {k_max + 1}) r(k), range(0, {k_max}) s(i)
        WHERE s.i < r.k) g,
       (SELECT count(*) AS n FROM {src}) n, {src} p
  WHERE p.point_id = 1 + (g.i * n.n) // g.k
  GROUP BY g.k)"""


def random_init(src: str, k_min: int, k_max: int, seed: int, name: str = "init") -> str:
    """For every k the first k points in the order of md5('<id>:<seed>'), as lists {c, x, y}."""
    return f"""{name} AS (
  SELECT g.k, list({{'c': d.c, 'x': d.x, 'y': d.y}} ORDER BY d.c) AS cs
  FROM range({k_min}, {k_max + 1}) g(k),
       (SELECT row_number() OVER (ORDER BY md5(CAST(point_id AS VARCHAR) || ':{seed}'), point_id) AS c, x, y
        FROM {src}) d
  WHERE d.c <= g.k
  GROUP BY g.k)"""


NEAREST = ("list_sort(list_transform({cs}, lambda u: {{'d': (p.x - u.x) * (p.x - u.x) "
           "+ (p.y - u.y) * (p.y - u.y), 'c': u.c, 'x': u.x, 'y': u.y}}))[1]")


def nearest(cs: str) -> str:
    """Struct {d, c, x, y} of the nearest centre in list ``cs`` to point ``p``."""
    return NEAREST.format(cs=cs)


def kmeans_rec(src: str, init: str, max_iter: int = MAX_ITER, weight: str | None = None,
               name: str = "km") -> str:
    """Recursive CTE ``name(k, it, cs, done)``: Lloyd rounds for every k at once."""
    w = f"p.{weight}" if weight else "1"
    return f"""{name}(k, it, cs, done) AS (
  SELECT k, 0, cs, false FROM {init}
  UNION ALL
  SELECT q.k, q.it + 1, q.ncs,
         len(q.ncs) = len(q.cs) AND list_bool_and(list_transform(list_zip(q.cs, q.ncs),
           lambda z: sqrt((z[1].x - z[2].x) * (z[1].x - z[2].x)
                          + (z[1].y - z[2].y) * (z[1].y - z[2].y)) <= 1e-6))
  FROM (
    SELECT a.k, a.it, a.cs,
           list({{'c': a.c, 'x': a.sx / a.sw, 'y': a.sy / a.sw}} ORDER BY a.c) AS ncs
    FROM (
      SELECT s.k, s.it, s.cs, {nearest('s.cs')}.c AS c,
             sum(p.x * {w}) AS sx, sum(p.y * {w}) AS sy, sum({w}) AS sw
      FROM {name} s, {src} p
      WHERE NOT s.done AND s.it < {max_iter}
      GROUP BY s.k, s.it, s.cs, c) a
    GROUP BY a.k, a.it, a.cs) q)"""


def kmeans_final(rec: str = "km", name: str = "kmf") -> str:
    """Last state per k: (k, it, cs, done)."""
    return f"""{name} AS (
  SELECT s.k, s.it, s.cs, s.done FROM {rec} s
  JOIN (SELECT k, max(it) AS it FROM {rec} GROUP BY k) m ON s.k = m.k AND s.it = m.it)"""


def kcenter_rec(src: str, k_max: int, first_sql: str = "1", name: str = "kc") -> str:
    """Recursive CTE ``name(i, pid, x, y, d2, used)``: farthest-first traversal."""
    return f"""{name}(i, pid, x, y, d2, used) AS (
  SELECT 1, point_id, x, y, 0.0::DOUBLE, [{{'x': x, 'y': y}}] FROM {src} WHERE point_id = {first_sql}
  UNION ALL
  SELECT i + 1, nx.pid, nx.x, nx.y, nx.d2, list_append(used, {{'x': nx.x, 'y': nx.y}})
  FROM (
    SELECT c.i, c.used,
           arg_max({{'pid': p.point_id, 'x': p.x, 'y': p.y,
                    'd2': list_min(list_transform(c.used, lambda u: (p.x - u.x) * (p.x - u.x)
                                                        + (p.y - u.y) * (p.y - u.y)))}},
                   {{'d': list_min(list_transform(c.used, lambda u: (p.x - u.x) * (p.x - u.x)
                                                        + (p.y - u.y) * (p.y - u.y))),
                    'n': -p.point_id}}) AS nx
    FROM {name} c, {src} p
    WHERE c.i < {k_max}
    GROUP BY c.i, c.used) t
  WHERE nx.d2 > 0)"""


def with_recursive(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n"
