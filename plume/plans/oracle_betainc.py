"""Regularized incomplete beta in DuckDB SQL, for the p-value oracles.

The continued fraction (modified Lentz) as a recursive CTE: one row per
iteration, values frozen once the step converges.  ``functions/stats_math.py``
uses a series of positive terms near the centre instead; independent values
(closed forms, the normal limit) are in the unit tests.
"""

from __future__ import annotations

_TINY = "1e-300"
_EPS = "1e-15"
_MAX_ITER = 400


def _guard(v: str) -> str:
    return f"(CASE WHEN abs({v}) > {_TINY} THEN {v} ELSE {_TINY} END)"


def betainc_ctes(src: str, name: str) -> str:
    """CTEs computing ``{name}(id, ix)`` = I_x(a, b) for rows ``{src}(id, a, b, x)``.

    Needs ``WITH RECURSIVE``.  For x < (a+1)/(a+b+2) the fraction is
    evaluated at (a, b, x), otherwise at (b, a, 1-x) and complemented.
    """
    return f"""
{name}_s0 AS (
  SELECT id, CAST(a AS DOUBLE) AS a, CAST(b AS DOUBLE) AS b, CAST(x AS DOUBLE) AS x FROM {src}
),
{name}_in AS (
  SELECT id, a, b, x, x < (a + 1.0) / (a + b + 2.0) AS direct,
         CASE WHEN x < (a + 1.0) / (a + b + 2.0) THEN a ELSE b END AS pa,
         CASE WHEN x < (a + 1.0) / (a + b + 2.0) THEN b ELSE a END AS pb,
         CASE WHEN x < (a + 1.0) / (a + b + 2.0) THEN x ELSE 1.0 - x END AS px
  FROM {name}_s0 WHERE x > 0.0 AND x < 1.0
),
{name}_cf(id, m, c, d, h, done) AS (
  SELECT id, 0, CAST(1.0 AS DOUBLE), 1.0 / {_guard('1.0 - (pa + pb) * px / (pa + 1.0)')},
         1.0 / {_guard('1.0 - (pa + pb) * px / (pa + 1.0)')}, false
  FROM {name}_in
  UNION ALL
  SELECT s.id, s.m + 1, s2.c2, s2.d2, s2.h2, s2.done2
  FROM {name}_cf s JOIN {name}_in i ON s.id = i.id,
  LATERAL (
    SELECT
      CASE WHEN s.done THEN s.c ELSE c2b END AS c2,
      CASE WHEN s.done THEN s.d ELSE d2b END AS d2,
      CASE WHEN s.done THEN s.h ELSE h1 * d2b * c2b END AS h2,
      s.done OR abs(d2b * c2b - 1.0) < {_EPS} AS done2
    FROM (
      SELECT d1, c1, h1,
        1.0 / {_guard('1.0 + aa2 * d1')} AS d2b,
        {_guard('1.0 + aa2 / c1')} AS c2b
      FROM (
        SELECT
          1.0 / {_guard('1.0 + aa1 * s.d')} AS d1,
          {_guard('1.0 + aa1 / s.c')} AS c1,
          s.h * (1.0 / {_guard('1.0 + aa1 * s.d')}) * {_guard('1.0 + aa1 / s.c')} AS h1,
          aa2
        FROM (
          SELECT (s.m + 1) * (i.pb - (s.m + 1)) * i.px
                   / ((i.pa - 1.0 + 2 * (s.m + 1)) * (i.pa + 2 * (s.m + 1))) AS aa1,
                 -(i.pa + (s.m + 1)) * (i.pa + i.pb + (s.m + 1)) * i.px
                   / ((i.pa + 2 * (s.m + 1)) * (i.pa + 1.0 + 2 * (s.m + 1))) AS aa2
        )
      )
    )
  ) s2
  WHERE s.m < {_MAX_ITER} AND NOT s.done
),
{name}_last AS (
  SELECT id, arg_max(h, m) AS h FROM {name}_cf GROUP BY id
),
{name} AS (
  SELECT s.id,
    CASE WHEN s.x <= 0.0 THEN 0.0 WHEN s.x >= 1.0 THEN 1.0
         WHEN i.direct THEN exp(lgamma(s.a + s.b) - lgamma(s.a) - lgamma(s.b) + s.a * ln(s.x) + s.b * ln(1.0 - s.x))
                            * l.h / s.a
         ELSE 1.0 - exp(lgamma(s.a + s.b) - lgamma(s.a) - lgamma(s.b) + s.a * ln(s.x) + s.b * ln(1.0 - s.x))
                    * l.h / s.b END AS ix
  FROM {name}_s0 s LEFT JOIN {name}_in i ON s.id = i.id LEFT JOIN {name}_last l ON s.id = l.id
)"""


def _branch(df: str, t: str) -> tuple[str, str, str, str, str]:
    """(x, direct, pa, pb, px) for I_x(df/2, 1/2) at x = df / (df + t^2)."""
    x = f"({df} / ({df} + {t} * {t}))"
    a, b = f"({df} / 2.0)", "0.5"
    direct = f"({x} < ({a} + 1.0) / ({a} + {b} + 2.0))"
    pa = f"(CASE WHEN {direct} THEN {a} ELSE {b} END)"
    pb = f"(CASE WHEN {direct} THEN {b} ELSE {a} END)"
    px = f"(CASE WHEN {direct} THEN {x} ELSE 1.0 - {x} END)"
    return x, direct, pa, pb, px


def t_quantile_ctes(src: str, name: str, q: float = 0.975, steps: int = 200) -> str:
    """CTEs computing ``{name}(id, t)``: the q-quantile of Student's t for rows ``{src}(id, df)``.

    The same search as ``stats_math.t_quantile``: double ``hi`` from 1 while
    the two-sided tail at ``hi`` exceeds 2(1-q), then ``steps`` bisections.
    Each recursion step is one continued-fraction iteration for the current
    point; a converged step also moves the search and starts the fraction
    for the next point.
    """
    target = "(2.0 * (1.0 - CAST(" + repr(q) + " AS DOUBLE)))"
    x, direct, pa, pb, px = _branch("s.df", "s.cur")

    def d0(df: str, t: str) -> str:
        """First Lentz term of the fraction at point t (also the starting h)."""
        _, _, ipa, ipb, ipx = _branch(df, t)
        return f"(1.0 / {_guard(f'1.0 - ({ipa} + {ipb}) * {ipx} / ({ipa} + 1.0)')})"

    m1 = "(s.m + 1)"
    aa1 = f"({m1} * ({pb} - {m1}) * {px} / (({pa} - 1.0 + 2 * {m1}) * ({pa} + 2 * {m1})))"
    aa2 = f"(-({pa} + {m1}) * ({pa} + {pb} + {m1}) * {px} / (({pa} + 2 * {m1}) * ({pa} + 1.0 + 2 * {m1})))"
    a = "(s.df / 2.0)"
    front = (f"exp(lgamma({a} + 0.5) - lgamma({a}) - lgamma(0.5) + {a} * ln({x}) + 0.5 * ln(1.0 - {x}))")
    p2 = f"(CASE WHEN {direct} THEN {front} * st.h2 / {a} ELSE 1.0 - {front} * st.h2 / 0.5 END)"
    hi2 = "(s.hi * 2.0)"
    mid0 = "((s.lo + s.hi) / 2.0)"
    # transition when the fraction for s.cur has converged
    go_on = f"({p2} > {target} AND s.hi < 1e12)"
    new_lo = f"(CASE WHEN s.phase = 1 AND {p2} > {target} THEN s.cur ELSE s.lo END)"
    new_hi = (f"(CASE WHEN s.phase = 0 AND {go_on} THEN {hi2} WHEN s.phase = 1 AND NOT ({p2} > {target}) "
              f"THEN s.cur ELSE s.hi END)")
    new_phase = (f"(CASE WHEN s.phase = 0 AND {go_on} THEN 0 WHEN s.phase = 0 THEN 1 "
                 f"WHEN s.k + 1 >= {steps} THEN 2 ELSE 1 END)")
    new_k = "(CASE WHEN s.phase = 0 THEN 0 ELSE s.k + 1 END)"
    return f"""
{name}_rec(id, df, phase, k, lo, hi, cur, m, c, d, h) AS (
  SELECT id, CAST(df AS DOUBLE), 0, 0, CAST(0.0 AS DOUBLE), CAST(1.0 AS DOUBLE), CAST(1.0 AS DOUBLE), 0,
         CAST(1.0 AS DOUBLE), {d0('CAST(df AS DOUBLE)', '1.0')}, {d0('CAST(df AS DOUBLE)', '1.0')}
  FROM {src} WHERE df > 0
  UNION ALL
  SELECT s.id, s.df, nx.phase, nx.k, nx.lo, nx.hi, nx.cur, nx.m, nx.c, nx.d, nx.h
  FROM {name}_rec s,
  LATERAL (SELECT 1.0 / {_guard(f'1.0 + {aa1} * s.d')} AS d1, {_guard(f'1.0 + {aa1} / s.c')} AS c1) st1,
  LATERAL (SELECT 1.0 / {_guard(f'1.0 + {aa2} * st1.d1')} AS d2, {_guard(f'1.0 + {aa2} / st1.c1')} AS c2) st2,
  LATERAL (SELECT s.h * st1.d1 * st1.c1 * st2.d2 * st2.c2 AS h2,
                  abs(st2.d2 * st2.c2 - 1.0) < {_EPS} OR s.m + 1 >= {_MAX_ITER} AS conv) st,
  LATERAL (SELECT {new_phase} AS phase, {new_k} AS k, {new_lo} AS lo, {new_hi} AS hi) tr,
  LATERAL (
    SELECT
      CASE WHEN st.conv THEN tr.phase ELSE s.phase END AS phase,
      CASE WHEN st.conv THEN tr.k ELSE s.k END AS k,
      CASE WHEN st.conv THEN tr.lo ELSE s.lo END AS lo,
      CASE WHEN st.conv THEN tr.hi ELSE s.hi END AS hi,
      CASE WHEN NOT st.conv THEN s.cur WHEN tr.phase = 0 THEN tr.hi ELSE (tr.lo + tr.hi) / 2.0 END AS cur,
      CASE WHEN st.conv THEN 0 ELSE s.m + 1 END AS m,
      CASE WHEN st.conv THEN CAST(1.0 AS DOUBLE) ELSE st2.c2 END AS c,
      st2.d2 AS d_cont, st.h2 AS h_cont, st.conv AS conv
  ) nx0,
  LATERAL (
    SELECT nx0.phase, nx0.k, nx0.lo, nx0.hi, nx0.cur, nx0.m, nx0.c,
      CASE WHEN nx0.conv THEN {d0('s.df', 'nx0.cur')} ELSE nx0.d_cont END AS d,
      CASE WHEN nx0.conv THEN {d0('s.df', 'nx0.cur')} ELSE nx0.h_cont END AS h
  ) nx
  WHERE s.phase < 2
),
{name} AS (
  SELECT id, (lo + hi) / 2.0 AS t FROM {name}_rec WHERE phase = 2
)"""
