"""DuckDB text of the fixture views and shared feature CTEs for the oracle SQL."""

from __future__ import annotations

import re

from ..sources import fixtures as fx

_GAMES = ("SELECT " + ", ".join(fx.GAMES_EXPRS) +
          " FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k FROM events) e")
_POSITIONS = ("SELECT " + ", ".join(fx.POSITIONS_EXPRS) +
              " FROM (SELECT *, row_number() OVER (PARTITION BY game_id ORDER BY l_shipdate, l_orderkey, "
              "l_linenumber, l_partkey, l_extendedprice) AS ply FROM (SELECT *, l_suppkey * 32 + l_partkey % 32 "
              "AS game_id FROM lineitem) a) b")
_CATALOG = "SELECT " + ", ".join(fx.CATALOG_EXPRS) + " FROM part"
_MESSAGES = ("SELECT " + ", ".join(fx._message_exprs("CAST(DATE '2021-11-01' + CAST(conv_id AS INT) AS DATE)")) +
             " FROM conversations")
_BOOK = ("SELECT DISTINCT pos_key FROM (SELECT pos_key, n, avg(n) OVER (PARTITION BY ply) AS mean FROM "
         "(SELECT ply, pos_key, count(*) AS n FROM positions WHERE ply <= 15 GROUP BY ply, pos_key) c) d WHERE n >= mean")


def acc_sql(x: str, digits: int = 2) -> str:
    return (f"CASE WHEN {x} IS NULL THEN NULL ELSE "
            f"round_even(least(100.0, greatest(0.0, 100.0 * exp(-0.0035 * {x}))), {digits}) END")


def wins_sql(x: str) -> str:
    return f"CASE WHEN {x} > 500 THEN 500.0 ELSE CAST({x} AS DOUBLE) END"


# game features, app variant
_GX = f"""SELECT g.*,
  {acc_sql('acl')} AS acc,
  {wins_sql('acl')} AS acl_w,
  {acc_sql(wins_sql('acl'))} AS acc_game,
  round_even({acc_sql('acl')} * (1 - 0.15 * least(1.0, greatest(0.0, least(CAST(theory_depth AS DOUBLE), 15.0) / 15.0))), 1) AS acc_adj,
  least(1.0, greatest(0.0, theory_depth / 15.0)) AS theory_norm,
  round_even((theory_depth / 15.0) * ({acc_sql('acl')} / 100.0), 4) AS prep_score,
  round_even((theory_depth / 15.0) * (100.0 - {acc_sql('acl')}), 4) AS risk_index,
  coalesce(CAST(theory_depth >= 10 AND {acc_sql('acl')} >= 70 AS INT), 0) AS is_theory_expert,
  coalesce(CAST(theory_depth < 7 AND {acc_sql('acl')} >= 65 AS INT), 0) AS is_feeling_natural,
  coalesce(CAST(theory_depth >= 10 AND {acc_sql('acl')} < 60 AS INT), 0) AS is_critical_point,
  CASE WHEN color = 'white' THEN 1 ELSE 0 END AS color_bin,
  CASE WHEN rating >= 0 AND rating < 1400 THEN 'principiante' WHEN rating >= 1400 AND rating < 1800 THEN 'intermedio'
       WHEN rating >= 1800 AND rating < 5000 THEN 'avanzado' END AS level3,
  (least(3000.0, greatest(500.0, CAST(rating AS DOUBLE))) - 500.0) / 2500.0 AS level_num
FROM games g"""

VIEWS = [  # (name, body) in dependency order
    ("games", _GAMES),
    ("positions", _POSITIONS),
    ("book", _BOOK),
    ("catalog", _CATALOG),
    ("messages", _MESSAGES),
    ("gx", _GX),
]
_DEPS = {"book": {"positions"}, "gx": {"games"}}


def with_views(sql: str) -> str:
    """Prefix ``sql`` with the CTEs of the fixture views it mentions."""
    needed: set[str] = set()
    for name, _ in VIEWS:
        if re.search(rf"\b{name}\b", sql):
            needed.add(name)
    changed = True
    while changed:
        changed = False
        for n in list(needed):
            for d in _DEPS.get(n, ()):
                if d not in needed:
                    needed.add(d)
                    changed = True
    ctes = [f"{name} AS ({body})" for name, body in VIEWS if name in needed]
    sql = sql.strip()
    if not ctes:
        return sql
    if sql[:4].upper() == "WITH":
        return "WITH " + ",\n".join(ctes) + ",\n" + sql[4:].lstrip()
    return "WITH " + ",\n".join(ctes) + "\n" + sql
