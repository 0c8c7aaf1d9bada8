"""Registered queries over the positions view (one row per ply)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators import positions as PO
from ..sources import fixtures as fx
from .registry import finalize, register

_EXIT_SQL = """
mk AS (SELECT p.*, (b.pos_key IS NOT NULL) AS in_book FROM positions p LEFT JOIN book b USING (pos_key) WHERE p.ply <= 30),
mk2 AS (SELECT *, (NOT in_book) AND coalesce(lag(NOT in_book) OVER (PARTITION BY game_id ORDER BY ply), false) AS dmiss FROM mk),
br AS (SELECT game_id, min(CASE WHEN dmiss THEN ply END) AS break_ply FROM mk2 GROUP BY game_id),
ex AS (SELECT mk2.game_id, CAST(coalesce(max(CASE WHEN in_book AND (break_ply IS NULL OR ply < break_ply) THEN ply END), 0) AS INT)
       AS theory_end FROM mk2 JOIN br USING (game_id) GROUP BY mk2.game_id)"""


def _loss_sql(missing: str = "NULL") -> str:
    return f"""
ev AS (SELECT *, CASE WHEN game_id % 2 = 0 THEN 'white' ELSE 'black' END AS player_color,
   CASE WHEN eval_value IS NULL OR eval_type IS NULL THEN {missing}
        ELSE coalesce(CASE WHEN eval_type = 'mate' THEN CASE WHEN eval_value > 0 THEN 1000.0 ELSE -1000.0 END
                           WHEN eval_type = 'cp' THEN greatest(-1000.0, least(1000.0, CAST(eval_value AS DOUBLE))) END, {missing}) END AS eval
   FROM positions),
ls AS (SELECT *, CASE WHEN row_number() OVER w = 1 AND ply = 1 THEN 0.0 ELSE lag(eval) OVER w END AS eval_prev,
   coalesce(lag(pos_key) OVER w, 'start') AS pos_before FROM ev WINDOW w AS (PARTITION BY game_id ORDER BY ply)),
ls2 AS (SELECT *, mover = player_color AS is_own,
   CASE WHEN mover = player_color AND eval_prev IS NOT NULL AND eval IS NOT NULL
        THEN greatest(0.0, (eval_prev - eval) * CASE WHEN player_color = 'white' THEN 1.0 ELSE -1.0 END) END AS loss
   FROM ls WHERE ply >= 1)"""


def _book(spark, sf):
    return fx.theory_book(fx.positions(spark, sf))


@register("s12_theory_book_build", "SELECT DISTINCT pos_key FROM positions WHERE ply <= 15")
def s12(spark, sf):
    return PO.build_theory_book(fx.positions(spark, sf), 15)


@register("j06_theory_membership", """
SELECT p.game_id, p.ply, (b.pos_key IS NOT NULL) AS in_book FROM positions p LEFT JOIN book b USING (pos_key) WHERE p.ply <= 30""")
def j06(spark, sf):
    return PO.mark_theory(fx.positions(spark, sf), _book(spark, sf)).select("game_id", "ply", "in_book")


@register("w01_theory_exit_tolerant", f"WITH {_EXIT_SQL} SELECT game_id, theory_end FROM ex")
def w01(spark, sf):
    return PO.theory_exit(fx.positions(spark, sf), _book(spark, sf), "tolerant")


@register("w02_theory_exit_strict", """
WITH mk AS (SELECT p.*, (b.pos_key IS NOT NULL) AS in_book FROM positions p LEFT JOIN book b USING (pos_key) WHERE p.ply <= 25)
SELECT game_id, CAST(coalesce(min(CASE WHEN NOT in_book THEN ply END) - 1, max(ply)) AS INT) AS theory_end FROM mk GROUP BY game_id""")
def w02(spark, sf):
    return PO.theory_exit(fx.positions(spark, sf), _book(spark, sf), "strict")


@register("p04_w03_move_losses", f"""WITH {_loss_sql()}
SELECT game_id, ply, eval, eval_prev, is_own, loss, pos_before FROM ls2""")
def w03(spark, sf):
    l = PO.move_losses(fx.positions(spark, sf))
    return finalize(l.select("game_id", "ply", "eval", "eval_prev", "is_own", "loss", "pos_before"))


@register("p18_loss_class", f"""WITH {_loss_sql()}
SELECT game_id, ply, CASE WHEN loss > 200 THEN 'severe' ELSE 'normal' END AS loss_class FROM ls2 WHERE loss IS NOT NULL""")
def p18_loss(spark, sf):
    l = PO.move_losses(fx.positions(spark, sf)).filter(F.col("loss").isNotNull())
    return l.select("game_id", "ply", S.loss_class("loss").alias("loss_class"))


@register("w04_w05_post_theory_acl", f"""WITH {_EXIT_SQL}, {_loss_sql()},
own AS (SELECT ls2.*, theory_end FROM ls2 JOIN ex USING (game_id) WHERE ply > theory_end AND ply <= theory_end + 24),
brd AS (SELECT ls2.*, theory_end FROM ls2 JOIN ex USING (game_id) WHERE ply > theory_end AND ply <= theory_end + 12),
a1 AS (SELECT game_id, round_even(avg(CASE WHEN is_own THEN loss END), 1) AS acl_own FROM own GROUP BY game_id),
a2 AS (SELECT game_id, round(avg(CASE WHEN is_own THEN loss END), 8) AS acl_board FROM brd GROUP BY game_id)
SELECT ex.game_id, theory_end, acl_own, acl_board FROM ex LEFT JOIN a1 USING (game_id) LEFT JOIN a2 USING (game_id)""")
def w04(spark, sf):
    pos, book = fx.positions(spark, sf), _book(spark, sf)
    return finalize(PO.post_theory_acl(PO.move_losses(pos), PO.theory_exit(pos, book)))


@register("w06_first_blunder", f"""WITH {_EXIT_SQL}, {_loss_sql('0.0')},
brd AS (SELECT ls2.* FROM ls2 JOIN ex USING (game_id) WHERE ply > theory_end AND ply <= theory_end + 12 AND is_own AND loss > 100)
SELECT game_id, ply, pos_before, round_even(loss, 0) AS loss FROM
  (SELECT *, row_number() OVER (PARTITION BY game_id ORDER BY ply) AS rn FROM brd) WHERE rn = 1""")
def w06(spark, sf):
    pos, book = fx.positions(spark, sf), _book(spark, sf)
    win = PO.post_theory_window(PO.move_losses(pos, "zero"), PO.theory_exit(pos, book), 12, "board")
    return finalize(PO.first_blunder(win))


_W07_SQL = f"""{_EXIT_SQL}, {_loss_sql()},
own AS (SELECT ls2.* FROM ls2 JOIN ex USING (game_id) WHERE ply > theory_end AND ply <= theory_end + 24 AND is_own AND loss > 100),
wb AS (SELECT game_id, ply, pos_before, loss FROM
  (SELECT *, row_number() OVER (PARTITION BY game_id ORDER BY loss DESC, ply) AS rn FROM own) WHERE rn = 1)"""


@register("w07_worst_blunder", f"WITH {_W07_SQL} SELECT * FROM wb")
def w07(spark, sf):
    pos, book = fx.positions(spark, sf), _book(spark, sf)
    win = PO.post_theory_window(PO.move_losses(pos), PO.theory_exit(pos, book), 12, "own")
    return finalize(PO.worst_blunder(win))


@register("j12_weak_game_blunders", f"""WITH {_EXIT_SQL}, {_loss_sql()},
ownw AS (SELECT ls2.* FROM ls2 JOIN ex USING (game_id) WHERE ply > theory_end AND ply <= theory_end + 24),
acl AS (SELECT game_id, avg(CASE WHEN is_own THEN loss END) AS acl FROM ownw GROUP BY game_id),
own AS (SELECT * FROM ownw WHERE is_own AND loss > 100 AND game_id IN (SELECT game_id FROM acl WHERE acl > 100))
SELECT game_id, ply, pos_before, loss FROM
  (SELECT *, row_number() OVER (PARTITION BY game_id ORDER BY loss DESC, ply) AS rn FROM own) WHERE rn = 1""")
def j12(spark, sf):
    pos, book = fx.positions(spark, sf), _book(spark, sf)
    return finalize(PO.blunders_of_weak_games(PO.move_losses(pos), PO.theory_exit(pos, book)))


@register("p19_position_export", f"""WITH {_W07_SQL},
fx AS (SELECT game_id, loss, concat_ws(' ', pos_before, CASE WHEN ply % 2 = 1 THEN 'w' ELSE 'b' END, '-', '-') AS fen,
   {fx.opening_case('game_id % 12')} AS opening FROM wb),
r AS (SELECT *, CASE WHEN len(string_split_regex(trim(fen), '\\s+')) = 4 THEN fen || ' 0 1' ELSE fen END AS fen_full,
   round_even(loss / 100.0, 1) AS pawns FROM fx WHERE len(string_split_regex(trim(fen), '\\s+')) >= 4)
SELECT game_id, fen_full, pawns, 'Blunder -' || CAST(pawns AS VARCHAR) || 'p | ' || substr(opening, 1, 28) AS chapter FROM r""")
def p19(spark, sf):
    pos, book = fx.positions(spark, sf), _book(spark, sf)
    win = PO.post_theory_window(PO.move_losses(pos), PO.theory_exit(pos, book), 12, "own")
    wb = PO.worst_blunder(win)
    wb = (wb.withColumn("fen", F.concat_ws(" ", "pos_before", F.when(F.col("ply") % 2 == 1, "w").otherwise("b"),
                                           F.lit("-"), F.lit("-")))
            .withColumn("opening", F.expr(fx.opening_case("game_id % 12"))))
    return finalize(PO.export_record(wb).select("game_id", "fen_full", "pawns", "chapter"))
