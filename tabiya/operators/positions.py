"""Ply-level operators: theory book, theory exit, per-move loss, post-theory
window, ACL and blunders (S12, J06, J12, W01-W07, P04, P19).

One row per ply. Every window is partitioned by ``game_id``: a game is a
naturally bounded group (a few hundred plies at most), so these windows never
buffer an unbounded group; the per-game results are grouped aggregates on the
same partitioning, so the whole chain needs a single shuffle by game.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalar as S

def _by_game():
    return Window.partitionBy("game_id").orderBy("ply")


def with_player_color(positions: DataFrame, rule: str = "game_parity") -> DataFrame:
    """Fixture rule: the analysed player is White when ``game_id`` is even."""
    if "player_color" in positions.columns:
        return positions
    return positions.withColumn("player_color", F.when(F.col("game_id") % 2 == 0, "white").otherwise("black"))


def build_theory_book(positions: DataFrame, max_ply: int = 15, source_col: str | None = None,
                      games_per_source: int | None = None) -> DataFrame:
    """Distinct position keys of the first ``max_ply`` plies of all games.

    A caller who wants the reference's limit gives ``games_per_source``: then
    only that many games of each source file count (first by game id), by a
    ``row_number() <= N`` that Spark plans with a map-side WindowGroupLimit.
    """
    p = positions.filter(F.col("ply") <= max_ply)
    if source_col is not None and games_per_source is not None:
        games = p.select(source_col, "game_id").distinct()
        w = Window.partitionBy(source_col).orderBy("game_id")
        keep = games.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= games_per_source)
        p = p.join(keep.select("game_id"), "game_id", "left_semi")
    return p.select("pos_key").distinct()


def mark_theory(positions: DataFrame, book: DataFrame, max_ply: int = 30) -> DataFrame:
    """Flag each ply (<= max_ply) whose position key is in the book.

    A left join to the distinct book; AQE turns it into a broadcast hash join
    at run time when the book's measured size is under the broadcast threshold
    and keeps a shuffled join beyond it.
    """
    b = book.select("pos_key").distinct().withColumn("__hit", F.lit(True))
    p = positions.filter(F.col("ply") <= max_ply)
    return p.join(b, "pos_key", "left").withColumn("in_book", F.coalesce(F.col("__hit"), F.lit(False))).drop("__hit")


def theory_exit(positions: DataFrame, book: DataFrame, variant: str = "tolerant") -> DataFrame:
    """W01 (``tolerant``, <=30 plies, exit after two consecutive misses) and
    W02 (``strict``, <=25 plies, stop at the first miss): (game_id, theory_end)."""
    if variant == "strict":
        m = mark_theory(positions, book, 25)
        agg = m.groupBy("game_id").agg(
            F.min(F.when(~F.col("in_book"), F.col("ply"))).alias("first_miss"),
            F.max("ply").alias("last_ply"))
        return agg.select("game_id", F.coalesce(F.col("first_miss") - 1, F.col("last_ply")).cast("int").alias("theory_end"))
    m = mark_theory(positions, book, 30)
    miss = ~F.col("in_book")
    m = m.withColumn("__double_miss", miss & F.coalesce(F.lag(miss).over(_by_game()), F.lit(False)))
    agg = m.groupBy("game_id").agg(
        F.min(F.when(F.col("__double_miss"), F.col("ply"))).alias("break_ply"),
        F.collect_list(F.when(F.col("in_book"), F.col("ply"))).alias("__hits"))
    # last hit before the break: max over hit plies below break_ply
    last_hit = F.array_max(F.filter("__hits", lambda x: F.col("break_ply").isNull() | (x < F.col("break_ply"))))
    return agg.select("game_id", F.coalesce(last_hit, F.lit(0)).cast("int").alias("theory_end"))


def move_losses(positions: DataFrame, on_missing: str = "null", cap: int = 1000) -> DataFrame:
    """P04 + W03: normalised evaluation per ply and the mover's loss.

    ``loss = max(0, (eval_prev - eval_now) * side)`` where side is +1 when the
    analysed player is White; the position before ply 1 evaluates to 0 unless
    a ply-0 row is present. ``loss`` is NULL when either evaluation is NULL.
    """
    p = with_player_color(positions)
    p = p.withColumn("eval", S.normalize_eval("eval_type", "eval_value", cap, on_missing))
    prev = F.lag("eval", 1).over(_by_game())
    first = F.row_number().over(_by_game()) == 1
    p = p.withColumn("eval_prev", F.when(first & (F.col("ply") == 1), F.lit(0.0)).otherwise(prev))
    p = p.withColumn("pos_before", F.coalesce(F.lag("pos_key", 1).over(_by_game()), F.lit("start")))
    side = F.when(F.col("player_color") == "white", F.lit(1.0)).otherwise(F.lit(-1.0))
    own = F.col("mover") == F.col("player_color")
    loss = F.greatest(F.lit(0.0), (F.col("eval_prev") - F.col("eval")) * side)
    return (p.withColumn("is_own", own)
             .withColumn("loss", F.when(own & F.col("eval_prev").isNotNull() & F.col("eval").isNotNull(), loss))
             .filter(F.col("ply") >= 1))


def post_theory_window(losses: DataFrame, exits: DataFrame, window: int = 12, mode: str = "own") -> DataFrame:
    """Plies after the theory exit. ``board`` = next ``window`` plies of the
    board; ``own`` = next ``window`` own moves (own plies alternate, so they are
    the own plies up to ``theory_end + 2*window``)."""
    lp = losses.join(exits, "game_id")
    span = window if mode == "board" else 2 * window
    return lp.filter((F.col("ply") > F.col("theory_end")) & (F.col("ply") <= F.col("theory_end") + span))


def game_acl(window_rows: DataFrame, digits: int | None = 1) -> DataFrame:
    """Mean own loss in the window (NULL if no own move with a loss)."""
    agg = window_rows.groupBy("game_id").agg(F.avg(F.when(F.col("is_own"), F.col("loss"))).alias("acl"))
    if digits is not None:
        agg = agg.withColumn("acl", F.bround("acl", digits))
    return agg


def first_blunder(window_rows: DataFrame, threshold: float = 100.0) -> DataFrame:
    """Earliest own loss above ``threshold`` per game (loss rounded to 0 digits)."""
    b = window_rows.filter(F.col("is_own") & (F.col("loss") > threshold))
    agg = b.groupBy("game_id").agg(F.min_by(F.struct("ply", "pos_before", "loss"), F.col("ply")).alias("b"))
    return agg.select("game_id", F.col("b.ply").alias("ply"), F.col("b.pos_before").alias("pos_before"),
                      F.bround("b.loss", 0).alias("loss"))


def worst_blunder(window_rows: DataFrame, threshold: float = 100.0) -> DataFrame:
    """Largest own loss above ``threshold`` (first ply on ties)."""
    b = window_rows.filter(F.col("is_own") & (F.col("loss") > threshold))
    agg = b.groupBy("game_id").agg(
        F.min_by(F.struct("ply", "pos_before", "loss"), F.struct(-F.col("loss"), F.col("ply"))).alias("b"))
    return agg.select("game_id", F.col("b.ply").alias("ply"), F.col("b.pos_before").alias("pos_before"),
                      F.col("b.loss").alias("loss"))


def post_theory_acl(losses: DataFrame, exits: DataFrame, window: int = 12) -> DataFrame:
    """W04 + W05 in one aggregate per game: (game_id, theory_end, acl_own, acl_board),
    the mean own loss over the next ``window`` own moves and board plies."""
    after = F.col("is_own") & (F.col("ply") > F.col("theory_end"))
    own = F.avg(F.when(after & (F.col("ply") <= F.col("theory_end") + 2 * window), F.col("loss")))
    board = F.avg(F.when(after & (F.col("ply") <= F.col("theory_end") + window), F.col("loss")))
    return losses.join(exits, "game_id").groupBy("game_id", "theory_end").agg(F.bround(own, 1).alias("acl_own"), board.alias("acl_board"))


def blunders_of_weak_games(losses: DataFrame, exits: DataFrame, window: int = 12, threshold: float = 100.0,
                           min_mean_acl: float = 100.0) -> DataFrame:
    """Worst blunder (W07) of the games whose mean post-theory ACL exceeds
    ``min_mean_acl``: both come from one aggregate over each game's window."""
    win = post_theory_window(losses, exits, window, "own").filter("is_own")
    blunder = F.when(F.col("loss") > threshold, F.struct(-F.col("loss"), F.col("ply")))
    agg = win.groupBy("game_id").agg(F.avg("loss").alias("acl"), F.min_by(F.struct("ply", "pos_before", "loss"), blunder).alias("b"))
    return agg.filter((F.col("acl") > min_mean_acl) & F.col("b").isNotNull()).select("game_id", "b.ply", "b.pos_before", "b.loss")


def export_record(blunders: DataFrame, opening_col: str = "opening", fen_col: str = "fen") -> DataFrame:
    """Upload record of a blunder position.

    Needs at least 4 FEN fields (else dropped); exactly 4 -> ' 0 1' appended;
    loss in pawns rounded to 1; chapter name ``Blunder -{pawns}p | {opening[:28]}``;
    minimal PGN block with SetUp before FEN.
    """
    n_fields = F.size(F.split(F.trim(F.col(fen_col)), r"\s+"))
    fen = F.when(n_fields == 4, F.concat(F.col(fen_col), F.lit(" 0 1"))).otherwise(F.col(fen_col))
    out = (blunders.filter(n_fields >= 4).withColumn("fen_full", fen)
                   .withColumn("pawns", F.bround(F.col("loss") / 100.0, 1)))
    chapter = F.concat(F.lit("Blunder -"), F.col("pawns").cast("string"), F.lit("p | "),
                       F.substring(F.coalesce(F.col(opening_col), F.lit("")), 1, 28))
    pgn = F.concat(F.lit('[Event "'), chapter, F.lit('"]\n[Site "'), F.col("game_id").cast("string"),
                   F.lit('"]\n[SetUp "1"]\n[FEN "'), F.col("fen_full"), F.lit('"]\n\n*'))
    return out.withColumn("chapter", chapter).withColumn("pgn", pgn)
