"""Theory exit and loss windows on hand-made ply sequences, plus fixture check values."""

from pyspark.sql import functions as F

from tabiya.operators import positions as PO
from tabiya.sources import fixtures as fx

from .conftest import SF01


def _pos(spark, seq, game_id=2):
    rows = [(game_id, i + 1, k, "white" if (i + 1) % 2 == 1 else "black", "cp", v) for i, (k, v) in enumerate(seq)]
    return spark.createDataFrame(rows, "game_id long, ply int, pos_key string, mover string, eval_type string, eval_value int")


def test_theory_exit_patterns(spark):
    book = spark.createDataFrame([("h",)], "pos_key string")
    cases = {
        "hhhh": 4,        # all hits
        "mmhh": 0,        # two misses first
        "mhmm": 2,        # miss-hit-miss-miss
        "hmhmh": 5,       # single misses tolerated
        "hhmmh": 2,       # break at two misses
    }
    for i, (pat, want) in enumerate(cases.items()):
        seq = [(c, 0) for c in pat]
        got = PO.theory_exit(_pos(spark, seq, 2 * i), book).collect()[0]["theory_end"]
        assert got == want, pat
    strict = PO.theory_exit(_pos(spark, [("h", 0), ("m", 0), ("h", 0)], 100), book, "strict").collect()[0]
    assert strict["theory_end"] == 1


def test_worst_blunder_first_on_ties(spark):
    # player White (even game id); own plies 1, 3, 5; evals drop 0 -> -200 twice
    seq = [("a", -200), ("b", -200), ("c", -400), ("d", -400), ("e", -400)]
    pos = _pos(spark, seq, 4)
    book = spark.createDataFrame([("zz",)], "pos_key string")
    win = PO.post_theory_window(PO.move_losses(pos), PO.theory_exit(pos, book), 12, "own")
    wb = PO.worst_blunder(win).collect()[0]
    assert (wb["ply"], wb["loss"]) == (1, 200.0)


def test_fixture_check_values(spark):
    pos = fx.positions(spark, SF01)
    ex = PO.theory_exit(pos, fx.theory_book(pos))
    r = ex.agg(F.count(F.lit(1)).alias("n"), F.sum("theory_end").alias("s"), F.max("theory_end").alias("m"),
               F.sum((F.col("theory_end") == 0).cast("int")).alias("z")).collect()[0]
    assert (r["n"], r["s"], r["m"], r["z"]) == (3200, 17692, 15, 482)
    g = fx.games(spark, SF01).agg(F.count(F.lit(1)).alias("n"), F.count("acl").alias("na"),
                                  F.sum("theory_depth").alias("sd")).collect()[0]
    assert (g["n"], g["na"], g["sd"]) == (10000, 9584, 87068)
