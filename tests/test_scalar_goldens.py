"""Hand-computed goldens for the scalar operators (edges of SURVEY 1.5)."""

import math

from pyspark.sql import functions as F

from tabiya.functions import scalar as S


def _one(spark, expr, schema, rows):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(expr).collect()]


def test_accuracy_null_and_curve(spark):
    out = _one(spark, S.accuracy("acl", 2), "acl double", [(None,), (0.0,), (100.0,), (-5.0,)])
    assert out[0] is None
    assert out[1] == 100.0
    assert out[2] == round(100 * math.exp(-0.35), 2)
    assert out[3] == 100.0  # clipped at 100


def test_winsorize_keeps_null(spark):
    assert _one(spark, S.winsorize("acl"), "acl double", [(None,), (600.0,), (20.0,)]) == [None, 500.0, 20.0]


def test_rating_bins_edges(spark):
    rows = [(1000,), (1001,), (1200,), (2400,), (2401,), (0,)]
    nine = _one(spark, S.bin_right_closed("r", S.BINS_9, S.LABELS_9), "r int", rows)
    assert nine == ["beginner_low", "beginner_high", "beginner_high", "expert_1", "expert_2", None]
    three = _one(spark, S.bin_left_closed("r"), "r int", [(1399,), (1400,), (1800,), (5000,)])
    assert three == ["principiante", "intermedio", "avanzado", None]


def test_rule_group_gap(spark):
    out = _one(spark, S.rule_group("r"), "r double", [(1399.0,), (1399.5,), (1400.0,), (2000.0,)])
    assert out == ["principiante", "avanzado", "intermedio", "avanzado"]
    strict = _one(spark, S.rule_group("r", strict=True), "r double", [(1399.5,)])
    assert strict == ["principiante"]


def test_eval_normalisation_mate_zero(spark):
    rows = [("mate", 0), ("mate", 3), ("mate", -2), ("cp", 1500), ("cp", -40), ("cp", None)]
    out = _one(spark, S.normalize_eval("t", "v"), "t string, v int", rows)
    assert out == [-1000.0, 1000.0, -1000.0, 1000.0, -40.0, None]
    zero = _one(spark, S.normalize_eval("t", "v", on_missing="zero"), "t string, v int", [("cp", None)])
    assert zero == [0.0]


def test_base_opening_and_search_query(spark):
    rows = [("Sicilian Defense: Najdorf, English Attack",), (None,)]
    assert _one(spark, S.base_opening("o"), "o string", rows) == ["Sicilian Defense", "Desconocida"]
    q = _one(spark, S.search_query("o"), "o string", [("Sicilian Defense: Najdorf Variation",)])
    assert q == ["najdorf"]


def test_flags_null_is_zero(spark):
    df = spark.createDataFrame([(12, None), (12, 75.0), (3, 80.0)], "t int, acc double")
    flags = S.flag_exprs_null_false(S.game_flags("t", F.col("acc")))
    got = df.select(*[v.alias(k) for k, v in flags.items()]).collect()
    assert [tuple(r) for r in got] == [(0, 0, 0), (1, 0, 0), (0, 1, 0)]
