"""Recommender properties: fusion closed form vs the literal fold, exact kNN vs brute force."""

import numpy as np
import pytest

from tabiya.operators import recommend as R
from tabiya.plans.registry import queries

from .conftest import SF001


def _fold(regs):
    score, sources = None, set()
    for src in regs:
        boost = 1.0 if src == "p" else 0.8
        if score is None:
            score = boost
        else:
            score += boost * 0.5
        sources.add(src)
    if len(sources) == 2:
        score = min(score + 0.5, 2.0)
    return score


def test_fusion_closed_form(spark):
    cases = [("p",), ("k",), ("p", "k"), ("p", "p", "k", "k"), ("k", "k", "k"), ("p", "p", "p", "k")]
    rows_p, rows_k = [], []
    for i, regs in enumerate(cases):
        for j, s in enumerate(sorted(regs, key=lambda x: x != "p")):
            (rows_p if s == "p" else rows_k).append((i, f"o{j}", None, f"t{i}"))
    schema = "player int, opening string, url string, title string"
    out = R.fuse_plans(spark.createDataFrame(rows_p, schema), spark.createDataFrame(rows_k, schema)).collect()
    got = {r["player"]: r["score"] for r in out}
    for i, regs in enumerate(cases):
        assert abs(got[i] - _fold(sorted(regs, key=lambda x: x != "p"))) < 1e-12


def test_knn_exact_against_brute_force(spark):
    rng = np.random.default_rng(7)
    x = np.vstack([rng.normal(0, 1, (60, 7)), rng.normal(3, 0.1, (40, 7))])  # one dense clump
    rows = [(i, float(i), [float(v) for v in x[i]]) for i in range(len(x))]
    vec = spark.createDataFrame(rows, "player long, rating_mean double, vec array<double>")
    got = R.knn_neighbours(vec, 5, leaf=8).collect()
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    d = np.round(1 - u @ u.T, 9)
    for i in range(len(x)):
        order = sorted((d[i, j], j) for j in range(len(x)) if j != i)[:5]
        mine = sorted((r["distance"], r["neighbour"]) for r in got if r["player"] == i)
        assert [j for _, j in mine] == [j for _, j in order], i


@pytest.mark.parametrize("query", ["r02_direct_profile_recommender", "r03_neighbour_gap_openings", "r04_plan_fusion"])
def test_games_are_not_read_again_after_the_per_player_tables(spark, query):
    """What several steps read of the games is written once; no later step goes through the events again."""
    plan = queries()[query](spark, SF001)._jdf.queryExecution().optimizedPlan().toString()
    assert "user_id" not in plan
