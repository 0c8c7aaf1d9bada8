"""K-means: starts, cost and indices against plain versions, and the queries' centres against DuckDB."""

import duckdb
import numpy as np
import pytest

from tabiya.operators import kmeans as KM
from tabiya.plans import queries_train as QT

from .conftest import SF001


def _frame(spark, x):
    return spark.createDataFrame([tuple(map(float, r)) for r in x], ", ".join(f"z_{c} double" for c in "abcdef"[:x.shape[1]]))


def _plain_sums(x, centres):
    d = np.sqrt(((x[:, None] - centres[None]) ** 2).sum(2))
    return d.argmin(1), d.min(1)


def test_cost_silhouette_and_davies_bouldin_against_plain_versions(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(c, 0.4, (120, 2)) for c in ((0, 0), (4, 0), (0, 5))] + [np.tile([[4.0, 4.0]], (60, 1))]).round(2)
    pts = KM.points(_frame(spark, x), ["a", "b"])
    assert pts.agg({"w": "sum"}).first()[0] == len(x) and pts.count() == len(np.unique(x, axis=0))
    models = KM.fit(pts, [2, 4], starts=8)
    worth = KM.silhouettes(pts, models)
    for k, m in models.items():
        label, d = _plain_sums(x, m.centres)
        assert m.cost == pytest.approx((d ** 2).sum()) and list(m.n) == list(np.bincount(label, minlength=k))
        spread = np.array([d[label == c].mean() for c in range(k)])
        apart = np.sqrt(((m.centres[:, None] - m.centres[None]) ** 2).sum(2)) + np.diag([np.inf] * k)
        assert m.davies_bouldin() == pytest.approx(np.mean(((spread[:, None] + spread) / apart).max(1)))
        far, s = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2)), []
        for i in range(len(x)):
            mean = [far[i, label == c].sum() / max((label == c).sum() - (c == label[i]), 1) for c in range(k)]
            other = min(v for c, v in enumerate(mean) if c != label[i])
            s.append((other - mean[label[i]]) / max(other, mean[label[i]]))
        assert worth[k] == pytest.approx(np.mean(s))
    # four clumps are found whole, and the best of many starts is no worse than the first
    assert sorted(models[4].n) == [60, 120, 120, 120]
    assert KM.fit(pts, [2], starts=1)[2].cost >= models[2].cost - 1e-9


def test_result_does_not_depend_on_partitions(spark):
    x = np.random.default_rng(2).normal(size=(400, 3)).round(1)
    found = [KM.fit(KM.points(_frame(spark, x).repartition(p), list("abc")), [3], starts=5)[3] for p in (1, 7)]
    assert found[0].start == found[1].start and np.allclose(found[0].centres, found[1].centres)


def test_starts_are_drawn_by_squared_distance(spark):
    # after a first centre at a, b is nine times as likely as c, which is three times as near
    x = np.array([[0.0], [3.0], [-1.0]])
    pts = KM.points(_frame(spark, x), ["a"])
    first = KM.seeds(pts, 600, 2, 5)[:, :, 0]
    second = first[first[:, 0] == 0, 1]
    assert 120 < len(second) < 280 and 0.82 < (second == 3.0).mean() < 0.97


def test_few_vectors_and_no_rows(spark):
    one = KM.points(_frame(spark, np.ones((5, 2))), ["a", "b"])
    models = KM.fit(one, [2, 3], starts=2)
    assert len(models[3].centres) == 1 and models[3].cost == 0 and models[3].davies_bouldin() is None
    assert KM.silhouettes(one, models) == {2: None, 3: None}
    assert KM.fit(KM.points(_frame(spark, np.ones((1, 2))).limit(0), ["a", "b"]), [2], starts=2) == {}


def test_cost_of_the_emitted_centres_by_sql(spark):
    from tabiya.operators import clusters as K
    from tabiya.operators import profiles as P
    from tabiya.sources import fixtures as fx

    got = QT.m09(spark, SF001).collect()
    e = P.game_features(fx.games(spark, SF001))
    z = K.scale(e, K.FEATURES, K.scaler_stats(e)).select(*[f"z_{c}" for c in K.FEATURES]).toArrow()  # noqa: F841
    names = ", ".join(f"z_{c}" for c in K.FEATURES)
    rows = ", ".join("(" + ", ".join(map(str, [r["rank"], *[r[f"c_{c}"] for c in K.FEATURES]])) + ")" for r in got)
    d2 = " + ".join(f"(z_{c} - c_{c}) ** 2" for c in K.FEATURES)
    sql = f"""WITH m(rank, {', '.join(f'c_{c}' for c in K.FEATURES)}) AS (VALUES {rows}), r AS (SELECT row_number() OVER () AS i, {names} FROM z),
      near AS (SELECT i, arg_min(rank, {d2}) AS rank, min({d2}) AS d2 FROM r, m GROUP BY i) SELECT rank, count(*) AS n, sum(sum(d2)) OVER () AS cost FROM near GROUP BY rank"""
    found = {r[0]: r for r in duckdb.sql(sql).fetchall()}
    for r in got:
        # the query rounds its centres to eight digits
        assert abs(found[r["rank"]][1] - r["n"]) <= 2 and found[r["rank"]][2] == pytest.approx(r["cost"], rel=1e-6)
