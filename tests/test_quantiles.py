"""Grouped quantiles against numpy: ties, one value, a hot group, nulls, no rows."""

import numpy as np
import pytest

from tabiya.operators.common import grouped_quantiles

PROBS = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]


def test_grouped_quantiles(spark):
    rng = np.random.default_rng(4)
    rows = [("hot", float(v)) for v in rng.integers(0, 40, 3000)] + [("one", 7.5)] + [("two", 1.0), ("two", 2.0)] + [("none", None)] * 3
    rows += [(None, float(v)) for v in rng.normal(size=101)] + [("hot", None)] + [(f"g{i % 9}", float(v)) for i, v in enumerate(rng.normal(size=400))]
    names = [f"q{i}" for i in range(len(PROBS))]
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    got = {r.k: [r[c] for c in names] for r in grouped_quantiles(df, "k", "v", PROBS, names).collect()}
    assert set(got) == {k for k, _ in rows}
    for k, q in got.items():
        values = [v for g, v in rows if g == k and v is not None]
        assert q == ([None] * len(PROBS) if not values else pytest.approx(list(np.quantile(values, PROBS))))
    assert grouped_quantiles(df.limit(0), "k", "v", PROBS, names).count() == 0
