"""No cut decides a result: exclusions, answer sizes, whole texts, unseen categories, restarts."""


import random

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tabiya.functions import text as X
from tabiya.operators import catalog as C
from tabiya.operators import ml as ML
from tabiya.operators import recommend as R
from tabiya.operators.bridge import match_bridge
from tabiya.sources import fixtures as fx
from tabiya.streaming import incremental as I

from .conftest import SF001
from .test_plan import _brute


def test_three_priority_search_with_many_exclusions(spark):
    cat = fx.catalog(spark, SF001).cache()
    catp = cat.toPandas()
    names = fx.OPENING_NAMES
    reqs = [(f"q{k}", ("white", "black")[k % 2], "Alekhine Defense" if k == 0 else names[k % 12], ("dominio", "desarrollo", "sin_base")[k % 3], 1000.0 + 97 * k) for k in range(8)]
    req = spark.createDataFrame(reqs, "req_id string, color string, opening string, level string, rating double").withColumn("free", F.lit(None).cast("int"))
    for n, x in ((1, 0), (3, 16), (3, 40), (6, 40)):
        out = {}
        for i, r in enumerate(reqs):  # what a search without exclusions would answer first
            row = dict(zip(("req_id", "color", "opening", "level", "rating"), r))
            gone = set()
            while len(gone) < x * (i % 3) // 2 and (got := _brute(row, catp, 6, gone)):
                gone.update(got)
            out[r[0]] = (row, gone)
        ex = spark.createDataFrame([(q, g) for q, (_, gone) in out.items() for g in gone] or [("none", "none")], "req_id string, resource_id string")
        found = R.three_priority_search(req, cat, n, ex).toPandas()
        for q, (row, gone) in out.items():
            mine = found[found["req_id"] == q].sort_values("pick")["resource_id"].tolist()
            assert mine == _brute(row, catp, n, gone), (q, n, x)


def _label_brute(line, cat, n):
    focus, avoid, high = R.GROUP_CFG[line["group"]]
    prefs = R.LABEL_COURSE_TYPE.get(line["label"], ["general"])
    rows = []
    for r in cat.to_dict("records"):
        lo, hi = (0 if r["level_min"] != r["level_min"] else r["level_min"]), (9999 if r["level_max"] != r["level_max"] else r["level_max"])
        if not lo <= line["rating"] <= hi or (r["course_type"] or "") in avoid:
            continue
        color = (r["color"] or "Both").lower()
        s = 40.0 if isinstance(r["openings"], str) and line["base"] in r["openings"].lower() else 0.0
        s += 10 if color == line["color"] else 5 if color == "both" else 0
        s += 20 if r["course_type"] == prefs[0] else 10 if r["course_type"] in prefs else 0
        s += 8 if r["course_type"] in focus else 0
        s -= 15 if r["course_type"] == "opening" and line["accuracy_pct"] >= high and line["label"] not in ("PUNTO_CRITICO", "TEORIA_VACIA") else 0
        s += 5 * sum(0 if v != v else v for v in (r["has_video"], r["has_pgn"], r["has_exercises"], r["has_spaced_rep"]))
        s += 5 * r["popularity_score"]
        rows.append((-s, r["resource_id"]))
    return [i for _, i in sorted(rows)[:n]]


def test_label_driven_plan_of_any_size(spark):
    cat = fx.catalog(spark, SF001).withColumn("popularity_score", (F.crc32("resource_id") % 5).cast("double")).cache()
    catp = cat.toPandas()
    lines = [(k, fx.OPENING_NAMES[k], ("white", "black")[k % 2], label, 1, acc, group, 1100.0 + 150 * k) for k, (label, group, acc) in enumerate(
        [("PUNTO_CRITICO", "principiante", 50.0), ("TEORIA_VACIA", "intermedio", 90.0), ("EXITO_NATURAL", "avanzado", 85.0), ("DOMINIO", "avanzado", 60.0), ("NEUTRO", "intermedio", 80.0)])]
    prof = spark.createDataFrame(lines, "player int, opening string, color string, label string, label_priority int, accuracy_pct double, group string, rating double")
    for n in (1, 3, 7, 10):
        got = R.label_driven_plan(prof, cat, n).toPandas()
        for player, opening, color, label, _, acc, group, rating in lines:
            mine = got[got["player"] == player].sort_values("rank")["resource_id"].tolist()
            assert mine == _label_brute({"base": opening.lower(), "color": color, "label": label, "accuracy_pct": acc, "group": group, "rating": rating}, catp, n), (opening, n)


def test_band_keeps_fractions(spark):
    games = spark.createDataFrame([(1399.6, 10.0, 1), (1599.4, 20.0, 2), (1600.0, 40.0, 3)], "rating double, acl double, theory_depth int")
    got = {r.target: r for r in R.band_aggregate(spark.createDataFrame([(1399.5,), (1199.6,)], "rating double"), games).collect()}
    assert got[1399.5].n_games == 2 and got[1199.6].n_games == 1


def test_message_signal_after_the_first_line(spark, tmp_path):
    text = "x" * 500 + " https://youtu.be/late"
    spark.createDataFrame([(1, 3, text)], "conv_id bigint, turn int, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    m = fx.messages(spark, str(tmp_path)).select(X.extract_urls("text").alias("urls")).first()
    assert "https://youtu.be/late" in m.urls


def test_unseen_categories_have_columns(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "new"), ("b", None)], "source string, level_tier string")
    p = C.pivot_counts(df, "source", "level_tier")
    assert set(p.columns) == {"source", "new", "x"} and {r.source: (r.new, r.x) for r in p.collect()} == {"a": (1, 1), "b": (0, 0)}
    assert set(C.one_hot(df, "level_tier").columns) == {"source", "level_tier", "level_tier_new", "level_tier_x"}


def test_missing_columns_keep_their_type(spark):
    a = spark.createDataFrame([("r1", 5)], "resource_id string, views int")
    b = spark.createDataFrame([("r2",)], "resource_id string")
    assert dict(C.merge_catalogues(a, b, ["resource_id", "views"]).dtypes)["views"] == "int"


def test_append_does_not_swallow_errors(spark, tmp_path):
    src, target = f"{tmp_path}/in", f"{tmp_path}/out"
    schema = "game_id long, ingest_seq long"
    spark.createDataFrame([(1, 1)], schema).write.parquet(src)
    I.exactly_once_append(spark, src, schema, target, f"{tmp_path}/c")
    (tmp_path / "out" / "part-bad.parquet").write_bytes(b"not parquet")
    spark.createDataFrame([(1, 2)], schema).write.mode("append").parquet(src)
    with pytest.raises(StreamingQueryException):
        I.exactly_once_append(spark, src, schema, target, f"{tmp_path}/c")


def test_blunder_state_survives_restarts(spark, tmp_path):
    schema = "game_id long, player long, opening string, fen string, loss double, ts long, kind string"
    def run():
        path = I.stream_blunder_state(spark, f"{tmp_path}/in", schema, f"{tmp_path}/state", f"{tmp_path}/c")
        return None if path is None else {r.game_id: r.loss for r in spark.read.parquet(path).collect()}
    def add(*rows):
        spark.createDataFrame([(g, 1, "o", "f", float(x), t, "observe") for g, x, t in rows], schema).write.mode("append").parquet(f"{tmp_path}/in")
    add((1, 100, 1), (2, 200, 1))
    assert run() == {1: 100.0, 2: 200.0}
    add((3, 50, 2), (1, 300, 2))
    assert run() == {1: 300.0, 2: 200.0, 3: 50.0}
    assert run() == {1: 300.0, 2: 200.0, 3: 50.0}  # nothing new


def test_bridge_finds_short_terms_and_shares_texts(spark):
    from tabiya.operators.bridge import match_bridge

    rows = [(f"r{k}", t) for k, t in enumerate(["1.d4 abc", "1.d4 abc", "x", "the defense of d4", "kingside", None, ""])] + [(f"h{k}", "the the the") for k in range(50)]
    res = spark.createDataFrame(rows, "resource_id string, openings string")
    terms = spark.createDataFrame([("A", "d4"), ("B", "x"), ("C", "the"), ("D", "defense of"), ("E", "zzz"), ("F", "the"), ("G", "")], "opening string, term string")
    got = {(r.opening, r.resource_id) for r in match_bridge(terms, res, ["openings"]).collect()}
    want = {(o, i) for o, t in [("A", "d4"), ("B", "x"), ("C", "the"), ("D", "defense of"), ("E", "zzz"), ("F", "the")] for i, s in rows if s and t in s}
    assert got == want
    assert match_bridge(terms, res, ["openings"], ["x"]).filter("opening = 'B'").count() == 1


def test_exact_quantiles_equal_numpy(spark):
    import numpy as np
    from tabiya.operators.common import exact_quantiles, global_rank

    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 20, 501).astype(float), rng.normal(size=501)
    df = spark.createDataFrame([(float(x), float(y) if i % 3 else None, None) for i, (x, y) in enumerate(zip(a, b))], "a double, b double, c double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = exact_quantiles(df, ["a", "b", "c"], probs)
    assert np.allclose(got["a"], np.quantile(a, probs)) and np.allclose(got["b"], np.quantile([y for i, y in enumerate(b) if i % 3], probs)) and got["c"] == [None] * 6
    ranked = global_rank(df.select("b").filter("b is not null"), [F.col("b")]).orderBy("b").collect()
    assert [r.rank for r in ranked] == list(range(1, len(ranked) + 1))


def test_course_card_of_a_full_page(spark):
    from tabiya.sources.io import course_cards

    html = ('<div><a href="/course/sharp-dragon/x"><h2>The <b>Sharp</b>  Dragon for Black</h2></a><a href="/l?opening=Sicilian+Dragon&p=1">a</a>'
            '<a href="/l?opening=Sicilian+Dragon">b</a><a href="/l?opening=Pirc">c</a><a class="x" href="/author/1">GM A. One</a><a href="/author/2">IM B</a>'
            "<p>For players 1400 - 1800. 2 h and 30 min</p><i>Video Content</i><i>Memory Booster</i></div>")
    df = spark.createDataFrame([(1, html), (2, "<h2>no link</h2>"), (3, None), (4, '<a href="/course/a/">x</a>')], "page_id int, html string")
    rows = course_cards(df).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.title, r.url, r.openings, r.color, r.course_type) == ("The Sharp Dragon for Black", "/course/sharp-dragon/x", "Sicilian Dragon|Pirc", "Black", "opening")
    assert (r.author, r.author_title, r.duration_min, r.level_min, r.level_max) == ("GM A. One, IM B", "GM", 150.0, 1400, 1800)
    assert (r.has_video, r.has_pgn, r.has_exercises, r.has_spaced_rep, r.format) == (1, 0, 0, 1, "video")
    assert r.resource_id == "mc__sharp_dragon" and r.description.startswith("For players")


def test_nearest_bounds_are_the_plain_ones(spark):
    import bisect
    import random

    from tabiya.operators.common import nearest_bound

    rng = random.Random(3)
    bounds = sorted({rng.randrange(-10 ** 6, 10 ** 6) for _ in range(20_000)})
    values = [rng.randrange(-2 * 10 ** 6, 2 * 10 ** 6) for _ in range(500)] + bounds[:50] + [None, 7, 7]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v long")
    bd = spark.createDataFrame([(b,) for b in bounds], "b long")
    got = nearest_bound(nearest_bound(df, "v", bd, "floor", "lo"), "v", bd, "ceil", "hi").collect()
    assert len(got) == len(values)
    for r in got:
        if r.v is None:
            assert r.lo is None and r.hi is None
            continue
        a, b = bisect.bisect_right(bounds, r.v), bisect.bisect_left(bounds, r.v)
        assert r.lo == (bounds[a - 1] if a else None) and r.hi == (bounds[b] if b < len(bounds) else None)
    assert nearest_bound(df, "v", bd.limit(0), "floor", "lo").filter("lo IS NOT NULL").count() == 0


def test_search_lists_make_no_row_per_request_and_candidate(spark):
    cat = fx.catalog(spark, SF001)
    req = spark.createDataFrame([(f"q{k}", "white", fx.OPENING_NAMES[0], "dominio", 1500.0) for k in range(400)], "req_id string, color string, opening string, level string, rating double")
    plan = R.three_priority_search(req.withColumn("free", F.lit(None).cast("int")), cat)
    assert plan.groupBy("req_id").count().filter("count <> 3").count() == 0
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    # ranked per class before, picked inside the request's row
    assert "posexplode" in text and not [line for line in text.splitlines() if "Window" in line and "req_id" in line]


def _broadcast_scans(df):
    """Lines of the plan that stand below a broadcast and read a table or a checkpoint."""
    found, inside = [], None
    for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
        depth = len(line) - len(line.lstrip(" :+-*()0123456789"))
        if inside is not None and depth <= inside:
            inside = None
        if inside is None and "BroadcastExchange" in line:
            inside = depth
        elif inside is not None and ("FileScan" in line or "Scan ExistingRDD" in line):
            found.append(line.strip())
    return found


def test_no_catalogue_is_broadcast(spark):
    cat = fx.catalog(spark, SF001)
    # a catalogue's file is far smaller than its rows, so its size estimate must not decide
    terms = spark.createDataFrame([("Slav Defense", "slav")], "opening string, term string")
    assert not [x for x in _broadcast_scans(match_bridge(terms, cat, ["openings", "title"])) if "FileScan" in x]
    req = spark.createDataFrame([("q", "white", "Slav Defense", "dominio", 1500.0, None)], "req_id string, color string, opening string, level string, rating double, free int")
    assert not [x for x in _broadcast_scans(R.three_priority_search(req, cat)) if "title" in x]


def test_boosted_catalogue_is_not_broadcast(spark):
    boosted = R.tier_boosted_by_tier(fx.catalog(spark, SF001), F.coalesce("rating_score", F.lit(0.0)), 10)
    assert not [x for x in _broadcast_scans(boosted) if "FileScan" in x]


def test_boosted_ranking_of_users(spark):
    rng = random.Random(3)
    users = [(1, 900), (2, 1500), (3, 2100), (4, None)]
    scored = [(u, f"r{i}", rng.choice(["beginner", "intermediate", "advanced", "expert", None]), rng.random()) for u in (1, 2, 3, 4, 5) for i in range(40)]
    scored += [(1, f"x{i}", "beginner", 5.0) for i in range(6)]
    got = R.tier_boosted_topn(spark.createDataFrame(users, "player long, rating int"), spark.createDataFrame(scored, "player long, resource_id string, level_tier string, base_score double"), 5).collect()
    boost = {(u, t): m for u, t, m in R.TIER_BOOST}
    for u, rating in users:
        tier = "advanced" if rating is None or rating >= 1800 else "beginner" if rating < 1200 else "intermediate"
        rows = sorted((-s * boost.get((tier, t), 1.0), r, t == tier) for p, r, t, s in scored if p == u)
        own = [x for x in rows if x[2]][:2]
        want = sorted(own + [x for x in rows if not x[2]][:5 - len(own)])
        assert [r.resource_id for r in sorted((r for r in got if r.player == u), key=lambda r: r["rank"])] == [x[1] for x in want]


def test_forest_rows_are_spread_over_tasks(spark):
    # adaptive execution leaves few bytes in one partition, whose rows one core would train on
    spread = ML._spread(spark.range(0, 2 * ML.ROWS_PER_TASK + 1, 1, 1))
    assert spread.rdd.getNumPartitions() == 3 and spread.agg(F.count("id"), F.sum("id")).first()[:] == (2 * ML.ROWS_PER_TASK + 1, ML.ROWS_PER_TASK * (2 * ML.ROWS_PER_TASK + 1))
    assert ML._spread(spark.range(0, 100, 1, 1)).rdd.getNumPartitions() == 1 and ML._spread(spark.range(0).coalesce(1)).count() == 0


def test_batches_do_not_grow_with_files(spark, tmp_path):
    # a part of a log is read in as many batches however many files it was written in
    rows = spark.range(60).withColumn("f", F.col("id") % 3)
    for name, n in (("few", 1), ("many", 12)):
        rows.repartition(n).write.partitionBy("f").parquet(str(tmp_path / name))
        files = len(list((tmp_path / name).glob("f=*/part-*")))
        batch = I.files_of_parts(spark, str(tmp_path / name), 2, 3)
        assert files >= 3 * min(n, 2) and -(-files // batch) == 2
    assert I.files_of_parts(spark, str(tmp_path / "none"), 2, 3) == 2
