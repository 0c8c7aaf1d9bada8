"""Scalar column expressions (pure ``Column -> Column`` functions).

All of them compile to Catalyst expressions, so they stay inside whole-stage
codegen. NULL semantics follow pandas where the reference relies on it: caps
keep NULL (``CASE`` rather than ``least``), NaN-skipping aggregates map to the
SQL aggregates that skip NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accuracy curve constants (exp curve and the documented steep curve).
ACC_DECAY = 0.0035
STEEP_A, STEEP_B, STEEP_C = 103.1668, 0.04354, 3.1669
ACL_CAP = 500.0
THEORY_MAX = 15.0


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def accuracy(acl, digits: int = 2, curve: str = "exp") -> Column:
    """Accuracy from average loss; NULL stays NULL.

    ``digits`` = 2 (game features) or 1 (pipeline dashboards); ``curve="steep"``
    is the alternate documented curve.
    """
    a = _c(acl)
    if curve == "steep":
        raw = F.greatest(F.lit(0.0), F.lit(STEEP_A) * F.exp(F.lit(-STEEP_B) * a) - F.lit(STEEP_C))
    else:
        raw = F.least(F.lit(100.0), F.greatest(F.lit(0.0), F.lit(100.0) * F.exp(F.lit(-ACC_DECAY) * a)))
    return F.when(a.isNull(), F.lit(None).cast("double")).otherwise(F.bround(raw, digits))


def winsorize(acl, cap: float = ACL_CAP) -> Column:
    """``min(acl, cap)`` keeping NULL."""
    a = _c(acl)
    return F.when(a > F.lit(cap), F.lit(float(cap))).otherwise(a.cast("double"))


def normalize_eval(eval_type, eval_value, cap: int = 1000, on_missing: str = "null") -> Column:
    """Mate -> +cap if value > 0 else -cap (mate 0 -> -cap); cp clamped to ±cap.

    ``on_missing="zero"`` is the pipeline variant (failed evaluation -> 0.0).
    """
    t, v = _c(eval_type), _c(eval_value).cast("double")
    out = (F.when(t == "mate", F.when(v > 0, F.lit(float(cap))).otherwise(F.lit(-float(cap))))
           .when(t == "cp", F.greatest(F.lit(-float(cap)), F.least(F.lit(float(cap)), v))))
    missing = F.lit(0.0) if on_missing == "zero" else F.lit(None).cast("double")
    return F.when(v.isNull() | t.isNull(), missing).otherwise(F.coalesce(out, missing))


def theory_norm(t, variant: str = "clip", max_theory: float = THEORY_MAX) -> Column:
    """``clip(t/15, 0, 1)``; ``raw`` = t/15; ``log`` = ln(1+t)/ln(16)."""
    x = _c(t).cast("double")
    if variant == "raw":
        return x / F.lit(max_theory)
    if variant == "log":
        return F.log1p(x) / F.log1p(F.lit(max_theory))
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), x / F.lit(max_theory)))


def prep_score(t, acc, variant: str = "app") -> Column:
    """(t/15)·(acc/100). ``app`` = raw t, rounded 4; ``aug`` = clipped t."""
    if variant == "aug":
        return theory_norm(t) * (_c(acc) / 100.0)
    return F.bround(theory_norm(t, "raw") * (_c(acc) / 100.0), 4)


def risk_index(t, acc, variant: str = "app") -> Column:
    """(t/15)·(100-acc), same two variants as P06."""
    if variant == "aug":
        return theory_norm(t) * (F.lit(100.0) - _c(acc))
    return F.bround(theory_norm(t, "raw") * (F.lit(100.0) - _c(acc)), 4)


def adjusted_accuracy(t, acc, variant: str = "penalty", bonus_max: float = 15.0) -> Column:
    """``penalty`` = acc·(1-0.15·clip(t/15)) (app); ``bonus`` = min(100, acc + log-theory·15)."""
    if variant == "bonus":
        return F.bround(F.least(F.lit(100.0), _c(acc) + theory_norm(t, "log") * bonus_max), 1)
    tn = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.least(_c(t).cast("double"), F.lit(15.0)) / 15.0))
    return F.bround(_c(acc) * (F.lit(1.0) - F.lit(0.15) * tn), 1)


# Game flag thresholds (theory plies, accuracy %) per variant.
FLAG_RULES = {
    "app": {"expert": (10, 70.0), "feeling": (7, 65.0), "critical": (10, 60.0)},
    "aug": {"expert": (10, 65.0), "feeling": (7, 70.0), "critical": (8, 55.0)},
}


def game_flags(t, acc, variant: str = "app") -> dict[str, Column]:
    """Expert (t>=a ∧ acc>=b), feeling (t<a ∧ acc>=b), critical (t>=a ∧ acc<b) as 0/1 ints."""
    r = FLAG_RULES[variant]
    tt, a = _c(t), _c(acc)
    return {
        "is_theory_expert": ((tt >= r["expert"][0]) & (a >= r["expert"][1])).cast("int"),
        "is_feeling_natural": ((tt < r["feeling"][0]) & (a >= r["feeling"][1])).cast("int"),
        "is_critical_point": ((tt >= r["critical"][0]) & (a < r["critical"][1])).cast("int"),
    }


def flag_exprs_null_false(flags: dict[str, Column]) -> dict[str, Column]:
    """pandas compares NaN as False: a NULL comparison becomes 0."""
    return {k: F.coalesce(v, F.lit(0)) for k, v in flags.items()}


# Colour names that count as White (multilingual fallback).
WHITE_NAMES = ["white", "blancas", "w", "1"]


def color_bin(color) -> Column:
    """P10: 1 for White, else 0."""
    return F.coalesce(F.lower(F.trim(_c(color))).isin(*WHITE_NAMES).cast("int"), F.lit(0))


# Right-closed rating bins.
BINS_9 = [0, 1000, 1200, 1400, 1600, 1800, 2000, 2200, 2400, 5000]
LABELS_9 = ["beginner_low", "beginner_high", "intermediate_1", "intermediate_2", "intermediate_3",
            "advanced_1", "advanced_2", "expert_1", "expert_2"]
BINS_4 = [0, 1200, 1600, 2000, 5000]
LABELS_4 = ["beginner", "intermediate", "advanced", "expert"]
AUDIT_LABELS = ["<1000", "1000-1200", "1200-1400", "1400-1600", "1600-1800", "1800-2000",
                "2000-2200", "2200-2400", ">2400"]
# left-closed 3-class bins
BINS_3 = [0, 1400, 1800, 5000]
LABELS_3 = ["principiante", "intermedio", "avanzado"]


def bin_right_closed(x, bins: list, labels: list) -> Column:
    """Pandas ``cut`` (a, b]; outside -> NULL."""
    v = _c(x)
    expr = None
    for lo, hi, lab in zip(bins[:-1], bins[1:], labels):
        cond = (v > lo) & (v <= hi)
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr


def bin_left_closed(x, bins: list = BINS_3, labels: list = LABELS_3) -> Column:
    """[a, b) bins; outside -> NULL."""
    v = _c(x)
    expr = None
    for lo, hi, lab in zip(bins[:-1], bins[1:], labels):
        cond = (v >= lo) & (v < hi)
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr


def level_ordinal(level4) -> Column:
    """P13 (class form): beginner..expert -> 0..3."""
    v = _c(level4)
    return (F.when(v == "beginner", 0).when(v == "intermediate", 1)
            .when(v == "advanced", 2).when(v == "expert", 3))


def level_continuous(rating) -> Column:
    """P13 (continuous form): (clip(r, 500, 3000) - 500) / 2500."""
    r = _c(rating).cast("double")
    return (F.least(F.lit(3000.0), F.greatest(F.lit(500.0), r)) - 500.0) / 2500.0


# Rule groups by closed integer rating ranges, default 'avanzado'.
GROUP_RANGES = [("principiante", 0, 1399), ("intermedio", 1400, 1999), ("avanzado", 2000, 9999)]


def rule_group(rating, strict: bool = False) -> Column:
    """First closed range containing the rating; no match -> 'avanzado'.

    ``strict=True`` closes the gaps (1399.5 -> principiante).
    """
    r = _c(rating)
    expr = None
    for name, lo, hi in GROUP_RANGES:
        cond = (r >= lo) & (r < hi + 1) if strict else (r >= lo) & (r <= hi)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit("avanzado"))


def base_opening(name, default: str = "Desconocida") -> Column:
    """Text before the first ':' then before the first ',', trimmed."""
    n = F.coalesce(_c(name), F.lit(default))
    return F.trim(F.split_part(F.split_part(n, F.lit(":"), F.lit(1)), F.lit(","), F.lit(1)))


def result_score(result, white_name, target_user) -> Column:
    """Player score from the result header (win 1, draw .5, else 0)."""
    is_white = F.lower(F.coalesce(_c(white_name), F.lit(""))) == F.lower(_c(target_user))
    res = _c(result)
    return (F.when(((res == "1-0") & is_white) | ((res == "0-1") & ~is_white), F.lit(1.0))
            .when(res == "1/2-1/2", F.lit(0.5)).otherwise(F.lit(0.0)))


# Player title ladder (minimum rating, title) in descending order.
TITLE_LADDER = [(2200, "Gran Maestro Amateur"), (2000, "Maestro FIDE"), (1800, "Jugador Avanzado"),
                (1600, "Competidor de Club"), (1400, "Jugador Intermedio"), (1200, "Principiante Avanzado"),
                (0, "Principiante")]


def diagnosis_rule(avg_acc, avg_theory) -> Column:
    """P17 (diagnosis half): index 1..5 of the first matching rule on (mean acc, mean theory)."""
    a, t = _c(avg_acc), _c(avg_theory)
    return (F.when((a >= 80) & (t >= 10), 1).when((a >= 80) & (t < 7), 2)
            .when((a < 65) & (t >= 10), 3).when(a < 65, 4).otherwise(5))


def title_of(rating) -> Column:
    """P17 (title half): highest ladder step whose minimum the rating reaches."""
    r = _c(rating)
    expr = None
    for lo, name in TITLE_LADDER:
        expr = F.when(r >= lo, F.lit(name)) if expr is None else expr.when(r >= lo, F.lit(name))
    return expr.otherwise(F.lit(TITLE_LADDER[-1][1]))


def accuracy_class(acc) -> Column:
    """Display severity of an accuracy (>=80 high, >=60 mid, else low)."""
    a = _c(acc)
    return F.when(a >= 80, "high").when(a >= 60, "mid").otherwise("low")


def loss_class(loss) -> Column:
    """A loss above 200 cp is severe."""
    return F.when(_c(loss) > 200, "severe").otherwise("normal")


# Generic words dropped by the search-query normaliser.
GENERIC_WORDS = ["variation", "defense", "opening", "attack", "gambit", "declined"]


def search_query(name, url_encode: bool = False) -> Column:
    """P20: last segment after ':' then after ',', lower, generic words removed as
    substrings, whitespace runs -> '+', outer '+' stripped. ``url_encode`` is the
    app variant: the trimmed name percent-encoded (blank ``%20``, slash kept).
    """
    n = F.coalesce(_c(name), F.lit(""))
    if url_encode:
        return F.replace(F.replace(F.url_encode(F.trim(n)), F.lit("+"), F.lit("%20")), F.lit("%2F"), F.lit("/"))
    last = F.lower(F.trim(F.element_at(F.split(F.element_at(F.split(n, ":"), -1), ","), -1)))
    for w in GENERIC_WORDS:
        last = F.trim(F.replace(last, F.lit(w), F.lit("")))
    q = F.regexp_replace(last, r"\s+", "+")
    return F.regexp_replace(q, r"^\++|\++$", "")


def richness(*flags) -> Column:
    """Sum of has_* flags with NULL counted as 0."""
    total = F.lit(0)
    for f in flags:
        total = total + F.coalesce(_c(f).cast("int"), F.lit(0))
    return total


def default_tier(tier, level_min, default_min: int = 1200) -> Column:
    """P25: keep the tier, else band of level_min (default 1200)."""
    lm = F.coalesce(_c(level_min), F.lit(default_min))
    band = level_band(lm)
    t = _c(tier)
    return F.when(t.isNull(), band).otherwise(t)


# Level bands [lo, hi) of the catalogue collector.
LEVEL_MAP = [("beginner", 0, 1200), ("intermediate", 1200, 1800), ("advanced", 1800, 2300), ("expert", 2300, 3000)]


def level_band(level, default: str = "intermediate") -> Column:
    """Band of a level by LEVEL_MAP, else ``default``."""
    v = _c(level)
    expr = None
    for name, lo, hi in LEVEL_MAP:
        cond = (v >= lo) & (v < hi)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(default))
