"""Randomised checks of the verdict rule and of load properties."""

import random

from pyspark.sql import functions as F

from tableguard import Threshold
from tableguard.functions import sql as Q


def python_rule(t, s, mode, v, lo):
    """Verdict R stated directly (signed denominator)."""
    if s is None:
        return True
    if s == 0 or t == 0:
        return False
    if t is None:
        return False
    r = (t - s) / s
    ar = abs(t - s) / s
    if mode == "range":
        return lo <= ar <= v
    if mode == "upward":
        return 0.0 <= r <= v
    if mode == "downward":
        return v <= r <= 0.0
    return ar <= v


def test_relative_change_random(spark):
    rnd = random.Random(7)
    thresholds = ["0", "0.1", "0.5", "1", "+0.2", "+1", "-0.2", "-1", "0.1,0.5", "0,1"]
    rows = []
    for _ in range(2000):
        thr = Threshold.parse(rnd.choice(thresholds))
        pick = lambda: rnd.choice([None, 0.0, float(rnd.randint(-50, 200)), rnd.uniform(-1e6, 1e6)])
        t, s = pick(), pick()
        if rnd.random() < 0.2 and s not in (None, 0.0):   # exact boundary cases
            t = s * (1 + thr.value)
        rows.append((t, s, thr.mode, float(thr.value), thr.low))
    df = spark.createDataFrame(rows, "t double, s double, mode string, v double, lo double")
    got = df.select("*", F.expr(Q.relative_change_pass("t", "s", "mode", "v", "lo")).alias("p")).collect()
    for r in got:
        assert r["p"] == python_rule(r["t"], r["s"], r["mode"], r["v"], r["lo"]), tuple(r)


def _round_half_away(x):
    import math
    return None if x is None else int(math.floor(abs(x) + 0.5)) * (1 if x >= 0 else -1)


def python_band(tgt, last, avg, sd, t, mode):
    """The weekly band stated directly: last -/+ round(avg) -/+ round(t*sd)."""
    if last is None or avg is None or sd is None:
        bottom = top = None
    else:
        spread, mean = _round_half_away(t * sd), _round_half_away(avg)
        bottom, top = last - mean - spread, last + mean + spread
    if mode == "upward":
        return True if top is None else (tgt is not None and _round_half_away(tgt) < top)
    if mode == "downward":
        return True if bottom is None else (tgt is not None and _round_half_away(tgt) > bottom)
    if bottom is None or top is None:
        return True
    return tgt is not None and bottom <= tgt <= top


def test_band_random(spark):
    rnd = random.Random(11)
    rows = []
    for _ in range(2000):
        mode = rnd.choice(["absolute", "upward", "downward"])
        t = rnd.choice([1.0, 2.0, 0.5, 3.0]) * (-1 if mode == "downward" else 1)
        last = rnd.choice([None, rnd.randint(0, 500)])
        avg = rnd.choice([None, rnd.uniform(-20, 20), float(rnd.randint(-5, 5)) + 0.5])
        sd = rnd.choice([None, rnd.uniform(0, 40)])
        tgt = rnd.choice([None, float(rnd.randint(0, 600)), rnd.uniform(0, 600)])
        rows.append((tgt, last, avg, sd, t, mode))
    df = spark.createDataFrame(rows, "tgt double, last long, avg double, sd double, t double, mode string")
    lo, hi = Q.band_bounds("last", "avg", "sd", "t")
    got = df.select("*", F.expr(Q.band_pass("tgt", lo, hi, "mode")).alias("p")).collect()
    for r in got:
        assert r["p"] == python_band(r["tgt"], r["last"], r["avg"], r["sd"], r["t"], r["mode"]), tuple(r)
