"""Property tests: sticker price and screener against plain-Python statements of the rules."""
import datetime as dt
import math

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from valuora.operators.screen import screener
from valuora.operators.valuation import sticker_price

NUM = st.one_of(st.none(), st.sampled_from([-2.0, -0.3, 0.0, 0.1, 0.29, 0.5, 1.0, 3.7, 58.0, 120.5]))


def py_round2(x):
    return None if x is None else float(np.round(x, 2))


def py_sticker(r, fp=10, rr=0.15):
    pe5, ped = r["pe_5yr"], r["pe_default_5yr"]
    pe_future = None if pe5 is None else (pe5 if ped is None else min(pe5, ped))
    pe_future = pe_future if pe_future is not None and pe_future > 0 else None
    g, e = r["rule1_gr_5yr"], r["eps_curr"]
    eps_future = None if g is None or e is None else e * (1 + g) ** fp
    eps_future = eps_future if eps_future is not None and eps_future > 0 else None
    bad = any(r[k] is not None and r[k] < 0 for k in ("roic_gr_5yr", "fcf_gr_5yr", "bvps_gr_5yr"))
    pf = None if bad or pe_future is None or eps_future is None else py_round2(pe_future * eps_future)
    sp = None if pf is None else py_round2(pf / (1 + rr) ** fp)
    mos = None if sp is None else py_round2(sp / 2)
    return {"pe_future": pe_future, "eps_future": eps_future, "price_future": pf,
            "sticker_price": sp, "mos": mos}


COLS = ["eps_curr", "rule1_gr_5yr", "pe_5yr", "pe_default_5yr", "roic_gr_5yr", "fcf_gr_5yr",
        "bvps_gr_5yr"]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.too_slow])
@given(st.lists(st.tuples(*[NUM for _ in COLS]), min_size=1, max_size=40))
def test_sticker_matches_python(spark, rows):
    data = [(f"T{i}",) + r for i, r in enumerate(rows)]
    df = spark.createDataFrame(data, "ticker string, " + ", ".join(f"{c} double" for c in COLS))
    got = {r["ticker"]: r.asDict() for r in sticker_price(df).collect()}
    for t, *vals in data:
        exp = py_sticker(dict(zip(COLS, vals)))
        for k, v in exp.items():
            a = got[t][k]
            assert (a is None and v is None) or (a is not None and v is not None
                                                 and math.isclose(a, v, rel_tol=1e-12)), (k, a, v)


DAY = st.integers(0, 6)
PRICE = st.sampled_from([1.0, 2.0, 5.0, 9.5, 10.0, 30.0])


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.too_slow])
@given(st.lists(st.tuples(st.sampled_from("ABCDE"), DAY, PRICE), min_size=1, max_size=60),
       st.dictionaries(st.sampled_from("ABCDEF"), st.one_of(st.none(), PRICE), max_size=6))
def test_screener_matches_python(spark, prices, mos):
    base = dt.date(2021, 6, 1)
    px = spark.createDataFrame([(base + dt.timedelta(days=d), t, p) for t, d, p in prices],
                               "date date, ticker string, low double")
    g = spark.createDataFrame([(t, 1.0, 1.0, m) for t, m in mos.items()] or [("Z", 1.0, 1.0, None)],
                              "ticker string, price_future double, sticker_price double, mos double")
    got = sorted((r.ticker, r.last_date.isoformat(), r.last_low_price) for r in screener(px, g).collect())
    exp = []
    for t in sorted({t for t, _, _ in prices}):
        m = mos.get(t)
        if m is None:
            continue
        last = max(d for tt, d, _ in prices if tt == t)
        for tt, d, p in prices:
            if tt == t and d == last and p <= m:
                exp.append((t, (base + dt.timedelta(days=d)).isoformat(), p))
    assert got == sorted(exp)


VAL = st.one_of(st.none(), st.sampled_from([0.0, 0.5, 1.0, 2.5, 10.0, 36.0, 100.0, 1234.56]))


def py_flags(mos, low, limit=3500):
    reached = mos is not None and low is not None and mos >= low
    diff = None if mos is None or low is None else mos - low
    if mos is None or low is None:
        pct = None
    elif low == 0:
        pct = None if mos - low == 0 else (math.inf if mos - low > 0 else -math.inf)
    else:
        pct = 100.0 * float(np.round((mos - low) / low, 2))
    out = pct is not None and pct > limit
    return reached, diff, pct, out


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.too_slow])
@given(st.lists(st.tuples(VAL, VAL), min_size=1, max_size=40))
def test_price_flags_match_python(spark, pairs):
    from valuora.operators.multimarket import price_flags
    g = spark.createDataFrame([(f"T{i}", m) for i, (m, _) in enumerate(pairs)],
                              "ticker string, mos double")
    latest = spark.createDataFrame([(f"T{i}", lo) for i, (_, lo) in enumerate(pairs)],
                                   "ticker string, last_low_price double")
    got = {r.ticker: r for r in price_flags(g, latest).collect()}
    for i, (m, lo) in enumerate(pairs):
        r = got[f"T{i}"]
        reached, diff, pct, out = py_flags(m, lo)
        assert r.mos_reached is reached and r.out_off_bounds_value is out
        assert r.diff_price_mos == diff
        assert r.diff_price_mos_percentage == pct, (m, lo, r.diff_price_mos_percentage, pct)
