"""Property test: Spark growth summary == a pandas brute-force statement of the rules."""
import math

import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from valuora.operators import growth as G

VALUES = st.sampled_from([None, 0.0, -3.0, -1.0, 1.0, 2.0, 5.0, 7.5, math.inf, -math.inf, 0.5])


@st.composite
def panels(draw):
    rows = []
    for t in range(draw(st.integers(1, 25))):
        years = sorted(draw(st.sets(st.integers(2000, 2013), min_size=1, max_size=12)))
        for y in years:
            rows.append((f"T{t}", y, draw(VALUES), draw(VALUES)))
    return rows


def brute(rows, agg):
    df = pd.DataFrame(rows, columns=["ticker", "fy", "eps", "bvps"]).sort_values(["ticker", "fy"])
    out = {}
    for k in ("eps", "bvps"):
        v = df[k].astype(float).replace(0, np.nan)
        df[k] = v
        filled = v.groupby(df["ticker"]).ffill()
        prev = filled.groupby(df["ticker"]).shift(1)
        df[f"{k}_gr"] = filled / prev - 1
    for t, g in df.groupby("ticker"):
        mx = g["fy"].max()
        r = {"eps_curr": g.loc[g["fy"] == mx, "eps"].iloc[0]}
        for n in (5, 10):
            w = g[g["fy"] > mx - n]
            f = (lambda s: s.mean()) if agg == "mean" else (lambda s: s.median())
            e, b = np.round(f(w["eps_gr"]), 2), np.round(f(w["bvps_gr"]), 2)
            m = pd.Series([b, e]).min()
            rule1 = m if m > 0 else np.nan
            r.update({f"eps_gr_{n}yr": e, f"bvps_gr_{n}yr": b, f"yrs_in_{n}yr": len(w),
                      f"rule1_gr_{n}yr": rule1, f"pe_default_{n}yr": 2 * 100 * rule1})
        out[t] = {k: (None if isinstance(v, float) and (math.isnan(v) or math.isinf(v)) else v)
                  for k, v in r.items()}
    return out


def spark_summary(spark, rows, agg):
    df = spark.createDataFrame(
        [(t, y, 1.0, 1.0, e, b, 1.0, None) for t, y, e, b in rows],
        "ticker string, fiscal_year int, roic double, revenue double, eps double, bvps double, "
        "fcf double, pe double")
    res = G.growth_summary(G.kpi_growth(df), agg).collect()
    return {r["ticker"]: r.asDict() for r in res}


def close(a, b):
    if a is None or b is None:
        return a is None and b is None
    return abs(a - b) <= 1e-9 * max(1.0, abs(a))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.too_slow])
@given(panels(), st.sampled_from(["mean", "median"]))
def test_growth_summary_matches_brute_force(spark, rows, agg):
    exp = brute(rows, agg)
    got = spark_summary(spark, rows, agg)
    assert set(exp) == set(got)
    for t, e in exp.items():
        for k, v in e.items():
            assert close(got[t][k], v), (t, k, got[t][k], v, agg)
