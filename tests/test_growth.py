import math

import pytest
from pyspark.sql import functions as F

from valuora.operators import growth as G
from valuora.operators.valuation import sticker_price

FUND_SCHEMA = ("ticker string, fiscal_year int, roic double, revenue double, eps double, "
               "bvps double, fcf double, pe double")


def fund(spark, rows):
    return spark.createDataFrame(rows, FUND_SCHEMA)


def gr(spark, values, years=None, col="eps"):
    years = years or list(range(2010, 2010 + len(values)))
    rows = []
    for y, v in zip(years, values):
        d = dict(roic=1.0, revenue=1.0, eps=1.0, bvps=1.0, fcf=1.0)
        d[col] = v
        rows.append(("T", y, d["roic"], d["revenue"], d["eps"], d["bvps"], d["fcf"], None))
    out = G.kpi_growth(fund(spark, rows)).orderBy("fiscal_year")
    return [r[f"{col}_gr"] for r in out.collect()]


def test_growth_forward_fill(spark):
    assert gr(spark, [10.0, None, 20.0, -5.0]) == [None, 0.0, 1.0, -1.25]


def test_growth_zero_is_nulled_then_filled(spark):
    assert gr(spark, [10.0, 0.0, 20.0]) == [None, 0.0, 1.0]


def test_growth_over_a_gap_is_row_to_row(spark):
    assert gr(spark, [10.0, 20.0], years=[2015, 2018]) == [None, 1.0]


def test_growth_leading_nulls_and_inf(spark):
    out = gr(spark, [None, 5.0, math.inf, math.inf])
    assert out[0] is None and out[1] is None and out[2] == math.inf
    assert out[3] is None  # inf/inf = NaN -> NULL


def _summary(spark, eps, bvps):
    rows = [("T", 2010 + i, 1.0, 1.0, e, b, 1.0, 10.0) for i, (e, b) in enumerate(zip(eps, bvps))]
    return G.growth_summary(G.kpi_growth(fund(spark, rows))).first()


def test_minus_inf_mean_nulls_rule1(spark):
    # eps: 1 -> -inf-ish: make eps growth -inf by dividing -inf by a positive value
    r = _summary(spark, [1.0, -math.inf, -math.inf, -math.inf, -math.inf, -math.inf],
                 [1.0, 1.3, 1.69, 2.197, 2.8561, 3.71293])
    assert r["eps_gr_5yr"] is None          # -inf mean is cleaned afterwards
    assert r["bvps_gr_5yr"] == pytest.approx(0.3)
    assert r["rule1_gr_5yr"] is None        # but the row minimum saw -inf first


def test_summary_windows_and_counts(spark):
    eps = [1.0, 2.0, 4.0, 8.0, 16.0, 32.0, 64.0]
    r = _summary(spark, eps, eps)
    assert r["yrs_in_5yr"] == 5 and r["yrs_in_10yr"] == 7
    assert r["eps_gr_5yr"] == 1.0 and r["rule1_gr_5yr"] == 1.0 and r["pe_default_5yr"] == 200.0
    assert r["eps_curr"] == 64.0 and r["pe_5yr"] == 10.0


def test_median_variant(spark):
    rows = [("T", 2010 + i, 1.0, 1.0, e, e, 1.0, p)
            for i, (e, p) in enumerate(zip([1.0, 2.0, 2.0, 4.0, 4.0, 8.0], [1.0, 2.0, 3.0, 4.0, 100.0, 6.0]))]
    r = G.growth_summary(G.kpi_growth(fund(spark, rows)), "median").first()
    assert r["pe_5yr"] == 4.0          # median of 2, 3, 4, 100, 6
    assert r["eps_gr_5yr"] == 1.0      # median of 1, 0, 1, 0, 1


GROWTH_SCHEMA = ("ticker string, eps_curr double, rule1_gr_5yr double, pe_5yr double, "
                 "pe_default_5yr double, roic_gr_5yr double, fcf_gr_5yr double, bvps_gr_5yr double")


def sticker(spark, rows):
    return {r["ticker"]: r for r in sticker_price(spark.createDataFrame(rows, GROWTH_SCHEMA)).collect()}


def test_golden_valuations(spark):
    out = sticker(spark, [
        ("ABMD", 4.493437, 0.29, 70.63, 58.0, 0.24, 0.38, 0.29),
        ("AGYS", -1466.319459, 176.47, -28.11, 35294.0, 0.1, 0.1, 176.47),
        ("AMSC", -0.814677, None, -2.04, None, -0.56, 0.08, -0.09),
        ("NULLGATE", 4.493437, 0.29, 70.63, 58.0, 0.24, None, 0.29),
    ])
    a = out["ABMD"]
    assert a["pe_future"] == 58.0
    # eps_curr is printed at 6 dp, so the golden eps_future carries ~6e-6 of input rounding
    assert a["eps_future"] == pytest.approx(57.342389, abs=1e-5)
    assert a["price_future"] == pytest.approx(3325.86, abs=0.01)
    assert a["sticker_price"] == pytest.approx(822.10, abs=0.01)
    assert a["mos"] == pytest.approx(411.05, abs=0.01)
    for k in ("pe_future", "eps_future", "price_future", "sticker_price", "mos"):
        assert out["AGYS"][k] is None
        assert out["AMSC"][k] is None
    assert out["NULLGATE"]["price_future"] == a["price_future"]   # missing growth passes the gate


def test_sticker_from_future_price(spark):
    # price_future 11930.05 -> sticker 2948.925 / mos 1474.463 (printed unrounded)
    df = spark.createDataFrame([(11930.05,)], "price_future double")
    from valuora.functions.num import round2
    r = df.select(round2(F.col("price_future") / F.lit(1.15 ** 10)).alias("s")).first()
    assert r["s"] == pytest.approx(2948.925, abs=0.01)
    assert round(r["s"] / 2, 2) == pytest.approx(1474.463, abs=0.01)


# A printed ten-year history (fiscal years 2010-2019: roic, eps, bvps, fcf, pe) and the
# growth row printed for the same ticker. Inputs are printed at 6 dp, so growth rates
# whose denominators are tiny (eps 0.001131, roic 0.000061) can only match approximately.
HISTORY = [
    (2010, -0.023821, -0.348732, -2.237862, 168266000.0, -7.336963),
    (2011, 0.164715, 0.193509, 0.885764, 145375000.0, 11.157339),
    (2012, 1.421134, 1.584957, 0.952818, 162317000.0, 1.517580),
    (2013, 0.052150, 0.054164, 0.894521, 117082000.0, 31.540967),
    (2014, 0.036874, 0.033504, 0.807790, 114646000.0, 252.642293),
    (2015, 0.217192, 0.175981, 0.748531, 163833000.0, 34.411200),
    (2016, 0.008511, 0.156344, 1.125612, 157131000.0, 39.589143),
    (2017, 0.000061, 0.001131, 1.491550, 221545000.0, 8661.665422),
    (2018, 0.029065, 0.670134, 4.162029, 263503000.0, 17.084963),
    (2019, 0.008959, 0.297052, 4.693300, 203787000.0, 64.833997),
]


def test_golden_growth_row(spark):
    rows = [("RDNT", y, roic, 1.0, eps, bvps, fcf, pe) for y, roic, eps, bvps, fcf, pe in HISTORY]
    g = G.growth_summary(G.kpi_growth(fund(spark, rows))).first()
    exact = {"eps_curr": 0.297052, "pe_5yr": 1763.52, "pe_10yr": 910.71, "bvps_gr_5yr": 0.53,
             "bvps_gr_10yr": 0.13, "fcf_gr_5yr": 0.15, "fcf_gr_10yr": 0.05, "yrs_in_5yr": 5,
             "yrs_in_10yr": 10, "rule1_gr_5yr": 0.53, "pe_default_5yr": 106.0,
             "rule1_gr_10yr": 0.13}
    for k, v in exact.items():
        assert g[k] == pytest.approx(v, abs=1e-9), k
    approx = {"roic_gr_5yr": 95.56, "eps_gr_5yr": 118.87, "roic_gr_10yr": 52.92,
              "eps_gr_10yr": 66.52}
    for k, v in approx.items():
        assert g[k] == pytest.approx(v, rel=2e-3), k
