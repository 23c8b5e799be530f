"""Invariants of the pipeline outputs at sf0.01."""
import math

from pyspark.sql import functions as F

from valuora.operators.quality import duplicate_keys
from valuora.plans.model import TestdataModel
from valuora.plans.oracle import PERIOD
from valuora.plans.jobs import single_market

SF = "/root/testdata/sf0.01"


def test_pipeline_invariants(spark):
    r = single_market(TestdataModel(spark, SF), PERIOD)
    g = r.growth.cache()
    # 0 < mos <= sticker_price <= price_future whenever present
    bad = g.where(F.col("mos").isNotNull() & ~((F.col("mos") > 0)
                                               & (F.col("mos") <= F.col("sticker_price"))
                                               & (F.col("sticker_price") <= F.col("price_future"))))
    assert bad.count() == 0
    # every growth row has five years in its 5-year window
    assert g.where(F.col("yrs_in_5yr") != 5).count() == 0
    # keys are unique
    assert duplicate_keys(g, ["ticker"]).count() == 0
    assert duplicate_keys(r.fundamental, ["ticker", "fiscal_year"]).count() == 0
    # the screener only lists valued, priced tickers at or below their mos
    s = r.screener
    assert s.join(g.where(F.col("mos").isNotNull()), "ticker", "left_anti").count() == 0
    assert s.join(r.price, "ticker", "left_anti").count() == 0
    assert s.where(F.col("last_low_price") > F.col("mos")).count() == 0
    # no NaN and no infinity in the growth table (inf is cleaned), none in fundamentals' ratios
    for c, t in g.dtypes:
        if t == "double":
            vals = [row[0] for row in g.select(c).collect()]
            assert not any(v is not None and (math.isnan(v) or math.isinf(v)) for v in vals), c
    for c in ("roic", "pe", "mean_low_price"):
        assert r.fundamental.where(F.isnan(c)).count() == 0, c
    g.unpersist()
