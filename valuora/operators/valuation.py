"""Rule-#1 sticker price and margin of safety (pure Column arithmetic per ticker)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuora.functions.num import false_if_null, null_first_min, positive_or_null, round2

DEFAULT_FP = 10
DEFAULT_EXP_RR = 0.15


def sticker_price(growth: DataFrame, fp: int = DEFAULT_FP,
                  exp_rr: float = DEFAULT_EXP_RR) -> DataFrame:
    """Adds pe_future, eps_future, price_future, sticker_price, mos.

    pe_future    = positive part of min(pe_5yr, pe_default_5yr); a missing pe_5yr
                   gives NULL, a missing default gives pe_5yr (Python ``min``)
    eps_future   = positive part of eps_curr * (1 + rule1_gr_5yr)^fp
    price_future = pe_future * eps_future, NULL when roic, fcf or bvps 5-year
                   growth is negative (missing growth passes), rounded to 2 dp
    sticker      = price_future / (1 + exp_rr)^fp, rounded; mos = sticker / 2, rounded
    """
    discount = (1 + exp_rr) ** fp  # folded in Python, exactly as the reference computes it
    pe_future = positive_or_null(null_first_min(F.col("pe_5yr"), F.col("pe_default_5yr")))
    eps_future = positive_or_null(F.col("eps_curr")
                                  * F.pow(F.lit(1.0) + F.col("rule1_gr_5yr"), F.lit(float(fp))))
    failed = (false_if_null(F.col("roic_gr_5yr") < 0)
              | false_if_null(F.col("fcf_gr_5yr") < 0)
              | false_if_null(F.col("bvps_gr_5yr") < 0))
    price_future = round2(F.when(~failed, pe_future * eps_future))
    sticker = round2(price_future / F.lit(discount))
    # one projection; the dependent columns repeat their inputs' expressions,
    # which codegen's common-subexpression elimination evaluates once
    return growth.withColumns({"pe_future": pe_future, "eps_future": eps_future,
                               "price_future": price_future, "sticker_price": sticker,
                               "mos": round2(sticker / 2)})
