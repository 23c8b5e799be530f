"""Year-over-year KPI growth and the 5/10-year growth summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from valuora.functions.num import (clean_inf, nan_to_null, null_if_zero,
                                   positive_or_null, round2)
from valuora.schemas import GROWTH_KPIS

PERIODS = (5, 10)
AGG_FUNCS = {"mean": F.avg, "median": F.median}


def _w():
    return Window.partitionBy("ticker").orderBy("fiscal_year")


def kpi_growth(fundamental: DataFrame, kpis: list[str] | None = None,
               carry: tuple[str, ...] = ("pe",)) -> DataFrame:
    """Row-to-row growth of each KPI per ticker, ordered by fiscal year.

    Zeros become NULL first; each value is then divided by the last non-NULL
    value before it (the forward fill of a grouped ``pct_change``). Gaps in
    fiscal years are not bridged specially, and the denominator keeps its
    sign. inf/inf gives NaN, which is turned into NULL right away.
    Output: ticker, fiscal_year, the zero-nulled KPIs, ``<kpi>_gr`` and ``carry``.
    """
    kpis = list(kpis or GROWTH_KPIS)
    w = _w()
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    base = fundamental.select("ticker", "fiscal_year",
                              *[null_if_zero(F.col(k)).alias(k) for k in kpis],
                              *[F.col(c) for c in carry])
    gr = [nan_to_null(F.last(k, ignorenulls=True).over(upto)
                      / F.last(k, ignorenulls=True).over(before) - 1).alias(f"{k}_gr")
          for k in kpis]
    return base.select("ticker", "fiscal_year", *kpis, *gr, *carry)


def _summary_cols(period: int, agg_name: str, gr_cols: list[str],
                  in_window: Column) -> list[Column]:
    agg = AGG_FUNCS[agg_name]
    cols = [agg(F.when(in_window, F.col(c))).alias(f"{c}_{period}yr") for c in gr_cols]
    cols.append(F.count(F.when(in_window, F.col("fiscal_year"))).alias(f"yrs_in_{period}yr"))
    return cols


def growth_summary(growth_rows: DataFrame, agg_func: str = "mean",
                   periods: tuple[int, ...] = PERIODS,
                   kpis: list[str] | None = None) -> DataFrame:
    """Per ticker: the current-year KPIs and, for each N, the mean (or median) of
    every growth rate and of pe over the ticker's last N fiscal years, rounded to
    2 dp, the count of those years, the rule-1 rate and the default P/E.

    One window (max fiscal year per ticker, sharing the growth window's
    partitioning) and one grouped aggregation with conditional aggregates
    replace the reference's two group-bys and outer merges. A median only ever
    holds the <= N values of one ticker's window.

    Infinity is still present here on purpose; ``clean_inf`` runs after the
    rule-1 minimum, as in the reference.
    """
    kpis = list(kpis or GROWTH_KPIS)
    gr_cols = [f"{k}_gr" for k in kpis] + ["pe"]
    wall = _w().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    df = growth_rows.withColumn("_max_fy", F.max("fiscal_year").over(wall))
    fy, mx = F.col("fiscal_year"), F.col("_max_fy")
    curr = fy == mx
    aggs = [F.max(F.when(curr, F.col("revenue_gr"))).alias("revenue_gr_curr"),
            F.max(F.when(curr, F.col("eps"))).alias("eps_curr")]
    for n in periods:
        aggs += _summary_cols(n, agg_func, gr_cols, fy > mx - n)
    g = df.groupBy("ticker").agg(*aggs)

    out = [F.col("ticker"), F.col("revenue_gr_curr"), F.col("eps_curr")]
    for n in periods:
        vals = {c: nan_to_null(round2(F.col(f"{c}_{n}yr"))) for c in gr_cols}
        out += [vals[c].alias(f"{c}_{n}yr") for c in gr_cols]
        out.append(F.col(f"yrs_in_{n}yr"))
        rule1 = positive_or_null(F.least(vals["bvps_gr"], vals["eps_gr"]))
        out += [rule1.alias(f"rule1_gr_{n}yr"), (rule1 * 200).alias(f"pe_default_{n}yr")]
    g = g.select(*out)
    return g.select(*[clean_inf(F.col(c)).alias(c) if t == "double" else F.col(c) for c, t in g.dtypes])


def growth_rates(fundamental: DataFrame, agg_func: str = "mean",
                 min_years: int = 5) -> DataFrame:
    """The growth table: summary of every ticker with ``min_years`` years in its 5-year window."""
    summary = growth_summary(kpi_growth(fundamental), agg_func)
    return summary.where(F.col("yrs_in_5yr") == min_years)


def last_n_years(df: DataFrame, n: int) -> DataFrame:
    """Rows in each ticker's last ``n`` fiscal years (FY > max FY - n)."""
    w = Window.partitionBy("ticker")
    return (df.withColumn("_max_fy", F.max("fiscal_year").over(w))
              .where(F.col("fiscal_year") > F.col("_max_fy") - n)
              .drop("_max_fy"))


def current_year(df: DataFrame) -> DataFrame:
    """Rows of each ticker's latest fiscal year."""
    return last_n_years(df, 1)
