"""Statement merge, per-year KPIs and the annual P/E."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuora.functions.num import ieee_div, null_if_zero
from valuora.operators.quality import one_row_per_key
from valuora.schemas import STATEMENT_KEYS


def restrict(df: DataFrame, symbols: DataFrame | None, col: str = "ticker") -> DataFrame:
    """Keep rows whose ``col`` is in the one-column ``symbols`` frame (left semi join)."""
    if symbols is None:
        return df
    return df.join(symbols.select(F.col(symbols.columns[0]).alias(col)), col, "left_semi")


def common_tickers(*dfs: DataFrame, col: str = "ticker") -> DataFrame:
    """Tickers present in every input, as chained semi joins of distinct sets."""
    sets = [d.select(col).where(F.col(col).isNotNull()).distinct() for d in dfs]
    return reduce(lambda a, b: a.join(b, col, "left_semi"), sets)


def _suffix_overlap(left: DataFrame, right: DataFrame, keys: list[str],
                    suffixes: tuple[str, str]) -> tuple[DataFrame, DataFrame]:
    overlap = (set(left.columns) & set(right.columns)) - set(keys)
    ls = left.select(*[F.col(f"`{c}`").alias(c + suffixes[0] if c in overlap else c)
                       for c in left.columns])
    rs = right.select(*[F.col(f"`{c}`").alias(c + suffixes[1] if c in overlap else c)
                        for c in right.columns])
    return ls, rs


def combine_statements(income: DataFrame, cashflow: DataFrame, balance: DataFrame,
                       symbols: DataFrame | None = None,
                       keys: list[str] | None = None) -> DataFrame:
    """income JOIN cashflow JOIN balance on the statement keys (all 1:1, inner).

    Overlapping columns of income and cashflow get ``_is``/``_cf``; balance
    columns keep bare names, since after the first merge nothing collides
    with them (any later collision gets ``_x``/``_y``). Restricting to tickers
    in all three statements is implied by the inner joins; ``symbols``
    narrows further with a semi join. Each statement must hold a key once; a
    repeated key fails the query.
    """
    keys = keys or STATEMENT_KEYS
    once = lambda df, name: one_row_per_key(restrict(df, symbols), keys, name)
    inc, cf = _suffix_overlap(once(income, "income"), once(cashflow, "cashflow"), keys, ("_is", "_cf"))
    merged = inc.join(cf, keys, "inner")
    merged, bal = _suffix_overlap(merged, once(balance, "balance"), keys, ("_x", "_y"))
    return merged.join(bal, keys, "inner")


def add_kpis(df: DataFrame) -> DataFrame:
    """roic, eps, bvps, fcf (the reference's top-5 KPI step; revenue is carried).

    roic = (net income + dividends paid, missing = 0) / total liabilities & equity (0 -> NULL)
    eps  = net income / shares (balance-sheet copy), IEEE: x/0 = +-inf, 0/0 = NULL
    bvps = total equity / shares, IEEE
    fcf  = operating cash - investing cash
    """
    div_clean = F.coalesce(F.col("dividends_paid"), F.lit(0.0))
    # one projection (one analysis of the plan) for all five columns
    return df.withColumns({
        "dividends_paid_clean": div_clean,
        "roic": (F.col("net_income") + div_clean) / null_if_zero(F.col("total_liab_equity")),
        "eps": ieee_div(F.col("net_income"), F.col("shares_basic")),
        "bvps": ieee_div(F.col("total_equity"), F.col("shares_basic")),
        "fcf": F.col("net_cash_ops") - F.col("net_cash_inv"),
    })


def add_annual_pe(fundamental: DataFrame, annual: DataFrame) -> DataFrame:
    """Left join the annual price on (ticker, fiscal year); pe = price / eps (eps 0 -> NULL).

    The annual prices of a ticker, one a year, come as one list, from which each
    year takes its own: the join is on the ticker alone, by which narrowed
    fundamentals are dealt out already, so these are not shuffled once more.
    """
    lists = annual.groupBy("ticker").agg(F.collect_list(F.struct("year", "mean_low_price")).alias("_annual"))
    rest = [c for c in fundamental.columns if c not in ("ticker", "fiscal_year")]
    of_year = F.filter("_annual", lambda a: a["year"] == F.col("fiscal_year"))
    out = (fundamental.join(lists, "ticker", "left").withColumn("_a", F.explode_outer(of_year))
           .select("ticker", "fiscal_year", *[F.col(f"`{c}`") for c in rest], F.col("_a.mean_low_price").alias("mean_low_price")))
    return out.withColumn("pe", F.col("mean_low_price") / null_if_zero(F.col("eps")))
