"""Adapters from the driver's TPC-H-like tables to the valuation model.

A ticker is a customer. The model tables (price, the three annual statements,
company info, symbol directory, peers, markets, industries, the daily price
drop) are derived here as lazy Spark plans, so every query's work grows with
the given tables. The mapping is documented in FIXTURES.md section 2; the SQL
mirror of each adapter lives in ``valuora.plans.oracle``.

Money is summed as DECIMAL(18,2) and cast to double afterwards, so the sums are
exact and identical in every engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from valuora.schemas import STATEMENT_KEYS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _money(c: str) -> Column:
    return F.col(c).cast("decimal(18,2)")


def _sum_money(c: Column) -> Column:
    return F.sum(c).cast("double")


def _ticker(c: str) -> Column:
    return F.col(c).cast("string")


def price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily prices: one row per line item; ticker = customer, date = ship date."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate",
                                                  "l_extendedprice", "l_quantity")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    j = li.join(od, li.l_orderkey == od.o_orderkey, "inner")
    px = F.col("l_extendedprice")
    return j.select(
        F.col("l_shipdate").cast("date").alias("date"),
        _ticker("o_custkey").alias("ticker"),
        px.alias("open"), px.alias("high"), px.alias("low"), px.alias("close"),
        px.alias("adj_close"), F.col("l_quantity").alias("volume"))


def lines(spark: SparkSession, sf_dir: str, peers: bool = False) -> DataFrame:
    """What prices and cash flow (and ``peers``) know of a line item, narrowed before the join."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.col("l_shipdate").cast("date").alias("date"), F.col("l_extendedprice").alias("low"),
        (F.col("l_linestatus") == "O").alias("is_open"), (F.col("l_returnflag") == "R").alias("is_returned"),
        *([F.col("l_suppkey").alias("peer_key")] if peers else []))
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("fiscal_year"),
                                                F.col("o_orderdate").cast("date").alias("order_date"))
    return li.join(od, li.l_orderkey == od.o_orderkey).drop("l_orderkey", "o_orderkey")


def lows(lines: DataFrame) -> DataFrame:
    """Ticker, date and low of the price rows."""
    return lines.select(_ticker("o_custkey").alias("ticker"), "date", "low")


def _orders_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (table(spark, sf_dir, "orders")
            .select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                    "o_orderdate", "o_orderpriority")
            .withColumn("fiscal_year", F.year("o_orderdate")))


def _statement_keys() -> list[Column]:
    return [_ticker("o_custkey").alias("ticker"),
            F.col("o_custkey").alias("simfin_id"),
            F.lit("USD").alias("currency"),
            F.col("fiscal_year")]


def annual_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What income and balance know of a customer's orders of a year."""
    od = _orders_by_year(spark, sf_dir)
    sign = (F.when(F.col("o_orderstatus") == "P", 2)
             .when(F.col("o_orderstatus") == "F", 1)
             .when(F.col("o_orderstatus") == "O", -1)
             .otherwise(0))
    pr = F.col("o_orderpriority")
    agg = od.groupBy("o_custkey", "fiscal_year").agg(
        F.max(F.col("o_orderdate").cast("date")).alias("report_date"),
        (F.count(F.lit(1)) * 10).cast("double").alias("shares_issued"),
        _sum_money(_money("o_totalprice")).alias("revenue"),
        _sum_money(_money("o_totalprice") * sign).alias("net_income"),
        (F.sum(F.when(pr != "1-URGENT", 1).otherwise(0)) * 10).cast("double")
        .alias("shares_held"),
        _sum_money(_money("o_totalprice")
                   * F.when(pr.isin("1-URGENT", "2-HIGH"), 2).otherwise(1))
        .alias("total_equity"),
        _sum_money(F.when(F.col("o_orderstatus") != "O", _money("o_totalprice") * 4)
                   .otherwise(F.lit(0).cast("decimal(18,2)")))
        .alias("total_liab_equity"))
    return agg.select(*_statement_keys(), F.lit("FY").alias("fiscal_period"), *agg.columns[2:])


def income(spark: SparkSession, sf_dir: str, written: DataFrame | None = None) -> DataFrame:
    """``written``: the annual orders, if they are written already."""
    agg = annual_orders(spark, sf_dir) if written is None else written
    return agg.select(*STATEMENT_KEYS, "fiscal_period", "report_date",
                      F.col("shares_issued").alias("shares_basic"), "revenue", "net_income")


def balance(spark: SparkSession, sf_dir: str, written: DataFrame | None = None) -> DataFrame:
    """``written``: the annual orders, if they are written already."""
    agg = annual_orders(spark, sf_dir) if written is None else written
    return agg.select(*STATEMENT_KEYS, "fiscal_period", "report_date",
                      F.col("shares_held").alias("shares_basic"), "total_equity", "total_liab_equity")


def cashflow(spark: SparkSession, sf_dir: str, written: DataFrame | None = None) -> DataFrame:
    """``written``: the lines, if they are written already."""
    j = lines(spark, sf_dir) if written is None else written
    amt = _money("low")
    agg = j.groupBy("o_custkey", "fiscal_year").agg(
        F.max("order_date").alias("report_date"),
        (F.count(F.lit(1)) * 10).cast("double").alias("shares_basic"),
        _sum_money(amt).alias("net_cash_ops"),
        (-F.sum(F.when(F.col("is_open"), amt))).cast("double")
        .alias("net_cash_inv"),
        (-F.sum(F.when(F.col("is_returned"), amt))).cast("double")
        .alias("dividends_paid"))
    return agg.select(*_statement_keys(), F.lit("FY").alias("fiscal_period"),
                      "report_date", "shares_basic", "net_cash_ops", "net_cash_inv",
                      "dividends_paid")


def ticker_market(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ticker, market): market = region of the customer's nation.

    nation (25 rows) and region (5 rows) are fixed-size dimensions, so the
    broadcast is bounded by construction.
    """
    cu = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    na = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    rg = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    dims = F.broadcast(na.join(rg, na.n_regionkey == rg.r_regionkey))
    return (cu.join(dims, cu.c_nationkey == dims.n_nationkey)
            .select(_ticker("c_custkey").alias("ticker"), F.col("r_name").alias("market")))


def company_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    cu = table(spark, sf_dir, "customer")
    na = table(spark, sf_dir, "nation")
    rg = table(spark, sf_dir, "region")
    dims = F.broadcast(na.join(rg, na.n_regionkey == rg.r_regionkey))
    return (cu.join(dims, cu.c_nationkey == dims.n_nationkey)
            .select(_ticker("c_custkey").alias("ticker"),
                    F.col("c_name").alias("company_name"),
                    F.col("n_name").alias("industry"),
                    F.col("c_mktsegment").alias("sector"),
                    F.col("r_name").alias("market"),
                    F.col("c_acctbal").alias("market_cap")))


def symbol_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    cu = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    fin = (F.when(k % 3 == 0, F.lit(None).cast("string"))
            .when((k % 3 == 1) & (k % 5 == 0), F.lit("D"))
            .otherwise(F.lit("N")))
    return cu.select(
        _ticker("c_custkey").alias("symbol"),
        F.col("c_name").alias("security_name"),
        F.when(F.col("c_mktsegment") == "FURNITURE", "Y").otherwise("N").alias("etf"),
        F.when(F.col("c_acctbal") < 0, "Y").otherwise("N").alias("test_issue"),
        fin.alias("financial_status"),
        _ticker("c_custkey").alias("nasdaq_symbol"))


def peer_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ticker_key, peer_key): the suppliers that a customer has bought from, as often as it has."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return (li.join(od, li.l_orderkey == od.o_orderkey)
            .select(F.col("o_custkey").alias("ticker_key"), F.col("l_suppkey").alias("peer_key")))


def markets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "region").select(F.col("r_name").alias("market_id"))


def industries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("industry_id"),
        F.col("n_name").alias("industry"),
        F.concat(F.lit("SECTOR-"), F.col("n_regionkey").cast("string")).alias("sector"))


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Company dimension of the multi-market variant (one row per ticker)."""
    cu = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    return (cu.join(ticker_market(spark, sf_dir),
                    _ticker("c_custkey") == F.col("ticker"))
            .select("ticker", F.col("c_custkey").alias("simfin_id"),
                    F.col("c_name").alias("company_name"),
                    F.col("c_nationkey").alias("industry_id"), "market"))


def daily_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Today's price files: the last event per user (the largest value of a tie)
    becomes that ticker's price row."""
    ev = table(spark, sf_dir, "events").select("user_id", "ts", "value")
    last = ev.groupBy("user_id").agg(F.max(F.struct("ts", "value")).alias("r"))
    low = F.col("r.value") * 1000
    return last.select(
        F.col("r.ts").cast("date").alias("date"),
        _ticker("user_id").alias("ticker"),
        low.alias("open"), low.alias("high"), low.alias("low"), low.alias("close"),
        low.alias("adj_close"), F.lit(None).cast("double").alias("volume"))


def event_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price rows of the events: the lowest value of a user and day."""
    ev = table(spark, sf_dir, "events")
    day = ev.groupBy("user_id", F.col("ts").cast("date").alias("date")).agg((F.min("value") * 1000).alias("low"))
    low = F.col("low")
    return day.select("date", _ticker("user_id").alias("ticker"), low.alias("open"), low.alias("high"), "low",
                      low.alias("close"), low.alias("adj_close"), F.lit(None).cast("double").alias("volume"))


def vendor_files(spark: SparkSession, sf_dir: str, folder: str, raised: str | None = None) -> None:
    """A delivery of vendor files, a folder per symbol: prices of every ticker; for suppliers, who have no
    prices, a file of the header only, or of an error message if their balance is negative. ``raised``: rewrite
    only tickers that end in this, at prices of one more.
    """
    from valuora.sinks import write_per_key
    px = price(spark, sf_dir)
    names = {"date": "Date", "open": "Open", "high": "High", "low": "Low", "close": "Close", "adj_close": "Adj Close",
             "volume": "Volume"}
    more = F.lit(0 if raised is None else 1)
    cols = [(F.col(c) + more if c not in ("date", "volume") else F.col(c)).alias(n) for c, n in names.items()]
    if raised is None:
        broken = F.col("s_acctbal") < 0
        text = F.when(broken, F.lit("Too many requests\nplease, try again later")).otherwise(F.lit(",".join(names.values())))
        suppliers = table(spark, sf_dir, "supplier").select(text.alias("value"), F.concat(F.lit("S"), _ticker("s_suppkey")).alias("symbol"))
        write_per_key(suppliers, folder, "symbol", fmt="text")   # the few first: Spark lists what is there before it appends
    else:
        px = px.where(F.col("ticker").endswith(raised))
    write_per_key(px.select(*cols, F.col("ticker").alias("symbol")), folder, "symbol", "Date",
                  mode="append" if raised is None else "replace")
