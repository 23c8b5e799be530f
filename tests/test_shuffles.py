"""Runs join line items once and shuffle a table's rows by one key where one will do; results as by joins."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

import valuora.session as S
from valuora.operators import company as C
from valuora.operators import fundamentals as FU
from valuora.plans import stored as SR
from valuora.plans.model import TestdataModel
from valuora.session import drop_tables
from valuora.sources import adapters as A

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def no_broadcast(spark):
    conf = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for k in conf:
        spark.conf.set(k, "-1")
    yield
    for k in conf:
        spark.conf.unset(k)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def tables(spark, at):
    t = dt.datetime
    orders = [(1, 7, "O", 10.0, t(2020, 12, 1), "1-URGENT"), (2, 7, "F", 20.0, t(2021, 3, 1), "2-HIGH"), (3, 8, "P", 5.0, t(2021, 1, 1), "3"),
              (4, None, "F", 1.0, t(2021, 1, 1), "3"), (5, 9, None, None, None, None)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, "
                          "o_orderpriority string").write.parquet(f"{at}/orders.parquet")
    lines = [(1, t(2020, 12, 5), 1.5, "O", "R"), (1, t(2020, 12, 5), 1.5, "O", "R"), (2, t(2021, 12, 9), None, "F", "N"), (3, None, 4.0, None, "R"),
             (4, t(2021, 1, 3), 2.0, "O", None), (None, t(2021, 1, 3), 2.0, "O", "N"), (5, t(2021, 1, 4), 3.0, "F", "N"), (6, t(2021, 1, 4), 3.0, "F", "N")]
    spark.createDataFrame(lines, "l_orderkey long, l_shipdate timestamp, l_extendedprice double, l_linestatus string, l_returnflag string") \
        .withColumn("l_quantity", F.lit(1.0)).withColumn("l_suppkey", F.col("l_orderkey") % 3).write.parquet(f"{at}/lineitem.parquet")


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_prices_and_cashflow_come_from_lines_joined_once(spark, tmp):
    tables(spark, tmp)
    plain, kept = TestdataModel(spark, tmp), TestdataModel(spark, tmp, until="2021-12-01")
    want = rows(plain.price.select("ticker", "date", "low"))
    flow, peers = rows(plain.cashflow), rows(plain.peers)
    drop_tables(spark)
    kept.prepare(prices=True)
    assert "Join" not in plan(TestdataModel(spark, tmp).lows()) and rows(TestdataModel(spark, tmp).lows()) == want
    early = [r for r in want if r[1] is not None and r[1] < dt.date(2021, 12, 1)]
    assert rows(kept.lows()) == early
    assert rows(kept.cashflow) == flow and len(want) == 6
    assert rows(kept.peers) == peers   # these lines hold no peers
    drop_tables(spark)
    kept.prepare(prices=True, peers=True)
    assert "Join" not in plan(kept.peer_pairs) and rows(kept.peers) == peers and rows(kept.lows()) == early
    drop_tables(spark)


def test_latest_rows_are_kept_before_the_shuffle(spark, no_broadcast):
    d = dt.date
    px = spark.createDataFrame([("A", d(2020, 1, 1), 1.0), ("A", d(2020, 1, 2), 2.0), ("A", d(2020, 1, 2), 3.0), ("A", None, 9.0),
                                ("B", None, 1.0), ("C", d(2020, 1, 1), None), ("D", d(2020, 1, 1), 4.0), (None, d(2020, 1, 1), 5.0)],
                               "ticker string, date date, low double").repartition(3)
    wanted = spark.createDataFrame([("A",), ("A",), ("B",), ("C",), (None,)], "ticker string")
    out = SR.latest_of(px, wanted)
    p = plan(out)
    assert p.index("WindowGroupLimit") < p.rindex("Exchange hashpartitioning(ticker")   # below, the rows of each task alone
    assert rows(out) == rows(spark.createDataFrame([("A", d(2020, 1, 2), 2.0), ("A", d(2020, 1, 2), 3.0), ("C", d(2020, 1, 1), None)],
                                                   "ticker string, last_date date, last_low_price double"))


def test_annual_prices_join_on_the_ticker_alone(spark, no_broadcast):
    fund = spark.createDataFrame([("A", 2020, 2.0), ("A", 2021, 0.0), ("A", None, 1.0), ("B", 2020, 4.0), (None, 2020, 4.0)],
                                 "ticker string, fiscal_year int, eps double")
    annual = spark.createDataFrame([(2020, "A", 10.0), (2021, "A", 11.0), (2019, "A", 9.0), (2021, "B", 3.0), (2022, "B", None), (2020, None, 7.0)],
                                   "year int, ticker string, mean_low_price double")
    out = FU.add_annual_pe(fund, annual)
    assert "fiscal_year" not in "".join(x for x in plan(out).splitlines() if "hashpartitioning" in x)
    assert out.columns == ["ticker", "fiscal_year", "eps", "mean_low_price", "pe"]
    assert rows(out) == rows(spark.createDataFrame(
        [("A", 2020, 2.0, 10.0, 5.0), ("A", 2021, 0.0, 11.0, None), ("A", None, 1.0, None, None), ("B", 2020, 4.0, None, None),
         (None, 2020, 4.0, None, None)], "t string, y int, e double, p double, pe double"))
    twice = FU.add_annual_pe(fund.where("ticker = 'B'"), annual.where("ticker = 'B'").withColumn("year", F.lit(2020)))
    assert len(rows(twice)) == 2   # a left join's rows


def test_peers_are_shuffled_once(spark, no_broadcast):
    pairs = spark.createDataFrame([(1, 10), (1, 9), (1, 10), (2, 5), (2, None), (None, 3), (4, None)], "ticker_key long, peer_key long")
    out = C.peer_string_agg(pairs)
    assert plan(out).count("Exchange hashpartitioning") == 1
    assert rows(out) == rows(spark.createDataFrame([("1", "9,10"), ("2", "5"), (None, "3"), ("4", "")], "t string, p string"))


def test_a_batch_shuffles_no_stored_table(spark, tmp, no_broadcast, monkeypatch):
    """Stored tables are dealt out by ticker: what a batch rewrites is neither joined nor grouped through a shuffle."""
    from valuora.plans.oracle import PERIOD
    SR.run_and_store(TestdataModel(spark, SF, until="2000-11-01"), f"{tmp}/run", PERIOD)
    plans, write = {}, SR.write_dealt

    def spy(df, path, buckets, *a):
        plans[path.rsplit("/", 1)[1]] = plan(df.repartition(buckets, "ticker"))
        write(df, path, buckets, *a)
    monkeypatch.setattr(SR, "write_dealt", spy)
    d = dt.date(2001, 1, 2)
    batch = spark.createDataFrame([("1", d, 2.0), ("1", d, 1.0), ("1", None, 1.0), ("none", d, 5.0), (None, d, 5.0)], "ticker string, date date, low double")
    day = SR.apply_day(spark, f"{tmp}/run", batch, "b")
    assert "Exchange" not in plans["fundamental"] + plans["growth"]
    for name in ("price_states", "price_latest"):   # only the batch's rows
        assert "Exchange" not in plans[name].split("Union")[0] and "Bucketed: true" in plans[name], plans[name]
    # the same without buckets: another application knows only the files
    drop = dict(S.DEALT)
    S.DEALT.clear()
    plain = SR.apply_day(spark, f"{tmp}/run", batch.limit(0), "c")
    S.DEALT.update({k: v for k, v in drop.items() if k not in S.DEALT})
    assert all(rows(spark.read.parquet(day[n])) == rows(spark.read.parquet(plain[n])) for n in SR.MAINTAINED)
    assert rows(spark.read.parquet(day["price_latest"]).where("ticker = '1'")) == [("1", d, 1.0), ("1", d, 2.0)]


def test_income_and_balance_come_from_orders_grouped_once(spark, tmp, no_broadcast):
    tables(spark, tmp)
    m = TestdataModel(spark, tmp)
    want = rows(A.income(spark, tmp)), rows(A.balance(spark, tmp))
    drop_tables(spark)
    m.prepare()
    assert "Aggregate" not in plan(m.income) + plan(m.balance) and (rows(m.income), rows(m.balance)) == want
    # both read one file set, whose key columns join without a second shuffle of either
    assert m.income.inputFiles() == m.balance.inputFiles()
    assert plan(FU.combine_statements(m.income, m.cashflow, m.balance)).count("Exchange") == 3
    assert [r[4:] for r in want[0] if r[0] == "7"][0][2:] == (10.0, 10.0, -10.0)
    drop_tables(spark)
