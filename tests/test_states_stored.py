"""Price states, stored runs that resume, and days taken into them."""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from valuora.operators import prices as P
from valuora.operators import states as ST
from valuora.plans import stored as SR
from valuora.plans.model import TestdataModel
from valuora.plans.oracle import PERIOD

SF = "/root/testdata/sf0.001"
PRICE = "date date, ticker string, low double"


def rows_of(rng, n, first=dt.date(2018, 11, 1), days=800):
    """Random price rows: lows are multiples of 1/64 (sums are exact), some null, some dates missing or repeated."""
    out = []
    for _ in range(n):
        d = first + dt.timedelta(days=rng.randrange(days))
        if rng.random() < 0.5:
            d = d.replace(month=12)
        out.append((None if rng.random() < 0.03 else d, rng.choice("ABCDEFG"),
                    None if rng.random() < 0.05 else rng.randrange(1, 9999) / 64))
    return out


def table(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("seed", range(2))
def test_states_give_what_prices_give(spark, seed):
    rows = rows_of(random.Random(seed), 400)
    price = spark.createDataFrame(rows, PRICE).repartition(5)
    states = ST.price_states(price)
    for how in ("mean", "min"):
        want = P.annual_price(price, 2018, 2020, how)
        assert table(ST.annual_of(states, 2018, 2020, how)) == table(want)
    assert table(ST.dates_of(states)) == table(P.latest_dates(price))
    stats, got = P.price_stats(price).first(), ST.price_figures(states).first()
    assert tuple(stats) == (got.n_rows, got.n_symbols, got.min_date, got.max_date)
    parts = [spark.createDataFrame(rows[a:a + 90], PRICE) for a in range(0, 400, 90)]
    assert table(ST.merge_states(*map(ST.price_states, parts))) == table(states)


def test_states_are_a_hash_aggregate(spark):
    price = spark.createDataFrame(rows_of(random.Random(1), 50), PRICE)
    plan = ST.price_states(price)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan and "partial_max" in plan


def test_no_prices(spark):
    none = spark.createDataFrame([], PRICE)
    assert table(ST.price_states(none)) == [] and ST.price_figures(ST.price_states(none)).first().n_rows is None


class Cut(TestdataModel):
    """The test tables with other prices."""

    def __init__(self, spark, price):
        super().__init__(spark, SF)
        self.__dict__["price"] = price

    def identity(self, *tables):
        return super().identity(*tables) if tables else None


def test_days_in_any_order_equal_a_full_run(spark, tmp):
    """Batches of mixed days, one delivered twice, on top of a stored history."""
    rng = random.Random(4)
    m = TestdataModel(spark, SF)
    price = m.price.select("date", "ticker", (F.round(F.col("low") * 64) / 64).alias("low")).cache()
    part = F.pmod(F.xxhash64("ticker", "date"), F.lit(9))
    SR.run_and_store(Cut(spark, price.where(part >= 3)), f"{tmp}/run", PERIOD)
    order = [0, 1, 2, 1]
    rng.shuffle(order)
    for k in order:
        SR.apply_day(spark, f"{tmp}/run", price.where(part == k), f"day-{k}")
    SR.run_and_store(Cut(spark, price), f"{tmp}/full", PERIOD)
    day, full = SR.current(spark, f"{tmp}/run"), SR.current(spark, f"{tmp}/full")
    assert day["growth"] != f"{tmp}/run/growth" and full["growth"] == f"{tmp}/full/growth"
    for name in SR.MAINTAINED:
        a, b = spark.read.parquet(day[name]), spark.read.parquet(full[name])
        assert table(a.select(*b.columns)) == table(b), name
    assert spark.read.parquet(full["screener"]).count() > 0
    price.unpersist()


def test_a_broken_run_goes_on(spark, tmp, monkeypatch):
    """A run that breaks off between tables is continued: finished tables are not written again."""
    m, out = TestdataModel(spark, SF), f"{tmp}/run"
    calls, write = [], SR.write_figured

    def failing(df, path, *a):
        name = path.rsplit("/", 1)[1]
        if name == "growth":
            raise RuntimeError("the driver is lost")
        calls.append(name)
        return write(df, path, *a)
    monkeypatch.setattr(SR, "write_figured", failing)
    with pytest.raises(RuntimeError):
        SR.run_and_store(m, out, PERIOD)
    assert "fundamental" in calls and "screener" not in calls
    first = set(calls)

    def counting(df, path, *a):
        calls.append(path.rsplit("/", 1)[1])
        return write(df, path, *a)
    monkeypatch.setattr(SR, "write_figured", counting)
    calls.clear()
    paths = SR.run_and_store(m, out, PERIOD)
    assert set(calls) == {"company_info", "fundamental_kpi", "price_states", "fundamental", "growth", "price_latest",
                          "screener"} - first
    calls.clear()
    SR.run_and_store(m, out, PERIOD)
    assert calls == []  # the same inputs and parameters: nothing to do
    figures = {r.table_name: r for r in SR.figures(spark, out, ("price", *SR.RESULTS)).collect()}
    for name in SR.RESULTS:
        df = spark.read.parquet(paths[name])
        assert figures[name].n_rows == df.count() and figures[name].n_symbols == df.select("ticker").distinct().count()
    years = spark.read.parquet(paths["fundamental"]).agg(F.min("fiscal_year"), F.max("fiscal_year")).first()
    assert (figures["fundamental"].min_fiscal_year, figures["fundamental"].max_fiscal_year) == tuple(years)
    SR.run_and_store(m, out, PERIOD, fp=9)  # other parameters: all tables anew
    assert set(calls) >= {"company_info", "growth", "screener"}
    with pytest.raises(FileNotFoundError):
        SR.figures(spark, f"{tmp}/none", ("growth",))


def test_changed_inputs_start_over(spark, tmp):
    """The identity of a table follows its files; dropped tables are forgotten."""
    import os
    import shutil

    from valuora.plans.model import identity
    os.makedirs(f"{tmp}/t/p=1")
    shutil.copy(f"{SF}/region.parquet", f"{tmp}/t/p=1/a.parquet")
    one = identity(spark, f"{tmp}/t")
    assert one == identity(spark, f"{tmp}/t")
    shutil.copy(f"{SF}/nation.parquet", f"{tmp}/t/p=1/b.parquet")
    assert one != identity(spark, f"{tmp}/t")
    from valuora.session import KEPT, _tables_folder, drop_tables
    m = TestdataModel(spark, SF)
    assert m.balance.count() > 0
    drop_tables(spark)
    assert not any(k[0] == _tables_folder(spark) for k in KEPT)
    assert TestdataModel(spark, SF).balance.count() > 0
