import os

from valuora.streaming.refresh import read_version, refresh_batch, start_refresh_stream


def _write(path, rows):
    with open(path, "w") as f:
        f.write("Date,Ticker,Open,High,Low,Close,Adj Close,Volume\n")
        for d, t, low in rows:
            f.write(f"{d},{t},{low},{low},{low},{low},{low},1\n")


def _growth(spark):
    return spark.createDataFrame([("A", 100.0, 50.0, 25.0), ("B", 10.0, 5.0, 2.5)],
                                 "ticker string, price_future double, sticker_price double, mos double")


def _screen(spark, tmp):
    return sorted((r.ticker, r.last_low_price, str(r.last_date)) for r in read_version(spark, f"{tmp}/screener").collect())


def test_daily_refresh_stream(spark, tmp):
    drop = f"{tmp}/drop"
    os.makedirs(drop)

    def run():
        q = start_refresh_stream(spark, drop, _growth(spark), f"{tmp}/latest", f"{tmp}/screener", f"{tmp}/ckpt")
        q.awaitTermination(120)

    day1 = [("2022-02-24", "A", 30.0), ("2022-02-24", "B", 2.0), ("2022-02-24", "C", 1.0)]
    _write(f"{drop}/day1.csv", day1)
    run()
    assert _screen(spark, tmp) == [("B", 2.0, "2022-02-24")]
    # next day: A drops below its mos, B rises above it
    _write(f"{drop}/day2.csv", [("2022-02-25", "A", 20.0), ("2022-02-25", "B", 3.0)])
    run()
    assert _screen(spark, tmp) == [("A", 20.0, "2022-02-25")]
    # the same files again, and an older one, change nothing
    _write(f"{drop}/day2-again.csv", [("2022-02-25", "A", 20.0), ("2022-02-25", "B", 3.0)])
    run()
    _write(f"{drop}/day1-again.csv", day1)
    run()
    assert _screen(spark, tmp) == [("A", 20.0, "2022-02-25")]
    assert len([d for d in os.listdir(f"{tmp}/latest") if d.startswith("v=")]) == 2


def test_repeats_ties_and_replays(spark, tmp):
    schema = "ticker string, date date, low double"
    batch = spark.createDataFrame([("A", 20.0), ("A", 20.0), ("A", 21.0), ("B", 1.0)], "ticker string, low double") \
        .selectExpr("ticker", "date'2022-03-01' AS date", "low")
    for epoch in (0, 1, 2):
        refresh_batch(batch, epoch, _growth(spark), f"{tmp}/latest", f"{tmp}/screener")
        # both lows of a tied day stay, each once
        assert _screen(spark, tmp) == [("A", 20.0, "2022-03-01"), ("A", 21.0, "2022-03-01"), ("B", 1.0, "2022-03-01")]
    # a corrected file replaces its day; a replayed epoch gives the same version
    fixed = spark.createDataFrame([("A", 24.0)], "ticker string, low double").selectExpr(
        "ticker", "date'2022-03-01' AS date", "low")
    for _ in range(2):
        refresh_batch(fixed, 3, _growth(spark), f"{tmp}/latest", f"{tmp}/screener")
        assert _screen(spark, tmp) == [("A", 24.0, "2022-03-01"), ("B", 1.0, "2022-03-01")]
    # a version that was not finished is not read
    os.makedirs(f"{tmp}/screener/v=9")
    assert len(_screen(spark, tmp)) == 2
    empty = spark.createDataFrame([], schema)
    refresh_batch(empty, 4, _growth(spark), f"{tmp}/latest", f"{tmp}/screener")
    assert len(_screen(spark, tmp)) == 2
