"""Folders of many small files: tasks list, read and write them, the driver holds none of them."""
import datetime as dt
import os

import pytest

from valuora import sinks
from valuora.plans import registry
from valuora.sources import files as SRC
from valuora.sources import folders
from valuora.sources import ingest as I

HEAD = "Date,Open,High,Low,Close,Adj Close,Volume\n"


def put(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "wb") as f:
        f.write(text if isinstance(text, bytes) else text.encode())


def test_an_ingest_lists_its_folders_in_few_tasks(spark, tmp):
    """Spark's file index starts a task per folder, up to 10,000, twice an ingest."""
    for k in range(120):
        put(f"{tmp}/vendor/symbol=T{k}", "one.csv", HEAD + "2020-12-01,1,2,3,4,5,6\n")
    group = f"ingest-{tmp}"
    spark.sparkContext.setJobGroup(group, "")
    try:
        manifest = I.ingest(spark, f"{tmp}/vendor", f"{tmp}/price", I.FOLDER, buckets=2)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    stages = [s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
    tasks = [i.numTasks for i in map(tracker.getStageInfo, stages) if i]
    assert tasks and max(tasks) < 100
    assert manifest.where("status = 'loaded'").count() == 120


def test_price_files_are_read_back_without_an_index_on_the_driver(spark, tmp):
    spark.createDataFrame([(k, dt.datetime(2024, 1, 1 + k % 5), k % 30, float(k)) for k in range(90)],
                          "event_id long, ts timestamp, user_id long, value double").write.parquet(f"{tmp}/events.parquet")
    back = registry.queries()["price_files"](spark, tmp)
    assert back.inputFiles() == []
    got = sorted((r.ticker, r.low) for r in back.collect())
    last = {u: max((1 + k % 5, float(k)) for k in range(90) if k % 30 == u)[1] * 1000 for u in range(30)}
    assert got == sorted((str(u), v) for u, v in last.items())


def price(spark, rows):
    return spark.createDataFrame([(dt.date(2024, 1, d), t, 0.1, 1e-7, low, None, 1e22, float("nan")) for d, t, low in rows],
                                 "date date, ticker string, open double, high double, low double, close double, "
                                 "adj_close double, volume double")


SYMBOLS = ["A", "B B", "C/D", "E=F%", "100%25", "G+H", "é", "_x", ".y", "", None, "q\"'"]


def test_symbols_are_written_and_read_as_by_spark(spark, tmp):
    px = price(spark, [(1 + k % 3, t, float(k)) for k, t in enumerate(SYMBOLS * 4)])
    sinks.write_per_symbol_csv(px, f"{tmp}/ours")
    sinks.by_symbol(px, "ticker", "date").mode("overwrite").option("header", True).csv(f"{tmp}/sparks")
    names = lambda at: {d for d in os.listdir(at) if d.startswith("ticker=")}
    assert names(f"{tmp}/ours") == names(f"{tmp}/sparks") and os.path.exists(f"{tmp}/ours/_SUCCESS")
    rows = lambda df: sorted(map(repr, df.collect()))
    read = spark.read.option("header", True).schema(px.schema)
    theirs = rows(read.csv(f"{tmp}/sparks").select(*px.columns))
    assert len(theirs) == 4 * len(SYMBOLS)
    assert rows(read.csv(f"{tmp}/ours").select(*px.columns)) == theirs
    assert rows(SRC.read_per_symbol_csv(spark, f"{tmp}/ours")) == theirs
    assert rows(SRC.read_per_symbol_csv(spark, f"{tmp}/sparks")) == theirs


def test_writes_replace_append_or_overwrite(spark, tmp):
    def got():
        return sorted(((r.ticker or ""), r.low) for r in SRC.read_per_symbol_csv(spark, f"{tmp}/p").collect())
    write = lambda rows, mode: sinks.write_per_key(price(spark, rows), f"{tmp}/p", "ticker", "date", mode=mode)
    write([(1, "A", 1.0), (1, None, 2.0)], "overwrite")
    write([(2, "B", 3.0), (2, None, 4.0)], "append")
    assert got() == [("", 2.0), ("", 4.0), ("A", 1.0), ("B", 3.0)]
    write([(3, "A", 5.0)], "replace")
    assert got() == [("", 2.0), ("", 4.0), ("A", 5.0), ("B", 3.0)]
    write([(3, "C", 6.0)], "overwrite")
    assert got() == [("C", 6.0)]


@pytest.mark.parametrize("piece", [folders.PIECE, 64])
def test_odd_files_are_read_as_by_spark(spark, tmp, monkeypatch, piece):
    monkeypatch.setattr(folders, "PIECE", piece)
    src = f"{tmp}/vendor"
    row = lambda d: f"2020-12-{d:02d},1.0,2.0,{d}.5,1.5,1.5,100"
    put(src, "LONG.csv", HEAD + "".join(row(1 + k % 28) + "\n" for k in range(40)))
    put(src, "CRLF.csv", "\r\n \r\n" + HEAD.strip() + "\r\n" + row(1) + "\r\n\r\n" + row(2))
    put(src, "BOM.csv", b"\xef\xbb\xbf" + HEAD.encode() + row(3).encode())
    put(src, "BAD.csv", "Too many requests\nplease, try again\n\xff,1\n2020-13-45,x,2,3,4,5,6\n2020-12-09,1\n\"2020-12-10\",\"1\",2,3,4,5,6,7\n")
    put(src, "EMPTY.csv", "")
    put(src, "HEAD.csv", HEAD)
    put(src, "_hidden.csv", HEAD + row(4))
    os.symlink(f"{tmp}/nothing", f"{src}/LINK.csv")
    put(f"{src}/sub", "a b+%41.csv", HEAD + row(5) + "\n")
    found = I.list_files(spark, src)
    assert sorted(r.ticker for r in found.collect()) == ["BAD", "BOM", "CRLF", "EMPTY", "HEAD", "LONG", "a b+%41"]
    ours, theirs = I.read_listed(found), I.read_files(spark, src)
    assert sorted(ours.columns) == sorted(theirs.columns) and len(theirs.collect()) == 49
    assert sorted(map(repr, ours.collect())) == sorted(map(repr, theirs.select(*ours.columns).collect()))
    with monkeypatch.context() as m:   # as on a file system that is not local
        m.setattr(folders, "local", lambda *a: None)
        index = I.list_files(spark, src)
    assert sorted(map(repr, found.collect())) == sorted(map(repr, index.select(*found.columns).collect()))


def test_another_file_system_is_left_to_spark(spark, tmp, monkeypatch):
    monkeypatch.setattr(folders, "local", lambda *a: None)
    px = price(spark, [(1, "A", 1.0), (2, "B", 2.0)])
    sinks.write_per_symbol_csv(px, f"{tmp}/p")
    assert any(f.endswith(".crc") for f in os.listdir(f"{tmp}/p/ticker=A"))
    back = SRC.read_per_symbol_csv(spark, f"{tmp}/p")
    assert sorted(r.low for r in back.collect()) == [1.0, 2.0] and back.inputFiles()
    put(f"{tmp}/vendor", "A.csv", HEAD + "2020-12-01,1,2,3,4,5,6\n")
    put(f"{tmp}/vendor", "B.csv", HEAD)
    for _ in range(2):
        assert I.ingest(spark, f"{tmp}/vendor", f"{tmp}/price", buckets=2).count() == 2
    assert I.read_ingested(spark, f"{tmp}/price").count() == 1
