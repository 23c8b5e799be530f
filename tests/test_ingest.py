"""Ingest by manifest: accounts of a delivery, and replacement of changed symbols only."""
import datetime as dt
import os
import time

import pytest

from valuora.sources import ingest as I

HEAD = "Date,Open,High,Low,Close,Adj Close,Volume\n"


def put(folder, name, *lines, at=None):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write("".join(lines))
    if at:
        os.utime(f"{folder}/{name}", (at, at))


def line(day, low):
    return f"2020-12-{day:02d},1.0,2.0,{low},1.5,1.5,100\n"


def accounts(manifest):
    return {os.path.basename(r.file): (r.ticker, r.status, r.n_rows, r.n_rejected, r.replaced) for r in manifest.collect()}


def stored(spark, table):
    return sorted((r.ticker, r.date.day, r.low) for r in I.read_ingested(spark, table).collect())


def test_delivery_by_delivery(spark, tmp):
    src, table = f"{tmp}/vendor", f"{tmp}/price"
    old = time.time() - 1000
    put(src, "AAA.csv", HEAD, line(1, 10.0), line(2, 11.0), at=old)
    put(src, "B B.csv", HEAD, line(1, 20.0), at=old)
    put(src, "C.D.csv", HEAD, line(1, 30.0), "not,a price\n", at=old)
    put(src, "EEE.csv", HEAD, at=old)
    put(src, "FFF.csv", at=old)
    put(src, "GGG.csv", "Too many requests\n", "please try again\n", at=old)
    m = I.ingest(spark, src, table, buckets=4)
    assert accounts(m) == {"AAA.csv": ("AAA", "loaded", 2, 0, True), "B B.csv": ("B B", "loaded", 1, 0, True),
                           "C.D.csv": ("C.D", "partial", 1, 1, True), "EEE.csv": ("EEE", "empty", 0, 0, True),
                           "FFF.csv": ("FFF", "empty", 0, 0, True), "GGG.csv": ("GGG", "unreadable", 0, 1, True)}
    report = {r.status: (r.n_files, r.n_symbols, r.n_rows) for r in I.delivery_report(m).collect()}
    assert report == {"loaded": (2, 2, 3), "partial": (1, 1, 1), "empty": (2, 2, 0), "unreadable": (1, 1, 0), "valid": (3, 3, 4)}
    assert stored(spark, table) == [("AAA", 1, 10.0), ("AAA", 2, 11.0), ("B B", 1, 20.0), ("C.D", 1, 30.0)]

    # the next delivery: one symbol changed, one gone, one new; nothing else is read
    put(src, "AAA.csv", HEAD, line(3, 12.0))
    os.remove(f"{src}/B B.csv")
    put(src, "HHH.csv", HEAD, line(1, 40.0))
    m = I.ingest(spark, src, table, buckets=4)
    assert {k: v[4] for k, v in accounts(m).items()} == {"AAA.csv": True, "C.D.csv": False, "EEE.csv": False,
                                                        "FFF.csv": False, "GGG.csv": False, "HHH.csv": True}
    assert stored(spark, table) == [("AAA", 3, 12.0), ("C.D", 1, 30.0), ("HHH", 1, 40.0)]

    # the same delivery again changes nothing
    before = {f: os.stat(os.path.join(d, f)).st_mtime for d, _, fs in os.walk(table) for f in fs if f.startswith("part-")}
    assert not any(v[4] for v in accounts(I.ingest(spark, src, table, buckets=4)).values())
    assert before == {f: os.stat(os.path.join(d, f)).st_mtime for d, _, fs in os.walk(table) for f in fs if f.startswith("part-")}


def test_a_broken_ingest_is_repeated(spark, tmp, monkeypatch):
    """The manifest is written last: an ingest that broke off reads the same files again."""
    src, table = f"{tmp}/vendor", f"{tmp}/price"
    put(src, "A.csv", HEAD, line(1, 1.0))
    I.ingest(spark, src, table, buckets=2)
    put(src, "B.csv", HEAD, line(1, 2.0))
    replace = I._replace

    def lost(*a):
        replace(*a)
        raise RuntimeError("the driver is lost")
    monkeypatch.setattr(I, "_replace", lost)
    with pytest.raises(RuntimeError):
        I.ingest(spark, src, table, buckets=2)
    monkeypatch.setattr(I, "_replace", replace)
    m = I.ingest(spark, src, table, buckets=2)
    assert accounts(m)["B.csv"] == ("B", "loaded", 1, 0, True)
    assert stored(spark, table) == [("A", 1, 1.0), ("B", 1, 2.0)]


def test_a_symbol_of_several_files_is_read_whole(spark, tmp):
    src, table = f"{tmp}/vendor", f"{tmp}/price"
    old = time.time() - 1000
    put(f"{src}/symbol=A", "one.csv", HEAD, line(1, 1.0), at=old)
    put(f"{src}/symbol=A", "two.csv", HEAD, line(2, 2.0), at=old)
    put(f"{src}/symbol=B", "one.csv", HEAD, line(1, 5.0), at=old)
    I.ingest(spark, src, table, I.FOLDER, buckets=2)
    put(f"{src}/symbol=A", "two.csv", HEAD, line(2, 3.0))
    m = I.ingest(spark, src, table, I.FOLDER, buckets=2)
    assert {(r.ticker, r.replaced) for r in m.collect()} == {("A", True), ("B", False)}
    assert stored(spark, table) == [("A", 1, 1.0), ("A", 2, 3.0), ("B", 1, 5.0)]


def test_empty_delivery(spark, tmp):
    put(f"{tmp}/vendor", "A.csv", HEAD)
    m = I.ingest(spark, f"{tmp}/vendor", f"{tmp}/price", buckets=2)
    assert accounts(m) == {"A.csv": ("A", "empty", 0, 0, True)}
    assert m.first().first_date is None and isinstance(m.first().modified, dt.datetime)
