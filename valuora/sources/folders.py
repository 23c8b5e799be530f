"""Folders of very many small files: tasks list, read and write them.

Spark's file index holds every file it reads on the driver, and lists a folder of folders in
up to 10,000 tasks. Its writer sets the mode of each folder and file, for which Hadoop starts a
process where its native library is missing. Neither suits a folder and a file per symbol. On a
file system that executors reach by plain paths (``file:``) the functions here do that work in
Python tasks, and the driver holds nothing per file. ``local`` says if they can; callers
leave any other file system to Spark's own readers and writers.

Names are Spark's: ``key=value`` folders with its escapes, ``part-`` files, and names that start with
``_`` or ``.`` are hidden.
"""

from __future__ import annotations

import os
import re
import shutil
import sys
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from valuora.session import remove_folder

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have this package

NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
ESCAPED = re.compile("[\x01-\x1f\"#%'*/:=?\\\\\x7f{\\[\\]^]")
PIECE = 32 * 1024 ** 2  # bytes of a file that one task reads
BATCH = 5_000           # lines or files handed to Spark at once
BLANK = bytes(range(33))  # what Java's trim takes off


def local(spark: SparkSession, path: str) -> str | None:
    """The plain path of an existing folder on a ``file:`` file system; else None."""
    if any(c in path for c in "*?[]{}\\"):
        return None  # a pattern
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    uri = fs.makeQualified(p).toUri()
    return uri.getPath() if uri.getScheme() == "file" and fs.exists(p) and fs.getFileStatus(p).isDirectory() else None


def local_new(spark: SparkSession, path: str) -> str | None:
    """As ``local``, of a folder that is made if it does not exist."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if fs.makeQualified(p).toUri().getScheme() != "file":
        return None
    fs.mkdirs(p)
    return local(spark, path)


def _tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# ---------------------------------------------------------------- listing

def _seen(name: str) -> bool:
    hidden = name.startswith(".") or name.endswith("._COPYING_") or (name.startswith("_") and "=" not in name)
    return not hidden or name.startswith(("_common_metadata", "_metadata"))


def _below(path: str) -> Iterator[tuple[str, int, int]]:
    """(path, size, milliseconds) of a file, or of the files below a folder."""
    if os.path.isdir(path):
        with os.scandir(path) as found:
            for e in found:
                if _seen(e.name):
                    yield from _below(e.path)
    else:
        try:
            st = os.stat(path)
        except FileNotFoundError:
            return  # gone meanwhile, or a link to nothing
        yield path, st.st_size, st.st_mtime_ns // 1_000_000


def _batches(rows: Iterator[tuple], kinds: dict) -> Iterator[pa.RecordBatch]:
    some = []
    for r in rows:
        some.append(r)
        if len(some) == BATCH:
            yield _batch(some, kinds)
            some = []
    if some:
        yield _batch(some, kinds)


def _batch(rows: list[tuple], kinds: dict) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds.values(), strict=True)], names=list(kinds))


def _top(folder: str):
    def run(batches):
        for b in batches:
            if b.num_rows:
                with os.scandir(folder) as found:
                    yield from _batches(((e.path,) for e in found if _seen(e.name)), {"path": pa.string()})
    return run


def _walk(batches):
    rows = (r for b in batches for p in b.column(0).to_pylist() for r in _below(p))
    yield from _batches(rows, {"path": pa.string(), "size": pa.int64(), "ms": pa.int64()})


def files_below(spark: SparkSession, folder: str) -> DataFrame:
    """(path, size, ms) of all files below a local folder: one task names what is in it, many look into that."""
    top = spark.range(0, 1, 1, 1).mapInArrow(_top(folder), "path string")
    return top.repartition(_tasks(spark)).mapInArrow(_walk, "path string, size long, ms long")


# ---------------------------------------------------------------- reading

def _lines(path: str, start: int, end: int) -> Iterator[bytes]:
    """Lines that start in a piece of a file, blank ones and the header left out."""
    with open(path, "rb") as f:
        if start:
            f.seek(start - 1)
            f.readline()
        header, at = start == 0, f.tell()
        while at < end:
            raw = f.readline()
            if not raw:
                return
            if at == 0 and raw.startswith(b"\xef\xbb\xbf"):
                raw = raw[3:]
            at = f.tell()
            for line in raw.replace(b"\r\n", b"\n").replace(b"\r", b"\n").split(b"\n"):
                if line.strip(BLANK):
                    if header:
                        header = False
                    else:
                        yield line


def _read(batches):
    def rows():
        for b in batches:
            for path, start, end in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                for line in _lines(path, start, end):
                    yield path, line.decode("utf-8", "replace")
    yield from _batches(rows(), {"path": pa.string(), "line": pa.string()})


def read_lines(files: DataFrame) -> DataFrame:
    """(path, line) of the files (path, size): lines without each file's header. Long files are read in pieces."""
    at = F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(PIECE).cast("long")))
    pieces = (files.where("size > 0").select("path", "size", at.alias("at"))
              .select("path", "at", F.least(F.col("at") + PIECE, F.col("size")).alias("end")))
    return pieces.repartition(_tasks(files.sparkSession)).mapInArrow(_read, "path string, line string")


def folder_value(path: Column, key: str) -> Column:
    """The value that a ``key=value`` folder on a path is named after, null if it stands for none."""
    raw = F.regexp_extract(path, f"/{re.escape(key)}=([^/]+)/[^/]*$", 1)
    plain = F.try_url_decode(F.replace(raw, F.lit("+"), F.lit("%2B")))
    return F.when(raw != NO_VALUE, F.coalesce(plain, raw))


# ---------------------------------------------------------------- writing

def _name(value: str | None) -> str:
    return ESCAPED.sub(lambda m: f"%{ord(m[0]):02X}", value) if value else NO_VALUE


def _remove(path: str) -> None:
    try:
        shutil.rmtree(path) if os.path.isdir(path) else os.unlink(path)
    except FileNotFoundError:
        pass  # another task or attempt was first


def _write(folder: str, key: str, ending: str, header: str | None, job: str, replace: bool):
    def run(batches):
        part, attempt = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()
        last, out, n = None, None, 0
        file = lambda at: f"{at}/part-{part:05d}-{job}.{ending}"
        draft = lambda at: f"{at}/.part-{part:05d}-{job}.{attempt}"
        try:
            for b in batches:
                for value, line in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                    at = f"{folder}/{key}={_name(value)}"
                    if at != last:
                        if out:
                            out.close()
                            os.replace(draft(last), file(last))
                        os.makedirs(at, exist_ok=True)
                        for old in os.listdir(at) if replace else ():
                            if job not in old:
                                _remove(f"{at}/{old}")
                        last, out, n = at, open(draft(at), "w", encoding="utf-8", newline=""), n + 1
                        if header is not None:
                            out.write(header + "\n")
                    out.write(f"{line}\n" if line is not None else "\n")
            if out:
                out.close()
                os.replace(draft(last), file(last))
        except BaseException:
            if out:
                out.close()
                _remove(draft(last))
            raise
        yield _batch([(n,)], {"n": pa.int64()})
    return run


def write_by_key(df: DataFrame, folder: str, key: str, order: list[str], line: Column, ending: str = "csv",
                 header: str | None = None, mode: str = "overwrite") -> bool:
    """Write ``line`` of all rows to a folder per value of ``key``, rows ranged by ``order``; False if the folder is not local.

    ``overwrite`` removes all that was in the folder, ``replace`` the files of the values that are written, ``append`` none.
    """
    spark = df.sparkSession
    at = local_new(spark, folder)
    if at is None:
        return False
    if mode == "overwrite":
        remove_folder(spark, folder)
        local_new(spark, folder)
    ranged = df.repartitionByRange(_tasks(spark), *order).sortWithinPartitions(*order).select(key, line.alias("line"))
    ranged.mapInArrow(_write(at, key, ending, header, uuid.uuid4().hex, mode == "replace"), "n long").agg(F.sum("n")).collect()
    done = spark._jvm.org.apache.hadoop.fs.Path(folder, "_SUCCESS")
    done.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).create(done, True).close()
    return True
