"""The model tables a pipeline runs on, from the test tables or files; only the statements are written when first asked for."""

from __future__ import annotations

import hashlib
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valuora.operators.company import peer_string_agg
from valuora.schemas import STATEMENT_KEYS
from valuora.session import KEPT, _tables_folder, cut_lineage, together
from valuora.sources import adapters as A


def size(spark: SparkSession, path: str) -> int:
    """Bytes of a table's files."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).getContentSummary(p).getLength()


def identity(spark: SparkSession, path: str) -> tuple:
    """What a table's files look like from outside: changed files change it, no row is read.

    The file system the path names is asked, so a table that changes between two
    queries is seen wherever it lies. For a folder these are name, size and time
    of its entries -- files, or the folders of partitions, whose time changes
    with the files in them -- and the size and number of all files below.
    """
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    st = fs.getFileStatus(p)
    if not st.isDirectory():
        return path, st.getLen(), st.getModificationTime()
    entries = sorted((e.getPath().getName(), e.getLen(), e.getModificationTime()) for e in fs.listStatus(p))
    total = fs.getContentSummary(p)
    digest = hashlib.sha256(repr(entries).encode()).hexdigest()
    return path, total.getLength(), total.getFileCount(), digest


class TestdataModel:
    """Model tables derived from the driver's tables (``/root/testdata/sf*``).

    Prices and all other tables are lazy plans over the given tables. Only what the
    three annual statements are read from (a row per ticker and year), which nearly
    every query derives, and for runs that read them several times the joined lines
    behind prices and cash flow are written once per application and used again
    as long as the files they come from are the same. A durable copy of the prices is the
    business of the ``ingest`` command, whose output a ``FileModel`` reads.
    """

    __test__ = False  # not a pytest test class despite the name
    TABLES = ("customer", "events", "lineitem", "nation", "orders", "region")
    WRITTEN = {"annual_orders": ("orders",), "cashflow": ("orders", "lineitem")}  # what the statements are read from

    def __init__(self, spark: SparkSession, sf_dir: str, until: str | None = None):
        """``until``: leave out prices from this date on (the history that days are later added to)."""
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.until = until

    def table(self, name: str) -> DataFrame:
        return A.table(self.spark, self.sf_dir, name)

    def identity(self, *tables: str) -> tuple:
        """Identity of the files that a run reads."""
        files = tuple(identity(self.spark, f"{self.sf_dir}/{t}.parquet") for t in tables or self.TABLES)
        return files if tables or self.until is None else (*files, self.until)

    def input_bytes(self) -> int:
        """Bytes of the files that a run reads."""
        return sum(size(self.spark, f"{self.sf_dir}/{t}.parquet") for t in self.TABLES)

    def _kept(self, name: str) -> tuple:
        return _tables_folder(self.spark), id(self.spark), name, self.identity(*self.WRITTEN.get(name, ("orders", "lineitem")))

    def _keep(self, name: str, build) -> DataFrame:
        key = self._kept(name)
        if key not in KEPT:
            KEPT[key] = cut_lineage(build(), name)
        return KEPT[key]

    def _write(self, name: str) -> DataFrame:
        more = {"written": KEPT.get(self._kept("lines"))} if name == "cashflow" else {}
        return self._keep(name, lambda: getattr(A, name)(self.spark, self.sf_dir, **more))

    def _statement(self, name: str) -> DataFrame:
        if name == "cashflow":
            return self._write(name)
        return getattr(A, name)(self.spark, self.sf_dir, self._write("annual_orders"))

    def prepare(self, prices: bool = False, peers: bool = False) -> None:
        """Write what the statements are read from and is not written yet, side by side.

        ``prices``: the caller reads prices too, so line items are joined to their
        orders once, for cash flow and prices (``lows``); ``peers``: and for the peers.
        """
        if prices:
            first = [lambda: self._write("annual_orders")] if self._kept("annual_orders") not in KEPT else []
            together(lambda: self._keep("lines", lambda: A.lines(self.spark, self.sf_dir, peers)), *first)
        missing = [n for n in self.WRITTEN if self._kept(n) not in KEPT]
        together(*[lambda n=n: self._write(n) for n in missing])

    def lows(self) -> DataFrame:
        """Ticker, date and low of all price rows: of the written lines, unless prices were given or planned already."""
        if "price" in self.__dict__:
            return self.price.select("ticker", "date", "low")
        written = KEPT.get(self._kept("lines"))
        return self._until(A.lows(A.lines(self.spark, self.sf_dir) if written is None else written))

    def _until(self, price: DataFrame) -> DataFrame:
        return price if self.until is None else price.where(F.col("date") < F.lit(self.until).cast("date"))

    def statement_keys(self, name: str) -> DataFrame:
        """Key columns of a statement: of the written one, else by a plan that sums no money."""
        if self._kept("cashflow" if name == "cashflow" else "annual_orders") in KEPT:
            return self._statement(name).select(*STATEMENT_KEYS)
        return getattr(A, name)(self.spark, self.sf_dir).select(*STATEMENT_KEYS)

    @cached_property
    def price(self) -> DataFrame:
        return self._until(A.price(self.spark, self.sf_dir))

    @cached_property
    def income(self) -> DataFrame:
        return self._statement("income")

    @cached_property
    def cashflow(self) -> DataFrame:
        return self._statement("cashflow")

    @cached_property
    def balance(self) -> DataFrame:
        return self._statement("balance")

    @cached_property
    def company_info(self) -> DataFrame:
        return A.company_info(self.spark, self.sf_dir)

    @cached_property
    def symbol_directory(self) -> DataFrame:
        return A.symbol_directory(self.spark, self.sf_dir)

    @property
    def peer_pairs(self) -> DataFrame:
        written = KEPT.get(self._kept("lines"))
        if written is None or "peer_key" not in written.columns:
            return A.peer_pairs(self.spark, self.sf_dir)
        return written.select(F.col("o_custkey").alias("ticker_key"), "peer_key")

    @property
    def peers(self) -> DataFrame:
        return peer_string_agg(self.peer_pairs)

    @cached_property
    def ticker_market(self) -> DataFrame:
        return A.ticker_market(self.spark, self.sf_dir)

    @cached_property
    def markets(self) -> DataFrame:
        return A.markets(self.spark, self.sf_dir)

    @cached_property
    def industries(self) -> DataFrame:
        return A.industries(self.spark, self.sf_dir)

    @cached_property
    def companies(self) -> DataFrame:
        return A.companies(self.spark, self.sf_dir)

    @cached_property
    def daily_drop(self) -> DataFrame:
        return A.daily_drop(self.spark, self.sf_dir)


FORMATS = ("parquet", "csv", "price_table", "per_symbol_csv", "statements")


class FileModel:
    """Model tables read from files in the reference's layout.

    ``paths`` maps table names (price, income, cashflow, balance, company_info,
    peers, symbol_directory, companies, industries, markets, ticker_market) to
    files or folders on any file system Spark reads. A value is a path or
    ``{"path": ..., "format": ...}``; without a format, paths that end in
    ``.csv`` or ``.txt`` are CSV and all others Parquet. Formats:

    * ``parquet``, ``csv``: a table, columns under model or vendor names;
    * ``price_table``: the date-partitioned table that ``ingest`` writes;
    * ``per_symbol_csv``: vendor price files without a ticker column, the symbol
      being the file's name;
    * ``statements``: a folder partitioned by statement, variant and market;
      ``{"market": ..., "variant": ...}`` choose the source (all markets and
      ``annual`` by default).
    """

    __test__ = False

    def __init__(self, spark: SparkSession, paths: dict):
        self.spark = spark
        self.sources = {name: self._source(v) for name, v in paths.items()}

    @staticmethod
    def _source(value) -> dict:
        src = {"path": value} if isinstance(value, str) else dict(value)
        src.setdefault("format", "csv" if src["path"].endswith((".csv", ".txt")) else "parquet")
        if src["format"] not in FORMATS:
            raise ValueError(f"unknown format {src['format']!r}; one of {', '.join(FORMATS)}")
        return src

    def _read(self, name: str) -> DataFrame:
        from valuora.schemas import MODEL_TYPES, snake
        from valuora.sinks import DISPLAY_NAMES
        from valuora.sources.files import read_statement
        src = self.sources[name]
        if src["format"] == "statements":
            df = read_statement(self.spark, src["path"], name, src.get("market"), src.get("variant", "annual"))
        elif src["format"] == "csv":
            df = self.spark.read.option("header", True).option("inferSchema", False).csv(src["path"])
        else:
            df = self.spark.read.parquet(src["path"])
        back = {v: k for k, v in DISPLAY_NAMES.items()}
        out = []
        for c, t in df.dtypes:
            col_name = back.get(c, snake(c))
            col = F.col(f"`{c}`")
            if t == "string" and col_name in MODEL_TYPES:   # text sources: declared model types
                col = col.cast(MODEL_TYPES[col_name])
            out.append(col.alias(col_name))
        return df.select(*out)

    def identity(self) -> tuple:
        """Identity of the files that a run reads."""
        return tuple((n, identity(self.spark, s["path"])) for n, s in sorted(self.sources.items()))

    def input_bytes(self) -> int:
        """Bytes of the files that a run reads."""
        return sum(size(self.spark, s["path"]) for s in self.sources.values())

    def statement_keys(self, name: str) -> DataFrame:
        return getattr(self, name).select(*STATEMENT_KEYS)

    def _has(self, name: str) -> bool:
        return name in self.sources

    @cached_property
    def price(self) -> DataFrame:
        from valuora.sources.files import ingest_price_files, read_price_table, read_prices_csv
        src = self.sources["price"]
        read = {"csv": read_prices_csv, "per_symbol_csv": ingest_price_files, "price_table": read_price_table}
        return read[src["format"]](self.spark, src["path"]) if src["format"] in read else self._read("price")

    @cached_property
    def income(self) -> DataFrame:
        return self._read("income")

    @cached_property
    def cashflow(self) -> DataFrame:
        return self._read("cashflow")

    @cached_property
    def balance(self) -> DataFrame:
        return self._read("balance")

    @cached_property
    def company_info(self) -> DataFrame:
        from valuora.sources.files import read_company_info
        src = self.sources["company_info"]
        return read_company_info(self.spark, src["path"]) if src["format"] == "csv" else self._read("company_info")

    @cached_property
    def peers(self) -> DataFrame:
        if not self._has("peers"):   # optional: results then carry no peer columns
            raise AttributeError("no peers table given")
        from valuora.sources.files import read_peers
        src = self.sources["peers"]
        peers = read_peers(self.spark, src["path"]) if src["format"] == "csv" else self._read("peers")
        return peers.select("ticker", "peer_string")

    @cached_property
    def symbol_directory(self) -> DataFrame:
        from valuora.sources.files import read_symbol_directory
        return read_symbol_directory(self.spark, self.sources["symbol_directory"]["path"])

    @cached_property
    def companies(self) -> DataFrame:
        return self._read("companies")

    @cached_property
    def industries(self) -> DataFrame:
        return self._read("industries")

    @cached_property
    def markets(self) -> DataFrame:
        return self._read("markets")

    @cached_property
    def ticker_market(self) -> DataFrame:
        if self._has("ticker_market"):
            return self._read("ticker_market")
        return self.companies.select("ticker", "market").distinct()
