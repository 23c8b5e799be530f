"""Stored runs: result tables, price states and figures in one folder, resumable and maintainable.

``run_and_store`` writes a run's tables one after the other. A table is done when
its entry stands in the run's manifest; an entry holds the identity of the files
the run reads, the run's parameters and the figures (rows, tickers, ranges) that
were gathered while the table was written. A run that broke off goes on with the
first table that has no entry, a finished run of the same inputs and parameters
does nothing, and any other inputs or parameters start over.

``apply_day`` takes a day's prices into a stored run without reading the prices
before them: the states merge, the latest rows are replaced, and fundamentals,
growth and screener follow from stored tables. Every application writes a new
version of what it changes and then its entry, so one that breaks off leaves the
version before it whole, and a batch that was applied already is left out.

The result tables stand in the run's folder; the manifest (a folder of small JSON
files), the states and the applied days stand in its state folder, by default
beside it (``<folder>.state``). Spark's own writers write all tables.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from valuora import sinks
from valuora.operators import prices as P
from valuora.operators import screen as S
from valuora.operators import states as ST
from valuora.operators import valuation as V
from valuora.plans import jobs as J
from valuora.session import buckets_for, dealt_buckets, read_table, together, write_dealt

RESULTS = ("company_info", "fundamental", "growth", "screener")
DEALT = ("fundamental_kpi", "price_states", "price_latest", "fundamental", "growth")  # joined and grouped by ticker
INNER = ("fundamental_kpi", "price_states", "price_latest", "mm_states")  # tables that no check asks about
RANGES = {"date": "date", "last_date": "date", "fiscal_year": "fiscal_year"}
FIGURES = ("table_name string, n_rows bigint, n_symbols bigint, min_date date, max_date date, "
           "min_fiscal_year int, max_fiscal_year int")


def state_of(base: str) -> str:
    return f"{base.rstrip('/')}.state"


class Manifest:
    """Entries of finished tables, one JSON file each."""

    def __init__(self, spark: SparkSession, state: str):
        self._spark, self._dir = spark, f"{state}/_manifest"

    def _path(self, name: str):
        return self._spark._jvm.org.apache.hadoop.fs.Path(f"{self._dir}/{name}.json")

    def _fs(self, path):
        return path.getFileSystem(self._spark._jsparkSession.sessionState().newHadoopConf())

    def read(self, name: str) -> dict | None:
        path = self._path(name)
        fs = self._fs(path)
        if not fs.exists(path):
            return None
        file = fs.open(path)
        try:
            return json.loads(self._spark._jvm.org.apache.commons.io.IOUtils.toString(file, "UTF-8"))
        finally:
            file.close()

    def write(self, name: str, entry: dict) -> None:
        """Whole or not at all: written beside its name, then renamed."""
        path, new = self._path(name), self._path(f".{name}-new")
        fs = self._fs(path)
        out = fs.create(new, True)
        out.write(bytearray(json.dumps(entry).encode()))
        out.close()
        fs.delete(path, False)
        fs.rename(new, path)

    def clear(self) -> None:
        path = self._spark._jvm.org.apache.hadoop.fs.Path(self._dir)
        self._fs(path).delete(path, True)


def observed(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` with row count and ranges gathered while it is written."""
    seen = Observation()
    text = lambda c: F.col(c).cast("string") if RANGES[c] == "date" else F.col(c)  # noqa: E731 - for JSON
    ranges = [f(text(c)).alias(f"{n}_{RANGES[c]}") for c in df.columns if c in RANGES
              for n, f in (("min", F.min), ("max", F.max))]
    return df.observe(seen, F.count(F.lit(1)).alias("n_rows"), *ranges), seen


def write_figured(df: DataFrame, path: str, compression: str = "gzip", symbols: bool = True, buckets: int = 0) -> dict:
    """Write a table, dealt out by ticker into ``buckets`` if given, and return its figures.

    Rows and ranges are observed by the write itself; the distinct tickers, if
    asked for, are counted in the ticker column of what was just written.
    """
    df, seen = observed(df)
    if buckets:
        write_dealt(df, path, buckets, compression=compression)
    else:
        sinks.write_table(df, path, compression)
    figures = dict(seen.get)
    if symbols and "ticker" in df.columns:
        figures["n_symbols"] = read_table(df.sparkSession, path).agg(F.count_distinct("ticker")).first()[0]
    return figures


def _named(parameters: dict) -> str:
    return hashlib.sha256(json.dumps(parameters, sort_keys=True, default=str).encode()).hexdigest()


class Stages:
    """The tables of a run in the order they are written."""

    def __init__(self, spark: SparkSession, base: str, parameters: dict, compression: str = "gzip", fresh: bool = False,
                 buckets: int = 0):
        self._buckets = buckets  # of the tables that are dealt out by ticker
        self._spark, self.base, self._compression = spark, base.rstrip("/"), compression
        self.state = state_of(base)
        self.manifest, self._key = Manifest(spark, self.state), _named(parameters)
        self.written: list[str] = []  # by this call
        run = self.manifest.read("run")
        if fresh or run is None or run["key"] != self._key:
            self.manifest.clear()
            self.manifest.write("run", {"key": self._key, "parameters": json.loads(json.dumps(parameters, default=str))})

    def path(self, name: str) -> str:
        return f"{self.base if name in RESULTS else self.state}/{name}"

    def table(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The written table; built and written unless its entry says that this is done."""
        if self.manifest.read(name) is None:
            figures = write_figured(build(), self.path(name), self._compression, name not in INNER, self._buckets if name in DEALT else 0)
            self.manifest.write(name, {"table_name": name, **figures})
            self.written.append(name)
        return read_table(self._spark, self.path(name))


    def entry(self, name: str, build: Callable[[], DataFrame]) -> None:
        """Figures of something that is not written, as one row."""
        if self.manifest.read(name) is None:
            row = build().first().asDict()
            self.manifest.write(name, {"table_name": name, **{k: v if isinstance(v, int | None) else str(v) for k, v in row.items()}})
            self.written.append(name)


def run_and_store(model, out_dir: str, period: tuple[int | None, int | None],
                  fp: int = V.DEFAULT_FP, exp_rr: float = V.DEFAULT_EXP_RR,
                  symbols: DataFrame | None = None, agg_func: str = "mean",
                  compression: str = "gzip", market: str | None = None) -> dict[str, str]:
    """The processing job with its result tables written to ``out_dir``; returns their paths.

    Each table is written and read back before the next step uses it, so the
    written table (on the shared file system) cuts the lineage: losing an
    executor later re-runs only the current step, and losing the driver only
    the current table. Beside the four results stand the KPI fundamentals, the
    price states and the latest price rows, from which ``apply_day`` goes on.
    Line items are joined to their orders once; of what that wrote, prices are
    read twice: for the states and for the latest rows.
    """
    spark = model.spark
    parameters = {"job": "single", "inputs": model.identity() if hasattr(model, "identity") else None, "period": period,
                  "fp": fp, "exp_rr": exp_rr, "agg_func": agg_func, "market": market}
    # without an identity, or with symbols from elsewhere, nothing tells whether the inputs are the same
    st = Stages(spark, out_dir, parameters, compression, fresh=parameters["inputs"] is None or symbols is not None,
                buckets=buckets_for(spark, model.input_bytes() if hasattr(model, "input_bytes") else None))
    r = J.single_market(model, period, fp, exp_rr, symbols, agg_func, market)
    def kpi_table() -> DataFrame:
        return st.table("fundamental_kpi", lambda: J.kpi_fundamentals(model, period, J.companies_for(model, symbols, market)))

    def states_table() -> DataFrame:
        return st.table("price_states", lambda: ST.price_states(J.lows(model)))

    if not all(st.manifest.read(n) for n in ("company_info", "fundamental_kpi", "price_states", "price_latest")):
        J.prepare_all(model, peers=True)
    # what does not depend on each other is written side by side
    _, kpi, states = together(lambda: st.table("company_info", lambda: r.company_info), kpi_table, states_table)
    wanted = kpi.select("ticker").distinct()
    fundamental = st.table("fundamental", lambda: J.priced_fundamentals(kpi, states, period))
    growth, latest, _ = together(
        lambda: st.table("growth", lambda: J.valued_growth(fundamental, agg_func, fp, exp_rr)),
        lambda: st.table("price_latest", lambda: latest_of(J.lows(model), wanted)),
        lambda: st.entry("price", lambda: ST.price_figures(J.FU.restrict(states, wanted))))
    st.table("screener", lambda: screener_of(latest, growth))
    return {n: st.path(n) for n in RESULTS}


def latest_of(price: DataFrame, tickers: DataFrame) -> DataFrame:
    """(ticker, last_date, last_low_price): the tickers' price rows on their latest dates.

    Every task keeps its own latest rows of a ticker, and only those are shuffled
    and narrowed to the wanted tickers.
    """
    # an inner join, as Spark would narrow all price rows before the window by a semi join
    return P.latest_price(price.where(F.col("date").isNotNull())).join(tickers.distinct(), "ticker")


def screener_of(latest: DataFrame, growth: DataFrame) -> DataFrame:
    """The screener from stored latest rows: rows of a ticker meet its one valuation."""
    valued = growth.select(*S.VALUATION_COLUMNS).where(F.col("mos").isNotNull())
    return (latest.join(valued, "ticker").where(F.col("last_low_price") <= F.col("mos"))
            .select(*S.SCREENER_COLUMNS).na.drop())


def store_multi(model, out_dir: str, excluded, fp: int = V.DEFAULT_FP, exp_rr: float = V.DEFAULT_EXP_RR,
                agg_func: str = "mean", compression: str = "gzip") -> dict[str, str]:
    """The multi-market run with the table after each of its steps written to ``out_dir``."""
    from valuora.operators import multimarket as MM
    parameters = {"job": "multi", "inputs": model.identity() if hasattr(model, "identity") else None,
                  "excluded": sorted(excluded), "fp": fp, "exp_rr": exp_rr, "agg_func": agg_func}
    st = Stages(model.spark, out_dir, parameters, compression, fresh=parameters["inputs"] is None)
    made: list = []

    def inputs():
        if not made:
            made.append(MM.multi_market_inputs(model, excluded))
        return made[0]

    merged = st.table("fundamental_merged", lambda: inputs()["fundamental_raw"])
    states = st.table("mm_states", lambda: inputs()["states"])
    fund = st.table("after_annual_pe", lambda: J.FU.add_annual_pe(J.FU.add_kpis(merged), ST.annual_of(states, how="min")))
    rates = st.table("after_growth_rates", lambda: J.G.growth_rates(fund, agg_func))
    companies = MM.kept_companies(model, excluded)
    st.table("after_latest_price", lambda: MM.flagged(rates, J.lows(model), states, companies, fp, exp_rr))
    return {n: st.path(n) for n in ("fundamental_merged", "after_annual_pe", "after_growth_rates", "after_latest_price")}


def figures(spark: SparkSession, base: str, tables) -> DataFrame:
    """The figures of stored tables, as gathered when they were written; no table is read."""
    manifest = Manifest(spark, state_of(base))
    rows = []
    for name in tables:
        e = manifest.read(name)
        if e is None:
            raise FileNotFoundError(f"{base}: no finished table {name}")
        rows.append(json.dumps({"table_name": name, **e}))
    return (spark.createDataFrame([(r,) for r in rows], "entry string")
            .select(F.from_json("entry", FIGURES).alias("e")).select("e.*"))


# --- a day's prices ---------------------------------------------------------

MAINTAINED = ("price_states", "price_latest", "fundamental", "growth", "screener")


def current(spark: SparkSession, base: str) -> dict[str, str]:
    """Paths of a stored run's tables, those of the last applied day where it changed them."""
    day, state = Manifest(spark, state_of(base)).read("days"), state_of(base)
    paths = {n: f"{base.rstrip('/')}/{n}" for n in RESULTS}
    paths |= {n: f"{state}/{n}" for n in ("fundamental_kpi", "price_states", "price_latest")}
    return paths | ({n: f"{state}/days/v={day['version']}/{n}" for n in MAINTAINED} if day else {})


def apply_day(spark: SparkSession, base: str, batch: DataFrame, batch_id: str) -> dict[str, str]:
    """Take a batch of price rows into the stored run at ``base``; returns the tables' paths.

    The result is what a run over all prices so far would store. ``batch_id``
    names the delivery: one that was applied before changes nothing. Days may
    come in any order.
    """
    manifest = Manifest(spark, state_of(base))
    run, done = manifest.read("run"), manifest.read("days") or {"applied": []}
    if batch_id in done["applied"]:
        return current(spark, base)
    p = run["parameters"]
    paths = current(spark, base)
    stored = {n: read_table(spark, at) for n, at in paths.items()}
    buckets = dealt_buckets(spark, paths["price_states"]) or buckets_for(spark, None)
    version = len(done["applied"])
    to = {n: f"{state_of(base)}/days/v={version}/{n}" for n in MAINTAINED}
    kpi = stored["fundamental_kpi"]
    batch = batch.select("ticker", "date", "low")

    def put(name: str, df: DataFrame) -> DataFrame:
        if name in DEALT:
            write_dealt(df, to[name], buckets)
        else:
            sinks.write_table(df, to[name])
        return read_table(spark, to[name])

    # the stored tables are dealt out by ticker: of this, only the batch's rows are shuffled
    states = put("price_states", ST.merge_states(stored["price_states"], ST.price_states(batch).repartition(buckets, "ticker")))
    new = P.latest_rows(J.FU.restrict(batch, kpi.select("ticker").distinct())).select("ticker", F.col("date").alias("last_date"), F.col("low").alias("last_low_price"))
    latest = put("price_latest", P.latest_rows(stored["price_latest"].unionByName(new.repartition(buckets, "ticker")), order="last_date"))
    fundamental = put("fundamental", J.priced_fundamentals(kpi, states, p["period"]))
    growth = put("growth", J.valued_growth(fundamental, p["agg_func"], p["fp"], p["exp_rr"]))
    put("screener", screener_of(latest, growth))
    manifest.write("days", {"applied": [*done["applied"], batch_id], "version": version})
    return current(spark, base)
