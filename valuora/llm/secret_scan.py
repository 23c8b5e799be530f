r"""Secret scan: fixed rules plus a randomness test battery, in DataFrame functions.

*Rules.* Assignments to a password-like name, access key ids and long
lower-case hex runs (``ASSIGN``, ``ACCESS``, ``HEX``), each leftmost and
non-overlapping per kind; matches that fail a kind's length rule are dropped.

*Battery.* Every further run of 20 or more key characters that mixes letters
and digits (or cases) is a candidate. Its encoding is inferred (hex, base 32,
36, 62 or 64) and three tests ask whether it could be random over that
alphabet: chi-squared uniformity of the characters, runs about the alphabet's
middle, and lag-one serial correlation. Under the uniform null all moments used
are exact: chi-squared's mean, variance and skewness (its tail is a gamma's, by
the cube-root rule), the variances of the runs and of the serial sum, and their
correlation, which is taken out of the serial test. Fisher's method combines
the p-values, and ``LIFT`` makes up for what the three tails still share in
short strings: over each alphabet the share of random strings at or below p is p
at 0.05, 0.01 and 0.001 (``tests/llm/test_battery.py``). How much a test sees depends on length, so the candidates of the
whole corpus are judged per length band: the Benjamini-Hochberg step-up at
``ALPHA`` decides which candidates are dismissed as structured, so that among
the dismissed the expected share of random strings is ``ALPHA`` at most. The
others are reported as ``random``. A run that a rule's match cuts gives each of
its remaining pieces of 20 or more key characters as a candidate.

The p-values meet as counts per band and hundredth of a decade, a table of
bounded size.

Defined results: a null or empty text has no spans; every row gives one row,
null and repeated ids included; an empty table gives an empty result; extra
columns are ignored (``redact`` keeps those of ``docs``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import spans as S
from .shared import cut_lineage

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"    # of AKIA[A-Z0-9]+ those of 20 characters or more
HEX = r"[0-9a-f]{24,}"           # of [0-9a-f]+ those of 24 characters or more
RUN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}"
SHORTEST = 20                    # of a run's characters without "="
ALPHA = 0.05
LIFT = 0.0186                    # of the log of p, at 20 characters; less by length ^ 0.75
BANDS = (20, 32, 48, 96)         # shortest lengths of the bands
BINS = 3000                      # hundredths of a decade of p

_ALPHABETS = {
    "hex": (16, "0123456789abcdef"),
    "base32": (32, "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    "base36": (36, "0123456789abcdefghijklmnopqrstuvwxyz"),
    "base62": (62, "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    "base64": (64, "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
}


def _text(col: str) -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def base_spans(text: Column) -> Column:
    """The rules' spans ``array<s, rank, e, kind>`` sorted by start, then kind as listed."""
    assign = F.filter(S.matches(text, r"(?=[pPsStTaA])" + ASSIGN),
                      lambda x: F.length(F.regexp_extract(x["v"], ASSIGN, 2)) >= 6)
    access = S.matches(text, ACCESS, F.contains(text, F.lit("AKIA")))
    return F.array_sort(F.concat(S.named(assign, "assign", 0), S.named(access, "access", 1),
                                 S.named(S.matches(text, HEX), "hex", 2)))


def _erfc(x: str) -> str:
    """Complementary error function for x >= 0 (Abramowitz and Stegun 7.1.26)."""
    t = f"(1 / (1 + 0.3275911D * {x}))"
    return (f"({t} * (0.254829592D + {t} * (-0.284496736D + {t} * (1.421413741D + {t} * "
            f"(-1.453152027D + {t} * 1.061405429D)))) * exp(-least({x} * {x}, 700D)))")


def tested(runs: str) -> str:
    """SQL of ``array<s, e, p>``: the battery's combined p-value of each run of column ``runs``."""
    k = "CASE enc " + " ".join(f"WHEN '{n}' THEN {s}" for n, (s, _) in _ALPHABETS.items()) + " END"
    letters = "CASE enc " + " ".join(f"WHEN '{n}' THEN '{a}'" for n, (_, a) in _ALPHABETS.items()) + " END"
    enc = ("CASE WHEN w RLIKE '^([0-9a-f]+|[0-9A-F]+)$' THEN 'hex' WHEN w RLIKE '^[A-Z2-7]+$' THEN 'base32' "
           "WHEN w RLIKE '^([0-9a-z]+|[0-9A-Z]+)$' THEN 'base36' WHEN w RLIKE '^[0-9A-Za-z]+$' THEN 'base62' ELSE 'base64' END")
    mixed = "x.v RLIKE '[0-9]' AND x.v RLIKE '[A-Za-z]' OR x.v RLIKE '([a-z][A-Z].*){3}'"

    def over(array: str, body: str) -> str:
        return f"transform({array}, x -> {body})"

    a = f"filter({runs}, x -> {mixed})"
    a = over(a, "named_struct('s', x.s, 'e', x.e, 'w', translate(rtrim('=', x.v), '-_', '+/'))")
    a = over(a, f"named_struct('s', x.s, 'e', x.e, 'w', x.w, 'enc', {enc.replace('w RLIKE', 'x.w RLIKE')})")
    case = "CASE x.enc WHEN 'hex' THEN lower(x.w) WHEN 'base36' THEN lower(x.w) ELSE x.w END"
    a = over(a, f"named_struct('s', x.s, 'e', x.e, 'w', {case}, 'k', {k.replace('CASE enc', 'CASE x.enc')}, "
                f"'abc', {letters.replace('CASE enc', 'CASE x.enc')})")
    a = over(a, "named_struct('s', x.s, 'e', x.e, 'k', x.k, 'n', CAST(length(x.w) AS DOUBLE), "
                "'v', transform(sequence(1, length(x.w)), i -> CAST(locate(substring(x.w, i, 1), x.abc) - 1 AS DOUBLE)))")
    a = over(a, "named_struct('s', x.s, 'e', x.e, 'k', CAST(x.k AS DOUBLE), 'n', x.n, "
                "'sq', aggregate(sequence(0, x.k - 1), 0D, (t, c) -> t + pow(size(filter(x.v, u -> u = c)), 2)), "
                "'pairs', zip_with(slice(x.v, 1, size(x.v) - 1), slice(x.v, 2, size(x.v) - 1), "
                "(u, w) -> named_struct('u', 2 * u - x.k + 1, 'w', 2 * w - x.k + 1)))")
    a = over(a, "named_struct('s', x.s, 'e', x.e, 'k', x.k, 'n', x.n, 'sq', x.sq, "
                "'sd', sqrt(2 * (x.k - 1) * (1 - 1 / x.n)), "
                "'third', 4 * (x.n - 1) * (x.k - 1) * (x.k + 2 * x.n - 6) / (x.n * x.n), "
                "'rho', 0.75D * x.k * x.k / (x.k * x.k - 1), "
                "'run', aggregate(x.pairs, 0D, (t, y) -> t + sign(y.u) * sign(y.w)) / sqrt(x.n - 1), "
                "'ser', aggregate(x.pairs, 0D, (t, y) -> t + y.u * y.w) * 3 / (x.k * x.k - 1) / sqrt(x.n - 1))")
    # standard scores: chi-squared as a gamma variable of shape root^2, what the runs do not tell of the serial sum
    a = over(a, "named_struct('s', x.s, 'e', x.e, 'n', x.n, 'run', abs(x.run), "
                "'ser', abs(x.ser - x.rho * x.run) / sqrt(1 - x.rho * x.rho), 'root', 2 * pow(x.sd, 3) / x.third, "
                "'chi', (x.k / x.n * x.sq - x.n - (x.k - 1)) / x.sd)")
    a = over(a, "named_struct('s', x.s, 'e', x.e, 'n', x.n, 'run', x.run, 'ser', x.ser, "
                "'chi', 3 * x.root * (cbrt(greatest(1 + x.chi / x.root, 0D)) - 1 + 1 / (9 * x.root * x.root)))")
    p = lambda z, side: f"greatest({side} * {_erfc(f'({z} / sqrt(2D))')}, 1e-290D)"
    upper = f"IF(x.chi >= 0, {p('x.chi', '0.5D')}, 1 - {p('-x.chi', '0.5D')})"
    a = over(a, f"named_struct('s', x.s, 'e', x.e, 'n', x.n, 'h', -(ln({upper}) + ln({p('x.run', '1D')}) + ln({p('x.ser', '1D')})))")
    a = over(a, "named_struct('s', x.s, 'e', x.e, 'n', x.n, 'l', x.h - ln(1 + x.h + x.h * x.h / 2))")
    return over(a, f"named_struct('s', x.s, 'e', x.e, 'p', exp(-x.l * pow(1 + {LIFT}D * pow(20 / x.n, 0.75D) * x.l * x.l, -1 / 6D)))")


def _band(length: Column) -> Column:
    out = F.lit(BANDS[0])
    for low in BANDS[1:]:
        out = F.when(length >= low, F.lit(low)).otherwise(out)
    return out


def _bin(p: Column) -> Column:
    return F.least(F.floor(-F.log10(F.greatest(p, F.lit(1e-300))) * 100), F.lit(BINS)).cast("int")


def thresholds(pieces: DataFrame) -> dict[int, int]:
    """Per band, the first bin of p-values that Benjamini-Hochberg dismisses; ``pieces(band, bin)``."""
    counts = pieces.groupBy("band", "bin").count()
    below = Window.partitionBy("band").orderBy(F.desc("bin"))  # at most BINS + 1 rows a band
    ranked = (counts.withColumn("k", F.sum("count").over(below))
              .withColumn("m", F.sum("count").over(Window.partitionBy("band"))))
    first = (ranked.where(F.pow(F.lit(10.0), -F.col("bin") / 100) <= ALPHA * F.col("k") / F.col("m"))
             .groupBy("band").agg(F.min("bin").alias("bin")))
    return {r["band"]: r["bin"] for r in first.collect()}  # one row a band


def _pieces(run: Column) -> Column:
    """What the rules' spans leave of a run: its pieces of ``SHORTEST`` or more key characters, as runs."""
    inside = F.filter("base", lambda b: (b["s"] < run["e"]) & (run["s"] < b["e"]))  # sorted by start

    def left(s: Column, e: Column) -> Column:
        v = F.substr(run["v"], s - run["s"] + 1, F.greatest(e - s, F.lit(0)))
        piece = F.struct(s.alias("s"), e.alias("e"), v.alias("v"), run["ctx"].alias("ctx")).cast(S.SPAN)
        return F.when(F.length(F.rtrim(v, F.lit("="))) >= SHORTEST, F.array(piece)).otherwise(S.none())

    def cut(acc: Column, b: Column) -> Column:
        return F.struct(F.greatest(acc["at"], b["e"]).alias("at"), F.concat(acc["out"], left(acc["at"], b["s"])).alias("out"))

    start = F.struct(run["s"].alias("at"), S.none().alias("out"))
    return F.when(F.size(inside) == 0, F.array(run)).otherwise(F.aggregate(
        inside, start, cut, lambda acc: F.concat(acc["out"], left(acc["at"], run["e"]))))


def _scanned(docs: DataFrame, text_col: str, keep: list[Column]) -> DataFrame:
    """``keep`` plus the rules' spans and the tested candidates between them."""
    text = _text(text_col)
    out = docs.select(*keep, base_spans(text).alias("base"), S.matches(text, RUN).alias("runs"))
    out = out.withColumn("runs", F.flatten(F.transform("runs", _pieces)))
    out = out.withColumn("cands", F.expr(tested("runs"))).drop("runs")
    return out.withColumn("cands", F.transform("cands", lambda x: F.struct(
        x["s"].alias("s"), x["e"].alias("e"), _band(x["e"] - x["s"]).alias("band"), _bin(x["p"]).alias("bin"))))


def _judged(scanned: DataFrame) -> DataFrame:
    """Candidates that the battery does not dismiss become spans of kind ``random``."""
    limit = thresholds(scanned.select(F.explode("cands").alias("c")).select("c.band", "c.bin"))
    none = BINS + 1
    stop = F.lit(none)
    kept = F.filter("cands", lambda x: x["bin"] < _limit(x["band"], limit, stop))
    extra = F.transform(kept, lambda x: F.struct(x["s"].alias("s"), F.lit(3).alias("rank"), x["e"].alias("e"),
                                                 F.lit("random").alias("kind")))
    return scanned.withColumn("spans", F.array_sort(F.concat("base", extra))).drop("cands")


def _limit(band: Column, limit: dict[int, int], stop: Column) -> Column:
    out = stop
    for b, at in sorted(limit.items()):
        out = F.when(band == b, F.lit(at)).otherwise(out)
    return out


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows ``(doc_id, base, spans)``, one per row; spans are ``array<s, rank, e, kind>``."""
    return _judged(cut_lineage(_scanned(docs, text_col, [F.col(id_col).cast("long").alias("doc_id")]), "secrets"))


def redact(docs: DataFrame, text_col: str = "text", mask: str = "<SECRET>", length_col: str | None = None) -> DataFrame:
    """``docs`` with every span replaced by ``mask``; spans that overlap give one mask.

    ``length_col``, if given, is set to the new length in code points.
    """
    row = F.struct(*[F.col(c) for c in docs.columns]).alias("row")
    found = _judged(cut_lineage(_scanned(docs, text_col, [row]), "secrets"))
    text = F.coalesce(F.col("row")[text_col].cast("string"), F.lit(""))

    def step(acc, x):
        # a span that begins inside the last mask only lengthens it
        fresh = x["s"] >= acc["at"]
        gap = F.substr(acc["text"], acc["at"] + 1, F.greatest(x["s"] - acc["at"], F.lit(0)))
        out = F.when(fresh, F.concat(acc["out"], gap, F.lit(mask))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], x["e"]).alias("at"), out.alias("out"), acc["text"].alias("text"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"), text.alias("text"))
    done = F.aggregate("spans", start, step, lambda acc: F.concat(
        acc["out"], F.substr(acc["text"], acc["at"] + 1, F.length(acc["text"]))))
    clean = F.when(F.size("spans") > 0, done).otherwise(F.col("row")[text_col].cast("string"))
    out = found.withColumn("new", clean)
    cols = []
    for c in docs.columns:
        if c == text_col:
            cols.append(F.col("new").alias(c))
        elif c == length_col:
            cols.append(F.when(F.size("spans") > 0, F.length("new").cast(docs.schema[c].dataType))
                        .otherwise(F.col("row")[c]).alias(c))
        else:
            cols.append(F.col("row")[c].alias(c))
    return out.select(*cols)
