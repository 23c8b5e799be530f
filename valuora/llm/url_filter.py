"""URL filters: pattern rules found by their rarest literal token.

A rule is a regular expression over the normal form of a URL, which is the
host with A-Z lower-cased followed by the rest. Every URL that a rule fits must
hold the rule's literal tokens (runs of ``[A-Za-z0-9]``) as whole tokens. Each
rule is filed under the one of them that the fewest URLs of the corpus hold
(the alphabetically first on a tie). A URL's own tokens fetch the rules filed
under them, and only those run their expression; rules without a literal are
tried on every URL. Of the rules that fit, a site rule beats a pattern rule,
and within a kind the longest wins, then the first in the list.

Site rules name a host and the start of a path and fit the host and its
subdomains; they are turned into expressions and filed like the others.

How many URLs hold a rule's token is counted by Spark over the whole table; the
driver gets one number per literal token of the rules. The filed rules go to
every task: their text is checked against ``RULE_BYTES`` first, and a longer
list is applied in parts, the best decision of all parts counting.

Defined results: a null URL or one without ``://`` has an empty host and path
and no rule fits it; every row gives one row, null and repeated ids included;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RULE_BYTES = 8 << 20
TOKEN = "[A-Za-z0-9]+"


@dataclass(frozen=True)
class Rule:
    name: str
    action: str            # allow or block
    pattern: str           # over host + rest
    literals: tuple[str, ...] = field(default=())  # tokens every URL that fits must hold
    site: bool = False


def site_rule(action: str, host: str, path: str) -> Rule:
    """Fits ``host`` and its subdomains where the path starts with ``path``."""
    tokens = re.findall(TOKEN, host)
    # the path's last token may go on in the URL
    closed = re.findall(f"{TOKEN}(?=[^A-Za-z0-9])", path)
    stop = "" if path else "(?=[/?#]|$)"
    return Rule(host + path, action, f"^([^/?#]*\\.)?{re.escape(host)}{re.escape(path)}{stop}", tuple(tokens + closed), True)


def pattern_rule(action: str, pattern: str, *literals: str) -> Rule:
    """Fits where ``pattern`` is found; the caller names the whole tokens that it implies."""
    return Rule(pattern, action, pattern, tuple(literals))


def parts(url: Column) -> tuple[Column, Column, Column]:
    """(host, path, host and all that follows it) of a URL."""
    after = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://((?s:.*))$", 1)
    host = F.translate(F.regexp_extract(after, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    rest = F.regexp_extract(after, r"^[^/?#]*((?s:.*))$", 1)
    return host, F.regexp_extract(rest, r"^([^?#]*)", 1), F.concat(host, rest)


def token_counts(normal: DataFrame, rules: list[Rule]) -> dict[str, int]:
    """In how many URLs each literal token of the rules stands."""
    wanted = sorted({t for r in rules for t in r.literals})
    if not wanted:
        return {}
    held = normal.select(F.explode(F.array_intersect(
        F.regexp_extract_all("normal", F.lit(f"({TOKEN})"), F.lit(1)), F.lit(wanted))).alias("token"))
    return {r["token"]: r["n"] for r in held.groupBy("token").agg(F.count("*").alias("n")).collect()}


def filed(rules: list[Rule], counts: dict[str, int]) -> tuple[dict[str, list[int]], list[int]]:
    """(rules by their rarest literal, rules without a literal), as places in the list."""
    index: dict[str, list[int]] = {}
    always = []
    for i, r in enumerate(rules):
        if r.literals:
            index.setdefault(min(r.literals, key=lambda t: (counts.get(t, 0), t)), []).append(i)
        else:
            always.append(i)
    return index, always


def _apply(rules: list[Rule], index: dict[str, list[int]], always: list[int]):
    order = sorted(range(len(rules)), key=lambda i: (not rules[i].site, -len(rules[i].name), i))
    rank = {i: k for k, i in enumerate(order)}

    def run(batches):
        tokens = re.compile(TOKEN)
        compiled = [re.compile(r.pattern) for r in rules]
        for b in batches:
            out = []
            for url in b.column("normal").to_pylist():
                fetched = set(always)
                for t in set(tokens.findall(url)):
                    fetched.update(index.get(t, ()))
                # best first, so the first fit decides
                out.append(next((i for i in sorted(fetched, key=rank.__getitem__) if compiled[i].search(url)), None) if url else None)
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in b.schema.names], pa.array([None if i is None else rank[i] for i in out], pa.int64())],
                names=[*b.schema.names, "place"])
    return run, [rules[i] for i in order]


def judge(urls: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url",
          otherwise: str = "allow") -> DataFrame:
    """Rows ``(id, host, path, rule, verdict, matched)``, one per row of ``urls``.

    ``matched`` names the rule that decided, ``rule`` only a site rule.
    """
    for r in rules:
        re.compile(r.pattern)
    host, path, normal = parts(F.col(url_col).cast("string"))
    out = urls.select(F.col(id_col).cast("long").alias("id"), host.alias("host"), path.alias("path"), normal.alias("normal"))
    counts = token_counts(out, rules)
    places = []
    for k, part in enumerate(_chunks(rules)):
        run, ranked = _apply(part, *filed(part, counts))
        out = out.mapInArrow(run, ", ".join(f"`{c}` {t}" for c, t in out.dtypes) + ", place long")
        out = out.withColumnRenamed("place", f"place{k}")
        places.append((f"place{k}", ranked))
    best = None
    for name, ranked in places:
        table = F.array(*[F.struct(F.lit(int(not r.site)).alias("kind"), F.lit(-len(r.name)).alias("size"),
                                   F.lit(rules.index(r)).alias("at"), F.lit(r.name).alias("name"),
                                   F.lit(r.action).alias("action"), F.lit(r.site).alias("site")) for r in ranked])
        here = F.get(table, F.col(name).cast("int"))
        best = here if best is None else F.least(best, here)
    if best is None:
        best = F.lit(None).cast("struct<name:string,action:string,site:boolean>")
    out = out.withColumn("best", best)
    return out.select("id", "host", "path", F.when(F.col("best.site"), F.col("best.name")).alias("rule"),
                      F.coalesce("best.action", F.lit(otherwise)).alias("verdict"), F.col("best.name").alias("matched"))


def _chunks(rules: list[Rule]):
    part, size = [], 0
    for r in rules:
        if part and size + len(r.pattern) > RULE_BYTES:
            yield part
            part, size = [], 0
        part.append(r)
        size += len(r.pattern)
    if part:
        yield part
