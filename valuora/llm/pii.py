r"""Personal data: fixed rules plus bootstrapped contextual extraction, in DataFrame functions.

*Rules.* Emails, IPv4 addresses, payment cards (13 to 19 digits, Luhn) and
international phone numbers, each leftmost and non-overlapping per kind;
failing matches are dropped without a retry.

*Bootstrapping.* The rules' matches are the seeds. The two words before a seed
form a lexical pattern; the same two words before any other word that holds a
digit tie that word to the pattern. In this graph of patterns and instances
over the whole corpus, Spark scores in turn

* a pattern by the mean score of its distinct instances, if at least
  ``SUPPORT`` of them are seeds or score 0.5 or more (else 0), and
* an instance that is no seed by ``1 - prod (1 - score)`` of its patterns,

for ``ROUNDS`` rounds. Instances that reach ``CONFIDENT`` are reported, where
they stand behind a pattern that reaches it too, as spans of kind ``context``.
Words inside a rule's match are no instances. Patterns and instances are
counted by partial aggregates, so a frequent one is no hot key.

Defined results: a null or empty text has no spans; every row gives one row,
null and repeated ids included; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import spans as S
from .shared import cut_lineage

# A match starts where its run of characters starts, or where the match before ended.
# Possessive repeats take no stack, however long the run.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)"
CARD = r"[0-9]([\x20-]?[0-9]){12,}+"     # of [0-9]([\x20-]?[0-9])+ those of 13 digits or more
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
WORD = r"(?<![^\s])[^\s0-9]*[0-9][^\s]*"  # a word that holds a digit
SUPPORT, ROUNDS, CONFIDENT = 3, 3, 0.9

_OCTETS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.|$)){4}$"


def _digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def _luhn(v: Column) -> Column:
    """Whether 13 to 19 digits pass the Luhn check."""
    turned = F.reverse(_digits(v))
    total = F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), lambda acc, i: acc + _luhn_digit(turned, i))
    # a longer run of digits is not summed: its sum would take time that grows with its square
    return F.when(F.length(turned).between(13, 19), total % 10 == 0).otherwise(F.lit(False))


def _luhn_digit(turned: Column, i: Column) -> Column:
    d = F.ascii(F.substr(turned, i, F.lit(1))) - 48
    twice = d * 2
    return F.when(i % 2 == 0, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(d)


def _rules(text: Column) -> list[tuple[str, Column]]:
    """Kinds as listed, with their matches (and the two words before each)."""
    email = S.matches(text, EMAIL, F.contains(text, F.lit("@")), context=True)
    ip = F.filter(S.matches(text, IP, context=True), lambda x: x["v"].rlike(_OCTETS))
    card = F.filter(S.matches(text, CARD, context=True), lambda x: _luhn(x["v"]))
    phone = F.filter(S.matches(text, PHONE, F.contains(text, F.lit("+")), context=True),
                     lambda x: F.length(_digits(x["v"])).between(9, 15))
    return [("email", email), ("ip", ip), ("card", card), ("phone", phone)]


def _named(found: Column, kind: str, rank: int) -> Column:
    return F.transform(found, lambda x: F.struct(
        F.lit(rank).alias("rank"), x["s"].alias("s"), x["e"].alias("e"), F.lit(kind).alias("kind"),
        x["v"].alias("v"), x["ctx"].alias("ctx")))


def _read(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per row: the rules' spans with their words before, and the other words that hold a digit."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    found = [_named(m, kind, rank) for rank, (kind, m) in enumerate(_rules(text))]
    out = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.array_sort(F.concat(*found)).alias("base"),
                      S.matches(text, WORD, context=True).alias("words"))
    out = out.withColumn("words", F.filter("words", lambda x: (x["ctx"] != "") & ~F.exists(
        F.col("base"), lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"]))))
    return out.withColumn("row", F.monotonically_increasing_id())


def _edges(read: DataFrame) -> DataFrame:
    """Distinct ``(pattern, instance, seed)``."""
    seeds = (read.select(F.explode("base").alias("x")).where("x.ctx <> ''")
             .select(F.col("x.ctx").alias("pattern"), F.lower("x.v").alias("instance"), F.lit(True).alias("seed")))
    other = (read.select(F.explode("words").alias("x"))
             .select(F.col("x.ctx").alias("pattern"), F.lower("x.v").alias("instance"), F.lit(False).alias("seed")))
    return seeds.unionByName(other).groupBy("pattern", "instance").agg(F.max("seed").alias("seed"))


def bootstrap(edges: DataFrame) -> DataFrame:
    """Confident ``(pattern, instance)`` pairs of instances that are no seeds; ``edges`` are distinct."""
    edges = cut_lineage(edges, "edges")
    seeds = edges.where("seed").select("instance", F.lit(True).alias("known")).distinct()
    # a pattern of fewer instances scores 0 in every round, and so changes no instance
    able = edges.groupBy("pattern").count().where(F.col("count") >= SUPPORT).select("pattern")
    is_seed = F.coalesce("known", F.lit(False))
    graph = cut_lineage(edges.join(able, "pattern").join(seeds, "instance", "left").select(
        "pattern", "instance", is_seed.alias("is_seed"), is_seed.cast("double").alias("score")), "graph")
    state = graph
    for _ in range(ROUNDS):
        patterns = state.groupBy("pattern").agg(
            F.when(F.sum((F.col("score") >= 0.5).cast("long")) >= SUPPORT, F.avg("score")).otherwise(F.lit(0.0)).alias("trust"))
        tied = graph.drop("score").join(patterns, "pattern")
        instances = tied.groupBy("instance").agg(
            (1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("trust"), F.lit(1e-12)))))).alias("found"))
        state = cut_lineage(tied.join(instances, "instance").select(
            "pattern", "instance", "is_seed", "trust",
            F.when(F.col("is_seed"), F.lit(1.0)).otherwise(F.col("found")).alias("score")), "graph")
    return state.where(~F.col("is_seed") & (F.col("score") >= CONFIDENT) & (F.col("trust") >= CONFIDENT)).select(
        "pattern", "instance")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows ``(doc_id, base, spans)``; spans are ``array<rank, s, e, kind>`` sorted by kind, then start."""
    read = cut_lineage(_read(docs, id_col, text_col), "pii")
    sure = bootstrap(_edges(read))
    extra = (read.select("row", F.explode("words").alias("x"))
             .select("row", "x.s", "x.e", F.col("x.ctx").alias("pattern"), F.lower("x.v").alias("instance"))
             .join(sure, ["pattern", "instance"])
             .groupBy("row").agg(F.collect_list(F.struct(
                 F.lit(4).alias("rank"), F.col("s"), F.col("e"), F.lit("context").alias("kind"))).alias("extra")))
    short = F.transform("base", lambda x: F.struct(x["rank"].alias("rank"), x["s"].alias("s"), x["e"].alias("e"),
                                                   x["kind"].alias("kind")))
    return (read.drop("words").withColumn("base", short).join(extra, "row", "left")
            .select("doc_id", "base", F.array_sort(F.concat("base", F.coalesce("extra", F.array().cast(
                "array<struct<rank:int,s:int,e:int,kind:string>>")))).alias("spans")))
