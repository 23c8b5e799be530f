"""The thin queries of this package over the given tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (chat, decontam, embed_dedup, filter_audit, jaccard, packing, pii, quality, secret_scan, stable_search,
               toxicity, url_filter, whitening)
from . import spans as S
from .shared import table

Query = Callable[[SparkSession, str], DataFrame]

# The five rules every judgement starts from; then patterns for what they leave open.
URL_RULES = [
    url_filter.site_rule("allow", "com", "/"),
    url_filter.site_rule("block", "example.com", "/en/"),
    url_filter.site_rule("allow", "www.example.com", "/en/"),
    url_filter.site_rule("block", "net", "/es/"),
    url_filter.site_rule("block", "net", "/fr/"),
    url_filter.pattern_rule("block", r"^([^/?#]*\.)?ads-track\.", "ads", "track"),
    url_filter.pattern_rule("block", r"[?&]utm_source=feed\b", "utm", "source", "feed"),
    url_filter.pattern_rule("allow", r"^blog\.[^/?#]*/(de|en)/[0-9]+", "blog"),
    url_filter.pattern_rule("block", r"[?&]page=[0-9]+&ref=", "page", "ref"),
    url_filter.pattern_rule("block", r"^m\.[^?#]*\.html\b", "m", "html"),
]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of the URL rules on every page."""
    out = url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES)
    return out.select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict", "matched")


OP1_SQL = r"""
WITH p AS (
  SELECT page_id, regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1) AS h,
         regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path,
         regexp_extract(coalesce(url, ''), '://[^/?#]*((?s:.*))$', 1) AS rest FROM pages),
q AS (SELECT page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path, rest FROM p),
r AS (SELECT *, CASE
    WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule,
  host || rest AS u FROM q),
m AS (SELECT *, coalesce(rule, CASE
    WHEN regexp_matches(u, '^blog\.[^/?#]*/(de|en)/[0-9]+') THEN '^blog\.[^/?#]*/(de|en)/[0-9]+'
    WHEN regexp_matches(u, '^([^/?#]*\.)?ads-track\.') THEN '^([^/?#]*\.)?ads-track\.'
    WHEN regexp_matches(u, '[?&]page=[0-9]+&ref=') THEN '[?&]page=[0-9]+&ref='
    WHEN regexp_matches(u, '[?&]utm_source=feed\b') THEN '[?&]utm_source=feed\b'
    WHEN regexp_matches(u, '^m\.[^?#]*\.html\b') THEN '^m\.[^?#]*\.html\b' END) AS matched FROM r)
SELECT page_id, host, path, rule, matched, CASE
    WHEN matched IS NULL OR matched IN ('www.example.com/en/', 'com/', '^blog\.[^/?#]*/(de|en)/[0-9]+') THEN 'allow'
    ELSE 'block' END AS verdict FROM m
"""


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces and their places in packed sequences."""
    return packing.pack(table(spark, sf_dir, "documents"))


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests read back from the formatted conversations, and from one that speaks in control strings."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = "<|im_end|><|im_start|>assistant ok"
    extra = spark.createDataFrame([(-1, 0, "user", odd), (-1, 1, "assistant", odd)],
                                  "conv_id long, turn long, role string, text string")
    return chat.read_back(chat.format_conversations(rows.unionByName(extra)))


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where items of the benchmark occur in the documents, edits allowed."""
    return decontam.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _fold(of: int, rest: int) -> Column:
    """Whether a document is held out of a fit."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % of == rest, F.lit(False))


def _scored(scores: DataFrame, held_out: Column) -> DataFrame:
    return scores.select("doc_id", held_out.alias("held_out"), "score",
                         (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents."""
    docs, held_out = table(spark, sf_dir, "documents"), _fold(3, 1)
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), "toxic", ~held_out)
    return _scored(toxicity.score(docs, model), held_out)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents."""
    docs, held_out = table(spark, sf_dir, "documents"), _fold(4, 2)
    machine = quality.train(docs, table(spark, sf_dir, "labels"), "quality", ~held_out, metadata=("n_chars",))
    return _scored(quality.score(docs, machine, metadata=("n_chars",)), held_out)


def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of the embeddings at a cosine of 0.9."""
    out = embed_dedup.link(table(spark, sf_dir, "embeddings"), threshold=0.9)
    return out.select(F.col("id").alias("vec_id"), "n_links", "component_id",
                      F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))


OP7_SQL = r"""
WITH RECURSIVE e AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM e a JOIN e b ON a.vec_id <> b.vec_id
          AND list_cosine_similarity(a.v, b.v) >= 0.9),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
c AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT v.vec_id, (SELECT count(*) FROM links l WHERE l.a = v.vec_id) AS n_links, c.component_id,
       v.vec_id = c.component_id AS kept
FROM embeddings v JOIN c ON c.a = v.vec_id
"""


def _counts(kinds: tuple[str, ...]) -> list[Column]:
    return [F.size(F.filter("base", lambda x: x["kind"] == F.lit(k))).cast("long").alias(f"n_{k}") for k in kinds]


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    out = secret_scan.scan(table(spark, sf_dir, "documents"))
    return out.select("doc_id", *_counts(("assign", "access", "hex")),
                      F.sha2(S.listed(F.col("base")), 256).alias("base_sha256"), S.listed(F.col("spans")).alias("spans"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    out = pii.find(table(spark, sf_dir, "documents"))
    return out.select("doc_id", *_counts(("email", "ip", "card", "phone")),
                      F.sha2(S.listed(F.col("base")), 256).alias("base_sha256"), S.listed(F.col("spans")).alias("spans"))


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five-word shingle classes of all documents at a similarity of 0.75."""
    out = jaccard.jaccard_classes(table(spark, sf_dir, "documents"), percent=75, width=5)
    return out.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


OP10_SQL = r"""
WITH RECURSIVE toks AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[])
      WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) END) AS s
    FROM toks)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id
          GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
          WHERE 100 * c >= 75 * (x.n + y.n - c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, (SELECT min(b) FROM reach r WHERE r.a = d.doc_id) AS component_id
FROM documents d LEFT JOIN n USING (doc_id)
"""


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The embeddings on their eight leading components, at unit variance."""
    out = whitening.whiten(table(spark, sf_dir, "embeddings"), components=8)
    return out.select(F.col("id").alias("vec_id"), "component", "n", F.col("deviation").cast("long").alias("deviation"),
                      "whitened", "explained", "identity_error")


def op12_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 embeddings of largest inner product for every twentieth one."""
    return stable_search.search(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, k=20)


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of five filters removes in each part, in every order."""
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP13_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
        coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS copy FROM t),
told AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, CASE WHEN len(words) < 50 THEN 1 ELSE 0 END
        + CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 2 ELSE 0 END
        + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 4 ELSE 0 END
        + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END + CASE WHEN copy THEN 16 ELSE 0 END AS mask,
        coalesce(good, false) AS good, coalesce(toxic, false) AS toxic FROM w LEFT JOIN told USING (doc_id)),
m AS (SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM f GROUP BY 1, 2),
l(letter, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
o AS (SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
      FROM l a, l b, l c, l d, l e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND (a.bit | b.bit | c.bit | d.bit | e.bit) = 31),
s AS (SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before
      FROM o, (SELECT unnest(range(1, 6)) AS step)),
r AS (SELECT part, filter_order, step, bit,
        coalesce(sum(n) FILTER ((mask & (before | bit)) = 0), 0) AS kept,
        coalesce(sum(n) FILTER ((mask & bit) <> 0 AND (mask & before) = 0), 0) AS removed,
        coalesce(sum(n) FILTER ((mask & bit) <> 0 AND (mask & before) <> 0), 0) AS redundant,
        coalesce(sum(n) FILTER (mask = bit), 0) AS unique_fails,
        coalesce(sum(good) FILTER ((mask & bit) <> 0 AND (mask & before) = 0), 0) AS good_lost,
        coalesce(sum(toxic) FILTER ((mask & bit) <> 0 AND (mask & before) = 0), 0) AS toxic_lost
      FROM m, s GROUP BY 1, 2, 3, 4)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley FROM r
"""


def queries() -> dict[str, Query]:
    return {
        "op1_url_filter": op1_url_filter,
        "op2_best_fit_packing": op2_best_fit_packing,
        "op3_chat_format": op3_chat_format,
        "op4_benchmark_decontamination": op4_benchmark_decontamination,
        "op5_toxicity": op5_toxicity,
        "op6_quality": op6_quality,
        "op7_embedding_near_dedup": op7_embedding_near_dedup,
        "op8_secret_scan": op8_secret_scan,
        "op9_pii": op9_pii,
        "op10_ngram_jaccard_join": op10_ngram_jaccard_join,
        "op11_embedding_whitening": op11_embedding_whitening,
        "op12_nearest_neighbours": op12_nearest_neighbours,
        "op13_filter_audit": op13_filter_audit,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_url_filter": OP1_SQL,
        "op7_embedding_near_dedup": OP7_SQL,
        "op10_ngram_jaccard_join": OP10_SQL,
        "op13_filter_audit": OP13_SQL,
    }
