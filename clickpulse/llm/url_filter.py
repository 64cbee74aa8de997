"""URL filtering against a list of host and path rules, in DataFrame operations.

A rule (host, path) fits its host and all subdomains, where the URL's path
starts with the rule's.  Every distinct (host, path) is expanded into its host
suffixes (at label borders) and path prefixes, of the sizes that rules have.
The expressions meet the rules on the first ``PREFIX_HEX`` digits of a SHA-256
digest, full digests confirm, and the longest rule wins.

Distinct (host, path) pairs are expanded, not pages, so a URL that fills a
third of the table is looked up once.  The winners are written before the pages
meet them, so that both sides of that join are plain tables and a hot URL is
split over tasks; pages without a host are judged without it.  A rule list of up to ``BROADCAST_RULES``
is broadcast; a longer one is joined by a shuffle with the rules repeated over
``SALTS`` salts, as short expressions (a top-level domain) are shared by very
many URLs.

Cases: a null URL, or one without ``://``, has an empty host and path and gets
the default; the same holds for an empty rule list; rules with a null part are
ignored; of rules of equal length the one with the longer host wins, then
block over allow, then the smaller text; repeated pages stay repeated; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpulse.llm.common import stored

#: (host, path, verdict) of the production list.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"),
         ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
DEFAULT = "allow"
PREFIX_HEX = 8
BROADCAST_RULES = 100_000
SALTS = 16

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    """host, path, verdict of a rule list in the code."""
    rows = [F.struct(*[F.lit(v).cast("string").alias(n) for n, v in zip(("host", "path", "verdict"), r)]) for r in rules]
    empty = F.array().cast("array<struct<host:string,path:string,verdict:string>>")
    return spark.range(1).select(F.inline(F.array(*rows) if rows else empty))


def url_host_path(url: F.Column) -> tuple[F.Column, F.Column]:
    """Host (A-Z lower-cased) and path of a URL; empty where there is none."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def _labels(host: F.Column) -> F.Column:
    return F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1


def _hashed(df: DataFrame, text: F.Column) -> DataFrame:
    return df.withColumn("digest", F.sha2(text, 256)) \
        .withColumn("prefix", F.conv(F.substring("digest", 1, PREFIX_HEX), 16, 10).cast("bigint"))


def match_rules(urls: DataFrame, rules: DataFrame, broadcast_rules: int = BROADCAST_RULES,
                salts: int = SALTS) -> DataFrame:
    """``urls`` (host, path; distinct) -> host, path, rule, verdict of the rule
    that wins, for those that a rule fits."""
    known = rules.where("host IS NOT NULL AND path IS NOT NULL AND verdict IS NOT NULL").select(
        F.translate("host", _UPPER, _LOWER).alias("rule_host"), F.col("path").alias("rule_path"),
        F.col("verdict").alias("rule_verdict")).distinct()
    sizes = known.agg(F.count("*").alias("n"), F.collect_set(_labels(F.col("rule_host"))).alias("labels"),
                      F.collect_set(F.length("rule_path")).alias("chars")).first()
    listed = _hashed(known, F.concat("rule_host", "rule_path"))
    labels = F.array(*map(F.lit, sorted(sizes["labels"]))).cast("array<int>")
    chars = F.array(*map(F.lit, sorted(sizes["chars"]))).cast("array<int>")
    expanded = urls.where("host <> ''") \
        .withColumn("k", F.explode(F.filter(labels, lambda k: k <= _labels(F.col("host"))))) \
        .withColumn("m", F.explode(F.filter(chars, lambda m: m <= F.length("path")))) \
        .withColumn("expression", F.concat(F.expr("substring_index(host, '.', -k)"), F.expr("left(path, m)")))
    hashed = _hashed(expanded, F.col("expression"))
    on = ["prefix"]
    if sizes["n"] <= broadcast_rules:
        listed = F.broadcast(listed)
    else:
        hashed = hashed.withColumn("salt", F.pmod(F.xxhash64("host", "path"), F.lit(salts)))
        listed = listed.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))))
        on.append("salt")
    fits = hashed.join(listed.withColumnRenamed("digest", "rule_digest"), on) \
        .where(F.col("digest") == F.col("rule_digest"))
    rule = F.concat("rule_host", "rule_path")
    order = F.struct(F.length(rule).alias("n"), F.length("rule_host").alias("h"),
                     (F.col("rule_verdict") == "block").alias("b"))
    best = fits.groupBy("host", "path").agg(
        F.max(order).alias("o"), F.max_by(F.struct(rule.alias("rule"), F.col("rule_verdict").alias("verdict")), order).alias("r"))
    return best.select("host", "path", "r.rule", "r.verdict")


def filter_urls(pages: DataFrame, rules: DataFrame, *, id_col: str = "page_id", url_col: str = "url",
                default: str = DEFAULT, **options) -> DataFrame:
    """One row per page: page_id, host, path, rule (null: none fits), verdict."""
    host, path = url_host_path(F.col(url_col).cast("string"))
    parts = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    known = parts.where("host <> ''")
    won = stored(match_rules(known.select("host", "path").distinct(), rules, **options), "winners")
    named = known.join(won, ["host", "path"], "left").select("page_id", "host", "path", "rule", "verdict")
    none = F.lit(None).cast("string")
    rest = parts.where("host = ''").select("page_id", "host", "path", none.alias("rule"), none.alias("verdict"))
    return named.unionByName(rest).withColumn("verdict", F.coalesce("verdict", F.lit(default)))


#: DuckDB twin of the registered query.
ORACLE = """
WITH rules(rule_host, rule_path, verdict) AS (VALUES
  ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
  ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
parts AS (
  SELECT row_number() OVER () AS i, page_id,
    translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut),
fits AS (
  SELECT i, rule_host || rule_path AS rule, verdict,
    row_number() OVER (PARTITION BY i ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC) AS k
  FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN (SELECT * FROM fits WHERE k = 1) USING (i)
"""
