"""URL filter: host-suffix and path-prefix expressions against hashed rules.

Each distinct URL is expanded into (host suffix + path prefix) expressions.
The expressions are joined with the rules on the first 32 bits of their
SHA-256, the full digest confirms a match, and of the rules that fit the
longest wins.  DataFrame functions only.

Defined cases: a null URL or one without ``://`` has empty host and path, no
rule, and the default verdict; an empty path fits no rule whose path is not
empty; equal rules that disagree block; repeated rows are all kept; no rules
at all give every page the default verdict.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    rest = F.substring(url, F.locate("://", url) + 3, F.length(url))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    return F.when(F.locate("://", url) > 0, host).otherwise("")


def url_path(url: Column) -> Column:
    rest = F.substring(url, F.locate("://", url) + 3, F.length(url))
    return F.when(F.locate("://", url) > 0, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)).otherwise("")


def rules_frame(spark: SparkSession, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "rule_host string, rule_path string, rule_verdict string")


def hashed_rules(rules: DataFrame) -> DataFrame:
    """One row per distinct rule with its digest and short prefix."""
    rule = F.concat("rule_host", "rule_path")
    return (
        rules.where("rule_host IS NOT NULL AND rule_path IS NOT NULL AND rule_host <> ''")
        .select(
            rule.alias("rule"),
            F.sha2(F.encode(rule, "UTF-8"), 256).alias("rule_digest"),
            F.length("rule_host").alias("rule_host_len"),
            F.length("rule_path").alias("rule_path_len"),
            F.col("rule_verdict"),
        )
        .groupBy("rule", "rule_digest", "rule_host_len", "rule_path_len")
        .agg(F.max("rule_verdict").alias("rule_verdict"))  # 'block' > 'allow'
        .withColumn("short", F.substring("rule_digest", 1, 8))
    )


def filter_urls(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with host, path, rule and verdict.  Columns of these names in
    ``pages`` are replaced; others keep their names, whatever these are."""
    hashed = hashed_rules(rules)
    # Distinct path lengths of the rules: an expression of another length can fit none.
    lengths = [r[0] for r in hashed.select("rule_path_len").distinct().collect()]
    own = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    rest = {c: f"_c{i}" for i, c in enumerate(own)}
    out = pages.select(*(pages[f"`{c}`"].alias(k) for c, k in rest.items()), url_host(pages[f"`{url_col}`"]).alias("host"), url_path(pages[f"`{url_col}`"]).alias("path"))
    distinct = out.select("host", "path").where("host <> ''").distinct()
    labels = F.split("host", "\\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    fitting = F.filter(
        F.array(*[F.lit(n) for n in sorted(lengths)]).cast("array<int>"), lambda n: n <= F.length("path")
    )
    prefixes = F.transform(fitting, lambda n: F.substring(F.col("path"), F.lit(1), n))
    expressions = F.flatten(F.transform(suffixes, lambda h: F.transform(prefixes, lambda p: F.concat(h, p))))
    digests = distinct.select("host", "path", F.explode(F.array_distinct(expressions)).alias("expression")).select(
        "host", "path", F.sha2(F.encode("expression", "UTF-8"), 256).alias("digest")
    )
    hits = digests.withColumn("short", F.substring("digest", 1, 8)).join(hashed, "short").where("digest = rule_digest")
    rank = F.struct(F.col("rule_host_len") + F.col("rule_path_len"), "rule_host_len")
    best = hits.groupBy("host", "path").agg(
        F.max_by("rule", rank).alias("rule"), F.max_by("rule_verdict", rank).alias("rule_verdict")
    )
    joined = out.join(best, ["host", "path"], "left")
    verdict = F.coalesce("rule_verdict", F.lit(default)).alias("verdict")
    return joined.select(*(F.col(k).alias(c) for c, k in rest.items()), "host", "path", "rule", verdict)


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return filter_urls(pages, rules_frame(spark)).select("page_id", "host", "path", "rule", "verdict")


OP9_SQL = r"""
WITH u AS (
  SELECT page_id,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest
  FROM pages),
h AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM u),
r(rh, rp, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
                        ('net', '/es/', 'block'), ('net', '/fr/', 'block'))
SELECT page_id, host, path,
       (SELECT rh || rp FROM r WHERE (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
        ORDER BY length(rh || rp) DESC LIMIT 1) AS rule,
       coalesce((SELECT v FROM r WHERE (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
        ORDER BY length(rh || rp) DESC LIMIT 1), 'allow') AS verdict
FROM h
"""
