"""URL rules by hash-prefix lookup.

Each distinct URL is expanded into host-suffix x path-prefix expressions.  An expression's SHA-256 is
equi-joined with the rules' on a short prefix (32 bits); the full digest and the rule's remaining path
characters then confirm the hit, and the longest rule wins.

The number of expressions a URL gets is limited by the labels and slashes that occur in the rules, which
loses nothing: a longer host suffix or deeper prefix could not equal any rule.  The rule table is never
broadcast by a hint; the planner does so when its size allows, and splits a skewed join otherwise.

Defined cases: a null URL, or one without ``://``, has empty host and path and gets the default verdict; repeated rows
are judged alike; empty inputs give empty results; an empty or null rule table leaves the default.
A rule without any ``/`` has the empty path and fits every path of its host.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from screenlake.llm.tables import ascii_lower, text_or_empty

SHORT = 8  # hex digits of the digest in the join key


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(text_or_empty(url), r"://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(text_or_empty(url), r"://[^/?#]*([^?#]*)", 1)


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """(verdict, rule) pairs, a rule being ``host`` or ``host/path...``, as a DataFrame."""
    return spark.createDataFrame([(v, r) for v, r in rules], "verdict string, rule string")


def _keyed_rules(rules: DataFrame) -> DataFrame:
    """Rule, its host and path, and the digest of host plus the path up to its last slash."""
    host = ascii_lower(F.substring_index("rule", "/", 1))
    parsed = rules.where("rule is not null and verdict is not null").select(
        "rule", "verdict", host.alias("_host"),
        F.expr("substring(rule, length(substring_index(rule, '/', 1)) + 1)").alias("_rule_path"))
    folder = F.regexp_extract("_rule_path", r"(?s)^(.*/)", 1)
    digest = F.sha2(F.concat("_host", folder), 256)
    return (parsed.distinct()
            .withColumn("_digest", digest)
            .withColumn("_short", F.substring("_digest", 1, SHORT))
            .withColumn("_labels", F.size(F.split("_host", r"\.")))
            .withColumn("_slashes", F.size(F.split(folder, "/")) - 1))


def _expressions(host: Column, path: Column, labels: int, slashes: int) -> Column:
    """Every host suffix of at most ``labels`` labels with every prefix of at most ``slashes`` slashes."""
    parts = F.split(host, r"\.")
    n = F.size(parts)
    suffixes = F.transform(F.sequence(F.greatest(F.lit(1), n - F.lit(labels - 1)), n),
                           lambda i: F.array_join(F.slice(parts, i, n - i + 1), "."))
    depth = F.least(F.size(F.split(path, "/")) - 1, F.lit(slashes))
    parts_of_path = F.split(path, "/")
    prefixes = F.transform(F.sequence(F.lit(0), depth), lambda k: F.when(k == 0, F.lit("")).otherwise(
        F.concat(F.array_join(F.slice(parts_of_path, F.lit(1), k), "/"), F.lit("/"))))
    return F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))


def match_rules(urls: DataFrame, rules: DataFrame, url_col: str = "url") -> DataFrame:
    """One row per distinct URL that some rule fits: ``url, rule, verdict`` of the longest rule
    (ties: block before allow, then the smaller rule string)."""
    keyed = _keyed_rules(rules)
    shape = keyed.agg(F.max("_labels").alias("l"), F.max("_slashes").alias("s")).first()
    labels, slashes = (shape["l"] or 1), (shape["s"] or 0)
    distinct = urls.select(F.col(url_col).alias("url")).where(F.col("url").contains("://")).distinct()
    parsed = distinct.select("url", host_of(F.col("url")).alias("_h"), path_of(F.col("url")).alias("_p"))
    expanded = (parsed.withColumn("_e", F.explode(_expressions(F.col("_h"), F.col("_p"), labels, slashes)))
                .select("url", "_p", F.sha2("_e", 256).alias("_full"))
                .withColumn("_key", F.substring("_full", 1, SHORT)))
    hits = expanded.join(keyed, (F.col("_key") == F.col("_short")) & (F.col("_full") == F.col("_digest"))
                         & F.expr("startswith(_p, _rule_path)"))
    best = F.min(F.struct((-F.length("rule")).alias("l"), (F.col("verdict") != "block").alias("v"),
                          F.col("rule"), F.col("verdict"))).alias("b")
    return hits.groupBy("url").agg(best).select("url", "b.rule", "b.verdict")


def judge(urls: DataFrame, rules: DataFrame, id_col: str, url_col: str = "url",
          default: str = "allow") -> DataFrame:
    """``id_col, host, path, rule, verdict`` for every row of ``urls``; other columns are not read."""
    rows = urls.select(F.col(id_col), F.col(url_col).alias("_url"))
    won = match_rules(urls, rules, url_col).withColumnsRenamed({"rule": "_rule", "verdict": "_verdict"})
    return (rows.join(won, rows["_url"] == won["url"], "left")
            .select(F.col(id_col), host_of(F.col("_url")).alias("host"), path_of(F.col("_url")).alias("path"),
                    F.col("_rule").alias("rule"), F.coalesce("_verdict", F.lit(default)).alias("verdict")))
