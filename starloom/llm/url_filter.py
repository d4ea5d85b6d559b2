"""URL filter: host-suffix / path-prefix expressions against a rule table.

Every URL is expanded into the expressions that a rule could be written as (a host
suffix on label boundaries followed by a path prefix), each expression is reduced to
a short hash prefix, the prefixes meet the rules' prefixes in an equi-join, and a hit
counts only if the full SHA-256 digests agree. Of the confirmed rules the longest
expression wins.

Only suffix depths and path lengths that occur in the rule table are expanded, which
loses nothing: another expression equals no rule. So a URL with thousands of labels or
a very long path yields no more expressions than any other.

Defined results: a null URL, or one without ``://``, has empty host and path and takes
the default verdict; an empty rule table gives every row the default; repeated rows are
judged one by one; equal-length rules prefer the longer host, then block over allow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import lower_ascii, pick
from starloom.operators.joins import MAX_BROADCAST_ROWS, join_small
from starloom.session import stage

#: Hex digits of the digest that the equi-join compares.
PREFIX_HEX = 8


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path) of a URL: host in ASCII lower case, path without query and fragment."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = lower_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0))
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def _digest(expression: Column) -> Column:
    return F.sha2(expression.cast("binary"), 256)


def prepare_rules(rules: DataFrame) -> DataFrame:
    """(prefix, digest, rule, action, weight) of rules (host, path, action)."""
    host, path = lower_ascii(F.col("host")), F.col("path")
    expr = F.concat(host, path)
    return (rules.where("host IS NOT NULL AND path IS NOT NULL")
            .select(expr.alias("rule"), "action", F.length(host).alias("host_len"),
                    F.length(path).alias("path_len"),
                    F.size(F.split(host, r"\.", -1)).alias("labels"))
            # The separator keeps ("a", "b/c") apart from ("ab", "/c").
            .withColumn("digest", _digest(F.concat(F.substring("rule", F.lit(1), F.col("host_len")),
                                                   F.lit("\n"),
                                                   F.expr("substring(rule, host_len + 1)"))))
            .withColumn("prefix", F.substring("digest", 1, PREFIX_HEX))
            .distinct())


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
          default: str = "allow", max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """(id, host, path, rule, verdict) for every row of ``pages``.

    ``rules`` has (host, path, action). It is broadcast only behind its measured size;
    a larger list is joined by shuffle on the hash prefix.
    """
    ready = stage(prepare_rules(rules), "url-rules")
    # One row each, however many rules: which depths and lengths occur.
    shape = ready.df.agg(F.collect_set("labels").alias("labels"),
                         F.collect_set("path_len").alias("lengths")).first()
    depths = F.array(*[F.lit(int(x)) for x in sorted(shape["labels"])]).cast("array<int>")
    lengths = F.array(*[F.lit(int(x)) for x in sorted(shape["lengths"])]).cast("array<int>")

    host, path = split_url(F.col("url"))
    base = (pick(pages, id=id_col, url=url_col)
            .select("id", host.alias("host"), path.alias("path"))
            .withColumn("_row", F.monotonically_increasing_id()))
    parts = F.split("host", r"\.", -1)
    suffixes = F.transform(F.filter(depths, lambda k: k <= F.size(parts)),
                           lambda k: F.array_join(F.slice(parts, F.size(parts) - k + 1, k), "."))
    prefixes = F.transform(F.filter(lengths, lambda n: n <= F.length("path")),
                           lambda n: F.substring(F.col("path"), F.lit(1), n))
    expressions = F.flatten(F.transform(suffixes, lambda h: F.transform(
        prefixes, lambda p: F.concat(h, F.lit("\n"), p))))
    found = (base.select("_row", "id", "host", "path", F.explode_outer(expressions).alias("_e"))
             .withColumn("_digest", _digest(F.col("_e"))).drop("_e")
             .withColumn("prefix", F.substring("_digest", 1, PREFIX_HEX)))
    hits = join_small(found, ready, "prefix", "left", max_rows=max_broadcast_rows)
    best = F.max(F.when(F.col("_digest") == F.col("digest"), F.struct(
        (F.col("host_len") + F.col("path_len")).alias("n"), "host_len", "action", "rule")))
    # Keyed by row: one row of the input never shares a group with another.
    return (hits.groupBy("_row", "id", "host", "path").agg(best.alias("_best"))
            .select(F.col("id").alias(id_col), "host", "path", F.col("_best.rule").alias("rule"),
                    F.coalesce(F.col("_best.action"), F.lit(default)).alias("verdict")))
