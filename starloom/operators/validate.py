"""Warehouse contract as distributed validation jobs.

Spark tables do not enforce keys, so each DDL constraint becomes a query
that returns its violations: primary/unique keys as grouped counts (partial
aggregation absorbs hot keys), foreign keys as anti joins (dimension side
broadcast only when its size is proven), NOT NULL and domain rules as one
aggregate pass per table. ``enforce`` raises before anything is published.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators.joins import join_small
from starloom.operators.star import Star
from starloom.schemas import LENGTHS, RANGES, WAREHOUSE
from starloom.session import Staged

PRIMARY_KEYS = {
    "dim_artist": ("artist_key",),
    "dim_album": ("album_key",),
    "dim_genre": ("genre_key",),
    "dim_year": ("year_key",),
    "fact_track": ("track_id", "genre_key"),
}

# (table, column, collation or None): natural keys that must be unique.
UNIQUE_KEYS = (
    ("dim_artist", "artist_norm", None),
    ("dim_genre", "genre_name", "UNICODE_CI_AI"),
    ("dim_year", "year_value", None),
)

FOREIGN_KEYS = (
    ("fk_fact_artist", "artist_key", "dim_artist"),
    ("fk_fact_album", "album_key", "dim_album"),
    ("fk_fact_genre", "genre_key", "dim_genre"),
    ("fk_fact_year", "year_key", "dim_year"),
)


class ContractViolation(Exception):
    """Raised by :func:`enforce` when any check finds violations."""


def grain_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key tuples that occur more than once, with their multiplicity."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).cast("long").alias("n"))
            .filter(F.col("n") > 1))


def unique_violations(df: DataFrame, col: str, collation: str | None = None,
                      key: str | None = None) -> DataFrame:
    """Groups of rows whose ``col`` is equal (under ``collation``, e.g.
    ``UNICODE_CI_AI`` where 'Pop' equals an accented 'pop')."""
    c = F.collate(F.col(col), collation) if collation else F.col(col)
    aggs = [F.count(F.lit(1)).cast("long").alias("n")]
    if key:
        aggs.insert(0, F.min(key).alias(key))
    return df.groupBy(c.alias("_v")).agg(*aggs).filter(F.col("n") > 1).drop("_v")


def fk_orphans(star: Star) -> DataFrame:
    """(fk_name, orphans): fact rows whose key has no dimension row.

    One scan of the fact gives the rows per (foreign key, value), combined map-side, so what
    meets the dimensions is no larger than they are and no value is hot."""
    values = (star.fact_track.select(F.explode(F.array(*[
        F.struct(F.lit(name).alias("fk_name"), F.col(col).cast("long").alias("value"))
        for name, col, _ in FOREIGN_KEYS])).alias("s")).select("s.*")
        .groupBy("fk_name", "value").agg(F.count(F.lit(1)).alias("n")))
    known = _union([getattr(star, dim).select(F.lit(name).alias("fk_name"), F.col(col).cast("long").alias("value"))
                    for name, col, dim in FOREIGN_KEYS])
    if all(dim in star.sizes for _, _, dim in FOREIGN_KEYS):
        rows = sum(star.sizes[dim][0] for _, _, dim in FOREIGN_KEYS)
        known = Staged(known, rows, 32 * rows)
    missing = join_small(values, known, ["fk_name", "value"], "left_anti")
    counts = missing.groupBy("fk_name").agg(F.sum("n").alias("n"))
    names = star.fact_track.sparkSession.createDataFrame([(n,) for n, _, _ in FOREIGN_KEYS], "fk_name string")
    return names.join(F.broadcast(counts), "fk_name", "left").select(  # a row for each foreign key
        "fk_name", F.coalesce("n", F.lit(0)).cast("long").alias("orphans"))


def _rules(table: str) -> list[tuple[str, str, Column]]:
    """(column, rule, violation predicate) for every rule on ``table``:
    NOT NULL on each column, then value ranges and VARCHAR lengths."""
    items = [(f.name, "not null", F.col(f.name).isNull()) for f in WAREHOUSE[table].fields]
    items += [(col, f"between {lo} and {hi}", ~F.col(col).between(lo, hi))
              for t, col, lo, hi in RANGES if t == table]
    items += [(col, f"length <= {n}", F.char_length(F.col(col)) > n)
              for t, col, n in LENGTHS if t == table]
    return items


def rule_counts(star: Star, which: str | None = None) -> DataFrame:
    """(table_name, column_name, rule, violations): NOT NULL and domain rules
    of a table evaluated together in one aggregate pass over it. ``which`` is ``"null"`` or
    ``"domain"`` for one kind of rules only."""
    parts = []
    for table, df in star.tables().items():
        items = [r for r in _rules(table) if which is None or (r[1] == "not null") == (which == "null")]
        if not items:
            continue
        wide = df.agg(*[F.count_if(bad).cast("long").alias(f"r{i}")
                        for i, (_, _, bad) in enumerate(items)])
        parts.append(wide.select(F.explode(F.array(*[
            F.struct(F.lit(table).alias("table_name"), F.lit(col).alias("column_name"),
                     F.lit(rule).alias("rule"), F.col(f"r{i}").alias("violations"))
            for i, (col, rule, _) in enumerate(items)])).alias("s")).select("s.*"))
    return _union(parts)


def null_counts(star: Star) -> DataFrame:
    """(table_name, column_name, nulls) for every warehouse column."""
    return rule_counts(star, "null").select("table_name", "column_name", F.col("violations").alias("nulls"))


def domain_violations(star: Star) -> DataFrame:
    """(table_name, column_name, rule, violations) for value ranges (TINYINT
    and unsigned TINYINT) and VARCHAR lengths."""
    return rule_counts(star, "domain")


def violations(star: Star) -> DataFrame:
    """Summary: (check_name, table_name, n) for every contract rule."""
    parts = []
    for table, keys in PRIMARY_KEYS.items():
        g = grain_violations(getattr(star, table), keys)
        parts.append(g.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n")).select(
            F.lit("primary_key").alias("check_name"), F.lit(table).alias("table_name"), "n"))
    for table, col, coll in UNIQUE_KEYS:
        u = unique_violations(getattr(star, table), col, coll)
        parts.append(u.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n")).select(
            F.lit(f"unique_{col}").alias("check_name"), F.lit(table).alias("table_name"), "n"))
    parts.append(fk_orphans(star).select(F.col("fk_name").alias("check_name"),
                                         F.lit("fact_track").alias("table_name"),
                                         F.col("orphans").alias("n")))
    # NOT NULL and domain rules share one pass per table.
    rules = rule_counts(star).withColumn(
        "check_name", F.when(F.col("rule") == "not null", F.lit("not_null"))
        .otherwise(F.lit("domain")))
    parts.append(rules.groupBy("check_name", "table_name").agg(
        F.sum("violations").cast("long").alias("n")).select("check_name", "table_name", "n"))
    return _union(parts)


def enforce(star: Star) -> DataFrame:
    """Run every check; raise :class:`ContractViolation` listing the failing
    rules. Returns the (small) report otherwise."""
    report = violations(star)
    failing = report.filter(F.col("n") > 0).collect()  # one row per rule: bounded
    if failing:
        detail = ", ".join(f"{r['check_name']}@{r['table_name']}={r['n']}" for r in failing)
        raise ContractViolation(f"warehouse contract violated: {detail}")
    return report


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
