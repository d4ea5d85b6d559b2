"""Distributed data profiling: the numbers behind every exploratory plot.

Each function returns a small DataFrame computed with one or two passes of
aggregates (partial + final), never by collecting a column. Per-column
statistics are computed in a single wide ``agg`` and unpivoted, so the scan
happens once for all columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, FloatType, NumericType, StringType

from starloom.functions.numeric import round_half_up
from starloom.functions.text import display_first_part
from starloom.operators.quantiles import exact_quantiles, long_values, number


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NumericType) and not isinstance(f.dataType, BooleanType)
            and f.name not in exclude]


def _unpivot_row(df: DataFrame, names: Sequence[str], exprs: dict[str, list[Column]],
                 value_cols: Sequence[str]) -> DataFrame:
    """One wide aggregate row -> one row per column name."""
    flat = []
    for n in names:
        flat += [e.alias(f"{n}\u0001{v}") for e, v in zip(exprs[n], value_cols)]
    wide = df.agg(*flat)
    structs = [F.struct(F.lit(n).alias("column_name"),
                        *[F.col(f"`{n}\u0001{v}`").alias(v) for v in value_cols])
               for n in names]
    return wide.select(F.explode(F.array(*structs)).alias("s")).select("s.*")


def _present(df: DataFrame, c: str) -> Column:
    """The column with NaN as missing."""
    floating = isinstance(df.schema[c].dataType, (FloatType, DoubleType))
    return number(c) if floating else F.col(f"`{c}`")


def shape(df: DataFrame, name: str) -> DataFrame:
    """(table_name, n_rows, n_cols)."""
    return df.agg(F.count(F.lit(1)).cast("long").alias("n_rows")).select(
        F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).alias("n_cols"))


def info(df: DataFrame) -> DataFrame:
    """(position, column_name, dtype, non_null) per column."""
    names = df.columns
    out = _unpivot_row(df, names, {c: [F.count(_present(df, c)).cast("long")] for c in names},
                       ["non_null"])
    meta = {f.name: (i, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)}
    pos = F.create_map(*[x for n in names for x in (F.lit(n), F.lit(meta[n][0]))])
    typ = F.create_map(*[x for n in names for x in (F.lit(n), F.lit(meta[n][1]))])
    return out.select(pos[F.col("column_name")].alias("position"), "column_name",
                      typ[F.col("column_name")].alias("dtype"), "non_null")


def nulls(df: DataFrame, name: str | None = None, only_missing: bool = False) -> DataFrame:
    """(column_name, nulls, pct) per column, sorted by pct desc; one scan."""
    names = df.columns
    exprs = {c: [F.count_if(_present(df, c).isNull()).cast("long"), F.count(F.lit(1))]
             for c in names}
    out = _unpivot_row(df, names, exprs, ["nulls", "_n"])
    out = out.select("column_name", "nulls",
                     round_half_up(F.try_divide(F.col("nulls"), F.col("_n")) * 100, 6).alias("pct"))
    if name is not None:
        out = out.select(F.lit(name).alias("table_name"), "*")
    if only_missing:
        out = out.filter(F.col("nulls") > 0)
    return out.orderBy(F.desc("pct"), F.asc("column_name"))


def describe(df: DataFrame, cols: Sequence[str] | None = None, digits: int = 6) -> DataFrame:
    """count, mean, sample std, min, quartiles (exact, linear), max per column; NaN counts as
    missing. Moments are one wide aggregate, quartiles come from :func:`exact_quantiles`."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    exprs = {c: [F.count(number(c)).cast("long"), F.avg(number(c)), F.stddev_samp(number(c)),
                 F.min(number(c)), F.max(number(c))] for c in cols}
    moments = _unpivot_row(df, cols, exprs, ["count", "mean", "std", "min", "max"])
    quartiles = exact_quantiles(df, cols, [0.25, 0.5, 0.75]).groupBy("column_name").agg(
        *[F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(a)
          for p, a in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))])
    # One row per column: a bounded broadcast.
    out = moments.join(F.broadcast(quartiles), "column_name", "left")
    return out.select("column_name", "count", *[round_half_up(F.col(c), digits).alias(c) for c in (
        "mean", "std", "min", "q25", "q50", "q75", "max")])


def top_values(df: DataFrame, col: str | Column, n: int | None = None,
               name: str = "value") -> DataFrame:
    """Value frequencies (nulls dropped) by count desc, value asc; top ``n``."""
    c = F.col(col) if isinstance(col, str) else col
    counts = (df.select(c.alias(name)).filter(F.col(name).isNotNull())
              .groupBy(name).agg(F.count(F.lit(1)).cast("long").alias("n")))
    ordered = counts.orderBy(F.desc("n"), F.asc(name))
    return ordered.limit(n) if n is not None else ordered


def describe_all(df: DataFrame, digits: int = 6) -> DataFrame:
    """``describe(include='all')``: count for every column; unique/top/freq
    for text and boolean columns; numeric summaries for numeric columns
    (null elsewhere).

    Text statistics come from one (column, value, count) table built by a
    partial/final hash aggregate, so no distinct aggregate expands the
    source once per column.
    """
    names = df.columns
    strings = [f.name for f in df.schema.fields
               if isinstance(f.dataType, (StringType, BooleanType))]
    nums = [c for c in numeric_columns(df) if c not in strings]
    out = _unpivot_row(df, names, {c: [F.count(_present(df, c)).cast("long")] for c in names},
                       ["count"])
    if strings:
        long = df.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("v"))
            for c in strings])).alias("s")).select("s.*").filter(F.col("v").isNotNull())
        freq = long.groupBy("column_name", "v").agg(F.count(F.lit(1)).cast("long").alias("n"))
        # Mode: highest count, smallest value among ties -- aggregates plus a
        # one-row-per-column broadcast, so no column is sorted in one task.
        peak = freq.groupBy("column_name").agg(F.max("n").alias("freq"),
                                               F.count(F.lit(1)).cast("long").alias("unique"))
        tops = (freq.join(F.broadcast(peak), "column_name")
                .filter(F.col("n") == F.col("freq"))
                .groupBy("column_name", "unique", "freq").agg(F.min("v").alias("top")))
        out = out.join(F.broadcast(tops), "column_name", "left")  # one row per column
    else:
        out = out.select("*", F.lit(None).cast("long").alias("unique"),
                         F.lit(None).cast("string").alias("top"),
                         F.lit(None).cast("long").alias("freq"))
    if nums:
        out = out.join(F.broadcast(describe(df, nums, digits).drop("count")), "column_name",
                       "left")
    else:
        for c in ("mean", "std", "min", "q25", "q50", "q75", "max"):
            out = out.withColumn(c, F.lit(None).cast("double"))
    return out


def repeated_signature_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows whose 96-bit signature over ``cols`` occurs more than once: a superset of every
    repeated group. Only signatures are grouped; the rows then meet the repeated signatures
    in a semi join (a broadcast where those are proven small, else a shuffle on the narrow
    signature, whose skewed partitions AQE splits)."""
    from starloom.operators.joins import join_small
    from starloom.session import stage

    tagged = df.withColumns({"_h1": F.xxhash64(*cols), "_h2": F.hash(*cols)})
    repeated = stage(tagged.groupBy("_h1", "_h2").agg(F.count(F.lit(1)).alias("_n"))
                     .filter(F.col("_n") > 1).drop("_n"), "dup-signatures")
    return join_small(tagged, repeated, ["_h1", "_h2"], "left_semi").drop("_h1", "_h2")


def duplicate_count(df: DataFrame, ignore: Sequence[str] = (),
                    by_signature: bool = False) -> DataFrame:
    """Rows that repeat an earlier row (``duplicated().sum()``), comparing all
    columns except ``ignore``. ``by_signature`` (for long-text rows) groups
    full rows only among signature-collision candidates; rows outside them
    are in groups of one and add nothing, so the count stays exact."""
    cols = [c for c in df.columns if c not in ignore]
    src = df.select(*cols)
    if by_signature:
        src = repeated_signature_rows(src, cols)
    return (src.groupBy(*cols).agg(F.count(F.lit(1)).alias("_c"))
            .agg(F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).cast("long").alias("duplicates")))


def duplicate_members(df: DataFrame, ignore: Sequence[str] = (),
                      order_by: Sequence[str] = (), n: int | None = None,
                      by_signature: bool = False) -> DataFrame:
    """All members of repeated groups (``keep=False``), sorted, first ``n``.

    Group sizes are counted by a partial/final aggregate and joined back,
    rather than a window over each group, so a huge group of copies is never
    buffered in one task. ``by_signature`` restricts both steps to
    signature-collision candidates (exact, far less text shuffled).
    """
    cols = [c for c in df.columns if c not in ignore]
    src = df
    if by_signature:
        src = repeated_signature_rows(df, cols)
    sizes = (src.groupBy(*cols).agg(F.count(F.lit(1)).alias("_c"))
             .filter(F.col("_c") > 1).drop("_c"))
    members = src.join(sizes, [src[c].eqNullSafe(sizes[c]) for c in cols], "left_semi")
    if order_by:
        members = members.orderBy(*order_by)
    return members.limit(n) if n is not None else members


def key_duplicate_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of rows whose key repeats (``duplicated(subset, keep=False).sum()``)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c"))
            .agg(F.coalesce(F.sum(F.when(F.col("_c") > 1, F.col("_c"))), F.lit(0))
                 .cast("long").alias("rows_with_repeated_key")))


def first_entity_counts(df: DataFrame, col: str, n: int = 10) -> DataFrame:
    """Frequencies of the stripped first ``;`` element (case kept), top ``n``."""
    return top_values(df.filter(F.col(col).isNotNull()), display_first_part(col), n, "entity")


def head_tail(df: DataFrame, order_col: str, n: int = 5) -> DataFrame:
    """First and last ``n`` rows in source order. The two top-k run over the order column
    alone; the few rows are then fetched by it."""
    keys = df.select(order_col)
    parts = []
    for part, order in (("head", F.asc(order_col)), ("tail", F.desc(order_col))):
        top = keys.orderBy(order).limit(n).groupBy(order_col).agg(F.count(F.lit(1)).alias("_take"))
        rows = df.join(F.broadcast(top), order_col)  # at most n rows
        # Rows that share the last order value: only as many as belong to the n.
        rank = F.row_number().over(Window.partitionBy(order_col).orderBy(order_col))
        parts.append(rows.withColumn("_rank", rank).where("_rank <= _take")
                     .select(*df.columns, F.lit(part).alias("part")))
    return parts[0].unionByName(parts[1])


def histogram(df: DataFrame, cols: Sequence[str], bins: int = 50, digits: int = 6) -> DataFrame:
    """Equal-width histogram per column with numpy's edge rules (right edge of
    the last bin closed, degenerate range widened by 0.5); empty bins kept."""
    names = list(cols)
    ranges = df.agg(*[f(number(c)).alias(f"{s}{i}") for i, c in enumerate(names)
                      for s, f in (("l", F.min), ("h", F.max))]).first()  # two numbers per column
    held = [(i, c) for i, c in enumerate(names) if ranges[f"l{i}"] is not None]
    spans = {}
    for i, c in held:
        lo, hi = ranges[f"l{i}"], ranges[f"h{i}"]
        spans[c] = (lo - 0.5, hi + 0.5) if lo == hi else (lo, hi)
    edges = df.sparkSession.createDataFrame([(i, c, *spans[c]) for i, c in held],
                                            "i int, column_name string, _lo double, _hi double")

    def edge(i: Column) -> Column:
        return F.when(i >= bins, F.col("_hi")).otherwise(i * ((F.col("_hi") - F.col("_lo")) / bins) + F.col("_lo"))

    # One row for each value; a bin is estimated first and then set right by its edges.
    x, b = F.col("x"), F.col("bin")
    binned = (long_values(df, names).join(F.broadcast(edges), "i")  # one row for each column
              .withColumn("bin", F.least(((x - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * bins).cast("int"),
                                         F.lit(bins - 1)))
              .withColumn("bin", F.when(x < edge(b), b - 1).otherwise(b))
              .withColumn("bin", F.when((b != bins - 1) & (x >= edge(b + 1)), b + 1).otherwise(b)))
    counts = binned.groupBy("column_name", "bin").agg(F.count(F.lit(1)).cast("long").alias("n"))
    grid = edges.select("column_name", "_lo", "_hi",
                        F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    out = grid.join(counts, ["column_name", "bin"], "left")
    return out.select("column_name", "bin",
                      round_half_up(edge(F.col("bin")), digits).alias("bin_lo"),
                      round_half_up(edge(F.col("bin") + 1), digits).alias("bin_hi"),
                      F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n"))


def boxstats(df: DataFrame, cols: Sequence[str], whis: float = 1.5, digits: int = 6) -> DataFrame:
    """Quartiles, IQR, whiskers (extreme values inside q1 - whis*IQR and q3 + whis*IQR, never
    inside the box) and the count of values beyond the whiskers per column. Quartiles are
    exact; whiskers and outliers are one wide aggregate with the fences they give."""
    quartiles = {(r["column_name"], r["prob"]): r["quantile"]
                 for r in exact_quantiles(df, cols, [0.25, 0.5, 0.75]).collect()}  # columns x 3 numbers
    exprs, held = {}, [c for c in cols if (c, 0.5) in quartiles]
    for c in held:
        q1, median, q3 = (quartiles[c, p] for p in (0.25, 0.5, 0.75))
        low, high = q1 - (q3 - q1) * whis, q3 + (q3 - q1) * whis
        x = number(c)
        exprs[c] = [F.lit(q1), F.lit(median), F.lit(q3), F.lit(q3 - q1),
                    F.least(F.coalesce(F.min(F.when(x >= low, x)), F.lit(q1)), F.lit(q1)),
                    F.greatest(F.coalesce(F.max(F.when(x <= high, x)), F.lit(q3)), F.lit(q3)),
                    F.count_if((x < low) | (x > high)).cast("long")]
    names = ["q1", "median", "q3", "iqr", "whisker_lo", "whisker_hi", "outliers"]
    if not held:
        return df.sparkSession.createDataFrame(
            [], "column_name string, " + ", ".join(f"{n} double" for n in names[:-1]) + ", outliers long")
    return _unpivot_row(df, held, exprs, names).select(
        "column_name", *[round_half_up(F.col(c), digits).alias(c) for c in names[:-1]], "outliers")


def corr_matrix(df: DataFrame, cols: Sequence[str], digits: int = 6) -> DataFrame:
    """Pearson correlation for every ordered pair of columns over the rows that have both (NaN
    counts as missing); NaN where a column is constant or fewer than two rows remain.

    Two scans: column means, then for every unordered pair five sums of the values shifted by
    those means, over the rows that have both. The formula is applied afterwards to one row
    per pair."""
    cols = list(cols)
    data = df.select(*[number(c).alias(f"c{i}") for i, c in enumerate(cols)])
    # One number per column, fetched to the driver.
    means = data.agg(*[F.avg(f"c{i}").alias(f"m{i}") for i in range(len(cols))]).first()
    shifted = data.select(*[(F.col(f"c{i}") - F.lit(means[i] or 0.0)).alias(f"c{i}") for i in range(len(cols))])
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    sums = []
    for k, (i, j) in enumerate(pairs):
        x, y = F.col(f"c{i}"), F.col(f"c{j}")
        both = x.isNotNull() & y.isNotNull()
        sums += [F.count_if(both).alias(f"n{k}"), F.sum(x * y).alias(f"xy{k}"),
                 F.sum(F.when(both, x)).alias(f"x{k}"), F.sum(F.when(both, y)).alias(f"y{k}"),
                 F.sum(F.when(both, x * x)).alias(f"xx{k}"), F.sum(F.when(both, y * y)).alias(f"yy{k}")]
    # As many pairs to an aggregate as generated code takes.
    parts = [shifted.agg(*sums[at:at + 6 * 12]) for at in range(0, len(sums), 6 * 12)]
    rows = [part.select(F.explode(F.array(*[F.struct(
        F.lit(cols[i]).alias("a"), F.lit(cols[j]).alias("b"),
        *[F.col(f"{s}{k}").alias(s) for s in ("n", "xy", "x", "y", "xx", "yy")])
        for k, (i, j) in list(enumerate(pairs))[at * 12:at * 12 + 12]])).alias("s")).select("s.*")
        for at, part in enumerate(parts)]
    long = rows[0]
    for r in rows[1:]:
        long = long.unionByName(r)
    n = F.col("n").cast("double")
    cov, var_x, var_y = (F.col(s) - F.try_divide(F.col(u) * F.col(v), n) for s, u, v in (
        ("xy", "x", "y"), ("xx", "x", "x"), ("yy", "y", "y")))
    value = F.coalesce(F.when((n >= 2) & (var_x > 0) & (var_y > 0), F.try_divide(cov, F.sqrt(var_x * var_y))),
                       F.lit(float("nan")))
    out = long.select("a", "b", round_half_up(value, digits).alias("corr"))
    ways = F.when(F.col("a") == F.col("b"), F.array(F.struct(F.col("a").alias("col_a"), F.col("b").alias("col_b")))
                  ).otherwise(F.array(F.struct(F.col("a").alias("col_a"), F.col("b").alias("col_b")),
                                      F.struct(F.col("b").alias("col_a"), F.col("a").alias("col_b"))))
    return out.select("corr", F.explode(ways).alias("w")).select("w.col_a", "w.col_b", "corr")
