"""The two sources derived from the driver's TPC-H-like tables.

Customer = artist, part brand = genre, part name = album, events = award
ceremonies, day of year = ceremony year. Each reader projects only the
columns it needs, so the parquet scans are pruned; lookup tables are broadcast
where their measured size allows, other joins are left to Catalyst + AQE
(sort-merge with skew splitting).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators.joins import join_small
from starloom.schemas import ROW_ORD


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def source_order() -> Column:
    """Order, line, part and supplier number side by side in 38 digits: the order of the
    source rows, at any scale factor (a long would overflow)."""
    def wide(c: Column | int) -> Column:
        return (F.lit(c) if isinstance(c, int) else c).cast("decimal(38,0)")

    out = F.col("l_orderkey").cast("decimal(13,0)") * F.lit(10).cast("decimal(2,0)") + F.col("l_linenumber")
    for column, digits in (("l_partkey", 11), ("l_suppkey", 10)):
        out = wide(out) * F.expr(f"CAST({10 ** digits} AS DECIMAL({digits + 1},0))") + wide(F.col(column))
    return wide(out)


def _lookup(big: DataFrame, small: DataFrame, key: str, small_key: str) -> DataFrame:
    return join_small(big, small.withColumnRenamed(small_key, key), key)


def track_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line items with what the track source takes of their orders, customers, parts and
    suppliers: the rows of ``raw_tracks`` before its columns are made of them, less than half as
    wide. Only what is needed of a column meets a join."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        F.floor("l_extendedprice").alias("whole_price"), "l_discount", "l_tax",
        (F.col("l_returnflag") == "R").alias("returned"),
        F.when(F.col("l_linestatus") == "O", 1).otherwise(0).alias("open"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_size")
    supp = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")

    # Orders meet their customers before the wide rows do; tables of a proven size do not move those.
    buyers = _lookup(orders, cust, "o_custkey", "c_custkey")
    j = li.join(buyers, F.col("l_orderkey") == F.col("o_orderkey"))
    j = _lookup(_lookup(j, part, "l_partkey", "p_partkey"), supp, "l_suppkey", "s_suppkey")
    return j.drop("o_orderkey", "o_custkey")


def tracks_of(lines: DataFrame) -> DataFrame:
    """The track source made of :func:`track_lines`, row by row: 20 columns plus ``_row_ord``."""
    line = F.col("l_linenumber")
    artists = (F.when(F.col("l_orderkey") % 997 == 0, F.lit(None).cast("string"))
               .when(line > 3, F.concat(F.col("c_name"), F.lit(";"), F.col("s_name")))
               .when(line == 3, F.concat(F.lit(" "), F.upper("c_name")))
               .otherwise(F.col("c_name")))
    return lines.select(
        source_order().alias(ROW_ORD),
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), line.cast("string"))
        .alias("track_id"),
        artists.alias("artists"),
        F.col("p_name").alias("album_name"),
        F.concat(F.col("p_name"), F.lit(" #"), line.cast("string")).alias("track_name"),
        (F.floor("l_quantity").cast("int") * 2).alias("popularity"),
        F.col("whole_price").cast("int").alias("duration_ms"),
        F.col("returned").alias("explicit"),
        (F.col("l_discount") * 10).alias("danceability"),
        (F.col("l_tax") * 10).alias("energy"),
        line.cast("int").alias("key"),
        (-F.col("l_quantity")).alias("loudness"),
        F.col("open").alias("mode"),
        ((F.col("l_partkey") % 100).cast("double") / 100).alias("speechiness"),
        ((F.col("l_suppkey") % 10).cast("double") / 10).alias("acousticness"),
        ((F.col("l_orderkey") % 50).cast("double") / 50).alias("instrumentalness"),
        ((F.col("l_orderkey") % 25).cast("double") / 25).alias("liveness"),
        (F.col("p_size").cast("double") / 50).alias("valence"),
        (F.lit(60) + F.col("l_quantity")).alias("tempo"),
        (F.lit(3) + line % 3).cast("int").alias("time_signature"),
        F.col("p_brand").alias("track_genre"),
    )


def raw_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Track-grain source: one row per line item, 20 columns plus ``_row_ord``."""
    return tracks_of(track_lines(spark, sf_dir))


def raw_awards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Awards landing table (10 text-ish columns plus ``_row_ord``): every event,
    a purchase being a win and any other a nomination only."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "props")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    j = _lookup(ev, cust, "user_id", "c_custkey")

    eid = F.col("event_id")
    ts_text = F.col("ts").cast("string")
    doy = F.dayofyear("ts").cast("int")
    return j.select(
        eid.alias(ROW_ORD),
        doy.alias("year"),
        F.concat(F.lit("Round "), doy.cast("string")).alias("title"),
        F.when(eid % 3 == 0, ts_text)
        .when(eid % 3 == 1, F.concat(F.substring(ts_text, 1, 10), F.lit("T00:00:00-08:00")))
        .otherwise(F.lit("")).alias("published_at"),
        ts_text.alias("updated_at"),
        F.concat(F.lit(" "), F.upper("event_type")).alias("category"),
        F.when(eid % 11 == 0, F.lit("")).otherwise(F.col("props")).alias("nominee"),
        F.when(eid % 40 == 0, F.lit(""))
        .when(eid % 3 == 0, F.concat(F.lit("  "), F.upper("c_name")))
        .when(eid % 3 == 1, F.concat(F.col("c_name"), F.lit(";Guest")))
        .otherwise(F.col("c_name")).alias("artist"),
        F.lit("crew").alias("workers"),
        F.lit("http://img").alias("img"),
        F.when(F.col("event_type") == "purchase", F.lit(" True")).otherwise(F.lit("False"))
        .alias("winner"),
    )


def gappy_tracks_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The track source as text with gaps, as an export has them: missing-value tokens, NaN and
    whole numbers written with a decimal point. By row: order number modulo 7, 5 and 3."""
    order = F.col("track_id").substr(F.lit(1), F.instr("track_id", "-") - 1).cast("long")
    return raw_tracks(spark, sf_dir).withColumns({
        "popularity": F.when(order % 7 == 0, "NA").otherwise(F.concat(F.col("popularity").cast("string"), F.lit(".0"))),
        "energy": F.when(order % 5 == 0, "NaN").otherwise(F.col("energy").cast("string")),
        "tempo": F.when(order % 3 == 0, "n/a").otherwise(F.col("tempo").cast("string")),
        "valence": F.lit("null")})
