"""Ratings and catalog views over the driver's TPC-H-like tables.

ratings: one row per (customer, part) = (userId, movieId) from lineitem JOIN orders;
the latest order wins (then order key, line number, quantity, all descending);
rating = ceil(l_quantity / 5) / 2, i.e. 0.5 .. 5.0 in half steps; ts = epoch seconds
of the order date.

catalog: part; title = p_name + ' #' + p_partkey; genres = p_type, then the two words
of p_name, joined by '|'; parts of size 50 have no genres.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cinerank.functions.genres import NO_GENRES
from cinerank.operators.joins import by_user


def load_tables(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{sf_dir.rstrip('/')}/{n}.parquet") for n in names}


def epoch_seconds(c: Column) -> Column:
    """Seconds since 1970-01-01 of a TIMESTAMP_NTZ (or DATE) value, time-zone free."""
    day = F.unix_date(F.to_date(c)).cast("long") * 86400
    return day + F.hour(c).cast("long") * 3600 + F.minute(c).cast("long") * 60 + F.second(c).cast("long")


def ratings_from_tables(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    items = lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    heads = orders.select("o_orderkey", "o_custkey", "o_orderdate")
    joined = items.join(heads, items.l_orderkey == heads.o_orderkey).select(
        F.col("o_custkey").alias("userId"), F.col("l_partkey").alias("movieId"),
        epoch_seconds(F.col("o_orderdate")).alias("ts"), "l_orderkey", "l_linenumber", "l_quantity")
    # One row per (user, item): max over a struct = latest date, then keys.  Dealt by user alone, so the rows
    # are sorted for the aggregate once and whatever reads them by user needs no exchange.
    latest = F.max(F.struct("ts", "l_orderkey", "l_linenumber", "l_quantity")).alias("latest")
    deduped = by_user(joined).groupBy("userId", "movieId").agg(latest)
    return deduped.select(
        "userId", "movieId",
        (F.ceil(F.col("latest.l_quantity") / 5.0) / 2.0).alias("rating"),
        F.col("latest.ts").alias("ts"),
    )


def catalog_from_part(part: DataFrame) -> DataFrame:
    first = F.split_part(F.col("p_name"), F.lit(" "), F.lit(1))
    second = F.split_part(F.col("p_name"), F.lit(" "), F.lit(2))
    genres = F.when(F.col("p_size") == 50, F.lit(NO_GENRES)).otherwise(
        F.concat_ws("|", F.col("p_type"), first, second))
    return part.select(
        F.col("p_partkey").alias("movieId"),
        F.concat(F.col("p_name"), F.lit(" #"), F.col("p_partkey").cast("string")).alias("title"),
        genres.alias("genres"),
    )


def ratings_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = load_tables(spark, sf_dir, "lineitem", "orders")
    return ratings_from_tables(t["lineitem"], t["orders"])


def catalog_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog_from_part(load_tables(spark, sf_dir, "part")["part"])
