"""Ratings and catalog files (MovieLens layout), columns by name.

CSV columns are taken by their header names as text and cast by name, whatever their order; a
missing column fails.  ``NaN`` and empty fields become NaN and null and are removed by the
preparation step.  A row is *bad* if it has fewer or more fields than the header or a value that
does not parse.  ``on_bad`` says what becomes of it: ``"error"`` fails the job with the row and the
reason, ``"null"`` keeps it with nulls for what is wrong, ``"reject"`` leaves it out.  Nothing goes
unseen: ``rejected_ratings`` and ``rejected_catalog`` return every bad row with its reason,
``reject_counts`` their number by reason.  Any Hadoop file-system URI works as ``path`` (local,
HDFS, object stores).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RATINGS_COLUMNS = {"userId": "long", "movieId": "long", "rating": "double", "timestamp": "long"}
CATALOG_COLUMNS = {"movieId": "long", "title": "string", "genres": "string"}
ON_BAD = ("error", "null", "reject")
_LINE = "_bad_line"  # the raw line of a CSV row whose number of fields is wrong


def _load(spark: SparkSession, path: str, fmt: str, wanted: dict[str, str]) -> DataFrame:
    if fmt == "csv":
        header = spark.read.option("header", True).option("inferSchema", False).csv(path)
        schema = ", ".join(f"`{c}` string" for c in [*header.columns, _LINE])
        # Without column pruning every field of a line is counted.
        df = (spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").option("enforceSchema", False)
              .option("columnNameOfCorruptRecord", _LINE).option("columnPruning", False).csv(path))
    else:
        df = spark.read.format(fmt).load(path).withColumn(_LINE, F.lit(None).cast("string"))
    missing = [c for c in wanted if c not in df.columns]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}; it has {', '.join(c for c in df.columns if c != _LINE)}")
    return df


def _unparsed(name: str, kind: str) -> Column:
    """Why the value of a column is bad, null if it is not."""
    text = F.col(name).cast("string")
    if kind == "string":
        return F.lit(None).cast("string")
    bad = F.col(name).try_cast(kind).isNull() & (F.trim(text) != "")
    return F.when(bad, F.concat(F.lit(f"{name} is no {kind}: "), text))


def _reason(wanted: dict[str, str]) -> Column:
    fields = F.when(F.col(_LINE).isNotNull(), F.concat(F.lit("wrong number of fields: "), F.col(_LINE)))
    return F.coalesce(fields, *[_unparsed(c, t) for c, t in wanted.items()])


def _names(wanted: dict[str, str]) -> list[tuple[str, str, str]]:
    return [(c, t, "ts" if c == "timestamp" else c) for c, t in wanted.items()]


def _read(spark: SparkSession, path: str, fmt: str, on_bad: str, wanted: dict[str, str]) -> DataFrame:
    if on_bad not in ON_BAD:
        raise ValueError(f"on_bad must be one of {', '.join(ON_BAD)}")
    rows = _load(spark, path, fmt, wanted).withColumn("_reason", _reason(wanted))
    if on_bad == "reject":
        rows = rows.where(F.col("_reason").isNull())
    value = lambda c, t: F.col(c).try_cast(t)
    if on_bad == "error":
        value = lambda c, t: (F.when(F.col("_reason").isNotNull(), F.raise_error(F.col("_reason")).cast(t))
                              .otherwise(F.col(c).try_cast(t)))
    return rows.select(*[value(c, t).alias(n) for c, t, n in _names(wanted)])


def read_ratings(spark: SparkSession, path: str, fmt: str = "csv", on_bad: str = "error") -> DataFrame:
    """``userId, movieId, rating, ts`` (``ts`` = epoch seconds)."""
    return _read(spark, path, fmt, on_bad, RATINGS_COLUMNS)


def read_catalog(spark: SparkSession, path: str, fmt: str = "csv", on_bad: str = "error") -> DataFrame:
    """``movieId, title, genres`` (genres joined with ``|``)."""
    return _read(spark, path, fmt, on_bad, CATALOG_COLUMNS)


def _rejected(spark: SparkSession, path: str, fmt: str, wanted: dict[str, str]) -> DataFrame:
    rows = _load(spark, path, fmt, wanted).withColumn("reason", _reason(wanted)).where(F.col("reason").isNotNull())
    return rows.select(F.split_part("reason", F.lit(": "), F.lit(1)).alias("kind"), "reason",
                       *[F.col(c).cast("string").alias(n) for c, _, n in _names(wanted)])


def rejected_ratings(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """``kind, reason, userId, movieId, rating, ts`` (as text) of every bad row."""
    return _rejected(spark, path, fmt, RATINGS_COLUMNS)


def rejected_catalog(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """``kind, reason, movieId, title, genres`` (as text) of every bad row."""
    return _rejected(spark, path, fmt, CATALOG_COLUMNS)


def reject_counts(rejected: DataFrame) -> DataFrame:
    """``kind, n``: bad rows by kind."""
    return rejected.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))
