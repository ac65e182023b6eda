"""Join helpers for plans keyed by user.

User-keyed work runs on ratings hash-partitioned by user once; aggregates, windows and
broadcast joins on that input keep the partitioning, so the large per-(user, item)
intermediates are produced, aggregated and cut to N rows per user without leaving their
partition.  Anything combining two separately shuffled inputs is an ordinary join (Spark
plans the exchange), and unions that feed a per-user window are first cut to at most N
rows per user and then explicitly repartitioned, so no result depends on two inputs
sharing a partition layout at run time.

Catalog-sized tables are broadcast only after their size (rows times a stated width) is
checked against a limit; above it the same plan runs with shuffle joins.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bytes that one broadcast table may take.  Rows are counted before use and weighed with a
# stated width; larger tables take the shuffle path.  A plan holds at most six such tables.
BROADCAST_BYTE_LIMIT = 96 << 20
# Widths: three numbers; an id with a title, genre array or signature text.
NUMBER_ROW, ITEM_ROW = 32, 256
# Rows of one key that one task may take in a join whose keys can be heavy.
PART_ROWS = 1 << 20


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def by_user(df: DataFrame) -> DataFrame:
    """Hash-partition by user into the session's shuffle-partition count.

    The count is fixed on purpose: the rating rows are small, but each one fans out into
    ~K scored rows downstream, so the partition count must not be shrunk to fit the
    input size (a fixed count is not coalesced by AQE).
    """
    return df.repartition(shuffle_partitions(df), "userId")


def fits_broadcast(n_rows: int, row_bytes: int = NUMBER_ROW) -> bool:
    return n_rows * row_bytes <= BROADCAST_BYTE_LIMIT


def maybe_broadcast(df: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(df) if small else df


def _parts(df: DataFrame, key: str, part_rows: int, name: str) -> DataFrame | None:
    """``key, name``: the parts of keys with more than ``part_rows`` rows (at most rows / part_rows keys); None if
    there are none, or more than a broadcast may hold."""
    from cinerank.session import materialize

    heavy = (df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > part_rows)
             .select(key, F.ceil(F.col("_n") / F.lit(part_rows)).cast("int").alias(name)))
    heavy = materialize(heavy, "heavy_keys")
    n = heavy.count()
    return heavy if n and fits_broadcast(n) else None


def split_join(left: DataFrame, right: DataFrame, key: str, part_rows: int = PART_ROWS) -> DataFrame:
    """Inner join on ``key`` with heavy keys dealt over tasks on both sides.

    Counting with map-side combination finds the keys above ``part_rows`` rows of each side.  A key with
    l parts on the left and r on the right becomes l x r keys: each side's rows go to one of
    their own parts by a hash of the row and to every part of the other side.  All other keys are
    hashed as they are; without heavy keys this is the plain join.
    """
    many_left, many_right = _parts(left, key, part_rows, "_pl"), _parts(right, key, part_rows, "_pr")
    if many_left is None and many_right is None:
        return left.join(right, key)

    def dealt(df: DataFrame, own: str, other: str) -> DataFrame:
        row = F.xxhash64(*[F.col(c) for c in df.columns])
        for heavy, name in ((many_left, "_pl"), (many_right, "_pr")):
            df = df.withColumn(name, F.lit(1)) if heavy is None else (
                df.join(F.broadcast(heavy), key, "left").withColumn(name, F.coalesce(name, F.lit(1))))
        return (df.withColumn(own, F.pmod(row, F.col(own)).cast("int"))
                .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(other) - 1))))

    return dealt(left, "_pl", "_pr").join(dealt(right, "_pr", "_pl"), [key, "_pl", "_pr"]).drop("_pl", "_pr")


def union_by_user(*frames: DataFrame) -> DataFrame:
    """Union of small per-user frames, explicitly clustered by user."""
    return reduce(lambda a, b: a.unionByName(b), frames).repartition("userId")


def with_count(users: DataFrame, counted: DataFrame, name: str) -> DataFrame:
    """``userId, <name>``: rows of ``counted`` per user, 0 for users without rows."""
    counts = counted.groupBy("userId").agg(F.count(F.lit(1)).alias(name))
    return users.select("userId").join(counts, "userId", "left").select(
        "userId", F.coalesce(F.col(name), F.lit(0)).alias(name))
