"""Line dedup by winnowing over line hashes, in DataFrame functions only.

A document is a sequence of *units*: every line that is not blank is one unit, a line of at
least ``long_chars`` characters (several words) two, so one repeated line of that length is a run by
itself.  Among the hashes of every ``window`` consecutive units the smallest is selected as a
fingerprint; neighbouring windows mostly select the same one, and a run of ``window`` units that
stands in two places has the same fingerprint at the same offset in both.

1. winnow: one row for each *selected* unit, with the windows that selected it; written once;
2. join positions: rows whose fingerprint stands at two positions or more (a map-side combined
   minimum and maximum, whatever their number) stay, all others go;
3. extend: a matched fingerprint grows both ways over the windows that selected it, whose hashes
   tell with which other places it agrees; the place that comes first (by id, then position) keeps the
   window, all later ones repeat it.  Where a run goes on, the next fingerprint goes on with it, so
   the windows of a place add up to its maximal runs;
4. delete the lines of the later runs.

So a line is deleted exactly if it lies in a run of ``window`` units that stands earlier, and a
frequent line never meets all its copies pairwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinerank.session import materialize

WINDOW = 2
LONG_CHARS = 30


def _winnow(units: DataFrame, w: int) -> DataFrame:
    """``doc_id, text_key, at, fp, windows`` of the selected units only (``at``: place, ``fp``: hash); a window
    has its place ``j``, the hash ``run`` of its units and their ``lines``."""
    chosen = units.withColumn("chosen", F.expr(f"""
        transform(sequence(0, size(u) - {w}), j -> cast(j + array_position(
            slice(u.h, j + 1, {w}), array_min(slice(u.h, j + 1, {w}))) - 1 AS int))"""))
    return chosen.select("doc_id", "text_key", F.expr(f"""
        inline(transform(array_distinct(chosen), p -> named_struct(
            'at', p, 'fp', u.h[p], 'windows', transform(
                filter(sequence(greatest(0, p - {w} + 1), least(p, size(u) - {w})), j -> chosen[j] = p),
                j -> named_struct('j', j, 'run', xxhash64(slice(u.h, j + 1, {w})), 'lines', slice(u.i, j + 1, {w}))))))"""))


def repeated_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   long_chars: int = LONG_CHARS) -> DataFrame:
    """(doc_id, text_key, removed): indexes of the lines to delete, for documents that have any.

    ``text_key`` is xxhash64 of the text: rows that repeat id and text are one document.  A null
    id orders first.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
        .filter(F.col("text").isNotNull())
    units = rows.select("doc_id", F.xxhash64("text").alias("text_key"), F.expr(f"""
        flatten(transform(split(text, '\\n'), (x, i) -> CASE
            WHEN trim(x) = '' THEN cast(array() AS array<struct<i:int,h:bigint>>)
            WHEN length(x) >= {int(long_chars)}
              THEN array(named_struct('i', i, 'h', xxhash64(x)), named_struct('i', i, 'h', xxhash64(x, 2)))
            ELSE array(named_struct('i', i, 'h', xxhash64(x))) END))""").alias("u")) \
        .filter(F.size("u") >= window)
    w = int(window)
    chosen = materialize(_winnow(units, w), "line-fingerprints")
    place = F.struct("doc_id", "text_key", "at")
    again = chosen.groupBy("fp").agg(F.min(place).alias("lo"), F.max(place).alias("hi")).filter("lo <> hi").select("fp")
    matched = chosen.join(again, "fp", "left_semi").select("doc_id", "text_key", F.inline("windows"))
    where = F.struct("doc_id", "text_key", "j")
    runs = matched.groupBy("run").agg(F.min(where).alias("lo"), F.max(where).alias("hi")).filter("lo <> hi")
    later = matched.join(runs.select("run", "lo"), "run").filter(~where.eqNullSafe(F.col("lo")))
    return later.select("doc_id", "text_key", F.explode("lines").alias("i")) \
        .groupBy("doc_id", "text_key").agg(F.collect_set("i").alias("removed"))  # at most its own lines


def dedup_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """All rows and columns of ``docs`` with repeated lines cut from the text, plus n_lines, n_removed.

    A line goes if it lies in a run of ``window`` units that stands earlier (smaller id, then
    earlier line); the first occurrence stays.  Null texts stay null with n_lines = n_removed = 0;
    an empty text has no line; blank lines are kept and belong to no run; a text that loses all
    its lines becomes empty.  Rows that repeat id and text are cut alike; rows that share an id
    only are documents of their own.  Clashing column names: n_lines and n_removed come last and
    replace no input column (an input column of that name makes the result ambiguous by name, not
    by position).  An empty table gives no rows.
    """
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    text = F.col(f"c{names.index(text_col)}").cast("string")
    removed = repeated_lines(docs, id_col=id_col, text_col=text_col, **options) \
        .withColumnRenamed("doc_id", "__id").withColumnRenamed("text_key", "__key")
    id_ = F.col(f"c{names.index(id_col)}").cast("long")
    met = plain.join(removed, id_.eqNullSafe(F.col("__id")) & (F.xxhash64(text) == F.col("__key")), "left")
    met = met.withColumn("__n", F.when(text.isNull() | (text == ""), 0).otherwise(F.size(F.split(text, "\n")))) \
        .withColumn("__cut", F.when(F.col("removed").isNull(), text).otherwise(F.expr(
            f"array_join(transform(array_except(sequence(0, __n - 1), removed), "
            f"i -> split(c{names.index(text_col)}, '\\n')[i]), '\\n')")))
    out = [F.col("__cut") if n == text_col else F.col(f"c{i}") for i, n in enumerate(names)]
    cut = met.select(*out, F.col("__n").cast("long"), F.coalesce(F.size("removed"), F.lit(0)).cast("long"))
    return cut.toDF(*names, "n_lines", "n_removed")
