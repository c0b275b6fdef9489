"""Line dedup over overlapping three-line windows.

Lines are the parts of a text between ``\\n``.  Every run of three consecutive lines is a
window; its key is a 128-bit hash of the three lines.  A window's first occurrence is the one
with the least (doc_id, row key, position).  Every later occurrence covers its three lines;
covered positions are merged and those lines removed, the rest joined by ``\\n`` again.

The key's rows are counted with map-side partial aggregates, and only repeated keys are joined
back to the windows, so a window in a third of all documents is one small group row; its many
occurrences are split by the adaptive skew join.

Defined cases: a text of fewer than three lines (null and empty ones too) has no window and
stays as it is, null included; a text whose lines are all covered becomes empty.  Documents
are told apart by (doc_id, text hash); repeated rows of one document share their windows'
places, so none of them counts as a later occurrence of another.  A null doc_id sorts first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 3


def _window_keys(lines: Column) -> Column:
    """Array of (k1, k2) for the windows of an array of lines."""
    # the arrays are arguments, evaluated once for a text; inside the lambda they would be for each line
    count = F.greatest(F.size(lines) - (WINDOW - 1), F.lit(0))
    three = F.arrays_zip(*[F.slice(lines, d + 1, count).alias(f"l{d}") for d in range(WINDOW)])
    return F.transform(three, lambda w: F.struct(F.xxhash64(*[w[f"l{d}"] for d in range(WINDOW)]).alias("k1"),
                                                 F.xxhash64(F.lit(WINDOW), *[w[f"l{d}"] for d in reversed(range(WINDOW))]).alias("k2")))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with its text less the later copies of three-line windows, plus n_lines and n_removed.

    The added columns replace columns of ``docs`` with those names.
    """
    kept_columns = [c for c in docs.columns if c not in ("n_lines", "n_removed", text_col)]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept_columns]).alias("rest"), F.col(id_col).alias("id"),
                       F.col(text_col).alias("body"), F.xxhash64(text_col).alias("row_key"))
    windows = (rows.select("id", "row_key", F.posexplode(_window_keys(F.split("body", "\n"))).alias("pos", "key"))
               .select("id", "row_key", "pos", "key.k1", "key.k2"))
    place = F.struct("id", "row_key", "pos")
    repeated = (windows.groupBy("k1", "k2").agg(F.min(place).alias("first"), F.max(place).alias("last"))
                .where(F.col("first") != F.col("last")).select("k1", "k2", "first"))
    later = windows.join(repeated, ["k1", "k2"]).where(place != F.col("first"))
    starts = (later.groupBy(F.col("id").alias("later_id"), F.col("row_key").alias("later_key"))
              .agg(F.collect_set("pos").alias("starts")))
    lines = F.split("body", "\n")
    covered = F.flatten(F.transform("starts", lambda s: F.sequence(s, s + WINDOW - 1)))
    joined = (rows.join(starts, F.col("id").eqNullSafe(F.col("later_id")) & (F.col("row_key") == F.col("later_key")), "left")
              .select("rest", "body", lines.alias("lines"), "starts")
              .select("rest", "body", "lines",
                      F.when(F.col("starts").isNotNull(), F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), covered)).alias("left")))
    text = F.when(F.col("left").isNull(), F.col("body")).otherwise(F.array_join(F.transform("left", lambda i: F.get("lines", i)), "\n"))
    n_lines = F.when(F.col("body").isNull(), 0).otherwise(F.size("lines"))
    columns = [text.alias(text_col) if c == text_col else F.col(f"rest.`{c}`").alias(c)
               for c in docs.columns if c not in ("n_lines", "n_removed")]
    return joined.select(*columns, n_lines.cast("long").alias("n_lines"),
                         F.when(F.col("left").isNull(), 0).otherwise(n_lines - F.size("left")).cast("long").alias("n_removed"))
