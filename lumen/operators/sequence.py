"""Next row(s), positions and as-of matches in a per-key sequence, without one task per key.

A window partitioned by the key alone sends every row of a key to one task; with one user
holding a third of all events that task holds a third of the data.  The operators here
cut each key's sequence into *splits* and run their windows per (key, split); they then
repair the only rows a split cannot answer (its tail, its offset) from a summary holding
one row per (key, split).  The summary is the only thing ranked per key; its size is the
number of splits a key spans, not the number of its rows.

Two ways to cut:

* ``split="range"`` (default): a global range partitioning on (key, order...), whose bounds
  Spark samples from the data, so a hot key is spread over as many splits as its volume
  needs and every (key, split) group is bounded by one range partition.  Costs one extra
  shuffle (and a sampling job); holds for any skew, even a key whose rows share one
  timestamp.
* ``split="time"``: fixed time buckets (``bucket_seconds``).  One shuffle fewer; a key
  can still crowd one bucket if its rows are dense in time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumen.operators.lineage import cut

DAY = 86_400
SPLIT = "__split"


def time_bucket(ts_col: str, bucket_seconds: int):
    micros = F.unix_micros(F.col(ts_col).cast("timestamp"))
    return F.floor(micros / F.lit(bucket_seconds * 1_000_000)).cast("bigint")


def add_split(df: DataFrame, key: str, order: list[str], *, split: str = "range", bucket_seconds: int = DAY,
              n_splits: int | None = None, materialize: bool = False) -> DataFrame:
    """Add ``__split``: a number that is monotone in ``order`` within each key.

    The partition id of a range partitioning is monotone in (key, order); without an
    explicit count AQE may merge adjacent ranges of small inputs, which keeps it monotone.
    The sampled bounds are fixed once in the shuffle dependency, so a retried task reads the
    same range.  ``materialize`` checkpoints the result, for callers that read it in more
    than one job; a single consumer (a window that is materialised next) does not need it.
    """
    if split == "time":
        return df.withColumn(SPLIT, time_bucket(order[0], bucket_seconds))
    if split != "range":
        raise ValueError(f"unknown split {split!r}")
    ranged = df.repartitionByRange(n_splits, key, *order) if n_splits else df.repartitionByRange(key, *order)
    out = ranged.withColumn(SPLIT, F.spark_partition_id().cast("bigint"))
    return cut(out) if materialize else out


def join_splits(rows: DataFrame, summary: DataFrame, key: str, how: str = "left") -> DataFrame:
    """``rows`` joined to a per-(key, split) summary; a null key is a key like any other."""
    right = summary.withColumnsRenamed({key: "__key", SPLIT: "__of_split"})
    on = F.col(key).eqNullSafe(F.col("__key")) & (F.col(SPLIT) == F.col("__of_split"))
    return rows.join(right, on, how).drop("__key", "__of_split")


def with_next_row(df: DataFrame, key: str, ts: str, tiebreak: str, carry: list[str], *,
                  split: str = "range", bucket_seconds: int = DAY, prefix: str = "next_") -> DataFrame:
    """Add ``prefix + c`` for c in [ts, tiebreak, *carry]: the following row of the same key
    in (ts, tiebreak) order, null for the last row of a key."""
    fields = [ts, tiebreak, *carry]
    rows = add_split(df, key, [ts, tiebreak], split=split, bucket_seconds=bucket_seconds)
    w = Window.partitionBy(key, SPLIT).orderBy(ts, tiebreak)
    rows = cut(rows.withColumn("__next", F.lead(F.struct(*fields)).over(w))
               .withColumn("__first", F.row_number().over(w) == 1))
    # one row per (key, split): the first row of the split, then per key the first row
    # of the following non-empty split
    heads = rows.where("__first").select(key, SPLIT, F.struct(*fields).alias("__head"))
    wk = Window.partitionBy(key).orderBy(SPLIT)
    next_heads = heads.select(key, SPLIT, F.lead("__head").over(wk).alias("__next_head"))
    inner = rows.where(F.col("__next").isNotNull())
    tails = (join_splits(rows.where(F.col("__next").isNull()).drop("__next"), next_heads, key)
             .withColumnRenamed("__next_head", "__next"))
    out = inner.unionByName(tails)
    return out.select(*df.columns, *[F.col("__next." + f).alias(prefix + f) for f in fields])


def with_positions(df: DataFrame, key: str, ts: str, tiebreak: str, *, split: str = "range",
                   bucket_seconds: int = DAY, name: str = "pos") -> DataFrame:
    """Add ``name``: the 0-based position of each row within its key in (ts, tiebreak) order.

    Row numbers are taken inside (key, split) partitions; each split's offset is the row
    count of the key's earlier splits, ranked over the per-(key, split) counts only.
    """
    rows = add_split(df, key, [ts, tiebreak], split=split, bucket_seconds=bucket_seconds, materialize=True)
    w = Window.partitionBy(key, SPLIT).orderBy(ts, tiebreak)
    rows = rows.withColumn("__rn", F.row_number().over(w) - 1)
    sizes = rows.groupBy(key, SPLIT).agg(F.count(F.lit(1)).alias("__n"))
    wk = Window.partitionBy(key).orderBy(SPLIT).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(key, SPLIT, F.coalesce(F.sum("__n").over(wk), F.lit(0)).alias("__off"))
    out = join_splits(rows, offsets, key, "inner")
    return out.select(*df.columns, (F.col("__rn") + F.col("__off")).cast("bigint").alias(name))


def first_match_after(probes: DataFrame, candidates: DataFrame, key: str, *,
                      probe_ts: str, probe_id: str, cand_ts: str, cand_id: str, carry: list[str] | None = None,
                      min_gap_us: int = 0, split: str = "range", bucket_seconds: int = DAY) -> DataFrame:
    """For each probe row, the first candidate of the same key with
    ``cand_ts - probe_ts > min_gap_us`` (microseconds), earliest by (cand_ts, cand_id).

    Returns (key, probe_id, probe_ts, match_id, match_ts) and match_<c> for each candidate
    column of ``carry``; match_* null when none (an as-of join that keeps every probe).  Keys are
    equal as in an equi join: a probe with a null key, or a null time, has no match.  Only probes
    and one row per (key, split) are written, never the candidates.
    """
    # candidate c is after probe p iff c.ts - gap > p.ts: compare both on one "sort time"
    shift = F.expr(f"INTERVAL {min_gap_us} MICROSECOND")
    usable = F.col(key).isNotNull() & F.col(probe_ts).isNotNull()
    carried, types = list(carry or []), dict(candidates.dtypes)
    more = "".join(f",c{k}:{types[c]}" for k, c in enumerate(carried))
    alone = probes.where(~usable).select(key, probe_id, probe_ts, F.lit(None).cast("bigint").alias("match_id"),
                                         F.lit(None).cast("timestamp_ntz").alias("match_ts"),
                                         *[F.lit(None).cast(types[c]).alias(f"match_{c}") for c in carried])
    p = probes.where(usable).select(F.col(key).alias("k"), F.col(probe_id).alias("pid"), F.col(probe_ts).alias("pts"),
                      F.col(probe_ts).alias("st"), F.lit(1).alias("rank"),
                      F.lit(None).cast(f"struct<st:timestamp_ntz,cid:bigint,cts:timestamp_ntz{more}>").alias("cand"))
    c = candidates.where(F.col(key).isNotNull() & F.col(cand_ts).isNotNull()).select(F.col(key).alias("k"), F.lit(None).cast("bigint").alias("pid"),
                          F.lit(None).cast("timestamp_ntz").alias("pts"),
                          (F.col(cand_ts) - shift).alias("st"), F.lit(0).alias("rank"),
                          F.struct((F.col(cand_ts) - shift).alias("st"), F.col(cand_id).cast("bigint").alias("cid"),
                                   F.col(cand_ts).alias("cts"), *[F.col(x).alias(f"c{k}") for k, x in enumerate(carried)]).alias("cand"))
    both = add_split(p.unionByName(c), "k", ["st", "rank"], split=split, bucket_seconds=bucket_seconds)
    # descending sort time; at equal sort time the probe comes first, so a candidate with
    # the same sort time (gap exactly min_gap) is not counted as after it
    ws = Window.partitionBy("k", SPLIT).orderBy(F.desc("st"), F.desc("rank"))
    w = ws.rowsBetween(Window.unboundedPreceding, -1)
    scanned = cut(both.withColumns({"__best": F.min("cand").over(w), "__last": F.lead(F.lit(1)).over(ws).isNull()})
                  .where("rank = 1 OR __last"))
    found = scanned.where("rank = 1")
    # one row per (key, split) seen on either side: the split's last row in the scan order
    # holds the minimum over the whole split (null where the split has no candidate)
    heads = scanned.where("__last").select("k", SPLIT, F.least("__best", "cand").alias("__head"))
    wk = Window.partitionBy("k").orderBy(F.desc(SPLIT)).rowsBetween(Window.unboundedPreceding, -1)
    later = heads.select("k", SPLIT, F.min("__head").over(wk).alias("__later"))
    ok = found.where(F.col("__best").isNotNull())
    miss = join_splits(found.where(F.col("__best").isNull()).drop("__best"), later, "k").withColumnRenamed("__later", "__best")
    out = ok.unionByName(miss)
    matched = out.select(F.col("k").alias(key), F.col("pid").alias(probe_id), F.col("pts").alias(probe_ts),
                         F.col("__best.cid").alias("match_id"), F.col("__best.cts").alias("match_ts"),
                         *[F.col(f"__best.c{k}").alias(f"match_{c}") for k, c in enumerate(carried)])
    return matched.unionByName(alone)


def with_following(df: DataFrame, key: str, ts: str, tiebreak: str, k: int, carry: list[str], *,
                   where=None, split: str = "range", bucket_seconds: int = DAY,
                   name: str = "following") -> DataFrame:
    """Add ``name``: the next ``k`` rows of the same key in (ts, tiebreak) order, as an array
    of structs (ts, tiebreak, *carry); shorter at the end of a key.

    k ``lead`` offsets per (key, split) answer every row whose k successors lie in its own
    split.  For the rest, each split contributes its first k rows to a summary with one
    row per (key, split), and a frame over the following k splits of that summary gives
    the continuation (each split holds at least one row, so k splits always suffice).
    Only rows matching ``where`` (default: all) are returned, and only they and the split
    heads are materialised.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    item = F.struct(*[F.col(c) for c in [ts, tiebreak, *carry]])
    rows = add_split(df, key, [ts, tiebreak], split=split, bucket_seconds=bucket_seconds)
    w = Window.partitionBy(key, SPLIT).orderBy(ts, tiebreak)
    keep = F.lit(True) if where is None else where
    # k offset lookups per row (no per-row array); the arrays are built after the filter,
    # only for the rows that are kept and the split heads
    leads = {f"__l{j}": F.lead(item, j).over(w) for j in range(1, k + 1)}
    rows = rows.withColumns({**leads, "__first": F.row_number().over(w) == 1,
                             "__keep": F.coalesce(keep, F.lit(False))})
    kept = rows.where(F.col("__keep") | F.col("__first"))
    needed = cut(kept.withColumns({
        "__ahead": F.filter(F.array(*[F.col(c) for c in leads]), lambda x: x.isNotNull()),
        "__item": item}).drop(*leads))
    heads = needed.where("__first").select(
        key, SPLIT, F.slice(F.concat(F.array("__item"), "__ahead"), 1, k).alias("__head"))
    wk = Window.partitionBy(key).orderBy(SPLIT).rowsBetween(1, k)
    conts = heads.select(key, SPLIT, F.slice(F.flatten(F.collect_list("__head").over(wk)), 1, k).alias("__cont"))
    out = needed.where("__keep")
    full = out.where(F.size("__ahead") == k).withColumn(name, F.col("__ahead"))
    short = (join_splits(out.where(F.size("__ahead") < k), conts, key)
             .withColumn(name, F.when(F.col("__cont").isNull(), F.col("__ahead"))
                         .otherwise(F.slice(F.concat("__ahead", "__cont"), 1, k))))
    return full.unionByName(short.drop("__cont")).select(*df.columns, name)
