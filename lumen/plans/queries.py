"""

Each takes ``(spark, sf_dir)`` and returns a DataFrame over the whole input tables.  Output
columns are named and typed like their DuckDB twins in :mod:`lumen.plans.oracles`.
Timestamps leave as ISO text, doubles that depend on summation order are snapped to
6 decimals, sums of plain numbers are exact decimal sums.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumen.functions import vectors as V
from lumen.functions.draws import by_cut_points, keyed_index, keyed_uniform
from lumen.functions.numeric import snap
from lumen.functions.shapes import guarded_inverse, guarded_sqrt, parity_even, quantize_sqrt, triangle_wave
from lumen.operators.assemble import global_line_numbers, ordered_concat
from lumen.operators.alias import alias_table, drawn
from lumen.operators.deal import folds
from lumen.operators.exact import exact_means, exact_sums
from lumen.operators.iterate import branching, frontier_loop, redraw_until_accepted
from lumen.operators.lineage import cut, write_round
from lumen.operators.metric import BLOCK, nearest_valid
from lumen.operators.ranges import range_join
from lumen.operators.recurse import recursed
from lumen.operators.relax import cheapest_paths
from lumen.operators.route import route
from lumen.operators.sequence import first_match_after, with_following, with_next_row
from lumen.operators.timeline import timeline
from lumen.operators.topk import dedup_by_key, latest_per_key, rows_at_group_max
from lumen.sources.export import with_offsets
from lumen.sources.tables import load

# ---- fixed values of the queries -------------------------------------------------------
JOURNEY_HOPS = 8                                     # O1/O20: K
JOURNEY_FACTORS = {"view": 0.9, "purchase": 0.7}     # O1: weight factor per event type, 1 otherwise
JOURNEY_STOP = "error"                               # O1: weight 0 and stop
REDRAW_MAX_SIZE = 25                                 # O2: eligible part when p_size <= 25
INSTALMENTS = 4                                      # O4
EPOCH = "2024-01-01 00:00:00"                        # O5, O26: hour numbering origin
DRAWS_PER_DOC = 4                                    # O6
SPLITS = (["train", "valid", "test"], [0.8, 0.95])   # O7: 80 / 15 / 5
DEFAULT_MEMBERS = [(-1, "unknown"), (-2, "n/a"), (-3, "missing"), (-4, "other")]  # O8
DEFAULT_REGION = "UNKNOWN"                           # O8
THRESHOLD_FACTOR = 1.5                               # O9
CHAIN_STEPS = 5                                      # cool-down chain: most jumps
CHAIN_HOUR = 3600                                    # cool-down seconds, for each tenth of weight lost and one more
NEAR_ZERO = 1e-8                                     # frame_vectors: tolerance
WAVE = (0.1125, 0.45)                                # O25: low and high
TRUNCATE_DIMS = 16                                   # O16
BLEND = (0.7, 0.3)                                   # O19: size, price weights
ERROR_GAP_US = 60_000_000                            # O12: more than 60 s
QUANT_LEVELS = 255                                   # O24
SIZE_SCALE, REACH = 10.0, 4.0                         # nearest_supplied_part: size against price, least reach
START_NATION = 0                                     # cheapest_supply
WALK_STEPS, CLICK_STRIDE, VALUE_CLASS = 5, 17, 10.0  # event_walk
LEAST_INSTALMENT = 500_000                           # instalment_plan: cents
FOLDS = 5                                            # document_folds
RESTOCK_ROUNDS = 6                                   # restock_walk: most purchases
NATION_COLUMNS = ["n_nationkey", "n_name", "n_regionkey"]  # O28


def _hours_since_epoch(ts: str):
    micros = F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'{EPOCH}', {ts})")
    return F.floor(micros / F.lit(3_600_000_000.0)).cast("bigint")


def _day(col: str):
    return F.date_format(col, "yyyy-MM-dd")


# ---- O1 / O20: journeys over next events ------------------------------------------------

def _journey_factor(event_type):
    """Weight factor of a step onto an event of this type (1 for types without one)."""
    etype_col = F.col(event_type) if isinstance(event_type, str) else event_type
    factor = F.lit(1.0)
    for etype, f in JOURNEY_FACTORS.items():
        factor = F.when(etype_col == etype, F.lit(f)).otherwise(factor)
    return factor


def journey_paths(spark: SparkSession, sf_dir: str, hops: int = JOURNEY_HOPS, running: bool = True) -> DataFrame:
    """One row per journey: (journey_id, user_id, nxt, stop, cum | weight).

    ``nxt`` holds the signup's next K events (``with_following``: K lead offsets per
    (user, split), continued across splits from a per-split summary); ``stop`` is the
    1-based position of the first stop in ``nxt`` (0: none).  With ``running`` ``cum``
    holds the running weights for depths 0..len(nxt); without, ``weight`` is only the
    product over all of ``nxt``.  Both multiply in path order.
    """
    ev = load(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type")
    starts = with_following(ev, "user_id", "ts", "event_id", hops, ["event_type"],
                            where=F.col("event_type") == "signup", name="nxt")
    nxt = F.col("nxt")
    stop = F.array_position(F.transform(nxt, lambda e: e["event_type"] == JOURNEY_STOP), F.lit(True))
    if running:
        acc = F.aggregate(nxt, F.array(F.lit(1.0)), lambda a, e: F.concat(
            a, F.array(F.element_at(a, -1) * _journey_factor(e["event_type"])))).alias("cum")
    else:
        acc = F.aggregate(nxt, F.lit(1.0), lambda a, e: a * _journey_factor(e["event_type"])).alias("weight")
    return starts.select(F.col("event_id").alias("journey_id"), "user_id", nxt.alias("nxt"),
                         stop.cast("int").alias("stop"), acc)


def journeys(spark: SparkSession, sf_dir: str, hops: int = JOURNEY_HOPS) -> DataFrame:
    """All journey rows (journey_id, user_id, depth, event_id, active, weight), exploded from
    :func:`journey_paths`: the first stop cuts the path, a path still active after K steps
    gets its terminal row."""
    t = journey_paths(spark, sf_dir, hops)
    last = F.when(F.col("stop") > 0, F.col("stop")).otherwise(F.size("nxt"))
    depth_rows = F.transform(F.sequence(F.lit(0), last), lambda d: F.struct(
        d.alias("depth"),
        F.when(d == 0, F.col("journey_id")).otherwise(F.element_at("nxt", F.greatest(d, F.lit(1)))["event_id"])
        .alias("event_id"),
        (~_stops_at(d)).alias("active"),
        F.when(_stops_at(d), F.lit(0.0)).otherwise(F.element_at("cum", d + 1)).alias("weight")))
    term = F.array(F.struct(F.lit(hops + 1).alias("depth"), F.lit(None).cast("bigint").alias("event_id"),
                            F.lit(False).alias("active"), F.lit(0.0).alias("weight")))
    all_rows = F.when((F.col("stop") == 0) & (F.size("nxt") == hops), F.concat(depth_rows, term)).otherwise(depth_rows)
    return t.select("journey_id", "user_id", F.inline(all_rows))


def journey_last_states(spark: SparkSession, sf_dir: str, hops: int = JOURNEY_HOPS) -> DataFrame:
    """(journey_id, user_id, depth, weight) of each journey's last row, read off its path
    arrays without exploding them: the stop row, else the terminal row after K active
    steps, else the last event reached."""
    t = journey_paths(spark, sf_dir, hops, running=False)
    n = F.size("nxt")
    stopped, capped = F.col("stop") > 0, n == hops
    depth = F.when(stopped, F.col("stop")).when(capped, F.lit(hops + 1)).otherwise(n)
    weight = F.when(stopped | capped, F.lit(0.0)).otherwise(F.col("weight"))
    return t.select("journey_id", "user_id", depth.alias("depth"), weight.alias("weight"))


def _stops_at(d):
    return (F.col("stop") > 0) & (d == F.col("stop"))


def q_journey_trace(spark, sf_dir):
    return journeys(spark, sf_dir).select("journey_id", "depth", "event_id", "active", "weight")


def q_journey_score(spark, sf_dir):
    # last state per journey straight from its path arrays: no per-row explosion, no ranking
    last = journey_last_states(spark, sf_dir)
    return last.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_journeys"),
        snap(F.avg("weight")).alias("avg_weight"),
        F.max("depth").alias("max_depth"))


# ---- a frontier whose next step depends on the state it carries --------------------------

def q_cooldown_chain(spark, sf_dir):
    """From each signup jump to the user's first event after a cool-down that grows with the
    weight lost so far; an error or ``CHAIN_STEPS`` jumps end the chain.

    The next event depends on the carried weight, so no successor table can be made ahead:
    every round is an as-of match of the frontier against the events, which are put in order once.
    """
    ev = load(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type")
    line = timeline(ev, "user_id", "ts", "event_id", ["event_type"])
    seed = (ev.where(F.col("event_type") == "signup")
            .select(F.col("event_id").alias("journey_id"), "user_id", F.lit(0).alias("depth"), "event_id", "ts",
                    F.lit(1.0).alias("weight"), F.lit(True).alias("active")))

    def step(frontier: DataFrame, _round: int) -> DataFrame:
        lost = F.floor((F.lit(1.0) - F.col("weight")) * 10 + F.lit(1e-9)).cast("int")
        due = F.col("ts") + F.make_dt_interval(secs=((lost + 1) * CHAIN_HOUR).cast("decimal(18,6)"))
        found = line.after(frontier.select("journey_id", "user_id", "depth", "weight", due.alias("due")), "due")
        kind = F.col("match.event_type")
        stop = kind == JOURNEY_STOP
        depth = F.col("depth") + 1
        return found.select("journey_id", "user_id", depth.alias("depth"), "match.event_id", "match.ts",
                            F.when(stop, F.lit(0.0)).otherwise(F.col("weight") * _journey_factor(kind)).alias("weight"),
                            (~F.coalesce(stop, F.lit(False)) & (depth < CHAIN_STEPS)).alias("active"))

    rows = frontier_loop(seed, step, active=F.col("active"), max_rounds=CHAIN_STEPS)
    line.drop()                                          # every round is written
    return rows.select("journey_id", "depth", "event_id", snap("weight").alias("weight"), "active")


def q_event_walk(spark, sf_dir):
    """From every signup a walk whose steps differ by what it stands on, each with a join of its own.

    From a view or a signup to the user's next event; from a click ``CLICK_STRIDE`` event ids on,
    whoever's event that is; from a purchase to the latest event of the user of greatest id that
    has the same value class; from anything else nowhere: the walk ends with a row that says so.
    """
    ev = load(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value")
    following = with_next_row(ev.select("event_id", "ts", "user_id", "event_type"), "user_id", "ts", "event_id", [])
    following = cut(following.where("next_event_id IS NOT NULL").select("event_id", F.col("next_event_id").alias("to")))
    kinds = ev.select(F.col("event_id").alias("to"), F.col("event_type").alias("kind"), value_class("value").alias("class"))
    latest = ev.groupBy(value_class("value").alias("class")).agg(F.max(F.struct("user_id", "ts", "event_id"))["event_id"].alias("to"))
    seed = (ev.where(F.col("event_type") == "signup")
            .select(F.col("event_id").alias("walk"), F.lit(0).alias("depth"), "event_id", F.col("event_type").alias("kind"),
                    value_class("value").alias("class"), F.lit(True).alias("active")))

    def arrived(steps: DataFrame) -> DataFrame:
        depth = F.col("depth") + 1
        return (steps.select("walk", "depth", "to").join(kinds, "to")
                .select("walk", depth.alias("depth"), F.col("to").alias("event_id"), "kind", "class", (depth < WALK_STEPS).alias("active")))

    def ended(rows: DataFrame, _r: int) -> DataFrame:
        return rows.select("walk", (F.col("depth") + 1).alias("depth"), F.lit(None).cast("bigint").alias("event_id"), F.lit("end").alias("kind"),
                           F.lit(None).cast("bigint").alias("class"), F.lit(False).alias("active"))

    step = branching([
        (F.col("kind").isin("view", "signup"), lambda rows, r: arrived(rows.join(following, "event_id"))),
        (F.col("kind") == "click", lambda rows, r: arrived(rows.withColumn("to", F.col("event_id") + CLICK_STRIDE))),
        (F.col("kind") == "purchase", lambda rows, r: arrived(rows.join(latest, "class"))),
    ], otherwise=ended)
    return (frontier_loop(seed, step, active=F.col("active"), max_rounds=WALK_STEPS)
            .select("walk", "depth", "event_id", "kind", "active"))


def value_class(value: str):
    return F.floor(F.col(value) / VALUE_CLASS).cast("bigint")


def q_supplier_draws(spark, sf_dir):
    """A supplier for each order, drawn by balance: suppliers with 0 or less are never drawn."""
    supplier = load(spark, sf_dir, "supplier", "s_suppkey", "s_acctbal")
    weights = supplier.select(F.col("s_suppkey").alias("item"), F.greatest(F.round(F.col("s_acctbal") * 100).cast("bigint"), F.lit(0)).alias("weight"))
    table, slots, each = alias_table(weights)
    orders = load(spark, sf_dir, "orders", "o_orderkey")
    picked = drawn(orders, "o_orderkey", table, slots, each, "supplier")
    return picked.groupBy(F.col("item").alias("s_suppkey")).agg(F.count(F.lit(1)).alias("n_orders"), F.min("o_orderkey").alias("first_order"))


# ---- O2: redraw until accepted ----------------------------------------------------------

def small_parts_accepted(tries: DataFrame, part: DataFrame) -> DataFrame:
    """``tries`` with ``accepted``: whether the candidate is a small enough part.

    A loop does this many times, so the parts are shuffled, never sent to the driver for a broadcast in each.
    """
    small = part.where(F.col("p_size") <= REDRAW_MAX_SIZE).select(F.col("p_partkey").alias("candidate"), F.lit(True).alias("ok"))
    return tries.join(small.hint("merge"), "candidate", "left").withColumn("accepted", F.coalesce("ok", F.lit(False)))


def q_redraw_until_accept(spark, sf_dir):
    cust = load(spark, sf_dir, "customer", "c_custkey")
    part = load(spark, sf_dir, "part", "p_partkey", "p_size")
    # one scan gives the draw range (max key + 1) and whether any part can be accepted at all
    stats = part.agg(F.max("p_partkey"), F.count(F.when(F.col("p_size") <= REDRAW_MAX_SIZE, 1))).first()
    if not stats[1]:
        raise ValueError(f"no part has p_size <= {REDRAW_MAX_SIZE}: no draw can be accepted")
    n = stats[0] + 1
    out = redraw_until_accepted(cust, "c_custkey",
                                draw=lambda i: keyed_index("redraw", F.lit(n), F.col("c_custkey"), i),
                                accept=lambda tries: small_parts_accepted(tries, part), batch=4)
    return out.select("c_custkey", "draws", F.col("candidate").alias("p_partkey"))


def instalments_left(cents: int) -> int:
    """Instalments that pay off a balance: a quarter of what is left each, ``LEAST_INSTALMENT`` at least."""
    n = 0
    while cents > 0:
        cents -= min(cents, max(cents // 4, LEAST_INSTALMENT))
        n += 1
    return n


def q_instalment_plan(spark, sf_dir):
    """Each order's balance after each instalment, by Spark's own recursion: a step needs its row only.

    A larger balance never takes fewer instalments, so the largest one bounds levels and rows.
    """
    o = load(spark, sf_dir, "orders", "o_orderkey", "o_totalprice")
    base = o.select("o_orderkey", F.lit(0).alias("instalment"), F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"))
    largest, n = base.agg(F.max("cents"), F.count(F.lit(1))).first()
    levels = instalments_left(largest or 0)
    step = {"o_orderkey": "o_orderkey", "instalment": "instalment + 1",
            "cents": f"cents - least(cents, greatest(cents div 4, {LEAST_INSTALMENT}L))"}
    return recursed(base, step, "cents > 0", levels=levels, rows=n * (levels + 1))


def q_document_folds(spark, sf_dir):
    """All documents in a keyed random order, dealt to equal folds without a sort."""
    docs = load(spark, sf_dir, "documents", "doc_id")
    return folds(docs, "doc_id", FOLDS, "folds").select("doc_id", "position", "fold")


# ---- O3-O9: series, fan-out, grids, draws, unions, parameters ---------------------------

def q_date_spine_counts(spark, sf_dir):
    ev = load(spark, sf_dir, "events", "ts")
    counts = ev.groupBy(F.date_trunc("hour", "ts").alias("hour")).agg(F.count(F.lit(1)).alias("n_events"))
    counts = cut(counts)                             # one row per hour; read twice below
    lo, hi = counts.agg(F.min("hour"), F.max("hour")).first()
    if lo is None:
        return counts.select(F.date_format("hour", "yyyy-MM-dd HH:mm:ss").alias("hour"), "n_events")
    n_hours = int((hi - lo).total_seconds() // 3600) + 1
    spine = spark.range(n_hours).select(
        (F.lit(lo).cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("id").cast("int"))).alias("hour"))
    out = spine.join(counts, "hour", "left")
    return out.select(F.date_format("hour", "yyyy-MM-dd HH:mm:ss").alias("hour"),
                      F.coalesce("n_events", F.lit(0).cast("bigint")).alias("n_events"))


def q_replicate_rows(spark, sf_dir):
    o = load(spark, sf_dir, "orders", "o_orderpriority", "o_totalprice")
    rep = o.select("o_orderpriority", "o_totalprice",
                   F.explode(F.sequence(F.lit(0), F.lit(INSTALMENTS - 1))).alias("instalment"))
    sums = exact_sums(rep, ["o_orderpriority", "instalment"], {"total": "o_totalprice"})
    return sums.select("o_orderpriority", "instalment", F.col("n_rows").alias("n"), snap(F.col("total") / F.lit(float(INSTALMENTS))).alias("amount"))


def q_grid_cells(spark, sf_dir):
    ev = load(spark, sf_dir, "events", "ts", "value")
    h = _hours_since_epoch("ts")
    # one row per cell; read twice below
    placed = ev.select(F.pmod(h, F.lit(24)).alias("col"), F.floor(h / F.lit(24.0)).cast("bigint").alias("row"), "value")
    cells = cut(exact_means(placed, ["col", "row"], {"avg_value": "value"})
                .select("col", "row", F.col("n_rows").alias("n"), snap("avg_value").alias("avg_value")))
    # grid height as an uncorrelated scalar subquery over the cells
    n_rows = cells.agg(F.max("row") + 1).scalar()
    return cells.select("col", "row",
                        ((F.col("col") + F.lit(0.5)) / F.lit(24.0)).alias("u"),
                        ((F.col("row") + F.lit(0.5)) / n_rows).alias("v"),
                        "n", "avg_value")


def q_keyed_uniform(spark, sf_dir):
    docs = load(spark, sf_dir, "documents", "doc_id", "source")
    draws = docs.select("source", "doc_id", F.explode(F.sequence(F.lit(0), F.lit(DRAWS_PER_DOC - 1))).alias("i"))
    u = keyed_uniform("draw", F.col("doc_id"), F.col("i"))
    return (draws.select("source", F.floor(u * F.lit(10.0)).cast("bigint").alias("bucket"))
            .groupBy("source", "bucket").agg(F.count(F.lit(1)).alias("n")))


def q_weighted_split(spark, sf_dir):
    docs = load(spark, sf_dir, "documents", "doc_id")
    labels = load(spark, sf_dir, "labels", "doc_id", "quality")
    labels = labels.select("doc_id", "quality", F.lit(1).alias("labelled"))
    split = by_cut_points(keyed_uniform("split", F.col("doc_id")), SPLITS[0], SPLITS[1])
    j = docs.select("doc_id", split.alias("split")).join(labels, "doc_id", "left")
    return j.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.count("labelled").alias("n_labelled"),
        (F.sum("quality").cast("double") / F.count("labelled").cast("double")).alias("quality_rate"))


def q_default_members_union(spark, sf_dir):
    nation = load(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    region = load(spark, sf_dir, "region", "r_regionkey", "r_name")
    dim = (nation.join(region, nation.n_regionkey == region.r_regionkey, "left")
           .select(F.col("n_nationkey").alias("nation_id"), F.col("n_name").alias("name"),
                   F.coalesce("r_name", F.lit(DEFAULT_REGION)).alias("region_name"),
                   F.lit(False).alias("is_default")))
    # fixed members as a JVM-side inline table (no Python rows to ship)
    members = F.array(*[F.struct(F.lit(k).alias("nation_id"), F.lit(name).alias("name"),
                                 F.lit(DEFAULT_REGION).alias("region_name"), F.lit(True).alias("is_default"))
                        for k, name in DEFAULT_MEMBERS])
    defaults = spark.range(1).select(F.inline(members))
    return dim.unionByName(defaults)


def q_param_join(spark, sf_dir):
    o = load(spark, sf_dir, "orders", "o_orderpriority", "o_totalprice")
    # the one-row parameter as an uncorrelated scalar subquery (evaluated once)
    threshold = exact_means(o, [], {"mean": "o_totalprice"}).select(snap(F.col("mean") * F.lit(THRESHOLD_FACTOR)).alias("threshold")).scalar()
    j = o.withColumn("threshold", threshold).where(F.col("o_totalprice") > F.col("threshold"))
    return j.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n_above"), F.max("threshold").alias("threshold"))


# ---- O10-O15: pairing and per-key operators ---------------------------------------------

def _centroids(emb: DataFrame) -> tuple[DataFrame, int]:
    """Per-label mean vectors, materialised once with their row count (one job): the count
    decides how they are matched, then they are read from the checkpoint folder."""
    return write_round(V.mean_vectors(emb.select("label", V.as_double("embedding").alias("v")), ["label"], "v"))


def q_nearest_zone(spark, sf_dir, block_rows: int = BLOCK):
    """Each vector's nearest zone among those it lies in.

    A zone is a label's mean vector with the label's mean distance from it as radius, so radii
    differ; a vector is in a zone when its distance, over all dimensions, is at most the radius.
    """
    emb = load(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    centroids, _ = _centroids(emb)
    v = emb.select("vec_id", "label", V.as_double("embedding").alias("v"))
    spread = (v.join(centroids, "label").select("label", F.sqrt(V.sqdist("v", "centroid")).alias("d"))
              .groupBy("label").agg(snap(F.avg("d")).alias("radius")))
    zones = centroids.join(spread, "label").select(F.col("label").alias("zone"), "centroid", "radius")
    best = nearest_valid(v, "vec_id", "v", zones, order_key="zone", vector="centroid", radius="radius", item="zone", block=block_rows)
    return best.select("vec_id", "zone", snap("score").alias("distance"))


def q_nearest_centroid(spark, sf_dir, block_rows: int = BLOCK):
    emb = load(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    centroids, _ = _centroids(emb)
    best = nearest_valid(emb, "vec_id", "embedding", centroids.withColumnRenamed("label", "nearest"), order_key="nearest", vector="centroid",
                         item="nearest", carry=["label"], block=block_rows)
    return best.groupBy("label", "nearest").agg(F.count(F.lit(1)).alias("n"))


def q_nearest_supplied_part(spark, sf_dir):
    """Each part's nearest other catalogue entry in price and size, among parts within reach: an entry
    of size s reaches ``REACH`` + s.  Every third part is a catalogue entry, the others ask."""
    part = load(spark, sf_dir, "part", "p_partkey", "p_size", "p_retailprice")
    part = part.withColumn("at", F.array(F.col("p_retailprice"), F.lit(SIZE_SCALE) * F.col("p_size")))
    third = F.pmod("p_partkey", F.lit(3)) == 0
    shown = part.where(third).select("p_partkey", "at", (F.lit(REACH) + F.col("p_size")).alias("reach"))
    best = nearest_valid(part.where(~third), "p_partkey", "at", shown.withColumnRenamed("p_partkey", "entry"), order_key="entry", vector="at",
                         radius="reach", item="entry")
    return best.select("p_partkey", "entry", snap("score").alias("distance"))


def q_shipments_in_window(spark, sf_dir):
    """Lineitems shipped between an order of their customer and the customer's next one.

    Windows are a day to years long; the last one of a customer is open and holds nothing.
    """
    orders = load(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    days = orders.withColumn("day", F.unix_date(F.to_date("o_orderdate")).cast("bigint"))
    windows = (with_next_row(days.select("o_custkey", "day", "o_orderkey", "o_orderpriority"), "o_custkey", "day", "o_orderkey", [])
               .select("o_custkey", "o_orderpriority", "day", F.col("next_day").alias("until")))
    shipped = (load(spark, sf_dir, "lineitem", "l_orderkey", "l_quantity", "l_shipdate")
               .join(orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey")
               .select("o_custkey", "l_quantity", F.unix_date(F.to_date("l_shipdate")).cast("bigint").alias("ship_day")))
    met = range_join(shipped, windows, point="ship_day", low="day", high="until", on=["o_custkey"])
    return met.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("ship_day") - F.col("day")).alias("days"),
                                              F.max(F.col("until") - F.col("day")).alias("longest"))


def q_cheapest_supply(spark, sf_dir):
    """The cheapest way from the suppliers of nation 0 to every part and supplier, along shared lineitems.

    A step between a part and a supplier costs 1 and the least discount, in hundredths, at which
    the supplier sold the part.  Parts are nodes from 0, suppliers from -1 downwards.
    """
    li = load(spark, sf_dir, "lineitem", "l_partkey", "l_suppkey", "l_discount")
    sold = li.select(F.col("l_partkey").alias("part"), (-1 - F.col("l_suppkey")).alias("supplier"),
                     (1 + F.round(F.col("l_discount") * 100)).cast("bigint").alias("cost"))
    there = sold.select(F.col("supplier").alias("src"), F.col("part").alias("dst"), "cost")
    back = sold.select(F.col("part").alias("src"), F.col("supplier").alias("dst"), "cost")
    supplier = load(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey").where(F.col("s_nationkey") == START_NATION)
    seeds = supplier.select((-1 - F.col("s_suppkey")).alias("node"), F.lit(0).cast("bigint").alias("cost"))
    return cheapest_paths(seeds, there.union(back))


def q_restock_walk(spark, sf_dir):
    """A loop nested in a loop: suppliers spend their balance on drawn parts.

    Each round every supplier that still buys redraws a part until it is small enough
    (``REDRAW_MAX_SIZE``) and pays its price; a balance below 0 or ``RESTOCK_ROUNDS`` rounds end it.
    The draws' keys hold the supplier and the outer round, so a task that is run again draws the same.
    """
    part = load(spark, sf_dir, "part", "p_partkey", "p_size", "p_retailprice")
    n, fit = part.agg(F.max("p_partkey") + 1, F.count(F.when(F.col("p_size") <= REDRAW_MAX_SIZE, 1))).first()
    if not fit:
        raise ValueError(f"no part has p_size <= {REDRAW_MAX_SIZE}: no draw can be accepted")
    prices = part.select("p_partkey", "p_retailprice").hint("merge")
    supplier = load(spark, sf_dir, "supplier", "s_suppkey", "s_acctbal")
    nothing = F.lit(None).cast("bigint")
    seed = supplier.select("s_suppkey", F.lit(0).alias("round"), nothing.alias("draws"), nothing.alias("p_partkey"),
                           F.col("s_acctbal").alias("balance"), (F.col("s_acctbal") >= 0).alias("active"))

    def step(frontier: DataFrame, r: int) -> DataFrame:
        drawn = redraw_until_accepted(
            frontier, "s_suppkey", draw=lambda i: keyed_index("restock", F.lit(n), F.col("s_suppkey"), F.lit(r), i),
            accept=lambda tries: small_parts_accepted(tries, part))
        bought = drawn.withColumnRenamed("candidate", "p_partkey").join(prices, "p_partkey")
        left = F.col("balance") - F.col("p_retailprice")
        return (frontier.select("s_suppkey", "balance").join(bought, "s_suppkey")
                .select("s_suppkey", F.lit(r).alias("round"), F.col("draws").cast("bigint").alias("draws"), "p_partkey", left.alias("balance"),
                        ((left >= 0) & F.lit(r < RESTOCK_ROUNDS)).alias("active")))

    rows = frontier_loop(seed, step, active=F.col("active"), max_rounds=RESTOCK_ROUNDS)
    return rows.select("s_suppkey", "round", "draws", "p_partkey", snap("balance").alias("balance"), "active")


def q_next_event_after(spark, sf_dir):
    ev = load(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type")
    errors = ev.where(F.col("event_type") == "error")
    purchases = ev.where(F.col("event_type") == "purchase")
    m = first_match_after(errors, purchases, "user_id", probe_ts="ts", probe_id="event_id",
                          cand_ts="ts", cand_id="event_id", min_gap_us=ERROR_GAP_US)
    gap = F.expr("timestampdiff(MICROSECOND, ts, match_ts)") / F.lit(1e6)
    return m.select("event_id", F.col("match_id").alias("next_event_id"), gap.alias("gap_s"))


def q_latest_per_key(spark, sf_dir):
    o = load(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    r = latest_per_key(o, ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return r.select("o_custkey", "o_orderkey", _day("o_orderdate").alias("o_orderdate"), "o_totalprice")


def q_rows_at_group_max(spark, sf_dir):
    o = load(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    r = rows_at_group_max(o, ["o_custkey"], "o_orderdate")
    return r.select("o_custkey", "o_orderkey", _day("o_orderdate").alias("o_orderdate"))


def q_dedup_by_key(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return dedup_by_key(li, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey"])


# ---- O16-O19, O21-O26: vector columns and row formulas ---------------------------------

def q_vec_normalize(spark, sf_dir):
    emb = load(spark, sf_dir, "embeddings", "vec_id", "embedding")
    v = V.dims(V.as_double("embedding"), 1, TRUNCATE_DIMS)
    t = emb.select("vec_id", v.alias("v"))
    unit = t.select("vec_id", V.norm("v").alias("len"), V.normalize("v").alias("u"))
    return unit.select("vec_id", snap("len").alias("len_before"), snap(V.norm("u")).alias("len_after"))


def q_frame_vectors(spark, sf_dir):
    """Of each embedding, with a its first three dimensions and b the next: a + b and whether it is
    near zero, a x b and its unit vector turned against a, and a mirrored in the plane across b."""
    emb = load(spark, sf_dir, "embeddings", "vec_id", "embedding")
    e = V.as_double("embedding")
    t = emb.select("vec_id", V.dims(e, 1, 3).alias("a"), V.dims(e, 4, 3).alias("b"))
    t = t.select("vec_id", "a", V.add("a", "b").alias("s"), V.cross3("a", "b").alias("n"), V.normalize("b").alias("ub"))
    t = t.select("vec_id", "a", "s", "n", V.normalize("n").alias("un"), V.remove_direction("a", "ub", 2.0).alias("m"))
    t = t.select("vec_id", "s", "n", "m", V.orient("un", "a").alias("o"))

    def parts(name):
        return [snap(F.get(F.col(name), F.lit(k))).alias(f"{name}{k + 1}") for k in range(3)]
    return t.select("vec_id", F.forall("s", lambda x: F.abs(x) < NEAR_ZERO).alias("cancels"), *parts("s"), *parts("n"), *parts("o"), *parts("m"))


def q_vec_remove_direction(spark, sf_dir):
    emb = load(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    centroids, _ = _centroids(emb)
    dirs = centroids.select("label", V.normalize("centroid").alias("n"))
    j = emb.select("vec_id", "label", V.as_double("embedding").alias("v")).join(dirs, "label")
    j = j.withColumns({"w": V.remove_direction("v", "n", 1.0), "dv": V.dot("n", "v")})
    return j.select("vec_id",
                    snap("dv").alias("dot_before"),
                    snap(V.dot("n", "w")).alias("dot_after"),
                    snap(V.norm("w")).alias("len_after"),
                    (F.col("dv") < 0).alias("flipped"))


def q_plane_projection(spark, sf_dir):
    emb = load(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    e = V.as_double("embedding")
    pair_means = V.mean_vectors(emb.where(F.col("label").isin(0, 1)).select("label", e.alias("v")), ["label"], "v")
    pair_means = cut(pair_means)                     # two rows
    if pair_means.count() < 2:
        raise ValueError("plane_projection needs vectors of labels 0 and 1")
    two = pair_means.agg(*[F.max(F.when(F.col("label") == lab, F.col("centroid"))).alias(f"c{lab}") for lab in (0, 1)])
    # Gram-Schmidt: e1 along c0, e2 the unit part of c1 orthogonal to e1
    basis = (two.withColumn("e1", V.normalize("c0"))
             .withColumn("e2", V.normalize(V.remove_direction("c1", "e1", 1.0)))
             .select("e1", "e2"))
    j = emb.select("vec_id", e.alias("v")).crossJoin(F.broadcast(basis))   # one row
    return j.select("vec_id", snap(V.dot("v", "e1")).alias("along"), snap(V.dot("v", "e2")).alias("across"))


def q_linear_blend(spark, sf_dir):
    p = load(spark, sf_dir, "part", "p_brand", "p_size", "p_retailprice")
    p = p.select("p_brand", F.col("p_size").cast("double").alias("s"), F.col("p_retailprice").alias("pr"))
    # the limits as one uncorrelated scalar subquery (evaluated once, reused)
    lim = p.agg(F.struct(F.min("s").alias("s0"), F.max("s").alias("s1"),
                         F.min("pr").alias("p0"), F.max("pr").alias("p1"))).scalar()
    j = p.withColumns({c: lim[c] for c in ("s0", "s1", "p0", "p1")})
    s_norm = F.when(F.col("s1") > F.col("s0"), (F.col("s") - F.col("s0")) / (F.col("s1") - F.col("s0")))
    p_norm = F.when(F.col("p1") > F.col("p0"), (F.col("pr") - F.col("p0")) / (F.col("p1") - F.col("p0")))
    score = F.lit(BLEND[0]) * s_norm + F.lit(BLEND[1]) * p_norm
    return j.groupBy("p_brand").agg(snap(F.avg(score)).alias("avg_score"))


def q_guarded_metrics(spark, sf_dir):
    c = load(spark, sf_dir, "customer", "c_mktsegment", "c_acctbal")
    return c.groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(F.col("c_acctbal") < 0, 1)).alias("n_guarded"),
        snap(F.avg(guarded_sqrt("c_acctbal"))).alias("avg_root"),
        snap(F.avg(guarded_inverse("c_acctbal", 1000.0))).alias("avg_inverse"))


def q_route_and_union(spark, sf_dir):
    ev = load(spark, sf_dir, "events", "event_type", "value")
    value = F.col("value")
    routed = route(ev, [
        ("purchase", F.col("event_type") == "purchase", value * F.lit(0.7)),
        ("view", F.col("event_type") == "view", value * F.lit(0.01)),
        ("click", F.col("event_type") == "click", F.lit(0.05)),
    ], default=("other", F.lit(0.0)))
    return exact_sums(routed, ["route"], {"total": "amount"}).select("route", F.col("n_rows").alias("n"), snap("total").alias("total"))


def q_group_averages(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem", "l_orderkey", "l_returnflag", "l_quantity", "l_extendedprice", "l_discount")
    per_order = exact_means(li, ["l_returnflag", "l_orderkey"], {"q": "l_quantity", "p": "l_extendedprice", "d": "l_discount"})
    return per_order.groupBy("l_returnflag").agg(
        snap(F.avg("q")).alias("avg_qty"), snap(F.avg("p")).alias("avg_price"), snap(F.avg("d")).alias("avg_disc"))


def q_quantize_histogram(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem", "l_extendedprice")
    mx = li.agg(F.max("l_extendedprice")).scalar()      # scalar subquery, evaluated once
    return (li.select(quantize_sqrt("l_extendedprice", mx, QUANT_LEVELS).alias("level"))
            .groupBy("level").agg(F.count(F.lit(1)).alias("n")))


def q_cyclic_piecewise(spark, sf_dir):
    ev = load(spark, sf_dir, "events", "event_type", "ts")
    phase = (F.hour("ts") + F.minute("ts") / F.lit(60.0)) / F.lit(4.0)
    a, b, c = (triangle_wave(phase, shift, *WAVE) for shift in (0, 2, 4))
    t = ev.select("event_type", a.alias("a"), b.alias("b"), c.alias("c"))
    return t.groupBy("event_type").agg(*[snap(F.avg(x)).alias(x) for x in "abc"])


def q_parity_cells(spark, sf_dir):
    ev = load(spark, sf_dir, "events", "ts", "user_id", "value")
    block = F.floor(_hours_since_epoch("ts") / F.lit(6.0))
    arm = F.when(parity_even(block, F.col("user_id")), F.lit("A")).otherwise(F.lit("B"))
    means = exact_means(ev.select(arm.alias("arm"), "value"), ["arm"], {"avg_value": "value"})
    return means.select("arm", F.col("n_rows").alias("n"), snap("avg_value").alias("avg_value"))


# ---- O27, O28: ordered text -------------------------------------------------------------

def q_ordered_documents(spark, sf_dir):
    conv = load(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    docs = ordered_concat(conv, ["conv_id"], "turn", F.concat("role", F.lit(": "), "text"))
    return docs.select("conv_id", F.col("n_parts").alias("n_turns"), F.col("text").alias("transcript"))


def framed_lines(spark, sf_dir):
    nation = load(spark, sf_dir, "nation", *NATION_COLUMNS)
    body = global_line_numbers(nation.select("n_nationkey", F.concat_ws("|", *NATION_COLUMNS).alias("line")),
                               ["n_nationkey"])
    header = spark.range(1).select(F.lit(0).cast("bigint").alias("line_no"), F.lit("|".join(NATION_COLUMNS)).alias("line"))
    return header.unionByName(body.select("line_no", "line"))


def q_framed_export(spark, sf_dir):
    return framed_lines(spark, sf_dir)


def q_lineitem_export(spark, sf_dir):
    """All lineitems as one text in order, each line with its number and the byte where it begins."""
    li = load(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_shipdate")
    fields = [F.col(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")]
    lines = li.select("l_orderkey", "l_linenumber", F.concat_ws("|", *fields, _day("l_shipdate")).alias("line"))
    return with_offsets(lines, ["l_orderkey", "l_linenumber"], "line").select("line_no", "byte_start", "line")


QUERIES = {
    "journey_trace": q_journey_trace,
    "cooldown_chain": q_cooldown_chain,
    "redraw_until_accept": q_redraw_until_accept,
    "date_spine_counts": q_date_spine_counts,
    "replicate_rows": q_replicate_rows,
    "grid_cells": q_grid_cells,
    "keyed_uniform": q_keyed_uniform,
    "weighted_split": q_weighted_split,
    "default_members_union": q_default_members_union,
    "param_join": q_param_join,
    "nearest_zone": q_nearest_zone,
    "nearest_centroid": q_nearest_centroid,
    "nearest_supplied_part": q_nearest_supplied_part,
    "shipments_in_window": q_shipments_in_window,
    "cheapest_supply": q_cheapest_supply,
    "restock_walk": q_restock_walk,
    "event_walk": q_event_walk,
    "instalment_plan": q_instalment_plan,
    "supplier_draws": q_supplier_draws,
    "document_folds": q_document_folds,
    "next_event_after": q_next_event_after,
    "latest_per_key": q_latest_per_key,
    "rows_at_group_max": q_rows_at_group_max,
    "dedup_by_key": q_dedup_by_key,
    "vec_normalize": q_vec_normalize,
    "frame_vectors": q_frame_vectors,
    "vec_remove_direction": q_vec_remove_direction,
    "plane_projection": q_plane_projection,
    "linear_blend": q_linear_blend,
    "journey_score": q_journey_score,
    "guarded_metrics": q_guarded_metrics,
    "route_and_union": q_route_and_union,
    "group_averages": q_group_averages,
    "quantize_histogram": q_quantize_histogram,
    "cyclic_piecewise": q_cyclic_piecewise,
    "parity_cells": q_parity_cells,
    "ordered_documents": q_ordered_documents,
    "framed_export": q_framed_export,
    "lineitem_export": q_lineitem_export,
}
