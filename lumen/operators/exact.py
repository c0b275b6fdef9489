"""Exact sums and means of doubles, whatever their size and order.

A double is cut at fixed powers of two into parts of ``BITS`` bits, and the parts are summed as
64-bit integers (a group may hold 2^36 rows).  Integer sums do not depend on order, so neither
does the result, and nothing is rounded before the end: cancelling amounts cancel exactly.

Numbers from 2^-26 to 2^52 (and zero) fall into the same five parts, which are columns of one
hash aggregate with partial sums.  Others (1e300, 1e-12) are summed by exponent: one row for each
key and range of 26 exponents, put together in order of exponent.  Whether there are any is one
look at the data, and the answer is the same number either way.  NaN and infinities are added as they
are, so a broken input shows in the result; nulls are left out.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 26
BASE = float(1 << BITS)
#: Parts of usual numbers: multiples of 2^(26 * place).
PLACES = (-3, -2, -1, 0, 1)
SMALLEST, LARGEST = 2.0 ** -BITS, 2.0 ** (2 * BITS)


def usual(x: Column) -> Column:
    return (x == 0) | ((F.abs(x) >= SMALLEST) & (F.abs(x) < LARGEST))


def special(x: Column) -> Column:
    return F.isnan(x) | (F.abs(x) == float("inf"))


def part(x: Column, place: int) -> Column:
    """The digit of ``x`` at 2^(26 * place), with its sign; scaling and remainder are exact."""
    scaled = x * F.lit(2.0 ** (-BITS * place))
    return (scaled if place == PLACES[-1] else scaled % F.lit(BASE)).cast("bigint")


def put_together(sums: list[Column]) -> Column:
    """The double nearest to the sum of ``sums[k] * 2^(26 * PLACES[k])``, by more than its last bit."""
    mask, digits, carry = F.lit((1 << BITS) - 1), [], F.lit(0).cast("bigint")
    for s in sums[:-1]:
        value = s + carry
        digits.append(value.bitwiseAND(mask))
        carry = F.shiftright(value, BITS)
    out = (sums[-1] + carry).cast("double")
    for digit in reversed(digits):             # from the top, so that cancelling digits cancel
        out = out * F.lit(BASE) + digit
    return out * F.lit(2.0 ** (BITS * PLACES[0]))


def wide_sums(df: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """(keys..., __wide_<name>...): sums of the finite numbers that are not usual."""
    each = F.posexplode(F.array(*[F.col(n) for n in names])).alias("__c", "__x")
    rows = df.select(*keys, each).where(~usual(F.col("__x")) & ~special(F.col("__x")))
    x = F.col("__x")
    # log2 is not exact: a little less, so that the scaled number is at least 1
    rows = rows.withColumn("__bin", F.floor((F.log2(F.abs(x)) - 0.001) / BITS))
    half = F.pow(F.lit(2.0), F.col("__bin") * F.lit(-BITS // 2))
    rows = rows.withColumn("__y", x * half * half)
    parts = [F.sum((F.col("__y") * F.lit(BASE**k) % F.lit(BASE) if k else F.col("__y")).cast("bigint")).alias(f"__p{k}") for k in range(3)]
    binned = rows.groupBy(*keys, "__c", "__bin").agg(*parts)
    scale = F.pow(F.lit(2.0), F.col("__bin") * F.lit(BITS // 2))
    terms = []
    for k in range(3):                         # two exact doubles for each integer
        high, low = F.shiftright(f"__p{k}", BITS).cast("double") * BASE, F.col(f"__p{k}").bitwiseAND(F.lit((1 << BITS) - 1)).cast("double")
        terms += [high * F.lit(BASE**-k) * scale * scale, low * F.lit(BASE**-k) * scale * scale]
    gathered = binned.groupBy(*keys, "__c").agg(F.array_sort(F.collect_list(F.struct((-F.col("__bin")).alias("o"), F.array(*terms).alias("t")))).alias("__t"))

    def add(state: Column, t: Column) -> Column:
        total = state["s"] + t
        lost = F.when(F.abs(state["s"]) >= F.abs(t), (state["s"] - total) + t).otherwise((t - total) + state["s"])
        return F.struct(total.alias("s"), (state["c"] + lost).alias("c"))
    whole = F.aggregate(F.flatten(F.transform("__t", lambda b: b["t"])), F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("c")), add,
                        lambda s: F.when(F.isnan(s["c"]), s["s"]).otherwise(s["s"] + s["c"]))
    summed = gathered.select(*keys, "__c", whole.alias("__w"))
    return summed.groupBy(*keys).agg(*[F.max(F.when(F.col("__c") == k, F.col("__w"))).alias(f"__wide_{n}") for k, n in enumerate(names)])


def exact_sums(df: DataFrame, keys: list[str], columns: Mapping[str, str | Column]) -> DataFrame:
    """(keys..., n_rows, <name>, n_<name>...): rows, exact sum and non-null count of each column by key.

    The sum of no number is null.  A null key is a key like any other; without keys there is one row.
    """
    names = list(columns)
    rows = df.select(*keys, *[(F.col(c) if isinstance(c, str) else c).cast("double").alias(n) for n, c in columns.items()])
    found = [F.count(F.lit(1)).alias("n_rows")]
    for n in names:
        x = F.col(n)
        found += [F.count(x).alias(f"n_{n}"), F.sum(F.when(special(x), x)).alias(f"__odd_{n}")]
        found += [F.coalesce(F.sum(F.when(usual(x), part(x, place))), F.lit(0)).alias(f"__{k}_{n}") for k, place in enumerate(PLACES)]
    out = rows.groupBy(*keys).agg(*found)
    is_wide = [F.coalesce(F.bool_or(~usual(F.col(n)) & ~special(F.col(n))), F.lit(False)) for n in names]
    some = any(rows.agg(*[w.alias(f"w{k}") for k, w in enumerate(is_wide)]).first())
    if some:
        wide = wide_sums(rows, keys, names).withColumnsRenamed({k: f"__of_{k}" for k in keys})
        same = F.lit(True)
        for k in keys:
            same = same & F.col(k).eqNullSafe(F.col(f"__of_{k}"))
        out = out.join(wide, same, "left") if keys else out.crossJoin(F.broadcast(wide))   # one row without keys

    def total(n: str) -> Column:
        whole = put_together([F.col(f"__{k}_{n}") for k in range(len(PLACES))])
        whole = whole + F.coalesce(f"__wide_{n}", F.lit(0.0)) if some else whole
        return F.when(F.col(f"n_{n}") > 0, F.coalesce(f"__odd_{n}", whole)).alias(n)
    return out.select(*keys, "n_rows", *[c for n in names for c in (total(n), f"n_{n}")])


def exact_means(df: DataFrame, keys: list[str], columns: Mapping[str, str | Column]) -> DataFrame:
    """(keys..., n_rows, <name>...): the exact sums divided by the non-null counts."""
    sums = exact_sums(df, keys, columns)
    return sums.select(*keys, "n_rows", *[F.when(F.col(f"n_{n}") > 0, F.col(n) / F.col(f"n_{n}")).alias(n) for n in columns])
