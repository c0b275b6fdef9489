"""Vector columns (``array<double>``) with higher-order built-ins.

The reference spells every 3-vector as three scalar columns; here a vector is one array
column so the same builders work for 3 and 64 dimensions.  Sums run left to right
(``aggregate``), the same order the DuckDB twins use, so results agree bit for bit.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def as_double(v) -> Column:
    return _c(v).cast("array<double>")


def dims(v, start: int, count: int) -> Column:
    """Dimensions start..start+count-1 (1-based, like ``element_at``)."""
    return F.slice(_c(v), start, count)


def vsum(v) -> Column:
    return F.aggregate(_c(v), F.lit(0.0), lambda acc, x: acc + x)


def dot(a, b) -> Column:
    return vsum(F.zip_with(_c(a), _c(b), lambda x, y: x * y))


def sqdist(a, b) -> Column:
    """Squared euclidean distance, summed left to right."""
    return vsum(F.zip_with(_c(a), _c(b), lambda x, y: (x - y) * (x - y)))


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` as a lambda variable.

    Expressions inside higher-order-function lambdas are not shared, so a value used
    several times there would be recomputed each time; binding it through a one-element
    ``transform`` computes it once.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def norm(v) -> Column:
    v = _c(v)
    return F.sqrt(dot(v, v))


def scale(v, s) -> Column:
    s = s if isinstance(s, Column) else F.lit(s)
    return F.transform(_c(v), lambda x: x * s)


def add(a, b) -> Column:
    return F.zip_with(_c(a), _c(b), lambda x, y: x + y)


def sub(a, b) -> Column:
    return F.zip_with(_c(a), _c(b), lambda x, y: x - y)


def normalize(v) -> Column:
    """Unit vector; null for the zero vector (division is guarded, never raises).

    The squared length is the accumulator of one ``aggregate`` and the scaled vector is
    built in its finish step, so the length is computed once per row.  (A scalar written
    inside an array lambda is re-evaluated for every element: O(d^2) per row.)
    """
    v = _c(v)
    return F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x * x,
                       lambda ss: F.when(ss > 0, F.transform(v, lambda x: x / F.sqrt(ss))))


def remove_direction(v, n, c: float = 1.0) -> Column:
    """v - c * n (n . v) for a unit n; c = 1 projects n out, c = 2 reflects across the plane.

    n . v is computed once per row (accumulator of one ``aggregate``), then used by the
    element-wise step in the finish lambda.
    """
    v, n = _c(v), _c(n)
    cc = F.lit(float(c))
    return F.aggregate(F.zip_with(n, v, lambda y, x: y * x), F.lit(0.0), lambda acc, p: acc + p,
                       lambda d: F.zip_with(v, n, lambda x, y: x - (d * cc) * y))


def mean_vectors(df, keys: list[str], v, name: str = "centroid"):
    """DataFrame (keys..., name): element-wise mean of the vectors of each key.

    ``Summarizer`` adds whole vectors up, with partial sums before the shuffle: one row for each key and
    length of vector, no row for each element.  A dimension's mean is over the vectors that have it.
    Null and empty vectors, and those with a null element, are left out; NaN stays NaN.
    """
    rows = df.select(*keys, _c(v).cast("array<double>").alias("__v")).where("size(__v) > 0 AND NOT exists(__v, x -> x IS NULL)")
    sums = rows.groupBy(*keys, F.size("__v").alias("d")).agg(
        F.count(F.lit(1)).alias("n"), vector_to_array(Summarizer.sum(array_to_vector("__v"))).alias("s"))
    lengths = F.array_sort(F.collect_list(F.struct("d", "n", "s")))          # few: a row for each length of vector

    def plus(one, other):
        return F.zip_with(one, other, lambda a, b: F.coalesce(a, F.lit(0.0)) + F.coalesce(b, F.lit(0.0)))

    def add(state, x):
        return F.struct(plus(state["s"], x["s"]).alias("s"), plus(state["n"], F.transform(x["s"], lambda _: x["n"].cast("double"))).alias("n"))
    nothing = F.array().cast("array<double>")
    mean = F.aggregate("__l", F.struct(nothing.alias("s"), nothing.alias("n")), add, lambda t: F.zip_with(t["s"], t["n"], lambda a, b: a / b))
    return sums.groupBy(*keys).agg(lengths.alias("__l")).select(*keys, mean.alias(name))


def cross3(a, b) -> Column:
    """3-d cross product a x b (the frame built from two directions)."""
    a, b = _c(a), _c(b)

    def e(v, i):
        return F.element_at(v, i)

    return F.array(e(a, 2) * e(b, 3) - e(a, 3) * e(b, 2),
                   e(a, 3) * e(b, 1) - e(a, 1) * e(b, 3),
                   e(a, 1) * e(b, 2) - e(a, 2) * e(b, 1))


def orient(n, v) -> Column:
    """``n`` turned to face against ``v``: n when n . v < 0, else -n (front-face normal)."""
    n, v = _c(n), _c(v)
    return F.when(dot(n, v) < 0, n).otherwise(F.transform(n, lambda x: -x))
