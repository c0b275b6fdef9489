"""Native recursion for row-local steps: Spark's own WITH RECURSIVE.

Where a step needs nothing but its own row (no aggregate, no join of the frontier), the loop need
not come back to the driver round by round: Spark runs it as one recursive plan.  Spark stops
such a plan at a number of levels and of rows from its settings; both are given here as bounds read off
the data, so a recursion that would pass them raises instead of returning a cut result.

The result is written to the shared folder, because the row limit is a setting of the session
while the plan runs and is put back right after.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from lumen.operators.lineage import write_round

ROW_LIMIT = "spark.sql.cteRecursionRowLimit"


def recursed(base: DataFrame, step: dict[str, str], where: str, *, levels: int, rows: int) -> DataFrame:
    """All rows of ``base`` and of the steps from them.

    step: an SQL expression over a row for each column of ``base``, cast to its type; rows for which
    ``where`` holds step on.  levels: most steps from a row of ``base``; rows: most rows in all.
    Raises if either is passed.
    """
    if set(step) != set(base.columns):
        raise ValueError("step needs an expression for each column")
    spark, view = base.sparkSession, f"lumen_{uuid.uuid4().hex}"
    base.createOrReplaceTempView(view)
    names = ", ".join(f"`{c}`" for c in base.columns)
    stepped = ", ".join(f"CAST({step[c]} AS {t}) AS `{c}`" for c, t in base.dtypes)
    before = spark.conf.get(ROW_LIMIT, None)
    spark.conf.set(ROW_LIMIT, str(rows + 1))             # Spark stops when the limit is met
    try:
        # the level that finds nothing left counts as one
        every = spark.sql(f"WITH RECURSIVE r({names}) MAX RECURSION LEVEL {levels + 2} AS "
                          f"(SELECT {names} FROM {view} UNION ALL SELECT {stepped} FROM r WHERE {where}) SELECT * FROM r")
        return write_round(every)[0]
    finally:
        if before is None:
            spark.conf.unset(ROW_LIMIT)
        else:
            spark.conf.set(ROW_LIMIT, before)
        spark.catalog.dropTempView(view)
