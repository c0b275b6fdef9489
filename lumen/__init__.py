"""lumen: table operators on PySpark DataFrames.

Layout
------
sources/    loading the parquet tables, ordered text export
functions/  Column builders (keyed draws, exact sums, vectors, guards, piecewise maps)
operators/  multi-step DataFrame operators (frontier loop, redraw loop, next-in-sequence,
            nearest match, top row per key, ordered assembly, line numbering)
plans/      the registered queries and their DuckDB twins
streaming/  nothing: the reference has no stream processing
"""

__all__ = ["session", "sources", "functions", "operators", "plans"]
