"""Cutting lineage reliably.

Loops that feed a DataFrame back into itself grow their plan every round.  We cut it by
writing to the shared ``spark.checkpoint.dir`` the cluster names, so an executor lost
later cannot force a recompute of earlier rounds (never ``localCheckpoint``, whose blocks
die with the executor, and never a machine-local folder).

* ``cut``: ``DataFrame.checkpoint()``.
* ``write_round``: writes the rows as a parquet table under the checkpoint folder and
  reads it back, while an ``Observation`` counts rows in the same job; a loop gets its
  lineage cut *and* its stop test from one job instead of two.
* ``drop_round``: deletes a round's table once nothing reads it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lumen.session import ensure_checkpoint_dir


def cut(df: DataFrame) -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def write_round(df: DataFrame, counted: Column | None = None) -> tuple[DataFrame, int]:
    """Persist ``df`` as parquet in the shared checkpoint folder; return the re-read frame
    and the number of rows for which ``counted`` holds (all rows when None).

    The count comes from an Observation (accumulator-based): if a stage is re-run after an
    executor loss it may count some rows twice, never fewer.  Callers use it only where
    that is harmless: as a stop test (zero stays zero), as a partition-count hint, or to
    choose between plans that return the same rows.
    """
    spark = df.sparkSession
    path = ensure_checkpoint_dir(spark).rstrip("/") + f"/lumen-round-{uuid.uuid4().hex}"
    obs = Observation(f"round_{uuid.uuid4().hex[:12]}")
    cond = F.lit(True) if counted is None else F.coalesce(counted, F.lit(False))
    df.observe(obs, F.count(F.when(cond, 1)).alias("n")).write.mode("overwrite").parquet(path)
    n = obs.get["n"]
    return spark.read.schema(df.schema).parquet(path), int(n)


def drop_round(df: DataFrame) -> None:
    """Delete the table behind a frame that ``write_round`` returned."""
    spark = df.sparkSession
    for file in df.inputFiles()[:1]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
        if folder.getName().startswith("lumen-round-"):
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
