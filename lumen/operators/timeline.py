"""As-of matches of many jobs against one set of rows, ordered once.

``first_match_after`` splits its candidates by range in every call; a loop whose every round is an
as-of match would do so in every round.  ``timeline`` orders the rows of each key once and packs
them into blocks of ``BLOCK`` successive rows, written to the shared folder.  A block answers the
times from its first row up to the first row of the key's next block, which it also carries, so a
match is a range join of probe times against blocks (an equi-join on key, level and cell, see
``ranges``) and a look into one array: no window, no range split and no sort of the rows again.

Nothing groups a whole key: blocks are cut inside (key, split), and what is ranked by key is one
row for each (key, split).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumen.operators.lineage import drop_round, write_round
from lumen.operators.ranges import levels_of, met_in_cells, with_cells
from lumen.operators.sequence import SPLIT, add_split, join_splits

#: Rows in a block.
BLOCK = 128
#: A time before all others, in microseconds; twice its size fits a bigint.
BEGINNING = -(1 << 61)


def _micros(at: Column) -> Column:
    return F.unix_micros(at.cast("timestamp"))


@dataclass(frozen=True)
class Timeline:
    """Blocks by cell: (__k, __low, __high, __items, __next, level, cell), and the levels in use."""

    key: str
    ts: str
    cells: DataFrame
    levels: list[int]

    def after(self, probes: DataFrame, at: str, name: str = "match") -> DataFrame:
        """The probes that have a row of their key later than ``at``, with the first such row by
        (ts, tiebreak) as the struct ``name``.  A probe with a null key or time has none."""
        asked = probes.where(F.col(self.key).isNotNull()).select(
            F.struct("*").alias("__probe"), F.col(self.key).alias("__k"), F.col(at).alias("__when"), _micros(F.col(at)).alias("__at"))
        met = met_in_cells(asked, self.cells, self.levels, point="__at", low="__low", high="__high", keys=["__k"])
        inside = F.get(F.filter("__items", lambda i: i[self.ts] > F.col("__when")), F.lit(0))
        return met.select("__probe.*", F.coalesce(inside, F.col("__next")).alias(name))

    def drop(self) -> None:
        """Delete the blocks, once every job that reads them is done."""
        drop_round(self.cells)


def timeline(rows: DataFrame, key: str, ts: str, tiebreak: str, carry: list[str] | None = None, block: int = BLOCK) -> Timeline:
    """Order ``rows`` by (key, ts, tiebreak) and write them in blocks; ``ts`` is a timestamp.

    Matches are structs (ts, tiebreak, *carry).  Rows with a null key or time are left out.
    """
    fields = [ts, tiebreak, *(carry or [])]
    usable = rows.where(F.col(key).isNotNull() & F.col(ts).isNotNull()).select(F.col(key).alias("__k"), F.struct(*fields).alias("__item"),
                                                                               F.col(ts).alias("__ts"), F.col(tiebreak).alias("__tie"))
    split = add_split(usable, "__k", ["__ts", "__tie"])
    w = Window.partitionBy("__k", SPLIT).orderBy("__item")
    numbered = split.select("__k", SPLIT, "__item", (F.row_number().over(w) - 1).alias("__row"), F.lead("__item").over(w).alias("__after"))
    packed, _ = write_round(numbered.groupBy("__k", SPLIT, F.floor(F.col("__row") / block).alias("__block")).agg(
        F.array_sort(F.collect_list("__item")).alias("__items"), F.max_by("__after", "__row").alias("__next")))

    # the last block of a split is followed by the first row of the key's next split
    heads = packed.where("__block = 0").select("__k", SPLIT, F.element_at("__items", 1).alias("__head"))
    following = heads.select("__k", SPLIT, F.lead("__head").over(Window.partitionBy("__k").orderBy(SPLIT)).alias("__later"))
    ends = join_splits(packed.where("__next IS NULL").drop("__next"), following, "__k").withColumnRenamed("__later", "__next")
    blocks = packed.where("__next IS NOT NULL").unionByName(ends)

    # times from a key's last row on have no match, times before its first row have that row
    last = F.coalesce(F.col("__next"), F.element_at("__items", -1))
    spans = blocks.select("__k", "__items", "__next", _micros(F.element_at("__items", 1)[ts]).alias("__low"), _micros(last[ts]).alias("__high"))
    first = F.min("__head")
    before = heads.groupBy("__k").agg(first.alias("__next")).select(
        "__k", F.array().cast(packed.schema["__items"].dataType).alias("__items"), "__next", F.lit(BEGINNING).alias("__low"),
        _micros(F.col("__next")[ts]).alias("__high"))
    cells, _ = write_round(with_cells(spans.unionByName(before), "__low", "__high"))
    drop_round(packed)
    return Timeline(key, ts, cells, levels_of(cells))
