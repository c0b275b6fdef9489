"""Chat formatting by prefix-target expansion.

Every assistant turn becomes one example: all turns before it as context, and that reply as
the only text under the loss mask.  A conversation that does not end with an assistant turn
(or has none) gives one more example with all its turns and an empty mask, so that no turn is
lost.

Template: ``<|start|>role<|text|>text<|end|>`` for each turn.  Control strings inside a role
or text (those of the template and common ones of other templates) get a backslash after
their first character, and one more for each they already carry; ``unescape`` takes one away.

Defined cases: null role or text is empty; turns are ordered by (turn, role, text), null
first; repeated rows stay repeated turns; rows with a null conv_id form one conversation.
Other columns are ignored, whatever their names.  One example is one row: the examples of a
conversation of n turns hold n(n+1)/2 turns at most, which is what the expansion asks for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The template's marks.
START, TEXT, END = "<|start|>", "<|text|>", "<|end|>"
# What can follow the first character of a control string.
CONTROL_TAILS = r"\||/?s>|/?INST\]|/?SYS>>"

ESCAPE = rf"([<\[])(\\*)({CONTROL_TAILS})"
UNESCAPE = rf"([<\[])\\(\\*)({CONTROL_TAILS})"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(ESCAPE), F.lit(r"$1\\$2$3"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(UNESCAPE), F.lit("$1$2$3"))


def format_chat(turns: DataFrame) -> DataFrame:
    """Examples (conv_id, example, n_turns, formatted, loss_start, loss_end) of rows (conv_id, turn, role, text).

    ``example`` counts from 1 in turn order; the mask is [loss_start, loss_end) in code points.
    """
    clean = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    ordered = (clean.groupBy("conv_id")
               .agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
               .select("conv_id", F.transform("turns", lambda t: t["role"]).alias("roles"),
                       F.transform("turns", lambda t: F.concat(F.lit(START), escape(t["role"]), F.lit(TEXT), escape(t["text"]),
                                                               F.lit(END))).alias("pieces")))
    n = F.size("pieces")
    targets = F.filter(F.sequence(F.lit(1), n), lambda k: (F.get("roles", k - 1) == "assistant") | (k == n))
    examples = ordered.select("conv_id", "roles", "pieces", F.posexplode(targets).alias("pos", "n_turns"))
    trained = F.get("roles", F.col("n_turns") - 1) == "assistant"
    context = F.array_join(F.slice("pieces", F.lit(1), F.col("n_turns") - 1), "")
    head = len(START + "assistant" + TEXT)
    whole = examples.select("conv_id", (F.col("pos") + 1).alias("example"), "n_turns", trained.alias("trained"), context.alias("context"),
                            F.get("pieces", F.col("n_turns") - 1).alias("last"))
    start = F.length("context") + head
    return whole.select(
        "conv_id", "example", "n_turns", F.concat("context", "last").alias("formatted"),
        F.when(F.col("trained"), start).otherwise(0).alias("loss_start"),
        F.when(F.col("trained"), F.length("context") + F.length("last") - len(END)).otherwise(0).alias("loss_end"))


def loss_text(formatted: str = "formatted") -> Column:
    """The text under an example's mask, unescaped."""
    return unescape(F.substring(F.col(formatted), F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start")))


def read_turns(formatted: Column) -> Column:
    """The array of (role, text) read back from a formatted example."""
    def turn(piece: Column) -> Column:
        parts = F.split(F.substring_index(piece, START, -1), r"<\|text\|>", 2)
        return F.struct(unescape(F.get(parts, F.lit(0))).alias("role"), unescape(F.get(parts, F.lit(1))).alias("text"))
    pieces = F.split(formatted, r"<\|end\|>")
    return F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), turn)
