"""Chat formatting: a dialogue of several parties, rendered once for each participant as the assistant.

For every participant of a conversation each turn is a rendered piece: the participant's own turns are the assistant's
and carry the loss, others' are named users', system turns are system's in every rendering and nobody's own. A piece has
its place among the code points of its dialogue (start, end), so pieces in order of start are the dialogue, and the rows
with loss are its mask; the header of an assistant's piece is not learnt: loss_start is where its text begins.

A dialogue is never gathered: places are sums of piece lengths within blocks of `block` turn numbers plus sums of the blocks
before, so that a conversation with a third of all rows is spread over tasks. Where a block has more than `most` rows, by many
turns of one number or of none, it is cut further by turn, speaker and how the text begins, and equal turns are one row with
their count until they have their places.

Defined results: a null text is an empty piece; a null speaker is named "unknown"; null turns come last; turns of one
number are ordered by speaker, then text; repeated rows are repeated turns; a null conv_id is a conversation (no other than that of an id "null"); very long texts are one
piece; a conversation of system turns only has no participant and no row; "<|" within texts and names is written "< |", so that
no text can pose as a turn; an empty table gives an empty table; other columns are left out.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import counted

BLOCK = 256
MOST = 4096
BEGINS = 16
SYSTEM = "system"
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def _safe(c: Column) -> Column:
    return F.replace(c, F.lit("<|"), F.lit("< |"))


def _placed_rows(turns: DataFrame, speaker: str, block: int, most: int) -> DataFrame:
    """conv_id, _key, turn, speaker, text, _part, _sub (together the block, in order) and _m, how many equal turns a row stands for."""
    key = F.concat(F.when(F.col("conv_id").isNull(), "0").otherwise("1"), F.coalesce(F.col("conv_id").cast("string"), F.lit("")))
    rows = turns.select(
        "conv_id", key.alias("_key"), "turn", F.coalesce(F.col(speaker), F.lit("unknown")).alias("speaker"),
        F.coalesce("text", F.lit("")).alias("text"), F.coalesce(F.floor(F.col("turn") / block), F.lit((1 << 62))).cast("long").alias("_part"),
    )
    begin = F.struct(F.col("turn").isNull().alias("none"), "turn", "speaker", F.substring("text", 1, BEGINS).alias("begins"))
    full = counted(rows.groupBy("_key", "_part").agg(F.count("*").alias("_n")).where(F.col("_n") > most).select("_key", "_part"))
    cold = rows.join(full, ["_key", "_part"], "left_anti").withColumn("_m", F.lit(1).cast("long"))
    hot = rows.join(full, ["_key", "_part"], "left_semi").groupBy(*rows.columns).agg(F.count("*").alias("_m"))
    return cold.select(*rows.columns, "_m", F.when(F.lit(False), begin).alias("_sub")).unionByName(hot.withColumn("_sub", begin))


def rotate(turns: DataFrame, speaker: str = "role", block: int = BLOCK, most: int = MOST) -> DataFrame:
    """conv_id, perspective, turn, speaker, role, piece, loss, start, loss_start, end for each participant and turn."""
    rows = _placed_rows(turns, speaker, block, most)
    people = rows.where(F.col("speaker") != SYSTEM).select("_key", F.col("speaker").alias("perspective")).distinct()
    each = rows.join(people, "_key")
    own, system = F.col("speaker") == F.col("perspective"), F.col("speaker") == SYSTEM
    role = F.when(system, "system").when(own, "assistant").otherwise("user")
    name = F.when(role == "user", F.concat(F.lit(" name="), _safe(F.col("speaker")))).otherwise("")
    head = F.concat(F.lit(OPEN), role, name, F.lit("\n"))
    each = each.withColumns({"role": role, "piece": F.concat(head, _safe(F.col("text")), F.lit(CLOSE)), "_head": F.length(head), "loss": own & ~system})
    each = each.withColumn("_n", F.length("piece").cast("long")).withColumn("_all", F.col("_n") * F.col("_m"))
    at = ["_key", "perspective", "_part", "_sub"]
    totals = each.groupBy(*at).agg(F.sum("_all").alias("_sum"))
    earlier = Window.partitionBy("_key", "perspective").orderBy("_part", "_sub").rowsBetween(Window.unboundedPreceding, -1)
    fronts = totals.select(*[F.col(c).alias(f"{c}_") for c in at], F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_front"))
    inside = Window.partitionBy(*at).orderBy(F.col("turn").asc_nulls_last(), "speaker", "text").rowsBetween(Window.unboundedPreceding, -1)
    same = [F.col(c).eqNullSafe(F.col(f"{c}_")) for c in at]
    placed = each.withColumn("_in", F.coalesce(F.sum("_all").over(inside), F.lit(0))).join(fronts, reduce(and_, same))
    placed = placed.withColumn("_nth", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_m") - 1)))
    start = F.col("_front") + F.col("_in") + F.col("_nth") * F.col("_n")
    return placed.select(
        "conv_id", "perspective", "turn", "speaker", "role", "piece", "loss", start.alias("start"),
        F.when(F.col("loss"), start + F.col("_head")).alias("loss_start"), (start + F.col("_n")).alias("end"),
    )


def dialogues(turns: DataFrame, **options) -> DataFrame:
    """conv_id, perspective, text, spans: whole dialogues, for conversations that one row can hold."""
    piece = F.struct("start", "piece", "loss", "loss_start", "end")
    listed = rotate(turns, **options).groupBy("conv_id", "perspective").agg(F.array_sort(F.collect_list(piece)).alias("_p"))
    spans = F.transform(F.filter("_p", lambda p: p["loss"]), lambda p: F.struct(p["loss_start"].alias("start"), p["end"].alias("end")))
    return listed.select("conv_id", "perspective", F.array_join(F.transform("_p", lambda p: p["piece"]), "").alias("text"), spans.alias("spans"))
