"""Preference formatting of conversation pairs; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A turn is rendered as OPEN role CLOSE text END.
OPEN, CLOSE, END = "<|", "|>\n", "<|end|>\n"
LEARNED = "assistant"


def attach_pairs(turns: DataFrame, pairs: DataFrame) -> DataFrame:
    """Turns (conv_id, turn, role, text) with pair_id and side, for pairs (pair_id, chosen_id, rejected_id); a conversation can be in many pairs."""
    sides = pairs.select("pair_id", F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("chosen_id").alias("conv_id")), F.struct(F.lit(1).alias("side"), F.col("rejected_id").alias("conv_id")))).alias("s"))
    return turns.join(sides.select("pair_id", F.col("s.side").alias("side"), F.col("s.conv_id").alias("conv_id")), "conv_id")


def format_pairs(turns: DataFrame) -> DataFrame:
    """(pair_id, chosen_id, rejected_id, n_prefix, prompt, chosen, rejected, chosen_mask, rejected_mask) of each pair.

    `turns` has (pair_id, side, conv_id, turn, role, text); side 0 is the chosen conversation,
    side 1 the rejected one. Turns are ordered by turn, then role and text; equal turns stay.
    The longest common prefix of turns, equal in role and text, is rendered
    once as the prompt; the rest of each is its completion, empty if nothing is left. A mask lists the spans (start,
    stop) of a completion, in code points, that are learned: the text and end mark of assistant turns.
    A null role renders as `user`, a null text as ''. A missing side has a null id and an empty
    completion, and the prompt is empty then. Rows with a null pair_id or side are left out. An empty table gives an
    empty result. One shuffle, by pair; a group is one pair's turns.
    """
    rows = turns.where("pair_id is not null and side is not null").select(
        "pair_id", F.col("side").cast("int").alias("side"), "conv_id", "turn", F.coalesce("role", F.lit("user")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    rows = rows.withColumn("shown", F.concat(F.lit(OPEN), "role", F.lit(CLOSE), "text", F.lit(END))).repartition("pair_id")
    order = Window.partitionBy("pair_id", "side").orderBy("turn", "role", "text")
    rows = rows.withColumn("nth", F.row_number().over(order)).withColumn("stop", F.sum(F.length("shown")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    pairs = rows.groupBy("pair_id").agg(
        F.min(F.when(F.col("side") == 0, F.col("conv_id"))).alias("chosen_id"),
        F.min(F.when(F.col("side") == 1, F.col("conv_id"))).alias("rejected_id"),
        F.sort_array(F.collect_list(F.struct("side", "nth", "role", "text", "shown", "stop"))).alias("all"),
    )
    pairs = pairs.withColumn("c", F.filter("all", lambda t: t["side"] == 0)).withColumn("r", F.filter("all", lambda t: t["side"] == 1))
    both = F.least(F.size("c"), F.size("r"))
    differs = F.filter(F.sequence(F.lit(1), both), lambda i: (F.element_at("c", i)["role"] != F.element_at("r", i)["role"]) | (F.element_at("c", i)["text"] != F.element_at("r", i)["text"]))
    pairs = pairs.withColumn("n_prefix", F.when(both < 1, 0).otherwise(F.coalesce(F.array_min(differs) - 1, both)))
    pairs = pairs.withColumn("skip", F.when(F.col("n_prefix") > 0, F.element_at("c", F.greatest("n_prefix", F.lit(1)))["stop"]).otherwise(0))

    def shown(part: Column) -> Column:
        return F.array_join(F.transform(part, lambda t: t["shown"]), "")

    def rest(side: str) -> Column:
        return F.slice(F.col(side), F.col("n_prefix") + 1, F.greatest(F.size(side) - F.col("n_prefix"), F.lit(0)))

    def mask(side: str) -> Column:
        return F.transform(F.filter(rest(side), lambda t: t["role"] == LEARNED), lambda t: F.struct((t["stop"] - F.col("skip") - F.length(t["text"]) - len(END)).alias("start"), (t["stop"] - F.col("skip")).alias("stop")))

    return pairs.select(
        "pair_id",
        "chosen_id",
        "rejected_id",
        F.col("n_prefix").cast("long").alias("n_prefix"),
        shown(F.slice("c", F.lit(1), F.col("n_prefix"))).alias("prompt"),
        shown(rest("c")).alias("chosen"),
        shown(rest("r")).alias("rejected"),
        mask("c").alias("chosen_mask"),
        mask("r").alias("rejected_mask"),
    )
