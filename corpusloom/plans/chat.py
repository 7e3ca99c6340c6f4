"""Conversations as prompts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def instruct(conversations: DataFrame, system: tuple[str, str]) -> DataFrame:
    """A prompt for each user turn, with the assistant turn before it (if any) as context and an open answer."""
    u = conversations.where("role = 'user'").select("conv_id", "turn", "text")
    a = conversations.where("role = 'assistant'").select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("context"))
    rows = u.join(a, ["conv_id", "turn"], "left")
    has = F.coalesce(F.col("context"), F.lit("")) != ""
    prompt = F.when(has, F.concat(F.lit("### Instruction:\n"), "text", F.lit("### Context:\n"), "context")).otherwise(F.col("text"))
    head = T.chat_block(F.lit("system"), F.when(has, F.lit(system[0])).otherwise(F.lit(system[1])))
    return rows.select("conv_id", "turn", F.concat(head, T.chat_block(F.lit("user"), prompt), T.chat_block(F.lit("assistant"), F.lit(None))).alias("text"))


def without_system(conversations: DataFrame) -> DataFrame:
    u = conversations.where("role = 'user'")
    return u.select("conv_id", "turn", F.concat(T.chat_block(F.lit("user"), F.col("text")), T.chat_block(F.lit("assistant"), F.lit(None))).alias("text"))
