"""Chat formatting with cumulative snapshots collapsed.

Logs often hold a conversation again and again, each time longer.  Rolling
hashes over the turns give every conversation a hash per prefix; one whose whole
hash is the proper prefix of another is dropped by an anti join, equal ones
leave the smallest id, and only what is left has its texts gathered and rendered.

Defined cases: rows that repeat (same conversation, turn, role, text) count
once; different rows of one turn number are ordered by their hashes; a null
role or text differs from an empty one and is rendered as empty; rows with a
null conversation id form one conversation; a conversation's turns are gathered
in one row, as a rendered text must be; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..staging import stage


def _turns(chats: DataFrame, names: tuple[str, str, str, str]) -> DataFrame:
    conv, turn, role, text = (chats[c] for c in names)
    role, text = role.cast("string"), text.cast("string")
    nulls = role.isNull().cast("int") + 2 * text.isNull().cast("int")
    return chats.select(
        conv.alias("conv_id"), turn.alias("turn"), role.alias("role"), text.alias("text"),
        F.xxhash64(nulls, role, text).alias("t1"), F.xxhash64(F.lit("second"), text, role, nulls).alias("t2"),
    )


def prefix_hashes(turns: Column) -> Column:
    """Per prefix of a sorted list of turns: two hashes, each of the one before and the turn."""
    start = F.struct(
        F.lit(0).cast("long").alias("h1"), F.lit(1).cast("long").alias("h2"),
        F.expr("CAST(array() AS ARRAY<STRUCT<h1: BIGINT, h2: BIGINT>>)").alias("seen"),
    )

    def step(state: Column, turn: Column) -> Column:
        h1, h2 = F.xxhash64(state["h1"], turn["t1"]), F.xxhash64(state["h2"], turn["t2"])
        return F.struct(
            h1.alias("h1"), h2.alias("h2"),
            F.concat(state["seen"], F.array(F.struct(h1.alias("h1"), h2.alias("h2")))).alias("seen"),
        )

    return F.aggregate(turns, start, step, lambda state: state["seen"])


def maximal_conversations(
    chats: DataFrame, names: tuple[str, str, str, str] = ("conv_id", "turn", "role", "text"),
) -> DataFrame:
    """`conv_id`, `n_turns`, `n_copies` of the conversations that are no proper prefix of another."""
    turns = _turns(chats, names).select("conv_id", "turn", "t1", "t2")
    hashed = stage(
        turns.groupBy("conv_id")
        .agg(F.sort_array(F.collect_set(F.struct("turn", "t1", "t2"))).alias("turns"))
        .select("conv_id", F.size("turns").cast("long").alias("n_turns"), prefix_hashes(F.col("turns")).alias("seen")),
        "conversations",
    )
    whole = F.element_at("seen", -1)
    # Copies become one row before anything is joined.
    different = hashed.groupBy(whole["h1"].alias("h1"), whole["h2"].alias("h2"), "n_turns").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_copies")
    )
    inner = hashed.select(F.posexplode(F.slice("seen", F.lit(1), F.greatest(F.size("seen") - 1, F.lit(0)))).alias("i", "p"))
    prefixes = inner.select(
        F.col("p.h1").alias("h1"), F.col("p.h2").alias("h2"), (F.col("i") + 1).cast("long").alias("n_turns")
    ).distinct()
    return different.join(prefixes, ["h1", "h2", "n_turns"], "left_anti").select("conv_id", "n_turns", "n_copies")


def format_chats(
    chats: DataFrame, names: tuple[str, str, str, str] = ("conv_id", "turn", "role", "text"),
    before: str = "<|", after: str = "|>\n", end: str = "\n",
) -> DataFrame:
    """`conv_id`, `n_turns`, `n_copies`, `rendered` for each maximal conversation."""
    kept = stage(maximal_conversations(chats, names), "maximal")
    own = kept.select(F.col("conv_id").alias("_id"))
    turns = _turns(chats, names)
    texts = (
        turns.join(own, turns["conv_id"].eqNullSafe(own["_id"]), "left_semi")
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_set(F.struct("turn", "t1", "t2", "role", "text"))).alias("turns"))
    )
    rendered = F.array_join(F.transform("turns", lambda t: F.concat(
        F.lit(before), F.coalesce(t["role"], F.lit("")), F.lit(after), F.coalesce(t["text"], F.lit("")), F.lit(end)
    )), "")
    texts = texts.select(F.col("conv_id").alias("_id"), rendered.alias("rendered"))
    return kept.join(texts, kept["conv_id"].eqNullSafe(texts["_id"])).select("conv_id", "n_turns", "n_copies", "rendered")
