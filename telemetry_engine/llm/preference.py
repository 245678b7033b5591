"""Preference formatting of chats: one prompt, two masked completions.

Two conversations, chosen and rejected, are compared turn by turn.  Their
longest common prefix of turns (same role, same text) is rendered once as the
prompt; what follows in each is its completion.  A completion carries its
loss mask as the spans of characters that train: the texts of assistant turns
and the end marks that close them.  Everything else, and the whole prompt, is
masked.

A turn is rendered as ``<|role|>``, line feed, text, ``<|end|>``, line feed.

Rows without a conversation id form no conversation.  A null role is
``unknown``, a null text empty.  Turns are ordered by (turn, role, text), null
first; repeated rows are turns as well.  Equal conversations, or one that
begins with all of the other, have an empty completion with no span.  An empty
table gives no pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetry_engine.llm import common as C

END = "<|end|>"
PAIRS_PER_SALT = 10_000

_TURNS = "array<struct<turn:bigint,role:string,text:string>>"


def conversations(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text") -> DataFrame:
    """(conv_id, turns): one row per conversation."""
    one = F.struct(C.col(turn_col).cast("long").alias("turn"), F.coalesce(C.col(role_col), F.lit("unknown")).alias("role"),
                   F.coalesce(C.col(text_col), F.lit("")).alias("text"))
    return (turns.where(C.col(id_col).isNotNull()).groupBy(C.col(id_col).cast("long").alias("conv_id"))
            .agg(F.array_sort(F.collect_list(one)).cast(_TURNS).alias("turns")))


def reply_pairs(chats: DataFrame) -> DataFrame:
    """A conversation up to its last reply, against the same one that repeats its first reply there.

    For every conversation with two different replies at least; (chosen_id, rejected_id, chosen, rejected).
    """
    n = F.size("turns")
    last = n - F.array_position(F.transform(F.reverse("turns"), lambda t: t["role"]), "assistant").cast("int") + 1
    first = F.filter("turns", lambda t: t["role"] == "assistant")[0]
    some = F.exists("turns", lambda t: t["role"] == "assistant")
    return (chats.where(some).withColumn("last", last).withColumn("first", first)
            .where(F.get("turns", F.col("last") - 1)["text"] != F.col("first.text"))
            .select(F.col("conv_id").alias("chosen_id"), F.col("conv_id").alias("rejected_id"),
                    F.slice("turns", F.lit(1), F.col("last")).alias("chosen"),
                    F.concat(F.slice("turns", F.lit(1), F.col("last") - 1), F.array("first")).cast(_TURNS).alias("rejected")))


def opening_pairs(chats: DataFrame) -> DataFrame:
    """Of the conversations that open with the same turn, the one of the least id against each of the others.

    A popular opening is spread over salts, its first conversation copied to each.
    """
    first = F.get("turns", F.lit(0))
    opening = F.xxhash64(first["role"], first["text"]).alias("opening")
    ids = chats.select("conv_id", opening, F.length(first["text"]).alias("length"))
    heads = (ids.groupBy("opening", "length").agg(F.min("conv_id").alias("chosen_id"), F.count("*").alias("n"))
             .where("n > 1").withColumn("salts", F.ceil(F.col("n") / PAIRS_PER_SALT).cast("int")))
    pairs = (ids.join(heads, ["opening", "length"]).where("conv_id != chosen_id")
             .select("chosen_id", F.col("conv_id").alias("rejected_id"),
                     F.pmod(F.xxhash64("conv_id"), F.col("salts")).cast("int").alias("salt")))
    copies = heads.select("chosen_id", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    chosen = chats.select(F.col("conv_id").alias("chosen_id"), F.col("turns").alias("chosen")).join(copies, "chosen_id")
    return (chats.select(F.col("conv_id").alias("rejected_id"), F.col("turns").alias("rejected"))
            .join(pairs, "rejected_id").join(chosen, ["chosen_id", "salt"])
            .select("chosen_id", "rejected_id", "chosen", "rejected"))


def _render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _turn), "")


def _turn(t: Column) -> Column:
    return F.concat(F.lit("<|"), t["role"], F.lit("|>\n"), t["text"], F.lit(f"{END}\n"))


def _trained(turns: str) -> Column:
    """Spans (start, end) of a completion's characters that train."""
    kind = "array<struct<start:int,end:int>>"
    return F.expr(f"""
      aggregate({turns}, named_struct('at', 0, 'out', cast(array() AS {kind})),
        (a, t) -> named_struct(
          'at', a.at + length(t.role) + length(t.text) + {5 + len(END) + 1},
          'out', cast(CASE WHEN t.role = 'assistant' THEN array_append(a.out, named_struct(
              'start', a.at + length(t.role) + 5,
              'end', a.at + length(t.role) + 5 + length(t.text) + {len(END)})) ELSE a.out END AS {kind})),
        a -> a.out)""")


def formatted(pairs: DataFrame) -> DataFrame:
    """(chosen_id, rejected_id, prompt_turns, prompt, chosen, rejected, chosen_spans, rejected_spans) of each pair."""
    same = F.zip_with("chosen", "rejected", lambda x, y: x.isNotNull() & y.isNotNull()
                      & x["role"].eqNullSafe(y["role"]) & x["text"].eqNullSafe(y["text"]))
    differ = F.array_position(same, False).cast("int")
    n = F.when(differ > 0, differ - 1).otherwise(F.least(F.size("chosen"), F.size("rejected")))
    rest = lambda c: F.slice(c, F.col("prompt_turns") + 1, F.greatest(F.size(c) - F.col("prompt_turns"), F.lit(0)))
    return (pairs.withColumn("prompt_turns", n)
            .select("chosen_id", "rejected_id", "prompt_turns",
                    _render(F.slice("chosen", F.lit(1), F.col("prompt_turns"))).alias("prompt"),
                    rest("chosen").alias("c"), rest("rejected").alias("r"))
            .select("chosen_id", "rejected_id", "prompt_turns", "prompt", _render(F.col("c")).alias("chosen"),
                    _render(F.col("r")).alias("rejected"), _trained("c").alias("chosen_spans"),
                    _trained("r").alias("rejected_spans")))


def preferences(turns: DataFrame) -> DataFrame:
    """Formatted reply pairs and opening pairs of a table of turns; ``kind`` says which."""
    chats = conversations(turns)
    return (formatted(reply_pairs(chats)).withColumn("kind", F.lit("reply"))
            .unionByName(formatted(opening_pairs(chats)).withColumn("kind", F.lit("opening"))))
