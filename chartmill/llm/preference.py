"""Preference pairs for chat models.

A chosen and a rejected conversation share a pair_id.  The longest prefix of turns that both have is rendered once as the
prompt; what follows on either side are the two completions.  A pair is a record of prompt, chosen and rejected text with the spans
of the completions that count for the loss: the assistant's messages; prompts and other roles are masked.  Of a long pair
each block of `BLOCK` turn numbers is a record of its own, a piece, so that no conversation has to fit into one row or
task; its pieces in order, the one of null turns first, are the pair.  `sides` tells pairs with both sides from those with only one,
which hold no preference: they have no prompt, and their side is whole.

A message is rendered as <|role|>, its text and <|end|>, each followed by a line feed.  Turns go by number, null first.  A
message that a side holds twice in a turn counts once; different ones of a turn are in order of role and text, and the turn
is shared if both sides hold all of them.  Null roles and texts are empty.  Rows without pair_id belong to no pair and are
left out.  If one side goes on where the other ends, the shorter one's completion is empty.  Extra columns are ignored.
Empty tables give no rows.

What a pair needs to know of itself, where its sides part, comes from hashes of its messages; so texts are shuffled once, by
pair and block, while the pairs are few enough to be broadcast, and twice beyond that.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartmill.llm.shared import before, bounded, let, row_key, written

FIRST = -(1 << 63)
BLOCK = 64
PARTS = ("prompt", "chosen", "rejected")


def rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), text, F.lit("\n<|end|>\n"))


def plain(rows: DataFrame, key: str) -> DataFrame:
    """The rows with a key, their nulls as what they count for."""
    empty = F.lit("")
    return rows.where(F.col(key).isNotNull()).select(key, F.coalesce(F.col("turn").cast("long"), F.lit(FIRST)).alias("turn"), F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text"))


def messages_of(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """(pair_id, turn, role, text, c, r): the messages of both sides, and which side holds them."""
    side = lambda rows, name: plain(rows, "pair_id").select("*", F.lit(name == "c").alias("c"), F.lit(name == "r").alias("r"))
    return side(chosen, "c").unionAll(side(rejected, "r"))


def parted(messages: DataFrame) -> DataFrame:
    """The messages with the `part` of the pair they stand in, twice if both completions hold them, and the pair's `sides`.  One
    that a side repeats in a turn may be there more than once."""
    told = messages.select("pair_id", "turn", row_key("role", "text").alias("key"), "c", "r").groupBy("pair_id", "turn", "key").agg(F.max("c").alias("c"), F.max("r").alias("r"))
    apart = F.min(F.when(~(F.col("c") & F.col("r")), F.col("turn"))).alias("split")
    pairs = told.groupBy("pair_id").agg(apart, F.max("c").alias("any_c"), F.max("r").alias("any_r"))
    sides = F.when(F.col("any_c") & F.col("any_r"), "both").when(F.col("any_c"), "chosen").otherwise("rejected")
    pairs = bounded(written(pairs.select("pair_id", "split", sides.alias("sides")), "pairs"))
    shared = F.col("split").isNull() | (F.col("turn") < F.col("split"))
    parts = F.when(shared, F.array(F.lit("prompt"))).otherwise(F.filter(F.array(F.when(F.col("c"), F.lit("chosen")), F.when(F.col("r"), F.lit("rejected"))), lambda x: x.isNotNull()))
    return messages.join(pairs, "pair_id").select("pair_id", "sides", "turn", "role", "text", F.explode(parts).alias("part"))


def trained() -> Column:
    return (F.col("part") != "prompt") & (F.col("role") == "assistant")


def formatted(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """(pair_id, part, place, turn, role, rendered, trained), a row for each message, from two tables (pair_id, turn, role, text)."""
    rows = parted(messages_of(chosen, rejected)).drop("sides").distinct()
    turn = F.when(F.col("turn") != FIRST, F.col("turn")).alias("turn")
    return rows.select("pair_id", "part", turn, "role", rendered(F.col("role"), F.col("text")).alias("rendered"), trained().alias("trained"), F.struct("turn", "role", "text").alias("place"))


def of_part(part: str) -> Callable[[Column], Column]:
    return lambda m: m["part"] == part


def records(messages: DataFrame) -> DataFrame:
    """(pair_id, piece, sides, prompt, chosen, chosen_mask, rejected, rejected_mask) from `messages_of` or `in_pairs`.

    A mask lists the spans (start, end) of its text, in code points, end exclusive, that are trained."""
    block = F.when(F.col("turn") != FIRST, F.floor(F.col("turn") / BLOCK)).alias("piece")
    rows = parted(messages).select("pair_id", "sides", block, F.struct("turn", "role", "text", "part").alias("m"))
    held = rows.groupBy("pair_id", "sides", "piece").agg(F.array_sort(F.collect_set("m")).alias("ms"))
    texts, masks = {}, {}
    for part in PARTS:
        own = F.filter("ms", of_part(part))
        told = F.transform(own, lambda m: F.struct(rendered(m["role"], m["text"]).alias("text"), (m["role"] == "assistant").alias("trained")))
        texts[part] = F.array_join(F.transform(told, lambda m: m["text"]), "")

        def spans(ms: Column) -> Column:
            starts = before(F.transform(ms, lambda m: F.length(m["text"])), F.lit(0), lambda a, b: a + b)
            every = F.zip_with(ms, starts, lambda m, at: F.struct(m["trained"].alias("trained"), at.alias("start"), (at + F.length(m["text"])).alias("end")))
            return F.transform(F.filter(every, lambda m: m["trained"]), lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end")))

        masks[part] = let(told, spans)
    return held.select("pair_id", "piece", "sides", texts["prompt"].alias("prompt"), texts["chosen"].alias("chosen"), masks["chosen"].alias("chosen_mask"),
                       texts["rejected"].alias("rejected"), masks["rejected"].alias("rejected_mask"))


def in_pairs(conversations: DataFrame) -> DataFrame:
    """Pairs from plain conversations, which hold no preferences: each conversation is chosen as it is; its rejected side
    has the messages of its last assistant turn replaced by those of its partner's (2 k and 2 k + 1 are partners).  A
    conversation without an assistant turn, or whose partner is missing or has none, is a pair with a chosen side only.

    Returns (pair_id, turn, role, text, c, r), what both sides hold once."""
    rows = plain(conversations, "conv_id")
    ends = rows.groupBy("conv_id").agg(F.max(F.when(F.col("role") == "assistant", F.col("turn"))).alias("last"))
    partner = F.col("conv_id").bitwiseXOR(F.lit(1))
    others = ends.where("last is not null").select(partner.alias("conv_id"), F.col("last").alias("other"))
    mine = bounded(written(ends.join(others, "conv_id", "left"), "ends"))
    two = F.col("last").isNotNull() & F.col("other").isNotNull()
    replaced = two & (F.col("turn") == F.col("last"))
    own = F.struct(F.col("conv_id").alias("pair_id"), F.col("turn").alias("turn"), F.lit(True).alias("c"), (two & ~replaced).alias("r"))
    # The last assistant turn of a conversation stands at its partner's.
    given = F.struct(partner.alias("pair_id"), F.col("other").alias("turn"), F.lit(False).alias("c"), F.lit(True).alias("r"))
    places = F.explode(F.when(replaced, F.array(own, given)).otherwise(F.array(own))).alias("at")
    return rows.join(mine, "conv_id").select(places, "role", "text").select("at.pair_id", "at.turn", "role", "text", F.coalesce("at.c", F.lit(False)).alias("c"), F.coalesce("at.r", F.lit(False)).alias("r"))


def pairs_of(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """`in_pairs` as two tables (pair_id, turn, role, text)."""
    rows = in_pairs(conversations).withColumn("turn", F.when(F.col("turn") != FIRST, F.col("turn")))
    return rows.where("c").drop("c", "r"), rows.where("r").drop("c", "r")
