"""A filter of the keys of a small batch, so that a join reads much of a large table but moves little of it.

Each key sets a few bits of an array that is built by grouping and is a single value in the plan; rows of the large table whose bits are
not all set cannot have a key of the batch and go while they are scanned, before any shuffle.  A few others stay by
chance, so the join still decides.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartmill.operators.choose import pick_one
from chartmill.operators.lookups import anti_staged, semi_on

#: With 16 bits a key and 4 hashes, about one row in 400 stays by chance.
BITS_PER_KEY, HASHES = 16, 4
#: The filter of a larger batch would be over 8 MB in every task; such a batch is joined without one.
MOST_KEYS = 1 << 22
_WORD = 64


def _positions(keys: Sequence[str], bits: int) -> list[Column]:
    one, two = F.xxhash64(*keys), F.xxhash64(F.lit("second"), *keys)
    # Halved, so that no sum leaves a long.
    return [F.pmod(F.shiftright(one, 4) + i * F.shiftright(two, 4), F.lit(bits)) for i in range(HASHES)]


def key_bits(batch: DataFrame, keys: Sequence[str], bits: int) -> DataFrame:
    """One row with `words`: the bits of all keys of the batch, 64 in a number."""
    at = batch.select(F.explode(F.array(*_positions(keys, bits))).alias("at"))
    word = F.floor(F.col("at") / _WORD).alias("word")
    words = at.groupBy(word).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("at", F.lit(_WORD)).cast("int"))).alias("bits"))
    every = batch.sparkSession.range(-(-bits // _WORD)).select(F.col("id").alias("word"))
    filled = every.join(words, "word", "left").select("word", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))
    return filled.agg(F.transform(F.array_sort(F.collect_list(F.struct("word", "bits"))), lambda w: w["bits"]).alias("words"))


def may_be_in(df: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of `df` whose key may be one of the batch; no row whose key is one is lost.  The batch is read twice
    more, so it should be at hand: persisted or written."""
    n = batch.limit(MOST_KEYS + 1).count()
    if n > MOST_KEYS:
        return df
    bits = max(_WORD, n * BITS_PER_KEY)
    words = key_bits(batch.select(*keys), keys, bits).scalar()
    held = F.lit(True)
    for at in _positions(keys, bits):
        held = held & (F.getbit(F.get(words, F.floor(at / _WORD).cast("int")), F.pmod(at, F.lit(_WORD)).cast("int")) == 1)
    return df.where(held)


def new_rows_of_delta(df: DataFrame, staged: DataFrame, keys: Sequence[str], order: Sequence[str] = (), nullable: Sequence[str] = ()) -> DataFrame:
    """What `new_rows` gives, for a batch that is small beside what is staged: of the staged rows only those that may be
    in the batch are shuffled."""
    single = pick_one(df, keys, order)
    return anti_staged(single, may_be_in(staged.select(*keys), df, keys), keys, nullable)


def semi_on_delta(df: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of a large table that have a key of a small batch."""
    return semi_on(may_be_in(df, batch, keys), batch.select(*keys), {k: k for k in keys}, repeated=True)
