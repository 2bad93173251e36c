"""Mixing sources to target weights.

The words of each source, document after document in hashed order, are packed into blocks of `block` words.  The output
is a number of slots, dealt into shards.  In each shard the slots' sources are a multinomial draw: every slot takes a source by a hashed
uniform number and the cumulative shares.  Over all shards a source then has some more or fewer slots than its share asks for; what it
has too many is taken back evenly over its shards, and the freed slots are given to the sources that lack some, so that totals are
within one slot of the shares.  The draws of a source, counted through all shards, pass through a pseudorandom permutation
of the source's block indices, another one for each pass over the source, and slots and blocks are joined by that index.

Sources are numbered by code point, null last, and weigh 1, 2, 3, repeating (`weights`).  They share as many words as there
are in all; no target exceeds `most` times its source's words, and the excess is shared anew by weight.  No block is taken
more than `most` times, so no document is either.

A null text has no words; null sources are one source.  Repeated rows are documents of their own.  Columns other than
doc_id, source and text are ignored.  An empty table gives an empty result.  Everything is drawn by hashes of `seed`, so a
rerun gives the same.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chartmill.llm.shared import WORD, let, row_key, words_of, written

CELLS = 4096
BUCKET_ROWS = 2048
#: Buckets of a source whose running sums are made together, and shards whose slots of a source are written out together.
CHUNK_BUCKETS, CHUNK_SHARDS = 2048, 256
#: Broadcast only if counted to be no more than this.
SMALL = 50_000
#: Walks of the permutation: more than enough for any number of blocks, see `permuted`.
WALKS = 32
#: Parts of an index and a hash add up within a long below this many blocks of a source.
MOST_BLOCKS = 1 << 60


def small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.limit(SMALL + 1).count() <= SMALL else df


def source_targets(sizes: DataFrame, weights: Sequence[int] = (1, 2, 3), most: int = 3) -> DataFrame:
    """(source, nr, source_size, target, docs) from rows (source, size).

    The sources are one row each here, and only these rows pass the windows over all."""
    found = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*(F.lit(int(w)) for w in weights))
    rows = found.withColumn("nr", F.row_number().over(by_name)).withColumn("w", F.get(cycle, F.pmod(F.col("nr") - 1, F.lit(len(weights)))).cast("double"))
    # In order of the level at which a source reaches its cap: the level if all before it are at theirs.
    rising = Window.orderBy(F.col("cap") / F.col("w"), "nr")
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    after = rising.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(after)
    rows = rows.withColumn("cap", F.col("source_size").cast("double") * most).withColumn("level", level)
    target = F.least("cap", F.max("level").over(everything) * F.col("w"))
    return rows.select("source", "nr", "source_size", target.alias("target"), "docs")


def sized(docs: DataFrame) -> DataFrame:
    """The documents as written rows without their texts: doc_id, source, number of words, and `key`, that of the columns used."""
    rows = docs.select("doc_id", F.col("source").cast("string").alias("source"), words_of(F.col("text").cast("string")).alias("size"), key())
    return written(rows.withColumn("row", F.monotonically_increasing_id()), "sized")


def key() -> Column:
    return row_key("doc_id", "source", "text").alias("key")


def running(rows: DataFrame, group: str, at: str, amount: str, chunk: int, alias: str) -> DataFrame:
    """Adds how much the rows of a group before `at` add up to, at being counted from 0.  In two steps, so that a
    group with very many rows is not one task: within chunks of `chunk` places, and over chunks."""
    placed = rows.withColumn("_chunk", F.floor(F.col(at) / chunk))
    over = Window.partitionBy(group).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = placed.groupBy(group, "_chunk").agg(F.sum(amount).alias("_sum"))
    starts = sums.select(F.col(group).alias("_group"), F.col("_chunk").alias("_of"), F.coalesce(F.sum("_sum").over(over), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(group, "_chunk").orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("_before", F.coalesce(F.sum(amount).over(inside), F.lit(0)))
    met = placed.join(starts, placed[group].eqNullSafe(starts["_group"]) & (placed["_chunk"] == starts["_of"]))
    return met.withColumn(alias, F.col("_start") + F.col("_before")).drop("_chunk", "_group", "_of", "_start", "_before")


def offsets(base: DataFrame, n_docs: int, seed: int) -> DataFrame:
    """Each row with `start`: how many words of its source come before it.

    Rows are dealt into buckets of bounded size by a hash; sums go inside buckets, and over buckets in two steps."""
    buckets = max(1, -(-n_docs // BUCKET_ROWS))
    dealt = base.withColumn("h", F.xxhash64("key.a", "key.b", F.lit(seed))).withColumn("bucket", F.pmod("h", F.lit(buckets)).cast("int"))
    sums = dealt.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    starts = running(sums, "source", "bucket", "words", CHUNK_BUCKETS, "bucket_start").select(F.col("source").alias("s"), F.col("bucket").alias("b"), "bucket_start")
    inside = Window.partitionBy("source", "bucket").orderBy("h", "doc_id", "row").rowsBetween(Window.unboundedPreceding, -1)
    own = dealt.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return own.join(starts, own["source"].eqNullSafe(starts["s"]) & (own["bucket"] == starts["b"])).withColumn("start", F.col("bucket_start") + F.col("before")).drop("s", "b", "h", "bucket", "before", "bucket_start")


def uniform(*columns: Column | str) -> Column:
    """A number of 53 hashed bits in [0, 1)."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 11).cast("double") / float(1 << 53)


def drawn_freely(targets: DataFrame, n_slots: int, shard_slots: int, seed: int) -> DataFrame:
    """(shard, nr, n): a multinomial draw for each shard."""
    order = Window.orderBy("nr")
    total = F.sum("share").over(Window.partitionBy())
    ends = targets.where("share > 0").withColumn("hi", F.sum("share").over(order) / total).withColumn("lo", F.coalesce(F.lag("hi").over(order), F.lit(0.0)))
    ends = ends.withColumn("hi", F.when(F.lead("nr").over(order).isNull(), F.lit(2.0)).otherwise(F.col("hi")))
    last = F.lit(CELLS - 1)
    cells = ends.select("nr", "lo", "hi", F.explode(F.sequence(F.least(F.floor(F.col("lo") * CELLS), last), F.least(F.floor(F.col("hi") * CELLS), last))).alias("cell"))
    slots = targets.sparkSession.range(n_slots).select(F.floor(F.col("id") / shard_slots).cast("long").alias("shard"), uniform("id", F.lit(seed), F.lit("slot")).alias("u"))
    slots = slots.withColumn("cell", F.least(F.floor(F.col("u") * CELLS), last))
    return slots.join(small(cells), "cell").where("u >= lo and u < hi").groupBy("shard", "nr").agg(F.count("*").alias("n"))


def asked(targets: DataFrame) -> DataFrame:
    """(nr, asked): the shares as whole numbers of slots, each within one of its share, with the sum of all."""
    up_to = F.sum("share").over(Window.orderBy("nr"))
    whole = targets.select("nr", F.floor(up_to + 0.5).cast("long").alias("up_to"))
    return whole.select("nr", (F.col("up_to") - F.coalesce(F.lag("up_to").over(Window.orderBy("nr")), F.lit(0))).alias("asked"))


def draws(targets: DataFrame, n_slots: int, shard_slots: int, seed: int) -> DataFrame:
    """(shard, nr, n): how many slots of each shard every source gets: a multinomial draw whose totals are put right."""
    free = written(drawn_freely(targets, n_slots, shard_slots, seed), "free")
    totals = free.groupBy("nr").agg(F.sum("n").alias("drawn"))
    odds = asked(targets).join(totals, "nr", "full").select("nr", F.coalesce("drawn", F.lit(0)).alias("drawn"), (F.coalesce("drawn", F.lit(0)) - F.coalesce("asked", F.lit(0))).alias("over"))
    before = Window.orderBy("nr").rowsBetween(Window.unboundedPreceding, -1)
    much, less = F.greatest("over", F.lit(0)), F.greatest(-F.col("over"), F.lit(0))
    odds = written(odds.withColumns({"freed_before": F.coalesce(F.sum(much).over(before), F.lit(0)), "lacking_before": F.coalesce(F.sum(less).over(before), F.lit(0))}), "odds")
    # A source that has too many gives back every so many-th of its slots, so its shards lose in proportion.
    rich = odds.where("over > 0").select(F.col("nr").alias("of"), "drawn", "over", "freed_before")
    counted = running(free, "nr", "shard", "n", CHUNK_SHARDS, "first").join(small(rich), F.col("nr") == F.col("of"), "left")
    back = lambda upto: F.expr(f"({upto}) * over div drawn")
    counted = counted.withColumns({"low": back("first"), "high": back("first + n")})
    kept = counted.select("shard", "nr", (F.col("n") - F.coalesce(F.col("high") - F.col("low"), F.lit(0))).alias("n"))
    freed = counted.where("high > low").select("shard", F.explode(F.sequence(F.col("freed_before") + F.col("low"), F.col("freed_before") + F.col("high") - 1)).alias("place"))
    # The freed slots, numbered through, are given to the sources that lack some, one after the other.
    poor = odds.where("over < 0").select("nr", F.col("lacking_before").alias("lo"), (F.col("lacking_before") - F.col("over")).alias("hi"))
    poor = poor.withColumn("cell", F.explode(F.sequence(F.expr(f"lo div {CELLS}"), F.expr(f"(hi - 1) div {CELLS}"))))
    given = freed.withColumn("cell", F.expr(f"place div {CELLS}")).join(small(poor), "cell").where("place >= lo and place < hi").groupBy("shard", "nr").agg(F.count("*").alias("n"))
    return kept.unionByName(given).groupBy("shard", "nr").agg(F.sum("n").alias("n")).where("n > 0")


def permuted(index: Column, n: Column, nr: Column, turn: Column, seed: int) -> Column:
    """A one-to-one map of 0 .. n-1: a Feistel network keyed by source, turn and seed, over the places of a table of a by b
    cells, a being the root of n rounded up and b as few as hold n; a place outside 0 .. n-1 walks on until it is inside.

    There are fewer than a places outside, so up to n = WALKS^2 every walk ends in time; beyond, a place lies outside with
    a chance below 1 / WALKS, and WALKS times in a row with one below 2^-160."""
    a = F.ceil(F.sqrt(n.cast("double"))).cast("long")
    b = F.ceil(n / a).cast("long")
    hashed = lambda x, round_: F.shiftrightunsigned(F.xxhash64(x, nr, turn, F.lit(seed), F.lit(round_)), 2)

    def network(x: Column) -> Column:
        halves = F.struct(F.floor(x / b).cast("long").alias("l"), F.pmod(x, b).alias("r"))
        for round_ in (0, 2):
            halves = let(halves, lambda h, k=round_: F.struct(F.pmod(h["l"] + hashed(h["r"], k), a).alias("l"), h["r"].alias("r")))
            halves = let(halves, lambda h, k=round_ + 1: F.struct(h["l"].alias("l"), F.pmod(h["r"] + hashed(h["l"], k), b).alias("r")))
        return let(halves, lambda h: h["l"] * b + h["r"])

    return F.aggregate(F.sequence(F.lit(1), F.lit(WALKS)), network(index), lambda x, _: F.when(x < n, x).otherwise(network(x)))


def slots_of(drawn: DataFrame, targets: DataFrame, most: int, seed: int) -> DataFrame:
    """(shard, slot, nr, turn, block): which block of its source each slot takes."""
    runs = running(drawn, "nr", "shard", "n", CHUNK_SHARDS, "first")
    every = runs.withColumn("k", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("n") - 1)))
    every = every.join(small(targets.select("nr", "blocks")), "nr").where(F.col("k") < F.col("blocks") * most)
    turn = F.floor(F.col("k") / F.col("blocks")).cast("long")
    # Slots of a shard stand in hashed order, so that sources alternate.
    slot = F.xxhash64("nr", "k", F.lit(seed))
    return every.withColumn("turn", turn).select("shard", slot.alias("slot"), "nr", "turn", permuted(F.pmod("k", "blocks"), F.col("blocks"), F.col("nr"), F.col("turn"), seed).alias("block"))


def plan(docs: DataFrame, block: int, shard_slots: int, seed: int, weights: Sequence[int], most: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The documents, the sources, the pieces of documents in blocks, and the slots with the blocks they take."""
    base = sized(docs)
    blocks = F.ceil(F.col("source_size") / block).cast("long")
    targets = written(source_targets(base, weights, most).withColumn("blocks", blocks).withColumn("share", F.when(F.col("source_size") > 0, F.col("target") * F.col("blocks") / F.col("source_size")).otherwise(0.0)), "targets")
    known = targets.agg(F.sum("docs"), F.sum("share"), F.max("blocks")).first()
    n_docs, n_slots = int(known[0] or 0), round(known[1] or 0)
    if (known[2] or 0) >= MOST_BLOCKS:
        raise ValueError(f"{known[2]} blocks in one source: use longer blocks")
    named = targets.select(F.col("source").alias("named"), "nr")
    placed = offsets(base, n_docs, seed).join(small(named), F.col("source").eqNullSafe(F.col("named"))).drop("named")
    first, last = F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block)
    pieces = placed.withColumn("block", F.explode_outer(F.when(F.col("size") > 0, F.sequence(first, last))))
    opens = F.greatest(F.col("start"), F.col("block") * block)
    closes = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block)
    pieces = pieces.withColumn("first_word", opens - F.col("start")).withColumn("n_words", F.coalesce(closes - opens, F.lit(0)))
    drawn = written(draws(targets, n_slots, shard_slots, seed), "draws")
    return base, targets, pieces, slots_of(drawn, targets, most, seed)


def taken(docs: DataFrame, block: int = 128, shard_slots: int = 1024, seed: int = 7, weights: Sequence[int] = (1, 2, 3), most: int = 3) -> DataFrame:
    """One row per document: doc_id, source, size, its source's size and target, and how many of its words the mix takes."""
    _, targets, pieces, slots = plan(docs, block, shard_slots, seed, weights, most)
    times = slots.groupBy("nr", "block").agg(F.count("*").alias("times"))
    met = pieces.select("row", "doc_id", "size", "nr", "block", "n_words").join(times, ["nr", "block"], "left")
    per = met.groupBy("row", "doc_id", "size", "nr").agg(F.sum(F.col("n_words") * F.coalesce("times", F.lit(0))).cast("long").alias("taken"))
    return per.join(small(targets.select("nr", "source", "source_size", "target")), "nr").select("doc_id", "source", "size", "source_size", "target", "taken")


def mixed_blocks(docs: DataFrame, block: int = 2048, shard_slots: int = 1024, seed: int = 7, weights: Sequence[int] = (1, 2, 3), most: int = 3) -> DataFrame:
    """The mixture itself: for each slot the pieces of documents in its block, in order of `piece`.  Words are joined by
    one space; a block is `block` words but for the last of a source."""
    base, _, pieces, slots = plan(docs, block, shard_slots, seed, weights, most)
    cut = pieces.where("n_words > 0").select("key", "nr", "block", F.col("start").alias("piece"), "first_word", "n_words")
    # A document's pieces are as many as its own length asks for; its text is shuffled once and taken apart once.
    cuts = written(slots.join(cut, ["nr", "block"]).groupBy("key").agg(F.collect_list(F.struct("shard", "slot", "turn", "block", "piece", "first_word", "n_words")).alias("cuts")), "cuts")
    texts = docs.select("doc_id", F.col("source").cast("string").alias("source"), F.col("text").cast("string").alias("text"), key())
    # The pieces of repeated rows are all listed under their one key.
    if base.groupBy("key").count().where("count > 1").limit(1).count():
        texts = texts.dropDuplicates(["key"])
    whole = texts.join(cuts, "key").withColumn("words", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    each = whole.select("doc_id", "source", "words", F.explode("cuts").alias("cut")).select("doc_id", "source", "words", "cut.*")
    text = F.array_join(F.slice("words", (F.col("first_word") + 1).cast("int"), F.col("n_words").cast("int")), " ")
    return each.select("shard", "slot", "source", "turn", "block", "piece", "doc_id", "first_word", "n_words", text.alias("text"))
