"""Benchmark decontamination with spaced seeds.

Words are lower-cased runs of letters and digits.  A spaced seed is a fixed mask over a few consecutive words; the words it
selects are hashed and those between are ignored, so that a substituted word does not hide a passage.  Hashes of benchmark
items and of all positions of all documents are joined.  Each hit aligns an item with a document; the whole item is then
compared with the words beside it, and the document counts as contaminated if

* at least `share` of the item's words are equal in place, or
* some stretch of the alignment scores `stretch` or more, an equal word counting 1 and a different one -4 (so that at least
  `share` = 4/5 of it are equal): a fragment of a longer item.

A mask is missed where substitutions hit each of its places.  For items of 5 to 8, 10 to 12, 15, 16 and 20 words as many
as a fifth of the words could hide all masks, so these have more of their own: at any length of 5 to 120 words, no fifth of
an item's words hides all.  Items of less than 5 words are looked up by all their words; as they are hard to tell from
chance, they are weak evidence: a report lists them apart, and a document that holds nothing else does not count as contaminated.  `min_words`
is the number of words from which an item is looked for in `overlaps` and strong in the others.  Null and empty texts hold nothing; repeated rows are judged alike, in the documents as in
the benchmark.  Items without id are looked for as well; together they are one item that is listed as null, before others.  Extra columns are ignored, or kept where documents are returned.  Empty tables are allowed on either side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartmill.llm.shared import bounded, row_key, written

#: Which words of a window are hashed.
MASKS = ((0, 1, 2, 3, 4), (0, 1, 3, 6, 7), (0, 2, 3, 5, 8))
SPAN = 9
#: Lengths at which MASKS can miss a fifth of the words, and what closes that gap, laid like MASKS.
THIN, MORE = (10, 11, 12, 15, 16, 20), (0, 1, 2, 4, 5)
#: Items of fewer words are weak evidence.
STRONG = 5
#: The seeds of the benchmark are broadcast only if they are no more than this.
SMALL = 500_000


def word_hashes(text: Column) -> Column:
    """The words of a text as hashes; an empty array if there are none."""
    clean = F.trim(F.regexp_replace(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"[^\p{L}\p{N}]+", " "))
    return F.when(clean == "", F.array().cast("array<bigint>")).otherwise(F.transform(F.split(clean, " "), lambda w: F.xxhash64(w)))


def seeds(rows: DataFrame, masks: dict[int, tuple[int, ...]], keep: list[str]) -> DataFrame:
    """Every position `pos` of rows with `words`, with the hash of each mask laid there; `keep` columns stay."""
    at = rows.where("size(words) > 0").withColumn("pos", F.explode(F.sequence(F.lit(0), F.size("words") - 1)))
    laid = [F.when(F.col("pos") + mask[-1] < F.size("words"), F.struct(F.lit(name).alias("mask"), F.xxhash64(*(F.get("words", F.col("pos") + o) for o in mask)).alias("seed"))) for name, mask in masks.items()]
    return at.withColumn("laid", F.explode(F.array(*laid))).where("laid is not null").select(*keep, "pos", "laid.mask", "laid.seed")


def own_masks(n: int) -> list[tuple[int, tuple[int, ...]]]:
    """(position, mask) that are laid on items of n words besides MASKS."""
    if n in THIN:
        return [(at, MORE) for at in range(n - MORE[-1])]
    if n < 5:
        return [(0, tuple(range(n)))]
    if n >= SPAN:
        return []
    # One word may differ, so each mask leaves out another part of the item.
    size = 1 if n == 5 else -(-n // 3)
    left = [[i for i in range(n) if i // size != part] for part in range(-(-n // size))]
    return [(places[0], tuple(i - places[0] for i in places)) for places in left]


def overlaps(docs: DataFrame, benchmark: DataFrame, share: float = 0.8, stretch: int = 13, min_words: int = 1, small: int = SMALL) -> DataFrame:
    """(key, doc_id, item_id, shift, matched, item_words, score) for every alignment that counts; `shift` is the word of
    the document at which the item's first word falls."""
    items = benchmark.select("item_id", word_hashes(F.col("text")).alias("words")).where(F.size("words") >= min_words).distinct()
    lengths = sorted(r[0] for r in items.where(F.size("words") <= THIN[-1]).select(F.size("words")).distinct().collect())
    own = {n: own_masks(n) for n in lengths}
    shapes = sorted({mask for laid in own.values() for _, mask in laid})
    masks = dict(enumerate(MASKS)) | {100 + i: mask for i, mask in enumerate(shapes)}
    wanted = seeds(items, masks, ["item_id", "words"])
    # The masks of a length only serve items of that length.
    serves = F.col("mask") < 100
    for n, laid in own.items():
        for shape in sorted({mask for _, mask in laid}):
            serves = serves | ((F.size("words") == n) & (F.col("mask") == 100 + shapes.index(shape)) & F.col("pos").isin([at for at, mask in laid if mask == shape]))
    wanted = wanted.where(serves)
    wanted = wanted.select("mask", "seed", "item_id", F.col("pos").alias("item_pos"), F.size("words").alias("item_words")).distinct()
    few = wanted.limit(small + 1).count() <= small
    rows = docs.select(row_key("doc_id", "text").alias("key"), "doc_id", word_hashes(F.col("text")).alias("words"))
    shift, lead = F.col("pos") - F.col("item_pos"), F.greatest(F.lit(0), -F.col("shift"))
    beside = F.slice("words", F.col("shift") + lead + 1, F.greatest(F.lit(0), F.col("item_words") - lead))
    at = ["key", "doc_id", "item_id", "item_words", "shift"]
    if few:
        # Documents stay where they are, so the words beside an item are at hand; they are kept once for each alignment.
        hits = seeds(rows, masks, ["key", "doc_id", "words"]).join(F.broadcast(wanted), ["mask", "seed"]).withColumn("shift", shift)
        aligned = hits.select(*at, lead.alias("lead"), beside.alias("beside")).groupBy(*at, "lead").agg(F.any_value("beside").alias("beside"))
    else:
        # Only hashes and positions are shuffled; the words of the documents that were hit join once alignments are known.
        hits = seeds(rows, masks, ["key", "doc_id"]).join(wanted, ["mask", "seed"]).withColumn("shift", shift)
        met = written(hits.select(*at).distinct(), "alignments")
        hit = rows.join(met.select("key").distinct(), "key", "left_semi").select("key", "words").dropDuplicates(["key"])
        aligned = met.join(hit, "key").select(*at, lead.alias("lead"), beside.alias("beside"))
    # Two items may share an id: the words' number tells which one a hit came from, and all that fit are compared.
    whole = items.select(F.col("item_id").alias("whole_id"), F.col("words").alias("item"), F.size("words").alias("whole_words"))
    pairs = aligned.join(whole, F.col("item_id").eqNullSafe(F.col("whole_id")) & (F.col("item_words") == F.col("whole_words")))
    equal = F.zip_with("beside", F.slice("item", F.col("lead") + 1, F.size("beside")), lambda a, b: F.when(a == b, 1).otherwise(0))
    pairs = pairs.withColumn("equal", equal)
    walked = F.aggregate(
        "equal", F.struct(F.lit(0).alias("best"), F.lit(0).alias("now")),
        lambda acc, e: F.struct(
            F.greatest(acc["best"], acc["now"] + F.when(e == 1, 1).otherwise(-4)).alias("best"),
            F.greatest(F.lit(0), acc["now"] + F.when(e == 1, 1).otherwise(-4)).alias("now"),
        ),
        lambda acc: acc["best"],
    )
    pairs = pairs.withColumns({"matched": F.aggregate("equal", F.lit(0), lambda s, e: s + e), "score": walked})
    enough = (F.col("matched") >= F.lit(share) * F.col("item_words")) | (F.col("score") >= stretch)
    return pairs.where(enough).select("key", "doc_id", "item_id", "shift", "matched", "item_words", "score")


def report(docs: DataFrame, benchmark: DataFrame, min_words: int = STRONG, **settings) -> DataFrame:
    """One row per document: doc_id, contaminated, how many items it holds, the items in order, the most words of one
    item found equal; and the short items that it holds, which are weak evidence."""
    found = overlaps(docs, benchmark, **settings)
    per_item = found.groupBy("key", "item_id").agg(F.max("matched").alias("matched"), F.max("item_words").alias("words"))
    strong = F.col("words") >= min_words
    # The lists are bounded by the benchmark.
    listed = lambda which: F.array_join(F.transform(F.sort_array(F.collect_set(F.when(which, F.struct("item_id")))), lambda i: F.coalesce(i["item_id"].cast("string"), F.lit("null"))), ",")
    per_doc = per_item.groupBy("key").agg(F.count_if(strong).alias("n_items"), listed(strong).alias("items"), F.max(F.when(strong, F.col("matched"))).alias("matched"), listed(~strong).alias("weak_items"))
    rows = docs.select(row_key("doc_id", "text").alias("key"), "doc_id").join(per_doc, "key", "left")
    none = F.lit("")
    return rows.select("doc_id", F.coalesce(F.col("n_items") > 0, F.lit(False)).alias("contaminated"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"), F.coalesce("items", none).alias("items"),
                       F.coalesce("matched", F.lit(0)).cast("long").alias("matched"), F.coalesce("weak_items", none).alias("weak_items"))


def clean(docs: DataFrame, benchmark: DataFrame, min_words: int = STRONG, **settings) -> DataFrame:
    """The documents that hold no benchmark passage, as they are; those that only hold items of less than `min_words` words stay."""
    # The documents are only shuffled if there are very many.
    found = bounded(written(overlaps(docs, benchmark, min_words=min_words, **settings).select("key").distinct(), "contaminated"))
    return docs.select(F.struct("*").alias("doc"), row_key("doc_id", "text").alias("key")).join(found, "key", "left_anti").select("doc.*")
