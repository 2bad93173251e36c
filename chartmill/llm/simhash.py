"""SimHash near-duplicates, found in a hierarchical index in Gray order.

A fingerprint belongs to three upper nodes, one for each third of its bits: a masked bit pattern that all members of the
node share.  Two fingerprints that differ in at most `distance` < 3 bits agree entirely in at least one third, so they meet
in an upper node.  Below it members are sorted by Gray rank, so that neighbours differ in few bits, and are cut into
groups; the bits that all members of a group share are factored out into its (mask, pattern), and so again for groups of
groups.  Two groups whose shared bits already differ in more than `distance` places are left with all that is below them.

Null and empty texts have the fingerprint zero and are linked like any other.  Repeated rows are ordinary rows.  Extra
columns are ignored.  A row without doc_id gets a fingerprint and the component of its group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartmill.llm.shared import bounded, components, in_arrow, row_key, split_hot, written

SLICE = 1 << 16
PARTS = 3
MASKS = tuple(np.uint64(sum(1 << b for b in range(lo, hi))) for lo, hi in ((0, 21), (21, 42), (42, 64)))


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """The 64-bit SimHash of a text's word shingles, repeats included; bit 0 is the lowest."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    grams = zip(*(words[i:] for i in range(shingle)), strict=False) if len(words) >= shingle else iter([tuple(words)])
    ones, total, digest = np.zeros(64, np.int64), 0, xxhash.xxh64_intdigest
    while True:
        part = np.fromiter((digest(b" ".join(g), seed) for _, g in zip(range(SLICE), grams, strict=False)), np.uint64)
        if not len(part):
            break
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        total += len(part)
        if len(part) < SLICE:
            break
    return int.from_bytes(np.packbits(2 * ones > total, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, key, fp): key is hashes of doc_id and text, fp holds the 64 bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(2)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found)], names=["doc_id", "key", "fp"])

    return in_arrow(docs.select(F.col("doc_id").cast("long"), row_key("doc_id", "text").alias("key"), F.col("text").cast("string")), run, "doc_id long, key struct<a:long,b:long>, fp long")


def gray_rank(fp: Column) -> Column:
    """The position of a bit pattern in Gray order, as a signed long that sorts like the unsigned one."""
    rank = fp
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, shift))
    return rank.bitwiseXOR(F.lit(-(1 << 63)))


def links_in(fps: np.ndarray, distance: int, leaf: int = 32, fan: int = 8) -> np.ndarray:
    """Pairs of positions, within one upper node in Gray order, whose fingerprints differ in at most `distance` bits."""
    levels, mask, pattern = [], np.full(len(fps), ~np.uint64(0)), fps
    size = leaf
    while True:
        levels.append((mask, pattern, size))
        if len(mask) == 1:
            break
        cuts = np.arange(0, len(mask), size)
        first = pattern[cuts]
        # Bits in which all members of a group agree, taken from what they share below.
        apart = np.bitwise_or.reduceat(pattern ^ np.repeat(first, np.diff(np.append(cuts, len(mask)))), cuts)
        mask = np.bitwise_and.reduceat(mask, cuts) & ~apart
        pattern, size = first & mask, fan
    pairs = np.zeros((1, 2), np.int64)
    for above in range(len(levels) - 1, 0, -1):
        mask, pattern, size = levels[above - 1][0], levels[above - 1][1], levels[above - 1][2]
        n, kept = len(mask), []
        for lo in range(0, len(pairs), max(1, SLICE // (size * size) * 4)):
            some = pairs[lo : lo + max(1, SLICE // (size * size) * 4)]
            a = (some[:, :1] * size + np.arange(size))[:, :, None]
            b = (some[:, 1:] * size + np.arange(size))[:, None, :]
            a, b = np.broadcast_arrays(a, b)
            fits = (a < n) & (b < n) & ((a <= b) if above > 1 else (a < b))
            a, b = a[fits], b[fits]
            near = np.bitwise_count((pattern[a] ^ pattern[b]) & mask[a] & mask[b]) <= distance
            kept.append(np.stack([a[near], b[near]], axis=1))
        pairs = np.concatenate(kept) if kept else np.zeros((0, 2), np.int64)
    return pairs if len(levels) > 1 else np.zeros((0, 2), np.int64)


def spanning(n: int, pairs: np.ndarray) -> np.ndarray:
    """For each of n positions the lowest one linked to it through pairs: links enough to hold each group together."""
    low = np.arange(n)
    while len(pairs):
        new = low.copy()
        np.minimum.at(new, pairs[:, 0], low[pairs[:, 1]])
        np.minimum.at(new, pairs[:, 1], low[pairs[:, 0]])
        new = new[new]
        if (new == low).all():
            break
        low = new
    return low


def index_links(distinct: DataFrame, distance: int = 2, limit: int = 2048) -> DataFrame:
    """Links (a, b) between distinct fingerprints `fp` that hold together all that differ in at most `distance` bits."""
    if not 0 <= distance < PARTS:
        raise ValueError("three masked patterns find fingerprints that differ in at most two bits")
    nodes = F.explode(F.array(*(F.struct(F.lit(i).alias("part_of"), F.col("fp").bitwiseAND(F.lit(int(m.view(np.int64)))).alias("pattern")) for i, m in enumerate(MASKS))))
    members = distinct.select("fp", nodes.alias("node")).select("fp", "node.part_of", "node.pattern")
    dealt = split_hot(members, ["part_of", "pattern"], "fp", limit)
    keys = ["part_of", "pattern", "part"]
    ordered = dealt.withColumn("rank", gray_rank(F.col("fp"))).repartition(*keys).sortWithinPartitions(*keys, "rank")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None

        def found(table: pa.Table) -> pa.RecordBatch:
            fps = table.column("fp").to_numpy().view(np.uint64)
            cut = np.flatnonzero(changes(table)) + 1
            edges = []
            starts, ends = np.append(0, cut), np.append(cut, len(fps))
            for lo, hi in zip(starts[ends - starts > 1], ends[ends - starts > 1], strict=True):
                own = fps[lo:hi]
                low = spanning(len(own), links_in(own, distance))
                at = np.flatnonzero(low < np.arange(len(own)))
                edges.append((own[low[at]], own[at]))
            a, b = (np.concatenate([e[i] for e in edges] or [np.zeros(0, np.uint64)]).view(np.int64) for i in (0, 1))
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table])
            cut = np.flatnonzero(changes(table))
            # The last group may go on in the next batch.
            whole = int(cut[-1]) + 1 if len(cut) else 0
            if whole:
                yield found(table.slice(0, whole).combine_chunks())
            rest = table.slice(whole)
        if rest is not None and rest.num_rows:
            yield found(rest.combine_chunks())

    def changes(table: pa.Table) -> np.ndarray:
        if table.num_rows < 2:
            return np.zeros(0, bool)
        out = np.zeros(table.num_rows - 1, bool)
        for k in keys:
            column = table.column(k).combine_chunks()
            codes = column.dictionary_encode().indices.to_numpy() if k == "part" else column.to_numpy()
            out |= codes[1:] != codes[:-1]
        return out

    return in_arrow(ordered.select(*keys, "fp"), run, "a long, b long")


def grouped(docs: DataFrame, shingle: int = 3, distance: int = 2) -> DataFrame:
    """Each document's doc_id, key, fp, component (a fingerprint that names its group) and component_id."""
    prints = written(fingerprints(docs, shingle), "prints")
    distinct = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct")
    linked = written(components(index_links(distinct, distance)), "groups")
    named = written(distinct.join(linked.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first_id", F.coalesce("component", "fp").alias("component")), "named")
    lowest = written(named.groupBy("component").agg(F.min("first_id").alias("component_id")), "lowest")
    labels = written(named.join(lowest, "component").select("fp", "component", "component_id"), "labels")
    return prints.join(labels, "fp")


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 2) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id: the smallest doc_id reachable by links."""
    return grouped(docs, shingle, distance).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def deduplicated(docs: DataFrame, shingle: int = 3, distance: int = 2) -> DataFrame:
    """One document of each group, as it is: the one with the smallest doc_id.  Of repeated rows one stays."""
    rows = written(grouped(docs, shingle, distance).select("doc_id", "key", "component"), "grouped")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "key"))["key"]
    chosen = written(rows.groupBy("component").agg(first.alias("key")).select("key"), "chosen")
    # The documents are only shuffled if there are very many.
    dropped = bounded(written(rows.select("key").join(chosen, "key", "left_anti").distinct(), "dropped"))
    kept = docs.select(F.struct("*").alias("doc"), row_key("doc_id", "text").alias("key")).join(dropped, "key", "left_anti")
    # A chosen row that stands in the table more than once.
    repeated = written(rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").join(chosen, "key", "left_semi").select("key"), "repeated")
    repeated = bounded(repeated)
    once = kept.join(repeated, "key", "left_anti")
    if repeated.limit(1).count():
        once = once.unionByName(kept.join(repeated, "key", "left_semi").dropDuplicates(["key"]))
    return once.select("doc.*")
