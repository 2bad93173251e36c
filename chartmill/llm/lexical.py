"""Ranked lexical search by inner products, with vectors in buckets of similar length.

A document is the vector of its terms' impacts, an item that of its terms' numbers; a score is their inner product, so the
search is one for the largest inner products.  Vectors are ordered by length and cut into buckets.  Two bounds decide what
is scored, both against the k-th best score that an item has so far:

* Cauchy-Schwarz: no vector of a bucket scores more than the item's length times that of the bucket's longest vector;
* coordinates: in a bucket a term adds at most its largest impact there.  Terms by this bound, largest first, are walked
  through until those left over cannot reach the k-th score alone; a vector with none of the terms walked through is not
  looked at, and one that has some is kept only if its sum so far, plus the least of what the terms left over can add and
  of what Cauchy-Schwarz allows the rest of both vectors, reaches the k-th score.

What is left is scored again in integers.  Bounds are in doubles and are widened by 10^-9, far above their error, so the
result is exact: a vector is only dropped where its bound is below the score of k others.

Items are searched in blocks of bounded size.  A block's terms are the coordinates (other terms score nothing with it), and
its items, terms and weights go to all tasks.  The k-th scores that the longest vectors give are known before the search
over all; each task raises them as it goes and returns k documents an item, so what is ranked at the end does not grow with the table's rows but with its tasks.

Terms, weights and scores are as `weights` and `impacts` say.  Null texts have no terms; a document or item without terms
has no result.  Repeated documents are ranked each, repeated items searched each.  Equal scores go by doc_id, null last.
Other columns are ignored.  Empty tables give no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chartmill.llm.shared import in_arrow, written

#: Entries (item, term) of a block of items; an item that has more is a block of its own.
BLOCK = 200_000
#: Vectors in a bucket, and how many of the longest ones are searched first.
BUCKET, OPENING = 4096, 20_000
SLACK = 1e-9

# A-Z as a-z; of the other characters below 128 only digits and letters belong to terms.
_PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_PLAIN).split()


def item_terms(items: DataFrame) -> DataFrame:
    """(nr, term, q) of rows (nr, text): how often each item has a term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nrs, terms, counts = [], [], []
            for nr, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for term, q in Counter(terms_of(text.as_py())).items():
                    nrs.append(nr)
                    terms.append(term)
                    counts.append(q)
            yield pa.RecordBatch.from_arrays([pa.array(nrs, pa.int64()), pa.array(terms, pa.binary()), pa.array(counts, pa.int64())], names=["nr", "term", "q"])

    return in_arrow(items.select("nr", F.col("text").cast("string")), run, "nr long, term binary, q long")


def counted(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, tfs): a document's number of terms, and which of the vocabulary it has how often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, ends, terms, tfs = [], [0], [], []
            for text in batch.column(1):
                found = terms_of(text.as_py())
                n.append(len(found))
                for term, tf in Counter(found).items():
                    at = vocabulary.get(term)
                    if at is not None:
                        terms.append(at)
                        tfs.append(tf)
                ends.append(len(terms))
            ends = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.ListArray.from_arrays(ends, pa.array(terms, pa.int32())), pa.ListArray.from_arrays(ends, pa.array(tfs, pa.int64()))],
                names=["doc_id", "n", "terms", "tfs"])

    return in_arrow(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, "doc_id long, n long, terms array<int>, tfs array<long>")


def weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    """floor(1000 ln((2 N + 2) / (2 df + 1))) for each term."""
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)


def impacts(tf: np.ndarray, weight: np.ndarray, n: int, n_docs: int, n_terms: int) -> np.ndarray:
    """w * ((10^9 tf) div (1000 tf + 12 m)) with m = 75 + (25 n N) div L."""
    m = 75 + 25 * n * n_docs // n_terms
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))


def vectors(counts: DataFrame, weight: np.ndarray, n_docs: int, n_terms: int) -> DataFrame:
    """(doc_id, norm, terms, impacts) in order of length, longest first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms, tfs = batch.column(2), batch.column(3)
            ends = terms.offsets.to_numpy()
            flat, tf = terms.values.to_numpy(), tfs.values.to_numpy()
            x = np.zeros(len(flat), np.int64)
            for row, n in enumerate(batch.column(1).to_pylist()):
                at = slice(ends[row], ends[row + 1])
                x[at] = impacts(tf[at], weight[flat[at]], n, n_docs, n_terms)
            squares = x.astype(float) ** 2
            # Each sum on its own, as differences of running sums are not exact.
            norm = np.array([math.sqrt(squares[a:b].sum()) for a, b in zip(ends, ends[1:], strict=False)])
            offsets, inside = pa.array(ends - ends[0], pa.int32()), slice(ends[0], ends[-1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(norm), pa.ListArray.from_arrays(offsets, pa.array(flat[inside], pa.int32())), pa.ListArray.from_arrays(offsets, pa.array(x[inside]))],
                names=["doc_id", "norm", "terms", "impacts"])

    rows = in_arrow(counts.where("size(terms) > 0").select("doc_id", "n", "terms", "tfs"), run, "doc_id long, norm double, terms array<int>, impacts array<long>")
    # Copies are equally long, so the order goes on by a hash, lest they all fall into one range.
    spread = F.xxhash64("doc_id", "terms", F.monotonically_increasing_id())
    rows = written(rows.where("norm > 0").withColumn("spread", spread), "impacts")
    return written(rows.repartitionByRange(F.desc("norm"), "spread").sortWithinPartitions(F.desc("norm"), "spread").drop("spread"), "vectors")


class Best:
    """The k best documents of each item so far."""

    def __init__(self, floors: np.ndarray, k: int):
        self.k, self.floors = k, floors.copy()
        none = np.zeros(0, np.int64)
        self.found = [(none, none, np.zeros(0, bool)) for _ in floors]

    def add(self, item: int, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        at_least = scores >= max(self.floors[item], 1)
        old = self.found[item]
        scores, ids, null = (np.concatenate([a, b[at_least]]) for a, b in zip(old, (scores, ids, null), strict=True))
        order = np.lexsort((ids, null, -scores))[: self.k]
        self.found[item] = scores[order], ids[order], null[order]
        if len(order) == self.k:
            self.floors[item] = max(self.floors[item], scores[order[-1]])


class Block:
    """Items as rows of a sparse matrix over the block's terms."""

    def __init__(self, rows: list):
        self.nrs = sorted({r["nr"] for r in rows})
        place = {nr: i for i, nr in enumerate(self.nrs)}
        self.vocabulary: dict[bytes, int] = {}
        held: list[list[tuple[int, int]]] = [[] for _ in self.nrs]
        for r in sorted(rows, key=lambda r: (r["nr"], bytes(r["term"]))):
            held[place[r["nr"]]].append((self.vocabulary.setdefault(bytes(r["term"]), len(self.vocabulary)), r["q"]))
        self.terms = [np.array([t for t, _ in h], np.int64) for h in held]
        self.q = [np.array([q for _, q in h], np.int64) for h in held]
        self.norms = np.array([math.sqrt(float((q.astype(float) ** 2).sum())) for q in self.q])


def search_bucket(block: Block, best: Best, ids: np.ndarray, null: np.ndarray, norms: np.ndarray, ends: np.ndarray, terms: np.ndarray, x: np.ndarray) -> None:
    """Searches one bucket, of vectors of similar length, for the items that it can serve."""
    wide = 1 + SLACK
    active = np.flatnonzero(block.norms * norms.max() * wide >= best.floors)
    if not len(active):
        return
    owner = np.repeat(np.arange(len(ids)), np.diff(ends))
    by_term = np.argsort(terms, kind="stable")
    sorted_terms, sorted_owner, sorted_x = terms[by_term], owner[by_term], x[by_term].astype(float)
    present, first = np.unique(sorted_terms, return_index=True)
    largest = np.zeros(len(block.vocabulary))
    largest[present] = np.maximum.reduceat(sorted_x, first)
    lo, hi = np.zeros(len(largest), np.int64), np.zeros(len(largest), np.int64)
    lo[present], hi[present] = first, np.append(first[1:], len(terms))
    dense = np.zeros(len(largest), np.int64)
    for item in active:
        t, q, floor = block.terms[item], block.q[item], max(best.floors[item], 1)
        most = q * largest[t]
        order = np.argsort(-most, kind="stable")
        t, q, most = t[order], q[order], most[order]
        rest = np.append(np.cumsum(most[::-1])[::-1], 0.0)
        if rest[0] * wide < floor:
            continue
        # Only a vector with one of the first `walk` terms can reach the floor.
        walk = int(np.argmax(rest * wide < floor))
        spans = [np.arange(lo[a], hi[a]) for a in t[:walk]]
        at = np.concatenate(spans)
        qs = np.repeat(q[:walk].astype(float), [len(s) for s in spans])
        sums = np.bincount(sorted_owner[at], qs * sorted_x[at], len(ids))
        seen = np.bincount(sorted_owner[at], sorted_x[at] ** 2, len(ids))
        left = math.sqrt(float((q[walk:].astype(float) ** 2).sum())) * np.sqrt(np.maximum(norms * norms * wide - seen, 0))
        kept = np.flatnonzero((sums > 0) & ((sums + np.minimum(rest[walk], left)) * wide >= floor))
        if not len(kept):
            continue
        dense[t] = q
        sizes = np.diff(ends)[kept]
        starts = np.cumsum(sizes) - sizes
        places = np.repeat(ends[kept] - starts, sizes) + np.arange(sizes.sum())
        scores = np.add.reduceat(dense[terms[places]] * x[places], starts)
        dense[t] = 0
        best.add(item, scores, ids[kept], null[kept])


def search(rows: DataFrame, block: Block, floors: np.ndarray, k: int) -> DataFrame:
    """(nr, doc_id, score): each task's k best documents for each item, but none below the item's floor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(floors, k)
        for batch in batches:
            ids, null = batch.column(0).fill_null(0).to_numpy(), batch.column(0).is_null().to_numpy(zero_copy_only=False)
            norms, ends = batch.column(1).to_numpy(), batch.column(2).offsets.to_numpy().astype(np.int64)
            terms, x = batch.column(2).values.to_numpy(), batch.column(3).values.to_numpy()
            for lo in range(0, len(ids), BUCKET):
                some = slice(lo, lo + BUCKET)
                own = ends[lo : lo + BUCKET + 1]
                inside = slice(own[0], own[-1])
                search_bucket(block, best, ids[some], null[some], norms[some], own - own[0], terms[inside], x[inside])
        for item, (scores, found, unnamed) in enumerate(best.found):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), block.nrs[item])), pa.array(found, mask=unnamed), pa.array(scores)], names=["nr", "doc_id", "score"])

    return in_arrow(rows.select("doc_id", "norm", "terms", "impacts"), run, "nr long, doc_id long, score long")


def floors_of(found: DataFrame, block: Block, k: int) -> np.ndarray:
    """The k-th best score of each item of the block among what was found, or 1."""
    ranked = found.withColumn("place", F.row_number().over(Window.partitionBy("nr").orderBy(F.desc("score")))).where(F.col("place") == k)
    known = {r["nr"]: r["score"] for r in ranked.select("nr", "score").collect()}
    return np.array([known.get(nr, 1) for nr in block.nrs], np.int64)


def ranked(docs: DataFrame, items: DataFrame, k: int = 20, block_entries: int = BLOCK) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's k best documents with a score above 0."""
    named = written(items.select("item_id", "text", F.monotonically_increasing_id().alias("nr")), "items")
    entries = written(item_terms(named), "item_terms")
    blocks = -(-entries.count() // block_entries)
    best = None
    for number in range(blocks):
        block = Block(entries.where(F.pmod(F.xxhash64("nr"), F.lit(blocks)) == number).collect())
        if not block.nrs:
            continue
        counts = written(counted(docs, block.vocabulary), "counts")
        n_docs, n_terms = counts.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
        if not n_docs:
            continue
        df = np.zeros(len(block.vocabulary), np.int64)
        for r in counts.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
            df[r["term"]] = r["count"]
        rows = vectors(counts, weights(n_docs, df), n_docs, n_terms)
        opening = rows.agg(F.percentile_approx("norm", max(0.0, 1 - OPENING / n_docs), 100_000)).first()[0]
        none = np.ones(len(block.nrs), np.int64)
        floors = none if opening is None else floors_of(search(rows.where(F.col("norm") >= opening).repartition(OPENING // BUCKET * 8), block, none, k), block, k)
        found = written(search(rows, block, floors, k), "found")
        best = found if best is None else best.unionAll(found)
    if best is None:
        best = docs.sparkSession.createDataFrame([], "nr long, doc_id long, score long")
    order = Window.partitionBy("nr").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    top = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return top.join(named.select("nr", "item_id"), "nr").select("item_id", "rank", "doc_id", "score")
