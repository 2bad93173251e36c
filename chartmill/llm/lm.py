"""Scoring by an interpolated modified Kneser-Ney model of word pairs, or of triples with `order=3`.

Words are counted by Spark in two passes over the training texts, triples in a third one.  Tasks gather distinct keys and their counts in sorted
arrays before anything is shuffled; what is shuffled are blocks of such arrays, one for each bucket of keys, with the
differences of sorted keys compressed.  A bucket's task merges its blocks and writes sorted arrays of keys and values to
the shared folder.  Scoring tasks map these files into memory and look up the distinct words and pairs of some texts at a
time, in key order, so that a machine reads a page once, however large the model is.

* The vocabulary is an array of 64-bit word hashes; a word's number is its rank in it.
* A pair's key is the numbers of its words.  Pairs lie in the bucket of their first word, so that what follows a word is
  counted in one place.  Words so frequent that their pairs could outgrow a bucket have their pairs spread over all buckets
  by the second word.  These are some 8 words for each bucket (48 where all words have one letter), the same list for all tasks.
* Buckets follow the bytes of the training texts: their number and their size both grow with the square root, so that 100 TB
  make some 55,000 buckets.  A bucket has three files: words, their sides, pairs; and three more with triples.  A process maps at most `MAPPINGS` of them.
* A triple's key is its first pair's place in the pair's bucket and the number of the last word; it lies in that bucket, so that
  what follows a pair is counted where the pair is.  How many words precede a pair goes back to the pair's bucket as numbers.
* Counts of counts, of which discounts are made, are a few numbers from each bucket.

P(v|u) = max(c(uv) - D(c(uv)), 0) / c(u) + g(u) P(v), where g(u) is what the discounts of u's pairs free, and P(v) is made
likewise from the number of different words before v, and interpolated with 1 / (V + 1): one share for all unknown words.
With triples P(w|uv) is made from the counts of uvw and interpolated with P(w|v), and P(w|v) from how many different words precede
vw (for v the start state: from the count of vw, as nothing precedes it).  After an unseen pair P(w|v) holds.
A text begins in a start state and ends with an end token.  After an unknown word P(v) holds.

Null texts are empty: one end token.  Repeated rows are texts of their own.  Without training texts N and V are zero and
every token has the probability 1.  Extra columns are ignored.
"""

from __future__ import annotations

import math
import os
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartmill.llm.shared import in_arrow, make_dir, mounted, new_folder
from chartmill.llm.tokens import mixed, slices, word_hashes

START, END = np.uint64(0x5354415254), np.uint64(0x454E44)
BYTES = 4 << 20
GATHERED = 3 << 20
LOW = np.uint64(0xFFFFFFFF)
#: A bucket of this many bytes of text is one of as many buckets times this number, see `buckets_for`.
GRAIN = 32 << 10
#: Files that a process maps at a time; systems commonly allow it 65,530 mappings.
MAPPINGS = 4_096
#: The columns of the files of a bucket.
COLUMNS = {
    "words": {"hash": np.uint64, "seen": np.int64},
    "sides": {"before": np.uint32, "after1": np.uint32, "after2": np.uint32, "after3": np.uint32, "follow": np.int64},
    "pairs": {"key": np.uint64, "count": np.uint8, "large_key": np.uint64, "large": np.int64},
    "triples": {"key": np.uint64, "count": np.uint8, "large_key": np.uint64, "large": np.int64},
    "context": {"after1": np.uint32, "after2": np.uint32, "after3": np.uint32},
    "lower": {"before": np.uint32},
}
SIDES = tuple(COLUMNS["sides"])


def held_out(doc_id: Column) -> Column:
    """Texts with this property are not learnt from; a null id counts as an empty one."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 1


# ---- blocks of sorted keys with counts

def pack(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted keys and counts, byte planes of their differences compressed."""
    planes = np.diff(keys, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()
    return zstandard.compress(planes + counts.astype(np.uint64).view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def unpack(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(zstandard.decompress(block), np.uint8)
    steps, counts = (np.ascontiguousarray(half.reshape(8, -1).T).view(np.uint64).ravel() for half in np.split(raw, 2))
    return np.cumsum(steps, dtype=np.uint64), counts.astype(np.int64)


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts[order], first) if len(first) else counts


class Gathered:
    """Distinct keys with counts, given out block by block once there are many."""

    def __init__(self, bucket_of):
        self.bucket_of, self.parts, self.size = bucket_of, [], 0

    def add(self, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.parts.append(np.unique(keys, return_counts=True))
        self.size += len(self.parts[-1][0])
        if self.size > GATHERED:
            self.merge()
            if self.size > GATHERED // 2:
                yield from self.out()

    def merge(self) -> None:
        if self.parts:
            keys, counts = summed(np.concatenate([p[0] for p in self.parts]), np.concatenate([p[1] for p in self.parts]))
            self.parts, self.size = [(keys, counts)], len(keys)

    def out(self) -> Iterator[pa.RecordBatch]:
        self.merge()
        if self.size:
            keys, counts = self.parts[0]
            yield blocks(self.bucket_of(keys), keys, counts)
        self.parts, self.size = [], 0


class GatheredByBucket(Gathered):
    """The same for keys that name their bucket's own things, so that a key means something else in each bucket."""

    def __init__(self):
        super().__init__(None)

    def add(self, bucket: np.ndarray, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.parts.append(summed_by_bucket(bucket, keys, np.ones(len(keys), np.int64)))
        self.size += len(self.parts[-1][0])
        if self.size > GATHERED:
            self.merge()
            if self.size > GATHERED // 2:
                yield from self.out()

    def merge(self) -> None:
        if self.parts:
            self.parts = [summed_by_bucket(*(np.concatenate([p[k] for p in self.parts]) for k in range(3)))]
            self.size = len(self.parts[0][0])

    def out(self) -> Iterator[pa.RecordBatch]:
        self.merge()
        if self.size:
            yield blocks(*self.parts[0])
        self.parts, self.size = [], 0


def summed_by_bucket(bucket: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((keys, bucket))
    bucket, keys, counts = bucket[order], keys[order], counts[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (bucket[1:] != bucket[:-1])
    first = np.flatnonzero(new)
    return bucket[first], keys[first], np.add.reduceat(counts, first) if len(first) else counts


def blocks(bucket: np.ndarray, keys: np.ndarray, *values: np.ndarray) -> pa.RecordBatch:
    """A row for each bucket: its keys and values, packed."""
    order = np.argsort(bucket, kind="stable")
    bucket, keys, values = bucket[order], keys[order], [v[order] for v in values]
    cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
    ends = np.append(cuts[1:], len(bucket))
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket[cuts].astype(np.int64)), *(pa.array([pack(keys[a:b], v[a:b]) for a, b in zip(cuts, ends, strict=True)], pa.binary()) for v in values)],
        names=["bucket", *(f"block{i}" if i else "block" for i in range(len(values)))],
    )


def save(folder: str, kind: str, bucket: int, **columns: np.ndarray) -> None:
    """All columns in one file behind their lengths, the widest first so that each is aligned.  Written aside and renamed, so
    that a repeated or parallel attempt leaves one whole file."""
    aside = f"{folder}/.{kind}-{bucket}-{uuid.uuid4().hex}"
    kinds = COLUMNS[kind]
    with open(aside, "wb") as out:
        out.write(np.array([len(columns[name]) for name in kinds], np.int64).tobytes())
        for name in widest_first(kind):
            out.write(np.ascontiguousarray(columns[name], kinds[name]).data)
    os.replace(aside, f"{folder}/{kind}-{bucket}")


def widest_first(kind: str) -> list[str]:
    return sorted(COLUMNS[kind], key=lambda name: -np.dtype(COLUMNS[kind][name]).itemsize)


@lru_cache(maxsize=MAPPINGS)
def mapped(folder: str, kind: str, bucket: int) -> dict[str, np.ndarray]:
    """The columns of a file by name, all views of one mapping; it is closed when it leaves the cache and no view is in use."""
    raw = np.memmap(f"{folder}/{kind}-{bucket}", np.uint8, "r")
    kinds = COLUMNS[kind]
    at = 8 * len(kinds)
    lengths, out = dict(zip(kinds, raw[:at].view(np.int64).tolist(), strict=True)), {}
    for name in widest_first(kind):
        end = at + lengths[name] * np.dtype(kinds[name]).itemsize
        out[name], at = raw[at:end].view(kinds[name]), end
    return out


# ---- reading texts

def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of start, words and end of each text in a row, and where each text starts."""
    words, counts = word_hashes(texts)
    starts = np.cumsum(np.append(0, counts + 2))
    out = np.empty(starts[-1], np.uint64)
    inner = np.ones(len(out), bool)
    inner[starts[:-1]] = inner[starts[1:] - 1] = False
    out[inner] = words
    out[starts[:-1]], out[starts[1:] - 1] = START, END
    return out, starts


def read_texts(batch: pa.RecordBatch, column: int) -> Iterator[tuple[slice, list[bytes]]]:
    texts = [t.as_py() or b"" for t in batch.column(column).cast(pa.binary())]
    for part in slices(texts, BYTES):
        yield part, texts[part]


class Model:
    """The files of a model; any process that sees the shared folder can open it."""

    def __init__(self, folder: str, n_buckets: int, sizes: list[int], order: int):
        self.folder, self.n, self.order = folder, n_buckets, order
        self.offsets = np.cumsum([0, *sizes]).astype(np.int64)
        self.hot = np.zeros(0, np.uint64)
        # Buckets that hold pairs, and pairs that something follows; numbers of the start state and the end token.
        self.paired, self.followed = np.zeros(n_buckets, bool), np.zeros(n_buckets, bool)
        self.start = self.end = -1
        self.total = self.distinct = self.texts = 0
        self.triple_discounts = self.pair_discounts = self.word_discounts = (0.0, 0.0, 0.0)
        self.continuations, self.freed = 0, 0.0

    def column(self, kind: str, name: str, bucket: int) -> np.ndarray:
        return mapped(self.folder, kind, bucket)[name]

    def word_bucket(self, hashes: np.ndarray) -> np.ndarray:
        """Buckets follow the order of the hashes."""
        return ((hashes >> np.uint64(32)) * np.uint64(self.n) >> np.uint64(32)).astype(np.int64)

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """The rank of each of some ascending hashes in the vocabulary, -1 if it is not there."""
        out = np.full(len(hashes), -1, np.int64)
        for b, lo, hi in runs(self.word_bucket(hashes)):
            if self.offsets[b] == self.offsets[b + 1]:
                continue
            known = self.column("words", "hash", b)
            at = np.searchsorted(known, hashes[lo:hi])
            held = at < len(known)
            held[held] = known[at[held]] == hashes[lo:hi][held]
            out[lo:hi][held] = at[held] + self.offsets[b]
        return out

    def values(self, kind: str, name: str, numbers: np.ndarray) -> np.ndarray:
        """A column of the vocabulary for ascending numbers; 0 where the number is -1."""
        out = np.zeros(len(numbers), np.int64)
        known = np.flatnonzero(numbers >= 0)
        for b, lo, hi in runs(np.searchsorted(self.offsets, numbers[known], "right") - 1):
            out[known[lo:hi]] = self.column(kind, name, b)[numbers[known[lo:hi]] - self.offsets[b]]
        return out

    def pair_bucket(self, keys: np.ndarray) -> np.ndarray:
        first = keys >> np.uint64(32)
        bucket = np.searchsorted(self.offsets, first.astype(np.int64), "right") - 1
        if len(self.hot):
            at = np.minimum(np.searchsorted(self.hot, first), len(self.hot) - 1)
            spread = self.hot[at] == first
            bucket[spread] = (mixed(keys[spread] & LOW) % np.uint64(self.n)).astype(np.int64)
        return bucket

    def find(self, kind: str, bucket: np.ndarray, keys: np.ndarray, there: np.ndarray) -> np.ndarray:
        """The place of each key among those of its bucket, -1 if it is not there; `there` tells which buckets have a file.
        Keys that ascend within a bucket read its pages in order."""
        out = np.full(len(keys), -1, np.int64)
        order = np.argsort(bucket, kind="stable")
        for b, lo, hi in runs(bucket[order]):
            if there[b]:
                own = order[lo:hi]
                known = self.column(kind, "key", b)
                at = np.searchsorted(known, keys[own])
                held = at < len(known)
                held[held] = known[at[held]] == keys[own][held]
                out[own[held]] = at[held]
        return out

    def at(self, kind: str, name: str, bucket: np.ndarray, places: np.ndarray) -> np.ndarray:
        """A column's values at places of buckets, 0 where the place is -1."""
        out = np.zeros(len(places), np.int64)
        known = np.flatnonzero(places >= 0)
        known = known[np.argsort(bucket[known], kind="stable")]
        for b, lo, hi in runs(bucket[known]):
            out[known[lo:hi]] = self.column(kind, name, b)[places[known[lo:hi]]]
        return out

    def counts(self, kind: str, bucket: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Counts at places of buckets; those of 255 and more are looked up by key."""
        out = self.at(kind, "count", bucket, places)
        large = np.flatnonzero(out == 255)
        large = large[np.argsort(bucket[large], kind="stable")]
        for b, lo, hi in runs(bucket[large]):
            own = large[lo:hi]
            out[own] = self.column(kind, "large", b)[np.searchsorted(self.column(kind, "large_key", b), self.column(kind, "key", b)[places[own]])]
        return out


def save_counts(folder: str, kind: str, bucket: int, keys: np.ndarray, counts: np.ndarray) -> None:
    large = counts >= 255
    save(folder, kind, bucket, key=keys, count=np.minimum(counts, 255), large_key=keys[large], large=counts[large])


def runs(labels: np.ndarray) -> Iterator[tuple[int, int, int]]:
    if len(labels):
        cuts = np.flatnonzero(np.append(True, labels[1:] != labels[:-1]))
        for lo, hi in zip(cuts, np.append(cuts[1:], len(labels)), strict=True):
            yield int(labels[lo]), int(lo), int(hi)


def discounts(n: np.ndarray) -> tuple[float, float, float]:
    """Of counts 1, 2 and more, from how many keys occur once to four times; fixed ones where these say nothing."""
    if min(n) <= 0:
        return 0.5, 1.0, 1.5
    y = n[0] / (n[0] + 2 * n[1])
    raw = (1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2])
    return tuple(float(min(max(d, 0.0), k)) for k, d in enumerate(raw, 1))


def discounted(counts: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return counts - np.array([0.0, *d])[np.minimum(counts, 3)]


# ---- training

def buckets_for(size: int) -> int:
    """Number and size of buckets grow alike: 55 of 1.8 MB of text for 0.1 GB, 960 of 31 MB for 30 GB, 55,000 of 1.8 GB for 100 TB.
    A task that merges a bucket holds its distinct pairs, at most 16 bytes for each, in about three copies."""
    return max(8, math.isqrt(size // GRAIN))


def train(texts: DataFrame, order: int = 2, buckets: int | None = None) -> Model:
    """Counts (text) rows for a model of pairs (`order` 2) or triples (3); more `buckets` than `buckets_for` make smaller tasks
    and more files."""
    if order not in (2, 3):
        raise ValueError("order is 2 or 3")
    size = texts.agg(F.sum(F.octet_length(F.coalesce(F.col("text").cast("string"), F.lit(""))) + F.lit(1).cast("long"))).first()[0] or 0
    n = buckets or buckets_for(size)
    folder = make_dir(mounted(new_folder(texts.sparkSession, "model")))
    model = Model(folder, n, [0] * n, order)
    only = texts.select(F.col("text").cast("string").alias("text"))

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Gathered(model.word_bucket)
        for batch in batches:
            for _, part in read_texts(batch, 0):
                yield from found.add(tokens(part)[0])
        yield from found.out()

    def merge_words(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        keys, counts = merged(table.column("block"))
        # The start state is a context only; its number of texts is known from the end token.
        counts = np.where(keys == START, 0, counts)
        save(folder, "words", bucket, hash=keys, seen=counts)
        # Words with about an eighth of a bucket's share of all tokens, a token with its space taken as six bytes; and the start state.
        hot = np.flatnonzero((counts > size // (48 * n)) | (keys == START))
        ends = counts[keys == END]
        return pa.table({"bucket": [bucket], "size": [len(keys)], "distinct": [int((counts > 0).sum())], "total": [int(counts.sum())], "texts": [int(ends[0]) if len(ends) else 0], "marks": [[int(np.flatnonzero(keys == k)[0]) if (keys == k).any() else -1 for k in (START, END)]], "hot": pa.array([hot.tolist()], pa.list_(pa.int64()))})

    seen = in_arrow(only, count_words, "bucket long, block binary").groupBy("bucket").applyInArrow(merge_words, "bucket long, size long, distinct long, total long, texts long, marks array<long>, hot array<long>").collect()
    sizes = np.zeros(n, np.int64)
    for r in seen:
        sizes[r["bucket"]] = r["size"]
    model.offsets = np.append(0, np.cumsum(sizes))
    if model.offsets[-1] >= 1 << 32:
        raise ValueError("more than 2^32 different words: split the corpus")
    model.total, model.distinct, model.texts = (sum(r[k] for r in seen) for k in ("total", "distinct", "texts"))
    hot = [model.offsets[r["bucket"]] + i for r in seen for i in r["hot"]]
    model.hot = np.unique(np.array(hot, np.uint64))
    model.start, model.end = (max((int(model.offsets[r["bucket"]]) + r["marks"][k] for r in seen if r["marks"][k] >= 0), default=-1) for k in (0, 1))

    def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Gathered(model.pair_bucket)
        for batch in batches:
            for _, part in read_texts(batch, 0):
                run, starts = tokens(part)
                distinct, back = np.unique(run, return_inverse=True)
                numbers = model.numbers(distinct).astype(np.uint64)[back]
                keys = numbers[:-1] << np.uint64(32) | numbers[1:]
                keep = np.ones(len(keys), bool)
                keep[starts[1:-1] - 1] = False  # from one text's end to the next one's start
                yield from found.add(keys[keep])
        yield from found.out()

    def merge_pairs(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        keys, counts = merged(table.column("block"))
        save_counts(folder, "pairs", bucket, keys, counts)
        return side_rows(bucket, keys, counts, [0] * 4)

    def pairs_only(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        keys, counts = merged(table.column("block"))
        save_counts(folder, "pairs", bucket, keys, counts)
        return pa.table({"bucket": [bucket], "followed": [bool(((keys & LOW) != np.uint64(model.end)).any())]})

    def side_rows(bucket: int, keys: np.ndarray, counts: np.ndarray, of_triples: list[int]) -> pa.Table:
        """What each word adds: how many words precede it (0), how many follow it once (1), twice (2) or more (3), and all counts (4)."""
        first, second = keys >> np.uint64(32), keys & LOW
        sides = [np.unique(second, return_counts=True)] + [np.unique(first[c], return_counts=True) for c in (counts == 1, counts == 2, counts > 2)]
        cuts = np.flatnonzero(np.append(True, first[1:] != first[:-1]))
        sides.append((first[cuts], np.add.reduceat(counts, cuts)))
        column = np.concatenate([np.full(len(k), i, np.uint64) for i, (k, _) in enumerate(sides)])
        words, number = np.concatenate([k for k, _ in sides]), np.concatenate([c for _, c in sides])
        tagged = words << np.uint64(3) | column
        order = np.argsort(tagged)
        rows = blocks(np.searchsorted(model.offsets, words[order].astype(np.int64), "right") - 1, tagged[order], number[order])
        return noted(rows, [bucket, *(int((counts == k).sum()) for k in (1, 2, 3, 4)), *of_triples])

    def noted(rows: pa.RecordBatch, numbers: list[int]) -> pa.Table:
        """The first row carries numbers of the whole bucket."""
        out = pa.Table.from_batches([rows])
        return out.append_column("n", pa.array([numbers, *([None] * (len(out) - 1))], pa.list_(pa.int64())))

    def count_triples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = GatheredByBucket()
        for batch in batches:
            for _, part in read_texts(batch, 0):
                run, starts = tokens(part)
                distinct, back = np.unique(run, return_inverse=True)
                numbers = model.numbers(distinct).astype(np.uint64)[back]
                pairs, pair_back = np.unique(numbers[:-1] << np.uint64(32) | numbers[1:], return_inverse=True)
                inside = np.ones(len(pair_back), bool)
                inside[starts[1:-1] - 1] = False
                bucket = model.pair_bucket(pairs)
                place = model.find("pairs", bucket, pairs, model.paired)
                whole = np.flatnonzero(inside[:-1] & inside[1:])
                context = pair_back[whole]
                yield from found.add(bucket[context], place[context].astype(np.uint64) << np.uint64(32) | numbers[whole + 2])
        yield from found.out()

    def merge_triples(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        keys, counts = merged(table.column("block"))
        save_counts(folder, "triples", bucket, keys, counts)
        known = model.column("pairs", "key", bucket)
        place = (keys >> np.uint64(32)).astype(np.int64)
        after = (np.bincount(place[c], minlength=len(known)) for c in (counts == 1, counts == 2, counts > 2))
        save(folder, "context", bucket, **dict(zip(COLUMNS["context"], after, strict=True)))
        later, number = np.unique((known[place] & LOW) << np.uint64(32) | keys & LOW, return_counts=True)
        return noted(blocks(model.pair_bucket(later), later, number), [int((counts == k).sum()) for k in (1, 2, 3, 4)])

    def merge_lower(table: pa.Table) -> pa.Table:
        """Pairs by how many different words precede them."""
        bucket = table.column("bucket")[0].as_py()
        if not model.paired[bucket]:
            return pa.table({"bucket": pa.array([], pa.int64()), "block": pa.array([], pa.binary()), "n": pa.array([], pa.list_(pa.int64()))})
        keys = np.array(model.column("pairs", "key", bucket))
        lower = np.zeros(len(keys), np.int64)
        held = table.filter(pc.is_valid(table.column("block")))
        if len(held):
            later, number = merged(held.column("block"))
            lower[np.searchsorted(keys, later)] = number
        save(folder, "lower", bucket, before=lower)
        first = np.flatnonzero(keys >> np.uint64(32) == np.uint64(model.start))
        lower[first] = model.counts("pairs", np.full(len(first), bucket), first)
        lists = [x for x in held.column("n").to_pylist() if x]
        return side_rows(bucket, keys, lower, [sum(x[k] for x in lists) for k in range(4)])

    def merge_sides(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        tagged, number = merged(table.column("block"))
        columns = np.zeros((5, int(sizes[bucket])), np.int64)
        columns[(tagged & np.uint64(7)).astype(np.int64), (tagged >> np.uint64(3)).astype(np.int64) - model.offsets[bucket]] = number
        save(folder, "sides", bucket, **dict(zip(SIDES, columns, strict=True)))
        lists = [x for x in table.column("n").to_pylist() if x]
        return pa.table({"origin": pa.array([[x[0] for x in lists]], pa.list_(pa.int64())), "pairs": [[sum(x[k] for x in lists) for k in (1, 2, 3, 4)]], "triples": [[sum(x[k] for x in lists) for k in (5, 6, 7, 8)]], "words": [[int((columns[0] == k).sum()) for k in (1, 2, 3, 4)]], "types": [int((columns[0] > 0).sum())], "all": [int(columns[0].sum())]})

    if model.total:
        pairs = in_arrow(only, count_pairs, "bucket long, block binary").groupBy("bucket")
        rows = "bucket long, block binary, n array<long>"
        if order == 2:
            sides = pairs.applyInArrow(merge_pairs, rows)
        else:
            kept = pairs.applyInArrow(pairs_only, "bucket long, followed boolean").collect()
            model.paired[[r["bucket"] for r in kept]] = True
            model.followed[np.array([r["bucket"] for r in kept if r["followed"]], np.int64)] = True
            # Buckets of pairs that nothing precedes get no numbers back; a row without a block stands for each bucket.
            every = texts.sparkSession.range(n).select(F.col("id").alias("bucket"), F.lit(None).cast("binary").alias("block"), F.lit(None).cast("array<long>").alias("n"))
            triples = in_arrow(only, count_triples, "bucket long, block binary").groupBy("bucket").applyInArrow(merge_triples, rows)
            sides = triples.unionAll(every).groupBy("bucket").applyInArrow(merge_lower, rows)
        done = sides.groupBy("bucket").applyInArrow(merge_sides, "origin array<long>, pairs array<long>, triples array<long>, words array<long>, types long, all long").collect()
        model.paired[np.array([b for r in done for b in r["origin"]], np.int64)] = True
        model.triple_discounts, model.pair_discounts = (discounts(np.sum([r[k] for r in done], axis=0)) for k in ("triples", "pairs"))
        model.word_discounts = discounts(np.sum([r["words"] for r in done], axis=0))
        model.continuations = sum(r["all"] for r in done)
        once, twice = (sum(r["words"][k] for r in done) for k in (0, 1))
        model.freed = free(np.array([once, twice, sum(r["types"] for r in done) - once - twice]), model.word_discounts)
    return model


def merged(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    parts = [unpack(b.as_py()) for b in column]
    return summed(np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts]))


def free(n: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return n[0] * d[0] + n[1] * d[1] + n[2] * d[2]


# ---- scoring

def score(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity."""

    def texts_scored(texts: list[bytes]) -> list[np.ndarray]:
        run, starts = tokens(texts)
        distinct, back = np.unique(run, return_inverse=True)
        numbers = model.numbers(distinct) if model.total else np.full(len(distinct), -1)
        seen = model.values("words", "seen", numbers)
        n, v = model.total, model.distinct
        base = np.log10((seen + 0.5) / (n + 0.5 * (v + 1)))
        if model.total:
            # Words alone, by how many different words precede them.
            alone = discounted(model.values("sides", "before", numbers), model.word_discounts) / model.continuations + model.freed / model.continuations / (v + 1)
            follow = model.values("sides", "follow", numbers).astype(np.float64)
            freed = free(np.stack([model.values("sides", x, numbers) for x in SIDES[1:4]]), model.pair_discounts)
            with np.errstate(divide="ignore", invalid="ignore"):
                back_off = np.where(follow > 0, freed / follow, 1.0)
            keys = numbers[back[:-1]].astype(np.uint64) << np.uint64(32) | numbers[back[1:]].astype(np.uint64) & LOW
            real = (numbers[back[:-1]] >= 0) & (numbers[back[1:]] >= 0)
            real[starts[1:-1] - 1] = False
            pairs, pair_back = np.unique(keys[real], return_inverse=True)
            bucket = model.pair_bucket(pairs)
            place = model.find("pairs", bucket, pairs, model.paired)
            raw = model.counts("pairs", bucket, place)
            lower = raw
            if model.order == 3:
                lower = np.where(pairs >> np.uint64(32) == np.uint64(model.start), raw, model.at("lower", "before", bucket, place))
            p = alone[back].copy()
            p[1:] *= back_off[back[:-1]]
            p[1:][real] += discounted(lower, model.pair_discounts)[pair_back] / follow[back[:-1][real]]
            if model.order == 3:
                # Seen pairs that another token of the same text follows.
                of = np.full(len(keys), -1)
                of[real] = np.where(place >= 0, np.arange(len(pairs)), -1)[pair_back]
                inside = np.ones(len(keys), bool)
                inside[starts[1:-1] - 1] = False
                first = np.flatnonzero((of[:-1] >= 0) & inside[1:])
                first = first[np.lexsort((numbers[back[first + 2]], place[of[first]], bucket[of[first]]))]
                own, last = of[first], numbers[back[first + 2]]
                triples = place[own].astype(np.uint64) << np.uint64(32) | np.maximum(last, 0).astype(np.uint64)
                at = np.where(last >= 0, model.find("triples", bucket[own], triples, model.followed), -1)
                contexts = np.where(model.followed[bucket], place, -1)
                opened = free(np.stack([model.at("context", x, bucket, contexts) for x in COLUMNS["context"]]), model.triple_discounts)
                p[first + 2] = (discounted(model.counts("triples", bucket[own], at), model.triple_discounts) + opened[own] * p[first + 2]) / raw[own]
            logs = np.log10(p)
        else:
            logs = np.zeros(len(run))
        logs[starts[:-1]] = 0
        own = base[back]
        own[starts[:-1]] = 0
        known = (seen > 0)[back]
        known[starts[:-1]] = False
        return [np.diff(starts) - 1, np.add.reduceat(known.astype(np.int64), starts[:-1]), np.add.reduceat(own, starts[:-1]), np.add.reduceat(logs, starts[:-1])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in read_texts(batch, 2):
                n_tokens, known, base, logs = texts_scored(texts)
                own = batch.slice(part.start, part.stop - part.start)
                yield pa.RecordBatch.from_arrays(
                    [own.column(0), own.column(1), pa.array(n_tokens), pa.array(known), pa.array(np.full(len(texts), model.total)), pa.array(base), pa.array(logs), pa.array(10 ** (-logs / n_tokens))],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"],
                )

    rows = docs.select(F.col("doc_id").cast("long"), held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string").alias("text"))
    return in_arrow(rows, run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double")


def scores(docs: DataFrame, order: int = 2) -> DataFrame:
    """All texts scored by a model learnt from those that are not held out."""
    return score(docs, train(docs.where(~held_out(F.col("doc_id"))).select("text"), order))
