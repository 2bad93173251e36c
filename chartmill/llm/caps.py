"""Near-duplicate vectors by spherical-cap filters.

A filter is a direction; a vector passes it if their inner product is high, so that it lies in a cap around the direction.
Two vectors that are close pass many filters together.  Directions are a random product code: the (rotated) space is cut
into `blocks` blocks, each has `size` Gaussian codewords, and every combination of one codeword from each block is a
direction.  A vector is list-decoded to all directions it exceeds without trying them one by one: sums are extended block
by block and left as soon as the best rest cannot lift them over the threshold.

The number of filters and the threshold follow from the number of distinct vectors n (`cap_code`): a filter keeps about
`bucket` vectors, and a pair just at the asked cosine shares `shared` filters on average.  Directions with a codeword in
common are not independent, so the filters are those of `codes` codes, each with its own rotation; with 8 codes and 20
shared filters 0.03 to 0.2 % of the pairs just at cosine 0.9 were missed in trials, and none at 0.98.  Vectors are joined on filters, and every pair is verified in double precision.  A pair counts only
in the first filter that both pass, so it is seen once.  Exact copies are one vector there, with their number as weight.
Large filters are dealt into parts (`split_hot`).

Rows without vec_id, and vectors that are null, empty, zero or hold null or non-finite components link with nothing.
Vectors of different length do not link.  Repeated rows of one vec_id are one vector to others.  Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartmill.llm.shared import components, in_arrow, split_hot, written
from chartmill.llm.simhash import spanning

MAX_CODEWORDS = 512


def tail(z: float) -> float:
    return math.erfc(z / math.sqrt(2)) / 2


def cap_code(n: int, cosine: float, bucket: int, shared: float, codes: int) -> tuple[float, int, int]:
    """For n vectors: threshold (in standard deviations), codewords a block and blocks of each of `codes` codes."""
    keep = min(0.05, bucket / max(n, 1))
    lo, hi = 0.0, 12.0
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if tail(mid) > keep else (lo, mid)
    # Both pass: integrate over the first one's excess.
    steps = np.linspace(lo, lo + 8, 4001)
    density = np.exp(-steps * steps / 2) / math.sqrt(2 * math.pi)
    other = np.array([tail((lo - cosine * x) / math.sqrt(1 - cosine * cosine)) for x in steps])
    both = float(np.sum(density * other) * (steps[1] - steps[0]))
    wanted, blocks = shared / codes / both, 2
    while wanted ** (1 / blocks) > MAX_CODEWORDS:
        blocks += 1
    return lo, math.ceil(wanted ** (1 / blocks)), blocks


def decode(scores: list[np.ndarray], threshold: float) -> np.ndarray:
    """Numbers of all code directions whose sum of block scores reaches the threshold, in order."""
    rest = np.append(np.cumsum([s.max() for s in scores][::-1])[::-1], 0.0)
    sums, ids = np.zeros(1), np.zeros(1, np.int64)
    for i, s in enumerate(scores):
        best = np.flatnonzero(s >= threshold - sums.max() - rest[i + 1])
        sums = sums[:, None] + s[best][None, :]
        ids = ids[:, None] * len(s) + best[None, :]
        keep = sums >= threshold - rest[i + 1]
        sums, ids = sums[keep], ids[keep]
        if not len(sums):
            break
    return np.sort(ids)


def codewords(dim: int, size: int, blocks: int, seed: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each block the part of a random rotation that leads to it, and its codewords."""
    rng = np.random.default_rng([seed, dim, size, blocks])
    rotation = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
    return [(rotation[:, part], rng.standard_normal((len(part), size))) for part in np.array_split(np.arange(dim), blocks)]


def unit(v: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that very large and very small components neither overflow nor vanish."""
    v = v.astype(np.float64)
    v = v / np.abs(v).max(axis=-1, keepdims=True)
    return v / np.linalg.norm(v, axis=-1, keepdims=True)


def coded(vectors: DataFrame, threshold: float, size: int, blocks: int, codes: int, seed: int) -> DataFrame:
    """(rep, copies, dim, vector, passed): each distinct vector with the filters it passes, in order."""
    kind = np.float32 if vectors.schema["vector"].dataType.elementType == T.FloatType() else np.float64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[int, list] = {}
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                raw = [np.array(v, kind) for v in part.column("vector").to_pylist()]
                passed = []
                for v in raw:
                    dim = len(v)
                    if dim not in words:
                        words[dim] = [[turn @ book for turn, book in codewords(dim, size, min(blocks, dim), seed + c)] for c in range(codes)]
                    x = unit(v)
                    passed.append(np.concatenate([decode([x @ w for w in code], threshold) + c * size**blocks for c, code in enumerate(words[dim])]))
                yield pa.RecordBatch.from_arrays(
                    [part.column("rep"), part.column("copies"), pa.array([len(v) for v in raw], pa.int32()), pa.array([v.tobytes() for v in raw], pa.binary()), pa.array(passed, pa.list_(pa.int64()))],
                    names=["rep", "copies", "dim", "vector", "passed"],
                )

    return in_arrow(vectors.select("rep", "copies", "vector"), run, "rep long, copies long, dim int, vector binary, passed array<long>")


def first_shared(a: np.ndarray, b: np.ndarray, here: int) -> np.ndarray:
    """Whether `here` is the first filter that both lists of each row hold; lists are ascending and padded with -1."""
    earlier = np.zeros(len(a), bool)
    for k in range(a.shape[1]):
        own = a[:, k]
        open_ = np.flatnonzero(~earlier & (own >= 0) & (own < here))
        if len(open_):
            earlier[open_] = (b[open_] == own[open_, None]).any(axis=1)
    return ~earlier


def verified(dealt: DataFrame, cosine: float, kind: type) -> DataFrame:
    """(a, b, weight): from every part, for each vector the copies it links to there (b null), and links (weight null) that
    hold linked vectors together."""
    keys = ["dim", "filter", "part"]
    ordered = dealt.repartition(*keys).sortWithinPartitions(*keys, "rep")

    def part(rows: pa.Table) -> tuple[list, list, list]:
        reps, copies = rows.column("rep").to_numpy(), rows.column("copies").to_numpy()
        x = unit(np.frombuffer(b"".join(rows.column("vector").to_pylist()), kind).reshape(len(reps), -1))
        passed = rows.column("passed").combine_chunks()
        lengths = passed.value_lengths().to_numpy()
        lists = np.full((len(reps), lengths.max()), -1, np.int64)
        lists[np.arange(lists.shape[1]) < lengths[:, None]] = passed.flatten().to_numpy()
        here, name = rows.column("filter")[0].as_py(), rows.column("part")[0].as_py()
        chunks = sorted(set(name.split("-")))
        own = rows.column("own").to_numpy()
        weight, kept = np.zeros(len(reps), np.int64), []
        for lo in range(0, len(reps), 256):
            i, j = np.nonzero(x[lo : lo + 256] @ x.T >= cosine)
            i += lo
            # Two vectors of the same chunk meet in several parts; they count in that chunk's own.
            fits = (i < j) & ((len(chunks) == 1) | (own[i] != own[j]))
            i, j = i[fits], j[fits]
            for at in range(0, len(i), 1 << 13):
                a, b = i[at : at + (1 << 13)], j[at : at + (1 << 13)]
                new = first_shared(lists[a], lists[b], here)
                a, b = a[new], b[new]
                np.add.at(weight, a, copies[b])
                np.add.at(weight, b, copies[a])
                kept.append(np.stack([a, b], axis=1))
        pairs = np.concatenate(kept) if kept else np.zeros((0, 2), np.int64)
        low = spanning(len(reps), pairs)
        linked, tied = np.flatnonzero(weight), np.flatnonzero(low < np.arange(len(reps)))
        return ([*reps[linked], *reps[tied]], [*([None] * len(linked)), *reps[low[tied]]], [*weight[linked], *([None] * len(tied))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = [], None

        def done() -> pa.RecordBatch:
            a, b, w = part(pa.Table.from_batches(held).combine_chunks())
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (a, b, w)], names=["a", "b", "weight"])

        for batch in batches:
            names = list(zip(*(batch.column(k).to_pylist() for k in keys), strict=True))
            lo = 0
            for i, name in enumerate([*names, None]):
                if i == len(names) or (name != now):
                    if i > lo:
                        held.append(batch.slice(lo, i - lo))
                    if i < len(names):
                        if sum(b.num_rows for b in held) > 1:
                            yield done()
                        held, now, lo = [], name, i
        if sum(b.num_rows for b in held) > 1:
            yield done()

    return in_arrow(ordered.select(*keys, "rep", "copies", "vector", "passed", "own"), run, "a long, b long, weight long")


def near_duplicates(rows: DataFrame, cosine: float = 0.9, bucket: int = 256, shared: float = 20.0, codes: int = 8, limit: int = 2048, seed: int = 11) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    vector = F.col("embedding")
    if not isinstance(rows.schema["embedding"].dataType.elementType, T.FloatType):
        vector = vector.cast("array<double>")
    sound = F.coalesce((F.size(vector) > 0) & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(vector, lambda x: x != 0), F.lit(False))
    every = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(sound & F.col("vec_id").isNotNull(), vector).alias("vector"))
    usable = every.where("vector is not null").distinct()
    distinct = written(usable.groupBy("vector").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")), "vectors")
    threshold, size, blocks = cap_code(distinct.count(), cosine, bucket, shared, codes)
    vectors = written(coded(distinct, threshold, size, blocks, codes, seed), "coded")
    # Only numbers are dealt out; vectors join once it is known where they go.
    dealt = split_hot(vectors.select("dim", F.explode("passed").alias("filter"), "rep"), ["dim", "filter"], "rep", limit)
    kind = np.float32 if distinct.schema["vector"].dataType.elementType == T.FloatType() else np.float64
    found = written(verified(dealt.join(vectors.drop("dim"), "rep"), cosine, kind), "links")
    weights = found.where("weight is not null").groupBy(F.col("a").alias("rep")).agg(F.sum("weight").alias("weight"))
    groups = components(found.where("b is not null").select("a", "b")).withColumnRenamed("node", "rep")
    labels = written(distinct.join(weights, "rep", "left").join(groups, "rep", "left").select("vector", (F.col("copies") - 1 + F.coalesce("weight", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component_id")), "labels")
    alone = every.where("vector is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    linked = every.where("vector is not null").join(labels, "vector").select("vec_id", "n_links", "component_id")
    return linked.unionAll(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
