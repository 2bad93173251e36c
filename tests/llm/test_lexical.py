"""Lexical search against a plain ranking, on odd rows, in blocks and over many short buckets."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from chartmill.llm import lexical
from tests.llm.test_operators import ASCII_LOWER, odd_rows, table

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate(ASCII_LOWER))


def brute(rows, items, k=20):
    docs = [(i, Counter(terms(t))) for i, t, *_ in rows]
    docs = [(i, c) for i, c in docs if c]
    n, total = len(docs), sum(c.total() for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item_id, text in items:
        scored = []
        for i, c in docs:
            m = 75 + 25 * c.total() * n // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t in terms(text) if c[t])
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item_id, rank + 1, None if null else i, -s) for rank, (s, null, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def items_of(spark, items):
    return spark.createDataFrame([(i, t, 1, 2, "x") for i, t in items], "item_id long, text string, nr long, term int, score string")


@pytest.fixture(scope="module")
def items(rows_):
    rng = random.Random(7)
    cut = [" ".join(t.split()[3:40]) for _, t, *_ in rows_[:12] if t]
    return [*enumerate(cut), (50, None), (51, ""), (52, "?! --"), (53, "nothingofthekind"), (54, "THE old MILL, the old mill"), (54, "the sea"), (55, "Ünï𝔘code"), (55, "Ünï𝔘code"), (None, "one two"),
            (56, " ".join(rng.choice(" ".join(cut).split()) for _ in range(3000)))]


@pytest.fixture(scope="module")
def rows_():
    return odd_rows()


@pytest.mark.parametrize("entries", [200_000, 40])
def test_ranked(spark, rows_, items, entries):
    got = lexical.ranked(table(spark, rows_), items_of(spark, items), 20, entries)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows_, items)


def test_ties_and_copies(spark):
    rows = [(i, "the same words again" if i % 3 else "the other words", "en", "a") for i in range(300)]
    items = [(1, "same words"), (2, "other")]
    got = lexical.ranked(table(spark, rows).repartition(5), items_of(spark, items))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, items)


def test_empty(spark, rows_, items):
    none = table(spark, rows_).where("false")
    assert lexical.ranked(none, items_of(spark, items)).count() == 0
    assert lexical.ranked(table(spark, [(1, None, "a", "a"), (2, "!", "a", "a")]), items_of(spark, items)).count() == 0
    assert lexical.ranked(table(spark, rows_), items_of(spark, items).where("false")).count() == 0


def test_small_buckets_and_pruning(monkeypatch):
    """Buckets of a few vectors give the same as scoring all, and most vectors are never scored."""
    rng = np.random.default_rng(5)
    n, v = 3000, 60
    rows = [(int(i), {int(t): int(x) for t, x in zip(rng.choice(v, 8, replace=False), rng.integers(1, 1 << 34, 8) // (1 + i % 50), strict=True)}) for i in range(n)]
    rows.sort(key=lambda r: -sum(x * x for x in r[1].values()))
    queries = [{int(t): int(q) for t, q in zip(rng.choice(v, 5, replace=False), rng.integers(1, 4, 5), strict=True)} for _ in range(9)]
    block = lexical.Block([{"nr": i, "term": b"%d" % t, "q": c} for i, q in enumerate(queries) for t, c in q.items()])
    code = {t: block.vocabulary.get(b"%d" % t) for t in range(v)}
    scored = []
    add = lexical.Best.add
    monkeypatch.setattr(lexical.Best, "add", lambda self, item, scores, *rest: (scored.append(len(scores)), add(self, item, scores, *rest)))
    best = lexical.Best(np.ones(len(queries), np.int64), 20)
    for lo in range(0, n, 32):
        some = [(i, {code[t]: x for t, x in r.items() if code[t] is not None}) for i, r in rows[lo : lo + 32]]
        ends = np.cumsum([0, *(len(r) for _, r in some)])
        flat = [(t, x) for _, r in some for t, x in r.items()]
        norms = np.array([math.sqrt(sum(float(x) ** 2 for x in r.values())) for _, r in some])
        lexical.search_bucket(block, best, np.array([i for i, _ in some]), np.zeros(len(some), bool), norms, ends, np.array([t for t, _ in flat]), np.array([x for _, x in flat]))
    for item, q in enumerate(queries):
        want = sorted((-sum(c * r.get(t, 0) for t, c in q.items()), i) for i, r in rows)[:20]
        assert [(-s, i) for s, i in zip(best.found[item][0].tolist(), best.found[item][1].tolist(), strict=True)] == [w for w in want if w[0] < 0]
    assert sum(scored) < n * len(queries) / 4


def test_order_by_length(spark, rows_):
    counts = lexical.counted(table(spark, rows_), {t.encode(): i for i, t in enumerate(sorted({t for _, x, *_ in rows_ for t in terms(x)}))})
    got = lexical.vectors(counts.cache(), np.arange(1, 1 + 2000), 50, 5000)
    per_file = got.select(F.input_file_name().alias("f"), "norm", "terms", "impacts").collect()
    spans = {}
    for r in per_file:
        assert math.isclose(r["norm"], math.sqrt(sum(x * x for x in r["impacts"])))
        spans.setdefault(r["f"], []).append(r["norm"])
    assert all(s == sorted(s, reverse=True) for s in spans.values())
    edges = sorted((max(s), min(s)) for s in spans.values())
    assert all(a[0] <= b[1] for a, b in zip(edges, edges[1:], strict=False))
