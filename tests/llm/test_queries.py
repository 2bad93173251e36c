"""The registered queries against their SQL, and the pipeline against the stages' brute-force versions."""

import random

import duckdb
import pytest

import corpus_pipeline
from chartmill.llm.queries import QUERIES, SQL
from chartmill.llm.shared import written
from tests.llm.test_operators import brute_fingerprint, brute_overlap, fixed_spans

FOLDER = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{FOLDER}/{t}.parquet')")
    want = con.execute(SQL[name]).fetchdf()
    got = QUERIES[name](spark, FOLDER).toPandas()
    columns = sorted(want.columns)
    assert columns == sorted(got.columns)
    plain = lambda f: sorted(map(tuple, f[columns].astype(object).where(f[columns].notna(), None).astype(str).values.tolist()))
    assert plain(got) == plain(want)


def test_sql_of_secrets_finds_planted_keys(spark, tmp_path):
    """The given tables hold no random strings, so keys are planted: alone, glued, in dense classes, and among names."""
    rng = random.Random(12)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(120).select("doc_id", "text").collect()
    key = lambda symbols, n: "".join(rng.choice(symbols) for _ in range(n))
    mixed = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    names = ["getUserNameOfTheListData2path", "config_Value_from_stream_of_the_path", "theriverrunspasttheoldmill", "A1b" * 20, "some/path/to/a/File2/of/the/Year2024"]
    rows = []
    for n, r in enumerate(docs):
        extra = [key(mixed, rng.choice([24, 32, 40, 64])), "aws_secret_access_key=" + key(mixed + "+/", 40), "/var_lib/" + key(mixed[:52], 44), key("0123456789ABCDEF", 32), key(mixed[26:52], 30), rng.choice(names), "token: " + key(mixed, 30)]
        rows.append((r["doc_id"], f"{r['text']} {' '.join(rng.sample(extra, n % 5))} end"))
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = con.execute(SQL["op1_secret_scan"]).fetchdf()
    got = QUERIES["op1_secret_scan"](spark, str(tmp_path)).toPandas()
    columns = sorted(want.columns)
    assert sorted(map(tuple, got[columns].astype(str).values)) == sorted(map(tuple, want[columns].astype(str).values))
    assert got["n_random"].sum() > 100 and got["n_assign"].sum() > 10


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)
    steps = [docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        steps.append(written(stage(spark, steps[-1], FOLDER), name))
        assert steps[-1].columns == docs.columns
    ids = [{r["doc_id"] for r in s.select("doc_id").collect()} for s in steps]
    assert ids[1] == {i for i, t in texts.items() if any(c.isalpha() for c in t)}
    # One of each group of fingerprints at most two bits apart.
    prints = {i: brute_fingerprint(texts[i]) for i in ids[1]}
    first = {i: i for i in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            low = min(first[b] for b in prints if (prints[a] ^ prints[b]).bit_count() <= 2)
            if low < first[a]:
                first[a], changed = low, True
    assert ids[2] == {i for i in prints if first[i] == i}
    import re
    words = lambda t: re.sub(r"[\W_]+", " ", t.lower()).split()
    items = [words(r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    held = {i for i in ids[2] for item in items if set(item) & set(words(texts[i])) and any(best >= 0.8 * len(item) or score >= 13 for best, score in [brute_overlap(words(texts[i]), item)])}
    assert ids[3] == ids[2] - held and ids[4] == ids[3]
    for r in steps[4].collect():
        assert (r["text"] != texts[r["doc_id"]]) == bool(fixed_spans(texts[r["doc_id"]])) and not fixed_spans(r["text"]) and r["n_chars"] == len(r["text"])
    mixed = stages["mixing"](spark, steps[4], FOLDER).collect()
    run = corpus_pipeline.run(spark, FOLDER).collect()
    assert sorted(map(str, mixed)) == sorted(map(str, run))
    clean = {r["doc_id"]: r["text"].split() for r in steps[4].collect()}
    assert all(r["text"].split() == clean[r["doc_id"]][r["first_word"] : r["first_word"] + r["n_words"]] for r in mixed)
