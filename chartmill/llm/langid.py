"""Language identification by fusing evidence.

For each page the posterior of a language is proportional to

    P(text | language) ^ temper * P(declared language | language) * P(language | host)

* The text's likelihood is that of its byte trigrams (letters lower-cased, everything else of ASCII as one space) under
  hashed trigram frequencies, learnt from a bounded sample of labelled documents: about `per_language` documents a
  language, drawn by the hash of doc_id.  The powers of overlapping trigrams are tempered.  One more class, `und`, gives all
  trigrams the same probability: what no language explains better than chance.
* How often a language is declared as which is counted over all pages, each page counting for its languages as its text
  alone would have it, so that a declaration counts for as much as declarations are worth.
* Host priors come from the same sums: a host's are smoothed by those of its address suffix, these by all pages'.

A row is accepted if the best class is a language.  Null and empty texts have no trigrams: `und`, rejected.  Unknown,
null and empty declarations and hosts are values of their own.  Repeated rows count each.  Extra columns are ignored, or
kept where documents are returned.  Without labelled documents every text is `und`.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartmill.llm.shared import bounded, in_arrow, row_key, written
from chartmill.llm.tokens import mixed, slices

LANGUAGES = ("de", "en", "es", "fr")
SLOTS = 1 << 14
BYTES = 2 << 20
SALTS = 32
_FOLD = np.full(256, 32, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)
MARKUP = re.compile(rb"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>")
#: `lang` of the first html tag.
DECLARED = r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]{2,8})"


def trigrams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The slot of every byte trigram of the texts, and where each text's begin; a text is set between spaces."""
    joined = b"".join(b" %s " % t if t else b"" for t in texts)
    ends = np.cumsum([len(t) + 2 if t else 0 for t in texts])
    a = _FOLD[np.frombuffer(joined, np.uint8)].astype(np.uint64)
    if len(a) < 3:
        return np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
    code = a[:-2] << np.uint64(16) | a[1:-1] << np.uint64(8) | a[2:]
    # Trigrams that reach into the next text, and those of spaces only, are left out.
    keep = code != 0x202020
    inner = ends[ends < len(a)]
    for back in (1, 2):
        keep[inner[inner >= back] - back] = False
    starts = np.append(0, np.cumsum(keep))[np.minimum(np.append(0, ends), len(code))]
    return (mixed(code[keep]) >> np.uint64(50)).astype(np.int64), starts


def learnt(docs: DataFrame, languages: Sequence[str], per_language: int) -> np.ndarray:
    """Log frequencies of the slots by class (languages, then `und`), from about `per_language` labelled documents each."""
    labelled = docs.where(F.col("lang").isin(*languages)).select("doc_id", F.col("lang"), F.col("text").cast("string").alias("text"))
    known = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    share = F.lit(0.0)
    for lang, n in known.items():
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, per_language / n))).otherwise(share)
    drawn = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) < share * (1 << 30)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(languages), SLOTS), np.int64)
        for batch in batches:
            texts = [t.as_py() or b"" for t in batch.column(1).cast(pa.binary())]
            langs = batch.column(0).to_pylist()
            for part in slices(texts, BYTES):
                found, starts = trigrams(texts[part])
                for i, lang in enumerate(langs[part]):
                    sums[languages.index(lang)] += np.bincount(found[starts[i] : starts[i + 1]], minlength=SLOTS)
        at = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at[0]), pa.array(at[1]), pa.array(sums[at])], names=["language", "slot", "n"])

    counted = in_arrow(labelled.where(drawn).select("lang", "text"), count, "language long, slot long, n long")
    # A row for each language and slot at most.
    table = counted.groupBy("language", "slot").agg(F.sum("n").alias("n")).toPandas()
    sums = np.zeros((len(languages), SLOTS))
    sums[table["language"], table["slot"]] = table["n"]
    logs = np.log((sums + 0.5) / (sums.sum(axis=1, keepdims=True) + 0.5 * SLOTS))
    logs[sums.sum(axis=1) == 0] = -np.inf
    return np.vstack([logs, np.full(SLOTS, -np.log(SLOTS))]).T.copy()


def likelihoods(rows: DataFrame, text: str, logs: np.ndarray, markup: bool, temper: float) -> DataFrame:
    """The rows without `text`, with `ll`: the tempered log likelihood of each class."""
    kept = [c for c in rows.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py() or b"" for t in batch.column(len(kept)).cast(pa.binary())]
            for part in slices(texts, BYTES):
                plain = [MARKUP.sub(b" ", t) for t in texts[part]] if markup else texts[part]
                found, starts = trigrams([b" ".join(t.split()) for t in plain])
                ll = np.zeros((len(plain), logs.shape[1]))
                full = np.flatnonzero(starts[1:] > starts[:-1])
                if len(full):
                    # Texts without trigrams take no place between those that have some.
                    ll[full] = np.add.reduceat(logs[found], starts[:-1][full], axis=0) * temper
                ll[np.setdiff1d(np.arange(len(plain)), full), :-1] = -1e9
                own = batch.slice(part.start, part.stop - part.start)
                yield pa.RecordBatch.from_arrays([*(own.column(i) for i in range(len(kept))), pa.array(list(np.maximum(ll, -1e9)), pa.list_(pa.float64()))], names=[*kept, "ll"])

    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in kept) + ", ll array<double>"
    return in_arrow(rows.select(*kept, F.col(text).cast("string")), run, schema)


def softmax(logs: Column) -> Column:
    top = F.transform(logs, lambda x: F.exp(x - F.array_max(logs)))
    return F.transform(top, lambda x: x / F.aggregate(top, F.lit(0.0), lambda s, y: s + y))


def sums(rows: DataFrame, keys: list[str], n: int) -> DataFrame:
    """The sum of the posteriors `q` in each group, class by class, as an array."""
    total = rows.groupBy(*keys).agg(*(F.sum(F.get("q", F.lit(i))).alias(f"q{i}") for i in range(n)))
    return total.select(*keys, F.array(*(f"q{i}" for i in range(n))).alias("sums"))


def smoothed(own: Column, above: Column, strength: float) -> Column:
    """Shares of a group's sums, drawn towards those of the group above as by `strength` pages."""
    size = F.aggregate(own, F.lit(0.0), lambda s, x: s + x)
    return F.zip_with(own, above, lambda x, p: (x + strength * p) / (size + strength))


def fused(rows: DataFrame, languages: Sequence[str], strength: float = 5.0) -> DataFrame:
    """Rows with key columns, `declared`, `host`, `suffix` and `ll`, with the evidence joined: lang, posterior, accepted."""
    n = len(languages) + 1
    none = F.lit("")
    known = F.when(F.col("declared").isin(*languages), F.col("declared")).otherwise(F.when(F.coalesce("declared", none) == "", none).otherwise(F.lit("other")))
    rows = written(rows.withColumns({"declared": known, "host": F.coalesce("host", none), "suffix": F.coalesce("suffix", none), "q": softmax(F.col("ll"))}), "likelihoods")
    # The declarations are as many as the languages and two.
    said = sums(rows, ["declared"], n).collect()
    uniform = np.full(n, 1.0 / n)
    table = {r["declared"]: np.array(r["sums"]) for r in said}
    total = sum(table.values(), np.zeros(n))
    given = {d: np.log((s + strength / (n + 1)) / (total + strength)) for d, s in table.items()}
    confusion = F.array(*(F.lit(0.0) for _ in range(n)))
    for d, values in given.items():
        confusion = F.when(F.col("declared") == d, F.array(*(F.lit(float(x)) for x in values))).otherwise(confusion)
    overall = (total + strength * uniform) / (total.sum() + strength)
    by_suffix = written(sums(rows, ["suffix"], n).select("suffix", smoothed(F.col("sums"), F.array(*(F.lit(float(x)) for x in overall)), strength).alias("above")), "suffixes")
    by_host = written(sums(rows, ["host", "suffix"], n), "hosts")
    by_host = by_host.join(by_suffix, "suffix").select("host", "suffix", smoothed(F.col("sums"), F.col("above"), strength).alias("prior"))
    # A host may have a third of all pages: its rows are dealt to several tasks, and its prior is sent to each.
    by_host = by_host.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    keyed = rows.withColumn("salt", F.pmod(F.xxhash64("ll", F.monotonically_increasing_id()), F.lit(SALTS)).cast("int"))
    joint = F.zip_with(F.zip_with("ll", confusion, lambda a, b: a + b), F.col("prior"), lambda a, b: a + F.log(b))
    out = keyed.join(by_host, ["host", "suffix", "salt"]).withColumn("post", softmax(joint))
    names = F.array(*(F.lit(x) for x in (*languages, "und")))
    best = F.array_position("post", F.array_max("post")).cast("int")
    text_best = F.array_position("ll", F.array_max("ll")).cast("int")
    out = out.withColumns({"lang_found": F.get(names, best - 1), "posterior": F.array_max("post"), "text_lang": F.get(names, text_best - 1)})
    # A row whose text says nothing stays `und`, whatever its host is.
    silent = F.get("ll", F.lit(0)) <= -1e8
    out = out.withColumn("lang_found", F.when(silent, F.lit("und")).otherwise(F.col("lang_found")))
    return out.withColumn("accepted", F.col("lang_found") != "und").drop("salt", "prior", "post", "q", "ll")


def identify(pages: DataFrame, docs: DataFrame, languages: Sequence[str] = LANGUAGES, per_language: int = 500, temper: float = 0.25) -> DataFrame:
    """One row per page: page_id, lang, posterior, text_lang, declared, host, accepted."""
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select("page_id", F.lower(F.regexp_extract(html, DECLARED, 1)).alias("declared"), host.alias("host"), F.substring_index(host, ".", -1).alias("suffix"), html.alias("html"))
    rows = likelihoods(rows, "html", learnt(docs, languages, per_language), True, temper)
    return fused(rows, languages).select("page_id", F.col("lang_found").alias("lang"), "posterior", "text_lang", "declared", "host", "accepted")


def accepted(docs: DataFrame, languages: Sequence[str] = LANGUAGES, per_language: int = 500, temper: float = 0.25) -> DataFrame:
    """The documents in a known language, as they are.  Their `lang` is the declaration, their `source` the host."""
    key = row_key("doc_id", "text", "lang", "source").alias("key")
    keyed = docs.select(key, F.lower(F.coalesce(F.col("lang").cast("string"), F.lit(""))).alias("declared"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("host"), F.lit("").alias("suffix"), "text")
    found = fused(likelihoods(keyed, "text", learnt(docs, languages, per_language), False, temper), languages)
    # Few are rejected, if any; the documents are only shuffled if there are very many.
    rejected = bounded(written(found.where("not accepted").select("key").distinct(), "rejected"))
    return docs.select(F.struct("*").alias("doc"), key).join(rejected, "key", "left_anti").select("doc.*")
