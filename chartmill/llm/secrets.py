"""Secret scans: fixed shapes, and strings that a battery of randomness tests cannot tell from random ones.

Fixed kinds are `assign`, `access` and `hex`: leftmost non-overlapping matches, those too short dropped.  The kind `random`
is added by the battery.  Candidates stand in runs of 20 or more letters, digits, +, /, =, _ and -, which may glue a key to
its name or path: every part of 20 characters or more between =, and between those and /, or _ and -, or all three, is a
candidate (closing = stay with it).  Their encoding is inferred from the characters in them (hex, upper-case, alphanumeric,
base64, base64url, each needing its kinds of characters, or the same without digits), and gives the alphabet that they would
be drawn from.  Three tests follow:

* chi-squared: are the alphabet's symbols used evenly (mean and variance of the sparse statistic, Wilson-Hilferty tail);
* runs: do symbols of the upper and lower half of the alphabet alternate as often as by chance (Wald-Wolfowitz);
* serial correlation: is a symbol's place in the alphabet unrelated to that of the next (circular, lag 1).

Fisher's method joins the three p-values.  For random strings the joint p is even between 0 and 1; for names, paths and
words it is near 0, the nearer the longer they are.  Words of 20 letters are too short for that, so candidates are also
weighed against the pairs of letters in the table's other words: one that those make 2^10 times as
likely as even letters do is text.  A random string of any encoding but hex, where this is not asked, has a chance of at
most 2^-10 to be taken for text, in a table of any size.

How many of the others above a threshold are not random is estimated from the different p in a group: half of the random
ones lie above 1/2, and what exceeds their share below it is false.  The lowest threshold on a fixed grid is used at which
the false finds do not exceed `fdr` of all by more than two standard deviations of that estimate.  The group is an encoding
and length class if it has `DENSE` candidates, or else the encoding, or else all; where even all are fewer, the threshold
is the lowest of the grid, which loses one random string in a thousand.  Candidates that overlap a fixed span add nothing,
and found ones that overlap each other are one span.

Work grows with a text's length and, but for sorting, with the number of its matches.  Positions are code points, ends are
exclusive.  Null texts count as empty; empty texts and tables find nothing.  Repeated
rows are scanned alike.  Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chartmill.llm.shared import before, bounded, let, row_key, written

ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
CANDIDATE = r"[A-Za-z0-9+/=_-]{20,}"
KINDS = ("assign", "access", "hex", "random")

DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Encodings by name: the characters allowed, the alphabet in order, and the patterns that all must occur.
ENCODINGS = (
    ("hex", "[0-9a-f]+", DIGITS + "abcdef", ("[0-9]", "[a-f]")),
    ("upper_hex", "[0-9A-F]+", DIGITS + "ABCDEF", ("[0-9]", "[A-F]")),
    ("upper", "[A-Z0-9]+", UPPER + DIGITS, ("[0-9]", "[A-Z]")),
    ("lower", "[a-z0-9]+", LOWER + DIGITS, ("[0-9]", "[a-z]")),
    ("alnum", "[A-Za-z0-9]+", UPPER + LOWER + DIGITS, ("[0-9]", "[a-z]", "[A-Z]")),
    ("base64", "[A-Za-z0-9+/]+={0,2}", UPPER + LOWER + DIGITS + "+/", ("[0-9]", "[a-z]", "[A-Z]")),
    ("base64url", "[A-Za-z0-9_-]+={0,2}", UPPER + LOWER + DIGITS + "-_", ("[0-9]", "[a-z]", "[A-Z]")),
)
#: The same where chance left out the digits; tried after the others.
LETTERS = (
    ("upper_letters", "[A-Z]+", UPPER, ()),
    ("lower_letters", "[a-z]+", LOWER, ()),
    ("letters", "[A-Za-z]+={0,2}", UPPER + LOWER, ("[a-z]", "[A-Z]")),
    ("base64_letters", "[A-Za-z+/]+={0,2}", UPPER + LOWER + "+/", ("[a-z]", "[A-Z]")),
    ("base64url_letters", "[A-Za-z_-]+={0,2}", UPPER + LOWER + "-_", ("[a-z]", "[A-Z]")),
)
#: The parts of a run that are candidates.
PARTS = tuple(f"[^={apart}]{{20,}}={{0,2}}" for apart in ("", "/", "_-", "/_-"))
GRID = (0.001, 0.01, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5)
#: A group of fewer candidates has no threshold of its own.
DENSE = 30
#: The bits from which a candidate is text.
TEXT_BITS = 10
#: What finds ASSIGN, ACCESS and HEX matches of full length, and candidates, without walking through each shorter run.
FINDS = {"assign": ASSIGN, "access": r"AKIA[A-Z0-9]{16,}+", "hex": r"(?<![0-9a-f])[0-9a-f]{24,}+", "random": r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/=_-]{20,}+"}
#: Long texts are cut into pieces of so many characters, as finding a place in a text walks through it.
CHARS = 1024

SPANS = "array<struct<start:int,end:int,kind:string>>"


def matches(text: Column, kind: str, group: int = 0, least: int = 0) -> Column:
    """Array of (start, token) of a kind's matches whose `group` has `least` characters or more.

    What lies between matches and the matches themselves alternate, so their lengths add up to positions."""
    pattern = FINDS[kind]
    return F.when(may_have(text, kind), cut_by(text, pattern, group, least)).otherwise(F.array().cast("array<struct<start:int,token:string>>"))


def may_have(text: Column, kind: str) -> Column:
    """What is quickly seen, and then whether the pattern is found at all."""
    quick = {"assign": F.contains(text, F.lit(":")) | F.contains(text, F.lit("=")), "access": F.contains(text, F.lit("AKIA"))}
    found = text.rlike(FINDS[kind])
    return quick[kind] & found if kind in quick else found


def cut_by(text: Column, pattern: str, group: int = 0, least: int = 0) -> Column:
    tokens = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    held = F.transform(tokens if not group else F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), F.length)
    gaps = F.slice(F.transform(F.split(text, pattern, -1), F.length), F.lit(1), F.size(held))
    rows = F.arrays_zip(gaps.alias("gap"), tokens.alias("token"), held.alias("held"))

    def placed(found: Column) -> Column:
        steps = F.transform(found, lambda m: m["gap"] + F.length(m["token"]))
        starts = before(steps, F.lit(0), lambda a, b: a + b)
        every = F.zip_with(found, starts, lambda m, at: F.struct((at + m["gap"]).alias("start"), m["token"].alias("token"), m["held"].alias("held")))
        return F.transform(F.filter(every, lambda m: m["held"] >= least), lambda m: F.struct(m["start"].alias("start"), m["token"].alias("token")))

    return let(rows, placed)


def spans_of(text: Column, kind: str, group: int = 0, least: int = 0) -> Column:
    """Array of (start, end, kind) of a kind's matches."""
    return F.transform(matches(text, kind, group, least), lambda m: F.struct(m["start"].alias("start"), (m["start"] + F.length(m["token"])).alias("end"), F.lit(kind).alias("kind")))


def fixed(text: Column) -> Column:
    """The spans of the fixed kinds."""
    return F.concat(spans_of(text, "assign", 2, 6), spans_of(text, "access"), spans_of(text, "hex"))


def upper_tail(z: Column) -> Column:
    """P(N > z) for a standard normal N (Abramowitz and Stegun 26.2.17)."""
    x = F.abs(z)
    t = 1 / (1 + 0.2316419 * x)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = F.exp(-x * x / 2) / math.sqrt(2 * math.pi) * poly
    return F.when(z >= 0, tail).otherwise(1 - tail)


def battery(found: DataFrame) -> DataFrame:
    """Adds `p` to rows with `body`, a string made of the symbols of `alphabet`: the joint p-value that it is random.

    Each step is a projection of its own, so that no expression is written out twice."""
    k = F.length("alphabet").cast("double")
    n = F.col("n")
    add = lambda s, x: s + x
    # Symbols are counted by what replacing them takes away, so the work is linear in the length.
    counts = F.transform(F.regexp_extract_all("alphabet", F.lit("."), F.lit(0)), lambda c: F.col("n") - F.length(F.replace("body", c, F.lit(""))))
    halves = F.call_function("translate", F.col("body"), F.col("alphabet"), F.concat(F.repeat(F.lit("l"), F.floor(k / 2).cast("int")), F.repeat(F.lit("u"), F.ceil(k / 2).cast("int"))))
    places = F.transform(F.regexp_extract_all("body", F.lit("."), F.lit(0)), lambda c: F.position(c, "alphabet").cast("double"))
    rows = found.withColumns({"n": F.length("body").cast("double"), "k": k, "halves": halves, "places": places})
    following = F.concat(F.slice("places", F.lit(2), F.size("places")), F.slice("places", F.lit(1), F.lit(1)))
    # A sparse table's statistic varies less than chi-squared; these degrees of freedom match its mean and variance.
    rows = rows.withColumns({
        "chi": (F.aggregate(counts, F.lit(0.0), lambda s, c: s + c * c) * F.col("k") / n - n) / ((n - 1) / n), "free": (F.col("k") - 1) / ((n - 1) / n),
        "upper": n - F.length(F.replace("halves", F.lit("u"), F.lit(""))), "runs": F.length(F.regexp_replace("halves", "l+|u+", "r")).cast("double"),
        "s1": F.aggregate("places", F.lit(0.0), add), "s2": F.aggregate("places", F.lit(0.0), lambda s, x: s + x * x),
        "cross": F.aggregate(F.zip_with("places", following, lambda a, b: a * b), F.lit(0.0), add),
    }).drop("halves", "places")
    rows = rows.withColumns({"mean": 2 * F.col("upper") * (n - F.col("upper")) / n + 1, "spread": n * F.col("s2") - F.col("s1") * F.col("s1"), "w": 2 / (9 * F.col("free"))})
    rows = rows.withColumn("var", (F.col("mean") - 1) * (F.col("mean") - 2) / (n - 1))
    sd = F.sqrt(n * (n - 3) / (n + 1)) / (n - 1)
    rows = rows.withColumns({
        "z_chi": (F.pow(F.greatest("chi", F.lit(0.0)) / F.col("free"), F.lit(1 / 3)) - (1 - F.col("w"))) / F.sqrt("w"),
        "z_runs": F.when(F.col("var") > 0, F.abs(F.col("runs") - F.col("mean")) / F.sqrt("var")),
        "z_serial": F.when(F.col("spread") > 0, F.abs((n * F.col("cross") - F.col("s1") * F.col("s1")) / F.col("spread") + 1 / (n - 1)) / sd),
    })
    rows = rows.withColumns({
        "p_chi": upper_tail(F.col("z_chi")), "p_runs": F.coalesce(2 * upper_tail(F.col("z_runs")), F.lit(0.0)), "p_serial": F.coalesce(2 * upper_tail(F.col("z_serial")), F.lit(0.0)),
    })
    # Fisher: minus twice the sum of logs is chi-squared with six degrees of freedom.
    least = F.lit(1e-300)
    rows = rows.withColumn("half", F.greatest(F.lit(0.0), -(F.log(F.greatest("p_chi", least)) + F.log(F.greatest("p_runs", least)) + F.log(F.greatest("p_serial", least)))))
    return rows.withColumn("p", F.exp(-F.col("half")) * (1 + F.col("half") + F.col("half") * F.col("half") / 2)).select(*found.columns, "p")


def length_class(n: Column) -> Column:
    """Eight characters a class up to 64, then doubling."""
    return F.when(n <= 64, F.floor(n / 8)).otherwise(F.floor(F.log2(n.cast("double"))) + 3).cast("int")


def judged(found: DataFrame) -> DataFrame:
    """Adds encoding, length class and p to rows with `token`; rows that fit no encoding are left out."""
    encoding, alphabet = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, allowed, symbols, needed in reversed(ENCODINGS + LETTERS):
        fits = F.col("token").rlike(f"^{allowed}$")
        for part in needed:
            fits = fits & F.col("token").rlike(part)
        encoding, alphabet = F.when(fits, F.lit(name)).otherwise(encoding), F.when(fits, F.lit(symbols)).otherwise(alphabet)
    rows = found.withColumns({"encoding": encoding, "alphabet": alphabet, "body": F.regexp_replace("token", "=+$", "")}).where("encoding is not null and length(body) >= 4")
    return battery(rows).withColumn("length_class", length_class(F.length("body"))).drop("alphabet", "body")


def letter_pairs(docs: DataFrame) -> DataFrame:
    """One row with `pairs`: the bits by which a letter makes the next one likelier than even ones would, by pair, in words
    outside the runs that candidates stand in, so that no candidate speaks for itself.  Letters that start no pair are left out.
    Counted in the whole texts of all documents; only different words are shuffled."""
    texts = docs.select(F.lower(F.regexp_replace(text_of(), FINDS["random"], " ")).alias("text"))
    words = texts.select(F.explode(F.regexp_extract_all("text", F.lit("[a-z]+"), F.lit(0))).alias("word")).where("length(word) between 2 and 19").groupBy("word").count()
    pairs = words.select(F.explode(F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substr("word", i, F.lit(2)))).alias("pair"), "count").groupBy("pair").agg(F.sum("count").alias("n"))
    ahead = pairs.groupBy(F.substring("pair", 1, 1).alias("one")).agg(F.sum("n").alias("of"), F.map_from_entries(F.collect_list(F.struct("pair", "n"))).alias("seen"))
    cells = ahead.withColumn("pair", F.explode(F.transform(F.split(F.lit(LOWER), ""), lambda c: F.concat("one", c)))).where("length(pair) = 2")
    bits = F.log2(len(LOWER) * (F.coalesce(F.element_at("seen", F.col("pair")), F.lit(0)) + 1.0) / (F.col("of") + len(LOWER)))
    return cells.agg(F.map_from_entries(F.collect_list(F.struct("pair", bits.alias("bits")))).alias("pairs"))


def unlike_text(tested: DataFrame, pairs: DataFrame) -> DataFrame:
    """The rows whose `token` is not likelier as text by `TEXT_BITS`."""
    # Every two neighbours, read in one walk.
    two = F.regexp_extract_all(F.lower("token"), F.lit("(?s)(?=(..))"), F.lit(1))
    bits = F.aggregate(two, F.lit(0.0), lambda s, pair: s + F.coalesce(F.element_at("pairs", pair), F.lit(0.0)))
    return tested.crossJoin(F.broadcast(pairs)).where(F.col("encoding").isin("hex", "upper_hex") | (bits < TEXT_BITS)).drop("pairs")


def thresholds(tested: DataFrame, fdr: float) -> DataFrame:
    """(encoding, length_class, threshold): the lowest on the grid whose estimated share of false finds is within `fdr`, as
    far as the group can tell."""
    # A string that is copied often is one candidate: its p is the same.
    apart = tested.where(F.col("p") >= GRID[0]).select("encoding", "length_class", "p").distinct()
    above = [F.sum(F.when(F.col("p") >= t, 1).otherwise(0)).alias(f"n{i}") for i, t in enumerate(GRID)]

    def lowest(counts: DataFrame, name: str) -> DataFrame:
        found = F.lit(GRID[-1])
        for i in reversed(range(len(GRID) - 1)):
            n, random = F.col(f"n{i}").cast("double"), F.col(f"n{len(GRID) - 1}") * ((1 - GRID[i]) / (1 - GRID[-1]))
            found = F.when(n - random <= fdr * n + 2 * F.sqrt(n), F.lit(GRID[i])).otherwise(found)
        return counts.withColumn(name, F.when(F.col("n0") >= DENSE, found)).drop(*(f"n{i}" for i in range(len(GRID))))

    # A few groups, so the coarser ones are counted from the finest.
    groups = apart.groupBy("encoding", "length_class").agg(*above)
    sums = [F.sum(f"n{i}").alias(f"n{i}") for i in range(len(GRID))]
    own, coded, all_ = lowest(groups, "own"), lowest(groups.groupBy("encoding").agg(*sums), "coded"), lowest(groups.agg(*sums), "every")
    joined = own.join(F.broadcast(coded), "encoding").crossJoin(F.broadcast(all_))
    return joined.select("encoding", "length_class", F.coalesce("own", "coded", "every", F.lit(GRID[0])).alias("threshold"))


def key() -> Column:
    return row_key("doc_id", "text").alias("key")


def text_of() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def clear_of(found: DataFrame, base: DataFrame) -> DataFrame:
    """The rows (key, start, end, token) of `found` that overlap no row (key, start, end) of `base`."""
    both = found.withColumn("candidate", F.lit(True)).unionByName(base.withColumns({"token": F.lit(None).cast("string"), "candidate": F.lit(False)}))
    by_start = Window.partitionBy("key").orderBy("start")
    reach = F.max(F.when(~F.col("candidate"), F.col("end"))).over(by_start.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    # From the other end, as a frame up to the last row is computed anew for each row.
    from_end = Window.partitionBy("key").orderBy(F.desc("start")).rangeBetween(Window.unboundedPreceding, -1)
    following = F.min(F.when(~F.col("candidate"), F.col("start"))).over(from_end)
    seen = both.withColumns({"reach": F.coalesce(reach, F.lit(0)), "following": following})
    return seen.where(F.col("candidate") & (F.col("reach") <= F.col("start")) & (F.col("following").isNull() | (F.col("following") >= F.col("end")))).select(*found.columns)


def united(found: DataFrame) -> DataFrame:
    """(key, random) from rows (key, start, end): the spans of each text by start, those that overlap as one."""
    by_start = Window.partitionBy("key").orderBy("start", "end")
    reach = F.max("end").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    opens = found.select("key", "start", "end").distinct().withColumn("opens", F.when(F.col("start") < reach, 0).otherwise(1))
    grouped = opens.withColumn("nr", F.sum("opens").over(by_start)).groupBy("key", "nr").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return grouped.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("start", "end", F.lit("random").alias("kind")))).alias("random"))


def found_random(docs: DataFrame, fdr: float) -> DataFrame:
    """(key, random): the spans that the battery adds, for the texts that it finds any in; `key` is that of doc_id and text.

    Only places and tokens are written and shuffled, and only of texts with a run of 20 characters."""
    text = text_of()
    rows = docs.where(text.rlike(FINDS["random"])).select(key(), fixed(text).alias("base"), matches(text, "random").alias("more"))
    rows = written(rows.dropDuplicates(["key"]), "runs")
    runs = rows.select("key", F.explode("more").alias("m")).select("key", "m.*")
    parts = F.array_distinct(F.concat(*(cut_by(F.col("token"), pattern) for pattern in PARTS)))
    placed = runs.select("key", "start", F.explode(parts).alias("part"))
    begins = F.col("start") + F.col("part.start")
    found = placed.select("key", begins.alias("start"), (begins + F.length("part.token")).alias("end"), F.col("part.token").alias("token"))
    base = rows.select("key", F.explode("base").alias("b")).select("key", "b.start", "b.end")
    tested = written(unlike_text(judged(clear_of(found, base)), letter_pairs(docs)), "tested")
    kept = tested.join(F.broadcast(thresholds(tested, fdr)), ["encoding", "length_class"]).where("p >= threshold")
    return bounded(written(united(kept), "random"))


def scan(docs: DataFrame, fdr: float = 0.1, carry: Column | None = None) -> DataFrame:
    """Each row as `doc` (its doc_id, or what `carry` says) with `base` and `random`: arrays of (start, end, kind)."""
    carry = (F.struct("doc_id") if carry is None else carry).alias("doc")
    rows = docs.select(carry, key(), fixed(text_of()).alias("base"))
    nothing = F.array().cast(SPANS)
    return rows.join(found_random(docs, fdr), "key", "left").select("doc", "base", F.coalesce("random", nothing).alias("random"))


def listed(spans: Column) -> Column:
    """kind:start:end by start, then by kind as listed, joined by commas."""
    rank = F.array(*(F.lit(k) for k in KINDS))
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.array_position(rank, s["kind"]).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"))))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame, fdr: float = 0.1) -> DataFrame:
    """doc_id, the number of spans of each kind, the digest of the fixed spans, and all spans."""
    found = scan(docs, fdr)
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc.doc_id", *(count(k) for k in KINDS[:-1]), F.size("random").cast("long").alias("n_random"), F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.concat("base", "random")).alias("spans"))


def without(text: Column, spans: Column, mark: str) -> Column:
    """The text with each of the spans, in order, replaced by `mark`, those that overlap together."""
    def kept(cuts: Column) -> Column:
        ends = F.transform(cuts, lambda s: s["end"])
        reach = before(ends, F.lit(0), lambda a, b: F.greatest(a, b))
        ranges = F.filter(F.zip_with(cuts, reach, lambda s, at: F.struct(at.alias("a"), s["start"].alias("b"))), lambda r: r["b"] >= r["a"])
        return F.array_append(ranges, F.struct(F.array_max(ends).alias("a"), F.length(text).alias("b")))

    def piece(chunks: Column, r: Column) -> Column:
        a, b = r["a"], r["b"]
        chunk = lambda c: F.substr(F.get(chunks, c), F.greatest(a - c * CHARS, F.lit(0)) + 1, F.least(b - c * CHARS, F.lit(CHARS)) - F.greatest(a - c * CHARS, F.lit(0)))
        whole = F.transform(F.sequence(F.floor(a / CHARS).cast("int"), F.floor((b - 1) / CHARS).cast("int")), chunk)
        return F.when(b > a, F.array_join(whole, "")).otherwise("")

    chunks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHARS}}}"), F.lit(0))
    return let(chunks, lambda c: F.array_join(F.transform(kept(spans), lambda r: piece(c, r)), mark))


def masked(docs: DataFrame, fdr: float = 0.1, mark: str = "[SECRET]") -> DataFrame:
    """The documents with every span replaced by `mark`, and n_chars, if there is one, counted anew where that changed
    the text.  No document is dropped; each is masked where it stands, without being copied or shuffled."""
    found = scan(docs, fdr, F.struct("*"))
    text = F.col("doc.text").cast("string")
    changed = F.size("base") + F.size("random") > 0
    walked = without(text, F.array_sort(F.concat("base", "random")), mark)
    clean = found.select("doc", F.when(changed, walked).otherwise(F.col("doc.text")).alias("clean"), changed.alias("changed"))
    new = {"text": F.col("clean")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("changed"), F.length("clean").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("doc.n_chars"))
    return clean.select(*(new.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns))
