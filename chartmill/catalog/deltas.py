"""Small changes beside much that is staged: filters, buckets, ranges, recomputed roll-ups, balanced reads, rejects."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartmill.catalog.basics import DICTIONARY_COLUMNS_SQL
from chartmill.catalog.jobs import REGIMENS_SQL, TRIAGE_SQL, VITAL_SIGNS, regimen_source, triage_source
from chartmill.catalog.registry import query
from chartmill.catalog.standins import Tables
from chartmill.operators import documents, membership
from chartmill.plans import care, changes, reports
from chartmill.sources import readers, writers
from chartmill.sources.bucketed import BucketedStage

# ---- a filter of the batch's keys, sent to the staged scan --------------------------------------------------

DELTA, STAGED = "l_orderkey % 100 = 7", "l_returnflag = 'R'"


@query("anti_not_staged_delta", f"""
    SELECT l_orderkey, l_linenumber, min(l_shipdate) AS l_shipdate FROM lineitem l
    WHERE {DELTA} AND NOT EXISTS (SELECT 1 FROM lineitem s WHERE s.{STAGED} AND s.l_orderkey = l.l_orderkey AND s.l_linenumber = l.l_linenumber)
    GROUP BY l_orderkey, l_linenumber""")
def anti_not_staged_delta(t: Tables) -> DataFrame:
    """A batch of one order in a hundred against all staged lines."""
    keys = ["l_orderkey", "l_linenumber"]
    return membership.new_rows_of_delta(t.lineitem.where(DELTA).select(*keys, "l_shipdate"), t.lineitem.where(STAGED), keys, ["l_shipdate"])


@query("semi_of_delta", f"SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_partkey IN (SELECT l_partkey FROM lineitem WHERE {DELTA} AND {STAGED})")
def semi_of_delta(t: Tables) -> DataFrame:
    return membership.semi_on_delta(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"), t.lineitem.where(f"{DELTA} AND {STAGED}").select("l_partkey"), ["l_partkey"])


# ---- staged rows in buckets ---------------------------------------------------------------------------------


def staged_visits(t: Tables) -> BucketedStage:
    """The orders of the first years in two loads, which overlap, and the second one twice."""
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderdate").where("o_orderdate < TIMESTAMP_NTZ'1997-01-01 00:00:00'")
    stage = BucketedStage.of(t.spark, t.scratch("bucketed"), rows.schema, ["o_orderkey"], 8)
    for part in ("o_orderdate < TIMESTAMP_NTZ'1995-01-01 00:00:00'", "true", "true"):
        stage.append(rows.where(part))
    return stage


def lines_with_a_hot_key(t: Tables) -> DataFrame:
    """Lineitems of which a good third name the same order, and some none."""
    visit = F.when(F.col("l_linenumber") <= 2, F.lit(1).cast("long")).when(F.col("l_linenumber") < 7, F.col("l_orderkey"))
    return t.lineitem.select(F.col("l_orderkey").alias("line_order"), "l_linenumber", visit.alias("visit"))


HOT_LINES_SQL = "SELECT l_orderkey AS line_order, l_linenumber, CASE WHEN l_linenumber <= 2 THEN 1 WHEN l_linenumber < 7 THEN l_orderkey END AS visit FROM lineitem"
EARLY_SQL = "SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01'"


@query("lookup_bucketed", f"SELECT f.*, o_custkey AS patient, o_orderdate AS since FROM ({HOT_LINES_SQL}) f LEFT JOIN ({EARLY_SQL}) ON visit = o_orderkey")
def lookup_bucketed(t: Tables) -> DataFrame:
    return staged_visits(t).lookup(lines_with_a_hot_key(t), {"visit": "o_orderkey"}, {"o_custkey": "patient", "o_orderdate": "since"})


@query("semi_bucketed", f"SELECT * FROM ({HOT_LINES_SQL}) WHERE visit IN (SELECT o_orderkey FROM ({EARLY_SQL}))")
def semi_bucketed(t: Tables) -> DataFrame:
    return staged_visits(t).semi(lines_with_a_hot_key(t), {"visit": "o_orderkey"})


@query("anti_bucketed", "SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01'")
def anti_bucketed(t: Tables) -> DataFrame:
    return staged_visits(t).new_rows(t.orders.select("o_orderkey", "o_custkey", "o_orderdate"))


# ---- ranges rewritten, and only those touched ---------------------------------------------------------------


@query("upsert_ranges", """
    SELECT p_partkey, CASE WHEN p_type IN ('PROMO', 'LARGE') AND p_partkey <= 1000 THEN upper(p_name) ELSE p_name END AS p_name
    FROM part WHERE p_size <= 30 OR (p_type IN ('PROMO', 'LARGE') AND p_partkey <= 1000)""")
def upsert_ranges(t: Tables) -> DataFrame:
    """A change of the lowest keys, put in twice."""
    target = t.part.where("p_size <= 30").select("p_partkey", "p_name")
    source = t.part.where(F.col("p_type").isin("PROMO", "LARGE") & (F.col("p_partkey") <= 1000)).select("p_partkey", F.upper("p_name").alias("p_name"))
    path = t.scratch("ranges")
    writers.write_ranges(target, path, "p_partkey", 250)
    for _ in range(2):
        writers.upsert_ranges(path, target.schema, source, ["p_partkey"], "p_partkey", 250, t.scratch("changed"))
    return t.spark.read.schema(target.schema).parquet(path).drop("key_range")


# ---- roll-ups brought up to date ----------------------------------------------------------------------------
# The lines of an order are its observations: the first two are known at first, the others come in two batches, late.

BATCHES = ("l_linenumber IN (4, 6)", "l_linenumber IN (3, 5, 7)")


def in_batches(t: Tables, source, job, change, keys: list[str]) -> DataFrame:
    """A first run, then two batches of late observations, the first of them twice."""
    known = "l_linenumber <= 2"
    staged = writers.write_snapshot(job(source(t, known)), t.scratch("first"))
    for late in (BATCHES[0], BATCHES[0], BATCHES[1]):
        known = known if late in known else f"{known} OR {late}"
        staged = changes.brought_up_to_date(
            staged, keys, lambda known=known, late=late, staged=staged: change(source(t, known), source(t, late)["obs"], staged), lambda df: writers.write_snapshot(df, t.scratch("next")))
    return staged


@query("triage_by_changes", TRIAGE_SQL)
def triage_by_changes(t: Tables) -> DataFrame:
    """Late vitals reach encounters that are staged."""
    settings = {"measures": VITAL_SIGNS, "concept_uuids": [f"SIZE {n}" for n in VITAL_SIGNS]}
    return in_batches(t, triage_source, lambda src: care.triage(src, **settings), lambda src, new, staged: changes.triage_changes(src, new, **settings), ["person_id", "encounter_id"])


@query("regimens_by_changes", REGIMENS_SQL)
def regimens_by_changes(t: Tables) -> DataFrame:
    """Drugs are the first lines; reasons for a change are the sixth and seventh."""
    settings = {"drug_concept": 1, "change_concepts": [6, 7]}
    return in_batches(t, regimen_source, lambda src: reports.regimens(src, **settings), lambda src, new, staged: changes.regimen_changes(src, new, staged=staged, **settings), ["person_id"])


# ---- reads --------------------------------------------------------------------------------------------------

RANGES = 16


@query("scan_balanced", "SELECT o_orderkey * o_orderkey AS k, o_custkey FROM orders")
def scan_balanced(t: Tables) -> DataFrame:
    """A key that is dense at its lower end, read in ranges of equal depth; each row once."""
    rows = t.orders.select((F.col("o_orderkey") * F.col("o_orderkey")).alias("k"), "o_custkey")
    ranges = readers.balanced_predicates(rows, "k", RANGES)
    out = rows.where(ranges[0])
    for predicate in ranges[1:]:
        out = out.unionAll(rows.where(predicate))
    return out


NAMES = ("source_parent", "source_label", "source_concept_uuid", "source_concept_id", "concept_type", "ciel", "target_parent", "target_label", "target_concept_uuid", "target_concept_id")
LINE_SQL = " || ',' || ".join(NAMES)
SHORT_SQL = " || ',' || ".join(NAMES[:-2])


def broken_file(t: Tables) -> str:
    """The dictionary as a file of lines, some of which lost two fields, gained one or open a quote that nothing closes."""
    fault = F.pmod(F.col("source_concept_id").cast("long"), F.lit(50))
    whole = F.concat_ws(",", *NAMES)
    line = F.when(fault == 1, F.concat_ws(",", *NAMES[:-2])).when(fault == 2, F.concat(whole, F.lit(",more"))).when(fault == 3, F.concat(F.lit('"'), whole)).otherwise(whole)
    header = t.spark.range(1, numPartitions=1).select(F.lit(",".join(NAMES)).alias("line"))
    path = t.scratch("lines")
    # One file, so that the header comes first.
    header.unionAll(t.full_dictionary.select(line.alias("line"))).coalesce(1).write.text(path)
    return path


@query("dictionary_or_reject", f"""
    SELECT CASE WHEN fault IN (1, 2, 3) THEN NULL ELSE source_concept_id END AS source_concept_id, CASE WHEN fault IN (1, 2, 3) THEN NULL ELSE target_concept_uuid END AS target_concept_uuid,
           CASE fault WHEN 1 THEN {SHORT_SQL} WHEN 2 THEN {LINE_SQL} || ',more' WHEN 3 THEN '"' || {LINE_SQL} END AS line,
           CASE fault WHEN 1 THEN 'too few fields' WHEN 2 THEN 'too many fields' WHEN 3 THEN 'open quote' END AS reason
    FROM (SELECT *, CAST(source_concept_id AS BIGINT) % 50 AS fault FROM ({DICTIONARY_COLUMNS_SQL}))""")
def dictionary_or_reject(t: Tables) -> DataFrame:
    """The concepts that could be read, and the lines that could not."""
    good, bad = readers.read_concept_dictionary_or_reject(t.spark, broken_file(t))
    nothing = F.lit(None).cast("string")
    return good.select("source_concept_id", "target_concept_uuid", nothing.alias("line"), nothing.alias("reason")).unionAll(
        bad.select(nothing, nothing, "line", "reason"))


BODY_SQL = """CASE event_type WHEN 'error' THEN '{"uuid":"U-' || event_id || '"' WHEN 'view' THEN '<html>' || event_id || '</html>'
    WHEN 'signup' THEN NULL ELSE '{"uuid":"U-' || event_id || '"}' END"""


@query("responses_or_reject", f"""
    SELECT event_id, CASE WHEN event_type IN ('click', 'purchase') THEN 'U-' || event_id END AS uuid,
           CASE WHEN event_type NOT IN ('click', 'purchase') THEN {BODY_SQL} END AS body,
           CASE event_type WHEN 'error' THEN 'unreadable' WHEN 'view' THEN 'not an object' WHEN 'signup' THEN 'no answer' END AS reason
    FROM events""")
def responses_or_reject(t: Tables) -> DataFrame:
    """Answers that were cut off, that are pages of a proxy, or that never came are not taken for created ones."""
    number = F.col("event_id").cast("string")
    opened = F.concat(F.lit('{"uuid":"U-'), number, F.lit('"'))
    body = F.when(F.col("event_type") == "error", opened).when(F.col("event_type") == "view", F.concat(F.lit("<html>"), number, F.lit("</html>"))).when(
        F.col("event_type") != "signup", F.concat(opened, F.lit("}")))
    good, bad = documents.read_responses_or_reject(t.events.select("event_id", body.alias("body")))
    nothing = F.lit(None).cast("string")
    return good.select("event_id", "uuid", nothing.alias("body"), nothing.alias("reason")).unionAll(bad.select("event_id", nothing, "body", "reason"))
