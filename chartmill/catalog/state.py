"""Incremental loads, delivery state, identifier allocation and finders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartmill.catalog.basics import ANSWER_SQL, uuid_sql, with_answer
from chartmill.catalog.registry import query
from chartmill.catalog.standins import (
    DICTIONARY_SQL, ENCOUNTER_SQL, ENCOUNTER_TYPE_SQL, IDENTIFIER_TYPE_OF_SEGMENT, PARENT, PATIENTS_SQL, PLACE_IDS_SQL, PLACES,
    PROGRAM_ID_OF_EVENT, PROGRAM_OF_EVENT, PROGRAMS_SQL, TYPES_SQL, Tables, code_of, code_of_sql, type_of_price,
)
from chartmill.functions import dictionaries, fixed_values as fixed
from chartmill.operators import choose, delivery, documents, finders, incremental, outbox
from chartmill.plans import care, registration
from chartmill.schemas import staged_schema
from chartmill.sources import writers
from chartmill.sources.ledger import Ledger
from chartmill.streaming import loads

# ---- incremental loads --------------------------------------------------------------------------------------
# Events arrive in key order, so the events of the first half of the month count as loaded.

LOADED_SQL = "(SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-16')"
BEFORE, SINCE = "ts < TIMESTAMP_NTZ'2024-01-16 00:00:00'", "ts >= TIMESTAMP_NTZ'2024-01-16 00:00:00'"


def slim(t: Tables) -> DataFrame:
    return t.events.select("event_id", "user_id", "event_type", "ts")


def loaded(t: Tables) -> DataFrame:
    return slim(t).where(BEFORE)


@query("incr_ascending", f"""
    SELECT event_id, user_id, event_type, ts FROM events WHERE event_id > (SELECT max(event_id) FROM {LOADED_SQL})""")
def incr_ascending(t: Tables) -> DataFrame:
    return incremental.after_cursor(slim(t), "event_id", loaded(t))


@query("incr_inclusive", f"""
    SELECT event_id, user_id, event_type, ts FROM events
    WHERE event_id >= (SELECT max(event_id) FROM {LOADED_SQL}) AND event_id NOT IN (SELECT event_id FROM {LOADED_SQL})""")
def incr_inclusive(t: Tables) -> DataFrame:
    return incremental.idempotent_load(slim(t), loaded(t), ["event_id"], cursor_key="event_id")


@query("incr_look_back", f"""
    SELECT event_id, user_id, event_type, ts FROM events
    WHERE ts >= (SELECT max(ts) - INTERVAL 3 DAY FROM {LOADED_SQL} WHERE event_type <> 'error')
      AND event_id NOT IN (SELECT event_id FROM {LOADED_SQL} WHERE event_type <> 'error')""")
def incr_look_back(t: Tables) -> DataFrame:
    """Late rows: the errors of the loaded half were missed; a look-back of three days picks up the recent ones."""
    staged = loaded(t).where("event_type <> 'error'")
    return incremental.idempotent_load(slim(t), staged, ["event_id"], cursor_key="ts",
                                       look_back=F.expr("INTERVAL 3 DAYS"))


@query("backfill_descending", """
    SELECT event_id, user_id, event_type, ts FROM events
    WHERE event_id < (SELECT min(event_id) FROM events WHERE ts >= TIMESTAMP '2024-01-16')""")
def backfill_descending(t: Tables) -> DataFrame:
    newest = slim(t).where(SINCE)
    return incremental.before_cursor(slim(t), "event_id", newest).orderBy(F.desc("event_id"))


@query("first_run_or_delta", f"""
    SELECT 'first' AS run, event_id, user_id, event_type, ts FROM events
    UNION ALL SELECT 'delta', event_id, user_id, event_type, ts FROM events
    WHERE event_id > (SELECT max(event_id) FROM {LOADED_SQL})""")
def first_run_or_delta(t: Tables) -> DataFrame:
    """The same plan over an empty and a half-filled staging table."""
    empty = t.spark.createDataFrame([], slim(t).schema)
    first = incremental.after_cursor(slim(t), "event_id", empty)
    delta = incremental.after_cursor(slim(t), "event_id", loaded(t))
    return first.select(F.lit("first").alias("run"), "*").unionByName(delta.select(F.lit("delta").alias("run"), "*"))


@query("idempotent_load", """
    SELECT o_custkey, o_orderkey, o_orderdate FROM orders
    WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)""")
def idempotent_load(t: Tables) -> DataFrame:
    """Three runs: the finished orders, all orders, all orders again; the last adds nothing."""
    keys = ("o_custkey", "o_orderkey")
    rows = t.orders.select(*keys, "o_orderdate")
    ledger = Ledger(t.spark, t.scratch("idempotent"), rows.schema, keys, "o_orderkey")
    finished = t.orders.where("o_orderstatus = 'F'").select(*rows.columns)
    for source in (finished, rows, rows):
        ledger.load(lambda staged, source=source: incremental.idempotent_load(source, staged, keys, gate=(t.patients, {"o_custkey": "person_id"})))
    return ledger.staged().select(*rows.columns)


@query("minute_batches", f"""
    SELECT patient_id, encounter_id, e.encounter_type AS encounter_type_id, name AS encounter_name, encounter_datetime, location_id,
           visit_id, d.target_type_id, d.target_type_uuid, CAST(NULL AS VARCHAR) AS response_code
    FROM ({ENCOUNTER_SQL}) e JOIN ({ENCOUNTER_TYPE_SQL}) et ON e.encounter_type = et.encounter_type_id
    LEFT JOIN {TYPES_SQL} ON e.encounter_type = d.encounter_type_id
    WHERE voided = 0 AND location_id IN ({PLACE_IDS_SQL}) AND patient_id IN (SELECT person_id FROM ({PATIENTS_SQL}))""")
def minute_batches(t: Tables) -> DataFrame:
    """The encounter job as a stream: encounters come in two halves, and between them the patients of all segments but
    one are staged, whose first encounters have waited."""
    halves = (("encounter_datetime < TIMESTAMP_NTZ'1996-01-01 00:00:00'", ["BUILDING"]), ("encounter_datetime >= TIMESTAMP_NTZ'1996-01-01 00:00:00'", None))
    ledger = Ledger.of(t.spark, t.scratch("staged"), "encounters", "encounter_id")
    inbox, checkpoint = t.scratch("inbox"), t.scratch("checkpoint")
    for half, segments in halves:
        t.encounter.where(half).write.mode("append").parquet(inbox)
        stage_encounters(t, ledger, inbox, checkpoint, segments)
    return ledger.staged().drop("id", "load_number")


def stage_encounters(t: Tables, ledger: Ledger, inbox: str, checkpoint: str, segments: list[str] | None) -> None:
    """The encounters that are new in `inbox`, and those that wait, while the patients of some segments are staged."""
    patients = t.patients
    if segments is not None:
        patients = patients.join(t.customer.where(F.col("c_mktsegment").isin(segments)).select(F.col("c_custkey").alias("person_id")), "person_id", "left_semi")
    dimensions = {name: t.clinical[name] for name in ("encounter_type", "location")}
    loads.stage_stream(
        loads.file_stream(t.spark, inbox, t.encounter.schema), ledger, checkpoint, range_key="encounter_id",
        transform=lambda told: care.encounters({**dimensions, "encounter": told}, patients, PLACES),
        may_wait=lambda told: care.encounters_that_may_come({**dimensions, "encounter": told}, PLACES),
    ).awaitTermination()


#: Three batches by date, and the segments whose patients are staged while each is loaded.
THIRDS = (("1995-01-01", "1900-01-01", ["BUILDING"]), ("1997-01-01", "1995-01-01", ["BUILDING", "MACHINERY"]), ("2999-01-01", "1997-01-01", ["BUILDING", "MACHINERY", "FURNITURE"]))
COMES_SQL = f"voided = 0 AND location_id IN ({PLACE_IDS_SQL}) AND e.encounter_type IN (SELECT encounter_type_id FROM ({ENCOUNTER_TYPE_SQL}))"


@query("minute_batches_waiting", " UNION ALL ".join(f"""
    SELECT {nr} AS batch, encounter_id, patient_id FROM ({ENCOUNTER_SQL}) e
    WHERE {COMES_SQL} AND encounter_datetime < TIMESTAMP '{until}' AND patient_id NOT IN (
        SELECT person_id FROM ({PATIENTS_SQL}) JOIN customer ON c_custkey = person_id WHERE c_mktsegment IN ({', '.join(f"'{s}'" for s in segments)}))"""
    for nr, (until, _, segments) in enumerate(THIRDS)))
def minute_batches_waiting(t: Tables) -> DataFrame:
    """Which encounters wait after each of three batches: those that can come but whose patient is not staged yet."""
    ledger = Ledger.of(t.spark, t.scratch("staged"), "encounters", "encounter_id")
    inbox, checkpoint, waiting = t.scratch("inbox"), t.scratch("checkpoint"), []
    for nr, (until, since, segments) in enumerate(THIRDS):
        t.encounter.where(f"encounter_datetime >= TIMESTAMP_NTZ'{since} 00:00:00' AND encounter_datetime < TIMESTAMP_NTZ'{until} 00:00:00'").write.mode("append").parquet(inbox)
        stage_encounters(t, ledger, inbox, checkpoint, segments)
        waiting.append(ledger.state(t.encounter.schema).select(F.lit(nr).alias("batch"), "encounter_id", "patient_id"))
    return waiting[0].unionAll(waiting[1]).unionAll(waiting[2])


# ---- committed loads ----------------------------------------------------------------------------------------


def visits_of(t: Tables) -> DataFrame:
    """Orders as visits of customers, in the staged form."""
    plain = {"visit_id": "o_orderkey", "patient_id": "o_custkey", "date_started": "o_orderdate"}
    known = {name: F.col(column) for name, column in plain.items()}
    return t.orders.select(*[known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in staged_schema("visits")], "o_orderstatus")


def visit_ledger(t: Tables) -> Ledger:
    """Two loads of visits, the finished ones and then all; a third one, of visits that are not there, is killed before
    its commit; and a fourth brings nothing."""
    ledger = Ledger.of(t.spark, t.scratch("visits"), "visits", "date_started")
    rows = visits_of(t)
    for load in (rows.where("o_orderstatus = 'F'"), rows):
        ledger.append(incremental.idempotent_load(load.drop("o_orderstatus"), ledger.staged(), ledger.keys))
    ledger.write(rows.withColumn("visit_id", -F.col("visit_id")).drop("o_orderstatus"))
    ledger.append(incremental.idempotent_load(rows.drop("o_orderstatus"), ledger.staged(), ledger.keys))
    return ledger


VISIT_LOADS_SQL = f"""SELECT o_orderkey AS visit_id, o_custkey AS patient_id, o_orderdate AS date_started, {uuid_sql('o_orderkey')} AS id,
    CAST(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 2 END AS BIGINT) AS load_number FROM orders"""


@query("load_ledger", VISIT_LOADS_SQL)
def load_ledger(t: Tables) -> DataFrame:
    """What readers see of four loads: every visit once, with its id and the number of the load that brought it."""
    return visit_ledger(t).staged().select("visit_id", "patient_id", "date_started", "id", "load_number")


@query("load_ledger_compacted", VISIT_LOADS_SQL)
def load_ledger_compacted(t: Tables) -> DataFrame:
    ledger = visit_ledger(t)
    ledger.compact()
    return ledger.staged().select("visit_id", "patient_id", "date_started", "id", "load_number")


@query("latest_staged_row", f"SELECT * FROM ({VISIT_LOADS_SQL}) ORDER BY load_number DESC, id DESC LIMIT 1")
def latest_staged_row(t: Tables) -> DataFrame:
    """The newest row by load, then id; only the newest load is read."""
    return visit_ledger(t).newest().select("visit_id", "patient_id", "date_started", "id", "load_number")


@query("ledger_first_run_or_delta", """
    SELECT 'first' AS run, o_orderkey AS visit_id FROM orders
    UNION ALL SELECT 'delta', o_orderkey FROM orders WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders WHERE o_orderstatus = 'F')
    UNION ALL SELECT 'back', o_orderkey FROM orders WHERE o_orderdate < (SELECT min(o_orderdate) FROM orders WHERE o_orderstatus = 'F')""")
def ledger_first_run_or_delta(t: Tables) -> DataFrame:
    """Cursors out of the log: over an empty ledger, and after the finished visits were loaded, on from there and back."""
    ledger, rows = Ledger.of(t.spark, t.scratch("visits"), "visits", "date_started"), visits_of(t)
    first = incremental.after_cursor(rows, "date_started", ledger.edges(), "high")
    ledger.append(rows.where("o_orderstatus = 'F'").drop("o_orderstatus"))
    delta = incremental.after_cursor(rows, "date_started", ledger.edges(), "high")
    back = incremental.before_cursor(rows, "date_started", ledger.edges(), "low")
    run = lambda df, name: df.select(F.lit(name).alias("run"), "visit_id")
    return run(first, "first").unionAll(run(delta, "delta")).unionAll(run(back, "back"))


# ---- delivery state -----------------------------------------------------------------------------------------


@query("pending_queue", f"SELECT o_orderkey, o_custkey FROM orders WHERE {ANSWER_SQL} IS NULL")
def pending_queue(t: Tables) -> DataFrame:
    return delivery.pending(with_answer(t.orders)).select("o_orderkey", "o_custkey").orderBy("o_orderkey")


def waiting_encounters(t: Tables) -> DataFrame:
    """Lineitems as encounters of a visit (their order); those shipped in bulk have no visit, some name an unknown one."""
    visit = F.when(F.col("l_quantity") > 45, F.lit(None)).when(F.col("l_tax") > 0.07, -F.col("l_orderkey") - 1).otherwise(F.col("l_orderkey"))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_suppkey").alias("patient_id"), visit.alias("visit_id"))


def staff_as_patients(t: Tables) -> DataFrame:
    return t.supplier.where("s_acctbal >= 0").select(
        F.col("s_suppkey").alias("person_id"), F.when(F.col("s_acctbal") < 8000, F.col("s_name")).alias("target_patient_uuid"))


def sent_visits(t: Tables) -> DataFrame:
    rows = with_answer(t.orders)
    uuid = F.when(F.col("response_code") == "201", F.concat(F.lit("V-"), F.col("o_orderkey").cast("string")))
    return rows.select(F.col("o_orderkey").alias("visit_id"), F.col("o_custkey").alias("patient_id"),
                       F.col("o_orderdate").alias("date_started"), "response_code", uuid.alias("target_visit_uuid"))


@query("gate_on_parent", f"""
    WITH waiting AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey AS patient_id,
                CASE WHEN l_quantity > 45 THEN NULL WHEN l_tax > 0.07 THEN -l_orderkey - 1 ELSE l_orderkey END AS visit_id
             FROM lineitem),
         staff AS (SELECT s_suppkey, CASE WHEN s_acctbal < 8000 THEN s_name END AS target_patient_uuid
             FROM supplier WHERE s_acctbal >= 0),
         visit AS (SELECT o_orderkey, {ANSWER_SQL} AS code,
             CASE WHEN {ANSWER_SQL} = '201' THEN 'V-' || o_orderkey END AS target_visit_uuid FROM orders),
         told AS (SELECT l_orderkey, l_linenumber, l_partkey, patient_id, visit_id, target_patient_uuid, target_visit_uuid,
             CASE WHEN s_suppkey IS NULL THEN 'patient not staged' WHEN visit_id IS NULL THEN NULL
                  WHEN o_orderkey IS NULL THEN 'visit not staged' WHEN code = '201' THEN NULL
                  ELSE 'visit not delivered' END AS reason
             FROM waiting LEFT JOIN staff ON patient_id = s_suppkey LEFT JOIN visit ON visit_id = o_orderkey)
    SELECT *, CASE WHEN reason IS NULL THEN 'ready' ELSE 'blocked' END AS state FROM told""")
def gate_on_parent(t: Tables) -> DataFrame:
    return delivery.gate_encounters(waiting_encounters(t), staff_as_patients(t), sent_visits(t))


@query("gate_visit", f"""
    WITH visit AS (SELECT o_orderkey AS visit_id, o_custkey AS patient_id, o_orderdate AS date_started, {ANSWER_SQL} AS code,
             CASE WHEN {ANSWER_SQL} = '201' THEN 'V-' || o_orderkey END AS target_visit_uuid FROM orders),
         told AS (SELECT visit.*, p.target_patient_uuid AS uuid,
             CASE WHEN target_visit_uuid IS NOT NULL THEN 'delivered' WHEN person_id IS NULL THEN 'blocked'
                  WHEN p.target_patient_uuid IS NOT NULL THEN 'ready' ELSE 'refused' END AS state
             FROM visit LEFT JOIN ({PATIENTS_SQL}) p ON patient_id = person_id)
    SELECT visit_id, patient_id, date_started, target_visit_uuid, state,
           CASE WHEN state = 'refused' THEN 'Patient is Missing' ELSE uuid END AS target_patient_uuid,
           CASE WHEN state = 'refused' THEN '400' ELSE code END AS response_code FROM told""")
def gate_visit(t: Tables) -> DataFrame:
    return delivery.gate_visits(sent_visits(t), t.patients)


ENROLMENT_SQL = f"""SELECT event_id AS patient_program_id, user_id AS patient_id, ts AS date_enrolled,
    CASE WHEN value > 100 THEN ts END AS date_completed, {code_of_sql('event_type', PROGRAM_OF_EVENT)} AS program_uuid,
    {code_of_sql('event_type', PROGRAM_ID_OF_EVENT, 0)} AS program_id FROM events"""


def enrolments(t: Tables) -> DataFrame:
    rows = t.events.select(
        F.col("event_id").alias("patient_program_id"), F.col("user_id").alias("patient_id"), F.col("ts").alias("date_enrolled"),
        F.when(F.col("value") > 100, F.col("ts")).alias("date_completed"),
        code_of("event_type", PROGRAM_OF_EVENT).alias("program_uuid"), code_of("event_type", PROGRAM_ID_OF_EVENT, 0).alias("program_id"))
    mapped = dictionaries.map_codes(rows, dictionaries.programs(t.spark), "program_uuid", "program_uuid", "")
    known = t.patients.select(F.col("person_id").alias("patient_id"), "target_patient_uuid")
    return mapped.join(known, "patient_id", "left").withColumn("response_code", F.lit(None).cast("string"))


@query("gate_program", f"""
    SELECT patient_program_id, coalesce(d.target_program_uuid, '') AS target_program_uuid, target_patient_uuid,
           CASE WHEN coalesce(d.target_program_uuid, '') <> '' OR target_patient_uuid IS NOT NULL THEN 'ready' ELSE 'refused' END AS state,
           CASE WHEN coalesce(d.target_program_uuid, '') <> '' OR target_patient_uuid IS NOT NULL THEN NULL ELSE '400' END AS response_code
    FROM ({ENROLMENT_SQL}) e LEFT JOIN {PROGRAMS_SQL} USING (program_uuid)
    LEFT JOIN ({PATIENTS_SQL}) p ON e.patient_id = p.person_id""")
def gate_program(t: Tables) -> DataFrame:
    return delivery.gate_programs(enrolments(t)).select(
        "patient_program_id", "target_program_uuid", "target_patient_uuid", "state", "response_code")


# ---- delivery, each document once ---------------------------------------------------------------------------

NOON = "TIMESTAMP_NTZ'2024-03-01 12:00:00'"


def visit_papers(t: Tables) -> DataFrame:
    return documents.visit_documents(t.orders.select(
        F.col("o_orderkey").alias("visit_id"), F.concat(F.lit("P-"), F.col("o_custkey").cast("string")).alias("target_patient_uuid"),
        F.col("o_orderdate").alias("date_started"), F.lit(None).cast("timestamp_ntz").alias("date_stopped")))


@query("numbered_queue", """
    SELECT o_orderkey AS visit_id, row_number() OVER (ORDER BY o_orderstatus <> 'F', o_orderkey) AS queue_number FROM orders""")
def numbered_queue(t: Tables) -> DataFrame:
    """The finished visits are queued, then all, then all again: each once, oldest first behind what was queued before."""
    box = outbox.Outbox(t.spark, t.scratch("outbox"))
    finished = t.orders.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("visit_id"))
    papers = visit_papers(t)
    for rows in (papers.join(finished, "visit_id", "left_semi"), papers, papers):
        box.put(rows, "visit", "visit_id")
    return box.queue.staged().select(F.col("key").cast("long").alias("visit_id"), "queue_number")


def delivered_in_rounds(t: Tables) -> outbox.Outbox:
    """Four rounds of sending at 12:00, 12:03, 12:07 and 13:30, each run twice.  By the last digit of the visit id the receiver
    answers 201 at once (0 to 3), 500 and then 201 (4 to 6), always 500 (7, 8), or never (9)."""
    box = outbox.Outbox(t.spark, t.scratch("outbox"), retry_minutes=5, timeout_minutes=60)
    box.put(visit_papers(t), "visit", "visit_id")
    for minute in (0, 3, 7, 90):
        now = F.expr(f"{NOON} + INTERVAL {minute} MINUTE")
        sent = box.send(now)
        box.send(now)  # what is on its way is not sent again
        digit = F.pmod(F.col("key").cast("long"), F.lit(10))
        good = (digit <= 3) | ((digit <= 6) & (F.col("attempt") > 1))
        answers = sent.where(digit < 9).select("queue_number", "attempt", now.alias("at"), F.when(good, "201").otherwise("500").alias("code"), F.when(good, F.concat(F.lit("V-"), "key")).alias("uuid"))
        box.answer(answers)
        box.answer(answers)  # answers may come twice
    return box


@query("outbox_rounds", """
    SELECT o_orderkey AS visit_id, CASE WHEN d <= 6 THEN 'delivered' WHEN d <= 8 THEN 'retry' ELSE 'sent' END AS state,
           CASE WHEN d <= 3 THEN 1 WHEN d <= 6 THEN 2 WHEN d <= 8 THEN 3 ELSE 2 END AS attempt,
           CASE WHEN d <= 6 THEN '201' WHEN d <= 8 THEN '500' END AS code, CASE WHEN d <= 6 THEN 'V-' || o_orderkey END AS target_uuid,
           CASE WHEN d <= 6 THEN NULL WHEN d <= 8 THEN TIMESTAMP '2024-03-01 13:50:00' ELSE TIMESTAMP '2024-03-01 14:30:00' END AS due_at
    FROM (SELECT *, o_orderkey % 10 AS d FROM orders)""")
def outbox_rounds(t: Tables) -> DataFrame:
    """A 201 ends it, a 500 comes due after five minutes, then ten, then twenty, and silence after an hour."""
    told = delivered_in_rounds(t).states(F.expr(f"{NOON} + INTERVAL 95 MINUTE"))
    return told.select(F.col("key").cast("long").alias("visit_id"), "state", "attempt", "code", "target_uuid", "due_at")


@query("outbox_attempts", """
    SELECT o_orderkey AS visit_id, unnest(CASE WHEN d <= 3 THEN [0] WHEN d <= 6 THEN [0, 7] WHEN d <= 8 THEN [0, 7, 90] ELSE [0, 90] END) AS minute
    FROM (SELECT *, o_orderkey % 10 AS d FROM orders)""")
def outbox_attempts(t: Tables) -> DataFrame:
    """When each document was sent: never while it is on its way, waits or has been delivered."""
    box = delivered_in_rounds(t)
    sent = box.events.staged().where("event = 'sent'")
    minute = F.timestamp_diff("MINUTE", F.expr(NOON), F.col("at")).cast("int").alias("minute")
    return sent.select("queue_number", "at").join(box.queue.staged().select("queue_number", "key"), "queue_number").select(F.col("key").cast("long").alias("visit_id"), minute)


# ---- identifiers from a pool --------------------------------------------------------------------------------


@query("allocate_identifiers", f"""
    WITH first AS (SELECT c_custkey, row_number() OVER (ORDER BY substr(md5(CAST(c_custkey AS VARCHAR)), 1, 3), c_custkey) AS n
                   FROM customer WHERE c_mktsegment = 'BUILDING'),
         second AS (SELECT c_custkey, (SELECT count(*) FROM first)
                        + row_number() OVER (ORDER BY substr(md5(CAST(c_custkey AS VARCHAR)), 1, 3), c_custkey) AS n
                    FROM customer WHERE c_mktsegment <> 'BUILDING'),
         pool AS (SELECT p_partkey AS identifier, row_number() OVER (
                      ORDER BY substr(md5(CAST(p_partkey AS VARCHAR)), 1, 3), p_partkey) AS n
                  FROM part WHERE p_type <> 'PROMO')
    SELECT c_custkey AS patient_id, '{fixed.GENERATED_IDENTIFIER_TYPE}' AS type_uuid, '{fixed.GENERATED_IDENTIFIER_TYPE}' AS target_type_uuid,
           CAST(identifier AS VARCHAR) AS identifier, 'true' AS preferred, CAST(NULL AS BIGINT) AS location_id, CAST(0 AS INTEGER) AS voided,
           '{PARENT}' AS parent_location_uuid
    FROM (SELECT * FROM first UNION ALL SELECT * FROM second) JOIN pool USING (n)""")
def allocate_identifiers(t: Tables) -> DataFrame:
    """Two runs: the patients of one segment, then all; what the first issued is staged and not issued again."""
    pool = t.part.where("p_type <> 'PROMO'").select(F.col("p_partkey").alias("number"))
    everyone = t.customer.select(F.col("c_custkey").alias("person_id"), "c_mktsegment")
    ledger = Ledger.of(t.spark, t.scratch("identifiers"), "identifiers")
    for patients in (everyone.where("c_mktsegment = 'BUILDING'"), everyone):
        ledger.load(lambda staged, patients=patients: registration.issued_identifiers(patients, pool, "number", PARENT, staged))
    return ledger.staged().select(*ledger.schema.names)


# ---- finders ------------------------------------------------------------------------------------------------


@query("find_encounter_mapping", f"""
    SELECT type_id AS encounter_type_id, target_type_id, target_type_uuid
    FROM (SELECT DISTINCT CAST(floor(o_totalprice / 1700) + 1 AS INTEGER) AS type_id FROM orders)
    JOIN {TYPES_SQL} ON type_id = encounter_type_id WHERE target_type_id = 8""")
def find_encounter_mapping(t: Tables) -> DataFrame:
    types = t.orders.select(type_of_price().alias("encounter_type_id")).distinct()
    mapping = dictionaries.map_codes(types, dictionaries.encounter_types(t.spark), "encounter_type_id", "encounter_type_id")
    return finders.find(mapping, "encounter_mapping", "by_target_type", 8)


@query("find_encounters", """
    SELECT DISTINCT o_custkey AS patient_id, o_orderkey AS encounter_id, o_orderdate FROM orders
    WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'A' AND l_quantity > 30)""")
def find_encounters(t: Tables) -> DataFrame:
    """Two-key lookups of a whole batch at once: the orders of large accepted lineitems."""
    staged = t.orders.select(F.col("o_custkey").alias("patient_id"), F.col("o_orderkey").alias("encounter_id"), "o_orderdate")
    big = t.lineitem.where("l_returnflag = 'A' AND l_quantity > 30").select(F.col("l_orderkey").alias("encounter_id"))
    wanted = big.join(staged.select("patient_id", "encounter_id"), "encounter_id")
    return finders.find_each(staged, "encounters", "by_patient_and_encounter", wanted)


@query("find_enrollments", """
    SELECT user_id AS person_id, event_id, ts FROM events WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def find_enrollments(t: Tables) -> DataFrame:
    staged = t.events.select(F.col("user_id").alias("person_id"), "event_id", "ts")
    wanted = t.customer.where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("person_id"))
    return finders.find_each(staged, "enrollments", "by_person", wanted)


@query("find_hiv_enrollment", """
    SELECT l_suppkey AS person_id, l_orderkey AS encounter_id, l_partkey AS concept_id, l_quantity FROM lineitem l
    WHERE EXISTS (SELECT 1 FROM lineitem w WHERE w.l_returnflag = 'R' AND w.l_suppkey = l.l_suppkey
                    AND w.l_orderkey = l.l_orderkey AND w.l_partkey = l.l_partkey)""")
def find_hiv_enrollment(t: Tables) -> DataFrame:
    keys = [F.col("l_suppkey").alias("person_id"), F.col("l_orderkey").alias("encounter_id"), F.col("l_partkey").alias("concept_id")]
    wanted = t.lineitem.where("l_returnflag = 'R'").select(*keys)
    return finders.find_each(t.lineitem.select(*keys, "l_quantity"), "hiv_enrollment", "by_patient_encounter_concept", wanted)


@query("find_identifiers", f"""
    SELECT c_custkey AS patient_id, {code_of_sql('c_mktsegment', IDENTIFIER_TYPE_OF_SEGMENT)} AS type_uuid,
           'NATION_' || c_nationkey AS parent_location_uuid FROM customer WHERE c_mktsegment = 'MACHINERY'""")
def find_identifiers(t: Tables) -> DataFrame:
    staged = t.customer.select(F.col("c_custkey").alias("patient_id"), code_of("c_mktsegment", IDENTIFIER_TYPE_OF_SEGMENT).alias("type_uuid"),
                               F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")).alias("parent_location_uuid"))
    return finders.find(staged, "identifiers", "by_type", IDENTIFIER_TYPE_OF_SEGMENT["MACHINERY"])


@query("find_concept_dictionary", f"""
    SELECT * FROM ({DICTIONARY_SQL}) WHERE source_concept_id IN (SELECT CAST(l_partkey AS VARCHAR) FROM lineitem WHERE l_returnflag = 'R')""")
def find_concept_dictionary(t: Tables) -> DataFrame:
    wanted = t.lineitem.where("l_returnflag = 'R'").select(F.col("l_partkey").cast("string").alias("source_concept_id"))
    staged = t.dictionary.select("source_concept_id", "target_concept_uuid")
    return finders.find_each(staged, "concept_dictionary", "by_source_concept", wanted)


@query("find_obs", """
    SELECT l_suppkey AS person_id, l_orderkey AS encounter_id, l_partkey AS concept_id, l_shipdate FROM lineitem
    WHERE CASE WHEN l_returnflag = 'A' THEN 'U-' || l_orderkey END IS NULL""")
def find_obs(t: Tables) -> DataFrame:
    """A null key looks for nulls: the observations that have no uuid yet."""
    staged = t.lineitem.select(F.col("l_suppkey").alias("person_id"), F.col("l_orderkey").alias("encounter_id"),
                               F.col("l_partkey").alias("concept_id"), "l_shipdate",
                               F.when(F.col("l_returnflag") == "A", F.concat(F.lit("U-"), F.col("l_orderkey").cast("string"))).alias("uuid"))
    return finders.find(staged, "obs", "by_uuid", None).drop("uuid")


@query("find_orders", "SELECT 'O-' || o_orderkey AS uuid, o_orderpriority FROM orders")
def find_orders(t: Tables) -> DataFrame:
    staged = t.orders.select(F.concat(F.lit("O-"), F.col("o_orderkey").cast("string")).alias("uuid"), "o_orderpriority")
    return finders.find(staged, "orders", "all")


@query("find_patients", """
    SELECT c_custkey AS person_id, c_name AS uuid, 'NATION_' || c_nationkey AS parent_location_uuid FROM customer
    WHERE c_custkey IN (SELECT user_id FROM events)""")
def find_patients(t: Tables) -> DataFrame:
    staged = t.customer.select(F.col("c_custkey").alias("person_id"), F.col("c_name").alias("uuid"),
                               F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")).alias("parent_location_uuid"))
    return finders.find_each(staged, "patients", "by_person", t.events.select(F.col("user_id").alias("person_id")))


@query("find_programs", f"""
    SELECT patient_program_id, patient_id, program_id FROM ({ENROLMENT_SQL}) e
    WHERE EXISTS (SELECT 1 FROM events WHERE event_type = 'view' AND value > 100 AND user_id = e.patient_id
                  AND {code_of_sql('event_type', PROGRAM_ID_OF_EVENT, 0)} = e.program_id)""")
def find_programs(t: Tables) -> DataFrame:
    staged = t.events.select(F.col("event_id").alias("patient_program_id"), F.col("user_id").alias("patient_id"),
                             code_of("event_type", PROGRAM_ID_OF_EVENT, 0).alias("program_id"))
    wanted = t.events.where("event_type = 'view' AND value > 100").select(
        F.col("user_id").alias("patient_id"), code_of("event_type", PROGRAM_ID_OF_EVENT, 0).alias("program_id"))
    return finders.find_each(staged, "programs", "by_patient_and_program", wanted)


@query("find_triage", """
    SELECT max(l_orderkey) AS id, arg_max(total, l_orderkey) AS highest
    FROM (SELECT l_orderkey, max(l_quantity) AS total FROM lineitem GROUP BY l_orderkey)""")
def find_triage(t: Tables) -> DataFrame:
    staged = t.lineitem.groupBy(F.col("l_orderkey").alias("id")).agg(F.max("l_quantity").alias("highest"))
    return finders.find(staged, "triage", "latest")


@query("find_users", f"""
    SELECT uuid, parent_location_uuid, s_nationkey, id, load_number FROM (
        SELECT s_name AS uuid, '{PARENT}' AS parent_location_uuid, s_nationkey, {uuid_sql('s_name', f"'{PARENT}'")} AS id,
               CAST(CASE WHEN s_acctbal < 0 THEN 1 ELSE 2 END AS BIGINT) AS load_number FROM supplier)
    ORDER BY load_number DESC, id DESC LIMIT 1""")
def find_users(t: Tables) -> DataFrame:
    """Two loads; the newest row is of the second, whatever the ids of the first are."""
    rows = t.supplier.select(F.col("s_name").alias("uuid"), F.lit(PARENT).alias("parent_location_uuid"), "s_nationkey", "s_acctbal")
    loads_ = [writers.with_stored_columns(rows.where(part).drop("s_acctbal"), "users", n) for n, part in ((1, "s_acctbal < 0"), (2, "s_acctbal >= 0"))]
    return finders.find(loads_[0].unionByName(loads_[1]), "users", "latest")


@query("find_visits", f"SELECT o_orderkey AS visit_id, o_custkey AS patient_id FROM orders WHERE {ANSWER_SQL} IS NULL")
def find_visits(t: Tables) -> DataFrame:
    return finders.find(sent_visits(t), "visits", "pending").select("visit_id", "patient_id")


@query("find_locations", """
    SELECT c_custkey AS child_id, 'NATION_' || c_nationkey AS parent_uuid, CASE WHEN c_acctbal >= 0 THEN 1 ELSE 0 END AS status
    FROM customer WHERE c_nationkey = 11 AND c_acctbal >= 0""")
def find_locations(t: Tables) -> DataFrame:
    return finders.find(sites(t), "locations", "by_parent_and_status", "NATION_11", 1)


@query("find_location_parents", "SELECT DISTINCT 'NATION_' || c_nationkey AS parent_uuid FROM customer WHERE c_acctbal >= 0")
def find_location_parents(t: Tables) -> DataFrame:
    return finders.find(sites(t), "locations", "active_parents")


def sites(t: Tables) -> DataFrame:
    return t.customer.select(
        F.col("c_custkey").alias("child_id"), F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")).alias("parent_uuid"),
        (F.col("c_acctbal") >= 0).cast("int").alias("status"))


@query("find_latest_events", """
    SELECT event_id AS id, user_id, event_type FROM events ORDER BY event_id DESC LIMIT 1""")
def find_latest_events(t: Tables) -> DataFrame:
    return choose.latest(t.events.select(F.col("event_id").alias("id"), "user_id", "event_type"), "id")
