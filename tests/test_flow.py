"""From source rows to answered documents, over two runs."""

import datetime
import json

from pyspark.sql import functions as F

from chartmill.functions.columns import natural_uuid
from chartmill.operators import delivery, documents
from chartmill.plans import care
from chartmill.schemas import source_schema, staged_schema
from chartmill.sources import readers, writers

DAY = datetime.datetime(2021, 5, 1)


def source(spark, name, rows):
    schema = source_schema(name)
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema) for r in rows], schema)


def clinic(spark, last):
    """Encounters 1..last of patients 1-4; patient 4 is not staged, every third encounter has no visit."""
    rows = [{"encounter_id": i, "patient_id": 1 + i % 4, "encounter_type": 14, "location_id": 1, "voided": 0,
             "visit_id": None if i % 3 == 0 else i // 2, "encounter_datetime": DAY} for i in range(1, last + 1)]
    return {
        "encounter": source(spark, "encounter", rows),
        "encounter_type": source(spark, "encounter_type", [{"encounter_type_id": 14, "name": "T"}]),
        "location": source(spark, "location", [{"location_id": 1, "uuid": "L"}]),
        "visit": source(spark, "visit", [{"visit_id": i, "voided": 0, "date_started": DAY} for i in range(0, last)]),
    }


def test_two_runs(spark, tmp_path):
    patients = spark.createDataFrame([(1, "P1"), (2, "P2"), (3, None)], "person_id long, target_patient_uuid string")
    paths = {name: f"{tmp_path}/{name}" for name in ("encounters", "visits", "outbox")}

    counts = []

    def staged(name):
        return readers.read_staged(spark, paths[name], staged_schema(name), first_run=not counts)

    for last in (20, 20, 33):
        src = clinic(spark, last)
        writers.append_rows(care.visits(src, patients, ["L"], staged("visits"), look_back=None), paths["visits"])
        writers.append_rows(care.encounters(src, patients, ["L"], staged("encounters"), look_back=5), paths["encounters"])
        counts.append((staged("visits").count(), staged("encounters").count()))
    assert counts[0] == counts[1] and counts[2][1] == sum(1 for i in range(1, 34) if i % 4 != 3)
    assert staged("encounters").select("encounter_id").distinct().count() == counts[2][1]

    # Visits: ready where the patient has a target uuid, refused where not.
    gated = delivery.gate_visits(staged("visits"), patients)
    states = {r["state"]: r["n"] for r in gated.groupBy("state").agg(F.count("*").alias("n")).collect()}
    assert set(states) == {"ready", "refused"} and sum(states.values()) == counts[2][0]
    ready = gated.where("state = 'ready'")
    writers.write_outbox(documents.visit_documents(ready), paths["outbox"], "visit")
    queued = spark.read.parquet(paths["outbox"]).where("entity = 'visit'")
    assert queued.count() == states["ready"]
    assert all("patient" in json.loads(r["document"]) for r in queued.collect())

    # The receiver takes some of them.
    ledger = queued.select("visit_id", F.lit(1).alias("attempt"), F.when(F.col("visit_id") % 4 == 0, "201").otherwise("500").alias("code"),
                           natural_uuid("visit_id").alias("uuid"))
    visits = delivery.apply_responses(gated.drop("state"), ledger, "visit_id", delivery.CREATED_ONLY, "target_visit_uuid")
    after = {r["visit_id"]: r for r in visits.withColumn("s", delivery.delivery_state()).collect()}
    assert {r["s"] for r in after.values()} == {"pending", "delivered", "rejected"}
    assert all((r["s"] == "delivered") == (r["target_visit_uuid"] is not None) for r in after.values())

    # Encounters follow their visits; every one is ready or blocked, and only the ready ones are rendered.
    encounters = delivery.gate_encounters(staged("encounters"), patients, visits)
    rows = encounters.collect()
    assert len(rows) == counts[2][1]
    for r in rows:
        visit = after.get(r["visit_id"])
        free = r["visit_id"] is None or (visit is not None and visit["s"] == "delivered")
        assert (r["state"] == "ready") == free
    rendered = documents.encounter_documents(encounters.where("state = 'ready'")).collect()
    assert len(rendered) == sum(r["state"] == "ready" for r in rows)
    assert {("visit" in json.loads(r["document"])) for r in rendered} == {True, False}
