import os

import pytest
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F

from chartmill.operators import delivery, finders, incremental
from chartmill.schemas import STAGED_KEYS, stored_schema
from chartmill.sources import readers, writers
from chartmill.streaming import loads


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def source(spark):
    return spark.createDataFrame([(k, k // 3, f"v{k}") for k in range(1, 31)], "k long, p long, v string")


def test_empty_staging_takes_everything(spark, source):
    empty = spark.createDataFrame([], source.schema)
    assert incremental.after_cursor(source, "k", empty).count() == 30
    assert incremental.before_cursor(source, "k", empty).count() == 30
    assert rows(incremental.idempotent_load(source, empty, ["k"], cursor_key="k")) == rows(source)


def test_cursor_edges(source):
    staged = source.where("k BETWEEN 10 AND 20")
    assert [r[0] for r in rows(incremental.after_cursor(source, "k", staged))] == list(range(21, 31))
    assert incremental.after_cursor(source, "k", staged, inclusive=True).count() == 11
    assert [r[0] for r in rows(incremental.before_cursor(source, "k", staged))] == list(range(1, 10))


def test_cursor_over_times(spark):
    df = spark.sql("SELECT id, timestampadd(DAY, id, TIMESTAMP_NTZ'2024-01-01 00:00:00') AS ts FROM range(10)")
    staged = df.where("id < 5")
    assert incremental.after_cursor(df, "ts", staged).count() == 5
    assert incremental.after_cursor(df, "ts", staged, look_back=F.expr("INTERVAL 2 DAYS")).count() == 7
    with pytest.raises(TypeError):
        incremental.after_cursor(df.select((F.col("id") * 1.5).alias("x")), "x", df, "id")


def test_first_run_and_delta_make_the_full_load(spark, source):
    empty = spark.createDataFrame([], source.schema)
    first = incremental.idempotent_load(source.where("k <= 12"), empty, ["k"], cursor_key="k")
    delta = incremental.idempotent_load(source, first, ["k"], cursor_key="k")
    assert rows(first.unionByName(delta)) == rows(source)
    assert incremental.idempotent_load(source, first.unionByName(delta), ["k"], cursor_key="k").count() == 0


def test_late_rows_need_a_look_back(source):
    staged = source.where("k <= 20 AND k <> 15")
    assert [r[0] for r in rows(incremental.idempotent_load(source, staged, ["k"], cursor_key="k"))] == list(range(21, 31))
    found = incremental.idempotent_load(source, staged, ["k"], cursor_key="k", look_back=10)
    assert [r[0] for r in rows(found)] == [15, *range(21, 31)]
    assert [r[0] for r in rows(incremental.idempotent_load(source, staged, ["k"]))] == [15, *range(21, 31)]


def test_gate_on_nobody_is_empty(spark, source):
    nobody = spark.createDataFrame([], "person_id long")
    empty = spark.createDataFrame([], source.schema)
    assert incremental.idempotent_load(source, empty, ["k"], gate=(nobody, {"p": "person_id"})).count() == 0


def test_the_cursor_reaches_the_scan(spark, source, tmp_path):
    source.write.parquet(f"{tmp_path}/t")
    table = spark.read.parquet(f"{tmp_path}/t")
    staged = table.where("p < 3")
    text = incremental.after_cursor(table, "k", staged)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(k," in text and "SinglePartition" not in text.split("Subquery")[0]


def test_within_range(spark, source):
    batch = source.where("k BETWEEN 5 AND 9")
    assert rows(incremental.within_range(source, batch, "k")) == rows(batch)
    assert incremental.within_range(source, batch.where("false"), "k").count() == 0


def test_stream_equals_batch(spark, source, tmp_path):
    inbox, staged, checkpoint = f"{tmp_path}/in", f"{tmp_path}/staged", f"{tmp_path}/cp"

    def run(range_key=None, first_run=False):
        stream = loads.file_stream(spark, inbox, source.schema, files_per_batch=1)
        loads.stage_stream(stream, staged, checkpoint, ["k"], range_key=range_key, first_run=first_run).awaitTermination()
        return readers.read_staged(spark, staged, source.schema)

    source.where("k <= 12").repartition(3).write.mode("append").parquet(inbox)
    assert rows(run(first_run=True)) == rows(source.where("k <= 12"))
    source.where("k > 8").repartition(2).write.mode("append").parquet(inbox)  # four of them a second time
    assert rows(run("k")) == rows(source)
    assert rows(run("k")) == rows(source)
    # A lost checkpoint replays everything and still adds nothing.
    stream = loads.file_stream(spark, inbox, source.schema)
    loads.stage_stream(stream, staged, f"{tmp_path}/cp2", ["k"], range_key="k").awaitTermination()
    assert rows(readers.read_staged(spark, staged, source.schema)) == rows(source)


def test_stream_on_a_clock(spark, source, tmp_path):
    source.write.parquet(f"{tmp_path}/in")
    stream = loads.file_stream(spark, f"{tmp_path}/in", source.schema)
    running = loads.stage_stream(stream, f"{tmp_path}/staged", f"{tmp_path}/cp", ["p"], order=["k"], every="1 second", first_run=True)
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    assert sorted(r[0] for r in rows(readers.read_staged(spark, f"{tmp_path}/staged", source.schema))) == [1, *range(3, 31, 3)]


def test_read_staged_before_and_after_the_first_load(spark, source, tmp_path):
    path = f"{tmp_path}/none"
    with pytest.raises(AnalysisException):
        readers.read_staged(spark, path, source.schema)
    assert readers.read_staged(spark, path, source.schema, first_run=True).count() == 0
    writers.append_rows(source, path)
    assert readers.read_staged(spark, path, source.schema).count() == 30


def test_upsert_and_snapshot(spark, tmp_path):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    source = spark.createDataFrame([("B", 2), ("C", 3)], "v string, k int")
    merged = writers.upsert(target, source, ["k"])
    assert rows(merged) == [(1, "a"), (2, "B"), (3, "C")]
    assert rows(writers.write_snapshot(merged, f"{tmp_path}/v1")) == rows(merged)
    with pytest.raises(PySparkException):
        writers.write_snapshot(merged, f"{tmp_path}/v1")


def test_row_ids_are_unique_and_repeatable(source):
    ids = writers.with_row_id(source, ["k", "p"])
    assert ids.select("row_id").distinct().count() == 30
    assert rows(ids) == rows(writers.with_row_id(source.repartition(3), ["k", "p"]))


def test_outbox(spark, tmp_path):
    docs = spark.createDataFrame([(1, "{}")], "id int, document string")
    writers.write_outbox(docs, f"{tmp_path}/o", "visit")
    writers.write_outbox(docs, f"{tmp_path}/o", "order")
    assert os.path.isdir(f"{tmp_path}/o/entity=visit")
    assert spark.read.parquet(f"{tmp_path}/o").where("entity = 'order'").count() == 1


def test_jdbc_options():
    options = readers.jdbc_options("jdbc:x", "obs", "obs_id", 0, 100, 8, ["obs_id", "value"], driver="d")
    assert options["dbtable"] == "(SELECT obs_id, value FROM obs) t" and options["partitionColumn"] == "obs_id"
    assert options["numPartitions"] == "8" and options["driver"] == "d" and options["lowerBound"] == "0"


def test_dictionary_file(spark, tmp_path):
    lines = ["p,l,u,i,t,c,tp,tl,tu,ti", 'a,"x, ""y""",u1,1,coded,9,b,z,t1,2', "a,,u2,2,coded,,b,z,t2,3"]
    (tmp_path / "d.csv").write_text("\n".join(lines) + "\n")
    got = {r["source_concept_id"]: r for r in readers.read_concept_dictionary(spark, f"{tmp_path}/d.csv").collect()}
    assert got["1"]["source_label"] == 'x, "y"' and got["2"]["source_label"] is None and got["2"]["target_concept_uuid"] == "t2"
    named = readers.read_concept_dictionary(spark, f"{tmp_path}/d.csv", {"i": "source_concept_id", "tu": "target_concept_uuid"})
    assert rows(named) == [("1", "t1"), ("2", "t2")]
    (tmp_path / "bad.csv").write_text(lines[0] + "\na,b\n")
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ_FILE"):
        readers.read_concept_dictionary(spark, f"{tmp_path}/bad.csv").collect()


# ---- delivery -----------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def parents(spark):
    patients = spark.createDataFrame([(1, "P1"), (2, None)], "person_id long, target_patient_uuid string")
    visits = spark.createDataFrame([(10, 1, "201", "V10"), (11, 1, "400", None), (12, 1, None, None)],
                                   "visit_id long, patient_id long, response_code string, target_visit_uuid string")
    return patients, visits


def test_every_encounter_is_ready_or_blocked(spark, parents):
    waiting = spark.createDataFrame([(1, 1, None), (2, 1, 10), (3, 1, 11), (4, 1, 12), (5, 1, 99), (6, 9, None), (7, 2, 10)],
                                    "encounter_id long, patient_id long, visit_id long")
    got = {r["encounter_id"]: (r["state"], r["reason"]) for r in delivery.gate_encounters(waiting, *parents).collect()}
    assert got == {
        1: ("ready", None), 2: ("ready", None), 3: ("blocked", "visit not delivered"), 4: ("blocked", "visit not delivered"),
        5: ("blocked", "visit not staged"), 6: ("blocked", "patient not staged"), 7: ("ready", None)}


def test_visits(spark, parents):
    patients, _ = parents
    visits = spark.createDataFrame([(1, 1, None, None), (2, 2, None, None), (3, 9, None, None), (4, 2, "201", "V4")],
                                   "visit_id long, patient_id long, response_code string, target_visit_uuid string")
    got = {r["visit_id"]: (r["state"], r["response_code"], r["target_patient_uuid"]) for r in delivery.gate_visits(visits, patients).collect()}
    assert got == {1: ("ready", None, "P1"), 2: ("refused", "400", "Patient is Missing"), 3: ("blocked", None, None),
                   4: ("delivered", "201", None)}


def test_programs(spark):
    df = spark.createDataFrame([(1, "m", "p"), (2, "m", None), (3, "", "p"), (4, "", None), (5, None, None)],
                               "id int, target_program_uuid string, target_patient_uuid string").withColumn("response_code", F.lit(None).cast("string"))
    states = lambda out: {r["id"]: r["state"] for r in out.collect()}
    assert states(delivery.gate_programs(df)) == {1: "ready", 2: "ready", 3: "ready", 4: "refused", 5: "refused"}
    assert states(delivery.gate_programs(df, require="all")) == {1: "ready", 2: "refused", 3: "refused", 4: "refused", 5: "refused"}


def test_responses_keep_the_newest_answer(spark):
    sent = spark.createDataFrame([(1, None, None), (2, None, None), (3, "400", None), (4, "201", "U4")],
                                 "id int, response_code string, target_uuid string")
    ledger = spark.createDataFrame([(1, 1, "400", None), (1, 2, "201", "U1"), (2, 1, "201", "U2"), (2, 2, "500", None)],
                                   "id int, attempt int, code string, uuid string")
    always = rows(delivery.apply_responses(sent, ledger, "id", delivery.ALWAYS))
    assert always == [(1, "201", "U1"), (2, "500", None), (3, "400", None), (4, "201", "U4")]
    created = rows(delivery.apply_responses(sent, ledger, "id", delivery.CREATED_ONLY))
    assert created == [(1, "201", "U1"), (2, "201", "U2"), (3, "400", None), (4, "201", "U4")]
    with pytest.raises(ValueError):
        delivery.apply_responses(sent, ledger, "id", "sometimes")


def test_delivery_state_covers_every_row(spark):
    df = spark.createDataFrame([(None,), ("201",), ("400",), ("500",)], "response_code string")
    assert [r[0] for r in df.select(delivery.delivery_state()).collect()] == ["pending", "delivered", "rejected", "rejected"]


# ---- finders ------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("entity,finder", [(e, f) for e, fs in finders.FINDERS.items() for f in fs])
def test_every_finder(spark, entity, finder):
    shape = finders.FINDERS[entity][finder]
    columns = list(shape) if isinstance(shape, tuple) else []
    names = list(dict.fromkeys(["id", "response_code", "status", "parent_uuid", *columns]))
    data = [tuple({"id": i, "response_code": None if i == 2 else 201, "status": 1}.get(n, i) for n in names) for i in (1, 2, 3)]
    df = spark.createDataFrame(data, ", ".join(f"{n} int" for n in names))
    if shape == finders.ALL:
        assert finders.find(df, entity, finder).count() == 3
    elif shape == finders.LATEST:
        assert [r["id"] for r in finders.find(df, entity, finder).collect()] == [3]
    elif shape == finders.PENDING:
        assert [r["id"] for r in finders.find(df, entity, finder).collect()] == [2]
    elif shape == finders.DISTINCT_PARENTS:
        assert rows(finders.find(df, entity, finder)) == [(1,), (2,), (3,)]
    else:
        wanted = {"status": 1}
        key = [wanted.get(c, 2) for c in columns]
        assert [r["id"] for r in finders.find(df, entity, finder, *key).collect()] == [2]
        assert finders.find(df, entity, finder, *[None] * len(columns)).count() == 0
        with pytest.raises(ValueError):
            finders.find(df, entity, finder)
        batch = df.where("id >= 2").select(*columns)
        assert sorted(r["id"] for r in finders.find_each(df, entity, finder, batch).collect()) == [2, 3]


def test_upsert_with_repeated_keys(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    source = spark.createDataFrame([(2, "y"), (2, "x"), (3, "z")], "k int, v string")
    assert rows(writers.upsert(target, source, ["k"])) == [(1, "a"), (2, "x"), (3, "z")]


def test_a_created_answer_is_never_taken_back(spark):
    sent = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    ledger = spark.createDataFrame([(1, 1, "201", "u1"), (1, 2, "500", None), (2, 1, "500", None), (2, 2, "201", "u2"), (2, 3, "201", "u3"), (3, 1, None, None)],
                                   "k int, attempt int, code string, uuid string")
    got = {r["k"]: (r["response_code"], r["target_uuid"]) for r in delivery.apply_responses(sent, ledger, "k", delivery.CREATED_ONLY).collect()}
    assert got == {1: ("201", "u1"), 2: ("201", "u3"), 3: (None, None)}
    always = {r["k"]: r["response_code"] for r in delivery.apply_responses(sent, ledger, "k", delivery.ALWAYS).collect()}
    assert always == {1: "500", 2: "201", 3: None}


def test_a_row_that_waits_is_staged_once_its_parent_is(spark, source, tmp_path):
    """Rows gated out of one batch come with a later one; the staged rows read are limited to the batch's range."""
    inbox, staged, checkpoint, waiting = (f"{tmp_path}/{n}" for n in ("in", "staged", "cp", "waiting"))
    for run, (part, known) in enumerate((("k <= 10", 5), ("k > 10 AND k <= 20", 30), ("k > 20", 30))):
        source.where(part).write.mode("append").parquet(inbox)
        loads.stage_stream(loads.file_stream(spark, inbox, source.schema), staged, checkpoint, ["k"], transform=lambda b, known=known: b.where(f"k <= {known}"),
                           range_key="k", waiting_path=waiting, first_run=run == 0).awaitTermination()
    assert rows(spark.read.schema(source.schema).parquet(staged)) == rows(source)
    found = incremental.within_range(spark.read.schema(source.schema).parquet(staged), source.where("k > 20"), "k")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "scalar-subquery" in plan.lower() or "Subquery" in plan


def test_finders_know_the_stored_schema():
    for entity, methods in finders.FINDERS.items():
        names = set(stored_schema(entity).names)
        for name, shape in methods.items():
            wanted = {finders.LATEST: ("load_number", "id"), finders.PENDING: ("response_code",), finders.DISTINCT_PARENTS: ("parent_uuid", "status"), finders.ALL: ()}.get(shape, shape) if isinstance(shape, str) else shape
            assert set(wanted) <= names, (entity, name, set(wanted) - names)
        assert set(STAGED_KEYS[entity]) <= names


def test_the_newest_row_is_of_the_newest_load(spark):
    rows_ = spark.createDataFrame([(5,), (6,)], "encounter_type_id int")
    stored = writers.with_stored_columns(rows_, "encounter_mapping", 1).unionByName(writers.with_stored_columns(rows_.where("encounter_type_id = 5"), "encounter_mapping", 2))
    assert finders.find(stored.withColumn("person_id", F.lit(1)), "triage", "latest").first()["load_number"] == 2
    given = writers.with_stored_columns(spark.createDataFrame([(1, 2)], "patient_id long, program_id int"), "programs", 1).first()
    assert len(given["uuid"]) == 36 and given["uuid"] != given["id"]
