import datetime as dt

from pyspark.sql import functions as F

from vellum.operators import state

E, C = state.EXTRACT, state.CAPTION


def log(spark, *steps):
    """(kind or status, stage, error, details) in order, one minute apart."""
    rows = []
    for k, (status, stage, error, details) in enumerate(steps):
        done = status == "completed"
        rows.append(("p", k, "completed" if done else "stage", stage, None if done else status, f"m{k}", error, details or {}, int(status == "in_progress"), dt.datetime(2024, 1, 1, 0, k)))
    return spark.createDataFrame(rows, state.EVENTS_SCHEMA)


def folds(events):
    return {r.stage: r for r in state.fold_stages(events).collect()}, state.fold_manifest(events).first()


def test_fresh(spark):
    s, m = folds(log(spark, ("in_progress", E, None, None), ("succeeded", E, None, None), ("skipped", C, None, None), ("completed", None, None, None)))
    assert (s[E].status, s[E].attempts, s[C].status, m.batch_status, m.failed_stage, m.current_stage) == ("succeeded", 1, "skipped", "succeeded", None, C)


def test_failure_stands_until_completion(spark):
    steps = [("in_progress", E, None, None), ("failed", E, "e1", None), ("in_progress", E, None, None)]
    s, m = folds(log(spark, *steps))
    assert (m.batch_status, m.failed_stage, m.final_error, s[E].attempts) == ("running", E, "e1", 2)
    assert (s[E].started_at.minute, s[E].completed_at.minute, s[E].error) == (0, 1, None)
    s, m = folds(log(spark, *steps, ("succeeded", E, None, None), ("skipped", C, None, None), ("completed", None, None, None)))
    assert (m.batch_status, m.failed_stage, m.final_error, s[E].started_at.minute) == ("succeeded", None, None, 0)


def test_failure_without_error_takes_the_message(spark):
    assert folds(log(spark, ("failed", E, None, None)))[1].final_error == "m0"


def test_details_merge(spark):
    s, _ = folds(log(spark, ("succeeded", E, None, {"a": "1"}), ("succeeded", E, None, {"a": "2", "b": "3"}), ("succeeded", E, None, {})))
    assert s[E].details == {"a": "2", "b": "3"}


def test_resume(spark):
    jobs = spark.createDataFrame([("p",), ("q",)], "paper_key string")
    for status, left in (("in_progress", 2), ("failed", 2), ("skipped", 2), ("succeeded", 1)):
        folded = state.fold_stages(log(spark, (status, E, None, None)))
        assert state.pending(jobs, folded, E).count() == left
        assert state.pending(jobs, folded, E, enabled=False).count() == 2


def test_manifest_round_trip_and_corrupt(spark):
    jobs = spark.createDataFrame([("p", "/in/p.pdf"), ("q", "/in/q.pdf")], "paper_key string, pdf_path string")
    m = state.manifests(jobs, log(spark, ("succeeded", E, None, {"markdown_path": "/x.md"})), F.lit("/out"))
    back = {r.paper_key: r for r in state.from_json(state.to_json(m)).collect()}
    assert back["p"].output_paths["markdown"] == "/x.md"
    assert back["p"].output_paths["pdf"] == "/in/p.pdf"
    assert back["q"].batch_status == "not_started"
    assert (back["q"].input_snapshot["input_value"], back["q"].selected_source["source_name"]) == ("/in/q.pdf", "local_pdf")
    assert '"title":"q"' in back["q"].paper_snapshot
    assert set(back["q"].stage_states) == set(state.STAGES)
    bad = spark.createDataFrame([("{oops",), ("null",), ('{"paper_key": "z", "created_at": "t", "updated_at": ""}',)], "json string")
    rows = state.from_json(bad).collect()
    assert [r.load_error is None for r in rows] == [False, False, True]
    assert (rows[2].updated_at, rows[2].manifest_version, len(rows[2].stage_states)) == ("t", 1, 7)
