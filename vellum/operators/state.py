"""Per-document state as a fold of an append-only event log.

``stage_events(paper_key, seq, kind, stage, status, message, error, details,
attempt_inc, ts)``; kind is ``stage`` for a stage's transition or ``completed``
for the end of a run.  ``seq`` is total per key and set by the driver, never by
a clock.  Both folds are plain hash aggregations with map-side partials.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.functions import paths, records

STAGES = ("parse_input", "fetch_metadata", "recover_identifiers", "resolve_source", "download_pdf", "extract_markdown", "caption_markdown")
ACQUISITION, EXTRACT, CAPTION = STAGES[:5], STAGES[5], STAGES[6]
TERMINAL = ("succeeded", "failed", "skipped")
VERSION = 1

EVENTS_SCHEMA = "paper_key string, seq bigint, kind string, stage string, status string, message string, error string, details map<string,string>, attempt_inc int, ts timestamp"


def stage_dimension(spark: SparkSession) -> DataFrame:
    """``(ord, stage)`` in order: seven constant rows."""
    return spark.createDataFrame(list(enumerate(STAGES)), "ord int, stage string")


def next_stages(spark: SparkSession) -> DataFrame:
    """Each stage with its successor, null at the end."""
    rows = [(s, n) for s, n in zip(STAGES, (*STAGES[1:], None), strict=True)]
    return spark.createDataFrame(rows, "stage string, next_stage string")


def is_terminal(status: Column) -> Column:
    return status.isin(*TERMINAL)


def iso(ts: Column) -> Column:
    """UTC, whole seconds, ``+00:00``."""
    return F.date_format(F.date_trunc("second", ts), "yyyy-MM-dd'T'HH:mm:ssxxx")


def now_iso() -> Column:
    return iso(F.current_timestamp())


def merged(details: Column) -> Column:
    """Maps of an array merged in order; later keys win."""
    empty = F.create_map().cast("map<string,string>")
    return F.aggregate(details, empty, lambda acc, x: F.map_concat(F.map_filter(acc, lambda k, _: ~F.map_contains_key(x, k)), x))


def fold_stages(events: DataFrame) -> DataFrame:
    """One row per document and stage that has events.

    ``started_at`` is the first start or end and stays; ``completed_at`` the
    last end, which a later start doesn't clear; status, message and error are
    the last event's; empty details are ignored.
    """
    e = events.where("kind = 'stage'")
    begun = F.col("status").isin("in_progress", *TERMINAL)
    full = F.size(F.coalesce("details", F.create_map().cast("map<string,string>"))) > 0
    return e.groupBy("paper_key", "stage").agg(
        F.max_by(F.struct("status", "message", "error"), "seq").alias("last"),
        F.sum(F.coalesce("attempt_inc", F.lit(0))).cast("bigint").alias("attempts"),
        F.min_by("ts", F.when(begun, F.col("seq"))).alias("started_at"),
        F.max_by("ts", F.when(is_terminal(F.col("status")), F.col("seq"))).alias("completed_at"),
        merged(F.transform(F.sort_array(F.collect_list(F.when(full, F.struct("seq", F.map_entries("details").alias("entries"))))), lambda x: F.map_from_entries(x["entries"]))).alias("details"),
    ).select("paper_key", "stage", "last.status", "attempts", "started_at", "completed_at", "last.message", "last.error", "details")


def fold_manifest(events: DataFrame) -> DataFrame:
    """One row per document: batch status, current stage, and the failure that stands.

    A failure stands until a run completes; a start after it sets the batch
    running but leaves it; successes and skips don't touch the batch.
    """
    stage, failed, running, done = F.col("kind") == "stage", F.col("status") == "failed", F.col("status") == "in_progress", F.col("kind") == "completed"
    state = F.when(done, "succeeded").when(stage & failed, "failed").when(stage & running, "running")
    out = events.groupBy("paper_key").agg(
        F.min_by("ts", "seq").alias("created_at"),
        F.max_by("ts", "seq").alias("updated_at"),
        F.max_by("stage", F.when(stage, F.col("seq"))).alias("current_stage"),
        F.max_by(state, F.when(state.isNotNull(), F.col("seq"))).alias("batch_status"),
        F.max_by(F.struct("stage", F.coalesce("error", "message").alias("error")), F.when(stage & failed, F.col("seq"))).alias("failure"),
        F.max(F.when(stage & failed, F.col("seq"))).alias("failed_seq"),
        F.max(F.when(done, F.col("seq"))).alias("done_seq"),
    )
    stands = F.col("failed_seq").isNotNull() & (F.col("done_seq").isNull() | (F.col("failed_seq") > F.col("done_seq")))
    return out.select("paper_key", "created_at", "updated_at", F.coalesce("batch_status", F.lit("not_started")).alias("batch_status"), "current_stage", F.when(stands, F.col("failure.stage")).alias("failed_stage"), F.when(stands, F.col("failure.error")).alias("final_error"))


def filled_stages(keys: DataFrame, folded: DataFrame) -> DataFrame:
    """All seven stages of every key; those without events are not started."""
    every = keys.select("paper_key").withColumn("s", F.explode(F.array(*[F.struct(F.lit(k).alias("ord"), F.lit(s).alias("stage")) for k, s in enumerate(STAGES)]))).select("paper_key", "s.ord", "s.stage")
    return every.join(folded, ["paper_key", "stage"], "left").select(
        "paper_key", "ord", "stage", F.coalesce("status", F.lit("not_started")).alias("status"), F.coalesce("attempts", F.lit(0)).cast("bigint").alias("attempts"),
        "started_at", "completed_at", "message", "error", F.coalesce("details", F.create_map().cast("map<string,string>")).alias("details"),
    )


def pending(jobs: DataFrame, folded: DataFrame, stage: str, enabled: bool = True, skip_completed: bool = True) -> DataFrame:
    """Jobs whose stage has not succeeded: in progress, failed or skipped ones run again."""
    if not (enabled and skip_completed):
        return jobs
    done = folded.where((F.col("stage") == stage) & (F.col("status") == "succeeded")).select("paper_key")
    return jobs.join(done, "paper_key", "left_anti")


def manifests(jobs: DataFrame, events: DataFrame, root: Column) -> DataFrame:
    """The manifest view: every job's state, planned paths, and stages by name.

    ``jobs(paper_key, pdf_path)`` give the snapshots of input, paper and source,
    which so are always the last run's; the latest output paths and statistics come
    out of the details of the stages.
    """
    stages = filled_stages(jobs, fold_stages(events))
    entry = F.struct("status", "attempts", iso(F.col("started_at")).alias("started_at"), iso(F.col("completed_at")).alias("completed_at"), "message", "error", "details")
    by_key = stages.groupBy("paper_key").agg(
        F.map_from_entries(F.collect_list(F.struct("stage", entry.alias("state")))).alias("stage_states"),
        *[F.max_by("details", F.when(F.col("stage") == s, F.lit(1))).alias(n) for s, n in ((EXTRACT, "extraction"), (CAPTION, "captioning"))],
    )
    none = F.create_map().cast("map<string,string>")
    path = lambda d, *keys: F.coalesce(*[F.nullif(F.try_element_at(F.col(d), F.lit(k)), F.lit("")) for k in keys])
    found = F.map_filter(F.create_map(F.lit("markdown"), path("extraction", "markdown_path"), F.lit("captioned_markdown"), path("captioning", "captioned_markdown_path", "markdown_path")), lambda _, v: v.isNotNull())
    planned = paths.output_paths(root, F.col("paper_key"))
    merged_paths = F.map_concat(F.map_filter(planned, lambda k, _: ~F.map_contains_key(found, k)), found, F.create_map(F.lit("pdf"), F.col("pdf_path")))
    return jobs.join(fold_manifest(events), "paper_key", "left").join(by_key, "paper_key").select(
        F.lit(VERSION).alias("manifest_version"), "paper_key", iso(F.col("created_at")).alias("created_at"), iso(F.coalesce("updated_at", "created_at")).alias("updated_at"),
        F.coalesce("batch_status", F.lit("not_started")).alias("batch_status"), "current_stage", "failed_stage", "final_error",
        F.create_map(F.lit("input_type"), F.lit("local_pdf"), F.lit("input_value"), F.col("pdf_path")).alias("input_snapshot"), F.to_json(records.from_local_pdf(F.col("paper_key"), F.col("pdf_path"))).alias("paper_snapshot"),
        records.selected_source(F.col("pdf_path")).alias("selected_source"), merged_paths.alias("output_paths"), F.create_map(F.lit("extraction"), F.coalesce("extraction", none), F.lit("captioning"), F.coalesce("captioning", none)).alias("stats"), "stage_states",
    )


STAGE_STATE = "struct<status:string,attempts:bigint,started_at:string,completed_at:string,message:string,error:string,details:map<string,string>>"
MANIFEST_SCHEMA = f"manifest_version int, paper_key string, created_at string, updated_at string, batch_status string, current_stage string, failed_stage string, final_error string, input_snapshot map<string,string>, paper_snapshot string, selected_source map<string,string>, output_paths map<string,string>, stats map<string,map<string,string>>, stage_states map<string,{STAGE_STATE}>"


def to_json(rows: DataFrame) -> DataFrame:
    """``(paper_key, json)``, null fields included."""
    return rows.select("paper_key", F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}).alias("json"))


def from_json(rows: DataFrame) -> DataFrame:
    """Manifests of ``rows(json)`` with defaults: version 1, updated_at as created_at, empty maps, all stages present.

    ``load_error`` says why a text can't be read; other rows are unharmed.
    """
    x = F.col("m")
    parsed = rows.withColumn("m", F.from_json("json", f"struct<{MANIFEST_SCHEMA.replace(', ', ',').replace(' ', ':')},_corrupt:string>", {"columnNameOfCorruptRecord": "_corrupt"}))
    bad = x.isNull() | x["_corrupt"].isNotNull() | x["paper_key"].isNull()
    empty = F.create_map().cast("map<string,string>")
    blank = F.struct(F.lit("not_started").alias("status"), F.lit(0).cast("bigint").alias("attempts"), *[F.lit(None).cast("string").alias(k) for k in ("started_at", "completed_at", "message", "error")], empty.alias("details"))
    have = F.coalesce(x["stage_states"], F.create_map().cast(f"map<string,{STAGE_STATE}>"))
    fill = F.map_from_arrays(F.array(*map(F.lit, STAGES)), F.array(*[F.coalesce(F.try_element_at(have, F.lit(s)), blank) for s in STAGES]))
    defaulted = F.transform_values(fill, lambda _, s: F.struct(F.coalesce(s["status"], F.lit("not_started")).alias("status"), F.coalesce(s["attempts"], F.lit(0)).cast("bigint").alias("attempts"), s["started_at"].alias("started_at"), s["completed_at"].alias("completed_at"), s["message"].alias("message"), s["error"].alias("error"), F.coalesce(s["details"], empty).alias("details")))
    return parsed.select(
        F.coalesce(x["manifest_version"], F.lit(VERSION)).alias("manifest_version"), x["paper_key"].alias("paper_key"), x["created_at"].alias("created_at"),
        F.coalesce(F.nullif(x["updated_at"], F.lit("")), x["created_at"]).alias("updated_at"), F.coalesce(x["batch_status"], F.lit("not_started")).alias("batch_status"),
        x["current_stage"].alias("current_stage"), x["failed_stage"].alias("failed_stage"), x["final_error"].alias("final_error"),
        F.coalesce(x["input_snapshot"], empty).alias("input_snapshot"), x["paper_snapshot"].alias("paper_snapshot"), F.coalesce(x["selected_source"], empty).alias("selected_source"),
        F.coalesce(x["output_paths"], empty).alias("output_paths"), F.coalesce(x["stats"], F.create_map().cast("map<string,map<string,string>>")).alias("stats"), defaulted.alias("stage_states"),
        F.when(bad, F.concat(F.lit("manifest can't be read: "), F.substring(F.coalesce("json", F.lit("")), 1, 200))).alias("load_error"),
    )
