"""The document pipeline: inputs to extracted and captioned Markdown, with resumable state.

Stage outputs and events are Parquet tables below ``root/tables``; each stage
reads what it needs and appends once, so a lost executor repeats its own
documents only.  Everything expensive runs on jobs that an anti-join has left.

Whatever fails, fails for its document: an extractor or captioner that raises
and a Markdown file that can't be written fail that stage, a manifest that can't
be written is a pipeline error.  A success is logged after its file exists.
"""

from __future__ import annotations

import datetime as dt
import logging
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum import config as configuration
from vellum.config import Config
from vellum.errors import StateStoreError
from vellum.functions import paths
from vellum.operators import artifacts, state
from vellum.operators import caption as captioning
from vellum.operators import extract as extraction
from vellum.sources import export, files

LOGGER = logging.getLogger("vellum")

PUBLIC = ("pdf_path", "success", "markdown_path", "captioned_path", "error", "status", "label")
EXTRACTION_SCHEMA = "paper_key string, md string, details map<string,string>, error string, num_images bigint, num_tables bigint, num_equations bigint, num_headings bigint, run bigint"
CAPTION_SCHEMA = "paper_key string, md string, images_found bigint, images_captioned bigint, images_skipped bigint, elapsed_seconds double, reused boolean, error string, run bigint"


@dataclass(frozen=True)
class Result:
    """What a caller sees of one document."""

    label: str
    status: str
    success: bool
    error: str | None
    pdf_path: str
    captioned_path: str | None
    markdown_path: str | None

    @property
    def effective_markdown(self) -> str | None:
        return self.captioned_path or self.markdown_path


def effective_markdown(captioned, markdown):
    """The captioned path unless it is null or empty."""
    return F.coalesce(F.nullif(captioned, F.lit("")), markdown)


def best_path(*candidates):
    """The first that is neither null nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in candidates])


def outcome(extract_error, caption_error, pipeline_error=None):
    """completed, or the stage that failed."""
    first = F.when(pipeline_error.isNotNull(), "failed_pipeline_error") if pipeline_error is not None else F.when(F.lit(False), "")
    return first.when(extract_error.isNotNull(), "failed_extraction").when(caption_error.isNotNull(), "failed_captioning").otherwise("completed")


def public(results: DataFrame) -> DataFrame:
    return results.select(*PUBLIC)


def failed(results: DataFrame) -> DataFrame:
    return results.where(~F.col("success"))


def summary(results: DataFrame) -> DataFrame:
    """Succeeded, total, and 0 where they agree, else 1."""
    return results.agg(F.count_if("success").alias("succeeded"), F.count("*").alias("total")).withColumn("exit_code", (F.col("succeeded") != F.col("total")).cast("int"))


def enable_logging(level="INFO", log_file=None) -> None:
    """Progress lines of the library, to the console and, if named, a file."""
    LOGGER.setLevel(level.upper())
    handlers: list[logging.Handler] = [logging.StreamHandler()]
    if log_file:
        Path(log_file).parent.mkdir(parents=True, exist_ok=True)
        handlers.append(logging.FileHandler(log_file, "a", "utf-8"))
    for h in handlers:
        h.setFormatter(logging.Formatter("%(asctime)s | %(levelname)s | %(message)s"))
    LOGGER.handlers = handlers


class TableStore:
    """Where stage outputs and events are kept: Parquet tables below ``root/tables``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def path(self, name: str) -> str:
        return f"{self.root}/tables/{name}"

    def table(self, name: str, schema: str) -> DataFrame:
        if not Path(self.path(name)).exists():
            return self.spark.createDataFrame([], schema)
        try:
            return self.spark.read.schema(schema).parquet(self.path(name))
        except Exception as e:
            raise StateStoreError(f"table {name} can't be read: {e}") from e

    def append(self, name: str, rows: DataFrame, mode: str = "append") -> None:
        try:
            rows.write.mode(mode).parquet(self.path(name))
        except Exception as e:
            raise StateStoreError(f"table {name} can't be written: {e}") from e

    def put(self, name: str, rows: DataFrame) -> None:
        """Replace a table."""
        self.append(name, rows, "overwrite")


class Pipeline:
    """One configuration, its tables, and the injected functions.

    ``places`` names files and folders as :mod:`vellum.functions.paths` does,
    ``store`` keeps tables as :class:`TableStore` does.
    """

    def __init__(self, spark: SparkSession, config: Config, extractor: extraction.Extractor | None = None, captioner: captioning.Captioner | captioning.DocumentCaptioner | None = None, *, places=paths, store: TableStore | None = None):
        configuration.validate(config)
        self.spark, self.config = spark, config
        self.extractor = extractor or extraction.command(config)
        whole = getattr(captioner, "documents", False)
        self.captioner = captioner if whole else captioning.with_retries(captioner, config.captioning.max_retries) if captioner else captioning.api(config) if config.captioning.enabled else None
        self.root = str(Path(config.output.root_dir).resolve())
        self.places, self.store = places, store or TableStore(spark, self.root)
        export.ensure_folders(config)

    # ---- tables ----

    def table(self, name: str, schema: str) -> DataFrame:
        return self.store.table(name, schema)

    def append(self, name: str, rows: DataFrame) -> None:
        self.store.append(name, rows)

    def latest(self, name: str, schema: str) -> DataFrame:
        """The last run's row of each document."""
        t = self.table(name, schema)
        columns = [c for c in t.columns if c != "paper_key"]
        return t.groupBy("paper_key").agg(F.max_by(F.struct(*columns), "run").alias("r")).select("paper_key", "r.*")

    def events(self) -> DataFrame:
        return self.table("stage_events", state.EVENTS_SCHEMA)

    def manifests(self, jobs: DataFrame) -> DataFrame:
        return state.manifests(jobs, self.events(), F.lit(self.root))

    # ---- running ----

    def _event(self, rows: DataFrame, run: int, step: int, kind: str, stage: str | None = None, status=None, message: str | None = None, error=None, details=None, attempt: int = 0) -> DataFrame:
        none = F.lit(None).cast("string")
        as_column = lambda x: none if x is None else F.lit(x) if isinstance(x, str) else x
        return rows.select(
            "paper_key", F.lit(run * 1000 + step).cast("bigint").alias("seq"), F.lit(kind).alias("kind"), as_column(stage).alias("stage"), as_column(status).alias("status"), as_column(message).alias("message"),
            as_column(error).alias("error"), (F.create_map().cast("map<string,string>") if details is None else details).alias("details"), F.lit(attempt).alias("attempt_inc"), F.lit(dt.datetime.now(dt.timezone.utc)).alias("ts"),
        )

    def run(self, jobs: DataFrame) -> DataFrame:
        """``jobs(ord, paper_key, pdf_path, label)`` to one full-width result per job, in order of ``ord``."""
        c = self.config
        folded = state.fold_stages(self.events())
        last = self.events().agg(F.max("seq")).first()[0]
        run = 1 if last is None else last // 1000 + 1
        total = jobs.count()
        LOGGER.info("%d documents | starting run %d", total, run)
        log = [self._event(jobs, run, k, "stage", s, "skipped", "not applicable") for k, s in enumerate(state.ACQUISITION)]

        # extraction of jobs that haven't succeeded; outputs that are there already are used again
        resume = c.resume.enabled and not c.resume.force
        todo = state.pending(jobs, folded, state.EXTRACT, resume, c.resume.skip_completed_stages)
        have = self.latest("extraction", EXTRACTION_SCHEMA).where("error is null")
        fresh = todo if c.resume.force else todo.join(have.select("paper_key"), "paper_key", "left_anti")
        o, root, key = c.output, F.lit(self.root), F.col("paper_key")
        raw, md_path, cap_path = self.places.raw_dir(root, key, o.raw_dir_name), self.places.markdown_path(root, key, o.markdown_dir_name), self.places.captioned_path(root, key, o.captioned_markdown_dir_name)
        done = extraction.with_statistics(extraction.extracted(fresh.withColumn("raw_dir", raw).withColumn("md_path", md_path), self.extractor, max(1, self.spark.sparkContext.defaultParallelism), reuse=not c.resume.force))
        self.append("extraction", done.withColumn("run", F.lit(run).cast("bigint")))
        latest = self.latest("extraction", EXTRACTION_SCHEMA)
        texts = todo.select("paper_key").join(latest.where("error is null"), "paper_key")
        summary_path = F.concat(raw, F.lit("/extraction_summary.json"))
        latest = self._written(latest, run, 1, texts.select("paper_key", md_path.alias("path"), F.col("md").alias("text")).unionByName(
            texts.select("paper_key", summary_path.alias("path"), F.to_json(F.struct("num_images", "num_tables", "num_equations", "num_headings", "details")).alias("text"))))
        now = todo.select("paper_key").join(latest, "paper_key")
        LOGGER.info("extraction: %s", self._tally(now))
        fine, counts = F.col("error").isNull(), [F.lit("markdown_path"), md_path]
        for n in ("num_images", "num_tables", "num_equations", "num_headings"):
            counts += [F.lit(n), F.col(n).cast("string")]
        counts += [F.lit("reused_existing"), F.coalesce(F.try_element_at("details", F.lit("reused_existing")), (F.col("run") != run).cast("string"))]
        log += [
            self._event(todo, run, 10, "stage", state.EXTRACT, "in_progress", "extracting markdown", attempt=1),
            self._event(now.where(~fine), run, 11, "stage", state.EXTRACT, "failed", error=F.col("error")),
            self._event(now.where(fine), run, 11, "stage", state.EXTRACT, "succeeded", "markdown extracted", details=F.map_concat(F.map_filter("details", lambda k, _: ~k.isin("markdown_path", "reused_existing", "num_images", "num_tables", "num_equations", "num_headings")), F.create_map(*counts))),
        ]
        good = jobs.join(latest.where("error is null"), "paper_key")

        # captioning
        captioned = None
        if c.captioning.enabled and self.captioner is not None:
            todo2 = state.pending(good, folded, state.CAPTION, resume, c.resume.skip_completed_stages)
            had = self.latest("captions", CAPTION_SCHEMA).where("error is null")
            fresh2 = todo2 if c.resume.force else todo2.join(had.select("paper_key"), "paper_key", "left_anti")
            self.append("captions", self._captioned(fresh2.withColumn("md_path", md_path).withColumn("captioned_path", cap_path)).withColumn("run", F.lit(run).cast("bigint")))
            captioned = self.latest("captions", CAPTION_SCHEMA)
            texts = todo2.select("paper_key").join(captioned.where("error is null"), "paper_key")
            captioned = self._written(captioned, run, 2, texts.select("paper_key", cap_path.alias("path"), F.col("md").alias("text")))
            now2 = todo2.select("paper_key").join(captioned, "paper_key")
            LOGGER.info("captioning: %s", self._tally(now2))
            again = (F.col("run") != run) | F.col("reused")
            stats = [F.lit("captioned_markdown_path"), cap_path, F.lit("reused_existing"), again.cast("string")]
            for n in captioning.COUNTS:
                stats += [F.lit(n), F.when(again, "0").otherwise(F.col(n).cast("string"))]
            log += [
                self._event(todo2, run, 20, "stage", state.CAPTION, "in_progress", "captioning markdown", attempt=1),
                self._event(now2.where("error is not null"), run, 21, "stage", state.CAPTION, "failed", error=F.col("error")),
                self._event(now2.where("error is null"), run, 21, "stage", state.CAPTION, "succeeded", "captioning completed", details=F.create_map(*stats)),
            ]
        else:
            log.append(self._event(good, run, 20, "stage", state.CAPTION, "skipped", "captioning disabled or not configured"))
        ended = good if captioned is None else good.join(captioned.where("error is null").select("paper_key"), "paper_key", "left_semi")
        log.append(self._event(ended, run, 30, "completed"))
        events = log[0]
        for e in log[1:]:
            events = events.unionByName(e)
        self.append("stage_events", events)
        manifests = state.to_json(self.manifests(jobs.select("paper_key", "pdf_path"))).select("paper_key", self.places.manifest_path(root, key, o.manifests_dir_name).alias("path"), F.col("json").alias("text"))
        unsaved = self._written(jobs.select("paper_key", F.lit(None).cast("string").alias("error")), run, 3, manifests).where("error is not null")
        return self._results(jobs, latest, captioned, unsaved, run)

    def _written(self, rows: DataFrame, run: int, step: int, files_: DataFrame) -> DataFrame:
        """``rows`` with ``error`` filled where a document's files can't be written; all others are."""
        name = f"exports/run={run}-{step}"
        self.store.put(name, export.export_texts(files_))  # files are written once
        bad = self.table(name, "paper_key string, path string, error string").where("error is not null")
        bad = bad.groupBy(F.col("paper_key").alias("b_key")).agg(F.min(F.concat("path", F.lit(": "), "error")).alias("b_error"))
        return rows.join(bad, F.col("paper_key") == F.col("b_key"), "left").withColumn("error", F.coalesce("error", "b_error")).drop("b_key", "b_error")

    def _tally(self, rows: DataFrame) -> str:
        n, bad = rows.agg(F.count("*"), F.count("error")).first()
        return f"{n - bad} succeeded, {bad} failed"

    def _captioned(self, todo: DataFrame) -> DataFrame:
        reuse = not self.config.resume.force
        if getattr(self.captioner, "documents", False):
            return captioning.documents(todo, self.captioner, reuse)
        if reuse:
            self.store.put("captions_found", captioning.documents(todo, None, True))
            there = self.table("captions_found", CAPTION_SCHEMA.rpartition(",")[0])
            todo = todo.join(there.select("paper_key"), "paper_key", "left_anti")
        raw = self.places.raw_dir(F.lit(self.root), F.col("paper_key"), self.config.output.raw_dir_name)
        based = todo.select("paper_key", raw.alias("raw_dir"), F.coalesce(F.try_element_at("details", F.lit("raw_dir")), raw).alias("recorded_dir"))
        self.store.put("raw_files", files.listing(based))
        listing = self.table("raw_files", "paper_key string, path string, is_dir boolean")
        texts = todo.select("paper_key", "md")
        made = captioning.captions(captioning.image_files(captioning.images(texts), artifacts.image_base(based, listing), listing), self.captioner)
        self.store.put("image_captions", made)  # each image is captioned once
        made = self.table("image_captions", captioning.CAPTIONS_SCHEMA)
        spent = made.groupBy("paper_key").agg(F.round(F.sum("seconds"), 3).alias("elapsed_seconds"))
        new = captioning.rewritten(texts, made).join(spent, "paper_key", "left").select("paper_key", "md", *captioning.COUNTS, F.coalesce("elapsed_seconds", F.lit(0.0)).alias("elapsed_seconds"), F.lit(False).alias("reused"), F.lit(None).cast("string").alias("error"))
        return new.unionByName(there) if reuse else new

    def _results(self, jobs: DataFrame, latest: DataFrame, captioned: DataFrame | None, unsaved: DataFrame, run: int) -> DataFrame:
        root, o = F.lit(self.root), self.config.output
        e = latest.select("paper_key", F.col("error").alias("extract_error"), F.create_map(*[x for n in ("num_images", "num_tables", "num_equations", "num_headings") for x in (F.lit(n), F.col(n))]).alias("extraction_stats"))
        null = F.lit(None)
        if captioned is None:
            c = latest.select("paper_key", null.cast("string").alias("caption_error"), null.cast("map<string,bigint>").alias("captioning_stats"), F.lit(False).alias("has_captions"))
        else:
            shown = lambda n: F.when((F.col("run") == run) & ~F.col("reused"), F.col(n)).otherwise(F.lit(0).cast("bigint"))
            c = captioned.select("paper_key", F.col("error").alias("caption_error"), F.create_map(*[x for n in captioning.COUNTS for x in (F.lit(n), shown(n))]).alias("captioning_stats"), F.col("error").isNull().alias("has_captions"))
        status = outcome(F.col("extract_error"), F.col("caption_error"), F.col("pipeline_error"))
        u = unsaved.select("paper_key", F.col("error").alias("pipeline_error"))
        r = jobs.join(e, "paper_key", "left").join(c, "paper_key", "left").join(u, "paper_key", "left").withColumn("status", status)
        fine = F.col("extract_error").isNull()
        return r.orderBy("ord").select(
            "paper_key", "label", "pdf_path", (F.col("status") == "completed").alias("success"), "status",
            F.when(fine, self.places.markdown_path(root, F.col("paper_key"), o.markdown_dir_name)).alias("markdown_path"),
            F.when(F.col("has_captions"), self.places.captioned_path(root, F.col("paper_key"), o.captioned_markdown_dir_name)).alias("captioned_path"),
            F.when(F.col("pipeline_error").isNull(), self.places.manifest_path(root, F.col("paper_key"), o.manifests_dir_name)).alias("manifest_path"),
            F.when(fine, F.col("extraction_stats")).alias("extraction_stats"), "captioning_stats", F.coalesce("pipeline_error", "extract_error", "caption_error").alias("error"),
        )


def ocr(input_path, *, caption=False, config=None, config_path=None, output_dir=None, spark=None, extractor=None, captioner=None) -> list[Result]:
    """Process one PDF or a folder of them; results in input order."""
    configuration.load_env()
    resolved = configuration.resolve(config, config_path, output_dir, caption)
    configuration.validate(resolved)
    found = files.resolve_inputs(input_path)
    spark = spark or SparkSession.builder.getOrCreate()
    rows = public(Pipeline(spark, resolved, extractor, captioner).run(files.jobs(spark, found))).collect()
    results = [Result(**r.asDict()) for r in rows]
    for k, r in enumerate(results, 1):
        LOGGER.log(logging.INFO if r.success else logging.ERROR, "%d/%d | %s | %s", k, len(results), r.label, r.status if r.success else f"{r.status}: {r.error}")
    return results
