"""Registered queries of the document engine and SQL that says the same.

The raw documents hold no Markdown structure, so the text operators run over a
derived view that adds headings, figures, tables and equations by doc_id.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.functions import markdown, paths, records
from vellum.operators import artifacts, caption, extract, state
from vellum.plans import pipeline
from vellum.sources import files

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    """Register a function under its name, with its SQL."""

    def register(f: Query) -> Query:
        QUERIES[f.__name__], ORACLE_SQL[f.__name__] = f, sql
        return f

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---- the derived Markdown view ----

_PARTS = """concat('# ', source, chr(10), chr(10), text,
  CASE WHEN doc_id % 3 = 0 THEN concat(chr(10), chr(10), '![fig ', CAST(doc_id AS VARCHAR(20)), '](images/', CAST(doc_id AS VARCHAR(20)), '.png)') ELSE '' END,
  CASE WHEN doc_id % 4 = 0 THEN concat(chr(10), chr(10), '## Methods', chr(10), chr(10), '![](chart.svg)') ELSE '' END,
  CASE WHEN doc_id % 5 = 0 THEN concat(chr(10), chr(10), '| a | b |', chr(10), '| --- | --- |', chr(10), '| 1 | 2 |') ELSE '' END,
  CASE WHEN doc_id % 7 = 0 THEN concat(chr(10), chr(10), '$$ x = y $$') ELSE '' END)"""
_MD = f"md AS (SELECT doc_id, lang, source, {_PARTS} AS md FROM documents)"
_CAP = markdown.CAPTIONABLE
_IMG = markdown.IMAGE.replace("[^\\x29]+", "([^\\x29]+)")
_COUNTS = rf"""len(regexp_extract_all(md, '{markdown.IMAGE}'))::BIGINT AS num_images,
  len(regexp_extract_all(md, '(?m)^[|].+[|]\s*\n[|][-:| ]+[|]'))::BIGINT AS num_tables,
  ((length(md) - length(replace(md, '$$', ''))) // 4)::BIGINT AS num_equations,
  len(regexp_extract_all(md, '(?m)^[#]{{1,6}}\s+'))::BIGINT AS num_headings"""


def derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select("doc_id", "lang", "source", F.expr(_PARTS).alias("md"))


@query(f"WITH {_MD} SELECT doc_id, {_COUNTS} FROM md")
def md_stats_per_doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(spark, sf_dir).select("doc_id", *markdown.statistics(F.col("md")))


@query(f"WITH {_MD}, s AS (SELECT lang, length(md) AS n, len(regexp_extract_all(md, '{_CAP}')) AS c, {_COUNTS} FROM md) SELECT lang, count(*) AS docs, sum(num_images)::BIGINT AS num_images, sum(num_tables)::BIGINT AS num_tables, sum(num_equations)::BIGINT AS num_equations, sum(num_headings)::BIGINT AS num_headings, sum(c)::BIGINT AS captionable, sum(n)::BIGINT AS chars FROM s GROUP BY lang")
def md_stats_by_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    md = F.col("md")
    s = derived(spark, sf_dir).select("lang", *markdown.statistics(md), markdown.captionable_count(md).alias("captionable"), F.length(md).alias("chars"))
    return s.groupBy("lang").agg(F.count("*").alias("docs"), *[F.sum(c).alias(c) for c in ("num_images", "num_tables", "num_equations", "num_headings", "captionable", "chars")])


@query(f"WITH {_MD}, x AS (SELECT doc_id, regexp_extract_all(md, '{_CAP}', 1) AS alts, regexp_extract_all(md, '{_CAP}', 2) AS targets FROM md), i AS (SELECT *, unnest(range(len(alts))) AS k FROM x) SELECT doc_id, k::INTEGER AS pos, alts[k + 1] AS alt, targets[k + 1] AS target FROM i")
def image_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return caption.images(derived(spark, sf_dir).withColumnRenamed("doc_id", "paper_key")).select(F.col("paper_key").alias("doc_id"), "pos", "alt", "target")


@query(f"WITH {_MD}, x AS (SELECT unnest(regexp_extract_all(md, '{_IMG}', 1)) AS target FROM md), y AS (SELECT regexp_matches(target, '(?i)\\.(png|jpg|jpeg|gif|webp)$') AS captionable, CASE lower(regexp_extract(target, '\\.[^./]+$')) WHEN '.png' THEN 'image/png' WHEN '.gif' THEN 'image/gif' WHEN '.webp' THEN 'image/webp' ELSE 'image/jpeg' END AS media_type FROM x) SELECT captionable, media_type, count(*) AS n FROM y GROUP BY ALL")
def captionable_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = F.explode(F.regexp_extract_all("md", F.lit(_IMG), F.lit(1))).alias("target")
    x = derived(spark, sf_dir).select(target)
    own = F.col("target").rlike(r"(?i)\.(png|jpg|jpeg|gif|webp)$")
    return x.groupBy(own.alias("captionable"), paths.media_type(F.col("target")).alias("media_type")).agg(F.count("*").alias("n"))


_CAPTIONS = "c AS (SELECT d.doc_id, b.text AS caption FROM documents d JOIN benchmark b ON b.item_id = d.doc_id % 40 WHERE d.doc_id % 2 = 0)"


def _captioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captions come from the benchmark; odd documents' figures have none and are skipped."""
    texts = derived(spark, sf_dir).select(F.col("doc_id").alias("paper_key"), "md")
    b = _table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("caption"))
    images = caption.images(texts).where("paper_key % 2 = 0")
    return caption.rewritten(texts, images.join(b, F.col("paper_key") % 40 == F.col("item_id")).select("paper_key", "pos", "caption")).withColumnRenamed("paper_key", "doc_id")


@query(f"WITH {_MD}, {_CAPTIONS}, p AS (SELECT doc_id, md, regexp_split_to_array(md, '{_CAP}') AS s, regexp_extract_all(md, '{_CAP}', 2) AS t FROM md) SELECT p.doc_id, md5(CASE WHEN len(t) = 1 AND c.caption IS NOT NULL THEN s[1] || '![' || c.caption || '](' || t[1] || ')' || s[2] ELSE md END) AS md_md5 FROM p LEFT JOIN c ON p.doc_id = c.doc_id")
def caption_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _captioned(spark, sf_dir).select("doc_id", F.md5(F.col("md").cast("binary")).alias("md_md5"))


@query(f"WITH {_MD}, {_CAPTIONS}, p AS (SELECT doc_id, len(regexp_extract_all(md, '{_CAP}'))::BIGINT AS n FROM md), j AS (SELECT p.doc_id, n, CASE WHEN c.caption IS NULL THEN 0 ELSE n END AS k FROM p LEFT JOIN c ON p.doc_id = c.doc_id) SELECT doc_id % 10 AS bucket, sum(n)::BIGINT AS images_found, sum(k)::BIGINT AS images_captioned, sum(n - k)::BIGINT AS images_skipped, count(*) FILTER (n = 0) AS docs_without FROM j GROUP BY 1")
def caption_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _captioned(spark, sf_dir).groupBy((F.col("doc_id") % 10).alias("bucket")).agg(*[F.sum(c).alias(c) for c in ("images_found", "images_captioned", "images_skipped")], F.count_if(F.col("images_found") == 0).alias("docs_without"))


@query("WITH t AS (SELECT doc_id, replace(replace(text, '. ', chr(13) || chr(10)), ', ', chr(13)) AS t FROM documents) SELECT doc_id, md5(replace(replace(t, chr(13) || chr(10), chr(10)), chr(13), chr(10))) AS text_md5 FROM t")
def newline_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.replace(F.replace("text", F.lit(". "), F.lit("\r\n")), F.lit(", "), F.lit("\r"))
    return _table(spark, sf_dir, "documents").select("doc_id", F.md5(markdown.normalised_newlines(t).cast("binary")).alias("text_md5"))


# ---- jobs, keys, paths ----

_PATH = "concat('/corpus/', source, '/doc-', CAST(doc_id AS VARCHAR(20)), CASE doc_id % 6 WHEN 0 THEN '.PDF' WHEN 1 THEN '.pdf' WHEN 2 THEN '.txt' WHEN 3 THEN '.tar.pdf' WHEN 4 THEN '.d/.pdf' ELSE '' END)"
_NAMED = f"n AS (SELECT doc_id, {_PATH} AS p FROM documents), s AS (SELECT doc_id, p, regexp_extract(p, '[^/]*$') AS name FROM n), x AS (SELECT *, regexp_extract(name, '^.+(\\.[^.]+)$', 1) AS suffix FROM s), j AS (SELECT doc_id, p, name[:length(name) - length(suffix)] AS label FROM x WHERE lower(suffix) = '.pdf')"
_KEY = "'ocr__' || label || '__' || sha1(p)[1:16]"


def _jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.with_keys(_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("ord"), F.expr(_PATH).alias("pdf_path")))


@query(f"WITH {_NAMED} SELECT doc_id AS ord, {_KEY} AS paper_key, p AS pdf_path, label FROM j")
def job_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _jobs(spark, sf_dir)


_SAFE = "left(coalesce(nullif(trim(regexp_replace({0}, '[^A-Za-z0-9._-]+', '_', 'g'), '._'), ''), 'unknown'), 180)"


@query(f"SELECT page_id, {_SAFE.format('url')} AS safe FROM pages")
def sanitize_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "pages").select("page_id", paths.sanitized(F.col("url")).alias("safe"))


@query(f"WITH {_NAMED}, k AS (SELECT doc_id, {_SAFE.format(_KEY)} AS s FROM j) SELECT doc_id, '/out/manifests/' || s || '.json' AS manifest, '/out/ocr_raw/' || s AS raw_dir, '/out/markdown/' || s || '.md' AS markdown, '/out/captioned_markdown/' || s || '.md' AS captioned_markdown FROM k")
def output_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = paths.output_paths(F.lit("/out"), F.col("paper_key"))
    return _jobs(spark, sf_dir).select(F.col("ord").alias("doc_id"), planned.alias("m")).select("doc_id", *[F.col("m")[k].alias(k) for k in ("manifest", "raw_dir", "markdown", "captioned_markdown")])


@query("SELECT page_id, 'data:image/gif;base64,' || base64(encode(html)) AS data_url FROM pages")
def image_data_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "pages").select("page_id", paths.data_url(F.lit("x/figure.GIF"), F.encode("html", "UTF-8")).alias("data_url"))


# ---- state ----


def stage_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table read as a stage log: users are documents, odd events belong to captioning."""
    e = _table(spark, sf_dir, "events")
    kind = F.col("event_type")
    status = F.when(kind == "view", "in_progress").when(kind == "click", "succeeded").when(kind == "error", "failed").when(kind == "signup", "skipped")
    k = F.get_json_object("props", "$.k").cast("bigint")
    details = F.when((kind == "click") & (k % 2 == 1), F.create_map(F.lit("k"), k.cast("string"), F.concat(F.lit("last_"), (k % 3).cast("string")), F.col("event_id").cast("string"))).otherwise(F.create_map().cast("map<string,string>"))
    return e.select(
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("paper_key"), F.col("event_id").alias("seq"), F.when(kind == "purchase", "completed").otherwise("stage").alias("kind"),
        F.when(kind != "purchase", F.when(F.col("event_id") % 2 == 0, state.EXTRACT).otherwise(state.CAPTION)).alias("stage"), status.alias("status"), kind.alias("message"),
        F.when((kind == "error") & (F.col("event_id") % 3 != 0), F.concat(F.lit("e"), F.col("event_id").cast("string"))).alias("error"), details.alias("details"), (kind == "view").cast("int").alias("attempt_inc"), F.col("ts").cast("timestamp").alias("ts"),
    )


_EVENTS = """e AS (SELECT 'user_' || user_id AS paper_key, event_id AS seq, event_type = 'purchase' AS done,
  CASE WHEN event_type <> 'purchase' THEN CASE WHEN event_id % 2 = 0 THEN 'extract_markdown' ELSE 'caption_markdown' END END AS stage,
  CASE event_type WHEN 'view' THEN 'in_progress' WHEN 'click' THEN 'succeeded' WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'skipped' END AS status,
  event_type AS message, CASE WHEN event_type = 'error' AND event_id % 3 <> 0 THEN 'e' || event_id END AS error,
  CASE WHEN event_type = 'click' AND (props->>'$.k')::BIGINT % 2 = 1 THEN (props->>'$.k')::BIGINT END AS k, ts FROM events)"""
_ISO = "strftime(date_trunc('second', {0}), '%Y-%m-%dT%H:%M:%S') || '+00:00'"
_STAGES = f"""f AS (SELECT paper_key, stage, arg_max({{'s': status, 'm': message, 'e': error}}, seq) AS l, count(*) FILTER (status = 'in_progress') AS attempts,
  {_ISO.format("arg_min(ts, seq)")} AS started_at, {_ISO.format("arg_max(ts, seq) FILTER (status <> 'in_progress')")} AS completed_at,
  arg_max(k::VARCHAR, seq) AS detail_k, arg_max(seq::VARCHAR, seq) FILTER (k % 3 = 0) AS last_0, arg_max(seq::VARCHAR, seq) FILTER (k % 3 = 1) AS last_1, arg_max(seq::VARCHAR, seq) FILTER (k % 3 = 2) AS last_2
  FROM e WHERE NOT done GROUP BY paper_key, stage)"""
_MANIFEST = f"""g AS (SELECT paper_key, {_ISO.format("arg_min(ts, seq)")} AS created_at, {_ISO.format("arg_max(ts, seq)")} AS updated_at, arg_max(stage, seq) AS current_stage,
  coalesce(arg_max(CASE WHEN done THEN 'succeeded' WHEN status = 'failed' THEN 'failed' WHEN status = 'in_progress' THEN 'running' END, seq), 'not_started') AS batch_status,
  arg_max({{'s': stage, 'e': coalesce(error, message)}}, seq) FILTER (status = 'failed') AS fail, max(seq) FILTER (status = 'failed') AS fs, max(seq) FILTER (done) AS ds FROM e GROUP BY paper_key),
m AS (SELECT paper_key, created_at, updated_at, batch_status, current_stage, CASE WHEN fs > coalesce(ds, -1) THEN fail.s END AS failed_stage, CASE WHEN fs > coalesce(ds, -1) THEN fail.e END AS final_error FROM g)"""


@query(f"WITH {_EVENTS}, {_STAGES} SELECT paper_key, stage, l.s AS status, attempts, started_at, completed_at, l.m AS message, l.e AS error, detail_k, last_0, last_1, last_2 FROM f")
def stage_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = state.fold_stages(stage_events(spark, sf_dir))
    d = [F.try_element_at("details", F.lit(k)).alias("detail_k" if k == "k" else k) for k in ("k", "last_0", "last_1", "last_2")]
    return f.select("paper_key", "stage", "status", "attempts", state.iso(F.col("started_at")).alias("started_at"), state.iso(F.col("completed_at")).alias("completed_at"), "message", "error", *d)


@query(f"WITH {_EVENTS}, {_MANIFEST} SELECT * FROM m")
def manifest_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = state.fold_manifest(stage_events(spark, sf_dir))
    return m.select("paper_key", state.iso(F.col("created_at")).alias("created_at"), state.iso(F.col("updated_at")).alias("updated_at"), "batch_status", "current_stage", "failed_stage", "final_error")


_DIMENSION = "s(ord, stage) AS (VALUES " + ", ".join(f"({k}, '{s}')" for k, s in enumerate(state.STAGES)) + ")"


def _users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "customer").select(F.concat(F.lit("user_"), F.col("c_custkey").cast("string")).alias("paper_key"))


@query(f"WITH {_EVENTS}, {_STAGES}, {_DIMENSION}, u AS (SELECT 'user_' || c_custkey AS paper_key FROM customer) SELECT u.paper_key, s.ord, s.stage, coalesce(l.s, 'not_started') AS status, coalesce(attempts, 0) AS attempts FROM u CROSS JOIN s LEFT JOIN f ON f.paper_key = u.paper_key AND f.stage = s.stage")
def stage_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.filled_stages(_users(spark, sf_dir), state.fold_stages(stage_events(spark, sf_dir))).select("paper_key", "ord", "stage", "status", "attempts")


@query(f"WITH {_DIMENSION} SELECT stage, lead(stage) OVER (ORDER BY ord) AS next_stage FROM s")
def next_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.next_stages(spark)


@query(f"WITH {_EVENTS}, {_STAGES}, u AS (SELECT 'user_' || c_custkey AS paper_key FROM customer) SELECT paper_key FROM u WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.paper_key = u.paper_key AND f.stage = 'extract_markdown' AND f.l.s = 'succeeded')")
def resume_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.pending(_users(spark, sf_dir), state.fold_stages(stage_events(spark, sf_dir)), state.EXTRACT)


@query(f"WITH {_EVENTS}, u AS (SELECT 'user_' || c_custkey AS paper_key FROM customer) SELECT paper_key FROM u WHERE EXISTS (SELECT 1 FROM e WHERE e.paper_key = u.paper_key)")
def manifest_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.existing(_users(spark, sf_dir), state.fold_manifest(stage_events(spark, sf_dir)))


@query(f"WITH {_EVENTS} SELECT status, coalesce(status, '') IN ('succeeded', 'failed', 'skipped') AS terminal, count(*) AS n FROM e GROUP BY ALL")
def terminal_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = stage_events(spark, sf_dir)
    return e.groupBy("status", F.coalesce(state.is_terminal(F.col("status")), F.lit(False)).alias("terminal")).agg(F.count("*").alias("n"))


@query(f"WITH {_EVENTS}, {_STAGES}, {_MANIFEST}, c AS (SELECT paper_key, 7 - count(*) AS not_started, sum(attempts)::BIGINT AS attempts FROM f GROUP BY paper_key) SELECT m.*, 1 AS manifest_version, coalesce(not_started, 7) AS not_started, coalesce(attempts, 0) AS attempts, '/in/' || m.paper_key || '.pdf' AS pdf FROM m LEFT JOIN c ON m.paper_key = c.paper_key")
def manifest_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest view written as JSON and read back."""
    e = stage_events(spark, sf_dir)
    jobs = e.select("paper_key").distinct().select("paper_key", F.concat(F.lit("/in/"), "paper_key", F.lit(".pdf")).alias("pdf_path"))
    back = state.from_json(state.to_json(state.manifests(jobs, e, F.lit("/out"))))
    states = F.map_values("stage_states")
    return back.where("load_error is null").select(
        "paper_key", "created_at", "updated_at", "batch_status", "current_stage", "failed_stage", "final_error", "manifest_version",
        F.size(F.filter(states, lambda s: s["status"] == "not_started")).cast("bigint").alias("not_started"),
        F.aggregate(F.transform(states, lambda s: s["attempts"]), F.lit(0).cast("bigint"), lambda a, x: a + x).alias("attempts"), F.col("output_paths")["pdf"].alias("pdf"),
    )


# ---- outcomes ----

_OUTCOME = """r AS (SELECT doc_id, CASE WHEN doc_id % 13 = 0 THEN 'unreadable state' END AS pe, CASE WHEN doc_id % 10 = 0 THEN 'no text' END AS xe, CASE WHEN doc_id % 10 = 1 THEN 'no service' END AS ce,
  CASE WHEN doc_id % 4 = 0 THEN '' ELSE '/md/' || doc_id END AS md, CASE WHEN doc_id % 3 = 0 THEN '/cap/' || doc_id WHEN doc_id % 3 = 1 THEN '' END AS cap FROM documents),
q AS (SELECT *, CASE WHEN pe IS NOT NULL THEN 'failed_pipeline_error' WHEN xe IS NOT NULL THEN 'failed_extraction' WHEN ce IS NOT NULL THEN 'failed_captioning' ELSE 'completed' END AS status FROM r)"""


def _outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("doc_id")
    text = i.cast("string")
    r = _table(spark, sf_dir, "documents").select(
        "doc_id", F.when(i % 13 == 0, "unreadable state").alias("pe"), F.when(i % 10 == 0, "no text").alias("xe"), F.when(i % 10 == 1, "no service").alias("ce"),
        F.when(i % 4 == 0, "").otherwise(F.concat(F.lit("/md/"), text)).alias("md"), F.when(i % 3 == 0, F.concat(F.lit("/cap/"), text)).when(i % 3 == 1, "").alias("cap"),
    )
    status = pipeline.outcome(F.col("xe"), F.col("ce"), F.col("pe"))
    return r.withColumn("status", status).withColumn("success", status == "completed")


@query(f"WITH {_OUTCOME} SELECT doc_id, status, status = 'completed' AS success, coalesce(pe, xe, ce) AS error FROM q")
def result_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _outcomes(spark, sf_dir).select("doc_id", "status", "success", F.coalesce("pe", "xe", "ce").alias("error"))


@query(f"WITH {_OUTCOME} SELECT doc_id, coalesce(nullif(cap, ''), md) AS effective, coalesce(nullif(md, ''), '/planned/' || doc_id) AS best_markdown, coalesce(nullif(cap, ''), nullif(md, ''), '/planned/' || doc_id) AS best_captioned FROM q")
def effective_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    cap, md, planned = F.col("cap"), F.col("md"), F.concat(F.lit("/planned/"), F.col("doc_id").cast("string"))
    return _outcomes(spark, sf_dir).select("doc_id", pipeline.effective_markdown(cap, md).alias("effective"), pipeline.best_path(md, planned).alias("best_markdown"), pipeline.best_path(cap, md, planned).alias("best_captioned"))


@query(f"WITH {_OUTCOME} SELECT count(*) FILTER (status = 'completed') AS succeeded, count(*) AS total, (count(*) FILTER (status = 'completed') <> count(*))::INTEGER AS exit_code FROM q")
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipeline.summary(_outcomes(spark, sf_dir))


@query(f"WITH {_OUTCOME} SELECT doc_id, status FROM q WHERE status <> 'completed'")
def failed_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipeline.failed(_outcomes(spark, sf_dir)).select("doc_id", "status")


@query(f"WITH {_OUTCOME} SELECT '/in/' || doc_id || '.pdf' AS pdf_path, status = 'completed' AS success, md AS markdown_path, cap AS captioned_path, coalesce(pe, xe, ce) AS error, status, 'doc ' || doc_id AS label FROM q")
def public_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("doc_id").cast("string")
    full = _outcomes(spark, sf_dir).select("*", F.concat(F.lit("/in/"), text, F.lit(".pdf")).alias("pdf_path"), F.col("md").alias("markdown_path"), F.col("cap").alias("captioned_path"), F.coalesce("pe", "xe", "ce").alias("error"), F.concat(F.lit("doc "), text).alias("label"))
    return pipeline.public(full)


# ---- artifacts ----

_SQL_PLACES = ["'s' || doc_id", "'s' || doc_id || '/auto'", "'s' || doc_id || '/hybrid_auto'", "'auto/s' || doc_id", "'auto'", "''"]
_LISTING = f"""d AS (SELECT doc_id, 's' || doc_id AS stem, CASE doc_id % 7 {" ".join(f"WHEN {k} THEN {p}" for k, p in enumerate(_SQL_PLACES))} ELSE 'deep/er' END AS dir, (doc_id // 7) % 4 AS v FROM documents),
a AS (SELECT doc_id, stem, CASE WHEN dir = '' THEN '' ELSE dir || '/' END AS b, v, doc_id % 7 = 6 AS deep FROM d),
l AS (SELECT doc_id, b || unnest(CASE WHEN deep THEN [stem || '.md', 'x.md'] WHEN v = 0 THEN [stem || '.md', 'output.md'] WHEN v = 1 THEN ['output.md', 'z.md'] WHEN v = 2 THEN ['only.md'] ELSE ['p.md', 'q.md'] END) AS path, false AS is_dir FROM a
  UNION ALL SELECT doc_id, b || stem || '_middle.json', false FROM a WHERE doc_id % 2 = 0
  UNION ALL SELECT doc_id, b || 'middle.json', false FROM a WHERE doc_id % 3 = 0
  UNION ALL SELECT doc_id, b || 'layout.pdf', false FROM a WHERE doc_id % 5 = 0
  UNION ALL SELECT doc_id, b || 'images', true FROM a WHERE doc_id % 2 = 1)"""


def _listing(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    i = F.col("doc_id")
    d = _table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("s"), i.cast("string")).alias("stem"))
    folder = F.lit("deep/er")
    for k in range(len(artifacts.PLACES)):
        folder = F.when(i % 7 == k, artifacts.place(k, F.col("stem"))).otherwise(folder)
    a = d.withColumn("dir", folder).select("doc_id", "stem", F.when(F.col("dir") == "", "").otherwise(F.concat("dir", F.lit("/"))).alias("b"), F.floor(i / 7).cast("bigint").alias("w"))
    own, v = F.concat("stem", F.lit(".md")), F.col("w") % 4
    md = F.when(i % 7 == 6, F.array(own, F.lit("x.md"))).when(v == 0, F.array(own, F.lit("output.md"))).when(v == 1, F.array(F.lit("output.md"), F.lit("z.md"))).when(v == 2, F.array(F.lit("only.md"))).otherwise(F.array(F.lit("p.md"), F.lit("q.md")))
    none = F.lit(None).cast("string")
    beside = F.array(F.when(i % 2 == 0, F.concat("stem", F.lit("_middle.json"))).otherwise(none), F.when(i % 3 == 0, "middle.json").otherwise(none), F.when(i % 5 == 0, "layout.pdf").otherwise(none), F.when(i % 2 == 1, "images").otherwise(none))
    listed = a.select(i.alias("paper_key"), "b", F.explode(F.filter(F.concat(md, beside), lambda x: x.isNotNull())).alias("n")).select("paper_key", F.concat("b", "n").alias("path"), (F.col("n") == "images").alias("is_dir"))
    return d.select(i.alias("paper_key"), "stem"), listed


_PICKED = f"""n AS (SELECT l.doc_id, path, stem, regexp_extract(path, '^(.*)/[^/]*$', 1) AS dir, regexp_extract(path, '[^/]*$') AS name FROM l JOIN d ON l.doc_id = d.doc_id WHERE NOT is_dir AND path LIKE '%.md'),
o AS (SELECT *, count(*) OVER (PARTITION BY doc_id, dir) AS c FROM n),
k AS (SELECT *, CASE {" ".join(f"WHEN dir = {p} THEN {k}" for k, p in enumerate(_SQL_PLACES))} WHEN name = stem || '.md' THEN 9 END AS r, CASE WHEN name = stem || '.md' THEN 0 WHEN name = 'output.md' THEN 1 WHEN c = 1 THEN 2 END AS q FROM o),
p AS (SELECT doc_id, path, dir, row_number() OVER (PARTITION BY doc_id ORDER BY r, q, path) AS w FROM k WHERE r IS NOT NULL AND q IS NOT NULL)"""


@query(f"WITH {_LISTING}, {_PICKED} SELECT doc_id, path AS markdown_path, dir AS document_dir FROM p WHERE w = 1")
def artifact_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    return artifacts.located(*_listing(spark, sf_dir)).withColumnRenamed("paper_key", "doc_id")


@query(f"""WITH {_LISTING}, {_PICKED}, z AS (SELECT l.doc_id, l.path, is_dir, regexp_extract(l.path, '[^/]*$') AS name FROM l)
SELECT p.doc_id, any_value(p.path) AS markdown_path, any_value(p.dir) AS document_dir, max(z.path) FILTER (z.name = 'images') AS images_dir,
  coalesce(max(z.path) FILTER (z.name = d.stem || '_middle.json'), max(z.path) FILTER (z.name = 'middle.json')) AS middle_json_path, NULL::VARCHAR AS content_list_path,
  max(z.path) FILTER (z.name = 'layout.pdf') AS layout_pdf_path, NULL::VARCHAR AS span_pdf_path
FROM p JOIN d ON p.doc_id = d.doc_id LEFT JOIN z ON z.doc_id = p.doc_id WHERE w = 1 GROUP BY p.doc_id""")
def artifact_companions(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs, listed = _listing(spark, sf_dir)
    return artifacts.companions(jobs, artifacts.located(jobs, listed), listed).withColumnRenamed("paper_key", "doc_id")


@query(f"""WITH {_LISTING} SELECT a.doc_id, CASE WHEN a.doc_id % 4 = 1 AND l.path IS NOT NULL THEN 'raw/' || l.path WHEN l.path IS NOT NULL THEN regexp_extract('raw/' || l.path, '^(.*)/[^/]*$', 1) ELSE 'raw' END AS base_dir
FROM a LEFT JOIN l ON a.doc_id = l.doc_id AND l.is_dir""")
def image_base_dir(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fourth document has its folder on record (here the images folder itself)."""
    jobs, listed = _listing(spark, sf_dir)
    full = listed.select("paper_key", F.concat(F.lit("raw/"), "path").alias("path"), "is_dir")
    known = full.where("is_dir and paper_key % 4 = 1").select("paper_key", F.col("path").alias("recorded_dir"))
    j = jobs.select("paper_key", F.lit("raw").alias("raw_dir")).join(known, "paper_key", "left")
    return artifacts.image_base(j, full).withColumnRenamed("paper_key", "doc_id")


# ---- bibliographic records ----


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("doc_id")
    text = i.cast("string")
    names = F.when(i % 4 == 0, '["", "Short"]').when(i % 4 == 1, '["A rather long alternate name", " ICML\\t"]').when(i % 4 == 2, "[]").otherwise("null")
    record = F.concat(
        F.lit('{"paperId": "p'), text, F.lit('", "title": '), F.when(i % 5 == 0, '" \\n "').otherwise(F.concat(F.lit('"  Title '), text, F.lit(' "'))), F.lit(', "year": '), F.when(i % 6 == 0, "null").otherwise((1990 + i % 30).cast("string")),
        F.lit(', "venue": '), F.when(i % 3 == 0, F.concat(F.lit('"'), F.col("source"), F.lit('"'))).otherwise('" "'), F.lit(', "publicationVenue": {"name": " The Long Venue ", "alternate_names": '), names,
        F.lit('}, "authors": '), F.when(i % 7 == 0, "null").otherwise(F.concat(F.lit('[{"name": " A'), text, F.lit(' "}, {"name": " "}, "B", {"id": 3}, 12]'))), F.lit(', "url": '), F.when(i % 2 == 0, F.concat(F.lit('"http://x/'), text, F.lit('"'))).otherwise("null"),
        F.lit(', "openAccessPdf": '), F.when(i % 3 == 1, '{"url": " http://pdf "}').when(i % 3 == 2, '"none"').otherwise("null"), F.lit(', "externalIds": '), F.when(i % 2 == 1, F.concat(F.lit('{"DOI": "10/'), text, F.lit('"}'))).otherwise("null"), F.lit("}"),
    )
    return _table(spark, sf_dir, "documents").select("doc_id", record.alias("record"))


@query("""SELECT doc_id, 'p' || doc_id AS semantic_scholar_paper_id, CASE WHEN doc_id % 5 <> 0 THEN 'Title ' || doc_id END AS title, CASE WHEN doc_id % 6 <> 0 THEN (1990 + doc_id % 30)::INTEGER END AS year,
  CASE WHEN doc_id % 3 = 0 THEN source WHEN doc_id % 4 = 1 THEN 'ICML' ELSE 'The Long Venue' END AS venue, CASE WHEN doc_id % 7 = 0 THEN '' ELSE 'A' || doc_id || ';B;12' END AS authors,
  CASE WHEN doc_id % 2 = 0 THEN 'http://x/' || doc_id END AS url, CASE WHEN doc_id % 3 = 1 THEN 'http://pdf' END AS open_access_pdf, CASE WHEN doc_id % 2 = 1 THEN '10/' || doc_id END AS doi, 'metadata_json' AS input_type FROM documents""")
def metadata_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = records.from_record(F.concat(F.lit("k"), F.col("doc_id").cast("string")), F.col("record"))
    at = lambda m, k: F.try_element_at(F.col(f"p.{m}"), F.lit(k))
    return _records(spark, sf_dir).select("doc_id", p.alias("p")).select("doc_id", "p.semantic_scholar_paper_id", "p.title", "p.year", "p.venue", F.array_join("p.authors", ";").alias("authors"), at("source_urls", "semantic_scholar").alias("url"), at("source_urls", "open_access_pdf").alias("open_access_pdf"), at("external_ids", "DOI").alias("doi"), "p.input_type")


@query("SELECT 'k' || doc_id AS paper_key, 'doi' AS input_type, '10.1/' || doc_id AS input_value, '10.1/' || doc_id AS doi, NULL::VARCHAR AS title, 0 AS n_authors, '{}' AS raw_metadata FROM documents")
def identifier_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("doc_id").cast("string")
    doi = F.concat(F.lit("10.1/"), text)
    p = records.from_identifier(F.concat(F.lit("k"), text), F.lit("doi"), doi, doi=doi)
    return _table(spark, sf_dir, "documents").select(p.alias("p")).select("p.paper_key", "p.input_type", "p.input_value", "p.doi", "p.title", F.size("p.authors").alias("n_authors"), "p.raw_metadata")


@query(f"WITH {_NAMED} SELECT {_KEY} AS paper_key, 'local_pdf' AS input_type, p AS input_value, label AS title, p AS local_pdf_path, '{{\"local_pdf_path\":\"' || p || '\"}}' AS raw_metadata, p AS source_pdf, 'local_file' AS host_type FROM j")
def local_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.col("pdf_path")
    s = records.selected_source(path)
    rows = _jobs(spark, sf_dir).select(records.from_local_pdf(F.col("paper_key"), path).alias("p"), s.alias("s"))
    return rows.select("p.paper_key", "p.input_type", "p.input_value", "p.title", "p.local_pdf_path", "p.raw_metadata", F.col("s")["pdf_url"].alias("source_pdf"), F.col("s")["host_type"].alias("host_type"))


# ---- stages over injected functions ----


def _numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("doc_id").cast("string")
    places = (F.lit("/nowhere"), key)
    return _table(spark, sf_dir, "documents").select("doc_id", key.alias("paper_key"), F.concat(F.lit("/in/"), key, F.lit(".pdf")).alias("pdf_path"), paths.raw_dir(*places).alias("raw_dir"), paths.markdown_path(*places).alias("md_path"), paths.captioned_path(*places).alias("captioned_path"))


def _extractor(pdf: str, raw: str) -> dict | int | None:
    k = int(pdf.rpartition("/")[2].removesuffix(".pdf"))
    if k % 11 == 0:
        raise RuntimeError(f"no text in {k}")
    return None if k % 13 == 0 else k if k % 17 == 0 else {"markdown": f"# {k}", "pages": k % 5}


_MADE = """CASE WHEN doc_id % 11 = 0 THEN 'no text in ' || doc_id WHEN doc_id % 13 = 0 THEN NULL WHEN doc_id % 17 = 0 THEN 'an extractor returns text, a dict or None' END AS error,
  CASE WHEN doc_id % 11 <> 0 AND doc_id % 13 <> 0 AND doc_id % 17 <> 0 THEN '# ' || doc_id END AS md"""


@query(f"SELECT *, CASE WHEN error IS NULL THEN 'completed' ELSE 'failed_extraction' END AS status FROM (SELECT doc_id, {_MADE}, CASE WHEN doc_id % 11 <> 0 AND doc_id % 13 <> 0 AND doc_id % 17 <> 0 THEN (doc_id % 5)::VARCHAR END AS pages FROM documents)")
def failed_isolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extractors that raise, or return what they may not, fail their document only."""
    made = extract.extracted(_numbered(spark, sf_dir), _extractor)
    return made.select(F.col("paper_key").cast("bigint").alias("doc_id"), "md", "error", F.try_element_at("details", F.lit("pages")).alias("pages"), pipeline.outcome(F.col("error"), F.lit(None).cast("string")).alias("status"))


def _captioner(paper: dict, manifest: dict) -> dict | None:
    k = int(paper["paper_key"])
    if k % 9 == 0:
        raise RuntimeError("no answer for " + manifest["output_paths"]["captioned_markdown"])
    return None if k % 10 == 0 else {"markdown": f"seen {k}", "images_found": k % 4, "images_captioned": k % 4 // 2, "images_skipped": k % 4 - k % 4 // 2}


@query("""WITH c AS (SELECT doc_id, doc_id % 9 = 0 AS bad, doc_id % 10 = 0 AS same FROM documents)
SELECT doc_id, CASE WHEN bad THEN NULL WHEN same THEN '# ' || doc_id ELSE 'seen ' || doc_id END AS md,
  CASE WHEN bad OR same THEN 0 ELSE doc_id % 4 END AS images_found, CASE WHEN bad OR same THEN 0 ELSE doc_id % 4 // 2 END AS images_captioned,
  CASE WHEN bad OR same THEN 0 ELSE doc_id % 4 - doc_id % 4 // 2 END AS images_skipped,
  CASE WHEN bad THEN 'no answer for /nowhere/captioned_markdown/' || doc_id || '.md' END AS error, CASE WHEN bad THEN 'failed_captioning' ELSE 'completed' END AS status FROM c""")
def caption_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captioners of whole documents: counts, documents left as they are, and those that fail."""
    todo = _numbered(spark, sf_dir).withColumn("md", F.concat(F.lit("# "), "paper_key"))
    made = caption.documents(todo, caption.of_paper(_captioner))
    return made.select(F.col("paper_key").cast("bigint").alias("doc_id"), "md", *caption.COUNTS, "error", pipeline.outcome(F.lit(None).cast("string"), F.col("error")).alias("status"))


@query(f"""WITH h AS (SELECT doc_id, doc_id % 3 = 0 AS have FROM documents), m AS (SELECT doc_id, {_MADE} FROM documents)
SELECT doc_id, CASE WHEN have THEN 'kept ' || doc_id ELSE md END AS md, CASE WHEN NOT have THEN error END AS error, have AS reused FROM h JOIN m USING (doc_id)""")
def reuse_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results that are there are used again; failed ones, and jobs without any, go to the extractor.

    What the anti-join leaves is a few bytes a job, so its partitions would be merged into few, and those run few extractors at once.
    """
    jobs = _numbered(spark, sf_dir)
    last = jobs.where("doc_id % 3 < 2").select("paper_key", F.concat(F.lit("kept "), "paper_key").alias("md"), F.when(F.col("doc_id") % 3 == 1, "failed before").alias("error"))
    have = last.where("error is null")
    made = extract.extracted(jobs.join(have.select("paper_key"), "paper_key", "left_anti"), _extractor, spark.sparkContext.defaultParallelism)
    key = F.col("paper_key").cast("bigint").alias("doc_id")
    return have.select(key, "md", "error", F.lit(True).alias("reused")).unionByName(made.select(key, "md", "error", F.lit(False).alias("reused")))
