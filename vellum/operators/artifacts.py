"""Finding an OCR tool's artifacts in a file listing, by priority, as joins and windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellum.functions import paths

#: Places that are searched below a document's raw folder, first hit wins; {} is the stem.
PLACES = ("{}", "{}/auto", "{}/hybrid_auto", "auto/{}", "auto", "")
COMPANIONS = {"middle_json_path": "middle.json", "content_list_path": "content_list.json", "layout_pdf_path": "layout.pdf", "span_pdf_path": "span.pdf"}


def place(k: int, stem: Column) -> Column:
    before, _, after = PLACES[k].partition("{}")
    return F.concat(F.lit(before), stem, F.lit(after)) if "{}" in PLACES[k] else F.lit(PLACES[k])


def _folder(path: Column) -> Column:
    return F.regexp_extract(path, r"(?s)^(.*)/[^/]*$", 1)


def located(jobs: DataFrame, listing: DataFrame) -> DataFrame:
    """``(paper_key, markdown_path, document_dir)`` of jobs whose Markdown is found.

    ``jobs(paper_key, stem)`` and ``listing(paper_key, path, is_dir)`` with
    paths relative to the job's raw folder.  In each of PLACES in order:
    ``stem.md``, else ``output.md``, else the only ``*.md``; where no place has
    one, any ``stem.md`` below, the first by path.
    """
    files = listing.where("not is_dir").select("paper_key", "path", _folder(F.col("path")).alias("dir"), paths.name(F.col("path")).alias("name"))
    md = files.where(F.col("name").endswith(".md")).join(jobs.select("paper_key", "stem"), "paper_key")
    here = md.withColumn("only", F.count("*").over(Window.partitionBy("paper_key", "dir")) == 1)
    ranks = F.filter(F.array(*[F.when(F.col("dir") == place(k, F.col("stem")), F.lit(k)) for k in range(len(PLACES))]), lambda x: x.isNotNull())
    own = F.col("name") == F.concat("stem", F.lit(".md"))
    kind = F.when(own, 0).when(F.col("name") == "output.md", 1).when(F.col("only"), 2)
    rank = F.coalesce(F.get(ranks, F.lit(0)), F.when(own, F.lit(len(PLACES))))
    hits = here.withColumn("rank", rank).withColumn("kind", kind).where("rank is not null and kind is not null")
    best = hits.groupBy("paper_key").agg(F.min(F.struct("rank", "kind", "path", "dir")).alias("b"))
    return best.select("paper_key", F.col("b.path").alias("markdown_path"), F.col("b.dir").alias("document_dir"))


def companions(jobs: DataFrame, found: DataFrame, listing: DataFrame) -> DataFrame:
    """``found`` with the files beside each Markdown: ``stem_<name>``, else ``<name>``; and its ``images`` folder."""
    near = listing.select("paper_key", F.col("path").alias("p"), "is_dir", _folder(F.col("path")).alias("dir"), paths.name(F.col("path")).alias("name"))
    j = found.join(jobs.select("paper_key", "stem"), "paper_key").join(near, "paper_key", "left").where("dir is null or dir = document_dir")
    pick = [F.coalesce(F.min(F.when(~F.col("is_dir") & (F.col("name") == F.concat("stem", F.lit(f"_{n}"))), F.col("p"))), F.min(F.when(~F.col("is_dir") & (F.col("name") == n), F.col("p")))).alias(c) for c, n in COMPANIONS.items()]
    images = F.min(F.when(F.col("is_dir") & (F.col("name") == "images"), F.col("p"))).alias("images_dir")
    return j.groupBy("paper_key", "markdown_path", "document_dir").agg(images, *pick)


def image_base(jobs: DataFrame, listing: DataFrame) -> DataFrame:
    """``(paper_key, base_dir)`` that image targets are relative to.

    ``jobs(paper_key, raw_dir, recorded_dir)``: the recorded folder if it is
    listed, else the parent of the first folder named ``images``, else the raw
    folder; ``listing`` has full paths.
    """
    dirs = listing.where("is_dir").select("paper_key", "path")
    j = jobs.join(dirs, "paper_key", "left").groupBy("paper_key", "raw_dir", "recorded_dir").agg(
        F.max(F.col("path") == F.col("recorded_dir")).alias("recorded"), F.min(F.when((paths.name(F.col("path")) == "images") & F.col("path").startswith(F.concat("raw_dir", F.lit("/"))), F.col("path"))).alias("images")
    )
    return j.select("paper_key", F.when(F.col("recorded"), F.col("recorded_dir")).otherwise(F.coalesce(_folder(F.col("images")), F.col("raw_dir"))).alias("base_dir"))
