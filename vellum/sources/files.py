"""Documents, Markdown, images and listings as DataFrames."""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.errors import InputParseError
from vellum.functions import markdown, paths

JOBS_SCHEMA = "ord int, pdf_path string"


def _is_pdf(p: Path) -> bool:
    return p.suffix.lower() == ".pdf"


def resolve_inputs(path: str | Path) -> list[str]:
    """Real paths of one PDF, or of a folder's PDFs in order; folders below aren't searched.

    Hidden and ``_`` names are included, which Spark's file sources would drop.
    """
    p = Path(path).resolve()
    if not p.exists():
        raise InputParseError(f"{p} does not exist")
    if p.is_file():
        if not _is_pdf(p):
            raise InputParseError(f"{p} is no PDF")
        return [str(p)]
    if not p.is_dir():
        raise InputParseError(f"{p} is neither a file nor a folder")
    found = sorted(str(x.resolve()) for x in p.iterdir() if x.is_file() and _is_pdf(x))
    if not found:
        raise InputParseError(f"{p} holds no PDF")
    return found


def jobs(spark: SparkSession, found: list[str]) -> DataFrame:
    """``(ord, paper_key, pdf_path, label)``: the driver lists, Spark derives."""
    return with_keys(spark.createDataFrame(list(enumerate(found)), JOBS_SCHEMA))


def with_keys(listed: DataFrame) -> DataFrame:
    p = F.col("pdf_path")
    return listed.where(paths.is_pdf(p)).select("ord", paths.paper_key(p).alias("paper_key"), "pdf_path", paths.stem(p).alias("label"))


def listing(folders: DataFrame) -> DataFrame:
    """``folders(paper_key, raw_dir)`` to ``(paper_key, path, is_dir)`` of everything below each, listed by the tasks."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for key, root in zip(frame["paper_key"], frame["raw_dir"], strict=True):
                below = sorted(Path(root).rglob("*")) if Path(root).is_dir() else []
                yield pd.DataFrame({"paper_key": [key] * len(below), "path": [str(x) for x in below], "is_dir": [x.is_dir() for x in below]})

    return folders.select("paper_key", "raw_dir").mapInPandas(run, "paper_key string, path string, is_dir boolean")


def read_markdown(spark: SparkSession, path: str) -> DataFrame:
    """``(path, md, error)`` of Markdown files: strict UTF-8, newlines normalised, a byte order mark kept.

    A file of bad bytes gives null text and an error; the others are read.
    """
    raw = spark.read.format("binaryFile").load(path)
    fine = F.is_valid_utf8(F.col("content").cast("string"))
    text = markdown.normalised_newlines(F.when(fine, F.col("content").cast("string")))
    return raw.select("path", text.alias("md"), F.when(~fine, F.lit("not valid UTF-8")).alias("error"))


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """``(path, media_type, data_url)``; without data_url selected, no bytes are read."""
    raw = spark.read.format("binaryFile").load(path)
    return raw.select("path", paths.media_type(F.col("path")).alias("media_type"), paths.data_url(F.col("path"), F.col("content")).alias("data_url"))


def read_manifests(spark: SparkSession, path: str) -> DataFrame:
    """Stored manifests, one JSON file each, with ``load_error`` for those that can't be read."""
    from vellum.operators import state

    return state.from_json(spark.read.text(path, wholetext=True).withColumnRenamed("value", "json"))


def existing(jobs_: DataFrame, stored: DataFrame) -> DataFrame:
    """Jobs that have a stored row of their key."""
    return jobs_.join(stored.select("paper_key"), "paper_key", "left_semi")
