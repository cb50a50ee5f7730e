"""Figure captioning: captionable images joined to the files at hand, an injected function, rewriting by position."""

from __future__ import annotations

import base64
import time
from collections.abc import Callable, Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.config import Config
from vellum.errors import CaptioningError
from vellum.functions import markdown

#: From an image's path to its caption; None or "" skips it.
Captioner = Callable[[str], "str | None"]

#: From (paper, manifest) to a dict with ``captioned_markdown_path`` or ``markdown``, and counts.
DocumentCaptioner = Callable[[dict, dict], "dict | None"]
COUNTS = ("images_found", "images_captioned", "images_skipped")

CAPTIONS_SCHEMA = "paper_key string, pos int, caption string, seconds double"


def with_retries(caption: Captioner, max_retries: int) -> Captioner:
    """Up to ``max_retries + 1`` attempts at once; None when all fail."""

    def attempt(path: str) -> str | None:
        for _ in range(max_retries + 1):
            try:
                return caption(path)
            except Exception:  # noqa: BLE001, S112 an image that fails is skipped
                continue
        return None

    return attempt


def media_type(path: str) -> str:
    from vellum.functions.paths import MEDIA_TYPES

    return MEDIA_TYPES.get(Path(path).suffix.lower(), "image/jpeg")


def api(config: Config) -> Captioner:
    """A chat-completion service that takes images as data URLs; needs the ``openai`` package on the executors."""
    apis, own = config.apis, config.captioning
    client = None

    def caption(path: str) -> str | None:
        nonlocal client
        if client is None:  # once per worker
            import openai

            client = openai.AzureOpenAI(api_key=apis.api_key, azure_endpoint=apis.base_url, api_version=apis.api_version, timeout=own.timeout_seconds)
        url = f"data:{media_type(path)};base64,{base64.b64encode(Path(path).read_bytes()).decode()}"
        parts = [dict(type="text", text=own.caption_prompt), dict(type="image_url", image_url=dict(url=url))]
        answer = client.chat.completions.create(model=apis.model, messages=[dict(role="user", content=parts)])
        return (answer.choices[0].message.content or "").strip() or None

    return with_retries(caption, own.max_retries)


def of_paper(captioner: DocumentCaptioner) -> DocumentCaptioner:
    """Mark a captioner as one of whole documents; where it raises, that document fails and keeps its Markdown."""

    def caption(paper: dict, manifest: dict) -> dict | None:
        return captioner(paper, manifest)

    caption.documents = True
    return caption


def documents(todo: DataFrame, captioner: DocumentCaptioner | None, reuse: bool = False) -> DataFrame:
    """``todo(paper_key, md, md_path, captioned_path)`` to ``(paper_key, md, *COUNTS, elapsed_seconds, reused, error)``.

    With ``reuse``, a file that lies at ``captioned_path`` already is taken as
    the result, without counts.  Without a captioner, nothing else comes back.
    """
    from vellum.operators.extract import read_text

    names = ["paper_key", "md", *COUNTS, "elapsed_seconds", "reused", "error"]

    def one(key: str, md: str, md_path: str, path: str) -> tuple | None:
        began = time.monotonic()
        try:
            if reuse and Path(path).is_file():
                return key, read_text(path), 0, 0, 0, 0.0, True, None
            if captioner is None:
                return None
            got = captioner({"paper_key": key}, {"paper_key": key, "output_paths": {"markdown": md_path, "captioned_markdown": path}})
            if got is not None and not isinstance(got, dict):
                raise CaptioningError("a captioner must return a dict or None")
            got = got or {}
            made = got.get("captioned_markdown_path") or got.get("markdown_path")
            text = got["markdown"] if got.get("markdown") is not None else read_text(made) if made else md
            return key, text, *(int(got.get(c, 0)) for c in COUNTS), round(time.monotonic() - began, 3), False, None
        except Exception as e:  # noqa: BLE001 one bad document never stops the rest
            return key, None, 0, 0, 0, round(time.monotonic() - began, 3), False, str(e) or type(e).__name__

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [one(*x) for x in zip(frame["paper_key"], frame["md"], frame["md_path"], frame["captioned_path"], strict=True)]
            yield pd.DataFrame([r for r in rows if r], columns=names)

    return todo.select("paper_key", "md", "md_path", "captioned_path").mapInPandas(run, "paper_key string, md string, images_found bigint, images_captioned bigint, images_skipped bigint, elapsed_seconds double, reused boolean, error string")


def images(texts: DataFrame) -> DataFrame:
    """``texts(paper_key, md)`` to ``(paper_key, pos, tag, alt, target)`` of captionable images."""
    return texts.select("paper_key", F.posexplode(markdown.captionable(F.col("md"))).alias("pos", "x")).select("paper_key", "pos", "x.tag", "x.alt", "x.target")


def image_files(found: DataFrame, bases: DataFrame, listing: DataFrame) -> DataFrame:
    """Images with the path of their file; null where no such file is listed."""
    files = listing.where("not is_dir").select(F.col("path").alias("file"))
    target = F.concat("base_dir", F.lit("/"), F.col("target"))
    return found.join(bases, "paper_key", "left").join(files, target == F.col("file"), "left").select("paper_key", "pos", "file")


def captions(files: DataFrame, captioner: Captioner) -> DataFrame:
    """``(paper_key, pos, caption, seconds)`` of images that have files."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for key, pos, file in zip(frame["paper_key"], frame["pos"], frame["file"], strict=True):
                began = time.monotonic()
                try:
                    text = captioner(file)
                except Exception:  # noqa: BLE001 an image that fails is skipped
                    text = None
                yield pd.DataFrame({"paper_key": [key], "pos": [pos], "caption": [text], "seconds": [time.monotonic() - began]})

    return files.where("file is not null").mapInPandas(run, CAPTIONS_SCHEMA)


def rewritten(texts: DataFrame, captioned: DataFrame) -> DataFrame:
    """``(paper_key, md, images_found, images_captioned, images_skipped)``: captions put in by position.

    Captions aggregate to one map per document before the join, so a document's
    text moves once however many images it has.
    """
    by_key = captioned.groupBy("paper_key").agg(F.map_from_entries(F.collect_list(F.struct("pos", "caption"))).alias("captions"))
    found = F.size(markdown.captionable(F.col("md")))
    listed = F.transform(F.when(found > 0, F.sequence(F.lit(0), found - 1)).otherwise(F.array().cast("array<int>")), lambda k: F.try_element_at(F.col("captions"), k))
    joined = texts.select("paper_key", "md").join(by_key, "paper_key", "left").withColumn("listed", listed)
    done = F.size(F.filter("listed", lambda c: F.coalesce(c, F.lit("")) != ""))
    return joined.select("paper_key", markdown.rewritten(F.col("md"), F.col("listed")).alias("md"), found.cast("bigint").alias("images_found"), done.cast("bigint").alias("images_captioned"), (found - done).cast("bigint").alias("images_skipped"))
