"""Files out of rows: written whole or not at all, each under a temporary name of its own."""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame

from vellum.config import Config


def write_bytes(path: str | Path, data: bytes) -> None:
    """Write beside the target and rename, so readers see the old or the new file."""
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    beside = path.with_name(f"{path.name}.{uuid.uuid4().hex}.tmp")
    try:
        beside.write_bytes(data)
        os.replace(beside, path)
    finally:
        beside.unlink(missing_ok=True)


def write_text(path: str | Path, text: str) -> None:
    write_bytes(path, text.encode())


def write_json(path: str | Path, payload: object, indent: int = 2) -> None:
    write_text(path, json.dumps(payload, ensure_ascii=False, indent=indent))


def ensure_folders(config: Config) -> None:
    """The output root and the folders below it."""
    o = config.output
    for name in (o.manifests_dir_name, o.raw_dir_name, o.markdown_dir_name, o.captioned_markdown_dir_name):
        (Path(o.root_dir).resolve() / name).mkdir(parents=True, exist_ok=True)


def export_texts(rows: DataFrame) -> DataFrame:
    """Write ``rows(paper_key, path, text)`` to files from the tasks; ``(paper_key, path, error)``, errors being data."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            errors = []
            for path, text in zip(frame["path"], frame["text"], strict=True):
                try:
                    write_text(path, text or "")
                    errors.append(None)
                except OSError as e:
                    errors.append(str(e))
            yield pd.DataFrame({"paper_key": frame["paper_key"], "path": frame["path"], "error": pd.Series(errors, dtype=object)})

    return rows.select("paper_key", "path", "text").mapInPandas(run, "paper_key string, path string, error string")
