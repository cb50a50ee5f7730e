"""Text extraction: an injected function over pending documents, errors as rows."""

from __future__ import annotations

import json
import subprocess
from collections.abc import Callable, Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.config import Config
from vellum.errors import ExtractionError
from vellum.functions import markdown

#: From (pdf_path, raw_dir) to Markdown, or to a dict with ``markdown`` and further details; None counts as empty.
Extractor = Callable[[str, str], "str | dict | None"]

SCHEMA = "paper_key string, md string, details map<string,string>, error string"

#: Characters of results that a task holds before it sends them.
HELD = 1 << 20


def failure_text(stderr: str, stdout: str, code: int) -> str:
    """What a failed command says: its errors, else its output, else its code."""
    return (stderr or "").strip() or (stdout or "").strip() or f"the command ended with code {code}"


def command(config: Config) -> Extractor:
    """The configured OCR command: ``command -p PDF -o OUT -b BACKEND [extra...]``; its stem.md is the text."""
    ocr = config.ocr

    def extract(pdf_path: str, raw_dir: str) -> dict:
        Path(raw_dir).mkdir(parents=True, exist_ok=True)
        stem = Path(pdf_path).stem
        found = _markdown_below(raw_dir, stem)
        reused = found is not None and not config.resume.force
        if not reused:
            try:
                done = subprocess.run([ocr.command, "-p", pdf_path, "-o", raw_dir, "-b", ocr.backend, *ocr.extra_args], capture_output=True, text=True, check=False)
            except FileNotFoundError as e:
                raise ExtractionError(f"there is no command {ocr.command!r}") from e
            if done.returncode:
                raise ExtractionError(failure_text(done.stderr, done.stdout, done.returncode))
            found = _markdown_below(raw_dir, stem)
        if found is None:
            raise ExtractionError(f"no Markdown of {stem} below {raw_dir}")
        return {"markdown": read_text(found), "ocr_markdown_path": str(found), "raw_dir": str(found.parent), "reused_existing": reused}

    return extract


def of_paper(extractor: Callable[[dict, dict], dict | None]) -> Extractor:
    """An extractor that takes ``(paper, manifest)`` as the command does: its dict names a ``markdown_path``, or holds ``markdown``.

    The paper has the fields of a local record, the manifest the paths that are
    planned for it.
    """

    def extract(pdf_path: str, raw_dir: str) -> dict:
        raw = Path(raw_dir)
        got = extractor({"paper_key": raw.name, "title": Path(pdf_path).stem, "pdf_path": pdf_path}, {"paper_key": raw.name, "output_paths": {"pdf": pdf_path, "raw_dir": raw_dir}})
        if got is not None and not isinstance(got, dict):
            raise ExtractionError("an extractor must return a dict or None")
        got = dict(got or {})
        if "markdown" not in got and got.get("markdown_path"):
            got["markdown"] = read_text(got["markdown_path"])
        return got

    return extract


def read_text(path: str | Path) -> str:
    """A text file with its newlines normalised."""
    return Path(path).read_bytes().decode().replace("\r\n", "\n").replace("\r", "\n")


def _markdown_below(raw_dir: str, stem: str) -> Path | None:
    """As :func:`vellum.operators.artifacts.located` for a folder at hand."""
    root = Path(raw_dir)
    for p in (root / stem, root / stem / "auto", root / stem / "hybrid_auto", root / "auto" / stem, root / "auto", root):
        if not p.is_dir():
            continue
        for name in (f"{stem}.md", "output.md"):
            if (p / name).is_file():
                return p / name
        only = list(p.glob("*.md"))
        if len(only) == 1:
            return only[0]
    return min((p for p in root.rglob("*.md") if p.name == f"{stem}.md"), default=None) if root.is_dir() else None


def extracted(pending: DataFrame, extractor: Extractor, tasks: int | None = None, reuse: bool = False) -> DataFrame:
    """``pending(paper_key, pdf_path, raw_dir)`` to ``(paper_key, md, details, error)``.

    With ``reuse``, a Markdown file that lies at a row's ``md_path`` already is
    taken as the result.  Jobs are dealt out in small partitions, their durations being uneven;
    results travel in frames of many rows, a frame costing far more than its rows do.
    Effects run again when an action does: write the result once.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows, held = [], 0
            for key, pdf, raw, *ready in zip(*(frame[c] for c in columns), strict=True):
                md, details, error = None, None, None
                try:
                    there = bool(ready) and Path(ready[0]).is_file()
                    got = {"markdown": read_text(ready[0]), "reused_existing": "true"} if there else extractor(pdf, raw)
                    if isinstance(got, str):
                        got = {"markdown": got}
                    if got is not None and not isinstance(got, dict):
                        raise ExtractionError("an extractor returns text, a dict or None")
                    got = dict(got or {})
                    text = got.pop("markdown", None)
                    if not isinstance(text, str | bytes | None):  # it would fail the rows beside it, or count as none
                        raise ExtractionError("an extractor's markdown is text")
                    md = text
                    details = {str(k): v if isinstance(v, str) else json.dumps(v, ensure_ascii=False) for k, v in got.items() if v is not None}
                except Exception as e:  # noqa: BLE001 one bad document never stops the rest
                    error = str(e) or type(e).__name__
                rows.append((key, md, details, error))
                held += len(md or "") + len(error or "") + sum(len(k) + len(v) for k, v in (details or {}).items())
                if held > HELD:
                    yield pd.DataFrame(rows, columns=names, dtype=object)
                    rows, held = [], 0
            if rows:
                yield pd.DataFrame(rows, columns=names, dtype=object)

    columns, names = ["paper_key", "pdf_path", "raw_dir", *["md_path"] * reuse], ["paper_key", "md", "details", "error"]
    spread = pending.repartition(tasks) if tasks else pending
    return spread.select(*columns).mapInPandas(run, SCHEMA)


def with_statistics(texts: DataFrame) -> DataFrame:
    """Extraction results with the structural counts of their Markdown."""
    return texts.select("*", *markdown.statistics(F.coalesce("md", F.lit(""))))
