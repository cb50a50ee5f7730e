"""Keys, names and output paths as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_NAME = 180
MEDIA_TYPES = {f".{x}": f"image/{x}" for x in ("gif", "jpeg", "png", "webp")} | {".jpg": "image/jpeg"}


def name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)/*$", 1)


def suffix(path: Column) -> Column:
    """The last dot and what follows; none for names whose only dot is first or last."""
    return F.regexp_extract(name(path), r"(?s)^.+(\.[^.]+)$", 1)


def stem(path: Column) -> Column:
    n = name(path)
    return F.substring(n, F.lit(1), F.length(n) - F.length(suffix(path)))


def is_pdf(path: Column) -> Column:
    return F.lower(suffix(path)) == ".pdf"


def paper_key(path: Column) -> Column:
    """A stable key: stem and 16 hex digits of the path's SHA-1."""
    return F.concat(F.lit("ocr__"), stem(path), F.lit("__"), F.substring(F.sha1(F.encode(path, "UTF-8")), 1, 16))


def sanitized(value: Column, max_length: int = MAX_NAME) -> Column:
    """A file-system-safe component: other characters collapse to ``_``, edges lose ``.`` and ``_``."""
    safe = F.regexp_replace(F.regexp_replace(value, r"[^\w.-]+", "_"), "^[._]+|[._]+$", "")
    return F.substring(F.when(safe == "", "unknown").otherwise(F.coalesce(safe, F.lit("unknown"))), 1, max_length)


def _below(root: Column, folder: str, key: Column, extension: str = "") -> Column:
    if extension and not extension.startswith("."):
        extension = f".{extension}"
    return F.concat(root, F.lit(f"/{folder}/"), sanitized(key), F.lit(extension))


def manifest_path(root: Column, key: Column, folder: str = "manifests") -> Column:
    return _below(root, folder, key, ".json")


def raw_dir(root: Column, key: Column, folder: str = "ocr_raw") -> Column:
    return _below(root, folder, key)


def markdown_path(root: Column, key: Column, folder: str = "markdown", extension: str = ".md") -> Column:
    return _below(root, folder, key, extension)


def captioned_path(root: Column, key: Column, folder: str = "captioned_markdown", extension: str = ".md") -> Column:
    return _below(root, folder, key, extension)


def output_paths(root: Column, key: Column, raw_folder: str = "ocr_raw") -> Column:
    """The planned paths that a new manifest starts with."""
    return F.create_map(F.lit("manifest"), manifest_path(root, key), F.lit("raw_dir"), raw_dir(root, key, raw_folder), F.lit("markdown"), markdown_path(root, key), F.lit("captioned_markdown"), captioned_path(root, key))


def media_type(path: Column) -> Column:
    """By suffix, JPEG for any other."""
    kinds = F.create_map(*[F.lit(x) for pair in MEDIA_TYPES.items() for x in pair])
    return F.coalesce(F.try_element_at(kinds, F.lower(suffix(path))), F.lit("image/jpeg"))


def data_url(path: Column, content: Column) -> Column:
    return F.concat(F.lit("data:"), media_type(path), F.lit(";base64,"), F.replace(F.base64(content), F.lit("\r\n"), F.lit("")))
