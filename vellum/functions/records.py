"""Bibliographic records as column expressions over JSON strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .markdown import WHITE
from .paths import stem

IDS = ("semantic_scholar_paper_id", "corpus_id", "doi", "arxiv_id", "dblp_id", "acl_id", "pmid", "pmcid", "mag_id")
FIELDS = ("title", "authors", "year", "venue", "publication_date", "abstract")
SHORT_NAME = 10


def stripped(value: Column) -> Column:
    return F.regexp_replace(value, f"^{WHITE}+|{WHITE}+$", "")


def cleaned(value: Column) -> Column:
    """As a string without white space around it; null if nothing is left."""
    return F.nullif(stripped(value.cast("string")), F.lit(""))


def _variant(record: Column, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(F.try_parse_json(record), path, kind)


def _texts(record: Column, path: str) -> Column:
    """Elements of a JSON array as variants; empty if there is none."""
    return F.coalesce(_variant(record, path, "array<variant>"), F.array().cast("array<variant>"))


def authors(record: Column) -> Column:
    """Names of author objects, or scalars as they are; blank ones go."""
    whole = lambda v: F.schema_of_variant(v).startswith("OBJECT")
    names = F.transform(_texts(record, "$.authors"), lambda v: cleaned(F.when(whole(v), F.try_variant_get(v, "$.name", "string")).otherwise(F.try_variant_get(v, "$", "string"))))
    return F.filter(names, lambda x: x.isNotNull())


def short_venue(record: Column) -> Column:
    """The first alternate name of at most ten characters, blank ones included; null if that one is blank."""
    names = F.transform(_texts(record, "$.publicationVenue.alternate_names"), lambda v: F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string")))
    return cleaned(F.get(F.filter(names, lambda x: x.isNotNull() & (F.length(stripped(x)) <= SHORT_NAME)), F.lit(0)))


def venue(record: Column) -> Column:
    return F.coalesce(cleaned(_variant(record, "$.venue")), short_venue(record), cleaned(_variant(record, "$.publicationVenue.name")))


def source_urls(record: Column) -> Column:
    both = F.create_map(F.lit("semantic_scholar"), cleaned(_variant(record, "$.url")), F.lit("open_access_pdf"), cleaned(_variant(record, "$.openAccessPdf.url")))
    return F.map_filter(both, lambda _, v: v.isNotNull())


def external_ids(record: Column) -> Column:
    return F.coalesce(_variant(record, "$.externalIds", "map<string,string>"), F.create_map().cast("map<string,string>"))


def _empty(kind: str) -> Column:
    return (F.array() if kind.startswith("array") else F.create_map()).cast(kind)


def from_record(key: Column, record: Column, input_type: str = "metadata_json", input_value: Column | None = None, **ids: Column) -> Column:
    """A paper struct from one JSON record; ids other than the record's own are given by the caller."""
    null = F.lit(None).cast("string")
    own = {"semantic_scholar_paper_id": cleaned(_variant(record, "$.paperId"))} | ids
    return F.struct(
        key.alias("paper_key"), F.lit(input_type).alias("input_type"), (null if input_value is None else input_value).alias("input_value"),
        cleaned(_variant(record, "$.title")).alias("title"), authors(record).alias("authors"), _variant(record, "$.year", "int").alias("year"),
        venue(record).alias("venue"), cleaned(_variant(record, "$.publicationDate")).alias("publication_date"), cleaned(_variant(record, "$.abstract")).alias("abstract"),
        *[own.get(k, null).alias(k) for k in IDS], null.alias("local_pdf_path"),
        external_ids(record).alias("external_ids"), source_urls(record).alias("source_urls"), record.alias("raw_metadata"),
    )


def from_identifier(key: Column, input_type: Column, input_value: Column, **ids: Column) -> Column:
    """A paper struct with identifiers only."""
    null = F.lit(None).cast("string")
    return F.struct(
        key.alias("paper_key"), input_type.alias("input_type"), input_value.alias("input_value"),
        null.alias("title"), _empty("array<string>").alias("authors"), F.lit(None).cast("int").alias("year"), *[null.alias(k) for k in FIELDS[3:]],
        *[ids.get(k, null).alias(k) for k in IDS], null.alias("local_pdf_path"),
        _empty("map<string,string>").alias("external_ids"), _empty("map<string,string>").alias("source_urls"), F.lit("{}").alias("raw_metadata"),
    )


def from_local_pdf(key: Column, path: Column, input_value: Column | None = None) -> Column:
    """A paper struct of a local file: its stem is the title."""
    null = F.lit(None).cast("string")
    given = path if input_value is None else F.coalesce(F.nullif(input_value, F.lit("")), path)
    return F.struct(
        key.alias("paper_key"), F.lit("local_pdf").alias("input_type"), given.alias("input_value"),
        stem(path).alias("title"), _empty("array<string>").alias("authors"), F.lit(None).cast("int").alias("year"), *[null.alias(k) for k in FIELDS[3:]],
        *[null.alias(k) for k in IDS], path.alias("local_pdf_path"),
        _empty("map<string,string>").alias("external_ids"), _empty("map<string,string>").alias("source_urls"), F.to_json(F.struct(path.alias("local_pdf_path"))).alias("raw_metadata"),
    )


def selected_source(path: Column) -> Column:
    """The fixed description of a local source."""
    return F.create_map(F.lit("source_name"), F.lit("local_pdf"), F.lit("pdf_url"), path, F.lit("version_type"), F.lit("local_file"), F.lit("host_type"), F.lit("local_file"))
