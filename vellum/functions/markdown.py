"""Structure of Markdown texts as column expressions: counts, image references, caption rewriting.

White space is spelled out as the Unicode class that text tools commonly use,
because regular-expression dialects differ in ``\\s``; ``(?d)`` lets only
``\\n`` end a line.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WHITE = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_ALT, _END = r"!\x5B{}\x5D\x28", r"\x29"
IMAGE = _ALT.format(r"[^\x5D]*") + r"[^\x29]+" + _END
#: An image whose target ends in a raster suffix: alt text and target.
CAPTIONABLE = _ALT.format(r"([^\x5D]*)") + r"([^\x29]+[.](?i:gif|png|webp|jpe?g))" + _END
TABLE = rf"(?dm)^[|].+[|]{WHITE}*\n[|][-:| ]+[|]"
HEADING = rf"(?dm)^#{{1,6}}{WHITE}+"


def normalised_newlines(text: Column) -> Column:
    """``\\r\\n`` and lone ``\\r`` become ``\\n``."""
    return F.regexp_replace(text, "\r\n?", "\n")


def image_count(md: Column) -> Column:
    return F.regexp_count(md, F.lit(IMAGE)).cast("bigint")


def table_count(md: Column) -> Column:
    """Lines between pipes that a separator row follows."""
    return F.regexp_count(md, F.lit(TABLE)).cast("bigint")


def equation_count(md: Column) -> Column:
    """Pairs of ``$$``."""
    marks = F.length(md) - F.length(F.replace(md, F.lit("$$"), F.lit("")))
    return F.shiftright(marks, 2).cast("bigint")


def heading_count(md: Column) -> Column:
    return F.regexp_count(md, F.lit(HEADING)).cast("bigint")


def captionable_count(md: Column) -> Column:
    return F.regexp_count(md, F.lit(CAPTIONABLE)).cast("bigint")


def statistics(md: Column) -> list[Column]:
    """The structural counts of an extraction, aliased."""
    return [image_count(md).alias("num_images"), table_count(md).alias("num_tables"), equation_count(md).alias("num_equations"), heading_count(md).alias("num_headings")]


def captionable(md: Column) -> Column:
    """Array of ``(tag, alt, target)`` of captionable images in order."""
    tags, alts, targets = (F.regexp_extract_all(md, F.lit(CAPTIONABLE), F.lit(k)) for k in range(3))
    return F.transform(F.arrays_zip(tags.alias("tag"), alts.alias("alt"), targets.alias("target")), lambda x: F.struct(x["tag"].alias("tag"), x["alt"].alias("alt"), x["target"].alias("target")))


def rewritten(md: Column, captions: Column) -> Column:
    """``md`` with the k-th captionable image's alt text replaced by ``captions[k]``.

    A null or empty caption leaves its tag.  The rewriting goes by position:
    a caption that looks like a later tag, or a tag repeated inside another
    one's target, is never taken for the image itself.
    """
    between = F.split(md, CAPTIONABLE, -1)
    tags = F.zip_with(captionable(md), captions, lambda x, c: F.when(F.coalesce(c, F.lit("")) != "", F.concat(F.lit("!["), c, F.lit("]("), x["target"], F.lit(")"))).otherwise(x["tag"]))
    return F.array_join(F.zip_with(between, tags, lambda text, tag: F.concat(text, F.coalesce(tag, F.lit("")))), "")
