"""Quality rules with adaptive thresholds.

Counts of each whole text are taken in one Arrow pass, by column.  The rules'
values, as integers per million, go into quantile sketches per language and
source: counts of logarithmic bins whose relative width is 1/64 (a histogram
sketch).  The sketches merge by adding counts, whatever the order and
partitioning, so the thresholds are the same on every run; Spark adds them
map-side first, and a source that holds a third of all rows sends a few hundred
rows per task.

Most documents have no symbol, no equal lines and no repeated words at all, so
quartiles of plain rates are 0 and tell nothing.  One is added to each count: a
document without any then stands for the least rate that one of its length can
show, and the quartiles carry the group's lengths and its usual rates.  A
group's fence for a rule is q3 * r ** k, r being q3 / q1, at least the rule's
``TIGHT`` (where all documents are alike, r says nothing of chance); mean word
lengths have a lower fence q1 / r ** k too.  Groups of fewer than ``LEAST``
documents use their language's fences, small languages those of the whole
table.  A source full of junk can't excuse itself: no fence lies beyond
``CEILING`` times that of the whole table.

Defined results: a null or empty text has no words and fails the base rule; a
null language or source is a group of its own; repeated rows each count and
each get a row; an empty table gives an empty result; other columns aren't read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import vec
from .shared import materialize

SYMBOLS = "#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")

#: rule: (value, doubled exponent k, TIGHT, whether there is a lower fence)
RULES = {
    "symbols": ("1000000 * (n_symbols + 1) div (word_chars + 1)", 4, 2.0, False),
    "dup_lines": ("1000000 * (n_dup_lines + 1) div (n_lines + 1)", 3, 2.0, False),
    "repeats": ("1000000 * (n_repeat_words + 1) div (n_words + 1)", 4, 2.0, False),
    "word_length": ("1000000 * word_chars div greatest(n_words, 1)", 10, 1.04, True),
}
LEAST, CEILING = 100, 2
#: Bins hold values exactly up to 2 ** BITS and to 1 part in 2 ** (BITS - 1) above.
BITS = 7

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in SYMBOLS]] = True


def _per_text(flag: np.ndarray, at: np.ndarray) -> np.ndarray:
    return vec.sums(flag.astype(np.int64), at)


def _again(h: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which hashes occur more than once in their text, and which of these are not the first."""
    key = h + vec.mix(text.astype(vec.U), 9)
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    some, later = np.zeros(len(h), bool), np.zeros(len(h), bool)
    later[order[1:][same]] = True
    some[order[:-1][same]] = True
    return some | later, later


def counts_of(column: pa.Array) -> np.ndarray:
    """COUNTS of whole texts, a row each; null counts as empty."""
    out = [np.zeros((0, len(COUNTS)), np.int64)]
    for lo, hi, buf, at in vec.slices(column):
        n = hi - lo
        w = vec.words(buf, at)
        text = w.text
        chars = ((buf & 0xC0) != 0x80) & (buf != 32) & ((buf < 9) | (buf > 13))
        # lines that have a word, whole
        newline = np.flatnonzero(buf == 10)
        k = np.searchsorted(newline, w.start)
        head = np.flatnonzero(np.concatenate(([True], (text[1:] != text[:-1]) | (k[1:] != k[:-1])))) if len(text) else text
        edge = np.concatenate(([-1], newline, [len(buf)]))
        owner = text[head]
        start, end = np.maximum(edge[k[head]] + 1, at[owner]), np.minimum(edge[k[head] + 1], at[owner + 1])
        _, dup = _again(vec.spans(vec.PLAIN[buf], start, end), owner)
        # words in windows of three that occur again
        t, off, first = vec.windows(w.hash, w.off, 3, short=False)
        some, _ = _again(t, np.repeat(np.arange(n), np.diff(off)))
        cover = np.zeros(len(text) + 1, np.int64)
        np.add.at(cover, first[some], 1)
        np.add.at(cover, first[some] + 3, -1)
        repeat = np.cumsum(cover)[:-1] > 0
        per = lambda x, o: np.bincount(o[x], minlength=n)
        out.append(np.stack([w.n, _per_text(chars, at), _per_text(_SYMBOL[buf], at), per(dup, owner), per(repeat, text), np.bincount(owner, minlength=n)], axis=1))
    return np.concatenate(out)


def counted(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text, lang, source)`` to keys and COUNTS, without the texts."""

    def run(batches):
        for batch in batches:
            got = counts_of(batch.column(3))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *(pa.array(np.ascontiguousarray(x)) for x in got.T)], ["doc_id", "lang", "source", *COUNTS])

    own = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["lang"].cast("string").alias("lang"), docs["source"].cast("string").alias("source"), docs["text"].cast("string").alias("text"))
    return own.mapInArrow(run, "doc_id bigint, lang string, source string, " + ", ".join(f"{c} bigint" for c in COUNTS))


def value(rule: str) -> Column:
    """A rule's value of a document with words, at least 1."""
    return F.expr(f"greatest({RULES[rule][0]}, 1)")


def bin_of(x: Column) -> Column:
    """The lowest value of a non-negative integer's bin."""
    drop = F.greatest(F.length(F.bin(x)) - BITS, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", x, drop), drop)


def sketches(stats: DataFrame) -> DataFrame:
    """Mergeable sketches ``(lang, source, rule, bin, n)`` of all documents with words."""
    rules = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), bin_of(value(r)).alias("bin")) for r in RULES]))
    return stats.where("n_words > 0").select("lang", "source", rules.alias("x")).groupBy("lang", "source", F.col("x.rule").alias("rule"), F.col("x.bin").alias("bin")).agg(F.count("*").alias("n"))


def fences(sketch: DataFrame, *by: str) -> DataFrame:
    """Upper and lower fences per group of ``by`` and rule out of merged sketches."""
    merged = sketch.groupBy(*by, "rule", "bin").agg(F.sum("n").alias("n"))
    listed = merged.groupBy(*by, "rule").agg(F.sort_array(F.collect_list(F.struct("bin", "n"))).alias("bins"), F.sum("n").alias("docs"))  # a few hundred bins at most

    def quantile(percent: int) -> Column:
        start = F.struct(F.lit(0).cast("bigint").alias("seen"), F.lit(None).cast("bigint").alias("at"))
        step = lambda acc, x: F.struct((acc["seen"] + x["n"]).alias("seen"), F.when(acc["at"].isNull() & ((acc["seen"] + x["n"]) * 100 >= F.col("docs") * percent), x["bin"]).otherwise(acc["at"]).alias("at"))
        return F.aggregate("bins", start, step)["at"].cast("double")

    def by_rule(of) -> Column:
        out = F.lit(None).cast("double")
        for rule, (_, k, tight, lower) in RULES.items():
            out = F.when(F.col("rule") == rule, of(F.greatest(F.col("q3") / F.col("q1"), F.lit(tight)), k, lower)).otherwise(out)
        return out

    def upper(r: Column, k: int, lower: bool) -> Column:
        out = F.col("q3")
        for _ in range(k // 2):
            out = out * r
        return out * F.sqrt(r) if k % 2 else out

    def below(r: Column, k: int, lower: bool) -> Column:
        out = F.col("q1") if lower else F.lit(0.0)
        for _ in range(k // 2):
            out = out / r
        return out

    return listed.select(*by, "rule", "docs", quantile(25).alias("q1"), quantile(75).alias("q3")).withColumn("fence", by_rule(upper)).withColumn("least", by_rule(below))


def thresholds(sketch: DataFrame) -> DataFrame:
    """One row per language and source: the fences of each rule, from the smallest group that is large enough."""
    small = materialize(sketch, "quality-sketch")
    group, lang, whole = fences(small, "lang", "source"), fences(small, "lang"), fences(small)
    l = lang.select(F.col("lang").alias("l"), F.col("rule").alias("lr"), F.col("docs").alias("ld"), F.col("fence").alias("lf"), F.col("least").alias("ll"))  # noqa: E741
    w = whole.select(F.col("rule").alias("wr"), F.col("fence").alias("wf"), F.col("least").alias("wl"))
    picked = group.join(l, F.col("lang").eqNullSafe(F.col("l")) & (F.col("rule") == F.col("lr"))).join(w, F.col("rule") == F.col("wr"))
    pick = lambda own, of_lang, of_all: F.when(F.col("docs") >= LEAST, F.col(own)).when(F.col("ld") >= LEAST, F.col(of_lang)).otherwise(F.col(of_all))
    fence = F.least(pick("fence", "lf", "wf"), CEILING * F.col("wf"))
    least = F.greatest(pick("least", "ll", "wl"), F.col("wl") / CEILING)
    of = lambda r, x: F.max(F.when(F.col("rule") == r, x))
    # written, so that Spark knows its size before it plans the join, and moves no texts where it is small
    return materialize(picked.groupBy(F.col("lang").alias("t_lang"), F.col("source").alias("t_source")).agg(*[of(r, fence).alias(f"max_{r}") for r in RULES], *[of(r, least).alias(f"min_{r}") for r, x in RULES.items() if x[3]]), "quality-fences")


def verdict(joined: DataFrame) -> tuple[Column, Column]:
    """base_failed and kept of rows with COUNTS and thresholds."""
    base = F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words")
    fine = ~base
    for r, (*_, lower) in RULES.items():
        fine = fine & (value(r) <= F.col(f"max_{r}"))
        if lower:
            fine = fine & (value(r) >= F.col(f"min_{r}"))
    return base, F.coalesce(fine, F.lit(False))


def judged(docs: DataFrame) -> DataFrame:
    """Every document's counts, thresholds and verdict.

    The join to the thresholds leaves the choice of strategy to Spark, which
    broadcasts them only if their measured size is below its limit and splits
    skewed sources otherwise.
    """
    stats = materialize(counted(docs), "quality-counts")
    limits = thresholds(sketches(stats))
    joined = stats.join(limits, F.col("lang").eqNullSafe(F.col("t_lang")) & F.col("source").eqNullSafe(F.col("t_source")), "left")
    base, kept = verdict(joined)
    return joined.withColumn("base_failed", base).withColumn("kept", kept)


def report(docs: DataFrame) -> DataFrame:
    return judged(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def keep(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns.

    Texts are counted twice, for the sketches and in place for the verdict;
    that costs less than a join of whole documents to their verdicts, and each
    row is judged by itself, with or without a doc_id.
    """
    limits = thresholds(sketches(counted(docs)))

    @F.arrow_udf("struct<" + ", ".join(f"{c}: bigint" for c in COUNTS) + ">")
    def counts(text: pa.Array) -> pa.Array:
        return pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(x)) for x in counts_of(text).T], list(COUNTS))

    own = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs["lang"].cast("string").alias("own_lang"), docs["source"].cast("string").alias("own_source"), counts(docs["text"].cast("string")).alias("own"))
    own = own.select("row", "own_lang", "own_source", "own.*")
    joined = own.join(limits, F.col("own_lang").eqNullSafe(F.col("t_lang")) & F.col("own_source").eqNullSafe(F.col("t_source")), "left")
    return joined.where(verdict(joined)[1]).select("row.*")
