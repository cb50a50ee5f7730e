"""Benchmark decontamination by canonical templates.

Words are lower-cased and stripped of ASCII punctuation at their ends.  Words
with a digit and number words become the placeholder of numbers, words after a
number that name a unit that of units, and capitalised words inside a sentence
that of names; the placeholder's value is kept beside it, units in the
singular.  Windows of WIDTH
template words of documents and of benchmark items are hash-joined.  Of a run
of matches (one document, item and offset) the longest stretch counts whose
slots are consistent: equal values in the item meet equal values in the
document; so do windows with the item's own values, wherever they lie.  So a
copied question counts, even where a value in it is changed, as does one whose
numbers and names are exchanged throughout, two of them for the same one too,
but not text that shares a frame and fills one value's places at random.

Windows of fewer than PLAIN_WORDS plain words say too little as templates.
They, and the first of an item, whose words' kinds depend on what precedes it,
are matched by their very words, whatever the slots of others.  An item of
fewer than WIDTH words is matched as a whole, by its words and the signs
between them; so an item of one word contaminates every document with it.

A document is contaminated by an item if matched windows cover NEEDED words of
it, or all of an item that is shorter, or all its windows that are templates.

Defined results: null and empty texts match nothing, nor do texts without words;
rows that repeat a doc_id or item_id count as one document or item, rows of a
null id match nothing; an empty table gives an empty result; other columns
aren't read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import vec
from .shared import Scratch, materialize

WIDTH, NEEDED, PLAIN_WORDS = 8, 13, 4
NUMBER, UNIT, NAME = 1, 2, 3
NUMBERS = "one two three four five six seven eight nine ten eleven twelve twenty thirty forty fifty hundred thousand million billion zwei drei vier fünf sechs sieben acht neun zehn elf zwölf hundert tausend deux trois quatre cinq sept huit neuf dix onze douze cent mille dos tres cuatro cinco seis siete ocho nueve diez cien mil".split()
UNITS = "kg g mg lb lbs oz km m cm mm mi mile miles meter meters metre metres foot feet inch inches yard yards l ml liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years usd eur dollar dollars euro euros cent cents percent kmh mph kwh watt watts volt volts degree degrees celsius fahrenheit jahr jahre tag tage stunde stunden an ans jour jours heure heures año años día días hora horas".split()
#: Units by their plurals.
PLURALS = {u: x for u in UNITS for x in (u[:-1],) if u.endswith("s") and x in UNITS and len(x) > 1} | {"feet": "foot", "inches": "inch", "jahre": "jahr", "tage": "tag", "stunden": "stunde"}

#: exact: by the very words; strong: the window is a template, too; width: the words it has.
MATCH_SCHEMA = "id bigint, t bigint, at int, slots array<bigint>, exact boolean, strong boolean, width int"

_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?:;"]] = True


def _hashed(listed: list[str]) -> np.ndarray:
    column = pa.array([" ".join(listed)])
    return np.concatenate([vec.words(buf, at, vec.FOLDED).hash for _, _, buf, at in vec.slices(column)])


_NUMBERS, _UNITS = np.sort(_hashed(NUMBERS)), np.sort(_hashed(UNITS))
_PLURALS, _SINGULARS = _hashed(list(PLURALS)), _hashed(list(PLURALS.values()))
_PLURALS, _SINGULARS = np.sort(_PLURALS), _SINGULARS[np.argsort(_PLURALS)]
_HOLDERS = vec.mix(np.arange(4, dtype=vec.U), 77)


def _among(h: np.ndarray, listed: np.ndarray) -> np.ndarray:
    return listed[np.minimum(np.searchsorted(listed, h), len(listed) - 1)] == h


def _values(w: vec.Words, kind: np.ndarray) -> np.ndarray:
    """What a slot holds: the word and its kind, units in the singular."""
    at = np.minimum(np.searchsorted(_PLURALS, w.hash), len(_PLURALS) - 1)
    h = np.where((kind == UNIT) & (_PLURALS[at] == w.hash), _SINGULARS[at], w.hash)
    return (vec.mix(h, 5) + kind.astype(vec.U)).view(np.int64)


def canonical(w: vec.Words) -> tuple[np.ndarray, np.ndarray]:
    """Kinds of a slice's words (0 plain) and template hashes."""
    kind = np.zeros(len(w.hash), np.int8)
    if not len(kind):
        return kind, w.hash
    digits = np.concatenate(([0], np.cumsum(_DIGIT[w.buf])))
    number = (digits[w.end] > digits[w.start]) | _among(w.hash, _NUMBERS)
    opens = np.zeros(len(kind), bool)
    opens[w.off[:-1][w.off[:-1] < len(kind)]] = True
    after = np.concatenate(([False], number[:-1])) & ~opens
    first = w.buf[w.start]
    second = w.buf[np.minimum(w.start + 1, len(w.buf) - 1)]
    capital = ((first >= 65) & (first <= 90)) | ((first == 0xC3) & (second >= 0x80) & (second <= 0x9E))
    # a sentence ends where a stop or newline lies between a word and the next
    ends = np.concatenate(([0], np.cumsum(_STOP[w.buf] | (w.buf == 10))))
    gap = np.concatenate(([1], ends[w.start[1:]] - ends[w.end[:-1]])) > 0
    kind[capital & ~gap & ~opens] = NAME
    kind[after & _among(w.hash, _UNITS)] = UNIT
    kind[number] = NUMBER
    return kind, np.where(kind > 0, _HOLDERS[kind], w.hash)


def _very_words(w: vec.Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all stretches of ``width`` words by their very words, and the first word of each; below WIDTH with the signs between them."""
    t, _, first = vec.windows(w.hash, w.off, width, short=False)
    if width < WIDTH and len(first):
        solid = np.flatnonzero((w.buf != 32) & ((w.buf < 9) | (w.buf > 13)))
        start, end = np.searchsorted(solid, w.start), np.searchsorted(solid, w.end)
        signs = vec.spans(vec.PLAIN[w.buf[solid]], end[:-1], start[1:])
        for j in range(width - 1):
            t = t + vec.mix(signs[first + j], 100 + j)
    return vec.mix(t, 200 + width), first


def windows(rows: DataFrame, bloom: vec.Bloom | None = None, widths: tuple[int, ...] = ()) -> DataFrame:
    """``rows(id, text)`` to MATCH_SCHEMA: hash, place, and values of the slots in order.

    Without ``bloom``, of benchmark items; with it, of documents, also by the
    very words of ``widths`` words, which come once for each text.
    """

    def parts(w: vec.Words):
        kind, h = canonical(w)
        t, _, first = vec.windows(h, w.off, WIDTH, short=False)
        plain = np.concatenate(([0], np.cumsum(kind == 0)))
        strong = plain[first + WIDTH] - plain[first] >= PLAIN_WORDS
        value = _values(w, kind)
        yield t[strong], first[strong], lambda f: value[f : f + WIDTH][kind[f : f + WIDTH] > 0], False, strong[strong], WIDTH
        none = lambda f: value[:0]
        if bloom is not None:
            for width in widths:
                x, at = _very_words(w, width)
                yield x, at, none, True, np.zeros(len(x), bool), width
            return
        x, at = _very_words(w, WIDTH)
        some = ~strong | np.isin(at, w.off[:-1])
        yield x[some], at[some], none, True, strong[some], WIDTH
        for width in np.unique(w.n[(w.n > 0) & (w.n < WIDTH)]).tolist():
            x, at = _very_words(w, width)
            some = np.isin(at, w.off[:-1][w.n == width])
            yield x[some], at[some], none, True, np.zeros(some.sum(), bool), width

    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for lo, _, buf, at in vec.slices(batch.column(1)):
                w = vec.words(buf, at, vec.FOLDED)
                for t, first, slots, exact, strong, width in parts(w):
                    if bloom is not None and len(t):
                        some = bloom.has(t)
                        t, first, strong = t[some], first[some], strong[some]
                    text = np.searchsorted(w.off, first, "right") - 1
                    if bloom is not None and exact and len(t):
                        order = np.lexsort((t, text))
                        t, first, strong, text = t[order], first[order], strong[order], text[order]
                        one = np.concatenate(([True], (t[1:] != t[:-1]) | (text[1:] != text[:-1])))
                        t, first, strong, text = t[one], first[one], strong[one], text[one]
                    if not len(t):
                        continue
                    columns = [vec.signed(t), pa.array((first - w.off[text]).astype(np.int32)), pa.array([slots(f) for f in first], pa.list_(pa.int64()))]
                    columns += [pa.array(np.full(len(t), exact)), pa.array(strong), pa.array(np.full(len(t), width, np.int32))]
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(lo + text)), *columns], ["id", "t", "at", "slots", "exact", "strong", "width"])

    return rows.where("id is not null").mapInArrow(run, MATCH_SCHEMA)


def _texts(rows: DataFrame, key: str) -> DataFrame:
    return rows.select(rows[key].cast("bigint").alias("id"), rows["text"].cast("string").alias("text"))


def stretch(windows: list[dict]) -> list[dict]:
    """Of a run's windows in order of place, the longest consistent stretch and all with the item's own values."""
    pairs = [list(zip(w["item_slots"], w["slots"], strict=True)) for w in windows]
    best, lo = (0, 0, 0), 0
    held: dict[int, dict[int, int]] = {}
    for hi, new in enumerate(pairs):
        for x, y in new:
            of = held.setdefault(x, {})
            of[y] = of.get(y, 0) + 1
        while any(len(held[x]) > 1 for x, _ in new):  # at worst until nothing is left
            for x, y in pairs[lo]:
                held[x][y] -= 1
                if not held[x][y]:
                    del held[x][y]
            lo += 1
        if hi >= lo and (words := windows[hi]["item_at"] - windows[lo]["item_at"]) + 1 > best[0]:
            best = words + 1, lo, hi + 1
    return [w for k, w in enumerate(windows) if best[1] <= k < best[2] or w["slots"] == w["item_slots"]]


def _stretches(batches):
    for batch in batches:
        out = []
        for doc, item, windows in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            some = stretch(windows)
            same = int(all(w["slots"] == w["item_slots"] for w in some))
            out += [(doc, item, w["item_at"], w["strong"], w["width"], same) for w in some]
        columns = list(zip(*out, strict=True)) or [()] * 6
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.int32(), pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "item_id", "item_at", "strong", "width", "same"])


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``(doc_id, item_id, n_windows, item_windows, n_words, exact)`` of all contaminated documents.

    The benchmark's window hashes reach the tasks as a Bloom table of fixed
    size; what it lets through is joined exactly.  A benchmark passage that
    many documents hold costs one row per window and item, never pairs of
    documents.
    """
    with Scratch(docs.sparkSession) as scratch:
        return materialize(_contaminated(docs, benchmark, scratch), "contaminated")


def _contaminated(docs: DataFrame, benchmark: DataFrame, scratch: Scratch) -> DataFrame:
    items = scratch.table(windows(_texts(benchmark, "item_id")).distinct(), "benchmark-windows")
    widths = tuple(r[0] for r in items.where("exact").select("width").distinct().collect())  # WIDTH at most
    hits = windows(_texts(docs, "doc_id"), bloom=vec.bloom_of(items, "t", 24), widths=widths).select("id", "t", "at", "slots", F.col("exact").alias("doc_exact"), F.col("width").alias("doc_width"))
    i = items.select(F.col("id").alias("item_id"), "t", F.col("at").alias("item_at"), F.col("slots").alias("item_slots"), "exact", "strong", "width")
    both = hits.join(i, "t").where((F.col("doc_exact") == F.col("exact")) & (F.col("doc_width") == F.col("width")))
    met = scratch.table(both.select(F.col("id").alias("doc_id"), "item_id", "at", "item_at", "slots", "item_slots", "exact", "strong", "width"), "benchmark-matches")

    run, place = ["doc_id", "item_id", "offset"], ["doc_id", "item_id", "item_at", "strong", "width"]
    very = met.where("exact").select(*place, F.lit(1).alias("same"))
    met = met.where(~F.col("exact")).withColumn("offset", F.col("at") - F.col("item_at")).select(*run, "item_at", "slots", "item_slots", "strong", "width").distinct()
    # an item has a bounded number of windows
    listed = met.groupBy(*run).agg(F.sort_array(F.collect_list(F.struct("item_at", "slots", "item_slots", "strong", "width"))).alias("windows")).select("doc_id", "item_id", "windows")
    runs = listed.mapInArrow(_stretches, "doc_id bigint, item_id bigint, item_at int, strong boolean, width int, same int").unionByName(very)
    templates = lambda at: F.count_distinct(F.when(F.col("strong"), F.col(at)))
    sizes = items.groupBy(F.col("id").alias("item_id")).agg(F.count_distinct("at").alias("item_windows"), templates("at").alias("item_templates"))
    found = runs.groupBy("doc_id", "item_id").agg(F.count_distinct("item_at").alias("n_windows"), templates("item_at").alias("n_templates"), F.sort_array(F.collect_set(F.struct("item_at", "width"))).alias("places"), F.min("same").alias("same"))
    # words under the union of the windows: an item has a bounded number of places
    covered = F.aggregate("places", F.struct(F.lit(0).alias("n"), F.lit(0).alias("upto")), lambda a, p: F.struct((a["n"] + p["width"] - F.greatest(a["upto"] - p["item_at"], F.lit(0))).alias("n"), (p["item_at"] + p["width"]).alias("upto")))["n"]
    found = found.withColumn("n_words", covered.cast("bigint")).join(sizes, "item_id")
    whole = (F.col("n_windows") >= F.col("item_windows")) | ((F.col("item_templates") > 0) & (F.col("n_templates") >= F.col("item_templates")))
    return found.where((F.col("n_words") >= NEEDED) | whole).select("doc_id", "item_id", "n_windows", "item_windows", "n_words", (F.col("same") == 1).alias("exact"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without contaminated documents; rows without a doc_id stay."""
    bad = contaminated(docs, benchmark).select(F.col("doc_id").alias("bad_id")).distinct()
    return docs.join(bad, docs["doc_id"] == bad["bad_id"], "left_anti")
