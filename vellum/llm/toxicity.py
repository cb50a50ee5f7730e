"""Toxicity with noisy-channel deobfuscation.

1. A character trigram model is counted over the words of all documents.
2. Words that mix letters with any sign that the lattice can replace or drop,
   runs of single letters set apart, and letters repeated three times or more
   are decoded: a lattice offers for each sign the letters it may stand for, or
   nothing, and in runs of single letters also the end of a word; the Viterbi
   path that the channel and the character model like best is the restored
   text.  Plain words have one path, themselves.
3. Restored words and their beginnings of 3 to 6 bytes are features; where a
   run of single letters leaves open how it splits, each of its letters may begin
   a word and each of the SPAN bytes after it may end one.  Weights
   are log odds between toxic and other documents of one half of a labelled
   sample; the other half fits the logistic function that turns a document's
   strongest weights into a score.

The sample has at most ``SAMPLE`` labelled rows, those with the smallest hashes
of their doc_id; rows whose crc32(doc_id as text) mod 5 is 0 are held out.
Everything else covers all rows and whole texts.  Labels, lang, source and
doc_id are no inputs of a score.

Defined results: null and empty texts score as a text without evidence; without
usable labels every score is the same; documents with contradictory labels
teach nothing, of rows that share a labelled doc_id the least text teaches;
rows that repeat get equal scores, a null doc_id is held
out; an empty table gives an empty result; other columns aren't read.
"""

from __future__ import annotations

import functools
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import vec
from .shared import materialize

SAMPLE = 10_000
#: A feature needs so many toxic documents of its half, and log odds of at least this.
LEAST, ODDS = 3, 2.0
PREFIXES = (3, 4, 5, 6)
#: Longest whole word looked up within a run of single letters; longer ones show by their beginnings.
SPAN = 32
LETTERS = "abcdefghijklmnopqrstuvwxyzäöüßàâçéèêëîïôùûñáíóúœæ"
#: Letters that a digit or sign may stand for.
LOOKS = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "*": "aeiou", "#": "aeiou"}
#: Signs that may stand for nothing.
NOTHING = set(".-_*~'`^,:; ·​") | set("@$!|+(#%&/=")
#: Costs of the channel: a look-alike, a sign dropped, a repeated letter dropped.
LOOK, DROP, REPEAT = 1.0, 2.0, 0.5

_WIDTH = 64
_IDS = np.ones(0x250, np.uint8)  # 1: any other letter
for _c in range(0x250):
    if not chr(_c).isalpha():
        _IDS[_c] = 0
    elif chr(_c).lower() in LETTERS:
        _IDS[_c] = 2 + LETTERS.index(chr(_c).lower())


# ---- the character model ----


def _trigrams(raw: bytes) -> np.ndarray:
    """Trigram counts of a text's letters, words being set apart by id 0."""
    code = np.frombuffer(raw.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    ids = np.where(code < 0x250, _IDS[np.minimum(code, 0x24F)], 0).astype(np.int64)
    ids = np.concatenate(([0, 0], ids, [0]))
    return np.bincount((ids[:-2] << 12) | (ids[1:-1] << 6) | ids[2:], minlength=_WIDTH**3)


def character_counts(docs: DataFrame) -> np.ndarray:
    """Trigram counts over all documents; 64 ** 3 numbers at most, summed by Spark."""

    def run(batches):
        total = np.zeros(_WIDTH**3, np.int64)
        for batch in batches:
            for _, _, buf, at in vec.slices(batch.column(0)):
                # texts are parted by a blank, so that no trigram spans two
                total += _trigrams(b" ".join(buf[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["k", "n"])

    counts = np.zeros(_WIDTH**3)
    for k, n in docs.select(docs["text"].cast("string").alias("text")).mapInArrow(run, "k int, n bigint").groupBy("k").agg(F.sum("n").alias("n")).toLocalIterator():
        counts[k] = n
    return counts


def log_probabilities(counts: np.ndarray) -> np.ndarray:
    """Interpolated log P(c | a, b) as an array of 64 by 64 by 64."""
    c3 = counts.reshape(_WIDTH, _WIDTH, _WIDTH)
    c2, c1 = c3.sum(axis=0), c3.sum(axis=(0, 1))
    p1 = (c1 + 0.1) / (c1.sum() + 0.1 * _WIDTH)
    p2 = (c2 + 5 * p1) / (c2.sum(axis=1, keepdims=True) + 5)
    return np.log((c3 + 5 * p2) / (c3.sum(axis=2, keepdims=True) + 5)).astype(np.float32)


# ---- the channel ----


@functools.lru_cache(maxsize=1 << 16)
def _arcs(c: str) -> tuple[tuple[str, float], ...]:
    """(letters, cost) that an observed character may stand for."""
    low = c.lower()
    out = [(low, 0.0)] if low.isalpha() else [(x, LOOK) for x in LOOKS.get(low, "")]
    if low in NOTHING or not out:
        out.append(("", DROP if low in LOOKS else DROP / 4))
    return tuple(out)


def _id(c: str) -> int:
    return int(_IDS[ord(c)]) if len(c) == 1 and ord(c) < 0x250 else 1


def decode(observed: str, model: np.ndarray, breaks: bool = False) -> str:
    """The best path through the lattice of an observed word; with ``breaks``, of words whose limits are unknown."""
    # state: the last two letters' ids and the last observed letter's run
    best: dict[tuple[int, int], tuple[float, tuple]] = {(0, 0): (0.0, ())}
    previous, run = "", 0
    for k, c in enumerate(observed):
        low = c.lower()
        run = run + 1 if low == previous else 1
        previous = low
        again = low.isalpha() and (run > 1) and (run > 2 or observed[k + 1 : k + 2].lower() == low)
        arcs = _arcs(c) + ((("", REPEAT),) if again else ())
        new: dict[tuple[int, int], tuple[float, tuple]] = {}
        for (a, b), (score, path) in best.items():
            for letter, cost in arcs:
                if letter:
                    x = _id(letter)
                    key, s, p = (b, x), score - cost + float(model[a, b, x]), (path, letter)
                else:
                    key, s, p = (a, b), score - cost, path
                if key not in new or s > new[key][0]:
                    new[key] = (s, p)
        if breaks:
            for (a, b), (score, path) in list(new.items()):
                key, s = (b, 0), score + float(model[a, b, 0])
                if b and (key not in new or s > new[key][0]):
                    new[key] = (s, (path, " "))
        best = new
    end = max(((score + float(model[a, b, 0]), path) for (a, b), (score, path) in best.items()), key=lambda x: x[0])[1]
    out = []
    while end:
        end, letter = end
        out.append(letter)
    return "".join(reversed(out))


_EDGE = re.compile(r"^[^\w$@!|(+€]+|[^\w]{2,}$|[.,;:?!)\]}\"'’]+$")


def restored(word: str, model: np.ndarray) -> str:
    """A suspicious word without the punctuation around it, decoded."""
    core = _EDGE.sub("", word)
    return decode(_EDGE.sub("", core), model)


@functools.cache
def _alphabetic() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _foreign(buf: np.ndarray) -> np.ndarray:
    """Which bytes belong to characters beyond ASCII that are no letters."""
    lead = np.flatnonzero(buf >= 0xC0)
    size = 2 + (buf[lead] >= 0xE0) + (buf[lead] >= 0xF0)
    code = buf[lead].astype(np.int64) & (0x7F >> size)
    for k in range(1, 4):
        code = np.where(size > k, code << 6 | buf[np.minimum(lead + k, len(buf) - 1)] & 0x3F, code)
    other = ~_alphabetic()[np.minimum(code, 0x10FFFF)]
    out = np.zeros(len(buf), bool)
    for k in range(4):
        out[np.minimum(lead + k, len(buf) - 1)[other & (size > k)]] = True
    return out


def suspicious(w: vec.Words) -> np.ndarray:
    """Which words of a slice need decoding; see the module's text."""
    buf = w.buf
    if not len(w.start):
        return np.zeros(0, bool)
    foreign = _foreign(buf)
    letter = ((buf | 32) >= 97) & ((buf | 32) <= 122) & (buf < 0x80) | (buf >= 0x80) & ~foreign
    sign = ~letter & (buf > 32)
    low = buf | 32
    triple = np.zeros(len(buf), bool)
    triple[2:] = letter[2:] & (buf[2:] < 0x80) & (low[2:] == low[1:-1]) & (low[2:] == low[:-2])
    within = lambda flag: (lambda c: c[w.end] - c[w.start])(np.concatenate(([0], np.cumsum(flag))))
    letters = within(letter)
    # a sign counts if a letter follows it in the word, or it looks like a letter and is after one
    follows = np.zeros(len(buf), bool)
    follows[:-1] = sign[:-1] & letter[1:]
    looks = np.zeros(len(buf), bool)
    looks[1:] = np.isin(buf[1:], [ord(c) for c in LOOKS if ord(c) < 128]) & letter[:-1]
    return (letters > 0) & ((within(follows) > 0) | (within(looks) > 0) | (within(foreign) > 0) | (within(triple) > 0))


def _singles(w: vec.Words) -> np.ndarray:
    """Starts of runs of three or more words of one character, and the runs' lengths."""
    begun = np.concatenate(([0], np.cumsum((w.buf & 0xC0) != 0x80)))
    one = begun[w.end] - begun[w.start] == 1
    edge = np.diff(np.concatenate(([0], one.astype(np.int8), [0])))
    edge_start, edge_end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return np.array([(a, b) for a, b in zip(edge_start, edge_end, strict=True) if b - a >= 3], np.int64).reshape(-1, 2)


def extra_words(w: vec.Words, model: np.ndarray) -> tuple[list[int], list[str], list[int], list[str]]:
    """(text, restored word) of all obfuscations in a slice, and (text, restored run) of letters set apart."""
    texts, words, owners, runs = [], [], [], []
    text = w.text
    for k in np.flatnonzero(suspicious(w)):
        texts.append(int(text[k]))
        words.append(restored(w.buf[w.start[k] : w.end[k]].tobytes().decode("utf-8", "replace"), model))
    for a, b in _singles(w) if len(w.start) else ():
        for x, y in _within_texts(text, a, b):
            run = "".join(w.buf[w.start[k] : w.end[k]].tobytes().decode("utf-8", "replace") for k in y)
            if any(map(str.isalpha, run)):
                owners.append(x)
                runs.append(decode(run, model, breaks=True).replace(" ", ""))
            else:  # digits of a table, as one word
                texts.append(x)
                words.append(decode(run, model))
    return texts, words, owners, runs


def _within_texts(text: np.ndarray, a: int, b: int):
    cuts = [a, *(np.flatnonzero(np.diff(text[a:b])) + a + 1), b]
    for x, y in zip(cuts, cuts[1:], strict=False):
        if y - x >= 3:
            yield int(text[x]), range(x, y)


# ---- features ----


def _features(w: vec.Words) -> tuple[np.ndarray, np.ndarray]:
    """(word, feature hash) of all words and beginnings in a slice."""
    at, h = [np.arange(len(w.start))], [vec.mix(w.hash, 11)]
    for n in PREFIXES:
        some = np.flatnonzero(w.end - w.start > n)
        at.append(some)
        h.append(vec.mix(vec.spans(w.value, w.start[some], w.start[some] + n), 20 + n))
    return np.concatenate(at), np.concatenate(h)


def _features_within(w: vec.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, position, feature hash) of all that words of unknown limits may hold, at every position."""
    n = w.end - w.start
    word = np.repeat(np.arange(len(n)), n)
    start = np.arange(len(word)) - np.repeat(np.cumsum(n) - n - w.start, n)
    begins = (w.buf[start] & 0xC0) != 0x80
    word, start = word[begins], start[begins]
    left = w.end[word] - start
    at, h = [], []
    for k in range(1, SPAN + 1):
        some = np.flatnonzero(left >= k)
        at.append(some)
        h.append(vec.mix(vec.spans(w.value, start[some], start[some] + k), 11))
    for k in PREFIXES:
        some = np.flatnonzero(left > k)
        at.append(some)
        h.append(vec.mix(vec.spans(w.value, start[some], start[some] + k), 20 + k))
    return word, np.concatenate(at), np.concatenate(h)


def _restored_words(texts: list[int], words: list[str]) -> tuple[np.ndarray, vec.Words]:
    """Restored words as one slice, and the texts they belong to; those that came out empty vanish."""
    pairs = [(t, x) for t, x in zip(texts, words, strict=True) if x]
    (_, _, buf, at), *more = vec.slices(pa.array([" ".join(x for _, x in pairs)]))
    assert not more
    r = vec.words(buf, at, vec.FOLDED)
    if len(r.start) != len(pairs):  # a restored word is letters only
        raise ValueError("restored words must be words")
    return np.array([t for t, _ in pairs], np.int64), r


def slices_of(column: pa.Array, model: np.ndarray):
    """(first text, end, list of (texts of words, words, features)) of a column: plain words, then restored ones."""
    for lo, hi, buf, at in vec.slices(column):
        plain = vec.words(buf, at)
        w = vec.words(buf, at, vec.FOLDED)
        parts = [(w.text, *_features(w))]
        texts, words, owners, runs = extra_words(plain, model)
        if any(words):
            owner, r = _restored_words(texts, words)
            parts.append((owner, *_features(r)))
        if any(runs):
            owner, r = _restored_words(owners, runs)
            word, at, h = _features_within(r)
            parts.append((owner[word], at, h))
        yield lo, hi, parts


def _evidence(weights_of, n: int, parts) -> np.ndarray:
    """Per text: the strongest word's weight, the sum of the five strongest, and the number of words with any."""
    text = np.concatenate([t for t, _, _ in parts])
    base = np.cumsum([0] + [len(t) for t, _, _ in parts])
    word, weight = [], []
    for k, (_, at, h) in enumerate(parts):
        some, x = weights_of(h)
        word.append(at[some] + base[k])
        weight.append(x)
    word, weight = np.concatenate(word), np.concatenate(weight)
    out = np.zeros((n, 3))
    if not len(word):
        return out
    order = np.lexsort((-weight, word))
    word, weight = word[order], weight[order]
    one = np.concatenate(([True], word[1:] != word[:-1]))
    owner, weight = text[word[one]], weight[one]
    order = np.lexsort((-weight, owner))
    owner, weight = owner[order], weight[order]
    first = np.searchsorted(owner, np.arange(n + 1))
    rank = np.arange(len(owner)) - first[owner]
    np.maximum.at(out[:, 0], owner, weight)
    np.add.at(out[:, 1], owner[rank < 5], weight[rank < 5])
    np.add.at(out[:, 2], owner, 1.0)
    return out


class Lexicon:
    """Feature weights: a bit table for a first look, sorted hashes for the exact one."""

    def __init__(self, h: np.ndarray, weight: np.ndarray):
        order = np.argsort(h)
        self.h, self.weight = h[order], weight[order]
        self.bloom = vec.Bloom(20)
        self.bloom.add(self.h)

    def __call__(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.h):
            return np.zeros(0, np.int64), np.zeros(0)
        some = np.flatnonzero(self.bloom.has(h))
        at = np.minimum(np.searchsorted(self.h, h[some]), len(self.h) - 1)
        fine = self.h[at] == h[some]
        return some[fine], self.weight[at[fine]]


def _inputs(x: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones(len(x)), x[:, 0], x[:, 1] / 5, np.log1p(x[:, 2])])


def fitted(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps with a small ridge."""
    beta, z = np.zeros(4), _inputs(x)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        gradient = z.T @ (y - p) - 0.1 * beta
        step = np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]) + 0.1 * np.eye(4), gradient)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta


# ---- Spark ----


def held_out(doc_id):
    """crc32(doc_id as text) mod 5 is 0; null ids too."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def learned(docs: DataFrame, labels: DataFrame, model: np.ndarray, sample: int = SAMPLE) -> tuple[Lexicon, np.ndarray]:
    """Weights and the logistic function out of a bounded sample of labelled rows."""
    own = labels.select(labels["doc_id"].cast("bigint").alias("label_id"), labels["toxic"].cast("int").alias("toxic")).where("toxic in (0, 1)")
    own = own.where(~held_out(F.col("label_id"))).groupBy("label_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("other")).where("toxic = other").select("label_id", "toxic")
    own = own.orderBy(F.xxhash64("label_id"), "label_id").limit(sample)
    chosen = F.broadcast(materialize(own, "toxic-labels"))  # at most `sample` rows
    texts = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].cast("string").alias("text"))
    rows = texts.join(chosen, F.col("doc_id") == F.col("label_id")).groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).withColumn("half", F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)).cast("int"))
    rows = materialize(rows.select("text", "toxic", "half"), "toxic-sample")

    def features(batches):
        for batch in batches:
            y = batch.column(1).to_numpy()
            for lo, hi, parts in slices_of(batch.column(0), model):
                pairs = np.concatenate([np.rec.fromarrays([t[at], h], names="d,h") for t, at, h in parts])
                pairs = pairs[np.lexsort((pairs["h"], pairs["d"]))]
                one = np.ones(len(pairs), bool)
                one[1:] = pairs[1:] != pairs[:-1]
                yield pa.RecordBatch.from_arrays([vec.signed(np.ascontiguousarray(pairs["h"][one])), pa.array(y[lo + pairs["d"][one]].astype(np.int64))], ["h", "toxic"])

    sizes = {(r["half"], r["toxic"]): r["count"] for r in rows.groupBy("half", "toxic").count().collect()}
    toxic, other = sizes.get((0, 1), 0), sizes.get((0, 0), 0)
    counted = rows.where("half = 0").select("text", "toxic").mapInArrow(features, "h bigint, toxic bigint").groupBy("h").agg(F.sum("toxic").alias("t"), F.count("*").alias("n"))
    odds = F.log((F.col("t") + 0.5) / (toxic + 1)) - F.log((F.col("n") - F.col("t") + 0.5) / (other + 1))
    strong = counted.where(F.col("t") >= LEAST).withColumn("odds", odds).where(F.col("odds") >= ODDS).select("h", "odds").collect()  # bounded by the sample
    lexicon = Lexicon(np.array([r[0] for r in strong], np.int64).view(vec.U), np.array([r[1] for r in strong], float))

    def evidence(batches):
        for batch in batches:
            for lo, hi, parts in slices_of(batch.column(0), model):
                x = _evidence(lexicon, hi - lo, parts)
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(lo, hi - lo), *(pa.array(np.ascontiguousarray(x[:, k])) for k in range(3))], ["toxic", "x0", "x1", "x2"])

    seen = sorted(map(tuple, rows.where("half = 1").select("text", "toxic").mapInArrow(evidence, "toxic int, x0 double, x1 double, x2 double").collect()))  # at most `sample` rows
    y, x = np.array([r[0] for r in seen], float), np.array([r[1:] for r in seen], float).reshape(-1, 3)
    if not len(y):
        return lexicon, np.array([np.log((toxic + 0.5) / (other + 0.5)), 0.0, 0.0, 0.0])
    return lexicon, fitted(x, y)


def scored(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every row of ``docs(doc_id, text)``."""
    model = log_probabilities(character_counts(docs))
    lexicon, beta = learned(docs, labels, model, sample)

    def run(batches):
        for batch in batches:
            for lo, hi, parts in slices_of(batch.column(1), model):
                z = _inputs(_evidence(lexicon, hi - lo, parts)) @ beta
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))], ["doc_id", "score"])

    own = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].cast("string").alias("text"))
    out = own.mapInArrow(run, "doc_id bigint, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
