"""Line deduplication by an exact set-similarity join.

A line is the set of its words.  A line goes if an earlier one (smaller doc_id,
then smaller line number) has a Jaccard similarity of at least ``THRESHOLD``.

1. Words are counted over all documents in hashed tables of fixed size; they
   order the words of every line, rarest first.  The order is total and the
   same everywhere, so the tables' collisions cost time, never results.
2. Each line posts its prefix: two lines at the threshold share a word there.
   Where all words that two lines share there are ``HOT`` ones, they share two
   of them in prefixes that are one word longer; so hot words are posted in
   pairs, and the group of a single word never has more than HOT lines.  Of
   equal sets, found by their hashes without postings, the earliest line
   posts; sets of up to three words only equal sets can match.
3. Postings are packed by ranges of words, dealt out and sorted by set size.  A pair survives if
   its sizes (length filter), its places in the orders (positional filter) and
   a parity of 64 or 128 bits of its words (no two sets differ in more bits than
   words) allow the threshold; it is a strong one if the parity leaves much
   room.  A line looks through the earlier ones among its word's lines of like
   size until it has ``STRONG`` strong partners, so in a group of g near copies
   about g log g pairs are looked at, not g * g.  These go on, or without any
   all that survive, ``MOST`` at most.  Lines for which all fail verification,
   though there may be more, are joined again with all survivors of their words.
4. Survivors are verified by exact Jaccard over the words' 64-bit hashes.

Defined results: a line without words always stays, as do lines of rows without
doc_id; a null text has no lines; rows that repeat a doc_id and line count as
the same line; ties in place can't occur otherwise; an empty table gives an
empty result; other columns aren't read, and :func:`keep` returns them
unchanged.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import vec
from .membership import Cascade, cascade
from .shared import Scratch, materialize

THRESHOLD = 0.8
#: Sets of fewer words have no partner but equal sets.
LEAST = 4
#: Bits of the table of word counts (2 ** 20 counts, 8 MB).
TABLE_BITS, CHUNKS = 20, 256
#: Words that occur so often are posted in pairs.
HOT = 1 << 16
#: Lines of more words keep 128 parity bits instead of 64.
LONG = 64
#: Survivors of a line and word that go on at once: strong ones, which by their parities differ in no more than half of the words that they may, or others.
STRONG, MOST = 2, 64

#: Set sizes and places of words in lines stop here.
TOP = (1 << 12) - 1
#: A posting: 40 bits of the word's hash, the set's size, the word's place in the line, 32 bits of the set's hash, the line's place and parity.
FIELDS = {"t": np.int64, "n": np.uint16, "pos": np.uint16, "s": np.uint32, "line": np.uint32, "doc_id": np.int64, "b0": np.uint64, "b1": np.uint64}
#: Postings travel packed, those of a task and a range of words in one row.
POSTS = "part int, rows int, size int, packed binary"
#: Ranges of words: at least 2 ** 10, and more of them for tables of more than 2 ** 31 words.
PART_BITS = 10
PAIRS = "doc_id bigint, line int, e_doc bigint, e_line int, more boolean"


def texts(docs: DataFrame) -> DataFrame:
    return docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].cast("string").alias("text")).where("doc_id is not null and text is not null")


SCAN = "doc_id bigint, line int, s1 bigint, s2 bigint, chunk int, counts binary"


def scanned(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """One pass over the texts, written once: ``(doc_id, line, s1, s2)`` of all lines with words (their places and
    128-bit set hashes), and each task's word counts as compressed ``(chunk, counts)``."""
    names = ["doc_id", "line", "s1", "s2", "chunk", "counts"]

    def run(batches):
        table = np.zeros(1 << TABLE_BITS, np.int64)
        for batch in batches:
            found = []
            for lo, _, buf, at in vec.slices(batch.column(1)):
                w = vec.words(buf, at)
                found.append((w.hash >> vec.U(64 - TABLE_BITS)).astype(np.int32))
                x = Lines(w)
                n = len(x.n)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(lo + x.text)), pa.array(x.number.astype(np.int32)), vec.signed(x.s1), vec.signed(x.s2()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names)
            if found:
                table += np.bincount(np.concatenate(found), minlength=len(table))
        parts = table.reshape(CHUNKS, -1)
        some = np.flatnonzero(parts.any(axis=1))
        for k in np.array_split(some, max(1, len(some) // 16)):
            n = len(k)
            packed = pa.array([zlib.compress(parts[x].tobytes(), 1) for x in k], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.array(k.astype(np.int32)), packed], names)

    return scratch.table(texts(docs).mapInArrow(run, SCAN), "line-scan")


def word_counts(scan: DataFrame) -> tuple[np.ndarray, int]:
    """Counts of all words by the top bits of their hashes, cut at 2 ** 20, and the number of words.

    The tasks' chunks are added where they are dealt to, as a stream.  The
    driver gets the sums, 8 MB for any input.
    """

    def add(batches):
        own: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                part = np.frombuffer(zlib.decompress(raw), np.int64)
                own[k] = own[k] + part if k in own else part
        for k, part in own.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([zlib.compress(part.tobytes(), 1)], pa.binary())], ["chunk", "counts"])

    table = np.zeros((CHUNKS, (1 << TABLE_BITS) // CHUNKS), np.int64)
    for k, part in scan.where("chunk is not null").select("chunk", "counts").repartition("chunk").mapInArrow(add, "chunk int, counts binary").toLocalIterator():
        table[k] = np.frombuffer(zlib.decompress(part), np.int64)
    return np.minimum(table.ravel(), (1 << 20) - 1).astype(np.int32), int(table.sum())


def equals(scan: DataFrame, scratch: Scratch) -> tuple[DataFrame, tuple[vec.Bloom, vec.Bloom]]:
    """``(doc_id, line, first)`` of lines whose sets several have, ``first`` being that of the earliest, and some other lines as first
    ones; Bloom tables of these sets and of the first ones' places."""
    every = scan.where("line is not null").select("doc_id", "line", "s1", "s2")
    several = every.groupBy(F.col("s1").alias("e1"), F.col("s2").alias("e2")).agg(F.min(F.struct("doc_id", "line")).alias("least"), F.count("*").alias("n")).where("n > 1")
    several = scratch.table(several.select("e1", "e2", "least"), "line-copies")
    bloom = vec.bloom_of(several, "e1", 26)

    def likely(batches):
        for batch in batches:
            yield batch.filter(pa.array(bloom.has(batch.column(2).to_numpy().view(vec.U))))

    rows = every.mapInArrow(likely, every.schema).join(several, (F.col("s1") == F.col("e1")) & (F.col("s2") == F.col("e2")), "left")
    first = F.col("least").isNull() | ((F.col("doc_id") == F.col("least.doc_id")) & (F.col("line") == F.col("least.line")))
    equal = scratch.table(rows.select("doc_id", "line", first.alias("first")), "line-equals")
    return equal, (bloom, bloom_of_places(equal.where("first")))


def rarest_first(h: np.ndarray, line: np.ndarray, n: int, counts: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Words' hashes and their ``n`` lines (ascending), in the order of each line, without repeats."""
    common = counts[(h >> vec.U(64 - TABLE_BITS)).astype(np.int64)].astype(vec.U) if counts is not None else np.zeros(len(h), vec.U)
    if n < 1 << 20:
        key = (line.astype(vec.U) << vec.U(44)) | (common << vec.U(24)) | (h & vec.U(0xFFFFFF))
        order = np.argsort(key)
        same = key[order[1:]] == key[order[:-1]]
    if n >= 1 << 20 or (same & (h[order[1:]] != h[order[:-1]])).any():
        order = np.lexsort((h, h & vec.U(0xFFFFFF), common, line))  # the same order, ties of the short key resolved
    h, line = h[order], line[order]
    one = np.ones(len(h), bool)
    one[1:] = (h[1:] != h[:-1]) | (line[1:] != line[:-1])
    return h[one], line[one]


class Lines:
    """Lines of a slice that have words, of which ``wanted(text, number)`` may tell those that count: each one's distinct word hashes, rarest first if counts are given."""

    def __init__(self, w: vec.Words, counts: np.ndarray | None = None, wanted=None):
        text, number = w.text, w.line()
        fresh = np.ones(len(text), bool)
        fresh[1:] = (text[1:] != text[:-1]) | (number[1:] != number[:-1])
        head = np.flatnonzero(fresh)
        line, h = np.cumsum(fresh) - 1, w.hash
        if wanted is not None:
            live = wanted(text[head], number[head])
            some = live[line]
            head, h, line = head[live], h[some], (np.cumsum(live) - 1)[line[some]]
        self.h, line = rarest_first(h, line, len(head), counts)
        self.n = np.bincount(line, minlength=len(head))
        self.text, self.number = text[head], number[head]
        self.off = np.concatenate(([0], np.cumsum(self.n)))
        self.s1 = vec.sums(vec.mix(self.h, 1), self.off)

    def s2(self) -> np.ndarray:
        return vec.sums(vec.mix(self.h, 2), self.off)

    def parity(self) -> tuple[np.ndarray, np.ndarray]:
        """Per line, the exclusive or of one bit for each word: of 128 for lines of more than LONG words, else of 64."""
        x = vec.mix(self.h, 3)
        bit = vec.U(1) << (x & vec.U(63))
        right = ((x >> vec.U(6)) & vec.U(1) == 1) & np.repeat(self.n > LONG, self.n)
        zero = vec.U(0)
        if not len(self.n):
            return np.zeros(0, vec.U), np.zeros(0, vec.U)
        return np.bitwise_xor.reduceat(np.where(right, zero, bit), self.off[:-1]), np.bitwise_xor.reduceat(np.where(right, bit, zero), self.off[:-1])


def needed(total: np.ndarray) -> np.ndarray:
    """The least overlap of two sets of ``total`` words together at the threshold, which is 4/5: (4 / 9) * total."""
    return -(-4 * total // 9)


def prefix(n: np.ndarray) -> np.ndarray:
    """How many of a line's words it posts."""
    return n - -(-4 * n // 5) + 1


def _stretches(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The numbers ``start, start + 1, ...``, n of each."""
    return np.repeat(start - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum()) if len(n) else np.zeros(0, np.int64)


def posted(h: np.ndarray, off: np.ndarray, mine: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(40 bits of hash, line, place of the word) of all that lines ``mine`` post; lines' words are ``off[k]:off[k + 1]``."""
    n = off[mine + 1] - off[mine]
    mine, n = mine[n >= LEAST], n[n >= LEAST]
    p = prefix(n)
    word, line = _stretches(off[mine], p + 1), np.repeat(mine, p + 1)
    hot = counts[(h[word] >> vec.U(64 - TABLE_BITS)).astype(np.int64)] >= HOT
    last = np.zeros(len(word), bool)
    last[np.cumsum(p + 1) - 1] = True
    single = ~hot & ~last
    out = [(h[word[single]], line[single], word[single])]
    # the hot words of a prefix are its last ones
    q = np.bincount(np.repeat(np.arange(len(mine)), p + 1)[hot], minlength=len(mine))
    for k in np.unique(q[q > 1]).tolist():
        some = np.flatnonzero(q == k)
        a, b = np.triu_indices(k, 1)
        first = off[mine[some]] + p[some] + 1 - k
        for lo in range(0, len(some), max(1, (1 << 20) // len(a))):
            at = first[lo : lo + max(1, (1 << 20) // len(a))]
            x, y = (at[:, None] + a).ravel(), (at[:, None] + b).ravel()
            out.append((vec.mix(h[x], 5) + vec.mix(h[y], 6), np.repeat(mine[some[lo : lo + len(at)]], len(a)), x))
    t, line, word = (np.concatenate(x) for x in zip(*out, strict=True))
    return t & vec.U((1 << 40) - 1), line, word - off[line]


def packed(x: dict[str, np.ndarray]) -> tuple[int, bytes]:
    """Postings sorted by ``t`` as compressed bytes, and their size before: words as differences, bytes of equal weight together."""
    planes = []
    for k, kind in FIELDS.items():
        v = np.diff(x[k], prepend=0) if k == "t" else x[k]
        planes.append(np.ascontiguousarray(v.astype(kind).view(np.uint8).reshape(len(v), -1).T))
    raw = b"".join(p.tobytes() for p in planes)
    return len(raw), pa.compress(raw, codec="zstd", asbytes=True)


def unpacked(rows: int, size: int, raw: bytes) -> dict[str, np.ndarray]:
    data, at, out = np.frombuffer(pa.decompress(raw, decompressed_size=size, codec="zstd", asbytes=True), np.uint8), 0, {}
    for k, kind in FIELDS.items():
        wide = np.dtype(kind).itemsize * rows
        v = np.ascontiguousarray(data[at : at + wide].reshape(-1, rows).T).view(kind).ravel()
        out[k] = np.cumsum(v) if k == "t" else v
        at += wide
    return out


def part_bits(words: int) -> int:
    """Bits of the number of ranges: one of some hundred thousand postings at most."""
    return min(20, max(PART_BITS, int(words).bit_length() - 21))


def postings(docs: DataFrame, counts: np.ndarray, bits: int, copies: tuple[vec.Bloom, vec.Bloom], words: vec.Bloom | None = None) -> DataFrame:
    """A posting per posted word or pair: the key (a collision of hashes only adds candidates), the line's place, and its set's
    hash and parity, which together tell sets apart; only those of ``words`` where given.  They are packed by 2 ** ``bits`` ranges of keys.
    Lines whose sets are in the first of ``copies`` post only if their places are in the second."""
    equal, first_ones = copies
    shared = docs.sparkSession.sparkContext.broadcast(counts)

    def sent(held: list[dict[str, np.ndarray]]):
        x = {k: np.concatenate([h[k] for h in held]) for k in FIELDS}
        order = np.argsort(x["t"], kind="stable")
        x = {k: v[order] for k, v in x.items()}
        part = (x["t"] >> (40 - bits)).astype(np.int32)
        head = np.flatnonzero(np.concatenate((np.ones(min(1, len(part)), bool), part[1:] != part[:-1])))
        end = np.append(head[1:], len(part))
        for lo in range(0, len(head), 1024):
            some = [packed({k: v[i:j] for k, v in x.items()}) for i, j in zip(head[lo : lo + 1024], end[lo : lo + 1024], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(part[head[lo : lo + 1024]]), pa.array((end - head)[lo : lo + 1024].astype(np.int32)), pa.array([n for n, _ in some], pa.int32()), pa.array([raw for _, raw in some], pa.binary())], ["part", "rows", "size", "packed"])

    def run(batches):
        held, rows = [], 0
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for lo, _, buf, at in vec.slices(batch.column(1)):
                x = Lines(vec.words(buf, at), shared.value)
                # of equal sets within the slice, the earliest line posts
                order = np.lexsort((x.number, ids[lo + x.text]))
                _, first = np.unique(x.s1[order], return_index=True)
                mine = np.sort(order[first])
                mine = mine[~equal.has(x.s1[mine]) | first_ones.has(place(ids[lo + x.text[mine]], x.number[mine]))]
                t, line, pos = posted(x.h, x.off, mine, shared.value)
                if words is not None:
                    some = words.has(t)
                    t, line, pos = t[some], line[some], pos[some]
                b0, b1 = x.parity()
                wide = {"t": t, "n": np.minimum(x.n, TOP)[line], "pos": np.minimum(pos, TOP), "s": (x.s1 >> vec.U(32))[line], "line": x.number[line], "doc_id": ids[lo + x.text[line]], "b0": b0[line], "b1": b1[line]}
                held.append({k: wide[k].astype(kind) for k, kind in FIELDS.items()})
                rows += len(t)
                if rows >= FLUSH:
                    yield from sent(held)
                    held, rows = [], 0
        if rows:
            yield from sent(held)

    return texts(docs).mapInArrow(run, POSTS)


#: Postings that a task holds before it sends them (5 MB, some copies of which are made).
FLUSH = 1 << 17


#: Pairs that are looked at at once.
BLOCK = 1 << 19


#: How many words two sets differ in, most likely, whose parities of 64 or 128 bits differ in so many bits.
_LIKELY = [-bits / 2 * np.log(np.maximum(1 - 2 * np.arange(bits + 1) / bits, 1e-9)) for bits in (64, 128)]


def allowed(x: dict[str, np.ndarray], i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs of rows may reach the threshold, as far as places in the orders and parities tell, and which are strong."""
    ni, nj, pi, pj = x["n"][i], x["n"][j], x["pos"][i], x["pos"][j]
    least = needed(ni + nj)
    fine = np.minimum(ni - pi, nj - pj) + np.minimum(pi, pj) >= least
    d0, d1 = x["b0"][i] ^ x["b0"][j], x["b1"][i] ^ x["b1"][j]
    both = np.minimum(ni, nj) > LONG  # else the shorter line has all its bits in b0
    differ = np.where(both, np.bitwise_count(d0).astype(np.int64) + np.bitwise_count(d1), np.bitwise_count(d0 ^ d1))
    most = ni + nj - 2 * least
    top = np.maximum(ni, nj) == TOP
    return fine & (differ <= most) | top, (np.where(both, _LIKELY[1][differ], _LIKELY[0][np.minimum(differ, 64)]) <= 0.5 * most) & ~top


def _ranks(i: np.ndarray) -> np.ndarray:
    """Places within runs of equal numbers."""
    if not len(i):
        return i
    first = np.flatnonzero(np.concatenate(([True], i[1:] != i[:-1])))
    return np.arange(len(i)) - np.repeat(first, np.diff(np.append(first, len(i))))


def survivors(x: dict[str, np.ndarray], wanted: np.ndarray | None = None, strong_ones: int = STRONG, most: int = MOST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (later, earlier) of rows with equal ``t`` that pass the filters, and whether the later one may have more.

    Rows are sorted by t, then n.  Of ``wanted`` rows all pairs are kept, if
    these are given, else what the module's text says.
    """
    rows = len(x["t"])
    place_order = np.lexsort((x["line"], x["doc_id"]))
    rank = np.empty(rows, np.int64)
    d, k = x["doc_id"][place_order], x["line"][place_order]
    rank[place_order] = np.cumsum(np.concatenate(([0], (d[1:] != d[:-1]) | (k[1:] != k[:-1]))))
    group = np.cumsum(np.concatenate(([0], x["t"][1:] != x["t"][:-1]))) * (TOP + 1)
    at = group + x["n"]
    now = np.searchsorted(at, group + -(-4 * x["n"] // 5))  # length filter
    to = np.searchsorted(at, group + np.minimum(5 * x["n"] // 4, TOP), "right")
    strong, weak = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
    more = np.zeros(rows, bool)
    active = np.arange(rows) if wanted is None else np.flatnonzero(wanted)
    later, earlier, kind = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, bool)]
    while len(active := active[now[active] < to[active]]):
        width = min(4096, max(1, BLOCK // len(active)))
        n = np.minimum(to[active] - now[active], width)
        i, j = np.repeat(active, n), _stretches(now[active], n)
        now[active] += n
        some = np.flatnonzero(rank[j] < rank[i])
        i, j = i[some], j[some]
        fine, close = allowed(x, i, j)
        i, j, close = i[fine], j[fine], close[fine]
        if wanted is None:
            for of, seen, limit in ((close, strong, strong_ones), (~close, weak, most)):
                a, b = i[of], j[of]
                some = _ranks(a) + seen[a] < limit
                seen += np.bincount(a, minlength=rows)
                later.append(a[some])
                earlier.append(b[some])
                kind.append(np.full(some.sum(), of is close))
            full = (strong[active] >= strong_ones) | (weak[active] >= most)
            more[active[full & (now[active] < to[active])]] = True
            active = active[~full]
        else:
            later.append(i)
            earlier.append(j)
            kind.append(close)
    i, j, close = np.concatenate(later), np.concatenate(earlier), np.concatenate(kind)
    if wanted is None:
        more |= (strong > strong_ones) | (weak > most) | (strong > 0) & (weak > 0)
        some = close | (strong[i] == 0)
        i, j = i[some], j[some]
    return i, j, more[i]


def collapsed(x: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Of rows with equal word and set, the earliest; sorted by word, then set size."""
    order = np.lexsort((x["line"], x["doc_id"], x["s1"], x["n"], x["t"]))
    t, s = x["t"][order], x["s1"][order]
    one = np.ones(len(t), bool)
    one[1:] = (t[1:] != t[:-1]) | (s[1:] != s[:-1])
    return {k: v[order[one]] for k, v in x.items()}


def candidates(posts: DataFrame, among: vec.Bloom | None = None) -> DataFrame:
    """Surviving pairs per word: some partners of each line and whether there may be more; or all partners of lines in ``among``."""

    def pairs(held):
        x = {k: np.concatenate([h[k] for h in held]) for k in FIELDS}
        x = {k: v if k in ("b0", "b1") else v.astype(np.int64) for k, v in x.items()}
        x["s1"] = vec.mix(x.pop("s").view(vec.U), 4) + vec.mix(x["b0"], 5) + vec.mix(x["b1"], 6)
        x = collapsed(x)
        wanted = None if among is None else among.has(place(x["doc_id"], x["line"]))
        later, earlier, more = survivors(x, wanted)
        return pa.RecordBatch.from_arrays([pa.array(v) for v in (x["doc_id"][later], x["line"][later].astype(np.int32), x["doc_id"][earlier], x["line"][earlier].astype(np.int32), more)], ["doc_id", "line", "e_doc", "e_line", "more"])

    def run(batches):
        held, rows, last = [], 0, None
        for batch in batches:
            for part, n, size, raw in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if part != last and rows >= 100_000:  # a word lies in one range
                    yield pairs(held)
                    held, rows = [], 0
                held.append(unpacked(n, size, raw))
                rows, last = rows + n, part
        if held:
            yield pairs(held)

    return posts.repartition("part").sortWithinPartitions("part").mapInArrow(run, PAIRS)


def place(doc_id: np.ndarray, line: np.ndarray) -> np.ndarray:
    """Hash of a line's place."""
    return vec.mix(vec.mix(doc_id.astype(np.int64).view(vec.U), 7) + line.astype(np.int64).view(vec.U), 8)


def bloom_of_places(places: DataFrame) -> vec.Bloom:
    return vec.bloom_of(places, ["doc_id", "line"], 26, place)


def verified(pairs: DataFrame, docs: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """``(doc_id, line)`` of lines with a partner in ``pairs`` at the threshold, and the sets ``(doc_id, line, s)`` of all lines in pairs, among a few others."""
    pairs = scratch.table(pairs.select("doc_id", "line", "e_doc", "e_line").distinct(), "line-pairs")
    places = scratch.table(pairs.select(F.explode(F.array(F.struct("doc_id", "line"), F.struct(F.col("e_doc").alias("doc_id"), F.col("e_line").alias("line")))).alias("x")).select("x.doc_id", "x.line").distinct(), "line-places")

    bloom, named = bloom_of_places(places), vec.bloom_of(places, "doc_id", 26)

    def run(batches):
        for batch in batches:
            batch = batch.filter(pa.array(named.has(batch.column(0).to_numpy().view(vec.U))))
            ids = batch.column(0).to_numpy()
            for lo, _, buf, at in vec.slices(batch.column(1)):
                x = Lines(vec.words(buf, at), wanted=lambda text, number: bloom.has(place(ids[lo + text], number)))  # noqa: B023
                sets = pa.ListArray.from_arrays(pa.array(x.off.astype(np.int32)), vec.signed(x.h))
                yield pa.RecordBatch.from_arrays([pa.array(ids[lo + x.text]), pa.array(x.number.astype(np.int32)), sets], ["doc_id", "line", "s"])

    # some sets that no pair names may be among them; the joins leave these out
    sets = scratch.table(texts(docs).mapInArrow(run, "doc_id bigint, line int, s array<bigint>"), "line-sets")
    x = pairs.join(sets, ["doc_id", "line"]).join(sets.select(F.col("doc_id").alias("e_doc"), F.col("line").alias("e_line"), F.col("s").alias("es")), ["e_doc", "e_line"])
    both = F.size(F.array_intersect("s", "es"))
    return x.where(5 * both >= 4 * (F.size("s") + F.size("es") - both)).select("doc_id", "line").distinct(), sets


def removed(docs: DataFrame) -> DataFrame:
    """``(doc_id, removed_lines)`` of documents that lose lines, numbered from 0."""
    with Scratch(docs.sparkSession) as scratch:
        return materialize(_listed(_gone(docs, scanned(docs, scratch), scratch)), "removed-lines")


def _listed(gone: DataFrame) -> DataFrame:
    return gone.groupBy("doc_id").agg(F.sort_array(F.collect_set("line")).alias("removed_lines"))


def _gone(docs: DataFrame, scan: DataFrame, scratch: Scratch) -> DataFrame:
    """``(doc_id, line)`` of the lines that go, some of them repeatedly."""
    counts, words = word_counts(scan)
    bits = part_bits(words)
    equal, copies = equals(scan, scratch)
    found = scratch.table(candidates(postings(docs, counts, bits, copies)), "line-candidates")
    near, sets = verified(found, docs, scratch)
    near = scratch.table(near, "line-matches")
    open_ = scratch.table(found.where("more").select("doc_id", "line").distinct().join(near, ["doc_id", "line"], "left_anti"), "line-open")
    if not open_.isEmpty():
        shared = docs.sparkSession.sparkContext.broadcast(counts)

        def keys(batches):
            for batch in batches:
                lists = batch.column(0)
                n = np.diff(lists.offsets.to_numpy())
                h, line = rarest_first(lists.flatten().to_numpy().view(vec.U), np.repeat(np.arange(len(n)), n), len(n), shared.value)
                t, _, _ = posted(h, np.concatenate(([0], np.cumsum(n))), np.arange(len(n)), shared.value)
                yield pa.RecordBatch.from_arrays([vec.signed(np.unique(t))], ["t"])

        of = bloom_of_places(open_)
        keyed = scratch.table(sets.join(open_, ["doc_id", "line"], "left_semi").select("s").mapInArrow(keys, "t bigint").distinct(), "line-words")
        rest = candidates(postings(docs, counts, bits, copies, vec.bloom_of(keyed, "t", 26)), of).join(open_, ["doc_id", "line"], "left_semi")
        near = near.unionAll(verified(scratch.table(rest, "line-rest"), docs, scratch)[0]).distinct()
    # of equal sets all but the first go; sets whose first line has an earlier match are among the matches
    return near.unionAll(equal.where(~F.col("first")).select("doc_id", "line"))


def report(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: its number of lines and the numbers of those removed."""
    gone = removed(docs).withColumnRenamed("doc_id", "gone_id")
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    n = F.when(docs["text"].isNull(), 0).otherwise(F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1)
    own = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), n.cast("bigint").alias("n_lines"))
    lost = F.coalesce("removed_lines", F.array().cast("array<int>"))
    return own.join(gone, F.col("doc_id") == F.col("gone_id"), "left").select("doc_id", "n_lines", F.size(lost).cast("bigint").alias("n_removed"), lost.alias("removed_lines"))


#: What separates words.
_BLANK = bytes([32, *range(9, 14)])


def cut(ids: pa.Array, column: pa.Array, of: Cascade) -> pa.Array:
    """Texts without the lines whose places ``of`` has; null for those that lose none."""
    known = pc.and_(ids.is_valid(), column.is_valid())
    n = pc.fill_null(pc.if_else(known, pc.add(pc.count_substring(column, "\n"), 1), 0), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    row, line = np.repeat(np.arange(len(n)), n), _stretches(np.zeros(len(n), np.int64), n)
    some = np.flatnonzero(of.has(place(pc.fill_null(ids, 0).to_numpy(zero_copy_only=False)[row], line)))
    raw, out, lost = column.cast(pa.binary()), [None] * len(n), {}
    for d, k in zip(row[some].tolist(), line[some].tolist(), strict=True):
        lost.setdefault(d, set()).add(k)
    for d, numbers in lost.items():
        lines = raw[d].as_py().split(b"\n")
        left = [x for k, x in enumerate(lines) if k not in numbers or not x.strip(_BLANK)]  # the cascade knows lines with words only
        if len(left) < len(lines):
            out[d] = b"\n".join(left)
    return pa.array(out, pa.binary()).view(pa.string())


def keep(docs: DataFrame) -> DataFrame:
    """``docs`` with the removed lines cut out of ``text``; a document that loses all its words so goes.

    ``n_chars``, where there is one, follows the text.  Texts stay where they
    are: tables that tell which lines go travel to them; only if there are too
    many for these are lists of lines joined to documents.
    """
    with Scratch(docs.sparkSession) as scratch:
        scan = scanned(docs, scratch)
        gone = scratch.table(_gone(docs, scan, scratch), "line-gone")
        of = cascade(gone, scan.where("line is not null").select("doc_id", "line"), place, scratch)
        lists = materialize(_listed(gone), "removed-lines") if of is None else None
    if of is None:
        return _joined(docs, lists)

    @F.arrow_udf("string")
    def less(ids: pa.Array, column: pa.Array) -> pa.Array:
        return cut(ids, column, of)

    found = docs.withColumn("_left", less(docs["doc_id"].cast("bigint"), docs["text"].cast("string")))
    return _kept(docs.columns, found, F.col("_left").isNull(), F.col("_left"))


def _joined(docs: DataFrame, lists: DataFrame) -> DataFrame:
    gone = lists.select(F.col("doc_id").alias("gone_id"), F.col("removed_lines").alias("gone_lines"))
    left = F.array_join(F.filter(F.split(docs["text"], "\n", -1), lambda _, k: ~F.array_contains(gone["gone_lines"], k)), "\n")
    return _kept(docs.columns, docs.join(gone, docs["doc_id"] == gone["gone_id"], "left"), gone["gone_lines"].isNull(), left)


def _kept(columns: list[str], found: DataFrame, whole: Column, left: Column) -> DataFrame:
    text = F.when(whole, F.col("text")).otherwise(left)
    values = {"text": text}
    if "n_chars" in columns:
        values["n_chars"] = F.when(whole, F.col("n_chars")).otherwise(F.length(text)).cast(found.schema["n_chars"].dataType)
    return found.where(whole | text.rlike(r"[^\x20\x09-\x0D]")).select(*[values[c].alias(c) if c in values else F.col(f"`{c}`") for c in columns])
