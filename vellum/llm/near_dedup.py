"""Near duplicates by a MinHash containment ensemble.

Documents are sets of five-word shingles.  Two documents are near copies where
at least ``THRESHOLD`` of the smaller set lies in the larger one and the sizes
differ by at most the factor ``MAX_RATIO``, so every pair with a Jaccard
similarity of 0.8 counts.

1. Equal sets are collapsed; what follows works on one document per set.
2. Sets are partitioned by size, at quantiles of a histogram over all sets.
   For each pair of partitions whose sizes can meet, the containment threshold
   becomes a Jaccard threshold by the partitions' bounds, and rows and bands
   are tuned to it: many rows where sizes are close, fewer where they differ.
3. Every document is a candidate of the smallest one in its buckets, then of
   those buckets' smallest ones that are still in other classes.  Then, for
   ``ROUNDS`` rounds, each bucket's classes meet one of them, a member standing
   for each.  Candidates whose signatures agree too little are dropped, the
   others are verified by exact containment and joined into classes.
4. Buckets that still hold several classes are joined with themselves, across
   classes only, so that no link between classes is lost and a large group of
   copies never emits its pairs.  MinHash nibbles within the join drop pairs
   that can hardly reach the threshold; the rest are verified exactly.
5. For verification a set travels to the groups of the documents that it is
   held against, once each; large groups are salted.  Packed sets, of about a
   byte a shingle, go first and drop only pairs that surely lack too many.
6. A set of which at least ``THRESHOLD`` lies in one that is more than
   ``MAX_RATIO`` times as large is contained in it: no copy, but a link all the
   same.  Each set posts its SAMPLE least hashes, and every set those of its
   hashes that another one posts.  A bucket's sets first meet the smallest
   and the largest of them; then sets not yet contained meet all larger
   ones, and contained ones those of other families.  Verified exactly, too.
   A holder has SHARED of a set's SAMPLE at least, so a set of fewer hashes
   that any larger one holds looks nowhere, and another one leaves out the
   SHARED - 1 buckets with most larger sets.  One whose WIDE least hashes are
   not held by larger sets often enough looks nowhere, too.  Within a bucket, bitmaps of the
   sets' shingles drop pairs that surely lack too many, before pairs are made.

A class holds copies of like sizes; a family joins classes by all links.

Defined results: a text without words (null or empty too) is in no group and
its own class; a text of one to four words has one shingle of them all; rows
of a null doc_id have a null class; rows that repeat a doc_id with other texts
put these texts, and all that equal them, in one class; an empty table gives an empty result; other
columns aren't read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import vec
from .components import components
from .membership import cascade
from .shared import Scratch, materialize

WIDTH, THRESHOLD, MAX_RATIO = 5, 0.8, 1.25
#: Hash functions, of which 16 bits each are kept; rows and bands of any pair of partitions come out of these.
HASHES = 64
#: Equi-depth partitions of set sizes.
PARTITIONS = 12
#: Least chance that a pair at the very threshold shares a bucket, and most that one at the similarity BACKGROUND does.
RECALL, BACKGROUND, STRAY = 0.95, 0.1, 0.02
#: How far the agreement of signatures may fall below the expectation at the threshold.
SIGMAS = 4.0
#: Rounds in which the classes of a bucket meet one of them.
ROUNDS = 1
#: Documents that one task's group holds against a document.
GROUP = 256

#: Least hashes that a set posts to find sets that hold it; larger sets of a bucket that one is held against at once.
SAMPLE, HEAVY = 12, 256
#: Of SAMPLE hashes, those that a set's holder has at least; fewer with a chance of 0.0006.
SHARED = 5
#: Least hashes of a set that looks for a holder of which it is asked whether any larger set holds them, and how many that must be:
#: a set's holder has fewer of WIDE ones with a chance of less than 0.0001, of sets of up to WIDE hashes all are asked.
WIDE, WIDE_SHARED = 64, 38
#: Hashes below it are looked up in the table of all that are posted, the others, which only small sets post, in one of their own too.
COMMON = 1 << 61
#: Bits of a set's bitmap; those of sets of many more shingles are full and drop nothing.
BITMAP = 4096
#: Values that shingle hashes have in packed sets; those of many more shingles drop little.
PACKED = 1 << 14

_rng = np.random.default_rng(20240229)
_A = (_rng.integers(0, 1 << 32, HASHES, np.uint64).astype(np.uint32) | np.uint32(1))[:, None]
_B = _rng.integers(0, 1 << 32, HASHES, np.uint64).astype(np.uint32)[:, None]


def shingle_sets(column: pa.Array):
    """For each text in order, its sorted distinct shingle hashes."""
    for lo, hi, buf, at in vec.slices(column):
        w = vec.words(buf, at)
        g, off, _ = vec.windows(w.hash, w.off, WIDTH)
        for d in range(hi - lo):
            yield np.unique(g[off[d] : off[d + 1]])


def signature(s: np.ndarray) -> np.ndarray:
    """MinHash of a non-empty set, 16 bits a hash function."""
    x = (s >> vec.U(32)).astype(np.uint32)[None, :]
    out = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for k in range(0, x.shape[1], 4096):
        np.minimum(out, (_A * x[:, k : k + 4096] + _B).min(axis=1), out=out)
    return (vec.mix(out.astype(vec.U)) >> vec.U(48)).astype(np.uint16)


def sampled(s: np.ndarray) -> np.ndarray:
    """A set's hashes in an order that has nothing to do with that of the set."""
    return np.sort(vec.mix(s, 9))


def bitmap(s: np.ndarray) -> bytes:
    """A bit for each shingle: of two sets' bitmaps, the bits that one lacks are no more than its missing shingles."""
    bits = np.zeros(BITMAP, bool)
    bits[(s & vec.U(BITMAP - 1)).astype(np.int64)] = True
    return np.packbits(bits).tobytes()


def packed(s: np.ndarray) -> bytes:
    """A set's size and its hashes cut to PACKED values, as gaps of a byte each; 255 goes on in the next byte."""
    v = np.unique((s & vec.U(PACKED - 1)).astype(np.int32))
    gap = np.diff(v, prepend=np.int32(-1)) - 1
    out = np.full(len(gap) + int((gap // 255).sum()), 255, np.uint8)
    out[np.cumsum(gap // 255 + 1) - 1] = gap % 255
    return np.int32(len(s)).tobytes() + out.tobytes()


def unpacked(raw: bytes) -> tuple[int, np.ndarray]:
    """A set's size and the sorted distinct values of its hashes."""
    gap = np.frombuffer(raw, np.uint8, offset=4)
    v = np.cumsum(gap, dtype=np.int32)[gap < 255]
    return int(np.frombuffer(raw, np.int32, 1)[0]), v + np.arange(len(v), dtype=np.int32)


def signed_docs(docs: DataFrame) -> DataFrame:
    """``(doc_id, n, s1, s2, sig, low, packed)`` of every document that has words: set size, 128-bit set hash, MinHash, least hashes, packed set."""

    def run(batches):
        for batch in vec.small(batches):
            rows = [(k, len(s), s) for k, s in enumerate(shingle_sets(batch.column(1))) if len(s)]
            at = pa.array([k for k, _, _ in rows], pa.int64())
            s1 = np.array([vec.mix(s, 1).sum() for *_, s in rows], vec.U)
            s2 = np.array([vec.mix(s, 2).sum() for *_, s in rows], vec.U)
            sig = pa.array([signature(s).tobytes() for *_, s in rows], pa.binary())
            low = pa.array([sampled(s)[:SAMPLE].view(np.int64) for *_, s in rows], pa.list_(pa.int64()))
            small = pa.array([packed(s) for *_, s in rows], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), pa.array([n for _, n, _ in rows], pa.int32()), vec.signed(s1), vec.signed(s2), sig, low, small], ["doc_id", "n", "s1", "s2", "sig", "low", "packed"])

    return texts(docs).where("doc_id is not null").mapInArrow(run, "doc_id bigint, n int, s1 bigint, s2 bigint, sig binary, low array<bigint>, packed binary")


def texts(docs: DataFrame) -> DataFrame:
    return docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].cast("string").alias("text"))


def bounds(reps: DataFrame, parts: int = PARTITIONS) -> list[int]:
    """Lowest sizes of equi-depth partitions, from a histogram of all sets with 1/32 wide bins (some hundred rows)."""
    drop = F.greatest(F.length(F.bin(F.col("n").cast("bigint"))) - 6, F.lit(0))
    low = F.call_function("shiftleft", F.call_function("shiftright", F.col("n"), drop), drop)
    hist = sorted((r[0], r[1]) for r in reps.groupBy(low.alias("low")).count().collect())
    whole, seen, out = sum(c for _, c in hist), 0, []
    for size, c in hist:
        if not out or seen * parts >= whole * len(out):
            out.append(size)
        seen += c
    return out


def tuned(jaccard: float) -> tuple[int, int]:
    """(bands, rows): the fewest bands that find a pair at this similarity with RECALL and few stray ones, else with as many rows as HASHES allow."""
    best = HASHES, 1
    for rows in range(1, 9):
        need = math.ceil(math.log(1 - RECALL) / math.log(1 - jaccard**rows)) if jaccard < 1 else 1
        if need * rows > HASHES:
            break
        best = need, rows
        if 1 - (1 - BACKGROUND**rows) ** need <= STRAY:
            break
    return best


def plan(low: list[int], top: int = 1 << 31, ratio: float = MAX_RATIO, t: float = THRESHOLD) -> list[tuple[int, int, int, int]]:
    """(smaller partition, larger partition, bands, rows) of all pairs of partitions whose sizes can meet."""
    high = [x - 1 for x in low[1:]] + [top]
    out = []
    for i in range(len(low)):
        for j in range(i, len(low)):
            if low[j] <= ratio * high[i]:
                far = min(ratio, high[j] / low[i])  # of any pair that may count: b / a
                out.append((i, j, *tuned(t / (1 + far - t))))
    return out


def banding(low: list[int]) -> list[dict[int, int]]:
    """For each partition, rows per band to the number of such bands: what its pairs of partitions need at most."""
    out: list[dict[int, int]] = [{} for _ in low]
    for i, j, bands, rows in plan(low):
        for k in {i, j}:
            out[k][rows] = max(out[k].get(rows, 0), bands)
    return out


def _signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, HASHES).astype(vec.U)


def postings(reps: DataFrame, low: list[int], live: vec.Bloom | None = None) -> DataFrame:
    """``(key, id, n)``: a row per band, of those with keys in ``live`` only where given.

    Two partitions that can meet share the rows per band tuned for them and,
    of these, at least the tuned number of bands.
    """
    bandings, edges = banding(low), np.array(low)

    def run(batches):
        for batch in vec.small(batches):
            ids, n = batch.column(0), batch.column(1).to_numpy()
            sig = _signatures(batch.column(2))
            part = np.searchsorted(edges, n, "right") - 1
            for p in np.unique(part):
                some = np.flatnonzero(part == p)
                for rows, bands in bandings[p].items():
                    keys = np.zeros((len(some), bands), vec.U)
                    block = sig[some, : bands * rows].reshape(len(some), bands, rows)
                    for r in range(rows):
                        keys = vec.mix(keys ^ block[:, :, r], r + 1)
                    keys = vec.mix(keys + np.arange(bands, dtype=vec.U), 1000 + rows).ravel()
                    of = np.repeat(some, bands)
                    if live is not None:
                        mine = live.has(keys)
                        keys, of = keys[mine], of[mine]
                    yield pa.RecordBatch.from_arrays([vec.signed(keys), ids.take(pa.array(of)), pa.array(n[of])], ["key", "id", "n"])

    return reps.select("id", "n", "sig").mapInArrow(run, "key bigint, id bigint, n int")


def near(a: Column, b: Column) -> Column:
    """Sizes that may belong to near copies."""
    return F.greatest(a, b) <= F.least(a, b) * MAX_RATIO


def enough(chance: float, ratio: float | np.ndarray = MAX_RATIO) -> np.ndarray:
    """How many hash functions agree at least for a pair at the threshold whose sizes differ by ``ratio``, any of them agreeing by chance so often."""
    floor = THRESHOLD / (1 + ratio - THRESHOLD)
    expected = floor + (1 - floor) * chance
    return np.floor(HASHES * expected - SIGMAS * np.sqrt(HASHES * expected * (1 - expected)))


def _named(ids: DataFrame) -> vec.Bloom:
    """A Bloom table of ``ids`` of one column: 16 bits or more each, as long as these are not more than 2^26."""
    return vec.bloom_of(ids, ids.columns[0], min(max((16 * ids.count()).bit_length(), 12), 26))


def _those(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """``rows``, the first column of which is an id, without most of those whose ids aren't among ``ids(id)``; rows without an id aren't allowed."""
    named = _named(ids)

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(named.has(batch.column(0).to_numpy().view(vec.U))))

    return rows.mapInArrow(run, rows.schema)


def likely(pairs: DataFrame, reps: DataFrame, scratch: Scratch) -> DataFrame:
    """Those of ``pairs(a, b)`` whose sizes and signatures allow near copies."""
    pairs = scratch.table(pairs, "minhash-met")
    reps = _those(reps.select("id", "n", "sig"), pairs.select(F.explode(F.array("a", "b")).alias("id")))

    def run(batches):
        for batch in batches:
            na, nb = (batch.column(k).to_numpy() for k in (4, 5))
            some = (_signatures(batch.column(2)) == _signatures(batch.column(3))).sum(axis=1) >= enough(1 / (1 << 16), np.maximum(na, nb) / np.minimum(na, nb))
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(pa.array(some)) for k in range(2)], ["a", "b"])

    x = reps.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("sig").alias("ga"))
    y = reps.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("sig").alias("gb"))
    both = pairs.join(x, "a").join(y, "b").where(near(F.col("na"), F.col("nb"))).select("a", "b", "ga", "gb", "na", "nb")
    return both.mapInArrow(run, "a bigint, b bigint").distinct()


def alike(s: np.ndarray, t: np.ndarray, ratio: float = MAX_RATIO) -> bool:
    """Near copies, by exact containment of sorted sets whose sizes differ by at most ``ratio``."""
    small, large = (s, t) if len(s) <= len(t) else (t, s)
    if not len(small) or len(large) > ratio * len(small):
        return False
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    return int((large[at] == small).sum()) >= THRESHOLD * len(small) - 1e-9


def verified(pairs: DataFrame, docs: DataFrame, scratch: Scratch, ratio: float = MAX_RATIO) -> DataFrame:
    """Those of the distinct ``pairs(a, b)`` that are near copies, or links of sizes up to ``ratio``, by exact containment.

    Only texts that a candidate names are hashed again: a Bloom table of bounded
    size lets their ids through, the join to the pairs is exact.
    """
    bloom = _named(pairs.select(F.explode(F.array("a", "b")).alias("id")))

    def hashed(batches):
        for batch in vec.small(batches):
            some = pa.array(np.flatnonzero(bloom.has(batch.column(0).to_numpy().view(vec.U))))
            for lo in range(0, len(some), 256):
                part = batch.take(some[lo : lo + 256])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([s.tobytes() for s in shingle_sets(part.column(1))], pa.binary())], ["id", "s"])

    load = lambda raw: np.frombuffer(raw, vec.U)
    return _dealt(pairs, texts(docs).where("doc_id is not null").mapInArrow(hashed, "id bigint, s binary"), load, load, lambda s, t: alike(s, t, ratio))


def plausible(pairs: DataFrame, signs: DataFrame, ratio: float = MAX_RATIO) -> DataFrame:
    """Those of the distinct ``pairs(a, b)`` that :func:`verified` can find right, by packed sets, an eighth of the bytes or less.

    Values that the larger set lacks are no more than the shingles that it lacks, so no pair is lost.
    """

    def head(raw):
        n, v = unpacked(raw)
        has = np.zeros(PACKED, bool)
        has[v] = True
        return n, len(v), has

    def fits(s, t):
        (n, v), (m, values, has) = s, t
        least = min(n, m)
        lacks = (len(v) if n <= m else values) - int(has[v].sum())
        return max(n, m) <= ratio * least and lacks <= least - math.ceil(THRESHOLD * least - 1e-9)

    sets = _those(signs.select(F.col("doc_id").alias("id"), F.col("packed").alias("s")), pairs.select(F.explode(F.array("a", "b")).alias("id")))
    return _dealt(pairs, sets, head, unpacked, fits)


def _dealt(pairs: DataFrame, sets: DataFrame, head, load, fits) -> DataFrame:
    """Those of the distinct ``pairs(a, b)`` of which any of b's ``sets(id, s)`` fits any of a's.

    Each b goes to the group of its a; a itself goes first to all of the group's parts.
    """

    def held(batches):
        group, heads = None, []
        for batch in batches:
            out = []
            for a, part, first, b, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (a, part) != group:
                    group, heads = (a, part), []
                if first:
                    heads.append(head(raw))
                elif any(fits(s, t) for s in (load(raw),) for t in heads):
                    out.append((a, b))
            x = np.array(out, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(x[:, 0]), pa.array(x[:, 1])], ["a", "b"])

    parts = pairs.groupBy(F.col("a").alias("g")).agg(F.ceil(F.count("*") / GROUP).cast("int").alias("parts"))
    heads = parts.select("g", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(True).alias("first"), F.col("g").alias("to"))
    others = pairs.join(parts, F.col("a") == F.col("g")).select("g", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"), F.lit(False).alias("first"), F.col("b").alias("to"))
    dealt = sets.join(heads.unionAll(others), F.col("id") == F.col("to")).select("g", "part", "first", "id", "s")
    # a set of some kilobytes is not sorted twice
    return dealt.repartition("g", "part").sortWithinPartitions("g", "part", F.desc("first")).mapInArrow(held, "a bigint, b bigint").distinct()


def _nibbles(reps: DataFrame, ids: DataFrame) -> DataFrame:
    """Four bits of each hash function, packed into bigints, for the ids that rest buckets hold."""

    def run(batches):
        for batch in batches:
            sig = _signatures(batch.column(1)).reshape(-1, HASHES // 16, 16)
            packed = ((sig & vec.U(15)) << (np.arange(16, dtype=vec.U) * vec.U(4))).sum(axis=2, dtype=vec.U)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(vec.signed(np.ascontiguousarray(packed[:, k])) for k in range(HASHES // 16))], ["id", *(f"k{k}" for k in range(HASHES // 16))])

    return _those(reps.select("id", "sig"), ids).join(ids, "id", "left_semi").select("id", "sig").mapInArrow(run, "id bigint, " + ", ".join(f"k{k} bigint" for k in range(HASHES // 16)))


def _agreeing(x: str, y: str) -> Column:
    """How many nibbles of two rows agree."""
    ones = 0x1111111111111111
    total = F.lit(0)
    for k in range(HASHES // 16):
        d = F.col(f"{x}.k{k}").bitwiseXOR(F.col(f"{y}.k{k}"))
        d = d.bitwiseOR(F.shiftright(d, 2).bitwiseAND(F.lit(0x3333333333333333)))
        d = d.bitwiseOR(F.shiftright(d, 1)).bitwiseAND(F.lit(ones))
        total = total + (F.lit(16) - F.bit_count(d))
    return total


def classes(docs: DataFrame) -> DataFrame:
    """``(doc_id, class_id, n_shingles, family_id, contained)`` of every row of ``docs(doc_id, text)``.

    class_id is the least doc_id of the near copies, family_id that of all that
    links of any sizes join; contained tells whether a set of more than
    MAX_RATIO times the size holds THRESHOLD of the text's.
    """
    with Scratch(docs.sparkSession) as scratch:
        return materialize(_classes(docs, scratch), "classes")


def _classes(docs: DataFrame, scratch: Scratch) -> DataFrame:
    signs = scratch.table(signed_docs(docs), "minhash")
    reps = scratch.table(signs.groupBy("s1", "s2", "n").agg(F.min("doc_id").alias("id"), F.first("sig").alias("sig")), "minhash-sets")
    scratch.tidy()
    low = bounds(reps)
    if not low:
        roots = families = docs.sparkSession.createDataFrame([], "node bigint, root bigint")
        inner = docs.sparkSession.createDataFrame([], "inner bigint")
    else:
        roots = _roots(docs, signs, reps, low, _repeated(signs, reps), scratch)
        scratch.tidy()
        families, inner = _families(docs, signs, roots, scratch)
    root = lambda x, name: x.select(F.col("node").alias(f"{name}_node"), F.col("root").alias(name))
    known = reps.select("id", "s1", "s2").join(root(roots, "class"), F.col("id") == F.col("class_node"), "left").join(root(families, "family"), F.col("id") == F.col("family_node"), "left").join(inner, F.col("id") == F.col("inner"), "left")
    known = known.select("s1", "s2", F.coalesce("class", "id").alias("root"), F.coalesce("family", "id").alias("family"), F.col("inner").isNotNull().alias("held"))
    # rows that repeat a doc_id have one class
    of_doc = signs.select("doc_id", "s1", "s2", "n").join(known, ["s1", "s2"]).groupBy(F.col("doc_id").alias("known_id")).agg(F.min("root").alias("root"), F.max("n").alias("n"), F.min("family").alias("family"), F.min("held").alias("held"))
    out = docs.select(docs["doc_id"].cast("bigint").alias("doc_id")).join(of_doc, F.col("doc_id") == F.col("known_id"), "left")
    return out.select("doc_id", F.coalesce("root", "doc_id").alias("class_id"), F.coalesce(F.col("n").cast("bigint"), F.lit(0)).alias("n_shingles"), F.coalesce("family", "doc_id").alias("family_id"), F.coalesce("held", F.lit(False)).alias("contained"))


def _repeated(signs: DataFrame, reps: DataFrame) -> DataFrame:
    """Edges between the sets of rows that repeat a doc_id."""
    own = F.struct("s1", "s2")
    several = signs.groupBy(F.col("doc_id").alias("d")).agg(F.min(own).alias("lo"), F.max(own).alias("hi")).where("lo <> hi").select("d")
    sets = signs.join(several, F.col("doc_id") == F.col("d")).select("d", "s1", "s2").join(reps.select("id", "s1", "s2"), ["s1", "s2"]).select("d", "id")
    least = sets.groupBy(F.col("d").alias("of")).agg(F.min("id").alias("a"))
    return sets.join(least, F.col("d") == F.col("of")).where("a <> id").select("a", F.col("id").alias("b")).distinct()


def _held(posts: DataFrame, roots: DataFrame) -> DataFrame:
    """Postings with the classes of their documents, of buckets that hold several classes."""
    held = posts.join(roots, F.col("id") == F.col("node"), "left").select("key", "id", "n", F.coalesce("root", "id").alias("class"))
    mixed = held.groupBy(F.col("key").alias("k")).agg(F.min("class").alias("c0"), F.max("class").alias("c1")).where("c0 <> c1").select("k")
    return held.join(mixed, F.col("key") == F.col("k"), "left_semi")


def _roots(docs: DataFrame, signs: DataFrame, reps: DataFrame, low: list[int], repeated: DataFrame, scratch: Scratch) -> DataFrame:
    posts = postings(reps, low)
    shared = posts.groupBy(F.col("key").alias("k")).agg(F.min("id").alias("hub"), F.max("id").alias("last")).where("hub <> last").select("k", "hub")
    shared = scratch.table(shared, "minhash-shared")
    posts = postings(reps, low, vec.bloom_of(shared, "k", 26))
    posts = scratch.table(posts.join(shared, F.col("key") == F.col("k")).select("key", "id", "n", "hub"), "minhash-buckets")
    scratch.tidy()
    edge = lambda x, y: (F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))
    # each set with the smallest hub of its buckets
    tried = scratch.table(likely(posts.where("id <> hub").groupBy("id").agg(F.min("hub").alias("a")).select("a", F.col("id").alias("b")), reps, scratch), "minhash-stars")
    exact = lambda x: verified(scratch.table(plausible(x, signs), "minhash-plausible"), docs, scratch)
    roots = components(repeated.unionAll(exact(tried)), scratch)
    joined = lambda more: components(roots.select(F.col("root").alias("a"), F.col("node").alias("b")).unionAll(exact(more)), scratch)
    for k in range(ROUNDS + 1):
        scratch.tidy()
        held = scratch.table(_held(posts, roots), "minhash-rest")
        if held.isEmpty():
            return roots
        if k == ROUNDS:
            break
        # the classes of a bucket meet one of them; which one, and by which members, differs from round to round
        draw = lambda c: F.xxhash64(c, F.lit(k))  # noqa: B023, E731
        stands = held.groupBy("key", "class").agg(F.min(F.struct(draw("id").alias("d"), "id"))["id"].alias("id"))
        hub = stands.groupBy(F.col("key").alias("k")).agg(F.min(F.struct(draw("class").alias("d"), "class", "id")).alias("h"))
        met = stands.join(hub, F.col("key") == F.col("k")).where(F.col("class") != F.col("h.class")).select(*edge("id", "h.id")).distinct()
        more = scratch.table(likely(met.join(tried, ["a", "b"], "left_anti"), reps, scratch), "minhash-more-stars")
        tried = tried.unionAll(more)
        roots = joined(more)

    bits = scratch.table(_nibbles(reps, held.select("id").distinct()), "minhash-nibbles")
    rest = held.join(bits, "id")
    x, y = rest.alias("x"), rest.alias("y")
    met = (F.col("x.key") == F.col("y.key")) & (F.col("x.class") < F.col("y.class")) & near(F.col("x.n"), F.col("y.n")) & (_agreeing("x", "y") >= int(enough(1 / 16)))
    pairs = x.join(y, met).select(*edge("x.id", "y.id")).distinct()
    pairs = scratch.table(likely(pairs.join(tried, ["a", "b"], "left_anti"), reps, scratch), "minhash-rest-pairs")
    return joined(pairs)


HITS = "key bigint, id bigint, n int, s1 bigint, own boolean"
BUCKETS = "key bigint, id bigint, n int, larger int, own boolean, up bigint, down bigint"


def hits(docs: DataFrame, posted: vec.Bloom, high: vec.Bloom) -> DataFrame:
    """Each set's hashes that may be posted; its ``own`` are its SAMPLE least ones."""

    def run(batches):
        for batch in vec.small(batches):
            keys, size, s1 = [], [], []
            for s in shingle_sets(batch.column(1)):
                keys.append(sampled(s))
                size.append(len(s))
                s1.append(vec.mix(s, 1).sum() if len(s) else vec.U(0))
            size = np.array(size)
            m, row = np.concatenate([np.zeros(0, vec.U), *keys]), np.repeat(np.arange(len(size)), size)
            own = np.arange(len(m)) - np.repeat(np.cumsum(size) - size, size) < SAMPLE
            some = np.flatnonzero(posted.has(m))
            rest = some[m[some] >= vec.U(COMMON)]
            some = np.sort(np.concatenate([some[m[some] < vec.U(COMMON)], rest[high.has(m[rest])]]))
            at = row[some]
            yield pa.RecordBatch.from_arrays([vec.signed(m[some]), batch.column(0).take(pa.array(at)), pa.array(size[at].astype(np.int32)), vec.signed(np.array(s1, vec.U)[at]), pa.array(own[some])], ["key", "id", "n", "s1", "own"])

    return texts(docs).where("doc_id is not null").mapInArrow(run, HITS)


def _whole_keys(batches, step: int = 100_000):
    """Lists of batches sorted by their first column, no key of which goes on in the next list."""
    held, rows = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        k = batch.column(0).to_numpy()
        if rows < step or k[0] == k[-1]:
            continue
        cut = int(np.searchsorted(k, k[-1]))
        held[-1] = batch.slice(0, cut)
        yield held
        held, rows = [batch.slice(cut)], batch.num_rows - cut
    if held:
        yield held


def _column(batches: list[pa.RecordBatch], k: int) -> np.ndarray:
    return pa.concat_arrays([b.column(k) for b in batches]).to_numpy(zero_copy_only=False)


def _bitmaps(batches: list[pa.RecordBatch], k: int) -> np.ndarray:
    """A column of bitmaps as rows of 64-bit words."""
    column = pa.concat_arrays([b.column(k) for b in batches])
    at = np.frombuffer(column.buffers()[1], np.int32)[column.offset]
    return np.frombuffer(column.buffers()[2], np.uint8)[at : at + len(column) * BITMAP // 8].view(vec.U).reshape(-1, BITMAP // 64)


def _groups(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and end of each row's run of equal keys."""
    head = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    n = np.diff(np.append(head, len(key)))
    return np.repeat(head, n), np.repeat(head + n, n)


def _larger_from(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Where, in each row's group that begins at ``first``, the sets begin that are more than MAX_RATIO times as large; groups are sorted by ``n``."""
    at = first.astype(np.float64) * (1 << 32)
    return np.searchsorted(at + n, at + MAX_RATIO * n, "right")


def buckets(found: DataFrame) -> DataFrame:
    """Of each key that a set posted and a larger one holds, the distinct sets; ``larger`` is how many may hold the row's, ``up``, the largest, may hold the row's, ``down``, the smallest that posted, may lie in it."""

    def run(batches):
        for part in _whole_keys(batches):
            key, ids, n, s1, own = (_column(part, k) for k in range(5))
            order = np.lexsort((ids, s1, n, key))
            k, m, s = key[order], n[order], s1[order]
            one = np.concatenate(([True], (k[1:] != k[:-1]) | (m[1:] != m[:-1]) | (s[1:] != s[:-1])))
            order = order[one]
            key, ids, n, own = key[order], ids[order], n[order], own[order].astype(bool)
            first, end = _groups(key)
            posted = np.append(np.flatnonzero(own), len(key))
            least = posted[np.searchsorted(posted, first)]  # of the bucket, if before its end
            least = np.where(least < end, least, end - 1)
            larger = end - _larger_from(first, n)
            up, down = own & (larger > 0), n > MAX_RATIO * n[least]
            live = np.flatnonzero(up | down)
            mate = lambda at, has: pa.array(ids[at[live]], mask=~has[live])  # noqa: B023, E731
            yield pa.RecordBatch.from_arrays([pa.array(key[live]), pa.array(ids[live]), pa.array(n[live]), pa.array(larger[live].astype(np.int32)), pa.array(up[live]), mate(end - 1, up), mate(least, down)], ["key", "id", "n", "larger", "own", "up", "down"])

    return found.repartition("key").sortWithinPartitions("key").mapInArrow(run, BUCKETS)


def _bits(sets: DataFrame) -> DataFrame:
    """``(id, n, bits)``: bitmaps of packed sets."""

    def run(batches):
        for batch in vec.small(batches):
            bits = [bitmap(unpacked(raw)[1].astype(vec.U)) for raw in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(bits, pa.binary())], ["id", "n", "bits"])

    return sets.mapInArrow(run, "id bigint, n int, bits binary")


def _larger(rows: DataFrame) -> DataFrame:
    """``(a, b)``: of each key, the rows b that still look for sets that hold them, with larger ones of other classes, or families if found already, whose bitmaps lack no more than they may."""

    def run(batches):
        for part in _whole_keys(batches, 20_000):
            key, n, ids, looks, held, kind, family = (_column(part, k) for k in range(7))
            bits = _bitmaps(part, 7)
            lacking = ~bits
            most = n - np.ceil(THRESHOLD * n - 1e-9).astype(np.int64)
            first, end = _groups(key)
            start = _larger_from(first, n)
            out, made = [np.zeros((0, 2), np.int64)], 0
            for i in np.flatnonzero(looks.astype(bool) & (start < end)):
                for lo in range(start[i], end[i], HEAVY):
                    j = slice(lo, min(lo + HEAVY, end[i]))
                    other = family[j] != family[i] if held[i] else kind[j] != kind[i]
                    some = ids[j][other & (np.bitwise_count(bits[i] & lacking[j]).sum(axis=1, dtype=np.int64) <= most[i])]
                    if len(some):
                        out.append(np.stack([some, np.full(len(some), ids[i])], axis=1))
                        made += len(some)
                if made > 1 << 16:
                    x, out, made = np.unique(np.concatenate(out), axis=0), [np.zeros((0, 2), np.int64)], 0
                    yield pa.RecordBatch.from_arrays([pa.array(x[:, 0]), pa.array(x[:, 1])], ["a", "b"])
            x = np.unique(np.concatenate(out), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(x[:, 0]), pa.array(x[:, 1])], ["a", "b"])

    return rows.repartition("key").sortWithinPartitions("key", "n").mapInArrow(run, "a bigint, b bigint").distinct()


def _least(n: Column) -> Column:
    """How many of the hashes that a set of ``n`` posted its holder has at least; of sets of fewer than SAMPLE these are all of them."""
    return F.when(n < SAMPLE, F.ceil(n * THRESHOLD - 1e-9)).otherwise(SHARED).cast("int")


def _looks(rows: DataFrame) -> DataFrame:
    """``(id, key)``: where sets look for their holders, which have at least so many of a set's keys that one of these buckets is among them."""
    own = rows.where(F.col("own") & F.col("up").isNotNull()).groupBy("id").agg(F.min("n").alias("n"), F.sort_array(F.collect_list(F.struct("larger", "key"))).alias("keys"))
    several = F.size("keys") - _least(F.col("n")) + 1
    return own.where(several > 0).select("id", F.explode(F.slice("keys", F.lit(1), several)).alias("x")).select("id", "x.key")


def _hashes(docs: DataFrame, ids: DataFrame, some) -> DataFrame:
    """``(key, id, n)``: those ``some`` of the ordered hashes of the texts that ``ids(id)`` names, and of few others."""
    named = _named(ids)

    def run(batches):
        for batch in vec.small(batches):
            batch = batch.take(pa.array(np.flatnonzero(named.has(batch.column(0).to_numpy().view(vec.U)))))
            sets = [sampled(s) for s in shingle_sets(batch.column(1))]
            keys = [np.zeros(0, vec.U), *map(some, sets)]
            at = np.repeat(np.arange(len(sets)), [len(k) for k in keys[1:]])
            size = np.array([len(s) for s in sets], np.int32)
            yield pa.RecordBatch.from_arrays([vec.signed(np.concatenate(keys)), batch.column(0).take(pa.array(at)), pa.array(size[at])], ["key", "id", "n"])

    return texts(docs).where("doc_id is not null").mapInArrow(run, "key bigint, id bigint, n int")


def _held_somewhere(docs: DataFrame, rows: DataFrame, look: DataFrame, scratch: Scratch) -> DataFrame:
    """Those of ``look(id, key)`` whose sets have enough hashes that larger sets of the buckets hold, each hash any of them.

    Most sets that look in vain have a line that many hold and some words of
    their own, which no larger set holds.
    """
    wide = scratch.table(_hashes(docs, look.select("id"), lambda m: m[:WIDE]), "minhash-wide")
    asked = _named(wide.select("key"))
    holders = rows.join(look.select("key").distinct(), "key", "left_semi").select("id")
    most = _hashes(docs, holders, lambda m: m[asked.has(m)]).groupBy(F.col("key").alias("held_key")).agg(F.max("n").alias("most"))
    held = wide.join(most, F.col("key") == F.col("held_key")).where(F.col("most") > F.col("n") * MAX_RATIO)
    least = F.when(F.col("n") <= WIDE, F.ceil(F.col("n") * THRESHOLD - 1e-9)).otherwise(WIDE_SHARED)
    live = held.groupBy("id", "n").agg(F.count("*").alias("held")).where(F.col("held") >= least)
    return look.join(live.select("id").distinct(), "id", "left_semi")


def _sharing(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """Those of ``pairs(a, b)`` of which a holds enough of what b posted."""
    own = rows.where("own").select("key", F.col("id").alias("of"), "n")
    held = rows.select(F.col("key").alias("held_key"), F.col("id").alias("by"))
    both = pairs.join(own, F.col("b") == F.col("of")).join(held, (F.col("a") == F.col("by")) & (F.col("key") == F.col("held_key")))
    return both.groupBy("a", "b").agg(F.count("*").alias("shared"), F.min("n").alias("n")).where(F.col("shared") >= _least(F.col("n"))).select("a", "b")


def _families(docs: DataFrame, signs: DataFrame, roots: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """``(node, root)`` by links of any sizes, and the ids ``inner`` of sets that lie in much larger ones."""
    low = signs.select(F.explode("low").alias("key"))
    high = low.where((F.col("key") < 0) | (F.col("key") >= COMMON))
    rows = scratch.table(buckets(hits(docs, vec.bloom_of(low, "key", 26), vec.bloom_of(high, "key", 26))), "minhash-holders")
    scratch.tidy()
    link = lambda x: x.select(F.col("a"), F.col("b")).where("a <> b").distinct()
    tried = scratch.table(_sharing(link(rows.where("up is not null").select(F.col("up").alias("a"), F.col("id").alias("b")).unionAll(rows.where("down is not null").select(F.col("id").alias("a"), F.col("down").alias("b")))), rows), "minhash-ends")
    exact = lambda x: verified(scratch.table(plausible(x, signs, math.inf), "minhash-plausible"), docs, scratch, math.inf)
    scratch.tidy()
    links = scratch.table(exact(tried), "minhash-inner")
    scratch.tidy()
    edges = lambda x, y: components(x.select(F.col("root").alias("a"), F.col("node").alias("b")).unionAll(y), scratch)
    families = edges(roots, links)
    inner = links.select(F.col("b").alias("inner")).distinct()
    root = lambda x, name: x.select(F.col("node").alias(f"{name}_node"), F.col("root").alias(name))
    look = scratch.table(_looks(rows), "minhash-looks")
    look = scratch.table(_held_somewhere(docs, rows, look, scratch), "minhash-looks-held")
    # only the buckets in which a set looks
    x = rows.join(look.select("key").distinct(), "key", "left_semi").select("key", "n", "id")
    x = x.join(look.select("key", "id", F.lit(True).alias("looks")), ["key", "id"], "left")
    x = scratch.table(x.join(root(roots, "class"), F.col("id") == F.col("class_node"), "left").join(root(families, "family"), F.col("id") == F.col("family_node"), "left").join(inner, F.col("id") == F.col("inner"), "left"), "minhash-looking")
    # rows that repeat a doc_id may have several sets of a size, each with its bitmap
    bits = _bits(_those(signs.select(F.col("doc_id").alias("id"), "n", "packed"), x.select("id"))).repartition("id").distinct()
    x = x.withColumnRenamed("n", "size").join(bits, "id").where("n = size")
    x = x.select("key", "n", "id", F.coalesce("looks", F.lit(False)).alias("looks"), F.col("inner").isNotNull().alias("held"), F.coalesce("class", "id").alias("kind"), F.coalesce("family", "id").alias("kin"), "bits")
    scratch.tidy()
    more = scratch.table(_sharing(_larger(x), rows).join(tried, ["a", "b"], "left_anti"), "minhash-larger")
    scratch.tidy()
    if more.isEmpty():
        return families, inner
    found = scratch.table(exact(more), "minhash-more-inner")
    return edges(families, found), inner.unionAll(found.select("b")).distinct()


def keep(docs: DataFrame, contained: bool = False) -> DataFrame:
    """``docs`` without near copies: of each class the document with most shingles stays, the least doc_id among equals.

    With ``contained``, those that lie in much larger documents go, too.
    Rows that repeat a doc_id count as one document; rows without one stay.
    Texts stay where they are, as in :func:`line_dedup.keep`.
    """
    found = classes(docs)
    best = found.where("doc_id is not null").groupBy(F.col("class_id").alias("c")).agg(F.max(F.struct("n_shingles", (-F.col("doc_id")).alias("minus"))).alias("best"))
    out = F.col("doc_id") != -F.col("best.minus")
    gone = found.join(best, F.col("class_id") == F.col("c")).where(out | F.col("contained") if contained else out).select(F.col("doc_id").alias("gone_id")).distinct()
    with Scratch(docs.sparkSession) as scratch:
        gone = materialize(gone, "near-copies")
        ids = docs.select(docs["doc_id"].cast("bigint").alias("gone_id")).where("gone_id is not null")
        of = cascade(gone, ids, _id_hash, scratch)
    if of is None:
        return docs.join(gone, docs["doc_id"] == gone["gone_id"], "left_anti")

    @F.arrow_udf("boolean")
    def goes(column: pa.Array) -> pa.Array:
        return pa.array(of.has(pc.fill_null(column, 0).to_numpy(zero_copy_only=False).view(vec.U)))

    return docs.where(docs["doc_id"].isNull() | ~goes(docs["doc_id"].cast("bigint")))


def _id_hash(ids: np.ndarray) -> np.ndarray:
    return ids.view(vec.U)
