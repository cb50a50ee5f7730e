"""Deduplication, decontamination, quality, licences, toxicity against brute force."""

import collections
import itertools
import math
import os
import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from pyspark.sql import functions as F
from vellum.llm import components, decontaminate, license_scan, line_dedup, near_dedup, quality_bayes, quality_rules, queries, toxicity

from ..conftest import SF

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, root string"
EMPTY = [(None, "no id", "en", "s", 5, "r"), (901, None, None, None, None, "r"), (902, "", "en", "s", 0, "r"), (903, " \n\t", "en", "s", 3, "r")]


def documents(spark, texts, extra=True):
    rows = [(k, t, "en", f"s{k % 3}", len(t), "r") for k, t in enumerate(texts)]
    return spark.createDataFrame(rows + EMPTY * extra, DOCS)


def prose(rnd, n, words=4000):
    return " ".join(f"w{rnd.randrange(words)}" for _ in range(n))


def edited(rnd, text, share):
    return " ".join(f"e{rnd.randrange(10**6)}" if rnd.random() < share else w for w in text.split(" "))


@pytest.fixture(scope="module")
def copies():
    rnd = random.Random(3)
    out = []
    for _ in range(25):
        base = prose(rnd, rnd.randrange(6, 300))
        out += [base, base, *(edited(rnd, base, s) for s in (0.004, 0.01, 0.02, 0.05, 0.5))]
        out.append(base + " " + prose(rnd, 20))
    group = prose(rnd, 400)
    out += [edited(rnd, group, 0.01) for _ in range(60)]
    shared = prose(rnd, 60)
    out += [shared + " " + prose(rnd, 200) for _ in range(40)]
    return [*out, "one two", "one two", "solo"]


# ---- near duplicates ----


def test_near_duplicates_equal_brute_force(spark, copies):
    def shingles(t):
        w = t.split()
        return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4)))

    sets = [shingles(t) for t in copies]
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    similar = []
    for a, b in itertools.combinations(range(len(sets)), 2):
        both, small, large = len(sets[a] & sets[b]), *sorted((len(sets[a]), len(sets[b])))
        if both >= 0.8 * small and large <= 1.25 * small:
            similar.append((a, b, both / (small + large - both)))
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    rows = near_dedup.classes(documents(spark, copies)).collect()
    got = {r.doc_id: r.class_id for r in rows if r.doc_id is not None and r.doc_id < 900}
    assert all(got[a] == got[b] for a, b, j in similar if j >= 0.8)
    wrong = [k for k in got if got[k] != find(k)]  # only at the very threshold may a link be missed
    assert len(wrong) <= 0.02 * len(got)
    assert {(r.doc_id, r.class_id, r.n_shingles) for r in rows if r.doc_id is None or r.doc_id > 900} == {(None, None, 0), (901, 901, 0), (902, 902, 0), (903, 903, 0)}
    kept = near_dedup.keep(documents(spark, copies))
    assert kept.columns == documents(spark, copies).columns
    ids = [r.doc_id for r in kept.collect()]
    assert len([i for i in ids if i is not None and i < 900]) == len(set(got.values()))
    assert {None, 901, 902, 903} <= set(ids)


def test_near_duplicates_of_nothing(spark):
    assert near_dedup.classes(documents(spark, []).limit(0)).count() == 0
    assert near_dedup.keep(documents(spark, [])).count() == 4


def test_tuning():
    for jaccard in (0.99, 0.8, 0.55, 0.3, 0.1):
        bands, rows = near_dedup.tuned(jaccard)
        assert bands * rows <= near_dedup.HASHES
        assert 1 - (1 - jaccard**rows) ** bands >= near_dedup.RECALL or rows == 1
    assert all(d for d in near_dedup.banding([1, 10, 11, 12, 100]))
    far = near_dedup.plan([1, 10, 11, 12, 100])
    assert (1, 2) in [x[:2] for x in far]
    assert (0, 4) not in [x[:2] for x in far]


def test_recall_of_the_bands():
    """Pairs at the very threshold, of equal sizes up to the largest ratio, share a band with a chance of at least 0.9; nearly all that are much alike do."""
    rnd = np.random.default_rng(7)
    low = [20, 60, 100, 200, 400]
    bands = near_dedup.banding(low)
    part = lambda n: int(np.searchsorted(low, n, "right")) - 1

    def met(n, m, both):
        x = rnd.integers(0, 1 << 63, n + m, np.uint64)
        a, b = near_dedup.signature(np.sort(x[:n])), near_dedup.signature(np.sort(np.concatenate([x[:both], x[n : n + m - both]])))
        p, q = bands[part(n)], bands[part(m)]
        return any((a[k * r : k * r + r] == b[k * r : k * r + r]).all() for r in set(p) & set(q) for k in range(min(p[r], q[r])))

    for n, m in ((100, 100), (100, 124), (190, 230), (320, 400)):
        assert np.mean([met(n, m, math.ceil(0.8 * n)) for _ in range(300)]) >= 0.9
    assert all(met(200, 210, 195) for _ in range(300))
    assert np.mean([met(200, 220, 20) for _ in range(300)]) <= 0.05


def test_signatures_are_held_to_the_sizes_of_the_pair():
    """Pairs of equal sizes need more agreement than those at the largest ratio; pairs at the threshold have it."""
    rnd = np.random.default_rng(11)
    assert near_dedup.enough(0, 1.0) >= near_dedup.enough(0) + 5
    for n, m in ((200, 200), (200, 250)):
        for _ in range(300):
            x = rnd.integers(0, 1 << 63, n + m, np.uint64)
            a, b = near_dedup.signature(np.sort(x[:n])), near_dedup.signature(np.sort(np.concatenate([x[:160], x[n : n + m - 160]])))
            assert (a == b).sum() >= near_dedup.enough(1 / (1 << 16), m / n)


def test_repeated_ids_put_their_texts_in_one_class(spark):
    rnd = random.Random(17)
    a, b, c = (prose(rnd, 50) for _ in range(3))
    docs = spark.createDataFrame([(1, a), (5, a), (5, b), (2, b), (3, c), (3, c), (4, " ".join(c.split()[:25])), (6, None)], "doc_id bigint, text string")
    rows = sorted((r.doc_id, r.class_id) for r in near_dedup.classes(docs).collect())
    assert rows == [(1, 1), (2, 1), (3, 3), (3, 3), (4, 4), (5, 1), (5, 1), (6, 6)]  # 4 is half of 3: no near copy of it


@pytest.mark.parametrize("heavy", [256, 3])
def test_contained_texts_equal_brute_force(spark, monkeypatch, heavy):
    """Texts in much larger ones are links, whatever the sizes; a passage that many share neither hides nor makes any."""
    monkeypatch.setattr(near_dedup, "HEAVY", heavy)
    rnd = random.Random(23)
    passage = prose(rnd, 40)
    texts = [prose(rnd, rnd.randrange(60, 500)) for _ in range(40)]
    for base in texts[:20]:
        w = base.split()
        for share in (0.05, 0.2, 0.5, 0.7):
            n = max(3, int(share * len(w)))
            at = rnd.randrange(len(w) - n + 1)
            part = " ".join(w[at : at + n])
            texts += [part, edited(rnd, part, 0.015), edited(rnd, part, 0.1)]
    texts += [passage + " " + prose(rnd, rnd.randrange(5, 200)) for _ in range(30)] + [passage, " ".join(passage.split()[:20]), texts[40], texts[0]]
    sets = [frozenset(tuple((w := t.split())[k : k + 5]) for k in range(max(1, len(t.split()) - 4))) for t in texts]
    links = [(a, b) for a, s in enumerate(sets) for b, t in enumerate(sets) if len(t) > 1.25 * len(s) and len(s & t) >= 0.8 * len(s)]
    rows = {r.doc_id: r for r in near_dedup.classes(documents(spark, texts)).collect() if r.doc_id is not None and r.doc_id < 900}
    found = {k for k, r in rows.items() if r.contained}
    assert len({a for a, _ in links}) > 100
    assert found == {a for a, _ in links}
    assert all(rows[a].family_id == rows[b].family_id for a, b in links)
    parent = {}
    find = lambda x: x if parent.setdefault(x, x) == x else find(parent[x])
    for a, b in [*links, *((k, r.class_id) for k, r in rows.items())]:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    assert {k: r.family_id for k, r in rows.items()} == {k: find(k) for k in rows}


def test_a_passage_that_many_share_makes_no_pairs_of_its_texts(spark, monkeypatch):
    """Texts that share a quarter to half of their shingles aren't held against each other, while those in larger ones are found."""
    rnd = random.Random(31)
    passage = prose(rnd, 60)
    texts = [passage + " " + prose(rnd, rnd.randrange(60, 200)) for _ in range(80)]
    texts += [t + " " + prose(rnd, 100) for t in texts[:5]]
    seen, verified = [], near_dedup.verified
    monkeypatch.setattr(near_dedup, "verified", lambda pairs, *x: seen.append(pairs.count() if len(x) > 2 else 0) or verified(pairs, *x))
    rows = near_dedup.classes(documents(spark, texts)).where("contained").collect()
    assert {r.doc_id for r in rows} >= set(range(5))
    assert sum(seen) < 400


def test_sets_look_where_a_holder_must_be(spark):
    """Of 7 posted hashes that larger sets hold, a holder has 5, so one is among any 3; of 4 hashes it can't have 5."""
    own = [(k, i, 100, larger, True, 9, None) for i, some in ((1, [70, 10, 60, 20, 50, 30, 40]), (2, [1, 1, 1, 1]), (3, [5] * 12)) for k, larger in enumerate(some)]
    rows = spark.createDataFrame([*own, (50, 4, 100, 3, False, 9, 1), (51, 5, 3, 1, True, 9, None), (52, 5, 3, 2, True, 9, None), (53, 5, 3, 3, True, 9, None)], near_dedup.BUCKETS)
    found = sorted((r.id, r.key) for r in near_dedup._looks(rows).collect())
    assert found == [(1, 1), (1, 3), (1, 5), *((3, k) for k in range(8)), (5, 51)]


def test_bitmaps_never_lack_more_than_sets():
    rng = np.random.default_rng(37)
    for n in (3, 40, 300, 5000):
        x = rng.integers(0, 1 << 63, 2 * n, np.uint64)
        s, t = np.unique(x[:n]), np.unique(x[n // 5 :])
        a, b = (np.frombuffer(near_dedup.bitmap(v), np.uint64) for v in (s, t))
        assert np.bitwise_count(a & ~b).sum() <= n // 5
        if n == 300:
            assert np.bitwise_count(a & ~np.frombuffer(near_dedup.bitmap(np.unique(x[n:])), np.uint64)).sum() > n // 5


def test_packed_sets_never_lack_more_than_sets():
    rng = np.random.default_rng(41)
    for n in (1, 2, 40, 300, 5000, 40000):
        x = rng.integers(0, 1 << 63, 2 * n, np.uint64)
        s, t = np.unique(x[:n]), np.unique(x[n // 5 :])
        size, a = near_dedup.unpacked(near_dedup.packed(s))
        assert size == n and (a == np.unique(s & np.uint64(near_dedup.PACKED - 1))).all()
        assert len(np.setdiff1d(a, near_dedup.unpacked(near_dedup.packed(t))[1])) <= n // 5
        assert len(near_dedup.packed(s)) < 1.5 * n or n < 200


def test_only_pairs_that_packed_sets_allow_are_verified(spark, monkeypatch):
    """Texts that share two thirds of their shingles are candidates, but their whole sets do not travel; near copies are found."""
    rnd = random.Random(43)
    base = prose(rnd, 100)
    texts = [base + " " + prose(rnd, 50) for _ in range(40)]
    texts += [t + " " + prose(rnd, 4) for t in texts[:5]]
    seen, verified = [], near_dedup.verified
    monkeypatch.setattr(near_dedup, "verified", lambda pairs, *x: seen.append(pairs.count()) or verified(pairs, *x))
    rows = {r.doc_id: r.class_id for r in near_dedup.classes(documents(spark, texts)).collect() if r.doc_id is not None}
    assert all(rows[40 + k] == k for k in range(5)) and len({rows[k] for k in range(40)}) == 40
    assert 5 <= sum(seen) <= 20


def test_sets_of_hashes_that_no_larger_set_holds_look_nowhere(spark, monkeypatch):
    """Short texts of a line that many hold and words of their own are not held against its holders; those in a holder are."""
    rnd = random.Random(47)
    line = prose(rnd, 20)
    texts = [line + " " + prose(rnd, rnd.randrange(60, 90)) for _ in range(60)]
    texts += [line + " " + prose(rnd, 9) for _ in range(20)] + [" ".join(t.split()[:29]) for t in texts[20:24]]
    looking, larger = [], near_dedup._larger
    monkeypatch.setattr(near_dedup, "_larger", lambda rows: looking.append({r.id for r in rows.where("looks").select("id").collect()}) or larger(rows))
    rows = near_dedup.classes(documents(spark, texts)).where("contained and doc_id < 900").collect()
    assert {r.doc_id for r in rows} == {80, 81, 82, 83}
    assert len(looking) == 1 and not looking[0] & set(range(60, 80))


def test_pipeline_drops_contained_documents(spark):
    import corpus_pipeline

    rnd = random.Random(29)
    long = prose(rnd, 400)
    texts = [long, " ".join(long.split()[100:300]), prose(rnd, 200)]
    kept = dict(corpus_pipeline.STAGES)["near dedup"](spark, documents(spark, texts), SF)
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None and r.doc_id < 900) == [0, 2]


def test_pipeline_bounds_what_workers_get_at_once(spark):
    """12 MB of texts in one partition reach Python in parts, not as one batch of all rows."""
    import corpus_pipeline

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(key)
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("a" * 4000), F.col("id").cast("string")).alias("text")).coalesce(1)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["size"])

    try:
        dict(corpus_pipeline.STAGES)["byte-level BPE"](spark, docs, SF)
        assert max(r.size for r in docs.mapInArrow(sizes, "size bigint").collect()) < 5 << 20
        spark.conf.set(key, "1m")
        dict(corpus_pipeline.STAGES)["byte-level BPE"](spark, docs, SF)
        assert spark.conf.get(key) == "1m"
    finally:
        spark.conf.unset(key)


@pytest.mark.parametrize("bits", [16, 12, 6])
def test_cascades_tell_members_exactly(spark, bits):
    """Small tables let many keys through, each of which a further table sets right; full ones give no answer."""
    from vellum.llm import membership, shared

    every = spark.range(0, 6000).select(F.col("id").alias("x"))
    with shared.Scratch(spark) as scratch:
        found = membership.cascade(every.where("x % 7 = 3"), every, near_dedup._id_hash, scratch, bits)
    assert (found is None) == (bits == 6)
    if found is not None:
        assert bits != 12 or len(found.levels) > 2
        x = np.arange(6000)
        assert (found.has(near_dedup._id_hash(x)) == (x % 7 == 3)).all()


def test_kept_texts_are_not_moved(spark, copies, monkeypatch):
    """Both stages leave texts in their partitions, and give what a join of documents gives."""
    docs = documents(spark, copies)
    for module in (line_dedup, near_dedup):
        kept = module.keep(docs)
        assert "Exchange" not in kept._jdf.queryExecution().executedPlan().toString()
        monkeypatch.setattr(module, "cascade", lambda *_: None)
        joined = module.keep(docs)
        assert "Exchange" in joined._jdf.queryExecution().executedPlan().toString()
        assert kept.columns == joined.columns
        assert sorted(map(tuple, kept.collect()), key=str) == sorted(map(tuple, joined.collect()), key=str)
        assert kept.count() < docs.count()


def test_components(spark):
    rnd = random.Random(1)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(1000, 1060)] + [(5, 5)]
    parent = {}
    find = lambda x: x if parent.setdefault(x, x) == x else find(parent[x])
    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {x: find(x) for x in parent if find(x) != x}


# ---- lines ----


def brute_lines(texts):
    seen, gone = [], set()
    for d, t in enumerate(texts):
        for k, line in enumerate(t.split("\n")):
            s = frozenset(line.split())
            if not s:
                continue
            if any(5 * len(s & x) >= 4 * len(s | x) for x in seen):
                gone.add((d, k))
            seen.append(s)
    return gone


def test_lines_equal_brute_force(spark):
    rnd = random.Random(5)
    bases = [prose(rnd, rnd.randrange(3, 60), 500) for _ in range(60)]
    texts = ["\n".join(edited(rnd, rnd.choice(bases), rnd.choice([0, 0.02, 0.1, 0.3])) if rnd.random() < 0.7 else prose(rnd, rnd.randrange(12), 30) for _ in range(8)) for _ in range(120)]
    expected = brute_lines(texts)
    rows = line_dedup.report(documents(spark, texts)).collect()
    assert {(r.doc_id, k) for r in rows for k in r.removed_lines} == expected
    assert len(expected) > 200
    by_id = {r.doc_id: (r.n_lines, r.n_removed) for r in rows}
    assert (by_id[None], by_id[901], by_id[902], by_id[903]) == ((1, 0), (0, 0), (1, 0), (2, 0))
    kept = {r.doc_id: r for r in line_dedup.keep(documents(spark, texts)).collect()}
    for d, t in enumerate(texts):
        left = "\n".join(x for k, x in enumerate(t.split("\n")) if (d, k) not in expected)
        assert (d not in kept) == (left != t and not left.split())
        if d in kept:
            assert (kept[d].text, kept[d].n_chars, kept[d].root) == (left, len(left), "r")
    assert kept[901].text is None
    assert line_dedup.report(documents(spark, []).limit(0)).count() == 0


def test_lines_post_packed_and_copies_once(spark):
    """Of equal lines in any number of tasks the earliest posts alone; postings take fewer bytes than in rows and come out as they went in."""
    rnd = random.Random(31)
    lines = [prose(rnd, 30) for _ in range(300)]
    docs = documents(spark, ["\n".join(lines[k % 300] for k in range(d, d + 20)) for d in range(0, 1200, 10)]).repartition(4, "doc_id")
    with line_dedup.Scratch(spark) as scratch:
        scan = line_dedup.scanned(docs, scratch)
        counts, words = line_dedup.word_counts(scan)
        equal, copies = line_dedup.equals(scan, scratch)
        assert equal.where("first").count() == 300
        rows = line_dedup.postings(docs, counts, 4, copies).collect()
    assert words == 120 * 20 * 30
    assert sum(r.rows for r in rows) == sum(len(set(x.split())) - math.ceil(0.8 * len(set(x.split()))) + 1 for x in lines)
    found = [(r.part, line_dedup.unpacked(r.rows, r.size, bytes(r.packed))) for r in rows]
    assert all((x["t"] >> 36 == part).all() and (np.diff(x["t"]) >= 0).all() for part, x in found)
    assert {(int(d), int(k)) for _, x in found for d, k in zip(x["doc_id"], x["line"], strict=True)} == {(d, k) for d in range(30) for k in range(20) if d == 0 or k >= 10 and d < 29}
    x = {k: rnd_.astype(kind) for (k, kind), rnd_ in zip(line_dedup.FIELDS.items(), np.random.default_rng(2).integers(0, 1 << 12, (8, 5000)), strict=True)}
    x["t"] = np.sort(x["t"])
    size, raw = line_dedup.packed(x)
    assert all((v == x[k]).all() for k, v in line_dedup.unpacked(5000, size, raw).items())
    assert len(raw) < 20 * 5000


def test_lines_open_after_the_first_pass(spark, monkeypatch):
    """A line whose first partners fail, though there are more, is joined again with all of them."""
    first = line_dedup.verified
    calls = []

    def failing(pairs, docs, scratch):
        near, sets = first(pairs, docs, scratch)
        calls.append(1)
        return (near.where("false"), sets) if len(calls) == 1 else (near, sets)

    rnd = random.Random(15)
    texts = []
    for _ in range(40):
        base = prose(rnd, 30, 300).split()
        texts += [" ".join(base[: 30 - k] + [f"v{rnd.randrange(10**6)}" for _ in range(k)]) for k in (2, 1, 1, 2, 1, 0)]
    expected = brute_lines(texts)
    monkeypatch.setattr(line_dedup, "verified", failing)
    found = {(r.doc_id, k) for r in line_dedup.report(documents(spark, texts)).collect() for k in r.removed_lines}
    assert len(calls) == 2
    assert found <= expected
    assert len(found) > 100


@pytest.mark.parametrize("hot", [1 << 16, 40, 1])
def test_postings_and_filters_lose_nothing(monkeypatch, hot):
    """All pairs at the threshold share a posted word, or pair of hot words, and pass the filters; lines of a group of near copies look at few pairs."""
    monkeypatch.setattr(line_dedup, "HOT", hot)
    rnd = random.Random(hot)
    bases = [prose(rnd, rnd.randrange(4, 90), 60) for _ in range(25)]
    texts = [edited(rnd, rnd.choice(bases), rnd.choice([0.01, 0.05, 0.1])) for _ in range(150)] + ["a third of all lines hold this", *(prose(rnd, k, 5) for k in range(1, 9))]
    buf, at = next(line_dedup.vec.slices(pa.array(["\n".join(texts)])))[2:]
    w = line_dedup.vec.words(buf, at)
    counts = np.bincount((w.hash >> np.uint64(44)).astype(np.int64), minlength=1 << 20).astype(np.int32)
    x = line_dedup.Lines(w, counts)
    t, line, pos = line_dedup.posted(x.h, x.off, np.arange(len(x.n)), counts)
    order = np.lexsort((x.n[line], t))
    t, line, pos = t[order], line[order], pos[order]
    b0, b1 = x.parity()
    rows = {"t": t.view(np.int64), "n": x.n[line], "pos": pos, "doc_id": np.zeros(len(t), np.int64), "line": x.number[line], "s1": x.s1[line].view(np.int64), "b0": b0[line], "b1": b1[line]}
    i, j, _ = line_dedup.survivors(rows, np.ones(len(t), bool))
    found = set(zip(rows["line"][i].tolist(), rows["line"][j].tolist(), strict=True))
    sets = [frozenset(v.split()) for v in texts]
    similar = {(b, a) for b in range(len(sets)) for a in range(b) if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]) and sets[a] != sets[b]}
    assert similar <= found
    assert len(similar) > 100
    i, j, more = line_dedup.survivors(rows)
    some = set(zip(rows["line"][i].tolist(), rows["line"][j].tolist(), strict=True))
    assert some <= found
    closed = {b for b, a in some & similar}
    open_ = set(rows["line"][i[more]].tolist())
    assert {b for b, _ in similar} <= closed | open_
    assert len(some) < len(found)


# ---- benchmark ----

ITEM = "Alice buys 12 apples and gives 5 of them to her friend Bob before she walks home again with Carol and the 12 dogs"


def test_decontamination(spark):
    rnd = random.Random(9)
    around = lambda t: f"{prose(rnd, 40)} {t} {prose(rnd, 40)}"
    moved = ITEM.replace("12", "31").replace("5", "8").replace("Bob", "Zoe").replace("Carol", "Dan")
    torn = ITEM.replace("the 12", "the 77")  # one slot in the item, two in the text
    texts = [around(ITEM), around(moved), around(torn), prose(rnd, 200), around(" ".join(ITEM.split()[:12])), around(" ".join(ITEM.split()[3:20])), ITEM]
    benchmark = spark.createDataFrame([(0, ITEM, "x"), (1, None, "x"), (2, "too short", "x"), (None, ITEM, "x"), (3, prose(rnd, 9), "x")], "item_id bigint, text string, t string")
    rows = {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(documents(spark, texts), benchmark).collect()}
    assert set(rows) == {(0, 0), (1, 0), (2, 0), (5, 0), (6, 0)}  # 2: verbatim but for one of two places of a number
    assert (rows[0, 0].exact, rows[1, 0].exact, rows[6, 0].exact) == (True, False, True)
    kept = decontaminate.clean(documents(spark, texts), benchmark)
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [3, 4, 901, 902, 903]
    assert kept.columns == documents(spark, texts).columns
    assert decontaminate.contaminated(documents(spark, texts), benchmark.limit(0)).count() == 0
    assert decontaminate.contaminated(documents(spark, []).limit(0), benchmark).count() == 0


def test_decontamination_equals_brute_force(spark):
    """Random items of few words with many slots, in documents that tear, refill and cut them."""
    rnd = random.Random(31)
    plain = [f"p{c}" for c in "abcdefghijkl"]

    def item():
        return [str(rnd.randrange(20, 24)) if rnd.random() < 0.25 else rnd.choice(plain) for _ in range(rnd.randrange(10, 30))]

    items = [item() for _ in range(12)]
    docs = []
    for _ in range(150):
        words = list(rnd.choice(items))
        kind, moved = rnd.randrange(4), {str(x): str(rnd.randrange(20, 28)) for x in range(20, 24)}
        if kind == 1:
            words = [moved.get(w, w) for w in words]
        elif kind == 2:
            words = [str(rnd.randrange(20, 28)) if w.isdigit() else w for w in words]
        if kind:
            for _ in range(rnd.randrange(3)):
                words[rnd.randrange(len(words))] = rnd.choice([*plain, "25"])
        docs.append(["qa"] * rnd.randrange(4) + words[rnd.randrange(4) :] + ["qb"] * 3)

    def found(doc, of):
        at = [k for k in range(len(of) - 7)]
        strong = {k: sum(not w.isdigit() for w in of[k : k + 8]) >= 4 for k in at}
        best: set[int] = set()
        very = {k for k in at if (not strong[k] or k == 0) and any(doc[d : d + 8] == of[k : k + 8] for d in range(len(doc) - 7))}
        for offset in range(-len(of), len(doc)):
            run = [k for k in at if strong[k] and 0 <= k + offset <= len(doc) - 8 and all(a == b or (a.isdigit() and b.isdigit()) for a, b in zip(of[k : k + 8], doc[k + offset : k + offset + 8], strict=True))]
            pairs = {k: {(a, b) for a, b in zip(of[k : k + 8], doc[k + offset : k + offset + 8], strict=True) if a.isdigit()} for k in run}
            fine = lambda ks: len(u := set().union(*(pairs[k] for k in ks))) == len({a for a, _ in u})  # noqa: B023, E731
            longest = max((run[x:y] for x in range(len(run)) for y in range(x + 1, len(run) + 1) if fine(run[x:y])), key=lambda ks: (ks[-1] - ks[0], -ks[0]), default=[])
            best |= set(longest) | {k for k in run if doc[k + offset : k + offset + 8] == of[k : k + 8]}
        best |= very
        templates = {k for k in at if strong[k]}
        return len({k + j for k in best for j in range(8)}) >= 13 or best >= set(at) or bool(templates) and best >= templates

    expected = {(d, k) for d, doc in enumerate(docs) for k, of in enumerate(items) if found(doc, of)}
    benchmark = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id bigint, text string")
    rows = decontaminate.contaminated(documents(spark, [" ".join(w) for w in docs], extra=False), benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == expected
    assert 50 < len(expected) < 150


def test_decontamination_with_values_that_fall_together(spark):
    """Unit plurals are one value, and two values of the item may meet the same one of the document."""
    item = "the slow train waits 1 hour at the old bridge and then waits another 2 hours near the small harbour before it leaves for 3 days"
    moved = item.replace("1 hour ", "3 hours ").replace("2 hours", "4 hours")
    less = item.replace("1 hour ", "9 hours ").replace("2 hours", "1 hour")
    equal = item.replace("1 hour ", "7 hour ").replace("2 hours", "7 hours")
    benchmark = spark.createDataFrame([(0, item)], "item_id bigint, text string")
    rows = decontaminate.contaminated(documents(spark, [item, moved, less, equal]), benchmark).collect()
    assert sorted((r.doc_id, r.exact) for r in rows) == [(0, True), (1, False), (2, False), (3, False)]


def test_decontamination_of_items_without_plain_windows(spark):
    """Arithmetic, Title Case and short items are found where a document holds them verbatim."""
    items = ["What is 12 + 7 - 3 * 5 + 88 / 4 - 6 + 19 ?", "Which Old King Of Northern Wessex Fought The Danes Near Ashdown Hill", "2 + 2 = ?", "Who wrote Faust", "Alice likes to walk her small dogs at night"]
    around = lambda t: f"before that we read quietly {t} and then we went on"
    texts = [around(t) for t in items] + [around("2 2"), around("2 - 2"), around("who else wrote Faust"), around("What is 12 + 7 - 3 * 5 + 88 / 4 - 6 + 20 ?"), items[2]]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    rows = decontaminate.contaminated(documents(spark, texts), benchmark).collect()
    assert sorted((r.doc_id, r.item_id) for r in rows) == [(0, 0), (1, 1), (2, 2), (3, 3), (4, 4), (9, 2)]
    assert all(r.exact for r in rows if r.item_id != 4)
    assert {r.item_id: r.n_words for r in rows}[3] == 3


# ---- quality rules ----


def brute_counts(text):
    import re

    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    places = collections.defaultdict(list)
    for k in range(len(w) - 2):
        places[tuple(w[k : k + 3])].append(k)
    covered = {k + j for v in places.values() if len(v) > 1 for k in v for j in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), sum(x in lines[:k] for k, x in enumerate(lines)), len(covered), len(lines)


def test_counts():
    rnd = random.Random(2)
    for _ in range(500):
        t = "".join(rnd.choices("ab #|\n\té", k=rnd.randrange(80)))
        assert tuple(quality_rules.counts_of(pa.array([t]))[0]) == brute_counts(t)
    texts = ["".join(rnd.choices("ab #|\n\té", k=rnd.randrange(80))) for _ in range(300)] + [None, "", "x " * 300_000]
    assert [tuple(x) for x in quality_rules.counts_of(pa.array(texts))] == [brute_counts(t or "") for t in texts]


def test_quality_rules(spark):
    rnd = random.Random(4)
    junk = " ".join(f"{w}%%%" for w in prose(rnd, 80).split())
    texts = [prose(rnd, 120) for _ in range(150)] + [junk, "same words here " * 60]
    rows = {r.doc_id: r for r in quality_rules.report(documents(spark, texts)).collect()}
    assert all(rows[k].kept for k in range(150))
    assert not rows[150].kept
    assert (rows[150].base_failed, rows[151].base_failed, rows[901].base_failed, rows[901].n_words) == (False, True, True, 0)
    assert sorted(r.doc_id for r in quality_rules.keep(documents(spark, texts)).collect() if r.doc_id is not None) == list(range(150))
    assert quality_rules.report(documents(spark, []).limit(0)).count() == 0


# ---- SQL ----


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_equals_sql(spark, name):
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    df = queries.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = c.execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in got.description]
    assert sorted(names) == columns
    assert sorted(repr([r[x] for x in columns]) for r in df.collect()) == sorted(repr([r[names.index(x)] for x in columns]) for r in got.fetchall())


# ---- licences ----


def cosine(text):
    l = license_scan  # noqa: E741
    best = []
    import re

    for unit in {*text.split("\n"), text, *(p for p in re.split(r"\n[ \t\r]*\n", text) if "\n" in p.strip())}:
        c = collections.Counter(l.words_of(unit))
        y = {w: n * l.IDF.get(w, l.UNKNOWN) for w, n in c.items()}
        norm = math.sqrt(sum(v * v for v in y.values()))
        best += [(-round(sum(v[w] * y[w] for w in y if w in v) / norm * 10000), name) for (name, _), v in zip(l.TEMPLATES, l.VECTORS, strict=True) if norm]
    best = [b for b in best if -b[0] >= l.THRESHOLD]
    return min(best, default=None)


def test_licenses(spark):
    rows = [
        (1, "a/LICENSE", dict(license_scan.TEMPLATES)["MIT"]), (2, "a/b/x.py", "code here"), (3, "a/b/c/y.py", "# Licensed under the Apache License, Version 2.0.\nmore code"), (4, "a/b/LICENSE.txt", "Licensed under CC BY-NC 4.0."),
        (5, "z/q.txt", "nothing"), (6, None, "Released under the MIT License."), (7, "a/z", None), (8, "", "x"), (2, "a/b/x.py", "code here"), (9, "top", "y"), (10, "a/b/w", "a license of the work to copy " + "word " * 50),
    ]
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id bigint, path string, text string, license int")
    got = collections.defaultdict(list)
    for r in license_scan.scan(df).collect():
        got[r.doc_id].append((r.license, r.how, r.declared_in))
    assert dict(got) == {
        1: [("MIT", "header", None)], 2: [("CC-BY-NC-4.0", "inherited", "a/b")] * 2, 3: [("Apache-2.0", "header", None)], 4: [("CC-BY-NC-4.0", "header", None)], 5: [(None, None, None)],
        6: [("MIT", "header", None)], 7: [("MIT", "inherited", "a")], 8: [(None, None, None)], 9: [(None, None, None)], 10: [("CC-BY-NC-4.0", "inherited", "a/b")],
    }
    assert license_scan.scan(df.limit(0)).count() == 0


COMMON = "/usr/share/common-licenses"


@pytest.mark.skipif(not os.path.isdir(COMMON), reason="no licence texts on this machine")
def test_standard_licence_files_declare_their_folders(spark):
    """Whole licence texts, as distributions carry them, declare the folders that they lie in."""
    names = {"Apache-2.0": "Apache-2.0", "BSD": "BSD-3-Clause", "CC0-1.0": "CC0-1.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0", "MPL-2.0": "MPL-2.0", "GFDL-1.3": "GFDL-1.3"}
    names = {k: v for k, v in names.items() if os.path.isfile(f"{COMMON}/{k}")}
    rows = [x for k, n in enumerate(names) for x in ((k, f"{n}/LICENSE", open(f"{COMMON}/{n}", encoding="utf-8", errors="replace").read()), (100 + k, f"{n}/src/a.c", "int main;"))]
    rows += [(200, "isc/COPYING", f"Copyright x\n\n{dict(license_scan.TEMPLATES[::-1])['ISC']}"), (201, "isc/y", "z"), (202, "two/LICENSE.md", license_scan._BSD + "\n\n" + license_scan._BSD_END), (203, "two/y", "z")]
    got = {r.doc_id: (r.license, r.how) for r in license_scan.scan(spark.createDataFrame(rows, "doc_id bigint, path string, text string")).collect()}
    assert {n: got[100 + k] for k, n in enumerate(names)} == {n: (v, "inherited") for n, v in names.items()}
    assert (got[201], got[203]) == (("ISC", "inherited"), ("BSD-2-Clause", "inherited"))


def test_anchors_lose_nothing(spark):
    """Every unit at the threshold holds an anchor, and the scores are those of plain arithmetic."""
    import re

    rnd = random.Random(8)
    texts = []
    for _, t in license_scan.TEMPLATES:
        for _ in range(12):
            words = [w for w in t.split() if rnd.random() < 0.75] + [f"x{rnd.randrange(99)}" for _ in range(rnd.randrange(3))]
            texts.append(" ".join(words))
    rows = {r.doc_id: r for r in license_scan.scan(spark.createDataFrame([(k, f"d{k}/f", t) for k, t in enumerate(texts)], "doc_id bigint, path string, text string")).collect()}
    for k, t in enumerate(texts):
        best = cosine(t)
        assert (None if best is None else best[1], None if best is None else -best[0]) == (rows[k].license, rows[k].score)
        if best:
            assert re.search(license_scan._ANCHOR, t)


# ---- empirical Bayes ----


def test_posteriors_equal_numpy(spark):
    rnd = np.random.default_rng(1)
    rows = [(k, f"h{k % 7 if k % 3 else 0}", f"p{k % 4}" if k % 5 else None, float(np.clip(rnd.beta(2, 2) + 0.1 * (k % 7) - 0.3, 0.01, 0.99))) for k in range(600)]
    got = {r.doc_id: r for r in quality_bayes.posteriors(spark.createDataFrame(rows, "doc_id bigint, host string, path string, p double")).collect()}
    p = np.array([r[3] for r in rows])
    theta = (p.sum() + 1) / (len(p) + 2)

    def strength(keys, parents):
        spread = noise = pq = n = 0.0
        for key in set(keys):
            x = p[[k == key for k in keys]]
            if len(x) > 1:
                m = parents(key)
                spread, noise, pq, n = spread + len(x) * (x.mean() - m) ** 2, noise + x.var(), pq + len(x) * m * (1 - m), n + len(x)
        between = (spread - noise) / n
        return quality_bayes.STRONGEST if between <= 0 else min(quality_bayes.STRONGEST, max(quality_bayes.WEAKEST, pq / n / between - 1))

    hosts, paths = [r[1] for r in rows], [(r[1], r[2]) for r in rows]
    of_host = {h: p[[x == h for x in hosts]] for h in set(hosts)}
    of_path = {h: p[[x == h for x in paths]] for h in set(paths)}
    mh, mp = strength(hosts, lambda _: theta), strength(paths, lambda k: of_host[k[0]].mean())
    lo = lambda x: math.log(x / (1 - x))
    for k, h, path, x in rows:
        a, b = of_host[h], of_path[h, path]
        host = (a.sum() - x + mh * theta) / (len(a) - 1 + mh)
        at = (b.sum() - x + mp * host) / (len(b) - 1 + mp)
        z = lo(x) + max(-quality_bayes.LIMIT, min(quality_bayes.LIMIT, lo(at) - lo(theta)))
        assert (got[k].host_post, got[k].path_post, got[k].score) == pytest.approx((host, at, 1 / (1 + math.exp(-z))))


def test_quality_classifier(spark):
    rnd = random.Random(6)
    texts = [prose(rnd, 100) if k % 2 else "bad %%% " * 40 for k in range(80)]
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(60)] + [(None, 1, 1), (3, None, None)], "doc_id bigint, quality int, toxic int")
    docs = documents(spark, texts).withColumnsRenamed({"source": "host", "lang": "path"})
    rows = {r.doc_id: r for r in quality_bayes.scored(docs, labels).collect()}
    assert all(rows[k].good == bool(k % 2) for k in range(80))
    assert len(rows) == 84
    assert {r.doc_score for r in quality_bayes.scored(docs, labels.limit(0)).collect()} == {0.5}
    assert quality_bayes.scored(docs.limit(0), labels).count() == 0


def test_quality_from_text_to_score(spark):
    """Against plain arithmetic over whole texts; a rich bad site moves a doubtful document, a sparse one hardly does."""
    rnd = random.Random(21)
    rows = []
    for k in range(400):
        host, junk = ("bad", k % 8 > 0) if k % 2 else ("fine", k % 16 == 0)
        text = prose(rnd, 60 + k % 50)
        words = text.split()
        for j in range(rnd.randrange(12, 40) if junk else rnd.randrange(8)):
            words[rnd.randrange(len(words))] += "%" * (1 + j % 3)
        rows.append((k, " ".join(words), host, f"p{k % 3}", int(not junk)))
    doubtful = " ".join(w + ("%%" if k % 9 == 0 else "") for k, w in enumerate(prose(rnd, 90).split()))
    rows += [(1000, doubtful, "bad", "p0", None), (1001, doubtful, "rare", "p0", None), (1002, doubtful, "fine", "p0", None), (1003, None, None, None, None)]
    docs = spark.createDataFrame([r[:4] for r in rows], "doc_id bigint, text string, host string, path string")
    labels = spark.createDataFrame([(r[0], r[4]) for r in rows if r[4] is not None] + [(7, 1 - rows[7][4])], "doc_id bigint, quality int")
    got = {r.doc_id: r for r in quality_bayes.scored(docs, labels).collect()}

    def rates(text):
        n, chars, symbols, dup, repeats, lines = brute_counts(text or "")
        return [math.log((symbols + 1) / (chars + 1)), math.log((dup + 1) / (lines + 1)), math.log((repeats + 1) / (n + 1)), math.log(1 + n), min(chars / max(n, 1), 20) / 10]

    x = np.array([rates(r[1]) for r in rows])
    some = [k for k, r in enumerate(rows) if r[4] is not None and r[0] != 7]  # 7 has both labels
    beta = quality_bayes.fitted(x[some], np.array([rows[k][4] for k in some], float))
    p = 1 / (1 + np.exp(-(np.column_stack([np.ones(len(x)), x]) @ beta)))
    assert [got[r[0]].doc_score for r in rows] == pytest.approx(list(p), rel=1e-6)
    score, post = {k: got[k].score for k in got}, {k: got[k].path_post for k in got}
    assert score[1000] < score[1001] < score[1002]
    theta = (p.sum() + 1) / (len(p) + 2)
    assert abs(post[1001] - theta) < 0.2 * abs(post[1000] - theta)


# ---- toxicity ----


@pytest.fixture(scope="module")
def model():
    words = " ".join(["idiot moron stupid loser scum clown trash pathetic the and house water people little other school number"] * 30)
    return toxicity.log_probabilities(toxicity._trigrams(words.encode()))


@pytest.mark.parametrize(("seen", "meant"), [("1d10t", "idiot"), ("m0r0n", "moron"), ("$tup1d", "stupid"), ("s.t.u.p.i.d", "stupid"), ("iiidiooot", "idiot"), ("l0$er", "loser"), ("p@thet1c!!!", "pathetic"), ("cl*wn", "clown"), ("house", "house"), ("Tr@sh,", "trash")])
def test_deobfuscation(model, seen, meant):
    assert toxicity.restored(seen, model) == meant


def test_toxicity(spark):
    rnd = random.Random(11)
    bad, hidden = ["idiot", "moron", "scum", "clown"], ["1d10t", "m o r o n", "$cum", "cl0wwwn"]
    texts, toxic = [], []
    for k in range(700):
        w = prose(rnd, 60, 800).split()
        if k % 3 == 0:
            for _ in range(3):
                w.insert(rnd.randrange(len(w)), rnd.choice(hidden if k % 2 else bad))
        texts.append(" ".join(w))
        toxic.append(int(k % 3 == 0))
    labels = spark.createDataFrame([(k, 1, t) for k, t in enumerate(toxic)] + [(None, 1, 1)], "doc_id bigint, quality int, toxic int")
    rows = [r for r in toxicity.scored(documents(spark, texts), labels).collect() if r.doc_id is not None and r.doc_id < 900]
    import zlib

    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.predicted == toxic[r.doc_id] for r in held) / len(held) >= 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert len({r.score for r in toxicity.scored(documents(spark, texts[:5]), labels.limit(0)).collect()}) == 1
    assert toxicity.scored(documents(spark, []).limit(0), labels).count() == 0


def test_long_spaced_runs_are_restored_whole(model):
    """A toxic word beyond the 4,096th letter set apart is restored like one before."""
    letters = "house" * 1000 + "moron" + "water" * 20
    buf = np.frombuffer(" ".join(letters).encode(), np.uint8)
    *_, texts, found = toxicity.extra_words(toxicity.vec.words(buf, np.array([0, len(buf)])), model)
    assert set(texts) == {0}
    assert "".join(found) == letters


@pytest.mark.parametrize("seen", ["s,t,u,p,i,d", "s\u200bt\u200bup\u200bid", "s'tu`pid", "s/t/u/p/i/d", "s:t;u^p\u00b7id", "stup\u00adid", "y o u s t u p i d", "a s t u p i d", "I s t u p i d", "h o u s e " * 900 + "s t u p i d"])
def test_obfuscations_reach_the_lattice(model, seen):
    """The toxic word is a feature, whatever splits its letters and whatever stands before them."""
    lexicon = toxicity.Lexicon(toxicity.vec.mix(toxicity.vec.words(b := np.frombuffer(b"stupid", np.uint8), np.array([0, len(b)])).hash, 11), np.ones(1))
    ((_, _, parts),) = toxicity.slices_of(toxicity.pa.array([seen]), model)
    assert toxicity._evidence(lexicon, 1, parts)[0, 2] == 1
    ((_, _, parts),) = toxicity.slices_of(toxicity.pa.array(["the house 4 5 5 t h e h o u s e"]), model)
    assert toxicity._evidence(lexicon, 1, parts)[0, 2] == 0


# ---- pipeline ----


def test_pipeline_stages(spark, copies, tmp_path):
    import corpus_pipeline

    rnd = random.Random(12)
    item = " ".join("".join(rnd.choices("aeioulmnrst", k=6)) for _ in range(30))
    texts = [prose(rnd, 90) for _ in range(30)]
    texts += [texts[0], texts[1] + " more words", "junk %%% " * 50, prose(rnd, 80) + " " + item + " " + prose(rnd, 10), texts[2][:200]]
    documents(spark, texts).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(0, item)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert [k for k, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "near dedup", "decontamination", "byte-level BPE"]
    ids = sorted(r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect() if r.doc_id is not None)
    assert ids == list(range(30))


def test_pipeline_equals_brute_force(spark):
    """Each stage over what its predecessor kept of a whole table, against SQL, loops over all pairs, and tiktoken."""
    import hashlib

    import corpus_pipeline
    import public_tokenizers
    import tiktoken
    from tiktoken.load import load_tiktoken_bpe

    stages = dict(corpus_pipeline.STAGES)
    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    now = {r.doc_id: r for r in docs.collect()}

    def staged(name):
        nonlocal docs, now
        docs = spark.createDataFrame(rows := stages[name](spark, docs, SF).collect(), docs.schema) if name != "byte-level BPE" else stages[name](spark, docs, SF)
        return {r.doc_id: r for r in (rows if name != "byte-level BPE" else docs.collect())}

    kept = {r[0] for r in c.execute(f"SELECT doc_id FROM ({queries.ORACLE_SQL['op9_quality_rules']}) WHERE kept").fetchall()}
    now = staged("quality rules")
    assert set(now) == kept

    ids = sorted(now)
    gone = {(ids[d], k) for d, k in brute_lines([now[i].text for i in ids])}
    left = {i: "\n".join(x for k, x in enumerate(now[i].text.split("\n")) if (i, k) not in gone) for i in ids}
    now = staged("line dedup")
    assert {i: r.text for i, r in now.items()} == {i: t for i, t in left.items() if t.split()}

    sets = {i: {tuple((w := r.text.split())[k : k + 5]) for k in range(max(1, len(r.text.split()) - 4))} for i, r in now.items()}
    parent = {i: i for i in sets}
    find = lambda x: x if parent[x] == x else find(parent[x])
    for a, b in itertools.combinations(sorted(sets), 2):
        small, large = sorted((len(sets[a]), len(sets[b])))
        if large <= 1.25 * small and len(sets[a] & sets[b]) >= 0.8 * small:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    best = {}
    for i in sorted(sets):
        if find(i) not in best or len(sets[i]) > len(sets[best[find(i)]]):
            best[find(i)] = i
    now = staged("near dedup")
    assert set(now) == set(best.values())

    items = [" ".join(r[0].lower().split()) for r in c.execute(f"SELECT text FROM '{SF}/benchmark.parquet'").fetchall()]
    before = now
    now = staged("decontamination")
    clean = lambda t: [w.strip(".,;:!?\"'()") for w in t.lower().split()]
    grams = {tuple(w[k : k + 13]) for t in items for w in [clean(t)] for k in range(len(w) - 12)}
    holding = {i for i, r in before.items() if any(tuple((w := clean(r.text))[k : k + 13]) in grams for k in range(len(clean(r.text)) - 12))}
    assert holding <= set(before) - set(now)
    assert all(any(set(clean(before[i].text)) & set(clean(t)) for t in items) for i in set(before) - set(now))

    texts = {i: r.text for i, r in now.items()}
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_tiktoken_bpe(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    now = staged("byte-level BPE")
    digest = lambda t: hashlib.sha256(np.array(enc.encode_ordinary(t), "<u4").tobytes()).hexdigest()
    assert {i: r.ids_sha256 for i, r in now.items()} == {i: digest(t) for i, t in texts.items()}
